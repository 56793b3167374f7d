"""Word-level substring dedup on passages in many surroundings and many batches; the query itself has SQL."""

import hashlib
import random

from faultline.llm import batches, block_anchors

WIDTH = block_anchors.WINDOW


def expected(rows):
    first, split = {}, [(i, (text or "").split()) for i, text in rows]
    for i, words in split:
        for a in range(len(words) - WIDTH + 1):
            key = tuple(words[a : a + WIDTH])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = {a + k for a in range(len(words) - WIDTH + 1) if first[tuple(words[a : a + WIDTH])] < i for k in range(WIDTH)}
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_passages_in_many_surroundings(spark):
    draw = random.Random(6)
    noise = lambda n: [draw.choice("abcdefgh") + draw.choice("ijkl") for _ in range(n)]
    whole = noise(60)
    rows = []
    for i in range(700):
        low = draw.randrange(0, 40)
        rows.append((i, " ".join(noise(draw.randrange(0, 25)) + whole[low : low + draw.randrange(8, 40)] + noise(draw.randrange(0, 25)))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert len(rows) > 2 * batches.DOCS_PER_BATCH
    assert sorted(tuple(r) for r in block_anchors.removable(docs).collect()) == expected(rows)


def test_any_window_holds_a_whole_block():
    assert all(any(p % block_anchors.BLOCK == 0 for p in range(s, s + WIDTH - block_anchors.BLOCK + 1)) for s in range(50))
