"""Byte-level substring dedup against brute force over all 200-byte strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from edge_tables import PASSAGE, edge_documents
from faultline.llm import suffix_family
from faultline.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
WIDTH = suffix_family.WINDOW


def expected(rows):
    texts = [(i, (text or "").encode()) for i, text in rows]
    counts = Counter(data[a : a + WIDTH] for _, data in texts for a in range(len(data) - WIDTH + 1))
    out = []
    for i, data in texts:
        gone, end = bytearray(len(data)), 0
        for a in range(len(data) - WIDTH + 1):
            if counts[data[a : a + WIDTH]] > 1:
                gone[max(a, end) : a + WIDTH] = b"\1" * (a + WIDTH - max(a, end))
                end = a + WIDTH
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert got(QUERIES["op7_suffix_family"](spark, DATA)) == expected(rows)


def test_edge_cases(spark):
    docs = edge_documents(spark).filter("doc_id is null or doc_id not in (9, 10)")
    assert got(suffix_family.removable(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert suffix_family.removable(edge_documents(spark, rows=False)).count() == 0


@pytest.mark.parametrize("hot", [2, 1024])
def test_passages_in_many_surroundings(spark, monkeypatch, hot):
    draw = random.Random(8)
    noise = lambda n: "".join(draw.choice("abcd é\n") for _ in range(n))
    whole = noise(500) + "\0\0\0" + noise(120)
    rows = []
    for i in range(120):
        low = draw.randrange(0, 300)
        text = noise(draw.randrange(0, 300)) + whole[low : low + draw.randrange(150, 420)] + noise(draw.randrange(0, 300))
        rows.append((i, text if i % 10 else text + PASSAGE * 3))
    monkeypatch.setattr(suffix_family, "HOT_CONTEXTS", hot)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got(suffix_family.removable(docs)) == expected(rows)


def test_family_of_levels_equals_one_array():
    draw = np.random.default_rng(3)
    texts = [bytes(draw.integers(97, 99, 30)) + b"anchor" * 40 + bytes(draw.integers(97, 99, 140)) for _ in range(90)]
    offset = draw.integers(20, 31, 90)
    starts = offset - draw.integers(0, 15, 90)
    bodies = [t[30 - o : 30 - o + n + WIDTH - 1] for t, o, n in zip(texts, offset.tolist(), starts.tolist())]
    gram, data = np.zeros(90, dtype=np.uint64), np.frombuffer(b"".join(bodies), dtype=np.uint8)
    windows = Counter(b[a : a + WIDTH] for b in bodies for a in range(len(b) - WIDTH + 1))
    want = [[windows[b[a : a + WIDTH]] > 1 if a < n else False for a in range(suffix_family.REACH + 1)] for b, n in zip(bodies, starts.tolist())]
    for size in (7, 30, 1000):
        assert suffix_family.repeated_ranges(gram, data, offset, starts, size).tolist() == want
    family = suffix_family.IndexFamily()
    for at in range(0, 90, 10):
        some = slice(at, at + 10)
        begin = np.cumsum([0] + [len(b) for b in bodies])[:-1]
        family.add(suffix_family.Contexts.of(gram[some], data, begin[some], offset[some], starts[some], np.arange(90)[some]))
    assert [level.generation for level in family.levels] == [3, 0]


def test_every_window_has_one_anchor_by_content():
    draw = np.random.default_rng(1)
    data = draw.integers(97, 100, 900).astype(np.uint8)
    twice = np.concatenate([data, draw.integers(97, 100, 333).astype(np.uint8), data])
    _, _, first, starts, offset = suffix_family.anchors(twice)
    assert np.array_equal(first, np.concatenate([[0], np.cumsum(starts)[:-1]])) and first[-1] + starts[-1] == len(twice) - WIDTH + 1
    assert offset.max() <= suffix_family.REACH and (offset - starts + 1).min() >= 0
    places = np.repeat(first + offset, starts)
    n = len(data) - WIDTH + 1
    assert np.array_equal(places[:n], places[-n:] - (len(twice) - len(data)))


def test_rows_keep_their_places_whatever_their_arrival():
    import pyarrow as pa

    from faultline.llm.batches import in_order

    rows = [(3, "b"), (1, "z"), (None, "n"), (3, "a"), (1, "z")]
    tables = [pa.table({"doc_id": pa.array([i for i, _ in some], pa.int64()), "text": [t for _, t in some]}) for some in (rows, rows[::-1], sorted(rows, key=repr))]
    assert len({str(in_order(t).to_pylist()) for t in tables}) == 1
