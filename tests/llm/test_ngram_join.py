"""The n-gram join against brute force over all pairs."""

import random
import tracemalloc
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from edge_tables import edge_documents
from faultline.llm import ngram_join
from faultline.llm.queries import QUERIES

WORDS = [f"w{i}" for i in range(3000)]


def slow_groups(rows, shingle=4, similarity=Fraction(17, 20)):
    sets = []
    for r in rows:
        words = (r.text or "").encode().lower().split()
        sets.append({tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set())
    root = list(range(len(rows)))
    for i, one in enumerate(sets):
        for j, other in enumerate(sets[:i]):
            common = len(one & other)
            if one and other and common * similarity.denominator >= (len(one) + len(other) - common) * similarity.numerator:
                old, new = root[i], root[j]
                root = [min(old, new) if r in (old, new) else r for r in root]
    low = {}
    for r, top in zip(rows, root):
        low[top] = min((i for i in (low.get(top), r.doc_id) if i is not None), default=None)
    return sorted(((r.doc_id, len(s), low[top]) for r, s, top in zip(rows, sets, root)), key=repr)


def got(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()
    assert got(QUERIES["op11_ngram_join"](spark, f"/root/testdata/{sf}")) == slow_groups(docs)


@pytest.mark.parametrize("batch_bytes", [1 << 25, 50_000])
def test_edge_cases(spark, batch_bytes):
    docs = edge_documents(spark)
    assert got(ngram_join.similar_groups(docs, batch_bytes=batch_bytes)) == slow_groups(docs.collect())
    assert ngram_join.similar_groups(edge_documents(spark, rows=False)).count() == 0


def edited(base, rng, share):
    return [rng.choice(WORDS) if rng.random() < share else w for w in base]


@pytest.mark.parametrize("rounds, pairs", [(8, 4), (0, 4), (8, 0)])
def test_groups_of_edited_copies(spark, monkeypatch, rounds, pairs):
    """Groups whose members differ by more or less than the limit allows, and lengths that differ; by hubs, at once, and hubs to the end."""
    monkeypatch.setattr(ngram_join, "ROUNDS", rounds)
    monkeypatch.setattr(ngram_join, "PAIRS_PER_POSTING", pairs)
    rng = random.Random(5)
    texts = []
    for share in (0.002, 0.01, 0.02, 0.04):
        base = rng.choices(WORDS, k=120)
        texts += [edited(base, rng, share)[: rng.randint(100, 120)] for _ in range(40)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(5)
    assert got(ngram_join.similar_groups(docs, batch_bytes=20_000)) == slow_groups(docs.collect())


def test_prefixes_hold_a_common_gram():
    """Any two sets at the limit share an n-gram in the smaller one's index prefix and the other's probe prefix."""
    t = Fraction(17, 20)
    for small in range(1, 120):
        for large in range(small, int(small / t) + 1):
            need = -(-t.numerator * (small + large) // (t.numerator + t.denominator))
            if need <= small:
                index, probe = ngram_join.prefix_sizes(small, t)[0], ngram_join.prefix_sizes(large, t)[1]
                assert small - need + 1 <= index and large - need + 1 <= probe


def test_packed_numbers_come_back():
    values = np.array([0, 1, 255, 256, 1 << 31, (1 << 32) - 1], dtype=np.uint32)
    assert ngram_join.from_planes(ngram_join.planes(values)).tolist() == values.tolist()


def test_a_batch_is_named_in_little_memory():
    """Naming and packing a batch's n-grams takes at most three times the hashes (seven times before), whatever sets and copies it has."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 50_000, 4000)) for _ in range(100)]
    texts += texts[:5] + ["", None, texts[0] + " " + texts[1]]
    table = pa.table({"batch": pa.array([7] * len(texts)), "doc_id": pa.array(range(len(texts))), "text": pa.array(texts, pa.string())})
    parts = 11
    hashes = [ngram_join.hashed_set(t.encode(), 4) for t in dict.fromkeys(texts) if t]
    keys, counts = np.unique(ngram_join.key_of(np.concatenate(hashes), parts), return_counts=True)
    size = sum(h.nbytes for h in hashes)
    tracemalloc.start()
    try:
        rows = ngram_join.sent_rows(7, ngram_join.named(ngram_join.Batch(table, 4).hashes, parts), parts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [r[:2] for r in rows] == [(7, p) for p in np.unique(keys >> np.uint64(32)).tolist()]
    assert np.concatenate([np.cumsum(ngram_join.from_planes(r[2]).astype(np.int64)) for r in rows]).tolist() == (keys & ngram_join.SHORT).tolist()
    assert np.concatenate([ngram_join.from_planes(r[3]) for r in rows]).tolist() == counts.tolist()
    assert peak < 3 * size
