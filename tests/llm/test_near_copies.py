"""Near copies against brute force over all pairs."""

import random

import pytest

import corpus_pipeline
from edge_tables import edge_documents
from faultline.llm import near_copies, ngram_join, simhash

WORDS = [f"w{i}" for i in range(400)]


def slow_sets(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_kept(rows):
    """Ids that stay: the smallest of each component of pairs with a Jaccard similarity of 0.8 or more."""
    rows = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id))
    sets, root = [slow_sets(r.text) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = sets[i] | sets[j]
            if len(sets[i] & sets[j]) * 5 >= len(both) * 4:
                old, new = root[i], root[j]
                root = [min(old, new) if r in (old, new) else r for r in root]
    return sorted((rows[i].doc_id for i in set(root)), key=repr)


def got(frame):
    return sorted((r.doc_id for r in frame.collect()), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_stage_drops_all_near_copies(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    assert got(corpus_pipeline.drop_near_copies(spark, docs, "")) == slow_kept(docs.collect())


def test_one_changed_word_in_a_hundred(spark):
    texts = [WORDS[:100], WORDS[:50] + ["other"] + WORDS[51:100], WORDS[200:300]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    assert got(corpus_pipeline.drop_near_copies(spark, docs, "")) == [0, 2]


def test_chains_and_groups(spark):
    """Every step of a chain is similar to the next only; a group's members are similar to each other."""
    chain = [WORDS[i * 10 : i * 10 + 140] for i in range(12)]
    group = [[f"g{i}" for i in range(200)][:100] + [f"own{k}"] + [f"g{i}" for i in range(100, 200)] for k in range(60)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(chain + group)], "doc_id bigint, text string")
    assert got(near_copies.drop_near_copies(docs)) == slow_kept(docs.collect())


def test_edge_cases(spark):
    docs = edge_documents(spark)
    assert got(near_copies.drop_near_copies(docs)) == slow_kept(docs.collect())
    assert near_copies.drop_near_copies(edge_documents(spark, rows=False)).count() == 0


def test_simhash_names_the_first_pairs(spark, monkeypatch):
    """The stage takes op1's components, and the join verifies their pairs before any other."""
    texts = [WORDS[:300], WORDS[:300] + ["other"], WORDS[300:400]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    fps = [simhash.fingerprint(" ".join(t).encode()) for t in texts]
    assert (fps[0] ^ fps[1]).bit_count() <= simhash.RADIUS < (fps[0] ^ fps[2]).bit_count()
    asked, verified = [], ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda pairs, *rest: asked.append(pairs.count()) or verified(pairs, *rest))
    assert got(near_copies.drop_near_copies(docs)) == [0, 2]
    assert asked == [1]


def test_candidates_are_only_tried(spark):
    """False candidates link nothing, and what the candidates lack is still found."""
    texts = [WORDS[:100], WORDS[:50] + ["other"] + WORDS[51:100], WORDS[45:100] + WORDS[200:240], WORDS[200:300], []]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    candidates = spark.createDataFrame([(2, 0), (3, 0), (4, 3)], "a bigint, b bigint")
    got = ngram_join.similar_groups(docs, shingle=near_copies.SHINGLE, similarity=near_copies.SIMILARITY, candidates=candidates)
    assert {r.doc_id: r.component_id for r in got.collect()} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}


def test_no_link_around_the_limit_is_left_out(spark, monkeypatch):
    """Groups of edited copies, whose similarities lie on both sides of the limit, with hubs to the end after the pairs that SimHash names."""
    monkeypatch.setattr(ngram_join, "PAIRS_PER_POSTING", 0)
    rng = random.Random(7)
    texts = []
    for share in (0.002, 0.01, 0.02, 0.03):
        base = rng.choices(WORDS, k=120)
        texts += [[rng.choice(WORDS) if rng.random() < share else w for w in base][: rng.randint(105, 120)] for _ in range(30)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(5)
    kept = slow_kept(docs.collect())
    assert 4 < len(kept) < 116
    assert got(near_copies.drop_near_copies(docs)) == kept
