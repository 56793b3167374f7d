"""The pipeline's stages, each against a plain version on what the stage before kept."""

import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pyspark.sql import functions as f

import corpus_pipeline
from edge_tables import edge_documents
from faultline.llm import mixing
from faultline.llm.queries import QUERIES
from faultline.session import stored
from test_near_copies import slow_kept
from test_packing import check

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """What goes into each stage and what comes out."""
    docs, found = spark.read.parquet(f"{DATA}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, DATA))
        found[name] = (docs.collect(), out.collect(), out.columns)
        docs = out
    return found


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_columns(steps):
    for name, (_, _, columns) in steps.items():
        if name != "packing":
            assert columns == COLUMNS


def test_quality_stage_drops_what_the_query_rejects(spark, steps):
    before, after, _ = steps["quality"]
    wanted = {r.doc_id for r in QUERIES["op5_quality"](spark, DATA).collect() if r.predicted}
    assert {r.doc_id for r in after} == wanted and len(after) < len(before)


def test_exact_stage(steps):
    before, after, _ = steps["exact_dedup"]
    best = {}
    for r in before:
        key = (-len(r.text or ""), r.doc_id)
        best[bare(r.text)] = min(best.get(bare(r.text), key), key)
    assert sorted(r.doc_id for r in after) == sorted(doc for _, doc in best.values())


def test_near_stage(steps):
    before, after, _ = steps["near_dedup"]
    assert sorted(r.doc_id for r in after) == sorted(slow_kept(before))


def test_mixing_stage(spark, steps):
    before, after, _ = steps["mixing"]
    picked = {r.doc_id: r for r in mixing.mixed(spark.createDataFrame(before)).collect()}
    texts = {r.doc_id: r.text for r in before}
    assert {r.doc_id for r in after} == {i for i, r in picked.items() if r.taken}
    for r in after:
        words = r.text.split()
        assert len(words) == picked[r.doc_id].taken and r.n_chars == len(r.text)
        own = Counter(texts[r.doc_id].split())
        assert all(n <= 3 * own[w] for w, n in Counter(words).items())
    taken = Counter()
    for r in picked.values():
        taken[r.source] += r.taken
    for r in picked.values():
        assert abs(taken[r.source] - r.target) <= mixing.BLOCK_WORDS


def test_packing_stage(steps):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    before, after, _ = steps["packing"]
    check(after, before, library)


def test_run_equals_its_stages(spark, steps):
    got = corpus_pipeline.run(spark, DATA).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in got) == Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in steps["packing"][1])


def test_stages_bear_edge_cases_and_empty_tables(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (11, 1, 0), (20, 0, 0), (None, 0, 0)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (True, False):
        docs = edge_documents(spark, rows).select(*COLUMNS)
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path)))
            if name != "packing":
                assert docs.columns == COLUMNS
        assert (docs.count() > 0) == rows
        assert np.all([r.offset + r.length <= 1024 for r in docs.collect()])


def test_extra_columns_of_any_name_come_back(spark, tmp_path):
    """Columns named like the ones that the stages use inside keep their values."""
    labels = spark.createDataFrame([(1, 1, 0), (11, 1, 0), (20, 0, 0)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    names = ["row", "row_", "file", "place", "number", "mix", "words", "stat_words", "__row", "first", "of"]
    docs = edge_documents(spark).select(*COLUMNS, *[f.lit(f"{i}").alias(n) for i, n in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        for row in out.collect():
            assert [row[n] for n in names] == [f"{i}" for i in range(len(names))], name
