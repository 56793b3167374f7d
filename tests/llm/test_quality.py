"""The rule ensemble: held-out accuracy, compiled rules against plain evaluation, and edge cases."""

import numpy as np
from pyspark.sql import functions as F

from edge_tables import edge_documents
from faultline.llm import quality
from faultline.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = QUERIES["op5_quality"](spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) >= 0.95
    assert np.mean([r.predicted for r in got if r.quality]) >= 0.97


def test_compiled_rules_equal_plain_evaluation(spark):
    docs = edge_documents(spark)
    below, above = quality.Condition(0, 0.01, False), quality.Condition(6, 4.0, True)
    model = quality.RuleEnsemble(list(quality.statistics(F.col("text"))), -0.5, [((below,), 1.5), ((below, above), -2.25)])
    stats = docs.select("doc_id", *[c.alias(n) for n, c in quality.statistics(F.col("text")).items()]).collect()
    values = np.array([[r[n] for n in model.names] for r in stats], dtype=float)
    total = -0.5 + 1.5 * below.holds(values) - 2.25 * (below.holds(values) & above.holds(values))
    want = sorted(zip([str(r.doc_id) for r in stats], (1 / (1 + np.exp(-total))).round(9)))
    got = sorted((str(r.doc_id), round(r.score, 9)) for r in quality.scored(docs, model).collect())
    assert got == want
    assert quality.keep_good(docs, model).count() == sum(s >= 0.3 for _, s in want)
    assert quality.keep_good(docs, model).columns == docs.columns


def test_edge_cases_and_no_labels(spark):
    docs, labels = edge_documents(spark), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = quality.fitted(docs, labels)
    got = quality.scored(docs, model).collect()
    assert len(got) == docs.count() and {r.score for r in got} == {0.5}
    assert quality.scored(edge_documents(spark, rows=False), model).count() == 0
    ones = spark.createDataFrame([(i, 1, 0) for i in range(1, 20)], "doc_id bigint, quality int, toxic int")
    assert all(r.predicted == 1 for r in quality.scored(docs, quality.fitted(docs, ones)).collect())
    mixed = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 20)] + [(None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in quality.scored(docs, quality.fitted(docs, mixed)).collect())


def test_the_sample_is_read_from_one_file(spark):
    """A fit's jobs read the sample from a stored file; rows held by the driver would be sent with every job's tasks."""
    values, target = np.arange(12.0).reshape(4, 3), np.array([0.0, 1.0, 1.0, 0.0])
    table = quality._vectors(spark, values, target)
    assert [list(r.features) for r in table.collect()] == values.tolist() and [r.label for r in table.collect()] == target.tolist()
    assert len(table.inputFiles()) == 1 and table.rdd.getNumPartitions() == 1
