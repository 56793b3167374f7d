"""The stored forest: its trees are rows of a table, and large nodes are split without holding their rows in one task."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.operators import forest, models


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(12)
    x = np.round(rng.normal(0, 1, (600, 6)), 2)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(int)
    return spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(600)], "row_key bigint, sensors array<double>, label int").repartition(3).persist()


def test_trees_are_a_table(spark, rows, tmp_path):
    fitted = models.CANDIDATES["RandomForest"](rows)
    assert not fitted.parts and fitted.table.select("tree").distinct().count() == models.FOREST_TREES   # no model of the driver's
    scored = fitted.score(rows)
    assert scored.columns == ["row_key", "sensors", "label", "probability", "prediction"] and scored.count() == 600
    assert scored.where("prediction = label").count() > 590    # trees grow until their leaves are pure
    fitted.save(str(tmp_path / "forest"), spark)
    again = models.Fitted.load(str(tmp_path / "forest"), spark).score(rows)
    assert sorted(again.select("row_key", "probability").collect()) == sorted(scored.select("row_key", "probability").collect())


@pytest.mark.parametrize("local_values", [6 * 40, 6 * 600, 1])
def test_any_size_of_a_task(rows, local_values):
    """Nodes are split by all tasks while they are large; each row is scored by its leaf of every tree."""
    params, table = forest.fit(rows, 10, 30 if local_values > 1 else 4, 7, local_values)
    trees = {(r.tree, r.root): forest.Flat(r.sensor, r.cut, r.child, r.share) for r in table.collect()}
    assert (max(len(top[0]) for top in params["tops"]) > 1) == (local_values < 6 * 600)
    got = {r.row_key: (r.probability, r.prediction) for r in forest.score(rows, params, table).collect()}
    right = 0
    for r in rows.collect():
        bins = forest.binned(np.array([r.sensors]), params["points"])
        shares = []
        for tree, top in enumerate(forest.Flat(*t) for t in params["tops"]):
            flat = trees[tree, int(top.leaf_of(bins)[0])]
            shares.append(flat.share[int(flat.leaf_of(bins)[0])])
        assert got[r.row_key][0] == pytest.approx(np.mean(shares))
        right += got[r.row_key][1] == r.label
    assert right > (570 if local_values > 1 else 420)


def test_best_split_of_a_node():
    """Against all splits of one node by hand."""
    rng = np.random.default_rng(1)
    bins, weight, label = rng.integers(0, 5, (50, 2)).astype(np.uint8), rng.integers(1, 4, 50).astype(float), rng.integers(0, 2, 50).astype(float)

    def gini(kept):
        share = (weight * label)[kept].sum() / weight[kept].sum()
        return weight[kept].sum() * (1 - share**2 - (1 - share) ** 2)

    least = min((gini(bins[:, s] <= c) + gini(bins[:, s] > c), s, c) for s in range(2) for c in range(4))
    gains, place, cut, *_ = forest.best_splits(forest.sums(bins, weight, weight * label, np.zeros(50, dtype=np.int64), np.array([[0, 1]])))
    assert gains[0] and (place[0], cut[0]) == least[1:]


def test_one_class_and_few_rows(rows):
    assert forest.score(rows, *forest.fit(rows.where("label = 0"), 3, 5, 1)).agg(F.max("probability")).first()[0] == 0
    alone = rows.where("row_key = 3").withColumn("label", F.lit(1))
    assert forest.score(rows, *forest.fit(alone, 5, 5, 1)).agg(F.min("probability")).first()[0] == 1
