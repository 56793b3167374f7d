"""Column selection and fills."""

import pytest
from pyspark.sql import functions as F

from faultline.operators import columns


def arrays(spark, rows, kind="double"):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"k int, sensors array<{kind}>")


def test_zero_variance_and_all_null(spark):
    frame = arrays(spark, [[1.3, 0.1, None, 5.0, None], [1.3, 0.2, None, None, None], [1.3, 0.1, None, None, 7.0]])
    stats = columns.position_stats(frame)
    flags = {r["position"]: (r["z"], r["a"]) for r in stats.select("position", columns.zero_variance(stats).alias("z"), columns.all_null(stats).alias("a")).collect()}
    assert flags == {0: (True, False), 1: (False, False), 2: (False, True), 3: (False, False), 4: (False, False)}
    kept = frame.select(columns.project(F.col("sensors"), [3, 0]).alias("x")).collect()
    assert [list(r["x"]) for r in kept] == [[5.0, 1.3], [None, 1.3], [None, 1.3]]


def test_labels():
    assert columns.feature_columns(["Wafer ", "a", "goodbad", "output"]) == (["a", "goodbad"], "output")
    with pytest.raises(KeyError, match="no label"):
        columns.feature_columns(["a"])
    assert columns.id_column(["x", "ID", "Wafer"]) == "Wafer"
    assert columns.id_column(["x"]) is None


def test_recode_and_markers(spark):
    frame = spark.createDataFrame([("?", -1), ("a?", 1), (None, None)], "Wafer string, y int")
    assert [r[0] for r in frame.select(columns.recode_label(F.col("y"))).collect()] == [0, 1, None]
    assert [r[0] for r in columns.marker_to_null(frame).collect()] == [None, "a?", None]
    assert columns.drop_wafer(frame).columns == ["y"]


def test_position_numbers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).coalesce(1).write.parquet(path)
    frame = spark.read.parquet(path)
    assert [r["wafer_id"] for r in columns.with_position(frame).orderBy("id").collect()] == list(range(1000))
    many = columns.with_position(spark.range(0, 1000, 1, 7))
    assert many.where("id != wafer_id").count() == 0 and many.count() == 1000


def test_modes_take_the_smallest_on_ties(spark):
    frame = spark.createDataFrame([(0, "b"), (0, "a"), (0, "b"), (0, "a"), (0, None), (1, "z"), (2, None)], "position int, value string")
    assert {r["position"]: r["mode"] for r in columns.modes(frame).collect()} == {0: "a", 1: "z"}


def test_prepare_batch(spark):
    rows = [
        # numbers   with marker  text   all null  marker+text
        ["1.0", "5", "x", "", "?"],
        ["3.0", "?", "y", None, "b"],
        ["", "5.0", "", "?", "a"],
        [None, "5.0", "y", "nan", "1"],
    ]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "k int, cells array<string>")
    filled, numbers, texts = columns.prepare_batch(frame, ["n", "m", "t", "z", "mt"])
    assert (numbers, texts) == (["n", "m"], ["t", "mt"])
    got = [(list(r["sensors"]), list(r["texts"])) for r in filled.orderBy("k").collect()]
    assert got == [([1.0, 5.0], ["x", "1"]), ([3.0, 5.0], ["y", "b"]), ([2.0, 5.0], ["y", "a"]), ([2.0, 5.0], ["y", "1"])]


def test_missing_spellings_leave_a_column_numeric(spark):
    cells = [["1.0", "a"], ["NA", "null"], ["3.0", None], ["inf", "N/A"], ["#N/A", "b"]]
    frame = spark.createDataFrame([(str(i), c) for i, c in enumerate(cells)], "wafer_id string, cells array<string>")
    filled, numbers, texts = columns.prepare_batch(frame, ["x", "y"])
    assert (numbers, texts) == (["x"], ["y"])
    assert [r["sensors"] for r in filled.orderBy("wafer_id").collect()] == [[1.0], [2.0], [3.0], [2.0], [2.0]]
