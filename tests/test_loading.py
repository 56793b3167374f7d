"""Names, coercion, file-level filters, union, append without duplicates, export."""

from datetime import datetime

from pyspark.sql import functions as F, types as T

from faultline.functions import names
from faultline.operators import loading
from faultline.plans.load import load_prediction, load_training
from faultline.plans.validate import validate_folder
from faultline.schema import (SensorSchema, prediction_schema, read_schema, storage_type, training_schema, write_schema)
from faultline.sources import tables

SCHEMA = training_schema(5)
HEAD = "wafer,Sensor - 1,Sensor - 2,Sensor - 3,Output\n"


def test_schema_documents(tmp_path):
    assert len(training_schema(592).columns) == 592
    assert training_schema(592).names[590:] == ["Sensor - 590", "Output"]
    assert prediction_schema(4).columns == SCHEMA.without_label().columns
    path = write_schema(SCHEMA, str(tmp_path / "s.json"))
    assert read_schema(path) == SCHEMA
    assert SCHEMA.table_schema().names == ["wafer", "sensor_1", "sensor_2", "sensor_3", "output"]
    assert SCHEMA.table_schema(style="underscored").names[1] == "sensor___1"
    assert SCHEMA.original_names()["sensor_1"] == "Sensor - 1"
    assert storage_type("BOOL") == T.BooleanType() and storage_type("bool", "prediction") == T.StringType()
    assert storage_type("date") == T.StringType()
    try:
        SensorSchema.from_json("{}")
    except ValueError as error:
        assert "columns" in str(error)
    else:
        raise AssertionError("a document without columns must be refused")


def test_name_rules_agree(spark):
    texts = ["Sensor - 1", " Good/Bad ", "A-b c/D", "wafer", "", "É -/x", "\tTab "]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for rule, column in [(names.normalize_name, names.normalize), (names.clean_name, names.clean),
                         (names.clean_name_underscored, names.clean_underscored)]:
        assert [r[0] for r in frame.select(column(F.col("t"))).collect()] == [rule(t) for t in texts]
    assert names.clean_name("Sensor - 1") == "sensor_1"
    assert names.clean_name_underscored("Sensor - 1") == "sensor___1"
    assert names.table_column("Good/Bad") == "output"


def test_rename_and_order(spark):
    frame = spark.createDataFrame([(1, 2, 3)], ["Unnamed: 0", "Sensor - 1", "Good/Bad"])
    renamed = loading.rename_columns(frame)
    assert renamed.columns == ["wafer", "sensor_1", "output"]
    assert loading.schema_order(renamed, ["output", "missing", "wafer"]).columns == ["output", "wafer"]


def test_union_and_coercion(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, "y")], "k int, b string")
    rows = {r["k"]: (r["a"], r["b"]) for r in loading.union_all([a, b]).collect()}
    assert rows == {1: ("x", None), 2: (None, "y")}
    cells = spark.createDataFrame([(t,) for t in ["1", " 2.0 ", "2.5", "x", "nan", "inf", None]], "t string")
    got = cells.select(loading.coerce(F.col("t"), T.DoubleType()), loading.coerce(F.col("t"), T.LongType()),
                       loading.breaks_integer(F.col("t"))).collect()
    assert [r[0] for r in got] == [1.0, 2.0, 2.5, None, None, float("inf"), None]
    assert [r[1] for r in got][:2] == [1, 2]
    assert [r[2] for r in got] == [False, False, True, False, False, True, False]


def test_load_training(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "wafer_00000001_000000.csv").write_text(HEAD + "w1,1,,3,1\n\nw2,nan,2\n")
    (folder / "wafer_00000002_000000.csv").write_text(HEAD + "w3,1,2,3,1\n,1,2,3,1\n")          # a missing id
    (folder / "wafer_00000003_000000.csv").write_text(HEAD + "w4,1,2,3,1\nw5,1,2,3,1,9\n")      # an over-long row
    (folder / "wafer_00000004_000000.csv").write_text(HEAD + "w6,1,x,3,1\n")                     # rejected
    (folder / "wafer_00000005_000000.csv").write_text(HEAD.replace("wafer", "") + '"w,7",1,"2",3,-1\n')
    (folder / "wafer_00000006_000000.csv").write_text(HEAD + '"w\n8",1,2,3,1\nw9,1,2,3,1\n')
    judged = validate_folder(spark, str(folder), SCHEMA)
    table = load_training(spark, str(folder), judged, SCHEMA, "faultline_test.wafers")
    assert table.columns == ["wafer", "sensor_1", "sensor_2", "sensor_3", "output"]
    assert sorted(map(tuple, table.collect())) == [("w\n8", 1.0, 2.0, 3.0, 1), ("w,7", 1.0, 2.0, 3.0, -1), ("w1", 1.0, None, 3.0, 1), ("w2", None, 2.0, None, None), ("w9", 1.0, 2.0, 3.0, 1)]
    tables.export_csv(table, str(tmp_path / "out"))
    assert spark.read.option("header", True).option("multiLine", True).csv(str(tmp_path / "out")).count() == 5
    assert loading.column_manifest(table).first()[0] == "wafer, sensor_1, sensor_2, sensor_3, output"
    spark.sql("DROP DATABASE faultline_test CASCADE")


def test_append_is_idempotent(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()
    head = "wafer,Sensor - 1,Sensor - 2,Sensor - 3\n"
    schema = SCHEMA.without_label()
    (folder / "wafer_00000001_000000.csv").write_text(head + "w1,1,2,3\nw2,1,2,3\n")
    judged = validate_folder(spark, str(folder), schema, "prediction")
    assert load_prediction(spark, str(folder), judged, schema, path).count() == 2
    assert load_prediction(spark, str(folder), judged, schema, path).count() == 2
    (folder / "wafer_00000002_000000.csv").write_text(head + "w3,1,2,3\n")
    judged = validate_folder(spark, str(folder), schema, "prediction")
    loaded = load_prediction(spark, str(folder), judged, schema, path)
    assert sorted(r["wafer"] for r in loaded.collect()) == ["w1", "w2", "w3"]
    wider = loaded.limit(1).select("wafer", F.lit("new.csv").alias("source_file"), F.lit("0").alias("sha256"), F.lit(1.5).alias("sensor_9"))
    tables.append_rows(wider, path)
    assert tables.read_table(spark, path).where("sensor_9 is not null").count() == 1


def test_predictions_name():
    assert tables.predictions_name("/in/batch_7.csv", datetime(2024, 5, 6, 7, 8, 9)) == "predictions_batch_7_20240506_070809.csv"


def test_integers_are_exact(spark):
    texts = ["9007199254740993", "-9223372036854775808", "2.0", "2.5", "9223372036854775808", "x", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        loading.coerce(F.col("t"), T.LongType()).alias("v"), loading.breaks_integer(F.col("t")).alias("b")
    ).collect()
    assert [r["v"] for r in rows] == [9007199254740993, -(2**63), 2, 2, None, None, None]
    assert [r["b"] for r in rows] == [False, False, False, True, True, False, False]
