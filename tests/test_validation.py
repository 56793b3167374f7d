"""Rule matrix, precedence, row numbering over splits, and both modes."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from faultline.functions import literals
from faultline.operators import validation
from faultline.plans.validate import route_files, validate_folder, write_verdicts
from faultline.schema import SensorSchema, training_schema

SCHEMA = training_schema(5)
HEAD = "wafer,Sensor - 1,Sensor - 2,Sensor - 3,Output\n"
BAD = "Processing error: "

TRAINING = {
    "ok": (HEAD + "w1,1.0,2.0,3.0,1\nw2,1.5,,3.5,-1\nw3,1,2,3,1\n", None),
    "ok_unnamed": (HEAD.replace("wafer", "") + "w1,1,2,3,1\n", None),
    "ok_unnamed0": (HEAD.replace("wafer", "Unnamed: 0") + "w1,1,2,3,1\n", None),
    "ok_spacing": ("WAFER,sensor-1,SENSOR - 2,Sensor  -3,Good/Bad\nw1,1,2,3,1\n", None),
    "ok_short_row": (HEAD + "w1,1\nw2,1,2,3,1\n", None),
    "ok_long_row": (HEAD + "w1,1,2,3,1,zz,yy\nw2,1,2,3,1\n", None),
    "ok_blank_line": (HEAD + "w1,1,2,3,1\n\nw2,1,2,3,1\n", None),
    "ok_literals": (HEAD + "w1,1e5, 2.5 ,inf,+1\nw2,nan,1_000,-.5,1_0\n", None),
    "ok_crlf": (HEAD.replace("\n", "\r\n") + "w1,1,2,3,1\r\n", None),
    "ok_quoted": (HEAD + '"w,1","1.5","2",3,1\n"w""2",1,2,3,1\n', None),
    "ok_spanning": (HEAD + '"w\n1",1,2,3,1\nw2,1,2,3,1\n', None),
    "bad_spanning": (HEAD + '"w\n1",1,2,3,1\nw2,1,"a\nb",3,1\n', "Row 3: Column 'Sensor - 2' expects float, got 'a\nb'"),
    "edge_null_sensors": (HEAD + "w1,,,,1\nw2,,, ,-1\n", None),
    "edge_two_columns": (HEAD + "w1,,,,\n,,,5,\n", None),
    "edge_null_label_too": (HEAD + "w1,,,,\nw2,,,,\n", "All feature columns contain only null values"),
    "bad_empty": ("", "File is empty"),
    "bad_blank_header": ("\nw1,1,2,3,1\n", "Header is empty"),
    "bad_label": (HEAD.replace("Output", "Result") + "w1,1,2,3,1\n", "Last column should be 'Output' or 'Good/Bad', got 'Result'"),
    "bad_count": ("wafer,Sensor - 1,Sensor - 2,Output\nw1,1,2,1\n", "Column count mismatch: expected 4, got 3"),
    "bad_order": ("wafer,Sensor - 2,Sensor - 1,Sensor - 3,Output\nw1,1,2,3,1\n", "Columns do not match schema"),
    "bad_bom": ("﻿" + HEAD + "w1,1,2,3,1\n", "Columns do not match schema"),
    "bad_float": (HEAD + "w1,1,2,3,1\nw2,1,abc,3,1\nw3,x,2,3,1\n", "Row 3: Column 'Sensor - 2' expects float, got 'abc'"),
    "bad_after_blank": (HEAD + "w1,1,2,3,1\n\nw2,1,abc,3,1\n", "Row 4: Column 'Sensor - 2' expects float, got 'abc'"),
    "bad_qmark": (HEAD + "w1,?,2,3,1\n", "Row 2: Column 'Sensor - 1' expects float, got '?'"),
    "bad_hex": (HEAD + "w1,0x1p3,2,3,1\n", "Row 2: Column 'Sensor - 1' expects float, got '0x1p3'"),
    "bad_suffix": (HEAD + "w1,1,2,1.0d,1\n", "Row 2: Column 'Sensor - 3' expects float, got '1.0d'"),
    "bad_int": (HEAD + "w1,1,2,3,1.0\n", "Row 2: Column 'Output' expects integer, got '1.0'"),
    "bad_repeated_header": (HEAD + "w1,1,2,3,1\n" + HEAD, "Row 3: Column 'Sensor - 1' expects float, got 'Sensor - 1'"),
    "bad_repeated_header_later": (HEAD + "w1,1,z,3,1\n" + HEAD, "Row 2: Column 'Sensor - 2' expects float, got 'z'"),
    "bad_no_rows": (HEAD, "File contains no data rows"),
    "bad_all_null": (HEAD + ",,,,\n , ,,,\n\n", "All feature columns contain only null values"),
    "bad_trailing_comma": (HEAD + "w1,1,2,3,1,\nw2,1,2,3,1,\n", BAD + "list index out of range"),
    "bad_far_blank": (HEAD + ("w1,1,2,3,1" + ",x" * 70 + ",\n") * 2, BAD + "list index out of range"),
    "ok_far_filled": (HEAD + "w1,1,2,3,1" + ",x" * 70 + ",\nw2,1,2,3,1" + ", " * 70 + ",y\n", None),
    "ok_partly_trailing": (HEAD + "w1,1,2,3,1,\nw2,1,2,3,1,9\n", None),
    "bad_giant_cell": (HEAD + "w1,1,2,3,1\n" + "x" * 140_000 + ",1,2,3,1\n", BAD + "field larger than field limit (131072)"),
    "quoted_header": ('"wafer","Sensor - 1","Sensor - 2","Sensor - 3","Output"\nw1,1,2,q,1\n', "Row 2: Column 'Sensor - 3' expects float, got 'q'"),
    "unnamed_reason": (HEAD.replace("wafer", "") + "w1,1,2,3,one\n", "Row 2: Column 'Output' expects integer, got 'one'"),
}


def write_cases(folder, cases):
    """One well-named file per case; returns file name -> case."""
    by_file = {}
    for i, (case, (text, _)) in enumerate(cases.items()):
        name = f"wafer_{i:08d}_000000.csv"
        by_file[name] = case
        (folder / name).write_bytes(text.encode("utf-8"))
    return by_file


@pytest.fixture(scope="module")
def training_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("training")
    by_file = write_cases(folder, TRAINING)
    (folder / "wafer_1_2.csv").write_text("nonsense\n")
    (folder / "wafer_12345678_123456.CSV").write_text("not scanned\n")
    (folder / "nested").mkdir()
    (folder / "nested" / "wafer_12345678_123456.csv").write_text(HEAD)
    return folder, by_file


def test_rule_matrix_training(spark, training_folder):
    folder, by_file = training_folder
    judged = {r["file"]: r for r in validate_folder(spark, str(folder), SCHEMA).collect()}
    assert len(judged) == len(by_file) + 1
    assert judged.pop("wafer_1_2.csv")["reason"] == "Invalid filename format"
    got = {by_file[f]: r["reason"] for f, r in judged.items()}
    assert got == {case: reason for case, (_, reason) in TRAINING.items()}
    for file, row in judged.items():
        assert row["verdict"] == ("good" if row["reason"] is None else "bad")
        if row["verdict"] == "good":
            digest = hashlib.sha256((folder / file).read_bytes()).hexdigest()
            assert row["target_name"] == f"{file[:-4]}_{digest[:8]}.csv"


def test_prediction_mode(spark, tmp_path):
    head = "Wafer,Sensor - 1,Sensor - 2,Sensor - 3\n"
    cases = {
        "ok": (head + "w1,1,2,3\n", None),
        "one_filled_column": (head + "w1,,,\n", None),
        "labelled": (HEAD + "w1,1,2,3,1\n", "Column count mismatch: expected 4, got 5"),
        "all_null": (head + ",,,\n", "All feature columns contain only null values"),
        "short": (head + "w1\n", None),
    }
    by_file = write_cases(tmp_path, cases)
    judged = validate_folder(spark, str(tmp_path), SCHEMA.without_label(), "prediction").collect()
    assert {by_file[r["file"]]: r["reason"] for r in judged} == {c: reason for c, (_, reason) in cases.items()}


def test_row_numbers_over_splits(spark, tmp_path):
    rows = [f"w{i},1,2,3,1\n" for i in range(5000)]
    rows[3210] = "w3210,1,2,bad,1\n"
    rows[4321] = "w4321,1,worse,3,1\n"
    (tmp_path / "wafer_00000001_000000.csv").write_text(HEAD + "".join(rows))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        (row,) = validate_folder(spark, str(tmp_path), SCHEMA).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert row["reason"] == "Row 3212: Column 'Sensor - 3' expects float, got 'bad'"


def test_literal_grammar_agrees_with_python(spark):
    parts = ["", " ", "+", "-", "1", "12", "1_0", "_1", "1__0", ".", "1.", ".5", "1.5", "e5", "1e5", "1e+5", "1e", "1_0.0_1e1_0",
             "inf", "-Infinity", "NaN", "nan5", "0x1", "1.0d", "1f", "\t7\n", " 5 ", "٣", "1,0", "--1", "True", "1e5.0", "\x1c3"]
    texts = sorted({a + b for a in parts for b in ["", "1", " ", "_", "."]})

    def accepted(kind, text):
        try:
            kind(text)
            return True
        except ValueError:
            return False

    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select("t", literals.fits(F.col("t"), "float").alias("f"), literals.fits(F.col("t"), "integer").alias("i"),
                        literals.is_blank(F.col("t")).alias("blank")).collect()
    for row in rows:
        assert row["f"] == accepted(float, row["t"]), repr(row["t"])
        assert row["i"] == accepted(int, row["t"]), repr(row["t"])
        assert row["blank"] == (row["t"].strip() == ""), repr(row["t"])


def test_summary_and_outputs(spark, training_folder, tmp_path):
    folder, by_file = training_folder
    judged = validate_folder(spark, str(folder), SCHEMA)
    total = len(by_file) + 1
    good = sum(1 for _, reason in TRAINING.values() if reason is None)
    (row,) = validation.summary(judged).collect()
    assert (row["total"], row["good"], row["bad"]) == (total, good, total - good)
    assert row["good_pct"] == round(100 * good / total, 1)
    assert validation.rejections(judged).count() == total - good

    write_verdicts(judged, str(tmp_path / "verdicts"), "training")
    stored = spark.read.parquet(str(tmp_path / "verdicts"))
    assert stored.where("rejected_at is not null").count() == total - good

    good_dir, bad_dir = tmp_path / "good", tmp_path / "bad"
    good_dir.mkdir()
    (good_dir / "stale.csv").write_text("old")
    route_files(judged, str(folder), str(good_dir), str(bad_dir), "training")
    assert len(os.listdir(good_dir)) == good
    errors = [f for f in os.listdir(bad_dir) if f.endswith(".error")]
    assert len(errors) == total - good
    text = (bad_dir / "wafer_1_2.csv.error").read_text()
    assert text.startswith("Error: Invalid filename format\nTimestamp: ") and text.endswith("Mode: training\n")


def test_full_width_schema(spark, tmp_path):
    schema = training_schema(592)
    header = ",".join(n for n, _ in schema.columns)
    good = ",".join(["w1"] + ["1.25"] * 590 + ["1"])
    bad = ",".join(["w2"] + ["1.25"] * 589 + ["oops", "1"])
    (tmp_path / "wafer_00000001_000000.csv").write_text("\n".join([header, good, good]))
    (tmp_path / "wafer_00000002_000000.csv").write_text("\n".join([header, good, bad]))
    rows = {r["file"]: r["reason"] for r in validate_folder(spark, str(tmp_path), schema).collect()}
    assert rows == {
        "wafer_00000001_000000.csv": None,
        "wafer_00000002_000000.csv": "Row 3: Column 'Sensor - 590' expects float, got 'oops'",
    }


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="unknown mode"):
        validate_folder(spark, "/nowhere", SCHEMA, "both")


def judged_once(spark, folder, schema, content, mode="training"):
    (folder / "wafer_01012025_120000.csv").write_text(content)
    return validate_folder(spark, str(folder), schema, mode).first()["reason"]


def test_label_spelling_of_the_only_typed_column(spark, tmp_path):
    schema = SensorSchema((("wafer", "varchar"), ("Sensor - 1", "varchar"), ("Output", "Integer")))
    assert judged_once(spark, tmp_path, schema, "wafer,Sensor - 1,Good/Bad\nw1,a,1\n") is None


def test_header_without_typed_columns_is_no_data(spark, tmp_path):
    schema = SensorSchema((("wafer", "varchar"), ("Sensor - 1", "varchar"), ("Output", "varchar")))
    content = ",Sensor - 1,Output\n,,\n,,\n"
    assert judged_once(spark, tmp_path, schema, content) == "All feature columns contain only null values"


def test_summary_of_an_empty_folder(spark):
    judged = spark.createDataFrame([], "file string, verdict string")
    assert validation.summary(judged).first().asDict() == {"total": 0, "good": 0, "good_pct": None, "bad": 0, "bad_pct": None}


def test_verdicts_are_stored(spark, tmp_path):
    (tmp_path / "wafer_01012025_120000.csv").write_text(HEAD + "w1,1,2,3,1\n")
    judged = validate_folder(spark, str(tmp_path), SCHEMA)
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert "binaryFile" not in plan and "text" not in plan.split("Relation")[0]
