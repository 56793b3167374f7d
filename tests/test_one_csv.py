"""One CSV file: bytes in order, one header, nothing left beside it."""

import csv

from faultline.sources import tables

ROWS = [(i, f'a"{i}, b' if i % 3 else None, i / 4) for i in range(500)]


def test_bytes_in_order(spark, tmp_path):
    frame = spark.createDataFrame(ROWS, 'id bigint, `odd "name", one` string, x double').repartition(7).orderBy("id")
    path = tmp_path / "out" / "predictions.csv"
    path.parent.mkdir()
    for _ in range(2):     # the second replaces the first
        tables.export_one_csv(frame, str(path))
        with path.open(newline="") as lines:
            head, *body = csv.reader(lines, escapechar="\\")
        assert head == ["id", 'odd "name", one', "x"]
        assert body == [[str(i), text or "", str(x)] for i, text, x in ROWS]
    assert path.is_file() and [p.name for p in path.parent.iterdir() if not p.name.endswith(".crc")] == ["predictions.csv"]


def test_no_rows_and_an_older_folder(spark, tmp_path):
    path = str(tmp_path / "predictions.csv")
    frame = spark.createDataFrame(ROWS, "id bigint, text string, x double")
    tables.export_csv(frame, path)
    tables.export_one_csv(frame.limit(0), path)
    with open(path) as lines:
        assert lines.read() == "id,text,x\n"


def test_a_failing_row_leaves_the_old_file(spark, tmp_path):
    path = tmp_path / "predictions.csv"
    tables.export_one_csv(spark.range(3).toDF("id"), str(path))
    try:
        tables.export_one_csv(spark.sql("select if(id = 40, raise_error('no'), id) as id from range(50)"), str(path))
    except Exception as error:
        assert "no" in str(error)
    else:
        raise AssertionError("written")
    assert path.read_text() == "id\n0\n1\n2\n" and [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["predictions.csv"]
