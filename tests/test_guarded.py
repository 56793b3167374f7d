"""Files of any size are hashed and judged in order; a file that cannot be read stops neither validation nor load nor stream."""

import hashlib
import io

import pytest
from pyspark.sql import functions as F

from faultline.plans.load import load_training
from faultline.plans.validate import validate_folder
from faultline.schema import training_schema
from faultline.sources import folder as drop, tables
from faultline.streaming.arrivals import append_arrivals
from test_validation import TRAINING, write_cases

SCHEMA = training_schema(4)
HEAD = "wafer,Sensor - 1,Sensor - 2,Output\n"
LIMIT = "spark.sql.sources.binaryFile.maxLength"
UNREAD = "Processing error: file cannot be read whole"
CONTENTS = [b"a\nb", b"a\r\nb\r\n", b"a\rb\r", b"\n", b"\r", b"\r\n\r\r\n\n\rx", b"\xef\xbb\xbfa,b\nc\n", b"\xef\xbb\xbf\n", b"\xef\xbb\xbfa",
            b"a\xff\xfe\x00b\r\r\n\n", "\u00e9\u2028,\u4e2d\n".encode() * 300, b"x" * 200_000 + b"\ny"]


@pytest.fixture
def small_limit(spark):
    """Every file of more than a few bytes counts as too large for one value."""
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "0")
    yield
    spark.conf.set(LIMIT, before)


def file_name(i):
    return f"wafer_{i:08d}_000000.csv"


def add(folder, i, content):
    (folder / file_name(i)).write_bytes(content if isinstance(content, bytes) else content.encode())


def damage(folder, i):
    """A wrong checksum beside the file makes every read through Spark fail."""
    (folder / f".{file_name(i)}.crc").write_bytes(b"crc\0" + (512).to_bytes(4, "big") + b"\1\2\3\4" * 4096)


def assert_digests(spark, folder):
    found = {r["file"]: r for r in drop.digests(spark, str(folder)).collect()}
    seen = {r["file"]: r["n"] for r in drop.lines(spark, str(folder)).groupBy("file").agg(F.count("*").alias("n")).collect()}
    assert len(found) == len(CONTENTS)
    for i, content in enumerate(CONTENTS):
        row = found[file_name(i)]
        assert row["sha256"] == hashlib.sha256(content).hexdigest(), content[:20]
        assert row["n_lines"] == seen.get(file_name(i), 0) == len(io.StringIO(content.decode("latin-1"), newline=None).readlines()), content[:20]


def test_digests_of_values_and_streams(spark, tmp_path):
    for i, content in enumerate(CONTENTS):
        add(tmp_path, i, content)
    assert_digests(spark, tmp_path)
    whole = sorted(drop.digests(spark, str(tmp_path)).select("file", "header").collect())
    before = spark.conf.get(LIMIT), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(LIMIT, "0")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # files are cut into splits
    try:
        assert_digests(spark, tmp_path)
        assert sorted(drop.digests(spark, str(tmp_path)).select("file", "header").collect()) == whole
    finally:
        spark.conf.set(LIMIT, before[0])
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[1])


def test_large_files_get_the_same_verdicts(spark, tmp_path, small_limit):
    by_file = write_cases(tmp_path, TRAINING)
    judged = {by_file[r["file"]]: r["reason"] for r in validate_folder(spark, str(tmp_path), training_schema(5)).collect()}
    assert judged == {case: reason for case, (_, reason) in TRAINING.items()}


def test_unreadable_file_is_rejected_and_others_load(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(4):
        add(folder, i, HEAD + f"w{i},1,2,1\n\n \nv{i},1,2,-1\n")
    add(folder, 4, "")
    add(folder, 5, HEAD + '"w\n5",1,2,1\n\n \nv5,1,2,1\n')
    damage(folder, 1)
    judged = validate_folder(spark, str(folder), SCHEMA)
    rows = {r["file"]: r for r in judged.collect()}
    assert {n: r["reason"] for n, r in rows.items() if r["verdict"] == "bad"} == {file_name(1): UNREAD, file_name(4): "File is empty"}
    assert rows[file_name(0)]["n_filled"] == 2 and rows[file_name(5)]["n_filled"] == 3
    loaded = load_training(spark, str(folder), judged, SCHEMA, "guarded.wafers")
    assert sorted(r["wafer"] for r in loaded.collect()) == [" ", "v0", "v2", "v3", "v5", "w\n5", "w0", "w2", "w3"]


def test_file_that_fails_after_its_verdict(spark, tmp_path):
    for i in range(3):
        add(tmp_path, i, HEAD + "".join(f"w{i}-{j},1,2,1\n" for j in range(5)))
    judged = validate_folder(spark, str(tmp_path), SCHEMA)
    damage(tmp_path, 0)
    add(tmp_path, 1, HEAD + "w1-0,1,2,1\n")  # what a read that ends early gives
    loaded = load_training(spark, str(tmp_path), judged, SCHEMA, "guarded.later")
    assert {r["wafer"][:2] for r in loaded.collect()} == {"w2"} and loaded.count() == 5


def test_ledger_holds_every_arrival_once(spark, tmp_path):
    folder, ledger = tmp_path / "in", str(tmp_path / "ledger")
    folder.mkdir()
    schema = SCHEMA.without_label()

    def run():
        append_arrivals(spark, str(folder), schema, str(tmp_path / "table"), str(tmp_path / "state"), ledger=ledger).awaitTermination()
        return sorted((r["file"], r["reason"]) for r in spark.read.parquet(ledger).collect())

    head = "wafer,Sensor - 1,Sensor - 2\n"
    add(folder, 0, head + "w0,1,2\n")
    add(folder, 1, "")
    add(folder, 2, head + "w2,x,2\n")
    first = [(file_name(0), None), (file_name(1), "File is empty"), (file_name(2), "Row 2: Column 'Sensor - 1' expects float, got 'x'")]
    key = lambda rows: sorted(rows, key=str)
    assert key(run()) == key(first)
    add(folder, 3, "")
    add(folder, 4, head + "w4,1,2\n")
    damage(folder, 4)
    more = [(file_name(3), "File is empty"), (file_name(4), UNREAD)]
    assert key(run()) == key(first + more)
    assert key(run()) == key(first + more)
    assert [r["wafer"] for r in tables.read_table(spark, str(tmp_path / "table")).collect()] == ["w0"]
