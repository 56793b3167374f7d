"""Arrivals as a stream give the same table as the batch load, once."""

from faultline.plans.load import load_prediction
from faultline.plans.validate import validate_folder
from faultline.schema import training_schema
from faultline.sources import tables
from faultline.streaming.arrivals import append_arrivals

SCHEMA = training_schema(4).without_label()
HEAD = "wafer,Sensor - 1,Sensor - 2\n"


def test_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def add(i, text):
        (folder / f"wafer_{i:08d}_000000.csv").write_text(text)

    def run():
        append_arrivals(spark, str(folder), SCHEMA, str(tmp_path / "table"), str(tmp_path / "state"), files_per_batch=2).awaitTermination()

    for i in range(3):
        add(i, HEAD + f"w{i},1,{i}\n")
    add(7, HEAD + "w7,bad,1\n")
    run()
    add(8, HEAD + "w8,1,2\nw9,,3\n")
    run()
    run()
    streamed = tables.read_table(spark, str(tmp_path / "table"))
    judged = validate_folder(spark, str(folder), SCHEMA, "prediction")
    batch = load_prediction(spark, str(folder), judged, SCHEMA, str(tmp_path / "batch"))
    columns = ["wafer", "sensor_1", "sensor_2", "source_file", "sha256"]
    assert sorted(map(tuple, streamed.select(columns).collect()), key=str) == sorted(map(tuple, batch.select(columns).collect()), key=str)
    assert streamed.count() == 5
