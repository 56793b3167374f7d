"""How many bytes go to a Python worker at once."""

import pyarrow as pa

from faultline.session import TEXT_BYTES, stored

NAME = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_long_texts_go_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    docs = spark.range(9000, numPartitions=1).selectExpr("id as doc_id", "repeat('word ', 600) as text")
    before = spark.conf.get(NAME)
    found = [r.n for r in stored(docs.mapInArrow(sizes, "n bigint"), TEXT_BYTES).collect()]
    assert len(found) >= 6 and max(found) < 1.5 * TEXT_BYTES
    assert spark.conf.get(NAME) == before
    assert len(stored(docs.mapInArrow(sizes, "n bigint")).collect()) == 1
