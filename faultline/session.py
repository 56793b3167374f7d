"""Session helpers: local sessions for tests, and durable lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


TEXT_BYTES = 4 << 20  # of a batch of texts, or of lists as long as texts, for Python workers


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A single-JVM session for tests and benchmarks. On a cluster the caller brings their own."""
    partitions = shuffle_partitions or (cores if isinstance(cores, int) else 8)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("faultline")
        .config("spark.driver.memory", os.environ.get("FAULTLINE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="faultline-package-")) / "faultline.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, Path(root.name) / source.relative_to(root))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder named by ``spark.checkpoint.dir``.

    A lost executor re-reads the checkpoint files instead of replaying the plan. Only a session whose driver
    runs all tasks (master ``local`` or ``local[n]``) gets a folder of its own when the setting is absent; a
    cluster without it is refused, because a machine-local folder is not shared by its executors.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back: each task's work is done once and kept.

    Unlike a checkpoint, later reads take only the columns that they use. ``batch_bytes``: rows that go to Python workers meanwhile go in
    batches of about so many bytes, as 10,000 rows of long texts are much memory on both sides.
    """
    path = _new_folder(df.sparkSession)
    with _batches(df.sparkSession, batch_bytes):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, column: str) -> DataFrame:
    """Write ``df`` to the shared folder, partitioned by ``column``, and read it back.

    A filter on ``column`` then reads its own part only, so working through the values one by one costs one
    pass over the data instead of one pass per value. Generated ids are fixed by it, too.
    """
    path = _new_folder(df.sparkSession)
    df.write.partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


@contextmanager
def _batches(spark: SparkSession, size: int | None) -> Iterator[None]:
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    if size:
        spark.conf.set(name, str(size))
    try:
        yield
    finally:
        if size:
            spark.conf.set(name, before)


_scopes: list[list[str]] = []


def _new_folder(spark: SparkSession) -> str:
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    for folders in _scopes:
        folders.append(path)
    return path


def stored_alone(spark: SparkSession, make: Callable[[], DataFrame]) -> tuple[DataFrame, str]:
    """``stored(make())`` and its folder, without the folders written on the way, which are removed once the result is written.

    ``make`` must keep no frame that is read later. The result reads its own folder only, so a lost executor needs none of the others.
    """
    folders: list[str] = []
    _scopes.append(folders)
    try:
        result = stored(make())
    finally:
        _scopes.remove(folders)
        remove_folders(spark, folders[:-1])
    return result, folders[-1]


def remove_folders(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which every executor reaches."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if named is None:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
            named = tempfile.mkdtemp(prefix="faultline-checkpoints-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()
