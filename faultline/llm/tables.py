"""What the operators share: table reads, word patterns, held-out rows, row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from faultline.session import stored

#: White space of all word and normalisation rules: space, tab, line feed, vertical tab, form feed, return.
WHITE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
FILES_BROADCAST = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves no rest by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added while a column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a row number in column ``name`` that every later read of these rows agrees on.

    Rows read straight from files are numbered by file and place in it, so nothing is written; others are stored first. The
    files' numbers, one small row each, are broadcast up to ``FILES_BROADCAST`` files and joined by a shuffle beyond.
    """
    source = docs if _read_from_files(docs) else stored(docs)
    path, place, number = (fresh_name(docs, n) for n in ("file", "place", "number"))
    placed = source.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(place))
    files = placed.select(path).distinct().withColumn(number, F.row_number().over(W.orderBy(path)).cast("long"))
    row = F.shiftleft(F.col(number), 40) + F.col(place)
    if len(source.inputFiles()) <= FILES_BROADCAST:
        files = F.broadcast(files)
    return placed.join(files, path).select(*[f"`{c}`" for c in docs.columns], row.alias(name))


def _read_from_files(docs: DataFrame) -> bool:
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation" or plan.nodeName().startswith("Relation")
