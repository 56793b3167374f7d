"""Named queries over the driver's tables, each built from the library's operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from faultline.catalog import standins
from faultline.catalog.standins import SCHEMA, table
from faultline.functions import names
from faultline.operators import (
    approximate, boosting, clustering, columns as cols, loading, metrics, models, neighbors, reporting, scaling, validation,
)
from faultline.plans.predict import predict_rows
from faultline.plans.train import train_rows
from faultline.session import durable, shared_folder, stored
from faultline.sources import folder, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# -- names and hashes ---------------------------------------------------------------------------------------


def _labels_of_parts(spark, sf_dir):
    label = F.concat(F.lit(" "), F.col("p_brand"), F.lit(" - "), F.col("p_name"), F.lit("/"), F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("label"))


@query
def normalize_names(spark, sf_dir):
    return _labels_of_parts(spark, sf_dir).select("p_partkey", names.normalize(F.col("label")).alias("name"))


@query
def clean_names_training(spark, sf_dir):
    return _labels_of_parts(spark, sf_dir).select("p_partkey", names.clean(F.col("label")).alias("name"))


@query
def clean_names_prediction(spark, sf_dir):
    label = F.concat("s_name", F.lit(" - "), F.col("s_nationkey").cast("string"), F.lit("/A"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", names.clean_underscored(label).alias("name"))


@query
def file_hash_prefix(spark, sf_dir):
    file = F.concat(F.lit("doc.v1_"), F.col("doc_id").cast("string"), F.lit(".csv"))
    digest = F.sha2("text", 256)
    return table(spark, sf_dir, "documents").select("doc_id", digest.alias("sha256"), validation.target_name(file, digest).alias("target_name"))


# -- file validation ----------------------------------------------------------------------------------------


def _lineitem(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def _facts(spark, sf_dir):
    records = standins.records(_lineitem(spark, sf_dir))
    return validation.with_blank_extras(validation.file_facts(validation.chunk_facts(records, SCHEMA)), records, SCHEMA)


def _facts_after_header(spark, sf_dir):
    """Of the files whose header is accepted."""
    headers = standins.headers(_lineitem(spark, sf_dir))
    passed = headers.where(validation.header_reason(F.col("header"), SCHEMA, "training").isNull()).select("file")
    return _facts(spark, sf_dir).join(passed, "file", "left_semi")


def _verdicts(spark, sf_dir):
    items = _lineitem(spark, sf_dir)
    return validation.verdicts(standins.files(items).select("file"), standins.headers(items), _facts(spark, sf_dir), SCHEMA, "training")


@query
def filename_check(spark, sf_dir):
    return standins.files(_lineitem(spark, sf_dir)).select("file", validation.file_name_reason(F.col("file")).alias("reason"))


@query
def header_check(spark, sf_dir):
    headers = standins.headers(_lineitem(spark, sf_dir))
    return headers.select("file", validation.header_reason(F.col("header"), SCHEMA, "training").alias("reason"))


@query
def header_check_prediction(spark, sf_dir):
    headers = standins.headers(_lineitem(spark, sf_dir))
    return headers.select("file", validation.header_reason(F.col("header"), SCHEMA.without_label(), "prediction").alias("reason"))


@query
def dtype_first_error(spark, sf_dir):
    facts = _facts_after_header(spark, sf_dir)
    return facts.where(F.col("error").isNotNull()).select(
        "file", F.col("error.row_num").alias("row_num"), F.col("error.position").alias("position"), F.col("error.text").alias("text")
    )


@query
def short_rows(spark, sf_dir):
    """Cells that a row lacks fit every type and count as blank."""
    facts = validation.file_facts(validation.chunk_facts(standins.short_records(_lineitem(spark, sf_dir)), SCHEMA))
    return facts.select(
        "file",
        F.col("n_rows").cast("bigint").alias("n_rows"),
        F.col("error.row_num").cast("bigint").alias("row_num"),
        F.col("error.position").cast("bigint").alias("position"),
        F.col("error.text").alias("text"),
        F.col("low").cast("bigint").alias("first_filled"),
        F.col("high").cast("bigint").alias("last_filled"),
    )


@query
def null_columns_check(spark, sf_dir):
    facts = _facts_after_header(spark, sf_dir).where(F.col("n_rows") > 0)
    return facts.select("file", validation.blank_columns_reason(SCHEMA, "training").alias("reason"))


@query
def file_verdicts(spark, sf_dir):
    return _verdicts(spark, sf_dir).select("file", "verdict", "reason")


@query
def raw_line_verdicts(spark, sf_dir):
    """The same files as text lines in several splits, every second cell quoted, through the line reader."""
    in_file = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    items = _lineitem(spark, sf_dir).withColumn("l_linenumber", F.row_number().over(in_file))  # lines without gaps
    quoted = F.transform("cells", lambda c, i: F.when(i % 2 == 1, F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c))
    line = F.when(F.hash("file", "line_id") % 2 == 0, F.array_join(quoted, ",")).otherwise(F.array_join("cells", ","))
    chunk = F.floor(F.col("line_id") / 3) * 1000  # three lines a split
    lines = standins.records(items).select("file", chunk.cast("bigint").alias("chunk"), "line_id", line.alias("line"))
    records = folder.line_records(lines, SCHEMA.types)
    facts = validation.with_blank_extras(validation.file_facts(validation.chunk_facts(records, SCHEMA)), records, SCHEMA)
    judged = validation.verdicts(standins.files(items).select("file"), standins.headers(items), facts, SCHEMA, "training")
    return judged.select("file", "verdict", "reason")


@query
def validation_summary(spark, sf_dir):
    return validation.summary(_verdicts(spark, sf_dir))


@query
def rejection_reasons(spark, sf_dir):
    return validation.rejections(_verdicts(spark, sf_dir))


# -- loading ------------------------------------------------------------------------------------------------


@query
def load_union_by_name(spark, sf_dir):
    items = _lineitem(spark, sf_dir)
    return loading.union_all([
        items.where("l_returnflag = 'A'").select("l_orderkey", "l_quantity", "l_tax"),
        items.where("l_returnflag = 'R'").select("l_discount", "l_orderkey"),
        items.where("l_returnflag NOT IN ('A', 'R')").select("l_tax", "l_orderkey"),
    ])


@query
def load_project_order(spark, sf_dir):
    renamed = _lineitem(spark, sf_dir).select(
        F.col("l_tax").alias("Sensor - 2"), F.col("l_quantity").alias("Sensor - 1"), F.col("l_partkey").alias("Unrelated"),
        F.col("l_orderkey").alias("Wafer"), F.col("l_linenumber").alias("Good/Bad"),
    )
    return loading.schema_order(loading.rename_columns(renamed), SCHEMA.table_schema().names)


@query
def load_drop_bad_files(spark, sf_dir):
    wafer = F.when(F.col("l_partkey") % 97 == 0, None).when(F.col("l_partkey") % 89 == 0, "").otherwise(F.col("l_partkey").cast("string"))
    rows = _lineitem(spark, sf_dir).select(F.col("l_orderkey").alias("source_file"), wafer.alias("wafer"), "l_quantity")
    return loading.without_files(rows, loading.missing_wafer(F.col("wafer")))


def _mixed_text():
    line, whole = F.col("l_linenumber"), F.col("l_quantity").cast("int").cast("string")
    return F.when(line == 1, F.concat(whole, F.lit(".0"))).when(line == 2, "abc").when(line == 3, "nan").when(
        line == 4, F.concat(whole, F.lit(".5"))).when(line == 5, F.concat(F.lit(" "), whole, F.lit(" "))).when(line == 6, None).otherwise(whole)


@query
def load_coerce_types(spark, sf_dir):
    text = F.col("text")
    return _lineitem(spark, sf_dir).withColumn("text", _mixed_text()).select(
        "l_orderkey",
        "l_linenumber",
        loading.coerce(text, T.DoubleType()).alias("as_double"),
        F.when(~loading.breaks_integer(text), loading.coerce(text, T.LongType())).alias("as_integer"),
        loading.coerce(text, T.StringType()).alias("as_text"),
        loading.breaks_integer(text).alias("fractional"),
    )


@query
def load_fractional_files(spark, sf_dir):
    rows = _lineitem(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("source_file"), F.col("l_partkey").cast("string").alias("wafer"),
        F.when(F.col("l_partkey") % 100 < 97, F.col("l_linenumber").cast("string")).otherwise("2.5").alias("output"),
    )
    return loading.typed_rows(rows, SCHEMA, "prediction")


@query
def load_provenance(spark, sf_dir):
    source = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return _lineitem(spark, sf_dir).select(source.alias("source_file"), "l_orderkey", "l_linenumber", "l_partkey")


# -- preprocessing ------------------------------------------------------------------------------------------


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


@query
def qmark_to_null(spark, sf_dir):
    marked = F.when(F.col("event_id") % 5 == 0, "?").otherwise(F.col("event_type"))
    return cols.marker_to_null(_events(spark, sf_dir).select("event_id", marked.alias("event_type"), F.col("value").alias("value")))


@query
def label_recode(spark, sf_dir):
    rows = standins.sensor_rows(_lineitem(spark, sf_dir))
    return rows.select("l_orderkey", "l_linenumber", cols.recode_label(F.col("label")).alias("label"))


@query
def split_features_label(spark, sf_dir):
    wide = _lineitem(spark, sf_dir).select(
        F.col("l_partkey").alias("Wafer"), "l_quantity", "l_tax", F.when(F.col("l_returnflag") == "R", -1).otherwise(1).alias("goodbad")
    )
    features, label = cols.feature_columns(wide.columns)
    return wide.select(*features, F.col(label).alias("label"))


def _sensor_array(spark, sf_dir):
    items = _lineitem(spark, sf_dir)
    one_value = F.when((F.col("l_orderkey") == 0) & (F.col("l_linenumber") == -1), 1.0)
    return items.select(F.array(*standins.SENSORS, F.lit(1.3), F.lit(None).cast("double"), one_value,
                                F.when(F.col("l_returnflag") == "R", 0.1)).alias("sensors"))


@query
def zero_variance_columns(spark, sf_dir):
    stats = cols.position_stats(_sensor_array(spark, sf_dir))
    return stats.select("position", "n", "low", "high", cols.zero_variance(stats).alias("zero_variance"))


@query
def all_null_columns(spark, sf_dir):
    stats = cols.position_stats(_sensor_array(spark, sf_dir))
    return stats.where(cols.all_null(stats)).select("position")


@query
def mean_impute(spark, sf_dir):
    value = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    user = F.when(F.col("event_id") % 5 != 0, F.col("user_id").cast("double"))
    rows = _events(spark, sf_dir).select("event_id", F.array(value, user).alias("sensors"))
    means = [r["mean"] for r in cols.position_stats(rows).orderBy("position").collect()]
    filled = cols.fill(F.col("sensors"), means)
    return rows.select("event_id", F.round(filled[0], 6).alias("value"), F.round(filled[1], 6).alias("user_id"))


@query
def mode_impute(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("value"))
    mode = cols.modes(rows.select(F.lit(0).alias("position"), "value")).first()["mode"]
    return rows.select("event_id", F.coalesce("value", F.lit(mode)).alias("event_type"))


def _event_cells(spark, sf_dir):
    key = F.col("event_id")
    value = F.when(key % 7 == 0, None).otherwise(F.col("value").cast("string"))
    user = F.when(key % 9 == 0, "?").otherwise((F.col("user_id") % 10).cast("string"))
    kind = F.when(key % 11 == 0, "?").when(key % 13 == 0, "").otherwise(F.col("event_type"))
    return _events(spark, sf_dir).select("event_id", F.array(value, user, kind, F.lit(None).cast("string")).alias("cells"))


@query
def numeric_or_text(spark, sf_dir):
    profile = cols.text_profile(_event_cells(spark, sf_dir))
    return profile.select("position", "n", "n_markers", "n_text", F.round("mean", 6).alias("mean"), "numeric", "converts")


@query
def prediction_fill(spark, sf_dir):
    filled, numbers, texts = cols.prepare_batch(_event_cells(spark, sf_dir), ["value", "user_id", "event_type", "nothing"])
    return filled.select(
        "event_id",
        *[F.round(F.get("sensors", F.lit(i)), 6).alias(n) for i, n in enumerate(numbers)],
        *[F.get("texts", F.lit(i)).alias(n) for i, n in enumerate(texts)],
    )


@query
def row_positions(spark, sf_dir):
    numbered = cols.with_position(_lineitem(spark, sf_dir).select("l_orderkey"))
    return numbered.agg(F.count("*").alias("n_rows"), F.min("wafer_id").alias("low"), F.max("wafer_id").alias("high"),
                        F.sum("wafer_id").alias("total"))


@query
def append_twice(spark, sf_dir):
    """A table in the shared folder: half of the files, then all of them with one column more; each file is there once."""
    rows = _lineitem(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax", standins.file_name(F.col("l_orderkey")).alias("source_file"),
        F.sha2(F.col("l_orderkey").cast("string"), 256).alias("sha256"))
    path = f"{shared_folder(spark)}/appended-{uuid.uuid4().hex}"
    tables.append_rows(rows.drop("l_tax").where(F.col("l_orderkey") % 2 == 0), path)
    tables.append_rows(rows, path)
    return tables.read_table(spark, path).select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "source_file", "sha256")


@query
def csv_round_trip(spark, sf_dir):
    """Exported as CSV and read again."""
    rows = _lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    path = f"{shared_folder(spark)}/exported-{uuid.uuid4().hex}"
    tables.export_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query
def csv_one_file(spark, sf_dir):
    """Exported in order as a single CSV file and read again."""
    rows = _lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    path = f"{shared_folder(spark)}/exported-{uuid.uuid4().hex}.csv"
    tables.export_one_csv(rows.orderBy("l_orderkey", "l_linenumber"), path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


# -- neighbours ---------------------------------------------------------------------------------------------


@query
def knn_impute(spark, sf_dir):
    rows = durable(standins.gappy_vectors(table(spark, sf_dir, "embeddings")))
    filled = neighbors.knn_impute(rows)
    return filled.select(F.col("row_key").alias("vec_id"), F.posexplode("sensors").alias("position", "value")).withColumn(
        "value", F.round("value", 6)
    )


#: Small enough leaves that the index has several on the given tables.
APPROX_LEAF_ROWS = 64


def _index(rows):
    return approximate.build_index(rows, leaf_rows=APPROX_LEAF_ROWS)


@query
def approximate_neighbors(spark, sf_dir):
    """Per row and gap: how many neighbours the index reports, and whether each distance is that of the stored vectors."""
    rows = durable(standins.gappy_vectors(table(spark, sf_dir, "embeddings")))
    found = approximate.nearest(_index(rows), rows)
    asked, held = rows.select(F.col("row_key").alias("key"), F.col("sensors").alias("x")), rows.select(F.col("row_key").alias("donor"), F.col("sensors").alias("y"))
    gaps = F.filter(F.zip_with("x", "y", lambda a, b: (a - b) * (a - b)), lambda g: g.isNotNull())
    square = F.aggregate(gaps, F.lit(0.0), lambda total, g: total + g) * (F.size("x") / F.size(gaps))
    # A donor's vector is joined and compared once for all gaps that it fills.
    pairs = found.groupBy("key", "donor", "distance").agg(F.collect_list(F.struct("position", "donated")).alias("gaps"))
    met = pairs.join(asked, "key").join(held, "donor").withColumn("square", square).select("key", "donor", "x", "y", "distance", "square", F.inline("gaps"))
    true = (F.abs(F.col("distance") - F.col("square")) <= 1e-9 * F.col("square")) & F.get("x", F.col("position")).isNull() & (F.get("y", F.col("position")) == F.col("donated"))
    judged = met.select("key", "position", "donor", true.alias("true"))
    return judged.groupBy(F.col("key").alias("vec_id"), "position").agg(F.countDistinct("donor").alias("found"), F.bool_and("true").alias("distances_true"))


@query
def approximate_recall(spark, sf_dir):
    """Rows whose id is divisible by 20, against all rows."""
    rows = durable(standins.gappy_vectors(table(spark, sf_dir, "embeddings")))
    measured = approximate.recall(_index(rows), rows.where("row_key % 20 = 0"))
    return measured.select("queries", "wanted", (F.col("recall") >= 0.9).alias("enough"))


@query
def knn_classify(spark, sf_dir):
    rows = durable(standins.vectors(table(spark, sf_dir, "embeddings")))
    return neighbors.knn_vote(rows.drop("label"), rows).select(F.col("row_key").alias("vec_id"), F.round("probability", 6).alias("probability"))


# -- scaling and clusters -----------------------------------------------------------------------------------


@query
def standardize(spark, sf_dir):
    rows = standins.sensor_rows(_lineitem(spark, sf_dir))
    scaled = scaling.scale(F.col("sensors"), *scaling.fit_scaler(rows))
    return rows.select("l_orderkey", "l_linenumber", *[F.round(F.get(scaled, F.lit(i)), 6).alias(f"sensor_{i + 1}") for i in range(4)])


@query
def wcss_k1(spark, sf_dir):
    rows = standins.sensor_rows(_lineitem(spark, sf_dir))
    scaled = rows.select(F.transform("sensors", lambda x: x / 1000).alias("sensors"))
    return clustering.wcss_of_one(scaled).select(F.round("wcss", 2).alias("wcss"))


CENTRES = [[10.0, 20000.0, 0.02, 0.02], [25.0, 50000.0, 0.05, 0.04], [40.0, 80000.0, 0.08, 0.06]]


@query
def assign_fixed_centers(spark, sf_dir):
    rows = standins.sensor_rows(_lineitem(spark, sf_dir))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", clustering.nearest_centre(F.col("sensors"), CENTRES).alias("cluster"))


@query
def kmeans_step(spark, sf_dir):
    """One round from fixed centres: the means of the rows nearest to each, and the cost before the move."""
    rows = standins.sensor_rows(_lineitem(spark, sf_dir)).select(F.col("sensors").alias("x"))
    (centres, cost), = clustering.step(rows, [np.array(CENTRES)])
    found = [(c, p, round(float(centres[c, p]), 4), round(cost / 1e6, 2)) for c in range(len(CENTRES)) for p in range(4)]
    return spark.createDataFrame(found, "cluster int, position int, mean double, cost double")


def _stored_vectors(spark, sf_dir):
    return stored(standins.vectors(table(spark, sf_dir, "embeddings")))


@query
def kmeans_clusters(spark, sf_dir):
    rows = _stored_vectors(spark, sf_dir)
    return clustering.assign(clustering.fit(rows), rows).select(F.col("row_key").alias("vec_id"), "cluster")


@query
def kmeans_consistent(spark, sf_dir):
    """Whether each vector is in the cluster of its nearest centre, and each centre is its members' mean."""
    rows = _stored_vectors(spark, sf_dir)
    model = clustering.fit(rows)
    centres = [[float(x) for x in centre] for centre in model.clusterCenters()]
    assigned = clustering.assign(model, rows).withColumn("centre", F.element_at(F.array(*[F.lit(c) for c in centres]), F.col("cluster") + 1))
    own, best = clustering.square_distance(F.col("sensors"), F.col("centre")), F.least(*[clustering.square_distance(F.col("sensors"), F.lit(c)) for c in centres])
    means = assigned.select("cluster", "centre", F.posexplode("sensors").alias("place", "value")).groupBy("cluster", "place").agg(
        F.avg("value").alias("mean"), F.first(F.get("centre", F.col("place"))).alias("centre"))
    met = means.groupBy("cluster").agg(F.bool_and(F.abs(F.col("mean") - F.col("centre")) < 1e-3).alias("centre_is_mean"))
    return assigned.select(F.col("row_key").alias("vec_id"), "cluster", (own <= best + 1e-9).alias("nearest")).join(met, "cluster").select("vec_id", "nearest", "centre_is_mean")


@query
def elbow_bounded(spark, sf_dir):
    """For each number of clusters, whether its cost lies between nothing and that of one cluster, as any local optimum's does."""
    (_, whole), *sweep = clustering.wcss_sweep(_stored_vectors(spark, sf_dir))
    return spark.createDataFrame([(k, 0 <= cost <= whole * (1 + 1e-9)) for k, cost in sweep], "k int, bounded boolean")


@query
def elbow_wcss(spark, sf_dir):
    return clustering.sweep_table(spark, clustering.wcss_sweep(_stored_vectors(spark, sf_dir)))


# -- metrics ------------------------------------------------------------------------------------------------


def _binary(spark, sf_dir):
    return _lineitem(spark, sf_dir).select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("score"),
        (F.col("l_quantity") > 25).cast("int").alias("prediction"),
        F.col("l_discount").alias("tied_score"),
    )


@query
def auc_rank_sum(spark, sf_dir):
    rows = _binary(spark, sf_dir)
    return metrics.roc_auc(rows).select(F.round("auc", 6).alias("auc"), F.lit("score").alias("by")).unionByName(
        metrics.roc_auc(rows, score="tied_score").select(F.round("auc", 6).alias("auc"), F.lit("tied_score").alias("by"))
    )


@query
def accuracy(spark, sf_dir):
    return _binary(spark, sf_dir).agg(F.round(metrics.accuracy(F.col("prediction"), F.col("label")), 6).alias("accuracy"))


@query
def select_best_model(spark, sf_dir):
    scores = _lineitem(spark, sf_dir).groupBy(F.col("l_suppkey").alias("cluster"), F.col("l_linenumber").alias("position")).agg(
        F.expr("cast(sum(cast(round(l_discount * 100) as bigint)) * 10 div count(*) as double)").alias("score")
    )
    return metrics.best_rows(scores, ["cluster"])


@query
def metric_per_cluster(spark, sf_dir):
    rows = _lineitem(spark, sf_dir).groupBy(F.col("l_orderkey").alias("cluster")).agg(
        F.min("l_returnflag").alias("low"), F.max("l_returnflag").alias("high")
    )
    return rows.select("cluster", metrics.metric_name(F.col("low"), F.col("high")).alias("metric"))


# -- models -------------------------------------------------------------------------------------------------


def _train_one(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stored_vectors(spark, sf_dir)
    scaled = durable(rows.withColumn("sensors", scaling.scale(F.col("sensors"), *scaling.fit_scaler(rows))))
    scored = models.CANDIDATES[name](scaled).score(scaled)
    return scored.select(F.col("row_key").alias("vec_id"), "label", "prediction", "probability")


for _name in models.CANDIDATES:
    QUERIES[f"train_{_name.lower()}"] = partial(_train_one, _name)

@query
def boost_one_round(spark, sf_dir):
    """One Newton round of depth one; a seventh of the first sensor's readings are gaps, whose side is learned."""
    rows = stored(_lineitem(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.array(F.when(F.col("l_suppkey") % 7 != 0, F.col("l_discount")), F.col("l_tax"), F.col("l_linenumber").cast("double")).alias("sensors"),
    ))
    scored = boosting.score(rows, boosting.fit(rows, rounds=1, depth=1))
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", F.round("probability", 9).alias("probability"))


VECTOR_NAMES = [f"sensor_{i}" for i in range(1, 65)]


@query
def best_model_per_cluster(spark, sf_dir):
    rows = durable(standins.vectors(table(spark, sf_dir, "embeddings")))
    chain = train_rows(rows, VECTOR_NAMES, parallelism=8)
    return chain.registry(spark).where("chosen").select("cluster", "model_name", "metric", "score")


@query
def predict_end_to_end(spark, sf_dir):
    """Gaps filled from neighbours, clusters, the best of all candidates each, then a scored batch."""
    rows = durable(standins.gappy_vectors(table(spark, sf_dir, "embeddings"), step=17))
    chain = train_rows(rows, VECTOR_NAMES, parallelism=8)
    return predict_rows(rows.select(F.col("row_key").cast("string").alias("wafer_id"), "sensors"), chain)


# -- prediction table ---------------------------------------------------------------------------------------


def _rounded(predictions):
    return predictions.select(*[F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in predictions.dtypes])


def _all_predictions(spark, sf_dir):
    rows = standins.scored_rows(_lineitem(spark, sf_dir))
    known = F.col("cluster") < 2
    used = F.concat(F.lit("model_cluster_"), F.col("cluster").cast("string"), F.lit("_RandomForest"))
    return reporting.prediction_rows(rows.where(known), used).unionByName(reporting.default_rows(rows.where(~known)))


@query
def prediction_labels(spark, sf_dir):
    return _rounded(reporting.prediction_rows(standins.scored_rows(_lineitem(spark, sf_dir)), F.lit("m")))


@query
def prediction_default_rows(spark, sf_dir):
    return _rounded(reporting.default_rows(standins.scored_rows(_lineitem(spark, sf_dir))))


@query
def prediction_sorted(spark, sf_dir):
    return reporting.sorted_by_wafer(_rounded(_all_predictions(spark, sf_dir)))


@query
def prediction_order(spark, sf_dir):
    """The place of each row of the sorted predictions."""
    rows = reporting.sorted_by_wafer(_all_predictions(spark, sf_dir)).select("wafer_id")
    return cols.with_position(rows, "place")


@query
def prediction_summary(spark, sf_dir):
    return reporting.batch_summary(_all_predictions(spark, sf_dir))
