"""The same results in ANSI SQL over the same tables, for every query that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# -- names and hashes ---------------------------------------------------------------------------------------

PART_LABEL = "' ' || p_brand || ' - ' || p_name || '/' || p_type"

ORACLES["normalize_names"] = f"SELECT p_partkey, replace(replace(lower({PART_LABEL}), ' ', ''), '-', '') AS name FROM part"
ORACLES["clean_names_training"] = f"""
SELECT p_partkey, lower(replace(replace(replace(trim({PART_LABEL}), ' ', ''), '-', '_'), '/', '')) AS name FROM part"""
ORACLES["clean_names_prediction"] = """
SELECT s_suppkey, replace(replace(replace(lower(s_name || ' - ' || s_nationkey || '/A'), ' ', '_'), '-', '_'), '/', '_') AS name
FROM supplier"""
ORACLES["file_hash_prefix"] = """
SELECT doc_id, sha256(text) AS sha256, 'doc.v1_' || doc_id || '_' || substr(sha256(text), 1, 8) || '.csv' AS target_name FROM documents"""

# -- file validation ----------------------------------------------------------------------------------------

FILE = """'wafer_' || CASE WHEN l_orderkey % 11 = 1 THEN 'x' || l_orderkey
  ELSE lpad(CAST(l_orderkey % 100000000 AS VARCHAR), 8, '0') || '_' || lpad(CAST(l_orderkey // 100000000 AS VARCHAR), 6, '0') END || '.csv'"""

FILES = f"files AS (SELECT DISTINCT {FILE} AS file, l_orderkey % 11 AS d FROM lineitem)"

NAME_REASON = r"CASE WHEN NOT regexp_full_match(file, 'wafer_\d{8}_\d{6}\.csv') THEN 'Invalid filename format' END"

HEADERS = f"""{FILES},
headers AS (
  SELECT file, d, CASE d
    WHEN 0 THEN ['Wafer', 'Sensor - 1', 'sensor-2', 'SENSOR - 3', 'Sensor  4', 'Good/Bad']
    WHEN 3 THEN CAST([] AS VARCHAR[])
    WHEN 4 THEN ['wafer', 'Sensor - 1', 'Sensor - 2', 'Sensor - 3', 'Sensor - 4', 'Result']
    WHEN 5 THEN ['wafer', 'Sensor - 1', 'Sensor - 2', 'Sensor - 3', 'Output']
    WHEN 6 THEN ['wafer', 'Sensor - 2', 'Sensor - 1', 'Sensor - 3', 'Sensor - 4', 'Output']
    ELSE ['', 'Sensor - 1', 'Sensor - 2', 'Sensor - 3', 'Sensor - 4', 'Output'] END AS header
  FROM files WHERE d <> 2),
normal AS (
  SELECT *, list_transform(header, lambda x: CASE WHEN lower(x) IN ('', 'unnamed: 0') THEN 'wafer'
    ELSE replace(replace(lower(x), ' ', ''), '-', '') END) AS h FROM headers)"""

HEADER_REASON = """CASE
  WHEN len(h) = 0 THEN 'Header is empty'
  WHEN h[-1] NOT IN ('output', 'good/bad') THEN 'Last column should be ''Output'' or ''Good/Bad'', got ''' || header[-1] || ''''
  WHEN len(h) - 1 <> 5 THEN 'Column count mismatch: expected 5, got ' || (len(h) - 1)
  WHEN h[:-2] <> ['wafer', 'sensor1', 'sensor2', 'sensor3', 'sensor4'] THEN 'Columns do not match schema' END"""

ORACLES["filename_check"] = f"WITH {FILES} SELECT file, {NAME_REASON} AS reason FROM files"
ORACLES["header_check"] = f"WITH {HEADERS} SELECT file, {HEADER_REASON} AS reason FROM normal"
ORACLES["header_check_prediction"] = f"""WITH {HEADERS} SELECT file, CASE
  WHEN len(h) = 0 THEN 'Header is empty'
  WHEN len(h) <> 5 THEN 'Column count mismatch: expected 5, got ' || len(h)
  WHEN h <> ['wafer', 'sensor1', 'sensor2', 'sensor3', 'sensor4'] THEN 'Columns do not match schema' END AS reason FROM normal"""

CELLS = f"""items AS (
  SELECT {FILE} AS file, l_orderkey % 11 AS d, l_linenumber + 1 AS row_num,
    CASE WHEN l_orderkey % 11 = 10 THEN ['', '', '', '', '', ''] ELSE [
      CAST(l_partkey AS VARCHAR), CAST(l_quantity AS VARCHAR),
      CASE WHEN l_orderkey % 11 = 7 AND l_linenumber % 3 = 0 THEN 'abc' ELSE CAST(l_extendedprice AS VARCHAR) END,
      CASE WHEN l_orderkey % 11 = 0 AND l_linenumber = 1 THEN ' inf ' WHEN l_orderkey % 11 = 0 AND l_linenumber = 2 THEN ' '
           WHEN l_orderkey % 11 = 0 AND l_linenumber = 3 THEN '1_000' ELSE CAST(l_discount AS VARCHAR) END,
      CAST(l_tax AS VARCHAR),
      CASE WHEN l_orderkey % 11 = 8 AND l_linenumber >= 4 THEN '1.0' WHEN l_returnflag = 'R' THEN '-1' ELSE '1' END] END AS cells
  FROM lineitem WHERE l_orderkey % 11 NOT IN (2, 9)),
cells AS (SELECT file, d, row_num, unnest(cells) AS text, generate_subscripts(cells, 1) AS position FROM items),
bad_cells AS (
  SELECT *, row_number() OVER (PARTITION BY file ORDER BY row_num, position, text) AS nth FROM cells
  WHERE regexp_matches(text, '\\S') AND CASE
    WHEN position = 6 THEN NOT regexp_full_match(text, '\\s*[+-]?\\d+(_\\d+)*\\s*')
    WHEN position > 1 THEN NOT regexp_full_match(text,
      '(?i)\\s*[+-]?((\\d+(_\\d+)*\\.?(\\d+(_\\d+)*)?|\\.\\d+(_\\d+)*)(e[+-]?\\d+(_\\d+)*)?|inf(inity)?|nan)\\s*')
    ELSE FALSE END),
first_bad AS (SELECT * FROM bad_cells WHERE nth = 1),
filled AS (SELECT file, any_value(d) AS d, count(DISTINCT CASE WHEN regexp_matches(text, '\\S') THEN position END) AS n FROM cells GROUP BY file)"""

BLANK_REASON = "CASE WHEN filled.n <= 1 THEN 'All feature columns contain only null values' END"

ORACLES["dtype_first_error"] = f"""WITH {CELLS}
SELECT file, CAST(row_num AS BIGINT) AS row_num, CAST(position AS BIGINT) AS position, text FROM first_bad WHERE d NOT IN (3, 4, 5, 6)"""
ORACLES["short_rows"] = f"""
WITH cut AS (SELECT {FILE} AS file, l_linenumber + 1 AS row_num, l_partkey % 6 + 1 AS width, l_suppkey % 5 = 0 AS odd FROM lineitem),
wrong AS (SELECT file, min(row_num) AS row_num FROM cut WHERE odd AND width >= 3 GROUP BY file)
SELECT cut.file, count(*) AS n_rows, CAST(any_value(wrong.row_num) AS BIGINT) AS row_num,
  CAST(any_value(CASE WHEN wrong.row_num IS NOT NULL THEN 3 END) AS BIGINT) AS position,
  any_value(CASE WHEN wrong.row_num IS NOT NULL THEN 'abc' END) AS text, CAST(1 AS BIGINT) AS first_filled, CAST(max(width) AS BIGINT) AS last_filled
FROM cut LEFT JOIN wrong USING (file) GROUP BY cut.file"""
ORACLES["null_columns_check"] = f"WITH {CELLS} SELECT file, {BLANK_REASON} AS reason FROM filled WHERE d NOT IN (3, 4, 5, 6)"

VERDICTS = f"""WITH {HEADERS}, {CELLS},
judged AS (
  SELECT files.file, coalesce(
    {NAME_REASON.replace('(file,', '(files.file,')},
    CASE WHEN normal.file IS NULL THEN 'File is empty' END,
    {HEADER_REASON},
    'Row ' || first_bad.row_num || ': Column ''' || header[first_bad.position] || ''' expects '
      || CASE WHEN first_bad.position = 6 THEN 'integer' ELSE 'float' END || ', got ''' || first_bad.text || '''',
    CASE WHEN filled.file IS NULL THEN 'File contains no data rows' END,
    {BLANK_REASON}) AS reason
  FROM files LEFT JOIN normal USING (file) LEFT JOIN first_bad USING (file) LEFT JOIN filled USING (file))"""

ORACLES["file_verdicts"] = f"{VERDICTS} SELECT file, CASE WHEN reason IS NULL THEN 'good' ELSE 'bad' END AS verdict, reason FROM judged"
ORACLES["validation_summary"] = f"""{VERDICTS}
SELECT count(*) AS total, count(*) FILTER (reason IS NULL) AS good, round(100.0 * count(*) FILTER (reason IS NULL) / count(*), 1) AS good_pct,
  count(reason) AS bad, round(100 - 100.0 * count(*) FILTER (reason IS NULL) / count(*), 1) AS bad_pct FROM judged"""
ORACLES["rejection_reasons"] = f"{VERDICTS} SELECT file, reason FROM judged WHERE reason IS NOT NULL"

# -- loading ------------------------------------------------------------------------------------------------

ORACLES["load_union_by_name"] = """
SELECT l_orderkey, l_quantity, l_tax FROM lineitem WHERE l_returnflag = 'A'
UNION ALL BY NAME SELECT l_discount, l_orderkey FROM lineitem WHERE l_returnflag = 'R'
UNION ALL BY NAME SELECT l_tax, l_orderkey FROM lineitem WHERE l_returnflag NOT IN ('A', 'R')"""
ORACLES["load_project_order"] = """
SELECT l_orderkey AS wafer, l_quantity AS sensor_1, l_tax AS sensor_2, l_linenumber AS output FROM lineitem"""
ORACLES["load_drop_bad_files"] = """
SELECT l_orderkey AS source_file, CAST(l_partkey AS VARCHAR) AS wafer, l_quantity FROM lineitem
WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_partkey % 97 = 0 OR l_partkey % 89 = 0)"""
ORACLES["load_coerce_types"] = """
WITH texts AS (
  SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS w FROM lineitem),
mixed AS (
  SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN w || '.0' WHEN 2 THEN 'abc' WHEN 3 THEN 'nan' WHEN 4 THEN w || '.5'
    WHEN 5 THEN ' ' || w || ' ' WHEN 6 THEN NULL ELSE w END AS text FROM texts),
numbers AS (SELECT *, CASE WHEN NOT isnan(TRY_CAST(text AS DOUBLE)) THEN TRY_CAST(text AS DOUBLE) END AS x FROM mixed)
SELECT l_orderkey, l_linenumber, x AS as_double, CASE WHEN x = floor(x) THEN CAST(x AS BIGINT) END AS as_integer, text AS as_text,
  coalesce(x <> floor(x), FALSE) AS fractional FROM numbers"""
ORACLES["load_fractional_files"] = """
SELECT CAST(l_partkey AS VARCHAR) AS wafer, CAST(l_linenumber AS BIGINT) AS output, CAST(l_orderkey AS VARCHAR) AS source_file FROM lineitem
WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_partkey % 100 >= 97)"""
ORACLES["load_provenance"] = "SELECT 'lineitem.parquet' AS source_file, l_orderkey, l_linenumber, l_partkey FROM lineitem"

# -- preprocessing ------------------------------------------------------------------------------------------

ORACLES["qmark_to_null"] = "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type, value FROM events"
ORACLES["label_recode"] = "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS label FROM lineitem"
ORACLES["split_features_label"] = """
SELECT l_quantity, l_tax, CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS label FROM lineitem"""

SENSOR_LISTS = """cells AS (
  SELECT unnest([l_quantity, l_extendedprice, l_discount, l_tax, 1.3, NULL, CASE WHEN l_orderkey = 0 AND l_linenumber = -1 THEN 1.0 END,
                 CASE WHEN l_returnflag = 'R' THEN 0.1 END]) AS value, unnest(range(0, 8)) AS position FROM lineitem),
stats AS (SELECT CAST(position AS INTEGER) AS position, count(value) AS n, min(value) AS low, max(value) AS high FROM cells GROUP BY position)"""

ORACLES["zero_variance_columns"] = f"WITH {SENSOR_LISTS} SELECT position, n, low, high, (n >= 2 AND low = high) AS zero_variance FROM stats"
ORACLES["all_null_columns"] = f"WITH {SENSOR_LISTS} SELECT position FROM stats WHERE n = 0"
ORACLES["mean_impute"] = """
WITH gaps AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS v, CASE WHEN event_id % 5 <> 0 THEN CAST(user_id AS DOUBLE) END AS u FROM events)
SELECT event_id, round(coalesce(v, avg(v) OVER ()), 6) AS value, round(coalesce(u, avg(u) OVER ()), 6) AS user_id FROM gaps"""
ORACLES["mode_impute"] = """
WITH gaps AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN event_type END AS v FROM events),
top AS (SELECT v FROM gaps WHERE v IS NOT NULL GROUP BY v ORDER BY count(*) DESC, v LIMIT 1)
SELECT event_id, coalesce(v, (SELECT v FROM top)) AS event_type FROM gaps"""

EVENT_CELLS = """cells AS (
  SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(value AS VARCHAR) END AS value,
    CASE WHEN event_id % 9 = 0 THEN '?' ELSE CAST(user_id % 10 AS VARCHAR) END AS user_id,
    CASE WHEN event_id % 11 = 0 THEN '?' WHEN event_id % 13 = 0 THEN '' ELSE event_type END AS event_type FROM events)"""

ORACLES["numeric_or_text"] = f"""
WITH {EVENT_CELLS},
long AS (SELECT unnest([value, user_id, event_type, NULL]) AS text, unnest(range(0, 4)) AS position FROM cells),
known AS (SELECT position, text, CASE WHEN text <> '?' AND regexp_matches(text, '\\S') THEN text END AS t FROM long),
stats AS (
  SELECT CAST(position AS INTEGER) AS position, count(t) AS n, count(*) FILTER (text = '?') AS n_markers,
    count(*) FILTER (t IS NOT NULL AND TRY_CAST(t AS DOUBLE) IS NULL) AS n_text, round(avg(TRY_CAST(t AS DOUBLE)), 6) AS mean
  FROM known GROUP BY position)
SELECT *, (n_markers = 0 AND n_text = 0) AS "numeric", n_text = 0 AS "converts" FROM stats"""
ORACLES["prediction_fill"] = f"""
WITH {EVENT_CELLS},
user_mode AS (SELECT user_id AS m FROM cells WHERE user_id <> '?' GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1),
type_mode AS (SELECT event_type AS m FROM cells WHERE event_type NOT IN ('?', '') GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)
SELECT event_id, round(coalesce(CAST(value AS DOUBLE), avg(CAST(value AS DOUBLE)) OVER ()), 6) AS value,
  CAST(CASE WHEN user_id = '?' THEN (SELECT m FROM user_mode) ELSE user_id END AS DOUBLE) AS user_id,
  CASE WHEN event_type IN ('?', '') THEN (SELECT m FROM type_mode) ELSE event_type END AS event_type FROM cells"""
ORACLES["row_positions"] = """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS low, count(*) - 1 AS high, CAST(count(*) * (count(*) - 1) // 2 AS BIGINT) AS total FROM lineitem"""

# -- neighbours ---------------------------------------------------------------------------------------------

ORACLES["knn_impute"] = """
WITH long AS (
  SELECT vec_id, position, CASE WHEN (vec_id + position) % 7 <> 0 THEN CAST(embedding[position + 1] AS DOUBLE) END AS value
  FROM embeddings CROSS JOIN (SELECT unnest(range(0, 64)) AS position)),
distances AS (
  SELECT q.vec_id, d.vec_id AS donor, 64.0 / count(*) * sum((q.value - d.value) * (q.value - d.value)) AS distance
  FROM long q JOIN long d ON q.position = d.position AND q.value IS NOT NULL AND d.value IS NOT NULL GROUP BY q.vec_id, d.vec_id),
ranked AS (
  SELECT q.vec_id, q.position, d.value, row_number() OVER (PARTITION BY q.vec_id, q.position ORDER BY distance, donor) AS nth
  FROM long q JOIN distances ON q.vec_id = distances.vec_id JOIN long d ON d.vec_id = donor AND d.position = q.position
  WHERE q.value IS NULL AND d.value IS NOT NULL),
found AS (SELECT vec_id, position, avg(value) AS value FROM ranked WHERE nth <= 5 GROUP BY vec_id, position)
SELECT vec_id, CAST(long.position AS INTEGER) AS position,
  round(coalesce(long.value, found.value, avg(long.value) OVER (PARTITION BY long.position)), 6) AS value
FROM long LEFT JOIN found USING (vec_id, position)"""
_GAPS = """
WITH cells AS (SELECT vec_id, CAST(position AS INTEGER) AS position, (vec_id + position) % 7 = 0 AS gap FROM embeddings CROSS JOIN (SELECT unnest(range(0, 64)) AS position)),
supply AS (SELECT position, least(5, count(*) FILTER (NOT gap)) AS found FROM cells GROUP BY position)"""
ORACLES["approximate_neighbors"] = _GAPS + """
SELECT vec_id, position, found, true AS distances_true FROM cells JOIN supply USING (position) WHERE gap AND found > 0"""
ORACLES["approximate_recall"] = _GAPS + """
SELECT count(DISTINCT vec_id) AS queries, CAST(sum(found) AS BIGINT) AS wanted, true AS enough FROM cells JOIN supply USING (position) WHERE gap AND vec_id % 20 = 0"""
ORACLES["knn_classify"] = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, CASE WHEN label >= 5 THEN 1.0 ELSE 0.0 END AS y FROM embeddings),
ranked AS (
  SELECT q.vec_id, d.y, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.x, d.x), d.vec_id) AS nth FROM v q CROSS JOIN v d)
SELECT vec_id, round(avg(CAST(y AS DOUBLE)), 6) AS probability FROM ranked WHERE nth <= 5 GROUP BY vec_id"""

# -- scaling and clusters -----------------------------------------------------------------------------------


def _scaled(column: str) -> str:
    return f"round(({column} - avg({column}) OVER ()) / stddev_pop({column}) OVER (), 6)"


ORACLES["standardize"] = f"""
SELECT l_orderkey, l_linenumber, {_scaled('l_quantity')} AS sensor_1, {_scaled('l_extendedprice')} AS sensor_2,
  {_scaled('l_discount')} AS sensor_3, {_scaled('l_tax')} AS sensor_4 FROM lineitem"""
ORACLES["wcss_k1"] = """
SELECT round(count(*) * (var_pop(l_quantity / 1000) + var_pop(l_extendedprice / 1000) + var_pop(l_discount / 1000) + var_pop(l_tax / 1000)), 2) AS wcss
FROM lineitem"""


def _square(centre: tuple[float, float, float, float]) -> str:
    columns = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return " + ".join(f"({c} - {v}::DOUBLE) * ({c} - {v}::DOUBLE)" for c, v in zip(columns, centre))


ORACLES["assign_fixed_centers"] = f"""
WITH d AS (
  SELECT l_orderkey, l_linenumber, l_partkey, {_square((10.0, 20000.0, 0.02, 0.02))} AS a, {_square((25.0, 50000.0, 0.05, 0.04))} AS b,
    {_square((40.0, 80000.0, 0.08, 0.06))} AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN a <= b AND a <= c THEN 0 WHEN b <= c THEN 1 ELSE 2 END AS cluster FROM d"""

# -- metrics ------------------------------------------------------------------------------------------------

BINARY = """b AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_extendedprice * (1 - l_discount) AS score, l_discount AS tied_score,
    CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS prediction FROM lineitem)"""


def _auc(score: str) -> str:
    return f"""SELECT round((sum(r) FILTER (label = 1) - p * (p + 1) / 2.0) / (p * n), 6) AS auc, '{score}' AS "by" FROM (
  SELECT label, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS r,
    sum(label) OVER () :: DOUBLE AS p, sum(1 - label) OVER () :: DOUBLE AS n FROM b) GROUP BY p, n"""


ORACLES["auc_rank_sum"] = f"WITH {BINARY} {_auc('score')} UNION ALL {_auc('tied_score')}"
ORACLES["accuracy"] = f"WITH {BINARY} SELECT round(avg(CASE WHEN prediction = label THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM b"
ORACLES["select_best_model"] = """
WITH s AS (
  SELECT l_suppkey AS cluster, l_linenumber AS position,
    CAST(CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) * 10 // count(*) AS DOUBLE) AS score FROM lineitem GROUP BY 1, 2)
SELECT cluster, position, score FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, position) AS nth FROM s WHERE score > 0) WHERE nth = 1"""
ORACLES["metric_per_cluster"] = """
SELECT l_orderkey AS cluster, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN 'accuracy' ELSE 'auc' END AS metric FROM lineitem GROUP BY 1"""

# -- prediction table ---------------------------------------------------------------------------------------

SCORED = """scored AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS wafer_id, CAST(l_linenumber % 3 AS INTEGER) AS cluster,
    CASE WHEN l_discount * 10 > 0.5 THEN 1 ELSE 0 END AS prediction, l_discount * 10 AS p FROM lineitem)"""


def _predicted(model: str, where: str = "TRUE") -> str:
    return f"""SELECT wafer_id, cluster, prediction, CASE WHEN prediction = 1 THEN 'Good' ELSE 'Bad' END AS prediction_label,
  {model} AS model_used, round(greatest(p, 1 - p), 6) AS confidence, round(p, 6) AS prob_good, round(1 - p, 6) AS prob_bad
FROM scored WHERE {where}"""


def _default(where: str = "TRUE") -> str:
    return f"""SELECT wafer_id, cluster, 0 AS prediction, 'Bad' AS prediction_label, 'default' AS model_used, 0.5::DOUBLE AS confidence,
  NULL::DOUBLE AS prob_good, NULL::DOUBLE AS prob_bad FROM scored WHERE {where}"""


ALL_PREDICTIONS = f"""{_predicted("'model_cluster_' || cluster || '_RandomForest'", "cluster < 2")} UNION ALL {_default("cluster = 2")}"""

ORACLES["prediction_labels"] = f"WITH {SCORED} {_predicted(repr('m'))}"
ORACLES["prediction_default_rows"] = f"WITH {SCORED} {_default()}"
ORACLES["prediction_sorted"] = f"WITH {SCORED} SELECT * FROM ({ALL_PREDICTIONS}) ORDER BY wafer_id"
ORACLES["prediction_summary"] = f"""
WITH {SCORED}, predicted AS ({ALL_PREDICTIONS})
SELECT count(*) AS total, count(*) FILTER (prediction = 1) AS good, round(100.0 * count(*) FILTER (prediction = 1) / count(*), 1) AS good_pct,
  count(*) FILTER (prediction <> 1) AS bad, round(100.0 * count(*) FILTER (prediction <> 1) / count(*), 1) AS bad_pct,
  round(avg(confidence) * 100, 1) AS mean_confidence_pct FROM predicted"""

ORACLES["prediction_order"] = f"""
WITH {SCORED}, predicted AS ({ALL_PREDICTIONS})
SELECT wafer_id, row_number() OVER (ORDER BY wafer_id) - 1 AS place FROM predicted"""

# -- the same files as lines, tables and exports, and what a fitted model must satisfy ------------------------

ORACLES["raw_line_verdicts"] = ORACLES["file_verdicts"].replace("WITH ", """WITH lineitem AS (
  SELECT * REPLACE (CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS INTEGER) AS l_linenumber)
  FROM main.lineitem), """, 1)
ORACLES["append_twice"] = f"""
SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_orderkey % 2 <> 0 THEN l_tax END AS l_tax, file AS source_file, sha256(CAST(l_orderkey AS VARCHAR)) AS sha256
FROM (SELECT *, {FILE} AS file FROM lineitem)"""
ORACLES["csv_round_trip"] = "SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem"
ORACLES["csv_one_file"] = ORACLES["csv_round_trip"]
ORACLES["kmeans_consistent"] = "SELECT vec_id, true AS nearest, true AS centre_is_mean FROM embeddings"
ORACLES["elbow_bounded"] = "SELECT CAST(k AS INTEGER) AS k, true AS bounded FROM range(2, 11) AS t(k)"
ORACLES["train_knn"] = """
WITH long AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS value, unnest(range(64)) AS place FROM embeddings),
scaled AS (
  SELECT vec_id, label, place, (value - avg(value) OVER (PARTITION BY place)) / coalesce(nullif(stddev_pop(value) OVER (PARTITION BY place), 0), 1) AS value FROM long),
v AS (SELECT vec_id, CAST(label >= 5 AS INTEGER) AS label, list(value ORDER BY place) AS x FROM scaled GROUP BY ALL),
ranked AS (
  SELECT q.vec_id, q.label, d.label AS y, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.x, d.x), d.vec_id) AS nth FROM v q CROSS JOIN v d)
SELECT vec_id, label, avg(y) AS probability, CAST(avg(y) > 0.5 AS INTEGER) AS prediction FROM ranked WHERE nth <= 5 GROUP BY vec_id, label"""

ORACLES["boost_one_round"] = """
WITH r AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_returnflag = 'R' AS INTEGER) AS y,
    [CASE WHEN l_suppkey % 7 <> 0 THEN l_discount END, l_tax, l_linenumber::DOUBLE] AS x FROM lineitem),
c AS (SELECT place, v, sum(0.5 - y)::DOUBLE AS g, count(*) * 0.25::DOUBLE AS h FROM (SELECT y, unnest(x) AS v, unnest(range(3)) AS place FROM r) GROUP BY ALL),
t AS (SELECT place, sum(g) AS g, sum(h) AS h, coalesce(sum(g) FILTER (v IS NULL), 0) AS gap_g, coalesce(sum(h) FILTER (v IS NULL), 0) AS gap_h FROM c GROUP BY place),
s AS (SELECT place, v, sum(g) OVER w AS low_g, sum(h) OVER w AS low_h, max(v) OVER (PARTITION BY place) AS top FROM c WHERE v IS NOT NULL WINDOW w AS (PARTITION BY place ORDER BY v)),
o AS (SELECT place, v, side, low_g + side * gap_g AS gl, low_h + side * gap_h AS hl, g, h FROM s JOIN t USING (place) CROSS JOIN (VALUES (1), (0)) AS d(side) WHERE v < top),
best AS (SELECT * FROM o WHERE hl >= 1 AND h - hl >= 1 ORDER BY gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) DESC, place, v, side DESC LIMIT 1)
SELECT l_orderkey, l_linenumber, l_partkey,
  round(1 / (1 + exp(0.3 * CASE WHEN coalesce(x[place + 1] <= v, side = 1) THEN gl / (hl + 1) ELSE (g - gl) / (h - hl + 1) END)), 9) AS probability
FROM r CROSS JOIN best"""

ORACLES["kmeans_step"] = f"""
WITH d AS (
  SELECT [l_quantity, l_extendedprice, l_discount, l_tax] AS x, {_square((10.0, 20000.0, 0.02, 0.02))} AS a, {_square((25.0, 50000.0, 0.05, 0.04))} AS b,
    {_square((40.0, 80000.0, 0.08, 0.06))} AS c FROM lineitem),
near AS (SELECT x, CASE WHEN a <= b AND a <= c THEN 0 WHEN b <= c THEN 1 ELSE 2 END AS cluster, least(a, b, c) AS square FROM d),
long AS (SELECT cluster, unnest(x) AS value, unnest(range(4)) AS place FROM near)
SELECT cluster, CAST(place AS INTEGER) AS position, round(avg(value), 4) AS mean, (SELECT round(sum(square) / 1e6, 2) FROM near) AS cost FROM long GROUP BY ALL"""
