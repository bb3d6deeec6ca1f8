"""Rolling features, labels, positions, error measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import tables as t
from millrace.catalog.registry import query
from millrace.functions import columns as C
from millrace.ml.runs import latest_run
from millrace.operators import cleaning, labels, rolling
from millrace.operators.indexing import join_by_position, number_rows
from millrace.operators.schema_check import schema_differences

M = t.EVENT_METRICS
LINE_KEYS = ["l_suppkey", *t.LINE_ORDER]


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return t.table(spark, d, "lineitem").select(*LINE_KEYS)


def _rolling_lines_sql(*stats: str) -> str:
    names = [f"{s}_{stat}_{w}" for w in t.WINDOWS for stat in stats for s in t.LINE_SENSORS]
    features = t.rolling_sql(t.LINE_SENSORS, "l_suppkey", ", ".join(t.LINE_ORDER))
    return f"WITH f AS (SELECT {', '.join(LINE_KEYS)}, {features} FROM lineitem) SELECT {', '.join(LINE_KEYS + names)} FROM f"


@query("rolling_mean", oracle=_rolling_lines_sql("mean"))
def rolling_mean(spark: SparkSession, d: str) -> DataFrame:
    return t.rounded_features(
        rolling.rolling_mean(_lines(spark, d), "l_suppkey", t.LINE_ORDER, t.LINE_SENSORS, t.WINDOWS), t.LINE_SENSORS
    )


@query("rolling_std", oracle=_rolling_lines_sql("std"))
def rolling_std(spark: SparkSession, d: str) -> DataFrame:
    return t.rounded_features(
        rolling.rolling_std(_lines(spark, d), "l_suppkey", t.LINE_ORDER, t.LINE_SENSORS, t.WINDOWS), t.LINE_SENSORS
    )


@query("rolling_features", oracle=_rolling_lines_sql("mean", "std"))
def rolling_features(spark: SparkSession, d: str) -> DataFrame:
    return t.rounded_features(
        rolling.rolling_features(_lines(spark, d), "l_suppkey", t.LINE_ORDER, t.LINE_SENSORS, t.WINDOWS),
        t.LINE_SENSORS,
    )


@query("rolling_features_split_series", oracle=f"""
WITH {t.wide_sql()}
SELECT engine_model, unit_number, time_in_cycles, CAST(w AS VARCHAR) AS window_start, {t.rounded_sql(M)},
       {t.rolling_sql(M, 'engine_model', 'time_in_cycles, w, unit_number')} FROM wide""")
def rolling_features_split_series(spark: SparkSession, d: str) -> DataFrame:
    """Five long series (one per engine model), each cut into segments of about 500 rows."""
    rows = t.training_rows(spark, d).select("engine_model", "unit_number", "time_in_cycles", "window_start", *M)
    order = ["time_in_cycles", "window_start", "unit_number"]
    wide = rolling.rolling_features(rows, "engine_model", order, M, t.WINDOWS, hot_rows=500)
    return t.rounded(t.rounded_features(wide, M), M)


@query("feature_rows", oracle=f"""
WITH {t.wide_sql()}
SELECT unit_number, time_in_cycles, CAST(w AS VARCHAR) AS window_start, engine_model, {t.rounded_sql(M)},
       {t.rolling_sql(M, 'unit_number', 'time_in_cycles, w')} FROM wide""")
def feature_rows(spark: SparkSession, d: str) -> DataFrame:
    """Sparse metrics: frames with gaps and frames without values."""
    rows = t.training_rows(spark, d).select("unit_number", "time_in_cycles", "window_start", "engine_model", *M)
    wide = rolling.rolling_features(rows, "unit_number", ["time_in_cycles", "window_start"], M, t.WINDOWS)
    return t.rounded(t.rounded_features(wide, M), M)


@query("last_cycle", oracle=f"""
SELECT {', '.join(LINE_KEYS)} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY {', '.join(c + ' DESC' for c in t.LINE_ORDER)}) = 1""")
def last_cycle(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.last_row(_lines(spark, d), "l_suppkey", t.LINE_ORDER)


@query("last_values", oracle=f"""
WITH {t.wide_sql()}
SELECT sensor_id, {', '.join(f'round(arg_max({m}, w) FILTER (WHERE {m} IS NOT NULL), 9) AS {m}' for m in M)}
FROM wide GROUP BY sensor_id""")
def last_values(spark: SparkSession, d: str) -> DataFrame:
    last = cleaning.last_values(t.wide(spark, d), "sensor_id", ["time_in_cycles", "window_start"], M)
    return t.rounded(last, M)


RUL_SQL = f"""WITH {t.wide_sql()}, labelled AS (
  SELECT *, CAST(w AS VARCHAR) AS window_start,
         max(time_in_cycles) OVER (PARTITION BY unit_number) - time_in_cycles AS rul FROM wide)"""


@query("cap_rul", oracle=f"""{RUL_SQL}
SELECT sensor_id, window_start, CAST(least(rul, 130) AS DOUBLE) AS RUL FROM labelled""")
def cap_rul(spark: SparkSession, d: str) -> DataFrame:
    return labels.cap_rul(t.labelled(spark, d)).select("sensor_id", "window_start", "RUL")


@query("health_band", oracle=f"""{RUL_SQL}
SELECT sensor_id, window_start, rul AS RUL, {t.band_sql('rul')} AS status_id FROM labelled""")
def health_band(spark: SparkSession, d: str) -> DataFrame:
    return labels.with_health_band(t.labelled(spark, d), "RUL").select("sensor_id", "window_start", "RUL", "status_id")


@query("int_coercion", oracle=f"""
WITH {t.wide_sql()}
SELECT CAST(unit_number AS BIGINT) AS unit_number, CAST(time_in_cycles AS BIGINT) AS time_in_cycles,
       CAST(w AS VARCHAR) AS window_start,
       {', '.join(f'CAST(coalesce(trunc(-{m}), 0) AS BIGINT) AS {m}' for m in M)} FROM wide""")
def int_coercion(spark: SparkSession, d: str) -> DataFrame:
    # negated, to show that truncation goes toward zero
    rows = t.training_rows(spark, d).withColumns({m: -F.col(m) for m in M})
    return labels.whole_numbers(rows, ["unit_number", "time_in_cycles", *M]).select(
        "unit_number", "time_in_cycles", "window_start", *M
    )


@query("encode_engine_model", oracle=f"""
WITH {t.READINGS_SQL}
SELECT sensor_id, event_time, CASE WHEN metric = 'error' THEN 5 ELSE unit_number % 5 END AS code FROM readings""")
def encode_engine_model(spark: SparkSession, d: str) -> DataFrame:
    sent = F.when(F.col("metric") != "error", F.col("engine_model"))
    return t.readings(spark, d).select("sensor_id", "event_time", C.engine_model_code(sent).alias("code"))


@query("regression_metrics", oracle="""
SELECT count(*) AS n, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae
FROM (SELECT l_quantity * 1000 - l_extendedprice AS e FROM lineitem)""")
def regression_metrics(spark: SparkSession, d: str) -> DataFrame:
    lines = t.table(spark, d, "lineitem")
    scaled = lines.select((F.col("l_quantity") * 1000).alias("actual"), F.col("l_extendedprice").alias("guess"))
    return t.rounded(labels.regression_metrics(scaled, "actual", "guess"), ["rmse", "mae"], 4)


@query("truth_by_position", oracle="""
WITH units AS (SELECT DISTINCT user_id FROM events),
  numbered AS (SELECT user_id, row_number() OVER (ORDER BY user_id) AS i FROM units),
  truth AS (SELECT s_acctbal AS rul, row_number() OVER (ORDER BY s_suppkey) AS i FROM supplier)
SELECT CAST(user_id AS INTEGER) AS unit_number, rul FROM numbered LEFT JOIN truth USING (i)""")
def truth_by_position(spark: SparkSession, d: str) -> DataFrame:
    units = t.readings(spark, d).select(C.unit_number_of("sensor_id").alias("unit_number")).distinct()
    suppliers = t.table(spark, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("rul"))
    truth = number_rows(suppliers, ["s_suppkey"]).drop("s_suppkey")
    return join_by_position(units, truth)


@query("number_rows", oracle="""
SELECT o_orderkey, o_orderdate::VARCHAR AS day,
       row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_index FROM orders""")
def numbered(spark: SparkSession, d: str) -> DataFrame:
    orders = t.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return number_rows(orders, ["o_orderdate", "o_orderkey"]).select(
        "o_orderkey", F.col("o_orderdate").cast("string").alias("day"), "row_index"
    )


@query("split_80_20", oracle=f"""
WITH {t.wide_sql()}
SELECT unit_number, time_in_cycles,
  CAST(('0x' || substr(md5('42|' || unit_number || '|' || time_in_cycles), 1, 8)) AS BIGINT) % 100 < 80 AS is_train
FROM wide""")
def split_80_20(spark: SparkSession, d: str) -> DataFrame:
    keys = ["unit_number", "time_in_cycles"]
    return labels.with_split(t.training_rows(spark, d).select(*keys), keys)


@query("latest_run", oracle="""
SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS run_name, CAST(o_orderdate AS VARCHAR) AS started
FROM orders WHERE o_orderpriority <> '1-URGENT' ORDER BY o_orderdate DESC, run_id DESC LIMIT 1""")
def latest(spark: SparkSession, d: str) -> DataFrame:
    # orders as a run log in which one priority marks the monitoring runs
    runs = t.table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("run_name"),
        F.col("o_orderdate").alias("start_time"),
    )
    newest = latest_run(runs, "1-URGENT")
    return newest.select("run_id", "run_name", F.col("start_time").cast("string").alias("started"))


@query("preview_top10", oracle="""
SELECT o_orderkey, round(o_totalprice, 1) AS predicted, o_custkey AS actual FROM orders ORDER BY o_orderkey LIMIT 10""")
def preview_top10(spark: SparkSession, d: str) -> DataFrame:
    orders = t.table(spark, d, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("predicted"), F.col("o_custkey").alias("actual")
    )
    return labels.preview(orders, "o_orderkey", "predicted", "actual")


FEATURE_COLUMNS = ["sensor_id", "engine_model", "time_in_cycles", *M, "window_start", "date", "unit_number"]


@query("schema_check", oracle=f"""
SELECT (SELECT count(*) FROM lineitem) AS rows, "column", problem FROM (
  SELECT column_name AS "column", 'unexpected' AS problem FROM (DESCRIBE lineitem)
  UNION ALL SELECT unnest({FEATURE_COLUMNS}), 'missing')""")
def schema_check(spark: SparkSession, d: str) -> DataFrame:
    """How the rows of ``lineitem`` differ from the schema of the event features, with the row count."""
    lines, features = t.table(spark, d, "lineitem"), t.training_rows(spark, d)
    problems = schema_differences(lines.schema, features.schema)
    listed = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(p).alias("problem")) for c, p in problems])
    return lines.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.inline(listed))
