"""Readings: cleaning, reshaping, windows, baselines, keyed writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import tables as t
from millrace.catalog.registry import query
from millrace.functions import columns as C
from millrace.operators import baselines as B
from millrace.operators import cleaning, reshape
from millrace.plans.silver import SILVER_KEY, run_silver, silver_features, touched_days
from millrace.session import scratch_path
from millrace.sinks import tables as sinks
from millrace.sources import files
from millrace.sources.payloads import unpivot_payloads

M = t.EVENT_METRICS
MEANS = ", ".join(M)


@query("valid_readings", oracle=f"""
WITH {t.READINGS_SQL}, loose AS (
  SELECT * REPLACE (CASE WHEN value < 1 THEN '' WHEN value > 100 THEN NULL ELSE sensor_id END AS sensor_id)
  FROM readings)
SELECT sensor_id, engine_model, time_in_cycles, metric, value, event_time FROM loose
WHERE sensor_id IS NOT NULL AND sensor_id <> ''""")
def valid_readings(spark: SparkSession, d: str) -> DataFrame:
    # readings with extreme values stand in for those without a usable sensor
    blanked = F.when(F.col("value") < 1, "").when(F.col("value") <= 100, F.col("sensor_id"))
    return cleaning.valid_readings(t.readings(spark, d).withColumn("sensor_id", blanked))


@query("event_dates", oracle=f"""
WITH {t.READINGS_SQL}
SELECT sensor_id, metric, event_time, strftime(event_timestamp, '%Y-%m-%d') AS date FROM readings""")
def event_dates(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.dated(t.readings(spark, d)).select("sensor_id", "metric", "event_time", "date")


@query("event_timestamps", oracle=f"""
WITH {t.READINGS_SQL}
SELECT sensor_id, event_time, CAST(date_trunc('second', event_timestamp) AS VARCHAR) AS second,
       CAST(strftime(event_timestamp, '%Y%m%d%H%M') AS BIGINT) AS date_id
FROM readings""")
def event_timestamps(spark: SparkSession, d: str) -> DataFrame:
    # the "T" form, as devices send it
    iso = t.readings(spark, d).withColumn("event_time", F.translate("event_time", " ", "T"))
    at = F.col("event_timestamp")
    return cleaning.timed(iso).select(
        "sensor_id",
        F.translate("event_time", "T", " ").alias("event_time"),
        F.date_trunc("second", at).cast("string").alias("second"),
        C.date_key(at).alias("date_id"),
    )


@query("unpivot_readings", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, metric, CAST(value AS DOUBLE) AS value
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax
      FROM lineitem)
UNPIVOT (value FOR metric IN (l_quantity, l_extendedprice, l_discount, l_tax))""")
def unpivot_readings(spark: SparkSession, d: str) -> DataFrame:
    # the flag column holds letters, so it gives no readings
    return reshape.unpivot_readings(
        t.table(spark, d, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
        [*t.LINE_SENSORS, "l_returnflag"],
    )


@query("assign_engine_model", oracle=f"""
SELECT c_custkey, {t.MODEL_SQL.format(unit='c_custkey')} AS engine_model FROM customer""")
def assign_engine_model(spark: SparkSession, d: str) -> DataFrame:
    customers = t.table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("engine_model"))
    return reshape.assign_engine_model(customers, "c_custkey")


@query("default_engine_model", oracle=f"""
WITH {t.READINGS_SQL}
SELECT sensor_id, event_time, CASE WHEN metric = 'error' THEN 'Turbofan-CFM56' ELSE engine_model END AS engine_model
FROM readings""")
def default_engine_model(spark: SparkSession, d: str) -> DataFrame:
    sent = F.when(F.col("metric") != "error", F.col("engine_model"))
    return cleaning.with_default_model(t.readings(spark, d).withColumn("engine_model", sent)).select(
        "sensor_id", "event_time", "engine_model"
    )


@query("unit_id_roundtrip", oracle="""
SELECT 'unit_' || o_custkey AS sensor_id, CAST(o_custkey AS INTEGER) AS unit_number, count(*) AS n
FROM orders GROUP BY 1, 2""")
def unit_id_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    ids = t.table(spark, d, "orders").select(C.sensor_id_of("o_custkey").alias("sensor_id"))
    return ids.select("sensor_id", C.unit_number_of("sensor_id").alias("unit_number")).groupBy(
        "sensor_id", "unit_number"
    ).agg(F.count(F.lit(1)).alias("n"))


@query("select_by_prefix", oracle=f"""
WITH {t.wide_sql()}
SELECT 'unit_' || unit_number AS sensor_id FROM wide GROUP BY unit_number""")
def select_by_prefix(spark: SparkSession, d: str) -> DataFrame:
    return reshape.drop_prefix(t.event_baselines(spark, d))


@query("window_avg_1m", oracle=f"""
WITH {t.READINGS_SQL}
SELECT sensor_id, engine_model, time_in_cycles, metric,
       CAST(date_trunc('minute', event_timestamp) AS VARCHAR) AS window_start, round(avg(value), 9) AS value
FROM readings GROUP BY 1, 2, 3, 4, 5""")
def window_avg_1m(spark: SparkSession, d: str) -> DataFrame:
    means = reshape.window_avg(cleaning.timed(t.readings(spark, d)))
    return t.rounded(reshape.with_window_keys(means).drop("date"), ["value"])


@query("window_avg_1d", oracle=f"""
WITH {t.READINGS_SQL}
SELECT sensor_id, metric, CAST(date_trunc('day', event_timestamp) AS VARCHAR) AS window_start,
       round(avg(value), 9) AS value
FROM readings GROUP BY 1, 2, 3""")
def window_avg_1d(spark: SparkSession, d: str) -> DataFrame:
    means = reshape.window_avg(cleaning.timed(t.readings(spark, d)), "1 day", ["sensor_id", "metric"])
    return t.rounded(reshape.with_window_keys(means).drop("date"), ["value"])


@query("pivot_metrics_1h", oracle=f"""
WITH {t.wide_sql()}
SELECT sensor_id, engine_model, time_in_cycles, CAST(w AS VARCHAR) AS window_start,
       strftime(w, '%Y-%m-%d') AS date, {t.rounded_sql(M)} FROM wide""")
def pivot_metrics_1h(spark: SparkSession, d: str) -> DataFrame:
    return t.rounded(t.wide(spark, d), M)


@query("baselines", oracle=f"""
WITH {t.wide_sql()}
SELECT sensor_id, {', '.join(f'round(avg({m}), 9) AS ref_{m}' for m in M)} FROM wide GROUP BY 1""")
def baselines(spark: SparkSession, d: str) -> DataFrame:
    return t.rounded(t.event_baselines(spark, d), [f"ref_{m}" for m in M])


IMPUTED = ", ".join(f"round(coalesce(wide.{m}, b.{m}), 9) AS {m}" for m in M)
BASE = f"b AS (SELECT sensor_id, {', '.join(f'avg({m}) AS {m}' for m in M)} FROM wide GROUP BY 1)"


@query("impute_baseline", oracle=f"""
WITH {t.wide_sql()}, {BASE}
SELECT wide.sensor_id, engine_model, time_in_cycles, CAST(w AS VARCHAR) AS window_start,
       strftime(w, '%Y-%m-%d') AS date, {IMPUTED}
FROM wide LEFT JOIN b ON wide.sensor_id = b.sensor_id""")
def impute_baseline(spark: SparkSession, d: str) -> DataFrame:
    return t.rounded(B.impute(t.wide(spark, d), t.event_baselines(spark, d), M), M)


@query("join_baselines", oracle=f"""
WITH {t.wide_sql()}, b AS (
  SELECT sensor_id, avg(view) AS ref_view FROM wide WHERE engine_model <> 'Turbofan-GE90' GROUP BY 1)
SELECT wide.sensor_id, time_in_cycles, round(view, 9) AS view, round(ref_view, 9) AS ref_view
FROM wide LEFT JOIN b ON wide.sensor_id = b.sensor_id""")
def join_baselines(spark: SparkSession, d: str) -> DataFrame:
    # one model has no baselines, so its units join nothing
    known = t.training_rows(spark, d).filter("engine_model <> 'Turbofan-GE90'")
    joined = B.join_baselines(t.wide(spark, d), B.compute_baselines(known, ["view"]))
    return t.rounded(joined.select("sensor_id", "time_in_cycles", "view", "ref_view"), ["view", "ref_view"])


@query("silver_features", oracle=f"""
WITH {t.wide_sql('minute')}, {BASE}
SELECT wide.sensor_id, engine_model, time_in_cycles, CAST(w AS VARCHAR) AS window_start,
       strftime(w, '%Y-%m-%d') AS date, {IMPUTED}
FROM wide LEFT JOIN b ON wide.sensor_id = b.sensor_id""")
def silver(spark: SparkSession, d: str) -> DataFrame:
    base = t.event_baselines(spark, d, "1 minute")
    # every reading arrives twice; the copies must not weigh in
    replayed = t.readings(spark, d).unionByName(t.readings(spark, d))
    return t.rounded(silver_features(replayed, base, M), M)


@query("dedupe_latest", oracle="""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
  l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
  l_linestatus DESC) = 1""")
def dedupe_latest(spark: SparkSession, d: str) -> DataFrame:
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
    return cleaning.newest_per_key(t.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], order)


def _versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A first load up to the 20th, and corrections from the 15th on."""
    rows = t.wide(spark, d).select(*SILVER_KEY, "time_in_cycles", "view", "date")
    first = rows.filter("date < '2024-01-20'").withColumn("version", F.lit(1))
    changes = rows.filter("date >= '2024-01-15'").withColumn("view", F.col("view") + 100)
    return first, changes.withColumn("version", F.lit(2))


MERGED_SQL = f"""
WITH {t.wide_sql()}, rows_of AS (
  SELECT sensor_id, CAST(w AS VARCHAR) AS window_start, time_in_cycles, view, strftime(w, '%Y-%m-%d') AS date
  FROM wide), both_loads AS (
  SELECT *, 1 AS version FROM rows_of WHERE date < '2024-01-20'
  UNION ALL
  SELECT * REPLACE (view + 100 AS view), 2 AS version FROM rows_of WHERE date >= '2024-01-15')
SELECT sensor_id, window_start, time_in_cycles, round(view, 9) AS view, date, version FROM both_loads"""
NEWEST_SQL = "QUALIFY row_number() OVER (PARTITION BY sensor_id, window_start ORDER BY version DESC) = 1"


NO_DAY_SQL = """
UNION ALL SELECT r_name, 'none', 0, CASE WHEN r_regionkey > 1 THEN r_regionkey + 100 ELSE r_regionkey END::DOUBLE, NULL,
  CASE WHEN r_regionkey > 1 THEN 2 ELSE 1 END FROM region"""


@query("upsert_merge", oracle=f"SELECT * FROM ({MERGED_SQL}\n{NEWEST_SQL}) {NO_DAY_SQL}")
def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    first, changes = _versions(spark, d)
    path = scratch_path(spark, "silver")
    # both loads have a row without a day
    no_day = t.table(spark, d, "region").select(
        F.col("r_name").alias("sensor_id"), F.lit("none").alias("window_start"), F.lit(0).alias("time_in_cycles"),
        F.col("r_regionkey").cast("double").alias("view"), F.lit(None).cast("string").alias("date"))
    first = first.unionByName(no_day.filter("view < 3").withColumn("version", F.lit(1)))
    changes = changes.unionByName(no_day.filter("view > 1").withColumns({"view": F.col("view") + 100, "version": F.lit(2)}))
    sinks.write_partitioned(first, path)
    sinks.upsert(changes, path, SILVER_KEY, ["version", "time_in_cycles"])
    return t.rounded(files.read_table(spark, path).select(*changes.columns), ["view"])


@query("merge_touched", oracle=MERGED_SQL + " WHERE date >= '2024-01-15' " + NEWEST_SQL)
def merge_touched(spark: SparkSession, d: str) -> DataFrame:
    first, changes = _versions(spark, d)
    merged = sinks.merge(first, changes, SILVER_KEY, ["version", "time_in_cycles"])
    return t.rounded(merged.select(*changes.columns), ["view"])


@query("late_data_recompute", oracle=f"""
WITH {t.READINGS_SQL}, dated AS (SELECT *, CAST(event_timestamp AS DATE) AS day FROM readings)
SELECT sensor_id, engine_model, time_in_cycles, metric,
       CAST(date_trunc('hour', event_timestamp) AS VARCHAR) AS window_start, strftime(day, '%Y-%m-%d') AS date,
       round(avg(value), 9) AS value
FROM dated WHERE day IN (SELECT day FROM dated WHERE event_timestamp >= TIMESTAMP '2024-01-25 12:00:00')
GROUP BY 1, 2, 3, 4, 5, 6""")
def late_data_recompute(spark: SparkSession, d: str) -> DataFrame:
    history = cleaning.timed(cleaning.dated(t.readings(spark, d)))
    arrivals = history.filter(F.col("event_timestamp") >= F.lit("2024-01-25 12:00:00").cast("timestamp"))
    means = reshape.window_avg(touched_days(arrivals, history), "1 hour")
    return t.rounded(reshape.with_window_keys(means), ["value"])


@query("partitioned_read", oracle=f"""
WITH {t.READINGS_SQL}
SELECT sensor_id, metric, value, event_time, strftime(event_timestamp, '%Y-%m-%d') AS date FROM readings
WHERE strftime(event_timestamp, '%Y-%m-%d') BETWEEN '2024-01-10' AND '2024-01-12'""")
def partitioned_read(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    sinks.write_partitioned(cleaning.dated(t.readings(spark, d)), path)
    days = files.read_table(spark, path, ("2024-01-10", "2024-01-12"))
    return days.select("sensor_id", "metric", "value", "event_time", "date")


@query("append_and_overwrite", oracle="""
SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation""")
def append_and_overwrite(spark: SparkSession, d: str) -> DataFrame:
    nation = t.table(spark, d, "nation")
    path = scratch_path(spark, "nation")
    sinks.overwrite(nation.limit(0), path)
    sinks.overwrite(nation, path)
    sinks.append(nation, path)
    return files.read_parquet(spark, path)


@query("star_table_refresh", oracle="SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def star_table_refresh(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    sinks.write_star_table(t.table(spark, d, "orders"), path, "o_orderkey")
    return files.read_table(spark, path).select("o_orderkey", "o_custkey", "o_totalprice")


@query("quarantine_malformed", oracle=f"""
WITH {t.READINGS_SQL}
SELECT 'reading' AS kind, sensor_id, metric, value FROM readings
UNION ALL
SELECT 'quarantined', NULL, NULL, CAST(length(text) AS DOUBLE) FROM documents""")
def quarantine_malformed(spark: SparkSession, d: str) -> DataFrame:
    # prose between the payloads: none of it is JSON
    payloads = t.readings(spark, d).select(F.to_json(F.struct("*")).alias("value"))
    prose = t.table(spark, d, "documents").select(F.col("text").alias("value"))
    good, bad = files.parse_payloads(payloads.unionByName(prose))
    return good.select(F.lit("reading").alias("kind"), "sensor_id", "metric", "value").unionByName(
        bad.select(
            F.lit("quarantined").alias("kind"),
            F.lit(None).cast("string").alias("sensor_id"),
            F.lit(None).cast("string").alias("metric"),
            F.length(files.CORRUPT).cast("double").alias("value"),
        )
    )


@query("quarantine_untimed", oracle="""
SELECT 'unit_' || doc_id AS sensor_id, source AS event_time FROM documents""")
def quarantine_untimed(spark: SparkSession, d: str) -> DataFrame:
    # documents carry no time: their source name does not parse as one
    untimed = t.table(spark, d, "documents").select(
        C.sensor_id_of("doc_id").alias("sensor_id"), F.col("source").alias("event_time")
    )
    timed = t.readings(spark, d).select("sensor_id", "event_time")
    return cleaning.split_by_time(timed.unionByName(untimed))[1]


@query("csv_roundtrip", oracle=f"""
WITH {t.wide_sql()}
SELECT unit_number, time_in_cycles, {t.rounded_sql(M)}, CAST(1.5 * time_in_cycles AS DOUBLE) AS RUL, engine_model FROM wide""")
def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "train-csv")
    rows = t.training_rows(spark, d).withColumn("RUL", F.col("time_in_cycles") * F.lit(1.5))
    schema = files.training_schema(M)
    # the order of the columns in the file is another, and it has one more
    rows.select(*reversed(schema.names), "window_start").write.csv(path, sep=";", header=True)
    return t.rounded(files.read_training_csv(spark, path, M), M)


@query("test_csv_roundtrip", oracle=f"""
WITH {t.wide_sql()}
SELECT unit_number, time_in_cycles, {t.rounded_sql(M)}, engine_model FROM wide""")
def test_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "test-csv")
    schema = files.training_schema(M, rul=False)
    t.training_rows(spark, d).select(*sorted(schema.names)).write.csv(path, sep=",", header=True)
    return t.rounded(files.read_test_csv(spark, path, M), M)


@query("csv_unlike_headers", oracle=f"""
WITH {t.wide_sql()}
SELECT unit_number, time_in_cycles, {t.rounded_sql(M)}, CAST(time_in_cycles AS DOUBLE) AS RUL, engine_model FROM wide""")
def csv_unlike_headers(spark: SparkSession, d: str) -> DataFrame:
    """A folder of files whose columns come in different orders, with different extra ones."""
    path = scratch_path(spark, "unlike-csv")
    rows = t.training_rows(spark, d).withColumn("RUL", F.col("time_in_cycles").cast("double"))
    names = files.training_schema(M).names
    for i, columns in enumerate((names, [*reversed(names), "window_start"], ["date", *sorted(names)])):
        rows.filter(F.pmod("time_in_cycles", F.lit(3)) == i).select(*columns).write.mode("append").csv(path, sep=";", header=True)
    return t.rounded(files.read_training_csv(spark, path, M), M)


SHAPES = 6  # long, wide, nested, in an array with another, a number as text, a word


@query("payload_shapes", oracle=f"""
WITH e AS (SELECT event_id % {SHAPES} AS shape, 'unit_' || user_id AS sensor_id, event_type AS metric, value FROM events)
SELECT 'reading' AS kind, sensor_id, metric, value FROM e WHERE shape < 5
UNION ALL SELECT 'reading', sensor_id, 'extra', value + 1 FROM e WHERE shape IN (1, 2, 3)
UNION ALL SELECT 'no number', sensor_id, metric, NULL FROM e WHERE shape = 5
UNION ALL SELECT 'no value', sensor_id, 'extra', NULL FROM e WHERE shape = 4
UNION ALL SELECT 'no readings', sensor_id, NULL, NULL FROM e WHERE shape = 0
UNION ALL SELECT 'no object', NULL, NULL, NULL FROM nation
UNION ALL SELECT 'no json', NULL, NULL, NULL FROM region""")
def payload_shapes(spark: SparkSession, d: str) -> DataFrame:
    """Messages of mixed shapes, unpivoted without a list of metrics; whatever is no reading is in quarantine with its reason."""
    e = t.table(spark, d, "events").withColumn("shape", F.pmod("event_id", F.lit(SHAPES)))
    sensor, kind, value = C.sensor_id_of("user_id"), F.col("event_type"), F.col("value")
    quoted = lambda c: F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    joined = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    head = joined('{"sensor_id": ', quoted(sensor), ', "time_in_cycles": 1, "event_time": "2024-01-01 00:00:00"')
    wide = joined(head, ", ", quoted(kind), ": ", value, ', "extra": ', value + 1, "}")
    long = joined(head, ', "metric": ', quoted(kind), ', "value": ')
    text = (
        F.when(F.col("shape") == 0, joined("[", long, value, "}, ", head, "}]"))
        .when(F.col("shape") == 1, wide)
        .when(F.col("shape") == 2, joined(head, ', "metrics": {', quoted(kind), ": ", value, ', "extra": ', value + 1, "}}"))
        .when(F.col("shape") == 3, joined("[", long, value, "}, ", long.substr(F.lit(1), F.length(head)), ', "extra": ', value + 1, "}]"))
        .when(F.col("shape") == 4, joined(head, ", ", quoted(kind), ": ", quoted(value), ', "extra": null}'))
        .otherwise(joined(long, '"word"}'))
    )
    scalars = t.table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("value"))
    prose = t.table(spark, d, "region").select(F.concat(F.lit("no json "), F.col("r_name")).alias("value"))
    good, bad = unpivot_payloads(e.select(text.alias("value")).unionByName(scalars).unionByName(prose))
    return good.select(F.lit("reading").alias("kind"), "sensor_id", "metric", "value").unionByName(
        bad.select(F.col("reason").alias("kind"), "sensor_id", "metric", F.lit(None).cast("double").alias("value")))


@query("read_truth", oracle="""
SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_index, CAST(c_custkey % 130 AS DOUBLE) AS rul FROM customer""")
def read_truth(spark: SparkSession, d: str) -> DataFrame:
    """A headerless file, one value a line, read back with its positions."""
    path = scratch_path(spark, "truth")
    customers = t.table(spark, d, "customer").orderBy("c_custkey").select((F.col("c_custkey") % 130).cast("string").alias("value"))
    customers.coalesce(1).write.text(path)  # lines have an order within one file only
    return files.read_truth(spark, path)


@query("dedupe_newest", oracle=f"""
WITH {t.READINGS_SQL}, copies AS (
  SELECT sensor_id, metric, event_time, engine_model, time_in_cycles, value, 1 AS v FROM readings
  UNION ALL SELECT sensor_id, metric, event_time, engine_model, time_in_cycles, -value, 2 FROM readings WHERE time_in_cycles % 2 = 0
  UNION ALL SELECT sensor_id, metric, event_time, NULL, time_in_cycles, value + 1000, 0 FROM readings)
SELECT sensor_id, metric, event_time, value FROM copies
QUALIFY row_number() OVER (PARTITION BY sensor_id, metric, event_time ORDER BY v DESC, value DESC) = 1""")
def dedupe_newest(spark: SparkSession, d: str) -> DataFrame:
    """Copies that contradict each other, also in their model: the one processed last counts."""
    rows = t.readings(spark, d)
    at = lambda df, minute: df.withColumn("processed_at", F.lit(f"2024-03-01 00:0{minute}:00").cast("timestamp"))
    corrected = rows.filter("time_in_cycles % 2 = 0").withColumn("value", -F.col("value"))
    older = rows.withColumns({"value": F.col("value") + 1000, "engine_model": F.lit(None).cast("string")})
    return cleaning.dedupe_readings(at(rows, 1).unionByName(at(corrected, 2)).unionByName(at(older, 0))).select(
        "sensor_id", "metric", "event_time", "value")


@query("silver_accounting", oracle=f"""
WITH {t.READINGS_SQL}
SELECT 'averaged' AS place, count(*) FILTER (WHERE value >= 5) AS n FROM readings
UNION ALL SELECT 'no readable time', count(*) FILTER (WHERE value >= 1 AND value < 5) FROM readings
UNION ALL SELECT 'no sensor', count(*) FILTER (WHERE value < 1) FROM readings""")
def silver_accounting(spark: SparkSession, d: str) -> DataFrame:
    """Readings in are readings averaged or quarantined, through the whole Silver run."""
    rows = t.readings(spark, d).withColumns({
        "sensor_id": F.when(F.col("value") >= 1, F.col("sensor_id")),
        "event_time": F.when((F.col("value") < 1) | (F.col("value") >= 5), F.col("event_time")).otherwise("never"),
        "metric": F.concat("metric", F.lit("-"), F.col("event_time"))})  # every reading a metric of its own
    bronze, silver, bad = (scratch_path(spark, x) for x in ("bronze", "silver", "rejects"))
    sinks.write_partitioned(cleaning.dated(cleaning.stamped(rows)), bronze)
    run_silver(spark, bronze, silver, metrics=M, quarantine_path=bad)
    rejects = spark.read.parquet(bad).groupBy(F.col("reason").alias("place")).agg(F.count(F.lit(1)).alias("n"))
    good = cleaning.valid_readings(cleaning.dedupe_readings(files.read_table(spark, bronze)))
    averaged = cleaning.split_by_time(good)[0].agg(F.count(F.lit(1)).alias("n")).select(F.lit("averaged").alias("place"), "n")
    return averaged.unionByName(rejects)
