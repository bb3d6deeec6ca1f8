"""Streams and tables that carry state from run to run: versions, ledger, partials, look-back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog import tables as t
from millrace.catalog.registry import query
from millrace.operators import cleaning
from millrace.operators.rolling import feature_names
from millrace.plans import partials as P
from millrace.plans.silver import run_silver
from millrace.session import scratch_path, settings
from millrace.sources.files import READING_SCHEMA, read_table
from millrace.streaming import bronze, rolling
from millrace.streaming.ledger import BatchLedger, ledger_of

ALL = {"availableNow": True}
M = t.EVENT_METRICS
VERSIONED = T.StructType([*READING_SCHEMA.fields, T.StructField("processed_at", T.TimestampType())])
STEPS = 5  # loads that land one after the other
FILE_ROWS = 200_000  # rows of a landed file
#: a stream keeps as many state stores as it starts with, and these tables are small
FEW = {"spark__sql__shuffle__partitions": "4"}
FAR = "2200-01-01 00:00:00"


def _land_in_steps(rows: DataFrame, at: Column, path: str, steps: range, form: str = "json", files: int = 1) -> None:
    """Rows by time of arrival, ``files`` files for each step, so that a stream sees them in that order."""
    stepped = rows.withColumn("_step", F.least(F.lit(STEPS - 1), F.greatest(F.lit(0), (F.dayofmonth(at) - 1) * STEPS / 31).cast("int")))
    for i in steps:
        stepped.filter(F.col("_step") == i).drop("_step").transform(lambda x: x.repartition(files) if files > 1 else x.coalesce(1)).write.mode("append").format(form).save(path)


def _heartbeat(rows: DataFrame, path: str, form: str = "json", **values: Column) -> None:
    """A line without a unit, far in the future, which lets the stream finish what waits."""
    spark = rows.sparkSession
    nothing = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema]
    spark.range(1).select(*nothing).write.mode("append").format(form).save(path)


NEWEST_VERSIONS = f"""
WITH {t.READINGS_SQL}, copies AS (
  SELECT sensor_id, metric, event_time, engine_model, time_in_cycles, value, 1 AS v FROM readings
  UNION ALL SELECT sensor_id, metric, event_time, engine_model, time_in_cycles, -value, 2 FROM readings WHERE time_in_cycles % 2 = 0
  UNION ALL SELECT sensor_id, metric, event_time, NULL, time_in_cycles, value + 1000, 0 FROM readings)
SELECT sensor_id, metric, event_time, engine_model, value FROM copies
QUALIFY row_number() OVER (PARTITION BY sensor_id, metric, event_time ORDER BY v DESC, value DESC) = 1"""


@query("stream_dedupe_newest", oracle=NEWEST_VERSIONS)
def stream_dedupe_newest(spark: SparkSession, d: str) -> DataFrame:
    """Contradicting versions of every reading, out of order over several batches and a restart: the newest one is kept."""
    landing, out, progress = (scratch_path(spark, x) for x in ("versions", "newest", "newest-progress"))
    rows = cleaning.timed(t.readings(spark, d))
    version = lambda df, v, hours: df.withColumns({
        "processed_at": F.timestamp_seconds(F.lit(1700000000 + v)),
        "_arrives": F.col("event_timestamp") + F.make_dt_interval(hours=F.lit(hours))}).drop("event_timestamp")
    corrected = version(rows.filter("time_in_cycles % 2 = 0").withColumn("value", -F.col("value")), 2, 7)
    outdated = version(rows.withColumns({"value": F.col("value") + 1000, "engine_model": F.lit(None).cast("string")}), 0, 30)
    arriving = version(rows, 1, 0).unionByName(corrected).unionByName(outdated)

    def run() -> None:
        stream = bronze.stream_readings(spark, landing, VERSIONED, max_files=2)
        newest = bronze.newest_in_stream(stream, "60 days")  # a file holds a sixth of a month, and day 31 lands with day 1
        with settings(spark, **FEW):
            newest.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).outputMode("append").trigger(**ALL).start().awaitTermination()

    for steps in (range(2), range(2, STEPS)):
        _land_in_steps(arriving, F.col("_arrives"), landing, steps)
        if steps.start == 0:
            run()
    _heartbeat(spark.createDataFrame([], VERSIONED), landing, event_time=F.lit(FAR))
    run()
    return spark.read.parquet(out).select("sensor_id", "metric", "event_time", "engine_model", "value")


@query("stream_rolling_features", oracle=f"""
WITH {t.wide_sql()}
SELECT sensor_id, time_in_cycles, CAST(w AS VARCHAR) AS window_start, {t.rolling_sql(M, 'sensor_id', 'time_in_cycles, w')} FROM wide""")
def stream_rolling_features(spark: SparkSession, d: str) -> DataFrame:
    """Feature rows out of order over several batches and a restart: the same features as in a batch."""
    stored, landing, out, progress = (scratch_path(spark, x) for x in ("wide-rows", "wide", "features", "features-progress"))
    t.wide(spark, d).withColumn("at", F.col("window_start").cast("timestamp")).write.parquet(stored)
    wide = spark.read.parquet(stored)
    late = F.col("at") + F.make_dt_interval(hours=F.pmod(F.xxhash64("sensor_id", "window_start"), F.lit(40)).cast("int"))
    files = 1 + wide.count() // (STEPS * FILE_ROWS)

    def run() -> None:
        stream = spark.readStream.schema(wide.schema).option("maxFilesPerTrigger", 2 * files).parquet(landing)
        features = rolling.rolling_in_stream(stream, "sensor_id", ["time_in_cycles", "window_start"], M, "at", "60 days", t.WINDOWS)
        stores = max(4, spark.sparkContext.defaultParallelism)
        with settings(spark, spark__sql__shuffle__partitions=str(stores)):
            features.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).outputMode("append").trigger(**ALL).start().awaitTermination()

    for steps in (range(2), range(2, STEPS)):
        _land_in_steps(wide, late, landing, steps, "parquet", files)
        if steps.start == 0:
            run()
    _heartbeat(wide, landing, "parquet", at=F.lit(FAR))
    run()
    return t.rounded_features(spark.read.parquet(out).select("sensor_id", "time_in_cycles", "window_start", *feature_names(M, t.WINDOWS)), M)


def _two_loads(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Most readings, then those that came late and those of the last days."""
    rows = t.readings(spark, d)
    late = (F.pmod(F.xxhash64("sensor_id", "event_time"), F.lit(11)) == 0) | (F.col("event_time") >= "2024-01-25")
    return rows.filter(~late), rows.filter(late)


def _bronze_in_two_loads(spark: SparkSession, d: str, after_first=lambda bronze: None) -> str:
    landing, out, progress = (scratch_path(spark, x) for x in ("landing", "bronze", "bronze-progress"))
    for i, load in enumerate(_two_loads(spark, d)):
        load.repartitionByRange(3, "event_time").write.mode("append").json(landing)
        bronze.start_bronze(bronze.stream_readings(spark, landing, max_files=2), out, progress, trigger=ALL).awaitTermination()
        if not i:
            after_first(out)
    return out


@query("bronze_ledger", oracle=f"""
WITH {t.READINGS_SQL}
SELECT strftime(event_timestamp, '%Y-%m-%d') AS day, count(*) AS noted, count(*) AS stored FROM readings GROUP BY 1""")
def bronze_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Rows by day, as the ledger of all batches notes them and as the table holds them."""
    out = _bronze_in_two_loads(spark, d)
    noted = BatchLedger(spark, ledger_of(out)).rows().filter("state = 'landed' AND n > 0").groupBy("day").agg(F.sum("n").alias("noted"))
    stored = read_table(spark, out).groupBy(F.col("date").alias("day")).agg(F.count(F.lit(1)).alias("stored"))
    return noted.join(stored, "day", "full")


SILVER_SQL = f"""
WITH {t.wide_sql('minute')}
SELECT sensor_id, engine_model, time_in_cycles, CAST(w AS VARCHAR) AS window_start, strftime(w, '%Y-%m-%d') AS date, {t.rounded_sql(M)}
FROM wide QUALIFY row_number() OVER (PARTITION BY sensor_id, w ORDER BY time_in_cycles DESC, engine_model DESC) = 1"""
SILVER_COLUMNS = ["sensor_id", "engine_model", "time_in_cycles", "window_start", "date", *M]


@query("silver_partials", oracle=SILVER_SQL)
def silver_partials(spark: SparkSession, d: str) -> DataFrame:
    """Two loads, the second with late readings, merged as counts and sums: what one run over all readings gives."""
    parts, silver = scratch_path(spark, "partials"), scratch_path(spark, "silver")
    update = lambda out: P.run_silver_incrementally(spark, out, parts, silver, metrics=M)
    update(_bronze_in_two_loads(spark, d, update))
    return t.rounded(read_table(spark, silver).select(*SILVER_COLUMNS), M)


@query("silver_since", oracle=SILVER_SQL)
def silver_since(spark: SparkSession, d: str) -> DataFrame:
    """A full run after the first load, then one over the days that the ledger names for the second."""
    silver, seen = scratch_path(spark, "silver"), {}

    def first(out: str) -> None:
        run_silver(spark, out, silver, metrics=M)
        seen["at"] = BatchLedger(spark, ledger_of(out)).rows().agg(F.max("at").cast("string")).first()[0]

    out = _bronze_in_two_loads(spark, d, first)
    run_silver(spark, out, silver, metrics=M, since=seen["at"])
    return t.rounded(read_table(spark, silver).select(*SILVER_COLUMNS), M)


@query("processing_stamp", oracle=f"""
WITH {t.READINGS_SQL} SELECT sensor_id, metric, event_time, true AS stamped, true AS after_event FROM readings""")
def processing_stamp(spark: SparkSession, d: str) -> DataFrame:
    """Every reading gets one time of processing, which lies after the reading's own."""
    at, event = F.col("processed_at"), F.col("event_time").cast("timestamp")
    return cleaning.stamped(t.readings(spark, d)).select(
        "sensor_id", "metric", "event_time", at.isNotNull().alias("stamped"), (at > event).alias("after_event"))


@query("bronze_retention", oracle=f"""
WITH {t.READINGS_SQL} SELECT place, count(*) AS n FROM readings, (VALUES ('bronze'), ('kept or archived')) AS p(place) GROUP BY 1""")
def bronze_retention(spark: SparkSession, d: str) -> DataFrame:
    """Files that were read move to the archive and none is lost: archive and landing together hold all readings."""
    landing, archive, out, progress = (scratch_path(spark, x) for x in ("landing", "archive", "bronze", "progress"))
    for load in _two_loads(spark, d):
        load.repartition(3).write.mode("append").json(landing)
        stream = bronze.stream_readings(spark, landing, max_files=2, archive=archive)
        bronze.start_bronze(stream, out, progress, trigger=ALL).awaitTermination()
    files = spark.read.schema(READING_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
    # archiving runs beside the stream, so a file may be in either place
    places = [p for p in (landing, archive) if read_any(spark, p)]
    found = files.json(places).dropDuplicates(list(READING_SCHEMA.names))
    count = lambda df, place: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(place).alias("place"), "n")
    return count(read_table(spark, out), "bronze").unionByName(count(found, "kept or archived"))


def read_any(spark: SparkSession, path: str) -> bool:
    """Whether the folder exists."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
