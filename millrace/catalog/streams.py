"""Streaming queries, run over all landed files until nothing is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import tables as t
from millrace.catalog.registry import query
from millrace.operators import reshape
from millrace.session import scratch_path
from millrace.sources.files import READING_SCHEMA, read_table
from millrace.streaming import bronze

ALL = {"availableNow": True}
COLUMNS = READING_SCHEMA.names


def _landed(spark: SparkSession, d: str) -> str:
    """JSON files as a producer leaves them, in the order of time."""
    path = scratch_path(spark, "landing")
    t.readings(spark, d).repartitionByRange(4, "event_time").write.json(path)
    return path


@query("stream_bronze", oracle=f"""
WITH {t.READINGS_SQL}
SELECT sensor_id, engine_model, time_in_cycles, metric, value, event_time,
       strftime(event_timestamp, '%Y-%m-%d') AS date FROM readings""")
def stream_bronze(spark: SparkSession, d: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "bronze"), scratch_path(spark, "bronze-progress")
    bronze.start_bronze(bronze.stream_readings(spark, _landed(spark, d), max_files=2), out, checkpoint, trigger=ALL).awaitTermination()
    return read_table(spark, out).select(*COLUMNS, "date")


@query("stream_accounting", oracle=f"""
WITH {t.READINGS_SQL}
SELECT 'bronze' AS place, count(*) FILTER (WHERE value >= 1) AS n FROM readings
UNION ALL SELECT 'quarantine', (SELECT count(*) FROM readings WHERE value < 1) + (SELECT count(*) FROM region)""")
def stream_accounting(spark: SparkSession, d: str) -> DataFrame:
    """Lines in are rows out: readings without a sensor and lines that are no JSON are all in quarantine."""
    landing, out, bad = (scratch_path(spark, x) for x in ("landing", "bronze", "rejects"))
    blanked = t.readings(spark, d).withColumn("sensor_id", F.when(F.col("value") >= 1, F.col("sensor_id")))
    prose = t.table(spark, d, "region").select(F.concat(F.lit("no json: "), F.col("r_name")).alias("value"))
    blanked.select(F.to_json(F.struct("*")).alias("value")).unionByName(prose).write.text(landing)
    bronze.start_bronze(bronze.stream_readings(spark, landing), out, scratch_path(spark, "progress"), trigger=ALL, quarantine=bad).awaitTermination()
    count = lambda path, name: spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("place"), "n")
    return count(out, "bronze").unionByName(count(bad, "quarantine"))


LATE = "INTERVAL 10 MINUTE"


@query("stream_window_avg", oracle=f"""
WITH {t.READINGS_SQL}
SELECT sensor_id, engine_model, time_in_cycles, metric,
       CAST(date_trunc('minute', event_timestamp) AS VARCHAR) AS window_start, round(avg(value), 9) AS value
FROM readings
GROUP BY 1, 2, 3, 4, date_trunc('minute', event_timestamp)
HAVING date_trunc('minute', event_timestamp) + INTERVAL 1 MINUTE
       <= (SELECT max(date_trunc('millisecond', event_timestamp)) - {LATE} FROM readings)""")
def stream_window_avg(spark: SparkSession, d: str) -> DataFrame:
    """The windows that the final watermark has passed."""
    out, checkpoint = scratch_path(spark, "means"), scratch_path(spark, "means-progress")
    means = bronze.stream_window_avg(bronze.stream_readings(spark, _landed(spark, d)))
    (
        means.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(**ALL).start().awaitTermination()
    )
    flat = reshape.with_window_keys(spark.read.parquet(out)).drop("date")
    return t.rounded(flat, ["value"])


@query("stream_features", oracle=f"""
WITH {t.wide_sql('minute')}
SELECT sensor_id, engine_model, time_in_cycles, CAST(w AS VARCHAR) AS window_start, {t.rounded_sql(t.EVENT_METRICS)} FROM wide
WHERE w + INTERVAL 1 MINUTE <= (SELECT max(date_trunc('millisecond', event_timestamp)) - {LATE} FROM readings)""")
def stream_features(spark: SparkSession, d: str) -> DataFrame:
    """Wide feature rows of the windows that the final watermark has passed."""
    out, checkpoint = scratch_path(spark, "wide"), scratch_path(spark, "wide-progress")
    wide = bronze.stream_features(bronze.stream_readings(spark, _landed(spark, d)), t.EVENT_METRICS)
    (
        wide.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(**ALL).start().awaitTermination()
    )
    return t.rounded(reshape.with_window_keys(spark.read.parquet(out)).drop("date"), t.EVENT_METRICS)


@query("stream_payloads", oracle=f"""
WITH {t.READINGS_SQL}
SELECT 'readings' AS place, count(*) AS n FROM readings UNION ALL SELECT 'quarantine', (SELECT count(*) FROM documents WHERE text <> '')""")
def stream_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Two streams over the same lines: the readings, and the lines that are no JSON."""
    landing = scratch_path(spark, "lines")
    prose = t.table(spark, d, "documents").filter("text <> ''").select(F.regexp_replace("text", "[\\r\\n]+", " ").alias("value"))
    t.readings(spark, d).select(F.to_json(F.struct("*")).alias("value")).unionByName(prose).write.text(landing)
    counts = []
    for rows, place in zip(bronze.stream_payloads(spark, landing), ("readings", "quarantine")):
        out, checkpoint = scratch_path(spark, place), scratch_path(spark, f"{place}-progress")
        (
            rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .trigger(**ALL).start().awaitTermination()
        )
        counts.append(spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n")).select(F.lit(place).alias("place"), "n"))
    return counts[0].unionByName(counts[1])
