"""Slices of the star: pruned facts, merged moments, clustered files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import star as S
from millrace.catalog import tables as t
from millrace.catalog.registry import query
from millrace.operators.clustering import clustered
from millrace.plans import cube as Q
from millrace.plans import dashboard, gold
from millrace.session import scratch_path
from millrace.sources.files import read_table

M = t.EVENT_METRICS
ENGINES = ["unit_1", "unit_2", "unit_3", "unit_5", "unit_8"]
FIRST, LAST = "2024-01-05", "2024-01-24"
DAYS_SQL = f"CAST(w AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"
ENGINES_SQL = "sensor_id IN (" + ", ".join(f"'{e}'" for e in ENGINES) + ")"


def _stored_fact(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """The fact by day, as Gold writes it, and its engines."""
    rows = S._plain(spark, d)
    day = F.to_date(F.substring(F.col("date_id").cast("string"), 1, 8), "yyyyMMdd").cast("string")
    fact, path = gold.fact_engine_health(rows, M).withColumn("date", day), scratch_path(spark, "fact")
    clustered(fact, ["engine_id", "date_id"], ["date"]).write.partitionBy("date").parquet(path)
    return path, gold.dim_engine(rows)


@query("bi_slice_of_fact", oracle=f"""
WITH {S.STAR} SELECT sensor_id, timestamp_str, time_in_cycles, predicted_rul, status_id FROM star WHERE {ENGINES_SQL}
  AND timestamp_str BETWEEN '{FIRST} 06:00:00' AND '{LAST} 17:00:00'""")
def slice_of_fact(spark: SparkSession, d: str) -> DataFrame:
    """Slicers as literals on the fact's own columns, before the dimensions are joined."""
    path, engines = _stored_fact(spark, d)
    facts = dashboard.sliced_fact(read_table(spark, path), engines, ENGINES, f"{FIRST} 06:00:00", f"{LAST} 17:00:00")
    rows = facts.join(engines, "engine_id").join(gold.dim_date(t.wide(spark, d)), "date_id")
    return rows.select("sensor_id", "timestamp_str", "time_in_cycles", "predicted_rul", "status_id")


def _cells(spark: SparkSession, d: str) -> tuple[DataFrame, dict[str, float], DataFrame]:
    fact, engines = _stored_fact(spark, d)
    path = scratch_path(spark, "cube")
    Q.refresh_cube(spark, fact, path, M, (FIRST, "2024-01-31"))
    Q.refresh_cube(spark, fact, path, M, ("2024-01-01", "2024-01-10"))  # days before and days again
    return read_table(spark, path), Q.read_offsets(spark, path), engines


@query("cube_trend", oracle=f"""
WITH {S.STAR} SELECT CAST(date_trunc('day', w) AS VARCHAR) AS bucket,
  {', '.join(f'round(avg({c}), 9) AS {c}' for c in [*M, 'predicted_rul'])} FROM star WHERE {DAYS_SQL} GROUP BY 1""")
def cube_trend(spark: SparkSession, d: str) -> DataFrame:
    """Daily means of the fleet, from stored cells."""
    cells, offsets, _ = _cells(spark, d)
    columns = [*M, "predicted_rul"]
    trend = Q.trend_from_cells(Q.sliced_cells(cells, first_day=FIRST, last_day=LAST), offsets, columns)
    return t.rounded(trend, columns)


CORRELATION = " UNION ALL ".join(
    f"""SELECT '{m}' AS sensor, count({m}) AS n, round(corr(predicted_rul, {m}), 6) AS correlation,
  round(regr_slope(predicted_rul, {m}), 6) AS slope, round(regr_intercept(predicted_rul, {m}), 6) AS intercept FROM chosen"""
    for m in M)


@query("cube_correlation", oracle=f"""
WITH {S.STAR}, chosen AS (SELECT * FROM star WHERE {DAYS_SQL} AND status_id >= 2) {CORRELATION}""")
def cube_correlation(spark: SparkSession, d: str) -> DataFrame:
    """Correlation with the RUL and its line, of a range of days and two states, from stored cells."""
    cells, offsets, _ = _cells(spark, d)
    found = Q.correlation_from_cells(Q.sliced_cells(cells, first_day=FIRST, last_day=LAST, statuses=[2, 3]), offsets, M)
    return t.rounded(found, ["correlation", "slope", "intercept"], 6)


@query("cube_engine_trend", oracle=f"""
WITH {S.STAR} SELECT CAST(date_trunc('month', w) AS VARCHAR) AS bucket,
  {', '.join(f'round(avg({c}), 9) AS {c}' for c in M)} FROM star WHERE {ENGINES_SQL} GROUP BY 1""")
def cube_engine_trend(spark: SparkSession, d: str) -> DataFrame:
    """Monthly means of chosen engines."""
    cells, offsets, engines = _cells(spark, d)
    return t.rounded(Q.trend_from_cells(Q.sliced_cells(cells, engines, ENGINES), offsets, M, "month"), M)


@query("clustered_orders", oracle="""
SELECT 'customer' AS slice, o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey BETWEEN 10 AND 20
UNION ALL SELECT 'price', o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 101000""")
def clustered_orders(spark: SparkSession, d: str) -> DataFrame:
    """A table clustered by two columns gives the same rows for a slice by either."""
    path = scratch_path(spark, "clustered")
    clustered(t.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey", "o_totalprice"]).write.parquet(path)
    rows = spark.read.parquet(path)
    by = {"customer": F.col("o_custkey").between(10, 20), "price": F.col("o_totalprice").between(100000, 101000)}
    return rows.filter(by["customer"]).withColumn("slice", F.lit("customer")).unionByName(rows.filter(by["price"]).withColumn("slice", F.lit("price")))
