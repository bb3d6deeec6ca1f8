"""Stored moments of the facts, from which averages, trends and correlations of any slice are merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import remove_scratch, scratch_path
from millrace.sinks.tables import overwrite, replace_partitions
from millrace.sources.files import read_table

RUL = "predicted_rul"
LEVEL = "level"
FINE, FLEET = "engine", "fleet"  # cells by (day, engine, status), and by (day, status)
ALONE = ("n_all", "s_all")  # of the column, whether or not there is a prediction
PAIRED = ("n", "sx", "sy", "sxx", "syy", "sxy")  # of rows that have both


def offsets_of(fact: DataFrame, columns: Sequence[str], rul: str = RUL) -> dict[str, float]:
    """A number near the mean of every column. Moments are taken around these, so that squares of large, nearly equal
    values keep their digits; any number is right, as long as all cells of a cube use the same."""
    means = fact.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(c) for c in [*columns, rul]]).first()
    return {c: means[c] or 0.0 for c in [*columns, rul]}


def moments(fact: DataFrame, offsets: dict[str, float], keys: Sequence[str] = ("date", "engine_id", "status_id"), rul: str = RUL) -> DataFrame:
    """One row per cell and column: counts, sums, squares and products around the offsets. They add up over cells."""
    y = F.col(rul).cast("double") - offsets[rul]

    def cell(c: str) -> Column:
        x = F.col(c).cast("double") - offsets[c]
        both = x.isNotNull() & y.isNotNull()
        total = lambda v: F.coalesce(F.sum(F.when(both, v)), F.lit(0.0))
        return F.struct(
            F.count(c).alias("n_all"), F.coalesce(F.sum(x), F.lit(0.0)).alias("s_all"), F.count_if(both).alias("n"),
            total(x).alias("sx"), total(y).alias("sy"), total(x * x).alias("sxx"), total(y * y).alias("syy"), total(x * y).alias("sxy"))

    columns = list(offsets)
    cells = fact.groupBy(*keys).agg(*[cell(c).alias(f"_{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"_{i}")[p].alias(p) for p in (*ALONE, *PAIRED)]) for i, c in enumerate(columns)])
    return cells.select(*keys, F.inline(rows))


def merged(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    return cells.groupBy(*keys, "column").agg(*[F.sum(p).alias(p) for p in (*ALONE, *PAIRED)])


def cube(fact: DataFrame, offsets: dict[str, float], rul: str = RUL) -> DataFrame:
    """Cells by (date, engine, status), and rolled up over the engines, in one pass over the facts.

    ``level`` tells them apart; the rolled-up cells have no engine. The facts are aggregated once, the roll-up adds up cells.
    """
    fine = moments(fact, offsets, rul=rul)
    sums = [F.sum(p).alias(p) for p in (*ALONE, *PAIRED)]
    whole = fine.groupingSets([["date", "engine_id", "status_id", "column"], ["date", "status_id", "column"]],
                              "date", "engine_id", "status_id", "column").agg(F.grouping("engine_id").alias("_fleet"), *sums)
    return whole.withColumn(LEVEL, F.when(F.col("_fleet") == 1, FLEET).otherwise(FINE)).drop("_fleet")


def refresh_cube(spark: SparkSession, fact_path: str, path: str, columns: Sequence[str], dates: tuple[str, str] | None = None) -> bool:
    """Writes the cells of the given days, or all, partitioned by level and day; the offsets are those of the first build."""
    fact = read_table(spark, fact_path, dates)
    if fact is None:
        return False
    known = read_table(spark, f"{path}-offsets")
    if known is None:
        overwrite(spark.createDataFrame(list(offsets_of(fact, columns).items()), "column string, around double"), f"{path}-offsets")
    staged = scratch_path(spark, "cube")
    overwrite(cube(fact, read_offsets(spark, path)), staged)
    replace_partitions(spark.read.parquet(staged), path, LEVEL, ["date"])
    remove_scratch(spark, staged)
    return True


def read_offsets(spark: SparkSession, path: str) -> dict[str, float]:
    return {r["column"]: r["around"] for r in spark.read.parquet(f"{path}-offsets").collect()}  # a row a column


def sliced_cells(cells: DataFrame, engines: DataFrame | None = None, sensors: Sequence[str] | None = None, first_day: str | None = None,
                 last_day: str | None = None, statuses: Sequence[int] | None = None) -> DataFrame:
    """Cells of a slice: of the fleet's, unless engines are chosen. Level and days are partitions."""
    cells = cells.filter(F.col(LEVEL) == (FLEET if sensors is None else FINE))
    if first_day is not None:
        cells = cells.filter(F.col("date") >= first_day)
    if last_day is not None:
        cells = cells.filter(F.col("date") <= last_day)
    if statuses is not None:
        cells = cells.filter(F.col("status_id").isin(list(statuses)))
    if sensors is not None:
        chosen = engines.filter(F.col("sensor_id").isin(list(sensors))).select("engine_id").distinct()
        cells = cells.join(chosen, "engine_id", "left_semi")
    return cells


def trend_from_cells(cells: DataFrame, offsets: dict[str, float], columns: Sequence[str], bucket: str = "day") -> DataFrame:
    """What ``metric_trend`` gives for the facts of these cells: means per time bucket."""
    start = F.date_trunc(bucket, F.col("date").cast("timestamp")).cast("string").alias("bucket")
    sums = cells.filter(F.col("column").isin(list(columns))).groupBy(start, "column").agg(F.sum("n_all").alias("n"), F.sum("s_all").alias("s"))
    mean = F.col("s") / F.nullif(F.col("n"), F.lit(0))
    return sums.groupBy("bucket").agg(*[(F.max(F.when(F.col("column") == c, mean)) + offsets[c]).alias(c) for c in columns])


def correlation_from_cells(cells: DataFrame, offsets: dict[str, float], sensors: Sequence[str], rul: str = RUL) -> DataFrame:
    """What ``rul_correlation`` gives for the facts of these cells; a constant sensor has no correlation and no line."""
    total = merged(cells.filter(F.col("column").isin(list(sensors))), [])
    n, sx, sy, sxx, syy, sxy = (F.col(p) for p in PAIRED)
    around = F.element_at(F.create_map(*[x for c in sensors for x in (F.lit(c), F.lit(float(offsets[c])))]), F.col("column"))
    known = F.nullif(n, F.lit(0))
    moved = total.select("*", (sxx - sx * sx / known).alias("vx"), (syy - sy * sy / known).alias("vy"), (sxy - sx * sy / known).alias("c"),
                         (sx / known + around).alias("mx"), (sy / known + offsets[rul]).alias("my"))
    spread = lambda v: F.when(F.col(v) > 0, F.col(v))
    slope = F.col("c") / spread("vx")
    return moved.select(
        F.col("column").alias("sensor"), "n", (F.col("c") / F.sqrt(spread("vx") * spread("vy"))).alias("correlation"),
        slope.alias("slope"), (F.col("my") - slope * F.col("mx")).alias("intercept"))
