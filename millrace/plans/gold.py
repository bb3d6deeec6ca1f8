"""Scored Silver rows to the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace import config
from millrace.functions import columns as C
from millrace.ml import model as M
from millrace.ml.runs import load_latest_model
from millrace.operators import labels
from millrace.operators.clustering import clustered
from millrace.operators.rolling import feature_names
from millrace.session import remove_scratch, scratch_path
from millrace.sinks.tables import drop_partitions, partition_values, replace_partitions, write_star_table
from millrace.sources.files import from_rows, read_table

ENGINE = ("sensor_id", "unit_number", "engine_model")
SERIES_ORDER = ("time_in_cycles", "window_start")
ORDER_BY = {"dim_engine": "engine_id", "dim_date": "date_id", "dim_status": "status_id"}


def dim_engine(scored: DataFrame) -> DataFrame:
    """One row per (sensor, unit, model) with a key over all three."""
    return scored.select(*ENGINE).distinct().withColumn("engine_id", C.surrogate_key(*ENGINE))


def dim_date(scored: DataFrame) -> DataFrame:
    """One row per window start with its parts."""
    at = F.col("timestamp")
    return (
        scored.select(F.col("window_start").alias("timestamp_str"))
        .distinct()
        .withColumn("timestamp", C.event_timestamp("timestamp_str"))
        .select(
            "timestamp_str",
            "timestamp",
            C.date_key("timestamp").alias("date_id"),
            F.year(at).alias("year"),
            F.month(at).alias("month"),
            F.dayofmonth(at).alias("day"),
            F.hour(at).alias("hour"),
            F.minute(at).alias("minute"),
        )
    )


def dim_status(spark: SparkSession) -> DataFrame:
    return from_rows(spark, config.HEALTH_STATUSES, "status_id int, status_label string, description string")


def join_engine(scored: DataFrame, engines: DataFrame) -> DataFrame:
    """Inner join on sensor, unit and model; a missing model matches a missing model."""
    right = engines.select(*[F.col(c).alias(f"_{c}") for c in ENGINE], "engine_id")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ENGINE]
    return scored.join(right, same, "inner").drop(*[f"_{c}" for c in ENGINE])


def join_date(scored: DataFrame, dates: DataFrame) -> DataFrame:
    """Inner join of the window start with the dimension's text."""
    right = dates.select("timestamp_str", "date_id")
    return scored.join(right, scored["window_start"] == right["timestamp_str"], "inner").drop("timestamp_str")


def fact_engine_health(
    scored: DataFrame,
    features: Sequence[str],
    engines: DataFrame | None = None,
    dates: DataFrame | None = None,
) -> DataFrame:
    """One fact per scored row.

    The dimension keys are functions of the row itself, so without given dimensions they are
    computed in place: the same result as joining with the dimensions of the same rows, and no
    shuffle. Pass stored dimensions to keep only rows that those know.
    """
    banded = labels.with_health_band(scored)
    keyed = (
        banded.withColumn("engine_id", C.surrogate_key(*ENGINE))
        if engines is None
        else join_engine(banded, engines)
    )
    placed = (
        keyed.filter("window_start IS NOT NULL").withColumn(
            "date_id", C.date_key(C.event_timestamp("window_start"))
        )
        if dates is None
        else join_date(keyed, dates)
    )
    return placed.select(
        "engine_id", "date_id", "status_id", "time_in_cycles", "predicted_rul", *features,
        C.wide_key("engine_id", "date_id", "time_in_cycles").alias("fact_id"),
    )


def fact_features(metrics: Sequence[str]) -> list[str]:
    return [*metrics, *feature_names(metrics)]


def score_silver(silver: DataFrame, model: PipelineModel, metrics: Sequence[str] = config.METRICS,
                 hot_rows: int | None = None) -> DataFrame:
    """Features and predictions for every Silver row; order ties go by window."""
    rows = M.with_unit_number(silver.withColumn("engine_model", C.or_default_model("engine_model")))
    features = M.feature_rows(rows, metrics, SERIES_ORDER, hot_rows=hot_rows, series="sensor_id")
    return M.score(model, features, metrics)


REACH = max(config.ROLLING_WINDOWS) - 1
AS_OF = "as_of"
KEPT_TAILS = 32  # days whose tails are kept, for runs that go back


def last_rows(silver: DataFrame, n: int = REACH) -> DataFrame:
    """The last ``n`` rows of every sensor. The filter on the rank keeps as many in each task before the shuffle."""
    latest = Window.partitionBy("sensor_id").orderBy(*[F.col(c).desc() for c in SERIES_ORDER], F.xxhash64(*silver.columns))
    return silver.withColumn("_rank", F.row_number().over(latest)).filter(F.col("_rank") <= n).drop("_rank")


def with_look_back(silver: DataFrame, dates: tuple[str, str], tails: DataFrame | None = None) -> DataFrame:
    """The rows of the given days and, of every sensor, the rows before them that its frames reach back to.

    With ``tails``, the table that ``store_tail`` writes, the rows up to the last day before these that has a tail come from
    there, and Silver is read from that day on; without one the whole history is searched.
    """
    as_of = None if tails is None else tails.filter(F.col(AS_OF) < dates[0]).agg(F.max(AS_OF)).first()[0]
    earlier = silver.filter(F.col("date") < dates[0])
    if as_of is not None:
        tail = tails.filter(F.col(AS_OF) == as_of).select(*silver.columns)
        earlier = earlier.filter(F.col("date") > as_of).unionByName(tail)
    return silver.filter(F.col("date").between(*dates)).unionByName(last_rows(earlier))


def read_tails(spark: SparkSession, path: str) -> DataFrame | None:
    tails = read_table(spark, path)
    return None if tails is None else tails.withColumn(AS_OF, F.col(AS_OF).cast("string"))


def store_tail(spark: SparkSession, rows: DataFrame, as_of: str, path: str) -> None:
    """Keeps the last rows of every sensor up to the day ``as_of``, out of ``rows`` that reach back far enough.

    Later tails rest on what this run has replaced and go; so do the oldest beyond ``KEPT_TAILS``.
    """
    staged = scratch_path(spark, "tail")
    last_rows(rows).withColumn(AS_OF, F.lit(as_of)).write.parquet(staged)
    replace_partitions(spark.read.parquet(staged), path, AS_OF)
    remove_scratch(spark, staged)
    tails = read_tails(spark, path)
    if tails is not None:
        days = sorted(partition_values(tails, AS_OF))
        drop_partitions(spark, path, AS_OF, [d for d in days if d > as_of] + [d for d in days if d <= as_of][:-KEPT_TAILS])


def run_gold(spark: SparkSession, silver_path: str, runs_path: str, out: str,
             metrics: Sequence[str] = config.METRICS, dates: tuple[str, str] | None = None) -> bool:
    """Refreshes the star tables, all of them or the given days. False while there is no Silver.

    The fact is partitioned by day, and within a day clustered by engine and time; a run over some days replaces those
    days' facts only, with features that look back over earlier rows, and adds to the dimensions, so runs over parts give
    what one run over all gives (for rows in the order of the days). What later days look back to is stored beside the
    star, so such a run reads its own days and that. After a change to earlier days run Gold from there on.
    """
    silver = read_table(spark, silver_path)
    if silver is None:
        return False
    model = load_latest_model(spark, runs_path)
    # scored once, then read by the dimensions and the fact
    scored_path, tails_path = scratch_path(spark, "scored"), f"{out}/silver_tail"
    chosen = silver if dates is None else with_look_back(silver, dates, read_tails(spark, tails_path))
    scored = score_silver(chosen, model, metrics)
    (scored if dates is None else scored.filter(F.col("date").between(*dates))).write.parquet(scored_path)
    last_day = silver.agg(F.max("date")).first()[0] if dates is None else dates[1]
    if last_day is not None:
        store_tail(spark, chosen, last_day, tails_path)
    scored = spark.read.parquet(scored_path)
    tables = {"dim_engine": dim_engine(scored), "dim_date": dim_date(scored), "dim_status": dim_status(spark)}
    for name, table in tables.items():
        known = read_table(spark, f"{out}/{name}") if dates is not None else None
        staged = scratch_path(spark, name)
        (table if known is None else known.select(*table.columns).unionByName(table).distinct()).write.parquet(staged)
        write_star_table(spark.read.parquet(staged), f"{out}/{name}", ORDER_BY[name])
        remove_scratch(spark, staged)
    day = F.to_date(F.substring(F.col("date_id").cast("string"), 1, 8), "yyyyMMdd").cast("string")
    fact = fact_engine_health(scored, fact_features(metrics)).withColumn("date", day)
    (
        clustered(fact, ["engine_id", "date_id"], within=["date"]).write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if dates is None else "dynamic")
        .partitionBy("date").parquet(f"{out}/fact_engine_health")
    )
    remove_scratch(spark, scored_path)
    return True
