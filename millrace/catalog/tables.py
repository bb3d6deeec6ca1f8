"""The test tables seen as telemetry, in Spark and in SQL.

``events`` stands in for sensor readings: the user is the unit, the event type the metric and the
hours since the first day the cycle. ``lineitem`` is the longer series: the supplier is the unit,
its lines in shipping order are the cycles, and the four amounts are sensors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.ml.model import with_unit_number
from millrace.operators import baselines as B
from millrace.operators import cleaning, labels, reshape
from millrace.operators.rolling import rolling_features

EVENT_METRICS = ["click", "error", "purchase", "signup", "view"]
LINE_SENSORS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# every column: lines that tie in all of them are interchangeable
LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
WINDOWS = (5, 10, 15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    hours = F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)")
    return events.select(
        C.sensor_id_of("user_id").alias("sensor_id"),
        C.engine_model_of("user_id").alias("engine_model"),
        (hours + 1).cast("int").alias("time_in_cycles"),
        F.col("event_type").alias("metric"),
        "value",
        F.col("ts").cast("string").alias("event_time"),
    )


def wide(spark: SparkSession, sf_dir: str, window: str = "1 hour") -> DataFrame:
    """Silver rows before imputation, with ``window_start`` and ``date``."""
    pivoted = reshape.pivot_metrics(cleaning.timed(readings(spark, sf_dir)), EVENT_METRICS, window)
    return reshape.with_window_keys(pivoted)


def training_rows(spark: SparkSession, sf_dir: str, window: str = "1 hour") -> DataFrame:
    """Wide rows with ``unit_number``, as the training table has them."""
    return with_unit_number(wide(spark, sf_dir, window))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.with_rul(training_rows(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows with the label in the place of a prediction, so that results are exact."""
    rows = rolling_features(
        labelled(spark, sf_dir), "unit_number", ["time_in_cycles", "window_start"], EVENT_METRICS, WINDOWS
    )
    return rows.withColumn("predicted_rul", F.col("RUL").cast("double")).drop("RUL")


def event_baselines(spark: SparkSession, sf_dir: str, window: str = "1 hour") -> DataFrame:
    return B.compute_baselines(training_rows(spark, sf_dir, window), EVENT_METRICS)


# Two engines add numbers in different orders, so results are compared rounded: far above the
# noise, and at a digit where means of few two-digit values cannot end in a lone 5.
DIGITS = 9
FEATURE_DIGITS = {"mean": 7, "std": 7}
PRICE_DIGITS = {"mean": 5, "std": 3}  # prices are a thousand times larger


def rounded(df: DataFrame, columns: list[str], digits: int = DIGITS) -> DataFrame:
    names = set(columns)
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


def feature_digits(sensor: str, stat: str) -> int:
    return (PRICE_DIGITS if sensor == "l_extendedprice" else FEATURE_DIGITS)[stat]


def rounded_features(df: DataFrame, sensors: list[str]) -> DataFrame:
    """Rounds whichever rolling features the frame has."""
    digits = {
        f"{s}_{stat}_{w}": feature_digits(s, stat) for w in WINDOWS for stat in ("mean", "std") for s in sensors
    }
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


# --- the same in SQL ------------------------------------------------------------------------

MODEL_SQL = (
    "CASE {unit} % 5 WHEN 0 THEN 'Turbofan-CFM56' WHEN 1 THEN 'Turbofan-GE90' "
    "WHEN 2 THEN 'Turbofan-PW4000' WHEN 3 THEN 'Turbofan-Trent800' ELSE 'Turbofan-V2500' END"
)

READINGS_SQL = f"""readings AS (
  SELECT 'unit_' || user_id AS sensor_id,
         {MODEL_SQL.format(unit='user_id')} AS engine_model,
         CAST(date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', ts) + 1 AS INTEGER) AS time_in_cycles,
         event_type AS metric, value, CAST(ts AS VARCHAR) AS event_time, ts AS event_timestamp,
         CAST(user_id AS INTEGER) AS unit_number
  FROM events)"""


def wide_sql(bucket: str = "hour") -> str:
    """CTEs ``readings`` and ``wide``."""
    means = ", ".join(f"avg(value) FILTER (WHERE metric = '{m}') AS {m}" for m in EVENT_METRICS)
    return f"""{READINGS_SQL},
wide AS (
  SELECT sensor_id, engine_model, time_in_cycles, unit_number,
         date_trunc('{bucket}', event_timestamp) AS w, {means}
  FROM readings GROUP BY 1, 2, 3, 4, 5)"""


def rolling_sql(sensors: list[str], unit: str, order: str, round_them: bool = True) -> str:
    """Select-list of the rolling features."""
    parts = []
    for n in WINDOWS:
        frame = f"OVER (PARTITION BY {unit} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for stat, name in (("avg({})", "mean"), ("stddev_samp({})", "std")):
            for s in sensors:
                value = f"{stat.format(s)} {frame}"
                if name == "std":
                    value = f"coalesce({value}, 0)"
                if round_them:
                    value = f"round({value}, {feature_digits(s, name)})"
                parts.append(f"{value} AS {s}_{name}_{n}")
    return ", ".join(parts)


def scored_sql() -> str:
    """CTEs up to ``scored``: wide rows, features unrounded, label as prediction."""
    return f"""{wide_sql()},
scored AS (
  SELECT sensor_id, engine_model, time_in_cycles, unit_number, CAST(w AS VARCHAR) AS window_start, w,
         {', '.join(EVENT_METRICS)},
         {rolling_sql(EVENT_METRICS, 'unit_number', 'time_in_cycles, w', False)},
         CAST(max(time_in_cycles) OVER (PARTITION BY unit_number) - time_in_cycles AS DOUBLE) AS predicted_rul
  FROM wide)"""


def key_sql(*parts: str) -> str:
    return f"CAST(('0x' || substr({wide_key_sql(*parts)}, 1, 15)) AS BIGINT)"


def wide_key_sql(*parts: str) -> str:
    marked = [f"coalesce(length(CAST({p} AS VARCHAR)) || ':' || CAST({p} AS VARCHAR), 'n')" for p in parts]
    return f"md5({' || '.join(marked)})"


def band_sql(rul: str) -> str:
    return f"CASE WHEN {rul} <= 15 THEN 1 WHEN {rul} <= 45 THEN 2 WHEN {rul} IS NOT NULL THEN 3 END"


def rounded_sql(columns: list[str], digits: int = DIGITS) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def rounded_features_sql(sensors: list[str]) -> str:
    return ", ".join(
        f"round({s}_{stat}_{w}, {feature_digits(s, stat)}) AS {s}_{stat}_{w}"
        for w in WINDOWS for stat in ("mean", "std") for s in sensors
    )
