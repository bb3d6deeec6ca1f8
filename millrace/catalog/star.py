"""Star schema and dashboard queries over facts whose RUL is the exact label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import tables as t
from millrace.catalog.registry import query
from millrace.operators.rolling import feature_names
from millrace.plans import dashboard, gold

M = t.EVENT_METRICS
FEATURES = [*M, *feature_names(M, t.WINDOWS)]
ENGINE_KEY = t.key_sql("sensor_id", "unit_number", "engine_model")
DATE_KEY = "CAST(strftime(w, '%Y%m%d%H%M') AS BIGINT)"


def _plain(spark: SparkSession, d: str) -> DataFrame:
    """Scored rows without the rolling features, for what does not show them. The prediction is the label and a
    number of cycles that differs by unit, so that engines end in different states."""
    spread = F.col("unit_number") % 7 * 11
    return t.labelled(spark, d).withColumn("predicted_rul", (F.col("RUL") + spread).cast("double"))


def _star(spark: SparkSession, d: str) -> DataFrame:
    rows = _plain(spark, d)
    fact = gold.fact_engine_health(rows, M)
    return dashboard.star_join(fact, gold.dim_engine(rows), gold.dim_date(rows), gold.dim_status(spark))


STAR = f"""{t.wide_sql()}, scored AS (
  SELECT *, CAST(w AS VARCHAR) AS timestamp_str,
         CAST(max(time_in_cycles) OVER (PARTITION BY unit_number) - time_in_cycles + unit_number % 7 * 11 AS DOUBLE) AS predicted_rul
  FROM wide),
star AS (
  SELECT *, {t.band_sql('predicted_rul')} AS status_id,
         CASE WHEN predicted_rul <= 15 THEN 'Critique' WHEN predicted_rul <= 45 THEN 'Avertissement'
              ELSE 'Sain' END AS status_label
  FROM scored),
latest AS (
  SELECT * FROM star
  QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY timestamp_str DESC, time_in_cycles DESC) = 1)"""


@query("dim_engine", oracle=f"""
WITH {t.wide_sql()}
SELECT DISTINCT sensor_id, unit_number, engine_model, {ENGINE_KEY} AS engine_id FROM wide""")
def dim_engine(spark: SparkSession, d: str) -> DataFrame:
    return gold.dim_engine(t.training_rows(spark, d))


@query("dim_date", oracle=f"""
WITH {t.wide_sql('minute')}
SELECT DISTINCT CAST(w AS VARCHAR) AS timestamp_str, CAST(w AS VARCHAR) AS timestamp, {DATE_KEY} AS date_id,
       CAST(year(w) AS INTEGER) AS year, CAST(month(w) AS INTEGER) AS month, CAST(day(w) AS INTEGER) AS day,
       CAST(hour(w) AS INTEGER) AS hour, CAST(minute(w) AS INTEGER) AS minute
FROM wide""")
def dim_date(spark: SparkSession, d: str) -> DataFrame:
    dates = gold.dim_date(t.wide(spark, d, "1 minute"))
    return dates.withColumn("timestamp", F.col("timestamp").cast("string"))


@query("dim_status", oracle=f"""
WITH {STAR}
SELECT d.status_id, d.status_label, d.description, count(status.status_id) AS facts
FROM (VALUES
  (1, 'Critique', 'RUL <= 15 cycles (Nécessite une maintenance immédiate)'),
  (2, 'Avertissement', '15 < RUL <= 45 cycles (Planifier une maintenance)'),
  (3, 'Sain', 'RUL > 45 cycles (Fonctionnement nominal)')) AS d(status_id, status_label, description)
LEFT JOIN (SELECT status_id FROM star) AS status ON d.status_id = status.status_id
GROUP BY 1, 2, 3""")
def dim_status(spark: SparkSession, d: str) -> DataFrame:
    """The literal rows, with how many facts each band holds."""
    facts = gold.fact_engine_health(_plain(spark, d), []).groupBy("status_id").agg(F.count(F.lit(1)).alias("facts"))
    joined = gold.dim_status(spark).join(facts, "status_id", "left")
    return joined.withColumn("facts", F.coalesce("facts", F.lit(0)))


@query("fact_engine_health", oracle=f"""
WITH {t.scored_sql()}, keyed AS (
  SELECT *, {ENGINE_KEY} AS engine_id, {DATE_KEY} AS date_id, {t.band_sql('predicted_rul')} AS status_id FROM scored)
SELECT engine_id, date_id, status_id, time_in_cycles, predicted_rul, {t.rounded_sql(M)}, {t.rounded_features_sql(M)},
       {t.wide_key_sql('engine_id', 'date_id', 'time_in_cycles')} AS fact_id FROM keyed""")
def fact_engine_health(spark: SparkSession, d: str) -> DataFrame:
    return t.rounded(t.rounded_features(gold.fact_engine_health(t.scored(spark, d), FEATURES), M), M)


@query("fact_from_stored_dimensions", oracle=f"""
WITH {STAR}
SELECT {ENGINE_KEY} AS engine_id, {DATE_KEY} AS date_id, status_id, time_in_cycles, predicted_rul,
       {t.rounded_sql(M)}, {t.wide_key_sql(ENGINE_KEY, DATE_KEY, 'time_in_cycles')} AS fact_id FROM star""")
def fact_from_stored_dimensions(spark: SparkSession, d: str) -> DataFrame:
    rows = _plain(spark, d)
    fact = gold.fact_engine_health(rows, M, gold.dim_engine(rows), gold.dim_date(rows))
    return t.rounded(fact, M)


@query("star_join", oracle=f"""
WITH {STAR}
SELECT sensor_id, unit_number, engine_model, timestamp_str, CAST(year(w) AS INTEGER) AS year, time_in_cycles,
       predicted_rul, status_label FROM star""")
def star_join(spark: SparkSession, d: str) -> DataFrame:
    return _star(spark, d).select("sensor_id", "unit_number", "engine_model", "timestamp_str", "year",
                                  "time_in_cycles", "predicted_rul", "status_label")


@query("bi_rul_over_time", oracle=f"""
WITH {STAR} SELECT sensor_id, timestamp_str, time_in_cycles, predicted_rul FROM star""")
def rul_over_time(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.rul_over_time(_star(spark, d))


@query("bi_status_counts", oracle=f"""
WITH {STAR} SELECT status_id, status_label, count(*) AS engines FROM latest GROUP BY 1, 2""")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.status_counts(_star(spark, d))


@query("bi_status_mix", oracle=f"""
WITH {STAR} SELECT status_label, year(w)::INTEGER AS year, month(w)::INTEGER AS month, day(w)::INTEGER AS day,
  count(*) AS facts FROM star GROUP BY ALL""")
def status_mix(spark: SparkSession, d: str) -> DataFrame:
    """Health states per day over the whole fleet."""
    return _star(spark, d).groupBy("status_label", "year", "month", "day").agg(F.count(F.lit(1)).alias("facts"))


@query("bi_latest_sensors", oracle=f"""
WITH {STAR} SELECT sensor_id, timestamp_str, {t.rounded_sql(M)} FROM latest""")
def latest_sensors(spark: SparkSession, d: str) -> DataFrame:
    return t.rounded(dashboard.latest_sensors(_star(spark, d), M), M)


@query("bi_metric_trend", oracle=f"""
WITH {STAR} SELECT CAST(date_trunc('day', w) AS VARCHAR) AS bucket,
  {', '.join(f'round(avg({c}), 9) AS {c}' for c in [*M, 'predicted_rul'])} FROM star GROUP BY 1""")
def metric_trend(spark: SparkSession, d: str) -> DataFrame:
    columns = [*M, "predicted_rul"]
    trend = dashboard.metric_trend(_star(spark, d), columns)
    return t.rounded(trend, columns)


CORRELATION = " UNION ALL ".join(
    f"""SELECT '{m}' AS sensor, count({m}) AS n, round(corr(predicted_rul, {m}), 6) AS correlation,
  round(regr_slope(predicted_rul, {m}), 6) AS slope, round(regr_intercept(predicted_rul, {m}), 6) AS intercept
  FROM star"""
    for m in M
)


@query("bi_rul_correlation", oracle=f"WITH {STAR} {CORRELATION}")
def rul_correlation(spark: SparkSession, d: str) -> DataFrame:
    fact = gold.fact_engine_health(_plain(spark, d), M)
    return t.rounded(dashboard.rul_correlation(fact, M), ["correlation", "slope", "intercept"], 6)


EXPECTED_SIGNS = {"error": -1, "purchase": 1, "view": 1}


@query("bi_corr_sign", oracle=f"""
WITH {STAR}, c AS ({CORRELATION}),
signs AS (SELECT sensor, CAST(sign(correlation) AS INTEGER) AS found_sign,
  CASE sensor WHEN 'error' THEN -1 WHEN 'purchase' THEN 1 WHEN 'view' THEN 1 END AS expected_sign FROM c)
SELECT sensor, found_sign, expected_sign, found_sign = expected_sign AS as_expected FROM signs
WHERE expected_sign IS NOT NULL""")
def corr_sign(spark: SparkSession, d: str) -> DataFrame:
    fact = gold.fact_engine_health(_plain(spark, d), M)
    return dashboard.correlation_signs(dashboard.rul_correlation(fact, M), EXPECTED_SIGNS)


@query("bi_slicer", oracle=f"""
WITH {STAR} SELECT sensor_id, timestamp_str, status_label, predicted_rul FROM star
WHERE sensor_id IN ('unit_1', 'unit_2', 'unit_3') AND status_label IN ('Sain', 'Avertissement')
  AND timestamp_str BETWEEN '2024-01-05 00:00:00' AND '2024-01-28 23:00:00'""")
def slicer(spark: SparkSession, d: str) -> DataFrame:
    chosen = dashboard.sliced(_star(spark, d), ["unit_1", "unit_2", "unit_3"], "2024-01-05 00:00:00",
                              "2024-01-28 23:00:00", ["Sain", "Avertissement"])
    return chosen.select("sensor_id", "timestamp_str", "status_label", "predicted_rul")
