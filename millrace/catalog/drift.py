"""Drift between two halves of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog import tables as t
from millrace.catalog.registry import query
from millrace.operators import drift
from millrace.session import scratch_path
from millrace.sinks.tables import overwrite, write_partitioned
from millrace.sources.files import read_table

FEATURES = ["unit_number", "time_in_cycles", *t.EVENT_METRICS]
LINE_FEATURES = ["l_suppkey", *t.LINE_SENSORS]

# p-value series shared by all statements
P_SQL = """CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0,
  list_sum([(CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * lam * lam) FOR k IN range(1, 101)])
  )) END"""


def tests_sql(source: str, features: list[str]) -> str:
    """CTE ``tests`` over a relation with the features and a boolean ``is_ref``."""
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value, is_ref FROM {source}" for f in features
    )
    return f"""long AS (SELECT * FROM ({long}) WHERE value IS NOT NULL),
counts AS (SELECT feature, value, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS c
           FROM long GROUP BY 1, 2),
cum AS (SELECT feature, sum(r) OVER w AS cr, sum(c) OVER w AS cc,
               sum(r) OVER (PARTITION BY feature) AS nr, sum(c) OVER (PARTITION BY feature) AS nc
        FROM counts WINDOW w AS (PARTITION BY feature ORDER BY value)),
ks AS (SELECT feature, CAST(max(nr) AS BIGINT) AS n_ref, CAST(max(nc) AS BIGINT) AS n_cur,
              max(abs(cr::DOUBLE / nr - cc::DOUBLE / nc)) AS d
       FROM cum WHERE nr > 0 AND nc > 0 GROUP BY 1),
lams AS (SELECT *, d * sqrt(n_ref::DOUBLE * n_cur / (n_ref::DOUBLE + n_cur)) AS lam FROM ks),
tests AS (SELECT feature, n_ref, n_cur, d, {P_SQL} AS p_value FROM lams)"""


EVENTS = f"""{t.wide_sql()}, sides AS (SELECT *, w < TIMESTAMP '2024-01-16' AS is_ref FROM wide),
{tests_sql('sides', FEATURES)}"""


def _halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = t.training_rows(spark, d).select(*FEATURES, "date")
    return rows.filter("date < '2024-01-16'"), rows.filter("date >= '2024-01-16'")


@query("ks_two_sample", oracle=f"""
WITH {EVENTS} SELECT feature, n_ref, n_cur, round(d, 6) AS d, round(p_value, 6) AS p_value FROM tests""")
def ks_two_sample(spark: SparkSession, d: str) -> DataFrame:
    return t.rounded(drift.ks_two_sample(*_halves(spark, d), FEATURES), ["d", "p_value"], 6)


LINES = f"""sides AS (SELECT *, l_shipdate < TIMESTAMP '1998-06-01' AS is_ref FROM lineitem),
{tests_sql('sides', LINE_FEATURES)}"""
LINES_SQL = f"WITH {LINES} SELECT feature, n_ref, n_cur, round(d, 6) AS d, round(p_value, 6) AS p_value FROM tests"


def _line_halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lines = t.table(spark, d, "lineitem")
    early = F.col("l_shipdate") < F.lit("1998-06-01").cast("timestamp_ntz")
    return lines.filter(early).select(*LINE_FEATURES), lines.filter(~early).select(*LINE_FEATURES)


@query("ks_lineitem", oracle=LINES_SQL)
def ks_lineitem(spark: SparkSession, d: str) -> DataFrame:
    return t.rounded(drift.ks_two_sample(*_line_halves(spark, d), LINE_FEATURES), ["d", "p_value"], 6)


@query("ks_split_features", oracle=LINES_SQL)
def ks_split_features(spark: SparkSession, d: str) -> DataFrame:
    """The same with every feature sorted in segments of about 1,000 values."""
    tests = drift.ks_two_sample(*_line_halves(spark, d), LINE_FEATURES, hot_rows=1000)
    return t.rounded(tests, ["d", "p_value"], 6)


@query("drift_flags", oracle=f"WITH {EVENTS} SELECT feature, p_value < 0.05 AS drifted FROM tests")
def drift_flags(spark: SparkSession, d: str) -> DataFrame:
    flags = drift.drift_flags(drift.ks_two_sample(*_halves(spark, d), FEATURES))
    return flags.select("feature", "drifted")


@query("drift_report", oracle=f"""
WITH {EVENTS}, n AS (SELECT count(*) FILTER (WHERE p_value < 0.05) AS number_of_drifted_columns, count(*) AS n_tested FROM tests)
SELECT number_of_drifted_columns / {len(FEATURES)}.0 >= 0.20 AS dataset_drift,
       round(CAST(number_of_drifted_columns AS DOUBLE) / {len(FEATURES)}, 6) AS share_of_drifted_columns,
       number_of_drifted_columns, n_tested FROM n""")
def drift_report(spark: SparkSession, d: str) -> DataFrame:
    fact, _ = drift.drift_report(*_halves(spark, d), FEATURES)
    return t.rounded(fact.drop("date_id"), ["share_of_drifted_columns"], 6)


RANGE = ("2024-01-18", "2024-01-24")


@query("drift_over_range", oracle=f"""
WITH {t.wide_sql()}, sides AS (SELECT *, w < TIMESTAMP '2024-01-16' AS is_ref FROM wide
  WHERE w < TIMESTAMP '2024-01-16' OR CAST(w AS DATE) BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'),
{tests_sql('sides', FEATURES)}
SELECT feature, n_ref, n_cur, round(d, 6) AS d, round(p_value, 6) AS p_value FROM tests""")
def drift_over_range(spark: SparkSession, d: str) -> DataFrame:
    """Value counts are stored once per day; a range of days is tested from those and the reference's counts alone."""
    counts, reference = scratch_path(spark, "day-counts"), scratch_path(spark, "reference-counts")
    ref, cur = _halves(spark, d)
    write_partitioned(drift.value_counts(cur, FEATURES, ["date"]), counts)
    overwrite(drift.value_counts(ref, FEATURES), reference)
    tests = drift.ks_of_counts(spark.read.parquet(reference), read_table(spark, counts, RANGE))
    return t.rounded(tests, ["d", "p_value"], 6)
