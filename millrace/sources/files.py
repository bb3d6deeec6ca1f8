"""Readers. Every schema is explicit except where a table brings its own."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import config
from millrace.operators.indexing import number_in_place

READING_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("engine_model", T.StringType()),
        T.StructField("time_in_cycles", T.IntegerType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("event_time", T.StringType()),
    ]
)
CORRUPT = "_corrupt_record"


def training_schema(metrics: Sequence[str] = config.METRICS, rul: bool = True) -> T.StructType:
    fields = [T.StructField("unit_number", T.IntegerType()), T.StructField("time_in_cycles", T.IntegerType())]
    fields += [T.StructField(m, T.DoubleType()) for m in metrics]
    if rul:
        fields.append(T.StructField("RUL", T.DoubleType()))
    return T.StructType([*fields, T.StructField("engine_model", T.StringType())])


def parse_payloads(lines: DataFrame, schema: T.StructType = READING_SCHEMA, column: str = "value",
                   ) -> tuple[DataFrame, DataFrame]:
    """JSON texts to (readings, quarantined texts). Works on batches and on streams."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = lines.select(
        F.col(column).alias("_text"),
        F.from_json(
            column, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        ).alias("_r"),
    )
    broken = F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()
    return (
        parsed.filter(~broken).select(*[F.col(f"_r.{name}") for name in schema.names]),
        parsed.filter(broken).select(F.col("_text").alias(CORRUPT)),
    )


def read_readings(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """JSON-lines files to (readings, quarantined lines)."""
    return parse_payloads(spark.read.text(path))


def _read_csv(spark: SparkSession, path: str, sep: str, schema: T.StructType) -> DataFrame:
    """Columns by the names in the header, whatever their order; others are ignored and a missing one is an error.
    A value that is no number becomes null.

    Files of a folder may have headers of their own: each is read by its own header, and one that lacks a column raises when
    it is read. Text that is a number or a date comes back in its usual form there, without leading zeros.
    """
    lines = spark.read.csv(path, sep=sep, header=True)
    missing = [name for name in schema.names if name not in lines.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    if len(lines.inputFiles()) < 2:
        return lines.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])
    rows = spark.read.option("singleVariantColumn", "_row").csv(path, sep=sep, header=True).select("_row", "_metadata.file_path")

    def value(f: T.StructField) -> Column:
        place = f"$['{f.name}']"
        absent = F.try_variant_get("_row", place, "variant").isNull()
        error = F.raise_error(F.concat(F.col("file_path"), F.lit(f" has no column {f.name}")))
        return F.when(absent, error.cast(f.dataType)).otherwise(F.try_variant_get("_row", place, f.dataType.simpleString())).alias(f.name)

    return rows.select(*[value(f) for f in schema])


def read_training_csv(spark: SparkSession, path: str, metrics: Sequence[str] = config.METRICS,
                      sep: str = ";") -> DataFrame:
    return _read_csv(spark, path, sep, training_schema(metrics))


def read_test_csv(spark: SparkSession, path: str, metrics: Sequence[str] = config.METRICS,
                  sep: str = ",") -> DataFrame:
    return _read_csv(spark, path, sep, training_schema(metrics, rul=False))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """``(row_index, rul)`` of a headerless file. Lines have an order within one file only."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    values = lines.select(F.trim("value").cast("double").alias("rul"))
    return number_in_place(values).select("row_index", "rul")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def read_table(spark: SparkSession, path: str, dates: tuple[str, str] | None = None) -> DataFrame | None:
    """The table at ``path``, or None while it does not exist; other errors are raised.

    ``dates`` (first, last) prunes the ``date`` partitions.
    """
    try:
        table = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if "date" in table.columns:
        # discovery types the partition values as dates; they were written as text
        table = table.withColumn("date", F.col("date").cast("string"))
        if dates:
            table = table.filter(F.col("date").between(*dates))
    return table


def from_rows(spark: SparkSession, rows: Iterable[Row | tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
