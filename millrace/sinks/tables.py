"""Table writes: partitioned layout, keyed upsert, JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.cleaning import newest_per_key
from millrace.session import remove_scratch, scratch_path
from millrace.sources.files import read_table


def write_partitioned(df: DataFrame, path: str, partition: str = "date", mode: str = "append",
                      extra: Sequence[str] = ()) -> None:
    """Hive-style layout. The rebalance hint gathers each partition's rows for few files, while
    adaptive execution still splits a partition value that holds much of the data."""
    columns = [partition, *extra]
    df.hint("rebalance", *[F.col(c) for c in columns]).write.mode(mode).partitionBy(*columns).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition: str = "date", extra: Sequence[str] = ()) -> None:
    """Overwrites only the partitions that ``df`` has rows for."""
    columns = [partition, *extra]
    (
        df.hint("rebalance", *[F.col(c) for c in columns])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def drop_partitions(spark: SparkSession, path: str, partition: str, values: Sequence[str]) -> None:
    """Removes whole partitions of a table."""
    for value in values:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition}={value}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


MAX_TOUCHED = 100_000  # partitions of one upsert: days are bounded by the calendar


def partition_values(df: DataFrame, partition: str) -> list:
    """The distinct values of ``partition`` in ``df``, null among them if it occurs."""
    rows = df.select(partition).distinct().limit(MAX_TOUCHED + 1).collect()
    if len(rows) > MAX_TOUCHED:
        raise ValueError(f"{partition} has more than {MAX_TOUCHED} values; partition by something bounded, such as days")
    return [r[0] for r in rows]


def in_partitions(df: DataFrame, partition: str, values: Sequence) -> DataFrame:
    """Rows of the given partitions. The values are literals, so the scan reads no other partition."""
    chosen = F.col(partition).isin([v for v in values if v is not None])
    return df.filter(chosen | F.col(partition).isNull() if None in values else chosen)


def merge(existing: DataFrame | None, changes: DataFrame, keys: Sequence[str], order: Sequence[str],
          partition: str = "date") -> DataFrame:
    """New content of the partitions that ``changes`` touches: per key the newest row of both.

    Only touched partitions of ``existing`` are read, the null partition like any other.
    ``order`` goes first by the precombine column, then by whatever settles its ties.
    """
    if existing is None:
        return newest_per_key(changes, keys, order)
    touched = partition_values(changes, partition)
    current = in_partitions(existing, partition, touched).select(*changes.columns)
    return newest_per_key(current.unionByName(changes), keys, order)


def upsert(changes: DataFrame, path: str, keys: Sequence[str], order: Sequence[str],
           partition: str = "date") -> None:
    """Keyed upsert into a partitioned table; running it again with the same rows changes nothing.

    The changes are computed once, into a staged table, and so are the merged rows. The
    replacement then reads those files and never the partitions it overwrites, so a lost executor
    cannot leave it without input; both staged copies are removed after the replacement. One
    writer at a time; readers see each partition replaced at commit.
    """
    spark = changes.sparkSession
    incoming, staged = scratch_path(spark, "changes"), scratch_path(spark, "merged")
    overwrite(changes, incoming)
    overwrite(merge(read_table(spark, path), spark.read.parquet(incoming), keys, order, partition), staged)
    replace_partitions(spark.read.parquet(staged), path, partition)
    remove_scratch(spark, incoming, staged)


def jdbc_options(table: str, order_by: str) -> dict[str, str]:
    """Options that let a column-store database cluster the table by one column."""
    return {"dbtable": table, "createTableOptions": f"ENGINE=MergeTree() ORDER BY {order_by}"}


def write_jdbc(df: DataFrame, url: str, table: str, order_by: str | None, properties: dict[str, str],
               mode: str = "overwrite") -> None:
    """Full refresh (or append) of a database table from all tasks."""
    writer = df.write.mode(mode).format("jdbc").option("url", url).options(**properties)
    options = jdbc_options(table, order_by) if order_by else {"dbtable": table}
    writer.options(**options).save()


def write_star_table(df: DataFrame, path: str, order_by: str) -> None:
    """Parquet form of the refresh: every file holds a range of the clustering column, in order, so that files
    and row groups prune."""
    df.repartitionByRange(order_by).sortWithinPartitions(order_by).write.mode("overwrite").parquet(path)
