"""Messages of unknown shape to readings: metrics are discovered from the payload, not from a list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.files import CORRUPT

#: what names a reading; every other key of a wide message is a metric
IDENTITY = (("sensor_id", "string"), ("engine_model", "string"), ("time_in_cycles", "int"), ("event_time", "string"))
METRIC, VALUE, NESTED = "metric", "value", "metrics"
NO_JSON, NO_OBJECT, NO_READINGS, NO_VALUE, NO_NUMBER = "no json", "no object", "no readings", "no value", "no number"
_ENTRIES = "array<struct<key: string, value: variant>>"


def _kind(v: Column) -> Column:
    """The outer type of a variant, such as OBJECT, ARRAY or STRING."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _entries(v: Column) -> Column:
    return F.map_entries(F.try_variant_get(v, "$", "map<string, variant>")).cast(_ENTRIES)


def _metrics(message: Column) -> Column:
    """The (metric, value) pairs of a message in any of its shapes.

    Long: one metric under ``metric`` and ``value``. Nested: an object under ``metrics``. Wide: every key that is no identity.
    """
    named = F.try_variant_get(message, f"$.{METRIC}", "string")
    value = F.try_variant_get(message, f"$.{VALUE}", "variant")
    nested = F.try_variant_get(message, f"$.{NESTED}", "variant")
    wide = F.filter(_entries(message), lambda e: ~e["key"].isin([name for name, _ in IDENTITY]))
    return (
        F.when(named.isNotNull() & value.isNotNull(), F.array(F.struct(named.alias("key"), value.alias("value"))).cast(_ENTRIES))
        .when(_kind(nested) == "OBJECT", _entries(nested))
        .otherwise(wide)
    )


def unpivot_payloads(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(readings, quarantined entries) of JSON texts, each an object or an array of objects. Batches and streams.

    Every entry of every message is a row of one side or the other: readings have the identity columns, ``metric`` and
    ``value``; quarantined rows have the text in question, the metric if there is one, and ``reason``. Numbers sent as text
    are numbers; words, booleans, lists and objects in the place of a number are not, so a metric whose type drifts shows up in
    quarantine instead of becoming null. A message without any metric is quarantined whole.
    """
    parsed = lines.select(F.col(column).cast("string").alias("_text"), F.try_parse_json(F.col(column).cast("string")).alias("_v"))
    several = F.when(_kind(F.col("_v")) == "ARRAY", F.try_variant_get("_v", "$", "array<variant>")).otherwise(F.array("_v"))
    messages = parsed.select("_text", F.explode_outer(several).alias("_m"))
    is_object = _kind(F.col("_m")) == "OBJECT"
    entries = messages.select("_text", "_m", is_object.alias("_object"), F.explode_outer(F.when(is_object, _metrics(F.col("_m")))).alias("_e"))
    item = F.col("_e.value")
    number = F.when(_kind(item).isin("BIGINT", "DOUBLE", "FLOAT", "DECIMAL", "STRING"), F.try_variant_get(item, "$", "double"))
    reason = (
        F.when(F.col("_m").isNull(), NO_JSON)
        .when(~F.col("_object"), NO_OBJECT)
        .when(F.col("_e").isNull(), NO_READINGS)
        .when(F.is_variant_null(item), NO_VALUE)
        .when(F.col("_number").isNull(), NO_NUMBER)
    )
    judged = entries.withColumn("_number", number).withColumn("_reason", reason)
    identity = [F.try_variant_get("_m", f"$.{name}", kind).alias(name) for name, kind in IDENTITY]
    readings = judged.filter("_reason IS NULL").select(*identity, F.col("_e.key").alias("metric"), F.col("_number").alias("value"))
    text = F.coalesce(F.to_json(item), F.when(F.col("_m").isNotNull(), F.to_json("_m")), F.col("_text"))
    quarantined = judged.filter("_reason IS NOT NULL").select(
        F.col("_reason").alias("reason"), F.try_variant_get("_m", "$.sensor_id", "string").alias("sensor_id"),
        F.col("_e.key").alias("metric"), text.alias(CORRUPT))
    return readings.select("sensor_id", "engine_model", "time_in_cycles", "metric", "value", "event_time"), quarantined
