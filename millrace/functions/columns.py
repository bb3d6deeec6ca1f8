"""Scalar column expressions. Everything here is a built-in expression; all but the p-value series stay in codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace import config

UNIT_PREFIX = "unit_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_timestamp(c: Column | str) -> Column:
    """ISO text, with or without microseconds, to a timestamp; null when it cannot be read."""
    return F.try_to_timestamp(_col(c))


def event_date(c: Column | str) -> Column:
    """Day of an ISO text as ``yyyy-MM-dd``; null when it cannot be read."""
    return event_timestamp(c).cast("date").cast("string")


def sensor_id_of(unit_number: Column | str) -> Column:
    return F.concat(F.lit(UNIT_PREFIX), _col(unit_number).cast("string"))


def unit_number_of(sensor_id: Column | str) -> Column:
    """``unit_17`` to 17; null when the rest is not a whole number."""
    return F.regexp_replace(_col(sensor_id), UNIT_PREFIX, "").try_cast("int")


def engine_model_of(unit_number: Column | str, models: Sequence[str] = config.ENGINE_MODELS) -> Column:
    """Model assigned round-robin by unit number."""
    position = F.pmod(_col(unit_number), F.lit(len(models))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(m) for m in models]), position)


def or_default_model(c: Column | str, default: str = config.DEFAULT_ENGINE_MODEL) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def engine_model_code(c: Column | str, models: Sequence[str] = config.ENGINE_MODELS) -> Column:
    """Position of the model in a fixed vocabulary; unseen or missing models share the last code."""
    code = F.lit(len(models))
    for i, model in reversed(list(enumerate(models))):
        code = F.when(_col(c) == model, F.lit(i)).otherwise(code)
    return code.cast("int")


def _nan_to_null(c: Column) -> Column:
    # NaN sorts above every number, so left alone it would pass as a large value.
    return F.when(~F.isnan(c), c)


def health_band(rul: Column | str) -> Column:
    """1 up to 15 cycles, 2 up to 45, 3 above; null for null or NaN."""
    value = _nan_to_null(_col(rul).cast("double"))
    return (
        F.when(value <= config.CRITICAL_RUL, 1)
        .when(value <= config.WARNING_RUL, 2)
        .when(value.isNotNull(), 3)
        .cast("int")
    )


def capped_rul(rul: Column | str, cap: float = config.RUL_CAP) -> Column:
    """``min(rul, cap)``, null kept null (``least`` alone would skip the null)."""
    value = _col(rul)
    return F.when(value.isNotNull(), F.least(value, F.lit(cap).cast("double")))


def whole_number(c: Column | str) -> Column:
    """Truncation toward zero, with null, NaN and out-of-range values as 0."""
    return F.coalesce(_col(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def wide_key(*parts: Column | str) -> Column:
    """128-bit key over the parts, as 32 hex digits. Every part goes in with its length and a null as a mark, so
    that different tuples always give different texts."""
    texts = [_col(p).cast("string") for p in parts]
    marked = [F.coalesce(F.concat(F.char_length(x).cast("string"), F.lit(":"), x), F.lit("n")) for x in texts]
    return F.md5(F.concat(*marked).cast("binary"))


def surrogate_key(*parts: Column | str) -> Column:
    """The first 60 bits of ``wide_key`` as a number, for dimensions of up to some million rows."""
    return F.conv(F.substring(wide_key(*parts), 1, 15), 16, 10).cast("bigint")


def date_key(ts: Column | str) -> Column:
    """Minute of a timestamp as the number yyyyMMddHHmm."""
    return F.date_format(_col(ts), "yyyyMMddHHmm").cast("bigint")


def hash_percent(seed: int, *parts: Column | str) -> Column:
    """0..99 from the parts alone: the same row falls on the same number in every run."""
    text = F.concat_ws("|", F.lit(str(seed)), *[_col(p).cast("string") for p in parts])
    digest = F.md5(text.cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def ks_p_value(d: Column | str, n: Column | str, m: Column | str) -> Column:
    """Asymptotic two-sided p-value of the two-sample Kolmogorov-Smirnov statistic."""
    size_n, size_m = _col(n).cast("double"), _col(m).cast("double")
    lam = _col(d) * F.sqrt(size_n * size_m / (size_n + size_m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    # below 0.2 the alternating series has not converged, while p is 1 to twelve digits
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))
