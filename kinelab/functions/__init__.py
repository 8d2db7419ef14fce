"""Scalar column expressions (all built-in, JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinelab import config as C


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL, so Spark aggregates skip it like pandas does (Q8)."""
    c = _c(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def energy(x="x", y="y", z="z") -> Column:
    """x^2 + y^2 + z^2."""
    x, y, z = _c(x), _c(y), _c(z)
    return x * x + y * y + z * z


def magnitude(e="energy") -> Column:
    """sqrt(energy)."""
    return F.sqrt(_c(e))


def ms_to_seconds(c) -> Column:
    """epoch milliseconds -> seconds (double)."""
    return _c(c) / F.lit(1000.0)


def window_start(time_ms, size_s: int = C.WINDOW_SECONDS) -> Column:
    """floor of seconds to the window grid, as BIGINT seconds (Q9: floor)."""
    return (F.floor(_c(time_ms) / F.lit(1000.0 * size_s)) * F.lit(size_s)).cast("bigint")


def seconds_to_timestamp(c) -> Column:
    """epoch seconds -> TIMESTAMP."""
    return F.timestamp_seconds(_c(c))


def epoch_ms(ts) -> Column:
    """TIMESTAMP or TIMESTAMP_NTZ (read as UTC) -> epoch milliseconds."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def epoch_s(ts) -> Column:
    """TIMESTAMP -> whole epoch seconds (floor)."""
    return F.floor(F.unix_millis(_c(ts).cast("timestamp")) / F.lit(1000.0)).cast("bigint")


def base_name(path) -> Column:
    """F8: last path segment."""
    return F.element_at(F.split(_c(path), "/"), -1)


def key_from_name(name, pattern: str = C.KEY_PATTERN) -> Column:
    """first capture of the key pattern; '' when absent (search, not full match)."""
    return F.regexp_extract(_c(name), pattern, 1)


def json_field(c, field: str, dtype: str = "double") -> Column:
    """one JSON field as a typed column; NULL where the text is not of that type."""
    return F.get_json_object(_c(c), f"$.{field}").try_cast(dtype)


def bool_text(c) -> Column:
    """boolean -> 'true' / 'false' (NULL stays NULL)."""
    c = _c(c)
    return F.when(c, F.lit("true")).when(~c, F.lit("false"))


def threshold_label(reading, threshold: float = C.LABEL_THRESHOLD,
                    unmatched: str = "null") -> Column:
    """Reading >= threshold.

    ``unmatched="null"`` keeps NULL for windows without a reading;
    ``unmatched="positive"`` reproduces the reference, where a missing
    reading (NaN) compares as true.
    """
    r = _c(reading)
    label = r >= F.lit(threshold)
    if unmatched == "positive":
        return F.when(r.isNull() | F.isnan(r), F.lit(True)).otherwise(label)
    return F.when(F.isnan(r), F.lit(None).cast("boolean")).otherwise(label)


def not_matching(c, pattern: str) -> Column:
    """Anchored negated regex match, like a PromQL ``!~`` matcher."""
    return ~_c(c).rlike(f"^(?:{pattern})$")
