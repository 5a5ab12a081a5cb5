"""Scalar column expressions (all JVM-side, all inside whole-stage codegen).

Every helper returns a ``Column``; nothing here touches data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-9  # fixed value: the guard added to every denominator of a price-structure ratio


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_nan(c: str | Column) -> Column:
    """NaN becomes NULL: comparisons with NaN are TRUE in Spark, never let one in."""
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def to_double(c: str | Column, source_type: str | None = None) -> Column:
    """Numeric coercion (unparseable text becomes NULL, NaN becomes NULL)."""
    c = col_(c)
    if source_type is None or source_type == "string":
        c = (F.trim(c.cast("string")) if source_type == "string" else c).try_cast("double")
    else:
        c = c.cast("double")
    return null_if_nan(c)


# Accepted textual date forms, and the times that may follow a date.
DATE_PATTERNS = ["yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd"]
TIME_PATTERNS = ["yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]", "yyyy/MM/dd HH:mm:ss"]


def parse_date(c: str | Column, source_type: str | None = None) -> Column:
    """Date parse with coercion; unknown forms give NULL (the row is then dropped).

    DATE and TIMESTAMP inputs are cast; integers such as 20210104 are read as
    text in the compact form, never as epoch offsets.  Text must match a date,
    or a date and a time, from its first to its last character.
    """
    c = col_(c)
    if source_type in ("date",):
        return c
    if source_type in ("timestamp", "timestamp_ntz"):
        return c.cast("date")
    text = F.trim(c.cast("string"))
    dates = [F.try_to_date(text, p) for p in DATE_PATTERNS]
    return F.coalesce(*dates, *[F.try_to_timestamp(text, F.lit(p)).cast("date") for p in TIME_PATTERNS])


def ratio_gap(num: Column, den: Column) -> Column:
    """(num) / (|den| + 1e-9): the reference's guarded ratio."""
    return num / (F.abs(den) + F.lit(EPS))


def zero_safe_return(cur: Column, base: Column) -> Column:
    """cur / NULLIF(base, 0) - 1; a zero or NULL base gives NULL (never +-inf)."""
    return cur / F.nullif(base, F.lit(0.0)) - F.lit(1.0)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def standardise(x: Column, mean: Column, scale: Column) -> Column:
    """(x - mean) / scale, with a zero scale replaced by 1."""
    return (x - mean) / F.when(scale == 0, F.lit(1.0)).otherwise(scale)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, 0.0 when den is 0 (the metric convention for undefined ratios)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def snap_to_grid(thr: Column, lo: float, hi: float, step: float) -> Column:
    """Clip to [lo, hi], round the offset to a whole step (half to even), clip, round to 2 places."""
    clipped = F.least(F.greatest(thr, F.lit(lo)), F.lit(hi))
    offset = F.bround((clipped - F.lit(lo)) / F.lit(step), 0)
    snapped = F.lit(lo) + offset * F.lit(step)
    snapped = F.least(F.greatest(snapped, F.lit(lo)), F.lit(hi))
    # greatest/least skip NULLs: keep a missing threshold missing.
    return F.when(thr.isNotNull(), F.round(snapped, 2))
