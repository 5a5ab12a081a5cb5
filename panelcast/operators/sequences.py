"""Fixed-length sequences of consecutive feature rows.

A window ending at row t holds rows ``t-L+1 .. t`` of one series (and one
split, so a window never crosses a split boundary) and carries the label of
row t.  Built with a bounded ``ROWS`` frame: each output row needs only the
previous L-1 rows of its own partition, whatever the panel size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.schema import DATE, LABEL, SEQUENCE_LENGTH, SERIES


def build_sequences(
    frame: DataFrame,
    features: list[str],
    seq_len: int = SEQUENCE_LENGTH,
    label_col: str = LABEL,
    within: list[str] | None = None,
) -> DataFrame:
    """One row per window end: ``series_id, [within...], end_date, x ARRAY<ARRAY<FLOAT>>, y FLOAT``.

    ``x[i]`` is the feature vector of the i-th row of the window (oldest first),
    cast to FLOAT at this boundary only.  Series (or splits) shorter than L
    give no rows; L <= 0 raises.
    """
    if seq_len <= 0:
        raise ValueError("sequence_length must be positive")
    keys = [SERIES, *(within or [])]
    w = Window.partitionBy(*keys).orderBy(DATE).rowsBetween(-(seq_len - 1), Window.currentRow)
    vec = F.array(*[F.col(c).cast("float") for c in features])
    out = frame.select(
        *keys,
        F.col(DATE).alias("end_date"),
        F.collect_list(vec).over(w).alias("x"),
        F.col(label_col).cast("float").alias("y"),
    )
    return out.where(F.size("x") == seq_len)


def explode_sequences(seqs: DataFrame, features: list[str], within: list[str] | None = None) -> DataFrame:
    """Flat form of ``build_sequences``: one row per (window, step), step 0 = oldest."""
    keys = [SERIES, *(within or [])]
    flat = seqs.select(*keys, "end_date", "y", F.posexplode("x").alias("step", "v"))
    return flat.select(
        *keys,
        "end_date",
        "step",
        *[F.col("v")[i].alias(c) for i, c in enumerate(features)],
        "y",
    )


def latest_window(
    frame: DataFrame, features: list[str], seq_len: int = SEQUENCE_LENGTH
) -> DataFrame:
    """The last L rows of every series as one model input (oldest first).

    Series shorter than L give no row.  The collected list is bounded by L.
    """
    if seq_len <= 0:
        raise ValueError("sequence_length must be positive")
    w = Window.partitionBy(SERIES).orderBy(F.col(DATE).desc())
    recent = frame.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= seq_len)
    grouped = recent.groupBy(SERIES).agg(
        F.array_sort(F.collect_list(F.struct(DATE, *features))).alias("rows"),
        F.max(DATE).alias("last_date"),
    )
    return grouped.where(F.size("rows") == seq_len)


def explode_latest(windows: DataFrame, features: list[str]) -> DataFrame:
    flat = windows.select(SERIES, "last_date", F.posexplode("rows").alias("step", "r"))
    return flat.select(SERIES, "last_date", "step", F.col(f"r.{DATE}").alias(DATE), *[F.col(f"r.{c}").alias(c) for c in features])
