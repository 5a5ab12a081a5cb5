"""Standardisation fitted on training rows only.

mean and population standard deviation per feature over the ``train`` rows
of each group; a zero deviation is replaced by 1.  The same statistics are
applied to every split of the group (and kept for a train+val refit).

Two scopes:

* ``series`` - statistics per (series, fold): computed with a window over
  ``PARTITION BY series_id, fold_id``.  The input is already hash
  partitioned on ``series_id`` by the feature windows, which satisfies that
  clustering, so no Exchange and no join are added.
* ``panel`` - statistics per fold over all series: a grouped aggregate whose
  result has one row per fold (bounded by the fold count), broadcast back.

``scale_stored_rows`` gives the rows of the ``series`` scope from a stored frame:
it reads the frame twice, and rows of folds go through no window.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import standardise
from panelcast.operators.splits import FOLD, SPLIT
from panelcast.schema import DATE, SERIES


def _keys(scope: str, by: list[str]) -> list[str]:
    if scope == "series":
        return [SERIES, *by]
    if scope == "panel":
        return list(by)
    raise ValueError("scope must be 'series' or 'panel'")


def fit_scaler(rows: DataFrame, features: list[str], scope: str = "series", by: list[str] | None = None) -> DataFrame:
    """Scaler table in long form: ``[series_id,] fold_id, feature, mean, scale``."""
    keys = _keys(scope, list(by if by is not None else [FOLD]))
    train = rows.where(F.col(SPLIT) == "train")
    aggs = []
    for f in features:
        aggs += [F.avg(f).alias(f"{f}__mean"), F.stddev_pop(f).alias(f"{f}__std")]
    wide = train.groupBy(*keys).agg(*aggs)
    stacked = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(f).alias("feature"),
                    F.col(f"{f}__mean").alias("mean"),
                    F.when(F.col(f"{f}__std") == 0, F.lit(1.0)).otherwise(F.col(f"{f}__std")).alias("scale"),
                )
                for f in features
            ]
        )
    )
    return wide.select(*keys, stacked.alias("s")).select(*keys, "s.feature", "s.mean", "s.scale")


def scale_rows(
    rows: DataFrame, features: list[str], scope: str = "series", by: list[str] | None = None
) -> DataFrame:
    """Replace each feature by its standardised value, statistics from ``train`` rows of the group."""
    keys = _keys(scope, list(by if by is not None else [FOLD]))
    is_train = F.col(SPLIT) == "train"
    if scope == "series":
        # Ordered whole-partition frame when rows carry a date: the sums run in
        # date order, so the statistics (and every score after them) are the
        # same on every run.
        w = Window.partitionBy(*keys)
        if DATE in rows.columns:
            w = w.orderBy(DATE).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        # Named first: an expression that reads a deviation twice would have the window take it twice.
        stats = {}
        for f in features:
            x = F.when(is_train, F.col(f))
            stats |= {f"{f}__mean": F.avg(x).over(w), f"{f}__std": F.stddev_pop(x).over(w)}
        known = rows.withColumns(stats)
        return known.withColumns({f: standardise(F.col(f), F.col(f"{f}__mean"), F.col(f"{f}__std")) for f in features}).drop(*stats)
    stats = rows.where(is_train).groupBy(*keys).agg(
        *[F.avg(f).alias(f"{f}__mean") for f in features],
        *[F.stddev_pop(f).alias(f"{f}__std") for f in features],
    )
    # One row per fold: the size is bounded by the fold count, not by the data.
    joined = rows.join(F.broadcast(stats), on=keys, how="inner")
    return joined.withColumns(
        {f: standardise(F.col(f), F.col(f"{f}__mean"), F.col(f"{f}__std")) for f in features}
    ).drop(*[f"{f}__mean" for f in features], *[f"{f}__std" for f in features])


def scale_stored_rows(frame: DataFrame, features: list[str], tag: Callable[[DataFrame], DataFrame], by: list[str] | None = None) -> DataFrame:
    """``scale_rows(tag(frame), ...)`` per series for a stored frame with dates, the same to the last bit.

    ``tag`` gives each row its split (and ``by``).  The statistics come from an
    aggregate over the training rows in order of date and are joined as one row
    per series, so that rows in buckets by series are neither shuffled nor held in
    a window, and only the rows of ``frame``, not those of folds, are sorted.
    ``frame`` is read twice.
    """
    by = list(by if by is not None else [FOLD])
    keys = _keys("series", by)
    rows = tag(frame)
    # The place of a row has a series meet in one task, in order of date.
    place = F.row_number().over(Window.partitionBy(SERIES).orderBy(DATE))
    in_order = frame.withColumn("_place", place).where(F.col("_place") > 0).drop("_place")
    train = tag(in_order).where(F.col(SPLIT) == "train")
    names = [f"{f}__{s}" for f in features for s in ("mean", "std")]
    wide = train.groupBy(*keys).agg(*[agg(f).alias(f"{f}__{s}") for f in features for s, agg in (("mean", F.avg), ("std", F.stddev_pop))])
    own = F.struct(*names)
    if by:
        stats = wide.groupBy(SERIES).agg(F.map_from_entries(F.collect_list(F.struct(F.struct(*by), own))).alias("_of_series"))
    else:
        stats = wide.select(SERIES, own.alias("_of_series"))
    # A join finds nothing for a NULL, which is a series too.
    unnamed = stats.where(F.col(SERIES).isNull()).select("_of_series").scalar()
    joined = rows.join(stats.hint("shuffle_hash"), SERIES, "left")
    found = F.when(F.col(SERIES).isNull(), unnamed).otherwise(F.col("_of_series"))
    joined = joined.withColumn("_own", found[F.struct(*by)] if by else found)
    return joined.select(
        *[standardise(F.col(c), F.col(f"_own.{c}__mean"), F.col(f"_own.{c}__std")).alias(c) if c in features else F.col(c) for c in rows.columns]
    )


def apply_scaler(rows: DataFrame, scaler: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """Apply a stored long-form scaler table (e.g. reloaded from Parquet).

    The table is pivoted to one row per key with a fixed column list; it is
    joined without a forced broadcast because a per-series scaler grows with
    the panel (AQE broadcasts it at runtime when it is small).  With a series
    and further keys (folds) the statistics of a series are joined as one map
    by these keys: rows stay in their partitioning by series.
    """
    stats = [f"{f}__{s}" for f in features for s in ("mean", "scale")]
    wide = scaler.groupBy(*keys).agg(
        *[F.max(F.when(F.col("feature") == f, F.col(s))).alias(f"{f}__{s}") for f in features for s in ("mean", "scale")]
    )
    more = [k for k in keys if k != SERIES]
    if SERIES in keys and more:
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in more])
        one = F.struct(F.struct(*more), F.struct(*stats))
        of_series = wide.where(known).groupBy(SERIES).agg(F.map_from_entries(F.collect_list(one)).alias("_scalers"))
        joined = rows.join(of_series, on=SERIES, how="inner").withColumn("_own", F.col("_scalers")[F.struct(*more)])
        joined = joined.where(F.col("_own").isNotNull()).select(*keys, *[c for c in rows.columns if c not in keys], *[F.col(f"_own.{c}").alias(c) for c in stats])
    else:
        joined = rows.join(wide, on=keys, how="inner")
    return joined.withColumns(
        {f: standardise(F.col(f), F.col(f"{f}__mean"), F.col(f"{f}__scale")) for f in features}
    ).drop(*stats)
