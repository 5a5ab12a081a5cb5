"""Configuration choice: per fold (stable pick) and across folds (stability score)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.thresholds import TuneOptions, stable_pick


def pick_config_per_fold(config_rows: DataFrame, by: list[str], opts: TuneOptions = TuneOptions()) -> DataFrame:
    """Per fold: configs within ``cfg_eps`` of the best validation score, then the
    threshold nearest the anchor, score, f1, config order."""
    return stable_pick(
        config_rows, by, "val_score_best", "best_threshold", "val_f1_best", "config_idx", opts.cfg_eps, opts.anchor
    )


def config_stability(config_rows: DataFrame, opts: TuneOptions = TuneOptions(), key: str = "config_idx") -> DataFrame:
    """Per config across folds: mean and population std of the validation score,
    population std of the chosen threshold, and
    ``stability = mean - std_pen * std_score - thr_pen * std_threshold``."""
    agg = config_rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("folds"),
        F.avg("val_score_best").alias("mean_score"),
        F.stddev_pop("val_score_best").alias("std_score"),
        F.stddev_pop("best_threshold").alias("std_threshold"),
    )
    stab = F.col("mean_score") - F.lit(opts.cfg_std_pen) * F.col("std_score") - F.lit(opts.cfg_thr_pen) * F.col("std_threshold")
    return agg.withColumn("stability", stab)


def best_config(stability: DataFrame, key: str = "config_idx") -> DataFrame:
    """Arg-max of ``stability`` above -1 (strict), the first config winning ties.

    Empty when no config scores above -1; ``require_row`` turns that into an error.
    """
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("stability").desc(), F.col(key).asc())
    return (
        stability.where(F.col("stability") > -1.0)
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .drop("_rn")
    )


def require_row(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise RuntimeError(f"{what}: no candidate (every score is at or below -1)")
