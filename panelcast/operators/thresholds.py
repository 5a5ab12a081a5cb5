"""Threshold sweep, floor-penalised score, stable pick, final threshold.

The sweep evaluates every grid threshold for every group in one pass: each
score is mapped to the number of grid points at or below it, rows are
counted per (group, bucket) with map-side combine, and each bucket row is
expanded over the grid (at most ``(grid+1) * grid`` rows per group, whatever
the row count).  A grid threshold ``t_k`` predicts 1 exactly for the buckets
above ``k``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import snap_to_grid
from panelcast.functions.grid import Grid
from panelcast.functions.columns import safe_ratio
from panelcast.operators.metrics import fbeta

# Threshold goals and their beta.
GOAL_BETA = {"f0.5": 0.5, "f1": 1.0, "f2": 2.0}


@dataclass(frozen=True)
class TuneOptions:
    # The reference's default tuning options (goal f0.5, grid
    # 0.30..0.70 step 0.01, threshold band 0.01, anchor 0.50, config band 0.001,
    # precision floor 0.56, recall floor 0.62, floor penalty 1.2, final
    # threshold from validation, config std penalty 0.20, threshold std penalty 0.12).
    goal: str = "f0.5"
    beta: float = 1.0
    grid: Grid = Grid()
    thr_eps: float = 0.01
    anchor: float = 0.50
    cfg_eps: float = 0.001
    min_precision: float = 0.56
    min_recall: float = 0.62
    penalty: float = 1.2
    final_mode: str = "val"
    cfg_std_pen: float = 0.20
    cfg_thr_pen: float = 0.12

    def __post_init__(self) -> None:
        goal = self.goal.strip().lower()
        if goal not in GOAL_BETA and goal != "fbeta":
            raise ValueError("goal must be one of f0.5, f1, f2, fbeta")
        if self.thr_eps < 0.0 or self.cfg_eps < 0.0:
            raise ValueError("eps values must be >= 0")
        if not (0.0 < self.anchor < 1.0) or not (self.grid.lo <= self.anchor <= self.grid.hi):
            raise ValueError("anchor must lie inside the threshold range")
        if not (0.0 <= self.min_precision <= 1.0 and 0.0 <= self.min_recall <= 1.0):
            raise ValueError("precision and recall floors must be in [0, 1]")
        if self.penalty < 0.0 or self.cfg_std_pen < 0.0 or self.cfg_thr_pen < 0.0:
            raise ValueError("penalties must be >= 0")
        if self.final_mode not in ("val", "rolling_median"):
            raise ValueError("final_mode must be 'val' or 'rolling_median'")

    @property
    def effective_beta(self) -> float:
        goal = self.goal.strip().lower()
        return float(self.beta) if goal == "fbeta" else GOAL_BETA[goal]


def penalised_score(base: Column, precision: Column, recall: Column, opts: TuneOptions) -> Column:
    """base - pen*(minP - P)+ - pen*(minR - R)+ (penalties summed first)."""
    pen_p = F.when(precision < F.lit(opts.min_precision), F.lit(opts.penalty) * (F.lit(opts.min_precision) - precision)).otherwise(F.lit(0.0))
    pen_r = F.when(recall < F.lit(opts.min_recall), F.lit(opts.penalty) * (F.lit(opts.min_recall) - recall)).otherwise(F.lit(0.0))
    return base - (pen_p + pen_r)


def threshold_sweep(
    preds: DataFrame,
    by: list[str],
    opts: TuneOptions = TuneOptions(),
    prob_col: str = "up_prob",
    label_col: str = "y_true",
) -> DataFrame:
    """One row per (group, grid point): counts, precision, recall, f1, fbeta, score."""
    grid = opts.grid
    n = grid.size
    y = F.col(label_col).cast("long")
    hist = preds.groupBy(*by, grid.count_at_or_below(F.col(prob_col)).alias("_c")).agg(
        F.sum(y).alias("_pos"), F.sum(F.lit(1) - y).alias("_neg")
    )
    expanded = hist.select(*by, "_c", "_pos", "_neg", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k"))
    above = F.col("_c") > F.col("k")
    counts = expanded.groupBy(*by, "k").agg(
        F.sum(F.when(above, F.col("_pos")).otherwise(F.lit(0))).alias("tp"),
        F.sum(F.when(above, F.col("_neg")).otherwise(F.lit(0))).alias("fp"),
        F.sum("_pos").alias("_p"),
        F.sum("_neg").alias("_n"),
    )
    tp, fp = F.col("tp"), F.col("fp")
    pos = F.col("_p")
    precision = safe_ratio(tp, tp + fp)
    recall = safe_ratio(tp, pos)
    f1 = fbeta(tp, fp, pos, 1.0)
    fb = fbeta(tp, fp, pos, opts.effective_beta)
    thr = grid.point(F.col("k"))
    out = counts.select(
        *by,
        F.col("k").cast("int").alias("k"),
        thr.alias("threshold_raw"),
        F.round(thr, 2).alias("threshold"),
        tp.cast("long").alias("tp"),
        fp.cast("long").alias("fp"),
        (pos - tp).cast("long").alias("fn"),
        (F.col("_n") - fp).cast("long").alias("tn"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        fb.alias("fbeta"),
    )
    return out.withColumn("score", penalised_score(F.col("fbeta"), F.col("precision"), F.col("recall"), opts))


def stable_pick(
    candidates: DataFrame,
    by: list[str],
    score_col: str,
    thr_col: str,
    f1_col: str,
    order_col: str,
    eps: float,
    anchor: float,
) -> DataFrame:
    """Per group: keep rows with score >= best - eps, then take the smallest
    |threshold - anchor|, then the highest score, then the highest f1, then the
    first in ``order_col`` order."""
    grp = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    band = candidates.withColumn("_top", F.max(score_col).over(grp)).where(
        F.col(score_col) >= F.col("_top") - F.lit(float(eps))
    )
    order = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    order = order.orderBy(
        F.abs(F.col(thr_col) - F.lit(float(anchor))).asc(),
        F.col(score_col).desc(),
        F.col(f1_col).desc(),
        F.col(order_col).asc(),
    )
    return band.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") == 1).drop("_rn", "_top")


def tune_threshold(preds: DataFrame, by: list[str], opts: TuneOptions = TuneOptions(), **kw) -> DataFrame:
    """Best grid threshold per group: ``threshold`` (2 places), ``score``, ``f1``."""
    sweep = threshold_sweep(preds, by, opts, **kw)
    best = stable_pick(sweep, by, "score", "threshold", "f1", "k", opts.thr_eps, opts.anchor)
    return best.select(*by, "threshold", "score", "f1", "precision", "recall", F.lit(opts.goal).alias("goal"))


def median_of(values: Column) -> Column:
    """Median of a sorted, bounded array (mean of the two middle values when even)."""
    n = F.size(values)
    mid = F.floor(n / 2).cast("int")
    odd = F.element_at(values, mid + 1)
    even = (F.element_at(values, mid) + F.element_at(values, mid + 1)) / F.lit(2.0)
    return F.when(n == 0, F.lit(None)).when(n % 2 == 1, odd).otherwise(even)


def final_threshold(
    fold_rows: DataFrame, by: list[str], opts: TuneOptions = TuneOptions(), thr_col: str = "best_threshold"
) -> DataFrame:
    """Median of the per-fold thresholds, snapped to the grid; the snapped anchor
    when there are none.  The list collected per group is bounded by the fold count."""
    grouped = fold_rows.groupBy(*by) if by else fold_rows.groupBy()
    agg = grouped.agg(F.array_sort(F.collect_list(F.col(thr_col).cast("double"))).alias("_thr"))
    med = median_of(F.col("_thr"))
    g = opts.grid
    anchor = snap_to_grid(F.lit(opts.anchor), g.lo, g.hi, g.step)
    return agg.select(
        *by,
        med.alias("median_threshold"),
        F.coalesce(snap_to_grid(med, g.lo, g.hi, g.step), anchor).alias("final_threshold"),
        F.size("_thr").alias("folds"),
    )
