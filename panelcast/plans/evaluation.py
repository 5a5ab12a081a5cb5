"""Rolling validation and final evaluation as DataFrame queries.

Scores come from any scorer that yields ``up_prob`` per row: the linear
coefficient tables of ``operators.scoring`` (SQL-checkable) or a fitted
Spark ML model (``plans.models``).  Everything after the scores - threshold
sweep, stable picks, configuration choice, fold results, final threshold,
error analysis - is the same code.

Tuning is per fold over the whole panel (every series contributes its own
fold rows); with a single series it reduces to the one-series case.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import snap_to_grid
from panelcast.operators import metrics as M
from panelcast.operators.consistency import combine_rows, one_row_struct
from panelcast.operators import selection as S
from panelcast.operators import thresholds as T
from panelcast.operators.errors import error_cases, error_summary
from panelcast.operators.scaling import scale_rows, scale_stored_rows
from panelcast.operators.scoring import FIXTURE_SCORERS, LinearScorer, predict_class, score_chosen, score_rows
from panelcast.operators.splits import FOLD, SPLIT, FoldSpec, fold_membership, require_folds, split_by_time, warmup_cut
from panelcast.schema import DATE, DEFAULT_FEATURES, SEQUENCE_LENGTH, SERIES
from panelcast.session import materialize


@dataclass(frozen=True)
class EvalSpec:
    features: list[str] = field(default_factory=lambda: list(DEFAULT_FEATURES))
    seq_len: int = SEQUENCE_LENGTH
    folds: FoldSpec = FoldSpec()
    tune: T.TuneOptions = T.TuneOptions()
    scaler_scope: str = "series"


def eval_frame(training: DataFrame, spec: EvalSpec = EvalSpec()) -> DataFrame:
    """Training frame after the sequence warm-up cut, with positions."""
    return warmup_cut(training, spec.seq_len)


def rolling_scaled(frame: DataFrame, spec: EvalSpec = EvalSpec()) -> DataFrame:
    """Fold rows, scaled; ``frame`` is read twice and should be stored."""
    return _scaled(frame, spec, lambda rows: fold_membership(rows, spec.folds), [FOLD])


def _scaled(frame: DataFrame, spec: EvalSpec, tag: Callable[[DataFrame], DataFrame], by: list[str]) -> DataFrame:
    if spec.scaler_scope == "series":
        return scale_stored_rows(frame, spec.features, tag, by)
    return scale_rows(tag(frame), spec.features, spec.scaler_scope, by=by)


def rolling_predictions(
    frame: DataFrame,
    spec: EvalSpec = EvalSpec(),
    scorers: list[LinearScorer] | None = None,
    splits: tuple[str, ...] | None = None,
) -> DataFrame:
    """``series_id, fold_id, split, bar_date, config_idx, y_true, logit, up_prob``.

    ``splits`` limits scoring to some parts (tuning reads only ``val`` and
    ``test``); the filter comes after scaling, which needs the train rows.
    """
    scaled = rolling_scaled(frame, spec)
    if splits is not None:
        scaled = scaled.where(F.col(SPLIT).isin(*splits))
    return score_rows(scaled, spec.features, scorers or FIXTURE_SCORERS, keep=[SERIES, FOLD, SPLIT, DATE])


def config_candidates(preds: DataFrame, spec: EvalSpec = EvalSpec()) -> DataFrame:
    """Per (fold, config): the stable best validation threshold and its score/F1."""
    val = preds.where(F.col(SPLIT) == "val")
    best = T.tune_threshold(val, [FOLD, "config_idx"], spec.tune)
    return best.select(
        FOLD,
        "config_idx",
        F.col("threshold").alias("best_threshold"),
        F.col("score").alias("val_score_best"),
        F.col("f1").alias("val_f1_best"),
        F.col("goal").alias("threshold_goal"),
    )


def fold_choice(candidates: DataFrame, spec: EvalSpec = EvalSpec()) -> DataFrame:
    return S.pick_config_per_fold(candidates, [FOLD], spec.tune)


def fold_results(
    preds: DataFrame, choice: DataFrame, spec: EvalSpec = EvalSpec(), sizes_from: DataFrame | None = None
) -> DataFrame:
    """Per fold: chosen config, its validation threshold, and test metrics at that threshold.

    Split sizes and dates come from ``sizes_from`` (the folded rows) or, when
    every row was scored, from the predictions of config 0.
    """
    # One row per fold: bounded by the fold count, safe to broadcast.
    chosen = F.broadcast(choice.select(FOLD, "config_idx", "best_threshold", "val_score_best", "val_f1_best"))
    test = preds.where(F.col(SPLIT) == "test").join(chosen, on=[FOLD, "config_idx"], how="inner")
    rates = M.classification_metrics(test, [FOLD], "best_threshold")
    auc = M.roc_auc(test, [FOLD])
    rows = sizes_from if sizes_from is not None else preds.where(F.col("config_idx") == F.lit(0))
    sizes = rows.groupBy(FOLD).agg(
        *[F.sum(F.when(F.col(SPLIT) == s, 1).otherwise(0)).cast("long").alias(f"{s}_rows") for s in ("train", "val", "test")],
        F.min(F.when(F.col(SPLIT) == "train", F.col(DATE))).alias("train_start_date"),
        F.max(F.when(F.col(SPLIT) == "train", F.col(DATE))).alias("train_end_date"),
        F.max(F.when(F.col(SPLIT) == "val", F.col(DATE))).alias("val_end_date"),
        F.max(F.when(F.col(SPLIT) == "test", F.col(DATE))).alias("test_end_date"),
    )
    return (
        choice.select(FOLD, "config_idx", "best_threshold", "val_score_best", "val_f1_best")
        .join(rates.select(FOLD, F.col("accuracy").alias("test_accuracy"), F.col("f1").alias("test_f1"),
                           F.col("precision").alias("test_precision"), F.col("recall").alias("test_recall")), on=FOLD)
        .join(auc.select(FOLD, F.col("roc_auc").alias("test_roc_auc")), on=FOLD)
        .join(sizes, on=FOLD)
    )


def final_predictions(
    frame: DataFrame,
    best_cfg: DataFrame,
    spec: EvalSpec = EvalSpec(),
    scorers: list[LinearScorer] | None = None,
) -> DataFrame:
    """Time split (train/val/test), scaler from train, scores of the chosen config."""
    parts = (spec.folds.train_ratio, spec.folds.val_ratio, spec.folds.test_ratio)
    scaled = _scaled(frame, spec, lambda rows: split_by_time(rows, *parts), [])
    # best_cfg has one row: its config is a scalar subquery that picks the
    # coefficient table per row (no join, no scoring of the other configs).
    # Tuning and metrics read only validation and test rows.  The result feeds
    # both, so it is materialised once.
    scaled = scaled.where(F.col(SPLIT).isin("val", "test"))
    chosen = best_cfg.select("config_idx").scalar()
    # No config above -1 leaves the subquery empty: fail with the cause, lazily.
    choice = F.when(chosen.isNull(), F.raise_error(F.lit("config choice: no candidate (every score is at or below -1)"))).otherwise(chosen)
    scored = score_chosen(scaled, spec.features, scorers or FIXTURE_SCORERS, choice, keep=[SERIES, SPLIT, DATE])
    return materialize(scored)


def final_threshold_row(final_preds: DataFrame, fold_res: DataFrame, spec: EvalSpec = EvalSpec()) -> DataFrame:
    """One row: validation-tuned threshold, rolling median, and the snapped final threshold."""
    g = spec.tune.grid
    val = T.tune_threshold(final_preds.where(F.col(SPLIT) == "val"), [], spec.tune)
    rolling = T.final_threshold(fold_res, [], spec.tune)
    row = combine_rows(
        val.select(F.col("threshold").alias("val_best_threshold"), F.col("score").alias("val_score_best"),
                   F.col("f1").alias("val_f1_at_best")),
        rolling.select(F.col("final_threshold").alias("rolling_threshold_median")),
    )
    if spec.tune.final_mode == "val":
        thr = snap_to_grid(F.col("val_best_threshold"), g.lo, g.hi, g.step)
        source = "val_best"
    else:
        thr = snap_to_grid(F.col("rolling_threshold_median"), g.lo, g.hi, g.step)
        source = "rolling_median"
    # One row, read by every consumer of the final run: stored, not planned again in each.
    return materialize(row.withColumns({"threshold": thr, "threshold_source": F.lit(source)}))


def final_test_predictions(final_preds: DataFrame, thr_row: DataFrame) -> DataFrame:
    """Test rows with ``y_pred`` at the final (snapped) threshold."""
    test = combine_with_row(final_preds.where(F.col(SPLIT) == "test"), thr_row.select("threshold"))
    return test.withColumn("y_pred", predict_class(F.col("up_prob"), F.col("threshold")))


def final_metrics(test_preds: DataFrame, beta: float) -> DataFrame:
    """Test metrics at the final threshold; ``fbeta`` is that of the tuning goal.

    Everything but the AUC comes from one aggregate over the test rows.
    """
    gap = F.col("up_prob") - F.col("y_true").cast("double")
    more = (F.avg(gap * gap).alias("brier_score"), F.count(F.lit(1)).alias("sample_count"), F.max("threshold").alias("threshold"))
    rates = M.with_rates(M.confusion(test_preds, [], "threshold", more=more), beta)
    auc = M.roc_auc(test_preds.withColumn("_g", F.lit(0)), ["_g"]).drop("_g", "positives", "negatives")
    return combine_rows(rates, auc)


def final_record(metrics: DataFrame, thr_row: DataFrame, spec: EvalSpec = EvalSpec(), calibration: str = "none") -> DataFrame:
    """Final metrics with how the threshold was found: goal, grid, tolerances, floors, penalties, source."""
    tune, grid = spec.tune, spec.tune.grid
    settings = {
        "threshold_goal": tune.goal, "threshold_beta": tune.effective_beta, "grid_lo": grid.lo, "grid_hi": grid.hi, "grid_step": grid.step,
        "threshold_eps": tune.thr_eps, "threshold_anchor": tune.anchor, "config_eps": tune.cfg_eps, "min_precision": tune.min_precision,
        "min_recall": tune.min_recall, "floor_penalty": tune.penalty, "config_std_penalty": tune.cfg_std_pen,
        "config_threshold_penalty": tune.cfg_thr_pen, "final_mode": tune.final_mode, "calibration": calibration,
    }
    both = combine_rows(metrics, thr_row.select("val_best_threshold", "rolling_threshold_median", "threshold_source"))
    return both.withColumns({name: F.lit(value) for name, value in settings.items()})


def final_errors(test_preds: DataFrame) -> tuple[DataFrame, DataFrame]:
    cases = error_cases(test_preds, "threshold")
    return cases, error_summary(cases, [], threshold_col="threshold")


def combine_with_row(rows: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row table to every row as scalar-subquery values (no join)."""
    return rows.withColumn("_ctx", one_row_struct(one_row)).select(
        *[F.col(c) for c in rows.columns], *[F.col(f"_ctx.{c}").alias(c) for c in one_row.columns]
    )


def tuning_inputs(
    training: DataFrame, spec: EvalSpec = EvalSpec(), scorers: list[LinearScorer] | None = None, buckets: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The cut frame and the validation/test predictions every tuning step reads.

    The frame is stored bucketed on the series key, so fold scaling and the
    final split's windows reuse that partitioning instead of shuffling again;
    only validation and test rows are scored, since tuning reads nothing else.
    """
    frame = materialize(eval_frame(training, spec), bucket_by=[SERIES], buckets=buckets)
    # One folder: writing one for each split would sort all scores by split, which costs more than the filter of a reader.
    preds = materialize(rolling_predictions(frame, spec, scorers, splits=("val", "test")))
    return frame, require_folds(preds)


@dataclass
class RollingRun:
    frame: DataFrame
    preds: DataFrame
    candidates: DataFrame
    choice: DataFrame
    folds: DataFrame
    stability: DataFrame
    best: DataFrame


def rolling_run(
    training: DataFrame, spec: EvalSpec = EvalSpec(), scorers: list[LinearScorer] | None = None, buckets: int | None = None
) -> RollingRun:
    """Folds -> scores -> per-fold tuning -> fold results -> config stability.

    The cut frame and the prediction table are each read by several
    branches, so both are materialised once.
    """
    frame, preds = tuning_inputs(training, spec, scorers, buckets)
    # Small (folds x configs rows) but built from the whole prediction table and
    # read by the choice, the stability score and the final threshold.
    cands = materialize(config_candidates(preds, spec))
    choice = materialize(fold_choice(cands, spec))  # one row per fold, read twice
    folds = materialize(fold_results(preds, choice, spec, sizes_from=fold_membership(frame, spec.folds)))
    stab = S.config_stability(cands, spec.tune)
    best = S.best_config(stab)
    return RollingRun(frame, preds, cands, choice, folds, stab, best)
