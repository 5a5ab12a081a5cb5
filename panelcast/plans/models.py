"""Model fitting: rolling perceptron validation, final evaluation, calibration,
a logistic baseline, a sequence classifier and scoring of the latest bar.

One model per fold is fitted on the rows of every series (pooled panel); scaling
stays per series and per fold.  All networks of a step (folds x configurations)
are fitted together by ``operators.perceptron``.  A tuned fit stops on the
validation part; a refit on train and validation runs as many steps as the tuned
fit chose.  With a ``RunStore`` fitted networks are kept under the key of their
rows and options, and later queries read them instead of fitting again.
Everything around the fits (fold rows, scaling, threshold sweep, stable picks,
metrics, error analysis) is the same DataFrame code as for the fixture scorer.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators import isotonic as I
from panelcast.operators import metrics as M
from panelcast.operators import perceptron as P
from panelcast.operators import selection as S
from panelcast.operators.consistency import combine_rows, fold_stability
from panelcast.operators.errors import error_cases, error_summary
from panelcast.operators.scaling import fit_scaler, scale_rows
from panelcast.operators.scoring import predict_class
from panelcast.operators.splits import FOLD, SPLIT, require_folds, split_by_time
from panelcast.plans import evaluation as E
from panelcast.plans.run_store import RunStore, content_key, rows_key
from panelcast.schema import DATE, LABEL, SERIES
from panelcast.session import materialize


@dataclass(frozen=True)
class MlpConfig:
    config_idx: int
    hidden: tuple[int, ...]
    alpha: float

    @property
    def key(self) -> str:
        """Names the configuration in result rows: hidden sizes and penalty."""
        return "-".join(["x".join(map(str, self.hidden)), format(self.alpha, "g")])


# The reference's per-fold configuration grid (hidden sizes, alpha).
MLP_GRID = [
    MlpConfig(0, (64, 32), 1e-3),
    MlpConfig(1, (64, 32), 1e-4),
    MlpConfig(2, (64,), 1e-3),
    MlpConfig(3, (32,), 1e-4),
]


CALIBRATIONS = ("none", "sigmoid", "isotonic")


@dataclass(frozen=True)
class FitOptions:
    """When a fit ends (see ``operators.perceptron``) and how its scores are calibrated.

    Fits learn from all labelled rows.  ``patience`` is the number of steps without
    a lower loss on the held-out part after which a fit stops, where it has one.
    """

    max_iter: int = 900
    tol: float = 1e-4
    patience: int = 20
    seed: int = 42
    calibration: str = "none"
    calib_cv: int = 3

    def __post_init__(self) -> None:
        wrong = [
            what
            for bad, what in (
                (self.max_iter < 1, "at least one iteration"),
                (self.tol < 0, "a tolerance of 0 or more"),
                (self.patience < 1, "a patience of one step or more"),
                (self.calibration not in CALIBRATIONS, f"calibration as one of {', '.join(CALIBRATIONS)}"),
                (self.calibration != CALIBRATIONS[0] and self.calib_cv < 2, "two or more calibration folds"),
            )
            if bad
        ]
        if wrong:
            raise ValueError(f"the fit needs {'; '.join(wrong)}")

    @property
    def search(self) -> P.Search:
        return P.Search(self.max_iter, self.tol, self.patience, self.seed)


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def _labelled(rows: DataFrame, label_col: str = LABEL) -> DataFrame:
    return rows.withColumn("label", F.col(label_col).cast("double"))


class FitRows:
    """Rows of one or more fits, packed by ``part`` (a column of text) and spread over the cluster when the first fit needs them."""

    def __init__(self, rows: DataFrame, features: list[str], part, label_col: str = LABEL):
        self.features, self.label_col = features, label_col
        self._packed, self._ready = P.pack_rows(rows, features, label_col, part), None

    def fit(self, fits: list[P.Fit], opts: FitOptions, store: RunStore | None = None, key: str | None = None) -> dict[str, P.Perceptron]:
        """Fit networks over the parts.

        With a store and the ``key`` of the rows, networks that an earlier run left
        are read, and only the others are fitted.
        """
        keys = {fit.name: content_key(key, self.features, fit, opts.search, self.label_col) for fit in fits}
        found = {name: model for name, k in keys.items() if store and key and (model := store.get(k))}
        missing = [fit for fit in fits if fit.name not in found]
        if missing:
            self._ready = self._ready or P.ready(materialize(self._packed))
            for name, model in P.fit_all(self._ready, missing, len(self.features), opts.search).items():
                found[name] = model
                if store and key:
                    store.put(keys[name], model)
        return found

    def release(self) -> None:
        """Give up the rows kept on the cluster."""
        if self._ready:
            self._ready[0].unpersist()
            self._ready = None


def fit_networks(rows: DataFrame, features: list[str], fits: list[P.Fit], part, opts: FitOptions, label_col: str = LABEL) -> dict[str, P.Perceptron]:
    """Fit networks side by side over the parts of ``rows`` that the column ``part`` names."""
    own = FitRows(rows, features, part, label_col)
    done = own.fit(fits, opts)
    own.release()
    return done


def fit_mlp(rows: DataFrame, features: list[str], cfg: MlpConfig, opts: FitOptions, label_col: str = LABEL) -> P.Perceptron:
    """One network on ``rows``."""
    return fit_networks(rows, features, [P.Fit("one", cfg.hidden, cfg.alpha, ("learn",))], F.lit("learn"), opts, label_col)["one"]


def tune_and_refit(known: FitRows, cfg: MlpConfig, opts: FitOptions, store: RunStore | None = None, key: str | None = None) -> tuple[P.Perceptron, P.Perceptron]:
    """A network on ``train``, stopped by ``val``, and one on both that runs as many steps."""
    tune = P.Fit("tuned", cfg.hidden, cfg.alpha, ("train",), ("val",))
    tuned = known.fit([tune], opts, store, key)["tuned"]
    both = P.Fit("refit", cfg.hidden, cfg.alpha, ("train", "val"), iterations=tuned.iterations)
    refit = known.fit([both], opts, store, key)["refit"]
    known.release()
    return tuned, refit


def fit_logreg(rows: DataFrame, features: list[str], opts: FitOptions, label_col: str = LABEL, reg: float = 0.0) -> PipelineModel:
    lr = LogisticRegression(maxIter=opts.max_iter, tol=opts.tol, regParam=reg, featuresCol="features", labelCol="label")
    return Pipeline(stages=[_assembler(features), lr]).fit(_labelled(rows, label_col))


def logreg_prob(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows plus ``up_prob`` = P(class 1)."""
    out = model.transform(rows)
    return out.withColumn("up_prob", vector_to_array(F.col("probability"))[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


# -------------------------------------------------------------- calibration


@dataclass
class CalibratedModel:
    """k networks, each with a calibrator fitted on the rows it did not learn from;
    the calibrated probabilities of the k pairs are averaged.

    A calibrator is a sigmoid (slope and offset of the raw probability) or the
    blocks of an isotonic fit.
    """

    pairs: list[tuple[P.Perceptron, tuple[float, float] | DataFrame]]
    features: list[str]

    def prob(self, rows: DataFrame) -> DataFrame:
        # Each pair adds one column to the same rows: no join, one pass.
        out, names = rows, []
        for i, (network, calibrator) in enumerate(self.pairs):
            out = P.with_prob(out, self.features, {"": network}, out="_raw")
            if isinstance(calibrator, tuple):
                slope, offset = calibrator
                out = out.withColumn(f"_p{i}", 1 / (1 + F.exp(-(F.col("_raw") * slope + offset))))
            else:
                out = I.calibrated(out, calibrator, "_raw", f"_p{i}")
            names.append(f"_p{i}")
        mean = reduce(lambda a, b: a + b, map(F.col, names)) / F.lit(float(len(names)))
        return out.withColumn("up_prob", mean).drop("_raw", *names)


def stratified_folds(rows: DataFrame, k: int, label_col: str = LABEL) -> DataFrame:
    """``rows`` with ``_cv``: blocks 0..k-1 of equal size within each class, in order of date and series."""
    place = F.struct(DATE, SERIES)
    ranked = M.prefix_sums(
        rows.select(SERIES, DATE, label_col, place.alias("_place"), F.lit(1).alias("_one")), [label_col], "_place", ["_one"]
    )
    sizes = rows.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    block = F.floor(F.col("_one_before") * F.lit(k) / F.col("_n")).cast("int")
    return rows.join(ranked.join(sizes, label_col).select(SERIES, DATE, block.alias("_cv")), [SERIES, DATE])


def fit_calibrated(rows: DataFrame, features: list[str], cfg: MlpConfig, opts: FitOptions, label_col: str = LABEL) -> CalibratedModel:
    """Cross-fitted calibration: fold i's calibrator is fitted on network i's scores
    of fold i, network i on the other folds (fold i also tells it when to stop).
    Folds are stratified by class; the k networks are fitted together."""
    k = opts.calib_cv
    tagged = materialize(stratified_folds(rows, k, label_col), partition_by=["_cv"])
    fits = [P.Fit(str(i), cfg.hidden, cfg.alpha, tuple(str(j) for j in range(k) if j != i), (str(i),)) for i in range(k)]
    networks = fit_networks(tagged, features, fits, F.col("_cv"), opts, label_col)
    # Every row scored by the network that did not learn from it, all folds in one pass.
    held = materialize(P.with_prob(tagged, features, networks, F.col("_cv"), "_raw").select("_cv", "_raw", F.col(label_col).cast("double").alias("label")), partition_by=["_cv"])
    pairs = []
    for i in range(k):
        own = held.where(F.col("_cv") == i)
        if opts.calibration == "sigmoid":
            line = Pipeline(stages=[_assembler(["_raw"]), LogisticRegression(featuresCol="features", labelCol="label")]).fit(own).stages[-1]
            pairs.append((networks[str(i)], (float(line.coefficients[0]), float(line.intercept))))
        else:
            pairs.append((networks[str(i)], I.fit_isotonic(own, "_raw", "label")))
    return CalibratedModel(pairs, features)


def fit_prob_model(rows: DataFrame, features: list[str], cfg: MlpConfig, opts: FitOptions, label_col: str = LABEL):
    """A function that adds ``up_prob``, calibrated if the options say so."""
    if opts.calibration == "none":
        model = fit_mlp(rows, features, cfg, opts, label_col)
        return lambda df: P.with_prob(df, features, {"": model})
    return fit_calibrated(rows, features, cfg, opts, label_col).prob


# --------------------------------------------------------- rolling / final


def _as_preds(scored: DataFrame, cfg: MlpConfig, keys: list[str]) -> DataFrame:
    return scored.select(
        *keys, F.lit(cfg.config_idx).alias("config_idx"), F.col(LABEL).cast("int").alias("y_true"), "up_prob"
    )


@dataclass
class MlpRun:
    config_rows: DataFrame
    fold_rows: DataFrame
    test_preds: DataFrame


_FIT_INFO = "iterations int, steps_run int, train_loss_last double, val_loss_best double, fit_ended string"


def _fit_info(spark, models: dict[tuple, P.Perceptron], key_schema: str) -> DataFrame:
    """What each fit did, one row per fit."""
    rows = [(*key, m.iterations, m.steps_run, m.loss, m.held_loss, m.ended) for key, m in models.items()]
    return spark.createDataFrame(rows, f"{key_schema}, {_FIT_INFO}")


def rolling_mlp(
    training: DataFrame,
    spec: E.EvalSpec = E.EvalSpec(),
    grid: list[MlpConfig] = MLP_GRID,
    opts: FitOptions = FitOptions(),
    store: RunStore | None = None,
) -> MlpRun:
    """Per fold: fit each config on train, tune its threshold on validation,
    choose a config (stable pick), refit it on train+val (same scaler),
    score test at the validation threshold."""
    spark = training.sparkSession
    frame = materialize(E.eval_frame(training, spec))
    # Folders by fold and split: scoring scans only its own part.
    scaled = require_folds(materialize(E.rolling_scaled(frame, spec), partition_by=[FOLD, SPLIT]))
    feats = spec.features
    keys = [SERIES, FOLD, SPLIT, DATE]
    folds = [r[FOLD] for r in scaled.select(FOLD).distinct().orderBy(FOLD).collect()]  # fold ids only
    by_idx = {c.config_idx: c for c in grid}
    part = F.concat_ws(":", FOLD, SPLIT)
    key = content_key("rolling", rows_key(frame, [SERIES, DATE, LABEL, *feats]), spec.folds, spec.scaler_scope, spec.seq_len) if store else None
    rows_of = lambda *splits: scaled.where(F.col(SPLIT).isin(*splits))

    infos: dict[tuple, P.Perceptron] = {}
    val_parts, tuned = [], {}
    if opts.calibration == "none":
        fits = [P.Fit(f"{f}/{c.config_idx}", c.hidden, c.alpha, (f"{f}:train",), (f"{f}:val",)) for f in folds for c in grid]
        known = FitRows(rows_of("train", "val"), feats, part)
        tuned = known.fit(fits, opts, store, key)
        infos = {(f, c.config_idx): tuned[f"{f}/{c.config_idx}"] for f in folds for c in grid}
        for c in grid:
            models = {str(f): tuned[f"{f}/{c.config_idx}"] for f in folds}
            val_parts.append(_as_preds(P.with_prob(rows_of("val"), feats, models, F.col(FOLD)), c, keys))
    else:
        for f in folds:
            for c in grid:
                score = fit_prob_model(rows_of("train").where(F.col(FOLD) == f), feats, c, opts)
                val_parts.append(_as_preds(score(rows_of("val").where(F.col(FOLD) == f)), c, keys))
    val_preds = materialize(reduce(DataFrame.unionByName, val_parts))
    cands = E.config_candidates(val_preds, spec)
    choice = materialize(E.fold_choice(cands, spec))
    chosen = {r[FOLD]: r["config_idx"] for r in choice.select(FOLD, "config_idx").collect()}  # one row per fold

    if opts.calibration == "none":
        again = [
            P.Fit(f"{f}/refit", by_idx[i].hidden, by_idx[i].alpha, (f"{f}:train", f"{f}:val"), iterations=tuned[f"{f}/{i}"].iterations)
            for f, i in sorted(chosen.items())
        ]
        refits = known.fit(again, opts, store, key)
        known.release()
        scored = P.with_prob(rows_of("test"), feats, {str(f): refits[f"{f}/refit"] for f in chosen}, F.col(FOLD))
        index = F.create_map(*[F.lit(x) for pair in chosen.items() for x in pair])[F.col(FOLD)]
        test_preds = scored.select(*keys, index.alias("config_idx"), F.col(LABEL).cast("int").alias("y_true"), "up_prob")
    else:
        parts = []
        for f, i in sorted(chosen.items()):
            own = scaled.where(F.col(FOLD) == f)
            score = fit_prob_model(own.where(F.col(SPLIT).isin("train", "val")), feats, by_idx[i], opts)
            parts.append(_as_preds(score(own.where(F.col(SPLIT) == "test")), by_idx[i], keys))
        test_preds = reduce(DataFrame.unionByName, parts)
    test_preds = materialize(test_preds)
    fold_rows = E.fold_results(test_preds, choice, spec, sizes_from=scaled)
    info = _fit_info(spark, infos, f"{FOLD} {scaled.schema[FOLD].dataType.simpleString()}, config_idx int")
    described = [with_settings(rows, grid, spec, opts).join(info, [FOLD, "config_idx"], "left") for rows in (cands, fold_rows)]
    return MlpRun(*described, test_preds)


def with_settings(rows: DataFrame, grid: list[MlpConfig], spec: E.EvalSpec, opts: FitOptions) -> DataFrame:
    """Rows with a ``config_idx`` plus what that configuration is and how its threshold is tuned."""
    of = lambda value: F.create_map(*[x for c in grid for x in (F.lit(c.config_idx), value(c))])[F.col("config_idx")]
    tune = spec.tune
    return rows.withColumns(
        {
            "config_key": of(lambda c: F.lit(c.key)),
            "hidden": of(lambda c: F.array(*[F.lit(h) for h in c.hidden])),
            "alpha": of(lambda c: F.lit(c.alpha)),
            "calibration": F.lit(opts.calibration),
            "threshold_goal": F.lit(tune.goal),
            "threshold_anchor": F.lit(tune.anchor),
            "threshold_eps": F.lit(tune.thr_eps),
            "config_eps": F.lit(tune.cfg_eps),
        }
    )


@dataclass
class FinalRun:
    metrics: DataFrame
    predictions: DataFrame
    error_cases: DataFrame
    error_summary: DataFrame
    threshold: DataFrame


def final_mlp(
    training: DataFrame,
    best: MlpConfig,
    rolling_folds: DataFrame,
    spec: E.EvalSpec = E.EvalSpec(),
    opts: FitOptions = FitOptions(),
    store: RunStore | None = None,
) -> FinalRun:
    """Time split: fit on train, tune on validation, snap, refit on train+val,
    evaluate test at the final threshold."""
    frame = E.eval_frame(training, spec)
    tagged = split_by_time(frame, spec.folds.train_ratio, spec.folds.val_ratio, spec.folds.test_ratio)
    scaled = materialize(scale_rows(tagged, spec.features, spec.scaler_scope, by=[]), partition_by=[SPLIT])
    keys = [SERIES, SPLIT, DATE]
    feats = spec.features
    rows_of = lambda *splits: scaled.where(F.col(SPLIT).isin(*splits))
    if opts.calibration == "none":
        key = content_key("final", rows_key(frame, [SERIES, DATE, LABEL, *feats]), spec.folds, spec.scaler_scope, spec.seq_len) if store else None
        base, refit = tune_and_refit(FitRows(rows_of("train", "val"), feats, F.col(SPLIT)), best, opts, store, key)
        scored = P.with_prob(rows_of("val", "test"), feats, {"val": base, "test": refit}, F.col(SPLIT))
        preds = _as_preds(scored, best, keys)
    else:
        base = fit_prob_model(rows_of("train"), feats, best, opts)
        refit = fit_prob_model(rows_of("train", "val"), feats, best, opts)
        preds = _as_preds(base(rows_of("val")), best, keys).unionByName(_as_preds(refit(rows_of("test")), best, keys))
    preds = materialize(preds, partition_by=[SPLIT])
    thr = E.final_threshold_row(preds, rolling_folds, spec)
    test = E.final_test_predictions(preds, thr)
    cases = error_cases(test, "threshold")
    summary = error_summary(cases, [], threshold_col="threshold")
    return FinalRun(E.final_metrics(test, spec.tune.effective_beta), test, cases, summary, thr)


def evaluation_summary(run: MlpRun, final: FinalRun, best: MlpConfig, rows: DataFrame) -> DataFrame:
    """One row with the headline numbers of a whole run."""
    fm = final.metrics.select(
        F.col("f1").alias("final_f1"), F.col("precision").alias("final_precision"),
        F.col("recall").alias("final_recall"), F.col("accuracy").alias("final_accuracy"),
        F.col("roc_auc").alias("final_roc_auc"), F.col("threshold").alias("final_threshold"),
    )
    es = final.error_summary.select("false_positive_count", "false_negative_count", "near_threshold_error_rate")
    stab = fold_stability(run.fold_rows)
    n = rows.agg(F.count(F.lit(1)).alias("rows"))
    cfg = rows.sparkSession.createDataFrame([(str(list(best.hidden)), float(best.alpha))], "best_hidden string, best_alpha double")
    return combine_rows(n, fm, es, stab, cfg)


def choose_best(run: MlpRun, spec: E.EvalSpec = E.EvalSpec(), grid: list[MlpConfig] = MLP_GRID) -> MlpConfig:
    stab = S.config_stability(run.config_rows, spec.tune)
    best = S.best_config(stab)
    S.require_row(best, "config choice")
    idx = best.select("config_idx").first()[0]
    return {c.config_idx: c for c in grid}[idx]


# ---------------------------------------------------------------- baseline


def logreg_baseline(training: DataFrame, spec: E.EvalSpec = E.EvalSpec(), opts: FitOptions = FitOptions(), threshold: float = 0.5) -> DataFrame:
    """Logistic regression on the time split: test metrics at a fixed threshold."""
    frame = E.eval_frame(training, spec)
    tagged = split_by_time(frame, spec.folds.train_ratio, spec.folds.val_ratio, spec.folds.test_ratio)
    scaled = materialize(scale_rows(tagged, spec.features, spec.scaler_scope, by=[]), partition_by=[SPLIT])
    model = fit_logreg(scaled.where(F.col(SPLIT) == "train"), spec.features, opts)
    test = logreg_prob(model, scaled.where(F.col(SPLIT) == "test")).withColumn("y_true", F.col(LABEL).cast("int"))
    test = materialize(test.select(SERIES, DATE, "y_true", "up_prob"))
    rates = M.classification_metrics(test, [], threshold)
    auc = M.roc_auc(test.withColumn("_g", F.lit(0)), ["_g"]).drop("_g", "positives", "negatives")
    return combine_rows(rates, auc).withColumn("model", F.lit("logreg"))


# ------------------------------------------------------------ persistence


def save_model(model: P.Perceptron, settings: DataFrame, path: str) -> None:
    """Network plus a one-row settings table (features, threshold, ...)."""
    settings.sparkSession.createDataFrame([model.row()], P.Perceptron.SCHEMA).write.mode("overwrite").parquet(f"{path}/model")
    settings.write.mode("overwrite").parquet(f"{path}/settings")


def load_model(spark, path: str) -> tuple[P.Perceptron, DataFrame]:
    return P.Perceptron.of(spark.read.parquet(f"{path}/model").first()), spark.read.parquet(f"{path}/settings")


def predict_latest(
    frame: DataFrame, scaler: DataFrame, model: P.Perceptron, features: list[str], threshold: float, min_rows: int = 1
) -> DataFrame:
    """Score the newest bar of every series with ``min_rows`` rows or more: date, probability, class, threshold."""
    from pyspark.sql import Window

    from panelcast.operators.scaling import apply_scaler

    w = Window.partitionBy(SERIES).orderBy(F.col(DATE).desc())
    rows = F.count(F.lit(1)).over(Window.partitionBy(SERIES))
    latest = frame.withColumns({"_rn": F.row_number().over(w), "_rows": rows})
    latest = latest.where((F.col("_rn") == 1) & (F.col("_rows") >= min_rows)).drop("_rn", "_rows")
    scaled = apply_scaler(latest, scaler, features, [SERIES])
    scored = P.with_prob(scaled, features, {"": model})
    return scored.select(
        SERIES,
        F.col(DATE).alias("trade_date"),
        "up_prob",
        predict_class(F.col("up_prob"), F.lit(float(threshold))).alias("y_pred"),
        F.lit(float(threshold)).alias("threshold"),
    )


def fit_for_latest(training: DataFrame, spec: E.EvalSpec, cfg: MlpConfig, opts: FitOptions) -> tuple[DataFrame, P.Perceptron, DataFrame]:
    """Scaler from the train part of the time split (per series) and a model on train+val, stopped where validation did."""
    frame = E.eval_frame(training, spec)
    tagged = materialize(split_by_time(frame, spec.folds.train_ratio, spec.folds.val_ratio, spec.folds.test_ratio))
    # Stored: sums of floating-point numbers, taken again, may differ in the last digit, and so would the scores.
    scaler = materialize(fit_scaler(tagged, spec.features, "series", by=[]))
    known = materialize(scale_rows(tagged, spec.features, "series", by=[]).where(F.col(SPLIT).isin("train", "val")))
    return frame, tune_and_refit(FitRows(known, spec.features, F.col(SPLIT)), cfg, opts)[1], scaler


# ------------------------------------------------------- sequence classifier


@dataclass
class SequenceRun:
    metrics: DataFrame
    predictions: DataFrame


def train_sequence_model(
    training: DataFrame,
    spec: E.EvalSpec = E.EvalSpec(),
    hidden: tuple[int, ...] = (64,),
    opts: FitOptions = FitOptions(),
    threshold: float = 0.5,
) -> SequenceRun:
    """Time split -> train-only scaler -> L-row windows per split -> classifier
    on the flattened window, stopped on the validation part -> losses and test
    metrics at a fixed threshold, with the test predictions.

    Windows never cross a split.  Rows are packed once per series and split; the
    windows (L*F inputs, oldest row first) exist only inside the tasks that
    evaluate them.
    """
    from panelcast.operators.splits import split_sizes

    tagged = split_by_time(training, spec.folds.train_ratio, spec.folds.val_ratio, spec.folds.test_ratio)
    scaled = materialize(scale_rows(tagged, spec.features, spec.scaler_scope, by=[]), partition_by=[SPLIT])
    feats, length = spec.features, spec.seq_len
    known = scaled.where(F.col(SPLIT).isin("train", "val"))
    blocks = materialize(P.pack_series(known, feats, LABEL, F.col(SPLIT), SERIES, DATE))
    fit = P.Fit("sequence", tuple(hidden), 0.0, ("train",), ("val",))
    model = P.fit_all(blocks, [fit], len(feats), opts.search, window=length)["sequence"]
    test = P.window_probs(scaled.where(F.col(SPLIT) == "test"), feats, LABEL, model, length, [SERIES], DATE)
    test = materialize(test.withColumn("y_pred", predict_class(F.col("up_prob"), threshold)))
    rates = M.with_confusion_matrix(M.confusion(test, [], F.lit(float(threshold)))).select(
        "tn", "fp", "fn", "tp", "confusion_matrix"
    )
    rates = M.with_rates(rates).select("accuracy", "f1", "confusion_matrix")
    sizes = split_sizes(tagged).groupBy().pivot(SPLIT, ["train", "val", "test"]).agg(F.first("rows"))
    samples = F.greatest(F.count(F.lit(1)) - (length - 1), F.lit(0)).alias("n")
    per_series = scaled.groupBy(SERIES, SPLIT).agg(samples)
    samples = per_series.groupBy().pivot(SPLIT, ["train", "val", "test"]).agg(F.sum("n"))
    metrics = combine_rows(
        sizes.select(F.struct("train", "val", "test").alias("split_rows")),
        samples.select(F.struct("train", "val", "test").alias("sequence_samples")),
        rates,
    ).withColumns(
        {
            "train_loss_last": F.lit(model.loss),
            "val_loss_best": F.lit(model.held_loss),
            "iterations": F.lit(model.iterations),
            "steps_run": F.lit(model.steps_run),
            "threshold": F.lit(float(threshold)),
            "sequence_length": F.lit(length),
        }
    )
    return SequenceRun(metrics, test.select(SERIES, DATE, "y_true", "up_prob", "y_pred"))
