"""Registered queries: final evaluation, error analysis, engine consistency, export."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from panelcast.operators import consistency as C
from panelcast.operators import features as feat
from panelcast.operators.errors import ERROR_ORDER, error_distribution
from panelcast.plans import evaluation as E
from panelcast.plans import oracle as O
from panelcast.plans import publish as P
from panelcast.plans.registry import panel, panel_buckets, register, training_frame
from panelcast.plans.catalog_eval import _BASE, _CANDS, _FOLD_RES, _STAB, FEATS, SPEC, TUNE, BETA
from panelcast.operators.scoring import FIXTURE_SCORERS
from panelcast.plans.signal_store import SignalStore
from panelcast.schema import FEATURE_COLUMNS, LABEL
from panelcast.session import ensure_checkpoint_dir, materialize
from panelcast.sources.store import read_ordered, write_ordered


def final_run(spark, sf_dir, form="dataframe"):
    """Rolling run, then the final split evaluation with the chosen config."""
    run = E.rolling_run(training_frame(spark, sf_dir, form), SPEC, buckets=panel_buckets(spark, sf_dir))
    fpreds = E.final_predictions(run.frame, run.best, SPEC)
    thr = E.final_threshold_row(fpreds, run.folds, SPEC)
    test = E.final_test_predictions(fpreds, thr)
    return run, fpreds, thr, test


# ----------------------------------------------------------------- oracle

_FINAL = _FOLD_RES + _STAB[len(_CANDS):] + [
    O.time_split_cte(),
    O.scaled_cte(FEATS, "tsplit", "series_id", name="fscaled", keep=""),
    O.scores_cte(FIXTURE_SCORERS, FEATS, "fscaled", "series_id, split, bar_date", name="fpreds_all"),
    "fpreds AS (SELECT p.* FROM fpreds_all p JOIN best_cfg b USING (config_idx))",
    O.sweep_cte("fpreds", ["config_idx"], TUNE.grid, BETA, TUNE.min_precision, TUNE.min_recall, TUNE.penalty, name="fsweep"),
    O.pick_cte("fsweep", ["config_idx"], "score", "threshold", "f1", "k", TUNE.thr_eps, TUNE.anchor, "fbest"),
    f"""fthr AS (
    SELECT b.threshold AS val_best_threshold, b.score AS val_score_best, b.f1 AS val_f1_at_best,
           (SELECT coalesce({O.snap_sql("median(best_threshold)", TUNE.grid)}, {O.snap_sql(O._d(TUNE.anchor), TUNE.grid)}) FROM fold_res)
             AS rolling_threshold_median,
           {O.snap_sql("b.threshold", TUNE.grid)} AS threshold, 'val_best' AS threshold_source
    FROM fbest b
)""",
    """ftest_final AS (
    SELECT p.*, t.threshold, CAST(p.up_prob >= t.threshold AS INTEGER) AS y_pred
    FROM fpreds p, fthr t WHERE p.split = 'test'
)""",
    """fcases AS (
    SELECT *, CASE WHEN y_true = 0 AND y_pred = 1 THEN 'false_positive'
                   WHEN y_true = 1 AND y_pred = 0 THEN 'false_negative' ELSE 'ok' END AS error_type,
           abs(up_prob - threshold) AS abs_gap_from_threshold
    FROM ftest_final
)""",
    """fsummary AS (
    SELECT count(*) AS sample_count,
           CAST(sum(CASE WHEN error_type = 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS ok_count,
           CAST(sum(CASE WHEN error_type = 'false_positive' THEN 1 ELSE 0 END) AS BIGINT) AS false_positive_count,
           CAST(sum(CASE WHEN error_type = 'false_negative' THEN 1 ELSE 0 END) AS BIGINT) AS false_negative_count,
           CAST(sum(CASE WHEN error_type <> 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
           CAST(sum(CASE WHEN error_type <> 'ok' AND abs_gap_from_threshold <= 0.05::DOUBLE THEN 1 ELSE 0 END) AS BIGINT)
             AS near_threshold_error_count,
           max(threshold) AS threshold
    FROM fcases
)""",
    O.auc_sql("ftest_final", [], "ffauc"),
    f"""fmetrics AS (
    SELECT tn, fp, fn, tp,
           {O._ratio("tp + tn", "tp + tn + fp + fn")} AS accuracy,
           {O._ratio("tp", "tp + fp")} AS precision,
           {O._ratio("tp", "tp + fn")} AS recall,
           {O._fbeta(1.0, pos="tp + fn")} AS f1,
           {O._fbeta(0.5, pos="tp + fn")} AS fbeta,
           (SELECT roc_auc FROM ffauc) AS roc_auc,
           brier_score, sample_count, threshold
    FROM (
      SELECT CAST(sum(CASE WHEN y_true = 0 AND y_pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
             CAST(sum(CASE WHEN y_true = 0 AND y_pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(sum(CASE WHEN y_true = 1 AND y_pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
             CAST(sum(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             avg((up_prob - y_true) * (up_prob - y_true)) AS brier_score, count(*) AS sample_count,
             max(threshold) AS threshold
      FROM ftest_final
    )
)""",
]


def _sql(ctes, select):
    return O.with_(*ctes) + select


@register("final_threshold_choice", _sql(_FINAL, "SELECT * FROM fthr"))
def q_final_threshold_choice(spark, sf_dir):
    return final_run(spark, sf_dir)[2]


@register("final_metrics", _sql(_FINAL, "SELECT * FROM fmetrics"))
def q_final_metrics(spark, sf_dir):
    return E.final_metrics(final_run(spark, sf_dir)[3], BETA)


@register(
    "final_record",
    _sql(
        _FINAL,
        """SELECT m.*, t.val_best_threshold, t.rolling_threshold_median, t.threshold_source, 'f0.5' AS threshold_goal, 0.5::DOUBLE AS threshold_beta,
       0.3::DOUBLE AS grid_lo, 0.7::DOUBLE AS grid_hi, 0.01::DOUBLE AS grid_step, 0.01::DOUBLE AS threshold_eps,
       0.5::DOUBLE AS threshold_anchor, 0.001::DOUBLE AS config_eps, 0.56::DOUBLE AS min_precision, 0.62::DOUBLE AS min_recall,
       1.2::DOUBLE AS floor_penalty, 0.2::DOUBLE AS config_std_penalty, 0.12::DOUBLE AS config_threshold_penalty,
       'val' AS final_mode, 'none' AS calibration
FROM fmetrics m, fthr t""",
    ),
)
def q_final_record(spark, sf_dir):
    """Final metrics with the settings that led to them."""
    _, _, thr, test = final_run(spark, sf_dir)
    return E.final_record(E.final_metrics(test, BETA), thr, SPEC)


@register(
    "final_threshold_rolling",
    _sql(
        _FINAL,
        "SELECT val_best_threshold, val_score_best, val_f1_at_best, rolling_threshold_median, "
        "rolling_threshold_median AS threshold, 'rolling_median' AS threshold_source FROM fthr",
    ),
)
def q_final_threshold_rolling(spark, sf_dir):
    """The final threshold taken from the folds instead of the validation part."""
    run, fpreds, _, _ = final_run(spark, sf_dir)
    return E.final_threshold_row(fpreds, run.folds, replace(SPEC, tune=replace(TUNE, final_mode="rolling_median")))


@register(
    "error_cases",
    _sql(
        _FINAL,
        "SELECT series_id, split, bar_date, config_idx, y_true, logit, up_prob, threshold, y_pred, error_type, "
        "abs_gap_from_threshold FROM fcases",
    ),
)
def q_error_cases(spark, sf_dir):
    cases, _ = E.final_errors(final_run(spark, sf_dir)[3])
    return cases.select(
        "series_id", "split", "bar_date", "config_idx", "y_true", "logit", "up_prob", "threshold", "y_pred",
        "error_type", "abs_gap_from_threshold",
    )


@register(
    "error_summary",
    _sql(
        _FINAL,
        f"""SELECT *, 0.05::DOUBLE AS near_threshold_band,
       {O._ratio("near_threshold_error_count", "error_count")} AS near_threshold_error_rate FROM fsummary""",
    ),
)
def q_error_summary(spark, sf_dir):
    return E.final_errors(final_run(spark, sf_dir)[3])[1]


@register(
    "error_distribution",
    _sql(
        _FINAL,
        """SELECT 'ok' AS error_type, ok_count AS count FROM fsummary
UNION ALL SELECT 'false_positive', false_positive_count FROM fsummary
UNION ALL SELECT 'false_negative', false_negative_count FROM fsummary""",
    ),
)
def q_error_distribution(spark, sf_dir):
    return error_distribution(E.final_errors(final_run(spark, sf_dir)[3])[1], [])


# ------------------------------------------------------ engine consistency

_CONS = [
    O.bars_cte("main"),
    O.features_cte(ddof=1, name="fa"),
    O.features_cte(ddof=0, name="fb"),
    f"""j AS (
    SELECT {", ".join(f"a.{c} AS {c}_a, b.{c} AS {c}_b" for c in FEATURE_COLUMNS + [LABEL])}
    FROM fa a JOIN fb b USING (series_id, bar_date)
)""",
    "cons AS ("
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column, count(abs({c}_b - {c}_a)) AS count, avg(abs({c}_b - {c}_a)) AS mean_abs_diff, "
        f"max(abs({c}_b - {c}_a)) AS max_abs_diff, avg({c}_a) AS dataframe_mean, avg({c}_b) AS sql_mean, "
        f"avg(abs({c}_b - {c}_a)) / (abs(avg({c}_a)) + 1e-12::DOUBLE) AS mean_rel_diff FROM j"
        for c in FEATURE_COLUMNS
    )
    + ")",
]


def _frames(spark, sf_dir):
    bars = panel(spark, sf_dir)
    return feat.features_dataframe(bars), feat.features_sql(bars)


@register("feature_consistency", _sql(_CONS, "SELECT * FROM cons"))
def q_feature_consistency(spark, sf_dir):
    a, b = _frames(spark, sf_dir)
    return C.feature_consistency(a, b, FEATURE_COLUMNS, names=("dataframe", "sql"))


@register(
    "consistency_summary",
    _sql(
        _CONS,
        f"""SELECT (SELECT count(*) FROM fa) AS dataframe_rows, (SELECT count(*) FROM fb) AS sql_rows,
       count(*) AS joined_rows,
       CAST(sum(CASE WHEN coalesce(target_up_a <> target_up_b, true) THEN 1 ELSE 0 END) AS BIGINT) AS label_mismatch_count,
       {O._ratio("sum(CASE WHEN coalesce(target_up_a <> target_up_b, true) THEN 1 ELSE 0 END)", "greatest(count(*), 1)")}
         AS label_mismatch_rate,
       (SELECT coalesce(avg(mean_abs_diff), 0.0) FROM cons) AS feature_mean_abs_diff_avg,
       (SELECT coalesce(max(max_abs_diff), 0.0) FROM cons) AS feature_max_abs_diff_max
FROM j""",
    ),
)
def q_consistency_summary(spark, sf_dir):
    a, b = _frames(spark, sf_dir)
    return C.consistency_summary(a, b, FEATURE_COLUMNS, names=("dataframe", "sql"))


_CONS_TRAIN = [
    O.bars_cte("main"),
    O.features_cte(ddof=1, name="fa"),
    O.features_cte(ddof=0, name="fb"),
    O.training_cte(src="fa", name="ta"),
    O.training_cte(src="fb", name="tb"),
    f"""jt AS (
    SELECT {", ".join(f"a.{c} AS {c}_a, b.{c} AS {c}_b" for c in FEATS + [LABEL])}
    FROM ta a JOIN tb b USING (series_id, bar_date)
)""",
]


@register(
    "feature_consistency_training",
    _sql(
        _CONS_TRAIN,
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column, count(abs({c}_b - {c}_a)) AS count, avg(abs({c}_b - {c}_a)) AS mean_abs_diff, "
            f"max(abs({c}_b - {c}_a)) AS max_abs_diff, avg({c}_a) AS dataframe_mean, avg({c}_b) AS sql_mean, "
            f"avg(abs({c}_b - {c}_a)) / (abs(avg({c}_a)) + 1e-12::DOUBLE) AS mean_rel_diff FROM jt"
            for c in FEATS
        ),
    ),
)
def q_feature_consistency_training(spark, sf_dir):
    """The two engines compared on their finished training frames and the configured columns."""
    a = training_frame(spark, sf_dir, "dataframe")
    b = training_frame(spark, sf_dir, "sql")
    return C.feature_consistency(a, b, FEATS, names=("dataframe", "sql"))


# ---------------------------------------------------------- ordered sinks


def _sink(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


@register(
    "ordered_error_cases",
    _sql(
        _FINAL,
        "SELECT series_id, bar_date, error_type, abs_gap_from_threshold, "
        "row_number() OVER (ORDER BY error_type, abs_gap_from_threshold, series_id, bar_date) - 1 AS position FROM fcases",
    ),
)
def q_ordered_error_cases(spark, sf_dir):
    """Error cases written in order (kind, then nearest to the threshold) and read back with their places."""
    cases, _ = E.final_errors(final_run(spark, sf_dir)[3])
    path = _sink(spark, "error-cases")
    write_ordered(cases.select("series_id", "bar_date", "error_type", "abs_gap_from_threshold"), path, [F.col(c) for c in ERROR_ORDER])
    return read_ordered(spark, path)


@register(
    "ordered_consistency",
    _sql(_CONS, """SELECT "column", mean_abs_diff, row_number() OVER (ORDER BY round(mean_abs_diff, 9) DESC NULLS LAST, "column") - 1 AS position FROM cons"""),
)
def q_ordered_consistency(spark, sf_dir):
    """The per-feature report of the two engines, largest difference first (to nine digits), read back with its places."""
    a, b = _frames(spark, sf_dir)
    rows = C.feature_consistency(a, b, FEATURE_COLUMNS, names=("dataframe", "sql")).select("column", "mean_abs_diff")
    path = _sink(spark, "consistency")
    write_ordered(rows, path, C.consistency_order(9))
    return read_ordered(spark, path)


# ------------------------------------------------------------- run compare

# Names of the compared run metrics.
RUN_METRICS = [
    "final_f1", "final_precision", "final_recall", "final_accuracy", "final_roc_auc", "final_threshold",
    "false_positive_count", "false_negative_count", "near_threshold_error_rate",
    "rolling_avg_f1", "rolling_min_f1", "rolling_std_f1", "rolling_std_threshold",
]


def run_summary(spark, sf_dir, form):
    """One row: the headline numbers of a whole evaluation run."""
    run, _, _, test = final_run(spark, sf_dir, form)
    fm = E.final_metrics(test, BETA).select(
        F.col("f1").alias("final_f1"), F.col("precision").alias("final_precision"),
        F.col("recall").alias("final_recall"), F.col("accuracy").alias("final_accuracy"),
        F.col("roc_auc").alias("final_roc_auc"), F.col("threshold").alias("final_threshold"),
    )
    es = E.final_errors(test)[1].select("false_positive_count", "false_negative_count", "near_threshold_error_rate")
    stab = C.fold_stability(run.folds)
    return C.combine_rows(fm, es, stab)


_RUNROW = """runrow AS (
  SELECT m.f1 AS final_f1, m.precision AS final_precision, m.recall AS final_recall, m.accuracy AS final_accuracy,
         m.roc_auc AS final_roc_auc, m.threshold AS final_threshold,
         s.false_positive_count, s.false_negative_count,
         CASE WHEN s.error_count = 0 THEN 0.0 ELSE s.near_threshold_error_count::DOUBLE / s.error_count END
           AS near_threshold_error_rate,
         r.*
  FROM fmetrics m, fsummary s,
       (SELECT avg(test_f1) AS rolling_avg_f1, min(test_f1) AS rolling_min_f1, stddev_pop(test_f1) AS rolling_std_f1,
               stddev_pop(best_threshold) AS rolling_std_threshold FROM fold_res) r
)"""


def _run_sql() -> str:
    """Both engines' whole chains (sample and population volatility), each to one row of metrics."""
    cols = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in RUN_METRICS)
    unpivot = f"SELECT metric, v FROM (UNPIVOT (SELECT {cols} FROM runrow) ON COLUMNS(*) INTO NAME metric VALUE v)"
    other = [O.features_cte(ddof=0) if cte == O.features_cte(ddof=1) else cte for cte in _FINAL]
    a, b = (_sql([*ctes, _RUNROW], unpivot) for ctes in (_FINAL, other))
    return f"SELECT metric, a.v AS dataframe, b.v AS sql, b.v - a.v AS sql_minus_dataframe FROM ({a}) a JOIN ({b}) b USING (metric)"


@register("run_comparison", _run_sql())
def q_run_comparison(spark, sf_dir):
    a = run_summary(spark, sf_dir, "dataframe")
    b = run_summary(spark, sf_dir, "sql")
    return C.run_comparison(a, b, RUN_METRICS, names=("dataframe", "sql"))


# ---------------------------------------------------------------- export

_EXPORT = _FINAL + [
    O.scaled_cte(FEATS, "tsplit", "series_id", name="xscaled", keep=""),
    O.scores_cte(FIXTURE_SCORERS, FEATS, "xscaled", "series_id, split, bar_date", name="xpreds_all"),
]


@register(
    "signal_export",
    _sql(
        _EXPORT,
        """SELECT p.series_id, p.bar_date AS trade_date, p.up_prob, CAST(p.up_prob >= t.threshold AS INTEGER) AS y_pred,
       t.threshold, p.config_idx, 'fixture-linear' AS model_version, 'dataframe' AS feature_engine,
       p.bar_date < (SELECT max(bar_date) FROM cut) AS is_stale
FROM xpreds_all p JOIN best_cfg b USING (config_idx), fthr t
WHERE p.bar_date = (SELECT max(c.bar_date) FROM cut c WHERE c.series_id = p.series_id)""",
    ),
)
def q_signal_export(spark, sf_dir):
    run, fpreds, thr, _ = final_run(spark, sf_dir)
    return P.signal_export(fpreds, thr, model_version="fixture-linear", feature_engine="dataframe")


_AT = "p.bar_date = (SELECT max(c.bar_date) FROM cut c WHERE c.series_id = p.series_id AND {until})"
_RUN = """SELECT p.series_id, p.bar_date AS trade_date, p.up_prob, CAST(p.up_prob >= 0.5::DOUBLE AS INTEGER) AS y_pred, 0.5::DOUBLE AS threshold,
         p.config_idx, 'fixture-linear' AS model_version, 'dataframe' AS feature_engine,
         p.bar_date < (SELECT max(c.bar_date) FROM cut c WHERE {until}) AS is_stale, '{run}' AS run_id, false AS is_carried
  FROM xpreds_all p WHERE p.config_idx = 0 AND p.split = 'test' AND {at}"""
_EARLY = "c.bar_date < (SELECT max(bar_date) FROM cut) - INTERVAL 30 DAY"


@register(
    "signal_store",
    _sql(
        [*_BASE, O.time_split_cte(), O.scaled_cte(FEATS, "tsplit", "series_id", name="xscaled", keep=""),
         O.scores_cte(FIXTURE_SCORERS, FEATS, "xscaled", "series_id, split, bar_date", name="xpreds_all"),
         f"one AS ({_RUN.format(run='run-1', until=_EARLY, at=_AT.format(until=_EARLY))})",
         f"two AS ({_RUN.format(run='run-2', until='true', at=_AT.format(until='true'))})",
         "good AS (SELECT * FROM two WHERE series_id % 7 <> 0)"],
        """SELECT * FROM good UNION ALL
SELECT * REPLACE (true AS is_stale, true AS is_carried) FROM one WHERE series_id NOT IN (SELECT series_id FROM good)""",
    ),
)
def q_signal_store(spark, sf_dir):
    """Two publishes, 30 days apart; the second lacks a value for every seventh series, which keep their last good signal."""
    frame = E.eval_frame(training_frame(spark, sf_dir), SPEC)
    scaled = E.scale_rows(E.split_by_time(frame), FEATS, "series", by=[])
    scored = E.score_rows(scaled.where(F.col("split") == "test"), FEATS, FIXTURE_SCORERS[:1], keep=["series_id", "split", "bar_date"])
    scored = materialize(scored)
    threshold = spark.range(1).select(F.lit(0.5).alias("threshold"))
    early = scored.where(F.col("bar_date") < F.date_sub(F.lit(scored.agg(F.max("bar_date")).head()[0]), 30))
    store = SignalStore(spark, _sink(spark, "signals"))
    export = lambda rows: P.signal_export(rows, threshold, model_version="fixture-linear", feature_engine="dataframe")
    store.publish(export(early), "run-1")
    broken = F.when(F.col("series_id") % 7 != 0, F.col("up_prob"))
    return store.publish(export(scored).withColumn("up_prob", broken), "run-2")
