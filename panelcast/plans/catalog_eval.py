"""Registered queries for splits, scaling, scoring and evaluation.

All of them start from the whole ``lineitem`` table: bars -> features ->
training frame -> warm-up cut, then the operator under test.  Scores come
from the fixture coefficient tables so that every evaluation step has an
independent DuckDB statement.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from panelcast.operators import metrics as M
from panelcast.operators import selection as S
from panelcast.operators import sequences as Q
from panelcast.operators import splits as SP
from panelcast.operators import thresholds as T
from panelcast.operators.errors import error_distribution
from panelcast.operators.scaling import fit_scaler, scale_rows
from panelcast.operators.scoring import FIXTURE_SCORERS
from panelcast.plans import evaluation as E
from panelcast.plans import oracle as O
from panelcast.plans.registry import panel, panel_buckets, register, training_frame
from panelcast.schema import DATE, DEFAULT_FEATURES, SERIES
from panelcast.session import materialize
from panelcast.sources import bars as B
from panelcast.operators import features as feat

SPEC = E.EvalSpec()
TUNE = SPEC.tune
FEATS = DEFAULT_FEATURES
BETA = TUNE.effective_beta


def cut_frame(spark, sf_dir, form="dataframe"):
    return E.eval_frame(training_frame(spark, sf_dir, form), SPEC)


def stored_frame(spark, sf_dir):
    """The cut frame, stored in buckets by series: scaling reads it twice and neither shuffles nor sorts it."""
    return materialize(cut_frame(spark, sf_dir), bucket_by=[SERIES], buckets=panel_buckets(spark, sf_dir))


def rolling_preds(spark, sf_dir, splits=None):
    """Scores of the fold rows (of all splits or some), for the per-split metric queries that read them once."""
    return E.rolling_predictions(stored_frame(spark, sf_dir), SPEC, splits=splits)


def tuning(spark, sf_dir, form="dataframe"):
    """(bucketed cut frame, validation/test scores): what the tuning queries read."""
    return E.tuning_inputs(training_frame(spark, sf_dir, form), SPEC, buckets=panel_buckets(spark, sf_dir))


def tuned(spark, sf_dir):
    """Candidates, per-fold choice and fold results from the tuning inputs."""
    frame, preds = tuning(spark, sf_dir)
    cands = materialize(E.config_candidates(preds, SPEC))
    choice = materialize(E.fold_choice(cands, SPEC))
    return frame, preds, cands, choice


# ----------------------------------------------------------------- oracle

_BASE = [O.bars_cte("main"), O.features_cte(ddof=1), O.training_cte(), O.positions_cte(), O.cut_cte()]
_FOLDS = _BASE + [O.fold_len_cte(), O.folded_cte()]
_SCALED = _FOLDS + [O.scaled_cte(FEATS, "folded", "series_id, fold_id", keep="fold_id,")]
_PREDS = _SCALED + [O.scores_cte(FIXTURE_SCORERS, FEATS, "scaled", "series_id, fold_id, split, bar_date")]
_SWEEP = _PREDS + [O.sweep_cte("preds", ["fold_id", "config_idx"], TUNE.grid, BETA, TUNE.min_precision, TUNE.min_recall, TUNE.penalty)]
_CANDS = _SWEEP + [
    O.pick_cte("sweep", ["fold_id", "config_idx"], "score", "threshold", "f1", "k", TUNE.thr_eps, TUNE.anchor, "best_thr"),
    """cands AS (
    SELECT fold_id, config_idx, threshold AS best_threshold, score AS val_score_best, f1 AS val_f1_best,
           'f0.5' AS threshold_goal FROM best_thr
)""",
]
_CHOICE = _CANDS + [
    O.pick_cte("cands", ["fold_id"], "val_score_best", "best_threshold", "val_f1_best", "config_idx", TUNE.cfg_eps, TUNE.anchor, "choice")
]
_FOLD_RES = _CHOICE + [
    """ftest AS (
    SELECT p.*, c.best_threshold FROM preds p JOIN choice c USING (fold_id, config_idx) WHERE p.split = 'test'
)""",
    """frates AS (
    SELECT fold_id,
           sum(CASE WHEN up_prob >= best_threshold AND y_true = 1 THEN 1 ELSE 0 END) AS tp,
           sum(CASE WHEN up_prob >= best_threshold AND y_true = 0 THEN 1 ELSE 0 END) AS fp,
           sum(CASE WHEN up_prob < best_threshold AND y_true = 1 THEN 1 ELSE 0 END) AS fn,
           sum(CASE WHEN up_prob < best_threshold AND y_true = 0 THEN 1 ELSE 0 END) AS tn,
           sum(y_true) AS pos
    FROM ftest GROUP BY fold_id
)""",
    O.auc_sql("ftest", ["fold_id"], "fauc"),
    """fsizes AS (
    SELECT fold_id,
           CAST(sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS BIGINT) AS train_rows,
           CAST(sum(CASE WHEN split = 'val' THEN 1 ELSE 0 END) AS BIGINT) AS val_rows,
           CAST(sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS BIGINT) AS test_rows,
           min(CASE WHEN split = 'train' THEN bar_date END) AS train_start_date,
           max(CASE WHEN split = 'train' THEN bar_date END) AS train_end_date,
           max(CASE WHEN split = 'val' THEN bar_date END) AS val_end_date,
           max(CASE WHEN split = 'test' THEN bar_date END) AS test_end_date
    FROM preds WHERE config_idx = 0 GROUP BY fold_id
)""",
    f"""fold_res AS (
    SELECT c.fold_id, c.config_idx, c.best_threshold, c.val_score_best, c.val_f1_best,
           {O._ratio("r.tp + r.tn", "r.tp + r.tn + r.fp + r.fn")} AS test_accuracy,
           {O._fbeta(1.0, "r.tp", "r.fp", "r.pos")} AS test_f1,
           {O._ratio("r.tp", "r.tp + r.fp")} AS test_precision,
           {O._ratio("r.tp", "r.pos")} AS test_recall,
           a.roc_auc AS test_roc_auc,
           s.train_rows, s.val_rows, s.test_rows, s.train_start_date, s.train_end_date, s.val_end_date, s.test_end_date
    FROM choice c JOIN frates r USING (fold_id) JOIN fauc a USING (fold_id) JOIN fsizes s USING (fold_id)
)""",
]
_STAB = _CANDS + [
    f"""stab AS (
    SELECT config_idx, count(*) AS folds, avg(val_score_best) AS mean_score,
           stddev_pop(val_score_best) AS std_score, stddev_pop(best_threshold) AS std_threshold,
           avg(val_score_best) - {O._d(TUNE.cfg_std_pen)} * stddev_pop(val_score_best)
             - {O._d(TUNE.cfg_thr_pen)} * stddev_pop(best_threshold) AS stability
    FROM cands GROUP BY config_idx
)""",
    """best_cfg AS (
    SELECT * FROM stab WHERE stability > -1.0::DOUBLE ORDER BY stability DESC, config_idx LIMIT 1
)""",
]


def _sql(ctes, select):
    return O.with_(*ctes) + select


def _rates_sql(thr: float, beta: float) -> str:
    t = O._d(thr)
    return f"""SELECT fold_id, config_idx, split, tn, fp, fn, tp,
       {O._ratio("tp + tn", "tp + tn + fp + fn")} AS accuracy,
       {O._ratio("tp", "tp + fp")} AS precision,
       {O._ratio("tp", "tp + fn")} AS recall,
       {O._fbeta(1.0, pos="tp + fn")} AS f1,
       {O._fbeta(beta, pos="tp + fn")} AS fbeta
FROM (
  SELECT fold_id, config_idx, split,
         CAST(sum(CASE WHEN y_true = 0 AND up_prob < {t} THEN 1 ELSE 0 END) AS BIGINT) AS tn,
         CAST(sum(CASE WHEN y_true = 0 AND up_prob >= {t} THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN y_true = 1 AND up_prob < {t} THEN 1 ELSE 0 END) AS BIGINT) AS fn,
         CAST(sum(CASE WHEN y_true = 1 AND up_prob >= {t} THEN 1 ELSE 0 END) AS BIGINT) AS tp
  FROM preds GROUP BY fold_id, config_idx, split
)"""


# ------------------------------------------------------------------ splits


@register("warmup_cut", _sql(_BASE, "SELECT series_id, bar_date, row_idx, n_rows FROM cut"))
def q_warmup_cut(spark, sf_dir):
    return cut_frame(spark, sf_dir).select(SERIES, DATE, "row_idx", "n_rows")


@register("split_by_time", _sql(_BASE + [O.time_split_cte()], "SELECT series_id, bar_date, row_idx, split FROM tsplit"))
def q_split_by_time(spark, sf_dir):
    return SP.split_by_time(cut_frame(spark, sf_dir)).select(SERIES, DATE, "row_idx", "split")


@register(
    "split_sizes",
    _sql(_BASE + [O.time_split_cte()], "SELECT series_id, split, count(*) AS rows FROM tsplit GROUP BY series_id, split"),
)
def q_split_sizes(spark, sf_dir):
    return SP.split_sizes(SP.split_by_time(cut_frame(spark, sf_dir)), by=[SERIES])


@register(
    "fold_cuts",
    _sql(
        _BASE + [O.fold_len_cte()],
        """SELECT DISTINCT series_id, CAST(j + 1 AS INTEGER) AS fold_id, CAST(j * step AS INTEGER) AS train_start,
       CAST(j * step + train_len AS INTEGER) AS train_end, CAST(j * step + train_len + val_len AS INTEGER) AS val_end,
       CAST(j * step + train_len + val_len + test_len AS INTEGER) AS test_end
FROM flen, range(0, 64) r(j) WHERE n_folds >= 2 AND j < n_folds""",
    ),
)
def q_fold_cuts(spark, sf_dir):
    return SP.fold_cuts(cut_frame(spark, sf_dir))


_MEMBERSHIP_SQL = _sql(_FOLDS, "SELECT series_id, bar_date, row_idx, fold_id, split FROM folded")


@register("fold_membership", _MEMBERSHIP_SQL)
def q_fold_membership(spark, sf_dir):
    return SP.fold_membership(cut_frame(spark, sf_dir)).select(SERIES, DATE, "row_idx", "fold_id", "split")


@register("fold_membership_join", _MEMBERSHIP_SQL)
def q_fold_membership_join(spark, sf_dir):
    frame = cut_frame(spark, sf_dir)
    return SP.fold_membership_join(frame, SP.fold_cuts(frame)).select(SERIES, DATE, "row_idx", "fold_id", "split")


@register(
    "split_bounds",
    _sql(
        _FOLDS,
        "SELECT series_id, fold_id, split, min(bar_date) AS start_date, max(bar_date) AS end_date, count(*) AS rows "
        "FROM folded GROUP BY series_id, fold_id, split",
    ),
)
def q_split_bounds(spark, sf_dir):
    return SP.split_bounds(SP.fold_membership(cut_frame(spark, sf_dir)))


@register(
    "train_val_union",
    _sql(_FOLDS, "SELECT fold_id, count(*) AS rows FROM folded WHERE split IN ('train', 'val') GROUP BY fold_id"),
)
def q_train_val_union(spark, sf_dir):
    tagged = SP.fold_membership(cut_frame(spark, sf_dir))
    return SP.train_and_val(tagged).groupBy("fold_id").agg(F.count(F.lit(1)).alias("rows"))


def _report_sql(ctes: list[str], seq_len: int = 20) -> str:
    """The guards over a feature frame ``train_frame`` and its bars; constants are those of the default layout."""
    least = seq_len + 30
    n, usable = "n_rows", f"CASE WHEN n_rows > {seq_len} THEN n_rows - {seq_len - 1} ELSE 0 END"
    return _sql(
        ctes,
        f"""SELECT *, CASE WHEN NOT enough_rows THEN 'fewer than {least} rows'
                WHEN NOT split_ok THEN 'an empty part in the time split'
                WHEN NOT folds_ok THEN 'fewer than 2 folds' END AS reason
FROM (
SELECT series_id, n_rows, n_rows >= {least} AS enough_rows, usable_rows,
       usable_rows >= 3 AND least(greatest(te + CAST(trunc(usable_rows * 0.15::DOUBLE) AS INTEGER), te + 1), usable_rows - 1) > te AS split_ok,
       n_folds, n_folds >= 2 AS folds_ok, greatest({n} - {seq_len - 1}, 0) AS sequences
FROM (
  SELECT *, greatest(CAST(trunc(usable_rows * 0.7::DOUBLE) AS INTEGER), 1) AS te,
         CASE WHEN remain >= 0 THEN CAST(floor(remain / step) AS INTEGER) + 1 ELSE 0 END AS n_folds
  FROM (
    SELECT *, greatest(CAST(floor(remain / 2) AS INTEGER), 20) AS step FROM (
      SELECT *, usable_rows - (greatest(least(greatest(CAST(trunc(usable_rows * 0.7::DOUBLE) AS INTEGER), 120),
                                              usable_rows - 2 * vl - 40), 120) + 2 * vl) AS remain
      FROM (
        SELECT *, greatest(CAST(trunc(usable_rows * 0.15::DOUBLE) AS INTEGER), 40) AS vl
        FROM (
          SELECT *, CAST({usable} AS INTEGER) AS usable_rows
          FROM (
            SELECT b.series_id, CAST(count(t.bar_date) AS INTEGER) AS n_rows
            FROM bars b LEFT JOIN train_frame t ON t.series_id = b.series_id AND t.bar_date = b.bar_date
            GROUP BY b.series_id
          )
        )
      )
    )
  )
))""",
    )


_UNFILTERED = [O.bars_cte("main"), O.features_cte(ddof=1), O.training_cte(min_rows=0)]
_PARTS = [O.bars_cte("main").replace("l_suppkey", "l_partkey"), *_UNFILTERED[1:]]


@register("series_report", _report_sql(_UNFILTERED))
def q_series_report(spark, sf_dir):
    """Every series of the panel against the guards, on the frame before any series is dropped."""
    bars = panel(spark, sf_dir)
    return SP.series_report(feat.finalize(feat.build_features(bars)), series=bars)


@register("short_series", _report_sql(_PARTS, seq_len=5) + " WHERE reason IS NOT NULL")
def q_short_series(spark, sf_dir):
    """Parts as series: most have too few days, and each of those is listed with the reason."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    bars = B.daily_bars(lineitem, "l_partkey", "l_shipdate", "l_extendedprice", F.col("l_quantity"), ["l_orderkey", "l_linenumber"])
    report = SP.series_report(feat.finalize(feat.build_features(bars)), seq_len=5, series=bars)
    return report.where(F.col("reason").isNotNull())


# ------------------------------------------------------------- other goals


@register(
    "threshold_goals",
    _sql(
        _PREDS
        + [
            O.sweep_cte("preds", ["fold_id", "config_idx"], TUNE.grid, 1.0, 0.56, 0.62, 1.2, name="sweep_f1"),
            O.pick_cte("sweep_f1", ["fold_id", "config_idx"], "score", "threshold", "f1", "k", 0.01, 0.5, "best_f1"),
            O.sweep_cte("preds", ["fold_id", "config_idx"], TUNE.grid, 2.0, 0.56, 0.62, 1.2, name="sweep_f2"),
            O.pick_cte("sweep_f2", ["fold_id", "config_idx"], "score", "threshold", "f1", "k", 0.01, 0.5, "best_f2"),
        ],
        "\nUNION ALL\n".join(
            f"SELECT fold_id, config_idx, threshold AS best_threshold, score AS val_score_best, f1 AS val_f1_best, '{g}' AS threshold_goal FROM best_{g}"
            for g in ("f1", "f2")
        ),
    ),
)
def q_threshold_goals(spark, sf_dir):
    """Thresholds tuned for the goals that are not the default."""
    _, preds = tuning(spark, sf_dir)
    first, second = (E.config_candidates(preds, replace(SPEC, tune=replace(TUNE, goal=g))) for g in ("f1", "f2"))
    return first.unionByName(second)


# --------------------------------------------------------------- sequences


def _small_scaled(spark, sf_dir):
    training = SP.long_enough(feat.finalize(feat.build_features(B.load_panel(spark, sf_dir, "small"))))
    tagged = SP.split_by_time(SP.with_positions(training))
    return scale_rows(tagged, FEATS, "series", by=[])


_SMALL = [
    O.bars_cte("small"), O.features_cte(ddof=1), O.training_cte(), O.positions_cte(),
    O.time_split_cte(src="pos"),
    O.scaled_cte(FEATS, "tsplit", "series_id", keep=""),
]
_STRUCT = ", ".join(f"'{f}': {f}" for f in FEATS)
_F32 = ", ".join(f"CAST(x[k].{f} AS FLOAT) AS {f}" for f in FEATS)


_WINDOWS = f"""SELECT series_id, split, end_date, CAST(k - 1 AS INTEGER) AS step, {_F32}, CAST(target_up AS FLOAT) AS y
FROM (SELECT *, unnest(generate_series(1, 20)) AS k FROM windows WHERE len(x) = 20)"""
_PLACES = f"""windows AS (
    SELECT series_id, split, bar_date AS end_date, target_up, list({{{_STRUCT}}}) OVER (
      PARTITION BY series_id, split ORDER BY bar_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS x FROM scaled
)"""


def _sequences(scaled):
    return Q.explode_sequences(Q.build_sequences(scaled, FEATS, 20, within=["split"]), FEATS, within=["split"])


@register("sequences", _sql(_SMALL + [_PLACES], _WINDOWS))
def q_sequences(spark, sf_dir):
    return _sequences(_small_scaled(spark, sf_dir))


@register("sequences_main", _sql([O.bars_cte("main"), *_SMALL[1:], _PLACES], _WINDOWS))
def q_sequences_main(spark, sf_dir):
    """The windows of every supplier: their number grows with the tables."""
    tagged = SP.split_by_time(SP.with_positions(training_frame(spark, sf_dir)))
    return _sequences(scale_rows(tagged, FEATS, "series", by=[]))


@register(
    "latest_window",
    _sql(
        [O.bars_cte("main"), O.features_cte(ddof=1), O.training_cte()],
        f"""SELECT series_id, last_date, CAST(20 - rn AS INTEGER) AS step, bar_date, {", ".join(FEATS)}
FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY bar_date DESC) AS rn,
             max(bar_date) OVER (PARTITION BY series_id) AS last_date,
             count(*) OVER (PARTITION BY series_id) AS n FROM train_frame)
WHERE rn <= 20 AND n >= 20""",
    ),
)
def q_latest_window(spark, sf_dir):
    return Q.explode_latest(Q.latest_window(training_frame(spark, sf_dir), FEATS, 20), FEATS)


# ----------------------------------------------------------------- scaling


def _scaler_sql() -> str:
    parts = []
    for f in FEATS:
        parts.append(
            f"SELECT series_id, fold_id, '{f}' AS feature, avg({f}) AS mean, "
            f"CASE WHEN stddev_pop({f}) = 0 THEN 1.0::DOUBLE ELSE stddev_pop({f}) END AS scale "
            f"FROM folded WHERE split = 'train' GROUP BY series_id, fold_id"
        )
    return _sql(_FOLDS, "\nUNION ALL\n".join(parts))


@register("scaler_fit", _scaler_sql())
def q_scaler_fit(spark, sf_dir):
    return fit_scaler(SP.fold_membership(cut_frame(spark, sf_dir)), FEATS, "series", by=["fold_id"])


@register("scaled_rows", _sql(_SCALED, f"SELECT series_id, fold_id, split, bar_date, {', '.join(FEATS)} FROM scaled"))
def q_scaled_rows(spark, sf_dir):
    return E.rolling_scaled(stored_frame(spark, sf_dir), SPEC).select(SERIES, "fold_id", "split", DATE, *FEATS)


@register("logistic_scores", _sql(_PREDS, "SELECT * FROM preds"))
def q_logistic_scores(spark, sf_dir):
    return rolling_preds(spark, sf_dir)


# --------------------------------------------------------------- metrics


@register(
    "confusion_by_fold",
    _sql(_PREDS, "SELECT fold_id, config_idx, split, tn, fp, fn, tp FROM (" + _rates_sql(0.5, 1.0) + ")"),
)
def q_confusion_by_fold(spark, sf_dir):
    return M.confusion(rolling_preds(spark, sf_dir), ["fold_id", "config_idx", "split"], 0.5)


@register("classification_metrics", _sql(_PREDS, _rates_sql(0.5, BETA)))
def q_classification_metrics(spark, sf_dir):
    return M.classification_metrics(rolling_preds(spark, sf_dir), ["fold_id", "config_idx", "split"], 0.5, beta=BETA)


@register("roc_auc", _sql(_PREDS + [O.auc_sql("preds", ["fold_id", "config_idx", "split"], "auc")], "SELECT * FROM auc"))
def q_roc_auc(spark, sf_dir):
    # Read twice (cut points, then counts): stored, not scored again.
    scores = materialize(rolling_preds(spark, sf_dir).select("fold_id", "config_idx", "split", "up_prob", "y_true"))
    return M.roc_auc(scores, ["fold_id", "config_idx", "split"])


@register(
    "roc_curve",
    _sql(
        _PREDS,
        """SELECT fold_id, config_idx, score AS threshold,
       CASE WHEN n > 0 THEN CAST(n - neg_before AS DOUBLE) / n END AS fpr,
       CASE WHEN p > 0 THEN CAST(p - pos_before AS DOUBLE) / p END AS tpr
FROM (
  SELECT *, coalesce(sum(pos) OVER w, 0) AS pos_before, coalesce(sum(neg) OVER w, 0) AS neg_before,
         sum(pos) OVER (PARTITION BY fold_id, config_idx) AS p, sum(neg) OVER (PARTITION BY fold_id, config_idx) AS n
  FROM (SELECT fold_id, config_idx, up_prob AS score, sum(y_true) AS pos, sum(1 - y_true) AS neg
        FROM preds WHERE split = 'test' GROUP BY fold_id, config_idx, up_prob)
  WINDOW w AS (PARTITION BY fold_id, config_idx ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
UNION ALL
SELECT fold_id, config_idx, 'Infinity'::DOUBLE, CASE WHEN sum(1 - y_true) > 0 THEN 0.0::DOUBLE END, CASE WHEN sum(y_true) > 0 THEN 0.0::DOUBLE END
FROM preds WHERE split = 'test' GROUP BY fold_id, config_idx""",
    ),
)
def q_roc_curve(spark, sf_dir):
    test = rolling_preds(spark, sf_dir, splits=("test",))
    return M.roc_curve(test, ["fold_id", "config_idx"])


@register(
    "brier",
    _sql(
        _PREDS,
        "SELECT fold_id, config_idx, split, avg((up_prob - y_true) * (up_prob - y_true)) AS brier_score, "
        "count(*) AS sample_count FROM preds GROUP BY fold_id, config_idx, split",
    ),
)
def q_brier(spark, sf_dir):
    return M.brier(rolling_preds(spark, sf_dir), ["fold_id", "config_idx", "split"])


@register(
    "log_loss",
    _sql(
        _PREDS,
        "SELECT fold_id, config_idx, split, avg(greatest(logit, 0.0::DOUBLE) - logit * y_true + ln(1 + exp(-abs(logit)))) AS log_loss, "
        "count(*) AS sample_count FROM preds GROUP BY fold_id, config_idx, split",
    ),
)
def q_log_loss(spark, sf_dir):
    return M.log_loss(rolling_preds(spark, sf_dir), ["fold_id", "config_idx", "split"])


# ------------------------------------------------------- threshold tuning


@register(
    "threshold_sweep",
    _sql(_SWEEP, "SELECT fold_id, config_idx, k, threshold_raw, threshold, tp, fp, fn, tn, precision, recall, f1, fbeta, score FROM sweep"),
)
def q_threshold_sweep(spark, sf_dir):
    val = rolling_preds(spark, sf_dir, splits=("val",))
    return T.threshold_sweep(val, ["fold_id", "config_idx"], TUNE)


@register("stable_threshold", _sql(_CANDS, "SELECT * FROM cands"))
def q_stable_threshold(spark, sf_dir):
    return E.config_candidates(tuning(spark, sf_dir)[1], SPEC)


@register(
    "config_choice",
    _sql(_CHOICE, "SELECT fold_id, config_idx, best_threshold, val_score_best, val_f1_best, threshold_goal FROM choice"),
)
def q_config_choice(spark, sf_dir):
    return tuned(spark, sf_dir)[3]


@register("fold_results", _sql(_FOLD_RES, "SELECT * FROM fold_res"))
def q_fold_results(spark, sf_dir):
    frame, preds, _, choice = tuned(spark, sf_dir)
    return E.fold_results(preds, choice, SPEC, sizes_from=SP.fold_membership(frame, SPEC.folds))


@register("config_stability", _sql(_STAB, "SELECT * FROM stab"))
def q_config_stability(spark, sf_dir):
    return S.config_stability(tuned(spark, sf_dir)[2], TUNE)


@register("best_config", _sql(_STAB, "SELECT * FROM best_cfg"))
def q_best_config(spark, sf_dir):
    return S.best_config(S.config_stability(tuned(spark, sf_dir)[2], TUNE))


@register(
    "final_threshold",
    _sql(
        _FOLD_RES,
        f"""SELECT median(best_threshold) AS median_threshold,
       coalesce({O.snap_sql("median(best_threshold)", TUNE.grid)}, {O.snap_sql(O._d(TUNE.anchor), TUNE.grid)}) AS final_threshold,
       CAST(count(*) AS INTEGER) AS folds
FROM fold_res""",
    ),
)
def q_final_threshold(spark, sf_dir):
    frame, preds, _, choice = tuned(spark, sf_dir)
    res = E.fold_results(preds, choice, SPEC, sizes_from=SP.fold_membership(frame, SPEC.folds))
    return T.final_threshold(res, [], TUNE)


@register(
    "fold_stability",
    _sql(
        _FOLD_RES,
        "SELECT avg(test_f1) AS rolling_avg_f1, min(test_f1) AS rolling_min_f1, stddev_pop(test_f1) AS rolling_std_f1, "
        "stddev_pop(best_threshold) AS rolling_std_threshold FROM fold_res",
    ),
)
def q_fold_stability(spark, sf_dir):
    frame, preds, _, choice = tuned(spark, sf_dir)
    res = E.fold_results(preds, choice, SPEC, sizes_from=SP.fold_membership(frame, SPEC.folds))
    from panelcast.operators.consistency import fold_stability

    return fold_stability(res)


@register(
    "error_distribution_folds",
    _sql(
        _FOLD_RES,
        """SELECT fold_id, error_type, CAST(count(*) AS BIGINT) AS count FROM (
  SELECT fold_id, CASE WHEN y_true = 0 AND up_prob >= best_threshold THEN 'false_positive'
                       WHEN y_true = 1 AND up_prob < best_threshold THEN 'false_negative' ELSE 'ok' END AS error_type
  FROM ftest) GROUP BY fold_id, error_type""",
    ),
)
def q_error_distribution_folds(spark, sf_dir):
    from panelcast.operators.errors import error_cases, error_summary
    from panelcast.operators.scoring import predict_class

    _, preds, _, choice = tuned(spark, sf_dir)
    test = preds.where(F.col("split") == "test").join(
        F.broadcast(choice.select("fold_id", "config_idx", "best_threshold")), on=["fold_id", "config_idx"]
    )
    test = test.withColumn("y_pred", predict_class(F.col("up_prob"), F.col("best_threshold")))
    summary = error_summary(error_cases(test, "best_threshold"), ["fold_id"])
    return error_distribution(summary, ["fold_id"]).where(F.col("count") > 0)
