"""Binary classification metrics as grouped aggregates.

Confusion counts, accuracy / precision / recall / F-beta, Brier score and
log-loss are single grouped aggregates with map-side combine.  ROC AUC and
the ROC curve need, for every distinct score, the count of negatives below
it; that prefix sum is computed without a single-partition window (see
``prefix_sums``), so one group holding a third of all rows is still spread
over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import safe_ratio
from panelcast.operators.scoring import predict_class
from panelcast.session import ensure_checkpoint_dir


def confusion(
    preds: DataFrame,
    by: list[str],
    threshold: Column | float | str,
    prob_col: str = "up_prob",
    label_col: str = "y_true",
    more: tuple[Column, ...] = (),
) -> DataFrame:
    """TN / FP / FN / TP per group at ``prob >= threshold`` (labels 0 and 1), and aggregates ``more`` of the same pass."""
    thr = F.col(threshold) if isinstance(threshold, str) else threshold
    y = F.col(label_col)
    p = predict_class(F.col(prob_col), thr)

    def n(cond: Column) -> Column:
        return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")

    return preds.groupBy(*by).agg(
        n((y == 0) & (p == 0)).alias("tn"),
        n((y == 0) & (p == 1)).alias("fp"),
        n((y == 1) & (p == 0)).alias("fn"),
        n((y == 1) & (p == 1)).alias("tp"),
        *more,
    )


def fbeta(tp: Column, fp: Column, pos: Column, beta: float) -> Column:
    """(1+b^2) TP / (b^2 (TP+FN) + TP + FP); 0 when undefined.  Exact integer terms."""
    b2 = float(beta) * float(beta)
    den = F.lit(b2) * pos.cast("double") + (tp + fp).cast("double")
    return safe_ratio(F.lit(1.0 + b2) * tp.cast("double"), den)


def with_rates(counts: DataFrame, beta: float = 1.0) -> DataFrame:
    """Add accuracy, precision, recall, f1 and fbeta to a table of tn/fp/fn/tp."""
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    pos = tp + fn
    return counts.withColumns(
        {
            "accuracy": safe_ratio(tp + tn, tp + tn + fp + fn),
            "precision": safe_ratio(tp, tp + fp),
            "recall": safe_ratio(tp, pos),
            "f1": fbeta(tp, fp, pos, 1.0),
            "fbeta": fbeta(tp, fp, pos, beta),
        }
    )


def classification_metrics(
    preds: DataFrame, by: list[str], threshold: Column | float | str, beta: float = 1.0, **kw
) -> DataFrame:
    return with_rates(confusion(preds, by, threshold, **kw), beta)


def brier(preds: DataFrame, by: list[str], prob_col: str = "up_prob", label_col: str = "y_true") -> DataFrame:
    d = F.col(prob_col) - F.col(label_col).cast("double")
    return preds.groupBy(*by).agg(F.avg(d * d).alias("brier_score"), F.count(F.lit(1)).alias("sample_count"))


def log_loss(
    preds: DataFrame,
    by: list[str],
    logit_col: str = "logit",
    label_col: str = "y_true",
    weight_col: str | None = None,
) -> DataFrame:
    """Mean binary cross-entropy with logits (stable form), optionally sample-weighted."""
    x, y = F.col(logit_col), F.col(label_col).cast("double")
    loss = F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x)))
    if weight_col is None:
        return preds.groupBy(*by).agg(F.avg(loss).alias("log_loss"), F.count(F.lit(1)).alias("sample_count"))
    w = F.col(weight_col).cast("double")
    return preds.groupBy(*by).agg(
        (F.sum(loss * w) / F.sum(w)).alias("log_loss"), F.count(F.lit(1)).alias("sample_count")
    )


# ------------------------------------------------------------ prefix sums


def prefix_sums(
    df: DataFrame,
    by: list[str],
    order_col: str,
    values: list[str],
    parts: int | None = None,
) -> DataFrame:
    """For each row, ``<v>_before`` = sum of ``v`` over rows of the same group
    with a smaller ``order_col`` (``order_col`` unique within a group).

    Distributed in two levels: the rows are range-partitioned on
    ``(by, order_col)`` (balanced by sampling, so no group or score band ends
    up in one task); per-partition totals form a table with at most
    ``groups + partitions`` rows whose running sums give each partition's
    offset; inside a partition a bounded-memory running window adds the rest.
    The ranged table is checkpointed so that both branches see the same
    partition ids.
    """
    spark = df.sparkSession
    n_parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(spark)
    # The partition id must mean the same range in both branches below.  The
    # range bounds come from sampling, and each branch would sample on its own
    # (column pruning keeps the two plans from sharing one exchange), so the
    # ranged table is frozen with a reliable checkpoint in the shared folder.
    ranged = (
        df.repartitionByRange(n_parts, *[F.col(c) for c in by], F.col(order_col))
        .withColumn("_pid", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    part_tot = ranged.groupBy(*by, "_pid").agg(*[F.sum(v).alias(f"_pt_{v}") for v in values])
    before_part = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = part_tot.select(
        *by,
        "_pid",
        *[F.coalesce(F.sum(f"_pt_{v}").over(before_part), F.lit(0)).alias(f"_off_{v}") for v in values],
    )
    inside = Window.partitionBy(*by, "_pid").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select(
        "*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_in_{v}") for v in values]
    )
    joined = local.join(offsets, on=[*by, "_pid"], how="inner")
    return joined.select(
        *[c for c in df.columns],
        *[(F.col(f"_off_{v}") + F.col(f"_in_{v}")).alias(f"{v}_before") for v in values],
    )


def score_histogram(
    preds: DataFrame, by: list[str], prob_col: str = "up_prob", label_col: str = "y_true"
) -> DataFrame:
    """Positives and negatives per distinct score (ties collapse map-side)."""
    y = F.col(label_col).cast("long")
    return preds.groupBy(*by, F.col(prob_col).alias("score")).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")
    )


#: Most score bands of ``roc_auc``: their cut points become one expression.
MOST_BANDS = 256


def _band(score: Column, cuts: list[float]) -> Column:
    """Number of cut points at or below the score, by halving."""

    def among(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(score < F.lit(cuts[mid]), among(lo, mid)).otherwise(among(mid + 1, hi))

    return among(0, len(cuts))


def roc_auc(
    preds: DataFrame, by: list[str], prob_col: str = "up_prob", label_col: str = "y_true", parts: int | None = None
) -> DataFrame:
    """Exact ROC AUC per group; ties count one half; NULL when a class is missing.

    AUC * P * N = sum over distinct scores s of pos(s) * (neg below s + neg(s)/2).
    A quantile sketch of the scores (one pass, no shuffle of scores) gives cut
    points, and a score's band is the number of cut points at or below it.  Equal
    scores are counted first (exchange 1), then hashed by (group, band), where a
    running window gives the negatives below each score inside the band
    (exchange 2).  One aggregate per (group, band) returns positives, negatives and
    the local sum; the negatives of the lower bands of a group (a running sum over
    groups x bands rows) complete the count.  Cut points only balance the bands:
    every term is an integer or a half, so the sum is exact whatever they are.
    """
    spark = preds.sparkSession
    n_bands = min(MOST_BANDS, parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
    marks = [k / n_bands for k in range(1, n_bands)]
    cuts = preds.agg(F.percentile_approx(F.col(prob_col).cast("double"), F.array(*map(F.lit, marks)), F.lit(1000))).head()[0] if marks else []
    hist = score_histogram(preds, by, prob_col, label_col).withColumn("_band", _band(F.col("score"), sorted(set(cuts or []))))
    inside = Window.partitionBy(*by, "_band").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    local = hist.withColumn("_nb", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    term = F.col("pos").cast("double") * (F.col("_nb").cast("double") + F.col("neg").cast("double") / 2.0)
    per_band = local.groupBy(*by, "_band").agg(F.sum("pos").alias("_pp"), F.sum("neg").alias("_pn"), F.sum(term).alias("_pl"))
    earlier = Window.partitionBy(*by).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    per_band = per_band.withColumn("_off", F.coalesce(F.sum("_pn").over(earlier), F.lit(0)))
    agg = per_band.groupBy(*by).agg(
        F.sum(F.col("_pl") + F.col("_off").cast("double") * F.col("_pp").cast("double")).alias("_u"),
        F.sum("_pp").alias("_p"),
        F.sum("_pn").alias("_n"),
    )
    auc = F.when(
        (F.col("_p") > 0) & (F.col("_n") > 0),
        F.col("_u") / (F.col("_p").cast("double") * F.col("_n").cast("double")),
    )
    return agg.select(*by, auc.alias("roc_auc"), F.col("_p").alias("positives"), F.col("_n").alias("negatives"))


def roc_curve(
    preds: DataFrame, by: list[str], prob_col: str = "up_prob", label_col: str = "y_true", parts: int | None = None
) -> DataFrame:
    """One ROC point per distinct score: predicting 1 for ``prob >= score`` gives (fpr, tpr).

    The point (0, 0), at which nothing is predicted 1, has an infinite threshold.
    """
    ranked = prefix_sums(score_histogram(preds, by, prob_col, label_col), by, "score", ["pos", "neg"], parts)
    # One row per group; AQE broadcasts it when small.
    y = F.col(label_col).cast("long")
    totals = preds.groupBy(*by).agg(F.sum(y).alias("_p"), F.sum(F.lit(1) - y).alias("_n"))
    j = ranked.join(totals, on=by, how="inner")
    share = lambda hits, of: F.when(F.col(of) > 0, hits / F.col(of))
    points = j.select(
        *by,
        F.col("score").alias("threshold"),
        share(F.col("_n") - F.col("neg_before"), "_n").alias("fpr"),
        share(F.col("_p") - F.col("pos_before"), "_p").alias("tpr"),
    )
    nothing = F.lit(0.0)
    start = totals.select(*by, F.lit(float("inf")).alias("threshold"), share(nothing, "_n").alias("fpr"), share(nothing, "_p").alias("tpr"))
    return points.unionByName(start)


def with_confusion_matrix(counts: DataFrame) -> DataFrame:
    """Nested ``confusion_matrix`` = [[TN, FP], [FN, TP]] for record sinks."""
    return counts.withColumn(
        "confusion_matrix",
        F.array(F.array(F.col("tn"), F.col("fp")), F.array(F.col("fn"), F.col("tp"))),
    )
