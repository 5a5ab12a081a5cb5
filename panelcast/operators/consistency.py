"""Consistency reports between two feature tables and between two runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import safe_ratio
from panelcast.schema import DATE, LABEL, SERIES
from panelcast.session import materialize


def join_feature_frames(
    left: DataFrame, right: DataFrame, features: list[str], label_col: str = LABEL,
    suffixes: tuple[str, str] = ("_a", "_b"), keys: list[str] | None = None,
) -> DataFrame:
    """Inner join on (series_id, bar_date) with suffixed feature and label columns."""
    keys = keys or [SERIES, DATE]
    cols = [*features, label_col]
    a = left.select(*keys, *[F.col(c).alias(c + suffixes[0]) for c in cols])
    b = right.select(*keys, *[F.col(c).alias(c + suffixes[1]) for c in cols])
    return a.join(b, on=keys, how="inner")


def feature_consistency(
    left: DataFrame, right: DataFrame, features: list[str], label_col: str = LABEL,
    names: tuple[str, str] = ("a", "b"),
) -> DataFrame:
    """One row per feature: ``column, count, mean_abs_diff, max_abs_diff,
    <a>_mean, <b>_mean, mean_rel_diff``.

    The joined rows are unpivoted once and aggregated in one grouped pass for
    all features (not one job per feature).
    """
    joined = join_feature_frames(left, right, features, label_col)
    long = joined.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(f).alias("column"),
                        F.col(f + "_a").cast("double").alias("a"),
                        F.col(f + "_b").cast("double").alias("b"),
                    )
                    for f in features
                ]
            )
        ).alias("v")
    ).select("v.column", "v.a", "v.b")
    diff = F.abs(F.col("b") - F.col("a"))
    agg = long.groupBy("column").agg(
        F.count(diff).alias("count"),
        F.avg(diff).alias("mean_abs_diff"),
        F.max(diff).alias("max_abs_diff"),
        F.avg("a").alias(f"{names[0]}_mean"),
        F.avg("b").alias(f"{names[1]}_mean"),
    )
    return agg.withColumn(
        "mean_rel_diff", F.col("mean_abs_diff") / (F.abs(F.col(f"{names[0]}_mean")) + F.lit(1e-12))
    )


def consistency_summary(
    left: DataFrame, right: DataFrame, features: list[str], label_col: str = LABEL,
    names: tuple[str, str] = ("a", "b"),
) -> DataFrame:
    """One row: both row counts, joined rows, label mismatches (a NULL on either
    side counts), mismatch rate, mean of the per-feature mean absolute
    differences, max of the per-feature maxima.

    One full outer join and one aggregate: each side is read once.
    """
    keys = [SERIES, DATE]
    cols = [*features, label_col]
    a = left.select(*keys, *[F.col(c).alias(c + "_a") for c in cols], F.lit(True).alias("_in_a"))
    b = right.select(*keys, *[F.col(c).alias(c + "_b") for c in cols], F.lit(True).alias("_in_b"))
    j = a.join(b, on=keys, how="full_outer")
    in_a = F.coalesce(F.col("_in_a"), F.lit(False))
    in_b = F.coalesce(F.col("_in_b"), F.lit(False))
    both = in_a & in_b

    def n(cond):
        return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")

    la, lb = F.col(label_col + "_a").cast("int"), F.col(label_col + "_b").cast("int")
    diffs = {f: F.abs(F.col(f + "_b").cast("double") - F.col(f + "_a").cast("double")) for f in features}
    row = j.agg(
        n(in_a).alias(f"{names[0]}_rows"),
        n(in_b).alias(f"{names[1]}_rows"),
        n(both).alias("joined_rows"),
        n(both & F.coalesce(la != lb, F.lit(True))).alias("label_mismatch_count"),
        *[F.avg(F.when(both, d)).alias(f"_mad_{i}") for i, d in enumerate(diffs.values())],
        *[F.max(F.when(both, d)).alias(f"_mx_{i}") for i, d in enumerate(diffs.values())],
    )
    k = len(features)
    mads = [F.col(f"_mad_{i}") for i in range(k)]
    total = sum((F.coalesce(m, F.lit(0.0)) for m in mads), F.lit(0.0))
    count = sum((F.when(m.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for m in mads), F.lit(0))
    mean_mad = F.when(count > 0, total / count).otherwise(F.lit(0.0))
    max_mx = F.coalesce(F.greatest(*[F.col(f"_mx_{i}") for i in range(k)]) if k > 1 else F.col("_mx_0"), F.lit(0.0))
    return row.select(
        f"{names[0]}_rows",
        f"{names[1]}_rows",
        "joined_rows",
        "label_mismatch_count",
        safe_ratio(F.col("label_mismatch_count"), F.greatest(F.col("joined_rows"), F.lit(1))).alias("label_mismatch_rate"),
        mean_mad.alias("feature_mean_abs_diff_avg"),
        max_mx.alias("feature_max_abs_diff_max"),
    )


def one_row_struct(one_row: DataFrame):
    """The single row of ``one_row`` as a struct-valued scalar subquery (no join).

    Evaluated once, before the query that uses it; NULL when the frame is empty.
    """
    return one_row.select(F.struct(*[F.col(c) for c in one_row.columns]).alias("_s")).scalar()


def combine_rows(*one_row_frames: DataFrame) -> DataFrame:
    """Put several one-row aggregates side by side as one row.

    Each frame becomes one scalar subquery returning a struct, so there is no
    join between them (a join of one-row tables would plan as a cross product).
    """
    spark = one_row_frames[0].sparkSession
    subs = [one_row_struct(df).alias(f"_s{i}") for i, df in enumerate(one_row_frames)]
    cols = [F.col(f"_s{i}.{c}").alias(c) for i, df in enumerate(one_row_frames) for c in df.columns]
    return spark.range(1).select(*subs).select(*cols)


def unpivot_metrics(row: DataFrame, metrics: list[str], value_name: str) -> DataFrame:
    return row.select(
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(value_name)) for m in metrics])
        ).alias("m")
    ).select("m.metric", f"m.{value_name}")


def run_comparison(
    run_a: DataFrame, run_b: DataFrame, metrics: list[str], names: tuple[str, str] = ("a", "b")
) -> DataFrame:
    """Two one-row metric records -> ``metric, <a>, <b>, <b>_minus_<a>``, joined on the metric name.

    Each record is stored (one row) before the join: Spark 4.1 fails to merge the
    scalar subqueries of two whole runs in one plan (ClassCastException in
    ``MergeScalarSubqueries``).
    """
    a = unpivot_metrics(materialize(run_a), metrics, names[0])
    b = unpivot_metrics(materialize(run_b), metrics, names[1])
    return a.join(b, on="metric", how="inner").withColumn(
        f"{names[1]}_minus_{names[0]}", F.col(names[1]) - F.col(names[0])
    )


def fold_stability(fold_rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean, minimum and population std of fold test F1; population std of thresholds."""
    grouped = fold_rows.groupBy(*(by or []))
    return grouped.agg(
        F.avg("test_f1").alias("rolling_avg_f1"),
        F.min("test_f1").alias("rolling_min_f1"),
        F.stddev_pop("test_f1").alias("rolling_std_f1"),
        F.stddev_pop("best_threshold").alias("rolling_std_threshold"),
    )


def consistency_order(digits: int | None = None) -> list[Column]:
    """Sink order of the per-feature report: largest mean absolute difference first (to ``digits``, if given)."""
    size = F.col("mean_abs_diff") if digits is None else F.round("mean_abs_diff", digits)
    return [size.desc_nulls_last(), F.col("column").asc()]
