"""Linear-logistic scoring from a coefficient table, and the class predicate.

A scorer is a small parameter table (one coefficient per feature plus an
intercept); applying it is one projection.  Several configurations are
scored in the same projection and stacked, so the rows are read once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import sigmoid


@dataclass(frozen=True)
class LinearScorer:
    config_idx: int
    coefficients: dict[str, float]
    intercept: float = 0.0
    name: str = field(default="")

    def logit(self, features: list[str]) -> Column:
        missing = sorted(set(self.coefficients) - set(features))
        if missing:
            raise ValueError(f"coefficients for unknown features: {missing}")
        total: Column = F.lit(float(self.intercept))
        for f in features:
            if f in self.coefficients:
                total = total + F.lit(float(self.coefficients[f])) * F.col(f)
        return total


# Four fixture coefficient tables over the default nine training
# columns.  They stand in for four fitted configurations so that every
# evaluation operator downstream can be checked against SQL without training.
_BASE = {
    "open": 0.05, "high": 0.10, "low": -0.10, "close": -0.30, "vol": 0.08,
    "pct_chg": -0.20, "ma5": 0.15, "ma10": 0.10, "ret_5": -0.25,
}
FIXTURE_SCORERS = [
    LinearScorer(0, dict(_BASE), 0.05, "base"),
    LinearScorer(1, {k: 0.5 * v for k, v in _BASE.items()}, 0.02, "half"),
    LinearScorer(2, {k: 2.0 * v for k, v in _BASE.items()}, -0.05, "double"),
    LinearScorer(3, {k: -v for k, v in _BASE.items()}, 0.10, "mirror"),
]


def score_rows(
    rows: DataFrame,
    features: list[str],
    scorers: list[LinearScorer],
    keep: list[str],
    label_col: str = "target_up",
) -> DataFrame:
    """``keep + [config_idx, y_true, logit, up_prob]``, one row per (row, scorer)."""
    stacked = F.explode(
        F.array(
            *[
                F.struct(F.lit(s.config_idx).alias("config_idx"), s.logit(features).alias("logit"))
                for s in scorers
            ]
        )
    )
    out = rows.select(*keep, F.col(label_col).cast("int").alias("y_true"), stacked.alias("_s"))
    return out.select(
        *keep, "_s.config_idx", "y_true", "_s.logit", sigmoid(F.col("_s.logit")).alias("up_prob")
    )


def predict_class(prob: Column, threshold: Column | float) -> Column:
    """1 when ``prob >= threshold`` (inclusive), else 0."""
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (prob >= thr).cast("int")


def score_chosen(
    rows: DataFrame,
    features: list[str],
    scorers: list[LinearScorer],
    choice: Column,
    keep: list[str],
    label_col: str = "target_up",
) -> DataFrame:
    """Score each row with one scorer picked by ``choice`` (e.g. a scalar subquery).

    One output row per input row: the chosen coefficient table is selected by
    a CASE, so the other configurations are never computed or stored.
    """
    logit = None
    for s in scorers:
        branch = s.logit(features)
        logit = F.when(choice == s.config_idx, branch) if logit is None else logit.when(choice == s.config_idx, branch)
    out = rows.select(
        *keep,
        choice.cast("int").alias("config_idx"),
        F.col(label_col).cast("int").alias("y_true"),
        logit.alias("logit"),
    )
    return out.withColumn("up_prob", sigmoid(F.col("logit")))
