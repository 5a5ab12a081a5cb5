"""Signal export: the newest prediction of every series, ready to publish.

Each series contributes its latest bar scored by the final model at the
final threshold.  A series whose latest bar is older than the newest bar of
the panel keeps its last good signal and is flagged ``is_stale``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.scoring import predict_class
from panelcast.schema import DATE, SERIES

EXPORT_COLUMNS = [
    SERIES, "trade_date", "up_prob", "y_pred", "threshold", "config_idx",
    "model_version", "feature_engine", "is_stale",
]


def signal_export(
    scored: DataFrame, threshold_row: DataFrame, model_version: str, feature_engine: str
) -> DataFrame:
    """``scored`` holds ``series_id, bar_date, config_idx, up_prob`` for at least
    the newest bar of every series (the test part of the final split does);
    ``threshold_row`` is one row with ``threshold``."""
    latest_w = Window.partitionBy(SERIES).orderBy(F.col(DATE).desc())
    latest = scored.withColumn("_rn", F.row_number().over(latest_w)).where(F.col("_rn") == 1).drop("_rn")
    # Two scalars (final threshold, newest bar of the panel) as subqueries: no join.
    out = latest.withColumns(
        {
            "threshold": threshold_row.select("threshold").scalar(),
            "_panel_last": scored.agg(F.max(DATE)).scalar(),
        }
    )
    return out.select(
        SERIES,
        F.col(DATE).alias("trade_date"),
        "up_prob",
        predict_class(F.col("up_prob"), F.col("threshold")).alias("y_pred"),
        "threshold",
        "config_idx",
        F.lit(model_version).alias("model_version"),
        F.lit(feature_engine).alias("feature_engine"),
        (F.col(DATE) < F.col("_panel_last")).alias("is_stale"),
    )


def incomplete_signals(export: DataFrame) -> DataFrame:
    """Rows that must not be published: any required field missing."""
    cond = None
    for c in EXPORT_COLUMNS:
        miss = F.col(c).isNull()
        cond = miss if cond is None else (cond | miss)
    return export.where(cond)
