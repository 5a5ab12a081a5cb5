"""Registered queries: name -> (spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame computed over
the whole supplied tables.  ``__spark_entry__`` exposes this registry.
"""

from __future__ import annotations

from panelcast.operators import features as feat
from panelcast.plans import oracle as O
from panelcast.schema import DATE, FEATURE_COLUMNS, LABEL, PRICE_COLUMNS, SERIES
from panelcast.sources import bars as B

from panelcast.plans.registry import REGISTRY, main_features, panel, register, training_frame  # noqa: F401


# ------------------------------------------------------------------ sources

_BARS_COLS = "series_id, bar_date, open, high, low, close, vol, pct_chg"


@register("bars_daily", O.with_(O.bars_cte("main")) + f"SELECT {_BARS_COLS} FROM bars")
def q_bars_daily(spark, sf_dir):
    return panel(spark, sf_dir, "main")


@register("bars_orders", O.with_(O.bars_cte("small")) + f"SELECT {_BARS_COLS} FROM bars")
def q_bars_orders(spark, sf_dir):
    return panel(spark, sf_dir, "small")


@register(
    "extract_bounded",
    O.with_(O.bars_cte("main"))
    + "SELECT series_id, bar_date, close, vol FROM bars WHERE bar_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'",
)
def q_extract_bounded(spark, sf_dir):
    return B.extract_bounded(panel(spark, sf_dir), None, "1996/01/01", "19991231", [SERIES, DATE, "close", "vol"])


@register(
    "extract_series",
    O.with_(O.bars_cte("main"))
    + "SELECT series_id, bar_date, open, pct_chg FROM bars WHERE series_id IN (2, 3, 5, 7, 11) AND bar_date BETWEEN DATE '1995-02-01' AND DATE '1998-03-31'",
)
def q_extract_series(spark, sf_dir):
    return B.extract_bounded(panel(spark, sf_dir), [2, 3, 5, 7, 11], "1995-2-1", "1998-03-31", [SERIES, DATE, "open", "pct_chg"])


@register(
    "label_tail_drop",
    O.with_(O.bars_cte("main"))
    + """SELECT series_id, bar_date, CAST(ahead > close AS INTEGER) AS target_up
FROM (SELECT series_id, bar_date, close, lead(close) OVER (PARTITION BY series_id ORDER BY bar_date) AS ahead FROM bars) WHERE ahead IS NOT NULL""",
)
def q_label_tail_drop(spark, sf_dir):
    """Labels with the last bar of a series, which has no next close, left out."""
    labelled = feat.build_features(panel(spark, sf_dir), label_tail="drop")
    return feat.finalize(labelled, ["close"]).select(SERIES, DATE, "target_up")


# ----------------------------------------------------------------- features

_ORACLE_FEAT = O.with_(O.bars_cte("main"), O.features_cte(ddof=1))
_ORACLE_FEAT_POP = O.with_(O.bars_cte("main"), O.features_cte(ddof=0))


def _feature_query(name: str, cols: list[str], ddof: int = 1):
    src = _ORACLE_FEAT if ddof == 1 else _ORACLE_FEAT_POP

    @register(name, src + f"SELECT series_id, bar_date, {', '.join(cols)} FROM feat")
    def q(spark, sf_dir):
        f = feat.features_dataframe(panel(spark, sf_dir), ddof=ddof)
        return f.select(SERIES, DATE, *cols)

    return q


_feature_query("returns", ["pct_chg", "ret_1", "ret_3", "ret_5"])
_feature_query("moving_averages", ["close", "ma5", "ma10", "ma20"])
_feature_query("volatility_sample", ["volatility_5", "volatility_10", "volatility_20"])
_feature_query("volatility_population", ["volatility_5", "volatility_10", "volatility_20"], ddof=0)
_feature_query(
    "price_structure",
    ["intraday_range", "overnight_gap", "close_ma5_gap", "close_ma10_gap", "close_ma20_gap", "close_pos_in_day"],
)
_feature_query("volume_features", ["vol", "vol_ma5", "vol_ma20", "vol_ratio_5_20"])
_feature_query("label_next_up", ["close", LABEL])

_ALL = ", ".join(PRICE_COLUMNS + FEATURE_COLUMNS + [LABEL])


@register("features_dataframe", _ORACLE_FEAT + f"SELECT series_id, bar_date, {_ALL} FROM feat")
def q_features_dataframe(spark, sf_dir):
    return feat.features_dataframe(panel(spark, sf_dir))


@register("features_sql", _ORACLE_FEAT_POP + f"SELECT series_id, bar_date, {_ALL} FROM feat")
def q_features_sql(spark, sf_dir):
    return feat.features_sql(panel(spark, sf_dir))


@register(
    "training_frame",
    O.with_(O.bars_cte("main"), O.features_cte(ddof=1), O.training_cte())
    + "SELECT * FROM train_frame",
)
def q_training_frame(spark, sf_dir):
    return training_frame(spark, sf_dir)


# Evaluation queries register themselves on import.
from panelcast.plans import catalog_eval  # noqa: E402,F401
from panelcast.plans import catalog_final  # noqa: E402,F401
from panelcast.plans import catalog_models  # noqa: E402,F401
from panelcast.plans import catalog_sources  # noqa: E402,F401
