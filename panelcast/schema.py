"""Column names shared by the operators."""

from __future__ import annotations

SERIES = "series_id"
DATE = "bar_date"
PRICE_COLUMNS = ["open", "high", "low", "close", "vol", "pct_chg"]
BAR_COLUMNS = [SERIES, DATE, *PRICE_COLUMNS]
# Columns a raw bar table must carry (the series key is optional, as in the
# reference: a table without it is one series).
REQUIRED_RAW = [DATE, "open", "high", "low", "close", "vol", "pct_chg"]

# The 18 derived feature names, in the order the reference builds them.
FEATURE_COLUMNS = [
    "ma5", "ma10", "ma20",
    "ret_1", "ret_3", "ret_5",
    "volatility_5", "volatility_10", "volatility_20",
    "intraday_range", "overnight_gap",
    "close_ma5_gap", "close_ma10_gap", "close_ma20_gap", "close_pos_in_day",
    "vol_ma5", "vol_ma20", "vol_ratio_5_20",
]
# The reference's default training columns and label name.
DEFAULT_FEATURES = ["open", "high", "low", "close", "vol", "pct_chg", "ma5", "ma10", "ret_5"]
LABEL = "target_up"
SEQUENCE_LENGTH = 20

ROW_IDX = "row_idx"
N_ROWS = "n_rows"
