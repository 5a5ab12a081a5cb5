"""Column expressions used by the operators."""

from panelcast.functions.columns import (  # noqa: F401
    EPS,
    null_if_nan,
    parse_date,
    ratio_gap,
    safe_ratio,
    sigmoid,
    snap_to_grid,
    standardise,
    to_double,
    zero_safe_return,
)
from panelcast.functions.grid import Grid  # noqa: F401
