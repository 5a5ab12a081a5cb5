"""Independent DuckDB SQL for the registered queries.

These statements are written directly against the raw test tables (views
``lineitem``, ``orders``, ...), without any code from the Spark side, so a
match is evidence that both implement the same semantics.  Shared CTE text is
composed with small Python helpers.
"""

from __future__ import annotations

from panelcast.functions.grid import Grid

W = "PARTITION BY series_id ORDER BY bar_date"

# -------------------------------------------------------------------- bars


def bars_cte(panel: str = "main") -> str:
    if panel == "main":
        daily = """
    SELECT l_suppkey AS series_id, CAST(l_shipdate AS DATE) AS bar_date,
           min_by(l_extendedprice, row(l_orderkey, l_linenumber, l_extendedprice)) AS open,
           max(l_extendedprice) AS high,
           min(l_extendedprice) AS low,
           max_by(l_extendedprice, row(l_orderkey, l_linenumber, l_extendedprice)) AS close,
           sum(l_quantity)::DOUBLE AS vol
    FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2"""
    else:
        daily = """
    SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS bar_date,
           min_by(o_totalprice, row(o_orderkey, o_totalprice)) AS open,
           max(o_totalprice) AS high,
           min(o_totalprice) AS low,
           max_by(o_totalprice, row(o_orderkey, o_totalprice)) AS close,
           count(*)::DOUBLE AS vol
    FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2"""
    return f"""daily AS ({daily}
),
bars AS (
    SELECT series_id, bar_date, open, high, low, close, vol,
           100.0::DOUBLE * (close / NULLIF(lag(close) OVER (PARTITION BY series_id ORDER BY bar_date), 0.0::DOUBLE) - 1.0::DOUBLE) AS pct_chg
    FROM daily
)"""


def _gate(fn: str, x: str, n: int) -> str:
    frame = f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    if fn == "avg":
        # The mean of the last n values, summed oldest first.
        total = f"lag({x}, {n - 1}) OVER ({W})"
        for back in range(n - 2, 0, -1):
            total = f"({total} + lag({x}, {back}) OVER ({W}))"
        total = f"({total} + {x})"
        return f"CASE WHEN count({x}) OVER {frame} >= {n} THEN {total} / {n}.0::DOUBLE END"
    return f"CASE WHEN count({x}) OVER {frame} >= {n} THEN {fn}({x}) OVER {frame} END"


def features_cte(ddof: int = 1, src: str = "bars", name: str = "feat") -> str:
    """All 18 features + label over ``src`` (DuckDB)."""
    std = "stddev_samp" if ddof == 1 else "stddev_pop"
    eps = "1e-9::DOUBLE"
    return f"""{name}_a AS (
    SELECT series_id, bar_date, open, high, low, close, vol, pct_chg,
           lag(close, 1) OVER ({W}) AS close_prev,
           {_gate("avg", "close", 5)} AS ma5,
           {_gate("avg", "close", 10)} AS ma10,
           {_gate("avg", "close", 20)} AS ma20,
           close / NULLIF(lag(close, 1) OVER ({W}), 0.0::DOUBLE) - 1.0::DOUBLE AS ret_1,
           close / NULLIF(lag(close, 3) OVER ({W}), 0.0::DOUBLE) - 1.0::DOUBLE AS ret_3,
           close / NULLIF(lag(close, 5) OVER ({W}), 0.0::DOUBLE) - 1.0::DOUBLE AS ret_5,
           {_gate("avg", "vol", 5)} AS vol_ma5,
           {_gate("avg", "vol", 20)} AS vol_ma20,
           CAST(CASE WHEN lead(close, 1) OVER ({W}) > close THEN 1 ELSE 0 END AS INTEGER) AS target_up
    FROM {src}
),
{name} AS (
    SELECT series_id, bar_date, open, high, low, close, vol, pct_chg,
           ma5, ma10, ma20, ret_1, ret_3, ret_5,
           {_gate(std, "ret_1", 5)} AS volatility_5,
           {_gate(std, "ret_1", 10)} AS volatility_10,
           {_gate(std, "ret_1", 20)} AS volatility_20,
           (high - low) / (abs(close) + {eps}) AS intraday_range,
           (open - close_prev) / (abs(close_prev) + {eps}) AS overnight_gap,
           (close - ma5) / (abs(ma5) + {eps}) AS close_ma5_gap,
           (close - ma10) / (abs(ma10) + {eps}) AS close_ma10_gap,
           (close - ma20) / (abs(ma20) + {eps}) AS close_ma20_gap,
           (close - low) / (abs(high - low) + {eps}) AS close_pos_in_day,
           vol_ma5, vol_ma20,
           vol_ma5 / (abs(vol_ma20) + {eps}) AS vol_ratio_5_20,
           target_up
    FROM {name}_a
)"""


DEFAULT_FEATURES = ["open", "high", "low", "close", "vol", "pct_chg", "ma5", "ma10", "ret_5"]


def training_cte(features: list[str] | None = None, src: str = "feat", name: str = "train_frame", min_rows: int = 50) -> str:
    feats = features or DEFAULT_FEATURES
    cols = ", ".join(feats)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in feats + ["target_up"])
    return f"""{name} AS (
    SELECT * EXCLUDE (n_series) FROM (
        SELECT series_id, bar_date, {cols}, target_up, count(*) OVER (PARTITION BY series_id) AS n_series
        FROM {src} WHERE {nn}
    ) WHERE n_series >= {min_rows}
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def grid_sql(grid: Grid) -> str:
    """Grid points as rows (k, thr) in DuckDB, same double arithmetic."""
    lo, step = f"{grid.lo!r}::DOUBLE", f"{grid.step!r}::DOUBLE"
    return (
        f"SELECT k::INTEGER AS k, {lo} + k::DOUBLE * (({lo} + {step}) - {lo}) AS thr "
        f"FROM range(0, {grid.size}) t(k)"
    )


# ---------------------------------------------------------------- splits

L = 20  # sequence length used by the registered queries


def positions_cte(src: str = "train_frame", name: str = "pos") -> str:
    return f"""{name} AS (
    SELECT *, CAST(row_number() OVER ({W}) - 1 AS INTEGER) AS row_idx,
           CAST(count(*) OVER (PARTITION BY series_id) AS INTEGER) AS n_rows
    FROM {src}
)"""


def cut_cte(src: str = "pos", name: str = "cut") -> str:
    return f"""{name} AS (
    SELECT * REPLACE (row_idx - {L - 1} AS row_idx, n_rows - {L - 1} AS n_rows)
    FROM {src} WHERE n_rows > {L} AND row_idx >= {L - 1}
)"""


def _trunc(expr: str, ratio: float) -> str:
    return f"CAST(trunc({expr} * {ratio!r}::DOUBLE) AS INTEGER)"


def time_split_cte(src: str = "cut", name: str = "tsplit") -> str:
    return f"""{name}_b AS (
    SELECT *, greatest({_trunc("n_rows", 0.7)}, 1) AS te FROM {src}
),
{name}_c AS (
    SELECT *, least(greatest(te + {_trunc("n_rows", 0.15)}, te + 1), n_rows - 1) AS ve FROM {name}_b
),
{name} AS (
    SELECT * EXCLUDE (te, ve),
           CASE WHEN row_idx < te THEN 'train' WHEN row_idx < ve THEN 'val' ELSE 'test' END AS split
    FROM {name}_c WHERE n_rows >= 3 AND ve > te
)"""


def fold_len_cte(src: str = "cut", name: str = "flen") -> str:
    return f"""{name}_a AS (
    SELECT *, greatest({_trunc("n_rows", 0.15)}, 40) AS val_len,
              greatest({_trunc("n_rows", 0.15)}, 40) AS test_len,
              greatest({_trunc("n_rows", 0.7)}, 120) AS train_len0
    FROM {src}
),
{name}_b AS (
    SELECT *, greatest(least(train_len0, n_rows - val_len - test_len - 40), 120) AS train_len FROM {name}_a
),
{name}_c AS (
    SELECT *, n_rows - (train_len + val_len + test_len) AS remain FROM {name}_b
),
{name}_d AS (
    SELECT *, greatest(CAST(floor(remain / 2) AS INTEGER), 20) AS step FROM {name}_c
),
{name} AS (
    SELECT *, CASE WHEN remain >= 0 THEN CAST(floor(remain / step) AS INTEGER) + 1 ELSE 0 END AS n_folds FROM {name}_d
)"""


def folded_cte(src: str = "flen", name: str = "folded") -> str:
    """Brute force: every row against every candidate fold number."""
    return f"""{name} AS (
    SELECT f.* EXCLUDE (val_len, test_len, train_len0, train_len, remain, step, n_folds),
           CAST(j + 1 AS INTEGER) AS fold_id,
           CASE WHEN row_idx - j * step < train_len THEN 'train'
                WHEN row_idx - j * step < train_len + val_len THEN 'val' ELSE 'test' END AS split
    FROM {src} f, range(0, 64) r(j)
    WHERE n_folds >= 2 AND j < n_folds
      AND row_idx >= j * step AND row_idx < j * step + train_len + val_len + test_len
)"""


def scaled_cte(features: list[str], src: str, by: str, name: str = "scaled", keep: str = "") -> str:
    """Standardise with mean / population std of the group's train rows (0 -> 1)."""
    cols = []
    for f in features:
        m = f"avg(CASE WHEN split = 'train' THEN {f} END) OVER g"
        s = f"stddev_pop(CASE WHEN split = 'train' THEN {f} END) OVER g"
        cols.append(f"({f} - {m}) / (CASE WHEN {s} = 0 THEN 1.0::DOUBLE ELSE {s} END) AS {f}")
    return f"""{name} AS (
    SELECT series_id, {keep} split, bar_date, target_up, {", ".join(cols)}
    FROM {src} WINDOW g AS (PARTITION BY {by})
)"""


def scores_cte(scorers, features: list[str], src: str, keep: str, name: str = "preds") -> str:
    parts = []
    for s in scorers:
        expr = f"{float(s.intercept)!r}::DOUBLE"
        for f in features:
            if f in s.coefficients:
                expr = f"({expr} + {float(s.coefficients[f])!r}::DOUBLE * {f})"
        parts.append(
            f"SELECT {keep}, CAST({s.config_idx} AS INTEGER) AS config_idx, CAST(target_up AS INTEGER) AS y_true, {expr} AS logit FROM {src}"
        )
    union = "\n    UNION ALL\n    ".join(parts)
    return f"""{name}_l AS (
    {union}
),
{name} AS (
    SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-logit)) AS up_prob FROM {name}_l
)"""


def _d(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


def _ratio(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) = 0 THEN 0.0::DOUBLE ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END"


def _fbeta(beta: float, tp="tp", fp="fp", pos="pos") -> str:
    b2 = float(beta) * float(beta)
    return _ratio(f"{_d(1.0 + b2)} * CAST({tp} AS DOUBLE)", f"{_d(b2)} * CAST({pos} AS DOUBLE) + CAST({tp} + {fp} AS DOUBLE)")


def sweep_cte(src: str, by: list[str], grid: Grid, beta: float, min_p: float, min_r: float, pen: float,
              where: str = "split = 'val'", name: str = "sweep") -> str:
    """Brute force: every prediction against every grid point."""
    keys = ", ".join(f"p.{k}" for k in by)
    gsql = grid_sql(grid)
    prec = _ratio("tp", "tp + fp")
    rec = _ratio("tp", "pos")
    return f"""{name}_g AS ({gsql}),
{name}_c AS (
    SELECT {keys}, g.k, g.thr,
           sum(CASE WHEN p.up_prob >= g.thr AND p.y_true = 1 THEN 1 ELSE 0 END) AS tp,
           sum(CASE WHEN p.up_prob >= g.thr AND p.y_true = 0 THEN 1 ELSE 0 END) AS fp,
           sum(p.y_true) AS pos, sum(1 - p.y_true) AS neg
    FROM {src} p, {name}_g g WHERE {where.replace("split", "p.split")}
    GROUP BY {keys}, g.k, g.thr
),
{name}_r AS (
    SELECT {", ".join(by)}, k, thr AS threshold_raw, round(thr, 2) AS threshold,
           CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
           CAST(pos - tp AS BIGINT) AS fn, CAST(neg - fp AS BIGINT) AS tn,
           {prec} AS precision, {rec} AS recall,
           {_fbeta(1.0)} AS f1, {_fbeta(beta)} AS fbeta
    FROM {name}_c
),
{name} AS (
    SELECT *, fbeta - ((CASE WHEN precision < {_d(min_p)} THEN {_d(pen)} * ({_d(min_p)} - precision) ELSE 0.0::DOUBLE END)
                     + (CASE WHEN recall < {_d(min_r)} THEN {_d(pen)} * ({_d(min_r)} - recall) ELSE 0.0::DOUBLE END)) AS score
    FROM {name}_r
)"""


def pick_cte(src: str, by: list[str], score: str, thr: str, f1: str, order: str, eps: float, anchor: float,
             name: str) -> str:
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    return f"""{name} AS (
    SELECT * EXCLUDE (top, rn) FROM (
        SELECT *, row_number() OVER ({part} ORDER BY abs({thr} - {_d(anchor)}), {score} DESC, {f1} DESC, {order}) AS rn
        FROM (SELECT *, max({score}) OVER ({part}) AS top FROM {src})
        WHERE {score} >= top - {_d(eps)}
    ) WHERE rn = 1
)"""


def snap_sql(x: str, grid: Grid) -> str:
    lo, hi, st = _d(grid.lo), _d(grid.hi), _d(grid.step)
    clipped = f"least(greatest({x}, {lo}), {hi})"
    snapped = f"({lo} + round_even(({clipped} - {lo}) / {st}, 0) * {st})"
    return f"round(least(greatest({snapped}, {lo}), {hi}), 2)"


def auc_sql(src: str, by: list[str], name: str) -> str:
    """AUC from distinct-score counts and a running count of negatives."""
    keys = ", ".join(by)
    part = f"PARTITION BY {keys}" if by else ""
    return f"""{name}_h AS (
    SELECT {keys + "," if by else ""} up_prob AS score, sum(y_true) AS pos, sum(1 - y_true) AS neg FROM {src}
    GROUP BY {keys + "," if by else ""} up_prob
),
{name}_c AS (
    SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before
    FROM {name}_h
),
{name} AS (
    SELECT {keys + "," if by else ""}
           CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
             sum(CAST(pos AS DOUBLE) * (CAST(neg_before AS DOUBLE) + CAST(neg AS DOUBLE) / 2.0::DOUBLE))
             / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS roc_auc,
           CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
    FROM {name}_c {"GROUP BY " + keys if by else ""}
)"""
