"""Bar tables: derive daily bars, read raw bars, clean them, bounded extracts.

A bar table is ``series_id, bar_date DATE, open, high, low, close, vol,
pct_chg`` and is unique on ``(series_id, bar_date)``.  Because ``bar_date``
is a calendar day, one series holds at most one row per day: however the
raw rows are skewed, a series has a bounded number of bars, which is what
keeps every ``PARTITION BY series_id`` window below small.
"""

from __future__ import annotations

import datetime as _dt
import re as _re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.columns import parse_date, to_double, zero_safe_return
from panelcast.schema import BAR_COLUMNS, DATE, PRICE_COLUMNS, REQUIRED_RAW, SERIES

RAW_BAR_SCHEMA = T.StructType(
    [
        T.StructField(SERIES, T.StringType()),
        T.StructField(DATE, T.StringType()),
        *[T.StructField(c, T.StringType()) for c in PRICE_COLUMNS],
    ]
)


#: Rows of a source that one task of a panel's windows should get, about: folds and scores multiply them.
ROWS_PER_TASK = 250_000


def panel_parts(rows: DataFrame) -> int:
    """Partitions of the panel built from the stored table ``rows``: they grow with it, so that no task does.

    The count comes from the Parquet footers.
    """
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_PER_TASK))


def _series_window() -> Window:
    return Window.partitionBy(SERIES).orderBy(DATE)


def with_pct_chg(daily: DataFrame, close: str = "close") -> DataFrame:
    """pct_chg = 100 * (close / previous close - 1), NULL on the first bar or a zero base."""
    prev = F.lag(close, 1).over(_series_window())
    return daily.withColumn("pct_chg", F.lit(100.0) * zero_safe_return(F.col(close), prev))


def daily_bars(
    rows: DataFrame,
    series: Column | str,
    ts: Column | str,
    price: Column | str,
    volume: Column | None,
    tie_break: list[str],
    parts: int | None = None,
) -> DataFrame:
    """Aggregate raw priced rows to one OHLCV bar per series and day.

    ``open``/``close`` are the price of the first/last row in ``tie_break``
    order (the price itself is the last key, so equal keys still give one
    answer).  With ``parts`` the rows are dealt to so many tasks by series and
    day before any is sorted: what a task sorts does not grow with the splits of
    the source, a series that owns a third of all rows is spread by its days,
    and the bars then go to ``parts`` partitions by series, which every later
    window over a series keeps.  Without, rows are combined before the shuffle,
    which has as many partitions as the session's.
    """
    series_c = F.col(series) if isinstance(series, str) else series
    ts_c = F.col(ts) if isinstance(ts, str) else ts
    price_c = F.col(price) if isinstance(price, str) else price
    vol_c = F.lit(1.0) if volume is None else volume
    key = F.struct(*[F.col(k) for k in tie_break], F.col("_price"))
    priced = rows.select(
        series_c.alias(SERIES),
        ts_c.cast("date").alias(DATE),
        price_c.cast("double").alias("_price"),
        vol_c.cast("double").alias("_vol"),
        *[F.col(k) for k in tie_break],
    ).where(F.col(DATE).isNotNull())
    if parts is not None:
        priced = priced.repartition(parts, SERIES, DATE)
    daily = priced.groupBy(SERIES, DATE).agg(
        F.min_by("_price", key).alias("open"),
        F.max("_price").alias("high"),
        F.min("_price").alias("low"),
        F.max_by("_price", key).alias("close"),
        F.sum("_vol").alias("vol"),
    )
    if parts is not None:
        daily = daily.repartition(parts, SERIES)
    return with_pct_chg(daily).select(*BAR_COLUMNS)


def bars_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Main panel: one series per supplier, one bar per ship day."""
    return daily_bars(
        lineitem,
        series="l_suppkey",
        ts="l_shipdate",
        price="l_extendedprice",
        volume=F.col("l_quantity"),
        tie_break=["l_orderkey", "l_linenumber"],
        parts=panel_parts(lineitem),
    )


def bars_from_orders(orders: DataFrame) -> DataFrame:
    """Small panel: one series per order priority, one bar per order day, vol = order count."""
    return daily_bars(
        orders,
        series="o_orderpriority",
        ts="o_orderdate",
        price="o_totalprice",
        volume=None,
        tie_break=["o_orderkey"],
    )


def load_panel(spark: SparkSession, sf_dir: str, panel: str = "main") -> DataFrame:
    if panel == "main":
        return bars_from_lineitem(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    if panel == "small":
        return bars_from_orders(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    raise ValueError(f"unknown panel {panel!r}; expected 'main' or 'small'")


# ---------------------------------------------------------------- raw input


def read_bars_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a raw bar snapshot from CSV with an explicit (all-text) schema; cleaning types it."""
    return spark.read.schema(schema or RAW_BAR_SCHEMA).option("header", True).csv(path)


def require_columns(df: DataFrame, required: list[str] | set[str], what: str = "raw data") -> None:
    """Raise before any job runs if a column is absent, naming all that are."""
    have = set(df.columns)
    if not have.issuperset(required):
        raise ValueError(f"{what} lacks these columns: {', '.join(sorted(set(required) - have))}")


def require_nonempty(df: DataFrame, what: str = "raw data") -> None:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")


def typed_bars(raw: DataFrame, series_default: str = "0") -> DataFrame:
    """Parse dates (bad ones dropped), coerce the six numerics (bad ones NULL).

    A table without ``series_id`` is one series.  Extra columns are dropped.
    """
    require_columns(raw, REQUIRED_RAW)
    types = {f.name: f.dataType.typeName() for f in raw.schema.fields}
    series = F.col(SERIES) if SERIES in raw.columns else F.lit(series_default)
    out = raw.select(
        series.alias(SERIES),
        parse_date(DATE, types.get(DATE)).alias(DATE),
        *[to_double(c, types.get(c)).alias(c) for c in PRICE_COLUMNS],
    )
    return out.where(F.col(DATE).isNotNull())


def clean_bars(raw: DataFrame, series_default: str = "0", on_duplicate: str = "raise") -> DataFrame:
    """Typed bars, one per series and day.

    ``on_duplicate`` says what to do about several bars on one day: ``raise``
    (checked before anything is returned) or ``largest`` (see ``one_bar_per_day``).
    """
    out = typed_bars(raw, series_default)
    if on_duplicate == "largest":
        return one_bar_per_day(out)
    if on_duplicate != "raise":
        raise ValueError("on_duplicate must be 'raise' or 'largest'")
    require_one_bar_per_day(out)
    return out


def duplicate_bars(bars: DataFrame) -> DataFrame:
    """(series_id, bar_date) pairs that occur more than once; must be empty."""
    return bars.groupBy(SERIES, DATE).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def require_one_bar_per_day(bars: DataFrame) -> None:
    """Raise if a series has several bars on one day: every window over a series relies on one."""
    worst = duplicate_bars(bars).orderBy(F.desc("copies")).first()
    if worst is not None:
        raise ValueError(f"series {worst[SERIES]!r} has {worst['copies']} bars on {worst[DATE]}; keep one, for instance with one_bar_per_day")


def one_bar_per_day(bars: DataFrame) -> DataFrame:
    """One bar per series and day: of several the largest by their columns, in order, so that reruns agree."""
    rest = [c for c in bars.columns if c not in (SERIES, DATE)]
    best = bars.groupBy(SERIES, DATE).agg(F.max(F.struct(*rest)).alias("_bar"))
    return best.select(*[F.col(c) if c in (SERIES, DATE) else F.col(f"_bar.{c}").alias(c) for c in bars.columns])


#: What a user may write for a day, by the shape of the text.
_BOUND_SHAPES = [
    (_re.compile(r"(\d{4})(\d{2})(\d{2})"), "YYYYMMDD"),
    (_re.compile(r"(\d{4})-(\d{1,2})-(\d{1,2})"), "YYYY-MM-DD"),
    (_re.compile(r"(\d{4})/(\d{1,2})/(\d{1,2})"), "YYYY/MM/DD"),
]


def normalize_date_bound(text: str, today: _dt.date | None = None) -> _dt.date:
    """A user's date bound as a date; ``latest`` stands for today."""
    given = text.strip()
    if given.lower() == "latest":
        return today or _dt.date.today()
    for shape, _ in _BOUND_SHAPES:
        if parts := shape.fullmatch(given):
            return _dt.date(*map(int, parts.groups()))
    raise ValueError(f"{text!r} is no date bound: write {', '.join(name for _, name in _BOUND_SHAPES)} or latest")


def extract_bounded(
    bars: DataFrame,
    series: list | None,
    start: str,
    end: str,
    columns: list[str] | None = None,
) -> DataFrame:
    """Bounded extract: series list + [start, end] + column list.

    Filters and the column list reach the Parquet scan when ``bars`` is a
    stored bar table; on a derived panel Catalyst pushes the series filter
    below the window that computes pct_chg (it is the window's partition key).
    """
    lo = normalize_date_bound(start)
    hi = normalize_date_bound(end)
    cond = F.col(DATE).between(F.lit(lo), F.lit(hi))
    if series is not None:
        cond = F.col(SERIES).isin(list(series)) & cond
    return bars.where(cond).select(*(columns or BAR_COLUMNS))
