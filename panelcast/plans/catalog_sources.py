"""Registered queries for sources, sinks, cleaning and digests."""

from __future__ import annotations

import os
import uuid
import zlib

from pyspark.sql import functions as F

from panelcast.operators import features as feat
from panelcast.operators import splits as SP
from panelcast.operators.scaling import apply_scaler, fit_scaler
from panelcast.plans import oracle as O
from panelcast.plans.prepare import prepare
from panelcast.plans.registry import panel, panel_buckets, register
from panelcast.plans.catalog_eval import _SCALED, FEATS, stored_frame
from panelcast.schema import DATE, PRICE_COLUMNS, SERIES
from panelcast.session import ensure_checkpoint_dir, materialize
from panelcast.sources import bars as B
from panelcast.sources import digest as D
from panelcast.sources import store as ST
from panelcast.sources.snapshot import Snapshot


def raw_text_bars(spark, sf_dir):
    """The main panel as a raw text snapshot: dates in the three accepted forms
    (picked by day of month), numbers as text, plus rows from ``events`` whose
    date field is not a date (to be dropped) or whose price is not a number."""
    bars = panel(spark, sf_dir)
    d = F.col(DATE)
    text_date = (
        F.when(F.dayofmonth(d) % 3 == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(F.dayofmonth(d) % 3 == 1, F.date_format(d, "yyyy/MM/dd"))
        .otherwise(F.date_format(d, "yyyyMMdd"))
    )
    good = bars.select(
        F.col(SERIES).cast("string").alias(SERIES), text_date.alias(DATE), *[F.col(c).cast("string").alias(c) for c in PRICE_COLUMNS]
    )
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where(F.col("ts").isNotNull())
    v = F.col("value").cast("string")
    bad_date = events.select(F.lit("junk").alias(SERIES), F.col("event_type").alias(DATE), *[v.alias(c) for c in PRICE_COLUMNS])
    bad_number = events.select(
        F.lit("junk").alias(SERIES), F.date_format("ts", "yyyyMMdd").alias(DATE), F.col("props").alias("open"),
        *[v.alias(c) for c in PRICE_COLUMNS[1:]],
    )
    return good.unionByName(bad_date).unionByName(bad_number)


_CLEAN_SQL = O.with_(O.bars_cte("main")) + """SELECT CAST(series_id AS VARCHAR) AS series_id, bar_date, open, high, low, close, vol, pct_chg FROM bars
UNION ALL
SELECT 'junk', CAST(ts AS DATE), NULL::DOUBLE, max(value), max(value), max(value), max(value), max(value) FROM events
WHERE ts IS NOT NULL AND TRY_CAST(event_type AS DATE) IS NULL AND TRY_STRPTIME(event_type, '%Y%m%d') IS NULL
  AND TRY_STRPTIME(event_type, '%Y/%m/%d') IS NULL
GROUP BY CAST(ts AS DATE)
"""


@register("clean_bars", _CLEAN_SQL)
def q_clean_bars(spark, sf_dir):
    return B.clean_bars(raw_text_bars(spark, sf_dir), on_duplicate="largest")


def _scratch(spark, name: str, sf_dir: str) -> str:
    tag = f"{zlib.crc32(os.path.abspath(sf_dir).encode()):08x}"
    return os.path.join(ensure_checkpoint_dir(spark), "tables", f"{name}-{tag}")


@register("read_csv_snapshot", _CLEAN_SQL)
def q_read_csv_snapshot(spark, sf_dir):
    """Raw snapshot written as CSV, read back with an explicit text schema, cleaned."""
    path = _scratch(spark, "raw_csv", sf_dir)
    ST.write_table(raw_text_bars(spark, sf_dir), path, fmt="csv")
    raw = B.read_bars_csv(spark, path)
    B.require_columns(raw, ["bar_date", "open", "high", "low", "close", "vol", "pct_chg"])
    B.require_nonempty(raw)
    return B.clean_bars(raw, on_duplicate="largest")


def _fresh(spark, name: str) -> str:
    """A folder of its own for one run of a query."""
    return os.path.join(ensure_checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")


def _stored_panel(spark, sf_dir):
    """Bars in buckets by series, which the windows of features keep."""
    return materialize(panel(spark, sf_dir), bucket_by=[SERIES], buckets=panel_buckets(spark, sf_dir))


@register(
    "snapshot_or_rebuild",
    O.with_(O.bars_cte("main"), O.features_cte(ddof=1), O.training_cte()) + "SELECT * FROM train_frame",
)
def q_snapshot_or_rebuild(spark, sf_dir):
    """Training frame behind the digest gate, from the snapshot that earlier runs left (recomputed where the source differs)."""
    bars = _stored_panel(spark, sf_dir)
    snapshot = Snapshot(spark, _scratch(spark, "snapshot", sf_dir), feat.features_dataframe)
    return prepare(bars, snapshot, expected=materialize(D.digest_tree(D.day_digests(bars))))


@register("snapshot_append", O.with_(O.bars_cte("main"), O.features_cte(ddof=1)) + "SELECT * FROM feat")
def q_snapshot_append(spark, sf_dir):
    """A snapshot made without the last 60 days, of bars whose 200th last day was wrong, brought up to date: equal to a full build."""
    bars = _stored_panel(spark, sf_dir)
    newest = bars.agg(F.max(DATE)).head()[0]
    early = bars.where(F.col(DATE) < F.date_sub(F.lit(newest), 60))
    early = early.withColumn("close", F.when(F.col(DATE) == F.date_sub(F.lit(newest), 200), F.col("close") + 1).otherwise(F.col("close")))
    snapshot = Snapshot(spark, _fresh(spark, "snapshot"), feat.features_dataframe)
    snapshot.refresh(early)
    return snapshot.refresh(bars)


_ROW_DIGEST = """CAST('0x' || md5(concat_ws('|', CAST(series_id AS VARCHAR), CAST(bar_date AS VARCHAR),
    CAST(CAST(round(high * 10000) AS BIGINT) AS VARCHAR), CAST(CAST(round(vol * 10000) AS BIGINT) AS VARCHAR)))[1:8] AS BIGINT)"""
_DIGEST_COLUMNS = [SERIES, DATE, "high", "vol"]


@register(
    "digest_tree",
    O.with_(O.bars_cte("main"))
    + f"""SELECT level, node, count(*) AS rows, CAST(sum(d) AS BIGINT) AS digest FROM (
  SELECT unnest(['table', 'year', 'month', 'day']) AS level,
         unnest(['', strftime(bar_date, '%Y'), strftime(bar_date, '%Y-%m'), strftime(bar_date, '%Y-%m-%d')]) AS node,
         {_ROW_DIGEST} AS d FROM bars) GROUP BY level, node""",
)
def q_digest_tree(spark, sf_dir):
    """Digests of the bar panel by day, month, year and as a whole."""
    return D.digest_tree(D.day_digests(panel(spark, sf_dir), _DIGEST_COLUMNS))


@register(
    "digest_differences",
    O.with_(O.bars_cte("main"))
    + """, ends AS (SELECT min(bar_date) AS a, max(bar_date) AS z FROM bars),
gone AS (SELECT 'day' AS level, strftime(a, '%Y-%m-%d') AS node, 'missing' AS status FROM ends),
lost AS (
  SELECT 'month' AS level, strftime(a, '%Y-%m') AS node,
         CASE WHEN (SELECT count(*) FROM bars WHERE strftime(bar_date, '%Y-%m') = strftime(a, '%Y-%m') AND bar_date > a) = 0 THEN 'missing' ELSE 'changed' END AS status
  FROM ends UNION ALL
  SELECT 'year', strftime(a, '%Y'),
         CASE WHEN (SELECT count(*) FROM bars WHERE year(bar_date) = year(a) AND bar_date > a) = 0 THEN 'missing' ELSE 'changed' END
  FROM ends),
more AS (
  SELECT 'day' AS level, strftime(z, '%Y-%m-%d') AS node, 'changed' AS status FROM ends
  UNION ALL SELECT 'month', strftime(z, '%Y-%m'), 'changed' FROM ends
  UNION ALL SELECT 'year', strftime(z, '%Y'), 'changed' FROM ends
  UNION ALL SELECT 'table', '', 'changed' FROM ends)
SELECT * FROM gone UNION SELECT * FROM lost UNION SELECT * FROM more""",
)
def q_digest_differences(spark, sf_dir):
    """The panel without its first day and with other volumes on its last, against the whole: what differs, by name."""
    bars = materialize(panel(spark, sf_dir))
    ends = bars.agg(F.min(DATE).alias("a"), F.max(DATE).alias("z")).head()
    other = bars.where(F.col(DATE) > F.lit(ends.a)).withColumn("vol", F.when(F.col(DATE) == F.lit(ends.z), F.col("vol") + 1).otherwise(F.col("vol")))
    trees = [D.digest_tree(D.day_digests(x, _DIGEST_COLUMNS)) for x in (other, bars)]
    return D.differences(*trees)


@register(
    "scaler_roundtrip",
    O.with_(*_SCALED) + f"SELECT series_id, fold_id, split, bar_date, {', '.join(FEATS)} FROM scaled",
)
def q_scaler_roundtrip(spark, sf_dir):
    """Scaler fitted on train rows, stored as Parquet, reloaded and applied to every split."""
    # Read by the fit and by its application, both per series: stored once, in buckets that either keeps.
    frame = stored_frame(spark, sf_dir)
    folded = SP.fold_membership(frame)
    path = _scratch(spark, "scaler", sf_dir)
    ST.write_table(fit_scaler(folded, FEATS, "series", by=["fold_id"]), path)
    scaler = spark.read.parquet(path)
    return apply_scaler(folded, scaler, FEATS, [SERIES, "fold_id"]).select(SERIES, "fold_id", "split", DATE, *FEATS)


@register(
    "table_digest",
    O.with_(O.bars_cte("main"))
    + f"SELECT count(*) AS rows, CAST(sum({_ROW_DIGEST}) AS BIGINT) AS digest FROM bars",
)
def q_table_digest(spark, sf_dir):
    """Order-free fingerprint of the bar panel over its exact columns."""
    return ST.table_fingerprint(panel(spark, sf_dir), _DIGEST_COLUMNS)


@register("file_digest", None)
def q_file_digest(spark, sf_dir):
    """Line fingerprint of every file of the raw CSV snapshot."""
    path = _scratch(spark, "raw_csv_digest", sf_dir)
    ST.write_table(raw_text_bars(spark, sf_dir), path, fmt="csv")
    return ST.file_digests(spark, path)


@register(
    "duplicate_bars",
    "SELECT 'junk' AS series_id, CAST(ts AS DATE) AS bar_date, count(*) AS copies FROM events WHERE ts IS NOT NULL "
    "GROUP BY 2 HAVING count(*) > 1",
)
def q_duplicate_bars(spark, sf_dir):
    """Days with several raw bars: the rows that ``clean_bars`` refuses or reduces."""
    return B.duplicate_bars(B.typed_bars(raw_text_bars(spark, sf_dir)))


@register("features_bucketed", O.with_(O.bars_cte("main"), O.features_cte(ddof=1)) + "SELECT * FROM feat")
def q_features_bucketed(spark, sf_dir):
    """Bars stored once bucketed and sorted by series, then all features with no shuffle."""
    path = _scratch(spark, "bars_bucketed", sf_dir)
    name = "panelcast_bars_" + os.path.basename(path).replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bars = ST.write_bucketed(panel(spark, sf_dir), name, path, buckets, [SERIES], [SERIES, DATE])
    return feat.features_dataframe(bars)
