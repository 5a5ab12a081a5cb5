"""Snapshot, digests, signal store and ordered sinks."""

import datetime as dt
import os

import pytest
from conftest import daily
from pyspark.sql import functions as F

from panelcast.operators import features as feat
from panelcast.plans.prepare import prepare
from panelcast.plans.publish import EXPORT_COLUMNS
from panelcast.plans.signal_store import SignalStore
from panelcast.sources import digest as D
from panelcast.sources import store as ST
from panelcast.sources.snapshot import Snapshot


def bars_of(spark, days=120, change=None):
    """Two series with gaps: ``v`` has every third day only."""
    rows = daily(spark, [100 + (7 * k) % 13 + k / 10 for k in range(days)], series="u").unionByName(
        daily(spark, [50 + (5 * k) % 11 for k in range(days)], series="v").where("datediff(bar_date, date'2021-01-01') % 3 = 0")
    )
    return rows if change is None else change(rows)


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.fixture
def snapshot(spark, tmp_path):
    built = []

    def build(bars):
        built.append(bars.count())
        return feat.features_dataframe(bars)

    made = Snapshot(spark, str(tmp_path / "snap"), build)
    made.built = built
    return made


def test_append_recomputes_only_what_can_change(spark, snapshot):
    old, new = bars_of(spark, 100), bars_of(spark, 110)
    snapshot.refresh(old)
    got = snapshot.refresh(new)
    assert rows_of(got) == rows_of(feat.features_dataframe(new))
    # 13 new bars (10 and 3), and per series the rows that the frames reach back and one more for its label.
    assert snapshot.built == [old.count(), 13 + 2 * (feat.LOOK_BACK + 1)]
    assert snapshot.version() == 2
    assert rows_of(snapshot.refresh(new)) == rows_of(got) and len(snapshot.built) == 2  # nothing differs: nothing is built
    months = {r.month: r.version for r in spark.read.parquet(f"{snapshot.root}/v2/months").collect()}
    assert months == {"2021-01": 1, "2021-02": 1, "2021-03": 1, "2021-04": 2}
    assert rows_of(snapshot.read(1)) == rows_of(feat.features_dataframe(old))


@pytest.mark.parametrize(
    "change",
    [
        lambda b: b.withColumn("close", F.when(F.col("bar_date") == "2021-02-10", 1.0).otherwise(F.col("close"))),
        lambda b: b.where("bar_date != date'2021-03-05'"),
        lambda b: b.where("bar_date < date'2021-03-05'"),
        lambda b: b.unionByName(daily_one(b, "w")),
        lambda b: b.where("series_id = 'u'"),
        lambda b: b.where("bar_date > date'2021-01-20'"),
    ],
)
def test_any_change_equals_a_full_build(spark, snapshot, change):
    snapshot.refresh(bars_of(spark, 90))
    new = bars_of(spark, 95, change)
    assert rows_of(snapshot.refresh(new)) == rows_of(feat.features_dataframe(new))


def daily_one(bars, series):
    return bars.where("series_id = 'v'").withColumn("series_id", F.lit(series)).limit(5)


def test_broken_off_refresh_changes_nothing(spark, snapshot):
    first = snapshot.refresh(bars_of(spark, 60))
    snapshot.refresh(bars_of(spark, 70))
    os.remove(f"{snapshot.root}/v2/months/_SUCCESS")
    assert snapshot.version() == 1 and rows_of(snapshot.read()) == rows_of(first)
    new = bars_of(spark, 75)
    assert rows_of(snapshot.refresh(new)) == rows_of(feat.features_dataframe(new)) and snapshot.version() == 2


def test_digest_tree_names_what_differs(spark):
    bars = bars_of(spark, 50)
    tree = D.digest_tree(D.day_digests(bars))
    assert {r.level: r.n for r in tree.groupBy("level").agg(F.count("*").alias("n")).collect()} == {"table": 1, "year": 1, "month": 2, "day": 50}
    root = tree.where("level = 'table'").head()
    whole = ST.table_fingerprint(bars).head()
    assert (root.rows, root.digest) == (whole.rows, whole.digest)
    other = bars.repartition(3).withColumn("vol", F.when(F.col("bar_date") == "2021-02-03", 5.0).otherwise(F.col("vol"))).where("bar_date != date'2021-01-04'")
    got = {(r.level, r.node): r.status for r in D.differences(D.digest_tree(D.day_digests(other)), tree).collect()}
    assert got == {("table", ""): "changed", ("year", "2021"): "changed", ("month", "2021-01"): "changed", ("month", "2021-02"): "changed",
                   ("day", "2021-01-04"): "missing", ("day", "2021-02-03"): "changed"}
    D.check_digests(D.digest_tree(D.day_digests(bars.repartition(2))), tree)


def test_gate_refuses_before_anything_is_built(spark, snapshot):
    bars = bars_of(spark, 120)
    tree = D.digest_tree(D.day_digests(bars))
    assert prepare(bars, snapshot, tree).count() > 0
    wrong = bars.withColumn("open", F.when(F.col("bar_date") == "2021-03-03", 0.5).otherwise(F.col("open")))
    with pytest.raises(ValueError, match=r"2021-03-03 \(changed\)"):
        prepare(wrong, snapshot, tree)
    assert len(snapshot.built) == 1 and prepare(wrong, snapshot).count() > 0


def test_empty_source(spark, snapshot):
    none = bars_of(spark, 3).limit(0)
    assert snapshot.refresh(none).count() == 0
    assert snapshot.refresh(bars_of(spark, 30)).count() == bars_of(spark, 30).count()


def signals(spark, rows):
    day = dt.date(2021, 1, 5)
    schema = "series_id string, trade_date date, up_prob double, y_pred int, threshold double, config_idx int, model_version string, feature_engine string, is_stale boolean"
    return spark.createDataFrame([(s, day, p, 1, 0.5, 0, "m", "e", False) for s, p in rows], schema)


def test_signal_store_carries_the_last_good_result(spark, tmp_path):
    store = SignalStore(spark, str(tmp_path / "signals"))
    assert store.read() is None
    store.publish(signals(spark, [("a", 0.1), ("b", 0.2), ("c", None)]), "r1")
    store.publish(signals(spark, [("a", 0.3), ("b", None), ("d", 0.4)]), "r2")
    got = {r.series_id: (r.up_prob, r.run_id, r.is_carried, r.is_stale) for r in store.publish(signals(spark, [("d", 0.5)]), "r3").collect()}
    assert got == {"a": (0.3, "r2", True, True), "b": (0.2, "r1", True, True), "d": (0.5, "r3", False, False)}
    assert {r.series_id for r in store.read(1).collect()} == {"a", "b"} and store.version() == 3
    with pytest.raises(ValueError, match="r4 has no complete signal"):
        store.publish(signals(spark, [("a", None)]), "r4")
    assert store.version() == 3
    os.remove(tmp_path / "signals" / "v3" / "_SUCCESS")  # a publish that broke off is not the newest
    assert store.version() == 2 and {r.series_id for r in store.read().collect()} == {"a", "b", "d"}
    assert store.read().columns == [*EXPORT_COLUMNS, "run_id", "is_carried"]


@pytest.mark.parametrize("partitions", [1, 7])
def test_ordered_sink_reads_back_in_order(spark, tmp_path, partitions):
    df = spark.range(500).selectExpr("id", "id * 7919 % 97 as x", "if(id % 10 = 0, null, id % 13) as y").repartition(4)
    order = [F.col("y").desc_nulls_last(), F.col("x").asc(), F.col("id").asc()]
    ST.write_ordered(df, str(tmp_path / "o"), order, partitions)
    got = ST.read_ordered(spark, str(tmp_path / "o")).orderBy("position").collect()
    want = df.orderBy(*order).collect()
    assert [r.position for r in got] == list(range(500)) and [r.id for r in got] == [r.id for r in want]


def test_a_month_is_written_by_few_tasks(spark, tmp_path):
    """However many tasks hold rows of every month, and the rows are the same."""
    bars = bars_of(spark)
    made = Snapshot(spark, str(tmp_path / "snap"), lambda b: feat.features_dataframe(b).repartition(6))
    assert rows_of(made.refresh(bars)) == rows_of(feat.features_dataframe(bars))
    written = [f for f in (tmp_path / "snap" / "v1" / "data").glob("month=*/*.parquet")]
    assert len(written) == len({f.parent for f in written}) > 1


def test_days_are_digested_once(spark, snapshot, monkeypatch):
    bars = bars_of(spark)
    tree = D.digest_tree(D.day_digests(bars))
    asked, own = [], D.day_digests
    monkeypatch.setattr(D, "day_digests", lambda *a, **k: asked.append(a) or own(*a, **k))
    assert prepare(bars, snapshot, tree).count() > 0 and len(asked) == 1
