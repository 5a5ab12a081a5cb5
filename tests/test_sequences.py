import pytest

from panelcast.operators import sequences as Q


def _frame(spark, n):
    import datetime as dt

    d0 = dt.date(2021, 1, 1)
    rows = [("s", d0 + dt.timedelta(days=i), float(2 * i), float(2 * i + 1), i % 2) for i in range(n)]
    return spark.createDataFrame(rows, "series_id string, bar_date date, f0 double, f1 double, target_up int")


def test_sequence_shapes(spark):
    seqs = Q.build_sequences(_frame(spark, 30), ["f0", "f1"], 20).orderBy("end_date").collect()
    assert len(seqs) == 11
    first = seqs[0]
    assert len(first["x"]) == 20 and all(len(v) == 2 for v in first["x"])
    assert [list(v) for v in first["x"]] == [[float(2 * i), float(2 * i + 1)] for i in range(20)]
    assert first["y"] == float(19 % 2)


def test_short_series_gives_no_sequences(spark):
    assert Q.build_sequences(_frame(spark, 19), ["f0", "f1"], 20).count() == 0


def test_nonpositive_length_raises(spark):
    with pytest.raises(ValueError):
        Q.build_sequences(_frame(spark, 30), ["f0"], 0)


def test_latest_window(spark):
    rows = Q.explode_latest(Q.latest_window(_frame(spark, 30), ["f0"], 20), ["f0"]).orderBy("step").collect()
    assert len(rows) == 20 and rows[0]["f0"] == 20.0 and rows[-1]["f0"] == 58.0


def test_main_panel_windows_are_a_checked_query(spark):
    import os

    import duckdb
    from pyspark.sql import functions as F

    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    if not os.path.exists(f"{sf}/lineitem.parquet"):
        pytest.skip("test data not present")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{sf}/lineitem.parquet')")
    place = ["series_id", "split", "end_date", "step"]
    got = entry.queries()["sequences_main"](spark, sf).select(*[F.col(c).cast("string") for c in place], "close", "y").collect()
    want = con.execute(f"SELECT {', '.join(f'CAST({c} AS VARCHAR)' for c in place)}, close, y FROM ({entry.oracle_sql()['sequences_main']})").fetchall()
    assert len({r[0] for r in want}) == 10 and len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got)), sorted(want)):
        assert a[:4] == b[:4] and a[5] == b[5] and a[4] == pytest.approx(b[4], rel=1e-5, abs=1e-6)
