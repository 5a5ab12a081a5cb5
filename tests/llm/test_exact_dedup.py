from pyspark.sql import functions as F

from panelcast.llm import exact_dedup as X

SCHEMA = "doc_id long, text string, keep_id string, kept int"
ROWS = [(1, "a", "x", 1), (2, "a", "y", None), (3, None, None, 2), (4, "", "z", 3), (5, "b" * 200_000, "x", 1),
        (2, "a", "y", None), (None, "a", "q", 4), (None, "c", None, None), (6, "A", "w", 5)]


def brute(rows, keep=max):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = keep(known) if known else None
        stays = True
        for i in ids:
            kept = i == best and stays
            stays = stays and not kept
            out.append((i, best, len(ids), kept, t))
    return out


def got(df):
    return sorted(map(str, ((r[0], r[1], r[2], r[3]) for r in df.collect())))


def want(rows, keep=max):
    return sorted(map(str, (r[:4] for r in brute(rows, keep))))


def test_marks_equal_brute_force_with_nulls_ties_and_extra_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert got(X.mark_duplicates(df)) == want(ROWS)
    assert got(X.mark_duplicates(df, keep="smallest")) == want(ROWS, min)


def test_colliding_hashes_are_split_by_bytes(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    weak = lambda t: F.substring(F.md5(t), 1, 0)
    assert got(X.mark_duplicates(df, hash_of=weak)) == want(ROWS)


def test_drop_duplicates_keeps_whole_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = X.drop_duplicates(df)
    assert out.columns == df.columns
    rows = {(r[0], r[1]) for r in out.collect()}
    assert rows == {(2, "a"), (4, ""), (5, "b" * 200_000), (None, "c"), (6, "A")}
    assert out.count() == 5


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert X.mark_duplicates(df).count() == 0
    assert X.drop_duplicates(df).count() == 0
