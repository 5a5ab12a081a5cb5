import math
import random

import numpy as np
from pyspark.sql import functions as F

from panelcast.llm import topk as K

SCHEMA = "vec_id long, embedding array<float>, score string, rank int, id string"


def brute(rows, k, step):
    good = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [float(np.float32(x)) for x in v]
        good[i] = max(good.get(i, v), v)
    ints = {i: [math.floor(256 * x) for x in v] for i, v in good.items()}
    out = []
    for q in ints:
        if q % step:
            continue
        dot = lambda v: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(ints[q], v))))
        own = [(-dot(v), i) for i, v in ints.items() if i != q and len(v) == len(ints[q])]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(own)[:k])]
    return sorted(out)


def test_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], "x", 1, None) for i in range(300)]
    rows += [(1000 + i, [0.5] * 8, "tie", None, "t") for i in range(40)]
    rows += [(2000 + i, [rng.random() for _ in range(3)], None, None, None) for i in range(4)]
    rows += [(3000, None, "", 0, ""), (3010, [None] * 8, "", 0, ""), (3020, [float("nan")] * 8, "", 0, ""), (3030, [float("inf")] * 8, "", 0, ""),
             (3040, [], "", 0, ""), (3041, [], "", 0, ""), (None, [1.0] * 8, "", 0, ""), rows[0], (0, [9.0] * 8, "again", 0, ""), (3050, [1.0] * 5, "alone", 0, "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for shard_rows, query_rows in ((64, 7), (10_000, 10_000)):
        got = K.search(df, F.col("vec_id") % 10 == 0, 5, shard_rows=shard_rows, query_rows=query_rows)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, got.collect())) == brute(rows, 5, 10)


def test_huge_components_stay_exact(spark):
    rows = [(i, [3e9 * (i + 1), -1e9 * i, 1.5], "x", 1, "") for i in range(12)] + [(50, [3e38, 3e38, 0.0], "", 1, ""), (60, [3e38, -1.0, 0.0], "", 1, "")]
    got = K.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 5 == 0, 3).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 5)


def test_bounds_prune_without_loss():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 2000, (20, 6))
    x = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(0, 20, (4000, 6)))
    ids, q = np.arange(4000), x[:100]
    s = K.Search(x, ids, q, ids[:100], 5, np.full(100, K.LOWEST))
    full = (q @ x.T).astype(np.int64)
    full[np.arange(100), np.arange(100)] = K.LOWEST
    want = np.sort(full, axis=1)[:, ::-1][:, :5]
    assert (s.best == want).all()
    assert s.seen < 0.5 * full.size
    shared = K.Search(x, ids, q, ids[:100], 5, want[:, -1])
    assert (shared.best == want).all() and shared.seen <= s.seen


def test_empty_table(spark):
    assert K.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
