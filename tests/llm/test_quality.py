import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from panelcast.llm import quality as Q

SCHEMA = "doc_id long, text string, lang string, quality string, bits double"
SF = "/root/testdata/sf0.1"


def brute(trusted, everything):
    """Interpolated modified Kneser-Ney over plain dictionaries; bits per symbol of every text."""
    letters = [c for c, _ in sorted(Counter(x for t in everything for x in t or "").items(), key=lambda e: (-e[1], ord(e[0])))][: Q.OTHER - 1]
    code = {c: k + 1 for k, c in enumerate(letters)}
    symbols = lambda t: [0] * (Q.ORDER - 1) + [code.get(c, Q.OTHER) for c in t]
    counts = {Q.ORDER: Counter()}
    for t in trusted:
        s = symbols(t or "")
        counts[Q.ORDER].update(tuple(s[k : k + Q.ORDER]) for k in range(len(s) - Q.ORDER + 1))
    for k in range(Q.ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cuts, total, spare = {}, defaultdict(int), defaultdict(float)
    for k, c in counts.items():
        n = [sum(v == j for v in c.values()) for j in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        cuts[k] = [max(0.1, j - (j + 1) * y * n[j] / n[j - 1]) if n[j - 1] else 0.1 for j in (1, 2, 3)]
        for g, v in c.items():
            total[g[:-1]] += v
            spare[g[:-1]] += min(v, cuts[k][min(v, 3) - 1])

    def p(g):
        if not g:
            return 1 / Q.SYMBOLS
        c, t = counts[len(g)].get(g, 0), total.get(g[:-1], 0)
        if not t:
            return p(g[1:])
        return (c - min(c, cuts[len(g)][min(c, 3) - 1]) if c else 0) / t + spare[g[:-1]] / t * p(g[1:])

    out = []
    for t in everything:
        s = symbols(t or "")
        costs = [-math.log2(p(tuple(s[k : k + Q.ORDER]))) for k in range(len(s) - Q.ORDER + 1)]
        out.append(sum(costs) / len(costs) if costs else None)
    return out


def test_perplexities_equal_a_plain_model(spark):
    rng = random.Random(1)
    words = ["the", "of", "thé", "ñu", "and", "in", "😀", "x" * 30]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(60)] + [None, "", "ZZZ### ###", "".join(map(chr, range(300, 420)))]
    rows = [(k, t, rng.choice(["en", None]), "x", 1.0) for k, t in enumerate(texts)] + [(None, "the and", "en", None, None), (1, "again the same id", "en", "", 0.0)]
    labels = [(k, int(k % 3 > 0)) for k in range(50)] + [(1, 1), (2, 0), (None, 1)]
    good = {k for k, _ in labels if k is not None and all(q for j, q in labels if j == k)}
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = Q.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int"), least=5, quantile=0.9)
    assert got.columns == ["doc_id", "lang", "perplexity", "threshold", "keep"]
    fold = {r.doc_id: r.f for r in docs.select("doc_id", Q._fold(F.col("doc_id")).alias("f")).collect()}
    by_fold = [brute([r[1] for r in rows if r[0] in good and fold[r[0]] == f], [r[1] for r in rows]) for f in (0, 1)]
    want = [by_fold[1 - fold[r[0]]][k] for k, r in enumerate(rows)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or 0)
    have = sorted(((r.doc_id, r.perplexity) for r in got.collect()), key=key)
    for (i, a), (j, b) in zip(have, sorted(((r[0], None if w is None else 2**w) for r, w in zip(rows, want)), key=key), strict=True):
        assert i == j and (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-4))
    assert all(r.keep == (r.perplexity is None or r.threshold is None or r.perplexity <= r.threshold) for r in got.collect())


def test_rejects_junk_and_keeps_good_text(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    # Limits and counts come from one half of the labels, the rates from the other.
    half = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)) == 0
    got = Q.classify(docs, labels.filter(half)).join(labels.filter(~half), "doc_id")
    rate = {r.quality: r.k for r in got.groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("k")).collect()}
    assert rate[1] > 0.985 and rate[0] < 0.2


def test_kept_rows_are_whole(spark):
    rows = [(k, "the text of a document " * 4, "en", "q", float(k)) for k in range(40)] + [(50, "#@!%&*~^|" * 20, "en", "q", None), (51, None, None, None, None)]
    labels = spark.createDataFrame([(k, 1) for k in range(40)], "doc_id long, quality int")
    out = Q.keep_good(spark.createDataFrame(rows, SCHEMA), labels)
    assert out.columns == ["doc_id", "text", "lang", "quality", "bits"]
    # 180 characters of junk: longer than any trusted text, so the language's limit counts.
    assert {r.doc_id for r in out.collect()} == {*range(40), 51}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.classify(none, labels).count() == 0
    some = spark.createDataFrame([(1, "text", "en", "", 0.0)], SCHEMA)
    assert [r.keep for r in Q.classify(some, labels).collect()] == [True]


def test_rare_characters_are_told_apart():
    """Characters beyond the alphabet get symbols of their own, near and far code points alike."""
    import numpy as np
    import pyarrow as pa

    from panelcast.llm import quality as Q

    table = Q._symbol_table([ord(c) for c in "etaoin"])
    texts = ["te", "tée", "tüe", "t\u4e2de", "t\u4e2ee", "t\U0010fffde", "", None]
    gram, rows, chars = Q._grams(pa.array(texts), table, spell=True)
    assert chars.tolist() == [2, 3, 3, 3, 3, 3, 0, 0]
    assert np.diff(rows).tolist() == [2, 5, 5, 8, 8, 8, 0, 0]
    parts = [tuple((gram[a:b] % Q.SYMBOLS).tolist()) for a, b in zip(rows, rows[1:])]
    assert parts[0] == (2, 1) and len(set(parts[:6])) == 6
    assert all(0 < s < Q.SYMBOLS for p in parts for s in p)


def test_costs_hold_rows_of_seen_contexts_only():
    import numpy as np

    rng, parts = np.random.default_rng(3), {}
    for k in range(1, Q.ORDER + 1):
        g = np.sort(rng.choice(Q.SYMBOLS**k, min(Q.SYMBOLS**k // 2, 5000), replace=False))
        x = np.unique(g // Q.SYMBOLS)
        parts[k] = ((g, rng.random(len(g)).astype(np.float32)), (x, rng.random(len(x)).astype(np.float32)))
    known = {k: (dict(zip(*map(np.ndarray.tolist, parts[k][0]))), dict(zip(*map(np.ndarray.tolist, parts[k][1])))) for k in parts}

    def p(k, g):
        if not k:
            return 1 / Q.SYMBOLS
        seen, weights = known[k]
        return seen[g] if g in seen else weights.get(g // Q.SYMBOLS, 1.0) * p(k - 1, g % Q.SYMBOLS ** (k - 1))

    costs = Q.Costs(parts)
    grams = np.concatenate([parts[Q.ORDER][0][0][:500], parts[Q.ORDER][1][0][:500] * Q.SYMBOLS + 7, rng.integers(0, Q.SYMBOLS**Q.ORDER, 1000)])
    assert np.allclose(costs.of(grams.astype(np.int32)), [-math.log2(p(Q.ORDER, g)) for g in grams.tolist()], rtol=1e-5)
    assert costs.cost.nbytes < 4 << 20  # of 64 MB


def test_whole_model_equals_a_plain_one(spark, monkeypatch):
    """With every character as a symbol, rare ones of any script have the context of three characters."""
    rng = random.Random(4)
    words = ["the", "of", "thé", "ñu", "数据", "处理系统", "😀", "да", "x" * 30, "".join(map(chr, range(33, 110)))]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(30))) for _ in range(60)] + [None, "", "\u0001", "".join(map(chr, range(300, 420)))]
    rows = [(k, t, "en", "x", 1.0) for k, t in enumerate(texts)] + [(3, texts[3], "en", "x", 1.0), (None, "the 数据", "en", None, None)]
    good = {k for k in range(50) if k % 3}
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = Q.classify(docs, spark.createDataFrame([(k, 1) for k in good], "doc_id long, quality int"), least=5, whole=True)
    fold = {r.doc_id: r.f for r in docs.select("doc_id", Q._fold(F.col("doc_id")).alias("f")).collect()}
    with monkeypatch.context() as m:
        m.setattr(Q, "OTHER", 0x110000)
        m.setattr(Q, "SYMBOLS", 1 + len({c for r in rows for c in r[1] or ""}))
        by_fold = [brute([r[1] for r in rows if r[0] in good and fold[r[0]] == f], [r[1] for r in rows]) for f in (0, 1)]
    want = [by_fold[1 - fold[r[0]]][k] for k, r in enumerate(rows)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or 0)
    have = sorted(((r.doc_id, r.perplexity) for r in got.collect()), key=key)
    for (i, a), (j, b) in zip(have, sorted(((r[0], None if w is None else 2**w) for r, w in zip(rows, want)), key=key), strict=True):
        assert i == j and (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-4))


def test_registered_model_tells_junk_in_any_script(spark, tmp_path):
    """Characters outside the 62 most frequent of the corpus: good text and the same characters shuffled."""
    from panelcast.llm.registry import QUERIES

    rng = random.Random(5)
    signs = [chr(0x4E00 + 7 * k) for k in range(120)]
    words = ["".join(rng.sample(signs, 4)) for _ in range(60)]
    latin = "".join(map(chr, range(33, 127)))
    chinese = lambda: "".join(rng.choice(words) for _ in range(20))
    good = [(k, chinese(), "zh") for k in range(300)]
    junk = [(1000 + k, "".join(rng.sample(t := chinese(), len(t))), "zh") for k in range(50)]
    other = [(2000 + k, "".join(rng.choices(latin, k=400)), "en") for k in range(300)]
    spark.createDataFrame(good + junk + other, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1) for k in range(250)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in QUERIES["op6_quality_classifier"][0](spark, str(tmp_path)).filter("keep").collect()}
    assert sum(k < 300 for k in kept) > 290 and not any(1000 <= k < 1050 for k in kept)
    docs, labels = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    assert sorted(r.doc_id for r in Q.keep_good(docs, labels, whole=True).collect()) == sorted(kept)
