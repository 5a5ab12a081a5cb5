import random
import re
from collections import Counter

import pytest

from panelcast.llm import phrases as P

SCHEMA = "doc_id long, text string, lang string, words string, f string, phrase string, score double"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, max_words=3):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        totals[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(ws)
            for k in range(1, max_words + 1):
                for i in range(len(ws) - k + 1):
                    counts[lang, tuple(ws[i : i + k])] += 1
    return counts, totals


def brute(rows, min_count=10, max_words=3, top=2000, percent=50):
    counts, totals = brute_counts(rows, max_words)
    out = []
    for lang in totals:
        own = {p: a for (g, p), a in counts.items() if g == lang and a >= min_count}
        scored = []
        for p, a in own.items():
            if len(p) < 2:
                continue
            inside = [q for q in own if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * own[q] >= percent * a for q in inside):
                continue
            score, _, l, r = min((10**6 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def rows_of(seed, n=120):
    rng = random.Random(seed)
    word = ["a", "b", "C", "d.e", "é", "ab", "x\x00y", "日本"]
    rows = []
    for _ in range(n):
        gap = lambda: rng.choice([" ", " ", "  ", "\t", "\n", ", ", ". ", "\r", "\x0b"])
        text = "".join(rng.choice(word[: rng.randrange(2, 9)]) + gap() for _ in range(rng.randrange(30)))
        rows.append((text, rng.choice(["en", "de", None])))
    return rows + [(None, "en"), ("", "fr"), (None, None), ("a b a b a b", ""), ("   ", "de")]


def frame(spark, rows):
    return spark.createDataFrame([(k, t, g, "w", None, "p", 0.5) for k, (t, g) in enumerate(rows)], SCHEMA)


def result(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("options", [{}, {"min_count": 2, "top": 30}, {"min_count": 3, "max_words": 5, "contained_percent": 80}, {"min_count": 20, "max_words": 2}])
def test_equals_brute_force(spark, monkeypatch, options):
    monkeypatch.setattr(P, "BLOCK", 50)  # phrases cross the blocks of a text
    monkeypatch.setattr(P, "BUCKET_BYTES", 700)
    rows = rows_of(1)
    names = {"contained_percent": "percent"}
    got = result(P.collocations(frame(spark, rows), **options))
    assert got == brute(rows, **{names.get(k, k): v for k, v in options.items()}) and got


def test_full_map_keeps_everything(spark, monkeypatch):
    """A map far too small for the candidates lets other phrases pass, which the global count removes."""
    monkeypatch.setattr(P, "MAP_BITS", 6)
    monkeypatch.setattr(P, "BUCKET_BYTES", 1000)
    rows = rows_of(2)
    assert result(P.collocations(frame(spark, rows), min_count=4)) == brute(rows, min_count=4)


def test_local_mining_is_complete_and_prunes(spark):
    rows = rows_of(3, 300) + [("rare pair number %d" % k, "en") for k in range(200)]
    texts = P._prepared(frame(spark, rows), "text", "lang", P.SHARDS)
    found = P.mine_shards(texts, 10, 3, 5).collect()
    counts, _ = brute_counts(rows)
    frequent = sum(a >= 10 for a in counts.values())
    assert frequent <= sum(r.n for r in found) < len(counts)
    assert all(len(r.found) == 4 * r.n for r in found) and len(found) == 5
    assert P.local_support(10) == (3, 4) and P.local_support(2) == (1, 2) and P.local_support(100) == (3, 34)


def test_copies_long_text_and_ties(spark):
    rows = [("same words here", "en")] * 500 + [("tie one. tie two. " * 20, "en"), ("long text of words " * 20_000, "xx")]
    got = result(P.collocations(frame(spark, rows)))
    assert got == brute(rows)


def test_large_counts_are_exact(spark):
    """a * a * 10^6 passes 64 bits."""
    row = spark.sql("SELECT 3000000000000L AS a, 3000000000001L AS l, 3000000000007L AS r")
    wide = "decimal(38, 0)"
    got = row.selectExpr(f"cast(cast(a as {wide}) * a * 1000000 as {wide}) div cast(cast(l as {wide}) * r as {wide}) AS s").head().s
    assert got == 10**6 * 3000000000000**2 // (3000000000001 * 3000000000007)


def test_empty_table(spark):
    assert P.collocations(frame(spark, [])).collect() == []
