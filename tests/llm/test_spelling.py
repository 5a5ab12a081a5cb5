import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelcast.llm import spelling as S

SCHEMA = "doc_id long, text string, word string, n string, id string, piece int"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(counts, ratio=10):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v.encode())) if near else None
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = [form, n, len(near), counts[form] if form else None]
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def brute_words(rows, min_length=7, min_count=2):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= min_length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= min_count}


def groups(spark, counts, **options):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {r.word: (r.form, r.n, r.n_near, r.form_n, r.root) for r in S.spelling_groups(words, **options).collect()}


@pytest.mark.parametrize("piece_bytes", [60, 4_000_000])
def test_equals_brute_force(spark, monkeypatch, piece_bytes):
    """Few letters, so that runs, ties and shared prefixes abound; small pieces cut paths of the tries."""
    monkeypatch.setattr(S, "PIECE_BYTES", piece_bytes)
    rng = random.Random(3)
    counts = {}
    while len(counts) < 250:
        word = "".join(rng.choice("abé") for _ in range(rng.randrange(1, 8)))
        counts[word] = rng.choice([1, 1, 2, 3, 10, 20, 100, 1000, 10_000])
    assert groups(spark, counts) == brute_groups(counts)
    assert groups(spark, counts, ratio=2) == brute_groups(counts, 2)


def test_chains_ties_and_runs(spark):
    counts = {"aaaaaaa": 1, "aaaaaaaa": 10, "aaaaaaaab": 100, "baaaaaaaab": 1000, "zzzzzzy": 5, "zzzzzzx": 50, "zzzzzzw": 50, "zzzzzyz": 9}
    got = groups(spark, counts)
    assert got == brute_groups(counts)
    assert got["aaaaaaa"][4] == "baaaaaaaab" and got["aaaaaaa"][2] == 1
    assert got["zzzzzzy"][0] == "zzzzzzw"  # equally frequent: code-point order
    assert got["zzzzzyz"][2] == 0  # a swap is two edits


def test_texts(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(6, 11))) for _ in range(12)]
    rows = [(k, " ".join(rng.choice(base) for _ in range(40))) for k in range(60)]
    rows += [(7, "Éclairs ÉCLAIRS écLAIRS éclairs"), (None, "abcdefg-abcdefg1abcdefg"), (None, "abcdefg"), (1, None), (2, ""), (3, "x" * 3000 + " " + "x" * 3000), (4, "x" * 2999 + "y " + "x" * 2999 + "y")]
    rows += rows[:5]
    df = spark.createDataFrame([(d, t, "k", "m", None, 3) for d, t in rows], SCHEMA)
    words = S.count_words(df)
    want = brute_words(rows)
    assert {r.word: r.n for r in words.collect()} == want
    got = {r.word: (r.form, r.n, r.n_near, r.form_n, r.root) for r in S.spelling_groups(words).collect()}
    assert got == brute_groups(want)
    assert any(form for form, *_ in got.values())
    assert {r.word for r in S.count_words(df, drop_every=None, min_count=1, min_length=3000).collect()} == {"x" * 3000, "x" * 2999 + "y"}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert S.spelling_groups(S.count_words(df)).collect() == []


def test_groups_are_bounded_by_the_alphabet(spark):
    """One frequent word with thousands of variants: no pair of nodes is shared by more than the letters that fill it."""
    letters = [chr(c) for c in range(97, 123)]
    word = "abcdefghij"
    variants = {word[:k] + c + word[k + 1 :] for k in range(10) for c in letters} | {word[:k] + c + word[k:] for k in range(11) for c in letters}
    counts = {w: 2 for w in variants} | {word: 1000}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    numbered = S.C.stored(S.number_prefixes(S._pieces(words, F.col("word"))))
    entries = S.pair_entries(S._pieces(numbered, F.reverse("word")))
    assert entries.groupBy("p", "s").count().agg(F.max("count")).head()[0] <= len(letters) + 1
    got = {r.id: r.n_near for r in S.neighbours(entries).collect()}
    middle = numbered.where(F.col("word") == word).head().id
    assert got[middle] == len(variants) - 1
