import random

import numpy as np
import pytest

from panelcast.llm import line_dedup as L

SCHEMA = "doc_id long, text string, n_lines string, kept int"


def brute(rows, m):
    texts = [(i, (t or "").split("\n")) for i, t, *_ in rows]
    items = [[k for k, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")] for _, lines in texts]
    place = lambda i, p: (i is None, i or 0, p)
    lead = {}
    for (i, lines), own in zip(texts, items):
        for p in range(len(own) - m + 1):
            k = tuple(lines[x] for x in own[p : p + m])
            lead[k] = min(lead.get(k, place(i, p)), place(i, p))
    out = []
    for (i, lines), own in zip(texts, items):
        gone = set()
        for p in range(len(own) - m + 1):
            if place(i, p) > lead[tuple(lines[x] for x in own[p : p + m])]:
                gone.update(own[p : p + m])
        out.append((i, len(own), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone)))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    line = lambda: rng.choice(["", "  ", "head", "é line", "a longer line of text", "x"]) + rng.choice(["", str(rng.randrange(12))])
    shared = [[line() for _ in range(rng.randrange(2, 9))] for _ in range(5)]
    rows = []
    for i in range(50):
        lines = []
        for _ in range(rng.randrange(0, 5)):
            lines += rng.choice(shared) if rng.random() < 0.5 else [line() for _ in range(rng.randrange(6))]
        rows.append((rng.choice([i, i, i, None, 9]), "\n".join(lines), "x", i))
    return rows + [(90, None, None, None), (91, "", "", 1), (92, "\n\n\n", "", 1), (93, "a\nb\nc\n" * 4, "", 1), (94, "r\n" * 500 + "r", "", 1), (95, "b" * 100_000, "", 1),
                   rows[2]]


@pytest.mark.parametrize("seed,m,group_bytes", [(1, 3, 300), (2, 2, 1 << 22), (3, 5, 500)])
def test_equals_brute_force(spark, seed, m, group_bytes):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = L.remove_repeated_lines(df, min_lines=m, group_bytes=group_bytes).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, m)


def test_every_window_holds_a_fingerprint():
    h = np.random.default_rng(1).integers(0, 5, 300).astype(np.uint64)
    rows = np.array([0, 100, 100, 102, 300])
    index, _ = L.line_items(4).anchors(h, rows)
    for a, b in zip(rows, rows[1:]):
        for p in range(a, b - 3):
            assert ((index >= p) & (index < p + 4)).any()


def test_empty_table(spark):
    assert L.remove_repeated_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_short_runs_and_whole_texts_are_repeats_too(spark):
    long, half = " ".join(f"w{k}" for k in range(50)), " ".join(f"h{k}" for k in range(25))
    texts = ["a\n" + long + "\nb", "c\n" + long + "\nd", "x\n" + half + "\n\n" + half + "!\ny", half + "\n" + half + "!\nz", half + "\nz\n1",
             "one line", "one line\n", "two\n\nlines", " \ntwo\nlines", "two\nmore\none line", None, long + "\n" + long]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    for group_bytes in (1 << 22, 200):
        got = {r.doc_id: (r.n_removed, r.kept) for r in L.remove_repeated_lines(df, min_words=50, group_bytes=group_bytes).collect()}
        want = dict(enumerate((0, t or "") for t in texts)) | {1: (1, "c\nd"), 3: (2, "z"), 6: (1, ""), 8: (2, " \n"), 11: (2, "")}
        assert {k: (n, t.rstrip("\n")) for k, (n, t) in got.items()} == {k: (n, t.rstrip("\n")) for k, (n, t) in want.items()}
    assert {r.n_removed for r in L.remove_repeated_lines(df).collect()} == {0}
