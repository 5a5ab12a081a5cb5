import hashlib
import random
import re

import pytest

from panelcast.llm import substring_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, id string, t int, g string"


def brute(rows, length):
    docs = [(i, WORD.findall(t or "")) for i, t, *_ in rows]
    lead = {}
    for i, w in docs:
        for p in range(len(w) - length + 1):
            if i is not None:
                k = tuple(w[p : p + length])
                lead[k] = min(lead.get(k, i), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            first = lead.get(tuple(w[p : p + length]))
            if first is not None and (i is None or first < i):
                gone[p : p + length] = [True] * length
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), " ".join(kept)))
    return sorted(out, key=str)


def corpus(seed, length):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "bé", "c d", "longer-than-eight-bytes", "x1", "y　", "zz"]) + str(rng.randrange(40))
    shared = [[word() for _ in range(rng.randrange(length - 5, 3 * length))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(0, 5)):
            words += rng.choice(shared)[rng.randrange(4) :] if rng.random() < 0.6 else [word() for _ in range(rng.randrange(80))]
        sep = rng.choice([" ", "\n", "\t ", "\x0b", "  "])
        rows.append((rng.choice([None, i, i, i, 7]), sep.join(words), "x", i, None))
    rows += [(100, None, None, None, None), (101, "", "", 1, ""), (102, "one", "", 1, ""), (103, "same same " * 3000, "", 1, ""),
             (104, "same same " * 100, "", 1, ""), (rows[3][0], rows[3][1], "again", 5, None)]
    return rows


@pytest.mark.parametrize("seed,length,group_bytes", [(1, 50, 4096), (2, 50, 1 << 22), (3, 33, 2000)])
def test_equals_brute_force(spark, seed, length, group_bytes):
    rows = corpus(seed, length)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = S.remove_repeated_windows(df, length=length, group_bytes=group_bytes).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute(rows, length)
    for r in got:
        assert sum(s["to"] - s["from"] for s in r.spans) == r.n_removed


def test_cover_meets_every_shift():
    assert {(a - b) % S.PERIOD for a in S.COVER for b in S.COVER} == set(range(S.PERIOD))


def test_empty_table(spark):
    assert S.remove_repeated_windows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_kept_hash(spark):
    df = spark.createDataFrame([(1, "a  b\nc", "", 1, "")], SCHEMA)
    assert S.remove_repeated_windows(df).head().kept == "a b c" and hashlib.sha256(b"a b c").hexdigest()
