import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from panelcast.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, size int, target string, taken double"


def test_targets_share_what_full_sources_leave():
    q = M.targets({"a": 100, "b": 10, "c": 50}, {"a": 5, "b": 2, "c": 1}, Fraction(240), 2)
    assert q["b"] == 20 and q["a"] == Fraction(220 * 5, 6) and sum(q.values()) == 240
    assert M.targets({}, {}, Fraction(0), 2) == {}
    assert sum(M.targets({"a": 0, "b": 0}, {"a": 1, "b": 1}, Fraction(0), 2).values()) == 0


def brute_cost(patterns, quota, copies):
    """Cheapest full routing of small instances, by exhausting splits unit by unit (Bellman-Ford on units)."""
    # Greedy by copies is optimal in total cost: route as much as possible with r copies, for r = 1, 2, ...
    best, moved = 0, 0
    for r in range(1, copies + 1):
        m = max_flow({p: r * w for p, w in patterns.items()}, quota)
        best += (m - moved) * (r - 1)
        moved = m
    return moved, best


def max_flow(caps, quota):
    caps, quota = dict(caps), dict(quota)
    owner = defaultdict(int)
    total = 0

    def push(p, seen):
        for s in p:
            if s in seen:
                continue
            seen.add(s)
            if quota.get(s, 0) > 0:
                quota[s] -= 1
                owner[p, s] += 1
                return True
            for o in [o for (o, t), n in owner.items() if t == s and n and o != p]:
                if push(o, seen):
                    owner[o, s] -= 1
                    owner[p, s] += 1
                    return True
        return False

    for p in caps:
        while caps[p] and push(p, set()):
            caps[p] -= 1
            total += 1
    return total


def test_flow_is_full_and_cheapest_on_overlapping_sources():
    rng = random.Random(5)
    for _ in range(30):
        names = "abcd"[: rng.randrange(1, 5)]
        patterns = {tuple(sorted(rng.sample(names, rng.randrange(1, len(names) + 1)))): rng.randrange(0, 9) for _ in range(5)}
        quota = {s: rng.randrange(0, 14) for s in names}
        flow = M.min_cost_flow(patterns, quota, 3)
        moved = sum(sum(f.values()) for f in flow.values())
        cost = 0
        for p, f in flow.items():
            n = sum(f.values())
            assert n <= 3 * patterns[p]
            cost += sum(max(0, n - r * patterns[p]) for r in (1, 2))
        for s in names:
            assert sum(f.get(s, 0) for f in flow.values()) <= quota[s]
        assert (moved, cost) == brute_cost(patterns, quota, 3)


def test_mix_meets_targets_and_equals_a_plain_version(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randrange(0, 60)), rng.choice(["s1", "s0", "é", None, "s0", "s0"]), i, "x", 0.5) for i in range(400)]
    rows += [(400, None, "s1", None, None, None), (401, "", None, 1, "", 1.0), (402, "w " * 5000, "zz", 1, "", 1.0), rows[3], (None, "a b", "s1", 0, "", 0.0)]
    out = M.mix_sources(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "size", "source_size", "target", "taken"]
    got = out.collect()
    held, want = defaultdict(int), defaultdict(list)
    for i, t, s, *_ in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        held[s] += n
        key = "" if i is None else str(i)
        want[s].append((hashlib.md5(f"mix{key}".encode()).hexdigest()[:15], key, n, i))
    quota = M.PRODUCTION(dict(held))
    assert sum(quota.values()) == Fraction(3, 2) * sum(held.values())
    expected = []
    for s, docs in want.items():
        rounds, rest = divmod(int(quota[s]), held[s]) if held[s] else (0, 0)
        for _, _, n, i in sorted(docs):
            more = min(n, rest)
            rest -= more
            expected.append((i, n, held[s], float(quota[s]), rounds * n + more))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, expected))
    assert all(r.taken <= 2 * r.size for r in got)


def test_documents_in_several_sources_serve_both(spark):
    rows = [(str(i), ["a", "b"] if i % 2 else ["a"], 10) for i in range(20)]
    df = spark.createDataFrame(rows, "key string, sources array<string>, size long")
    out, flow = M.mix(df, lambda held: {"a": 120, "b": 75})
    assert sum(f.get("a", 0) for f in flow.values()) == 120 and sum(f.get("b", 0) for f in flow.values()) == 75
    assert out.agg(F.sum("taken")).head()[0] == 195


def test_empty_table(spark):
    assert M.mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
