"""Mixing sources to target weights by min-cost flow.

A document may belong to several sources.  Documents are aggregated by
membership pattern (the sorted set of their sources); a small flow network

    pattern --(copy 1, 2, ... at rising cost)--> pattern' --> source --> sink

routes word capacity to the sources' quotas.  The r-th copy of a pattern costs
``r - 1`` per word, a convex cost, so nothing is repeated while an unrepeated
word can still serve the same quota.  Inside a pattern the routed words are
laid over the documents: whole rounds for everybody, then one more (partly cut)
round for the documents that come first in a seeded hash order.

Only the table of patterns meets the driver: one row per distinct set of
sources, never one per document.  Its size is checked (``max_patterns``) and
more raises an error; nothing is dropped.  The order inside a pattern is found
with two levels: sums per (pattern, hash bucket), a running sum over those, and
a window only inside the one bucket where the quota ends.

Defined results: NULL text has size 0 and takes 0 words.  A NULL source is a
source of its own, last in order.  Repeated rows are documents of their own
(tied rows share the hash order, then size decides).  A NULL id hashes as the
empty text.  An empty table gives no rows.  Only the id, text and source
columns are read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelcast.llm import common as C
from panelcast.llm.registry import query

BUCKETS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(C.WORD)), F.lit(0)).cast("long")


def targets(sizes: dict, weights: dict, total: Fraction, most: int) -> dict:
    """Quotas in proportion to ``weights`` that add to ``total``, none above ``most`` times its size.

    What a full source can't take is shared among the others by weight, until
    none is above.  Exact rationals: the same on every run.
    """
    quota, open_ = {}, set(sizes)
    rest = Fraction(total)
    while open_:
        weight = sum(Fraction(weights[s]) for s in open_)
        over = [s for s in open_ if rest * Fraction(weights[s]) >= most * sizes[s] * weight]
        if not over:
            quota |= {s: rest * Fraction(weights[s]) / weight for s in open_}
            break
        for s in over:
            quota[s] = Fraction(most * sizes[s])
            open_.discard(s)
        rest -= sum(quota[s] for s in over)
    return quota


def min_cost_flow(patterns: dict[tuple, int], quota: dict, copies: int) -> dict[tuple, dict]:
    """Words each pattern sends to each of its sources: {pattern: {source: words}}.

    Successive shortest paths with potentials (Dijkstra) on integer capacities.
    ``patterns`` maps a tuple of sources to its words; at most ``copies`` times
    those are used, the r-th copy at cost r - 1.
    """
    graph: dict = defaultdict(list)  # node -> indices of edges; edge i ^ 1 is the reverse of edge i
    to, room, cost = [], [], []

    def edge(a, b, capacity, price):
        for x, y, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            graph[x].append(len(to))
            to.append(y)
            room.append(c)
            cost.append(p)

    links = {}
    for p, words in patterns.items():
        for r in range(copies):
            edge("from", ("p", p), words, r)
        for s in p:
            links[p, s] = len(to)
            edge(("p", p), ("s", s), copies * words, 0)
    for s, q in quota.items():
        edge(("s", s), "to", int(q), 0)
    rank = {n: i for i, n in enumerate(graph)}
    price = dict.fromkeys(graph, 0)
    while True:
        far, via, heap = {"from": 0}, {}, [(0, rank["from"], "from")] if "from" in graph else []
        while heap:
            d, _, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for i in graph[a]:
                b = to[i]
                step = d + cost[i] + price[a] - price[b]
                if room[i] > 0 and step < far.get(b, float("inf")):
                    far[b], via[b] = step, i
                    heapq.heappush(heap, (step, rank[b], b))
        if "to" not in far:
            break
        last = far["to"]
        for n in graph:
            price[n] += min(far.get(n, last), last)
        path, n = [], "to"
        while n != "from":
            path.append(via[n])
            n = to[via[n] ^ 1]
        push = min(room[i] for i in path)
        for i in path:
            room[i] -= push
            room[i ^ 1] += push
    out: dict = {p: {} for p in patterns}
    for (p, s), i in links.items():
        out[p][s] = room[i ^ 1]
    return out


def mix(
    docs: DataFrame,
    quotas,
    key: str = "key",
    sources: str = "sources",
    size: str = "size",
    copies: int = 2,
    seed: str = "mix",
    max_patterns: int = 100_000,
) -> tuple[DataFrame, dict]:
    """Words to take from each document so that every source meets its quota.

    ``docs`` has a string ``key`` (seeded order), an array of ``sources`` and a
    long ``size``; its other columns pass through.  ``quotas`` is a function
    from ``{source: words it holds}`` to ``{source: words wanted}``.  Returns
    ``docs`` with a long column ``taken`` (at most ``copies * size``), and the
    plan ``{pattern: {source: words}}``.
    """
    spark = docs.sparkSession
    # The hash order is cut into equal buckets; 60 bits of md5 as a long.
    order = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col(key), F.lit("")))), 1, 15), 16, 10).cast("long")
    # Sources as tagged strings, so that a NULL source can be a member.
    tags = F.array_sort(F.transform(F.array_distinct(F.col(sources)), lambda s: F.coalesce(F.concat(F.lit("="), s), F.lit(""))))
    rows = docs.withColumns({"__o": order, "__p": F.coalesce(tags, F.array().cast("array<string>"))})
    rows = rows.withColumn("__b", F.shiftright("__o", 60 - (BUCKETS.bit_length() - 1)))
    table = rows.groupBy("__p").agg(F.sum(size).alias("words")).limit(max_patterns + 1).collect()
    if len(table) > max_patterns:
        raise ValueError(f"more than max_patterns={max_patterns} distinct sets of sources")
    untag = lambda t: t[1:] if t else None
    patterns = {tuple(untag(t) for t in r["__p"]): int(r["words"] or 0) for r in table}
    held: dict = defaultdict(int)
    for p, words in sorted(patterns.items(), key=str):
        for s in p:
            held[s] += words
    flow = min_cost_flow(dict(sorted(patterns.items(), key=str)), quotas(dict(held)), copies)

    plan = [
        (
            ["" if s is None else f"={s}" for s in sorted(p, key=lambda s: "" if s is None else f"={s}")],
            (f := sum(flow[p].values())) // words if words else 0,
            f % words if words else 0,
        )
        for p, words in patterns.items()
    ]
    plan_df = spark.createDataFrame(plan, "__p array<string>, __rounds long, __rest long")
    # The bucket in which the last, partial round ends, per pattern.
    running = W.partitionBy("__p").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    ends = (
        rows.groupBy("__p", "__b")
        .agg(F.sum(size).alias("__w"))
        .withColumn("__before", F.coalesce(F.sum("__w").over(running), F.lit(0)))
        .join(plan_df, "__p")
        .filter("__before <= __rest AND __rest < __before + __w")
        .select("__p", "__rounds", F.col("__b").alias("__end"), (F.col("__rest") - F.col("__before")).alias("__left"))
    )
    # A pattern without words has no such bucket: it takes nothing.
    planned = C.stored(ends)
    marked = rows.join(planned, "__p", "left")
    base = F.coalesce(F.col("__rounds") * F.col(size), F.lit(0))
    at_end = F.coalesce(F.col("__b") == F.col("__end"), F.lit(False))
    sure = marked.filter(~at_end).withColumn(
        "taken", base + F.when(F.col("__b") < F.col("__end"), F.col(size)).otherwise(0)
    )
    within = W.partitionBy("__p").orderBy("__o", key, size).rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum(size).over(within), F.lit(0))
    last = marked.filter(at_end).withColumn(
        "taken", base + F.least(F.col(size), F.greatest(F.lit(0), F.col("__left") - before))
    )
    out = sure.unionByName(last)
    return out.select(*[f"`{c}`" for c in docs.columns], F.col("taken").cast("long").alias("taken")), flow


def weighted_quotas(pattern: tuple[int, ...], share: Fraction, most: int):
    """Quotas for sources in code-point order (NULL last) that weigh ``pattern``, repeating."""

    def quotas(held: dict) -> dict:
        names = sorted(held, key=lambda s: (s is None, (s or "").encode()))
        weights = {s: pattern[i % len(pattern)] for i, s in enumerate(names)}
        return targets(held, weights, share * sum(held.values()), most)

    return quotas


#: The production mix: weights 5, 2, 1 repeating, 150 % of all words, nothing more than twice.
PRODUCTION = weighted_quotas((5, 2, 1), Fraction(3, 2), 2)


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, ``size, source_size, target, taken`` under the production mix."""
    # Sizes come from the whole texts once; everything after reads this narrow table.
    sized = C.stored(
        df.select(
            F.col(id_col).alias("id"),
            F.col(id_col).cast("string").alias("key"),
            F.col(source_col).cast("string").alias("source"),
            F.array(F.col(source_col).cast("string")).alias("sources"),
            word_count(F.col(text_col)).alias("size"),
        )
    )
    kept: dict = {}

    def quotas(held: dict) -> dict:
        kept.update(PRODUCTION(held))
        kept["held"] = held
        return {s: kept[s] for s in held}

    taken, _ = mix(sized, quotas)
    held = kept.pop("held")
    facts = df.sparkSession.createDataFrame(
        [(s, held[s], float(q)) for s, q in kept.items()], "source string, source_size long, target double"
    )
    return (
        taken.alias("t")
        .join(facts.alias("f"), F.col("t.source").eqNullSafe(F.col("f.source")))
        .select(F.col("t.id").alias(id_col), "t.size", "f.source_size", "f.target", "t.taken")
    )


def repeat_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The production mix as whole documents: every row as often as the mix takes it, rounded to whole copies.

    Half a copy or more counts as one.  Rows without words serve no source and
    stay as they are.  The columns are those of ``df``.
    """
    names = {c: f"c{k}" for k, c in enumerate(df.columns)}
    own = df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    sized = own.withColumns(
        {
            "key": F.col(names[id_col]).cast("string"),
            "sources": F.array(F.col(names[source_col]).cast("string")),
            "size": word_count(F.col(names[text_col])),
        }
    )
    taken, _ = mix(sized, PRODUCTION)
    copies = F.when(F.col("size") == 0, 1).otherwise(F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size")))).cast("int")
    return taken.withColumn("copy", F.explode(F.array_repeat(F.lit(0), copies))).select(*[F.col(n).alias(c) for c, n in names.items()])


_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('mix' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:15] AS o FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS held,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1) % 3] AS weight
  FROM d GROUP BY source),
r AS (  -- sources in the order in which they fill up
  SELECT *, row_number() OVER (ORDER BY held / weight, source NULLS LAST) AS k FROM s),
c AS (
  SELECT *, coalesce(sum(2 * held) OVER w, 0) AS filled, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS unfilled
  FROM r WINDOW w AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e AS (  -- the first that does not fill up, and its share per weight
  SELECT *, (3 * sum(held) OVER () - 2 * filled) AS rest2, weight * (3 * sum(held) OVER () - 2 * filled) >= 4 * held * unfilled AS is_full
  FROM c),
f AS (SELECT min_by(rest2, k) AS rest2, min_by(unfilled, k) AS unfilled, min(k) AS k FROM e WHERE NOT is_full),
t AS (
  SELECT e.source, e.held,
         CASE WHEN f.k IS NULL OR e.k < f.k THEN CAST(2 * e.held AS DOUBLE)
              ELSE CAST(e.weight * f.rest2 AS DOUBLE) / CAST(2 * f.unfilled AS DOUBLE) END AS target,
         CASE WHEN f.k IS NULL OR e.k < f.k THEN 2 * e.held ELSE (e.weight * f.rest2) // (2 * f.unfilled) END AS quota
  FROM e LEFT JOIN f ON true),
x AS (
  SELECT d.*, t.held, t.target, t.quota // greatest(t.held, 1) AS rounds, t.quota % greatest(t.held, 1) AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, CAST(d.doc_id AS VARCHAR), d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, held AS source_size, target,
       CAST(rounds * size + least(size, greatest(0, rest - before)) AS BIGINT) AS taken
FROM x
"""


@query("op4_mix_sources", _SQL)
def op4_mix_sources(spark, sf_dir):
    return mix_sources(C.documents(spark, sf_dir))
