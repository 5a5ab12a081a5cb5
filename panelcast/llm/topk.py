"""Exact top-k inner-product search: one ball tree per shard, branch and bound.

Vectors become integers ``floor(scale * x)``, so scores are exact.  Shards hold
a bounded number of vectors; each builds a ball tree (centre and radius per
node).  For a query ``q`` no vector below a node scores more than
``q.centre + |q| * radius``.  A block of queries goes down the tree at once;
each query visits the child with the higher bound first and leaves out a node
whose bound lies below its current kth score.  That score is shared: a first
pass searches one shard per query block, and the kth score found there is where
the search of every other shard starts.  The stated query set meets all rows in
blocks of bounded size (shard x query block), one task row each; every shard
returns at most k rows a query, and a window merges them.

Defined results: rows whose id or vector is NULL, or whose vector holds NULL or
a non-finite component, take no part.  Of rows that repeat an id the largest
vector stands.  Vectors only meet vectors of their own length.  Ties go to the
smaller id.  Scores beyond the range of long are set to its ends.  A query with
fewer than k candidates returns them all.  An empty table gives no rows.  Only
the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelcast.llm import common as C
from panelcast.llm.registry import query

LOWEST = np.iinfo(np.int64).min
#: Every integer up to here is exact in float64.
EXACT = float(1 << 53)


class BallTree:
    """A ball tree over the rows of a float matrix; nodes in arrays, leaves of at most ``leaf`` rows."""

    def __init__(self, x: np.ndarray, leaf: int = 128):
        self.order = np.arange(len(x))
        self.low, self.high, self.child, self.centre, self.radius = [], [], [], [], []
        todo = [(0, len(x), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            own = x[self.order[a:b]]
            centre = own.mean(axis=0)
            far = own - centre
            node = len(self.low)
            self.low.append(a)
            self.high.append(b)
            self.child.append([-1, -1])
            self.centre.append(centre)
            self.radius.append(float(np.sqrt((far * far).sum(axis=1).max())))
            if parent >= 0:
                self.child[parent][side] = node
            if b - a > leaf:
                # Split at the median of the projection on the line to the farthest row.
                line = far[np.argmax((far * far).sum(axis=1))]
                half = (b - a) // 2
                cut = np.argpartition(far @ line, half)
                self.order[a:b] = self.order[a:b][cut]
                todo += [(a, a + half, node, 0), (a + half, b, node, 1)]
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows, as int64."""
    top = np.abs(q).max(initial=0.0) * np.abs(x).max(initial=0.0) * max(1, q.shape[1])
    if top < EXACT:
        return (q @ x.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(q) @ whole(x).T
    return np.clip(exact, LOWEST, np.iinfo(np.int64).max).astype(np.int64)


class Search:
    """Top k of one shard for a block of queries, starting from given kth scores."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int, floor: np.ndarray):
        self.tree, self.k = BallTree(x), k
        self.x, self.ids, self.q, self.q_ids = x[self.tree.order], ids[self.tree.order], q, q_ids
        self.length = np.sqrt((q * q).sum(axis=1))
        self.best = np.full((len(q), k), LOWEST)
        self.who = np.full((len(q), k), np.iinfo(np.int64).max)
        self.kth = floor.copy()
        reach = np.abs(x).max(initial=0.0) * np.abs(q).max(initial=0.0) * max(1, q.shape[1])
        self.prune = reach < EXACT
        self.slack = 1 + reach * 1e-12
        self.seen = 0
        if len(x):
            self._visit(0, np.arange(len(q)))

    def _bound(self, node: int, at: np.ndarray) -> np.ndarray:
        return self.q[at] @ self.tree.centre[node] + self.length[at] * self.tree.radius[node] + self.slack

    def _visit(self, node: int, at: np.ndarray) -> None:
        left, right = self.tree.child[node]
        if left < 0:
            self._leaf(node, at)
            return
        bound = {c: self._bound(c, at) for c in (left, right)}
        for first, second, own in (
            (left, right, bound[left] >= bound[right]),
            (right, left, bound[left] < bound[right]),
        ):
            for child in (first, second):
                live = own & ((bound[child] >= self.kth[at]) | (not self.prune))
                if live.any():
                    self._visit(child, at[live])

    def _leaf(self, node: int, at: np.ndarray) -> None:
        a, b = self.tree.low[node], self.tree.high[node]
        self.seen += len(at) * (b - a)
        got = scores(self.q[at], self.x[a:b])
        own = self.q_ids[at][:, None] == self.ids[None, a:b]
        got[own] = LOWEST
        use = ((got >= self.kth[at][:, None]) & ~own).any(axis=1)
        at, got, own = at[use], got[use], own[use]
        if not len(at):
            return
        who = np.broadcast_to(self.ids[a:b], got.shape).copy()
        who[own] = np.iinfo(np.int64).max
        all_s, all_w = np.hstack([self.best[at], got]), np.hstack([self.who[at], who])
        order = np.lexsort((all_w, -1 - all_s), axis=1)[:, : self.k]  # -1 - s reverses without overflow
        self.best[at], self.who[at] = np.take_along_axis(all_s, order, 1), np.take_along_axis(all_w, order, 1)
        self.kth[at] = np.maximum(self.kth[at], self.best[at][:, -1])


def _matrix(col: pa.ChunkedArray, rows: int, scale: float) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in col.chunks]) if col.num_chunks else pa.array([], pa.float64())
    return np.floor(scale * flat.to_numpy(zero_copy_only=False).astype(np.float64)).reshape(rows, -1)


def _valid(v: Column) -> Column:
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & whole


def search(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = 16_384,
    query_rows: int = 2_048,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for rows with ``is_query`` (an expression on the id), against all rows."""
    rows = (
        df.select(F.col(id_col).cast("long").alias(id_col), F.col(vector_col).alias("v"))
        .filter(F.col(id_col).isNotNull() & _valid(F.col("v")))
        .groupBy(id_col)
        .agg(F.max("v").alias("v"))
        .withColumn("q", F.coalesce(is_query, F.lit(False)))
        .select(F.col(id_col).alias("id"), "v", "q", F.size("v").alias("dim"))
    )
    total, asked = df.agg(F.count(F.lit(1)), F.count_if(F.coalesce(is_query, F.lit(False)))).head()
    shards, blocks = max(1, -(-total // shard_rows)), max(1, -(-asked // query_rows))

    def block(table: pa.Table) -> pa.Table:
        x = _matrix(table.column("v"), table.num_rows, scale)
        return pa.table(
            [table.column("dim").slice(0, 1), table.column("part").slice(0, 1)] + [pa.array([a.tobytes()], pa.binary()) for a in (table.column("id").to_numpy(), x)],
            names=["dim", "part", "ids", "x"],
        )

    def packed(side: DataFrame, parts: int) -> DataFrame:
        part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
        return C.stored(
            side.select("dim", part.alias("part"), "id", "v").groupBy("dim", "part").applyInArrow(block, "dim int, part int, ids binary, x binary")
        )

    data, asks = packed(rows, shards), packed(rows.filter("q"), blocks)

    def read(row: dict, dim: int) -> tuple[np.ndarray, np.ndarray]:
        ids = np.frombuffer(row["ids"], np.int64)
        return ids, np.frombuffer(row["x"], np.float64).reshape(len(ids), dim)

    def run(left: pa.Table, right: pa.Table) -> Iterator[tuple[dict, Search]]:
        for shard in left.to_pylist():
            for ask in right.to_pylist():
                ids, x = read(shard, shard["dim"])
                q_ids, q = read(ask, shard["dim"])
                floor = np.frombuffer(ask["floor"], np.int64) if ask.get("floor") else np.full(len(q_ids), LOWEST)
                yield ask, Search(x, ids, q, q_ids, k, floor)

    def bounds(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(a["dim"], a["block"], s.best[:, -1].tobytes()) for a, s in run(left, right)]
        return pa.table(
            [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.binary())],
            names=["dim", "block", "floor"],
        )

    def results(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [np.zeros((3, 0), np.int64)]
        for _, s in run(left, right):
            use = s.who < np.iinfo(np.int64).max
            parts.append(np.stack([np.broadcast_to(s.q_ids[:, None], use.shape)[use], s.who[use], s.best[use]]))
        flat = np.concatenate(parts, axis=1)
        return pa.table([pa.array(c) for c in flat], names=["query_id", "vec_id", "score"])

    key = ["dim", "shard", "block"]
    ask_cols = asks.select("dim", F.col("part").alias("block"), "ids", "x")
    home = ask_cols.withColumn("shard", F.pmod(F.col("block"), F.lit(shards)))
    tiles = data.withColumnRenamed("part", "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    at_home = tiles.filter(F.col("shard") == F.pmod(F.col("block"), F.lit(shards)))
    floor = C.stored(at_home.groupBy(*key).cogroup(home.groupBy(*key)).applyInArrow(bounds, "dim int, block int, floor binary"))
    every = ask_cols.join(floor, ["dim", "block"], "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = tiles.groupBy(*key).cogroup(every.groupBy(*key)).applyInArrow(results, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("vec_id").alias(id_col), "score")
    )


_SQL = """
WITH v AS (
  SELECT vec_id, max(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op5_topk_search", _SQL)
def op5_topk_search(spark, sf_dir):
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
