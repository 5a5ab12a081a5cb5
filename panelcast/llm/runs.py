"""Repeated runs of words or lines, found by shared anchors and settled by whole windows.

Used by substring dedup (anchors at difference-cover positions) and line dedup
(winnowed anchors).  A *window* is ``length`` consecutive items of one text.
It counts as repeated if the same items also start at an earlier place.  All
steps are Spark jobs over groups of texts (hash of id and text, about
``group_bytes`` each; the number of groups follows the size of the input):

1. every group hashes its anchors; a second grouping by anchor hash finds the
   anchors that occur more than once and sends their positions back;
2. a cogroup of texts and shared anchors extends them to every window around
   them and hashes those whole windows (two independent hashes, 128 bits);
   grouping by window hash marks each window that also starts earlier;
3. a cogroup of texts and marked windows gives the items that they cover.

Items travel as packed arrays, one row per (group, hash bucket).  There are as many
buckets as groups, so a bucket's size stays the same however large the input; a
group has rows only for the buckets of its keys, at most one a key.  A key that
repeats inside a group is settled there and sent once, so a passage that a
third of all texts share costs one entry per group, not one per text.  No
pairs of texts are formed.  The texts' exchange is the same in all three steps,
so Spark writes it once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm import common as C

GROUP_BYTES = 4 << 20

_LAST = np.iinfo(np.int64).max
_FLAGS = "g int, r binary, p binary"
_KEYS = "b int, g int, k binary, r binary, p binary"
_WINDOWS = "b int, g int, k binary, k2 binary, i binary, r binary, p binary"


@dataclass(frozen=True)
class Items:
    """What a text is made of, and how its anchors are chosen.

    ``cut(column)`` gives (bytes, item starts, item ends, row offsets, item hashes, ...);
    ``anchors(hashes, row offsets)`` gives (item indices, 64-bit keys) such that two
    equal windows contain equal keys at the same place; ``span`` is how many items
    a key covers; ``within`` tells whether earlier places of the same text count.
    """

    cut: Callable
    anchors: Callable
    length: int
    span: int
    within: bool
    #: ``short(cut, n)``: starts of the windows of ``n`` items, fewer than ``length``, that count too (None: no such windows).
    short: Callable | None = None


def grouped(
    df: DataFrame, id_col: str, text_col: str, group_bytes: int = GROUP_BYTES, more: tuple[str, ...] = ()
) -> tuple[DataFrame, int]:
    """``g, id, t`` and the columns ``more``, with texts dealt to groups by a hash of id and text; the number of groups."""
    n = max(1, -(-C.text_bytes(df, text_col) // group_bytes))
    text = F.coalesce(F.col(text_col), F.lit(""))
    g = F.pmod(F.xxhash64(F.col(id_col), text), F.lit(n)).cast("int")
    return df.select(g.alias("g"), F.col(id_col).cast("long").alias("id"), text.alias("t"), *more), n


def in_order(table: pa.Table) -> pa.Table:
    """The rows of a group by id (NULL last), then text: the same on every pass."""
    order = pc.sort_indices(table, sort_keys=[("id", "ascending"), ("t", "ascending")], null_placement="at_end")
    return table.take(order)


def ids_of(table: pa.Table) -> np.ndarray:
    """Ids as integers; NULL as the largest, which is never earlier than another."""
    return pc.fill_null(table.column("id"), _LAST).to_numpy()


def unpack(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def by_bucket(keys: np.ndarray, buckets: int):
    """(bucket, indices) of keys, ascending by bucket."""
    b = (keys >> np.uint64(20)) % np.uint64(buckets)
    order = np.argsort(b, kind="stable")
    cuts = np.flatnonzero(np.diff(b[order])) + 1
    return [(int(b[part[0]]), part) for part in np.split(order, cuts) if len(part)]


def _firsts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Marks the first of each run of equal keys."""
    first = np.ones(len(sorted_keys[0]), bool)
    if len(first):
        first[1:] = sorted_keys[0][1:] != sorted_keys[0][:-1]
        for k in sorted_keys[1:]:
            first[1:] |= k[1:] != k[:-1]
    return first


def _place(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    r = np.searchsorted(rows, index, side="right") - 1
    return r.astype(np.uint32), (index - rows[r]).astype(np.uint32)


def _rows(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.strip().split() for f in schema.split(",")]
    return pa.table(
        [pa.array([row[k] for row in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)],
        names=[name for name, _ in fields],
    )


def packed_keys(rows: list[tuple]) -> pa.Table:
    return _rows(_KEYS, rows)


def settle_locally(g: int, keys: np.ndarray, r: np.ndarray, p: np.ndarray, buckets: int) -> list[tuple]:
    """Packed rows of a group's keys: repeats inside the group are known already, and each key is sent once."""
    order = np.argsort(keys, kind="stable")
    again = ~_firsts(keys[order])
    many = again.copy()
    many[:-1] |= again[1:]
    local, sent = order[many], order[~again]
    out = [(buckets + g, g, b"", r[local].tobytes(), p[local].tobytes())] if len(local) else []
    for b, part in by_bucket(keys[sent], buckets):
        s = sent[part]
        out.append((b, g, keys[s].tobytes(), r[s].tobytes(), p[s].tobytes()))
    return out


def repeated_keys(texts: DataFrame, emit: Callable[[pa.Table], pa.Table], buckets: int) -> DataFrame:
    """Positions (``g, r, p``) of the keys emitted by groups of texts that occur more than once."""

    def settle(table: pa.Table) -> pa.Table:
        if table.column("b")[0].as_py() >= buckets:
            return table.select(["g", "r", "p"])
        keys = unpack(table, "k", np.uint64)
        sizes = pc.binary_length(table.column("k")).to_numpy() // 8
        order = np.argsort(keys, kind="stable")
        again = ~_firsts(keys[order])
        many = again.copy()
        many[:-1] |= again[1:]
        hit = np.zeros(len(keys), bool)
        hit[order[many]] = True
        r, p = unpack(table, "r", np.uint32), unpack(table, "p", np.uint32)
        out, at = [], 0
        for g, n in zip(table.column("g").to_pylist(), sizes):
            own = np.flatnonzero(hit[at : at + n]) + at
            if len(own):
                out.append((g, r[own].tobytes(), p[own].tobytes()))
            at += n
        return _rows(_FLAGS, out)

    return texts.groupBy("g").applyInArrow(emit, _KEYS).groupBy("b").applyInArrow(settle, _FLAGS)


def shared_anchors(texts: DataFrame, groups: int, items: Items) -> DataFrame:
    """Positions (``g, r, p``: group, row, item) of anchors that occur more than once."""

    def emit(table: pa.Table) -> pa.Table:
        table = in_order(table)
        rows, h = items.cut(table.column("t"))[3:5]
        index, keys = items.anchors(h, rows)
        return packed_keys(settle_locally(table.column("g")[0].as_py(), keys, *_place(index, rows), groups))

    return repeated_keys(texts, emit, groups)


def _send_windows(g: int, keys: np.ndarray, second: np.ndarray, ids: np.ndarray, r: np.ndarray, p: np.ndarray, buckets: int, within: bool) -> pa.Table:
    """Packed rows of a group's windows: those that start earlier in the group are known already, the others are sent."""
    # Entries in order of key, then place; rows are in order of id already.
    order = np.lexsort((p, r, second, keys))
    keys, second, ids, r, p = keys[order], second[order], ids[order], r[order], p[order]
    first = _firsts(keys, second)
    head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    later = ids > ids[head]
    if within:
        later |= (ids == ids[head]) & (p > p[head])
    out = [(buckets + g, g, b"", b"", b"", r[later].tobytes(), p[later].tobytes())] if later.any() else []
    sent = np.flatnonzero(~later)
    for b, part in by_bucket(keys[sent], buckets):
        s = sent[part]
        out.append((b, g, *(x[s].tobytes() for x in (keys, second, ids, r, p))))
    return _rows(_WINDOWS, out)


def _settle_windows(buckets: int, within: bool) -> Callable[[pa.Table], pa.Table]:
    """Marks, over all groups, each window that also starts earlier."""

    def settle(table: pa.Table) -> pa.Table:
        if table.column("b")[0].as_py() >= buckets:
            return table.select(["g", "r", "p"])
        keys, second, ids = unpack(table, "k", np.uint64), unpack(table, "k2", np.uint64), unpack(table, "i", np.int64)
        r, p = unpack(table, "r", np.uint32), unpack(table, "p", np.uint32)
        src = np.repeat(table.column("g").to_numpy(), pc.binary_length(table.column("k")).to_numpy() // 8)
        order = np.lexsort((p, ids, second, keys))
        keys, second, ids, r, p, src = (x[order] for x in (keys, second, ids, r, p, src))
        first = _firsts(keys, second)
        head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        later = ids > ids[head]
        if within:
            later |= (ids == ids[head]) & (p > p[head])
        r, p, src = r[later], p[later], src[later]
        order = np.argsort(src, kind="stable")
        cuts = np.flatnonzero(np.diff(src[order])) + 1
        parts = [x for x in np.split(order, cuts) if len(x)]
        return _rows(_FLAGS, [(int(src[x[0]]), r[x].tobytes(), p[x].tobytes()) for x in parts])

    return settle


def repeated_windows(texts: DataFrame, groups: int, items: Items) -> DataFrame:
    """Starts (``g, r, p``) of the windows that also start at an earlier place."""
    buckets, length, back = groups, items.length, items.length - items.span

    def emit(table: pa.Table, flags: pa.Table) -> pa.Table:
        if not table.num_rows or not flags.num_rows:
            return _rows(_WINDOWS, [])
        table = in_order(table)
        g = table.column("g")[0].as_py()
        rows, h = items.cut(table.column("t"))[3:5]
        r, p = unpack(flags, "r", np.uint32), unpack(flags, "p", np.uint32)
        at = rows[r] + p.astype(np.int64)
        cover = np.zeros(len(h) + 1, np.int64)
        np.add.at(cover, np.maximum(rows[r], at - back), 1)
        np.add.at(cover, at + 1, -1)
        near = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        ends = rows[1:][np.searchsorted(rows, near, side="right") - 1]
        near = near[near + length <= ends]
        keys, second = C.rolling(h, length)[near], C.rolling(h, length, 1)[near]
        r, p = _place(near, rows)
        ids = ids_of(table)[r]
        return _send_windows(g, keys, second, ids, r, p, buckets, items.within)

    flags = shared_anchors(texts, groups, items)
    windows = texts.groupBy("g").cogroup(flags.groupBy("g")).applyInArrow(emit, _WINDOWS)
    return windows.groupBy("b").applyInArrow(_settle_windows(buckets, items.within), _FLAGS)


def repeated_short_windows(texts: DataFrame, groups: int, items: Items) -> DataFrame:
    """Like ``repeated_windows``, of the shorter windows that ``items.short`` names; ``p`` is start * length + items - 1."""
    buckets = groups

    def emit(table: pa.Table) -> pa.Table:
        table = in_order(table)
        cut = items.cut(table.column("t"))
        rows, h = cut[3:5]
        found = []
        for n in range(1, items.length):
            at = items.short(cut, n)
            r, p = _place(at, rows)
            found.append((C.rolling(h, n)[at], C.rolling(h, n, 1)[at], r, p * np.uint32(items.length) + np.uint32(n - 1)))
        keys, second, r, p = (np.concatenate(x) for x in zip(*found))
        return _send_windows(table.column("g")[0].as_py(), keys, second, ids_of(table)[r], r, p, buckets, items.within)

    windows = texts.groupBy("g").applyInArrow(emit, _WINDOWS)
    return windows.groupBy("b").applyInArrow(_settle_windows(buckets, items.within), _FLAGS)


def with_removed(
    df: DataFrame,
    items: Items,
    finish: Callable[[pa.Table, tuple, np.ndarray], pa.Table],
    schema: str,
    id_col: str,
    text_col: str,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """Calls ``finish(rows, cut, removed)`` per group: ``removed`` marks the items that a repeated window covers."""
    texts, groups = grouped(df, id_col, text_col, group_bytes)
    marks = repeated_windows(texts, groups, items).withColumn("s", F.lit(False))
    if items.short is not None:
        marks = marks.unionByName(repeated_short_windows(texts, groups, items).withColumn("s", F.lit(True)))

    def apply(table: pa.Table, marked: pa.Table) -> pa.Table:
        table = in_order(table)
        cut = items.cut(table.column("t"))
        rows, cover = cut[3], np.zeros(len(cut[4]) + 1, np.int64)
        if marked.num_rows:
            r, p = unpack(marked, "r", np.uint32), unpack(marked, "p", np.uint32).astype(np.int64)
            short = np.repeat(marked.column("s").to_numpy(), pc.binary_length(marked.column("r")).to_numpy() // 4)
            p, n = np.where(short, p // items.length, p), np.where(short, p % items.length + 1, items.length)
            at = rows[r] + p
            np.add.at(cover, at, 1)
            np.add.at(cover, at + n, -1)
        return finish(table, cut, np.cumsum(cover[:-1]) > 0)

    return texts.groupBy("g").cogroup(marks.groupBy("g")).applyInArrow(apply, schema)
