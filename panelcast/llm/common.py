"""Helpers shared by the operators: reading, words and hashes on Arrow buffers.

Words are maximal runs of bytes other than space and ``\\x09-\\x0D`` in the
UTF-8 text, which equals ``[^\\x20\\x09-\\x0D]+`` on characters.  All array
helpers work on one Arrow batch inside a task.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
_STEP = _U(0x9E3779B97F4A7C15)
_ROLL = (_U(0xD6E8FEB86659FD93), _U(0xC2B2AE3D27D4EB4F))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name below the cluster's shared checkpoint folder."""
    import uuid

    from panelcast.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"


#: Spark's own settings while a table is written: shuffle files of a finished query are removed with it,
#: and Python workers get rows in small batches, since a row may hold a very long text or set.
_WHILE_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (lineage cut, columnar).

    The write's shuffle files are of no use afterwards and go when it ends, so a
    job of several steps holds the shuffles of one step at a time.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    before = {key: spark.conf.get(key, None) for key in _WHILE_WRITING}
    for key, value in _WHILE_WRITING.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table made by ``stored`` that nothing reads any more."""
    from pyarrow import fs

    files = table.inputFiles()
    if files:
        where, path = fs.FileSystem.from_uri(files[0].rpartition("/")[0])
        if "/llm-" in path:  # only what scratch_dir named
            where.delete_dir(path)


_HELD: dict = {}


def held(name: tuple, make):
    """The one large object (a vocabulary, a model) that a Python worker keeps between tasks.

    Workers serve one operator after another; a new object replaces the last one.
    """
    if name not in _HELD:
        if _HELD:
            _HELD.clear()
            _give_back()
        _HELD[name] = make()
    return _HELD[name]


def _give_back(collect: bool = True) -> None:
    """Return freed memory to the system, where the C library can."""
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


@contextmanager
def no_cycles() -> Iterator[None]:
    """While a memo of millions of acyclic objects grows: no passes of the cycle collector over all of them."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def tidy() -> None:
    """At the end of a group in a step that holds no large object: drop the last step's, return freed memory."""
    _HELD.clear()
    _give_back(collect=False)


def text_bytes(df: DataFrame, text_col: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(text_col))).head()[0] or 0


def slices(batch: pa.RecordBatch, text: str, limit: int = 6_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a piece have about ``limit`` bytes (one row at least)."""
    ends = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def text_buffer(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (NULL as empty) and its row offsets, from 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.large_string())
    col = col.cast(pa.large_string()).fill_null("")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each row's offsets into them."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (in place on a fresh array)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: eight bytes a step, all spans at once."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    length = ends - starts
    out = mix(length.astype(np.uint64) * _STEP)
    live, at = np.arange(len(starts)), starts
    while len(live):
        left = length[live]
        piece = words[at] & _TAIL[np.minimum(left, 8)]
        out[live] = mix(out[live] * _STEP + piece)
        more = left > 8
        live, at = live[more], at[more] + 8
        length = length - 8
    return out


def words_of(col, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, word starts, word ends, row offsets into words, word hashes) of a text column."""
    data, offsets = text_buffer(col)
    if lower:
        data = _LOWER[data]
    starts, ends, rows = word_spans(data, offsets)
    return data, starts, ends, rows, span_hashes(data, starts, ends)


@lru_cache(maxsize=2)
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    base = int(_ROLL[which])
    back = pow(base, -1, 1 << 64)
    up = np.full(size, _U(base))
    down = np.full(size, _U(back))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def rolling(h: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hash of every run of ``length`` consecutive entries of ``h`` (len(h) - length + 1 values)."""
    n = len(h)
    if n < length:
        return np.zeros(0, np.uint64)
    up, down = _powers(which, 1 << max(10, (n + 1).bit_length()))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((h if which == 0 else mix(h + _STEP)) * up[:n], out=total[1:])
    return mix((total[length:] - total[: n - length + 1]) * down[: n - length + 1])


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ranges ``start, start+1, ...`` of the given lengths."""
    total = int(counts.sum())
    out = np.ones(total, np.int64)
    live = counts > 0
    starts, counts = starts[live], counts[live]
    if not total:
        return out
    at = np.cumsum(counts) - counts
    out[0] = starts[0]
    out[at[1:]] = starts[1:] - (starts[:-1] + counts[:-1] - 1)
    return np.cumsum(out)
