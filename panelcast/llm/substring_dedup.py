"""Substring dedup: word windows that also start in a document with a smaller id are removed.

Anchors are taken at difference-cover positions: position ``i`` of a document
counts if ``i mod 31`` lies in a perfect difference set.  For any two positions
``i, j`` some shift below 31 moves both onto the cover, so two equal windows of
``length >= 50`` words contain equal sub-windows of ``length - 30`` words that
start at cover positions of both documents.  Six positions in 31 are hashed.
Shared anchors are then extended to whole windows (see ``runs``).

Defined results: NULL text has no words; texts shorter than the window lose
nothing.  A NULL id ranks after every id, and rows with equal ids never remove
each other's words.  Repeated rows get equal results.  An empty table gives no
rows.  Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelcast.llm import common as C
from panelcast.llm import runs
from panelcast.llm.registry import query

# A perfect difference set modulo 31.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)

_ON_COVER = np.isin(np.arange(PERIOD), COVER)


def word_items(length: int = 50) -> runs.Items:
    span = length - PERIOD + 1
    if span < 1:
        raise ValueError(f"the window must have at least {PERIOD} words")

    def anchors(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = np.diff(rows)
        at = np.arange(len(h)) - np.repeat(rows[:-1], n)
        use = _ON_COVER[at % PERIOD] & (at + span <= np.repeat(n, n)) & (np.repeat(n, n) >= length)
        index = np.flatnonzero(use)
        return index, C.rolling(h, span)[index]

    return runs.Items(C.words_of, anchors, length, span, within=False)


def remove_repeated_windows(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, group_bytes: int = runs.GROUP_BYTES
) -> DataFrame:
    """Per row: id, ``n_words``, ``n_removed``, ``kept`` (kept words joined by one space), ``spans`` (removed
    word ranges, end excluded)."""

    def finish(table: pa.Table, cut: tuple, removed: np.ndarray) -> pa.Table:
        data, starts, ends, rows, _ = cut
        raw, kept, spans = data.tobytes(), [], []
        for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
            gone = removed[a:b]
            edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            spans.append([{"from": int(x), "to": int(y)} for x, y in zip(edge[::2], edge[1::2])])
            words = raw[starts[a] : ends[b - 1]].split() if b > a else []
            if len(edge):
                words = [w for w, out in zip(words, gone.tolist()) if not out]
            kept.append(b" ".join(words).decode())
        n_removed = np.add.reduceat(np.append(removed, 0).astype(np.int64), rows[:-1]) if len(rows) > 1 else []
        n = np.diff(rows)
        return pa.table(
            [
                table.column("id"),
                pa.array(n, pa.int64()),
                pa.array(np.where(n > 0, n_removed, 0), pa.int64()),
                pa.array(kept, pa.string()),
                pa.array(spans, pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))),
            ],
            names=[id_col, "n_words", "n_removed", "kept", "spans"],
        )

    schema = f"`{id_col}` long, n_words long, n_removed long, kept string, spans array<struct<`from`: int, `to`: int>>"
    return runs.with_removed(df, word_items(length), finish, schema, id_col, text_col, group_bytes)


_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS p FROM w WHERE len(words) >= 50),
h AS (SELECT doc_id, p, md5_number(array_to_string(words[p : p + 49], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS lead FROM h GROUP BY h HAVING count(DISTINCT doc_id) > 1),
c AS (SELECT DISTINCT h.doc_id, unnest(range(p, p + 50)) AS k FROM h JOIN f USING (h) WHERE h.doc_id > f.lead),
g AS (SELECT doc_id, list(k) AS gone FROM c GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN words
              ELSE list_filter(words, lambda x, k: NOT list_contains(gone, k)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)
"""


@query("op3_substring_dedup", _SQL)
def op3_substring_dedup(spark, sf_dir):
    from pyspark.sql import functions as F

    out = remove_repeated_windows(C.documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
