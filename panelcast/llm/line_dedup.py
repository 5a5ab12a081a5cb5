"""Line dedup: runs of lines that appeared before are deleted, found by winnowing.

The items are a text's lines that hold more than white space, in order.  Of
every ``min_lines`` consecutive line hashes the smallest (the last of equals) is
a fingerprint, so two equal runs of ``min_lines`` lines select the same
fingerprint at the same place.  Positions of fingerprints that occur more than
once are joined back to their texts and extended both ways over every run of
``min_lines`` lines around them; the runs' own hashes decide (see ``runs``).  A
line is deleted if a run of ``min_lines`` lines that covers it also starts
earlier: in a text with a smaller id, or further up in the same text.

With ``min_words`` runs of fewer than ``min_lines`` lines count too, if they hold
that many words together or are all lines of their text.  They are few, so each is
its own fingerprint.  Such a run is repeated if an equal run that counts starts
earlier; so a whole short text is held against whole texts, a long line against any.

Defined results: lines end at ``\\n`` and are compared byte by byte; blank lines
never count and always stay.  NULL text has no lines.  A NULL id ranks after
every id, and rows with equal ids delete from each other only by place.  An
empty table gives no rows.  Only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm import common as C
from panelcast.llm import runs
from panelcast.llm.registry import query

MIN_LINES = 3
#: Words (parted by white space) from which a shorter run counts, where short runs are asked for.
MIN_WORDS = 50


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the lines that are not blank, and each row's offsets into them."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([breaks, offsets[1:]])
    starts, ends = np.sort(starts), np.sort(ends)
    ink = np.concatenate([[0], np.cumsum(~C._SPACE[data])])
    live = ink[ends] > ink[starts]
    starts, ends = starts[live], ends[live]
    return starts, ends, np.searchsorted(starts, offsets)


def _cut(col) -> tuple:
    data, offsets = C.text_buffer(col)
    starts, ends, rows = line_spans(data, offsets)
    return data, starts, ends, rows, C.span_hashes(data, starts, ends), offsets


def _words(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of words in each line."""
    first = ~C._SPACE[data]
    first[1:] &= C._SPACE[data[:-1]]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = ~C._SPACE[data[heads]]
    total = np.concatenate([[0], np.cumsum(first)])
    return total[ends] - total[starts]


def line_items(min_lines: int = MIN_LINES, min_words: int | None = None) -> runs.Items:
    def short(cut: tuple, n: int) -> np.ndarray:
        data, starts, ends, rows, _, offsets = cut
        total = np.concatenate([[0], np.cumsum(_words(data, offsets, starts, ends))])
        start = np.arange(max(0, len(starts) - n + 1))
        row = np.searchsorted(rows, start, side="right") - 1
        inside = start + n <= rows[row + 1]
        whole = rows[row + 1] - rows[row] == n
        return start[inside & (whole | (total[start + n] - total[start] >= min_words))]

    def anchors(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(h) < min_lines:
            return np.zeros(0, np.int64), h[:0]
        # The last minimum of every window that lies in one text.
        start = np.arange(len(h) - min_lines + 1)
        inside = start + min_lines <= rows[1:][np.searchsorted(rows, start, side="right") - 1]
        back = sliding_window_view(h, min_lines)[inside][:, ::-1]
        index = np.unique(start[inside] + min_lines - 1 - np.argmin(back, axis=1))
        return index, h[index]

    return runs.Items(_cut, anchors, min_lines, 1, within=True, short=None if min_words is None else short)


def remove_repeated_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_lines: int = MIN_LINES,
    group_bytes: int = runs.GROUP_BYTES,
    min_words: int | None = None,
) -> DataFrame:
    """Per row: id, ``n_lines`` (not blank), ``n_removed``, ``kept`` (the text without the deleted lines)."""

    def finish(table: pa.Table, cut: tuple, removed: np.ndarray) -> pa.Table:
        data, starts, ends, rows, _, offsets = cut
        raw, kept, gone = data.tobytes(), [], []
        for a, b, x, y in zip(rows[:-1].tolist(), rows[1:].tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
            out = np.flatnonzero(removed[a:b]) + a
            gone.append(len(out))
            parts, at = [], x
            for k in out.tolist():
                # A deleted line takes the break after it, or the one before it at the end of the text.
                parts.append(raw[at : starts[k]])
                at = min(int(ends[k]) + 1, y)
            text = b"".join(parts) + raw[at:y]
            if len(out) and ends[out[-1]] == y and text.endswith(b"\n"):
                text = text[:-1]
            kept.append(text.decode())
        return pa.table(
            [table.column("id"), pa.array(np.diff(rows), pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
            names=[id_col, "n_lines", "n_removed", "kept"],
        )

    schema = f"`{id_col}` long, n_lines long, n_removed long, kept string"
    return runs.with_removed(df, line_items(min_lines, min_words), finish, schema, id_col, text_col, group_bytes)


_SQL = """
WITH t AS (SELECT doc_id, str_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
a AS (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS k FROM t),
l AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS p FROM a
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
c AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words, count(*) OVER (PARTITION BY doc_id) AS own FROM l),
x AS (SELECT *, lead(line, 1) OVER o AS line2, lead(line, 2) OVER o AS line3, lead(words, 1) OVER o AS words2
      FROM c WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
w AS (SELECT doc_id, p, 3 AS size, md5(line || chr(10) || line2 || chr(10) || line3) AS h FROM x WHERE line3 IS NOT NULL
      UNION ALL SELECT doc_id, p, 2, md5(line || chr(10) || line2) FROM x WHERE line2 IS NOT NULL AND (words + words2 >= 50 OR own = 2)
      UNION ALL SELECT doc_id, p, 1, md5(line) FROM x WHERE words >= 50 OR own = 1),
f AS (SELECT doc_id, p, size, row_number() OVER (PARTITION BY size, h ORDER BY doc_id, p) AS turn FROM w),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + size)) AS p FROM f WHERE turn > 1),
n AS (SELECT l.doc_id, count(*) AS n_lines, count(g.p) AS n_removed FROM l LEFT JOIN g USING (doc_id, p) GROUP BY 1),
s AS (SELECT a.doc_id, string_agg(a.line, chr(10) ORDER BY a.k) AS kept
      FROM a LEFT JOIN l ON l.doc_id = a.doc_id AND l.k = a.k LEFT JOIN g ON g.doc_id = l.doc_id AND g.p = l.p
      WHERE g.p IS NULL GROUP BY 1)
SELECT t.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)
"""


@query("op1_line_dedup", _SQL)
def op1_line_dedup(spark, sf_dir):
    """Runs of three lines, and shorter ones of 50 words or that are a whole text."""
    out = remove_repeated_lines(C.documents(spark, sf_dir), min_words=MIN_WORDS)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
