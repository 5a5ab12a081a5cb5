"""Spelling variants: words one edit apart, found by integer pairs of trie nodes.

All words are put into a trie, and all reversed words into a second one; the
nodes of both are numbered.  A word cut at a position is then the pair (node of
the part before it, node of the part after it), and with the letter at the
position left out the pair (node before, node after that letter).  Two words

* differ by one replaced letter exactly if they share a pair with a letter left
  out at the same place;
* differ by one inserted letter exactly if a pair of the longer word with a
  letter left out is a pair of the shorter word's cuts.

So one grouping by integer pairs lists all neighbours, without false ones and
without strings.  In a run of equal letters each left-out letter gives the same
shorter word, so only the first of the run counts for insertions.

Numbering: words are range-partitioned in code-point order, one sorted piece a
task.  A node's number is the place, in the concatenation of all sorted words, of
the letter that creates it.  A piece needs from the pieces before it only their
letter count and the last word with its nodes; these few values per piece pass
through the driver, the words don't.  Paths are linear in a word's length, so a
run of letters that fills a whole text costs no more than its length.

Sizes: a pair is shared by at most one cut word and one word per letter that can
fill the gap, so groups are bounded by the alphabet (90 letters for the
registered query) and a word has at most 2 * 90 * (length + 1) neighbours.
Nothing is emitted per pair of words: a group's members take the count and the
best of the others.  A form has at least ``ratio`` times its word's occurrences,
so chains of forms end after log(largest n) steps to that base.

Defined results: NULL or empty texts hold no words; a NULL id is written as an
empty text in the digest.  Repeated rows count again.  Of equally frequent
neighbours the smallest word in code-point order is the form.  An empty table
gives no rows.  Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm import common as C
from panelcast.llm.registry import query

LETTERS = "a-zÀ-ÿ"
PIECE_BYTES = 4_000_000
CUT, LEFT_OUT, LEFT_OUT_AGAIN = 0, 1, 2


def count_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, min_count: int = 2, drop_every: int | None = 31) -> DataFrame:
    """``word, n``: runs of letters of all texts, A-Z lower-cased, with at least these sizes.

    With ``drop_every`` an occurrence loses a letter if that number divides the
    crc32 of ``<id>:<run>``; the letter is crc32 % length.  (A planted-misspelling
    rule of the registered query; None counts the runs as they are.)
    """
    text = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # Shorter runs can't give a word, and a run is matched whole or not at all.
    runs = df.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("d"),
        F.explode(F.regexp_extract_all(text, F.lit(f"([{LETTERS}]{{{min_length},}})"), F.lit(1))).alias("run"),
    )
    word = F.col("run")
    if drop_every:
        runs = runs.withColumn("h", F.crc32(F.concat("d", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.char_length("run")).cast("int")
        word = F.when(F.col("h") % drop_every == 0, F.concat(F.expr("substring(run, 1, int(h % char_length(run)))"), F.substring("run", at + 2, F.char_length("run")))).otherwise(word)
    words = runs.select(word.alias("word")).where(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(k for k in range(n) if a[k] != b[k])


class _Trie:
    """Numbers the nodes of sorted words, one after another."""

    def __init__(self, base: int, last: str, path: list[int]):
        self.at, self.last, self.path = base, last, path

    def add(self, word: str) -> list[int]:
        """Node numbers of the word's prefixes, from the empty one (-1)."""
        shared = _common(self.last, word)
        self.path = [*self.path[: shared + 1], *range(self.at + shared, self.at + len(word))]
        self.at += len(word)
        self.last = word
        return self.path


_ROOT = (0, "", [-1])


def _pieces(words: DataFrame, by) -> DataFrame:
    """Range-partition by the text ``key`` and keep the piece's number in a stored table."""
    size = words.agg(F.sum(F.octet_length("word") + 24)).head()[0] or 0
    cut = words.withColumn("key", by).repartitionByRange(1 + int(size / PIECE_BYTES), "key")
    return C.stored(cut.withColumn("piece", F.spark_partition_id()))


def _starts(pieces: DataFrame) -> dict[int, tuple[int, str, list[int]]]:
    """Per piece: letters before it, the word before it and that word's nodes."""

    def last_path(piece: pa.Table) -> pa.Table:
        keys = piece.column("key").sort().to_pylist()
        trie = _Trie(*_ROOT)
        for key in keys:
            trie.add(key)
        return pa.table({"piece": piece.column("piece")[:1], "last": [trie.last], "letters": [trie.at], "path": pa.array([trie.path], pa.list_(pa.int64()))})

    ends = pieces.select("piece", "key").groupBy("piece").applyInArrow(last_path, "piece int, last string, letters long, path array<long>")
    out, (base, last, path) = {}, _ROOT
    for row in ends.orderBy("piece").toLocalIterator():
        out[row.piece] = (base, last, path)
        shared = _common(last, row.last)
        path = [*path[: shared + 1], *(base + k for k in row.path[shared + 1 :])]
        base, last = base + row.letters, row.last
    return out


def number_prefixes(pieces: DataFrame) -> DataFrame:
    """``id, word, n, path`` of sorted pieces: ids ascend in code-point order; path holds the nodes of all prefixes."""
    starts = pieces.sparkSession.sparkContext.broadcast(_starts(pieces))

    def number(piece: pa.Table) -> pa.Table:
        piece = piece.sort_by("key")
        trie = _Trie(*starts.value[piece.column("piece")[0].as_py()])
        ids, paths = [], []
        for word in piece.column("key").to_pylist():
            ids.append(trie.at)
            paths.append(np.array(trie.add(word), np.int64))
        return pa.table({"id": pa.array(ids, pa.int64()), "word": piece.column("word"), "n": piece.column("n"), "path": pa.array(paths, pa.list_(pa.int64()))})

    return pieces.groupBy("piece").applyInArrow(number, "id long, word string, n long, path array<long>")


def pair_entries(pieces: DataFrame, limit: int = 20_000) -> DataFrame:
    """``p, s, id, n, kind`` of numbered words in pieces of reversed order.

    One entry for every cut and every left-out letter of every word, as a pair of nodes.
    """
    starts = pieces.sparkSession.sparkContext.broadcast(_starts(pieces))

    def entries(out: list) -> pa.Table:
        cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in zip(*out)] or [np.zeros(0, np.int64)] * 5
        return pa.table({k: pa.array(c, pa.int8() if k == "kind" else pa.int64()) for k, c in zip(("p", "s", "id", "n", "kind"), cols)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = pa.Table.from_batches(batches).sort_by("key")
        trie = _Trie(*starts.value[piece.column("piece")[0].as_py()])
        out: list = []
        held = 0
        for at in range(0, piece.num_rows, limit):
            part = piece.slice(at, limit)
            paths = part.column("path").combine_chunks()
            nodes, offsets = paths.values.to_numpy(), paths.offsets.to_numpy()
            ids, n = part.column("id").to_numpy(), part.column("n").to_numpy()
            for k, key in enumerate(part.column("key").to_pylist()):
                before = nodes[offsets[k] : offsets[k + 1]]
                after = np.array(trie.add(key), np.int64)[::-1]
                length = len(key)
                first = np.full(length, LEFT_OUT, np.int8)
                letters = key[::-1]
                first[1:][[x == y for x, y in zip(letters, letters[1:])]] = LEFT_OUT_AGAIN
                out.append((
                    np.concatenate([before, before[:-1]]),
                    np.concatenate([after, after[1:]]),
                    np.full(2 * length + 1, ids[k]),
                    np.full(2 * length + 1, n[k]),
                    np.concatenate([np.full(length + 1, CUT, np.int8), first]),
                ))
                held += 2 * length + 1
                if held > 500_000:
                    yield from entries(out).to_batches(100_000)
                    out, held = [], 0
        yield from entries(out).to_batches(100_000)

    return pieces.groupBy("piece").applyInArrow(run, "p long, s long, id long, n long, kind byte")


def neighbours(entries: DataFrame) -> DataFrame:
    """``id, n_near, best``: number of words one edit away, and the most frequent as ``struct(less, id)``, less = -n."""
    member = F.struct((-F.col("n")).alias("less"), "id", "kind")
    groups = entries.groupBy("p", "s").agg(F.sort_array(F.collect_list(member)).alias("g")).where(F.size("g") > 1)
    # A cut word takes the longer ones; a word with a letter left out takes those with another letter
    # there and, from the first letter of a run, the cut word.
    others = F.expr("CASE WHEN me.kind = 0 THEN filter(g, x -> x.kind = 1) ELSE filter(g, x -> x.id != me.id AND (x.kind != 0 OR me.kind = 1)) END")
    seen = groups.select("g", F.explode("g").alias("me")).select(F.col("me.id").alias("id"), others.alias("o")).where(F.size("o") > 0)
    best = F.struct(F.col("o")[0]["less"].alias("less"), F.col("o")[0]["id"].alias("id"))
    return seen.select("id", F.size("o").alias("k"), best.alias("b")).groupBy("id").agg(F.sum("k").alias("n_near"), F.min("b").alias("best"))


def spelling_groups(words: DataFrame, ratio: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for a table ``word, n`` of distinct words.

    A word's form is its most frequent neighbour if that is at least ``ratio``
    (above 1) times as frequent; its root is the end of the chain of forms.
    """
    forward = _pieces(words.select("word", "n"), F.col("word"))
    numbered = C.stored(number_prefixes(forward))
    backward = _pieces(numbered, F.reverse("word"))
    near = neighbours(pair_entries(backward))
    formed = F.col("best.less") * -1 >= ratio * F.col("n")
    found = C.stored(
        numbered.select("id", "word", "n")
        .join(near, "id", "left")
        .select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best.id")).alias("form_id"), F.when(formed, -F.col("best.less")).alias("form_n"))
    )
    for table in (forward, numbered, backward):
        C.discard(table)
    roots = found.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("root_id"))
    top = found.agg(F.max("n")).head()[0] or 1
    steps = max(1, math.ceil(math.log(max(top, 2), ratio)) + 1)  # every step multiplies n by the ratio
    for _ in range(math.ceil(math.log2(steps))):
        further = roots.select(F.col("id").alias("root_id"), F.col("root_id").alias("next"))
        roots = C.stored(roots.join(further, "root_id", "left").select("id", F.coalesce("next", "root_id").alias("root_id")))
    names = found.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    ends = found.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    return (
        found.join(roots, "id", "left")
        .join(names, "form_id", "left")
        .join(ends, "root_id", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    )


@query("op11_spelling_variants")
def op11_spelling_variants(spark, sf_dir):
    return spelling_groups(C.stored(count_words(C.documents(spark, sf_dir))))
