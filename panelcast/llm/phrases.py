"""Phrase collocations: frequent word sequences by SON partitioning, scored and ranked per language.

Texts are cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into words ``[^\\x20\\x09]+``
(A-Z lower-cased first); a phrase is a run of up to ``max_words`` words of one piece.

1. *Local mining.*  Texts are dealt to ``SHARDS`` shards by a hash, so each holds
   the same expected share of the corpus and the local support is that share of
   the global one, rounded up.  Every shard is mined completely: all its phrases
   are counted, keyed by a 60-bit hash.  A phrase with the global support has the
   local one in some shard, whatever the shards' sizes (else its sum falls short).
   At most ``min_count - 1`` shards are used, so the local support is 2 or more
   and what a shard holds once drops out.
2. *Union.*  The locally frequent hashes of all shards set bits of one map of fixed
   size (at most 2^28 bits, 32 MB, broadcast).  Further phrases that share a bit
   only cost work.  Where a corpus has more candidates than the map can tell
   apart, more phrases pass it, up to a plain count of all; nothing is dropped.
3. *Global count.*  Phrases that pass are counted by their exact text over all
   texts, which also removes the false ones.

Both passes count inside blocks of words first, so a phrase that a third of all
texts hold is one entry a block.  The two parts of a phrase's cut are frequent
phrases themselves; their counts are joined, with the many phrases that begin or
end with one word spread over ``SALTS`` keys.

Defined results: NULL or empty texts hold no words; a NULL language is ``und``.
Repeated rows count again; ids are not read.  Ties are settled by the stated
order, scores are floors of exact quotients (38 digits).  An empty table gives no
rows.  Only the text and language columns are read.  One text must fit a task's
memory some ten times over; the counting works on blocks of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm import common as C
from panelcast.llm.registry import query

SHARDS = 3
SALTS = 8
TOP_PARTS = 64
MAP_BITS = 28
BLOCK = 1_000_000
BUCKET_BYTES = 16_000_000
_REST = 28

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(10, 14)]] = True
_GAP = _BREAK.copy()
_GAP[[9, 32]] = True


class _Words:
    """The words of a text column: spans, hashes and whether a word and the next share a piece."""

    def __init__(self, col, seeds: np.ndarray):
        data, offsets = C.text_buffer(col)
        data = C._LOWER[data]
        inside = ~_GAP[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.data, self.inside = data, inside
        rows = np.searchsorted(self.starts, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(rows))
        breaks = np.cumsum(_BREAK[data], dtype=np.int64)
        n = len(self.starts)
        self.joined = np.zeros(n, dtype=bool)
        if n:
            self.joined[:-1] = (self.row[1:] == self.row[:-1]) & (breaks[self.starts[1:]] == breaks[self.ends[:-1] - 1])
        self.hashes = C.mix(C.span_hashes(data, self.starts, self.ends) + seeds[self.row])

    def __len__(self) -> int:
        return len(self.starts)

    def keys(self, a: int, b: int, max_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length: (length, first words in [a, b) of all phrases, their 64-bit keys)."""
        at, key = np.arange(a, b), self.hashes[a:b]
        yield 1, at, key
        for length in range(2, max_words + 1):
            more = self.joined[at + length - 2]
            at = at[more]
            key = C.mix(key[more] * C._STEP + self.hashes[at + length - 1])
            yield length, at, key

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        """Each word as an index into the distinct words."""
        kept = self.data[self.inside]
        offsets = np.concatenate([[0], np.cumsum(self.ends - self.starts)])
        words = pa.Array.from_buffers(pa.large_string(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
        coded = words.dictionary_encode()
        return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from C.slices(batch, "text")


def _blocks(words: _Words) -> Iterator[tuple[int, int]]:
    for a in range(0, len(words), BLOCK):
        yield a, min(a + BLOCK, len(words))


def local_support(min_count: int) -> tuple[int, int]:
    """(number of shards, occurrences that make a phrase frequent in a shard)."""
    shards = max(1, min(SHARDS, min_count - 1))
    return shards, -(-min_count // shards)


def _prepared(df: DataFrame, text_col: str, lang_col: str, shards: int) -> DataFrame:
    return df.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")).select(
        "text", "lang", F.xxhash64("lang").alias("seed"), F.pmod(F.xxhash64("lang", "text"), F.lit(shards)).cast("int").alias("shard")
    )


def bucket_count(texts: DataFrame) -> int:
    return 1 + C.text_bytes(texts) // BUCKET_BYTES


def _bucket_and_rest(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket by a key's upper half, and 28 bits of its lower half."""
    upper, lower = key >> np.uint64(32), key & np.uint64((1 << _REST) - 1)
    return (upper * np.uint64(buckets)) >> np.uint64(32), lower


def mine_shards(texts: DataFrame, min_count: int, max_words: int, buckets: int) -> DataFrame:
    """``bucket, found, n``: in each hash bucket the phrases that are frequent in some shard.

    A block of words sends one packed row per bucket: four bytes per distinct
    phrase, 28 of hash and 4 of shard, as often as it occurs but not beyond the
    local support.  A bucket's size follows ``BUCKET_BYTES`` of text, so the share
    of phrases that meet another one's hash is the same (0.2 %) at every size.
    """
    _, support = local_support(min_count)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            words = _Words(piece.column("text"), piece.column("seed").to_numpy().view(np.uint64))
            shard = piece.column("shard").to_numpy().astype(np.uint64)
            for a, b in _blocks(words):
                found = []
                for _, at, key in words.keys(a, b, max_words):
                    bucket, rest = _bucket_and_rest(key, buckets)
                    found.append(bucket << np.uint64(32) | rest << np.uint64(4) | shard[words.row[at]])
                entry, n = np.unique(np.concatenate(found), return_counts=True)
                entry = np.repeat(entry, np.minimum(n, support))
                cuts = np.searchsorted(entry, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
                packed = pa.Array.from_buffers(pa.binary(), buckets, [None, pa.py_buffer((cuts * 4).astype(np.int32)), pa.py_buffer(entry.astype(np.uint32))])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), packed], names=["bucket", "entries"])

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = None, []
        for batch in batches:
            bucket = batch.column("bucket")[0]
            parts += [np.frombuffer(x.as_buffer(), np.uint32) for x in batch.column("entries")]
        entry = np.sort(np.concatenate(parts))
        local = entry[: max(0, len(entry) - support + 1)]  # a run of this length ends where it began
        rest = np.unique(local[local == entry[support - 1 :]] >> np.uint32(4))
        yield pa.RecordBatch.from_arrays([pa.array([bucket.as_py()]), pa.array([rest.tobytes()], pa.binary()), pa.array([len(rest)])], names=["bucket", "found", "n"])

    return texts.mapInArrow(pack, "bucket long, entries binary").where(F.length("entries") > 0).groupBy("bucket").applyInArrow(frequent, "bucket long, found binary, n long")


def candidate_map(mined: DataFrame, buckets: int) -> tuple[int, np.ndarray]:
    """(bits per bucket, map) with a bit set for every candidate; at most 2^``MAP_BITS`` bits, or 64 a bucket.

    Only the finished pieces of the map pass through the driver.
    """
    total = mined.agg(F.sum("n")).head()[0] or 0
    wanted = min(1 << MAP_BITS, 8 * max(total, 1)) // buckets
    width = 1 << max(6, min(_REST, wanted.bit_length() - 1))
    shift = _REST - (width.bit_length() - 1)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for found in batch.column("found"):
                one = np.zeros(width, bool)
                one[np.frombuffer(found.as_buffer(), np.uint32) >> np.uint32(shift)] = True
                bits.append(np.packbits(one, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), pa.array(bits, pa.binary())], names=["bucket", "bits"])

    out = np.zeros((buckets, width // 8), np.uint8)
    for row in mined.select("bucket", "found").mapInArrow(mark, "bucket long, bits binary").toLocalIterator():
        out[row.bucket] = np.frombuffer(row.bits, np.uint8)
    return shift, out


def _passes(key: np.ndarray, shift: int, bits: np.ndarray) -> np.ndarray:
    bucket, rest = _bucket_and_rest(key, len(bits))
    cell = rest >> np.uint64(shift)
    return (bits[bucket, cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _phrase_counts(words: _Words, shift: int, bits: np.ndarray, max_words: int) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(length, distinct phrases, counts) of what passes the map, block by block."""
    codes, names = words.codes()
    for a, b in _blocks(words):
        for length, at, key in words.keys(a, b, max_words):
            at = at[_passes(key, shift, bits)]
            code = codes[at]
            for k in range(1, length):
                if k > 1:  # dense again, so that the product stays below 2^63
                    code = np.unique(code, return_inverse=True)[1]
                code = code * len(names) + codes[at + k]
            _, first, n = np.unique(code, return_index=True, return_counts=True)
            parts = [names.take(pa.array(codes[at[first] + k])) for k in range(length)]
            yield length, parts[0] if length == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())), n


def frequent_phrases(df: DataFrame, min_count: int = 10, max_words: int = 3, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, words, phrase, f``: all phrases of up to ``max_words`` words that occur ``min_count`` times.

    The row with 0 words of a language holds the number of its word occurrences.
    """
    spark = df.sparkSession
    texts = _prepared(df, text_col, lang_col, local_support(min_count)[0])
    buckets = bucket_count(texts)
    mined = C.stored(mine_shards(texts, min_count, max_words, buckets))
    shift, bits = candidate_map(mined, buckets)
    C.discard(mined)
    shared = spark.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            for lang in piece.column("lang").unique().to_pylist():
                own = piece.filter(pc.equal(piece.column("lang"), lang))
                words = _Words(own.column("text"), own.column("seed").to_numpy().view(np.uint64))
                found = [(0, pa.array([""], pa.large_string()), np.array([len(words)])), *_phrase_counts(words, shift, shared.value, max_words)]
                for length, phrase, n in found:
                    rows = len(phrase)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * rows, pa.string()), pa.array(np.full(rows, length, np.int32)), phrase.cast(pa.string()), pa.array(n.astype(np.int64))], names=["lang", "words", "phrase", "c"])

    counted = texts.mapInArrow(run, "lang string, words int, phrase string, c long")
    return counted.groupBy("lang", "words", "phrase").agg(F.sum("c").alias("f")).where((F.col("f") >= min_count) | (F.col("words") == 0))


def _part(side: str) -> DataFrame:
    return F.array_join(F.expr("slice(ws, 1, cut)" if side == "first" else "slice(ws, cut + 1, words)"), " ")


def collocations(df: DataFrame, min_count: int = 10, max_words: int = 3, top: int = 2000, contained_percent: int = 50, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases.

    A phrase scores floor(10^6 a^2 / (l r)) at its worst cut.  A phrase that a
    longer frequent one contains is dropped if that one has ``contained_percent``
    of its occurrences.
    """
    found = C.stored(frequent_phrases(df, min_count, max_words, text_col, lang_col))
    phrases = found.where(F.col("words") >= 2).withColumn("ws", F.split("phrase", " "))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    cuts = phrases.select("lang", "words", "phrase", F.col("f").alias("a"), "ws", salt.alias("salt"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cuts = cuts.select("lang", "words", "phrase", "a", "salt", "cut", _part("first").alias("first"), _part("rest").alias("rest"))
    parts = found.where(F.col("words").between(1, max_words - 1)).select("lang", "phrase", "f", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"), "salt")
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"), "salt")
    cuts = cuts.join(left, ["lang", "first", "salt"]).join(right, ["lang", "rest", "salt"])
    wide = "decimal(38, 0)"
    score = F.expr(f"cast(cast(a as {wide}) * a * 1000000 as {wide}) div cast(cast(l as {wide}) * r as {wide})")
    worst = cuts.withColumn("score", score).groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("w"))

    inner = phrases.where(F.col("words") > 2).select("lang", "f", "ws", "words", F.explode(F.expr("sequence(2, words - 1)")).alias("size"))
    inner = inner.select("lang", "f", "ws", "size", F.explode(F.expr("sequence(1, words - size + 1)")).alias("at"))
    covered = inner.groupBy("lang", F.array_join(F.expr("slice(ws, at, size)"), " ").alias("phrase")).agg(F.max("f").alias("longer"))
    kept = worst.join(covered, ["lang", "phrase"], "left").where(F.coalesce(F.col("longer") * 100 < F.col("a") * contained_percent, F.lit(True)))
    order = [F.col("w.score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = lambda rows, *by: rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", *by).orderBy(*order))).where(F.col("rank") <= top)
    # First within parts of a language, so that one task ends up with a bounded number of rows.
    best = ranked(ranked(kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))), "part"))
    totals = found.where(F.col("words") == 0).select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("w.l").alias("l"), F.col("w.r").alias("r"), "n", F.col("w.score").alias("score"))


@query(
    "op13_phrase_collocations",
    r"""
WITH rows AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, coalesce(text, '') AS text FROM documents),
pieces AS (
  SELECT rid, lang,
         unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece,
         generate_subscripts(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'), 1) AS pid
  FROM rows),
worded AS (
  SELECT rid, pid, lang, unnest(regexp_extract_all(piece, '[^\x20\x09]+')) AS w,
         generate_subscripts(regexp_extract_all(piece, '[^\x20\x09]+'), 1) AS pos
  FROM pieces),
runs AS (
  SELECT lang, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3
  FROM worded WINDOW o AS (PARTITION BY rid, pid ORDER BY pos)),
grams AS (
  SELECT lang, 1 AS k, w AS phrase FROM runs
  UNION ALL SELECT lang, 2, w || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL),
totals AS (SELECT lang, count(*) AS n FROM runs GROUP BY lang),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
cand AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
cuts AS MATERIALIZED (
  SELECT lang, phrase, a, 1 AS cut, ws[1] AS part, array_to_string(ws[2:], ' ') AS rest FROM cand
  UNION ALL
  SELECT lang, phrase, a, 2, ws[1] || ' ' || ws[2], ws[3] FROM cand WHERE k = 3),
lefts AS MATERIALIZED (SELECT c.*, x.f AS l FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.part),
scored AS MATERIALIZED (
  SELECT c.lang, c.phrase, c.a, c.cut, c.l, y.f AS r, (1000000::HUGEINT * c.a * c.a) // (c.l::HUGEINT * y.f) AS score
  FROM lefts c JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
worst AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, ws[1] || ' ' || ws[2] AS phrase, a FROM cand WHERE k = 3
  UNION ALL SELECT lang, ws[2] || ' ' || ws[3], a FROM cand WHERE k = 3),
kept AS (
  SELECT * FROM worst w
  WHERE NOT EXISTS (SELECT 1 FROM longer g WHERE g.lang = w.lang AND g.phrase = w.phrase AND 100 * g.a >= 50 * w.a)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
)
def op13_phrase_collocations(spark, sf_dir):
    return collocations(C.documents(spark, sf_dir))
