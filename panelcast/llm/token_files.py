"""Token ids in bit-packed files: fixed width, block offsets, random access.

``write_corpus`` encodes texts in ascending id order and writes one file per
range of ids; ``read_corpus`` reads them back as a Spark job.  File layout, all
integers little-endian::

    b"TOKBITS1"                                            magic
    blocks: ids, each in ``bits`` bits, big-endian bit order, padded to a byte
    footer: int64 byte offset of each block, then of the footer itself
            int64 ordinal of each block's first id, then the number of ids
            int64 document ids, uint8 whether it has one, int64 ids before each document, then the total
    int64 number of blocks, int64 number of documents, int64 bits

``bits`` is the least number of bits that holds every id of the vocabulary.
Every block but the last holds ``BLOCK`` ids, so an id's block is known by
division and any document is read by unpacking only the blocks that it touches.

Files are written under a temporary name and renamed when complete, so a task
that runs again replaces its file with the same bytes.  Paths go through
``pyarrow.fs`` (``file://``, ``hdfs://``, ``s3://`` and the like) and belong in
the shared folder of ``spark.checkpoint.dir``.

Defined results: NULL or empty text has the end id alone.  Rows without an id
come last; rows with equal ids are ordered by text.  An empty table writes no
file and gives no rows.  Only the id and text columns are read.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import common as C
from panelcast.llm.pool import Pool
from panelcast.llm.registry import query

MAGIC = b"TOKBITS1"
BLOCK = 1 << 16


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each, padded to a whole byte."""
    big = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return big[:, 4 - bits // 8 :].tobytes()
    return np.packbits(np.unpackbits(big, axis=1)[:, 32 - bits :].ravel()).tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of a packed block."""
    raw = np.frombuffer(data, np.uint8)
    big = np.zeros((n, 4), np.uint8)
    if bits % 8 == 0:
        big[:, 4 - bits // 8 :] = raw[: n * bits // 8].reshape(n, bits // 8)
    else:
        wide = np.zeros((n, 32), np.uint8)
        wide[:, 32 - bits :] = np.unpackbits(raw, count=n * bits).reshape(n, bits)
        big = np.packbits(wide, axis=1)
    return big.reshape(-1).view(">u4").astype(np.uint32)


class Writer:
    """Appends documents to one file."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.out.write(MAGIC)
        self.at, self.rest, self.done = len(MAGIC), np.zeros(0, np.uint32), 0
        self.blocks, self.docs, self.known, self.counts = [], [], [], []

    def add(self, docs: np.ndarray, known: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(docs)
        self.known.append(known)
        self.counts.append(counts)
        ids = np.concatenate([self.rest, ids.astype(np.uint32)])
        whole = len(ids) // BLOCK * BLOCK
        for k in range(0, whole, BLOCK):
            self._block(ids[k : k + BLOCK])
        self.rest = ids[whole:]

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.out.write(data)
        self.blocks.append((self.at, self.done))
        self.at += len(data)
        self.done += len(ids)

    def close(self) -> tuple[int, int]:
        """Writes the footer; (documents, ids)."""
        if len(self.rest):
            self._block(self.rest)
        counts = np.concatenate([np.zeros(1, np.int64), *self.counts])
        docs = np.concatenate([np.zeros(0, np.int64), *self.docs])
        known = np.concatenate([np.zeros(0, np.uint8), *self.known])
        for part in (
            np.array([a for a, _ in self.blocks] + [self.at], "<i8"),
            np.array([i for _, i in self.blocks] + [self.done], "<i8"),
            docs.astype("<i8"),
            known.astype(np.uint8),
            np.cumsum(counts).astype("<i8"),
            np.array([len(self.blocks), len(docs), self.bits], "<i8"),
        ):
            self.out.write(part.tobytes())
        return len(docs), self.done


class Reader:
    """Random access to one file (a seekable binary file object)."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, 2)
        blocks, docs, self.bits = (int(x) for x in np.frombuffer(self._read(size - 24, 24), "<i8"))
        length = 16 * (blocks + 1) + 9 * docs + 8 * (docs + 1)
        footer = self._read(size - 24 - length, length)
        cut = lambda at, n, kind: np.frombuffer(footer, kind, n, at)
        self.offsets, self.firsts = cut(0, blocks + 1, "<i8"), cut(8 * (blocks + 1), blocks + 1, "<i8")
        at = 16 * (blocks + 1)
        self.docs, self.known = cut(at, docs, "<i8"), cut(at + 8 * docs, docs, np.uint8)
        self.starts = cut(at + 9 * docs, docs + 1, "<i8")
        if self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a token file")

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids ``first <= k < last`` of the file; reads only their blocks."""
        if last <= first:
            return np.zeros(0, np.uint32)
        a, b = first // BLOCK, (last - 1) // BLOCK
        data = self._read(int(self.offsets[a]), int(self.offsets[b + 1] - self.offsets[a]))
        out, base = [], int(self.offsets[a])
        for k in range(a, b + 1):
            n = int(self.firsts[k + 1] - self.firsts[k])
            out.append(unpack(data[int(self.offsets[k]) - base : int(self.offsets[k + 1]) - base], n, self.bits))
        out = np.concatenate(out)
        return out[first - a * BLOCK : last - a * BLOCK]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))

    def stretches(self, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first document, document after the last, their ids) in turn, about ``limit`` ids at a time."""
        at = 0
        while at < len(self.docs):
            to = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + limit, side="right")) - 1)
            yield at, to, self.ids(int(self.starts[at]), int(self.starts[to]))
            at = to


def word_encoder(path: str) -> tuple[Pool, int, tuple[str, ...]]:
    return C.held(("words", path), lambda: _word_encoder(path))


def _word_encoder(path: str) -> tuple[Pool, int, tuple[str, ...]]:
    """Encoder of words and their halves, the size of the vocabulary, and its special strings.

    A special string written in a text is that token, as the library has it; such
    words are encoded one by one, all others as if no string were special.

    The tokenizer's normaliser and pre-tokenizer never join text across white
    space, so a text's ids are its words' ids in a row.  Unseen words go through
    the library in one text, kept apart by a character that is a token of its own.
    """
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already runs one task per core
    from tokenizers import Tokenizer

    t, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    special = tuple(sorted(str(x.content) for x in t.get_added_tokens_decoder().values() if x.special))
    # Only strings matched as they stand, without blanks, stay inside one word.
    if any(x.normalized or x.lstrip or x.rstrip or x.single_word or x.content.split() != [x.content] for x in t.get_added_tokens_decoder().values()):
        raise ValueError("a special token may reach beyond a word")
    mark = "\0"
    own = plain.encode(mark, add_special_tokens=False).ids
    if len(own) != 1:
        raise ValueError("the separator must be a single token")

    apart = re.compile("|".join(map(re.escape, (mark, *special)))).search

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out: list = [None] * len(words)
        alone = [apart(w) is not None for w in words]
        odd = [k for k, a in enumerate(alone) if a]
        even = [k for k, a in enumerate(alone) if not a]
        for k in odd:
            out[k] = np.array(t.encode(words[k], add_special_tokens=False).ids, np.int32)
        for at in range(0, len(even), 20_000):
            part = even[at : at + 20_000]
            ids = plain.encode_batch_fast([f" {mark} ".join(words[k] for k in part)], add_special_tokens=False)[0].ids
            ids = np.array(ids, np.int32)
            cuts = np.flatnonzero(ids == own[0])
            if len(cuts) != len(part) - 1:
                raise ValueError("the separator was not kept apart")
            a = 0
            for k, b in zip(part, [*cuts.tolist(), len(ids)]):
                out[k] = ids[a:b]
                a = b + 1
        return np.concatenate([np.zeros(0, np.int32), *out]), np.fromiter(map(len, out), np.int64, len(out))

    return Pool(encode, 700_000), t.get_vocab_size(with_added_tokens=True), special


#: Marks that never join a letter or digit before them; what ends a word is its own unit.
_TAIL = ",.;:!?"


def _halves(word: str) -> tuple[str, str]:
    """A word as stem and closing marks, if the tokenizer splits there; ASCII stems in lower case, as it makes them."""
    stem = word.rstrip(_TAIL)
    # The last character as the normaliser leaves it: a mark split off it would join what follows.
    last = stem[-1:] if stem.isascii() else unicodedata.normalize("NFC", stem[-1:]).lower()[-1:]
    if not last.isalnum():
        stem = word
    return (stem.lower() if stem.isascii() else stem), word[len(stem) :]


_ALNUM = np.array([chr(b).isalnum() and b < 128 for b in range(256)])


def _units(words: pa.Array, whole: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Distinct halves of all words, and the places of each word's two; words marked ``whole`` stay as they are.

    The same as ``_halves`` of each word, for ASCII words at once.
    """
    ascii_ = pc.string_is_ascii(words).to_numpy(zero_copy_only=False)
    plain, odd, whole = np.flatnonzero(ascii_ & ~whole), np.flatnonzero(~ascii_ & ~whole), np.flatnonzero(whole)
    own = words.take(pa.array(plain))
    stems = pc.ascii_rtrim(own, characters=_TAIL)
    data, offsets = C.text_buffer(stems)
    split = np.zeros(len(plain), bool)
    some = offsets[1:] > offsets[:-1]
    split[some] = _ALNUM[data[offsets[1:][some] - 1]]
    marked = np.flatnonzero(split & (np.diff(offsets) < pc.binary_length(own).to_numpy()))
    tails = pc.replace_substring_regex(own.take(pa.array(marked)), f"(?s)^.*[^{_TAIL}]", "")
    pairs = list(map(_halves, words.take(pa.array(odd)).to_numpy(zero_copy_only=False)))
    listed = (
        pc.ascii_lower(pc.if_else(pa.array(split), stems, own)),
        *(pa.array([pair[k] for pair in pairs], pa.large_string()) for k in (0, 1)),
        words.take(pa.array(whole)),
        tails,
        pa.array([""], pa.large_string()),
    )
    coded = pa.concat_arrays(listed).dictionary_encode()
    place = np.split(coded.indices.to_numpy(), np.cumsum([len(x) for x in listed])[:-1])
    at = np.full((len(words), 2), place[5][0], np.int64)
    at[plain, 0], at[odd, 0], at[odd, 1], at[whole, 0] = place[:4]
    at[plain[marked], 1] = place[4]
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), at


def encode_words(text: pa.Array, pool: Pool, special: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row and each text's offsets into them."""
    words = pc.ascii_split_whitespace(text.cast(pa.large_string()).fill_null(""))
    rows = words.offsets.to_numpy() - words.offsets[0].as_py()
    coded = words.flatten().dictionary_encode()
    whole = np.zeros(len(coded.dictionary), bool)
    if special:  # what holds a special string, or would in lower case, stays as it is
        whole = pc.match_substring_regex(coded.dictionary, "|".join(map(re.escape, special)), ignore_case=True).to_numpy(zero_copy_only=False)
    units, at = _units(coded.dictionary, whole)
    places = pool.find(units)[at]
    return pool.gather(places[coded.indices.to_numpy()].ravel(), rows * 2)


def _open(path: str, mode: str):
    where, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    if mode == "r":
        return where, name, where.open_input_file(name)
    where.create_dir(name.rpartition("/")[0], recursive=True)
    return where, name, where.open_output_stream(name)


def write_corpus(
    df: DataFrame, folder: str, vocabulary: str, end: int = 1, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = 16 << 20
) -> list[tuple[str, int, int]]:
    """Writes token files of about ``file_bytes`` of text each; (path, documents, ids) per file in id order."""
    n = max(1, -(-C.text_bytes(df, text_col) // file_bytes))
    texts = df.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    keys = (F.col("i").asc_nulls_last(), F.col("t"))
    ordered = texts.repartitionByRange(n, keys[0]).sortWithinPartitions(*keys)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        final = f"{folder}/part-{task.partitionId():08d}.tok"
        pool, size, special = word_encoder(vocabulary)
        writer = where = out = name = None
        for batch in batches:
            for piece in C.slices(batch, "t"):
                if writer is None:
                    where, name, out = _open(f"{final}.{task.taskAttemptId()}.tmp", "w")
                    writer = Writer(out, bits_for(max(size, end + 1)))
                with C.no_cycles():
                    ids, rows = encode_words(piece.column("t"), pool, special)
                closed = np.insert(ids, rows[1:], end)
                known = pc.is_valid(piece.column("i")).to_numpy(zero_copy_only=False).astype(np.uint8)
                writer.add(piece.column("i").fill_null(0).to_numpy(), known, np.diff(rows) + 1, closed)
        if writer is not None:
            docs, total = writer.close()
            out.close()
            where.move(name, name.rpartition(f".{task.taskAttemptId()}.tmp")[0])
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([task.partitionId()], pa.int64()), "path": [final], "docs": pa.array([docs], pa.int64()), "ids": pa.array([total], pa.int64())}
            )

    files = ordered.mapInArrow(write, "part long, path string, docs long, ids long").collect()
    return [(f.path, f.docs, f.ids) for f in sorted(files)]


def read_corpus(spark: SparkSession, files: list[tuple[str, int, int]], row, schema: str) -> DataFrame:
    """One task per file; ``row(reader, first, after, ids, base)`` makes a batch for a stretch of documents.

    ``base`` is the number of ids in all files before.
    """
    base, table = 0, []
    for path, _, ids in files:
        table.append((path, base))
        base += ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                with _open(path, "r")[2] as file:
                    reader = Reader(file)
                    for first, after, ids in reader.stretches():
                        yield row(reader, first, after, ids, before)

    manifest = spark.createDataFrame(table, "path string, base long").repartition(max(1, len(table)))
    return manifest.mapInArrow(read, schema)


def _digest(reader: Reader, first: int, after: int, ids: np.ndarray, base: int) -> pa.RecordBatch:
    starts = reader.starts[first : after + 1]
    raw, at = ids.astype("<u4").tobytes(), (starts - starts[0]).tolist()
    docs = pa.array(reader.docs[first:after], mask=reader.known[first:after] == 0)
    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at, at[1:])]
    return pa.RecordBatch.from_arrays(
        [docs, pa.array(base + starts[:-1]), pa.array(np.diff(starts)), pa.array(crc, pa.int64())],
        names=["doc_id", "start", "n_tokens", "ids_crc32"],
    )


@query("op7_token_files")
def op7_token_files(spark, sf_dir):
    import public_tokenizers

    files = write_corpus(C.documents(spark, sf_dir), C.scratch_dir(spark), public_tokenizers.path("word_bpe_49k.json"))
    return read_corpus(spark, files, _digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
