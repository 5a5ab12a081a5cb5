"""Token counts under a unigram vocabulary: Viterbi that carries scores and counts only.

The vocabulary's pieces go into an Aho-Corasick automaton, which lists the
pieces that end at each character, longest first.  Dynamic programming keeps,
per position, the best score, the number of pieces on that path and how many of
them are bytes of characters outside the vocabulary; no path is stored.

Tie rule of the unigram lattice: a candidate replaces the best
only if its score is strictly higher, and earlier starts come first, so of
equal scores the longest last piece wins; a character that no single-character
piece covers may be unknown, at the lowest score minus 10, and comes last.  An
unknown character counts as its UTF-8 bytes (byte fallback).  Scores add up in
float64 within one unit, so paths are compared exactly (float32 sums over a long
text are not).

Units: text gets a leading space and every space becomes U+2581.  No piece of
the vocabulary goes on over such a mark (checked when it is loaded) or holds a
line break, so a text's count is the sum over its units, and each distinct unit
is solved once per worker.

Defined results: NULL or empty text has 0 tokens.  Rows are independent.  An
empty table gives no rows.  Only the id and text columns are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from panelcast.llm import common as C
from panelcast.llm.pool import Pool
from panelcast.llm.registry import query

# Fixed values of the sentencepiece file format and encoder.
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
NORMAL, USER_DEFINED, UNUSED = 1, 4, 5


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at : at + size]
        at += size


def read_pieces(path: str) -> dict[str, float]:
    """The ordinary pieces of a sentencepiece model file and their scores."""
    with open(path, "rb") as f:
        model = f.read()
    out = {}
    for field, value in _fields(model):
        if field == 1:
            piece = dict(_fields(value))
            if piece.get(3, NORMAL) == NORMAL:
                out[piece[1].decode()] = struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]
    return out


class Unigram:
    def __init__(self, pieces: dict[str, float]):
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in pieces):
            raise ValueError("a piece goes on over a word's start or a line break")
        self.unknown = min(pieces.values()) - UNKNOWN_PENALTY
        self.single = {p for p in pieces if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for p, score in pieces.items():
            self.automaton.add_word(p, (len(p), score))
        self.automaton.make_automaton()
        self.pool = Pool(self._count_units)

    def count(self, unit: str) -> tuple[int, int]:
        """(tokens, those that are bytes of unknown characters) of a text whose spaces are marked."""
        n = len(unit)
        score = [0.0] * (n + 1)
        tokens, fallback = [0] * (n + 1), [0] * (n + 1)
        done = 0

        def unknown(to: int) -> None:
            """Settle the positions up to ``to`` that end in an unknown character."""
            nonlocal done
            while done < to:
                done += 1
                char = unit[done - 1]
                best = found.get(done)
                if char not in self.single:
                    other = score[done - 1] + self.unknown
                    if best is None or other > best[0]:
                        width = len(char.encode())
                        best = (other, tokens[done - 1] + width, fallback[done - 1] + width)
                score[done], tokens[done], fallback[done] = best

        found: dict[int, tuple[float, int, int]] = {}
        for last, (length, own) in self.automaton.iter(unit):
            end = last + 1
            if end - 1 > done:
                unknown(end - 1)
            start = end - length
            value = score[start] + own
            best = found.get(end)
            if best is None or value > best[0]:
                found[end] = (value, tokens[start] + 1, fallback[start])
        unknown(n)
        return tokens[n], fallback[n]

    def _count_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out = np.zeros((len(units), 2), np.int32)
        for k, unit in enumerate(units):
            for line in unit.split("\n"):
                if line:
                    out[k] += self.count(line)
            out[k] += unit.count("\n")  # one unknown byte each
        return out.ravel(), np.full(len(units), 2, np.int64)

    def count_batch(self, text: pa.Array) -> np.ndarray:
        """Rows of (tokens, bytes of unknown characters), one per text."""
        text = text.cast(pa.large_string()).fill_null("")
        # A run of spaces is one unit with the word after it.
        cuts = pc.split_pattern(text, " ")
        rows = cuts.offsets.to_numpy() - cuts.offsets[0].as_py()
        coded = cuts.flatten().dictionary_encode()
        words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        blank = np.fromiter((not w for w in words), bool, len(words))[codes]
        lengths = pc.binary_length(text).to_numpy()
        # Empty cuts are the inner spaces of a run: texts that have one are counted whole.
        runs = np.zeros(len(text), bool)
        runs[np.searchsorted(rows, np.flatnonzero(blank), side="right") - 1] = True
        runs &= lengths > 0
        live = ~runs & (lengths > 0)
        use = np.repeat(live, np.diff(rows))
        distinct, back = np.unique(codes[use], return_inverse=True)
        places = self.pool.find([SPACE + words[k] for k in distinct.tolist()])
        ids, _ = self.pool.gather(places[back], np.zeros(1, np.int64))
        sums = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(ids.reshape(-1, 2).astype(np.int64), axis=0)])
        ends = np.concatenate([[0], np.cumsum(np.where(live, np.diff(rows), 0))])
        out = sums[ends[1:]] - sums[ends[:-1]]
        for k in np.flatnonzero(runs):
            whole = SPACE + text[int(k)].as_py().replace(" ", SPACE)
            own, _ = self._count_units(self._units(whole))
            out[k] = own.reshape(-1, 2).sum(axis=0, dtype=np.int64)
        return out

    @staticmethod
    def _units(marked: str) -> list[str]:
        """Cut before every mark that follows another character."""
        units, at = [], 0
        for k in range(1, len(marked)):
            if marked[k] == SPACE and marked[k - 1] != SPACE:
                units.append(marked[at:k])
                at = k
        return [*units, marked[at:]]


def vocabulary(path: str) -> Unigram:
    return C.held(("unigram", path), lambda: Unigram(read_pieces(path)))


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, n_fallback`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(path)
        for batch in batches:
            for piece in C.slices(batch, text_col):
                with C.no_cycles():
                    n = model.count_batch(piece.column(text_col))
                yield pa.RecordBatch.from_arrays([piece.column(id_col), pa.array(n[:, 0]), pa.array(n[:, 1])], names=["id", "n_tokens", "n_fallback"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"id {kind}, n_tokens long, n_fallback long").withColumnRenamed("id", id_col)


@query("op9_token_counts")
def op9_token_counts(spark, sf_dir):
    import public_tokenizers

    return count_tokens(C.documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
