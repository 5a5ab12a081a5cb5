"""Byte-level BPE: encoding by a lazily built transducer, streaming decoding.

Merges are not replayed over the text.  A sequence of tokens is the BPE
encoding of its bytes exactly if every two neighbours are (each pair encodes to
itself), so for every prefix of the bytes the last token is unique: it is the
one suffix token that may follow the last token of the prefix before it.  The
transducer reads one byte at a time and keeps the last tokens of the prefixes
that a longer token could still reach back to.  As soon as all of those agree
on a token, it is emitted; no token is longer than ``longest``, so the
lookahead is bounded.  Its state is (last emitted token, pending bytes).
States and transitions are made when first reached (lazy determinisation) and
kept in a bounded memo.

Decoding joins the tokens' bytes; ``Utf8Stream`` turns any stream of byte
pieces into text with a state machine that holds back an unfinished character.

Defined results: NULL text encodes as the empty text, to no ids.  Rows are
independent, so repeated rows get equal results.  An empty table gives no
rows.  Only the id and text columns are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from panelcast.llm import common as C
from panelcast.llm.pool import Pool
from panelcast.llm.registry import query

START = -1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """BPE by its definition: join the neighbours of lowest rank, leftmost first.  Only for short pieces."""
    parts = [piece[k : k + 1] for k in range(len(piece))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda k: ranks.get(parts[k] + parts[k + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return parts


def splits(left: bytes, right: bytes, ranks: dict[bytes, int]) -> bool:
    """Whether BPE of ``left + right`` never joins across the place where they meet."""
    whole = left + right
    parts = [whole[k : k + 1] for k in range(len(whole))]
    none = 1 << 60
    ranked = [ranks.get(whole[k : k + 2], none) for k in range(len(whole) - 1)]
    gap = len(left) - 1  # the pair that spans the place
    while ranked:
        low = min(ranked)
        if low == none:
            return True
        at = ranked.index(low)
        if at == gap:
            return False
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del ranked[at]
        gap -= at < gap
        if at:
            ranked[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
        if at < len(ranked):
            ranked[at] = ranks.get(parts[at] + parts[at + 1], none)
    return True


class Transducer:
    """Byte pieces to token ids."""

    def __init__(self, ranks: dict[bytes, int], states: int = 400_000):
        self.ranks, self.states = ranks, states
        # Tokens that merging their own bytes can make; others never come out of BPE.
        self.tokens = {t: i for t, i in ranks.items() if len(t) == 1 or merge(t, ranks) == [t]}
        self.bytes = {i: t for t, i in self.tokens.items()}
        self.unfinished = {t[:k] for t in self.tokens for k in range(1, len(t))}
        self.longest = max(map(len, self.tokens), default=1)
        self.single = [bytes((k,)) for k in range(256)]
        self.pairs: dict[tuple[int, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.number: dict[tuple, int] = {}
        # (last emitted token, pending bytes, last token of each pending prefix, where that token begins)
        self.state: list[tuple] = []
        self.moves: dict[int, tuple] = {}  # 256 * state + byte -> (state, emitted ids)
        self.start = self._state(START, b"", (), ())

    def _state(self, before: int, pending: bytes, lasts: tuple, begins: tuple) -> int:
        key = (before, pending)
        at = self.number.get(key)
        if at is None:
            at = self.number[key] = len(self.state)
            self.state.append((before, pending, lasts, begins))
        return at

    def _follows(self, a: int, b: int) -> bool:
        """Whether token b may come right after token a."""
        if a == START:
            return True
        if len(self.pairs) > 5 * self.states:
            self.pairs.clear()
        ok = self.pairs[a, b] = splits(self.bytes[a], self.bytes[b], self.ranks)
        return ok

    @staticmethod
    def _path(lasts: tuple, begins: tuple, end: int) -> list[int]:
        """Tokens of the pending prefix of ``end`` bytes."""
        out = []
        while end:
            out.append(lasts[end - 1])
            end = begins[end - 1]
        return out[::-1]

    def _next(self, at: int, byte: int) -> tuple[int, tuple]:
        before, pending, lasts, begins = self.state[at]
        pending += self.single[byte]
        n = len(pending)
        reach = n - self.longest if n > self.longest else 0
        tokens, pairs, prior = self.tokens, self.pairs, (before, *lasts)
        rests = [pending[k:] for k in range(reach, n)]
        for k, rest in enumerate(rests, reach):
            t = tokens.get(rest)
            if t is None:
                continue
            ok = pairs.get((prior[k], t))
            if ok or (ok is None and self._follows(prior[k], t)):
                break
        else:
            raise ValueError(f"no token ends with byte {byte}")
        lasts += (t,)
        begins += (k,)
        # The tokens begin at boundaries that form a tree.  A token that is still
        # unfinished can only begin where the rest is the start of a longer token;
        # all tokens before the place where the paths to those and to the end meet are certain.
        meet, unfinished = n, self.unfinished
        for k, rest in enumerate(rests, reach):
            if rest in unfinished:
                while meet != k:
                    if meet > k:
                        meet = begins[meet - 1]
                    else:
                        k = begins[k - 1]
                if not meet:
                    return self._state(before, pending, lasts, begins), ()
        path = self._path(lasts, begins, meet)
        begins = tuple([b - meet for b in begins[meet:]])
        return self._state(path[-1], pending[meet:], lasts[meet:], begins), tuple(path)

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.state) > self.states:
            self._reset()
        out: list[int] = []
        at, get = self.start, self.moves.get
        for byte in piece:
            move = get(at << 8 | byte)
            if move is None:
                if len(self.state) > 2 * self.states:  # a single huge piece: forget all but where we are
                    here = self.state[at]
                    self._reset()
                    at, get = self._state(*here), self.moves.get
                move = self.moves[at << 8 | byte] = self._next(at, byte)
            at, emitted = move
            if emitted:
                out += emitted
        _, pending, lasts, begins = self.state[at]
        return out + self._path(lasts, begins, len(pending))


class Utf8Stream:
    """Incremental UTF-8 decoding: bytes in any pieces, text out; an invalid byte becomes U+FFFD."""

    # Lead byte ranges, the number of bytes that follow, and the range of the first of those (fixed by UTF-8).
    LEADS = (
        (0xC2, 0xDF, 1, 0x80, 0xBF),
        (0xE0, 0xE0, 2, 0xA0, 0xBF),
        (0xE1, 0xEC, 2, 0x80, 0xBF),
        (0xED, 0xED, 2, 0x80, 0x9F),
        (0xEE, 0xEF, 2, 0x80, 0xBF),
        (0xF0, 0xF0, 3, 0x90, 0xBF),
        (0xF1, 0xF3, 3, 0x80, 0xBF),
        (0xF4, 0xF4, 3, 0x80, 0x8F),
    )

    def __init__(self):
        self.need, self.low, self.high, self.value = 0, 0x80, 0xBF, 0

    def feed(self, data: bytes) -> str:
        if not self.need:
            try:
                return data.decode()  # the whole piece starts and ends between characters
            except UnicodeDecodeError:
                pass
        out = []
        for b in data:
            if self.need and self.low <= b <= self.high:
                self.need, self.low, self.high, self.value = self.need - 1, 0x80, 0xBF, self.value << 6 | b & 0x3F
                if not self.need:
                    out.append(chr(self.value))
                continue
            if self.need:
                out.append("�")
                self.need = 0
            if b < 0x80:
                out.append(chr(b))
                continue
            for first, last, need, low, high in self.LEADS:
                if first <= b <= last:
                    self.need, self.low, self.high, self.value = need, low, high, b & (0x3F >> need)
                    break
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        cut, self.need = self.need, 0
        return "�" if cut else ""


class ByteBpe:
    """Texts to ids and back with one vocabulary; pieces are split off by ``pattern``.

    ``memo`` bounds what is remembered (pieces, units, states); it changes time only.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = 400_000):
        self.pattern = regex.compile(pattern)
        self.memo = memo
        self.transducer = Transducer(ranks, memo)
        self.table = np.full(max(ranks.values()) + 1, b"", dtype=object)
        for token, i in ranks.items():
            self.table[i] = token
        self.pieces: dict[str, list[int]] = {}
        self.pool = Pool(self._encode_units, memo * 5 // 4)
        self.space = regex.compile(r"\s")
        self.decimal = [str(i) for i in range(len(self.table))]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known = self.pieces
        for piece in self.pattern.findall(text):
            ids = known.get(piece)
            if ids is None:
                if len(known) > self.memo:
                    known.clear()
                ids = known[piece] = self.transducer.encode(piece.encode())
            out += ids
        return out

    def _encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self.encode(u) for u in units]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.int32, int(counts.sum())), counts

    def encode_batch(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and each text's offsets into them.

        A single space between two characters that are not white space starts a
        piece whatever surrounds it, so texts are cut there and only distinct cuts
        are encoded.  Texts with other white space at a cut are encoded whole.
        """
        text = text.cast(pa.large_string()).fill_null("")
        cuts = pc.split_pattern(text, " ")
        rows = cuts.offsets.to_numpy() - cuts.offsets[0].as_py()
        coded = cuts.flatten().dictionary_encode()
        words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        space = self.space.match
        bad_start = np.fromiter((not w or space(w) is not None for w in words), bool, len(words))[codes]
        bad_end = np.fromiter((not w or space(w[-1]) is not None for w in words), bool, len(words))[codes]
        first, last = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
        first[rows[:-1]] = last[rows[1:] - 1] = True  # a split gives one cut at least
        bad = np.flatnonzero((bad_start & ~first) | (bad_end & ~last))
        whole = np.zeros(len(text), bool)
        whole[np.searchsorted(rows, bad, side="right") - 1] = True
        regular = np.repeat(~whole, np.diff(rows))
        # A cut that is not the first of its text begins with the space.
        unit = (codes * 2 + first)[regular]
        present = np.zeros(2 * len(words), bool)
        present[unit] = True
        distinct, back = np.flatnonzero(present), (np.cumsum(present) - 1)[unit]
        names = [words[u >> 1] if u & 1 else " " + words[u >> 1] for u in distinct.tolist()]
        counts = np.where(whole, 0, np.diff(rows))
        ids, ends = self.pool.gather(self.pool.find(names)[back], np.concatenate([[0], np.cumsum(counts)]))
        if not whole.any():
            return ids, ends
        odd = np.flatnonzero(whole)
        extra = [np.array(self.encode(text[int(k)].as_py()), np.int32) for k in odd]
        ids = np.insert(ids, np.repeat(ends[odd], [len(x) for x in extra]), np.concatenate(extra))
        sizes = np.diff(ends)
        sizes[odd] = [len(x) for x in extra]
        return ids, np.concatenate([[0], np.cumsum(sizes)])

    def decode_bytes(self, ids: Iterable[int] | np.ndarray) -> bytes:
        return b"".join(self.table[np.asarray(ids, np.int64)].tolist())

    def decode_stream(self, pieces: Iterable[Iterable[int]]) -> Iterator[str]:
        """Text of ids that arrive in pieces; a character split between tokens waits for its end."""
        stream = Utf8Stream()
        for ids in pieces:
            yield stream.feed(self.decode_bytes(list(ids)))
        yield stream.end()


def vocabulary(path: str, pattern: str, memo: int = 400_000) -> ByteBpe:
    return C.held(("byte_bpe", path, pattern, memo), lambda: ByteBpe(read_ranks(path), pattern, memo))


def _pieces(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from C.slices(batch, text_col, 4_000_000)


def _streamed(bpe: ByteBpe, ids: list[int]) -> str:
    return "".join(bpe.decode_stream(ids[k : k + 4096] for k in range(0, len(ids), 4096)))


def encode_and_check(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", memo: int = 100_000) -> DataFrame:
    """``id_col, n_tokens, ids array<int>, exact`` for every row; ``exact``: decoding the ids gives the text again.

    ``memo`` is small, because the rows' ids fill the executor's memory beside it.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path, pattern, memo)
        for piece in _pieces(batches, text_col):
            with C.no_cycles():
                ids, ends = bpe.encode_batch(piece.column(text_col))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32()))
                exact = [
                    _streamed(bpe, ids[a:b].tolist()) == (text or "")
                    for a, b, text in zip(ends[:-1].tolist(), ends[1:].tolist(), piece.column(text_col).to_pylist())
                ]
            yield pa.RecordBatch.from_arrays(
                [piece.column(id_col), pa.array(np.diff(ends)), lists, pa.array(exact, pa.bool_())], names=["id", "n_tokens", "ids", "exact"]
            )

    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(id_col, text_col).mapInArrow(encode, f"id {kind}, n_tokens long, ids array<int>, exact boolean")
    return out.withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every row and decodes its ids again: ``id_col, n_tokens, ids_sha256, decoded_sha256, exact``.

    ``exact`` tells whether the streamed decoding equals the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path, pattern)
        name = bpe.decimal.__getitem__
        for piece in _pieces(batches, text_col):
            with C.no_cycles():
                ids, ends = bpe.encode_batch(piece.column(text_col))
                texts = piece.column(text_col).to_pylist()
                listed, sha_ids, sha_out, exact = ids.tolist(), [], [], []
                for a, b, text in zip(ends[:-1].tolist(), ends[1:].tolist(), texts):
                    own = listed[a:b]
                    sha_ids.append(hashlib.sha256(" ".join(map(name, own)).encode()).hexdigest())
                    decoded = _streamed(bpe, own)
                    sha_out.append(hashlib.sha256(decoded.encode()).hexdigest())
                    exact.append(decoded == (text or ""))
            yield pa.RecordBatch.from_arrays(
                [piece.column(id_col), pa.array(np.diff(ends), pa.int64()), pa.array(sha_ids, pa.string()), pa.array(sha_out, pa.string()), pa.array(exact, pa.bool_())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "exact"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean"
    return df.select(id_col, text_col).mapInArrow(run, schema).withColumnRenamed("id", id_col)


@query("op2_byte_bpe")
def op2_byte_bpe(spark, sf_dir):
    import public_tokenizers as P

    return round_trip(C.documents(spark, sf_dir), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
