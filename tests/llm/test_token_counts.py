import random

import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece

from panelcast.llm import token_counts as T

PATH = P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_tokens string, score double"
TEXTS = ["Hello the world and", None, "", " ", "  a  b   c ", "\n\n a\n", "x\ty", "日本語 テキスト", "😀 é\x00", "word " * 20_000, "a" * 30_000, "▁ already ▁marked", "line\nline two\n"]


def brute(text, pieces):
    """Plain Viterbi over the whole marked text with the same tie rule."""
    if not text:
        return 0, 0
    t = T.SPACE + text.replace(" ", T.SPACE)
    unknown = min(pieces.values()) - 10
    longest = max(map(len, pieces))
    best = [(0.0, 0, 0)] + [None] * len(t)
    for end in range(1, len(t) + 1):
        for start in range(max(0, end - longest), end):
            piece = t[start:end]
            score = pieces.get(piece)
            width = (1, 0)
            if score is None:
                if end - start > 1:
                    continue
                score, width = unknown, (len(piece.encode()),) * 2
            s, n, f = best[start]
            if best[end] is None or s + score > best[end][0]:
                best[end] = (s + score, n + width[0], f + width[1])
    return best[-1][1:]


@pytest.fixture(scope="module")
def pieces():
    return T.read_pieces(PATH)


def test_equals_brute_force_with_ties():
    rng = random.Random(1)
    for _ in range(60):
        vocabulary = {T.SPACE: -3.0, "a": -2.0}
        for _ in range(25):
            p = "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 5)))
            vocabulary[rng.choice(["", T.SPACE]) + p] = float(-rng.randrange(1, 6))
        model = T.Unigram(vocabulary)
        texts = ["".join(rng.choice("abbcé d\n ") for _ in range(rng.randrange(40))) for _ in range(30)]
        got = model.count_batch(pa.array(texts))
        assert [tuple(r) for r in got.tolist()] == [brute(t, vocabulary) for t in texts]


def test_best_score_path_is_the_lattice_s(tmp_path, pieces):
    """The library's lattice, told that the same pieces form a unigram model, finds paths of the same length."""
    out = b""
    for field, value in T._fields(open(PATH, "rb").read()):
        if field == 2:
            value = b"".join(_field(a, 1 if a == 3 else b) for a, b in T._fields(value) if a in (3, 4, 35))
        out += _field(field, value)
    (tmp_path / "unigram.model").write_bytes(out)
    lattice = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "unigram.model"))
    rng = random.Random(2)
    syllables = ["th", "er", "in", "tion", "ung", "é", "s", "whe", "and", "."]
    model = T.Unigram(pieces)
    for _ in range(150):
        text = " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 6))) for _ in range(4))
        paths = lattice.nbest_encode_as_pieces(text, 3)
        score = lambda path: sum(pieces[p] for p in path)
        top = [len(p) for p in paths if score(p) == max(map(score, paths))]
        assert model.count_batch(pa.array([text]))[0, 0] in top


def _field(number, value):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    return varint(number << 3) + varint(value) if isinstance(value, int) else varint(number << 3 | 2) + varint(len(value)) + value


def test_documents(spark, pieces):
    rows = [(k, t, "x", None) for k, t in enumerate(TEXTS)] + [(None, "the end", None, 1.0), (3, " ", "x", None)]
    got = T.count_tokens(spark.createDataFrame(rows, SCHEMA), PATH).collect()
    small = [r for r in rows if len(r[1] or "") < 5000]
    assert sorted(((r.doc_id, r.n_tokens, r.n_fallback) for r in got if r.doc_id not in (9, 10)), key=str) == sorted(((r[0], *brute(r[1], pieces)) for r in small), key=str)
    n = {r.doc_id: r.n_tokens for r in got}
    one = T.Unigram(pieces).count(T.SPACE + "word")[0]
    assert n[9] == 20_000 * one + brute("a ", pieces)[0] - brute("a", pieces)[0] and 0 < n[10] < 30_000


def test_empty_table(spark):
    assert T.count_tokens(spark.createDataFrame([], SCHEMA), PATH).count() == 0
