import hashlib
import random

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from panelcast.llm import byte_bpe as B

PATH = P.path("byte_bpe_50k.tiktoken")
MULTI = P.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, ids string, n_tokens int"
TEXTS = ["Hello  World, it's 12345 ok!", None, "", " ", "  a", "a  ", " \n\t x \n", "naïve café Ünïcode", "日本語 テキスト 你好世界", "emoji 😀👍🏽 x",
         "a b 　c d e", "a\x1cb \x1dc\x85 d", "don't I'll 'S we've", "x" * 5000, "ab " * 5000, "a\n b", "a \nb", "\tabc  def\t", "aaaaaaa bbbbb    ccc",
         "٣٤٥ ½ ²", "\x00\x01 z", "!!! ??? ---", "word.\nNext line.\n\nEnd\n"]


def library(path):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(path), special_tokens={})


@pytest.mark.parametrize("path", [PATH, MULTI])
def test_equals_tiktoken_and_decodes(path):
    enc, bpe = library(path), B.ByteBpe(B.read_ranks(path), P.PATTERN)
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("ab é日😀 \n'st.,1Tz") for _ in range(rng.randrange(200))) for _ in range(400)]
    texts += [" ".join("".join(rng.choice(["th", "er", "in", "tion", "é", "ung", "x"]) for _ in range(rng.randrange(1, 9))) for _ in range(50)) for _ in range(100)]
    ids, ends = bpe.encode_batch(pa.array(texts))
    for k, t in enumerate(texts):
        own = ids[ends[k] : ends[k + 1]].tolist()
        assert own == enc.encode_ordinary(t or ""), t
        assert own == bpe.encode(t or "")
        assert bpe.decode_bytes(own) == (t or "").encode()
        assert "".join(bpe.decode_stream([i] for i in own)) == (t or "")


def test_transducer_equals_merging_with_bounded_memory():
    ranks = B.read_ranks(PATH)
    small = B.Transducer(ranks, states=50)
    rng = random.Random(4)
    for _ in range(300):
        piece = bytes(rng.choice([*b"the andingzq", 0xC3, 0xA9]) for _ in range(rng.randrange(1, 40)))
        if piece in ranks:
            continue
        assert [small.bytes[i] for i in small.encode(piece)] == B.merge(piece, ranks)
        assert len(small.state) <= 2 * 50 + 1


def test_utf8_stream_equals_python():
    rng = random.Random(5)
    for _ in range(2000):
        data = bytes(rng.choice([65, 0x80, 0xBF, 0xC3, 0xA9, 0xE0, 0xA0, 0xED, 0x9F, 0xF0, 0x90, 0xF4, 0x8F, 0xFF, 0xC0]) for _ in range(rng.randrange(12)))
        s, out, at = B.Utf8Stream(), "", 0
        while at < len(data):
            to = at + rng.randrange(1, 4)
            out, at = out + s.feed(data[at:to]), to
        assert out + s.end() == data.decode(errors="replace")


def test_documents(spark):
    enc = library(PATH)
    rows = [(k, t, "x", None) for k, t in enumerate(TEXTS)] + [(None, "tail", None, 1), (3, TEXTS[3], "x", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = []
    for i, t, *_ in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), True))
    got = [tuple(r) for r in B.round_trip(df, PATH, P.PATTERN).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    ids = B.encode_and_check(df, PATH, P.PATTERN).collect()
    assert all(r.exact and r.n_tokens == len(r.ids) for r in ids)
    assert sorted((r.doc_id, len(r.ids)) for r in ids if r.doc_id is not None) == sorted(w[:2] for w in want if w[0] is not None)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert B.round_trip(df, PATH, P.PATTERN).count() == 0 and B.encode_and_check(df, PATH, P.PATTERN).count() == 0
