import io
import zlib

import numpy as np
import public_tokenizers
import pytest

from panelcast.llm import token_files as T

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start string, n_tokens int"
TEXTS = ["Hello  World, it's 12345 ok!", None, "", " \n\t", "naïve café Ünïcode ÉCOLE ß İstanbul", "x́ ́y àb", "a b　c d",
         "日本語のテキスト 你好", "nul\0in word \0 end", "\0", "<|startoftext|> don't <|endoftext|>", "a<|endoftext|>B. <|ENDOFTEXT|>! <|endoftext|>. X<|startoftext|><|endoftext|>, <|EndOfText|>e", "<|endoftext|", "<|endoftext|>\0x", "emoji 😀👍🏽 x", "ΣΑΣ ΣΑΣ.", "a\x1cb\x85c", "word " * 30_000, "'s 't it'S", "K Å"]


def test_pack_round_trip():
    rng = np.random.default_rng(1)
    for bits in range(1, 33):
        ids = rng.integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
        packed = T.pack(ids, bits)
        assert len(packed) == -(-1001 * bits // 8)
        assert (T.unpack(packed, 1001, bits) == ids).all()
    assert T.bits_for(49408) == 16 and T.bits_for(65537) == 17 and T.bits_for(1) == 1


@pytest.mark.parametrize("bits", [11, 16])
def test_random_access(bits):
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 3000, 200)
    ids = rng.integers(0, 1 << bits, counts.sum()).astype(np.uint32)
    out = io.BytesIO()
    w = T.Writer(out, bits)
    cut = counts[:90].sum()
    w.add(np.arange(90), np.ones(90), counts[:90], ids[:cut])
    w.add(np.arange(90, 200), np.ones(110), counts[90:], ids[cut:])
    assert w.close() == (200, len(ids))
    r = T.Reader(out)
    ends = np.cumsum(counts)
    for k in rng.permutation(200):
        assert (r.document(k) == ids[ends[k] - counts[k] : ends[k]]).all()
    assert (np.concatenate([x for *_, x in r.stretches(5000)]) == ids).all()


def test_files_equal_the_library_on_whole_texts(spark, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    rows = [(i * 3 % 17, x, "s", i) for i, x in enumerate(TEXTS)] + [(None, "last", None, None), (3, "twin", None, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    files = T.write_corpus(df, f"file://{tmp_path}/tok", PATH, file_bytes=40_000)
    got = T.read_corpus(spark, files, T._digest, "doc_id long, start long, n_tokens long, ids_crc32 long").collect()
    at, want = 0, []
    for i, x, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] or "")):
        ids = np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert len(files) > 1
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_words_and_halves_equal_whole_texts():
    import pyarrow as pa
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    texts += ["A, b. c! d? e; f: g'. h's, i#, j_. K., ... ?! x²? ½. é́, ΑΣ, İ. ñ!! 'S. it's, O'Neil. ''. a'. 5'5.", "Ⅷ, ①. ª! ٣٤. x\u0301, \u0301. \u200b, ZWJ\u200d. \u0958. \u0130. \ufb2a! \u1100\u1161."] + TEXTS
    pool, _, special = T.word_encoder(PATH)
    ids, ends = T.encode_words(pa.array(texts), pool, special)
    for k, x in enumerate(texts):
        assert ids[ends[k] : ends[k + 1]].tolist() == t.encode(x or "", add_special_tokens=False).ids, x


def test_units_equal_halves_word_by_word():
    import pyarrow as pa

    words = ["Ab,", "it's", "...", "a.b!?", "x_.", "É.", "ÉCOLE;", "9:", "\0.", "a\x1c,", ";a", "Ab", "<|endoftext|>.", "ß", "K!", "-,"]
    whole = np.array(["<|" in w for w in words])
    units, at = T._units(pa.array(words, pa.large_string()), whole)
    assert [tuple(units[k] for k in pair) for pair in at] == [(w, "") if x else T._halves(w) for w, x in zip(words, whole)]
    assert len(set(units)) == len(units)
    assert T._units(pa.array([], pa.large_string()), whole[:0])[1].shape == (0, 2)


def test_empty_table(spark, tmp_path):
    files = T.write_corpus(spark.createDataFrame([], SCHEMA), f"{tmp_path}/none", PATH)
    assert files == []
    assert T.read_corpus(spark, files, T._digest, "doc_id long, start long, n_tokens long, ids_crc32 long").count() == 0
