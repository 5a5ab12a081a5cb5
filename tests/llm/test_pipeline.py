import re
from collections import Counter

import corpus_pipeline as P
import public_tokenizers
import tiktoken
from test_jaccard_join import brute as near_brute
from fractions import Fraction

from panelcast.llm import byte_bpe, mixing, quality

SF = "/root/testdata/sf0.001"


def test_stages_in_order_and_each_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in P.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "ngram_jaccard_join", "mix_sources", "byte_bpe"]
    steps = [docs]
    for _, stage in P.STAGES:
        steps.append(P.common.stored(stage(spark, steps[-1], SF)))
    for s in steps[:-1]:
        assert s.columns == docs.columns
    rows = [[tuple(r) for r in s.collect()] for s in steps]
    # 1: the rows that the operator keeps, whole.
    kept = {r.doc_id for r in quality.classify(docs, quality.labels_of(spark, SF)).collect() if r.keep}
    assert sorted(rows[1]) == sorted(r for r in rows[0] if r[0] in kept)
    # 2: the largest id of every text.
    last = {}
    for r in rows[1]:
        last[r[1]] = max(last.get(r[1], r), r)
    assert sorted(rows[2]) == sorted(last.values())
    # 3: the smallest id of every component of five-word shingle links.
    groups = near_brute(rows[2], Fraction(4, 5), 5)[0]
    assert sorted(r[0] for r in rows[3]) == sorted(i for i, _, c in groups if i == c)
    assert set(rows[3]) <= set(rows[2])
    # 4: whole copies of what the mix takes.
    taken = {r.doc_id: (r.size, r.taken) for r in mixing.mix_sources(steps[3]).collect()}
    copies = Counter(rows[4])
    for r in rows[3]:
        size, t = taken[r[0]]
        assert size == len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
        assert copies[r] == ((2 * t + size) // (2 * size) if size else 1)
    assert sum(copies.values()) == len(rows[4])
    # 5: the library's ids.
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = Counter((r[0], tuple(enc.encode_ordinary(r[1] or ""))) for r in rows[4])
    assert Counter((r[0], tuple(r[2])) for r in rows[5]) == want and all(r[3] for r in rows[5])


def test_run_handles_nulls_clashing_columns_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size long, taken string, key string, row_key int, c0 string"
    rows = [(k, f"some words of text number {k} " * 3, "en", f"s{k % 3}", 5, 1, "t", "k", 1, "c") for k in range(30)]
    rows += [(40, None, None, None, None, None, None, None, None, None), (41, "", "en", None, 0, 1, "", "", 1, ""), (None, "no id at all here", "en", "s1", 1, 1, "", "", 1, ""),
             rows[3], (42, rows[4][1], "de", "s0", 1, 2, "x", "y", 3, "z"), (43, "long " * 60_000, "en", "s2", 1, 2, "x", "y", 3, "z")]
    for name, part in (("some", rows), ("none", [])):
        spark.createDataFrame(part, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(k, 1) for k in range(20)] if part else [], "doc_id long, quality int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        out = P.run(spark, f"{tmp_path}/{name}")
        got = out.collect()
        assert all(r.exact for r in got)
        assert len(got) > 20 if part else got == []
    docs = spark.read.parquet(f"{tmp_path}/some/documents.parquet")
    # Columns named like those the stages work with keep their values.
    odd = docs.selectExpr("*", "doc_id + 7000 as __bits", "doc_id + 8000 as __limit", "doc_id as c1", "doc_id as label", "doc_id as id").drop("row_key").selectExpr("*", "doc_id + 9000 as row_key")
    whole = {str(r) for r in odd.collect()}
    for name, stage in P.STAGES[:-1]:
        got = stage(spark, odd, f"{tmp_path}/some")
        rows = got.collect()
        assert got.columns == odd.columns and rows and {str(r) for r in rows} <= whole, name
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, f"{tmp_path}/some").columns == docs.columns
