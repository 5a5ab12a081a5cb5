import random

from pyspark.sql import functions as F

from panelcast.llm import runs
from panelcast.llm import substring_dedup as S


def sizes(spark, monkeypatch, n):
    """(groups, largest bucket in bytes of keys, largest number of rows of a group) for n texts, 600 bytes a group."""
    rng = random.Random(n)
    rows = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) if k % 3 else "one shared passage " * 30) for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(runs, "repeated_keys", lambda texts, emit, buckets: texts.groupBy("g").applyInArrow(emit, runs._KEYS).where(F.col("b") < buckets))
    texts, groups = runs.grouped(df, "doc_id", "text", 600)
    sent = runs.shared_anchors(texts, groups, S.word_items(50))
    bucket = sent.groupBy("b").agg(F.sum(F.length("k")).alias("s")).agg(F.max("s")).head()[0]
    return groups, bucket, sent.groupBy("g").count().agg(F.max("count")).head()[0]


def test_buckets_do_not_grow_with_the_input(spark, monkeypatch):
    small, large = sizes(spark, monkeypatch, 60), sizes(spark, monkeypatch, 1500)
    assert large[0] > 20 * small[0]  # groups follow the input
    # Keys spread evenly; the passage that a third of the texts share is one entry per group that holds it.
    spread = large[0] * 8 * 3
    assert large[1] < 4 * small[1] + spread and large[2] < 4 * small[2] + 100
