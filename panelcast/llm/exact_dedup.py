"""Exact dedup: rows grouped by a 128-bit content hash, bytes compared inside groups.

DataFrame operations only.  Classes are groups by (128-bit hash, text):
the hash decides where a row goes, and the grouping's key comparison is the
byte comparison, so two texts that share a hash stay two classes.  Copies are
combined before the shuffle, hence a class of a third of all rows sends one
row per map task.  Membership then travels by hash only; for a hash with more
than one class (a collision) the text itself joins.

Defined results: NULL text equals the empty text.  NULL ids rank below every
id for ``keep="largest"`` and above every id for ``keep="smallest"``.  Of
repeated rows (same id, same text) exactly one stays.  An empty table gives no
rows.  Other columns of the input, whatever their names, are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm import common as C
from panelcast.llm.registry import query


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8."""
    return F.unhex(F.md5(text.cast("binary")))


def _keyed(df: DataFrame, id_col: str, text_col: str, hash_of) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("__id"), hash_of(text).alias("__h"), text.alias("__t"))


def _classes(keyed: DataFrame, keep: str) -> DataFrame:
    pick = {"largest": F.max, "smallest": F.min}[keep]
    return keyed.groupBy("__h", "__t").agg(pick("__id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def mark_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", hash_of=content_hash
) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``."""
    sha = F.sha2(F.col("__t").cast("binary"), 256).alias("text_sha256")
    rows = _keyed(df, id_col, text_col, hash_of)
    # Classes per hash (written once: two branches read it); anything but one
    # class is a collision of different texts.
    by_hash = C.stored(
        _classes(rows, keep)
        .groupBy("__h")
        .agg(
            F.count(F.lit(1)).alias("__n"),
            F.first("keep_id").alias("keep_id"),
            F.first("group_size").alias("group_size"),
            F.first(sha).alias("text_sha256"),
        )
    )
    plain = (
        rows.groupBy("__h", "__id")
        .agg(F.count(F.lit(1)).alias("__m"))
        .join(by_hash.filter("__n = 1"), "__h")
        .select("__id", "__m", "keep_id", "group_size", "text_sha256")
    )
    # A written table, so that Spark knows its size (normally no row) before it
    # chooses how to join it with the texts.
    collisions = C.stored(by_hash.filter("__n > 1").select("__h"))
    hard = rows.join(collisions, "__h", "left_semi")
    collided = (
        hard.groupBy("__h", "__t", "__id")
        .agg(F.count(F.lit(1)).alias("__m"))
        .join(_classes(hard, keep), ["__h", "__t"])
        .select("__id", "__m", "keep_id", "group_size", sha)
    )
    return (
        plain.unionByName(collided)
        .withColumn("__k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__m"))))
        .select(
            F.col("__id").alias(id_col),
            "keep_id",
            "group_size",
            (F.col("__id").eqNullSafe(F.col("keep_id")) & (F.col("__k") == 1)).alias("kept"),
            "text_sha256",
        )
    )


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows that stay, with all their columns: one per distinct text (NULL as empty).

    Ties between repeated rows of one id go to the larger (``keep="smallest"``:
    smaller) remaining columns, so the choice does not depend on row order.
    """
    rest = [c for c in df.columns if c not in (id_col, text_col)]
    pick = {"largest": F.max, "smallest": F.min}[keep]
    sign = F.col(id_col).isNull() if keep == "smallest" else F.col(id_col).isNotNull()
    whole = F.struct(sign.alias("s"), F.col(id_col).alias("i"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(rest)], F.col(text_col).isNull().alias("n"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = df.groupBy(content_hash(text).alias("__h"), text.alias("__t")).agg(pick(whole).alias("__r"))
    cols = {id_col: F.col("__r.i"), text_col: F.when(~F.col("__r.n"), F.col("__t"))}
    cols |= {c: F.col(f"__r.c{k}") for k, c in enumerate(rest)}
    return kept.select(*[cols[c].alias(c) for c in df.columns])


SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


@query("op10_exact_dedup", SQL)
def op10_exact_dedup(spark, sf_dir):
    return mark_duplicates(C.documents(spark, sf_dir))
