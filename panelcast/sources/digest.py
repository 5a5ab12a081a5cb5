"""Digests of a day-keyed table as a tree: day, month, year, table.

A day's digest is that of its rows (``store.row_digest``), and every node above
sums the digests below it, so equal tables have equal trees whatever their order,
and two trees that differ name the days that do.  One aggregation; the tree has a
row per day, month and year, however many rows a day holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.schema import DATE
from panelcast.session import materialize
from panelcast.sources.store import row_digest

#: Levels from the root, and the text that names a node.
LEVELS = {"table": None, "year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd"}
#: Days that an error message names; the tables of differences hold all.
NAMED = 10


def day_digests(df: DataFrame, columns: list[str] | None = None, date: str = DATE) -> DataFrame:
    """``date, rows, digest`` per day."""
    return df.groupBy(date).agg(F.count(F.lit(1)).alias("rows"), F.sum(row_digest(df, columns)).alias("digest"))


def digest_tree(days: DataFrame, date: str = DATE) -> DataFrame:
    """``level, node, rows, digest`` from a table of day digests."""
    nodes = [F.struct(F.lit(level).alias("level"), (F.lit("") if form is None else F.date_format(date, form)).alias("node")) for level, form in LEVELS.items()]
    wide = days.select(F.explode(F.array(*nodes)).alias("n"), "rows", "digest")
    return wide.groupBy("n.level", "n.node").agg(F.sum("rows").alias("rows"), F.sum("digest").alias("digest"))


def differences(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """``level, node, status`` of the nodes of two trees that differ: changed, missing or extra."""
    a, e = actual.alias("a"), expected.alias("e")
    both = a.join(e, (F.col("a.level") == F.col("e.level")) & (F.col("a.node") == F.col("e.node")), "full")
    status = (
        F.when(F.col("a.level").isNull(), "missing")
        .when(F.col("e.level").isNull(), "extra")
        .when((F.col("a.rows") != F.col("e.rows")) | (F.col("a.digest") != F.col("e.digest")), "changed")
    )
    named = both.select(F.coalesce("a.level", "e.level").alias("level"), F.coalesce("a.node", "e.node").alias("node"), status.alias("status"))
    return named.where(F.col("status").isNotNull())


def check_digests(actual: DataFrame, expected: DataFrame) -> None:
    """Raise, naming days, if two trees differ."""
    # Read up to three times: stored, so that the rows are digested once.
    wrong = materialize(differences(actual, expected))
    days = wrong.where(F.col("level") == "day")
    n = days.count()
    if n or not wrong.isEmpty():
        named = [f"{r.node} ({r.status})" for r in days.orderBy("node").limit(NAMED).collect()]
        raise ValueError(f"the data differ from the expected digest on {n} days: {', '.join(named)}{', ...' if n > NAMED else ''}")
