"""A stored feature frame that follows its source day by day.

The snapshot keeps, beside the features, the digest of every source day it was
made from.  A refresh compares these with the source: with no difference the
stored frame is returned; otherwise features are computed anew from the first day
that differs, with as many earlier rows of each series as the longest frame
reaches back (and the one row before, whose label looks a day ahead).  Only
months that hold such rows are written; the others stay where they are.

A version is a folder of month folders and a manifest (months with their place,
days with their digest).  Writing the manifest is the last step and its success
marker is the pointer: readers take the highest version that has one, so a
refresh that breaks off changes nothing.  Concurrent refreshes of one snapshot
must be kept apart by the caller.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.operators.features import LOOK_BACK
from panelcast.schema import DATE, SERIES
from panelcast.session import materialize
from panelcast.sources import digest as D
from panelcast.sources.bars import ROWS_PER_TASK
from panelcast.sources.store import folders, has_success

_MONTH = "month"


class Snapshot:
    def __init__(self, spark: SparkSession, root: str, build: Callable[[DataFrame], DataFrame], look_back: int = LOOK_BACK):
        """``build`` makes the feature frame (one row per bar) from bars; a row's
        features may use ``look_back`` rows before it and its label one row after."""
        self.spark, self.root, self.build, self.look_back = spark, root.rstrip("/"), build, look_back

    # ------------------------------------------------------------- versions

    def version(self) -> int:
        """The newest complete version; 0 if there is none."""
        names = [n for n in folders(self.spark, self.root) if n.startswith("v") and n[1:].isdigit()]
        done = [int(n[1:]) for n in names if has_success(self.spark, f"{self.root}/{n}/days") and has_success(self.spark, f"{self.root}/{n}/months")]
        return max(done, default=0)

    def _months(self, version: int) -> dict[str, int]:
        """The version in which each month was written (one row per month of the calendar)."""
        if not version:
            return {}
        return {r[_MONTH]: r["version"] for r in self.spark.read.parquet(f"{self.root}/v{version}/months").collect()}

    def days(self, version: int | None = None) -> DataFrame | None:
        """Source digests per day of a version (the newest by default)."""
        version = version or self.version()
        return self.spark.read.parquet(f"{self.root}/v{version}/days") if version else None

    def read(self, version: int | None = None) -> DataFrame | None:
        version = version or self.version()
        if not version:
            return None
        return self._parts(self._months(version))

    def _parts(self, months: dict[str, int]) -> DataFrame:
        paths = [f"{self.root}/v{v}/data/{_MONTH}={m}" for m, v in sorted(months.items())]
        return self.spark.read.parquet(*paths)

    # -------------------------------------------------------------- refresh

    def changed(self, days: DataFrame) -> DataFrame:
        """Source days that differ from the snapshot: ``level, node, status``."""
        old = self.days()
        own = D.digest_tree(days)
        return D.differences(own, own.limit(0) if old is None else D.digest_tree(old)).where(F.col("level") == "day")

    def refresh(self, bars: DataFrame, days: DataFrame | None = None) -> DataFrame:
        """The feature frame of ``bars``, recomputed only where the source differs; ``days`` are their stored day digests, if known."""
        version = self.version()
        days = materialize(D.day_digests(bars)) if days is None else days
        first = self.changed(days).agg(F.min(F.to_date("node"))).head()[0]
        if first is None and version:
            return self.read(version)
        if not version or first is None:
            return self._publish(1 + version, self.build(bars), {}, days)
        before = bars.where(F.col(DATE) < F.lit(first))
        back = F.row_number().over(Window.partitionBy(SERIES).orderBy(F.col(DATE).desc()))
        tail = materialize(before.withColumn("_back", back).where(F.col("_back") <= self.look_back + 1))
        label_day = tail.where(F.col("_back") == 1).select(SERIES, F.col(DATE).alias("_from"))
        fresh = self.build(tail.drop("_back").unionByName(bars.where(F.col(DATE) >= F.lit(first))))
        # Of the earlier rows only the last of each series changes: its label looks at the next bar.
        fresh = fresh.join(label_day, SERIES, "left").where((F.col(DATE) >= F.lit(first)) | (F.col(DATE) == F.col("_from"))).drop("_from")
        fresh = materialize(fresh)
        months = self._months(version)
        month = F.date_format(DATE, "yyyy-MM")
        touched = {r[0] for r in fresh.select(month).distinct().collect()}  # months of the calendar
        touched |= {m for m in months if m >= first.strftime("%Y-%m")}
        rewritten = fresh
        if held := {m: v for m, v in months.items() if m in touched}:
            old = self._parts(held).where(F.col(DATE) < F.lit(first)).join(fresh.select(SERIES, DATE), [SERIES, DATE], "left_anti")
            rewritten = old.select(*fresh.columns).unionByName(fresh)
        return self._publish(version + 1, rewritten, {m: v for m, v in months.items() if m not in touched}, days)

    def _publish(self, version: int, rows: DataFrame, kept: dict[str, int], days: DataFrame) -> DataFrame:
        root = f"{self.root}/v{version}"
        # An incomplete version of that number is an attempt that broke off.
        of_month = F.date_format(DATE, "yyyy-MM")
        size = days.agg(F.sum("rows").alias("rows"), F.count_distinct(of_month).alias("months")).head()
        # A month goes to as many tasks as its rows need: else every task would write a file for every month.
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-(size["rows"] or 0) // ROWS_PER_TASK))
        share = F.pmod(F.xxhash64(SERIES), F.lit(-(-tasks // max(1, size["months"]))))
        dealt = rows.withColumn(_MONTH, of_month).repartition(tasks, _MONTH, share)
        dealt.write.mode("overwrite").partitionBy(_MONTH).parquet(f"{root}/data")
        written = [n.partition("=")[2] for n in folders(self.spark, f"{root}/data") if n.startswith(f"{_MONTH}=")]
        months = kept | {m: version for m in written}
        days.write.mode("overwrite").parquet(f"{root}/days")
        self.spark.createDataFrame(sorted(months.items()), f"{_MONTH} string, version int").coalesce(1).write.mode("overwrite").parquet(f"{root}/months")
        return self._parts(months) if months else rows.limit(0)
