"""Published signals in versions, with a completeness gate.

A publish adds a version folder; its success marker is the pointer, so readers see
the newest whole version and never half of one.  A row that lacks a required
value is not published: the series keeps the last good signal of the version
before, marked ``is_carried`` with the run that made it, and so does a series that
a run has no row for.  A run without any complete row is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.plans.publish import EXPORT_COLUMNS, incomplete_signals
from panelcast.schema import SERIES
from panelcast.session import materialize
from panelcast.sources.store import folders, has_success

SIGNAL_COLUMNS = [*EXPORT_COLUMNS, "run_id", "is_carried"]


class SignalStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def version(self) -> int:
        names = [n for n in folders(self.spark, self.root) if n.startswith("v") and n[1:].isdigit()]
        return max((int(n[1:]) for n in names if has_success(self.spark, f"{self.root}/{n}")), default=0)

    def read(self, version: int | None = None) -> DataFrame | None:
        version = version or self.version()
        return self.spark.read.parquet(f"{self.root}/v{version}").select(*SIGNAL_COLUMNS) if version else None

    def merged(self, export: DataFrame, run_id: str) -> DataFrame:
        """What a publish of ``export`` would store."""
        lacking = incomplete_signals(export).select(SERIES)
        new = export.join(lacking, SERIES, "left_anti").select(*EXPORT_COLUMNS, F.lit(run_id).alias("run_id"), F.lit(False).alias("is_carried"))
        old = self.read()
        if old is None:
            return new
        # A signal that is carried over is stale by definition.
        carried = old.join(new.select(SERIES), SERIES, "left_anti").withColumns({"is_carried": F.lit(True), "is_stale": F.lit(True)})
        return new.unionByName(carried.select(*SIGNAL_COLUMNS))

    def publish(self, export: DataFrame, run_id: str) -> DataFrame:
        """Store a run's signals as the next version and return it."""
        rows = materialize(self.merged(materialize(export), run_id))
        if rows.where(~F.col("is_carried")).isEmpty():
            raise ValueError(f"run {run_id} has no complete signal; the last version stays")
        version = self.version() + 1
        rows.write.mode("overwrite").parquet(f"{self.root}/v{version}")
        return self.read(version)
