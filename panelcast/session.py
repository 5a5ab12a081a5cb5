"""Session helpers.

Library functions never create a session: they take DataFrames and use
``df.sparkSession``. ``local_session`` is for tests, the bench and the
driver entry points only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this library assumes.  Timestamps are pinned to UTC so
# that ``CAST(ts AS DATE)`` gives the same calendar day as any other engine.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins on (series_id, bar_date) may reuse a series_id hash partitioning:
    # a series holds at most one row per day, so co-partitioning on the series
    # key alone cannot create the skew this guard is for.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
    # Materialised intermediates are compressed, and removed once unreferenced.
    "spark.checkpoint.compress": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "panelcast") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="panelcast-warehouse-"))
        .config("spark.driver.memory", os.environ.get("PANELCAST_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder, setting a scratch one only in local mode.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; when it is missing there, this raises instead of falling back to a
    machine-local folder that other executors could not read.  A fresh local
    folder is created only for a ``local[...]`` master with nothing configured
    (tests, the bench).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            current = None
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="panelcast-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_TEMPORARY = "panelcast_tmp_"


def materialize(df, bucket_by: list[str] | None = None, buckets: int | None = None, partition_by: list[str] | None = None):
    """Write ``df`` once as a Parquet table in the shared warehouse and read it back (lineage cut).

    Used for intermediates that several branches of one query read (the
    prediction table feeds the sweep, the fold metrics, AUC and the final
    split): computing them once instead of once per branch, from storage that
    survives the loss of an executor.  Readers scan only the columns they need,
    and with ``partition_by`` only the folders that their filter allows.

    With ``bucket_by`` the table carries that hash partitioning, so later
    windows and aggregations on those columns plan without an Exchange.
    ``release`` drops these tables when their results have been read.
    """
    import uuid

    spark = df.sparkSession
    name = _TEMPORARY + uuid.uuid4().hex
    writer = df.write.format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), *bucket_by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return spark.table(name).select(*df.columns)


def release(spark) -> int:
    """Drop all materialised intermediates (tables and files); how many there were."""
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith(_TEMPORARY)]
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return len(names)
