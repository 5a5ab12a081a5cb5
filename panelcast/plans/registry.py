"""Query registry and the shared builders every registered query starts from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelcast.operators import features as feat
from panelcast.operators.splits import long_enough
from panelcast.sources import bars as B

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, oracle)
        return fn

    return deco


def panel(spark: SparkSession, sf_dir: str, which: str = "main") -> DataFrame:
    return B.load_panel(spark, sf_dir, which)


def panel_buckets(spark: SparkSession, sf_dir: str) -> int:
    """Buckets of tables derived from the main panel: as many as it has partitions."""
    return B.panel_parts(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def main_features(spark: SparkSession, sf_dir: str, form: str = "dataframe") -> DataFrame:
    return feat.build_features(panel(spark, sf_dir), form=form)


def training_frame(spark: SparkSession, sf_dir: str, form: str = "dataframe") -> DataFrame:
    """Rows of all series that are long enough; the query ``short_series`` lists the others."""
    return long_enough(feat.finalize(main_features(spark, sf_dir, form)))
