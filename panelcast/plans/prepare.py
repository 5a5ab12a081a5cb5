"""From bars to the training frame: digest gate, snapshot, finished rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelcast.operators.features import finalize
from panelcast.operators.splits import long_enough
from panelcast.session import materialize
from panelcast.sources import digest as D
from panelcast.sources.snapshot import Snapshot


def prepare(bars: DataFrame, snapshot: Snapshot, expected: DataFrame | None = None) -> DataFrame:
    """The training frame of ``bars``.

    With an ``expected`` digest tree (``level, node, rows, digest``) bars that
    differ from it are refused, naming the days, before anything is computed.
    Features come from the snapshot, brought up to date where the bars differ from
    those it was made of.
    """
    days = materialize(D.day_digests(bars))  # read by the gate and by the snapshot
    if expected is not None:
        D.check_digests(D.digest_tree(days), expected)
    return long_enough(finalize(snapshot.refresh(bars, days)))
