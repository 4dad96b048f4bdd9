"""Clearing as a stream: each micro-batch recomputes the days it touches and replaces just those partitions, so late rows are
taken in and a replay changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clearing import clearing_rollup
from ..sources.tables import overwrite_partitions


def stream_clearing(arrivals: DataFrame, core: Callable[[], DataFrame], other: Callable[[], DataFrame], path: str, checkpoint: str, day: str = "dw_process_date"):
    """Starts a query over a stream of clearing details. A batch gives the days it has rows of (a day is a small value, so its
    distinct days fit the driver); core() and other() read all details of these days, and the result goes to path by region
    and day. Days are the state, kept in the table itself: no watermark, however late a row comes."""

    def replace(batch: DataFrame, _: int) -> None:
        days = [r[0] for r in batch.select(F.col(day).cast("string")).distinct().collect() if r[0] is not None]
        if days:
            overwrite_partitions(clearing_rollup(core(), other(), days), path, ["dw_merch_region_cd", "process_date"])

    return arrivals.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
