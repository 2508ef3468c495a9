"""Incremental refresh from a stream of scraped rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from boutlake.operators.upsert import replace_scope, upsert
from boutlake.sources.store import Store

Load = Callable[[], DataFrame]
Save = Callable[[DataFrame], None]


def upsert_stream(stream: DataFrame, load: Load, save: Save, keys: Sequence[str], tracked: Sequence[str], keep_good: Sequence[str] = ()) -> DataStreamWriter:
    """Each batch is merged into the table; a batch that runs again changes nothing.

    save must not overwrite the files that load reads while it reads them: write a new version, then switch.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        save(upsert(load(), batch, keys, tracked, F.current_timestamp(), keep_good).drop("action"))

    return stream.writeStream.foreachBatch(merge).outputMode("append")


def merge_stream(stream: DataFrame, store: Store, name: str, tracked: Sequence[str], keep_good: Sequence[str] = ()) -> DataStreamWriter:
    """Each batch is merged into a store of buckets, of which only those with a changed row are written again.

    The store keeps the number of the last batch of name: one that runs again is left out.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        store.merge(batch, tracked, F.current_timestamp(), keep_good, (name, epoch))

    return stream.writeStream.foreachBatch(merge).outputMode("append")


def snapshot_stream(stream: DataFrame, load: Load, save: Save, scope: Sequence[str]) -> DataStreamWriter:
    """Each batch replaces the rows of the scopes that it holds."""

    def swap(batch: DataFrame, epoch: int) -> None:
        save(replace_scope(load(), batch, scope))

    return stream.writeStream.foreachBatch(swap).outputMode("append")


def events_per_window(stream: DataFrame, size: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Rows and values by event type and window of ts; a window closes once it is later than the watermark."""
    windowed = stream.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return windowed.select(F.col("window.start").alias("start"), "event_type", "n", "total")
