"""Streams into the store, and event-time windows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators import require
from tidemark.store.snapshots import SnapshotTable


def merge_sink(stream: DataFrame, target: Callable[[], SnapshotTable], keys: Sequence[str], mode: str = "upsert", newest_by: str | None = None) -> DataStreamWriter:
    """Each micro-batch merged into a snapshot table by its keys.

    A batch that is run again after a failure is told by its number, committed with its rows, and left out. Of several
    rows of a key in one batch the newest by newest_by counts. A batch rewrites only the files that hold its keys.
    """
    require(stream, keys)

    def write(batch: DataFrame, number: int) -> None:
        table = target()
        if newest_by:
            best = F.max_by(F.struct(*batch.columns), F.struct(newest_by, *batch.columns)).alias("row")
            batch = batch.groupBy(*keys).agg(best).select("row.*")
        else:
            batch = batch.dropDuplicates(list(keys))
        if not table.exists():
            table.overwrite(batch, properties={"stream_batch": number})
        elif table.manifest()["properties"].get("stream_batch", -1) < number:
            table.merge(batch, keys, mode, {"stream_batch": number})

    return stream.writeStream.foreachBatch(write)


def windowed_counts(events: DataFrame, time: str, keys: Sequence[str], width: str = "1 day", late: str = "2 days", value: str | None = None) -> DataFrame:
    """Counts, and sums of a value, by keys and window of event time; rows later than `late` are left out of a stream.

    The same for a stream and a table.
    """
    require(events, [time, *keys])
    stamped = events.withColumn(time, F.col(time).cast("timestamp"))
    marked = stamped.withWatermark(time, late) if events.isStreaming else stamped
    sums = [F.sum(F.col(value).cast("decimal(18,4)")).cast("double").alias(f"{value}_sum")] if value else []
    grouped = marked.groupBy(F.window(time, width).alias("w"), *keys).agg(F.count("*").alias("n"), *sums)
    return grouped.select(F.col("w.start").alias("window_start"), *keys, "n", *(f"{value}_sum" for _ in sums))
