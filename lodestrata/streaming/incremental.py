"""Structured Streaming forms of the incremental operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_texts(stream: DataFrame, *, text: str, at: str, keep: str = "1 day") -> DataFrame:
    """The first row of each text within the watermark; the batch ledger stays the authority beyond it."""
    hashed = stream.withColumn("text_hash", F.sha2(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), 256))
    return hashed.withWatermark(at, keep).dropDuplicatesWithinWatermark(["text_hash"])


def windowed_counts(stream: DataFrame, *, at: str, every: str = "1 hour", late: str = "2 hours", keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    rows = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    counted = rows.groupBy(F.window(at, every).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return counted.select(F.col("w.start").alias("started"), *keys, "n", "total")


def sessions(stream: DataFrame, *, at: str, gap: str = "30 minutes", late: str = "2 hours", key: str = "user_id") -> DataFrame:
    rows = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return rows.groupBy(key, F.session_window(at, gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("started"), "n")


def host_limits(stream: DataFrame, *, cooldown: float = 30.0, most: float = 60.0) -> DataFrame:
    """(host, url, start) of fetches asked for at (host, url, at, delay, failed): when each may start, in seconds.

    Per host a fetch waits `delay` after the one before, doubled for every failure in a row up to `most` more, and for the cooldown after a
    failure. The state of a host is three numbers: the last start, the failures in a row, the end of the cooldown.
    """

    def plan(key: tuple[str], batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, errors, until = state.get if state.exists else (float("-inf"), 0, float("-inf"))
        rows = pd.concat(list(batches)).sort_values(["at", "url"])
        out = []
        for url, at, delay, failed in zip(rows["url"], rows["at"], rows["delay"], rows["failed"]):
            extra = min(2.0**errors, most) if errors else 0.0
            last = max(at, last + delay + extra, until)
            errors, until = (errors + 1, last + cooldown) if failed else (0, float("-inf"))
            out.append((key[0], url, last))
        state.update((last, errors, until))
        yield pd.DataFrame(out, columns=["host", "url", "start"])

    return stream.groupBy("host").applyInPandasWithState(plan, "host string, url string, start double", "last double, errors int, until double", "append", "NoTimeout")


def manifest_updates(stream: DataFrame, root: str, checkpoint: str, *, key: str = "key", digest: str = "digest") -> None:
    """Brings a manifest (key, digest) under root up to what has arrived: each batch is compared with the current version and a new
    one is published behind the pointer; a batch that changes nothing publishes nothing."""
    from ..operators.registry import manifest_diff
    from ..sources.sinks import current, publish

    def apply(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = batch.groupBy(key).agg(F.max(digest).alias(digest))
        name = current(spark, root)
        if name is None:
            publish(fresh, root, key)
            return
        held = spark.read.parquet(f"{root}/{name}")
        changed = manifest_diff(held, fresh, key, digest).where(F.col("status").isin("new", "changed")).select(key)
        if changed.take(1):
            publish(held.join(changed, key, "left_anti").unionByName(fresh.join(changed, key, "left_semi").select(*held.columns)), root, key)

    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Processes what is there, writes it as Parquet and stops."""
    query = stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
