"""Sinks of streams and batches: roll-up store, topics, keyed state tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import rollup
from tidemark.sources.kafka import write_topics
from tidemark.sources.messages import to_messages

_ROLLUPS = {"flow": rollup.flows, "event": rollup.events, "monitor": rollup.monitor}


def write_section(
    df: DataFrame,
    kind: str,
    *,
    topic: str | None = None,
    servers: str | None = None,
    path: str | None = None,
    checkpoint: str | None = None,
):
    """A section's records: to its topic when one is configured, else rolled up per
    minute into Parquet partitioned by hour."""
    if topic is not None:
        return write_topics(to_messages(df, topic), servers, checkpoint)
    rolled = rollup.by_hour(_ROLLUPS[kind](df))
    if df.isStreaming:
        return (
            rolled.writeStream.format("parquet")
            .partitionBy("hour")
            .option("checkpointLocation", checkpoint)
            .option("path", path)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    return rolled.repartition("hour", F.pmod(F.hash("minute"), F.lit(16))).write.mode("append").partitionBy("hour").parquet(path)


def run_available(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over everything available, into a Parquet folder, and read it back."""
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def upsert_latest(df: DataFrame, key: str, fields: Sequence[str], root: str, checkpoint: str, *, ts="ts", seq="seq"):
    """Keep the latest value of each key: every micro-batch is reduced to one row per
    key and merged into a new version of the table."""
    from tidemark.operators.records import state_upsert
    from tidemark.operators.tables import save

    kept = list(dict.fromkeys([ts, seq, *fields]))

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(key, *kept)
        if batch_id > 0:
            rows = rows.unionByName(batch.sparkSession.read.parquet(f"{root}/version={batch_id - 1}").select(key, *kept))
        latest = state_upsert(rows, key, [c for c in kept if c != ts], ts=ts, seq=seq)
        save(latest, root, batch_id, replace=True)

    return (
        df.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
