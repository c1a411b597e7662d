"""Topic sources and sinks. The connector package must be on the session's classpath."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source_options(
    servers: str, topics: Sequence[str], *, from_start: bool = False, per_trigger: int | None = None
) -> dict[str, str]:
    """Reader options: newest messages unless ``from_start``; a lost offset range is skipped."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest" if from_start else "latest",
        "failOnDataLoss": "false",
    }
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def read_topics(spark: SparkSession, servers: str, topics: Sequence[str], **options) -> DataFrame:
    """Messages of the topics as UTF-8 text in ``value`` (with ``key``, ``topic`` and ``timestamp``)."""
    raw = spark.readStream.format("kafka").options(**source_options(servers, topics, **options)).load()
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "timestamp")


def key_value_map(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Each message as a one-entry map from its key to its value."""
    entry = F.create_map(F.col("key").cast("string"), F.col("value").cast("string"))
    return raw.select(*keep, entry.alias("entry"))


def write_topics(messages: DataFrame, servers: str, checkpoint: str | None = None):
    """Append ``topic``/``value`` rows; a streaming frame needs its checkpoint folder."""
    if messages.isStreaming:
        return (
            messages.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("checkpointLocation", checkpoint)
            .start()
        )
    return messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
