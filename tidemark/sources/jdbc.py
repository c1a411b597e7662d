"""Relational event tables and lookups through the JDBC source."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

RELOAD_SECONDS = 30 * 60
RETRY_SECONDS = 5 * 60


def read_options(
    url: str, table: str, *, split_on: str | None = None, bounds: tuple | None = None, parts: int = 1, **connection: str
) -> dict[str, str]:
    """Reader options. ``split_on`` with ``bounds`` reads ranges of a column in parallel."""
    options = {"url": url, "dbtable": table, **connection}
    if split_on is not None and bounds is not None:
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(parts),
        }
    return options


def read_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """An event table; Spark pushes filters and columns to the database."""
    return spark.read.format("jdbc").options(**read_options(url, table, **options)).load()


def append(df: DataFrame, url: str, table: str, **connection: str) -> None:
    """Insert rows."""
    df.write.format("jdbc").options(url=url, dbtable=table, **connection).mode("append").save()


def update_statement(table: str, staging: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """One statement that applies a staged batch of updates to the table."""
    same = " AND ".join(f"{table}.{k} = {staging}.{k}" for k in keys)
    sets = ", ".join(f"{c} = (SELECT {staging}.{c} FROM {staging} WHERE {same})" for c in columns)
    return f"UPDATE {table} SET {sets} WHERE EXISTS (SELECT 1 FROM {staging} WHERE {same})"


def delete_statement(table: str, staging: str, keys: Sequence[str]) -> str:
    """One statement that deletes the staged keys from the table."""
    same = " AND ".join(f"{table}.{k} = {staging}.{k}" for k in keys)
    return f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} WHERE {same})"


def apply_batch(batch: DataFrame, url: str, staging: str, statement: str, execute: Callable[[str], None], **connection: str) -> None:
    """For ``foreachBatch``: stage the batch's rows (one per key), then run one set-based statement.

    ``execute`` runs a statement on the caller's own database connection.
    """
    batch.write.format("jdbc").options(url=url, dbtable=staging, truncate="true", **connection).mode("overwrite").save()
    execute(statement)


class Reloading:
    """A lookup frame that is loaded again when it is stale; after a failed load the old
    one stays and the next try comes sooner."""

    def __init__(self, load: Callable[[], DataFrame], clock: Callable[[], float] = time.time):
        self.load, self.clock = load, clock
        self.frame: DataFrame | None = None
        self.due = float("-inf")

    def get(self) -> DataFrame | None:
        if self.clock() >= self.due:
            try:
                self.frame = self.load()
                self.due = self.clock() + RELOAD_SECONDS
            except Exception:
                self.due = self.clock() + RETRY_SECONDS
                if self.frame is None:
                    raise
        return self.frame
