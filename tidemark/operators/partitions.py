"""Partitioned queries: independent instances per value or per named range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_value(df: DataFrame, columns: Sequence[str], out: str = "partition_key") -> DataFrame:
    """Key of the instance that handles a row; rows with different values never meet."""
    return df.withColumn(out, F.struct(*columns))


def by_range(df: DataFrame, ranges: Sequence[tuple[str, Column]], out: str = "partition_key") -> DataFrame:
    """Send each row to every range whose condition holds; other rows are dropped."""
    names = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in ranges]))
    return df.withColumn(out, F.explode(names))
