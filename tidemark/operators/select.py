"""Selection, membership and merging."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def passthrough(df: DataFrame) -> DataFrame:
    """No filter."""
    return df


def prefixed(df: DataFrame, source: str) -> DataFrame:
    """Columns named ``<source>_<attribute>``, as in a multi-source ``select *``."""
    return df.select(*[F.col(c).alias(f"{source}_{c}") for c in df.columns])


def section(df: DataFrame, name: str) -> DataFrame:
    """Tag rows with the section they come from."""
    return df.withColumn("section", F.lit(name))


def merge(*frames: DataFrame) -> DataFrame:
    """All rows of all streams; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def in_table(
    df: DataFrame, table: DataFrame, on: Sequence[tuple[str, str]], *, negate: bool = False
) -> DataFrame:
    """Rows with (without) a table row equal on the given column pairs."""
    right = table.select(*[F.col(r).alias(f"_m{i}") for i, (_, r) in enumerate(on)])
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_m{i}") for i, (c, _) in enumerate(on)])
    return df.join(right, same, "left_anti" if negate else "left_semi")


def in_table_theta(
    df: DataFrame, table: DataFrame, left: str, op: str, right: str, on: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """``[left op table.right in table]`` for ``<, <=, >, >=``.

    Some table row satisfies an inequality exactly when the table's extreme
    value does, so the table is reduced to one value (per ``on`` key) first.
    """
    extreme = F.min if op in (">", ">=") else F.max
    holds = {
        ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
        "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
    }[op]
    if not on:
        bound = table.agg(extreme(right)).scalar()
        return df.filter(F.coalesce(holds(F.col(left), bound), F.lit(False)))
    bounds = table.groupBy(*[F.col(r).alias(f"_m{i}") for i, (_, r) in enumerate(on)]).agg(
        extreme(right).alias("_bound")
    )
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_m{i}") for i, (c, _) in enumerate(on)])
    return df.join(bounds, same & holds(F.col(left), F.col("_bound")), "left_semi")
