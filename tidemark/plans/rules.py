"""Alert rules over the merged section streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.select import merge


@dataclass(frozen=True)
class Rule:
    """A named rule: ``plan`` turns the merged stream into alert rows, ``fields`` are emitted."""

    name: str
    plan: Callable[[DataFrame], DataFrame]
    fields: Sequence[str]


def alerts(stream: DataFrame, rules: Sequence[Rule], now) -> DataFrame:
    """Alert messages of all rules, each as JSON of its fields plus rule name and time."""
    parts = []
    for rule in rules:
        rows = rule.plan(stream)
        body = [F.col(f) for f in rule.fields]
        stamped = F.struct(*body, F.lit(rule.name).alias("alert"), now.alias("timestamp"))
        parts.append(rows.select(F.lit(rule.name).alias("alert"), F.to_json(stamped).alias("value")))
    return merge(*parts)
