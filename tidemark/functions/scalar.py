"""Scalar functions with the engine's arithmetic, conversion and text rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = {"int": 0, "long": 1, "float": 2, "double": 3}
_SPARK = {"int": "int", "long": "bigint", "float": "float", "double": "double", "string": "string", "bool": "boolean"}
_NAME = {
    T.IntegerType: "int", T.LongType: "long", T.FloatType: "float",
    T.DoubleType: "double", T.StringType: "string", T.BooleanType: "bool",
}


def type_name(df: DataFrame, name: str) -> str:
    return _NAME[type(df.schema[name].dataType)]


def promoted(df: DataFrame, a: str, b: str) -> str:
    """Result type of arithmetic: DOUBLE > FLOAT > LONG > INT; INT widens to BIGINT."""
    best = max(type_name(df, a), type_name(df, b), key=_RANK.__getitem__)
    return {"int": "bigint", "long": "bigint"}.get(best, best)


def arithmetic(df: DataFrame, a: str, op: str, b: str) -> Column:
    """``+ - * %`` in the promoted type, ``/`` always floating."""
    x, y = F.col(a), F.col(b)
    if op == "/":
        return divide(x, y)
    kind = promoted(df, a, b)
    x, y = x.cast(kind), y.cast(kind)
    if op == "%":
        return F.when(y != 0, F.try_mod(x, y))
    return {"+": x + y, "-": x - y, "*": x * y}[op]


def divide(a: Column, b: Column) -> Column:
    """Floating division; by zero it gives an infinity, or NaN for 0/0."""
    x, y = a.cast("double"), b.cast("double")
    by_zero = (
        F.when(x > 0, F.lit(float("inf"))).when(x < 0, F.lit(float("-inf"))).when(x == 0, F.lit(float("nan")))
    )
    return F.when(y == 0, by_zero).otherwise(F.try_divide(x, y))


def convert(df: DataFrame, name: str, to: str, fmt: str | None = None, fmt_to: str | None = None) -> Column:
    """``convert``: between the six types, or between times and text with formats.

    A value that cannot be read gives null. Times are UTC milliseconds.
    """
    source, c = type_name(df, name), F.col(name)
    if fmt is not None:
        if source == "long" and to == "string":
            return F.date_format(F.timestamp_millis(c), fmt)
        if source == "string" and to == "long":
            return F.unix_millis(F.try_to_timestamp(c, F.lit(fmt)))
        if source == "string" and to == "string" and fmt_to:
            return F.date_format(F.try_to_timestamp(c, F.lit(fmt)), fmt_to)
        raise TypeError(f"no time conversion from {source} to {to}")
    if to == "string":
        return c.cast("string")
    if source == "bool":
        return c if to == "bool" else c.cast("int").cast(_SPARK[to])
    if to == "bool":
        if source == "string":
            return F.lower(c) == "true"
        return c == 1
    if source == "string":
        return F.trim(c).try_cast(_SPARK[to])
    return c.try_cast(_SPARK[to])


def coalesce(df: DataFrame, *names: str) -> Column:
    """First non-null of columns of one type."""
    if len({type_name(df, n) for n in names}) > 1:
        raise TypeError("coalesce needs arguments of one type")
    return F.coalesce(*[F.col(n) for n in names])


def concat(*parts: Column) -> Column:
    """Text of all parts; null prints as ``null``."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])


def is_match(pattern: str, value: Column) -> Column:
    """Whole-text regular expression match."""
    return F.coalesce(value.rlike(f"^(?:{pattern})$"), F.lit(False))


def sine(value: Column) -> Column:
    return F.sin(value.try_cast("double"))


def item_at(slot: Column, place: int | str = "last") -> Column:
    """Event of a counted pattern slot: ``e[0]``, ``e[last]``; null when absent."""
    return F.try_element_at(slot, F.lit(-1 if place == "last" else place + 1))
