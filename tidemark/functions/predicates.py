"""Two-valued predicates: a comparison with null is false, and ``not_`` of it is true."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBERS = (T.IntegerType, T.LongType, T.ShortType, T.FloatType, T.DoubleType)
_TYPES = {
    "string": T.StringType,
    "int": T.IntegerType,
    "long": T.LongType,
    "float": T.FloatType,
    "double": T.DoubleType,
    "bool": T.BooleanType,
}


def truth(condition: Column) -> Column:
    """A boolean expression as a condition: null is false."""
    return F.coalesce(condition, F.lit(False))


def eq(a: Column, b: Column) -> Column:
    return truth(a == b)


def ne(a: Column, b: Column) -> Column:
    return truth(a != b)


def lt(a: Column, b: Column) -> Column:
    return truth(a < b)


def le(a: Column, b: Column) -> Column:
    return truth(a <= b)


def gt(a: Column, b: Column) -> Column:
    return truth(a > b)


def ge(a: Column, b: Column) -> Column:
    return truth(a >= b)


def and_(*conditions: Column) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & truth(c)
    return out


def or_(*conditions: Column) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | truth(c)
    return out


def not_(condition: Column) -> Column:
    return ~truth(condition)


def contains(a: Column, b: Column) -> Column:
    return truth(F.contains(a, b))


def instance_of(df: DataFrame, name: str, kind: str) -> Column:
    """``a instanceof type``: decided by the schema, false for null values."""
    same = isinstance(df.schema[name].dataType, _TYPES[kind])
    return F.col(name).isNotNull() if same else F.lit(False)


def _family(kind: T.DataType) -> str:
    if isinstance(kind, _NUMBERS):
        return "number"
    if isinstance(kind, T.BooleanType):
        return "bool"
    return "string" if isinstance(kind, T.StringType) else kind.simpleString()


def check_comparable(df: DataFrame, left: str, op: str, right: str) -> None:
    """Reject type pairs that cannot be compared, when the query is built."""
    a, b = (_family(df.schema[c].dataType) for c in (left, right))
    ordered = op in ("<", "<=", ">", ">=")
    if a != b or (ordered and a != "number"):
        raise TypeError(f"cannot compare {left} ({a}) {op} {right} ({b})")


def equals_field(name: str, value) -> Column:
    """Keep when the record's field has this value."""
    return eq(F.col(name), F.lit(value))


def present(*names: str) -> Column:
    """None of the named fields is null."""
    return and_(*[F.col(n).isNotNull() for n in names])


def universal_mac(mac: Column) -> Column:
    """False for locally administered addresses (second-lowest bit of the first octet)."""
    octet = F.conv(F.substring_index(mac, ":", 1), 16, 10).cast("int")
    return F.coalesce(octet.bitwiseAND(F.lit(2)) == 0, mac.isNull())
