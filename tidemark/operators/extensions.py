"""User extensions: scalar, aggregate, transform and window functions by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from tidemark.operators.intervals import Mergeable

_SCALAR: dict[str, Callable[..., Column]] = {}
_AGGREGATE: dict[str, Callable[..., Column]] = {}
_TRANSFORM: dict[str, Callable[..., DataFrame]] = {}
_WINDOW: dict[str, Callable[..., DataFrame]] = {}
_MERGEABLE: dict[str, Callable[..., Mergeable]] = {}
_KINDS = {"scalar": _SCALAR, "aggregate": _AGGREGATE, "transform": _TRANSFORM, "window": _WINDOW, "mergeable": _MERGEABLE}


def extension(kind: str, name: str):
    """Register ``ns:fn``. Scalars and aggregates give Columns (built-ins or pandas UDFs),
    transforms give DataFrames, windows give change streams. Mergeable aggregates run in parts, over groups
    and over the changes of any window."""

    def register(fn):
        _KINDS[kind][name] = fn
        return fn

    return register


def lookup(kind: str, name: str) -> Callable:
    """A registered extension."""
    try:
        return _KINDS[kind][name]
    except KeyError:
        raise KeyError(f"no {kind} extension named {name}") from None


def call(kind: str, name: str, *args, **options):
    """Use a registered extension."""
    return lookup(kind, name)(*args, **options)


def transform(df: DataFrame, name: str, *args, **options) -> DataFrame:
    """``#transform.ns:fn(...)``"""
    return df.transform(lambda d: call("transform", name, d, *args, **options))
