"""What each of five filters removes, in every order of them, from one walk over their subsets.

Every document gets a mask of the filters that it fails. Documents are counted by part and mask, at most 32 cells a part.
A Gray-code walk then visits all 32 subsets of the filters, toggling one filter at a time: a counter per mask cell says how
many active filters the cell fails, and the survivors change only by the cells whose counter leaves or reaches zero. The
32 states are kept; any step of any order is the difference of two of them.

Defined cases: a null text is the empty text, a null source the part of the empty name; identical texts are compared by
their SHA-256; a null doc_id is neither smaller nor larger than another, so such a row never fails by identity and
makes no other fail; rows that repeat an id with the same text do not fail by each other; a document is good (toxic) if any
of its labels says so, unlabelled ones are neither; labels of a null id mean nothing; only doc_id, source and text are read,
whatever other columns are called; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import text_column

FILTERS = "ABCDE"
MEASURES = ("n", "good", "toxic")
LEAST_WORDS = 50
LEAST_DISTINCT = 65
MOST_CAPITALS = 5
#: Texts are read in blocks of about so many bytes.
BLOCK = 1 << 22
#: Parts answered at once: 600 rows each.
PARTS_AT_ONCE = 128

_SPACE = re.compile(rb"[\x20\x09-\x0D]").search
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = b"#$%&*|"
_INSIDE = bytes(range(0x80, 0xC0))


def blocks(raw: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """``raw`` cut before white space, so that no word is divided."""
    start = 0
    while start < len(raw):
        cut = _SPACE(raw, start + size) if start + size < len(raw) else None
        end = cut.start() if cut else len(raw)
        yield raw[start:end]
        start = end


def failures(raw: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = capitals = points = 0
    distinct: set[bytes] = set()
    symbols = False
    for block in blocks(raw):
        found = block.split()  # bytes.split() cuts at \x20 and \x09-\x0D alone
        words += len(found)
        distinct.update(found)
        capitals += len(block) - len(block.translate(None, _CAPITALS))
        points += len(block.translate(None, _INSIDE))
        symbols = symbols or len(block.translate(None, _SYMBOLS)) < len(block)
    failed = (
        words < LEAST_WORDS,
        100 * len(distinct) < LEAST_DISTINCT * words,
        100 * capitals > MOST_CAPITALS * points,
        symbols,
    )
    return sum(1 << bit for bit, fails in enumerate(failed) if fails)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        masks, keys = [], []
        for value in batch.column(2):
            raw = value.as_py()
            masks.append(failures(raw))
            keys.append(hashlib.sha256(raw).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(keys, pa.binary())],
            names=["doc_id", "part", "mask", "key"],
        )


def _label(labels: DataFrame, name: str) -> Column:
    return F.max(F.coalesce(labels[name].cast("int") == 1, F.lit(False)).cast("long")).alias(name)


def cells(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part and mask: (part, mask, n, good, toxic).

    Equal (text, id, part) are counted before anything is joined, and texts by part before they meet their smallest id, so
    a text that a third of all rows share is a few rows by then.
    """
    read = documents.select(
        documents["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(documents["source"].cast("string"), F.lit("")).alias("part"),
        text_column(documents, "text").cast("binary").alias("raw"),
    ).mapInArrow(_read, "doc_id long, part string, mask int, key binary")
    rows = read.groupBy("key", "doc_id", "part").agg(F.min("mask").alias("mask"), F.count("*").alias("n"))
    marks = (
        labels.filter(labels["doc_id"].isNotNull())
        .groupBy(labels["doc_id"].cast("long").alias("__id"))
        .agg(_label(labels, "quality"), _label(labels, "toxic"))
        .withColumn("__salt", F.lit(0).cast("long"))
    )
    # Rows without an id match nothing and are dealt by their text instead of to one task.
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("key")).otherwise(F.lit(0).cast("long"))
    marked = rows.join(marks, (F.col("doc_id") == F.col("__id")) & (salt == F.col("__salt")), "left").select(
        "key", "doc_id", "part", "mask", "n",
        (F.col("n") * F.coalesce("quality", F.lit(0))).alias("good"), (F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )
    here = F.struct(*MEASURES)
    no_id = F.col("doc_id").isNull()
    texts = marked.groupBy("key", "part").agg(
        F.min("mask").alias("mask"),
        F.min("doc_id").alias("least"),
        F.min_by(here, "doc_id").alias("first"),
        *[F.sum(m).alias(m) for m in MEASURES],
        *[F.sum(F.when(no_id, F.col(m)).otherwise(0)).alias(f"free_{m}") for m in MEASURES],
    )
    leasts = texts.groupBy(F.col("key").alias("__key")).agg(F.min("least").alias("__least"))
    seen = texts.join(leasts, F.col("key") == F.col("__key"))
    own_first = F.col("least") == F.col("__least")
    passing = {m: F.col(f"free_{m}") + F.coalesce(F.when(own_first, F.col(f"first.{m}")), F.lit(0)) for m in MEASURES}
    split = F.array(
        F.struct(F.col("mask"), *[passing[m].alias(m) for m in MEASURES]),
        F.struct(
            F.col("mask").bitwiseOR(F.lit(1 << FILTERS.index("E"))).alias("mask"),
            *[(F.col(m) - passing[m]).alias(m) for m in MEASURES],
        ),
    )
    each = seen.select("part", F.explode(split).alias("c")).select("part", "c.*").filter("n > 0")
    return each.groupBy("part", "mask").agg(*[F.sum(m).alias(m) for m in MEASURES])


def walk(counts: np.ndarray) -> np.ndarray:
    """Survivors of every subset of the filters; ``counts`` and result are (parts, 32, measures)."""
    size = counts.shape[1]
    bits = np.arange(size)
    failing = np.zeros(size, np.int64)
    survivors = counts.sum(axis=1)
    states = np.empty_like(counts)
    states[:, 0] = survivors
    subset = 0
    for turn in range(1, size):
        bit = (turn & -turn).bit_length() - 1
        subset ^= 1 << bit
        fails = (bits >> bit & 1).astype(bool)
        if subset >> bit & 1:
            survivors = survivors - counts[:, fails & (failing == 0)].sum(axis=1)
            failing[fails] += 1
        else:
            failing[fails] -= 1
            survivors = survivors + counts[:, fails & (failing == 0)].sum(axis=1)
        states[:, subset] = survivors
    return states


def _orders() -> tuple[np.ndarray, list[str]]:
    orders = list(permutations(range(len(FILTERS))))
    return np.array(orders), ["".join(FILTERS[f] for f in order) for order in orders]


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    orders, names = _orders()
    after = np.cumsum(1 << orders, axis=1)
    before = after - (1 << orders)
    everything = (1 << len(FILTERS)) - 1
    per_part = orders.size
    for batch in batches:
        for start in range(0, batch.num_rows, PARTS_AT_ONCE):
            some = batch.slice(start, PARTS_AT_ONCE)
            counts = np.zeros((some.num_rows, everything + 1, len(MEASURES)), np.int64)
            for row, held in enumerate(some.column(1).to_pylist()):
                for cell in held:
                    counts[row, cell["mask"]] = [cell[m] for m in MEASURES]
            states = walk(counts)
            kept = states[:, after, 0]
            removed = states[:, before] - states[:, after]
            failing = np.stack([counts[:, np.arange(everything + 1) >> f & 1 == 1, 0].sum(1) for f in range(len(FILTERS))], 1)
            alone = np.stack([states[:, everything ^ (1 << f), 0] - states[:, everything, 0] for f in range(len(FILTERS))], 1)
            shares = np.stack([removed[:, orders == f, 0].sum(1) for f in range(len(FILTERS))], 1)
            columns = {
                "part": pa.array([p for p in some.column(0).to_pylist() for _ in range(per_part)], pa.string()),
                "filter_order": pa.array([n for n in names for _ in FILTERS] * some.num_rows, pa.string()),
                "step": pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(names) * some.num_rows)),
                "kept": kept,
                "removed": removed[..., 0],
                "redundant": failing[:, orders] - removed[..., 0],
                "unique_fails": alone[:, orders],
                "good_lost": removed[..., 1],
                "toxic_lost": removed[..., 2],
                "shapley": shares[:, orders],
            }
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c.ravel()) for c in columns.values()], names=list(columns)
            )


SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    held = cells(documents, labels).groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))
    return held.mapInArrow(_steps, SCHEMA)
