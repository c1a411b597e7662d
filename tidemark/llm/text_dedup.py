"""Near-duplicate documents by a forest of sorted MinHash signatures.

A document is the set of its distinct shingles of five words. Two documents are linked where the Jaccard similarity of their
sets is at least ``percent`` of a hundred; components of links are the groups of near-duplicates.

1. Every document gets a MinHash signature of ``DEPTH`` values for each tree. Documents with equal sets are one class; only one
   per class goes on, however many copies there are.
2. A tree of the forest is an order of the signature: its values from another start. Classes that agree in the first
   ``DEPTH`` values of a tree share a region there; two sets of similarity s meet in none of n trees with probability
   (1 - s^4)^n. There are as many trees as bring that to ``MISS`` at the limit: 16 at 0.85, 22 at 0.80.
3. In the sorted order of each tree a class has its neighbours with the longest common prefix next to it. Over all trees
   it keeps the one with the longest, so the depth at which it looks follows the density of its region. It is compared
   with that neighbour and with the first document of each of its regions.
4. What these comparisons have joined is not compared again. A region that still holds several components is finished
   exactly: every two members of different components are compared, in blocks of bounded size, without emitting pairs.

So a link is lost only where no tree brings its two sets together; all comparisons are exact, on the full sets. Regions are
grouped with partial results, sorted by ranges or cut into blocks, so one that holds a large share of all documents is
spread over tasks.

Defined cases: letters A-Z are lower-cased; a document of fewer than five words is one shingle, of no words (or null) has no
shingle and is linked with nothing; rows that repeat, also under one id, are documents of one class and link through
it; rows without an id are returned with component null and kept, and link with nothing; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components, joined
from tidemark.llm.storage import saved, text_column

WORDS = 5
DEPTH = 4
#: Probability that two sets at the limit share no region, at most.
MISS = 1e-5
#: Values of a tree's order by which neighbours are sorted.
SORTED = 12
BLOCK_ROWS = 256
_FIXED = np.random.default_rng(17)
_OF_PLACE = _FIXED.integers(1 << 62, size=WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OF_COUNT = _FIXED.integers(1 << 63, size=WORDS, dtype=np.uint64)


def trees(percent: int) -> int:
    """Trees of the forest for a limit; three at least, so that the values of an order are different ones."""
    met = (percent / 100) ** DEPTH
    return 3 if met >= 1 else max(3, math.ceil(math.log(MISS) / math.log1p(-met)))


@lru_cache
def _functions(values: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and terms of the hash functions, one for each value of a signature."""
    fixed = np.random.default_rng(18).integers(1 << 63, size=(values, 2), dtype=np.uint64)
    return fixed[:, 0] | np.uint64(1), fixed[:, 1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64 over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word):
        import xxhash

        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def shingle_set(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    if len(hashes) < WORDS:
        if not len(hashes):
            return hashes
        whole = (hashes * _OF_PLACE[: len(hashes)]).sum(dtype=np.uint64) + _OF_COUNT[len(hashes)]
        return mixed(np.array([whole], np.uint64))
    size = len(hashes) - WORDS + 1
    total = hashes[:size] * _OF_PLACE[0]
    for place in range(1, WORDS):
        total += hashes[place : place + size] * _OF_PLACE[place]
    return np.unique(mixed(total))


def signature(shingles: np.ndarray, values: int) -> np.ndarray:
    """The smallest of each of the hash functions over the set."""
    factors, terms = _functions(values)
    low = np.full(values, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(shingles), 2048):
        part = shingles[start : start + 2048, None] * factors + terms
        np.minimum(low, (part >> np.uint64(32)).astype(np.uint32).min(0), out=low)
    return low


def _features(batches: Iterator[pa.RecordBatch], values: int) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        sizes, nodes, signatures = [], [], []
        for text in batch.column(2):
            found = shingle_set(text.as_py())
            sizes.append(len(found))
            nodes.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            signatures.append(signature(found, values).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(signatures, pa.binary())],
            names=["doc_id", "text_key", "n_shingles", "node", "signature"],
        )


def _orders(signatures: np.ndarray) -> np.ndarray:
    """(row, tree, SORTED) values: the signature from another start in each tree."""
    values = signatures.shape[1]
    places = (np.arange(values // DEPTH)[:, None] * DEPTH + np.arange(SORTED)) % values
    return signatures[:, places]


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per class and tree."""
    with np.errstate(over="ignore"):
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = b"".join(batch.column(2).to_pylist())
            orders = _orders(np.frombuffer(raw, np.uint32).reshape(batch.num_rows, -1))
            count = orders.shape[1]
            region = np.zeros(orders.shape[:2], np.uint64)
            for depth in range(DEPTH):
                region = mixed(region * np.uint64(0x9E3779B97F4A7C15) + orders[:, :, depth].astype(np.uint64))
            at = np.repeat(np.arange(batch.num_rows), count)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(np.arange(count, dtype=np.int32), batch.num_rows)),
                    pa.array(region.ravel().astype(np.int64)),
                    batch.column(0).take(pa.array(at)),
                    batch.column(1).take(pa.array(at)),
                ],
                names=["tree", "region", "node", "first_id"],
            )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in sorted order; each with the next one of its region, both ways, and their common prefix."""
    last = None
    for batch in batches:
        out = []
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if last is not None and row[:2] == last[:2]:
                differ = np.flatnonzero(np.frombuffer(row[3], np.uint8) != np.frombuffer(last[3], np.uint8))
                depth = int(differ[0]) // 4 if len(differ) else SORTED
                out += [(row[2], last[2], depth), (last[2], row[2], depth)]
            last = row
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.binary(), pa.binary(), pa.int32()), strict=True)],
                names=["a", "b", "depth"],
            )


def _sorted_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the order bytes of the row's tree."""
    for batch in batches:
        orders = [
            np.take(np.frombuffer(s, np.uint32), tree * DEPTH + np.arange(SORTED), mode="wrap").astype(">u4").tobytes()
            for tree, s in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(orders, pa.binary())], names=["tree", "region", "node", "order"])


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _linked(shared, a, b, percent: int):
    return 100 * shared >= percent * (a + b - shared)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every two sets; shingles that only one of them has do not matter."""
    values, place, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    common = uses > 1
    column = np.cumsum(common) - 1
    keep = common[place]
    row, place = row[keep], column[place[keep]]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    counts = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(common.sum()), 2048):
        part = slice(*np.searchsorted(place, [low, low + 2048]))
        has = np.zeros((len(sets), 2048), np.float32)
        has[row[part], place[part] - low] = 1
        counts += has @ has.T
    return counts.astype(np.int64)


def near_duplicates(documents: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, component_id, kept, node, group.

    ``group`` is the component itself; where ids repeat, two groups can have the same smallest id.
    """
    rows = documents.select(documents[id_column].cast("long").alias("doc_id"), text_column(documents, text).alias("text"))
    keyed = rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    values = trees(percent) * DEPTH

    def features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _features(batches, values)

    features = saved(
        keyed.mapInArrow(features_of, "doc_id long, text_key long, n_shingles long, node binary, signature binary"), "minhash"
    )
    usable = features.filter("node is not null and doc_id is not null")
    classes = saved(
        usable.groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.first("signature").alias("signature")),
        "minhash-classes",
    )

    # Regions of every tree with at least two classes, and their first documents.
    placed = classes.select("node", "first.doc_id", "signature").mapInArrow(
        _regions, "tree int, region long, node binary, first_id long"
    )
    shared = placed.groupBy("tree", "region").agg(F.min(F.struct("first_id", "node")).alias("head"), F.count("*").alias("n"))
    shared = shared.filter("n > 1").select("tree", "region", "head.node").withColumnRenamed("node", "head")
    members = saved(placed.join(shared, ["tree", "region"]).select("tree", "region", "node", "head"), "minhash-regions")

    # Sets of the classes that have a partner in some tree.
    needed = members.select("node").distinct().join(classes.select("node", "first"), "node")
    needed = needed.select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.text_key").alias("text_key"))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "shingles"])

    texts = keyed.join(needed, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
    sets = saved(texts.select("node", "text").mapInArrow(sets_of, "node binary, shingles binary"), "minhash-sets")

    # Longest-common-prefix neighbours and first documents.
    ordered = (
        members.join(classes.select("node", "signature"), "node")
        .select("tree", "region", "node", "signature")
        .mapInArrow(_sorted_bytes, "tree int, region long, node binary, order binary")
        .repartitionByRange("tree", "region", "order", "node")
        .sortWithinPartitions("tree", "region", "order", "node")
    )
    beside = ordered.mapInArrow(_neighbours, "a binary, b binary, depth int").groupBy("a").agg(F.max_by("b", F.struct("depth", "b")).alias("b"))
    heads = members.filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    pairs = beside.select("a", "b").unionByName(heads).select(
        F.col("b").alias("b"), F.col("a").alias("a")
    ).distinct()

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(c)[k].as_py(), np.uint64) for c in (2, 3))
                if _linked(_shared(a, b), len(a), len(b), percent):
                    keep.append(k)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    with_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b")
    with_both = with_b.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a")
    links = saved(with_both.select("a", "b", "of_a", "of_b").mapInArrow(confirm, "a binary, b binary"), "minhash-links")

    rest = _open_regions(members, components(links))
    more = saved(_compare_blocks(rest, sets, percent), "minhash-links")
    groups = components(links.unionByName(more))

    # From classes back to documents: a component is named by its smallest id.
    named = classes.select(F.col("node").alias("_node"), F.col("first.doc_id").alias("first_id")).join(
        groups, F.col("_node") == F.col("node"), "left"
    ).select("_node", "first_id", F.coalesce("component", "_node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "component").select("_node", F.col("component").alias("group"), "component_id")
    out = features.select("doc_id", "text_key", "n_shingles", "node").join(
        named, (F.col("node") == F.col("_node")) & F.col("doc_id").isNotNull(), "left"
    )
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id", "text_key", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "node", "group",
    )


def _open_regions(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of regions that hold several components, dealt to comparisons of two blocks.

    The largest component of a region is its main part and need not be compared with itself; the others are cut into blocks
    that meet each other and the blocks of the main part.
    """
    known = members.join(labels.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left").select(
        "tree", "region", "node", F.coalesce("component", "node").alias("label")
    )
    known = saved(known, "minhash-labels")
    parts = known.groupBy("tree", "region", "label").agg(F.count("*").alias("n"))
    regions = (
        parts.groupBy("tree", "region")
        .agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("all"), F.count("*").alias("labels"))
        .filter("labels > 1")
        .select(
            "tree", "region", F.col("main.label").alias("main"),
            F.ceil((F.col("all") - F.col("main.n")) / BLOCK_ROWS).alias("small"), F.ceil(F.col("main.n") / BLOCK_ROWS).alias("large"),
        )
    )
    rows = known.join(regions, ["tree", "region"]).withColumn("is_main", F.col("label") == F.col("main"))
    own = F.when(F.col("is_main"), F.pmod(F.xxhash64("node"), F.col("large"))).otherwise(F.pmod(F.xxhash64("node"), F.col("small")))
    rows = rows.withColumn("own", own)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    of_small = F.sequence(zero, F.col("small") - one)
    of_large = F.sequence(zero, F.col("large") - one)
    # A comparison is (small block, other block): others below ``small`` are small blocks, then come those of the main part.
    for_main = F.transform(of_small, lambda i: F.struct(i.alias("i"), (F.col("small") + F.col("own")).alias("k")))
    for_small = F.concat(
        F.transform(of_small, lambda k: F.struct(F.least(k, "own").alias("i"), F.greatest(k, "own").alias("k"))),
        F.transform(of_large, lambda k: F.struct(F.col("own").alias("i"), (F.col("small") + k).alias("k"))),
    )
    return rows.select(
        "tree", "region", "node", "label", F.explode(F.when(F.col("is_main"), for_main).otherwise(for_small)).alias("at")
    ).select("tree", "region", "node", "label", "at.i", "at.k")


def _compare_blocks(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of different components, as one edge per member."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"a": pd.Series([], dtype=object), "b": pd.Series([], dtype=object)})
        labels = frame["label"].map(bytes).to_numpy()
        if len(set(labels.tolist())) < 2:
            return empty
        sets = [np.frombuffer(raw, np.uint64) for raw in frame["shingles"]]
        sizes = np.array([len(s) for s in sets])
        _, label = np.unique(labels.astype(object), return_inverse=True)
        shared = shared_counts(sets)
        i, j = np.nonzero(_linked(shared, sizes[:, None], sizes[None], percent) & (label[:, None] != label[None]))
        if not len(i):
            return empty
        root, nodes = joined(len(sets), i, j), frame["node"].to_numpy()
        hit = np.flatnonzero(root != np.arange(len(sets)))
        return pd.DataFrame({"a": nodes[hit], "b": nodes[root[hit]]})

    with_sets = rows.join(sets.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n")).drop("_n")
    return with_sets.groupBy("tree", "region", "i", "k").applyInPandas(compare, "a binary, b binary")
