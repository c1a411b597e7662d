"""Near-duplicate vectors by sorted projection passes.

Equal vectors are one class from the start. In each pass a class has a code of ``SIGNS`` signs of random projections, other
ones in every pass. The classes are ordered by their codes, and each is compared with the ``window`` classes that follow it
in that order by exact cosine in double precision; rows next to a block's border are lent to the block before. Components
join the verified pairs of all passes.

Then the regions are finished that windows leave open. A region are the classes whose codes share their first signs, as
many of them as bring a region to half a window if codes were spread evenly; in the order a region is a run. Where a region
is longer than a window, its pairs further apart are compared too, in blocks of ``BLOCK_ROWS`` places that all meet each
other, one task for two blocks, so a dense group is compared whole and spread over tasks. Passes grow with the signs of a
region: two vectors at the limit share no region of any pass with probability ``MISS`` at most, less above the limit,
however many rows there are and however dense they lie; windows that reach over the borders of regions find more.

A pair that several passes bring together counts in the first of them only, which the codes and places that every class
carries tell, so links are counted without listing pairs. Links of a task leave it as one edge per class. Work is
passes * rows * window, and for open regions the square of their size.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component link with nothing, nor do rows
without an id; a shorter vector counts as filled up with zeros; each row is a vector of its own, so rows that repeat an
id are copies of each other where their vectors are equal; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components, joined
from tidemark.llm.storage import saved

#: Fewest passes where there is more than one region.
PASSES = 8
#: Signs of a code; the order of a pass is that of its codes.
SIGNS = 62
#: Following classes of the order that a class is compared with; twice a region's classes, if codes were spread evenly.
WINDOW = 1024
#: Probability that a pair at the limit meets in no pass, at most.
MISS = 1e-6
#: Places of a block; a task compares a block with itself and the window behind it, or two blocks of a region.
BLOCK_ROWS = 4096


def unit_rows(vectors: list, width: int) -> np.ndarray:
    """Rows of length 1 in double precision; large and small components are scaled first."""
    x = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        x[i, : len(v)] = v
    x /= np.abs(x).max(1, initial=0, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def plan(classes: int, cosine: float, passes: int = PASSES, window: int = WINDOW) -> tuple[int, int]:
    """(signs that the codes of a region share, passes)."""
    bits = min(SIGNS, max(0, math.ceil(math.log2(max(1, 2 * classes) / window))))
    if classes <= window + 1 or not bits:
        return 0, 1
    met = (1 - math.acos(min(1.0, max(-1.0, cosine))) / math.pi) ** bits
    return bits, max(passes, math.ceil(math.log(MISS) / math.log1p(-met))) if met < 1 else passes


def sign_codes(x: np.ndarray, passes: int, seed: int) -> np.ndarray:
    """One code of ``SIGNS`` signs per row and pass, the first sign highest. The projections of a component do not
    depend on the width."""
    planes = np.random.default_rng(seed).normal(size=(x.shape[1], passes * SIGNS))
    signs = (x @ planes > 0).reshape(len(x), passes, SIGNS)
    return (signs * (np.int64(1) << np.arange(SIGNS - 1, -1, -1, dtype=np.int64))).sum(2)


def _classes(vectors: DataFrame, id_column: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """All rows (vec_id, v or null), and the classes of equal vectors (first_id, copies, v)."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(vector, lambda x: x != 0)
    fits = F.col(id_column).isNotNull() & F.col(vector).isNotNull() & ~F.coalesce(odd | zero, F.lit(True))
    # Floats stay floats until they are compared: half the bytes, the same numbers.
    single = vectors.schema[vector].dataType.elementType == T.FloatType()
    v = F.col(vector) if single else F.transform(vector, lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.when(fits, v).alias("v"))
    classes = rows.filter("v is not null").groupBy("v").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    return rows, classes


def _places(coded: DataFrame, classes: int, bits: int) -> DataFrame:
    """(rep, codes) -> (rep, pass, place, region): the place of a class in the order of each pass, from 0."""
    long = coded.select("rep", F.posexplode("codes").alias("pass", "code"))
    ordered = long.repartitionByRange("pass", "code", "rep").sortWithinPartitions("pass", "code", "rep")
    # The number of a row is its partition and its place there; both follow the order, and are fixed by being saved.
    ordered = ordered.select("rep", "pass", F.shiftright("code", SIGNS - bits).alias("region"), F.monotonically_increasing_id().alias("at"))
    ordered = saved(ordered, "vector-order").withColumn("part", F.shiftright("at", 33))
    parts = ordered.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # a row per partition
    place = F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1) - F.col("pass").cast("long") * classes
    return ordered.join(F.broadcast(starts), "part").select("rep", "pass", place.alias("place"), "region")


CLASS = ["rep", "copies", "v", "regions", "places"]


def _windows(placed: DataFrame, block: int, reach: int) -> DataFrame:
    """One row per class, pass and block that it lies in or is lent to: also pass, block."""
    rows = placed.select(*CLASS, F.posexplode("places").alias("pass", "_at"))
    own = F.floor(F.col("_at") / block)
    lent = (F.col("_at") % block < reach) & (own > 0)
    return rows.select(*CLASS, "pass", F.explode(F.when(lent, F.array(own, own - 1)).otherwise(F.array(own))).alias("block"))


def _open_regions(placed: DataFrame, at: DataFrame, reach: int) -> DataFrame:
    """One row per class and comparison of two blocks in a region longer than a window: also pass, region, own, i, k."""
    runs = at.groupBy("pass", "region").agg(F.count("*").alias("n"), F.min("place").alias("start")).filter(F.col("n") > reach + 1)
    runs = runs.select("pass", "region", "start", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    own = F.floor((F.col("place") - F.col("start")) / BLOCK_ROWS).cast("int").alias("own")
    inside = at.join(runs, ["pass", "region"]).select("rep", F.struct("pass", "region", "blocks", own).alias("in"))
    inside = inside.groupBy("rep").agg(F.collect_list("in").alias("in"))  # a pass at most once
    rows = placed.join(inside, "rep").select(*CLASS, F.explode("in").alias("in")).select(*CLASS, "in.*")
    with_others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, "own").alias("i"), F.greatest(k, "own").alias("k"))
    )
    return rows.select(*CLASS, "pass", "region", "own", F.explode(with_others).alias("two")).select(
        *CLASS, "pass", "region", "own", "two.i", "two.k"
    )


def new_links(
    x: np.ndarray, copies: np.ndarray, regions: np.ndarray, places: np.ndarray, of_pass: int, reach: int, cosine: float,
    here: np.ndarray, there: np.ndarray, nearest: int, farthest: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Links per row that no earlier pass has counted, and the smallest row each is joined with.

    A row of ``here`` meets the rows of ``there`` that follow it by ``nearest`` to ``farthest`` places. Both are in the
    order of the pass.
    """
    links, label = np.zeros(len(x)), np.arange(len(x))
    weight, place = copies.astype(float), places[:, of_pass]
    for low in range(0, len(here), 256):
        part = here[low : low + 256]
        start = np.searchsorted(place[there], place[part[0]] + nearest)
        others = there[start : np.searchsorted(place[there], place[part[-1]] + farthest, "right")]
        if not len(others):
            continue
        near = x[part] @ x[others].T >= cosine
        apart = place[others][None] - place[part][:, None]
        near &= (apart >= nearest) & (apart <= farthest)
        if np.count_nonzero(near) > near.size // 16:
            for p in range(of_pass):
                near &= regions[part, p][:, None] != regions[others, p][None]
                near &= np.abs(places[part, p][:, None] - places[others, p][None]) > reach
            new = near.astype(float)
            links[part] += new @ weight[others]
            links[others] += weight[part] @ new
            i, j = np.nonzero(near & (label[part][:, None] != label[others][None]))
            i, j = part[i], others[j]
        else:
            i, j = np.nonzero(near)
            i, j = part[i], others[j]
            met = (regions[i, :of_pass] == regions[j, :of_pass]) | (np.abs(places[i, :of_pass] - places[j, :of_pass]) <= reach)
            i, j = i[~met.any(1)], j[~met.any(1)]
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
        if len(i):
            label = joined(len(x), np.append(i, np.arange(len(x))), np.append(j, label))
    return links.astype(np.int64), label


def links_found(
    classes: DataFrame, cosine: float = 0.95, passes: int = PASSES, window: int = WINDOW, seed: int = 3
) -> DataFrame:
    """Links between the classes (rep, copies, v): step (window or region), rep, root, links.

    ``links`` counts the vectors that the class is linked with by one task, ``root`` is a class of the same component.
    """
    width, count = classes.agg(F.max(F.size("v")), F.count("*")).head()
    width, (bits, passes) = width or 0, plan(count, cosine, passes, window)
    block = max(BLOCK_ROWS, window)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = sign_codes(unit_rows([v.as_py() for v in batch.column(1)], width), passes, seed)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes.tolist(), pa.list_(pa.int64()))], names=["rep", "codes"])

    at = saved(_places(classes.select("rep", "v").mapInArrow(code, "rep long, codes array<long>"), count, bits), "vector-places")
    by_pass = F.sort_array(F.collect_list(F.struct("pass", "place", "region")))
    all_at = at.groupBy("rep").agg(by_pass.alias("_p")).select("rep", F.col("_p.region").alias("regions"), F.col("_p.place").alias("places"))
    placed = saved(classes.select("rep", "copies", "v").join(all_at, "rep").select(*CLASS), "vector-codes")

    def compare(frame: pd.DataFrame, of_pass: int, here, there, nearest: int, farthest: float, step: str) -> pd.DataFrame:
        regions, places = np.stack(list(frame["regions"])), np.stack(list(frame["places"]))
        met_before = (regions[:, :of_pass] == regions[0, :of_pass]).all(0).any()
        if met_before or not len(here) or not len(there):
            return pd.DataFrame({"step": pd.Series([], dtype="str"), **{n: pd.Series([], dtype="int64") for n in ("rep", "root", "links")}})
        x, ids, copies = unit_rows(list(frame["v"]), width), frame["rep"].to_numpy(), frame["copies"].to_numpy()
        links, label = new_links(x, copies, regions, places, of_pass, window, cosine, here, there, nearest, farthest)
        hit = np.flatnonzero(links)
        return pd.DataFrame({"step": step, "rep": ids[hit], "root": ids[label[hit]], "links": links[hit]})

    def in_order(frame: pd.DataFrame) -> tuple[pd.DataFrame, int, np.ndarray]:
        of_pass = int(frame["pass"].iloc[0])
        place = np.array([p[of_pass] for p in frame["places"]])
        order = np.argsort(place)
        return frame.iloc[order], of_pass, place[order]

    def in_windows(frame: pd.DataFrame) -> pd.DataFrame:
        frame, of_pass, place = in_order(frame)
        own = np.flatnonzero(place // block == frame["block"].iloc[0])
        return compare(frame, of_pass, own, np.arange(len(frame)), 1, window, "window")

    def in_region(frame: pd.DataFrame) -> pd.DataFrame:
        frame, of_pass, _ = in_order(frame)
        own = frame["own"].to_numpy()
        here, there = np.flatnonzero(own == frame["i"].iloc[0]), np.flatnonzero(own == frame["k"].iloc[0])
        return compare(frame, of_pass, here, there, window + 1, math.inf, "region")

    result = "step string, rep long, root long, links long"
    windows = _windows(placed, block, window).groupBy("pass", "block").applyInPandas(in_windows, result)
    rest = _open_regions(placed, at, window).groupBy("pass", "region", "i", "k").applyInPandas(in_region, result)
    return saved(windows.unionByName(rest), "vector-links")


def near_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", cosine: float = 0.95,
    passes: int = PASSES, window: int = WINDOW, seed: int = 3,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows, classes = _classes(vectors, id_column, vector)
    # A number of its own names a class, as ids can repeat with different vectors; it is fixed by being saved.
    classes = saved(classes.withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    found = links_found(classes, cosine, passes, window, seed)
    linked = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("links").alias("others"))
    # A component is named by its smallest id.
    named = (
        classes.select("rep", "first_id", "copies", F.col("v").alias("_v"))
        .join(counts, "rep", "left")
        .join(linked, F.col("rep") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = named.join(smallest, "component").select(
        "_v", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"
    )
    out = rows.join(known, F.col("v") == F.col("_v"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
