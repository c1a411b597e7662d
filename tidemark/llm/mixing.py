"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame operations only.

Targets: sources in code-point order (null last) weigh ``weights``, repeating, and share the corpus size; a target stops
at ``max_copies`` times its source's size and the excess is shared again by weight, which ends where every open source
has the same ratio of target to weight.

Copies: a document of a source with target / size = f is taken floor(f) times, and once more with probability f's
fraction. Those fractions are settled in pairs: of two open documents one gains and the other loses words, in random
direction with expectations kept, until one of them is taken wholly or not at all; the other stays open and meets the
next. The words of the pair are kept at every step, so a source's sum moves only when its last open document is
drawn. Pairs are settled inside blocks of about ``block_rows`` documents, then the one document that each block left
open goes into the blocks of the next level: a reduction tree of log(documents) / log(block_rows) levels over tables
that shrink by that factor. A hot source is many blocks. Random numbers are hashes of the rows, so reruns agree.

Defined cases: size is the number of words; null and empty texts have size 0 and take 0; a source of size 0 has target 0;
rows that repeat are told apart by number and are rounded each on its own; other columns are ignored; an empty table gives
no rows. The source of a null is a source of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from tidemark.llm.storage import saved, text_column

WORD = r"[^\x20\x09-\x0D]+"
_UNIT = float(1 << 53)


def _draw(*keys) -> Column:
    """A number in [0, 1) that depends on the keys only."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11).cast("double") / _UNIT


def sized(documents: DataFrame, source: str, text: str) -> DataFrame:
    """(source, doc_id, text_key, size, copies of the row) with the words counted."""
    whole = text_column(documents, text)
    rows = documents.select(
        documents[source].cast("string").alias("source"),
        documents["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(whole).alias("text_key"),
        F.regexp_count(whole, F.lit(WORD)).cast("long").alias("size"),
    )
    return rows.groupBy("source", "doc_id", "text_key", "size").agg(F.count("*").alias("rows"))


def source_ranks(sizes: DataFrame) -> DataFrame:
    """``rank`` (from 0) of each source by code point, null last, without ordering all of them in one task."""
    parts = sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    parts = saved(parts, "mix-sources")
    before = Win.orderBy("part").rowsBetween(Win.unboundedPreceding, -1)
    starts = parts.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    inside = Win.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return parts.join(starts, "part").withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)


def targets(sizes: DataFrame, weights: tuple[int, ...], max_copies: int) -> DataFrame:
    """(source, source_size, target). Each round closes the sources above their limit and raises the level of the others."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = saved(
        source_ranks(sizes).select(
            "source", "source_size", weight.cast("double").alias("weight"), (F.col("source_size") * max_copies).alias("limit")
        ),
        "mix-weights",
    )
    first = table.agg(F.sum("source_size"), F.sum("weight")).head()
    total, level = first[0] or 0, 0.0
    if first[1]:
        level = total / first[1]
    while total:
        full = F.col("weight") * level >= F.col("limit")
        closed, open_ = table.agg(
            F.sum(F.when(full, F.col("limit"))), F.sum(F.when(~full, F.col("weight")))
        ).head()
        if not open_ or (total - (closed or 0)) / open_ <= level:
            break
        level = (total - (closed or 0)) / open_
    target = F.least(F.col("limit").cast("double"), F.col("weight") * F.lit(level))
    return table.select("source", "source_size", target.alias("target"))


def _settle(open_rows: Column, seed: Column) -> Column:
    """One block: (settled rows, the row left open). A row is (doc_id, text_key, size, nr, key, base, share)."""
    struct = "doc_id", "text_key", "size", "nr", "key", "base"

    def with_share(row, share):
        return F.struct(*(row[name].alias(name) for name in struct), share.alias("share"))

    def meet(state, row):
        held, size = state["held"], row["size"].cast("double")
        held_size = held["size"].cast("double")
        # Words that move from the held document to the row, and the other way, until one of the two is 0 or 1.
        give = F.least(held["share"] * held_size, (1 - row["share"]) * size)
        take = F.least((1 - held["share"]) * held_size, row["share"] * size)
        given = F.xxhash64(held["key"], row["key"], seed)
        moved = F.when(F.shiftrightunsigned(given, 11).cast("double") / _UNIT * (give + take) < take, give).otherwise(-take)
        gives, takes = moved == give, moved == -take
        held_share = F.when(gives & (held["share"] * held_size <= (1 - row["share"]) * size), 0.0).when(
            takes & ((1 - held["share"]) * held_size <= row["share"] * size), 1.0
        ).otherwise(held["share"] - moved / held_size)
        row_share = F.when(gives & ((1 - row["share"]) * size <= held["share"] * held_size), 1.0).when(
            takes & (row["share"] * size <= (1 - held["share"]) * held_size), 0.0
        ).otherwise(row["share"] + moved / size)
        one, two = with_share(held, held_share), with_share(row, row_share)
        held_done = (held_share == 0) | (held_share == 1)
        return F.when(
            held.isNull(), F.struct(state["settled"].alias("settled"), row.alias("held"))
        ).otherwise(
            F.struct(
                F.concat(state["settled"], F.array(F.when(held_done, one).otherwise(two))).alias("settled"),
                F.when(held_done, two).otherwise(one).alias("held"),
            )
        )

    kind = "struct<doc_id:bigint,text_key:bigint,size:bigint,nr:bigint,key:bigint,base:bigint,share:double>"
    start = F.struct(
        F.array().cast(f"array<{kind}>").alias("settled"), F.lit(None).cast(kind).alias("held")
    )
    return F.aggregate(open_rows, start, meet)


def mix(
    documents: DataFrame,
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = (1, 2, 3),
    max_copies: int = 3,
    block_rows: int = 64,
    seed: int = 7,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken (copies times size).

    ``text_key`` and ``nr`` tell rows of one id apart: the hash of the text, and a number among equal rows.
    """
    rows = saved(sized(documents, source, text), "mix-sizes")
    sizes = rows.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("source_rows")
    )
    goals = saved(targets(sizes, weights, max_copies), "mix-targets")
    many = sizes.select(F.col("source").alias("_s"), "source_rows")
    goals = goals.join(many, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    wanted = goals.withColumnRenamed("source", "_source").withColumn("ratio", F.least(ratio, F.lit(float(max_copies))))
    every = (
        rows.join(wanted, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("nr", F.explode(F.sequence(F.lit(1), F.col("rows"))))
        .withColumn("base", F.floor("ratio"))
        .withColumn("share", F.col("ratio") - F.col("base"))
        .withColumn("key", F.xxhash64("doc_id", "text_key", "nr", F.lit(seed)))
    )
    kept = "source", "source_size", "target", "source_rows"
    row = "doc_id", "text_key", "size", "nr", "key", "base", "share"
    by_key = ("key", *(name for name in row if name != "key"))
    every = every.select(*kept, *row)
    open_ = every.filter("size > 0 and share > 0")
    done = [every.filter("not (size > 0 and share > 0)")]
    most = sizes.agg(F.max("source_rows")).head()[0] or 0
    levels = max(1, math.ceil(math.log(max(most, 2), block_rows)) + 1)
    for level in range(levels):
        # The last level has one block per source; fewer than ``block_rows`` documents are open there on average.
        blocks = F.ceil(F.col("source_rows") / float(block_rows ** (level + 1))) if level < levels - 1 else F.lit(1)
        block = F.pmod(F.xxhash64("key", F.lit(level)), blocks.cast("long"))
        grouped = open_.groupBy(*kept, block.alias("block")).agg(
            F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("order"), *by_key))).alias("rows")
        )
        # Long documents first: what is left open in the end is a short one where there are enough of them.
        ordered = F.transform("rows", lambda r: F.struct(*(r[name].alias(name) for name in row)))
        met = grouped.select(*kept, _settle(ordered, F.lit(level)).alias("met"))
        held = F.transform(F.array("met.held"), lambda r: F.struct(r.alias("row"), F.lit(True).alias("open")))
        ended = F.transform("met.settled", lambda r: F.struct(r.alias("row"), F.lit(False).alias("open")))
        flat = met.select(*kept, F.explode(F.concat(ended, held)).alias("x"))
        flat = flat.select(*kept, *(F.col(f"x.row.{name}").alias(name) for name in row), "x.open")
        flat = saved(flat, f"mix-level-{level}")
        done.append(flat.filter("not open or share in (0, 1)").drop("open"))
        open_ = flat.filter("open and share not in (0, 1)").drop("open")
    last = _draw("key", F.lit(seed), F.lit("last"))
    done.append(open_.withColumn("share", F.when(last < F.col("share"), 1.0).otherwise(0.0)))
    result = done[0].withColumn("share", F.lit(0.0))
    for part in done[1:]:
        result = result.unionByName(part)
    copies = (F.col("base") + F.col("share")).cast("long")
    copies = F.when(F.col("size") > 0, copies).otherwise(F.lit(0).cast("long"))
    return result.select(
        "doc_id",
        "text_key",
        "nr",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
