"""The corpus pipeline: quality, near-duplicates, repeated passages, source mix, packing.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. Every stage works on all rows
of the one before; its result is written and read again. All but the last return the columns of documents.

Defined cases, beyond those of the operators: rows that repeat an id are documents of their own, but equal rows (same id,
same text) are near-duplicates and one of them stays; documents without words stay where near-duplicates go; a null
text stays null; a character of which a removed passage holds a part goes with it; other columns are handed on; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from tidemark.llm import mixing, packing, passage_dedup, quality, text_dedup
from tidemark.llm.labelled import remainder
from tidemark.llm.storage import saved, text_column

LEAST_QUALITY = 0.3
#: Similarity, in percent, from which documents are near-duplicates here.
NEAR_PERCENT = 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least ``LEAST_QUALITY``."""
    learn = F.coalesce(remainder(F.col("doc_id"), 5) != 0, F.lit(False))
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), learn)
    scored = quality.score(docs.withColumnsRenamed({"score": "__score"}), model)
    return scored.filter(F.col("score") >= LEAST_QUALITY).drop("score").withColumnsRenamed({"__score": "score"})


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    found = text_dedup.near_duplicates(docs, percent=NEAR_PERCENT)
    alone = found.filter("node is null or doc_id is null").select("doc_id", "text_key", F.lit(False).alias("several")).distinct()
    stay = (
        found.filter("node is not null and doc_id is not null and kept")
        .groupBy("group", "doc_id", "text_key")
        .agg(F.count("*").alias("n"))
        .groupBy("group")
        .agg(F.min(F.struct("doc_id", "text_key", "n")).alias("one"))
        .select("one.doc_id", "one.text_key", (F.col("one.n") > 1).alias("several"))
    )
    stay = saved(stay.unionByName(alone), "near-duplicates-kept")
    keys = stay.select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__t"), F.col("several").alias("__several"))
    same = F.col("doc_id").eqNullSafe(F.col("__d")) & (F.xxhash64(text_column(docs, "text")) == F.col("__t"))
    kept = docs.join(keys.hint("shuffle_hash"), same)
    single = kept.filter("not __several").select(*docs.columns)
    if stay.filter("several").isEmpty():
        return single
    return single.unionByName(kept.filter("__several").dropDuplicates(["__d", "__t"]).select(*docs.columns))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that documents of smaller ids have."""
    # Columns that are called like those of the operator stand aside meanwhile.
    aside = {c: f"__aside_{i}" for i, c in enumerate(docs.columns) if c in ("n_bytes", "n_removed", "n_spans", "kept_text")}
    left = passage_dedup.remove_passages(docs.withColumnsRenamed(aside), as_text=True)
    changed = F.col("n_removed") > 0
    out = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    changed_rows = left.withColumns(out)
    return changed_rows.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    taken = saved(
        mixing.mix(docs).filter("copies > 0").select(
            F.col("doc_id").alias("__d"), F.col("text_key").alias("__t"), F.col("source").alias("__s"),
            F.col("nr").alias("__nr"), F.col("copies").alias("__copies"),
        ),
        "mix-taken",
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("__d"))
        & F.col("source").eqNullSafe(F.col("__s"))
        & (F.xxhash64(text_column(docs, "text")) == F.col("__t"))
    )
    rows = docs
    if not taken.filter("__nr > 1").isEmpty():
        # Equal rows are numbered here as they were there; which is which does not matter.
        alike = Win.partitionBy("doc_id", "source", F.xxhash64(text_column(docs, "text"))).orderBy(F.lit(1))
        rows = docs.withColumn("__row", F.row_number().over(alike))
        same = same & (F.col("__row") == F.col("__nr"))
    found = rows.join(taken.hint("shuffle_hash"), same)
    return found.withColumn("__n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of powers of two."""
    return packing.digest(packing.pieces(docs))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("passages", cut_passages),
    ("mix", mix_sources),
    ("packing", pack),
]
#: Trained scores, random rounding and token ids have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query."""
    return run(spark, sf_dir)
