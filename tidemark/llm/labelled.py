"""Labelled documents from which the classifiers learn: all of them, or bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import saved, text_column


def remainder(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(column.cast("long").cast("string")) % modulus


def _known(labels: DataFrame, label: str, learn: Column) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label) of all rows labelled 0 or 1 that ``learn`` allows, and how many there are of each class."""
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).filter(learn).distinct()
    return known, {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}


def _with_texts(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, label, fold, text) of the chosen ids."""
    texts = documents.select(documents["doc_id"].cast("long").alias("doc_id"), text_column(documents, "text").alias("text"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)).cast("int").alias("fold")
    found = texts.join(chosen, "doc_id").select("doc_id", "label", fold, "text")
    return found.groupBy("doc_id", "label", "fold").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def every(documents: DataFrame, labels: DataFrame, label: str, learn: Column) -> tuple[DataFrame, dict[int, int]]:
    """All labelled rows with their whole texts, as ``sample`` gives some of them. Both tables meet by merge: the ids grow
    with the labels."""
    known, counts = _known(labels, label, learn)
    return _with_texts(documents, known.hint("merge")), counts


def sample(
    documents: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int
) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` labelled rows of each class, by hash of the id, with their whole texts, and all rows by class.
    Of rows that repeat an id the text with the smallest hash stands for all.

    ``learn`` is a condition on ``doc_id``. The table is (doc_id, label, fold, text); fold is 0 to 3 by hash. Only ids are
    ordered and broadcast (at most twice ``per_class``), so the texts never meet outside the sample.
    """
    known, counts = _known(labels, label, learn)
    order = F.xxhash64("doc_id").alias("order")
    chosen = None
    for value in (0, 1):
        part = known.filter(F.col("label") == value).select("doc_id", "label", order)
        part = part.orderBy("order", "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    return saved(_with_texts(documents, F.broadcast(chosen)), "labelled-sample"), counts
