"""Sequence packing by power-of-two decomposition.

A document's ids are cut into full sequences of ``sequence_length`` and then into the binary digits of what is
left, longest first. Every piece has a power of two of ids and is a sequence of its own in the bucket of its length,
so no sequence crosses documents and none is padded. One pass over the documents, no shuffle: a piece depends on its
document only, and a task holds one Arrow batch.

Defined cases: a null text is an empty text; every document ends with ``end_id``, so an empty one is one piece of one
id; each row is a document of its own, also where rows or ids repeat or the id is null; other columns are ignored;
an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import text_column
from tidemark.llm.tokens import default_path, encoder

TOKENIZER = "word_bpe_49k.json"
_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("ids", pa.binary()),
    ]
)


def piece_lengths(tokens: int, sequence_length: int) -> list[int]:
    """Full sequences, then the binary digits of the rest from the largest."""
    full, rest = divmod(tokens, sequence_length)
    digits = [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]
    return [sequence_length] * full + digits


def pieces(
    documents: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    sequence_length: int = 2048,
    end_id: int = 1,
) -> DataFrame:
    """Pieces with their ids (little-endian unsigned 32-bit): doc_id, start, length, doc_tokens, ids, sequence_id, offset.

    ``length`` is the bucket; ``offset`` in the sequence is always 0. ``sequence_id`` is unique.
    """
    if sequence_length < 1 or sequence_length & (sequence_length - 1):
        raise ValueError("sequence_length must be a power of two")
    path = tokenizer or default_path(TOKENIZER)
    end = np.asarray([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            rows, size = [], 0
            texts = (value.as_py() for value in batch.column(1))
            for doc, raw in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                raw += end
                tokens, start = len(raw) // 4, 0
                for length in piece_lengths(tokens, sequence_length):
                    rows.append((doc, start, length, tokens, raw[4 * start : 4 * (start + length)]))
                    start += length
                size += len(raw)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES
                    )
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES
                )

    source = documents.select(documents[id_column].cast("long").alias("doc_id"), text_column(documents, text).alias("text"))
    found = source.mapInArrow(cut, "doc_id long, start long, length long, doc_tokens long, ids binary")
    return found.select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )


def write_buckets(packed: DataFrame, folder: str) -> None:
    """The sequences as Parquet, one folder per length."""
    packed.write.partitionBy("length").parquet(folder)


def digest(packed: DataFrame) -> DataFrame:
    """Pieces with the crc32 of their ids in place of the ids."""
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
