"""Token ids in raw binary shards, with keyed access through a minimal perfect hash index.

Writing: documents are dealt by ranges of (doc_id, row) and written in ascending doc_id order, one shard file per range:
raw little-endian ids and nothing else, of 2 bytes where the vocabulary allows and of 4 elsewhere. Index: keys are dealt to
buckets of bounded size; each bucket's file holds a minimal perfect hash of its keys (levels of bits, an entry stays at
the first level where no other key has its place, its rank among the set bits is its slot) and per slot a fingerprint,
the shard, the place and the number of ids. Bits lie in blocks that begin with the rank so far, so reading one key takes
the header of its bucket, a block per level tried (1.8 on average), one slot and one stretch of one shard, whatever the
size of the bucket or of the corpus. Where a bucket is asked for many keys at once it is read whole.

Lost tasks write again under another name; only files named by committed rows are read.

Defined cases: a null text is empty; every document ends with ``end_id``, so none has no ids; a null doc_id comes first
and is a key of its own; rows that repeat a doc_id are told apart by ``copy`` (0, 1, ... in the order written); other
columns are ignored; an empty table gives empty results. A doc_id with any share of the rows is spread over shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from tidemark.llm.storage import attempt_file, create, open_random, saved, text_column
from tidemark.llm.tokens import default_path, encoder
from tidemark.session import new_folder

TOKENIZER = "byte_bpe_50k.json"
#: Keys of an index bucket, on average.
BUCKET_KEYS = 50_000
#: A bucket is read whole where more than one of so many of its keys is asked for.
SINGLE_SHARE = 64
_LEVELS = 64
_HEADER = 8 * (1 + _LEVELS)
#: Bits of a block, and its bytes with the rank before it.
_BLOCK_BITS = 512
_BLOCK = 8 + _BLOCK_BITS // 8
_EXTRA = np.uint64(0x9E3779B97F4A7C15)


# Shards


def write_shards(
    documents: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = 2,
    width: int = 2,
) -> DataFrame:
    """Write the shards; one row per document: doc_id, copy, shard, file, offset and n_tokens (both in ids)."""
    path = tokenizer or default_path(TOKENIZER)
    folder = new_folder(documents.sparkSession, "token-shards")
    end = end_id.to_bytes(width, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encode, out, at, last, place = encoder(path, width).encode, None, 0, object(), 0
        file = attempt_file(folder, f"shard-{shard:06d}", ".ids")
        for batch in batches:
            if out is None and batch.num_rows:
                out = create(file)
            docs, places, sizes = batch.column(0).to_pylist(), [], []
            for doc, raw in zip(docs, encode(value.as_py() for value in batch.column(1)), strict=True):
                raw += end
                out.write(raw)
                place = place + 1 if doc == last else 0
                last = doc
                places.append(place)
                sizes.append(len(raw))
            counts = np.array(sizes, np.int64) // width
            offsets = at + np.cumsum(counts) - counts
            at += int(counts.sum())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(docs, pa.int64()),
                    "place": pa.array(places, pa.int64()),
                    "shard": pa.array([shard] * len(docs), pa.int64()),
                    "file": pa.array([file] * len(docs), pa.string()),
                    "offset": pa.array(offsets, pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()),
                }
            )
        if out is not None:
            out.close()

    rows = documents.select(
        documents[id_column].cast("long").alias("doc_id"),
        text_column(documents, text).alias("text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    ordered = rows.repartitionByRange("doc_id", "_row").sortWithinPartitions("doc_id", "_row").select("doc_id", "text")
    written = saved(
        ordered.mapInArrow(write, "doc_id long, place long, shard long, file string, offset long, n_tokens long"),
        "token-manifest",
    )
    # An id on the border of shards goes on counting its copies; one row per id and shard is read for that.
    border = Win.partitionBy("doc_id").orderBy("shard").rowsBetween(Win.unboundedPreceding, -1)
    earlier = (
        written.groupBy("doc_id", "shard")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(border))
        .filter("_before > 0")
        .select(F.col("doc_id").alias("_id"), F.col("shard").alias("_shard"), "_before")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("shard") == F.col("_shard"))
    copy = (F.col("place") + F.coalesce("_before", F.lit(0))).alias("copy")
    return written.join(earlier, same, "left").select("doc_id", copy, "shard", "file", "offset", "n_tokens")


def shard_starts(manifest: DataFrame) -> DataFrame:
    """Per shard its file and the number of ids before it (one row per shard is ordered)."""
    before = Win.orderBy("shard").rowsBetween(Win.unboundedPreceding, -1)
    return (
        manifest.groupBy("shard")
        .agg(F.sum("n_tokens").alias("_n"), F.min("file").alias("file"))
        .select("shard", "file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("shard_start"))
    )


# Minimal perfect hash


def _mixed(values: np.ndarray, level: int) -> np.ndarray:
    """Other bits of the hash for every level."""
    with np.errstate(over="ignore"):
        x = values + _EXTRA * np.uint64(2 * level + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hashes(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for the place and a 32-bit fingerprint from other bits."""
    import xxhash

    raw = b"".join(xxhash.xxh3_128_digest(key.encode()) for key in keys)
    both = np.frombuffer(raw, ">u8").reshape(-1, 2).astype(np.uint64)
    return both[:, 0], (both[:, 1] & np.uint64(0xFFFFFFFF)).astype("<u4")


class PerfectHash:
    """Slots 0 .. n-1 for n different hashes; ``levels`` are arrays of bits."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self._ranks = []
        before = 0
        for bits in levels:
            ranks = np.cumsum(bits, dtype=np.int64)
            self._ranks.append(before + ranks - bits)
            before += int(ranks[-1]) if len(ranks) else 0
        self.size = before

    @classmethod
    def build(cls, hashes: np.ndarray, load: float = 1.7) -> PerfectHash:
        levels, left = [], hashes
        while len(left):
            if len(levels) == _LEVELS:
                raise ValueError("two keys have the same hash")
            size = max(64, int(len(left) * load))
            places = (_mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(places, minlength=size) == 1
            levels.append(alone.astype(np.uint8))
            left = left[~alone[places]]
        return cls(levels)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """-1 where no level has a bit for the hash."""
        found, open_ = np.full(len(hashes), -1, np.int64), np.arange(len(hashes))
        for level, bits in enumerate(self.levels):
            places = (_mixed(hashes[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[places] == 1
            found[open_[hit]] = self._ranks[level][places[hit]]
            open_ = open_[~hit]
        return found

    def write(self, out) -> None:
        """A header of fixed size (the number of levels and their bits), then the blocks of every level."""
        header = np.zeros(1 + _LEVELS, "<i8")
        header[: 1 + len(self.levels)] = [len(self.levels), *map(len, self.levels)]
        out.write(header.tobytes())
        for bits, ranks in zip(self.levels, self._ranks, strict=True):
            blocks = np.zeros((-(-len(bits) // _BLOCK_BITS), _BLOCK), np.uint8)
            packed = np.packbits(np.pad(bits, (0, -len(bits) % _BLOCK_BITS)))
            blocks[:, :8] = ranks[::_BLOCK_BITS].astype("<i8").view(np.uint8).reshape(-1, 8)
            blocks[:, 8:] = packed.reshape(len(blocks), -1)
            out.write(blocks.tobytes())

    @classmethod
    def read(cls, data) -> PerfectHash:
        levels = []
        for size in _level_sizes(data.read(_HEADER)):
            blocks = np.frombuffer(data.read(-(-size // _BLOCK_BITS) * _BLOCK), np.uint8).reshape(-1, _BLOCK)
            levels.append(np.unpackbits(blocks[:, 8:].reshape(-1))[:size])
        return cls(levels)


def _level_sizes(header: bytes) -> list[int]:
    count, *sizes = np.frombuffer(header, "<i8").tolist()
    return sizes[:count]


_SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("n_tokens", "<u8")])


def read_slot(data, hash_: int, mark: int) -> np.void | None:
    """The slot of one key from an open bucket file, or None; reads a block per level tried and the slot."""
    sizes = _level_sizes(data.read_at(_HEADER, 0))
    blocks = [-(-size // _BLOCK_BITS) for size in sizes]
    slots_at = _HEADER + sum(blocks) * _BLOCK
    start, one = _HEADER, np.array([hash_], np.uint64)
    for level, size in enumerate(sizes):
        block, bit = divmod(int(_mixed(one, level)[0] % np.uint64(size)), _BLOCK_BITS)
        raw = data.read_at(_BLOCK, start + block * _BLOCK)
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, offset=8))
        if bits[bit]:
            rank = int(np.frombuffer(raw, "<i8", 1)[0]) + int(bits[:bit].sum())
            slot = np.frombuffer(data.read_at(_SLOT.itemsize, slots_at + rank * _SLOT.itemsize), _SLOT)[0]
            return slot if slot["fingerprint"] == mark else None
        start += blocks[level] * _BLOCK
    return None


def _names(frame: pd.DataFrame) -> list[str]:
    """The text that stands for a key: its id (nothing for null) and its copy."""
    ids = ["" if pd.isna(value) else str(int(value)) for value in frame["doc_id"]]
    return [f"{i}/{c}" for i, c in zip(ids, frame["copy"].astype("int64"), strict=True)]


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(buckets)).cast("int"))


def build_index(manifest: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """Write the index; one row per bucket: bucket, buckets, index_file."""
    spark = manifest.sparkSession
    folder = new_folder(spark, "token-index")
    buckets = max(1, -(-manifest.count() // bucket_keys))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        bucket = int(frame["bucket"].iloc[0])
        hashes, marks = key_hashes(_names(frame))
        table = PerfectHash.build(hashes)
        slots = np.zeros(len(frame), _SLOT)
        at = table.slots(hashes)
        slots["fingerprint"][at] = marks
        for name in ("shard", "offset", "n_tokens"):
            slots[name][at] = frame[name].to_numpy()
        file = attempt_file(folder, f"bucket-{bucket:06d}", ".mph")
        with create(file) as out:
            table.write(out)
            out.write(slots.tobytes())
        return pd.DataFrame({"bucket": [bucket], "buckets": [buckets], "index_file": [file]})

    keys = _bucketed(manifest.select("doc_id", "copy", "shard", "offset", "n_tokens"), buckets)
    return saved(keys.groupBy("bucket").applyInPandas(build, "bucket int, buckets int, index_file string"), "token-index-files")


def look_up(keys: DataFrame, index: DataFrame) -> DataFrame:
    """(doc_id, copy) -> shard, offset, n_tokens; unknown keys are left out."""
    first = index.select("buckets").head()
    buckets = first[0] if first else 1

    def find(frame: pd.DataFrame) -> pd.DataFrame:
        hashes, marks = key_hashes(_names(frame))
        with open_random(frame["index_file"].iloc[0]) as data:
            keys_there = (data.size() - _HEADER) // _SLOT.itemsize
            if len(frame) * SINGLE_SHARE <= keys_there:
                slots = [read_slot(data, h, m) for h, m in zip(hashes.tolist(), marks.tolist(), strict=True)]
                known = np.array([slot is not None for slot in slots], bool)
                hit = np.array([slot for slot in slots if slot is not None], _SLOT)
            else:
                table = PerfectHash.read(data)
                slots = np.frombuffer(data.read(table.size * _SLOT.itemsize), _SLOT)
                at = table.slots(hashes)
                known = at >= 0
                known[known] = slots["fingerprint"][at[known]] == marks[known]
                hit = slots[at[known]]
        out = frame.loc[known, ["doc_id", "copy"]].copy()
        for name in ("shard", "offset", "n_tokens"):
            out[name] = hit[name].astype("int64")
        return out

    placed = _bucketed(keys.select("doc_id", "copy"), buckets).join(index.select("bucket", "index_file"), "bucket")
    return placed.groupBy("bucket").applyInPandas(find, "doc_id long, copy long, shard long, offset long, n_tokens long")


def read_ids(places: DataFrame, shards: DataFrame, width: int = 2) -> DataFrame:
    """Ids of the places found, read shard by shard in order: doc_id, copy, start, n_tokens, ids (32 bits each)."""
    kind = {2: "<u2", 4: "<u4"}[width]
    fields = pa.schema(
        [("doc_id", pa.int64()), ("copy", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, data = None, None
        for batch in batches:
            rows, size = [], 0
            for row in batch.to_pylist():
                if row["file"] != name:
                    name, data = row["file"], open_random(row["file"])
                raw = data.read_at(row["n_tokens"] * width, row["offset"] * width)
                ids = np.frombuffer(raw, kind).astype("<u4").tobytes()
                rows.append({**{f: row[f] for f in ("doc_id", "copy", "start", "n_tokens")}, "ids": ids})
                size += len(ids)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=fields)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=fields)

    found = places.join(shards, "shard").select(
        "doc_id", "copy", "shard", "file", "offset", "n_tokens", (F.col("shard_start") + F.col("offset")).alias("start")
    )
    dealt = found.repartition("shard").sortWithinPartitions("shard", "offset")
    return dealt.mapInArrow(fetch, "doc_id long, copy long, start long, n_tokens long, ids binary")
