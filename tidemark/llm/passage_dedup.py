"""Removal of repeated passages by run-length indexes over repetitive stretches.

A byte goes where it lies in a ``length``-byte string that also starts in a document with a smaller id. The work is cut into
independent pieces by anchors: of the ``GRAM``-byte grams of every ``length``-byte window the one with the smallest hash, so
equal windows have equal anchors at the same place. An anchor with the stretch of the windows it serves is a context.

1. Documents that are read together settle what they share among themselves. The other anchors (one per eighteen bytes or so)
   are dealt by their gram and read in sorted order. Where the same context occurs
   in a document with a smaller id, all its windows go. A gram with one context is done; of the others the first document
   of each context is kept for the next step.
2. Those contexts meet in buckets by gram; one that shares no gram beside its anchor with another is let go. Each bucket gets a run-compressed Burrows-Wheeler transform with sampled run
   ends, and a table of the row intervals that share ``length`` bytes with the smallest document of each. All contexts of
   the bucket are streamed through it, right to left, by steps on the runs; a window whose interval has a smaller document
   is a long match and is marked.
3. Grams with more than ``CROWDED`` contexts would not fit a bucket: their windows are compared one by one, by a grouping
   with partial results.
4. Marked ranges go back to their documents, are united and cut out.

Reading sorted runs needs the memory of one Arrow batch. A context that very many documents share is settled in groups of
documents before the shuffle, so of its gram only about one document per group meets in one task.

Defined cases: a null text is empty; texts shorter than ``length`` stay as they are; rows that repeat an id do not remove from
each other, whatever their texts; rows without an id remove nothing and stay whole; other columns are ignored; an empty
table gives no rows. Texts of any length are read in segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import saved, text_column

LENGTH = 50
GRAM = 16
#: Contexts of a bucket, on average, and of a gram at most.
BUCKET_CONTEXTS = 4_000
CROWDED = 20_000
_SEGMENT = 1 << 19
_LOW = np.uint64((1 << 20) - 1)
_FIXED = np.random.default_rng(29)
_ODD = _FIXED.integers(1 << 62, size=16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bits of gram and context hashes that are kept; contexts are compared within a gram only.
_KEPT = np.uint64((1 << 48) - 1)
#: In place of a context hash: the row is settled already.
_SETTLED = -1


# Anchors


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all ``GRAM``-byte grams (16), by doubling."""
    h = data.astype(np.uint64) + np.uint64(1)
    for level, step in enumerate((1, 2, 4, 8)):
        h = h[:-step] * _ODD[level] + h[step:]
    return _mixed(h)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours, by doubling."""
    size, have = len(x) - width + 1, 1
    while have * 2 <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    return np.minimum(x[:size], x[width - have : width - have + size])


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of texts that lie one after another in ``data``: place, first window, last window, gram hash, context hash.

    Windows do not cross ``ends``.
    """
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    h = gram_hashes(data)
    keyed = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    place = (_sliding_min(keyed, LENGTH - GRAM + 1) & _LOW).astype(np.int64)
    valid = np.ones(len(data), bool)
    for end in ends.tolist():
        valid[max(0, end - LENGTH + 1) : end] = False
    windows = np.flatnonzero(valid[: len(place)])
    if not len(windows):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    place = place[windows]
    new = np.flatnonzero(np.diff(place, prepend=-1))
    first, last, place = windows[new], windows[np.append(new[1:], len(windows)) - 1], place[new]
    size = last - first + LENGTH
    context = h[last + LENGTH - GRAM] * _ODD[4] + size.astype(np.uint64) * _ODD[5] + (place - first).astype(np.uint64) * _ODD[6]
    for block in range(0, 2 * LENGTH // GRAM):
        inside = (block + 1) * GRAM <= size
        at = np.where(inside, first + block * GRAM, 0)
        context += np.where(inside, h[at], np.uint64(0)) * _ODD[7 + block]
    return place, first, last, h[place] & _KEPT, _mixed(context) & _KEPT


def _info(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """First window and number of windows in one integer."""
    return (first << np.int64(6)) | (last - first)


def _unpack(info: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first window, last window)."""
    first = info >> np.int64(6)
    return first, first + (info & np.int64(63))


def _groups(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, start in the text, bytes) of about a segment together; long texts in overlapping segments."""
    group, size = [], 0
    for row, raw in enumerate(texts):
        for start in range(0, max(1, len(raw) - LENGTH + 1), _SEGMENT):
            part = raw[start : start + _SEGMENT + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            if size + len(part) > 2 * _SEGMENT - 1:
                yield group
                group, size = [], 0
            group.append((row, start, part))
            size += len(part)
            if size > _SEGMENT // 2:
                yield group
                group, size = [], 0
    if group:
        yield group


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def settled_here(gram: np.ndarray, context: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Rows whose context a smaller document of the same few has too."""
    key = _mixed(gram * _ODD[14] + context)
    order = np.argsort(key, kind="stable")
    new = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    least = np.repeat(np.minimum.reduceat(doc[order], new), np.diff(np.append(new, len(order))))
    out = np.empty(len(order), bool)
    out[order] = doc[order] > least
    return out


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, variant, text -> gram, context, doc_id, variant, info.

    What a group of documents settles among itself need not meet the other rows of its gram: it is dealt by place, so that
    very frequent contexts do not come together.
    """
    for batch in batches:
        docs, variants = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for group in _groups([_utf8(value.as_py()) for value in batch.column(2)]):
            data = np.frombuffer(b"".join(part for _, _, part in group), np.uint8)
            ends = np.cumsum([len(part) for _, _, part in group])
            place, first, last, gram, context = anchors(data, ends)
            if not len(place):
                continue
            member = np.searchsorted(ends, first, "right")
            rows = np.array([row for row, _, _ in group])[member]
            shift = (np.array([start for _, start, _ in group]) - np.concatenate(([0], ends[:-1])))[member]
            info = _info(first + shift, last + shift)
            settled = settled_here(gram, context, docs[rows])
            of_row = (info ^ docs[rows] ^ variants[rows]).astype(np.uint64)
            dealt = np.where(settled, _mixed(of_row) & np.uint64(0xFFF), gram)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(dealt.astype(np.int64)),
                    pa.array(np.where(settled, _SETTLED, context.astype(np.int64))),
                    pa.array(docs[rows]),
                    pa.array(variants[rows]),
                    pa.array(info),
                ],
                names=["gram", "context", "doc_id", "variant", "info"],
            )


# Sorted runs


_RUN_FIELDS = ["gram", "doc_id", "variant", "info", "open"]


class _Runs:
    """Rows sorted by (gram, context, doc_id, variant, info), a batch at a time.

    A row whose context has a smaller document is settled. The rows of a context's first document are open if the gram
    has another context; until that is known those of the last gram are held.
    """

    def __init__(self):
        self.gram = self.context = self.first = None
        self.several = False
        self.held: list[tuple[int, ...]] = []

    def feed(self, gram, context, doc, *others) -> tuple[np.ndarray, ...]:
        """(gram, doc, others, open) of the rows that are now known to matter."""
        new_gram = np.diff(gram, prepend=gram[0]) != 0
        new_context = new_gram | (np.diff(context, prepend=context[0]) != 0)
        same_gram = self.gram is not None and gram[0] == self.gram
        new_gram[0] = not same_gram
        new_context[0] = not (same_gram and context[0] == self.context)
        starts = np.flatnonzero(new_context)
        first = np.zeros(len(gram), np.int64)
        of_start = np.cumsum(new_context) - 1
        first[of_start >= 0] = doc[starts][of_start[of_start >= 0]]
        if not new_context[0]:
            first[of_start < 0] = self.first
        settled = doc > first
        # Contexts per gram of this batch; the first may go on from the last one.
        of_gram = np.cumsum(new_gram) - int(new_gram[0])
        count = np.bincount(of_gram, weights=new_context)
        if not new_gram[0]:
            count[0] += 2 if self.several else 1
        several = count > 1
        held = self.held
        flushed = held if held and not new_gram[0] and several[0] else []
        if new_gram[0] or several[0]:
            held = []
        open_ = ~settled & several[of_gram]
        wait = ~settled & ~several[of_gram] & (of_gram == of_gram[-1])
        if of_gram[-1] > 0:
            held = []
        if wait.any():
            held = held + list(zip(*(c[wait].tolist() for c in (gram, doc, *others)), strict=True))
        self.gram, self.context, self.first = gram[-1], context[-1], first[-1]
        self.several, self.held = bool(several[of_gram[-1]]), held
        keep = settled | open_
        out = [c[keep] for c in (gram, doc, *others, open_)]
        if flushed:
            more = [np.array(c, np.int64) for c in zip(*flushed, strict=True)]
            out = [np.concatenate(pair) for pair in zip(out, [*more, np.ones(len(flushed), bool)], strict=True)]
        return tuple(out)


def _read_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs = _Runs()
    for batch in batches:
        gram, context, *rest = (column.to_numpy() for column in batch.columns)
        before = context == _SETTLED
        if before.any():
            settled = [column[before] for column in rest]
            none = np.zeros(len(settled[0]), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (none, *settled, none == 1)], names=_RUN_FIELDS)
            gram, context, *rest = (column[~before] for column in (gram, context, *rest))
        if len(gram):
            gram, *rest, still = runs.feed(gram, context, *rest)
            found = np.where(still, gram, 0), *rest, still
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=_RUN_FIELDS)


# Run-length index


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of several contexts, with sampled run ends.

    ``starts`` and ``follow`` describe the runs: a row in run r goes to ``follow[r] + row - starts[r]`` with the byte before it.
    ``samples`` are the places of the last row of each run. ``intervals`` are the rows where stretches of rows with the same
    first ``length`` bytes begin, ``owners`` the smallest owner of each. Contexts end in separators that sort first, in
    order, so context i starts its walk at row i.
    """

    def __init__(self, contexts: list[bytes], owners: np.ndarray, length: int = LENGTH):
        self.count, self.length = len(contexts), length
        self.sizes = sizes = np.array([len(c) for c in contexts])
        ends = np.cumsum(sizes + 1) - 1
        inside = np.ones(int(ends[-1]) + 1, bool)
        inside[ends] = False
        text = np.zeros(len(inside), np.int64)
        text[inside] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.int64) + 1
        left = np.repeat(ends, sizes + 1) - np.arange(len(text))
        order, same = self._sorted(text, left)
        letter = text[order - 1]
        self.starts = np.flatnonzero(np.diff(letter, prepend=-1) != 0)
        self.samples = order[np.append(self.starts[1:], len(order)) - 1]
        # A run goes to the rows of its letter, behind those of the earlier runs of that letter.
        run_letter, run_size = letter[self.starts], np.diff(np.append(self.starts, len(order)))
        below = np.cumsum(np.bincount(text, minlength=257)) - np.bincount(text, minlength=257)
        by_letter = np.argsort(run_letter, kind="stable")
        sums = np.cumsum(run_size[by_letter]) - run_size[by_letter]
        grouped = run_letter[by_letter]
        self.follow = np.empty(len(self.starts), np.int64)
        self.follow[by_letter] = below[grouped] + sums - sums[np.searchsorted(grouped, grouped, "left")]
        self.intervals = np.flatnonzero(~same)
        self.owners = np.minimum.reduceat(np.repeat(owners, sizes + 1)[order], self.intervals)

    def _sorted(self, text: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the order of their suffixes, and which rows share ``length`` letters with the row before.

        A suffix ends with its context; equal ones stay in the order of their contexts.
        """
        at, have = np.arange(len(text)), min(7, self.length)
        padded = np.concatenate((text, np.zeros(have, np.int64)))
        key = np.zeros(len(text), np.int64)
        for step in range(have):
            key = key * 257 + np.where(step < left, padded[step : step + len(text)], 0)
        while True:
            order = np.argsort(key, kind="stable")
            rank = np.empty(len(text), np.int64)
            rank[order] = np.cumsum(np.diff(key[order], prepend=-1) != 0)
            if have <= self.length <= 2 * have:  # two overlapping stretches
                later = rank[np.minimum(at + self.length - have, len(text) - 1)]
                share = rank, later
            if have > left.max() and 2 * have >= self.length:
                break
            later = np.where(left > have, rank[np.minimum(at + have, len(text) - 1)], 0)
            key = rank * (len(text) + 1) + later
            have *= 2
        same = np.zeros(len(text), bool)
        same[1:] = (share[0][order[1:]] == share[0][order[:-1]]) & (share[1][order[1:]] == share[1][order[:-1]])
        return order, same

    def stream(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Right to left over all contexts at once: (contexts, place in them, smallest owner of the match there).

        Only places with ``length`` bytes after them are reported.
        """
        alive, rows = np.arange(self.count), np.arange(self.count)
        for step in range(1, int(self.sizes.max(initial=0)) + 1):
            going = self.sizes[alive] >= step
            alive, rows = alive[going], rows[going]
            run = np.searchsorted(self.starts, rows, "right") - 1
            rows = self.follow[run] + rows - self.starts[run]
            if step >= self.length:
                yield alive, self.sizes[alive] - step, self.owners[np.searchsorted(self.intervals, rows, "right") - 1]


def may_match(contexts: list[bytes], grams: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Contexts that share the gram beside their anchor, left or right, with a context of another owner.

    A window holds the anchor's gram and at least ``GRAM`` bytes next to it on one side, so no other context can match.
    """
    sizes = np.array([len(c) for c in contexts])
    ends = np.cumsum(sizes)
    h = gram_hashes(np.frombuffer(b"".join(contexts), np.uint8))
    low = ends - sizes
    hits = np.flatnonzero((h & _KEPT) == np.repeat(grams, sizes)[: len(h)])
    which = np.searchsorted(ends, hits, "right")
    hits, which = hits[hits + GRAM <= ends[which]], which[hits + GRAM <= ends[which]]
    place = np.full(len(contexts), -1)
    place[which[::-1]] = hits[::-1]
    passed = np.zeros(len(contexts), bool)
    for beside, inside in ((place - GRAM, place - GRAM >= low), (place + GRAM, place + 2 * GRAM <= ends)):
        has = np.flatnonzero(inside & (place >= 0))
        if not len(has):
            continue
        key = _mixed(grams[has] * _ODD[14] + h[beside[has]] * _ODD[15])
        order = np.argsort(key, kind="stable")
        new = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        least, most = np.minimum.reduceat(owners[has][order], new), np.maximum.reduceat(owners[has][order], new)
        several = np.repeat(least != most, np.diff(np.append(new, len(order))))
        passed[has[order[several]]] = True
    return passed


def marked(contexts: list[bytes], owners: np.ndarray, length: int = LENGTH) -> list[tuple[int, int, int]]:
    """(context, first, end) of the bytes in matches with a smaller owner."""
    index = RunLengthIndex(contexts, owners, length)
    found = [(c[w < owners[c]], p[w < owners[c]]) for c, p, w in index.stream()]
    if not found:
        return []
    which, place = (np.concatenate(part) for part in zip(*found, strict=True))
    order = np.lexsort((place, which))
    which, place = which[order], place[order]
    if not len(which):
        return []
    new = (np.diff(which, prepend=-1) != 0) | (np.diff(place, prepend=-1) > length)
    start = np.flatnonzero(new)
    last = np.append(start[1:], len(which)) - 1
    return list(zip(which[start].tolist(), place[start].tolist(), (place[last] + length).tolist(), strict=True))


# Operator


def _same_text():
    return (F.col("__doc") == F.col("_d")) & (F.col("__variant") == F.col("_v"))


def _variant(text):
    """Tells texts of one id apart."""
    return F.xxhash64(text)


def _cut_contexts(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    """..., __doc, __variant, __wanted [(gram, info)] or null -> one row per context."""
    for batch in batches:
        out = []
        for text, doc, variant, wanted in zip(batch.column(text_at), *batch.columns[-3:], strict=True):
            wanted = wanted.as_py()
            if not wanted:
                continue
            raw, doc, variant = _utf8(text.as_py() or ""), doc.as_py(), variant.as_py()
            first, last = _unpack(np.array([w["info"] for w in wanted], np.int64))
            for w, low, high in zip(wanted, first.tolist(), last.tolist(), strict=True):
                out.append((w["gram"], doc, variant, low, raw[low : high + LENGTH]))
        if out:
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                names=["gram", "doc_id", "variant", "start", "bytes"],
            )


def repeated_ranges(keyed: DataFrame, text: str, crowded: int = CROWDED, bucket_contexts: int = BUCKET_CONTEXTS) -> DataFrame:
    """(doc_id, variant, start, end) of byte ranges to remove; they may overlap.

    ``keyed`` ends with __doc and __variant, which tells texts of one id apart.
    """
    usable = keyed.filter("__doc is not null")
    ids_repeat = not usable.groupBy("__doc").count().filter("count > 1").isEmpty()
    texts = usable.select("__doc", "__variant", text_column(usable, text).alias("text"))
    rows = texts.mapInArrow(_anchor_rows, "gram long, context long, doc_id long, variant long, info long")
    if ids_repeat:
        rows = rows.distinct()
    sorted_rows = rows.repartition("gram").sortWithinPartitions("gram", "context", "doc_id", "variant", "info")
    runs = saved(sorted_rows.mapInArrow(_read_runs, "gram long, doc_id long, variant long, info long, open boolean"), "passage-runs")
    first = F.shiftright("info", 6)
    end = first + F.col("info").bitwiseAND(F.lit(63)) + LENGTH
    settled = runs.filter("not open").select("doc_id", "variant", first.alias("start"), end.alias("end"))

    still = runs.filter("open").select("gram", "doc_id", "variant", "info")
    buckets = max(1, -(-still.count() // bucket_contexts))
    full = saved(still.groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") > crowded).select("gram"), "passage-crowded")
    some_full = not full.isEmpty()
    few, many = (still.join(full, "gram", kind) for kind in ("left_anti", "left_semi")) if some_full else (still, None)

    def contexts(of: DataFrame) -> DataFrame:
        wanted = of.groupBy(F.col("doc_id").alias("_d"), F.col("variant").alias("_v")).agg(
            F.collect_list(F.struct("gram", "info")).alias("__wanted")
        )
        # The same columns, keys and kind of join as where the ranges are cut out, so that texts are shuffled once.
        found = keyed.join(wanted.hint("shuffle_hash"), _same_text(), "left")
        if ids_repeat:
            found = found.filter("__wanted is not null").dropDuplicates(["__doc", "__variant"])
        text_at = keyed.columns.index(text)
        return found.select(*keyed.columns, "__wanted").mapInArrow(
            lambda batches: _cut_contexts(batches, text_at), "gram long, doc_id long, variant long, start long, bytes binary"
        )

    bucket = F.pmod(F.xxhash64("gram"), F.lit(buckets)).alias("bucket")

    def index(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame[may_match(list(frame["bytes"]), frame["gram"].to_numpy().astype(np.uint64), frame["doc_id"].to_numpy())]
        found = marked(list(frame["bytes"]), frame["doc_id"].to_numpy()) if len(frame) else []
        which = [c for c, _, _ in found]
        out = frame.iloc[which][["doc_id", "variant"]].copy()
        out["start"] = frame["start"].to_numpy()[which] + np.array([s for _, s, _ in found], np.int64)
        out["end"] = frame["start"].to_numpy()[which] + np.array([e for _, _, e in found], np.int64)
        return out

    ranges = "doc_id long, variant long, start long, end long"
    dealt = contexts(few).select("gram", "doc_id", "variant", "start", "bytes", bucket)
    matched = dealt.groupBy("bucket").applyInPandas(index, ranges)
    if not some_full:
        return settled.unionByName(matched)

    # Windows of crowded grams, one by one.
    at = F.explode(F.sequence(F.lit(0), F.length("bytes") - LENGTH)).alias("at")
    windows = contexts(many).select("doc_id", "variant", "start", "bytes", at)
    window = F.substring("bytes", F.col("at") + 1, F.lit(LENGTH))
    windows = windows.select("doc_id", "variant", (F.col("start") + F.col("at")).alias("start"), window.alias("window"))
    smallest = windows.groupBy("window").agg(F.min("doc_id").alias("_least"))
    single = windows.join(smallest, "window").filter("doc_id > _least").select(
        "doc_id", "variant", "start", (F.col("start") + LENGTH).alias("end")
    )
    return settled.unionByName(matched).unionByName(single)


def remove_passages(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", as_text: bool = False, crowded: int = CROWDED
) -> DataFrame:
    """All columns of ``documents`` and n_bytes, n_removed, n_spans and the remaining bytes, as ``kept_bytes`` or ``kept_text``.

    As text, the rest of a character that was cut apart is left out. Columns of these names in ``documents`` give way.
    """
    documents = documents.drop(*[c for c in ("n_bytes", "n_removed", "n_spans", "kept_text" if as_text else "kept_bytes") if c not in (id_column, text)])
    doc = documents[id_column].cast("long")
    keyed = documents.select("*", doc.alias("__doc"), _variant(text_column(documents, text)).alias("__variant"))
    ranges = repeated_ranges(keyed, text, crowded)
    by_text = ranges.groupBy(F.col("doc_id").alias("_d"), F.col("variant").alias("_v")).agg(
        F.collect_list(F.struct("start", "end")).alias("__ranges")
    )
    joined = keyed.join(by_text.hint("shuffle_hash"), _same_text(), "left")
    kept = documents.columns
    fields = joined.select(*kept).schema
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_text", "string") if as_text else ("kept_bytes", "binary")):
        fields = fields.add(name, kind)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, found in zip(batch.column(kept.index(text)), batch.column(len(kept) + 2), strict=True):
                raw = _utf8(value.as_py() or "")
                spans = united([(r["start"], r["end"]) for r in found.as_py() or ()])
                parts, at = [], 0
                for low, high in spans:
                    parts.append(raw[at:low])
                    at = high
                left = b"".join([*parts, raw[at:]])
                out.append((len(raw), len(raw) - len(left), len(spans), left.decode("utf-8", "ignore") if as_text else left))
            columns = zip(*out, strict=True) if out else [[]] * 4
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.string() if as_text else pa.binary()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=fields.fieldNames(),
            )

    return joined.select(*keyed.columns, "__ranges").mapInArrow(cut, fields)


def united(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, with those that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], high)
        else:
            out.append((low, high))
    return out
