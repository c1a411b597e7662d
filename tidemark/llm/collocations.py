r"""Phrases whose words keep together, mined with stripes.

A stripe belongs to a prefix of no, one or two words and counts the words that follow it, the end of a piece included. Tasks
fill stripes from their texts and send them on whole; stripes of one prefix are merged elementwise. A merged stripe holds all
that is asked: its entries are the counts of the extensions, its total is the count of the prefix itself, and its largest
entry says whether one extension takes the prefix over.

Levels are mined one after another: a phrase of ``LEAST`` occurrences has a first and a last part of as many, so a stripe is
kept for frequent prefixes alone, and words that cannot extend it are counted together as its rest; totals stay exact.
Frequent parts are known to the tasks by a bit table of at most ``MOST_BITS`` bits; a wrong hit costs an entry, never a count.

A stripe of a prefix with more than ``HOT_SHARE`` of all words goes to ``SECTIONS`` places by the hash of the next word (there
are few such prefixes, and the level below counts them). Elementwise merging is a spilling aggregation inside the partition
of the prefix; no stripe is held whole.

Defined cases: A-Z are lower-cased; pieces end at ``[.,;:!?\x0A-\x0D]``, words are runs without space and tab; a null text
is the empty text and has no words; a null lang is ``und``; equal rows count as often as they come; ids are not read, nor
any other column, whatever its name; an empty table gives no rows. Scores are exact while 10^6 a^2 has at most 38 digits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from tidemark.llm.filter_audit import blocks
from tidemark.llm.storage import saved, text_column

LEAST = 10
OVER = 50
TOP = 2000
#: Tokens that a task counts at once, and words of a language that it numbers.
HELD = 1 << 22
NUMBERED = 1 << 20
MINERS = 64
HOT_SHARE = 1e-3
SECTIONS = 256
MOST_BITS = 1 << 27

_END, _REST = 0, 1
#: In stripes: the end of a piece, and all words that cannot extend the prefix.
END, REST = "", "\n"
_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(
    bytes(range(ord("A"), ord("Z") + 1)) + _SEPARATORS,
    bytes(range(ord("a"), ord("z") + 1)) + b"\xff" * len(_SEPARATORS),
)
STRIPE = "lang string, prefix string, section int, following array<string>, counts array<long>"


def tokens(raw: bytes) -> list[bytes]:
    """Words and ends of pieces; 0xFF is in no UTF-8 text."""
    return raw.translate(_TABLE).replace(b"\xff", b" \xff ").split()


@dataclass
class Bits:
    """A set of phrases by the crc32 of language and phrase."""

    words: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))

    def has(self, crc: np.ndarray) -> np.ndarray:
        place = crc.astype(np.int64) % (len(self.words) * 64)
        return (self.words[place >> 6] >> (place & 63)) & 1 == 1


def bit_table(phrases: DataFrame) -> Bits:
    """The bits of (lang, phrase) rows: 16 for each, ``MOST_BITS`` at most."""
    size = 64
    while size < min(16 * phrases.count(), MOST_BITS):
        size *= 2
    place = F.crc32(F.concat(F.col("lang"), F.lit("\n"), F.col("phrase")).cast("binary")) % size
    bit = F.expr("shiftleft(CAST(1 AS BIGINT), CAST(place % 64 AS INT))")
    rows = phrases.select(place.alias("place")).groupBy(F.floor(F.col("place") / 64).alias("at")).agg(F.bit_or(bit).alias("bits"))
    held = rows.toPandas()
    out = np.zeros(size // 64, np.int64)
    out[held["at"].to_numpy(np.int64)] = held["bits"].to_numpy(np.int64)
    return Bits(out)


class _Words(dict):
    """Word -> number, with the word's crc and whether it is frequent."""

    def __init__(self, lang: str, frequent: Bits | None):
        super().__init__({b"\xff": _END})
        self._head, self._frequent = zlib.crc32(lang.encode() + b"\n"), frequent
        self.names: list[bytes] = [b"", REST.encode()]
        self.crcs: list[int] = [0, 0]
        self._known = np.zeros(0, bool)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.names)
        self.names.append(word)
        self.crcs.append(zlib.crc32(word, self._head))
        return number

    def frequent(self) -> np.ndarray:
        """A flag for every number."""
        if len(self._known) < len(self.names):
            fresh = self._frequent.has(np.array(self.crcs[len(self._known) :], np.int64))
            fresh[: max(0, 2 - len(self._known))] = False
            self._known = np.concatenate([self._known, fresh])
        return self._known


class _Miner:
    """Stripes of one level for the texts of one language."""

    def __init__(self, lang: str, level: int, words: Bits | None, pairs: Bits | None, hot: frozenset[str]):
        self.lang, self._level, self._frequent, self._pairs, self._hot = lang, level, words, pairs, hot
        self._words = _Words(lang, words)
        self._parts: list[np.ndarray] = []
        self.held = 0

    def add(self, raw: bytes) -> Iterator[pa.RecordBatch]:
        """A text; stripes come out when enough is held."""
        for block in blocks(raw):
            found = tokens(block)
            self._parts.append(np.fromiter(map(self._words.__getitem__, found), np.int64, len(found)))
            self.held += len(found)
            if self.held > HELD:
                yield from self.flush()
        self._parts.append(np.zeros(1, np.int64))

    def flush(self) -> Iterator[pa.RecordBatch]:
        """Stripes of all that is held; the tokens that may still be extended stay."""
        row = np.concatenate(self._parts) if self._parts else np.zeros(0, np.int64)
        names = self._words.names
        if len(row) > self._level:
            yield from self._stripes(row, names)
        tail = row[len(row) - self._level :] if self._level else row[:0]
        if len(names) > NUMBERED:
            words = _Words(self.lang, self._frequent)
            tail = np.array([words[names[t]] if t > _REST else _END for t in tail], np.int64)
            self._words = words
        self._parts, self.held = [tail], 0

    def _stripes(self, row: np.ndarray, names: list[bytes]) -> Iterator[pa.RecordBatch]:
        if self._level == 0:
            prefix, following = np.zeros(len(row), np.int64), row
            keep = row != _END
            spell = lambda _: b""
        elif self._level == 1:
            frequent = self._words.frequent()
            prefix, following, keep = row[:-1], self._extend(row[1:], frequent[row[1:]]), frequent[row[:-1]]
            spell = names.__getitem__
        else:
            frequent = self._words.frequent()[row]
            both = frequent[:-1] & frequent[1:]
            pairs, found = np.unique((row[:-1] << 32 | row[1:])[both], return_inverse=True)
            at = np.zeros(len(both), np.int64)
            at[both] = found
            known = both.copy()
            known[both] = self._known_pairs(pairs)[found]
            prefix, following, keep = at[:-1], self._extend(row[2:], known[1:]), known[:-1]
            spell = lambda p: names[pairs[p] >> 32] + b" " + names[pairs[p] & 0xFFFFFFFF]
        if self._level == 0:  # numbers are small and dense
            seen = np.bincount(following[keep])
            entries = np.flatnonzero(seen)
            counts = seen[entries]
        else:
            entries, counts = np.unique(prefix[keep] << 32 | following[keep], return_counts=True)
        if not len(entries):
            return
        prefix, following = entries >> 32, entries & 0xFFFFFFFF
        first = np.flatnonzero(np.diff(prefix, prepend=-1))
        spelt = [spell(p) for p in prefix[first].tolist()]
        section = np.zeros(len(entries), np.int64)
        ends = np.append(first[1:], len(entries))
        for start, end, name in zip(first, ends, spelt):
            if name.decode() in self._hot:
                section[start:end] = [zlib.crc32(names[f]) % SECTIONS for f in following[start:end]]
        number = np.repeat(np.arange(len(first)), ends - first)
        order = np.lexsort((section, number))
        number, section, following, counts = number[order], section[order], following[order], counts[order]
        starts = np.flatnonzero((np.diff(number, prepend=-1) != 0) | (np.diff(section, prepend=-1) != 0))
        spellings = pa.array(names, pa.binary()).cast(pa.string())
        offsets = pa.array(np.append(starts, len(number)), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, v) for v in (spellings.take(pa.array(following)), pa.array(counts.astype(np.int64)))]
        prefixes = pa.array(spelt, pa.binary()).cast(pa.string()).take(pa.array(number[starts]))
        langs = pa.array([self.lang], pa.string()).take(pa.array(np.zeros(len(starts), np.int32)))
        out = pa.table([langs, prefixes, pa.array(section[starts], pa.int32()), *lists], names=["lang", "prefix", "section", "following", "counts"])
        yield from out.to_batches(20_000)

    @staticmethod
    def _extend(following: np.ndarray, fits: np.ndarray) -> np.ndarray:
        return np.where(fits | (following == _END), following, _REST)

    def _known_pairs(self, pairs: np.ndarray) -> np.ndarray:
        crcs, names = self._words.crcs, self._words.names
        both = zip((pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist())
        found = [zlib.crc32(names[y], zlib.crc32(b" ", crcs[x])) for x, y in both]
        return self._pairs.has(np.array(found, np.int64))


def _stripes(level: int, words: Bits | None, pairs: Bits | None, hot: dict[str, frozenset[str]]):
    """Arrow batches of (lang, raw text) to stripes of one level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        miners: dict[str, _Miner] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if len(miners) > MINERS or sum(m.held for m in miners.values()) > HELD:
                    fullest = max(miners, key=lambda k: miners[k].held)
                    yield from (miners.pop(fullest) if len(miners) > MINERS else miners[fullest]).flush()
                if lang not in miners:
                    miners[lang] = _Miner(lang, level, words, pairs, hot.get(lang, frozenset()) if level else frozenset([""]))
                yield from miners[lang].add(text.as_py())
        for miner in miners.values():
            yield from miner.flush()

    return run


def _merged(stripes: DataFrame) -> DataFrame:
    """Stripes of one prefix added elementwise: (lang, prefix, section, following, a)."""
    return (
        stripes.repartition("lang", "prefix", "section")
        .select("lang", "prefix", "section", F.inline(F.arrays_zip("following", "counts")))
        .groupBy("lang", "prefix", "section", "following")
        .agg(F.sum("counts").alias("a"))
    )


def _hot(counts: DataFrame, total: int) -> dict[str, frozenset[str]]:
    """Phrases with more than ``HOT_SHARE`` of all words, by language: at most ``1 / HOT_SHARE``."""
    found: dict[str, set[str]] = {}
    for row in counts.filter(F.col("a") > HOT_SHARE * total).select("lang", "phrase").collect():
        found.setdefault(row["lang"], set()).add(row["phrase"])
    return {lang: frozenset(phrases) for lang, phrases in found.items()}


def _level(texts: DataFrame, level: int, words: Bits, pairs: Bits | None, hot: dict) -> DataFrame:
    """(lang, prefix, section, total, largest, extensions): extensions are the entries of at least ``LEAST``."""
    entries = _merged(texts.mapInArrow(_stripes(level, words, pairs, hot), STRIPE))
    word = ~F.col("following").isin(END, REST)
    found = entries.groupBy("lang", "prefix", "section").agg(
        F.sum("a").alias("total"),
        F.coalesce(F.max(F.when(word, F.col("a"))), F.lit(0).cast("long")).alias("largest"),
        F.collect_list(F.when(word & (F.col("a") >= LEAST), F.struct("following", "a"))).alias("extensions"),
    )
    return saved(found, f"stripes-{level}")


def mined_stripes(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stripes of one-word and two-word prefixes, and the number of words by language (lang, n)."""
    texts = documents.select(
        F.coalesce(documents["lang"].cast("string"), F.lit("und")).alias("lang"),
        text_column(documents, "text").cast("binary").alias("raw"),
    )
    words = saved(_merged(texts.mapInArrow(_stripes(0, None, None, {}), STRIPE)).withColumnRenamed("following", "phrase"), "words")
    sizes = words.groupBy("lang").agg(F.sum("a").alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = words.filter(F.col("a") >= LEAST).select("lang", "phrase", "a")
    bits = bit_table(frequent)
    ones = _level(texts, 1, bits, None, _hot(frequent, total))
    extended = ones.select("lang", "prefix", F.inline("extensions"))
    pairs = extended.select("lang", F.concat_ws(" ", "prefix", "following").alias("phrase"), "a")
    twos = _level(texts, 2, bits, bit_table(pairs), _hot(pairs, total))
    return ones.unionByName(twos), sizes


def _score(a: str, l: str, r: str) -> Column:
    """floor(10^6 a^2 / (l r)) in whole numbers."""
    whole = {name: f"CAST({name} AS DECIMAL(19,0))" for name in (a, l, r)}
    return F.expr(f"(1000000 * {whole[a]} * {whole[a]}) div ({whole[l]} * {whole[r]})")


def collocations(documents: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    stripes, sizes = mined_stripes(documents)
    counts = stripes.groupBy("lang", "prefix").agg(F.sum("total").alias("f"), F.max("largest").alias("largest"))
    words = sizes.withColumnRenamed("lang", "n_lang")
    known = saved(counts.filter(F.col("f") >= LEAST), "prefixes")

    def joined(rows: DataFrame, phrase: Column, out: str, *more: str) -> DataFrame:
        right = known.select(
            F.col("lang").alias("__lang"), F.col("prefix").alias("__prefix"), F.col("f").alias(out), *[F.col(m) for m in more]
        )
        return rows.join(right, (F.col("lang") == F.col("__lang")) & (phrase == F.col("__prefix"))).drop("__lang", "__prefix")

    # The total of a prefix meets its sections, not its extensions.
    wide = joined(stripes.filter(F.size("extensions") > 0), F.col("prefix"), "prefix_f")
    phrases = saved(
        wide.select("lang", "prefix", "prefix_f", F.inline("extensions")).withColumn("phrase", F.concat_ws(" ", "prefix", "following")),
        "phrases",
    )
    pairs = phrases.filter(~F.col("prefix").contains(" "))
    triples = phrases.filter(F.col("prefix").contains(" "))
    first, last_two = F.element_at(F.split("prefix", " "), 1), F.concat_ws(" ", F.element_at(F.split("prefix", " "), 2), F.col("following"))

    # Two words: what takes them over from the right is the largest entry of their own stripe, from the left the
    # largest three-word phrase that ends with them.
    before = triples.groupBy(F.col("lang").alias("__l"), last_two.alias("__p")).agg(F.max("a").alias("before"))
    two = joined(joined(pairs, F.col("following"), "r"), F.col("phrase"), "again", "largest")
    two = two.join(before, (F.col("lang") == F.col("__l")) & (F.col("phrase") == F.col("__p")), "left")
    longer = F.greatest(F.coalesce("before", F.lit(0)), F.when(F.col("largest") >= LEAST, F.col("largest")).otherwise(0))
    two = two.filter(~((longer > 0) & (100 * longer >= OVER * F.col("a"))))
    two = two.select("lang", "phrase", "a", F.col("prefix_f").alias("l"), "r", _score("a", "prefix_f", "r").alias("score"))

    three = joined(joined(joined(triples, F.col("following"), "r_last"), first, "l_first"), last_two, "r_two")
    three = three.withColumns({"s1": _score("a", "l_first", "r_two"), "s2": _score("a", "prefix_f", "r_last")})
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", "phrase", "a", F.when(early, F.col("l_first")).otherwise(F.col("prefix_f")).alias("l"),
        F.when(early, F.col("r_two")).otherwise(F.col("r_last")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    # The first of each of 64 parts of a language, then the first of these.
    first_come = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    best = two.unionByName(three).withColumn("part", part)
    best = best.withColumn("rank", F.row_number().over(Win.partitionBy("lang", "part").orderBy(*first_come))).filter(F.col("rank") <= top)
    place = F.row_number().over(Win.partitionBy("lang").orderBy(*first_come)).cast("long")
    ranked = best.withColumn("rank", place).filter(F.col("rank") <= top)
    out = ranked.join(words, F.col("lang") == F.col("n_lang"))
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
