"""Toxicity by a small convolutional network over hashed word embeddings, trained in numpy.

Words are lower-cased runs of word characters, hashed to ``BUCKETS`` places; a place has an embedding where at least two
texts of training use it, all other words share a zero one. Filters of several widths slide over a text, the largest
answer of each filter over the whole text is kept, and a linear layer makes one number of them. The decision threshold is
set per language on a fold that training does not see; the language is guessed from common words of the text itself, and
the score is shifted so that each language's threshold lies at ``DECISION``.

Learning reads the whole texts of all labelled rows. They are dealt into parts of about ``PART_ROWS`` rows or ``PART_WORDS``
words. Each round trains every part from the same model in a task of its own; Spark then averages each weight over the parts
that use it, by their texts. One part is trained in one go. Words are counted and thresholds are set over all rows as well;
thresholds lie between steps of 1 / ``STEPS`` of the answer. What the driver holds, the model and those steps, is bounded by
``BUCKETS`` and ``LIMIT``. Scoring reads every word of every text, one Arrow batch at a time.

Defined cases: null and empty texts have no words and score as a text of unknown words; rows are scored one by one,
whatever repeats; only the text is read for a score; without labels the score is 0.5, with one class it leans to that
class; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import every
from tidemark.llm.storage import saved, text_column

BUCKETS = 1 << 22
PART_ROWS = 8_192
PART_WORDS = 1 << 22
#: Answers are counted in steps of 1 / STEPS between -LIMIT and LIMIT.
STEPS = 1024
LIMIT = 64
#: Words multiplied at once: small enough for the cache, and for a product that starts no threads.
BLOCK = 2_048
#: No weight is larger.
LARGEST = 1024
WIDTHS = (1, 2, 3)
FILTERS = 12
DIM = 8
DECISION = 0.7
_WORDS = re.compile(r"\w+").findall
#: Common words by which a language is guessed; a text without any counts as the last one.
COMMON = {
    "en": "the of and to in is that for with are",
    "de": "der die das und den dem ein ist von auf",
    "fr": "le les des et est une dans pour que du",
    "es": "el los las que y en del una por es",
    "other": "",
}
LANGUAGES = tuple(COMMON)


def bucket(word: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) % BUCKETS


class _Rows(dict):
    """Word -> embedding row, remembered for a bounded number of words."""

    def __init__(self, table: np.ndarray):
        super().__init__()
        self._table = table

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        row = self[word] = int(self._table[bucket(word)])
        return row


@dataclass
class ToxicityModel:
    """Row 0 of the embeddings belongs to all unknown words and to the margin of a text."""

    places: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    embeddings: np.ndarray = field(default_factory=lambda: np.zeros((1, DIM), np.float32))
    filters: list[np.ndarray] = field(default_factory=lambda: [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS])
    bias: list[np.ndarray] = field(default_factory=lambda: [np.zeros(FILTERS, np.float32) for _ in WIDTHS])
    out: np.ndarray = field(default_factory=lambda: np.zeros(len(WIDTHS) * FILTERS, np.float32))
    shift: float = 0.0
    slope: float = 1.0
    thresholds: dict[str, float] = field(default_factory=dict)

    # Texts

    def reader(self):
        return _Rows(self.table()).__getitem__

    def table(self) -> np.ndarray:
        """The embedding row of every place."""
        rows = np.zeros(BUCKETS, np.int32)
        rows[self.places] = np.arange(1, len(self.places) + 1)
        return rows

    @staticmethod
    def words(text: str) -> list[str]:
        return _WORDS(text.lower())

    @staticmethod
    def language(words: list[str]) -> str:
        counts = Counter(words)
        hits = [sum(counts[w] for w in COMMON[name].split()) for name in LANGUAGES]
        best = int(np.argmax(hits))
        return LANGUAGES[best] if hits[best] else LANGUAGES[-1]

    # Network

    def forward(self, texts: list[np.ndarray]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Answers per text, and per width the largest value and its place for every filter.

        Texts lie one after another with a margin of unknown words, so a filter never sees two of them.
        """
        gap = np.zeros(max(WIDTHS) + 1, np.int64)
        flat = np.concatenate([part for text in texts for part in (text, gap)])
        sizes = np.array([len(text) for text in texts])
        starts = np.cumsum(sizes + len(gap)) - sizes - len(gap)
        ends = starts + np.maximum(sizes, 1)
        bounds = np.stack([starts, ends], 1).ravel()
        x = self.embeddings.take(flat, axis=0)
        size = len(flat) - max(WIDTHS) + 1
        pooled = []
        for filters, bias in zip(self.filters, self.bias, strict=True):
            answer = np.empty((size, FILTERS), np.float32)
            for low in range(0, size, BLOCK):
                part = answer[low : low + BLOCK]
                np.matmul(x[low : low + len(part)], filters[0], out=part)
                for offset in range(1, len(filters)):
                    part += x[low + offset : low + offset + len(part)] @ filters[offset]
                part += bias
            pooled.append((np.maximum.reduceat(answer, bounds, axis=0)[::2], answer))
        hidden = np.concatenate([np.maximum(best, 0) for best, _ in pooled], axis=1)
        self._last = flat, starts, ends, x, hidden
        return hidden @ self.out + self.shift, pooled

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        return self.forward(texts)[0]

    def step(self, texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, optimiser) -> float:
        """One Adam step on a batch; the gradient reaches the places of the largest answers only."""
        z, pooled = self.forward(texts)
        flat, starts, ends, x, hidden = self._last
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        slope = (weights * (p - labels) / len(texts)).astype(np.float32)
        grads = {"out": hidden.T @ slope, "shift": np.array([slope.sum()], np.float32)}
        of_words = np.zeros_like(x)
        for i, (best, answer) in enumerate(pooled):
            own = slope[:, None] * self.out[i * FILTERS : (i + 1) * FILTERS] * (best > 0)
            width, of_filter = len(self.filters[i]), np.zeros_like(self.filters[i])
            top = np.stack([s + answer[s:e].argmax(0) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])
            for offset in range(width):
                seen = x[top + offset]  # text, filter, dim
                of_filter[offset] = np.einsum("tf,tfd->df", own, seen)
                np.add.at(of_words, (top + offset).ravel(), (own[:, :, None] * self.filters[i][offset].T[None]).reshape(-1, DIM))
            grads[f"filter{i}"], grads[f"bias{i}"] = of_filter, own.sum(0)
        touched, inverse = np.unique(flat, return_inverse=True)
        of_rows, reached = np.zeros((len(touched), DIM), np.float32), np.flatnonzero(of_words.any(1))
        np.add.at(of_rows, inverse[reached], of_words[reached])
        of_rows[touched == 0] = 0
        optimiser(self, grads, touched, of_rows)
        return float(-np.mean(weights * np.log(np.where(labels == 1, p, 1 - p) + 1e-9)))

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, epochs: int, seed: int = 11) -> None:
        rng, optimiser = np.random.default_rng(seed), _Adam(self)
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for low in range(0, len(order), 32):
                part = order[low : low + 32]
                self.step([texts[i] for i in part], labels[part], weights[part], optimiser)

    def scores(self, texts: Iterator[str], read) -> np.ndarray:
        """Scores of whole texts."""
        found, rows, names, size = [], [], [], 0

        def flush():
            if rows:
                limits = np.array([self.thresholds.get(n, self.thresholds.get("", 0.0)) for n in names])
                z = self.slope * (self.logits(rows) - limits) + (np.log(DECISION / (1 - DECISION)) if self.thresholds else 0.0)
                found.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        for text in texts:
            words = self.words(text)
            rows.append(np.fromiter(map(read, words), np.int64, len(words)))
            names.append(self.language(words))
            size += len(words)
            if size > 200_000:
                flush()
                rows, names, size = [], [], 0
        flush()
        return np.concatenate(found) if found else np.zeros(0)


class _Adam:
    """Adam with the state of embedding rows kept per row."""

    def __init__(self, model: ToxicityModel, rate: float = 0.02):
        self.rate, self.count, self.state = rate, 0, {}
        self.first, self.second = np.zeros_like(model.embeddings), np.zeros_like(model.embeddings)

    def _move(self, name, grad):
        m, v = self.state.get(name, (0.0, 0.0))
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        self.state[name] = m, v
        return self.rate * (m / (1 - 0.9**self.count)) / (np.sqrt(v / (1 - 0.99**self.count)) + 1e-6)

    def __call__(self, model, grads, rows, of_rows):
        self.count += 1
        model.out -= self._move("out", grads["out"])
        model.shift -= float(self._move("shift", grads["shift"])[0])
        for i in range(len(WIDTHS)):
            model.filters[i] -= self._move(f"filter{i}", grads[f"filter{i}"])
            model.bias[i] -= self._move(f"bias{i}", grads[f"bias{i}"])
        m = self.first[rows] = 0.9 * self.first.take(rows, axis=0) + 0.1 * of_rows
        v = self.second[rows] = 0.99 * self.second.take(rows, axis=0) + 0.01 * of_rows * of_rows
        model.embeddings[rows] -= self.rate * m / (np.sqrt(v) + 1e-6) * np.sqrt(1 - 0.99**self.count) / (1 - 0.9**self.count)
        model.embeddings[0] = 0


def threshold(low: np.ndarray, top: np.ndarray, hit: np.ndarray, rows: np.ndarray) -> float:
    """The cut with the best F1, in the middle of the gap it lies in, from ascending steps: the lowest and the highest answer,
    toxic rows and all rows of each."""
    found = np.cumsum(hit[::-1])[::-1]
    flagged = np.cumsum(rows[::-1])[::-1]
    f1 = 2 * found / (flagged + hit.sum())
    at = int(np.argmax(f1))
    return float(low[at] + top[at - 1]) / 2 if at else float(low[0]) - 1.0


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, label, fold, text) with the language and the hashed words instead of the text."""
    for batch in batches:
        words = [ToxicityModel.words(text) for text in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:3],
                pa.array(map(ToxicityModel.language, words), pa.string()),
                pa.array(map(len, words), pa.int64()),
                pa.array([np.array([bucket(w) for w in ws], "<u4").tobytes() for ws in words], pa.binary()),
            ],
            names=["doc_id", "label", "fold", "language", "size", "words"],
        )


def _places(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(raw, "<u4").astype(np.int32) for raw in column.to_pylist()]


def _uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, words): how many texts, and how many toxic ones, use a place."""
    for batch in batches:
        if batch.num_rows:
            seen = [np.unique(places) for places in _places(batch.column(1))]
            toxic = np.repeat(batch.column(0).to_numpy() == 1, [len(places) for places in seen])
            places, at = np.unique(np.concatenate(seen), return_inverse=True)
            counts = np.bincount(at, minlength=len(places)), np.bincount(at[toxic], minlength=len(places))
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int32()), *(pa.array(c, pa.int64()) for c in counts)], names=["place", "uses", "toxic"]
            )


def _start(learned: DataFrame, n0: int, n1: int) -> ToxicityModel:
    """The untrained network; known words and their start values come from all texts of training."""
    counted = learned.select("label", "words").mapInArrow(_uses, "place int, uses long, toxic long")
    counted = counted.groupBy("place").agg(F.sum("uses").alias("uses"), F.sum("toxic").alias("toxic")).filter("uses >= 2")
    known = counted.toArrow().sort_by("place")
    places, uses, toxic = (known[name].to_numpy() for name in ("place", "uses", "toxic"))
    model, rng = ToxicityModel(places=places), np.random.default_rng(5)
    model.embeddings = np.empty((len(places) + 1, DIM), np.float32)
    for low in range(0, len(model.embeddings), 1 << 16):
        part = model.embeddings[low : low + (1 << 16)]
        part[:] = (rng.normal(size=part.shape) * 0.02).astype(np.float32)
    # A place starts with how much oftener toxic texts use it, drawn towards 0 where few texts do.
    odds = np.log((toxic + 1) / (n1 + 2) * (n0 + 2) / (uses - toxic + 1))
    model.embeddings[1:, 0] = odds * uses / (uses + 5)
    model.embeddings[0] = 0
    model.filters = [(rng.normal(size=(w, DIM, FILTERS)) * 0.2).astype(np.float32) for w in WIDTHS]
    model.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    model.out = np.full(len(WIDTHS) * FILTERS, 0.1, np.float32)
    model.shift = -1.0
    return model


def _layers(model: ToxicityModel) -> np.ndarray:
    """All weights but the embeddings, in rows as wide as theirs."""
    shift = float(np.float32(model.shift)), model.shift - float(np.float32(model.shift))  # a double in two floats
    flat = np.concatenate([model.out, shift, *(f.ravel() for f in model.filters), *model.bias])
    return np.append(flat, np.zeros(-len(flat) % DIM)).reshape(-1, DIM)


def _set_layers(model: ToxicityModel, rows: np.ndarray) -> None:
    flat, sizes = rows.ravel(), [len(model.out), 2, *(f.size for f in model.filters), *map(len, model.bias)]
    out, shift, *rest = np.split(flat[: sum(sizes)].astype(np.float32), np.cumsum(sizes)[:-1])
    model.out, model.shift = out, float(shift[0]) + float(shift[1])
    model.filters = [part.reshape(f.shape) for part, f in zip(rest, model.filters, strict=False)]
    model.bias = rest[len(model.filters) :]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """(part, label, words), rows of a part together: the labels and words of one part after the other."""
    part, labels, texts = None, [], []
    for batch in batches:
        for own, label, places in zip(*(c.to_pylist() for c in batch.columns[:2]), _places(batch.column(2)), strict=True):
            if own != part:
                if labels:
                    yield part, np.array(labels, np.float32), texts
                part, labels, texts = own, [], []
            labels.append(label)
            texts.append(places)
    if labels:
        yield part, np.array(labels, np.float32), texts


def _trained(shared, even: tuple[float, float], passes: int, seed: int, unit: int):
    """Trains each part from the shared model. Gives its weights in units, times its texts: rows below 0 are the layers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start: ToxicityModel = shared.value
        table = start.table()
        for part, labels, texts in _parts(batches):
            ends = np.cumsum([len(places) for places in texts])
            rows = table[np.concatenate(texts)]
            used = np.zeros(len(start.embeddings), bool)
            used[0] = used[rows] = True
            own = np.flatnonzero(used)  # the part trains these rows alone
            texts = np.split((np.cumsum(used) - 1)[rows], ends[:-1])
            model = ToxicityModel(embeddings=start.embeddings[own])
            _set_layers(model, _layers(start))
            model.fit(texts, labels, np.where(labels == 1, even[1], even[0]).astype(np.float32), passes, seed + part)
            uses = np.zeros(len(own), np.int64)
            for text in texts:
                uses[text] += 1  # once, however often the text has the place
            layers = _layers(model)
            n = np.concatenate([np.full(len(layers), len(texts)), uses[1:]])
            values = np.concatenate([layers, model.embeddings[1:].astype(float)])
            sums = np.rint(np.clip(values, -LARGEST, LARGEST) * unit).astype(np.int64) * n[:, None]
            keys = np.concatenate([-1 - np.arange(len(layers)), own[1:]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int32()), pa.array(n, pa.int64()), *(pa.array(c, pa.int64()) for c in sums.T.copy())],
                names=["row", "n", *_VALUES],
            )

    return run


_VALUES = [f"v{i}" for i in range(DIM)]


def _round(
    model: ToxicityModel, parts: DataFrame, rows: int, even: tuple[float, float], passes: int, seed: int
) -> None:
    """Every part trained from ``model``; each weight becomes its mean over the texts of the parts that use it. Whole numbers
    are added, so that the order of the parts changes nothing, as fine as sums over ``rows`` texts allow."""
    unit = 1 << max(0, 63 - LARGEST.bit_length() - rows.bit_length())
    shared = parts.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(["row int, n long", *(f"{name} long" for name in _VALUES)])
    weights = parts.select("part", "label", "words").mapInArrow(_trained(shared, even, passes, seed, unit), schema)
    mean = [(F.sum(name) / F.sum("n") / F.lit(float(unit))).cast("float").alias(name) for name in _VALUES]
    found = weights.groupBy("row").agg(*mean).toArrow()
    shared.destroy()
    keys = found["row"].to_numpy()
    values = np.stack([found[name].to_numpy() for name in _VALUES], axis=1)
    layer = np.flatnonzero(keys < 0)
    _set_layers(model, values[layer[np.argsort(-keys[layer])]])
    model.embeddings[keys[keys > 0]] = values[keys > 0]


def _answers(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ToxicityModel = shared.value
        table = model.table()
        for batch in batches:
            texts, found, low, size = [table[places] for places in _places(batch.column(2))], [], 0, 0
            for i, text in enumerate(texts, 1):
                size += len(text)
                if size > 200_000 or i - low == 64 or i == len(texts):
                    found.append(model.logits(texts[low:i]))
                    low, size = i, 0
            z = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(z, pa.float32())], names=["language", "label", "z"])

    return run


def _calibrate(model: ToxicityModel, apart: DataFrame) -> None:
    """Thresholds of all rows and of each language that has enough of both classes."""
    shared = apart.sparkSession.sparkContext.broadcast(model)
    z = apart.select("language", "label", "words").mapInArrow(_answers(shared), "language string, label int, z float")
    step = F.floor(F.greatest(F.least(F.col("z"), F.lit(float(LIMIT))), F.lit(-float(LIMIT))) * STEPS).alias("step")
    z = z.select(F.explode(F.array("language", F.lit(""))).alias("name"), step, "label", "z").groupBy("name", "step")
    steps = z.agg(F.min("z").alias("low"), F.max("z").alias("top"), F.sum("label").alias("hit"), F.count("*").alias("rows"))
    steps = steps.toArrow().sort_by("step")
    shared.destroy()
    names = np.array(steps["name"].to_pylist())
    columns = [steps[name].to_numpy() for name in ("low", "top", "hit", "rows")]
    for name in ("", *LANGUAGES):
        low, top, hit, rows = (column[names == name] for column in columns)
        if not name or min(hit.sum(), (rows - hit).sum()) >= 15:
            model.thresholds[name] = threshold(low, top, hit, rows)


def train(
    documents: DataFrame, labels: DataFrame, learn: Column, epochs: int = 8, part_rows: int = PART_ROWS
) -> ToxicityModel:
    """The network from three folds of all labelled rows, thresholds from the other one. ``learn`` is a condition on doc_id."""
    rows, counts = every(documents, labels, "toxic", learn)
    if min(counts.get(0, 0), counts.get(1, 0)):
        schema = "doc_id long, label int, fold int, language string, size long, words binary"
        rows = saved(rows.select("doc_id", "label", "fold", "text").mapInArrow(_hashed, schema), "toxicity-words")
        of = rows.groupBy((F.col("fold") > 0).alias("learned"), "label")
        of = {(r[0], r[1]): (r[2], r[3]) for r in of.agg(F.count("*"), F.sum("size")).collect()}
        counts = {v: sum(n for (_, label), (n, _) in of.items() if label == v) for v in (0, 1)}
    if min(counts.get(0, 0), counts.get(1, 0)) == 0:
        return ToxicityModel(shift=3.0 * (bool(counts.get(1)) - bool(counts.get(0))))

    learned, apart = rows.filter("fold > 0"), rows.filter("fold = 0")
    if len(of) < 4:  # a handful of labels
        learned = apart = rows
        (n0, n1), words = (counts[0], counts[1]), sum(n for _, n in of.values())
    else:
        (n0, w0), (n1, w1) = of[True, 0], of[True, 1]
        words = w0 + w1
    model = _start(learned, n0, n1)
    parts = max(1, -(-(n0 + n1) // part_rows), -(-words // PART_WORDS))
    dealt = learned.select("doc_id", "label", "words").repartition(parts).withColumn("part", F.spark_partition_id())
    dealt = saved(dealt.sortWithinPartitions("doc_id", "label"), "toxicity-parts")
    even = (n0 + n1) / (2 * n0), (n0 + n1) / (2 * n1)
    passes = max(epochs, min(60, epochs * 2000 // (n0 + n1)))
    rounds = 1 if parts == 1 else epochs
    for number in range(rounds):
        _round(model, dealt, n0 + n1, even, -(-passes // rounds), 11 + 1_000_003 * number)
    _calibrate(model, apart)
    return model


def score(documents: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``documents`` with ``score``: how likely a text is toxic, from its whole text alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = model.reader()
        for batch in batches:
            found = model.scores((value.as_py() or "" for value in batch.column(last)), read)
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(found, pa.float64())], names=[*names, "score"])

    kept = documents.drop("score")
    last, names = len(kept.columns), kept.columns
    schema = kept.withColumn("score", F.lit(0.0)).schema
    return kept.withColumn("__text", text_column(documents, text)).mapInArrow(run, schema)
