"""Quality by compression: zstandard dictionaries of good and of bad text.

A text is cut into pieces of ``PIECE`` bytes and every piece is compressed with the dictionary of the good and with that of
the bad text. What the bad dictionary needs more, per compressed and per raw byte, says which kind of text it is; the bytes
per raw byte with the good dictionary say how much it repeats itself. A logistic curve over the three, fitted on labelled rows
that the dictionaries have not seen, makes the score. Every byte of every text counts; pieces bound the memory and keep
long texts from outgrowing the dictionary.

Learning reads at most ``SAMPLE_ROWS`` labelled rows of each class and at most ``PIECES_PER_ROW`` pieces of each for the
dictionaries; counts of all labelled rows restore the share of the classes.

Defined cases: null and empty texts score like any text with no difference; rows are scored one by one, whatever repeats;
only the text is read for a score; without labels the score is 0.5, with one class it leans to that class; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import sample
from tidemark.llm.storage import text_column

PIECE = 1024
DICTIONARY_BYTES = 112_640
SAMPLE_ROWS = 4_000
PIECES_PER_ROW = 6
LEVEL = 3


def _pieces(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]


def build_dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary; few pieces are one themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, k=200, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:]


@dataclass
class QualityModel:
    """Dictionaries and the curve over the three measures."""

    bad: bytes = b""
    good: bytes = b""
    weights: list[float] = field(default_factory=lambda: [0.0, 0.0, 0.0, 0.0])
    centre: list[float] = field(default_factory=lambda: [0.0, 0.0, 0.0])
    scale: list[float] = field(default_factory=lambda: [1.0, 1.0, 1.0])

    def measures(self, texts: Iterator[str]) -> np.ndarray:
        """Per text: difference per compressed byte, difference per raw byte, good size per raw byte."""
        import zstandard

        bad, good = (
            zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d) if d else None).compress
            for d in (self.bad, self.good)
        )
        rows = []
        for text in texts:
            raw = with_bad = with_good = 0
            for piece in _pieces(text):
                raw += len(piece)
                with_bad += len(bad(piece))
                with_good += len(good(piece))
            rows.append(
                ((with_bad - with_good) / max(1, with_bad + with_good), (with_bad - with_good) / max(1, raw), with_good / max(1, raw))
            )
        return np.array(rows).reshape(-1, 3)

    def probabilities(self, measures: np.ndarray) -> np.ndarray:
        x = (measures - self.centre) / self.scale @ np.array(self.weights[:-1]) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def fit_curve(self, measures: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        """Newton steps of a slightly damped logistic fit."""
        self.centre, self.scale = measures.mean(0).tolist(), (measures.std(0) + 1e-9).tolist()
        x = np.c_[(measures - self.centre) / self.scale, np.ones(len(measures))]
        damp = 1e-2 * np.diag([1.0, 1.0, 1.0, 0.01])
        w = np.zeros(4)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (weights * (labels - p)) - damp @ w
            w = w + np.linalg.solve(x.T @ (x * (weights * p * (1 - p))[:, None]) + damp + 1e-9 * np.eye(4), slope)
        self.weights = w.tolist()


def train(documents: DataFrame, labels: DataFrame, learn: Column, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Dictionaries from three folds of the sample, the curve from the other one. ``learn`` is a condition on doc_id."""
    rows, counts = sample(documents, labels, "quality", learn, sample_rows)
    model = QualityModel()
    if min(counts.get(0, 0), counts.get(1, 0)) == 0:
        model.weights[-1] = 3.0 * (bool(counts.get(1)) - bool(counts.get(0)))
        return model

    def some_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pieces = _pieces(text)
                step = max(1, -(-len(pieces) // PIECES_PER_ROW))
                out += [(label, piece) for piece in pieces[::step]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([label for label, _ in out], pa.int32()), pa.array([piece for _, piece in out], pa.binary())],
                names=["label", "piece"],
            )

    learned = rows.filter("fold > 0").select("label", "text").mapInArrow(some_pieces, "label int, piece binary")
    both: tuple[list[bytes], list[bytes]] = ([], [])
    for label, piece in sorted((row["label"], bytes(row["piece"])) for row in learned.toLocalIterator()):
        both[label].append(piece)
    model.bad, model.good = map(build_dictionary, both)
    curve = rows.filter("fold = 0")
    if curve.select("label").distinct().count() < 2:  # a handful of labels
        curve = rows
    fitted = curve.select("doc_id", "label", "text").mapInArrow(
        _measured(model), "doc_id long, label int, a double, b double, c double"
    ).toPandas().sort_values(["doc_id", "label", "a", "b"])
    y = fitted["label"].to_numpy(float)
    share = {v: counts[v] / max(1, (y == v).sum()) for v in (0, 1)}
    weights = np.where(y == 1, share[1], share[0])
    model.fit_curve(fitted[["a", "b", "c"]].to_numpy(), y, weights * len(y) / weights.sum())
    return model


def _measured(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = model.measures(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, m.T.copy())], names=["doc_id", "label", "a", "b", "c"]
            )

    return run


def score(documents: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """``documents`` with ``score``: the chance that a text is good, from its whole text alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (value.as_py() or "" for value in batch.column(last))
            scores = pa.array(model.probabilities(model.measures(texts)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], scores], names=[*names, "score"])

    kept = documents.drop("score")
    last, names = len(kept.columns), kept.columns
    schema = kept.withColumn("score", F.lit(0.0)).schema
    return kept.withColumn("__text", text_column(documents, text)).mapInArrow(run, schema)
