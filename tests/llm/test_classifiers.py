import copy
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import SF
from tests.llm.conftest import words

from tidemark.llm import catalog, labelled, quality, toxicity



def every_row():
    return F.lit(True)


def auc(scores, labels):
    rank = scores.rank().to_numpy()
    n1, n0 = labels.sum(), (1 - labels).sum()
    return (rank[labels == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


@pytest.mark.parametrize(("name", "label", "least"), [("op1_quality", "quality", 0.95), ("op8_toxicity", "toxic", 0.9)])
def test_held_out_rows_are_told_apart(shared, name, label, least):
    folder = SF.replace("0.001", "0.1")
    scored = catalog.QUERIES[name](shared, folder).toPandas()
    labels = shared.read.parquet(f"{folder}/labels.parquet").toPandas()
    assert scored.score.between(0, 1).all() and scored.doc_id.is_unique and len(scored) == 10_000
    cut = {"op1_quality": 0.3, "op8_toxicity": 0.7}[name]
    assert ((scored.score >= cut).astype(int) == scored.predicted).all()
    both = scored[scored.held_out].merge(labels, on="doc_id")
    assert auc(both.score, both[label].to_numpy()) > least


@pytest.mark.parametrize("module", [quality, toxicity])
def test_awkward_rows(documents, no_documents, module):
    labels = documents.sparkSession.createDataFrame(
        [(i, int(i % 2), int(i % 2)) for i in range(1, 12)] + [(3, None, None), (None, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    model = module.train(documents, labels, every_row())
    clashing = documents.withColumnsRenamed({"lang": "score", "n_chars": "label"})
    rows = module.score(clashing, model).collect()
    assert len(rows) == documents.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert module.score(no_documents, model).count() == 0
    again = {(r["doc_id"], r["text"]): r["score"] for r in module.score(documents.repartition(4), model).collect()}
    assert all(abs(again[r["doc_id"], r["text"]] - r["score"]) < 1e-6 for r in rows)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_too_few_labels(documents, no_documents, module):
    spark = documents.sparkSession
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in module.score(documents, module.train(documents, none, every_row())).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert all(r["score"] > 0.5 for r in module.score(documents, module.train(documents, one, every_row())).collect())
    assert module.train(no_documents, none, every_row()) is not None


def test_labels_outside_the_condition_are_not_learned(shared):
    rows = [(i, words(i, 30).upper() if i % 2 else words(i, 30)) for i in range(60)]
    docs = shared.createDataFrame(rows, "doc_id long, text string")
    right = shared.createDataFrame([(i, 1 - i % 2, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    wrong = shared.createDataFrame([(i, 1 - i % 2 if i < 40 else i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    learn = F.col("doc_id") < 40
    one, other = (quality.score(docs, quality.train(docs, labels, learn)).orderBy("doc_id").toPandas().score for labels in (right, wrong))
    assert np.allclose(one, other)


def test_an_id_with_many_texts_is_one_row_of_the_sample(shared):
    docs = shared.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "other")], "doc_id long, text string")
    labels = shared.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    rows, counts = labelled.sample(docs, labels, "quality", every_row(), 10)
    assert sorted(r["doc_id"] for r in rows.collect()) == [1, 2] and counts == {0: 1, 1: 1}


def test_network_against_loops():
    rng = np.random.default_rng(1)
    model = toxicity.ToxicityModel(places=np.arange(9))
    model.embeddings = rng.normal(size=(10, toxicity.DIM)).astype(np.float32)
    model.embeddings[0] = 0
    model.filters = [rng.normal(size=f.shape).astype(np.float32) for f in model.filters]
    model.bias = [rng.normal(size=b.shape).astype(np.float32) for b in model.bias]
    model.out = rng.normal(size=model.out.shape).astype(np.float32)
    texts = [rng.integers(0, 10, n) for n in (7, 0, 1, 2, 40)]
    for text, z in zip(texts, model.logits(texts), strict=True):
        padded, answers = [*text.tolist(), *[0] * 4], []
        for filters, bias in zip(model.filters, model.bias, strict=True):
            for f in range(toxicity.FILTERS):
                seen = [
                    sum(float(model.embeddings[padded[at + k]] @ filters[k][:, f]) for k in range(len(filters))) + bias[f]
                    for at in range(max(1, len(text)))
                ]
                answers.append(max(0.0, *seen))
        assert abs(float(np.dot(answers, model.out)) + model.shift - z) < 1e-3


def test_network_gradient():
    """One step lowers the loss of its own batch."""
    rng = np.random.default_rng(0)
    model = toxicity.ToxicityModel(places=np.arange(20))
    model.embeddings = rng.normal(size=(21, toxicity.DIM)).astype(np.float32)
    model.embeddings[0] = 0
    model.filters = [rng.normal(size=f.shape).astype(np.float32) for f in model.filters]
    model.out = rng.normal(size=model.out.shape).astype(np.float32) * 0.1
    texts = [rng.integers(0, 21, n) for n in (5, 1, 0, 9, 30)]
    labels, weights = np.array([1, 0, 1, 0, 1], np.float32), np.ones(5, np.float32)
    step = toxicity._Adam(model, rate=0.003)
    losses = [model.step(texts, labels, weights, step) for _ in range(40)]
    assert losses[-1] < losses[0]
    alone = np.concatenate([model.logits([t]) for t in texts])
    assert np.allclose(alone, model.logits(texts), atol=1e-4)


def test_every_labelled_row_is_learned(shared):
    """3 000 rows of either class, every word in two texts: all words of the training folds are known, none by a sample."""
    rows = [(i, f"common w{i // 4} " + ("bad" if i % 2 else "good"), i % 2) for i in range(6_000)]
    docs = shared.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    model = toxicity.train(docs, docs, every_row(), epochs=1, part_rows=1_000)
    folds = labelled.every(docs, docs, "toxic", every_row())[0].filter("fold > 0").collect()
    uses = Counter(place for row in folds for place in {toxicity.bucket(w) for w in row["text"].split()})
    assert set(model.places.tolist()) == {place for place, n in uses.items() if n >= 2} and len(model.places) > 1_200
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert all((scored[i] >= toxicity.DECISION) == bool(label) for i, _, label in rows)


def test_a_round_averages_its_parts(shared):
    rng, model = np.random.default_rng(3), toxicity.ToxicityModel(places=np.arange(0, 60, 2))
    model.embeddings = rng.normal(size=(31, toxicity.DIM)).astype(np.float32)
    model.embeddings[0] = 0
    model.filters = [rng.normal(size=f.shape).astype(np.float32) for f in model.filters]
    model.out = rng.normal(size=model.out.shape).astype(np.float32)
    rows = [(part, int(rng.integers(2)), rng.integers(20 * part, 20 * part + 30, n)) for part in range(2) for n in (5, 1, 0, 9, 30)]
    before = model.embeddings.copy()
    sums, layers = {}, 0
    for part in range(2):
        own = copy.deepcopy(model)
        labels = np.array([label for p, label, _ in rows if p == part], np.float32)
        texts = [np.array([p // 2 + 1 if p % 2 == 0 else 0 for p in words.tolist()], int) for p, _, words in rows if p == part]
        own.fit(texts, labels, np.where(labels == 1, 2.0, 0.5).astype(np.float32), 3, 7 + part)
        layers = layers + toxicity._layers(own) / 2
        for row in {row for text in texts for row in text.tolist()} - {0}:
            n = sum(row in text for text in texts)
            total, value = sums.get(row, (0, 0.0))
            sums[row] = total + n, value + n * own.embeddings[row].astype(float)
    parts = shared.createDataFrame(
        [(p, label, words.astype("<u4").tobytes()) for p, label, words in rows], "part int, label int, words binary"
    ).repartition(2, "part")
    toxicity._round(model, parts, len(rows), (0.5, 2.0), 3, 7)
    assert np.allclose(toxicity._layers(model), layers, atol=1e-5)
    for row in range(31):
        n, value = sums.get(row, (1, before[row]))
        assert np.allclose(model.embeddings[row], value / n, atol=1e-5)


def test_threshold_has_the_best_f1():
    rng = np.random.default_rng(5)
    for size in (1, 2, 30, 400):
        z = np.unique(rng.normal(size=size).round(2))
        hit, clean = rng.integers(0, 3, len(z)), rng.integers(0, 3, len(z))
        hit[-1] += 1
        limit = toxicity.threshold(z, z, hit, hit + clean)
        f1 = [2 * hit[z >= cut].sum() / ((hit + clean)[z >= cut].sum() + hit.sum()) for cut in (*z, limit)]
        assert f1[-1] == max(f1) and limit not in z
