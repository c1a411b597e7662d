"""Filters in all orders against a plain application of each order."""

import re
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import words
from tidemark.llm import filter_audit as A

LABELS = "doc_id long, quality int, toxic int"


def fails(text, smaller):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(found) < 50,
        "B": 100 * len(set(found)) < 65 * len(found),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": text in smaller,
    }


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for doc_id, text, source in docs:
        smaller = {t or "" for i, t, _ in docs if i is not None and doc_id is not None and i < doc_id}
        rows.append((doc_id, source or "", fails(text or "", smaller)))
    out = {}
    for part in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == part]
        shares = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[2][f]]
                left = [r for r in left if not r[2][f]]
                failing = [r for r in mine if r[2][f]]
                shares[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(sum(r[2].values()) == 1 for r in failing),
                    sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone),
                ]
        for (p, order, step), held in out.items():
            if p == part:
                held.append(shares[order[step - 1]])
    return out


def result(df):
    return {
        (r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
        for r in df.collect()
    }


def docs_and_labels():
    long = words(3, 60)
    docs = [
        (1, long, "a"), (2, long, "a"), (3, long + " #", "b"), (4, long.upper(), None), (5, "one two", "b"),
        (6, None, "a"), (7, "", "a"), (7, "", "a"), (None, long, "a"), (None, "", "c"), (8, "go " * 80, "b"),
        (9, "go " * 80 + "$", "b"), (9, long, "a"), (10, long + " " + long, "\U0001f600"), (11, "É" * 10 + " A", "b"),
        (12, "\x1c ".join(words(9, 70).split()), "a"), (2, words(5, 90), "b"),
    ]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (8, None, None), (5, 1, 1), (None, 1, 1), (99, 1, 1), (7, 1, 0)]
    return docs, labels


def test_against_every_order(shared):
    docs, labels = docs_and_labels()
    df = shared.createDataFrame(docs, "doc_id long, text string, source string")
    df = df.withColumns({c: F.lit("x") for c in ("mask", "part", "key", "n", "good", "quality", "toxic", "__id")})
    found = result(A.audit(df, shared.createDataFrame(labels, LABELS)))
    assert found == brute(docs, labels)
    assert len(found) == 600 * 5


def test_empty_table(shared, no_documents):
    labels = shared.createDataFrame([], LABELS)
    assert A.audit(no_documents, labels).count() == 0
    docs = shared.createDataFrame([(1, "x", "a")], "doc_id long, text string, source string")
    assert A.audit(docs, labels).count() == 600


def test_the_walk_toggles_to_the_right_states():
    counts = np.random.default_rng(2).integers(0, 50, (3, 32, 2))
    states = A.walk(counts)
    for subset in range(32):
        alive = [m for m in range(32) if not m & subset]
        assert (states[:, subset] == counts[:, alive].sum(1)).all()


def test_long_texts_are_read_in_blocks():
    raw = (words(4, 5000) + " AB#").encode()
    whole = A.failures(raw)
    pieces = list(A.blocks(raw, 100))
    assert len(pieces) > 100 and b"".join(pieces) == raw
    assert sum(len(p.split()) for p in pieces) == len(raw.split())
    assert whole == A.failures(b"".join(pieces))
