import hashlib
import random

import numpy as np
import pytest
from tests.llm.conftest import DOCUMENTS, document_rows, words

from tidemark.llm import passage_dedup, text_dedup


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def expected_components(rows, percent=85):
    sets = [(r[0], shingles(r[1])) for r in rows if r[0] is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets)


def family(seed, copies, changes):
    """A text and copies with some words changed: near the limit to the text, further from each other."""
    rng = random.Random(seed)
    base = words(seed, 150).split()
    out = [" ".join(base)]
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(*changes)):
            w[rng.randrange(len(w))] = "x" + str(rng.random())[2:8]
        out.append(" ".join(w))
    rng.shuffle(out)
    return out


def near_rows():
    texts = family(1, 40, (1, 4)) + family(2, 30, (2, 6)) + [words(s, 60) for s in range(100, 130)]
    chain = words(50, 200).split()
    for k in range(12):  # every one near the next, the ends far apart
        chain = chain[2:] + words(900 + k, 2).split()
        texts.append(" ".join(chain))
    return [(i * 3 + 20, t, "en", "a", 1) for i, t in enumerate(texts)]


def test_trees_follow_the_limit():
    assert [text_dedup.trees(p) for p in (100, 99, 85, 80)] == [3, 4, 16, 22]
    for percent in (50, 70, 80, 85, 95):
        assert (1 - (percent / 100) ** 4) ** text_dedup.trees(percent) <= 1e-5


@pytest.mark.parametrize(("block", "percent"), [(256, 85), (4, 85), (256, 80), (256, 60)])
def test_components_against_brute_force(shared, monkeypatch, block, percent):
    monkeypatch.setattr(text_dedup, "BLOCK_ROWS", block)
    rows = near_rows() + document_rows()
    found = text_dedup.near_duplicates(shared.createDataFrame(rows, DOCUMENTS).withColumnRenamed("lang", "node"), percent=percent).collect()
    assert len(found) == len(rows)
    mine = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found if r["doc_id"] is not None)
    assert mine == expected_components(rows, percent)
    assert all(r["kept"] and r["component_id"] is None for r in found if r["doc_id"] is None)


def test_no_documents(no_documents):
    assert text_dedup.near_duplicates(no_documents).count() == 0
    assert passage_dedup.remove_passages(no_documents).count() == 0


def test_shared_counts():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (1, 500, 4000, 4000, 7)]
    assert text_dedup.shared_counts(sets).tolist() == [
        [len(np.intersect1d(a, b)) if i != j else int(sum((a == x).any() for s, c in enumerate(sets) if s != i for x in ()) or c_(sets, i)) for j, b in enumerate(sets)]
        for i, a in enumerate(sets)
    ]


def c_(sets, i):
    """On the diagonal: the shingles that some other set has too."""
    others = np.concatenate([s for k, s in enumerate(sets) if k != i])
    return int(np.isin(sets[i], others).sum())


# Passages


def expected_cut(rows, length=50):
    first = {}
    for doc, text, *_ in rows:
        if doc is not None:
            raw = (text or "").encode()
            for i in range(len(raw) - length + 1):
                s = raw[i : i + length]
                first[s] = min(first.get(s, doc), doc)
    out = []
    for doc, text, *_ in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if doc is not None and first[raw[i : i + length]] < doc:
                gone[i : i + length] = True
        kept = bytes(c for c, g in zip(raw, gone, strict=False) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((-1 if doc is None else doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def passage_rows():
    rng = random.Random(8)
    parts = [words(s, 14) for s in range(12)]
    rows = list(document_rows())
    for i in range(60):
        body = [words(5000 + i, rng.randint(1, 40)), rng.choice(parts), words(6000 + i, 3), rng.choice(parts)[rng.randint(0, 30) :]]
        rows.append((rng.randint(100, 140), " ".join(body), "en", "a", 1))
    rows.append((150, "ab" * 400, "en", "a", 1))
    rows.append((149, "ba" * 300 + "c" * 200, "en", "a", 1))
    rows.append((151, "é" * 120, "en", "a", 1))
    rows.append((152, "x" + "é" * 120, "en", "a", 1))
    return rows


@pytest.mark.parametrize(("crowded", "bucket", "segment"), [(20_000, 4_000, 1 << 19), (3, 10, 1 << 19), (20_000, 5, 300)])
def test_passages_against_brute_force(shared, monkeypatch, crowded, bucket, segment):
    monkeypatch.setattr(passage_dedup, "_SEGMENT", segment)
    rows = passage_rows()
    docs = shared.createDataFrame(rows, DOCUMENTS).withColumnRenamed("n_chars", "start").repartition(3)
    ranges = passage_dedup.repeated_ranges
    monkeypatch.setattr(passage_dedup, "repeated_ranges", lambda d, t, c: ranges(d, t, c, bucket))
    left = passage_dedup.remove_passages(docs, crowded=crowded).collect()
    mine = sorted(
        (-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept_bytes"]).hexdigest())
        for r in left
    )
    assert mine == expected_cut(rows)


def test_texts_of_one_id_stay_apart(shared):
    """Two texts of one id whose hashes agree in their last 20 bits; each has a passage of another document."""
    import xxhash

    one, two, mask = words(70, 30), words(71, 30), (1 << 20) - 1
    low = {xxhash.xxh64_intdigest(t, seed=42) & mask: t for t in (f"{words(72, 20)} {one[5:]} {i}" for i in range(4000))}
    pairs = ((low.get(xxhash.xxh64_intdigest(t, seed=42) & mask), t) for t in (f"{i} {two[9:]} {words(73, 40)}" for i in range(4000)))
    a, b = next(pair for pair in pairs if pair[0])
    rows = [(1, one), (2, "x" + two), (5, a), (5, b), (6, a[20:]), (7, "y" + b[9:])]
    left = passage_dedup.remove_passages(shared.createDataFrame(rows, "doc_id long, text string")).collect()
    mine = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept_bytes"]).hexdigest()) for r in left)
    assert mine == expected_cut(rows)


def test_kept_text_is_valid(shared):
    docs = shared.createDataFrame([(1, "é" * 40), (2, "a" + "é" * 40 + "b")], "doc_id long, text string")
    rows = {r["doc_id"]: r["kept_text"] for r in passage_dedup.remove_passages(docs, as_text=True).collect()}
    assert rows == {1: "é" * 40, 2: "ab"}


def test_run_length_index_walks_every_context():
    rng = random.Random(4)
    contexts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(5, 40))) for _ in range(80)]
    owners = np.array([rng.randrange(20) for _ in contexts])
    index = passage_dedup.RunLengthIndex(contexts, owners, length=5)
    seen = {}
    for c, p, w in index.stream():
        for one, place, owner in zip(c.tolist(), p.tolist(), w.tolist(), strict=True):
            seen[one, place] = owner
    want = {}
    for i, c in enumerate(contexts):
        for p in range(len(c) - 4):
            want[i, p] = min(int(owners[j]) for j, d in enumerate(contexts) if c[p : p + 5] in d)
    assert seen == want
    assert len(index.starts) < sum(len(c) + 1 for c in contexts) and len(index.samples) == len(index.starts)


def test_runs_do_not_depend_on_batches():
    rng = np.random.default_rng(6)
    rows = np.unique(np.stack([rng.integers(0, 12, 600), rng.integers(0, 3, 600), rng.integers(0, 9, 600), rng.integers(0, 4, 600)], 1), axis=0)
    found = set()
    for size in (1, 2, 3, 7, 600):
        runs, out = passage_dedup._Runs(), []
        for low in range(0, len(rows), size):
            part = rows[low : low + size]
            out += list(zip(*(c.tolist() for c in runs.feed(*part.T.copy())), strict=True))
        found.add(tuple(sorted(out)))
    assert len(found) == 1
    by_gram = {}
    for g, c, d, _ in rows.tolist():
        by_gram.setdefault(g, {}).setdefault(c, []).append(d)
    want = []
    for g, c, d, i in rows.tolist():
        if d > min(by_gram[g][c]):
            want.append((g, d, i, False))
        elif len(by_gram[g]) > 1:
            want.append((g, d, i, True))
    assert found.pop() == tuple(sorted(want))
