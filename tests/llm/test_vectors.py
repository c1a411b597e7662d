import math
import random

import numpy as np
import pytest

from tidemark.llm import top_k, vector_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(count=260, width=12, seed=3):
    rng = random.Random(seed)
    rows, base = [], [rng.gauss(0, 1) for _ in range(width)]
    for i in range(count):
        if i % 4 == 1:  # a dense group
            v = [x + rng.gauss(0, 0.08) for x in base]
        elif i % 10 == 2:  # equal vectors
            v = base
        else:
            v = [rng.gauss(0, 1) for _ in range(width)]
        rows.append((i, [float(np.float32(x)) for x in v], i % 3))
    rows += [
        (1000, None, 1), (1001, [], 1), (1002, [0.0] * width, 1), (1003, [None] + [1.0] * (width - 1), 1),
        (1004, [math.nan] + [1.0] * (width - 1), 1), (1005, [math.inf] + [1.0] * (width - 1), 1),
        (None, rows[0][1], 1), (1006, rows[0][1][:5], 2), (1100, rows[0][1], 2), (1100, rows[0][1], 2),
    ]
    return rows


def fits(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def test_top_k_against_brute_force(shared):
    rows = vectors()
    df = shared.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "score")
    mine = sorted(map(tuple, top_k.top_k(df, every=20, k=7).collect()))
    whole = {i: [math.floor(1024 * x) for x in v] for i, v, _ in rows if i is not None and fits(v)}
    want = []
    for q in whole:
        if q % 20 == 0:
            score = lambda o, q=q: sum(a * b for a, b in zip(whole[q], whole[o], strict=False))
            best = sorted((-score(o), o) for o in whole if o != q)[:7]
            want += [(q, r, o, -s) for r, (s, o) in enumerate(best, 1)]
    assert mine == sorted(want)


def test_top_k_many_blocks_and_large_values(shared, monkeypatch):
    monkeypatch.setattr(top_k, "CHUNK_ROWS", 40)
    monkeypatch.setattr(top_k, "BLOCK_QUERIES", 2)
    test_top_k_against_brute_force(shared)
    big = shared.createDataFrame([(0, [1e6, 1e6]), (1, [1e6, 2e6]), (2, [1e30, 1.0])], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r["score"] for r in top_k.top_k(big).collect()}
    assert found == {1: 1024 * 10**6 * 1024 * 3 * 10**6, 2: 2**63 - 1}
    assert top_k.top_k(shared.createDataFrame([], SCHEMA)).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, y = rng.integers(-900, 900, (50, 13)).astype(float), rng.integers(-900, 900, (40, 13)).astype(float)
    for segments in (1, 4, 16):
        bound = top_k.statistics(x, segments) @ top_k.statistics(y, segments).T
        assert (bound + 1e-6 >= x @ y.T).all()


def expected_links(rows, cosine):
    known = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and fits(v) and len(v) and any(v)]
    width = max(len(v) for _, v in known)
    x = np.stack([np.pad(v, (0, width - len(v))) for _, v in known])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= cosine
    links = near.sum(1) - 1
    label = np.array([i for i, _ in known])
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    return sorted(zip([i for i, _ in known], links.tolist(), label.tolist(), strict=True))


@pytest.mark.parametrize(("window", "passes"), [(1024, 2), (64, 16)])
def test_links_against_brute_force(shared, window, passes):
    rows = vectors()
    df = shared.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "rep")
    found = vector_dedup.near_duplicates(df, window=window, passes=passes).collect()
    assert len(found) == len(rows)
    alone = {1000, 1001, 1002, 1003, 1004, 1005, None}
    assert all(r["n_links"] == 0 and r["kept"] for r in found if r["vec_id"] in alone)
    mine = sorted(tuple(r)[:3] for r in found if r["vec_id"] not in alone)
    want = expected_links(rows, 0.95)
    assert [m[2] for m in mine] == [w[2] for w in want]
    total, all_ = sum(m[1] for m in mine), sum(w[1] for w in want)
    assert all(m[1] <= w[1] for m, w in zip(mine, want, strict=True)) and total >= 0.98 * all_
    if window == 1024:
        assert total == all_


def test_dense_group_of_many_windows(shared, monkeypatch):
    """Every link of 500 different vectors, over 15 windows and several blocks large; and a pair at the limit."""
    monkeypatch.setattr(vector_dedup, "BLOCK_ROWS", 60, raising=False)
    rng = np.random.default_rng(5)
    base = rng.normal(size=24)
    x = np.concatenate([base + 0.06 * rng.normal(size=(500, 24)), rng.normal(size=(300, 24))])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    df = shared.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = sorted(tuple(r)[:3] for r in vector_dedup.near_duplicates(df, window=32).collect())
    assert found == expected_links(rows, 0.95)


@pytest.mark.parametrize("window", [1024, 8])
def test_one_id_with_different_vectors(shared, window):
    """Linked rows of one id, rows of one id in two components, and one that is alone."""
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=(2, 10))
    ids = [7, 7, 8, 7, 7, 9, 5, 5, 5] + list(range(20, 60))
    x = [a, a + 0.01, a + 0.02, b, b + 0.01, b + 0.02, b, rng.normal(size=10), a + 0.01, *rng.normal(size=(40, 10))]
    rows = [(i, v.tolist(), 0) for i, v in zip(ids, x, strict=True)]
    df = shared.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = vector_dedup.near_duplicates(df, window=window).collect()
    assert sorted(tuple(r)[:3] for r in found) == expected_links(rows, 0.95)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def test_sorted_windows_and_open_regions(shared, monkeypatch):
    """Windows alone settle a table with no region longer than one; a dense group is finished by its region; no pair counts twice."""
    monkeypatch.setattr(vector_dedup, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(11)
    spread = rng.normal(size=(300, 24))
    twins = spread + 0.02 * rng.normal(size=(300, 24))
    dense = rng.normal(size=24) + 0.05 * rng.normal(size=(150, 24))

    def steps(x):
        rows = [(i, 1, v.tolist()) for i, v in enumerate(x)]
        classes = shared.createDataFrame(rows, "rep long, copies long, v array<double>")
        found = vector_dedup.links_found(classes, window=32).groupBy("step").sum("links").collect()
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return dict(map(tuple, found)), int((unit @ unit.T >= 0.95).sum()) - len(x)

    found, want = steps(np.concatenate([spread, twins]))
    assert sum(found.values()) == want and found["window"] > 0.9 * want
    found, want = steps(np.concatenate([spread, dense]))
    assert sum(found.values()) == want and found["window"] > 0 and found["region"] > 0


def test_places_follow_the_codes(shared):
    rows = [(i, [(i * 7919) % 1009 << 40, (i * 31) % 50 << 50]) for i in range(500)]
    coded = shared.createDataFrame(rows, "rep long, codes array<long>")
    at = vector_dedup._places(coded, 500, 10).collect()
    for p in (0, 1):
        order = sorted((c[p], i) for i, c in rows)
        assert sorted((r["place"], r["rep"]) for r in at if r["pass"] == p) == [(n, i) for n, (_, i) in enumerate(order)]
        assert all(r["region"] == rows[r["rep"]][1][p] >> 52 for r in at if r["pass"] == p)


def test_passes_keep_the_miss_bound():
    for classes in (10**3, 10**5, 10**7, 10**9):
        bits, passes = vector_dedup.plan(classes, 0.95)
        met = (1 - math.acos(0.95) / math.pi) ** bits
        assert classes / 2**bits <= vector_dedup.WINDOW and (1 - met) ** passes <= vector_dedup.MISS


def test_no_vectors(shared):
    assert vector_dedup.near_duplicates(shared.createDataFrame([], SCHEMA)).count() == 0


def test_components(shared):
    from tidemark.llm.components import components

    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1200)] + [(2000, 2000 + i) for i in range(1, 300)]
    found = {r["node"]: r["component"] for r in components(shared.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    assert found == {n: root(n) for n in parent if any(n in e and e[0] != e[1] for e in edges)}
    assert components(shared.createDataFrame([], "a long, b long")).count() == 0


def test_top_k_keeps_rows_that_repeat_an_id(shared):
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (1, [0.5, 0.5]), (2, [0.1, 0.1])]
    found = top_k.top_k(shared.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in found] == [(1, 1, 921 * 1024), (2, 1, 512 * 1024), (3, 2, 102 * 1024)]
    twice = [(100, [1.0]), (100, [2.0]), (3, [1.0])]
    found = top_k.top_k(shared.createDataFrame(twice, "vec_id long, embedding array<double>"), factor=1).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found) == [
        (100, 1, 3, 2), (100, 1, 100, 2), (100, 2, 3, 1), (100, 2, 100, 2)
    ]
