import re
from collections import defaultdict

from tests.llm.conftest import document_rows

from tidemark.llm import mixing


def expected_targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    """Resharing round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= most * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = float(most * sizes[s])
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def check(rows, documents, slack):
    sizes, biggest = defaultdict(int), defaultdict(int)
    for _, text, _, source, _ in documents:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] += n
        biggest[source] = max(biggest[source], n)
    target = expected_targets(sizes)
    assert len(rows) == len(documents)
    taken = defaultdict(int)
    for row in rows:
        assert row["source_size"] == sizes[row["source"]]
        assert abs(row["target"] - target[row["source"]]) <= 1e-6 * max(1, target[row["source"]])
        assert row["taken"] == row["copies"] * row["size"] and 0 <= row["copies"] <= 3
        taken[row["source"]] += row["taken"]
    for source, words in taken.items():
        assert abs(words - target[source]) <= slack * max(1, biggest[source])


def test_awkward_rows(documents, no_documents):
    rows = mixing.mix(documents.withColumnRenamed("lang", "share")).collect()
    check(rows, document_rows(), 1)
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mix(no_documents).count() == 0


def test_many_rows_one_hot_source(shared):
    rows = [(i, " ".join("w" * (1 + i % 5) for _ in range(1 + i * 7 % 90)), None, "hot" if i % 3 == 0 else f"s{i % 7}", 0) for i in range(1500)]
    rows += [(3000, "one repeated row", None, "hot", 0)] * 200
    df = shared.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = mixing.mix(df, block_rows=8).collect()
    check(found, rows, 1)
    again = mixing.mix(df.repartition(5), block_rows=8).collect()
    key = lambda r: (r["doc_id"], r["nr"])
    assert [r["copies"] for r in sorted(found, key=key)] == [r["copies"] for r in sorted(again, key=key)]


def test_expected_copies(shared):
    """Over many documents of one size the share taken follows the target."""
    rows = [(i, "a b c d", None, "x" if i < 400 else "y", 0) for i in range(1000)]
    df = shared.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    check(mixing.mix(df).collect(), rows, 1)
