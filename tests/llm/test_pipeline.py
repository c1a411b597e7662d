"""The stages against brute force, each on its own input."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import DOCUMENTS, document_rows, words
from tests.llm.test_mixing import expected_targets
from tests.llm.test_text_dedup import expected_components, near_rows, passage_rows

import corpus_pipeline
from tidemark.llm import quality
from tidemark.llm.labelled import remainder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(shared, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    rows = near_rows() + document_rows() + [(1000 + i, words(i, 60).upper() + " !!", "en", "junk", 1) for i in range(40)]
    shared.createDataFrame(rows, DOCUMENTS).write.parquet(f"{root}/documents.parquet")
    labels = [(r[0], int(r[0] < 1000), 0) for r in rows if r[0] is not None and r[0] >= 20]
    shared.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def test_quality_stage(shared, folder):
    docs = shared.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.keep_quality(shared, docs.withColumn("score", F.lit("clash")), folder)
    assert out.columns == [*COLUMNS, "score"]
    learn = F.coalesce(remainder(F.col("doc_id"), 5) != 0, F.lit(False))
    model = quality.train(docs, shared.read.parquet(f"{folder}/labels.parquet"), learn)
    rows = docs.collect()
    keep = [r for r, p in zip(rows, model.probabilities(model.measures([r["text"] or "" for r in rows])), strict=True) if p >= 0.3]
    assert Counter(map(tuple, out.select(*COLUMNS).collect())) == Counter(map(tuple, keep))
    clean = [r for r in rows if r["doc_id"] is not None and 20 <= r["doc_id"] < 1000]
    kept = {r["doc_id"] for r in out.collect()}
    assert sum(r["doc_id"] in kept for r in clean) >= 0.95 * len(clean)
    assert sum(i >= 1000 for i in kept if i is not None) <= 4


def test_near_duplicate_stage(shared, folder):
    rows = near_rows() + document_rows() + [(13, words(77, 40), "en", "b", 1)]
    # One word of sixty changed: 51 of 61 shingles are shared, 0.836.
    close = words(78, 60).split()
    rows += [(2000, " ".join(close), "en", "b", 1), (2001, " ".join([*close[:30], "changed", *close[31:]]), "en", "b", 1)]
    docs = shared.createDataFrame(rows, DOCUMENTS)
    out = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(shared, docs, folder).collect()]
    assert not Counter(out) - Counter(rows)
    without_words = [r for r in rows if r[0] is None or not (r[1] or "").split()]
    assert Counter(r for r in out if r in without_words) == Counter(without_words)
    groups = {m[2] for m in expected_components([r for r in rows if (r[1] or "").split() and r[0] is not None], 80)}
    assert 2000 in groups and 2001 not in groups
    left = [r for r in out if r not in without_words]
    assert {r[0] for r in left} == groups
    # Two rows of id 13 are equal, the third has another text and is a group of its own.
    assert sorted(r[0] for r in left) == sorted([*groups, 13])


def test_passage_stage(shared, folder):
    rows = [r for r in passage_rows() if r[0] is None or r[0] not in (12, 13)]
    docs = shared.createDataFrame(rows, DOCUMENTS)
    out = corpus_pipeline.cut_passages(shared, docs, folder)
    assert out.columns == COLUMNS and out.count() == len(rows)
    first = {}
    for doc, text, *_ in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - 49):
            if doc is not None:
                first[raw[i : i + 50]] = min(first.get(raw[i : i + 50], doc), doc)
    want = Counter()
    for doc, text, lang, source, n in rows:
        raw = (text or "").encode()
        gone = set()
        for i in range(len(raw) - 49):
            if doc is not None and first[raw[i : i + 50]] < doc:
                gone.update(range(i, i + 50))
        if gone:
            text = bytes(c for i, c in enumerate(raw) if i not in gone).decode("utf-8", "ignore")
            n = len(text)
        want[doc, text, lang, source, n] += 1
    assert Counter(map(tuple, out.collect())) == want


def test_mix_stage(shared, folder):
    rows = near_rows() + document_rows() + [(500, "a b c", "en", "hot", 1)] * 30
    docs = shared.createDataFrame(rows, DOCUMENTS)
    out = [tuple(r) for r in corpus_pipeline.mix_sources(shared, docs, folder).collect()]
    there, taken = Counter(rows), Counter(out)
    assert all(taken[r] <= 3 * there[r] for r in taken) and not set(taken) - set(there)
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    sizes, words_taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r)
        largest[r[3]] = max(largest[r[3]], size(r))
    for r in out:
        words_taken[r[3]] += size(r)
    for source, target in expected_targets(sizes).items():
        assert abs(words_taken[source] - target) <= largest[source]
    again = corpus_pipeline.mix_sources(shared, docs.repartition(4), folder)
    assert Counter(map(tuple, again.collect())) == taken


def test_whole_run_and_no_rows(shared, folder, tmp_path):
    out = corpus_pipeline.pipeline(shared, folder).collect()
    assert out and len({r["sequence_id"] for r in out}) == len(out)
    assert all(r["length"] & (r["length"] - 1) == 0 and r["length"] <= 2048 for r in out)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    shared.createDataFrame([], DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    shared.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.pipeline(shared, str(tmp_path)).count() == 0


def test_columns_named_like_results_pass_through(shared):
    text = " ".join(f"word{i}" for i in range(40))
    docs = shared.createDataFrame(
        [(1, text, "en", "a", 1, "x", "y", "z"), (2, text + " end", "en", "a", 1, "u", "v", "w")],
        "doc_id long, text string, lang string, source string, n_chars long, n_removed string, n_bytes string, kept_text string",
    )
    out = {r["doc_id"]: r for r in corpus_pipeline.cut_passages(shared, docs, "").collect()}
    assert list(out[1].asDict()) == docs.columns
    assert out[1]["text"] == text and out[2]["text"] == " end"
    assert (out[2]["n_removed"], out[2]["n_bytes"], out[2]["kept_text"]) == ("u", "v", "w")
