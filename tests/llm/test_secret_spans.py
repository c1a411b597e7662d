"""Secrets: patterns against a plain reading, tags against a search over whole texts."""

import hashlib
import random

import numpy as np
import pytest

from tests.conftest import SF
from tests.llm.conftest import words
from tidemark.llm import catalog
from tidemark.llm import secret_spans as S


@pytest.fixture(scope="module")
def model(shared):
    return S.train(shared.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet"))


def plain_base(text):
    """The three patterns read character by character."""
    out, at, low = [], 0, text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text)
    names = ["password", "passwd", "secret", "token", "api_key", "apikey"]
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    while at < len(text):
        end = None
        for name in names:
            if low.startswith(name, at):
                k = at + len(name)
                k += k < len(text) and text[k] in "\"'"
                while k < len(text) and text[k] == " ":
                    k += 1
                if k < len(text) and text[k] in ":=":
                    k += 1
                    while k < len(text) and text[k] == " ":
                        k += 1
                    k += k < len(text) and text[k] in "\"'"
                    first = k
                    while k < len(text) and text[k] in value:
                        k += 1
                    if k > first:
                        end = k
                        if k - first >= 6:
                            out.append((at, 0, f"assign:{at}:{k}"))
                        break
        at = end or at + 1
    for kind, order, chars, head, least in (("access", 1, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "AKIA", 20), ("hex", 2, "0123456789abcdef", "", 24)):
        at = 0
        while at < len(text):
            k = at + len(head)
            if text.startswith(head, at):
                while k < len(text) and text[k] in chars:
                    k += 1
                if k > at + len(head):
                    if k - at >= least:
                        out.append((at, order, f"{kind}:{at}:{k}"))
                    at = k
                    continue
            at += 1
    return ",".join(s for _, _, s in sorted(out))


def plain_tags(text, model):
    """Viterbi over every token of the whole text, features added one by one."""
    tokens = S._TOKEN(text)
    cores = [""] * S.BEFORE + [t.rstrip() for t in tokens] + [""] * S.BEHIND
    base = sum(model.weights[S._place(f)] for f in S.text_features(text))
    scores = []
    for n in range(len(tokens)):
        total = np.array(base, np.float64)
        for k, o in enumerate(S.OFFSETS):
            core = cores[n + S.BEFORE + o]
            if core:
                for place in S.shape_places(S.shape(core))[k]:
                    total += model.weights[place]
                if S.word_of(core) in model.words:
                    total += model.weights[S.word_places(S.word_of(core))[k]]
        scores.append(total)
    if not scores:
        return []
    tags, out, at, before = S.viterbi(np.array(scores), model.moves), [], 0, S.OUTSIDE
    for token, tag in zip(tokens, tags):
        end = at + len(token.rstrip())
        if tag == S.BEGIN or (tag == S.INSIDE and before == S.OUTSIDE):
            out.append((at, end))
        elif tag == S.INSIDE:
            out[-1] = (out[-1][0], end)
        at, before = at + len(token), tag
    return out


def awkward_texts():
    rng = random.Random(3)
    texts = ["", " ", "token", "token=", 'Token = "abcdef"', "toKen=abcdefgh", "api_key:'x'", "APIKEY: = abcdefg", "secret: secret: abcdef9"]
    texts += ["token: token: abcdefgh", "AKIA" + "A" * 16, "AKIAAKIA" + "B2" * 7, "AKIA1", "f" * 24 + " " + "f" * 23, "é\U0001f600 passwd='" + "a1" * 12 + "'"]
    for n in range(60):
        text = words(n, rng.randint(1, 60))
        for _ in range(rng.randint(0, 3)):
            head, value, tail = S.planted_secret(rng)
            at = rng.randrange(len(text))
            text = text[:at] + " " + head + value + tail + S.planted_look_alike(rng) + text[at:]
        texts.append(text)
    return texts


def test_base_spans_by_character():
    for text in awkward_texts():
        assert ",".join(f"{k}:{a}:{b}" for a, b, k in S.base_spans(text)) == plain_base(text), text


def test_decoding_is_exact(model, monkeypatch):
    for block in (S.BLOCK, 40):
        monkeypatch.setattr(S, "BLOCK", block)
        monkeypatch.setattr(S, "REMEMBERED", S.REMEMBERED if block > 40 else 20)
        tagger = S.Tagger(model)
        for text in awkward_texts():
            assert tagger.spans(text) == plain_tags(text, model), text


def test_viterbi_by_enumeration():
    from itertools import product

    rng = np.random.default_rng(4)
    for size in (1, 2, 5):
        scores, moves = rng.normal(size=(size, 3)), rng.normal(size=(3, 3))
        value = lambda tags: sum(scores[i, t] for i, t in enumerate(tags)) + sum(moves[a, b] for a, b in zip((0, *tags), (*tags, 0)))
        assert tuple(S.viterbi(scores, moves)) == max(product(range(3), repeat=size), key=value)


def test_expected_sums_by_enumeration():
    from itertools import product

    rng = np.random.default_rng(5)
    scores, moves, sizes = rng.normal(size=(3, 4, 3)), rng.normal(size=(3, 3)), [4, 2, 1]
    live = np.arange(4)[None, :] < np.array(sizes)[:, None]
    marginal, pair = S._sums(scores, moves, live)
    want, moved = np.zeros_like(scores), np.zeros((3, 3))
    for row, size in enumerate(sizes):
        held = []
        for tags in product(range(3), repeat=size):
            full = (0, *tags, 0)
            held.append((tags, full, np.exp(sum(scores[row, i, t] for i, t in enumerate(tags)) + sum(moves[a, b] for a, b in zip(full, full[1:])))))
        total = sum(w for _, _, w in held)
        for tags, full, w in held:
            for i, t in enumerate(tags):
                want[row, i, t] += w / total
            for a, b in zip(full, full[1:]):
                moved[a, b] += w / total
    assert np.allclose(marginal, want) and np.allclose(pair, moved)


def test_planted_secrets_are_found_and_plain_texts_left_alone(model, shared):
    docs = shared.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("text").collect()
    clean = [r.text for r in docs if r.text and not S.base_spans(r.text)]
    tagger, rng, caught = S.Tagger(model), random.Random(77), 0
    assert sum(len(tagger.spans(t)) for t in clean) <= len(clean) // 50
    for text in clean[:200]:
        head, value, tail = S.planted_secret(rng)
        found = tagger.spans(text + " " + head + value + tail)
        first = len(text) + 1 + len(head)
        caught += any(a < first + len(value) and b > first for a, b in found)
    assert caught >= 180


def test_query_against_plain_reading(shared):
    folder = SF
    rows = catalog.QUERIES["op13_secrets"](shared, folder).collect()
    texts = {r.doc_id: r.text or "" for r in shared.read.parquet(f"{folder}/documents.parquet").collect()}
    model = S.train(shared.read.parquet(f"{folder}/documents.parquet"))
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in base.split(",")) for k in ("assign", "access", "hex")]
        both = [tuple(map(int, s.split(":")[1:])) for s in base.split(",") if s]
        tagged = [f"crf:{a}:{b}" for a, b in plain_tags(texts[r.doc_id], model) if not any(a < y and b > x for x, y in both)]
        key = lambda s: (int(s.split(":")[1]), S.KINDS.index(s.split(":")[0]))
        assert r.spans == ",".join(sorted([s for s in [*base.split(","), *tagged] if s], key=key))


def test_awkward_rows(documents, no_documents):
    model = S.train(documents)
    clashing = documents.withColumnsRenamed({"lang": "spans", "n_chars": "__hash"})
    rows = S.find(clashing, model).collect()
    assert len(rows) == documents.count() and {tuple(r.spans) for r in rows if not r.text} == {()}
    assert S.find(no_documents, model).count() == 0
    assert not S.train(no_documents).trained
    assert S.find(documents, S.SecretModel()).count() == documents.count()
