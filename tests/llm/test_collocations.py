"""Phrases against plain counting."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm import collocations as C
from tidemark.llm.filter_audit import blocks

SCHEMA = "text string, lang string"


def brute(rows, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, found in counts.items():
        wanted = {p: a for p, a in found.items() if len(p) > 1 and a >= 10}
        rows_of_lang = []
        for p, a in wanted.items():
            inside = [b for q, b in wanted.items() if len(q) > len(p) and (q[:2] == p or q[1:] == p)]
            if any(100 * b >= 50 * a for b in inside):
                continue
            s, _, l, r = min(
                (1_000_000 * a * a // (found[p[:k]] * found[p[k:]]), k, found[p[:k]], found[p[k:]]) for k in range(1, len(p))
            )
            rows_of_lang.append((-s, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows_of_lang)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return sorted(out)


def texts(seed=1, count=300):
    rng = random.Random(seed)
    words = ["the", "Of", "new", "york", "City", "é\x1cx", "a\xa0b", "to", "be", "\U0001f600", "or", "not"]
    rows = []
    for _ in range(count):
        text = ""
        for _ in range(rng.randint(0, 40)):
            text += rng.choice(["new york city", "to be or not", rng.choice(words), rng.choice(words)])
            text += rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ; "])
        rows.append((text, rng.choice(["en", "de", None])))
    return rows + [(None, "en"), ("", None), ("...", "en"), ("one", "xx"), ("new york city " * 2000, "en")]


def found(df, **options):
    return sorted(tuple(r) for r in C.collocations(df, **options).collect())


def test_against_counting(shared):
    rows = texts()
    df = shared.createDataFrame(rows, SCHEMA)
    df = df.withColumns({c: F.lit("x") for c in ("prefix", "section", "following", "raw", "n", "score")})
    mine = found(df)
    assert mine == brute(rows) and len(mine) > 30
    assert found(df, top=3) == brute(rows, 3)


def test_sections_blocks_and_flushes_change_nothing(shared, monkeypatch):
    rows = texts(2, 80)
    df = shared.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(C, "HOT_SHARE", 0.0)
    monkeypatch.setattr(C, "HELD", 50)
    monkeypatch.setattr(C, "blocks", lambda raw: blocks(raw, 17))
    assert found(df) == brute(rows)
    monkeypatch.setattr(C, "NUMBERED", 5)
    monkeypatch.setattr(C, "MOST_BITS", 64)  # a bit table without power
    assert found(df) == brute(rows)


def test_empty_tables(shared):
    assert found(shared.createDataFrame([], SCHEMA)) == []
    assert found(shared.createDataFrame([(None, None), ("a b c", "en")], SCHEMA)) == []


def test_exact_beyond_64_bits(shared):
    a, l, r = 3_000_000_000_007, 4_000_000_000_001, 5_000_000_000_003
    df = shared.createDataFrame([(a, l, r)], "a long, l long, r long")
    assert df.select(C._score("a", "l", "r")).first()[0] == 1_000_000 * a * a // (l * r)
