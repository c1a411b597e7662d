import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import document_rows

from tidemark.llm import packing, token_index
from tidemark.llm.tokens import PieceEncoder, default_path

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
_KNOWN = {name: PieceEncoder(default_path(name)) for name in FILES}
TEXT = st.lists(st.sampled_from([*"abZ .,'\n\t12<|>!ßéİΣσ\x1c\xa0日", "  ", "'s", "<|endoftext|>", "\r\n", "the"]), max_size=16).map("".join)


def plain_ids(name: str, text: str) -> bytes:
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(default_path(name)).encode(text, add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(text=TEXT)
def test_pieces_give_the_ids_of_the_whole_text(name, text):
    encoder = _KNOWN[name]
    assert next(encoder.encode([text])) == encoder._direct(text)


@pytest.mark.parametrize("name", FILES)
def test_very_long_text_and_bounded_memory(name):
    encoder = PieceEncoder(default_path(name), remembered=100)
    text = "some words, and more.\nAgain " * 60_000
    assert next(encoder.encode([text])) == plain_ids(name, text)
    list(encoder.encode([" ".join(f"w{i}" for i in range(500)), "x"]))
    assert len(encoder._words) <= 101


def test_piece_lengths():
    assert packing.piece_lengths(2048 * 2 + 5, 2048) == [2048, 2048, 4, 1]
    for n in range(1, 300):
        parts = packing.piece_lengths(n, 64)
        assert sum(parts) == n and all(p & (p - 1) == 0 and p <= 64 for p in parts)


def test_packing_against_whole_encoding(documents, no_documents):
    extra = documents.withColumnsRenamed({"lang": "ids", "n_chars": "start"})
    rows = packing.pieces(extra, sequence_length=256).toPandas()
    whole = []
    for doc, text, *_ in document_rows():
        raw = plain_ids(FILES[0], text or "") + np.array([1], "<u4").tobytes()
        whole.append((doc, raw))
    built = {}
    for sequence in rows.itertuples():
        assert len(sequence.ids) == 4 * sequence.length and sequence.offset == 0
    assert rows.sequence_id.is_unique
    ordered = rows.sort_values("sequence_id")
    joined = b"".join(bytes(i) for i in ordered.ids)
    assert sorted(joined) == sorted(b"".join(raw for _, raw in whole))
    starts = ordered[ordered.start == 0]
    assert len(starts) == len(whole)
    digest = packing.digest(packing.pieces(documents)).toPandas()
    for doc, raw in whole:
        if doc in (1, 10, 8, 6):
            mine = digest[digest.doc_id == doc].sort_values("start")
            at = 0
            for piece in mine.itertuples():
                assert piece.start == at and piece.doc_tokens == len(raw) // 4
                assert piece.ids_crc32 == zlib.crc32(raw[4 * at : 4 * (at + piece.length)])
                at += piece.length
            assert 4 * at == len(raw)
            built[doc] = at
    assert len(built) == 4
    assert packing.pieces(no_documents).count() == 0


def test_perfect_hash_round_trip(tmp_path):
    hashes, marks = token_index.key_hashes([f"{i}/0" for i in range(5000)])
    table = token_index.PerfectHash.build(hashes)
    assert sorted(table.slots(hashes).tolist()) == list(range(5000))
    with open(tmp_path / "h", "wb") as out:
        table.write(out)
    with open(tmp_path / "h", "rb") as data:
        again = token_index.PerfectHash.read(data)
    assert (again.slots(hashes) == table.slots(hashes)).all()
    assert len(token_index.PerfectHash.build(hashes[:0]).levels) == 0
    with pytest.raises(ValueError):
        token_index.PerfectHash.build(np.repeat(hashes[:1], 2))


class _Counted:
    """A file that counts the bytes read."""

    def __init__(self, raw):
        self.raw, self.read_bytes = raw, 0

    def read_at(self, n, at):
        self.read_bytes += n
        return self.raw[at : at + n]


@pytest.mark.parametrize("count", [1, 700, 60_000])
def test_one_key_reads_as_much_of_any_bucket(tmp_path, count):
    hashes, marks = token_index.key_hashes([f"{i}/0" for i in range(count)])
    table = token_index.PerfectHash.build(hashes)
    slots = np.zeros(count, token_index._SLOT)
    slots["fingerprint"][table.slots(hashes)] = marks
    slots["offset"][table.slots(hashes)] = np.arange(count)
    with open(tmp_path / "h", "wb") as out:
        table.write(out)
        out.write(slots.tobytes())
    raw = (tmp_path / "h").read_bytes()
    read = []
    for i in range(0, count, max(1, count // 500)):
        data = _Counted(raw)
        assert token_index.read_slot(data, int(hashes[i]), int(marks[i]))["offset"] == i
        read.append(data.read_bytes)
    assert np.mean(read) < 520 + 24 + 3 * 72
    other, mark = token_index.key_hashes([f"{i}/1" for i in range(300)])
    assert all(token_index.read_slot(_Counted(raw), int(h), int(m)) is None for h, m in zip(other, mark, strict=True))


def test_few_and_many_keys_of_a_bucket_find_the_same(shared):
    rows = [(i, 0, i % 7, f"f{i % 7}", 3 * i, i % 11) for i in range(3000)]
    manifest = shared.createDataFrame(rows, "doc_id long, copy long, shard long, file string, offset long, n_tokens long")
    index = token_index.build_index(manifest, bucket_keys=5000)
    assert index.count() == 1
    every = {tuple(r) for r in token_index.look_up(manifest.select("doc_id", "copy"), index).collect()}
    assert every == {(d, c, s, o, n) for d, c, s, _, o, n in rows}
    few = token_index.look_up(manifest.filter("doc_id % 300 = 7").select("doc_id", "copy"), index).collect()
    assert {tuple(r) for r in few} == {r for r in every if r[0] % 300 == 7} and len(few) == 10


@pytest.mark.parametrize("width", [2, 4])
def test_token_index_reads_back_every_document(documents, no_documents, width):
    manifest = token_index.write_shards(documents.repartition(3), width=width)
    index = token_index.build_index(manifest, bucket_keys=4)
    places = token_index.look_up(manifest.select("doc_id", "copy"), index)
    read = token_index.read_ids(places, token_index.shard_starts(manifest), width).toPandas()
    expected = sorted(
        (-1 if doc is None else doc, plain_ids(FILES[1], text or "") + np.array([2], "<u4").tobytes())
        for doc, text, *_ in document_rows()
    )
    mine = sorted((-1 if np.isnan(r.doc_id) else int(r.doc_id), bytes(r.ids)) for r in read.itertuples())
    assert mine == expected
    at = 0
    for row in read.sort_values("start").itertuples():
        assert row.start == at
        at += row.n_tokens
    assert read.sort_values("start").doc_id.fillna(-1).is_monotonic_increasing
    unknown = documents.sparkSession.createDataFrame([(999, 0), (1, 5)], "doc_id long, copy long")
    assert token_index.look_up(unknown, index).count() == 0
    empty = token_index.write_shards(no_documents)
    assert token_index.look_up(empty.select("doc_id", "copy"), token_index.build_index(empty)).count() == 0
