import hashlib
import io

import pytest

from tidemark.llm import archives

PAGES = "page_id long, url string, html string, file string"


def rows():
    big = "<p>" + "word " * 400 + "</p>"
    return [
        (1, "http://a.example/x y", big, "clash"),
        (5, "http://a.example/2", big, None),
        (3, "http://b.example/\t", big + "é", None),
        (7, None, "short", None),
        (8, "", "short", None),
        (9, "http://c.example/", None, None),
        (10, "http://c.example/long", "x" * 300_000 + "\r\n\r\nWARC/1.1\r\n", None),
        (11, "http://c.example/long", "x" * 300_000 + "\r\n\r\nWARC/1.1\r\n", None),
        (None, "http://d.example/", big, None),
        (5, "http://a.example/2", big, None),
    ]


def expected(pages):
    out = []
    for k, _, html, _ in pages:
        raw = (html or "").encode()
        same = [p[0] for p in pages if (p[2] or "").encode() == raw and p[0] is not None]
        out.append((k, len(raw), hashlib.sha1(raw).hexdigest(), max(same, default=None) if len(raw) >= 1000 else k))
    return out


@pytest.mark.parametrize("parts", [1, 4])
def test_round_trip(shared, parts):
    pages = shared.createDataFrame(rows(), PAGES).repartition(parts)
    read = archives.read_warc(archives.convert(archives.write_arc(pages))).collect()
    want = expected(rows())
    assert sorted((r["page_id"] or -1, r["payload_bytes"], r["payload_digest"]) for r in read) == sorted((k or -1, n, h) for k, n, h, _ in want)
    top = {(k, h): t for k, _, h, t in want}
    for digest in {r["payload_digest"] for r in read}:
        group = [r for r in read if r["payload_digest"] == digest]
        responses = [r for r in group if r["record_type"] == "response"]
        if group[0]["payload_bytes"] < 1000:
            assert len(responses) == len(group)
            continue
        assert len(responses) == 1
        for r in group:
            assert responses[0]["page_id"] == top[r["page_id"], digest]
            assert r["record_type"] == "response" or r["refers_to"] == responses[0]["page_id"]
    assert {r["url"] for r in read} >= {"about:blank", "http://a.example/x%20y", "http://b.example/%09"}


def test_no_pages(shared):
    assert archives.read_warc(archives.convert(archives.write_arc(shared.createDataFrame([], PAGES)))).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_plain_and_short_headers(version):
    block = b"HTTP/1.0 200 OK\nno blank line"
    raw = archives.arc_version_block(version, "19970102030405") + archives.arc_header(
        version, b"http://x/", "1997", "text/html", len(block)
    ) + block + b"\n"
    found = list(archives.read_arc(io.BytesIO(raw)))
    assert [b for _, b in found] == [block]
    assert found[0][0]["URL"] == b"http://x/" and archives.warc_date(found[0][0]["Archive-date"]) == "1997-01-01T00:00:00Z"
    fields = archives.ARC_FIELDS[version].split(" ")
    assert list(found[0][0]) == fields


def test_broken_files():
    good = archives.arc_version_block(1, "19970102030405") + archives.arc_header(1, b"http://x/", "1997", "text/html", 50) + b"short"
    with pytest.raises(EOFError):
        list(archives.read_arc(io.BytesIO(good)))
    with pytest.raises(ValueError):
        list(archives.read_arc(io.BytesIO(b"http://x/ 0.0.0.0 1997 text/html 3\nabc\n")))
    assert list(archives.read_arc(io.BytesIO(b""))) == []


def test_identifiers_are_the_same_in_every_run():
    assert archives.record_id(4, b"x" * 20) == archives.record_id(4, b"x" * 20) != archives.record_id(5, b"x" * 20)


def test_as_many_warc_files_as_arc_files(shared):
    pages = shared.createDataFrame([(i, f"http://a.example/{i % 7}", "word " * 300 + str(i % 40), None) for i in range(320)], PAGES)
    arcs = archives.write_arc(pages.repartition(16))
    assert arcs.count() == 16
    warcs = archives.convert(arcs)
    assert warcs.count() == 16 and warcs.agg({"records": "sum"}).first()[0] == 320
    read = archives.read_warc(warcs)
    assert read.rdd.getNumPartitions() == 16 and read.count() == 320


def test_revisits_name_their_response(shared):
    pages = shared.createDataFrame(rows(), PAGES)
    seen, infos = {}, []
    for file in archives.convert(archives.write_arc(pages)).collect():
        with archives.open_stream(file["file"]) as stream:
            for fields, _ in archives.warc_records(stream):
                (infos.append(fields) if fields["WARC-Type"] == "warcinfo" else seen.setdefault(fields["WARC-Record-ID"], fields))
    assert {i["WARC-Date"] for i in infos} == {"1998-01-01T00:00:00Z"}
    revisits = [f for f in seen.values() if f["WARC-Type"] == "revisit"]
    assert len(revisits) >= 3
    for f in revisits:
        assert f["WARC-Refers-To-Date"] == "1998-01-01T00:00:00Z" and f["WARC-Block-Digest"].startswith("sha1:")
        assert f["WARC-Refers-To-Target-URI"].startswith("http://")
