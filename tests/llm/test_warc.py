"""WARC archives: round trip, revisits against brute force, and archives written anew."""

import hashlib

import pytest

from tessera.llm import shared, warc
from tessera.llm.shared import fresh_path

BIG = "<p>é " + "x" * 1200 + "</p>\r\n\r\nWARC/1.1\r\n\r\n\x00end"
EDGE = "y" * 1000
ROWS = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, BIG), (4, "http://a/4", EDGE), (5, "http://a/5", EDGE), (6, "http://b", "small"),
    (7, "http://b", "small"), (8, "http://c/\r\nX: y", None), (9, "http://d", ""), (10, "http://e", "z" * 5000), (5, "http://a/5", EDGE), (None, "http://f", BIG),
    (11, "http://é/ü", "y" * 999), (12, "http://g", "y" * 999),
]


def brute(rows):
    groups = {}
    for i, _, h in rows:
        groups.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        first = max((x for x in groups[h or ""] if x is not None), default=None)
        revisit = len(raw) >= 1000 and i != first
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x") for r in ROWS], "page_id bigint, url string, html string, payload string").repartition(3)


def clean(url):
    return url and url.replace("\r", "%20").replace("\n", "%20").replace(" ", "%20")


@pytest.mark.parametrize("words", [shared.WORDS, 1])  # with one word of bits, most digests look repeated
def test_round_trip_and_revisits(spark, pages, monkeypatch, words):
    monkeypatch.setattr(warc, "may_match", lambda *args: shared.may_match(*args, words))
    path = fresh_path(spark, "warc-test")
    warc.write(warc.resolve(pages), path, archive_bytes=2000)
    full = warc.read(spark, path, with_payload=True)
    found = warc.join_revisits(full)
    assert rows_of(found) == brute(ROWS)
    revisits = {r[0] for r in brute(ROWS) if r[3] == "revisit"}
    assert sorted(((r.page_id, r.url, r.payload) for r in full.collect()), key=str) == sorted(((i, clean(u), None if i in revisits else h or "") for i, u, h in ROWS), key=str)
    ids = [r.record_id for r in found.dropDuplicates(["page_id"]).collect()]
    assert len(set(ids)) == len(ids)


def test_one_payload_in_most_rows(spark):
    rows = [(i, "u", BIG if i % 3 else f"{i}" * 400) for i in range(3000)]
    path = fresh_path(spark, "warc-test")
    warc.write(warc.resolve(spark.createDataFrame(rows, "page_id bigint, url string, html string")), path)
    assert rows_of(warc.join_revisits(warc.read(spark, path))) == brute(rows)


def test_files_are_gzip_members(spark, pages):
    import gzip
    from pathlib import Path

    path = fresh_path(spark, "warc-test")
    warc.write(warc.resolve(pages), path, archive_bytes=3000)
    files = list(Path(path.removeprefix("file:")).glob("*.txt"))
    assert len(files) > 2
    plain = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert len(list(warc.parse(plain))) == len(ROWS)


def test_archives_of_other_makers():
    import base64

    page = b"<p>hi</p>"
    sha = base64.b32encode(hashlib.sha1(page).digest())
    block = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\n" + page
    info, body = b"software: y\r\n", b"GET / HTTP/1.1\r\n\r\n"
    head = lambda kind, size, more=b"": b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nWARC-Record-ID: <urn:uuid:1>\r\n" + more + b"Content-Length: %d\r\n\r\n" % size
    data = b"".join((head(b"warcinfo", len(info)), info, b"\r\n\r\n", head(b"request", len(body)), body, b"\r\n\r\n", head(b"response", len(block), b"WARC-Payload-Digest: sha1:" + sha + b"\r\n"), block, b"\r\n\r\n", head(b"resource", 3), b"abc\r\n\r\n"))
    for archive in (data, warc.pack(data[:90]) + warc.pack(data[90:])):
        found = [warc._row(r, True) for r in warc.parse(b"".join(warc.members(archive)))]
        assert [(r["record_type"], r["payload"], r["payload_bytes"], r["page_id"]) for r in found] == [("response", "<p>hi</p>", 9, None), ("response", "abc", 3, None)]
        assert found[0]["payload_digest"] == hashlib.sha1(page).hexdigest()


def test_archives_written_anew(spark, pages):
    a, b = fresh_path(spark, "warc-test"), fresh_path(spark, "warc-test")
    everything = warc.resolve(pages, min_revisit=10**9)  # nothing resolved yet
    assert everything.filter("record_type = 'revisit'").isEmpty()
    warc.write(everything, a)
    warc.deduplicate(spark, a, b)
    found = warc.read(spark, b)
    assert rows_of(warc.join_revisits(found)) == brute(ROWS)
    assert not {r.record_id for r in found.collect()} & {r.record_id for r in warc.read(spark, a).collect()}
    c = fresh_path(spark, "warc-test")
    warc.deduplicate(spark, b, c, made="3")
    assert rows_of(warc.join_revisits(warc.read(spark, c))) == brute(ROWS)


def test_lengths_lead_from_record_to_record(spark, pages):
    data = b"".join(r.value.encode() for r in warc.records(warc.resolve(pages), "1").collect())
    found = list(warc.parse(data))
    assert len(found) == len(ROWS)
    with pytest.raises(ValueError):
        list(warc.parse(data[:-3]))


def test_empty_table(spark, pages):
    path = fresh_path(spark, "warc-test")
    warc.write(warc.resolve(pages.limit(0)), path)
    assert warc.read(spark, path).count() == 0
