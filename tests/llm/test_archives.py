import gzip
import hashlib

import pytest

from corpusloom.llm import archives as A


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, kind string, digest string")


def brute(rows):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, p in sorted(payloads, key=lambda x: (x[0] is None, x[0] or 0)):
        if len(p) >= 100:
            first.setdefault(p, i)
    return sorted(((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if p in first and first[p] != i else "response",
                    first[p] if p in first and first[p] != i else None) for i, p in payloads), key=repr)


def test_awkward_pages(spark, monkeypatch):
    monkeypatch.setattr(A, "ARCHIVE_BYTES", 2000)
    body = "<p>é\r\n\r\nWARC/1.1\r\n" * 10
    rows = [(3, "http://a.example/x y", body), (1, "http://a.example/", body), (2, None, body), (7, "", None), (8, "http://b.example/\n", ""), (9, "http://c.example", "z" * 99),
            (10, "http://c.example", "z" * 99), (11, "http://c.example", "z" * 100), (12, "http://d.example", "z" * 100), (13, "http://e.example", "q" * 50_000), (None, "http://f.example", body)]
    got = sorted((tuple(r) for r in A.page_archive(pages(spark, rows).repartition(3)).collect()), key=repr)
    assert got == brute(rows)
    assert A.page_archive(pages(spark, [])).count() == 0


def test_pages_named_like_version_blocks_and_repeated_rows(spark):
    body = "1 0 corpus\nURL IP-address Archive-date Content-type Archive-length\n" * 3
    rows = [(1, "filedesc://pages.arc", body), (2, "filedesc://x", "short"), (3, "http://a.example/", body), (3, "http://a.example/", body), (2, "filedesc://x", "short"),
            (4, "filedesc://y", None), (5, "http://b.example/", "w" * 300_000), (5, "http://b.example/", "w" * 300_000)]
    got = sorted((tuple(r) for r in A.page_archive(pages(spark, rows).repartition(2)).collect()), key=repr)
    assert [g[:3] for g in got] == [w[:3] for w in brute(rows)]
    assert sorted((g[0], g[3], g[4]) for g in got) == sorted([(1, "response", None), (2, "response", None), (2, "response", None), (3, "revisit", 1), (3, "revisit", 1),
                                                              (4, "response", None), (5, "response", None), (5, "revisit", 5)], key=repr)


def test_both_versions_and_their_header_lines(spark, tmp_path):
    v1 = b"filedesc://one.arc 0.0.0.0 20010203040506 text/plain 77\n1 0 crawler\nURL IP-address Archive-date Content-type Archive-length\n" + b"x" * 5
    v1 = v1.replace(b" 77\n", b" %d\n" % (len(v1) - v1.index(b"\n") - 1))
    plain = b"\nhttp://a.example/r.txt 1.2.3.4 200102030405 text/plain 9\nnot http\n"
    http = b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n<p>"
    v2head = b"2 0 crawler\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    v2 = b"\nfiledesc://two.arc 0.0.0.0 20020203040506 text/plain 200 - - 0 two.arc %d\n" % len(v2head) + v2head
    v2 += b"\nhttp://b.example/ 1.2.3.4 20020203040507 text/html 200 abc - 99 two.arc %d\n" % len(http) + http + b"\n"
    got = [(r[1], r[3], r[5], r[7]) for r in A.arc_records(v1 + plain + v2, "f")]
    assert [g[2] for g in got] == ["warcinfo", "resource", "warcinfo", "response"]
    assert got[1][1] == "2001-02-03T04:05:00Z" and got[1][3] == b"not http\n" and got[3][3] == b"<p>"
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "part-1.gz").write_bytes(gzip.compress(v1 + plain + v2))
    A.arc_to_warc(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    kinds = {r.uri: (r.kind, r.digest) for r in A.read_warc(spark, str(tmp_path / "warc")).collect() if r.uri}
    assert kinds == {"http://a.example/r.txt": ("resource", hashlib.sha256(b"not http\n").hexdigest()), "http://b.example/": ("response", hashlib.sha256(b"<p>").hexdigest())}


@pytest.mark.parametrize("data", [b"http://a.example/ 1.2.3.4 20010203040506 text/html 99\nshort", b"http://a.example/ 1.2.3.4 text/html 5\nshort"])
def test_bad_headers_and_lengths_are_errors(data):
    with pytest.raises(ValueError, match="f at 0"):
        list(A.arc_records(data, "f"))
