"""ARC to WARC: formats by hand, an exact round trip, revisits, odd input."""

import base64
import gzip
import hashlib

from recspark.llm import archives

ROWS = [(5, "http://a.example/x y", "<p>same</p>"), (2, "http://b.example/", "<p>same</p>"),
        (9, None, None), (3, "", ""), (7, "http://c.example/é\n", "ünï\r\n\r\nWARC/1.1\r\n\n"),
        (11, "http://d.example/", "long " * 1_500_000), (12, "dns:x", "filedesc://no\n1 0 x"),
        (2, "http://b.example/", "<p>same</p>"), (None, "http://n.example/", "<p>same</p>")]


def brute(rows, least=0):
    groups = {}
    for page, _, html in rows:
        groups.setdefault(html or "", []).append(page)
    out = []
    for html, pages in groups.items():
        raw = html.encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        order = sorted(pages, key=lambda p: (p is None, p or 0))
        for i, p in enumerate(order):
            again = i > 0 and len(raw) >= least
            out.append((p, len(raw), digest, "revisit" if again else "response",
                        order[0] if again else None))
    return sorted(out, key=str)


def run(spark, df, least=0):
    got = archives.archive_round_trip(spark, df, least)
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in got.collect() if r.digests_agree), key=str)


def test_round_trip(spark):
    df = spark.createDataFrame([(*r, 1, "p") for r in ROWS],
                               "page_id long, url string, html string, offset int, path string")
    assert run(spark, df.repartition(2)) == brute(ROWS)
    assert run(spark, df, 8) == brute(ROWS, 8)


def test_payloads_survive(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    archives.write_arc(spark, df, f"{tmp_path}/arc")
    archives.arc_to_warc(spark, f"{tmp_path}/arc", f"{tmp_path}/warc", 1 << 40)
    rows = archives.read_warc(spark, f"{tmp_path}/warc", with_payload=True).collect()
    got = sorted(bytes(r.payload) for r in rows if r.record_type == "response")
    assert got == sorted((h or "").encode() for _, _, h in ROWS)
    assert sum(r.record_type == "warcinfo" for r in rows) >= 1


def test_negative_ids(spark):
    rows = [(-5, "u", "same page"), (4, "v", "same page"), (-7, "w", "same page"), (0, "x", "z"),
            (-(1 << 63), "y", "least"), ((1 << 63) - 1, "y", "least")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert run(spark, df) == brute(rows)
    assert archives.page_of(b"x-page-id: -12\r\n") == -12
    for odd in (b"1.5", b"--1", b"9" * 30, b""):
        assert archives.page_of(b"X-Page-Id: " + odd + b"\r\n") is None


def test_a_revisit_outlives_its_response(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "same"), (2, "v", "same")],
                               "page_id long, url string, html string")
    archives.write_arc(spark, df, f"{tmp_path}/arc")
    archives.arc_to_warc(spark, f"{tmp_path}/arc", f"{tmp_path}/warc", 0)
    records = archives.read_warc(spark, f"{tmp_path}/warc")
    left = archives.resolve_revisits(spark, records.where("record_type <> 'response'")).collect()
    assert [(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in left] == [
        (2, "revisit", None, None)]


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert run(spark, df) == []


def test_versions_by_hand(spark, tmp_path):
    block = b"HTTP/1.0 200 OK\r\nX-Page-Id: 4\r\n\r\nbody"
    v1 = (b"filedesc://old.arc 0.0.0.0 19960923142103 text/plain 76\n1 0 AlexaInternet\n"
          b"URL IP-address Archive-date Content-type Archive-length\n\n\n"
          b"http://x.example/a b c 192.168.1.1 19970101123456 text/html %d\n" % len(block) + block
          + b"\n")
    body = b"2 0 me\n" + archives.ARC_FIELDS["2"].encode() + b"\n"
    v2 = (b"filedesc://new.arc 0.0.0.0 20010101000000 text/plain %d\n" % len(body) + body
          + b"\nhttp://y.example/ 10.0.0.1 20010203040506 text/html 200 abc - 99 new.arc %d\n"
          % len(block) + block + b"\n")
    v1_body = b"1 0 AlexaInternet\nURL IP-address Archive-date Content-type Archive-length\n"
    v1 = v1.replace(b"text/plain 76", b"text/plain %d" % len(v1_body))
    found = list(archives.arc_records(v1 + v2))
    assert [h["URL"] for _, h, _ in found] == [
        "filedesc://old.arc", "http://x.example/a b c", "filedesc://new.arc", "http://y.example/"]
    assert found[1][2] == found[3][2] == block
    assert found[3][1]["Result-code"] == "200"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.arc.gz").write_bytes(gzip.compress(v1) + gzip.compress(v2))
    (tmp_path / "in" / "bad.arc").write_bytes(v1 + b"http://z.example/ 1.1.1.1 2001 text/html 999\nshort")
    archives.arc_to_warc(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    rows = archives.read_warc(spark, str(tmp_path / "out")).collect()
    kinds = sorted(r.record_type for r in rows)
    assert kinds == ["response", "revisit", "revisit", "warcinfo", "warcinfo", "warcinfo", "x-damaged"]
    dates = {r.date for r in rows if r.url == "http://y.example/"}
    assert dates == {"2001-02-03T04:05:06Z"}
