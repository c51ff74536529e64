import base64
import gzip
import hashlib
import json

from tidelake.llm import warc

PAGE = """<!DOCTYPE html><html lang="fr"><head><title>A &amp; B</title><script>var t="</p>";</script><style>p{}</style>
<meta name="description" content="x &lt; y"></head><body><!-- <p>no</p> --><h1>Head</h1><p>one <b>two</b>three<br>four</p>
<a href="/x?a=1&amp;b=2">link</a><a href='http://[bad'>odd</a><img alt="a > b"><p>1 < 2</p></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, headers string, block string")


def sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_conversion():
    text, facts = warc.converted(PAGE)
    assert text.split("\n") == ["A & B", "Head", "one twothree", "four", "linkodd", "1 < 2"]
    assert facts == {"title": "A & B", "lang": "fr", "links": ["/x?a=1&b=2", "http://[bad"], "meta": {"description": "x < y"}}
    assert warc.converted("")[0] == "" and warc.converted("<script>never closed")[0] == "" and warc.converted("a < b")[0] == "a < b"


def test_records_are_linked(spark):
    rows = [(1, "http://a.example.com/d/e", PAGE), (2, None, None), (3, "no url", ""), (3, "no url", ""), (None, "http://b/", "é " * 50_000)]
    responses = warc.responses(pages(spark, rows))
    sources = {r.record_id: r for r in responses.collect()}
    out = warc.derivatives(responses).collect()
    assert len(out) == 2 * len(rows) and len(sources) == 4
    for r in out:
        source, headers, block = sources[r.refers_to], dict(r.headers), bytes(r.block)
        payload = bytes(source.block).split(b"\r\n\r\n", 1)[1]
        assert headers["WARC-Refers-To"] == source.record_id and r.target_uri == source.target_uri
        assert r.source_digest == headers["WARC-Source-Payload-Digest"] == sha(payload)
        assert r.block_digest == sha(block) and r.content_length == len(block)
        partner = next(x for x in out if x.record_id == headers["WARC-Concurrent-To"])
        assert partner.refers_to == r.refers_to and partner.record_type != r.record_type
        if r.record_type == "metadata":
            facts = json.loads(r.block)
            assert facts["text_digest"] == partner.block_digest and dict(facts["http"])["Content-Type"].startswith("text/html")
            assert facts["warc"] == [list(h) for h in source.headers]
            if r.page_id == 1:
                assert facts["links"] == ["http://a.example.com/x?a=1&b=2", "http://[bad"]
    assert warc.derivatives(warc.responses(pages(spark, []))).count() == 0


def test_files_round_trip(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<p>text {i} \r\n\r\n WARC/1.0 é</p>") for i in range(20)]
    responses = warc.responses(pages(spark, rows).repartition(3))
    for compression in ("gzip", "none"):
        path = str(tmp_path / compression)
        warc.write_warc(responses.unionByName(warc.derivatives(responses)), path, compression)
        back = warc.read_warc(spark, path + "/part-*")
        assert back.count() == 60
        again = warc.derivatives(back).drop("page_id").collect()
        assert sorted(r.block_digest for r in again) == sorted(r.block_digest for r in warc.derivatives(responses).collect())


def record(headers, block):
    return b"WARC/1.1\r\n" + "\r\n".join(f"{k}: {v}" for k, v in headers).encode() + b"\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def http(headers, payload):
    return b"HTTP/1.1 200 OK\r\n" + "\r\n".join(headers).encode("latin-1") + b"\r\n\r\n" + payload


def test_foreign_files(spark, tmp_path):
    """A warcinfo record, absent headers, other charsets, repeated headers, images, chunks, compressed payloads; several gzip members."""
    latin = "<html><p>caf\xe9</p></html>".encode("latin-1")
    packed = gzip.compress("<p>zipped é</p>".encode())
    chunks = b"4\r\n<p>a\r\n7;x=1\r\nb c</p>\r\n0\r\n\r\n"
    image = bytes(range(256)) * 4
    records = [
        record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Date", "2020-02-02T00:00:00Z")], b"software: x\r\n"),
        record([("WARC-Type", "request"), ("WARC-Target-URI", "http://a/")], b"GET / HTTP/1.1\r\n\r\n"),
        record([("warc-type", "response"), ("WARC-Record-ID", "<urn:uuid:2>"), ("WARC-Target-URI", "http://a/l"), ("WARC-Date", "2020-02-02T00:00:00Z"),
                ("WARC-IP-Address", "1.2.3.4"), ("WARC-Protocol", "h2"), ("WARC-Protocol", "tls/1.3")],
               http(["Content-Type: text/html; charset=iso-8859-1", "Set-Cookie: a=1", "set-cookie: b=2", "X-Long: one", " two"], latin)),
        record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:3>"), ("WARC-Target-URI", "http://a/i")], http(["Content-Type: image/png"], image)),
        record([("WARC-Type", "response"), ("WARC-Target-URI", "http://a/z")], http(["Content-Type: text/html", "Content-Encoding: gzip"], packed)),
        record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:5>")], http(["Content-Type: text/html", "Transfer-Encoding: chunked"], chunks)),
        record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:6>")], http(["Content-Type: text/html; charset=none-such", "Content-Encoding: gzip"], b"torn \xff")),
        record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:7>")], b"")]
    (tmp_path / "members.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "plain.warc").write_bytes(b"".join(records))
    (tmp_path / "empty.warc").write_bytes(b"")
    for name in ("members.warc.gz", "plain.warc", "*.warc"):
        back = warc.read_warc(spark, str(tmp_path / name))
        rows = back.collect()
        assert [r.record_type for r in rows] == ["warcinfo", "request"] + ["response"] * 6
        assert rows[0].target_uri is None and rows[1].record_id is None and rows[0].block_digest == sha(b"software: x\r\n")
        assert [h.value for h in rows[2].headers if h.name == "WARC-Protocol"] == ["h2", "tls/1.3"]
        assert bytes(rows[3].block).endswith(image) and rows[3].source_digest == sha(image)
        out = warc.derivatives(back).collect()
        texts = {dict(r.headers).get("WARC-Target-URI", r.refers_to): bytes(r.block).decode() for r in out if r.record_type == "conversion"}
        assert texts == {"http://a/l": "caf\xe9", "http://a/z": "zipped é", "<urn:uuid:5>": "ab c", "<urn:uuid:6>": "torn \ufffd", "<urn:uuid:7>": ""}
        facts = {r.target_uri: json.loads(bytes(r.block)) for r in out if r.record_type == "metadata"}
        assert [v for k, v in facts["http://a/l"]["http"] if k.lower() == "set-cookie"] == ["a=1", "b=2"]
        assert ["X-Long", "one two"] in facts["http://a/l"]["http"] and ["WARC-IP-Address", "1.2.3.4"] in facts["http://a/l"]["warc"]
        assert facts["http://a/i"]["text_digest"] is None and facts["http://a/i"]["source_digest"] == sha(image)
        path = str(tmp_path / f"again-{name[:3].strip('*.')}")
        warc.write_warc(back, path)
        again = warc.read_warc(spark, path + "/part-*").collect()
        assert sorted(bytes(r.block) for r in again) == sorted(bytes(r.block) for r in rows)
