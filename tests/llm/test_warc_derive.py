import base64
import hashlib
import json
from html.parser import HTMLParser

from pyspark.sql import functions as F

from mktpanel.llm import warc_derive as W
from mktpanel.llm.common import table


class Plain(HTMLParser):
    def __init__(self):
        super().__init__()
        self.words, self.links, self.off = [], [], 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style")
        if tag == "a" and dict(attrs).get("href"):
            self.links.append(dict(attrs)["href"])

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.off:
            self.words.append(data)


def parse(record):
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    assert lines[0] == "WARC/1.0" and rest.endswith(b"\r\n\r\n")
    return fields, rest[:-4]


def test_records_are_linked_and_whole(spark, small):
    pages = table(spark, small, "pages")
    sources = {r.page_id: r for r in W.responses(pages).collect()}
    rows = W.derive(W.responses(pages)).collect()
    assert len(rows) == 2 * pages.count() and len({r.record_id for r in rows}) == len(rows)
    html = {r.page_id: r.html for r in pages.collect()}
    other = {(r.page_id, r.record_type): r.record_id for r in rows}
    for r in rows:
        source, (fields, block) = sources[r.page_id], parse(r.record)
        assert fields["WARC-Refers-To"] == source.record_id == r.refers_to
        assert fields["WARC-Type"] == r.record_type and fields["WARC-Record-ID"] == r.record_id
        assert fields["WARC-Target-URI"] == source.target_uri and fields["WARC-Date"] == source.date
        assert fields["WARC-Concurrent-To"] == other[r.page_id, {"metadata": "conversion"}.get(r.record_type, "metadata")]
        assert int(fields["Content-Length"]) == len(block) == r.content_length
        assert fields["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode() == r.block_digest
        plain = Plain()
        plain.feed(html[r.page_id])
        if r.record_type == "conversion":
            assert "".join(block.decode().split()) == "".join("".join(plain.words).split())
        else:
            envelope = json.loads(block)["Envelope"]
            meta = envelope["Payload-Metadata"]["HTTP-Response-Metadata"]
            assert envelope["WARC-Header-Metadata"]["WARC-Record-ID"] == source.record_id
            assert envelope["WARC-Header-Metadata"]["WARC-Payload-Digest"] == source.payload_digest
            assert meta["Entity-Length"] == len(html[r.page_id].encode()) == int(meta["Headers"]["Content-Length"])
            assert len([x for x in meta["HTML-Metadata"]["Links"] if x["path"] == "A@/href"]) == len(plain.links)


def test_text_of_awkward_pages():
    assert W.visible_text("a<b>b</b><br>c&amp;d<!-- x > y --><script>1<2</script> e") == "ab\nc&d e"
    assert W.visible_text('<p title="a>b">x</p><script>never closed') == "x"
    assert W.visible_text("2 < 3 and 4 > 1") == "2 < 3 and 4 > 1"
    assert W.visible_text("") == ""


def test_edge_cases(spark):
    rows = [(1, None, "<a href='/x'>y</a>"), (2, "http://h/a/", None), (2, "http://h/a/", None), (None, "u", ""),
            (3, "http://[bad", "<a href='//[x'>q</a>"), (4, "http://h/a/", "<a href=b>t</a>" * 20000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_id", F.lit("x"))
    got = W.derive(W.responses(pages)).collect()
    assert len(got) == 12 and len({r.record_id for r in got}) == 10
    long = next(r for r in got if r.page_id == 4 and r.record_type == "metadata")
    assert len(json.loads(parse(long.record)[1])["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]["HTML-Metadata"]["Links"]) == 20000
    assert W.derive(W.responses(pages.limit(0))).count() == 0


def test_all_headers_of_the_source_are_kept(spark):
    head = ("HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nServer:x\r\nset-cookie: b=2; Path=/\r\nVia: 1.1 p\r\nX-Long: one\r\n two\r\n\tthree\r\n"
            "Link: <http://h/?a: b>\r\nno field\r\nEmpty:")
    warc = ("WARC-Type: response\r\nWARC-IP-Address: 192.0.2.1\r\nWARC-Concurrent-To: <urn:a>\r\nWARC-Concurrent-To: <urn:b>\r\n"
            "warc-refers-to: <urn:c>\r\nContent-Type: application/http;\r\n msgtype=response\r\nContent-Length: 12")
    pages = W.responses(spark.createDataFrame([(1, "http://h/", "<p>x")], "page_id long, url string, html string"))
    for given in (True, False):
        sources = pages.withColumn("http_head", F.lit(head))
        sources = sources.withColumn("warc_headers", F.lit(warc)) if given else sources
        record = next(r.record for r in W.derive(sources).collect() if r.record_type == "metadata")
        envelope = json.loads(parse(record)[1])["Envelope"]
        assert list(envelope["Payload-Metadata"]["HTTP-Response-Metadata"]["Headers"].items()) == [
            ("Set-Cookie", ["a=1", "b=2; Path=/"]), ("Server", "x"), ("Via", "1.1 p"), ("X-Long", "one two three"),
            ("Link", "<http://h/?a: b>"), ("Empty", "")]
        headers = envelope["WARC-Header-Metadata"]
        assert headers["WARC-Record-ID"] == pages.first().record_id and headers["WARC-Type"] == "response"
        if given:
            assert headers["WARC-IP-Address"] == "192.0.2.1" and headers["WARC-Concurrent-To"] == ["<urn:a>", "<urn:b>"]
            assert headers["WARC-Refers-To"] == "<urn:c>" and headers["Content-Type"] == "application/http; msgtype=response"


def test_broken_markup_takes_linear_time():
    """A megabyte each; the quadratic forms of this took minutes to hours."""
    import time
    for part in ("<a ", '<a href="x ', "<!", "<title", "<title>", "<a b='", "</script ", "<p a" + "b" * 500 + " ", "<x y=\"'>", "&amp"):
        page = part * (1_000_000 // len(part))
        for closed in (page, "<p>" + page + ">"):
            start = time.perf_counter()
            W.visible_text(closed)
            W.page_metadata(closed, "http://x.org/")
            assert time.perf_counter() - start < 5, part


def test_tags_end_outside_quotes():
    page = "<p title='a>b' id=\"c'>\">one<br/>two <b x=y>three</b> 1 < 2 <i never closed"
    assert W.visible_text(page) == "one\ntwo three 1 < 2 <i never closed"
    meta = W.page_metadata("<title>A &amp; B</title><a href='x>y'>l</a><meta name=n content=\"c'\"><a href=/z><A HREF=", "http://h/")
    assert meta["Title"] == "A & B" and [x["url"] for x in meta["Links"]] == ["http://h/x>y", "http://h/z"]
    assert meta["Metas"] == [{"name": "n", "content": "c'"}]


def test_a_line_break_in_a_url_forges_no_header(spark):
    url = "http://x.org/a\r\nWARC-Type: response\r\n\r\nforged"
    pages = spark.createDataFrame([(1, url, "<p>t</p>")], "page_id long, url string, html string")
    records = {r.record_type: r for r in W.derive(W.responses(pages)).collect()}
    for kind, r in records.items():
        fields, block = parse(bytes(r.record))
        assert fields["WARC-Type"] == kind and len(block) == int(fields["Content-Length"]) == r.content_length
        assert fields["WARC-Target-URI"] == "http://x.org/a%0D%0AWARC-Type: response%0D%0A%0D%0Aforged" and r.target_uri == url


def test_plain_pages_need_no_list_of_ends(monkeypatch):
    """Tags whose ends the pattern finds itself cost no second pass; the others still end where they did."""
    asked = []
    real = W._Ends._read
    monkeypatch.setattr(W._Ends, "_read", lambda self: asked.append(self.page) or real(self))
    page = "<title>t</title><p class='a>b'>x\t y  z<a href=\"/u\" rel=v>l</a><br/>"
    assert W.visible_text(page) == "t\nx y zl"
    assert W.page_metadata(page, "http://h/")["Links"] == [{"path": "A@/href", "url": "http://h/u"}]
    assert asked == []
    assert W.visible_text("<p a<b>x") == "x" and W.visible_text("<p " + "a='>' " * 20 + ">x") == "x" and len(asked) == 2
