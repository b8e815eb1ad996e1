"""Derivatives: links, digests and round trips of records."""

import base64
import hashlib
import os
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from feedhouse.llm import warc


def pages(spark):
    return spark.createDataFrame([
        (1, "http://a.example/1", "<html lang='de'><head><title>A &amp; B</title><style>x{}</style></head><body>"
            "<script>var t='</p>';</script><h1>Kopf</h1><p>eins <b>zwei</b><br>drei &lt;4&gt;<!-- weg --></p>"
            "<a href=\"/x?a=1&amp;b=2\">hier</a><a href='/y'>da</a><a href=\"/x?a=1&amp;b=2\">noch</a></body></html>"),
        (2, "http://a.example/2\r\nWARC-Type: fake", ""),
        (3, None, None),
        (3, None, None),
        (None, "http://a.example/4", "1 < 2 & 3 > 2 <unclosed"),
    ], "page_id long, url string, html string")


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_records_link_to_their_source(spark):
    responses = warc.response_records(pages(spark))
    sources = {}
    for row in responses.collect():
        fields, block = warc.parse(row.record)
        sources[warc.first(fields, "WARC-Record-ID")] = fields, block
    rows = warc.derive(responses).collect()
    assert len(rows) == 10
    for r in rows:
        fields, block = warc.parse(r.record)
        source, source_block = sources[r.refers_to]
        assert warc.first(fields, "WARC-Refers-To") == r.refers_to
        assert warc.first(fields, "WARC-Record-ID") == r.record_id
        assert r.warc_date == warc.first(source, "WARC-Date") == warc.first(fields, "WARC-Date")
        assert r.target_uri == warc.first(source, "WARC-Target-URI") == (warc.first(fields, "WARC-Target-URI") or "")
        assert r.block_digest == sha1(block) == warc.first(fields, "WARC-Block-Digest")
        assert r.content_length == len(block) == int(warc.first(fields, "Content-Length"))
        assert r.source_record_digest == sha1(source_block)
        assert r.source_payload_digest == sha1(source_block.partition(b"\r\n\r\n")[2])
        assert [v for k, v in fields if k == "WARC-Type"] == [r.warc_type]
    assert len({(r.record_id, r.page_id) for r in rows}) == 8


def test_contents(spark):
    rows = {r.warc_type: r for r in warc.derive(warc.response_records(pages(spark).where("page_id = 1"))).collect()}
    _, text = warc.parse(rows["conversion"].record)
    assert text.decode() == "Kopf\neins zwei\ndrei <4>\nhierdanoch"
    about = warc.parse_fields(warc.parse(rows["metadata"].record)[1])
    assert ("title", "A & B") in about and ("language", "de") in about
    assert [v for k, v in about if k == "outlink"] == ["/x?a=1&b=2", "/y"]
    assert ("source-header-content-type", "text/html; charset=utf-8") in about


def test_text_of_odd_pages():
    assert warc.read_page("1 < 2 & 3 > 2 <unclosed").text == "1 < 2 & 3 > 2"
    assert warc.read_page("<script>never closed <p>gone").text == ""
    assert warc.read_page("").text == ""


def test_broken_and_other_records_give_nothing():
    assert warc.derived_records(b"") == []
    assert warc.derived_records(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nshort") == []
    other = warc.to_bytes([("WARC-Type", "request"), ("WARC-Record-ID", "<urn:uuid:1>")], b"GET /")
    assert warc.derived_records(other) == []


def test_folded_headers_and_latin_payload():
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html;\r\n charset=latin-1\r\n\r\n<p>\xe9t\xe9"
    record = warc.to_bytes([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>")], http)
    conversion = warc.derived_records(record)[1]
    assert warc.parse(conversion["record"])[1].decode() == "été" and conversion["refers_to"] == "<urn:uuid:1>"


def test_empty_table(spark):
    assert warc.derive(warc.response_records(pages(spark).limit(0))).collect() == []


class Plain(HTMLParser):
    """The same page as the standard library sees it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text, self.links, self.title, self.inside = [], [], None, []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "head", "title"):
            self.inside.append(tag)
        elif tag in ("p", "div", "h1", "li", "br"):
            self.text.append("\n")
        self.links += [v for k, v in attrs if tag == "a" and k == "href" and v not in self.links]

    def handle_endtag(self, tag):
        if tag in self.inside:
            self.inside.remove(tag)
        elif tag in ("p", "div", "h1", "li"):
            self.text.append("\n")

    def handle_comment(self, data):
        self.text.append(" ")

    def handle_data(self, data):
        if "title" in self.inside and self.title is None:
            self.title = data
        if not self.inside:
            self.text.append(data)


def test_pages_as_the_standard_parser_sees_them(spark):
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    rows = spark.read.parquet(f"{folder}/pages.parquet").collect()
    made = ["<html lang=en><head><title>T &lt; 1</title><script>if (a<b) '</p>'</script></head><body><div>x<p>y &amp; z"
            "<!-- <a href='/no'> --><A HREF='/u?a=1&amp;b=2'>v</A> <a name=x href=/w>w</a></div></body></html>"]
    for page in made + [r.html for r in rows if r.html]:
        plain = Plain()
        plain.feed(page)
        plain.close()
        found = warc.read_page(page)
        lines = (" ".join(x.split()) for x in "".join(plain.text).split("\n"))
        assert found.text == "\n".join(x for x in lines if x)
        assert found.links == plain.links and found.title == plain.title


def test_values_with_a_tag_end_and_open_values():
    page = warc.read_page("<a href='/a>b'>x</a><a href=\"/open>y</a><a data-href=/n>z</a><html xml:lang=a lang='pt-BR'>")
    assert page.links == ["/a>b", "/open"] and page.language == "pt-BR"


@pytest.mark.parametrize("part", [
    "<a ", "<a href=\"", "<a href='x>", "<html ", "<html lang ", "<p ", "<!--", "<script>", "<head>", "</head ", "<title>",
    "<", "&#", "&#0", "&#9", "&amp", "<a href", "<p>", " ", "href = ", "<a href=x>"])
def test_long_pages_of_open_tags(part):
    page = part * (4_000_000 // len(part))
    start = time.process_time()
    warc.read_page(page)
    assert time.process_time() - start < 20


def test_long_folded_header():
    head = b"A: 1" + b"\r\n x" * 300_000
    start = time.process_time()
    assert len(warc.parse_fields(head)[0][1]) == 600_001
    assert time.process_time() - start < 5


def test_odd_charsets():
    for name in ("idna", "punycode", "hex", "none-such", "utf-16"):
        assert isinstance(warc.decoded(b"\xff<p>abc" * 50, f"text/html; charset={name}"), str)


def test_extra_columns_are_not_read(spark):
    plain = pages(spark)
    more = plain.select("*", *[F.lit(7).alias(c) for c in ("record", "warc_type", "_metadata", "refers_to")])
    records = warc.response_records(more)
    wide = records.select("*", F.lit("x").alias("record_id"), F.lit(1).alias("content_length"))
    assert sorted(map(str, warc.derive(wide).collect())) == sorted(
        map(str, warc.derive(warc.response_records(plain)).collect()))
