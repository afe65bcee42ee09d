"""WARC derivatives against another reader of pages and records, and hostile input."""

import base64
import gzip
import hashlib
import json
import re
import time
import uuid
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F
from tests_llm_helpers import SF

from tidewater.llm import op3_warc
from tidewater.llm.queries import QUERIES

BLOCKS = set("address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
HIDDEN = set("script style noscript template svg title".split())
ADDRESS = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "form": "action"}


class Reader(HTMLParser):
    """What a page shows and tells, by the standard library's parser."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.text, self.title, self.links, self.metas, self.inside = [], None, [], [], []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in ADDRESS and (url := dict(attrs).get(ADDRESS[tag])):
            self.links.append({"path": f"{tag.upper()}@/{ADDRESS[tag]}", "url": url})
        if tag == "meta":
            self.metas.append({k: v or "" for k, v in attrs})
        if tag in HIDDEN:
            self.inside.append(tag)
            self.text.append(" ")
        if tag in BLOCKS and not self.inside:
            self.text.append("\n")

    def handle_endtag(self, tag):
        if tag in self.inside:
            self.inside.remove(tag)
        elif tag in BLOCKS and not self.inside:
            self.text.append("\n")

    def handle_data(self, data):
        if "title" in self.inside and self.title is None:
            self.title = data.strip()
        elif not self.inside:
            self.text.append(re.sub(r"[\r\n]", " ", data))

    def shown(self):
        lines = (re.sub(r"\s+", " ", x).strip() for x in "".join(self.text).split("\n"))
        return "\n".join(x for x in lines if x)


def sha1(block):
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def by_hand(page_id, url, html):
    """The two records of a page, put together line by line."""
    url, html = url or "", html or ""
    urn = lambda of: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, of)}>"
    source = urn(f"response {page_id} {url}")
    payload = html.encode()
    status = "HTTP/1.1 200 OK"
    http = f"{status}\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    seen = Reader(html)
    told = {"Envelope": {
        "WARC-Header-Metadata": {"WARC-Type": "response", "WARC-Record-ID": source, "WARC-Target-URI": url, "WARC-Date": op3_warc.DATE, "WARC-Block-Digest": sha1(http + payload), "WARC-Payload-Digest": sha1(payload)},
        "Payload-Metadata": {"HTTP-Response-Metadata": {"Response-Message": status, "Headers": {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload))},
                                                        "HTML-Metadata": {"Title": seen.title, "Metas": seen.metas, "Links": seen.links}}}}}
    out = []
    for kind, content, block in (("metadata", "application/json", json.dumps(told, ensure_ascii=False)), ("conversion", "text/plain", seen.shown())):
        block = block.encode()
        lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {urn(f'{kind} {source}')}", f"WARC-Refers-To: {source}", f"WARC-Target-URI: {url}", f"WARC-Date: {op3_warc.DATE}",
                 f"WARC-Block-Digest: {sha1(block)}", f"Content-Type: {content}", f"Content-Length: {len(block)}", "", ""]
        record = "\r\n".join(lines).encode() + block
        out.append((page_id, kind, source, url, len(block), len(seen.links), hashlib.sha256(record).hexdigest()))
    return out


def test_the_query_equals_another_reader(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()
    got = QUERIES["op3_warc_derivatives"](spark, SF).select("page_id", "warc_type", "refers_to", "target_uri", "length", "links", "record_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == sorted((r for p in pages for r in by_hand(*p)), key=str)


@pytest.mark.parametrize("part", ["<title>", "<script ", "<meta ", "<a href='", "<!-- ", "<svg ", "</title ", "<title a=b>x</", "<script>", "a", "a=", "&amp", "<p ", "<a <b", "<style>x</style", "<svg/>"])
def test_a_hostile_page_of_a_megabyte_takes_no_second(part):
    for page in ((part * (1 << 20))[: 1 << 20], "<a " + (part * (1 << 20))[: 1 << 20] + ">"):
        began = time.process_time()
        op3_warc.visible_text(page)
        op3_warc.envelope(page)
        assert time.process_time() - began < 1


def test_every_header_is_kept():
    h = op3_warc.Headers(["Set-Cookie: a=1", "X:y", "set-cookie: b=2", " more", "no header", ": none", "\tfolded", "Empty:"])
    assert h.told() == {"Set-Cookie": ["a=1", "b=2 more folded"], "X": "y", "Empty": ""}
    assert h.get("SET-COOKIE") == "a=1" and "x" in h and h.get("z") is None


def test_repeated_source_headers_reach_the_envelope(spark):
    http = "HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2\r\ncontent-type:text/html\r\n\r\n"
    rows = [("<id>", "http://a/", "d", "b", "p", http, "<p>x")]
    record = op3_warc.derive(spark.createDataFrame(rows, op3_warc.RESPONSE)).where("warc_type = 'metadata'").first().record
    told = json.loads(record.split("\r\n\r\n", 1)[1])
    assert told["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]["Headers"] == {"Set-Cookie": ["a=1", "b=2"], "content-type": "text/html"}


def one(uri, page, length="content-length", extra=b""):
    block = f"HTTP/1.1 200 OK\r\nX: y\r\n\r\n{page}".encode()
    return b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <%s>\r\nwarc-target-uri: %s\r\n%s%s: %d\r\n\r\n" % (uri, uri, extra, length.encode(), len(block)) + block + b"\r\n\r\n"


def test_awkward_files(spark, tmp_path):
    good, other = one(b"http://a/", "one WARC/1.0 \r\n\r\n two"), one(b"http://b/", "zwei", extra=b"X-\xff\xfe: \xff\r\n")
    none = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: many\r\n\r\nblock\r\n\r\n"
    files = {
        "plain.warc": good + none + other,
        "cut.warc": good + other[:-20],
        "cut_head.warc": good + b"WARC/1.0\r\nWARC-Type: resp",
        "by_record.warc.gz": b"".join(map(gzip.compress, (good, other))),
        "whole.warc.gz": gzip.compress(good + other),
        "cut.warc.gz": gzip.compress(good) + gzip.compress(other)[:-30],
        "noise.warc.gz": gzip.compress(good) + b"\x1f\x8bnoise",
        "empty.warc": b"",
    }
    want = {"plain.warc": 2, "cut.warc": 1, "cut_head.warc": 1, "by_record.warc.gz": 2, "whole.warc.gz": 2, "cut.warc.gz": 1, "noise.warc.gz": 1, "empty.warc": 0}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
        rows = op3_warc.read_warc(spark, str(tmp_path / name)).orderBy("target_uri").collect()
        assert len(rows) == want[name], name
        if rows:
            assert (rows[0].target_uri, rows[0].record_id, rows[0].payload) == ("http://a/", "<http://a/>", "one WARC/1.0 \r\n\r\n two")
            assert rows[0].http.endswith("X: y\r\n\r\n") and rows[0].payload_digest == sha1(rows[0].payload.encode())
    assert op3_warc.read_warc(spark, str(tmp_path)).count() == sum(want.values())


def test_many_small_members_are_read_in_linear_time():
    data = gzip.compress(one(b"http://a/", "x")) * 20_000
    began = time.process_time()
    assert sum(1 for m in op3_warc.members(data) for _ in op3_warc.parsed(m)) == 20_000
    assert time.process_time() - began < 10


def test_ids_hold_across_columns(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x", "z")], "page_id long, url string, html string, record string")
    assert op3_warc.derive(op3_warc.responses_of(pages)).select(F.count("*")).first()[0] == 2
