"""WARC derivative builder: responses become linked metadata and plain-text conversion records.

For each response record two records are derived, both of which refer to it (``WARC-Refers-To``):
``metadata``, a JSON envelope with the source record's headers and digests, the HTTP status and headers,
title, description, canonical address and links; and ``conversion``, the page's visible text.  Each
gets a block digest of its own; ids are UUIDs of the response's id and the kind, so a rerun derives the
same ones.

``responses_of`` makes response records of rows of (page_id, url, html), ``read_warc`` of WARC files
(plain or gzip, by record or whole).  ``write_warc`` writes derived records with Spark's text writer: a
record's end (CRLF CRLF) is the line separator, so the parts are valid WARC files.

Pages are read in one pass: every search goes on where the one before ended, and what isn't found once is
not looked for again, so hostile pages (open tags without end, in any number) take time by their length.

Defined cases: a null url or html is empty, and yields records with empty fields; repeated rows yield
records with repeated ids; an empty table an empty one; further columns are ignored.  Each row is worked
on by itself, so no key can be hot.  Header names go without case, a repeated header keeps all its values
(a list of them in the envelope), a folded line belongs to the one before; header bytes that aren't UTF-8
are replaced; a record that is cut off, or has no length, is left out.  A packed file is unpacked member by
member, so that a task holds the file as it is stored and one record.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns_of

DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
#: Bytes of a packed file that are unpacked at a time.
PIECE = 1 << 16
RESPONSE = "record_id string, target_uri string, date string, block_digest string, payload_digest string, http string, payload string"
RECORD = "refers_to string, record_id string, warc_type string, target_uri string, block_digest string, length long, links long, record string"

#: What begins a hidden part.  Not <head>: its end tag may be left out, and what it may hold is hidden by
#: itself.  A name ends at a blank, / or >.
_HIDDEN = re.compile(r"<!--|<(script|style|noscript|template|svg|title)(?=[\s/>])", re.IGNORECASE)
_END_OF = {n: re.compile(rf"</{n}\s*>", re.IGNORECASE) for n in ("script", "style", "noscript", "template", "svg", "title")}
_BLOCK = re.compile(r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)(?=[\s/>])[^>]*>", re.IGNORECASE)
_TAG = re.compile(r"</?[a-zA-Z!?][^>]*(?:>|\Z)")
_BLANKS = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.DOTALL)
_TITLE = re.compile(r"<title(?=[\s/>])[^>]*>", re.IGNORECASE)
_LINK = re.compile(r"<(a|area|img|link|script|iframe|form)(?=[\s/>])([^>]*)>", re.IGNORECASE)
_META = re.compile(r"<meta(?=[\s/>])([^>]*)>", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""(?<![a-zA-Z:_-])([a-zA-Z:_-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_ADDRESS = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "form": "action"}


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def urn(of: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, of)}>"


def closed(page: str) -> str:
    """The page up to its last ``>``: behind it no tag ends, so none needs to be looked for."""
    return page[: page.rfind(">") + 1]


def shown_parts(page: str) -> Iterator[str]:
    """What stands between comments, scripts, styles and the like, and titles."""
    at, tags_until, without_end = 0, page.rfind(">"), set()
    while m := _HIDDEN.search(page, at):
        name = (m[1] or "").lower()
        end = page.find("-->", m.end()) if not name else page.find(">", m.end()) if m.end() <= tags_until else -1
        if name and end < 0:  # a tag that isn't closed, nor is any behind it
            break
        yield page[at : m.start()]
        if not name:
            if end < 0:
                return
            at = end + 3
            continue
        at = end + 1
        if name == "svg" and page[end - 1] == "/" or name in without_end:
            continue
        if last := _END_OF[name].search(page, at):
            at = last.end()
        elif name == "title":  # its end is left out: only the tag is hidden
            without_end.add(name)
        else:
            return
    yield page[at:]


def visible_text(page: str) -> str:
    """The page's text: a line for each block, blanks folded, entities resolved."""
    t = " ".join(shown_parts(page)).replace("\n", " ").replace("\r", " ")
    tags = closed(t)
    t = entities.unescape(_TAG.sub("", _BLOCK.sub("\n", tags) + t[len(tags) :]))
    return _LINES.sub("\n", _BLANKS.sub(" ", t)).strip()


def attributes(tag: str) -> dict[str, str]:
    return {m[0].lower(): entities.unescape(m[1] or m[2] or m[3]) for m in _ATTRIBUTE.findall(tag)}


def envelope(page: str) -> dict:
    """Title, metas and links of a page."""
    shown = _COMMENT.sub("", page)
    tags = closed(shown)
    title, said = _TITLE.search(tags), None
    if title:
        end = _END_OF["title"].search(shown, title.end())
        said = entities.unescape(shown[title.end() : end.start() if end else len(shown)]).strip()
    links = []
    for tag, rest in _LINK.findall(tags):
        got = attributes(rest)
        if address := got.get(_ADDRESS[tag.lower()]):
            links.append({"path": f"{tag.upper()}@/{_ADDRESS[tag.lower()]}", "url": address})
    metas = [attributes(m) for m in _META.findall(tags)]
    return {"Title": said, "Metas": [m for m in metas if m], "Links": links}


class Headers:
    """Header lines in their order; names go without case."""

    def __init__(self, lines: list[str]):
        self.pairs: list[tuple[str, str]] = []
        for line in lines:
            name, colon, value = line.partition(":")
            if line[:1] in (" ", "\t") and self.pairs:
                before, said = self.pairs[-1]
                self.pairs[-1] = before, f"{said} {line.strip()}".strip()
            elif colon and name.strip():
                self.pairs.append((name.strip(), value.strip()))

    def all(self, name: str) -> list[str]:
        return [v for k, v in self.pairs if k.lower() == name.lower()]

    def get(self, name: str) -> str | None:
        return next(iter(self.all(name)), None)

    def __getitem__(self, name: str) -> str:
        return self.all(name)[0]

    def __contains__(self, name: str) -> bool:
        return bool(self.all(name))

    def told(self) -> dict[str, str | list[str]]:
        """By name, as first written; a repeated header as the list of its values."""
        first = {k.lower(): k for k, _ in reversed(self.pairs)}
        return {k: found if len(found := self.all(k)) > 1 else found[0] for k in dict.fromkeys(first[k.lower()] for k, _ in self.pairs)}


def responses_of(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of pages (page_id, url, html): RESPONSE, with page_id."""
    p = columns_of(pages, "page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                b = whole.slice(a, 256)
                rows = []
                for i, url, page in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                    url, page = url or "", page or ""
                    payload = page.encode()
                    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                    rows.append((urn(f"response {i} {url}"), url, date, digest(http.encode() + payload), digest(payload), http, page))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([b.column("page_id"), *[pa.array(c, pa.string()) for c in columns]], names=["page_id", *names(RESPONSE)])

    return p.mapInArrow(run, f"page_id {p.schema['page_id'].dataType.simpleString()}, {RESPONSE}")


def names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def record(headers: list[tuple[str, str]], block: bytes) -> str:
    plain = lambda v: re.sub(r"[\r\n]+", " ", v)  # noqa: E731  an address can't bring in headers of its own
    head = "".join(f"{k}: {plain(v)}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return f"WARC/1.0\r\n{head}\r\n{block.decode()}"


def derive(responses: DataFrame) -> DataFrame:
    """The metadata and the conversion record of each response: RECORD, with its other columns' page_id
    if it has one.  ``record`` is the record as it stands in a file, without its end."""
    keep = ["page_id"] if "page_id" in responses.columns else []
    r = columns_of(responses, *keep, *names(RESPONSE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                b = whole.slice(a, 256)
                rows = []
                for source, uri, date, block_digest, payload_digest, http, page in zip(*(b.column(c).to_pylist() for c in names(RESPONSE)), strict=True):
                    source, uri, date, page = source or "", uri or "", date or "", page or ""
                    status, _, rest = (http or "").partition("\r\n")
                    fields = Headers(rest.split("\r\n")).told()
                    found = envelope(page)
                    told = {
                        "Envelope": {
                            "WARC-Header-Metadata": {"WARC-Type": "response", "WARC-Record-ID": source, "WARC-Target-URI": uri, "WARC-Date": date, "WARC-Block-Digest": block_digest, "WARC-Payload-Digest": payload_digest},
                            "Payload-Metadata": {"HTTP-Response-Metadata": {"Response-Message": status, "Headers": fields, "HTML-Metadata": found}},
                        }
                    }
                    linked = [("WARC-Refers-To", source), ("WARC-Target-URI", uri), ("WARC-Date", date)]
                    for kind, content, block in (("metadata", "application/json", json.dumps(told, ensure_ascii=False).encode()), ("conversion", "text/plain", visible_text(page).encode())):
                        own, mine = urn(f"{kind} {source}"), digest(block)
                        head = [("WARC-Type", kind), ("WARC-Record-ID", own), *linked, ("WARC-Block-Digest", mine), ("Content-Type", content)]
                        rows.append((source, own, kind, uri, mine, len(block), len(found["Links"]), record(head, block)))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.string()] * 5 + [pa.int64()] * 2 + [pa.string()], strict=True)]
                ids = [pa.array([x for x in b.column(k).to_pylist() for _ in range(2)], b.schema.field(k).type) for k in keep]
                yield pa.RecordBatch.from_arrays([*ids, *columns], names=[*keep, *names(RECORD)])

    kept = "".join(f"{k} {r.schema[k].dataType.simpleString()}, " for k in keep)
    return r.mapInArrow(run, kept + RECORD)


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """The records as WARC files, one for each partition."""
    records.select("record").write.option("lineSep", END).option("compression", compression).text(path)


def parsed(data: bytes) -> Iterator[tuple[Headers, bytes]]:
    """(headers, block) of each whole record of a WARC file's bytes, by its Content-Length."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        head_end = data.find(END.encode(), at)
        if head_end < 0:
            return
        head = Headers(data[at:head_end].decode(errors="replace").split("\r\n")[1:])
        start, length = head_end + len(END), head.get("Content-Length") or ""
        if not length.isdecimal():
            at = start
            continue
        at = start + int(length)
        if at <= len(data):
            yield head, data[start:at]


def members(data: bytes) -> Iterator[bytes]:
    """The members of a packed file, one at a time (of a cut-off one, what there is); a plain file as it is."""
    view, at = memoryview(data), 0
    while bytes(view[at : at + 2]) == b"\x1f\x8b":
        unpack, parts = zlib.decompressobj(wbits=31), []
        try:
            while at < len(view) and not unpack.eof:
                some = view[at : at + PIECE]
                parts.append(unpack.decompress(some))
                at += len(some) - len(unpack.unused_data)
        except zlib.error:
            at = len(view)
        yield b"".join(parts)
    if at < len(view):
        yield bytes(view[at:])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The response records of WARC files under ``path`` (RESPONSE).  A file is read as one value, as it is
    stored, so files should be of the customary 1 GB at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                data = content.as_py()
                rows = []
                for head, block in (r for part in members(data) for r in parsed(part)):
                    if (head.get("WARC-Type") or "").lower() == "response":
                        http, _, page = block.partition(END.encode())
                        rows.append((head.get("WARC-Record-ID"), head.get("WARC-Target-URI"), head.get("WARC-Date"), head.get("WARC-Block-Digest") or digest(block), head.get("WARC-Payload-Digest") or digest(page), http.decode(errors="replace") + END, page.decode(errors="replace")))
                    if len(rows) >= 256:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=names(RESPONSE))
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=names(RESPONSE))

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RESPONSE)


def response_record(c: str = "") -> Column:
    """The text of a response record, to write with ``write_warc``."""
    of = lambda name: F.coalesce(F.col(f"{c}{name}"), F.lit(""))
    block = F.concat(of("http"), of("payload"))
    crlf = F.lit("\r\n")
    head = [F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: "), of("record_id"), crlf]
    for name, column in (("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"), ("WARC-Payload-Digest", "payload_digest")):
        head += [F.lit(f"{name}: "), of(column), crlf]
    return F.concat(*head, F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)
