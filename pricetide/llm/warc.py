"""Metadata and plain-text records from archived responses.

A record is a row: record_id, record_type, target_uri, date, refers_to, concurrent_to,
content_type, block (bytes), block_digest, payload_digest. From each response come a
conversion record (the page's text) and a metadata record (source headers and digests,
title, links, JSON); both refer to the response and the metadata names the conversion.
"""

import base64
import hashlib
import html
import json
import re
import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from pricetide.llm.shipping import map_batches

RECORD = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, concurrent_to string, "
    "content_type string, block binary, block_digest string, payload_digest string"
)
#: Headers of a record in the order they are written, with the column each comes from.
HEADERS = {
    "WARC-Type": "record_type",
    "WARC-Record-ID": "record_id",
    "WARC-Date": "date",
    "WARC-Target-URI": "target_uri",
    "WARC-Refers-To": "refers_to",
    "WARC-Concurrent-To": "concurrent_to",
    "WARC-Block-Digest": "block_digest",
    "WARC-Payload-Digest": "payload_digest",
    "Content-Type": "content_type",
}
VERSION = "WARC/1.1"
_MARKUP = re.compile(r"<(?:(!--)|(!|\?(?=[a-zA-Z]))|(/?)([a-zA-Z][^\s/>]*+))")
#: What follows a tag's name: signs up to the first > that is in no quoted value.
_ATTRIBUTES = re.compile(r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)>""")
_ADDRESS = re.compile(
    r"""(?:^|[\s/"'])(href|src)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))|=\s*+(?:"[^"]*+"|'[^']*+')""", re.I
)
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in ("script", "style")}
#: Elements whose content is not shown, though it is markup.
UNSHOWN = {"noscript", "template", "svg"}
LINKING = {"a", "area", "link", "img", "script", "iframe", "source"}
BREAKS = set(
    "address article aside blockquote body br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 head header hr "
    "html li main nav ol p pre section table tbody td tfoot th thead title tr ul".split()
)
_BLANK = re.compile(r"[ \t\r\f\v]+")
_LINES = re.compile(r" ?\n[ \n]*")


def markup(page):
    """(start, stop, name, closes, attributes) of the tags, comments ("!--") and declarations ("") of a page.

    A script or style goes from its tag to the end of its end tag, without one to the page's
    end. Of a comment that nothing closes only the opening is one. A tag without an end
    though quotes are open turns the quotes of the rest of the page into common signs, so
    that no part is looked at more than a few times; what has no > behind it is text.
    """
    at, quotes, comments = 0, True, True
    while found := _MARKUP.search(page, at):
        start, at = found.span()
        name = (found[4] or "").lower()
        if found[1]:
            end = _COMMENT_END.search(page, start + 2) if comments else None
            comments = end is not None
            at = end.end() if end else at
            yield start, at, "!--", False, ""
            continue
        tag = _ATTRIBUTES.match(page, at) if quotes and name else None
        if tag:
            attributes, at = tag[1], tag.end()
        else:
            quotes = quotes and not name
            end = page.find(">", at)
            if end < 0:
                return
            attributes, at = page[at:end], end + 1
        if name in _RAW_END and not found[3]:
            end = _RAW_END[name].search(page, at)
            at = (page.find(">", end.end()) + 1 or len(page)) if end else len(page)
        yield start, at, name, bool(found[3]), attributes


def hidden_spans(found):
    """(start, stop) of comments and of elements whose content is not shown, of what `markup` found.

    A self-closed tag hides itself alone, as does what opens an svg, noscript or template
    that nothing closes.
    """
    spans, opened = [], {}
    for start, stop, name, closes, attributes in found:
        if name == "!--" or name in _RAW_END:
            spans.append((start, stop))
        elif name in UNSHOWN:
            first = opened[name].pop() if closes and opened.get(name) else start
            spans.append((first, stop))
            if not closes and not attributes.endswith("/"):
                opened.setdefault(name, []).append(start)
    return spans


def shown(page, found):
    """The visible text of a page, a line for each block of it, and the text of its title (None without one)."""
    hidden = [(a, b, " ", "") for a, b in hidden_spans(found)]
    tags = [
        (start, stop, "\n" if name in BREAKS else "", "/" * closes + name)
        for start, stop, name, closes, _ in found
        if name != "!--" and name not in _RAW_END and name not in UNSHOWN
    ]
    out, end, title = [], 0, None
    for start, stop, sign, name in sorted(hidden + tags):
        if start >= end:
            out += [page[end:start], sign]
            if name == "title" and title is None:
                title = len(out)
            elif name == "/title" and isinstance(title, int):
                title = plain_text("".join(out[title:]))
        end = max(end, stop)
    return plain_text("".join([*out, page[end:]])), title if isinstance(title, str) else None


def plain_text(text):
    """Text between tags, line breaks put in as lines; those of the source are none."""
    if "&" in text:
        text = html.unescape(text)
    return _LINES.sub("\n", _BLANK.sub(" ", text)).strip()


def links_of(found):
    """[{path, url}] of the tags that `markup` found: the first href or src that has a value."""
    links = []
    for _, _, name, closes, attributes in found:
        if name in LINKING and not closes:
            address = next((m for m in _ADDRESS.finditer(attributes) if m[1]), None)
            if address:
                links.append({"path": name, "url": html.unescape(address[2] or address[3] or address[4] or "")})
    return links


def page_facts(page):
    """(text, title, links) of a page, read once."""
    page = page.replace("\n", " ")
    found = list(markup(page))
    return *shown(page, found), links_of(found)


def page_text(page):
    """The visible text of a page, a line for each block of it."""
    return page_facts(page)[0]


def page_links(page):
    """[{path, url}] in the order of the page; comments and scripts hold none."""
    return page_facts(page)[2]


def digest(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_name(*parts):
    """A record id that depends on nothing but its parts, so that a repeated task gives the same."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts))}>"


def split_response(block):
    """(status line, headers, body) of an HTTP response; a block without a head is all body."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"HTTP/"):
        return "", [], block
    lines = head.decode("latin-1").split("\r\n")
    pairs = [line.partition(":") for line in lines[1:] if ":" in line]
    return lines[0], [[k.strip(), v.strip()] for k, _, v in pairs], body


def body_text(headers, body):
    """The body decoded by the character set of its headers, UTF-8 if there is none or it is unknown."""
    kind = next((v for k, v in headers if k.lower() == "content-type"), "")
    found = re.search(r"charset=[\"']?([\w.:-]+)", kind, re.I)
    try:
        return body.decode(found[1] if found else "utf-8", errors="replace")
    except LookupError:
        return body.decode(errors="replace")


def _derive(row):
    source = row["record_id"] or ""
    block = row["block"] or b""
    status, headers, body = split_response(block)
    page = body_text(headers, body)
    payload = row["payload_digest"] or digest(body)
    text, title, links = page_facts(page)
    text = text.encode()
    conversion_id = record_name("conversion", source, payload)
    facts = {
        "source": {
            "WARC-Record-ID": row["record_id"],
            "WARC-Target-URI": row["target_uri"],
            "WARC-Date": row["date"],
            "WARC-Block-Digest": row["block_digest"] or digest(block),
            "WARC-Payload-Digest": payload,
            "Content-Length": len(block),
        },
        "http": {"status": status, "headers": headers},
        "title": title,
        "links": links,
        "conversion": conversion_id,
    }
    metadata = json.dumps(facts, ensure_ascii=False, sort_keys=True).encode()
    shared = {"target_uri": row["target_uri"], "date": row["date"], "refers_to": row["record_id"]}
    yield shared | {
        "record_id": record_name("metadata", source, payload),
        "record_type": "metadata",
        "concurrent_to": conversion_id,
        "content_type": "application/json",
        "block": metadata,
        "block_digest": digest(metadata),
        "payload_digest": payload,
    }
    yield shared | {
        "record_id": conversion_id,
        "record_type": "conversion",
        "concurrent_to": None,
        "content_type": "text/plain; charset=UTF-8",
        "block": text,
        "block_digest": digest(text),
        "payload_digest": payload,
    }


_ARROW = pa.schema(
    [(f.strip().split()[0], pa.binary() if f.strip().endswith("binary") else pa.string()) for f in RECORD.split(",")]
)
ROWS_AT_ONCE = 200


def _derive_batches(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            rows = batch.slice(start, ROWS_AT_ONCE).to_pylist()
            yield pa.RecordBatch.from_pylist([out for row in rows for out in _derive(row)], schema=_ARROW)


def derivatives(records):
    """Metadata and conversion records of the responses among `records`, two rows for each.

    Records of other types and extra columns are passed over. The payload digest of both is
    the response's own where it has one, else that of its body; `refers_to` is its id. A
    null or empty block gives an empty text and no links; null ids, addresses and dates stay
    null. Repeated responses give repeated rows with equal ids. No responses give no rows.
    """
    columns = [F.col(f.strip().split()[0]).cast(f.strip().split()[1]) for f in RECORD.split(",")]
    responses = records.where(F.col("record_type") == "response").select(*columns)
    return map_batches(responses, _derive_batches, RECORD)


def responses(pages, html_column="html", url="url", key="page_id", date="2024-01-01T00:00:00Z"):
    """Response records of a table of pages. The record id is a UUID made of key and address."""

    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    def base32(data):
        """Spark has no base32; hexadecimal digits mark the digest as such."""
        return F.concat(F.lit("sha1:"), F.sha1(data))

    name = F.md5(F.concat_ws("\n", F.lit("response"), text(key), text(url)).cast("binary"))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    body = text(html_column).cast("binary")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(head.cast("binary"), body)
    return pages.select(
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
        F.lit("response").alias("record_type"),
        F.col(url).cast("string").alias("target_uri"),
        F.lit(date).alias("date"),
        F.lit(None).cast("string").alias("refers_to"),
        F.lit(None).cast("string").alias("concurrent_to"),
        F.lit("application/http; msgtype=response").alias("content_type"),
        block.alias("block"),
        base32(block).alias("block_digest"),
        base32(body).alias("payload_digest"),
        F.col(key).alias("source_key"),
    )


def write_records(records, path, compression="none"):
    """Write records as WARC files, one for each task. Blocks have to be UTF-8, as those of `derivatives` are."""
    fields = [
        F.when(F.col(column).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(column), F.lit("\r\n")))
        for name, column in HEADERS.items()
    ]
    length = F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string"), F.lit("\r\n\r\n"))
    record = F.concat_ws("", F.lit(f"{VERSION}\r\n"), *fields, length, F.col("block").cast("string"))
    # two line ends follow each record
    records.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)


def read_records(spark, path):
    """Records of WARC files, split by Spark at the version line that begins each.

    Adds `complete`: false where a block holds fewer bytes than its Content-Length says,
    as when the block itself has such a line in it.
    """

    def parse(batches):
        schema = pa.schema([*_ARROW, ("complete", pa.bool_())])
        for batch in batches:
            out = []
            for data in batch.column(0).cast(pa.binary()).to_pylist():
                head, mark, block = data.partition(b"\r\n\r\n")
                if not mark:
                    continue
                lines = [line.partition(": ") for line in head.decode().split("\r\n")]
                found = {k.lower(): v for k, _, v in lines}
                length = int(found.get("content-length", 0))
                row = {column: found.get(name.lower()) for name, column in HEADERS.items()}
                out.append(row | {"block": block[:length], "complete": len(block) >= length})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    chunks = spark.read.option("lineSep", f"{VERSION}\r\n").text(path).where(F.length("value") > 0)
    return map_batches(chunks, parse, RECORD + ", complete boolean")
