"""Interleaved sequences of text and media.

HTML is parsed into an ordered list of text and media-reference structs; a reference names its payload by digest
(`media:sha256:<hex>`), and its position, caption and size attributes stay beside it. Payloads live in a written
table of digest and stored form, an 8-bit grey PNG of WIDTH samples a row; a join on the digest resolves
references to the stored form or to what was read from it. A task stores a payload that it meets again once, and
the table is made distinct by digest where it is read, on small rows.

Edge cases: null text counts as empty and gives one row of filler samples; equal texts share a payload and have
equal values; null html has no items; a reference without a stored payload keeps nulls; repeated rows give rows
each; an empty table gives no rows; the caption of a figure is its figcaption, else the image's alt text; malformed
HTML parses as far as it goes, nested to any depth, and what follows an unclosed script gives no items.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytolake.llm.common import docs_of, lean, shared_dir, slices, table

WIDTH, FILL = 576, 255
SEEN = 100_000
PREFIX = "media:sha256:"


def to_png(payload: bytes, width: int = WIDTH) -> bytes:
    """Grey 8-bit samples, row by row, unfiltered."""
    height = len(payload) // width
    rows = np.zeros((height, width + 1), np.uint8)
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(height, width)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 1)) + chunk(b"IEND", b"")


def from_png(data: bytes) -> tuple[int, int, bytes]:
    """Width, height and samples of what to_png has written."""
    at, body, width, height = 8, [], 0, 0
    while at < len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        if kind == b"IHDR":
            width, height = struct.unpack_from(">II", data, at + 8)
        elif kind == b"IDAT":
            body.append(data[at + 8 : at + 8 + size])
        at += 12 + size
    rows = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width + 1)
    return width, height, rows[:, 1:].tobytes()


def feature(width: int, height: int, samples: bytes) -> str:
    """Size, mean, deviation and the share of samples, in thousandths, in each eighth of the range."""
    count = np.bincount(np.frombuffer(samples, np.uint8), minlength=256)
    n, level = int(count.sum()), np.arange(256)
    total, square = int((count * level).sum()), int((count * level * level).sum())
    eighths = (count.reshape(8, 32).sum(1) * 1000 // max(n, 1)).tolist()
    return f"{width}x{height};mean={total / n:.4f};sd={max(square / n - (total / n) ** 2, 0) ** 0.5:.4f};hist={','.join(map(str, eighths))}"


class _Items(HTMLParser):
    SKIP = {"script", "style", "noscript", "template"}
    BREAK = {"p", "div", "li", "br", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "td", "article", "section", "figure", "figcaption", "ul", "ol", "table", "nav", "header", "footer", "blockquote", "pre", "title"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.text: list[str] = []
        self.skip = 0
        self.figure: int | None = None
        self.caption: list[str] | None = None

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text = []
        if text:
            self.items.append({"kind": "text", "text": text})

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in self.SKIP:
            self.skip += 1
        elif tag in ("img", "video", "audio", "source") and a.get("src"):
            self.flush()
            src = a["src"]
            size = a.get("data-bytes") or ""
            self.items.append({"kind": "media", "src": src, "digest": src[len(PREFIX) :].lower() if src.startswith(PREFIX) else None, "caption": a.get("alt") or None, "n_bytes": int(size) if size.isdigit() else None})
        elif tag in self.BREAK:
            self.flush()
            if tag == "figure":
                self.figure = len(self.items)
            elif tag == "figcaption":
                self.caption = []

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.skip = max(0, self.skip - 1)
        elif tag == "figcaption" and self.caption is not None:
            text, self.caption = " ".join("".join(self.caption).split()), None
            for item in self.items[self.figure or 0 :] if self.figure is not None else []:
                if item["kind"] == "media" and text:
                    item["caption"] = text
        elif tag in self.BREAK:
            self.flush()
            if tag == "figure":
                self.figure = None

    def handle_data(self, data):
        if not self.skip:
            (self.text if self.caption is None else self.caption).append(data)


def parse_items(html: str | None) -> list[dict]:
    p = _Items()
    p.feed(html or "")
    p.close()
    p.flush()
    return p.items


_ITEM = pa.struct([("pos", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("src", pa.string()), ("digest", pa.string()), ("caption", pa.string()), ("n_bytes", pa.int64())])
ITEMS = "array<struct<pos:int,kind:string,text:string,src:string,digest:string,caption:string,n_bytes:bigint>>"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items = [[{"pos": i, **x} for i, x in enumerate(parse_items(h))] for h in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(items, pa.list_(_ITEM))], names=["doc_id", "items"])


def sequences(pages: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """doc_id and items of each page: text and media references in document order."""
    return pages.select(F.col(id_column).cast("long").alias("doc_id"), F.col("html").cast("string").alias("html")).mapInArrow(lean(_parse), f"doc_id long, items {ITEMS}")


def payload_of(text):
    """UTF-8 bytes of a text and filler up to a positive multiple of WIDTH."""
    n = F.octet_length(text)
    short = F.when(n == 0, F.lit(WIDTH)).otherwise(F.pmod(-n, F.lit(WIDTH)))
    return F.concat(F.encode(text, "utf-8"), F.unhex(F.repeat(F.lit(f"{FILL:02X}"), short.cast("int"))))


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[str] = set()
    for part in slices(batches, "payload"):
        out = []
        for digest, payload in zip(part.column(0).to_pylist(), part.column(1), strict=True):
            if digest not in seen:
                seen.add(digest)
                out.append((digest, to_png(payload.as_py())))
        if len(seen) > SEEN:
            seen.clear()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.binary())], names=["digest", "media"])


def store_media(payloads: DataFrame, path: str) -> DataFrame:
    """Writes the stored form of digest, payload rows to path, and returns the table; a digest may be there more than once."""
    payloads.mapInArrow(lean(_store), "digest string, media binary").write.mode("overwrite").parquet(path)
    return payloads.sparkSession.read.parquet(path)


_FEATURES = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "media"):
        out = []
        for digest, media in zip(part.column(0).to_pylist(), part.column(1), strict=True):
            raw = media.as_py()
            width, height, samples = from_png(raw)
            out.append((digest, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), len(raw), hashlib.sha256(raw).hexdigest(), feature(width, height, samples)))
        names = [x.split()[0] for x in _FEATURES.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def media_features(media: DataFrame) -> DataFrame:
    """What the stored bytes say, one row for each digest."""
    return media.select("digest", "media").mapInArrow(lean(_features), _FEATURES).dropDuplicates(["digest"])


def resolve(items: DataFrame, payloads: DataFrame) -> DataFrame:
    """A row for each item (doc_id, pos, kind, text, src, digest, caption, n_bytes) with the columns of payloads, a table with one row for each digest."""
    return items.select("doc_id", F.inline("items")).join(payloads, "digest", "left")


def op8_media(spark, sf_dir: str) -> DataFrame:
    docs = docs_of(table(spark, sf_dir, "documents"))
    payload = docs.select(payload_of(F.col("text")).alias("payload")).select(F.sha2("payload", 256).alias("digest"), "payload")
    media = store_media(payload, shared_dir(spark, "media"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("unnamed"))
    page = F.concat(F.lit("<article><h1>Document "), name, F.lit('</h1><p>Its text follows as samples.</p><figure><img src="' + PREFIX), F.sha2(payload_of(F.col("text")), 256), F.lit('" data-bytes="'), F.octet_length("text").cast("string"), F.lit('" alt="samples"><figcaption>Text of document '), name, F.lit("</figcaption></figure><p>End.</p></article>"))
    items = sequences(docs.select("doc_id", page.alias("html")))
    got = resolve(items, media_features(media)).where("kind = 'media'")
    return got.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "caption", F.col("pos").cast("long").alias("pos"))
