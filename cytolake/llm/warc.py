"""WARC archives of individually compressed records under a shared dictionary.

An archive is a skippable frame with a Zstandard dictionary, built from the archive's own records, and then one
Zstandard frame for each record. Pages with equal payloads of at least MIN_REVISIT bytes are one response (the
least page_id) and revisits of it. A task sorts its records by page, buffers at most ARCHIVE_BYTES, writes the archive
under a name that its attempt alone has, and moves it to a name made from the digest of its contents: attempts of a task
that cut the same records differently never replace each other's files, and equal files have one name. The list of
archives is a written table, and it alone says which files count; `orphans` names the others.

Edge cases: null html counts as empty; payloads under MIN_REVISIT bytes are always responses; rows that repeat a
page_id and payload are all responses if that page_id is the least; a null page_id is kept and is never the least
unless all are null; null urls are written as `urn:none`; line ends and blanks in urls are percent-encoded; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytolake.llm.common import lean, partitions, shared_dir, table

MIN_REVISIT = 100
ARCHIVE_BYTES = 24_000_000
DICTIONARY_BYTES, SAMPLE_BYTES = 65_536, 4_000_000
SKIPPABLE = 0x184D2A5D
DATE = "1970-01-01T00:00:00Z"


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """From every k-th record, so that the samples stay within SAMPLE_BYTES and span the archive; too few records serve as raw content."""
    step = max(1, -(-sum(map(len, records)) // SAMPLE_BYTES))
    samples = [r[:SAMPLE_BYTES] for r in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=3)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES] or b"WARC/1.1\r\n", dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, first: int | None, is_revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    name = lambda x: uuid.uuid5(uuid.NAMESPACE_OID, f"page/{x}/{digest}")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{name(page_id)}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~') if url else 'urn:none'}", f"WARC-Payload-Digest: sha256:{digest}"]
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if is_revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:uuid:{name(first)}>"]
        if first is not None:
            lines.append(f"Refers-To-Page-ID: {first}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    d = build_dictionary(records)
    raw = d.as_bytes()
    press = zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=True)
    return b"".join([struct.pack("<II", SKIPPABLE, len(raw)), raw, *map(press.compress, records)])


def frame_end(data: memoryview, at: int) -> int:
    """End of the Zstandard frame at a place: its header, its blocks, its checksum."""
    p = zstandard.get_frame_parameters(data[at : at + 18])
    end = at + zstandard.frame_header_size(data[at : at + 18])
    last = False
    while not last:
        head = int.from_bytes(data[end : end + 3], "little")
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        end += 3 + (1 if kind == 1 else size)
    return end + (4 if p.has_checksum else 0)


def read_archive(data: bytes) -> Iterator[dict]:
    """The records: header fields, and the block after them."""
    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame")
    raw, view = data[8 : 8 + size], memoryview(data)
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    open_ = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind))
    at = 8 + size
    while at < len(data):
        end = frame_end(view, at)
        head, _, rest = open_.decompress(view[at:end]).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield fields | {"block": rest[: int(fields["Content-Length"])]}
        at = end


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or ":/" in uri else f"file://{uri}")


def _write(uri: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _filesystem(uri)
        store.create_dir(top, recursive=True)
        task = TaskContext.get()
        made = 0

        def close(records: list[bytes]) -> pa.RecordBatch:
            nonlocal made
            data = archive(records)
            name = f"{top}/{hashlib.sha256(data).hexdigest()[:32]}.warc.zst"
            part = f"{name}.{task.taskAttemptId() if task else 0}-{made}"
            with store.open_output_stream(part) as f:
                f.write(data)
            store.move(part, name)
            made += 1
            return pa.RecordBatch.from_pydict({"path": [name], "n_records": [len(records)], "n_bytes": [len(data)]})

        held, size = [], 0
        for batch in batches:
            for r in zip(*(batch.column(k) for k in ("page_id", "url", "html", "digest", "size", "first_id", "revisit")), strict=True):
                page, url, html, digest, n, first, revisit = (x.as_py() for x in r)
                held.append(record(page, url, (html or "").encode(), digest, n, first, revisit))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield close(held)
                    held, size = [], 0
        if held:
            yield close(held)

    return run


def write_archives(pages: DataFrame, uri: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives below uri (a fresh shared folder by default) and returns their list: path, n_records, n_bytes."""
    spark = pages.sparkSession
    uri = uri or shared_dir(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha2("html", 256), "size": F.octet_length("html").cast("long")})
    first = rows.where(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Who revisits whom is told by narrow rows, which a digest of many pages may fill; payloads are then dealt by page, and those of revisits dropped.
    told = rows.where(F.col("size") >= MIN_REVISIT).select("page_id", "digest").distinct().join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("first_id")))
    told = told.select(F.col("page_id").alias("t_page"), F.col("digest").alias("t_digest"), "first_id", F.lit(True).alias("again"))
    rows = rows.join(told, rows["page_id"].eqNullSafe(told["t_page"]) & (rows["digest"] == told["t_digest"]), "left").withColumn("revisit", F.coalesce("again", F.lit(False)))
    rows = rows.select("page_id", "url", F.when(~F.col("revisit"), F.col("html")).alias("html"), "digest", "size", "first_id", "revisit")
    rows = rows.sortWithinPartitions("page_id", "digest", "url")
    at = shared_dir(spark, "warc-list")
    rows.mapInArrow(lean(_write(uri, archive_bytes)), "path string, n_records long, n_bytes long").write.parquet(at)
    return spark.read.parquet(at)


def orphans(listed: DataFrame, uri: str) -> list[str]:
    """Files below uri that the list does not name: what lost attempts left behind. Names of archives come to the driver, one for each ARCHIVE_BYTES."""
    from pyarrow import fs

    store, top = _filesystem(uri)
    known = {r.path for r in listed.select("path").collect()}
    return sorted(x.path for x in store.get_file_info(fs.FileSelector(top, allow_not_found=True)) if x.path not in known)


_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _read(uri_of: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _filesystem(uri_of)
        number = lambda x: None if x is None else int(x)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_file(path) as f:
                    data = f.read()
                out = []
                for r in read_archive(data):
                    head, _, payload = r["block"].partition(b"\r\n\r\n")
                    digest = r["WARC-Payload-Digest"].removeprefix("sha256:")
                    if r["WARC-Type"] == "response":
                        size, found = len(payload), hashlib.sha256(payload).hexdigest()
                        if found != digest:
                            raise ValueError(f"{path}: a payload does not have its digest")
                    else:
                        size = int(head.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
                    out.append((number(r.get("Page-ID")), r["WARC-Target-URI"], size, digest, r["WARC-Type"], number(r.get("Refers-To-Page-ID")), payload if with_payload else None))
                for x in range(0, len(out), 1000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[x : x + 1000], strict=True), _READ, strict=True)], schema=_READ)

    return run


def read_archives(listed: DataFrame, uri: str, with_payload: bool = False) -> DataFrame:
    """A row for each record of the listed archives; uri names the store they are in."""
    n = partitions(listed.sparkSession)
    return listed.select("path").repartition(n, "path").mapInArrow(lean(_read(uri, with_payload)), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def op6_warc(spark, sf_dir: str) -> DataFrame:
    uri = shared_dir(spark, "warc")
    return read_archives(write_archives(table(spark, sf_dir, "pages"), uri), uri).drop("url", "payload")


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
