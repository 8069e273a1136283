"""Aligned reads from BAM files, without an index: one task streams one file.

A BAM file is a run of gzip members (BGZF); inflated, it is a header with the contigs and then records of little-endian
fields. Only what the spliced-read operators use is kept: contig, interval, mapping quality, flags, CIGAR, and the
cell and gene tags."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CIGAR_OPS = "MIDNSHP=X"
#: Bytes of the fixed-width tag types; Z and H end at a zero byte, B says its own length.
TAG_BYTES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_OUT = pa.schema([("chrom", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("mapq", pa.int32()), ("is_unmapped", pa.bool_()), ("is_secondary", pa.bool_()), ("is_supplementary", pa.bool_()), ("cb", pa.string()), ("gn", pa.string()), ("cigar", pa.string())])


class Inflated:
    """The inflated bytes of a BGZF stream, read in order; holds little more than what is asked for."""

    def __init__(self, stream, chunk: int = 1 << 20) -> None:
        self.stream, self.chunk, self.raw, self.out, self.at = stream, chunk, b"", bytearray(), 0
        self.z = zlib.decompressobj(31)

    def _more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.stream.read(self.chunk)
                if not self.raw:
                    return False
            got = self.z.decompress(self.raw)
            self.raw = self.z.unused_data
            if self.z.eof:
                self.z = zlib.decompressobj(31)
            else:
                self.raw = b""
            if got:
                self.out += got
                return True

    def read(self, n: int) -> bytes:
        """n bytes, or none at the end; a stream that ends within them is damaged."""
        if self.at > self.chunk:
            del self.out[: self.at]
            self.at = 0
        while len(self.out) - self.at < n and self._more():
            pass
        got = bytes(self.out[self.at : self.at + n])
        if got and len(got) < n:
            raise ValueError("the file ends within a record")
        self.at += len(got)
        return got


def tags(raw: bytes, at: int, wanted: tuple[bytes, ...]) -> dict[bytes, str]:
    """The wanted text tags of a record."""
    out = {}
    while at < len(raw):
        name, kind = raw[at : at + 2], chr(raw[at + 2])
        at += 3
        if kind in "ZH":
            end = raw.index(0, at)
            if name in wanted:
                out[name] = raw[at:end].decode()
            at = end + 1
        elif kind == "B":
            at += 5 + TAG_BYTES[chr(raw[at])] * struct.unpack_from("<I", raw, at + 1)[0]
        else:
            at += TAG_BYTES[kind]
    return out


def records(stream, cell_tag: str = "CB", gene_tag: str = "GN") -> Iterator[tuple]:
    f = Inflated(stream)
    if f.read(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    f.read(struct.unpack("<i", f.read(4))[0])
    contigs = []
    for _ in range(struct.unpack("<i", f.read(4))[0]):
        contigs.append(f.read(struct.unpack("<i", f.read(4))[0])[:-1].decode())
        f.read(4)
    cell, gene = cell_tag.encode(), gene_tag.encode()
    while head := f.read(4):
        raw = f.read(struct.unpack("<i", head)[0])
        ref, pos, n_name, mapq, _, n_ops, flag, n_seq = struct.unpack_from("<iiBBHHHi", raw)
        at = 32 + n_name
        ops = [(x >> 4, CIGAR_OPS[x & 15]) for x in struct.unpack_from(f"<{n_ops}I", raw, at)]
        got = tags(raw, at + 4 * n_ops + (n_seq + 1) // 2 + n_seq, (cell, gene))
        end = pos + sum(n for n, op in ops if op in "MDN=X")
        yield (contigs[ref] if ref >= 0 else None, pos, end, mapq, bool(flag & 4), bool(flag & 256), bool(flag & 2048), got.get(cell), got.get(gene), "".join(f"{n}{op}" for n, op in ops))


def _scan(cell_tag: str, gene_tag: str, rows: int = 20_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        held: list[tuple] = []
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), _OUT, strict=True)], schema=_OUT)
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, path = fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")
                with store.open_input_stream(path, compression=None) as stream:
                    for r in records(stream, cell_tag, gene_tag):
                        held.append(r)
                        if len(held) >= rows:
                            yield flush()
                            held.clear()
        if held:
            yield flush()

    return run


def read_bam(spark: SparkSession, paths: list[str], cell_tag: str = "CB", gene_tag: str = "GN") -> DataFrame:
    """chrom, start (0-based), end, mapq, is_unmapped, is_secondary, is_supplementary, cb, gn, cigar of each record of each file."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)), F.col("path"))
    return listed.mapInArrow(_scan(cell_tag, gene_tag), "chrom string, start long, end long, mapq int, is_unmapped boolean, is_secondary boolean, is_supplementary boolean, cb string, gn string, cigar string")
