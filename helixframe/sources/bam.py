"""Binary alignments (BAM) as a DataFrame.

A BAM file is a chain of small gzip members. Each file is one task, which decodes member by member and hands on batches of
rows: memory follows one member and one batch, not the file. Files are found by a glob; splitting one file among tasks would need its index.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "file string, qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags map<string,string>"
_LETTERS, _OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
#: Type letters of tags: struct codes.
_TAGS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
ROWS = 4096


class BamError(ValueError):
    """The bytes are not a BAM file that can be read."""


def _stream(read) -> Iterator[bytes]:
    """The decompressed bytes of a chain of gzip members, in pieces. read(n) gives up to n bytes."""
    decoder, left = zlib.decompressobj(31), b""
    while True:
        piece = left or read(1 << 16)
        left = b""
        if not piece:
            return
        try:
            yield decoder.decompress(piece)
        except zlib.error as e:
            raise BamError(f"compressed data: {e}") from e
        if decoder.eof:
            left, decoder = decoder.unused_data, zlib.decompressobj(31)


class _Reader:
    def __init__(self, read) -> None:
        self.pieces, self.held = _stream(read), bytearray()

    def take(self, n: int, may_end: bool = False) -> bytes | None:
        while len(self.held) < n:
            piece = next(self.pieces, None)
            if piece is None:
                if may_end and not self.held:
                    return None
                raise BamError("the file ends within a record")
            self.held += piece
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def _tags(data: bytes) -> dict[str, str]:
    out, i = {}, 0
    while i + 3 <= len(data):
        name, kind = data[i : i + 2].decode("ascii"), chr(data[i + 2])
        i += 3
        if kind == "A":
            out[name], i = chr(data[i]), i + 1
        elif kind in "ZH":
            end = data.index(0, i)
            out[name], i = data[i:end].decode("utf-8", "replace"), end + 1
        elif kind == "B":
            code, n = _TAGS[chr(data[i])], struct.unpack_from("<I", data, i + 1)[0]
            out[name] = ",".join(map(str, struct.unpack_from(f"<{n}{code}", data, i + 5)))
            i += 5 + n * struct.calcsize(code)
        else:
            code = _TAGS[kind]
            out[name], i = str(struct.unpack_from(f"<{code}", data, i)[0]), i + struct.calcsize(code)
    return out


def records(read) -> Iterator[dict]:
    """The alignments of a BAM file; pos and pnext from 1 as in its text form, * and 0 where something is missing."""
    r = _Reader(read)
    if r.take(4) != b"BAM\1":
        raise BamError("not a BAM file")
    r.take(struct.unpack("<i", r.take(4))[0])
    names = []
    for _ in range(struct.unpack("<i", r.take(4))[0]):
        names.append(r.take(struct.unpack("<i", r.take(4))[0])[:-1].decode("ascii"))
        r.take(4)
    name = lambda i: names[i] if i >= 0 else "*"
    while (size := r.take(4, may_end=True)) is not None:
        data = r.take(struct.unpack("<i", size)[0])
        ref, pos, n_name, mapq, _, n_ops, flag, n, mate, mate_pos, tlen = struct.unpack_from("<iiBBHHHiiii", data)
        i = 32
        qname = data[i : i + n_name - 1].decode("ascii", "replace")
        i += n_name
        ops = struct.unpack_from(f"<{n_ops}I", data, i)
        i += 4 * n_ops
        packed = data[i : i + (n + 1) // 2]
        seq = "".join(_LETTERS[b >> 4] + _LETTERS[b & 15] for b in packed)[:n]
        i += (n + 1) // 2
        qual = data[i : i + n]
        tags = _tags(data[i + n :])
        cigar = "".join(f"{x >> 4}{_OPS[x & 15]}" for x in ops)
        yield {"qname": qname, "flag": flag, "rname": name(ref), "pos": pos + 1, "mapq": mapq, "cigar": tags.pop("CG", None) or cigar or "*", "rnext": "=" if mate == ref >= 0 else name(mate), "pnext": mate_pos + 1, "tlen": tlen,
               "seq": seq or "*", "qual": "*" if not n or qual[0] == 255 else "".join(chr(q + 33) for q in qual), "tags": tags}


def read_bam(spark: SparkSession, path: str, chrom: str | None = None, start: int | None = None, end: int | None = None) -> DataFrame:
    """Alignments of all files of a path or glob; of one contig, or of those that begin in [start, end) on it (from 0), if given. A file without alignments has no rows."""
    import pyarrow as pa

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*").load(path).select("path")
    kinds = [("file", pa.string()), ("qname", pa.string()), ("flag", pa.int32()), ("rname", pa.string()), ("pos", pa.int64()), ("mapq", pa.int32()), ("cigar", pa.string()), ("rnext", pa.string()), ("pnext", pa.int64()), ("tlen", pa.int64()), ("seq", pa.string()), ("qual", pa.string()), ("tags", pa.map_(pa.string(), pa.string()))]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([list(r[n].items()) if n == "tags" else r[n] for r in rows], k) for n, k in kinds], [n for n, _ in kinds])

    def rows(batches) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, where = fs.FileSystem.from_uri(name)
                with store.open_input_stream(where, compression=None) as f:
                    held = []
                    for r in records(f.read):
                        if chrom is not None and (r["rname"] != chrom or (start is not None and r["pos"] <= start) or (end is not None and r["pos"] > end)):
                            continue
                        held.append(r | {"file": name})
                        if len(held) == ROWS:
                            yield batch_of(held)
                            held = []
                    if held:
                        yield batch_of(held)

    return files.repartition(max(1, files.count()), "path").mapInArrow(rows, SCHEMA)
