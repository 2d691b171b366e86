import struct
import zlib

import pytest

from helixframe.sources import bam, formats


def member(data):
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def bam_bytes(rows, names=("chr1", "chr2")):
    """A BAM file of (qname, flag, ref, pos0, mapq, ops, seq, qual, tag bytes), cut into small gzip members."""
    out = bytearray(b"BAM\1" + struct.pack("<i", 5) + b"@HD\t\n" + struct.pack("<i", len(names)))
    for n in names:
        out += struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", 1000)
    for qname, flag, ref, pos, mapq, ops, seq, qual, tags in rows:
        codes = [bam._LETTERS.index(c) for c in seq] + [0] * (len(seq) % 2)
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(qname) + 1, mapq, 0, len(ops), flag, len(seq), -1, -1, 0) + qname.encode() + b"\0"
        body += b"".join(struct.pack("<I", n << 4 | bam._OPS.index(o)) for n, o in ops) + bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True)) + bytes(qual) + tags
        out += struct.pack("<i", len(body)) + body
    return b"".join(member(bytes(out[i : i + 50])) for i in range(0, len(out), 50)) + member(b"")


ROWS = [("r1", 0, 0, 9, 60, [(5, "S"), (7, "M")], "ACGTNACGTACG", [30] * 12, b"NMC\2SAZchr2,5,+,7M,60,0;\0"), ("r2", 16, 1, 4, 0, [(3, "M")], "ACG", [255] * 3, b"XBBs\2\0\0\0\1\0\xff\xff" + b"XFf" + struct.pack("<f", 0.5)), ("r3", 4, -1, -1, 0, [], "", [], b"XAAq")]


def test_records(spark, tmp_path):
    (tmp_path / "a.bam").write_bytes(bam_bytes(ROWS))
    (tmp_path / "b.bam").write_bytes(bam_bytes([]))
    got = {r.qname: r for r in bam.read_bam(spark, f"{tmp_path}/*.bam").collect()}
    assert (got["r1"].rname, got["r1"].pos, got["r1"].cigar, got["r1"].seq, got["r1"].qual, got["r1"].tags) == ("chr1", 10, "5S7M", "ACGTNACGTACG", "?" * 12, {"NM": "2", "SA": "chr2,5,+,7M,60,0;"})
    assert (got["r2"].flag, got["r2"].qual, got["r2"].tags) == (16, "*", {"XB": "1,-1", "XF": "0.5"})
    assert (got["r3"].rname, got["r3"].pos, got["r3"].cigar, got["r3"].seq, got["r3"].tags) == ("*", 0, "*", "*", {"XA": "q"})
    assert [r.qname for r in bam.read_bam(spark, f"{tmp_path}/a.bam", "chr2").collect()] == ["r2"]
    assert bam.read_bam(spark, f"{tmp_path}/a.bam", "chr1", 10, 20).count() == 0 and bam.read_bam(spark, f"{tmp_path}/a.bam", "chr1", 9, 10).count() == 1
    assert bam.read_bam(spark, f"{tmp_path}/b.bam").count() == 0


def test_damaged_files(spark, tmp_path):
    (tmp_path / "a.bam").write_bytes(bam_bytes(ROWS)[:-120])
    with pytest.raises(Exception, match="ends within a record"):
        bam.read_bam(spark, f"{tmp_path}/a.bam").collect()


def test_tables_written_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b", None), (2, 'q"uote,comma', 0.5), (3, None, 1.5)], "n long, t string, x double")
    for kind in ("csv", "tsv", "parquet"):
        formats.write_table(df, f"{tmp_path}/{kind}", kind)
        assert sorted(map(tuple, formats.read_table(spark, f"{tmp_path}/{kind}", kind, df.schema).collect())) == sorted(map(tuple, df.collect()))
