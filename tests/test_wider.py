"""Projections, chains, split reads and mixtures against golden values, plain code and small cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.operators import chains, cigar, intervals, models, projection, sequence, splits, variants
from helixframe.sources import formats

# The alignment and the expected projections that a projection of blocks has to give.
CIGAR = "4=1X2I2=1X10D1X2=10I1X1=5D5=1X4=5I3=1X6="
PROJECTIONS = [
    ("+", False, "ctg 80 106 ref 10 15, ctg 110 116 ref 28 31, ctg 123 126 ref 31 39"),
    ("+", False, "ctg 80 108 ref 10 16, ctg 110 123 ref 28 31, ctg 123 150 ref 31 58"),
    ("+", False, "ctg 100 150 ref 10 58"),
    ("-", False, "ctg 234 240 ref 28 31, ctg 244 270 ref 10 15"),
    ("-", False, "ctg 200 227 ref 31 58, ctg 227 240 ref 28 31, ctg 242 270 ref 10 16"),
    ("-", False, "ctg 200 250 ref 10 58"),
    ("+", True, "ref 10 19 ctg 100 110, ref 20 35 ctg 110 125, ref 38 58 ctg 125 150"),
    ("+", True, "ref 14 16 ctg 104 108, ref 39 45 ctg 126 132"),
    ("+", True, "ref 10 58 ctg 100 150"),
    ("-", True, "ref 10 19 ctg 240 250, ref 20 35 ctg 225 240, ref 38 58 ctg 200 225"),
    ("-", True, "ref 14 16 ctg 242 246, ref 39 45 ctg 218 224"),
    ("-", True, "ref 10 58 ctg 200 250"),
]


def alignment(spark, strand):
    q = (100, 150) if strand == "+" else (200, 250)
    alns = spark.createDataFrame([("a", "ref", 10, 58, "ctg", *q, strand == "-")], "aln string, chrom string, r_start long, r_end long, contig string, q_start long, q_end long, is_reverse boolean")
    ops = spark.createDataFrame([("a", CIGAR)], "aln string, c string").select("aln", F.posexplode(cigar.parse(F.col("c"))).alias("idx", "o")).select("aln", "idx", "o.op", "o.len")
    return alns, ops


def test_golden_projections(spark):
    for strand, to_contig, text in PROJECTIONS:
        alns, ops = alignment(spark, strand)
        want = [line.split() for line in text.split(", ")]
        blocks = spark.createDataFrame([(i, w[0], int(w[1]), int(w[2])) for i, w in enumerate(want)], "block int, chrom string, start long, end long")
        got = projection.project(blocks, projection.elements(ops, alns), "block", to_contig).orderBy("block").collect()
        assert [(r.block, r.target, r.to_start, r.to_end) for r in got] == [(i, w[3], int(w[4]), int(w[5])) for i, w in enumerate(want)], (strand, to_contig, text)


def test_projection_limits(spark):
    alns, ops = alignment(spark, "+")
    parts = projection.elements(ops, alns)
    # Inside of an insertion, beyond the alignment, at an insertion's border; a whole block's differences: 6 mismatches, 15 + 17 letters in gaps.
    blocks = spark.createDataFrame([(0, "ctg", 105, 107), (1, "ctg", 0, 100), (2, "ctg", 150, 200), (3, "ctg", 104, 108), (4, "ctg", 90, 160)], "block int, chrom string, start long, end long")
    got = {r.block: tuple(r)[2:] for r in projection.project(blocks, parts, "block").collect()}
    assert set(got) == {3, 4}
    assert got[3][:5] == (104, 108, "ref", 14, 16) and got[3][5] == pytest.approx(100 * (1 + 2) / 2)
    assert got[4][:5] == (100, 150, "ref", 10, 58) and got[4][5] == pytest.approx(100 * (6 + 32) / 48)


def test_duplicated_candidates(spark):
    rows = [("a", "ref", 0, 100, "c1", 0, 100, False), ("b", "ref", 90, 190, "c2", 20, 120, True)]
    alns = spark.createDataFrame(rows, "aln string, chrom string, r_start long, r_end long, contig string, q_start long, q_end long, is_reverse boolean")
    ops = spark.createDataFrame([("a", 0, 0, 100), ("b", 0, 0, 100)], "aln string, idx int, op int, len int")
    contigs = spark.createDataFrame([("c1", 100), ("c2", 130)], "chrom string, length long")
    got = sorted(tuple(r) for r in projection.duplicated_candidates(alns, ops, contigs, 30).select("chrom", "start", "end").collect())
    # c1: the shared end; c2: what stands before, the shared stretch (at the turned end) with what stands after.
    assert got == [("c1", 90, 100), ("c2", 0, 20), ("c2", 110, 130)]


def test_chains_against_all_predecessors():
    rng = random.Random(5)
    for _ in range(200):
        rows = sorted({(rng.randrange(40), rng.randrange(40), rng.randrange(1, 8)) for _ in range(rng.randrange(1, 25))})
        gap = rng.choice([0.0, 0.05, 0.5])
        score = []
        for i, (q, t, n) in enumerate(rows):
            before = [score[j] - gap * (q - a - m + t - b - m) for j, (a, b, m) in enumerate(rows[:i]) if a + m <= q and b + m <= t]
            score.append(n + max([0.0, *before]))
        total, chain = chains.best_chain(*(np.array(x) for x in zip(*rows, strict=True)), gap)
        assert total == pytest.approx(max(score))
        path = [rows[i] for i in chain]
        assert all(a + m <= q and b + m <= t for (a, b, m), (q, t, _) in zip(path, path[1:], strict=False))
        assert total == pytest.approx(sum(r[2] for r in path) - gap * sum(q - a - m + t - b - m for (a, b, m), (q, t, _) in zip(path, path[1:], strict=False)))


def test_empty_chains(spark):
    assert chains.best_chain(np.array([]), np.array([]), np.array([]), 0.1) == (0.0, [])
    none = spark.createDataFrame([], "k int, q long, t long, n long")
    assert chains.chains(none, ["k"]).count() == 0
    twice = spark.createDataFrame([(1, 5, 5, 3)] * 2, "k int, q long, t long, n long")
    assert [tuple(r) for r in chains.chains(twice, ["k"]).collect()] == [(1, 3.0, 1, 5, 8, 5, 8)]


def split(spark, *segments):
    df = spark.createDataFrame([("r", *s) for s in segments], "qname string, q_start long, q_end long, chrom string, ref_start long, ref_end long, is_reverse boolean")
    return sorted(tuple(r)[1:] for r in splits.read_split_variants(df).collect())


def test_read_split_variants(spark):
    seg = lambda q, a, chrom="chr1", rev=False, n=1000: (q, q + n, chrom, a, a + n, rev)
    assert split(spark, seg(0, 5000)) == []
    assert split(spark, seg(0, 5000), seg(1500, 6000)) == [("INS", "chr1", 6000.0, 500, None, None)]
    assert split(spark, seg(0, 5000), seg(1000, 6300)) == [("DEL", "chr1", 6000.0, 300, None, None)]
    assert split(spark, seg(0, 6300, rev=True), seg(1000, 5000, rev=True)) == [("DEL", "chr1", 6000.0, 300, None, None)]
    assert split(spark, seg(0, 5000), seg(1000, 6020)) == split(spark, seg(0, 5000), seg(1000, 60000)) == split(spark, seg(0, 5000), seg(1000, 6300, rev=True)) == []
    # Both pairs of a window of three; the first one not where the third segment lies before the second one's end.
    assert split(spark, seg(0, 5000), seg(1000, 6300), seg(2500, 7300)) == [("DEL", "chr1", 6000.0, 300, None, None), ("INS", "chr1", 7300.0, 500, None, None)]
    assert split(spark, seg(0, 5000), seg(1000, 6300), seg(2000, 7000)) == [("DEL", "chr1", 6000.0, 300, None, None)][:0]


@pytest.mark.parametrize(
    ("rev1", "rev2", "chrom", "want"),
    [(False, False, "chr2", ("A", "chr1", 6000.0, "chr2", 9000)), (False, False, "chr0", ("D", "chr0", 9000.0, "chr1", 6000)), (False, True, "chr2", ("B", "chr1", 6000.0, "chr2", 10000)), (True, False, "chr2", ("C", "chr1", 5000.0, "chr2", 9000)),
     (True, True, "chr2", ("D", "chr1", 5000.0, "chr2", 10000)), (True, True, "chr0", ("A", "chr0", 10000.0, "chr1", 5000))],
)
def test_translocations(spark, rev1, rev2, chrom, want):
    kind, c1, p1, c2, p2 = want
    assert split(spark, (0, 1000, "chr1", 5000, 6000, rev1), (1000, 2000, chrom, 9000, 10000, rev2)) == [(kind, c1, p1, None, c2, p2)]
    assert split(spark, (0, 1000, "chr1", 5000, 6000, rev1), (1101, 2101, chrom, 9000, 10000, rev2)) == []


def test_inserted_translocation(spark):
    a, b, c = (0, 1000, "chr1", 5000, 6000, False), (1000, 1700, "chr2", 9000, 9700, False), (1700, 2700, "chr1", 6010, 7010, False)
    assert split(spark, a, b, c) == [("A", "chr1", 6000.0, None, "chr2", 9000), ("D", "chr1", 6010.0, None, "chr2", 9700), ("INS", "chr1", 6000.0, 690, None, None)]


def test_negative_binomials():
    rng = np.random.default_rng(3)
    mean, variance = 20.0, 40.0
    theta = mean / variance
    draws = np.concatenate([rng.negative_binomial(mean * p * theta / (1 - theta), theta, int(200_000 * w)) for p, w in ((1, 0.7), (2, 0.25))] + [rng.negative_binomial(0.5, 0.4, 10_000)])
    x, n = np.unique(draws, return_counts=True)
    fit = models.fit_negative_binomials(x, n, 2)
    assert fit["mean"] == pytest.approx(mean, rel=0.01) and fit["variance"] == pytest.approx(variance, rel=0.03)
    assert fit["weights"] == pytest.approx([0.05, 0.7, 0.25], abs=0.01)
    assert fit["bic"] - fit["aic"] == pytest.approx(6 * (np.log(n.sum()) - 2))
    # No neighbouring point is likelier.
    assert fit["error_mean"] == pytest.approx(0.75, rel=0.15)
    shuffled = rng.permutation(len(x))
    assert models.fit_negative_binomials(x[shuffled], n[shuffled], 2)["likelihood"] == fit["likelihood"]


def test_memberships(spark):
    block = lambda *rows: spark.createDataFrame([("c", *r) for r in rows], "chrom string, start long, end long")
    got = intervals.memberships({"x": block((0, 10), (10, 20), (5, 8)), "y": block((20, 30), (8, 12))}).orderBy("start").collect()
    assert [tuple(r) for r in got] == [("c", 0, 8, 1, "x"), ("c", 8, 12, 2, "x,y"), ("c", 12, 20, 1, "x"), ("c", 20, 30, 1, "y")]
    with pytest.raises(ValueError):
        intervals.memberships({})


def test_assembly_statistics(spark):
    got = {r.name: (r.length, r.n) for r in sequence.assembly_statistics(spark.createDataFrame([(10,), (10,), (10,), (5,), (5,), (None,)], "len int"), "len").collect()}
    assert got == {"N10": (10, 1), "N20": (10, 1), "N30": (10, 2), "N40": (10, 2), "N50": (10, 2), "N60": (10, 3), "N70": (10, 3), "N80": (5, 4), "N90": (5, 5), "min": (5, 5), "max": (10, 5), "mean": (8, 5), "total": (40, 5)}
    assert sequence.assembly_statistics(spark.createDataFrame([], "len int"), "len").count() == 0


def test_parted_reads(spark):
    reads = spark.createDataFrame([(1, "ACGT"), (2, "ACG"), (3, "ACNT"), (4, None)], "i int, seq string")
    kept, rest = sequence.parted_reads(reads, 4)
    assert [r.i for r in kept.collect()] == [1] and sorted(r.i for r in rest.collect()) == [2, 3, 4]


def test_merged_translocations(spark):
    rows = [("a", "c1", 100, "c2", 500, "[", "0/1"), ("b", "c1", 150, "c2", 540, "[", "1/0"), ("c", "c1", 150, "c2", 540, "]", "1/0"), ("d", "c1", 300, "c2", 540, "[", "0/1"), ("e", "c1", 301, "c2", 10, "[", "0/1")]
    df = spark.createDataFrame(rows, "svid string, chrom string, pos long, chrom2 string, pos2 long, bracket string, gt string")
    got = sorted(tuple(r)[0:1] + tuple(r)[6:] for r in variants.merged_translocations(df, 100).collect())
    assert got == [("a", "1/1", 2), ("c", "1/0", 1), ("d", "1/1", 2)]


def test_parameter_table(spark, tmp_path):
    (tmp_path / "p.csv").write_bytes(b"\xef\xbb\xbfasm,dtype,lb,rb\r\nother,hifi,0.048,2\r\nx,clr,nan,3\r\n")
    rows = formats.read_parameter_table(spark, str(tmp_path / "p.csv"))
    assert rows.dtypes == [("asm", "string"), ("dtype", "string"), ("lb", "double"), ("rb", "double")]
    assert [tuple(r) for r in rows.orderBy("dtype").collect()] == [("x", "clr", None, 3.0), ("other", "hifi", 0.048, 2.0)]
