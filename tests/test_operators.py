import random

import pytest
from pyspark.sql import functions as F

from helixframe.operators import cigar, intervals, sequence

# Published cases whose results must be met.
GOLDEN = [
    ([(5, 10), (4, 20), (0, 10), (7, 10), (8, 5), (0, 5), (1, 50), (0, 30), (4, 25), (5, 15)], [(30, 50, 50, "INS")]),
    ([(5, 10), (4, 20), (0, 30), (2, 50), (0, 30), (4, 25), (5, 15)], [(30, 50, 50, "DEL")]),
    ([(5, 10), (4, 20), (0, 30), (2, 40), (1, 50), (0, 30), (4, 25), (5, 15)], [(30, 50, 40, "DEL"), (70, 50, 50, "INS")]),
    ([(5, 10), (4, 20), (0, 30), (1, 40), (2, 50), (0, 30), (4, 25), (5, 15)], [(30, 50, 40, "INS"), (30, 90, 50, "DEL")]),
]


# N, =, X and P move both, both, both and neither of the coordinates (N the reference only).
GOLDEN.append(([(4, 3), (7, 20), (3, 100), (8, 2), (6, 7), (1, 31), (7, 5), (2, 30)], [(122, 25, 31, "INS"), (127, 61, 30, "DEL")]))


@pytest.mark.parametrize("ops,expected", GOLDEN)
def test_cigar_indels(spark, ops, expected):
    table = spark.createDataFrame([(1, i, o, n) for i, (o, n) in enumerate(ops)], "aln long, idx int, op int, len long")
    assert sorted(tuple(r)[1:] for r in cigar.indels(table, 30).collect()) == sorted(expected)


def test_cigar_parse(spark):
    row = spark.range(1).select(cigar.parse(F.lit("4=1X2I10D3S")).alias("c")).first()
    assert [tuple(x) for x in row.c] == [(7, 4), (8, 1), (1, 2), (2, 10), (4, 3)]


def test_subtract_and_intersect_cover_all(spark):
    a = spark.createDataFrame([("x", "c", 0, 250_000), ("y", "c", 10, 20)], "key string, chrom string, start long, end long")
    b = spark.createDataFrame([("c", 5, 12), ("c", 11, 15), ("c", 99_990, 100_010), ("c", 300_000, 300_001)], "chrom string, start long, end long")
    left = intervals.subtract(a, b, "key").groupBy("key").agg(F.sum(F.col("end") - F.col("start")).alias("n"))
    assert {r.key: r.n for r in left.collect()} == {"x": 250_000 - 10 - 20, "y": 5}
    assert sorted(tuple(r) for r in intervals.merge_blocks(b).collect()) == [("c", 5, 15), ("c", 99_990, 100_010), ("c", 300_000, 300_001)]


def test_sequences(spark):
    row = spark.range(1).select(sequence.reverse_complement(F.lit("aCGN")).alias("r"), sequence.pack(F.lit("ACGT")).alias("p"), sequence.kmers(F.lit("ACG"), 5).alias("k"), sequence.kmers(F.lit("ACGTA"), 3, False).alias("h")).first()
    assert tuple(row) == ("NCGT", 27, [], ["ACG", "CGT"])


def test_tiles_do_not_matter(spark):
    """Tiles of 7 positions, across which blocks, runs and gaps go on, give what one tile gives."""
    rng = random.Random(11)
    blocks = spark.createDataFrame([("c", s, s + rng.randrange(1, 12)) for s in (rng.randrange(300) for _ in range(40))] + [("d", 0, 50), ("d", 50, 60), ("e", 14, 21)], "chrom string, start long, end long")
    contigs = spark.createDataFrame([("c", 320), ("d", 60), ("e", 42), ("f", 15), ("g", 0)], "chrom string, length long")
    depths = spark.createDataFrame([("c", p, rng.randrange(2)) for p in range(100) if p % 13] + [("d", p, 1) for p in range(30)] + [("e", p, None) for p in range(6, 9)], "chrom string, pos long, depth int")
    kinds = spark.createDataFrame([("c", s, s + rng.randrange(1, 9), rng.choice("ab")) for s in rng.sample(range(400), 30)], "chrom string, start long, end long, kind string")
    for f in (
        lambda t: intervals.merge_blocks(blocks, tile=t), lambda t: intervals.merge_blocks(blocks, 2, t), lambda t: intervals.merge_blocks(blocks, 9, t), lambda t: intervals.complement(blocks, contigs, t),
        lambda t: intervals.run_lengths(depths, ["chrom"], "pos", "depth", t), lambda t: intervals.assign_gaps(kinds, t),
    ):
        small, whole = (sorted(map(str, f(t).collect())) for t in (7, 1 << 30))
        assert small == whole and small
    covered = {(r.chrom, p) for r in blocks.collect() for p in range(r.start, r.end)}
    bare = {(r.chrom, p) for r in intervals.complement(blocks, contigs, 7).collect() for p in range(r.start, r.end)}
    assert bare == {(r.chrom, p) for r in contigs.collect() for p in range(r.length)} - covered
