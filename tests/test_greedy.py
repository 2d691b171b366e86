import random

from pyspark.sql import functions as F

from helixframe.operators import calling, cigar, greedy, intervals


def signatures(seed, n, width):
    r = random.Random(seed)
    return sorted({("c", r.choice(["INS", "DEL"]), r.choice(["1", "2"]), r.randrange(width), r.randrange(30, 200), f"q{i}") for i in range(n)}, key=lambda x: (x[3], -x[4], x[5]))


def test_seed_clusters_equal_brute_force(spark):
    sigs = signatures(1, 400, 6000)
    expected = []
    for kind in ("INS", "DEL"):
        for hp in ("1", "2"):
            left = [s for s in sigs if s[1] == kind and s[2] == hp]
            while left:
                seed = left[0]
                group = [s for s in left if greedy.alike(kind, seed[3], seed[4], s[3], s[4], 100)]
                left = [s for s in left if s not in group]
                expected.append((*max(group, key=lambda s: s[4]), len(group)))
    got = greedy.seed_clusters(spark.createDataFrame(sigs, greedy.COLUMNS))
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)
    assert greedy.seed_clusters(spark.createDataFrame([], greedy.COLUMNS)).count() == 0


def test_pairs_equal_brute_force(spark):
    sigs = signatures(2, 400, 6000)
    one, two = ([s for s in sigs if s[2] == hp] for hp in "12")
    free, expected = list(two), []
    for a in one:
        b = next((b for b in free if b[1] == a[1] and greedy.alike(a[1], a[3], a[4], b[3], b[4], 200)), None)
        if b:
            free.remove(b)
        kept = a if not b or a[4] > b[4] else b
        expected.append((*kept[:2], *kept[3:5], "1/1" if b else "0/1", a[5], b[5] if b else None))
    expected += [(*b[:2], *b[3:5], "0/1", None, b[5]) for b in free]
    frame = lambda x: spark.createDataFrame(x, greedy.COLUMNS)
    got = greedy.pair_haplotypes(frame(one), frame(two)).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, expected))


def test_tiles_do_not_matter(spark):
    sigs = spark.createDataFrame(signatures(3, 300, 30_000), greedy.COLUMNS)
    keys = ["chrom", "svtype", "hp"]
    of = lambda tile: sorted(tuple(r) for r in calling.gap_partitions(sigs, keys, 100, tile).select(*keys, "pos", "qname", "part").collect())
    assert of(10) == of(700) == of(1 << 40)
    blocks = sigs.select("chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("svlen")).alias("end"))
    deep = lambda tile: sorted(tuple(r) for r in intervals.depth(blocks, tile).collect())
    assert deep(50) == deep(1 << 40)


def test_lift(spark):
    ops = spark.createDataFrame([("a", 0, 4, 2), ("a", 1, 0, 10), ("a", 2, 1, 3), ("a", 3, 0, 5), ("a", 4, 2, 4), ("a", 5, 0, 6)], "aln string, idx int, op int, len long")
    segs = cigar.segments(ops)
    blocks = spark.createDataFrame([("b", "a", 8, 12), ("gap", "a", 15, 19), ("c", "a", 14, 21)], "block string, aln string, start long, end long")
    assert sorted(tuple(r) for r in cigar.lift(blocks, segs, "block").collect()) == [("b", "a", 8, 12, 10, 17, 4), ("c", "a", 14, 21, 19, 22, 3)]
    back = spark.createDataFrame([("b", "a", 10, 17)], "block string, aln string, start long, end long")
    assert [tuple(r) for r in cigar.lift(back, segs, "block", to_query=False).collect()] == [("b", "a", 10, 17, 8, 12, 4)]
