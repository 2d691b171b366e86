import random

from helixframe.operators import calling


def test_components_of_a_long_chain(spark):
    """Chains of a diameter in the thousands, with nodes in order and at random, and a star around its largest node."""
    r = random.Random(4)
    chain, mixed = list(range(4000)), list(range(10_000, 14_000))
    r.shuffle(mixed)
    edges = [*zip(chain, chain[1:], strict=False), *zip(mixed, mixed[1:], strict=False), *[(30_000, 20_000 + i) for i in range(300)]]
    got = calling.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {**dict.fromkeys(chain, 0), **dict.fromkeys(mixed, 10_000), **dict.fromkeys([30_000, *range(20_000, 20_300)], 20_000)}
    assert len(got) == len(want)
    assert sum(want[x.node] != x.label for x in got) == 0


CALL = "svid string, chrom string, svtype string, pos long, svlen long, gt string, alt string"


def test_depth_and_genotypes_by_type(spark):
    calls = spark.createDataFrame([("i", "c", "INS", 5000, 900, "0/1", ""), ("d", "c", "DEL", 5000, 900, "0/1", ""), ("l", "c", "DEL", 5000, 3000, "1/1", ""), ("n", "c", "INS", 90_000, 1001, "1/1", "")], CALL)
    alns = spark.createDataFrame([("c", 4800, 5200), ("c", 4800, 6000), ("c", 4800, 6000), ("c", 8100, 8300)], "chrom string, ref_start long, ref_end long")
    depth = {r.svid: r.n_cov for r in calling.spanning_depth(calls, alns).collect()}
    assert depth == {"i": 3, "d": 2, "l": 2, "n": 0}
    sigs = spark.createDataFrame([("c", "INS", 5000, 900)] * 2 + [("c", "DEL", 5000, 900)] * 2 + [("c", "DEL", 5000, 3000)], "chrom string, svtype string, pos long, svlen long")
    got = {r.svid: (round(r.n_ratio, 6), r.new_gt) for r in calling.correct_genotypes(calls, sigs, alns).collect()}
    assert got == {"i": (0.666667, "0/1"), "d": (1.0, "1/1"), "l": (0.5, "0/1"), "n": (1.0, "1/1")}


def test_redundancy_by_type(spark):
    rows = [("a", "c", "DEL", 1000, 3000, "0/1", ""), ("b", "c", "DEL", 3900, 400, "0/1", ""), ("z", "c", "DEL", 4500, 400, "0/1", ""),
            ("i", "c", "INS", 1000, 60, "0/1", "A" * 60), ("j", "c", "INS", 1100, 50, "0/1", "A" * 50), ("k", "c", "INS", 1100, 32, "0/1", "C" * 32)]
    got = {r.svid: (r.collapse_id, r.kept) for r in calling.collapse_redundant(spark.createDataFrame(rows, CALL)).collect()}
    assert got == {"a": ("DEL:a", True), "b": ("DEL:a", False), "z": (None, True), "i": ("INS:i", True), "j": ("INS:i", False), "k": (None, True)}


def test_inversions_need_both_ends(spark):
    calls = spark.createDataFrame([("x", "c", "DEL", 10_000, 5000, "", ""), ("y", "c", "DEL", 50_000, 5000, "", "")], CALL)
    reads = [("c", at, at + 500, 60, q, k) for q, at in (("p", 10_000), ("q", 15_000), ("r", 50_000)) for k in (0, 1)]
    alns = spark.createDataFrame(reads, "chrom string, ref_start long, ref_end long, mapq long, qname string, is_reverse int")
    assert [tuple(r) for r in calling.inversion_support(calls, alns).collect()] == [("x", 1, 1)]
