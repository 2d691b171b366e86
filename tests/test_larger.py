"""Cases in which the form before gave other rows, or took work that grew with the square of the input."""

import itertools
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from helixframe.operators import calling, linkage, pileup, sequence
from helixframe.plans import more


def test_tied_segments_do_not_depend_on_the_order_of_rows(spark, tmp_path):
    # Two segments of a read that differ only in where they end on the read (suppkey 6 and 12), in both orders of the file; then one that follows.
    rows = [(1, 1, 400, 6), (1, 1, 400, 12), (1, 2, 400, 9)]
    found = []
    for i, order in enumerate(([0, 1, 2], [1, 0, 2], [2, 1, 0])):
        d = tmp_path / str(i)
        spark.createDataFrame([rows[j] for j in order], "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long").coalesce(1).write.parquet(f"{d}/lineitem.parquet")
        pairs = more._split_pairs(spark, str(d))
        found.append(sorted(tuple(r) for r in pairs.select("qname", "ref1_end", "ref2_start", "read1_end", "read2_start").collect()))
    assert found[0] == found[1] == found[2]
    assert [(read1_end, read2_start) for _, _, _, read1_end, read2_start in found[0]] == [(1986, 977), (1992, 1977)]


def test_pairing_does_not_join_pairs_of_texts(spark):
    refs = spark.createDataFrame([("c1", "ACGT" * 500)], "chrom string, seq string")
    calls = spark.createDataFrame([(f"s{i}", i % 2 + 1, "c1", "DEL", 200 + 7 * i, 240 + 7 * i, "", 1) for i in range(6)], "svid string, hap int, chrom string, svtype string, start long, end long, alt string, copies int")
    paired = linkage.pair_by_sequence(calls, refs)
    plan = paired._jdf.queryExecution().analyzed().toString()
    assert "levenshtein" not in plan and "FlatMapGroupsInPandas" not in plan
    assert sorted(paired.columns) == sorted([*calls.columns, "part", "cluster"]) and paired.count() == 6


def test_edit_distance_against_the_matrix():
    rng = random.Random(3)
    for _ in range(500):
        a, b = ("".join(rng.choice("ACGé") for _ in range(rng.randrange(14))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            row = [last := i] + [last := min(row[j] + (c != d), row[j + 1] + 1, last + 1) for j, d in enumerate(b)]
        most = rng.randrange(16)
        assert sequence.edit_distance(a, b, most) == (row[-1] if row[-1] <= most else -1)


def test_nearest_blocks_in_tiles(spark):
    rng = random.Random(8)
    blocks = [(i, "c", 20 * i + rng.randrange(5), 20 * i + rng.randrange(6, 15)) for i in range(12) if i not in (4, 5, 6)]
    reads = [(f"r{i}", "c", at, at + rng.randrange(1, 30)) for i, at in enumerate(rng.randrange(-20, 300) for _ in range(60))]
    got = pileup.nearest_blocks(spark.createDataFrame(reads, "read string, chrom string, start long, end long"), spark.createDataFrame(blocks, "block long, chrom string, b_start long, b_end long"), tile=16)
    want = [(read, block, dist, rk) for read, _, s, e in reads for rk, (dist, block) in enumerate(sorted((max(s, b) - min(e, c), i) for i, _, b, c in blocks)[:2], 1)]
    assert sorted(tuple(r) for r in got.select("read", "block", "dist", "rk").collect()) == sorted(want)
    # A frame up to the partition's end is gone through anew for each row.
    assert "unboundedfollowing" not in got._jdf.queryExecution().analyzed().toString().lower()


def test_inversion_support_against_all_pairs(spark):
    rng = random.Random(9)
    calls = [(f"s{rng.randrange(40)}", rng.choice("cd"), rng.randrange(300), rng.randrange(60)) for _ in range(30)]
    alns = [(rng.choice("cd"), s, s + rng.randrange(1, 40), rng.randrange(3), f"q{rng.randrange(8)}", rng.randrange(2)) for s in (rng.randrange(400) for _ in range(200))]
    want = {}
    for svid, chrom, pos, svlen in calls:
        for first, at in ((0, pos), (1, pos + svlen)):
            for c, s, e, mapq, q, rev in alns:
                if c == chrom and s < at + 10 and e > at - 10 and mapq >= 1:
                    want.setdefault(svid, ({}, {}))[first].setdefault(q, set()).add(rev)
    counts = {svid: tuple(sum(len(r) == 2 for r in side.values()) for side in sides) for svid, sides in want.items()}
    got = calling.inversion_support(spark.createDataFrame(calls, "svid string, chrom string, pos long, svlen long"), spark.createDataFrame(alns, "chrom string, ref_start long, ref_end long, mapq int, qname string, is_reverse int"), 10, 1, 1)
    assert {r.svid: (r.n_start, r.n_end) for r in got.collect()} == {svid: n for svid, n in counts.items() if min(n) > 0}


def test_inversion_support_meets_no_alignment(spark):
    calls = spark.createDataFrame([("s", "c", 100, 50)], "svid string, chrom string, pos long, svlen long")
    alns = spark.createDataFrame([("c", 0, 500, 1, "q", i % 2) for i in range(4)], "chrom string, ref_start long, ref_end long, mapq int, qname string, is_reverse int")
    got = calling.inversion_support(calls, alns)
    assert "sequence(" not in got._jdf.queryExecution().analyzed().toString() and [tuple(r) for r in got.collect()] == [("s", 1, 1)]


def test_redundancy_labels_against_all_links(spark):
    rng = random.Random(11)
    for tile in (50_000, 700):
        calling.LINK_TILE = tile
        rows = []
        for i in range(160):
            svtype = rng.choice(["DEL", "INS"])
            svlen = rng.choice([0, 5, 30, 35, 80, 300, 320, 900, 5000]) if svtype == "DEL" else rng.choice([30, 50, 70, 150])
            rows.append((f"s{i if i < 150 else rng.randrange(150)}", rng.choice("cd"), svtype, rng.randrange(-500, 14_000), svlen, "".join(rng.choice("AC") for _ in range(rng.choice([0, 2, 8, 20, 31])))))
        calls = spark.createDataFrame(rows, "svid string, chrom string, svtype string, pos long, svlen long, alt string")
        want = sorted(tuple(r) for r in calling.components(calling.redundancy_links(calls)).select("node", "label").collect())
        assert sorted(tuple(r) for r in calling.redundancy_labels(calls).select("node", "label").collect()) == want and len({x for _, x in want}) > 5
    calling.LINK_TILE = 50_000


def test_links_of_a_dense_place_are_few(spark):
    # 3000 insertions at a place have 4.5 million links.
    rows = [(200 + i % 300, 50, f"s{i}", "ACGT"[i % 4] * 9) for i in range(3000)]
    tried = []
    alike, calling._alike = calling._alike, lambda x, y: tried.append(1) or alike(x, y)
    try:
        found = calling._linked_in_tile(False, rows)
    finally:
        calling._alike = alike
    assert len({root for _, root in found}) == 1 and len(found) == 3000 and len(tried) < 10_000


def test_linkage_of_pairs_against_the_matrix():
    rng = random.Random(5)
    for _ in range(3000):
        n, kinds, cut = rng.randrange(2, 14), rng.randrange(2, 5), rng.randrange(1, 7)
        haps = [str(rng.randrange(kinds)) for _ in range(n)]
        d = np.full((n, n), float(linkage.FAR))
        for i, j in itertools.combinations(range(n), 2):
            if haps[i] != haps[j] and rng.random() < 0.9:
                d[i, j] = d[j, i] = rng.randrange(9)
        near = sorted((d[i, j], i, j, haps[i], haps[j]) for i, j in itertools.combinations(range(n), 2) if d[i, j] <= cut)
        first = linkage.linkage_of_pairs(near)
        places = {x: k for k, x in enumerate(sorted({first.get(i, i) for i in range(n)}))}
        assert [places[first.get(i, i)] for i in range(n)] == linkage.complete_linkage(d, cut).tolist()


def test_large_partitions_are_paired(spark):
    rng = random.Random(12)
    calls, refs = [], []
    for chrom, svtype in itertools.product(("c", "d"), ("DEL", "INS", "INV", "DUP")):
        for i in range(75 if chrom == "c" else 9):
            start = rng.randrange(40, 1900)
            alt = "".join(rng.choice("AC") for _ in range(rng.randrange(20, 60)))
            calls.append((f"{chrom}{svtype}{rng.randrange(90)}", rng.choice((1, 2, 2, None) if i % 9 == 0 else (1, 2)), chrom, svtype, start, start + (0 if svtype == "INS" else rng.randrange(20, 80)), alt if i % 20 else None, i % 3))
        refs = [(c, "".join(random.Random(c).choice("ACGTacgt") for _ in range(2500))) for c in "cd"]
    df = spark.createDataFrame(calls, "svid string, hap int, chrom string, svtype string, start long, end long, alt string, copies int")
    refs = spark.createDataFrame(refs, "chrom string, seq string")
    found = [sorted(map(str, linkage.pair_by_sequence(df, refs, cut=60, most=most).collect())) for most in (10, 1000, 1)]
    # The same clusters in one piece, in chunks, and some either way; nothing is dropped.
    assert found[0] == found[1] == found[2] and len(found[0]) == len(calls)
    sizes = Counter((r.chrom, r.svtype, r.part, r.cluster) for r in linkage.pair_by_sequence(df, refs, cut=60).collect())
    assert set(sizes.values()) == {1, 2} and len(sizes) > 100
