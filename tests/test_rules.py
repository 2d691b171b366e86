"""Operators without SQL, and rules with thresholds, against plain code and small cases."""

import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.operators import assignment, calling, coverage, linkage, models, pileup, splits
from helixframe.plans import catalogue, clusters, more
from helixframe.plans.adapters import frame

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("platform", ["Hifi", "CLR", "ONT"])
def test_genotype_thresholds(spark, platform):
    """A row at, below and above each threshold, of every type, size and called genotype; null thresholds and other genotypes change nothing."""
    t = calling.thresholds_of(platform)
    rows, want = [], []
    for svtype, size, called in itertools.product(("DEL", "INS"), ("small", "large"), ("01", "11")):
        limit = t[svtype][f"t_{size}_{called}"]
        for ratio in (0.0, 0.5, *((limit - 1e-9, limit, limit + 1e-9) if limit is not None else ()), 1.0):
            gt = "/".join(called)
            rows.append((len(rows), svtype, 1000 if size == "small" else 1001, gt, ratio))
            want.append(gt if limit is None else "1/1" if ratio > limit else "0/1")
    rows.append((len(rows), "DEL", 100, "./.", 0.99))
    want.append("./.")
    df = spark.createDataFrame(rows, "i long, svtype string, svlen long, gt string, r double")
    got = df.withColumn("new", calling.corrected_genotype(F.col("r"), F.col("svtype"), F.col("svlen"), F.col("gt"), t)).orderBy("i").collect()
    assert [x.new for x in got] == want


def test_thresholds_from_files(spark, tmp_path):
    for (platform, svtype), t in calling.GT_THRESHOLDS.items():
        (tmp_path / f"{platform}_{svtype}").write_text("".join(f"{k}:{'nan' if v is None else v}\n" for k, v in t.items()))
    for platform in ("Hifi", "CLR", "ONT"):
        assert calling.read_thresholds(spark, {s: f"{tmp_path}/{platform}_{s}" for s in ("DEL", "INS")}) == calling.thresholds_of(platform)


def test_depth_by_type(spark):
    calls = spark.createDataFrame([("a", "chr1", "DEL", 1000, 500), ("b", "chr1", "DEL", 1000, 2000), ("c", "chr1", "INS", 1000, 2000), ("d", "chr2", "INS", 5, 10)], "svid string, chrom string, svtype string, pos long, svlen long")
    alns = spark.createDataFrame([("chr1", 0, 1501), ("chr1", 0, 1500), ("chr1", 1000, 9000), ("chr1", 849, 1200), ("chr1", 3100, 3300), ("chr1", 3149, 3251)], "chrom string, ref_start long, ref_end long")
    got = {r.svid: r.n_cov for r in calling.spanning_depth(calls, alns).collect()}
    # a: [1000, 1500] within; b: mean of [850, 950] and [3150, 3250]; c: [900, 1100].
    assert got == {"a": 1.0, "b": (3 + 3) / 2, "c": 3.0, "d": 0.0}


def classify(spark, segments):
    df = spark.createDataFrame([("r", *s) for s in segments], "qname string, q_start long, q_end long, chrom string, ref_start long, ref_end long, is_reverse boolean")
    return [(r.kind, r.chrom, r.start, r.chrom2, r.end, r.detail) for r in splits.classify_segments(df).orderBy("q_start").collect()]


def test_split_classes(spark):
    seg = lambda q, a, chrom="chr1", rev=False, n=1000: (q, q + n, chrom, a, a + n, rev)
    assert classify(spark, [seg(0, 5000), seg(1500, 6000)]) == [("INS", "chr1", 6000, "chr1", 6500, "")]
    assert classify(spark, [seg(0, 5000), seg(1000, 6300)]) == [("DEL", "chr1", 6000, "chr1", 6300, "")]
    assert classify(spark, [seg(0, 6300, rev=True), seg(1000, 5000, rev=True)]) == [("DEL", "chr1", 6000, "chr1", 6300, "")]
    assert classify(spark, [seg(0, 5000), seg(1000, 5600)]) == [("DUP", "chr1", 5600, "chr1", 6000, "full")]
    assert classify(spark, [seg(0, 50000), seg(1000, 20000)]) == [("DUP", "chr1", 20000, "chr1", 51000, "partial")]
    assert classify(spark, [seg(0, 5000), seg(1000, 300000)]) == [("BND", "chr1", 5999, "chr1", 300000, "fwd-fwd")]
    assert classify(spark, [seg(0, 5000), seg(1000, 7000, rev=True)]) == [("INV", "chr1", 6000, "chr1", 8000, "left_fwd")]
    assert classify(spark, [seg(0, 7000, rev=True), seg(1000, 9000)]) == [("INV", "chr1", 7000, "chr1", 9000, "right_fwd")]
    assert classify(spark, [seg(0, 5000), seg(1000, 9000, "chr2", True)]) == [("BND", "chr1", 5999, "chr2", 9999, "fwd-rev")]
    assert classify(spark, [seg(0, 5000), seg(1000, 6020)]) == classify(spark, [seg(0, 5000), seg(800, 6400)]) == classify(spark, [seg(0, 5000)]) == []


def test_interspersed_duplications(spark):
    rows = [("r", 1, "fwd", "fwd", "chr1", 999, "chr2", 5000), ("r", 2, "fwd", "fwd", "chr2", 5499, "chr1", 1003), ("s", 1, "fwd", "fwd", "chr1", 999, "chr2", 5000), ("s", 2, "fwd", "fwd", "chr2", 5499, "chr1", 1100),
            ("t", 1, "rev", "rev", "chr1", 1000, "chr2", 5499), ("t", 2, "rev", "rev", "chr2", 5000, "chr1", 999), ("u", 2, "fwd", "fwd", "chr1", 999, "chr2", 5000), ("u", 1, "fwd", "fwd", "chr2", 5499, "chr1", 1003)]
    df = spark.createDataFrame(rows, "qname string, idx int, dir1 string, dir2 string, chrom1 string, pos1 long, chrom2 string, pos2 long")
    got = sorted(tuple(r) for r in splits.interspersed_duplications(df).collect())
    # u goes the other way round: chr1 is copied to chr2, but too short to count.
    assert got == [("r", "chr2", 5000, 5500, "chr1", 1001), ("t", "chr2", 5000, 5500, "chr1", 1000)]


@pytest.mark.parametrize("svtype", ["INS", "DEL"])
def test_chains(spark, svtype):
    sigs = more._chains(spark, SF, svtype)
    extra = spark.createDataFrame([("z", "chr1", p, n, 2 * p, 2 * p + n) for p, n in ((0, 300), (200, 260), (500, 400), (520, 20), (900, 330), (1250, 340), (1300, 110), (1400, 120))], sigs.schema)
    sigs = sigs.unionByName(extra)
    reads = defaultdict(list)
    for r in sigs.collect():
        reads[r.qname, r.chrom].append((r.pos, r.q_start, r.q_end, r.svlen))
    want = []
    for key, rows in reads.items():
        done = []
        for pos, qs, qe, n in sorted(rows):
            p = done[-1] if done else None
            if p and any(p[3] > least and n > least and abs(pos - p[0]) < apart for least, apart in splits.CHAIN_RULES[svtype]):
                done[-1] = (p[0], p[1], qe, qe - p[1]) if svtype == "INS" else (p[0], p[1], p[1] + 1, pos + n - p[0])
            else:
                done.append((pos, qs, qe, n))
        want += [(*key, *x) for x in done]
    got = [(r.qname, r.chrom, r.pos, r.q_start, r.q_end, r.svlen) for r in splits.merge_chains(sigs, svtype).collect()]
    assert sorted(got) == sorted(want) and len(want) < sum(map(len, reads.values()))


def plain_linkage(d, cut):
    groups = [[i] for i in range(len(d))]
    while True:
        far = [(max(d[i][j] for i in a for j in b), x, y) for (x, a), (y, b) in itertools.combinations(enumerate(groups), 2)]
        if not far or min(far)[0] > cut:
            return sorted(groups, key=min)
        _, x, y = min(far)
        groups[x] += groups.pop(y)


def test_complete_linkage():
    r = random.Random(4)
    for _ in range(200):
        n = r.randrange(1, 9)
        d = np.zeros((n, n))
        for i, j in itertools.combinations(range(n), 2):
            d[i, j] = d[j, i] = r.random()
        got = linkage.complete_linkage(d, 0.5)
        assert [sorted(np.flatnonzero(got == g).tolist()) for g in range(got.max() + 1)] == [sorted(g) for g in plain_linkage(d, 0.5)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row = [last := i] + [last := min(row[j] + (c != d), row[j + 1] + 1, last + 1) for j, d in enumerate(b)]
    return row[-1]


def test_pairing_by_sequence(spark):
    r = random.Random(7)
    ref = "".join(r.choice("ACGT") for _ in range(1500))
    alt = "".join(r.choice("ACGT") for _ in range(60))
    calls = [("a", 1, "DEL", 300, 360, ""), ("b", 2, "DEL", 303, 362, ""), ("c", 2, "DEL", 700, 740, ""), ("d", 1, "INS", 400, 400, alt), ("e", 2, "INS", 402, 402, alt[:-5]), ("f", 1, "INV", 800, 900, ""), ("g", 2, "INV", 805, 898, ""), ("h", 1, "DUP", 1000, 1050, ""), ("i", 2, "DUP", 1100, 1190, "")]
    df = spark.createDataFrame([(i, h, "c1", t, s, e, x, 1) for i, h, t, s, e, x in calls], "svid string, hap int, chrom string, svtype string, start long, end long, alt string, copies int")
    refs = spark.createDataFrame([("c1", ref)], "chrom string, seq string")
    cut = 30

    def text(t, s, e, x):
        mid = ref[s:e]
        put = {"DEL": "", "INS": x, "INV": mid[::-1].translate(str.maketrans("ACGT", "TGCA")), "DUP": mid * 2}[t]
        return ref[:s] + put + (ref[s:] if t == "INS" else ref[e:])

    want = []
    for t in ("DEL", "INS", "INV", "DUP"):
        mine = [c for c in calls if c[2] == t]
        d = [[0 if a == b else 10**9 if a[1] == b[1] else distance(text(*a[2:]), text(*b[2:])) for b in mine] for a in mine]
        want += [sorted(mine[i][0] for i in g) for g in plain_linkage(d, cut)]
    paired = linkage.pair_by_sequence(df, refs, cut=cut)
    groups = defaultdict(list)
    for x in paired.collect():
        groups[x.svtype, x.part, x.cluster].append(x.svid)
    assert sorted(map(sorted, groups.values())) == sorted(want) and ["a", "b"] in want and ["d", "e"] in want
    gts = {(x.svtype, x.start): (x.n, x.gt) for x in linkage.genotypes(paired, ["chrom", "svtype", "part"]).collect()}
    assert gts["DEL", 300] == (2, "1/1") and gts["DEL", 700] == (1, "0/1") and gts["DUP", 1000][1] in ("1/0", "1/1")


def test_large_partitions_give_no_cluster(spark):
    df = spark.createDataFrame([("k", str(i), i % 2 + 1, i, "fwd", i, "fwd") for i in range(11)] + [("m", "x", 1, 5, "fwd", 9, "fwd"), ("m", "y", 2, 100, "fwd", 50, "fwd"), ("m", "z", 2, 90, "rev", 50, "fwd")], "k string, svid string, hap int, pos1 long, dir1 string, pos2 long, dir2 string")
    assert sorted((r.svid, r.cluster) for r in linkage.pair_breakends(df, ["k"]).collect()) == [("x", 0), ("y", 0), ("z", 1)]


def test_sweep_and_runs(spark):
    inv = spark.createDataFrame([("r", "c", 100, 1000, "left_fwd"), ("r", "c", 150, 1010, "right_fwd"), ("r", "c", 5000, 6000, "left_fwd"), ("r", "c", 5100, 9000, "right_fwd"), ("s", "c", 100, 1000, "left_fwd")], "qname string, chrom string, start long, end long, side string")
    assert sorted(tuple(r) for r in linkage.swept_inversions(inv).select("qname", "start", "end", "complete").collect()) == [("r", 150, 1000, True), ("r", 5000, 6000, False), ("r", 5100, 9000, False), ("s", 100, 1000, False)]
    dup = spark.createDataFrame([("r", 1, "c", 100, 200, False, True), ("r", 2, "c", 110, 205, True, True), ("r", 3, "c", 124, 200, False, True), ("r", 4, "c", 100, 200, False, True), ("r", 5, "c", 101, 200, False, False), ("s", 1, "c", 7, 9, True, True)], "qname string, idx int, chrom string, start long, end long, full boolean, forward boolean")
    got = sorted(tuple(r) for r in linkage.tandem_runs(dup).collect())
    assert got == [("r", "c", 101, 200, 1, False), ("r", "c", 108, 201, 4, True), ("s", "c", 7, 9, 1, True)]


def test_mixture_recovers_its_parameters():
    r = np.random.default_rng(2)
    x = np.concatenate([r.exponential(2, 3000), r.normal(20, 3, 60000), r.normal(40, 3 * 2**0.5, 20000)])
    values, counts = np.unique(np.round(x[x >= 0]), return_counts=True)
    f = models.fit_mixture(values, counts, 2)
    assert abs(f["mean"] - 20) < 0.2 and abs(f["variance"] - 9) < 0.6 and abs(f["weights"][2] - 20000 / 83000) < 0.02


def test_hidden_states_against_all_paths(spark):
    model = clusters.HMM
    means, variances, move, start = (np.array(model[k]) for k in ("means", "variances", "transition", "start"))
    x = np.array([6.0, 18.0, 22.0, 39.0, 21.0, 4.0])
    emit = models._emissions(x, means, variances)
    weight = {}
    for path in itertools.product(range(3), repeat=len(x)):
        w = start[path[0]] * emit[0, path[0]]
        for i in range(1, len(x)):
            w *= move[path[i - 1], path[i]] * emit[i, path[i]]
        weight[path] = w
    total = sum(weight.values())
    posterior, moves, likelihood = models.forward_backward(emit, move, start)
    for i, s in itertools.product(range(len(x)), range(3)):
        assert abs(posterior[i, s] - sum(w for p, w in weight.items() if p[i] == s) / total) < 1e-9
    for a, b in itertools.product(range(3), repeat=2):
        assert abs(moves[a, b] - sum(w * sum(p[i - 1] == a and p[i] == b for i in range(1, len(x))) for p, w in weight.items()) / total) < 1e-9
    assert abs(likelihood - np.log(total)) < 1e-9
    df = spark.createDataFrame([(c, i, float(v) + c) for c in range(3) for i, v in enumerate(x)], "chunk long, pos long, depth double")
    first = models.hmm_train(df, model, 1)
    later = models.hmm_train(df, model, 6)
    assert later["likelihood"] > first["likelihood"]
    assert models.hmm_labels(df, model).count() == 18


def per_letter(spark, name):
    return frame(spark, SF, name)


def test_final_labels_per_letter(spark):
    r = random.Random(3)
    tracks = [("c1", s, s + r.randrange(1, 60), r.choice("AB")) for s in (r.randrange(900) for _ in range(40))]
    df = spark.createDataFrame(tracks, "chrom string, start long, end long, label string")
    contigs = spark.createDataFrame([("c1", 1000), ("c2", 50)], "chrom string, length long")
    claims = [set() for _ in range(1000)]
    for label in "AB":
        merged = []
        for _, s, e, x in sorted(t for t in tracks if t[3] == label):
            if merged and s <= merged[-1][1] + 10:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        for s, e in merged:
            if e - s >= 30:
                for i in range(s, min(e, 1000)):
                    claims[i].add(label)
    want = ["Unk" if not c else "Amb" if len(c) > 1 else c.pop() for c in claims]
    got = [None] * 1000
    for b in coverage.final_labels(df, contigs, 10, 30).where("chrom = 'c1'").collect():
        for i in range(b.start, min(b.end, 1000)):
            assert got[i] is None
            got[i] = b.label
    assert got == want
    assert [tuple(b) for b in coverage.final_labels(df, contigs, 10, 30).where("chrom = 'c2'").select("start", "end", "label").collect()] == [(0, 50, "Unk")]


def test_collapsed_candidates_per_letter(spark):
    hits = spark.createDataFrame([("c1", 10, 60), ("c1", 50, 80)], "chrom string, start long, end long")
    dels = spark.createDataFrame([("c1", 20, 30), ("c1", 40, 45), ("c1", 78, 90)], "chrom string, start long, end long")
    contigs = spark.createDataFrame([("c1", 100)], "chrom string, length long")
    assert sorted(tuple(r) for r in coverage.collapsed_candidates(hits, dels, contigs, 10).collect()) == [("c1", 0, 10), ("c1", 20, 30), ("c1", 78, 100)]


def test_nearest_blocks_edges(spark):
    reads = spark.createDataFrame([("a", "c", 50, 60), ("b", "c", 0, 5), ("d", "c", 900, 950), ("e", "x", 1, 2)], "read string, chrom string, start long, end long")
    blocks = spark.createDataFrame([(1, "c", 10, 20), (2, "c", 30, 55), (3, "c", 58, 70), (4, "c", 100, 200)], "block long, chrom string, b_start long, b_end long")
    got = {(r.read, r.rk): (r.block, r.dist) for r in pileup.nearest_blocks(reads, blocks).collect()}
    assert got == {("a", 1): (2, -5), ("a", 2): (3, -2), ("b", 1): (1, 5), ("b", 2): (2, 25), ("d", 1): (4, 700), ("d", 2): (3, 830)}


def test_cutoff_is_exact_on_ties_and_small_tables(spark):
    for values in ([0.5], [0.1, 0.2], [0.25] * 7 + [1.0], [i / 97 for i in range(98)], [0.0, 0.0, 1.0, 1.0, 1.0]):
        for alpha in (0.0, 0.1, 0.5, 1.0):
            df = spark.createDataFrame([(v,) for v in values], "x double")
            assert abs(assignment.global_cutoff(df, ["x"], alpha).first()[0] - np.quantile(values, 1 - alpha)) < 1e-12


def test_windows_of_a_stream(spark, tmp_path):
    """A stream gives the batch's rows once a far later event has moved the watermark past them all."""
    from helixframe.streaming import sessions

    events = spark.read.parquet(f"{SF}/events.parquet")
    far = events.limit(1).withColumn("ts", F.expr("timestamp_ntz'2035-01-01'")).withColumn("event_type", F.lit("end")).withColumn("user_id", F.lit(-1).cast("long"))
    for name, made in (("w", lambda e: sessions.tumbling(e, ["event_type"], "1 day", "value", "400 days")), ("s", lambda e: sessions.sessions(e, ["user_id"], "6 hours", "400 days"))):
        events.repartition(3).write.parquet(f"{tmp_path}/in-{name}")
        for step in range(2):
            stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in-{name}")
            out = made(stream)
            out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{tmp_path}/c-{name}").trigger(availableNow=True).start(f"{tmp_path}/out-{name}").awaitTermination(120)
            if not step:
                far.write.mode("append").parquet(f"{tmp_path}/in-{name}")
        got = {tuple(map(str, r)) for r in spark.read.parquet(f"{tmp_path}/out-{name}").collect()}
        assert {g for g in got if g[0] not in ("end", "-1")} == {tuple(map(str, r)) for r in made(events).collect()}


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_queries_without_sql_give_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).columns
