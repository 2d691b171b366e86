"""Joins of blocks: every pair once, against plain code, and written in a fraction of the space that pairs in no order take."""

import random

import duckdb
import pytest

from helixframe.operators import intervals
from helixframe.plans import catalogue


def _random_blocks(rng, n, names):
    # Short, long, empty and backward blocks, copies, and starts at the borders of bins and below zero.
    rows = []
    for i in range(n):
        start = rng.choice([rng.randrange(-1500, 4000), rng.choice([-500, 0, 500, 1000, 2000])])
        rows.append((f"{names}{i}", rng.choice(["c1", "c2"]), start, start + rng.choice([0, 1, -3, 10, 500, 1000, 2600, rng.randrange(1, 900)])))
    return [*rows, *[(f"{names}copy", *rows[0][1:]), (f"{names}null", None, 0, 900)]]


def _pairs(a, b):
    return sorted((x, y, max(s, t), min(e, f)) for x, c, s, e in a for y, d, t, f in b if c is not None and c == d and s < f and t < e)


@pytest.mark.parametrize("width", [None, 37, 500])
def test_each_pair_of_proper_blocks_once(spark, width):
    rng = random.Random(5)
    a, b = ([r for r in _random_blocks(rng, 150, n) if r[2] < r[3]] for n in "ab")
    left = spark.createDataFrame(a, "x string, chrom string, start long, end long")
    right = spark.createDataFrame(b, "y string, chrom string, b_start long, b_end long")
    more = {} if width is None else {"width": width}
    cut = intervals.intersect(left, right, **more)
    assert cut.columns == ["x", "chrom", "start", "end", "y", "b_start", "b_end", "i_start", "i_end"]
    assert sorted(tuple(r) for r in cut.select("x", "y", "i_start", "i_end").collect()) == _pairs(a, b)
    both = intervals.ordered_overlaps(left, right, **more)
    assert both.columns == cut.columns[:-2]
    assert sorted((r.x, r.y, max(r.start, r.b_start), min(r.end, r.b_end)) for r in both.collect()) == _pairs(a, b)


def test_empty_and_backward_blocks_as_in_the_plain_join(spark):
    rng = random.Random(6)
    left = spark.createDataFrame(_random_blocks(rng, 150, "a"), "x string, chrom string, start long, end long")
    right = spark.createDataFrame(_random_blocks(rng, 150, "b"), "y string, chrom string, b_start long, b_end long")
    plain = sorted(tuple(r) for r in intervals.overlap_join(left, right).select("x", "y").collect())
    assert len(plain) > 1000
    for found in (intervals.intersect(left, right), intervals.ordered_overlaps(left, right)):
        assert sorted(tuple(r) for r in found.select("x", "y").collect()) == plain


@pytest.mark.parametrize("name, columns", [("interval_intersect", ("svid", "i_start", "i_end")), ("overlay", ("svid", "qname", "hp"))])
def test_dense_pairs_are_written_small(spark, tmp_path, name, columns):
    rng, apart = random.Random(7), pow(7919, -1, 1_000_000)  # keys of neighbouring positions are so far apart
    orders = [(k * apart % 1_000_000, 22 * rng.randrange(9), "F") for k in rng.sample(range(3000), 1000)]
    lines = [(rng.randrange(3000) * apart % 1_000_000, rng.randrange(100_000), 22 * rng.randrange(9), 1, float(rng.randrange(1, 51)), "R") for _ in range(4000)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet("/root/testdata/sf0.001/nation.parquet").write.parquet(f"{tmp_path}/nation.parquet")
    # As at size: the tables are too large to be sent whole to the tasks.
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in before:
        spark.conf.set(k, "-1")
    try:
        found = catalogue.QUERIES[name](spark, str(tmp_path)).select(*columns)
        found.write.parquet(f"{tmp_path}/found")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    db = duckdb.connect()
    for t in ("orders", "lineitem", "nation"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    db.sql(f"CREATE TABLE f AS SELECT * FROM '{tmp_path}/found/*.parquet'")
    db.sql(f"CREATE TABLE w AS SELECT {', '.join(columns)} FROM ({catalogue.SQL[name]})")
    n = db.sql("SELECT count(*) FROM w").fetchall()[0][0]
    assert n > 400_000 and db.sql("SELECT count(*) FROM f").fetchall()[0][0] == n
    assert not db.sql("(FROM w EXCEPT ALL FROM f) UNION ALL (FROM f EXCEPT ALL FROM w)").fetchall()
    size = sum(p.stat().st_size for p in (tmp_path / "found").glob("*.parquet"))
    assert size < n
