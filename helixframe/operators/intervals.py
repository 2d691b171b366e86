"""Interval algebra on tables (chrom, start, end, ...), 0-based and half-open unless a name says otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Positions per bin of the range joins; choose it near the 99th percentile of lengths.
BIN = 2_000
#: Positions per tile in which blocks are merged first, so that no chromosome is sorted whole.
TILE = 100_000


def bins(start: Column, end: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(start / width), F.floor((F.greatest(end, start + 1) - 1) / width)))


def overlap_join(a: DataFrame, b: DataFrame, width: int = BIN, how: str = "inner") -> DataFrame:
    """Pairs of a (chrom, start, end) and b (chrom, b_start, b_end) that overlap.

    Both sides meet in bins; a pair counts only in the bin of the larger start, so no distinct is needed.
    With left_semi the pair's bin does not matter, but rows of a that span bins need distinct keys afterwards.
    """
    left = a.withColumn("_bin", bins(F.col("start"), F.col("end"), width))
    right = b.withColumnRenamed("chrom", "b_chrom").withColumn("b_bin", bins(F.col("b_start"), F.col("b_end"), width))
    on = (
        (F.col("chrom") == F.col("b_chrom")) & (F.col("_bin") == F.col("b_bin")) & (F.col("start") < F.col("b_end")) & (F.col("b_start") < F.col("end"))
        & (F.floor(F.greatest("start", "b_start") / width) == F.col("_bin"))
    )
    out = left.join(right, on, how)
    return out.drop("_bin") if how == "left_semi" else out.drop("_bin", "b_bin", "b_chrom")


def in_order(rows: DataFrame, chrom: str, bin_: str, order: list[str], number: str) -> DataFrame:
    """Rows of a bin by order, numbered. A window sorts them, as the optimizer drops a sort below a join; a join by sorting keeps that order, as it has the window's keys."""
    return rows.withColumn(number, F.row_number().over(W.partitionBy(chrom, bin_).orderBy(*order)))


def ordered_overlaps(a: DataFrame, b: DataFrame, width: int = BIN // 2) -> DataFrame:
    """The pairs of overlap_join, for joins of far more pairs than rows: those of a row of b follow each other, by the starts of b and then of a.

    What neighbouring rows of b meet is nearly the same list, which files hold in a fraction of the space.
    """
    left = a.withColumn("_bin", bins(F.col("start"), F.col("end"), width)).withColumn("_first", F.col("start") >= F.col("_bin") * width)
    right = b.withColumnRenamed("chrom", "b_chrom").withColumn("b_bin", bins(F.col("b_start"), F.col("b_end"), width)).withColumn("b_first", F.col("b_start") >= F.col("b_bin") * width)
    left, right = in_order(left, "chrom", "_bin", ["start", "end"], "_n"), in_order(right, "b_chrom", "b_bin", ["b_start", "b_end"], "b_n")
    # The larger start lies in the bin if either does. The numbers are asked for, or the windows would be dropped as unused.
    on = (
        (F.col("chrom") == F.col("b_chrom")) & (F.col("_bin") == F.col("b_bin")) & (F.col("start") < F.col("b_end")) & (F.col("b_start") < F.col("end"))
        & (F.col("_first") | F.col("b_first")) & (F.col("_n") > 0) & (F.col("b_n") > 0)
    )
    return right.join(left, on).select(*a.columns, *[c for c in b.columns if c != "chrom"])


def starts_within(points: DataFrame, blocks: DataFrame, on: Column, width: int) -> DataFrame:
    """Pairs of points (p_chrom, p_start, p_end, p_bin) with the blocks (q_chrom, q_start, q_end, q_bin) on whose condition the point's start lies in the block: point after point, each with its blocks by their ends.

    Both sides come once for each bin of theirs; as a point, a row counts in the first one. So a table is shuffled in the same way for both of its parts, and one shuffle serves them.
    """
    points, blocks = in_order(points, "p_chrom", "p_bin", ["p_start", "p_end"], "p_n"), in_order(blocks, "q_chrom", "q_bin", ["q_end", "q_start"], "q_n")
    points = points.where(F.col("p_start") >= F.col("p_bin") * width)
    on = (F.col("p_chrom") == F.col("q_chrom")) & (F.col("p_bin") == F.col("q_bin")) & on & (F.col("p_start") < F.col("q_end")) & (F.col("q_start") < F.col("p_end")) & (F.col("p_n") > 0) & (F.col("q_n") > 0)
    return points.join(blocks, on)


def band_join(calls: DataFrame, points: DataFrame, radius: Column, width: int, how: str = "inner", keys: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """calls (chrom, pos) with points (p_chrom, p_pos) at most radius away and equal keys (column of calls, column of points); only the calls' bands are binned."""
    left = calls.withColumn("_radius", radius).withColumn("_bin", bins(F.col("pos") - F.col("_radius"), F.col("pos") + F.col("_radius") + 1, width))
    right = points.withColumn("p_bin", F.floor(F.col("p_pos") / width))
    on = (F.col("chrom") == F.col("p_chrom")) & (F.col("_bin") == F.col("p_bin")) & (F.abs(F.col("pos") - F.col("p_pos")) <= F.col("_radius"))
    for ours, theirs in keys:
        on = on & (F.col(ours) == F.col(theirs))
    return left.join(right, on, how).drop("_bin", "p_bin", "_radius")


def islands(df: DataFrame, keys: list[str], distance: int = 0) -> DataFrame:
    """Merge blocks whose start is at most distance past the furthest end before them."""
    order = W.partitionBy(*keys).orderBy("start", "end")
    ahead = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    marked = df.withColumn("_new", F.when(ahead.isNull() | (F.col("start") > ahead + distance), 1).otherwise(0))
    marked = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def apart_from_borders(local: DataFrame, tile: int, distance: int = 0) -> DataFrame:
    """Tile numbers of blocks that are merged within their tile: -1 for those near enough to a border to go on in the next one, so that only they are sorted together."""
    near = (F.col("start") - F.col("_tile") * tile <= distance) | ((F.col("_tile") + 1) * tile - F.col("end") <= distance)
    return local.withColumn("_tile", F.when(near, F.lit(-1).cast("long")).otherwise(F.col("_tile")))


def merge_blocks(df: DataFrame, distance: int = 0, tile: int = TILE) -> DataFrame:
    """Union of blocks: first within tiles, at whose borders blocks are cut, then over those of each chromosome that lie at a border."""
    cut = df.select("chrom", "start", "end", bins(F.col("start"), F.col("end"), tile).alias("_tile"))
    cut = cut.select("chrom", "_tile", F.greatest("start", F.col("_tile") * tile).alias("start"), F.least("end", (F.col("_tile") + 1) * tile).alias("end"))
    return islands(apart_from_borders(islands(cut, ["chrom", "_tile"], distance), tile, distance), ["chrom", "_tile"], distance).drop("_tile")


def intersect(a: DataFrame, b: DataFrame, width: int = BIN // 4) -> DataFrame:
    """Pairs of a (chrom, start, end) and b (chrom, b_start, b_end) that overlap, with i_start and i_end.

    The pairs in which a begins first and the others are joined apart, each with the later start as the point: then i_start is one value
    for all blocks that a point meets, and i_end the blocks' ends in order and then one value, which files hold in a fraction of the space.
    """
    def side(df, prefix, start, end):
        names = {"chrom": f"{prefix}_chrom", start: f"{prefix}_start", end: f"{prefix}_end"}
        return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns], bins(F.col(start), F.col(end), width).alias(f"{prefix}_bin"))

    def named(pairs, first, second):
        found = {"chrom": f"{first}_chrom", "start": f"{first}_start", "end": f"{first}_end", "b_start": f"{second}_start", "b_end": f"{second}_end"}
        return pairs.select(*[F.col(found.get(c, c)).alias(c) for c in [*a.columns, *[c for c in b.columns if c != "chrom"]]], F.col("p_start").alias("i_start"), F.least("p_end", "q_end").alias("i_end"))

    within_a = starts_within(side(b, "p", "b_start", "b_end"), side(a, "q", "start", "end"), F.col("q_start") <= F.col("p_start"), width)
    within_b = starts_within(side(a, "p", "start", "end"), side(b, "q", "b_start", "b_end"), F.col("q_start") < F.col("p_start"), width)
    return named(within_a, "q", "p").unionByName(named(within_b, "p", "q"))


def subtract(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """The parts of each block of a (named by key) that no block of b covers."""
    merged = merge_blocks(b).select("chrom", F.col("start").alias("b_start"), F.col("end").alias("b_end"))
    hits = overlap_join(a, merged).select(key, "chrom", "start", "end", "b_start", "b_end")
    none = a.join(hits.select(key).distinct(), key, "left_anti").select(key, "chrom", "start", "end")
    order = W.partitionBy(key).orderBy("b_start")
    hits = hits.withColumn("from", F.coalesce(F.lag("b_end").over(order), F.col("start"))).withColumn("last", F.lead("b_start").over(order).isNull())
    before = hits.select(key, "chrom", F.col("from").alias("start"), F.col("b_start").alias("end"))
    after = hits.where("last").select(key, "chrom", F.col("b_end").alias("start"), "end")
    return before.unionByName(after).where("start < end").unionByName(none)


def complement(blocks: DataFrame, contigs: DataFrame, tile: int = TILE) -> DataFrame:
    """The parts of contigs (chrom, length) that no block covers: sought in each tile, and joined where they meet at its border."""
    tiles = contigs.select("chrom", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.greatest("length", F.lit(1)) - 1) / tile))).alias("_tile"))
    whole = tiles.select("chrom", "_tile", (F.col("_tile") * tile).alias("start"), F.least("length", (F.col("_tile") + 1) * tile).alias("end"))
    # A contig of many blocks is one key per tile. Borders lie between letters, so pieces meet but never overlap.
    parts = subtract(whole.select(F.struct("chrom", "_tile").alias("_key"), "chrom", "start", "end"), blocks, "_key").select("chrom", F.col("_key._tile").alias("_tile"), "start", "end").where("start < end")
    return islands(apart_from_borders(parts, tile), ["chrom", "_tile"]).drop("_tile")


def joined_tiles(rows: DataFrame, tiles: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the columns of their tile's summary; null keys match."""
    names = [*keys, "_tile"]
    tiles = tiles.select(*[F.col(k).alias(f"_of_{k}") for k in names], *[c for c in tiles.columns if c not in names])
    on = F.lit(True)
    for k in names:
        on = on & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return rows.join(tiles, on).drop(*[f"_of_{k}" for k in names])


def _steps(blocks: DataFrame, weight: Column, keys: list[str]) -> DataFrame:
    """(keys, at, d): where blocks begin and end, with what they add and take."""
    return blocks.select(*keys, F.explode(F.array(F.struct(F.col("start").alias("at"), weight.alias("d")), F.struct(F.col("end").alias("at"), (-weight).alias("d")))).alias("e")).select(*keys, "e.*")


def _summed(steps: DataFrame, tile: int, keys: list[str]) -> DataFrame:
    """Steps (keys, start, d, ...) with depth, the sum of all up to them, and end, the next start: summed within tiles, to which the sums of the tiles before are added."""
    steps = steps.withColumn("_tile", F.floor(F.col("start") / tile))
    order = W.partitionBy(*keys, "_tile").orderBy("start")
    across = W.partitionBy(*keys).orderBy("_tile")
    local = steps.withColumn("_sum", F.sum("d").over(order)).withColumn("_next", F.lead("start").over(order))
    tiles = steps.groupBy(*keys, "_tile").agg(F.sum("d").alias("_d"), F.min("start").alias("_first"))
    tiles = tiles.select(*keys, "_tile", F.coalesce(F.sum("_d").over(across.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.lead("_first").over(across).alias("_after"))
    return joined_tiles(local, tiles, keys).withColumn("end", F.coalesce("_next", "_after")).withColumn("depth", F.col("_sum") + F.col("_before"))


def depth(blocks: DataFrame, tile: int = TILE, weight: Column | None = None, keys: tuple[str, ...] = ("chrom",)) -> DataFrame:
    """(keys, start, end, depth) of the stretches of equal cover, without stretches of none. A block adds its weight, 1 if there is none.

    Steps are summed within tiles, to which the sums of the tiles before are added; no chromosome is sorted whole.
    """
    steps = _steps(blocks, F.lit(1) if weight is None else weight, list(keys))
    steps = steps.groupBy(*keys, F.col("at").alias("start")).agg(F.sum("d").alias("d")).where("d <> 0")
    return _summed(steps, tile, list(keys)).select(*keys, "start", "end", "depth").where("depth > 0")


def depth_at(points: DataFrame, blocks: DataFrame, tile: int = TILE) -> DataFrame:
    """(chrom, at, depth): how many blocks cover each of the distinct points (chrom, at), 0 included. No point meets a block."""
    steps = _steps(blocks, F.lit(1), ["chrom"]).withColumn("_point", F.lit(False)).unionByName(points.select("chrom", "at", F.lit(0).alias("d"), F.lit(True).alias("_point")))
    steps = steps.groupBy("chrom", F.col("at").alias("start")).agg(F.sum("d").alias("d"), F.bool_or("_point").alias("_point"))
    return _summed(steps, tile, ["chrom"]).where("_point").select("chrom", F.col("start").alias("at"), "depth")


def memberships(tracks: dict[str, DataFrame]) -> DataFrame:
    """(chrom, start, end, n_tracks, tracks) of the stretches that the same tracks (blocks chrom, start, end; up to 62 of them) cover; tracks are named in their order, comma-joined.

    Each track is merged first, so that the sum of powers of two over a stretch is its set of tracks.
    """
    if not 0 < len(tracks) <= 62:
        raise ValueError("1 to 62 tracks")
    merged = None
    for i, blocks in enumerate(tracks.values()):
        rows = merge_blocks(blocks).select("chrom", "start", "end", F.lit(1 << i).cast("long").alias("_bit"))
        merged = rows if merged is None else merged.unionByName(rows)
    names = F.concat_ws(",", *[F.when(F.col("depth").bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(t)) for i, t in enumerate(tracks)])
    return depth(merged, weight=F.col("_bit")).select("chrom", "start", "end", F.bit_count("depth").alias("n_tracks"), names.alias("tracks"))


def run_lengths(df: DataFrame, keys: list[str], pos: str, value: str, tile: int = TILE) -> DataFrame:
    """Closed runs of equal value at consecutive positions, found within tiles and joined at their borders. A position occurs once."""
    rows = df.withColumn("_tile", F.floor(F.col(pos) / tile))
    island = F.col(pos) - F.row_number().over(W.partitionBy(*keys, value, "_tile").orderBy(pos))
    local = rows.withColumn("_run", island).groupBy(*keys, value, "_tile", "_run").agg(F.min(pos).alias("start"), (F.max(pos) + 1).alias("end")).drop("_run")
    return islands(apart_from_borders(local, tile), [*keys, value, "_tile"]).drop("_tile").withColumn("end", F.col("end") - 1)


def assign_gaps(blocks: DataFrame, tile: int = TILE) -> DataFrame:
    """Fill the gaps between consecutive typed blocks (chrom, start, end, kind): with the common kind, or split in the middle."""
    rows = blocks.withColumn("_tile", F.floor(F.col("start") / tile)).withColumn("_block", F.struct("start", "end", "kind"))
    # The block before the first one of a tile is the last one of the tile before.
    across = W.partitionBy("chrom").orderBy("_tile")
    tiles = rows.groupBy("chrom", "_tile").agg(F.max("_block").alias("_last")).select("chrom", "_tile", F.lag("_last").over(across).alias("_earlier"))
    rows = rows.withColumn("_before", F.lag("_block").over(W.partitionBy("chrom", "_tile").orderBy("start", "end", "kind")))
    rows = joined_tiles(rows, tiles, ["chrom"]).withColumn("_before", F.coalesce("_before", "_earlier"))
    gaps = rows.withColumn("p_end", F.col("_before.end")).withColumn("p_kind", F.col("_before.kind")).where("p_end < start")
    mid = F.floor((F.col("p_end") + F.col("start")) / 2)
    parts = F.when(F.col("kind") == F.col("p_kind"), F.array(F.struct(F.col("p_end").alias("s"), F.col("start").alias("e"), F.col("kind").alias("k")))).otherwise(
        F.array(F.struct(F.col("p_end").alias("s"), mid.alias("e"), F.col("p_kind").alias("k")), F.struct(mid.alias("s"), F.col("start").alias("e"), F.col("kind").alias("k"))))
    return gaps.select("chrom", F.explode(parts).alias("g")).select("chrom", F.col("g.s").alias("start"), F.col("g.e").alias("end"), F.col("g.k").alias("kind")).where("start < end")
