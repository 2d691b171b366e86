"""Greedy clustering and pairing of signatures (chrom, svtype, hp, pos, svlen, qname, ...).

The order is fixed: position, then longer first, then name. Both operators stream sorted rows and hold
only those within the largest shift of the current one, so a task's memory does not follow the size of an island.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators.calling import gap_partitions

COLUMNS = "chrom string, svtype string, hp string, pos long, svlen long, qname string"


def alike(svtype: str, pos: int, size: int, other: int, other_size: int, shift: int, overlap: float = 0.5, similarity: float = 0.5) -> bool:
    """Near enough, of similar size, and for deletions with enough overlap of the shorter one."""
    if abs(pos - other) > shift or min(size, other_size) < similarity * max(size, other_size):
        return False
    return svtype != "DEL" or min(pos + size, other + other_size) - max(pos, other) >= overlap * min(size, other_size)


def seed_clusters(sigs: DataFrame, shift: int = 100) -> DataFrame:
    """The longest signature of each cluster (the first on ties), with the cluster's size n.

    The first signature that no cluster holds is a seed; those after it that are like the seed join it.
    A null in a key keeps its rows together; an empty table gives an empty one.
    """
    keys = ["chrom", "svtype", "hp"]

    def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, seeds = None, []  # each seed: pos, svlen, best row, size
        for frame in frames:
            out = []
            for part, *row in frame.itertuples(index=False, name=None):
                here = (part, *row[:3])
                if here != group:
                    out += [(*s[2], s[3]) for s in seeds]
                    group, seeds = here, []
                pos, size = row[3], row[4]
                while seeds and seeds[0][0] < pos - shift:
                    s = seeds.pop(0)
                    out.append((*s[2], s[3]))
                for s in seeds:
                    if alike(row[1], s[0], s[1], pos, size, shift):
                        s[3] += 1
                        if size > s[2][4]:
                            s[2] = row
                        break
                else:
                    seeds.append([pos, size, row, 1])
            yield pd.DataFrame(out, columns=[*frame.columns[1:], "n"])
        yield pd.DataFrame([(*s[2], s[3]) for s in seeds], columns=["chrom", "svtype", "hp", "pos", "svlen", "qname", "n"])

    rows = gap_partitions(sigs.select(*keys, "pos", "svlen", "qname"), keys, shift).select("part", *keys, "pos", "svlen", "qname")
    rows = rows.repartition(*keys, "part").sortWithinPartitions(*keys, "part", "pos", F.desc("svlen"), "qname")
    return rows.mapInPandas(pick, COLUMNS + ", n long")


def pair_haplotypes(first: DataFrame, second: DataFrame, shift: int = 200) -> DataFrame:
    """One call per pair of the two haplotypes' signatures, and per signature without partner.

    Each signature of the first haplotype, in order, takes the first free one of the second that is like it.
    The longer of a pair is called (the second haplotype's on ties) as 1/1, the others as 0/1.
    A signature of the first haplotype is decided when all of the second within reach have passed: rows sort by
    pos, those of the first by pos + shift.
    """
    keys = ["chrom", "svtype"]
    both = first.select(*keys, "pos", "svlen", "qname").withColumn("side", F.lit(1)).unionByName(second.select(*keys, "pos", "svlen", "qname").withColumn("side", F.lit(0)))
    rows = gap_partitions(both, keys, shift).withColumn("at", F.col("pos") + F.col("side") * shift)
    names = ["chrom", "svtype", "pos", "svlen", "gt", "qname1", "qname2"]

    def pair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, free = None, []
        alone = lambda x: (*x[:4], "0/1", None, x[4])
        for frame in frames:
            out = []
            for part, side, *row in frame.itertuples(index=False, name=None):
                here = (part, *row[:2])
                if here != group:
                    out += map(alone, free)
                    group, free = here, []
                if side == 0:
                    free.append(row)
                    continue
                while free and free[0][2] < row[2] - shift:
                    out.append(alone(free.pop(0)))
                for i, other in enumerate(free):
                    if alike(row[1], row[2], row[3], other[2], other[3], shift):
                        longer = row if row[3] > other[3] else other
                        out.append((*longer[:4], "1/1", row[4], other[4]))
                        del free[i]
                        break
                else:
                    out.append((*row[:4], "0/1", row[4], None))
            yield pd.DataFrame(out, columns=names)
        yield pd.DataFrame(list(map(alone, free)), columns=names)

    rows = rows.select("part", "side", *keys, "pos", "svlen", "qname", "at").repartition(*keys, "part")
    rows = rows.sortWithinPartitions(*keys, "part", "at", "side", F.desc("svlen"), "qname").drop("at")
    return rows.mapInPandas(pair, "chrom string, svtype string, pos long, svlen long, gt string, qname1 string, qname2 string")
