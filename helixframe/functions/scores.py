"""Scalar similarities, distances and densities."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap(start: Column, end: Column, start2: Column, end2: Column) -> Column:
    """Shared letters; negative where the blocks are apart."""
    return F.least(end, end2) - F.greatest(start, start2)


def overlap_ratio(start: Column, end: Column, start2: Column, end2: Column, of: str = "longer") -> Column:
    """The overlap over the longer or the shorter block."""
    size = (F.greatest if of == "longer" else F.least)(end - start, end2 - start2)
    return F.try_divide(overlap(start, end, start2, end2).cast("double"), size)


def reciprocal_overlap_distance(start: Column, end: Column, way: Column, start2: Column, end2: Column, way2: Column) -> Column:
    """1 less the smaller relative overlap; 1 for blocks of one direction or apart."""
    shared = overlap(start, end, start2, end2)
    return F.when((way == way2) | (shared <= 0), F.lit(1.0)).otherwise(1 - F.least(shared / (end - start), shared / (end2 - start2)))


def position_distance(start: Column, end: Column, start2: Column, end2: Column) -> Column:
    """The least of the distances of starts, ends and (rounded down) middles."""
    middle = lambda a, b: F.floor((a + b) / 2)
    return F.least(F.abs(start - start2), F.abs(end - end2), F.abs(middle(start, end) - middle(start2, end2)))


def is_similar(start: Column, end: Column, start2: Column, end2: Column, near: int = 20) -> Column:
    return (F.abs(start - start2) < near) & (F.abs(end - end2) < near)


def genome_size_label(start: Column, end: Column) -> Column:
    """The size in thousands, 10 at least, with a k. Halves go to the even number."""
    return F.concat(F.greatest(F.bround((end - start) / 1000, 0).cast("long"), F.lit(10)).cast("string"), F.lit("k"))


def normal_density(x: Column, mean: float, sd: float) -> Column:
    z = (x - mean) / sd
    return F.exp(-z * z / 2) / (sd * math.sqrt(2 * math.pi))


def truncated_exponential_density(x: Column, rate: float, most: float) -> Column:
    """Of an exponential that ends at `most`; 0 beyond."""
    return F.when(x.between(0, most), rate * F.exp(-rate * x) / (1 - math.exp(-rate * most))).otherwise(F.lit(0.0))


def poisson_density(k: Column, mean: float) -> Column:
    """Of whole numbers; by logarithms, so that no factorial overflows."""
    log_factorial = F.aggregate(F.sequence(F.lit(1), F.greatest(k, F.lit(1)).cast("int")), F.lit(0.0), lambda s, i: s + F.ln(i.cast("double")))
    return F.exp(k * math.log(mean) - mean - log_factorial)


def divergence_mapq(mapq: Column, edits: Column, length: Column, expected: float) -> Column:
    """The mapping quality less the Phred-scaled chance of fewer edits than seen, where a read has more edits than its length expects.

    The quality falls by -10 log10 of the upper Poisson tail from `edits` on, at most to 0.
    """
    mean = length * expected
    terms = F.sequence(F.lit(0), F.greatest(edits - 1, F.lit(0)).cast("int"))
    # Each term follows from the one before: p(i) = p(i - 1) * mean / i.
    acc = F.aggregate(terms, F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("last")),
                      lambda a, i: F.struct((a["sum"] + F.when(i == 0, F.exp(-mean)).otherwise(a["last"] * mean / F.greatest(i, F.lit(1)))).alias("sum"), F.when(i == 0, F.exp(-mean)).otherwise(a["last"] * mean / F.greatest(i, F.lit(1))).alias("last")), lambda a: a["sum"])
    tail = F.greatest(1 - acc, F.lit(1e-12))
    drop = F.when(edits > mean, F.round(-10 * F.log10(tail), 0)).otherwise(F.lit(0.0))
    return F.greatest(mapq - drop, F.lit(0.0)).cast("int")


def _jaro(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, left = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                left.append(c)
                break
    if not left:
        return 0.0
    moved = sum(x != y for x, y in zip(left, (c for c, t in zip(b, taken, strict=True) if t), strict=True)) // 2
    m = len(left)
    return (m / len(a) + m / len(b) + (m - moved) / m) / 3


def jaro_similarity(a: Column, b: Column) -> Column:
    """Jaro similarity of two texts; Spark has no such function, so it is a vectorised Python one."""

    @F.pandas_udf("double")
    def each(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in pairs:
            yield pd.Series([None if p is None or q is None else _jaro(p, q) for p, q in zip(x, y, strict=True)], dtype="float64")

    return each(a, b)
