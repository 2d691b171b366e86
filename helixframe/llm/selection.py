"""Distributed prefix selection: the first rows of an order, up to a budget, without sorting a group in one task.

Every row has a 64-bit unsigned-style sort key (here a long >= 0).  Weights are
summed per group and key bucket (aggregated before the shuffle), the buckets'
running sums give each bucket its start, and only rows of the bucket in which
the budget runs out are ordered one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Keys are below 2**KEY_BITS; the top BUCKET_BITS of them name the bucket.
KEY_BITS = 60
BUCKET_BITS = 12


def uniform_key(*columns):
    """A number in (0, 1) from the md5 of the columns' text: the same in any SQL engine and on any rerun."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def bucket_of(key: str):
    return F.shiftright(F.col(key), KEY_BITS - BUCKET_BITS).cast("int")


def bucket_starts(rows: DataFrame, group: str, key: str, weight: str) -> DataFrame:
    """(group, bucket, before, within): the weight before each bucket of a group, and in it."""
    sums = rows.groupBy(group, bucket_of(key).alias("bucket")).agg(F.sum(weight).alias("within"))
    order = W.partitionBy(group).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    return sums.withColumn("before", F.coalesce(F.sum("within").over(order), F.lit(0)))
