"""Best-fit packing of documents into sequences of several permitted lengths.

Lengths are whole numbers up to the longest permitted one, so that best-fit decreasing
can be run on the histogram of lengths: equal items meet equal bins, and a run of them is
placed at once.  The plan is exactly what placing the items one by one would give, and
its size depends on the longest length, not on the number of documents.  It is computed
for several rules of opening bins (each permitted length alone, and the least cost per item that
fits) and the cheapest after downsizing is taken: finally each bin becomes the
smallest permitted length that holds its contents.

Documents find their places by their rank among those of equal length; ranks come
from counts per (length, salt), so that a frequent length is spread over many tasks.
A document longer than the longest length is cut into full sequences and a rest; nothing is dropped.

Edge cases: a null or blank text has length 0 and one row without a bin; rows that repeat
an id are placed each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.llm.common import documents, importable, written

WORD = r"[^\x20\x09-\x0D]+"
#: Permitted lengths of a sequence, in words, and what one costs: its length and a quadratic share.
SIZES = (256, 512, 1024, 2048)
#: Documents are dealt into one part for each so many of them, at least and at most so many parts; a part's documents are ranked in one task.
DOCUMENTS_A_SALT = 100_000
SALTS = (64, 1 << 16)


def cost(size: int) -> float:
    return size + size * size / 16384


def plan_bins(histogram: dict[int, int], sizes: tuple[int, ...], opening) -> tuple[list[tuple], list[tuple], float]:
    """Best-fit decreasing. opening(length) says which size to open for an item that fits nowhere.

    Returns runs (length, rank of the first item, items, first bin, items per bin, offset of the first
    in its bin), groups of equal bins (first bin, bins, final size), and the cost.
    """
    room: dict[int, list[tuple[int, int, int]]] = {}  # by space left: (first bin, bins, size opened)
    spaces: list[int] = []
    runs, bins = [], 0

    def put(space: int, group: tuple[int, int, int]) -> None:
        if space not in room:
            room[space] = []
            bisect.insort(spaces, space)
        room[space].append(group)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            i = bisect.bisect_left(spaces, length)
            if i == len(spaces):
                size = opening(length)
                opened = -(-left // (size // length))
                put(size, (bins, opened, size))
                bins += opened
                continue
            space = spaces[i]
            first, count, size = room[space].pop()
            if not room[space]:
                del room[space]
                spaces.pop(i)
            each = space // length
            n = min(left, count * each)
            runs.append((length, rank, n, first, each, size - space))
            full, rest = divmod(n, each)
            if full:
                put(space - each * length, (first, full, size))
            if rest:
                put(space - rest * length, (first + full, 1, size))
            if count > full + bool(rest):
                put(space, (first + full + bool(rest), count - full - bool(rest), size))
            left, rank = left - n, rank + n
    groups = [(first, count, next(s for s in sizes if s >= size - space)) for space, held in room.items() for first, count, size in held]
    return runs, sorted(groups), sum(count * cost(size) for _, count, size in groups)


def best_plan(histogram: dict[int, int], sizes: tuple[int, ...] = SIZES) -> tuple[list[tuple], list[tuple]]:
    """The cheapest plan over the rules of opening bins."""
    sizes = tuple(sorted(sizes))
    fitting = lambda n: [s for s in sizes if s >= n]
    rules = [lambda n: min(fitting(n), key=lambda s: (cost(s) / (s // n), s)), lambda n: min(fitting(n), key=lambda s: (cost(s) / s, s))]
    rules += [lambda n, s=s: s if s >= n else fitting(n)[0] for s in sizes]
    return min((plan_bins(histogram, sizes, rule) for rule in rules), key=lambda p: p[2])[:2]


RUN = "array<struct<rank:long,n:long,bin:long,each:long,offset:int>>"


def pack(docs: DataFrame, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """One row per piece: doc_id, piece, start and length (words of the document), bin_id, bin_size, bin_offset."""
    spark = docs.sparkSession
    longest = max(sizes)
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long"), size.alias("size"))
    rows = rows.withColumn("whole", F.floor(F.col("size") / longest)).withColumn("rest", F.col("size") % longest)
    salts = min(max(docs.count() // DOCUMENTS_A_SALT, SALTS[0]), SALTS[1])
    # Rows that repeat an id are dealt by their size too.
    rows = written(rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "size"), F.lit(salts)).cast("int")), "pack-sizes")

    # The histogram has fewer rows than the longest length.
    histogram = {r.rest: r["count"] for r in rows.where("rest > 0").groupBy("rest").count().collect()}
    runs, groups = best_plan(histogram, sizes)
    bins = sum(g[1] for g in groups)
    by_length: dict[int, list[tuple]] = {}
    for length, rank, n, first, each, offset in runs:
        by_length.setdefault(length, []).append((rank, n, first, each, offset))
    plan = spark.createDataFrame(list(by_length.items()) or [(-1, [])], f"length int, runs {RUN}")
    final = spark.createDataFrame([tuple(g) for g in groups] or [(-1, 0, 0)], "first_bin long, bins long, bin_size int")

    before = W.partitionBy("rest").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    bases = rows.where("rest > 0").groupBy("rest", "salt").count().withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))).select("rest", "salt", "base")
    rests = rows.where("rest > 0").withColumn("rank", F.row_number().over(W.partitionBy("rest", "salt").orderBy("doc_id", "size")) - 1)
    rests = rests.join(bases, ["rest", "salt"]).withColumn("rank", F.col("rank") + F.col("base"))
    rests = rests.join(F.broadcast(plan), F.col("rest") == F.col("length"))
    rests = rests.withColumn("run", F.filter("runs", lambda r: (F.col("rank") >= r["rank"]) & (F.col("rank") < r["rank"] + r["n"]))[0]).drop("runs")
    at = F.col("rank") - F.col("run.rank")
    rests = rests.select(
        "doc_id", F.col("whole").cast("int").alias("piece"), (F.col("whole") * longest).alias("start"), F.col("rest").cast("int").alias("length"),
        (F.col("run.bin") + F.floor(at / F.col("run.each"))).alias("bin_id"), (F.col("run.offset") + (at % F.col("run.each")) * F.col("rest")).cast("int").alias("bin_offset"))
    # Bins of one group are neighbours with one final size; a small table of bounds, looked up by search.
    firsts = sorted(groups)
    table = F.array(*[F.struct(F.lit(g[0]).cast("long").alias("first"), F.lit(g[2]).alias("size")) for g in firsts]) if len(firsts) <= 64 else None
    if table is not None and firsts:
        rests = rests.withColumn("bin_size", F.element_at(F.filter(table, lambda g: g["first"] <= F.col("bin_id")), -1)["size"])
    else:
        rests = _sized(rests, final, bins)

    sums = rows.where("whole > 0").groupBy("salt").agg(F.sum("whole").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(W.orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("salt", "base")
    wholes = rows.where("whole > 0").withColumn("first", F.coalesce(F.sum("whole").over(W.partitionBy("salt").orderBy("doc_id", "size").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    wholes = wholes.join(F.broadcast(sums), "salt").withColumn("piece", F.explode(F.sequence(F.lit(0), (F.col("whole") - 1).cast("int"))))
    wholes = wholes.select("doc_id", "piece", (F.col("piece") * longest).cast("long").alias("start"), F.lit(longest).alias("length"), (F.lit(bins) + F.col("base") + F.col("first") + F.col("piece")).cast("long").alias("bin_id"), F.lit(0).alias("bin_offset"), F.lit(longest).alias("bin_size"))
    blank = rows.where("size = 0").select("doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(0).alias("length"), F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("int").alias("bin_offset"), F.lit(None).cast("int").alias("bin_size"))
    names = ["doc_id", "piece", "start", "length", "bin_id", "bin_size", "bin_offset"]
    return rests.select(*names).unionByName(wholes.select(*names)).unionByName(blank.select(*names))


def _sized(rests: DataFrame, final: DataFrame, bins: int) -> DataFrame:
    """Give each piece its bin's final size: groups are cut at multiples of a width, and joined on that cell."""
    width = 1 << 12
    cells = final.withColumn("cell", F.explode(F.sequence(F.floor(F.col("first_bin") / width), F.floor((F.col("first_bin") + F.col("bins") - 1) / width))))
    joined = rests.withColumn("cell", F.floor(F.col("bin_id") / width)).join(cells, "cell")
    return joined.where((F.col("bin_id") >= F.col("first_bin")) & (F.col("bin_id") < F.col("first_bin") + F.col("bins")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def pipeline_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return pack(docs)
