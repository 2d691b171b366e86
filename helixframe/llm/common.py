"""Spark plumbing shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch: setting, Spark's own value, and ours where the session has that one.
ARROW_BATCH = (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "16777216b"))

#: How a Python worker's allocators behave (glibc's and Arrow's), unless the session's environment says otherwise.
WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}

_ROOT = str(Path(__file__).resolve().parents[2])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the session was started without it, and keep Arrow batches small.

    On a cluster the package is installed or sent with --py-files; there the
    added entry names no folder and is ignored.
    """
    # Bounds what an Arrow batch of long texts takes in the JVM and in Python; a value of the user's own stays.
    for name, usual, ours in ARROW_BATCH:
        if spark.conf.get(name, None) == usual:
            spark.conf.set(name, ours)
    env = spark.sparkContext.environment
    # Python workers live on between tasks: freed arrays go back to the system instead of staying in a worker's heap.
    for name, value in WORKER_MEMORY.items():
        env.setdefault(name, value)
    if _ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (_ROOT, env.get("PYTHONPATH", "")) if x)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local session, in which all is one
    process on one machine, gets a folder of its own; a cluster gets an error, as no folder of the driver's will do."""
    there = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("helixframe.shared.dir", None)
    if not there:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        there = f"file://{tempfile.mkdtemp(prefix='helixframe-')}"
        spark.conf.set("helixframe.shared.dir", there)
    return there.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(name: str, columns: list[str]) -> str:
    """The name, with underscores added until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def removed(df: DataFrame) -> None:
    """Delete a table that written() made and nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: A key is hot if it has more than this share of a table's rows; there are fewer such keys than its inverse.
HOT_SHARE = 1 / 1024
#: Ways that a hot key's rows are dealt where its partner is too large to broadcast.
HOT_SALTS = 64


def hot_keys(rows: DataFrame, key: str) -> list[int]:
    """The values of a whole-number column that hold more than HOT_SHARE of the rows: fewer than 1 / HOT_SHARE of them, counted before the shuffle."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.agg(F.count(F.lit(1)).alias("_n")).first()[0]
    return [r[0] for r in counts.where(F.col("_n") > max(64, total * HOT_SHARE)).select(key).collect()]


def _key_table(spark: SparkSession, key: str, values: list[int]) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(v,) for v in values], f"{key} long"))


def joined_by_key(rows: DataFrame, other: DataFrame, key: str, how: str = "inner", hot: list[int] | None = None) -> DataFrame:
    """rows with the columns of other, which has one small row per key. Hot keys' rows of other are broadcast (fewer than
    1 / HOT_SHARE), so that no task gets all rows of a hot key; all else is shuffled. rows should be a written table."""
    hot = hot_keys(rows, key) if hot is None else hot
    if not hot:
        return rows.join(other, key, how)
    table = _key_table(rows.sparkSession, key, hot)
    some = rows.join(table, key, "left_semi").join(F.broadcast(other.join(table, key, "left_semi")), key, how)
    return some.unionByName(rows.join(table, key, "left_anti").join(other, key, how))


def joined_by_salted_key(rows: DataFrame, other: DataFrame, key: str, by: str) -> DataFrame:
    """rows with the columns of other, which has one row, of any size, per key: a hot key's rows are dealt by the column `by` into
    HOT_SALTS parts and its row of other goes to each of them. rows should be a written table."""
    hot = hot_keys(rows, key)
    if not hot:
        return rows.join(other, key)
    table = _key_table(rows.sparkSession, key, hot).withColumn("_hot", F.lit(True))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(by), F.lit(HOT_SALTS))).otherwise(F.lit(0)).cast("int")
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(table, key, "left").withColumn("_salt", salt).drop("_hot")
    right = other.join(table, key, "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return left.join(right, [key, "_salt"]).drop("_salt")


def crc_remainder(doc_id: str, modulus: int):
    """crc32 of the id as text, modulo the given number."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def labelled_sample(labels: DataFrame, label: str, most: int, where=None) -> DataFrame:
    """(doc_id, label) of at most so many labelled rows, those of smallest id hash; one row per id.

    A doc_id with several labels counts by the largest. This is the bounded sample
    that a classifier is fitted on; at 16 bytes a row its broadcast is bounded too.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if where is not None:
        rows = rows.where(where)
    rows = rows.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias(label))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
