"""Text formats of genomics as DataFrames, and back.

Everything is read with Spark's text source, in parallel and split by byte ranges; nothing needs a file to fit
in one task, save that one FASTA record is one row. Paths may be folders or globs, and gz is transparent.
An empty file gives no rows; lines without the needed columns have nulls in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Order of the keys of a merged VCF header (fixed values); keys not listed are left out.
HEADER_ORDER = ("##fileformat", "##contig", "##ALT", "##INFO", "##FILTER", "##FORMAT")
VCF_COLUMNS = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format", "sample")
PAF_COLUMNS = ("q_name", "q_len", "q_start", "q_end", "strand", "t_name", "t_len", "t_start", "t_end", "n_match", "n_block", "mapq")
SAM_COLUMNS = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")
NUMBERS = {"pos", "flag", "mapq", "pnext", "tlen", "q_len", "q_start", "q_end", "t_len", "t_start", "t_end", "n_match", "n_block", "start", "end", "length"}


def _columns(line: Column, names: tuple[str, ...], sep: str = "\t") -> list[Column]:
    """The line's columns by name; numbers are longs, null where they are none."""
    parts = F.split(line, sep)
    at = lambda i: F.try_element_at(parts, F.lit(i + 1))
    return [(at(i).try_cast("long") if n in NUMBERS else at(i)).alias(n) for i, n in enumerate(names)]


def _tag(line: Column, name: str, kind: str) -> Column:
    found = F.regexp_extract(line, rf"\t{name}:{kind}:([^\t]*)", 1)
    return F.when(found != "", found)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no from 0, value). Lines are counted per byte range of a file; the ranges' counts are summed."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_range"), F.monotonically_increasing_id().alias("_id"))
    ranges = lines.groupBy("file", "_range").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("file").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select("file", "_range", (before - F.col("_first")).alias("_shift"))
    return lines.join(ranges, ["file", "_range"]).select("file", (F.col("_id") + F.col("_shift")).alias("line_no"), "value")


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """Records of the first sample; info also as a map (flags have null values)."""
    rows = spark.read.text(path).where("value <> '' and not startswith(value, '#')").select(*_columns(F.col("value"), VCF_COLUMNS))
    return rows.withColumn("info_map", F.str_to_map("info", F.lit(";"), F.lit("=")))


def read_vcf_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line, key, id) of the ## lines."""
    rows = numbered_lines(spark, path).where("startswith(value, '##')")
    named = F.regexp_extract("value", r"<ID=([^,>]*)", 1)
    return rows.select("file", "line_no", F.col("value").alias("line"), F.regexp_extract("value", "^([^=]*)", 1).alias("key"), F.when(named != "", named).alias("id"))


def merge_headers(headers: DataFrame, order: tuple[str, ...] = HEADER_ORDER) -> DataFrame:
    """(place, line): the first line of each key and id, in the forced order; contigs as in the file that has most, then the others.

    "First" goes by file name and line; the file with most contigs is the first of those that tie.
    """
    ranks = F.coalesce(*[F.when(F.col("key") == k, i) for i, k in enumerate(order)])
    rows = headers.withColumn("_rank", ranks).where("_rank is not null")
    most = rows.where("key = '##contig'").groupBy("file").agg(F.count(F.lit(1)).alias("_contigs"))
    rows = rows.join(most, "file", "left").withColumn("_order", F.when(F.col("key") == "##contig", -F.col("_contigs")).otherwise(0))
    name = F.when(F.col("key") == "##contig", F.col("line")).otherwise(F.coalesce("id", F.lit("")))
    first = W.partitionBy("key", name).orderBy("_order", "file", "line_no")
    kept = rows.withColumn("_nth", F.row_number().over(first)).where("_nth = 1")
    # Header lines only: their number follows the number of contigs and keys, not the records.
    return kept.select((F.row_number().over(W.orderBy("_rank", "_order", "file", "line_no")) - 1).cast("long").alias("place"), "line")


def contig_header(contigs: DataFrame, only: str | None = None) -> DataFrame:
    """(chrom, line) of the header lines of contigs (chrom, length); only: a pattern that whole names must match."""
    rows = contigs.where(F.col("chrom").rlike(f"^(?:{only})$")) if only else contigs
    return rows.select("chrom", F.format_string("##contig=<ID=%s,length=%d>", "chrom", "length").alias("line"))


def write_vcf(records: DataFrame, header: list[str], path: str) -> None:
    """A folder of part files in the order of chrom and pos; the header stands in a file that sorts first.

    Records are range-partitioned, so that no task holds all of them.
    """
    spark = records.sparkSession
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in VCF_COLUMNS]
    records.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos", "id").select(F.concat_ws("\t", *fields).alias("value")).write.mode("overwrite").text(f"{path}/records")
    names = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "SAMPLE"])
    spark.createDataFrame([("\n".join([*header, names]),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/header")


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text; pos is 1-based as in the file. is_reverse and the SA tag are columns of their own."""
    rows = spark.read.text(path).where("value <> '' and not value rlike '^@[A-Z][A-Z]\\t'")
    out = rows.select(*_columns(F.col("value"), SAM_COLUMNS), _tag(F.col("value"), "SA", "Z").alias("sa"))
    return out.withColumn("is_reverse", F.col("flag").bitwiseAND(16) != 0)


def read_paf(spark: SparkSession, path: str) -> DataFrame:
    tags = [_tag(F.col("value"), n, k).alias(a) for n, k, a in (("tp", "A", "kind"), ("cg", "Z", "cigar"))]
    edits = _tag(F.col("value"), "NM", "i").try_cast("long").alias("edits")
    return spark.read.text(path).where("value <> ''").select(*_columns(F.col("value"), PAF_COLUMNS), *tags, edits)


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, start, end, name); comment, track and browser lines are left out."""
    rows = spark.read.text(path).where("value <> '' and not value rlike '^(#|track|browser)'")
    return rows.select(*_columns(F.col("value"), ("chrom", "start", "end", "name"), "\\s+"))


def write_bed(blocks: DataFrame, path: str) -> None:
    blocks.repartitionByRange("chrom", "start").sortWithinPartitions("chrom", "start", "end").select(F.concat_ws("\t", "chrom", "start", "end").alias("value")).write.mode("overwrite").text(path)


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where("value <> ''").select(*_columns(F.col("value"), ("chrom", "length")))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(name, seq): the name ends at the first white space."""
    rows = spark.read.option("lineSep", ">").text(path).where("trim(both '\\r\\n' from value) <> ''")
    return rows.select(F.regexp_extract("value", r"^(\S*)", 1).alias("name"), F.regexp_replace(F.regexp_replace("value", r"^[^\n]*(\n|$)", ""), r"\s+", "").alias("seq"))


def write_fasta(seqs: DataFrame, path: str) -> None:
    seqs.select(F.concat(F.lit(">"), "name", F.lit("\n"), "seq").alias("value")).write.mode("overwrite").text(path)


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """(file, read_no, name, seq, qual) of records of four lines each."""
    lines = numbered_lines(spark, path)
    part = lambda i: F.max(F.when(F.col("line_no") % 4 == i, F.col("value")))
    rows = lines.groupBy("file", F.floor(F.col("line_no") / 4).alias("read_no")).agg(part(0).alias("head"), part(1).alias("seq"), part(3).alias("qual"))
    return rows.select("file", "read_no", F.regexp_extract("head", r"^@(\S*)", 1).alias("name"), "seq", "qual").where("qual is not null")


def write_fastq(reads: DataFrame, path: str, by: str | None = None) -> None:
    """Records with quality ! throughout where there is none; one folder per value of the column by."""
    qual = F.coalesce("qual", F.repeat(F.lit("!"), F.length("seq"))) if "qual" in reads.columns else F.repeat(F.lit("!"), F.length("seq"))
    rows = reads.select(*([by] if by else []), F.concat(F.lit("@"), "name", F.lit("\n"), "seq", F.lit("\n+\n"), qual).alias("value"))
    out = rows.write.mode("overwrite")
    (out.partitionBy(by) if by else out).text(path)


def read_cov(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, chrom_length, start, end, depth), 1-based and closed, of blocks below `>name length` lines.

    The header is carried down within tiles of lines and from tile to tile.
    """
    tile = 100_000
    rows = numbered_lines(spark, path).where("value <> ''").withColumn("_tile", F.floor(F.col("line_no") / tile))
    rows = rows.withColumn("_head", F.when(F.col("value").startswith(">"), F.col("value")))
    rows = rows.withColumn("_local", F.last("_head", True).over(W.partitionBy("file", "_tile").orderBy("line_no")))
    tiles = rows.groupBy("file", "_tile").agg(F.max_by("_head", F.when(F.col("_head").isNotNull(), F.col("line_no"))).alias("_last"))
    tiles = tiles.select("file", "_tile", F.last("_last", True).over(W.partitionBy("file").orderBy("_tile").rowsBetween(W.unboundedPreceding, -1)).alias("_before"))
    rows = rows.where("_head is null").join(tiles, ["file", "_tile"])
    head, parts = F.split(F.coalesce("_local", "_before"), r"\s+"), F.split("value", r"\s+")
    number = lambda array, i: F.try_element_at(array, F.lit(i)).try_cast("long")
    return rows.select(F.substring(F.try_element_at(head, F.lit(1)), 2, 1 << 30).alias("chrom"), number(head, 2).alias("chrom_length"), *[number(parts, i + 1).alias(n) for i, n in enumerate(("start", "end", "depth"))])


def read_sigs(spark: SparkSession, path: str) -> DataFrame:
    """(svtype, chrom, pos, svlen, rest): a ragged table; columns past the fourth stay an array."""
    parts = F.split(F.trim("value"), r"\s+")
    get = lambda i: F.try_element_at(parts, F.lit(i))
    rows = spark.read.text(path).where("trim(value) <> ''")
    return rows.select(get(1).alias("svtype"), get(2).alias("chrom"), get(3).try_cast("double").cast("long").alias("pos"), get(4).try_cast("double").cast("long").alias("svlen"), F.slice(parts, 5, 1 << 30).alias("rest"))


def read_parameters(spark: SparkSession, path: str) -> DataFrame:
    """(name, value) of `name:value` lines; nan means a disabled threshold and is null."""
    text = F.regexp_replace("value", "^﻿", "")
    value = F.trim(F.regexp_extract(text, r":(.*)$", 1))
    number = F.when(F.lower(value) != "nan", value.try_cast("double"))
    return spark.read.text(path).where("value like '%:%'").select(F.trim(F.regexp_extract(text, r"^([^:]*)", 1)).alias("name"), number.alias("value"))


def read_parameter_table(spark: SparkSession, path: str) -> DataFrame:
    """A table of parameters as comma-separated values with a header, which may begin with a byte order mark; nan is null, a column without other texts than numbers is double."""
    rows = spark.read.csv(path, header=True, nanValue="nan", nullValue="nan", inferSchema=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    rows = rows.toDF(*[c.lstrip("\ufeff").strip() for c in rows.columns])
    return rows.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() in ("integer", "long", "double", "decimal") else F.col(f.name) for f in rows.schema.fields])


def read_gfa_sequences(spark: SparkSession, path: str) -> DataFrame:
    """(name, seq) of the S lines."""
    return spark.read.text(path).where("startswith(value, 'S\\t')").select(*_columns(F.col("value"), ("_s", "name", "seq"))).drop("_s")


def chunks(seqs: DataFrame, size: int = 1_000_000, overlap: int = 10_000) -> DataFrame:
    """(name, chunk from 1, offset, seq): windows of size + overlap letters of (name, seq), each size after the one before."""
    n = F.greatest(F.ceil(F.length("seq") / size), F.lit(1))
    rows = seqs.select("name", "seq", F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("chunk")).withColumn("offset", (F.col("chunk") - 1) * size)
    return rows.select("name", "chunk", "offset", F.substring(F.col("seq"), (F.col("offset") + 1).cast("int"), F.lit(size + overlap)).alias("seq"))


def unchunked(hits: DataFrame, size: int = 1_000_000) -> DataFrame:
    """Hits (name, chunk from 1, start, end) in the coordinates of the whole sequence."""
    offset = (F.col("chunk") - 1) * size
    return hits.withColumn("start", F.col("start") + offset).withColumn("end", F.col("end") + offset).drop("chunk")


def write_table(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """An intermediate table as Parquet, csv or tsv (with a header line)."""
    out = df.write.mode("overwrite")
    if kind == "parquet":
        out.parquet(path)
    else:
        out.option("header", True).option("escape", '"').option("sep", {"csv": ",", "tsv": "\t"}[kind]).csv(path)


def read_table(spark: SparkSession, path: str, kind: str, schema=None) -> DataFrame:
    if kind == "parquet":
        return spark.read.parquet(path)
    return spark.read.option("header", True).option("escape", '"').option("sep", {"csv": ",", "tsv": "\t"}[kind]).csv(path, schema=schema)
