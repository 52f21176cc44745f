"""Sorted prefix shards, their byte index, and checks of both."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import KEY_LENGTH
from .relational import running_offsets

#: A text of Spark holds 2 GiB at most.
SHARD_BYTES = 1 << 30
#: Lines of a shard that ``verify_shards`` compares in one task.
SPAN = 1 << 16


def shard_index(df: DataFrame, prefix: str = "prefix", key: str = "key", value: str = "value", key_length: int = KEY_LENGTH, stretch: int = 6) -> DataFrame:
    """``running_offsets`` of the lines that ``write_shards`` writes. Raises for a key of another length."""
    size = F.length(key)
    checked = F.when(size == key_length, F.col(key)).otherwise(F.raise_error(F.concat(F.lit("key of wrong length: "), F.col(key))))
    return running_offsets(df.withColumn(key, checked), prefix, key, value, stretch)


def shard_counts(index: DataFrame, prefix: str = "prefix") -> DataFrame:
    """Records and bytes of each shard."""
    return index.groupBy(prefix).agg(F.count("*").alias("records"), F.sum("length").alias("bytes"))


def release_totals(counts: DataFrame) -> DataFrame:
    """One row: records and number of shards; shards whose count is null (an unreadable index) count as nothing."""
    return counts.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("total"), F.count(F.when(F.col("records").isNotNull(), 1)).alias("shard_count"))


def shard_artifact_summary(df: DataFrame, prefix: str = "prefix", key: str = "key", value: str = "value") -> DataFrame:
    """Bytes and MD5 of each shard's text. A shard is one piece of text in a task, so one of over ``SHARD_BYTES`` is an error, raised before
    any is put together; longer prefixes make smaller shards."""
    sizes = df.groupBy(F.col(prefix).alias("__prefix")).agg(F.sum(F.octet_length(value) + 1).alias("__bytes"))
    fits = F.when(F.col("__bytes") <= SHARD_BYTES, True).otherwise(F.raise_error(F.concat(F.lit("shard too large, use a longer prefix: "), F.col("__prefix"))))
    df = df.join(sizes.where(fits), F.col(prefix).eqNullSafe(F.col("__prefix")))
    lines = df.groupBy(prefix).agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(value).alias("v")))).alias("r"))
    text = F.concat(F.array_join(F.transform("r", lambda x: x["v"]), "\n"), F.lit("\n"))
    return lines.select(prefix, F.octet_length(text).cast("long").alias("bytes"), F.md5(text).alias("md5"))


def file_artifacts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, bytes, md5) of written files, in order of name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.md5("content").alias("md5")).orderBy("path")


def shard_pieces(spark: SparkSession, path: str, prefix: str = "prefix") -> DataFrame:
    """(prefix, piece, file, bytes, md5) of the files that ``write_shard_pieces`` wrote; pieces count from 0 in each shard."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    shard = F.url_decode(F.regexp_extract("path", f"/{prefix}=([^/]*)/[^/]*$", 1))
    placed = files.select(shard.alias(prefix), name.alias("file"), F.col("length").alias("bytes"), F.md5("content").alias("md5"))
    return placed.withColumn("piece", F.row_number().over(Window.partitionBy(prefix).orderBy("file")) - 1).select(prefix, "piece", "file", "bytes", "md5")


def shard_checksums(pieces: DataFrame, prefix: str = "prefix") -> DataFrame:
    """(prefix, pieces, bytes, checksum): the checksum is the MD5 of the list of the pieces' digests, each on a line, so no task holds a shard."""
    listed = F.array_sort(F.collect_list(F.struct("piece", "md5")))
    return pieces.groupBy(prefix).agg(F.count("*").alias("pieces"), F.sum("bytes").alias("bytes"), F.md5(F.concat(F.array_join(F.transform(listed, lambda x: x["md5"]), "\n"), F.lit("\n"))).alias("checksum"))


def file_lines(spark: SparkSession, path: str, prefix: str = "prefix", json_key: str = "$.cnpj") -> DataFrame:
    """(prefix, key, offset, length) of every line of shard files as they are on disk, offsets running over a shard's files in order of their
    names. The key is the one that the line's document names. Lines are shuffled by file, without their text."""
    read = spark.read.schema(f"value string, {prefix} string").option("lineSep", "\n").text(path)
    lines = read.select(
        prefix, F.col("_metadata.file_name").alias("file"), F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"), F.get_json_object("value", json_key).alias("key"), (F.octet_length("value") + 1).cast("long").alias("length")
    )
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    here = F.coalesce(F.sum("length").over(before(Window.partitionBy(prefix, "file").orderBy("at"))), F.lit(0))
    starts = lines.groupBy(prefix, "file").agg(F.sum("length").alias("bytes"))
    starts = starts.select(F.col(prefix).alias("__p"), F.col("file").alias("__f"), F.coalesce(F.sum("bytes").over(before(Window.partitionBy(prefix).orderBy("file"))), F.lit(0)).alias("start"))
    placed = lines.withColumn("here", here).join(starts, F.col(prefix).eqNullSafe(F.col("__p")) & (F.col("file") == F.col("__f")))
    return placed.select(prefix, "key", (F.col("start") + F.col("here")).alias("offset"), "length")


def verify_files(index: DataFrame, lines: DataFrame, prefix: str = "prefix", key: str = "key") -> DataFrame:
    """(fault, prefix, key, offset) of every difference between an index and the lines on disk (``file_lines``): no_line (nothing begins at
    the offset), unindexed (a line that no entry points to), wrong_length and wrong_key (another document, or none, at the offset)."""
    a = index.select(F.col(prefix).alias("p"), F.col("offset").alias("o"), F.col(key).alias("k"), F.col("length").alias("n"))
    b = lines.select(F.col(prefix).alias("q"), F.col("offset").alias("at"), F.col("key").alias("named"), F.col("length").alias("size"))
    both = a.join(b, F.col("p").eqNullSafe(F.col("q")) & (F.col("o") == F.col("at")), "full")
    fault = F.when(F.col("at").isNull(), F.array(F.lit("no_line"))).when(F.col("o").isNull(), F.array(F.lit("unindexed")))
    fault = fault.otherwise(F.array_compact(F.array(F.when(F.col("n") != F.col("size"), "wrong_length"), F.when(~F.col("k").eqNullSafe(F.col("named")), "wrong_key"))))
    return both.select(F.explode(fault).alias("fault"), F.coalesce("p", "q").alias(prefix), F.coalesce("k", "named").alias(key), F.coalesce("o", "at").alias("offset"))


def verify_shards(index: DataFrame, documents: DataFrame | None = None, prefix: str = "prefix", key: str = "key", counts: DataFrame | None = None, json_key: str = "$.cnpj", span: int = SPAN) -> DataFrame:
    """(fault, prefix, key) of everything that a reader of the index would trip over; no rows if all is well.

    unsorted, duplicate, gap (an offset that doesn't follow the line before), wrong_count (against ``counts``: prefix,
    records), wrong_key (the document of ``documents`` (prefix, key, value) names another key) and missing_document.
    Each task compares the lines of up to ``span`` ordinals of a shard; the last line of a span is handed on to the next.
    """
    at = F.struct(F.col(prefix).alias("p"), F.floor(F.col("ordinal") / span).alias("s")).alias("__at")
    lines = index.select(at, key, "ordinal", "offset", "length").repartition("__at")
    line = F.struct(F.col(key).alias("key"), (F.col("offset") + F.col("length")).alias("end"))
    tails = lines.groupBy("__at").agg(F.max_by(line, "ordinal").alias("__tail"))
    tails = tails.select("__at", F.lag("__tail").over(Window.partitionBy("__at.p").orderBy("__at.s")).alias("__tail"))
    before = lines.select("*", F.lag(line).over(Window.partitionBy("__at").orderBy("ordinal")).alias("__line")).join(tails, "__at")
    before = before.withColumn("__line", F.coalesce("__line", "__tail"))
    seen = before.select(F.col("__at.p").alias(prefix), key, "offset", F.col("__line.key").alias("__last"), F.coalesce("__line.end", F.lit(0)).alias("__end"))
    faults = F.array(
        F.when(F.col("__last") > F.col(key), "unsorted"),
        F.when(F.col("__last") == F.col(key), "duplicate"),
        F.when(F.col("__end") != F.col("offset"), "gap"),
    )
    out = seen.select(F.explode(F.array_compact(faults)).alias("fault"), prefix, key)
    if counts is not None:
        have = index.groupBy(prefix).agg(F.count("*").alias("__have"))
        wrong = counts.join(have, prefix, "full").where(~F.coalesce("records", F.lit(0)).eqNullSafe(F.coalesce("__have", F.lit(0)))).select(F.lit("wrong_count").alias("fault"), prefix, F.lit(None).cast("string").alias(key))
        out = out.unionByName(wrong)
    if documents is not None:
        j = index.select(prefix, key).join(documents.select(prefix, key, F.get_json_object("value", json_key).alias("__named"), F.lit(True).alias("__there")), [prefix, key], "left")
        fault = F.when(F.col("__there").isNull(), "missing_document").when(~F.col("__named").eqNullSafe(F.col(key)), "wrong_key")
        out = out.unionByName(j.select(fault.alias("fault"), prefix, key).where("fault IS NOT NULL"))
    return out


def release_plan(wanted: DataFrame, existing: DataFrame, prefix: str = "prefix", files: tuple[str, ...] = ("data", "index")) -> DataFrame:
    """(prefix, action): ``reuse`` where every file of the shard exists, else ``generate``. existing: (prefix, file)."""
    whole = existing.where(F.col("file").isin(*files)).groupBy(prefix).agg(F.countDistinct("file").alias("__files")).where(F.col("__files") == len(files))
    j = wanted.select(prefix).distinct().join(whole, prefix, "left")
    return j.select(prefix, F.when(F.col("__files").isNotNull(), "reuse").otherwise("generate").alias("action"))


def upload_targets(prefixes: DataFrame, prefix: str = "prefix") -> DataFrame:
    """Distinct file names of the shards, in order."""
    names = F.array(F.concat(prefix, F.lit(".ndjson")), F.concat(prefix, F.lit(".index")))
    return prefixes.select(F.explode(names).alias("file")).distinct().orderBy("file")
