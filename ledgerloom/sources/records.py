"""CSV files whose values may hold line breaks, read by many tasks; what is no record is kept and told apart.

A physical line with an odd number of quotes opens or closes a value that goes on over line breaks. Files are read as lines by splits; a
first pass keeps of each split only where such lines are, a prefix sum over the splits of a file tells which of them open and which
close, and so which lines form one record. What it finds is written to the shared scratch folder, so where that is little it is broadcast
and only the lines of such records are shuffled; all others are records as they stand.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lines that are matched with the stretches of one bucket; physical lines of a record at most (a stray quote would swallow a file).
BUCKET, LONGEST = 4096, 10_000


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``; a local folder only where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/ledgerloom-{uuid.uuid4().hex}"


def _kept(df: DataFrame) -> DataFrame:
    """``df`` written to scratch and read back, so that it is made once and its size is known to the plans that read it."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Encodings that ``decode`` takes in any session.
PLAIN = ("iso-8859-1", "us-ascii", "utf-8")


def _decoded(data: Column, encoding: str) -> Column:
    """The text of ``data``, whatever the session's settings. Other encodings than ``PLAIN`` must have a byte a character; a byte that is none there becomes U+FFFD."""
    name = encoding.lower()
    if name in PLAIN:
        return F.decode(data, name)
    if not name.startswith(("windows-125", "iso-8859-")):
        raise ValueError(f"not an encoding of a byte a character: {encoding}")
    other = {chr(i): bytes([i]).decode(name, "replace") for i in range(256)}
    differ = {a: b for a, b in other.items() if a != b}
    return F.translate(F.decode(data, "iso-8859-1"), "".join(differ), "".join(differ.values()))


def _lines(spark: SparkSession, paths: str | list[str], encoding: str, pattern: str) -> DataFrame:
    """(file, block, pos, text, odd) of every physical line; ``pos`` ascends in a split, ``odd``: whether its quotes are."""
    read = spark.read.options(lineSep="\n", pathGlobFilter=pattern, recursiveFileLookup=True).text(paths)
    # a quote is the same byte in every encoding that ``_decoded`` takes, and no part of another character
    odd = (F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"')))) % 2 == 1
    text = _decoded(F.col("value").cast("binary"), encoding).alias("text")
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), text, odd.alias("odd"))


def _stretches(lines: DataFrame, header: bool, longest: int) -> DataFrame:
    """(bucket, low, high, record, nr, kind): the lines of each record that has more than one, cut at splits and buckets. kind: ``joined``,
    ``broken`` (never closed, or over ``longest`` lines) or ``header``."""
    # at most a split's lines meet in a group, and they come from one task
    blocks = lines.groupBy("file", "block").agg(F.min("pos").alias("low"), F.max("pos").alias("high"), F.sort_array(F.collect_list(F.when(F.col("odd"), F.col("pos")))).alias("odd"))
    blocks = _kept(blocks)
    of_file = Window.partitionBy("file").orderBy("block")
    before = F.coalesce(F.sum(F.size("odd")).over(of_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("*", before.alias("before"), F.row_number().over(of_file).alias("nr"), F.count("*").over(Window.partitionBy("file")).alias("last"))
    events = blocks.select("file", "nr", "last", "before", F.posexplode("odd").alias("i", "pos")).withColumn("seq", F.col("before") + F.col("i"))
    end = lambda f: f(F.struct("seq", "nr", "pos"))
    pairs = events.groupBy("file", F.floor(F.col("seq") / 2).alias("pair")).agg(end(F.min).alias("o"), end(F.max).alias("c"), F.max("last").alias("last"), F.count("*").alias("n"))
    closed = F.col("n") == 2
    upto = F.when(closed, F.col("c.nr")).otherwise(F.col("last"))
    spans = pairs.select("file", "o", "c", closed.alias("closed"), F.explode(F.sequence("o.nr", upto)).alias("nr")).join(blocks.select("file", "nr", "low", "high"), ["file", "nr"])
    low = F.when(F.col("nr") == F.col("o.nr"), F.col("o.pos")).otherwise(F.col("low"))
    high = F.when(F.col("closed") & (F.col("nr") == F.col("c.nr")), F.col("c.pos")).otherwise(F.col("high"))
    spans = spans.select("file", "nr", F.col("o.pos").alias("record"), "closed", low.alias("low"), high.alias("high"))
    size = F.sum(F.col("high") - F.col("low") + 1).over(Window.partitionBy("record"))
    spans = spans.withColumn("kind", F.when(F.col("closed") & (size <= longest), "joined").otherwise("broken"))
    if header:
        first = blocks.where("block = 0").select("file", "low")
        spans = spans.join(first.select("file", F.col("low").alias("first")), "file", "left")
        spans = spans.withColumn("kind", F.when(F.col("record").eqNullSafe(F.col("first")), "header").otherwise(F.col("kind"))).drop("first")
        alone = first.join(spans.select(F.col("record").alias("low")), "low", "left_anti")
        spans = spans.unionByName(alone.select("file", F.lit(1).alias("nr"), F.col("low").alias("record"), F.lit(True).alias("closed"), "low", F.col("low").alias("high"), F.lit("header").alias("kind")))
    bucket = F.explode(F.sequence(F.floor(F.col("low") / BUCKET), F.floor(F.col("high") / BUCKET)))
    return spans.select(bucket.alias("bucket"), "low", "high", "record", "nr", "kind")


def csv_records(spark: SparkSession, paths: str | list[str], encoding: str, pattern: str = "*", header: bool = False, longest: int = LONGEST) -> DataFrame:
    """(file, value, closed): each record's text, line breaks in values included. Blank lines are left out, and with ``header`` each file's
    first record. ``closed`` is false for the single lines of a stretch that a quote opens and none closes, or only after
    ``longest`` lines. Files are read twice by as many tasks as they have splits, the first time at once, and again where a record has more than one line."""
    lines = _lines(spark, paths, encoding, pattern)
    s = _kept(_stretches(lines, header, longest))
    placed = lines.withColumn("bucket", F.floor(F.col("pos") / BUCKET)).join(s.withColumnRenamed("bucket", "at"), (F.col("bucket") == F.col("at")) & F.col("pos").between(F.col("low"), F.col("high")), "left")
    bare = lambda c: F.when(F.endswith(c, F.lit("\r")), F.left(c, F.length(c) - 1)).otherwise(c)
    whole = placed.where("kind IS NULL OR kind = 'broken'").select("file", bare(F.col("text")).alias("value"), F.col("kind").isNull().alias("closed")).where("trim(value) <> ''")
    if s.where("kind = 'joined'").isEmpty():
        return whole
    of_record = F.array_sort(F.collect_list(F.struct("nr", "pos", "text")))  # at most ``longest`` lines
    joined = placed.where("kind = 'joined'").groupBy("file", "record").agg(of_record.alias("l"))
    joined = joined.select("file", bare(F.array_join("l.text", "\n")).alias("value"), F.lit(True).alias("closed"))
    return whole.unionByName(joined)


def parse_records(records: DataFrame, schema: T.StructType, sep: str, empty_is_null: bool = False) -> tuple[DataFrame, DataFrame]:
    """Of ``csv_records``: the rows of ``schema``, and (file, value, reason) of what is none: ``unclosed`` or ``columns`` (another number of them).

    The columns of ``schema`` are strings; empty values are null. Every record is in exactly one of both."""
    names, bad = schema.names, "__record"
    while bad in names:
        bad += "_"
    wide = ", ".join(f"`{c}` string" for c in [*names, bad])
    options = dict(sep=sep, quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=bad, multiLine="true") | (dict(nullValue="", emptyValue="") if empty_is_null else {})
    found = F.transform(F.array(F.from_csv("value", wide, options)), lambda r: F.when(r[bad].isNull() & r.isNotNull(), F.array(*[r[c] for c in names])))[0]
    # a record whose values are all quoted, without quotes or line breaks in them, is cut between them; only others need the parser
    plain = r'[^"\x00\x1f\r\n]*+'
    simple = F.col("value").rlike(rf'^"{plain}"(?:{re.escape(sep)}"{plain}"){{{len(names) - 1}}}\z')
    cut = F.split(F.replace(F.expr("substring(value, 2, length(value) - 2)"), F.lit(f'"{sep}"'), F.lit("\x1f")), "\x1f")
    # the filter names the test of the form again and not the values, which would be made twice
    is_row = F.col("closed") & (simple | found.isNotNull())
    values = records.where(is_row).select(F.when(simple, cut).otherwise(found).alias("__values"))
    good = values.select(*[F.nullif(F.col("__values")[i], F.lit("")).alias(c) for i, c in enumerate(names)])
    reason = F.when(F.col("closed"), "columns").otherwise("unclosed")
    return good, records.where(~is_row).select("file", "value", reason.alias("reason"))


def count_rejected(rejected: DataFrame) -> DataFrame:
    """(file, reason, n): file names without their folders."""
    return rejected.groupBy(F.element_at(F.split("file", "/"), -1).alias("file"), "reason").agg(F.count("*").alias("n"))
