"""What several corpus operators share: scratch tables, dense numbering, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of code points that are neither a space nor one of U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
#: The same separators as bytes; ``bytes.split()`` without an argument splits at exactly these.
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names.

    Only where the setting is absent and the master is local (tests, one machine) a local folder is made and set; on a cluster other
    machines would miss what is written there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/ledgerloom-{uuid.uuid4().hex}"


def written(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends there, so a lost
    executor costs no more than the stage at hand, and later joins see plain scans."""
    path = scratch_dir(df.sparkSession)
    df.write.partitionBy(*partition_by).parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.scratch_path = path
    return back


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def dense_index(df: DataFrame, group: list[str], order: list[Column], name: str, part_name: str | None = None) -> DataFrame:
    """Number the rows of each group from 0 without gaps in the given order.

    The rows are range-partitioned by (group, order), so one group may span many tasks; a count of
    rows for each (partition, group) turns positions in a partition into positions in a group.
    Rows that tie in ``order`` get any distinct numbers. ``part_name`` adds the number of the range partition.
    """
    parts = shuffle_partitions(df.sparkSession)
    keys = [F.col(c).asc_nulls_first() for c in group]
    placed = df.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
    placed = written(placed.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    spans = placed.groupBy(*group, part.alias("__part")).agg(F.min("__at").alias("__low"), F.count("*").alias("__n"))
    # a row for each partition and group, not for each row of the data
    from pyspark.sql import Window

    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__low")).drop("__low", "__n")
    left = placed.withColumn("__part", part)
    spans = spans.select("__part", "__base", *[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)])
    same = left["__part"] == spans["__part"]
    for i, c in enumerate(group):
        same = same & left[c].eqNullSafe(spans[f"__g{i}"])
    return left.join(spans, same).select(*df.columns, (F.col("__at") + F.col("__base")).alias(name), *([left["__part"].alias(part_name)] if part_name else []))


def forget(df: DataFrame) -> None:
    """Delete a scratch table (what ``written`` returned) that no later plan reads."""
    path = getattr(df, "scratch_path", None)
    if path:
        context = df.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected components.

    ``nodes``: (node, least); ``edges``: (a, b), either direction, repeats allowed, between nodes.
    Returns (node, component), component being the smallest ``least`` that links reach. Nodes without
    an edge keep their own. Both inputs must be scratch tables (they are read more than once).

    Each round sends a node to the neighbour (or itself) of least hashed rank, then rewrites the edges
    between the targets; hashed ranks halve even a sorted chain, so rounds grow with the logarithm
    of the nodes. All state stays in tables: the driver sees one row count a round.
    """
    live = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    moves: list[DataFrame] = []
    turn = 0
    while not live.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("r"), c.alias("v"))
        both = live.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")
        best = both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("m"))
        move = written(best.select("a", F.least(F.col("m"), rank(F.col("a")))["v"].alias("to")))
        moves.append(move)
        first = written(live.join(move, "a").select(F.col("to").alias("x"), "b"))
        second = first.join(move.withColumnRenamed("a", "b"), "b").where("x <> to")
        after = written(second.select(F.least("x", "to").alias("a"), F.greatest("x", "to").alias("b")).distinct())
        forget(live)
        forget(first)
        live, turn = after, turn + 1
    if not moves:
        return nodes.select("node", F.col("least").alias("component"))
    root = moves[0].select(F.col("a").alias("node"), F.col("to").alias("root"))
    for m in moves[1:]:
        step = m.select(F.col("a").alias("root"), "to")
        root = written(root.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")))
    placed = written(nodes.join(root, "node", "left").select("node", "least", "root"))
    floor = written(placed.where("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("component")))
    return placed.join(floor, "root", "left").select("node", F.coalesce("component", "least").alias("component"))


def own_prefix(df: DataFrame) -> str:
    """Underscores that no column of ``df`` begins with, for names of our own beside its columns."""
    mark = "__"
    while any(c.startswith(mark) for c in df.columns):
        mark += "_"
    return mark


def rows_of(docs: DataFrame, keys: DataFrame, n: str = "__n") -> DataFrame:
    """The rows of ``docs`` whose doc_id and text ``keys`` (doc_id, text_hash, ``n``, more) names, one row for each key.

    ``n``: how many rows of ``docs`` have the key. Only rows that share theirs are grouped to keep one of them.
    Null keys match null. Returns the columns of ``docs`` and what else ``keys`` holds, whose names ``docs`` must not have.
    """
    mark = own_prefix(docs)
    id_, hash_, text = (mark + x for x in ("id", "hash", "text"))
    k = keys.withColumnRenamed("doc_id", id_).withColumnRenamed("text_hash", hash_)
    d = docs.withColumn(text, F.xxhash64("text"))
    found = d.join(k, d["doc_id"].eqNullSafe(k[id_]) & (d[text] == k[hash_])).drop(id_, hash_)
    once = found.where(F.col(n) == 1).unionByName(found.where(F.col(n) > 1).dropDuplicates(["doc_id", text]))
    return once.drop(text, n)
