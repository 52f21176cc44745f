"""Comparing two hash states by trees of digests, so that only what differs is read.

A digest is a number of rows and two order-free sums of row hashes. A state is written partitioned by the first characters of its keys, with the
digests of (prefix, sub-prefix) beside it; those of prefixes and of the whole are their sums. Roots are compared first, then prefixes,
then sub-prefixes; only the partitions of prefixes that differ are read, and only their rows under a sub-prefix that differs are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import key_prefix
from .relational import hash_diff

#: Characters of a key that make its prefix, and those after them that make its sub-prefix.
PREFIX, SUB = 3, 2
STATE, LEAVES = "cnpj string, content_hash string, prefix string", "prefix string, sub string, n long, total decimal(38,0), mixed long"
DIGEST = ("n", "total", "mixed")


def _keyed(state: DataFrame, key: str, content: str, start: int) -> DataFrame:
    # null keys and those too short for a prefix have one of their own, which is no valid name otherwise
    name = lambda length, at: F.coalesce(F.nullif(key_prefix(key, length, at), F.lit("")), F.lit("-"))
    return state.select(F.col(key).alias("cnpj"), F.col(content).alias("content_hash"), name(PREFIX, start).alias("prefix"), name(SUB, start + PREFIX).alias("sub"))


def digest_leaves(state: DataFrame, key: str = "cnpj", content: str = "content_hash", start: int = 1) -> DataFrame:
    """(prefix, sub, n, total, mixed) of a state; repeated rows count as often as they occur."""
    row = lambda seed: F.xxhash64("cnpj", F.col("content_hash").isNull(), "content_hash", F.lit(seed))
    return _keyed(state, key, content, start).groupBy("prefix", "sub").agg(F.count("*").alias("n"), F.sum(row(1).cast("decimal(38,0)")).cast("decimal(38,0)").alias("total"), F.bit_xor(row(2)).alias("mixed"))


def _sums(leaves: DataFrame, *by: str) -> DataFrame:
    return leaves.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"), F.bit_xor("mixed").alias("mixed"))


def differing(old: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """The keys ``by`` whose digests differ, or that only one side has."""
    a, b = (x.select(*by, F.struct(*DIGEST).alias(side)) for x, side in ((old, "a"), (new, "b")))
    return a.join(b, by, "full").where(~F.col("a").eqNullSafe(F.col("b"))).select(*by)


def write_tree(state: DataFrame, path: str, key: str = "cnpj", content: str = "content_hash", start: int = 1) -> str:
    """Write a state and its digests as new folders below ``path``."""
    keyed = _keyed(state, key, content, start).drop("sub")
    keyed.hint("rebalance", F.col("prefix")).sortWithinPartitions("prefix", "cnpj").write.mode("errorifexists").partitionBy("prefix").option("compression", "zstd").parquet(f"{path}/rows")
    written = state.sparkSession.read.schema(STATE).parquet(f"{path}/rows")
    digest_leaves(written, start=start).write.mode("errorifexists").option("compression", "zstd").parquet(f"{path}/digests")
    return path


def tree_diff(spark: SparkSession, old: str, new: str, start: int = 1) -> DataFrame:
    """What ``hash_diff`` gives for two states that ``write_tree`` wrote.

    The digests, a row a sub-prefix, are all that is read of what is equal: equal roots end the search, and the partitions of the rows are pruned to the
    prefixes that differ when the query runs (a broadcast of at most as many names as there are prefixes).
    """
    leaves = [spark.read.schema(LEAVES).parquet(f"{p}/digests") for p in (old, new)]
    rows = [spark.read.schema(STATE).parquet(f"{p}/rows") for p in (old, new)]
    roots = [x.agg(*[f(c).alias(c) for f, c in ((F.sum, "n"), (F.sum, "total"), (F.bit_xor, "mixed"))]).first() for x in leaves]  # one row each
    if roots[0] == roots[1]:
        return hash_diff(rows[0].limit(0), rows[1].limit(0))
    prefixes = differing(*[_sums(x, "prefix") for x in leaves], ["prefix"])
    changed = differing(*[x.join(F.broadcast(prefixes), "prefix", "left_semi") for x in leaves], ["prefix", "sub"])
    sub = F.coalesce(F.nullif(key_prefix("cnpj", SUB, start + PREFIX), F.lit("")), F.lit("-"))
    near = [x.join(F.broadcast(prefixes), "prefix", "left_semi").withColumn("sub", sub).join(changed, ["prefix", "sub"], "left_semi") for x in rows]
    return hash_diff(*near)
