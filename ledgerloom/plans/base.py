"""How registered queries are declared, and the tables in the roles of a registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.records import scratch as scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name, with the SQL that gives the same rows."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The leading zeros of a padded order key say nothing, so its last digits but two serve as prefix.
PREFIX_AT, PREFIX_LENGTH = 11, 2


def padded(c: str) -> Column:
    return F.lpad(F.col(c).cast("string"), 14, "0")


def order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with ``key`` and ``pfx``."""
    o = table(spark, sf_dir, "orders").withColumn("key", padded("o_orderkey"))
    return o.withColumn("pfx", F.substring("key", PREFIX_AT, PREFIX_LENGTH))


KEY_SQL = "lpad(CAST(o_orderkey AS VARCHAR), 14, '0')"
ORDERS_SQL = f"(SELECT *, {KEY_SQL} AS key, substring({KEY_SQL}, {PREFIX_AT}, {PREFIX_LENGTH}) AS pfx FROM orders)"


def flat_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with customer, nation and region: the flat table of the documented analytics. Spark broadcasts the code tables."""
    o, c, n, r = order_keys(spark, sf_dir), *(table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return j.join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")


FLAT_SQL = f"""(SELECT * FROM {ORDERS_SQL} o LEFT JOIN customer ON o_custkey = c_custkey
 LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""


def hash_states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A previous and a current hash state: of ten keys one came, one went and one changed."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    o = order_keys(spark, sf_dir).select(F.col("key").alias("cnpj"), F.md5(F.concat("key", "o_orderstatus", day)).alias("h"), (F.col("o_orderkey") % 10).alias("d"))
    previous = o.where("d <> 2").select("cnpj", F.when(F.col("d") == 1, F.md5("h")).otherwise(F.col("h")).alias("content_hash"))
    return previous, o.where("d <> 0").select("cnpj", F.col("h").alias("content_hash"))


STATES_SQL = f"""o AS (SELECT key AS cnpj, md5(key || o_orderstatus || strftime(o_orderdate, '%Y-%m-%d')) AS h, o_orderkey % 10 AS d FROM {ORDERS_SQL}),
prev AS (SELECT cnpj, CASE WHEN d = 1 THEN md5(h) ELSE h END AS content_hash FROM o WHERE d <> 2),
curr AS (SELECT cnpj, h AS content_hash FROM o WHERE d <> 0)"""
