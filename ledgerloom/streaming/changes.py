"""Incremental change feed of a module: files arrive, changes leave."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.relational import hash_diff
from ..sources.readers import empty_like, exists

STATE = "cnpj string, content_hash string"


def change_feed(previous: DataFrame, current: DataFrame, batch_id: int, removals: bool = True) -> DataFrame:
    """(cnpj, change, content_hash, batch_id): the batch form. Without ``removals`` absent keys stay as they were."""
    diff = hash_diff(previous, current)
    if not removals:
        diff = diff.where("change <> 'removed'")
    return diff.select("cnpj", "change", F.coalesce("current_hash", "previous_hash").alias("content_hash"), F.lit(batch_id).cast("long").alias("batch_id"))


def state_before(spark: SparkSession, state: str, batch_id: int, full_every: int = 1) -> DataFrame:
    """(cnpj, content_hash, batch): what the batches before ``batch_id`` wrote since the last whole state; of a key the row of the last batch holds."""
    if not batch_id:
        return empty_like(spark, STATE + ", batch long")
    last = batch_id - 1
    folders = [f"{state}/batch={i}" for i in range(last - last % full_every, batch_id)]
    for f in folders:
        if not exists(spark, f):
            raise ValueError(f"the state before batch {batch_id} is gone: {f}")
    return spark.read.schema(STATE + ", batch long").option("basePath", state).parquet(*folders)


def _newest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("cnpj").agg(F.max_by("content_hash", "batch").alias("content_hash"))


def stream_module_changes(
    spark: SparkSession, source: str, schema: T.StructType | str, reduce: Callable[[DataFrame], DataFrame], state: str, feed: str, checkpoint: str, file_format: str = "parquet", options: dict | None = None, full_every: int = 1
):
    """Process the files that are new below ``source`` and stop; returns the finished query.

    ``reduce`` turns a batch of raw rows into one row a key (cnpj, content_hash). Every ``full_every``-th batch writes the
    whole state to a folder of its own, the others only the rows that they changed, and shuffle only state rows of their own keys; readers of
    the state use ``state_before``. With 1 each folder is a whole state. The number must stay the same between runs. The feed has one folder a batch too. A repeated batch overwrites its folders, so a restart gives the same result.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        known = state_before(spark, state, batch_id, full_every)
        new = reduce(batch).select("cnpj", "content_hash").persist()
        try:
            old = _newest(known.join(new.select("cnpj"), "cnpj", "left_semi"))
            feed_path = f"{feed}/batch={batch_id}"
            change_feed(old, new, batch_id, removals=False).write.mode("overwrite").parquet(feed_path)
            changed = new.join(spark.read.schema(STATE).parquet(feed_path).select("cnpj"), "cnpj", "left_semi")
            if batch_id % full_every == 0:
                changed = _newest(known.unionByName(changed.withColumn("batch", F.lit(batch_id).cast("long"))))
            changed.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        finally:
            new.unpersist()

    read = spark.readStream.format(file_format).schema(schema).options(**(options or {})).load(source)
    query = read.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
