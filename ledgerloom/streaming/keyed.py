"""The change feed with its state in Spark's state store: one value a key, so nothing is rewritten that didn't change.

Python sees the rows of a batch and the state of their keys alone. The state store must be RocksDB, as ``transformWithState`` needs it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGES = "cnpj string, change string, content_hash string"


class KeyedChanges(StatefulProcessor):
    """Compares each key's hash with the last one. A row without ``present`` is a tombstone: its key was removed.

    Of several rows of a key in a batch the one of the highest ``position`` counts, ties by the greatest hash. A null hash is a value of its own."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "content_hash string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timer: object) -> Iterator[pd.DataFrame]:
        best = None
        for batch in rows:
            for position, present, hash_ in zip(batch["position"], batch["present"], batch["content_hash"]):
                hash_ = None if pd.isna(hash_) else hash_
                mine = (position, present, hash_ is not None, hash_ or "")
                best = mine if best is None or mine > best else best
        _, present, known, text = best
        new, old = (text if known else None), self.last.get()[0] if self.last.exists() else None
        change = None
        if not present:
            change, new = ("removed", old) if self.last.exists() else (None, None)
            self.last.clear()
        elif not self.last.exists():
            change = "added"
            self.last.update((new,))
        elif new != old:
            change = "changed"
            self.last.update((new,))
        if change:
            yield pd.DataFrame({"cnpj": [key[0]], "change": [change], "content_hash": [new]})

    def close(self) -> None:
        pass


def keyed_changes(rows: DataFrame) -> DataFrame:
    """(cnpj, change, content_hash) of a stream of (cnpj, content_hash, position long, present boolean). Null keys are left out."""
    return rows.where("cnpj IS NOT NULL").groupBy("cnpj").transformWithStateInPandas(KeyedChanges(), T._parse_datatype_string(CHANGES), "update", "none")


def tombstones(previous: DataFrame, snapshot: DataFrame, position: int) -> DataFrame:
    """Rows for a stream: all of a whole snapshot (cnpj, content_hash), and a tombstone for each key of ``previous`` that it lacks."""
    here = snapshot.select("cnpj", "content_hash", F.lit(position).cast("long").alias("position"), F.lit(True).alias("present"))
    gone = previous.select("cnpj").join(snapshot.select("cnpj"), "cnpj", "left_anti").distinct()
    return here.unionByName(gone.select("cnpj", F.lit(None).cast("string").alias("content_hash"), F.lit(position).cast("long").alias("position"), F.lit(False).alias("present")))


def stream_keyed_changes(spark: SparkSession, source: str, reduce: Callable[[DataFrame], DataFrame], schema: T.StructType | str, feed: str, checkpoint: str, files_a_batch: int | None = None, file_format: str = "parquet"):
    """Process the files that are new below ``source`` and stop; returns the finished query.

    ``reduce`` turns the stream of raw rows into (cnpj, content_hash, position, present). The feed has a folder for each batch with its changes, written anew if a
    batch is repeated; state and progress are in ``checkpoint``, and a restart goes on from there. ``files_a_batch`` bounds a batch.
    """
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKSDB)
    try:
        options = {"maxFilesPerTrigger": files_a_batch} if files_a_batch else {}
        changes = keyed_changes(reduce(spark.readStream.format(file_format).schema(schema).options(**options).load(source)))

        def put(batch: DataFrame, batch_id: int) -> None:
            batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{feed}/batch={batch_id}")

        query = changes.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    finally:
        spark.conf.set(STORE, before)
