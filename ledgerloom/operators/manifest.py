"""The release manifest: built from tables, checked and compared as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = "storage_release_id json_property_name schema_version source_version updated_at record_count zip_available zip_size zip_url zip_md5checksum".split()


def build_manifest(base: DataFrame, datasets: DataFrame) -> DataFrame:
    """(value): the manifest document. base: one row (total, shard_count, last_updated, storage_release_id, shard_prefix_length);
    datasets: one row each (dataset and ``FIELDS``), written in order of name."""
    entry = F.struct("dataset", F.struct(*FIELDS).alias("entry"))
    listed = datasets.agg(F.array_sort(F.collect_list(entry)).alias("d"))  # a handful of datasets
    one = base.withColumn("__one", F.lit(1)).join(listed.withColumn("__one", F.lit(1)), "__one")
    head = ["total", "last_updated", "shard_prefix_length", "shard_count", "storage_release_id"]
    return one.select(F.to_json(F.struct(*head, F.map_from_entries("d").alias("datasets"))).alias("value"))


def orphan_releases(old: DataFrame, new: DataFrame) -> DataFrame:
    """Releases (kind, module, release) that the old manifest names and the new one doesn't."""
    return old.select("kind", "module", "release").distinct().join(new, ["kind", "module", "release"], "left_anti")


def unknown_keys(requested: DataFrame, available: DataFrame, key: str) -> DataFrame:
    return requested.select(key).distinct().join(available, key, "left_anti")


def manifest_check(datasets: DataFrame, release: str, expected: DataFrame, files: DataFrame) -> DataFrame:
    """One row a dataset: whether any dataset refers to the release, files expected and found, and whether all are there.

    expected and files: (dataset, file).
    """
    named = datasets.agg(F.coalesce(F.bool_or(F.col("storage_release_id") == release), F.lit(False)).alias("release_referenced"))
    there = expected.join(files.distinct().withColumn("__there", F.lit(1)), ["dataset", "file"], "left")
    per = there.groupBy("dataset").agg(F.count("*").alias("expected_files"), F.count("__there").alias("found_files"))
    per = per.withColumn("complete", F.col("expected_files") == F.col("found_files")).withColumn("__one", F.lit(1))
    return per.join(named.withColumn("__one", F.lit(1)), "__one").drop("__one")


def carry_forward_base(old: DataFrame, new: DataFrame) -> DataFrame:
    """The base entry of a manifest: the new one where there is one, else the old one, which must name a release."""
    ranked = new.withColumn("__rank", F.lit(0)).unionByName(old.where(F.col("storage_release_id").isNotNull()).withColumn("__rank", F.lit(1)))
    return ranked.orderBy("__rank").limit(1).drop("__rank")
