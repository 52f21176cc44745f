"""Decisions about refreshing and publishing, as columns of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def refresh_decision(catalog: DataFrame, state: DataFrame, manifest: DataFrame, now: str) -> DataFrame:
    """One row a module: a boolean for each rule, ``refresh`` if any holds, and whether the cached state may be trusted.

    catalog: (module, schema_version, refresh_hours); state: (module, source_version, schema_version, updated_at,
    data_present); manifest: (module, source_version, schema_version, updated_at). Timestamps are ISO text. The cached state is
    trusted if it agrees with what is published.
    """
    s = state.select("module", F.col("source_version").alias("s_source"), F.col("schema_version").alias("s_schema"), F.col("updated_at").alias("s_time"), "data_present")
    m = manifest.select("module", F.col("source_version").alias("m_source"), F.col("schema_version").alias("m_schema"), F.col("updated_at").alias("m_time"), F.lit(True).alias("published"))
    j = catalog.join(s, "module", "left").join(m, "module", "left")
    published = F.coalesce("published", F.lit(False))
    agrees = published & F.col("s_source").eqNullSafe(F.col("m_source")) & F.col("s_schema").eqNullSafe(F.col("m_schema")) & F.try_to_timestamp("s_time").eqNullSafe(F.try_to_timestamp("m_time"))
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.try_to_timestamp("m_time"))
    rules = {
        "not_published": ~published,
        "cache_differs": ~agrees,
        "schema_changed": ~F.col("schema_version").eqNullSafe(F.col("m_schema")),
        "too_old": F.coalesce(age >= F.col("refresh_hours") * 3600, F.lit(True)),
        "data_missing": ~F.coalesce("data_present", F.lit(False)),
    }
    out = j.select("module", *[F.coalesce(c, F.lit(False)).alias(n) for n, c in rules.items()])
    any_ = F.lit(False)
    for n in rules:
        any_ = any_ | F.col(n)
    return out.withColumn("refresh", any_).withColumn("trusted", ~F.col("cache_differs"))


def publish_decision(runs: DataFrame) -> DataFrame:
    """runs: (module, published, trusted, changed_keys, schema_before, schema_now, source_before, source_now).

    A module is published in full if it never was or its state isn't trusted; else if keys or its versions changed.
    """
    full = ~F.col("published") | ~F.col("trusted")
    meta = ~F.col("schema_before").eqNullSafe(F.col("schema_now")) | ~F.col("source_before").eqNullSafe(F.col("source_now"))
    keys = F.col("changed_keys") > 0
    return runs.select("module", full.alias("full_publish"), keys.alias("keys_changed"), meta.alias("metadata_changed"), (full | keys | meta).alias("publish"))


def any_publish(decisions: DataFrame) -> DataFrame:
    """One row: whether anything is to be published."""
    return decisions.agg(F.coalesce(F.bool_or("publish"), F.lit(False)).alias("publish"))


def module_counts(states: DataFrame, module: str = "module", key: str = "cnpj", content: str = "content_hash") -> DataFrame:
    """Distinct keys of each module that have a hash."""
    return states.where(F.col(content).isNotNull()).groupBy(module).agg(F.countDistinct(key).alias("record_count"))
