"""Queries for shards, manifests, decisions and reports. Their small tables are derived from the driver's."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import changes, manifest, quality, shards
from ..operators.relational import carry_forward as carry
from ..sources import readers, writers
from .base import FLAT_SQL, ORDERS_SQL, PREFIX_AT, flat_orders, order_keys, query, scratch, table
from .tables import DOCUMENTS_SQL, FIRST_SQL, WORKS_SQL, first_like, order_documents, works_like

NOW = "2024-01-31T00:00:00Z"

INDEX_SQL = f"""(SELECT prefix, key, CAST(row_number() OVER w - 1 AS INTEGER) AS ordinal,
CAST(coalesce(sum(strlen(value) + 1) OVER (PARTITION BY prefix ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
CAST(strlen(value) + 1 AS INTEGER) AS length FROM {DOCUMENTS_SQL} WINDOW w AS (PARTITION BY prefix ORDER BY key))"""


# shards -----------------------------------------------------------------------------------------------------
@query(f"SELECT * FROM {INDEX_SQL}")
def shard_index(spark, sf_dir):
    return shards.shard_index(order_documents(spark, sf_dir), stretch=PREFIX_AT - 1)


@query(f"SELECT prefix, count(*) AS records, CAST(sum(length) AS BIGINT) AS bytes FROM {INDEX_SQL} GROUP BY prefix")
def shard_counts(spark, sf_dir):
    return shards.shard_counts(shards.shard_index(order_documents(spark, sf_dir), stretch=PREFIX_AT - 1))


@query(f"SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS shard_count FROM (SELECT prefix, count(*) AS n FROM {DOCUMENTS_SQL} GROUP BY prefix)")
def release_totals(spark, sf_dir):
    return shards.release_totals(shards.shard_counts(shards.shard_index(order_documents(spark, sf_dir), stretch=PREFIX_AT - 1)))


@query(
    f"""SELECT prefix, CAST(sum(strlen(value) + 1) AS BIGINT) AS bytes, md5(string_agg(value, chr(10) ORDER BY key) || chr(10)) AS md5 FROM {DOCUMENTS_SQL} GROUP BY prefix"""
)
def shard_artifact_summary(spark, sf_dir):
    return shards.shard_artifact_summary(order_documents(spark, sf_dir))


@query(f"SELECT prefix, value FROM {DOCUMENTS_SQL}")
def shard_pieces_roundtrip(spark, sf_dir):
    """Shards in pieces hold every document; ``verify_files`` finds nothing wrong with them."""
    docs, path = order_documents(spark, sf_dir), scratch(spark)
    writers.write_shard_pieces(docs, path)
    faults = shards.verify_files(shards.shard_index(docs, stretch=PREFIX_AT - 1), shards.file_lines(spark, path))
    lines = readers.read_shard_lines(spark, path).select("prefix", "value")
    return lines.unionByName(faults.select("prefix", F.col("fault").alias("value")))


@query(f"SELECT prefix, CAST(sum(strlen(value) + 1) AS BIGINT) AS bytes, count(*) AS records FROM {DOCUMENTS_SQL} GROUP BY prefix")
def shard_pieces_bytes(spark, sf_dir):
    """Bytes of the pieces of each shard, and of the lines that they hold."""
    path = scratch(spark)
    writers.write_shard_pieces(order_documents(spark, sf_dir), path, 12)
    sums = shards.shard_checksums(shards.shard_pieces(spark, path)).select("prefix", "bytes")
    return sums.join(shards.file_lines(spark, path).groupBy("prefix").agg(F.count("*").alias("records")), "prefix")


@query(
    f"""WITH i AS (SELECT *, ordinal = max(ordinal) OVER (PARTITION BY prefix) AS last FROM {INDEX_SQL})
SELECT 'wrong_length' AS fault, prefix, key, "offset" FROM i WHERE prefix = '07' AND ordinal = 3
UNION ALL SELECT 'no_line', prefix, key, "offset" FROM i WHERE prefix = '07' AND ordinal > 3 UNION ALL SELECT 'unindexed', prefix, key, "offset" + 1 FROM i WHERE prefix = '07' AND ordinal > 3
UNION ALL SELECT 'no_line', prefix, key, "offset" FROM i WHERE prefix = '05' AND last
UNION ALL SELECT 'wrong_key', prefix, key, "offset" FROM i WHERE prefix = '03' AND ordinal = 2"""
)
def verify_written_files(spark, sf_dir):
    """Files with a line that a byte was put into, so that all after it are shifted, a shard that was cut off, and a line of another document."""
    docs, path = order_documents(spark, sf_dir), scratch(spark)
    index = shards.shard_index(docs, stretch=PREFIX_AT - 1)
    last = F.max("ordinal").over(Window.partitionBy("prefix"))
    at = index.withColumn("last", F.col("ordinal") == last).select(F.col("prefix").alias("p"), F.col("key").alias("k"), "ordinal", "last")
    placed = docs.join(at, (F.col("prefix") == F.col("p")) & (F.col("key") == F.col("k")))
    value = F.when((F.col("p") == "07") & (F.col("ordinal") == 3), F.concat("value", F.lit(" "))).when((F.col("p") == "03") & (F.col("ordinal") == 2), F.regexp_replace("value", '"cnpj":"0', '"cnpj":"9'))
    spoilt = placed.where("NOT (p = '05' AND last)").select("prefix", "key", F.coalesce(value, "value").alias("value"))
    writers.write_shard_pieces(spoilt, path)
    return shards.verify_files(index, shards.file_lines(spark, path))


_FAULTY_SQL = f"""(SELECT prefix, CASE WHEN prefix = '03' AND ordinal = 4 THEN '00000000000000' WHEN prefix = '05' AND ordinal = 2
THEN (SELECT key FROM {INDEX_SQL} x WHERE x.prefix = '05' AND x.ordinal = 1) ELSE key END AS key, ordinal, "offset" + CASE WHEN prefix = '07' AND ordinal >= 3 THEN 5 ELSE 0 END AS "offset", length FROM {INDEX_SQL})"""


@query(
    f"""SELECT fault, prefix, key FROM (SELECT *, lag(key) OVER w AS last, coalesce(lag("offset" + length) OVER w, 0) AS gone FROM {_FAULTY_SQL} WINDOW w AS (PARTITION BY prefix ORDER BY ordinal)),
LATERAL (SELECT unnest([CASE WHEN last > key THEN 'unsorted' END, CASE WHEN last = key THEN 'duplicate' END, CASE WHEN gone <> "offset" THEN 'gap' END]) AS fault) WHERE fault IS NOT NULL"""
)
def verify_shards(spark, sf_dir):
    index = shards.shard_index(order_documents(spark, sf_dir), stretch=PREFIX_AT - 1)
    twin = index.where("prefix = '05' AND ordinal = 1").select(F.col("prefix").alias("p"), F.col("key").alias("twin"))
    spoilt = index.join(twin, F.col("prefix") == F.col("p"), "left")
    key = F.when((F.col("prefix") == "03") & (F.col("ordinal") == 4), "0" * 14).when((F.col("prefix") == "05") & (F.col("ordinal") == 2), F.col("twin")).otherwise(F.col("key"))
    offset = F.col("offset") + F.when((F.col("prefix") == "07") & (F.col("ordinal") >= 3), 5).otherwise(0)
    return shards.verify_shards(spoilt.select("prefix", key.alias("key"), "ordinal", offset.alias("offset"), "length"))


_PLAN_SQL = f"""(SELECT pfx AS prefix, CASE WHEN CAST(pfx AS INTEGER) % 3 = 0 THEN 'reuse' ELSE 'generate' END AS action FROM (SELECT DISTINCT pfx FROM {ORDERS_SQL}))"""


@query(f"SELECT * FROM {_PLAN_SQL}")
def release_plan(spark, sf_dir):
    wanted = order_keys(spark, sf_dir).select(F.col("pfx").alias("prefix")).distinct()
    n = F.col("prefix").cast("int") % 3
    files = F.when(n == 0, F.array(F.lit("data"), F.lit("index"))).when(n == 1, F.array(F.lit("data"))).otherwise(F.array().cast("array<string>"))
    return shards.release_plan(wanted, wanted.select("prefix", F.explode(files).alias("file")))


@query(f"SELECT prefix || suffix AS file FROM (SELECT DISTINCT pfx AS prefix FROM {ORDERS_SQL}), (VALUES ('.ndjson'), ('.index')) v(suffix)")
def upload_targets(spark, sf_dir):
    return shards.upload_targets(order_keys(spark, sf_dir).select(F.col("pfx").alias("prefix")).distinct())


# manifest ---------------------------------------------------------------------------------------------------
def datasets(spark, sf_dir) -> DataFrame:
    """A "dataset" for each order status: its release is a digest of what it holds."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("dataset")).agg(F.count("*").alias("record_count"), F.max(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("updated_at"))
    release = F.md5(F.concat_ws("|", "dataset", F.col("record_count").cast("string"), "updated_at"))
    return o.select(
        "dataset", release.alias("storage_release_id"), F.lower("dataset").alias("json_property_name"), F.lit("1").alias("schema_version"), F.lit(None).cast("string").alias("source_version"),
        "updated_at", "record_count", F.lit(True).alias("zip_available"), (F.col("record_count") * 100).alias("zip_size"), F.concat(F.lit("zip/"), "dataset").alias("zip_url"), F.lit("").alias("zip_md5checksum"),
    )


_DATASETS_SQL = """(SELECT o_orderstatus AS dataset, md5(o_orderstatus || '|' || count(*) || '|' || max(strftime(o_orderdate, '%Y-%m-%d'))) AS storage_release_id,
count(*) AS record_count, max(strftime(o_orderdate, '%Y-%m-%d')) AS updated_at FROM orders GROUP BY o_orderstatus)"""
_ROWS_SQL = f"""SELECT dataset, storage_release_id, lower(dataset) AS json_property_name, '1' AS schema_version, CAST(NULL AS VARCHAR) AS source_version, updated_at, record_count,
true AS zip_available, record_count * 100 AS zip_size, 'zip/' || dataset AS zip_url, '' AS zip_md5checksum FROM {_DATASETS_SQL}"""


def _document(spark, sf_dir) -> DataFrame:
    totals = table(spark, sf_dir, "orders").agg(F.count("*").alias("total"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_updated"))
    base = totals.withColumn("shard_count", F.lit(100)).withColumn("storage_release_id", F.md5("last_updated")).withColumn("shard_prefix_length", F.lit(2))
    return manifest.build_manifest(base, datasets(spark, sf_dir))


@query(_ROWS_SQL)
def manifest_rows(spark, sf_dir):
    return readers.manifest_datasets(_document(spark, sf_dir))


@query(
    """SELECT event_type AS dataset, md5(event_type) AS storage_release_id, event_type AS json_property_name, '' AS schema_version, CAST(NULL AS VARCHAR) AS source_version,
CAST(NULL AS VARCHAR) AS updated_at, count(*) AS record_count, false AS zip_available, CAST(0 AS BIGINT) AS zip_size, '' AS zip_url, '' AS zip_md5checksum
FROM events WHERE event_type <> 'error' GROUP BY event_type"""
)
def manifest_explode(spark, sf_dir):
    """Manifests with missing fields, a dataset without a release, and text that is no manifest."""
    e = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    release = F.when(F.col("event_type") == "error", F.lit(" ")).otherwise(F.md5("event_type"))
    entry = F.to_json(F.struct(F.map_from_arrays(F.array("event_type"), F.array(F.struct(release.alias("storage_release_id"), F.col("n").alias("record_count")))).alias("datasets")))
    texts = e.select(entry.alias("value"))
    return readers.manifest_datasets(texts.unionByName(e.select(F.concat(F.lit("{broken "), "event_type").alias("value"))))


@query("SELECT DISTINCT 'module' AS kind, o_orderpriority AS module, md5(o_orderpriority) AS release FROM orders WHERE o_orderpriority <= '2-HIGH'")
def orphan_releases(spark, sf_dir):
    old = table(spark, sf_dir, "orders").select(F.lit("module").alias("kind"), F.col("o_orderpriority").alias("module"), F.md5("o_orderpriority").alias("release"))
    new = table(spark, sf_dir, "orders").where("o_orderpriority > '2-HIGH'").select(F.lit("module").alias("kind"), F.col("o_orderpriority").alias("module"), F.md5("o_orderpriority").alias("release")).distinct()
    return manifest.orphan_releases(old, new)


@query("SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 2000)")
def unknown_keys(spark, sf_dir):
    known = table(spark, sf_dir, "customer").where("c_acctbal > 2000").select(F.col("c_custkey").alias("user_id"))
    return manifest.unknown_keys(table(spark, sf_dir, "events"), known, "user_id")


@query(
    f"""SELECT dataset, CASE WHEN dataset = 'O' THEN storage_release_id ELSE md5(storage_release_id) END AS storage_release_id, CASE WHEN dataset = 'O' THEN 'new' ELSE 'old' END AS origin FROM {_DATASETS_SQL}"""
)
def carry_forward(spark, sf_dir):
    d = datasets(spark, sf_dir)
    old = d.select("dataset", F.md5("storage_release_id").alias("storage_release_id"), F.lit("old").alias("origin"))
    new = d.where("dataset = 'O'").select("dataset", "storage_release_id", F.lit("new").alias("origin"))
    return carry(old, new, ["dataset"])


@query(
    """SELECT o_orderstatus AS dataset, count(DISTINCT o_orderpriority) AS expected_files, count(DISTINCT CASE WHEN o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW' THEN o_orderpriority END) AS found_files,
o_orderstatus <> 'P' AS complete, true AS release_referenced FROM orders GROUP BY o_orderstatus"""
)
def manifest_check(spark, sf_dir):
    files = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("dataset"), F.col("o_orderpriority").alias("file")).distinct()
    d = datasets(spark, sf_dir).withColumn("storage_release_id", F.when(F.col("dataset") == "F", "r1").otherwise(F.col("storage_release_id")))
    return manifest.manifest_check(d, "r1", files, files.where("dataset <> 'P' OR file <> '5-LOW'"))


# decisions --------------------------------------------------------------------------------------------------
@query(f"SELECT 'first' AS module, count(*) AS record_count FROM ({FIRST_SQL}) UNION ALL SELECT 'works' AS module, count(*) AS record_count FROM ({WORKS_SQL})")
def module_counts(spark, sf_dir):
    of = lambda df, name: df.select(F.lit(name).alias("module"), "cnpj", "content_hash")
    return changes.module_counts(of(first_like(spark, sf_dir), "first").unionByName(of(works_like(spark, sf_dir), "works")))


@query(
    """WITH m AS (SELECT event_type AS module, max(ts) AS last, md5(event_type) AS v FROM events GROUP BY event_type),
r AS (SELECT module, module = 'view' AS not_published, module IN ('view', 'error') AS cache_differs, module IN ('view', 'signup') AS schema_changed,
module = 'view' OR epoch(TIMESTAMP '2024-01-31 00:00:00') - floor(epoch(last)) >= 2000 AS too_old, module = 'click' AS data_missing FROM m)
SELECT *, not_published OR cache_differs OR schema_changed OR too_old OR data_missing AS refresh, NOT cache_differs AS trusted FROM r"""
)
def refresh_decision(spark, sf_dir):
    """A module for each event type, published at its last event; one is unpublished, one outdated, and so on."""
    e = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("module")).agg(F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("updated_at"))
    e = e.withColumn("source_version", F.md5("module")).withColumn("schema_version", F.lit("1"))
    is_ = lambda name: F.col("module") == name
    catalog = e.select("module", F.when(is_("signup"), "2").otherwise("1").alias("schema_version"), F.lit(2000 / 3600).alias("refresh_hours"))
    state = e.withColumn("source_version", F.when(is_("error"), "x").otherwise(F.col("source_version"))).withColumn("data_present", ~is_("click"))
    return changes.refresh_decision(catalog, state, e.where(~is_("view")), NOW)


_RUNS_SQL = """(SELECT o_orderpriority AS module, o_orderpriority <> '1-URGENT' AS published, o_orderpriority <> '2-HIGH' AS trusted,
count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O') AS changed_keys, o_orderpriority = '5-LOW' AS meta FROM orders GROUP BY o_orderpriority)"""


@query(
    f"""SELECT module, NOT published OR NOT trusted AS full_publish, changed_keys > 0 AS keys_changed, meta AS metadata_changed,
NOT published OR NOT trusted OR changed_keys > 0 OR meta AS publish FROM {_RUNS_SQL}"""
)
def publish_decision(spark, sf_dir):
    p = F.col("o_orderpriority")
    runs = table(spark, sf_dir, "orders").groupBy(p.alias("module")).agg(F.count(F.when((p == "3-MEDIUM") & (F.col("o_orderstatus") == "O"), 1)).alias("changed_keys"))
    m = F.col("module")
    runs = runs.select("module", "changed_keys", (m != "1-URGENT").alias("published"), (m != "2-HIGH").alias("trusted"), F.lit("1").alias("schema_before"), F.when(m == "5-LOW", "2").otherwise("1").alias("schema_now"), m.alias("source_before"), m.alias("source_now"))
    return changes.publish_decision(runs)


# quality ----------------------------------------------------------------------------------------------------
_RULES = (
    quality.Rule("key", pattern=r"^[0-9]{14}\z", longest=14),
    quality.Rule("c_name", shortest=5, longest=17),
    quality.Rule("n_name", longest=8),
    quality.Rule("segment", required=False, pattern="^[A-Z]{1,9}\\z"),
    quality.Rule("phone"),
    quality.Rule("words[]", longest=4),
)


@query(
    f"""WITH d AS (SELECT *, string_split(o_orderpriority, '-') AS words, CASE WHEN o_orderkey % 11 <> 0 THEN c_name END AS phone FROM {FLAT_SQL})
SELECT 'n_name:too_long' AS rule, count(*) AS n FROM d WHERE length(n_name) > 8 HAVING count(*) > 0
UNION ALL SELECT 'c_name:too_long' AS rule, count(*) AS n FROM d WHERE length(c_name) > 17 HAVING count(*) > 0
UNION ALL SELECT 'segment:pattern' AS rule, count(*) AS n FROM d WHERE length(c_mktsegment) > 9 HAVING count(*) > 0
UNION ALL SELECT 'phone:required' AS rule, count(*) AS n FROM d WHERE phone IS NULL HAVING count(*) > 0
UNION ALL SELECT 'words[]:too_long' AS rule, count(*) AS n FROM d WHERE len(list_filter(words, lambda x: length(x) > 4)) > 0 HAVING count(*) > 0"""
)
def conformance_report(spark, sf_dir):
    d = flat_orders(spark, sf_dir).withColumn("segment", F.col("c_mktsegment")).withColumn("words", F.split("o_orderpriority", "-"))
    return quality.conformance_report(d.withColumn("phone", F.when(F.col("o_orderkey") % 11 != 0, F.col("c_name"))), _RULES)
