"""Queries for sources, joins, nesting, counts and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..operators import relational as R
from ..operators.modules import module_rows
from ..sources import readers, writers
from .base import FLAT_SQL, ORDERS_SQL, PREFIX_AT, PREFIX_LENGTH, STATES_SQL, flat_orders, hash_states, order_keys, padded, query, scratch, table

TIME = "2024-01-31T00:00:00Z"


# sources and sinks ------------------------------------------------------------------------------------------
@query(f"SELECT key, pfx, o_orderstatus FROM {ORDERS_SQL} WHERE pfx IN ('00', '01', '07')")
def scan_partitioned_orders(spark, sf_dir):
    path = scratch(spark)
    rows = order_keys(spark, sf_dir).select("key", "o_orderstatus")
    writers.write_partitioned(rows, path, "key", PREFIX_LENGTH, PREFIX_AT, "pfx")
    return readers.read_partitioned(spark, path, rows.schema, ["00", "01", "07"], "pfx").select("key", "pfx", "o_orderstatus")


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def scan_lookup_nation(spark, sf_dir):
    readers.load_lookups(spark, {t: f"{sf_dir}/{t}.parquet" for t in ("nation", "region")})
    return spark.sql("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")


@query("SELECT o_orderstatus, count(*) AS n, CAST(0 AS BIGINT) AS with_child FROM orders GROUP BY 1")
def empty_child_left_join(spark, sf_dir):
    child = readers.empty_like(spark, "o_orderkey bigint, note string")
    j = readers.require_nonempty(table(spark, sf_dir, "orders"), "orders").join(child, "o_orderkey", "left")
    return j.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count("note").alias("with_child"))


@query(f"SELECT DISTINCT pfx FROM {ORDERS_SQL}")
def list_prefixes(spark, sf_dir):
    return readers.list_prefixes(order_keys(spark, sf_dir), "pfx")


def order_documents(spark, sf_dir) -> DataFrame:
    """(prefix, key, value) of a small document for each order."""
    o = order_keys(spark, sf_dir)
    return o.select(F.col("pfx").alias("prefix"), "key", X.json_text(F.col("key").alias("cnpj"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p")).alias("value"))


DOCUMENTS_SQL = f"(SELECT pfx AS prefix, key, CAST(to_json({{'cnpj': key, 's': o_orderstatus, 'p': o_orderpriority}}) AS VARCHAR) AS value FROM {ORDERS_SQL})"


@query(f"SELECT value->>'$.cnpj' AS key, value->>'$.s' AS status FROM {DOCUMENTS_SQL}")
def ndjson_roundtrip(spark, sf_dir):
    path = scratch(spark)
    writers.write_documents(order_documents(spark, sf_dir), path)
    return readers.read_documents(spark, path, "cnpj string, s string, p string").select(F.col("cnpj").alias("key"), F.col("s").alias("status"))


@query(f"SELECT pfx, count(*) AS n, min(key) AS first_key, max(key) AS last_key FROM {ORDERS_SQL} GROUP BY pfx")
def partitioned_roundtrip(spark, sf_dir):
    path = scratch(spark)
    writers.write_partitioned(order_keys(spark, sf_dir).select("key"), path, "key", PREFIX_LENGTH, PREFIX_AT, "pfx")
    again = writers.write_partitioned(order_keys(spark, sf_dir).select("key"), path, "key", PREFIX_LENGTH, PREFIX_AT, "pfx", skip_existing=True)
    assert not again
    back = readers.read_partitioned(spark, path, T.StructType([T.StructField("key", T.StringType())]), key="pfx")
    return back.groupBy("pfx").agg(F.count("*").alias("n"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))


@query(f"SELECT prefix, value FROM {DOCUMENTS_SQL}")
def shard_roundtrip(spark, sf_dir):
    path = scratch(spark)
    writers.write_shards(order_documents(spark, sf_dir), path)
    return readers.read_shard_lines(spark, path).select("prefix", "value")


@query("SELECT event_type, event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_per_group(spark, sf_dir):
    return readers.latest(table(spark, sf_dir, "events"), ["event_type"], F.desc_nulls_last("ts"), F.desc("event_id")).select("event_type", "event_id", "user_id")


@query(
    """SELECT max(m) AS latest, bool_or(m = '1997-05') AS requested_present, bool_or(m = '2030-01') AS current_present, '1997-05' AS selected
FROM (SELECT strftime(o_orderdate, '%Y-%m') AS m FROM orders)"""
)
def latest_period(spark, sf_dir):
    months = table(spark, sf_dir, "orders").select(X.month("o_orderdate").alias("period")).distinct()
    return readers.select_period(months, requested="1997-05", current="2030-01")


# joins ------------------------------------------------------------------------------------------------------
@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def orders_left_customer(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name", "c_mktsegment")


@query("SELECT o_orderkey, c_mktsegment AS segment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) ON o_custkey = c_custkey")
def sparse_left_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_acctbal > 5000")
    return table(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", F.col("c_mktsegment").alias("segment"))


@query(f"SELECT key, c_name, n_name, r_name FROM {FLAT_SQL}")
def chained_lookup(spark, sf_dir):
    return flat_orders(spark, sf_dir).select("key", "c_name", "n_name", "r_name")


_CHILD_SQL = """(SELECT l_orderkey, CAST(to_json(list({'line': l_linenumber, 'part': coalesce(p_name, ''), 'flag': l_returnflag}
 ORDER BY l_linenumber, coalesce(p_name, ''), l_returnflag)) AS VARCHAR) AS items FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)"""


def _children(spark, sf_dir) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    j = line.join(table(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"), "left")
    fields = [F.col("l_linenumber").alias("line"), X.or_empty("p_name").alias("part"), F.col("l_returnflag").alias("flag")]
    return R.nest_children(j, ["l_orderkey"], fields, "items")


@query(f"SELECT l_orderkey, items FROM {_CHILD_SQL}")
def children_array(spark, sf_dir):
    return _children(spark, sf_dir).select("l_orderkey", F.to_json("items").alias("items"))


@query(
    f"""SELECT pfx AS prefix, key, '{{"key":"' || key || '","status":' || to_json(CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled' ELSE o_orderstatus END)
|| ',"date":"' || strftime(o_orderdate, '%Y-%m-%d') || '","customer":' || to_json(coalesce(c_name, '')) || ',"nation":' || to_json(coalesce(n_name, ''))
|| ',"region":' || to_json(coalesce(r_name, '')) || ',"items":' || coalesce(items, '[]') || '}}' AS value FROM {FLAT_SQL} LEFT JOIN {_CHILD_SQL} ON o_orderkey = l_orderkey"""
)
def entity_documents(spark, sf_dir):
    """One JSON document an order: the order, its customer with two chained code tables, and its nested lines."""
    items = _children(spark, sf_dir)
    j = flat_orders(spark, sf_dir).join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    doc = X.json_text(
        F.col("key"),
        X.label("o_orderstatus", {"O": "Open", "F": "Filled"}).alias("status"),
        X.guarded_date(F.date_format("o_orderdate", "yyyyMMdd")).alias("date"),
        *[X.or_empty(c).alias(n) for c, n in (("c_name", "customer"), ("n_name", "nation"), ("r_name", "region"))],
        F.coalesce("items", F.array().cast(items.schema["items"].dataType)).alias("items"),
    )
    return j.select(F.col("pfx").alias("prefix"), "key", doc.alias("value"))


# set operations, modules ------------------------------------------------------------------------------------
_OWNERS_SQL = """(SELECT o_custkey AS owner, o_orderkey AS item FROM orders WHERE o_orderstatus = 'O'
 UNION SELECT o_custkey AS owner, o_orderkey AS item FROM orders WHERE o_orderpriority = '1-URGENT')"""


def _owner_rows(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("owner"), F.col("o_orderkey").alias("item"), "o_orderstatus", "o_orderpriority")
    return R.union_distinct(o.where("o_orderstatus = 'O'").select("owner", "item"), o.where("o_orderpriority = '1-URGENT'").select("owner", "item"))


@query(f"SELECT owner, item FROM {_OWNERS_SQL}")
def owners_union(spark, sf_dir):
    return _owner_rows(spark, sf_dir)


@query(f"SELECT owner, item, o_orderstatus FROM {_OWNERS_SQL} JOIN (SELECT * FROM orders WHERE o_totalprice >= 100000) ON item = o_orderkey")
def owners_inner(spark, sf_dir):
    known = table(spark, sf_dir, "orders").where("o_totalprice >= 100000").select(F.col("o_orderkey").alias("item"), "o_orderstatus")
    return _owner_rows(spark, sf_dir).join(known, "item").select("owner", "item", "o_orderstatus")


def works_like(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item"), F.struct(F.col("o_orderkey").cast("string").alias("cno"), F.col("o_orderpriority").alias("nome")).alias("obra"))
    nested = R.nest_children(_owner_rows(spark, sf_dir).join(o, "item"), ["owner"], [F.col("obra")], "obras", ["item"])
    nested = nested.select(padded("owner").alias("cnpj"), F.transform("obras", lambda x: x["obra"]).alias("obras"))
    return module_rows(nested, [F.col("obras")], TIME, prefix_length=PREFIX_LENGTH, prefix_start=PREFIX_AT)


def first_like(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").select(padded("user_id").alias("cnpj"), "ts", "event_id", "event_type")
    one = R.first_per_key(e, ["cnpj"], ["ts", "event_id"])
    payload = [F.col("event_id").cast("string").alias("numero"), F.col("event_type").alias("categoria"), X.truth((F.col("event_type") == "view").cast("string")).alias("equiparado")]
    return module_rows(one, payload, TIME, prefix_length=PREFIX_LENGTH, prefix_start=PREFIX_AT)


def _six(payload: str, source: str) -> str:
    return f"""SELECT cnpj, substring(cnpj, {PREFIX_AT}, {PREFIX_LENGTH}) AS cnpj_prefix, payload_json, md5(payload_json) AS content_hash,
'{TIME}' AS source_updated_at, '{TIME}' AS module_updated_at FROM (SELECT cnpj, CAST(to_json({payload}) AS VARCHAR) AS payload_json FROM ({source}))"""


WORKS_SQL = _six(
    f"{{'updated_at': '{TIME}', 'obras': obras}}",
    f"""SELECT lpad(CAST(owner AS VARCHAR), 14, '0') AS cnpj, list({{'cno': CAST(item AS VARCHAR), 'nome': o_orderpriority}} ORDER BY item) AS obras
FROM {_OWNERS_SQL} JOIN orders ON item = o_orderkey GROUP BY owner""",
)
FIRST_SQL = _six(
    f"{{'updated_at': '{TIME}', 'numero': CAST(event_id AS VARCHAR), 'categoria': event_type, 'equiparado': event_type = 'view'}}",
    """SELECT lpad(CAST(user_id AS VARCHAR), 14, '0') AS cnpj, event_id, event_type
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id) AS r FROM events) WHERE r = 1""",
)


@query(WORKS_SQL)
def module_works_like(spark, sf_dir):
    return works_like(spark, sf_dir).drop("stable_hash")


@query(FIRST_SQL)
def module_first_like(spark, sf_dir):
    return first_like(spark, sf_dir).drop("stable_hash")


@query(f"SELECT DISTINCT cnpj_prefix FROM ({FIRST_SQL})")
def module_prefixes(spark, sf_dir):
    return readers.list_prefixes(first_like(spark, sf_dir))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id) AS r FROM events) WHERE r = 1")
def dedup_first(spark, sf_dir):
    return R.first_per_key(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query(
    f"""SELECT key AS cnpj, w.payload_json AS cno, f.payload_json AS rntrc FROM {ORDERS_SQL}
LEFT JOIN ({WORKS_SQL}) w ON w.cnpj = key LEFT JOIN ({FIRST_SQL}) f ON f.cnpj = key"""
)
def compose_modules(spark, sf_dir):
    base = order_keys(spark, sf_dir).select(F.col("key").alias("cnpj"))
    return R.compose(base, {"cno": works_like(spark, sf_dir), "rntrc": first_like(spark, sf_dir)})


# counts and lists -------------------------------------------------------------------------------------------
@query(f"SELECT r_name, count(*) AS n FROM {FLAT_SQL} WHERE upper(o_orderstatus) = 'F' GROUP BY r_name")
def active_by_region(spark, sf_dir):
    return R.count_by(flat_orders(spark, sf_dir), ["r_name"], F.upper("o_orderstatus") == "F")


_DIMS = ("r_name", "n_name", "c_mktsegment", "o_orderstatus", "o_orderpriority")


@query(" UNION ALL ".join(f"SELECT '{d}' AS dimension, {d} AS value, count(*) AS n FROM {FLAT_SQL} GROUP BY {d}" for d in _DIMS))
def multi_dim_counts(spark, sf_dir):
    return R.count_each(flat_orders(spark, sf_dir), list(_DIMS))


@query(
    f"""SELECT key, c_name, n_name FROM {FLAT_SQL} WHERE n_name = 'NATION_3' AND c_mktsegment = 'BUILDING' AND o_orderstatus = 'O' AND o_totalprice >= 50000
ORDER BY key LIMIT 100"""
)
def lead_list(spark, sf_dir):
    leads = R.lead_list(flat_orders(spark, sf_dir), 100, ["key"], {"o_totalprice": 50000.0}, n_name="nation_3", c_mktsegment="Building", o_orderstatus="o")
    return leads.select("key", "c_name", "n_name")


@query(f"SELECT key, o_orderstatus, c_name, r_name FROM {FLAT_SQL} WHERE key = '00000000000123' LIMIT 1")
def point_lookup(spark, sf_dir):
    return flat_orders(spark, sf_dir).where(F.col("key") == "00000000000123").select("key", "o_orderstatus", "c_name", "r_name").limit(1)


_ASKED_SQL = f"""(SELECT CASE o_orderkey % 3 WHEN 0 THEN substring(k,1,2) || '.' || substring(k,3,3) || '.' || substring(k,6,3) || '/' || substring(k,9,4) || '-' || substring(k,13,2)
WHEN 1 THEN '9' || substring(k, 2) ELSE substring(k, 3) END AS raw, CASE o_orderkey % 3 WHEN 2 THEN substring(k, 3) WHEN 1 THEN '9' || substring(k, 2) ELSE k END AS cnpj
FROM (SELECT o_orderkey, key AS k FROM {ORDERS_SQL}))"""


def asked_keys(spark, sf_dir) -> DataFrame:
    """A user's list: masked keys, unknown keys, and text that is no key."""
    k, kind = F.col("key"), F.col("o_orderkey") % 3
    raw = F.when(kind == 0, X.mask_key(k)).when(kind == 1, F.concat(F.lit("9"), F.substring(k, 2, 13))).otherwise(F.substring(k, 3, 12))
    return order_keys(spark, sf_dir).select(raw.alias("raw"))


@query(f"SELECT raw, cnpj AS key, c_name, r_name FROM {_ASKED_SQL} LEFT JOIN (SELECT key, c_name, r_name FROM {FLAT_SQL}) ON cnpj = key")
def bulk_enrich(spark, sf_dir):
    return R.enrich(asked_keys(spark, sf_dir), flat_orders(spark, sf_dir), "key", ["c_name", "r_name"])


@query(
    f"""SELECT raw, a.cnpj, CASE WHEN length(a.cnpj) <> 14 THEN 'invalid' WHEN d.value IS NULL THEN 'not_found' ELSE 'ok' END AS outcome, d.value,
CASE WHEN d.value IS NOT NULL THEN f.payload_json END AS rntrc FROM {_ASKED_SQL} a LEFT JOIN {DOCUMENTS_SQL} d ON a.cnpj = d.key LEFT JOIN ({FIRST_SQL}) f ON f.cnpj = a.cnpj"""
)
def batch_lookup(spark, sf_dir):
    from ..operators.lookup import lookup

    modules = {"cno": works_like(spark, sf_dir), "rntrc": first_like(spark, sf_dir)}
    return lookup(asked_keys(spark, sf_dir), order_documents(spark, sf_dir), modules, "base, rntrc", prefix_length=PREFIX_LENGTH, prefix_start=PREFIX_AT)


# change data ------------------------------------------------------------------------------------------------
def _diff_sql(previous: str) -> str:
    return f"""WITH {STATES_SQL} SELECT coalesce(p.cnpj, c.cnpj) AS cnpj, CASE WHEN p.cnpj IS NULL THEN 'added' WHEN c.cnpj IS NULL THEN 'removed' ELSE 'changed' END AS change,
p.content_hash AS previous_hash, c.content_hash AS current_hash FROM {previous} p FULL JOIN curr c ON p.cnpj = c.cnpj WHERE p.content_hash IS DISTINCT FROM c.content_hash"""


@query("SELECT o_orderstatus, count(*) AS n, md5(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey)) AS children, true AS bounded FROM orders GROUP BY o_orderstatus")
def children_pieces(spark, sf_dir):
    """All orders of a status, of which one has half of them, in pieces of at most 500; joined in order they are all of them."""
    pieces = R.nest_pieces(table(spark, sf_dir, "orders"), ["o_orderstatus"], ["o_orderkey"], 500)
    short = pieces.select("o_orderstatus", "piece", F.size("children").alias("k"), F.array_join(F.transform("children", lambda x: x["o_orderkey"].cast("string")), ",").alias("text"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "text"))), lambda x: x["text"]), ",")
    return short.groupBy("o_orderstatus").agg(F.sum("k").alias("n"), F.md5(whole).alias("children"), (F.max("k") <= 500).alias("bounded"))


@query(_diff_sql("prev"))
def hash_diff(spark, sf_dir):
    return R.hash_diff(*hash_states(spark, sf_dir))


@query(_diff_sql("prev"))
def hash_diff_tree(spark, sf_dir):
    """The same by trees of digests of two written states; prefixes are taken where padded order keys differ."""
    from ..operators.digests import tree_diff, write_tree

    old, new = hash_states(spark, sf_dir)
    paths = [write_tree(x, scratch(spark), start=9) for x in (old, new)]
    return tree_diff(spark, *paths, start=9)


@query(_diff_sql("(SELECT * FROM prev WHERE false)"))
def hash_diff_untrusted(spark, sf_dir):
    return R.hash_diff(*hash_states(spark, sf_dir), trusted=False)


@query(f"SELECT cnpj, change, coalesce(current_hash, previous_hash) AS content_hash, CAST(7 AS BIGINT) AS batch_id FROM ({_diff_sql('prev')})")
def change_feed_batch(spark, sf_dir):
    from ..streaming.changes import change_feed

    return change_feed(*hash_states(spark, sf_dir), 7)
