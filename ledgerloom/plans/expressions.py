"""Queries for the column builders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.quality import duplicate_keys as duplicates
from ..operators.quality import key_quality as quality
from ..operators.relational import explode_count
from .base import KEY_SQL, ORDERS_SQL, order_keys, query, table

STATUS = {"O": "Open", "F": "Filled"}
PRIORITY = {"1-URGENT": "Urgent", "2-HIGH": "High", "5-LOW": "Low"}
FLAG = {"A": "Accepted", "R": "Returned"}
LINE = {"F": "Filled", "O": "Open"}


def _case(column: str, names: dict[str, str], other: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + f" ELSE {other} END"


@query(f"SELECT substring(key, 1, 8) || substring(key, 9, 4) || substring(key, 13, 2) AS key, substring(key, 11, 2) AS pfx FROM {ORDERS_SQL}")
def entity_key(spark, sf_dir):
    parts = order_keys(spark, sf_dir).select(F.substring("key", 1, 8).alias("a"), F.substring("key", 9, 4).alias("b"), F.substring("key", 13, 2).alias("c"))
    key = X.entity_key("a", "b", "c")
    return parts.select(key.alias("key"), X.key_prefix(key, 2, 11).alias("pfx"))


@query(f"SELECT key, substring(key, 1, 8) AS base, substring(key, 9, 4) AS ord, substring(key, 13, 2) AS digits FROM {ORDERS_SQL}")
def key_parts(spark, sf_dir):
    return order_keys(spark, sf_dir).select("key", X.key_parts(X.mask_key("key")).alias("p")).select("key", "p.base", "p.ord", "p.digits")


@query(
    """SELECT c.c_custkey, coalesce(s.c_name, '') AS name, coalesce(s.c_mktsegment, '') AS segment FROM customer c
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) s ON c.c_custkey = s.c_custkey"""
)
def default_empty(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    rich = c.where("c_acctbal > 5000").select("c_custkey", "c_name", "c_mktsegment")
    return c.select("c_custkey").join(rich, "c_custkey", "left").select("c_custkey", X.or_empty("c_name").alias("name"), X.or_empty("c_mktsegment").alias("segment"))


@query(f"SELECT o_orderkey, {_case('o_orderstatus', STATUS, 'o_orderstatus')} AS status FROM orders")
def label_status(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", X.label("o_orderstatus", STATUS).alias("status"))


@query(
    f"""SELECT {_case("o_orderpriority", PRIORITY, "coalesce(o_orderpriority, '')")} AS label, count(*) AS n FROM orders GROUP BY 1
UNION ALL SELECT {_case("l_returnflag", FLAG, "''")} AS label, count(*) AS n FROM lineitem GROUP BY 1"""
)
def label_map(spark, sf_dir):
    count = lambda df, c: df.groupBy(c.alias("label")).agg(F.count("*").alias("n"))
    a = count(table(spark, sf_dir, "orders"), X.label("o_orderpriority", PRIORITY, "empty"))
    return a.unionByName(count(table(spark, sf_dir, "lineitem"), X.label("l_returnflag", FLAG, "blank")))


@query(f"SELECT l_linestatus AS codigo, {_case('l_linestatus', LINE, chr(39) * 2)} AS descricao, count(*) AS n FROM lineitem GROUP BY 1, 2")
def code_struct(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").select(X.code_struct("l_linestatus", LINE).alias("c"))
    return c.groupBy("c.codigo", "c.descricao").agg(F.count("*").alias("n"))


_DATES_SQL = "(SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'n/a ' || o_orderkey ELSE strftime(o_orderdate, '%Y%m%d') END AS raw FROM orders)"


@query(
    f"""SELECT o_orderkey, iso, strftime(try_cast(iso AS DATE), '%d/%m/%Y') AS typed FROM (SELECT o_orderkey, CASE WHEN regexp_full_match(raw, '[0-9]{{8}}')
THEN substring(raw, 1, 4) || '-' || substring(raw, 5, 2) || '-' || substring(raw, 7, 2) ELSE coalesce(raw, '') END AS iso FROM {_DATES_SQL})"""
)
def guarded_date(spark, sf_dir):
    kind = F.col("o_orderkey") % 4
    raw = F.when(kind == 1, F.concat(F.lit("n/a "), F.col("o_orderkey").cast("string"))).when(kind > 1, F.date_format("o_orderdate", "yyyyMMdd"))
    d = table(spark, sf_dir, "orders").select("o_orderkey", X.guarded_date(raw).alias("iso"))
    return d.select("o_orderkey", "iso", F.date_format(X.typed_date("iso"), "dd/MM/yyyy").alias("typed"))


@query("SELECT p_partkey, CAST(to_json(string_split(p_name, ' ')) AS VARCHAR) AS words FROM part")
def split_list(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.to_json(X.split_list("p_name", " ")).alias("words"))


@query("SELECT item, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS item FROM part) GROUP BY item")
def explode_counts(spark, sf_dir):
    return explode_count(table(spark, sf_dir, "part"), X.split_list("p_name", " "))


@query(
    """SELECT c_custkey, CAST(to_json(list_filter([
CASE WHEN c_acctbal > 3000 THEN {'ddd': CAST(c_nationkey AS VARCHAR), 'numero': c_name, 'is_fax': false} END,
CASE WHEN c_mktsegment = 'BUILDING' THEN {'ddd': '', 'numero': c_mktsegment, 'is_fax': false} END,
CASE WHEN c_nationkey < 5 THEN {'ddd': CAST(c_nationkey AS VARCHAR), 'numero': '', 'is_fax': true} END], lambda x: x IS NOT NULL)) AS VARCHAR) AS phones FROM customer"""
)
def compact_struct_array(spark, sf_dir):
    phone = lambda area, number, fax: F.struct(area.alias("ddd"), number.alias("numero"), F.lit(fax).alias("is_fax"))
    nation, empty = F.col("c_nationkey").cast("string"), F.lit("")
    phones = X.compact(
        F.when(F.col("c_acctbal") > 3000, phone(nation, F.col("c_name"), False)),
        F.when(F.col("c_mktsegment") == "BUILDING", phone(empty, F.col("c_mktsegment"), False)),
        F.when(F.col("c_nationkey") < 5, phone(nation, empty, True)),
    )
    return table(spark, sf_dir, "customer").select("c_custkey", F.to_json(phones).alias("phones"))


@query(
    f"""SELECT key, CAST(to_json({{'key': key, 'status': o_orderstatus, 'customer': s.c_name, 'segment': s.c_mktsegment}}) AS VARCHAR) AS doc FROM {ORDERS_SQL} o
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) s ON o_custkey = s.c_custkey"""
)
def to_json_keep_nulls(spark, sf_dir):
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 5000")
    j = order_keys(spark, sf_dir).join(rich, F.col("o_custkey") == F.col("c_custkey"), "left")
    return j.select("key", X.json_text(F.col("key"), F.col("o_orderstatus").alias("status"), F.col("c_name").alias("customer"), F.col("c_mktsegment").alias("segment")).alias("doc"))


@query(
    """SELECT c_custkey, clean FROM (SELECT c_custkey, regexp_replace(coalesce(c_name, ''), '[^0-9A-Za-z]', '', 'g') AS clean FROM customer) WHERE length(clean) = 17"""
)
def clean_identifier(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", X.clean_identifier("c_name").alias("clean")).where(F.length("clean") == 17)


_MASKED_SQL = f"(SELECT o_orderkey, {KEY_SQL} AS k FROM orders)"


@query(f"SELECT o_orderkey, upper('ab' || substring(k, 3)) AS key FROM {_MASKED_SQL}")
def normalize_key(spark, sf_dir):
    o = order_keys(spark, sf_dir).select("o_orderkey", F.concat(F.lit("aB."), F.substring("key", 3, 6), F.lit("/"), F.substring("key", 9, 4), F.lit("-"), F.substring("key", 13, 2)).alias("raw"))
    return o.select("o_orderkey", X.normalize_key("raw").alias("key"))


@query(f"SELECT o_orderkey, substring(k,1,2) || '.' || substring(k,3,3) || '.' || substring(k,6,3) || '/' || substring(k,9,4) || '-' || substring(k,13,2) AS masked FROM {_MASKED_SQL}")
def mask_key(spark, sf_dir):
    return order_keys(spark, sf_dir).select("o_orderkey", X.mask_key("key").alias("masked"))


_RAW_SQL = f"""(SELECT o_orderkey, k, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN k || '#' WHEN 2 THEN substring(k, 2) WHEN 3 THEN substring(k, 1, 12) || 'AB'
WHEN 4 THEN repeat(CAST(o_orderkey % 10 AS VARCHAR), 14) ELSE k END AS raw FROM {_MASKED_SQL})"""


def _raw_keys(spark, sf_dir):
    """Keys that are faulty in every way."""
    k, kind = F.col("key"), F.col("o_orderkey") % 7
    raw = F.when(kind == 1, F.concat(k, F.lit("#"))).when(kind == 2, F.substring(k, 2, 13)).when(kind == 3, F.concat(F.substring(k, 1, 12), F.lit("AB")))
    raw = raw.when(kind == 4, F.repeat((F.col("o_orderkey") % 10).cast("string"), F.lit(14))).when(kind > 4, k)
    return order_keys(spark, sf_dir).select("o_orderkey", raw.alias("raw"))


def _digit_sql(raw: str, weights) -> str:
    total = " + ".join(f"(ascii(substring({raw}, {i + 1}, 1)) - 48) * {w}" for i, w in enumerate(weights))
    return f"(CASE WHEN ({total}) % 11 < 2 THEN 0 ELSE 11 - ({total}) % 11 END)"


def _digits_sql(base: str) -> str:
    first = f"CAST({_digit_sql(base, X.WEIGHTS_FIRST)} AS VARCHAR)"
    return f"({first} || CAST({_digit_sql(f'({base} || {first})', X.WEIGHTS_SECOND)} AS VARCHAR))"


_REASON_SQL = f"""CASE WHEN coalesce(trim(raw), '') = '' THEN 'empty' WHEN regexp_matches(raw, '[^A-Za-z0-9./-]') THEN 'bad_character' WHEN length(raw) <> 14 THEN 'bad_length'
WHEN NOT regexp_full_match(raw, '[A-Z0-9]{{12}}[0-9]{{2}}') THEN 'bad_pattern' WHEN raw = repeat(raw[1], 14) THEN 'repeated'
WHEN {_digits_sql("substring(raw, 1, 12)")} <> substring(raw, 13, 2) THEN 'bad_digits' ELSE 'ok' END"""


@query(
    f"""SELECT o_orderkey, reason, reason = 'ok' AS by_digits, reason IN ('ok', 'bad_digits') AS by_format, reason IN ('ok', 'bad_digits', 'repeated') AS by_pattern
FROM (SELECT o_orderkey, {_REASON_SQL} AS reason FROM {_RAW_SQL})"""
)
def validate_key(spark, sf_dir):
    # one reason tells all levels: a level passes over the faults that only a stricter one looks for
    later = {"by_digits": [], "by_format": ["bad_digits"], "by_pattern": ["bad_digits", "repeated"]}
    return _raw_keys(spark, sf_dir).select("o_orderkey", X.key_reason("raw").alias("reason")).select("o_orderkey", "reason", *[F.col("reason").isin("ok", *v).alias(k) for k, v in later.items()])


def _level_sql(level: str) -> str:
    """The reason at a level, of a key that may have white space around it."""
    reason = _REASON_SQL.replace("coalesce(trim(raw), '') = ''", "regexp_full_match(coalesce(raw, ''), '\\s*')")
    if level == "pattern":
        return reason.replace("raw", "bare").replace("WHEN bare = repeat(bare[1], 14) THEN 'repeated'", "").replace(f"WHEN {_digits_sql('substring(bare, 1, 12)')} <> substring(bare, 13, 2) THEN 'bad_digits'", "")
    return reason.replace(f"WHEN {_digits_sql('substring(raw, 1, 12)')} <> substring(raw, 13, 2) THEN 'bad_digits'", "") if level == "format" else reason


_SPACED_SQL = f"""(SELECT o_orderkey, raw, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS bare FROM
(SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN chr(9) || raw || chr(10) WHEN o_orderkey % 11 = 0 THEN chr(13) || chr(10) ELSE raw END AS raw FROM {_RAW_SQL}))"""


@query(f"SELECT o_orderkey, {', '.join(f'{_level_sql(x)} AS {x}' for x in ('pattern', 'format', 'check_digits'))} FROM {_SPACED_SQL}")
def key_levels(spark, sf_dir):
    """Each level of validation by itself, on keys of which some have tabs and line breaks around them or hold nothing else."""
    raw = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("\t"), "raw", F.lit("\n"))).when(F.col("o_orderkey") % 11 == 0, "\r\n").otherwise(F.col("raw"))
    keys = _raw_keys(spark, sf_dir).select("o_orderkey", raw.alias("raw"))
    return keys.select("o_orderkey", *[X.key_reason("raw", x).alias(x) for x in ("pattern", "format", "check_digits")])


@query(f"SELECT o_orderkey, base, {_digits_sql('base')} AS digits FROM (SELECT o_orderkey, substring(k, 3) AS base FROM {_MASKED_SQL})")
def check_digits(spark, sf_dir):
    return order_keys(spark, sf_dir).select("o_orderkey", F.substring("key", 3, 12).alias("base")).withColumn("digits", X.check_digits("base"))


@query(f"SELECT reason, count(*) AS n FROM (SELECT {_REASON_SQL} AS reason FROM {_RAW_SQL}) GROUP BY reason")
def key_quality(spark, sf_dir):
    return quality(_raw_keys(spark, sf_dir), "raw")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return duplicates(table(spark, sf_dir, "events"), "user_id")


@query("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders")
def parse_money(spark, sf_dir):
    text = F.regexp_replace(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), r"\.", ",")
    return table(spark, sf_dir, "orders").select("o_orderkey", X.money(text).alias("amount"))


@query("SELECT event_id, event_id % 6 < 4 AS flag FROM events")
def bool_from_text(spark, sf_dir):
    words = F.element_at(F.array(*[F.lit(x) for x in ("Sim", "S", "TRUE", "1", "no", "")]), (F.col("event_id") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", X.truth(words).alias("flag"))


@query(f"SELECT key, md5(CAST(to_json({{'k': key, 's': o_orderstatus, 'p': o_orderpriority}}) AS VARCHAR)) AS hash FROM {ORDERS_SQL}")
def content_hash(spark, sf_dir):
    doc = X.json_text(F.col("key").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    return order_keys(spark, sf_dir).select("key", X.content_hash(doc).alias("hash"))


@query(
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN md5(props) ELSE sha256('v' || event_id || '|' || event_type || '|' || props) END AS fingerprint FROM events"""
)
def source_fingerprint(spark, sf_dir):
    given = F.when(F.col("event_id") % 2 == 0, F.upper(F.md5("props"))).otherwise(F.concat(F.lit("v"), F.col("event_id").cast("string")))
    seed = F.concat(F.lit("v"), F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", X.source_fingerprint(given, seed, "event_type", "props").alias("fingerprint"))


@query(
    """SELECT event_id, CASE event_id % 10 WHEN 4 THEN '{"a":1.10' WHEN 5 THEN NULL WHEN 6 THEN NULL WHEN 7 THEN NULL ELSE substring(props, 1, length(props) - 1) END || ',"cnpj":"' || lpad(CAST(user_id AS VARCHAR), 14, '0') || '"}' AS payload FROM events"""
)
def json_inject_key(spark, sf_dir):
    wrapped = F.concat(F.lit('"'), F.regexp_replace("props", '"', '\\\\"'), F.lit('"'))
    kind = F.col("event_id") % 10
    text = F.when(kind == 4, '{"cnpj":{"old":[","]},"a":1.10}').when(kind == 5, F.concat("props", F.lit("}"))).when(kind == 6, '{"a":1,"a":2}').when(kind == 7, '"{"')
    text = text.when(kind % 2 == 0, F.col("props")).otherwise(wrapped)
    return table(spark, sf_dir, "events").select("event_id", X.inject_key(text, F.lpad(F.col("user_id").cast("string"), 14, "0")).alias("payload"))
