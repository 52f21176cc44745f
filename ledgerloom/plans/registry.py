"""The registry operators on the given tables: customers as companies, their orders as establishments, orders as works, events as carriers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..operators import changes, incremental, quality
from ..operators.documents import entity_documents as documents
from ..operators.documents import entity_rows
from ..operators.modules import carriers_module, works_module
from ..sources import readers, schemas, writers
from .base import query, scratch, table

TIME = "2024-01-31T00:00:00Z"


def _columns(names: str, given: dict[str, str]) -> list[str]:
    """SQL for a table of the registry: the columns that ``given`` has, null for all others."""
    return [f"CAST({given.get(n, 'NULL')} AS STRING) AS {n}" for n in names.split()]


#: Registry columns as SQL that Spark and DuckDB share; every other column is null.
_COMPANY = "reverse(lpad(CAST({0} AS STRING), 8, '0'))"
_DAY = {"spark": "date_format({0}, 'yyyyMMdd')", "duckdb": "strftime({0}, '%Y%m%d')"}


def _source(name: str, kind: str = "spark") -> dict[str, str]:
    day = lambda c: _DAY[kind].format(c)
    text = lambda c: f"CAST({c} AS STRING)"
    return {
        "estabelecimento": {
            "cnpj_basico": _COMPANY.format("o_custkey"),
            "cnpj_ordem": f"lpad({text('CAST(floor(o_orderkey / 100) AS BIGINT)')}, 4, '0')",
            "cnpj_dv": f"lpad({text('o_orderkey % 100')}, 2, '0')",
            "identificador_matriz_filial": text("o_orderkey % 3"),
            "nome_fantasia": "CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority END",
            "situacao_cadastral": "CASE o_orderstatus WHEN 'O' THEN '2' WHEN 'F' THEN '8' ELSE '77' END",
            "data_situacao_cadastral": day("o_orderdate"),
            "data_inicio_atividade": f"CASE WHEN o_orderkey % 7 = 0 THEN 'junk' WHEN o_orderkey % 7 < 6 THEN {day('o_orderdate')} END",
            "cnae_principal": text("o_orderkey % 1000"),
            "cnaes_secundarios": "CASE WHEN o_orderkey % 4 > 0 THEN concat(o_orderpriority, ',', o_orderstatus) END",
            "logradouro": "o_orderpriority",
            "uf": "CASE WHEN o_orderkey % 2 = 0 THEN 'SP' END",
            "codigo_municipio": text("o_orderkey % 30"),
            "ddd1": "CASE WHEN o_orderkey % 2 = 0 THEN '11' END",
            "telefone1": f"CASE WHEN o_orderkey % 4 = 0 THEN {text('o_orderkey')} END",
            "fax": "CASE WHEN o_orderkey % 3 = 0 THEN '4000' END",
        },
        "empresa": {
            "cnpj_basico": _COMPANY.format("c_custkey"),
            "razao_social": "c_name",
            "natureza_juridica": text("c_nationkey"),
            "capital_social": "CASE WHEN c_custkey % 3 > 0 THEN '1000,00' END",
            "porte_empresa": "CASE c_nationkey % 4 WHEN 0 THEN '01' WHEN 1 THEN '03' WHEN 2 THEN '09' END",
        },
        "simples": {"cnpj_basico": _COMPANY.format("c_custkey"), "opcao_simples": "'S'", "data_opcao_simples": "'20190701'", "opcao_mei": "'N'", "data_opcao_mei": "'0'"},
        "socio": {
            "cnpj_basico": _COMPANY.format("o_custkey"),
            "identificador_socio": text("l_suppkey % 5"),
            "nome_socio": f"concat('P', {text('l_partkey')})",
            "qualificacao_socio": text("l_suppkey % 7"),
            "data_entrada_sociedade": day("l_shipdate"),
            "faixa_etaria": text("l_partkey % 11"),
        },
    }[name]


_ROWS = {"estabelecimento": "orders", "empresa": "customer WHERE c_acctbal > 0", "simples": "customer WHERE c_custkey % 2 = 0", "socio": "lineitem JOIN orders ON l_orderkey = o_orderkey"}


def registry_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The tables that ``entity_documents`` reads; prefixes are the first three characters of a company's key."""
    for t in ("orders", "customer", "lineitem"):
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    out = {}
    for name, rows in _ROWS.items():
        made = spark.sql(f"SELECT {', '.join(_columns(schemas.REGISTRY[name][1], _source(name)))} FROM {rows}")
        out[name] = made.withColumn("cnpj_prefix", F.substring("cnpj_basico", 1, 3))
    code = lambda t, key, text: table(spark, sf_dir, t).select(F.col(key).cast("string").alias("codigo"), F.col(text).alias("descricao"))
    return out | {"natureza": code("nation", "n_nationkey", "n_name"), "municipio": code("nation", "n_nationkey", "n_name"), "qualificacao": code("region", "r_regionkey", "r_name")}


# the same documents as SQL ----------------------------------------------------------------------------------
def _case(c: str, names: dict[str, str], other: str) -> str:
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + f" ELSE {other} END"


def _date(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[0-9]{{8}}') THEN {c}[1:4] || '-' || {c}[5:6] || '-' || {c}[7:8] ELSE coalesce({c}, '') END"


def _table_sql(name: str) -> str:
    return f"(SELECT {', '.join(_columns(schemas.REGISTRY[name][1], _source(name, 'duckdb')))} FROM {_ROWS[name]})"


_STATUS = "lpad(situacao_cadastral, 2, '0')"
_PARTNER = (
    "{'nome_socio': coalesce(nome_socio, ''), 'cnpj_cpf_socio': coalesce(cnpj_cpf_socio, ''), 'qualificacao_socio': coalesce(r_name, ''), "
    f"'data_entrada_sociedade': {_date('data_entrada_sociedade')}, 'identificador_socio': {_case('identificador_socio', labels.PARTNER_TYPE, 'identificador_socio')}, "
    f"'faixa_etaria': {_case('faixa_etaria', labels.AGE_BAND, 'faixa_etaria')}}}"
)
_QSA_SQL = f"(SELECT cnpj_basico, list(p ORDER BY p) AS qsa FROM (SELECT cnpj_basico, {_PARTNER} AS p FROM {_table_sql('socio')} LEFT JOIN region ON qualificacao_socio = CAST(r_regionkey AS VARCHAR)) GROUP BY cnpj_basico)"
_PHONE = "CASE WHEN {0} IS NOT NULL OR {1} IS NOT NULL THEN {{'ddd': coalesce({0}, ''), 'numero': coalesce({1}, ''), 'is_fax': {2}}} END"


def _document_sql() -> str:
    plain = lambda *names: [(n, f"coalesce({n}, '')") for n in names]
    phones = ", ".join(_PHONE.format(*p) for p in (("ddd1", "telefone1", "false"), ("ddd2", "telefone2", "false"), ("ddd_fax", "fax", "true")))
    fields = [
        ("cnpj", "cnpj"),
        *plain("razao_social", "nome_fantasia"),
        ("situacao_cadastral", _case(_STATUS, labels.STATUS, "situacao_cadastral")),
        ("data_situacao_cadastral", _date("data_situacao_cadastral")),
        ("matriz_filial", _case("identificador_matriz_filial", labels.BRANCH, "identificador_matriz_filial")),
        ("data_inicio_atividade", _date("data_inicio_atividade")),
        *plain("cnae_principal"),
        ("cnaes_secundarios", "CASE WHEN coalesce(cnaes_secundarios, '') = '' THEN [] ELSE string_split(cnaes_secundarios, ',') END"),
        ("natureza_juridica", "coalesce(nature, '')"),
        *plain("tipo_logradouro", "logradouro", "numero", "complemento", "bairro", "cep", "uf"),
        ("municipio", "coalesce(city, '')"),
        ("email", "coalesce(correio_eletronico, '')"),
        ("telefones", f"list_filter([{phones}], lambda x: x IS NOT NULL)"),
        *plain("capital_social"),
        ("porte_empresa", _case("porte_empresa", labels.COMPANY_SIZE, "coalesce(porte_empresa, '')")),
        *plain("opcao_simples"),
        ("data_opcao_simples", _date("data_opcao_simples")),
        *plain("opcao_mei"),
        ("data_opcao_mei", _date("data_opcao_mei")),
        ("QSA", "coalesce(qsa, [])"),
    ]
    doc = ", ".join(f"'{n}': {e}" for n, e in fields)
    rows = f"""(SELECT e.*, m.* EXCLUDE (cnpj_basico), s.* EXCLUDE (cnpj_basico), q.qsa, n.n_name AS nature, c.n_name AS city, e.cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj
FROM {_table_sql('estabelecimento')} e LEFT JOIN {_table_sql('empresa')} m USING (cnpj_basico) LEFT JOIN {_table_sql('simples')} s USING (cnpj_basico) LEFT JOIN {_QSA_SQL} q USING (cnpj_basico)
LEFT JOIN nation n ON natureza_juridica = CAST(n.n_nationkey AS VARCHAR) LEFT JOIN nation c ON codigo_municipio = CAST(c.n_nationkey AS VARCHAR))"""
    return f"SELECT cnpj_basico[1:3] AS prefix, cnpj AS key, CAST(to_json({{{doc}}}) AS VARCHAR) AS value FROM {rows}"


@query(_document_sql())
def registry_documents(spark, sf_dir):
    """The documents of all establishments by the operator itself."""
    return documents(registry_tables(spark, sf_dir))


@query(_document_sql())
def bucketed_documents(spark, sf_dir):
    """The same documents from tables bucketed by (prefix, key): their joins need no exchange."""
    tables = registry_tables(spark, sf_dir)
    for t in incremental.LARGE:
        path = scratch(spark)
        name = "bucketed_" + path.rpartition("-")[2]
        writers.write_bucketed(tables[t].drop("cnpj_prefix"), name, "cnpj_basico", int(spark.conf.get("spark.sql.shuffle.partitions")), path=path)
        tables[t] = spark.table(name)
    return documents(tables)


@query(_document_sql())
def incremental_documents(spark, sf_dir):
    """Documents of an older state, brought up to date by making the touched prefixes again: equal to making all of them."""
    new = registry_tables(spark, sf_dir)
    touched = F.col("cnpj_prefix").isin("100", "210", "321")
    old = dict(new)
    old["empresa"] = new["empresa"].withColumn("razao_social", F.when(touched, F.concat(F.lit("old "), "razao_social")).otherwise(F.col("razao_social")))
    old["socio"] = new["socio"].where("cnpj_prefix <> '400' OR faixa_etaria <> '3'")
    old["estabelecimento"] = new["estabelecimento"].where("cnpj_prefix <> '501' OR uf = 'SP'")
    return incremental.regenerate(writers.keep_documents(documents(old), scratch(spark)), old, new)[0]


_FAULTS_SQL = """SELECT 'data_inicio_atividade:pattern' AS rule, count(*) AS n FROM d WHERE value->>'$.data_inicio_atividade' = 'junk'
UNION ALL SELECT 'data_opcao_mei:pattern' AS rule, count(*) AS n FROM d WHERE value->>'$.data_opcao_mei' = '0'
UNION ALL SELECT 'cnaes_secundarios[]:too_long' AS rule, count(*) AS n FROM d WHERE len(list_filter(CAST(value->'$.cnaes_secundarios' AS VARCHAR[]), lambda x: length(x) > 7)) > 0
UNION ALL SELECT 'cnpj:pattern' AS rule, count(*) AS n FROM d WHERE NOT regexp_full_match(key, '[A-Z0-9]{12}[0-9]{2}')"""


def _judged(spark, sf_dir) -> DataFrame:
    """The documents as they are written, but that a company's partners are held against the rules once and those that keep them all, save the last, left out."""
    return documents(registry_tables(spark, sf_dir), listed=lambda text: quality.thinned_list(text, quality.ENTITY_TREE.fields["QSA"]))


@query(f"WITH d AS ({_document_sql()}) SELECT * FROM ({_FAULTS_SQL}) WHERE n > 0")
def registry_conformance(spark, sf_dir):
    """Every rule of the published document schema on the documents as they are written."""
    return quality.json_report(_judged(spark, sf_dir), "value", quality.ENTITY_TREE, "QSA")


def _filled(node: quality.Node) -> str:
    """JSON text that breaks no rule of ``node``."""
    if node.kind == "object":
        return "{" + ",".join(f'"{name}":{_filled(inner)}' for name, inner in node.fields.items()) + "}"
    return {"list": lambda: f"[{_filled(node.item)}]", "flag": lambda: "true", "text": lambda: '""'}[node.kind]()


_CNO = _filled(quality.WORKS_TREE)
#: What is written before a property, by the last two digits of a document's key modulo 16, and the rules that break by it.
_WRONG = {
    1: ("capital_social", '"capital_social":5,"was":', ["capital_social:type"]),
    2: ("capital_social", '"capital_social":{"x":1},"was":', ["capital_social:type"]),
    3: ("telefones", '"telefones":[{"ddd":"1","numero":"2","is_fax":"yes"}],"was":', ["telefones[].is_fax:type"]),
    4: ("telefones", '"telefones":[{"ddd":"1","numero":"2","is_fax":true,"ramal":"3"}],"was":', ["telefones[].ramal:unknown"]),
    5: ("QSA", '"QSA":{},"was":', ["QSA:type"]),
    6: ("uf", '"cno":null,"rntrc":null,"uf":', []),
    7: ("uf", f'"cno":{_CNO},"uf":', []),
    8: ("uf", '"cno":' + _CNO.replace('"situacao":{', '"situacao":{"z":[1.0],', 1) + ',"uf":', ["cno.obras[].situacao.z:unknown"]),
    9: ("uf", '"rntrc":"none","uf":', ["rntrc:type"]),
    10: ("email", '"email":null,"was":', ["email:type"]),
    11: ("email", '"e-mail":', ["email:required"]),
    12: ("cnpj", '"cnpj":"x","cnpj":', None),
    13: ("cnpj", '"cnpj"', None),
    14: ("email", '"email":["a"],"was":', ["email:type"]),
}


def _altered_sql(value: str) -> str:
    """SQL that Spark and DuckDB share; class 15 gets a brace too many."""
    spoilt = " ".join(f"""WHEN {k} THEN replace(value, '"{name}":', '{text}')""" for k, (name, text, _) in _WRONG.items())
    return f"CASE CAST(substring(key, 13, 2) AS INT) % 16 {spoilt} WHEN 15 THEN concat(value, '}}') ELSE value END AS {value}"


def _typed_sql() -> str:
    k = "CAST(substring(key, 13, 2) AS INT) % 16"
    rows = [f"SELECT '{rule}' AS rule, count(*) AS n FROM d WHERE {k} = {i}" for i, (_, _, rules) in _WRONG.items() for rule in rules or ()]
    none = ", ".join(str(i) for i, (_, _, rules) in _WRONG.items() if rules is None)
    rows.append(f"SELECT ':no_object' AS rule, count(*) AS n FROM d WHERE {k} IN ({none}, 15)")
    base = _FAULTS_SQL.replace("FROM d WHERE", f"FROM d WHERE {k} NOT IN ({none}, 15) AND")
    return f"WITH d AS ({_document_sql()}) SELECT rule, CAST(sum(n) AS BIGINT) AS n FROM ({base} UNION ALL {' UNION ALL '.join(rows)}) GROUP BY rule HAVING sum(n) > 0"


@query(_typed_sql())
def typed_conformance(spark, sf_dir):
    """Documents with a fault of each kind: wrong types, names that the schema doesn't list two levels down, null and whole modules, free
    root names, null and missing properties, a property twice, a value cut off, text after the end."""
    return quality.json_report(_judged(spark, sf_dir).selectExpr(_altered_sql("value")), "value", quality.ENTITY_TREE, "QSA")


# modules ----------------------------------------------------------------------------------------------------
_WORKS = {
    "cno": "CAST(o_orderkey AS STRING)",
    "ni_responsavel": "CASE o_orderkey % 4 WHEN 0 THEN lpad(CAST(o_custkey AS STRING), 11, '0') WHEN 1 THEN concat('00.', lpad(CAST(o_custkey AS STRING), 10, '0'), '-00') ELSE lpad(CAST(o_custkey AS STRING), 14, '0') END",
    "nome": "o_orderpriority",
    "situacao": "CASE o_orderstatus WHEN 'O' THEN '02' WHEN 'F' THEN '15' ELSE '99' END",
    "qualificacao_responsavel": "CASE WHEN o_orderkey % 3 > 0 THEN '0057' END",
    "estado": "CASE WHEN o_orderkey % 2 = 0 THEN 'SP' END",
    "nome_municipio": "o_orderpriority",
    "area_total": "CAST(o_orderkey % 977 AS STRING)",
}
_LINKS = {"cno": "CAST(l_orderkey AS STRING)", "ni_responsavel": "lpad(CAST(l_suppkey AS STRING), 14, '0')"}
_CARRIERS = {
    "nome_transportador": "event_type",
    "numero_rntrc": "lpad(CAST(event_id AS STRING), 9, '0')",
    "cpfcnpjtransportador": "CASE WHEN event_id % 5 = 0 THEN lpad(CAST(user_id AS STRING), 11, '0') ELSE lpad(CAST(user_id AS STRING), 14, '0') END",
    "categoria_transportador": "CASE WHEN event_id % 2 = 0 THEN 'ETC' END",
    "equiparado": "CASE event_id % 3 WHEN 0 THEN 'Sim' WHEN 1 THEN 'no' END",
}


def _side(spark, sf_dir, name: str, columns: str, given: dict[str, str]) -> DataFrame:
    table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(f"SELECT {', '.join(_columns(columns, given))} FROM {name}")


def works(spark, sf_dir) -> DataFrame:
    return works_module(_side(spark, sf_dir, "orders", schemas.WORKS, _WORKS), _side(spark, sf_dir, "lineitem", schemas.LINKS, _LINKS), TIME)


def carriers(spark, sf_dir) -> DataFrame:
    return carriers_module(_side(spark, sf_dir, "events", schemas.CARRIERS, _CARRIERS), TIME)


def _six(payload: str, rows: str) -> str:
    return f"""SELECT cnpj, cnpj[1:3] AS cnpj_prefix, payload_json, md5(payload_json) AS content_hash, '{TIME}' AS source_updated_at, '{TIME}' AS module_updated_at
FROM (SELECT cnpj, CAST(to_json({payload}) AS VARCHAR) AS payload_json FROM {rows})"""


def _code(c: str, names: dict[str, str]) -> str:
    return f"{{'codigo': coalesce({c}, ''), 'descricao': {_case(c, names, chr(39) * 2)}}}"


def _works_sql() -> str:
    names = {"uf": "estado", "municipio": "nome_municipio", "numero": "numero_logradouro", "pais": "nome_pais"}
    order = (
        "cno nome nome_empresarial situacao data_inicio data_inicio_responsabilidade data_registro data_situacao cep uf codigo_municipio municipio tipo_logradouro "
        "logradouro numero bairro complemento unidade_medida area_total cno_vinculado codigo_pais pais qualificacao_responsavel codigo_localizacao"
    ).split()
    codes = {"situacao": labels.WORK_STATUS, "qualificacao_responsavel": labels.WORK_ROLE}
    work = ", ".join(f"'{n}': " + (_code(n, codes[n]) if n in codes else f"coalesce({names.get(n, n)}, '')") for n in order)
    key = "upper(regexp_replace(coalesce(ni_responsavel, ''), '[^0-9A-Za-z]', '', 'g'))"
    w = f"(SELECT {', '.join(_columns(schemas.WORKS, _WORKS))} FROM orders)"
    links = f"(SELECT {', '.join(_columns(schemas.LINKS, _LINKS))} FROM lineitem)"
    owners = f"(SELECT * FROM (SELECT {key} AS cnpj, cno FROM {w} UNION SELECT {key} AS cnpj, cno FROM {links}) WHERE length(cnpj) = 14)"
    rows = f"(SELECT cnpj, list({{{work}}} ORDER BY cno) AS obras FROM {owners} JOIN {w} USING (cno) GROUP BY cnpj)"
    return _six(f"{{'updated_at': '{TIME}', 'obras': obras}}", rows)


def _carriers_sql() -> str:
    c = f"(SELECT {', '.join(_columns(schemas.CARRIERS, _CARRIERS))} FROM events)"
    rows = f"(SELECT * FROM (SELECT cpfcnpjtransportador AS cnpj, *, row_number() OVER (PARTITION BY cpfcnpjtransportador ORDER BY numero_rntrc, nome_transportador) AS r FROM {c} WHERE length(cpfcnpjtransportador) = 14) WHERE r = 1)"
    text = lambda name, column=None: f"'{name}': coalesce({column or name}, '')"
    fields = [text("numero_rntrc"), text("nome", "nome_transportador"), text("categoria", "categoria_transportador"), text("situacao", "situacao_rntrc"), text("data_primeiro_cadastro"), text("data_situacao", "data_situacao_rntrc"), text("cep"), text("municipio"), text("uf"), "'equiparado': coalesce(lower(equiparado) IN ('sim', 's', 'true', '1'), false)"]
    return _six(f"{{'updated_at': '{TIME}', {', '.join(fields)}}}", rows)


@query(_works_sql())
def module_works(spark, sf_dir):
    return works(spark, sf_dir).drop("stable_hash")


@query(_carriers_sql())
def module_carriers(spark, sf_dir):
    return carriers(spark, sf_dir).drop("stable_hash")


#: As above, for the payloads of modules by the last digit of their key modulo 5; 3 is cut off.
_WRONG_WORKS = {1: ("updated_at", '"updated_at":7,"was":', ["updated_at:type", "was:unknown"]), 2: ("codigo", '"codigo":1,"x":', [f"obras[].{c}.{f}" for c in ("situacao", "qualificacao_responsavel") for f in ("codigo:type", "x:unknown")])}
_WRONG_CARRIERS = {1: ("equiparado", '"equiparado":"sim","was":', ["equiparado:type", "was:unknown"]), 2: ("uf", '"uf":"XYZ","cep2":', ["uf:too_long", "cep2:unknown"])}


def _spoilt(wrong: dict) -> str:
    spoilt = " ".join(f"""WHEN {k} THEN replace(payload_json, '"{name}":', '{text}')""" for k, (name, text, _) in wrong.items())
    return f"CASE CAST(substring(cnpj, 14, 1) AS INT) % 5 {spoilt} WHEN 3 THEN substring(payload_json, 1, 40) ELSE payload_json END AS value"


def _module_faults_sql() -> str:
    rows = []
    for name, wrong in (("w", _WRONG_WORKS), ("c", _WRONG_CARRIERS)):
        for k, rules in [*((k, rules) for k, (_, _, rules) in wrong.items()), (3, [":no_object"])]:
            rows += [f"SELECT '{rule}' AS rule, count(*) AS n FROM {name} WHERE CAST(substring(cnpj, 14, 1) AS INT) % 5 = {k}" for rule in rules]
    return f"WITH w AS ({_works_sql()}), c AS ({_carriers_sql()}) SELECT rule, CAST(sum(n) AS BIGINT) AS n FROM ({' UNION ALL '.join(rows)}) GROUP BY rule HAVING sum(n) > 0"


@query(_module_faults_sql())
def module_conformance(spark, sf_dir):
    """Payloads of both modules, some of them spoilt; the others break no rule."""
    found = [quality.json_report(rows.selectExpr(_spoilt(wrong)), "value", tree) for rows, wrong, tree in ((works(spark, sf_dir), _WRONG_WORKS, quality.WORKS_TREE), (carriers(spark, sf_dir), _WRONG_CARRIERS, quality.CARRIER_TREE))]
    return found[0].unionByName(found[1]).groupBy("rule").agg(F.sum("n").alias("n"))


# states, lookups, resources ---------------------------------------------------------------------------------
@query(f"SELECT 'rntrc' AS module, cnpj, content_hash FROM ({_carriers_sql()})")
def state_roundtrip(spark, sf_dir):
    """A state is empty before the first release, and written once the release is."""
    folder = scratch(spark)
    assert readers.read_state(spark, f"{folder}/version=1").isEmpty()
    rows = carriers(spark, sf_dir).select(F.lit("rntrc").alias("module"), "cnpj", "content_hash")
    path = writers.commit_state(lambda: writers.write_module(carriers(spark, sf_dir), f"{folder}/release"), rows, folder, "1")
    return readers.read_state(spark, path)


@query("SELECT CAST(n_nationkey AS VARCHAR) AS codigo, n_name AS descricao FROM nation")
def lookup_roundtrip(spark, sf_dir):
    path = scratch(spark)
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("codigo"), F.col("n_name").alias("descricao"))
    writers.write_lookup(nation, path)
    writers.write_lookup(nation.limit(0), path, "ignore")
    return readers.load_lookups(spark, {"pais": path})["pais"]


@query("SELECT CAST(max(event_id) AS VARCHAR) AS position, 'u' || max(event_id) AS url FROM events WHERE event_type <> 'error' AND event_id % 3 = 0")
def latest_resource(spark, sf_dir):
    """A catalog document for each event type, one of them a failed answer; the newest CSV of all."""
    csv = F.when(F.col("event_id") % 3 == 0, "csv").otherwise("PDF").alias("format")
    resource = F.struct(csv, F.concat(F.lit("u"), F.col("event_id").cast("string")).alias("url"), F.col("event_id").cast("string").alias("position"))
    answers = table(spark, sf_dir, "events").groupBy("event_type").agg(F.collect_list(resource).alias("resources"))
    text = F.to_json(F.struct((F.col("event_type") != "error").alias("success"), F.struct("resources").alias("result")))
    return readers.latest_resource(answers.select(text.alias("value"))).select("position", "url")


@query("SELECT count(*) FILTER (WHERE o_orderstatus = 'P') > 0 AS publish FROM orders")
def any_publish(spark, sf_dir):
    decisions = table(spark, sf_dir, "orders").groupBy("o_orderstatus").count().select(F.col("o_orderstatus").alias("module"), (F.col("o_orderstatus") == "P").alias("publish"))
    return changes.any_publish(decisions)
