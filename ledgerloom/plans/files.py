"""Sources from files that are first written out of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.modules import carriers_module, works_module
from ..sources import readers, records, schemas
from .base import query, scratch, table
from .registry import _CARRIERS, _LINKS, _WORKS, TIME, _carriers_sql, _side, _works_sql

_COMPANY_SQL = """(SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, CASE c_custkey % 3 WHEN 0 THEN c_name || chr(10) || '"' || c_mktsegment || '";' || chr(10) ELSE c_name END AS razao_social,
CAST(c_nationkey AS VARCHAR) AS natureza_juridica, '' AS qualificacao_responsavel, CASE WHEN c_custkey % 4 = 0 THEN chr(10) ELSE '1000,00' END AS capital_social, '"' AS porte_empresa, 'a;b' AS ente_federativo FROM customer)"""
_RAGGED = "c_custkey % 11 = 0"


def _company_file(spark, sf_dir) -> str:
    """Companies as a quoted file with line breaks, quotes and separators in values; every eleventh has a column too many."""
    c = table(spark, sf_dir, "customer")
    c.createOrReplaceTempView("customer")
    rows = spark.sql("SELECT * FROM " + _COMPANY_SQL.replace("VARCHAR", "STRING").replace("chr(10)", "'\\n'"))
    names = schemas.REGISTRY["empresa"][1].split()
    quoted = [F.concat(F.lit('"'), F.replace(n, F.lit('"'), F.lit('""')), F.lit('"')) for n in rows.columns[1:]]
    assert len(quoted) == len(names)
    line = F.concat(F.concat_ws(";", *quoted), F.when(F.expr(_RAGGED), ';"more"').otherwise(""))
    path = scratch(spark)
    rows.select(line.alias("value")).write.option("lineSep", "\n").text(path)
    return path


@query(f"SELECT * EXCLUDE (c_custkey) FROM {_COMPANY_SQL} WHERE NOT {_RAGGED}")
def csv_registry(spark, sf_dir):
    """Rows of a file whose values hold line breaks, read by splits."""
    names = ["cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel", "capital_social", "porte_empresa", "ente_federativo"]
    good, _ = readers.registry_records(spark, _company_file(spark, sf_dir), "empresa", "*")
    return good.toDF(*names).select(*[F.coalesce(n, F.lit("")).alias(n) for n in names])


@query(f"SELECT 'columns' AS reason, count(*) AS n, (SELECT count(*) FROM customer) AS lines FROM customer WHERE {_RAGGED} HAVING count(*) > 0")
def csv_rejected(spark, sf_dir):
    """What was rejected and why; good and rejected records are all that were written."""
    good, bad = readers.registry_records(spark, _company_file(spark, sf_dir), "empresa", "*")
    found = records.count_rejected(bad).groupBy("reason").agg(F.sum("n").alias("n"))
    total = good.select(F.lit(1).alias("x")).unionByName(bad.select(F.lit(1).alias("x"))).agg(F.count("*").alias("lines"))
    return found.join(F.broadcast(total))


def _written_csv(df, sep: str) -> str:
    path = scratch(df.sparkSession)
    df.write.options(header=True, sep=sep, quoteAll=True, escape='"', emptyValue="", nullValue="").csv(path)
    return path


@query(_works_sql())
def files_works(spark, sf_dir):
    """The module of works from its two files."""
    read = readers.read_works_csv(spark, _written_csv(_side(spark, sf_dir, "orders", schemas.WORKS, _WORKS), ","))
    links = readers.read_links_csv(spark, _written_csv(_side(spark, sf_dir, "lineitem", schemas.LINKS, _LINKS), ","))
    return works_module(read, links, TIME).drop("stable_hash")


@query(_carriers_sql())
def files_carriers(spark, sf_dir):
    """The module of carriers from its file."""
    read = readers.read_carriers_csv(spark, _written_csv(_side(spark, sf_dir, "events", schemas.CARRIERS, _CARRIERS), ";"))
    return carriers_module(read, TIME).drop("stable_hash")
