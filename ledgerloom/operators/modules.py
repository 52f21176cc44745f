"""Side datasets, each reduced to one row a key with the same six columns."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.exprs import KEY_LENGTH, clean_identifier, content_hash, json_objects, json_text, json_values, key_prefix, label, or_empty, truth
from .relational import first_per_key, nest_children


@dataclass(frozen=True)
class Descriptor:
    """What a module is called, how often it is refreshed, and the version of its payload."""

    key: str
    json_property: str
    refresh_hours: float = 24.0
    schema_version: str = "1"

    def __post_init__(self):
        for name in (self.key, self.json_property):
            if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
                raise ValueError(f"{name!r} is no identifier")
        if self.refresh_hours <= 0:
            raise ValueError("the refresh interval must be positive")
        if not self.schema_version.strip():
            raise ValueError("the schema version is empty")


@dataclass(frozen=True)
class Context:
    """Where a module reads from and the time that its rows carry."""

    updated_at: str
    inputs: dict[str, DataFrame] = field(default_factory=dict)
    prefix_length: int = 3


class Module(Protocol):
    descriptor: Descriptor

    def build(self, spark: SparkSession, context: Context) -> DataFrame: ...


def module_rows(df: DataFrame, payload: list[Column] | Column, updated_at: str, key: str = "cnpj", prefix_length: int = 3, prefix_start: int = 1) -> DataFrame:
    """The six columns, and ``stable_hash``: the hash of the payload without its time, which a mere refresh leaves as it is. ``payload``: its fields, or the
    text of them as members of a JSON object."""
    time = F.lit(updated_at)
    if isinstance(payload, list):
        whole, stable = json_text(time.alias("updated_at"), *payload), json_text(*payload)
    else:
        df = df.select(key, payload.alias("__members"))
        head = F.expr("left(__head, length(__head) - 1)")
        df = df.withColumn("__head", json_text(time.alias("updated_at")))
        whole, stable = F.concat(head, F.lit(","), F.col("__members"), F.lit("}")), F.concat(F.lit("{"), F.col("__members"), F.lit("}"))
    out = df.select(F.col(key).alias("cnpj"), key_prefix(key, prefix_length, prefix_start).alias("cnpj_prefix"), whole.alias("payload_json"), F.md5(stable).alias("stable_hash"))
    return out.select("cnpj", "cnpj_prefix", "payload_json", content_hash("payload_json").alias("content_hash"), time.alias("source_updated_at"), time.alias("module_updated_at"), "stable_hash")


def _owners(df: DataFrame) -> DataFrame:
    """(cnpj, cno) where the responsible's id is a full key; keys are upper-cased so that they join."""
    key = F.upper(clean_identifier("ni_responsavel"))
    return df.select(key.alias("cnpj"), F.col("cno").alias("cno")).where(F.length("cnpj") == KEY_LENGTH)


#: Fields of a work as they are published: the name, the name and its column, or a code's name and its list.
_WORK = (
    *("cno", "nome", "nome_empresarial", ("situacao", labels.WORK_STATUS), "data_inicio", "data_inicio_responsabilidade", "data_registro", "data_situacao", "cep"),
    *(("uf", "estado"), "codigo_municipio", ("municipio", "nome_municipio"), "tipo_logradouro", "logradouro", ("numero", "numero_logradouro"), "bairro", "complemento"),
    *("unidade_medida", "area_total", "cno_vinculado", "codigo_pais", ("pais", "nome_pais"), ("qualificacao_responsavel", labels.WORK_ROLE), "codigo_localizacao"),
)


def works_module(works: DataFrame, links: DataFrame, updated_at: str, prefix_length: int = 3) -> DataFrame:
    """Construction works by responsible company: from the works themselves and from links to known works.

    Each work's values are escaped once, and only they are moved: the names are put to them when a company's works are together. Works of a company that
    share their number are ordered by these values.
    """
    # owners are made distinct where they meet the works, so they are moved once
    owners = _owners(works).unionByName(_owners(links)).repartition("cno").distinct()
    names, values = [], []
    for field_ in _WORK:
        name, source = (field_, field_) if isinstance(field_, str) else field_
        if isinstance(source, str):
            names.append(name)
            values.append(or_empty(source))
        else:
            names.append((name, "codigo", "descricao"))
            values += [or_empty(name), label(name, source, "blank")]
    joined = owners.join(works.select("cno", json_values(*values).alias("obra")), "cno")
    nested = nest_children(joined, ["cnpj"], ["obra"], "obras", ["cno"])
    texts = F.transform("obras", lambda x: x["obra"])
    return module_rows(nested, F.concat(F.lit('"obras":'), json_objects(texts, names)), updated_at, prefix_length=prefix_length)


def carriers_module(carriers: DataFrame, updated_at: str, prefix_length: int = 3) -> DataFrame:
    """Road carriers by company: the first registration in order of number, then name. Personal ids are left out."""
    keyed = carriers.withColumn("cnpj", F.upper(clean_identifier("cpfcnpjtransportador"))).where(F.length("cnpj") == KEY_LENGTH)
    one = first_per_key(keyed, ["cnpj"], ["numero_rntrc", "nome_transportador"])
    payload = [
        or_empty("numero_rntrc").alias("numero_rntrc"),
        or_empty("nome_transportador").alias("nome"),
        or_empty("categoria_transportador").alias("categoria"),
        or_empty("situacao_rntrc").alias("situacao"),
        or_empty("data_primeiro_cadastro").alias("data_primeiro_cadastro"),
        or_empty("data_situacao_rntrc").alias("data_situacao"),
        *[or_empty(c).alias(c) for c in ("cep", "municipio", "uf")],
        truth("equiparado").alias("equiparado"),
    ]
    return module_rows(one, payload, updated_at, prefix_length=prefix_length)


class WorksModule:
    descriptor = Descriptor("cno", "cno", schema_version="2")

    def build(self, spark: SparkSession, context: Context) -> DataFrame:
        return works_module(context.inputs["works"], context.inputs["links"], context.updated_at, context.prefix_length)


class CarriersModule:
    descriptor = Descriptor("rntrc", "rntrc")

    def build(self, spark: SparkSession, context: Context) -> DataFrame:
        return carriers_module(context.inputs["carriers"], context.updated_at, context.prefix_length)


MODULES = (WorksModule, CarriersModule)


def enabled_modules(settings: dict[str, dict], known=MODULES) -> dict[str, Module]:
    """The modules that a configuration enables, by key. ``settings``: key -> {enabled, refresh_hours}; a module that isn't named is on.

    Unknown keys, and two modules of one key or JSON property, are errors.
    """
    every = {m.descriptor.key: m for m in known}
    if len(every) < len(known) or len({m.descriptor.json_property for m in known}) < len(known):
        raise ValueError("two modules share a key or a property")
    if unknown := sorted(set(settings) - set(every)):
        raise ValueError(f"unknown modules: {', '.join(unknown)}")
    out = {}
    for key, module in every.items():
        mine = settings.get(key, {})
        if mine.get("enabled", True):
            out[key] = module()
            out[key].descriptor = replace(module.descriptor, refresh_hours=mine.get("refresh_hours", module.descriptor.refresh_hours))
    return out
