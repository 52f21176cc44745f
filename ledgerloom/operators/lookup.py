"""Batch lookup of keys, with the datasets that a request selects."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import is_valid_key, key_prefix, normalize_key, trimmed
from .bloom import only_near
from .relational import compose

IGNORED = {"e", "and"}


class UnknownDataset(ValueError):
    pass


def parse_selection(text: str | list[str] | None, available: list[str], base: str = "base") -> list[str]:
    """Dataset names of a request, in the order given: separated by commas or blanks, any case, repeats and joining
    words dropped. Nothing given means all. An unknown name is an error."""
    given = [text] if isinstance(text, str) else list(text or [])
    words = [w for t in given for w in re.split(r"[,\s]+", t.lower()) if w and w not in IGNORED]
    known = [base, *available]
    if unknown := [w for w in words if w not in known]:
        raise UnknownDataset(", ".join(sorted(set(unknown))))
    return list(dict.fromkeys(words)) or known


def lookup(keys: DataFrame, documents: DataFrame, modules: dict[str, DataFrame], selection: str | list[str] | None = None, raw: str = "raw", base: str = "base", prefix_length: int = 3, prefix_start: int = 1, level: str = "pattern", bloom: bool = True) -> DataFrame:
    """(raw, cnpj, outcome, value, one column a module) for each key asked for.

    documents: (prefix, key, value). outcome: ``invalid`` for text that is no key, ``not_found`` without a base document, else
    ``ok``. A selection without the base still needs it to exist, but its document isn't returned. Nothing runs while the plan is made: partitions of prefixes
    that nobody asks for are pruned when the query runs (at most as many names as there are prefixes are broadcast), and documents that a Bloom
    filter of the keys (``bloom``; of fixed size) knows nobody asks for aren't shuffled.
    """
    chosen = parse_selection(selection, sorted(modules), base)
    asked = keys.select(raw).withColumn("cnpj", normalize_key(trimmed(raw))).withColumn("__valid", F.coalesce(is_valid_key(raw, level), F.lit(False)))
    asked = asked.withColumn("__prefix", F.when(F.col("__valid"), key_prefix("cnpj", prefix_length, prefix_start)))
    docs = documents.select(F.col("prefix").alias("__prefix"), F.col("key").alias("cnpj"), "value", F.lit(True).alias("__there"))
    valid = asked.where("__valid")
    # Spark prunes by a side with a filter that it can take for selective: a comparison is one, a test of validity isn't
    wanted = valid.groupBy("__prefix").agg(F.count("*").alias("__n")).where("__n > 0").select("__prefix")
    docs = docs.join(F.broadcast(wanted), "__prefix", "left_semi")
    if bloom:
        docs = only_near(docs, "cnpj", valid, "cnpj")
    found = asked.join(docs, ["__prefix", "cnpj"], "left")
    found = compose(found, modules, [m for m in chosen if m != base])
    outcome = F.when(~F.col("__valid"), "invalid").when(F.col("__there").isNull(), "not_found").otherwise("ok")
    names = [m for m in chosen if m != base]
    value = [F.col("value")] if base in chosen else []
    only = lambda m: F.when(outcome == "ok", F.col(m)).alias(m)
    return found.select(raw, "cnpj", outcome.alias("outcome"), *value, *map(only, names))
