"""From raw documents to token ids: quality, toxicity, near-duplicates, source mix, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame: the columns of ``docs`` for the rows that it keeps
(the mix repeats rows), and the last one the tokens. Empty tables pass through; extra columns are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import byte_bpe, mixing, quality, simhash, toxicity
from ledgerloom.llm.common import own_prefix, rows_of, table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the quality rules. Equal rows share their verdict, null texts and texts without ten words go, and a null language or source
    is one of its own. Texts are judged whole, however long. Rows at the very limit stay."""
    verdicts = quality.quality_rules(docs)
    out = verdicts.where("NOT kept").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.col("lang").alias("of_lang"), F.col("source").alias("of_source")).distinct()
    same = docs["doc_id"].eqNullSafe(out["id"]) & (F.xxhash64(docs["text"]) == out["hash"]) & docs["lang"].eqNullSafe(out["of_lang"]) & docs["source"].eqNullSafe(out["of_source"])
    return docs.join(out, same, "left_anti")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the model trained on the labelled ones doesn't find toxic. Null and empty texts stay, repeated rows share their fate, very long texts
    are scored whole, and P(toxic) of exactly the limit goes. Without labels all rows stay."""
    model = toxicity.model_for(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.severity(model)(docs["text"])["p_toxic"] < toxicity.LIMIT)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component: that of the smallest doc_id, and of its texts that of the least hash.

    Components whose doc_ids are all null keep a row for each fingerprint. Null and blank texts form one component. Of repeated rows one stays.
    """
    mark = own_prefix(docs)
    groups = written(simhash.simhash_groups(docs).where("kept"))
    name = F.coalesce(F.col("component_id").cast("string"), F.col("fingerprint"))
    counts = groups.groupBy(name.alias("g"), "doc_id", "text_hash").agg(F.count("*").alias("n"))
    best = counts.groupBy("g").agg(F.min(F.struct("text_hash", "doc_id", "n")).alias("k"))
    return rows_of(docs, best.select("k.doc_id", "k.text_hash", F.col("k.n").alias(mark + "n")), mark + "n").select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it. Null texts and texts without words count as empty, and are taken or left like others. Repeated
    rows are drawn one by one; what is taken of them comes from one of them."""
    mark = own_prefix(docs)
    n, copies, k = (mark + x for x in ("n", "copies", "k"))
    taken = mixing.mix(docs).groupBy("doc_id", "text_hash").agg(F.count("*").alias(n), F.sum("copies").cast("int").alias(copies))
    found = rows_of(docs, written(taken.where(F.col(copies) > 0)), n)
    return found.withColumn(k, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, ids_sha256, decoded_sha256) of each row. A null text has no ids; repeated rows have the same ones."""
    encoded = byte_bpe.encode_decode(docs, public_tokenizers.path(byte_bpe.RANKS), ["doc_id", "lang", "source"])
    return byte_bpe.digests(encoded, "lang", "source", "ids")


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("SimHash near-duplicates", near_duplicate_stage),
    ("source mix", mixing_stage),
    ("byte-level BPE", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained models, the cube method and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None
