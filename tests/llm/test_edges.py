"""Ties at limits, clashing names in the side table and very long texts."""

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import mixing, quality, toxicity

WORDS = [f"w{i}" for i in range(400)]


def test_a_distance_of_exactly_the_limit_is_kept(spark, monkeypatch):
    rng = np.random.default_rng(41)
    rows = [(i, " ".join(rng.choice(WORDS, int(n))), "en", "s") for i, n in enumerate(rng.integers(30, 300, 150))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    limit = quality.chi2_quantile(1 - quality.TAIL, quality.P)
    for distance, kept in ((limit, True), (float(np.nextafter(limit, np.inf)), False)):
        monkeypatch.setattr(quality, "_distance", lambda: F.lit(distance))
        assert {r.kept for r in quality.quality_rules(df).where("NOT base_failed").collect()} == {kept}


def test_a_probability_of_exactly_the_limit_is_toxic(spark):
    docs = spark.createDataFrame([(1, "any text"), (2, None)], "doc_id long, text string")
    odds = float(np.log(toxicity.LIMIT / (1 - toxicity.LIMIT)))
    at = lambda t: {r.toxic for r in toxicity.score(docs, toxicity.Model({}, np.zeros(0), np.array([t, t + 1, t + 2]))).collect()}
    assert at(-odds) == {True} and at(-odds + 1e-9) == {False}


def test_labels_with_clashing_names(spark):
    rng = np.random.default_rng(42)
    rows = [(i, " ".join(rng.choice(WORDS, 40)) + (" vile nasty slur" if i % 3 == 0 else ""), 1, "x", 0.5) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int, fold string, severity double")
    plain = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    clash = plain.select("*", F.lit("other").alias("text"), F.lit(1).alias("fold"), F.lit(2).alias("h"), F.lit("w").alias("word"), F.lit(None).cast("string").alias("source"))
    a, b = ({r.doc_id: r.toxic for r in toxicity.toxicity(d, x).collect()} for d, x in ((docs.select("doc_id", "text"), plain), (docs, clash)))
    assert a == b == {i: i % 3 == 0 for i in range(600)}


def test_a_very_long_text_in_the_mix(spark):
    rows = [(1, "w " * 400_000, "long")] + [(i, "a b c", "short") for i in range(2, 400)] + [(400, "w " * 1000, "short")]
    got = {r.doc_id: r for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert len(got) == 400 and got[1].size == got[1].source_size == 400_000
    assert got[1].taken in (0, 400_000, 800_000) and abs(got[1].taken - got[1].target) <= 400_000
    short = [r for i, r in got.items() if i > 1]
    assert abs(sum(r.taken for r in short) - short[0].target) <= 1000
