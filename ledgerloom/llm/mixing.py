"""Mixing sources to target weights by the cube method.

Each document is taken target/source-size times in expectation: the whole part of that rate surely, the
fraction by balanced sampling. A flight moves the fractions of three documents at a time along the one
direction that changes neither the sum of fractions nor the sum of fraction times size, until one of them is
0 or 1. Chunks of a source fly in parallel and leave two fractions at most each; these fly again in larger groups, level
by level, until two remain for a source: the landing rounds those to the nearest token and document totals, and
mends what that misses by exchanging a few documents of the last group.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, table, written

#: Weights of the sources in order of name, repeating; the share of all sizes to take; the most a source or document repeats.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Documents in a chunk of the first flight, and chunks whose rest flies together on the next level.
CHUNK, FAN = 2000, 500
#: Equal rows that are numbered together.
RUN = 1 << 16
SEED = 42
_CLOSE = 1e-9


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all sizes; a target stops at
    ``most`` times its source and the excess is shared again by weight. That ends where every open source gets
    the same amount for its weight: the level found by taking sources in order of size for weight. One task orders all sources,
    so there may be millions of them (as of hosts) but not as many as documents.
    """
    everyone = Window.partitionBy()  # one row a source
    rank = F.row_number().over(everyone.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("cap", most * F.col("source_size"))
    s = s.withColumn("all", share * F.sum("source_size").over(everyone))
    first = everyone.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("all") - F.coalesce(F.sum("cap").over(first), F.lit(0.0))
    level = left / (F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(first), F.lit(0.0)))
    s = s.withColumn("level", level).withColumn("open", F.col("cap") / F.col("w") >= F.col("level"))
    water = F.coalesce(F.max(F.when(F.col("open"), F.col("level"))).over(everyone), F.lit(float("inf")))
    return s.select("source", "source_size", F.least(F.col("cap"), F.col("w") * water).cast("double").alias("target"))


def flight(fractions: np.ndarray, sizes: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Fractions after the flight: at most two lie strictly between 0 and 1; the sums of p and of p * size stay.

    ``draws``: a uniform number a document, which decides the direction of the step that begins with it.
    """
    p = np.clip(fractions.astype(float), 0.0, 1.0).tolist()
    x, u = sizes.astype(float).tolist(), draws.tolist()
    held: list[int] = []
    for i in range(len(p)):
        if p[i] < _CLOSE or p[i] > 1 - _CLOSE:
            p[i] = round(p[i])
            continue
        held.append(i)
        if len(held) < 3:
            continue
        a, b, c = held
        d = (x[c] - x[b], x[a] - x[c], x[b] - x[a])  # orthogonal to (1, 1, 1) and to the sizes
        if d == (0.0, 0.0, 0.0):
            d = (1.0, -1.0, 0.0)
        up = min((1 - p[k]) / v if v > 0 else p[k] / -v for k, v in zip(held, d) if v)
        down = min(p[k] / v if v > 0 else (1 - p[k]) / -v for k, v in zip(held, d) if v)
        step = up if u[i] * (up + down) < down else -down  # keeps every expectation
        for k, v in zip(held, d):
            p[k] += step * v
            if p[k] < _CLOSE or p[k] > 1 - _CLOSE:
                p[k] = round(p[k])
        held = [k for k in held if 0 < p[k] < 1]
    return np.array(p)


def landing(fractions: np.ndarray, sizes: np.ndarray, tokens: float, swaps: int = 4) -> np.ndarray:
    """Round the last fractions so that the taken sizes come nearest to ``tokens``.

    First the corner that misses the token total least, then the document total; then up to ``swaps`` exchanges
    of a taken document for one that isn't, of the size difference that helps most, which keep the document total.
    """
    p, open_ = fractions.copy(), np.nonzero((fractions > 0) & (fractions < 1))[0]
    if len(open_):
        base = tokens - (p * sizes).sum() + (p[open_] * sizes[open_]).sum()
        corners = [np.array([c >> k & 1 for k in range(len(open_))], float) for c in range(1 << len(open_))]
        p[open_] = min(corners, key=lambda c: (abs((c * sizes[open_]).sum() - base), abs((c - fractions[open_]).sum()), c.tolist()))
    for _ in range(swaps):
        lack = tokens - (p * sizes).sum()
        out, into = np.nonzero(p == 1)[0], np.nonzero(p == 0)[0]
        if not len(out) or not len(into):
            break
        into = into[np.argsort(sizes[into], kind="stable")]
        want = sizes[out] + lack
        spot = np.clip(np.searchsorted(sizes[into], want), 1, max(1, len(into) - 1))
        best = min(((abs(sizes[into[j]] - w), i, into[j]) for at in (spot - 1, np.minimum(spot, len(into) - 1)) for i, j, w in zip(out.tolist(), at.tolist(), want.tolist())), default=None)
        if best is None or best[0] >= abs(lack) - _CLOSE:
            break
        p[best[1]], p[best[2]] = 0.0, 1.0
    return p


def _draw(key: str) -> np.random.Generator:
    return np.random.default_rng(int.from_bytes(hashlib.blake2b(f"{SEED} {key}".encode(), digest_size=8).digest(), "little"))


def balanced(rows: DataFrame, fan: int = FAN) -> DataFrame:
    """``rows`` (g: group, chunks: of the group, h: a hash of the document, size, p, more), a scratch table, with p
    rounded to 0 or 1 by the cube method."""

    def fly(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "size", "p"], kind="stable").reset_index(drop=True)
        size, p = pdf["size"].to_numpy(float), pdf["p"].to_numpy(float)
        draws = _draw(f"{pdf['g'].iloc[0]} {pdf['at'].iloc[0]} {pdf['level'].iloc[0]}").random(len(pdf))
        flown = flight(p, size, draws)
        alone = pdf["chunks"].iloc[0] <= 1  # the whole rest of its group
        return pdf.assign(p=landing(flown, size, float((p * size).sum())) if alone else flown)

    now = rows.withColumn("at", F.pmod("h", "chunks")).withColumn("level", F.lit(0))
    chunks = rows.agg(F.max("chunks")).first()[0] or 1
    done, level = None, 0
    while True:
        now = written(now.groupBy("g", "at").applyInPandas(fly, now.schema))
        fixed = now.where("p = 0 OR p = 1")
        done = fixed if done is None else done.unionByName(fixed)
        if chunks <= 1:
            return done.drop("chunks", "at", "level")
        level, chunks = level + 1, -(-chunks // fan)
        now = now.where("p > 0 AND p < 1").withColumn("chunks", F.ceil(F.col("chunks") / fan))
        now = now.withColumn("at", F.floor(F.col("at") / fan)).withColumn("level", F.lit(level))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, text_hash, source, size, source_size, target, copies, taken) for each row of ``docs`` (doc_id, text, source).

    size: words of the whole text (null: 0). copies: 0, 1 or 2; taken = copies * size. Null is a source of its own,
    last. A source whose texts hold no word has target 0 and copies 0. Repeated rows are separate units of the
    sample, dealt to the chunks in turn. The draws depend on doc_id, text and chunk alone, so reruns agree. An empty table gives no rows.
    Very long texts are units like others, so a source's words come within about one of its documents of the target.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = written(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "source", size.alias("size")))
    sources = written(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.ceil(F.count("*") / chunk).alias("chunks")))
    targets = source_targets(sources.drop("chunks"), weights, share, most).withColumnRenamed("source", "t")
    t = targets.join(sources, F.col("t").eqNullSafe(F.col("source"))).select(F.col("t").alias("s"), targets["source_size"], "target", "chunks")
    t = written(t)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(F.lit(0.0))
    rows = sized.join(t, sized["source"].eqNullSafe(t["s"])).drop("s").withColumn("rate", rate)
    rows = rows.withColumn("whole", F.floor("rate")).withColumn("p", F.col("rate") - F.col("whole"))
    g = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))
    # equal rows are counted and numbered, so that they are dealt to chunks in turn; two steps keep the lists of numbers short
    equal = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    runs = equal.withColumn("run", F.explode(F.expr(f"sequence(0L, (n - 1) div {RUN})")))
    rows = runs.withColumn("k", F.explode(F.expr(f"sequence(run * {RUN}, least((run + 1) * {RUN}, n) - 1)"))).drop("n", "run")
    rows = rows.withColumn("g", g).withColumn("h", F.xxhash64("doc_id", "text_hash").bitwiseXOR(F.col("k"))).drop("k")
    copies = (F.col("whole") + F.col("p")).cast("int")
    out = balanced(written(rows)).withColumn("copies", copies)
    return out.select("doc_id", "text_hash", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("text_hash")
