"""Quality rules: base limits, then minimum-covariance-determinant outliers per language and source.

The estimate begins from three robust starts for each group. The concentration steps run over all rows: one grouped pass a step gives, for each
group, start and narrow band of distance, the count and the moments; the bands that hold the nearest share of the rows are
added up, and their mean and covariance are the next estimate. The start of least determinant goes on, and the estimate of least determinant
stays. No group is gathered in a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE_BYTES, table, written

WINDOW, MIN_WORDS, REPEAT_PERCENT = 5, 10, 20
SYMBOLS = b"#*$%&|<>"
#: Share of a group's rows that the estimate is taken from; concentration steps of all starts, and of the best one after them; rows a group needs
#: for its own estimate.
SHARE, FIRST_STEPS, STEPS, LEAST_ROWS = 0.75, 2, 4, 100
STARTS = ("median deviations", "hyperbolic tangents", "spatial signs")
#: A row is an outlier if its squared distance is beyond this upper tail of the chi-square distribution.
TAIL = 1e-9
#: The transformed statistics, and the least standard deviation of each: statistics that are constant in most of
#: a group (no symbols, no repeats) would else make any other value infinitely far. A mean word length is known
#: only so well from a short text, and a repeated title is no fault. Each floor is small enough for its statistic to
#: reach the limit of ``TAIL`` alone, even where the base rules bound it.
VECTOR = {
    "z_words": ("ln(n_words)", 0.3),
    "z_length": ("ln(word_chars / n_words)", 0.12),
    "z_symbols": ("ln(1 + 100 * n_symbols / n_words)", 0.4),
    "z_lines": ("ln(1 + 100 * n_dup_lines / n_words)", 0.4),
    "z_repeats": ("ln(1 + 100 * n_repeat_words / n_words)", 0.4),
}
COLUMNS = list(VECTOR)
P = len(COLUMNS)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def repeat_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a window of ``size`` words which occurs twice or more, first occurrence included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    first: dict[bytes, int] = {}
    ids = np.fromiter(map(first.setdefault, words, count()), np.uint64, len(words))
    mixed = np.zeros(n, np.uint64)
    for i in range(size):
        mixed += ids[i : i + n] * _MIX[i % len(_MIX)]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return 0
    maybe = np.union1d(order[1:][same], order[:-1][same])
    _, which, times = np.unique(ids[maybe[:, None] + np.arange(size)], axis=0, return_inverse=True, return_counts=True)
    starts = maybe[times[which.ravel()] > 1]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return int((np.cumsum(edge) > 0).sum())


def statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text; all zero for null or blank."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    blanks = len(raw) - len(raw.translate(None, SPACE_BYTES))
    lines = [x for x in raw.split(b"\n") if x.strip(SPACE_BYTES)]
    return len(words), len(text) - blanks, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(words)


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, text_hash) plus the counts of ``statistics`` and base_failed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = np.array([statistics(t) for t in b["text"]], np.int64).reshape(-1, 5)
            yield b.drop(columns="text").assign(**dict(zip(names, found.T)))

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", "lang", "source"))
    wanted = docs.select("doc_id", "lang", "source", F.xxhash64("text").alias("text_hash"), "text")
    counts = wanted.mapInPandas(run, kinds + "".join(f", {c} long" for c in ("text_hash", *names)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return counts.withColumn("base_failed", failed)


def chi2_cdf(x: float, dof: int) -> float:
    """Series of the regularised lower incomplete gamma function."""
    a, y = dof / 2, x / 2
    if y <= 0:
        return 0.0
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= y / k
        total += term
    return total * math.exp(a * math.log(y) - y - math.lgamma(a))


def chi2_quantile(q: float, dof: int) -> float:
    low, high = 0.0, 10.0 * dof + 400
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dof) < q else (low, mid)
    return high


def _distance() -> Column:
    """Squared Mahalanobis distance from ``centre``; ``root`` holds the rows of a triangular root of the precision matrix."""
    parts = ["(" + " + ".join(f"root[{i * P + j}] * ({COLUMNS[j]} - centre[{j}])" for j in range(i, P)) + ")" for i in range(P)]
    return F.expr(" + ".join(f"{x} * {x}" for x in parts))


def _roots(covariances: np.ndarray) -> tuple[list[list[float]], list[float]]:
    """Rows of triangular roots of the precision matrices, and logarithms of the determinants."""
    if not len(covariances):
        return [], []
    low = np.linalg.cholesky(np.linalg.inv(covariances))
    return low.transpose(0, 2, 1).reshape(-1, P * P).tolist(), np.linalg.slogdet(covariances)[1].tolist()


def _estimates(moments: DataFrame, scale: float) -> DataFrame:
    """One row a group and start (g, start, n, s: sums, c: sums of products) -> (g, start, centre, root, logdet): mean, and precision root and
    determinant of the regularised covariance."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n = b["n"].to_numpy(float)
            mean = np.array(b["s"].tolist()).reshape(-1, P) / n[:, None]
            cov = np.array(b["c"].tolist()).reshape(-1, P, P) / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
            root, logdet = _roots(scale * (cov + cov.transpose(0, 2, 1)) / 2 + FLOOR)
            yield pd.DataFrame({"g": b["g"], "start": b["start"], "centre": mean.tolist(), "root": root, "logdet": logdet})

    return written(moments.mapInPandas(run, PARAMETERS))


FLOOR = np.diag([least**2 for _, least in VECTOR.values()])
PARAMETERS = "g string, start int, centre array<double>, root array<double>, logdet double"


def _sums(values: list[str], name: str) -> Column:
    return F.expr(f"array({', '.join(f'sum({v})' for v in values)})").alias(name)


def _moments(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy("g", "start", *by).agg(F.count("*").alias("n"), _sums(COLUMNS, "s"), _sums([f"{a} * {b}" for a in COLUMNS for b in COLUMNS], "c"))


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy("g", "start").agg(F.sum("n").alias("n"), _sums([f"s[{i}]" for i in range(P)], "s"), _sums([f"c[{i}]" for i in range(P * P)], "c"))


def _starts(rows: DataFrame) -> DataFrame:
    """The starts (g, start, centre, root, logdet) of each group: its medians with, in turn, the scaled median deviations alone, and these with the
    correlations of the hyperbolic tangents and of the spatial signs of the scaled rows. Medians are taken over bands of 1/64."""
    band = lambda c: F.floor(c * 64)

    def middle(long: DataFrame) -> DataFrame:
        """Median of v for each (g, k) from counts of bands."""
        counts = long.groupBy("g", "k", band(F.col("v")).alias("at")).agg(F.count("*").alias("n"))
        w = Window.partitionBy("g", "k")
        run = counts.withColumn("upto", F.sum("n").over(w.orderBy("at"))).withColumn("all", F.sum("n").over(w))
        return run.where("2 * upto >= all").groupBy("g", "k").agg((F.min("at") / 64 + 1 / 128).alias("mid"))

    long = rows.select("g", F.posexplode(F.array(*COLUMNS)).alias("k", "v"))
    mid = written(middle(long))
    off = middle(long.join(mid, ["g", "k"]).select("g", "k", F.abs(F.col("v") - F.col("mid")).alias("v"))).withColumnRenamed("mid", "off")
    least = F.get(F.array(*[F.lit(x) for _, x in VECTOR.values()]), F.col("k"))
    width = F.sqrt(F.pow(1.4826 * F.col("off"), F.lit(2)) + F.pow(least, F.lit(2))).alias("width")
    scaled = mid.join(off, ["g", "k"]).select("g", F.struct("k", "mid", width).alias("m")).groupBy("g").agg(F.array_sort(F.collect_list("m")).alias("m"))
    scaled = written(scaled.select("g", F.transform("m", lambda x: x["mid"]).alias("centre"), F.transform("m", lambda x: x["width"]).alias("width")))
    z = F.array(*[(F.col(c) - F.col("centre")[i]) / F.col("width")[i] for i, c in enumerate(COLUMNS)])
    seen = rows.join(scaled, "g").select("g", z.alias("z")).withColumn("r", F.sqrt(F.aggregate("z", F.lit(1e-12), lambda a, x: a + x * x)))
    tangents, signs = [f"tanh(z[{i}])" for i in range(P)], [f"(z[{i}] / r)" for i in range(P)]
    sums = written(seen.groupBy("g").agg(*[_sums([f"{a} * {b}" for a in v for b in v], c) for v, c in ((tangents, "t"), (signs, "u"))]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            wide = np.array(b["width"].tolist()).reshape(-1, P)
            for k, name in enumerate((None, "t", "u")):
                c = np.tile(np.eye(P), (len(b), 1, 1)) if name is None else np.array(b[name].tolist()).reshape(-1, P, P)
                d = np.sqrt(np.maximum(c[:, range(P), range(P)], 1e-12))
                like = 0.99 * c / (d[:, :, None] * d[:, None, :]) + 0.01 * np.eye(P)  # correlations
                root, logdet = _roots(like * wide[:, :, None] * wide[:, None, :])
                yield pd.DataFrame({"g": b["g"], "start": k, "centre": b["centre"], "root": root, "logdet": logdet})

    return written(scaled.join(sums, "g").mapInPandas(run, PARAMETERS))


def _least(*params: DataFrame) -> DataFrame:
    """The estimate of least determinant of each group."""
    every = params[0]
    for p in params[1:]:
        every = every.unionByName(p)
    return written(every.groupBy("g").agg(F.min(F.struct("logdet", "start", "centre", "root")).alias("k")).select("g", "k.start", "k.centre", "k.root", "k.logdet"))


def concentrated(rows: DataFrame) -> DataFrame:
    """(g, start, centre, root, logdet) of the nearest ``SHARE`` of each group of ``rows`` (g and the vector): the least determinant found."""
    near = chi2_quantile(SHARE, P)
    scale = SHARE / chi2_cdf(near, P + 2)

    def step(params: DataFrame) -> DataFrame:
        placed = rows.join(params, "g").withColumn("at", F.floor(32 * F.ln(_distance() + 1e-9)))
        w = Window.partitionBy("g", "start")
        ranked = _moments(placed, "at").withColumn("before", F.sum("n").over(w.orderBy("at")) - F.col("n")).withColumn("all", F.sum("n").over(w))
        return _estimates(_added(ranked.where(F.col("before") < SHARE * F.col("all"))), scale)

    params = _starts(rows)
    for _ in range(FIRST_STEPS):
        params = step(params)
    found = [_least(params)]
    for _ in range(STEPS):
        found.append(step(found[-1]))
    return _least(*found)


def covariance_estimates(rows: DataFrame) -> DataFrame:
    """MCD estimate (g, centre, root) of each group of ``rows`` (g and the vector), a scratch table.

    ``concentrated``, then one step that takes all rows within the 97.5 % ellipsoid. The floors in ``VECTOR`` are added to every covariance
    (minimum regularised covariance determinant), so it is never singular.
    """
    wide = chi2_quantile(0.975, P)
    inside = _moments(rows.join(concentrated(rows), "g").where(_distance() <= wide))
    return _estimates(inside, 0.975 / chi2_cdf(wide, P + 2)).select("g", "centre", "root")


def quality_rules(docs: DataFrame, least_rows: int = LEAST_ROWS, tail: float = TAIL) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text, lang, source): text_hash, the counts, base_failed, level, distance2, kept.

    A text of fewer than ten words, or with over a fifth of its words in repeated five-word windows, fails the
    base rules. Any other is rejected if its transformed statistics are beyond the chi-square limit from the
    estimate of its language and source (of its language, or of all, where those have too few rows; null is a
    language or source of its own); ``level`` says which: pair, language, all, or none. Without enough rows for any estimate (an empty or tiny table) only the base
    rules apply. Repeated rows get equal verdicts. Very long texts are counted whole. A distance of exactly the limit is kept.
    """
    stats = written(document_statistics(docs))
    alive = stats.where("NOT base_failed")
    name = lambda *c: F.concat_ws("/", *[F.coalesce(F.concat(F.lit("="), F.col(x)), F.lit("null")) for x in c])
    pair, lang, everything = name("lang", "source"), F.concat(F.lit("lang "), name("lang")), F.lit("all")
    vector = [F.expr(e).cast("double").alias(z) for z, (e, _) in VECTOR.items()]
    # row counts by language and source: one row a pair
    n = F.col("n")
    pairs = alive.groupBy("lang", "source").agg(F.count("*").alias("n"))
    pairs = pairs.withColumn("n_lang", F.sum("n").over(Window.partitionBy("lang"))).withColumn("pair", pair).withColumn("lang_key", lang)
    pairs = written(pairs.select("pair", F.when(n >= least_rows, F.col("pair")).when(F.col("n_lang") >= least_rows, F.col("lang_key")).otherwise(everything).alias("use")))
    rows = written(alive.withColumn("pair", pair).withColumn("lang_key", lang).select("pair", "lang_key", *vector))
    # a level is estimated from all its rows, and only where some pair uses it
    used = pairs.select(F.col("use").alias("g")).distinct()
    levels = rows.select(F.explode(F.array("pair", "lang_key", everything)).alias("g"), *COLUMNS).join(used, "g")
    params = covariance_estimates(written(levels))
    verdicts = pairs.join(params, F.col("use") == F.col("g")).select("pair", "use", "centre", "root")
    limit = chi2_quantile(1 - tail, P)
    enough = F.lit(alive.limit(least_rows).count() >= least_rows)
    known = stats.withColumn("pair", F.when(~F.col("base_failed"), pair)).select("*", *[F.when(~F.col("base_failed"), c).alias(z) for z, c in zip(COLUMNS, vector)])
    measured = known.join(verdicts, "pair", "left").withColumn("distance2", _distance())
    use = F.col("use")
    level = F.when(~enough | use.isNull(), "none").when(use == "all", "all").when(use.startswith("lang "), "language").otherwise("pair")
    outlier = enough & F.coalesce(F.col("distance2") > limit, F.lit(False))
    return measured.withColumn("kept", ~F.col("base_failed") & ~outlier).withColumn("level", level).select(*stats.columns, "level", "distance2", "kept")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("lang", "source", "text_hash")
