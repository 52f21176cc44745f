"""Toxicity by a cumulative-link ordinal regression on sparse text features.

The features are the beginnings of words (three to seven letters, or a whole shorter word) that set labelled toxic texts apart, at most
``FEATURES`` of them. Beginnings stand for a word and its inflected forms. Features and weights are fitted on ``SAMPLE``
labelled documents at most; every document is scored. Labels say only toxic or not; the grade of a toxic text is the third in which its odds lie
under a model of toxic or not that was fitted without it, on the other folds of the labelled documents. One weight vector serves all thresholds: P(grade > k) = s(w.x - t_k).
A text's severity is the expected grade; it is toxic if P(grade > 0) reaches one half.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

#: Grades 0 (clean) to 3; features at most; labelled documents that the model is fitted on at most.
GRADES, FEATURES, SAMPLE = 4, 600, 20_000
#: Folds of the labelled documents for the grades.
FOLDS = 3
#: A feature's least number of toxic texts, and its least smoothed ratio of toxic to clean shares.
LEAST_TEXTS, LEAST_RATIO = 3, 8.0
RIDGE, ITERATIONS = 2e-5, 400
#: A text is toxic from this P(grade > 0).
LIMIT = 0.5
LETTERS = re.compile(r"[^\W\d_]+").findall
PREFIXES = range(3, 8)


def beginnings(word: str) -> set[str]:
    return {word[:k] for k in PREFIXES}


def _document_frequencies(labelled: DataFrame) -> DataFrame:
    """(word, fold, toxic texts, clean texts) over ``labelled`` (text, toxic, fold), counted in a task before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[tuple[str, int], list[int]] = {}

        def frame() -> pd.DataFrame:
            return pd.DataFrame({"word": np.array([w for w, _ in found], object), "fold": [f for _, f in found], "bad": [x[1] for x in found.values()], "good": [x[0] for x in found.values()]})

        for b in batches:
            for text, toxic, fold in zip(b["text"], b["toxic"], b["fold"]):
                words = {w[: PREFIXES[-1]] for w in LETTERS((text or "").lower())}
                for w in set().union(*map(beginnings, words)):
                    found.setdefault((w, fold), [0, 0])[toxic] += 1
                if len(found) > 300_000:  # bounds a task's memory
                    yield frame()
                    found.clear()
        yield frame()

    found = labelled.select("text", "toxic", "fold").mapInPandas(run, "word string, fold int, bad long, good long")
    return found.groupBy("word", "fold").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def features(counts: DataFrame, bad: int, good: int, most: int = FEATURES) -> dict[str, int]:
    """The words of the largest log-likelihood gain for toxic texts, numbered."""
    a, b = F.col("bad"), F.col("good")
    ratio = ((a + 0.5) / (bad + 1)) / ((b + 0.5) / (good + 1))
    gain = a * F.ln(ratio)
    best = counts.where((a >= LEAST_TEXTS) & (ratio >= LEAST_RATIO)).orderBy(gain.desc(), "word").limit(most).select("word")
    return {r["word"]: i for i, r in enumerate(best.collect())}


class Features:
    """Finds the features of texts; remembers which ones a word has."""

    def __init__(self, words: dict[str, int]):
        self.words, self.known = words, {}

    def __call__(self, text: str | None) -> dict[int, float]:
        """Feature -> 1 + log(occurrences)."""
        hits: dict[int, int] = {}
        if len(self.known) > 300_000:
            self.known.clear()
        for w, n in Counter(LETTERS((text or "").lower())).items():
            ids = self.known.get(w)
            if ids is None:
                ids = self.known[w] = tuple(sorted(self.words[x] for x in beginnings(w) if x in self.words))
            for k in ids:
                hits[k] = hits.get(k, 0) + n
        return {k: 1 + math.log(n) for k, n in hits.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(row: np.ndarray, col: np.ndarray, x: np.ndarray, k: int, grade: np.ndarray, grades: int, ridge: float = RIDGE, iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of the proportional-odds model, by gradient steps with momentum (Adam).

    The features are sparse: cell (row, col) holds x. Thresholds are kept in order as a first value and positive gaps.
    """
    n = len(grade)
    share = np.array([max(0.5, (grade > j).sum()) / (n + 1) for j in range(grades - 1)])
    start = np.log((1 - share) / share)
    start = np.maximum.accumulate(start + 0.01 * np.arange(grades - 1))
    theta = np.concatenate([np.zeros(k), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, iterations + 1):
        w, first, gaps = theta[:k], theta[k], np.exp(theta[k + 1 :])
        t = np.concatenate([[-np.inf], first + np.concatenate([[0.0], np.cumsum(gaps)]), [np.inf]])
        s = np.bincount(row, w[col] * x, n)
        up, low = _sigmoid(t[grade + 1] - s), _sigmoid(t[grade] - s)
        p = np.maximum(up - low, 1e-12)
        du, dl = up * (1 - up) / p, low * (1 - low) / p
        g_t = np.array([dl[grade == j].sum() - du[grade == j - 1].sum() for j in range(1, grades)])  # of the negative log-likelihood
        grad = np.concatenate([np.bincount(col, (du - dl)[row] * x, k) / n + 2 * ridge * w, [g_t.sum() / n], np.cumsum(g_t[::-1])[::-1][1:] * gaps / n])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta -= 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-9)
    gaps = np.exp(theta[k + 1 :])
    return theta[:k], theta[k] + np.concatenate([[0.0], np.cumsum(gaps)])


class Model:
    """words: feature numbers; weights; thresholds. Small: bounded by ``FEATURES``."""

    def __init__(self, words: dict[str, int], weights: np.ndarray, thresholds: np.ndarray):
        self.words, self.weights, self.thresholds = words, weights, thresholds

    def score(self, text: str | None, find: Features) -> tuple[float, float]:
        """(expected severity, P(grade > 0))"""
        found = find(text)
        beyond = _sigmoid(sum(self.weights[k] * x for k, x in found.items()) - self.thresholds)
        return float(beyond.sum()), float(beyond[0])


def train(labelled: DataFrame) -> Model:
    """Fit on all of ``labelled`` (doc_id, text, toxic: 0 or 1), a scratch table of at most ``SAMPLE`` rows. Without a toxic
    label nothing is toxic."""
    labelled = labelled.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int"))
    sizes = {(r["fold"], r["toxic"]): r["n"] for r in labelled.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    size = lambda toxic, out=None: sum(n for (f, t), n in sizes.items() if t == toxic and f != out)
    if not size(1):
        return Model({}, np.zeros(0), np.array([40.0] * (GRADES - 1)))
    counts = written(_document_frequencies(labelled))
    added = lambda rows: rows.groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    words = features(added(counts), size(1), size(0))
    if not words:
        return Model({}, np.zeros(0), np.array([40.0] * (GRADES - 1)))
    # the words of a fold's model are chosen without that fold too
    others = [features(added(counts.where(F.col("fold") != f)), size(1, f), size(0, f)) for f in range(FOLDS)]
    every = {w: i for i, w in enumerate(sorted({*words}.union(*others)))}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = Features(every)
        for b in batches:
            found = [find(t) for t in b["text"]]
            yield pd.DataFrame({"toxic": b["toxic"], "fold": b["fold"], "k": [list(f) for f in found], "x": [list(f.values()) for f in found]})

    kept = labelled.select("doc_id", "text", "toxic", "fold").orderBy(F.xxhash64("doc_id", "text"), "doc_id").select("text", "toxic", "fold")
    rows = kept.mapInPandas(run, "toxic int, fold int, k array<int>, x array<double>").collect()  # at most ``SAMPLE`` rows of few numbers
    toxic, fold = np.array([r["toxic"] for r in rows]), np.array([r["fold"] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r["k"]) for r in rows])
    col, x = (np.array([v for r in rows for v in r[c]], kind) for c, kind in (("k", np.int64), ("x", np.float64)))

    def fit(mine: dict[str, int], those: np.ndarray, grade: np.ndarray, grades: int) -> tuple[np.ndarray, np.ndarray]:
        """Weights by number in ``every``, and thresholds, of the model for the words ``mine`` on the rows ``those``."""
        number = np.full(len(every), -1)
        number[[every[w] for w in mine]] = list(mine.values())
        use = those[row] & (number[col] >= 0)
        at = np.cumsum(those) - 1
        w, t = fit_ordinal(at[row[use]], number[col[use]], x[use], len(mine), grade[those], grades)
        wide = np.zeros(len(every))
        wide[[every[v] for v in mine]] = w[list(mine.values())]
        return wide, t

    odds = np.zeros(len(rows))
    for f, mine in enumerate(others):
        if (fold != f).any():
            w, t = fit(mine, fold != f, toxic, 2)
            odds = np.where(fold == f, np.bincount(row, w[col] * x, len(rows)) - t[0], odds)
    w, t = fit(words, np.ones(len(rows), bool), grades_of(toxic, odds), GRADES)
    return Model(words, w[[every[v] for v in words]], t)


def grades_of(toxic: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """0 for a clean text, else 1 to 3: the third of the toxic texts in which the odds lie."""
    thirds = np.quantile(odds[toxic == 1], [1 / 3, 2 / 3])
    return np.where(toxic == 1, 1 + (odds > thirds[0]) + (odds > thirds[1]), 0)


def severity(model: Model):
    """A function of a text column: struct of severity (the expected grade) and p_toxic."""

    @F.pandas_udf("severity double, p_toxic double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        find = Features(model.words)
        for b in batches:
            yield pd.DataFrame([model.score(t, find) for t in b], columns=["severity", "p_toxic"], dtype=float)

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, severity, p_toxic, toxic) for each row of ``docs`` (doc_id, text). Null and empty texts hold no feature
    and get the severity of a text without any. Repeated rows are scored alike."""
    scored = docs.select("doc_id", severity(model)("text").alias("s"))
    return scored.select("doc_id", "s.severity", "s.p_toxic", (F.col("s.p_toxic") >= LIMIT).alias("toxic"))


def model_for(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Trained on those rows of ``docs`` that ``labels`` (doc_id, toxic) covers: all, or the ``sample`` doc_ids of least hash, one row for each
    (its text of least hash).

    A doc_id that is labelled both ways is toxic; labels other than 0 and 1 are left out. The texts are not shuffled:
    the bounded sample of ids is broadcast to them.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    present = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    some = written(present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    return train(written(_one_text(docs.select("doc_id", "text", F.xxhash64("text").alias("h")).join(F.broadcast(some), "doc_id"))))


def _one_text(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text, h: its hash, toxic), the text of least hash for each doc_id; a task drops the others before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        least: dict = {}
        held = 0
        for b in batches:
            for r in zip(b["doc_id"], b["text"], b["h"], b["toxic"]):
                old = least.get(r[0])
                if old is None or r[2] < old[2]:
                    held += len(r[1] or "") - (len(old[1] or "") if old else 0)
                    least[r[0]] = r
            if held > 1 << 24:  # bounds a task's memory
                yield frame(least)
                least, held = {}, 0
        yield frame(least)

    def frame(least: dict) -> pd.DataFrame:
        return pd.DataFrame({c: pd.Series([r[i] for r in least.values()], dtype=object) for i, c in enumerate(("doc_id", "text", "h", "toxic"))})

    kept = rows.select("doc_id", "text", "h", "toxic").mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string, h long, toxic int")
    one = kept.groupBy("doc_id").agg(F.min(F.struct("h", "text", "toxic")).alias("k"))
    return one.select("doc_id", "k.text", "k.toxic")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``score`` of ``docs`` under the model for ``docs`` and ``labels``. Very long texts are scored whole; a P(toxic) of exactly the limit counts as toxic.
    An empty table gives none, and without labels nothing is toxic."""
    return score(docs, model_for(docs, labels))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
