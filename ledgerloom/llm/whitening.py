"""Whitening of embeddings from an exact, bit-sliced covariance.

Each entry becomes an integer. A task packs every bit plane of every dimension (less the dimension's minimum) across its rows into 64-bit
words; the product sum of two dimensions is the sum over their planes of 2^(p+q) times the ones that the planes have in common. So a
task hands on counts of ones, which add up exactly whatever the order, and sums are centred as integers before anything is divided.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import own_prefix, table, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Integers are held between these, so that sums of a row's and a dimension's parts fit in a long.
LARGEST = 1 << 61
#: Components of less than this share of the largest eigenvalue, times the dimensions, are rounding errors and have no whitened values.
TINY = 4e-16
#: Rows whose planes are compared at once.
ROWS = 1 << 15


def integers(embedding: Column) -> Column:
    """floor(64 c) + 1,000,000 of each entry as a long; entries beyond +-2^61 are held there."""
    held = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
    return F.transform(embedding, lambda c: F.floor(held(c)) + F.lit(SHIFT))


def is_whole(embedding: Column) -> Column:
    """True for vectors that are neither null nor hold null, NaN or infinite entries."""
    bad = F.exists(embedding, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(embedding.isNotNull() & ~bad, F.lit(False))


def planes(y: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of the non-negative columns of ``y``: [dimension, bit, word], rows packed into 64-bit words, padded with zeros."""
    rows = np.ascontiguousarray(y.T)
    out = np.zeros((y.shape[1], bits, -(-len(y) // 64) * 8), np.uint8)
    for p in range(bits):
        packed = np.packbits((rows >> p & 1).astype(np.uint8), axis=1)
        out[:, p, : packed.shape[1]] = packed
    return out.view(np.uint64)


def product_counts(words: np.ndarray) -> np.ndarray:
    """[i, j, w]: ones that planes p of dimension i and q of dimension j >= i have in common, summed over p + q = w."""
    dims, bits, _ = words.shape
    out = np.zeros((dims, dims, 2 * bits - 1), np.int64)
    for i in range(dims):
        for p in range(bits):
            ones = np.bitwise_count(words[i:] & words[i, p]).sum(axis=2, dtype=np.int64)
            out[i, i:, p : p + bits] += ones
    return out


def _groups(b: pd.DataFrame, rows: int = ROWS) -> Iterator[tuple[int, pd.DataFrame, np.ndarray]]:
    """(dimensions, rows, integers [row, dimension]) of a batch, by the length of its vectors."""
    for dims, part in b.groupby(b["x"].map(len)):
        for lo in range(0, len(part) if dims else 0, rows):
            some = part.iloc[lo : lo + rows]
            yield int(dims), some, np.array(some["x"].tolist(), np.int64)


class Fit:
    """What whitening needs of the vectors of one length."""

    def __init__(self, n: int, sums: list[int], scatter: dict[tuple[int, int], int], components: int):
        """``scatter``: by i <= j the sum of products of the shifted integers, n times it less the product of their sums being shift-free."""
        self.n, self.sums = n, sums
        dims = len(sums)
        v = np.zeros((dims, dims))
        for (i, j), c in scatter.items():
            v[i, j] = v[j, i] = float(Fraction(c, n * n))
        values, vectors = np.linalg.eigh(v)
        self.trace = sum((Fraction(scatter[i, i], n * n) for i in range(dims)), Fraction(0))
        order = np.argsort(-values, kind="stable")[:components]
        self.values, vectors = values[order], vectors[:, order]
        large = np.abs(vectors).argmax(axis=0)
        vectors = vectors * np.where(vectors[large, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
        self.real = self.values > max(0.0, values.max()) * TINY * dims
        self.to = np.where(self.real, vectors / np.sqrt(np.where(self.real, self.values, 1.0)), np.nan)
        self.explained = self.values / float(self.trace) if self.trace else np.full(len(self.values), np.nan)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S of each row, exact: longs where they fit, else Python's integers."""
        s = np.array(self.sums, object)
        far = max(1, *(abs(self.n * int(v) - t) for edge in (x.min(axis=0), x.max(axis=0)) for v, t in zip(edge, self.sums)))
        widest = max(self.n * int(np.abs(x).max()), max(map(abs, self.sums)))
        if widest < 1 << 62 and far * far * len(self.sums) < 1 << 63:
            return self.n * x - s.astype(np.int64)
        return self.n * x.astype(object) - s

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.n) @ self.to


def _moments(rows: DataFrame) -> list:
    """A row a dimension of each length: (dims, at, n, s, low, high)."""
    # a task hands on a row a dimension of each length
    return rows.select(F.size("x").alias("dims"), F.posexplode("x").alias("at", "v")).groupBy("dims", "at").agg(
        F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.min("v").alias("low"), F.max("v").alias("high")
    ).orderBy("dims", "at").collect()


def fits_of(rows: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """A ``Fit`` for each length of the vectors ``x`` (longs) of ``rows``; what is collected grows with dimensions and bits alone."""
    moments = defaultdict(list)
    for r in _moments(rows):
        moments[r["dims"]].append(r)
    low = {dims: np.array([r["low"] for r in m], np.int64) for dims, m in moments.items()}
    bits = {dims: max(1, max(r["high"] - r["low"] for r in m).bit_length()) for dims, m in moments.items()}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for dims, _, x in _groups(b):
                found = product_counts(planes(x - low[dims], bits[dims]))
                totals[dims] = totals[dims] + found if dims in totals else found
        for dims, t in totals.items():
            i, j, w = np.nonzero(t)
            yield pd.DataFrame({"dims": dims, "i": i, "j": j, "w": w, "ones": t[i, j, w]})

    counted = rows.select("x").mapInPandas(count, "dims int, i int, j int, w int, ones long")
    scatter = {dims: dict.fromkeys(((i, j) for i in range(dims) for j in range(i, dims)), 0) for dims in moments}
    for r in counted.groupBy("dims", "i", "j", "w").agg(F.sum("ones").alias("ones")).collect():
        scatter[r["dims"]][r["i"], r["j"]] += r["ones"] << r["w"]
    out = {}
    for dims, m in moments.items():
        n, sums = m[0]["n"], [int(r["s"]) for r in m]
        shifted = [s - n * int(v) for s, v in zip(sums, low[dims])]
        out[dims] = Fit(n, sums, {(i, j): n * c - shifted[i] * shifted[j] for (i, j), c in scatter[dims].items()}, components)
    return out


def _identity_errors(rows: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """By length: the largest entry of the whitened vectors' covariance less the identity, measured over all rows."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for dims, _, x in _groups(b):
                f = fits[dims]
                w = f.whitened(f.centred(x))[:, f.real]
                found = [w.sum(axis=0), w.T @ w]
                sums[dims] = [a + c for a, c in zip(sums[dims], found)] if dims in sums else found
        for dims, (s, m) in sums.items():
            yield pd.DataFrame({"dims": dims, "i": np.arange(len(s) + m.size), "v": np.concatenate([s, m.ravel()])})

    found = defaultdict(dict)
    for r in rows.select("x").mapInPandas(measure, "dims int, i int, v double").groupBy("dims", "i").agg(F.sum("v").alias("v")).collect():
        found[r["dims"]][r["i"]] = r["v"]
    out = {}
    for dims, f in fits.items():
        k = int(f.real.sum())
        v = np.array([found[dims][i] for i in range(k + k * k)]) / f.n if k else np.zeros(0)
        mean = v[:k]  # of vectors that were centred exactly: what rounding leaves
        out[dims] = float(np.abs(v[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max()) if k else 0.0
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS, keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """(``keep``, n, deviation, whitened array<double>, explained array<double>, identity_error) for each whole vector of ``embedding``.

    Vectors that are null or hold null, NaN or infinite entries are dropped, all others are fitted and returned, repeated rows and null
    ids as often as they occur. Vectors of another length are a fit of their own, and empty ones have no components. Entry k of
    ``whitened`` belongs to component k + 1; it is null (and out of the identity error) where the component's eigenvalue is zero but
    for rounding, as for a single row. ``explained`` is null where nothing varies. ``deviation`` is null where it is over a long. Tied
    eigenvalues are numbered as they come from one decomposition for all rows; of either sign the one whose largest entry is
    positive is taken. An empty table gives none.
    """
    mark = own_prefix(vectors)
    kept = [F.col(c).alias(f"{mark}{i}") for i, c in enumerate(keep)]
    rows = written(vectors.where(is_whole(F.col("embedding"))).select(*kept, integers(F.col("embedding")).alias("x")))
    fits = fits_of(rows, components)
    errors = _identity_errors(rows, fits)
    names = [c for c in rows.columns if c != "x"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        real = lambda v: [None if np.isnan(e) else float(e) for e in v]
        for b in batches:
            for dims, some, x in _groups(b, 4096):
                f = fits[dims]
                c = f.centred(x)
                deviation = [int(d) if d < 1 << 63 else None for d in (c * c).sum(axis=1)]
                w = f.whitened(c)
                whitened = list(w) if f.real.all() else [real(v) for v in w]
                yield some[names].assign(n=f.n, deviation=pd.array(deviation, "Int64"), whitened=whitened, explained=[real(f.explained)] * len(some), identity_error=errors[dims])

    kinds = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names)
    found = rows.mapInPandas(run, f"{kinds}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double")
    return found.withColumnsRenamed({f"{mark}{i}": c for i, c in enumerate(keep)})


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "of")
    found = whiten(table(spark, sf_dir, "embeddings")).select("vec_id", "n", "deviation", "identity_error", each)
    return found.select("vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", "of.whitened", "of.explained", "identity_error")
