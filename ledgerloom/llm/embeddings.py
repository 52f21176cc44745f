"""Near-duplicate embeddings by spherical-cap filters.

A filter is a tuple of directions, one for each block of a randomly rotated vector (a random product code); a vector passes
it if the sum of the block products is at least a limit. Decoding a vector lists every filter that it passes, by
extending partial sums only while the limit can still be reached; a vector that passes few is given its best ones.
Vectors of up to ``GRID`` numbers go to cells of a grid instead, which loses no link. Filters are chosen for directions that lie evenly
around, which those of real vectors don't: so the mean of a label's directions is taken off before (candidates are verified as they are). Vectors near
that mean would lose their neighbours so; they, and those a link away from them, are decoded as they are. Vectors of a label that share a filter
are candidates: small buckets are sifted by sign sketches first, and what remains is verified by cosine in double
precision. A pair is counted only in the first filter that both pass, so counts are exact and no list of pairs is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, shuffle_partitions, table, written

COSINE = 0.98
#: Rotations; filters that a vector passes in each on average, at most; vectors of a label in a bucket that the number of filters aims at.
TABLES, PASSES, BUCKET = 4, 24, 8
#: Blocks of a vector, at every size; filters that a vector has in each rotation at least.
SPLIT, LEAST = 2, 12
#: Dimensions up to which the filters are cells of a grid, and the side of a cell; near vectors are ``REACH`` apart at most.
GRID, CELL, REACH = 6, 0.4, math.sqrt(2 - 2 * COSINE) + 1e-9
#: Vectors at least ``FAR`` from the mean of their label are decoded without it, those less than ``CORE`` from it as they are. Linked vectors are at
#: most ``REACH`` apart, so both are decoded in one way or in the other.
FAR = 0.25
CORE = FAR + REACH
OFFSET = 1 << 60
#: Buckets above this size skip the sketches; larger groups of verified vectors are cut into blocks of so many rows.
SIFTED, BLOCK = 256, 2048
#: Numbers in a block of the search for earlier common filters.
CELLS = 1 << 24
#: Sign bits in which candidates may differ. At cosine 0.98 a pair differs in 4 of 64 on average as it is, and in more than 18 about once in 10^8; less the mean
#: and ``CORE`` away from it a pair differs in 8.6 on average and in more than 18 once in 400, which is what bounds recall there (0.9975 measured).
SKETCH_BITS = 18
SEED = 42


class Filters:
    """The filters for vectors of ``dim`` numbers; all of it follows from its parameters and the seed."""

    def __init__(self, dim: int, count: int, tables: int = TABLES, passes: float = PASSES, blocks: int = SPLIT, least: int = 0):
        rng = np.random.default_rng(SEED)
        self.dim, self.least = dim, least
        self.blocks = min(dim, blocks)
        self.width = max(4, math.ceil(count ** (1 / self.blocks)))
        edges = np.linspace(0, dim, self.blocks + 1).astype(int)
        self.cuts = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        total = self.width**self.blocks
        sigma = math.sqrt(self.blocks / dim)
        self.limit = sigma * NormalDist().inv_cdf(1 - min(0.5, passes / total))
        self.total = total
        self.codes = []
        for _ in range(tables):
            turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
            book = []
            for a, b in self.cuts:
                c = rng.standard_normal((self.width, b - a))
                book.append(turn[:, a:b] @ (c / np.linalg.norm(c, axis=1, keepdims=True)).T)
            self.codes.append(book)
        self.planes = rng.standard_normal((dim, 64))

    def sketches(self, unit: np.ndarray) -> np.ndarray:
        return np.packbits(unit @ self.planes > 0, axis=1).view(np.int64).ravel()

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Numbers of all filters that each row of ``unit`` passes, and of its ``least`` best ones in each rotation, ascending."""
        rows, found = [], []
        for t, book in enumerate(self.codes):
            scores = [unit @ code for code in book]
            full = rest = sum(s.max(axis=1) for s in scores)
            row, sums, ids = np.arange(len(unit)), np.zeros(len(unit)), np.zeros(len(unit), np.int64)
            top, top_ids = np.zeros((len(unit), 1)), np.zeros((len(unit), 1), np.int64)
            for s in scores:
                most = s.max(axis=1)
                rest = rest - most
                # only directions that can reach the limit with the best ones of all other blocks are sorted
                k = min(self.width, max(1, self.least, int((s >= (self.limit - full + most - 1e-12)[:, None]).sum(axis=1).max())))
                order = np.argpartition(-s, k - 1, axis=1)[:, :k]
                order = np.take_along_axis(order, np.argsort(-np.take_along_axis(s, order, axis=1), axis=1, kind="stable"), axis=1)
                best = np.take_along_axis(s, order, axis=1)
                # a partial sum goes on only with the directions that still let it reach the limit
                n = (best[row] >= (self.limit - rest[row] - sums - 1e-12)[:, None]).sum(axis=1)
                old = np.repeat(np.arange(len(row)), n)
                at = np.arange(len(old)) - np.repeat(np.cumsum(n) - n, n)
                row = row[old]
                sums, ids = sums[old] + best[row, at], ids[old] * self.width + order[row, at]
                # the best sums continue the best partial sums with the best directions
                wide = (top[:, :, None] + best[:, None, :self.least]).reshape(len(unit), -1)
                wide_ids = (top_ids[:, :, None] * self.width + order[:, None, :self.least]).reshape(len(unit), -1)
                pick = np.argsort(-wide, axis=1, kind="stable")[:, :self.least]
                top, top_ids = np.take_along_axis(wide, pick, axis=1), np.take_along_axis(wide_ids, pick, axis=1)
            few = np.bincount(row, minlength=len(unit)) < self.least
            rows += [row[~few[row]], np.repeat(np.nonzero(few)[0], top.shape[1])]
            found += [t * self.total + ids[~few[row]], t * self.total + top_ids[few].ravel()]
        return _by_row(np.concatenate(rows), np.concatenate(found), len(unit))

    def both(self, unit: np.ndarray, mean: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Filters of each row of ``unit``, and its sketches: without ``mean`` (numbers below ``OFFSET``) and as it is (from there on)."""
        if self.dim <= GRID:
            return [c + OFFSET for c in self._cells(unit)], np.stack([self.sketches(unit)] * 2, axis=1)
        away = unit - mean
        r = np.linalg.norm(away, axis=1)
        out = [np.zeros(0, np.int64)] * len(unit)
        for x, which, offset in ((away / np.maximum(r, 1e-12)[:, None], r >= FAR, 0), (unit, r < CORE, OFFSET)):
            at = np.nonzero(which)[0]
            if len(at):
                for i, ids in zip(at.tolist(), self.decode(x[at])):
                    out[i] = np.concatenate([out[i], ids + offset])
        return out, np.stack([self.sketches(away), self.sketches(unit)], axis=1)

    def _cells(self, unit: np.ndarray) -> list[np.ndarray]:
        """Numbers of all cells within half of ``REACH`` of each row in every dimension: near rows have one in common."""
        low, high = (np.floor((unit + d) / CELL).astype(np.int64) + 3 for d in (-REACH / 2, REACH / 2))
        row, ids = np.arange(len(unit)), np.zeros(len(unit), np.int64)
        for i in range(self.dim):
            both = high[row, i] > low[row, i]
            more = ids[both] * 8 + high[row[both], i]
            row, ids = np.concatenate([row, row[both]]), np.concatenate([ids * 8 + low[row, i], more])
        return _by_row(row, ids, len(unit))


def _by_row(row: np.ndarray, ids: np.ndarray, n: int) -> list[np.ndarray]:
    """The ids of each of ``n`` rows, ascending."""
    by = np.lexsort((ids, row))
    return np.split(ids[by], np.searchsorted(row[by], np.arange(1, n)))


def _whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Batches of a stream that is sorted by ``keys``, cut so that each holds whole groups, and where groups begin."""
    tail = None
    for b in batches:
        b = b if tail is None else pd.concat([tail, b], ignore_index=True)
        k = b[keys].to_numpy()
        cuts = np.nonzero((k[1:] != k[:-1]).any(axis=1))[0] + 1
        last = cuts[-1] if len(cuts) else 0
        tail = b.iloc[last:]  # the last group may go on
        if last:
            yield b.iloc[:last], np.concatenate([[0], cuts])
    if tail is not None and len(tail):
        yield tail, np.array([0, len(tail)])


def _sift(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by (label, filter): those whose sketch is near another one's in their bucket."""
    for b, _ in _whole_groups(batches, ["label", "filter"]):
        yield _near(b)


def _near(b: pd.DataFrame) -> pd.DataFrame:
    label, filter_, sketch = (b[c].to_numpy() for c in ("label", "filter", "sketch"))
    keep = np.zeros(len(b), bool)
    live, d = np.arange(len(b)), 1
    while len(live := live[live + d < len(b)]):
        live = live[(label[live] == label[live + d]) & (filter_[live] == filter_[live + d])]
        close = live[np.bitwise_count((sketch[live] ^ sketch[live + d]).view(np.uint64)) <= SKETCH_BITS]
        keep[close] = keep[close + d] = True
        d += 1
    return b.loc[keep, ["label", "filter", "uid"]]


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (label, filter, low, high) -> (uid, links, to): links found here, and a spanning edge."""
    for b, cuts in _whole_groups(batches, ["label", "filter", "low", "high"]):
        units = np.array(b["unit"].tolist())
        filters = [np.asarray(f) for f in b["filters"]]
        here, uid, copies = (b[c].to_numpy() for c in ("filter", "uid", "copies"))
        own = np.where(b["low"].to_numpy() == b["high"].to_numpy(), -1, b["block"].to_numpy())
        found = []
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if j - i > 1:
                links, root = _links_of(units[i:j], filters[i:j], here[i], copies[i:j], own[i:j])
                some = np.nonzero(links)[0]
                found.append((uid[i:j][some], links[some], uid[i:j][root[some]]))
        if found:
            yield pd.DataFrame({c: np.concatenate([f[k] for f in found]) for k, c in enumerate(("uid", "links", "to"))})


def _links_of(x: np.ndarray, filters: list[np.ndarray], here: int, copies: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each vector of a bucket to others whose first common filter is ``here``, and a root for each linked set.

    ``own``: the block of each row where two blocks meet (only pairs across count), else -1. Most pairs of a dense group
    have met in an earlier filter. Rows that have the most common earlier filter need not be compared with each
    other, so only the others are, with all rows.
    """
    n = len(x)
    before = [f[: np.searchsorted(f, here)] for f in filters]
    names, column = np.unique(np.concatenate(before), return_inverse=True)
    fresh, root = np.arange(n), np.arange(n)
    rows = np.repeat(np.arange(n), [len(f) for f in before])
    if len(names):
        met = np.zeros(n, bool)
        met[rows[column == np.bincount(column).argmax()]] = True
        fresh = np.nonzero(~met)[0]
    links = np.zeros(n, np.int64)
    if not len(fresh):
        return links, root
    linked = x[fresh] @ x.T >= COSINE
    linked[np.arange(len(fresh)), fresh] = False
    if own[0] >= 0:
        linked &= own[fresh, None] != own[None, :]
    if not linked.any():
        return links, root
    _unmeet(linked, fresh, rows, column)
    rest = np.ones(n, bool)
    rest[fresh] = False
    links[fresh] = linked @ copies
    links[rest] = copies[fresh] @ linked[:, rest]
    while True:
        low = root.copy()
        low[fresh] = np.minimum(low[fresh], np.where(linked, root[None, :], n).min(axis=1))
        low = np.minimum(low, np.where(linked, low[fresh, None], n).min(axis=0))
        if (low == root).all():
            return links, root
        root = low


def _unmeet(linked: np.ndarray, fresh: np.ndarray, rows: np.ndarray, column: np.ndarray) -> None:
    """Clear ``linked`` (rows ``fresh`` by all rows) where both rows have an earlier filter in common; cell (rows, column): a row has one.

    A few rows are compared at once, on the filters that they and some other row have, so a block holds at most ``CELLS`` numbers or one row's.
    """
    n = linked.shape[1]
    often = np.bincount(column)[column] > 1
    rows, column = rows[often], column[often]
    first = np.searchsorted(rows, np.arange(n + 1))
    lo = 0
    while lo < len(fresh):
        hi = lo + 1
        size = lambda k: int((first[fresh[lo:k] + 1] - first[fresh[lo:k]]).sum())
        while hi < len(fresh) and size(hi + 1) * n <= CELLS:
            hi += 1
        some = np.unique(np.concatenate([column[first[r] : first[r + 1]] for r in fresh[lo:hi]]))
        if len(some):
            here = np.isin(column, some)
            passed = np.zeros((n, len(some)), np.float32)
            passed[rows[here], np.searchsorted(some, column[here])] = 1
            linked[lo:hi] &= passed[fresh[lo:hi]] @ passed.T == 0
        lo = hi


def _means(units: DataFrame) -> DataFrame:
    """(label, dim, mean): the mean direction of each label's vectors of a length, added up in tasks before the shuffle."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    scaled = units.select("label", F.size("embedding").alias("dim"), e.alias("e")).withColumn("e", F.transform("e", lambda x: x / F.array_max(F.transform("e", F.abs))))
    unit = F.transform("e", lambda x: x / F.sqrt(F.aggregate("e", F.lit(0.0), lambda a, y: a + y * y)))
    return scaled.select("label", "dim", array_to_vector(unit).alias("v")).groupBy("label", "dim").agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("mean"))


def near_embeddings(vectors: DataFrame, tables: int = TABLES, passes: float = PASSES) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding, label).

    Vectors of equal label link if their cosine in double precision is at least 0.98. Null, empty and zero vectors,
    vectors with a null, NaN or infinite part, and vectors without a label, link with nothing and form their own
    components. Vectors of different length do not link. Equal vectors are verified once and counted as often as they
    occur. A null vec_id names a component only where all of it is null. An empty table gives none. A cosine of exactly 0.98 links.
    """
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(e, lambda x: x != 0)
    valid = F.col("label").isNotNull() & e.isNotNull() & ~F.coalesce(bad | zero, F.lit(True))
    rows = written(vectors.select("vec_id", "label", "embedding", F.coalesce(valid, F.lit(False)).alias("valid"), F.xxhash64("label", "embedding").alias("h")))
    good = rows.where("valid")
    units = good.groupBy("label", "h", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    units = written(units.withColumn("uid", F.monotonically_increasing_id()))

    # how many filters: the largest label decides; one row a label and length
    most = units.groupBy("label", F.size("embedding").alias("dim")).count().agg(F.max("count")).first()[0] or 1
    count = max(1024, most * passes // BUCKET)

    def pass_(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: dict[int, Filters] = {}
        for b in batches:
            for dim, part in b.groupby(b["embedding"].map(len)):
                if dim not in made:
                    made[dim] = Filters(dim, count, tables, passes, SPLIT, LEAST)
                f = made[dim]
                for lo in range(0, len(part), 256):
                    some = part.iloc[lo : lo + 256]
                    x = np.array(some["embedding"].tolist(), np.float64)
                    x /= np.abs(x).max(axis=1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    filters, sketches = f.both(x, np.array(some["mean"].tolist()))
                    yield pd.DataFrame({"uid": some["uid"], "label": some["label"], "copies": some["copies"], "unit": list(x), "sketches": list(sketches), "filters": filters})

    kind = vectors.schema["label"].dataType.simpleString()
    means = written(_means(units)).withColumnRenamed("label", "of")
    placed = units.join(means, (F.col("label") == F.col("of")) & (F.size("embedding") == F.col("dim"))).select("uid", "label", "copies", "embedding", "mean")
    passed = written(placed.mapInPandas(pass_, f"uid long, label {kind}, copies long, unit array<double>, sketches array<long>, filters array<long>"))
    parts = shuffle_partitions(vectors.sparkSession)
    # vectors of different lengths never meet
    entries = passed.select("uid", F.xxhash64("label", F.size("unit")).alias("label"), "sketches", F.explode("filters").alias("filter"))
    entries = written(entries.select("uid", "label", "filter", F.when(F.col("filter") < OFFSET, F.col("sketches")[0]).otherwise(F.col("sketches")[1]).alias("sketch")))
    sizes = written(entries.groupBy("label", "filter").agg(F.count("*").alias("n")).where("n > 1"))
    crowded = written(entries.join(sizes, ["label", "filter"]))
    small = crowded.where(F.col("n") <= SIFTED).repartition(parts, "label", "filter").sortWithinPartitions("label", "filter")
    sifted = small.select("label", "filter", "uid", "sketch").mapInPandas(_sift, "label long, filter long, uid long")
    left = written(sifted.union(crowded.where(F.col("n") > SIFTED).select("label", "filter", "uid")))

    groups = left.groupBy("label", "filter").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = left.join(written(groups), ["label", "filter"]).withColumn("block", F.pmod(F.xxhash64("uid"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other).withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    dealt = dealt.join(passed.select("uid", "copies", "unit", "filters"), "uid")
    keys = ["label", "filter", "low", "high"]
    placed = dealt.select(*keys, "block", "uid", "copies", "unit", "filters").repartition(parts, *keys).sortWithinPartitions(*keys)
    found = written(placed.mapInPandas(_verify, "uid long, links long, to long"))

    nodes = written(units.select(F.col("uid").alias("node"), "least"))
    parts_of = written(components(nodes, found.select(F.col("uid").alias("a"), F.col("to").alias("b"))).withColumnRenamed("node", "uid"))
    links = written(found.groupBy("uid").agg(F.sum("links").alias("links")))
    known = units.select("uid", "label", "h", "embedding", "copies").join(links, "uid", "left").join(parts_of, "uid")
    known = written(known.select("label", "h", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component"))
    linked = good.join(known, ["label", "h", "embedding"]).select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where("NOT valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op2_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"))
