"""Packing documents into sequences by length patterns.

The plan needs only the histogram of lengths. Patterns of up to ``DEPTH`` documents that nearly fill a sequence are enumerated, their
repeat counts are fitted to the histogram by non-negative least squares and rounded down, and what the histogram has left is packed
best-fit, longest first, into the patterns' gaps and new sequences; all of it on counts, so the plan's cost and size follow the
capacity and not the corpus. Each piece then finds its place from its ordinal among the pieces of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written
from .units import StemIds, byte_level, encode_units

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
CAPACITY = 1024
#: Documents in a pattern at most; share of the capacity that a pattern may leave free.
DEPTH, WASTE = 3, 0.0
#: Rounds of the fit at most. What is not fitted is packed as residual.
ROUNDS = 120
#: Power of a length by which the square of its error weighs: long pieces have few partners, so they are fitted first.
STEEP = 10
#: Bytes of text encoded at once, but for a longer row; stems that a worker keeps in each of two generations. Both bound memory only.
LOT, REMEMBERED = 4_000_000, 500_000

Contents = tuple[tuple[int, int], ...]  # (length, how often) of a sequence


def patterns(lengths: np.ndarray, capacity: int, depth: int = DEPTH, waste: float = WASTE) -> np.ndarray:
    """Places in the ascending ``lengths`` of each pattern's documents (rows, padded with len(lengths)).

    Of all patterns that begin with the same documents the one with the longest last document is listed, if it leaves at most
    ``waste`` of the capacity.
    """
    n = len(lengths)
    size = np.concatenate([lengths, [0]])
    found, begun = [], np.full((1, depth), n)
    for k in range(depth):
        left = capacity - size[begun].sum(axis=1)
        last = begun[:, k - 1] if k else np.full(len(begun), n - 1)
        end = np.minimum(np.searchsorted(lengths, left, side="right") - 1, last)  # places fall within a pattern
        whole = begun[end >= 0].copy()
        whole[:, k] = end[end >= 0]
        found.append(whole[capacity - size[whole].sum(axis=1) <= capacity * waste])
        if k + 1 < depth:
            count = np.maximum(end + 1, 0)
            more = np.repeat(begun, count, axis=0)
            more[:, k] = np.arange(len(more)) - np.repeat(np.cumsum(count) - count, count)
            # the rest must be able to fill the sequence with documents that are no longer
            begun = more[capacity - size[more].sum(axis=1) <= size[more[:, k]] * (depth - k - 1) + capacity * waste]
    return np.unique(np.concatenate(found), axis=0)


def fit_counts(pats: np.ndarray, lengths: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that least-squares fit ``counts`` (errors weighed by length), by block coordinate descent.

    A round takes the patterns of the steepest projected slope of which no two share a length, and sets each to its exact minimum, or
    to zero where that lies below. It ends when no slope is over a millionth of the first one's, or after ``rounds``. Patterns are only
    taken up where they are steepest, so few are used, which is what makes rounding cheap.
    """
    m = len(lengths)
    x = np.zeros(len(pats))
    if not len(pats):
        return x
    weight = np.concatenate([(lengths / lengths.max()) ** STEEP, [0]])
    ordered = np.sort(pats, axis=1)
    # squared norm of a column: a length that occurs k times in a pattern counts k^2
    norm = sum((weight[ordered[:, i]] * (ordered[:, i] == ordered[:, j]) for i in range(pats.shape[1]) for j in range(pats.shape[1])), np.zeros(len(pats)))
    residual = np.concatenate([counts, [0]]).astype(float)
    least = None
    for _ in range(rounds):
        step = np.maximum((weight * residual)[pats].sum(axis=1) / norm, -x)
        gain = step * step * norm
        least = gain.max() * 1e-12 if least is None else least
        order = np.argsort(-gain, kind="stable")[: 8 * m]
        used, now = bytearray(m + 1), []
        for j, places in zip(order.tolist(), pats[order].tolist()):
            if gain[j] <= max(least, 1e-9):
                break
            if not any(used[i] for i in places if i < m):
                for i in places:
                    used[i] = 1
                now.append(j)
        if not now:
            break
        x[now] += step[now]
        np.subtract.at(residual, pats[now], step[now][:, None])
        residual[m] = 0
    return x


def best_fit(counts: dict[int, int], capacity: int, begun: list[tuple[Contents, int]] = ()) -> list[tuple[Contents, int]]:
    """Sequences as (contents, how many alike): ``counts`` pieces a length, longest first, each into the smallest gap that holds it.

    ``begun``: sequences that may have gaps left. Alike sequences are handled together.
    """
    open_: dict[int, list[tuple[Contents, int]]] = {}
    gaps: list[int] = []
    done = []

    def put(contents: Contents, gap: int, n: int) -> None:
        if not gap:
            done.append((contents, n))
            return
        if gap not in open_:
            insort(gaps, gap)
        open_.setdefault(gap, []).append((contents, n))

    for contents, n in begun:
        put(contents, capacity - sum(size * k for size, k in contents), n)
    for size in sorted(counts, reverse=True):
        c = counts[size]
        while c:
            i = bisect_left(gaps, size)
            if i < len(gaps):
                gap = gaps[i]
                contents, n = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap], gaps[i]
            else:
                gap, contents, n = capacity, (), -(-c // (capacity // size))
            k = gap // size
            full, rest = min(n, c // k), 0
            if full < n:
                rest = c - full * k
                if n > full + (rest > 0):
                    put(contents, gap, n - full - (rest > 0))
            if full:
                put((*contents, (size, k)), gap - k * size, full)
            if rest:
                put((*contents, (size, rest)), gap - rest * size, 1)
            c -= full * k + rest
    return done + [x for some in open_.values() for x in some]


class Plan:
    """Places for all pieces of a histogram {length: count}.

    Fitted counts below a limit lose most by rounding, so several limits are tried and the one that
    needs fewest sequences stays.
    """

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY, depth: int = DEPTH, waste: float = WASTE):
        if any(not 0 < size <= capacity for size in histogram):
            raise ValueError(f"lengths must lie between 1 and {capacity}")
        left = {size: n for size, n in sorted(histogram.items()) if n}
        lengths, counts = np.array([*left], np.int64), np.array([*left.values()], np.float64)
        pats = patterns(lengths, capacity, depth, waste)
        x = fit_counts(pats, lengths, counts)
        best = None
        for least in (1, 2, 4, 8):
            begun, rest = self._round(np.where(x >= least, x, 0), pats, lengths, left)
            classes = best_fit(rest, capacity, begun)
            n = sum(k for _, k in classes)
            if best is None or n < best[0]:
                best = n, classes, sum(k for _, k in begun)
        self.sequences, self.classes, self.fitted = best
        slots, low, base = [], dict.fromkeys(histogram, 0), 0
        for contents, n in self.classes:
            at = 0
            for size, times in contents:
                slots.append((size, low[size], times, base, at))
                low[size] += n * times
                at += size * times
            base += n
        by = np.array(sorted(slots), np.int64).reshape(-1, 5)
        self.size, self.low, self.times, self.base, self.at = (np.ascontiguousarray(c) for c in by.T)
        self.first = np.searchsorted(self.size, np.arange(capacity + 2))

    @staticmethod
    def _round(x: np.ndarray, pats: np.ndarray, lengths: np.ndarray, histogram: dict[int, int]) -> tuple[list[tuple[Contents, int]], dict[int, int]]:
        """Sequences of the patterns at their counts rounded down, largest first and never over the histogram, and what it has left."""
        begun, left = [], dict(histogram)
        order = np.argsort(-x, kind="stable")
        for j in order[: np.count_nonzero(x >= 1)].tolist():
            sizes, k = np.unique(lengths[pats[j][pats[j] < len(lengths)]], return_counts=True)
            contents = tuple(zip(sizes[::-1].tolist(), k[::-1].tolist()))
            n = min([int(x[j] + 1e-6), *(left[size] // times for size, times in contents)])
            if n:
                begun.append((contents, n))
                for size, times in contents:
                    left[size] -= n * times
        return begun, left

    def place(self, size: np.ndarray, ordinal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces by length and ordinal among those of their length."""
        order = np.lexsort((ordinal, size))
        slot = np.empty(len(size), np.int64)
        for value in np.unique(size).tolist():
            a, b = np.searchsorted(size[order], [value, value + 1])
            lo, hi = self.first[value], self.first[value + 1]
            slot[order[a:b]] = lo + np.searchsorted(self.low[lo:hi], ordinal[order[a:b]], side="right") - 1
        j = ordinal - self.low[slot]
        times = self.times[slot]
        return self.base[slot] + j // times, self.at[slot] + size * (j % times)


@lru_cache(maxsize=2)
def encoder(path: str) -> StemIds:
    """Encodes texts with the tokenizers library; ids are little-endian 32-bit integers."""
    model, tokens = byte_level(path)
    sizes = np.array([len(t) for t in tokens])
    ids = lambda text: model.encode_batch_fast([text], add_special_tokens=False)[0].ids
    return StemIds(lambda units: encode_units(units, ids, sizes), REMEMBERED)


def lots(batch: pa.RecordBatch, column: int, size: int = LOT) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices whose values of ``column`` have some ``size`` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
    cuts = [*np.flatnonzero(np.diff(ends // size, prepend=-1)).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]))


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text), a scratch table: (part, nth, doc_id, piece, start, length, ids, ids_crc32).

    A document is its ids and ``end_id``; of one over ``capacity`` the first piece takes what full ones leave. ``nth`` counts the
    pieces of a length in the task ``part``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, bpe, seen = TaskContext.get().partitionId(), encoder(tokenizer), [0] * (capacity + 1)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for some in lots(batch, 1):
                rows, held = [], []
                for i, ids in enumerate(bpe.of(some.column(1))):
                    ids += end
                    n = len(ids) // 4
                    first = (n - 1) % capacity + 1
                    held.append(ids)
                    for piece, (a, b) in enumerate(zip((0, *range(first, n, capacity)), range(first, n + 1, capacity))):
                        rows.append((i, seen[b - a], piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
                        seen[b - a] += 1
                at, nth, piece, start, length, crc = map(np.array, zip(*rows))
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(held), "<i4")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), part, np.int32)), pa.array(nth), some.column(0).take(pa.array(at)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), ids, pa.array(crc)],
                    names=["part", "nth", "doc_id", "piece", "start", "length", "ids", "ids_crc32"],
                )

    return written(docs.select("doc_id", "text").mapInArrow(run, f"part int, nth long, doc_id {kind}, piece int, start long, length long, ids array<int>, ids_crc32 long"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, depth: int = DEPTH, waste: float = WASTE) -> DataFrame:
    """(sequence_id, offset) beside the columns of ``pieces`` (part, nth, length and any others; ``pieces_of`` makes them).

    (part, length) groups must number their rows in ``nth`` from 0 without gaps. A sequence holds at most ``capacity`` tokens and its
    pieces lie in it one after the other. Repeated rows are pieces of their own; ties among pieces of a length are settled by
    (part, nth); an empty table gives none.
    """
    ends = written(pieces.groupBy("length", "part").agg(F.count("*").alias("n")))
    plan = Plan({r["length"]: r["n"] for r in ends.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity, depth, waste)  # a row a length
    # a row for each task and length
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = ends.select(F.col("length").alias("__length"), F.col("part").alias("__part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(size: pd.Series, ordinal: pd.Series) -> pd.DataFrame:
        sequence, offset = plan.place(size.to_numpy(), ordinal.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    found = pieces.join(base, (F.col("part") == F.col("__part")) & (F.col("length") == F.col("__length")))
    found = found.withColumn("__at", place("length", F.col("nth") + F.col("__base")))
    return found.select(*pieces.columns, "__at.sequence_id", "__at.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, starts): the packed sequences themselves, where each piece begins, and whose it is."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))  # at most ``capacity`` pieces
    return packed.groupBy("sequence_id").agg(inside.alias("x")).select("sequence_id", F.flatten("x.ids").alias("ids"), F.col("x.doc_id").alias("doc_ids"), F.col("x.offset").alias("starts"))


def op11_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pieces_of(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return pack(pieces.drop("ids")).drop("part", "nth")
