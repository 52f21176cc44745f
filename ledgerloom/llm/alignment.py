"""Links between the tokens of two tokenizers, and how many documents of the corpus hold each pair.

Every task aligns its documents and, a million or so records (pair, document, links) at a time, radix-partitions them by the A id into
buckets; a bucket's records are sorted side-major (A id, B id, document) and spilled as a zstd run to the shared folder. A run's
head, its pairs and in how many documents each lies, is all that counting needs: heads are merged k-way, a heap giving the key up to
which every run is read, until one table of counts a bucket is left, in which all of an A id's pairs follow each other, so its maximum
falls out of the same pass. At last the counts stream past the runs again, a slice of runs at a time, and each document's share is
added up. Nothing depends on how often a pair occurs: a bucket's counts are bounded by the vocabularies, a run by its size.
"""

from __future__ import annotations

import heapq
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from math import ceil

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import _field
from .common import own_prefix, shuffle_partitions, table, written
from .units import Units, byte_level, check_pieces, cut_ids, stand_together

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Buckets of A ids; records of a run, at least; entries of a compressed block; runs that are merged at once; runs of a slice.
BUCKETS, RECORDS, BLOCK, FAN, SLICE = 128, 1 << 20, 1 << 14, 64, 8
#: Rows aligned at once; distinct units that a worker remembers; links of a group from which on its distinct ids are counted instead.
ROWS, REMEMBERED, PAIRS = 128, 400_000, 4096


class Aligner:
    """Both tokenizers and what they make of the units of texts."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a, self.a_bytes = byte_level(a_path)
        with open(b_path, "rb") as f:
            model = f.read()
        # the last setting of a field counts: units carry their own space
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model + _field(3, _field(3, 0)))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        check_pieces([p for i, p in enumerate(pieces) if not self.b.is_byte(i)])
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in tokens]) for tokens in (self.a_bytes, self.b_bytes))
        self.a_texts, self.b_texts = ([str(i) for i in range(len(tokens))] for tokens in (self.a_bytes, self.b_bytes))
        self.sizes = len(self.a_bytes), len(self.b_bytes)
        self.units = Units(self._learn, self._clear, REMEMBERED)
        self._clear()

    def _clear(self) -> None:
        self.groups: list[str | None] = []  # of each unit; null where a tokenizer changes its bytes
        self.numbers, self.sizes_of, self.codes, self.times = (array("q") for _ in range(4))

    def _learn(self, units: list[str]) -> list[int]:
        """Numbers of the units, whose groups and pairs are held from now on. Most are aligned together, as one text."""
        out = [0] * len(units)
        lots, alone = stand_together(units)
        for held in lots:
            first = len(self.groups)
            if self._together([units[i] for i in held]):
                for k, i in enumerate(held):
                    out[i] = first + k
            else:
                alone += held
        for i in alone:
            out[i] = len(self.groups)
            text, numbers, codes, times = self._whole(units[i]) or (None, (0, 0, 0, 0), [], [])
            self.groups.append(text)
            self.numbers.extend(numbers)
            self.sizes_of.append(len(codes))
            self.codes.extend(codes)
            self.times.extend(times)
        return out

    def _together(self, units: list[str]) -> bool:
        """Align units that may stand after one another; False, and nothing held, where they have to be looked at one by one."""
        text = "".join(units)
        x, y = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text)
        raw = text.encode()
        if b"".join(map(self.a_bytes.__getitem__, x)) != raw or b"".join(map(self.b_bytes.__getitem__, y)) != raw:
            return False
        a, b = np.array(x), np.array(y)
        a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_cut, b_cut = cut_ids(a_end, units), cut_ids(b_end, units)
        if a_cut is None or b_cut is None:
            return False
        both = np.intersect1d(a_end, b_end, assume_unique=True)
        p, q = np.searchsorted(a_end, both, side="right"), np.searchsorted(b_end, both, side="right")
        n, m = np.diff(p, prepend=0), np.diff(q, prepend=0)
        links = n * m
        if links.max() > PAIRS:
            return False
        # every pair of a group's tokens
        group = np.repeat(np.arange(len(both)), links)
        t = np.arange(len(group)) - np.repeat(np.cumsum(links) - links, links)
        codes = a[(p - n)[group] + t // m[group]] * self.sizes[1] + b[(q - m)[group] + t % m[group]]
        texts, i, j = [], 0, 0
        a_text, b_text = list(map(self.a_texts.__getitem__, x)), list(map(self.b_texts.__getitem__, y))
        for e, f in zip(p.tolist(), q.tolist()):
            texts.append(f"{a_text[i]}|{b_text[j]}" if e - i == f - j == 1 else ",".join(a_text[i:e]) + "|" + ",".join(b_text[j:f]))
            i, j = e, f
        g = np.searchsorted(p, a_cut, side="right")
        ends = [0, *g.tolist()]
        self.groups.extend(";".join(texts[i:j]) for i, j in zip(ends, ends[1:]))
        upto = np.concatenate([[0], np.cumsum(links)])[g]
        size = np.diff(upto, prepend=0)
        numbers = np.stack([np.diff(a_cut, prepend=0), np.diff(b_cut, prepend=0), np.diff(g, prepend=0), size], axis=1)
        for held, values in ((self.numbers, numbers), (self.sizes_of, size), (self.codes, codes), (self.times, np.ones_like(codes))):
            held.frombytes(np.ascontiguousarray(values, np.int64).tobytes())
        return True

    def align(self, x: list[int], y: list[int]) -> tuple[str, tuple[int, int, int, int], list[int], list[int]]:
        """(groups as text, (A tokens, B tokens, groups, links), pair codes, links of each) of two token lists over the same bytes."""
        cuts, i, j = [], 0, 0
        a_at = b_at = 0
        while i < len(x) or j < len(y):  # the side that is behind goes on
            if a_at <= b_at:
                a_at += len(self.a_bytes[x[i]])
                i += 1
            else:
                b_at += len(self.b_bytes[y[j]])
                j += 1
            if a_at == b_at:
                cuts.append((i, j))
        texts, links, count, i, j = [], 0, Counter(), 0, 0
        for p, q in cuts:
            texts.append(",".join(map(str, x[i:p])) + "|" + ",".join(map(str, y[j:q])))
            links += (p - i) * (q - j)
            if p - i == q - j == 1:
                count[x[i], y[j]] += 1
            else:
                of_b = Counter(y[j:q])
                for k, n in Counter(x[i:p]).items():
                    for m, o in of_b.items():
                        count[k, m] += n * o
            i, j = p, q
        return ";".join(texts), (len(x), len(y), len(cuts), links), [k * self.sizes[1] + m for k, m in count], [*count.values()]

    def _whole(self, text: str) -> tuple[str, tuple[int, int, int, int], list[int], list[int]] | None:
        """A text, or a unit, by itself; None where a tokenizer changes its bytes."""
        x, y = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text)
        raw = text.encode()
        if b"".join(map(self.a_bytes.__getitem__, x)) == raw == b"".join(map(self.b_bytes.__getitem__, y)):
            return self.align(x, y)
        return None

    def texts(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(groups, numbers [text, 4]) of each text, and its records: number of the text, pair code, links."""
        spaced = [" " + t if t else "" for t in texts]
        found = self.units.of(spaced)
        groups, numbers, doc, code, times = [], np.zeros((len(texts), 4), np.int64), [], [], []
        # views: gone by the next call, which may append
        codes, each, size, of_unit = (np.frombuffer(x, np.int64) if x else np.zeros(0, np.int64) for x in (self.codes, self.times, self.sizes_of, self.numbers))
        start, of_unit = np.cumsum(size) - size, of_unit.reshape(-1, 4)
        for t, units in enumerate(found):
            parts = list(map(self.groups.__getitem__, units))
            if None in parts:
                whole = self._whole(spaced[t])
                if whole:
                    groups.append(whole[0])
                    numbers[t] = whole[1]
                    doc.append(np.full(len(whole[2]), t))
                    code.append(np.array(whole[2], np.int64))
                    times.append(np.array(whole[3], np.int64))
                else:
                    groups.append("")
                continue
            groups.append(";".join(parts))
            if units:
                u = np.array(units)
                numbers[t] = of_unit[u].sum(axis=0)
                u, often = np.unique(u, return_counts=True)
                n = size[u]
                at = np.repeat(start[u] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                doc.append(np.full(len(at), t))
                code.append(codes[at])
                times.append(each[at] * np.repeat(often, n))
        doc, code, times = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (doc, code, times))
        # a record for each text and pair
        order = np.lexsort((code, doc))
        doc, code, times = doc[order], code[order], times[order]
        new = np.nonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])]))[0] if len(doc) else np.zeros(0, np.int64)
        return groups, numbers, doc[new], code[new], np.add.reduceat(times, new) if len(new) else times


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


# runs: blocks of (length, zstd of the columns), each column little-endian longs or the narrowest type that holds it ----------------------
def _pack(*columns: np.ndarray) -> bytes:
    parts, kinds = [], []
    for c in columns:
        kind = np.min_scalar_type(int(c.max())) if len(c) else np.dtype("u1")
        kinds.append(kind.itemsize)
        parts.append(c.astype(kind.newbyteorder("<")).tobytes())
    head = np.array([len(columns[0]), *kinds], "<u4").tobytes()
    body = zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))
    return np.array([len(body)], "<u4").tobytes() + body


def write_blocks(keys: np.ndarray, *columns: np.ndarray, size: int = BLOCK) -> bytes:
    """Ascending ``keys`` and columns of non-negative integers beside them."""
    out = []
    for lo in range(0, len(keys), size):
        some = keys[lo : lo + size]
        out.append(_pack(np.diff(some, prepend=0), *(c[lo : lo + size] for c in columns)))
    return b"".join(out)


def _unpack(blob: bytes, width: int) -> Iterator[list[np.ndarray]]:
    """The ``width`` columns of each block in turn."""
    at = 0
    while at < len(blob):
        n = int.from_bytes(blob[at : at + 4], "little")
        raw = zstandard.ZstdDecompressor().decompress(blob[at + 4 : at + 4 + n])
        at += 4 + n
        rows, *kinds = np.frombuffer(raw, "<u4", width + 1).tolist()
        place, found = 4 * (width + 1), []
        for kind in kinds:
            found.append(np.frombuffer(raw, f"<u{kind}", rows, place).astype(np.int64))
            place += kind * rows
        yield found


def read_blocks(blob: bytes, width: int) -> Iterator[list[np.ndarray]]:
    """[keys, columns ...] of each block in turn; ``width``: columns, the keys included."""
    for keys, *columns in _unpack(blob, width):
        yield [np.cumsum(keys), *columns]


def merge_runs(blobs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ascending (keys, summed counts) of runs of (key, count), a block of each in memory at a time.

    The heap's least block end is the key up to which all runs are known; that much of each is taken and summed.
    """
    runs = [read_blocks(b, 2) for b in blobs]
    held: list[list[np.ndarray]] = [next(r, []) for r in runs]
    heap = [(int(h[0][-1]), k) for k, h in enumerate(held) if h]
    heapq.heapify(heap)
    while heap:
        end, _ = heap[0]
        keys, counts = [], []
        for k, h in enumerate(held):
            if h:
                n = int(np.searchsorted(h[0], end, side="right"))
                keys.append(h[0][:n])
                counts.append(h[1][:n])
                held[k] = [c[n:] for c in h]
        while heap and heap[0][0] == end:
            _, k = heapq.heappop(heap)
            held[k] = next(runs[k], [])
            if held[k]:
                heapq.heappush(heap, (int(held[k][0][-1]), k))
        key, count = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
        new = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
        yield key[new], np.add.reduceat(count, new)


def with_maxima(merged: Iterator[tuple[np.ndarray, np.ndarray]], b_size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, counts, 1 where the count is its A id's highest): blocks that end where an A id ends; one id's pairs are at most ``b_size``."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def judged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        side = keys // b_size
        new = np.nonzero(np.concatenate([[True], side[1:] != side[:-1]]))[0]
        most = np.repeat(np.maximum.reduceat(counts, new), np.diff(np.append(new, len(keys))))
        return keys, counts, (counts == most).astype(np.int64)

    for k, c in merged:
        keys, counts = np.concatenate([keys, k]), np.concatenate([counts, c])
        end = int(np.searchsorted(keys, keys[-1] // b_size * b_size))  # the last id may go on
        if end:
            yield judged(keys[:end], counts[:end])
            keys, counts = keys[end:], counts[end:]
    if len(keys):
        yield judged(keys, counts)


# Spark ----------------------------------------------------------------------------------------------------------------------------------
def aligned(docs: DataFrame, a_path: str, b_path: str, records: int = RECORDS, with_groups: bool = True) -> tuple[DataFrame, DataFrame]:
    """Aligns ``docs`` (text last, any columns before it). Two scratch tables:

    (uid, the other columns, n_a, n_b, n_groups, n_links, groups_sha256, groups if ``with_groups``) of each row, and the runs (run, bucket, base, n_docs, head, body):
    ``head`` holds the bucket's pairs and the number of the run's texts with each, ``body`` for each pair and text the text's uid
    less ``base`` and its links.
    """
    others = docs.columns[:-1]
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    of_docs = [*((c, docs.schema[c].dataType.simpleString()) for c in others), ("uid", "long"), *((c, "long") for c in counts), ("groups_sha256", "string")] + [("groups", "string")] * with_groups
    of_runs = [("run", "string"), ("bucket", "int"), ("base", "long"), ("n_docs", "long"), ("head", "binary"), ("body", "binary")]
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, part, number = aligner(a_path, b_path), TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0
        uid = base = part << 33
        kinds = {}

        def rows(size: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
            made = {"kind": pa.array(np.full(size, int("run" in columns), np.int32))}
            for c, kind in kinds.items():
                made[c] = columns[c] if c in columns else pa.nulls(size, kind)
            return pa.RecordBatch.from_arrays([*made.values()], names=[*made])

        def spill() -> Iterator[pa.RecordBatch]:
            doc, code, times = (np.concatenate(c) for c in zip(*held))
            bucket = code // both.sizes[1] % BUCKETS
            # side-major; documents ascend already
            order = np.argsort(bucket * (both.sizes[0] * both.sizes[1]) + code, kind="stable")
            doc, code, times, bucket = doc[order], code[order], times[order], bucket[order]
            ends = np.searchsorted(bucket, np.arange(BUCKETS + 1)).tolist()
            for k, (i, j) in enumerate(zip(ends, ends[1:])):
                if j > i:
                    keys, often = np.unique(code[i:j], return_counts=True)
                    body = b"".join(_pack(doc[lo : min(j, lo + BLOCK)], times[lo : min(j, lo + BLOCK)]) for lo in range(i, j, BLOCK))
                    values = (f"{part}-{number}", k, base, uid - base, write_blocks(keys, often), body)
                    yield rows(1, {c: pa.array([v], types[kind]) for (c, kind), v in zip(of_runs, values)})

        for batch in batches:
            kinds = kinds or {c: batch.schema.field(c).type if c in others else types[kind] for c, kind in of_docs + of_runs}
            for lo in range(0, batch.num_rows, ROWS):
                some = batch.slice(lo, ROWS)
                groups, numbers, doc, code, times = both.texts(some.column(len(others)).to_pylist())
                uids = np.arange(uid, uid + len(groups))
                own = {c: some.column(i) for i, c in enumerate(others)}
                yield rows(len(groups), own | {"uid": pa.array(uids), "groups": pa.array(groups, pa.string()), "groups_sha256": pa.array([sha256(g.encode()).hexdigest() if g else "" for g in groups], pa.string())} | {c: pa.array(numbers[:, i]) for i, c in enumerate(counts)})
                held.append((uids[doc] - base, code, times))
                uid += len(groups)
                n += len(doc)
                if n >= records:
                    yield from spill()
                    held, n, base, number = [], 0, uid, number + 1
        if n:
            yield from spill()

    kinds = ", ".join(f"`{c}` {kind}" for c, kind in [("kind", "int"), *of_docs, *of_runs])
    both = written(docs.mapInArrow(run, kinds), "kind")
    return both.where("kind = 0").select(*(c for c, _ in of_docs)), both.where("kind = 1").select(*(c for c, _ in of_runs))


def pair_counts(runs: DataFrame, n_runs: int, b_size: int) -> DataFrame:
    """(bucket, counts): a bucket's pairs with their documents and whether they are their A id's best, as blocks. Runs are merged ``FAN`` at a time."""

    def merging(last: bool):
        def merge(some: pd.DataFrame) -> pd.DataFrame:
            merged = merge_runs(some["head"].tolist())
            blobs = [write_blocks(*x) for x in (with_maxima(merged, b_size) if last else merged)]
            return pd.DataFrame({"run": [str(some["group"].iloc[0])], "bucket": [some["bucket"].iloc[0]], "head": [b"".join(blobs)]})

        return merge

    heads, level = runs.select("run", "bucket", "head"), 0
    while True:
        groups = ceil(n_runs / FAN)
        last = groups <= 1
        level += 1

        by = heads.withColumn("group", F.pmod(F.xxhash64("run", F.lit(level)), F.lit(max(1, groups))))
        heads = written(by.groupBy("bucket", "group").applyInPandas(merging(last), "run string, bucket int, head binary"))
        if last:
            return heads.select("bucket", F.col("head").alias("counts"))
        n_runs = groups


def shares(runs: DataFrame, counts: DataFrame, n_runs: int) -> DataFrame:
    """(uid, n_best, count_sum) of each text with links. A slice of runs meets the counts bucket by bucket; both stream."""
    slices = ceil(n_runs / SLICE) or 1
    binary = lambda c=None: (F.lit(None) if c is None else F.col(c)).cast("binary")
    of_runs = runs.select(F.pmod(F.xxhash64("run"), F.lit(slices)).alias("slice"), "bucket", F.lit(1).alias("turn"), "run", "base", "n_docs", "head", "body", binary().alias("counts"))
    to_all = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice")
    of_counts = counts.select(to_all, "bucket", F.lit(0).alias("turn"), F.lit(None).cast("string").alias("run"), F.lit(None).cast("long").alias("base"), F.lit(None).cast("long").alias("n_docs"), binary().alias("head"), binary().alias("body"), "counts")
    order = ["slice", "bucket", "turn"]
    met = of_runs.unionByName(of_counts).repartition(shuffle_partitions(runs.sparkSession), "slice").sortWithinPartitions(*order)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_ = known = None
        sums: dict[str, tuple[int, np.ndarray]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for base, s in sums.values():
                some = np.nonzero(s.any(axis=1))[0]
                yield pa.RecordBatch.from_arrays([pa.array(base + some), pa.array(s[some, 0]), pa.array(s[some, 1])], names=["uid", "n_best", "count_sum"])

        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i] for c in batch.schema.names}
                if r["slice"].as_py() != slice_:
                    yield from out()
                    slice_, sums = r["slice"].as_py(), {}
                if r["turn"].as_py() == 0:
                    blocks = list(read_blocks(r["counts"].as_py(), 3))
                    known = [np.concatenate(c) for c in zip(*blocks)]
                    continue
                if r["run"].as_py() not in sums:
                    sums[r["run"].as_py()] = r["base"].as_py(), np.zeros((r["n_docs"].as_py(), 2), np.int64)
                s = sums[r["run"].as_py()][1]
                keys, often = (np.concatenate(c) for c in zip(*read_blocks(r["head"].as_py(), 2)))
                at = np.repeat(np.searchsorted(known[0], keys), often)
                done = 0
                for doc, links in _unpack(r["body"].as_py(), 2):
                    here = at[done : done + len(doc)]
                    done += len(doc)
                    np.add.at(s[:, 0], doc, links * known[2][here])
                    np.add.at(s[:, 1], doc, links * known[1][here])
        yield from out()

    return met.mapInArrow(add, "uid long, n_best long, count_sum long")


def align_corpus(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, keep: tuple[str, ...] = ("doc_id",), records: int = RECORDS, with_groups: bool = True) -> DataFrame:
    """(``keep``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups) of each row of ``docs`` (text and ``keep``).

    groups: ``a1,a2|b1;a3|b2,b3``, the ids of each group in order, left out without ``with_groups``; its digest is '' where it is empty.

    Texts that are null, empty or changed by a tokenizer have no tokens: zeros and empty groups. Repeated rows count as documents of
    their own. Texts are aligned whole, however long; a group is counted by distinct ids, so a long stretch without a common
    boundary costs its distinct pairs. Ties for an A id's highest count are all best. An empty table gives none.
    """
    a_path, b_path = a_path or public_tokenizers.path(A_FILE), b_path or public_tokenizers.path(B_FILE)
    mark = own_prefix(docs)
    kept = {f"{mark}{i}": c for i, c in enumerate(keep)}
    found, runs = aligned(docs.select(*[F.col(c).alias(m) for m, c in kept.items()], "text"), a_path, b_path, records, with_groups)
    n_runs = runs.select("run").distinct().count()
    gained = shares(runs, pair_counts(runs, n_runs, aligner(a_path, b_path).sizes[1]), n_runs)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    out = found.join(written(gained), "uid", "left")
    return out.select(*kept, "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256", *["groups"] * with_groups).withColumnsRenamed(kept)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_corpus(table(spark, sf_dir, "documents"), with_groups=False)
