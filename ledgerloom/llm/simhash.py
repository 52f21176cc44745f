"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments. Two fingerprints that differ in at most two bits agree
in one whole segment, and the next segment differs in at most two bits. The perfect (23,12) Golay code
turns the latter into equality: vectors within two bits of each other share a codeword within four bits
of both, and a vector has at most six such codewords. So the key is (whole segment, codeword index of the
next one): 3 to 18 keys for a fingerprint, each of 33 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, table, written

SHINGLE = 3
SEED = 42
MAX_BITS = 2
#: Buckets up to this many distinct fingerprints are compared pair by pair; larger ones by common centres.
PAIRWISE = 64
#: Generator polynomial of the binary Golay code (fixed value).
GOLAY = 0b101011100011
SEGMENTS = ((0, 22), (22, 21), (43, 21))

_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORD = re.compile(rb"[^ \t-\r]+")


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Unsigned SimHash of a whole text. Null, empty and blank texts have fingerprint zero."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").translate(_UPPER).split()
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if n > size:
        a, b = starts[: n - size + 1].tolist(), ends[size - 1 :].tolist()
        h = xxhash.xxh64_intdigest
        ones, total = np.zeros(64, np.int64), n - size + 1
        for lo in range(0, total, 1 << 16):  # blocks bound the memory of a very long text
            hashes = np.fromiter((h(line[i:j], SEED) for i, j in zip(a[lo : lo + (1 << 16)], b[lo : lo + (1 << 16)])), np.uint64)
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        bits = 2 * ones > total
        return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    return xxhash.xxh64_intdigest(line, SEED)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` (doc_id and the text) -> (doc_id, text_hash, fp): the fingerprint as a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_hash": b["text_hash"], "fp": [_signed(fingerprint(t)) for t in b["text"]]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")).mapInPandas(run, f"doc_id {kind}, text_hash long, fp long")


def _syndromes(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.int64).copy()
    for shift in range(11, -1, -1):
        x ^= np.where(x >> (shift + 11) & 1, GOLAY << shift, 0)
    return x


def golay_errors() -> np.ndarray:
    """For each syndrome the error patterns of weight four or less (one, or six): shape (2048, 6), -1 where absent."""
    from itertools import combinations

    out, used = np.full((2048, 6), -1, np.int64), np.zeros(2048, int)
    patterns = np.array([sum(1 << i for i in c) for w in range(5) for c in combinations(range(23), w)])
    for s, e in zip(_syndromes(patterns).tolist(), patterns.tolist()):
        out[s, used[s]] = e
        used[s] += 1
    return out


def fuzzy_keys(fps: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """Keys of fingerprints (uint64): shape (n, 18), -1 where a slot is empty."""
    parts = [(fps >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    keys = []
    for i in range(3):
        near = parts[(i + 1) % 3]
        e = errors[_syndromes(near)]
        index = (near[:, None] ^ e) >> 11  # a codeword is told by its 12 information bits
        keys.append(np.where(e >= 0, (np.int64(i) << 40) | (parts[i][:, None] << 12) | index, -1))
    return np.concatenate(keys, axis=1)


def links(distinct: DataFrame, pairwise: int = PAIRWISE) -> DataFrame:
    """Edges (a, b) that connect the fingerprints (column ``fp``, distinct) just as the pairs within two bits do.

    Small buckets give their verified pairs. In a bucket of more than ``pairwise`` fingerprints all pairs
    would be too many; there each fingerprint is dealt to the 65 values within one bit of it. Two
    fingerprints are within two bits exactly if they share such a centre, and a centre holds at most
    65 distinct fingerprints, so the work stays linear and no link is lost.
    """

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        errors = golay_errors()
        for b in batches:
            fp = b["fp"].to_numpy(np.int64)
            keys = fuzzy_keys(fp.view(np.uint64), errors)
            row, slot = np.nonzero(keys >= 0)
            yield pd.DataFrame({"key": keys[row, slot], "fp": fp[row]})

    keys = written(distinct.select("fp").mapInPandas(keyed, "key long, fp long"))
    sizes = written(keys.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"))
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_BITS
    twos = sizes.where("n = 2").where(near("a", "b")).select("a", "b")
    small = written(keys.join(sizes.where(F.col("n").between(3, pairwise)).select("key"), "key"))
    left, right = small.withColumnRenamed("fp", "a"), small.withColumnRenamed("fp", "b")
    some = left.join(right, "key").where((F.col("a") < F.col("b")) & near("a", "b")).select("a", "b")
    large = written(keys.join(sizes.where(F.col("n") > pairwise).select("key"), "key").select("fp").distinct())
    centre = F.expr("explode(concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))))")
    balls = large.select("fp", centre.alias("c")).groupBy("c").agg(F.collect_set("fp").alias("s")).where(F.size("s") > 1)
    many = balls.select(F.array_min("s").alias("a"), F.explode("s").alias("b")).where("a <> b")
    return written(twos.union(some).union(many).distinct())


def simhash_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fingerprint, component_id, kept) for each row of ``docs`` (doc_id, text).

    Texts whose fingerprints differ in two bits or fewer are linked; a component is named by its smallest
    doc_id, and that row is kept. Null, empty and blank texts share fingerprint zero and are linked to each
    other. Texts of fewer than three words hash as a whole. Rows that repeat a doc_id share its component;
    a null doc_id joins its component but never names it, unless all of it is null. An empty table gives no rows. Very long texts are
    hashed whole. A bit that half of the hashes have, no more, is 0.
    """
    prints = written(fingerprints(docs))
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumnRenamed("fp", "node"))
    found = written(components(nodes, links(nodes.select(F.col("node").alias("fp")))).withColumnRenamed("node", "fp"))
    return prints.join(found, "fp").select(
        "doc_id",
        "text_hash",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text_hash")
