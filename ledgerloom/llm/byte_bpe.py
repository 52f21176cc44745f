"""Byte-level BPE through a sentencepiece model that is serialised straight from a rank file.

Every token's bytes are written with one printable character a byte, its score is its negative rank, and
normalisation is the identity, so sentencepiece's merge order (best score, leftmost first) is the order of
ranks. Each match of the pre-token pattern is encoded on its own; a match that is itself a token is that
token, as in the reference encoder. Decoding maps ids back to bytes.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

RANKS = "byte_bpe_50k.tiktoken"
#: Rows handled at once, and distinct pieces of text remembered by a worker: both bound memory only.
ROWS, REMEMBERED = 128, 250_000


def byte_alphabet() -> str:
    """A printable character for each byte: itself where printable in Latin-1, else the next free one from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return "".join(chr(b if b in plain else next(spare)) for b in range(256))


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """A protobuf field: bytes, a varint or a 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank. Ranks must be 0, 1, 2, ... without gaps."""
    with open(path, "rb") as f:
        found = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in f if line.strip())}
    return [found[i] for i in range(len(found))]


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised BPE model whose piece ids are the ranks; one unknown piece follows them."""
    alphabet = byte_alphabet()
    spell = lambda t: "".join(alphabet[b] for b in t).encode()
    pieces = [_field(1, spell(t)) + _field(2, -float(i)) for i, t in enumerate(tokens)]
    pieces.append(_field(1, "⁇unknown".encode()) + _field(2, 0.0) + _field(3, 2))
    negative = (1 << 64) - 1  # -1: the model has no such piece
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(tokens)) + b"".join(_field(n, negative) for n in (41, 42, 43)) + _field(45, "⁇unknown".encode())
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normalizer)


class ByteBpe:
    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        self.tokens = read_ranks(path)
        self.whole = {t: i for i, t in enumerate(self.tokens)}
        self.split = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.tokens))
        self.to_piece = {b: ord(c) for b, c in enumerate(byte_alphabet())}
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.sizes = np.fromiter(map(len, self.tokens), np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.gaps = re.compile(r"\s\s").search
        self.known: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        """Remember the ids of pre-tokens."""
        rest = []
        for w in words:
            if (i := self.whole.get(w.encode("utf-8"))) is not None:
                self.known[w] = struct.pack("<i", i)
            else:
                rest.append(w)
        spelt = [w.encode("utf-8").decode("latin-1").translate(self.to_piece) for w in rest]
        for w, ids in zip(rest, self.model.encode(spelt, num_threads=1) if rest else ()):
            self.known[w] = struct.pack(f"<{len(ids)}i", *ids)

    def _ids(self, parts: list[list[str]]) -> list[bytes]:
        """Little-endian ids of texts that have been cut into pre-tokens."""
        if new := set(chain.from_iterable(parts)).difference(self.known):
            self._learn(new)
        return [b"".join(map(self.known.__getitem__, words)) for words in parts]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids of each whole text; null is empty.

        A space between two other characters that aren't white space always begins a pre-token, so a text
        without white space of two or more can be cut there, and what follows each cut is encoded once
        while it is remembered. Any other text is matched as a whole.
        """
        if len(self.known) > REMEMBERED or len(self.units) > REMEMBERED:
            self.known.clear()
            self.units.clear()
        units, found, absent = self.units, [], []
        cut = [t.split(" ") if t and not self.gaps(t) else None for t in texts]
        for words in cut:
            found.append(list(map(units.get, words[1:])) if words else [])
            absent.append([i for i, x in enumerate(found[-1]) if x is None])
        if new := list({words[i + 1] for words, at in zip(cut, absent) for i in at}):
            units.update(zip(new, self._ids([self.split(" " + w) for w in new])))
        heads = self._ids([self.split(words[0]) if words else self.split(t or "") for words, t in zip(cut, texts)])
        for words, ids, at in zip(cut, found, absent):
            for i in at:
                ids[i] = units[words[i + 1]]
        return [np.frombuffer(head + b"".join(ids), "<i4") for head, ids in zip(heads, found)]

    def decode(self, ids: np.ndarray) -> bytes:
        out = []
        for lo in range(0, len(ids), 1 << 16):  # blocks bound the memory of a very long text
            some = ids[lo : lo + (1 << 16)]
            size = self.sizes[some]
            shift = self.starts[some] - (np.cumsum(size) - size)
            out.append(self.blob[np.repeat(shift, size) + np.arange(size.sum())].tobytes())
        return b"".join(out)


@lru_cache(maxsize=4)
def codec(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode_decode(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns of ``docs`` plus ids array<int> and decoded binary (the bytes those ids stand for).

    A null or empty text has no ids and decodes to nothing. Rows are independent: repeated ones give the same ids. Very long texts are encoded
    whole, in the memory of one row. An empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                found = bpe.encode(part.column(part.num_columns - 1).to_pylist())
                offsets = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(x) for x in found], out=offsets[1:])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids, pa.array([bpe.decode(x) for x in found], pa.binary())], names=[*keep, "ids", "decoded"])

    wanted = docs.select(*keep, F.col(text).alias("__text"))
    kinds = ", ".join(f"`{c}` {wanted.schema[c].dataType.simpleString()}" for c in keep)
    return wanted.mapInArrow(run, f"{kinds}, ids array<int>, decoded binary")


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """(doc_id, ``more``, n_tokens, ids_sha256, decoded_sha256) of what ``encode_decode`` returned."""
    return encoded.select(
        "doc_id",
        *more,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return digests(encode_decode(docs, public_tokenizers.path(RANKS), ["doc_id"]))
