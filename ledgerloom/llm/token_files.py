"""Token ids in Arrow stream files of fixed-size lists.

A part holds the ids of a range of documents in ascending order, cut into equal-length sequences: a column of
ids and a column of masks (false on the padding that ends the last sequence). All batches but the last of a
part have the same number of bytes, so sequence i is found by arithmetic and read without copying.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark import TaskContext

from .common import scratch_dir, shuffle_partitions, table, written

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Ids in a sequence; sequences in a batch.
LENGTH, BATCH = 2048, 64
REMEMBERED = 1_000_000


# How the vocabulary's file normalises and splits text. -------------------------------------------------------------------
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# ---------------------------------------------------------------------------------------------------------------------------------------


def may_cut(settings: dict) -> bool:
    """Whether a tokenizer file splits text as ``ChunkEncoder`` takes for granted: white space dropped, words lower-cased, letters,
    digits and marks apart, a word's end marked. Any other one encodes whole texts."""
    normalizer, before, model = settings["normalizer"] or {}, settings["pre_tokenizer"] or {}, settings["model"]
    first, *more = before.get("pretokenizers", [{}])
    return (
        normalizer.get("normalizers") == NORMALIZERS
        and (first.get("pattern"), first.get("behavior"), first.get("invert")) == ({"Regex": SPLIT}, "Removed", True)
        and [(x["type"], x["use_regex"], x["add_prefix_space"]) for x in more] == [("ByteLevel", False, False)]
        and (model["type"], model["end_of_word_suffix"], model["dropout"]) == ("BPE", "</w>", None)
    )


class ChunkEncoder:
    """Encodes whole texts with the tokenizers library, one blank-separated chunk at a time.

    The tokenizer drops white space and no pre-token holds any, so a text's ids are those of its chunks in
    turn; a worker encodes each distinct chunk once while it is remembered. It also lower-cases, and marks
    of punctuation that follow a letter form a pre-token of their own, so chunks that differ in such ways share their stem.
    """

    #: A private-use character between chunks that are encoded in one call; chunks that hold it go alone.
    MARK = "\ue000"
    PUNCTUATION = "!#$%&*,.:;?|"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            self.cuts = may_cut(json.load(f))
        self.kind = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        self.chunks: dict[str, bytes] = {"": b""}
        self.stems: dict[str, bytes] = {}
        self.mark = np.array(self._direct(self.MARK), self.kind)
        self.tails = {"": b""}
        vocabulary = self.model.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _direct(self, text: str) -> list[int]:
        return self.model.encode(text, add_special_tokens=False).ids

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _learn(self, stems: list[str]) -> None:
        """Remember the ids of stems. A stem of letters alone is one pre-token, which ends at the next word-final id."""
        letters = [w for w in stems if w.isalpha() and max(w) < "\u0100"]
        for lo in range(0, len(letters), 4096):
            some = letters[lo : lo + 4096]
            ids = np.array(self.model.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.kind)
            ends = ((np.nonzero(self.ends_word[ids])[0] + 1) * self.kind.itemsize).tolist()
            raw = ids.tobytes()
            if len(ends) == len(some):
                self.stems.update((w, raw[i:j]) for w, i, j in zip(some, [0, *ends], ends))
        plain = [w for w in stems if w not in self.stems and self.MARK not in w]
        for w in stems:
            if self.MARK in w:
                self.stems[w] = self._bytes(self._direct(w))
        width = len(self.mark)
        for lo in range(0, len(plain), 512):
            some = plain[lo : lo + 512]
            joined = f" {self.MARK} ".join(some)
            ids = np.array(self.model.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.kind)
            hit = np.ones(max(0, len(ids) - width + 1), bool)
            for i in range(width):
                hit &= ids[i : len(ids) - width + 1 + i] == self.mark[i]
            ends = np.nonzero(hit)[0]
            if len(ends) != len(some) - 1:  # cannot happen while the mark is a pre-token of its own
                self.stems.update((w, self._bytes(self._direct(w))) for w in some)
                continue
            raw, size = ids.tobytes(), self.kind.itemsize
            starts = [0, *((ends + width) * size).tolist()]
            for w, i, j in zip(some, starts, [*(ends * size).tolist(), len(raw)]):
                self.stems[w] = raw[i:j]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian ids of each text; null is empty."""
        if not self.cuts:
            return [self._bytes(e.ids) for e in self.model.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        split = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        if len(self.chunks) > REMEMBERED:
            self.chunks = {"": b""}
        if len(self.stems) > REMEMBERED or len(self.tails) > REMEMBERED:
            self.stems, self.tails = {}, {"": b""}
        chunks, stems = self.chunks, self.stems
        found = [list(map(chunks.get, words)) for words in split]
        absent = [[i for i, x in enumerate(ids) if x is None] for ids in found]
        stem_of = {}
        for w in {words[i] for words, at in zip(split, absent) for i in at}:
            low = w.lower() if w.isascii() or max(w) < "\u0100" else w
            stem = low.rstrip(self.PUNCTUATION)
            if not (stem and stem[-1].isalpha() and stem[-1] < "\u0100"):
                stem = low
            tail = low[len(stem) :]
            if tail not in self.tails:
                self.tails[tail] = self._bytes(self._direct(tail))
            stem_of[w] = stem, self.tails[tail]
        if new := list({stem for stem, _ in stem_of.values() if stem not in stems}):
            self._learn(new)
        for w, (stem, tail) in stem_of.items():
            chunks[w] = stems[stem] + tail
        for words, ids, at in zip(split, found, absent):
            for i in at:
                ids[i] = chunks[words[i]]
        return [b"".join(ids) for ids in found]


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def schema(kind: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Writes one part. Each attempt of a task has a file of its own, which the index names if that attempt counts."""

    def __init__(self, uri: str, kind: np.dtype, length: int = LENGTH, batch: int = BATCH):
        self.kind, self.length, self.batch = kind, length, batch
        self.fs, self.path = pafs.FileSystem.from_uri(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.sink = self.fs.open_output_stream(self.path)
        self.schema = schema(kind, length)
        self.out = pa.ipc.new_stream(self.sink, self.schema)
        self.held: list[bytes] = []
        self.size = self.total = 0

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.size += len(ids)
        self.total += len(ids) // self.kind.itemsize
        full = self.batch * self.length * self.kind.itemsize
        if self.size >= full:
            data = b"".join(self.held)
            cut = self.size // full * full
            for lo in range(0, cut, full):
                self._write(np.frombuffer(data, self.kind, full // self.kind.itemsize, lo), self.batch)
            self.held, self.size = [data[cut:]], self.size - cut

    def _write(self, ids: np.ndarray, rows: int) -> None:
        cells = rows * self.length
        mask = pa.array(np.arange(cells) < len(ids))
        ids = pa.array(np.concatenate([ids, np.zeros(cells - len(ids), self.kind)]))
        self.out.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(ids, self.length), pa.FixedSizeListArray.from_arrays(mask, self.length)], schema=self.schema))

    def close(self) -> None:
        data = b"".join(self.held)
        if data:
            ids = np.frombuffer(data, self.kind)
            self._write(ids, -(-len(ids) // self.length))
        self.out.close()
        self.sink.close()


class SequenceFile:
    """Random access to the sequences of a part."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        head = pa.ipc.read_message(self.file)
        self.schema = pa.ipc.read_schema(head)
        self.length, self.kind = self.schema.field("ids").type.list_size, self.schema.field("ids").type.value_type
        self.first, self.end = self.file.tell(), self.file.size()
        self.step = self.rows = 0
        if self.end - self.first > 16:  # a stream ends with eight bytes of its own
            first = pa.ipc.read_record_batch(pa.ipc.read_message(self.file), self.schema)
            self.step, self.rows = self.file.tell() - self.first, first.num_rows

    def batch(self, k: int) -> pa.RecordBatch:
        self.file.seek(self.first + k * self.step)
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.file), self.schema)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file) and mask of sequence i."""
        b = self.batch(i // self.rows)
        row = i % self.rows
        return b.column(0)[row].values.to_numpy(), b.column(1)[row].values.to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> np.ndarray:
        """n ids from the running position ``start`` of the part."""
        if not n:
            return np.zeros(0, np.int64)
        per = self.rows * self.length
        got = [self.batch(k).column(0).flatten().to_numpy() for k in range(start // per, (start + n - 1) // per + 1)]
        at = start % per
        return (got[0] if len(got) == 1 else np.concatenate(got))[at : at + n]


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into part files under the shared ``folder``.

    Returns the index, a scratch table: (part, file, doc_id, at, n_tokens), at being the place of a document's first id
    in its part, whose name in ``folder`` is ``file``. Null and empty texts have the end id alone. Documents ascend by doc_id over the
    parts (null first); rows that repeat a doc_id follow each other, in the order of their texts' hashes, and rows that share both
    as they come: such rows may be any number, and are dealt to as many parts as others. An empty table gives no parts.
    """
    parts = shuffle_partitions(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        bpe, out, file = encoder(tokenizer), None, f"{part:06d}-{uuid.uuid4().hex}.arrows"
        end = np.array([end_id], bpe.kind).tobytes()
        for b in batches:
            out = out or SequenceWriter(f"{folder}/{file}", bpe.kind, length)
            for lo in range(0, len(b), 128):
                some, rows = b.iloc[lo : lo + 128], []
                for ids in bpe.encode(some["text"].tolist()):
                    rows.append((out.total, len(ids) // bpe.kind.itemsize + 1))
                    out.add(ids + end)
                at, n = zip(*rows)
                yield pd.DataFrame({"part": part, "file": file, "doc_id": some["doc_id"], "at": at, "n_tokens": n})
        if out:
            out.close()

    kind = docs.schema["doc_id"].dataType.simpleString()
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    # the row's own number last: else rows that are equal otherwise would all go to one task
    placed = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    placed = placed.repartitionByRange(parts, *order, "row").sortWithinPartitions(*order, "row").select("doc_id", "text")
    return written(placed.mapInPandas(run, f"part int, file string, doc_id {kind}, at long, n_tokens long"))


def read_token_files(index: DataFrame, folder: str) -> DataFrame:
    """(part, file, doc_id, at, n_tokens, ids_le32 binary) of every document, read from the files: its ids as
    little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = file = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                some = batch.slice(lo, 128)
                found = []
                for p, at, n in zip(*(some.column(c).to_pylist() for c in ("file", "at", "n_tokens"))):
                    if p != part:
                        part, file = p, SequenceFile(f"{folder}/{p}")
                    found.append(file.ids(at, n).astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(found, pa.binary())], names=[*some.schema.names, "ids_le32"])

    kind = index.schema["doc_id"].dataType.simpleString()
    parts = shuffle_partitions(index.sparkSession)
    spread = index.select("part", "file", "doc_id", "at", "n_tokens").repartitionByRange(parts, "part", "at").sortWithinPartitions("part", "at")
    return spread.mapInArrow(run, f"part int, file string, doc_id {kind}, at long, n_tokens long, ids_le32 binary")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark)
    index = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), folder)
    ends = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row a part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = ends.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return read_token_files(index, folder).join(base, "part").select(
        "doc_id",
        (F.col("base") + F.col("at")).alias("start"),
        "n_tokens",
        F.crc32("ids_le32").alias("ids_crc32"),
    )
