"""Cutting texts where no tokenizer's token can lie across, so that what lies between is encoded once.

A cut goes before each space or line break that follows a character which isn't white space. Pre-token patterns of byte-level BPE
take white space only at the front of a pre-token, and a sentencepiece model whose pieces have the blank only as a prefix (and no
line break) can't merge across such a place either; ``check_pieces`` asserts the latter.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .byte_bpe import byte_alphabet

#: Distinct units that a worker remembers: bounds memory only.
REMEMBERED = 800_000

#: What ``\\s`` matches in Python's patterns, for those of Arrow, where it stands for ASCII only.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: The end of a text after which punctuation begins a pre-token: a letter or digit of ASCII, a letter of Latin-1.
WORD_END = r"[0-9A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]$"

_gaps = re.compile(r"\s\s").search
_cuts = re.compile(r"(?<=\S)(?=[ \n])").split


def cut(text: str) -> list[str]:
    """The units of ``text``; joined they are the text."""
    return _cuts(text) if text else []


class Units:
    """What ``learn`` (units -> a value for each) gives for the units of texts; each unit is learnt once while it is remembered."""

    def __init__(self, learn: Callable[[list[str]], list[Any]], forget: Callable[[], None] = lambda: None, remembered: int = REMEMBERED):
        self.learn, self.forget, self.remembered = learn, forget, remembered
        self.words: dict[str, Any] = {}  # by the unit without its space; one that begins with a line break as it is
        self.others: dict[str, Any] = {}

    def _known(self, known: dict[str, Any], keys: list[list[str]], unit: Callable[[str], str]) -> list[list[Any]]:
        found = [list(map(known.get, ks)) for ks in keys]
        absent = [[i for i, x in enumerate(f) if x is None] for f in found]
        if new := list(dict.fromkeys(ks[i] for ks, at in zip(keys, absent) for i in at)):
            known.update(zip(new, self.learn([unit(k) for k in new])))
            for ks, f, at in zip(keys, found, absent):
                for i in at:
                    f[i] = known[ks[i]]
        return found

    def of(self, texts: list[str]) -> list[list[Any]]:
        """The values of each text's units in turn."""
        if len(self.words) + len(self.others) > self.remembered:
            self.words, self.others = {}, {}
            self.forget()
        # where no two white spaces meet, each space and each line break begins a unit
        split = [None if _gaps(t) else t.replace("\n", " \n").split(" ") for t in texts]
        heads = [cut(t) if words is None else words[:1] if words[0] else [] for t, words in zip(texts, split)]
        tails = [words[1:] if words else [] for words in split]
        first = self._known(self.others, heads, lambda k: k)
        rest = self._known(self.words, tails, lambda k: k if k[:1] == "\n" else " " + k)
        return [a + b for a, b in zip(first, rest)]


def stand_together(units: list[str], chars: int = 1 << 16) -> tuple[list[list[int]], list[int]]:
    """Places of units in lots that can be encoded as one text, as any of their units may follow any other, and of those that can't."""
    lots, alone, held, length = [], [], [], 0
    for i, u in enumerate(units):
        if u[0] in " \n" and not u[-1].isspace():
            held.append(i)
            length += len(u)
            if length >= chars:
                lots.append(held)
                held, length = [], 0
        else:
            alone.append(i)
    return [*lots, held] if held else lots, alone


def cut_ids(ends: np.ndarray, units: list[str]) -> np.ndarray | None:
    """For ids that end at ``ends`` (in bytes) of the joined units: how many of them lie before each unit's end; None where an id lies across one."""
    wanted = np.cumsum([len(u.encode()) for u in units])
    cuts = np.searchsorted(ends, wanted, side="right")
    return cuts if cuts[-1] == len(ends) and cuts[0] and (ends[cuts - 1] == wanted).all() else None


def encode_units(units: list[str], encode: Callable[[str], list[int]], sizes: np.ndarray, chars: int = 1 << 16) -> list[bytes]:
    """Ids of each unit as little-endian 32-bit integers; ``sizes``: bytes of each id."""
    out: list[bytes | None] = [None] * len(units)
    for held in stand_together(units, chars)[0]:
        some = [units[i] for i in held]
        ids = np.array(encode("".join(some)), "<u4")
        if (cuts := cut_ids(np.cumsum(sizes[ids]), some)) is not None:
            raw, ends = ids.tobytes(), (4 * cuts).tolist()
            for i, a, b in zip(held, [0, *ends], ends):
                out[i] = raw[a:b]
    return [np.array(encode(u), "<u4").tobytes() if x is None else x for u, x in zip(units, out)]


def _key(unit: str) -> str:
    """What ``StemIds`` knows a unit by: without its space; any that doesn't begin with one space or a line break after a blank of its own."""
    if unit[:1] == " " and unit[1:2] not in ("", " ", "\n"):
        return unit[1:]
    return unit if unit[:1] == "\n" else " " + unit


def _unit(key: str) -> str:
    return key[1:] if key[:1] == " " else key if key[:1] == "\n" else " " + key


def _objects(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


class StemIds:
    """Ids of whole texts under a byte-level BPE whose pre-tokens are runs of letters, of digits or of other marks.

    Texts are cut into units, and the distinct units of a lot of texts are looked up. Of a unit that ends with ASCII punctuation after a
    letter or digit the stem and the marks are pre-tokens of their own, so each is learnt alone. What was used among the last
    ``remembered`` stems is kept, and at most twice as many and those of one lot: this bounds memory only.
    """

    def __init__(self, learn: Callable[[list[str]], list[bytes]], remembered: int = REMEMBERED):
        self.learn, self.remembered = learn, remembered
        self.recent: dict[str, bytes] = {_key(""): b""}
        self.older: dict[str, bytes] = {}

    def _known(self, keys: list[str]) -> pa.Array:
        """Ids of the units that distinct ``keys`` stand for."""
        found = list(map(self.recent.get, keys))
        absent = [i for i, x in enumerate(found) if x is None]
        new = []
        for i in absent:
            if (x := self.older.get(keys[i])) is None:
                new.append(keys[i])
            else:
                self.recent[keys[i]] = x
        if new:
            self.recent.update(zip(new, self.learn([_unit(k) for k in new])))
        for i in absent:
            found[i] = self.recent[keys[i]]
        return pa.array(found, pa.large_binary())

    def _ids(self, keys: pa.Array) -> pa.Array:
        """Ids of the units that distinct ``keys`` stand for, each of its stem and its marks."""
        stems = pc.utf8_rtrim(keys, characters=string.punctuation)
        stems = pc.if_else(pc.match_substring_regex(stems, WORD_END), stems, keys)
        marks = pc.subtract(pc.binary_length(keys), pc.binary_length(stems)).to_numpy()
        ended = np.nonzero(marks)[0]
        tails = pa.array([" " + w[-n:] for w, n in zip(_objects(keys.take(pa.array(ended))), marks[ended].tolist())], pa.large_string()).dictionary_encode()
        stems = stems.dictionary_encode()
        ids = self._known(_objects(stems.dictionary)).take(stems.indices)
        if not len(ended):
            return ids
        tail = np.zeros(len(marks), np.int64)
        tail[ended] = tails.indices.to_numpy() + 1
        known = pa.concat_arrays([pa.array([b""], pa.large_binary()), self._known(_objects(tails.dictionary))])
        return pc.binary_join_element_wise(ids, known.take(pa.array(tail)), pa.scalar(b"", pa.large_binary()))

    @staticmethod
    def _cut(texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
        """Distinct keys, the places among them of all units, where each text's units begin and end, and the order of the texts."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        gapped = pc.match_substring_regex(texts, SPACE + "{2}")
        # where no two white spaces meet, each space and each line break begins a unit
        split = pc.split_pattern(pc.replace_substring(texts.filter(pc.invert(gapped)), "\n", " \n"), " ")
        flat, first = split.flatten(), split.offsets.to_numpy()[:-1]
        heads = [" " + h for h in _objects(flat.take(pa.array(first)))]
        others = [[_key(u) for u in cut(t)] for t in _objects(texts.filter(gapped))]
        inner = np.ones(len(flat), bool)
        inner[first] = False
        more = pa.array([*heads, *(k for keys in others for k in keys)], pa.large_string())
        keys = pa.concat_arrays([flat.filter(pa.array(inner)), more]).dictionary_encode()
        # units of plain texts in their order, then those of the others
        rest = len(flat) - len(first)
        place = np.arange(len(keys))
        place[: len(flat)][inner], place[first] = np.arange(rest), rest + np.arange(len(first))
        bounds = np.concatenate([first, len(flat) + np.cumsum([0, *map(len, others)])])
        return keys.dictionary, keys.indices.take(pa.array(place)), bounds.astype(np.int64), np.argsort(gapped.to_numpy(zero_copy_only=False), kind="stable")

    def of(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text in turn; null is empty."""
        if len(self.recent) > self.remembered:
            self.older, self.recent = self.recent, {_key(""): b""}
        if not len(texts):
            return []
        keys, units, bounds, order = self._cut(texts)
        ids = self._ids(keys).take(units)
        ends, raw = np.frombuffer(ids.buffers()[1], np.int64)[bounds].tolist(), memoryview(ids.buffers()[2] or b"")
        out = [b""] * len(order)
        for i, a, b in zip(order.tolist(), ends, ends[1:]):
            out[i] = bytes(raw[a:b])
        return out


def byte_level(path: str):
    """A byte-level BPE of the tokenizers library, special tokens' strings being plain text, and the bytes of each id."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    back = {c: bytes([i]) for i, c in enumerate(byte_alphabet())}
    vocabulary = model.get_vocab(with_added_tokens=False)
    tokens = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        tokens[i] = b"".join(map(back.__getitem__, token))
    return model, tokens


def check_pieces(pieces: list[str], blank: str = "▁") -> None:
    """Raise where a piece of a sentencepiece model could lie across a cut."""
    odd = [p for p in pieces if blank in p.lstrip(blank) or "\n" in p or " " in p]
    if odd:
        raise ValueError(f"pieces hold a blank or line break after other characters, so texts can't be cut there: {odd[:5]}")
