"""Token ids of whole texts, by the tokenizers library, with each distinct word encoded once.

A tokenizer that lowers texts, drops white space and never joins what white space parts
gives a text the ids of its words, one after the other. For such a tokenizer the texts
of a batch are cut into words by array operations, words not seen before are encoded by
the library's model, and the ids are put together by array look-up. This holds for texts
whose characters' classes are beyond doubt: printable ASCII, tab, line ends and the letters
of Latin-1. Any other text, and any other tokenizer, is encoded whole by the library.
"""

from __future__ import annotations

import functools
import gc
import json
import os

import numpy as np
import pyarrow as pa

from .common import HELD
from .wordhash import buffer_of, hashes

CACHE_WORDS = 600_000
PART_BYTES = 2 << 20
SPACE, LETTER, DIGIT, OTHER, UNSURE = range(5)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _classes() -> np.ndarray:
    kind = np.full(256, UNSURE, np.uint8)
    kind[33:127] = OTHER
    kind[48:58] = DIGIT
    kind[65:91] = kind[97:123] = LETTER
    kind[[9, 10, 13, 32]] = SPACE
    return kind


CLASS = _classes()


def _by_words(spec: dict) -> bool:
    """Whether the tokenizer's file asks for exactly the cuts that ``_cut`` makes."""
    try:
        steps = [x["type"] for x in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        return (steps == ["NFC", "Replace", "Lowercase"] and split["pattern"]["Regex"] == PATTERN
                and split["behavior"] == "Removed" and split["invert"]
                and not level["add_prefix_space"] and not level["use_regex"]
                and spec["model"]["type"] == "BPE")
    except (KeyError, TypeError, ValueError):
        return False


def _shift(x: np.ndarray, by: int, fill=0) -> np.ndarray:
    """The array moved left by ``by``."""
    out = np.full_like(x, fill)
    out[:len(x) - by] = x[by:]
    return out


def _cut(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes in lower case, begin and end of the words) of sure bytes; ``first`` marks
    the bytes at which a text begins."""
    kind, n = CLASS[data], len(data)
    pair = data == 0xC3  # the first of the two bytes of a Latin-1 letter
    second = np.concatenate([[False], pair[:-1]])
    kind[data >= 128] = LETTER
    low = np.where((data >= 65) & (data <= 90) | second & (data <= 0x9E), data | 32, data)
    cut = np.concatenate([[True], kind[1:] != kind[:-1]]) | (kind == DIGIT) | first
    quote = np.flatnonzero((data == 39) & cut)
    if len(quote):  # 's and the like, where the quote begins a run
        one, two = (_shift(low, k) for k in (1, 2))
        inside = ~_shift(first, 1, True)
        short = quote[np.isin(one[quote], list(b"stmd")) & inside[quote]]
        ends = one[quote].astype(int) * 256 + two[quote]
        long = quote[np.isin(ends, [int.from_bytes(x) for x in (b"re", b"ve", b"ll")])
                     & inside[quote] & ~_shift(first, 2, True)[quote]]
        for at, size in ((short, 2), (long, 3)):
            cut[at + 1] = False
            at = at[at + size < n] + size
            cut[at] |= True
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], n)
    word = kind[begin] != SPACE
    return low, begin[word], end[word]


def _unsure(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which texts hold a byte whose character this module does not class itself."""
    kind = CLASS[data] == UNSURE
    lead = np.concatenate([[0], data[:-1]]) == 0xC3
    letter = lead & (data >= 0x80) & (data != 0x97) & (data != 0xB7)
    odd = kind & (data != 0xC3) & ~letter
    total = np.concatenate([[0], np.cumsum(odd)])
    return total[at[1:]] > total[at[:-1]]


class Encoder:
    """Encodes batches of texts; holds about ``CACHE_WORDS`` words at most between calls."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        self.by_words = _by_words(spec)
        self.special = [x["content"] for x in spec.get("added_tokens") or ()]
        if self.by_words:
            self.model = self.library.model
            self.byte_map = [self.library.pre_tokenizer.pre_tokenize_str(chr(b))[0][0] if 32 < b < 127
                             else None for b in range(256)]
            for b in range(0x80, 0xC0):  # the letters' bytes, as the byte-level step writes them
                mapped = self.library.pre_tokenizer.pre_tokenize_str(
                    bytes([0xC3, b]).decode() if b not in (0x97, 0xB7) else "é")[0][0]
                self.byte_map[0xC3] = mapped[0]
                self.byte_map[b] = mapped[1]
        self._clear()

    def _clear(self) -> None:
        self.place: dict[int, int] = {}
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, keys: list[int], words: list[bytes]) -> None:
        tokenize, mapped = self.model.tokenize, self.byte_map.__getitem__
        gc.disable()  # many small objects, none of them in a cycle
        found = [[t.id for t in tokenize(w.decode() if w.isascii() else "".join(map(mapped, w)))]
                 for w in words]
        gc.enable()
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        for key in keys:
            self.place[key] = len(self.place)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, np.array([i for ids in found for i in ids], np.uint32)])

    def _part(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin of each word, ids of each word) of a part of the bytes."""
        if len(self.place) > CACHE_WORDS:
            self._clear()
        low, begin, end = _cut(data, first)
        keys, example, word = np.unique(hashes(low, begin, end), return_index=True, return_inverse=True)
        get = self.place.get
        at = np.array([get(k, -1) for k in keys.tolist()], np.int64)
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            raw = low.tobytes()
            at[fresh] = len(self.place) + np.arange(len(fresh))
            self._learn(keys[fresh].tolist(),
                        [raw[b:e] for b, e in zip(begin[example[fresh]].tolist(), end[example[fresh]].tolist())])
        at = at[word]
        lengths = self.lengths[at]
        stop = np.cumsum(lengths)
        ids = self.flat[np.repeat(self.starts[at] - (stop - lengths), lengths)
                        + np.arange(stop[-1] if len(stop) else 0)]
        return ids, begin, lengths

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32)
                for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in one uint32 array, ids per text)."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if not self.by_words:
            found = self._whole(texts.to_pylist())
            return _joined(found), np.fromiter(map(len, found), np.int64, len(found))
        data, at = buffer_of(texts)
        odd = _unsure(data, at)
        raw = data.tobytes()
        if any(s.encode() in raw for s in self.special):
            for i, text in enumerate(texts.to_pylist()):
                odd[i] |= any(s in text for s in self.special)
        if odd.any():  # the library's ids go in the places of these texts
            plain = texts.filter(pa.array(~odd))
            ids, lengths = self.encode(plain) if len(plain) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
            ends = np.cumsum(lengths)
            sure = iter([ids[e - n:e] for e, n in zip(ends, lengths)])
            own = iter(self._whole(texts.filter(pa.array(odd)).to_pylist()))
            found = [next(own) if o else next(sure) for o in odd]
            return _joined(found), np.fromiter(map(len, found), np.int64, len(found))
        first = np.zeros(len(data) + 1, bool)
        first[at] = True
        parts, start = [], 0
        while start < len(data):
            stop = min(start + PART_BYTES, len(data))
            if stop < len(data):  # go back to white space or a text's begin
                free = np.flatnonzero((CLASS[data[start + 1:stop]] == SPACE) | first[start + 1:stop])
                stop = start + 1 + int(free[-1]) if len(free) else len(data)
            ids, begin, lengths = self._part(data[start:stop], first[start:stop])
            parts.append((ids, begin + start, lengths))
            start = stop
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        begin, lengths = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
        total = np.concatenate([[0], np.cumsum(lengths)])
        return _joined([p[0] for p in parts]), np.diff(total[np.searchsorted(begin, at)])


def _joined(found: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint32), *found])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a Python worker."""
    return Encoder(path)


HELD.append(encoder)


def with_end(ids: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end`` after the ids of each text."""
    return np.insert(ids, np.cumsum(lengths), np.uint32(end)), lengths + 1
