"""Cutting the texts of an Arrow batch into words, and hashing them, with array operations.

Works on the UTF-8 bytes of all texts of a batch at once. A word's hash is a polynomial in
its bytes modulo 2^64, read off running sums, then mixed; equal words hash alike in every
task, and two given words collide with a chance of about 2^-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^j and BASE^-j for j up to n."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 16)
        for i, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the slices [begin, end) of a byte array."""
    up, down = _powers_to(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    return mixed((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, where each text begins and the last ends); NULL is the empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of True that do not cross a text's border: (begin, end, runs per text)."""
    n = len(inside)
    first = np.zeros(n + 1, bool)
    first[at] = True
    before = np.concatenate([[False], inside[:-1]])
    begin = np.flatnonzero(inside & (~before | first[:n]))
    after = np.concatenate([inside[1:], [False]])
    end = np.flatnonzero(inside & (~after | first[1:])) + 1
    return begin, end, np.diff(np.searchsorted(begin, at))


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lowered."""
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def space_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words between white space (space, tab to carriage return), A-Z
    lowered; words per text."""
    data, at = buffer_of(texts)
    low = lowered(data)
    begin, end, n = runs((low != 32) & ((low < 9) | (low > 13)), at)
    return hashes(low, begin, end), n


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of letters and digits in any script, in lower case; words per
    text. Bytes outside ASCII count as letters."""
    import pyarrow.compute as pc

    data, at = buffer_of(pc.utf8_lower(texts.cast(pa.large_string())))
    inside = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128)
    begin, end, n = runs(inside, at)
    return hashes(data, begin, end), n
