"""Words of whole Arrow text columns as 64-bit hashes, without a Python loop over words.

Words are maximal runs of bytes other than space and 0x09-0x0D, with A-Z
lower-cased; bytes above 0x7F are kept as they are, so this equals the rule on
code points. A word's hash is a polynomial over random byte values modulo
2**64, read off a running sum, then mixed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE = 1 << 19
U = np.uint64
_rng = np.random.RandomState(20240229)
BYTE_VALUE = _rng.randint(1, 2**63 - 1, 256, dtype=np.int64).astype(U) | U(1)
BYTE_VALUE[65:91] = BYTE_VALUE[97:123]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)
NO_WORD = U(0)
_powers = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, SLICE + 1)
        for k, b in enumerate((BASE, BASE_INVERSE)):
            p = np.full(n, U(b), U)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(32)
    return h


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-dependent hash of two hashes."""
    return mix(a * U(0x9FB21C651E98DF25) + (b ^ (b >> U(29))))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and where each begins; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("") if texts.null_count else texts
    texts = texts.cast(pa.large_string())
    n = len(texts)
    _, offsets, data = texts.buffers()
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def word_spans(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = IS_SPACE[buf]
    first = ~space
    last = first.copy()
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    first[1:] &= space[:-1] | cut[1:n]
    last[:-1] &= space[1:] | cut[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _slices(buf: np.ndarray, at: np.ndarray):
    """Byte ranges of about SLICE bytes that end at a text's end or at white space."""
    n, s = len(buf), 0
    while s < n:
        e = s + SLICE
        if e >= n:
            e = n
        else:
            k = int(np.searchsorted(at, e, "right")) - 1
            doc = int(at[k])
            near = np.flatnonzero(IS_SPACE[buf[max(s, e - 4096):e]])
            if doc > s and doc > e - 4096:
                e = doc
            elif len(near):
                e = max(s, e - 4096) + int(near[-1]) + 1
            elif doc > s:
                e = doc
            else:
                stop = int(at[k + 1])
                while e < stop and not IS_SPACE[buf[e]]:
                    e += 1
        yield s, e
        s = e


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of words before each text (n+1 values)."""
    buf, at = flat(texts)
    hashes, counts = [], np.zeros(len(at), np.int64)
    for s, e in _slices(buf, at):
        k0, k1 = int(np.searchsorted(at, s, "right")) - 1, int(np.searchsorted(at, e, "left"))
        inner = np.clip(at[k0:k1 + 1], s, e) - s
        part = buf[s:e]
        begin, end = word_spans(part, inner[inner < e - s])
        p, inverse = powers(e - s + 1)
        run = np.empty(e - s + 1, U)
        run[0] = 0
        np.cumsum(BYTE_VALUE[part] * p[:e - s], out=run[1:])
        hashes.append(mix((run[end] - run[begin]) * inverse[begin]))
        found = np.searchsorted(begin, inner, "left")
        counts[k0 + 1:k1 + 1] += np.diff(found)
    return (np.concatenate(hashes) if hashes else np.zeros(0, U)), np.cumsum(counts)


def shingles(h: np.ndarray, ptr: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``width`` words of each text; a shorter text's
    whole word sequence is one shingle; a text without words has none."""
    n_words = np.diff(ptr)
    count = np.where(n_words >= width, n_words - width + 1, (n_words > 0).astype(np.int64))
    out_ptr = np.concatenate(([0], np.cumsum(count)))
    if not len(h):
        return np.zeros(0, U), out_ptr
    run = h.copy()
    short = np.zeros(len(n_words), U)
    for k in range(1, width):
        at = np.flatnonzero(n_words == k)
        short[at] = run[ptr[at]] * U(2 * k + 1)  # run holds the first k words here
        if k < len(run) + 0:
            nxt = np.zeros_like(run)
            nxt[:len(run) - k] = h[k:]
            run = combine(run, nxt)
    out = np.empty(out_ptr[-1], U)
    doc = np.repeat(np.arange(len(n_words)), count)
    src = ptr[doc] + (np.arange(len(out)) - out_ptr[doc])
    out[:] = run[src]
    at = np.flatnonzero((n_words > 0) & (n_words < width))
    out[out_ptr[at]] = mix(short[at])
    return out, out_ptr


def pieces(ptr: np.ndarray, most: int):
    """Ranges of texts with about ``most`` items each (one text at least)."""
    s, n = 0, len(ptr) - 1
    while s < n:
        e = max(s + 1, int(np.searchsorted(ptr, ptr[s] + most, "right")) - 1)
        yield s, min(e, n)
        s = min(e, n)


class Memo:
    """A worker's memory of a float for each 64-bit hash: two places by the
    hash, so a look-up is two gathers. Starts anew beyond ``most`` entries."""

    def __init__(self, bits: int = 22, most: int = 3_000_000):
        self.shift, self.mask, self.most = U(64 - bits), U((1 << bits) - 1), most
        self.key = np.zeros((2, 1 << bits), U)
        self.value = np.zeros((2, 1 << bits), np.float32)
        self.n = 0

    def get(self, key: np.ndarray, make) -> np.ndarray:
        """Values of ``key``; ``make(first)`` gives those of the keys at the
        positions ``first``, one for each distinct unknown key."""
        one, two = key >> self.shift, key & self.mask
        out = self.value[0, one]
        other = np.flatnonzero(self.key[0, one] != key)
        out[other] = self.value[1, two[other]]
        miss = other[self.key[1, two[other]] != key[other]]
        if len(miss):
            unique, where, back = np.unique(key[miss], return_index=True, return_inverse=True)
            value = make(miss[where]).astype(np.float32)
            out[miss] = value[back]
            if self.n > self.most:
                self.key[:] = 0
                self.n = 0
            one, two = unique >> self.shift, unique & self.mask
            free = self.key[0, one] == 0
            self.key[0, one[free]], self.value[0, one[free]] = unique[free], value[free]
            self.key[1, two[~free]], self.value[1, two[~free]] = unique[~free], value[~free]
            # two keys of this call may have met in one place: the last one stays, and the value must be its own
            self.value[0, one[free]] = np.where(self.key[0, one[free]] == unique[free], value[free], self.value[0, one[free]])
            self.value[1, two[~free]] = np.where(self.key[1, two[~free]] == unique[~free], value[~free], self.value[1, two[~free]])
            self.n += len(unique)
        return out
