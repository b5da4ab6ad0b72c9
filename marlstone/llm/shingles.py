"""Word shingles of whole texts as 64-bit fingerprints, computed with numpy over the UTF-8 bytes of many texts at once.

Words are maximal runs of characters other than space and \\t..\\r, after lower-casing A-Z. A text's set holds
its distinct n-word shingles; with fewer words, the whole sequence as one; without words, nothing.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEPS = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


#: Letters as they count in words: A-Z lower-cased.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = bytes(FOLD)

#: Places with a row in the table; bytes further into a word are mixed one by one.
_PLACES = 64


def _coded(byte: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix((byte.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95) + place.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


_TABLE = _coded(np.tile(np.arange(256), _PLACES), np.repeat(np.arange(_PLACES), 256))


def piece_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of the pieces data[start:end], which must not overlap: the sum of a random value for each (byte, place in
    the piece), mixed. Unlike a polynomial it has no texts that clash by their structure."""
    at = np.zeros(len(data), np.int32)
    at[start] = start
    key = np.arange(len(data), dtype=np.int32)
    key -= np.maximum.accumulate(at)
    far = np.flatnonzero(key >= _PLACES - 1) if len(start) and (end - start).max() >= _PLACES else np.zeros(0, np.int64)
    place = key[far]
    np.minimum(key, _PLACES - 1, out=key)
    key <<= 8
    key |= data
    value = _TABLE[key]
    value[far] = _coded(data[far], place)
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)))
    return mix(run[end] - run[start] + (end - start).astype(np.uint64))


def distinct(values: np.ndarray, sort: bool = True) -> np.ndarray:
    """Sorted distinct values."""
    v = np.sort(values) if sort else values
    return v[np.concatenate(([True], v[1:] != v[:-1]))] if len(v) else v


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; tables of up to a million entries are kept."""
    own = _POWERS.get(int(base), np.zeros(0, np.uint64))
    if len(own) < n:
        own = np.full(max(n, 1 << 16), base, np.uint64)
        own[:1] = 1
        own = np.multiply.accumulate(own)
        if len(own) <= 1 << 20:
            _POWERS[int(base)] = own
    return own[:n]


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets and fingerprints of the words of a byte array."""
    space = _SPACE[data]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return start, piece_hashes(FOLD[data], start, end)


def words(raw: bytes) -> list[bytes]:
    """The words themselves; bytes.split() parts at exactly the six blanks."""
    return raw.translate(_LOWER).split()


def exact_set(raw: bytes, n: int) -> set[tuple[bytes, ...]]:
    """The shingles as tuples of words, for comparisons that must not rest on fingerprints."""
    w = words(raw)
    if len(w) < n:
        return {tuple(w)} if w else set()
    return set(zip(*[w[k:] for k in range(n)]))


def shingle_sets(texts: list[str], n: int, most: int = 1 << 19) -> list[np.ndarray]:
    """A sorted uint64 array of distinct shingle fingerprints for each text."""
    out: list[np.ndarray] = []
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    i = 0
    while i < len(raw):
        j, size = i, 0
        while j < len(raw) and (j == i or size + len(raw[j]) < most):
            size += len(raw[j]) + 1
            j += 1
        data = np.frombuffer(b" ".join(raw[i:j]), np.uint8)
        start, h = word_hashes(data)
        cuts = np.cumsum([0] + [len(x) + 1 for x in raw[i:j]])
        at = np.searchsorted(start, cuts)
        keys = np.zeros(len(h), np.uint64)
        for k in range(n):
            keys = mix(keys * np.uint64(3) + np.uint64(k + 1) + np.concatenate((h[k:], np.zeros(min(k, len(h)), np.uint64)))[: len(h)])
        for k in range(j - i):
            a, b = at[k], at[k + 1]
            if b - a >= n:
                out.append(distinct(keys[a : b - n + 1]))
            elif b > a:
                x = np.zeros(1, np.uint64)
                for y in h[a:b]:
                    x = mix(x * np.uint64(5) + y + np.uint64(b - a))
                out.append(x)
            else:
                out.append(np.zeros(0, np.uint64))
        i = j
    return out
