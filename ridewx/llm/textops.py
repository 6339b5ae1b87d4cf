"""Vectorised word hashing over a slice of texts (numpy, no per-word Python).

A slice is the UTF-8 bytes of consecutive texts. Words are maximal runs of
bytes other than space and 0x09-0x0D, which is the same as runs of such
code points.

There are two hashes of a word. ``words`` gives a polynomial over its bytes
modulo 2**64 followed by a bit mix: quick, for features, but words that
collide can be written down for it. ``word_ids`` takes 64 bits or more of
BLAKE2b, for which none are known; whatever decides that two words, shingles
or texts are equal builds on it. N-gram hashes combine the hashes of n words.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x5851F42D4C957F2D
_IBASE = pow(_BASE, -1, 1 << 64)
_GRAM = U(0x9E3779B97F4A7C15)
_WS = np.zeros(256, bool)
_WS[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 … base**(n-1) modulo 2**64; grown and kept per worker."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, U)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    offs = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if offs[-1] == offs[0]:
        return np.empty(0, np.uint8), offs - offs[0]
    return np.frombuffer(col.buffers()[2], np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True bytes that don't cross texts: starts, ends, and
    the number of runs before each text."""
    n = len(inside)
    if not n:
        e = np.empty(0, np.int64)
        return e, e, np.zeros(len(offs), np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[offs[:-1][offs[:-1] < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    last = offs[1:] - 1
    after[last[last >= 0]] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes."""
    n = len(data)
    total = np.zeros(n + 1, U)
    np.cumsum((data.astype(U) + U(1)) * powers(_BASE, n), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(_IBASE, n + 1)[starts])


def words(col: pa.Array):
    """(hash of every word, words before each text, starts, ends, bytes)."""
    data, offs = text_bytes(col)
    starts, ends, bounds = runs(~_WS[data], offs)
    return span_hash(data, starts, ends), bounds, starts, ends, data


def word_ids(col: pa.Array, hashes: int = 1):
    """(``hashes`` independent 64-bit hashes of every word, words before each
    text). Each distinct word of the slice is hashed once, by BLAKE2b."""
    data, offs = text_bytes(col)
    inside = ~_WS[data]
    starts, ends, bounds = runs(inside, offs)
    size = np.concatenate([[0], np.cumsum(ends - starts)])
    each = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(size.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[inside]))]).dictionary_encode()
    digests = b"".join(blake2b(w, digest_size=8 * hashes).digest() for w in each.dictionary.to_pylist())
    distinct = np.frombuffer(digests, "<u8").reshape(-1, hashes)
    code = each.indices.to_numpy()
    return [np.ascontiguousarray(distinct[:, i])[code] for i in range(hashes)], bounds


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of h[i:i+n] for every i (the caller drops those crossing texts)."""
    if len(h) < n:
        return np.empty(0, U)
    out = np.zeros(len(h) - n + 1, U)
    for j in range(n):
        out = out * _GRAM + h[j:len(h) - n + 1 + j]
    return mix(out)


def gram_docs(bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word of every n-gram inside a text, and its text."""
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[:-1][doc]
    return first, doc


def shingles(col: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, shingle hash) of all n-word shingles; a text of one to
    n-1 words has one shingle, all its words."""
    (h,), bounds = word_ids(col)
    first, doc = gram_docs(bounds, n)
    sh = grams(h, n)[first] if len(first) else np.empty(0, U)
    count = np.diff(bounds)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        extra = np.zeros(len(short), U)
        for j in range(n):
            has = count[short] > j
            at = np.where(has, bounds[:-1][short] + j, 0)
            extra = np.where(has, extra * _GRAM + h[at] + U(j + 1), extra)
        doc = np.concatenate([doc, short])
        sh = np.concatenate([sh, mix(extra + count[short].astype(U))])
    return doc, sh
