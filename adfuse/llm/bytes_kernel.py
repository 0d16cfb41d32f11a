"""Vectorised word hashing over raw UTF-8 bytes, for use inside Spark tasks.

A word is a maximal run of *word bytes*; which bytes those are is given by a
256-entry mask derived from a rule.  Both word rules of this package treat
every byte of a non-ASCII character as a word byte, so working on bytes gives
exactly the words of the equivalent character class.

The work runs in slices of ``SLICE`` bytes that end between words, so the
temporary arrays stay small however long one text is.
"""

from __future__ import annotations

import numpy as np

#: Bytes handled at once; temporary arrays take about 40 bytes for each.
SLICE = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


_POW = np.empty(0, dtype=_U)
_INV = np.empty(0, dtype=_U)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    global _POW, _INV
    if len(_POW) < n:
        _POW = _powers(_BASE, n)
        _INV = _powers(pow(_BASE, -1, 1 << 64), n)
    return _POW, _INV


def lower_table() -> np.ndarray:
    """Byte map that lower-cases A-Z and nothing else."""
    t = np.arange(256, dtype=np.uint8)
    t[ord("A") : ord("Z") + 1] += 32
    return t


LOWER = lower_table()


def alnum_mask() -> np.ndarray:
    """Word bytes of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F], after lower-casing."""
    b = np.arange(256)
    return ((b >= 0x30) & (b <= 0x39)) | ((b >= 0x61) & (b <= 0x7A)) | (b >= 0x80)


def nonspace_mask() -> np.ndarray:
    """Word bytes of [^\\x20\\x09-\\x0D]."""
    b = np.arange(256)
    return ~((b == 0x20) | ((b >= 0x09) & (b <= 0x0D)))


ALNUM, NONSPACE = alnum_mask(), nonspace_mask()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _slice_words(low: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    is_word = mask[low]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], is_word, [False])).view(np.int8)))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return np.empty(0, _U), start, end
    power, inverse = _tables(len(low) + 1)
    total = np.zeros(len(low) + 1, dtype=_U)
    np.cumsum((low.astype(_U) + _U(1)) * power[: len(low)], dtype=_U, out=total[1:])
    raw = (total[end] - total[start]) * inverse[start]
    return mix(raw + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93)), start, end


def word_hashes(text: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end byte of every word of one buffer of UTF-8 bytes.

    Equal words have equal hashes wherever they stand.  Letters A-Z count as
    lower case.
    """
    n, at, parts = len(text), 0, []
    while at < n:
        stop, size = min(n, at + SLICE), SLICE
        while stop < n:  # end the slice after its last separator
            gaps = np.flatnonzero(~mask[LOWER[text[at:stop]]])
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
                break
            size *= 2  # one word longer than the slice
            stop = min(n, at + size)
        h, s, e = _slice_words(LOWER[text[at:stop]], mask)
        parts.append((h, s + at, e + at))
        at = stop
    if not parts:
        z = np.empty(0, np.int64)
        return np.empty(0, _U), z, z
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words (order counts)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, _U)
    out = np.zeros(n, dtype=_U)
    for k in range(width):
        out = out * _U(0x9FB21C651E98DF25) + words[k : k + n]
    return mix(out)


def texts(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string column; null counts as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, at
