"""Vectorised 64-bit hashes of the words, shingles and n-grams of many texts at once.

A word is a run of bytes other than ASCII white space (0x20, 0x09-0x0D), so bytes of
multi-byte characters never split a word.
"""

import numpy as np

from candlemill.llm.common import PIECE_BYTES

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Odd multipliers of a 64-bit finaliser and of the polynomials; any odd values serve.
_MIX1, _MIX2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_BASE, _STEP = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
_BYTE = None


def mix(x):
    """Spreads every input bit over all output bits."""
    x = x ^ (x >> _U(30))
    x = x * _MIX1
    x = x ^ (x >> _U(27))
    x = x * _MIX2
    return x ^ (x >> _U(31))


def _powers(base, n):
    out = np.full(n, base, _U)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=_U)


_FORWARD = _powers(_BASE, 0)
_BACKWARD = _FORWARD


def _tables(n):
    """Powers of the base and of its inverse modulo 2**64, kept for the task's next call."""
    global _FORWARD, _BACKWARD, _BYTE
    if _BYTE is None:
        _BYTE = mix(np.arange(1, 257, dtype=_U) * _STEP)
    if len(_FORWARD) < n:
        inverse = pow(int(_BASE), -1, 1 << 64)
        _FORWARD, _BACKWARD = _powers(_BASE, n), _powers(_U(inverse), n)
    return _FORWARD, _BACKWARD


def _piece(data):
    """Hashes, starts and ends of the words in one piece of bytes."""
    inside = ~_SPACE[data]
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    forward, backward = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[data] * forward[: len(data)], dtype=_U, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * backward[starts]), starts, ends


def words_of(data, lower=False):
    """``(hashes, starts, ends)`` of the words in a byte array; long arrays go in pieces.

    Pieces end at white space, so a piece is longer than the limit only for a word that is.
    """
    if lower:
        data = _LOWER[data]
    if len(data) <= 2 * PIECE_BYTES:
        return _piece(data)
    found, at = [], 0
    while at < len(data):
        stop = min(len(data), at + PIECE_BYTES)
        while stop < len(data):
            gap = np.flatnonzero(_SPACE[data[stop : stop + PIECE_BYTES]])
            if len(gap):
                stop += int(gap[0])
                break
            stop = min(len(data), stop + PIECE_BYTES)
        hashes, starts, ends = _piece(data[at:stop])
        found.append((hashes, starts + at, ends + at))
        at = stop
    return tuple(np.concatenate(part) for part in zip(*found))


def batch_words(texts, lower=False):
    """Words of an array of binary texts: ``(hashes, first, starts, ends, base)``.

    ``first[i]:first[i + 1]`` are the words of text i; starts and ends are byte positions
    in the joined texts, text i beginning at ``base[i]``.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    joined = texts.buffers()[2]
    data = np.frombuffer(joined, np.uint8)[offsets[0] : offsets[-1]] if joined else np.zeros(0, np.uint8)
    sizes = np.diff(offsets)
    # A blank between neighbours keeps the last word of one from joining the first of the next.
    base = offsets[:-1] - offsets[0] + np.arange(len(sizes))
    spaced = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
    keep = np.ones(len(spaced), bool)
    keep[base + sizes] = False
    spaced[keep] = data
    hashes, starts, ends = words_of(spaced, lower)
    first = np.concatenate((np.searchsorted(starts, base), [len(starts)]))
    return hashes, first, starts, ends, base


def grams(hashes, n):
    """Hash of the ``n`` words from each position on; positions too near the end are left out."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, _U)
    total = np.zeros(count, _U)
    for k in range(n):
        total = total * _STEP + hashes[k : k + count]
    return mix(total)


def as_long(hashes):
    return hashes.view(np.int64)
