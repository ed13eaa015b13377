"""Hashed words and shingles of Arrow text columns, in numpy.

A word is a run without ASCII white space, A-Z lower-cased; its 64-bit hash is
a polynomial over its bytes, so a block of texts is hashed without a Python
object for each word.  Works inside Python tasks on the UTF-8 bytes.
"""

from __future__ import annotations

import numpy as np

#: Bytes hashed at once: numpy needs some 30 bytes for each.
SEGMENT = 1 << 19

_U = np.uint64


def mix(x):
    """A bijection of 64-bit integers whose output bits depend on all input bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _tables():
    """(is white space, hash of the lower-cased byte) by byte."""
    byte = np.arange(256)
    white = (byte == 0x20) | ((byte >= 0x09) & (byte <= 0x0D))
    lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
    return white, mix((lower.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))


def text_bytes(column):
    """(bytes, where each text starts and the last ends); null is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def _segments(white, data):
    """Cuts of ``data`` after about SEGMENT bytes each, only where a word can't go on."""
    at, n = 0, len(data)
    while at < n:
        to = at + SEGMENT
        while to < n:
            ahead = np.flatnonzero(white[data[to : to + SEGMENT]])
            if len(ahead):
                to += int(ahead[0])
                break
            to += SEGMENT
        to = min(to, n)
        yield at, to
        at = to


def words(column, marks=None, letters: bool = False):
    """Of each word, or with ``letters`` of each run of ASCII letters, digits
    and all bytes beyond ASCII: (hash, where its first byte is, how many bytes it has and,
    by ``marks`` (bits for each byte value), the bits that any of its bytes has;
    where each text's words start and the last end)."""
    white, value = _tables()
    if letters:
        byte = np.arange(256)
        white = (byte < 128) & ~np.char.isalnum(np.array([chr(b) for b in byte]))
    data, bounds = text_bytes(column)
    hashes, first, sizes, bits = [np.empty(0, _U)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint8)]
    for a, b in _segments(white, data):
        part = data[a:b]
        inside = ~white[part]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        cuts = bounds[(bounds >= a) & (bounds < b)] - a
        start[cuts] = inside[cuts]  # a text's first byte begins a word
        at = np.flatnonzero(start)
        if not len(at):
            continue
        of = np.zeros(len(part), np.int64)  # where the word, or the gap after it, began
        of[at] = at
        place = np.arange(len(part)) - np.maximum.accumulate(of)
        power = np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15 | 1, dtype=_U)
        power[0] = 1
        power = np.multiply.accumulate(power)
        terms = np.where(inside, value[part] * power[place], _U(0))
        hashes.append(mix(np.add.reduceat(terms, at)))
        first.append(at + a)
        sizes.append(np.add.reduceat(inside, at, dtype=np.int64))
        if marks is not None:
            bits.append(np.bitwise_or.reduceat(np.where(inside, marks[part], 0).astype(np.uint8), at))
    first = np.concatenate(first)
    found = np.concatenate(hashes), first, np.concatenate(sizes), np.concatenate(bits) if marks is not None else None
    return *found, np.searchsorted(first, bounds)


def word_hashes(column):
    """(hash of each word, where each text's words start and the last end)."""
    found = words(column)
    return found[0], found[-1]


def shingle_sets(column, n: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: ``n`` consecutive
    words, the whole sequence if there are fewer, nothing without a word."""
    hashes, bounds = word_hashes(column)
    factor = _U(0xD6E8FEB86659FD93)
    rolled = np.zeros(max(0, len(hashes) - n + 1), dtype=_U)
    for j in range(n):
        rolled = rolled * factor + hashes[j : j + len(rolled)]
    rolled = mix(rolled)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= n:
            out.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:
            whole = np.zeros(1, dtype=_U)
            for h in hashes[a:b]:
                whole = whole * factor + h
            out.append(mix(whole + _U(b - a)))
        else:
            out.append(np.empty(0, dtype=_U))
    return out
