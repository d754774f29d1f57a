"""Hashed word shingles of texts, computed over whole buffers at once.

Words are maximal runs without ASCII white space, with A-Z folded to lower case. A word's hash is a
polynomial over its bytes, a shingle's hash a polynomial over its words, both modulo 2**64 and mixed
to spread over all bits. Distinct shingles share a hash with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
BUFFER_BYTES = 1_000_000

_U = np.uint64
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_STEP = _U(0xD6E8FEB86659FD93)
_powers: list[np.ndarray] = [np.empty(0, _U), np.empty(0, _U)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def power_tables(n: int) -> list[np.ndarray]:
    """The first n powers, at least, of the base and of its inverse."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            table = np.full(n, base, dtype=_U)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers


def _buffers(texts: list[bytes]) -> Iterator[list[bytes]]:
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > BUFFER_BYTES:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text) + 1
    if part:
        yield part


def _of_buffer(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    data = _FOLD[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[0::2], edge[1::2]
    if len(ends) < len(starts):
        ends = np.append(ends, len(data))
    power, inverse = power_tables(max(len(data), BUFFER_BYTES))
    total = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_VALUE[data] * power[: len(data)], out=total[1:])
    word = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(_U))
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(starts, begin)  # of each text's words; texts end in a space
    n = max(0, len(word) - words + 1)
    run = np.zeros(n, dtype=_U)
    for k in range(words):
        run = run * _STEP + word[k : n + k]
    run = mix(run)
    for lo, hi in zip(first[:-1], first[1:]):
        if hi - lo >= words:
            yield np.unique(run[lo : hi - words + 1])
        elif hi > lo:
            short = _U(hi - lo)
            for w in word[lo:hi]:
                short = short * _STEP + w
            yield mix(np.array([short ^ _STEP], dtype=_U))
        else:
            yield np.empty(0, dtype=_U)


def shingle_sets(texts: list[bytes], words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, given in UTF-8. A text of fewer words is
    one shingle, a text without words none."""
    with np.errstate(over="ignore"):
        for part in _buffers(texts):
            yield from _of_buffer(part, words)
