"""Vectorised byte work on Arrow text columns, for use inside tasks.

Texts are handled as UTF-8 bytes in slices of a few MB (a longer text is a slice of its own), so a
task's memory follows the longest text and not the batch. A word is a run of bytes other than the
six ASCII white-space characters; UTF-8 never uses those bytes inside a character."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 2 << 20
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_P = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_Q = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def byte_alphabet() -> dict[str, int]:
    """The published byte-level alphabet: printable bytes stand for themselves, the others for the next code points from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def mix64(x: np.ndarray) -> np.ndarray:
    """The published 64-bit finaliser of MurmurHash3: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows in those bytes). Nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=n + 1 + column.offset)[column.offset:]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield lo, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each row): the words of every row, as byte positions."""
    word = ~SPACE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    cut = offsets[1:-1]
    cut = cut[cut < len(data)]
    start[cut] = word[cut]  # a row's first byte can't go on with the row before
    end = word.copy()
    end[:-1] &= ~word[1:] | start[1:]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def word_counts(column: pa.Array) -> np.ndarray:
    out = [np.diff(spans(data, offsets)[2]) for _, data, offsets in slices(column)]
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of byte * P**position modulo 2**64, and the inverse powers of P."""
    n = len(data) + 1
    power, back = np.full(n, _P), np.full(n, _Q)
    power[0] = back[0] = 1
    power, back = np.cumprod(power), np.cumprod(back)
    sums = np.zeros(n, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
    return sums, back


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span, wherever the span stands."""
    sums, back = prefix_sums(data)
    return mix64((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """For every row, the sorted distinct hashes of its ``k``-word shingles. A row of fewer words
    has its whole sequence as the one shingle, a row without words has none."""
    data = LOWER[data]
    starts, ends, first = spans(data, offsets)
    words, out = span_hashes(data, starts, ends), []
    n = len(words)
    grams = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        shifted = np.zeros(n, dtype=np.uint64)
        shifted[:max(0, n - i)] = words[i:]
        grams = mix64(grams * _P + shifted + np.uint64(i + 1))
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a:b - k + 1]))
        else:
            short = np.full(min(b - a, 1), b - a, dtype=np.uint64)
            for w in words[a:b]:
                short = mix64(short * _P + w)
            out.append(short)
    return out
