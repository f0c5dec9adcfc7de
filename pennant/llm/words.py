"""Word spans and hashes for a whole Arrow batch of texts at once.

Texts stay the UTF-8 bytes that Arrow holds. A byte table says which bytes
belong to words, so spans come from comparing neighbours, and hashes of words
and of runs of words come from prefix sums of a polynomial modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BYTE_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
#: Texts are taken together up to so many bytes, which bounds what the prefix sums need.
CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Words between white space.
NOT_SPACE = ~SPACE
#: Lower-case words of digits, a-z and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the output."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, dtype=U64)
        have[0] = 1
        have = np.cumprod(have, dtype=U64)
        if size <= 4 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


class RunHash:
    """Hash of any run of a sequence of numbers, from two prefix sums."""

    def __init__(self, values: np.ndarray, base: int):
        n = len(values)
        sums = np.empty(n + 1, dtype=U64)
        sums[0] = 0
        np.cumsum(values.astype(U64, copy=False) * powers(base, n), dtype=U64, out=sums[1:])
        self.sums, self.back = sums, powers(_inverse(base), n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins (with the end of the last); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


class Words:
    """Words of the texts first .. last-1 of a batch.

    start, end: byte spans in data. of: index of the word's text, from first.
    bounds: where each text's words begin in those arrays, with the end of the last.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int, last: int, kind: np.ndarray):
        lo, hi = offsets[first], offsets[last]
        self.first, self.last = first, last
        self.data = data[lo:hi]
        self.offsets = at = offsets[first : last + 1] - lo
        inside = kind[self.data]
        n = len(inside)
        begin, finish = np.zeros(n, bool), np.zeros(n, bool)
        if n:
            edge = at[:-1][at[:-1] < n]
            begin[1:] = ~inside[:-1]
            begin[edge] = True
            finish[:-1] = ~inside[1:]
            finish[edge[edge > 0] - 1] = True
            finish[-1] = True
        self.start = np.flatnonzero(inside & begin)
        self.end = np.flatnonzero(inside & finish) + 1
        self.bounds = np.searchsorted(self.start, at)
        self.counts = np.diff(self.bounds)
        self.of = np.repeat(np.arange(last - first), self.counts)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return RunHash(self.data.astype(U64) + U64(1), BYTE_BASES[seed])(self.start, self.end)

    def left(self) -> np.ndarray:
        """For each word, how many words its text has from there on, itself included."""
        return self.bounds[1:][self.of] - np.arange(len(self))


def chunks(column: pa.Array | pa.ChunkedArray, kind: np.ndarray, lower: bool = False) -> Iterator[Words]:
    """The batch's texts in order, in groups of about CHUNK_BYTES."""
    data, offsets = buffers(column)
    if lower:
        data = lower_ascii(data)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, side="right")) - 1)
        yield Words(data, offsets, first, min(last, n), kind)
        first = last


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """out[i] = min(values[i : i+width]), cut at the end of the array; doubling steps."""
    out, have = values.copy(), 1
    while have < width:
        step = min(have, width - have)
        np.minimum(out[:-step], out[step:].copy(), out=out[:-step]) if step < len(out) else None
        have += step
    return out


def spans_to_mask(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Positions 0..n-1 that lie in any of the spans."""
    change = np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1)
    return np.cumsum(change[:-1]) > 0
