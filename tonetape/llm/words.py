"""Words and hashes of batches of texts, on numpy arrays.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed
and carriage return; letters A-Z count as a-z.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tonetape.llm.common import kept_by_worker

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Random odd multipliers and a random number for each byte, from a fixed seed.
_draw = np.random.default_rng(20240229)
LETTER = _draw.integers(1, 1 << 63, 256, dtype=U) * U(2) + U(1)
BASE, STEP = (int(x) * 2 + 1 for x in _draw.integers(1 << 61, 1 << 62, 2))
#: Bytes hashed at a time, and with it the memory of a step.
BLOCK = 1 << 20


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finisher that spreads h over all bits; another one for each salt."""
    h = h + U((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


@kept_by_worker
@lru_cache(maxsize=3)
def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i < n."""
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        out = np.full(n, U(b & 0xFFFFFFFFFFFFFFFF), U)
        out[0] = 1
        both.append(np.multiply.accumulate(out))
    return both[0], both[1]


def spans_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, *shorter: np.ndarray) -> np.ndarray | list[np.ndarray]:
    """64-bit hashes of data[start:end] for sorted spans that do not overlap.

    With shorter ends of the same spans, a list: the hashes up to end and up to each."""
    ends = [end, *shorter]
    out = [np.zeros(len(start), U) for _ in ends]
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + BLOCK, side="right")))
        first, last = int(start[lo]), int(end[hi - 1])
        up, down = powers(1 << max(20, (last - first).bit_length()))
        sums = np.zeros(last - first + 1, U)
        np.cumsum(LETTER[data[first:last]] * up[: last - first], out=sums[1:])
        s = start[lo:hi] - first
        for got, to in zip(out, ends):
            e = to[lo:hi] - first
            got[lo:hi] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(U) * U(STEP))
        lo = hi
    return out if shorter else out[0]


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each followed by a space, and where each text begins (one more for the end)."""
    raw = pc.fill_null(texts, "").cast(pa.large_binary())
    if raw.offset:
        raw = pa.concat_arrays([raw])
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    body = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    flat = np.insert(body, offsets[1:], 32) if len(raw) else body
    return flat, offsets + np.arange(len(offsets))


def words(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of flat begin and end."""
    inside = ~SPACE[flat]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edge[::2], edge[1::2]


def per_text(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of values between the marks in begin, one for each text."""
    sums = np.append(0.0, np.cumsum(values, dtype=np.float64))
    return sums[begin[1:]] - sums[begin[:-1]]


def shingles(texts: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's word shingles, and the number of each text's.

    A text with fewer words than size has one, of all its words; one without words none."""
    flat, begin = joined(texts)
    start, end = words(flat)
    h = spans_hash(LOWER[flat], start, end)
    first = np.searchsorted(start, begin)
    n_words = np.diff(first)
    count = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    stops = np.cumsum(count)
    total = int(stops[-1]) if len(stops) else 0
    at = np.arange(total) + np.repeat(first[:-1] - (stops - count), count)
    have = np.repeat(np.minimum(n_words, size), count)
    out = np.zeros(total, U)
    step = 1
    for k in range(size):
        step = step * STEP & 0xFFFFFFFFFFFFFFFF
        here = have > k
        part = h[np.minimum(at + k, max(len(h) - 1, 0))] * U(step) if len(h) else out
        out += np.where(here, part, U(0))
    return mixed(out, 1) + (U(size) - have.astype(U)), count


def shingle_sets(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    h, count = shingles(texts, size)
    stops = np.cumsum(count)
    return [np.unique(h[e - n : e]) for e, n in zip(stops, count)]
