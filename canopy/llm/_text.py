"""Words and their hashes for a whole batch of texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

CHUNK = 2 << 20
LONG_WORD = 64
_BASE, _OTHER = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_SEEDS = np.array([0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
_ODD = np.array([0x9FB21C651E98DF25, 0xD6E8FEB86659FD93], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[int, np.ndarray] = {}


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about limit bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    _, offsets = raw(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an array of texts; null is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, first): white-space words of all texts; text k has words first[k] to first[k + 1]."""
    buf, offsets = raw(texts)
    inside = ~_SPACE[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(begins)
    return buf, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        steps = np.full(max(n, CHUNK // 2), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.cumprod(steps)
    return _POWERS[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_digests(pair: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each span of words, as two unlike hashes."""
    return span_hashes(pair[0], starts, ends), span_hashes(pair[1], starts, ends, _OTHER)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each span of word hashes, from one prefix sum."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(base, n), out=total[1:])
    back = _powers(pow(base, -1, 1 << 64), n + 1)
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def word_digests(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two unlike 64-bit hashes of each word.

    Eight bytes at a time go through a mixing that isn't linear, so no choice of
    letters cancels out; words too long for that go to XXH3.
    """
    eights = np.zeros((len(buf) >> 3) + 2, np.uint64)
    eights.view(np.uint8)[: len(buf)] = buf
    left = ends - starts
    one, two = mix(left.astype(np.uint64) + _SEEDS[0]), mix(left.astype(np.uint64) + _SEEDS[1])
    rows = np.flatnonzero(left <= LONG_WORD)
    at, left = starts[rows], left[rows]
    while len(rows):
        block, shift = at >> 3, (at & 7).astype(np.uint64) << np.uint64(3)
        value = (eights[block] >> shift) | ((eights[block + 1] << (np.uint64(63) - shift)) << np.uint64(1))
        value &= np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - np.minimum(left, 8)).astype(np.uint64) << np.uint64(3))
        one[rows] = mix((one[rows] ^ value) * _ODD[0])
        two[rows] = mix((two[rows] ^ value) * _ODD[1])
        more = np.flatnonzero(left > 8)
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        digest = xxhash.xxh3_128_intdigest(buf[starts[k] : ends[k]].tobytes())
        one[k], two[k] = digest & 0xFFFFFFFFFFFFFFFF, digest >> 64
    return one, two


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return word_digests(buf, starts, ends)[0]
