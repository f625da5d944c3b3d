"""Vectorised byte and word operations on Arrow text columns (numpy, no per-character Python)."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

U64 = np.uint64
#: Keys of the hashes. Hashes are chains of the bijection `mix`, eight bytes a step: no sum of terms can cancel, whatever the text.
KEYS = np.random.default_rng(20240229).integers(1, 1 << 63, 64, dtype=U64) * U64(2) + U64(1)
#: Bytes of text whose numbers of eight bytes are made at once.
CHUNK = 1 << 18
#: Words of more bytes are hashed one by one.
LONG_WORD = 256


_libc = ctypes.CDLL(None)


def release() -> None:
    """Gives freed memory back to the system: Python workers live on between tasks and stages, beside a JVM that needs it."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, in place: a bijection in which every input bit reaches every output bit."""
    t = h >> U64(30)
    h ^= t
    h *= U64(0xBF58476D1CE4E5B9)
    np.right_shift(h, U64(27), out=t)
    h ^= t
    h *= U64(0x94D049BB133111EB)
    np.right_shift(h, U64(31), out=t)
    h ^= t
    return h


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows end to end, and n + 1 offsets. A null row counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each row the number of words before it (n + 1 values)."""
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(s, offsets)


def eights(buf: np.ndarray) -> np.ndarray:
    """For each byte the number that it and the next seven spell; zeros stand beyond the end."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    out = np.empty(len(buf), U64)
    for j in range(min(8, len(buf))):
        part = out[j::8]
        part[:] = np.frombuffer(padded, "<u8", len(part), j)
    return out


def gram_hashes(buf: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all strings of k >= 8 bytes of buf, by their first byte."""
    n = max(0, len(buf) - k + 1)
    x = eights(buf)
    h = mix(x[:n] ^ KEYS[0])
    for step, at in enumerate([*range(8, k - 7, 8), *([k - 8] if k % 8 else [])], 1):
        h += KEYS[step]
        h ^= x[at : at + n]
        mix(h)
    return h


def row_hashes(rows: np.ndarray) -> np.ndarray:
    """Hashes of the rows of a byte matrix."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    x = wide.view("<u8")
    h = mix(x[:, 0] ^ KEYS[0])
    for j in range(1, x.shape[1]):
        h += KEYS[j]
        h ^= x[:, j]
        mix(h)
    return h


def word_hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [s, e), which ascend and do not overlap."""
    out = np.empty(len(s), U64)
    at = 0
    while at < len(s):
        to = max(at + 1, int(np.searchsorted(e, s[at] + CHUNK, side="right")))
        if e[to - 1] - s[at] <= max(CHUNK, LONG_WORD):
            x, start = eights(buf[s[at] : e[to - 1]]), s[at:to] - s[at]
            left = e[at:to] - s[at:to]
            h = mix(_first_bytes(x[start], left) ^ (left.astype(U64) * KEYS[0]))
            more = np.flatnonzero(left > 8)
            for step in range(1, LONG_WORD // 8):
                if not len(more):
                    break
                h[more] = mix((h[more] + KEYS[step]) ^ _first_bytes(x[start[more] + 8 * step], left[more] - 8 * step))
                more = more[left[more] > 8 * (step + 1)]
            out[at:to] = h
        at = to
    for i in np.flatnonzero(e - s > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(buf[s[i] : e[i]].tobytes(), int(KEYS[0]))
    return out


def _first_bytes(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The low n bytes (all of them from eight on) of numbers."""
    return x & (U64(0xFFFFFFFFFFFFFFFF) >> (U64(64) - U64(8) * np.minimum(n, 8).astype(U64)))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of pairs, in order."""
    return mix(a * KEYS[1] + b)


def windows(hashes: np.ndarray, word_offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of k words that stay in their row, and their hashes: pairs, pairs of pairs, and so on."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    have, h = 1, hashes
    while have < k:
        step = min(have, k - have)
        h = joined(h[:-step], h[step:])
        have += step
    last = np.repeat(word_offsets[1:], np.diff(word_offsets))[: n - k + 1]
    start = np.flatnonzero(np.arange(n - k + 1) + k <= last)
    return start, h[start]


def chained(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of short sequences [start, end) of hashes, in order and with their lengths."""
    out = mix((end - start).astype(U64) + KEYS[2])
    for i in range(int((end - start).max(initial=0))):
        rows = np.flatnonzero(start + i < end)
        out[rows] = joined(out[rows], hashes[start[rows] + i])
    return out


def spelled(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> pa.LargeBinaryArray:
    """All words of buf as an Arrow array."""
    ends = np.concatenate([[0], np.cumsum(e - s)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(ends), pa.py_buffer(buf[~SPACE[buf]])])


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n positions lie in one of the spans [start, start + length)."""
    on = np.zeros(n, bool)
    on[starts] = True
    starts = np.flatnonzero(on)
    change = np.zeros(n + 1, np.int32)
    change[starts] = 1
    change[starts + length] -= 1
    return np.cumsum(change[:-1], out=change[:-1]) > 0


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, .. of all spans, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def slices(offsets: np.ndarray, limit: int = 4 << 20):
    """Row ranges (from, to) of at most limit bytes each, but of one row at least."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, min(to, n)
        at = to


def counts(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set before each row (n + 1 values)."""
    total = np.zeros(len(flags) + 1, np.int32 if len(flags) < 1 << 31 else np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets].astype(np.int64)


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each row."""
    return np.diff(counts(flags, offsets))
