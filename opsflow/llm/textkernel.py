"""Array helpers that run inside tasks: rows of an Arrow batch as one byte
buffer, spans of words in it, and 64-bit hashes of spans.

Memory per task is a small multiple of one slice (``SLICE_BYTES`` of text, or
one row where a row is longer than that).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
HASH_BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_WORD = 1 << 64


def byte_table(word: Callable[[int], bool]) -> np.ndarray:
    """Boolean table over the 256 byte values."""
    return np.array([word(b) for b in range(256)], dtype=bool)


def lower_table() -> np.ndarray:
    """Byte map that lower-cases A-Z only (UTF-8 bytes over 0x7F stay)."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Contiguous parts of a batch with at most ``limit`` bytes of text each (one row at least).

    After the last part, Arrow's unused memory goes back to the system: a worker
    process outlives its task, and what it keeps is missing in the next stage."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(total, total[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j
    pa.default_memory_pool().release_unused()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string or binary column; null rows are empty."""
    kind = pa.large_binary()
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
        column = pc.fill_null(column, "")
    else:
        column = pc.fill_null(column.cast(kind), b"")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; a run ends where a row ends."""
    if len(mask) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    first = np.concatenate([[0], edge]) if mask[0] else edge
    starts, ends = first[0::2], first[1::2]
    if len(ends) < len(starts):
        ends = np.append(ends, len(mask))
    cut = offsets[(offsets > 0) & (offsets < len(mask))]
    cut = np.unique(cut[mask[cut] & mask[cut - 1]])
    if len(cut):
        starts, ends = np.sort(np.append(starts, cut)), np.sort(np.append(ends, cut))
    return starts.astype(np.int64), ends.astype(np.int64)


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row of each span (empty rows have none)."""
    return np.searchsorted(offsets, starts, "right") - 1


def span_bounds(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bounds of each row's spans in the list of spans (one more than rows)."""
    return np.searchsorted(starts, offsets, "left")


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (splitmix constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gather(first: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values of the lists (first, size), one after the other."""
    total = int(sizes.sum())
    if not total:
        return values[:0]
    step = np.ones(total, np.int64)
    first, sizes = first[sizes > 0], sizes[sizes > 0]
    ends = np.cumsum(sizes)
    step[0] = first[0]
    step[ends[:-1]] = first[1:] - (first[:-1] + sizes[:-1] - 1)
    return values[np.cumsum(step)]


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


class SpanHasher:
    """Polynomial hashes modulo 2**64 of byte (or code point) spans, finalized with the length.

    Prefix sums over blocks of at most ``HASH_BLOCK`` values; a longer span is
    added up piece by piece.
    """

    def __init__(self, block: int = HASH_BLOCK):
        self.block = block
        self.up = _powers(_BASE, block)
        self.down = _powers(pow(_BASE, -1, _WORD), block)

    def _sums(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
        last = int(ends[-1])
        part = (data[base:last].astype(np.uint64) + np.uint64(1)) * self.up[:last - base]
        pre = np.zeros(last - base + 1, np.uint64)
        np.cumsum(part, out=pre[1:])
        a = starts - base
        return (pre[ends - base] - pre[a]) * self.down[np.minimum(a, self.block - 1)]

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each span; spans are in order and do not overlap."""
        out = np.zeros(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            base = int(starts[i])
            j = int(np.searchsorted(ends, base + self.block, "right"))
            if j > i:
                out[i:j] = self._sums(data, starts[i:j], ends[i:j], base)
                i = j
                continue
            total, stop = 0, int(ends[i])
            for at in range(base, stop, self.block):
                end = min(stop, at + self.block)
                piece = self._sums(data, np.array([at]), np.array([end]), at)[0]
                total = (total + int(piece) * pow(_BASE, at - base, _WORD)) % _WORD
            out[i] = total
            i += 1
        return mix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
