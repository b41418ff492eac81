"""Shared numpy helpers on Arrow text columns: slices of bounded size, words, rolling hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once in a task; the arrays of one slice take about 50 times as much.
BLOCK_BYTES = 1 << 20

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
BASE_INVERSE = U64(pow(int(BASE), -1, 1 << 64))

_byte = np.arange(256)
SPACE = (_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D))
LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U64(29))) * U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> U64(32))


BYTE_HASH = mix(_byte.astype(np.uint64) + U64(0x632BE59BD9B4E019))

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    global _powers, _inverses
    if len(_powers) < n:
        for name, base in (("_powers", BASE), ("_inverses", BASE_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers[:n], _inverses[:n]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the text of each slice is at most ``limit`` bytes, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and where each text begins (one more for the end). Null is empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def word_spans(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without white space), and the text that each is in."""
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~SPACE[flat]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(flat))]
    begin[cuts] = inside[cuts]
    stop[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans: equal bytes, equal hash, wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers, inverses = _power_tables(len(flat) + 1)
    table = BYTE_HASH if not seed else mix(BYTE_HASH + U64(seed))
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(table[flat] * powers[:-1], out=total[1:])
    h = (total[ends] - total[starts]) * inverses[starts]
    return mix(h + (ends - starts).astype(np.uint64) * U64(0x94D049BB133111EB))


def window_hashes(flat: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` bytes from each position; by doubling, so about 2*log2(k) passes."""
    n = len(flat)
    if n < k:
        return np.zeros(0, np.uint64)
    power, width, base, done, out = BYTE_HASH[flat], 1, BASE, 0, None
    with np.errstate(over="ignore"):
        while True:
            if k & width:
                m = n - done - width + 1
                out = power[:m] if out is None else out[:m] * base + power[done : done + m]
                done += width
            if width * 2 > k:
                return mix(out)
            m = n - 2 * width + 1
            power = power[:m] * base + power[width : width + m]
            base, width = base * base, width * 2


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    step, x = 1, a
    while step * 2 <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return x if step == width else np.minimum(x[: len(x) - (width - step)], x[width - step :])


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where runs of equal neighbours begin, with the length at the end."""
    if not len(sorted_keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1, [len(sorted_keys)]])


def ragged(counts: np.ndarray) -> np.ndarray:
    """0..counts[0]-1, 0..counts[1]-1 and so on, in one array."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
