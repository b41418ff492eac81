"""Document fingerprints by context-triggered piecewise hashing.

A hash rolling over the last seven bytes ends a chunk where it hits a value that depends on the
block size; each chunk becomes one character. A fingerprint is ``size:signature:signature`` with
the signatures at the block size and at twice that size, at most 64 characters each, so texts of up
to twice the length remain comparable. Likeness is ``1 - d / (m + n)`` for the edit distance ``d``
(insertions and deletions) of signatures of ``m`` and ``n`` characters at a common block size, and
0 if they share no run of seven characters (or half of the shorter signature).

Null and empty texts have the fingerprint ``1::``; two of them are alike (1.0), an empty and a
non-empty one are not (0.0). Texts of any length are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ranges import id_of, range_index, shuffle_partitions, split_points
from tidemark.llm.textkit import BASE, BASE_INVERSE, BYTE_HASH, U64, mix, slices

WINDOW = 7
SIGNATURE = 64
SMALLEST = 1
SHARED_RUN = 7
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
PAIRS_AT_ONCE = 512

_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _tables or len(_tables["up"]) < n:
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps, dtype=np.uint64)
    return _tables["up"][:n], _tables["down"][:n]


def _rolling(data: np.ndarray) -> np.ndarray:
    """Sum, weighted sum and shifted xor of the last ``WINDOW`` bytes, added; bytes before the text are 0."""
    n = len(data)
    wide = np.zeros(n + WINDOW - 1, np.uint32)
    wide[WINDOW - 1 :] = data
    total = np.zeros(n, np.uint32)
    shifted = np.zeros(n, np.uint32)
    for age in range(WINDOW):
        part = wide[WINDOW - 1 - age : WINDOW - 1 - age + n]
        total += part * np.uint32(1 + WINDOW - age)
        shifted ^= part << np.uint32(5 * age % 32)
    h = (total + shifted) * np.uint32(0x9E3779B1)
    return h ^ (h >> np.uint32(15))


def _signature(ends: np.ndarray, n: int, sums: np.ndarray, down: np.ndarray) -> str:
    """One character a chunk; what follows the 63rd chunk is one more chunk."""
    stops = ends[: SIGNATURE - 1] + 1
    if not len(stops) or stops[-1] < n:
        stops = np.append(stops, n)
    starts = np.concatenate([[0], stops[:-1]])
    h = mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))
    return ALPHABET[(h >> U64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(data: bytes) -> str:
    """The fingerprint of one text."""
    n = len(data)
    if not n:
        return f"{SMALLEST}::"
    flat = np.frombuffer(data, np.uint8)
    size = SMALLEST
    while size * SIGNATURE < n:
        size *= 2
    rolled = _rolling(flat)
    low = max(SMALLEST, size // 8)
    marks = None
    while True:
        if marks is None or size < low:
            low = min(low, size)
            marks = np.flatnonzero(rolled & np.uint32(low - 1) == low - 1)
            values = rolled[marks]
        ends = marks[values & np.uint32(size - 1) == size - 1]
        if len(ends) >= SIGNATURE // 2 - 1 or size == SMALLEST:
            break
        size //= 2
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_HASH[flat] * up[:n], out=sums[1:])
    double = marks[values & np.uint32(2 * size - 1) == 2 * size - 1]
    return f"{size}:{_signature(ends, n, sums, down)}:{_signature(double, n, sums, down)}"


def _padded(signatures: list[str], fill: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in signatures], np.int64)
    flat = np.frombuffer("".join(s.ljust(SIGNATURE, "\0") for s in signatures).encode(), np.uint8)
    table = flat.reshape(-1, SIGNATURE).copy()
    table[table == 0] = fill
    return table, lengths


def _common_subsequence(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each pair, 64 columns of a row at once as bits."""
    weights = U64(1) << np.arange(SIGNATURE, dtype=np.uint64)
    row = np.full(len(left), ~U64(0), np.uint64)
    for j in range(SIGNATURE):
        match = ((left == right[:, j : j + 1]) * weights).sum(axis=1, dtype=np.uint64)
        both = row & match
        row = (row + both) | (row - both)
    return SIGNATURE - np.bitwise_count(row).astype(np.int64)


def _shares_run(left: np.ndarray, right: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Whether a pair has a common run of ``need`` characters."""
    run = (left[:, :, None] == right[:, None, :]).astype(np.int8)
    best = run.max(axis=(1, 2)).astype(np.int64)
    longest = run
    for _ in range(SHARED_RUN - 1):
        longest = np.where(run[:, 1:, 1:] & (longest[:, :-1, :-1] > 0), longest[:, :-1, :-1] + 1, 0).astype(np.int8) if longest.shape[1] > 1 else longest
        if longest.shape[1] <= 1:
            break
        best = np.maximum(best, longest.max(axis=(1, 2)))
        run = run[:, 1:, 1:]
    return best >= need


def _score(left: list[str], right: list[str]) -> np.ndarray:
    """Likeness of signatures at one block size."""
    a, m = _padded(left, 1)
    b, n = _padded(right, 2)
    out = (m == n).astype(np.float64) * np.array([x == y for x, y in zip(left, right)], np.float64)
    todo = np.flatnonzero((out == 0) & (m > 0) & (n > 0))
    for at in range(0, len(todo), PAIRS_AT_ONCE):
        k = todo[at : at + PAIRS_AT_ONCE]
        k = k[_shares_run(a[k], b[k], np.minimum(SHARED_RUN, (np.minimum(m[k], n[k]) + 1) // 2))]
        if len(k):
            out[k] = 2 * _common_subsequence(a[k], b[k]) / (m[k] + n[k])
    return out


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """Likeness (0 to 1) of fingerprints, pair by pair; 0 where the block sizes are not compatible."""
    parts = [[f.split(":") for f in side] for side in (left, right)]
    sizes = [np.array([int(p[0]) for p in side], np.int64) for side in parts]
    out = np.zeros(len(left))
    for i, j, fits in (
        (1, 1, sizes[0] == sizes[1]),
        (2, 2, sizes[0] == sizes[1]),
        (2, 1, 2 * sizes[0] == sizes[1]),
        (1, 2, sizes[0] == 2 * sizes[1]),
    ):
        k = np.flatnonzero(fits)
        if len(k):
            out[k] = np.maximum(out[k], _score([parts[0][x][i] for x in k], [parts[1][x][j] for x in k]))
    return out


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id and fingerprint of every text."""
    kind = dict(docs.dtypes)[id_column]

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = [fingerprint((t or "").encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints, pa.string())], ["id", "fingerprint"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(one, f"id {kind}, fingerprint string").withColumnRenamed("id", id_column)


def in_order_with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows cut into id ranges, each followed by a copy of the row that comes next (``copy`` true).

    After the last row comes the first. Only the split points and the first id of each range reach
    the driver; the text moves once. Rows with equal ids are ordered by text, null ids come first.
    """
    spark = docs.sparkSession
    n = ranges or shuffle_partitions(spark)
    points = split_points(docs, n)
    part = range_index(points).alias("part")
    firsts = docs.select(part, id_of().alias("id")).groupBy("part").agg(F.min("id").alias("id")).orderBy("part").collect()
    before = {row["id"]: firsts[i - 1]["part"] for i, row in enumerate(firsts)}
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), id_of().alias("id"), part)
    place = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col("id")] if before else F.lit(None)
    own = F.struct("part", F.lit(False).alias("copy"))
    again = F.struct(place.cast("int").alias("part"), F.lit(True).alias("copy"))
    spread = F.when(place.isNull(), F.array(own)).otherwise(F.array(own, again))
    return (
        rows.withColumn("to", F.explode(spread))
        .select("to.part", "to.copy", "id", "doc_id", "text")
        .repartition(n, "part")
        .sortWithinPartitions("part", "copy", "id", "text")
    )


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut] if cut else text


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint beside those of its edited text and of the next document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        held = None  # (part, doc_id, text, fingerprint) that waits for its next

        def flush() -> pa.RecordBatch:
            ids, lengths, shas, own, changed, following = zip(*done)
            arrays = [ids, lengths, shas, own, changed, likeness(own, changed), likeness(own, following)]
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = [part.split()[0] for part in SCHEMA.split(", ")]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, types)], names)

        for batch in slices(batches):
            columns = (batch.column(c).to_pylist() for c in ("part", "copy", "doc_id", "text"))
            for part, copy, doc_id, text in zip(*columns):
                if copy and (held is None or held[0] != part):
                    continue  # a further row with the id that begins the next range
                own = fingerprint(text.encode())
                if held is not None:
                    _, last_id, last, last_own = held
                    new = edited(last, text)
                    data = new.encode()
                    changed = last_own if new == last else fingerprint(data)
                    done.append((last_id, len(last), hashlib.sha256(data).hexdigest(), last_own, changed, own))
                held = None if copy else (part, doc_id, text, own)
                if len(done) >= 2048:
                    yield flush()
        if done:
            yield flush()

    ordered = in_order_with_next(docs.select("doc_id", "text"))
    return ordered.select("part", "copy", "doc_id", "text").mapInArrow(rows, SCHEMA)
