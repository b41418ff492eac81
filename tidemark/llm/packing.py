"""Best-fit decreasing packing of token sequences.

Documents longer than a sequence are cut into whole sequences, the first piece taking what is
left over. Pieces go by descending length into the tightest open sequence that has room; a segment
tree over the remaining capacities finds it in logarithmic time. Only lengths decide, so the run is
planned on the counts of pieces by length: a plan row places so many pieces of one length into
consecutive sequences at one offset. The plan has at most some thousand rows whatever the number
of documents, is made once, and every piece then finds its place by its rank among the pieces of its
length. Thus the packing is that of one best-fit run over all pieces, without one task seeing them.

Ids come from a byte-level BPE vocabulary file (tokenizers JSON) that every executor has.
Null and empty texts are documents of one token, the end token. Repeated ids are packed as separate
documents, a null id is kept.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.textkit import ragged, runs, slices
from tidemark.scratch import new_dir

CAPACITY = 1024
END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, nth long"
PACKED_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


# The fixed word pattern of the vocabulary, with possessive runs.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@lru_cache(maxsize=4)
def _encoding(path: str):
    """The byte-level vocabulary of a tokenizers JSON; its ids are also the ranks of the merges."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[x] for x in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special), special


def token_ids(path: str, text: str) -> bytes:
    """Ids as little-endian unsigned 32-bit integers; a special token's string is that token."""
    encoding, special = _encoding(path)
    if any(s in text for s in special):
        ids = encoding.encode(text, allowed_special="all", disallowed_special=())
    else:
        ids = encoding.encode_ordinary(text)
    return np.array(ids, "<u4").tobytes()


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: the smallest one of at least ``need`` with open bins."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.width)

    def set(self, capacity: int, value: bool) -> None:
        node = capacity + self.width
        self.open[node] = value
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, need: int) -> int | None:
        node = need + self.width
        if self.open[node]:
            return need
        while node > 1 and (node % 2 or not self.open[node + 1]):
            node //= 2
        if node <= 1:
            return None
        node += 1
        while node < self.width:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.width


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, number, first bin, offset): pieces of a length into consecutive bins."""
    tree, rows = CapacityTree(capacity), []
    bins: dict[int, list[tuple[int, int]]] = {}  # remaining capacity -> ranges (first bin, number)
    created = 0

    def put(remaining: int, first: int, number: int) -> None:
        if remaining:
            if not bins.get(remaining):
                tree.set(remaining, True)
            bins.setdefault(remaining, []).append((first, number))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                # new bins hold as many of this length as fit, one bin after the other
                fit = min(capacity // length, left)
                number = left // fit
                for i in range(fit):
                    rows.append((length, rank + i * number, number, created, i * length))
                put(capacity - fit * length, created, number)
                created, rank, left = created + number, rank + fit * number, left - fit * number
                continue
            first, number = bins[remaining].pop()
            if not bins[remaining]:
                tree.set(remaining, False)
            fit = min(remaining // length, left)
            taken = min(number, left // fit)
            for i in range(fit):
                rows.append((length, rank + i * taken, taken, first, capacity - remaining + i * length))
            if taken < number:
                put(remaining, first + taken, number - taken)
            put(remaining - fit * length, first, taken)
            rank, left = rank + fit * taken, left - fit * taken
    return rows


def tokenised(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents, each with its task and its number among the task's pieces of its length."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, end = TaskContext.get().partitionId(), int(end_id).to_bytes(4, "little")
        seen = np.zeros(capacity + 1, np.int64)
        for batch in slices(batches):
            ids = [token_ids(path, t or "") + end for t in batch.column("text").to_pylist()]
            total = np.array([len(x) // 4 for x in ids], np.int64)
            pieces = -(-total // capacity)
            doc, number = np.repeat(np.arange(len(ids)), pieces), ragged(pieces)
            first = total - (pieces - 1) * capacity
            start = np.where(number > 0, first[doc] + (number - 1) * capacity, 0)
            length = np.where(number > 0, capacity, first[doc])
            crc = [zlib.crc32(ids[d][4 * s : 4 * (s + n)]) for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist())]
            order = np.argsort(length, kind="stable")
            nth = np.empty(len(doc), np.int64)
            nth[order] = ragged(np.diff(runs(length[order])))
            nth += seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()).take(pa.array(doc)),
                    pa.array(number.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crc, pa.int64()),
                    pa.array(np.full(len(doc), task, np.int64)),
                    pa.array(nth),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"],
            )

    return docs.select("doc_id", "text").mapInArrow(rows, PIECES)


def _placed(ranked: DataFrame, rows: np.ndarray) -> DataFrame:
    """Look up each piece's sequence in the plan, which is bounded by the capacity and not by the data."""
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    wide = int((rows[:, 1] + rows[:, 2]).max() + 1) if len(rows) else 1
    shared = ranked.sparkSession.sparkContext.broadcast(rows)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan_rows = shared.value
        keys = plan_rows[:, 0] * wide + plan_rows[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length * wide + rank, side="right") - 1
            sequence = plan_rows[at, 3] + rank - plan_rows[at, 1]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(plan_rows[at, 4])], PACKED_NAMES)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(look, schema)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Sequence and offset of every piece of every document.

    The pieces are written once. A piece's rank among all of its length is its number within its
    task plus those of the tasks before; that table has a row for each task and length.
    """
    spark = docs.sparkSession
    table = new_dir(spark, "pieces")
    tokenised(docs, path, capacity, end_id).write.parquet(table)
    pieces = spark.read.schema(PIECES).parquet(table)
    by_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["task", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    rows = np.array(plan({r["length"]: r["n"] for r in counts}, capacity), np.int64).reshape(-1, 5)
    return _placed(ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank"), rows)
