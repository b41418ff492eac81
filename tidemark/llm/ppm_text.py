"""Language-model scoring by prediction by partial matching over the bytes of the running text.

A text is its words (A-Z in lower case), each followed by a space, and an end symbol. A byte is coded in the
last ``ORDER`` bytes before it, at every position and across the ends of words; what precedes the text is
read as end symbols. If the byte is new there, an escape leads to the context one byte shorter, down to none,
where the symbols of the longer context are excluded; below that all 257 symbols not yet excluded are equally
likely. Escape probabilities are estimated as in ``ppm``, for each length of context by itself. The score of a
text is the log10 of its probability, the pretrained code length.

The cost of a byte follows from the byte and the ``ORDER`` bytes before it, one gram of 64 bits. Blocks of
documents count their different grams; buckets of grams that agree in the last ``ppm.ORDER`` + 1 bytes of
context sum them, so that a bucket holds all contexts longer than ``ppm.ORDER`` of its grams, of every length.
Shorter ones, 257**3 entries at most, and the escape estimates are sent to all tasks. Buckets return the
costs (32 bits each) to the blocks, which look up every position of their texts. Only the distinct grams
of a bucket are held at once, whatever the number of blocks.

The unigram base gives each token (word or end) log10((c + 1) / (N + V + 1)); words are compared by 64-bit hashes.

Null and empty texts consist of the end token alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ppm import BITS, DISTINCT, KINDS, SCORED, Contexts, Model, left_out
from tidemark.llm.ppm import ORDER as KNOWN
from tidemark.llm.ppm import _keys as node_keys
from tidemark.llm.ranges import shuffle_partitions
from tidemark.llm.textkit import LOWER, flat_text, mix, ragged, runs, slices, span_hashes, word_spans
from tidemark.scratch import materialise

ORDER = 6  # bytes of the longest context; with the byte that follows, at most 8
END = 10  # no word holds it
BLOCK = 24 << 20  # bytes of running text in a block
SHARE = 8 << 20  # bytes of running text for each bucket
PENDING = 1 << 20  # counts that may wait to be merged
SENT = 4 << 20  # bytes of values that may wait to be sent

BLOCKS = "block string, n_bytes long, ids array<long>, held_out binary, sizes binary, text binary"
COUNTS = "bucket int, word boolean, block string, keys binary, n binary"
VALUES = "block string, bucket int, word boolean, keys binary, n binary"
STATS = "bucket int, word boolean, keys binary, n binary, node long, cell int, seen long, escaped long"


def _pack(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, all first bytes before all second ones."""
    plain = np.ascontiguousarray(values)
    planes = plain.view(np.uint8).reshape(len(plain), plain.itemsize).T.tobytes()
    return len(plain).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if len(plain) else b"")


def _unpack(data: bytes, kind: type) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = pa.decompress(data[8:], n * width, "zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(width, n).T.copy().view(kind)[:, 0]


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=keys.dtype.type(0)))


def _unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.int64), dtype=np.int64)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows by a schema of long, int, boolean, string, binary and array<long> columns."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    types = [kinds.get(kind, pa.list_(pa.int64())) for _, kind in fields]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [name for name, _ in fields])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one; packed values are copied out of a batch only when it is their turn."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with sums."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    at = runs(keys)[:-1]
    return (keys[at], np.add.reduceat(n, at)) if len(keys) else (keys, n)


class Sums:
    """Sums by key of what is added, merged from time to time."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((keys, n))
        self.waiting += len(keys)
        if self.waiting > PENDING + len(self.parts[0][0]):
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.parts, self.waiting = [_summed(*(np.concatenate(x) for x in zip(*self.parts)))], 0
        return self.parts[0]


def running_text(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts, each as ORDER end symbols, its words with a space after each, and the end symbol; their lengths."""
    flat = LOWER[flat]
    starts, ends, doc = word_spans(flat, offsets)
    lengths, docs = ends - starts, len(offsets) - 1
    sizes = np.bincount(doc, lengths + 1, docs).astype(np.int64) + ORDER + 1
    out = np.full(int(sizes.sum()), END, np.uint8)
    first = np.cumsum(lengths + 1) - (lengths + 1) + (ORDER + 1) * doc + ORDER
    inner = ragged(lengths)
    out[np.repeat(first, lengths) + inner] = flat[np.repeat(starts, lengths) + inner]
    out[first + lengths] = 32
    return out, sizes


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Blocks of documents as running text, cut when they reach so many bytes."""
    from pyspark import TaskContext

    task, number, held = TaskContext.get().partitionId(), 0, 0
    docs: list[tuple] = []

    def flush() -> pa.RecordBatch:
        ids, apart, sizes, text = zip(*docs)
        row = (sum(ids, []), np.concatenate(apart).tobytes(), np.concatenate(sizes).tobytes())
        return _batch([(f"{task}-{number}", held, *row, pa.compress(b"".join(text), "zstd", asbytes=True))], BLOCKS)

    for batch in slices(batches):
        text, sizes = running_text(*flat_text(batch.column("text")))
        apart = np.array(batch.column("held_out").to_pylist(), bool)
        docs.append((batch.column("doc_id").to_pylist(), apart, sizes, text.tobytes()))
        held += len(text)
        if held >= block:
            yield flush()
            docs.clear()
            held, number = 0, number + 1
    if docs:
        yield flush()


def _pieces(row: dict, limit: int = 1 << 19) -> Iterator[tuple]:
    """Of a block, a few documents at a time: ids, held out, number of document and gram of every coded byte, and of every token its hash."""
    apart, sizes = np.frombuffer(row["held_out"], bool), np.frombuffer(row["sizes"], np.int64)
    text = np.frombuffer(pa.decompress(row["text"], row["n_bytes"], "zstd", asbytes=True), np.uint8)
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        start = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, start + limit, side="right")))
        part, own = text[start : int(ends[b - 1])], sizes[a:b]
        gram = np.zeros(len(part) - ORDER, np.int64)
        for i in range(ORDER + 1):
            gram = gram << 8 | part[i : len(part) - ORDER + i]
        inner, doc = ragged(own)[ORDER:], np.repeat(np.arange(b - a), own)[ORDER:]
        coded = inner >= ORDER
        stops = np.flatnonzero(((part[ORDER:] == 32) | (part[ORDER:] == END)) & coded) + ORDER
        # a word ends before its space; the end symbol is a token by itself
        last = part[stops] == END
        begins = np.append(ORDER, stops[:-1] + 1 + np.where(last[:-1], ORDER, 0))
        tokens = span_hashes(part, begins, np.where(last, stops + 1, stops)).view(np.int64)
        yield row["ids"][a:b], apart[a:b], doc[coded], gram[coded], doc[stops - ORDER], tokens
        a = b


def _buckets(keys: np.ndarray, word: bool, buckets: int) -> np.ndarray:
    """Words by hash; grams by the last bytes of context beyond those that every task knows."""
    own = keys.view(np.uint64) if word else mix(keys.view(np.uint64) >> np.uint64(8) & np.uint64((1 << 8 * (KNOWN + 1)) - 1))
    return (own % np.uint64(buckets)).astype(np.int64)


def block_counts(buckets: int):
    """Counts in training texts of the different grams and words of a block, those of other texts with 0, by bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            grams, words = Sums(), Sums()
            for _, apart, doc, gram, token_doc, token in _pieces(row):
                grams.add(*_summed(gram, (~apart[doc]).astype(np.int64)))
                words.add(*_summed(token, (~apart[token_doc]).astype(np.int64)))
            for word, sums in ((False, grams), (True, words)):
                keys, n = sums.merged()
                sums.parts = []
                bucket = _buckets(keys, word, buckets)
                order = np.argsort(bucket, kind="stable")
                keys, n, bucket = keys[order], n[order], bucket[order]
                at = runs(bucket)
                out = [(int(bucket[a]), word, row["block"], _pack_keys(keys[a:b]), _pack(n[a:b])) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                del keys, n, bucket, order
                yield _batch(out, COUNTS)
        pa.default_memory_pool().release_unused()  # Arrow would keep it for the worker's next task

    return counted


def _short(size: int) -> int:
    return (1 << 8 * size) - 1


def contexts(keys: np.ndarray, n: np.ndarray, order: int) -> Contexts:
    """Contexts of some bytes, from distinct grams with training counts."""
    own = n > 0
    entries, sums = _summed(keys[own] & _short(order + 1), n[own])
    return Contexts(entries >> 8, entries & 255, sums)


def bucket_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket: its sums, what they say about escapes, and what they add to the short contexts."""
    now, sums = None, Sums()

    def finished() -> pa.RecordBatch:
        (bucket, word), (keys, n) = now, sums.merged()
        out = [(bucket, word, _pack_keys(keys), _pack(n), *[None] * 4)]
        if word:
            out.append((None, True, None, None, None, None, int(n.sum()), int((n > 0).sum())))
            return _batch(out, STATS)
        size = KINDS * BITS * DISTINCT
        cells = np.zeros((2, size))
        for k in range(KNOWN + 1, ORDER + 1):
            own = contexts(keys, n, k)
            cells += left_out(np.full(len(own.context), k), own.total, own.distinct, own.single)
        out += [(None, False, None, None, None, i, int(cells[0, i]), int(cells[1, i])) for i in np.flatnonzero(cells[0]).tolist()]
        entries, total = _summed(keys[n > 0] & _short(KNOWN + 1), n[n > 0])
        out += [(None, False, None, None, x, None, y, None) for x, y in zip(entries.tolist(), total.tolist())]
        return _batch(out, STATS)

    for row in _rows(batches):
        if now != (row["bucket"], row["word"]):
            if now is not None:
                yield finished()
            now, sums = (row["bucket"], row["word"]), Sums()
        sums.add(_unpack_keys(row["keys"]), _unpack(row["n"], np.int64))
    if now is not None:
        yield finished()


def gram_costs(model: Model, keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log10 probability of the last byte of each gram of a bucket."""
    cost, hidden, hidden_kinds = (np.zeros(len(keys)) for _ in range(3))
    open_ = np.ones(len(keys), bool)
    levels = {k: (model.orders[k], model.shadows[k]) for k in range(KNOWN + 1)}
    for k in range(KNOWN + 1, ORDER + 1):
        own = contexts(keys, n, k)
        levels[k] = own, own.shadow(levels[k - 1][0], own.context[own.owner] & _short(k - 1))
    for k in range(ORDER, -1, -1):
        now = np.flatnonzero(open_)
        own, shadow = levels[k]
        open_[model.step(cost, hidden, hidden_kinds, now, k, own, keys >> 8 & _short(k), keys & 255, shadow)] = False
    cost[open_] -= np.log10(np.maximum(257 - hidden_kinds[open_], 1.0))
    return cost


def _model(short: pa.Table, cells: list) -> Model:
    """The contexts that every task knows, from the entries of the longest of them, and all estimates."""
    entries, n = short.column("node").to_numpy(), short.column("n").to_numpy()
    levels = [_summed(entries & _short(k + 1), n) for k in range(KNOWN + 1)]
    keys = np.concatenate([node_keys(k, e >> 8, e & 255) for k, (e, _) in enumerate(levels)])
    model = Model(keys, np.concatenate([s for _, s in levels]))
    for row in cells:
        model.cells[:, row["cell"]] += (row["seen"], row["escaped"])
    return model


def score(docs: DataFrame, held_out: Column, block: int = BLOCK, share: int = SHARE) -> DataFrame:
    """Code length of every text under the model of the rows that ``held_out`` leaves in."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held_out.alias("held_out"))
    blocks = materialise(rows.mapInArrow(lambda batches: _blocks(batches, block), BLOCKS), "lm-blocks")
    size = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n")).first()["n"]
    tasks = shuffle_partitions(spark)
    buckets = max(tasks, -(-size // share))
    counts = materialise(blocks.mapInArrow(block_counts(buckets), COUNTS), "lm-counts")
    dealt = counts.repartition(tasks, "bucket", "word").sortWithinPartitions("bucket", "word")
    stats = materialise(dealt.mapInArrow(bucket_sums, STATS), "lm-sums")
    sums = stats.filter("bucket IS NOT NULL").select("bucket", "word", F.lit(None).cast("string").alias("block"), "keys", "n")
    short = stats.filter("node IS NOT NULL").groupBy("node").agg(F.sum("seen").alias("n")).toArrow()  # at most 257**3
    cells = stats.filter("cell IS NOT NULL").groupBy("cell").agg(F.sum("seen").alias("seen"), F.sum("escaped").alias("escaped")).collect()
    tokens = stats.filter("bucket IS NULL AND word").agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("seen", "escaped")]).first()
    everything, kinds = tokens["seen"], tokens["escaped"]
    shared = spark.sparkContext.broadcast(_model(short, cells))

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, values = np.zeros(0, np.int64), np.zeros(0)
        out, held = [], 0
        for row in _rows(batches):
            keys, word = _unpack_keys(row["keys"]), row["word"]
            if row["block"] is None:  # the sums of a bucket come before its blocks
                own, values = keys, _unpack(row["n"], np.int64)
                if not word:
                    values = gram_costs(shared.value, own, values).astype(np.float32)
                continue
            out.append((row["block"], row["bucket"], word, row["keys"], _pack(values[np.searchsorted(own, keys)])))
            held += len(out[-1][3]) + len(out[-1][4])
            if held >= SENT:
                yield _batch(out, VALUES)
                out, held = [], 0
        yield _batch(out, VALUES)
        pa.default_memory_pool().release_unused()

    asked = counts.withColumn("n", F.lit(None).cast("binary"))  # of a block only its keys are asked for
    both = asked.unionByName(sums).repartition(tasks, "bucket", "word").sortWithinPartitions("bucket", "word", F.col("block").asc_nulls_first())
    values = both.mapInArrow(valued, VALUES)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, now = [field.split()[0] for field in SCORED.split(", ")], None
        parts: dict[tuple[bool, int], tuple[np.ndarray, np.ndarray]] = {}

        def found(word: bool, keys: np.ndarray, kind: type) -> np.ndarray:
            """The values of keys, each looked up in its own bucket."""
            bucket, values = _buckets(keys, word, buckets), np.zeros(len(keys), kind)
            order = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
            at = runs(bucket[order])
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                own, known = parts[word, int(bucket[order[a]])]
                values[order[a:b]] = known[np.searchsorted(own, keys[order[a:b]])]
            return values

        for row in _rows(batches):
            if row["block"] != now:
                now = row["block"]
                parts.clear()
            if row["text"] is None:  # the values of a block come before its text
                parts[row["word"], row["bucket"]] = _unpack_keys(row["keys"]), _unpack(row["n"], np.int64 if row["word"] else np.float32)
                continue
            for ids, apart, doc, gram, token_doc, token in _pieces(row):
                cost, count = found(False, gram, np.float32), found(True, token, np.int64)
                n, base = len(ids), np.log10((count + 1) / (everything + kinds + 1))
                columns = [
                    pa.array(ids, pa.int64()),
                    pa.array(apart),
                    np.bincount(token_doc, minlength=n),
                    np.bincount(token_doc, count > 0, n).astype(np.int64),
                    np.full(n, everything, np.int64),
                    np.bincount(token_doc, base, n),
                    np.bincount(doc, cost, n),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
        pa.default_memory_pool().release_unused()

    together = values.unionByName(blocks, allowMissingColumns=True).repartition(tasks, "block")
    ordered = together.sortWithinPartitions("block", F.col("text").isNotNull())
    return ordered.mapInArrow(add_up, SCORED)
