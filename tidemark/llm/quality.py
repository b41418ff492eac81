"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + <w, x> + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2))

so the pairwise interactions cost one pass over the non-zero features. Inputs are the words of the
text hashed into ``BUCKETS`` columns (share of the words, square root), their shapes, and binned
statistics of its structure; the only metadata is the text's own length. Language, source, id and
labels are no inputs.

The model is fitted on at most ``SAMPLE`` labelled rows, those with the smallest hashes of their ids,
in one task; every row is scored. Null and empty texts have no words and one structure bin each and
get a score like any other text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textkit import LOWER, U64, flat_text, runs, slices, span_hashes, word_spans

SAMPLE = 6_000
BUCKETS = 1 << 14
SHAPES = 64
BINS = 12
FACTORS = 8
EPOCHS = 6
BATCH = 64
THRESHOLD = 0.3
STATS = 14
FEATURES = BUCKETS + SHAPES + STATS * BINS


def held_out(folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls on the fold."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold


def _class_counts(flat: np.ndarray, offsets: np.ndarray, mask: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(mask, dtype=np.int64))
    return total[offsets[1:]] - total[offsets[:-1]]


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of a slice of texts: row starts (one more for the end), feature numbers, values."""
    flat, offsets = flat_text(texts)
    n = len(offsets) - 1
    size = np.diff(offsets)
    starts, ends, doc = word_spans(flat, offsets)
    low = LOWER[flat]
    hashes = span_hashes(low, starts, ends)
    words = np.bincount(doc, minlength=n).astype(np.float64)
    # shapes: first and last character kinds and length of a word
    kind = np.zeros(256, np.uint8)
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = 1, 2, 3, 1
    if len(starts):
        shape = kind[flat[starts]] * 16 + kind[flat[ends - 1]] * 4 + np.minimum((ends - starts) // 4, 3)
    else:
        shape = np.zeros(0, np.int64)
    bucket = (hashes >> U64(40)).astype(np.int64) % BUCKETS
    key = np.concatenate([doc * FEATURES + bucket, doc * FEATURES + BUCKETS + shape])
    key.sort()
    at = runs(key)
    rows, columns, counts = key[at[:-1]] // FEATURES, key[at[:-1]] % FEATURES, np.diff(at)
    values = np.sqrt(counts / np.maximum(words[rows], 1))
    # structure
    order = np.lexsort((hashes, doc))
    sd, sh = doc[order], hashes[order]
    new = np.append(True, (sd[1:] != sd[:-1]) | (sh[1:] != sh[:-1])) if len(sd) else np.zeros(0, bool)
    distinct = np.bincount(sd[new], minlength=n)
    same_next = np.zeros(n)
    if len(doc) > 1:
        again = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
        same_next = np.bincount(doc[1:][again], minlength=n)
    letters = _class_counts(flat, offsets, kind[flat] == 1)
    upper = _class_counts(flat, offsets, kind[flat] == 2)
    digits = _class_counts(flat, offsets, kind[flat] == 3)
    breaks = _class_counts(flat, offsets, flat == 10)
    stops = _class_counts(flat, offsets, (flat == 46) | (flat == 33) | (flat == 63))
    commas = _class_counts(flat, offsets, (flat == 44) | (flat == 59))
    odd = _class_counts(flat, offsets, np.isin(flat, np.frombuffer(b"#$%&*|<>{}[]~^\\/_=+@", np.uint8)))
    wide = _class_counts(flat, offsets, flat >= 128)
    blanks = _class_counts(flat, offsets, flat == 32)
    many, w = np.maximum(size, 1), np.maximum(words, 1)
    stats = np.stack(
        [
            np.log1p(size) / 12, np.log1p(words) / 10, size / w / 20, distinct / w, same_next / w, letters / many,
            5 * upper / many, 5 * digits / many, 20 * breaks / many, stops / w * 2, commas / w * 4, 5 * odd / many,
            3 * wide / many, 3 * blanks / many,
        ],
        axis=1,
    )
    binned = np.clip((stats * BINS).astype(np.int64), 0, BINS - 1) + np.arange(STATS) * BINS + BUCKETS + SHAPES
    rows = np.concatenate([rows, np.repeat(np.arange(n), STATS)])
    columns = np.concatenate([columns, binned.ravel()])
    values = np.concatenate([values, np.full(n * STATS, 1 / np.sqrt(STATS))])
    order = np.argsort(rows, kind="stable")
    begin = np.append(0, np.cumsum(np.bincount(rows, minlength=n)))
    return begin, columns[order], values[order].astype(np.float32)


@dataclass
class Machine:
    """Bias, linear weights and factors."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def sums(self, begin: np.ndarray, columns: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Raw outputs, and the per-factor sums that the gradient needs. Every row has a feature."""
        linear = np.add.reduceat(self.linear[columns] * values, begin[:-1])
        parts = self.factors[columns] * values[:, None]
        total = np.add.reduceat(parts, begin[:-1], axis=0)
        squares = np.add.reduceat((parts * parts).sum(axis=1), begin[:-1])
        return self.bias + linear + 0.5 * ((total * total).sum(axis=1) - squares), total

    def score(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        raw, _ = self.sums(*features(texts))
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30).astype(np.float64)))


def fit(texts: list[str | None], labels: np.ndarray, seed: int = 7) -> Machine:
    """Logistic loss, AdaGrad on shuffled mini-batches. Without labelled rows every score is 0.5."""
    rng = np.random.default_rng(seed)
    machine = Machine(0.0, np.zeros(FEATURES, np.float32), rng.normal(0, 0.05, (FEATURES, FACTORS)).astype(np.float32))
    if not len(labels):
        machine.factors[:] = 0
        return machine
    parts = [features(pa.array(texts[i : i + 256], pa.string())) for i in range(0, len(texts), 256)]
    begin = np.concatenate([[0], *[np.diff(p[0]) for p in parts]]).cumsum()
    columns, values = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    share = min(max(float(np.mean(labels)), 1e-3), 1 - 1e-3)
    machine.bias = float(np.log(share / (1 - share)))
    seen_l = np.full(FEATURES, 1e-6, np.float32)
    seen_f = np.full((FEATURES, FACTORS), 1e-6, np.float32)
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            counts = begin[rows + 1] - begin[rows]
            ends = np.cumsum(counts)
            take = np.repeat(begin[rows] - (ends - counts), counts) + np.arange(ends[-1])
            c, v, own = columns[take], values[take], np.repeat(np.arange(len(rows)), counts)
            raw, total = machine.sums(np.append(0, ends), c, v)
            error = ((1 / (1 + np.exp(-raw))) - labels[rows]).astype(np.float32)
            slope = error[own] * v
            g = np.zeros(FEATURES, np.float32)
            np.add.at(g, c, slope)
            gf = np.zeros((FEATURES, FACTORS), np.float32)
            np.add.at(gf, c, slope[:, None] * (total[own] - machine.factors[c] * v[:, None]))
            used = np.unique(c)
            g, gf = g[used] / len(rows) + 1e-5 * machine.linear[used], gf[used] / len(rows) + 1e-5 * machine.factors[used]
            seen_l[used] += g * g
            seen_f[used] += gf * gf
            machine.linear[used] -= 0.1 * g / np.sqrt(seen_l[used])
            machine.factors[used] -= 0.03 * gf / np.sqrt(seen_f[used])
            machine.bias -= 0.01 * float(error.mean())
    return machine


MODEL = "bias double, linear binary, factors binary"


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Fit on the labelled rows of ``labels`` (doc_id, quality): at most ``sample``, by hash of the id.

    Rows without label or id are left out. The sample is chosen before any text is read, and the
    machine, whose size is fixed, is what reaches the driver.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = joined.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))  # one row for an id

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema).sort_by([("doc_id", "ascending")])
        machine = fit(table.column("text").to_pylist(), table.column("label").to_numpy().astype(np.float32))
        cells = [[machine.bias], [machine.linear.tobytes()], [machine.factors.tobytes()]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in cells], ["bias", "linear", "factors"])

    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("label", pa.int32())])
    row = rows.select(F.col("doc_id").cast("long"), "text", "label").repartition(1).mapInArrow(learn, MODEL).first()
    return Machine(
        row["bias"],
        np.frombuffer(row["linear"], np.float32),
        np.frombuffer(row["factors"], np.float32).reshape(FEATURES, FACTORS),
    )


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """All columns of ``docs`` and ``quality_score``, which replaces one of that name. The model's size does not depend on the data."""
    docs = docs.drop("quality_score")
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    names = docs.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = pa.array(shared.value.score(batch.column("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*names, "quality_score"])

    fields = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes)
    return docs.mapInArrow(rows, f"{fields}, quality_score double")


def crc_fold(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds
