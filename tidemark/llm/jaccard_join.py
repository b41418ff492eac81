"""N-gram Jaccard join by grouped prefixes.

A document is the set of its distinct word shingles. In a common order, rare shingles first, two sets
can only reach the threshold if their prefixes share a shingle and their sizes are close. Documents of
one size and prefix form a group, which takes part once. Lists of groups by prefix shingle, cut where
sizes are too far apart, connect the groups that may hold linked members; the members of connected
groups meet, one row for each different set, and are verified exactly. Large connected sets are dealt
out as pairs of tiles, so no task sees more than two tiles. A tile pair reports only the links that
join something new, so a thousand near copies yield hundreds of rows rather than all pairs.

The order is by document frequency, counted over all documents: shingles' leading 32 bits are packed in sorted
arrays for each pair of task and bucket, and a range of documents gets back those that occur elsewhere
with the magnitude of their count. Only shingles that occur elsewhere need to be listed. Words are runs without white space, A-Z in lower case; with fewer words than a shingle has,
the whole sequence is the one shingle; null, empty and blank texts have none and no links. Rows
without id take no part and have no component; rows that share an id share its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import Forest, components
from tidemark.llm.ranges import range_index, shuffle_partitions, split_points
from tidemark.llm.textkit import LOWER, U64, flat_text, mix, ragged, runs, slices, span_hashes, word_spans
from tidemark.scratch import materialise

SHINGLE = 4
PERCENT = 85
TILE = 64
FLUSH = 1 << 21


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Row starts (one more for the end) and the distinct shingle hashes of each text, ascending."""
    flat, offsets = flat_text(texts)
    n = len(offsets) - 1
    flat = LOWER[flat]
    starts, ends, doc = word_spans(flat, offsets)
    h = span_hashes(flat, starts, ends)
    words = np.bincount(doc, minlength=n)
    begin = np.cumsum(words) - words
    count = np.where(words >= width, words - width + 1, (words > 0).astype(np.int64))
    owner, inner = np.repeat(np.arange(n), count), ragged(count)
    first = begin[owner] + inner
    length = np.minimum(words[owner], width)
    out = length.astype(np.uint64)
    for i in range(width):
        inside = i < length
        part = np.where(inside, h[np.minimum(first + i, max(len(h) - 1, 0))] if len(h) else U64(0), U64(0))
        out = mix(out * U64(0x9E3779B97F4A7C15) + part)
    order = np.lexsort((out, owner))
    owner, out = owner[order], out[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (out[1:] != out[:-1])) if len(out) else np.zeros(0, bool)
    owner, out = owner[new], out[new]
    return np.append(0, np.cumsum(np.bincount(owner, minlength=n))), out


def _pack(values: np.ndarray) -> bytes:
    """Ascending 32-bit integers as differences, byte plane by byte plane, which Spark's codec then shrinks."""
    return np.diff(values, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _counted(batches: Iterator[pa.RecordBatch], buckets: int, width: int) -> Iterator[pa.RecordBatch]:
    """The shingles of a task with range of documents and count, packed by bucket."""
    held: list[tuple] = []
    size = 0

    def flush() -> pa.RecordBatch:
        short, chunk = (np.concatenate(x) for x in zip(*held))
        held.clear()
        key = np.sort(short.astype(np.uint64) << U64(32) | chunk.astype(np.uint64))
        at = runs(key)
        counts = np.minimum(np.diff(at), 255).astype(np.uint8)
        short, chunk = (key[at[:-1]] >> U64(32)).astype(np.uint32), (key[at[:-1]] & U64(0xFFFFFFFF)).astype(np.int32)
        bucket = (short.astype(np.int64) * buckets) >> 32
        cuts = runs(bucket)
        spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        columns = [
            pa.array([int(bucket[x]) for x, _ in spans], pa.int32()),
            pa.array([_pack(short[x:y]) for x, y in spans], pa.binary()),
            pa.array([chunk[x:y].tobytes() for x, y in spans], pa.binary()),
            pa.array([counts[x:y].tobytes() for x, y in spans], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "shingles", "chunks", "counts"])

    for batch in slices(batches):
        begin, values = shingle_sets(batch.column("text"), width)
        chunk = np.repeat(batch.column("chunk").to_numpy(), np.diff(begin))
        held.append(((values >> U64(32)).astype(np.uint32), chunk))
        size += len(values)
        if size >= FLUSH:
            yield flush()
            size = 0
    if size:
        yield flush()


def _elsewhere(bucket: pd.DataFrame) -> pd.DataFrame:
    """For each range of documents its shingles of two documents or more, with the magnitude of their count."""
    short = np.concatenate([_unpack(x) for x in bucket["shingles"]])
    chunk = np.frombuffer(b"".join(bucket["chunks"]), np.int32)
    counts = np.frombuffer(b"".join(bucket["counts"]), np.uint8)
    order = np.argsort(short, kind="stable")
    short, chunk, counts = short[order], chunk[order], counts[order]
    at = runs(short)
    total = np.add.reduceat(counts.astype(np.int64), at[:-1])
    size = np.repeat(np.minimum(np.log2(total).astype(np.uint8), 63), np.diff(at))
    keep = size > 0
    short, chunk, size = short[keep], chunk[keep], size[keep]
    order = np.argsort(chunk, kind="stable")
    short, chunk, size = short[order], chunk[order], size[order]
    at, out = runs(chunk), []
    for x, y in zip(at[:-1].tolist(), at[1:].tolist()):
        if y > x:
            new = np.append(True, short[x + 1 : y] != short[x : y - 1])
            out.append((int(chunk[x]), _pack(short[x:y][new]), size[x:y][new].tobytes()))
    return pd.DataFrame(out, columns=["part", "shingles", "sizes"])


OUT = "kind int, doc_id long, n int, sig1 long, sig2 long, grp long, bucket int, tokens binary, groups binary, low binary, high binary"
NAMES = [field.split()[0] for field in OUT.split(", ")]
TYPES = [pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), *[pa.binary()] * 4]


def _filled(rows: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[n], t) if n in columns else pa.nulls(rows, t) for n, t in zip(NAMES, TYPES)], NAMES
    )


def _close(small: np.ndarray, large: np.ndarray, percent: int) -> np.ndarray:
    return 100 * small >= percent * large


def _chains(token: np.ndarray, group: np.ndarray, low: np.ndarray, high: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """Runs of postings of one token whose sizes are close: chain edges, and one posting for each run."""
    order = np.lexsort((group, low, token))
    token, group, low, high = token[order], group[order], low[order], high[order]
    # the largest size so far, within a token
    at = runs(token)
    lift = np.repeat(np.arange(len(at) - 1), np.diff(at)) * np.int64(1 << 33)
    reach = np.maximum.accumulate(high + lift) - lift if len(high) else high
    linked = np.append(False, (token[1:] == token[:-1]) & _close(reach[:-1], np.maximum(low[1:], 0), percent) | (token[1:] == token[:-1]) & (low[1:] <= reach[:-1])) if len(token) else np.zeros(0, bool)
    edges = np.flatnonzero(linked)
    a, b = group[edges - 1], group[edges]
    head = np.flatnonzero(~linked)
    top = np.maximum.reduceat(high, head) if len(head) else high
    return a, b, token[head], group[head], low[head], top


def _prefixes(docs: pa.Table, shared: pa.Table, buckets: int, width: int, percent: int) -> pa.Table:
    """Of a range of documents. Kind 0: a row for each. Kind 1: edges of groups. Kind 2: packed postings."""
    parts = [_unpack(x) for x in shared["shingles"].to_pylist()]
    common = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    rank = np.frombuffer(b"".join(shared["sizes"].to_pylist()), np.uint8).astype(np.int64)
    order = np.argsort(common, kind="stable")
    common, rank = common[order], rank[order]
    texts = iter(docs.select(["doc_id", "text"]).to_batches())
    found = list(_prefix_rows(texts, common, rank, buckets, width, percent))
    pa.default_memory_pool().release_unused()  # Arrow would keep it for the worker's next range
    return pa.Table.from_batches(found, pa.schema(list(zip(NAMES, TYPES))))


def _prefix_rows(
    batches: Iterator[pa.RecordBatch], common: np.ndarray, rank: np.ndarray, buckets: int, width: int, percent: int
) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        token, group, n = (np.concatenate(x) for x in zip(*held))
        held.clear()
        a, b, token, group, low, high = _chains(token, group, n, n, percent)
        differ = a != b
        pairs = np.unique(np.stack([np.minimum(a, b)[differ], np.maximum(a, b)[differ]], axis=1), axis=0)
        if len(pairs):
            yield _filled(len(pairs), kind=np.full(len(pairs), 1, np.int32), doc_id=pairs[:, 0], grp=pairs[:, 1])
        bucket = (mix(token) % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        at = runs(bucket[order])
        cells = [order[x:y] for x, y in zip(at[:-1], at[1:])]
        yield _filled(
            len(cells),
            kind=np.full(len(cells), 2, np.int32),
            bucket=[int(bucket[c[0]]) for c in cells],
            tokens=[token[c].tobytes() for c in cells],
            groups=[group[c].tobytes() for c in cells],
            low=[low[c].astype(np.int32).tobytes() for c in cells],
            high=[high[c].astype(np.int32).tobytes() for c in cells],
        )

    for batch in slices(batches):
        begin, values = shingle_sets(batch.column("text"), width)
        n = np.diff(begin)
        owner = np.repeat(np.arange(len(n)), n)
        weight = np.zeros(len(values), np.int64)
        if len(common):
            short = (values >> U64(32)).astype(np.uint32)
            spot = np.minimum(np.searchsorted(common, short), len(common) - 1)
            weight = np.where(common[spot] == short, rank[spot], 0)
        order = np.lexsort((values, weight, owner))
        values, weight = values[order], weight[order]
        length = np.where(n > 0, n + (-percent * n // 100) + 1, 0)  # n - ceil(percent n / 100) + 1
        prefix = ragged(n) < length[owner]
        add = lambda x, of: np.array([np.add.reduce(x[i:j], dtype=np.uint64) for i, j in zip(of[:-1], of[1:])], np.uint64)
        sig1, sig2 = add(mix(values), begin), add(mix(values ^ U64(0x5851F42D4C957F2D)), begin)
        cut = np.append(0, np.cumsum(length))
        group = mix(add(mix(values[prefix] + U64(77)), cut) * U64(0x9E3779B97F4A7C15) + n.astype(np.uint64)).view(np.int64)
        ids = batch.column("doc_id")
        yield _filled(
            len(n), kind=np.zeros(len(n), np.int32), doc_id=ids, n=n.astype(np.int32),
            sig1=sig1.view(np.int64), sig2=sig2.view(np.int64), grp=group,
        )
        listed = prefix & (weight > 0) & np.array(ids.is_valid())[owner]
        held.append((values[listed], group[owner[listed]], n[owner[listed]]))
        size += int(listed.sum())
        if size >= FLUSH:
            yield from flush()
            size = 0
    if held:
        yield from flush()


def _bucket_edges(bucket: pd.DataFrame, percent: int) -> pd.DataFrame:
    token = np.frombuffer(b"".join(bucket["tokens"]), np.uint64)
    group = np.frombuffer(b"".join(bucket["groups"]), np.int64)
    low, high = (np.frombuffer(b"".join(bucket[c]), np.int32).astype(np.int64) for c in ("low", "high"))
    a, b, *_ = _chains(token, group, low, high, percent)
    differ = a != b
    pairs = np.unique(np.stack([np.minimum(a, b)[differ], np.maximum(a, b)[differ]], axis=1), axis=0)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def verify(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links among sets that join something new, found by an exact count of common shingles."""
    n = np.array([len(s) for s in sets], np.int64)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    kinds, at, counts = np.unique(values, return_inverse=True, return_counts=True)
    shared = counts[at] > 1
    column = np.cumsum(counts > 1) - 1
    inside = np.zeros((len(sets), len(sets)), np.float32)
    wide, o, c = int((counts > 1).sum()), owner[shared], column[at[shared]]
    for start in range(0, wide, 1 << 15):
        part = (c >= start) & (c < start + (1 << 15))
        table = np.zeros((len(sets), min(1 << 15, wide - start)), np.float32)
        table[o[part], c[part] - start] = 1
        inside += table @ table.T
    common = inside.astype(np.int64)
    linked = np.triu(100 * common >= percent * (n[:, None] + n[None, :] - common), 1)
    forest = Forest(len(sets))
    return [(a, b) for a, b in zip(*(x.tolist() for x in np.nonzero(linked))) if forest.join(a, b)]


def _verified(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tile pair: the links of each."""
    key, ids, sets = None, [], []

    def close() -> Iterator[pa.RecordBatch]:
        if len(sets) > 1:
            found = verify(sets, percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([ids[a] for a, _ in found], pa.int64()), pa.array([ids[b] for _, b in found], pa.int64())], ["a", "b"])

    for batch in slices(batches):
        begin, values = shingle_sets(batch.column("text"), width)
        keys = zip(*(batch.column(c).to_pylist() for c in ("cluster", "i", "j")))
        for row, (own, doc_id) in enumerate(zip(keys, batch.column("doc_id").to_pylist())):
            if own != key:
                yield from close()
                key, ids, sets = own, [], []
            ids.append(doc_id)
            sets.append(values[begin[row] : begin[row + 1]])
    yield from close()


def similar_groups(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = rows.withColumn("chunk", range_index(split_points(rows, 2 * parts)))
    counted = ranged.select("chunk", "text").mapInArrow(
        lambda b: _counted(b, 2 * parts, width), "bucket int, shingles binary, chunks binary, counts binary"
    )
    shared = counted.groupBy("bucket").applyInPandas(_elsewhere, "part int, shingles binary, sizes binary")
    prefixes = ranged.groupBy("chunk").cogroup(shared.groupBy("part"))
    scanned = materialise(prefixes.applyInArrow(lambda d, c: _prefixes(d, c, 2 * parts, width, percent), OUT), "shingles")
    each = scanned.filter("kind = 0").select("doc_id", "n", "sig1", "sig2", "grp")
    near = scanned.filter("kind = 1").select(F.col("doc_id").alias("a"), F.col("grp").alias("b"))
    packed = scanned.filter("kind = 2").select("bucket", "tokens", "groups", "low", "high")
    far = packed.groupBy("bucket").applyInPandas(lambda b: _bucket_edges(b, percent), "a long, b long")
    clusters = components(near.union(far).distinct())

    # one row for each different set: its smallest document stands for all
    full = each.filter("n > 0 AND doc_id IS NOT NULL")
    sets = full.groupBy("sig1", "sig2", "n", "grp").agg(F.min("doc_id").alias("rep"))
    sets = materialise(
        sets.join(clusters, sets["grp"] == clusters["node"], "left").select(
            "sig1", "sig2", "n", "rep", F.coalesce("component", "grp").alias("cluster")
        ),
        "sets",
    )
    sizes = sets.groupBy("cluster").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    tiles = F.ceil(F.col("m") / TILE).cast("int")
    dealt = materialise(
        sets.join(sizes, "cluster").select("rep", "cluster", tiles.alias("tiles"), F.pmod(F.xxhash64("rep"), tiles).cast("int").alias("tile")),
        "members",
    )
    texts = rows.join(dealt, rows["doc_id"] == dealt["rep"]).select("doc_id", "text", "cluster", "tile", "tiles")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    pairs = texts.withColumn("other", other).select(
        "doc_id", "text", "cluster", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j")
    )
    links = (
        pairs.repartition(4 * parts, "cluster", "i", "j")
        .sortWithinPartitions("cluster", "i", "j")
        .mapInArrow(lambda b: _verified(b, width, percent), "a long, b long")
    )
    linked = components(links)
    of_set = sets.join(linked, sets["rep"] == linked["node"], "left").select(
        "sig1", "sig2", "n", F.coalesce("component", "rep").alias("component_id")
    )
    found = each.join(of_set, ["sig1", "sig2", "n"], "left")
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    return found.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
