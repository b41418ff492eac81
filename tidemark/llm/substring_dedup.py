"""Exact substring dedup by blockwise suffix sorting with a difference cover.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts earlier: in a document
with a smaller id, or earlier in the same one. Strings are judged on the input and never cross
documents; bytes of a null text are none. Rows that repeat an id follow each other by text; null ids
come first.

1. Every string has a content-chosen anchor, the smallest hash of its ``ANCHOR``-byte windows, so equal
   strings have equal anchors. Anchors met once anywhere cannot belong to a repeat; they are counted
   in packed arrays, one for each pair of task and bucket.
2. Stretches of strings with a repeated anchor are cut out of the text, one piece for each anchor, and
   pieces with one anchor meet. Frequent anchors (boilerplate with ever new surroundings) are replaced by
   anchors nearly as long as the strings, which spreads them. Equal pieces of a range of documents become one.
3. A block of pieces is a text of bounded size whose suffixes are sorted, one bucket of first bytes at a time.
   Suffixes that agree in ``PERIOD`` bytes are told apart by the ranks of a difference cover sample: for
   any two there is an offset at which both are sampled. Of equal strings the first is kept.
4. In each document the strings with repeated anchors that were not first are repeats; the bytes they
   cover go.

No text is compared with all others, the text itself moves once, and a group never grows with the number
of copies beyond one piece for each range of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ranges import id_of, range_index, shuffle_partitions, split_points
from tidemark.llm.textkit import BLOCK_BYTES, U64, flat_text, mix, ragged, runs, slices, sliding_min, span_hashes, window_hashes

LENGTH = 100
ANCHOR = 32
LONGER = 3  # the anchor of strings with a frequent one is this much shorter than they are
FREQUENT = 512
PERIOD = 32
COVER = (0, 1, 2, 3, 7, 11, 19)
BLOCK = 1 << 21
BUCKET_SUFFIXES = 1 << 17
FLUSH = 1 << 21
ORDINAL_BITS = 36  # documents in a range
PLACE = U64((1 << 20) - 1)


def _offsets() -> np.ndarray:
    """For residues a, b the smallest d with a+d and b+d in the cover."""
    inside = np.zeros(PERIOD, bool)
    inside[list(COVER)] = True
    a, b, d = np.ogrid[:PERIOD, :PERIOD, :PERIOD]
    both = inside[(a + d) % PERIOD] & inside[(b + d) % PERIOD]
    assert both.any(axis=2).all()
    return both.argmax(axis=2)


OFFSET = _offsets()


def _dense(key: np.ndarray) -> np.ndarray:
    """Ranks from 1; equal values, equal rank. Ties need no order, so numpy's fastest sort will do."""
    order = np.argsort(key)
    ranked = key[order]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(np.append(False, ranked[1:] != ranked[:-1])[: len(order)]) + 1
    return rank


def _paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Keys in the order of (first, second): dense ranks of both in one number."""
    return _dense(first) * np.int64(len(first) + 2) + _dense(second)


def _lexical(parts: list[np.ndarray]) -> np.ndarray:
    """Ranks (the number of smaller ones) in the order of (parts[0], parts[1], ...); only ties are looked at again."""
    n = len(parts[0])
    rank = np.zeros(n, np.int64)
    tied = np.arange(n)
    for part in parts:
        group = rank[tied]
        key = _dense(part[tied]) if part is parts[0] else group * np.int64(len(tied) + 2) + _dense(part[tied])
        order = np.argsort(key)
        key, group, tied = key[order], group[order], tied[order]
        place = np.arange(len(tied))
        new_group = np.append(True, group[1:] != group[:-1])[: len(tied)]
        new_key = np.append(True, key[1:] != key[:-1])[: len(tied)]
        first, least = (np.maximum.accumulate(np.where(new, place, 0)) for new in (new_group, new_key))
        rank[tied] = group + least - first
        alone = new_key & np.append(new_key[1:], True)[: len(tied)]
        tied = tied[~alone]
        if not len(tied):
            break
    return rank


def _period_rank(words: np.ndarray, spots: np.ndarray) -> np.ndarray:
    """Ranks of the PERIOD bytes from each spot; ``words`` has the 8 bytes from each place.

    Equal periods are brought together by one sort of a 64-bit mix of their bytes and verified, so only
    different ones are ranked. Should two of them ever share a mix, all are.
    """
    parts = [words[spots + i] for i in range(0, PERIOD, 8)]
    mixed = np.zeros(len(spots), np.uint64)
    for part in parts:
        mixed = mix(mixed * U64(0x9E3779B97F4A7C15) + part)
    order = np.argsort(mixed)
    new = np.append(True, mixed[order][1:] != mixed[order][:-1])[: len(order)]
    for part in parts:
        ranked = part[order]
        if (~new[1:] & (ranked[1:] != ranked[:-1])).any():
            return _lexical(parts)
    one = order[new]
    rank = np.empty(len(order), np.int64)
    rank[order] = _lexical([part[one] for part in parts])[np.cumsum(new) - 1]
    return rank


class CoverSample:
    """Ranks, to a depth of at least ``length`` bytes, of the suffixes of a block that start at sampled positions."""

    def __init__(self, words: np.ndarray, n: int, length: int = LENGTH):
        inside = np.zeros(PERIOD, bool)
        inside[list(COVER)] = True
        spots = np.flatnonzero(np.resize(inside, n))
        self.rank = np.zeros(n + 2 * length + 2 * PERIOD, np.int64)
        self.rank[spots] = _period_rank(words, spots)
        depth = PERIOD
        while depth < length:
            high = np.int64(len(spots) + 2)
            self.rank[spots] = _dense(self.rank[spots] * high + self.rank[spots + depth])
            depth *= 2

    def compare(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for suffixes that agree in the first PERIOD bytes."""
        d = OFFSET[i % PERIOD, j % PERIOD]
        return np.sign(self.rank[i + d] - self.rank[j + d])


def _resolve(items: np.ndarray, group: np.ndarray, sample: CoverSample) -> np.ndarray:
    """Order tied suffixes: rounds of three-way partition of all groups at once, by a pivot of each."""
    where = np.arange(len(items))
    active = where
    while len(active):
        g = group[active]
        at = runs(g)
        counts = np.diff(at)
        big = np.repeat(counts > 1, counts)
        active, g = active[big], g[big]
        if not len(active):
            break
        at = runs(g)
        counts = np.diff(at)
        own = items[active]
        pivot = np.repeat(own[at[:-1] + counts // 2], counts)
        side = sample.compare(own, pivot)
        order = np.argsort(3 * g + side)
        items[active] = own[order]
        side, g = side[order], g[order]
        # new groups are named by their first place; those equal to the pivot are done
        fresh = np.append(True, (g[1:] != g[:-1]) | (side[1:] != side[:-1]))
        names = active[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        group[active] = names
        active = active[side != 0]
    return items


def first_of_equal(text: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which strings text[s:s+length] are the first of their kind, in the order given."""
    n = len(text)
    wide = np.zeros(n + 5 * PERIOD + 16, np.uint64)
    wide[:n] = text
    for step in (1, 2, 4):
        wide[: len(wide) - step] = wide[: len(wide) - step] << U64(8 * step) | wide[step:]
    sample = CoverSample(wide, n, length)
    first = np.zeros(len(starts), bool)
    row_at = np.zeros(n, np.int64)  # starts are distinct within a block
    row_at[starts] = np.arange(len(starts))
    lead = (wide[starts] >> U64(48)).astype(np.uint16)
    by_lead = np.argsort(lead, kind="stable")
    ends = np.cumsum(np.bincount(lead, minlength=1 << 16))
    begin = 0
    while begin < len(starts):
        stop = int(ends[np.searchsorted(ends, begin + 1)])
        more = ends[np.searchsorted(ends, begin + BUCKET_SUFFIXES, side="right") - 1] if begin + BUCKET_SUFFIXES >= ends[0] else 0
        stop = max(stop, int(more))
        bucket = by_lead[begin:stop]
        spots = starts[bucket]
        rank = _period_rank(wide, spots)
        order = np.argsort(rank)
        tied = rank[order][1:] == rank[order][:-1]
        group = np.maximum.accumulate(np.where(np.append(False, tied), 0, np.arange(len(order))))
        sorted_spots = _resolve(spots[order].copy(), group, sample)
        rows = row_at[sorted_spots]
        same = np.flatnonzero(tied)
        for offset in [*range(PERIOD, length - 8, 8), length - 8]:
            same = same[wide[sorted_spots[same] + offset] == wide[sorted_spots[same + 1] + offset]]
        new = np.ones(len(rows), bool)
        new[same + 1] = False
        first[np.minimum.reduceat(rows, np.flatnonzero(new))] = True
        begin = stop
    return first


def _anchors(flat: np.ndarray, offsets: np.ndarray, size: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of the string at each position with its place in the low bits, and which positions begin a string.

    The place tells the anchors of a periodic text apart; `_value` drops it.
    """
    hashes = window_hashes(flat, size)
    placed = hashes & ~PLACE | np.arange(len(hashes), dtype=np.uint64) & PLACE
    anchor = sliding_min(placed, length - size + 1) if len(flat) >= length else np.zeros(0, np.uint64)
    begins = np.zeros(len(anchor), bool)
    sizes = np.diff(offsets)
    own = np.maximum(sizes - length + 1, 0)
    spots = np.repeat(offsets[:-1], own) + ragged(own)
    begins[spots] = True
    return anchor, begins


def _value(anchor: np.ndarray) -> np.ndarray:
    return anchor & ~PLACE


def _unique_anchors(batches: Iterator[pa.RecordBatch], buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    """Anchors of a task with their range of documents and count, packed by bucket."""
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def flush() -> pa.RecordBatch:
        anchor, chunk = (np.concatenate(x) for x in zip(*kept))
        order = np.argsort(_paired(anchor, chunk))
        anchor, chunk = anchor[order], chunk[order]
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (chunk[1:] != chunk[:-1]))
        counts = np.diff(np.append(np.flatnonzero(new), len(new)))
        anchor, chunk = anchor[new], chunk[new]
        bucket = (mix(anchor) % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        at = runs(bucket[order])
        cells = [order[a:b] for a, b in zip(at[:-1], at[1:])]
        columns = [
            pa.array([int(bucket[c[0]]) for c in cells], pa.int32()),
            pa.array([anchor[c].tobytes() for c in cells], pa.binary()),
            pa.array([chunk[c].astype(np.int32).tobytes() for c in cells], pa.binary()),
            pa.array([np.minimum(counts[c], FREQUENT).astype(np.uint16).tobytes() for c in cells], pa.binary()),
        ]
        kept.clear()
        return pa.RecordBatch.from_arrays(columns, ["bucket", "anchors", "chunks", "counts"])

    for batch in slices(batches):
        flat, offsets = flat_text(batch.column("text"))
        anchor, begins = _anchors(flat, offsets, ANCHOR, length)
        spots = np.flatnonzero(begins)
        if not len(spots):
            continue
        values = anchor[spots]
        # the strings of two documents are never neighbours
        new = np.append(True, (values[1:] != values[:-1]) | (np.diff(spots) != 1))
        doc = np.searchsorted(offsets, spots[new], side="right") - 1
        chunk = batch.column("chunk").to_numpy().astype(np.int32)
        kept.append((_value(values[new]), chunk[doc]))
        held += int(new.sum())
        if held >= FLUSH:
            yield flush()
            held = 0
    if kept:
        yield flush()


def _repeated_anchors(bucket: pd.DataFrame) -> pd.DataFrame:
    """The anchors of a bucket met twice or more, for each range of documents that holds them."""
    anchor = np.frombuffer(b"".join(bucket["anchors"]), np.uint64)
    chunk = np.frombuffer(b"".join(bucket["chunks"]), np.int32)
    counts = np.frombuffer(b"".join(bucket["counts"]), np.uint16).astype(np.int64)
    order = np.argsort(anchor, kind="stable")
    anchor, chunk, counts = anchor[order], chunk[order], counts[order]
    at = runs(anchor)
    total = np.repeat(np.add.reduceat(counts, at[:-1]), np.diff(at))
    keep = total > 1
    anchor, chunk, total = anchor[keep], chunk[keep], total[keep]
    order = np.lexsort((anchor, chunk))
    anchor, chunk, hot = anchor[order], chunk[order], total[order] >= FREQUENT
    at = runs(chunk)
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b > a:
            values, many = anchor[a:b], hot[a:b]
            new = np.append(True, values[1:] != values[:-1])
            out.append((int(chunk[a]), values[new & ~many].tobytes(), values[new & many].tobytes()))
    return pd.DataFrame(out, columns=["chunk", "anchors", "frequent"])


SIDE = "chunk int, anchors binary, frequent binary, ident long, pos long, n long"


def _member(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


class _Range:
    """The documents of a range in order, with the strings that may be repeats."""

    def __init__(self, docs: pa.Table, side: pa.Table, length: int):
        self.length = length
        texts = pc.fill_null(docs.column("text"), "")
        docs = docs.set_column(docs.schema.get_field_index("text"), "text", texts)
        self.docs = docs.take(pc.sort_indices(docs, [("id", "ascending"), ("text", "ascending")]))
        packed = side.filter(pc.is_valid(side.column("anchors")))
        self.cold, self.hot = (
            np.sort(np.frombuffer(b"".join(packed.column(name).to_pylist()), np.uint64)) for name in ("anchors", "frequent")
        )
        chunk = docs.column("chunk")[0].as_py() if docs.num_rows else 0
        self.base = chunk << ORDINAL_BITS

    def blocks(self) -> Iterator[tuple]:
        """Slices: first ordinal, bytes, offsets, anchors, and masks of cold and hot strings."""
        ordinal = 0
        for part in slices(iter(self.docs.select(["text"]).to_batches()), limit=BLOCK_BYTES):
            flat, offsets = flat_text(part.column("text"))
            anchor, begins = _anchors(flat, offsets, ANCHOR, self.length)
            anchor = _value(anchor)
            at = runs(anchor)  # neighbours mostly share their anchor
            cold, hot = (begins & np.repeat(_member(v, anchor[at[:-1]]), np.diff(at)) for v in (self.cold, self.hot))
            yield ordinal, flat, offsets, anchor, cold, hot
            ordinal += part.num_rows


PIECE = pa.schema([("key", pa.int64()), ("ident", pa.int64()), ("pos", pa.int64()), ("piece", pa.binary())])


def _pieces(docs: pa.Table, side: pa.Table, length: int) -> pa.Table:
    """Stretches of strings with one repeated anchor; equal ones of the range only once."""
    part, out = _Range(docs, side, length), []
    for ordinal, flat, offsets, anchor, cold, hot in part.blocks():
        long_anchor = None
        if hot.any():
            long_anchor, _ = _anchors(flat, offsets, length - LONGER, length)
            long_anchor = _value(long_anchor)
        for mask, values, seed in ((cold, anchor, 0), (hot, long_anchor, 1)):
            spots = np.flatnonzero(mask)
            if not len(spots):
                continue
            v = values[spots]
            new = np.append(True, (v[1:] != v[:-1]) | (np.diff(spots) != 1))
            begin = np.flatnonzero(new)
            doc = np.searchsorted(offsets, spots[begin], side="right") - 1
            count = np.diff(np.append(begin, len(spots)))
            starts, ends = spots[begin], spots[begin] + count + length - 1
            out.append(
                (
                    mix(v[begin] + U64(1)) if seed else v[begin],
                    part.base + ordinal + doc,
                    starts - offsets[doc],
                    span_hashes(flat, starts, ends),
                    [flat[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())],
                )
            )
    if not out:
        return PIECE.empty_table()
    key, ident, pos, h = (np.concatenate([o[i] for o in out]) for i in range(4))
    piece = [x for o in out for x in o[4]]
    order = np.lexsort((pos, ident))
    same = _paired(key[order], h[order])
    by = np.argsort(same)
    keep = order[np.sort(np.minimum.reduceat(by, runs(same[by])[:-1]))]
    return pa.table([key[keep].view(np.int64), ident[keep], pos[keep], pa.array([piece[i] for i in keep], pa.binary())], schema=PIECE)


def _firsts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Sort the pieces of a task block by block; yield the strings that come first, as runs."""
    held: list[pa.RecordBatch] = []
    size = 0

    def sort(block: pa.Table) -> pa.RecordBatch:
        block = block.sort_by([("ident", "ascending"), ("pos", "ascending")])
        piece = block.column("piece").combine_chunks()
        if isinstance(piece, pa.ChunkedArray):
            piece = piece.chunk(0)
        text, offsets = flat_text(piece)
        count = np.diff(offsets) - length + 1
        owner, inner = np.repeat(np.arange(len(count)), count), ragged(count)
        first = first_of_equal(text, offsets[owner] + inner, length)
        hits = np.flatnonzero(first)
        new = np.append(True, (np.diff(hits) != 1) | (owner[hits[1:]] != owner[hits[:-1]]))
        begin = np.flatnonzero(new)
        n = np.diff(np.append(begin, len(hits)))
        ident, pos = (block.column(c).to_numpy()[owner[hits[begin]]] for c in ("ident", "pos"))
        columns = [ident >> ORDINAL_BITS, ident, pos + inner[hits[begin]], n]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["chunk", "ident", "pos", "n"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column("piece").nbytes
        if size >= BLOCK:
            table = pa.Table.from_batches(held)
            keys = table.column("key").to_numpy()
            # the last key may go on in the next batch
            last = np.flatnonzero(keys[1:] != keys[:-1])
            cut = int(last[-1]) + 1 if len(last) else 0
            for part in _bounded(table.slice(0, cut)):
                yield sort(part)
            rest = table.slice(cut).combine_chunks()
            held, size = rest.to_batches(), rest.column("piece").nbytes
    if held:
        for part in _bounded(pa.Table.from_batches(held)):
            yield sort(part)


def _bounded(table: pa.Table) -> Iterator[pa.Table]:
    """Cut a table sorted by key between keys, at about BLOCK bytes."""
    keys = table.column("key").to_numpy()
    at = runs(keys)
    sizes = np.cumsum(pc.binary_length(table.column("piece")).to_numpy().astype(np.int64)) if len(keys) else keys
    start = 0
    for stop in at[1:]:
        if stop > start and (stop == len(keys) or sizes[stop - 1] - (sizes[start - 1] if start else 0) >= BLOCK):
            yield table.slice(start, stop - start)
            start = stop


RESULT = ("kept", "n_bytes", "n_removed", "n_spans")


def _freed(table: pa.Table) -> pa.Table:
    """Give memory that a range needed back to the machine; Arrow would keep it for the worker's next one."""
    pa.default_memory_pool().release_unused()
    return table


def _removed(docs: pa.Table, side: pa.Table, length: int) -> pa.Table:
    """What is left of the documents of a range; ``side`` has the repeated anchors and the runs that came first."""
    part = _Range(docs, side, length)
    found = side.filter(pc.is_valid(side.column("ident")))
    ident, pos, n = (found.column(name).to_numpy().astype(np.int64) for name in ("ident", "pos", "n"))
    order = np.argsort(ident, kind="stable")
    ident, pos, n = ident[order] - part.base, pos[order], n[order]
    kept, removed, spans, sizes = [], [], [], []
    for ordinal, flat, offsets, _, cold, hot in part.blocks():
        repeat = cold | hot
        a, b = np.searchsorted(ident, [ordinal, ordinal + len(offsets) - 1])
        where = np.repeat(offsets[ident[a:b] - ordinal] + pos[a:b], n[a:b]) + ragged(n[a:b])
        repeat[where] = False
        edge = np.zeros(len(flat) + 1, np.int64)
        hits = np.flatnonzero(repeat)
        edge[hits] += 1  # places are distinct
        edge[hits + length] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        begin = gone.copy()
        begin[1:] &= ~gone[:-1]
        cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(flat))]
        begin[cuts] = gone[cuts]
        for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            kept.append(flat[x:y][~gone[x:y]].tobytes())
            removed.append(int(gone[x:y].sum()))
            spans.append(int(begin[x:y].sum()))
            sizes.append(y - x)
    numbers = (pa.array(x, pa.int64()) for x in (sizes, removed, spans))
    return pa.table([part.docs.column("row"), pa.array(kept, pa.binary()), *numbers], names=["row", *RESULT])


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``kept`` (the bytes left), ``n_bytes``, ``n_removed``, ``n_spans``, and all columns of ``docs`` but ``text``.

    Other columns pass unseen and unchanged, whatever their names; only one named like a result is replaced by
    it. ``length`` may be any from 48 bytes on.
    """
    if length < ANCHOR + 16:
        raise ValueError(f"length must be at least {ANCHOR + 16}")
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    points = split_points(docs, 4 * parts)
    own = [F.col(f"`{name}`") for name in docs.columns if name != "text" and name not in RESULT]
    rows = docs.select(F.struct(*own).alias("row"), id_of().alias("id"), range_index(points).alias("chunk"), "text")
    packed = rows.select("chunk", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        lambda batches: _unique_anchors(batches, max(8, parts // 2), length),
        "bucket int, anchors binary, chunks binary, counts binary",
    )
    repeated = packed.groupBy("bucket").applyInPandas(_repeated_anchors, "chunk int, anchors binary, frequent binary")
    nothing = F.lit(None).cast("long")
    side = repeated.select("chunk", "anchors", "frequent", nothing.alias("ident"), nothing.alias("pos"), nothing.alias("n"))
    by_chunk = rows.groupBy("chunk")  # shuffled once for both passes over the texts
    pieces = by_chunk.cogroup(side.groupBy("chunk")).applyInArrow(
        lambda d, s: _freed(_pieces(d, s, length)), "key long, ident long, pos long, piece binary"
    )
    firsts = (
        pieces.repartition(parts, "key")
        .sortWithinPartitions("key")
        .mapInArrow(lambda batches: _firsts(batches, length), "chunk int, ident long, pos long, n long")
    )
    empty = F.lit(None).cast("binary")
    both = side.unionByName(firsts.select("chunk", empty.alias("anchors"), empty.alias("frequent"), "ident", "pos", "n"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, kept binary, n_bytes long, n_removed long, n_spans long"
    left = by_chunk.cogroup(both.groupBy("chunk")).applyInArrow(lambda d, s: _freed(_removed(d, s, length)), schema)
    return left.select("row.*", *RESULT)


def text_of(column: str) -> Column:
    """Bytes as text; what is left of a character that was cut is left out."""

    @F.pandas_udf("string")
    def decode(data: pd.Series) -> pd.Series:
        return data.map(lambda x: None if x is None else bytes(x).decode("utf-8", "ignore"))

    return decode(F.col(column))
