"""Links between the tokens of two tokenizers, by whitespace-token anchors.

Every whole text is encoded by a byte-level vocabulary (A, over a space and the text) and by a
sentencepiece model (B, which adds the space itself). Where both streams have a token end and both next
tokens begin with a space lies an anchor, verified on the bytes; anchors cut a text into windows of token
ids. A window's alignment (its groups between shared ends, and the id pairs linked in them) depends on its
ids alone, so it is worked out once for a tuple of ids and remembered.

Counts of pairs are corpus-wide. Tasks encode blocks of about BLOCK_BYTES of text and write one row for
each: a dictionary of its pairs with the number of documents holding them, and each document's pairs as
positions in it. Only dictionaries are shuffled: summed by pair, compared by A id, and sent back to
their blocks, where the documents' columns are added up. Texts do not move and nothing is broadcast.

A null or empty text, and one whose joined token bytes differ from space + text, has no tokens: zeros and
an empty digest. Null and repeated ids each give a row of their own and count as documents; columns
other than ``doc_id`` and ``text`` are ignored; texts have no length limit; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textkit import U64, mix, ragged, slices
from tidemark.scratch import materialise

BLOCK_BYTES = 2 << 20
REMEMBERED = 300_000  # windows; more are forgotten, and worked out again when met
WIDE_GROUP = 1024  # links of a group from which pairs are counted by numpy

# Fixed value: the pattern of the byte-level vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens, where each begins, its length, and whether it begins with a space."""
    sizes = np.array([len(t) for t in tokens], np.int64)
    flat = np.frombuffer(b"".join(tokens), np.uint8)
    return flat, np.cumsum(sizes) - sizes, sizes, np.array([t[:1] == b" " for t in tokens])


@lru_cache(maxsize=2)
def _byte_level(path: str):
    """Encoder of space + text, and the token table, of a tokenizers JSON."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"] for t in spec["added_tokens"]}
    vocab = spec["model"]["vocab"]
    ranks = {bytes(byte_of[x] for x in t): i for t, i in vocab.items() if t not in special}
    encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = [b""] * (max(vocab.values()) + 1)
    for token, number in ranks.items():
        tokens[number] = token
    return encoding, _table(tokens)


@lru_cache(maxsize=2)
def _pieces(path: str):
    """Processor and token table of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        tokens.append(bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace("▁", " ").encode())
    return model, _table(tokens)


def encode(texts: list[str], byte_path: str, piece_path: str) -> tuple[list, list]:
    """Token ids of each text by both tokenizers; strings of special tokens are plain text."""
    encoding, model = _byte_level(byte_path)[0], _pieces(piece_path)[0]
    return [encoding.encode_to_numpy(" " + t) for t in texts], model.encode(texts, num_threads=1)


def _joined(ids: np.ndarray, table: tuple) -> np.ndarray:
    flat, starts, sizes, _ = table
    return _pick(flat, sizes[ids], starts[ids])


def _pick(flat: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``counts`` neighbours from each of ``starts``."""
    return flat[np.repeat(starts, counts) + ragged(counts)]


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([len(x) for x in lists], np.int64)
    if lists and isinstance(lists[0], np.ndarray):
        return np.concatenate(lists).astype(np.int64), counts
    return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts


def _unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different values, and the place of each value among them; by hashing, not by sorting all."""
    codes, keys = pd.factorize(values, sort=True)
    return keys, codes


def _before(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


class Windows:
    """Alignments of windows by their tuples of ids: groups as text, numbers of groups and links, pairs and their times."""

    def __init__(self, sizes_a: np.ndarray, sizes_b: np.ndarray):
        self.sizes_a, self.sizes_b = sizes_a, sizes_b
        numbers = [str(i).encode() for i in range(max(len(sizes_a), len(sizes_b)))]
        self.digits = _table(numbers)
        self.clear()

    def clear(self) -> None:
        self.number: dict[tuple[bytes, bytes], int] = {}
        self.shown: list[bytes] = []  # every group ends with a semicolon
        none = np.zeros(0, np.int64)
        self.groups = self.links = self.counts = self.starts = self.pairs = self.times = none

    def look_up(self, windows: list[tuple[bytes, bytes]]) -> np.ndarray:
        """The numbers of windows given as pairs of little-endian ids; those not met before are aligned together."""
        number, fresh = self.number, []
        found = []
        for window in windows:
            n = number.get(window)
            if n is None:
                n = number[window] = len(number)
                fresh.append(window)
            found.append(n)
        if fresh:
            self._align(*([np.frombuffer(b"".join(ids), "<u4").astype(np.int64), np.array([len(x) // 4 for x in ids])] for ids in zip(*fresh)))
        return np.array(found, np.int64)

    def _align(self, side_a: list[np.ndarray], side_b: list[np.ndarray]) -> None:
        (a, count_a), (b, count_b) = side_a, side_b
        end_a, end_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        many_a, many_b = np.bincount(group_a, minlength=len(shared)), np.bincount(group_b, minlength=len(shared))
        first_a, first_b = _before(many_a), _before(many_b)
        window = np.searchsorted(end_a[np.cumsum(count_a) - 1], shared)  # of each group

        # the groups as text: tokens of A, then of B, each followed by its separator
        ids, after = np.zeros(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.uint8)
        place_a, place_b = np.arange(len(a)) + first_b[group_a], np.arange(len(b)) + (first_a + many_a)[group_b]
        ids[place_a], ids[place_b], after[:] = a, b, ord(",")
        after[place_a[first_a + many_a - 1]], after[place_b[first_b + many_b - 1]] = ord("|"), ord(";")
        flat, starts, sizes, _ = self.digits
        sizes = sizes[ids] + 1
        text = _pick(np.append(flat, np.uint8(0)), sizes, starts[ids])
        text[np.cumsum(sizes) - 1] = after
        ends = np.cumsum(sizes)[np.cumsum(count_a + count_b) - 1].tolist()
        data, begin = text.tobytes(), 0
        for end in ends:
            self.shown.append(data[begin:end])
            begin = end

        # the linked pairs of all groups: each token of A with every one of B
        links = many_a * many_b
        rows = [np.stack([np.full(len(y), window[g]), x << 32 | y, t]) for g in np.flatnonzero(links >= WIDE_GROUP).tolist() for x, y, t in self._wide(a[first_a[g] :][: many_a[g]], b[first_b[g] :][: many_b[g]])]
        narrow = links[group_a] < WIDE_GROUP
        times = many_b[group_a[narrow]]
        left = np.repeat(a[narrow], times)
        right = _pick(b, times, first_b[group_a[narrow]])
        rows.append(np.stack([np.repeat(window[group_a[narrow]], times), left << 32 | right, np.ones(len(left), np.int64)]))
        where, pair, often = np.concatenate(rows, axis=1)
        kinds, kind = _unique(pair)
        cells, back = _unique(where * len(kinds) + kind)
        sums = np.zeros(len(cells), np.int64)
        np.add.at(sums, back, often)
        counts = np.bincount(cells // len(kinds), minlength=len(count_a))
        self.starts = np.append(self.starts, len(self.pairs) + _before(counts))
        self.counts = np.append(self.counts, counts)
        self.pairs, self.times = np.append(self.pairs, kinds[cells % len(kinds)]), np.append(self.times, sums)
        self.groups = np.append(self.groups, np.bincount(window, minlength=len(count_a)))
        total = np.zeros(len(count_a), np.int64)
        np.add.at(total, window, links)
        self.links = np.append(self.links, total)

    @staticmethod
    def _wide(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The different pairs of a large group and how often each is linked."""
        (xs, nx), (ys, ny) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
        for x, n in zip(xs, nx):
            yield np.full(len(ys), x), ys, n * ny


@lru_cache(maxsize=1)
def _memory(byte_path: str, piece_path: str) -> Windows:
    return Windows(_byte_level(byte_path)[1][2], _pieces(piece_path)[1][2])


def _distinct(a: np.ndarray, b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray) -> tuple[list[tuple[bytes, bytes]], np.ndarray]:
    """The different windows as id bytes, and the place of each window among them.

    Windows are brought together by a 64-bit hash of their ids, and compared with one of their kind id by id.
    """
    starts_a, starts_b = np.append(0, stop_a[:-1]), np.append(0, stop_b[:-1])
    sides = [(ids, begin, stop - begin) for ids, begin, stop in ((a, starts_a, stop_a), (b, starts_b, stop_b))]
    mixed = [_sums(mix((ids.astype(np.uint64) << U64(20)) + ragged(counts).astype(np.uint64) + U64(side)), counts) for side, (ids, _, counts) in enumerate(sides)]
    place, kinds = pd.factorize(mix(mixed[0]) + mixed[1])
    model = np.zeros(len(kinds), np.int64)
    model[place[::-1]] = np.arange(len(place))[::-1]  # the first window of each kind
    twin = model[place]
    same = np.ones(len(place), bool)
    for ids, begin, counts in sides:
        same &= counts == counts[twin]
    for ids, begin, counts in sides:
        size = np.where(same, counts, 0)
        differs = _pick(ids, size, begin) != _pick(ids, size, begin[twin])
        same &= np.bincount(np.repeat(np.arange(len(size)), size), weights=differs, minlength=len(size)) == 0
    strangers = np.flatnonzero(~same)  # windows that only share a hash
    place[strangers] = len(model) + np.arange(len(strangers))
    model = np.concatenate([model, strangers])
    bytes_a, bytes_b = a.astype("<u4").tobytes(), b.astype("<u4").tobytes()
    cuts = (np.stack([starts_a, stop_a, starts_b, stop_b])[:, model] * 4).tolist()
    return [(bytes_a[p:q], bytes_b[r:s]) for p, q, r, s in zip(*cuts)], place


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of unsigned values, modulo 2**64."""
    total = np.append(U64(0), np.cumsum(values, dtype=np.uint64))
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _equal_texts(joined: np.ndarray, counts: np.ndarray, spaced: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which texts' joined token bytes are the text's own."""
    same = counts == sizes
    starts, at = np.cumsum(counts) - counts, np.cumsum(sizes) - sizes
    rows = np.flatnonzero(same)
    within = ragged(sizes[rows])
    differs = joined[np.repeat(starts[rows], sizes[rows]) + within] != spaced[np.repeat(at[rows], sizes[rows]) + within]
    wrong = np.bincount(np.repeat(rows, sizes[rows]), weights=differs, minlength=len(sizes)) > 0
    return same & ~wrong


def align_block(texts: list[str | None], byte_path: str, piece_path: str) -> dict:
    """Counts and digests of each text, and the block's pairs; see :func:`_block_row` for the columns."""
    table_a, table_b = _byte_level(byte_path)[1], _pieces(piece_path)[1]
    memory = _memory(byte_path, piece_path)
    if len(memory.number) > REMEMBERED:
        memory.clear()
    n = len(texts)
    out = {name: np.zeros(n, np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
    out["groups_sha256"] = [""] * n
    rows = np.array([i for i, t in enumerate(texts) if t], np.int64)
    data = [texts[i] for i in rows.tolist()]
    (a, count_a), (b, count_b) = (_flat(x) for x in encode(data, byte_path, piece_path))
    spaced = [b" " + t.encode() for t in data]
    sizes = np.array([len(x) for x in spaced], np.int64)
    flat = np.frombuffer(b"".join(spaced), np.uint8)
    good = np.ones(len(data), bool)
    for ids, counts, table in ((a, count_a, table_a), (b, count_b, table_b)):
        ends = np.append(0, np.cumsum(table[2][ids]))
        places = np.append(0, np.cumsum(counts))
        good &= _equal_texts(_joined(ids, table), np.diff(ends[places]), flat, sizes)
    kept = np.flatnonzero(good)
    a, b = (_pick(ids, counts[kept], _before(counts)[kept]) for ids, counts in ((a, count_a), (b, count_b)))
    count_a, count_b, rows = count_a[kept], count_b[kept], rows[kept]
    out["n_a"][rows], out["n_b"][rows] = count_a, count_b
    if not len(rows):
        return out | _pairs_of(np.zeros(0, np.int64), np.zeros(0, np.int64), memory, n)

    end_a, end_b = np.cumsum(table_a[2][a]), np.cumsum(table_b[2][b])
    shared = np.intersect1d(end_a, end_b, assume_unique=True)
    next_a, next_b = np.searchsorted(end_a, shared) + 1, np.searchsorted(end_b, shared) + 1
    spaced_a, spaced_b = np.append(table_a[3][a], True), np.append(table_b[3][b], True)
    text_ends = np.cumsum(count_a)
    anchor = (spaced_a[next_a] & spaced_b[next_b]) | np.isin(next_a, text_ends, assume_unique=False)
    stop_a, stop_b = next_a[anchor], next_b[anchor]
    different, place = _distinct(a, b, stop_a, stop_b)
    window = memory.look_up(different)[place]
    owner = np.searchsorted(text_ends, stop_a, side="left")
    for name, values in (("n_groups", memory.groups), ("n_links", memory.links)):
        totals = np.zeros(len(rows), np.int64)
        np.add.at(totals, owner, values[window])
        out[name][rows] = totals
    edges, shown, numbers = np.append(0, np.cumsum(np.bincount(owner, minlength=len(rows)))).tolist(), memory.shown, window.tolist()
    for row, begin, end in zip(rows.tolist(), edges[:-1], edges[1:]):
        groups = b"".join([shown[w] for w in numbers[begin:end]])
        out["groups_sha256"][row] = hashlib.sha256(memoryview(groups)[:-1]).hexdigest()
    return out | _pairs_of(rows[owner], window, memory, n)


def _pairs_of(row: np.ndarray, window: np.ndarray, memory: Windows, n: int) -> dict:
    """The block's sorted pairs with their numbers of documents; each document's pairs as places in them, and times."""
    known = max(len(memory.counts), 1)
    held, same = _unique(row * known + window)
    often = np.bincount(same, minlength=len(held))
    row, window = held // known, held % known
    counts, starts = memory.counts[window], memory.starts[window]
    keys, place = _unique(_pick(memory.pairs, counts, starts))
    width = max(len(keys), 1)
    cells, back = _unique(np.repeat(row, counts) * width + place)
    linked = np.zeros(len(cells), np.int64)
    np.add.at(linked, back, _pick(memory.times, counts, starts) * np.repeat(often, counts))
    row, place = cells // width, cells % width
    return {
        "pairs": keys,
        "documents": np.bincount(place, minlength=len(keys)),
        "held": np.bincount(row, minlength=n),
        "places": place,
        "times": linked,
    }


def _packed(numbers: np.ndarray) -> bytes:
    """Non-negative numbers as zstd over the planes of their bytes."""
    import zstandard

    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.compress(planes.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1).astype(np.int64)


NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
BLOCK_SCHEMA = (
    "block long, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>,"
    " groups_sha256 array<string>, pairs array<bigint>, documents array<bigint>, held binary, places binary, times binary"
)


def _block_row(batch: pa.RecordBatch, block: int, byte_path: str, piece_path: str) -> pa.RecordBatch:
    found = align_block(batch.column("text").to_pylist(), byte_path, piece_path)
    numbers = pa.list_(pa.int64())
    columns = {
        "block": pa.array([block], pa.int64()),
        "doc_ids": pa.array([batch.column("doc_id").cast(pa.int64()).to_pylist()], numbers),
        **{name: pa.array([found[name]], numbers) for name in NUMBERS},
        "groups_sha256": pa.array([found["groups_sha256"]], pa.list_(pa.string())),
        **{name: pa.array([found[name]], numbers) for name in ("pairs", "documents")},
        **{name: pa.array([_packed(found[name])], pa.binary()) for name in ("held", "places", "times")},
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks with the corpus-wide counts of their pairs -> rows of documents."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = {name: batch.column(name)[row] for name in batch.schema.names}
            held, places, times = (_unpacked(one[name].as_py()) for name in ("held", "places", "times"))
            counts, best = (one[name].values.to_numpy(zero_copy_only=False).astype(np.int64) for name in ("counts", "best"))
            owner = np.repeat(np.arange(len(held)), held)
            sums = {"n_best": np.zeros(len(held), np.int64), "count_sum": np.zeros(len(held), np.int64)}
            if len(places):
                np.add.at(sums["n_best"], owner, times * best[places])
                np.add.at(sums["count_sum"], owner, times * counts[places])
            columns = [one["doc_ids"].values, *(one[name].values for name in NUMBERS)]
            columns += [pa.array(sums[name]) for name in ("n_best", "count_sum")] + [one["groups_sha256"].values]
            names = ["doc_id", *NUMBERS, "n_best", "count_sum", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([c.cast(pa.int64()) if c.type != pa.string() else c for c in columns], names)


def encoded_blocks(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """One written row for each block of documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in slices(batches, limit=BLOCK_BYTES):
            yield _block_row(batch, number, byte_path, piece_path)
            number += 1

    return materialise(docs.select("doc_id", "text").mapInArrow(rows, BLOCK_SCHEMA), "token_blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair`` (A id above, B id below the 32nd bit), ``count`` of documents, ``best``: no pair of the A id has more."""
    listed = blocks.select(F.explode(F.arrays_zip("pairs", "documents")).alias("x")).select("x.pairs", "x.documents")
    sums = listed.groupBy(F.col("pairs").alias("pair")).agg(F.sum("documents").alias("count"))
    counts = materialise(sums.withColumn("a", F.shiftright("pair", 32)), "pair_counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    return counts.join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Per document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    blocks = encoded_blocks(docs, byte_path, piece_path)
    listed = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    known = listed.join(pair_counts(blocks), "pair").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("place", "count", F.col("best").cast("int").alias("best")))).alias("known")
    )
    empty = F.array().cast("array<bigint>")
    joined = blocks.drop("pairs", "documents").join(known, "block", "left").select(
        *(name for name in blocks.columns if name not in ("pairs", "documents")),
        F.coalesce(F.col("known.count"), empty).alias("counts"),
        F.coalesce(F.col("known.best").cast("array<bigint>"), empty).alias("best"),
    )
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return joined.mapInArrow(_added_up, schema)
