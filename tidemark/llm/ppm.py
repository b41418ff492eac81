"""Language-model scoring by prediction by partial matching over bytes.

A text is its words (A-Z in lower case), each ended by a space, and an end symbol. Counts of what
followed each context in the training texts form a byte-context trie. A byte of a word is coded in its
longest context, all that precedes it in the word (up to ``DEPTH`` bytes with the space before); if it
is new there, an escape leads to the last two bytes, the last byte, and none, where the symbols of the
longer context are excluded; below that all 257 symbols not yet excluded are equally likely. Escape
probabilities are estimated, not fixed: each training occurrence is taken out of its context in turn, and
contexts of like length, total and number of symbols share how often the occurrence was then new. The
score of a text is the log10 of its probability, the pretrained code length.

Since contexts end at the word, a word costs the same wherever it stands: the distinct words are
scored once, and documents add up the costs of their words. Words are counted over all training
texts; documents keep only numbers of words of their block of documents, so the text does not move.

The trie is never in one place and has no limit: the distinct words are cut into sorted ranges, and a
range holds every context that begins its words. The few contexts that reach over an end of a range
(prefixes of its first and last word) are summed across ranges first. Only the contexts of at most
two bytes, 257**3 entries whatever the input, and the escape estimates are sent to all tasks.

The unigram base gives each token (word or end) log10((c + 1) / (N + V + 1)).

Null and empty texts consist of the end token alone. A null id counts as empty text for the fold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ranges import shuffle_partitions
from tidemark.llm.textkit import LOWER, flat_text, ragged, runs, slices, span_hashes, word_spans
from tidemark.scratch import materialise

ORDER = 2  # of the contexts that every task knows
DEPTH = 24  # of the contexts from a word's beginning
SYMBOLS = 257
# estimates are shared by kind of context, bits of its total and number of its symbols, up to these
KINDS, BITS, DISTINCT = 9, 21, 13
END = "\n"  # no word holds it
FLUSH_BYTES = 24 << 20

ROWS = (
    "block string, code int, word string, trained long,"
    " doc_id long, held_out boolean, n_tokens long, codes binary, counts binary"
)


def _symbols(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every symbol of every word: word number, symbol, context of up to ORDER bytes, bytes of context.

    A word is read as space, its bytes, space; the end token as space, end.
    """
    ended = [w if w == END.encode() else w + b" " for w in words]
    sizes = np.array([len(w) for w in ended], np.int64)
    flat = np.frombuffer(b"".join(ended), np.uint8).astype(np.int64)
    word, inner = np.repeat(np.arange(len(words)), sizes), ragged(sizes)
    context = np.zeros(len(flat), np.int64)
    for back in range(ORDER, 0, -1):
        earlier = np.zeros(len(flat), np.int64)
        earlier[back:] = flat[:-back]
        earlier[inner == back - 1] = 32
        context = context << 8 | np.where(inner >= back - 1, earlier, 0)
    return word, flat, context, np.minimum(inner + 1, ORDER)


def _keys(order: int, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return np.int64(order) << 48 | (context & ((1 << 8 * order) - 1)) << 8 | symbol


def trie_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (context, symbol) for words with their training counts, summed for each batch."""
    for batch in batches:
        words = [w.encode() for w in batch.column("word").to_pylist()]
        if not words:
            continue
        word, symbol, context, depth = _symbols(words)
        count = batch.column("trained").to_numpy()[word]
        keys = np.concatenate([_keys(k, context[depth >= k], symbol[depth >= k]) for k in range(ORDER + 1)])
        counts = np.concatenate([count[depth >= k] for k in range(ORDER + 1)])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        at = runs(keys)[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(keys[at]), pa.array(np.add.reduceat(counts, at))], ["node", "n"])


def cell(kind: np.ndarray | int, total: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Number of the escape estimate for contexts of a kind (0..2: order, from 3: bytes since the word's beginning)."""
    bits = np.minimum(np.frexp(np.maximum(total, 0).astype(np.float64))[1], BITS - 1)
    return (kind * BITS + bits) * DISTINCT + np.minimum(distinct, DISTINCT - 1).astype(np.int64)


def prefix_kind(inner: np.ndarray) -> np.ndarray:
    return 3 + np.minimum(inner, KINDS - 4)


def left_out(kind: np.ndarray, total: np.ndarray, distinct: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Row 0: occurrences by cell when each is left out of its context in turn; row 1: those then new."""
    size = KINDS * BITS * DISTINCT
    new, old = cell(kind, total - 1, distinct - 1), cell(kind, total - 1, distinct)
    escaped = np.bincount(new, single, size)
    return np.stack([escaped + np.bincount(old, total - single, size), escaped])


def _grouped(context: np.ndarray, symbol: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (context, symbol) in order, the first value summed, the others taken from any row."""
    order = np.lexsort((symbol, context))
    context, symbol, values = context[order], symbol[order], [v[order] for v in values]
    if not len(order):
        return context, symbol, *values
    new = np.append(True, (context[1:] != context[:-1]) | (symbol[1:] != symbol[:-1]))
    at = np.flatnonzero(new)
    return context[at], symbol[at], np.add.reduceat(values[0], at), *[v[at] for v in values[1:]]


class Contexts:
    """Contexts with the counts of what followed them, from sorted distinct (context, symbol)."""

    def __init__(self, context: np.ndarray, symbol: np.ndarray, n: np.ndarray):
        self.symbol, self.n, at = symbol, n.astype(np.float64), runs(context)
        self.first, self.context = at[:-1], context[at[:-1]]
        self.owner = np.repeat(np.arange(len(self.context)), np.diff(at))
        self.total = np.bincount(self.owner, self.n, len(self.context))
        self.distinct = np.bincount(self.owner, minlength=len(self.context))
        self.single = np.bincount(self.owner, self.n == 1, len(self.context))
        self.entry = self.owner.astype(np.int64) * 256 + symbol

    def find(self, context: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of each context, -1 if it is new; whether the symbol is known there; its count."""
        if not len(self.context):
            return np.full(len(context), -1), np.zeros(len(context), bool), np.zeros(len(context))
        node = np.minimum(np.searchsorted(self.context, context), len(self.context) - 1)
        known = self.context[node] == context
        key = node * 256 + symbol
        spot = np.minimum(np.searchsorted(self.entry, key), len(self.entry) - 1)
        hit = known & (self.entry[spot] == key)
        return np.where(known, node, -1), hit, np.where(hit, self.n[spot], 0.0)

    def shadow(self, shorter: Contexts, context: np.ndarray) -> np.ndarray:
        """What the symbols of each context count for in a shorter one, given for each of the entries."""
        return np.bincount(self.owner, shorter.find(context, self.symbol)[2], len(self.context))


class Model:
    """The contexts of up to ``ORDER`` bytes and the escape estimates; bounded whatever the input."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        self.orders, self.shadows = [], []
        for k in range(ORDER + 1):
            own = keys >> 48 == k
            context = keys[own] >> 8 & ((np.int64(1) << 40) - 1)
            self.orders.append(Contexts(context, keys[own] & 255, counts[own]))
            last = (np.int64(1) << 8 * max(k - 1, 0)) - 1
            self.shadows.append(self.orders[k].shadow(self.orders[k - 1], context & last) if k else None)
        self.cells = sum(left_out(np.full(len(c.context), k), c.total, c.distinct, c.single) for k, c in enumerate(self.orders))

    def escape(self, kind: np.ndarray | int, total: np.ndarray, distinct: np.ndarray) -> np.ndarray:
        at = cell(kind, total, distinct)
        return (self.cells[1][at] + 0.5) / (self.cells[0][at] + 1.0)

    def step(self, cost, hidden, hidden_kinds, now, kind, contexts, context, symbol, shadow) -> np.ndarray:
        """Code positions ``now`` in their contexts of one length; which of them are done."""
        node, hit, count = contexts.find(context[now], symbol[now])
        met, at = now[node >= 0], node[node >= 0]
        hit, count = hit[node >= 0], count[node >= 0]
        left, kinds = contexts.total[at] - hidden[met], contexts.distinct[at] - hidden_kinds[met]
        escape = self.escape(kind[node >= 0] if isinstance(kind, np.ndarray) else kind, left, kinds)
        with np.errstate(divide="ignore", invalid="ignore"):
            spent = np.where(hit, np.log10(count / left * (1 - escape)), np.log10(escape))
        cost[met] += np.where(kinds > 0, spent, 0.0)
        hidden[met], hidden_kinds[met] = shadow[at] if shadow is not None else 0.0, contexts.distinct[at]
        return met[hit]

    def code(self, words: list[bytes], prefixes: Contexts, shadow: np.ndarray) -> np.ndarray:
        """log10 probability of each word with what ends it; ``shadow`` as of the next shorter contexts."""
        word, symbol, context, _ = _symbols(words)
        inner, prefix = _prefixes(words)
        cost, hidden, hidden_kinds = (np.zeros(len(symbol)) for _ in range(3))
        open_ = np.ones(len(symbol), bool)
        now = np.flatnonzero(inner < DEPTH)
        open_[self.step(cost, hidden, hidden_kinds, now, prefix_kind(inner[now]), prefixes, prefix, symbol, shadow)] = False
        for k in range(ORDER, -1, -1):
            now = np.flatnonzero(open_ & ((inner >= k) | (inner >= DEPTH)))
            own = context & ((np.int64(1) << 8 * k) - 1)
            open_[self.step(cost, hidden, hidden_kinds, now, k, self.orders[k], own, symbol, self.shadows[k])] = False
        cost[open_] -= np.log10(np.maximum(SYMBOLS - hidden_kinds[open_], 1.0))
        return np.bincount(word, cost, minlength=len(words))


def _prefixes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every symbol of every word: the bytes before it in the word, as their number and as a hash."""
    ended = [w if w == END.encode() else w + b" " for w in words]
    sizes = np.array([len(w) for w in ended], np.int64)
    flat, inner = np.frombuffer(b"".join(ended), np.uint8), ragged(sizes)
    ends = np.arange(len(flat))
    return inner, span_hashes(flat, ends - inner, ends).view(np.int64)


def _trained(frame: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """(prefix, symbol), its count, bytes of the prefix, and its last bytes, for all training words of a range."""
    words = [w.encode() for w in frame["word"]]
    word, symbol, context, _ = _symbols(words)
    inner, prefix = _prefixes(words)
    count = frame["trained"].to_numpy(np.int64)[word]
    own = (inner < DEPTH) & (count > 0)
    last = np.minimum(inner, ORDER) << 48 | context  # how many bytes the next shorter context has, and the bytes
    return _grouped(prefix[own], symbol[own], count[own], inner[own], last[own])


PARTS = "part int, prefix long, symbol int, n long, inner int, last long, cell int, seen long, escaped long"


def range_parts(frame: pd.DataFrame) -> pd.DataFrame:
    """Of a range of words: the counts of contexts that may reach over its ends, and what the others say about escapes."""
    prefix, symbol, n, inner, last = _trained(frame)
    ends = [w.encode() for w in (frame["word"].min(), frame["word"].max())]
    outer = np.isin(prefix, np.unique(_prefixes(ends)[1]))
    whole = Contexts(prefix[~outer], symbol[~outer], n[~outer])
    seen, escaped = left_out(prefix_kind(inner[~outer][whole.first]), whole.total, whole.distinct, whole.single)
    at = np.flatnonzero(seen)
    part = int(frame["part"].iloc[0])
    names = [field.split()[0] for field in PARTS.split(", ")]
    a = pd.DataFrame(dict(part=part, prefix=prefix[outer], symbol=symbol[outer], n=n[outer], inner=inner[outer], last=last[outer]))
    b = pd.DataFrame(dict(part=part, cell=at, seen=seen[at], escaped=escaped[at]))
    return pd.concat([a.astype("Int64"), b.astype("Int64")]).reindex(columns=names)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: their distinct words with training counts, and each document as word numbers."""
    from pyspark import TaskContext

    names = [field.split()[0] for field in ROWS.split(", ")]
    types = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()]
    task, number = TaskContext.get().partitionId(), 0
    docs: list[tuple] = []  # (ids, held out, tokens, document, hash, count)
    words: list[tuple[np.ndarray, list[bytes]]] = []
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        hashes, at = np.unique(np.concatenate([w[0] for w in words]), return_index=True)
        spelled = [x for w in words for x in w[1]]
        spelled = [spelled[i].decode("utf-8", "replace") for i in at.tolist()] + [END]
        trained = np.zeros(len(spelled), np.int64)
        block, out = f"{task}-{number}", []
        for ids, apart, tokens, doc, h, count in docs:
            code = np.searchsorted(hashes, h).astype(np.int32)
            learn = ~apart[doc]
            np.add.at(trained, code[learn], count[learn])
            trained[-1] += int((~apart).sum())
            at = np.searchsorted(doc, np.arange(len(apart) + 1))
            for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                out.append((ids[i], bool(apart[i]), int(tokens[i]), code[a:b].tobytes(), count[a:b].astype(np.int32).tobytes()))
        n, empty = len(spelled), len(out)
        columns = [[block] * n, range(n), spelled, trained.tolist(), *[[None] * n] * 5]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
        columns = [[block] * empty, *[[None] * empty] * 3, *zip(*out)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in slices(batches):
        flat, offsets = flat_text(batch.column("text"))
        flat = LOWER[flat]
        starts, ends, doc = word_spans(flat, offsets)
        h = span_hashes(flat, starts, ends)
        order = np.lexsort((h, doc))
        sd, sh = doc[order], h[order]
        new = np.append(True, (sd[1:] != sd[:-1]) | (sh[1:] != sh[:-1])) if len(sd) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(sd)))
        tokens = np.bincount(doc, minlength=batch.num_rows) + 1
        apart = np.array(batch.column("held_out").to_pylist(), bool)
        docs.append((batch.column("doc_id").to_pylist(), apart, tokens, sd[begin], sh[begin], count))
        kinds, first = np.unique(h, return_index=True)
        data = flat.tobytes()
        words.append((kinds, [data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]))
        held += len(flat)
        if held >= FLUSH_BYTES:
            yield from flush()
            docs.clear()
            words.clear()
            held, number = 0, number + 1
    if docs:
        yield from flush()


def word_costs(vocabulary: DataFrame) -> DataFrame:
    """``cost`` of each distinct word, under the counts of all."""
    spark = vocabulary.sparkSession
    ranges = vocabulary.repartitionByRange(shuffle_partitions(spark), "word")
    ordered = materialise(ranges.withColumn("part", F.spark_partition_id()), "lm-ranges")
    short = vocabulary.filter("trained > 0").mapInArrow(trie_counts, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    entries = short.toArrow()  # at most 257**3
    model = Model(entries.column("node").to_numpy(), entries.column("n").to_numpy())

    parts = materialise(ordered.groupBy("part").applyInPandas(range_parts, PARTS), "lm-parts")
    outer = parts.filter("cell IS NULL")
    sums = outer.groupBy("prefix", "symbol", "inner", "last").agg(F.sum("n").alias("n"))
    sums = materialise(sums, "lm-outer")
    stats = sums.groupBy("prefix", "inner").agg(F.sum("n").alias("total"), F.count("n").alias("distinct"), F.count_if(F.col("n") == 1).alias("single"))
    kind = F.lit(3) + F.least("inner", F.lit(KINDS - 4))
    bits = F.when(F.col("total") > 1, F.least(F.length(F.bin(F.col("total") - 1)), F.lit(BITS - 1))).otherwise(0)
    at = lambda distinct: (kind * BITS + bits) * DISTINCT + F.least(distinct, F.lit(DISTINCT - 1))
    both = F.array(
        F.struct(at(F.col("distinct") - 1).cast("int").alias("cell"), F.col("single").alias("seen"), F.col("single").alias("escaped")),
        F.struct(at(F.col("distinct")).cast("int").alias("cell"), (F.col("total") - F.col("single")).alias("seen"), F.lit(0).cast("long").alias("escaped")),
    )
    cells = stats.select(F.inline(both)).unionByName(parts.filter("cell IS NOT NULL").select("cell", "seen", "escaped"))
    for row in cells.groupBy("cell").agg(F.sum("seen").alias("seen"), F.sum("escaped").alias("escaped")).collect():
        model.cells[:, row["cell"]] += (row["seen"], row["escaped"])
    shared = spark.sparkContext.broadcast(model)

    def coded(own: pd.DataFrame, over: pd.DataFrame) -> pd.DataFrame:
        prefix, symbol, n, _, last = _trained(own)
        inside = ~np.isin(prefix, over["prefix"].to_numpy(np.int64))
        columns = zip((prefix, symbol, n, last), ("prefix", "symbol", "n", "last"))
        prefix, symbol, n, last = _grouped(*[np.append(x[inside], over[name].to_numpy(np.int64)) for x, name in columns])
        prefixes, model = Contexts(prefix, symbol, n), shared.value
        # the next shorter context has two bytes, or one or none near the word's beginning
        shadow = np.zeros(len(prefixes.context))
        length = np.minimum(last >> 48, ORDER)
        for k in range(ORDER + 1):
            mine = np.where(length == k, last & ((np.int64(1) << 8 * k) - 1), -1)
            shadow += prefixes.shadow(model.orders[k], mine)
        words = own["word"].tolist()
        cost = model.code([w.encode() for w in words], prefixes, shadow)
        return pd.DataFrame({"word": words, "trained": own["trained"].to_numpy(), "cost": cost})

    needed = outer.select("part", "prefix").distinct().join(sums, "prefix").select("part", "prefix", "symbol", "n", "last")
    both = ordered.groupBy("part").cogroup(needed.groupBy("part"))
    return both.applyInPandas(coded, "word string, trained long, cost double")


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Code length of every text under the model of the rows that ``held_out`` leaves in."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held_out.alias("held_out"))
    table = materialise(rows.mapInArrow(_blocks, ROWS), "lm-blocks")
    words = table.filter("word IS NOT NULL").select("block", "code", "word", "trained")
    vocabulary = materialise(words.groupBy("word").agg(F.sum("trained").alias("trained")), "lm-words")
    sums = vocabulary.agg(F.coalesce(F.sum("trained"), F.lit(0)).alias("n"), F.count_if(F.col("trained") > 0).alias("v")).first()
    everything, kinds = sums["n"], sums["v"]
    costs = word_costs(vocabulary)
    valued = words.select("block", "code", "word").join(costs, "word").select("block", "code", "trained", "cost")

    def add_up(own: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        trained, cost = np.zeros(len(values)), np.zeros(len(values))
        at = values["code"].to_numpy(np.int64)
        trained[at], cost[at] = values["trained"].to_numpy(np.float64), values["cost"].to_numpy(np.float64)
        base = np.log10((trained + 1) / (everything + kinds + 1))
        out = []
        for doc_id, apart, tokens, codes, counts in zip(own["doc_id"], own["held_out"], own["n_tokens"], own["codes"], own["counts"]):
            code = np.append(np.frombuffer(codes, np.int32), len(values) - 1)  # and the end token
            count = np.append(np.frombuffer(counts, np.int32), 1)
            known = int(count[trained[code] > 0].sum())
            out.append((doc_id, bool(apart), int(tokens), known, everything, float(base[code] @ count), float(cost[code] @ count)))
        frame = pd.DataFrame(out, columns=NAMES)
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame

    own = table.filter("word IS NULL").select(F.col("block").alias("part"), "doc_id", "held_out", "n_tokens", "codes", "counts")
    return own.groupBy("part").cogroup(valued.groupBy("block")).applyInPandas(add_up, SCORED)


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)
NAMES = [field.split()[0] for field in SCORED.split(", ")]
