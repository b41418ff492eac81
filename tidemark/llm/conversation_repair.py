"""Least-cost repair of conversations by a Viterbi search whose survivors coalesce.

The rows of a conversation, by turn (nulls first; rows of one turn by role, then by the SHA-256 of the
text), are kept, given another role, deleted, or preceded by an inserted empty turn, until the roles read
system?, (user, assistant)+ or nothing is left. Costs: keep 0, another role 2, delete 3, insert 2, and 1 for a row that
stays although its text breaks off. Blank rows and repetitions (role and text seen earlier in the conversation) must be
deleted. Of repairs of equal cost the one with the least string of initials (D, I, K, R) is taken.

Rows are sorted by ranges over the cluster and cut into blocks of at most BLOCK_ROWS rows of one
conversation, so a conversation with a third of all rows is many blocks. For each state before a block
the search keeps one survivor per state after it. Survivors hang in a tree of backpointers with
reference counts; survivors that another one beats whatever follows are dropped, branches without
survivors are freed, and letters are emitted as soon as all survivors descend from one node, so memory
follows the unresolved part only. Ties compare the complete
unresolved strings. Inserts belong to the row after them, so no string of a block begins another one's:
a comparison never needs the next block. Per conversation one task then folds the blocks' costs and
orders (one short record for 4,096 rows) and chooses each block's way. Last, plan and texts meet in one
shuffle by conversation and are read as a stream, a row at a time.

A null role or text is one space; a null conversation id is a conversation of its own; null turns come
first; repeated rows are repetitions; columns other than ``conv_id, turn, role, text`` are ignored; an
empty table gives empty tables. Roles count by their first letter: s, u, a, any other fits nowhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import materialise

BLOCK_ROWS = 4096
BLANKS = " \t\n\x0b\x0c\r"  # fixed value: the white space of the contract

# Costs of the edits, states (nothing yet, after system, user, assistant) and their grammar.
RENAME, DELETE, INSERT, BROKEN = 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
SPOKEN_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ENDING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
LEGAL_PAIRS = ("su", "ua", "au")
# What it costs at most to do from the first state what can be done from the second: a system row deleted
# instead of kept, turns inserted.
IMITATION = (
    (0, 0, INSERT, 0),
    (2 * INSERT, 0, INSERT, 2 * INSERT),
    (INSERT + DELETE, INSERT, 0, INSERT),
    (DELETE, 0, INSERT, 0),
)

OTHER_ROLE = 3  # initials as numbers: 0 system, 1 user, 2 assistant
SOUND, DOOMED, CUT = 0, 4, 8  # added to the initial: what is wrong with the row
FAR = 1 << 60


def _row_steps(code: int) -> list[list[tuple[str, int, int]]]:
    """For each state before a row: (letters, state after it, cost) of all its edits."""
    initial, fault = code % 4, code - code % 4
    steps = []
    for state in range(4):
        ways = [("D", state, DELETE)]
        if fault != DOOMED:
            extra = BROKEN if fault == CUT else 0
            before = state
            for inserts in range(3):
                paid = inserts * INSERT + extra
                fits = initial == 0 and before == START or initial in (1, 2) and SPOKEN_NEXT[before] == initial + 1
                if fits:
                    ways.append(("I" * inserts + "K", initial + 1, paid))
                ways.append(("I" * inserts + "R", SPOKEN_NEXT[before], paid + RENAME))
                before = SPOKEN_NEXT[before]
        steps.append(ways)
    return steps


STEPS = [_row_steps(code) for code in range(12)]


class _Node:
    """One edit of the tree: the letters that led here, and how many nodes still point to it."""

    __slots__ = ("parent", "letters", "pointers", "heir")

    def __init__(self, parent: _Node | None, letters: str):
        self.parent, self.letters, self.pointers, self.heir = parent, letters, 0, None
        if parent is not None:
            parent.pointers += 1
            parent.heir = self


def _unresolved(node: _Node) -> str:
    parts = []
    while node is not None:
        parts.append(node.letters)
        node = node.parent
    return "".join(reversed(parts))


class Search:
    """Survivors of one search; ``peak`` is the most nodes the tree held."""

    def __init__(self, entry: int):
        self.root = _Node(None, "")
        self.live = {entry: (0, self.root)}
        self.emitted: list[str] = []
        self.nodes = self.peak = 1

    def step(self, code: int) -> None:
        offers: dict[int, list[tuple[int, _Node, str]]] = {}
        for state, (cost, node) in self.live.items():
            for letters, after, more in STEPS[code][state]:
                offers.setdefault(after, []).append((cost + more, node, letters))
        before = [node for _, node in self.live.values()]
        lowest_of = {state: min(way[0] for way in ways) for state, ways in offers.items()}
        live = {}
        for state, lowest in lowest_of.items():
            if any(lowest > cost + IMITATION[other][state] for other, cost in lowest_of.items()):
                continue  # whatever follows, the other state's survivor ends cheaper
            tied = [way for way in offers[state] if way[0] == lowest]
            if len(tied) > 1:
                tied.sort(key=lambda way: _unresolved(way[1]) + way[2])
            live[state] = (lowest, _Node(tied[0][1], tied[0][2]))
        self.live = live
        self.nodes += len(live)
        self.peak = max(self.peak, self.nodes)
        for node in before:  # branches that no survivor descends from
            while node is not self.root and not node.pointers:
                above, node.parent = node.parent, None
                above.pointers -= 1
                self.nodes -= 1
                node = above
        self._emit()

    def _emit(self) -> None:
        """Move the root down while all survivors descend from one child."""
        while self.root.pointers == 1 and all(node is not self.root for _, node in self.live.values()):
            child = self._only_child()
            self.emitted.append(child.letters)
            child.parent, child.letters = None, ""
            self.root = child
            self.nodes -= 1

    def _only_child(self) -> _Node:
        """The child made last, if it still hangs there; else found from a survivor."""
        if self.root.heir.parent is self.root:
            return self.root.heir
        node = next(iter(self.live.values()))[1]
        while node.parent is not self.root:
            node = node.parent
        return node

    def results(self) -> dict[int, tuple[int, str]]:
        """(cost, string) for each state after the rows."""
        done = "".join(self.emitted)
        return {state: (cost, done + _unresolved(node)) for state, (cost, node) in self.live.items()}


@lru_cache(maxsize=1 << 14)
def short_block_ways(codes: bytes) -> tuple[list[int], list[int], list[str]]:
    return block_ways(codes)


def block_ways(codes: bytes) -> tuple[list[int], list[int], list[str]]:
    """Cost, place among the strings of the same entry, and string, for 4 states before and 4 after the rows."""
    costs, places, strings = [FAR] * 16, [0] * 16, [""] * 16
    for entry in range(4):
        search = Search(entry)
        for code in codes:
            search.step(code)
        found = sorted((string, state, cost) for state, (cost, string) in search.results().items())
        for place, (string, state, cost) in enumerate(found):
            costs[entry * 4 + state], places[entry * 4 + state], strings[entry * 4 + state] = cost, place, string
    return costs, places, strings


def choose(blocks: list[tuple[list[int], list[int]]]) -> tuple[int, list[int]]:
    """The cheapest way through a conversation's blocks, of equal ones the least: its cost, and a cell of each block."""
    ahead = [len(ENDING[state]) * INSERT for state in range(4)]
    rest = [ahead]
    for costs, _ in reversed(blocks):
        ahead = [min(costs[e * 4 + x] + ahead[x] for x in range(4)) for e in range(4)]
        rest.append(ahead)
    state, cells = START, []
    for (costs, places), after in zip(blocks, reversed(rest[:-1])):
        cell = min(range(state * 4, state * 4 + 4), key=lambda c: (costs[c] + after[c % 4], places[c]))
        cells.append(cell)
        state = cell % 4
    return rest[-1][START], cells


def illegal_pairs(initials: list[int]) -> int:
    names = "sua?"
    return sum(names[a] + names[b] not in LEGAL_PAIRS for a, b in zip(initials[:-1], initials[1:]))


def _key(column: str = "conv_id") -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


@dataclass(frozen=True)
class Repair:
    """A repair that is planned: counts per conversation, and the rows or digests of the result on demand."""

    keys: DataFrame  # conv, conv_id
    rows: DataFrame  # conv, turn, role, text, mark
    plan: DataFrame  # conv, turn, role, mark (of a block's first row), block, edits
    counts: DataFrame  # conv, blank, duplicate, truncated, illegal, cost, gaps

    def _stream(self, consume, schema: str) -> DataFrame:
        order = ["conv", F.col("turn").asc_nulls_first(), "role", "mark", "kind", "block"]
        plans = self.plan.select("conv", "turn", "role", "mark", F.lit(0).alias("kind"), "block", F.col("edits").alias("text"))
        texts = self.rows.select("conv", "turn", "role", "mark", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("block"), "text")
        both = plans.unionByName(texts).repartition("conv").sortWithinPartitions(*order)

        def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return consume(_replayed(batches))

        return both.select("conv", "role", "kind", "text").mapInArrow(replay, schema)

    def repaired(self) -> DataFrame:
        """The rows of the repaired conversations: ``conv_id``, ``place`` (from 0), ``role``, ``text``, ``edit`` (I, K or R)."""
        found = self._stream(_rows, "conv string, place long, role string, text string, edit string")
        return found.join(self.keys, "conv").select("conv_id", "place", "role", "text", "edit")

    def digests(self) -> DataFrame:
        """One row per conversation: the counts, ``audit`` (initials of the edits) and ``repaired_sha256``."""
        found = self._stream(_digests, "conv string, audit string, repaired_sha256 string")
        nothing = hashlib.sha256().hexdigest()
        numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
        return (
            self.keys.join(self.counts, "conv", "left")
            .join(found, "conv", "left")
            .select(
                "conv_id",
                *(F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in numbers),
                F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
            )
        )


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, str, str]]:
    """(conversation, edit, role after it, text) of each letter; a conversation's edits precede its rows."""
    conv, pending, state = None, [], START

    def written() -> Iterator[tuple[str, str, str, str]]:
        nonlocal state
        while pending and pending[-1] == "I":
            pending.pop()
            state = SPOKEN_NEXT[state]
            yield conv, "I", "user" if state == USER else "assistant", ""

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("conv", "role", "kind", "text")]
        for key, role, kind, text in zip(*columns):
            if key != conv:
                conv, pending, state = key, [], START
            if kind == 0:
                pending = list(reversed(text)) + pending
                continue
            yield from written()
            edit = pending.pop()
            if edit == "D":
                yield conv, "D", role, text
            else:
                if edit == "R":
                    state = SPOKEN_NEXT[state]
                    role = "user" if state == USER else "assistant"
                else:
                    state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
                yield conv, edit, role, text
            if pending and len(pending) <= 2 and pending[0] == "I":  # only inserts behind the last row end a plan
                yield from written()


def _rows(edits: Iterator[tuple[str, str, str, str]], size: int = 1024) -> Iterator[pa.RecordBatch]:
    names = ["conv", "place", "role", "text", "edit"]
    conv, place, out = None, 0, []
    for key, edit, role, text in edits:
        if key != conv:
            conv, place = key, 0
        if edit != "D":
            out.append((key, place, role, text, edit))
            place += 1
        if len(out) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names)


def _digests(edits: Iterator[tuple[str, str, str, str]], size: int = 4096) -> Iterator[pa.RecordBatch]:
    names = ["conv", "audit", "repaired_sha256"]
    conv, audit, digest, first, out = None, [], None, True, []
    for key, edit, role, text in edits:
        if key != conv:
            if conv is not None:
                out.append((conv, "".join(audit), digest.hexdigest()))
            conv, audit, digest, first = key, [], hashlib.sha256(), True
        audit.append(edit)
        if edit != "D":
            digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False
        if len(out) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*out)], names)
            out = []
    if conv is not None:
        out.append((conv, "".join(audit), digest.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*out)], names)


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their ways; ``initials`` are the first and last of the rows."""
    for batch in batches:
        costs, places, strings, illegal, first, last = [], [], [], [], [], []
        for codes in batch.column("codes").to_pylist():
            data = bytes(codes)
            ways = short_block_ways(data) if len(data) <= 16 else block_ways(data)
            costs.append(ways[0]), places.append(ways[1]), strings.append(ways[2])
            initials = [c % 4 for c in codes]
            illegal.append(illegal_pairs(initials)), first.append(initials[0]), last.append(initials[-1])
        kinds = {"costs": (costs, pa.list_(pa.int64())), "places": (places, pa.list_(pa.int64())), "strings": (strings, pa.list_(pa.string()))}
        added = {name: pa.array(values, kind) for name, (values, kind) in kinds.items()}
        added |= {name: pa.array(v, pa.int64()) for name, v in (("illegal", illegal), ("first", first), ("last", last))}
        kept = [name for name in batch.schema.names if name != "codes"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *added.values()], [*kept, *added])


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by conversation -> the cell of each; the last one carries cost and illegal pairs of the whole."""
    names = ["conv", "block", "cell", "closing", "cost", "illegal"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
    held: list[tuple] = []
    out: list[tuple] = []

    def resolve() -> None:
        cost, cells = choose([(row[2], row[3]) for row in held])
        illegal = sum(row[4] for row in held) + sum(illegal_pairs([a[6], b[5]]) for a, b in zip(held[:-1], held[1:]))
        for i, (row, cell) in enumerate(zip(held, cells)):
            closing = i == len(held) - 1
            out.append((row[0], row[1], cell, closing, cost if closing else 0, illegal if closing else 0))
        held.clear()

    def flushed() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names)
        out.clear()
        return batch

    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in ("conv", "block", "costs", "places", "illegal", "first", "last"))):
            if held and held[0][0] != row[0]:
                resolve()
            held.append(row)
        if len(out) >= 4096:
            yield flushed()
    if held:
        resolve()
    if out:
        yield flushed()


def plan_repair(conversations: DataFrame, everyone: DataFrame | None = None) -> Repair:
    """Plan the repair of ``conv_id, turn, role, text``; ``everyone`` (``conv_id``) names conversations without rows."""
    rows = conversations.select(
        _key().alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("mark", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    first = F.left("role", F.lit(1))
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(OTHER_ROLE)
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "mark"]
    sorted_rows = (  # equal rows may fill many ranges, so the row's number goes into the range
        rows.select("conv", "turn", "role", "mark", initial.alias("initial"), last.alias("last"))
        .withColumn("number", F.monotonically_increasing_id())
        .repartitionByRange(*order, "number")
        .sortWithinPartitions(*order, "number")
        .drop("number")
        .withColumn("at", F.monotonically_increasing_id())
    )
    lines = materialise(sorted_rows, "sorted_turns")

    seen = lines.groupBy("conv", "role", "mark").agg(F.min("at").alias("earliest"), F.count(F.lit(1)).alias("n"))
    again = lines.join(seen.filter("n > 1").drop("n"), ["conv", "role", "mark"]).filter("at > earliest").select("at", F.lit(True).alias("again"))
    blank, cut = F.col("last") == "", ~F.col("last").isin(".", "!", "?")
    repeated = F.coalesce("again", F.lit(False))
    fault = F.when(blank | repeated, DOOMED).when(cut, CUT).otherwise(SOUND)
    marked = lines.join(again, "at", "left").select(
        "conv",
        F.floor(F.col("at") / BLOCK_ROWS).alias("block"),
        "at",
        F.struct("at", "turn", "role", "mark").alias("head"),
        (F.col("initial") + fault).cast("int").alias("code"),
        blank.cast("long").alias("blank"),
        (repeated & ~blank).cast("long").alias("duplicate"),
        (cut & ~blank & ~repeated).cast("long").alias("truncated"),
    )
    faults = ["blank", "duplicate", "truncated"]
    blocks = (
        marked.groupBy("conv", "block")
        .agg(F.sort_array(F.collect_list(F.struct("at", "code"))).alias("codes"), F.min("head").alias("head"), *(F.sum(f).alias(f) for f in faults))
        .select("conv", "block", "head.turn", "head.role", "head.mark", *faults, F.col("codes.code").alias("codes"))
    )
    schema = (
        "conv string, block long, turn long, role string, mark binary, blank long, duplicate long, truncated long,"
        " costs array<bigint>, places array<bigint>, strings array<string>, illegal long, first long, last long"
    )
    ways = materialise(blocks.mapInArrow(_ways, schema), "block_ways")
    folded = ways.select("conv", "block", "costs", "places", "illegal", "first", "last").repartition("conv").sortWithinPartitions("conv", "block")
    cells = materialise(folded.mapInArrow(_chosen, "conv string, block long, cell long, closing boolean, cost long, illegal long"), "cells")
    state = F.col("cell") % 4
    ending = F.when(~F.col("closing"), "").when(state == SYSTEM, ENDING[SYSTEM]).when(state == USER, ENDING[USER]).otherwise("")
    plan = ways.drop("illegal").join(cells, ["conv", "block"]).select(
        "conv", "turn", "role", "mark", "block", F.concat(F.get("strings", F.col("cell").cast("int")), ending).alias("edits")
    )
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = (
        ways.groupBy("conv").agg(*(F.sum(f).alias(f) for f in faults))
        .join(cells.filter("closing").select("conv", "cost", "illegal"), "conv")
        .join(lines.groupBy("conv").agg(F.coalesce(span, F.lit(0)).alias("gaps")), "conv")
    )
    named = conversations if everyone is None else everyone
    keys = named.select("conv_id").distinct().select(_key().alias("conv"), "conv_id")
    return Repair(keys, rows, plan, counts)
