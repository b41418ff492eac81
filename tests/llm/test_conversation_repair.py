from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tidemark.llm import conversation_repair as C
from tidemark.llm.queries import QUERIES

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, block long, mark string, kind long"


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        kept = text.rstrip(BLANKS)
        out.append("b" if not kept else "d" if (role, text) in seen else "" if kept[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def plain(rows):
    """(role, text) in order -> counts, cost, audit and repaired rows, by keeping the best string for each prefix of rows."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def with_inserts(found):
        for _ in range(2):
            for state, (cost, audit, kept) in list(found.items()):
                for new in after[state].replace("s", ""):
                    offer = (cost + 2, audit + "I", (*kept, (names[new], "")))
                    found[new] = min(found.get(new, offer), offer)
        return found

    faults = faults_of(rows)
    found = {"": (0, "", ())}
    for (role, text), fault in zip(rows, faults):
        new: dict = {}
        for state, (cost, audit, kept) in with_inserts(found).items():
            offers = [(state, (cost + 3, audit + "D", kept))]
            if fault not in ("b", "d"):
                extra = fault == "t"
                if role[:1] in after[state] and role[:1]:
                    offers.append((role[:1], (cost + extra, audit + "K", (*kept, (role, text)))))
                offers += [(x, (cost + 2 + extra, audit + "R", (*kept, (names[x], text)))) for x in after[state] if x != "s"]
            for x, offer in offers:
                if x not in new or offer[:2] < new[x][:2]:
                    new[x] = offer
        found = new
    cost, audit, kept = min(v for x, v in with_inserts(found).items() if x in ("", "a"))
    initials = [role[:1] for role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:]))
    return faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, kept


def every_edit(rows):
    """The cheapest audit by trying every string of edits."""
    faults = faults_of(rows)
    best = None
    for edits in itertools.product("DKR", repeat=len(rows)):
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * n + e for n, e in zip(inserts, edits)) + "I" * inserts[-1]
            cost, roles, i, right = 0, [], 0, True
            for letter in audit:
                spoken = "u" if not roles or roles[-1] in "sa" else "a"
                if letter == "I":
                    cost += 2
                    roles.append(spoken)
                    continue
                role, fault, i = rows[i][0], faults[i], i + 1
                if letter == "D":
                    cost += 3
                    continue
                right = right and fault not in ("b", "d")
                cost += (fault == "t") + 2 * (letter == "R")
                roles.append((role[:1] or "?") if letter == "K" else spoken)
            if right and re.fullmatch("(s?(ua)+)?", "".join(roles)):
                best = min(best or (cost, audit), (cost, audit))
    return best


def searched(rows):
    codes = []
    for (role, _), fault in zip(rows, faults_of(rows)):
        codes.append({"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + {"": 0, "b": 4, "d": 4, "t": 8}[fault])
    return bytes(codes)


def some_rows(rng, n):
    texts = ["yes.", "no!", "cut off", " \t", "", "why?", "é.", "and"]
    return [(rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), rng.choice(texts) + rng.choice(["", " ", str(i) + "."])) for i in range(n)]


def test_plain_version_equals_all_edits():
    rng = random.Random(1)
    for _ in range(60):
        rows = some_rows(rng, rng.randint(0, 4))
        assert plain(rows)[4:6] == every_edit(rows)


@pytest.mark.parametrize("size", [1, 2, 3, 1000])
def test_blocks_compose_to_the_whole(size):
    rng = random.Random(size)
    for _ in range(200):
        rows = some_rows(rng, rng.randint(1, 14))
        codes = searched(rows)
        blocks = [C.block_ways(codes[i : i + size]) for i in range(0, len(codes), size)]
        cost, cells = C.choose([b[:2] for b in blocks])
        audit = "".join(b[2][cell] for b, cell in zip(blocks, cells)) + C.ENDING[cells[-1] % 4]
        assert (cost, audit) == plain(rows)[4:6]


def test_the_tree_holds_only_what_is_unresolved():
    search = C.Search(C.START)
    for i in range(20_000):
        search.step(1 + i % 2)
    assert search.peak < 40
    assert search.results()[C.START + 3][1] == "K" * 20_000


def test_ties_that_never_resolve_are_compared_whole():
    rows = [("tool", f"{i}.") for i in range(9)]
    ways = C.block_ways(searched(rows))
    cost, cells = C.choose([ways[:2]])
    assert (cost, ways[2][cells[0]] + C.ENDING[cells[0] % 4]) == plain(rows)[4:6]


def digest(kept):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()


def wanted_of(rows):
    """(conv_id, turn, role, text) -> the digest row of each conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, r or " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        *counts, audit, kept = plain([(r, x) for _, r, x in own])
        out[conv] = (gaps, *counts, audit, digest(kept))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "m", 2) for r in rows], SCHEMA).repartition(3)


@pytest.fixture
def rows():
    rng = random.Random(9)
    out = [(i % 23, i // 23, role, text) for i, (role, text) in enumerate(some_rows(rng, 200))]
    out += [(None, 1, "user", "x."), (None, 2, "assistant", "y."), (5, None, "user", "z."), (5, None, None, None)]
    out += [(40, 9, "user", "same."), (40, 9, "user", "same."), (40, 3, "system", "s" * 100_000 + "."), (41, None, "a", ""), (42, 7, "", "q.")]
    return out + rng.choices(out, k=30) + [(1 << 60, 1, "user", "big."), ((1 << 60) + 1, 1, "user", "big")]


@pytest.mark.parametrize("block", [C.BLOCK_ROWS, 2])
def test_awkward_conversations(spark, rows, block, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_ROWS", block)
    repair = C.plan_repair(frame(spark, rows))
    found = {r[0]: tuple(r[1:]) for r in repair.digests().collect()}
    wanted = wanted_of(rows)
    assert found == wanted
    again: dict = {}
    for r in sorted(repair.repaired().collect(), key=lambda r: (str(r.conv_id), r.place)):
        again.setdefault(r.conv_id, []).append((r.role, r.text))
    assert {c: digest(k) for c, k in again.items()} == {c: w[-1] for c, w in wanted.items() if set(w[-2]) - {"D"}}


def test_conversations_without_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.plan_repair(none).digests().collect() == []
    assert C.plan_repair(none).repaired().collect() == []
    everyone = frame(spark, [(3, 1, "user", "x."), (None, 1, "user", "x.")])
    empty = hashlib.sha256().hexdigest()
    found = C.plan_repair(none, everyone).digests().collect()
    assert {tuple(r) for r in found} == {(c, 0, 0, 0, 0, 0, 0, "", empty) for c in (3, None)}


def test_query_equals_the_plain_version(spark, data_dir):
    source = spark.read.parquet(f"{data_dir}/conversations.parquet").collect()
    rows = []
    for r in source:
        fault = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", r.text)}.get(fault, r.text)
        rows += [(r.conv_id, r.turn, "user" if fault == 4 else r.role, text)] * {0: 0, 3: 2}.get(fault, 1)
    wanted = {r.conv_id: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for r in source} | wanted_of(rows)
    assert {r[0]: tuple(r[1:]) for r in QUERIES["op12_conversation_repair"](spark, data_dir).collect()} == wanted
