from __future__ import annotations

import collections
import hashlib
import random
import re

import pytest

from tidemark.llm import token_alignment as T
from tidemark.llm.queries import QUERIES, vocabulary

BYTE, PIECE = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    plain = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or 174 <= x]
    byte_of = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
    bytes_a = {i: bytes(byte_of[c] for c in t) for t, i in a.get_vocab().items() if all(c in byte_of for c in t)}

    def piece(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", name) else name.replace("▁", " ").encode()

    return a, b, bytes_a, [piece(i) for i in range(b.get_piece_size())]


def plain(texts, libraries):
    """One row for each text, groups found by a walk over both streams."""
    a, b, bytes_a, bytes_b = libraries
    found, counts = [], collections.Counter()
    for text in texts:
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        wanted = (" " + (text or "")).encode()
        if not text or b"".join(map(bytes_a.get, ids_a)) != wanted or b"".join(bytes_b[i] for i in ids_b) != wanted:
            found.append(None)
            continue
        ends_a, ends_b, groups = set(), set(), []
        for ids, table, ends in ((ids_a, bytes_a, ends_a), (ids_b, bytes_b, ends_b)):
            at = 0
            for i in ids:
                at += len(table[i])
                ends.add(at)
        cuts, spots = sorted(ends_a & ends_b), [0, 0]
        for cut in cuts:
            group = []
            for side, (ids, table) in enumerate(((ids_a, bytes_a), (ids_b, bytes_b))):
                start = spots[side]
                size = cut - (groups[-1][2] if groups else 0)
                while size:
                    size -= len(table[ids[spots[side]]])
                    spots[side] += 1
                group.append(ids[start : spots[side]])
            groups.append((*group, cut))
        links = [(x, y) for ga, gb, _ in groups for x in ga for y in gb]
        counts.update(set(links))
        shown = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb, _ in groups)
        found.append((len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(shown.encode()).hexdigest()))
    highest: dict = {}
    for (x, _), n in counts.items():
        highest[x] = max(highest.get(x, 0), n)
    out = []
    for row in found:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, shown = row
        best = sum(counts[p] == highest[p[0]] for p in links)
        out.append((n_a, n_b, n_groups, len(links), best, sum(counts[p] for p in links), shown))
    return out


def texts():
    rng = random.Random(2)
    words = ["the", "The", "ration", "über", "naïve", "x", "12", "3.14", "日本語", "👩‍👩‍👧", "don't", "<s>", "<|endoftext|>", "<0x41>", "ﬁ", "é", "the\n", "a\tb", "  two", "\r\n"]
    out = [None, "", " ", "\n", "a", "▁", "x▁y", "x\x00y", "aaaa" * 300, " " * 50, "日本語テキスト" * 30, "the the the", "ab" * 600]
    out += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 80))) for _ in range(60)]
    out += [chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0x10000, 0x1FFFF)])) * rng.randint(1, 3) for _ in range(60)]
    return out + out[13:20]


def rows_of(found):
    return sorted(((r.doc_id, *(r[n] for n in NUMBERS), r.groups_sha256) for r in found.collect()), key=str)


def test_awkward_texts(spark, libraries):
    data = texts()
    ids = [None, None, 7, 7, *((1 << 60) + i for i in range(len(data) - 4))]
    docs = spark.createDataFrame([(i, t, 1, "p", 2) for i, t in zip(ids, data)], "doc_id long, text string, block long, pairs string, place long")
    wanted = sorted(((i, *row) for i, row in zip(ids, plain(data, libraries))), key=str)
    assert rows_of(T.align(docs.repartition(3), BYTE, PIECE)) == wanted
    assert rows_of(T.align(docs.limit(0), BYTE, PIECE)) == []


def test_small_blocks_and_a_forgetful_memory_change_nothing(spark, libraries, monkeypatch):
    data = texts()
    monkeypatch.setattr(T, "REMEMBERED", 5)
    wide, T.WIDE_GROUP = T.WIDE_GROUP, 2
    try:
        found = [T.align_block(data[i : i + 9], BYTE, PIECE) for i in range(0, len(data), 9)]
    finally:
        T.WIDE_GROUP = wide
    wanted = plain(data, libraries)
    for name, at in (("n_a", 0), ("n_b", 1), ("n_groups", 2), ("n_links", 3), ("groups_sha256", 6)):
        assert [x for f in found for x in list(f[name])] == [w[at] for w in wanted]
    assert sum(int(f["times"].sum()) for f in found) == sum(w[3] for w in wanted)


def test_equal_hashes_of_different_windows_do_not_mix(libraries, monkeypatch):
    monkeypatch.setattr(T, "mix", lambda h: h & T.U64(7))
    T._memory(BYTE, PIECE).clear()
    data = [t for t in texts() if t]
    found = T.align_block(data, BYTE, PIECE)
    assert found["groups_sha256"] == [w[-1] for w in plain(data, libraries)]


def test_a_long_text_without_spaces(libraries):
    found = T.align_block(["a" * 400_000, "日本" * 100_000], BYTE, PIECE)
    assert found["n_groups"].min() > 10_000


def test_query_equals_the_plain_version(spark, data_dir, libraries):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").collect()
    wanted = sorted(((d.doc_id, *row) for d, row in zip(docs, plain([d.text for d in docs], libraries))), key=str)
    assert rows_of(QUERIES["op13_token_alignment"](spark, data_dir)) == wanted
