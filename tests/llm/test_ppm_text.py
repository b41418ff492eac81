"""The language model over running text against a plain version, and what its contexts must tell apart."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import ppm_text, queries

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
K = ppm_text.ORDER


def running(text: str | None) -> bytes:
    return b"\n" * K + "".join(w + " " for w in WORD.findall((text or "").translate(LOWER))).encode() + b"\n"


def plain_model(training: list[bytes]):
    contexts: dict[bytes, collections.Counter] = {}
    for s in training:
        for p in range(K, len(s)):
            for k in range(K + 1):
                contexts.setdefault(s[p - k : p], collections.Counter())[s[p]] += 1
    cell = lambda k, n, d: (k, min(n.bit_length(), 20), min(d, 12))
    seen, escaped = collections.Counter(), collections.Counter()
    for context, known in contexts.items():
        k, n, d, once = len(context), sum(known.values()), len(known), sum(x == 1 for x in known.values())
        seen[cell(k, n - 1, d - 1)] += once
        escaped[cell(k, n - 1, d - 1)] += once
        seen[cell(k, n - 1, d)] += n - once

    def cost(s: bytes) -> float:
        total = 0.0
        for p in range(K, len(s)):
            hidden: set[int] = set()
            for k in range(K, -1, -1):
                known = contexts.get(s[p - k : p])
                if known is None:
                    continue
                left = sum(n for x, n in known.items() if x not in hidden)
                kinds = sum(x not in hidden for x in known)
                if kinds:
                    at = cell(k, left, kinds)
                    escape = (escaped[at] + 0.5) / (seen[at] + 1)
                    if s[p] in known:
                        total += math.log10(known[s[p]] / left * (1 - escape))
                        break
                    total += math.log10(escape)
                hidden = set(known)
            else:
                total -= math.log10(257 - len(hidden))
        return total

    return cost


@pytest.mark.parametrize("block", [ppm_text.BLOCK, 1])
def test_scores_equal_a_plain_model(docs, no_docs, block):
    apart = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    texts = {r.doc_id: running(r.text) for r in docs.select("doc_id", "text").collect()}
    cost = plain_model([s for i, s in texts.items() if not apart(i)])
    tokens = {i: [*WORD.findall(s[K:].decode()), "\n"] for i, s in texts.items()}
    counts = collections.Counter(w for i, ws in tokens.items() if not apart(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    rows = ppm_text.score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, block, 1 << 12).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for row in rows:
        words = tokens[row.doc_id]
        assert (row.held_out, row.n_tokens, row.train_tokens) == (apart(row.doc_id), len(words), n)
        assert row.n_known == sum(counts[w] > 0 for w in words)
        assert row.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
        assert row.score == pytest.approx(cost(texts[row.doc_id]), rel=1e-6)
    assert ppm_text.score(no_docs, F.lit(False)).count() == 0


def scored_apart(spark, folder, common: str, texts: list[str]):
    """The query's rows for held-out texts, after training on texts of which every other one is ``common``."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(200)]
    ids = range(400)
    apart = [i for i in ids if zlib.crc32(str(i).encode()) % 7 == 2][: len(texts)]
    rows = [(i, common if i % 2 else " ".join(rng.choice(words) for _ in range(60))) for i in ids if zlib.crc32(str(i).encode()) % 7 != 2]
    rows += list(zip(apart, texts))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    scored = {r.doc_id: r for r in queries.op6_lm_score(spark, str(folder)).collect()}
    return [scored[i] for i in apart]


def test_order_of_words_counts(spark, tmp_path):
    rng = random.Random(6)
    phrase = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(60)]
    texts = [" ".join(phrase), " ".join(rng.sample(phrase, len(phrase)))]
    fluent, mixed_up = scored_apart(spark, tmp_path, texts[0], texts)
    assert fluent.base_score == pytest.approx(mixed_up.base_score)
    assert fluent.score > mixed_up.score / 2  # costs are negative: less than half


def test_unseen_words_are_spelled_by_longer_contexts(spark, tmp_path):
    """Both words are new from their first bytes on, and every trigram of theirs was met equally often."""
    spelled, garbled = scored_apart(spark, tmp_path, " ".join(["rklms zyxwvuzyx tklmp zyxwvuzyx"] * 9), ["vwrklms zyxwvuzyx", "vwrklmp zyxwvuzyx"])
    assert spelled.n_known == garbled.n_known == 2
    assert spelled.score > garbled.score + 1


def test_long_words_count_to_their_end(spark, tmp_path):
    """After 30 bytes, where every trigram of both words was met equally often."""
    start = "http://0123456789abcdefghij.uv/"
    known, garbled = scored_apart(spark, tmp_path, f"{start}rklms zyxwvuzyx {start}tklmp zyxwvuzyx", [f"{start}rklms zyxwvuzyx", f"{start}rklmp zyxwvuzyx"])
    assert known.score > garbled.score + 1


def test_packed_numbers_come_back():
    import numpy as np

    keys = np.array([-(1 << 63), -5, 0, 7, (1 << 63) - 1], np.int64)
    assert ppm_text._unpack_keys(ppm_text._pack_keys(keys)).tolist() == keys.tolist()
    assert ppm_text._unpack(ppm_text._pack(keys[:0]), np.int64).tolist() == []


def test_a_block_is_read_in_small_pieces():
    """All positions of a block of many documents, never more than half a megabyte of text at once."""
    import numpy as np
    import pyarrow as pa

    texts = ["word%d other " % i * 5000 for i in range(30)]
    text, sizes = ppm_text.running_text(*ppm_text.flat_text(pa.array(texts)))
    row = {
        "ids": list(range(30)),
        "held_out": np.zeros(30, bool).tobytes(),
        "sizes": sizes.tobytes(),
        "n_bytes": len(text),
        "text": pa.compress(text.tobytes(), "zstd", asbytes=True),
    }
    pieces = list(ppm_text._pieces(row))
    assert sum(len(gram) for _, _, _, gram, _, _ in pieces) == len(text) - 30 * K
    assert max(len(gram) for _, _, _, gram, _, _ in pieces) <= 1 << 19
    assert [i for ids, *_ in pieces for i in ids] == row["ids"]
