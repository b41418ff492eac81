"""Every operator against a plain version on a small table with awkward rows, and on an empty table."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, fingerprints, jaccard_join, line_dedup, mtree, packing, ppm, quality, substring_dedup, token_counts
from tidemark.llm.components import components
from tidemark.llm.queries import vocabulary

WORD = re.compile("[^\x20\x09-\x0d]+")
EDGE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts_of(df) -> list[tuple[int, str]]:
    return sorted((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect())


def test_fingerprints(docs, no_docs):
    rows = {r.doc_id: r for r in fingerprints.compare_with_edits(docs).collect()}
    texts = texts_of(docs)
    for (i, text), (j, following) in zip(texts, texts[1:] + texts[:1]):
        row, new = rows[i], fingerprints.edited(text, following)
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert row.fingerprint == fingerprints.fingerprint(text.encode())
        assert row.edited_fingerprint == fingerprints.fingerprint(new.encode())
        assert row.near_next == fingerprints.likeness([row.fingerprint], [rows[j].fingerprint])[0]
    assert fingerprints.compare_with_edits(no_docs).count() == 0
    assert fingerprints.likeness(["1::"], ["1::"])[0] == 1.0


def test_fingerprint_likeness_follows_edits():
    rng = np.random.default_rng(2)
    text = rng.integers(97, 123, 20_000).astype(np.uint8).tobytes()
    other = rng.integers(97, 123, 20_000).astype(np.uint8).tobytes()
    mine, near, far = (fingerprints.fingerprint(x) for x in (text, text[:15_000] + other[:5_000], other))
    assert fingerprints.likeness([mine], [near])[0] > 0.6
    assert fingerprints.likeness([mine], [far])[0] == 0


def test_line_dedup(docs, no_docs):
    key = lambda line: line.strip(EDGE).translate(LOWER)
    count, last = collections.Counter(), {}
    for i, text in texts_of(docs):
        for k in {key(x) for x in text.split("\n")}:
            count[k] += 1
            last[k] = i
    rows = {r.doc_id: r for r in line_dedup.drop_repeated_lines(docs, batches=4).collect()}
    dropped = 0
    for i, text in texts_of(docs):
        lines = text.split("\n")
        kept = [x for x in lines if len(key(x)) < 40 or count[key(x)] < 5 or last[key(x)] == i]
        assert (rows[i].n_lines, rows[i].n_dropped, rows[i].text) == (len(lines), len(lines) - len(kept), "\n".join(kept))
        dropped += len(lines) - len(kept)
    assert dropped > 0
    assert line_dedup.drop_repeated_lines(no_docs).count() == 0


def removed(texts: list[tuple[int, str]], length: int = 100) -> dict[int, tuple]:
    seen, out = set(), {}
    for i, text in texts:
        data = text.encode()
        mark = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            part = data[p : p + length]
            if part in seen:
                mark[p : p + length] = True
            seen.add(part)
        spans = int((np.diff(mark.astype(int), prepend=0) == 1).sum())
        out[i] = (len(data), int(mark.sum()), spans, bytes(b for b, m in zip(data, mark) if not m))
    return out


def test_substring_dedup(docs, no_docs):
    rows = substring_dedup.remove_repeats(docs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows} == removed(texts_of(docs))
    assert substring_dedup.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_suffix_blocks(letters):
    rng = np.random.default_rng(letters)
    text = rng.integers(97, 97 + letters, 900).astype(np.uint8)
    text[500:800] = text[:300]
    data, seen = text.tobytes(), set()
    want = []
    for i in range(801):
        want.append(data[i : i + 100] not in seen)
        seen.add(data[i : i + 100])
    assert substring_dedup.first_of_equal(text, np.arange(801)).tolist() == want


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe_equals_the_library(docs, no_docs, name):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary(name))
    rows = {r.doc_id: r for r in bpe.encode_and_decode(docs, vocabulary(name)).collect()}
    for i, text in texts_of(docs):
        ids = library.encode(text, add_special_tokens=False).ids
        assert bytes(rows[i].ids) == np.array(ids, "<u4").tobytes()
        assert bytes(rows[i].decoded).decode() == library.decode(ids, skip_special_tokens=False)
    model = bpe.BPE(vocabulary(name))
    for text in ["<|endoftext|>a<|x|>", "aaaaaaa" * 50, "ΑΣ İ ½ ² 日本 🎉", "it's WE'LL  x  y", "\x1c\x85é"]:
        assert model.encode([text])[0] == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert bpe.encode_and_decode(no_docs, vocabulary(name)).count() == 0


def test_token_counts(spark, docs):
    counts = token_counts.counted(docs)
    rollup = token_counts.Rollup(spark)
    rollup.commit(1, token_counts.inserts(counts))
    for _ in range(2):
        rollup.commit(2, token_counts.deletes(counts.filter("doc_id < 5")))
    rollup.commit(3, token_counts.recounts(counts.filter("doc_id = 9"), counts.filter("doc_id = 9").withColumn("tokens", F.lit(3).cast("long"))))
    left = [(i, t) for i, t in texts_of(docs) if i >= 5]
    want = {
        "words-1": (len(left), sum(3 if i == 9 else len(WORD.findall(t)) for i, t in left)),
        "quads-1": (len(left), sum(3 if i == 9 else -(-len(t) // 4) for i, t in left)),
    }
    for state in (rollup, rollup.compact()):
        assert {r.tokenizer: (r.docs, r.tokens) for r in state.totals().collect()} == want


def test_folded_batches_are_not_counted_again(spark):
    rows = lambda *r: spark.createDataFrame([("s", None, "t", d, n) for d, n in r], "source string, lang string, tokenizer string, docs long, tokens long")
    rollup = token_counts.Rollup(spark)
    of = lambda state: [(r.docs, r.tokens) for r in state.totals().collect()]
    assert of(rollup) == [] and of(rollup.compact()) == []
    rollup.commit(1, rows((1, 3), (1, 2)))
    rollup.commit(2, rows((-1, -2)))
    assert of(rollup) == of(rollup.compact()) == [(1, 3)]
    for batch in (1, 2):
        rollup.commit(batch, rows((-1, -2)))
    assert of(rollup) == [(1, 3)]
    rollup.commit(3, rows((1, 9)))
    rollup.commit(3, rows((1, 8)))
    assert of(rollup) == [(2, 11)]
    assert of(rollup.compact()) == [(2, 11)]
    rollup.commit(3, rows((1, 9)))
    assert of(rollup) == [(2, 11)]
    rollup.commit(4, rows((5, 5)))
    rollup.commit(4, rows((5, 5)).limit(0))
    assert of(rollup) == [(2, 11)]
    rollup.commit(0, rows((-2, -11)))
    assert of(rollup) == of(rollup.compact()) == []
    assert token_counts._folded(rollup.table.current()) == [(0, 3)]


def test_a_writer_lost_in_a_commit_leaves_the_batch(spark, monkeypatch):
    rows = spark.createDataFrame([("s", "l", "t", 1, 3)], "source string, lang string, tokenizer string, docs long, tokens long")
    rollup = token_counts.Rollup(spark)
    rollup.commit(1, rows)
    monkeypatch.setattr(type(rollup.table), "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        rollup.commit(1, rows.union(rows))
    assert [(r.docs, r.tokens) for r in rollup.totals().collect()] == [(1, 3)]


def test_counts_of_a_vocabulary(spark, docs):
    tokenizers = pytest.importorskip("tokenizers")
    path = vocabulary("byte_bpe_50k.json")
    counts = token_counts.counted(docs, {"byte_bpe_50k": token_counts.byte_bpe(path)})
    library = tokenizers.Tokenizer.from_file(path)
    want = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in texts_of(docs)}
    assert {r.doc_id: r.tokens for r in counts.collect()} == want


def plain_ppm(counts: dict[str, int]):
    ended = lambda w: b" " + w.encode() + (b"" if w == "\n" else b" ")

    def chain(s: bytes, p: int) -> list[tuple[int, bytes]]:
        whole = [(2 + min(p, 6), s[:p])] if p <= ppm.DEPTH else []
        return whole + [(k, s[p - k : p]) for k in range(ppm.ORDER, -1, -1) if k < p or p > ppm.DEPTH]

    contexts: dict[tuple, collections.Counter] = {}
    for word, n in counts.items():
        s = ended(word)
        for p in range(1, len(s)):
            # short contexts are counted everywhere, also where the whole beginning is as short
            for key in {*chain(s, p), *((k, s[p - k : p]) for k in range(min(p, ppm.ORDER) + 1))}:
                contexts.setdefault(key, collections.Counter())[s[p]] += n
    cell = lambda kind, n, d: (kind, min(n.bit_length(), 20), min(d, 12))
    seen, escaped = collections.Counter(), collections.Counter()
    for (kind, _), known in contexts.items():
        n, d, once = sum(known.values()), len(known), sum(x == 1 for x in known.values())
        seen[cell(kind, n - 1, d - 1)] += once
        escaped[cell(kind, n - 1, d - 1)] += once
        seen[cell(kind, n - 1, d)] += n - once

    def cost(word: str) -> float:
        s, total = ended(word), 0.0
        for p in range(1, len(s)):
            hidden: set[int] = set()
            for key in chain(s, p):
                known = contexts.get(key)
                if known is None:
                    continue
                left = sum(n for x, n in known.items() if x not in hidden)
                kinds = sum(x not in hidden for x in known)
                if kinds:
                    at = cell(key[0], left, kinds)
                    escape = (escaped[at] + 0.5) / (seen[at] + 1)
                    if s[p] in known:
                        total += math.log10(known[s[p]] / left * (1 - escape))
                        break
                    total += math.log10(escape)
                hidden = set(known)
            else:
                total -= math.log10(ppm.SYMBOLS - len(hidden))
        return total

    return cost


def test_ppm(docs, no_docs):
    apart = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    tokens = {i: [*WORD.findall(t.translate(LOWER)), "\n"] for i, t in texts_of(docs)}
    counts = collections.Counter(w for i, ws in tokens.items() if not apart(i) for w in ws)
    n, v, cost = sum(counts.values()), len(counts), plain_ppm(counts)
    rows = ppm.score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).collect()
    assert len(rows) == len(tokens)
    for row in rows:
        words = tokens[row.doc_id]
        assert (row.held_out, row.n_tokens, row.train_tokens) == (apart(row.doc_id), len(words), n)
        assert row.n_known == sum(counts[w] > 0 for w in words)
        assert row.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
        assert row.score == pytest.approx(sum(map(cost, words)))
    assert ppm.score(no_docs, F.lit(False)).count() == 0


def test_exact_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 0.3, (300, 8)).astype(np.float32)
    vectors[50:80] = vectors[50]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(300, None), (400, [1.0, None] * 4), (500, [float("nan")] * 8), (None, [0.1] * 8), (600, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = mtree.exact_top_k(table, table.filter("vec_id % 100 = 0"), 10).collect()
    whole = np.floor(1024 * vectors.astype(np.float64)).astype(np.int64)
    want = []
    for q in (0, 100, 200):
        score = whole @ whole[q]
        best = [j for j in np.lexsort((np.arange(300), -score)).tolist() if j != q][:10]
        want += [(q, rank + 1, j, int(score[j])) for rank, j in enumerate(best)]
    assert sorted(tuple(r) for r in found) == sorted(want)
    assert mtree.exact_top_k(table.limit(0), table.limit(0)).count() == 0


def test_quality(spark, data_dir, no_docs):
    documents, labels = (spark.read.parquet(f"{data_dir}/{n}.parquet") for n in ("documents", "labels"))
    apart = quality.held_out(5, 0)
    machine = quality.train(documents.filter(~apart), labels)
    scored = quality.score(documents, machine).join(labels, "doc_id").filter(apart).collect()
    good = [r.quality_score for r in scored if r.quality == 1]
    bad = [r.quality_score for r in scored if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert quality.score(no_docs, machine).count() == 0
    blank = machine.score(__import__("pyarrow").array([None, ""]))
    assert blank[0] == blank[1] and 0 <= blank[0] <= 1
    nothing = quality.train(no_docs, labels)
    assert quality.score(documents, nothing).filter("quality_score != 0.5").count() == 0


def test_factorisation_identity():
    import pyarrow as pa

    machine = quality.fit(["a b c", "x y z w"], np.array([1.0, 0.0], np.float32))
    begin, columns, values = quality.features(pa.array(["a b z c"]))
    raw, _ = machine.sums(begin, columns, values)
    pairs = sum(
        float(machine.factors[a] @ machine.factors[b]) * float(x) * float(y)
        for n, (a, x) in enumerate(zip(columns, values))
        for b, y in list(zip(columns, values))[n + 1 :]
    )
    assert raw[0] == pytest.approx(machine.bias + float(machine.linear[columns] @ values) + pairs, abs=1e-4)


def test_packing(docs, no_docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rows = packing.pack(docs, vocabulary("byte_bpe_50k.json")).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, text in texts_of(docs):
        ids, at = [*library.encode(text, add_special_tokens=False).ids, 2], 0
        for r in sorted(pieces[i], key=lambda r: r.piece):
            assert r.start == at
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert packing.pack(no_docs, vocabulary("byte_bpe_50k.json")).count() == 0


def test_plan_is_best_fit_decreasing():
    import random

    rng = random.Random(8)
    for _ in range(20):
        lengths, bins = [rng.randint(1, 30) for _ in range(rng.randint(1, 200))], []
        for length in sorted(lengths, reverse=True):
            fits = [(room, i) for i, room in enumerate(bins) if room >= length]
            if fits:
                bins[min(fits)[1]] -= length
            else:
                bins.append(30 - length)
        rows = packing.plan(collections.Counter(lengths), 30)
        assert max(first + number for _, _, number, first, _ in rows) == len(bins)


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80)])
def test_jaccard_join(docs, no_docs, width, percent):
    sets, parent = {}, {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, text in texts_of(docs):
        words = WORD.findall(text.translate(LOWER))
        grams = [tuple(words[j : j + width]) for j in range(len(words) - width + 1)] or ([tuple(words)] if words else [])
        sets[i], parent[i] = set(grams), i
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    rows = jaccard_join.similar_groups(docs, width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {i: (len(s), root(i)) for i, s in sets.items()}
    assert jaccard_join.similar_groups(no_docs).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (200, 200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}
