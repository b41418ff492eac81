"""Null ids beside large ones, repeated ids, and columns whose names the operators use themselves."""

from __future__ import annotations

import corpus_pipeline
import pytest

from tidemark.llm import jaccard_join, line_dedup, quality, substring_dedup

BIG = 1 << 60
NAMES = ["_id", "chunk", "kept", "_dropped", "n_lines", "quality_score", "batch", "row", "id", "_row_"]
LONG = "the same passage of many words that stands in several of these texts, again and again, one hundred bytes and more. "
LINE = "a line of more than forty code points that many share"


@pytest.fixture
def odd(spark):
    """Rows with (doc_id, text) and their own number in every column of an awkward name."""
    texts = [(BIG + 1, LONG + "one"), (BIG + 3, "two " + LONG), (None, LONG + "three"), (None, None), (7, LONG), (7, "else " * 30)]
    texts += [(i, f"{LINE}\nown words {i} " + "x y z " * i) for i in range(20, 27)]
    rows = [(i, t, *[n] * len(NAMES)) for n, (i, t) in enumerate(texts)]
    schema = "doc_id long, text string, " + ", ".join(f"{name} long" for name in NAMES)
    return spark.createDataFrame(rows, schema).coalesce(1)


def test_substring_dedup(odd):
    found = substring_dedup.remove_repeats(odd).collect()
    source = odd.collect()
    numbers = {r.batch: r for r in found}
    assert len(found) == len(source) == len(numbers)
    ordered = sorted(source, key=lambda r: (r.doc_id is not None, r.doc_id or 0, (r.text or "").encode()))
    seen: set = set()
    for r in ordered:
        data, gone = (r.text or "").encode(), bytearray(len((r.text or "").encode()))
        for i in range(len(data) - 99):
            if data[i : i + 100] in seen:
                gone[i : i + 100] = b"\x01" * 100
            seen.add(data[i : i + 100])
        got = numbers[r.batch]
        assert bytes(got.kept) == bytes(b for b, g in zip(data, gone) if not g)
        assert (got.doc_id, got.n_bytes, got.n_removed) == (r.doc_id, len(data), sum(gone))
        assert [got[n] for n in NAMES if n != "kept"] == [r[n] for n in NAMES if n != "kept"]


def test_lengths_other_than_a_hundred(spark):
    import random

    rng = random.Random(4)
    base = "".join(rng.choice("ab ") for _ in range(900))
    texts = [base, base[200:700] + "c" + base[:150], "z" * 400]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for length in (48, 150, 260):
        found = {r.doc_id: bytes(r.kept) for r in substring_dedup.remove_repeats(docs, length).collect()}
        seen: set = set()
        for i, text in enumerate(texts):
            gone = set()
            for at in range(len(text) - length + 1):
                if text[at : at + length] in seen:
                    gone.update(range(at, at + length))
                seen.add(text[at : at + length])
            assert found[i].decode() == "".join(c for at, c in enumerate(text) if at not in gone)
    with pytest.raises(ValueError):
        substring_dedup.remove_repeats(docs, 40)


def test_line_dedup(odd):
    found = {r.batch: r for r in line_dedup.drop_repeated_lines(odd).collect()}
    for r in odd.collect():
        got, lines = found[r.batch], (r.text or "").split("\n")
        kept = lines if r.doc_id in (None, 26) or LINE not in lines else lines[1:]
        assert (got.doc_id, got.text, got.n_lines, got.n_dropped) == (r.doc_id, "\n".join(kept), len(lines), len(lines) - len(kept))
        assert [got[n] for n in NAMES if n != "n_lines"] == [r[n] for n in NAMES if n != "n_lines"]


def test_quality_score(odd, spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20, 27)], "doc_id long, quality int, toxic int")
    scored = quality.score(odd, quality.train(odd, labels))
    assert scored.columns.count("quality_score") == 1 and scored.count() == odd.count()


def test_near_duplicate_stage(spark):
    p = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, p), (1, p), (None, p), (None, p), (2, p + " a"), (2, other), (None, None), (5, ""), (BIG + 1, other + " b"), (BIG, "alone here")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _row_ string")
    kept = corpus_pipeline.one_of_near_duplicates(spark, docs, "").collect()
    wanted = [(1, p), (2, other), (None, None), (5, ""), (BIG, "alone here")]
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(wanted, key=str)
    assert corpus_pipeline.one_of_near_duplicates(spark, docs.limit(0), "").collect() == []


def test_jaccard_join_keeps_large_ids_beside_nulls(spark):
    """One range holds all rows; ids above 2^53 that differ in the last bits must not meet."""
    rows = [(BIG + 1, LONG), (BIG + 3, "else " * 30), (None, LONG), (None, None), (BIG + 2, LONG + "more"), (BIG + 9, LONG)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = sorted(((r.doc_id, r.component_id) for r in jaccard_join.similar_groups(docs).collect()), key=str)
    want = [(BIG + 1, BIG + 1), (BIG + 3, BIG + 3), (None, None), (None, None), (BIG + 2, BIG + 1), (BIG + 9, BIG + 1)]
    assert found == sorted(want, key=str)
