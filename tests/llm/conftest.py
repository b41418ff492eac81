from __future__ import annotations

import random

import pytest

from tidemark.llm.shipping import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, line long, rank string"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def sample_texts() -> list[str | None]:
    """Null, empty, blank, repeated, near-copied, periodic, accented and long texts with shared lines."""
    rng = random.Random(3)
    words = ["the", "of", "and", "ration", "entis", "über", "été", "naïve", "Onder", "thing", "x", "blest", "12"]
    shared = ["A line that very many of the documents share, word by word.", "Short one", "  " + "PASSAGE " * 20]

    def text(n: int) -> str:
        parts = [rng.choice(words) + (rng.choice(".,!") if rng.random() < 0.2 else "") for _ in range(n)]
        return " ".join(parts) + "\n" + rng.choice(shared) + "\n" + " ".join(rng.choice(words) for _ in range(n // 2))

    out = [None, "", " \t ", "one two", "\n", "ab " * 200, "é" * 300, *[text(rng.randint(5, 120)) for _ in range(40)]]
    out += [out[10], out[11], out[10], out[12] + " more words", out[13].replace("the", "that", 1), text(6000)]
    return out


@pytest.fixture
def docs(spark):
    """The texts with ids out of order, and extra columns whose names the operators use themselves."""
    texts = sample_texts()
    ids = list(range(len(texts)))
    random.Random(4).shuffle(ids)
    rows = [(i, t, "en", "src", None, 7, 8, "r") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
