"""Token counts as delta-maintained rollups.

A change to a document is a signed row: +1 document and its tokens when it is inserted, -1 and
minus its tokens when it is deleted, and the difference of the counts when it is recounted. A batch
of changes is summed by source, language and tokenizer version and committed under its batch id;
a batch committed again replaces itself, so a repeated commit changes nothing. Totals are the sum
over batches, and `compact` folds batches into one base without changing them. The base remembers which
batches it holds: a folded batch is closed, and committing it again does nothing. Every commit and
compaction becomes visible in one step (a snapshot table), so that readers and a lost writer leave a batch
as it was or as it is to be. A rollup without batches has no totals.

Null source or language forms a group of its own; null and empty texts count 0 tokens. Groups whose
documents have all gone stay with zeros until the next compaction, and `totals` leaves them out.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.packing import token_ids
from tidemark.plans.snapshots import Snapshot, SnapshotTable
from tidemark.scratch import new_dir

GROUP = ["source", "lang", "tokenizer"]
BASE = -1  # the batch that holds what was folded
FOLDED = "folded"
SPACES = "[\\x20\\x09-\\x0D]+"
EDGE = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Number of runs without white space."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(EDGE))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACES, -1))).cast("long")


def quads(text: Column) -> Column:
    """Number of pieces of four code points, the last may be shorter."""
    return F.ceil(F.length(F.coalesce(text, F.lit(""))) / 4).cast("long")


def byte_bpe(path: str) -> Callable[[Column], Column]:
    """Number of ids under a byte-level vocabulary file, which every executor has at ``path``."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(token_ids(path, text)) // 4 for text in texts], dtype=np.int64)

    return lambda text: count(F.coalesce(text, F.lit("")))


TOKENIZERS = {"words-1": words, "quads-1": quads}


def counted(docs: DataFrame, tokenizers: dict = TOKENIZERS) -> DataFrame:
    """A row for each document and tokenizer version: id, group columns and ``tokens``."""
    each = F.array(
        *[F.struct(F.lit(name).alias("tokenizer"), count(F.col("text")).alias("tokens")) for name, count in tokenizers.items()]
    )
    rows = docs.select("doc_id", "source", "lang", F.explode(each).alias("c"))
    return rows.select("doc_id", "source", "lang", "c.tokenizer", "c.tokens")


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*GROUP, F.lit(1).cast("long").alias("docs"), "tokens")


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*GROUP, F.lit(-1).cast("long").alias("docs"), (-F.col("tokens")).alias("tokens"))


def recounts(old: DataFrame, new: DataFrame) -> DataFrame:
    """The old counts go and the new ones come; documents stay as many."""
    return deletes(old).unionByName(inserts(new))


class Rollup:
    """Committed batches below one folder of shared storage."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or new_dir(spark, "token-counts")
        self.table = SnapshotTable(spark, self.path, ("batch",))

    def commit(self, batch_id: int, changes: DataFrame) -> None:
        """Sum a batch (id from 0) of signed rows and store it; the same id again replaces it, unless it was folded."""
        if batch_id < 0:
            raise ValueError(f"batch ids start at 0: {batch_id}")
        base = self.table.current()
        if any(first <= batch_id <= last for first, last in _folded(base)):
            return
        summed = _summed(changes).withColumn("batch", F.lit(batch_id).cast("long"))
        self.table.commit(summed, "replace", emptied=[f"batch={batch_id}"], base=base)

    def totals(self) -> DataFrame:
        if self.table.current() is None:
            empty = "source string, lang string, tokenizer string, docs long, tokens long"
            return self.spark.createDataFrame([], empty)
        return _summed(self.table.read()).filter("docs != 0 OR tokens != 0")

    def compact(self) -> Rollup:
        """Fold all batches into the base. Snapshots before stay readable; batches committed meanwhile stay batches.

        A writer that replaces one of the folded batches meanwhile is told so (``ConcurrentChange``), or this is.
        """
        base = self.table.current()
        if base is None:
            return self
        held = sorted(base.folders)
        ids = [int(name.split("=")[1]) for name in held]
        spans = _joined([*_folded(base), *((i, i) for i in ids if i != BASE)])
        rows = _summed(self.table.read(base)).filter("docs != 0 OR tokens != 0").withColumn("batch", F.lit(BASE).cast("long"))
        self.table.commit(rows, "replace", emptied=held, base=base, also={FOLDED: json.dumps(spans)})
        return self


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


def _folded(snapshot: Snapshot | None) -> list[tuple[int, int]]:
    """First and last id of the runs of folded batches."""
    return [tuple(span) for span in json.loads(snapshot.tags.get(FOLDED, "[]"))] if snapshot else []


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out
