"""Tables that change in one step: versioned folders, and a pointer to what is current.

Rows are written into a folder of their own, ``data/version=.../<partitions>``, which no reader knows. A
manifest names, for each partition, the folders whose files are its rows. The change becomes visible
when a pointer file with the next number is created, which fails when another writer was faster; nothing
is ever overwritten or moved. A reader takes the highest pointer and reads the folders of its manifest,
so it sees the table before a commit or after it, also when the writer is lost at any point between.

Two writers may commit at once: the second one's changes are put on top of the first's when they touch
other partitions or only append, otherwise :class:`ConcurrentChange` says that its rows are out of date.
``vacuum`` deletes folders that recent snapshots do not name.

The pointer needs a file system whose create-without-overwrite is exclusive, as HDFS and the object
stores with conditional writes have it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import storage

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder name of a NULL
VERSION = "version"


class ConcurrentChange(RuntimeError):
    """Another writer changed partitions that this commit was computed from."""


@dataclass(frozen=True)
class Snapshot:
    """What the table was at a commit: folders by partition, its schema, and the tags of all batches it holds."""

    number: int
    folders: dict[str, list[str]]
    schema: T.StructType
    tags: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class SnapshotTable:
    """A table below ``root``, partitioned by ``partition_by`` (may be empty)."""

    spark: SparkSession
    root: str
    partition_by: tuple[str, ...] = ()
    compression: str = "snappy"
    max_records_per_file: int = 5_000_000

    # --- reading -----------------------------------------------------------------------------

    def _numbers(self) -> list[int]:
        return [int(name) for name, _ in storage.names(self.spark, f"{self.root}/_pointers") if name.isdigit()]

    def snapshot(self, number: int) -> Snapshot | None:
        """The snapshot of a number; None when there is none or its pointer was never finished."""
        name = storage.read_text(self.spark, f"{self.root}/_pointers/{number:012d}") or ""
        text = storage.read_text(self.spark, f"{self.root}/_manifests/{name.strip()}.json") if name.endswith("\n") else None
        if text is None:
            return None
        found = json.loads(text)
        return Snapshot(number, found["folders"], T.StructType.fromJson(found["schema"]), found["tags"])

    def current(self) -> Snapshot | None:
        """The newest snapshot that is complete; None before the first commit."""
        for number in reversed(self._numbers()):
            found = self.snapshot(number)
            if found:
                return found
        return None

    def read(self, at: Snapshot | None = None, only: Iterable[str] | None = None) -> DataFrame:
        """The rows of a snapshot (the current one unless told); ``only`` names partitions, and no others are listed or read."""
        found = at or self.current()
        if found is None:
            raise FileNotFoundError(f"no snapshot of {self.root}")
        wanted = found.folders if only is None else {name: found.folders.get(name, []) for name in only}
        return self._rows(wanted, found.schema)

    def partition_names(self, rows: DataFrame) -> list[str]:
        """The partitions, as manifests name them, that these rows belong to; a list as long as the table's partitions."""
        parts = [
            F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit(NULL_PARTITION)))
            for name in self.partition_by
        ]
        named = rows.select(F.concat_ws("/", *parts).alias("name")).distinct()
        return sorted(row[0] for row in named.toLocalIterator())

    def staged_rows(self, staged: tuple[dict[str, list[str]], T.StructType]) -> DataFrame:
        """The rows that :meth:`stage` wrote, whether they are committed or not."""
        return self._rows(*staged)

    def _rows(self, folders: dict[str, list[str]], schema: T.StructType) -> DataFrame:
        paths = [f"{self.root}/data/{folder}" for found in folders.values() for folder in found]
        if not paths:
            return self.spark.createDataFrame([], schema)
        widened = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
        rows = self.spark.read.schema(widened).option("basePath", f"{self.root}/data").parquet(*paths)
        return rows.select(*schema.fieldNames())

    # --- writing -----------------------------------------------------------------------------

    def stage(self, rows: DataFrame) -> tuple[dict[str, list[str]], T.StructType]:
        """Write rows where no reader looks; the folders by partition, and the schema."""
        folder = f"{VERSION}={uuid.uuid4().hex}"
        path = f"{self.root}/data/{folder}"
        laid_out = rows.hint("rebalance", *self.partition_by) if self.partition_by else rows
        writer = laid_out.write.option("compression", self.compression)
        writer = writer.option("maxRecordsPerFile", self.max_records_per_file)
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(path)
        inner = storage.folders_at(self.spark, path, len(self.partition_by)) if self.partition_by else [""]
        return {name: [f"{folder}/{name}".rstrip("/")] for name in inner}, rows.schema

    def commit(
        self,
        rows: DataFrame,
        mode: str = "replace",
        emptied: Iterable[str] = (),
        base: Snapshot | None = None,
        tag: tuple[str, str] | None = None,
        also: dict[str, str] | None = None,
        staged: tuple[dict[str, list[str]], T.StructType] | None = None,
    ) -> Snapshot:
        """Make rows part of the table: ``append``, ``replace`` (their partitions) or ``table`` (everything).

        ``guarded`` appends, unless another writer changed the rows' partitions since ``base``. ``fold`` puts the
        rows in place of what ``base`` held of the ``emptied`` partitions; what was appended since stays.
        ``emptied`` names partitions that lose all rows they have not got anew. ``base`` is the snapshot the rows
        were computed from: a partition changed since then by another writer is a conflict. ``tag`` (key,
        value) is kept with the snapshot and all later ones; see :meth:`tagged`. ``also`` holds more to keep.
        ``staged`` is what :meth:`stage` returned for the rows, which then are not written once more.
        """
        if mode not in ("append", "guarded", "fold", "replace", "table"):
            raise ValueError(f"unknown mode: {mode}")
        seen = base if base or mode == "guarded" else self.current()
        folders, schema = staged or self.stage(rows)
        while True:
            newest = self.current()
            if tag and newest and newest.tags.get(tag[0]) == tag[1]:
                return newest  # another attempt at the same batch was faster
            merged = self._merged(folders, mode, list(emptied), seen, newest)
            tags = {**(newest.tags if newest else {}), **(dict([tag]) if tag else {}), **(also or {})}
            number = max(self._numbers(), default=0) + 1
            candidate = Snapshot(number, merged, _widened(newest.schema, schema) if newest and mode != "table" else schema, tags)
            if self._publish(candidate):
                return candidate

    def _merged(
        self, staged: dict[str, list[str]], mode: str, emptied: Sequence[str], seen: Snapshot | None, newest: Snapshot | None
    ) -> dict[str, list[str]]:
        old = newest.folders if newest else {}
        before = seen.folders if seen else {}
        if mode == "append":
            return {**old, **{name: [*old.get(name, []), *folders] for name, folders in staged.items()}}
        changed = {name for name in {*old, *before} if old.get(name) != before.get(name)}
        if mode == "fold":  # appends since then are no conflict
            changed = {name for name in changed if not set(before.get(name, [])) <= set(old.get(name, []))}
        conflict = changed if mode == "table" else changed.intersection([*staged, *emptied])
        if conflict:
            raise ConcurrentChange(f"{self.root}: {sorted(conflict)[:5]} changed since snapshot {seen.number if seen else 0}")
        if mode == "guarded":
            return {**old, **{name: [*old.get(name, []), *folders] for name, folders in staged.items()}}
        if mode == "fold":
            since = {name: [f for f in old[name] if f not in before[name]] for name in emptied}
            folded = {name: [*staged.get(name, []), *since.get(name, [])] for name in {*staged, *emptied}}
            others = {name: folders for name, folders in old.items() if name not in folded}
            return {**others, **{name: folders for name, folders in folded.items() if folders}}
        kept = {} if mode == "table" else {name: folders for name, folders in old.items() if name not in emptied}
        return {**kept, **staged}

    def _publish(self, candidate: Snapshot) -> bool:
        """Manifest first, then the pointer; False when the number is taken."""
        name = uuid.uuid4().hex
        body = {"folders": candidate.folders, "schema": candidate.schema.jsonValue(), "tags": candidate.tags}
        storage.create_new(self.spark, f"{self.root}/_manifests/{name}.json", json.dumps(body))
        return storage.create_new(self.spark, f"{self.root}/_pointers/{candidate.number:012d}", name + "\n")

    def tagged(self, key: str) -> str | None:
        """The value last committed under a tag, which tells a repeated run what is done already."""
        found = self.current()
        return found.tags.get(key) if found else None

    def vacuum(self, keep: int = 2, older_than_seconds: float = 24 * 3600) -> list[str]:
        """Delete versions that none of the last ``keep`` snapshots names, and older pointers.

        Folders younger than ``older_than_seconds`` may belong to a commit under way and stay.
        """
        numbers = self._numbers()
        kept = [s for s in (self.snapshot(n) for n in numbers[-keep:]) if s]
        current = self.current()
        named = {folder.split("/")[0] for s in [*kept, *([current] if current else [])] for folders in s.folders.values() for folder in folders}
        limit = (time.time() - older_than_seconds) * 1000
        gone = [n for n, changed in storage.names(self.spark, f"{self.root}/data") if n.startswith(VERSION) and n not in named and changed <= limit]
        for name in gone:
            storage.delete(self.spark, f"{self.root}/data/{name}")
        for number in numbers[:-keep]:
            if current is None or number < current.number:
                storage.delete(self.spark, f"{self.root}/_pointers/{number:012d}")
        return gone


def _widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of a table after rows with these columns came; a column keeps its type."""
    known = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        if f.name in known and known[f.name] != f.dataType:
            raise TypeError(f"column {f.name} is {known[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([*old.fields, *(f for f in new.fields if f.name not in known)])
