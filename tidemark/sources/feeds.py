"""Feeds: raw tables of different shape bound to the trip schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.lineage import scanned_file
from tidemark.schema import RAW_TRIP_SCHEMA, TRIP_SCHEMA, conform, struct, union_all
from tidemark.sources.files import catalog, catalog_paths, new_files


@dataclass(frozen=True)
class Feed:
    """Parquet paths with one physical schema, and the trip column -> SQL expression binding."""

    name: str
    paths: tuple[str, ...]
    schema: T.StructType
    binding: tuple[tuple[str, str], ...]

    def at(self, *paths: str) -> Feed:
        """The same feed read from other paths."""
        return replace(self, paths=paths)

    def per_path(self) -> list[Feed]:
        return [replace(self, name=path.rsplit("/", 1)[-1], paths=(path,)) for path in self.paths]


# Physical schemas of the raw tables and their binding to trip columns.
LONG, INT, DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
STRING, TIME = T.StringType(), T.TimestampNTZType()

EVENTS_SCHEMA = struct(event_id=LONG, ts=TIME, user_id=LONG, event_type=STRING, value=DOUBLE, props=STRING)
ORDERS_SCHEMA = struct(
    o_orderkey=LONG,
    o_custkey=LONG,
    o_orderstatus=STRING,
    o_totalprice=DOUBLE,
    o_orderdate=TIME,
    o_orderpriority=STRING,
)
LINEITEM_SCHEMA = struct(
    l_orderkey=LONG,
    l_partkey=LONG,
    l_suppkey=LONG,
    l_linenumber=INT,
    l_quantity=DOUBLE,
    l_extendedprice=DOUBLE,
    l_discount=DOUBLE,
    l_tax=DOUBLE,
    l_returnflag=STRING,
    l_linestatus=STRING,
    l_shipdate=TIME,
)
RAW_SCHEMAS = {"events": EVENTS_SCHEMA, "orders": ORDERS_SCHEMA, "lineitem": LINEITEM_SCHEMA}

BINDINGS: dict[str, dict[str, str]] = {
    "events": {
        "trip_id": "event_id",
        "pickup_datetime": "ts",
        "trip_miles": "value",
        "trip_time": "try_cast(get_json_object(props, '$.k') as int)",
        "PULocationID": "user_id",
        "hvfhs_license_num": "event_type",
    },
    "orders": {
        "trip_id": "o_orderkey",
        "pickup_datetime": "o_orderdate",
        "trip_miles": "o_totalprice",
        "trip_time": "try_cast(left(o_orderpriority, 1) as int)",
        "PULocationID": "o_custkey",
        "hvfhs_license_num": "o_orderstatus",
    },
    "lineitem": {
        "trip_id": "l_orderkey * 8 + l_linenumber",  # an order has at most seven lines
        "pickup_datetime": "l_shipdate",
        "trip_miles": "l_quantity",
        "trip_time": "l_linenumber",
        "PULocationID": "l_suppkey",
        "hvfhs_license_num": "l_returnflag",
        "base_passenger_fare": "l_extendedprice",
    },
}


def raw_table(spark: SparkSession, data_dir: str, table: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMAS[table]).parquet(table_path(data_dir, table))


def table_path(data_dir: str, table: str) -> str:
    return f"{data_dir}/{table}.parquet"


def table_feed(data_dir: str, table: str) -> Feed:
    path = table_path(data_dir, table)
    return Feed(table, (path,), RAW_SCHEMAS[table], tuple(BINDINGS[table].items()))


def directory_feed(
    spark: SparkSession,
    raw_dir: str,
    schema: T.StructType = TRIP_SCHEMA,
    file_limit: int | None = None,
) -> Feed:
    """All (or the first ``file_limit``) trip files of a directory, read with one declared schema.

    Columns outside the schema are not read, and files must hold its types; for others use
    :func:`directory_feeds`.
    """
    paths = catalog_paths(catalog(spark, raw_dir, file_limit))
    return Feed(raw_dir, tuple(paths), schema, tuple((f.name, f"`{f.name}`") for f in schema.fields))


def directory_feeds(
    spark: SparkSession, raw: str | Sequence[str], file_limit: int | None = None
) -> list[Feed]:
    """All (or the first ``file_limit``) trip files of folders, with every column they have.

    Files are grouped by the types they are written in, each group is read in its own types, and the
    values are cast to the trip schema afterwards. Columns beyond that schema are passed through;
    trip columns a file lacks are NULL. Footers are merged by Spark, halving a run of files (in
    order of their names) wherever types disagree: as many jobs as there are changes of type, times
    the logarithm of the number of files.
    """
    paths = catalog_paths(catalog(spark, raw, file_limit))
    name = raw if isinstance(raw, str) else ",".join(raw)
    grouped: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, members in _same_types(spark, paths):
        grouped.setdefault(schema.json(), (schema, []))[1].extend(members)
    return [
        Feed(name, tuple(members), schema, tuple((field.name, f"`{field.name}`") for field in schema.fields))
        for schema, members in grouped.values()
    ]


def _same_types(spark: SparkSession, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    if not paths:
        return []
    try:
        return [(spark.read.option("mergeSchema", True).parquet(*paths).schema, paths)]
    except (PySparkException, Py4JJavaError) as failure:
        if len(paths) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(failure):
            raise
    middle = len(paths) // 2
    return _same_types(spark, paths[:middle]) + _same_types(spark, paths[middle:])


def bind(df: DataFrame, binding: Sequence[tuple[str, str]]) -> DataFrame:
    """Rename and compute columns; types are left as they are."""
    return df.select(*[F.expr(expression).alias(name) for name, expression in binding])


def with_binding(df: DataFrame, feed: Feed, lineage: bool = True) -> DataFrame:
    """Bound columns plus the source file; ``df`` must be a plain scan, batch or streaming.

    Columns a binding names beyond the trip schema are passed through. Ask for no lineage rather
    than dropping ``source_file`` later: once a plan mentions file metadata, the scan builds all of
    it for every row unless a field is used.
    """
    columns = [F.expr(expression).alias(name) for name, expression in feed.binding]
    if not lineage:
        return conform(df.select(*columns), TRIP_SCHEMA, keep_extra=True)
    bound = df.select(*columns, scanned_file().alias("source_file"))
    return conform(bound, RAW_TRIP_SCHEMA, keep_extra=True)


def read_feed(spark: SparkSession, feed: Feed, lineage: bool = True) -> DataFrame:
    return with_binding(spark.read.schema(feed.schema).parquet(*feed.paths), feed, lineage)


def read_feeds(spark: SparkSession, feeds: Sequence[Feed], lineage: bool = True) -> DataFrame:
    """All feeds as one frame: one scan per physical schema, however many files it has."""
    merged: dict[tuple, Feed] = {}
    for feed in feeds:
        key = (feed.schema.json(), feed.binding)
        known = merged.get(key)
        merged[key] = replace(known, paths=known.paths + feed.paths) if known else feed
    frames = [read_feed(spark, feed, lineage) for feed in merged.values()]
    if len(frames) == 1:
        return frames[0]
    return union_all(frames, RAW_TRIP_SCHEMA if lineage else TRIP_SCHEMA)


def unread(spark: SparkSession, feeds: Sequence[Feed], ingested: DataFrame) -> list[Feed]:
    """The feeds narrowed to files whose path is not in the ingestion log; fully read feeds drop out."""
    remaining = []
    for feed in feeds:
        paths = catalog_paths(new_files(catalog(spark, feed.paths), ingested))
        if paths:
            remaining.append(replace(feed, paths=tuple(paths)))
    return remaining


def read_trips(spark: SparkSession, data_dir: str, table: str, lineage: bool = False) -> DataFrame:
    """One raw table as trips."""
    return read_feed(spark, table_feed(data_dir, table), lineage)
