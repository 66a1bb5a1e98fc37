"""The hit and group tables.

What a table holds is named by its commit log (``sources.log``), so appends, readers and compaction don't
disturb each other. Rows carry a version, by default the time of the write; of equal keys the latest version
counts, and readers resolve that. Hits lie in a fixed number of folders by a hash of the group, so that the
layout doesn't grow with the groups, and are sorted within files, so that a filter on group, observation or
strength skips row groups.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.operators.range_join import range_semi_join
from nearfield.operators.upsert import latest
from nearfield.schema import GROUP_KEY, GROUPS, HIT_KEY, HITS
from nearfield.sources import log

# The read order of hits within an observation.
CLUSTERING = [("snr", False), ("driftrate", False)]
#: Folders of the hit table.
BUCKETS = 64
#: Columns by which slices of a bucket are laid out, bits of each on the curve, and of a slice's number.
SPANS, CURVE_BITS, SLICE_BITS = ("frequency", "snr"), 4, 4
#: Columns of the tables that rows are looked up by.
HIT_LOOKUPS, GROUP_LOOKUPS = ("observationgroup",), ("observationgroup", "source")

BUCKET = T.StructField("bucket", T.IntegerType())
VERSION = T.StructField("version", T.LongType())
STORED_HITS = T.StructType([*HITS.fields, VERSION, BUCKET])
STORED_GROUPS = T.StructType([*GROUPS.fields, VERSION])


def conform(df: DataFrame, schema: T.StructType, *extra: str) -> DataFrame:
    """The schema's columns in its order and types, and any extra columns."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *extra)


def from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType = HITS) -> DataFrame:
    """A few rows given in the program as a DataFrame."""
    return spark.createDataFrame(list(rows), schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType = HITS, format: str = "parquet", **options):
    """Scan of a table. The partition column is typed by the schema, not guessed from paths."""
    return conform(spark.read.format(format).schema(schema).options(**options).load(path), schema)


def bucket_of(group: Column) -> Column:
    """The folder of a group."""
    return F.pmod(F.xxhash64(group.cast("int")), F.lit(BUCKETS)).cast("int")


def in_groups(stored: DataFrame, groups: Sequence[int]) -> DataFrame:
    """The rows of a few groups; only their folders are read."""
    wanted = [F.lit(int(g)) for g in groups]
    return stored.where(F.col("bucket").isin(*[bucket_of(g) for g in wanted]) & F.col("observationgroup").isin(*wanted))


def read_hits(spark: SparkSession, path: str, groups: Sequence[int] | None = None, state: log.Snapshot | None = None) -> DataFrame:
    """The hits, the latest version of each key; of some groups only, or of an earlier snapshot, if given."""
    stored = log.scan(spark, path, STORED_HITS, state)
    chosen = stored if groups is None else in_groups(stored, groups)
    return conform(latest(chosen.drop("bucket"), HIT_KEY, ["version"]), HITS)


def read_groups(spark: SparkSession, path: str, state: log.Snapshot | None = None) -> DataFrame:
    """The group rows, the latest version of each group."""
    return conform(latest(log.scan(spark, path, STORED_GROUPS, state), GROUP_KEY, ["version"]), GROUPS)


def clustered(hits: DataFrame) -> DataFrame:
    """Hits with their bucket, gathered by it, a large one over several files, each file in read order.

    The rebalance hint splits and merges by size, so no group needs to fit a task.
    """
    order = [F.col("bucket"), F.col("observationgroup"), F.col("observationorder")]
    order += [F.col(c).asc() if up else F.col(c).desc() for c, up in CLUSTERING]
    rows = hits.withColumn("bucket", bucket_of(F.col("observationgroup")))
    return rows.hint("rebalance", F.col("bucket")).sortWithinPartitions(*order)


def _versioned(rows: DataFrame, version: int | None) -> DataFrame:
    return rows.withColumn("version", F.lit(time.time_ns() if version is None else version).cast("bigint"))


def _curve(column: str, ends: tuple) -> list[Column]:
    """The bits of a column's place between two values, the highest first."""
    low, high = ends
    share = (F.col(column) - F.lit(low)) / F.lit(high - low if high > low else 1.0)
    cell = F.greatest(F.lit(0), F.least(F.lit((1 << CURVE_BITS) - 1), F.floor(share * (1 << CURVE_BITS)))).cast("int")
    return [F.shiftright(cell, k).bitwiseAND(1) for k in reversed(range(CURVE_BITS))]


def sliced(hits: DataFrame) -> DataFrame:
    """Clustered hits with a ``slice``: a run of a space-filling curve over frequency and strength, so that a
    slice's rows lie near each other in both. The curve spans the bulk of the rows; the rest is at its ends.

    Rows without a frequency or strength are in slice 0.
    """
    ends = hits.agg(*[F.percentile_approx(c, [0.01, 0.99]).alias(c) for c in SPANS]).first()
    bits = [b for pair in zip(*[_curve(c, tuple(ends[c] or (0.0, 0.0))) for c in SPANS], strict=True) for b in pair][:SLICE_BITS]
    number = F.lit(0)
    for b in bits:
        number = number * 2 + b
    rows = hits.withColumn("slice", F.coalesce(number, F.lit(0)).cast("int")).withColumn("bucket", bucket_of(F.col("observationgroup")))
    order = [F.col("bucket"), F.col("slice"), F.col("observationgroup"), F.col("observationorder")]
    order += [F.col(c).asc() if up else F.col(c).desc() for c, up in CLUSTERING]
    return rows.hint("rebalance", F.col("bucket"), F.col("slice")).sortWithinPartitions(*order)


def read_hits_within(spark: SparkSession, path: str, within: dict[str, tuple[float, float]]) -> DataFrame:
    """The hits with frequency and snr (see SPANS) between two values each. Parts of which the log tells that
    they have none aren't opened.

    Both columns are in the key, so every version of a hit lies between the values or none does.
    """
    if not set(within) <= set(SPANS):
        raise ValueError(f"only {', '.join(SPANS)} can be asked for")
    stored = log.scan_parts(spark, path, STORED_HITS, log.parts_within(log.snapshot(spark, path).parts, within))
    for column, (low, high) in within.items():
        stored = stored.where(F.col(column).between(low, high))
    return conform(latest(stored.drop("bucket"), HIT_KEY, ["version"]), HITS)


def stored_semi_join(spark: SparkSession, path: str, right: DataFrame, radius: float, order: int, by: Sequence[str] = ()) -> DataFrame:
    """The stored hits of an observation that have a row of ``right`` within the radius of their frequency: the
    other side's span tells which files to read."""
    low, high = right.agg(F.min("frequency"), F.max("frequency")).first()
    if low is None:
        return read_hits(spark, path).limit(0)
    room = radius + 1e-9 * max(abs(low), abs(high))
    hits = read_hits_within(spark, path, {"frequency": (low - room, high + room)})
    return range_semi_join(hits.where(F.col("observationorder") == order), right, "frequency", radius, by=by)


def append_hits(hits: DataFrame, path: str, version: int | None = None) -> None:
    """Append hits to the table, over those of equal keys and lower versions."""
    log.append(clustered(_versioned(conform(hits, HITS), version)), path, "bucket", HIT_LOOKUPS)


def append_groups(groups: DataFrame, path: str, version: int | None = None) -> None:
    """Append group rows to the table, over those of equal groups and lower versions."""
    rows = _versioned(conform(groups, GROUPS), version)
    log.append(rows.hint("rebalance").sortWithinPartitions("observationgroup"), path, looked_up=GROUP_LOOKUPS)


def compact_hits(spark: SparkSession, path: str, curve: bool = False) -> bool:
    """Rewrites the buckets that several writes have added to, without the rows that later ones replace; with
    ``curve`` in slices by frequency and strength, whose ends the log tells (see ``read_hits_within``).

    Other buckets are not touched. Readers and appends go on meanwhile; of two compactions at once one gives
    up (False). The old files stay until ``log.vacuum``.
    """
    layout = sliced if curve else clustered
    merged = lambda rows: layout(latest(rows.drop("bucket"), HIT_KEY, ["version"], keep_version=True))
    spans, slices = (SPANS, "slice") if curve else ((), None)
    return log.rewrite(spark, path, STORED_HITS, merged, "bucket", looked_up=HIT_LOOKUPS, slices=slices, spans=spans)


def compact_groups(spark: SparkSession, path: str) -> bool:
    """The same for the group table, which is one part then."""
    merged = lambda rows: latest(rows, GROUP_KEY, ["version"], keep_version=True)
    ordered = lambda rows: merged(rows).hint("rebalance").sortWithinPartitions("observationgroup")
    return log.rewrite(spark, path, STORED_GROUPS, ordered, looked_up=GROUP_LOOKUPS)
