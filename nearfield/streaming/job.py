"""The streaming job: parse, store, and report each group once it is complete.

A group is closed when a higher group id has been seen; a late hit of a closed group has it reported again.
All state is in tables with commit logs (``sources.log``). A batch commits to each table once, under its id, so
a batch that is run again after a failure adds nothing twice, wherever it was cut off, and readers and
compaction go on beside it.

What detection needs of a group is kept up to date instead of being read anew: its anchor hits, and per
frequency cell the extremes of its other hits, which merge by minimum and maximum. A batch reads its own hits
and, of the groups that it closes, the anchors and extremes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from nearfield.functions.records import bad_messages, good_hits, parse_hits
from nearfield.operators.upsert import latest
from nearfield.plans import detect
from nearfield.plans.detect import GROUP, STREAM_RULE, Rule
from nearfield.schema import GROUP_KEY, GROUPS, HIT_KEY, HITS
from nearfield.sources import log
from nearfield.sources.tables import BUCKET, GROUP_LOOKUPS, HIT_LOOKUPS, bucket_of, clustered, conform

_BATCH = T.StructField("batch_id", T.LongType())
_VERSION = T.StructField("version", T.LongType())
_ORIGIN = [T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())]
STORED_HITS = T.StructType([*HITS.fields, *_ORIGIN, _BATCH, BUCKET])
STORED_GROUPS = T.StructType([*GROUPS.fields, _BATCH, _VERSION])
REJECTS = T.StructType([T.StructField("value", T.StringType()), T.StructField("reason", T.StringType()), _BATCH])
ANCHORS = T.StructType([*HITS.fields, BUCKET])
#: Offsets are comparable within a topic and partition only; between those any fixed order will do.
VERSION = ["batch_id", "topic", "partition", "offset"]
#: The name under which the job commits its batches.
WRITER = "batches"
#: Compaction leaves replaced files to their readers for so many seconds.
UNUSED_FOR = 24 * 3600.0


@dataclass(frozen=True)
class Tables:
    """Folders of the job's tables."""

    root: str

    def of(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"

    def anchors(self, rule: Rule) -> str:
        return self.of(f"anchors_{_digest(rule)}")

    def states(self, rule: Rule) -> list[str]:
        """A table for each summary of the rule."""
        return [self.of(f"state_{_digest(rule)}_{k}") for k in range(len(detect.steps(rule)))]


def _digest(rule: Rule) -> str:
    return hashlib.sha256(repr(rule).encode()).hexdigest()[:12]


def _buckets(groups: DataFrame) -> list[int]:
    """The folders of some groups; as many as there are, at most."""
    return [r[0] for r in groups.select(bucket_of(F.col(GROUP))).distinct().collect()]


def _of_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return rows.join(groups.select(GROUP).distinct(), GROUP, "left_semi").select(*rows.columns)


def read_stored_hits(spark: SparkSession, root: str, groups: DataFrame | None = None) -> DataFrame:
    """Stored hits, repeated keys resolved; of the groups in ``groups`` only, if given: their folders."""
    rows = log.scan(spark, Tables(root).of("hits"), STORED_HITS)
    if groups is not None:
        rows = _of_groups(rows.where(F.col("bucket").isin(_buckets(groups))), groups)
    return conform(latest(rows.drop("bucket"), HIT_KEY, VERSION), HITS)


def read_reports(spark: SparkSession, root: str) -> DataFrame:
    """All reports of groups that compaction has left, with their batch and version."""
    return log.scan(spark, Tables(root).of("groups"), STORED_GROUPS)


def read_results(spark: SparkSession, root: str) -> DataFrame:
    """The latest result of every reported group."""
    return conform(latest(read_reports(spark, root).drop("batch_id"), GROUP_KEY, ["version"]), GROUPS)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Messages that could not be parsed."""
    return log.scan(spark, Tables(root).of("rejects"), REJECTS)


def batch_counts(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, hits, rejects, groups) of every batch: messages stored and kept aside, groups reported.

    The counts were observed on the batch's own writes.
    """
    reported = {c["batch"]: c["note"]["groups"] for c in log.commits(spark, Tables(root).of("groups")) if c["writer"]}
    rows = [
        (c["batch"], c["note"]["hits"], c["note"]["rejects"], reported.get(c["batch"], 0))
        for c in log.commits(spark, Tables(root).of("hits"))
        if c["writer"]
    ]
    return spark.createDataFrame(rows, "batch_id bigint, hits bigint, rejects bigint, groups bigint")


# ---- a batch


def _observed(seen: Observation, rows: DataFrame, metrics: Sequence[Column]) -> dict:
    """The values observed while ``rows`` were written; if the plan turned out empty beyond the observation,
    which drops that as well, they are counted by a job of their own."""
    try:
        found = seen.get
    except Py4JJavaError:
        found = {}
    return found or rows.agg(*metrics).first().asDict()


def _store(messages: DataFrame, batch_id: int, tables: Tables) -> dict:
    """Stores the hits of a batch, and what could not be parsed, and returns the note of its commit."""
    spark, hits = messages.sparkSession, tables.of("hits")
    now = log.snapshot(spark, hits)
    if now.batch(WRITER) < batch_id:
        origin = [F.col(f.name) if f.name in messages.columns else F.lit(None) for f in _ORIGIN]
        shaped = messages.select("value", *[c.cast(f.dataType).alias(f.name) for c, f in zip(origin, _ORIGIN, strict=True)])
        parsed, seen = parse_hits(shaped), Observation()
        good = F.when(F.col("reason").isNull(), F.col(GROUP))
        metrics = [F.min(good).alias("low"), F.max(good).alias("high"), F.count(good).alias("hits"), F.count("reason").alias("rejects")]
        rows = good_hits(parsed.observe(seen, *metrics), *[f.name for f in _ORIGIN])
        parts = log.write(clustered(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))), hits, "bucket", HIT_LOOKUPS)
        note = _observed(seen, parsed, metrics)
        if note["rejects"]:
            aside = bad_messages(parsed).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            log.append(aside, tables.of("rejects"), writer=WRITER, batch=batch_id)
        before = now.writers.get(WRITER, {})
        note |= {"previous": now.batch(WRITER), "last": before.get("top")}
        note["top"] = max((g for g in (note["last"], note["high"]) if g is not None), default=None)
        log.commit(spark, hits, [p | {"batch": batch_id} for p in parts], writer=WRITER, batch=batch_id, note=note)
    return log.snapshot(spark, hits).writers[WRITER]


def _batch_hits(spark: SparkSession, tables: Tables, batch_id: int | None) -> DataFrame:
    """The hits that a batch has stored, or all."""
    parts = log.snapshot(spark, tables.of("hits")).parts
    own = {p: about for p, about in parts.items() if batch_id is None or about.get("batch") == batch_id}
    return log.scan_parts(spark, tables.of("hits"), STORED_HITS, own)


def _in_buckets(rows: DataFrame, *order: str) -> DataFrame:
    placed = rows.withColumn("bucket", bucket_of(F.col(GROUP)))
    return placed.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", GROUP, *order)


def _keep_state(spark: SparkSession, tables: Tables, batch_id: int, previous: int, rule: Rule) -> None:
    """Adds a batch's hits to the rule's state; a rule that the tables have no state of yet gets all hits."""
    anchors, states = tables.anchors(rule), tables.states(rule)

    def add(path: str, rows: Callable[[DataFrame], DataFrame], *order: str) -> None:
        have = log.snapshot(spark, path).batch(WRITER)
        if have < batch_id:
            hits = _batch_hits(spark, tables, batch_id if have == previous else None)
            log.append(_in_buckets(rows(hits.select(*HITS.names)), *order), path, "bucket", writer=WRITER, batch=batch_id)

    add(anchors, lambda hits: detect.anchors_of(hits, rule), "frequency")
    for k, path in enumerate(states):
        add(path, lambda hits, k=k: detect.summaries(hits, rule)[k], detect.CELL)


def _state_schema(spark: SparkSession, rule: Rule) -> list[T.StructType]:
    empty = spark.createDataFrame([], HITS)
    return [T.StructType([*s.schema.fields, BUCKET]) for s in detect.summaries(empty, rule)]


def _closed_groups(hits: DataFrame, note: dict, compat: bool) -> DataFrame | None:
    """Groups to report after a batch whose ids run from ``low`` to ``high`` (None if it has no hits);
    ``last`` is the highest id before it. None if there are none."""
    spark, ids = hits.sparkSession, T.StructType([HITS[GROUP]])
    low, high, last, top = (note[k] for k in ("low", "high", "last", "top"))
    if compat:
        return spark.createDataFrame([(low,)], ids) if low is not None and low < high else None
    opened = spark.createDataFrame([(last,)], ids) if last is not None and last < top else None
    if low is None or low == top:
        return opened
    late = hits.where(F.col(GROUP) < top).select(GROUP)
    return (late if opened is None else late.unionByName(opened)).distinct()


def _results(spark: SparkSession, tables: Tables, closed: DataFrame, rule: Rule, metadata: DataFrame | None) -> DataFrame:
    """Result rows of the closed groups: from the rule's state, or from their stored hits if there is none."""
    paths = [tables.anchors(rule), *tables.states(rule)]
    newest = log.snapshot(spark, tables.of("hits")).batch(WRITER)
    if any(log.snapshot(spark, path).batch(WRITER) != newest for path in paths):
        hits = read_stored_hits(spark, tables.root, closed)
        return detect.group_results(hits, rule, metadata, closed)
    buckets = _buckets(closed)

    def of(path: str, schema: T.StructType) -> DataFrame:
        return _of_groups(log.scan(spark, path, schema, buckets=buckets).drop("bucket"), closed)

    anchors = of(paths[0], ANCHORS).dropDuplicates(HIT_KEY)
    found = [detect.merged(of(path, schema)) for path, schema in zip(paths[1:], _state_schema(spark, rule), strict=True)]
    return detect.counted_results(detect.anomalies_by_summary(anchors, found, rule), closed, metadata)


def _report(
    spark: SparkSession, root: str, closed: DataFrame, rule: Rule, metadata: DataFrame | None, batch_id: int, flushed: bool
) -> None:
    """Commits the results of the closed groups; their version is the commit's number."""
    tables, path = Tables(root), Tables(root).of("groups")
    results = _results(spark, tables, closed, rule, metadata)
    while True:
        now = log.snapshot(spark, path)
        if not flushed and now.batch(WRITER) >= batch_id:
            return
        seen, number, metrics = Observation(), now.number + 1, [F.count(F.lit(1)).alias("groups")]
        versioned = results.withColumns({"batch_id": F.lit(batch_id).cast("bigint"), "version": F.lit(number).cast("bigint")})
        parts = log.write(versioned.observe(seen, *metrics), path, looked_up=GROUP_LOOKUPS)
        about = {"writer": None if flushed else WRITER, "batch": batch_id, "note": _observed(seen, results, metrics)}
        try:
            log.commit(spark, path, parts, expected=now.number, **about)
            return
        except log.Conflict:  # another commit took the number
            continue


def process_batch(
    messages: DataFrame,
    batch_id: int,
    root: str,
    rule: Rule = STREAM_RULE,
    metadata: DataFrame | None = None,
    compat: bool = False,
    compact_every: int | None = None,
) -> None:
    """Store the hits of one batch and report the groups it closes."""
    spark, tables = messages.sparkSession, Tables(root)
    note = _store(messages, batch_id, tables)
    if note["batch"] == batch_id:  # else it is an old batch, which is complete
        _keep_state(spark, tables, batch_id, note["previous"], rule)
        closed = _closed_groups(_batch_hits(spark, tables, batch_id), note, compat)
        if closed is not None:
            _report(spark, root, closed, rule, metadata, batch_id, False)
    if compact_every and (batch_id + 1) % compact_every == 0:
        compact(spark, root, rule)


def flush(spark: SparkSession, root: str, rule: Rule = STREAM_RULE, metadata: DataFrame | None = None) -> None:
    """Report the group that is still open, over any earlier report of it. Hits that come later have it
    reported again."""
    note = log.snapshot(spark, Tables(root).of("hits")).writers.get(WRITER)
    if note and note["top"] is not None:
        closed = spark.createDataFrame([(note["top"],)], T.StructType([HITS[GROUP]]))
        _report(spark, root, closed, rule, metadata, note["batch"], True)


def compact(spark: SparkSession, root: str, rule: Rule = STREAM_RULE, unused_for: float = UNUSED_FOR) -> None:
    """Merges what the batches have written since the last compaction, bucket by bucket, without the rows that
    later ones replace, and removes files that have been unused for ``unused_for`` seconds.

    Readers and batches may go on meanwhile; the hits of the last batch are left alone, as a batch that was
    cut off and is run again reads its own.
    """
    tables = Tables(root)
    newest = log.snapshot(spark, tables.of("hits")).batch(WRITER)
    hits = lambda rows: clustered(latest(rows.drop("bucket"), HIT_KEY, VERSION, keep_version=True))
    reports = lambda rows: latest(rows, GROUP_KEY, ["version"], keep_version=True)
    log.rewrite(spark, tables.of("hits"), STORED_HITS, hits, "bucket", newest, HIT_LOOKUPS)
    ordered = lambda rows: reports(rows).hint("rebalance").sortWithinPartitions(GROUP)
    log.rewrite(spark, tables.of("groups"), STORED_GROUPS, ordered, looked_up=GROUP_LOOKUPS)
    log.rewrite(spark, tables.of("rejects"), REJECTS, lambda rows: rows.hint("rebalance"))
    anchors = lambda rows: _in_buckets(rows.drop("bucket").dropDuplicates(HIT_KEY), "frequency")
    log.rewrite(spark, tables.anchors(rule), ANCHORS, anchors, "bucket")
    for path, schema in zip(tables.states(rule), _state_schema(spark, rule), strict=True):
        log.rewrite(spark, path, schema, lambda rows: _in_buckets(detect.merged(rows.drop("bucket")), detect.CELL), "bucket")
    for path in [*map(tables.of, ("hits", "groups", "rejects")), tables.anchors(rule), *tables.states(rule)]:
        log.vacuum(spark, path, unused_for)


# ---- changes of the results

CHANGES = T.StructType([_VERSION, T.StructField("change", T.StringType()), *GROUPS.fields])


def changes(spark: SparkSession, root: str, after: int = -1, upto: int | None = None) -> DataFrame:
    """What the commits to the group table after ``after`` changed among the groups with anomalous hits.

    (version, change, the group's columns): ``insert`` for a group that had none before, ``update`` for one
    whose report changed, ``delete`` for one whose anomalous hits are gone, with its new report. Reports that
    say the same again, and compactions, change nothing. The commits' files must not have been removed yet
    (see ``compact``); a reader that is further behind starts from ``read_results``.
    """
    path = Tables(root).of("groups")
    made = [c for c in log.commits(spark, path, after) if (upto is None or c["number"] <= upto) and c["kind"] == "append"]
    parts = {a["path"]: {"bucket": a["bucket"]} for c in made for a in c["add"]}
    rows = log.scan_parts(spark, path, STORED_GROUPS, parts).drop("batch_id").withColumn("__new", F.lit(True))
    if after >= 0:
        known = latest(log.scan(spark, path, STORED_GROUPS, log.snapshot(spark, path, after)).drop("batch_id"), GROUP_KEY, ["version"], keep_version=True)
        rows = rows.unionByName(_of_groups(known, rows).withColumn("__new", F.lit(False)))
    content = F.struct(*[n for n in GROUPS.names if n != GROUP])
    before = F.lag(content).over(Window.partitionBy(GROUP).orderBy("version"))
    shown, was = F.col("grouphit") > 0, F.coalesce(F.col("__before.grouphit") > 0, F.lit(False))
    change = (
        F.when(shown & ~was, "insert")
        .when(shown & ~content.eqNullSafe(F.col("__before")), "update")
        .when(~shown & was, "delete")
    )
    told = rows.withColumn("__before", before).where("__new").withColumn("change", change)
    return conform(told.where(F.col("change").isNotNull()), CHANGES)


def replayed(feed: DataFrame) -> DataFrame:
    """The anomalous groups that a whole feed of changes leaves."""
    last = latest(feed, GROUP_KEY, ["version"], keep_version=True)
    return conform(last.where(F.col("change") != "delete"), GROUPS)


def _runs(numbers: Sequence[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for n in sorted(numbers):
        if out and n == out[-1][1] + 1:
            out[-1] = (out[-1][0], n)
        else:
            out.append((n, n))
    return out


def follow(
    spark: SparkSession,
    root: str,
    handle: Callable[[DataFrame, int], None],
    every: str = "60 seconds",
    available_now: bool = False,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """A stream of the changes (see ``changes``): ``handle`` is given those of each batch and the batch's id.

    The stream's source is the group table's log, so that each commit is handled once; like any batch, one
    that failed is given to ``handle`` again under the same id.
    """
    path = f"{Tables(root).of('groups')}/log"
    store, place = log._store(spark, path)
    store.mkdirs(place)
    made = spark.readStream.schema("number bigint").option("pathGlobFilter", "*.json").json(path)

    def tell(batch: DataFrame, batch_id: int) -> None:
        numbers = [r[0] for r in batch.select("number").collect()]  # commits since the last batch
        found = [changes(batch.sparkSession, root, first - 1, last) for first, last in _runs(numbers)]
        for k, part in enumerate(found[1:]):
            found[0] = found[0].unionByName(part)
        if found:
            handle(found[0], batch_id)

    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    writer = made.writeStream.foreachBatch(tell).option("checkpointLocation", checkpoint or f"{root}/feed_checkpoint")
    return writer.trigger(**trigger).start()


def write_feed(spark: SparkSession, root: str, available_now: bool = False, every: str = "60 seconds") -> StreamingQuery:
    """Follows the changes into the table ``feed``, each once."""

    def store(found: DataFrame, batch_id: int) -> None:
        log.append(found, Tables(root).of("feed"), writer="feed", batch=batch_id)

    return follow(spark, root, store, every, available_now)


def read_feed(spark: SparkSession, root: str) -> DataFrame:
    """The changes that ``write_feed`` has stored."""
    return log.scan(spark, Tables(root).of("feed"), CHANGES)


# ---- running


def start(
    messages: DataFrame,
    root: str,
    rule: Rule = STREAM_RULE,
    metadata: DataFrame | None = None,
    compat: bool = False,
    every: str = "60 seconds",
    available_now: bool = False,
    checkpoint: str | None = None,
    compact_every: int | None = 100,
) -> StreamingQuery:
    """Start the job on a stream with a ``value`` column (and, from Kafka, topic, partition and offset).

    ``compat`` reports only the smallest group of a batch, and only if the batch holds several.
    ``available_now`` handles what is there and ends, instead of a batch ``every`` interval.
    ``compact_every`` so many batches the tables are merged.
    """
    tables = Tables(root)
    handle: Callable[[DataFrame, int], None] = lambda batch, batch_id: process_batch(
        batch, batch_id, root, rule, metadata, compat, compact_every
    )
    writer = messages.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint or tables.checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def run_available(messages: DataFrame, root: str, rule: Rule = STREAM_RULE, metadata: DataFrame | None = None) -> None:
    """Handle all messages that are there, then report the group still open."""
    start(messages, root, rule, metadata, available_now=True).awaitTermination()
    flush(messages.sparkSession, root, rule, metadata)
