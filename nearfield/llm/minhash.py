"""Near-duplicate documents by an LSH forest over MinHash signatures, confirmed on whole shingle sets.

Each distinct shingle set gets TREES sorted orders of DEPTH min-hashes. In an order, the sets that share
a longest common prefix of at least BASE values are a region; a region of more than REGION_ROWS sets is
also divided by further values, so that depth follows density. Sets of one region whose whole signatures look
close enough are candidates. The candidates' connected families then meet once, with their whole sets:
an inverted index of a family's shingles gives all exact intersections, so no link inside a family is
missed. A family too large for one task is confirmed region by region instead.

Regions that were too crowded for one task meet once more, with what is linked by then: where they hold several
components still, all their sets meet part by part, and links between components are confirmed on whole sets.

Exact copies are one set from the start, so a group of copies costs no more than one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.llm.common import (
    blocks,
    components,
    fresh,
    groups_of,
    marked,
    mixed,
    skewed_join,
    texts_of,
    without,
    word_hashes,
)
from nearfield.scratch import stored

WORDS = 5
TREES, DEPTH, BASE = 16, 8, 3
HASHES = TREES * DEPTH
#: Sets in one region, and sets and shingles in one family that a task confirms, at most.
REGION_ROWS, FAMILY_SHINGLES = 4096, 4_000_000
#: Share of equal min-hashes from which two sets are candidates: more than four standard deviations
#: below a similarity of 0.75.
CANDIDATE = 0.58

_OF_WORD = np.ones(256, bool)
_OF_WORD[[32, *range(9, 14)]] = False


def _constants(n: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_XOR, _TIMES = _constants(HASHES, 11), _constants(HASHES, 23) | np.uint64(1)
def shingle_sets(column: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text of a string array without nulls.

    Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return, with
    A-Z in lower case. A text of fewer than ``words`` words has its whole sequence as one shingle, a
    text without words the empty set.
    """
    hashes, bounds = word_hashes(column, _OF_WORD)
    bounds = bounds.tolist()
    long = hashes[: max(0, len(hashes) - words + 1)].copy()
    for k in range(1, words):
        long = long * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + len(long)]
    long = mixed(long + np.uint64(words))
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        if hi - lo >= words:
            out.append(np.unique(long[lo : hi - words + 1]))
        elif hi > lo:
            value = hashes[lo : lo + 1].copy()
            for k in range(lo + 1, hi):
                value = value * np.uint64(0xD6E8FEB86659FD93) + hashes[k]
            out.append(mixed(value + np.uint64(hi - lo)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """HASHES 32-bit min-hashes of a set that isn't empty."""
    least = np.full(HASHES, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 512):
        part = (shingles[None, at : at + 512] ^ _XOR[:, None]) * _TIMES[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (mixed(least) >> np.uint64(32)).astype(np.uint32)


def set_key(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


# ---- stages


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, key and sig (null for an empty set) of every row."""
    fields = [
        docs.schema["doc_id"],
        T.StructField("text_hash", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("sig", T.BinaryType()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi in blocks(texts):
                sets = shingle_sets(texts.slice(lo, hi - lo))
                arrays = [
                    batch.column(0).slice(lo, hi - lo),
                    batch.column(2).slice(lo, hi - lo),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) for s in sets], pa.binary()),
                    pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])

    text_hash = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    return docs.select("doc_id", "text", text_hash).mapInArrow(run, T.StructType(fields))


def _prefix(tree, depth: int):
    """The first ``depth`` values of the signature in a tree's order."""
    return F.substring("sig", tree * (4 * DEPTH) + 1, F.lit(4 * depth))


def forest_regions(sets: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(tree, region, key): the sets of each region of two to ``limit`` sets; and those of the regions of BASE
    values that hold more, None if there are none.

    ``sets`` has key and sig. Starts with prefixes of BASE values. A region beyond the limit is dealt into
    parts by a hash, each with the region's first set, so that every set meets many others of the crowd,
    and is divided by one value more, so that it meets its nearest.
    """
    limit = limit or REGION_ROWS
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    rows = sets.select("key", "sig", trees).select("key", "tree", F.xxhash64(_prefix(F.col("tree"), BASE)).alias("region"))
    found, crowded = [], None
    for depth in range(BASE, DEPTH + 1):
        sizes = rows.groupBy("tree", "region").agg(F.count("*").alias("n"), F.min("key").alias("least")).where("n > 1")
        sized = stored(skewed_join(rows, sizes, ["tree", "region"]), "regions")
        found.append(sized.where(F.col("n") <= limit).select("tree", "region", "key"))
        over = sized.where(F.col("n") > limit)
        if over.isEmpty():
            break
        crowded = over.select("tree", "region", "key") if crowded is None else crowded
        part = F.pmod(F.xxhash64("key"), F.ceil(F.col("n") * 2 / limit))
        dealt = over.select("tree", F.xxhash64("region", part).alias("region"), "key", "least")
        firsts = dealt.select("tree", "region", F.col("least").alias("key"))
        found.append(dealt.select("tree", "region", "key").unionByName(firsts).distinct())
        if depth < DEPTH:
            deeper = skewed_join(over.select("key", "tree"), sets.select("key", "sig"), ["key"])
            rows = deeper.select("key", "tree", F.xxhash64(F.lit(depth), _prefix(F.col("tree"), depth + 1)).alias("region"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out, crowded


def _spanning(close, n: int, roots: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """A spanning forest of the graph in which ``close(i, others)`` tells which others i is linked to; between
    components, if ``roots`` tells what is connected already."""
    left = np.arange(n)
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            if roots is not None:
                known = roots[left] == roots[i]
                queue += left[known].tolist()
                left = left[~known]
                if not len(left):
                    continue
            linked = close(i, left)
            for k in left[linked].tolist():
                queue.append(k)
                yield i, k
            left = left[~linked]


def candidate_links(regions: DataFrame, sets: DataFrame, share: float = CANDIDATE) -> DataFrame:
    """(a, b): links that connect, in each region, the sets of which enough min-hashes are equal."""
    rows = skewed_join(regions, sets.select("key", "sig"), ["key"]).select("tree", "region", "key", "sig")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[bytes, bytes]] = []
        for group in groups_of(batches, 2):
            keys = group.column("key").to_pylist()
            sigs = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint32).reshape(-1, HASHES)

            def close(i: int, others: np.ndarray) -> np.ndarray:
                return (sigs[others] == sigs[i]).sum(axis=1) >= share * HASHES

            out += [(keys[i], keys[k]) for i, k in _spanning(close, len(keys))]
            if len(out) > 50_000:
                yield _links(out)
                out = []
        yield _links(out)

    dealt = rows.repartition("tree", "region").sortWithinPartitions("tree", "region")
    return dealt.mapInArrow(run, "a binary, b binary").distinct()


def _links(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    arrays = [pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(arrays, ["a", "b"])


def exact_links(sets: list[np.ndarray], percent: int, roots: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Links that connect the sets with 100 * intersection >= percent * union, from all exact intersections;
    those between components only, if ``roots`` tells these."""
    sizes = np.array([len(s) for s in sets])
    shingles, which = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(which, kind="stable")
    posting, starts = owner[order], np.searchsorted(which[order], np.arange(len(shingles) + 1))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    lengths = np.diff(starts)

    def close(i: int, others: np.ndarray) -> np.ndarray:
        mine = which[begins[i] : begins[i + 1]]
        n = lengths[mine]
        at = np.repeat(starts[mine] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        shared = np.bincount(posting[at], minlength=len(sets))[others]
        return 100 * shared >= percent * (sizes[i] + sizes[others] - shared)

    yield from _spanning(close, len(sets), roots)


def confirmed_links(units: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """(a, b): links inside each unit, confirmed on whole sets. ``whole`` has key and shingles (binary)."""
    rows = skewed_join(units, whole, ["key"]).select("unit", "key", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, 1):
            if group.num_rows > 1:
                keys = group.column("key").to_pylist()
                sets = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
                yield _links([(keys[i], keys[k]) for i, k in exact_links(sets, percent)])

    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a binary, b binary")


def _units(families: DataFrame, regions: DataFrame, sets: DataFrame) -> DataFrame:
    """(unit, key): what one task confirms. A family, or, if it has too many sets or shingles, its regions;
    a region of too many shingles is cut into parts, and each two parts are a unit."""
    member = skewed_join(
        families.withColumnRenamed("node", "key"), sets.select("key", F.col("n_shingles").alias("n")), ["key"]
    )
    weight = member.groupBy("root").agg(F.count("*").alias("rows"), F.sum("n").alias("weight"))
    member = stored(skewed_join(member, weight, ["root"]), "families")
    large = (F.col("rows") > REGION_ROWS) | (F.col("weight") > FAMILY_SHINGLES)
    units = member.where(~large).select(F.xxhash64(F.lit("family"), "root").alias("unit"), "key")
    if member.where(large).isEmpty():
        return units
    inside = skewed_join(regions, member.where(large).select("key", "n", "root"), ["key"])
    weights = inside.groupBy("tree", "region", "root").agg(F.count("*").alias("rows"), F.sum("n").alias("weight"))
    inside = skewed_join(inside, weights.where("rows > 1"), ["tree", "region", "root"])
    parts = F.ceil(F.col("weight") * 2 / FAMILY_SHINGLES).cast("int")
    part = F.pmod(F.xxhash64("key"), parts).cast("int")
    others = F.explode(F.sequence(F.lit(0), parts - 1))
    cut = inside.withColumn("parts", parts).withColumn("part", part).withColumn("other", others)
    pair = [F.least("part", "other"), F.greatest("part", "other")]
    return units.unionByName(cut.select(F.xxhash64("tree", "region", "root", *pair).alias("unit"), "key"))


def crowd_links(crowded: DataFrame, found: DataFrame, sets: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between different components of ``found`` (node, root) in crowded regions, confirmed on
    whole sets. A region's sets are dealt into parts, and each two parts meet in one task; regions that are of
    one component, and equal regions of several trees, don't meet again."""
    roots = found.select(F.col("node").alias("key"), "root")
    rows = skewed_join(crowded, roots, ["key"], "left").withColumn("root", F.coalesce("root", "key"))
    rows = skewed_join(rows, sets.select("key", F.col("n_shingles").alias("n")), ["key"])
    rows = stored(rows.select("tree", "region", "key", "root", "n"), "crowded")
    about = [F.count("*").alias("rows"), F.sum("n").alias("weight"), F.min("root").alias("low"), F.max("root").alias("high")]
    about += [F.sum(F.xxhash64("key").cast("decimal(20,0)")).alias("content")]
    open_ones = rows.groupBy("tree", "region").agg(*about).where("low <> high")
    first = F.min(F.struct("tree", "region")).alias("of")
    open_ones = open_ones.groupBy("rows", "weight", "low", "high", "content").agg(first).select("rows", "weight", "of.*")
    inside = skewed_join(rows, open_ones, ["tree", "region"])
    parts = F.greatest(F.ceil(F.col("rows") * 2 / REGION_ROWS), F.ceil(F.col("weight") * 2 / FAMILY_SHINGLES)).cast("int")
    others = F.explode(F.sequence(F.lit(0), parts - 1))
    cut = inside.withColumn("part", F.pmod(F.xxhash64("key"), parts).cast("int")).withColumn("other", others)
    pair = [F.least("part", "other"), F.greatest("part", "other")]
    units = cut.select(F.xxhash64("tree", "region", *pair).alias("unit"), "key", "root")
    met = skewed_join(units, whole, ["key"]).select("unit", "key", "root", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, 1):
            keys, names = group.column("key").to_pylist(), group.column("root").to_pylist()
            number = {name: k for k, name in enumerate(dict.fromkeys(names))}
            if len(number) > 1:
                values = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
                known = np.array([number[name] for name in names])
                yield _links([(keys[i], keys[k]) for i, k in exact_links(values, percent, known)])

    return met.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a binary, b binary")


def whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """key and shingles of the documents whose doc_id is among those of ``wanted`` (and of a few others)."""
    mark = fresh(docs.select("doc_id", "text"), "_wanted")
    held = marked(docs.select("doc_id", "text"), wanted, {"doc_id": "doc_id"}, mark).where(mark).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(0))
            for lo, hi in blocks(texts):
                sets = [s for s in shingle_sets(texts.slice(lo, hi - lo)) if len(s)]
                arrays = [pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "shingles"])

    return held.mapInArrow(run, "key binary, shingles binary")


def _decided(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id of every row."""
    signed = stored(_signed(docs), "signed")
    sets = stored(
        signed.where("key is not null")
        .groupBy("key")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")),
        "sets",
    )
    regions, crowded = forest_regions(sets)
    regions = stored(regions, "forest")
    families = components(candidate_links(regions, sets))
    units = stored(_units(families, regions, sets), "units")
    wanted = skewed_join(families.select(F.col("node").alias("key")), sets.select("key", "rep"), ["key"])
    whole = whole_sets(docs, wanted.select(F.col("rep").alias("doc_id"))).dropDuplicates(["key"])
    found = components(confirmed_links(units, whole, percent))
    if crowded is not None:
        nodes = crowded.select("key").distinct()
        held = skewed_join(nodes, sets.select("key", "rep"), ["key"]).select(F.col("rep").alias("doc_id"))
        all_whole = whole_sets(docs, stored(held, "wanted")).dropDuplicates(["key"])
        more = stored(crowd_links(crowded, found, sets, all_whole, percent), "links")
        if not more.isEmpty():
            found = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    found = found.withColumnRenamed("node", "key")
    reps = skewed_join(found, sets.select("key", "rep"), ["key"])
    least = reps.groupBy("root").agg(F.min("rep").alias("component_id"))
    reached = skewed_join(reps, least, ["root"]).select("key", "component_id")
    named = sets.select("key", "rep").join(reached, "key", "left")
    named = named.select("key", F.coalesce("component_id", "rep").alias("component_id"))
    joined = skewed_join(signed.select("doc_id", "text_hash", "n_shingles", "key"), named, ["key"], "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"))


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of doc_id, text.

    Documents with 100 * intersection >= percent * union of their shingle sets are linked; component_id is
    the smallest doc_id that links reach, itself included, and kept tells whether it is the row's own.
    Null and empty texts, and texts without words, are linked with nothing. Repeated rows are kept or
    dropped alike; rows of one doc_id with different texts are documents of their own.
    """
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return _decided(docs, percent).select("doc_id", "n_shingles", "component_id", kept)


def deduplicated(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``near_duplicates`` keeps.

    Of rows with equal doc_id and text one stays. A null doc_id stays only if its group has no other.
    """
    decided = stored(_decided(docs, percent), "decided")
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    row = [F.col("doc_id"), F.col("text_hash")]
    dropped = decided.where(~kept).select(*row)
    repeated = decided.where(kept).groupBy(*row).count().where("count > 1").select(*row)
    hashed = docs.withColumn(name := fresh(docs, "text_hash"), F.xxhash64(F.coalesce("text", F.lit(""))))
    keys = {"doc_id": "doc_id", name: "text_hash"}
    out = without(hashed, dropped.unionByName(repeated), keys)
    if not repeated.isEmpty():
        again = hashed.join(repeated.withColumnRenamed("doc_id", "_id").withColumnRenamed("text_hash", "_hash"),
                            F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col(name) == F.col("_hash")), "left_semi")
        out = out.unionByName(again.dropDuplicates(["doc_id", name]))
    return out.drop(name)
