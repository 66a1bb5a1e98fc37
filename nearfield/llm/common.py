"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nearfield.scratch import stored

#: Characters that an operator handles at once inside a task (a longer text is handled alone).
BLOCK_CHARS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def texts_of(column: pa.Array) -> pa.Array:
    """Strings without nulls; a null is the empty text."""
    return pc.fill_null(column, "")


def blocks(column: pa.Array, limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text each."""
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    start, n = 0, len(column)
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start = stop


def utf8_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without nulls; the offsets start at 0."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def joined_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row and the offsets of each."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return points, np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit integers (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 2**64)
#: Bytes of text that are hashed at once.
_PART = 1 << 18


def _powers(base: int, n: int, known: dict[int, np.ndarray] = {}) -> np.ndarray:  # noqa: B006
    """The first ``n`` powers of an odd number modulo 2 ** 64, kept for the next call."""
    have = known.get(base, np.ones(1, np.uint64))
    while len(have) < n:
        have = np.concatenate([have, have * (have[-1:] * np.uint64(base))])
    known[base] = have if len(have) <= 8 * _PART else have[: 8 * _PART]
    return have[:n]


def word_hashes(column: pa.Array, of_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a string array without nulls, A-Z as lower case, and where each text's
    words begin and end. ``of_word``: for each byte whether words consist of it.

    A word's hash is a polynomial in its bytes, taken as a difference of running sums.
    """
    raw, offsets = utf8_of(column)
    word = of_word[raw]
    # a text's first byte begins a word even if the text before ends with one
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    new, last = word.copy(), word.copy()
    new[1:] &= ~word[:-1] | cut[1:-1]
    last[:-1] &= ~word[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(new), np.flatnonzero(last) + 1
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # in parts that end with a word
        lo = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, lo + _PART, side="right")))
        n = int(ends[stop - 1] - lo)
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum((_LOWER[raw[lo : lo + n]].astype(np.uint64) + np.uint64(1)) * _powers(_ODD, n), out=sums[1:])
        some = slice(at, stop)
        out[some] = (sums[ends[some] - lo] - sums[starts[some] - lo]) * _powers(_INVERSE, n)[starts[some] - lo]
        at = stop
    return mixed(out), np.searchsorted(starts, offsets)


def skewed_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join of a left side with hot keys and a right side that has few rows for each key.

    The right side usually is an aggregate by ``keys``. Adaptive execution splits a hot partition only
    where both sides come straight from a shuffle made for the join, so the join gets one more key,
    a hash of the others, which no earlier partitioning matches.
    """
    extra = "_join_hash"
    with_hash = lambda df: df.withColumn(extra, F.xxhash64(*keys))
    return with_hash(left).join(with_hash(right), [*keys, extra], how).drop(extra)


def groups_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of the rows with equal values in the first ``keys`` columns, which must lie together."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        new = np.zeros(n, bool)
        for k in range(keys):
            column = batch.column(k)
            new[1:] |= pc.fill_null(pc.not_equal(column[1:], column[:-1]), True).to_numpy(zero_copy_only=False)
        starts = [0, *np.flatnonzero(new).tolist(), n]
        first = [batch.column(k)[0].as_py() for k in range(keys)]
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            if lo and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
        last = [batch.column(k)[n - 1].as_py() for k in range(keys)]
    if held:
        yield pa.Table.from_batches(held)


def components(links: DataFrame) -> DataFrame:
    """The connected components of a graph: (node, root) for every node of the links (a, b), where root
    is the component's smallest node.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each links the neighbours of a
    node to its smallest neighbour, until every node is linked to its root alone. Links stay distributed;
    a node of very many links is aggregated before it is shuffled.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, before = _stored_links(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = skewed_join(both, least, ["u"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = skewed_join(large, least, ["u"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links, now = _stored_links(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        # stars that nothing changes any more: each node has one link, to a node that has none further
        if before == now:
            break
        before = now
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stored(links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots), "components")


def _stored_links(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links written to a table, and a summary of them that is observed on the way."""
    parts = F.xxhash64("u", "v")
    low, high = F.sum(parts.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(parts, 32))
    metrics, seen = [F.count(F.lit(1)).alias("n"), low.alias("low"), high.alias("high")], Observation()
    out = stored(links.observe(seen, *metrics), "links")
    try:
        found = seen.get
    except Py4JJavaError:  # a plan that turns out empty loses its observation
        found = {}
    return out, tuple((found or out.agg(*metrics).first().asDict())[m] for m in ("n", "low", "high"))


#: Bits of a map of row hashes (8 MB).
MAP_BITS = 26


def map_place(keys: list[str]) -> Column:
    """A row's bit in a map of 2 ** MAP_BITS bits."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << MAP_BITS))


def _bitmaps(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(_part, _bits): the map's non-empty parts of 4 KB, at most 2048."""
    place = map_place(keys) + 1
    return rows.groupBy(F.bitmap_bucket_number(place).alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")
    )


def marked(df: DataFrame, rows: DataFrame, keys: dict[str, str], name: str = "_set") -> DataFrame:
    """``df`` with a column telling whether its row may be among ``rows``, by equal keys (its column: that
    of ``rows``); false is sure. Nothing of ``df`` is shuffled. ``rows`` should be a stored table."""
    place, part, bits, byte = (fresh(df, n) for n in ("_place", "_part", "_bits", "_byte"))
    # at most 2048 parts of 4 KB
    maps = F.broadcast(_bitmaps(rows, list(keys.values())).toDF(part, bits))
    placed = df.withColumn(place, map_place(list(keys)))
    joined = placed.join(maps, F.bitmap_bucket_number(F.col(place) + 1) == F.col(part), "left")
    wanted = F.substring(bits, F.shiftright(place, 3) % 4096 + 1, F.lit(1))
    read = joined.withColumn(byte, F.conv(F.hex(wanted), 16, 10).cast("int"))
    bit = F.expr(f"shiftright({byte}, cast({place} % 8 AS INT)) & 1") == 1
    return read.select(*df.columns, F.coalesce(bit, F.lit(False)).alias(name))


def without(df: DataFrame, dropped: DataFrame, keys: dict[str, str]) -> DataFrame:
    """The rows of ``df`` whose keys (its column: that of ``dropped``) are not among ``dropped``; nulls are equal.

    Most rows pass by a map of hashes, without a shuffle; only the dropped and a few others are joined.
    ``dropped`` should be a stored table.
    """
    seen = marked(df, dropped, keys, mark := fresh(df, "_set"))
    names = [fresh(df, f"_drop{k}") for k in range(len(keys))]
    named = dropped.select(*keys.values()).toDF(*names).distinct()
    same = None
    for own, theirs in zip(keys, names, strict=True):
        test = F.col(own).eqNullSafe(F.col(theirs))
        same = test if same is None else same & test
    sure, maybe = seen.where(~F.col(mark)).drop(mark), seen.where(F.col(mark)).drop(mark)
    return sure.unionByName(maybe.join(named, same, "left_anti"))
