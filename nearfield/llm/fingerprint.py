"""Document fingerprints by Order MinHash, which are sensitive to the order of a text's parts.

Each occurrence of a k-mer counts as an element of its own (k-mer, how many before it). All elements are
placed on a circle by one hash; slot j of the fingerprint selects the elements that come first from the
j-th of SLOTS equally spaced points on, that is, the smallest under the j-th rotation of one random order.
The selected k-mers are put back in the order of the text and hashed as a tuple. Equal slots of two
texts thus need equal k-mers in equal order, and their share estimates closeness in edit distance.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.llm.common import mixed
from nearfield.scratch import stored

SLOTS, PICKS, KMER = 128, 2, 6
_ARC = np.uint64(64 - int(SLOTS).bit_length() + 1)
_STARTS = np.arange(SLOTS, dtype=np.uint64) << _ARC
#: Documents of a part of the order, about, and parts at most: the driver holds the first key of each.
ROWS_PER_PART, MAX_PARTS = 4000, 20_000


def fingerprint(text: str) -> np.ndarray:
    """SLOTS 16-bit values. A text of fewer than KMER characters counts as one k-mer."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(points) < KMER:
        points = np.concatenate([points, np.full(KMER - len(points), 0x110000, np.uint64)])
    n = len(points) - KMER + 1
    kmers = points[:n].copy()
    for k in range(1, KMER):
        kmers *= np.uint64(0x9E3779B97F4A7C15)
        kmers += points[k : k + n]
    kmers = mixed(kmers)
    # number equal k-mers by place: sort (hash, place) packed into one integer
    width = np.uint64(max(1, int(n - 1).bit_length()))
    low = (np.uint64(1) << width) - np.uint64(1)
    packed = np.sort((kmers & ~low) | np.arange(n, dtype=np.uint64))
    place, grouped = packed & low, packed >> width
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(grouped[1:], grouped[:-1], out=new[1:])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    earlier = (np.arange(n) - first).astype(np.uint64)
    place = place.astype(np.int64)
    elements = mixed(kmers[place] + earlier * np.uint64(0xD6E8FEB86659FD93))
    if n > 64 * SLOTS:  # the few candidates of each slot: those below a bound that leaves enough in each
        order = _nearest(elements)
    else:
        order = np.argsort(elements)
    ring = elements[order]
    at = np.searchsorted(ring, _STARTS)
    chosen = order[(at[:, None] + np.arange(min(PICKS, n))) % len(ring)]
    in_text = np.sort(place[chosen], axis=1)
    tuples = np.zeros(SLOTS, np.uint64)
    for k in range(in_text.shape[1]):
        tuples = mixed(tuples + kmers[in_text[:, k]] + np.uint64(k + 1))
    return (tuples >> np.uint64(48)).astype(np.uint16)


def _nearest(elements: np.ndarray) -> np.ndarray:
    """Indices, in order, of elements that include the first PICKS of each slot: with many elements only the
    low part of each slot's arc is sorted."""
    arc = 1 << int(_ARC)
    low = np.flatnonzero((elements & np.uint64(arc - 1)) < np.uint64(arc // (len(elements) // (16 * SLOTS))))
    if np.bincount((elements[low] >> _ARC).astype(np.int64), minlength=SLOTS).min() < PICKS:
        return np.argsort(elements)
    return low[np.argsort(elements[low])]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal slots, 0 to 1."""
    return float(np.count_nonzero(a == b)) / SLOTS


def as_text(prints: np.ndarray) -> str:
    return prints.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as many characters of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_neighbours(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (part, ahead, id, text) such that in each part, ordered by ``ahead`` and descending id, every row
    with ``ahead`` 0 is followed by the next row of the whole table (the last one by the first).

    Only ids are sorted as a whole; the texts are shuffled once. Where a part ends, the row that follows
    is sent there, too, as ``ahead`` 1. Equal ids are in order of the text's hash; null ids come last.
    """
    spark = docs.sparkSession
    order = [F.col("id").desc_nulls_last(), F.col("tie")]
    rows = docs.select(F.col(id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    keyed = rows.withColumn("tie", F.xxhash64("text"))
    keys = keyed.select("id", "tie")
    n = keys.count()
    parts = min(MAX_PARTS, max(1, round(n / ROWS_PER_PART)))
    ranged = stored(keys.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), "order")
    # one row for each part: its first key, which the part before needs as well
    firsts = (
        ranged.groupBy("range")
        .agg(F.min(F.struct(F.coalesce(F.bitwise_not("id"), F.lit(2**63 - 1)).alias("down"), "tie")).alias("first"))
        .select("range", "first.down", "first.tie")
        .orderBy("range")
        .collect()
    )
    bounds = [(r["down"], r["tie"]) for r in firsts]
    last = max(0, len(bounds) - 1)
    fields = [
        T.StructField("part", T.IntegerType()),
        T.StructField("ahead", T.IntegerType()),
        T.StructField("id", docs.schema[id].dataType),
        T.StructField("tie", T.LongType()),
        T.StructField("text", T.StringType()),
    ]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            ids, ties = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            at, part, ahead = [], [], []
            for k, (i, tie) in enumerate(zip(ids, ties, strict=True)):
                key = (2**63 - 1 if i is None else ~i, tie)
                own = max(0, bisect_right(bounds, key) - 1)
                at.append(k)
                part.append(own)
                ahead.append(0)
                if bounds[own] == key and own not in sent:  # equal rows are sent once by each task
                    sent.add(own)
                    at.append(k)
                    part.append(own - 1 if own else last)
                    ahead.append(1)
            rows = batch.take(pa.array(at, pa.int64()))
            out = [pa.array(part, pa.int32()), pa.array(ahead, pa.int32()), rows.column(0), rows.column(2), rows.column(1)]
            yield pa.RecordBatch.from_arrays(out, [f.name for f in fields])

    dealt = keyed.select("id", "text", "tie").mapInArrow(deal, T.StructType(fields))
    spread = max(1, min(parts, max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts // 8)))
    return dealt.repartition(spread, "part").sortWithinPartitions("part", "ahead", *order)


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row.

    The next row is that of the next smaller id (after the smallest: the largest). Null texts are empty.
    The fingerprints are SLOTS 16-bit numbers in hexadecimal. A table of one row is its own next.
    """
    fields = [
        docs.schema[id],
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # (part, ahead, id, text, fingerprint) of the row before
        for batch in batches:
            out = []
            columns = [batch.column(k).to_pylist() for k in (0, 1, 2, 4)]
            for row in zip(*columns, strict=True):
                own = fingerprint(row[3])
                if before and before[0] == row[0] and before[1] == 0:
                    _, _, of, text, prints = before
                    changed = edited(text, row[3])
                    after = fingerprint(changed)
                    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((of, len(text), digest, as_text(prints), as_text(after), likeness(prints, after), likeness(prints, own)))
                before = (*row, own)
            names = [f.name for f in fields]
            ids = pa.array([r[0] for r in out], batch.schema.field("id").type)
            types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            rest = [pa.array([r[k] for r in out], t) for k, t in enumerate(types, 1)]
            yield pa.RecordBatch.from_arrays([ids, *rest], names)

    return with_neighbours(docs, id, text).mapInArrow(run, T.StructType(fields))
