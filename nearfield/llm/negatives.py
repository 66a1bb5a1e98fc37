"""Hard-negative mining by exact integer products in a residue number system.

Vectors are rounded to integers. A task multiplies a block of anchors with a block of rows modulo several
small primes: residues are at most 510 in size, so 64 products of them add up exactly in float32, and the
machine's fast float32 product can be used. From the residues of a score under all primes, Chinese
remaindering (by mixed-radix digits) gives the exact signed score. The number of primes follows from the
longest vector.

Two passes: the first meets anchors with the rows of their label and finds the positives, the second meets
them with all rows and selects, for each positive, the best negatives within a window below its score. Rows
and anchors are dealt into blocks by hash, block meets block, and a block keeps a few rows for each anchor; a
window over these gives the result. No block grows with the data or with a label's share of it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.scratch import stored

#: Rows and anchors of a block at most, about, and rows at least as long as there are few blocks.
ROWS, ANCHORS, FEW_ROWS, FEW_BLOCKS = 65_536, 16_384, 2_048, 64
#: Anchors and rows that are multiplied at once.
TILE = (256, 8_192)
#: Components that can be multiplied exactly at once in float32, and the largest prime this holds for.
DEPTH, LARGEST = 64, 1021
#: The square of the longest vector that takes part; no score exceeds it.
LONGEST = float(2**60)


def _primes(n: int) -> list[int]:
    found, at = [], LARGEST
    while len(found) < n:
        if all(at % d for d in range(3, int(at**0.5) + 1, 2)):
            found.append(at)
        at -= 2
    return found


def primes_for(bound: float) -> list[int]:
    """As many primes as tell all integers of at most ``bound`` in size apart."""
    n, product = 1, LARGEST
    while product < 2.1 * bound + 2:
        n += 1
        product = 1
        for p in _primes(n):
            product *= p
    return _primes(n)


def _reduced(x: np.ndarray, p: int) -> np.ndarray:
    """``x`` modulo ``p``, of about p / 2 in size at most; float32 integers below 2 ** 24, in place."""
    multiple = np.rint(x * np.float32(1 / p))
    multiple *= np.float32(p)
    x -= multiple
    return x


def residues(vectors: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Integer vectors (rows) modulo each prime, between -p / 2 and p / 2."""
    out = []
    for p in primes:
        r = vectors % p
        r[r > p // 2] -= p
        out.append(r.astype(np.float32))
    return out


def products(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """All inner products of two sets of integer vectors, given by their residues, as exact integers."""
    digits: list[np.ndarray] = []
    total: np.ndarray | None = None
    radix = 1
    for k, (a, b, p) in enumerate(zip(left, right, primes, strict=True)):
        r = np.zeros((len(a), len(b)), np.float32)
        for at in range(0, a.shape[1], DEPTH):
            r += _reduced(a[:, at : at + DEPTH] @ b[:, at : at + DEPTH].T, p)
            if at:
                r = _reduced(r, p)
        for digit, q in zip(digits, primes[:k], strict=True):
            inverse = pow(q, -1, p)
            r = _reduced((r - _reduced(digit.copy(), p)) * np.float32(inverse - p if inverse > p // 2 else inverse), p)
        if k + 1 < len(primes):
            digits.append(r)
        part = r.astype(np.int64)
        # the product of the first primes may exceed 64 bits where the digits are 0 in sum; arithmetic wraps
        part *= np.int64((radix + 2**63) % 2**64 - 2**63)
        total = part if total is None else total + part
        radix *= p
    return total


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as the rows of a matrix; shorter ones are filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _best(scores: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` highest scores, the first of equals first."""
    if len(scores) > 8 * count:
        least = -np.partition(-scores, count - 1)[count - 1]
        some = np.flatnonzero(scores >= least)
        return some[np.argsort(-scores[some], kind="stable")[:count]]
    return np.argsort(-scores, kind="stable")[:count]


def _each_anchor(
    anchors: pa.Table, rows: pa.Table, width: int, primes: list[int], visit: Callable[[int, np.ndarray, slice], None]
) -> None:
    """Calls ``visit`` with each anchor's scores against a run of rows."""
    if not len(anchors) or not len(rows):
        return
    right = residues(_matrix(rows["v"], width), primes)
    for at in range(0, len(anchors), TILE[0]):
        left = residues(_matrix(anchors["v"].slice(at, TILE[0]), width), primes)
        for lo in range(0, len(rows), TILE[1]):
            part = slice(lo, min(lo + TILE[1], len(rows)))
            scores = products(left, [r[part] for r in right], primes)
            for k in range(len(scores)):
                visit(at + k, scores[k], part)


def _ids(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def rounded(rows: DataFrame, vector: str, scale: float) -> Column:
    """The components as integers: floor(scale * x) in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def participants(rows: DataFrame, id: str, label: str, vector: str, scale: float) -> DataFrame:
    """(id, label, v): the rows that take part, with their rounded vectors."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    kept = rows.where(F.col(id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    named = kept.select(F.col(id).cast("bigint").alias("id"), F.col(label).alias("label"), rounded(kept, vector, scale).alias("v"))
    # 32 bits hold every component of a vector that is not too long
    return named.where(square <= LONGEST).withColumn("v", F.col("v").cast("array<int>"))


def _blocks(rows: int, anchors: int) -> tuple[int, int]:
    few = min(FEW_BLOCKS, -(-rows // FEW_ROWS))
    return max(1, -(-rows // ROWS), few), max(1, -(-anchors // ANCHORS))


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 5,
    window: tuple[int, int] = (80, 100),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each
    of its first ``positives`` other rows of the same label, the first ``negatives`` rows of another label
    whose score is at least ``window[0] / window[1]`` of the positive's and at most the positive's.

    A score is the integer inner product of the rounded vectors; higher ones come first, of equal ones the
    smaller id. ``is_anchor`` is a condition on ``rows``. Rows with a null id, label or vector, a null or
    non-finite component, or a rounded vector of a length above 2 ** 30 take no part. A shorter vector has
    zeros in the missing components. Rows of equal ids are rows of their own, but none is a positive or
    negative of its own id; equal anchor rows count once.
    """
    low, high = window
    flagged = rows.withColumn("_anchor", F.coalesce(is_anchor, F.lit(False)))
    taken = participants(flagged.where("_anchor"), id, label, vector, scale).dropDuplicates(["id", "label", "v"])
    anchors = stored(taken.withColumn("key", F.xxhash64("id", "label", "v")), "anchors")
    every = stored(participants(rows, id, label, vector, scale), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    n, width, longest = every.agg(F.count("*"), F.max(F.size("v")), F.max(square)).first()
    width, primes = max(1, width or 0), primes_for(longest or 0.0)
    row_blocks, anchor_blocks = _blocks(n, anchors.count())
    # sorted copies of each side; a tile is a pair of blocks
    of_row = F.pmod(F.xxhash64("id"), F.lit(row_blocks)).alias("j")
    of_anchor = F.pmod(F.xxhash64("id", "key"), F.lit(anchor_blocks)).alias("i")
    to_all = lambda n, name: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))).alias(name)
    spread = every.select("*", of_row).select("*", to_all(anchor_blocks, "i"))

    def first(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        ids, own = _ids(rows, "id"), _ids(anchors, "id")
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2] * len(anchors)

        def visit(k: int, scores: np.ndarray, part: slice) -> None:
            other = ids[part] != own[k]
            held = np.concatenate([best[k][0], scores[other]]), np.concatenate([best[k][1], ids[part][other]])
            top = _best(held[0], positives)
            best[k] = held[0][top], held[1][top]

        _each_anchor(anchors, rows, width, primes, visit)
        at = np.repeat(np.arange(len(anchors)), [len(b[0]) for b in best])
        none = [np.zeros(0, np.int64)]
        found = {
            "id": own[at],
            "key": _ids(anchors, "key")[at],
            "positive_id": np.concatenate([b[1] for b in best] + none),
            "positive_score": np.concatenate([b[0] for b in best] + none),
        }
        return pa.table(found)

    longs = lambda *names: T.StructType([T.StructField(n, T.LongType()) for n in names])
    met = anchors.select("*", of_anchor).select("*", to_all(row_blocks, "j"))
    tiles = ["label", "i", "j"]
    near = met.groupBy(*tiles).cogroup(spread.groupBy(*tiles))
    near = near.applyInArrow(first, longs("id", "key", "positive_id", "positive_score"))
    best_first = [F.desc("positive_score"), F.asc("positive_id")]
    place = F.row_number().over(Window.partitionBy("id", "key").orderBy(*best_first))
    pairs = near.withColumn("place", place).where(F.col("place") <= positives)
    # at most ``positives`` for an anchor
    listed = pairs.groupBy("id", "key").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("p"))
    with_positives = stored(anchors.join(listed, ["id", "key"]), "positives")

    def second(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        ids, code = _ids(rows, "id"), {}
        codes = np.array([code.setdefault(value, len(code)) for value in rows["label"].to_pylist()], np.int64)
        theirs = [code.get(value, -1) for value in anchors["label"].to_pylist()]
        own, given = _ids(anchors, "id"), anchors["p"].to_pylist()
        least = [[-(-low * p["positive_score"] // high) for p in ps] for ps in given]
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

        def visit(k: int, scores: np.ndarray, part: slice) -> None:
            ps = given[k]
            # the first positive has the highest score
            top, bottom = ps[0]["positive_score"], min(least[k])
            some = np.flatnonzero((scores <= top) & (scores >= bottom))
            some = some[(codes[part][some] != theirs[k]) & (ids[part][some] != own[k])]
            if not len(some):
                return
            # highest first, the smaller id of equals first
            order = some[np.argsort(-scores[some], kind="stable")]
            down, named = scores[order], ids[part][order]
            for m, p in enumerate(ps):
                lo = int(np.searchsorted(-down, -p["positive_score"], side="left"))
                hi = min(lo + negatives, int(np.searchsorted(-down, -least[k][m], side="right")))
                if hi > lo:
                    held = best.get((k, m), (down[:0], named[:0]))
                    held = np.concatenate([held[0], down[lo:hi]]), np.concatenate([held[1], named[lo:hi]])
                    keep = np.argsort(-held[0], kind="stable")[:negatives]
                    best[k, m] = held[0][keep], held[1][keep]

        _each_anchor(anchors, rows, width, primes, visit)
        keys = _ids(anchors, "key")
        sizes = [len(b[0]) for b in best.values()]
        spelled = {
            "anchor_id": [own[k] for k, _ in best],
            "key": [keys[k] for k, _ in best],
            "positive_id": [given[k][m]["positive_id"] for k, m in best],
            "place": [given[k][m]["place"] for k, m in best],
            "positive_score": [given[k][m]["positive_score"] for k, m in best],
        }
        found = {name: np.repeat(np.array(values, np.int64), sizes) for name, values in spelled.items()}
        none = [np.zeros(0, np.int64)]
        found["negative_id"] = np.concatenate([b[1] for b in best.values()] + none)
        found["negative_score"] = np.concatenate([b[0] for b in best.values()] + none)
        return pa.table(found)

    met = with_positives.select("*", of_anchor).select("*", to_all(row_blocks, "j"))
    schema = longs("anchor_id", "key", "positive_id", "place", "positive_score", "negative_id", "negative_score")
    found = met.groupBy("i", "j").cogroup(spread.groupBy("i", "j")).applyInArrow(second, schema)
    order = Window.partitionBy("anchor_id", "key", "place").orderBy(F.desc("negative_score"), F.asc("negative_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mined_embeddings(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by 100; every seventh vec_id has the next label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    kept = embeddings.select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives(kept, F.col("vec_id") % 100 == 0)
