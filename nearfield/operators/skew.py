"""Joins that stay balanced when a key holds a large part of the rows.

Rows are read once for a join with a summary, and at most once more, for a count, for a join that tests
pairs. Nothing is limited: every key takes the same way, whatever its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A task tests about the square of this many pairs of one key.
PAIR_SIDE = 10_000

_HASH = "__hash"


def _check_types(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> None:
    """Equal keys must have equal hashes, which holds within one type only."""
    for k in keys:
        ours, theirs = left.schema[k].dataType, right.schema[k].dataType
        if ours != theirs:
            raise TypeError(f"equal keys must have one type, not {ours.simpleString()} and {theirs.simpleString()}")


def join_summary(left: DataFrame, summary: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join (inner or left) with a right side that has one row per key.

    Adaptive execution splits a hot key's left rows over tasks by size, but only where both sides come
    from shuffles that were made for the join. A hash of the keys as one more key sees to that: the
    summary, small by then, is shuffled once more after its aggregate.
    """
    keys = list(keys)
    _check_types(left, summary, keys)
    own, theirs = (df.withColumn(_HASH, F.xxhash64(*keys)) for df in (left, summary))
    return own.join(theirs, [*keys, _HASH], how).drop(_HASH)


def _count_rows(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def _dealt(rows: DataFrame, columns: Sequence[str], own: str, other: str, here: str, there: str) -> DataFrame:
    """The rows with the number of their part (``here``) and, once each, of every part that it meets."""
    of = F.coalesce(F.col(own), F.lit(1))
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(other), F.lit(1)) - 1)
    return rows.select(*columns, F.pmod(F.xxhash64(*columns), of).alias(here), F.explode(copies).alias(there))


def dealt_sides(left: DataFrame, right: DataFrame, keys: Sequence[str], side: int) -> tuple[DataFrame, DataFrame]:
    """The rows whose key both sides have, dealt so that the rows of one (key, __i, __j) are about ``side`` of
    each side at most, and each pair of equal keys meets in one of them."""
    keys = list(keys)
    _check_types(left, right, keys)
    counted = _count_rows(left, keys, "__nl").join(_count_rows(right, keys, "__nr"), keys)
    parts = counted.select(*keys, *[F.ceil(F.col(n) / F.lit(side)).alias(p) for n, p in (("__nl", "__a"), ("__nr", "__b"))])
    lhs = _dealt(join_summary(left, parts, keys, "inner"), left.columns, "__a", "__b", "__i", "__j")
    rhs = _dealt(join_summary(right, parts, keys, "inner"), right.columns, "__b", "__a", "__j", "__i")
    return lhs, rhs


def join_close(
    left: DataFrame, right: DataFrame, keys: Sequence[str], condition: Column, pair_side: int = PAIR_SIDE
) -> DataFrame:
    """All pairs of equal keys that meet a condition: the left columns, and the right ones without the keys.

    Apart from the keys the sides must share no column names. Splitting by size alone would leave a
    crowded key's pairs in one task, so the rows of each key are counted on both sides, and where the
    pairs are many, the left rows are dealt into ``a`` parts and the right rows into ``b`` by a hash of
    the row; part ``i`` meets part ``j`` under (key, i, j). Equal rows share a part; if they are so many
    that it is large, adaptive execution splits it by size.
    """
    keys = list(keys)
    _check_types(left, right, keys)
    pairs = F.col("__nl").cast("double") * F.col("__nr").cast("double")
    parts = [F.ceil(F.col(n) / F.lit(pair_side)).alias(p) for n, p in (("__nl", "__a"), ("__nr", "__b"))]
    counted = _count_rows(left, keys, "__nl").join(_count_rows(right, keys, "__nr"), keys)
    crowded = counted.where(pairs > float(pair_side) ** 2).select(*keys, *parts)

    # like any summary, so that a crowded key's rows don't meet in one task before they are dealt
    lhs = _dealt(join_summary(left, crowded, keys, "left"), left.columns, "__a", "__b", "__i", "__j")
    rhs = _dealt(join_summary(right, crowded, keys, "left"), right.columns, "__b", "__a", "__j", "__i")
    on = [*keys, "__i", "__j"]
    rhs = rhs.withColumnsRenamed({k: f"__k_{k}" for k in on})
    test = condition
    for k in on:
        test = (F.col(k) == F.col(f"__k_{k}")) & test
    output = [*left.columns, *[c for c in right.columns if c not in keys]]
    return lhs.join(rhs, test).select(*output)
