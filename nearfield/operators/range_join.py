"""Range joins: semi, anti and pairs, on numeric and timestamp keys.

A left key ``c`` matches a right key in ``(c - r, c + r]`` (``closed`` moves the closed end). Keys
are put into cells, which turns the range test into an equality that Spark can hash on.

Semi and anti need no pairs. With cells of 1.5 radii the interval around a left key in cell ``k``
stays within cells ``k-1 .. k+1``, and it holds a right key exactly when it holds one of four:
the largest of ``k-1``, the smallest or largest of ``k``, the smallest of ``k+1``. So the right
side shrinks, before its shuffle, to one row per cell, however dense the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.operators.axis import Axis, check_closed, inside, shared_axis
from nearfield.operators.skew import PAIR_SIDE, join_close, join_summary

CELL = "__cell"
POSITION = "__position"
MATCHED = "__matched"
SEMI_CELL = 1.5
PAIR_CELL = 4
_EXTREMES = ("below", "least", "most", "above")


def neighbour_summary(right: DataFrame, keys: Sequence[str], axis: Axis, slots: Mapping[str, Column]) -> DataFrame:
    """One row per (keys, cell): the right positions that decide the left rows of that cell.

    ``right`` has the keys and a ``__position``. Each slot is a condition that picks the rows of
    one right side; its four values are named ``<slot>_below`` and so on.
    """
    position, step = F.col(POSITION), F.col("__offer.step")
    picked = right.select(*keys, POSITION, *[c.alias(f"__in_{s}") for s, c in slots.items()])
    offered = picked.where(position.isNotNull()).withColumn("__offer", F.explode(axis.offers(position, SEMI_CELL)))
    offered = offered.withColumn(CELL, F.col("__offer.cell"))
    aggregates = []
    for slot in slots:
        chosen = F.col(f"__in_{slot}")
        aggregates += [
            F.max(F.when(chosen & (step > 0), position)).alias(f"{slot}_below"),
            F.min(F.when(chosen & (step == 0), position)).alias(f"{slot}_least"),
            F.max(F.when(chosen & (step == 0), position)).alias(f"{slot}_most"),
            F.min(F.when(chosen & (step < 0), position)).alias(f"{slot}_above"),
        ]
    return offered.groupBy(*keys, CELL).agg(*aggregates)


def place(left: DataFrame, axis: Axis, position: Column) -> DataFrame:
    """The left side with its ``__position`` and ``__cell``.

    Rows without a position match nothing, but an anti-join has to keep them; a hash of the row as
    their cell spreads them over the tasks.
    """
    placed = left.withColumn(POSITION, position)
    return placed.withColumn(CELL, F.coalesce(axis.cell(F.col(POSITION), SEMI_CELL), F.xxhash64(*left.columns)))


def near(slot: str, ends: tuple[Column, Column], closed: str) -> Column:
    """True where a summary row of ``slot`` holds a value between the ends."""
    tests = [inside(F.col(f"{slot}_{e}"), ends, closed) for e in _EXTREMES]
    return F.coalesce(tests[0] | tests[1] | tests[2] | tests[3], F.lit(False))


def flag_matches(
    left: DataFrame,
    summary: DataFrame,
    by: Sequence[str],
    axis: Axis,
    slots: Sequence[str],
    closed: str,
    how: str,
    keep: Column | None,
) -> DataFrame:
    """Rows of the placed left side with one boolean per slot: whether it holds a match.

    ``keep`` is a condition on the booleans.
    """
    columns = [c for c in left.columns if c not in (POSITION, CELL)]
    ends = axis.around(F.col(POSITION))
    flags = [near(s, ends, closed).alias(s) for s in slots]
    flagged = join_summary(left, summary, [*by, CELL], how).select(*columns, *flags)
    return flagged if keep is None else flagged.where(keep)


def _names(on) -> tuple[str, str]:
    left, right = (on, on) if isinstance(on, str) else on
    return left, right


def _matched(
    left: DataFrame, right: DataFrame, on, within, by: Sequence[str], closed: str, how: str, keep: Column
) -> DataFrame:
    """Distinct left rows that pass ``keep``."""
    check_closed(closed)
    left_name, right_name = _names(on)
    left_type, right_type = left.schema[left_name].dataType, right.schema[right_name].dataType
    axis = shared_axis(left_type, right_type, within)
    position = axis.position(F.col(left_name), left_type)
    if how == "inner":
        left = left.where(position.isNotNull())
        left = left.dropna(subset=list(by)) if by else left
    # The right side's keys get names of their own, so both sides may come from one DataFrame.
    own = {k: f"__by{i}" for i, k in enumerate(by)}
    right_keys = right.select(
        *[F.col(k).alias(name) for k, name in own.items()],
        axis.position(F.col(right_name), right_type).alias(POSITION),
    )
    summary = neighbour_summary(right_keys, list(own.values()), axis, {MATCHED: F.lit(True)})
    summary = summary.withColumnsRenamed({name: k for k, name in own.items()})
    placed = place(left, axis, position)
    return flag_matches(placed, summary, by, axis, [MATCHED], closed, how, keep).select(*left.columns).distinct()


def range_semi_join(
    left: DataFrame,
    right: DataFrame,
    on: str | tuple[str, str],
    within,
    by: Sequence[str] = (),
    closed: str = "right",
) -> DataFrame:
    """Distinct left rows that have a right key within the radius.

    ``on`` names the key (a pair if the names differ), ``by`` further columns that must be equal.
    ``within`` is a number, or interval text such as ``"10 minutes"`` for timestamps. Null, NaN
    and infinite keys match nothing; finite keys of any size are compared as doubles are.
    """
    return _matched(left, right, on, within, by, closed, "inner", F.col(MATCHED))


def range_anti_join(
    left: DataFrame,
    right: DataFrame,
    on: str | tuple[str, str],
    within,
    by: Sequence[str] = (),
    closed: str = "right",
) -> DataFrame:
    """Distinct left rows that have no right key within the radius; arguments as in the semi-join."""
    return _matched(left, right, on, within, by, closed, "left", ~F.col(MATCHED))


def pair_sides(
    left: DataFrame, right: DataFrame, by: Sequence[str], suffixes: tuple[str, str]
) -> tuple[DataFrame, DataFrame, list[str], list[str]]:
    """Both sides with suffixed columns and the equal keys as ``__by0 …``; then the output columns
    and the names of the equal keys."""
    keys = [f"__by{i}" for i in range(len(by))]
    sides = []
    for df, suffix in ((left, suffixes[0]), (right, suffixes[1])):
        renamed = df.withColumnsRenamed({c: c + suffix for c in df.columns})
        equal = {name: F.col(k + suffix) for name, k in zip(keys, by)}
        sides.append(renamed.withColumns(equal).dropna(subset=keys) if keys else renamed)
    output = [c + s for df, s in ((left, suffixes[0]), (right, suffixes[1])) for c in df.columns]
    return sides[0], sides[1], output, keys


def range_pairs(
    left: DataFrame,
    right: DataFrame,
    on: str | tuple[str, str],
    within,
    by: Sequence[str] = (),
    closed: str = "right",
    suffixes: tuple[str, str] = ("_left", "_right"),
    pair_side: int = PAIR_SIDE,
) -> DataFrame:
    """All pairs whose right key is within the radius of the left key, columns suffixed."""
    check_closed(closed)
    left_name, right_name = _names(on)
    left_type, right_type = left.schema[left_name].dataType, right.schema[right_name].dataType
    axis = shared_axis(left_type, right_type, within)
    lhs, rhs, output, keys = pair_sides(left, right, by, suffixes)
    lhs = lhs.withColumn("__c1", axis.position(F.col(left_name + suffixes[0]), left_type))
    rhs = rhs.withColumn("__c2", axis.position(F.col(right_name + suffixes[1]), right_type))
    c1, c2 = F.col("__c1"), F.col("__c2")
    lhs = lhs.where(c1.isNotNull()).withColumn(CELL, axis.pair_cell(c1, PAIR_CELL))
    # A quarter radius more than needed: covers rounding in the cell numbers, costs few copies.
    rhs = rhs.where(c2.isNotNull()).withColumn(CELL, F.explode(axis.pair_cells(c2, PAIR_CELL, 1.25)))
    close = inside(c2, axis.around(c1), closed)
    return join_close(lhs, rhs, [*keys, CELL], close, pair_side).select(*output)
