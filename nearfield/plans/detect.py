"""Detection: hits that recur in every ON observation of a group and appear in no OFF observation.

All groups are handled by one plan: an aggregate that holds, per group and frequency cell, what the
other observations contain, and one join of the anchor observation with it (two of either where the
radii differ). Everything is compared with the anchor's frequency; the anchor is the first ON
observation.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.operators.axis import check_closed, shared_axis
from nearfield.operators.range_join import CELL, POSITION, flag_matches, neighbour_summary, place
from nearfield.schema import GROUPS

GROUP, ORDER = "observationgroup", "observationorder"


@dataclass(frozen=True)
class Rule:
    """Thresholds are strict. Radii are in units of frequency."""

    on_orders: tuple[int, ...] = (1, 3, 5)
    off_orders: tuple[int, ...] = (2, 4, 6)
    r_on: float = 600
    r_off: float = 600
    snr_on: float = 25
    snr_off: float = 20
    min_drift: float = 0.0001
    abs_drift: bool = False
    closed: str = "right"

    def __post_init__(self):
        if not self.on_orders:
            raise ValueError("at least one ON observation is needed")
        if set(self.on_orders) & set(self.off_orders):
            raise ValueError("an observation cannot be both ON and OFF")
        check_closed(self.closed)


STREAM_RULE = Rule()
BATCH_RULE = Rule(r_on=100, r_off=100)


def is_on(order: Column) -> Column:
    """Role by parity: odd observations are ON, even ones OFF."""
    return order % 2 == 1


def observation(hits: DataFrame, group: int, order: int) -> DataFrame:
    """The hits of one observation."""
    return hits.where((F.col(GROUP) == group) & (F.col(ORDER) == order))


def above(hits: DataFrame, snr: float, drift: float, abs_drift: bool = False) -> DataFrame:
    """Hits above both thresholds."""
    rate = F.abs("driftrate") if abs_drift else F.col("driftrate")
    return hits.where((F.col("snr") > snr) & (rate > drift))


def strong(hits: DataFrame, rule: Rule) -> DataFrame:
    """Hits above the thresholds of their observation's role, all observations of the rule."""
    snr, order = F.col("snr"), F.col(ORDER)
    on = order.isin(*rule.on_orders) & (snr > rule.snr_on)
    off = order.isin(*rule.off_orders) & (snr > rule.snr_off) if rule.off_orders else F.lit(False)
    # The looser threshold is stated again on its own, so that it reaches the file scan.
    return above(hits, min(rule.snr_on, rule.snr_off), rule.min_drift, rule.abs_drift).where(on | off)


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _flag(
    anchors: DataFrame,
    others: DataFrame,
    rule: Rule,
    radius: float,
    slots: Mapping[str, Column],
    how: str,
    keep: Column | None = None,
) -> DataFrame:
    """Anchors with one boolean per slot: whether the slot's hits hold a match."""
    key_type = anchors.schema["frequency"].dataType
    axis = shared_axis(key_type, key_type, radius)
    centre = axis.position(F.col("frequency"), key_type)
    chosen = others.where(reduce(lambda a, b: a | b, slots.values()))
    summary = neighbour_summary(chosen.withColumn(POSITION, centre), [GROUP], axis, slots)
    placed = place(anchors, axis, centre)
    return flag_matches(placed, summary, [GROUP], axis, list(slots), rule.closed, how, keep)


def _matched_anchors(
    hits: DataFrame, rule: Rule, on: Mapping[str, Column], off: Mapping[str, Column], only_anomalous: bool
) -> DataFrame:
    """Distinct anchor hits with a boolean per slot. Anchors that fail every stage may be missing."""
    rows = strong(hits, rule).where(F.col(GROUP).isNotNull())
    if on:
        rows = rows.where(F.col("frequency").isNotNull())
    anchors, others = (rows.where(test) for test in _split(rule))
    keep_on, keep_off = _all(F.col(s) for s in on), _all(~F.col(s) for s in off)
    if on and off and rule.r_on == rule.r_off:
        keep = keep_on & keep_off if only_anomalous else None
        return _flag(anchors, others, rule, rule.r_on, {**on, **off}, "inner", keep).distinct()
    if on:
        anchors = _flag(anchors, others, rule, rule.r_on, on, "inner", keep_on if only_anomalous else None)
    if off:
        anchors = _flag(anchors, others, rule, rule.r_off, off, "left", keep_off if only_anomalous else None)
    return anchors.distinct()


def _split(rule: Rule) -> tuple[Column, Column]:
    anchor = F.col(ORDER) == rule.on_orders[0]
    return anchor, ~anchor


def detect_anomalies(hits: DataFrame, rule: Rule = BATCH_RULE) -> DataFrame:
    """The anomalous hits of all groups: distinct anchor hits matched in every other ON
    observation and in no OFF observation."""
    order = F.col(ORDER)
    on = {f"__on{o}": order == o for o in rule.on_orders[1:]}
    # No match in any OFF observation is no match in all of them taken together.
    off = {"__off": order.isin(*rule.off_orders)} if rule.off_orders else {}
    return _matched_anchors(hits, rule, on, off, only_anomalous=True).select(*hits.columns)


def steps(rule: Rule) -> list[tuple[float, dict[str, Column]]]:
    """The summaries that detection needs: a radius with its slots; one, or two if the radii differ."""
    order = F.col(ORDER)
    on = {f"__on{o}": order == o for o in rule.on_orders[1:]}
    off = {"__off": order.isin(*rule.off_orders)} if rule.off_orders else {}
    if on and off and rule.r_on == rule.r_off:
        return [(rule.r_on, on | off)]
    return [(radius, slots) for radius, slots in ((rule.r_on, on), (rule.r_off, off)) if slots]


def anchors_of(hits: DataFrame, rule: Rule) -> DataFrame:
    """Hits of the anchor observation above their thresholds; those without a frequency only where no other
    ON observation has to match."""
    rows = strong(hits, rule).where(_split(rule)[0] & F.col(GROUP).isNotNull())
    return rows.where(F.col("frequency").isNotNull()) if len(rule.on_orders) > 1 else rows


def summaries(hits: DataFrame, rule: Rule) -> list[DataFrame]:
    """For each step, per group and cell, the extremes of what the other observations contain.

    They are minima and maxima, so summaries of two sets of hits merge into that of both. A hit that
    replaces another one of its key leaves them as they are, for all they depend on is in the key.
    """
    others = strong(hits, rule).where(_split(rule)[1] & F.col(GROUP).isNotNull())
    out = []
    for radius, slots in steps(rule):
        key_type = hits.schema["frequency"].dataType
        axis = shared_axis(key_type, key_type, radius)
        centre = axis.position(F.col("frequency"), key_type)
        chosen = others.where(reduce(lambda a, b: a | b, slots.values()))
        out.append(neighbour_summary(chosen.withColumn(POSITION, centre), [GROUP], axis, slots))
    return out


def merged(summary: DataFrame) -> DataFrame:
    """Summaries of several sets of hits, one after another, as that of all."""
    ends = [c for c in summary.columns if c not in (GROUP, CELL)]
    largest = [F.max(c).alias(c) if c.endswith(("_below", "_most")) else F.min(c).alias(c) for c in ends]
    return summary.groupBy(GROUP, CELL).agg(*largest)


def anomalies_by_summary(anchors: DataFrame, found: list[DataFrame], rule: Rule) -> DataFrame:
    """The anchors that are anomalous by the merged summaries of their groups' other hits."""
    key_type = anchors.schema["frequency"].dataType
    rows = anchors
    for (radius, slots), summary in zip(steps(rule), found, strict=True):
        axis = shared_axis(key_type, key_type, radius)
        placed = place(rows, axis, axis.position(F.col("frequency"), key_type))
        matched, apart = ([s for s in slots if s.startswith(side)] for side in ("__on", "__off"))
        keep = _all(F.col(s) for s in matched) & _all(~F.col(s) for s in apart)
        # without ON slots a cell that nobody is near must not drop the anchor
        how = "inner" if matched else "left"
        rows = flag_matches(placed, summary, [GROUP], axis, list(slots), rule.closed, how, keep).select(*anchors.columns)
    return rows


def observation_counts(hits: DataFrame, rule: Rule = BATCH_RULE) -> DataFrame:
    """Hits above the thresholds, per group and observation."""
    return strong(hits, rule).groupBy(GROUP, ORDER).agg(F.count(F.lit(1)).alias("n_hits"))


def funnel_stages(rule: Rule) -> list[str]:
    """Names of the stages, in order: one per further ON observation, one per OFF observation."""
    return [f"on_{o}" for o in rule.on_orders[1:]] + [f"off_{o}" for o in rule.off_orders]


def detection_funnel(hits: DataFrame, rule: Rule = BATCH_RULE) -> DataFrame:
    """Hits that survive each stage, one row per group and stage, groups without hits included."""
    order = F.col(ORDER)
    on = {f"__on{o}": order == o for o in rule.on_orders[1:]}
    off = {f"__off{o}": order == o for o in rule.off_orders}
    found = _matched_anchors(hits, rule, on, off, only_anomalous=False)
    alive, counts = F.lit(True), []
    for stage, test in zip(funnel_stages(rule), [F.col(s) for s in on] + [~F.col(s) for s in off]):
        alive = alive & test
        counts.append(F.when(alive, 1).otherwise(0).cast("bigint").alias(stage))
    stages = funnel_stages(rule)
    zero = [F.lit(0).cast("bigint").alias(s) for s in stages]
    counted = found.select(GROUP, *counts).unionByName(hits.select(GROUP, *zero))
    totals = counted.groupBy(GROUP).agg(*[F.sum(s).alias(s) for s in stages])
    return totals.unpivot([GROUP], stages, "stage", "n_hits")


def group_results(
    hits: DataFrame,
    rule: Rule = BATCH_RULE,
    metadata: DataFrame | None = None,
    groups: DataFrame | None = None,
) -> DataFrame:
    """One row per group: the number of anomalous hits and the group's metadata.

    The groups are those of the hits, or of ``groups``, which may repeat them. ``metadata`` has an
    ``observationgroup`` and any of the other group columns; what it lacks is null. Groups without
    anomalous hits have a count of zero.
    """
    return counted_results(detect_anomalies(hits, rule), hits if groups is None else groups, metadata)


def counted_results(found: DataFrame, groups: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """The rows ``found`` counted for each of ``groups``, which may repeat them, as rows of the group table."""
    ones, zeros = found.select(GROUP, F.lit(1).alias("__one")), groups.select(GROUP, F.lit(0).alias("__one"))
    results = ones.unionByName(zeros).groupBy(GROUP).agg(F.sum("__one").cast("int").alias("grouphit"))
    return with_metadata(results, metadata)


def with_metadata(results: DataFrame, metadata: DataFrame | None) -> DataFrame:
    """Group results as full rows of the group table, which has one row per group: of a group that
    ``metadata`` has more than once, the greatest row counts."""
    rest = [f for f in GROUPS.fields if f.name not in (GROUP, "grouphit")]
    known = [] if metadata is None else [f.name for f in rest if f.name in metadata.columns]
    if known:
        each = metadata.groupBy(GROUP).agg(F.max(F.struct(*known)).alias("__known"))
        results = results.join(each.select(GROUP, "__known.*"), GROUP, "left")
    columns = [(F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in rest]
    return results.select(GROUP, "grouphit", *columns)


def groups_in(hits: DataFrame) -> DataFrame:
    """Distinct group ids, ascending."""
    return hits.select(GROUP).distinct().orderBy(GROUP)


def first_group(hits: DataFrame) -> DataFrame:
    """The smallest group id, and the number of distinct ids."""
    ids = hits.select(GROUP).distinct()
    return ids.agg(F.min(GROUP).alias("first_group"), F.count(F.lit(1)).alias("n_groups"))
