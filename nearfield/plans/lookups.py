"""Lookups on the hit table and the group table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearfield.functions.display import group_records, hit_records
from nearfield.plans.detect import observation

# Columns of the short report on anomalous groups.
ANOMALY_COLUMNS = ["observationgroup", "grouphit", "source", "mjd", "ra", "dec"]


# Fixed value: the selector of the page query that shows a group; any other shows an observation.
GROUP_QUERY = "1"


def hits_of_observation(hits: DataFrame, group: int, order: int) -> DataFrame:
    """The hits of one observation, strongest first, then by drift rate."""
    return observation(hits, group, order).orderBy(F.col("snr").desc(), F.col("driftrate").desc())


def ranked_hits(hits: DataFrame, group: int, order: int) -> DataFrame:
    """The hits of one observation with their place in that order; equal ones share a place."""
    strongest = Window.partitionBy("observationgroup", "observationorder").orderBy(F.col("snr").desc(), F.col("driftrate").desc())
    return observation(hits, group, order).withColumn("place", F.rank().over(strongest).cast("bigint"))


def group_lookup(groups: DataFrame, group: int) -> DataFrame:
    """The row of one group."""
    return groups.where(F.col("observationgroup") == group)


def groups_by_source(groups: DataFrame, source: str) -> DataFrame:
    """The groups that observed a source."""
    return groups.where(F.col("source") == source)


def anomaly_feed(groups: DataFrame) -> DataFrame:
    """Groups with at least one anomalous hit, all columns. Works on a table and on a stream."""
    return group_records(groups.where(F.col("grouphit") > 0))


def anomalous_groups(groups: DataFrame) -> DataFrame:
    """Groups with at least one anomalous hit, the short report."""
    return groups.where(F.col("grouphit") > 0).select(*ANOMALY_COLUMNS)


def answer(query: str, hits: DataFrame, groups: DataFrame, group: int, order: int | None = None) -> DataFrame:
    """The two page queries: ``GROUP_QUERY`` is the group's record, anything else the observation's hits."""
    if str(query) == GROUP_QUERY:
        return group_records(group_lookup(groups, group))
    if order is None:
        raise ValueError("the observation query needs an order")
    return hit_records(hits_of_observation(hits, group, order))
