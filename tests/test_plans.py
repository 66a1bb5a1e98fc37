import re

import pytest
from pyspark.sql import functions as F

from nearfield.operators import distance_pairs, lsh_semi_join, range_anti_join, range_pairs, range_semi_join
from nearfield.operators.skew import join_close
from nearfield.schema import HITS
from nearfield.plans.detect import Rule, detect_anomalies, detection_funnel
from nearfield.sources.tables import append_hits, read_hits


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "hits")
    part = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n))
    made = spark.range(4200).select(
        (100 + part(1, 3)).cast("int").alias("observationgroup"),
        (1 + part(2, 6)).cast("int").alias("observationorder"),
        (part(3, 100_000) / 10).alias("frequency"),
        (part(4, 1000) / 10).alias("snr"),
        (part(5, 1000) / 1000).alias("driftrate"),
        F.lit(0.0).alias("uncorrectedfrequency"),
    )
    append_hits(made, path)
    return read_hits(spark, path)


def executed(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("+- == Initial Plan ==")[0]


def observation(hits, order):
    return hits.where(F.col("observationorder") == order)


def plans(stored, by=("observationgroup",)):
    one, two = observation(stored, 1), observation(stored, 3)
    rule = Rule(r_on=10, r_off=10)
    yield range_semi_join(one, two, "frequency", 10, by=by)
    yield range_anti_join(one, two, "frequency", 10, by=by)
    yield range_pairs(one, two, "frequency", 10, by=by)
    yield distance_pairs(one, two, {"frequency": 1e-4, "snr": 1e-2, "driftrate": 1.0}, 0.01, by=by)
    yield lsh_semi_join(one, two, within=0.01, bucket_length=0.1, by=by)
    yield detect_anomalies(stored, rule)
    yield detection_funnel(stored, rule)


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_no_nested_loops(spark, stored, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for by in (("observationgroup",), ()):
            for df in plans(stored, by):
                plan = df._jdf.queryExecution().executedPlan().toString()
                assert "CartesianProduct" not in plan and "NestedLoop" not in plan
                assert "Python" not in plan and "Pandas" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_thresholds_and_groups_reach_the_scan(stored):
    df = detect_anomalies(stored.where("observationgroup = 101"), Rule(r_on=10, r_off=10))
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert scans and all("EqualTo(observationgroup,101)" in f for f in scans)
    assert all("GreaterThan(snr,20.0)" in f and "GreaterThan(driftrate,1.0E-4)" in f for f in scans)


@pytest.fixture(scope="module")
def flat(spark, tmp_path_factory):
    """The same hits as plain files, so that scans are counted without those of a versioned table."""
    path = str(tmp_path_factory.mktemp("plans") / "flat")
    part = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n))
    columns = [(100 + part(1, 3)).cast("int"), (1 + part(2, 6)).cast("int"), part(3, 100_000) / 10, part(4, 1000) / 10, part(5, 1000) / 1000, F.lit(0.0)]
    spark.range(4200).select(*[c.alias(f.name) for c, f in zip(columns, HITS.fields)]).write.parquet(path)
    return spark.read.schema(HITS).parquet(path)


def stages_run(spark, df):
    """Stages that ran tasks for the query, of which adaptive execution may have dropped some from the plan."""
    tracker, group = spark.sparkContext.statusTracker(), f"count-{id(df)}"
    spark.sparkContext.setJobGroup(group, "")
    df.collect()
    ids = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    infos = [tracker.getStageInfo(s) for s in ids]
    return sum(1 for i in infos if i is not None and i.numCompletedTasks > 0)


def initial(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_detection_reads_the_hits_twice_and_runs_few_stages(spark, flat):
    """Anchors and others. A small summary is broadcast: its own shuffle, and one for the distinct. Else one
    more for each side of the join."""
    one = detect_anomalies(flat, Rule(r_on=10, r_off=10))
    plan = initial(one)
    assert plan.count("FileScan") == 2 and len(re.findall("Exchange hashpartitioning", plan)) == 2
    assert stages_run(spark, one) <= 6
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert len(re.findall("Exchange hashpartitioning", initial(detect_anomalies(flat, Rule(r_on=10, r_off=10))))) == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    two = detect_anomalies(flat, Rule(r_on=10, r_off=5))
    assert initial(two).count("FileScan") == 3
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any("uncorrectedfrequency" not in s for s in schemas)


def test_pair_joins_read_each_side_twice(spark, flat):
    one, three = observation(flat, 1), observation(flat, 3)
    for pairs in (range_pairs(one, three, "frequency", 10), distance_pairs(one, three, {"frequency": 1e-4, "snr": 1e-2}, 0.01)):
        plan = initial(pairs)
        # each side is counted once, for the plan of either side's rows, and read once
        scans = set(re.findall(r"FileScan[^\n]*PushedFilters: \[([^\]]*)\]", plan))
        assert len(scans) <= 4 and "Limit" not in plan and "BroadcastNestedLoop" not in plan


def test_a_hot_cell_is_split_over_tasks(spark, flat):
    """A third of a million rows in one cell: no task reads more than a part of it."""
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "200k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") / 10)
        left = spark.range(300_000).select("id", spread.alias("c"), F.sha2(F.col("id").cast("string"), 256).alias("load"))
        right = spark.range(100_000).select((F.col("id") / 3).alias("c"))
        found = range_semi_join(left.repartition(4), right, "c", 0.01)
        expected = left.where("id % 3 = 0 OR id % 10 = 0").count()
        assert 0 < found.count() <= expected
        plan = executed(found)
        assert "skew=true" in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        for key in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)


def test_rows_of_a_crowded_key_are_dealt_by_several_tasks(spark):
    """Without broadcasts: the list of crowded keys is joined like a summary, so the hot key's rows are split."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "200k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        side = lambda n, name: spark.range(n).select(
            F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias(name), F.md5(F.col("id").cast("string")).alias(name + "_text")
        )
        left, right = side(60_000, "a"), side(60, "b")
        pairs = join_close(left, right, ["k"], F.col("a") % 10_000 == F.col("b"), pair_side=500)
        assert pairs.count() == 48 * 6 + 12
        plan = executed(pairs)
        dealt = [line for line in plan.splitlines() if "SortMergeJoin" in line and "LeftOuter" in line]
        assert dealt and any("skew=true" in line for line in dealt)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        for key in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)


def test_the_summary_is_one_row_per_cell(spark):
    """A right side of a hundred thousand equal rows is one row after the map side."""
    from nearfield.operators.axis import shared_axis
    from nearfield.operators.range_join import POSITION, neighbour_summary

    right = spark.range(100_000).select(F.lit(5.0).alias(POSITION))
    kind = right.schema[POSITION].dataType
    summary = neighbour_summary(right, [], shared_axis(kind, kind, 1), {"r": F.lit(True)})
    assert summary.count() == 3
    plan = executed(summary)
    assert "partial_max" in plan
