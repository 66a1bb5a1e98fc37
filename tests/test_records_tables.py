import json
import random
import re

import pytest
from pyspark.errors import AnalysisException

from pyspark.sql import functions as F

from nearfield.functions.display import GROUP_PAGE, group_records, hit_records, hits_json
from nearfield.functions.records import bad_messages, encode_hits, good_hits, parse_hits
from nearfield.operators import latest
from nearfield.plans import lookups
from nearfield.schema import GROUPS, HIT_KEY, HITS
from nearfield.sources import log
from nearfield.operators import range_semi_join
from nearfield.sources.tables import (
    STORED_HITS,
    append_groups,
    append_hits,
    compact_hits,
    from_rows,
    read_groups,
    read_hits,
    read_hits_within,
    stored_semi_join,
)

HIT = (2, 1, 77.25, 31.5, 0.125, 77.5)
GROUP = (2, 1, "Canopus", 811.5, "6.4", "-52.7", *[f"scan-{i}.dat" for i in range(1, 7)])


def some_hits(spark, n=200, seed=1):
    rng = random.Random(seed)
    return from_rows(
        spark,
        [
            (rng.randrange(4), rng.randint(1, 6), rng.random() * 1e4, rng.random() * 100, rng.random() - 0.5, rng.random())
            for _ in range(n)
        ],
    )


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_round_trip_of_messages(spark):
    hits = some_hits(spark)
    sent = encode_hits(hits, F.lit("Vega"))
    assert sent.columns == ["key", "value"]
    parsed = parse_hits(sent)
    assert rows(good_hits(parsed)) == rows(hits)
    assert bad_messages(parsed).count() == 0
    assert good_hits(parsed).schema.simpleString() == HITS.simpleString()


def test_message_format(spark):
    message = encode_hits(from_rows(spark, [(50, 3, 1234.5, 30.0, 0.25, 1234.9)]), F.lit("1")).first()
    assert tuple(message) == ("1", "1;50;3;1234.5;30.0;0.25;1234.9")


def test_bad_messages_are_kept_with_a_reason(spark):
    values = [
        "1;50;3;1234.5;30.0;0.25;1234.9",
        "1;50;3;1234.5;30.0;0.25;1234.9;more;fields",
        "1;50;3;1234.5",
        "1;50;3;high;30.0;0.25;1234.9",
        "1;50.5;3;1.0;30.0;0.25;1234.9",
        "1;99999999999;3;1.0;30.0;0.25;1234.9",
        "1;50;3;;30.0;0.25;1234.9",
        "",
        None,
    ]
    parsed = parse_hits(spark.createDataFrame([(v,) for v in values], "value string"))
    assert good_hits(parsed).count() == 2
    reasons = [r["reason"] for r in bad_messages(parsed).collect()]
    assert sorted(reasons) == ["empty value", "no value"] + ["not a number"] * 4 + ["too few fields"]


def test_numbers_that_begin_with_letters(spark):
    values = [f"1;50;3;{v};30.0;0.25;1" for v in ("x", "_1", "Infinity", "-inf", "inf", "NaN", "nan", "1e3", "+2", " 7", "", "I", "é")]
    found = {r["value"].split(";")[3]: r["reason"] for r in parse_hits(spark.createDataFrame([(v,) for v in values], "value string")).collect()}
    endless, bad = dict.fromkeys(("Infinity", "-inf", "inf", "NaN", "nan"), "not finite"), dict.fromkeys(("x", "_1", "", "I", "é"), "not a number")
    assert found == {**endless, **bad, "1e3": None, "+2": None, " 7": None}


def test_a_message_is_read_once(spark):
    parsed = parse_hits(spark.createDataFrame([("1;50;3;1.0;2.0;3.0;4.0",)], "value string"))
    for out in (good_hits(parsed), bad_messages(parsed)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"as double", plan)) == 4 and plan.count("not finite") == 1


def test_hit_table(spark, tmp_path):
    path = str(tmp_path / "hits")
    hits = some_hits(spark)
    append_hits(hits, path)
    append_hits(from_rows(spark, [HIT]), path)
    assert rows(read_hits(spark, path)) == sorted([*rows(hits), HIT])
    one = lookups.hits_of_observation(read_hits(spark, path), 2, 1)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(observationgroup,2)" in plan and "EqualTo(observationorder,1)" in plan
    assert rows(read_hits(spark, path, [2, 3])) == [r for r in rows(read_hits(spark, path)) if r[0] in (2, 3)]
    plan = read_hits(spark, path, [2])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)


def test_later_versions_replace_earlier_ones(spark, tmp_path):
    path, groups = str(tmp_path / "hits"), str(tmp_path / "groups")
    append_hits(from_rows(spark, [(*HIT[:5], 1.0), (3, *HIT[1:])]), path)
    append_hits(from_rows(spark, [(*HIT[:5], 2.0)]), path)
    append_hits(from_rows(spark, [(*HIT[:5], 3.0)]), path, version=5)
    assert rows(read_hits(spark, path)) == [(*HIT[:5], 2.0), (3, *HIT[1:])]
    compact_hits(spark, path)
    assert rows(read_hits(spark, path)) == [(*HIT[:5], 2.0), (3, *HIT[1:])]
    assert log.scan(spark, path, STORED_HITS).count() == 2
    append_hits(from_rows(spark, [(*HIT[:5], 4.0)]), path)
    assert rows(read_hits(spark, path))[0] == (*HIT[:5], 4.0)
    append_groups(from_rows(spark, [GROUP], GROUPS), groups)
    append_groups(from_rows(spark, [(2, 9, *GROUP[2:])], GROUPS), groups)
    assert rows(read_groups(spark, groups)) == [(2, 9, *GROUP[2:])]


def test_strongest_hits_come_first(spark, tmp_path):
    path = str(tmp_path / "hits")
    append_hits(some_hits(spark).unionByName(from_rows(spark, [HIT])), path)
    one = lookups.hits_of_observation(read_hits(spark, path), 2, 1)
    shown = [(r["snr"], r["driftrate"]) for r in one.collect()]
    assert shown == sorted(shown, reverse=True) and (31.5, 0.125) in shown


def test_files_are_in_read_order(spark, tmp_path):
    path = str(tmp_path / "hits")
    append_hits(some_hits(spark), path)
    for file in (tmp_path / "hits").rglob("*.parquet"):
        stored = [(r["observationgroup"], r["observationorder"], -r["snr"], -r["driftrate"]) for r in spark.read.parquet(str(file)).collect()]
        assert stored == sorted(stored)


def test_group_table_and_lookups(spark, tmp_path):
    path = str(tmp_path / "groups")
    append_groups(from_rows(spark, [GROUP, (3, 0, "Vega", *GROUP[3:]), (4, 5, "Vega", *GROUP[3:])], GROUPS), path)
    groups = read_groups(spark, path)
    assert rows(lookups.group_lookup(groups, 2)) == [GROUP]
    assert [r[0] for r in rows(lookups.groups_by_source(groups, "Vega"))] == [3, 4]
    short = lookups.anomalous_groups(groups)
    assert short.columns == ["observationgroup", "grouphit", "source", "mjd", "ra", "dec"]
    assert [r[0] for r in rows(short)] == [2, 4]
    feed = lookups.anomaly_feed(groups)
    assert feed.columns == GROUP_PAGE and feed.count() == 2
    assert group_records(groups).columns == GROUP_PAGE


def test_page_queries(spark):
    hits, groups = from_rows(spark, [HIT]), from_rows(spark, [GROUP], GROUPS)
    assert lookups.answer("1", hits, groups, 2).first()["filename6"] == "scan-6.dat"
    shown = lookups.answer("2", hits, groups, 2, 1)
    assert shown.columns == ["observationgroup", "observationorder", "frequency", "SNR", "driftrate", "uncorrectedfrequency"]
    assert tuple(shown.first()) == HIT
    assert hit_records(hits).first()["SNR"] == 31.5


def test_json_names(spark):
    text = hits_json(from_rows(spark, [HIT])).first()["json"]
    assert json.loads(text) == {
        "observation group": 2,
        "observation number": 1,
        "frequency": 77.25,
        "SNR": 31.5,
        "driftrate": 0.125,
        "uncorrected frequency": 77.5,
    }


def test_last_write_wins(spark):
    written = spark.createDataFrame(
        [(*HIT, 1, None), (*HIT[:5], 9.0, 2, 5), (*HIT[:5], 8.0, 2, 7), (*HIT[:5], 7.0, 2, None), (3, *HIT[1:], 1, 1)],
        "observationgroup int, observationorder int, frequency double, snr double, driftrate double, "
        "uncorrectedfrequency double, batch int, offset int",
    )
    newest = latest(written, HIT_KEY, ["batch", "offset"])
    assert newest.columns == [f.name for f in HITS.fields]
    assert rows(newest) == [(*HIT[:5], 8.0), (3, *HIT[1:])]


def test_filters_on_the_key_go_below_the_upsert(spark, tmp_path):
    path = str(tmp_path / "hits")
    some_hits(spark).withColumn("version", F.lit(1)).write.parquet(path)
    newest = latest(spark.read.parquet(path), HIT_KEY, ["version"]).where("snr > 50 and observationorder = 1")
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(snr,50.0)" in plan and "EqualTo(observationorder,1)" in plan
    assert "Window" not in plan


def test_a_narrow_span_opens_few_files(spark, tmp_path):
    """Slices by frequency and strength: files read for a narrow span, and the same rows as from all."""
    path = str(tmp_path / "hits")
    part = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n))
    made = spark.range(20_000).select(
        part(1, 3).cast("int").alias("observationgroup"),
        (1 + part(2, 6)).cast("int").alias("observationorder"),
        (part(3, 100_000) / 10).alias("frequency"),
        (part(4, 1000) / 10).alias("snr"),
        F.lit(0.5).alias("driftrate"),
        F.lit(0.0).alias("uncorrectedfrequency"),
    )
    append_hits(made, path, version=1)
    append_hits(made.where("observationorder = 1").withColumn("uncorrectedfrequency", F.lit(1.0)), path, version=2)
    append_hits(from_rows(spark, [(1, 1, 5e7, 30.0, 0.5, 0.0), (2, 1, 3.0, 2e6, 0.5, 0.0)]), path, version=3)
    before = rows(read_hits(spark, path))
    assert compact_hits(spark, path, curve=True) and not compact_hits(spark, path, curve=True)
    assert rows(read_hits(spark, path)) == before
    within = {"frequency": (5000.0, 5100.0), "snr": (10.0, 15.0)}
    wanted = [r for r in before if 5000 <= r[2] <= 5100 and 10 <= r[3] <= 15]
    some = read_hits_within(spark, path, within)
    assert rows(some) == wanted and len(wanted) > 3
    everything = len(log.scan(spark, path, STORED_HITS).inputFiles())
    assert everything >= 3 * 16 and len(some.inputFiles()) <= 0.2 * everything
    assert rows(read_hits_within(spark, path, {"frequency": (4e7, 6e7)})) == [(1, 1, 5e7, 30.0, 0.5, 0.0)]
    right = spark.createDataFrame([(0, 700.0), (1, 800.0)], "observationgroup int, frequency double")
    found = stored_semi_join(spark, path, right, 10.0, 1, by=["observationgroup"])
    hits = read_hits(spark, path).where("observationorder = 1")
    assert rows(found) == rows(range_semi_join(hits, right, "frequency", 10.0, by=["observationgroup"])) != []
    append_hits(from_rows(spark, [(1, 1, 799.0, 99.0, 0.5, 9.0)]), path, version=4)  # not in slices, still found
    assert (1, 1, 799.0, 99.0, 0.5, 9.0) in rows(stored_semi_join(spark, path, right, 10.0, 1, by=["observationgroup"]))
    assert rows(stored_semi_join(spark, path, right.limit(0), 10.0, 1)) == []
    with pytest.raises(ValueError):
        read_hits_within(spark, path, {"driftrate": (0, 1)})


def test_scratch_folders_can_be_removed(spark):
    from nearfield import scratch

    table = scratch.stored(spark.range(3), "some")
    path = scratch._MADE[-1]
    assert table.count() == 3 and spark.read.parquet(path).count() == 3
    kept, scratch._MADE[:] = scratch._MADE[:-1], [path]
    assert scratch.clean(spark) == 1 and scratch._MADE == []
    scratch._MADE[:] = kept  # other tests' tables
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
