import os

import duckdb
import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def oracle(testdata):
    con = duckdb.connect()
    for file in os.listdir(testdata):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{testdata}/{file}'")
    return con


def plain(row):
    return tuple(repr(float(v)) if isinstance(v, float) else v for v in row)


def test_flagship(spark):
    assert entry.entry(spark).count() == 8


def own(names):
    return {n for n in names if not (n == "pipeline" or n.startswith("op") and n[2].isdigit())}


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert own(entry.queries()) == own(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(own(entry.oracle_sql())))
def test_query_equals_sql(spark, oracle, testdata, name):
    df = entry.queries()[name](spark, testdata)
    columns = sorted(df.columns)
    cursor = oracle.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    expected = sorted((plain(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=str)
    assert sorted((plain(r) for r in df.select(*columns).collect()), key=str) == expected


def test_results_are_not_empty(spark, testdata):
    for name in ("detect_anomalies", "detect_two_radii", "range_pairs", "range_semi_large", "range_pairs_large", "distance_semi_lsh", "anomaly_feed"):
        assert entry.queries()[name](spark, testdata).limit(1).count() == 1, name


def test_ordered_queries_are_in_order(spark, testdata):
    ids = [r[0] for r in entry.batch_groups(spark, testdata).collect()]
    assert ids == sorted(ids) and len(ids) > 1
    shown = [(-r["snr"], -r["driftrate"]) for r in entry.stored_observation(spark, testdata).collect()]
    assert shown == sorted(shown) and len(shown) > 1


def test_lookups_scan_the_group_table(spark, testdata):
    for name in ("group_lookup", "groups_by_source", "anomalous_groups", "anomaly_feed", "page_group"):
        plan = entry.queries()[name](spark, testdata)._jdf.queryExecution().executedPlan().toString()
        assert "lineitem" not in plan and "Join" not in plan, name
    plan = entry.group_lookup(spark, testdata)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == plan.count("EqualTo(observationgroup,3)") == 1


def test_lsh_finds_nearly_all_exact_matches(spark, testdata):
    found = entry.distance_semi_lsh(spark, testdata)
    exact = entry.distance_pairs_exact(spark, testdata)
    keys = ["observationgroup", "frequency", "snr", "driftrate"]
    exact = exact.select("observationgroup", *[exact[f"{k}_1"].alias(k) for k in keys[1:]]).distinct()
    assert found.join(exact, keys, "left_anti").count() == 0
    assert exact.join(found, keys, "left_anti").count() <= 0.01 * exact.count()


def test_semi_join_of_embeddings_asks_for_all_of_them(spark, testdata):
    found = entry.queries()["distance_semi_lsh_arrays"](spark, "/root/testdata/sf0.01")
    assert {r[0] % 20 for r in found.select("vec_id").collect()} - {0}
    assert "vec_id % 20" not in entry.oracle_sql()["distance_semi_lsh_arrays"]


def test_messages_are_encoded_after_they_are_dealt(spark, testdata):
    """The pass that samples the ends of ranges makes no messages."""
    dealt = entry.messages_by_group(spark, testdata, 4)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange rangepartitioning")
    assert "cast(frequency" in above and "cast(frequency" not in below
    every = entry.messages(spark, testdata).select("value")
    assert dealt.exceptAll(every).isEmpty() and every.exceptAll(dealt).isEmpty()


def test_late_messages_are_those_of_one_order(spark, tmp_path):
    """Also where fields are null, which leaves no place in the message."""
    shape = "l_suppkey bigint, l_linenumber int, l_extendedprice double, l_quantity double, l_discount double, l_tax double"
    rows = [(g, o, p, 1.0, 0.1, 0.0) for g in (1, 2, None) for o in (1, 2, 3, None) for p in (20.0, 2.0, None)]
    spark.createDataFrame(rows, shape).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, 7 * k) for k in range(7, 107, 10)], "o_orderkey bigint, o_custkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    every = [r["value"] for r in entry.messages(spark, str(tmp_path)).collect()]
    early, late = ([r["value"] for r in part.collect()] for part in entry.early_and_late(spark, str(tmp_path)))
    is_late = lambda v: (v.split(";") + [""] * 3)[2] == "2"
    assert sorted(early + late) == sorted(every) and all(map(is_late, late)) and not any(map(is_late, early))
    for part in entry.early_and_late(spark, str(tmp_path)):
        assert "split" not in part._jdf.queryExecution().optimizedPlan().toString()
