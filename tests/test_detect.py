import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from nearfield.plans import detect
from nearfield.plans.detect import Rule
from nearfield.schema import HITS


def random_hits(spark, n=600, groups=3, seed=5, spread=60.0):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        f = round(rng.uniform(0, spread), 1)
        rows.append((rng.randrange(groups), rng.randint(1, 6), f, rng.uniform(0, 100), rng.uniform(-0.2, 1), f + 0.5))
    rows += rows[:20]
    return rows, spark.createDataFrame(rows, HITS)


def brute_stages(rows, rule):
    """Survivors of each stage, per group, by comparing everything."""

    def strong(row):
        drift = abs(row[4]) if rule.abs_drift else row[4]
        return row[3] > (rule.snr_on if row[1] in rule.on_orders else rule.snr_off) and drift > rule.min_drift

    out = {}
    for group in {r[0] for r in rows}:
        of = {o: [r for r in rows if r[0] == group and r[1] == o and strong(r)] for o in range(1, 7)}
        alive = set(of[rule.on_orders[0]])
        stages = []
        for o in rule.on_orders[1:]:
            alive = {a for a in alive if any(a[2] - rule.r_on < b[2] <= a[2] + rule.r_on for b in of[o])}
            stages.append((f"on_{o}", set(alive)))
        for o in rule.off_orders:
            alive = {a for a in alive if not any(a[2] - rule.r_off < b[2] <= a[2] + rule.r_off for b in of[o])}
            stages.append((f"off_{o}", set(alive)))
        out[group] = stages
    return out


RULES = [
    Rule(r_on=1, r_off=0.5),
    Rule(r_on=0.4, r_off=0.4),
    Rule(r_on=2, r_off=0.3, abs_drift=True, snr_on=10, snr_off=50),
    Rule(on_orders=(2,), off_orders=(3,), r_off=0.4, r_on=0.4),
    Rule(on_orders=(1, 3), off_orders=(), r_on=0.4, r_off=0.4),
    Rule(on_orders=(5, 1, 3), off_orders=(6, 2), r_on=0.5, r_off=0.2),
]


@pytest.mark.parametrize("rule", RULES)
def test_against_brute_force(spark, rule):
    rows, hits = random_hits(spark)
    expected = brute_stages(rows, rule)
    found = [tuple(r) for r in detect.detect_anomalies(hits, rule).collect()]
    assert len(found) == len(set(found))
    assert set(found) == set().union(*[stages[-1][1] for stages in expected.values()])
    funnel = {(r[0], r[1]): r[2] for r in detect.detection_funnel(hits, rule).collect()}
    assert funnel == {(g, s): len(alive) for g, stages in expected.items() for s, alive in stages}
    counts = {r["observationgroup"]: r["grouphit"] for r in detect.group_results(hits, rule).collect()}
    assert counts == {g: len(stages[-1][1]) for g, stages in expected.items()}


def test_anchor_is_the_first_on_observation(spark):
    """5 is near 3 but not near 1: no chain."""
    rows = [(1, 1, 0.0, 30.0, 0.1, 0.0), (1, 3, 9.0, 30.0, 0.1, 0.0), (1, 5, 18.0, 30.0, 0.1, 0.0)]
    hits = spark.createDataFrame(rows, HITS)
    assert detect.detect_anomalies(hits, Rule(r_on=10, r_off=10)).count() == 0
    assert detect.detect_anomalies(hits, Rule(r_on=20, r_off=10)).count() == 1


def test_thresholds_are_strict_and_one_sided(spark):
    rows = [(1, 1, 1.0, 25.0, 0.1, 0.0), (1, 1, 2.0, 26.0, 0.0001, 0.0), (1, 1, 3.0, 26.0, -0.5, 0.0), (1, 1, 4.0, 26.0, 0.5, 0.0)]
    hits = spark.createDataFrame(rows, HITS)
    kept = lambda **kw: sorted(r["frequency"] for r in detect.strong(hits, Rule(**kw)).collect())
    assert kept() == [4.0]
    assert kept(abs_drift=True) == [3.0, 4.0]


def test_groups_without_hits_are_reported(spark):
    rows = [(7, 2, 1.0, 1.0, 0.0, 1.0), (8, 1, 1.0, 90.0, 0.5, 1.0)]
    hits = spark.createDataFrame(rows, HITS)
    rule = Rule()
    metadata = spark.createDataFrame([(8, "Vega", 3.5)], "observationgroup int, source string, mjd double")
    got = {r["observationgroup"]: (r["grouphit"], r["source"], r["mjd"]) for r in detect.group_results(hits, rule, metadata).collect()}
    assert got == {7: (0, None, None), 8: (0, "Vega", 3.5)}
    funnel = detect.detection_funnel(hits, rule)
    assert funnel.count() == 2 * 5 and funnel.agg(F.sum("n_hits")).first()[0] == 0


def test_a_group_has_one_row_of_metadata(spark):
    hits = spark.createDataFrame([(8, 1, 1.0, 90.0, 0.5, 1.0)], HITS)
    metadata = spark.createDataFrame([(8, "Vega"), (8, "Altair"), (8, None)], "observationgroup int, source string")
    assert [r["source"] for r in detect.group_results(hits, Rule(), metadata).collect()] == ["Vega"]


def test_a_hit_of_any_size_spoils_nothing(spark):
    rows = [(1, o, f, 90.0, 0.5, f) for o in (1, 3, 5) for f in (1.0, 1e300, -1e300, 1e15 + o)] + [(1, 2, 1e300, 90.0, 0.5, 0.0)]
    hits = spark.createDataFrame(rows, HITS)
    rule = Rule(r_on=10, r_off=10)
    expected = brute_stages(rows, rule)[1][-1][1]
    assert {tuple(r) for r in detect.detect_anomalies(hits, rule).collect()} == expected
    assert {r[2] for r in expected} == {1.0, 1e15 + 1}


def test_nulls_neither_fail_nor_match(spark):
    rows = [(None, 1, 1.0, 90.0, 0.5, 1.0), (1, 1, None, 90.0, 0.5, 1.0), (1, 1, float("nan"), 90.0, 0.5, 1.0),
            (1, 1, 1.0, 90.0, 0.5, 1.0), (1, 3, 1.0, 90.0, 0.5, 1.0), (1, 5, 1.0, 90.0, 0.5, 1.0), (1, 2, None, 90.0, 0.5, 1.0)]
    hits = spark.createDataFrame(rows, HITS)
    assert [r["frequency"] for r in detect.detect_anomalies(hits, Rule(r_on=1, r_off=1)).collect()] == [1.0]


def test_counts_groups_and_roles(spark):
    rows, hits = random_hits(spark)
    rule = Rule()
    counted = {(r[0], r[1]): r[2] for r in detect.observation_counts(hits, rule).collect()}
    expected = {}
    for r in rows:
        if r[3] > (25 if r[1] % 2 else 20) and r[4] > 0.0001:
            expected[(r[0], r[1])] = expected.get((r[0], r[1]), 0) + 1
    assert counted == expected
    assert [r[0] for r in detect.groups_in(hits).collect()] == [0, 1, 2]
    assert tuple(detect.first_group(hits).first()) == (0, 3)
    assert {r[0] for r in hits.where(detect.is_on(F.col("observationorder"))).select("observationorder").collect()} == {1, 3, 5}


def test_refused_rules():
    for bad in ({"on_orders": ()}, {"off_orders": (1, 2)}, {"closed": "?"}):
        with pytest.raises(ValueError):
            Rule(**bad)
    assert dataclasses.replace(Rule(), r_on=1).r_on == 1


def test_radius_is_checked(spark):
    _, hits = random_hits(spark, 10)
    with pytest.raises(ValueError):
        detect.detect_anomalies(hits, Rule(r_on=0, r_off=0))
