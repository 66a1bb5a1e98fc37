import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nearfield.functions.intervals import interval_micros
from nearfield.operators import range_anti_join, range_pairs, range_semi_join


def matches(c1, c2, r, closed="right"):
    if c1 is None or c2 is None or any(isinstance(c, float) and not math.isfinite(c) for c in (c1, c2)):
        return False
    low, high = c1 - r, c1 + r
    above = c2 >= low if closed in ("left", "both") else c2 > low
    below = c2 <= high if closed in ("right", "both") else c2 < high
    return above and below


def frame(spark, values, dtype="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, c {dtype}")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def check(spark, left, right, r, closed="right", dtype="double", **options):
    lhs, rhs = frame(spark, left, dtype), frame(spark, right, dtype)
    semi = [i for i, c in enumerate(left) if any(matches(c, d, r, closed) for d in right)]
    anti = [i for i in range(len(left)) if i not in set(semi)]
    assert ids(range_semi_join(lhs, rhs, "c", r, closed=closed)) == semi
    assert ids(range_anti_join(lhs, rhs, "c", r, closed=closed)) == anti
    pairs = sorted((i, j) for i, c in enumerate(left) for j, d in enumerate(right) if matches(c, d, r, closed))
    found = range_pairs(lhs, rhs, "c", r, closed=closed, **options)
    assert sorted((x["id_left"], x["id_right"]) for x in found.collect()) == pairs


@pytest.mark.parametrize(
    "left, right, r, closed, expected",
    [
        (10.0, 20.0, 10, "right", True),
        (20.0, 10.0, 10, "right", False),
        (20.0, 10.0, 10, "left", True),
        (10.0, 20.0, 10, "left", False),
        (10.0, 20.0, 10, "both", True),
        (10.0, 20.0, 10, "neither", False),
        (0.3, 0.4, 0.1, "right", True),
        (-0.05, 0.0, 0.1, "right", True),
        (None, 0.0, 1, "right", False),
        (math.nan, 0.0, 1, "right", False),
        (math.nan, math.nan, 1, "both", False),
        (0.0, None, 1, "right", False),
        (0.0, math.nan, 1, "right", False),
        (0.0, math.inf, 1, "right", False),
    ],
)
def test_edges(spark, left, right, r, closed, expected):
    lhs, rhs = frame(spark, [left]), frame(spark, [right])
    assert ids(range_semi_join(lhs, rhs, "c", r, closed=closed)) == ([0] if expected else [])
    assert ids(range_anti_join(lhs, rhs, "c", r, closed=closed)) == ([] if expected else [0])
    assert range_pairs(lhs, rhs, "c", r, closed=closed).count() == int(expected)


@pytest.mark.parametrize(
    "r, closed",
    [(0.1, "right"), (0.3, "right"), (1, "right"), (10, "right"), (0.1, "left"), (0.3, "both"), (1, "neither")],
)
def test_grid_values(spark, r, closed):
    """Values on a grid of the radius' own fineness: most pairs at exactly the radius."""
    rng = random.Random(7)
    left = [rng.randrange(-200, 200) / 10 for _ in range(150)] + [None, math.nan, math.inf]
    right = [rng.randrange(-200, 200) / 10 for _ in range(40)] + [None, math.nan, -math.inf]
    check(spark, left, right, r, closed)


@pytest.mark.parametrize("pair_side", [2, 7])
def test_crowded_cells_are_split_without_change(spark, pair_side):
    """A third of both sides in one spot."""
    rng = random.Random(11)
    left = [5.0] * 40 + [rng.uniform(0, 100) for _ in range(80)]
    right = [5.5] * 30 + [rng.uniform(0, 100) for _ in range(60)]
    check(spark, left, right, 0.7, pair_side=pair_side)


def test_dense_cells_without_a_match(spark):
    """Many right values in the cells around, none in reach."""
    left = [10.0 + i / 1000 for i in range(100)]
    right = [11.2 + i / 1000 for i in range(100)] + [8.5 + i / 1000 for i in range(100)]
    check(spark, left, right, 1.0)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    left=st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=15),
    right=st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=15),
    r=st.floats(0.01, 1e6),
)
def test_any_values(spark, left, right, r):
    check(spark, left, right, r)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    centre=st.floats(-1e5, 1e5),
    steps=st.lists(st.integers(-4, 4), min_size=1, max_size=12),
    r=st.floats(0.001, 10),
)
def test_values_at_multiples_of_the_radius(spark, centre, steps, r):
    check(spark, [centre, centre + r / 3], [centre + k * r for k in steps] + [centre + k * r / 2 for k in steps], r)


def test_integer_keys(spark):
    rng = random.Random(3)
    left, right = ([rng.randrange(-300, 300) for _ in range(60)] for _ in range(2))
    check(spark, left, right, 1, dtype="int")
    check(spark, left, right, 2, closed="neither", dtype="int")
    check(spark, left, right, 7, closed="left", dtype="int")
    check(spark, left, right, 2.5, dtype="int")


def test_large_bigint_keys_stay_exact(spark):
    top = 2**63 - 1
    left = [top, top - 1, 2**53, -(2**63), 0]
    right = [top - 2, 2**53 + 1, -(2**63) + 1]
    check(spark, left, right, 1, dtype="bigint")
    check(spark, left, right, 2, "both", dtype="bigint")


def test_decimal_keys_stay_exact(spark):
    left = [Decimal(f"{i}.{j:02d}") for i in (-1, 0, 1) for j in range(0, 100, 7)] + [None]
    right = [Decimal("0.10"), Decimal("0.40"), Decimal("-1.30"), None]
    check(spark, left, right, Decimal("0.3"), dtype="decimal(20,2)")
    lhs, rhs = frame(spark, left, "decimal(20,2)"), frame(spark, right, "decimal(20,2)")
    expected = [i for i, c in enumerate(left) if any(matches(c, d, Decimal("0.3")) for d in right)]
    assert ids(range_semi_join(lhs, rhs, "c", 0.3)) == expected
    with pytest.raises(TypeError):
        range_semi_join(frame(spark, [], "decimal(38,10)"), rhs, "c", 1)


@pytest.mark.parametrize("dtype", ["timestamp", "timestamp_ntz"])
def test_timestamps(spark, dtype):
    base = dt.datetime(2024, 3, 10, 1, 30)
    left = [base + dt.timedelta(seconds=s) for s in (0, 599, 600, 601, 5000)] + [None]
    right = [base + dt.timedelta(seconds=s) for s in (-600, 0, 1200)]
    lhs, rhs = frame(spark, left, dtype), frame(spark, right, dtype)
    radius = dt.timedelta(minutes=10)
    for closed in ("right", "left"):
        expected = [i for i, c in enumerate(left) if any(matches(c, d, radius, closed) for d in right)]
        for text in ("10 minutes", "INTERVAL 9 minutes 60 seconds"):
            assert ids(range_semi_join(lhs, rhs, "c", text, closed=closed)) == expected
        assert ids(range_anti_join(lhs, rhs, "c", "10 minutes", closed=closed)) == [
            i for i in range(len(left)) if i not in expected
        ]
    pairs = range_pairs(lhs, rhs, "c", "10 minutes")
    assert pairs.count() == sum(matches(c, d, radius) for c in left for d in right)


def test_microsecond_radius(spark):
    base = dt.datetime(2024, 1, 1)
    left = [base + dt.timedelta(microseconds=s) for s in range(6)]
    right = [base + dt.timedelta(microseconds=3)]
    lhs, rhs = frame(spark, left, "timestamp_ntz"), frame(spark, right, "timestamp_ntz")
    assert ids(range_semi_join(lhs, rhs, "c", "1 microsecond")) == [2, 3]
    assert range_pairs(lhs, rhs, "c", "1 microsecond").count() == 2


def test_wall_clock_times_ignore_the_session_zone(spark):
    """02:30 and 03:30 are an hour apart also on the night a zone skips that hour."""
    lhs = frame(spark, [dt.datetime(2024, 3, 10, 1, 30)], "timestamp_ntz")
    rhs = frame(spark, [dt.datetime(2024, 3, 10, 3, 30)], "timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert ids(range_semi_join(lhs, rhs, "c", "2 hours")) == [0]
        assert ids(range_semi_join(lhs, rhs, "c", "119 minutes")) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_mixed_timestamp_types(spark):
    lhs = frame(spark, [dt.datetime(2024, 1, 1, 0, 0)], "timestamp_ntz")
    rhs = lhs.select("id", F.expr("timestamp '2024-01-01 00:10:00'").alias("c"))
    assert ids(range_semi_join(lhs, rhs, "c", "10 minutes")) == [0]
    assert ids(range_semi_join(rhs, lhs, "c", "10 minutes")) == []


def test_equal_keys_names_and_extra_columns(spark):
    left = spark.createDataFrame(
        [("a", 1.0, "p"), ("a", 1.0, "p"), ("b", 1.0, "q"), (None, 1.0, "r"), ("c", 1.0, "s")],
        "grp string, x double, tag string",
    )
    right = spark.createDataFrame([("a", 1.5, 1), ("b", 5.0, 2), (None, 1.0, 3)], "grp string, y double, other int")
    semi = range_semi_join(left, right, ("x", "y"), 1, by=["grp"])
    assert semi.columns == left.columns
    assert [tuple(r) for r in semi.collect()] == [("a", 1.0, "p")]
    anti = range_anti_join(left, right, ("x", "y"), 1, by=["grp"])
    assert sorted(r["tag"] for r in anti.collect()) == ["q", "r", "s"]
    pairs = range_pairs(left, right, ("x", "y"), 1, by=["grp"], suffixes=("_1", "_2"))
    assert pairs.columns == ["grp_1", "x_1", "tag_1", "grp_2", "y_2", "other_2"]
    assert pairs.count() == 2


def test_hot_rows_without_keys(spark):
    """Many left rows without a key or group: they spread, and the anti-join keeps them."""
    rows = [(None, 1.0, i % 50) for i in range(200)] + [("a", None, i % 40) for i in range(200)]
    rows += [("a", math.nan, i) for i in range(20)] + [("a", 1.0, 0), ("a", 5.0, 1)]
    left = spark.createDataFrame(rows, "grp string, c double, tag int")
    right = spark.createDataFrame([("a", 1.0), (None, 1.0), ("a", None)], "grp string, c double")
    assert range_anti_join(left, right, "c", 1, by=["grp"]).count() == 50 + 40 + 20 + 1
    assert range_semi_join(left, right, "c", 1, by=["grp"]).count() == 1


def test_both_sides_from_one_table(spark):
    table = spark.createDataFrame([(1, 1.0), (2, 1.4), (1, 9.0), (2, 7.0)], "side int, c double")
    one, two = table.where("side = 1"), table.where("side = 2")
    assert [r["c"] for r in range_semi_join(one, two, "c", 1).collect()] == [1.0]
    assert [r["c"] for r in range_anti_join(one, two, "c", 1).collect()] == [9.0]
    assert [(r["c_left"], r["c_right"]) for r in range_pairs(one, two, "c", 1).collect()] == [(1.0, 1.4)]
    assert range_semi_join(table, table, "c", 1, by=["side"]).count() == 4


def test_pairs_keep_copies(spark):
    left = spark.createDataFrame([("a", 1.0)] * 5 + [("b", 2.0)], "id string, c double")
    right = spark.createDataFrame([(1.2,)] * 3, "c double")
    for split in ({}, {"pair_side": 2}):
        pairs = range_pairs(left, right, "c", 0.5, **split)
        assert pairs.count() == 15
        assert {r["id_left"] for r in pairs.collect()} == {"a"}


def test_empty_sides(spark):
    empty, some = frame(spark, []), frame(spark, [1.0, 2.0])
    assert range_semi_join(empty, some, "c", 1).count() == 0
    assert range_semi_join(some, empty, "c", 1).count() == 0
    assert ids(range_anti_join(some, empty, "c", 1)) == [0, 1]
    assert range_pairs(some, empty, "c", 1).count() == 0


def test_refused_arguments(spark):
    numbers = frame(spark, [1.0])
    stamps = frame(spark, [dt.datetime(2024, 1, 1)], "timestamp")
    text = frame(spark, ["x"], "string")
    for join in (range_semi_join, range_anti_join, range_pairs):
        for radius in (0, -1, math.nan, math.inf):
            with pytest.raises(ValueError):
                join(numbers, numbers, "c", radius)
        for left, right, radius in (
            (numbers, stamps, 1),
            (stamps, stamps, 1),
            (numbers, numbers, "1 minute"),
            (text, text, 1),
            (numbers, numbers, True),
        ):
            with pytest.raises(TypeError):
                join(left, right, "c", radius)
        for radius in ("1 month", "1 year 2 days", "soon", "0 seconds", ""):
            with pytest.raises(ValueError):
                join(stamps, stamps, "c", radius)
        with pytest.raises(ValueError):
            join(numbers, numbers, "c", 1, closed="sometimes")


def test_equal_keys_of_two_types_are_refused(spark):
    left = spark.createDataFrame([(1, 1.0)], "grp int, c double")
    right = spark.createDataFrame([(1, 1.0)], "grp bigint, c double")
    for join in (range_semi_join, range_anti_join, range_pairs):
        with pytest.raises(TypeError, match="one type"):
            join(left, right, "c", 1, by=["grp"])


def test_large_keys_match_as_doubles_do(spark):
    far = [1.0, 5.0, 1e15, 1e15 + 3, 1e15 + 12, -1e15, 3e16, 3e16 + 8, 9e18, math.nextafter(9e18, math.inf), -1e300, 1e300, 1.7e308, 0.0]
    check(spark, far, far, 10)
    check(spark, far, far, 10, "both")
    check(spark, far, far, 1e-6, "left")
    check(spark, far, far, 1e300)


@pytest.mark.parametrize("r", [1.0, 0.3, 7e10])
def test_around_the_ends_of_equal_cells(spark, r):
    """Neighbouring doubles around the sizes from which cells are runs of doubles."""
    keys = []
    for bits, radii in ((50, 1.5), (47, 4), (46, 6), (52, 1), (53, 1), (54, 1)):
        edge = 2.0**bits * radii * r
        for start in (edge, 2.0 ** math.floor(math.log2(edge))):
            key = start
            for _ in range(9):
                keys.append(key)
                key = math.nextafter(key, -math.inf)
            keys += [math.nextafter(start, math.inf), start + r, start - r, start + 3 * r, -start]
    check(spark, keys, keys[::2], r)
    check(spark, keys, keys[::3], r, "both")


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    left=st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=12),
    steps=st.lists(st.tuples(st.integers(0, 11), st.integers(-20, 20)), min_size=1, max_size=12),
    r=st.sampled_from([1e-200, 1e-3, 1.0, 10.0, 1e12]),
)
def test_any_finite_values(spark, left, steps, r):
    right = []
    for at, n in steps:
        key = left[at % len(left)]
        for _ in range(abs(n)):
            key = math.nextafter(key, math.copysign(math.inf, n))
        right.append(key)
    check(spark, left, right, r)


def test_tiny_radii_are_refused(spark):
    with pytest.raises(ValueError, match="at least"):
        range_semi_join(frame(spark, [1.0]), frame(spark, [1.0]), "c", 1e-290)


def test_interval_text():
    assert interval_micros("10 minutes") == 600_000_000
    assert interval_micros("interval 1 hour 30 seconds") == 3_630_000_000
    assert interval_micros("1.5 milliseconds") == 1_500
    with pytest.raises(ValueError):
        interval_micros("0.1 microseconds")
