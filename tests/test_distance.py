import math
import random

import pytest
from pyspark.sql import functions as F

from nearfield.operators import (
    distance_pairs,
    lsh_semi_join,
    projections,
    scaled_features,
    with_hashes,
    with_vector,
)
from nearfield.operators.distance import HIT_WEIGHTS, squared_distance, squared_distance_arrays

WEIGHTS = {"x": 1.0, "y": 0.1, "z": 2.0}
SCHEMA = "id int, grp int, x double, y double, z double"


def points(seed, n, centre=None):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        near = centre is not None and i % 3 == 0
        x, y, z = centre if near else (rng.uniform(-1, 1), rng.uniform(-10, 10), rng.uniform(-0.5, 0.5))
        out.append((i, rng.randrange(2), x + rng.uniform(0, 0.05) * near, y, z))
    return out


def near_pairs(left, right, t, by=True):
    def squared(a, b):
        return sum((a[i + 2] - b[i + 2]) * (a[i + 2] - b[i + 2]) * (w * w) for i, w in enumerate(WEIGHTS.values()))

    return sorted((a[0], b[0]) for a in left for b in right if (not by or a[1] == b[1]) and squared(a, b) <= t * t)


@pytest.mark.parametrize("t, axes", [(0.05, 3), (0.2, 3), (1.0, 3), (0.2, 1), (0.2, 2)])
def test_pairs_against_brute_force(spark, t, axes):
    left, right = points(1, 120), points(2, 110)
    lhs, rhs = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    found = distance_pairs(lhs, rhs, WEIGHTS, t, by=["grp"], grid_axes=axes)
    assert sorted((r["id_left"], r["id_right"]) for r in found.collect()) == near_pairs(left, right, t)


def test_hot_spot(spark):
    left, right = points(3, 150, (0.1, 1.0, 0.1)), points(4, 150, (0.1, 1.0, 0.1))
    lhs, rhs = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    expected = near_pairs(left, right, 0.02, by=False)
    found = distance_pairs(lhs, rhs, WEIGHTS, 0.02, pair_side=4)
    assert sorted((r["id_left"], r["id_right"]) for r in found.collect()) == expected
    assert len(expected) > 400


def test_array_points(spark):
    left, right = points(5, 80), points(6, 80)
    make = lambda rows: scaled_features(spark.createDataFrame(rows, SCHEMA), WEIGHTS).select(
        "id", "grp", F.array("nx", "ny", "nz").alias("p")
    )
    found = distance_pairs(make(left), make(right), "p", 0.3, by=["grp"])
    assert sorted((r["id_left"], r["id_right"]) for r in found.collect()) == near_pairs(left, right, 0.3)


def test_points_without_a_place_match_nothing(spark):
    rows = [(0, 1, None, 1.0, 1.0), (1, 1, math.nan, 1.0, 1.0), (2, 1, math.inf, 1.0, 1.0), (3, 1, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = distance_pairs(df, df, WEIGHTS, 1)
    assert [(r["id_left"], r["id_right"]) for r in found.collect()] == [(3, 3)]


def test_the_edge_belongs_to_the_exact_join(spark):
    one = spark.createDataFrame([(0, 0.0)], "id int, x double")
    two = spark.createDataFrame([(0, 0.5), (1, 0.5000001)], "id int, x double")
    found = distance_pairs(one, two, {"x": 1.0}, 0.5)
    assert [r["id_right"] for r in found.collect()] == [0]
    lsh = lsh_semi_join(one, two.where("id = 0"), {"x": 1.0}, within=0.5, bucket_length=50.0)
    assert lsh.count() == 0


def test_distance_expressions(spark):
    row = spark.range(1).select(
        squared_distance([F.lit(1.0), F.lit(2.0)], [F.lit(4.0), F.lit(6.0)], [1.0, 0.5]).alias("a"),
        squared_distance_arrays(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(4.0), F.lit(6.0))).alias("b"),
    )
    assert tuple(row.first()) == (13.0, 25.0)


def test_features(spark):
    hits = spark.createDataFrame([(5000.0, 50.0, 0.5)], "frequency double, snr double, driftrate double")
    made = with_vector(scaled_features(hits), ["n" + n for n in HIT_WEIGHTS])
    assert list(made.first()["features"]) == [0.5, 0.5, 0.5]
    hashes = with_hashes(hits, HIT_WEIGHTS, 0.1, 4).first()["hashes"]
    assert hashes == [math.floor(sum(0.5 * x for x in v) / 0.1) for v in projections(3)]
    lengths = [math.dist(v, [0] * 64) for v in projections(64, 5)]
    assert all(abs(n - 1) < 1e-12 for n in lengths) and projections(64, 5) == projections(64, 5)


def test_far_points(spark):
    """Coordinates whose neighbours are further apart than the radius, on any axis."""
    rng = random.Random(5)
    sizes = [0.0, 1.0, 1e15, 3e16, -1e300, 1e300]
    left = [(i, 0, rng.choice(sizes), rng.choice(sizes), rng.choice(sizes)) for i in range(60)]
    right = [(i, 0, *[math.nextafter(c, rng.choice((-1, 1)) * math.inf) if rng.random() < 0.3 else c for c in p[2:]]) for i, p in enumerate(left)]
    lhs, rhs = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    for t in (0.5, 3.0):
        found = distance_pairs(lhs, rhs, WEIGHTS, t)
        assert sorted((r["id_left"], r["id_right"]) for r in found.collect()) == near_pairs(left, right, t, by=False)


def lsh_setup(spark, seed=9, n=400):
    rng = random.Random(seed)
    left = [(i, rng.randrange(2), rng.random(), rng.random(), rng.random()) for i in range(n)]
    # Near most left points there is a right one.
    right = [
        (i, a[1], *[c + rng.uniform(-0.004, 0.004) for c in a[2:]]) for i, a in enumerate(left) if rng.random() < 0.7
    ]
    weights = {"x": 1.0, "y": 1.0, "z": 1.0}
    return left, right, spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), weights


def test_lsh_precision_and_recall(spark):
    left, right, lhs, rhs, weights = lsh_setup(spark)
    t = 0.01
    exact = {a[0] for a in left for b in right if a[1] == b[1] and math.dist(a[2:], b[2:]) < t}
    found = [r["id"] for r in lsh_semi_join(lhs, rhs, weights, t, bucket_length=10 * t, by=["grp"]).collect()]
    assert len(found) == len(set(found))
    assert set(found) <= exact
    assert len(found) >= 0.99 * len(exact) and len(exact) > 200


def by_definition(left, right, t, bucket, tables, dimensions):
    def hashes(p):
        return [math.floor(sum(c * x for c, x in zip(p, v)) / bucket) for v in projections(dimensions, tables)]

    near = lambda a, b: math.dist(a, b) < t and any(x == y for x, y in zip(hashes(a), hashes(b)))
    return sorted(i for i, a in left if any(near(a, b) for _, b in right))


def test_lsh_is_a_shared_bucket_and_a_distance(spark):
    left, right, lhs, rhs, weights = lsh_setup(spark)
    t, bucket = 0.01, 0.004
    expected = by_definition([(a[0], a[2:]) for a in left], [(b[0], b[2:]) for b in right], t, bucket, 2, 3)
    ours = lsh_semi_join(lhs, rhs, weights, t, bucket_length=bucket, tables=2)
    assert sorted(r["id"] for r in ours.collect()) == expected
    exact = lsh_semi_join(lhs, rhs, weights, t, bucket_length=100.0, tables=2).count()
    assert 50 < len(expected) < exact


def test_lsh_on_arrays(spark):
    rng = random.Random(3)
    left = [(i, [rng.gauss(0, 1) for _ in range(12)]) for i in range(120)]
    right = [(i, [c + rng.gauss(0, 0.02) for c in p]) for i, p in left[::2]] + [(500, [1e300] * 12)]
    lhs, rhs = (spark.createDataFrame(rows, "id int, p array<double>") for rows in (left, right))
    found = lsh_semi_join(lhs, rhs, "p", 0.1, bucket_length=0.3, tables=3, dimensions=12)
    expected = by_definition(left, right[:-1], 0.1, 0.3, 3, 12)
    assert sorted(r["id"] for r in found.collect()) == expected and len(expected) > 40
    with pytest.raises(ValueError, match="dimensions"):
        lsh_semi_join(lhs, rhs, "p", 0.1)


def test_refused_arguments(spark):
    df = spark.createDataFrame([(0, 1.0)], "id int, x double")
    for radius, error in ((0, ValueError), (-1, ValueError), (math.nan, ValueError), ("1", TypeError), (True, TypeError)):
        with pytest.raises(error):
            distance_pairs(df, df, {"x": 1.0}, radius)
        with pytest.raises(error):
            lsh_semi_join(df, df, {"x": 1.0}, radius)
    with pytest.raises(ValueError):
        distance_pairs(df, df, {}, 1)
    with pytest.raises(ValueError):
        distance_pairs(df, df, {"x": 1.0}, 1, grid_axes=4)
