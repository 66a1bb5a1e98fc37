import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.operators import wide
from nearfield.operators.wide import Table, exact_pairs, fit, fit_rotation, fit_table, wide_pairs, wide_semi_join

POINTS = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("g", T.IntegerType()), T.StructField("v", T.ArrayType(T.DoubleType()))]
)


def near_pairs(left, right, within):
    return {
        (i, j)
        for i, g, v in left
        for j, h, w in right
        if i != j and g == h and math.dist(v, w) < within
    }


def clustered(n, dimensions, seed, spread=0.05, groups=1):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dimensions)] for _ in range(n // 5)]
    out = []
    for k in range(n):
        c, scale = rng.choice(centres), rng.choice((0.5, 1.0, 3.0))
        out.append((k, rng.randrange(groups), [scale * (x + rng.gauss(0, spread)) for x in c]))
    return out


@pytest.fixture(scope="module")
def embeddings(spark):
    return spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")


def test_recall_and_work_on_embeddings(spark, embeddings):
    """Against brute force without buckets: nine of ten pairs and more, meeting a tenth of all pairs at most."""
    rows = embeddings.toPandas()
    vectors = np.stack(rows["embedding"]).astype(float)
    asked = np.flatnonzero(rows["vec_id"] % 20 == 0)
    queries = embeddings.where("vec_id % 20 = 0")
    table = fit_table(queries, embeddings, "embedding", 1.1, 0.9)
    met = wide._reach(
        wide.codes(vectors[asked], table, table.left), wide.codes(vectors, table, table.right), table.directions, [table.right], False
    ).reshape(-1, len(asked)) <= table.left
    met = sum(int(m.sum()) for m in met) - len(asked)
    assert met <= 0.1 * len(asked) * len(vectors)
    truth = {
        (int(rows["vec_id"][a]), int(rows["vec_id"][b]))
        for a in asked
        for b in np.flatnonzero(np.linalg.norm(vectors - vectors[a], axis=1) < 1.1)
        if a != b
    }
    found = {(r.left_id, r.right_id) for r in wide_pairs(queries, embeddings, "embedding", 1.1, "vec_id", table=table).collect()}
    assert found <= truth and len(found) >= 0.9 * len(truth)
    semi = {r.vec_id for r in wide_semi_join(queries, embeddings, "embedding", 1.1, table=table, other="vec_id").collect()}
    assert semi == {a for a, _ in found}


def test_finds_near_rows_of_clusters(spark):
    rows = clustered(400, 24, 1, groups=2)
    df = spark.createDataFrame(rows, POINTS)
    truth = near_pairs(rows, rows, 1.0)
    got = [(r.left_id, r.right_id, r.distance) for r in wide_pairs(df, df, "v", 1.0, "id", 0.95, by=["g"]).collect()]
    assert len(got) == len({g[:2] for g in got}) and {g[:2] for g in got} <= truth
    assert len(got) >= 0.9 * len(truth) > 100
    assert all(d == pytest.approx(math.dist(rows[i][2], rows[j][2])) for i, j, d in got)
    semi = [r.id for r in wide_semi_join(df, df, "v", 1.0, 0.95, by=["g"], other="id").collect()]
    ends = {i for i, _ in truth}
    assert len(semi) == len(set(semi)) and set(semi) <= ends and len(semi) >= 0.9 * len(ends)


def test_a_crowded_bucket_loses_nothing(spark):
    """Half of all rows are one vector, and few pairs make a task's share: parts meet each other."""
    rng = random.Random(3)
    rows = [(k, 0, [1.0] * 16 if k % 2 else [rng.gauss(0, 1) for _ in range(16)]) for k in range(200)]
    df = spark.createDataFrame(rows, POINTS)
    table = Table(16, 128, 4, 2)
    got = {(r.left_id, r.right_id) for r in wide_pairs(df, df, "v", 0.5, "id", table=table, pair_side=10).collect()}
    assert got == near_pairs(rows, rows, 0.5) and len(got) == 100 * 99


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0, 0.0], [1.0], [1.0, 0.01, 0.0], None, [nan, 0.0, 0.0], [inf, 0.0, 0.0], [1.0, None, 0.0], [], [0.0, 0.0, 0.0]]
    rows = [(k, None if k == 2 else 1, v) for k, v in enumerate(vectors)] + [(0, 1, [1.0, 0.0, 0.0]), (None, 1, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, POINTS).withColumn("__v", F.lit(1)).withColumn("buckets", F.lit(2))
    semi = sorted((r.id for r in wide_semi_join(df, df, "v", 0.1, by=["g"], other="id").collect()), key=repr)
    assert semi == [0, 0, 1, 7, 8, None]
    assert sorted(r.id or 0 for r in wide_semi_join(df, df, "v", 0.1, by=["g"]).collect()) == [0, 0, 0, 1, 7, 8]
    none = spark.createDataFrame([], POINTS)
    assert wide_semi_join(df, none, "v", 0.1).isEmpty() and wide_pairs(none, df, "v", 0.1, "id").isEmpty()
    for radius in (0, -1, nan):
        with pytest.raises(ValueError):
            wide_semi_join(df, df, "v", radius)


def test_settings_follow_data_and_target():
    rng = np.random.default_rng(1)
    apart = rng.standard_normal((300, 64))
    apart /= np.linalg.norm(apart, axis=1, keepdims=True)
    close, wider = fit(apart, apart, 0.3, 0.95), fit(apart, apart, 1.1, 0.9)
    assert close.found >= 0.95 and close.met < 0.01 < wider.met < 0.12 and wider.found >= 0.9
    # nothing is far: one bucket for all is exact
    assert fit(apart, apart, 3.0, 0.9).met > 0.9
    assert fit(apart[:0], apart, 1.0, 0.9).directions == 2


def exact(left, right, within):
    pairs = {(i, j) for i, g, v in left for j, h, w in right if i != j and g == h and math.dist(v, w) <= within}
    return sorted(pairs, key=repr)


def found_pairs(*args, **options):
    rows = exact_pairs(*args, **options).collect()
    return sorted(((r.left_id, r.right_id) for r in rows), key=repr)


@pytest.mark.parametrize("dimensions", [1, 2, 3, 5, 24, 300])
def test_exact_pairs_equal_brute_force(spark, dimensions):
    rows = clustered(150, dimensions, dimensions, groups=2)
    df = spark.createDataFrame(rows, POINTS)
    for within in (0.05, 1.0):
        assert found_pairs(df, df, "v", within, "id", by=["g"]) == exact(rows, rows, within)


def test_rotation_loses_nothing(spark):
    """Points on a grid, whose distances equal the radius, far from the origin; any rotation and part size."""
    rng = np.random.default_rng(2)
    rows = [(k, 0, [1e6 + float(x) for x in rng.integers(0, 3, 8)]) for k in range(120)]
    df, truth = spark.createDataFrame(rows, POINTS), exact(rows, rows, 2.0)
    turn, _ = np.linalg.qr(rng.standard_normal((8, 8)))
    assert found_pairs(df, df, "v", 2.0, "id") == truth
    assert found_pairs(df, df, "v", 2.0, "id", rotation=turn, pair_side=7) == truth
    # a radius that rounding in the rotation would cover
    tiny = spark.createDataFrame([(1, 0, [1e15, 2.0, 3.0]), (2, 0, [1e15, 2.0, 3.0]), (3, 0, [1e15, 2.0, 3.5])], POINTS)
    assert found_pairs(tiny, tiny, "v", 0.1, "id") == [(1, 2), (2, 1)]


def test_odd_rows_of_exact_pairs(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0, 0.0], [1.0], [1.0, 0.05, 0.0], None, [nan, 0.0, 0.0], [inf, 0.0, 0.0], [1.0, None, 0.0], [], [0.0, 0.0, 0.0]]
    rows = [(k, None if k == 2 else 1, v) for k, v in enumerate(vectors)] + [(0, 1, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, POINTS).withColumn("__p", F.lit(1))
    assert found_pairs(df, df, "v", 0.1, "id", by=["g"]) == [(0, 1), (1, 0), (7, 8), (8, 7)]
    assert (0, 2) in found_pairs(df, df, "v", 0.1, "id")
    none = spark.createDataFrame([], POINTS)
    assert found_pairs(df, none, "v", 0.1, "id") == found_pairs(none, none, "v", 0.1, "id") == []


def test_share_of_pairs_that_reach_the_whole_distance(spark, embeddings):
    """Random directions: nothing separates them, and still few pairs need all their coordinates. Where the
    vectors lie near a plane, the grid and the first coordinates leave hardly any."""
    queries = embeddings.where("vec_id % 20 = 0")
    reached = exact_pairs(queries, embeddings, "embedding", 1.1, "vec_id", tested=False).count()
    assert reached <= 0.2 * queries.count() * embeddings.count()
    rng = np.random.default_rng(4)
    plane, _ = np.linalg.qr(rng.standard_normal((40, 2)))
    rows = [(k, 0, (plane @ rng.uniform(-1, 1, 2) + rng.normal(0, 0.001, 40)).tolist()) for k in range(600)]
    df = spark.createDataFrame(rows, POINTS)
    turn = fit_rotation(df, df, "v")
    assert np.allclose(turn @ turn.T, np.eye(40)) and np.allclose(np.linalg.norm(turn[2:] @ plane), 0, atol=0.01)
    reached = exact_pairs(df, df, "v", 0.05, "id", tested=False).count()
    truth = exact(rows, rows, 0.05)
    assert found_pairs(df, df, "v", 0.05, "id") == truth and len(truth) <= reached <= 1.1 * len(truth) + 10


def test_exact_semi_join_misses_nothing(spark, embeddings):
    """Buckets that hardly any near pair shares: what they miss is found among all others, part by part."""
    points = embeddings.where("vec_id < 600")
    rows = points.orderBy("vec_id").toPandas()
    vectors = np.stack(rows["embedding"]).astype(float)
    far = np.linalg.norm(vectors[:, None] - vectors[None], axis=2) + 9 * np.eye(len(vectors))
    truth = set(rows["vec_id"][(far < 1.1).any(axis=1)])
    for table, side in ((Table(64, 1024, 1, 1), 100), (Table(64, 2, 1, 1), 100), (Table(64, 1024, 1, 1), 10_000)):
        got = wide_semi_join(points, points, "embedding", 1.1, other="vec_id", table=table, exact=True, block_rows=side)
        assert {r.vec_id for r in got.collect()} == truth and len(truth) > 100


def test_pairs_are_tested_by_blocks(spark, embeddings):
    """No row meets another one in a join of the JVM, and settings weigh copies of rows against pairs."""
    queries = embeddings.where("vec_id % 20 = 0")
    plan = exact_pairs(queries, embeddings, "embedding", 1.1, "vec_id")._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "zip_with" not in plan
    vectors = np.stack(embeddings.toPandas()["embedding"]).astype(float)[:500]
    many, few = fit(vectors, vectors, 1.1, 0.98), fit(vectors, vectors, 1.1, 0.98, copy=2_000 / 100_000)
    assert few.left + few.right < (many.left + many.right) / 10
