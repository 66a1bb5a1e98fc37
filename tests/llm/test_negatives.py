import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.llm import negatives

VECTORS = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())]
)


def expected(rows, every=100, count=5):
    """All rows of the result by sorting all scores of every anchor."""
    kept = []
    for i, v, label in rows:
        if i is None or v is None or label is None or not all(x is not None and math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for i, v, label in {(i, tuple(v), label) for i, v, label in kept if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), k, own) for k, w, own in kept if k != i)
        for p, positive, own in [s for s in scored if s[2] == label][:count]:
            good = [(n, k) for n, k, theirs in scored if theirs != label and 80 * -p <= 100 * -n <= 100 * -p]
            out += [(i, positive, r, k, -p, -n) for r, (n, k) in enumerate(good[:count], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in negatives.mined_embeddings(df).collect())


def made(seed, n, width=16, spread=1.0, labels=3):
    rng = random.Random(seed)
    return [(k, [rng.gauss(0.1, spread) for _ in range(width)], rng.randrange(labels)) for k in range(n)]


def test_equals_sorting(spark):
    rows = made(1, 700)
    assert found(spark.createDataFrame(rows, VECTORS)) == expected(rows)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "FEW_ROWS", 40)
    monkeypatch.setattr(negatives, "ANCHORS", 2)
    monkeypatch.setattr(negatives, "TILE", (2, 7))
    rows = made(2, 600)
    assert found(spark.createDataFrame(rows, VECTORS)) == expected(rows)


def test_odd_rows(spark):
    rows = made(3, 300)
    nan, inf = float("nan"), float("inf")
    rows += [
        (None, [0.5] * 16, 1), (301, None, 1), (302, [0.5] * 16, None), (303, [0.5] * 15 + [None], 1), (304, [nan] * 16, 1),
        (305, [inf] + [0.0] * 15, 1), (306, [], 1), (307, [0.5] * 3, 1), (400, [0.0] * 16, 0), (500, [-1.0] * 16, 2),
        (308, rows[5][1], rows[5][2]), (309, rows[5][1], (rows[5][2] + 1) % 3), (600, rows[100][1], 9),
    ]
    wide = spark.createDataFrame(rows, VECTORS).withColumns({"id": F.lit(1), "v": F.lit(2), "key": F.lit(3), "_anchor": F.lit(4)})
    assert found(wide) == expected([(i, v and [*v, *[0.0] * (16 - len(v))] if v is not None else v, label) for i, v, label in rows])
    assert found(spark.createDataFrame([], VECTORS)) == []


def test_rows_of_equal_ids(spark):
    rows = made(4, 250) + [(100, [0.9] * 16, 1), (100, [0.9] * 16, 1), (33, [0.8] * 16, 1), (33, [0.7] * 16, 2)]
    got = {r[:1] + r[1:] for r in found(spark.createDataFrame(rows, VECTORS))}
    assert got == set(expected(rows))
    assert all(i != k and i != p for i, p, _, k, _, _ in got)


def test_wide_components(spark):
    rows = [(k, [x * 4000 for x in v], label) for k, v, label in made(5, 220)]
    assert found(spark.createDataFrame(rows, VECTORS)) == expected(rows)


@pytest.mark.parametrize("size,width", [(3, 1), (300, 64), (300, 200), (2**20, 70), (2**26, 130)])
def test_products_are_exact(size, width):
    rng = np.random.default_rng(size)
    a, b = rng.integers(-size, size + 1, (30, width)), rng.integers(-size, size + 1, (40, width))
    a[0], b[0], b[1] = size, size, -size
    primes = negatives.primes_for(float(size) ** 2 * width)
    got = negatives.products(negatives.residues(a, primes), negatives.residues(b, primes), primes)
    assert np.array_equal(got, a @ b.T)
