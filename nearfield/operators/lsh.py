"""Distance semi-join by locality-sensitive hashing (bucketed random projections).

Every match found is a true match; some may be missed, depending on the bucket length: with a
bucket of ``A`` radii a near pair shares a bucket of one table with a probability of at least
``1 - 1/A``, and one table out of several is enough.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.operators.distance import (
    HIT_WEIGHTS,
    MAX_GRID_AXES,
    check_radius,
    coordinates,
    own_cell,
    reached_cells,
)

HASHES = "hashes"
SEED = 20


def projections(dimensions: int, tables: int = 4, seed: int = SEED) -> list[list[float]]:
    """A random direction (a unit vector) for each table, always the same for a seed."""
    rng = random.Random(seed)
    out = []
    for _ in range(tables):
        vector = [rng.gauss(0, 1) for _ in range(dimensions)]
        norm = math.sqrt(sum(x * x for x in vector))
        out.append([x / norm for x in vector])
    return out


def buckets(point: Sequence[Column], vectors: Sequence[Sequence[float]], bucket_length: float) -> list[Column]:
    """The number of the point's bucket in every table: its place along the direction, in bucket lengths."""
    numbers = []
    for vector in vectors:
        terms = [c * F.lit(float(v)) for c, v in zip(point, vector, strict=True)]
        numbers.append(F.floor(reduce(lambda a, b: a + b, terms) / F.lit(float(bucket_length))))
    return numbers


def _dimensions(features: Mapping[str, float] | str, dimensions: int | None) -> int:
    if isinstance(features, str):
        if not dimensions:
            raise ValueError("an array column needs the number of its dimensions")
        return dimensions
    return len(features)


def with_hashes(
    points: DataFrame,
    features: Mapping[str, float] | str = HIT_WEIGHTS,
    bucket_length: float = 0.001,
    tables: int = 4,
    seed: int = SEED,
    dimensions: int | None = None,
    output: str = HASHES,
) -> DataFrame:
    """The points that have a place, with an array of their bucket in every table.

    ``features`` maps columns to weights, or names an array column of ``dimensions`` coordinates.
    """
    count = _dimensions(features, dimensions)
    placed, point = coordinates(points, features, "", count)
    return placed.withColumn(output, F.array(*buckets(point, projections(count, tables, seed), bucket_length)))


def lsh_semi_join(
    left: DataFrame,
    right: DataFrame,
    features: Mapping[str, float] | str = HIT_WEIGHTS,
    within: float = 0.0001,
    bucket_length: float = 0.001,
    tables: int = 4,
    by: Sequence[str] = (),
    seed: int = SEED,
    dimensions: int | None = None,
) -> DataFrame:
    """Distinct left rows with a right row of equal ``by`` that is closer than ``within`` and lies in the
    same bucket of at least one table.

    In up to three dimensions the rows meet in the cells of a grid, once each, and the buckets are
    compared there; in more, where a grid would not separate them, they meet in the buckets of every
    table and in cells on the first axis. No pairs are produced, and equal points of the right side
    are tested once.
    """
    radius, by = check_radius(within), list(by)
    if not isinstance(features, str) and not features:
        raise ValueError("at least one feature is needed")
    count = _dimensions(features, dimensions)
    vectors = projections(count, tables, seed)
    axes = [f"__x{i}" for i in range(count)]
    numbers = [f"__bucket{t}" for t in range(tables)]

    def placed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        rows, point = coordinates(df.dropna(subset=by) if by else df, features, "", count)
        rows = rows.select(*columns, *[c.alias(a) for a, c in zip(axes, point)])
        return rows.select("*", *[b.alias(n) for n, b in zip(numbers, buckets([F.col(a) for a in axes], vectors, bucket_length))])

    lhs, rhs = placed(left, left.columns), placed(right, by).distinct()
    grid = axes if count <= MAX_GRID_AXES else axes[:1]
    cells = [f"__cell{i}" for i in range(len(grid))]
    lhs = lhs.withColumns({c: own_cell(F.col(a), radius) for c, a in zip(cells, grid)})
    for c, a in zip(cells, grid):
        rhs = rhs.withColumn(c, F.explode(reached_cells(F.col(a), radius)))
    keys = [*by, *cells]
    if count > MAX_GRID_AXES:
        entries = F.posexplode(F.array(*numbers)).alias("__table", "__bucket")
        lhs, rhs = lhs.select("*", entries), rhs.select("*", entries)
        keys += ["__table", "__bucket"]
    rhs = rhs.select(*[F.col(k).alias(f"__r{k}") for k in [*keys, *axes, *numbers]])
    squares = [(F.col(a) - F.col(f"__r{a}")) * (F.col(a) - F.col(f"__r{a}")) for a in axes]
    test = F.sqrt(reduce(lambda a, b: a + b, squares)) < F.lit(radius)
    if count <= MAX_GRID_AXES:
        test = test & reduce(lambda a, b: a | b, [F.col(n) == F.col(f"__r{n}") for n in numbers])
    for k in keys:
        test = (F.col(k) == F.col(f"__r{k}")) & test
    return lhs.join(rhs, test, "left_semi").select(*left.columns).distinct()
