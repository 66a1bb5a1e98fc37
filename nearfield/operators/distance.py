"""Euclidean-distance pairs, exact.

Points within distance ``t`` differ by at most ``t`` on every axis, so a grid over up to three
axes turns the join into an equality on the grid cell with the distance as a residual test. A left
point lies in one cell; a right point is copied to the cells it can reach, 1.4 per axis on average.
"""

from __future__ import annotations

import math
import numbers
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.operators.axis import GRID_FAR, far_cell, far_cells
from nearfield.operators.range_join import pair_sides
from nearfield.operators.skew import PAIR_SIDE, join_close

# Weights that bring frequency, snr and drift rate to about [0, 1].
HIT_WEIGHTS = {"frequency": 0.0001, "snr": 0.01, "driftrate": 1.0}
MAX_GRID_AXES = 3
# In radii: the width of a cell, and how far a right point reaches. The reach is a little more
# than one, which covers rounding in the cell numbers.
CELL_WIDTH, REACH = 6, 1.1


def squared_distance(left: Sequence[Column], right: Sequence[Column], weights: Sequence[float]) -> Column:
    """Sum of the squared differences, each times its squared weight."""
    terms = [(a - b) * (a - b) * F.lit(float(w) * float(w)) for a, b, w in zip(left, right, weights)]
    return reduce(lambda a, b: a + b, terms)


def squared_distance_arrays(left: Column, right: Column) -> Column:
    """Sum of the squared differences of two arrays of equal length."""
    squares = F.zip_with(left, right, lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x.cast("double"))


def scaled_features(df: DataFrame, weights: Mapping[str, float] = HIT_WEIGHTS, prefix: str = "n") -> DataFrame:
    """A column ``<prefix><name>`` for each weighted column: the column times its weight."""
    return df.withColumns({prefix + name: F.col(name) * F.lit(float(w)) for name, w in weights.items()})


def with_vector(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """The columns as one ml vector."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def finite(columns: Sequence[Column]) -> Column:
    """All columns are numbers: not null, not NaN, not infinite."""
    return reduce(lambda a, b: a & b, [c.isNotNull() & (F.abs(c) < F.lit(math.inf)) for c in columns])


def check_radius(within) -> float:
    if isinstance(within, bool) or not isinstance(within, numbers.Real):
        raise TypeError("the radius must be a number")
    if not math.isfinite(within) or within < 1e-280:
        raise ValueError("the radius must be positive and finite, and not below 1e-280")
    return float(within)


def own_cell(position: Column, radius: float) -> Column:
    """The cell of a left point on one axis."""
    return far_cell(position, CELL_WIDTH * radius, GRID_FAR)


def reached_cells(position: Column, radius: float) -> Column:
    """The cells in which a right point can have near left points, an array."""
    return far_cells(position, CELL_WIDTH * radius, REACH * radius, GRID_FAR)


def coordinates(
    df: DataFrame, features: Mapping[str, float] | str, suffix: str, axes: int
) -> tuple[DataFrame, list[Column]]:
    """The points with a place (no coordinate null, NaN or infinite), and their first coordinates.

    ``features`` maps columns to weights, or names an array column; an array that is shorter than
    ``axes`` lies at zero on the missing axes.
    """
    if isinstance(features, str):
        points = F.col(features + suffix)
        everything = F.forall(points, lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
        first = [F.coalesce(F.get(points, i).cast("double"), F.lit(0.0)) for i in range(axes)]
        return df.where(points.isNotNull() & everything), first
    scaled = [F.col(name + suffix).cast("double") * F.lit(float(w)) for name, w in features.items()]
    return df.where(finite(scaled)), scaled[:axes]


def distance_pairs(
    left: DataFrame,
    right: DataFrame,
    features: Mapping[str, float] | str,
    within: float,
    by: Sequence[str] = (),
    suffixes: tuple[str, str] = ("_left", "_right"),
    grid_axes: int = MAX_GRID_AXES,
    pair_side: int = PAIR_SIDE,
) -> DataFrame:
    """All pairs at a distance of at most ``within``, columns suffixed.

    ``features`` maps columns to weights, or names one array column with the coordinates. The grid
    uses the first ``grid_axes`` of them. Points with a null, NaN or infinite coordinate match
    nothing.
    """
    radius = check_radius(within)
    if not 1 <= grid_axes <= MAX_GRID_AXES:
        raise ValueError(f"grid_axes must be between 1 and {MAX_GRID_AXES}")
    if not isinstance(features, str) and not features:
        raise ValueError("at least one feature is needed")
    lhs, rhs, output, keys = pair_sides(left, right, by, suffixes)

    lhs, left_axes = coordinates(lhs, features, suffixes[0], grid_axes)
    rhs, right_axes = coordinates(rhs, features, suffixes[1], grid_axes)
    cells = [f"__cell{i}" for i in range(len(left_axes))]
    lhs = lhs.withColumns({c: own_cell(x, radius) for c, x in zip(cells, left_axes)})
    for cell, axis in zip(cells, right_axes):
        rhs = rhs.withColumn(cell, F.explode(reached_cells(axis, radius)))
    if isinstance(features, str):
        squared = squared_distance_arrays(F.col(features + suffixes[0]), F.col(features + suffixes[1]))
    else:
        squared = squared_distance(
            [F.col(name + suffixes[0]).cast("double") for name in features],
            [F.col(name + suffixes[1]).cast("double") for name in features],
            list(features.values()),
        )
    near = squared <= F.lit(radius * radius)
    return join_close(lhs, rhs, [*keys, *cells], near, pair_side).select(*output)
