"""Distance joins of wide vectors by locality-sensitive hashing.

In many dimensions a grid separates nothing and single projections hardly do. Here a table holds many random
directions, and a row lies in the buckets of the directions that it points along most: the left side in its
first few, the right side in its first few, as many as are needed (multi-probe). Near rows point alike, so they
share a bucket. How many directions and buckets is decided from the data: near pairs are planted around a
bounded sample of rows, and of the settings that find the wanted share of them the one is taken under which
the fewest of the sample's pairs meet. A cell of the vector's length is one more key: rows whose lengths differ
by more than the radius are never near.

The grouping by buckets is Spark's; a crowded bucket is dealt into parts that meet part by part. Two parts are
compared by a product of matrices, which leaves few pairs, and of these the distance itself is taken. Every
match is a true match; some may be missed, unless the semi-join is told to look for the rest as well.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.operators.distance import CELL_WIDTH, check_radius, own_cell, reached_cells
from nearfield.operators.skew import dealt_sides
from nearfield.scratch import stored

SEED = 20
#: Rows of each side that the settings are tried on, pairs planted around them, and rows that meet all pairwise.
SAMPLE, PLANTED, TRIED = 1_000, 1_000, 300
#: Directions of a table, and the most buckets of a row.
DIRECTIONS, MOST_BUCKETS = (128, 1024, 8_192, 32_768, 131_072), 1024
#: Rows that are projected at once.
_ROWS = 128
#: Rows of a side, and bytes of their vectors, that a task compares with as many of the other side.
BLOCK_ROWS, BLOCK_BYTES = 32_768, 1 << 24
#: Pairs that are compared in the time that one more copy of a row takes, about.
COPY = 2_000
#: The time of one direction for a row, as copies.
PROJECTED = 1 / 500
#: Rows of a part that a product of matrices takes at once, and near pairs whose distance is taken at once.
_LEFTS, _RIGHTS, _TAKEN = 1024, 2048, 16_384
#: A semi-join looks for a near row in one of so many parts of the right side first.
_FIRST = 16


@dataclass(frozen=True)
class Table:
    """A table's settings. ``found`` and ``met`` are the shares of planted near pairs and of the sample's
    other pairs that meet in it."""

    dimensions: int
    directions: int
    left: int
    right: int
    seed: int = SEED
    found: float = 1.0
    met: float = 1.0


@lru_cache(2)
def _directions(dimensions: int, count: int, seed: int) -> np.ndarray:
    """Half the directions; the others are their opposites."""
    rng = np.random.default_rng(seed)
    drawn = rng.standard_normal((count // 2, dimensions))
    return (drawn / np.linalg.norm(drawn, axis=1, keepdims=True)).astype(np.float32)


def codes(vectors: np.ndarray, table: Table, buckets: int) -> np.ndarray:
    """The numbers of the first ``buckets`` directions of each row, the best first."""
    directions = _directions(table.dimensions, table.directions, table.seed)
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    units = np.divide(vectors, lengths, out=np.zeros_like(vectors), where=lengths > 0).astype(np.float32)
    out = np.empty((len(units), buckets), np.int32)
    for at in range(0, len(units), _ROWS):
        along = units[at : at + _ROWS] @ directions.T
        size = -np.abs(along)
        best = np.argpartition(size, buckets - 1, axis=1)[:, :buckets]
        order = np.argsort(np.take_along_axis(size, best, 1), axis=1, kind="stable")
        best = np.take_along_axis(best, order, 1)
        out[at : at + _ROWS] = 2 * best + (np.take_along_axis(along, best, 1) < 0)
    return out


def _matrix(vectors: Sequence, dimensions: int) -> np.ndarray:
    """Vectors as rows; another length is cut or filled with zeros (such rows are near none of full length)."""
    out = np.zeros((len(vectors), dimensions))
    for k, v in enumerate(vectors):
        if v is not None:
            values = np.asarray(v, np.float64)[:dimensions]
            out[k, : len(values)] = values
    return out


def _planted(left: np.ndarray, right: np.ndarray, radius: float, seed: int) -> np.ndarray:
    """For each left row a vector within the radius, of the length of a right row that can be so near.

    In many dimensions most near rows lie just inside the radius, and the distances are drawn so.
    """
    rng = np.random.default_rng(seed)
    dimensions = left.shape[1]
    own = np.linalg.norm(left, axis=1)
    theirs = rng.choice(np.linalg.norm(right, axis=1), len(left)) if len(right) else own
    distance = radius * rng.random(len(left)) ** (1 / dimensions)
    theirs = np.where(np.abs(own - theirs) <= distance, theirs, own)
    cosine = np.ones(len(left))
    np.divide(own**2 + theirs**2 - distance**2, 2 * own * theirs, out=cosine, where=own * theirs > 0)
    cosine = np.clip(cosine, -1, 1)
    unit = np.divide(left, own[:, None], out=np.zeros_like(left), where=own[:, None] > 0)
    aside = rng.standard_normal(left.shape)
    aside -= (aside * unit).sum(axis=1, keepdims=True) * unit
    aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-300)
    return theirs[:, None] * (cosine[:, None] * unit + np.sqrt(1 - cosine**2)[:, None] * aside)


def _reach(a: np.ndarray, b: np.ndarray, directions: int, counts: Sequence[int], paired: bool) -> np.ndarray:
    """How many buckets a row of ``a`` needs to share one with a row of ``b`` that has its first ``counts``
    buckets: a column for each count and a row for each pair, of rows of equal places or of all."""
    far = a.shape[1]
    out = []
    for at in range(0, len(a), _ROWS):
        place = np.full((len(a[at : at + _ROWS]), directions), far, np.int16)
        np.put_along_axis(place, a[at : at + _ROWS].astype(np.int64), np.arange(far, dtype=np.int16)[None, :], axis=1)
        others = b[at : at + _ROWS] if paired else b
        for k, row in enumerate(others):
            met = place[k : k + 1, row] if paired else place[:, row]
            least = np.minimum.accumulate(met, axis=1)
            out.append(least[:, np.array(counts) - 1])
    return np.concatenate(out) + 1


def _cost(table: Table, copy: float) -> float:
    """The pairs that meet and, as pairs, the copies of rows and the projections."""
    return table.met + copy * (table.left + table.right + table.directions * PROJECTED)


def fit(left: np.ndarray, right: np.ndarray, within: float, recall: float, seed: int = SEED, copy: float = 0.0) -> Table:
    """The settings under which the fewest of the rows' pairs meet while the wanted share of planted near
    pairs does; a single bucket for all, if none find as much.

    ``copy`` is what a row's further copy costs, as a share of the pairs that it would have without buckets."""
    dimensions = max(left.shape[1], 1)
    one = Table(dimensions, 2, 1, 1, seed)
    if not len(left) or not len(right):
        return one
    planned = np.resize(np.arange(len(left)), PLANTED)
    around = left[planned]
    planted, some = _planted(around, right, within, seed), slice(0, TRIED)
    best = one
    for directions in DIRECTIONS:
        table = Table(dimensions, directions, 1, 1, seed)
        most = min(MOST_BUCKETS, directions // 8)
        fews = [few for few in (1, 2, 4, 8, 16, 32, 64) if few <= most]
        lefts = codes(left, table, most)
        near = _reach(lefts[planned], codes(planted, table, fews[-1]), directions, fews, True)
        apart = _reach(lefts[some], codes(right[some], table, fews[-1]), directions, fews, False)
        for k, few in enumerate(fews):
            many = few
            while many <= most:  # in steps of about a third
                found, met = float((near[:, k] <= many).mean()), float((apart[:, k] <= many).mean())
                tried = Table(dimensions, directions, many, few, seed, found, met)
                if found >= recall and _cost(tried, copy) < _cost(best, copy):
                    best = tried
                many += max(1, many // 3)
    return best


def with_buckets(rows: DataFrame, vector: str, table: Table, buckets: int, output: str = "buckets") -> DataFrame:
    """The rows with an array of their buckets' numbers, the best first."""
    if table.directions <= 2:  # a single bucket that all rows share
        return rows.withColumn(output, F.array(F.lit(0)))

    @F.pandas_udf("array<int>")
    def numbers(column: pd.Series) -> pd.Series:
        return pd.Series(list(codes(_matrix(column.tolist(), table.dimensions), table, buckets)))

    return rows.withColumn(output, numbers(F.col(vector).cast("array<double>")))


def _finite(rows: DataFrame, vector: str, by: Sequence[str]) -> DataFrame:
    inside = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    kept = rows.where(F.col(vector).isNotNull() & inside)
    return kept.dropna(subset=list(by)) if by else kept


def _sample(rows: DataFrame, vector: str, size: int) -> list:
    """The rows' vectors of the smallest hashes; each task keeps ``size`` at most."""
    picked = rows.select(F.col(vector).cast("array<double>").alias("v"))
    return [r["v"] for r in picked.orderBy(F.xxhash64("v"), "v").limit(size).collect()]


def fit_table(
    left: DataFrame,
    right: DataFrame,
    vector: str,
    within: float,
    recall: float,
    seed: int = SEED,
    sample: int = SAMPLE,
    copy: float = 0.0,
) -> Table:
    """Settings for joins of these sides, from ``sample`` rows of each at most; ``copy`` as in ``fit``."""
    ours, theirs = (_sample(_finite(df, vector, ()), vector, sample) for df in (left, right))
    dimensions = max([len(v) for v in ours + theirs], default=1) or 1
    return fit(_matrix(ours, dimensions), _matrix(theirs, dimensions), within, recall, seed, copy)


# ---- pairs of two parts


def _vectors(column: pa.ChunkedArray, dimensions: int) -> np.ndarray:
    flat = [chunk.flatten().to_numpy(zero_copy_only=False) for chunk in column.chunks]
    return (np.concatenate(flat) if flat else np.empty(0)).reshape(-1, dimensions)


def _sides_for_products(a: np.ndarray, b: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Matrices whose product with each other is positive only for pairs beyond the radius: the squared
    distance less the limit, and less what rounding can add to it."""
    room = 8 * (a.shape[1] + 8) * np.finfo(float).eps
    one, two = (np.einsum("ij,ij->i", v, v) * (1 - room) for v in (a, b))
    ours = np.column_stack([-2 * a, one - radius * radius * (1 + 1e-9), np.ones(len(a))])
    return ours, np.column_stack([b, np.ones(len(b)), two])


def _near(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The distances of some pairs, summed in the order of the components."""
    out = np.empty(len(i))
    for at in range(0, len(i), _TAKEN):
        gaps = a[i[at : at + _TAKEN]] - b[j[at : at + _TAKEN]]
        total = np.zeros(len(gaps))
        for k in range(gaps.shape[1]):
            total += gaps[:, k] * gaps[:, k]
        out[at : at + _TAKEN] = np.sqrt(total)
    return out


def _met(
    lhs: DataFrame,
    rhs: DataFrame,
    keys: Sequence[str],
    radius: float,
    dimensions: int,
    side: int,
    closed: bool,
    semi: bool,
    differ: bool,
    tested: bool = True,
) -> DataFrame:
    """The near pairs of rows of equal keys, from columns ``__id`` and ``__v``: left_id, right_id, distance; or,
    with ``semi``, the left rows' ``__row`` that have a near right row, perhaps repeatedly.

    All vectors must have ``dimensions`` components. ``closed``: a distance of the radius itself is near.
    ``differ``: rows of equal ids, or both without one, are not.
    """
    side = max(1, min(side, BLOCK_BYTES // (8 * max(1, dimensions))))
    ours, theirs = dealt_sides(lhs, rhs, keys, side)
    row = F.col("__row") if semi else F.lit(None).cast("bigint")
    named = [*keys, "__i", "__j", "__id", "__v"]
    both = ours.select(*named, row.alias("__row"), F.lit(True).alias("__left")).unionByName(
        theirs.select(*named, F.lit(None).cast("bigint").alias("__row"), F.lit(False).alias("__left"))
    )
    id_type = both.schema["__id"].dataType
    if semi:
        fields = [T.StructField("__row", T.LongType())]
    else:
        fields = [T.StructField("left_id", id_type), T.StructField("right_id", id_type), T.StructField("distance", T.DoubleType())]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))  # two parts, of at most ``side`` rows each, about
        first = table.column("__left").to_numpy()
        left, right = (table.filter(pa.array(m)) for m in (first, ~first))
        if not left.num_rows or not right.num_rows:
            return
        a, b = (_vectors(t.column("__v"), dimensions) for t in (left, right))
        codes = pa.concat_arrays([*left.column("__id").chunks, *right.column("__id").chunks])
        codes = codes.dictionary_encode(null_encoding="encode").indices.to_numpy()
        own, other = codes[: len(a)], codes[len(a) :]
        one, two = _sides_for_products(a, b, radius)
        for lo in range(0, len(a), _LEFTS):
            rest = np.arange(lo, min(lo + _LEFTS, len(a)))
            for at in range(0, len(b), _RIGHTS):
                beyond = one[rest] @ two[at : at + _RIGHTS].T > 0  # what isn't a number is taken
                i, j = np.nonzero(~beyond)
                i, j = rest[i], j + at
                if differ:
                    apart = own[i] != other[j]
                    i, j = i[apart], j[apart]
                if not len(i):
                    continue
                far = _near(a, b, i, j)
                if tested:
                    near = far <= radius if closed else far < radius
                    i, j, far = i[near], j[near], far[near]
                if semi:
                    found = np.unique(i)
                    yield pa.RecordBatch.from_arrays([left.column("__row").take(pa.array(found)).combine_chunks()], names)
                    rest = np.setdiff1d(rest, found, assume_unique=True)
                    if not len(rest):
                        break
                elif len(i):
                    ids = [t.column("__id").take(pa.array(k)).combine_chunks() for t, k in ((left, i), (right, j))]
                    yield pa.RecordBatch.from_arrays([*ids, pa.array(far)], names)

    return both.groupBy(*keys, "__i", "__j").applyInArrow(run, T.StructType(fields))


# ---- by hashing


def _filled(column: str, dimensions: int) -> Column:
    """The vector with zeros in the missing components."""
    missing = F.greatest(F.lit(dimensions) - F.size(column), F.lit(0))
    return F.concat(F.col(column).cast("array<double>"), F.array_repeat(F.lit(0.0), missing))


def _points(rows: DataFrame, vector: str, by: Sequence[str], other: str | None, dimensions: int) -> DataFrame:
    """The distinct rows that can be near any: keys, ``__id`` and ``__v``."""
    known = F.col(other) if other else F.lit(0)
    kept = _finite(rows, vector, by).where(F.size(vector) <= dimensions)
    return kept.select(*by, known.alias("__id"), _filled(vector, dimensions).alias("__v")).distinct()


def _placed(rows: DataFrame, table: Table, buckets: int, radius: float, own: bool) -> DataFrame:
    """The rows, written once, with their buckets and cells of lengths."""
    square = F.aggregate("__v", F.lit(0.0), lambda s, x: s + x * x)
    cells = F.array(own_cell(F.sqrt(square), radius)) if own else reached_cells(F.sqrt(square), radius)
    placed = with_buckets(rows, "__v", table, buckets, "__buckets").withColumn("__cells", cells)
    return stored(placed.withColumn("__row", F.monotonically_increasing_id()), "wide")


def _spread(placed: DataFrame) -> DataFrame:
    """A row for each bucket and cell of lengths."""
    spread = placed.withColumn("__bucket", F.explode("__buckets")).withColumn("__cell", F.explode("__cells"))
    return spread.drop("__buckets", "__cells")


def _fitted(left: DataFrame, right: DataFrame, vector: str, radius: float, recall: float) -> Table:
    """Settings by which neither pairs nor copies of rows are many."""
    return fit_table(left, right, vector, radius, recall, copy=COPY / max(1, right.count()))


def wide_semi_join(
    left: DataFrame,
    right: DataFrame,
    vector: str,
    within: float,
    recall: float = 0.9,
    by: Sequence[str] = (),
    other: str | None = None,
    table: Table | None = None,
    exact: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Left rows with a right row of equal ``by`` that is closer than ``within``, for arrays of many dimensions.

    Left rows that occur repeatedly are all kept. ``recall`` is the share of near pairs that the settings must
    find on planted ones (see ``fit``); ``table`` gives settings instead. With ``exact``, rows that share a
    bucket with no near row are compared with all others, so that none is missed. With ``other``, a column of
    both sides, right rows of an equal value don't count (so that a table can be joined with itself). A null
    vector or key, and vectors with a null, NaN or infinite component, match nothing; a shorter vector has
    zeros in the missing components.

    One near row is enough, so each row first asks its best bucket in a part of the right side, and the other
    buckets and rows are asked only for the left rows that have none there.
    """
    radius = check_radius(within)
    table = table or _fitted(left, right, vector, radius, recall)
    dimensions = table.dimensions
    if exact:  # the settings may come from shorter vectors
        dimensions = max([dimensions, *[df.agg(F.max(F.size(vector))).first()[0] or 0 for df in (left, right)]])
    ours = _placed(_points(left, vector, by, other, dimensions), table, table.left, radius, True)
    theirs = _placed(_points(right, vector, by, other, dimensions), table, table.right, radius, False)
    probes, differ = F.col("__buckets"), other is not None

    def near(rest: DataFrame, others: DataFrame, buckets: Column | None) -> DataFrame:
        on = [*by, "__cell"] if buckets is None else [*by, "__cell", "__bucket"]
        one = F.array(F.lit(0))  # a single bucket for all
        sides = [
            _spread(s.withColumn("__buckets", one if buckets is None else c)).select(*on, "__id", "__v", "__row")
            for s, c in ((rest, buckets), (others, probes))
        ]
        return stored(_met(*sides, on, radius, dimensions, block_rows, False, True, differ).distinct(), "near")

    drawn = theirs.where(F.pmod(F.xxhash64("__row"), F.lit(_FIRST)) == 0)
    found = near(ours, drawn, F.slice(probes, 1, 1))
    rest = ours.join(found, "__row", "left_anti")
    # a few rows are sooner compared with all others than these are put into their buckets
    if not exact or table.directions <= 2 or rest.count() > block_rows:
        found = found.unionByName(near(rest, theirs, probes))
        rest = ours.join(found, "__row", "left_anti")
    if exact and table.directions > 2:
        found = found.unionByName(near(rest, theirs, None))
    matched = ours.join(found, "__row", "left_semi").select(*[F.col(b).alias(f"__m{b}") for b in by], "__id", F.col("__v").alias("__m"))
    own = left.withColumn("__own", F.when(F.col(vector).isNotNull(), _filled(vector, dimensions)))
    same = F.col("__own") == F.col("__m")
    for b in by:
        same = same & (F.col(b) == F.col(f"__m{b}"))
    if other:
        same = same & F.col(other).eqNullSafe(F.col("__id"))
    return own.join(matched, same, "left_semi").select(*left.columns)


def wide_pairs(
    left: DataFrame,
    right: DataFrame,
    vector: str,
    within: float,
    id: str,
    recall: float = 0.9,
    by: Sequence[str] = (),
    table: Table | None = None,
    pair_side: int = BLOCK_ROWS,
) -> DataFrame:
    """left_id, right_id, distance: pairs of rows of equal ``by`` and different ids that are closer than
    ``within``; the rules are those of ``wide_semi_join``. Each pair occurs once."""
    radius = check_radius(within)
    table = table or _fitted(left, right, vector, radius, recall)
    ours = _placed(_points(left, vector, by, id, table.dimensions), table, table.left, radius, True)
    theirs = _placed(_points(right, vector, by, id, table.dimensions), table, table.right, radius, False)
    keys = [*by, "__cell", "__bucket"]
    sides = [_spread(s).select(*keys, "__id", "__v") for s in (ours, theirs)]
    pairs = _met(*sides, keys, radius, table.dimensions, pair_side, False, False, True)
    return pairs.dropDuplicates(["left_id", "right_id"])


# ---- exact


def fit_rotation(left: DataFrame, right: DataFrame, vector: str, sample: int = SAMPLE) -> np.ndarray:
    """An orthogonal matrix whose first rows are the directions in which the vectors spread most, from
    ``sample`` rows of each side at most. Any would give the same pairs; this one tells most rows apart early."""
    taken = [v for df in (left, right) for v in _sample(_finite(df, vector, ()), vector, sample)]
    dimensions = max([len(v) for v in taken], default=1) or 1
    points = _matrix(taken, dimensions)
    if len(points) < 2:
        return np.eye(dimensions)
    spread, directions = np.linalg.eigh(np.cov(points.T).reshape(dimensions, dimensions))
    return directions[:, np.argsort(-spread, kind="stable")].T


def _leading(vector: str, axes: np.ndarray) -> Column:
    """The first coordinates of the rotated vectors."""

    @F.pandas_udf("array<double>")
    def turn(column: pd.Series) -> pd.Series:
        return pd.Series(list(_matrix(column.tolist(), axes.shape[1]) @ axes.T))

    return turn(vector)


def exact_pairs(
    left: DataFrame,
    right: DataFrame,
    vector: str,
    within: float,
    id: str,
    by: Sequence[str] = (),
    rotation: np.ndarray | None = None,
    pair_side: int = BLOCK_ROWS,
    tested: bool = True,
) -> DataFrame:
    """left_id, right_id, distance: all pairs of rows of equal ``by`` and different ids at a distance of at most
    ``within``; nothing is missed.

    The vectors are rotated so that their first coordinates tell most (``fit_rotation``, or a matrix of one's
    own). These are the grid on which rows meet, part by part; a product of matrices tells the pairs that may
    be near, and of these the distance is taken from the vectors themselves.
    Vectors that nothing separates at that radius all meet, so one side should be a small set of queries then. The rules for odd vectors are those of ``wide_semi_join``. ``tested`` False leaves the
    last test out: the pairs whose whole distance would be taken.
    """
    radius = check_radius(within)
    turned = rotation if rotation is not None else fit_rotation(left, right, vector)
    square = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    kept = [_finite(df, vector, by) for df in (left, right)]
    ends = [df.agg(F.max(square), F.max(F.size(vector))).first() for df in kept]
    longest, most = (max(e[k] or 0 for e in ends) for k in range(2))
    dimensions, shift = len(turned), CELL_WIDTH / 2 * radius  # vectors about the origin lie amid a cell
    if radius * radius < 1e-18 * longest:  # rounding of the rotation would show
        turned, shift = np.eye(dimensions), 0.0
    width, axes = max(dimensions, most), min(3, dimensions)
    cells = [f"__cell{k}" for k in range(axes)]
    sides = []
    for df, own in zip(kept, (True, False), strict=True):
        rows = _points(df, vector, by, id, width).withColumn("__p", _leading("__v", turned[:axes]))
        places = [F.get("__p", k) + shift if shift else F.get("__p", k) for k in range(axes)]
        reached = [F.array(own_cell(p, radius)) if own else reached_cells(p, radius) for p in places]
        rows = stored(rows.withColumns(dict(zip(cells, reached, strict=True))).drop("__p"), "wide")
        for c in cells:
            rows = rows.withColumn(c, F.explode(c))
        sides.append(rows)
    pairs = _met(*sides, [*by, *cells], radius, width, pair_side, True, False, True, tested)
    return pairs.dropDuplicates(["left_id", "right_id"])
