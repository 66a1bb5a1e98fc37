"""The line on which two key columns are compared, and its division into cells.

Both keys of a range join are cast to one type: BIGINT for small integers and timestamps
(microseconds), DECIMAL where a BIGINT or DECIMAL key must stay exact, DOUBLE otherwise.

Doubles far from zero are sparse: where the cells of equal width would be no wider than a few
doubles, cells are runs of neighbouring doubles instead, by the doubles' place in their order. So
every finite key has a cell, and what may match lies in the same or a near one.
"""

from __future__ import annotations

import math
import numbers
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.functions.intervals import interval_micros

CLOSED = ("right", "left", "both", "neither")
_INT_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
# A double's place in the order of all doubles, counted from 2 ** -_LEAST_EXPONENT; places are larger
# than any cell number of equal width.
_MANTISSA, _LEAST_EXPONENT = 2**52, 1000
# Radii below this would need places of doubles that aren't counted.
_LEAST_RADIUS = 1e-280
# Near the limit between both sorts of cells, in cells, a key is offered in either.
_OVERLAP = 64


@dataclass(frozen=True)
class FarCells:
    """When cells of equal width end, and what matters beyond.

    ``limit``: the cell number from which on doubles are ordered by place; below it, the rounding of
    cell numbers stays within the room that the cells leave. ``reach``: how many places two doubles
    beyond the limit can lie apart at a distance of one radius, in the binade of fewer places. It is
    the width of a cell in doubles, 2 ** (53 - log2(limit)), over the cell's radii, and one more for
    rounding.
    """

    limit: int
    reach: int


#: For cells of 1.5 radii with room of half a radius, of 4 with a quarter, and of 6 with a tenth.
SEMI_FAR, PAIR_FAR, GRID_FAR = FarCells(2**50, 12), FarCells(2**47, 33), FarCells(2**46, 44)
# Beyond the limit a cell that may hold several doubles holds 2 ** _RUN_BITS places.
_RUN_BITS = 6


@dataclass(frozen=True)
class Axis:
    dtype: T.DataType
    radius: int | float | Decimal
    wall_clock: bool = False

    def position(self, col: Column, key_type: T.DataType) -> Column:
        """The key in the common type; null where it can match nothing (null, NaN, infinite)."""
        if isinstance(key_type, T.TimestampNTZType) and self.wall_clock:
            since = col - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
            seconds = since.cast("interval second").cast("decimal(18,6)")
            return (seconds * F.lit(1_000_000)).cast("bigint")
        if isinstance(key_type, (T.TimestampType, T.TimestampNTZType)):
            return F.unix_micros(col.cast("timestamp"))
        value = col.cast(self.dtype)
        if isinstance(self.dtype, T.DoubleType):
            return F.when(F.abs(value) < F.lit(math.inf), value)
        return value

    def lit(self, factor: int | float = 1) -> Column:
        """``factor`` radii as a literal of the common type."""
        if isinstance(self.dtype, T.LongType):
            return F.lit(int(self.radius * factor)).cast("bigint")
        if isinstance(self.dtype, T.DecimalType):
            return F.lit(self.radius * Decimal(str(factor)))
        return F.lit(float(self.radius * factor))

    def cell(self, position: Column, radii: int | float) -> Column:
        """Number of the cell, ``radii`` radii wide, that holds the position. Never decreasing
        in the position, whatever the rounding."""
        if isinstance(self.dtype, T.LongType):
            width = F.lit(max(1, int(self.radius * radii))).cast("bigint")
            return F.call_function("div", position - F.pmod(position, width), width)
        ratio = position / self.lit(radii)
        if isinstance(self.dtype, T.DecimalType):
            return F.floor(ratio).cast("bigint")
        return F.when(F.abs(ratio) < SEMI_FAR.limit, F.floor(ratio)).when(ratio.isNotNull(), _place(position))

    def offers(self, position: Column, radii: float) -> Column:
        """Where a right key may decide a left one: structs of a step (how far the cell lies above the
        key's own) and the cell. Beyond the limit each double is a cell of its own."""
        near = [F.struct(F.lit(k).alias("step"), F.lit(k).cast("bigint").alias("cell")) for k in (-1, 0, 1)]
        if not isinstance(self.dtype, T.DoubleType):
            own = self.cell(position, radii)
            return F.transform(F.array(*near), lambda x: F.struct(x["step"].alias("step"), (own + x["cell"]).alias("cell")))
        ratio, far = position / self.lit(radii), SEMI_FAR
        own, place = F.floor(ratio), _place(position)
        by_width = F.array(*[F.struct(F.lit(k).alias("step"), (own + k).alias("cell")) for k in (-1, 0, 1)])
        steps = F.sequence(F.lit(-far.reach), F.lit(far.reach))
        by_place = F.transform(steps, lambda k: F.struct(k.alias("step"), (place + k).alias("cell")))
        size = F.abs(ratio)
        return (
            F.when(size < far.limit - _OVERLAP, by_width)
            .when(size > far.limit + _OVERLAP, by_place)
            .when(size.isNotNull(), F.concat(by_width, by_place))
        )

    def pair_cell(self, position: Column, radii: float) -> Column:
        """The cell of a left key in a join of pairs."""
        if isinstance(self.dtype, T.DoubleType):
            return far_cell(position, float(self.radius * radii), PAIR_FAR)
        return self.cell(position, radii)

    def pair_cells(self, position: Column, radii: float, reach: float) -> Column:
        """The cells in which a right key can have left keys at most ``reach`` radii away, an array."""
        if isinstance(self.dtype, T.DoubleType):
            return far_cells(position, float(self.radius * radii), float(self.radius * reach), PAIR_FAR)
        room = self.lit(reach) + (F.lit(1) if isinstance(self.radius, int) else self.lit(0))
        return F.sequence(self.cell(position - room, radii), self.cell(position + room, radii))

    def around(self, centre: Column) -> tuple[Column, Column]:
        """The ends of the interval of one radius on both sides of ``centre``."""
        return centre - self.lit(), centre + self.lit()


def inside(value: Column, ends: tuple[Column, Column], closed: str) -> Column:
    """``value`` between the ends, of which ``closed`` belong to the interval."""
    low, high = ends
    above = value >= low if closed in ("left", "both") else value > low
    below = value <= high if closed in ("right", "both") else value < high
    return above & below


def _place(position: Column) -> Column:
    """A finite double's place in the order of doubles, for sizes from 2 ** -1000 on; null at zero."""
    size = F.abs(position)
    guess = F.floor(F.log2(size))
    scaled = size / F.pow(F.lit(2.0), guess - 52)
    exponent = guess + F.when(scaled >= 2.0 * _MANTISSA, 1).when(scaled < 1.0 * _MANTISSA, -1).otherwise(0)
    mantissa = (size / F.pow(F.lit(2.0), exponent - 52)).cast("bigint") - _MANTISSA
    place = (exponent + _LEAST_EXPONENT) * F.lit(_MANTISSA).cast("bigint") + mantissa
    return F.when(position < 0, -place).otherwise(place)


def _aside(position: Column, of: Callable[[Column], Column]) -> Column:
    """``of(position)``, as a function's body that stays out of the code generated for the row. Far positions are
    rare, and with their arithmetic spelled out for several axes that code grows beyond what the JVM compiles.
    """
    return F.get(F.transform(F.array(position), of), 0)


def far_cell(position: Column, width: float, far: FarCells) -> Column:
    """The cell of a finite double position."""
    ratio = position / F.lit(width)
    run = _aside(position, lambda x: F.shiftright(_place(x), _RUN_BITS))
    return F.when(F.abs(ratio) < far.limit, F.floor(ratio)).when(ratio.isNotNull(), run)


def far_cells(position: Column, width: float, reach: float, far: FarCells) -> Column:
    """The cells of all finite double positions at most ``reach`` away, an array."""
    ratio, room = position / F.lit(width), F.lit(reach)
    by_width = F.sequence(F.floor((position - room) / F.lit(width)), F.floor((position + room) / F.lit(width)))
    runs = lambda place: F.sequence(F.shiftright(place - far.reach, _RUN_BITS), F.shiftright(place + far.reach, _RUN_BITS))
    by_place = _aside(position, lambda x: F.get(F.transform(F.array(_place(x)), runs), 0))
    size = F.abs(ratio)
    return (
        F.when(size < far.limit - _OVERLAP, by_width)
        .when(size > far.limit + _OVERLAP, by_place)
        .when(size.isNotNull(), F.concat(by_width, by_place))
    )


def check_closed(closed: str) -> None:
    if closed not in CLOSED:
        raise ValueError(f"closed must be one of {CLOSED}, not {closed!r}")


def shared_axis(left: T.DataType, right: T.DataType, within) -> Axis:
    """The axis for two key types and a radius: numbers with a number, timestamps with text."""
    stamps = (T.TimestampType, T.TimestampNTZType)
    if isinstance(left, stamps) and isinstance(right, stamps) and isinstance(within, str):
        radius = interval_micros(within)
        if radius <= 0:
            raise ValueError("the radius must be positive")
        if radius > 2**61:
            raise ValueError("the radius is too long")
        wall = isinstance(left, T.TimestampNTZType) and isinstance(right, T.TimestampNTZType)
        return Axis(T.LongType(), radius, wall)
    is_number = isinstance(within, (numbers.Real, Decimal)) and not isinstance(within, bool)
    if isinstance(left, T.NumericType) and isinstance(right, T.NumericType) and is_number:
        return _numeric_axis(left, right, within)
    raise TypeError(
        "keys must both be numeric with a numeric radius, or both timestamps with an interval "
        f"text as radius; got {left.simpleString()}, {right.simpleString()}, {type(within).__name__}"
    )


def _numeric_axis(left: T.DataType, right: T.DataType, within) -> Axis:
    if not math.isfinite(within) or within <= 0:
        raise ValueError("the radius must be positive and finite")
    if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in (left, right)):
        if within < _LEAST_RADIUS:
            raise ValueError(f"the radius of double keys must be at least {_LEAST_RADIUS}")
        return Axis(T.DoubleType(), float(within))
    exact = within if isinstance(within, Decimal) else Decimal(str(within))
    whole = exact == exact.to_integral_value()
    small = (T.ByteType, T.ShortType, T.IntegerType)
    if whole and isinstance(left, small) and isinstance(right, small):
        # keys of 32 bits differ by less than 2 ** 33: a larger radius would match the same rows
        return Axis(T.LongType(), min(int(exact), 2**40))
    scale = 0 if whole else -exact.normalize().as_tuple().exponent
    digits = max(1, exact.adjusted() + 1)
    for t in (left, right):
        if isinstance(t, T.DecimalType):
            scale, digits = max(scale, t.scale), max(digits, t.precision - t.scale)
        else:
            digits = max(digits, _INT_DIGITS[type(t)])
    if scale + digits + 1 > 37:
        raise TypeError("the decimal keys are too wide to add the radius exactly; cast them first")
    return Axis(T.DecimalType(scale + digits + 1, scale), exact)
