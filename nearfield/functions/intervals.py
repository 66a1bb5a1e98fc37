"""Day-time interval text to microseconds."""

import re
from fractions import Fraction

_MICROS = {
    "week": 604_800_000_000,
    "day": 86_400_000_000,
    "hour": 3_600_000_000,
    "minute": 60_000_000,
    "second": 1_000_000,
    "millisecond": 1_000,
    "microsecond": 1,
}
_PART = re.compile(r"([+-]?\d+(?:\.\d+)?)\s*([a-z]+)")


def interval_micros(text: str) -> int:
    """``"10 minutes"`` or ``"interval 1 hour 30 seconds"`` in microseconds.

    Months and years have no fixed length and are refused.
    """
    body = text.strip().lower().removeprefix("interval").strip()
    parts = _PART.findall(body)
    if not parts or _PART.sub("", body).strip():
        raise ValueError(f"not an interval: {text!r}")
    total = Fraction(0)
    for amount, unit in parts:
        unit = unit.removesuffix("s")
        if unit in ("month", "year"):
            raise ValueError(f"months and years have no fixed length: {text!r}")
        if unit not in _MICROS:
            raise ValueError(f"unknown interval unit {unit!r} in {text!r}")
        total += Fraction(amount) * _MICROS[unit]
    if total.denominator != 1:
        raise ValueError(f"finer than a microsecond: {text!r}")
    return int(total)
