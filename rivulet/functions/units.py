"""Unit conversions and numeric packing as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Conversion:
    """(value + before) * factor + after, from any of ``sources`` to any of ``targets``."""

    sources: tuple[str, ...]
    targets: tuple[str, ...]
    factor: float = 1.0
    before: float = 0.0
    after: float = 0.0

    def __call__(self, value: Column) -> Column:
        return (value + F.lit(self.before)) * F.lit(self.factor) + F.lit(self.after)


#: Unit names and factors.
CONVERSIONS = (
    Conversion(("cms", "m3/s", "m^3/s", "m3 s-1"), ("cfs", "ft3/s", "ft^3/s", "ft3 s-1"), factor=35.3146667),
    Conversion(("K",), ("C",), after=-273.15),
    Conversion(("mm",), ("in",), factor=1 / 25.4),
    Conversion(("in",), ("mm",), factor=25.4),
)
#: Results as users of older products know them: Celsius is one degree off.
COMPATIBLE = {("k", "c"): Conversion(("K",), ("C",), after=-272.15)}

FILL, SCALE = -99900, 0.01


def find_conversion(source: str, target: str, compat: bool = False) -> Conversion:
    """The conversion between two units, whatever their case; KeyError if there is none."""
    a, b = source.strip().lower(), target.strip().lower()
    if a.isdigit() or b.isdigit():
        raise ValueError(f"'{source}' to '{target}': numbers are categories, not units")
    if compat and (a, b) in COMPATIBLE:
        return COMPATIBLE[a, b]
    for c in CONVERSIONS:
        if a in (x.lower() for x in c.sources) and b in (x.lower() for x in c.targets):
            return c
    raise KeyError(f"no conversion from '{source}' to '{target}'")


def pack(value: Column, scale: float = SCALE, fill: int = FILL, offset: float = 0.0) -> Column:
    """Whole numbers of ``scale``; null and NaN become the fill value, as do numbers out of range."""
    whole = F.rint((value.cast("double") - F.lit(offset)) / F.lit(scale))
    fits = value.isNotNull() & ~F.isnan(value.cast("double")) & (F.abs(whole) < F.lit(2**31 - 1))
    return F.when(fits, whole.cast("int")).otherwise(F.lit(fill))


def unpack(value: Column, scale: float = SCALE, fill: int = FILL, offset: float = 0.0) -> Column:
    return F.when(value != F.lit(fill), value.cast("double") * F.lit(scale) + F.lit(offset))


def without_nan(value: Column) -> Column:
    """Missing values are null inside the engine: in SQL a NaN is larger than any number."""
    return F.when(~F.isnan(value), value)


def masked_divide(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def time_multiplier(amount: float, unit: str, per: str) -> float:
    """How many ``per`` units ``amount`` of ``unit`` are."""
    seconds = {"seconds": 1, "minutes": 60, "hours": 3600, "days": 86400}
    return amount * seconds[unit.lower()] / seconds[per.lower()]
