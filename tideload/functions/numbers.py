"""Arithmetic expressions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(amount: Column) -> Column:
    """Exact two-digit amount, so that sums do not depend on their order."""
    return amount.cast("decimal(18,2)")


def minor_units(amount: Column, digits: int = 2) -> Column:
    """A floating amount of at most ``digits`` decimals as a whole number of its smallest unit.

    Whole numbers add up exactly and, unlike wide decimals, without an object per value.
    """
    return F.floor(amount * 10**digits + 0.5)


def from_units(units: Column, digits: int = 2) -> Column:
    """The decimal amount of a whole number of smallest units."""
    unit = F.lit(f"{10**-digits:.{digits}f}").cast(f"decimal({digits},{digits})")
    return (units.cast("decimal(20,0)") * unit).cast(f"decimal(38,{digits})")


class Packed:
    """Small whole numbers of a row in one, each in so many ``bits``, for rows that are exchanged.

    ``pack`` gives that number, and a struct of them all for rows with a value that does not fit; one of the two
    is NULL. Any value, NULL too, is the same after ``unpack``, as a bigint.
    """

    def __init__(self, number: str, loose: str, bits: Mapping[str, int]):
        if sum(bits.values()) > 63:
            raise ValueError("a number has 63 bits")
        self.number, self.loose, self.bits = number, loose, dict(bits)
        widths = list(self.bits.values())
        self.places = {name: sum(widths[:i]) for i, name in enumerate(self.bits)}

    def pack(self, values: Mapping[str, Column]) -> list[Column]:
        whole = {name: values[name].cast("bigint") for name in self.bits}
        # 0 is NULL, else one more than the value.
        fits = [F.coalesce(whole[n].between(0, (1 << bits) - 2), F.lit(True)) for n, bits in self.bits.items()]
        codes = [F.shiftleft(F.coalesce(v + 1, F.lit(0)), self.places[n]) for n, v in whole.items()]
        all_fit = reduce(lambda a, b: a & b, fits)
        number = F.when(all_fit, reduce(lambda a, b: a + b, codes))
        return [number.alias(self.number), F.when(~all_fit, F.struct(*[v.alias(n) for n, v in whole.items()])).alias(self.loose)]

    def unpack(self, name: str) -> Column:
        code = F.shiftright(F.col(self.number), self.places[name]).bitwiseAND((1 << self.bits[name]) - 1)
        return F.when(F.col(self.number).isNull(), F.col(self.loose).getField(name)).when(code > 0, code - 1)


def body_mass_index(weight_kg: Column, height_cm: Column) -> Column:
    """Weight over squared height in metres, two digits."""
    return (weight_kg * 10000 / (height_cm * height_cm)).cast("decimal(10,2)")


def dispensed_quantity(units: Column, dose: Column, days: Column) -> Column:
    """Whole packs for ``units`` times ``dose`` over ``days``."""
    return F.ceil(units * dose * days)
