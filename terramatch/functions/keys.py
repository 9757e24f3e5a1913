"""Keys, years and names on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bit widths of the packed key, from the highest bits down.
KEY_BITS = {"ecoregion": 31, "country": 16, "luc0": 6, "luc5": 5, "luc10": 5}


def packed_key(ecoregion: Column, country: Column, luc0: Column, luc5: Column, luc10: Column) -> Column:
    """The hard attributes in one long: ecoregion above bit 32, country above 16, classes above 10, 5 and 0. Out of range is an error."""
    at, key, bad = {"ecoregion": 32, "country": 16, "luc0": 10, "luc5": 5, "luc10": 0}, F.lit(0).cast("long"), F.lit(False)
    for (name, bits), value in zip(KEY_BITS.items(), (ecoregion, country, luc0, luc5, luc10), strict=True):
        bad = bad | (value < 0) | (value >= 2**bits)
        key = key.bitwiseOR(F.shiftleft(value.cast("long"), at[name]))
    return F.when(bad, F.raise_error(F.lit("an attribute is too large for the packed key")).cast("long")).otherwise(key)


def within(a: Column, b: Column, width: float | Column) -> Column:
    """Whether a lies in b's band, both ends included. A negative width is a share of b. NaN lies in no band."""
    if not isinstance(width, Column):
        width = F.lit(float(width))
    half = F.when(width < 0, -width * b).otherwise(width)
    return (a >= b - half) & (a <= b + half) & ~F.isnan(a) & ~F.isnan(b)


def all_true(*conditions: Column) -> Column:
    """Conjunction across columns; null counts as false."""
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out


def tile_name_year(path: Column, pattern: str = r"_([0-9]{4})_") -> Column:
    """The year in a tile's file name; null if there is none."""
    found = F.regexp_extract(path, pattern, 1)
    return F.when(found != "", found.cast("int"))


def tile_corner(path: Column) -> tuple[Column, Column]:
    """Latitude and longitude of a tile from N10_W070 or ID11_S10_E20 in its name; null if there is none."""
    parts = [F.regexp_extract(path, "([NS])([0-9]{1,2})_([EW])([0-9]{1,3})", i) for i in range(1, 5)]
    signed = lambda side, n, minus: F.when(n != "", n.cast("int") * F.when(side == minus, -1).otherwise(1))
    return signed(parts[0], parts[1], "S"), signed(parts[2], parts[3], "W")


def uniform(seed: int, *columns: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the values alone."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) / float(1 << 52)
