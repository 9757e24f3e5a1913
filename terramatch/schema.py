"""Relations of the matching pipeline: land-use classes, column sets by year, schemas and their checks."""

from __future__ import annotations

from enum import IntEnum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Classes of land use and their numbers.
class LandUse(IntEnum):
    UNDISTURBED = 1
    DEGRADED = 2
    DEFORESTED = 3
    REGROWTH = 4
    WATER = 5
    OTHER = 6


#: Widths of the bands within which a candidate pixel's attributes may differ from a treated pixel's.
TOLERANCES = {"elevation": 200.0, "slope": 2.5, "access": 10.0, "cpc0_u": 0.1, "cpc0_d": 0.1, "cpc5_u": 0.1, "cpc5_d": 0.1, "cpc10_u": 0.1, "cpc10_d": 0.1}
#: Fixed value: mass of carbon dioxide over mass of its carbon.
CO2_PER_CARBON = 44.0 / 12.0
#: Total biomass over above-ground biomass, and carbon over biomass.
BIOMASS_FACTOR, CARBON_SHARE = 1.31, 0.47


def matching_years(start: int) -> tuple[int, int, int]:
    """Years whose classes must agree: the start, five and ten years before it."""
    return start, start - 5, start - 10


def stored_years(start: int, end: int) -> range:
    """Years whose classes are kept: from ten years before the start to the end, inclusive."""
    return range(start - 10, end + 1)


def hard_columns(start: int) -> list[str]:
    return ["country", "ecoregion", *(f"luc_{y}" for y in matching_years(start)[::-1])]


def pixel_schema(start: int, end: int) -> T.StructType:
    """Treated pixels: place, attributes, classes by year, and coverages."""
    fields = [("x", T.IntegerType()), ("y", T.IntegerType()), ("lat", T.DoubleType()), ("lng", T.DoubleType()), ("elevation", T.DoubleType()), ("slope", T.DoubleType()), ("ecoregion", T.IntegerType()), ("access", T.DoubleType()), ("country", T.IntegerType())]
    fields += [(f"luc_{y}", T.IntegerType()) for y in stored_years(start, end)] + [(f"cpc{n}_{c}", T.DoubleType()) for n in (0, 5, 10) for c in "ud"]
    return T.StructType([T.StructField(*x) for x in fields])


SERIES = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("value", T.DoubleType())])
SCHEDULE = T.StructType([T.StructField("est_year", T.IntegerType()), T.StructField("for_year", T.IntegerType()), T.StructField("release", T.DoubleType())])
DENSITY = T.StructType([T.StructField("luc", T.IntegerType()), T.StructField("density", T.DoubleType())])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df's columns in the schema's order and types; a missing one is an error."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Columns by prefix, in the table's order."""
    return [c for c in df.columns if c.startswith(prefix)]


def first_luc_year(df: DataFrame, prefix: str = "k_luc_") -> int | None:
    """Earliest year among the class columns."""
    years = [int(c.removeprefix(prefix)) for c in df.columns if c.startswith(prefix) and c.removeprefix(prefix).isdigit()]
    return min(years, default=None)
