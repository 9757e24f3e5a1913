"""Geodesy on columns: zones, aspect ratio, metric cell sizes, tile indices, and the forward transverse Mercator projection."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: eccentricity of the ellipsoid in the aspect ratio.
ECCENTRICITY = 0.081819191
#: The ellipsoid of WGS 84, and the scale and false origins of UTM.
SEMI_MAJOR, FLATTENING, UTM_SCALE, FALSE_EAST, FALSE_NORTH = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0
HECTARE = 10000.0
#: Fixed value: letters of UTM latitude bands, from 80 degrees south in steps of 8.
BANDS = "CDEFGHJKLMNPQRSTUVWX"


def utm_zone(lng: Column) -> Column:
    return (F.pmod(F.floor((lng + 180.0) / 6.0), F.lit(60)) + 1).cast("int")


def utm_epsg(lat: Column, lng: Column) -> Column:
    """EPSG code of the zone of a point; the equator is north."""
    return utm_zone(lng) + F.when(lat < 0, 32700).otherwise(32600)


def utm_band(lat: Column) -> Column:
    """Letter of the latitude band; null beyond 80 south and 84 north. The northernmost band is 12 degrees high."""
    step = F.least(F.floor((lat + 80.0) / 8.0), F.lit(19)).cast("int")
    return F.when((lat >= -80) & (lat < 84), F.substring(F.lit(BANDS), step + 1, F.lit(1)))


def utm_box(zone: Column, letter: Column) -> dict[str, Column]:
    """Bounds in degrees of a zone and band."""
    south = (F.position(letter, F.lit(BANDS)) - 1) * 8.0 - 80.0
    return {"west": zone * 6.0 - 186.0, "east": zone * 6.0 - 180.0, "south": south, "north": south + F.when(letter == "X", 12.0).otherwise(8.0)}


def aspect_ratio(lat: Column) -> Column:
    """Pixels in x that span the ground distance of one pixel in y."""
    s = F.sin(F.radians(lat))
    w = 1.0 - ECCENTRICITY**2 * s * s
    return (1.0 - ECCENTRICITY**2) / F.pow(w, F.lit(1.5)) / (F.cos(F.radians(lat)) / F.sqrt(w))


def metres_per_degree(lat: Column) -> tuple[Column, Column]:
    """Ground lengths of a degree of longitude and of latitude on the ellipsoid."""
    e2 = FLATTENING * (2 - FLATTENING)
    s = F.sin(F.radians(lat))
    w = 1.0 - e2 * s * s
    return math.pi / 180 * SEMI_MAJOR * F.cos(F.radians(lat)) / F.sqrt(w), math.pi / 180 * SEMI_MAJOR * (1 - e2) / F.pow(w, F.lit(1.5))


def utm_forward(lat: Column, lng: Column, zone: Column, south: Column | None = None) -> tuple[Column, Column]:
    """Easting and northing by Krüger's series to the third order (Karney, 2011): millimetres within a zone. south: whether northings get the
    southern false origin, by default where the latitude is negative; shapes across the equator need one origin for all points."""
    n = FLATTENING / (2 - FLATTENING)
    a = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    c = 2 * math.sqrt(n) / (1 + n)
    s, dl = F.sin(F.radians(lat)), F.radians(lng - (zone * 6.0 - 183.0))
    atanh = lambda v: 0.5 * F.log((1.0 + v) / (1.0 - v))
    t = F.sinh(atanh(s) - c * atanh(c * s))
    xi, eta = F.atan2(t, F.cos(dl)), atanh(F.sin(dl) / F.sqrt(1.0 + t * t))
    east, north = eta, xi
    for j, x in enumerate(alpha, 1):
        east = east + x * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + x * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return FALSE_EAST + UTM_SCALE * a * east, UTM_SCALE * a * north + F.when(lat < 0 if south is None else south, FALSE_NORTH).otherwise(0.0)


def utm_inverse(east: Column, north: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Latitude and longitude by the inverse of utm_forward, to the same order. south: whether northings have the southern false origin."""
    n = FLATTENING / (2 - FLATTENING)
    a = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    xi = (north - F.when(south, FALSE_NORTH).otherwise(0.0)) / (UTM_SCALE * a)
    eta = (east - FALSE_EAST) / (UTM_SCALE * a)
    x, y = xi, eta
    for j, b in enumerate(beta, 1):
        x = x - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        y = y - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(x) / F.cosh(y))
    lat = chi
    for j, d in enumerate(delta, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return F.degrees(lat), zone * 6.0 - 183.0 + F.degrees(F.atan2(F.sinh(y), F.cos(x)))


def hectares(square_metres: Column) -> Column:
    return square_metres / HECTARE


def square_metres(ha: Column) -> Column:
    return ha * HECTARE


def pixel_of(value: Column, origin: float, step: float) -> Column:
    """Index of the pixel that holds a coordinate."""
    return F.floor((value - origin) / step).cast("int")


def centre_of(index: Column, origin: float, step: float) -> Column:
    """Coordinate of a pixel's centre."""
    return origin + (index + 0.5) * step


def srtm_tile(lat: Column, lng: Column) -> tuple[Column, Column]:
    """Column and row of the five-degree elevation tile with a point: columns from 180 west, rows from 60 north, both from 1."""
    return (F.floor((lng + 180.0) / 5.0) + 1).cast("int"), (F.floor((60.0 - lat) / 5.0) + 1).cast("int")


def srtm_name(column: Column, row: Column) -> Column:
    return F.format_string("srtm_%02d_%02d", column, row)


def degree_name(lat: Column, lng: Column) -> Column:
    """N10_W070 and the like."""
    return F.concat(F.when(lat < 0, "S").otherwise("N"), F.abs(lat).cast("int").cast("string"), F.lit("_"), F.when(lng < 0, "W").otherwise("E"), F.abs(lng).cast("int").cast("string"))
