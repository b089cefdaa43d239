"""UTM zones and the WGS84 transverse Mercator projection as Column arithmetic.

The projection is the Krueger series to order six (Karney 2011, J. Geodesy 85:475). The
coefficients follow from the ellipsoid; they are evaluated once on the driver and enter the
expressions as literals.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundloom.functions.indices import as_col

# WGS84 ellipsoid and UTM constants.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
UTM_SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0

_N = FLATTENING / (2 - FLATTENING)
_E = math.sqrt(FLATTENING * (2 - FLATTENING))
_RECT = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)


def _poly(*coefficients: float) -> float:
    """Sum of c_k * n^(k) with the first coefficient belonging to n^1."""
    return sum(c * _N ** (k + 1) for k, c in enumerate(coefficients))


# Series coefficients in the third flattening n, forward and inverse.
ALPHA = [
    _poly(1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800),
    _poly(0, 13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360),
    _poly(0, 0, 61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440),
    _poly(0, 0, 0, 49561 / 161280, -179 / 168, 6601661 / 7257600),
    _poly(0, 0, 0, 0, 34729 / 80640, -3418889 / 1995840),
    _poly(0, 0, 0, 0, 0, 212378941 / 319334400),
]
BETA = [
    _poly(1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800),
    _poly(0, 1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720),
    _poly(0, 0, 17 / 480, -37 / 840, -209 / 4480, 5569 / 90720),
    _poly(0, 0, 0, 4397 / 161280, -11 / 504, -830251 / 7257600),
    _poly(0, 0, 0, 0, 4583 / 161280, -108847 / 3991680),
    _poly(0, 0, 0, 0, 0, 20648693 / 638668800),
]


def utm_zone(lon: Column | str) -> Column:
    return (F.pmod(F.floor((as_col(lon) + 180) / 6), F.lit(60)) + 1).cast("int")


def utm_epsg(lat: Column | str, lon: Column | str) -> Column:
    return F.when(as_col(lat) >= 0, utm_zone(lon) + 32600).otherwise(utm_zone(lon) + 32700)


def _central_meridian(epsg: int) -> float:
    return (epsg % 100) * 6 - 183.0


def _is_utm(epsg: int) -> bool:
    return 32601 <= epsg <= 32660 or 32701 <= epsg <= 32760


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    Plain nesting would repeat the value wherever it is used, and a filter on the result would
    multiply the expression with every step.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pair(a: Column, b: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"))


def _conformal(tau: Column) -> Column:
    """Tangent of the conformal latitude from the tangent of the geographic latitude."""
    root = F.sqrt(1 + tau * tau)
    return _let(F.sinh(_E * F.atanh(_E * tau / root)), lambda s: tau * F.sqrt(1 + s * s) - s * root)


def _series(xi: Column, eta: Column, coefficients: list[float], sign: int) -> Column:
    north, east = xi, eta
    for k, c in enumerate(coefficients, start=1):
        north = north + sign * c * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
        east = east + sign * c * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
    return _pair(north, east)


def _to_utm(x: Column, y: Column, epsg: int) -> Column:
    """Pair of northing and easting in the order (a, b)."""
    shift, scale = (0.0 if epsg < 32700 else FALSE_NORTHING_SOUTH), UTM_SCALE * _RECT
    lam = F.radians(x - _central_meridian(epsg))
    sphere = _let(F.tan(F.radians(y)), lambda tau: _let(_pair(_conformal(tau), lam), lambda p: _pair(
        F.atan2(p["a"], F.cos(p["b"])),
        F.asinh(F.sin(p["b"]) / F.sqrt(p["a"] * p["a"] + F.cos(p["b"]) * F.cos(p["b"]))))))
    plane = _let(sphere, lambda p: _series(p["a"], p["b"], ALPHA, 1))
    return _let(plane, lambda p: _pair(shift + scale * p["a"], FALSE_EASTING + scale * p["b"]))


def _newton(goal: Column, tau: Column) -> Column:
    """One step towards the geographic latitude whose conformal latitude is the goal."""
    return _let(_conformal(tau), lambda got: tau + (goal - got) / F.sqrt(1 + got * got)
                * (1 + (1 - _E * _E) * tau * tau) / ((1 - _E * _E) * F.sqrt(1 + tau * tau)))


def _from_utm(x: Column, y: Column, epsg: int) -> Column:
    """Pair of latitude and longitude in the order (a, b)."""
    shift, scale = (0.0 if epsg < 32700 else FALSE_NORTHING_SOUTH), UTM_SCALE * _RECT
    sphere = _let(_pair((y - shift) / scale, (x - FALSE_EASTING) / scale),
                  lambda p: _series(p["a"], p["b"], BETA, -1))

    def latitude(goal: Column) -> Column:
        return _let(goal / (1 - _E * _E), lambda t: _let(_newton(goal, t), lambda u: _let(
            _newton(goal, u), lambda v: F.degrees(F.atan(_newton(goal, v))))))

    return _let(sphere, lambda p: _pair(
        _let(F.sin(p["a"]) / F.sqrt(F.sinh(p["b"]) * F.sinh(p["b"]) + F.cos(p["a"]) * F.cos(p["a"])), latitude),
        F.degrees(F.atan2(F.sinh(p["b"]), F.cos(p["a"]))) + _central_meridian(epsg)))


def _moved(x: Column, y: Column, from_epsg: int, to_epsg: int) -> Column:
    """Pair of the new y and x in the order (a, b)."""
    for epsg in (from_epsg, to_epsg):
        if epsg != 4326 and not _is_utm(epsg):
            raise ValueError(f"unsupported coordinate system: {epsg}")
    place = _pair(y.cast("double"), x.cast("double"))
    if from_epsg == to_epsg:
        return place
    if from_epsg != 4326:
        place = _let(place, lambda p: _from_utm(p["b"], p["a"], from_epsg))
    if to_epsg != 4326:
        place = _let(place, lambda p: _to_utm(p["b"], p["a"], to_epsg))
    return place


def reproject(df: DataFrame, x: str, y: str, from_epsg: int, to_epsg: int) -> DataFrame:
    """Replace the coordinate columns ``x`` and ``y``; systems are 4326 and the UTM zones."""
    place = _moved(F.col(x), F.col(y), from_epsg, to_epsg)
    moved = df.select(*df.columns, F.inline(F.array(place)).alias("_a", "_b"))     # both axes in one evaluation
    return moved.withColumns({x: F.col("_b"), y: F.col("_a")}).drop("_a", "_b")


def reproject_ring(ring: Column | str, from_epsg: int, to_epsg: int) -> Column:
    """Vertex array in another coordinate system."""
    return F.transform(as_col(ring), lambda p: _let(
        _moved(p["x"], p["y"], from_epsg, to_epsg), lambda q: F.struct(q["b"].alias("x"), q["a"].alias("y"))))


def epsg_of(lat: float, lon: float) -> int:
    """UTM system of a position, for the driver."""
    return (32600 if lat >= 0 else 32700) + math.floor((lon + 180) / 6) % 60 + 1
