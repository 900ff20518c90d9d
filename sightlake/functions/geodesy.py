"""Circular buffers around points, as Column expressions.

A point is projected onto a transverse Mercator plane whose central meridian runs
through it, a circle is drawn there, and the circle is projected back. Both ways use
the published Krüger series on the WGS84 ellipsoid. On its own central meridian a
point has x = 0, and for a fixed radius everything that depends on the vertex alone
is a constant, so per row only the terms in the northing are left to compute.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS84 (fixed values).
EQUATOR_RADIUS = 6378137.0
FLATTENING = 1 / 298.257223563

_N = FLATTENING / (2 - FLATTENING)
_E = math.sqrt(FLATTENING * (2 - FLATTENING))
RECTIFYING_RADIUS = EQUATOR_RADIUS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)

# Krüger series coefficients to the fourth order in the third flattening.
ALPHA = [
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
]
BETA = [
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
]
DELTA = [
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
]


# The expressions below are SQL text: a few hundred terms parse in one go, where building
# them column by column takes longer than computing them.


def _series(coefficients: list[float], function: str, x: str, factor: str = "1") -> str:
    """Sum of coefficient * function(2 j x), each term times a factor that may name {j}."""
    return " + ".join(
        f"{k!r}D * {function}({2 * j} * {x}) * {factor.format(j=j)}"
        for j, k in enumerate(coefficients, start=1)
    )


def _let(name: str, value: str, body: str) -> str:
    """Bind a value to a name: a lambda over one element computes it once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _northing(latitude: str, body: str) -> str:
    """Bind ``centre``, the northing of a point on its own central meridian.

    In units of the rectifying radius, by way of the conformal latitude ``chi``.
    """
    chi = "atan(tan(phi) * sqrt(1 + sigma * sigma) - sigma * sqrt(1 + tan(phi) * tan(phi)))"
    return _let("phi", f"radians({latitude})", _let(
        "sigma", f"sinh({_E!r}D * atanh({_E!r}D * sin(phi)))", _let(
            "chi", chi, _let("centre", f"chi + {_series(ALPHA, 'sin', 'chi')}", body))))


def _eastern_half(radius_m: float, quad_segs: int) -> str:
    """Constants of the eastern half circle's vertices, clockwise from north to south."""
    vertices = []
    for k in range(2 * quad_segs + 1):
        angle = math.pi / 2 * (1 - k / quad_segs)
        xi = radius_m * math.sin(angle) / RECTIFYING_RADIUS
        eta = radius_m * (0.0 if k % (2 * quad_segs) == 0 else math.cos(angle)) / RECTIFYING_RADIUS
        fields = [f"{xi!r}D AS dxi", f"{eta!r}D AS eta"]
        for j in range(1, len(BETA) + 1):
            fields.append(f"{math.cosh(2 * j * eta)!r}D AS ch{j}")
            fields.append(f"{math.sinh(2 * j * eta)!r}D AS sh{j}")
        vertices.append(f"struct({', '.join(fields)})")
    return f"array({', '.join(vertices)})"


def _side(part: str, longitude: str, sign: str) -> str:
    lon = f"{longitude} {sign} p.dlon"
    wrapped = f"CASE WHEN {lon} > 180 THEN {lon} - 360 WHEN {lon} < -180 THEN {lon} + 360 ELSE {lon} END"
    return f"transform({part}, p -> named_struct('lon', {wrapped}, 'lat', p.lat))"


def buffer_ring(
    longitude: str, latitude: str, radius_km: float = 100, quad_segs: int = 16
) -> Column:
    """Ring around the point in two columns as array<struct<lon, lat>>; null for a null point.

    ``4 * quad_segs + 1`` vertices, clockwise from east, the first repeated at the end. The
    western half mirrors the eastern one, which alone is computed.
    """
    placed = (
        f"transform({_eastern_half(radius_km * 1000, quad_segs)}, "
        "v -> named_struct('xi', centre + v.dxi, 'v', v))"
    )
    conformal = (
        f"transform({placed}, p -> named_struct("
        f"'xi', p.xi - ({_series(BETA, 'sin', 'p.xi', 'p.v.ch{j}')}), "
        f"'eta', p.v.eta - ({_series(BETA, 'cos', 'p.xi', 'p.v.sh{j}')})))"
    )
    spherical = (
        f"transform({conformal}, p -> named_struct("
        "'dlon', atan2(sinh(p.eta), cos(p.xi)), 'chi', asin(sin(p.xi) / cosh(p.eta))))"
    )
    geographic = (
        f"transform({spherical}, p -> named_struct("
        f"'dlon', degrees(p.dlon), 'lat', degrees(p.chi + {_series(DELTA, 'sin', 'p.chi')})))"
    )
    quarter = quad_segs + 1
    sides = [
        _side(f"slice(east, {quarter}, {quarter})", longitude, "+"),
        _side(f"reverse(slice(east, 2, {2 * quad_segs - 1}))", longitude, "-"),
        _side(f"slice(east, 1, {quarter})", longitude, "+"),
    ]
    ring = _northing(latitude, _let("east", geographic, f"concat({', '.join(sides)})"))
    return F.expr(f"CASE WHEN {longitude} IS NOT NULL AND {latitude} IS NOT NULL THEN {ring} END")


def ring_to_geojson(ring: Column) -> Column:
    """GeoJSON text of the polygon a ring encloses; null for a null ring."""
    pairs = F.transform(ring, lambda p: F.array(p["lon"], p["lat"]))
    polygon = F.struct(F.lit("Polygon").alias("type"), F.array(pairs).alias("coordinates"))
    return F.when(ring.isNotNull(), F.to_json(polygon))


def with_distance(
    df: DataFrame, lon1: str, lat1: str, lon2: str, lat2: str, name: str = "metres", rounds: int = 6
) -> DataFrame:
    """df with the length of the shortest line between two points on the ellipsoid, in metres.

    The published inverse solution on the auxiliary sphere, its longitude improved a fixed number of
    times: for points up to a few thousand kilometres apart six times settle it below a micrometre.
    Equal points are 0 apart, a null coordinate gives null.
    """
    polar_radius = EQUATOR_RADIUS * (1 - FLATTENING)
    columns = [F.col(f"`{c}`") for c in df.columns]
    c = F.col

    def reduced(latitude: str) -> Column:
        return F.atan(F.lit(1 - FLATTENING) * F.tan(F.radians(c(latitude))))

    df = df.withColumns({
        "__u1": reduced(lat1), "__u2": reduced(lat2), "__l": F.radians(c(lon2) - c(lon1))})
    df = df.withColumns({
        "__s1": F.sin("__u1"), "__c1": F.cos("__u1"), "__s2": F.sin("__u2"), "__c2": F.cos("__u2"),
        "__lam": c("__l")})
    for _ in range(rounds):
        df = df.withColumns({"__sl": F.sin("__lam"), "__cl": F.cos("__lam")})
        df = df.withColumns({
            "__ss": F.sqrt(
                F.pow(c("__c2") * c("__sl"), 2)
                + F.pow(c("__c1") * c("__s2") - c("__s1") * c("__c2") * c("__cl"), 2)),
            "__cs": c("__s1") * c("__s2") + c("__c1") * c("__c2") * c("__cl")})
        df = df.withColumns({
            "__sig": F.atan2("__ss", "__cs"),
            "__sa": F.when(c("__ss") == 0, 0.0).otherwise(c("__c1") * c("__c2") * c("__sl") / c("__ss"))})
        df = df.withColumn("__ca2", 1 - c("__sa") * c("__sa"))
        df = df.withColumns({
            # On the equator no line has a middle away from it.
            "__m": F.when(c("__ca2") == 0, 0.0).otherwise(
                c("__cs") - 2 * c("__s1") * c("__s2") / c("__ca2")),
            "__k": F.lit(FLATTENING / 16) * c("__ca2") * (4 + FLATTENING * (4 - 3 * c("__ca2")))})
        df = df.withColumn("__lam", c("__l") + (1 - c("__k")) * FLATTENING * c("__sa") * (
            c("__sig") + c("__k") * c("__ss") * (
                c("__m") + c("__k") * c("__cs") * (2 * c("__m") * c("__m") - 1))))
    df = df.withColumn("__q", c("__ca2") * (EQUATOR_RADIUS**2 / polar_radius**2 - 1))
    q, m = c("__q"), c("__m")
    df = df.withColumns({
        "__a": 1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q))),
        "__b": q / 1024 * (256 + q * (-128 + q * (74 - 47 * q)))})
    a, b, ss = c("__a"), c("__b"), c("__ss")
    change = b * ss * (m + b / 4 * (
        c("__cs") * (2 * m * m - 1) - b / 6 * m * (4 * ss * ss - 3) * (4 * m * m - 3)))
    return df.select(*columns, (polar_radius * a * (c("__sig") - change)).alias(name))
