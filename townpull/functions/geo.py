"""Geometry and pull-model expressions as native Column functions (no UDFs)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from townpull.schema import (EARTH_RADIUS_KM, FORCE_K, MERCATOR_RADIUS_M, RADIUS_MIN_KM,
                             RADIUS_POP_SCALE, RADIUS_SPAN_KM)

ColumnOrName = Column | str


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def influence_radius_km(pop: ColumnOrName, lo: float = RADIUS_MIN_KM, span: float = RADIUS_SPAN_KM,
                        scale: float = RADIUS_POP_SCALE) -> Column:
    """G1: ``lo + span * (1 - exp(-pop / scale))``; null population gives null."""
    p = _c(pop).cast("double")
    return F.lit(lo) + F.lit(span) * (F.lit(1.0) - F.exp(-p / F.lit(scale)))


def pull_force(distance: ColumnOrName, radius: ColumnOrName, k: float = FORCE_K) -> Column:
    """``exp(-k * d / r)``; inside the radius always above exp(-k)."""
    return F.exp(F.lit(-k) * _c(distance) / _c(radius))


def haversine_km(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName,
                 radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km."""
    la1, lo1, la2, lo2 = (_c(x) for x in (lat1, lon1, lat2, lon2))
    dphi = F.radians(la2 - la1)
    dlam = F.radians(lo2 - lo1)
    a = (F.pow(F.sin(dphi / 2), 2)
         + F.cos(F.radians(la1)) * F.cos(F.radians(la2)) * F.pow(F.sin(dlam / 2), 2))
    return F.lit(radius_km) * (F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))


def point(lon: ColumnOrName, lat: ColumnOrName) -> Column:
    """A point as ``struct(lon AS x, lat AS y)`` (x = longitude)."""
    return F.struct(_c(lon).cast("double").alias("x"), _c(lat).cast("double").alias("y"))


def mercator_y(lat: ColumnOrName) -> Column:
    """Unit-sphere Web-Mercator ordinate ``ln tan(pi/4 + phi/2)``."""
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(_c(lat)) / 2))


def web_mercator_xy(lon: ColumnOrName, lat: ColumnOrName) -> Column:
    """EPSG:4326 -> EPSG:3857 metres as ``struct(x, y)``."""
    r = F.lit(MERCATOR_RADIUS_M)
    return F.struct((r * F.radians(_c(lon))).alias("x"), (r * mercator_y(lat)).alias("y"))


def mercator_cos_km(town_lat: ColumnOrName, town_lon: ColumnOrName, lat: ColumnOrName,
                    lon: ColumnOrName) -> Column:
    """Planar Web-Mercator distance scaled by cos(town latitude), in km.

    Asymmetric (uses the first point's latitude) and without wrap at +-180 degrees,
    as the parity metric requires.
    """
    r = F.lit(MERCATOR_RADIUS_M)
    dx = r * (F.radians(_c(town_lon)) - F.radians(_c(lon)))
    dy = r * (mercator_y(town_lat) - mercator_y(lat))
    return F.sqrt(dx * dx + dy * dy) * F.cos(F.radians(_c(town_lat))) / F.lit(1000.0)


def distance_km(metric: str, town_lat, town_lon, lat, lon) -> Column:
    if metric == "haversine":
        return haversine_km(town_lat, town_lon, lat, lon)
    if metric == "mercator_cos":
        return mercator_cos_km(town_lat, town_lon, lat, lon)
    raise ValueError(f"unknown metric {metric!r}; use 'haversine' or 'mercator_cos'")


def to_int(c: ColumnOrName, default: int | None = None) -> Column:
    """Lenient integer: any number is cut to its whole part (``12.7``, ``1e5``); junk and
    what an int cannot hold give null (or ``default``)."""
    v = whole_number(_c(c), "int")
    return v if default is None else F.coalesce(v, F.lit(default))


def to_double(c: ColumnOrName, default: float | None = None) -> Column:
    """Lenient double; junk gives null (or ``default``)."""
    v = _try_cast(_c(c), "double")
    return v if default is None else F.coalesce(v, F.lit(float(default)))


def _try_cast(c: Column, t: str) -> Column:
    return c.try_cast(t)


def whole_number(c: Column, t: str) -> Column:
    """The whole part of a number or of a number's text as type ``t``; else null."""
    d = c.cast("string").try_cast("double")
    exact = c.cast("string").try_cast(t)   # ids beyond 2**53 keep every digit
    return F.coalesce(exact, F.when(~F.isnan(d) & (F.abs(d) < 9.2e18), d.try_cast("long").try_cast(t)))


def edge_pairs(ring: Column) -> Column:
    """Edges of a ring as ``array<struct<a, b>>``, closing the ring if it is open."""
    n = F.size(ring)
    idx = F.sequence(F.lit(0), n - 1)
    return F.transform(idx, lambda i: F.struct(
        F.element_at(ring, i + 1).alias("a"),
        F.element_at(ring, F.when(i + 1 < n, i + 2).otherwise(F.lit(1))).alias("b")))


def point_in_ring(lat: ColumnOrName, lon: ColumnOrName, ring: ColumnOrName) -> Column:
    """Strict containment of (lat, lon) in a ring of ``struct(lat, lon)``.

    Even-odd crossing count over the edges; a point on an edge or vertex is outside.
    The ring may be closed (first vertex repeated) or open.
    """
    r = _c(ring)
    return F.when(r.isNull() | (F.size(r) < 3), F.lit(False)).otherwise(inside_edges(lat, lon, edge_pairs(r)))


def inside_edges(lat: ColumnOrName, lon: ColumnOrName, edges: ColumnOrName) -> Column:
    """The same test on edges ``array<struct<a, b>>``; those whose latitudes do not span the
    point's may be missing, they change nothing."""
    y, x, edges = _c(lat), _c(lon), _c(edges)

    def on_edge(e):
        ay, ax, by, bx = e["a"]["lat"], e["a"]["lon"], e["b"]["lat"], e["b"]["lon"]
        cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        return ((cross == 0) & (x >= F.least(ax, bx)) & (x <= F.greatest(ax, bx))
                & (y >= F.least(ay, by)) & (y <= F.greatest(ay, by)))

    def crosses(e):
        ay, ax, by, bx = e["a"]["lat"], e["a"]["lon"], e["b"]["lat"], e["b"]["lon"]
        straddles = (ay > y) != (by > y)
        x_at = ax + (y - ay) * (bx - ax) / (by - ay)
        return straddles & (x < x_at)

    n_cross = F.aggregate(edges, F.lit(0), lambda acc, e: acc + F.when(crosses(e), 1).otherwise(0))
    touching = F.exists(edges, on_edge)
    return ~touching & (n_cross % 2 == 1)


def ring_area2(ring: ColumnOrName) -> Column:
    """Twice the signed shoelace area of a ring in (lon, lat) degrees."""
    edges = edge_pairs(_c(ring))
    return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + (
        e["a"]["lon"] * e["b"]["lat"] - e["b"]["lon"] * e["a"]["lat"]))


def ring_is_usable(ring: ColumnOrName) -> Column:
    """At least 3 distinct non-null vertices that are not all on one line. The signed areas of
    a ring that crosses itself may cancel; it is usable all the same. So is one over the antimeridian
    (an edge spans over 180 degrees), which may go round a pole along one latitude."""
    r = _c(ring)
    no_nulls = ~F.exists(r, lambda p: p.isNull() | p["lat"].isNull() | p["lon"].isNull())
    # a vertex unlike the first, and one unlike both: one pass each, however many there are
    first = F.get(r, 0)
    other = F.get(F.filter(r, lambda p: p != first), 0)
    distinct_ok = F.exists(r, lambda p: (p != first) & (p != other))

    def fan(e):   # twice the area of the triangle of an edge and the first vertex
        return F.abs((e["a"]["lon"] - first["lon"]) * (e["b"]["lat"] - first["lat"])
                     - (e["b"]["lon"] - first["lon"]) * (e["a"]["lat"] - first["lat"]))

    spread = F.aggregate(edge_pairs(r), F.lit(0.0), lambda acc, e: acc + fan(e))
    over = F.exists(edge_pairs(r), lambda e: F.abs(e["b"]["lon"] - e["a"]["lon"]) > 180.0)
    return F.coalesce(r.isNotNull() & no_nulls & distinct_ok & ((spread > F.lit(1e-12)) | over), F.lit(False))
