"""Rings as parts of a region: the antimeridian, self-crossing, outlines and shared borders.

* ``split_antimeridian``: a ring one of whose edges spans more than 180 degrees of longitude goes
  the short way round, over the antimeridian. It is unrolled to continuous longitudes and kept twice,
  a turn apart, so that either side of the antimeridian finds it. A ring that does not come back to its
  start goes round a pole and is closed over the nearer one. Other rings are not touched.
* ``ring_verdicts``: whether a ring is usable (G10) and whether it crosses or touches itself.
* ``boundary_outline`` (C11): the edges of all rings, turned one way, less those that two rings hold
  in opposite directions: the outline of districts that adjoin along equal edges.
* ``arcs`` / ``covers_circle``: whether a point on the borders of rings lies inside their union.
  Around the point each ring takes some sectors between the directions of its edges there; the
  union holds the point if no sector is left free. That is so on a border that two districts share, whether
  or not their vertices agree, and at a corner where several meet; not on the union's own border.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townpull.functions.geo import edge_pairs, ring_area2, ring_is_usable

SLIVER = 1e-9   # radians; narrower sectors are rounding between borders that coincide
ARCS = "array<struct<odd:boolean,angles:array<double>>>"
TURN = 2 * math.pi


def _over(ring: Column) -> Column:
    return F.exists(edge_pairs(ring), lambda e: F.abs(e["b"]["lon"] - e["a"]["lon"]) > 180.0)


def unrolled(lat, lon):
    """The vertices of a ring (arrays) with continuous longitudes; round a pole, closed over it."""
    import numpy as np
    if len(lat) > 1 and lat[0] == lat[-1] and lon[0] == lon[-1]:
        lat, lon = lat[:-1], lon[:-1]
    step = np.diff(np.append(lon, lon[0]))
    turns = np.where(step > 180, -360.0, np.where(step < -180, 360.0, 0.0))
    out = lon + np.concatenate(([0.0], np.cumsum(turns[:-1])))
    total = float(turns.sum())
    if total:
        pole = 90.0 if lat.mean() >= 0 else -90.0
        lat, out = np.append(lat, [lat[0], pole, pole]), np.append(out, [lon[0] + total, lon[0] + total, out[0]])
    return lat, out


def split_antimeridian(rings: DataFrame) -> DataFrame:
    """``rings`` (id, ring_no, ring, lat_min, lat_max, lon_min, lon_max) with rings that pass the
    antimeridian unrolled and held on both of its sides, under their own id and number."""
    def unroll(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for b in batches:
            for i in range(b.num_rows):
                ring = b.column("ring")[i].as_py()
                lat, lon = unrolled(np.array([p["lat"] for p in ring], float), np.array([p["lon"] for p in ring], float))
                for turn in (-360.0, 0.0, 360.0):
                    if lon.min() + turn >= 180 or lon.max() + turn < -180:   # places have longitudes from -180 to below 180
                        continue
                    row = {"ring": [{"lat": a, "lon": o} for a, o in zip(lat.tolist(), (lon + turn).tolist())],
                           "lat_min": float(lat.min()), "lat_max": float(lat.max()),
                           "lon_min": float(lon.min() + turn), "lon_max": float(lon.max() + turn)}
                    yield pa.RecordBatch.from_arrays(
                        [b.column(c).slice(i, 1) if c in ("id", "ring_no") else pa.array([row[c]], b.schema.field(c).type)
                         for c in b.schema.names], b.schema.names)

    over = _over(F.col("ring"))
    return rings.filter(~over).unionAll(rings.filter(over).mapInArrow(unroll, rings.schema))


def _orientation(ax, ay, bx, by, cx, cy):
    import numpy as np
    return np.sign((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def _meet(p, q):
    """Which of the segments p meet those of q (arrays n x 4: ax, ay, bx, by)."""
    ax, ay, bx, by = p.T
    cx, cy, dx, dy = q.T
    o = [_orientation(ax, ay, bx, by, cx, cy), _orientation(ax, ay, bx, by, dx, dy),
         _orientation(cx, cy, dx, dy, ax, ay), _orientation(cx, cy, dx, dy, bx, by)]

    def between(x, y, ax, ay, bx, by):
        import numpy as np
        return (x >= np.minimum(ax, bx)) & (x <= np.maximum(ax, bx)) & (y >= np.minimum(ay, by)) & (y <= np.maximum(ay, by))

    met = (o[0] * o[1] < 0) & (o[2] * o[3] < 0)
    met |= (o[0] == 0) & between(cx, cy, ax, ay, bx, by) | (o[1] == 0) & between(dx, dy, ax, ay, bx, by)
    return met | (o[2] == 0) & between(ax, ay, cx, cy, dx, dy) | (o[3] == 0) & between(bx, by, cx, cy, dx, dy)


def crosses_itself(x, y) -> bool:
    """Whether two edges of a ring (open or closed) share more than the vertex between neighbours.

    Edges sorted by their west end are compared, all at once, with the next, the one after it and so
    on, as long as they begin before the edge ends; so the work is in the pairs that overlap in longitude."""
    import numpy as np
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    x, y = x[keep], y[keep]
    if len(x) > 1 and x[0] == x[-1] and y[0] == y[-1]:
        x, y = x[:-1], y[:-1]
    n = len(x)
    if n < 3:
        return False
    e = np.stack((x, y, np.roll(x, -1), np.roll(y, -1)), axis=1)
    nxt = np.roll(e, -1, axis=0)
    # neighbours: one turns back over the other
    back = (_orientation(*e.T, nxt[:, 2], nxt[:, 3]) == 0) & \
        ((e[:, 2] - e[:, 0]) * (nxt[:, 2] - nxt[:, 0]) + (e[:, 3] - e[:, 1]) * (nxt[:, 3] - nxt[:, 1]) < 0)
    if back.any():
        return True
    west, east = np.minimum(e[:, 0], e[:, 2]), np.maximum(e[:, 0], e[:, 2])
    order = np.argsort(west, kind="stable")
    west, east, e = west[order], east[order], e[order]
    at, step = np.arange(n), 0
    while len(at):
        step += 1
        at = at[at + step < n]
        at = at[west[at + step] <= east[at]]
        apart = np.abs(order[at] - order[at + step])
        some = at[(apart > 1) & (apart < n - 1)]
        if len(some) and _meet(e[some], e[some + step]).any():
            return True
    return False


def ring_verdicts(rings: DataFrame, col: str = "ring") -> DataFrame:
    """``rings`` with ``usable`` (G10) and ``crossing``: whether the ring crosses, touches or retraces
    itself (false for rings that are not usable, null vertices and antimeridian included as they are).

    Nested removal (D6) takes a crossing ring by the even-odd rule: what its border goes round an odd
    number of times is inside, so both wings of a bow-tie are, whatever their signed areas add up to."""
    def judge(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for b in batches:
            out = []
            for usable, ring in zip(b.column("usable").to_pylist(), b.column(col)):
                if not usable:
                    out.append(False)
                    continue
                points = ring.values
                lat, lon = (points.field(c).to_numpy(zero_copy_only=False) for c in ("lat", "lon"))
                if len(lon) and np.abs(np.diff(np.append(lon, lon[0]))).max() > 180:
                    lat, lon = unrolled(lat, lon)
                out.append(crosses_itself(lon, lat))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.bool_())], [*b.schema.names, "crossing"])

    judged = rings.withColumn("usable", ring_is_usable(col))
    from pyspark.sql import types as T
    return judged.mapInArrow(judge, T.StructType([*judged.schema.fields, T.StructField("crossing", T.BooleanType())]))


def boundary_outline(rings: DataFrame) -> DataFrame:
    """C11: (lat_a, lon_a, lat_b, lon_b) of the outline of ``rings`` (ring), each edge once, with the rings'
    inside on its left: the edges less those held in opposite directions, which lie within the region.

    Rings are turned by their signed area; of a crossing ring no side is known, it keeps its direction. Edges
    cancel where they are equal; a region of overlapping rings is tested by ``remove_nested`` instead."""
    ring = F.when(ring_area2("ring") < 0, F.reverse("ring")).otherwise(F.col("ring"))
    e = F.col("e")
    a, b = e["a"], e["b"]
    ahead = F.struct(a["lat"], a["lon"]) < F.struct(b["lat"], b["lon"])
    ends = rings.select(F.explode(edge_pairs(ring)).alias("e")).filter(a != b).select(
        F.when(ahead, a).otherwise(b).alias("low"), F.when(ahead, b).otherwise(a).alias("high"),
        F.when(ahead, 1).otherwise(-1).alias("way"))
    net = ends.groupBy("low", "high").agg(F.min("way").alias("way"), F.max("way").alias("other")).filter(F.col("way") == F.col("other"))
    start = F.when(F.col("way") > 0, F.col("low")).otherwise(F.col("high"))
    end = F.when(F.col("way") > 0, F.col("high")).otherwise(F.col("low"))
    return net.select(start["lat"].alias("lat_a"), start["lon"].alias("lon_a"), end["lat"].alias("lat_b"), end["lon"].alias("lon_b"))


def _turn(y: Column, x: Column) -> Column:
    """The angle of a direction in (0, 2 pi]."""
    t = F.atan2(y, x)
    return F.when(t <= 0, t + TURN).otherwise(t)


def arc(y: Column, x: Column, edges: Column) -> Column:
    """What a ring (``edges``, those near its point) takes around the point (y, x) on its border:
    whether the sector counter-clockwise of east is inside, and the angles of its edges there."""
    def on(e):
        ay, ax, by, bx = e["a"]["lat"], e["a"]["lon"], e["b"]["lat"], e["b"]["lon"]
        cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        return ((cross == 0) & (x >= F.least(ax, bx)) & (x <= F.greatest(ax, bx))
                & (y >= F.least(ay, by)) & (y <= F.greatest(ay, by)))

    def right(e):
        ay, ax, by, bx = e["a"]["lat"], e["a"]["lon"], e["b"]["lat"], e["b"]["lon"]
        return ((ay > y) != (by > y)) & (x < ax + (y - ay) * (bx - ax) / (by - ay)) & ~on(e)

    def ways(e):
        ends = F.filter(F.array(e["a"], e["b"]), lambda p: (p["lat"] != y) | (p["lon"] != x))
        return F.transform(ends, lambda p: _turn(p["lat"] - y, p["lon"] - x))

    angles = F.flatten(F.transform(F.filter(edges, on), ways))
    return F.struct((F.size(F.filter(edges, right)) % 2 == 1).alias("odd"), angles.alias("angles"))


def covers_circle(arcs: Column) -> Column:
    """Whether the rings' sectors leave no direction free."""
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(TURN)), F.flatten(F.transform(arcs, lambda r: r["angles"])))))
    sectors = F.transform(F.sequence(F.lit(0), F.size(cuts) - 2),
                          lambda i: F.struct(F.get(cuts, i).alias("a"), F.get(cuts, i + 1).alias("b")))
    wide = F.filter(sectors, lambda s: s["b"] - s["a"] > SLIVER)

    def inside(r, middle):
        return r["odd"] != (F.size(F.filter(r["angles"], lambda t: t < middle)) % 2 == 1)

    covered = F.forall(wide, lambda s: F.exists(arcs, lambda r: inside(r, (s["a"] + s["b"]) / 2)))
    return F.when(F.size(arcs) > 0, covered).otherwise(F.lit(False))
