"""Arrow-batched evaluation of the candidate arrays (engine="arrow").

After the (broadcast) hash join, each town row carries the metro array of its
cell. Spark evaluates higher-order functions element by element without code
generation, which costs microseconds per (town, metro) pair. This path hands the
joined rows to ``mapInArrow``: per record batch the metro lists are flattened to
numpy columns, every pair's distance and force is computed in one vectorised
pass, and the winner (or the sorted candidate list) per town is assembled back as
Arrow arrays. Town columns pass through untouched (zero copy); nothing is
shuffled. The formulas follow the Column versions operation for operation.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from townpull.schema import EARTH_RADIUS_KM, FORCE_K, MERCATOR_RADIUS_M

CAND_FIELDS = [pa.field("metro_id", pa.int32()), pa.field("metro_name", pa.string()),
               pa.field("force", pa.float64()), pa.field("distance", pa.float64())]
CAND_STRUCT = pa.struct(CAND_FIELDS)


def _pair_distance(metric: str, tlat, tlon, tcos, ty, mlat, mlon, my):
    if metric == "haversine":
        dphi = np.radians(mlat - tlat)
        dlam = np.radians(mlon - tlon)
        a = np.sin(dphi / 2) ** 2 + tcos * np.cos(np.radians(mlat)) * np.sin(dlam / 2) ** 2
        return EARTH_RADIUS_KM * (2.0 * np.arctan2(np.sqrt(a), np.sqrt(1.0 - a)))
    r = MERCATOR_RADIUS_M
    dx = r * (np.radians(tlon) - np.radians(mlon))
    dy = r * (ty - my)
    return np.sqrt(dx * dx + dy * dy) * tcos / 1000.0


def _col(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


MAX_PAIRS_PER_SLICE = 1_000_000


def _slices(batch: pa.RecordBatch, weights: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices of ``batch`` whose summed ``weights`` stay under ``limit``
    (a single heavier row forms its own slice), bounding the numpy temporaries."""
    n = batch.num_rows
    if n == 0 or weights.sum() <= limit:
        yield batch
        return
    cum = np.cumsum(weights)
    start = 0
    while start < n:
        base = cum[start - 1] if start else 0
        end = int(np.searchsorted(cum, base + limit, side="right"))
        end = max(end, start + 1)
        yield batch.slice(start, end - start)
        start = end


def _list_lengths(arr) -> np.ndarray:
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    return pc.fill_null(pc.list_value_length(arr), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def evaluate_batches(metric: str, mode: str, out_col: str, drop: list[str]):
    """Build the ``mapInArrow`` function: joined rows (with ``_metros``) -> rows with
    ``out_col`` (``best`` struct or ``candidates`` list), helper columns dropped."""
    limit = MAX_PAIRS_PER_SLICE  # read on the driver, shipped with the closure

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths_all = _list_lengths(whole.column(whole.schema.get_field_index("_metros")))
            for batch in _slices(whole, lengths_all, limit):
                yield _evaluate(batch, metric, mode, out_col, drop)

    return fn


def _evaluate(batch: pa.RecordBatch, metric: str, mode: str, out_col: str, drop: list[str]) -> pa.RecordBatch:
    n = batch.num_rows
    metros = batch.column(batch.schema.get_field_index("_metros"))
    if isinstance(metros, pa.ChunkedArray):
        metros = metros.combine_chunks()
    filled = metros.fill_null(pa.scalar([], metros.type)) if metros.null_count else metros
    lengths = pc.list_value_length(filled).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = filled.flatten()
    owner = np.repeat(np.arange(n), lengths)
    if len(flat):
        tlat, tlon, tcos = _col(batch, "_tlat")[owner], _col(batch, "_tlon")[owner], _col(batch, "_tcos")[owner]
        ty = _col(batch, "_ty")[owner] if metric == "mercator_cos" else None
        mlat = flat.field("lat").to_numpy(zero_copy_only=False)
        mlon = flat.field("lon").to_numpy(zero_copy_only=False)
        my = flat.field("y").to_numpy(zero_copy_only=False) if metric == "mercator_cos" else None
        rad = flat.field("radius").to_numpy(zero_copy_only=False)
        with np.errstate(invalid="ignore"):
            dist = _pair_distance(metric, tlat, tlon, tcos, ty, mlat, mlon, my)
            keep = dist < rad
        idx = np.nonzero(keep)[0]
    else:
        idx = np.zeros(0, dtype=np.int64)
        dist = rad = np.zeros(0)
    mid = flat.field("metro_id").to_numpy(zero_copy_only=False)[idx] if len(flat) else np.zeros(0, np.int32)
    d = dist[idx]
    force = np.exp(-FORCE_K * d / rad[idx])
    own = owner[idx]
    # order: town, force desc, distance asc, metro id asc
    order = np.lexsort((mid, d, -force, own))
    idx, own, mid, d, force = idx[order], own[order], mid[order], d[order], force[order]
    has_names = flat.type.get_field_index("metro_name") >= 0
    if len(flat) and has_names:
        names = flat.field("metro_name").take(pa.array(idx, pa.int64()))
    else:
        names = pa.nulls(len(idx), pa.string())
    cands = pa.StructArray.from_arrays(
        [pa.array(mid, pa.int32()), names, pa.array(force, pa.float64()), pa.array(d, pa.float64())],
        fields=CAND_FIELDS)
    counts = np.bincount(own, minlength=n) if len(own) else np.zeros(n, dtype=np.int64)
    if mode == "list":
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        result = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), cands)
    else:
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]]) if n else np.zeros(0, np.int64)
        has = counts > 0
        pick = np.where(has, starts, 0).astype(np.int64)
        taken = cands.take(pa.array(pick, pa.int64())) if len(cands) else pa.nulls(n, CAND_STRUCT)
        mask = pa.array(~has)
        result = pa.StructArray.from_arrays([taken.field(i) for i in range(4)], fields=CAND_FIELDS,
                                            mask=mask) if len(cands) else pa.nulls(n, CAND_STRUCT)
    keep_cols = [i for i, f in enumerate(batch.schema) if f.name not in drop]
    arrays = [batch.column(i) for i in keep_cols] + [result]
    names_out = [batch.schema.field(i).name for i in keep_cols] + [out_col]
    return pa.RecordBatch.from_arrays(arrays, names=names_out)


def _flat_list(arr: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Flatten a list array (nulls as empty lists); return values and per-row lengths."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null(pa.scalar([], arr.type))
    return arr.flatten(), pc.list_value_length(arr).to_numpy(zero_copy_only=False).astype(np.int64)


def point_in_rings_batches(out_col: str, arcs_col: str, drop: list[str]):
    """Build the ``mapInArrow`` function for nested removal: joined rows (point
    ``latitude``/``longitude`` + ``_rings`` of its cell) -> rows + ``out_col`` = strictly
    inside any ring (even-odd crossings; on an edge or vertex counts as outside) + ``arcs_col`` = for
    other points, what each ring on whose border they lie takes around them (``regions.arc``). The
    arithmetic is the Column version's, edge for edge."""
    limit = MAX_PAIRS_PER_SLICE

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            rings_all = whole.column(whole.schema.get_field_index("_rings"))
            if isinstance(rings_all, pa.ChunkedArray):
                rings_all = rings_all.combine_chunks()
            # edges per point = vertices of all rings of its cell
            flat_r, per_pt = _flat_list(rings_all)
            v_per_ring = _list_lengths(flat_r.field("edges")) if len(flat_r) else np.zeros(0, np.int64)
            owner = np.repeat(np.arange(whole.num_rows), per_pt)
            edges = np.bincount(owner, weights=v_per_ring, minlength=whole.num_rows).astype(np.int64) \
                if len(flat_r) else np.zeros(whole.num_rows, np.int64)
            for batch in _slices(whole, edges, limit):
                yield _inside(batch, out_col, arcs_col, drop)

    return fn


ARC = pa.list_(pa.struct([("odd", pa.bool_()), ("angles", pa.list_(pa.float64()))]))


def _inside(batch: pa.RecordBatch, out_col: str, arcs_col: str, drop: list[str]) -> pa.RecordBatch:
    n = batch.num_rows
    arcs: dict[int, list] = {}
    rings, per_point = _flat_list(batch.column(batch.schema.get_field_index("_rings")))
    inside_pt = np.zeros(n, dtype=bool)
    if len(rings):
        segments, per_ring = _flat_list(rings.field("edges"))
        full = rings.field("full").to_numpy(zero_copy_only=False).astype(bool)
        ring_owner = np.repeat(np.arange(n), per_point)
        inside_pt = np.bincount(ring_owner, weights=full, minlength=n) > 0
        if len(segments):
            edge_ring = np.repeat(np.arange(len(per_ring)), per_ring)
            p = ring_owner[edge_ring]
            y = _col(batch, "latitude").astype(np.float64)[p]
            lon = _col(batch, "longitude").astype(np.float64)
            x = np.where(lon >= 180.0, lon - 360.0, lon)[p]
            ay, ax, by, bx = (segments.field(end).field(c).to_numpy(zero_copy_only=False)
                              for end in ("a", "b") for c in ("lat", "lon"))
            with np.errstate(invalid="ignore", divide="ignore"):
                cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
                on_edge = ((cross == 0) & (x >= np.minimum(ax, bx)) & (x <= np.maximum(ax, bx))
                           & (y >= np.minimum(ay, by)) & (y <= np.maximum(ay, by)))
                straddles = (ay > y) != (by > y)
                x_at = ax + (y - ay) * (bx - ax) / (by - ay)
                crosses = straddles & (x < x_at)
            n_ring = len(per_ring)
            n_cross = np.bincount(edge_ring, weights=crosses, minlength=n_ring)
            touching = np.bincount(edge_ring, weights=on_edge, minlength=n_ring) > 0
            inside_ring = (~touching) & (n_cross % 2 == 1)
            inside_pt |= np.bincount(ring_owner, weights=inside_ring, minlength=n) > 0
            near = np.nonzero(on_edge & ~inside_pt[p])[0]   # few: places on a border
            if len(near):
                odd = np.bincount(edge_ring, weights=crosses & ~on_edge, minlength=n_ring) % 2 == 1
                ways: dict[int, list[float]] = {}
                for i in near.tolist():
                    for end_y, end_x in ((ay[i], ax[i]), (by[i], bx[i])):
                        if end_y != y[i] or end_x != x[i]:
                            t = math.atan2(end_y - y[i], end_x - x[i])
                            ways.setdefault(int(edge_ring[i]), []).append(t + 2 * math.pi if t <= 0 else t)
                for ring, angles in ways.items():
                    arcs.setdefault(int(ring_owner[ring]), []).append({"odd": bool(odd[ring]), "angles": angles})
    keep_cols = [i for i, f in enumerate(batch.schema) if f.name not in drop]
    around = pa.array([arcs.get(i) for i in range(n)], ARC) if arcs else pa.nulls(n, ARC)
    arrays = [batch.column(i) for i in keep_cols] + [pa.array(inside_pt, pa.bool_()), around]
    names_out = [batch.schema.field(i).name for i in keep_cols] + [out_col, arcs_col]
    return pa.RecordBatch.from_arrays(arrays, names=names_out)


def _take_structs(arr: pa.Array, at: np.ndarray) -> pa.Array:
    return arr.take(pa.array(at, pa.int64()))


def quotient_batches(metric: str, cell_deg: float, n_lat: int, n_lon: int, most: float, steps: int, cols: list[str]):
    """Build the ``mapInArrow`` function of a strongest-only index: entries (``base``, ``parts``, ``si``, ``sj``, ``m``), each
    for ``steps`` x ``steps`` parts of its part, with bounds ``low`` and ``high`` of distance / radius over all points
    of the part (see ``radius_join._quotients``); without those whose ``low`` is above ``most``."""
    limit = MAX_PAIRS_PER_SLICE

    def bounds(base, parts, si, sj, mlat, mlon, r, my):
        side = cell_deg / parts
        lat = np.floor_divide(base, n_lon) * cell_deg - 90.0 + (si + 0.5) * side
        lon = np.mod(base, n_lon) * cell_deg - 180.0 + (sj + 0.5) * side
        half = side * (0.5 + 1e-6) + 1e-9
        widest = np.cos(np.radians(np.maximum(np.abs(lat) - half, 0.0)))
        if metric == "haversine":
            middle = _pair_distance(metric, lat, lon, np.cos(np.radians(lat)), None, mlat, mlon, None)
            corner = np.radians(half) * np.sqrt(1.0 + widest * widest) * (EARTH_RADIUS_KM * 1.0001)
            low, high = np.maximum(middle - corner, 0.0) / r, (middle + corner) / r
        else:
            def ordinate(a):
                return np.log(np.tan(math.pi / 4 + np.radians(a) / 2))
            y = ordinate(lat)
            tall = np.maximum(ordinate(lat + half) - y, y - ordinate(lat - half))
            dx, dy = np.radians(lon) - np.radians(mlon), y - my
            km = MERCATOR_RADIUS_M / 1000.0
            middle, corner = np.sqrt(dx * dx + dy * dy) * km, np.sqrt(np.radians(half) ** 2 + tall * tall) * (km * 1.0001)
            narrowest = np.cos(np.radians(np.abs(lat) + half))
            low, high = np.maximum(middle - corner, 0.0) * narrowest / r, (middle + corner) * widest / r
        sure = (base >= n_lon) & (base < (n_lat - 1) * n_lon)
        return np.where(sure, low, 0.0), np.where(sure, high, np.inf)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _slices(whole, np.full(whole.num_rows, steps * steps, np.int64), limit):
                n = b.num_rows
                own = np.repeat(np.arange(n), steps * steps)
                base, parts, si, sj = (_col(b, c)[own] for c in ("base", "parts", "si", "sj"))
                if steps > 1:
                    nth = np.tile(np.arange(steps * steps), n)
                    parts, si, sj = parts * steps, si * steps + nth // steps, sj * steps + nth % steps
                m = b.column(b.schema.get_field_index("m"))
                metro = [m.field(c).to_numpy(zero_copy_only=False)[own] for c in ("lat", "lon", "radius")]
                metro.append(m.field("y").to_numpy(zero_copy_only=False)[own] if metric == "mercator_cos" else None)
                with np.errstate(all="ignore"):
                    low, high = bounds(base, parts, si, sj, *metro)
                    at = np.nonzero(low <= most)[0]
                got = {"base": base, "parts": parts, "si": si, "sj": sj, "low": low, "high": high}
                yield pa.RecordBatch.from_arrays(
                    [_take_structs(m, own[at]) if c == "m" else pa.array(got[c][at]) for c in cols], names=cols)

    return fn


def ring_part_batches(cell_deg: float, n_lon: int, steps: int, cols: list[str]):
    """Build the ``mapInArrow`` function that splits entries (``base``, ``parts``, ``si``, ``sj``, ``r``) of rings: for each of
    ``steps`` x ``steps`` parts of their part an entry with the edges of the part's latitudes where one comes near
    it, a mark where it lies wholly inside, none where outside."""
    limit = MAX_PAIRS_PER_SLICE
    margin = cell_deg * 1e-6

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths = _list_lengths(whole.column(whole.schema.get_field_index("r")).field("edges"))
            for b in _slices(whole, (lengths + 1) * steps, limit):
                yield from split(b)

    def split(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = b.num_rows
        base, parts, si, sj = (_col(b, c) for c in ("base", "parts", "si", "sj"))
        parts = parts * steps
        side = cell_deg / parts
        r = b.column(b.schema.get_field_index("r"))
        r_type = b.schema.field("r").type
        ids, ring_nos, marked = (r.field(c) for c in ("id", "ring_no", "full"))
        marked = marked.to_numpy(zero_copy_only=False).astype(bool)
        edges, per = _flat_list(r.field("edges"))
        owner = np.repeat(np.arange(n), per)
        if len(edges):
            ay, ax, by, bx = (edges.field(end).field(c).to_numpy(zero_copy_only=False) for end in ("a", "b") for c in ("lat", "lon"))
        else:
            ay = ax = by = bx = np.zeros(0)
        south0 = np.floor_divide(base, n_lon) * cell_deg - 90.0
        west0 = np.mod(base, n_lon) * cell_deg - 180.0
        for a in range(steps):
            ti = si * steps + a
            south = south0 + ti * side
            s, d = south[owner], side[owner]
            # of a mark (no edges) every part is a mark; else a part has the edges of its own latitudes
            row = np.nonzero(~(np.maximum(ay, by) < s - margin) & (np.fmin(ay, by) <= s + d + margin))[0]
            o, s, d = owner[row], s[row], d[row]
            y0, x0, y1, x1 = ay[row], ax[row], by[row], bx[row]
            # an edge counts where it runs within the part's latitudes; one along them, with its whole length
            flat = np.abs(y1 - y0) < 1e-4
            with np.errstate(all="ignore"):
                slope = (x1 - x0) / np.where(flat, 1.0, y1 - y0)
                p = np.where(flat, x0, x0 + (np.maximum(np.fmin(y0, y1), s - margin) - y0) * slope)
                q = np.where(flat, x1, x0 + (np.fmin(np.maximum(y0, y1), s + d + margin) - y0) * slope)
            lo, hi = np.fmin(p, q), np.maximum(p, q)   # a NaN counts as largest, as in Spark
            held = np.bincount(o, minlength=n)
            y = (south + 0.5 * side)[o]
            straddles = (y0 <= y) != (y1 <= y)
            with np.errstate(all="ignore"):
                x_at = x0 + (y - y0) * (x1 - x0) / (y1 - y0)
            for c in range(steps):
                tj = sj * steps + c
                west = west0 + tj * side
                near = np.bincount(o, weights=~(hi < west[o] - margin) & (lo <= west[o] + d + margin), minlength=n) > 0
                x = (west + 0.5 * side)[o]
                inside = np.bincount(o, weights=straddles & ~(x >= x_at), minlength=n) % 2 == 1   # no edge runs through the middle where none is near
                full = marked | (~near & inside)
                at = np.nonzero(near | full)[0]
                kept = np.where(near, held, 0)[at]
                edge_at = row[near[o]]
                offsets = np.concatenate([[0], np.cumsum(kept)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), _take_structs(edges, edge_at)).cast(r_type.field("edges").type)
                got = {"base": pa.array(base[at]), "parts": pa.array(parts[at]), "si": pa.array(ti[at]), "sj": pa.array(tj[at]),
                       "nv": pa.array(np.maximum(kept, 1).astype(np.int32)),
                       "r": pa.StructArray.from_arrays([_take_structs(ids, at), _take_structs(ring_nos, at), pa.array(full[at]), lists], fields=list(r_type))}
                yield pa.RecordBatch.from_arrays([got[k] for k in cols], names=cols)

    return fn
