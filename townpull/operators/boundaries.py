"""Boundary enrichment and nested-place removal.

Nested removal keeps every row that has polygons and drops a polygon-less row when
it lies inside the union of all usable rings (even-odd rule for each; holes are not
kept): strictly inside a ring, or on borders of rings that together leave no direction
around it free, as on a border that two districts share (``regions.covers_circle``). On
the union's own border a place stays. Rings over the antimeridian are split there first.

Plan of D6: a ring's edges are grouped by rows of grid cells; a cell near an edge gets
the edges of its row, a cell inside gets a mark (``_ring_cells``). These entries are
grouped into a cell index (cell -> array of at most ``chunk_size`` entries), which is
written to the checkpoint folder, measured, and broadcast when its edge count is
bounded. Each candidate point joins the index on its own cell and tests only that
cell's entries, so no (point, ring) pairs are formed and the point rows are not
shuffled in the broadcast case. Cells that many rings meet are split into parts, and of
a part that lies wholly inside some ring only that mark is kept (``_refine_rings``), so
that a point meets few entries however densely the rings lie. Cells covered by more than ``chunk_size`` rings are
numbered into chunks; only points of such cells take a second path that combines
per-chunk results with one aggregation per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townpull.functions.geo import edge_pairs, inside_edges, ring_is_usable
from townpull.operators.filters import has_polygons, split_boundaries
from townpull.operators.metro_rules import flag_metros
from townpull.operators.radius_join import MAX_PARTS, SPLIT_STEP, _divisible, _grid, _lat_idx, _part_key, part_of_cell
from townpull.operators.regions import ARCS, arc, covers_circle, split_antimeridian
from townpull.operators.setops import recombine
from townpull.operators.sizing import DEFAULT_BROADCAST_ROWS, join_small, materialize, row_hash

DEFAULT_RING_CHUNK = 1_000
DEFAULT_VERTEX_CHUNK = 20_000
DEFAULT_BROADCAST_VERTICES = 5_000_000
SPLIT_RINGS = 16    # rings an entry shares its cell with, on average, before cells are split


def attach_boundaries(df: DataFrame, boundaries: DataFrame, fanout: bool = False,
                      keys: tuple[str, ...] = ("country_code", "name")) -> DataFrame:
    """Left join boundary polygons onto rows.

    Default: boundaries are first reduced to one per (country_code, name) (the one
    with the most rings, then the shortest and then smallest text form) so a repeated name cannot
    multiply rows. ``fanout=True`` joins on ``name`` alone without reduction, as the
    source does: n x m rows for a name that n places and m boundaries have, which grows with the
    square of a hot name; it is there for parity, at scale use the default.
    """
    if fanout:
        return df.join(boundaries.select("name", "polygons"), "name", "left")
    k = list(keys)
    one = (boundaries.filter(F.col("polygons").isNotNull())
           .withColumn("_text", F.to_json("polygons"))
           .groupBy(*k).agg(F.min_by("polygons", F.struct(-F.size("polygons"), F.length("_text"), F.col("_text")))
                            .alias("polygons")))
    return join_small(df, one, k, "left", null_spread=True)


def boundary_rings(df: DataFrame, id_col: str = "geonameid") -> DataFrame:
    """C11: every usable ring of the boundary rows, one row each:
    (id, ring_no, ring, lat_min, lat_max, lon_min, lon_max)."""
    rings = df.filter(has_polygons()).select(F.col(id_col).alias("id"),
                                             F.posexplode("polygons").alias("ring_no", "ring"))
    rings = rings.filter(ring_is_usable("ring"))
    lats, lons = F.transform("ring", lambda p: p["lat"]), F.transform("ring", lambda p: p["lon"])
    return rings.select("id", "ring_no", "ring", F.array_min(lats).alias("lat_min"), F.array_max(lats).alias("lat_max"),
                        F.array_min(lons).alias("lon_min"), F.array_max(lons).alias("lon_max"))


def _ring_cells(rings: DataFrame, cell_deg: float) -> DataFrame:
    """(cell, r, nv): what each cell needs to know of each ring whose box touches it.

    A point's test only meets edges whose latitudes span it, so a ring's edges are grouped by
    rows of cells first. A cell that no edge comes near is wholly inside or outside: it is
    marked ``full`` or left out. Only the other cells hold the edges of their row, so a ring
    costs its border, not its vertices times its cells.
    """
    n_lat, n_lon = _grid(cell_deg)
    c = cell_deg
    lo = F.greatest(F.floor((F.col("lon_min") + 180.0) / c), F.lit(0))
    hi = F.least(F.floor((F.col("lon_max") + 180.0) / c), F.lit(n_lon - 1))
    e = F.col("e")
    edges = rings.select("id", "ring_no", lo.alias("lo"), hi.alias("hi"), F.explode(edge_pairs("ring")).alias("e"))
    low, high = F.least(e["a"]["lat"], e["b"]["lat"]), F.greatest(e["a"]["lat"], e["b"]["lat"])
    rows = edges.select("id", "ring_no", "lo", "hi", "e",
                        F.explode(F.sequence(_lat_idx(low, c, n_lat), _lat_idx(high, c, n_lat))).alias("i"))
    rows = rows.groupBy("id", "ring_no", "lo", "hi", "i").agg(F.collect_list("e").alias("edges"))   # one ring's edges there
    cells = rows.select("id", "ring_no", "i", "edges", F.explode(F.sequence("lo", "hi")).alias("j"))
    west = F.col("j") * c - 180.0
    margin = c * 1e-6
    near = F.exists("edges", lambda e: (F.greatest(e["a"]["lon"], e["b"]["lon"]) >= west - margin)
                    & (F.least(e["a"]["lon"], e["b"]["lon"]) <= west + c + margin))
    middle = inside_edges((F.col("i") + 0.5) * c - 90.0, west + 0.5 * c, "edges")
    cells = cells.withColumn("near", near).withColumn("full", F.when(F.col("near"), F.lit(False)).otherwise(middle)) \
        .filter(F.col("near") | F.col("full"))
    kept = F.when(F.col("near"), F.col("edges")).otherwise(F.slice("edges", 1, 0))
    return cells.select((F.col("i") * n_lon + F.col("j")).cast("long").alias("cell"),
                        F.struct("id", "ring_no", "full", kept.alias("edges")).alias("r"),
                        F.greatest(F.size(kept), F.lit(1)).alias("nv"))


def _marked(entries: DataFrame) -> DataFrame:
    """``entries`` (base, parts, si, sj, r, nv), less those of parts that lie wholly inside a ring: these keep one mark."""
    part = ["base", "parts", "si", "sj"]
    full = entries.filter("r.full").groupBy(*part).agg(F.min_by("r", F.struct("r.id", "r.ring_no")).alias("r"), F.min("nv").alias("nv"))
    return entries.join(full.select(*part), part, "left_anti").unionByName(full)


def _split_entries(entries: DataFrame, cell_deg: float) -> DataFrame:
    """``entries`` (base, parts, si, sj, r) for ``SPLIT_STEP`` x ``SPLIT_STEP`` parts of their part, with ``nv``. Worked out
    Arrow-batched: higher-order functions take tens of microseconds an entry."""
    from townpull.operators.arrow_eval import ring_part_batches
    _, n_lon = _grid(cell_deg)
    rows = entries.select("base", "parts", "si", "sj", "r")
    schema = T.StructType([*rows.schema.fields, T.StructField("nv", T.IntegerType())])
    return rows.mapInArrow(ring_part_batches(cell_deg, n_lon, SPLIT_STEP, schema.fieldNames()), schema)


def _refine_rings(rc: DataFrame, cell_deg: float) -> tuple[DataFrame, DataFrame | None]:
    """Entries (cell, r, nv), and how many parts a side cells are split into (base, parts) where some are: cells
    that many rings meet are split until few do, or until a split does not thin them out."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    left = rc.select(F.col("cell").alias("base"), one.alias("parts"), none.alias("si"), none.alias("sj"), "r", "nv")
    settled, split, parts, before = [], [], 1, None
    while True:
        left = materialize(_marked(left))
        n = left.groupBy("base", "si", "sj").agg(F.count(F.lit(1)).cast("double").alias("n")).groupBy("base").agg(
            (F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("shared"))
        n = n.filter((F.col("shared") > SPLIT_RINGS) & _divisible(F.col("base"), cell_deg))
        if before is not None:
            n = n.join(before, "base", "inner").filter(F.col("shared") < 0.9 * F.col("shared_before")).drop("shared_before")
        if parts < MAX_PARTS:
            n = materialize(n)
        if parts >= MAX_PARTS or n.isEmpty():
            settled.append(left)
            break
        dense, before = n.select("base"), n.withColumnRenamed("shared", "shared_before")
        settled.append(left.join(dense, "base", "left_anti"))
        parts *= SPLIT_STEP
        split.append(dense.withColumn("parts", F.lit(parts).cast("long")))
        left = materialize(_split_entries(left.join(dense, "base", "left_semi"), cell_deg))
    out = settled[0]
    for x in settled[1:]:
        out = out.unionByName(x)
    sides = None
    if split:
        sides = split[0]
        for x in split[1:]:
            sides = sides.unionByName(x)
        sides = materialize(sides.groupBy("base").agg(F.max("parts").alias("parts")))
    return out.select(_part_key(F.col("base"), F.col("parts"), F.col("si"), F.col("sj")).alias("cell"), "r", "nv"), sides


def _region_flags(df: DataFrame, keep: list[str], engine: str) -> DataFrame:
    """``keep`` columns + ``_in`` (point strictly inside any ring of ``_rings``) + ``_arcs`` (for other
    points, what each ring on whose border it lies takes around it)."""
    if engine == "arrow":
        from townpull.operators.arrow_eval import point_in_rings_batches
        arcs = T.DataType.fromDDL(ARCS)
        schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("_in", T.BooleanType()), T.StructField("_arcs", arcs)])
        staged = df.select(*keep, *[c for c in ("latitude", "longitude", "_rings") if c not in keep])
        drop = [c for c in staged.columns if c not in keep]
        return staged.mapInArrow(point_in_rings_batches("_in", "_arcs", drop), schema)
    lat, lon = F.col("latitude").cast("double"), _turned(F.col("longitude"))
    rings = F.coalesce(F.col("_rings"), F.array())
    inside = F.coalesce(F.exists(rings, lambda r: r["full"] | inside_edges(lat, lon, r["edges"])), F.lit(False))
    around = F.filter(F.transform(rings, lambda r: arc(lat, lon, r["edges"])), lambda a: F.size(a["angles"]) > 0)
    return df.select(*keep, inside.alias("_in"), F.when(~inside & lat.isNotNull() & lon.isNotNull(), around).alias("_arcs"))


def _turned(lon: Column) -> Column:
    """Longitudes from 180 on are those of the other side of the antimeridian."""
    lon = lon.cast("double")
    return F.when(lon >= 180.0, lon - 360.0).otherwise(lon)


def _outside() -> Column:
    return ~(F.col("_in") | F.coalesce(covers_circle(F.col("_arcs")), F.lit(False)))


def remove_nested(df: DataFrame, cell_deg: float = 0.25, chunk_size: int = DEFAULT_RING_CHUNK,
                  max_broadcast_vertices: int = DEFAULT_BROADCAST_VERTICES, engine: str = "arrow",
                  vertex_chunk: int = DEFAULT_VERTEX_CHUNK) -> DataFrame:
    """Keep rows with polygons; drop polygon-less rows inside the union of all
    usable rings of all boundary rows. A ring that crosses itself counts by the even-odd
    rule. ``engine="arrow"`` runs the crossing test
    Arrow-batched with numpy (same arithmetic), ``"jvm"`` with higher-order functions.
    A cell's ring list is split into chunks of at most ``chunk_size`` rings and about
    ``vertex_chunk`` edges; of a ring a cell holds the edges of its row of cells only."""
    if engine not in ("arrow", "jvm"):
        raise ValueError("engine must be 'arrow' or 'jvm'")
    if chunk_size < 1:
        raise ValueError("chunk_size must be >= 1")
    n_lat, n_lon = _grid(cell_deg)
    holders, rest = split_boundaries(df)
    cols = df.columns
    rc = materialize(_ring_cells(split_antimeridian(materialize(boundary_rings(holders))), cell_deg))

    def count(rc: DataFrame):
        counts = rc.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum("nv").alias("v"))
        counts = counts.withColumn("n_chunks", F.least(F.col("n"), F.greatest(
            F.ceil(F.col("n") / F.lit(chunk_size)), F.ceil(F.col("v") / F.lit(vertex_chunk)))).cast("int"))
        return counts, counts.agg(F.coalesce(F.max("n_chunks"), F.lit(1)).alias("mx"), F.coalesce(F.sum("v"), F.lit(0)).alias("v"),
                                  F.coalesce(F.sum("n_chunks"), F.lit(0)).alias("chunks"), F.coalesce(F.max("n"), F.lit(0)).alias("rings")).first()

    counts, st = count(rc)
    parts = None
    if st["rings"] > SPLIT_RINGS and n_lat * n_lon < 1 << 32:
        rc, parts = _refine_rings(rc, cell_deg)
        counts, st = count(rc)
    mx = int(st["mx"])
    n_rows = int(st["chunks"])
    if mx <= 1:
        table = rc.groupBy("cell").agg(F.collect_list("r").alias("_rings")).withColumn("n_chunks", F.lit(1))
        hot = None
    else:
        per_cell = counts.select("cell", "n_chunks")
        keyed = join_small(rc, per_cell, "cell", "inner")
        place = Window.partitionBy("cell").orderBy("r.id", "r.ring_no")
        table = (keyed.withColumn("chunk", F.pmod(F.row_number().over(place), F.col("n_chunks")))
                 .groupBy("cell", "chunk", "n_chunks").agg(F.collect_list("r").alias("_rings")))
        hot = materialize(per_cell.filter(F.col("n_chunks") > 1).select(F.col("cell").alias("_cell")))
    table = materialize(table.withColumnRenamed("cell", "_cell"))
    bc = st["v"] <= max_broadcast_vertices and n_rows <= DEFAULT_BROADCAST_ROWS

    def side(t: DataFrame) -> DataFrame:
        return F.broadcast(t) if bc else t

    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    cell = (_lat_idx(lat, cell_deg, n_lat) * n_lon + F.pmod(F.floor((lon + 180.0) / cell_deg), F.lit(n_lon)))
    cell = cell.cast("long")
    places = rest
    if parts is not None:
        places = join_small(rest.withColumn("_base", cell), parts.select(F.col("base").alias("_base"), F.col("parts").alias("_parts")),
                            "_base", "left", null_spread=True)
        cell = part_of_cell(lat, lon, F.col("_base"), F.coalesce("_parts", F.lit(1).cast("long")), cell_deg)
    if not bc:  # shuffle join: no coordinates -> a key from the row that matches no cell, spread over partitions
        cell = F.coalesce(cell, F.lit(-1).cast("long") - F.shiftrightunsigned(row_hash(rest), 2))
    pts = places.withColumn("_cell", cell)
    if hot is None:
        joined = pts.join(side(table.select("_cell", "_rings")), "_cell", "left")
        kept = _region_flags(joined, cols, engine).filter(_outside()).select(*cols)
        return recombine(holders, kept)
    pts = join_small(pts, hot.withColumn("_hot", F.lit(True)), "_cell", "left")
    cool = pts.filter(F.col("_hot").isNull()).join(
        side(table.filter(F.col("n_chunks") == 1).select("_cell", "_rings")), "_cell", "left")
    cool = _region_flags(cool, cols, engine).filter(_outside()).select(*cols)
    # row numbers are given to a stored copy, so that a task that runs again gives the same
    warm = materialize(pts.filter(F.col("_hot"))).withColumn("_rk", F.monotonically_increasing_id()).join(side(table.filter(F.col("n_chunks") > 1).select("_cell", "_rings")),
                                          "_cell", "inner")
    warm = _region_flags(warm, cols + ["_rk"], engine)
    row = F.struct(*[F.col(c) for c in cols])
    # borders through one point; rings that are alike there count once
    arcs = F.flatten(F.collect_set(F.when(F.size("_arcs") > 0, F.array_distinct("_arcs"))))
    warm_kept = (warm.groupBy("_rk").agg(F.first(row).alias("_row"), F.bool_or("_in").alias("_in"), arcs.alias("_arcs"))
                 .filter(_outside()).select("_row.*"))
    return recombine(holders, cool.unionByName(warm_kept))


def enrich_boundaries(df: DataFrame, boundaries: DataFrame, rule: str = "admin_seat",
                      fanout: bool = False, keys: tuple[str, ...] = ("country_code", "name"),
                      **rule_kw) -> DataFrame:
    """Rows selected by the metro ``rule`` get their boundary polygons (D5); all
    other rows pass through with null polygons (D8)."""
    flagged = flag_metros(df, rule, **rule_kw)
    sel, rest = flagged.filter(F.col("isMetro")), flagged.filter(~F.col("isMetro"))
    enriched = attach_boundaries(sel.drop("isMetro"), boundaries, fanout=fanout, keys=keys)
    return recombine(rest.drop("isMetro"), enriched)
