"""Town-to-metro radius join (D2, D3) without an all-pairs comparison.

Design
------
Each metro's influence disc is bounded by a latitude/longitude box, the box is
cut into grid cells of ``cell_deg`` degrees, and the metros are grouped into a
*cell index*: one row per (cell, chunk) with an array of at most ``chunk_size``
metros. Every town computes its own cell and joins the index many-to-one on that
key; the exact distance test and the force then run on the metro array of the
town's cell with higher-order functions, so a town row never fans out into pairs
and nothing is re-joined to it afterwards.

* Size: the index is written to the shared checkpoint folder, measured, and
  broadcast only if its metro entries stay under ``max_broadcast_entries``
  (then the town table is not shuffled at all). Beyond that the join is a
  shuffle join on the cell key, where AQE splits hot town cells.
* Hot cells: a cell covered by more than ``chunk_size`` metros is split into
  hash chunks of that size. Only towns of such cells take a second path that
  merges per-chunk results with one aggregation per town row; with no hot cell
  the plan has a single branch.
* Strongest only: where a job needs no more than each town's ``best`` strongest metros, the
  index keeps of a cell only the metros that can be among them somewhere in it (``_survivors``),
  and cells that still hold many are split into parts (``_refine``). A town then meets a
  bounded number of metros however densely they lie, and the index grows with the metros.
* Exactness: boxes are conservative for both metrics (derivation below); the
  final test is the exact strict ``distance < radius``. The Web-Mercator metric
  collapses towards the poles, so towns beyond +-85 degrees use one polar cell
  per hemisphere that every metro joins.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townpull.functions.geo import influence_radius_km, mercator_y
from townpull.operators.sizing import DEFAULT_BROADCAST_ROWS, join_small, materialize, row_hash
from townpull.schema import CANDIDATE_TYPE, EARTH_RADIUS_KM, FORCE_K, MERCATOR_RADIUS_M

POLAR_LAT = 85.0
POLAR_NORTH, POLAR_SOUTH = -1, -2
DEFAULT_CHUNK = 1_000
DEFAULT_CELL_DEG = 0.25
DEFAULT_ENGINE = "arrow"
DEFAULT_BROADCAST_ENTRIES = 2_000_000
METRICS = ("haversine", "mercator_cos")
TASKS_A_CORE = 4       # tasks a core that towns are dealt out to where pairs are listed
SPLIT_ENTRIES = 48     # metros an entry of a strongest-only index shares its cell with, on average, before cells are split
SPLIT_STEP = 4         # parts a side of a cell is split into at a time
MAX_PARTS = 64         # parts a side of a grid cell is split into at most
SLACK = 1e-6           # on quotients of distance and radius: far above rounding and ties of the force


def _grid(cell_deg: float) -> tuple[int, int]:
    n_lat, n_lon = 180.0 / cell_deg, 360.0 / cell_deg
    if abs(n_lon - round(n_lon)) > 1e-9 or abs(n_lat - round(n_lat)) > 1e-9:
        raise ValueError("cell_deg must divide 180 evenly (e.g. 0.25, 0.5, 1, 2, 5)")
    return int(round(n_lat)), int(round(n_lon))


def _lat_idx(lat: Column, c: float, n_lat: int) -> Column:
    return F.least(F.greatest(F.floor((lat + 90.0) / c), F.lit(0)), F.lit(n_lat - 1))


def _lon_idx_raw(lon: Column, c: float) -> Column:
    return F.floor((lon + 180.0) / c)


def town_cell(lat: Column, lon: Column, metric: str, cell_deg: float) -> Column:
    """Cell key of a point (null if a coordinate is null)."""
    n_lat, n_lon = _grid(cell_deg)
    key = _lat_idx(lat, cell_deg, n_lat) * n_lon + F.pmod(_lon_idx_raw(lon, cell_deg), F.lit(n_lon))
    if metric == "mercator_cos":
        # the metric does not wrap: points beyond +-180 degrees go by the cells that every metro joins, too
        key = (F.when(lat > POLAR_LAT, F.lit(POLAR_NORTH)).when(lat < -POLAR_LAT, F.lit(POLAR_SOUTH))
               .when(_off_map(lon), F.lit(POLAR_NORTH)).otherwise(key))
    return key.cast("long")


def _off_map(lon: Column) -> Column:
    return (lon < -180.0) | (lon >= 180.0)


def _part_key(base: Column, parts: Column, si: Column, sj: Column) -> Column:
    """Key of a part of cell ``base``; with one part, the cell's own key."""
    nth = ((parts * parts - 1) / 3).cast("long") + si * parts + sj
    return F.when(parts == 1, base).otherwise(base + F.shiftleft(nth, 32)).cast("long")


def part_of_cell(lat: Column, lon: Column, base: Column, parts: Column, cell_deg: float) -> Column:
    """Key of the part of its cell ``base`` that a point lies in, with ``parts`` parts a side."""
    n_lat, _ = _grid(cell_deg)

    def nth(x: Column, whole: Column) -> Column:
        return F.least(F.greatest(F.floor((x - whole) * parts), F.lit(0)), parts - 1)

    return _part_key(base, parts, nth((lat + 90.0) / cell_deg, _lat_idx(lat, cell_deg, n_lat)),
                     nth((lon + 180.0) / cell_deg, _lon_idx_raw(lon, cell_deg)))


def metro_box(lat: Column, radius_km: Column, metric: str) -> tuple[Column, Column, Column]:
    """Half-widths (degrees) of a box containing every town within ``radius_km``,
    and whether the box spans all longitudes.

    haversine: |dphi| <= delta = r/R; the longitude spread of a spherical cap is
    asin(sin delta / cos phi) unless the cap holds a pole.
    mercator_cos: d = R cos(phi_t) sqrt(dlam^2 + dy^2) with dy the Mercator ordinate
    difference. Equatorward |dphi| < rho (= r/R); poleward |dphi| < rho cos(phi_m)/cos(phi_t);
    both hold with phi_t capped at 85 degrees (polar towns use the polar cells), and
    |dlam| < rho / cos(phi_t). A 1 % margin absorbs rounding.
    """
    phi = F.radians(lat)
    if metric == "haversine":
        delta = radius_km / F.lit(EARTH_RADIUS_KM)
        lat_half = F.degrees(delta) * 1.000001 + 1e-9
        polar = F.abs(lat) + F.degrees(delta) >= 90.0
        ratio = F.least(F.sin(delta) / F.cos(phi), F.lit(1.0))
        lon_half = F.degrees(F.asin(ratio)) * 1.000001 + 1e-9
        return lat_half, lon_half, polar | (ratio >= 1.0)
    if metric == "mercator_cos":
        rho = radius_km * 1000.0 / F.lit(MERCATOR_RADIUS_M)
        cap = math.radians(POLAR_LAT)
        far = F.least(F.abs(phi) + rho * 2.0, F.lit(cap))
        lat_half_rad = F.greatest(rho, rho * F.cos(phi) / F.cos(far)) * 1.01
        lat_half = F.degrees(lat_half_rad)
        reach = F.least(F.abs(phi) + lat_half_rad, F.lit(cap))
        lon_half = F.degrees(rho / F.cos(reach)) * 1.01
        return lat_half, lon_half, lon_half >= 180.0
    raise ValueError(f"metric must be one of {METRICS}")


def _metro_entries(metros: DataFrame, metric: str) -> DataFrame:
    r = (F.col("influence_radius") if "influence_radius" in metros.columns
         else influence_radius_km("population"))
    return metros.select(
        F.col("geonameid").cast("int").alias("metro_id"),
        F.col("name").alias("metro_name"),
        F.col("latitude").cast("double").alias("lat"),
        F.col("longitude").cast("double").alias("lon"),
        r.cast("double").alias("radius"),
        (F.greatest(F.col("reach"), r) if "reach" in metros.columns else r).cast("double").alias("reach"),
        *(["changed"] if "changed" in metros.columns else []),
    ).filter(F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("radius").isNotNull()
             & (F.col("radius") > 0))


def metro_cells(metros: DataFrame, metric: str = "haversine", cell_deg: float = DEFAULT_CELL_DEG,
                with_names: bool = True) -> DataFrame:
    """One row per (cell, metro) for every cell the metro's box touches (its box at ``reach`` where
    there is such a column, never smaller than the radius). The entry carries the name only if ``with_names`` and the Mercator ordinate only for that
    metric, so the arrays joined onto every town stay as small as the job needs."""
    n_lat, n_lon = _grid(cell_deg)
    c = cell_deg
    m = _metro_entries(metros, metric)
    marks = [c for c in ("changed",) if c in metros.columns]
    lat_half, lon_half, all_lon = metro_box(F.col("lat"), F.col("reach"), metric)
    lo_raw = _lon_idx_raw(F.col("lon") - lon_half, c)
    hi_raw = _lon_idx_raw(F.col("lon") + lon_half, c)
    every_lon = all_lon | (hi_raw - lo_raw + 1 >= n_lon)
    lat_seq = F.sequence(_lat_idx(F.col("lat") - lat_half, c, n_lat), _lat_idx(F.col("lat") + lat_half, c, n_lat))
    lon_seq = F.when(every_lon, F.sequence(F.lit(0).cast("long"), F.lit(n_lon - 1).cast("long"))) \
        .otherwise(F.sequence(lo_raw, hi_raw))
    cells = F.flatten(F.transform(lat_seq, lambda i: F.transform(
        lon_seq, lambda j: i * n_lon + F.pmod(j, F.lit(n_lon)))))
    if metric == "mercator_cos":
        cells = F.concat(cells, F.array(F.lit(POLAR_NORTH).cast("long"), F.lit(POLAR_SOUTH).cast("long")))
    fields = ["metro_id"] + (["metro_name"] if with_names else []) + ["lat", "lon", "radius"]
    extra = [mercator_y(F.col("lat")).alias("y")] if metric == "mercator_cos" else []
    entry = F.struct(*fields, *extra)
    return m.select(F.explode(F.array_distinct(cells.cast("array<long>"))).alias("cell"), entry.alias("m"), *marks)


def _divisible(base: Column, cell_deg: float) -> Column:
    """Whether bounds hold in a cell: not in the polar ones, nor in the outermost rows, which also take in
    whatever lies beyond +-90 degrees."""
    n_lat, n_lon = _grid(cell_deg)
    return (base >= n_lon) & (base < (n_lat - 1) * n_lon)


def _quotients(entries: DataFrame, metric: str, cell_deg: float, steps: int) -> DataFrame:
    """``entries`` (base, parts, si, sj, m), each for ``steps`` x ``steps`` parts of its part, with bounds ``low`` and
    ``high``, over all points of the part, of distance / radius of metro ``m``; those that no point's distance can be
    within the radius of are left out.

    haversine: distance from the part's middle, give or take the distance from there to a corner. mercator_cos: the
    same in the plane, times the smallest and largest cosine of the part's latitudes. Worked out Arrow-batched: the formulas
    are too long for compiled row code."""
    from townpull.operators.arrow_eval import quotient_batches
    n_lat, n_lon = _grid(cell_deg)
    part = ["base", "parts", "si", "sj"]
    fields = [T.StructField(c, T.LongType()) for c in part] + [entries.schema["m"]] + [T.StructField(c, T.DoubleType()) for c in ("low", "high")]
    fn = quotient_batches(metric, cell_deg, n_lat, n_lon, 1.0 + SLACK, steps, [f.name for f in fields])
    return entries.select(*part, "m").mapInArrow(fn, T.StructType(fields))


def _survivors(entries: DataFrame, metric: str, cell_deg: float, best: int, steps: int = 1) -> DataFrame:
    """Of ``entries`` (base, parts, si, sj, m), each in ``steps`` x ``steps`` parts of its part, those that can be
    among the ``best`` strongest metros of a point of their part. The force falls with distance / radius, so a metro is out where ``best`` others have a smaller
    quotient everywhere in the part; also where none of its points lie within its radius."""
    part = ["base", "parts", "si", "sj"]
    e = _quotients(entries, metric, cell_deg, steps)
    if best == 1:
        bar = e.groupBy(*part).agg(F.min("high").alias("bar"))
    else:   # the best-th smallest, of the smallest of some lots
        least = F.slice(F.sort_array(F.collect_list("high")), 1, best).alias("least")
        lots = e.groupBy(*part, F.pmod(F.xxhash64("m.metro_id"), F.lit(64)).alias("lot")).agg(least)
        bar = lots.groupBy(*part).agg(F.get(F.sort_array(F.flatten(F.collect_list("least"))), best - 1).alias("bar"))
    # a bar a part: as a rule small enough for a broadcast, so that entries about to be dropped are not shuffled
    return join_small(e, bar, part, "inner").filter(F.col("low") <= F.coalesce("bar", F.lit(float("inf"))) + SLACK).select(*part, "m")


def _refine(cells: DataFrame, metric: str, cell_deg: float, best: int) -> tuple[DataFrame, DataFrame | None]:
    """The entries (cell, m) of a strongest-only index, and how many parts a side cells are split into (base, parts)
    where some are. Each round drops what cannot be strongest and splits the cells that hold many still, so a
    round's work is a fixed multiple of the entries left. Cells that the round before has not thinned out (many
    metros on one point) stay as they are."""
    many = SPLIT_ENTRIES * best
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    left = cells.select(F.col("cell").alias("base"), one.alias("parts"), none.alias("si"), none.alias("sj"), "m")
    settled, split, parts, before, steps = [], [], 1, None, 1
    while True:
        left = materialize(_survivors(left, metric, cell_deg, best, steps))
        n = left.groupBy("base", "si", "sj").agg(F.count(F.lit(1)).cast("double").alias("n")).groupBy("base").agg(
            (F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("shared"))
        n = n.filter((F.col("shared") > many) & _divisible(F.col("base"), cell_deg))
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
        steps = SPLIT_STEP
        left = left.join(dense, "base", "left_semi")
    out = settled[0]
    for s in settled[1:]:
        out = out.unionByName(s)
    sides = None
    if split:
        sides = split[0]
        for s in split[1:]:
            sides = sides.unionByName(s)
        sides = materialize(sides.groupBy("base").agg(F.max("parts").alias("parts")))
    key = _part_key(F.col("base"), F.col("parts"), F.col("si"), F.col("sj"))
    return out.select(key.alias("cell"), "m"), sides


@dataclass
class CellIndex:
    """A built metro cell index and the plan decisions taken from its measured size."""

    table: DataFrame          # cell, chunk, n_chunks, metros
    metric: str
    cell_deg: float
    broadcast: bool
    hot_cells: DataFrame | None   # cells split into several chunks (None if there are none)
    entries: int
    cells: int
    max_per_cell: int
    with_names: bool = True
    hot_polar_only: bool = False  # the only split cells are the two polar cells
    best: int | None = None       # only the metros that can be among a town's ``best`` strongest (None: all)
    parts: DataFrame | None = None    # base, parts: grid cells split into parts (None if there are none)
    covered: DataFrame | None = None  # grid cells that a changed metro reaches (only with ``changed``)


def build_cell_index(metros: DataFrame, metric: str = "haversine", cell_deg: float = DEFAULT_CELL_DEG,
                     chunk_size: int = DEFAULT_CHUNK,
                     max_broadcast_entries: int = DEFAULT_BROADCAST_ENTRIES,
                     with_names: bool = True, at_most: int | None = None, best: int | None = None,
                     towns: DataFrame | None = None, few_pairs: int = 0) -> CellIndex:
    """With a column ``changed``, only cells that a changed metro reaches are indexed, with all their metros.

    ``best``: the towns need their ``best`` strongest metros only; others may be left out.

    ``at_most``: a known bound of the number of metros. Where that is within ``chunk_size`` no cell can
    hold more, and the lists are made at once, without a count of each cell before.

    ``towns`` (cell, towns): the towns of each grid cell, where known. If they meet at most ``few_pairs`` metros in
    all, a strongest-only index keeps them all, as thinning it out would take longer."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if chunk_size < 1:
        raise ValueError("chunk_size must be >= 1")
    mc = metro_cells(metros, metric, cell_deg, with_names)
    if at_most is not None and at_most <= chunk_size:
        marked = F.bool_or("changed") if "changed" in metros.columns else F.lit(True)
        table = mc.groupBy("cell").agg(F.collect_list("m").alias("metros"), marked.alias("t")).filter("t") \
            .select("cell", F.lit(0).alias("chunk"), F.lit(1).alias("n_chunks"), "metros")
        table = materialize(table)
        st = table.agg(F.count(F.lit(1)).alias("cells"), F.coalesce(F.max(F.size("metros")), F.lit(0)).alias("mx"),
                       F.coalesce(F.sum(F.size("metros")), F.lit(0)).alias("total")).first()
        bc = st["total"] <= max_broadcast_entries and st["cells"] <= DEFAULT_BROADCAST_ROWS
        return CellIndex(table, metric, cell_deg, bc, None, int(st["total"]), int(st["cells"]), int(st["mx"]), with_names,
                         covered=table.select("cell") if "changed" in metros.columns else None)
    mc = materialize(mc)
    touched = None
    if "changed" in metros.columns:
        touched = materialize(mc.groupBy("cell").agg(F.bool_or("changed").alias("t")).filter("t").select("cell"))
        mc = mc.drop("changed").join(touched, "cell", "left_semi")

    def count(mc: DataFrame):
        counts = mc.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        return counts, counts.agg(F.count(F.lit(1)).alias("cells"), F.coalesce(F.max("n"), F.lit(0)).alias("mx"),
                                  F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                                  F.coalesce(F.sum(F.ceil(F.col("n") / F.lit(chunk_size))), F.lit(0)).alias("chunks")).first()

    counts, st = count(mc)
    n_lat, n_lon = _grid(cell_deg)
    parts = None
    if best is not None and st["mx"] > SPLIT_ENTRIES * best and n_lat * n_lon < 1 << 32 and not (
            towns is not None and _pairs_met(counts, towns) <= few_pairs):
        mc, parts = _refine(mc, metric, cell_deg, best)
        counts, st = count(mc)
    n_cells, max_n, total = int(st["cells"]), int(st["mx"]), int(st["total"])
    n_rows = n_cells if max_n <= chunk_size else int(st["chunks"])
    if max_n <= chunk_size:
        # every cell's list is proven to hold at most chunk_size metros
        table = (mc.groupBy("cell").agg(F.collect_list("m").alias("metros"))
                 .select("cell", F.lit(0).alias("chunk"), F.lit(1).alias("n_chunks"), "metros"))
        hot = None
    else:
        per_cell = counts.select("cell", F.ceil(F.col("n") / F.lit(chunk_size)).cast("int").alias("n_chunks"))
        keyed = join_small(mc, per_cell, "cell", "inner")
        # numbered, so that no chunk has more than chunk_size entries
        place = Window.partitionBy("cell").orderBy("m.metro_id")
        table = (keyed.withColumn("chunk", F.pmod(F.row_number().over(place), F.col("n_chunks")).cast("int"))
                 .groupBy("cell", "chunk", "n_chunks").agg(F.collect_list("m").alias("metros")))
        hot = materialize(per_cell.filter(F.col("n_chunks") > 1).select("cell"))
    polar_only = hot is not None and hot.filter(F.col("cell") >= 0).limit(1).count() == 0
    table = materialize(table)
    bc = total <= max_broadcast_entries and n_rows <= DEFAULT_BROADCAST_ROWS
    return CellIndex(table, metric, cell_deg, bc, hot, total, n_cells, max_n, with_names, polar_only, best, parts, touched)


def _pairs_met(counts: DataFrame, towns: DataFrame) -> int:
    """(town, metro) pairs of the same cell, by ``counts`` (cell, n) of the metros and ``towns`` (cell, towns)."""
    met = counts.join(towns, "cell").agg(F.sum((F.col("n") * F.col("towns")).cast("decimal(38,0)"))).first()[0]
    return int(met or 0)


def spread_evenly(towns: DataFrame) -> DataFrame:
    """``towns`` dealt out evenly to a few tasks a core: a town's work is the metros it meets, of which neither the
    files of the towns nor their bytes tell. Dealt by a hash of the row, so a task that runs again gets the same."""
    n = TASKS_A_CORE * towns.sparkSession.sparkContext.defaultParallelism
    return towns.repartition(n, row_hash(towns))


def _pair_distance(metric: str, m: Column) -> Column:
    """Distance (km) from the current town (columns _tlat/_tlon/_tcos/_ty) to metro entry m."""
    if metric == "haversine":
        dphi = F.radians(m["lat"] - F.col("_tlat"))
        dlam = F.radians(m["lon"] - F.col("_tlon"))
        a = (F.pow(F.sin(dphi / 2), 2)
             + F.col("_tcos") * F.cos(F.radians(m["lat"])) * F.pow(F.sin(dlam / 2), 2))
        return F.lit(EARTH_RADIUS_KM) * (F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))
    r = F.lit(MERCATOR_RADIUS_M)
    dx = r * (F.radians(F.col("_tlon")) - F.radians(m["lon"]))
    dy = r * (F.col("_ty") - m["y"])
    return F.sqrt(dx * dx + dy * dy) * F.col("_tcos") / F.lit(1000.0)


def _local_candidates(metric: str, with_names: bool = True) -> Column:
    """Exact in-radius candidates of the joined metro array, as
    array<struct<metro_id, metro_name, force, distance>>."""
    scored = F.transform(F.coalesce(F.col("_metros"), F.array()), lambda m: F.struct(
        m["metro_id"].alias("metro_id"),
        (m["metro_name"] if with_names else F.lit(None).cast("string")).alias("metro_name"),
        m["radius"].alias("radius"), _pair_distance(metric, m).alias("distance")))
    inside = F.filter(scored, lambda x: x["distance"] < x["radius"])
    return F.transform(inside, lambda x: F.struct(
        x["metro_id"].alias("metro_id"), x["metro_name"].alias("metro_name"),
        F.exp(F.lit(-FORCE_K) * x["distance"] / x["radius"]).alias("force"),
        x["distance"].alias("distance")))


def _rank_key(x: Column) -> Column:
    """Ordering key: force desc, distance asc, metro_id asc (ascending struct order)."""
    return F.struct((-x["force"]).alias("k1"), x["distance"].alias("k2"), x["metro_id"].alias("k3"),
                    x.alias("v"))


def sort_candidates(col: Column) -> Column:
    return F.transform(F.sort_array(F.transform(col, _rank_key)), lambda s: s["v"])


def best_of(col: Column) -> Column:
    """Strongest candidate of an array (null when empty)."""
    return F.array_min(F.transform(col, _rank_key))["v"]


def _town_prep(towns: DataFrame, metric: str, cell_deg: float, skip: Column | None = None,
               spread_nulls: bool = False, cell_col: str | None = None, parts: DataFrame | None = None) -> DataFrame:
    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    cell = F.col(cell_col) if cell_col else town_cell(lat, lon, metric, cell_deg)
    if skip is not None:
        cell = F.when(F.coalesce(skip, F.lit(False)), F.lit(None).cast("long")).otherwise(cell)
    out = towns
    if parts is not None and not cell_col:
        out = join_small(towns.withColumn("_base", cell), parts.select(F.col("base").alias("_base"), F.col("parts").alias("_parts")),
                         "_base", "left", null_spread=True)
        cell = part_of_cell(lat, lon, F.col("_base"), F.coalesce("_parts", F.lit(1).cast("long")), cell_deg)
    out = out.withColumn("_tlat", lat).withColumn("_tlon", lon) \
        .withColumn("_tcos", F.cos(F.radians(lat))) \
        .withColumn("_cell", F.coalesce(cell, F.lit(-3).cast("long") - F.shiftrightunsigned(row_hash(towns), 2))
                    if spread_nulls and not cell_col
                    # shuffle join: rows without a cell (no coordinates, skipped) get a key made from the
                    # row that matches nothing, so they spread over partitions instead of one
                    else cell)
    if metric == "mercator_cos":
        out = out.withColumn("_ty", mercator_y(lat))
    return out


_TMP = ["_tlat", "_tlon", "_tcos", "_cell", "_ty", "_metros", "_rk", "_hot", "_local"]


def attach_candidates(towns: DataFrame, index: CellIndex, mode: str = "list",
                      out_col: str | None = None, skip: Column | None = None,
                      engine: str | None = None, cell_col: str | None = None) -> DataFrame:
    """Add to every town row its metros within radius (rows where ``skip`` is true,
    e.g. the metros themselves, get none and cost no distance evaluation).

    ``mode="list"`` adds ``candidates`` (C8: sorted by force desc, distance asc, metro_id
    asc; empty array when none). ``mode="best"`` adds ``best`` (C9/W1: the strongest
    candidate struct or null). The town rows keep all their columns.

    ``engine="arrow"`` evaluates the joined metro arrays Arrow-batched with numpy
    (``mapInArrow``); ``engine="jvm"`` with Spark higher-order functions. Both follow
    the same formulas; the plan around them (join, no shuffle of towns) is identical.

    An index of the ``best`` strongest only serves ``mode="best"``; of a list from it, the first ``best`` are right.

    ``cell_col`` names a column that holds every town's cell already, as in stored places
    (``stored_index``); it is joined as it is, so that its bucketing holds.
    """
    engine = engine or DEFAULT_ENGINE
    if engine not in ("arrow", "jvm"):
        raise ValueError("engine must be 'arrow' or 'jvm'")
    if mode not in ("list", "best"):
        raise ValueError("mode must be 'list' or 'best'")
    out_col = out_col or ("candidates" if mode == "list" else "best")
    cols = towns.columns
    t = _town_prep(towns, index.metric, index.cell_deg, skip, not index.broadcast, cell_col, index.parts)
    tab = index.table.select(F.col("cell").alias("_cell"), "chunk", "n_chunks", F.col("metros").alias("_metros"))

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if index.broadcast else df

    def finish_single(df: DataFrame) -> DataFrame:
        if engine == "arrow":
            return _arrow_eval(df, towns.schema, index.metric, mode, out_col, keep=cols)
        local = _local_candidates(index.metric, index.with_names)
        val = sort_candidates(local) if mode == "list" else best_of(local)
        return df.select(*cols, val.alias(out_col))

    if index.hot_cells is None:
        joined = t.join(side(tab.drop("chunk", "n_chunks")), "_cell", "left")
        return finish_single(joined)

    # hot cells exist: only their towns take the chunk-merging path. Row numbers are given
    # to a stored copy of these, so that a task that runs again gives the same.
    if index.hot_polar_only:
        # only the polar cells are split: select their towns by latitude, which the
        # scan can prune by row-group statistics
        lat = F.col("latitude").cast("double")
        polar_lat = (lat > POLAR_LAT) | (lat < -POLAR_LAT)
        off_map = _off_map(F.col("longitude").cast("double"))
        in_polar = F.col("_cell").isin(POLAR_NORTH, POLAR_SOUTH)
        cool_src = t.filter(~F.coalesce((polar_lat | off_map) & in_polar, F.lit(False)))

        def selected(rows: Column) -> DataFrame:
            return _town_prep(towns.filter(rows), index.metric, index.cell_deg, skip,
                              not index.broadcast, cell_col, index.parts).filter(in_polar)
        # towns beyond +-180 degrees are selected by a filter of their own, so that both reach the scan
        warm_src = selected(polar_lat).unionAll(selected(off_map & ~F.coalesce(polar_lat, F.lit(False))))
    else:
        hot = index.hot_cells.select(F.col("cell").alias("_cell"), F.lit(True).alias("_hot"))
        t = join_small(t, hot, "_cell", "left")
        cool_src, warm_src = t.filter(F.col("_hot").isNull()), t.filter(F.col("_hot"))
    cool = cool_src.join(side(tab.filter(F.col("n_chunks") == 1).drop("chunk", "n_chunks")), "_cell", "left")
    part_a = finish_single(cool)
    warm_src = materialize(warm_src).withColumn("_rk", F.monotonically_increasing_id())
    warm = warm_src.join(side(tab.filter(F.col("n_chunks") > 1)), "_cell", "inner")
    if engine == "arrow":
        warm = _arrow_eval(warm, T.StructType(list(towns.schema.fields) + [T.StructField("_rk", T.LongType())]),
                           index.metric, "list", "_local",
                           keep=cols + ["_rk"])
    else:
        warm = warm.withColumn("_local", _local_candidates(index.metric, index.with_names))
    row = F.struct(*[F.col(c) for c in cols])
    if mode == "list":
        merged = warm.groupBy("_rk").agg(F.first(row).alias("_row"),
                                         F.flatten(F.collect_list("_local")).alias("_all"))
        part_b = merged.select("_row.*", sort_candidates(F.col("_all")).alias(out_col))
    else:
        merged = warm.groupBy("_rk").agg(F.first(row).alias("_row"),
                                         F.min(F.array_min(F.transform(F.col("_local"), _rank_key))).alias("_b"))
        part_b = merged.select("_row.*", F.col("_b")["v"].alias(out_col))
    return part_a.unionByName(part_b)


def _arrow_eval(df: DataFrame, base: T.StructType, metric: str, mode: str, out_col: str,
                keep: list[str]) -> DataFrame:
    """Evaluate ``_metros`` of the joined rows Arrow-batched; output ``keep`` + ``out_col``."""
    from townpull.operators.arrow_eval import evaluate_batches
    fields = {f.name: f for f in base.fields}
    out_type = CANDIDATE_TYPE if mode == "list" else CANDIDATE_TYPE.elementType
    schema = T.StructType([fields[c] for c in keep] + [T.StructField(out_col, out_type)])
    drop = [c for c in df.columns if c not in keep]
    staged = df.select(*keep, *[c for c in ("_tlat", "_tlon", "_tcos", "_ty", "_metros") if c in df.columns])
    return staged.mapInArrow(evaluate_batches(metric, mode, out_col, drop), schema)


def radius_join(towns: DataFrame, metros: DataFrame, metric: str = "haversine", cell_deg: float = DEFAULT_CELL_DEG,
                **kw) -> DataFrame:
    """Every (town, metro) pair with distance strictly inside the metro's radius.

    Returns ``geonameid, metro_id, metro_name, distance, force``.
    """
    idx = build_cell_index(metros, metric, cell_deg, **kw)
    rows = towns.select("geonameid", "latitude", "longitude")
    # pairs of a cell's chunks need not come together again
    joined = _with_chunks(_town_prep(rows, metric, cell_deg), idx, F.col("metros"))
    if DEFAULT_ENGINE == "arrow":
        with_c = _arrow_eval(joined, rows.schema, metric, "list", "candidates", keep=["geonameid"])
    else:
        with_c = joined.select("geonameid", _local_candidates(metric, idx.with_names).alias("candidates"))
    return with_c.select("geonameid", F.inline("candidates"))


def _with_chunks(t: DataFrame, idx: CellIndex, metros: Column) -> DataFrame:
    """Prepared towns ``t`` (with ``_cell``), a row for each chunk of their cell, with ``metros`` of it as ``_metros``.

    A town's work is the metros of its cell, not the size of its row, so neither the files of the towns nor their
    bytes tell how to divide it: towns are dealt out evenly to a few tasks a core where the index is
    broadcast. Else a cell's towns go to each of its chunks, which may be joined in different tasks."""
    tab = idx.table.select(F.col("cell").alias("_cell"), F.col("chunk").alias("_chunk"), metros.alias("_metros"))
    t = t.filter(F.col("_cell").isNotNull())
    if idx.broadcast:
        return t.repartition(TASKS_A_CORE * t.sparkSession.sparkContext.defaultParallelism).join(F.broadcast(tab.drop("_chunk")), "_cell", "inner")
    if idx.hot_cells is None:
        return t.join(tab.drop("_chunk"), "_cell", "inner")
    several = idx.table.filter((F.col("n_chunks") > 1) & (F.col("chunk") == 0)).select(F.col("cell").alias("_cell"), "n_chunks")
    t = join_small(t, several, "_cell", "left")
    last = F.coalesce(F.col("n_chunks"), F.lit(1)) - 1
    t = t.withColumn("_chunk", F.explode(F.sequence(F.lit(0), last))).drop("n_chunks")
    return t.join(tab, ["_cell", "_chunk"], "inner")


def bbox_candidates(towns: DataFrame, metros: DataFrame, metric: str = "haversine",
                    cell_deg: float = DEFAULT_CELL_DEG, **kw) -> DataFrame:
    """D3: (town, metro) pairs whose town lies inside the metro's lat/lon box.

    Box test: |lat - lat_m| <= lat_half and the wrapped longitude difference <= lon_half
    (or the box spans all longitudes). Uses the same cell index, without the exact test.
    """
    idx = build_cell_index(metros, metric, cell_deg, **kw)
    t = _town_prep(towns.select("geonameid", "latitude", "longitude"), metric, cell_deg).select("geonameid", "_tlat", "_tlon", "_cell")

    def boxed(m: Column) -> Column:   # a metro's box is worked out once a cell, not once a pair
        lat_half, lon_half, all_lon = metro_box(m["lat"], m["radius"], metric)
        return F.struct(m["metro_id"].alias("metro_id"), m["lat"].alias("lat"), m["lon"].alias("lon"),
                        lat_half.alias("lat_half"), lon_half.alias("lon_half"), all_lon.alias("all_lon"))

    j = _with_chunks(t, idx, F.transform("metros", boxed))
    pairs = j.select("geonameid", "_tlat", "_tlon", F.explode("_metros").alias("m"))
    apart = F.col("_tlon") - F.col("m.lon") + 180.0
    # pmod leaves numbers within a turn as they are
    dlon = F.abs(F.when((apart >= 0.0) & (apart < 360.0), apart).otherwise(F.pmod(apart, F.lit(360.0))) - 180.0)
    inside = (F.abs(F.col("_tlat") - F.col("m.lat")) <= F.col("m.lat_half")) & (F.col("m.all_lon") | (dlon <= F.col("m.lon_half")))
    return pairs.filter(inside).select("geonameid", F.col("m.metro_id").alias("metro_id"))
