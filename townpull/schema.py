"""Place-record schema and the fixed values the semantics depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the source project's for identical results) ---
# Column order of a gazetteer dump row (19 tab-separated fields).
PLACE_COLUMNS = [
    "geonameid", "name", "asciiname", "alternatenames", "latitude", "longitude",
    "feature_class", "feature_code", "country_code", "cc2", "admin1_code",
    "admin2_code", "admin3_code", "admin4_code", "population", "elevation",
    "dem", "timezone", "modification_date",
]
# Feature codes that count as populated places.
POPULATED_CODES = ["PPL", "PPLA", "PPLA2", "PPLA3", "PPLA4", "PPLA5", "PPLC"]
# Codes whose admin2 area excludes a PPL from metro status.
SEAT_CODES = ["PPLA", "PPLC"]
# Codes that are metros outright under the admin-seat rule.
ADMIN_SEAT_METRO_CODES = ["PPLA", "PPLA2", "PPLC"]
# Metro share of the largest population, and the admin-seat PPL population floor.
METRO_SHARE = 0.1
ADMIN_SEAT_MIN_POPULATION = 100000
# Influence radius: MIN + SPAN * (1 - exp(-population / SCALE)), in km.
RADIUS_MIN_KM = 10.0
RADIUS_SPAN_KM = 90.0
RADIUS_POP_SCALE = 1443000.0
# Pull force: exp(-K * distance / radius).
FORCE_K = 1.4
# Earth radius for haversine (km) and the Web-Mercator sphere radius (m).
EARTH_RADIUS_KM = 6371.0
MERCATOR_RADIUS_M = 6378137.0
# Marker colour per feature code for the code-lookup map style, and its default.
CODE_COLORS = {
    "PPL": "blue", "PPLA": "red", "PPLA2": "red", "PPLA3": "red", "PPLA4": "red",
    "PPLC": "purple", "PPLX": "green", "PPLF": "orange", "PPLH": "black", "PPLW": "gray",
}
CODE_COLOR_DEFAULT = "cadetblue"
# Marker radius: (population, radius) points, linear between them, flat outside.
MARKER_POINTS = [(1000, 3.0), (50000, 8.0), (200000, 12.0)]
# --- end of fixed values ---

# every column is text but these
_TYPES = {"geonameid": T.IntegerType(), "latitude": T.DoubleType(), "longitude": T.DoubleType(),
          "population": T.IntegerType(), "dem": T.IntegerType(), "modification_date": T.DateType()}
PLACE_SCHEMA = T.StructType([T.StructField(c, _TYPES.get(c, T.StringType())) for c in PLACE_COLUMNS])

CANDIDATE_TYPE = T.ArrayType(T.StructType([
    T.StructField("metro_id", T.IntegerType()),
    T.StructField("metro_name", T.StringType()),
    T.StructField("force", T.DoubleType()),
    T.StructField("distance", T.DoubleType()),
]))

LATLON = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])
RING_TYPE = T.ArrayType(LATLON)
POLYGONS_TYPE = T.ArrayType(RING_TYPE)

ASSIGNED_EXTRA = T.StructType([
    T.StructField("isMetro", T.BooleanType()),
    T.StructField("influence_radius", T.DoubleType()),
    T.StructField("assigned_metro_id", T.IntegerType()),
])


def assigned_schema(base: T.StructType = PLACE_SCHEMA) -> T.StructType:
    """Schema of an assignment output: the place columns plus the three derived ones."""
    return T.StructType(list(base.fields) + list(ASSIGNED_EXTRA.fields))
