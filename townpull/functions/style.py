"""Map-layer expressions (G11-G18): marker size, colours and label text."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from townpull.functions.geo import whole_number
from townpull.schema import CODE_COLOR_DEFAULT, CODE_COLORS, MARKER_POINTS

# --- fixed values: label formats of the map layers ---
TOOLTIP_FORMAT = "City: %s<br>Population: %s<br>Feature: %s<br>Admin1: %s, Admin2: %s, Admin3: %s"
POPUP_FORMAT = ("<b>Nazwa:</b> %s<br><b>Feature Code:</b> %s<br><b>Populacja:</b> %s<br>"
                "<b>Geoname ID:</b> %s<br><b>Współrzędne:</b> (%s, %s)<br><b>Admin1 code:</b> %s <br>"
                "<b>Admin2 code:</b> %s <br><b>Admin3 code:</b> %s")
CANDIDATE_FORMAT = "%s | %d (force: %.3f, dist: %.1f km)"
CANDIDATE_HEADER = "<br>Candidate Metros:<br>"
MISSING_TEXT = "nan"
# --- end of fixed values ---


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def marker_radius(pop) -> Column:
    """3 below 1000 (and for null / non-positive), 3->8 linear to 50000,
    8->12 linear to 200000, else 12."""
    p = _c(pop).cast("double")
    (low, smallest), *_ = MARKER_POINTS
    out = F.when(p.isNull() | (p < low), F.lit(smallest))
    for (p0, r0), (p1, r1) in zip(MARKER_POINTS, MARKER_POINTS[1:]):
        out = out.when(p < p1, F.lit(r0) + (p - p0) / F.lit(float(p1 - p0)) * (r1 - r0))
    return out.otherwise(F.lit(MARKER_POINTS[-1][1]))


def color_by_metro(flag="isMetro") -> Column:
    """Red for metros, blue otherwise."""
    return F.when(F.coalesce(_c(flag), F.lit(False)), F.lit("red")).otherwise(F.lit("blue"))


def color_by_code(code="feature_code") -> Column:
    """Codes starting with PPLA red, PPLC green, others blue."""
    c = _c(code)
    return (F.when(c.startswith("PPLA"), F.lit("red")).when(c == "PPLC", F.lit("green"))
            .otherwise(F.lit("blue")))


def color_by_lookup(code="feature_code", mapping: dict | None = None,
                    default: str = CODE_COLOR_DEFAULT) -> Column:
    """Colour from a code -> colour map literal, with a default."""
    mapping = CODE_COLORS if mapping is None else mapping
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(m[_c(code)], F.lit(default))


def _txt(c) -> Column:
    return F.coalesce(_c(c).cast("string"), F.lit(MISSING_TEXT))


def tooltip_text(name="name", population="population", code="feature_code", a1="admin1_code",
                 a2="admin2_code", a3="admin3_code") -> Column:
    """City / Population / Feature / Admin1-3 joined with <br>; null shows as nan."""
    return F.format_string(TOOLTIP_FORMAT, *[_txt(x) for x in (name, population, code, a1, a2, a3)])


def popup_text(name="name", code="feature_code", population="population", gid="geonameid",
               lat="latitude", lon="longitude", a1="admin1_code", a2="admin2_code",
               a3="admin3_code") -> Column:
    """The longer popup label."""
    return F.format_string(POPUP_FORMAT, *[_txt(x) for x in (name, code, population, gid, lat, lon, a1, a2, a3)])


def candidate_text(col="candidates") -> Column:
    """One ``name | id (force, dist)`` line per candidate, with a header;
    empty string for an empty or null list."""
    c = _c(col)
    lines = F.transform(c, lambda x: F.format_string(CANDIDATE_FORMAT, _txt(x["metro_name"]),
                                                     x["metro_id"], x["force"], x["distance"]))
    return F.when(F.coalesce(F.size(c), F.lit(0)) > 0,
                  F.concat(F.lit(CANDIDATE_HEADER), F.array_join(lines, "<br>"))).otherwise(F.lit(""))


def safe_id(col) -> Column:
    """Id as int, from a number (as an id column with nulls comes back as double) or its
    text (``756135``, ``756135.0``); unparsable gives null (the row is skipped where an id is
    required)."""
    return whole_number(_c(col), "int")
