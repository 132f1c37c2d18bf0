"""Planar geometry as column expressions.

A point is a pair of columns; a polygon is array<array<struct<x,y>>>, the
shell first and then its holes, each ring open or closed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SRID_RD, SRID_WGS84 = 28992, 4326
POINT = r"POINT\((\d+(?:\.\d+)?)\s+(\d+(?:\.\d+)?)\)"


def distance(x1, y1, x2, y2) -> Column:
    dx, dy = F.col(x1) - F.col(x2) if isinstance(x1, str) else x1 - x2, F.col(y1) - F.col(y2) if isinstance(y1, str) else y1 - y2
    return F.sqrt(dx * dx + dy * dy)


def cell(value: Column, size: float) -> Column:
    return F.floor(value / size).cast("long")


def neighbour_cells(x: Column, y: Column, size: float) -> Column:
    """The 3 x 3 grid cells around a point: every point within size lies in one of them."""
    around = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    return F.flatten(F.transform(around, lambda i: F.transform(around, lambda j: F.struct((cell(x, size) + i).alias("cx"), (cell(y, size) + j).alias("cy")))))


def _edges(ring: Column) -> Column:
    """struct(a, b) of each side of a ring, closing it if need be."""
    following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.arrays_zip(ring.alias("a"), following.alias("b"))


def on_edge(ring: Column, x: Column, y: Column) -> Column:
    def touches(e: Column) -> Column:
        a, b = e["a"], e["b"]
        cross = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
        return (cross == 0) & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))

    return F.exists(_edges(ring), touches)


def in_ring(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd ray casting; undefined on the edge."""

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        spans = (a["y"] > y) != (b["y"] > y)
        return F.when(spans, x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"]).otherwise(F.lit(False))

    return F.aggregate(_edges(ring), F.lit(False), lambda odd, e: odd != crosses(e))


def contains(polygon: Column, x: Column, y: Column) -> Column:
    """Strictly inside: within the shell, outside the holes and on no edge."""
    shell, holes = F.element_at(polygon, 1), F.slice(polygon, 2, F.size(polygon))
    return in_ring(shell, x, y) & ~F.exists(polygon, lambda r: on_edge(r, x, y)) & ~F.exists(holes, lambda r: in_ring(r, x, y))


def bounds(polygon: Column) -> Column:
    shell = F.element_at(polygon, 1)
    xs, ys = F.transform(shell, lambda p: p["x"]), F.transform(shell, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def centroid(ring: Column) -> Column:
    """struct(x, y): area-weighted by the shoelace rule."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(s: Column, e: Column) -> Column:
        a, b = e["a"], e["b"]
        w = a["x"] * b["y"] - b["x"] * a["y"]
        return F.struct((s["a"] + w).alias("a"), (s["x"] + (a["x"] + b["x"]) * w).alias("x"), (s["y"] + (a["y"] + b["y"]) * w).alias("y"))

    return F.aggregate(_edges(ring), zero, add, lambda s: F.struct((s["x"] / (3 * s["a"])).alias("x"), (s["y"] / (3 * s["a"])).alias("y")))


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1)))


# The published polynomial approximation between WGS84 and RD (p, q, coefficient).
RD_X = [(0, 1, 190094.945), (1, 1, -11832.228), (2, 1, -114.221), (0, 3, -32.391), (1, 0, -0.705), (3, 1, -2.340), (1, 3, -0.608), (0, 2, -0.008), (2, 3, 0.148)]
RD_Y = [(1, 0, 309056.544), (0, 2, 3638.893), (2, 0, 73.077), (1, 2, -157.984), (3, 0, 59.788), (0, 1, 0.433), (2, 2, -6.439), (1, 1, -0.032), (0, 4, 0.092), (1, 4, -0.054)]
RD_ORIGIN = (155000.0, 463000.0, 52.15517440, 5.38720621)


def rd_from_wgs84(lon: Column, lat: Column) -> Column:
    """struct(x, y) in metres, within about a metre."""
    x0, y0, lat0, lon0 = RD_ORIGIN
    dlat, dlon = 0.36 * (lat - lat0), 0.36 * (lon - lon0)
    total = lambda terms: sum((F.lit(k) * F.pow(dlat, F.lit(p)) * F.pow(dlon, F.lit(q)) for p, q, k in terms), F.lit(0.0))
    return F.struct((total(RD_X) + x0).alias("x"), (total(RD_Y) + y0).alias("y"))


def point_from_wkt(text: Column) -> Column:
    """struct(x, y) of the first POINT(x y) in a text, else null."""
    x, y = (F.try_to_number(F.nullif(F.regexp_extract(text, POINT, k), F.lit("")), F.lit("999999999.999999999")) for k in (1, 2))
    return F.when(text.rlike(POINT), F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))


def ewkt(x: Column, y: Column, srid: int = SRID_RD) -> Column:
    return F.when(x.isNotNull() & y.isNotNull(), F.concat(F.lit(f"SRID={srid};POINT("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")")))


def point_from_ewkt(text: Column) -> Column:
    pattern = r"^SRID=(\d+);POINT\((-?[0-9.E]+) (-?[0-9.E]+)\)$"
    part = lambda k: F.nullif(F.regexp_extract(text, pattern, k), F.lit(""))
    return F.when(text.rlike(pattern), F.struct(part(1).cast("int").alias("srid"), part(2).cast("double").alias("x"), part(3).cast("double").alias("y")))


def point_from_geojson(geometry: Column) -> Column:
    """struct(x, y) of a GeoJSON point; null, {} and other geometries give null."""
    at = lambda k: F.get_json_object(geometry, f"$.coordinates[{k}]").cast("double")
    return F.when(F.get_json_object(geometry, "$.type") == "Point", F.struct(at(0).alias("x"), at(1).alias("y")))
