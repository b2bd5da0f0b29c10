"""Geometry queries."""

from pyspark.sql import functions as F

from lakerisk.functions import geometry as G
from lakerisk.operators import geo
from lakerisk.plans import domain as D
from lakerisk.plans.catalog.registry import query, rounded

# Viewport and point inside the area the registry covers.
VIEW = (112.66, -7.33, 112.74, -7.27)
POINT = (-7.2575, 112.7521)
_VIEW_SQL = "minx <= 112.74e0 AND maxx >= 112.66e0 AND miny <= -7.27e0 AND maxy >= -7.33e0"
_BOX = "round(minx, 6) AS minx, round(miny, 6) AS miny, round(maxx, 6) AS maxx, round(maxy, 6) AS maxy"
_DIST = (
    "round(2*6371e0*atan2(sqrt(h), sqrt(1-h)), 3) AS distance_km FROM (SELECT *, "
    "power(sin(radians((miny+maxy)/2 - -7.2575e0)/2), 2) + cos(radians(-7.2575e0))*cos(radians((miny+maxy)/2))*"
    "power(sin(radians((minx+maxx)/2 - 112.7521e0)/2), 2) AS h"
)


def located(spark, d):
    return geo.normalize_geometry(D.units(spark, d))


@query(
    "geometry_bounds",
    "SELECT u.id_wilayah, CASE kind WHEN 'point' THEN x/1e4 WHEN 'multi' THEN x/1e4 WHEN 'polygon' THEN x/1e4 END AS minx, "
    "CASE WHEN kind IN ('point', 'multi', 'polygon') THEN -y/1e4 END AS miny, "
    "CASE kind WHEN 'point' THEN x/1e4 WHEN 'multi' THEN (x+130)/1e4 WHEN 'polygon' THEN (x+30)/1e4 END AS maxx, "
    "CASE kind WHEN 'point' THEN -y/1e4 WHEN 'multi' THEN -(y-30)/1e4 WHEN 'polygon' THEN -(y-30)/1e4 END AS maxy "
    "FROM units u JOIN corners c USING (id_wilayah)",
)
def geometry_bounds(spark, d):
    """Raw bounds; a point is its own box, unusable text has none."""
    return geo.with_bounds(D.units(spark, d), "geometry_wkt").select("id_wilayah", *G.BOUNDS)


@query(
    "normalize_geometry",
    "SELECT c.id_wilayah, CASE kind WHEN 'missing' THEN 'missing' WHEN 'broken' THEN 'not a GeoJSON object' "
    f"WHEN 'line' THEN 'unsupported type' END AS geometry_error, {_BOX} FROM corners c LEFT JOIN bounds b USING (id_wilayah, kind)",
)
def normalize_geometry(spark, d):
    return rounded(located(spark, d).select("id_wilayah", "geometry_error", *G.BOUNDS), *G.BOUNDS)


@query("point_box", f"SELECT id_wilayah, {_BOX} FROM bounds WHERE kind = 'point'")
def point_box(spark, d):
    """Squares of the point units, read back from the polygon text they became."""
    points = located(spark, d).filter(G.geojson_type(F.col("geometry_wkt")) == "Point")
    squares = points.select("id_wilayah", "geometry")
    return rounded(geo.with_bounds(squares, "geometry").select("id_wilayah", *G.BOUNDS), *G.BOUNDS)


@query("bbox_filter", f"SELECT id_wilayah FROM bounds WHERE {_VIEW_SQL}")
def bbox_filter(spark, d):
    minx, miny, maxx, maxy = VIEW
    return geo.bbox_filter(located(spark, d), maxx, miny, minx, maxy).select("id_wilayah")


@query(
    "nearest_units",
    f"SELECT id_wilayah, distance_km FROM (SELECT id_wilayah, {_DIST} FROM bounds) t) n ORDER BY distance_km, id_wilayah LIMIT 20",
)
def nearest_units(spark, d):
    return geo.nearest_units(located(spark, d), *POINT, k=20).select("id_wilayah", "distance_km")


@query("unit_distances", f"SELECT id_wilayah, {_DIST} FROM bounds) t")
def unit_distances(spark, d):
    located_units = located(spark, d).filter(F.col("minx").isNotNull())
    return geo.with_distance(located_units, *POINT).select("id_wilayah", "distance_km")


# One viewport per supplier, from street to city size.
_BOX_X = "(1126000 + s_suppkey * 7919 % 2000)/1e4"
_BOX_Y = "-(73500 - s_suppkey * 104729 % 1500)/1e4"
_BOX_W = "(s_suppkey % 9 * s_suppkey % 9 * 50 + 5)/1e4"
_BOXES = (
    f"SELECT cast(s_suppkey AS varchar(20)) AS box_id, {_BOX_X} AS minx, {_BOX_Y} AS miny, "
    f"{_BOX_X} + {_BOX_W} AS maxx, {_BOX_Y} + {_BOX_W} AS maxy FROM supplier"
)


@query(
    "bbox_join",
    f"SELECT b.box_id, u.id_wilayah FROM ({_BOXES}) b JOIN bounds u ON u.minx <= b.maxx AND u.maxx >= b.minx "
    "AND u.miny <= b.maxy AND u.maxy >= b.miny",
)
def bbox_join(spark, d):
    boxes = D.table(spark, d, "supplier").selectExpr(
        "cast(s_suppkey as varchar(20)) as box_id",
        f"{_BOX_X} as minx",
        f"{_BOX_Y} as miny",
        f"{_BOX_X} + {_BOX_W} as maxx",
        f"{_BOX_Y} + {_BOX_W} as maxy",
    )
    return geo.bbox_join(boxes, geo.normalize_geometry(geo.dealt(D.units(spark, d))))
