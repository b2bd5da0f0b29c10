"""GeoJSON and distance expressions on plain columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakerisk.functions.text import clamp

# Fixed values of the point-to-square rule and the distance formula.
METERS_PER_DEGREE = 111_320.0
DEFAULT_SIDE_M = 450.0
MIN_SIDE_M, MAX_SIDE_M = 120.0, 700.0
MIN_COS_LAT = 0.2
EARTH_RADIUS_KM = 6371.0

BOUNDS = ("minx", "miny", "maxx", "maxy")


# Read as text, the coordinates can be parsed once the type is known.
GEOJSON = "type STRING, coordinates STRING"


def geojson_type(geom: Column) -> Column:
    return F.get_json_object(geom, "$.type")


def points_of(kind: Column, coordinates: Column) -> Column:
    """All [lng, lat] positions in the coordinates text of a Point, Polygon or MultiPolygon, else NULL."""
    polygon = F.from_json(coordinates, "array<array<array<double>>>")
    multi = F.from_json(coordinates, "array<array<array<array<double>>>>")
    points = (
        F.when(kind == "Point", F.array(F.from_json(coordinates, "array<double>")))
        .when(kind == "Polygon", F.flatten(polygon))
        .when(kind == "MultiPolygon", F.flatten(F.flatten(multi)))
    )
    return F.filter(points, lambda p: F.get(p, 0).isNotNull() & F.get(p, 1).isNotNull())


def geojson_points(geom: Column) -> Column:
    return points_of(geojson_type(geom), F.get_json_object(geom, "$.coordinates"))


def bounds_of(points: Column) -> Column:
    """struct(minx, miny, maxx, maxy) of positions; NULL when there are none."""
    lngs = F.transform(points, lambda p: F.get(p, 0))
    lats = F.transform(points, lambda p: F.get(p, 1))
    box = F.struct(
        F.array_min(lngs).alias("minx"),
        F.array_min(lats).alias("miny"),
        F.array_max(lngs).alias("maxx"),
        F.array_max(lats).alias("maxy"),
    )
    return F.when(F.size(points) > 0, box)


def geometry_bounds(geom: Column) -> Column:
    return bounds_of(geojson_points(geom))


def point_box(lng: Column, lat: Column, area_m2: Column) -> Column:
    """Square around a point, sized by area: struct(minx, miny, maxx, maxy)."""
    side = clamp(
        F.when(area_m2 > 0, F.sqrt(area_m2.cast("double"))).otherwise(F.lit(DEFAULT_SIDE_M)),
        MIN_SIDE_M,
        MAX_SIDE_M,
    )
    half_lat = side / 2.0 / METERS_PER_DEGREE
    per_lng = F.lit(METERS_PER_DEGREE) * F.greatest(F.cos(F.radians(lat)), F.lit(MIN_COS_LAT))
    half_lng = side / 2.0 / per_lng
    return F.struct(
        (lng - half_lng).alias("minx"),
        (lat - half_lat).alias("miny"),
        (lng + half_lng).alias("maxx"),
        (lat + half_lat).alias("maxy"),
    )


def box_geojson(box: Column) -> Column:
    """Closed polygon text of a bounds struct."""

    def corner(x: str, y: str) -> Column:
        return F.array(box[x], box[y])

    ring = F.array(
        corner("minx", "miny"),
        corner("maxx", "miny"),
        corner("maxx", "maxy"),
        corner("minx", "maxy"),
        corner("minx", "miny"),
    )
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))


def bbox_intersects(a: Column, b: Column) -> Column:
    """Overlap of two bounds structs, touching edges included."""
    return (
        (a["minx"] <= b["maxx"])
        & (a["maxx"] >= b["minx"])
        & (a["miny"] <= b["maxy"])
        & (a["maxy"] >= b["miny"])
    )


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in km."""
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2.0)
    half_dlng = F.sin(F.radians(lng2 - lng1) / 2.0)
    chord = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlng * half_dlng
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(F.lit(1.0) - chord))
