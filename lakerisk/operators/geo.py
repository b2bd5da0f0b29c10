"""Geometry columns, viewport filters and distances."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerisk.functions import geometry as G
from lakerisk.operators.joins import MOST_PARTS, shuffled, split_parts
from lakerisk.sources.tables import staged

FIRST_CELL_DEG = 0.005
LEVELS = 64  # the last cell size exceeds any coordinate
FINENESS = 8  # a box covers about so many cells in each direction
FINER = 2  # a unit's cell is so many levels below its size
PAIRS_PER_PART = 20_000_000


def _once(df: DataFrame, struct: Column) -> DataFrame:
    """Adds the fields of a struct, computed exactly once per row.

    A one-row inline() instead of a projection: filters on the fields then stay
    above it, where a projection's expressions would be copied into every
    predicate and every further column.
    """
    return df.select("*", F.inline_outer(F.array(struct)))


def with_bounds(df: DataFrame, geom_col: str, point_area: Column | None = None) -> DataFrame:
    """Adds geo_type and minx..maxy of a GeoJSON text column, NULL where it has no positions.

    With ``point_area`` a Point gets the square of that area instead of its own position.
    """
    parsed = _once(df, F.from_json(F.col(geom_col), G.GEOJSON))
    listed = _once(parsed, F.struct(G.points_of(F.col("type"), F.col("coordinates")).alias("_pts")))
    box = G.bounds_of(F.col("_pts"))
    if point_area is not None:
        first = F.get("_pts", F.lit(0))
        square = G.point_box(F.get(first, F.lit(0)), F.get(first, F.lit(1)), point_area)
        box = F.when((F.col("type") == "Point") & (F.size("_pts") > 0), square).otherwise(box)
    return _once(listed, box).drop("_pts", "coordinates").withColumnRenamed("type", "geo_type")


def normalize_geometry(df: DataFrame, geom_col: str = "geometry_wkt", area_col: str = "luas_m2") -> DataFrame:
    """Adds geometry, its minx..maxy and geometry_error.

    A Point becomes a square sized by the unit's area, a Polygon or MultiPolygon
    stays as it is, anything else leaves geometry NULL and names the reason.
    """
    bounded = with_bounds(df, geom_col, F.coalesce(F.col(area_col), F.lit(0.0)))
    kind, found = F.col("geo_type"), F.col("minx").isNotNull()
    error = (
        F.when(found, F.lit(None))
        .when(F.coalesce(F.col(geom_col), F.lit("")) == "", "missing")
        .when(kind.isNull(), "not a GeoJSON object")
        .when(~kind.isin("Point", "Polygon", "MultiPolygon"), "unsupported type")
        .otherwise("no coordinates")
    )
    geometry = F.when(found & (kind == "Point"), G.box_geojson(F.struct(*G.BOUNDS))).when(found, F.col(geom_col))
    return bounded.withColumns({"geometry": geometry, "geometry_error": error}).drop("geo_type")


def dealt(units: DataFrame) -> DataFrame:
    """The registry may be one file, so its rows are dealt out before their texts are parsed."""
    return units.repartition(split_parts(units.sparkSession), "id_wilayah", "geometry_wkt")


def unit_map(units: DataFrame, cell_deg: float = 0.05) -> DataFrame:
    """Units with normalized geometry, neighbours stored together.

    Range-sorted by grid cell, so that a viewport touches few files and the
    row groups of the rest are skipped by their minx..maxy statistics. Dealt rows are located
    and written to the scratch folder: the sort reads its input twice.
    """
    located = staged(units.sparkSession, normalize_geometry(dealt(units)), "located")
    cell = [F.floor(F.col(c) / F.lit(cell_deg)) for c in ("minx", "miny")]
    return located.orderBy(*cell, "id_wilayah")


def bbox_filter(df: DataFrame, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """Rows whose stored bounds meet the viewport; swapped corners are put in order.

    Plain comparisons on double columns, so Parquet min/max statistics skip
    row groups outside the viewport.
    """
    left, right = sorted((minx, maxx))
    bottom, top = sorted((miny, maxy))
    return df.filter(
        (F.col("minx") <= right) & (F.col("maxx") >= left) & (F.col("miny") <= top) & (F.col("maxy") >= bottom)
    )


def with_distance(df: DataFrame, lat: float, lng: float) -> DataFrame:
    """distance_km from the point to the middle of each row's bounds, 3 decimals."""
    center_lng = (F.col("minx") + F.col("maxx")) / 2.0
    center_lat = (F.col("miny") + F.col("maxy")) / 2.0
    return df.withColumn(
        "distance_km", F.round(G.haversine(F.lit(float(lat)), F.lit(float(lng)), center_lat, center_lng), 3)
    )


def nearest_units(units: DataFrame, lat: float, lng: float, k: int, offset: int = 0) -> DataFrame:
    """The k nearest units after ``offset``; a top-k plan, so no full sort."""
    located = with_distance(units.filter(F.col("minx").isNotNull()), lat, lng)
    return located.orderBy(F.asc("distance_km"), F.asc("id_wilayah")).offset(offset).limit(k)


def _level(size: Column) -> Column:
    """Grid level whose cells are at least as large as ``size`` degrees."""
    raw = F.ceil(F.log2(F.greatest(size, F.lit(1e-9)) / F.lit(FIRST_CELL_DEG)))
    return F.greatest(F.lit(0), F.least(F.lit(LEVELS), raw)).cast("int")


def _cell_size(level: Column) -> Column:
    return F.lit(FIRST_CELL_DEG) * F.pow(F.lit(2.0), level)


def _cell(value: str, size: Column) -> Column:
    return F.floor(F.col(value) / size)


def bbox_join(boxes: DataFrame, units: DataFrame, spread: int = 8) -> DataFrame:
    """(box_id, id_wilayah) of every unit that meets each box, for many boxes at once.

    Both sides sit on a grid of doubling cell sizes. A unit lies in one cell, that of its lower left
    corner, at a level set by its own size and at the coarser levels of boxes; a box covers, for each size of
    units, all cells in which one that meets it can have its corner, some FINENESS of them in each direction
    however large it is. So a pair meets once, no distinct is needed, and few pairs that meet do not overlap.

    Pairs may be far more than the rows they come from. Both sides are counted by cell first, which tells
    how many pairs there are: they are dealt by cell to so many tasks that neither a broadcast nor
    the merging of small partitions can leave the pairs to a few, and the units of a cell with more than one task's
    share are spread over ``spread`` tasks or more, its boxes repeated (of at most as many cells as there are tasks).
    """
    spark = units.sparkSession
    span = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    u = units.filter(F.col("minx").isNotNull()).select("id_wilayah", *G.BOUNDS, _level(span).alias("_own"))
    u = staged(spark, u, "units")
    finest = F.greatest(F.lit(0), F.col("_own") - FINER)
    size = _cell_size(finest)
    # At most LEVELS + 1 rows: the cells a unit may reach beyond that of its corner.
    reach = [F.max(F.greatest(F.lit(0), _cell(high, size) - _cell(low, size))).alias(name) for low, high, name in (("minx", "maxx", "x"), ("miny", "maxy", "y"))]
    sizes = u.groupBy("_own").agg(*reach).collect()
    b = boxes.select("box_id", *G.BOUNDS, _level(span / F.lit(FINENESS)).alias("_box"))
    b = staged(spark, b.repartition(split_parts(spark), "box_id", *G.BOUNDS), "boxes")
    levels = [r["_box"] for r in b.select("_box").distinct().collect()]
    if not sizes or not levels:
        return boxes.select("box_id").limit(0).crossJoin(units.select("id_wilayah").limit(0))

    cell = ["_own", "_level", "_cx", "_cy"]
    meeting = [F.greatest(finest, F.lit(level)) for level in levels]
    u_cells = u.withColumn("_level", F.explode(F.array_distinct(F.array(*meeting))))
    at = _cell_size(F.col("_level"))
    u_cells = u_cells.withColumns({"_cx": _cell("minx", at), "_cy": _cell("miny", at)})
    owned = F.array(*[F.struct(F.lit(r["_own"]).alias("_own"), F.lit(r["x"]).alias("_x"), F.lit(r["y"]).alias("_y")) for r in sizes])
    b_cells = b.select("*", F.inline(owned)).withColumn("_level", F.greatest(finest, F.col("_box")))
    for low, high, reached, name in (("minx", "maxx", "_x", "_cx"), ("miny", "maxy", "_y", "_cy")):
        back = F.ceil(F.col(reached) / F.pow(F.lit(2.0), F.col("_level") - finest))  # cells of a coarser level hold 2 x 2 of a finer one
        b_cells = b_cells.withColumn(name, F.explode(F.sequence(_cell(low, at) - back, _cell(high, at))))
    b_cells = b_cells.drop("_box", "_x", "_y")

    n = F.count(F.lit(1))
    counted = u_cells.groupBy(*cell).agg(n.alias("_u")).join(shuffled(b_cells.groupBy(*cell).agg(n.alias("_b"))), cell)
    counted = staged(spark, counted.select(*cell, "_u", (F.col("_u").cast("double") * F.col("_b")).alias("_pairs")), "cells")
    total = counted.agg(F.sum("_pairs").alias("n")).first()["n"] or 0.0
    parts = min(MOST_PARTS, max(split_parts(spark), int(total / PAIRS_PER_PART)))
    share = F.col("_pairs") * F.lit(parts / max(total, 1.0))
    copies = F.least(F.greatest(F.ceil(share), F.lit(spread)), F.col("_u"))
    heavy = counted.filter(share > 1).select(*cell, copies.alias("_copies"))
    deal = list(cell)
    if not heavy.isEmpty():
        u_cells, b_cells = (side.join(shuffled(heavy), cell, "left") for side in (u_cells, b_cells))
        times = F.coalesce("_copies", F.lit(1))
        u_cells = u_cells.withColumn("_salt", F.pmod(F.xxhash64("id_wilayah", *G.BOUNDS), times))
        b_cells = b_cells.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)))
        deal.append("_salt")

    u_side, b_side = u_cells.repartition(parts, *deal).alias("u"), b_cells.repartition(parts, *deal).hint("merge").alias("b")
    same = [F.col(f"u.{c}") == F.col(f"b.{c}") for c in deal]
    overlap = (
        (F.col("u.minx") <= F.col("b.maxx"))
        & (F.col("u.maxx") >= F.col("b.minx"))
        & (F.col("u.miny") <= F.col("b.maxy"))
        & (F.col("u.maxy") >= F.col("b.miny"))
    )
    return u_side.join(b_side, [*same, overlap]).select("box_id", "id_wilayah")
