import json
import math
import random

import pytest
from pyspark.sql import functions as F
from seed import unit, units

from lakerisk.operators import geo, joins, linkage, serving
from lakerisk.operators.linkage import FIELD_POINTS
from lakerisk.plans import domain as D
from lakerisk.plans import medallion as M
from lakerisk.plans.catalog import QUERIES
from lakerisk.sources.files import to_geojson_features


def square(x, y, side):
    return [[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]


GEOMETRIES = {
    "point": {"type": "Point", "coordinates": [112.75, -7.25]},
    "polygon": {"type": "Polygon", "coordinates": [square(112.7, -7.3, 0.01), square(112.702, -7.298, 0.002)]},
    "multi": {"type": "MultiPolygon", "coordinates": [[square(112.0, -7.0, 0.1)], [square(113.0, -8.0, 0.5)]]},
    "altitude": {"type": "Polygon", "coordinates": [[[1, 2, 9], [3, 4, 9], [1, 2, 9]]]},
    "short_point": {"type": "Point", "coordinates": [112.75]},
    "empty": {"type": "Polygon", "coordinates": []},
    "line": {"type": "LineString", "coordinates": [[1, 2], [3, 4]]},
    "no_coordinates": {"type": "Polygon"},
}
TEXTS = {**{k: json.dumps(v) for k, v in GEOMETRIES.items()}, "text": "POINT(1 2)", "blank": "", "null": None}


@pytest.fixture(scope="module")
def located(spark):
    rows = geo.normalize_geometry(units(spark, [unit(k, "K", "L", geometry=v) for k, v in TEXTS.items()])).collect()
    return {r["id_wilayah"]: r for r in rows}


def test_every_row_stays(located):
    assert set(located) == set(TEXTS)


def test_errors(located):
    assert {k: r["geometry_error"] for k, r in located.items()} == {
        "point": None,
        "polygon": None,
        "multi": None,
        "altitude": None,
        "short_point": "no coordinates",
        "empty": "no coordinates",
        "line": "unsupported type",
        "no_coordinates": "no coordinates",
        "text": "not a GeoJSON object",
        "blank": "missing",
        "null": "missing",
    }


def test_bounds(located):
    def box(k):
        return [located[k][n] for n in ("minx", "miny", "maxx", "maxy")]

    assert box("polygon") == pytest.approx([112.7, -7.3, 112.71, -7.29])
    assert box("multi") == pytest.approx([112.0, -8.0, 113.5, -6.9])
    assert box("altitude") == [1, 2, 3, 4]
    assert box("line") == [None] * 4


def test_point_square_is_sized_by_area(spark):
    rows = [unit(str(i), "K", "L") for i in range(4)]
    areas = {"0": 15000.0, "1": 0.0, "2": 1.0, "3": 1e9}
    df = units(spark, rows).withColumn("luas_m2", F.create_map(*[F.lit(x) for kv in areas.items() for x in kv])[F.col("id_wilayah")])
    sides = {"0": math.sqrt(15000), "1": 450.0, "2": 120.0, "3": 700.0}
    for r in geo.normalize_geometry(df).collect():
        side = sides[r["id_wilayah"]]
        assert (r["maxy"] - r["miny"]) * 111320 == pytest.approx(side)
        assert (r["maxx"] - r["minx"]) * 111320 * math.cos(math.radians(7.25)) == pytest.approx(side)
        ring = json.loads(r["geometry"])["coordinates"][0]
        assert ring[0] == ring[-1] and len(ring) == 5


def test_geojson_feature_is_valid_json(spark):
    df = units(spark, [unit("a", 'Q "x"', "L", geometry=TEXTS["multi"])])
    feature = json.loads(to_geojson_features(geo.normalize_geometry(df)).first()["feature"])
    assert feature["type"] == "Feature" and feature["geometry"] == GEOMETRIES["multi"]
    assert feature["properties"]["kecamatan"] == 'Q "x"'


def overlaps(a, b):
    return a[0] <= b[2] and a[2] >= b[0] and a[1] <= b[3] and a[3] >= b[1]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bbox_join_equals_brute_force(spark, seed):
    rng = random.Random(seed)

    def box():
        x, y = rng.uniform(-1, 1), rng.uniform(-1, 1)
        side = rng.choice([0.0, 0.001, 0.01, 0.02, 0.3, 5.0])
        return (x, y, x + side, y + side * rng.random())

    left = {f"b{i}": box() for i in range(60)}
    right = {f"u{i}": box() for i in range(120)}
    schema = "{} STRING, minx DOUBLE, miny DOUBLE, maxx DOUBLE, maxy DOUBLE"
    boxes = spark.createDataFrame([(k, *v) for k, v in left.items()], schema.format("box_id"))
    places = spark.createDataFrame([(k, *v) for k, v in right.items()], schema.format("id_wilayah"))
    got = sorted(map(tuple, geo.bbox_join(boxes, places).collect()))
    assert got == sorted((b, u) for b in left for u in right if overlaps(left[b], right[u]))


def test_bbox_join_deals_pairs_over_tasks(spark):
    """Few rows can make very many pairs, so the sides are neither broadcast nor merged into few partitions."""
    boxes = spark.range(40).selectExpr("cast(id as string) as box_id", "0d as minx", "0d as miny", "0.3d as maxx", "0.3d as maxy")
    places = spark.range(400).selectExpr("cast(id as string) as id_wilayah", "id / 2000 as minx", "id / 2000 as miny", "id / 2000 as maxx", "id / 2000 as maxy")
    pairs = geo.bbox_join(boxes, places)
    assert pairs.count() == 40 * 400
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and plan.count("REPARTITION_BY_NUM") >= 2


def test_bbox_join_locates_units_once_in_many_tasks(spark, data):
    """The registry is one file: its texts are parsed once, not by the one task that reads it, and not again for each side."""
    pairs = QUERIES["bbox_join"](spark, data)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "customer.parquet" not in plan
    read = [f for f in pairs.inputFiles() if "/units/" in f]
    assert 1 < len(read) <= geo.dealt(D.units(spark, data)).rdd.getNumPartitions()


def test_bbox_join_splits_a_cell_of_many_pairs(spark):
    """Units and boxes that lie in one spot are dealt over tasks, with ids that repeat or are missing, boxes turned over, and rows without bounds."""
    place = lambda i: (None if i == 3 else str(i % 290), 1 + i / 1e6, 1.0, 1 + i / 1e6, 1.0)
    view = lambda i: (str(i % 28), 1 + i / 1e5, 1.0, 1 + i / 1e5 + 1e-4, 1.001)
    right = [*map(place, range(300)), ("wide", 0.0, 0.0, 5.0, 5.0), ("nowhere", None, None, None, None)]
    left = [*map(view, range(30)), ("turned", 1.2, 1.2, 1.1, 1.1), ("nowhere", None, None, None, None)]
    schema = "{} STRING, minx DOUBLE, miny DOUBLE, maxx DOUBLE, maxy DOUBLE"
    found = geo.bbox_join(spark.createDataFrame(left, schema.format("box_id")), spark.createDataFrame(right, schema.format("id_wilayah")))
    expected = [(b[0], u[0]) for b in left for u in right if None not in (b[1], u[1]) and overlaps(b[1:], u[1:])]
    some = lambda pair: (pair[0], pair[1] or "")
    assert sorted(map(some, found.collect())) == sorted(map(some, expected))
    assert ("turned", "wide") in expected and "_salt" in found._jdf.queryExecution().executedPlan().toString()
    tasks = found.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 8


@pytest.mark.parametrize("of", ["boxes", "units"])
def test_bbox_join_of_no_rows(spark, of):
    bounds = "0d as minx", "0d as miny", "1d as maxx", "1d as maxy"
    boxes = spark.range(0 if of == "boxes" else 2).selectExpr("cast(id as string) as box_id", *bounds)
    places = spark.range(0 if of == "units" else 2).selectExpr("cast(id as string) as id_wilayah", *bounds)
    found = geo.bbox_join(boxes, places)
    assert found.columns == ["box_id", "id_wilayah"] and found.count() == 0


def test_lookups_that_grow_with_the_units_are_not_broadcast(spark):
    """Small files may hold much in memory, so their size does not decide."""
    rows = units(spark, [unit("a", "K", "L"), unit("b", "K", "L")])
    log = spark.createDataFrame([("e1", "a", None), ("e2", "b", None)], "event_id string, id_wilayah string, priority_score double")
    ids = rows.select("id_wilayah")
    made = {
        "place": joins.lookup_left(log, rows, ["id_wilayah"], ["event_id"]),
        "scope": joins.scope_by_keys(log, ids),
        "match": joins.match_rows(log, ids, ["id_wilayah"], "left_anti"),
        "geometry": M.with_geometry(log, rows),
        "people": M.attach_unit_geometry(log, rows),
    }
    for name, frame in made.items():
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, name
    assert [made[name].count() for name in made] == [2, 2, 0, 2, 2]


def test_viewport_filter_reaches_the_scan(spark, tmp_path):
    geo.unit_map(units(spark, [unit("a", "K", "L")])).write.parquet(str(tmp_path / "map"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    seen = geo.bbox_filter(spark.read.parquet(str(tmp_path / "map")), 112, -8, 113, -7)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(minx,113.0)" in plan and "GreaterThanOrEqual(maxy,-8.0)" in plan
    assert seen.count() == 1


def test_unit_map_parses_a_registry_of_one_file_in_many_tasks_and_once(spark):
    rows = units(spark, [unit(f"u{i}", "K", "L", geometry=TEXTS["polygon"]) for i in range(50)] + [unit(None, "K", "L", geometry=g) for g in TEXTS.values()])
    found = geo.unit_map(rows.coalesce(1))
    assert len(found.inputFiles()) > 8
    assert "from_json" not in found._jdf.queryExecution().executedPlan().toString()
    columns = [*rows.columns, *geo.G.BOUNDS, "geometry", "geometry_error"]
    assert found.select(columns).exceptAll(geo.normalize_geometry(rows).select(columns)).isEmpty()
    assert found.count() == 50 + len(TEXTS)


def test_ids_override_the_viewport(spark):
    df = units(spark, [unit("a", "K", "L"), unit("b", "K", "L"), unit("c", "K", "L", geometry=None)])
    gold = spark.createDataFrame([("a", 10.0, "Ringan")], "id_wilayah STRING, risk_score DOUBLE, risk_level STRING")
    rows = serving.map_layer(df, gold, bbox=(0, 0, 1, 1), ids="b, c,,").collect()
    assert [(r["id_wilayah"], r["risk_level"]) for r in rows] == [("b", "Belum Didata")]
    assert serving.map_layer(df, gold, bbox=(0, 0, 1, 1)).count() == 0


def brute_match(request, places):
    if not request["kecamatan"] and not request["kelurahan"]:
        return None
    scored = []
    for place in places:
        score = sum(p for f, p in FIELD_POINTS.items() if request[f] and request[f] == place[f])
        if score:
            scored.append((-score, place["id"]))
    return min(scored) if scored else None


def test_match_units_deals_units_before_they_multiply(spark):
    """The rows of all field sets are sorted in many tasks, even if one file holds all units."""
    registry = units(spark, [unit("a", "K", "L")]).coalesce(1)
    requests = spark.createDataFrame([("r", "K", "L", "1", "1")], "request_id STRING, kecamatan STRING, kelurahan STRING, rw STRING, rt STRING")
    plan = linkage.match_units(requests, registry)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and "REPARTITION_BY_NUM" in plan.split("Expand", 1)[1]


@pytest.mark.parametrize("seed", [1, 2])
def test_match_units_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    values = {"kecamatan": "abc", "kelurahan": "defgh", "rw": "123", "rt": "4567"}
    places = [{"id": f"u{i:03d}", **{f: rng.choice(v + " ").strip() for f, v in values.items()}} for i in range(60)]
    asked = [{"id": f"r{i}", **{f: rng.choice(v + "x ").strip() for f, v in values.items()}} for i in range(120)]
    fields = list(FIELD_POINTS)
    # A third of the units share one district, and one unit cannot be placed on the map.
    for place in places[:20]:
        place["kecamatan"] = "a"
    registry = units(spark, [unit(p["id"], p["kecamatan"].upper(), f" {p['kelurahan']}", p["rw"], p["rt"]) for p in places]
                     + [unit("a-unmapped", "a", "d", "1", "4", geometry="nowhere")])
    requests = spark.createDataFrame([(r["id"], *[r[f] for f in fields]) for r in asked], "request_id STRING, " + ", ".join(f"{f} STRING" for f in fields))
    got = {r["request_id"]: (-r["match_score"], r["id_wilayah"]) for r in linkage.match_units(requests, registry).collect()}
    want = {r["id"]: brute_match(r, places) for r in asked}
    assert got == {k: v for k, v in want.items() if v}
