"""Read-side queries: listings, lookups, map, dashboard, matching, reports."""

from pyspark.sql import functions as F

from lakerisk import vocabulary as V
from lakerisk.operators import forecast as fc, history as h, linkage, ranking, serving
from lakerisk.plans import domain as D
from lakerisk.plans.catalog.geo import POINT, VIEW, _DIST, _VIEW_SQL
from lakerisk.plans.catalog.registry import gold, history, latest, pick, query, ranked, rounded, scored
from lakerisk.sources import files


@query("page_units", "SELECT id_wilayah, kecamatan, kelurahan FROM units WHERE kecamatan = 'ASIA' ORDER BY id_wilayah LIMIT 50 OFFSET 20")
def page_units(spark, d):
    rows = serving.list_units(D.units(spark, d), limit=50, offset=20, kecamatan="ASIA")
    return rows.select("id_wilayah", "kecamatan", "kelurahan")


@query(
    "page_info",
    "SELECT count(*) AS total, least(greatest(count(*) - 20, 0), 50) AS returned, 20 + least(greatest(count(*) - 20, 0), 50) < count(*) AS has_more "
    "FROM units WHERE kecamatan = 'ASIA'",
)
def page_info(spark, d):
    return serving.page_info(serving.filter_units(D.units(spark, d), kecamatan="ASIA"), 50, 20)


@query("unit_options", "SELECT DISTINCT kelurahan AS option FROM units WHERE kecamatan = 'EUROPE'")
def unit_options(spark, d):
    return serving.unit_options(D.units(spark, d), "kelurahan", kecamatan="EUROPE")


@query(
    "unit_lookup",
    "SELECT id_wilayah FROM units WHERE kecamatan = 'ASIA' AND kelurahan = 'NATION_12' AND rw = '05' AND rt = '012' ORDER BY id_wilayah LIMIT 1",
)
def unit_lookup(spark, d):
    return serving.lookup_unit(D.units(spark, d), "ASIA", "NATION_12", "05", "012").select("id_wilayah")


# Point lookups ask for the unit heard from last.
_NEWEST_UNIT = "(SELECT max_by(id_wilayah, recorded_at) FROM survey)"


def newest_unit(spark, d):
    return D.survey(spark, d).agg(F.max_by("id_wilayah", "recorded_at")).scalar()


@query("unit_latest", f"SELECT id_wilayah, event_id, round(risk_score, 6) AS risk_score FROM latest WHERE id_wilayah = {_NEWEST_UNIT}")
def unit_latest(spark, d):
    row = serving.of_unit(latest(spark, d), newest_unit(spark, d))
    return pick(row, ["id_wilayah", "event_id", "risk_score"], "risk_score")


@query(
    "unit_history",
    f"SELECT event_id, recorded_at, round(risk_score, 6) AS risk_score_saat_itu FROM scored WHERE id_wilayah = {_NEWEST_UNIT}",
)
def unit_history(spark, d):
    rows = serving.unit_history(history(spark, d), newest_unit(spark, d))
    return pick(rows, ["event_id", "recorded_at", "risk_score_saat_itu"], "risk_score_saat_itu")


@query("unit_trend", f"SELECT id_wilayah, round(delta_risk, 6) AS delta_risk FROM trends WHERE id_wilayah = {_NEWEST_UNIT}")
def unit_trend(spark, d):
    row = serving.of_unit(h.trend(scored(spark, d)), newest_unit(spark, d))
    return pick(row, ["id_wilayah", "delta_risk"], "delta_risk")


@query("unit_forecast", f"SELECT id_wilayah, round(forecast_score, 6) AS forecast_score FROM forecasts WHERE id_wilayah = {_NEWEST_UNIT}")
def unit_forecast(spark, d):
    row = serving.of_unit(fc.forecast(scored(spark, d)), newest_unit(spark, d))
    return pick(row, ["id_wilayah", "forecast_score"], "forecast_score")


@query("area_factors_lookup", "SELECT kelurahan, faktor FROM (SELECT kelurahan, faktor, row_number() OVER (PARTITION BY kelurahan, kecamatan "
       "ORDER BY avg_skor DESC, faktor) AS rn FROM (" + " UNION ALL ".join(
           f"SELECT kelurahan, kecamatan, '{V.INDICATOR_LABELS[n]}' AS faktor, avg(coalesce({n}, 0)) AS avg_skor FROM placed GROUP BY 1, 2"
           for n in V.INDICATORS) + ") a) r WHERE rn <= 3 AND kelurahan = 'NATION_7'")
def area_factors_lookup(spark, d):
    area = latest(spark, d).filter(F.col("kelurahan") == "NATION_7")
    return ranking.area_factors(area).select("kelurahan", "faktor")


@query("priority_list", "SELECT prioritas_rank, id_wilayah, risk_level FROM ranked")
def priority_list(spark, d):
    return serving.priority_list(ranked(spark, d)).select("prioritas_rank", "id_wilayah", "risk_level")


@query("priority_filtered", "SELECT prioritas_rank, id_wilayah FROM ranked WHERE kecamatan = 'AFRICA' AND risk_level = 'Berat'")
def priority_filtered(spark, d):
    return serving.filter_priority(ranked(spark, d), "AFRICA", "Berat").select("prioritas_rank", "id_wilayah")


@query("top10_priority", "SELECT prioritas_rank, id_wilayah, round(risk_score, 6) AS risk_score FROM ranked ORDER BY prioritas_rank, id_wilayah LIMIT 10")
def top10_priority(spark, d):
    return pick(ranking.top_priority(ranked(spark, d)), ["prioritas_rank", "id_wilayah", "risk_score"], "risk_score")


_ALL_UNITS = "units u LEFT JOIN gold g USING (id_wilayah)"


def every_unit(spark, d):
    """All registered units with their gold figures, NULL when never surveyed."""
    return D.units(spark, d).select("id_wilayah").join(gold(spark, d).select("id_wilayah", "risk_score", "proba_kumuh"), "id_wilayah", "left")


@query(
    "top20_risk",
    f"SELECT u.id_wilayah, round(risk_score, 6) AS risk_score FROM {_ALL_UNITS} ORDER BY coalesce(g.risk_score, 0) DESC, u.id_wilayah LIMIT 20",
)
def top20_risk(spark, d):
    return pick(ranking.top_by(every_unit(spark, d), "risk_score"), ["id_wilayah", "risk_score"], "risk_score")


@query(
    "top20_proba",
    f"SELECT u.id_wilayah, proba_kumuh FROM {_ALL_UNITS} ORDER BY coalesce(proba_kumuh, 0) DESC, u.id_wilayah LIMIT 20",
)
def top20_proba(spark, d):
    return ranking.top_by(every_unit(spark, d), "proba_kumuh").select("id_wilayah", "proba_kumuh")


_NAMED = "forecasts f LEFT JOIN gold g USING (id_wilayah)"


def named(spark, d):
    return serving.forecast_named(fc.forecast(scored(spark, d)), gold(spark, d))


@query(
    "forecast_named",
    f"SELECT f.id_wilayah, round(f.forecast_score, 6) AS forecast_score, coalesce(g.kelurahan, '') AS kelurahan, coalesce(g.kecamatan, '') AS kecamatan, "
    f"coalesce(g.risk_level, '') AS risk_level FROM {_NAMED}",
)
def forecast_named(spark, d):
    return pick(named(spark, d), ["id_wilayah", "forecast_score", "kelurahan", "kecamatan", "risk_level"], "forecast_score")


@query("forecast_filtered", f"SELECT f.id_wilayah, f.forecast_trend FROM {_NAMED} WHERE f.forecast_trend = 'Stabil' AND g.kecamatan = 'AMERICA'")
def forecast_filtered(spark, d):
    return serving.filter_forecast(named(spark, d), "STABIL", "AMERICA").select("id_wilayah", "forecast_trend")


@query(
    "forecast_list",
    f"SELECT f.id_wilayah, round(f.forecast_score, 6) AS forecast_score FROM {_NAMED} ORDER BY f.forecast_score DESC, f.id_wilayah LIMIT 25 OFFSET 5",
)
def forecast_list(spark, d):
    rows = serving.forecast_list(fc.forecast(scored(spark, d)), gold(spark, d), limit=25, offset=5)
    return pick(rows, ["id_wilayah", "forecast_score"], "forecast_score")


@query(
    "map_risk",
    "SELECT b.id_wilayah, u.kecamatan, u.kelurahan, u.rw, u.rt, u.total_jiwa, round(g.risk_score, 6) AS risk_score, "
    "coalesce(g.risk_level, 'Belum Didata') AS risk_level, g.proba_kumuh, g.label_prediksi, coalesce(g.top_faktor_1, '') AS top_faktor_1, "
    "round(minx, 6) AS minx, round(maxy, 6) AS maxy FROM bounds b JOIN units u USING (id_wilayah) LEFT JOIN gold g USING (id_wilayah)",
)
def map_risk(spark, d):
    rows = serving.map_rows(D.units(spark, d), gold(spark, d))
    cols = ["id_wilayah", *V.HIERARCHY, "total_jiwa", "risk_score", "risk_level", "proba_kumuh", "label_prediksi"]
    return pick(rows, [*cols, "top_faktor_1", "minx", "maxy"], "risk_score", "minx", "maxy")


@query(
    "map_page",
    f"SELECT n.id_wilayah, n.distance_km, coalesce(g.risk_level, 'Belum Didata') AS risk_level FROM (SELECT id_wilayah, {_DIST} FROM bounds "
    f"WHERE {_VIEW_SQL}) t) n LEFT JOIN gold g USING (id_wilayah) ORDER BY n.distance_km, n.id_wilayah LIMIT 40 OFFSET 10",
)
def map_page(spark, d):
    """A page of the map inside a viewport, nearest to a point first."""
    rows = serving.map_layer(D.units(spark, d), gold(spark, d), bbox=VIEW, point=POINT, limit=40, offset=10)
    return rows.select("id_wilayah", "distance_km", "risk_level")


@query(
    "geojson_features",
    "SELECT b.id_wilayah, 'Feature' AS type, CASE kind WHEN 'multi' THEN 'MultiPolygon' ELSE 'Polygon' END AS geometry_type, "
    "coalesce(g.risk_level, 'Belum Didata') AS risk_level, g.label_prediksi, u.total_jiwa FROM bounds b JOIN units u USING (id_wilayah) "
    "LEFT JOIN gold g USING (id_wilayah)",
)
def geojson_features(spark, d):
    """Every map feature as GeoJSON text, read back field by field."""
    features = files.to_geojson_features(serving.map_rows(D.units(spark, d), gold(spark, d)))

    def at(path):
        return F.get_json_object("feature", path)

    return features.select(
        "id_wilayah",
        at("$.type").alias("type"),
        at("$.geometry.type").alias("geometry_type"),
        at("$.properties.risk_level").alias("risk_level"),
        at("$.properties.label_prediksi").try_cast("int").alias("label_prediksi"),
        at("$.properties.total_jiwa").cast("long").alias("total_jiwa"),
    )


@query(
    "priority_report",
    "SELECT cast(prioritas_rank AS varchar) AS peringkat, id_wilayah, kelurahan, kecamatan, printf('%.1f', risk_score) AS skor_risiko, "
    "risk_level AS tingkat_risiko, printf('%.1f', proba_kumuh*100e0) || '%' AS probabilitas_kumuh, cast(jiwa_terdampak AS varchar) AS jiwa, "
    "top_faktor_1 AS faktor_1 FROM ranked",
)
def priority_report(spark, d):
    report = files.priority_report(ranked(spark, d).withColumn("cluster_label", F.lit("")))
    return report.drop("cluster", "faktor_2", "faktor_3")


@query(
    "summary_totals",
    "SELECT (SELECT count(*) FROM units) AS total_wilayah, (SELECT count(*) FROM gold WHERE label_prediksi = 1) AS total_kumuh, "
    "(SELECT cast(coalesce(sum(jiwa_terdampak), 0) AS bigint) FROM gold WHERE label_prediksi = 1) AS total_jiwa_terdampak, "
    "(SELECT count(*) FROM survey) AS total_survey_events, (SELECT count(*) FROM forecasts) AS total_forecasted",
)
def summary_totals(spark, d):
    return serving.summary_totals(D.units(spark, d), gold(spark, d), D.survey(spark, d), fc.forecast(scored(spark, d)))


@query("level_breakdown", "SELECT risk_level, count(*) AS n_units FROM gold GROUP BY risk_level")
def level_breakdown(spark, d):
    return serving.level_breakdown(gold(spark, d))


@query(
    "breakdown_map",
    "SELECT unnest(['Berat', 'Ringan', 'Sangat Berat', 'Sedang']) AS risk_level, unnest([count(*) FILTER (WHERE risk_level = 'Berat'), "
    "count(*) FILTER (WHERE risk_level = 'Ringan'), count(*) FILTER (WHERE risk_level = 'Sangat Berat'), "
    "count(*) FILTER (WHERE risk_level = 'Sedang')]) AS n_units FROM gold",
)
def breakdown_map(spark, d):
    """The level breakdown as one map value, opened again for comparison."""
    counts = serving.as_map(serving.level_breakdown(gold(spark, d)), "risk_level", "n_units")
    return counts.select(F.explode("breakdown").alias("risk_level", "n_units"))


@query(
    "forecast_trend_counts",
    "SELECT v.label AS forecast_trend, count(f.id_wilayah) AS n_units FROM (VALUES ('Memburuk'), ('Stabil'), ('Membaik')) AS v(label) "
    "LEFT JOIN forecasts f ON f.forecast_trend = v.label GROUP BY v.label",
)
def forecast_trend_counts(spark, d):
    return serving.forecast_trend_counts(fc.forecast(scored(spark, d)))


_REQUESTS = (
    "SELECT cast(s_suppkey AS varchar(20)) AS request_id, "
    "CASE WHEN s_suppkey % 7 = 0 THEN ' ' ELSE concat(' ', lower(r_name)) END AS kecamatan, "
    "CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE concat(n_name, ' ') END AS kelurahan, "
    "CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE lpad(cast(s_suppkey % 19 + 1 AS varchar(20)), 2, '0') END AS rw, "
    "CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE lpad(cast(s_suppkey % 29 + 1 AS varchar(20)), 3, '0') END AS rt "
    "FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"
)


@query(
    "match_units",
    "SELECT request_id, id_wilayah, match_score FROM (SELECT r.request_id, u.id_wilayah, s.points AS match_score, row_number() OVER "
    "(PARTITION BY r.request_id ORDER BY s.points DESC, u.id_wilayah) AS rn FROM ("
    + _REQUESTS.format(supplier="supplier", nation="nation", region="region")
    + ") r CROSS JOIN (SELECT u.* FROM units u JOIN bounds USING (id_wilayah)) u CROSS JOIN LATERAL (SELECT "
    "CASE WHEN lower(trim(r.kecamatan)) = lower(u.kecamatan) THEN 2 ELSE 0 END + CASE WHEN lower(trim(r.kelurahan)) = lower(u.kelurahan) THEN 4 ELSE 0 END "
    "+ CASE WHEN r.rw = u.rw THEN 3 ELSE 0 END + CASE WHEN r.rt = u.rt THEN 5 ELSE 0 END AS points) s "
    "WHERE s.points > 0 AND (trim(r.kecamatan) <> '' OR trim(r.kelurahan) <> '')) t WHERE rn = 1",
)
def match_units(spark, d):
    names = {n: D.table(spark, d, n) for n in ("supplier", "nation", "region")}
    requests = spark.sql(_REQUESTS, **names)
    return linkage.match_units(requests, D.units(spark, d))
