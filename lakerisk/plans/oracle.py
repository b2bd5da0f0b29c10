"""ANSI SQL views over the given tables, the starting point of every check query.

They restate the operators' meaning independently: windows and joins written
out, no code shared with the operators but the input mapping.
"""

from lakerisk.plans import domain as D


def _select(pairs: list[tuple[str, str]], source: str) -> str:
    return "SELECT " + ", ".join(D.exprs(pairs)) + f" FROM {source}"


_POINTS = (
    "(coalesce(skor_bangunan,0) + coalesce(skor_jalan,0) + coalesce(skor_drainase,0) + coalesce(skor_air_limbah,0)"
    " + coalesce(skor_sampah,0) + coalesce(skor_kebakaran,0) + coalesce(skor_air_minum,0))"
)


def level(score: str) -> str:
    return (
        f"CASE WHEN {score} < 25 THEN 'Ringan' WHEN {score} < 50 THEN 'Sedang' "
        f"WHEN {score} < 75 THEN 'Berat' ELSE 'Sangat Berat' END"
    )


_FACTOR_ROWS = " UNION ALL ".join(
    f"SELECT id_wilayah, '{label}' AS faktor, cast(coalesce({name}, 0) AS double) AS skor FROM latest"
    for name, label in (
        ("skor_bangunan", "Kondisi Bangunan"),
        ("skor_jalan", "Aksesibilitas Jalan"),
        ("skor_drainase", "Drainase Lingkungan"),
        ("skor_air_limbah", "Pengelolaan Air Limbah"),
        ("skor_sampah", "Pengelolaan Persampahan"),
        ("skor_kebakaran", "Proteksi Kebakaran"),
        ("skor_air_minum", "Penyediaan Air Minum"),
    )
)

VIEWS = {
    "survey": _select(D.SURVEY, "events"),
    "units": _select(D.UNITS, "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"),
    "labels_all": _select(D.GROUND_TRUTH, "customer CROSS JOIN (VALUES (0), (1)) AS v(version)"),
    "corners": (
        "SELECT cast(c_custkey AS varchar) AS id_wilayah, "
        f"{D.GEOMETRY_KIND} AS kind, 1126000 + c_custkey * 7919 % 2000 AS x, 73500 - c_custkey * 104729 % 1500 AS y, "
        "least(greatest(CASE WHEN c_custkey % 30 > 0 THEN sqrt(c_custkey % 30 * 1000e0) ELSE 450e0 END, 120e0), 700e0) AS side "
        "FROM customer"
    ),
    "bounds": (
        "SELECT id_wilayah, kind, "
        "CASE kind WHEN 'point' THEN x/1e4 - half_lng ELSE x/1e4 END AS minx, "
        "CASE kind WHEN 'point' THEN -y/1e4 - half_lat ELSE -y/1e4 END AS miny, "
        "CASE kind WHEN 'point' THEN x/1e4 + half_lng WHEN 'multi' THEN (x+130)/1e4 ELSE (x+30)/1e4 END AS maxx, "
        "CASE kind WHEN 'point' THEN -y/1e4 + half_lat ELSE -(y-30)/1e4 END AS maxy "
        "FROM (SELECT *, side/2/111320e0 AS half_lat, "
        "side/2/(111320e0*greatest(cos(radians(-y/1e4)), 0.2e0)) AS half_lng FROM corners) c "
        "WHERE kind IN ('point', 'multi', 'polygon')"
    ),
    "scored": f"SELECT *, {_POINTS}/21e0*100e0 AS risk_score, {level(_POINTS + '/21e0*100e0')} AS risk_level FROM survey",
    "latest": (
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id_wilayah "
        "ORDER BY recorded_at DESC, event_id DESC) AS rn FROM scored) t WHERE rn = 1"
    ),
    "placed": "SELECT l.*, u.kota, u.kecamatan, u.kelurahan, u.rw, u.rt FROM latest l LEFT JOIN units u USING (id_wilayah)",
    "factors": (
        "SELECT id_wilayah, max(CASE WHEN rn = 1 THEN faktor END) AS top_faktor_1, "
        "max(CASE WHEN rn = 2 THEN faktor END) AS top_faktor_2, max(CASE WHEN rn = 3 THEN faktor END) AS top_faktor_3, "
        "max(CASE WHEN rn = 1 THEN skor END) AS skor_faktor_1, max(CASE WHEN rn = 2 THEN skor END) AS skor_faktor_2, "
        "max(CASE WHEN rn = 3 THEN skor END) AS skor_faktor_3 FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY id_wilayah ORDER BY skor DESC, faktor) AS rn FROM ({_FACTOR_ROWS}) f) r GROUP BY id_wilayah"
    ),
    "gold": (
        "SELECT p.id_wilayah, p.kota, p.kecamatan, p.kelurahan, p.rw, p.rt, p.recorded_at, p.risk_score, p.risk_level, "
        "cast(p.risk_score >= 50e0 AS int) AS label_prediksi, round(p.risk_score/100e0, 4) AS proba_kumuh, "
        "u.total_jiwa AS jiwa_terdampak, p.risk_score * u.total_jiwa AS priority_score, "
        "f.top_faktor_1, f.top_faktor_2, f.top_faktor_3, f.skor_faktor_1, f.skor_faktor_2, f.skor_faktor_3 "
        "FROM placed p LEFT JOIN units u USING (id_wilayah) LEFT JOIN factors f USING (id_wilayah)"
    ),
    "ranked": "SELECT *, rank() OVER (ORDER BY priority_score DESC NULLS LAST) AS prioritas_rank FROM gold",
    "trends": (
        "SELECT id_wilayah, risk_score AS risk_score_latest, recorded_at AS recorded_at_latest, risk_score_prev, "
        "recorded_at_prev, risk_score - coalesce(risk_score_prev, risk_score) AS delta_risk FROM (SELECT *, "
        "lead(risk_score) OVER w AS risk_score_prev, lead(recorded_at) OVER w AS recorded_at_prev, "
        "row_number() OVER w AS rn FROM scored WINDOW w AS (PARTITION BY id_wilayah ORDER BY recorded_at DESC, event_id DESC)) t "
        "WHERE rn = 1"
    ),
    "fitted": (
        "SELECT id_wilayah, count(*) AS n, max(t) AS last_t, avg(risk_score) AS mean_y, avg(t/86400e0) AS mean_x, "
        "CASE WHEN var_pop(t/86400e0) > 0 THEN regr_slope(risk_score, t/86400e0) ELSE 0e0 END AS slope FROM "
        "(SELECT *, cast(floor(epoch(recorded_at)) AS bigint) AS t FROM scored) s GROUP BY id_wilayah HAVING count(*) >= 2"
    ),
    "forecasts": (
        "SELECT f.id_wilayah, n AS n_history_events, l.risk_score AS current_risk_score, "
        "least(greatest(mean_y + slope*((last_t + 30*86400)/86400e0 - mean_x), 0e0), 100e0) AS forecast_score, "
        "to_timestamp(last_t + 30*86400) AT TIME ZONE 'UTC' AS forecast_at, slope, "
        "CASE WHEN slope > 0.5e0 THEN 'Memburuk' WHEN slope < -0.5e0 THEN 'Membaik' ELSE 'Stabil' END AS forecast_trend "
        "FROM fitted f JOIN latest l USING (id_wilayah)"
    ),
    "truth": (
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id_wilayah "
        "ORDER BY ingested_at DESC NULLS LAST, batch_id DESC) AS rn FROM labels_all) t WHERE rn = 1"
    ),
    "judged": (
        "SELECT g.id_wilayah, t.label_kumuh AS label, g.label_prediksi AS prediction, g.proba_kumuh AS proba "
        "FROM gold g JOIN truth t USING (id_wilayah)"
    ),
}


def sql(body: str) -> str:
    """The query text with all views in front; engines drop the unused ones."""
    return "WITH " + ", ".join(f"{name} AS ({text})" for name, text in VIEWS.items()) + " " + body
