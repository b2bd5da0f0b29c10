"""Area aggregates, ranks, and metric queries."""

from pyspark.sql import functions as F

from lakerisk import vocabulary as V
from lakerisk.operators import features, history as h, joins, metrics, ml, ranking, serving
from lakerisk.operators.forecast import forecast
from lakerisk.plans import domain as D
from lakerisk.plans import medallion as M
from lakerisk.plans.catalog.registry import gold, latest, pick, query, ranked, rounded, scored
from lakerisk.plans.catalog.rows import recent_keys
from lakerisk.operators.quality import union_aligned
from lakerisk.session import scratch_path
from lakerisk.sources.files import read_secondary_csv

_MATRIX = (
    ", ".join(f"round(avg({n}), 6) AS avg_{n}" for n in V.INDICATORS)
    + ", cast(sum(jumlah_jiwa) AS bigint) AS total_jiwa_kelurahan, round(avg(frekuensi_banjir), 6) AS avg_frekuensi_banjir, "
    "count(id_wilayah) AS total_rt_surveyed, round(avg(risk_score), 6) AS avg_risk_score, kelurahan AS id_kelurahan"
)
_MATRIX_DOUBLES = [*[f"avg_{n}" for n in V.INDICATORS], "avg_frekuensi_banjir", "avg_risk_score"]


@query("feature_matrix", f"SELECT kelurahan, kecamatan, {_MATRIX} FROM placed GROUP BY kelurahan, kecamatan")
def feature_matrix(spark, d):
    return rounded(features.feature_matrix(latest(spark, d)), *_MATRIX_DOUBLES)


_RECENT = "SELECT DISTINCT id_wilayah FROM survey WHERE recorded_at > (SELECT max(recorded_at) - INTERVAL 6 HOUR FROM survey)"


@query(
    "feature_scope",
    f"SELECT p.id_wilayah, p.kelurahan, p.kecamatan FROM placed p WHERE EXISTS (SELECT 1 FROM placed q JOIN ({_RECENT}) k "
    "USING (id_wilayah) WHERE q.kelurahan IS NOT DISTINCT FROM p.kelurahan AND q.kecamatan IS NOT DISTINCT FROM p.kecamatan)",
)
def feature_scope(spark, d):
    """All units of the areas that an incremental run touches."""
    snapshot = latest(spark, d)
    touched = joins.scope_by_keys(snapshot, recent_keys(spark, d)).select(*V.AREA_KEYS)
    return joins.scope_by_area(snapshot, touched).select("id_wilayah", *V.AREA_KEYS)


@query(
    "population",
    "SELECT kelurahan, kecamatan, cast(sum(total_jiwa) AS bigint) AS total_jiwa, cast(sum(total_kk) AS bigint) AS total_kk, "
    "count(id_wilayah) AS total_rt FROM units GROUP BY kelurahan, kecamatan",
)
def population(spark, d):
    return features.population(D.units(spark, d))


@query(
    "hierarchy_rollup",
    "SELECT kota, kecamatan, kelurahan, cast(grouping(kota, kecamatan, kelurahan) AS bigint) AS grouping_level, "
    "count(id_wilayah) AS n_units, cast(sum(jumlah_jiwa) AS bigint) AS total_jiwa, round(avg(risk_score), 6) AS avg_risk_score "
    "FROM placed GROUP BY ROLLUP (kota, kecamatan, kelurahan)",
)
def hierarchy_rollup(spark, d):
    city = D.units(spark, d).select("id_wilayah", "kota")
    return rounded(features.hierarchy_rollup(latest(spark, d).join(city, "id_wilayah", "left")), "avg_risk_score")


def secondary_files(spark, d):
    """The four secondary sources written as CSV and read back through the CSV reader."""
    parts = []
    for kind in V.SECONDARY_TYPES:
        path = scratch_path(spark, kind)
        D.secondary_layout(spark, d, kind).write.option("header", True).csv(path)
        parts.append(read_secondary_csv(spark, path, kind))
    return union_aligned(*parts)


_SECONDARY_SQL = (
    "SELECT 'ground_truth' AS source_type, id_wilayah, '' AS kelurahan, label_kumuh, sumber_label, tanggal_label, "
    "cast(NULL AS double) AS kepadatan_jiwa_per_km2, cast(NULL AS int) AS jumlah_kejadian_banjir, "
    "cast(NULL AS double) AS pct_akses_air_bersih, cast(NULL AS int) AS tahun_data FROM truth "
    "UNION ALL SELECT 'bps', '', n_name, NULL, '', '', n_nationkey * 137 % 20000 + 0.5e0, NULL, NULL, 2024 FROM nation "
    "UNION ALL SELECT 'bmkg', '', n_name, NULL, '', '', NULL, cast(n_nationkey % 5 AS int), NULL, 2023 FROM nation "
    "UNION ALL SELECT 'pdam', '', n_name, NULL, '', '', NULL, NULL, cast(60 + n_nationkey % 40 AS double), NULL FROM nation"
)


@query("secondary_unified", _SECONDARY_SQL)
def secondary_unified(spark, d):
    cols = ["source_type", "id_wilayah", "kelurahan", "label_kumuh", "sumber_label", "tanggal_label", "kepadatan_jiwa_per_km2"]
    return secondary_files(spark, d).select(*cols, "jumlah_kejadian_banjir", "pct_akses_air_bersih", "tahun_data")


@query(
    "feature_matrix_ext",
    "SELECT m.kelurahan, m.kecamatan, m.avg_risk_score, m.total_rt_surveyed, n_nationkey * 137 % 20000 + 0.5e0 AS kepadatan_jiwa_per_km2, "
    "cast(n_nationkey % 5 AS int) AS jumlah_kejadian_banjir, cast(60 + n_nationkey % 40 AS double) AS pct_akses_air_bersih FROM "
    f"(SELECT kelurahan, kecamatan, {_MATRIX} FROM placed GROUP BY kelurahan, kecamatan) m LEFT JOIN nation ON n_name = m.kelurahan",
)
def feature_matrix_ext(spark, d):
    rows = features.with_secondary(features.feature_matrix(latest(spark, d)), secondary_files(spark, d))
    cols = ["kelurahan", "kecamatan", "avg_risk_score", "total_rt_surveyed"]
    return pick(rows, [*cols, "kepadatan_jiwa_per_km2", "jumlah_kejadian_banjir", "pct_akses_air_bersih"], "avg_risk_score")


@query(
    "kelurahan_factors",
    "SELECT kelurahan, kecamatan, faktor, round(avg_skor, 6) AS avg_skor, cast(rn AS int) AS urutan FROM (SELECT *, row_number() OVER "
    "(PARTITION BY kelurahan, kecamatan ORDER BY avg_skor DESC, faktor) AS rn FROM ("
    + " UNION ALL ".join(
        f"SELECT kelurahan, kecamatan, '{V.INDICATOR_LABELS[n]}' AS faktor, avg(coalesce({n}, 0)) AS avg_skor FROM placed GROUP BY 1, 2"
        for n in V.INDICATORS
    )
    + ") a) r WHERE rn <= 3",
)
def kelurahan_factors(spark, d):
    return rounded(ranking.area_factors(latest(spark, d)), "avg_skor")


_RANK = "SELECT id_wilayah, round(priority_score, 6) AS priority_score, prioritas_rank FROM ranked"


@query("priority_rank", _RANK)
def priority_rank(spark, d):
    return pick(ranked(spark, d), ["id_wilayah", "priority_score", "prioritas_rank"], "priority_score")


_WIDE_RANK = (
    "SELECT o_orderkey, rank() OVER (ORDER BY o_totalprice DESC NULLS LAST) AS overall, "
    "rank() OVER (ORDER BY o_custkey % 7 - 3 DESC NULLS LAST) AS tied FROM orders"
)


@query("priority_rank_scaled", _WIDE_RANK)
def priority_rank_scaled(spark, d):
    """The distributed rank on a larger table: nearly unique values, and few values with many ties."""
    orders = D.table(spark, d, "orders").withColumn("_sign", (F.col("o_custkey") % 7 - 3).cast("double"))
    once = ranking.global_rank(orders, "o_totalprice", "overall", salt_from=["o_orderkey"])
    both = ranking.global_rank(once, "_sign", "tied", salt_from=["o_orderkey"])
    return both.select("o_orderkey", "overall", "tied")


_NARROW = "1e0 + cast(o_orderkey * 7919 % 1000003 AS double) / 1e12"


@query("priority_rank_narrow", f"SELECT o_orderkey, rank() OVER (ORDER BY {_NARROW} DESC) AS overall FROM orders")
def priority_rank_narrow(spark, d):
    """The distributed rank of values that all lie within a millionth of each other."""
    orders = D.table(spark, d, "orders").select("o_orderkey", F.expr(_NARROW).alias("_value"))
    return ranking.global_rank(orders, "_value", "overall", salt_from=["o_orderkey"]).select("o_orderkey", "overall")


_GAPPED = (
    "CASE WHEN o_orderkey % 5 = 0 THEN cast('NaN' AS double) WHEN o_orderkey % 5 = 1 THEN NULL "
    "ELSE cast(o_orderkey % 1009 - 500 AS double) END"
)


@query("priority_rank_nan", f"SELECT o_orderkey, rank() OVER (ORDER BY {_GAPPED} DESC NULLS LAST) AS overall FROM orders")
def priority_rank_nan(spark, d):
    """The distributed rank where a fifth of the values are no numbers and a fifth are missing."""
    orders = D.table(spark, d, "orders").select("o_orderkey", F.expr(_GAPPED).alias("_value"))
    return ranking.global_rank(orders, "_value", "overall", salt_from=["o_orderkey"]).select("o_orderkey", "overall")


@query(
    "unranked_units_last",
    "SELECT u.id_wilayah, rank() OVER (ORDER BY g.priority_score DESC NULLS LAST) AS prioritas_rank FROM units u LEFT JOIN gold g USING (id_wilayah)",
)
def unranked_units_last(spark, d):
    """Every registered unit ranked; those never surveyed have no score and share the last rank."""
    scores = gold(spark, d).select("id_wilayah", "risk_score", "jiwa_terdampak")
    every = D.units(spark, d).select("id_wilayah").join(scores, "id_wilayah", "left")
    return ranking.priority_rank(every).select("id_wilayah", "prioritas_rank")


_GOLD_COLS = (
    "id_wilayah, kecamatan, kelurahan, round(risk_score, 6) AS risk_score, risk_level, label_prediksi, proba_kumuh, jiwa_terdampak, "
    "top_faktor_1, top_faktor_2, top_faktor_3, skor_faktor_1, round(priority_score, 6) AS priority_score"
)
_GOLD_NAMES = [
    "id_wilayah", "kecamatan", "kelurahan", "risk_score", "risk_level", "label_prediksi", "proba_kumuh", "jiwa_terdampak",
    "top_faktor_1", "top_faktor_2", "top_faktor_3", "skor_faktor_1", "priority_score",
]


@query("gold_risk", f"SELECT {_GOLD_COLS}, prioritas_rank FROM ranked")
def gold_risk(spark, d):
    return pick(ranked(spark, d), [*_GOLD_NAMES, "prioritas_rank"], "risk_score", "priority_score")


@query(
    "gold_without_registry",
    "SELECT id_wilayah, '' AS geometry_wkt, cast(0 AS bigint) AS jiwa_terdampak, round(risk_score, 6) AS risk_score FROM latest",
)
def gold_without_registry(spark, d):
    """Gold columns when no unit registry exists: no places, nobody counted."""
    rows = M.gold_units(M.latest_with_place(D.survey(spark, d), None), None)
    return pick(rows, ["id_wilayah", "geometry_wkt", "jiwa_terdampak", "risk_score"], "risk_score")


def judged(spark, d):
    """Rule predictions of labelled units."""
    truth = h.latest_ground_truth(D.ground_truth(spark, d)).select("id_wilayah", F.col("label_kumuh").alias("label"))
    predicted = gold(spark, d).select(
        "id_wilayah", F.col("label_prediksi").alias("prediction"), F.col("proba_kumuh").alias("proba")
    )
    return predicted.join(truth, "id_wilayah")


_COUNTS = (
    "SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, "
    "count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn FROM judged"
)


@query(
    "confusion_matrix",
    f"SELECT tp, tn, fp, fn, round(coalesce(tp/nullif(tp+fp, 0), 0), 4) AS precision, round(coalesce(tp/nullif(tp+fn, 0), 0), 4) AS recall "
    f"FROM ({_COUNTS}) c",
)
def confusion_matrix(spark, d):
    return metrics.confusion_matrix(judged(spark, d))


@query(
    "classification_metrics",
    "SELECT round(auc, 6) AS auc, round((pos*2e0*p1*r1/nullif(p1+r1, 0) + neg*2e0*p0*r0/nullif(p0+r0, 0))/(pos+neg), 6) AS f1, "
    "round((tp+tn)/(pos+neg), 6) AS accuracy, round((pos*p1+neg*p0)/(pos+neg), 6) AS weighted_precision, "
    "round((pos*r1+neg*r0)/(pos+neg), 6) AS weighted_recall FROM (SELECT *, tp/(tp+fp) AS p1, tp/(tp+fn) AS r1, tn/(tn+fn) AS p0, "
    f"tn/(tn+fp) AS r0, cast(tp+fn AS double) AS pos, cast(tn+fp AS double) AS neg FROM ({_COUNTS}) c) m, "
    "(SELECT (sum(CASE WHEN label = 1 THEN mid END) - count(*) FILTER (WHERE label = 1)*(count(*) FILTER (WHERE label = 1)+1)/2e0) "
    "/ (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)) AS auc FROM (SELECT label, "
    "rank() OVER (ORDER BY proba) + (count(*) OVER (PARTITION BY proba) - 1)/2e0 AS mid FROM judged) r) a",
)
def classification_metrics(spark, d):
    rows = metrics.classification_metrics(judged(spark, d))
    return rounded(rows, *rows.columns)


@query("avg_risk", "SELECT round(avg(coalesce(risk_score, 0)), 6) AS avg_risk_score FROM gold")
def avg_risk(spark, d):
    return rounded(serving.avg_risk(gold(spark, d)), "avg_risk_score")


# Clusters given by the data, so that labelling and counting have a SQL form.
_BANDED = "SELECT g.*, cast(6 - floor(risk_score/15e0) AS int) AS cluster_id FROM gold g"
_NAMED = (
    "SELECT cluster_id, avg_risk_score, jumlah_wilayah, cast(rn AS int) AS cluster_rank, "
    "CASE WHEN rn = 1 THEN 'Cluster Risiko Rendah' WHEN rn = 2 THEN 'Cluster Risiko Sedang' WHEN rn = 3 THEN 'Cluster Risiko Tinggi' "
    "ELSE 'Cluster Risiko Sangat Tinggi' END AS cluster_label FROM (SELECT *, row_number() OVER (ORDER BY avg_risk_score, cluster_id) AS rn "
    f"FROM (SELECT cluster_id, avg(risk_score) AS avg_risk_score, count(*) AS jumlah_wilayah FROM ({_BANDED}) b GROUP BY cluster_id) s) r"
)


def banded(spark, d):
    return gold(spark, d).withColumn("cluster_id", (6 - F.floor(F.col("risk_score") / 15.0)).cast("int"))


@query(
    "cluster_stats",
    f"SELECT cluster_id, round(avg_risk_score, 6) AS avg_risk_score, jumlah_wilayah, cluster_rank, cluster_label FROM ({_NAMED}) n",
)
def cluster_stats(spark, d):
    return rounded(ml.label_stats(ml.cluster_stats(banded(spark, d))), "avg_risk_score")


@query(
    "cluster_labels",
    f"SELECT b.id_wilayah, b.kelurahan, b.kecamatan, cluster_id, cluster_rank, cluster_label FROM ({_BANDED}) b JOIN ({_NAMED}) n USING (cluster_id)",
)
def cluster_labels(spark, d):
    return ml.label_clusters(banded(spark, d))


@query(
    "cluster_distribution",
    f"SELECT cluster_label, count(*) AS n_units FROM ({_BANDED}) b JOIN ({_NAMED}) n USING (cluster_id) GROUP BY cluster_label",
)
def cluster_distribution(spark, d):
    named = ml.label_clusters(banded(spark, d))
    return serving.cluster_distribution(ml.attach_clusters(gold(spark, d), named))


@query(
    "cluster_filtered",
    f"SELECT b.id_wilayah, n.cluster_id, n.cluster_label, b.risk_level FROM ({_BANDED}) b JOIN ({_NAMED}) n USING (cluster_id) "
    "WHERE cluster_id = 3 AND kecamatan = 'ASIA'",
)
def cluster_filtered(spark, d):
    named = ml.label_clusters(banded(spark, d))
    rows = serving.cluster_assignment(ml.attach_clusters(gold(spark, d), named), cluster_id=3, kecamatan="ASIA")
    return rows.select("id_wilayah", "cluster_id", "cluster_label", "risk_level")


@query(
    "cluster_centroids",
    "SELECT cluster_id, "
    + ", ".join(f"round(avg(coalesce({n}, 0)), 6) AS centroid_{n}" for n in V.INDICATORS)
    + " FROM (SELECT l.*, cast(6 - floor(risk_score/15e0) AS int) AS cluster_id FROM latest l) b GROUP BY cluster_id",
)
def cluster_centroids(spark, d):
    """Centroids of the given clusters in original units, by the summary operator."""
    rows = ml.kmeans_input(latest(spark, d))
    given = ml.feature_stage(V.INDICATORS).transform(rows).withColumn(
        "cluster_id", (6 - F.floor(F.col("risk_score") / 15.0)).cast("int")
    )
    names = [f"centroid_{n}" for n in V.INDICATORS]
    return pick(ml.cluster_summary(given), ["cluster_id", *names], *names)


_TEXT = "SELECT string_agg({key} || '=' || n, ',' ORDER BY {key}) FROM ({counts}) c"


@query(
    "summary",
    "SELECT (SELECT count(*) FROM units) AS total_wilayah, (SELECT count(*) FROM forecasts) AS total_forecasted, ("
    + _TEXT.format(key="risk_level", counts="SELECT risk_level, count(*) AS n FROM gold GROUP BY risk_level")
    + ") AS risk_level_breakdown, ("
    + _TEXT.format(
        key="cluster_label",
        counts=f"SELECT cluster_label, count(*) AS n FROM ({_BANDED}) b JOIN ({_NAMED}) n USING (cluster_id) GROUP BY cluster_label",
    )
    + ") AS cluster_distribution, ("
    + _TEXT.format(
        key="label",
        counts="SELECT v.label, count(f.id_wilayah) AS n FROM (VALUES ('Memburuk'), ('Stabil'), ('Membaik')) AS v(label) "
        "LEFT JOIN forecasts f ON f.forecast_trend = v.label GROUP BY v.label",
    )
    + ") AS forecast_trend_summary",
)
def summary(spark, d):
    """The dashboard row, its maps written as text."""
    clustered = ml.attach_clusters(gold(spark, d), ml.label_clusters(banded(spark, d)))
    forecasts = forecast(scored(spark, d))
    row = serving.summary(D.units(spark, d), clustered, D.survey(spark, d), forecasts)

    def as_text(name):
        pairs = F.transform(F.array_sort(F.map_entries(name)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
        return F.array_join(pairs, ",").alias(name)

    maps = ("risk_level_breakdown", "cluster_distribution", "forecast_trend_summary")
    return row.select("total_wilayah", "total_forecasted", *map(as_text, maps))
