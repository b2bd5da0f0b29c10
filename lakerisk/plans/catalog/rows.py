"""Row-level queries: scores, bands, texts, ids, validation, filters."""

from pyspark.sql import functions as F

from lakerisk import schemas
from lakerisk import vocabulary as V
from lakerisk.functions import text as X
from lakerisk.operators import features, joins, quality, scoring, serving
from lakerisk.plans import domain as D
from lakerisk.plans.catalog.registry import gold, latest, pick, query, rounded, scored
from lakerisk.plans.oracle import level

_SCORES = list(V.INDICATORS)


@query("risk_score", "SELECT event_id, round(risk_score, 6) AS risk_score FROM scored")
def risk_score(spark, d):
    return pick(scoring.risk_score(D.survey(spark, d)), ["event_id", "risk_score"], "risk_score")


@query("risk_level", "SELECT event_id, risk_level FROM scored")
def risk_level(spark, d):
    return scoring.score_and_level(D.survey(spark, d)).select("event_id", "risk_level")


_ANSWERED = " + ".join(f"cast({n} IS NOT NULL AS int)" for n in _SCORES)
_POINTS = " + ".join(f"coalesce({n}, 0)" for n in _SCORES)


@query(
    "partial_score",
    f"SELECT event_id, answered, round(s, 6) AS partial_score, CASE WHEN answered = 7 THEN {level('s')} "
    "WHEN answered > 0 THEN 'Belum Lengkap' END AS partial_level FROM "
    f"(SELECT event_id, {_ANSWERED} AS answered, ({_POINTS})/nullif(({_ANSWERED})*3e0, 0)*100e0 AS s FROM survey) t",
)
def partial_score(spark, d):
    rows = scoring.partial_risk_score(D.survey(spark, d))
    return pick(rows, ["event_id", "answered", "partial_score", "partial_level"], "partial_score")


@query(
    "prediction_band",
    "SELECT u.id_wilayah, CASE WHEN proba_kumuh IS NULL THEN 'none' WHEN proba_kumuh >= 0.7e0 THEN 'high' "
    "WHEN proba_kumuh >= 0.5e0 THEN 'medium' ELSE 'low' END AS prediction_band FROM units u LEFT JOIN gold g USING (id_wilayah)",
)
def prediction_band(spark, d):
    predicted = gold(spark, d).select("id_wilayah", "label_prediksi", "proba_kumuh")
    every = D.units(spark, d).select("id_wilayah").join(predicted, "id_wilayah", "left")
    return scoring.prediction_band(every).select("id_wilayah", "prediction_band")


@query(
    "prediction_label",
    "SELECT u.id_wilayah, CASE WHEN proba_kumuh IS NULL AND label_prediksi IS NULL THEN 'Belum Ada Prediksi' "
    "WHEN label_prediksi = 1 OR proba_kumuh >= 0.5e0 THEN 'Berpotensi Kumuh' ELSE 'Tidak Kumuh' END AS prediction_text "
    "FROM units u LEFT JOIN gold g USING (id_wilayah)",
)
def prediction_label(spark, d):
    predicted = gold(spark, d).select("id_wilayah", "label_prediksi", "proba_kumuh")
    every = D.units(spark, d).select("id_wilayah").join(predicted, "id_wilayah", "left")
    return scoring.prediction_label(every).select("id_wilayah", "prediction_text")


@query(
    "weighted_score",
    "SELECT event_id, round((" + " + ".join(f"coalesce({n}, 0)*{k + 1}e0/28e0" for k, n in enumerate(_SCORES))
    + ")*100e0/3e0, 6) AS weighted_score FROM survey",
)
def weighted_score(spark, d):
    weights = {n: float(k + 1) for k, n in enumerate(V.INDICATORS)}
    return pick(scoring.weighted_risk_score(D.survey(spark, d), weights), ["event_id", "weighted_score"], "weighted_score")


@query(
    "rule_prediction",
    "SELECT id_wilayah, label_prediksi, proba_kumuh FROM gold",
)
def rule_prediction(spark, d):
    return scoring.rule_prediction(latest(spark, d)).select("id_wilayah", "label_prediksi", "proba_kumuh")


@query(
    "dominant_factors",
    "SELECT id_wilayah, top_faktor_1, top_faktor_2, top_faktor_3, skor_faktor_1, skor_faktor_2, skor_faktor_3 FROM factors",
)
def dominant_factors(spark, d):
    rows = scoring.dominant_factors(latest(spark, d))
    return rows.select("id_wilayah", *[f"{kind}_{i}" for kind in ("top_faktor", "skor_faktor") for i in (1, 2, 3)])


@query(
    "indicator_long",
    " UNION ALL ".join(
        f"SELECT id_wilayah, '{V.RADAR_LABELS[n]}' AS label, cast(coalesce({n}, 0) AS double) AS value FROM latest" for n in _SCORES
    ),
)
def indicator_long(spark, d):
    return scoring.indicators_long(latest(spark, d))


@query(
    "feature_vector_input",
    "SELECT id_wilayah, " + ", ".join(f"coalesce({n}, 0) AS {n}" for n in V.MODEL_FEATURES) + " FROM latest",
)
def feature_vector_input(spark, d):
    return features.fill_features(latest(spark, d)).select("id_wilayah", *V.MODEL_FEATURES)


@query(
    "raw_json",
    "SELECT event_id, id_wilayah, skor_jalan, sosek_dominan FROM survey",
)
def raw_json(spark, d):
    """Raw records kept as JSON, read back field by field."""
    kept = quality.with_raw_json(D.survey(spark, d)).select("event_id", "raw_data")
    fields = "id_wilayah STRING, skor_jalan INT, sosek_dominan STRING"
    return kept.select("event_id", F.from_json("raw_data", fields).alias("_r")).select("event_id", "_r.*")


@query(
    "conform_defaults",
    "SELECT event_id, id_wilayah, recorded_at, '' AS recorded_by, "
    + ", ".join(f"coalesce({n}, 0) AS {n}" for n in _SCORES)
    + ", jumlah_kk, jumlah_jiwa, false AS pernah_banjir, frekuensi_banjir, sosek_dominan, '' AS catatan FROM survey",
)
def conform_defaults(spark, d):
    """Text input with some columns absent, typed and defaulted."""
    rows = D.survey(spark, d).withColumn("recorded_at", X.fmt_ts(F.col("recorded_at")))
    as_text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns if c not in ("pernah_banjir", "catatan", "recorded_by")])
    return quality.conform_survey(as_text)


@query(
    "survey_rejects",
    "SELECT reason, count(*) AS n_rows FROM ("
    + " UNION ALL ".join(f"SELECT '{n} missing' AS reason FROM survey WHERE {n} IS NULL" for n in _SCORES)
    + " UNION ALL SELECT 'skor_jalan out of range' FROM survey WHERE recorded_by = 'error' AND skor_jalan + 2 > 3) r GROUP BY reason",
)
def survey_rejects(spark, d):
    """Rejected rows per reason; error events carry a score raised by two."""
    raised = F.when(F.col("recorded_by") == "error", F.col("skor_jalan") + 2).otherwise(F.col("skor_jalan"))
    _, rejected = quality.validate_survey(D.survey(spark, d).withColumn("skor_jalan", raised))
    return rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "survey_valid",
    "SELECT event_id, id_wilayah FROM survey WHERE " + " AND ".join(f"{n} BETWEEN 0 AND 3" for n in _SCORES),
)
def survey_valid(spark, d):
    valid, _ = quality.validate_survey(D.survey(spark, d))
    return valid.select("event_id", "id_wilayah")


@query(
    "build_unit_id",
    "SELECT id_wilayah, 'SBY-' || substr(regexp_replace(upper(kecamatan), '\\s+', '-', 'g'), 1, 5) || '-' || "
    "substr(regexp_replace(upper(kelurahan), '\\s+', '-', 'g'), 1, 5) || '-' || rw || '-' || rt AS built_id FROM units",
)
def build_unit_id(spark, d):
    short_rw, short_rt = F.col("rw").cast("int").cast("string"), F.col("rt").cast("int").cast("string")
    built = X.unit_id(F.col("kecamatan"), F.col("kelurahan"), short_rw, short_rt)
    return D.units(spark, d).select("id_wilayah", built.alias("built_id"))


_VARIANT = "substr('89ab89ab89ab89ab', strpos('0123456789abcdef', substr(h, 17, 1)), 1)"


@query(
    "uuid5_ids",
    f"SELECT id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || {_VARIANT} || "
    "substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid FROM (SELECT event_id AS id, "
    "sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('survey:' || event_id)) AS h FROM survey) t",
)
def uuid5_ids(spark, d):
    name = F.concat(F.lit("survey:"), F.col("event_id"))
    return D.survey(spark, d).select(F.col("event_id").alias("id"), X.uuid5(X.NAMESPACE_URL, name).alias("uuid"))


@query(
    "time_functions",
    "SELECT event_id, t AS unix_s, to_timestamp(t) AT TIME ZONE 'UTC' AS whole_second, recorded_at + INTERVAL 30 DAY AS plus_30, "
    "strftime(recorded_at, '%Y%m%d_%H%M%S') AS version FROM (SELECT *, cast(floor(epoch(recorded_at)) AS bigint) AS t FROM survey) s",
)
def time_functions(spark, d):
    at = F.col("recorded_at")
    return D.survey(spark, d).select(
        "event_id",
        X.epoch(at).alias("unix_s"),
        X.from_epoch(X.epoch(at)).alias("whole_second"),
        X.plus_days(at, 30).alias("plus_30"),
        X.version_string(at).alias("version"),
    )


@query(
    "split_id_list",
    "SELECT DISTINCT kecamatan, kelurahan FROM units",
)
def split_id_list(spark, d):
    """Comma lists with blanks, built per district and split again."""
    names = F.array_sort(F.collect_set("kelurahan"))
    lists = D.units(spark, d).groupBy("kecamatan").agg(F.concat(F.lit(" ,"), F.array_join(names, " , "), F.lit(",")).alias("ids"))
    return lists.select("kecamatan", F.explode(X.split_ids(F.col("ids"))).alias("kelurahan"))


@query("unit_filter", "SELECT id_wilayah, kecamatan, rw, rt FROM units WHERE kecamatan = 'ASIA' AND rw = '05'")
def unit_filter(spark, d):
    return serving.filter_units(D.units(spark, d), kecamatan="ASIA", rw="05").select("id_wilayah", "kecamatan", "rw", "rt")


@query(
    "unit_search",
    "SELECT id_wilayah FROM units WHERE contains(lower(id_wilayah || ' ' || kecamatan || ' ' || kelurahan || ' ' || rw || ' ' || rt), 'asia nation_1')",
)
def unit_search(spark, d):
    return serving.filter_units(D.units(spark, d), q="ASIA nation_1").select("id_wilayah")


@query(
    "incremental_scope",
    "SELECT event_id, id_wilayah FROM survey WHERE id_wilayah IN (SELECT id_wilayah FROM survey WHERE "
    "recorded_at > (SELECT max(recorded_at) - INTERVAL 6 HOUR FROM survey))",
)
def incremental_scope(spark, d):
    """All events of the units heard from in the log's last six hours."""
    return joins.scope_by_keys(D.survey(spark, d), recent_keys(spark, d)).select("event_id", "id_wilayah")


def recent_keys(spark, d):
    log = D.survey(spark, d)
    newest = log.agg(F.max("recorded_at")).scalar()
    return log.filter(F.col("recorded_at") > newest - F.expr("INTERVAL 6 HOURS")).select("id_wilayah").distinct()


@query(
    "affected_ids",
    "SELECT id_wilayah FROM units UNION SELECT id_wilayah FROM survey",
)
def affected_ids(spark, d):
    return joins.affected_ids(D.survey(spark, d), D.units(spark, d), recent_keys(spark, d))


@query(
    "typed_secondary",
    "SELECT batch_id, source_type, id_wilayah, label_kumuh, sumber_label, tanggal_label, cast(NULL AS double) AS kepadatan_jiwa_per_km2, "
    "ingested_at FROM labels_all",
)
def typed_secondary(spark, d):
    rows = D.ground_truth(spark, d)
    rows = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    kept = [f.name for f in schemas.SECONDARY if f.name in (*rows.columns, "kepadatan_jiwa_per_km2")]
    return quality.conform_secondary(rows).select(*kept)
