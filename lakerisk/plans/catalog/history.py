"""Queries over the event log: snapshots, trends, forecasts, as-of joins."""

from pyspark.sql import functions as F

from lakerisk import vocabulary as V
from lakerisk.operators import features, forecast as fc, history as h, joins, upsert as up
from lakerisk.plans import domain as D
from lakerisk.plans import medallion as M
from lakerisk.plans.catalog.registry import history, latest, pick, query, rounded, scored
from lakerisk.plans.catalog.rows import recent_keys
from lakerisk.plans.oracle import level

_SCORES = ", ".join(V.INDICATORS)


@query("scan_survey", f"SELECT event_id, id_wilayah, recorded_at, {_SCORES}, jumlah_jiwa, sosek_dominan FROM survey")
def scan_survey(spark, d):
    return D.survey(spark, d).select("event_id", "id_wilayah", "recorded_at", *V.INDICATORS, "jumlah_jiwa", "sosek_dominan")


@query(
    "latest_indicators",
    f"SELECT id_wilayah, event_id, recorded_at, {_SCORES}, round(risk_score, 6) AS risk_score, risk_level FROM latest",
)
def latest_indicators(spark, d):
    cols = ["id_wilayah", "event_id", "recorded_at", *V.INDICATORS, "risk_score", "risk_level"]
    return pick(h.latest_indicators(D.survey(spark, d)), cols, "risk_score")


@query(
    "event_history",
    "SELECT s.event_id, s.id_wilayah, s.recorded_at, u.kecamatan, u.kelurahan, u.rw, u.rt, u.total_jiwa, "
    "round(s.risk_score, 6) AS risk_score_saat_itu, s.risk_level AS risk_level_saat_itu FROM scored s LEFT JOIN units u USING (id_wilayah)",
)
def event_history(spark, d):
    cols = ["event_id", "id_wilayah", "recorded_at", *V.HIERARCHY, "total_jiwa", "risk_score_saat_itu", "risk_level_saat_itu"]
    return pick(history(spark, d), cols, "risk_score_saat_itu")


def redelivered(spark, d):
    """The log with every event delivered again an hour later and once more at once."""
    log = D.survey(spark, d)
    again = F.explode(F.expr("array(INTERVAL 0 HOURS, INTERVAL 1 HOURS, INTERVAL 0 HOURS)"))
    return log.withColumn("_late", again).withColumn("recorded_at", F.col("recorded_at") + F.col("_late")).drop("_late")


@query("dedup_events", "SELECT event_id, id_wilayah, recorded_at FROM survey")
def dedup_events(spark, d):
    return h.dedup_events(redelivered(spark, d)).select("event_id", "id_wilayah", "recorded_at")


@query(
    "duplicate_keys",
    "SELECT event_id, cast(3 AS bigint) AS n_rows FROM survey",
)
def duplicate_keys(spark, d):
    return up.duplicate_keys(redelivered(spark, d), ["event_id"])


@query("ground_truth_latest", "SELECT id_wilayah, label_kumuh, batch_id, ingested_at FROM truth")
def ground_truth_latest(spark, d):
    return h.latest_ground_truth(D.ground_truth(spark, d)).select("id_wilayah", "label_kumuh", "batch_id", "ingested_at")


@query(
    "trend",
    "SELECT id_wilayah, round(risk_score_latest, 6) AS risk_score_latest, recorded_at_latest, round(risk_score_prev, 6) AS risk_score_prev, "
    "recorded_at_prev, round(delta_risk, 6) AS delta_risk, CASE WHEN delta_risk > 2 THEN 'Memburuk' WHEN delta_risk < -2 THEN 'Membaik' "
    "ELSE 'Stabil' END AS trend_label FROM trends",
)
def trend(spark, d):
    return rounded(h.trend(scored(spark, d)), "risk_score_latest", "risk_score_prev", "delta_risk")


@query(
    "history_series",
    f"SELECT id_wilayah, recorded_at, event_id, round(risk_score, 6) AS risk_score, {level('risk_score')} AS point_level FROM scored",
)
def history_series(spark, d):
    return rounded(h.history_series(scored(spark, d)), "risk_score")


_FORECAST = (
    "f.id_wilayah, f.n_history_events, round(f.current_risk_score, 6) AS current_risk_score, round(f.forecast_score, 6) AS forecast_score, "
    f"f.forecast_at, f.forecast_trend, round(f.slope, 4) AS slope_per_day, {level('f.forecast_score')} AS forecast_risk_level"
)


@query("forecast", f"SELECT {_FORECAST} FROM forecasts f")
def forecast(spark, d):
    return rounded(fc.forecast(scored(spark, d)), "current_risk_score", "forecast_score")


@query(
    "forecast_per_second",
    "SELECT id_wilayah, CASE WHEN slope/86400e0 > 0.5e0 THEN 'Memburuk' WHEN slope/86400e0 < -0.5e0 THEN 'Membaik' ELSE 'Stabil' END "
    "AS forecast_trend FROM forecasts",
)
def forecast_per_second(spark, d):
    """Trend labels with the threshold applied to the slope per second."""
    return fc.forecast(scored(spark, d), per_second=True).select("id_wilayah", "forecast_trend")


@query(
    "snapshot_as_of",
    "SELECT id_wilayah, event_id, recorded_at FROM (SELECT *, row_number() OVER (PARTITION BY id_wilayah ORDER BY recorded_at DESC, "
    "event_id DESC) AS rn FROM survey WHERE recorded_at <= timestamp '2024-01-15 12:00:00') t WHERE rn = 1",
)
def snapshot_as_of(spark, d):
    return h.snapshot_as_of(D.survey(spark, d), "2024-01-15 12:00:00").select("id_wilayah", "event_id", "recorded_at")


_DATED = "SELECT *, cast(tanggal_label || ' 12:00:00' AS timestamp) AS labeled_at FROM labels_all"


@query(
    "label_asof",
    f"SELECT l.batch_id, l.id_wilayah, l.labeled_at, max(s.recorded_at) AS recorded_at, max_by(s.event_id, s.recorded_at) AS event_id "
    f"FROM ({_DATED}) l LEFT JOIN survey s ON s.id_wilayah = l.id_wilayah AND s.recorded_at <= l.labeled_at "
    "GROUP BY l.batch_id, l.id_wilayah, l.labeled_at",
)
def label_asof(spark, d):
    at = F.concat("tanggal_label", F.lit(" 12:00:00")).cast("timestamp")
    labels = D.ground_truth(spark, d).select("batch_id", "id_wilayah", at.alias("labeled_at"))
    return h.label_asof(labels, D.survey(spark, d))


@query(
    "training_set",
    "SELECT l.id_wilayah, t.label_kumuh AS label, " + ", ".join(f"coalesce({n}, 0) AS {n}" for n in V.MODEL_FEATURES)
    + " FROM latest l JOIN truth t USING (id_wilayah)",
)
def training_set(spark, d):
    return features.training_set(latest(spark, d), h.latest_ground_truth(D.ground_truth(spark, d)))


# Merges of an older snapshot with what came after it.
_MIDDLE = "timestamp '2024-01-15 12:00:00'"
_MIDDLE_TS = "2024-01-15 12:00:00"


@query("upsert_latest", "SELECT id_wilayah, event_id, recorded_at FROM latest")
def upsert_latest(spark, d):
    """Snapshot of mid-month upserted with the latest rows of the units heard from since."""
    log = D.survey(spark, d)
    older = h.snapshot_as_of(log, _MIDDLE_TS)
    newer = h.latest_per_key(log.filter(F.col("recorded_at") > F.lit(_MIDDLE_TS).cast("timestamp")))
    return up.upsert(older, newer, ["id_wilayah"]).select("id_wilayah", "event_id", "recorded_at")


@query(
    "insert_only_history",
    f"SELECT event_id, id_wilayah, CASE WHEN recorded_at <= {_MIDDLE} THEN 'kept' ELSE 'inserted' END AS origin FROM survey",
)
def insert_only_history(spark, d):
    """The mid-month log merged with the whole log: known events stay as they are."""
    log = D.survey(spark, d).select("event_id", "id_wilayah", "recorded_at")
    stored = log.filter(F.col("recorded_at") <= F.lit(_MIDDLE_TS).cast("timestamp")).withColumn("origin", F.lit("kept"))
    merged = up.upsert(stored, log.withColumn("origin", F.lit("inserted")), ["event_id"], update_matches=False)
    return merged.select("event_id", "id_wilayah", "origin")


@query(
    "align_schema",
    "SELECT id_wilayah, event_id, cast(NULL AS int) AS skor_jalan, cast(NULL AS double) AS risk_score FROM survey",
)
def align_schema(spark, d):
    target = latest(spark, d).select("id_wilayah", "event_id", "skor_jalan", "risk_score").schema
    return up.align_schema(D.survey(spark, d).select("event_id", "id_wilayah"), target)


@query(
    "register_units",
    "SELECT id_wilayah, id_wilayah IN (SELECT id_wilayah FROM survey) AS duplicate FROM units",
)
def register_units(spark, d):
    """Registry rows offered again, where surveyed units count as registered."""
    units = D.units(spark, d)
    known = D.survey(spark, d).select("id_wilayah").distinct()
    new, again = joins.register_units(known, units)
    return (
        new.select("id_wilayah", F.lit(False).alias("duplicate"))
        .unionByName(again.select("id_wilayah", F.lit(True).alias("duplicate")))
    )


@query("rescoped_history", "SELECT s.event_id FROM survey s SEMI JOIN (SELECT id_wilayah FROM survey WHERE recorded_at > "
       "(SELECT max(recorded_at) - INTERVAL 6 HOUR FROM survey)) k USING (id_wilayah)")
def rescoped_history(spark, d):
    """History of recently heard units, built as an incremental run builds it."""
    scope = joins.scope_by_keys(D.survey(spark, d), recent_keys(spark, d))
    return M.event_history(scope, D.units(spark, d)).select("event_id")
