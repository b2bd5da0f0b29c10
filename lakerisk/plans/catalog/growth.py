"""Queries over tables that grow: folded batches, id indexes, new columns, keyed messages."""

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk import schemas
from lakerisk import vocabulary as V
from lakerisk.functions.text import JSON_OPTIONS
from lakerisk.operators import unit_state as us
from lakerisk.operators.clusters import Clusters, farther_than_nearest
from lakerisk.operators.joins import shuffled
from lakerisk.plans import domain as D
from lakerisk.plans import medallion as M
from lakerisk.plans.catalog.history import _FORECAST, _MIDDLE_TS
from lakerisk.plans.catalog.lake import _LATEST_SQL, _latest, _read, grown_lake
from lakerisk.plans.catalog.registry import query, rounded, scored
from lakerisk.plans.catalog.rows import _VARIANT
from lakerisk.plans.catalog.streams import _consume
from lakerisk.session import scratch_path
from lakerisk.sources import files, idindex, tables
from lakerisk.streaming import ingest

_UUID = (
    f"substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || {_VARIANT} || "
    "substr(h, 18, 3) || '-' || substr(h, 21, 12)"
)


def _named(name: str) -> str:
    return f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({name}))"


def _folded(spark: SparkSession, d: str) -> DataFrame:
    """Unit states of the log's three thirds by event number, folded one after another."""
    log = scored(spark, d).select("id_wilayah", "recorded_at", "event_id", F.col("risk_score_saat_itu"))
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    state = us.event_state(log.filter(part == 0))
    for k in (1, 2):
        batch = us.event_state(log.filter(part == k))
        untouched = state.join(shuffled(batch.select("id_wilayah")), "id_wilayah", "left_anti")
        state = tables.staged(spark, us.merge_state(state, batch).unionByName(untouched), "state")
    return state


@query(
    "folded_trend",
    "SELECT id_wilayah, round(risk_score_latest, 6) AS risk_score_latest, recorded_at_latest, round(risk_score_prev, 6) AS risk_score_prev, "
    "recorded_at_prev, round(delta_risk, 6) AS delta_risk FROM trends",
)
def folded_trend(spark, d):
    """Trend from unit states that saw the log in three batches, in no order of time."""
    return rounded(us.trend_of(_folded(spark, d)).drop("trend_label"), "risk_score_latest", "risk_score_prev", "delta_risk")


@query("folded_forecast", f"SELECT {_FORECAST} FROM forecasts f")
def folded_forecast(spark, d):
    return rounded(us.forecast_of(_folded(spark, d)), "current_risk_score", "forecast_score")


@query("indexed_insert", "SELECT event_id, id_wilayah, CASE WHEN recorded_at <= timestamp '2024-01-15 12:00:00' THEN 'old' ELSE 'new' END AS came FROM survey")
def indexed_insert(spark, d):
    """The older half of the log stored, then all of it offered: the index lets only the newer half in."""
    path = scratch_path(spark, "events")
    log = D.survey(spark, d).select("event_id", "id_wilayah", "recorded_at")
    old = log.filter(F.col("recorded_at") <= F.lit(_MIDDLE_TS).cast("timestamp"))
    for rows, came in ((old, "old"), (log, "new")):
        idindex.insert_new(spark, path, f"{path}-ids", rows.withColumn("came", F.lit(came)), "event_id", came)
    return tables.read_table(spark, path).select("event_id", "id_wilayah", "came")


@lru_cache(maxsize=4)
def _wider(app: str, d: str) -> M.Lakehouse:
    """A log whose first append lacks an indicator and whose second has a column more, through silver and gold."""
    spark = SparkSession.active()
    lake = M.Lakehouse(scratch_path(spark, "lake"))
    tables.append_table(D.units(spark, d), lake.path(M.UNITS))
    log = D.survey(spark, d)
    older = F.col("recorded_at") <= F.lit(_MIDDLE_TS).cast("timestamp")
    tables.append_table(log.filter(older).drop("skor_jalan"), lake.path(M.SURVEY))
    M.bronze_to_silver(spark, lake)
    M.silver_to_gold(spark, lake)
    newer = log.filter(~older).withColumn("surveyor_app", F.concat(F.lit("v"), F.col("sosek_dominan")))
    tables.append_table(newer, lake.path(M.SURVEY))
    M.fold_events(spark, lake, newer)
    M.silver_to_gold(spark, lake, newer.select("id_wilayah").distinct())
    return lake


_WIDER_LOG = (
    "SELECT *, CASE WHEN recorded_at > timestamp '2024-01-15 12:00:00' THEN 'v' || sosek_dominan END AS surveyor_app, "
    "CASE WHEN recorded_at > timestamp '2024-01-15 12:00:00' THEN risk_score "
    "ELSE risk_score - coalesce(skor_jalan, 0) / 21e0 * 100e0 END AS score FROM scored"
)


@query(
    "grown_schema_latest",
    "SELECT id_wilayah, event_id, round(score, 6) AS risk_score, surveyor_app FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY id_wilayah ORDER BY recorded_at DESC, event_id DESC) AS rn FROM ({_WIDER_LOG}) w) t WHERE rn = 1",
)
def grown_schema_latest(spark, d):
    """The snapshot in gold keeps the column that joined the log later."""
    stored = _read(spark, _wider(spark.sparkContext.applicationId, d), M.RISK)
    return rounded(stored.select("id_wilayah", "event_id", "risk_score", "surveyor_app"), "risk_score")


@query("grown_schema_history", f"SELECT event_id, round(score, 6) AS risk_score_saat_itu, surveyor_app FROM ({_WIDER_LOG}) w")
def grown_schema_history(spark, d):
    stored = _read(spark, _wider(spark.sparkContext.applicationId, d), M.HISTORY)
    return rounded(stored.select("event_id", "risk_score_saat_itu", "surveyor_app"), "risk_score_saat_itu")


@query("keyed_survey_ids", f"SELECT {_UUID} AS event_id, id_wilayah FROM (SELECT id_wilayah, {_named(chr(39) + 'survey:form ' + chr(39) + ' || event_id')} AS h FROM survey) t")
def keyed_survey_ids(spark, d):
    """Every survey sent twice under one key, the second time with another note: one event each."""
    out, checkpoint, folder = scratch_path(spark, "unique"), scratch_path(spark, "checkpoint"), scratch_path(spark, "messages")
    keyed = D.survey(spark, d).withColumn("idempotency_key", F.concat(F.lit("form "), F.col("event_id"))).drop("event_id")
    for note in ("first", "second"):
        said = keyed.withColumn("catatan", F.lit(note))
        said.select(F.to_json(F.struct(*said.columns), JSON_OPTIONS).alias("value")).write.mode("append").text(folder)
        good, _ = ingest.split_corrupt(files.read_events(spark, folder, schemas.SURVEY), schemas.SURVEY)
        writer = ingest.typed_survey(good).writeStream.foreachBatch(ingest.unique_sink(spark, out))
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return tables.read_table(spark, out).select("event_id", "id_wilayah")


_ROW_OF = "row_number() OVER (ORDER BY id_wilayah, batch_id) - 1"


@query(
    "keyed_secondary_ids",
    f"SELECT {_UUID} AS batch_id, id_wilayah, label_kumuh FROM (SELECT id_wilayah, label_kumuh, "
    f"{_named(chr(39) + 'secondary:upload 7:' + chr(39) + ' || cast(row_no AS varchar)')} AS h FROM "
    f"(SELECT *, {_ROW_OF} AS row_no FROM labels_all) r) t",
)
def keyed_secondary_ids(spark, d):
    """A label file uploaded under a key: ids from the key and the row's place in the file."""
    path = scratch_path(spark, "upload")
    rows = D.ground_truth(spark, d).orderBy("id_wilayah", "batch_id").select("id_wilayah", "label_kumuh", "sumber_label", "tanggal_label")
    rows.coalesce(1).write.csv(path, header=True)
    return files.read_secondary_csv(spark, path, "ground_truth", "upload 7").select("batch_id", "id_wilayah", "label_kumuh")


@query(
    "stream_strict",
    f"SELECT event_id, id_wilayah FROM survey WHERE {' AND '.join(f'{c} IS NOT NULL' for c in V.INDICATORS)}",
)
def stream_strict(spark, d):
    """Strict intake: surveys that lack a score are turned away."""
    folder = scratch_path(spark, "messages")
    log = D.survey(spark, d)
    log.select(F.to_json(F.struct(*log.columns), JSON_OPTIONS).alias("value")).write.text(folder)
    stored, _ = _consume(spark, folder, strict=True)
    return stored.select("event_id", "id_wilayah")


@query("clusters_kept", "SELECT id_wilayah, true AS nearest FROM placed")
def clusters_kept(spark, d):
    """After an incremental run every unit, scored by the stored centres, is in the nearest one's cluster."""
    lake = grown_lake(spark, d)
    units = _read(spark, lake, M.RISK)
    far = farther_than_nearest(units, Clusters(_read(spark, lake, M.CLUSTER_MODEL))).select("id_wilayah")
    judged = units.join(shuffled(far.withColumn("far", F.lit(True))), "id_wilayah", "left")
    return judged.select("id_wilayah", (F.col("far").isNull() & F.col("cluster_id").isNotNull()).alias("nearest"))


@query("folded_latest", _LATEST_SQL)
def folded_latest(spark, d):
    """The newer half of the log folded in two batches, the later one first."""
    return _latest(spark, _in_batches(spark.sparkContext.applicationId, d))


@query("folded_history", "SELECT event_id, id_wilayah, recorded_at FROM survey")
def folded_history(spark, d):
    lake = _in_batches(spark.sparkContext.applicationId, d)
    return _read(spark, lake, M.HISTORY).select("event_id", "id_wilayah", "recorded_at")


@lru_cache(maxsize=4)
def _in_batches(app: str, d: str) -> M.Lakehouse:
    spark = SparkSession.active()
    lake = M.Lakehouse(scratch_path(spark, "lake"))
    tables.append_table(D.units(spark, d), lake.path(M.UNITS))
    log = D.survey(spark, d)
    at = F.col("recorded_at")
    first, last = F.lit(_MIDDLE_TS).cast("timestamp"), F.lit("2024-01-25 00:00:00").cast("timestamp")
    tables.append_table(log.filter(at <= first), lake.path(M.SURVEY))
    M.bronze_to_silver(spark, lake)
    for batch in (log.filter(at > last), log.filter((at > first) & (at <= last))):
        M.fold_events(spark, lake, batch)
    return lake
