"""Streaming queries: the log as JSON messages, consumed to the end."""

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk import schemas
from lakerisk.functions.text import JSON_OPTIONS
from lakerisk.plans import domain as D
from lakerisk.plans import medallion as M
from lakerisk.plans.catalog.history import redelivered
from lakerisk.plans.catalog.lake import _FEATURES_SQL, _GOLD_SQL, _LATEST_SQL, _features, _gold_table, _latest, bronze
from lakerisk.plans.catalog.registry import query
from lakerisk.session import scratch_path
from lakerisk.sources import files, tables
from lakerisk.streaming import ingest


def _publish(rows: DataFrame, text: Column | None = None) -> str:
    """Write rows as JSON-lines messages and return the folder."""
    path = scratch_path(rows.sparkSession, "messages")
    message = F.to_json(F.struct(*rows.columns), JSON_OPTIONS) if text is None else text
    rows.select(message.alias("value")).write.text(path)
    return path


def _consume(spark: SparkSession, folder: str, table=schemas.SURVEY, typed=ingest.typed_survey, strict=False) -> tuple[DataFrame, DataFrame]:
    """(bronze rows, quarantine) after the stream has read the whole folder."""
    out = scratch_path(spark, "bronze")
    bad = scratch_path(spark, "quarantine")
    messages = files.read_events(spark, folder, table)
    for running in ingest.stream_to_bronze(messages, table, typed, out, bad, scratch_path(spark, "checkpoint"), strict=strict):
        running.awaitTermination()
    schema = typed(spark.createDataFrame([], schemas.message_schema(table))).schema
    return spark.read.schema(schema).parquet(out), spark.read.schema("message STRING, reasons ARRAY<STRING>").parquet(bad)


@query(
    "stream_bronze",
    "SELECT event_id, id_wilayah, recorded_at, coalesce(skor_bangunan, 0) AS skor_bangunan, pernah_banjir, sosek_dominan FROM survey",
)
def stream_bronze(spark, d):
    stored, _ = _consume(spark, _publish(D.survey(spark, d)))
    return stored.select("event_id", "id_wilayah", "recorded_at", "skor_bangunan", "pernah_banjir", "sosek_dominan")


@query("stream_secondary", "SELECT batch_id, source_type, id_wilayah, label_kumuh, sumber_label FROM labels_all")
def stream_secondary(spark, d):
    folder = _publish(D.ground_truth(spark, d))
    stored, _ = _consume(spark, folder, schemas.SECONDARY, ingest.typed_secondary)
    return stored.select("batch_id", "source_type", "id_wilayah", "label_kumuh", "sumber_label")


@query(
    "stream_quarantine",
    "SELECT CASE recorded_by WHEN 'view' THEN 'not JSON' WHEN 'error' THEN 'skor_jalan out of range' ELSE 'jumlah_kk is not int' END "
    "AS reason, count(*) AS n_messages FROM survey WHERE recorded_by IN ('view', 'error', 'click') GROUP BY 1",
)
def stream_quarantine(spark, d):
    """Messages damaged by kind of event; the undamaged ones pass."""
    kind = F.col("recorded_by")
    damaged = D.survey(spark, d).withColumns(
        {
            "skor_jalan": F.when(kind == "error", F.lit(9)).otherwise(F.col("skor_jalan")),
            "jumlah_kk": F.when(kind == "click", F.lit("many")).otherwise(F.col("jumlah_kk").cast("string")),
        }
    )
    text = F.to_json(F.struct(*damaged.columns), JSON_OPTIONS)
    _, bad = _consume(spark, _publish(damaged, F.when(kind == "view", F.concat(F.lit("<"), text)).otherwise(text)))
    return bad.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_messages"))


@query("stream_dedup", "SELECT event_id, id_wilayah FROM survey")
def stream_dedup(spark, d):
    """Every event delivered three times, the older half of the log last; one of each is kept."""
    out, checkpoint, folder = scratch_path(spark, "unique"), scratch_path(spark, "checkpoint"), scratch_path(spark, "messages")
    log = redelivered(spark, d)
    middle = F.lit("2024-01-15 12:00:00").cast("timestamp")
    for delivery in (log.filter(F.col("recorded_at") > middle), log.filter(F.col("recorded_at") <= middle)):
        delivery.select(F.to_json(F.struct(*delivery.columns), JSON_OPTIONS).alias("value")).write.mode("append").text(folder)
        good, _ = ingest.split_corrupt(files.read_events(spark, folder, schemas.SURVEY), schemas.SURVEY)
        writer = ingest.typed_survey(good).writeStream.foreachBatch(ingest.unique_sink(spark, out))
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schemas.SURVEY).parquet(out).select("event_id", "id_wilayah")


@query("mixed_bronze_latest", _LATEST_SQL)
def mixed_bronze_latest(spark, d):
    """Newer half of the log by batch and a full run, the older half by stream, then another full run."""
    return _latest(spark, mixed_lake(spark, d))


@query("mixed_bronze_history", "SELECT event_id, id_wilayah, recorded_at FROM survey")
def mixed_bronze_history(spark, d):
    return tables.read_table(spark, mixed_lake(spark, d).path(M.HISTORY)).select("event_id", "id_wilayah", "recorded_at")


def mixed_lake(spark, d):
    return _mixed(spark.sparkContext.applicationId, d)


@lru_cache(maxsize=4)
def _mixed(app: str, d: str) -> M.Lakehouse:
    spark = SparkSession.active()
    lake = M.Lakehouse(scratch_path(spark, "lake"))
    tables.append_table(D.units(spark, d), lake.path(M.UNITS))
    log = D.survey(spark, d)
    middle = F.lit("2024-01-15 12:00:00").cast("timestamp")
    tables.append_table(log.filter(F.col("recorded_at") > middle), lake.path(M.SURVEY))
    M.bronze_to_silver(spark, lake)
    messages = files.read_events(spark, _publish(log.filter(F.col("recorded_at") <= middle)), schemas.SURVEY)
    ingest.start_refresh(messages, ingest.survey_refresh(spark, lake), scratch_path(spark, "checkpoint"), interval=None).awaitTermination()
    M.bronze_to_silver(spark, lake)
    return lake


@lru_cache(maxsize=4)
def _streamed(app: str, d: str) -> M.Lakehouse:
    """A lakehouse fed only by streams: the survey log in two deliveries, late
    events last, each refreshing the units it touches."""
    spark = SparkSession.active()
    lake = M.Lakehouse(scratch_path(spark, "lake"))
    tables.append_table(D.units(spark, d), lake.path(M.UNITS))
    log = D.survey(spark, d)
    middle = F.lit("2024-01-15 12:00:00").cast("timestamp")
    checkpoint = scratch_path(spark, "checkpoint")
    folder = scratch_path(spark, "messages")
    for delivery in (log.filter(F.col("recorded_at") > middle), log.filter(F.col("recorded_at") <= middle)):
        message = F.to_json(F.struct(*delivery.columns), JSON_OPTIONS).alias("value")
        delivery.select(message).write.mode("append").text(folder)
        messages = files.read_events(spark, folder, schemas.SURVEY)
        ingest.start_refresh(messages, ingest.survey_refresh(spark, lake), checkpoint, interval=None).awaitTermination()
    return lake


def streamed_lake(spark, d):
    return _streamed(spark.sparkContext.applicationId, d)


# Answers missing from a message count as 0, so scores equal those of the log.


@query("stream_incremental_latest", _LATEST_SQL)
def stream_incremental_latest(spark, d):
    return _latest(spark, streamed_lake(spark, d))


@query("stream_incremental_history", "SELECT event_id, id_wilayah, recorded_at FROM survey")
def stream_incremental_history(spark, d):
    stored = tables.read_table(spark, streamed_lake(spark, d).path(M.HISTORY))
    return stored.select("event_id", "id_wilayah", "recorded_at")


@query("stream_incremental_gold", _GOLD_SQL)
def stream_incremental_gold(spark, d):
    return _gold_table(spark, streamed_lake(spark, d))
