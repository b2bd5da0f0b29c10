"""Message streams into bronze, and bronze batches into silver and gold."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from lakerisk import schemas
from lakerisk import vocabulary as V
from lakerisk.functions.text import JSON_OPTIONS, NAMESPACE_URL, parse_ts, uuid5
from lakerisk.operators.history import latest_per_key
from lakerisk.operators.joins import affected_ids
from lakerisk.operators.quality import conform_secondary, conform_survey
from lakerisk.plans import medallion as M
from lakerisk.sources import idindex, tables

CORRUPT = "_corrupt_record"
BATCH = "ingest_batch"


def _bad_value(name: str, data_type: T.DataType) -> Column:
    """Reason text when a field is present but not of its type."""
    text = F.col(name)
    parsed = parse_ts(text) if isinstance(data_type, T.TimestampType) else text.try_cast(data_type)
    return F.when(text.isNotNull() & parsed.isNull(), F.lit(f"{name} is not {data_type.simpleString()}"))


def message_reasons(table: T.StructType, required: tuple[str, ...]) -> Column:
    """What is wrong with a message: broken JSON, absent required or mistyped fields, scores outside 0..3."""
    checks = [F.when(F.col(CORRUPT).isNotNull(), F.lit("not JSON"))]
    checks += [F.when(F.col(CORRUPT).isNull() & F.col(n).isNull(), F.lit(f"{n} missing")) for n in required]
    checks += [_bad_value(f.name, f.dataType) for f in table if not isinstance(f.dataType, T.StringType)]
    for field in table:
        if field.name in V.INDICATORS:
            inside = F.col(field.name).try_cast("int").between(0, V.MAX_INDICATOR_SCORE)
            checks.append(F.when(~inside, F.lit(f"{field.name} out of range")))
    return F.array_compact(F.array(*checks))


def split_corrupt(
    messages: DataFrame, table: T.StructType, required: tuple[str, ...] = ("id_wilayah",)
) -> tuple[DataFrame, DataFrame]:
    """(good messages, rejected messages as raw text with reasons)"""
    fields = [*table.fieldNames(), *[c for c in schemas.MESSAGE_KEYS if c in messages.columns]]
    checked = messages.withColumn("reasons", message_reasons(table, required))
    good = checked.filter(F.size("reasons") == 0).select(*fields)
    raw = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*fields)))
    return good, checked.filter(F.size("reasons") > 0).select(raw.alias("message"), "reasons")


def _keyed(good: DataFrame, name: str, parts: tuple[str, ...], content: Column) -> Column:
    """Name an id is made of: the sender's key where the message has one, else the content."""
    if not set(parts) <= set(good.columns):
        return content
    key = F.nullif(F.col(parts[0]), F.lit(""))
    more = [F.concat(F.lit(":"), F.col(c)) for c in parts[1:]]
    return F.coalesce(F.concat(F.lit(f"{name}:"), key, *more), content)


def typed_survey(good: DataFrame) -> DataFrame:
    """Survey rows. A message without an id gets one from its idempotency_key, so that a second try gets
    the same whatever else it says, or else from its content; one without a time is taken as recorded now."""
    content = F.concat(F.lit("survey:"), F.to_json(F.struct(*schemas.SURVEY.fieldNames())))
    name = _keyed(good, "survey", ("idempotency_key",), content)
    return conform_survey(
        good.withColumns(
            {
                "event_id": F.coalesce("event_id", uuid5(NAMESPACE_URL, name)),
                "recorded_at": F.coalesce(parse_ts(F.col("recorded_at")), F.current_timestamp()),
            }
        )
    )


def typed_secondary(good: DataFrame) -> DataFrame:
    """Secondary rows with the sender's time kept as accepted_at and the reading time as ingested_at.

    A row without a batch_id gets one from the upload's idempotency_key and the row_number in it
    (from 0), or else from its content."""
    said = [c for c in good.columns if c not in ("raw_data", "accepted_at", *schemas.MESSAGE_KEYS)]
    raw = good.withColumn("raw_data", F.to_json(F.struct(*said), JSON_OPTIONS))
    name = _keyed(good, "secondary", schemas.MESSAGE_KEYS, F.concat(F.lit("secondary:"), F.col("raw_data")))
    return conform_secondary(
        raw.withColumns(
            {
                "batch_id": F.coalesce("batch_id", uuid5(NAMESPACE_URL, name)),
                "source_type": F.coalesce("source_type", F.lit("unknown")),
                "accepted_at": F.col("ingested_at"),
                "ingested_at": F.current_timestamp(),
            }
        )
    )


def unique_sink(spark: SparkSession, path: str, key: str = "event_id") -> Callable[[DataFrame, int], None]:
    """foreachBatch function: insert events whose key the table does not hold.

    However late an event or its repetition arrives, the event is kept and the
    repetition is not; a batch that is run again inserts nothing twice. The index beside
    the table says which keys it holds, so batches of new events read none of it.
    """

    def insert(batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(batch, key, ("recorded_at",))
        idindex.insert_new(spark, path, f"{path}-ids", rows, key, _batch_name(spark, batch_id))

    return insert


def _start(writer: DataStreamWriter, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Continuous micro-batches every ``interval``, or with None one pass over what is there."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def stream_to_bronze(
    messages: DataFrame,
    table: T.StructType,
    typed: Callable[[DataFrame], DataFrame],
    out: str,
    quarantine: str,
    checkpoint: str,
    interval: str | None = None,
    strict: bool = False,
) -> list[StreamingQuery]:
    """Good rows to bronze, rejected messages to quarantine, each micro-batch in a folder of its
    own that a repeated batch replaces. Files that batch loads and other streams wrote there
    stay, and stay readable. ``strict`` asks surveys for all scores."""
    good, bad = split_corrupt(messages, table, _required(table, strict))

    def into(path: str) -> Callable[[DataFrame, int], None]:
        return lambda batch, batch_id: _store_batch(batch.sparkSession, batch, path, batch_id) and None

    return [
        _start(typed(good).writeStream.foreachBatch(into(out)), f"{checkpoint}/bronze", interval),
        _start(bad.writeStream.foreachBatch(into(quarantine)), f"{checkpoint}/quarantine", interval),
    ]


def _required(table: T.StructType, strict: bool = False) -> tuple[str, ...]:
    if table != schemas.SURVEY:
        return ()
    return ("id_wilayah", *V.INDICATORS) if strict else ("id_wilayah",)


def _batch_name(spark: SparkSession, batch_id: int) -> str:
    """Names a micro-batch among those of all streams: batch ids start at 0 with each checkpoint,
    and the query id lasts as long as the checkpoint. Outside a stream there is only the number.
    Inside foreachBatch the query id is a property of the calling thread (PySpark pins threads by default)."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}" if query else str(batch_id)


def _store_batch(spark: SparkSession, rows: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Write a micro-batch as its own partition and read it back. A repeated
    batch replaces its partition instead of adding rows twice."""
    name = _batch_name(spark, batch_id)
    stamped = rows.withColumn(BATCH, F.lit(name))
    tables.record_schema(rows, path)
    writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BATCH).parquet(path)
    schema = T.StructType([*rows.schema.fields, T.StructField(BATCH, T.StringType())])
    stored = spark.read.schema(schema).parquet(path)
    return stored.filter(F.col(BATCH) == name).drop(BATCH)


def affected_keys(batch: DataFrame) -> DataFrame:
    return affected_ids(batch)


def needs_training(batch: DataFrame) -> bool:
    """New labels ask for a new model; surveys and other secondary rows do not."""
    return not batch.filter(F.col("source_type") == "ground_truth").isEmpty()


def survey_refresh(spark: SparkSession, lake: M.Lakehouse, load_model: Callable = lambda: None, strict: bool = False):
    """foreachBatch function: store a micro-batch of surveys, then refresh its units.

    The batch is folded into the stored silver tables, so a late event enters the history
    without displacing a newer snapshot, and nothing but the batch is read of the log. ``strict``
    turns away surveys that lack a score.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_corrupt(batch, schemas.SURVEY, _required(schemas.SURVEY, strict))
        _store_batch(spark, bad, lake.path("bronze/survey_rejects"), batch_id)
        stored = _store_batch(spark, typed_survey(good), lake.path(M.SURVEY), batch_id)
        keys = affected_keys(stored)
        if keys.isEmpty():
            return
        M.fold_events(spark, lake, stored, _batch_name(spark, batch_id))
        M.silver_to_gold(spark, lake, keys, load_model())

    return refresh


def secondary_refresh(spark: SparkSession, lake: M.Lakehouse, train: bool = True):
    """foreachBatch function: store secondary rows; new labels retrain and rescore everything."""

    def refresh(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_corrupt(batch, schemas.SECONDARY, required=())
        _store_batch(spark, bad, lake.path("bronze/secondary_rejects"), batch_id)
        stored = _store_batch(spark, typed_secondary(good), lake.path(M.SECONDARY), batch_id)
        if needs_training(stored):
            M.refresh_ground_truth(spark, lake, affected_keys(stored))
            model = M.train(spark, lake) if train else None
            M.silver_to_gold(spark, lake, model=model)

    return refresh


def start_refresh(
    messages: DataFrame, refresh: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = "2 seconds"
) -> StreamingQuery:
    """Run a refresh function per micro-batch. Messages that arrive within one
    interval are refreshed together, as the union of their units."""
    return _start(messages.writeStream.foreachBatch(refresh), checkpoint, interval)
