"""Batch runs over the lakehouse layers: bronze -> silver, training, silver -> gold."""

from dataclasses import dataclass
from typing import Literal

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk import schemas
from lakerisk import vocabulary as V
from lakerisk.operators import features, geo, history, ml, ranking, scoring, unit_state
from lakerisk.operators.clusters import Clusters, model_table
from lakerisk.operators.joins import register_units, scope_by_area, scope_by_keys, shuffled
from lakerisk.operators.upsert import upsert
from lakerisk.sources import idindex, tables

AREA_PARTITION = ("kelurahan",)
UNIT_ORDER = ("id_wilayah", "recorded_at")


@dataclass(frozen=True)
class Lakehouse:
    """Table locations under one root folder."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def models(self) -> str:
        return self.path("models")


SURVEY, UNITS, SECONDARY = "bronze/survey_events", "bronze/master_wilayah", "bronze/secondary_sources"
HISTORY, LATEST, FEATURES = "silver/event_history", "silver/latest_indicators", "silver/feature_matrix"
UNIT_MAP, UNIT_STATE, EVENT_IDS = "silver/unit_map", "silver/unit_state", "silver/event_ids"
GROUND_TRUTH, POPULATION, METRICS = "silver/ground_truth", "silver/population", "silver/model_metrics"
RISK, PREDICTION, TREND = "gold/slum_risk_score", "gold/slum_prediction", "gold/slum_trend"
FACTORS, PRIORITY = "gold/dominant_factors", "gold/intervention_priority"
CLUSTERS, FORECAST, CLUSTER_MODEL = "gold/slum_clusters", "gold/slum_forecast", "gold/cluster_model"

FACTOR_COLUMNS = [f"{kind}_{i}" for kind in ("top_faktor", "skor_faktor") for i in (1, 2, 3)]
PRIORITY_COLUMNS = [
    "prioritas_rank",
    "id_wilayah",
    *V.AREA_KEYS,
    "risk_score",
    "risk_level",
    "label_prediksi",
    "proba_kumuh",
    "jiwa_terdampak",
    "top_faktor_1",
    "top_faktor_2",
    "top_faktor_3",
    "cluster_id",
    "cluster_rank",
    "cluster_label",
    "last_updated",
]


def _exists(spark: SparkSession, lake: Lakehouse, *names: str) -> bool:
    return all(tables.table_exists(spark, lake.path(n)) for n in names)


def _read(spark: SparkSession, lake: Lakehouse, name: str) -> DataFrame:
    return tables.read_table(spark, lake.path(name), text=AREA_PARTITION)


def _units(spark: SparkSession, lake: Lakehouse) -> DataFrame | None:
    return _read(spark, lake, UNITS) if _exists(spark, lake, UNITS) else None


def register(spark: SparkSession, lake: Lakehouse, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add new units to the registry and its map; returns (already registered, bad geometry).

    Units with a geometry text that is not a usable GeoJSON are turned away;
    units without one are registered and stay off the map.
    """
    offered = tables.staged(spark, geo.normalize_geometry(incoming), "offered")
    bad = F.col("geometry_error").isNotNull() & (F.col("geometry_error") != "missing")
    usable = offered.filter(~F.coalesce(bad, F.lit(False)))
    known = tables.read_optional(spark, lake.path(UNITS), T.StructType([incoming.schema["id_wilayah"]]))
    new, again = register_units(known, usable)
    new, again = tables.staged(spark, new, "new"), tables.staged(spark, again, "again")
    tables.append_table(new, lake.path(UNIT_MAP))
    tables.append_table(new.select(*incoming.columns).withColumn("created_at", F.current_timestamp()), lake.path(UNITS))
    return again.select(*incoming.columns), offered.filter(bad).select(*incoming.columns, "geometry_error")


def survey_log(spark: SparkSession, lake: Lakehouse) -> DataFrame:
    return tables.read_log(spark, lake.path(SURVEY), schemas.SURVEY)


def history_or_log(spark: SparkSession, lake: Lakehouse) -> DataFrame:
    """The scored history, or the raw log while no silver run has happened."""
    return _read(spark, lake, HISTORY) if _exists(spark, lake, HISTORY) else survey_log(spark, lake)


def event_history(events: DataFrame, units: DataFrame | None) -> DataFrame:
    """Deduplicated log with place names and the score at the time of each event."""
    return scoring.score_and_level(features.enrich_events(history.dedup_events(events), units, log=events), "_saat_itu")


def latest_with_place(events: DataFrame, units: DataFrame | None) -> DataFrame:
    """Latest snapshot from the raw log, reduced to one row per unit before the registry is joined."""
    return with_geometry(features.enrich_events(history.latest_indicators(events), units), units)


def latest_of_history(past: DataFrame, units: DataFrame | None) -> DataFrame:
    """Latest snapshot from the scored history."""
    renamed = {"risk_score_saat_itu": "risk_score", "risk_level_saat_itu": "risk_level"}
    return with_geometry(history.latest_per_key(past).withColumnsRenamed(renamed), units)


def with_geometry(latest: DataFrame, units: DataFrame | None) -> DataFrame:
    if units is None or "geometry_wkt" not in units.columns:
        return latest
    return latest.join(shuffled(units.select("id_wilayah", "geometry_wkt")), "id_wilayah", "left")


def refresh_ground_truth(spark: SparkSession, lake: Lakehouse, keys: DataFrame | None = None) -> None:
    if not _exists(spark, lake, SECONDARY):
        return
    secondary = tables.read_log(spark, lake.path(SECONDARY), schemas.SECONDARY)
    labels = history.latest_ground_truth(scope_by_keys(secondary, keys))
    if keys is None:
        if not labels.isEmpty():
            tables.write_table(labels, lake.path(GROUND_TRUTH))
    else:
        tables.merge_table(spark, lake.path(GROUND_TRUTH), labels, ["id_wilayah"], unique_source=True)


def bronze_to_silver(
    spark: SparkSession, lake: Lakehouse, keys: DataFrame | None = None, labels_changed: bool = False
) -> None:
    """Rebuild the silver tables, or with ``keys`` only what those units touch."""
    if not _exists(spark, lake, SURVEY):
        if labels_changed:
            refresh_ground_truth(spark, lake)
        return
    incremental = keys is not None and _folds(spark, lake)
    scope = keys if incremental else None
    units = _units(spark, lake)
    past = event_history(scope_by_keys(survey_log(spark, lake), scope), units)

    if not incremental:
        tables.write_table(past, lake.path(HISTORY), AREA_PARTITION, UNIT_ORDER)
        stored = _read(spark, lake, HISTORY)

        def snapshot() -> None:
            tables.write_table(latest_of_history(stored, units), lake.path(LATEST), AREA_PARTITION, UNIT_ORDER)
            tables.write_table(features.feature_matrix(_read(spark, lake, LATEST)), lake.path(FEATURES))

        def places() -> None:
            tables.write_table(features.population(units), lake.path(POPULATION))
            geo.unit_map(units).write.mode("overwrite").parquet(lake.path(UNIT_MAP))

        tables.together(
            snapshot,
            lambda: tables.write_table(_stamped(unit_state.event_state(stored)), lake.path(UNIT_STATE)),
            lambda: idindex.build(spark, lake.path(EVENT_IDS), stored.select("event_id")),
            lambda: refresh_ground_truth(spark, lake),
            *([places] if units is not None else []),
        )
        return

    past = tables.staged(spark, past, "history")
    before = scope_by_keys(_read(spark, lake, LATEST), scope)
    tables.merge_table(spark, lake.path(HISTORY), past, ["event_id"], update_matches=False, **HISTORY_LAYOUT)
    _merge_latest(spark, lake, latest_of_history(past, units), before)
    tables.merge_table(
        spark, lake.path(UNIT_STATE), _stamped(unit_state.event_state(past)), ["id_wilayah"], null_safe=True, unique_source=True
    )
    ids = past.select("event_id").filter(F.col("event_id").isNotNull())
    known = idindex.find(spark, lake.path(EVENT_IDS), ids)
    if known is not None:
        ids = tables.staged(spark, ids.join(shuffled(known.select(F.col("id").alias("event_id"))), "event_id", "left_anti"), "ids")
    idindex.add(spark, lake.path(EVENT_IDS), ids)
    if labels_changed:
        refresh_ground_truth(spark, lake)


# A unit's rows leave the NULL area when it is registered and never move again.
HISTORY_LAYOUT = {"partition_cols": AREA_PARTITION, "sort_cols": UNIT_ORDER, "keys_move": False}


def _folds(spark: SparkSession, lake: Lakehouse) -> bool:
    """Whether a full silver run has left all that an incremental one builds on."""
    return _exists(spark, lake, HISTORY, LATEST, FEATURES, UNIT_STATE) and idindex.exists(spark, lake.path(EVENT_IDS))


def _stamped(state: DataFrame, batch: str | None = None) -> DataFrame:
    """Unit states with the name of the batch folded in last."""
    return state.withColumn("folded", F.lit(batch).cast("string"))


def _merge_latest(spark: SparkSession, lake: Lakehouse, latest: DataFrame, before: DataFrame) -> None:
    """Store new snapshots and the features of the areas their units are in or were in (``before``)."""
    was = before.select("id_wilayah", *[F.col(c).alias(f"_was_{c}") for c in V.AREA_KEYS])
    moved = tables.staged(spark, latest.join(shuffled(was), "id_wilayah", "left"), "latest")
    latest = moved.drop(*was.columns[1:])
    touched = latest.select(*V.AREA_KEYS).unionByName(moved.select(*[F.col(f"_was_{c}").alias(c) for c in V.AREA_KEYS])).distinct()
    tables.merge_table(spark, lake.path(LATEST), latest, ["id_wilayah"], unique_source=True, stored_source=True, **HISTORY_LAYOUT)
    matrix = features.feature_matrix(scope_by_area(_read(spark, lake, LATEST), touched))
    tables.merge_table(spark, lake.path(FEATURES), matrix, list(V.AREA_KEYS), null_safe=True, unique_source=True)


def fold_events(spark: SparkSession, lake: Lakehouse, events: DataFrame, batch: str | None = None) -> None:
    """Bring the silver tables up to date with a batch of the log, reading neither the log nor the history.

    Events whose id the history holds, by the id index, change nothing. New ones are appended
    to it, and the stored snapshots and states of their units are merged with the batch's own; late
    events count in the state and leave newer snapshots alone. A call repeated after a failure
    under the same ``batch`` name goes on where the first one ended. Batches are folded one at a
    time. Without stored silver tables this is a full run over the log.
    """
    if not _folds(spark, lake):
        bronze_to_silver(spark, lake)
        return
    units = _units(spark, lake)
    rows = history.dedup_events(events)
    scored = tables.staged(spark, scoring.score_and_level(features.enrich_events(rows, units), "_saat_itu"), "batch")
    batch = batch or idindex.name_of(scored, "event_id")
    fresh = idindex.insert_new(spark, lake.path(HISTORY), lake.path(EVENT_IDS), scored, "event_id", batch, AREA_PARTITION, UNIT_ORDER, stored_rows=True)
    if fresh.isEmpty():
        return
    raw = rows.columns

    def snapshot() -> None:
        stored = scope_by_keys(_read(spark, lake, LATEST), fresh)
        both = fresh.select(*raw).unionByName(stored.select(*scoring.present(stored, raw)), allowMissingColumns=True)
        _merge_latest(spark, lake, latest_with_place(both, units), stored)

    def state() -> None:
        states = _read(spark, lake, UNIT_STATE)
        todo = fresh.join(shuffled(states.filter(F.col("folded") == batch)), "id_wilayah", "left_anti")
        merged = unit_state.merge_state(scope_by_keys(states, todo), unit_state.event_state(todo))
        tables.merge_table(spark, lake.path(UNIT_STATE), _stamped(merged, batch), ["id_wilayah"], null_safe=True, unique_source=True)

    tables.together(snapshot, state)


def train(
    spark: SparkSession, lake: Lakehouse, trees: int = 8, depth: int = 3, folds: int = 3
) -> PipelineModel | None:
    """Fit, evaluate, save and record a model; None when no labelled unit was surveyed."""
    if not _exists(spark, lake, LATEST, GROUND_TRUTH):
        return None
    rows = features.training_set(_read(spark, lake, LATEST), _read(spark, lake, GROUND_TRUTH)).persist()
    try:
        total = rows.count()
        if total == 0:
            return None
        train_rows, test_rows = ml.train_test_split(rows, total)
        pipeline = ml.rf_pipeline(trees, depth)
        search = ml.fit_cv(pipeline, train_rows, folds)
        model = search.bestModel if search else pipeline.fit(train_rows)
        version = ml.new_version(spark)
        record = ml.metrics_row(
            spark,
            ml.evaluate(ml.predictions(model, test_rows)),
            ml.feature_importance(spark, model),
            model,
            version,
            ml.save_model(model, lake.models, version),
            train_rows.count(),
            test_rows.count(),
            ml.cv_summary(search) if search else None,
            folds,
        )
        tables.append_table(record, lake.path(METRICS))
        return model
    finally:
        rows.unpersist()


def attach_unit_geometry(scored: DataFrame, units: DataFrame | None) -> DataFrame:
    """geometry_wkt and jiwa_terdampak of the unit; without a registry the stored population, else 0."""
    if units is not None:
        place = units.select("id_wilayah", "geometry_wkt", F.col("total_jiwa").alias("jiwa_terdampak"))
        return scored.drop("geometry_wkt", "jiwa_terdampak").join(shuffled(place), "id_wilayah", "left")
    people = F.col("total_jiwa") if "total_jiwa" in scored.columns else F.lit(0)
    return scored.drop("total_jiwa").withColumns({"geometry_wkt": F.lit(""), "jiwa_terdampak": people.cast("long")})


def attach_predictions(scored: DataFrame, model: PipelineModel | None) -> DataFrame:
    return ml.score(model, scored)


def gold_units(latest: DataFrame, units: DataFrame | None, model: PipelineModel | None = None) -> DataFrame:
    """Per-unit gold columns that depend on nothing but the unit itself."""
    scored = scoring.score_and_level(latest.drop("risk_score", "risk_level"))
    placed = attach_unit_geometry(attach_predictions(scored, model), units)
    return scoring.priority_score(scoring.dominant_factors(placed))


def silver_to_gold(
    spark: SparkSession,
    lake: Lakehouse,
    keys: DataFrame | None = None,
    model: PipelineModel | Literal["rule"] | None = None,
    k: int = 4,
) -> None:
    """Rebuild the gold tables; with ``keys`` the per-unit parts of only those units.

    Without a model the latest stored one predicts, in full and incremental runs
    alike; the risk rule does only where none is stored or ``"rule"`` is asked for.
    The rank compares all units and is computed over all of them. Clusters are fitted in full runs,
    and in others once there are many more units; in between, changed units go to the
    nearest stored centre.
    """
    if not _exists(spark, lake, LATEST):
        return
    incremental = keys is not None and _exists(spark, lake, RISK, PREDICTION, TREND, FACTORS, PRIORITY)
    scope = keys if incremental else None
    if model is None:
        model = ml.stored_model(spark, lake.models)
    elif model == "rule":
        model = None
    units = _units(spark, lake)
    latest = _read(spark, lake, LATEST)

    kept = Clusters(_read(spark, lake, CLUSTER_MODEL)) if incremental and _exists(spark, lake, CLUSTER_MODEL) else None
    if kept is not None and kept.due(latest, k):
        kept = None
    fresh = gold_units(scope_by_keys(latest, scope), units, model).withColumn("last_updated", F.current_timestamp())
    if kept is not None:
        fresh = kept.assign(fresh)
    if incremental:
        fresh = upsert(_read(spark, lake, RISK).drop("prioritas_rank"), fresh, ["id_wilayah"])
    # Written once and read by every step below: ranking and the gold tables.
    base = tables.staged(spark, fresh, "gold_units")

    if kept is None:
        fitted = ml.fit_kmeans(latest, k)
        base = ml.attach_clusters(base, ml.label_clusters(fitted[1]) if fitted else None)
        if fitted:
            # Few rows, made before the table they may come from is replaced.
            tables.write_table(tables.staged(spark, model_table(*fitted), "clusters"), lake.path(CLUSTER_MODEL))
            kept = Clusters(_read(spark, lake, CLUSTER_MODEL))
    tables.write_table(ranking.priority_rank(base), lake.path(RISK), AREA_PARTITION, UNIT_ORDER)
    gold = _read(spark, lake, RISK)
    state = scope_by_keys(_read(spark, lake, UNIT_STATE), scope)

    def per_unit(name: str, rows: DataFrame) -> None:
        if incremental:
            tables.merge_table(spark, lake.path(name), rows, ["id_wilayah"], unique_source=True)
        else:
            tables.write_table(rows, lake.path(name))

    predicted = gold.select("id_wilayah", *V.AREA_KEYS, "label_prediksi", "proba_kumuh", "last_updated")
    jobs = [
        lambda: tables.write_table(predicted, lake.path(PREDICTION)),
        lambda: tables.write_table(gold.select("id_wilayah", *V.AREA_KEYS, *FACTOR_COLUMNS), lake.path(FACTORS)),
        lambda: tables.write_table(gold.select(*PRIORITY_COLUMNS), lake.path(PRIORITY)),
        lambda: per_unit(TREND, unit_state.trend_of(state)),
        lambda: per_unit(FORECAST, unit_state.forecast_of(state)),
    ]
    if kept is not None:
        jobs.append(lambda: tables.write_table(kept.summary(gold), lake.path(CLUSTERS)))
    tables.together(*jobs)
