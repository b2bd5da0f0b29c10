"""Queries that write tables and read them back: sinks, batch runs, models."""

from functools import lru_cache

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk import schemas
from lakerisk import vocabulary as V
from lakerisk.operators import history as h, ml, serving
from lakerisk.operators.features import training_set
from lakerisk.operators.geo import bbox_filter
from lakerisk.plans import domain as D
from lakerisk.plans import medallion as M
from lakerisk.plans.catalog.areas import _GOLD_COLS, _GOLD_NAMES, _MATRIX, _MATRIX_DOUBLES
from lakerisk.plans.catalog.geo import _VIEW_SQL, VIEW
from lakerisk.plans.catalog.history import _MIDDLE_TS
from lakerisk.plans.catalog.registry import gold, latest, pick, query, rounded
from lakerisk.session import scratch_path
from lakerisk.sources import files, tables


@query("optional_scan", "SELECT id_wilayah, kecamatan FROM units")
def optional_scan(spark, d):
    """A written table and a missing one, read the same way and united."""
    path = scratch_path(spark, "units")
    tables.write_table(D.units(spark, d), path)
    there = tables.read_optional(spark, path, schemas.UNITS)
    missing = tables.read_optional(spark, f"{path}-missing", schemas.UNITS)
    return there.unionByName(missing).select("id_wilayah", "kecamatan")


@query(
    "append_table",
    "SELECT event_id, CASE WHEN recorded_at > timestamp '2024-01-15 12:00:00' THEN sosek_dominan END AS sosek_dominan FROM survey",
)
def append_table(spark, d):
    """Two appends, the second with a column more; older rows read it as NULL."""
    path = scratch_path(spark, "log")
    log = D.survey(spark, d)
    middle = F.lit(_MIDDLE_TS).cast("timestamp")
    tables.append_table(log.filter(F.col("recorded_at") <= middle).select("event_id", "id_wilayah"), path)
    tables.append_table(log.filter(F.col("recorded_at") > middle).select("event_id", "id_wilayah", "sosek_dominan"), path)
    return tables.read_table(spark, path, merge_schema=True).select("event_id", "sosek_dominan")


@query("partitioned_table", "SELECT kelurahan, count(*) AS n_units FROM placed GROUP BY kelurahan")
def partitioned_table(spark, d):
    """Overwrite by kelurahan; a partition column the frame lacks is left out."""
    path = scratch_path(spark, "latest")
    tables.write_table(latest(spark, d), path, ("kelurahan", "absent"))
    return tables.read_table(spark, path).groupBy("kelurahan").agg(F.count(F.lit(1)).alias("n_units"))


@query("merged_table", "SELECT id_wilayah, event_id, kelurahan FROM placed")
def merged_table(spark, d):
    """Stored mid-month snapshot merged on disk with the newer rows, by touched partitions."""
    path = scratch_path(spark, "latest")
    log, units = D.survey(spark, d), D.units(spark, d)
    middle = F.lit(_MIDDLE_TS).cast("timestamp")
    older = M.latest_with_place(log.filter(F.col("recorded_at") <= middle), units)
    newer = M.latest_with_place(log.filter(F.col("recorded_at") > middle), units)
    tables.merge_table(spark, path, older, ["id_wilayah"], ("kelurahan",))
    tables.merge_table(spark, path, newer, ["id_wilayah"], ("kelurahan",))
    return tables.read_table(spark, path).select("id_wilayah", "event_id", "kelurahan")


@query("priority_csv", "SELECT id_wilayah, risk_level AS tingkat_risiko, cast(prioritas_rank AS varchar) AS peringkat FROM ranked")
def priority_csv(spark, d):
    """The CSV report written and read back."""
    path = scratch_path(spark, "report")
    lake = gold_lake(spark, d)
    files.write_priority_csv(tables.read_table(spark, lake.path(M.PRIORITY)), path)
    back = spark.read.option("header", True).csv(path)
    return back.select(
        F.col("ID Wilayah").alias("id_wilayah"), F.col("Tingkat Risiko").alias("tingkat_risiko"), F.col("Peringkat").alias("peringkat")
    )


def bronze(spark: SparkSession, d: str, events: DataFrame | None = None) -> M.Lakehouse:
    """A fresh lakehouse with the given tables as bronze."""
    lake = M.Lakehouse(scratch_path(spark, "lake"))
    tables.append_table(events if events is not None else D.survey(spark, d), lake.path(M.SURVEY))
    tables.append_table(D.units(spark, d), lake.path(M.UNITS))
    labels = tables.with_ingest_time(D.ground_truth(spark, d), "accepted_at")
    tables.append_table(labels, lake.path(M.SECONDARY))
    return lake


@lru_cache(maxsize=4)
def _silver(app: str, d: str) -> M.Lakehouse:
    spark = SparkSession.active()
    lake = bronze(spark, d)
    M.bronze_to_silver(spark, lake)
    return lake


def silver_lake(spark: SparkSession, d: str) -> M.Lakehouse:
    """Lakehouse after a full silver run, built once per session and data folder."""
    return _silver(spark.sparkContext.applicationId, d)


@lru_cache(maxsize=4)
def _gold(app: str, d: str) -> M.Lakehouse:
    spark = SparkSession.active()
    lake = silver_lake(spark, d)
    M.silver_to_gold(spark, lake)
    return lake


def gold_lake(spark: SparkSession, d: str) -> M.Lakehouse:
    """Lakehouse after a full gold run with the rule prediction."""
    return _gold(spark.sparkContext.applicationId, d)


@lru_cache(maxsize=4)
def _grown(app: str, d: str) -> M.Lakehouse:
    """A lakehouse first built from the log of mid-month, then refreshed for the
    units heard from since, as an incremental run does."""
    spark = SparkSession.active()
    middle = F.lit(_MIDDLE_TS).cast("timestamp")
    log = D.survey(spark, d)
    lake = bronze(spark, d, log.filter(F.col("recorded_at") <= middle))
    M.bronze_to_silver(spark, lake)
    M.silver_to_gold(spark, lake)
    newer = log.filter(F.col("recorded_at") > middle)
    tables.append_table(newer, lake.path(M.SURVEY))
    M.fold_events(spark, lake, newer)
    M.silver_to_gold(spark, lake, newer.select("id_wilayah").distinct())
    return lake


def grown_lake(spark: SparkSession, d: str) -> M.Lakehouse:
    return _grown(spark.sparkContext.applicationId, d)


def _read(spark, lake, name):
    return tables.read_table(spark, lake.path(name))


_HISTORY_SQL = (
    "SELECT s.event_id, s.id_wilayah, u.kelurahan, round(s.risk_score, 6) AS risk_score_saat_itu, s.risk_level AS risk_level_saat_itu "
    "FROM scored s LEFT JOIN units u USING (id_wilayah)"
)
_HISTORY_COLS = ["event_id", "id_wilayah", "kelurahan", "risk_score_saat_itu", "risk_level_saat_itu"]
_LATEST_SQL = "SELECT id_wilayah, event_id, kelurahan, round(risk_score, 6) AS risk_score FROM placed"
_LATEST_COLS = ["id_wilayah", "event_id", "kelurahan", "risk_score"]
_FEATURES_SQL = f"SELECT kelurahan, kecamatan, {_MATRIX} FROM placed GROUP BY kelurahan, kecamatan"


def _history(spark, lake):
    return pick(_read(spark, lake, M.HISTORY), _HISTORY_COLS, "risk_score_saat_itu")


def _latest(spark, lake):
    return pick(_read(spark, lake, M.LATEST), _LATEST_COLS, "risk_score")


def _features(spark, lake):
    return rounded(_read(spark, lake, M.FEATURES), *_MATRIX_DOUBLES)


@query("silver_full_history", _HISTORY_SQL)
def silver_full_history(spark, d):
    return _history(spark, silver_lake(spark, d))


@query("silver_full_latest", _LATEST_SQL)
def silver_full_latest(spark, d):
    return _latest(spark, silver_lake(spark, d))


@query("silver_full_features", _FEATURES_SQL)
def silver_full_features(spark, d):
    return _features(spark, silver_lake(spark, d))


@query("silver_full_ground_truth", "SELECT id_wilayah, label_kumuh FROM truth")
def silver_full_ground_truth(spark, d):
    return _read(spark, silver_lake(spark, d), M.GROUND_TRUTH).select("id_wilayah", "label_kumuh")


@query("silver_full_population", "SELECT kelurahan, cast(sum(total_jiwa) AS bigint) AS total_jiwa FROM units GROUP BY kelurahan, kecamatan")
def silver_full_population(spark, d):
    return _read(spark, silver_lake(spark, d), M.POPULATION).select("kelurahan", "total_jiwa")


@query("silver_incremental_history", _HISTORY_SQL)
def silver_incremental_history(spark, d):
    return _history(spark, grown_lake(spark, d))


@query("silver_incremental_latest", _LATEST_SQL)
def silver_incremental_latest(spark, d):
    return _latest(spark, grown_lake(spark, d))


@query("silver_incremental_features", _FEATURES_SQL)
def silver_incremental_features(spark, d):
    return _features(spark, grown_lake(spark, d))


@query("map_stored", f"SELECT id_wilayah, coalesce(g.risk_level, 'Belum Didata') AS risk_level FROM bounds b LEFT JOIN gold g USING (id_wilayah) WHERE {_VIEW_SQL}")
def map_stored(spark, d):
    """Viewport over the stored unit map: the bounds filter reaches the scan."""
    lake = gold_lake(spark, d)
    seen = bbox_filter(_read(spark, lake, M.UNIT_MAP), *VIEW)
    return serving.map_rows(seen, _read(spark, lake, M.RISK)).select("id_wilayah", "risk_level")


_GOLD_SQL = f"SELECT {_GOLD_COLS}, prioritas_rank FROM ranked"


def _gold_table(spark, lake):
    return pick(_read(spark, lake, M.RISK), [*_GOLD_NAMES, "prioritas_rank"], "risk_score", "priority_score")


@query("gold_full_risk", _GOLD_SQL)
def gold_full_risk(spark, d):
    return _gold_table(spark, gold_lake(spark, d))


@query("gold_incremental_risk", _GOLD_SQL)
def gold_incremental_risk(spark, d):
    return _gold_table(spark, grown_lake(spark, d))


@query("gold_incremental_trend", "SELECT id_wilayah, round(delta_risk, 6) AS delta_risk FROM trends")
def gold_incremental_trend(spark, d):
    return pick(_read(spark, grown_lake(spark, d), M.TREND), ["id_wilayah", "delta_risk"], "delta_risk")


@query("gold_incremental_forecast", "SELECT id_wilayah, round(forecast_score, 6) AS forecast_score FROM forecasts")
def gold_incremental_forecast(spark, d):
    return pick(_read(spark, grown_lake(spark, d), M.FORECAST), ["id_wilayah", "forecast_score"], "forecast_score")


@query("gold_prediction_table", "SELECT id_wilayah, kelurahan, kecamatan, label_prediksi, proba_kumuh FROM gold")
def gold_prediction_table(spark, d):
    return _read(spark, gold_lake(spark, d), M.PREDICTION).drop("last_updated")


# Models: the trees and cluster numbers have no SQL form, so most of these are
# checked by the tests instead.


@lru_cache(maxsize=4)
def _trained(app: str, d: str):
    """A silver lakehouse after a training run, and its model."""
    spark = SparkSession.active()
    lake = bronze(spark, d)
    M.bronze_to_silver(spark, lake)
    return lake, M.train(spark, lake)


def trained(spark, d):
    return _trained(spark.sparkContext.applicationId, d)


def _labelled(spark, d):
    return training_set(latest(spark, d), h.latest_ground_truth(D.ground_truth(spark, d)))


_SLOT = "cast('0x' || substr(md5('{purpose}:' || id_wilayah), 1, 8) AS bigint) % {slots}"
_SPLIT = (
    "(SELECT id_wilayah, label_kumuh AS label, "
    f"CASE WHEN {_SLOT.format(purpose='split', slots=1000)} < 800 THEN 'train' ELSE 'test' END AS split, "
    f"cast({_SLOT.format(purpose='fold', slots=3)} AS int) AS fold "
    "FROM latest JOIN truth USING (id_wilayah))"
)


@query("train_test_split", f"SELECT label, split, count(*) AS n_rows FROM {_SPLIT} s GROUP BY label, split")
def train_test_split(spark, d):
    return ml.stable_split(_labelled(spark, d)).groupBy("label", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@query("train_test_sides", f"SELECT id_wilayah, split, fold FROM {_SPLIT} s")
def train_test_sides(spark, d):
    """Side and fold of every labelled unit."""
    return ml.stable_folds(ml.stable_split(_labelled(spark, d))).select("id_wilayah", "split", "fold")


@query("train_test_union", "SELECT id_wilayah, t.label_kumuh AS label FROM latest JOIN truth t USING (id_wilayah)")
def train_test_union(spark, d):
    """Train and test rows together: every labelled unit exactly once."""
    rows = _labelled(spark, d)
    train, test = ml.train_test_split(rows, rows.count())
    return train.unionByName(test).select("id_wilayah", "label")


@query("rf_predictions")
def rf_predictions(spark, d):
    _, model = trained(spark, d)
    return ml.score(model, latest(spark, d)).select("id_wilayah", "label_prediksi", "proba_kumuh")


@query("rf_predictions_sound", "SELECT id_wilayah, true AS sound FROM latest")
def rf_predictions_sound(spark, d):
    """Every surveyed unit is scored once, with a probability on its label's side of a half."""
    p, label = F.col("proba_kumuh"), F.col("label_prediksi")
    agrees = F.when(p > 0.5, label == 1).when(p < 0.5, label == 0).otherwise(label.isin(0, 1))
    return rf_predictions(spark, d).select("id_wilayah", (p.between(0, 1) & agrees).alias("sound"))


@query("feature_importance")
def feature_importance(spark, d):
    _, model = trained(spark, d)
    return ml.feature_importance(spark, model)


@query("feature_importance_total", f"SELECT {len(V.MODEL_FEATURES)} AS n_features, 1e0 AS total, true AS sound")
def feature_importance_total(spark, d):
    """Importances of all features are shares of one."""
    of = F.col("importance")
    return feature_importance(spark, d).agg(
        F.count_distinct("feature").cast("int").alias("n_features"), F.round(F.sum(of), 9).alias("total"), F.every(of.between(0, 1)).alias("sound")
    )


@query(
    "model_metrics_counts",
    "SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test') AS n_test, "
    "count(*) FILTER (WHERE split = 'test' AND label = 1) AS n_positive, count(*) FILTER (WHERE split = 'test' AND label = 0) AS n_negative "
    f"FROM {_SPLIT} s",
)
def model_metrics_counts(spark, d):
    """Rows the stored model was fitted and judged on, by class, from its newest metrics row."""
    cell = lambda c: F.col(f"confusion_matrix_{c}").cast("long")
    return model_metrics(spark, d).select(
        F.col("n_train").cast("long").alias("n_train"),
        F.col("n_test").cast("long").alias("n_test"),
        (cell("tp") + cell("fn")).alias("n_positive"),
        (cell("tn") + cell("fp")).alias("n_negative"),
    )


@query("model_metrics")
def model_metrics(spark, d):
    lake, _ = trained(spark, d)
    return serving.model_metrics(tables.read_table(spark, lake.path(M.METRICS), schemas.METRICS))


@query("cv_summary")
def cv_summary(spark, d):
    rows = _labelled(spark, d)
    train, _ = ml.train_test_split(rows, rows.count())
    pipeline = ml.rf_pipeline()
    train = tables.staged(spark, train, "train")
    return ml.cv_frame(spark, ml.fit_cv(pipeline, train), pipeline)


@query("kmeans_assign")
def kmeans_assign(spark, d):
    _, assigned = ml.fit_kmeans(latest(spark, d))
    return ml.label_clusters(assigned)


@query("kmeans_summary")
def kmeans_summary(spark, d):
    return serving.cluster_list(_read(spark, gold_lake(spark, d), M.CLUSTERS))


@query("kmeans_covers_units", "SELECT id_wilayah, kelurahan FROM placed")
def kmeans_covers_units(spark, d):
    """Every surveyed unit gets exactly one cluster."""
    clustered = _read(spark, gold_lake(spark, d), M.RISK).filter(F.col("cluster_id").isNotNull())
    return clustered.select("id_wilayah", "kelurahan")


@query("kmeans_distribution")
def kmeans_distribution(spark, d):
    return serving.cluster_distribution(_read(spark, gold_lake(spark, d), M.RISK))


@query("kmeans_filtered")
def kmeans_filtered(spark, d):
    return serving.cluster_assignment(_read(spark, gold_lake(spark, d), M.RISK), cluster_id=0, kecamatan="ASIA")


@query("embedding_clusters")
def embedding_clusters(spark, d):
    """The same clustering pipeline shape on the 64-dimensional vectors."""
    vectors = D.table(spark, d, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = KMeans(k=4, seed=ml.SEED, maxIter=20, predictionCol="cluster_id").fit(vectors)
    return model.transform(vectors).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_vectors"))
