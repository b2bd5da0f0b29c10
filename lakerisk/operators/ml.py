"""Random forest and K-Means on Spark ML."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakerisk import schemas
from lakerisk import vocabulary as V
from lakerisk.functions.text import version_string
from lakerisk.operators.features import fill_features
from lakerisk.operators.joins import shuffled
from lakerisk.operators.metrics import classification_metrics, confusion_matrix
from lakerisk.operators.scoring import present, risk_score, rule_prediction

SEED = 42
MIN_SPLIT_ROWS = 5
MAX_TREES, MAX_DEPTH = 20, 5
CV_SCHEMA = "n_trees INT, max_depth INT, mean_f1 DOUBLE, fold_std_f1 DOUBLE"


def feature_stage(cols: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=output, handleInvalid="keep")


def rf_pipeline(trees: int = 8, depth: int = 3, seed: int = SEED, cols: Sequence[str] = V.MODEL_FEATURES) -> Pipeline:
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[feature_stage(cols), forest])


def hash_slot(id_col: str, purpose: str, slots: int) -> Column:
    """0 to ``slots`` - 1: the first 32 bits of md5 of ``purpose:id``, modulo ``slots``. Any SQL can restate it."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{purpose}:"), F.col(id_col).cast("string"))), 1, 8)
    return (F.conv(digits, 16, 10).cast("long") % slots).cast("int")


def stable_split(df: DataFrame, id_col: str = "id_wilayah", frac: float = 0.8) -> DataFrame:
    """Adds split = train / test by the hash of the id, about ``frac`` of each class.

    The same unit always lands on the same side, whatever the partitioning, and also when its label changes.
    """
    slot = hash_slot(id_col, "split", 1000)
    return df.withColumn("split", F.when(slot < round(frac * 1000), "train").otherwise("test"))


def stable_folds(df: DataFrame, folds: int = 3, id_col: str = "id_wilayah") -> DataFrame:
    """Adds fold, by a hash of the id independent of the split's."""
    return df.withColumn("fold", hash_slot(id_col, "fold", folds))


def train_test_split(df: DataFrame, total: int, frac: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(train, test); with fewer than five rows both are the whole set."""
    if total < MIN_SPLIT_ROWS:
        return df, df
    split = stable_split(df, frac=frac)
    return split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")


def fit_cv(pipeline: Pipeline, df: DataFrame, folds: int = 3, id_col: str = "id_wilayah") -> CrossValidatorModel | None:
    """Grid search by F1 over trees and depth, folds chosen by id hash.

    None when there are fewer than three rows per fold, or a fold or its rest
    lacks rows: then a single fit is the way.
    """
    forest = pipeline.getStages()[-1]
    trees, depth = forest.getNumTrees(), forest.getMaxDepth()
    grid = (
        ParamGridBuilder()
        .addGrid(forest.numTrees, sorted({trees, min(2 * trees, MAX_TREES)}))
        .addGrid(forest.maxDepth, sorted({depth, min(depth + 1, MAX_DEPTH)}))
        .build()
    )
    folded = stable_folds(df, folds, id_col)
    sizes = [r["n"] for r in folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()]
    if sum(sizes) < 3 * folds or len(sizes) < folds:
        return None
    search = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(labelCol="label", metricName="f1"),
        numFolds=folds,
        seed=SEED,
        parallelism=len(grid),
        foldCol="fold",
    )
    return search.fit(folded)


@dataclass(frozen=True)
class CvSummary:
    mean_f1: float
    grid_std_f1: float
    fold_std_f1: float


def cv_summary(model: CrossValidatorModel) -> CvSummary:
    """Best mean F1, its spread over the grid, and over the folds of the best grid point."""
    means = list(model.avgMetrics)
    best = max(range(len(means)), key=means.__getitem__)
    center = sum(means) / len(means)
    grid_std = (sum((m - center) ** 2 for m in means) / len(means)) ** 0.5
    return CvSummary(round(means[best], 4), round(grid_std, 4), round(model.stdMetrics[best], 4))


def cv_frame(spark: SparkSession, model: CrossValidatorModel | None, pipeline: Pipeline) -> DataFrame:
    """One row per grid point: trees, depth, mean and fold std of F1. If the search was skipped, the point
    that a single fit of ``pipeline`` takes, its figures NULL as in the metrics table."""
    rows = []
    if model is None:
        forest = pipeline.getStages()[-1]
        return spark.createDataFrame([(forest.getNumTrees(), forest.getMaxDepth(), None, None)], CV_SCHEMA)
    for params, mean, std in zip(model.getEstimatorParamMaps(), model.avgMetrics, model.stdMetrics, strict=True):
        named = {p.name: v for p, v in params.items()}
        rows.append((named["numTrees"], named["maxDepth"], float(mean), float(std)))
    return spark.createDataFrame(rows, CV_SCHEMA)


def proba_of(col: str = "probability", i: int = 1) -> Column:
    return F.get(vector_to_array(F.col(col)), F.lit(i))


def score(model: PipelineModel | None, df: DataFrame, cols: Sequence[str] = V.MODEL_FEATURES) -> DataFrame:
    """``df`` with label_prediksi and proba_kumuh; without a model the risk rule decides.

    The model's transform keeps the other columns, so nothing is joined back.
    Features are zero-filled on copies; the stored indicators keep their NULLs.
    """
    if model is None:
        return rule_prediction(df)
    kept = df.columns
    filled = df.withColumn("_row", F.struct(*kept))
    predicted = model.transform(fill_features(filled, cols))
    return predicted.select(
        "_row.*",
        F.col("prediction").cast("int").alias("label_prediksi"),
        F.round(proba_of(), 4).alias("proba_kumuh"),
    )


def predictions(model: PipelineModel, df: DataFrame) -> DataFrame:
    """id, label, prediction and probability of labelled rows."""
    return model.transform(df).select("id_wilayah", "label", "prediction", proba_of().alias("proba"))


def feature_importance(spark: SparkSession, model: PipelineModel, cols: Sequence[str] = V.MODEL_FEATURES) -> DataFrame:
    """(feature, importance), largest first."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    pairs = sorted(zip(cols, values, strict=True), key=lambda p: (-p[1], p[0]))
    return spark.createDataFrame(pairs, "feature STRING, importance DOUBLE")


def evaluate(pred: DataFrame) -> DataFrame:
    """One row of classification metrics and confusion counts."""
    metrics = classification_metrics(pred).withColumn("_one", F.lit(1))
    matrix = confusion_matrix(pred).drop("precision", "recall").withColumn("_one", F.lit(1))
    return metrics.join(matrix, "_one").drop("_one")


def save_model(model: PipelineModel, root: str, version: str) -> str:
    """Write the model under its version and again as the latest; returns the version's path."""
    path = f"{root}/rf_slum_v{version}"
    model.write().overwrite().save(path)
    model.write().overwrite().save(f"{root}/rf_slum_latest")
    return path


def load_model(root: str) -> PipelineModel:
    return PipelineModel.load(f"{root}/rf_slum_latest")


def stored_model(spark: SparkSession, root: str) -> PipelineModel | None:
    """The latest saved model, or None when none was ever saved."""
    try:
        spark.read.text(f"{root}/rf_slum_latest/metadata")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return load_model(root)


def new_version(spark: SparkSession) -> str:
    return spark.range(1).select(version_string(F.current_timestamp())).first()[0]


def metrics_row(
    spark: SparkSession,
    evaluation: DataFrame,
    importance: DataFrame,
    model: PipelineModel,
    version: str,
    path: str,
    n_train: int,
    n_test: int,
    cv: CvSummary | None,
    folds: int,
    cols: Sequence[str] = V.MODEL_FEATURES,
) -> DataFrame:
    """One row of the model-metrics table. CV fields are NULL when CV was skipped."""
    forest = model.stages[-1]
    known = {
        "model_version": f"rf_slum_v{version}",
        "model_path": path,
        "algorithm": "RandomForestClassifier",
        "n_trees": forest.getNumTrees,
        "max_depth": forest.getOrDefault("maxDepth"),
        "cv_folds": folds if cv else None,
        "cv_mean_f1": cv.mean_f1 if cv else None,
        "cv_std_f1": cv.grid_std_f1 if cv else None,
        "n_train": n_train,
        "n_test": n_test,
        "feature_cols": ",".join(cols),
    }
    # The importance frame has one row per feature.
    as_json = importance.agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("feature", "importance")))).alias("feature_importances"),
    ).withColumn("_one", F.lit(1))
    row = evaluation.withColumn("_one", F.lit(1)).join(as_json, "_one").withColumns({k: F.lit(v) for k, v in known.items()})
    renamed = row.withColumnsRenamed(
        {
            "f1": "f1_score",
            "weighted_precision": "precision",
            "weighted_recall": "recall",
            **{c: f"confusion_matrix_{c}" for c in ("tp", "tn", "fp", "fn")},
        }
    ).withColumn("trained_at", F.current_timestamp())
    return renamed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.METRICS])


def kmeans_pipeline(k: int = 4, cols: Sequence[str] = V.INDICATORS) -> Pipeline:
    means = KMeans(k=k, seed=SEED, maxIter=20, featuresCol="features", predictionCol="cluster_id")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return Pipeline(stages=[feature_stage(cols, "raw_features"), scaler, means])


def kmeans_input(latest: DataFrame, cols: Sequence[str] = V.INDICATORS) -> DataFrame:
    return risk_score(fill_features(latest.select("id_wilayah", *present(latest, (*V.AREA_KEYS, *cols))), cols), cols)


def fit_kmeans(latest: DataFrame, k: int = 4) -> tuple[PipelineModel, DataFrame] | None:
    """(model, assigned rows), or None when no indicator exists, fewer than k units do, or all answer alike.

    Units of fewer than k kinds get a cluster for each kind: the fit needs as many different points."""
    cols = present(latest, V.INDICATORS)
    rows = kmeans_input(latest, cols) if cols else None
    if rows is None or len(rows.select("id_wilayah").take(k)) < k:
        return None
    kinds = len(rows.select(*cols).distinct().take(k))
    if kinds < 2:
        return None
    model = kmeans_pipeline(kinds, cols).fit(rows)
    return model, model.transform(rows)


def cluster_stats(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("cluster_id").agg(
        F.avg("risk_score").alias("avg_risk_score"), F.count("id_wilayah").alias("jumlah_wilayah")
    )


def label_stats(stats: DataFrame, labels: Sequence[str] = V.CLUSTER_LABELS) -> DataFrame:
    """cluster_rank and cluster_label by rising mean risk; ranks past the last label share it.

    The window runs over one row per cluster.
    """
    rank = F.row_number().over(Window.orderBy("avg_risk_score", "cluster_id"))
    names = F.array(*[F.lit(name) for name in labels])
    ranked = stats.withColumn("cluster_rank", rank)
    return ranked.withColumn("cluster_label", F.get(names, F.least(F.col("cluster_rank"), F.lit(len(labels))) - 1))


def label_clusters(assigned: DataFrame, labels: Sequence[str] = V.CLUSTER_LABELS) -> DataFrame:
    """Cluster of each unit with its label. The broadcast side has k rows."""
    named = label_stats(cluster_stats(assigned), labels).select("cluster_id", "cluster_rank", "cluster_label")
    units = assigned.select("id_wilayah", *present(assigned, V.AREA_KEYS), "cluster_id")
    return units.join(F.broadcast(named), "cluster_id", "left")


def cluster_summary(assigned: DataFrame, cols: Sequence[str] = V.INDICATORS) -> DataFrame:
    """One row per cluster: label, size, mean risk and centroid, in original
    units (centroid_*) and in the standardised space of the model (scaled_*)."""
    cols = present(assigned, cols)
    centers = assigned.groupBy("cluster_id").agg(
        *[F.avg(c).alias(f"centroid_{c}") for c in cols],
        vector_to_array(Summarizer.mean(F.col("features"))).alias("_scaled"),
    )
    scaled = [F.get("_scaled", F.lit(i)).alias(f"scaled_{c}") for i, c in enumerate(cols)]
    joined = label_stats(cluster_stats(assigned)).join(centers, "cluster_id")
    return joined.select(*[c for c in joined.columns if c != "_scaled"], *scaled)


def attach_clusters(scored: DataFrame, assignment: DataFrame | None) -> DataFrame:
    bare = scored.drop("cluster_id", "cluster_rank", "cluster_label")
    if assignment is None:
        return bare.withColumns(
            {"cluster_id": F.lit(None).cast("int"), "cluster_rank": F.lit(None).cast("int"), "cluster_label": F.lit("")}
        )
    return bare.join(shuffled(assignment.select("id_wilayah", "cluster_id", "cluster_rank", "cluster_label")), "id_wilayah", "left")
