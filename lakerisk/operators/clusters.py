"""A fitted K-Means model as a small table, so that changed units are scored without a fit.

One row per cluster: its centre in the model's space, the shift and factor of each indicator, rank and
label of the cluster at fit time, and the number of units it was fitted on.
"""

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakerisk import vocabulary as V
from lakerisk.operators.features import fill_features
from lakerisk.operators.ml import cluster_stats, label_stats
from lakerisk.operators.scoring import present, risk_score

#: Share of units more than at fit time from which a new fit is due.
GROWTH = 0.2


def model_table(model: PipelineModel, assigned: DataFrame) -> DataFrame:
    """The fitted pipeline and its assignment as rows; k rows are collected and made literals."""
    cols = present(assigned, V.INDICATORS)
    scaler, means = model.stages[-2], model.stages[-1]
    std = np.asarray(scaler.std)
    # The scaler maps a column without spread to 0.
    factor = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0).tolist()
    units = label_stats(cluster_stats(assigned))
    centers = F.array(*[F.array(*map(F.lit, map(float, center))) for center in means.clusterCenters()])
    return units.select(
        "cluster_id",
        "cluster_rank",
        "cluster_label",
        F.get(centers, F.col("cluster_id")).alias("center"),
        F.array(*map(F.lit, np.asarray(scaler.mean).tolist())).alias("shift"),
        F.array(*map(F.lit, factor)).alias("factor"),
        F.array(*map(F.lit, cols)).alias("cols"),
        F.sum("jumlah_wilayah").over(Window.partitionBy()).alias("n_units"),
        F.current_timestamp().alias("fitted_at"),
    )


class Clusters:
    """A stored model, read: k rows."""

    def __init__(self, table: DataFrame):
        rows = sorted(table.collect(), key=lambda r: r["cluster_id"])
        self.rows, self.cols, self.n_units = rows, rows[0]["cols"], rows[0]["n_units"]

    def due(self, latest: DataFrame, k: int) -> bool:
        """Whether to fit anew: other indicators, another k, or many more units than at fit time.
        Clusters that no unit was in are not stored, so k is a bound."""
        return present(latest, V.INDICATORS) != list(self.cols) or len(self.rows) > k or latest.count() > (1 + GROWTH) * self.n_units

    def distances(self) -> list[Column]:
        """Squared distance to each centre in the model's space; absent answers count as 0."""
        first = self.rows[0]
        points = [
            (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(shift)) * F.lit(factor)
            for c, shift, factor in zip(self.cols, first["shift"], first["factor"], strict=True)
        ]
        return [sum((p - F.lit(x)) * (p - F.lit(x)) for p, x in zip(points, row["center"], strict=True)) for row in self.rows]

    def assign(self, units: DataFrame) -> DataFrame:
        """Units with cluster_id, cluster_rank and cluster_label of the nearest centre, ties to the smaller id."""
        found = units.drop("cluster_id", "cluster_rank", "cluster_label").withColumn("_d", F.array(*self.distances()))
        at = F.array_position("_d", F.array_min("_d")).cast("int") - 1
        named = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in ("cluster_id", "cluster_rank", "cluster_label")]) for r in self.rows])
        return found.withColumn("_c", F.get(named, at)).select(*[c for c in found.columns if c != "_d"], "_c.*")

    def summary(self, units: DataFrame) -> DataFrame:
        """One row per cluster as ``ml.cluster_summary`` gives it, over units with their cluster; labels are the stored ones.

        A standardised mean is the mean standardised, so one aggregation gives both."""
        filled = risk_score(fill_features(units, self.cols), self.cols)
        means = filled.groupBy("cluster_id", "cluster_rank", "cluster_label").agg(
            F.avg("risk_score").alias("avg_risk_score"),
            F.count("id_wilayah").alias("jumlah_wilayah"),
            *[F.avg(c).alias(f"centroid_{c}") for c in self.cols],
        )
        first = self.rows[0]
        scaled = [
            ((F.col(f"centroid_{c}") - F.lit(shift)) * F.lit(factor)).alias(f"scaled_{c}")
            for c, shift, factor in zip(self.cols, first["shift"], first["factor"], strict=True)
        ]
        return means.filter(F.col("cluster_id").isNotNull()).select("*", *scaled)


def farther_than_nearest(units: DataFrame, clusters: Clusters) -> DataFrame:
    """Units with a stored centre nearer than their own: none, while each is scored by the model."""
    own = F.get(F.array(*clusters.distances()), F.array_position(F.array(*[F.lit(r["cluster_id"]) for r in clusters.rows]), F.col("cluster_id")).cast("int") - 1)
    return units.filter(own > F.least(*clusters.distances()) if len(clusters.rows) > 1 else F.lit(False))
