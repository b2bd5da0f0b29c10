"""Latest snapshots, deduplication, trends and points in time of the event log.

The top-n operators filter on row_number(), which Spark turns into a group
limit ahead of the shuffle: every task forwards at most n rows per key, so a
key with a third of the log costs no more than any other.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakerisk.functions.scoring import change_label, level_of
from lakerisk.operators.joins import match_rows
from lakerisk.operators.scoring import score_and_level

NEWEST = ("recorded_at", "event_id")


def _newest(order_cols: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(c) for c in order_cols]


def newest_first() -> list[Column]:
    """Order of a unit's events: newest first, equal times by event id."""
    return _newest(NEWEST)


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank: str | None = None
) -> DataFrame:
    """First ``n`` rows of each key; ``rank`` keeps the position under that name."""
    numbered = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    top = numbered.filter(F.col("_rn") <= n)
    return top.withColumnRenamed("_rn", rank) if rank else top.drop("_rn")


def latest_per_key(df: DataFrame, key: str = "id_wilayah", order_cols: Sequence[str] = NEWEST) -> DataFrame:
    return top_per_key(df, [key], _newest(order_cols))


def latest_indicators(events: DataFrame) -> DataFrame:
    """Newest event of each unit with its score and level."""
    return score_and_level(latest_per_key(events))


def dedup_events(events: DataFrame) -> DataFrame:
    """One row per event_id: the earliest, equal times settled by row content."""
    return top_per_key(events, ["event_id"], [F.asc_nulls_last("recorded_at"), F.xxhash64(*events.columns)])


def latest_ground_truth(secondary: DataFrame) -> DataFrame:
    labels = secondary.filter(F.col("source_type") == "ground_truth")
    return latest_per_key(labels, "id_wilayah", ("ingested_at", "batch_id"))


def trend(history: DataFrame, threshold: float = 2.0, score_col: str = "risk_score_saat_itu") -> DataFrame:
    """Newest against second newest score of each unit."""
    last_two = top_per_key(
        history.select("id_wilayah", "recorded_at", "event_id", score_col), ["id_wilayah"], _newest(NEWEST), n=2, rank="_rn"
    )
    by_unit = Window.partitionBy("id_wilayah").orderBy(*_newest(NEWEST))
    delta = F.col(score_col) - F.coalesce(F.col("risk_score_prev"), F.col(score_col))
    return (
        last_two.withColumns(
            {
                "risk_score_prev": F.lead(score_col).over(by_unit),
                "recorded_at_prev": F.lead("recorded_at").over(by_unit),
            }
        )
        .filter(F.col("_rn") == 1)
        .withColumn("delta_risk", delta)
        .select(
            "id_wilayah",
            F.col(score_col).alias("risk_score_latest"),
            F.col("recorded_at").alias("recorded_at_latest"),
            "risk_score_prev",
            "recorded_at_prev",
            "delta_risk",
            change_label(F.col("delta_risk"), threshold).alias("trend_label"),
        )
    )


def history_series(history: DataFrame, score_col: str = "risk_score_saat_itu") -> DataFrame:
    """Chart points of every unit in time order. The sort key ends in event_id, so
    its range partitions can cut inside a unit."""
    return history.select(
        "id_wilayah",
        "recorded_at",
        "event_id",
        F.col(score_col).alias("risk_score"),
        level_of(F.col(score_col)).alias("point_level"),
    ).orderBy("id_wilayah", "recorded_at", "event_id")


def snapshot_as_of(events: DataFrame, ts: str) -> DataFrame:
    """Latest row of each unit as the log stood at ``ts``."""
    return latest_per_key(events.filter(F.col("recorded_at") <= F.lit(ts).cast("timestamp")))


def label_asof(
    labels: DataFrame,
    events: DataFrame,
    at: str = "labeled_at",
    payload: Sequence[str] = ("event_id", "recorded_at"),
    bucket_seconds: int = 3600,
) -> DataFrame:
    """Each label with the newest event of its unit at or before the label time.

    Labels and events meet inside (unit, time bucket) groups, and only events of
    buckets that hold a label are sorted. Every other bucket is reduced to its
    last event, which is carried forward on one row per bucket. So no label-event
    pairs are formed and no task holds the log of a whole unit.
    """

    def bucket(name: str) -> Column:
        return F.floor(F.unix_timestamp(name) / F.lit(bucket_seconds)).alias("_bucket")

    event = F.struct("recorded_at", "event_id", *[F.col(c).alias(f"p_{c}") for c in payload])
    log = events.filter(F.col("recorded_at").isNotNull()).select(
        "id_wilayah", bucket("recorded_at"), F.col("recorded_at").alias("_t"), F.lit(0).alias("_kind"), event.alias("_event")
    )
    asked = labels.select(
        "id_wilayah", bucket(at), F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.struct(*labels.columns).alias("_label")
    )
    merged = log.unionByName(asked, allowMissingColumns=True)
    places = ["id_wilayah", "_bucket"]
    near = match_rows(log, asked.select(*places).distinct(), places, "left_semi")
    in_order = Window.partitionBy(*places).orderBy("_t", "_kind", F.col("_event.event_id").asc_nulls_last())
    together = near.unionByName(asked, allowMissingColumns=True)
    seen = F.last("_event", ignorenulls=True).over(in_order)
    within = together.withColumn("_seen", seen).filter(F.col("_kind") == 1)

    # A struct orders by its first fields, so max() is the bucket's newest event.
    steps = merged.groupBy(*places).agg(F.max("_event").alias("_event"))
    earlier = Window.partitionBy("id_wilayah").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = steps.select(
        F.col("id_wilayah"), "_bucket", F.last("_event", ignorenulls=True).over(earlier).alias("_carried")
    )
    found = F.coalesce(F.col("_seen"), F.col("_carried"))
    return within.join(carried, places, "left").select(
        "_label.*", *[found[f"p_{c}"].alias(c) for c in payload]
    )
