"""Linear forecast of each unit's risk score."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.functions.scoring import change_label, level_of
from lakerisk.functions.text import clamp, from_epoch

DAY = 86_400


def ols_by_key(events: DataFrame, key: str, ts: str, y: str, newest_by: str | None = "event_id") -> DataFrame:
    """Least-squares line of ``y`` over time in days, per key, in one aggregation.

    All observations at one instant give slope 0 through the mean. last_y is the
    newest observation, equal times settled by ``newest_by``; with None it is
    left out, and the aggregation needs no sort.
    """
    x = F.unix_timestamp(ts) / F.lit(float(DAY))
    rows = events.select(
        key,
        x.alias("_x"),
        F.col(y).cast("double").alias("_y"),
        F.col(ts).alias("_t"),
        F.col(newest_by or key).alias("_tie"),
    )
    rows = rows.filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    newest = [F.max_by("_y", F.struct("_t", "_tie")).alias("last_y")] if newest_by else []
    fitted = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.max("_t").alias("last_ts"),
        *newest,
        F.max("_y").alias("max_y"),
        F.avg("_y").alias("avg_y"),
        F.var_pop("_x").alias("_var"),
        F.regr_slope("_y", "_x").alias("_slope"),
        F.regr_intercept("_y", "_x").alias("_intercept"),
    )
    moving = F.col("_var") > 0
    return fitted.withColumns(
        {
            "slope": F.when(moving, F.col("_slope")).otherwise(F.lit(0.0)),
            "intercept": F.when(moving, F.col("_intercept")).otherwise(F.col("avg_y")),
        }
    ).drop("_var", "_slope", "_intercept")


def having_min_events(fitted: DataFrame, n: int = 2) -> DataFrame:
    """Keys with at least ``n`` observations, from the count the aggregation already has."""
    return fitted.filter(F.col("n") >= n)


def forecast(
    history: DataFrame,
    horizon_days: int = 30,
    threshold: float = 0.5,
    score_col: str = "risk_score_saat_itu",
    per_second: bool = False,
    latest: DataFrame | None = None,
) -> DataFrame:
    """Score expected ``horizon_days`` after a unit's last event.

    The current score comes from ``latest`` (id_wilayah, risk_score; one row per
    unit) when that snapshot exists, else from the history.

    The trend compares the daily slope with ``threshold``; ``per_second``
    compares the slope per second instead.
    """
    newest_by = "event_id" if latest is None else None
    fitted = having_min_events(ols_by_key(history, "id_wilayah", "recorded_at", score_col, newest_by))
    if latest is not None:
        fitted = fitted.join(latest.select("id_wilayah", F.col("risk_score").alias("last_y")), "id_wilayah", "left")
    return project(fitted, horizon_days, threshold, per_second)


def project(fitted: DataFrame, horizon_days: int, threshold: float, per_second: bool) -> DataFrame:
    """The lines (n, last_ts, last_y, slope, intercept) of ``fitted`` extended beyond their last event."""
    at = F.unix_timestamp("last_ts") + F.lit(horizon_days * DAY)
    raw = F.col("intercept") + F.col("slope") * at / F.lit(float(DAY))
    slope = F.col("slope") / F.lit(float(DAY)) if per_second else F.col("slope")
    return fitted.select(
        "id_wilayah",
        F.col("n").alias("n_history_events"),
        F.col("last_y").alias("current_risk_score"),
        clamp(raw, 0.0, 100.0).alias("forecast_score"),
        from_epoch(at).alias("forecast_at"),
        change_label(slope, threshold).alias("forecast_trend"),
        F.round("slope", 4).alias("slope_per_day"),
    ).withColumn("forecast_risk_level", level_of(F.col("forecast_score")))
