"""What trend and forecast need of a unit's events, in a form that batches are folded into.

A row holds the two newest events and the central moments of time and score. Moments of
two sets of events combine exactly, so a batch is aggregated alone and merged with
the stored rows of its units; the event log is not read again.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerisk.functions.scoring import change_label
from lakerisk.operators.forecast import DAY, having_min_events, project
from lakerisk.operators.history import newest_first, top_per_key
from lakerisk.operators.joins import shuffled

SUMS = ["n", "first_at", "last_at", "mean_x", "mean_y", "m2_x", "c_xy"]


def event_state(events: DataFrame, score_col: str = "risk_score_saat_itu") -> DataFrame:
    """One row per unit: newest (at most two events, newest first), and over the events that
    have a time and a score their number n, first_at, last_at, means in days and points, and sums m2_x
    and c_xy of squared and crossed deviations. Aggregated before the shuffle, however many events a unit has."""
    rows = events.select("id_wilayah", "recorded_at", "event_id", F.col(score_col).cast("double").alias("risk_score"))
    event = F.struct("recorded_at", "event_id", "risk_score")
    two = top_per_key(rows, ["id_wilayah"], newest_first(), n=2).groupBy("id_wilayah").agg(
        F.sort_array(F.collect_list(event), asc=False).alias("newest")
    )
    x, y = F.col("_x"), F.col("risk_score")
    timed = rows.withColumn("_x", F.unix_timestamp("recorded_at") / F.lit(float(DAY))).filter(x.isNotNull() & y.isNotNull())
    sums = timed.groupBy(F.col("id_wilayah").alias("_id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("recorded_at").alias("first_at"),
        F.max("recorded_at").alias("last_at"),
        F.avg(x).alias("mean_x"),
        F.avg(y).alias("mean_y"),
        (F.var_pop(x) * F.count(F.lit(1))).alias("m2_x"),
        (F.covar_pop(x, y) * F.count(F.lit(1))).alias("c_xy"),
    )
    return two.join(shuffled(sums), F.col("id_wilayah").eqNullSafe(F.col("_id")), "left").select("id_wilayah", "newest", F.coalesce("n", F.lit(0).cast("long")).alias("n"), *SUMS[1:])


def merge_state(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The states of the batch's units after folding it into ``stored``; other units are left out.

    The events of both must be different ones.
    """
    old = stored.select(*[F.col(c).alias(f"_{c}") for c in ("id_wilayah", "newest", *SUMS)])
    both = batch.join(shuffled(old), F.col("id_wilayah").eqNullSafe(F.col("_id_wilayah")), "left")

    def of(name: str, empty: Column) -> tuple[Column, Column]:
        return F.coalesce(F.col(name), empty), F.coalesce(F.col(f"_{name}"), empty)

    zero = F.lit(0.0)
    (n_new, n_old), (x_new, x_old), (y_new, y_old) = of("n", F.lit(0).cast("long")), of("mean_x", zero), of("mean_y", zero)
    (m2_new, m2_old), (c_new, c_old) = of("m2_x", zero), of("c_xy", zero)
    n = n_new + n_old
    share = F.try_divide(n_new.cast("double"), n)
    step_x, step_y = x_new - x_old, y_new - y_old
    weight = F.coalesce(n_old * share, zero)

    def mean(new: Column, old: Column, step: Column) -> Column:
        # A side without events has no mean to start from.
        return F.when(n_old == 0, new).otherwise(old + step * share)

    events = F.concat(F.col("newest"), F.coalesce(F.col("_newest"), F.slice("newest", 1, 0)))
    known = n > 0
    return both.select(
        "id_wilayah",
        F.slice(F.sort_array(events, asc=False), 1, 2).alias("newest"),
        n.alias("n"),
        F.least("first_at", "_first_at").alias("first_at"),
        F.greatest("last_at", "_last_at").alias("last_at"),
        F.when(known, F.when(n_new == 0, x_old).otherwise(mean(x_new, x_old, step_x))).alias("mean_x"),
        F.when(known, F.when(n_new == 0, y_old).otherwise(mean(y_new, y_old, step_y))).alias("mean_y"),
        F.when(known, m2_new + m2_old + F.when((n_old > 0) & (n_new > 0), step_x * step_x * weight).otherwise(zero)).alias("m2_x"),
        F.when(known, c_new + c_old + F.when((n_old > 0) & (n_new > 0), step_x * step_y * weight).otherwise(zero)).alias("c_xy"),
    )


def trend_of(state: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Newest against second newest score, as ``history.trend`` gives it."""
    one, other = F.try_element_at("newest", F.lit(1)), F.try_element_at("newest", F.lit(2))
    delta = one["risk_score"] - F.coalesce(other["risk_score"], one["risk_score"])
    return state.select(
        "id_wilayah",
        one["risk_score"].alias("risk_score_latest"),
        one["recorded_at"].alias("recorded_at_latest"),
        other["risk_score"].alias("risk_score_prev"),
        other["recorded_at"].alias("recorded_at_prev"),
        delta.alias("delta_risk"),
        change_label(delta, threshold).alias("trend_label"),
    )


def forecast_of(state: DataFrame, horizon_days: int = 30, threshold: float = 0.5, per_second: bool = False) -> DataFrame:
    """Score expected ``horizon_days`` after a unit's last event, as ``forecast.forecast`` gives it."""
    # Deviations of equal times may leave rounding errors in m2_x.
    moving = F.unix_timestamp("first_at") < F.unix_timestamp("last_at")
    slope = F.when(moving, F.col("c_xy") / F.col("m2_x")).otherwise(F.lit(0.0))
    fitted = having_min_events(state).select(
        "id_wilayah",
        "n",
        F.col("last_at").alias("last_ts"),
        F.try_element_at("newest", F.lit(1))["risk_score"].alias("last_y"),
        slope.alias("slope"),
        (F.col("mean_y") - slope * F.col("mean_x")).alias("intercept"),
    )
    return project(fitted, horizon_days, threshold, per_second)
