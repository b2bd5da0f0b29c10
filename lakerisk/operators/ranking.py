"""Global ranks and running totals without a single-task window, and top-n lists."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk import vocabulary as V
from lakerisk.functions.scoring import largest_named
from lakerisk.operators.joins import lookup_left, split_parts
from lakerisk.operators.scoring import priority_score
from lakerisk.sources.tables import staged

RANGES = 256


def _range_of(value: Column, cuts: Column) -> Column:
    """How many of the sorted ``cuts`` are smaller than the value, by halving; NULL for NULL."""
    steps = [1 << i for i in reversed(range(RANGES.bit_length()))]

    def halve(at: Column, step: Column) -> Column:
        # One beyond the end gives NULL, which is not smaller.
        return F.when(F.get(cuts, at + step - 1) < value, at + step).otherwise(at)

    return F.when(value.isNotNull(), F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), halve))


def _cuts(value: str) -> Column:
    """Aggregate: at most 255 values that cut the distinct ones into ranges of about equal size, from a quantile sketch."""
    return F.percentile_approx(value, [i / RANGES for i in range(1, RANGES)], 10 * RANGES)


def running_totals(hist: DataFrame, value: str, counts: Sequence[str]) -> DataFrame:
    """Adds before_<count>: the total over all larger values, NULL values last.

    ``hist`` has one row per distinct value and is written to the scratch folder. Quantiles cut
    its values into at most 256 ranges of about equal size, whatever their distribution. Range
    totals are summed in one small window; inside a range the windows run in parallel.
    """
    hist = staged(hist.sparkSession, hist, "counts")
    return _totals_by_range(hist, value, counts, hist.agg(_cuts(value)).first()[0])


def _totals_by_range(hist: DataFrame, value: str, counts: Sequence[str], found: list | None) -> DataFrame:
    ahead = (Window.unboundedPreceding, -1)
    cuts = F.array(*[F.lit(c) for c in found or []]).cast(T.ArrayType(hist.schema[value].dataType))
    ranged = hist.withColumn("_range", _range_of(F.col(value), cuts))
    totals = ranged.groupBy("_range").agg(*[F.sum(c).alias(c) for c in counts])
    over_ranges = Window.orderBy(F.desc_nulls_last("_range")).rowsBetween(*ahead)
    offsets = totals.select(
        F.col("_range").alias("_r"), *[F.coalesce(F.sum(c).over(over_ranges), F.lit(0)).alias(f"_off_{c}") for c in counts]
    )
    inside = Window.partitionBy("_range").orderBy(F.desc_nulls_last(value)).rowsBetween(*ahead)
    local = ranged.withColumns({f"_in_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in counts})
    joined = local.join(F.broadcast(offsets), F.col("_range").eqNullSafe(F.col("_r")), "left")
    return joined.select(*hist.columns, *[(F.col(f"_in_{c}") + F.col(f"_off_{c}")).alias(f"before_{c}") for c in counts])


def global_rank(df: DataFrame, value: str, rank: str, salt_from: Sequence[str]) -> DataFrame:
    """rank() over the whole frame, largest first, NaN before all numbers and NULLs last.

    Rows are first counted per distinct value, so ties, however many, are one
    row in the running total; the ranks are then looked up by value. The counts also tell which
    values hold more rows than a task should: only these are split.
    """
    spark = df.sparkSession
    hist = staged(spark, df.groupBy(value).agg(F.count(F.lit(1)).alias("_n")), "counts")
    most, total, cuts = hist.agg(F.max("_n"), F.sum("_n"), _cuts(value)).first()
    ranks = _totals_by_range(hist, value, ["_n"], cuts).select(value, (F.col("before__n") + 1).alias(rank))
    parts = split_parts(spark)
    heavy = None
    if total and most * parts > total:
        heavy = hist.filter(F.col("_n") * parts > total).select(value, F.ceil(F.col("_n") * parts / total).alias("_copies"))
    return lookup_left(df, ranks, [value], salt_from=salt_from, null_safe=True, heavy=heavy)


def priority_rank(gold: DataFrame) -> DataFrame:
    """prioritas_rank by risk_score x people, ties sharing a rank."""
    return global_rank(priority_score(gold), "priority_score", "prioritas_rank", salt_from=["id_wilayah"])


def top_n(df: DataFrame, by: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*by).limit(n)


def top_priority(gold: DataFrame, n: int = 10) -> DataFrame:
    return top_n(gold, [F.asc_nulls_last("prioritas_rank"), F.asc("id_wilayah")], n)


def top_by(gold: DataFrame, column: str, n: int = 20) -> DataFrame:
    """Largest values first, NULL counted as 0."""
    return top_n(gold, [F.coalesce(F.col(column), F.lit(0)).desc(), F.asc("id_wilayah")], n)


def area_factors(latest: DataFrame, k: int = 3) -> DataFrame:
    """Top-k indicators of each kelurahan by mean score.

    The seven means come from one aggregation; ranking happens inside area rows.
    """
    means = latest.groupBy(*V.AREA_KEYS).agg(*[F.avg(F.coalesce(F.col(n), F.lit(0))).alias(n) for n in V.INDICATORS])
    worst = largest_named({V.INDICATOR_LABELS[n]: F.col(n) for n in V.INDICATORS}, k)
    ranked = means.select(*V.AREA_KEYS, F.posexplode(worst).alias("_at", "_of"))
    return ranked.select(
        *V.AREA_KEYS, F.col("_of.name").alias("faktor"), F.col("_of.value").alias("avg_skor"), (F.col("_at") + 1).alias("urutan")
    )
