"""Risk scores, bands and prediction texts as Column expressions."""

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakerisk import vocabulary as V


def _points(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def score_of(indicators: Sequence[str]) -> Column:
    """0-100 score over the given indicators; an unanswered one counts as 0."""
    if not indicators:
        return F.lit(0.0)
    best = float(V.MAX_INDICATOR_SCORE * len(indicators))
    return reduce(add, map(_points, indicators)) / F.lit(best) * F.lit(100.0)


def answered_of(indicators: Sequence[str]) -> Column:
    return reduce(add, [F.col(c).isNotNull().cast("int") for c in indicators])


def partial_score_of(indicators: Sequence[str]) -> Column:
    """0-100 score over answered indicators only; NULL when none is answered."""
    points = reduce(add, map(_points, indicators))
    return F.try_divide(points, answered_of(indicators) * F.lit(float(V.MAX_INDICATOR_SCORE))) * F.lit(100.0)


def weighted_score_of(weights: Mapping[str, float]) -> Column:
    """0-100 score with indicator weights rescaled to sum to 1."""
    total = float(sum(weights.values()))
    if total <= 0:
        raise ValueError("weights must sum to a positive number")
    parts = [_points(name) * F.lit(weight / total) for name, weight in weights.items()]
    return reduce(add, parts) * F.lit(100.0) / F.lit(float(V.MAX_INDICATOR_SCORE))


def level_of(score: Column) -> Column:
    """Risk band of a score; NULL falls into the top band."""
    (first, label), *rest = V.RISK_BANDS
    bands = F.when(score < first, label)
    for limit, label in rest:
        bands = bands.when(score < limit, label)
    return bands.otherwise(V.TOP_RISK_BAND)


def change_label(delta: Column, threshold: float) -> Column:
    """Worsening above +threshold, improving below -threshold, else stable."""
    return (
        F.when(delta > F.lit(float(threshold)), V.WORSENING)
        .when(delta < F.lit(-float(threshold)), V.IMPROVING)
        .otherwise(V.STABLE)
    )


def prediction_band_of(label: Column, proba: Column) -> Column:
    """Display band: none / low / medium / high; the label decides without a probability."""
    return (
        F.when(label.isNull() & proba.isNull(), "none")
        .when(proba >= 0.7, "high")
        .when(proba >= 0.5, "medium")
        .when(proba.isNotNull(), "low")
        .when(label == 1, "high")
        .otherwise("low")
    )


def prediction_text_of(label: Column, proba: Column) -> Column:
    positive = F.coalesce(label == 1, F.lit(False)) | F.coalesce(proba >= 0.5, F.lit(False))
    return (
        F.when(label.isNull() & proba.isNull(), V.NOT_PREDICTED)
        .when(positive, V.PREDICTED_SLUM)
        .otherwise(V.PREDICTED_FINE)
    )


def largest_named(values: Mapping[str, Column], k: int) -> Column:
    """The k largest of named values as array<struct<name, value>>: largest first, ties by name, NaN above all numbers.

    NULL counts as 0. Fewer than k values give a shorter array.
    """

    def order(a: Column, b: Column) -> Column:
        by_name = F.when(a["key"] < b["key"], -1).otherwise(1)
        return F.when(a["value"] > b["value"], -1).when(a["value"] < b["value"], 1).otherwise(by_name)

    pairs = [part for name, value in values.items() for part in (F.lit(name), F.coalesce(value.cast("double"), F.lit(0.0)))]
    ordered = F.array_sort(F.map_entries(F.create_map(*pairs)), order)
    return F.transform(F.slice(ordered, 1, k), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value")))
