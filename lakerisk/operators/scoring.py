"""Score, band, factor and prediction columns."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk import vocabulary as V
from lakerisk.functions import scoring as S


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The names that are columns of ``df``, in the given order."""
    return [n for n in names if n in df.columns]


def risk_score(df: DataFrame, indicators: Sequence[str] = V.INDICATORS, name: str = "risk_score") -> DataFrame:
    return df.withColumn(name, S.score_of(present(df, indicators)))


def risk_level(df: DataFrame, score_col: str = "risk_score", name: str = "risk_level") -> DataFrame:
    return df.withColumn(name, S.level_of(F.col(score_col)))


def score_and_level(df: DataFrame, suffix: str = "") -> DataFrame:
    scored = risk_score(df, name=f"risk_score{suffix}")
    return risk_level(scored, f"risk_score{suffix}", f"risk_level{suffix}")


def partial_risk_score(df: DataFrame, indicators: Sequence[str] = V.INDICATORS) -> DataFrame:
    """Score over answered indicators; the level is final only when all are answered."""
    score = S.partial_score_of(indicators)
    answered = S.answered_of(indicators)
    return df.withColumns(
        {
            "answered": answered,
            "partial_score": score,
            "partial_level": F.when(answered == len(indicators), S.level_of(score)).when(
                answered > 0, V.INCOMPLETE
            ),
        }
    )


def weighted_risk_score(df: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    return df.withColumn("weighted_score", S.weighted_score_of(weights))


def prediction_band(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction_band", S.prediction_band_of(F.col("label_prediksi"), F.col("proba_kumuh")))


def prediction_label(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction_text", S.prediction_text_of(F.col("label_prediksi"), F.col("proba_kumuh")))


def rule_prediction(df: DataFrame) -> DataFrame:
    """Prediction without a model: slum when the risk score reaches 50."""
    return df.withColumns(
        {
            "label_prediksi": (F.col("risk_score") >= 50.0).cast("int"),
            "proba_kumuh": F.round(F.col("risk_score") / 100.0, 4),
        }
    )


def priority_score(df: DataFrame) -> DataFrame:
    return df.withColumn("priority_score", F.col("risk_score") * F.col("jiwa_terdampak").cast("double"))


def dominant_factors(df: DataFrame, k: int = 3) -> DataFrame:
    """top_faktor_1..k and skor_faktor_1..k per row: the worst indicators, ties by label; blanks when no indicator column exists."""
    held = {V.INDICATOR_LABELS[n]: F.col(n) for n in present(df, V.INDICATORS)}
    worst = S.largest_named(held, k) if held else F.array_repeat(F.struct(F.lit("").alias("name"), F.lit(0.0).alias("value")), k)
    with_worst = df.select("*", worst.alias("_worst"))
    place = {"top_faktor": "name", "skor_faktor": "value"}
    wide = [F.get("_worst", F.lit(i))[field].alias(f"{out}_{i + 1}") for out, field in place.items() for i in range(k)]
    return with_worst.select(*df.columns, *wide)


def indicators_long(df: DataFrame, keep: Sequence[str] = ("id_wilayah",)) -> DataFrame:
    """One row per unit and indicator (label, value), unanswered as 0."""
    wide = df.select(*keep, *[F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(V.RADAR_LABELS[n]) for n in V.INDICATORS])
    return wide.unpivot(list(keep), list(V.RADAR_LABELS.values()), "label", "value")
