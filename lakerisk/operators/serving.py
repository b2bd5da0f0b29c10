"""Read-side queries: listings, lookups, map layer, dashboard counts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from lakerisk import vocabulary as V
from lakerisk.functions.text import search_text, split_ids
from lakerisk.operators.geo import bbox_filter, normalize_geometry, with_distance
from lakerisk.operators.joins import scope_by_keys

GOLD_PROPERTIES = (
    "risk_score",
    "risk_level",
    "proba_kumuh",
    "label_prediksi",
    "top_faktor_1",
    "top_faktor_2",
    "top_faktor_3",
    "prioritas_rank",
    "cluster_id",
    "cluster_label",
)


def _equals(df: DataFrame, wanted: dict[str, object]) -> DataFrame:
    """Equality on text for every value that is given."""
    for name, value in wanted.items():
        if value not in (None, ""):
            df = df.filter(F.col(name) == F.lit(value))
    return df


def filter_units(
    units: DataFrame,
    kecamatan: str | None = None,
    kelurahan: str | None = None,
    rw: str | None = None,
    rt: str | None = None,
    q: str | None = None,
) -> DataFrame:
    found = _equals(units, {"kecamatan": kecamatan, "kelurahan": kelurahan, "rw": rw, "rt": rt})
    if q:
        found = found.filter(search_text(("id_wilayah", *V.HIERARCHY)).contains(q.lower()))
    return found


def filter_ids(df: DataFrame, ids: str) -> DataFrame:
    """Rows whose id is in a comma-separated list; an empty list keeps all."""
    wanted = df.sparkSession.createDataFrame([Row(ids=ids)]).select(
        F.explode(split_ids(F.col("ids"))).alias("id_wilayah")
    )
    return df if not ids.replace(",", "").strip() else scope_by_keys(df, wanted)


def filter_priority(gold: DataFrame, kecamatan: str | None = None, level: str | None = None) -> DataFrame:
    return _equals(gold, {"kecamatan": kecamatan, "risk_level": level})


def filter_forecast(named: DataFrame, trend: str | None = None, kecamatan: str | None = None) -> DataFrame:
    found = _equals(named, {"kecamatan": kecamatan})
    return found.filter(F.lower("forecast_trend") == trend.lower()) if trend else found


def filter_clusters(gold: DataFrame, cluster_id: int | None = None, kecamatan: str | None = None) -> DataFrame:
    return _equals(gold, {"cluster_id": cluster_id, "kecamatan": kecamatan})


def page(df: DataFrame, order_cols: Sequence[Column | str], limit: int, offset: int = 0) -> DataFrame:
    """One page in an order that must be unique, so pages do not overlap."""
    return df.orderBy(*order_cols).offset(offset).limit(limit)


def page_info(df: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """total, returned and has_more of a page, counted without fetching it."""
    left = F.greatest(F.col("total") - F.lit(offset), F.lit(0))
    returned = F.least(left, F.lit(limit)).cast("long")
    return df.agg(F.count(F.lit(1)).alias("total")).select(
        "total", returned.alias("returned"), (F.lit(offset) + returned < F.col("total")).alias("has_more")
    )


def list_units(units: DataFrame, limit: int = 500, offset: int = 0, **filters: str) -> DataFrame:
    return page(filter_units(units, **filters), ["id_wilayah"], limit, offset)


def unit_options(units: DataFrame, level: str, **filters: str) -> DataFrame:
    """Distinct non-blank values of a hierarchy level, sorted."""
    if level not in V.HIERARCHY:
        raise ValueError(f"unknown level {level!r}")
    values = filter_units(units, **filters).select(F.col(level).alias("option"))
    return values.filter(F.col("option") != "").distinct().orderBy("option")


def lookup_unit(units: DataFrame, kecamatan: str, kelurahan: str, rw: str, rt: str) -> DataFrame:
    return filter_units(units, kecamatan, kelurahan, rw, rt).orderBy("id_wilayah").limit(1)


def of_unit(df: DataFrame, id_wilayah: str) -> DataFrame:
    """Point lookup by id, pushed to the scan; used for latest, trend and forecast."""
    return df.filter(F.col("id_wilayah") == id_wilayah)


def unit_history(history: DataFrame, id_wilayah: str) -> DataFrame:
    return of_unit(history, id_wilayah).orderBy(F.desc("recorded_at"), F.desc("event_id"))


def priority_list(gold: DataFrame) -> DataFrame:
    return gold.orderBy(F.asc_nulls_last("prioritas_rank"), "id_wilayah")


def cluster_list(summary: DataFrame) -> DataFrame:
    return summary.orderBy("cluster_id")


def cluster_assignment(gold: DataFrame, cluster_id: int | None = None, kecamatan: str | None = None) -> DataFrame:
    return filter_clusters(gold, cluster_id, kecamatan).select(
        "id_wilayah", *V.AREA_KEYS, "risk_score", "risk_level", "cluster_id", "cluster_label"
    )


def forecast_named(forecast: DataFrame, gold: DataFrame) -> DataFrame:
    """Forecast rows with the names and level of their unit, '' when unknown."""
    names = ("kelurahan", "kecamatan", "risk_level")
    joined = forecast.join(gold.select("id_wilayah", *names), "id_wilayah", "left")
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit("")) for n in names})


def forecast_list(
    forecast: DataFrame,
    gold: DataFrame,
    trend: str | None = None,
    kecamatan: str | None = None,
    limit: int = 100,
    offset: int = 0,
) -> DataFrame:
    """Worst forecast first."""
    found = filter_forecast(forecast_named(forecast, gold), trend, kecamatan)
    return page(found, [F.desc_nulls_last("forecast_score"), "id_wilayah"], limit, offset)


def model_metrics(metrics: DataFrame, latest_only: bool = True) -> DataFrame:
    newest_first = metrics.orderBy(F.desc("trained_at"), F.desc("model_version"))
    return newest_first.limit(1) if latest_only else newest_first


def map_rows(units: DataFrame, gold: DataFrame) -> DataFrame:
    """Every unit with a usable geometry and its risk figures, 'Belum Didata' when never surveyed.

    Units that already carry their bounds are taken as they are.
    """
    known = [c for c in GOLD_PROPERTIES if c in gold.columns]
    located = units if "minx" in units.columns else normalize_geometry(units)
    located = located.filter(F.col("minx").isNotNull())
    joined = located.join(gold.select("id_wilayah", F.lit(True).alias("_found"), *known), "id_wilayah", "left")
    defaults = {"risk_level": V.NOT_SURVEYED, "top_faktor_1": "", "top_faktor_2": "", "top_faktor_3": "", "cluster_label": ""}
    filled = {
        name: F.when(F.col("_found"), F.col(name)).otherwise(F.lit(value)) for name, value in defaults.items() if name in known
    }
    return joined.withColumns(filled).drop("_found")


def map_layer(
    units: DataFrame,
    gold: DataFrame,
    bbox: tuple[float, float, float, float] | None = None,
    point: tuple[float, float] | None = None,
    ids: str | None = None,
    limit: int = 100,
    offset: int = 0,
) -> DataFrame:
    """One page of the map, nearest first when a (lat, lng) point is given.

    An id list overrides the viewport. Filters run on the units before the gold
    columns are joined.
    """
    if ids:
        units = filter_ids(units, ids)
    rows = map_rows(units, gold)
    if bbox and not ids:
        rows = bbox_filter(rows, *bbox)
    if point:
        return page(with_distance(rows, *point), ["distance_km", "id_wilayah"], limit, offset)
    return page(rows, ["id_wilayah"], limit, offset)


def summary_totals(units: DataFrame, gold: DataFrame, events: DataFrame, forecast: DataFrame) -> DataFrame:
    """One row of dashboard totals. Each table is reduced to one row, then the rows are added up."""
    slum = F.col("label_prediksi") == 1
    names = ("total_wilayah", "total_kumuh", "total_jiwa_terdampak", "total_survey_events", "total_forecasted")

    def part(df: DataFrame, **values: Column) -> DataFrame:
        return df.agg(*[F.coalesce(values.get(n, F.lit(0)), F.lit(0)).cast("long").alias(n) for n in names])

    rows = F.count(F.lit(1))
    parts = (
        part(units, total_wilayah=rows)
        .unionByName(
            part(
                gold,
                total_kumuh=F.count_if(slum),
                total_jiwa_terdampak=F.sum(F.when(slum, F.coalesce(F.col("jiwa_terdampak"), F.lit(0)))),
            )
        )
        .unionByName(part(events, total_survey_events=rows))
        .unionByName(part(forecast, total_forecasted=rows))
    )
    return parts.agg(*[F.sum(n).alias(n) for n in names])


def level_breakdown(gold: DataFrame) -> DataFrame:
    return gold.groupBy(F.coalesce("risk_level", F.lit(V.NOT_SURVEYED)).alias("risk_level")).agg(
        F.count(F.lit(1)).alias("n_units")
    )


def cluster_distribution(gold: DataFrame) -> DataFrame:
    return gold.filter(F.col("cluster_label") != "").groupBy("cluster_label").agg(F.count(F.lit(1)).alias("n_units"))


def forecast_trend_counts(forecast: DataFrame) -> DataFrame:
    """Count per trend label, the three labels always present, others ignored."""
    counted = forecast.agg(
        *[F.count_if(F.col("forecast_trend") == label).alias(label) for label in V.TREND_LABELS]
    )
    return counted.unpivot([], list(V.TREND_LABELS), "forecast_trend", "n_units")


def as_map(df: DataFrame, key: str, value: str, name: str = "breakdown") -> DataFrame:
    """A small keyed frame (one row per label) as one map value."""
    entries = F.sort_array(F.collect_list(F.struct(key, value)))
    return df.agg(F.map_from_entries(entries).alias(name))


def summary(units: DataFrame, gold: DataFrame, events: DataFrame, forecast: DataFrame) -> DataFrame:
    """The dashboard in one row: totals, and the three breakdowns as maps."""
    levels = as_map(level_breakdown(gold), "risk_level", "n_units").scalar()
    clusters = as_map(cluster_distribution(gold), "cluster_label", "n_units").scalar()
    trends = as_map(forecast_trend_counts(forecast), "forecast_trend", "n_units").scalar()
    return summary_totals(units, gold, events, forecast).select(
        "*",
        levels.alias("risk_level_breakdown"),
        clusters.alias("cluster_distribution"),
        trends.alias("forecast_trend_summary"),
    )


def avg_risk(gold: DataFrame) -> DataFrame:
    return gold.agg(F.avg(F.coalesce("risk_score", F.lit(0.0))).alias("avg_risk_score"))
