"""Matching free-text place requests to registered units."""

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.functions.text import norm_text
from lakerisk.operators.geo import with_bounds
from lakerisk.operators.joins import heavy_keys, lookup_left, split_parts
from lakerisk.vocabulary import HIERARCHY

# Points for an equal field.
FIELD_POINTS = {"kecamatan": 2, "kelurahan": 4, "rw": 3, "rt": 5}


def _field_sets() -> list[tuple[str, ...]]:
    return [s for n in range(1, len(HIERARCHY) + 1) for s in combinations(HIERARCHY, n)]


def match_units(requests: DataFrame, units: DataFrame) -> DataFrame:
    """Best unit of each request (request_id, id_wilayah, match_score), ties to the smallest id.

    A unit's score depends only on which of the four fields agree, so the best
    unit agrees on some set of fields and is the smallest id among the units
    that do. Units are reduced to that id for each of the 15 sets and each
    combination of values; a request looks up its 15 entries. No request-unit
    pairs are formed, even where a third of the units share a district.
    """
    fields = list(HIERARCHY)
    sets = _field_sets()
    usable = with_bounds(units, "geometry_wkt").filter(F.col("minx").isNotNull())
    names = usable.select("id_wilayah", *[F.nullif(norm_text(F.col(f)), F.lit("")).alias(f) for f in fields])
    # Each unit becomes a row per set, sorted to find the smallest id: dealt out first, however few files hold the units.
    names = names.repartition(split_parts(units.sparkSession), "id_wilayah")
    # grouping_id() sets bit i (from the left) when field i is left out of the set.
    best = (
        names.groupingSets([[F.col(f) for f in s] for s in sets], *fields)
        .agg(F.grouping_id().cast("int").alias("_set"), F.min("id_wilayah").alias("_candidate"))
        .select("_set", *fields, "_candidate")
    )

    def set_number(s: tuple[str, ...]) -> int:
        return sum(1 << (len(fields) - 1 - i) for i, f in enumerate(fields) if f not in s)

    asked = requests.select("request_id", *[F.nullif(norm_text(F.col(f)), F.lit("")).alias(f) for f in fields])
    asked = asked.filter(F.col("kecamatan").isNotNull() | F.col("kelurahan").isNotNull())
    probes = F.filter(
        F.array(
            *[
                F.when(
                    F.array_size(F.array_compact(F.array(*s))) == len(s),
                    F.struct(
                        F.lit(set_number(s)).alias("_set"),
                        *[(F.col(f) if f in s else F.lit(None).cast("string")).alias(f) for f in fields],
                        F.lit(sum(FIELD_POINTS[f] for f in s)).alias("_points"),
                    ),
                )
                for s in sets
            ]
        ),
        lambda p: p.isNotNull(),
    )
    lookups = asked.select("request_id", F.explode(probes).alias("_p")).select("request_id", "_p.*")
    keys = ["_set", *fields]
    found = lookup_left(lookups, best, keys, salt_from=["request_id"], null_safe=True, heavy=heavy_keys(lookups, keys))
    hits = found.filter(F.col("_candidate").isNotNull())
    top = F.min(F.struct(-F.col("_points"), "_candidate")).alias("_top")
    return hits.groupBy("request_id").agg(top).select(
        "request_id", F.col("_top._candidate").alias("id_wilayah"), (-F.col("_top.col1")).alias("match_score")
    )
