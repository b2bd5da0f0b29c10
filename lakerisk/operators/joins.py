"""Joins that stay even when one key holds a large share of the rows."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakerisk import vocabulary as V

# Bounds of the number of parts, and so of heavy keys: at most 10,000 rows of a hash and a count reach the driver.
LEAST_PARTS, MOST_PARTS = 64, 10_000


def shuffled(lookup: DataFrame) -> DataFrame:
    """``lookup`` as the side of a join that is never broadcast, for tables that grow with the units or the log.

    Spark broadcasts what is small on disk; files of 10 MB can hold hundreds of MB in memory, and all of it
    passes the driver.
    """
    return lookup.hint("merge")


def match_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool = False, few: bool = False) -> DataFrame:
    """Semi or anti join on keys, with NULL equal to NULL if ``null_safe``.

    ``few`` says that ``right`` has a row per area or partition at most, so that Spark may broadcast it."""
    other = right.select(*[F.col(k).alias(f"_o_{k}") for k in keys])
    other = other if few else shuffled(other)
    tests = [left[k].eqNullSafe(other[f"_o_{k}"]) if null_safe else left[k] == other[f"_o_{k}"] for k in keys]
    return left.join(other, reduce(and_, tests), how)


def _matched(rows: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: bool, extra: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Left join to ``other``, whose keys are named ``_k_<key>``; also on the ``extra`` pairs of equal columns."""
    tests = [rows[a] == other[b] for a, b in extra]
    for k in keys:
        tests.append(rows[k].eqNullSafe(other[f"_k_{k}"]) if null_safe else rows[k] == other[f"_k_{k}"])
    return rows.join(other, reduce(and_, tests), "left").drop(*[other[f"_k_{k}"] for k in keys])


def _named(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    return lookup.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in lookup.columns if c not in keys])


def split_parts(spark: SparkSession) -> int:
    """How many parts the rows of a join are thought to fall into; a key with more than one part's share is split."""
    return min(MOST_PARTS, max(LEAST_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def heavy_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """(keys, _copies) of the keys with more than one part's share of ``rows``; None if there are none.

    Keys are counted by a sketch of their hashes (approx_top_k, its error under a third of a
    part), in one pass over the key columns. At most ``split_parts`` hashes can hold such a
    share, so the list is bounded; their keys are found by one more pass, if there are any.
    """
    spark = rows.sparkSession
    parts = split_parts(spark)
    named = ", ".join(f"`{k}`" for k in keys)
    sketch = F.expr(f"approx_top_k(xxhash64({named}), {parts}, {16 * parts})")
    found = rows.agg(sketch.alias("top"), F.count(F.lit(1)).alias("n")).first()
    copies = {t["item"]: -(-t["count"] * parts // found["n"]) for t in found["top"] if t["count"] * parts > found["n"]}
    if not copies:
        return None
    listed = F.broadcast(spark.createDataFrame(list(copies.items()), "_hash long, _copies long"))
    hashed = rows.select(*keys, F.xxhash64(*keys).alias("_hash")).join(listed, "_hash")
    return hashed.select(*keys, "_copies").distinct()


def lookup_left(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    salt_from: Sequence[str],
    null_safe: bool = False,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Left join of many rows to a lookup with unique keys.

    ``heavy`` lists the keys (with ``_copies``) that hold too many rows for one task, as
    ``heavy_keys`` finds them: only their lookup rows are repeated, and each of their rows
    picks one copy by the hash of ``salt_from``. The salt is a hash, never random, so a re-run
    task makes the same choice. Without ``heavy`` it is a plain join.
    """
    right = _named(lookup, keys)
    if heavy is None:
        return _matched(rows, shuffled(right), keys, True) if null_safe else rows.join(shuffled(lookup), list(keys), "left")
    listed = F.broadcast(_named(heavy, keys))
    left = _matched(rows, listed, keys, null_safe)
    salt = F.when(F.col("_copies").isNotNull(), F.pmod(F.xxhash64(*salt_from), F.col("_copies"))).otherwise(F.lit(0))
    left = left.withColumn("_salt", salt).drop("_copies")
    copied = _matched(lookup, listed, keys, null_safe)
    numbers = F.sequence(F.lit(0).cast("long"), F.coalesce("_copies", F.lit(1)) - 1)
    copied = copied.withColumn("_copy", F.explode(numbers)).drop("_copies")
    return _matched(left, shuffled(_named(copied, keys)), keys, null_safe, [("_salt", "_copy")]).drop("_salt", "_copy")


def scope_by_keys(df: DataFrame, keys: DataFrame, on: Sequence[str] = ("id_wilayah",)) -> DataFrame:
    """Rows whose key is in ``keys``; ``None`` keeps all (a full run)."""
    if keys is None:
        return df
    return df.join(shuffled(keys.select(*on).distinct()), list(on), "left_semi")


def scope_by_area(latest: DataFrame, areas: DataFrame) -> DataFrame:
    """Rows of the given (kelurahan, kecamatan) areas, the unregistered NULL area included."""
    return match_rows(latest, areas.distinct(), V.AREA_KEYS, "left_semi", null_safe=True, few=True)


def affected_ids(*frames: DataFrame, key: str = "id_wilayah") -> DataFrame:
    """Distinct union of key sets, NULL and blank keys left out."""
    merged = reduce(DataFrame.unionByName, [f.select(key).distinct() for f in frames])
    return merged.filter(F.col(key) != "").distinct()


def register_units(existing: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split incoming units into (new, already registered) by id.

    Of rows that offer one id the first by content is new; the others count as registered.
    """
    known = shuffled(existing.select("id_wilayah").distinct())
    offers = Window.partitionBy("id_wilayah").orderBy(F.to_json(F.struct(*incoming.columns)))
    numbered = incoming.withColumn("_offer", F.row_number().over(offers))
    first, again = numbered.filter("_offer = 1").drop("_offer"), numbered.filter("_offer > 1").drop("_offer")
    return (
        first.join(known, "id_wilayah", "left_anti"),
        first.join(known, "id_wilayah", "left_semi").unionByName(again),
    )
