"""Upserts as DataFrame algebra over plain Parquet tables."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.operators.joins import match_rows


def align_schema(df: DataFrame, target_schema: T.StructType) -> DataFrame:
    """Target columns first and in order, absent ones as typed NULLs; extra columns stay."""
    known = [
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in target_schema
    ]
    extra = [c for c in df.columns if c not in target_schema.fieldNames()]
    return df.select(*known, *extra)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, or ValueError naming one repeated key. NULL keys never match, so they may repeat."""
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    repeated = duplicate_keys(df.filter(complete), keys).limit(1).collect()
    if repeated:
        raise ValueError(f"several source rows for key {repeated[0].asDict()}")
    return df


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_matches: bool = True,
    null_safe: bool = False,
) -> DataFrame:
    """Target after merging ``source`` by key.

    Matching target rows are replaced, a column absent from the source turning
    NULL. With ``update_matches=False`` they stay and only new keys come in.
    """
    aligned = align_schema(source, target.schema)
    if update_matches:
        return match_rows(target, source, keys, "left_anti", null_safe).unionByName(aligned, allowMissingColumns=True)
    return target.unionByName(match_rows(aligned, target, keys, "left_anti", null_safe), allowMissingColumns=True)
