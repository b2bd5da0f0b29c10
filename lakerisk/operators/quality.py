"""Typing, defaults, validation and raw-record keeping for incoming rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk import schemas
from lakerisk import vocabulary as V
from lakerisk.functions.text import JSON_OPTIONS, parse_ts


def _typed(df: DataFrame, field: T.StructField) -> Column:
    """The field of ``df`` in its target type; a bad or absent value is NULL."""
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    col = F.col(field.name)
    if isinstance(field.dataType, T.TimestampType) and dict(df.dtypes)[field.name] == "string":
        return parse_ts(col)
    if isinstance(field.dataType, T.StringType):
        return col.cast("string")
    return col.try_cast(field.dataType)


def _default(data_type: T.DataType) -> Column | None:
    if isinstance(data_type, T.IntegerType | T.LongType):
        return F.lit(0)
    if isinstance(data_type, T.BooleanType):
        return F.lit(False)
    if isinstance(data_type, T.StringType):
        return F.lit("")
    return None


def _conform(df: DataFrame, schema: T.StructType, defaulted: Sequence[str]) -> DataFrame:
    columns = []
    for field in schema:
        value = _typed(df, field)
        default = _default(field.dataType) if field.name in defaulted else None
        columns.append((value if default is None else F.coalesce(value, default)).alias(field.name))
    return df.select(*columns)


def conform_survey(df: DataFrame) -> DataFrame:
    """Survey columns in order and type; absent scores and counts 0, flags false, texts ''."""
    required = ("event_id", "id_wilayah", "recorded_at")
    return _conform(df, schemas.SURVEY, [f.name for f in schemas.SURVEY if f.name not in required])


def conform_secondary(df: DataFrame) -> DataFrame:
    """Secondary columns in order and type; absent numbers stay NULL, absent texts are ''."""
    texts = ("id_wilayah", "kelurahan", "kecamatan", "sumber_label", "tanggal_label")
    return _conform(df, schemas.SECONDARY, texts)


def with_raw_json(df: DataFrame, name: str = "raw_data") -> DataFrame:
    return df.withColumn(name, F.to_json(F.struct(*df.columns), JSON_OPTIONS))


def survey_reasons(df: DataFrame) -> Column:
    """What is wrong with a survey row: missing required fields, scores outside 0..3."""
    checks = []
    for name in ("id_wilayah", *V.INDICATORS):
        checks.append(F.when(F.col(name).isNull(), F.lit(f"{name} missing")))
    for name in V.INDICATORS:
        checks.append(F.when(~F.col(name).between(0, V.MAX_INDICATOR_SCORE), F.lit(f"{name} out of range")))
    return F.array_compact(F.array(*checks))


def validate_survey(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reasons)"""
    checked = df.withColumn("reasons", survey_reasons(df))
    valid = checked.filter(F.size("reasons") == 0).drop("reasons")
    return valid, checked.filter(F.size("reasons") > 0)


def union_aligned(*frames: DataFrame) -> DataFrame:
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged
