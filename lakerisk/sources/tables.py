"""Parquet tables addressed by path.

Once a column joins a table, the folder ``<path>-schemas`` beside it holds the grown schemas, each
named by its hash. Readers take their union, so a column that came later is read from all files,
as NULL where a file lacks it, without reading their footers.
"""

import hashlib
import json
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import and_, or_

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.operators.joins import match_rows
from lakerisk.operators.scoring import present
from lakerisk.operators.upsert import align_schema, assert_unique, upsert
from lakerisk.session import scratch_path


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    merge_schema: bool = False,
    text: Sequence[str] = (),
) -> DataFrame:
    """Table scan with the given schema, else that of a file and all columns recorded since.

    With a schema no footer is read for planning. For files that others wrote,
    ``merge_schema`` unites the schemas of all of them, which reads every footer.

    ``text`` names partition columns to read as the strings they are, where
    Spark would guess a type from their values.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    guessed = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    grown = stored_schema(spark, path)
    schema = guessed.schema if grown is None else merged_schema(grown, _plain(guessed.schema))
    if grown is None and all(isinstance(f.dataType, T.StringType) for f in schema if f.name in text):
        return guessed
    exact = [T.StructField(f.name, T.StringType()) if f.name in text else f for f in schema]
    return spark.read.schema(T.StructType(exact)).parquet(path)


#: Number types in the order in which one takes in the other.
_WIDER = ["int", "bigint", "double"]


def merged_schema(*schemas: T.StructType) -> T.StructType:
    """Columns of all schemas, in the order of their first appearance; whole numbers widen to
    long and numbers to double where schemas differ. ValueError for types that cannot be united."""
    merged: dict[str, T.DataType] = {}
    for field in (f for schema in schemas for f in schema):
        before = merged.setdefault(field.name, field.dataType)
        kinds = before.simpleString(), field.dataType.simpleString()
        if kinds[0] != kinds[1]:
            if not set(kinds) <= set(_WIDER):
                raise ValueError(f"column {field.name} was {kinds[0]} and is now {kinds[1]}")
            merged[field.name] = before if _WIDER.index(kinds[0]) > _WIDER.index(kinds[1]) else field.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in merged.items()])


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Union of the schemas appended to the table at ``path``; None if none was recorded."""
    try:
        rows = spark.read.schema("value STRING").option("recursiveFileLookup", "true").text(f"{path}-schemas").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # Oldest first, so that columns keep their place.
    found = sorted((json.loads(row["value"]) for row in rows), key=lambda entry: entry["at"])
    return merged_schema(*[T.StructType.fromJson(entry["schema"]) for entry in found]) if found else None


def _plain(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def record_schema(df: DataFrame, path: str, replace: bool = False) -> None:
    """Store the schema of ``df`` beside the table at ``path`` if it has more than the table so far.

    A table whose files all have one schema needs no record; with ``replace``, the files are written
    anew, and a record of earlier ones is replaced.
    """
    spark, schema = df.sparkSession, _plain(df.schema)
    before = stored_schema(spark, path)
    if replace:
        merged = schema if before is not None and before != schema else None
    else:
        before = before or _found_schema(spark, path)
        merged = merged_schema(before, schema) if before is not None else None
        if merged == before:
            merged = None
    if merged is None:
        return
    name = hashlib.sha256(merged.json().encode()).hexdigest()[:16]
    entry = json.dumps({"at": time.time(), "schema": merged.jsonValue()})
    where = f"{path}-schemas" if replace else f"{path}-schemas/{name}"
    spark.range(1).select(F.lit(entry).alias("value")).coalesce(1).write.mode("overwrite" if replace else "ignore").text(where)


def _found_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema of one of the table's files, without partition columns; None if there is no table."""
    try:
        return _plain(spark.read.option("recursiveFileLookup", "true").parquet(path).schema)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An append-only table whose files lie in its folder and in folders per batch.

    All of them are read, whoever wrote them, with the columns of ``schema`` and those appended
    since; columns that a file lacks are NULL.
    """
    grown = stored_schema(spark, path)
    schema = merged_schema(schema, grown) if grown is not None else schema
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty frame of the same schema when it was never written."""
    if table_exists(spark, path):
        return read_table(spark, path, schema)
    return spark.createDataFrame([], schema)


def append_table(df: DataFrame, path: str) -> None:
    """Append; new columns are allowed and read as NULL from older files."""
    record_schema(df, path)
    df.write.mode("append").parquet(path)


def append_sorted(
    df: DataFrame, path: str, partition_cols: Sequence[str] = (), sort_cols: Sequence[str] = ()
) -> None:
    """Append to a table that is partitioned and sorted by those of the columns that exist."""
    cols, order = present(df, partition_cols), present(df, sort_cols)
    rows = _balanced(df, cols)
    record_schema(df.drop(*cols), path)
    writer = (rows.sortWithinPartitions(*cols, *order) if order else rows).write.mode("append")
    (writer.partitionBy(*cols) if cols else writer).parquet(path)


def _balanced(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows grouped by output partition with even file sizes: AQE splits a large
    partition over several tasks and merges small ones."""
    return df.hint("rebalance", *partition_cols) if partition_cols else df.hint("rebalance")


def _write(df: DataFrame, path: str, partition_cols: Sequence[str], sort_cols: Sequence[str], mode: str) -> None:
    rows = _balanced(df, partition_cols)
    if sort_cols:
        rows = rows.sortWithinPartitions(*partition_cols, *sort_cols)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", mode)
    record_schema(df.drop(*partition_cols), path, replace=mode == "static")
    (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(path)


def write_table(
    df: DataFrame, path: str, partition_cols: Sequence[str] = (), sort_cols: Sequence[str] = ()
) -> None:
    """Replace the table, partitioned by those of the columns that exist.

    Files sorted by a column that queries filter on let the scan skip row groups.
    """
    _write(df, path, present(df, partition_cols), present(df, sort_cols), "static")


def together(*jobs: Callable[[], object]) -> list:
    """Results of jobs that do not depend on each other, run side by side on the driver's threads;
    Spark shares its executors among them. The first error is raised once all have ended."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(SparkSession.active())(job)) for job in jobs]
    return [job.result() for job in running]


def staged(spark: SparkSession, df: DataFrame, name: str = "staged") -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed once
    however often it is used, and safe from lost executors."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


MAX_PRUNED = 1000


def _in_partitions(target: DataFrame, touched: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Target rows in the touched partitions. Up to MAX_PRUNED of them become a
    filter that prunes the scan; beyond that they are joined."""
    few = touched.limit(MAX_PRUNED + 1).collect()
    if len(few) > MAX_PRUNED:
        return match_rows(target, touched, cols, "left_semi", null_safe=True, few=True)
    tests = [reduce(and_, [F.col(c).eqNullSafe(F.lit(row[c])) for c in cols]) for row in few]
    return target.filter(reduce(or_, tests, F.lit(False)))


def merge_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_cols: Sequence[str] = (),
    update_matches: bool = True,
    null_safe: bool = False,
    unique_source: bool = False,
    keys_move: bool = True,
    sort_cols: Sequence[str] = (),
    stored_source: bool = False,
) -> None:
    """Upsert ``source`` into the table at ``path``, creating it if needed.

    Insert-only merges append. Updates of a partitioned table rewrite only the
    partitions that hold a matched or new key. ``unique_source`` says the keys
    are unique by construction and skips the check, ``stored_source`` that it
    reads stored rows and need not be written first. ``keys_move=False`` says a
    key's rows lie in the source's partitions or the NULL partition, so others
    are not searched.
    """
    if not table_exists(spark, path):
        write_table(source, path, partition_cols, sort_cols)
        return
    source = source if stored_source else staged(spark, source, "source")
    if source.isEmpty():
        return
    text = [c for c in partition_cols if c in source.columns and isinstance(source.schema[c].dataType, T.StringType)]
    target = read_table(spark, path, text=text)
    cols, order = present(target, partition_cols), present(target, sort_cols)
    if update_matches and not unique_source:
        assert_unique(source, keys)

    touched = None
    if cols:
        nowhere = spark.range(1).select(*[F.lit(None).cast(target.schema[c].dataType).alias(c) for c in cols])
        if keys_move:
            homes = match_rows(target, source, keys, "left_semi", null_safe).select(*cols)
        else:
            homes = nowhere
        touched = source.select(*cols).unionByName(homes).distinct()

    if not update_matches:
        searched = target if keys_move or not cols else _in_partitions(target, touched, cols)
        aligned = align_schema(source, target.schema)
        append_sorted(match_rows(aligned, searched, keys, "left_anti", null_safe), path, cols, order)
        return
    # The result reads the table it replaces, so it is staged first.
    if not cols:
        _write(staged(spark, upsert(target, source, keys, True, null_safe)), path, (), order, "static")
        return
    merged = staged(spark, upsert(_in_partitions(target, touched, cols), source, keys, True, null_safe))
    # A partition that lost its last row has nothing to overwrite it with.
    occupied = match_rows(target.select(*cols).distinct(), touched, cols, "left_semi", null_safe=True, few=True)
    if match_rows(occupied, merged.select(*cols).distinct(), cols, "left_anti", null_safe=True, few=True).isEmpty():
        _write(merged, path, cols, order, "dynamic")
    else:
        _write(staged(spark, upsert(target, source, keys, True, null_safe)), path, cols, order, "static")


def with_ingest_time(df: DataFrame, name: str = "ingested_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())
