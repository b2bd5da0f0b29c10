"""Index of the ids a stored table holds, so that an insert reads only what can match.

Ids lie in folders by their hash. Beside each folder lies a filter: one bit per hash
position, in pieces of 32768 bits as rows. An id whose bit is not set in its folder's
filter is new without reading any id; only folders that may hold one of the asked ids are read.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.operators.joins import match_rows, shuffled
from lakerisk.sources import tables

PIECE_SHIFT = 15
IDS_PER_FOLDER = 1 << 20
FEWEST, MOST = 16, 1024
BITS_PER_ID = 16


def _power(n: float) -> int:
    """Smallest power of two that is at least ``n``."""
    return 1 << max(0, int(n - 1).bit_length() if n > 1 else 0)


def _folder(key: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(folders)).cast("int")


def _placed(ids: DataFrame, folders: int, bits: int) -> DataFrame:
    """id with its folder, piece of the filter and bit in the piece."""
    position = F.pmod(F.xxhash64(F.lit("bit"), F.col("id")), F.lit(bits))
    placed = ids.withColumns({"folder": _folder(F.col("id"), folders), "_p": position})
    return placed.withColumns({"piece": F.shiftright("_p", PIECE_SHIFT), "bit": F.col("_p").bitwiseAND((1 << PIECE_SHIFT) - 1).cast("int")}).drop("_p")


def _layout(spark: SparkSession, path: str) -> tuple[int, int]:
    row = tables.read_table(spark, f"{path}/layout").first()
    return row["folders"], row["bits"]


def _store(spark: SparkSession, path: str, ids: DataFrame, batch: str, layout: tuple[int, int], mode: str) -> None:
    placed = _placed(ids, *layout)
    rows = placed.select("id", F.lit(batch).alias("batch"), "folder").repartition("folder").sortWithinPartitions("folder", "id")
    pieces = placed.groupBy("folder", "piece").agg(F.bitmap_construct_agg("bit").alias("bits"))
    pieces = pieces.repartition("folder").sortWithinPartitions("folder", "piece")
    tables.together(
        lambda: rows.write.mode(mode).partitionBy("folder").parquet(f"{path}/ids"),
        lambda: pieces.write.mode(mode).partitionBy("folder").parquet(f"{path}/filter"),
    )


def build(spark: SparkSession, path: str, ids: DataFrame, batch: str = "") -> None:
    """Write the index anew for the non-null values of the one column of ``ids``.

    Folders and filter bits are sized for the ids there are; an index that has grown many times
    over stays right but skips fewer folders until it is built again.
    """
    rows = tables.staged(spark, ids.toDF("id").filter(F.col("id").isNotNull()), "ids")
    n = rows.count()
    folders = min(MOST, max(FEWEST, _power(n / IDS_PER_FOLDER)))
    bits = max(1 << PIECE_SHIFT, _power(BITS_PER_ID * n / folders))
    _store(spark, path, rows, batch, (folders, bits), "overwrite")
    spark.range(1).select(F.lit(folders).alias("folders"), F.lit(bits).cast("long").alias("bits")).write.mode("overwrite").parquet(f"{path}/layout")


def exists(spark: SparkSession, path: str) -> bool:
    return tables.table_exists(spark, f"{path}/layout")


def add(spark: SparkSession, path: str, ids: DataFrame, batch: str = "") -> None:
    """Add ids that the index does not hold."""
    _store(spark, path, ids.toDF("id").filter(F.col("id").isNotNull()), batch, _layout(spark, path), "append")


def _folders_of(rows: DataFrame) -> list[int]:
    """Numbers of the folders of some rows, at most ``MOST``."""
    return [row["folder"] for row in rows.select("folder").distinct().collect()]


def candidates(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """(id, folder) of the ids that the filter does not rule out."""
    placed = _placed(ids.toDF("id").filter(F.col("id").isNotNull()).distinct(), *_layout(spark, path))
    schema = "piece long, bits binary, folder int"
    pieces = spark.read.schema(schema).parquet(f"{path}/filter").filter(F.col("folder").isin(_folders_of(placed)))
    pieces = pieces.withColumnsRenamed({"folder": "_folder", "piece": "_piece"})
    byte = F.conv(F.hex(F.expr("substring(bits, shiftright(bit, 3) + 1, 1)")), 16, 10).cast("long")
    is_set = F.getbit(byte, F.col("bit").bitwiseAND(7)) == 1
    met = (F.col("folder") == F.col("_folder")) & (F.col("piece") == F.col("_piece")) & is_set
    return placed.join(shuffled(pieces), met, "left_semi").select("id", "folder")


def find(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame | None:
    """(id, batch) of those of ``ids`` that the index holds, None if the filter rules out all of
    them; reads the folders of possible matches only."""
    possible = tables.staged(spark, candidates(spark, path, ids), "possible")
    folders = _folders_of(possible)
    if not folders:
        return None
    stored = spark.read.schema(f"id {ids.dtypes[0][1]}, batch string, folder int").parquet(f"{path}/ids")
    return stored.filter(F.col("folder").isin(folders)).join(shuffled(possible), ["folder", "id"]).select("id", "batch")


def name_of(rows: DataFrame, key: str) -> str:
    """A name for a set of keys, the same whenever the set is."""
    of = rows.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(key)).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), key)).alias("y")).first()
    return f"{of['n']}-{of['x']}-{of['y']}"


def insert_new(
    spark: SparkSession,
    table: str,
    index: str,
    rows: DataFrame,
    key: str,
    batch: str | None = None,
    partition_cols: Sequence[str] = (),
    sort_cols: Sequence[str] = (),
    stored_rows: bool = False,
) -> DataFrame:
    """Append the rows whose key the table does not hold, one row per key expected; returns them.

    The table is not read: the index says which keys are known. A call that is repeated with
    the same ``batch`` name (by default one made of the keys) after a failure finishes
    the first one: it returns the same rows and stores each once. Rows without a key are left out.
    ``stored_rows`` says that the rows are read from files and need not be written first.
    """
    rows = rows.filter(F.col(key).isNotNull())
    rows = rows if stored_rows else tables.staged(spark, rows, "rows")
    batch = batch or name_of(rows, key)
    if not exists(spark, index):
        stored = tables.read_table(spark, table).select(key) if tables.table_exists(spark, table) else rows.select(key).limit(0)
        build(spark, index, stored)
    found = find(spark, index, rows.select(key))
    fresh = new = rows
    held = {"known": 0, "mine": 0}
    if found is not None:
        found = tables.staged(spark, found.withColumnRenamed("id", key), "found")
        mine = F.col("batch") == batch
        held = found.agg(F.count_if(~mine).alias("known"), F.count_if(mine).alias("mine")).first()
        if held["known"]:
            fresh = new = tables.staged(spark, match_rows(rows, found.filter(~mine), [key], "left_anti"), "fresh")
        if held["mine"]:
            new = match_rows(fresh, found.filter(mine), [key], "left_anti")
    # Keys are in the index before rows are in the table, so that a failure between leaves a trace.
    add(spark, index, new.select(key), batch)
    if held["mine"] and tables.table_exists(spark, table):
        tables.merge_table(spark, table, fresh, [key], partition_cols, update_matches=False, keys_move=False, sort_cols=sort_cols)
    else:
        tables.append_sorted(fresh, table, partition_cols, sort_cols)
    return fresh
