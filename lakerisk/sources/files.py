"""CSV input, JSON message streams, and CSV / GeoJSON output."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk import schemas
from lakerisk import vocabulary as V
from lakerisk.functions import text as X
from lakerisk.operators.quality import conform_secondary


def numbered_rows(rows: DataFrame, name: str = "row_number") -> DataFrame:
    """Rows read from files with their place in their file, from 0, however the files were split.

    Row ids rise inside a block of a file; the counts of a file's earlier blocks, one row per block,
    are added.
    """
    block = ["_file", "_start"]
    at = rows.withColumns({"_file": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start"), "_id": F.monotonically_increasing_id()})
    blocks = at.groupBy(*block).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(*block, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return at.join(offsets, block).withColumn(name, F.col("_id") + F.col("_shift")).select(*rows.columns, name)


def read_secondary_csv(spark: SparkSession, path: str, source_type: str, idempotency_key: str | None = None) -> DataFrame:
    """One of the four secondary CSV layouts in the common secondary schema.

    batch_id is made of the upload's ``idempotency_key`` and the row's place in its file, or without a
    key of the record's content, so that the same row read again, in any order or partition,
    gets the same id.
    """
    if source_type not in V.SECONDARY_TYPES:
        raise ValueError(f"unknown source_type {source_type!r}")
    rows = spark.read.csv(path, header=True, schema=schemas.SECONDARY_CSV[source_type])
    if idempotency_key:
        rows = numbered_rows(rows, "_row")
    raw = rows.withColumn("raw_data", F.to_json(F.struct(*[c for c in rows.columns if c != "_row"]), X.JSON_OPTIONS))
    raw = raw.withColumn("source_type", F.lit(source_type))
    if "tahun" in raw.columns:
        raw = raw.withColumnRenamed("tahun", "tahun_data")
    content = [F.col("source_type"), F.col("raw_data")]
    if idempotency_key:
        content = [F.lit(idempotency_key), F.col("_row").cast("string")]
    content = F.concat_ws(":", F.lit("secondary"), *content)
    stamped = raw.withColumns(
        {
            "batch_id": X.uuid5(X.NAMESPACE_URL, content),
            "accepted_at": F.current_timestamp(),
            "ingested_at": F.current_timestamp(),
        }
    )
    return conform_secondary(stamped)


def read_events(spark: SparkSession, source: str, table: T.StructType, topic: str | None = None) -> DataFrame:
    """Streaming messages of one table, as text fields plus _corrupt_record.

    ``source`` is a folder of JSON-lines files, or with ``topic`` the bootstrap
    servers of a Kafka cluster (needs the Kafka connector on the classpath).
    """
    schema = schemas.message_schema(table).add("_corrupt_record", T.StringType())
    if topic is None:
        return spark.readStream.schema(schema).option("columnNameOfCorruptRecord", "_corrupt_record").json(source)
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", source)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = F.from_json(F.col("value").cast("string"), schema, options)
    return messages.select(parsed.alias("_m")).select("_m.*")


def priority_report(gold: DataFrame) -> DataFrame:
    """Priority table as display text, one column per CSV column."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    return gold.select(
        shown("prioritas_rank").alias("peringkat"),
        shown("id_wilayah").alias("id_wilayah"),
        shown("kelurahan").alias("kelurahan"),
        shown("kecamatan").alias("kecamatan"),
        X.fmt_score(F.col("risk_score")).alias("skor_risiko"),
        shown("risk_level").alias("tingkat_risiko"),
        X.fmt_pct(F.col("proba_kumuh")).alias("probabilitas_kumuh"),
        F.coalesce(F.col("jiwa_terdampak").cast("string"), F.lit("0")).alias("jiwa"),
        shown("cluster_label").alias("cluster"),
        *[shown(f"top_faktor_{i}").alias(f"faktor_{i}") for i in (1, 2, 3)],
    )


# Header row of the report, in column order.
REPORT_HEADER = (
    "Peringkat",
    "ID Wilayah",
    "Kelurahan",
    "Kecamatan",
    "Skor Risiko",
    "Tingkat Risiko",
    "Probabilitas Kumuh",
    "Jiwa",
    "Cluster",
    "Faktor 1",
    "Faktor 2",
    "Faktor 3",
)


def write_priority_csv(gold: DataFrame, path: str) -> None:
    report = priority_report(gold.orderBy(F.asc_nulls_last("prioritas_rank"), "id_wilayah"))
    report.toDF(*REPORT_HEADER).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def to_geojson_features(layer: DataFrame, geometry: str = "geometry") -> DataFrame:
    """id_wilayah and the GeoJSON Feature text of every row that has a geometry."""
    hidden = {geometry, "minx", "miny", "maxx", "maxy", "geometry_error"}
    props = F.to_json(F.struct(*[c for c in layer.columns if c not in hidden]), {"ignoreNullFields": "false"})
    feature = F.concat(
        F.lit('{"type":"Feature","geometry":'), F.col(geometry), F.lit(',"properties":'), props, F.lit("}")
    )
    return layer.filter(F.col(geometry).isNotNull()).select("id_wilayah", feature.alias("feature"))


def write_geojson(layer: DataFrame, path: str) -> None:
    """Line-delimited GeoJSON features."""
    to_geojson_features(layer).select("feature").write.mode("overwrite").text(path)
