"""The given tables seen as survey log, unit registry, labels and secondary data.

Each view is a list of (expression, name) pairs that Spark SQL and ANSI engines
both evaluate, so a checker can build the same inputs. Views keep every row.
"""

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk import vocabulary as V

SURVEY = [
    ("cast(event_id as varchar(20))", "event_id"),
    ("cast(user_id as varchar(20))", "id_wilayah"),
    ("ts", "recorded_at"),
    ("event_type", "recorded_by"),
    *[
        (
            f"case when event_id % 97 = {k} then null "
            f"else cast((user_id % 4 + event_id % {k + 2}) % 4 as int) end",
            name,
        )
        for k, name in enumerate(V.INDICATORS)
    ],
    ("cast(user_id * 11 % 200 + 20 as int)", "jumlah_kk"),
    ("cast(user_id * 37 % 900 + 100 as int)", "jumlah_jiwa"),
    ("event_id % 6 > 0", "pernah_banjir"),
    ("cast(event_id % 6 as int)", "frekuensi_banjir"),
    ("case user_id % 3 when 0 then 'rendah' when 1 then 'menengah' else 'tinggi' end", "sosek_dominan"),
    ("props", "catatan"),
]

# Corner coordinates in 1/10000 degree, so that text and numbers agree exactly.
_X, _Y = "(1126000 + c_custkey * 7919 % 2000)", "(73500 - c_custkey * 104729 % 1500)"


def _lng(offset: int = 0) -> str:
    return f"concat('112.', substr(cast({_X} + {offset} as varchar(20)), 4))"


def _lat(offset: int = 0) -> str:
    return f"concat('-7.', substr(cast({_Y} + {offset} as varchar(20)), 2))"


def _ring(shift: int = 0) -> str:
    """Text of a closed square of side 30 whose west and north edges sit at the corner plus shift."""
    corners = [(0, 0), (30, 0), (30, -30), (0, -30), (0, 0)]
    points = [f"'[', {_lng(x + shift)}, ',', {_lat(y)}, ']'" for x, y in corners]
    return "concat('[', " + ", ',', ".join(points) + ", ']')"


_POINT = f"""concat('{{"type":"Point","coordinates":[', {_lng()}, ',', {_lat()}, ']}}')"""
_POLYGON = f"""concat('{{"type":"Polygon","coordinates":[', {_ring()}, ']}}')"""
_MULTI = f"""concat('{{"type":"MultiPolygon","coordinates":[[', {_ring()}, '],[', {_ring(100)}, ']]}}')"""

# How geometries are told apart: missing, broken text and an unsupported type
# occur next to the three supported types.
GEOMETRY_KIND = (
    "case when c_custkey % 50 = 49 then 'missing' when c_custkey % 50 = 48 then 'broken' "
    "when c_custkey % 50 = 47 then 'line' when c_custkey % 5 = 0 then 'point' "
    "when c_custkey % 5 = 1 then 'multi' else 'polygon' end"
)

UNITS = [
    ("cast(c_custkey as varchar(20))", "id_wilayah"),
    ("'Surabaya'", "kota"),
    ("r_name", "kecamatan"),
    ("n_name", "kelurahan"),
    ("lpad(cast(c_custkey % 17 + 1 as varchar(20)), 2, '0')", "rw"),
    ("lpad(cast(c_custkey % 23 + 1 as varchar(20)), 3, '0')", "rt"),
    ("cast(c_custkey * 11 % 200 + 20 as bigint)", "total_kk"),
    ("cast(c_custkey * 37 % 900 + 100 as bigint)", "total_jiwa"),
    ("cast(c_custkey % 30 * 1000 as double)", "luas_m2"),
    (
        f"case {GEOMETRY_KIND} when 'missing' then null when 'broken' then 'POINT (112 -7)' "
        f"""when 'line' then '{{"type":"LineString","coordinates":[[112,-7],[113,-7]]}}' """
        f"when 'point' then {_POINT} when 'multi' then {_MULTI} else {_POLYGON} end",
        "geometry_wkt",
    ),
]

# Two label versions per unit; the later one holds.
GROUND_TRUTH = [
    ("concat(cast(c_custkey as varchar(20)), '-', cast(version as varchar(20)))", "batch_id"),
    ("'ground_truth'", "source_type"),
    ("cast(c_custkey as varchar(20))", "id_wilayah"),
    ("case when (c_custkey + 2 * version) % 4 >= 2 then 1 else 0 end", "label_kumuh"),
    ("c_mktsegment", "sumber_label"),
    ("concat('2024-01-', lpad(cast(c_custkey % 28 + 1 as varchar(20)), 2, '0'))", "tanggal_label"),
    ("cast(concat('2024-02-0', cast(version + 1 as varchar(20)), ' 00:00:00') as timestamp)", "ingested_at"),
]

SECONDARY = {
    "bps": [
        ("n_name", "kelurahan"),
        ("cast(n_nationkey * 137 % 20000 + 0.5e0 as double)", "kepadatan_jiwa_per_km2"),
        ("2024", "tahun_data"),
    ],
    "bmkg": [("n_name", "kelurahan"), ("cast(n_nationkey % 5 as int)", "jumlah_kejadian_banjir"), ("2023", "tahun")],
    "pdam": [("n_name", "kelurahan"), ("cast(60 + n_nationkey % 40 as double)", "pct_akses_air_bersih")],
}


def exprs(pairs: list[tuple[str, str]]) -> list[str]:
    return [f"{expr} as {name}" for expr, name in pairs]


@lru_cache(maxsize=256)
def _schema(app: str, path: str) -> T.StructType:
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its footer is read once per session."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark.sparkContext.applicationId, path)).parquet(path)


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr(*exprs(SURVEY))
    return rows.withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    places = nation.join(table(spark, sf_dir, "region"), "r_regionkey")
    # 25 nations, where Spark may take the customers for the smaller side.
    return customer.join(F.broadcast(places), "n_nationkey").selectExpr(*exprs(UNITS))


def ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = F.explode(F.array(F.lit(0), F.lit(1)))
    return table(spark, sf_dir, "customer").withColumn("version", versions).selectExpr(*exprs(GROUND_TRUTH))


def secondary_layout(spark: SparkSession, sf_dir: str, source_type: str) -> DataFrame:
    """One secondary source in its CSV columns."""
    if source_type == "ground_truth":
        newest = ground_truth(spark, sf_dir).filter("ingested_at = timestamp '2024-02-02 00:00:00'")
        return newest.select("id_wilayah", "label_kumuh", "sumber_label", "tanggal_label")
    return table(spark, sf_dir, "nation").selectExpr(*exprs(SECONDARY[source_type]))
