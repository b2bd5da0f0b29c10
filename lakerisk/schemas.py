"""Fixed table schemas, one StructType per stored table that needs one."""

from pyspark.sql import types as T

from lakerisk.vocabulary import INDICATORS


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """StructType of "name TYPE, ..." text; usable before a session exists."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


_SCORES = ", ".join(f"{name} INT" for name in INDICATORS)

UNITS = _struct(
    "id_wilayah STRING, kota STRING, kecamatan STRING, kelurahan STRING, rw STRING, rt STRING, "
    "total_kk BIGINT, total_jiwa BIGINT, luas_m2 DOUBLE, geometry_wkt STRING, created_at TIMESTAMP"
)

SURVEY = _struct(
    f"event_id STRING, id_wilayah STRING, recorded_at TIMESTAMP, recorded_by STRING, {_SCORES}, "
    "jumlah_kk INT, jumlah_jiwa INT, pernah_banjir BOOLEAN, frekuensi_banjir INT, "
    "sosek_dominan STRING, catatan STRING"
)

SECONDARY = _struct(
    "batch_id STRING, source_type STRING, id_wilayah STRING, kelurahan STRING, kecamatan STRING, "
    "label_kumuh INT, sumber_label STRING, tanggal_label STRING, kepadatan_jiwa_per_km2 DOUBLE, "
    "jumlah_kejadian_banjir INT, pct_akses_air_bersih DOUBLE, tahun_data INT, raw_data STRING, "
    "accepted_at TIMESTAMP, ingested_at TIMESTAMP"
)

# CSV layouts of the four secondary sources. The flood file calls its year
# column "tahun"; it lands in tahun_data.
SECONDARY_CSV = {
    "ground_truth": _struct(
        "id_wilayah STRING, label_kumuh STRING, sumber_label STRING, tanggal_label STRING"
    ),
    "bps": _struct("kelurahan STRING, kepadatan_jiwa_per_km2 STRING, tahun_data STRING"),
    "bmkg": _struct("kelurahan STRING, jumlah_kejadian_banjir STRING, tahun STRING"),
    "pdam": _struct("kelurahan STRING, pct_akses_air_bersih STRING"),
}

METRICS = _struct(
    "model_version STRING, model_path STRING, algorithm STRING, n_trees INT, max_depth INT, "
    "auc DOUBLE, f1_score DOUBLE, accuracy DOUBLE, precision DOUBLE, recall DOUBLE, "
    "cv_folds INT, cv_mean_f1 DOUBLE, cv_std_f1 DOUBLE, "
    "confusion_matrix_tp BIGINT, confusion_matrix_tn BIGINT, "
    "confusion_matrix_fp BIGINT, confusion_matrix_fn BIGINT, "
    "n_train BIGINT, n_test BIGINT, feature_cols STRING, feature_importances STRING, "
    "trained_at TIMESTAMP"
)


# Columns of the two area tables, each with its aggregate and input.
AREA_FEATURES = {f"avg_{name}": ("mean", name) for name in INDICATORS} | {
    "total_jiwa_kelurahan": ("total", "jumlah_jiwa"),
    "avg_frekuensi_banjir": ("mean", "frekuensi_banjir"),
    "total_rt_surveyed": ("filled", "id_wilayah"),
    "avg_risk_score": ("mean", "risk_score"),
}
AREA_POPULATION = {
    "total_jiwa": ("total", "total_jiwa"),
    "total_kk": ("total", "total_kk"),
    "total_rt": ("filled", "id_wilayah"),
}


#: Fields of a message beside the table's: the sender's key of a survey or an upload, and the row in it.
MESSAGE_KEYS = ("idempotency_key", "row_number")


def message_schema(table: T.StructType) -> T.StructType:
    """Schema for reading one JSON message of a table: every field as text.

    Text first, typed later: a bad cell then costs its record a reason in the
    quarantine instead of the whole file.
    """
    return T.StructType([T.StructField(name, T.StringType()) for name in (*table.fieldNames(), *MESSAGE_KEYS)])
