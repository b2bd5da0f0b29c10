"""Names and labels the tables use.

Fixed values: column names, labels and thresholds below are part of the data
contract and must stay exactly as written. Indicator order matters for feature
vectors.
"""

INDICATORS = (
    "skor_bangunan",
    "skor_jalan",
    "skor_drainase",
    "skor_air_limbah",
    "skor_sampah",
    "skor_kebakaran",
    "skor_air_minum",
)

INDICATOR_LABELS = {
    "skor_bangunan": "Kondisi Bangunan",
    "skor_jalan": "Aksesibilitas Jalan",
    "skor_drainase": "Drainase Lingkungan",
    "skor_air_limbah": "Pengelolaan Air Limbah",
    "skor_sampah": "Pengelolaan Persampahan",
    "skor_kebakaran": "Proteksi Kebakaran",
    "skor_air_minum": "Penyediaan Air Minum",
}

RADAR_LABELS = {
    "skor_bangunan": "Bangunan",
    "skor_jalan": "Jalan",
    "skor_drainase": "Drainase",
    "skor_air_limbah": "Air Limbah",
    "skor_sampah": "Sampah",
    "skor_kebakaran": "Kebakaran",
    "skor_air_minum": "Air Minum",
}

MODEL_FEATURES = INDICATORS + ("frekuensi_banjir", "jumlah_jiwa")

MAX_INDICATOR_SCORE = 3
RISK_BANDS = ((25.0, "Ringan"), (50.0, "Sedang"), (75.0, "Berat"))
TOP_RISK_BAND = "Sangat Berat"
NOT_SURVEYED = "Belum Didata"
INCOMPLETE = "Belum Lengkap"

WORSENING, STABLE, IMPROVING = "Memburuk", "Stabil", "Membaik"
TREND_LABELS = (WORSENING, STABLE, IMPROVING)

PREDICTED_SLUM = "Berpotensi Kumuh"
PREDICTED_FINE = "Tidak Kumuh"
NOT_PREDICTED = "Belum Ada Prediksi"

CLUSTER_LABELS = (
    "Cluster Risiko Rendah",
    "Cluster Risiko Sedang",
    "Cluster Risiko Tinggi",
    "Cluster Risiko Sangat Tinggi",
)

SECONDARY_TYPES = ("ground_truth", "bps", "bmkg", "pdam")
HIERARCHY = ("kecamatan", "kelurahan", "rw", "rt")
AREA_KEYS = ("kelurahan", "kecamatan")
