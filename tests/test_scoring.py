import uuid

from pyspark.sql import functions as F
from seed import GOLDEN, UNSURVEYED, golden_events, golden_units

from lakerisk.functions import text as X
from lakerisk.functions.scoring import largest_named
from lakerisk.operators import scoring, serving
from lakerisk.plans import medallion as M


def test_golden_scores(spark):
    rows = M.latest_with_place(golden_events(spark), golden_units(spark)).collect()
    assert {r["id_wilayah"]: (round(r["risk_score"], 6), r["risk_level"]) for r in rows} == {
        unit: (score, level) for unit, (_, score, level) in GOLDEN.items()
    }


def test_unsurveyed_units_stay_on_the_map(spark):
    units = golden_units(spark)
    gold = M.gold_units(M.latest_with_place(golden_events(spark), units), units)
    levels = {r["id_wilayah"]: r["risk_level"] for r in serving.map_rows(units, gold).collect()}
    assert len(levels) == 10
    assert {u for u, level in levels.items() if level == "Belum Didata"} == set(UNSURVEYED)


def test_missing_indicator_columns(spark):
    two = spark.createDataFrame([(3, 0), (None, 3)], "skor_jalan INT, skor_sampah INT")
    assert [r["risk_score"] for r in scoring.risk_score(two).collect()] == [50.0, 50.0]
    none = spark.createDataFrame([("x",)], "id_wilayah STRING")
    assert scoring.risk_score(none).first()["risk_score"] == 0.0
    row = scoring.dominant_factors(none).first()
    assert (row["top_faktor_1"], row["skor_faktor_3"]) == ("", 0.0)


def test_largest_named_values(spark):
    rows = spark.createDataFrame([(2.0, 2.0, None), (None, float("nan"), 1.0)], "b DOUBLE, a DOUBLE, c DOUBLE")
    found = rows.select(largest_named({n: F.col(n) for n in ("b", "a", "c")}, 2).alias("top")).collect()
    assert [[e["name"] for e in r["top"]] for r in found] == [["a", "b"], ["a", "c"]]
    short = rows.select(largest_named({"a": F.col("a")}, 3).alias("top")).first()
    assert [(e["name"], e["value"]) for e in short["top"]] == [("a", 2.0)]


def test_null_score_is_in_the_top_band(spark):
    df = spark.createDataFrame([(None,), (24.9,), (25.0,), (50.0,), (75.0,)], "risk_score DOUBLE")
    levels = [r["risk_level"] for r in scoring.risk_level(df).collect()]
    assert levels == ["Sangat Berat", "Ringan", "Sedang", "Berat", "Sangat Berat"]


def test_prediction_texts(spark):
    df = spark.createDataFrame(
        [(None, None), (1, None), (0, None), (0, 0.6), (0, 0.2), (1, 0.8)], "label_prediksi INT, proba_kumuh DOUBLE"
    )
    rows = scoring.prediction_label(scoring.prediction_band(df)).collect()
    assert [r["prediction_band"] for r in rows] == ["none", "high", "low", "medium", "low", "high"]
    assert [r["prediction_text"] for r in rows] == [
        "Belum Ada Prediksi", "Berpotensi Kumuh", "Tidak Kumuh", "Berpotensi Kumuh", "Tidak Kumuh", "Berpotensi Kumuh",
    ]


def test_uuid5_equals_python(spark):
    names = ["survey:abc", "secondary:x:1", "", "survey:ñandú"]
    df = spark.createDataFrame([(n,) for n in names], "name STRING")
    got = [r["u"] for r in df.select(X.uuid5(X.NAMESPACE_URL, F.col("name")).alias("u")).collect()]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]


def test_unit_id(spark):
    rows = [("Rungkut Kidul", "Gading", "1", "2"), ("  a b", "X", "123", "4567"), ("", "Y", "1", "1"), ("K", "L", None, "")]
    df = spark.createDataFrame(rows, "kec STRING, kel STRING, rw STRING, rt STRING")
    got = [r["i"] for r in df.select(X.unit_id(*[F.col(c) for c in df.columns]).alias("i")).collect()]
    assert got == ["SBY-RUNGK-GADIN-01-002", "SBY--A-B-X-123-4567", "--", "SBY-K-L-00-000"]


def test_text_functions(spark):
    df = spark.createDataFrame([(" a, b,,c ", 0.7345, None)], "ids STRING, p DOUBLE, q DOUBLE")
    row = df.select(
        X.split_ids(F.col("ids")).alias("ids"),
        X.fmt_pct(F.col("p")).alias("pct"),
        X.fmt_pct(F.col("q")).alias("blank"),
        X.fmt_score(F.col("q")).alias("zero"),
    ).first()
    assert (row["ids"], row["blank"], row["zero"]) == (["a", "b", "c"], "", "0.0")
    assert row["pct"] in ("73.4%", "73.5%")
