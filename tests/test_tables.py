from datetime import datetime

import pytest
from pyspark.sql import functions as F
from seed import unit, units

from lakerisk import schemas
from lakerisk.operators import quality, upsert as up
from lakerisk.operators.joins import scope_by_area
from lakerisk.plans import medallion as M
from lakerisk.sources import files, tables

SCHEMA = "k STRING, area STRING, v INT"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(df):
    return sorted(map(tuple, df.select("k", "area", "v").collect()), key=str)


def test_upsert_replaces_inserts_and_keeps(spark):
    target = frame(spark, [("a", "x", 1), ("b", "x", 2), (None, "x", 3)])
    source = frame(spark, [("b", "y", 20), ("c", "y", 30), (None, "y", 40)])
    assert content(up.upsert(target, source, ["k"])) == content(
        frame(spark, [("a", "x", 1), ("b", "y", 20), ("c", "y", 30), (None, "x", 3), (None, "y", 40)])
    )
    assert content(up.upsert(target, source, ["k"], null_safe=True)) == content(
        frame(spark, [("a", "x", 1), ("b", "y", 20), ("c", "y", 30), (None, "y", 40)])
    )
    assert content(up.upsert(target, source, ["k"], update_matches=False)) == content(
        frame(spark, [("a", "x", 1), ("b", "x", 2), (None, "x", 3), ("c", "y", 30), (None, "y", 40)])
    )


def test_absent_column_overwrites_with_null(spark):
    target = frame(spark, [("a", "x", 1)])
    merged = up.upsert(target, frame(spark, [("a", "x", 9)]).drop("v").withColumn("new", F.lit(1)), ["k"])
    row = merged.first()
    assert (row["v"], row["new"]) == (None, 1)


def test_repeated_source_key_is_refused(spark):
    with pytest.raises(ValueError, match="several source rows"):
        up.assert_unique(frame(spark, [("a", "x", 1), ("a", "x", 2)]), ["k"])
    up.assert_unique(frame(spark, [(None, "x", 1), (None, "x", 2)]), ["k"])


@pytest.mark.parametrize("partitions", [(), ("area",)])
def test_merge_table_equals_upsert(spark, tmp_path, partitions):
    path = str(tmp_path / "t")
    target = frame(spark, [("a", "x", 1), ("b", "y", 2), ("c", None, 3), ("d", "x", 4)])
    # b leaves y, which becomes empty; c leaves the NULL area; e opens a new one.
    source = frame(spark, [("b", "x", 20), ("c", "x", 30), ("e", "z", 50)])
    tables.merge_table(spark, path, target, ["k"], partitions)
    tables.merge_table(spark, path, source, ["k"], partitions)
    once = content(tables.read_table(spark, path))
    assert once == content(up.upsert(target, source, ["k"]))
    tables.merge_table(spark, path, source, ["k"], partitions)
    assert content(tables.read_table(spark, path)) == once


def test_merge_leaves_other_partitions_alone(spark, tmp_path):
    path = tmp_path / "t"
    tables.merge_table(spark, str(path), frame(spark, [("a", "x", 1), ("b", "y", 2)]), ["k"], ("area",))
    before = sorted((path / "area=y").iterdir())
    tables.merge_table(spark, str(path), frame(spark, [("a", "x", 5)]), ["k"], ("area",), keys_move=False)
    assert sorted((path / "area=y").iterdir()) == before
    assert content(tables.read_table(spark, str(path))) == [("a", "x", 5), ("b", "y", 2)]


def test_insert_only_merge_appends(spark, tmp_path):
    path = str(tmp_path / "t")
    first = frame(spark, [("a", "x", 1), ("n", None, 2)])
    again = frame(spark, [("a", "x", 9), ("n", "x", 9), ("b", "y", 3)])
    for source in (first, again, again):
        tables.merge_table(spark, path, source, ["k"], ("area",), update_matches=False, keys_move=False)
    assert content(tables.read_table(spark, path)) == [("a", "x", 1), ("b", "y", 3), ("n", None, 2)]


def test_missing_table_reads_empty(spark, tmp_path):
    empty = tables.read_optional(spark, str(tmp_path / "none"), schemas.UNITS)
    assert empty.schema == schemas.UNITS and empty.isEmpty()


def test_csv_sources(spark, tmp_path):
    texts = {
        "ground_truth": "id_wilayah,label_kumuh,sumber_label,tanggal_label\nu1,1,\"SK, 2023\",2023-01-15\nu2,maybe,x,\n",
        "bps": "kelurahan,kepadatan_jiwa_per_km2,tahun_data\nGading,12450.5,2024\n",
        "bmkg": "kelurahan,jumlah_kejadian_banjir,tahun\nGading,4,2024\n",
        "pdam": "kelurahan,pct_akses_air_bersih\nGading,96.5\n",
    }
    read = {}
    for kind, text in texts.items():
        path = tmp_path / f"{kind}.csv"
        path.write_text(text)
        df = files.read_secondary_csv(spark, str(path), kind)
        assert df.schema.fieldNames() == schemas.SECONDARY.fieldNames()
        read[kind] = df.collect()
    assert [(r["label_kumuh"], r["sumber_label"]) for r in read["ground_truth"]] == [(1, "SK, 2023"), (None, "x")]
    assert (read["bps"][0]["kepadatan_jiwa_per_km2"], read["bps"][0]["tahun_data"]) == (12450.5, 2024)
    assert (read["bmkg"][0]["jumlah_kejadian_banjir"], read["bmkg"][0]["tahun_data"]) == (4, 2024)
    assert read["pdam"][0]["pct_akses_air_bersih"] == 96.5
    again = files.read_secondary_csv(spark, str(tmp_path / "bps.csv"), "bps").first()
    assert again["batch_id"] == read["bps"][0]["batch_id"]
    with pytest.raises(ValueError, match="unknown source_type"):
        files.read_secondary_csv(spark, "x", "other")


def test_conform_defaults(spark):
    df = spark.createDataFrame([("e", "u", "2024-01-01T08:00:00", "2", "x", None)], "event_id STRING, id_wilayah STRING, recorded_at STRING, skor_jalan STRING, skor_sampah STRING, catatan STRING")
    row = quality.conform_survey(df).first()
    assert (row["recorded_at"], row["skor_jalan"], row["skor_sampah"]) == (datetime(2024, 1, 1, 8), 2, 0)
    assert (row["pernah_banjir"], row["catatan"], row["jumlah_kk"]) == (False, "", 0)


def test_null_area_is_in_scope(spark):
    rows = spark.createDataFrame([("a", "x", "k"), ("b", None, None), ("c", "y", "k")], "id STRING, kelurahan STRING, kecamatan STRING")
    areas = spark.createDataFrame([(None, None), ("x", "k")], "kelurahan STRING, kecamatan STRING")
    assert sorted(r["id"] for r in scope_by_area(rows, areas).collect()) == ["a", "b"]


def test_priority_csv_quotes_commas(spark, tmp_path):
    columns = "prioritas_rank LONG, id_wilayah STRING, kelurahan STRING, kecamatan STRING, risk_score DOUBLE, risk_level STRING, proba_kumuh DOUBLE, jiwa_terdampak LONG, cluster_label STRING, top_faktor_1 STRING, top_faktor_2 STRING, top_faktor_3 STRING"
    gold = spark.createDataFrame([(1, "u", "a, b", "k", 71.43, "Berat", None, 5, None, "f", "", "")], columns)
    files.write_priority_csv(gold, str(tmp_path / "csv"))
    text = next((tmp_path / "csv").glob("*.csv")).read_text().splitlines()
    assert text[0].startswith("Peringkat,ID Wilayah") and text[1] == '1,u,"a, b",k,71.4,Berat,,5,,f,,'


def test_register_refuses_duplicates_and_bad_geometry(spark, tmp_path):
    lake = M.Lakehouse(str(tmp_path / "lake"))
    first = units(spark, [unit("a", "K", "L"), unit("b", "K", "L", geometry=None)]).drop("created_at")
    M.register(spark, lake, first)
    again, bad = M.register(spark, lake, units(spark, [unit("a", "K", "L"), unit("c", "K", "L", geometry="x"), unit("d", "K", "L")]).drop("created_at"))
    assert [r["id_wilayah"] for r in again.collect()] == ["a"]
    assert [r["id_wilayah"] for r in bad.collect()] == ["c"]
    assert sorted(r["id_wilayah"] for r in tables.read_table(spark, lake.path(M.UNITS)).collect()) == ["a", "b", "d"]


def test_number_like_partitions_stay_text(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([("a", "001", 1), ("b", "02", 2)], [("b", "02", 3), ("c", "001", 4)]):
        tables.merge_table(spark, path, frame(spark, rows), ["k"], ("area",))
    assert content(tables.read_table(spark, path, text=("area",))) == [("a", "001", 1), ("b", "02", 3), ("c", "001", 4)]
