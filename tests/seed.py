"""Hand-checkable units and surveys.

Fixed values: ids, scores and the expected risk and level of each unit.
"""

from datetime import datetime

from lakerisk.vocabulary import INDICATORS

GOLDEN = {
    "SBY-TBS-PEGIRIAN-02-001": ((2, 2, 3, 2, 2, 3, 1), 71.428571, "Berat"),
    "SBY-SMK-SIMOLAWANG-01-001": ((2, 1, 2, 2, 2, 2, 1), 57.142857, "Berat"),
    "SBY-SMK-TAMBAKREJO-03-002": ((3, 2, 3, 3, 2, 3, 2), 85.714286, "Sangat Berat"),
    "SBY-SMP-UJUNG-05-003": ((2, 2, 2, 2, 3, 2, 2), 71.428571, "Berat"),
    "SBY-SMP-WONOKUSUMO-04-001": ((1, 1, 2, 1, 2, 2, 1), 47.619048, "Sedang"),
    "SBY-TBS-GADING-01-001": ((0, 0, 1, 0, 1, 1, 0), 14.285714, "Ringan"),
    "SBY-KNJ-BULAK-02-001": ((1, 0, 1, 1, 1, 1, 0), 23.809524, "Ringan"),
    "SBY-KNJ-TANAH-KALi-06-002": ((2, 1, 2, 2, 2, 2, 1), 57.142857, "Berat"),
}
UNSURVEYED = ("SBY-TBS-GADING-01-002", "SBY-GNA-RUNGKUT-KIDUL-01-001")


def event(event_id, unit, at, scores, people=100, floods=0):
    return {
        "event_id": event_id,
        "id_wilayah": unit,
        "recorded_at": at if isinstance(at, datetime) else datetime.fromisoformat(at),
        **dict(zip(INDICATORS, scores, strict=True)),
        "jumlah_jiwa": people,
        "frekuensi_banjir": floods,
    }


def events(spark, rows):
    from lakerisk.operators.quality import conform_survey

    columns = (
        "event_id STRING, id_wilayah STRING, recorded_at TIMESTAMP, "
        + ", ".join(f"{n} INT" for n in INDICATORS)
        + ", jumlah_jiwa INT, frekuensi_banjir INT"
    )
    return conform_survey(spark.createDataFrame(rows, columns))


def golden_events(spark):
    rows = [event(f"e{i}", unit, "2024-01-01 08:00:00", scores) for i, (unit, (scores, _, _)) in enumerate(GOLDEN.items())]
    return events(spark, rows)


def unit(unit_id, kecamatan, kelurahan, rw="01", rt="001", people=100, geometry='{"type":"Point","coordinates":[112.75,-7.25]}'):
    return (unit_id, "Surabaya", kecamatan, kelurahan, rw, rt, people // 4, people, 15000.0, geometry, None)


def units(spark, rows):
    from lakerisk import schemas

    return spark.createDataFrame(rows, schemas.UNITS)


def golden_units(spark):
    rows = []
    for unit_id in (*GOLDEN, *UNSURVEYED):
        parts = unit_id.split("-")
        rows.append(unit(unit_id, parts[1], parts[2], parts[-2], parts[-1]))
    return units(spark, rows)
