import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from seed import event, events

from lakerisk.operators import forecast as fc
from lakerisk.operators import history as h
from lakerisk.operators.scoring import score_and_level

START = datetime(2024, 1, 1)


def random_log(spark, n=400, seed=1):
    """Few units, one of them with a third of the events, and many equal times."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        unit = "hot" if rng.random() < 0.34 else f"u{rng.randrange(12)}"
        at = START + timedelta(minutes=30 * rng.randrange(200))
        rows.append(event(f"e{i:04d}", unit, at, [rng.randrange(4) for _ in range(7)]))
    return rows, events(spark, rows)


def newest(rows):
    return max(rows, key=lambda r: (r["recorded_at"], r["event_id"]))


def by_unit(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["id_wilayah"], []).append(row)
    return groups


def test_latest_breaks_ties_by_event_id(spark):
    rows, log = random_log(spark)
    got = {r["id_wilayah"]: r["event_id"] for r in h.latest_per_key(log).collect()}
    assert got == {unit: newest(group)["event_id"] for unit, group in by_unit(rows).items()}


def test_dedup_keeps_the_earliest(spark):
    rows, _ = random_log(spark)
    copies = rows + [{**r, "recorded_at": r["recorded_at"] + timedelta(hours=1)} for r in rows] + rows
    got = {r["event_id"]: r["recorded_at"] for r in h.dedup_events(events(spark, copies)).collect()}
    assert got == {r["event_id"]: r["recorded_at"] for r in rows}


def test_snapshot_ignores_later_events(spark):
    rows, log = random_log(spark)
    cut = datetime(2024, 1, 2, 12)
    got = {r["id_wilayah"]: r["event_id"] for r in h.snapshot_as_of(log, str(cut)).collect()}
    earlier = by_unit([r for r in rows if r["recorded_at"] <= cut])
    assert got == {unit: newest(group)["event_id"] for unit, group in earlier.items()}


def test_label_asof_equals_brute_force(spark):
    rows, log = random_log(spark)
    rng = random.Random(2)
    asked = [(f"l{i}", rng.choice(["hot", "u1", "u2", "nowhere"]), START + timedelta(minutes=30 * rng.randrange(210))) for i in range(80)]
    labels = spark.createDataFrame(asked, "label_id STRING, id_wilayah STRING, labeled_at TIMESTAMP")
    got = {r["label_id"]: r["event_id"] for r in h.label_asof(labels, log).collect()}
    want = {}
    for label_id, unit, at in asked:
        seen = [r for r in rows if r["id_wilayah"] == unit and r["recorded_at"] <= at]
        want[label_id] = newest(seen)["event_id"] if seen else None
    assert got == want


def test_trend_of_one_event_is_stable(spark):
    log = events(spark, [event("a", "u", "2024-01-01", [1] * 7)])
    row = h.trend(score_and_level(log, "_saat_itu")).first()
    assert (row["risk_score_prev"], row["delta_risk"], row["trend_label"]) == (None, 0.0, "Stabil")


def test_forecast_of_a_straight_line(spark):
    days = [event(f"e{i}", "u", START + timedelta(days=i), s) for i, s in enumerate([[0] * 7, [1, 0, 0, 0, 0, 0, 0], [1, 1, 0, 0, 0, 0, 0]])]
    row = fc.forecast(score_and_level(events(spark, days), "_saat_itu"), horizon_days=2).first()
    assert row["slope_per_day"] == round(100 / 21, 4)
    assert abs(row["forecast_score"] - 4 * 100 / 21) < 1e-6
    assert (row["forecast_trend"], row["forecast_at"]) == ("Memburuk", START + timedelta(days=4))


def test_forecast_at_one_instant_and_of_one_event(spark):
    log = events(spark, [event("a", "u", "2024-01-01", [0] * 7), event("b", "u", "2024-01-01", [3] * 7), event("c", "v", "2024-01-01", [1] * 7)])
    rows = fc.forecast(score_and_level(log, "_saat_itu")).collect()
    assert [(r["id_wilayah"], r["slope_per_day"], r["forecast_score"], r["current_risk_score"]) for r in rows] == [("u", 0.0, 50.0, 100.0)]


def test_forecast_with_and_without_snapshot(spark):
    _, log = random_log(spark)
    scored = score_and_level(log, "_saat_itu")
    alone = fc.forecast(scored)
    given = fc.forecast(scored, latest=h.latest_indicators(log))
    assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, given.select(*alone.columns).collect()))


def test_late_event_does_not_displace_the_snapshot(spark):
    first = [event("new", "u", "2024-01-05", [3] * 7)]
    late = [event("old", "u", "2024-01-01", [0] * 7)]
    row = h.latest_indicators(events(spark, first + late)).first()
    assert row["event_id"] == "new"


def test_latest_ground_truth_prefers_known_times(spark):
    rows = [("b1", "u", None), ("b2", "u", START), ("b3", "u", START)]
    labels = spark.createDataFrame(rows, "batch_id STRING, id_wilayah STRING, ingested_at TIMESTAMP").withColumn("source_type", F.lit("ground_truth"))
    assert h.latest_ground_truth(labels).first()["batch_id"] == "b3"
