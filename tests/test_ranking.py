import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakerisk.operators import metrics, ranking
from lakerisk.operators.joins import heavy_keys, lookup_left
from lakerisk.operators.scoring import priority_score


def brute_rank(values):
    known = sorted((v for v in values if v is not None), reverse=True)
    return [len(known) + 1 if v is None else known.index(v) + 1 for v in values]


@pytest.mark.parametrize("kind", ["spread", "ties", "signs", "nulls"])
def test_global_rank_equals_brute_force(spark, kind):
    rng = random.Random(kind)
    make = {
        "spread": lambda: rng.random() * 10 ** rng.randrange(-6, 7),
        "ties": lambda: float(rng.randrange(3)),
        "signs": lambda: rng.choice([-1, 0, 1]) * rng.random(),
        "nulls": lambda: None if rng.random() < 0.4 else float(rng.randrange(50)),
    }[kind]
    values = [make() for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "id INT, v DOUBLE")
    got = {r["id"]: r["r"] for r in ranking.global_rank(df, "v", "r", ["id"]).collect()}
    assert [got[i] for i in range(500)] == brute_rank(values)


def test_scaled_rank_equals_plain_window(spark):
    rows = [(f"u{i}", float(i % 22) * 100 / 21, i * 37 % 90 if i % 11 else None) for i in range(300)]
    gold = spark.createDataFrame(rows, "id_wilayah STRING, risk_score DOUBLE, jiwa_terdampak LONG")
    cols = ["id_wilayah", "prioritas_rank"]
    scaled = ranking.priority_rank(gold).select(*cols).collect()
    plain = F.rank().over(Window.orderBy(F.desc_nulls_last("priority_score"))).cast("long")
    assert sorted(scaled) == sorted(priority_score(gold).withColumn("prioritas_rank", plain).select(*cols).collect())


def test_only_range_totals_meet_in_one_task(spark):
    df = spark.range(1000).withColumn("v", F.rand(1))
    plan = ranking.running_totals(df.groupBy("v").agg(F.count("*").alias("n")), "v", ["n"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(below) == 1
    assert "HashAggregate" in below[0] and "_range" in below[0]


@pytest.mark.parametrize("kind", ["narrow", "geometric", "one", "nan"])
def test_ranges_are_even(spark, kind):
    make = {"narrow": "1 + id * 1e-13D", "geometric": "pow(1.01D, id % 20000) * if(id % 2 = 0, 1, -1)", "one": "7D", "nan": "if(id % 2 = 0, double('NaN'), id)"}
    hist = spark.range(20_000).select(F.expr(make[kind]).cast("double").alias("v")).groupBy("v").agg(F.count("*").alias("n"))
    cuts = F.lit(hist.agg(ranking._cuts("v")).first()[0])
    sizes = [r["count"] for r in hist.groupBy(ranking._range_of(F.col("v"), cuts)).count().collect()]
    assert max(sizes) <= 1 + 2 * hist.count() / ranking.RANGES
    rows = ranking.running_totals(hist, "v", ["n"]).collect()
    # NaN is the largest, as to SQL.
    order = sorted(rows, key=lambda r: (r["v"] == r["v"], -r["v"] if r["v"] == r["v"] else 0))
    before = 0
    for r in order:
        assert r["before_n"] == before
        before += r["n"]


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("split", [False, True])
def test_lookup_left_keeps_every_row_once(spark, null_safe, split):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else None) for i in range(90)], "id INT, k STRING")
    lookup = spark.createDataFrame([("hot", 1), (None, 2), ("other", 3)], "k STRING, v INT")
    heavy = heavy_keys(rows, ["k"]) if split else None
    got = lookup_left(rows, lookup, ["k"], ["id"], null_safe=null_safe, heavy=heavy).collect()
    assert len(got) == 90
    assert all(r["v"] == (1 if r["k"] else (2 if null_safe else None)) for r in got)


def test_only_keys_with_a_large_share_are_split(spark):
    rows = spark.range(30_000).selectExpr("id", "if(id % 3 = 0, -1, id) AS k", "if(id % 3 = 0, NULL, 'x') AS other")
    found = [tuple(r) for r in heavy_keys(rows, ["k", "other"]).collect()]
    assert [r[:2] for r in found] == [(-1, None)] and 20 <= found[0][2] <= 24
    assert heavy_keys(rows.filter("k >= 0"), ["k"]) is None
    assert heavy_keys(rows.limit(0), ["k"]) is None
    plan = lookup_left(rows, rows.select("k", F.lit(1).alias("v")).distinct(), ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def brute_auc(pairs):
    pos = [p for label, p in pairs if label == 1]
    neg = [p for label, p in pairs if label == 0]
    return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))


def test_auc_equals_brute_force(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(2), round(rng.random(), 1)) for _ in range(200)]
    df = spark.createDataFrame(pairs, "label INT, proba DOUBLE")
    assert metrics.auc(df, "label", "proba").first()["auc"] == pytest.approx(brute_auc(pairs))


def test_metrics_of_one_class(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.2)], "label INT, prediction INT, proba DOUBLE")
    row = metrics.classification_metrics(df).first()
    assert row["auc"] is None and row["accuracy"] == 0.5
    assert metrics.confusion_matrix(df.filter("prediction = 0")).first()["precision"] == 0.0


def test_rows_without_probability_count_in_the_confusion_only(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (0, 0, 0.2), (1, 0, None), (None, 1, 0.4), (0, None, 0.95)], "label INT, prediction INT, proba DOUBLE")
    row = metrics.classification_metrics(df).first()
    assert row["auc"] == pytest.approx(metrics.auc(df, "label", "proba").first()["auc"]) == pytest.approx(0.5)
    assert row["accuracy"] == pytest.approx(2 / 3)
    none = metrics.classification_metrics(df.limit(0)).first()
    assert none["auc"] is None and none["accuracy"] == 0.0
