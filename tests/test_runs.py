"""Batch, incremental and streaming runs against each other."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from seed import GOLDEN, event, events, golden_events, golden_units, unit, units

from lakerisk import schemas
from lakerisk.operators import ml
from lakerisk.plans import medallion as M
from lakerisk.sources import files, tables
from lakerisk.streaming import ingest

START = datetime(2024, 1, 1)
SKIP = {"last_updated", "cluster_id", "cluster_rank", "cluster_label", "created_at"}
TABLES = [M.HISTORY, M.LATEST, M.FEATURES, M.RISK, M.TREND, M.FORECAST, M.FACTORS, M.PREDICTION, M.PRIORITY]


def log(spark):
    rows = []
    for day in range(4):
        for i in range(8):
            unit_id = "hot" if i % 3 == 0 else f"u{i}"
            scores = [(day * i + k) % 4 for k in range(7)]
            rows.append(event(f"e{day}-{i}", unit_id, START + timedelta(days=day, minutes=i), scores, people=50 + i))
    # stranger has no registry entry
    rows.append(event("s", "stranger", START + timedelta(days=3), [3] * 7))
    return events(spark, rows)


def registry(spark):
    ids = ["hot", *[f"u{i}" for i in range(1, 9)]]
    return units(spark, [unit(u, "K", f"L{n % 2}", people=100 + n) for n, u in enumerate(ids)])


def lakehouse(spark, path, events_df, with_units=True):
    lake = M.Lakehouse(str(path))
    tables.append_table(events_df, lake.path(M.SURVEY))
    if with_units:
        tables.append_table(registry(spark), lake.path(M.UNITS))
    return lake


def state(spark, lake, name):
    df = tables.read_table(spark, lake.path(name))
    cols = sorted(set(df.columns) - SKIP)
    rows = df.select(cols).collect()
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=str)


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    lake = lakehouse(spark, tmp_path_factory.mktemp("full") / "lake", log(spark))
    M.bronze_to_silver(spark, lake)
    M.silver_to_gold(spark, lake)
    return {name: state(spark, lake, name) for name in TABLES}


def test_incremental_equals_full(spark, tmp_path, full):
    cut = F.lit(START + timedelta(days=2))
    everything = log(spark)
    lake = lakehouse(spark, tmp_path / "lake", everything.filter(F.col("recorded_at") < cut))
    M.bronze_to_silver(spark, lake)
    M.silver_to_gold(spark, lake)
    newer = everything.filter(F.col("recorded_at") >= cut)
    tables.append_table(newer, lake.path(M.SURVEY))
    for _ in range(2):  # a repeated run changes nothing
        M.bronze_to_silver(spark, lake, newer.select("id_wilayah"))
        M.silver_to_gold(spark, lake, newer.select("id_wilayah"))
    for name in TABLES:
        assert state(spark, lake, name) == full[name], name


def test_stream_of_late_and_repeated_messages_equals_full(spark, tmp_path, full):
    lake = M.Lakehouse(str(tmp_path / "lake"))
    tables.append_table(registry(spark), lake.path(M.UNITS))
    folder = tmp_path / "messages"
    folder.mkdir()
    records = [{k: str(v) for k, v in r.asDict().items() if v is not None} for r in log(spark).collect()]
    deliveries = [records[16:], records[:16] + records[20:24]]  # late half last, some repeated
    for i, batch in enumerate(deliveries):
        lines = [json.dumps(r) for r in batch] + ["{broken", json.dumps({"id_wilayah": "u1", "skor_jalan": "7"})]
        (folder / f"{i}.json").write_text("\n".join(lines))
        messages = files.read_events(spark, str(folder), schemas.SURVEY)
        refresh = ingest.survey_refresh(spark, lake)
        ingest.start_refresh(messages, refresh, str(tmp_path / "checkpoint"), interval=None).awaitTermination()
    for name in TABLES:
        assert state(spark, lake, name) == full[name], name
    rejected = spark.read.parquet(lake.path("bronze/survey_rejects"))
    reasons = sorted(r["reason"] for r in rejected.select(F.explode("reasons").alias("reason")).collect())
    assert reasons == ["not JSON", "not JSON", "skor_jalan out of range", "skor_jalan out of range"]


def test_repeated_batch_is_stored_once(spark, tmp_path):
    lake = M.Lakehouse(str(tmp_path / "lake"))
    rows = golden_events(spark).select(*[F.col(c).cast("string").alias(c) for c in schemas.SURVEY.fieldNames()])
    batch = rows.withColumn("_corrupt_record", F.lit(None).cast("string"))
    refresh = ingest.survey_refresh(spark, lake)
    refresh(batch, 0)
    refresh(batch, 0)
    assert tables.read_table(spark, lake.path(M.SURVEY)).count() == len(GOLDEN)
    assert tables.read_table(spark, lake.path(M.HISTORY)).count() == len(GOLDEN)


def test_streams_into_one_log_keep_each_others_batches(spark, tmp_path):
    """Batch numbers start at 0 for every checkpoint; a repeated batch of one stream is still stored once."""
    out, bad = str(tmp_path / "log"), str(tmp_path / "rejects")
    for stream in ("a", "b"):
        folder = tmp_path / stream
        folder.mkdir()
        good = json.dumps({"event_id": f"event {stream}", "id_wilayah": "u1"})
        (folder / "0.json").write_text(f"{good}\n{{broken {stream}")
        for _ in range(2):  # the second start goes on from the checkpoint
            messages = files.read_events(spark, str(folder), schemas.SURVEY)
            for running in ingest.stream_to_bronze(messages, schemas.SURVEY, ingest.typed_survey, out, bad, str(tmp_path / f"checkpoint {stream}")):
                running.awaitTermination()
    lake = M.Lakehouse(str(tmp_path / "lake"))
    for stream in ("a", "b"):
        messages = files.read_events(spark, str(tmp_path / stream), schemas.SURVEY)
        ingest.start_refresh(messages, ingest.survey_refresh(spark, lake), str(tmp_path / f"refresh {stream}"), interval=None).awaitTermination()
    for log, rejects in ((out, bad), (lake.path(M.SURVEY), lake.path("bronze/survey_rejects"))):
        stored = tables.read_log(spark, log, schemas.SURVEY).collect()
        assert sorted(r["event_id"] for r in stored) == ["event a", "event b"]
        assert sorted(r["message"] for r in spark.read.parquet(rejects).collect()) == ["{broken a", "{broken b"]


def test_a_rerun_batch_of_a_stream_is_stored_once(spark, tmp_path):
    """A batch whose commit was lost is run again under the same query id."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text(json.dumps({"event_id": "e", "id_wilayah": "u1"}))
    lake, checkpoint = M.Lakehouse(str(tmp_path / "lake")), tmp_path / "checkpoint"
    for _ in range(2):
        messages = files.read_events(spark, str(tmp_path / "in"), schemas.SURVEY)
        ingest.start_refresh(messages, ingest.survey_refresh(spark, lake), str(checkpoint), interval=None).awaitTermination()
        for name in ("0", ".0.crc"):
            (checkpoint / "commits" / name).unlink(missing_ok=True)
    assert tables.read_log(spark, lake.path(M.SURVEY), schemas.SURVEY).count() == 1


def test_history_falls_back_to_the_log(spark, tmp_path):
    lake = lakehouse(spark, tmp_path / "lake", golden_events(spark), with_units=False)
    assert "risk_score_saat_itu" not in M.history_or_log(spark, lake).columns
    M.bronze_to_silver(spark, lake)
    assert "risk_score_saat_itu" in M.history_or_log(spark, lake).columns


def test_no_survey_no_tables(spark, tmp_path):
    lake = M.Lakehouse(str(tmp_path / "lake"))
    M.bronze_to_silver(spark, lake)
    M.silver_to_gold(spark, lake)
    assert M.train(spark, lake) is None
    assert not tables.table_exists(spark, lake.path(M.LATEST))


def test_run_without_registry(spark, tmp_path):
    lake = lakehouse(spark, tmp_path / "lake", golden_events(spark), with_units=False)
    M.bronze_to_silver(spark, lake)
    M.silver_to_gold(spark, lake)
    gold = tables.read_table(spark, lake.path(M.RISK))
    assert {r["jiwa_terdampak"] for r in gold.collect()} == {0}


def label_rows(spark, labels):
    rows = [(f"b{i}", "ground_truth", u, y, START) for i, (u, y) in enumerate(labels.items())]
    df = spark.createDataFrame(rows, "batch_id STRING, source_type STRING, id_wilayah STRING, label_kumuh INT, ingested_at TIMESTAMP")
    from lakerisk.operators.quality import conform_secondary

    return conform_secondary(df)


def test_training_records_a_model(spark, tmp_path):
    rows = [event(f"e{i}", f"u{i}", START, [i % 4] * 7, floods=i % 3) for i in range(40)]
    lake = lakehouse(spark, tmp_path / "lake", events(spark, rows))
    tables.append_table(label_rows(spark, {f"u{i}": int(i % 4 >= 2) for i in range(40)}), lake.path(M.SECONDARY))
    M.bronze_to_silver(spark, lake)
    for _ in range(2):
        assert M.train(spark, lake, trees=4, depth=2) is not None
    metrics = tables.read_table(spark, lake.path(M.METRICS), schemas.METRICS).collect()
    assert len(metrics) == 2  # history is kept
    for row in metrics:
        assert row["accuracy"] == 1.0 and row["auc"] == 1.0 and row["n_train"] + row["n_test"] == 40
        assert row["confusion_matrix_fp"] == row["confusion_matrix_fn"] == 0 and row["cv_folds"] == 3
        assert abs(sum(json.loads(row["feature_importances"]).values()) - 1) < 1e-9
    scored = ml.score(ml.load_model(lake.models), tables.read_table(spark, lake.path(M.LATEST)))
    assert all(r["label_prediksi"] == int(r["skor_jalan"] >= 2) for r in scored.collect())


def test_few_labels_train_without_cross_validation(spark, tmp_path):
    lake = lakehouse(spark, tmp_path / "lake", golden_events(spark), with_units=False)
    tables.append_table(label_rows(spark, {u: int(level != "Ringan") for u, (_, _, level) in list(GOLDEN.items())[:4]}), lake.path(M.SECONDARY))
    M.bronze_to_silver(spark, lake)
    assert M.train(spark, lake) is not None
    row = tables.read_table(spark, lake.path(M.METRICS), schemas.METRICS).first()
    assert (row["cv_folds"], row["cv_mean_f1"], row["n_train"], row["n_test"]) == (None, None, 4, 4)


def test_only_labels_ask_for_training(spark):
    rows = label_rows(spark, {"u": 1})
    assert ingest.needs_training(rows)
    assert not ingest.needs_training(rows.withColumn("source_type", F.lit("bps")))


def test_too_few_units_for_clusters(spark):
    assert ml.fit_kmeans(golden_events(spark).limit(3), k=4) is None
    gold = ml.attach_clusters(golden_events(spark), None)
    assert {(r["cluster_id"], r["cluster_label"]) for r in gold.collect()} == {(None, "")}


def test_split_is_stable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id_wilayah"), (F.col("id") % 2).cast("int").alias("label"))

    def train_ids(frame):
        return {r["id_wilayah"] for r in ml.stable_split(frame).filter("split = 'train'").collect()}

    one, other = train_ids(df.coalesce(1)), train_ids(df.repartition(7))
    assert one == other and 700 < len(one) < 900
    relabelled = df.withColumn("label", 1 - F.col("label"))
    assert train_ids(relabelled) == one
    sizes = {(r["split"], r["fold"]): r["count"] for r in ml.stable_folds(ml.stable_split(df)).groupBy("split", "fold").count().collect()}
    assert len(sizes) == 6 and all(200 < sizes["train", fold] < 340 for fold in range(3))


def test_a_skipped_search_names_the_single_fit(spark):
    pipeline = ml.rf_pipeline(trees=3, depth=2)
    few = spark.createDataFrame([("u", 1)], "id_wilayah string, label int")
    assert ml.fit_cv(pipeline, few) is None
    assert [tuple(r) for r in ml.cv_frame(spark, None, pipeline).collect()] == [(3, 2, None, None)]


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "CartesianProduct")


def test_no_python_and_no_cartesian_in_plans(spark, data):
    from lakerisk.plans.catalog import QUERIES

    for name in ("gold_risk", "map_risk", "match_units", "bbox_join", "forecast", "label_asof", "priority_rank_scaled", "event_history"):
        plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert not [node for node in PYTHON_NODES if node in plan], name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_hot_keys_are_limited_before_the_shuffle(spark, data):
    from lakerisk.plans.catalog import QUERIES

    for name in ("latest_indicators", "trend", "dedup_events", "ground_truth_latest"):
        plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert "Partial" in plan and "WindowGroupLimit" in plan, name


def test_batch_and_stream_files_are_read_together(spark, tmp_path):
    path = str(tmp_path / "log")
    events = golden_events(spark)
    tables.append_table(events.limit(2), path)
    tables.append_table(events.drop("skor_jalan").limit(1), path)
    ingest._store_batch(spark, events.limit(3), path, 7)
    rows = tables.read_log(spark, path, schemas.SURVEY)
    assert rows.count() == 6 and rows.columns == schemas.SURVEY.fieldNames()
    assert rows.filter("skor_jalan is null").count() >= 1


def test_an_id_offered_twice_is_registered_once(spark):
    from lakerisk.operators.joins import register_units

    offered = spark.createDataFrame([("x", 2), ("x", 1), ("y", 1), ("k", 1)], "id_wilayah string, total_jiwa int")
    new, again = register_units(spark.createDataFrame([("k",)], "id_wilayah string"), offered)
    assert sorted(map(tuple, new.collect())) == [("x", 1), ("y", 1)]
    assert sorted(map(tuple, again.collect())) == [("k", 1), ("x", 2)]


def test_nan_ranks_first(spark):
    from lakerisk.operators.ranking import global_rank

    rows = spark.createDataFrame([(1, float("nan")), (2, 5.0), (3, None), (4, -1.0)], "id int, v double")
    assert {r["id"]: r["r"] for r in global_rank(rows, "v", "r", ["id"]).collect()} == {1: 1, 2: 2, 4: 3, 3: 4}
