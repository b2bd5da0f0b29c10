"""Folded batches, id indexes, growing schemas, keyed messages and stored clusters."""

import json
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from seed import event, events
from test_runs import TABLES, lakehouse, log, state

from lakerisk import schemas
from lakerisk import vocabulary as V
from lakerisk.operators import forecast, history, joins, ml, ranking, unit_state
from lakerisk.operators.clusters import Clusters, farther_than_nearest, model_table
from lakerisk.plans import medallion as M
from lakerisk.sources import files, idindex, tables
from lakerisk.streaming import ingest

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    lake = lakehouse(spark, tmp_path_factory.mktemp("full") / "lake", log(spark))
    M.bronze_to_silver(spark, lake)
    M.silver_to_gold(spark, lake)
    return {name: state(spark, lake, name) for name in TABLES}


def started(spark, path, days):
    """A lakehouse after full runs over the first days of the log, and the rest of the log."""
    cut = F.lit(START + timedelta(days=days))
    everything = log(spark)
    lake = lakehouse(spark, path, everything.filter(F.col("recorded_at") < cut))
    M.bronze_to_silver(spark, lake)
    M.silver_to_gold(spark, lake)
    return lake, everything.filter(F.col("recorded_at") >= cut), everything


def test_folded_batches_equal_a_full_run(spark, tmp_path, full):
    lake, newer, everything = started(spark, tmp_path / "lake", 2)
    # Late half first, then a batch with events that are known already.
    M.fold_events(spark, lake, newer.filter("event_id > 'e3'"))
    known = (F.col("event_id") > "e3") | (F.col("event_id") < "e2")
    M.fold_events(spark, lake, everything.withColumn("catatan", F.when(known, "said again").otherwise(F.col("catatan"))))
    M.silver_to_gold(spark, lake, newer.select("id_wilayah"))
    for name in TABLES:
        assert state(spark, lake, name) == full[name], name


@pytest.mark.parametrize("failing", ["add", "append_sorted", "merge_table"])
def test_a_failed_fold_is_finished_by_the_next_try(spark, tmp_path, full, monkeypatch, failing):
    lake, newer, _ = started(spark, tmp_path / "lake", 2)
    module = idindex if failing == "add" else tables
    real = getattr(module, failing)

    def after(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(module, failing, after)
    with pytest.raises(RuntimeError):
        M.fold_events(spark, lake, newer, "batch 7")
    monkeypatch.setattr(module, failing, real)
    for _ in range(2):
        M.fold_events(spark, lake, newer, "batch 7")
    M.silver_to_gold(spark, lake, newer.select("id_wilayah"))
    for name in TABLES:
        assert state(spark, lake, name) == full[name], name


def test_folding_reads_neither_log_nor_history(spark, tmp_path, monkeypatch):
    lake, newer, _ = started(spark, tmp_path / "lake", 3)
    newer = tables.staged(spark, newer)
    read = []
    monkeypatch.setattr(tables, "read_log", lambda *a: read.append(a[1]))
    real = tables.read_table
    monkeypatch.setattr(tables, "read_table", lambda s, p, *a, **k: (read.append(p), real(s, p, *a, **k))[1])
    M.fold_events(spark, lake, newer)
    M.silver_to_gold(spark, lake, newer.select("id_wilayah"))
    assert read and not [p for p in read if p in (lake.path(M.SURVEY), lake.path(M.HISTORY))]


@pytest.mark.parametrize("streamed", [False, True])
def test_refreshes_broadcast_nothing_that_grows_with_the_units(spark, tmp_path, monkeypatch, streamed):
    """Whatever a full run, a folded batch or a stream writes: without heavy keys, Spark may broadcast rows of areas, ranges and clusters only."""
    everything, plans = log(spark), []
    for module in (joins, ranking):
        monkeypatch.setattr(module, "split_parts", lambda spark: 1)
    kind = type(everything)
    write = kind.write.fget
    monkeypatch.setattr(kind, "write", property(lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df)))
    if streamed:
        lake = lakehouse(spark, tmp_path / "lake", everything.filter("event_id < 'e2'"))
        M.bronze_to_silver(spark, lake)
        messages = tmp_path / "messages"
        everything.select(F.to_json(F.struct(*everything.columns)).alias("value")).write.text(str(messages))
        stream = files.read_events(spark, str(messages), schemas.SURVEY)
        ingest.start_refresh(stream, ingest.survey_refresh(spark, lake), str(tmp_path / "checkpoint"), interval=None).awaitTermination()
    else:
        lake, newer, _ = started(spark, tmp_path / "lake", 2)
        M.fold_events(spark, lake, newer)
        M.silver_to_gold(spark, lake, newer.select("id_wilayah"))
    keys = {key for plan in plans for on in re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan) for key in re.findall(r"(\w+)#", on)}
    assert "kelurahan" in keys and keys <= {"kelurahan", "kecamatan", "_range", "cluster_id"}
    assert sum("SortMergeJoin" in plan for plan in plans) > 10 and not any("BroadcastNestedLoopJoin" in plan for plan in plans)


def test_an_incremental_run_fits_nothing(spark, tmp_path, monkeypatch):
    lake, newer, _ = started(spark, tmp_path / "lake", 3)
    M.fold_events(spark, lake, newer)
    monkeypatch.setattr(ml, "fit_kmeans", lambda *a: pytest.fail("fitted"))
    M.silver_to_gold(spark, lake, newer.select("id_wilayah"))
    units = tables.read_table(spark, lake.path(M.RISK))
    kept = Clusters(tables.read_table(spark, lake.path(M.CLUSTER_MODEL)))
    assert units.filter("cluster_id is null").count() == 0 and farther_than_nearest(units, kept).count() == 0
    sizes = {r["cluster_id"]: r["jumlah_wilayah"] for r in tables.read_table(spark, lake.path(M.CLUSTERS)).collect()}
    assert sizes == {r["cluster_id"]: r["count"] for r in units.groupBy("cluster_id").count().collect()}


def test_stored_centres_assign_as_the_model_does(spark):
    rng = random.Random(1)
    rows = [event(f"e{i}", f"u{i}", START, [rng.randint(0, 3) for _ in range(6)] + [2]) for i in range(200)]
    latest = history.latest_indicators(events(spark, rows))
    model, assigned = ml.fit_kmeans(latest, 4)
    kept = Clusters(model_table(model, assigned))
    mine = {r["id_wilayah"]: (r["cluster_id"], r["cluster_rank"], r["cluster_label"]) for r in kept.assign(latest).collect()}
    theirs = {r["id_wilayah"]: (r["cluster_id"], r["cluster_rank"], r["cluster_label"]) for r in ml.label_clusters(assigned).collect()}
    assert mine == theirs
    columns = sorted(ml.cluster_summary(assigned).columns)
    one = {r["cluster_id"]: r for r in kept.summary(kept.assign(latest)).select(columns).collect()}
    for r in ml.cluster_summary(assigned).select(columns).collect():
        assert [pytest.approx(v, abs=1e-9) if isinstance(v, float) else v for v in r] == list(one[r["cluster_id"]])
    assert not kept.due(latest, 4) and kept.due(latest, 3) and kept.due(latest.unionByName(latest), 4)
    assert kept.due(latest.drop(V.INDICATORS[0]), 4)


def test_fewer_kinds_of_units_than_clusters(spark):
    rows = [event(f"e{i}", f"u{i}", START, [i % 2] * 7) for i in range(8)]
    _, assigned = ml.fit_kmeans(history.latest_indicators(events(spark, rows)), 4)
    assert assigned.select("cluster_id").distinct().count() == 2
    alike = [event(f"e{i}", f"u{i}", START, [1] * 7) for i in range(8)]
    assert ml.fit_kmeans(history.latest_indicators(events(spark, alike)), 4) is None


def score_rows(spark, rows):
    return spark.createDataFrame(rows, "id_wilayah string, recorded_at timestamp, event_id string, risk_score_saat_itu double")


def test_states_folded_in_any_order_equal_one_pass(spark):
    rng = random.Random(4)
    rows = []
    for unit in ("a", "b", "c"):
        for i in range({"a": 1, "b": 2, "c": 40}[unit]):
            at = None if rng.random() < 0.1 and unit == "c" else START + timedelta(seconds=rng.randint(0, 5 * 86_400))
            rows.append((unit, at, f"{unit}{i}", None if unit == "c" and i % 9 == 0 else rng.random() * 100))
    rows += [("same", START, f"s{i}", float(i)) for i in range(5)] + [(None, START, "n1", 5.0), (None, START + timedelta(days=1), "n2", 6.0), ("bare", None, "x", 3.0)]
    rng.shuffle(rows)
    everything = score_rows(spark, rows)
    kept = unit_state.event_state(score_rows(spark, rows[:20]))
    for at in range(20, len(rows), 15):
        batch = unit_state.event_state(score_rows(spark, rows[at : at + 15]))
        others = kept.join(batch.select(F.col("id_wilayah").alias("_i")), F.col("id_wilayah").eqNullSafe(F.col("_i")), "left_anti")
        kept = tables.staged(spark, unit_state.merge_state(kept, batch).unionByName(others))
    for mine, theirs in (
        (unit_state.trend_of(kept), history.trend(everything)),
        (unit_state.forecast_of(kept), forecast.forecast(everything)),
    ):
        got = {r["id_wilayah"]: r for r in mine.collect()}
        want = {r["id_wilayah"]: r for r in theirs.collect()}
        assert set(got) == set(want)
        for unit, row in want.items():
            for name, value in row.asDict().items():
                # The state's current score is the newest event's, timed or not.
                if name != "current_risk_score":
                    assert got[unit][name] == (pytest.approx(value, abs=1e-6) if isinstance(value, float) else value), (unit, name)


def test_index_finds_what_it_holds(spark, tmp_path):
    path = str(tmp_path / "index")
    ids = spark.range(5000).select(F.concat(F.lit("id"), "id").alias("event_id"))
    idindex.build(spark, path, ids.unionByName(spark.createDataFrame([(None,)], "event_id string")), "one")
    idindex.add(spark, path, spark.range(5000, 5100).select(F.concat(F.lit("id"), "id").alias("event_id")), "two")
    asked = spark.range(4990, 9000).select(F.concat(F.lit("id"), "id").alias("event_id"))
    found = {(r["id"], r["batch"]) for r in idindex.find(spark, path, asked).collect()}
    assert found == {(f"id{i}", "one" if i < 5000 else "two") for i in range(4990, 5100)}
    assert idindex.candidates(spark, path, asked).count() < 110 + 0.2 * 4000
    assert idindex.find(spark, path, asked.limit(0)) is None


def test_an_insert_reads_a_share_of_the_index(spark, tmp_path):
    path = str(tmp_path / "index")
    idindex.build(spark, path, spark.range(20_000).select(F.col("id").cast("string").alias("event_id")))
    found = idindex.find(spark, path, spark.createDataFrame([("7",), ("8",)], "event_id string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.split("\n") if "FileScan" in line and "batch#" in line]
    assert len(scan) == 1 and re.search(r"PartitionFilters: \[[^]]*folder#", scan[0]), plan
    assert sorted(r["id"] for r in found.collect()) == ["7", "8"]
    new = idindex.find(spark, path, spark.createDataFrame([("unseen",)], "event_id string"))
    assert new is None or new.count() == 0


def test_insert_new_keeps_first_rows_and_leaves_out_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "k string, v int")
    assert idindex.insert_new(spark, path, f"{path}-ids", rows, "k").count() == 2
    again = spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    assert [tuple(r) for r in idindex.insert_new(spark, path, f"{path}-ids", again, "k").collect()] == [("c", 2)]
    assert sorted(map(tuple, tables.read_table(spark, path).collect())) == [("a", 1), ("b", 1), ("c", 2)]


def test_schemas_grow_and_widen(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_table(spark.createDataFrame([(1, "a")], "id int, x string"), path)
    assert tables.stored_schema(spark, path) is None  # one schema needs no record
    tables.append_table(spark.createDataFrame([(2, True)], "id int, y boolean"), path)
    tables.append_table(spark.createDataFrame([(3_000_000_000, 1.5)], "id long, z double"), path)
    for read in (tables.read_table(spark, path), tables.read_log(spark, path, T.StructType([T.StructField("id", T.IntegerType())]))):
        assert dict(read.dtypes) == {"id": "bigint", "x": "string", "y": "boolean", "z": "double"}
        assert sorted(map(tuple, read.select("id", "x", "y", "z").collect())) == [(1, "a", None, None), (2, None, True, None), (3_000_000_000, None, None, 1.5)]
    lists = [spark.createDataFrame([([1],)], T.StructType([T.StructField("l", T.ArrayType(T.IntegerType(), inner))])) for inner in (True, False)]
    for rows in lists:
        tables.append_table(rows, f"{path}-lists")
    assert tables.stored_schema(spark, f"{path}-lists") is None
    with pytest.raises(ValueError, match="column x"):
        tables.append_table(spark.createDataFrame([(1,)], "x int"), path)
    tables.write_table(spark.createDataFrame([(9,)], "id int"), path)
    assert tables.read_table(spark, path).columns == ["id"]


def test_partitioned_tables_keep_columns_of_untouched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.merge_table(spark, path, spark.createDataFrame([("1", "007", 1), ("2", "008", 1)], "k string, p string, v int"), ["k"], ["p"])
    tables.merge_table(spark, path, spark.createDataFrame([("2", "008", 2, "n")], "k string, p string, v int, w string"), ["k"], ["p"])
    got = sorted(map(tuple, tables.read_table(spark, path, text=["p"]).select("k", "p", "v", "w").collect()))
    assert got == [("1", "007", 1, None), ("2", "008", 2, "n")]


def test_rows_are_numbered_in_file_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n\n" + "\n".join(f"a{i:06d}" for i in range(3000)))
    (tmp_path / "b.csv").write_text("n\n" + "\n".join(f"b{i:06d}" for i in range(500)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = files.numbered_rows(spark.read.csv(str(tmp_path), header=True, schema="n string")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 3500 and all(int(r["n"][1:]) == r["row_number"] for r in rows)


def test_keys_of_messages_make_their_ids(spark):
    names = [*schemas.SECONDARY.fieldNames(), *schemas.MESSAGE_KEYS]
    schema = ", ".join(f"{n} string" for n in names)
    rows = [{"idempotency_key": "k", "row_number": str(i % 2), "kelurahan": f"L{i}"} for i in range(3)] + [{"kelurahan": "L0"}, {"kelurahan": "L0"}, {"kelurahan": "L1", "idempotency_key": ""}]
    table = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
    got = [r["batch_id"] for r in ingest.typed_secondary(table).collect()]
    import uuid

    assert got[:3] == [str(uuid.uuid5(uuid.NAMESPACE_URL, f"secondary:k:{i % 2}")) for i in range(3)]
    assert got[3] == got[4] and len(set(got)) == 4
    said = ingest.typed_secondary(table).first()["raw_data"]
    assert "idempotency_key" not in json.loads(said) and json.loads(said)["kelurahan"] == "L0"


def test_strict_intake_asks_for_all_scores(spark):
    names = [*schemas.SURVEY.fieldNames(), "_corrupt_record"]
    rows = [{"id_wilayah": "u", **{c: "1" for c in V.INDICATORS}}, {"id_wilayah": "u", **{c: "1" for c in V.INDICATORS[1:]}}, {**{c: "1" for c in V.INDICATORS}}]
    table = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"{n} string" for n in names))
    good, bad = ingest.split_corrupt(table, schemas.SURVEY, ingest._required(schemas.SURVEY, strict=True))
    assert good.count() == 1 and sorted(r["reasons"][0] for r in bad.collect()) == ["id_wilayah missing", f"{V.INDICATORS[0]} missing"]
    assert ingest.split_corrupt(table, schemas.SURVEY)[0].count() == 2


def test_jobs_run_together_and_fail_together(spark):
    assert tables.together(lambda: 1, lambda: 2) == [1, 2] and tables.together() == []
    with pytest.raises(ZeroDivisionError):
        tables.together(lambda: 1, lambda: 1 / 0)
