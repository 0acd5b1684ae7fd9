"""What batch functions carry along: upserts, statistics, late rows, alert state, progress."""

import dataclasses
import json
import math
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from test_streaming import Box, at

from tidemark.operators import kpi as k
from tidemark.operators.moments import as_statistics, merged, moments
from tidemark.operators.quality import observe_stream
from tidemark.streaming import carry, metrics
from tidemark.streaming.sinks import (
    BatchSink,
    late_rows,
    read_drift_history,
    refresh_statistics,
    split_late,
    write_drift_history,
)
from tidemark.streaming.stages import run_stage
from tidemark.streaming.upsert import UpsertTable


@pytest.fixture
def box(spark, tmp_path):
    return Box(spark, tmp_path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stage_of(box, sink, name, build=None):
    made = box.stage(build or (lambda: box.source(max_files=1, lineage=False)), sink)
    return dataclasses.replace(made, checkpoint=f"{made.checkpoint}_{name}", name=name)


def test_upsert_over_two_checkpoints_with_folds_and_replay(box, spark):
    kind = StructType.fromDDL("id int, x double")
    table = UpsertTable(spark, f"{box.path}/up", ["id"], kind, buckets=3, fold_every=2)
    seen = {}
    for name in ("a", "b"):
        for i in range(3):
            rows = [at(i, j if j else None, float(random.random())) for j in range(i, i + 4)]
            box.add(f"{name}{i}", rows)
            seen.update({r[0]: r[2] for r in rows})
        # The second checkpoint starts with batch 0 again and reads all files once more, in order.
        run_stage(stage_of(box, BatchSink(lambda df, i: table(df.select("id", "x"), i)), name))
        assert {r["id"]: r["x"] for r in table.read().collect()} == seen
    assert table.generation >= 2
    # A replay of the last batch, and a table object of another session.
    table(spark.createDataFrame([(9, 1.0)], kind), 10**6)
    again = UpsertTable(spark, f"{box.path}/up", ["id"], kind, buckets=3, fold_every=2)
    for _ in range(2):
        again(spark.createDataFrame([(9, 2.0)], kind), 10**6)
    assert {r["id"]: r["x"] for r in again.read().collect()} == {**seen, 9: 2.0}
    assert "Exchange" not in plan(again.read()) and "Bucketed: true" in plan(again.read())
    files = {f.rsplit("/", 1)[-1] for f in again.read().inputFiles()}
    assert len(files) <= 3 * 5


def test_moments_merge_like_one_pass(spark):
    rows = [(random.choice(["a", "b", None]), random.choice([None, random.gauss(1e6, 3)])) for _ in range(300)] + [("c", 5.0)]
    parts = [spark.createDataFrame(rows[i::4], "g string, x double") for i in range(4)]
    total = moments(parts[0], "g", "x")
    for part in parts[1:]:
        total = merged(total, moments(part, "g", "x"), "g")
    got = {r["g"]: r for r in as_statistics(total, "g").collect()}
    want = spark.createDataFrame(rows, "g string, x double").where("g IS NOT NULL AND x IS NOT NULL").groupBy("g").agg(
        F.avg("x").alias("m"), F.stddev("x").alias("s"), F.count("x").alias("n")).collect()
    assert len(got) == len(want) == 3
    for r in want:
        assert got[r["g"]]["n_samples"] == r["n"] and math.isclose(got[r["g"]]["mean_total"], r["m"], rel_tol=1e-12)
        assert (got[r["g"]]["std_total"] is None) == (r["s"] is None)
        assert r["s"] is None or math.isclose(got[r["g"]]["std_total"], r["s"], rel_tol=1e-9)


def test_statistics_go_on_over_checkpoints(box, spark):
    said = []

    def score(df, stats, batch_id):
        said.append({r["id"]: (r["n_samples"], r["mean_total"]) for r in stats.collect()})

    write = refresh_statistics(f"{box.path}/stats", "id", "x", F.col("x") > 0, score)
    box.add("a", [at(1, 1, 2.0), at(1, 2, 5.0), at(1, 1, -9.0)])
    box.add("b", [at(2, 1, 4.0)])
    run_stage(stage_of(box, BatchSink(write), "one"))
    assert said == [{1: (1, 2.0), 2: (1, 5.0)}, {1: (2, 3.0), 2: (1, 5.0)}]
    # Another checkpoint reads the files anew and goes on from the last state.
    run_stage(stage_of(box, BatchSink(write), "two"))
    assert said[2:] == [{1: (3, 8 / 3), 2: (2, 5.0)}, {1: (4, 3.0), 2: (2, 5.0)}]


def test_late_rows_are_those_that_spark_drops(box, spark):
    random.seed(8)
    for i in range(9):
        box.add(str(i), [at(i * 12 + random.randint(-60, 10), i * 10 + j) for j in range(10)])

    def rows():
        return k.with_event_time(box.source(max_files=1, lineage=False), ["ts"], "ts", "5 minutes")

    write = split_late(f"{box.path}/split", "ts", "5 minutes", "10 minutes")
    run_stage(stage_of(box, BatchSink(write), "split", rows))
    late = late_rows(spark, f"{box.path}/split", rows().schema)
    dropped = run_stage(box.stage(box.windows)).agg(F.sum("dropped_by_watermark")).first()[0]
    # Spark counts what it drops after rows of a batch and window are added up.
    assert late.select("batch_id", "window_start").distinct().count() == dropped > 3
    whole = {r["id"] for r in spark.read.schema(box.schema).parquet(f"{box.path}/in/*").collect()}
    kept = box.read().agg(F.sum("n")).first()[0]
    assert all(r["window_end"] - r["window_start"] == timedelta(minutes=10) for r in late.collect())
    assert kept <= len(whole) - late.count()
    # A replayed batch replaces what it wrote.
    before = late.count()
    write(rows_of(spark, box), 0)
    assert late_rows(spark, f"{box.path}/split", rows().schema).where("run = 0").count() == before


def rows_of(spark, box):
    return spark.read.schema(box.schema).parquet(f"{box.path}/in/0")


def test_alerts_over_two_checkpoints_replay_and_reset(box, spark):
    spark.createDataFrame([("A", 0.5), ("B", 0.5)], "label string, share double").write.parquet(f"{box.path}/base")
    path, calls = f"{box.path}/psi", []
    write = write_drift_history(path, "c", f"{box.path}/base")

    def twice(df, batch_id):
        # Every batch is written twice, as after a crash before its commit.
        write(df, batch_id)
        write(df, batch_id)
        calls.append(batch_id)

    def run(name, mixes):
        for i, (a, b) in enumerate(mixes):
            box.add(f"{name}{i}", [at(i, j, float(j < a)) for j in range(a + b)])
        build = lambda: box.source(max_files=1, glob=None).where(F.col("source_file").contains(f"/in/{name}")).withColumn(
            "c", F.when(F.col("x") > 0, "A").otherwise("B"))
        run_stage(stage_of(box, BatchSink(twice), name, build))

    run("p", [(5, 5), (1, 9), (1, 9)])
    run("q", [(0, 10), (1, 9), (5, 5), (0, 9)])
    rows = read_drift_history(spark, path).orderBy("run", "batch_id").collect()
    # The new checkpoint first sees the files of the old one as batches without rows, which leave the counter alone.
    assert [(r["run"], r["consecutive"], r["retrain"]) for r in rows] == [
        (0, 0, False), (0, 1, False), (0, 2, False), (1, 3, True), (1, 1, False), (1, 0, False), (1, 1, False)]


def test_progress_log_holds_little_and_counts_gaps(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(metrics, "HELD_REPORTS", 10)

    class Event:
        def __init__(self, i):
            self.progress = self
            self.runId, self.json = "r", json.dumps({"batchId": i, "numInputRows": 2})

    class Query:
        runId, recentProgress = "r", []
        lastProgress = {"batchId": 34}

    log = metrics.ProgressLog(spark, f"{tmp_path}/p")
    log.onQueryProgress(Event(0))
    log.follow(Query)
    for i in range(1, 35):
        log.onQueryProgress(Event(i))
        assert len(log.held) < 10
    assert log.frame(Query).agg(F.sum("num_input_rows")).first()[0] == 70
    log.onQueryProgress(Event(40))
    Query.lastProgress = {"batchId": 40}
    with pytest.raises(RuntimeError, match="5 progress reports"):
        log.frame(Query)


def test_observed_checks_of_a_stream(box, spark):
    checks = {"big": (F.count_if(F.col("x") > 1) / F.count(F.lit(1)), 0.2, 0.6), "any": (F.max("x"), 0.0, 2.0)}
    box.add("a", [at(1, 1, 2.0), at(2, 2, 1.0)])
    box.add("b", [at(3, 3, 1.0), at(3, 4, 9.0), at(3, 4, 9.0)])
    progress = run_stage(box.stage(lambda: observe_stream(box.source(max_files=1), "checks", checks)))
    rows = {(r["batch_id"], r["check_name"]): (r["value"], r["passed"]) for r in metrics.stream_verdicts(progress, "checks", checks).collect()}
    assert rows == {(0, "big"): (0.5, True), (0, "any"): (2.0, True), (1, "big"): (2 / 3, False), (1, "any"): (9.0, False)}


def test_carry_starts_empty_and_reads_one_state(spark, tmp_path):
    state = carry.Carry(f"{tmp_path}/c", StructType.fromDDL("n bigint"))
    assert state.before(spark, 0) is None
    for i in (0, 1, 1, 4):
        out = state.step(spark, i, lambda old: spark.sql(f"SELECT CAST({0 if old is None else old.first()[0]} + 1 AS BIGINT) AS n"))
    assert out.first()[0] == 3 and state.history(spark).count() == 3
    assert len(state.before(spark, 2).inputFiles()) == 1
