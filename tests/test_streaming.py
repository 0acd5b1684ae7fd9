import dataclasses
import time
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.operators import kpi as k
from tidemark.operators.quality import route, with_route
from tidemark.sources.files import ingest, stream_dir, stream_table
from tidemark.streaming.metrics import ingest_totals, lateness_what_if, progress_frame
from tidemark.streaming.sinks import (
    BatchSink,
    FileSink,
    TableSink,
    by_batch,
    committed,
    latest_per_key,
    read_drift_history,
    read_latest_version,
    snapshots,
    write_drift_history,
    write_version,
)
from tidemark.streaming.stages import ROCKSDB_STATE, Stage, run_continuously, run_stage, start_stage, stop_started

T0 = datetime(2024, 1, 1, 12)
DDL = "id int, ts timestamp, x double"


def at(minute, i=0, x=1.0):
    return (i, T0 + timedelta(minutes=minute), x)


class Box:
    """A folder of input files and the stages that read it."""

    def __init__(self, spark, path):
        self.spark, self.path, self.schema = spark, str(path), spark.createDataFrame([], DDL).schema

    def add(self, name, rows):
        self.spark.createDataFrame(rows, DDL).coalesce(1).write.parquet(f"{self.path}/in/{name}")
        time.sleep(0.02)

    def source(self, **options):
        return ingest(self.spark, f"{self.path}/in/*", self.schema, **options)

    def windows(self):
        rows = k.with_event_time(self.source(max_files=1, lineage=False), ["ts"], "ts", "5 minutes")
        return k.window_kpi(rows, "ts", [], {"n": F.count(F.lit(1))})

    def stage(self, build, sink=None, mode="append", name="s", **kw):
        return Stage(name, build, sink or FileSink(f"{self.path}/{name}"), f"{self.path}/_cp/{name}", mode, **kw)

    def read(self, name="s"):
        return self.spark.read.parquet(f"{self.path}/{name}")


@pytest.fixture
def box(spark, tmp_path):
    return Box(spark, tmp_path)


def run_late_files(box, stage):
    # Watermark 12:33 after the first file: 12:31 falls in an open window, 12:29 in a closed one.
    files = {"a": [at(38, 1)], "b": [at(31, 2), at(29, 3)], "c": [at(60, 4)]}
    reports = []
    for name, rows in files.items():
        box.add(name, rows)
        reports.append(run_stage(stage))
    return reports


def test_each_file_is_read_once_with_lineage(box):
    box.add("a", [at(1, 1), at(2, 2)])
    run_stage(box.stage(box.source))
    box.add("b", [at(3, 3)])
    progress = run_stage(box.stage(box.source))
    assert progress.groupBy().sum("num_input_rows").first()[0] == 1
    rows = box.read()
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 3]
    assert rows.where("ingestion_timestamp IS NULL OR NOT source_file LIKE '%.parquet'").count() == 0


def test_bounded_micro_batches(box):
    for i in range(4):
        box.add(str(i), [at(i, i)])
    progress = run_stage(box.stage(lambda: box.source(max_files=1)))
    totals = ingest_totals(progress).first()
    assert (totals["micro_batches"], totals["rows"]) == (4, 4)


def test_window_drops_only_rows_of_closed_windows(box):
    reports = run_late_files(box, box.stage(box.windows))
    got = {r["window_start"].minute: r["n"] for r in box.read().collect()}
    assert got == {30: 2}
    assert sum(r.groupBy().sum("dropped_by_watermark").first()[0] for r in reports) == 1


def test_settings_of_one_stage(box, spark):
    conf = {**ROCKSDB_STATE, "spark.sql.shuffle.partitions": "2"}
    before = {key: spark.conf.get(key, None) for key in conf}
    reports = run_late_files(box, box.stage(box.windows, conf=conf))
    assert {r["window_start"].minute: r["n"] for r in box.read().collect()} == {30: 2}
    assert sum(r.groupBy().sum("dropped_by_watermark").first()[0] for r in reports) == 1
    assert {key: spark.conf.get(key, None) for key in conf} == before
    state = spark.read.format("state-metadata").load(f"{box.path}/_cp/s").first()
    assert state["numPartitions"] == 2


def test_stateless_stage_keeps_late_rows(box):
    run_late_files(box, box.stage(lambda: k.with_event_time(box.source(), ["ts"], "ts", "5 minutes")))
    assert box.read().count() == 4


def test_update_mode_shows_open_windows_and_survives_replay(box):
    write, kept = by_batch(f"{box.path}/upsert"), []

    def upsert(df, batch_id):
        write(df, batch_id)
        kept.append((batch_id, df.collect(), df.schema))

    run_late_files(box, box.stage(box.windows, BatchSink(upsert), "update"))
    view = latest_per_key(box.spark, f"{box.path}/upsert", ["window_start", "window_end"])
    want = {(12, 30): 2, (13, 0): 1}
    assert {(r["window_start"].hour, r["window_start"].minute): r["n"] for r in view.collect()} == want
    for batch_id, rows, schema in kept:
        write(box.spark.createDataFrame(rows, schema), batch_id)
    again = latest_per_key(box.spark, f"{box.path}/upsert", ["window_start", "window_end"])
    assert {(r["window_start"].hour, r["window_start"].minute): r["n"] for r in again.collect()} == want


def test_complete_mode_keeps_whole_snapshots(box):
    def counts():
        return box.source(lineage=False).groupBy((F.col("id") % 2).alias("odd")).count()

    run_late_files(box, box.stage(counts, BatchSink(snapshots(f"{box.path}/snap")), "complete"))
    assert {r["odd"]: r["count"] for r in read_latest_version(box.spark, f"{box.path}/snap").collect()} == {0: 2, 1: 2}
    assert committed(box.spark, f"{box.path}/snap").select("batch_id").distinct().count() == 3


def test_versions_survive_a_new_checkpoint_and_uncommitted_attempts(box, spark):
    """Batch ids start again with a new checkpoint; the newest commit wins, and what was not committed is not read."""
    keys, path = ["id"], f"{box.path}/up"

    def stage(cp):
        box.add(cp, [at(i, i, float(i + (100 if cp == "b" else 0))) for i in range(3)])
        made = box.stage(lambda: box.source(max_files=1, lineage=False).select("id", "x"), BatchSink(by_batch(path)))
        return dataclasses.replace(made, checkpoint=f"{made.checkpoint}_{cp}", name=cp)

    run_stage(stage("a"))
    assert {r["id"]: r["x"] for r in latest_per_key(spark, path, keys).collect()} == {0: 0.0, 1: 1.0, 2: 2.0}
    run_stage(stage("b"))
    want = {0: 100.0, 1: 101.0, 2: 102.0}
    assert {r["id"]: r["x"] for r in latest_per_key(spark, path, keys).collect()} == want
    assert committed(spark, path).select("run").distinct().count() == 2
    run = committed(spark, path).first()["run"]
    spark.sql("SELECT CAST(0 AS INT) AS id, -1D AS x").write.parquet(f"{path}/data/run={run}/batch_id=9/attempt=ahalf")
    assert {r["id"]: r["x"] for r in latest_per_key(spark, path, keys).collect()} == want


def test_progress_is_complete_beyond_a_hundred_batches(box, spark):
    for i in range(105):
        box.add(str(i), [at(i % 60, i)])
    progress = run_stage(box.stage(lambda: box.source(max_files=1, lineage=False)), f"{box.path}/progress")
    assert progress.count() == 105 and progress.agg(F.sum("num_input_rows")).first()[0] == 105
    assert spark.read.parquet(f"{box.path}/progress").count() == 105


def test_file_sink_refuses_update_and_raw_complete(box):
    box.add("a", [at(1)])
    for build, mode in ((box.windows, "update"), (box.source, "complete")):
        with pytest.raises(Exception, match="(?i)output.mode|complete"):
            start_stage(box.stage(build, mode=mode, name=f"no_{mode}"))


def test_ntz_watermark_needs_the_cast(box):
    box.add("a", [at(1)])
    raw = box.source(lineage=False).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    with pytest.raises(Exception, match="EVENT_TIME"):
        start_stage(box.stage(lambda: raw.withWatermark("ts", "5 minutes"), name="ntz"))
    run_stage(box.stage(lambda: k.without_zone(k.with_event_time(raw, ["ts"], "ts"), ["ts"])))
    assert dict(box.read().dtypes)["ts"] == "timestamp_ntz"


def test_restart_adds_nothing(box):
    box.add("a", [at(i, i) for i in range(10)])
    stage = box.stage(box.source)
    run_stage(stage)
    run_stage(stage)
    assert box.read().count() == 10


def test_crash_between_write_and_commit(box):
    """The batch was written, the process died before the commit: the replay overwrites it."""
    box.add("a", [at(1, 1), at(2, 2)])
    write, calls = by_batch(f"{box.path}/out"), []

    def dies(df, batch_id):
        write(df, batch_id)
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("killed")

    stage = box.stage(box.source, BatchSink(dies))
    with pytest.raises(StreamingQueryException):
        run_stage(stage)
    run_stage(stage)
    assert calls == [0, 0]
    assert sorted(r["id"] for r in committed(box.spark, f"{box.path}/out").collect()) == [1, 2]


def test_one_pass_routes_equal_two_filters(box):
    box.add("a", [at(i, i) for i in range(20)])

    def flagged(df):
        return df.withColumn("quality_flag", F.when(F.col("id") % 3 == 0, "BAD").otherwise("VALIDE"))

    run_stage(box.stage(lambda: with_route(flagged(box.source())), FileSink(f"{box.path}/s", ("route",))))
    gold, rejected = route(flagged(box.spark.read.schema(box.schema).parquet(f"{box.path}/in/*")))
    for name, want in (("gold", gold), ("quarantine", rejected)):
        have = box.read().where(F.col("route") == name)
        assert {r["id"] for r in have.collect()} == {r["id"] for r in want.collect()}
    assert box.read().count() == 20


def test_one_batch_equals_many(box):
    for i in range(3):
        box.add(str(i), [at(i * 4 + j, i * 4 + j) for j in range(4)])
    run_stage(box.stage(lambda: box.source(max_files=1), name="many"))
    run_stage(box.stage(box.source, name="one"))
    cols = ["id", "ts", "x"]
    assert box.read("many").select(cols).exceptAll(box.read("one").select(cols)).count() == 0
    assert box.read("many").count() == box.read("one").count() == 12


def test_tables_chain(box, spark):
    box.add("a", [at(1, 1), at(2, 2)])
    run_stage(box.stage(box.source, TableSink("chain_bronze"), name="chain_bronze"))
    run_stage(box.stage(lambda: stream_table(spark, "chain_bronze").where("id > 1"), TableSink("chain_gold"), name="g"))
    assert [r["id"] for r in spark.table("chain_gold").collect()] == [2]


def test_stage_directory_as_stream(box, spark):
    box.add("a", [at(1, 1)])
    run_stage(box.stage(box.source, name="bronze"))
    run_stage(box.stage(lambda: stream_dir(spark, f"{box.path}/bronze"), name="next"))
    assert box.read("next").count() == 1


def test_continuous_trigger_and_stop(box, spark):
    box.add("a", [at(1, 1)])
    query = start_stage(box.stage(box.source, name="live", trigger={"processingTime": "200 milliseconds"}))
    query.processAllAvailable()
    box.add("b", [at(2, 2)])
    query.processAllAvailable()
    assert box.read("live").count() == 2
    assert progress_frame(query).groupBy().sum("num_input_rows").first()[0] == 2
    other = spark.readStream.format("rate").load().writeStream.format("noop").start()
    try:
        assert stop_started(spark) == ["live"]
        assert other.isActive and not query.isActive
    finally:
        other.stop()


def test_refreshed_statistics_reach_the_next_batch(box, spark):
    """Static data read inside the batch function follows its newest version."""
    stats = f"{box.path}/stats"

    def build():
        return box.source(max_files=1, lineage=False)

    def score(df, batch_id):
        mean = read_latest_version(spark, stats)
        by_batch(f"{box.path}/out")(df.join(F.broadcast(mean), "id", "left"), batch_id)

    stage = box.stage(build, BatchSink(score))
    write_version(spark.sql("SELECT 1 AS id, 10 AS m"), stats, 1)
    box.add("a", [at(1, 1)])
    run_stage(stage)
    write_version(spark.sql("SELECT 1 AS id, 20 AS m"), stats, 2)
    box.add("b", [at(2, 1)])
    run_stage(stage)
    assert sorted(r["m"] for r in committed(spark, f"{box.path}/out").collect()) == [10, 20]


def test_drift_history_counts_breaches_across_micro_batches(box, spark):
    mixes = [(5, 5), (5, 5), (1, 9), (0, 10), (1, 9), (5, 5)]
    for i, (a, b) in enumerate(mixes):
        box.add(str(i), [at(i, j, float(j < a)) for j in range(a + b)])

    def labelled():
        return box.source(max_files=1).withColumn("c", F.when(F.col("x") > 0, "A").otherwise("B"))

    spark.createDataFrame([("A", 0.5), ("B", 0.5)], "label string, share double").write.parquet(f"{box.path}/base")
    run_stage(box.stage(labelled, BatchSink(write_drift_history(f"{box.path}/psi", "c", f"{box.path}/base"))))
    rows = read_drift_history(spark, f"{box.path}/psi").orderBy("batch_id").collect()
    assert [r["consecutive"] for r in rows] == [0, 0, 1, 2, 3, 0]
    assert [r["batch_id"] for r in rows if r["retrain"]] == [4]


def test_lateness_what_if_by_brute_force(spark):
    rows = [(i // 5, T0 + timedelta(minutes=i - (40 if i % 7 == 0 else 0))) for i in range(60)]
    df = spark.createDataFrame(rows, "b int, ts timestamp")
    got = {r["delay"]: r["n_late"] for r in lateness_what_if(df, "b", "ts", ["1 minute", "38 minutes"]).collect()}
    for delay, minutes in (("1 minute", 1), ("38 minutes", 38)):
        late = 0
        for b, ts in rows:
            seen = [t for c, t in rows if c < b]
            late += bool(seen) and ts < max(seen) - timedelta(minutes=minutes)
        assert got[delay] == late


# -- continuous trigger -----------------------------------------------------------------------


def test_continuous_run_gives_the_rows_of_available_now(box, tmp_path):
    for name, rows in {"a": [at(38, 1)], "b": [at(31, 2), at(29, 3)], "c": [at(60, 4)]}.items():
        box.add(name, rows)
    progress = run_continuously(box.stage(box.windows, name="on"), "0 seconds")
    run_stage(box.stage(box.windows, name="now"))
    on, now = (sorted(map(tuple, box.read(n).collect())) for n in ("on", "now"))
    assert on == now and len(on) == 2
    assert progress.groupBy().sum("num_input_rows").first()[0] == 4 and not box.spark.streams.active
    files = [f.name for f in (tmp_path / "_cp" / "on" / "state").rglob("*")]
    assert any(f.endswith(".changelog") for f in files) and not any(f.endswith(".delta") for f in files)


def test_continuous_run_goes_on_where_it_stopped(box):
    box.add("a", [at(38, 1)])
    stage = box.stage(box.windows, name="on")
    run_continuously(stage, "0 seconds", seconds=4)
    box.add("b", [at(31, 2), at(29, 3)])
    box.add("c", [at(60, 4)])
    run_continuously(stage, "0 seconds")
    assert sum(r["n"] for r in box.read("on").collect()) == 2 and not box.spark.streams.active
