"""Streaming stages: a plan, a sink, a checkpoint and a trigger."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.streaming.metrics import ProgressLog, append_progress
from tidemark.streaming.sinks import BatchSink, FileSink, TableSink, settings

AVAILABLE_NOW = {"availableNow": True}

# Keeps large state on local disk instead of the executor's heap.
ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}

# The same, with a checkpoint of only the changes after each micro-batch: short intervals do not upload whole state files.
CHANGELOG_STATE = {**ROCKSDB_STATE, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}

_started: set[str] = set()


@dataclass(frozen=True)
class Stage:
    """One streaming query. Each stage owns its checkpoint.

    ``conf`` holds session settings for this query only, such as the number of state
    partitions, fixed at the first start, or the state store.
    """

    name: str
    build: Callable[[], DataFrame]
    sink: FileSink | TableSink | BatchSink
    checkpoint: str
    mode: str = "append"
    trigger: dict = field(default_factory=lambda: dict(AVAILABLE_NOW))
    conf: dict[str, str] = field(default_factory=dict)


def start_stage(stage: Stage) -> StreamingQuery:
    """Start a stage without waiting; needed for continuous triggers."""
    df = stage.build()
    writer = (
        df.writeStream.queryName(stage.name)
        .outputMode(stage.mode)
        .option("checkpointLocation", stage.checkpoint)
        .trigger(**stage.trigger)
    )
    with settings(df.sparkSession, {**stage.sink.conf(), **stage.conf}):
        query = stage.sink.start(writer)
    _started.add(str(query.id))
    return query


def run_stage(stage: Stage, progress_path: str | None = None) -> DataFrame:
    """Run a stage to the end of the available input and return its progress, one row per micro-batch.

    With ``progress_path`` the progress is also added to the table stored there.
    """
    return _followed(stage, lambda query: query.awaitTermination(), progress_path)


def run_continuously(
    stage: Stage, every: str = "1 second", seconds: float | None = None, progress_path: str | None = None
) -> DataFrame:
    """Run a stage on a processing-time trigger and stop it: after ``seconds``, else when it has caught up with its input.

    State is held by RocksDB with changelog checkpoints unless the stage's ``conf`` says otherwise. The state store is
    fixed at the first start, so run a checkpoint always by this function or always by ``run_stage``. A micro-batch
    that is running when ``seconds`` are over is given up; the next run does it again. Returns the progress.
    """

    def wait(query: StreamingQuery) -> None:
        try:
            if seconds is None:
                query.processAllAvailable()
            else:
                query.awaitTermination(seconds)
        finally:
            query.stop()

    stage = replace(stage, trigger={"processingTime": every}, conf={**CHANGELOG_STATE, **stage.conf})
    return _followed(stage, wait, progress_path)


def _followed(stage: Stage, wait: Callable[[StreamingQuery], object], progress_path: str | None) -> DataFrame:
    """Start a stage, wait for it as told, and return what a listener heard of it."""
    spark = SparkSession.active()
    log = ProgressLog(spark)
    spark.streams.addListener(log)
    try:
        query = start_stage(stage)
        log.follow(query)
        wait(query)
        progress = log.frame(query)
    finally:
        spark.streams.removeListener(log)
    if progress_path:
        append_progress(progress, progress_path, stage.name)
    return progress


def run_stages(stages: Iterable[Stage]) -> dict[str, DataFrame]:
    """Run stages in order; each reads what the one before stored."""
    return {stage.name: run_stage(stage) for stage in stages}


def stop_started(spark: SparkSession) -> list[str]:
    """Stop the running queries this library started; others are left alone."""
    stopped = []
    for query in spark.streams.active:
        if str(query.id) in _started:
            query.stop()
            stopped.append(query.name)
    return stopped
