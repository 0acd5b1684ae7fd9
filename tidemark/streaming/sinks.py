"""Sinks whose replays overwrite instead of duplicating, and the views that read them."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tidemark.operators.drift import psi_against, share_by_batch
from tidemark.operators.moments import as_statistics, merged, moments
from tidemark.plans.bounds import settings
from tidemark.streaming.carry import Carry, run_id, run_number
from tidemark.vocabulary import PSI_DRIFT, PSI_EPS, RETRAIN_AFTER

BatchWriter = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class FileSink:
    """Append to a directory; the sink's own log makes reads exactly-once."""

    path: str
    partition_by: tuple[str, ...] = ()
    format: str = "parquet"

    def start(self, writer: DataStreamWriter) -> StreamingQuery:
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        return writer.format(self.format).start(self.path)

    def conf(self) -> dict[str, str]:
        # A task keeps one file open per partition value instead of sorting all its rows by that
        # value. Past this many values Spark falls back to the sort.
        return {"spark.sql.maxConcurrentOutputFileWriters": "16"} if self.partition_by else {}


@dataclass(frozen=True)
class TableSink:
    """Append to a catalog table."""

    name: str
    format: str = "parquet"

    def start(self, writer: DataStreamWriter) -> StreamingQuery:
        return writer.format(self.format).toTable(self.name)

    def conf(self) -> dict[str, str]:
        return {}


@dataclass(frozen=True)
class BatchSink:
    """Hand every micro-batch to a function of (frame, batch id)."""

    write: BatchWriter

    def start(self, writer: DataStreamWriter) -> StreamingQuery:
        return writer.foreachBatch(self.write).start()

    def conf(self) -> dict[str, str]:
        return {}


COMMITS = "_run string, batch_id bigint, _attempt string, _at bigint"


def by_batch(path: str, partition_by: tuple[str, ...] = ()) -> BatchWriter:
    """Write each micro-batch to a directory of its own attempt, then commit it by one row in a table beside the data.

    Nothing is overwritten: a reader sees a batch once its row is there, and a replay commits a newer attempt. The
    run is the query's id, which its checkpoint keeps, so batch ids that start again do not hide later versions.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark, attempt = df.sparkSession, f"a{uuid.uuid4().hex}"
        run = run_id(spark)
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(f"{path}/data/run={run}/batch_id={batch_id}/attempt={attempt}")
        row = spark.createDataFrame([(run, batch_id, attempt, time.time_ns())], COMMITS)
        row.coalesce(1).write.mode("append").parquet(f"{path}/commits")

    return write


def committed(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest committed attempt of every batch, with ``run``, ``batch_id`` and ``committed_at``.

    The commit table has one row per micro-batch; the join prunes the directories it does not name.
    """
    commits = spark.read.schema(COMMITS).parquet(f"{path}/commits")
    newest = commits.groupBy("_run", "batch_id").agg(F.max(F.struct("_at", "_attempt")).alias("_last"))
    named = newest.select("_run", F.col("batch_id").alias("_batch"), "_last.*")
    rows = spark.read.option("basePath", f"{path}/data").parquet(f"{path}/data")
    on = (F.col("run") == F.col("_run")) & (F.col("batch_id") == F.col("_batch")) & (F.col("attempt") == F.col("_attempt"))
    return rows.join(named, on).drop("_run", "_batch", "attempt", "_attempt").withColumnRenamed("_at", "committed_at")


def latest_per_key(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Row per key as committed last.

    ``max_by`` combines on the map side, so a key updated in every batch is not gathered in one task.
    """
    versions = committed(spark, path)
    values = [c for c in versions.columns if c not in (*keys, "run", "batch_id", "committed_at")]
    return (
        versions.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), "committed_at").alias("_last"))
        .select(*keys, *[F.col(f"_last.{c}").alias(c) for c in values])
    )


def write_version(df: DataFrame, path: str, version: int) -> None:
    """Store and commit a whole snapshot beside earlier ones."""
    by_batch(path)(df, version)


def read_latest_version(spark: SparkSession, path: str) -> DataFrame:
    """Newest committed snapshot, whatever its number."""
    snapshots = committed(spark, path)
    newest = spark.read.schema(COMMITS).parquet(f"{path}/commits").agg(F.max("_at")).scalar()
    return snapshots.where(F.col("committed_at") == newest).drop("run", "batch_id", "committed_at")


def snapshots(path: str) -> BatchWriter:
    """Complete-mode writer: each batch stores the whole, bounded result as a new version."""
    return lambda df, batch_id: write_version(df, path, batch_id)


#: Breaches in a row up to and including a batch (the count starts anew after a retrain signal), and the batch's index.
ALERTS = StructType([StructField("consecutive", LongType()), StructField("psi", DoubleType()), StructField("verdict", StringType())])


def write_drift_history(
    path: str, category: str, baseline_path: str, eps: float = PSI_EPS, limit: float = PSI_DRIFT, after: int = RETRAIN_AFTER
) -> BatchWriter:
    """Store the stability index of every micro-batch with its alert state; read it back with ``read_drift_history``.

    The baseline is a stored table of one share per label. Every batch reads it, so a new one counts from then on. The
    counter of breaches is a state of one row, carried from batch to batch and from one checkpoint to the next; a batch
    without classified rows has no index and leaves the counter as it is.
    """
    history = Carry(path, ALERTS)

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        baseline = {r["label"]: r["share"] for r in spark.read.parquet(baseline_path).collect()}
        shares = share_by_batch(df.withColumn("_at", F.lit(batch_id)), "_at", category, tuple(baseline))
        found = psi_against(shares, "_at", baseline, eps).first()
        psi, verdict = (found["psi"], found["verdict"]) if found else (None, None)

        def alert(before: DataFrame | None) -> DataFrame:
            count = before.first()["consecutive"] if before is not None else 0
            if psi is not None:
                count = count % after + 1 if psi >= limit else 0
            return spark.createDataFrame([(count, psi, verdict)], ALERTS)

        history.step(spark, batch_id, alert)

    return write


def read_drift_history(spark: SparkSession, path: str, limit: float = PSI_DRIFT, after: int = RETRAIN_AFTER) -> DataFrame:
    """Stored indices with ``run``, the consecutive-breach counter as it was then, and the retrain signal."""
    return Carry(path, ALERTS).history(spark).where("psi IS NOT NULL").select(
        "run", "batch_id", "psi", "verdict", (F.col("psi") >= limit).alias("breach"), "consecutive", (F.col("consecutive") == after).alias("retrain")
    )


def refresh_statistics(path: str, key: str, value: str, clean: Column, score: Callable[[DataFrame, DataFrame, int], None]) -> BatchWriter:
    """Refresh the statistics of every key with each micro-batch, then hand the batch and the newest ones to ``score``.

    What is kept are mergeable moments, one row per key: a batch's own moments are combined with those of the batch
    before, so no earlier row is read again. ``score`` gets (batch, statistics, batch id).
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        own = moments(df, key, value, clean)
        newest = statistics_carry(path, df.schema[key]).step(
            spark, batch_id, lambda before: own if before is None else merged(before, own, key)
        )
        score(df, as_statistics(newest, key), batch_id)

    return write


def statistics_carry(path: str, key: StructField) -> Carry:
    moments_kind = [StructField("n", LongType()), StructField("mean", DoubleType()), StructField("m2", DoubleType())]
    return Carry(path, StructType([StructField(key.name, key.dataType), *moments_kind]))


#: Newest event times up to the batch, and up to the one before it.
SEEN = StructType([StructField("seen", TimestampType()), StructField("seen_before", TimestampType())])


def split_late(path: str, ts: str, delay: str, window: str, on_time: BatchWriter | None = None) -> BatchWriter:
    """Keep the rows that a windowed aggregate of this watermark would drop, for ``late_rows``, instead of losing them.

    A batch drops a row when the row's window ended at or before the newest event time of all batches but the last one,
    less the delay: the watermark that was in force when the batch before it began. Two times are carried for it. The
    batch is read once: late and other rows are two partitions of one write, which also observes the newest time.
    ``on_time`` gets the other rows as stored.
    """
    carry = Carry(path, SEEN)

    def write(df: DataFrame, batch_id: int) -> None:
        spark, newest = df.sparkSession, Observation()
        before = carry.before(spark, batch_id)
        seen, seen_before = before.first() if before is not None else (None, None)
        start = F.window(ts, window).getField("start")
        closed = F.lit(seen_before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        rows = df.withColumns({"window_start": start, "window_end": start + F.expr(f"INTERVAL {window}")})
        rows = rows.withColumn("late", F.coalesce(F.col("window_end") <= closed, F.lit(False)))
        at = f"{path}/rows/run={run_number(spark, path)}/batch_id={batch_id}"
        observed = rows.observe(newest, F.max(ts).alias("newest"))
        observed.write.partitionBy("late").mode("overwrite").parquet(at)
        if on_time:
            on_time(spark.read.schema(rows.schema).parquet(at).where(~F.col("late")).select(*df.columns), batch_id)
        times = [t for t in (newest.get["newest"], seen) if t is not None]
        carry.step(spark, batch_id, lambda _: spark.createDataFrame([(max(times, default=None), seen)], SEEN))

    return write


def late_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows that ``split_late`` set apart, with ``run``, ``batch_id`` and their closed window."""
    added = [("window_start", TimestampType()), ("window_end", TimestampType()), ("run", IntegerType()), ("batch_id", LongType()), ("late", BooleanType())]
    kinds = StructType([*schema.fields, *[StructField(name, kind) for name, kind in added]])
    return spark.read.schema(kinds).parquet(f"{path}/rows").where("late").drop("late")
