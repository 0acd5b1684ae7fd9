"""Progress of streaming queries as DataFrames, and loss by lateness."""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.functions.columns import ratio, seconds
from tidemark.operators.joins import enrich
from tidemark.operators.quality import Checks, judged
from tidemark.plans.bounds import cut, run_dir
from tidemark.plans.ordered import running

PROGRESS = (
    "batch_id bigint, num_input_rows bigint, batch_duration_ms bigint, input_rows_per_s double, "
    "processed_rows_per_s double, add_batch_ms bigint, planning_ms bigint, dropped_by_watermark bigint, "
    "state_rows bigint, watermark string, observed string"
)
#: Reports that are held before they are stored, about 1 KB each.
HELD_REPORTS = 500


def _report(p: dict) -> tuple:
    spent, state = p.get("durationMs", {}), p.get("stateOperators", [])
    return (
        p["batchId"],
        p["numInputRows"],
        p.get("batchDuration"),
        p.get("inputRowsPerSecond"),
        p.get("processedRowsPerSecond"),
        spent.get("addBatch"),
        spent.get("queryPlanning"),
        sum(s.get("numRowsDroppedByWatermark", 0) for s in state),
        sum(s.get("numRowsTotal", 0) for s in state),
        p.get("eventTime", {}).get("watermark"),
        json.dumps(p.get("observedMetrics", {})),
    )


class ProgressLog(StreamingQueryListener):
    """Takes each progress report of one query when it comes and stores them in runs of ``HELD_REPORTS``.

    What is held does not grow with the run, and what Spark itself keeps of the past does not matter. Reports of a query
    come in order; a missing batch id is counted in ``missing``. Without a path nothing is stored until the first
    ``HELD_REPORTS`` are full, so short runs write nothing.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path, self.own = spark, path, path is None
        self.query: str | None = None
        self.early: list[tuple[str, tuple]] = []
        self.held: list[tuple] = []
        self.last: int | None = None
        self.stored = self.missing = 0
        self.lock = threading.RLock()

    def follow(self, query: StreamingQuery) -> None:
        """Keep the reports of this run of ``query``; some may have come before."""
        with self.lock:
            self.query = str(query.runId)
            early, self.early = self.early, []
            for run, row in early:
                self._take(run, row)

    def _take(self, run: str, row: tuple) -> None:
        if run != self.query:
            return
        if self.last is not None and row[0] > self.last + 1:
            self.missing += row[0] - self.last - 1
        self.last = row[0] if self.last is None else max(row[0], self.last)
        self.held.append(row)
        if len(self.held) >= HELD_REPORTS:
            self._store()

    def _store(self) -> None:
        if self.held:
            self.path = self.path or run_dir(self.spark, "progress")
            rows, self.held = self.held, []
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
            self.stored += len(rows)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.lock:
            run, row = str(event.progress.runId), _report(json.loads(event.progress.json))
            if self.query is None:
                self.early.append((run, row))
            else:
                self._take(run, row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def frame(self, query: StreamingQuery, seconds: float = 5.0) -> DataFrame:
        """All reports of the ended run. The last ones may still be on their way; Spark keeps those too."""
        newest = query.lastProgress
        until = time.monotonic() + seconds
        while newest is not None and (self.last is None or self.last < newest["batchId"]) and time.monotonic() < until:
            time.sleep(0.01)
        with self.lock:
            for report in query.recentProgress:
                row = _report(json.loads(report.json))
                if self.last is None or row[0] > self.last:
                    self._take(self.query, row)
            if self.missing:
                raise RuntimeError(f"{self.missing} progress reports did not come")
            if self.own and not self.stored:
                return self.spark.createDataFrame(self.held, PROGRESS)
            self._store()
            return self.spark.read.schema(PROGRESS).parquet(self.path)


def progress_frame(query: StreamingQuery) -> DataFrame:
    """The progress reports that Spark still keeps of a running query, one row per report."""
    rows = [_report(json.loads(report.json)) for report in query.recentProgress]
    return SparkSession.active().createDataFrame(rows, PROGRESS)


def append_progress(progress: DataFrame, path: str, stage: str) -> None:
    """Add a run's reports to a stored table of all runs; one row per micro-batch, with the stage and the time."""
    progress.withColumns({"stage": F.lit(stage), "stored_at": F.current_timestamp()}).write.mode("append").parquet(path)


def stream_verdicts(progress: DataFrame, name: str, checks: Checks) -> DataFrame:
    """One row per micro-batch and check of the aggregates that ``observe_stream`` put on a stream under ``name``."""
    kind = "map<string, map<string, double>>"
    seen = progress.select("batch_id", F.from_json("observed", kind).getItem(name).alias("_seen")).where("_seen IS NOT NULL")
    rows = F.array(*[
        F.struct(F.lit(c).alias("check_name"), F.col("_seen").getItem(c).alias("value"), F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"))
        for c, (_, low, high) in checks.items()
    ])
    return judged(seen.select("batch_id", F.inline(rows)))


def ingest_totals(progress: DataFrame) -> DataFrame:
    """Micro-batches, rows, mean duration and mean throughput of a run."""
    return progress.agg(
        F.count(F.lit(1)).alias("micro_batches"),
        F.sum("num_input_rows").alias("rows"),
        F.avg("batch_duration_ms").alias("mean_duration_ms"),
        F.avg("processed_rows_per_s").alias("mean_rows_per_s"),
        F.sum("dropped_by_watermark").alias("dropped_by_watermark"),
    )


def lateness_what_if(df: DataFrame, batch: str, ts: str, delays: list[str]) -> DataFrame:
    """Rows older than the newest event time of earlier batches minus each delay.

    This is what a stateful query could lose at most under that watermark. The
    running maximum works on one row per arrival batch, computed once; the join
    back is broadcast only if that table is small.
    """
    per_batch = cut(df.groupBy(batch).agg(F.max(ts).alias("newest")))
    seen = running(per_batch, batch, {"seen": ("max", F.col("newest"))}, inclusive=False)
    rows = enrich(df.select(batch, ts), seen.select(batch, "seen"), batch, batch, {"seen": "seen"}, proof=per_batch)
    tagged = [(d, f"late_{seconds(d)}") for d in delays]
    wide = rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(ts) < F.col("seen") - F.expr(f"INTERVAL {d}")).alias(name) for d, name in tagged],
    )
    pairs = F.array(*[F.struct(F.lit(d).alias("delay"), F.col(name).alias("n_late")) for d, name in tagged])
    return wide.select("n_rows", F.inline(pairs)).select(
        "delay", "n_late", "n_rows", ratio(F.col("n_late"), F.col("n_rows")).alias("late_share")
    )
