"""Time the headline queries and the ingest sweep; prints one JSON line.

BENCH_SF_DIR   data directory (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated query names instead of the headline set
BENCH_RUNS     ingest runs per rate (default 10)
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators.kpi import with_event_time  # noqa: E402
from tidemark.plans.bounds import run_dir  # noqa: E402
from tidemark.plans.layout import zorder_rewrite  # noqa: E402
from tidemark.sources.files import ingest, stream_dir  # noqa: E402
from tidemark.streaming.sinks import FileSink  # noqa: E402
from tidemark.streaming.stages import Stage, run_stage  # noqa: E402
from tidemark.vocabulary import SATURATION_S  # noqa: E402
from workload import views as w  # noqa: E402
from workload.queries import Flow, registry  # noqa: E402

HEADLINE = (
    "bronze_ingest",
    "silver_stream",
    "kpi_window_stream",
    "kpi_upsert",
    "gold_stream",
    "stages_end_to_end",
    "kpi_window_batch",
    "kpi_window_summary",
    "kpi_ci95",
    "kpi_compare",
    "point_lookup_count",
    "borough_stats",
    "quality_flagged",
    "quality_dashboard",
    "quarantine_repair",
    "anomaly_rate_sliding",
    "watermark_loss_whatif",
    "score_lookup",
    "drift_psi",
    "drift_alerts",
    "kmeans_lloyd",
    "zorder_compact",
)
RATES = (20, 50, 100, 200)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # Call-site capture costs several milliseconds per column expression in Python.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def ingest_sweep(spark: SparkSession, sf_dir: str, runs: int) -> dict[str, float]:
    """Mean seconds of one availableNow run over one new file of ``rate`` rows: ingest, then silver."""
    out = {}
    source = w.Source(spark, sf_dir)
    for rate in RATES:
        root = run_dir(spark, f"sweep-{rate}")
        schema = source.trips.schema
        bronze = Stage(
            "bronze", lambda: ingest(spark, f"{root}/in/*", schema), FileSink(f"{root}/bronze"), f"{root}/cp_bronze"
        )
        silver = Stage(
            "silver",
            lambda: source.locate(with_event_time(stream_dir(spark, f"{root}/bronze"), w.TIMES, w.TIMES[0])),
            FileSink(f"{root}/silver"),
            f"{root}/cp_silver",
        )
        spent: dict[str, list[float]] = {"ingest": [], "silver": []}
        for i in range(runs):
            part = source.trips.where(F.col("trip_id").between(i * rate, (i + 1) * rate - 1))
            part.coalesce(1).write.parquet(f"{root}/in/{i}")
            spent["ingest"].append(timed(lambda: run_stage(bronze)))
            spent["silver"].append(timed(lambda: run_stage(silver)))
        for layer, seconds in spent.items():
            out[f"{layer}_run_rate_{rate}"] = round(sum(seconds) / runs, 3)
        out[f"saturated_runs_rate_{rate}"] = float(sum(s > SATURATION_S for s in spent["ingest"]))
    return out


def silver_runs(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Mean of three silver runs over the whole stored bronze layer, zone table as it is and cached, in turn."""
    spent: dict[str, list[float]] = {"plain": [], "cached": []}
    # The first pair is not counted: it pays for class loading.
    for i in range(4):
        for tag in ("plain", "cached") if i % 2 else ("cached", "plain"):
            flow = Flow(spark, sf_dir, f"silver-{tag}")
            run_stage(flow.bronze())
            if tag == "cached":
                flow.source.zones.cache().count()
            seconds = timed(lambda: run_stage(flow.silver()))
            flow.source.zones.unpersist()
            if i:
                spent[tag].append(seconds)
    return {f"silver_run_{tag}": round(sum(s) / len(s), 3) for tag, s in spent.items()}


def compaction(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """A table of 1,000 rows in 40 files into one Z-ordered file, and a filtered scan before and after."""
    before, after = run_dir(spark, "compact"), run_dir(spark, "compact")
    columns = [w.TIMES[0], "PULocationID"]
    w.Source(spark, sf_dir).trips.orderBy("trip_id").limit(1000).repartition(40).write.parquet(before)

    def scan(path: str) -> None:
        spark.read.parquet(path).where("PULocationID = 24").count()

    return {
        "scan_40_files": timed(lambda: scan(before)),
        "zorder_1000_rows": timed(lambda: zorder_rewrite(spark.read.parquet(before), columns, after, files=1)),
        "scan_1_file": timed(lambda: scan(after)),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    runs = int(os.environ.get("BENCH_RUNS", "10"))
    spark, todo = session(), registry()
    # The first stream and the first batch query pay for class loading; they are not timed.
    for name in ("kpi_window_stream", "drift_alerts"):
        consume(todo[name](spark, sf_dir))
    spent = {name: timed(lambda name=name: consume(todo[name](spark, sf_dir))) for name in names}
    total = round(sum(spent.values()), 3)
    runs_spent = {**ingest_sweep(spark, sf_dir, runs), **silver_runs(spark, sf_dir), **compaction(spark, sf_dir)}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": total,
                "unit": "sec",
                "queries": {**spent, **runs_spent},
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
