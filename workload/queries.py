"""One query per operator; each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from tidemark import vocabulary as v
from tidemark.operators import clustering as cl
from tidemark.operators import drift as dr
from tidemark.operators import kpi as k
from tidemark.operators import quality as q
from tidemark.operators import schema as sch
from tidemark.operators import scoring as sc
from tidemark.operators.joins import enrich
from tidemark.plans import layout as lay
from tidemark.plans.bounds import cut, run_dir, settings
from tidemark.plans.ordered import rolling_mean
from tidemark.sources.files import ingest, read_csv_dimension, stream_dir, stream_table
from tidemark.sources.rescue import RESCUED, rescue, rescue_json, rescue_variant
from tidemark.streaming.metrics import ingest_totals as totals
from tidemark.streaming.metrics import lateness_what_if, stream_verdicts
from tidemark.streaming.sinks import (
    BatchSink,
    FileSink,
    TableSink,
    by_batch,
    committed,
    read_drift_history,
    read_latest_version,
    refresh_statistics,
    snapshots,
    split_late,
    write_drift_history,
    write_version,
)
from tidemark.streaming.sinks import late_rows as kept_late
from tidemark.streaming.stages import Stage, run_continuously, run_stage, run_stages, start_stage, stop_started
from tidemark.streaming.upsert import UpsertTable
from workload import views as w

Query = Callable[[SparkSession, str], DataFrame]

BATCH = "sim_batch_id"
INGEST_FILES = 125
PICKUP = "tpep_pickup_datetime"
LLOYD_PASSES = 20
#: Rows of a full file and of the small files that micro-batches leave.
FULL_FILE_ROWS, SMALL_FILE_ROWS = 100_000, 250
#: Small files that one task writes.
TASK_FILES = 32

_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


def registry() -> dict[str, Query]:
    return dict(_registry)


def r6(df: DataFrame) -> DataFrame:
    """Doubles to 6 decimals, so that the order of summation does not show."""
    return df.select(
        *[
            F.round(f.name, 6).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def kpi_aggs() -> dict[str, Column]:
    return {"trip_count": F.count(F.lit(1)), "avg_total_amount": F.avg("total_amount")}


# -- stages shared by the streaming queries ---------------------------------------------------


class Flow:
    """Stage definitions of one run, all below one fresh folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, name: str):
        self.spark, self.sf_dir, self.root = spark, sf_dir, run_dir(spark, name)
        self.source = w.Source(spark, sf_dir)
        self.files: int | None = None

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def read(self, layer: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer))

    def stream(self, layer: str) -> DataFrame:
        return stream_dir(self.spark, self.path(layer))

    def stage(self, name: str, build: Callable[[], DataFrame], sink=None, mode: str = "append") -> Stage:
        # As many state partitions as cores, fixed at the first start.
        conf = {"spark.sql.shuffle.partitions": str(self.spark.sparkContext.defaultParallelism)}
        sink = sink or FileSink(self.path(name))
        return Stage(name, build, sink, f"{self.root}/_checkpoints/{name}", mode, conf=conf)

    def arrivals(self) -> DataFrame:
        """Trips in many micro-batches, as they arrive; staged once for a flow."""
        if self.files is None:
            self.files = w.stage_arrivals(self.spark, self.sf_dir, self.path("arrivals"))
        return w.arrival_stream(self.spark, self.sf_dir, self.path("arrivals"), self.files)

    def by_arrival(self) -> DataFrame:
        """Watermarked, located trips, one arrival a micro-batch."""
        return self.source.locate(k.with_event_time(self.arrivals(), w.TIMES, PICKUP))

    def bronze(self) -> Stage:
        return self.stage("bronze", lambda: w.trip_stream(self.spark, self.sf_dir))

    def silver(self) -> Stage:
        return self.stage("silver", lambda: k.without_zone(self.located("bronze"), w.TIMES))

    def located(self, layer: str | None = None) -> DataFrame:
        """Watermarked, located trips from a stored layer, or straight from the input files."""
        source = self.stream(layer) if layer else w.trip_stream(self.spark, self.sf_dir)
        return self.source.locate(k.with_event_time(source, w.TIMES, PICKUP))

    def kpi(self, rows: DataFrame) -> DataFrame:
        out = k.window_kpi(rows, PICKUP, ["pickup_borough"], kpi_aggs())
        return k.without_zone(out, ["window_start", "window_end"])

    def store_stats(self, silver: DataFrame) -> DataFrame:
        """Statistics are written once: a stream would otherwise recompute them in every micro-batch."""
        write_version(w.borough_stats(silver), self.path("stats"), 0)
        return read_latest_version(self.spark, self.path("stats"))

    def store_clusters(self) -> DataFrame:
        write_version(self.source.zone_clusters, self.path("clusters"), 0)
        return read_latest_version(self.spark, self.path("clusters"))

    def flagged_stream(self, rows: DataFrame, stats: DataFrame) -> DataFrame:
        return k.without_zone(self.source.flag(rows, stats), w.TIMES)

    def routed(self, layer: str | None = None, stats: DataFrame | None = None) -> Stage:
        """Gold and quarantine from one pass, as two partitions of one sink."""
        if stats is None:
            stats = self.store_stats(self.source.silver)
        sink = FileSink(self.path("routed"), ("route",))

        def build() -> DataFrame:
            rows = k.with_event_time(self.stream(layer), w.TIMES, PICKUP) if layer else self.located()
            return q.with_route(self.flagged_stream(rows, stats))

        return self.stage("routed", build, sink)

    def route(self, name: str) -> DataFrame:
        return self.read("routed").where(F.col("route") == name).drop("route")


def _shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(dr.share_by_batch(w.Source(spark, sf_dir).classified, BATCH, "cluster_label"))


def _business(df: DataFrame) -> DataFrame:
    return df.select(*w.TRIPS)


# -- sources and stream semantics -------------------------------------------------------------


@query
def bronze_ingest(spark, sf_dir):
    flow = Flow(spark, sf_dir, "bronze_ingest")
    run_stage(flow.bronze())
    name = F.element_at(F.split("source_file", "/"), -1)
    return flow.read("bronze").select(*w.TRIPS, name.alias("source_name"))


@query
def rescued_data(spark, sf_dir):
    events = w.table(spark, sf_dir, "events")
    ddl = "event_id bigint, ts timestamp_ntz, user_id int, event_type string, value double"
    return r6(rescue(events, spark.createDataFrame([], ddl).schema))


@query
def rescued_json(spark, sf_dir):
    events = w.table(spark, sf_dir, "events").select("event_id", "props")
    payload = events.withColumn("props", F.expr(w.PAYLOAD))
    return rescue_json(payload, "props", spark.createDataFrame([], "k int").schema)


@query
def rescued_variant(spark, sf_dir):
    """Payloads whose keys and kinds change in mid-stream; the old files are read with the new ones."""
    flow = Flow(spark, sf_dir, "rescued_variant")
    events = w.table(spark, sf_dir, "events").select("event_id", "ts", "props")
    late = F.expr(w.SECOND_HALF)
    parts = [events.where(~late), events.where(late).withColumn("props", F.expr(w.PAYLOAD))]
    pinned = StructType.fromDDL("k int")
    build = lambda: rescue_variant(ingest(spark, flow.path("in"), events.schema), "props", pinned)
    for part in parts:
        part.write.mode("append").parquet(flow.path("in"))
        run_stage(flow.stage("rescued", build))
    first = F.try_variant_get(RESCUED, "$.extra.a[0]", "int")
    return flow.read("rescued").select("event_id", "k", first.alias("first_extra"), F.to_json(RESCUED).alias(RESCUED))


@query
def dim_zones_csv(spark, sf_dir):
    path, dim = run_dir(spark, "zones_csv"), w.Source(spark, sf_dir).zones
    dim.write.option("header", True).csv(path)
    return read_csv_dimension(spark, path, dim.schema)


@query
def dimension_stored_once(spark, sf_dir):
    """The second call takes the stored table: it does not see a row that the CSV files got meanwhile."""
    path, dim = run_dir(spark, "zones_once"), w.Source(spark, sf_dir).zones
    table = f"zones_once_{uuid.uuid4().hex}"
    dim.write.option("header", True).csv(path)
    read_csv_dimension(spark, path, dim.schema, table)
    dim.selectExpr("CAST(-1 AS INT) AS LocationID", "Borough", "Zone", "service_zone").write.mode("append").option("header", True).csv(path)
    return read_csv_dimension(spark, path, dim.schema, table)


@query
def silver_stream(spark, sf_dir):
    flow = Flow(spark, sf_dir, "silver_stream")
    run_stages([flow.bronze(), flow.silver()])
    return flow.read("silver").select(*w.TRIPS, "pickup_borough", "pickup_zone")


@query
def kpi_window_stream(spark, sf_dir):
    flow = Flow(spark, sf_dir, "kpi_window_stream")
    run_stage(flow.stage("kpi", lambda: flow.kpi(flow.by_arrival())))
    return r6(flow.read("kpi"))


@query
def kpi_continuous(spark, sf_dir):
    """The same windows from a stream on a processing-time trigger, stopped when it has caught up."""
    flow = Flow(spark, sf_dir, "kpi_continuous")
    run_continuously(flow.stage("kpi", lambda: flow.kpi(flow.by_arrival())), "0 seconds")
    return r6(flow.read("kpi"))


@query
def kpi_upsert(spark, sf_dir):
    flow = Flow(spark, sf_dir, "kpi_upsert")
    kind = "window_start timestamp_ntz, window_end timestamp_ntz, pickup_borough string, trip_count bigint, avg_total_amount double"
    keys = ["window_start", "window_end", "pickup_borough"]
    table = UpsertTable(spark, flow.path("kpi"), keys, StructType.fromDDL(kind), fold_every=16)
    run_stage(flow.stage("kpi", lambda: flow.kpi(flow.by_arrival()), BatchSink(table), "update"))
    return r6(table.read())


@query
def late_rows(spark, sf_dir):
    """Rows whose window had closed when they came, kept by the stream that would drop them."""
    flow = Flow(spark, sf_dir, "late_rows")
    path = flow.path("split")
    run_stage(flow.stage("split", flow.by_arrival, BatchSink(split_late(path, PICKUP, v.WATERMARK, v.KPI_WINDOW))))
    late = kept_late(spark, path, flow.by_arrival().schema)
    return k.without_zone(late, ["window_start", "window_end"]).select("trip_id", "batch_id", "window_start", "window_end")


@query
def stats_refresh(spark, sf_dir):
    """Statistics after every micro-batch, and what they find odd in that batch."""
    flow = Flow(spark, sf_dir, "stats_refresh")
    key, value, out = "pickup_borough", "total_amount", flow.path("scored")

    def score(rows: DataFrame, stats: DataFrame, batch_id: int) -> None:
        odd = F.count_if(F.abs("z_score") > 3)
        scored = q.z_score(rows, stats, key, value, flow.source.zone_size)
        counts = scored.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), odd.alias("n_anomalies")).withColumnRenamed(key, "_at")
        found = stats.join(counts, F.col(key) == F.col("_at"), "left").drop("_at").na.fill(0, ["n_rows", "n_anomalies"])
        found.coalesce(1).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    sink = BatchSink(refresh_statistics(flow.path("moments"), key, value, q.clean_rows(), score))
    run_stage(flow.stage("stats", flow.by_arrival, sink))
    return r6(spark.read.parquet(out).withColumn("batch_id", F.col("batch_id").cast("bigint")))


@query
def stopped_streams(spark, sf_dir):
    """Two endless streams of trips, stopped by the library when they have caught up; what each had stored."""
    flow = Flow(spark, sf_dir, "stopped_streams")
    names = ["endless_a", "endless_b"]
    trips = lambda: w.trip_stream(spark, sf_dir).select("trip_id", "total_amount")
    endless = [replace(flow.stage(name, trips), trigger={"processingTime": "1 second"}) for name in names]
    for running in [start_stage(stage) for stage in endless]:
        running.processAllAvailable()
    stopped = [name for name in stop_started(spark) if name in names]
    stored = [flow.read(name).select(F.lit(name).alias("name"), "trip_id") for name in stopped]
    return reduce(DataFrame.unionByName, stored).groupBy("name").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def crash_replayed(spark, sf_dir):
    """A run that dies after it wrote a batch and before it committed it, and the run after it: every row once."""
    flow = Flow(spark, sf_dir, "crash_replayed")
    write, seen = by_batch(flow.path("out")), []

    def dies_once(rows: DataFrame, batch_id: int) -> None:
        write(rows.select("trip_id", "total_amount"), batch_id)
        seen.append(batch_id)
        if seen == [0, 1, 2]:
            raise RuntimeError("the process is lost here")

    stage = flow.stage("trips", flow.by_arrival, BatchSink(dies_once))
    try:
        run_stage(stage)
    except StreamingQueryException:
        run_stage(stage)
    rows = committed(spark, flow.path("out")).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return r6(rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_amount").alias("amount")))


@query
def ratio_assertion_stream(spark, sf_dir):
    """Range checks of every micro-batch, observed while it was written."""
    flow = Flow(spark, sf_dir, "ratio_assertion_stream")
    stats = flow.store_stats(flow.source.silver)
    build = lambda: q.observe_stream(flow.flagged_stream(flow.by_arrival(), stats), "ratios", _ratios())
    return r6(stream_verdicts(run_stage(flow.stage("flagged", build)), "ratios", _ratios()))


@query
def kpi_complete(spark, sf_dir):
    flow = Flow(spark, sf_dir, "kpi_complete")
    sink = BatchSink(snapshots(flow.path("kpi")))
    run_stage(flow.stage("kpi", lambda: flow.kpi(flow.located()), sink, "complete"))
    return r6(read_latest_version(spark, flow.path("kpi")))


@query
def gold_stream(spark, sf_dir):
    flow = Flow(spark, sf_dir, "gold_stream")
    run_stage(flow.routed())
    return r6(flow.route("gold").select("trip_id", "pickup_borough", "mean_total", "z_score", "quality_flag"))


@query
def quarantine_stream(spark, sf_dir):
    flow = Flow(spark, sf_dir, "quarantine_stream")
    run_stage(flow.routed())
    return r6(flow.route("quarantine").select("trip_id", "pickup_borough", "mean_total", "z_score", "quality_flag"))


@query
def restart_idempotent(spark, sf_dir):
    flow = Flow(spark, sf_dir, "restart_idempotent")
    stage = flow.routed()
    counts = []
    for _ in range(2):
        run_stage(stage)
        counts.append(cut(q.quality_summary(flow.read("routed"))))
    before, after = (c.select(F.lit(1).alias("_k"), "gold", "quarantine") for c in counts)
    return before.join(after.withColumnsRenamed({"gold": "gold_again", "quarantine": "quarantine_again"}), "_k").drop(
        "_k"
    )


@query
def layer_ratio(spark, sf_dir):
    flow = Flow(spark, sf_dir, "layer_ratio")
    run_stages([flow.bronze(), flow.silver()])
    return r6(k.layer_ratio(flow.read("bronze"), flow.read("silver"), BATCH, [5, 10]))


@query
def watermark_loss_whatif(spark, sf_dir):
    late = w.Source(spark, sf_dir).trips_late
    return r6(lateness_what_if(late, "arrival_batch", "pickup", ["1 minute", "5 minutes", "60 minutes"]))


@query
def ingest_totals(spark, sf_dir):
    """Progress of a run of 125 micro-batches, from the stored table of all runs."""
    flow = Flow(spark, sf_dir, "ingest_totals")
    events = w.table(spark, sf_dir, "events").withColumn("part", F.col("event_id") % INGEST_FILES)
    events.repartition(INGEST_FILES, "part").write.partitionBy("part").parquet(flow.path("in"))
    stage = flow.stage("raw", lambda: ingest(spark, flow.path("in"), events.drop("part").schema, max_files=1))
    run_stage(stage, flow.path("progress"))
    return totals(flow.read("progress")).select("micro_batches", "rows", "dropped_by_watermark")


@query
def classified_stream(spark, sf_dir):
    """Every classified row of the stream, scored from the stored clusters."""
    flow = Flow(spark, sf_dir, "classified_stream")
    run_stage(flow.routed())
    clusters = flow.store_clusters()

    def classify() -> DataFrame:
        gold = flow.stream("routed").where(F.col("route") == "gold").drop("route")
        return flow.source.score(gold, clusters)

    run_stage(flow.stage("classified", classify))
    return flow.read("classified").select("trip_id", "PULocationID", "prediction", "cluster_label")


@query
def table_chain(spark, sf_dir):
    """Bronze as a catalog table, and silver from that table as a stream."""
    flow = Flow(spark, sf_dir, "table_chain")
    name = f"bronze_{flow.root.rsplit('-', 1)[-1]}"
    bronze = flow.stage("bronze", lambda: w.trip_stream(spark, sf_dir), TableSink(name))
    silver = flow.stage("silver", lambda: k.without_zone(
        flow.source.locate(k.with_event_time(stream_table(spark, name), w.TIMES, PICKUP)), w.TIMES))
    run_stages([bronze, silver])
    return flow.read("silver").select(*w.TRIPS, "pickup_borough", "pickup_zone")


@query
def anomaly_rate_stream(spark, sf_dir):
    """Sliding anomaly counts as a stream, one arrival a micro-batch; closed windows only."""
    flow = Flow(spark, sf_dir, "anomaly_rate_stream")
    stats = flow.store_stats(flow.source.silver)

    def build() -> DataFrame:
        odd = flow.source.flag(flow.by_arrival(), stats).where(F.col("quality_flag") == v.ANOMALIE_STATISTIQUE)
        counts = odd.groupBy(F.window(PICKUP, "50 minutes", "10 minutes")).agg(F.count(F.lit(1)).alias("n_anomalies"))
        flat = counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n_anomalies")
        return k.without_zone(flat, ["window_start", "window_end"])

    run_stage(flow.stage("odd", build))
    return flow.read("odd")


@query
def stages_end_to_end(spark, sf_dir):
    flow = Flow(spark, sf_dir, "stages")
    run_stages([flow.bronze(), flow.silver()])
    silver = flow.read("silver")
    stats, clusters = flow.store_stats(silver), flow.store_clusters()

    def classify() -> DataFrame:
        gold = flow.stream("routed").where(F.col("route") == "gold").drop("route")
        return flow.source.score(gold, clusters)

    def kpi() -> DataFrame:
        return flow.kpi(k.with_event_time(flow.stream("silver"), [PICKUP], PICKUP))

    run_stages([flow.stage("kpi", kpi), flow.routed("silver", stats), flow.stage("classified", classify)])
    layers = {
        "bronze": flow.read("bronze"),
        "silver": silver,
        "kpi": flow.read("kpi"),
        "gold": flow.route("gold"),
        "quarantine": flow.route("quarantine"),
        "classified": flow.read("classified"),
    }
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
        for name, df in layers.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


# -- indicators -------------------------------------------------------------------------------


def _kpi_batch(spark, sf_dir):
    return k.window_kpi(w.Source(spark, sf_dir).silver, PICKUP, ["pickup_borough"], kpi_aggs())


@query
def kpi_window_batch(spark, sf_dir):
    return r6(_kpi_batch(spark, sf_dir)).orderBy(F.desc("window_start"), "pickup_borough")


@query
def kpi_window_summary(spark, sf_dir):
    return k.window_summary(_kpi_batch(spark, sf_dir), "pickup_borough")


@query
def kpi_ci95(spark, sf_dir):
    silver = w.Source(spark, sf_dir).silver
    return r6(k.mean_ci(silver, "pickup_borough", "total_amount", "stream")).orderBy("pickup_borough")


@query
def kpi_compare(spark, sf_dir):
    src = w.Source(spark, sf_dir)
    sides = {"stream": src.silver, "batch": src.locate(src.history)}
    kpis = [k.mean_ci(df, "pickup_borough", "total_amount", name) for name, df in sides.items()]
    return r6(k.compare_sources(*kpis, key="pickup_borough"))


@query
def tip_rate_by_borough(spark, sf_dir):
    src = w.Source(spark, sf_dir)
    parts = {
        "fare": ["fare_amount"],
        "tip": ["tip_amount"],
        "tax": ["mta_tax"],
        "toll": ["tolls_amount"],
        "surcharge": ["extra", "improvement_surcharge", "congestion_surcharge"],
        "fee": ["airport_fee", "cbd_congestion_fee"],
    }
    return r6(k.component_rates(src.locate(src.trips_billed), "pickup_borough", "billed", parts))


@query
def point_lookup_count(spark, sf_dir):
    # On the stored, Z-ordered layer, where the filter reaches the scan and skips row groups.
    trips = w.Source(spark, sf_dir).trips

    def write(path: str) -> None:
        lay.zorder_rewrite(trips, [PICKUP, "PULocationID"], path, files=_files(trips, FULL_FILE_ROWS), mode="overwrite")

    path = lay.layer_of(spark, "trips_zorder", f"{sf_dir}/events.parquet", write)
    return spark.read.parquet(path).where("PULocationID = 24").agg(F.count(F.lit(1)).alias("n"))


@query
def point_lookup_trips(spark, sf_dir):
    """Three trips by their id, one of them absent, from files that hash and Bloom filters make skippable."""
    trips = w.Source(spark, sf_dir).trips

    def write(path: str) -> None:
        lay.write_lookup_layer(trips, {"trip_id": FULL_FILE_ROWS}, path, _files(trips, FULL_FILE_ROWS))

    path = lay.layer_of(spark, "trips_by_id", f"{sf_dir}/events.parquet", write)
    found = spark.read.parquet(path).where(F.col("trip_id").isin(7, 778, -5))
    return r6(found.select("trip_id", PICKUP, "PULocationID", "total_amount"))


@query
def lookup_large(spark, sf_dir):
    """Lookup of a dimension that is not broadcast; one key holds a quarter of the facts, others have none or no match."""
    lines = w.project(w.table(spark, sf_dir, "lineitem"), w.LOOKUPS)
    keep = {"o_custkey": "o_custkey", "o_orderstatus": "o_orderstatus"}
    return enrich(lines, w.table(spark, sf_dir, "orders"), "wanted", "o_orderkey", keep, max_rows=0)


@query
def schema_diff(spark, sf_dir):
    return sch.schema_diff(w.Source(spark, sf_dir).trips, w.Source(spark, sf_dir).history)


@query
def latency_summary(spark, sf_dir):
    log = w.table(spark, sf_dir, "events").withColumnRenamed("event_type", "rate")
    return r6(k.latency_summary(log, "rate", "value", "event_id", threshold=200.0))


# -- quality ----------------------------------------------------------------------------------


@query
def borough_stats(spark, sf_dir):
    return r6(w.Source(spark, sf_dir).stats)


@query
def quality_flagged(spark, sf_dir):
    return r6(
        w.Source(spark, sf_dir).flagged.select(
            "trip_id", "pickup_borough", "mean_total", "std_total", "z_score", "quality_flag"
        )
    )


@query
def quality_dashboard(spark, sf_dir):
    return r6(q.quality_summary(w.Source(spark, sf_dir).flagged))


@query
def reject_rate_by_batch(spark, sf_dir):
    return r6(q.quality_summary(w.Source(spark, sf_dir).flagged, (BATCH,)))


@query
def anomaly_distribution(spark, sf_dir):
    return q.anomaly_distribution(w.Source(spark, sf_dir).flagged)


@query
def flag_coverage(spark, sf_dir):
    return q.flag_coverage(w.Source(spark, sf_dir).flagged)


@query
def dashboard_delta(spark, sf_dir):
    return r6(q.dashboard_delta(w.Source(spark, sf_dir).flagged, BATCH, 15, 31))


@query
def reject_rate_since(spark, sf_dir):
    return r6(q.quality_summary(w.Source(spark, sf_dir).flagged.where(F.col(BATCH) >= 16)))


@query
def quarantine_recall(spark, sf_dir):
    return r6(q.recall(w.Source(spark, sf_dir).flagged, "sim_is_corrupted"))


def _repaired(spark, sf_dir):
    return q.repair(w.Source(spark, sf_dir).quarantine)


@query
def quarantine_repair(spark, sf_dir):
    return _repaired(spark, sf_dir).select("trip_id", *w.TIMES, "quality_flag", "is_outlier", "disposition")


def _reinjected(spark, sf_dir):
    return q.repaired_gold(w.Source(spark, sf_dir).flagged)


@query
def gold_clean(spark, sf_dir):
    clean = _reinjected(spark, sf_dir).where(~F.col("is_outlier"))
    return r6(clean.select("trip_id", *w.TIMES, "total_amount", "quality_flag"))


@query
def gold_with_outliers(spark, sf_dir):
    return r6(_reinjected(spark, sf_dir).select("trip_id", *w.TIMES, "total_amount", "quality_flag", "is_outlier"))


@query
def extra_rules(spark, sf_dir):
    src = w.Source(spark, sf_dir)
    flagged = src.flag(src.locate(src.trips_wide), src.stats, [*q.taxi_rules(), *q.extra_rules()])
    return flagged.groupBy("quality_flag").agg(F.count(F.lit(1)).alias("n"))


def _ratios() -> q.Checks:
    valid = F.count_if(F.col("quality_flag") == v.VALIDE) / F.count(F.lit(1))
    located = F.count("pickup_borough") / F.count(F.lit(1))
    return {"valid_share": (valid, 0.70, 0.95), "located_share": (located, 0.85, 0.95)}


@query
def ratio_assertion(spark, sf_dir):
    return r6(q.check_ranges(w.Source(spark, sf_dir).flagged, _ratios()))


@query
def anomaly_rate_sliding(spark, sf_dir):
    odd = w.Source(spark, sf_dir).flagged.where(F.col("quality_flag") == v.ANOMALIE_STATISTIQUE)
    return k.sliding_counts(odd, PICKUP, [], {"n_anomalies": F.lit(True)}, "50 minutes", "10 minutes")


@query
def anomaly_rate_rolling(spark, sf_dir):
    odd = F.count_if(F.col("quality_flag") == v.ANOMALIE_STATISTIQUE)
    rates = w.Source(spark, sf_dir).flagged.groupBy(BATCH).agg((odd / F.count(F.lit(1))).alias("rate"))
    return r6(rolling_mean(cut(rates), BATCH, "rate", 5, "rolling_rate"))


# -- scoring and drift ------------------------------------------------------------------------


@query
def zone_features(spark, sf_dir):
    return r6(cl.zone_features(w.Source(spark, sf_dir).trips))


@query
def cluster_profile(spark, sf_dir):
    return r6(sc.cluster_profile(w.Source(spark, sf_dir).zone_clusters))


@query
def derived_labels(spark, sf_dir):
    profile = cut(sc.cluster_profile(w.Source(spark, sf_dir).zone_clusters))
    return sc.derive_labels(profile).select("prediction", "n_zones", "cluster_label")


@query
def score_lookup(spark, sf_dir):
    return w.Source(spark, sf_dir).classified.select("trip_id", "PULocationID", "prediction", "cluster_label")


@query
def cluster_label(spark, sf_dir):
    classified = w.Source(spark, sf_dir).classified
    return classified.groupBy("cluster_label").agg(F.count(F.lit(1)).alias("n"))


@query
def cluster_distribution(spark, sf_dir):
    return sc.cluster_distribution(w.Source(spark, sf_dir).classified)


@query
def score_unmatched(spark, sf_dir):
    unmatched = w.Source(spark, sf_dir).classified.where(F.col("prediction").isNull())
    return unmatched.agg(F.count(F.lit(1)).alias("n_unmatched"))


@query
def score_validation(spark, sf_dir):
    src = w.Source(spark, sf_dir)
    rows = src.gold.select("trip_id", "PULocationID", *cl.TRIP_FEATURES).na.drop()
    return sc.cluster_distribution(src.score(rows, src.zone_clusters))


@query
def latest_batch_dist(spark, sf_dir):
    # Stored by batch, so that only the newest batch's folder is read.
    classified = w.Source(spark, sf_dir).classified.select(BATCH, "cluster_label")
    path = lay.layer_of(spark, "classified", sf_dir, lambda to: classified.write.mode("overwrite").partitionBy(BATCH).parquet(to))
    latest = dr.latest_batch(spark.read.parquet(path), BATCH)
    return latest.groupBy(BATCH, "cluster_label").agg(F.count(F.lit(1)).alias("n"))


@query
def drift_monitor(spark, sf_dir):
    return r6(dr.share_by_batch(w.Source(spark, sf_dir).classified, BATCH, "cluster_label"))


@query
def drift_baseline(spark, sf_dir):
    return r6(dr.drift_baseline(dr.share_by_batch(w.Source(spark, sf_dir).classified, BATCH, "cluster_label"), BATCH))


@query
def drift_psi(spark, sf_dir):
    return r6(dr.psi(_shares(spark, sf_dir), BATCH))


@query
def drift_onset(spark, sf_dir):
    return dr.drift_onset(dr.psi(_shares(spark, sf_dir), BATCH), BATCH)


@query
def drift_alerts(spark, sf_dir):
    return r6(dr.retrain_signal(dr.psi(_shares(spark, sf_dir), BATCH), BATCH))


@query
def drift_history(spark, sf_dir):
    flow = Flow(spark, sf_dir, "drift_history")
    clusters, shares = flow.store_clusters(), _shares(spark, sf_dir)
    dr.drift_baseline(shares, BATCH).write.parquet(flow.path("baseline"))
    stats = flow.store_stats(flow.source.silver)

    def classify() -> DataFrame:
        gold = flow.source.flag(flow.by_arrival(), stats).where(F.col("quality_flag") == v.VALIDE)
        return flow.source.score(gold, clusters)

    sink = BatchSink(write_drift_history(flow.path("psi"), "cluster_label", flow.path("baseline")))
    run_stage(flow.stage("psi", classify, sink))
    return r6(read_drift_history(spark, flow.path("psi")).drop("run"))


# -- clustering -------------------------------------------------------------------------------


def _features(spark, sf_dir):
    return cl.trip_features(w.Source(spark, sf_dir).trips, keep=("trip_id",))


def _scaled(spark, sf_dir):
    features = _features(spark, sf_dir)
    moments = cl.feature_moments(features).first()
    return cl.standardise(features, moments), moments


def _lloyd(spark, sf_dir):
    """Centres, assigned rows and moments of one training, stored for all queries that read them."""

    def train(path: str) -> None:
        scaled, moments = _scaled(spark, sf_dir)
        init = cl.first_centres(scaled, "trip_id", cl.TRIP_FEATURES, 4)
        centres, assigned = cl.lloyd(scaled, cl.TRIP_FEATURES, init, max_iter=LLOYD_PASSES)
        cl.centre_frame(assigned, cl.TRIP_FEATURES, centres).write.mode("overwrite").parquet(f"{path}-centres")
        spark.createDataFrame([moments], cl.feature_moments(scaled).schema).write.mode("overwrite").parquet(f"{path}-moments")
        # Last: the layer counts as there from here on.
        assigned.write.mode("overwrite").parquet(path)

    path = lay.layer_of(spark, "lloyd", f"{sf_dir}/events.parquet", train)
    return spark.read.parquet(f"{path}-centres"), spark.read.parquet(path), spark.read.parquet(f"{path}-moments").first()


@query
def trip_features(spark, sf_dir):
    return r6(_scaled(spark, sf_dir)[0])


@query
def trip_sample(spark, sf_dir):
    # Unscaled features; of all rows, as a sample would grow no model at scale.
    return r6(_features(spark, sf_dir))


@query
def feature_moments(spark, sf_dir):
    return r6(cl.feature_moments(_features(spark, sf_dir)))


@query
def kmeans_lloyd(spark, sf_dir):
    _, assigned, _ = _lloyd(spark, sf_dir)
    return r6(assigned.select("trip_id", "cluster", "distance2"))


@query
def kmeans_distribution(spark, sf_dir):
    _, assigned, _ = _lloyd(spark, sf_dir)
    return sc.cluster_distribution(assigned, "cluster")


@query
def kmeans_centroids(spark, sf_dir):
    centres, _, moments = _lloyd(spark, sf_dir)
    return r6(cl.destandardise(centres, moments))


@query
def kmeans_inertia(spark, sf_dir):
    _, assigned, _ = _lloyd(spark, sf_dir)
    return r6(cl.inertia(assigned))


@query
def kmeans_ml(spark, sf_dir):
    features = _features(spark, sf_dir)
    model = cl.train_trip_model(features)
    return r6(
        model.transform(features)
        .groupBy("prediction")
        .agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in cl.TRIP_FEATURES])
    )


@query
def zone_clusters_ml(spark, sf_dir):
    features = cut(cl.zone_features(w.Source(spark, sf_dir).trips, clean=True))
    scored = cl.train_zone_model(features).transform(features)
    return r6(scored.select("PULocationID", *cl.ZONE_FEATURES, "cluster_pca"))


@query
def score_model_stream(spark, sf_dir):
    flow = Flow(spark, sf_dir, "score_model_stream")
    path = flow.path("model")
    cl.train_trip_model(_features(spark, sf_dir)).write().save(path)
    model = PipelineModel.load(path)

    def build() -> DataFrame:
        rows = cl.trip_features(w.trip_stream(spark, sf_dir), keep=("trip_id", BATCH))
        return model.transform(rows).select("trip_id", BATCH, "prediction")

    run_stage(flow.stage("scored", build))
    return flow.read("scored")


def _off_centre(scored: DataFrame, model: PipelineModel, vector: str, prediction: str) -> DataFrame:
    """Rows that are not with their nearest stored centre, told by plain distance expressions."""
    centres = [list(map(float, c)) for c in model.stages[-1].clusterCenters()]
    places = [f"_v{i}" for i in range(len(centres[0]))]
    parts = vector_to_array(vector)
    flat = scored.withColumns({p: parts[i] for i, p in enumerate(places)})
    return cl.assign(flat, tuple(places), centres).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("cluster") != F.col(prediction)).alias("n_off"),
        F.countDistinct(prediction).cast("bigint").alias("n_clusters"),
    )


@query
def zone_model_check(spark, sf_dir):
    """The zone model drops no zone and puts each at its nearest stored centre."""
    features = cut(cl.zone_features(w.Source(spark, sf_dir).trips, clean=True))
    path = run_dir(spark, "zone_model")
    cl.train_zone_model(features).write().save(path)
    model = PipelineModel.load(path)
    return _off_centre(model.transform(features), model, "pca", "cluster_pca")


@query
def trip_model_check(spark, sf_dir):
    """A stored trip model on a stream: rows as in the table, same clusters, each row at its nearest centre."""
    flow = Flow(spark, sf_dir, "trip_model_check")
    features = _features(spark, sf_dir)
    cl.train_trip_model(features).write().save(flow.path("model"))
    model = PipelineModel.load(flow.path("model"))
    build = lambda: model.transform(cl.trip_features(w.trip_stream(spark, sf_dir), keep=("trip_id",))).select("trip_id", "prediction")
    run_stage(flow.stage("scored", build))
    table = model.transform(features)
    streamed = flow.read("scored").select(F.col("trip_id").alias("_id"), F.col("prediction").alias("_streamed"))
    both = table.join(streamed, F.col("trip_id") == F.col("_id"), "full_outer")
    differ = both.agg(F.count_if(~F.col("prediction").eqNullSafe(F.col("_streamed"))).alias("n_differ"))
    return _off_centre(table, model, "scaled", "prediction").withColumn("n_differ", differ.scalar())


# -- layout -----------------------------------------------------------------------------------


def _files(df: DataFrame, rows: int) -> int:
    return max(1, math.ceil(df.count() / rows))


def _scattered(spark, sf_dir, name: str) -> str:
    """Trips stored the way many micro-batches leave them: in many small files.

    A task for every file takes longer to start and commit than to write. So a task gets the rows of many files, by their
    numbers in the table's own files, and only the last file of all is not full. Tasks commit their files themselves.
    """
    path, trips = run_dir(spark, name), w.Source(spark, sf_dir).trips
    rows = trips.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    # The driver lists the table's files anyway: their row counts are summed up in one window.
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select("_file", before.alias("_start"))
    task = F.floor((F.col("_start") + F.col("_index")) / F.lit(SMALL_FILE_ROWS * TASK_FILES)).cast("int")
    dealt = rows.join(F.broadcast(starts), "_file").repartitionById(math.ceil(_files(trips, SMALL_FILE_ROWS) / TASK_FILES), task)
    files = dealt.select(*trips.columns).write.option("maxRecordsPerFile", SMALL_FILE_ROWS)
    files.option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path)
    return path


@query
def zorder_compact(spark, sf_dir):
    path = run_dir(spark, "zorder_compact")
    trips = w.Source(spark, sf_dir).trips
    lay.zorder_rewrite(trips, [PICKUP, "PULocationID"], path, files=_files(trips, FULL_FILE_ROWS))
    return r6(_business(spark.read.parquet(path)))


@query
def file_stats(spark, sf_dir):
    before, after = _scattered(spark, sf_dir, "layout"), run_dir(spark, "layout")
    stored = spark.read.parquet(before)
    # A task reads hundreds of the small files, not 32: each pass has fewer tasks, and fewer sketches to merge.
    with settings(spark, {"spark.sql.files.openCostInBytes": str(256 * 1024)}):
        lay.zorder_rewrite(stored, [PICKUP, "PULocationID"], after, files=_files(stored, FULL_FILE_ROWS))
    rows = [
        lay.file_stats(spark, p).select(F.lit(tag).alias("layout"), "n_files", "n_rows")
        for tag, p in (("before", before), ("after", after))
    ]
    return rows[0].unionByName(rows[1])


@query
def layer_compacted(spark, sf_dir):
    """A layer by day, compacted in place; later rows of the odd days come in, and only these days are replaced."""
    path, trips = run_dir(spark, "layer_compacted"), w.Source(spark, sf_dir).trips
    later = F.expr(f"{BATCH} % 2 = 1 AND trip_id % 4 = 0")
    for rows in (trips.where(~later), trips.where(later)):
        rows.write.mode("append").partitionBy(BATCH).parquet(path)
        before = cut(lay.data_files(spark, path, [BATCH]))
        lay.compact(spark, path, [BATCH])
    after = lay.data_files(spark, path, [BATCH]).select("_file", F.lit(1).alias("_still"))
    kept = before.join(after, "_file", "left").groupBy(F.col(BATCH).alias("_day")).agg(F.count("_still").alias("n_kept"))
    rows = spark.read.parquet(path).groupBy(BATCH).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_amount").alias("amount"))
    joined = rows.join(kept, F.col(BATCH) == F.col("_day"))
    return r6(joined.select(BATCH, "n_rows", "amount", (F.col("n_kept") == 0).alias("replaced")))
