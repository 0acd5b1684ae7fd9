"""Trip-shaped views of the driver tables.

Each view is one list of SQL expressions valid in Spark and in DuckDB, so both
engines see the same input rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.clustering import zone_features
from tidemark.operators.joins import enrich
from tidemark.operators.quality import clean_rows, flag, reference_stats, route, taxi_rules, z_score
from tidemark.operators.scoring import score_by_lookup
from tidemark.plans.bounds import Size, measure
from tidemark.sources.files import ingest, one_path

TIMES = ["tpep_pickup_datetime", "tpep_dropoff_datetime"]

TRIPS = {
    "trip_id": "event_id",
    "VendorID": "CAST(event_id % 2 + 1 AS INT)",
    "tpep_pickup_datetime": "ts",
    "tpep_dropoff_datetime": """CASE WHEN event_id % 41 = 0 THEN ts - INTERVAL '7' MINUTE
        ELSE ts + INTERVAL '12' MINUTE END""",
    "passenger_count": "CAST(event_id % 6 + 1 AS INT)",
    "trip_distance": """CASE WHEN event_id % 37 = 0 THEN CAST(0 AS DOUBLE)
        WHEN event_id % 43 = 0 THEN CAST(9999 AS DOUBLE)
        WHEN event_id % 47 = 0 THEN CAST(NULL AS DOUBLE) ELSE value / CAST(10 AS DOUBLE) END""",
    "PULocationID": """CASE WHEN event_id % 31 = 0 THEN CAST(NULL AS INT)
        WHEN day(ts) > 15 AND event_id % 2 = 0 THEN 24 ELSE CAST(user_id % 30 AS INT) END""",
    "DOLocationID": "CAST((user_id + event_id) % 30 AS INT)",
    "payment_type": "CAST(event_id % 4 + 1 AS INT)",
    "fare_amount": "CASE WHEN event_id % 29 = 0 THEN -value ELSE value * CAST(0.8 AS DOUBLE) END",
    "tip_amount": "value * CAST(0.1 AS DOUBLE)",
    "total_amount": """CASE WHEN event_id % 23 = 0 THEN -value WHEN event_id % 59 = 0 THEN CAST(NULL AS DOUBLE)
        WHEN event_id % 53 = 0 THEN value + CAST(1000 AS DOUBLE) ELSE value END""",
    "sim_batch_id": "CAST(day(ts) AS INT)",
    "sim_is_corrupted": """(event_id % 41 = 0 OR event_id % 37 = 0 OR event_id % 43 = 0 OR event_id % 31 = 0
        OR event_id % 29 = 0 OR event_id % 23 = 0 OR event_id % 53 = 0)""",
}

TRIPS_LATE = {
    "trip_id": "event_id",
    "arrival_batch": "CAST(floor(event_id / CAST(20 AS DOUBLE)) AS INT)",
    "pickup": """CASE WHEN event_id % 20 = 3 THEN ts - INTERVAL '2' MINUTE
        WHEN event_id % 20 = 9 THEN ts - INTERVAL '7' MINUTE
        WHEN event_id % 20 = 15 THEN ts - INTERVAL '90' MINUTE ELSE ts END""",
    "value": "value",
}

# A trip arrives with its day; one in twenty arrives three days late.
ARRIVAL = "CAST(day(ts) + CASE WHEN event_id % 20 = 15 THEN 3 ELSE 0 END AS INT)"

# Columns of the full schema, added to trips.
WIDE = {
    "store_and_fwd_flag": "CASE WHEN trip_id % 61 = 0 THEN 'Y' ELSE 'N' END",
    "extra": """CASE WHEN trip_id % 67 = 0 THEN CAST(7.5 AS DOUBLE) WHEN trip_id % 71 = 0 THEN CAST(-1 AS DOUBLE)
        ELSE CAST(0.5 AS DOUBLE) END""",
    "mta_tax": "CASE WHEN trip_id % 73 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END",
    "improvement_surcharge": "CASE WHEN trip_id % 79 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0.3 AS DOUBLE) END",
    "tolls_amount": "CASE WHEN trip_id % 13 = 0 THEN CAST(6.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "congestion_surcharge": "CASE WHEN trip_id % 3 = 0 THEN CAST(2.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "airport_fee": "CASE WHEN trip_id % 11 = 0 THEN CAST(1.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "cbd_congestion_fee": "CASE WHEN trip_id % 7 = 0 THEN CAST(0.75 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
}

# The total that the nine components add up to; one trip in 83 is off by a dollar.
BILL = {
    "billed": """fare_amount + tip_amount + mta_tax + extra + improvement_surcharge + tolls_amount
        + congestion_surcharge + airport_fee + cbd_congestion_fee
        + CASE WHEN trip_id % 83 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END""",
}

# Payloads as they come: fitting, unfit, nested, null, malformed, missing and too large values.
PAYLOAD = """CASE event_id % 7 WHEN 1 THEN '{"k": "x"}' WHEN 2 THEN '{"k": 5, "extra": {"a":[1,2]}}'
    WHEN 3 THEN '{"k": null}' WHEN 4 THEN 'not json' WHEN 5 THEN CAST(NULL AS STRING)
    WHEN 6 THEN '{"k": 99999999999}' ELSE props END"""

# Events of the days from which on payloads change.
SECOND_HALF = "day(ts) > 15"

# A larger batch history with wider ids, standing beside the stream.
HISTORY = {
    "PULocationID": "CAST(l_suppkey % 30 AS BIGINT)",
    "tpep_pickup_datetime": "l_shipdate",
    "total_amount": "l_extendedprice / CAST(150 AS DOUBLE)",
}

# Order lines that look up an order; a hot key, missing keys and keys without a match.
LOOKUPS = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "wanted": """CASE WHEN l_linenumber % 3 = 0 THEN 1 WHEN l_linenumber = 7 THEN NULL
        WHEN l_linenumber = 5 THEN -l_orderkey ELSE l_orderkey END""",
}


def project(df: DataFrame, columns: dict[str, str], keep: bool = False) -> DataFrame:
    """Apply a view's expressions; works on streams."""
    return df.selectExpr(*(["*"] if keep else []), *[f"{sql} AS {name}" for name, sql in columns.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).selectExpr(
        "n_nationkey AS LocationID",
        "r_name AS Borough",
        "n_name AS Zone",
        "CASE WHEN n_nationkey % 5 = 4 THEN 'Airports' ELSE 'Yellow Zone' END AS service_zone",
    )


class Source:
    """The views of one data directory. The zone table is measured once and bounds every lookup."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def zones(self) -> DataFrame:
        return zones(self.spark, self.sf_dir)

    @cached_property
    def zone_size(self) -> Size:
        return measure(self.zones, "LocationID")

    @cached_property
    def trips(self) -> DataFrame:
        return project(table(self.spark, self.sf_dir, "events"), TRIPS)

    @cached_property
    def trips_late(self) -> DataFrame:
        return project(table(self.spark, self.sf_dir, "events"), TRIPS_LATE)

    @cached_property
    def trips_wide(self) -> DataFrame:
        return project(self.trips, WIDE, keep=True)

    @cached_property
    def trips_billed(self) -> DataFrame:
        return project(self.trips_wide, BILL, keep=True)

    @cached_property
    def history(self) -> DataFrame:
        return project(table(self.spark, self.sf_dir, "lineitem"), HISTORY)

    @cached_property
    def silver(self) -> DataFrame:
        return self.locate(self.trips)

    @cached_property
    def stats(self) -> DataFrame:
        return borough_stats(self.silver)

    @cached_property
    def flagged(self) -> DataFrame:
        return self.flag(self.silver, self.stats)

    @cached_property
    def gold(self) -> DataFrame:
        return route(self.flagged)[0]

    @cached_property
    def quarantine(self) -> DataFrame:
        return route(self.flagged)[1]

    @cached_property
    def zone_clusters(self) -> DataFrame:
        """The clustered dimension; zone 23 is absent from the model on purpose."""
        features = zone_features(self.trips).where(F.col("PULocationID") != 23)
        cluster = "CASE WHEN PULocationID = 24 THEN 1 ELSE CAST(PULocationID % 4 AS INT) END"
        return features.join(self.zones, F.col("PULocationID") == F.col("LocationID")).select(
            *features.columns, "Borough", "Zone", F.expr(cluster).alias("cluster_pca")
        )

    @cached_property
    def classified(self) -> DataFrame:
        return self.score(self.gold, self.zone_clusters)

    def locate(self, df: DataFrame) -> DataFrame:
        """Add the pick-up borough and zone."""
        keep = {"Borough": "pickup_borough", "Zone": "pickup_zone"}
        return enrich(df, self.zones, "PULocationID", "LocationID", keep, self.zone_size)

    def flag(self, rows: DataFrame, stats: DataFrame, rules=None) -> DataFrame:
        """Score and flag; there are no more boroughs than zones."""
        return flag(z_score(rows, stats, "pickup_borough", "total_amount", self.zone_size), rules or taxi_rules())

    def score(self, rows: DataFrame, clusters: DataFrame) -> DataFrame:
        return score_by_lookup(rows, clusters, proof=self.zone_size)


def borough_stats(silver: DataFrame) -> DataFrame:
    return reference_stats(silver, "pickup_borough", "total_amount", clean_rows())


def stage_arrivals(spark: SparkSession, sf_dir: str, path: str, rows_per_file: int = 1_000_000) -> int:
    """Write the events as they arrive, one folder after the other, and return the files of each arrival.

    One partitioned write comes first, so that an arrival is read without the others. The file source goes by the
    time of the files, so the arrivals are written in turn; there are as many as days.
    """
    events = table(spark, sf_dir, "events").withColumn("arrival", F.expr(ARRIVAL))
    events.write.partitionBy("arrival").parquet(f"{path}_by_arrival")
    apart = spark.read.parquet(f"{path}_by_arrival")
    counts = {r["arrival"]: r["n"] for r in apart.groupBy("arrival").agg(F.count(F.lit(1)).alias("n")).collect()}
    files = max(1, max(counts.values()) // rows_per_file)
    for arrival in sorted(counts):
        apart.where(F.col("arrival") == arrival).drop("arrival").repartition(files).write.parquet(f"{path}/{arrival:04d}")
    return files


def arrival_stream(spark: SparkSession, sf_dir: str, path: str, files: int) -> DataFrame:
    """Staged arrivals as trips, one arrival a micro-batch."""
    raw = ingest(spark, f"{path}/*", table(spark, sf_dir, "events").schema, max_files=files)
    return raw.selectExpr(*[f"{sql} AS {name}" for name, sql in TRIPS.items()], "ingestion_timestamp", "source_file")


def trip_stream(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Trips ingested incrementally from the event files, with lineage columns."""
    raw = ingest(spark, one_path(sf_dir, "events.parquet"), table(spark, sf_dir, "events").schema, **options)
    return raw.selectExpr(*[f"{sql} AS {name}" for name, sql in TRIPS.items()], "ingestion_timestamp", "source_file")
