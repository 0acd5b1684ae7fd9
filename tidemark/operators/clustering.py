"""Feature preparation and k-means over trips and zones."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidemark.functions.columns import nearest, safe_std
from tidemark.plans.bounds import stored

# Feature columns of the two models, and the bounds of a plausible trip below.
TRIP_FEATURES = ("trip_distance", "fare_amount", "total_amount", "tip_amount", "passenger_count")
ZONE_FEATURES = ("avg_distance", "avg_fare", "avg_tip", "trips_count", "green_taxi_ratio")


def trip_features(df: DataFrame, keep: tuple[str, ...] = (), columns: tuple[str, ...] = TRIP_FEATURES) -> DataFrame:
    """Complete feature rows of plausible trips, over the whole input."""
    return (
        df.where("trip_distance > 0 AND fare_amount > 0 AND total_amount > 0 AND tip_amount >= 0")
        .select(*keep, *columns)
        .na.drop(subset=list(columns))
    )


def feature_moments(df: DataFrame, columns: tuple[str, ...] = TRIP_FEATURES) -> DataFrame:
    """One row with ``mean_`` and ``std_`` of every feature; the deviation is made safe to divide by."""
    return df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[safe_std(F.stddev(c)).alias(f"std_{c}") for c in columns],
    )


def standardise(df: DataFrame, moments: Row, columns: tuple[str, ...] = TRIP_FEATURES) -> DataFrame:
    """Replace features by standard scores. The moments are one row of ``feature_moments``, taken as literals."""
    return df.withColumns({c: (F.col(c) - moments[f"mean_{c}"]) / moments[f"std_{c}"] for c in columns})


def destandardise(centres: DataFrame, moments: Row, columns: tuple[str, ...] = TRIP_FEATURES) -> DataFrame:
    """Centres back on the original scale."""
    return centres.withColumns({c: F.col(c) * moments[f"std_{c}"] + moments[f"mean_{c}"] for c in columns})


def assign(df: DataFrame, columns: tuple[str, ...], centres: list[list[float]]) -> DataFrame:
    """Add ``cluster`` and ``distance2``: k distance expressions per row, no join."""
    best = nearest(list(columns), centres)
    return df.withColumn("_best", best).select(
        *df.columns, F.col("_best.cluster").alias("cluster"), F.col("_best.distance2").alias("distance2")
    )


def first_centres(df: DataFrame, order: str, columns: tuple[str, ...], k: int) -> list[list[float]]:
    """The first k rows by ``order`` as starting centres."""
    return [[float(row[c]) for c in columns] for row in df.orderBy(order).limit(k).select(*columns).collect()]


def lloyd(
    df: DataFrame,
    columns: tuple[str, ...],
    init: list[list[float]],
    max_iter: int = 20,
    tol: float = 1e-4,
    keep: bool = True,
) -> tuple[list[list[float]], DataFrame]:
    """K-means by repeated passes; returns the centres and the rows with their last assignment.

    Each pass is one partial/final aggregation to k rows. Only those k rows reach
    the driver. An empty cluster keeps its centre; the pass that moves all centres
    by less than ``tol`` in total is the last. The assignment is the one made in
    that last pass, before the centres moved.
    """
    centres = used = [list(map(float, c)) for c in init]
    points = df.persist(StorageLevel.MEMORY_AND_DISK) if keep else df
    try:
        for _ in range(max_iter):
            used = centres
            means = {
                row["cluster"]: [row[c] for c in columns]
                for row in assign(points, columns, centres)
                .groupBy("cluster")
                .agg(*[F.avg(c).alias(c) for c in columns])
                .collect()
            }
            centres = [means.get(i, old) for i, old in enumerate(used)]
            moved = math.sqrt(sum((a - b) ** 2 for new, old in zip(centres, used) for a, b in zip(new, old)))
            if moved < tol:
                break
        # Written while the rows are at hand: later reads need neither the source nor the cache.
        assigned = stored(assign(points, columns, used), "lloyd") if keep else assign(df, columns, used)
    finally:
        if keep:
            points.unpersist()
    return centres, assigned


def centre_frame(like: DataFrame, columns: tuple[str, ...], centres: list[list[float]]) -> DataFrame:
    """The k centres as a frame with ``cluster`` and the feature columns."""
    schema = ", ".join(["cluster int", *[f"{c} double" for c in columns]])
    return like.sparkSession.createDataFrame([(i, *c) for i, c in enumerate(centres)], schema)


def inertia(assigned: DataFrame) -> DataFrame:
    """Within-cluster sum of squares and row count."""
    return assigned.agg(F.count(F.lit(1)).alias("n"), F.sum("distance2").alias("inertia"))


def zone_features(trips: DataFrame, clean: bool = False) -> DataFrame:
    """Per-zone features for the zone model."""
    rows = trips.where(F.col("PULocationID").isNotNull())
    if clean:
        rows = rows.where((F.col("trip_distance") > 0) & (F.col("trip_distance") < 100))
    return rows.groupBy("PULocationID").agg(
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("tip_amount").alias("avg_tip"),
        F.count(F.lit(1)).alias("trips_count"),
        F.avg(F.when(F.col("VendorID") == 2, 1.0).otherwise(0.0)).alias("green_taxi_ratio"),
    )


def _stages(columns: tuple[str, ...], handle_invalid: str) -> list:
    return [
        VectorAssembler(inputCols=list(columns), outputCol="raw_features", handleInvalid=handle_invalid),
        StandardScaler(inputCol="raw_features", outputCol="scaled", withMean=True, withStd=True),
    ]


def train_zone_model(features: DataFrame, k: int = 4, seed: int = 42, components: int = 2) -> PipelineModel:
    """Assemble, standardise, project and cluster zones; predicts ``cluster_pca``."""
    return Pipeline(
        stages=[
            *_stages(ZONE_FEATURES, "skip"),
            PCA(k=components, inputCol="scaled", outputCol="pca"),
            KMeans(k=k, seed=seed, featuresCol="pca", predictionCol="cluster_pca"),
        ]
    ).fit(features)


def train_trip_model(features: DataFrame, k: int = 4, seed: int = 42) -> PipelineModel:
    """Cluster single trips; the model can be saved, loaded and applied to a stream."""
    return Pipeline(
        stages=[*_stages(TRIP_FEATURES, "skip"), KMeans(k=k, seed=seed, featuresCol="scaled")]
    ).fit(features)
