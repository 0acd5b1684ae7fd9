"""Scoring by cluster lookup, cluster profiles and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import label
from tidemark.operators.joins import enrich
from tidemark.plans.bounds import Size
from tidemark.vocabulary import LABEL_MAP


def score_by_lookup(
    df: DataFrame,
    clusters: DataFrame,
    key: str = "PULocationID",
    cluster: str = "cluster_pca",
    mapping: dict = LABEL_MAP,
    proof: DataFrame | Size | None = None,
) -> DataFrame:
    """Add ``prediction`` and ``cluster_label`` to rows with a location; NULL for unknown zones."""
    scored = enrich(df.where(F.col(key).isNotNull()), clusters, key, key, {cluster: "prediction"}, proof)
    return scored.withColumn("cluster_label", label(F.col("prediction"), mapping))


def cluster_distribution(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    return df.groupBy(prediction).agg(F.count(F.lit(1)).alias("n")).orderBy(prediction)


def cluster_profile(clusters: DataFrame, cluster: str = "cluster_pca") -> DataFrame:
    """Zones and mean features per cluster."""
    # Feature column and its name in the profile.
    features = {
        "avg_distance": "avg_dist",
        "avg_fare": "avg_fare",
        "avg_tip": "avg_tip",
        "trips_count": "avg_trips",
        "green_taxi_ratio": "avg_green_ratio",
    }
    return (
        clusters.groupBy(F.col(cluster).alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n_zones"), *[F.avg(f).alias(name) for f, name in features.items()])
        .orderBy("prediction")
    )


def derive_labels(profile: DataFrame, mapping: dict = LABEL_MAP) -> DataFrame:
    """Name clusters from their profile rather than from a fixed map.

    Longest mean distance, then largest volume, then highest fare of those not yet
    named; whatever is left is the regular suburb. One row per cluster, so the
    picks are scalar subqueries over a handful of rows.
    """
    regular, distance, volume, premium = (mapping[i] for i in range(4))
    named = profile.withColumn("cluster_label", F.lit(None).cast("string"))
    for name, feature in ((distance, "avg_dist"), (volume, "avg_trips"), (premium, "avg_fare")):
        free = named.where(F.col("cluster_label").isNull())
        best = free.agg(F.max_by("prediction", F.struct(F.col(feature), -F.col("prediction")))).scalar()
        pick = F.col("cluster_label").isNull() & (F.col("prediction") == best)
        named = named.withColumn("cluster_label", F.when(pick, name).otherwise(F.col("cluster_label")))
    return named.withColumn("cluster_label", F.coalesce("cluster_label", F.lit(regular)))
