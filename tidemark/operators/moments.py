"""Mergeable moments: count, mean and sum of squared deviations per key, combined without going back to the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOMENTS = "n bigint, mean double, m2 double"


def moments(df: DataFrame, key: str, value: str, clean: Column | None = None) -> DataFrame:
    """(key, n, mean, m2) of the clean rows with a key and a value."""
    rows = df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    rows = rows if clean is None else rows.where(clean)
    n = F.count(value)
    return rows.groupBy(key).agg(n.alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * n).alias("m2"))


def merged(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Moments of both parts together, pair by pair; a key may be missing from either."""
    other = b.select(F.col(key).alias("_key"), F.col("n").alias("_n"), F.col("mean").alias("_mean"), F.col("m2").alias("_m2"))
    both = a.join(other, F.col(key) == F.col("_key"), "full_outer")
    n, n2 = F.coalesce("n", F.lit(0)), F.coalesce("_n", F.lit(0))
    total, gap = n + n2, F.coalesce("_mean", "mean") - F.coalesce("mean", "_mean")
    return both.select(
        F.coalesce(key, "_key").alias(key),
        total.cast("bigint").alias("n"),
        (F.coalesce("mean", "_mean") + gap * n2 / total).alias("mean"),
        (F.coalesce("m2", F.lit(0.0)) + F.coalesce("_m2", F.lit(0.0)) + gap * gap * n * n2 / total).alias("m2"),
    )


def as_statistics(df: DataFrame, key: str) -> DataFrame:
    """Mean, sample deviation and rows per key, as ``reference_stats`` gives them."""
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return df.select(key, F.col("mean").alias("mean_total"), deviation.alias("std_total"), F.col("n").alias("n_samples"))
