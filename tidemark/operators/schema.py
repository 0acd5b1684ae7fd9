"""Schema comparison of two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _described(df: DataFrame, side: str) -> DataFrame:
    # One aggregate row holds the filled count of every column; it is turned into one row per column.
    wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(field.name).alias("name"),
            F.lit(field.dataType.simpleString()).alias(f"{side}_type"),
            F.col(f"`{field.name}`").alias(f"{side}_filled"),
        )
        for field in df.schema.fields
    ]
    return wide.select(F.inline(F.array(*rows)))


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer comparison of column names and types, with the non-NULL count on each side."""
    status = (
        F.when(F.col("right_type").isNull(), "only_left")
        .when(F.col("left_type").isNull(), "only_right")
        .when(F.col("left_type") == F.col("right_type"), "same")
        .otherwise("type_mismatch")
    )
    return (
        _described(left, "left")
        .join(_described(right, "right"), "name", "full_outer")
        .select("name", "left_type", "right_type", status.alias("status"), "left_filled", "right_filled")
    )
