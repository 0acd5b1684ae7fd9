"""Checks that come before a broadcast, and the shared folder for written state."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Size:
    """Rows and rough bytes of a whole table, and the most rows of one non-NULL key where a key was asked for."""

    rows: int
    bytes: int
    most: int | None = None


def _width(field: T.StructField) -> Column:
    """Rough bytes of one value."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
    return F.lit(8)


def measure(df: DataFrame, key: str | None = None) -> Size:
    """Count the whole table, and with ``key`` the rows of every key, in one distributed aggregation.

    A LIMIT before the count would send up to that many rows of every partition to one task.
    """
    width = reduce(lambda a, b: a + b, [_width(f) for f in df.schema.fields], F.lit(8))
    if key is not None:
        by_key = df.groupBy(F.col(f"`{key}`").alias("_k")).agg(F.count(F.lit(1)).alias("_n"), F.sum(width).alias("_b"))
        most = F.max(F.when(F.col("_k").isNotNull(), F.col("_n")))
        row = by_key.agg(*[F.coalesce(c, F.lit(0)) for c in (F.sum("_n"), F.sum("_b"), most)]).first()
        return Size(*row)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return Size(row["n"], row["b"])


def fits_broadcast(
    proof: DataFrame | Size, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """True when the table, counted as a whole, lies within both limits."""
    size = proof if isinstance(proof, Size) else measure(proof)
    return size.rows <= max_rows and size.bytes <= max_bytes


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``. In local masters the session's warehouse stands in for it."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not set_dir and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return set_dir or spark.conf.get("spark.sql.warehouse.dir")


def run_dir(spark: SparkSession, name: str) -> str:
    """A path nothing has used before, below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once and return a frame that reads it back, so later readers do not rescan the facts.

    Meant for aggregates that several plans read. Survives lost executors.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(run_dir(spark, "checkpoint"))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back; columnar, for tables of many rows."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for what runs inside, or for the start of a query, which copies them; put back right after."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
