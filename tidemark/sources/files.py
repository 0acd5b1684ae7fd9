"""File, table and dimension inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def pinned_schema(spark: SparkSession, path: str, merge: bool = False) -> StructType:
    """Types inferred once from Parquet footers, to be pinned for later streaming reads."""
    return spark.read.option("mergeSchema", merge).parquet(path).schema


def one_path(directory: str, name: str) -> str:
    """Glob matching exactly ``name``: a stream can then read a single file as well as a directory."""
    return f"{directory.rstrip('/')}/[{name[0]}]{name[1:]}"


def ingest(
    spark: SparkSession,
    path: str,
    schema: StructType,
    glob: str | None = None,
    max_files: int | None = None,
    max_bytes: str | None = None,
    lineage: bool = True,
) -> DataFrame:
    """Stream of new Parquet files with ``ingestion_timestamp`` and ``source_file``.

    ``max_files`` or ``max_bytes`` bound a micro-batch, so a large backlog is
    worked off in restartable steps.
    """
    reader = spark.readStream.schema(schema)
    options = {"pathGlobFilter": glob, "maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    for key, value in options.items():
        if value is not None:
            reader = reader.option(key, value)
    stream = reader.parquet(path)
    return with_lineage(stream) if lineage else stream


def with_lineage(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"ingestion_timestamp": F.current_timestamp(), "source_file": F.col("_metadata.file_path")}
    )


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table as a stream."""
    return spark.readStream.table(name)


def stream_dir(spark: SparkSession, path: str, schema: StructType | None = None, **options) -> DataFrame:
    """A stage's output directory as a stream; its schema is pinned at the start."""
    return spark.readStream.schema(schema or pinned_schema(spark, path)).options(**options).parquet(path)


def read_csv_dimension(
    spark: SparkSession, path: str, schema: StructType | str | None = None, table: str | None = None
) -> DataFrame:
    """Dimension from CSV with a header; with ``table`` it is stored once and reused afterwards."""
    if table and spark.catalog.tableExists(table):
        return spark.table(table)
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    rows = reader.csv(path)
    if not table:
        return rows
    rows.write.mode("overwrite").format("parquet").saveAsTable(table)
    return spark.table(table)
