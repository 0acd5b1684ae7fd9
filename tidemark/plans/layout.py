"""Z-ordered rewrite, compaction in place, layers written once, Bloom filters, and file statistics."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import zorder_key
from tidemark.plans.bounds import fits_broadcast, settings, shared_dir, stored

#: Bytes of a full file.
FULL_FILE = 128 * 1024 * 1024


def _as_number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    raise TypeError(f"cannot rank {name} of type {kind.simpleString()}")


def add_zorder_key(df: DataFrame, columns: list[str], bits: int = 8, name: str = "_zkey") -> DataFrame:
    """Rank each column into quantile buckets and interleave the ranks.

    One pass with bounded sketches finds the cut points of all columns. Ranks are
    stretched over all ``bits``, so a column of few values counts as much as one of
    many. NULL and NaN take the last rank.
    """
    numbered = df.withColumns({f"_n{i}": _as_number(df, c) for i, c in enumerate(columns)})
    buckets = 2**bits - 1
    probes = [b / buckets for b in range(1, buckets)]
    names = [f"_n{i}" for i in range(len(columns))]
    cuts = numbered.approxQuantile(names, probes, 1 / (4 * buckets))
    splits = [[-math.inf, *(sorted(set(c)) or [0.0]), math.inf] for c in cuts]
    ranked = Bucketizer(
        splitsArray=splits,
        inputCols=names,
        outputCols=[f"_r{i}" for i in range(len(columns))],
        handleInvalid="keep",
    ).transform(numbered)
    ranked = ranked.withColumns(
        {f"_r{i}": F.floor(F.col(f"_r{i}") * buckets / (len(s) - 1)) for i, s in enumerate(splits)}
    )
    key = zorder_key([f"_r{i}" for i in range(len(columns))], bits)
    return ranked.withColumn(name, key).select(*df.columns, name)


def zorder_rewrite(
    df: DataFrame, columns: list[str], path: str, files: int | None = None, bits: int = 8, mode: str = "errorifexists"
) -> None:
    """Write ``df`` to ``path`` in few files clustered on all ``columns`` together.

    Without ``files`` adaptive execution sizes them. A key bucket can hold many rows,
    so the range goes on to the values themselves and to the task that read the row:
    a hot bucket, even of equal values, fills several files instead of one.
    """
    keyed = add_zorder_key(df, columns, bits).withColumn("_tie", F.spark_partition_id())
    order = ["_zkey", *columns, "_tie"]
    ranged = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    (
        ranged.sortWithinPartitions(*order)
        .drop("_zkey", "_tie")
        .write.mode(mode)
        .parquet(path)
    )


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """Files, rows and bytes of a stored table; sizes come from the listing, not from the data."""
    rows = spark.read.parquet(path).agg(F.count(F.lit(1))).scalar()
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return (
        listing.option("pathGlobFilter", "*.parquet")
        .load(path)
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("total_bytes"))
        .select("n_files", rows.alias("n_rows"), "total_bytes")
    )


# -- compaction in place ----------------------------------------------------------------------


#: Folder names stay text, so that a value such as 05 goes back to the folder it came from.
_AS_TEXT = {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}


def _finished(spark: SparkSession, path: str) -> bool:
    """True when a write to ``path`` came to its end."""
    try:
        spark.read.format("binaryFile").load(f"{path}/_SUCCESS")
        return True
    except AnalysisException:
        return False


def data_files(spark: SparkSession, path: str, partitions: list[str]) -> DataFrame:
    """File and length of every data file below a partitioned layer; the files are not opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(F.col("_metadata.file_path").alias("_file"), F.col("length").alias("_bytes"), *partitions)


def packed_files(listing: DataFrame, partitions: list[str], full: int) -> DataFrame:
    """Bins (``_bin``, from 0 over all partitions) for the files of those partitions that fewer files can hold.

    Files are laid end to end within their partition, by length, and cut every ``full`` bytes: a bin begins where a
    file begins and holds less than ``full`` bytes beyond its last file. A partition that would not get fewer files
    is left out.
    """
    inside = Window.partitionBy(*partitions).orderBy("_bytes", "_file").rowsBetween(Window.unboundedPreceding, -1)
    cut_at = F.floor(F.coalesce(F.sum("_bytes").over(inside), F.lit(0)) / F.lit(full))
    binned = listing.withColumn("_in", cut_at)
    bins = binned.groupBy(*partitions, "_in").agg(F.count(F.lit(1)).alias("_n"))
    fewer = bins.groupBy(*partitions).agg(F.count(F.lit(1)).alias("_bins"), F.sum("_n").alias("_files")).where("_bins < _files")
    # Partitions are folders, which the driver lists anyway: their bin counts are summed up in one window.
    before = Window.orderBy(*partitions).rowsBetween(Window.unboundedPreceding, -1)
    starts = fewer.withColumn("_start", F.coalesce(F.sum("_bins").over(before), F.lit(0)))
    dense = F.dense_rank().over(Window.partitionBy(*partitions).orderBy("_in")) - 1
    same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"_p_{p}")) for p in partitions])
    renamed = starts.select("_start", *[F.col(p).alias(f"_p_{p}") for p in partitions])
    return (
        binned.withColumn("_dense", dense).join(renamed, same)
        .select("_file", "_bytes", *partitions, (F.col("_start") + F.col("_dense")).cast("int").alias("_bin"))
    )


def compact(spark: SparkSession, path: str, partitions: list[str], full: int = FULL_FILE) -> int:
    """Pack the small files of a partitioned Parquet layer, in place; returns how many partitions were replaced.

    Only partitions that get fewer files are read, and dynamic partition overwrite replaces only these; files of the
    others keep their names. One task writes one bin. The new files are first written to ``<path>__pending``, and the
    layer is replaced from there: a run that dies in between is finished by the next call. There must be no other
    writer meanwhile, and streams that read the layer by its files must have read it.
    """
    pending = f"{path.rstrip('/')}__pending"
    with settings(spark, _AS_TEXT):
        _replace(spark, path, pending, partitions)
        files = stored(packed_files(data_files(spark, path, partitions), partitions, full), "packed_files")
        touched = [tuple(row) for row in files.select(*partitions).distinct().collect()]
        if not touched:
            return 0
        bins = files.agg(F.max("_bin")).first()[0] + 1
        here = [reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.lit(x)) for p, x in zip(partitions, t, strict=True)]) for t in touched]
        layer = spark.read.parquet(path)
        rows = layer.where(reduce(lambda a, b: a | b, here)).withColumn("_file", F.col("_metadata.file_path"))
        bin_of = files.select("_file", "_bin")
        rows = rows.join(F.broadcast(bin_of) if fits_broadcast(files) else bin_of, "_file")
        packed = rows.repartitionById(bins, F.col("_bin")).select(*layer.columns)
        packed.write.mode("overwrite").partitionBy(*partitions).parquet(pending)
        _replace(spark, path, pending, partitions)
    return len(touched)


def _replace(spark: SparkSession, path: str, pending: str, partitions: list[str]) -> None:
    """Put the pending files of a finished write in the place of their partitions; then empty the pending folder."""
    new = spark.read.parquet(pending) if _finished(spark, pending) else None
    if new is None or not set(partitions) <= set(new.columns):
        return
    whole = {"spark.sql.files.maxPartitionBytes": str(1 << 40), "spark.sql.files.openCostInBytes": str(1 << 40)}
    with settings(spark, {**whole, "spark.sql.files.minPartitionNum": "1"}):
        # One task reads one file, so the files stay as they were packed.
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    spark.createDataFrame([], new.drop(*partitions).schema).write.mode("overwrite").parquet(pending)


# -- layers written once, point lookups -------------------------------------------------------


def layer_of(spark: SparkSession, name: str, source: str, write: Callable[[str], None]) -> str:
    """Path of a layer derived from the files of ``source``; ``write(path)`` is called unless it is there.

    The path holds a digest of the names, lengths and times of the files, so a changed source gets a new layer.
    A layer counts as there when its last write ended (``_SUCCESS``).
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    one = F.xxhash64("path", "length", "modificationTime")
    row = listing.agg(F.bit_xor(one).alias("x"), F.sum(one.cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).first()
    digest = f"{(row['x'] or 0) & (2**64 - 1):016x}{int(row['s'] or 0) & (2**64 - 1):016x}-{row['n']}"
    path = f"{shared_dir(spark).rstrip('/')}/tidemark/layers/{name}-{digest}"
    if not _finished(spark, path):
        write(path)
    return path


def bloom_options(keys: dict[str, int]) -> dict[str, str]:
    """Writer options for a Bloom filter on each key column, sized for that many distinct values a row group."""
    options = {}
    for name, distinct in keys.items():
        options[f"parquet.bloom.filter.enabled#{name}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{name}"] = str(distinct)
    return options


def write_lookup_layer(df: DataFrame, keys: dict[str, int], path: str, files: int) -> None:
    """Store ``df`` for lookups by keys that its order does not follow: files with Bloom filters on the ``keys``.

    A scan for one value skips the row groups whose filter excludes it, also where the value lies between their least
    and greatest. Rows are spread by the hash of the first key, so all rows of a value lie in one file.
    """
    df.repartition(files, next(iter(keys))).write.mode("overwrite").options(**bloom_options(keys)).parquet(path)
