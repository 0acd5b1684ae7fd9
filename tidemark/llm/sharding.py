"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass one scatters the rows uniformly into buckets that fit in memory, by a seeded hash of the row's id and of the
place it is stored at (so that a repeated id spreads too). Pass two gathers a bucket into one array, applies the
Fisher-Yates shuffle to it (Spark's ``shuffle``) and writes it. The buckets follow each other; the shuffled order
is cut into shards whose row counts differ by at most one.

Nulls and edge cases: a null text has no bytes; a null id is hashed by the place alone; equal rows stay separate
rows; an empty table gives an empty result; with fewer rows than shards some shards stay empty; all columns of
the input are kept, also one called ``slot`` or ``shard`` (the operator's own columns have a prefix of their own
until the result names them).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.rows import ADDRESS, addressed
from tidemark.plans.bounds import run_dir, stored

SHARDS = 40
ROW_OVERHEAD = 16
#: Bytes of text that one bucket holds about; a task has one bucket's rows in memory.
BUCKET_BYTES = 4 << 20


def row_size(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + F.lit(ROW_OVERHEAD)


def scatter(docs: DataFrame, buckets: int, seed: int, id_col: str) -> DataFrame:
    """Number the rows by a seeded hash of their id and address, and deal them to buckets."""
    row = F.xxhash64(F.lit(seed), F.col(id_col), *ADDRESS)
    return docs.withColumn("_row", row).withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)).cast("int"))


def shuffle_into_shards(
    docs: DataFrame,
    path: str,
    shards: int = SHARDS,
    seed: int = 23,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> None:
    """Write ``docs`` to ``path`` as folders ``shard=N``, each row with its ``slot``.

    A count by bucket comes before the rows are moved, so the scatter depends on ids and on where rows are stored, not on the
    tasks that read them. Text is moved once.
    """
    names = docs.columns
    docs = addressed(docs)
    size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_size(text_col)), F.lit(0))).first()
    rows, buckets = size[0], max(1, math.ceil(size[1] / bucket_bytes))
    per_bucket = scatter(docs.select(id_col, *ADDRESS), buckets, seed, id_col).groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    per_bucket = stored(per_bucket, "shard_buckets")
    # One short row per bucket, not per document.
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = per_bucket.select(F.col("_bucket").alias("_of"), before.alias("_start"))

    record = F.struct("_row", F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"))
    gathered = (
        scatter(docs, buckets, seed, id_col)
        .groupBy("_bucket")
        .agg(F.sort_array(F.collect_list(record)).alias("_rows"))
        .join(starts, F.col("_bucket") == F.col("_of"))
        .sortWithinPartitions("_bucket")
    )
    dealt = gathered.select("_start", F.posexplode(F.shuffle("_rows", seed)).alias("_at", "_record"))
    place = F.col("_start") + F.col("_at")
    least, larger = rows // shards, rows % shards
    edge = larger * (least + 1)
    late = larger + F.floor((place - edge) / max(least, 1))
    shard = F.when(place < edge, F.floor(place / (least + 1))).otherwise(late).cast("int")
    first = F.col("_shard") * least + F.least(F.col("_shard"), F.lit(larger))
    out = dealt.select(place.alias("_place"), shard.alias("_shard"), F.col("_record._doc").alias("doc"))
    out.select("doc", (F.col("_place") - first).alias("slot"), F.col("_shard").alias("shard")).write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame:
    """The written rows: ``doc`` with the columns of the input, ``slot`` and ``shard``."""
    kind = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).schema
    return spark.read.schema(kind.add("slot", "long").add("shard", "integer")).parquet(path)


def two_pass_shuffle(docs: DataFrame, **options) -> DataFrame:
    """Shuffle into shards below the shared folder and read them back."""
    spark = docs.sparkSession
    path = run_dir(spark, "shards")
    shuffle_into_shards(docs, path, **options)
    return read_shards(spark, path, docs)
