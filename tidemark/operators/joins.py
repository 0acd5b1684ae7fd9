"""Left joins of large, possibly streaming, facts with a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.bounds import BROADCAST_ROWS, Size, fits_broadcast, measure

#: Keys whose rows the sketch counts; it misses none with more than 3.5 / TRACKED of all rows.
TRACKED = 16_384
#: Shares below one in so many are not looked for, which keeps well clear of the sketch's error.
FINEST = 2_000


def enrich(
    df: DataFrame,
    dim: DataFrame,
    left_key: str,
    right_key: str,
    keep: dict[str, str],
    proof: DataFrame | Size | None = None,
    max_rows: int = BROADCAST_ROWS,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Add ``keep`` (dimension column to new name) by left join; rows without a match keep NULLs.

    One pass over the dimension measures rows, bytes and the most rows of one key; a repeated key would multiply facts
    and is an error. ``proof`` is a cheaper table with the same keys, or its size if measured before, that bounds ``dim``
    (the groups of an aggregate can not outnumber the dimension their key comes from).

    The dimension is broadcast only when it fits. Past the limit the join shuffles: keys that hold a partition's worth of
    the facts or more are found by a sketch and spread over as many tasks as their share asks for, the dimension's rows
    of those keys are copied as often, all others are joined as they are. ``heavy`` gives what ``heavy_keys`` found
    before; a stream, which can not be counted ahead, needs it, else only its rows without a key are spread.
    """
    side = dim.select(F.col(right_key).alias("_key"), *[F.col(c).alias(name) for c, name in keep.items()])
    size = proof if isinstance(proof, Size) else measure(dim if proof is None else proof, right_key)
    if size.most is None:
        size = Size(size.rows, size.bytes, measure(side, "_key").most)
    if size.most > 1:
        raise ValueError(f"{size.most} rows of the lookup have the same {right_key}")
    if fits_broadcast(size, max_rows):
        return df.join(F.broadcast(side), df[left_key] == side["_key"], "left").drop("_key")
    if heavy is None:
        slots = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        heavy = _keyless(df, left_key, slots) if df.isStreaming else heavy_keys(df, left_key, slots)
    return _by_share(df, side, left_key, heavy)


def heavy_keys(df: DataFrame, key: str, slots: int) -> DataFrame:
    """(_hot, _tasks): keys, NULL among them, that hold at least one in ``slots`` of the rows, and the tasks they need.

    One aggregation with bounded sketches; only keys above the share come to the driver, ``FINEST`` at most.
    """
    least = min(slots, FINEST)
    sketch = F.expr(f"approx_top_k(`{key}`, {least}, {TRACKED})")
    row = df.agg(F.count(F.lit(1)).alias("n"), sketch.alias("top")).first()
    found = [(r["item"], -(-r["count"] * slots // row["n"])) for r in row["top"] or [] if r["count"] * least >= row["n"]]
    return _salts(df, key, [(item, tasks) for item, tasks in found if tasks > 1])


def _keyless(df: DataFrame, key: str, slots: int) -> DataFrame:
    return _salts(df, key, [(None, slots)])


def _salts(df: DataFrame, key: str, rows: list[tuple]) -> DataFrame:
    kind = T.StructType([T.StructField("_hot", df.schema[key].dataType), T.StructField("_tasks", T.LongType())])
    return df.sparkSession.createDataFrame(rows, kind)


def _by_share(df: DataFrame, side: DataFrame, left_key: str, heavy: DataFrame) -> DataFrame:
    """Join on (key, salt); only keys of ``heavy``, at most FINEST short rows, have more than one salt."""
    # Copies of one row compress away in what adaptive skew handling measures, so the salt is explicit. The task's
    # partition id keeps such copies apart; both parts repeat on a retry.
    hashable = [
        f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    few = F.broadcast(heavy)
    spread = F.pmod(F.xxhash64(*hashable) + F.spark_partition_id(), F.col("_tasks"))
    left = df.join(few, df[left_key].eqNullSafe(few["_hot"]), "left").withColumn("_salt", F.coalesce(spread, F.lit(0)))
    copies = side.join(few, side["_key"] == few["_hot"], "left").withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_tasks", F.lit(1)) - 1))
    )
    left, copies = left.drop("_hot", "_tasks"), copies.drop("_hot", "_tasks")
    on = (left[left_key] == copies["_key"]) & (left["_salt"] == copies["_copy"])
    return left.join(copies, on, "left").drop("_key", "_salt", "_copy")
