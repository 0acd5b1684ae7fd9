"""Running, neighbouring and rolling values over a global order, without one task holding the whole order.

A window with no PARTITION BY moves every row to one task. Here quantiles of the
order column cut the rows into blocks of about ``block`` rows each, however
sparse or clustered the values are. A window inside a block is bounded; what
other blocks contribute comes from a table of one row per block.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 100_000
#: Blocks at most. A table of this many rows is ordered by one task; larger inputs get larger blocks.
MAX_BLOCKS = 2_048

_COMBINE = {
    "sum": lambda before, here: F.coalesce(before, F.lit(0)) + F.coalesce(here, F.lit(0)),
    "max": lambda before, here: F.greatest(before, here),
    "min": lambda before, here: F.least(before, here),
}
_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def with_blocks(df: DataFrame, order: str, block: int = BLOCK, name: str = "_block") -> DataFrame:
    """Add the number of the block that a row's order value falls in; equal values share one, NULL comes first."""
    number = df.select(F.col(order).cast("double").alias("_at"))
    rows = number.agg(F.count("_at")).first()[0]
    n = min(MAX_BLOCKS, math.ceil(rows / block))
    if n <= 1:
        return df.withColumn(name, F.when(F.col(order).isNull(), F.lit(-1)).otherwise(F.lit(0)))
    cuts = number.approxQuantile("_at", [i / n for i in range(1, n)], 1 / (4 * n))
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    ranked = Bucketizer(splits=splits, inputCol="_at", outputCol="_rank", handleInvalid="keep").transform(
        df.withColumn("_at", F.col(order).cast("double"))
    )
    at = F.when(F.col(order).isNull(), F.lit(-1)).otherwise(F.col("_rank").cast("int"))
    return ranked.withColumn(name, at).drop("_at", "_rank")


def _block_of(at: Column, width: int) -> Column:
    """Whole-number block of a dense integer column; no detour over doubles."""
    return (at - F.pmod(at, F.lit(width))).cast("bigint")


def followers(df: DataFrame, order: str, name: str, block: int = BLOCK) -> DataFrame:
    """Add the next larger value of the unique integer column ``order``, NULL after the last.

    ``df`` is read several times: pass a written or ``cut`` frame.
    """
    blocked = with_blocks(df, order, block)
    later = Window.orderBy("_block").rowsBetween(1, Window.unboundedFollowing)
    edges = (
        blocked.groupBy("_block")
        .agg(F.min(order).alias("_low"))
        .select(F.col("_block").alias("_of"), F.min("_low").over(later).alias("_after"))
    )
    inside = F.lead(order).over(Window.partitionBy("_block").orderBy(order))
    return (
        blocked.withColumn("_inside", inside)
        .join(edges, F.col("_block") == F.col("_of"))
        .select(*df.columns, F.coalesce("_inside", "_after").alias(name))
    )


def running(
    df: DataFrame,
    order: str,
    values: dict[str, tuple[str, Column]],
    inclusive: bool = True,
    block: int = BLOCK,
) -> DataFrame:
    """Add running ``sum``, ``max`` or ``min`` columns; ``order`` is a unique integer column.

    ``values`` maps the new column to (kind, expression). With ``inclusive=False``
    only earlier rows count. A row with NULL ``order`` comes first. ``df`` is read
    twice: pass a written or ``cut`` frame.
    """
    blocked = with_blocks(df, order, block)
    upto = Window.partitionBy("_block").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1
    )
    local = blocked.select(
        "*", *[_AGG[kind](expr).over(upto).alias(f"_in_{name}") for name, (kind, expr) in values.items()]
    )
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        blocked.groupBy("_block")
        .agg(*[_AGG[kind](expr).alias(f"_t_{name}") for name, (kind, expr) in values.items()])
        .select(
            F.col("_block").alias("_of"),
            *[_AGG[kind](F.col(f"_t_{name}")).over(earlier).alias(f"_b_{name}") for name, (kind, _) in values.items()],
        )
    )
    return local.join(before, F.col("_block").eqNullSafe(F.col("_of"))).select(
        *df.columns,
        *[_COMBINE[kind](F.col(f"_b_{name}"), F.col(f"_in_{name}")).alias(name) for name, (kind, _) in values.items()],
    )


def row_numbers(df: DataFrame, order: str, name: str = "rn", block: int = BLOCK) -> DataFrame:
    """Global 1-based position by a unique integer column."""
    return running(df, order, {name: ("sum", F.lit(1).cast("bigint"))}, block=block)


def rolling_mean(
    df: DataFrame, order: str, value: str, rows: int, name: str, block: int = BLOCK
) -> DataFrame:
    """Mean over the last ``rows`` rows, the current one included; early rows average what exists.

    Positions are grouped in blocks; the last ``rows - 1`` rows of a block are
    copied into the next one, so each block can be windowed by itself.
    """
    numbered = row_numbers(df, order, "_rn", block)
    width = max(block, rows)
    home = _block_of(F.col("_rn"), width)
    spill = _block_of(F.col("_rn") + F.lit(rows - 1), width)
    last = Window.partitionBy("_at").orderBy("_rn").rowsBetween(-(rows - 1), Window.currentRow)
    return (
        numbered.withColumn("_at", F.explode(F.array_distinct(F.array(home, spill))))
        .withColumn(name, F.avg(value).over(last))
        .where(F.col("_at") == home)
        .select(*df.columns, name)
    )
