"""Category shares per batch and drift against a baseline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.functions.columns import psi_term, share_pct, verdict
from tidemark.plans.ordered import row_numbers, running


def share_by_batch(df: DataFrame, batch: str, category: str, pool: tuple[str, ...] = v.LABELS) -> DataFrame:
    """Count and percentage of each pool label per batch; rows of no label count in ``n`` only.

    One aggregation with partial sums, so a batch holding most rows costs no more than any other.
    """
    return (
        df.groupBy(batch)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(F.col(category) == lbl).alias(lbl) for lbl in pool],
        )
        .select(batch, "n", *pool, *[share_pct(F.col(lbl), F.col("n")).alias(f"pct_{lbl}") for lbl in pool])
    )


def _first(shares: DataFrame, batch: str, batches: int) -> DataFrame:
    """Rows of the first batches that exist, whatever their ids; ``shares`` has one row per batch."""
    last = shares.orderBy(F.asc_nulls_last(batch)).limit(batches).agg(F.max(batch)).scalar()
    return shares.where(F.col(batch) <= last)


def _shares(pool: tuple[str, ...]) -> list[Column]:
    return [(F.avg(f"pct_{lbl}") / 100).alias(lbl) for lbl in pool]


def drift_baseline(
    shares: DataFrame, batch: str, batches: int = v.BASELINE_BATCHES, pool: tuple[str, ...] = v.LABELS
) -> DataFrame:
    """Unweighted mean share per label over the first batches, one row per label."""
    wide = _first(shares, batch, batches).agg(*_shares(pool))
    pairs = F.array(*[F.struct(F.lit(lbl).alias("label"), F.col(lbl).alias("share")) for lbl in pool])
    return wide.select(F.inline(pairs))


def psi(
    shares: DataFrame,
    batch: str,
    batches: int = v.BASELINE_BATCHES,
    pool: tuple[str, ...] = v.LABELS,
    eps: float = v.PSI_EPS,
) -> DataFrame:
    """Population stability index and verdict per batch.

    The baseline is a scalar subquery over ``shares``, which is therefore read
    more than once: pass a written or ``cut`` frame.
    """
    base = _first(shares, batch, batches).agg(*_shares(pool)).select(F.struct(*pool).alias("base")).scalar()
    return _scored(shares, batch, {lbl: base.getField(lbl) for lbl in pool}, eps)


def psi_against(
    shares: DataFrame, batch: str, baseline: dict[str, float], eps: float = v.PSI_EPS
) -> DataFrame:
    """Index and verdict per batch against a stored baseline of label to share."""
    return _scored(shares, batch, {lbl: F.lit(float(share)) for lbl, share in baseline.items()}, eps)


def _scored(shares: DataFrame, batch: str, base: dict[str, Column], eps: float) -> DataFrame:
    terms = [psi_term(F.col(f"pct_{lbl}") / 100, share, eps) for lbl, share in base.items()]
    scored = shares.select(batch, reduce(lambda a, b: a + b, terms).alias("psi"))
    return scored.withColumn("verdict", verdict(F.col("psi")))


def latest_batch(df: DataFrame, batch: str) -> DataFrame:
    """Rows of the newest batch; the maximum is a scalar subquery, so stored tables can skip other batches."""
    return df.where(F.col(batch) == df.agg(F.max(batch)).scalar())


def drift_onset(scored: DataFrame, batch: str, limit: float = v.PSI_DRIFT) -> DataFrame:
    """First batch at or over the drift limit; NULL if there is none."""
    return scored.agg(F.min(F.when(F.col("psi") >= limit, F.col(batch))).alias("onset_batch"))


def streaks(df: DataFrame, order: str, predicate: Column, name: str = "consecutive") -> DataFrame:
    """Length of the current run of rows where the predicate holds, 0 where it does not.

    ``order`` is a unique integer column; pass a written or ``cut`` frame.
    """
    hit = F.coalesce(predicate, F.lit(False))
    numbered = row_numbers(df.withColumn("_hit", hit), order, "_rn")
    missed = {"_miss": ("max", F.when(~F.col("_hit"), F.col("_rn")))}
    return (
        running(numbered, order, missed)
        .withColumn(name, F.col("_rn") - F.coalesce("_miss", F.lit(0)))
        .drop("_hit", "_rn", "_miss")
    )


def retrain_signal(
    scored: DataFrame, batch: str, limit: float = v.PSI_DRIFT, after: int = v.RETRAIN_AFTER
) -> DataFrame:
    """Breach history with the consecutive-breach counter and the retrain signal, after which the count starts anew."""
    breach = F.col("psi") >= limit
    run = F.col("consecutive")
    return (
        streaks(scored.withColumn("breach", breach), batch, F.col("breach"))
        .withColumn("consecutive", F.when(run > 0, (run - 1) % after + 1).otherwise(run))
        .withColumn("retrain", F.col("consecutive") == after)
        .select(batch, "psi", "verdict", "breach", "consecutive", "retrain")
    )
