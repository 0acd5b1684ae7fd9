"""Windowed and grouped indicators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import mean_ci_bounds, ratio, seconds
from tidemark.vocabulary import KPI_WINDOW, SATURATION_S, WATERMARK, Z_95


def with_event_time(
    df: DataFrame, columns: list[str], watermark_on: str | None = None, delay: str = WATERMARK
) -> DataFrame:
    """Cast columns to TIMESTAMP, as watermarks need it, and set the watermark on streams."""
    typed = df.withColumns({c: F.col(c).cast("timestamp") for c in columns})
    if watermark_on and df.isStreaming:
        typed = typed.withWatermark(watermark_on, delay)
    return typed


def without_zone(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast back to TIMESTAMP_NTZ, so that stored values do not depend on the session time zone."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def window_kpi(
    df: DataFrame,
    ts: str,
    keys: list[str],
    aggs: dict[str, Column],
    size: str = KPI_WINDOW,
    slide: str | None = None,
) -> DataFrame:
    """Aggregate per event-time window and key; batch or streaming. NULL keys form their own group."""
    span = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (
        df.groupBy(span.alias("window"), *keys)
        .agg(*[expr.alias(name) for name, expr in aggs.items()])
        .select("window.start", "window.end", *keys, *aggs)
        .withColumnsRenamed({"start": "window_start", "end": "window_end"})
    )


def sliding_counts(
    df: DataFrame, ts: str, keys: list[str], counts: dict[str, Column], size: str, slide: str
) -> DataFrame:
    """Sliding-window counts of conditions, batch only.

    Rows are first counted per pane of length ``slide``; each pane, not each row,
    is then copied into the size/slide windows that cover it.
    """
    width, step = seconds(size), seconds(slide)
    if width % step:
        raise ValueError("size must be a multiple of slide")
    panes = window_kpi(df, ts, keys, {name: F.count_if(cond) for name, cond in counts.items()}, slide)
    # Panes count from the epoch, and so do the windows.
    back = F.explode(F.sequence(F.lit(0), F.lit(width // step - 1))).alias("_back")
    start = F.col("window_start") - F.make_dt_interval(secs=F.col("_back") * F.lit(step))
    return (
        panes.select("*", back)
        .withColumn("window_start", start)
        .groupBy("window_start", *keys)
        .agg(*[F.sum(name).alias(name) for name in counts])
        .withColumn("window_end", F.col("window_start") + F.make_dt_interval(secs=F.lit(width)))
        .select("window_start", "window_end", *keys, *counts)
    )


def closed_only(kpi: DataFrame, latest: Column, delay: str = WATERMARK) -> DataFrame:
    """Windows a stream in append mode has emitted once the newest event time is ``latest``."""
    return kpi.where(F.col("window_end") <= latest - F.expr(f"INTERVAL {delay}"))


def window_summary(kpi: DataFrame, key: str) -> DataFrame:
    """Distinct windows and rows per key, most windows first."""
    return (
        kpi.groupBy(key)
        .agg(F.countDistinct("window_start").alias("nb_windows"), F.count(F.lit(1)).alias("total_rows"))
        .orderBy(F.desc("nb_windows"), key)
    )


def mean_ci(df: DataFrame, key: str, value: str, source: str | None = None, z: float = Z_95) -> DataFrame:
    """Mean of ``value`` per key with its normal confidence interval, over 0 < value < 500."""
    low, high = mean_ci_bounds(F.col("avg_total"), F.col("std_total"), F.col("n"), z)
    out = (
        df.where((F.col(value) > 0) & (F.col(value) < 500) & F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(value).alias("avg_total"),
            F.stddev(value).alias("std_total"),
        )
        .select(key, "n", "avg_total", "std_total", low.alias("ic95_low"), high.alias("ic95_high"))
    )
    return out if source is None else out.select(F.lit(source).alias("source"), "*")


def compare_sources(*kpis: DataFrame, key: str) -> DataFrame:
    """Indicators of several sources side by side."""
    return reduce(DataFrame.unionByName, kpis).orderBy(key, "source")


def component_rates(
    df: DataFrame, key: str, total: str, parts: dict[str, list[str]], eps: float = 0.01
) -> DataFrame:
    """Share of each group of components in the total, and rows whose components add up to it."""
    every = [c for cols in parts.values() for c in cols]
    gap = F.abs(F.col(total) - reduce(lambda a, b: a + b, [F.col(c) for c in every]))
    sums = [
        F.sum(reduce(lambda a, b: a + b, [F.col(c) for c in cols])).alias(f"_{name}") for name, cols in parts.items()
    ]
    return (
        df.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(gap < eps).alias("n_balanced"),
            F.sum(total).alias("_total"),
            *sums,
        )
        .select(key, "n", "n_balanced", *[ratio(F.col(f"_{p}"), F.col("_total")).alias(f"{p}_rate") for p in parts])
    )


def layer_ratio(upstream: DataFrame, downstream: DataFrame, batch: str, marks: list[int]) -> DataFrame:
    """Rows of two layers up to each marked batch and their ratio, one pass over each layer."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        wide = df.where(F.col(batch) <= max(marks)).agg(
            *[F.count_if(F.col(batch) <= m).alias(str(m)) for m in marks]
        )
        pairs = F.array(*[F.struct(F.lit(m).alias("mark"), F.col(str(m)).alias(name)) for m in marks])
        return wide.select(F.inline(pairs))

    up, down = counts(upstream, "upstream_rows"), counts(downstream, "downstream_rows")
    return up.join(down, "mark").withColumn(
        "layer_ratio", ratio(F.col("downstream_rows"), F.col("upstream_rows"))
    )


def latency_summary(
    log: DataFrame, rate: str, duration: str, rows: str, threshold: float = SATURATION_S
) -> DataFrame:
    """Durations, saturated runs and final row count per rate of a run log."""
    return log.groupBy(rate).agg(
        F.avg(duration).alias("duration_avg"),
        F.max(duration).alias("duration_max"),
        F.min(duration).alias("duration_min"),
        F.count_if(F.col(duration) > threshold).alias("n_saturated"),
        F.max(rows).alias("rows_final"),
    )
