"""Reference statistics, ordered flags, routing, repair and quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.functions.columns import guarded_z, ratio, share_pct
from tidemark.operators.joins import enrich
from tidemark.plans.bounds import Size

Rule = tuple[Column, str]


def clean_rows() -> Column:
    """Rows fit to serve as the statistical reference; all bounds are strict."""
    total, distance = F.col("total_amount"), F.col("trip_distance")
    return (total > 0) & (total < 500) & (distance > 0) & (distance < 100)


def reference_stats(df: DataFrame, key: str, value: str, clean: Column) -> DataFrame:
    """Mean, sample deviation and row count of ``value`` per non-NULL key."""
    return (
        df.where(clean & F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.avg(value).alias("mean_total"),
            F.stddev(value).alias("std_total"),
            F.count(F.lit(1)).alias("n_samples"),
        )
    )


def z_score(
    df: DataFrame, stats: DataFrame, key: str, value: str, proof: DataFrame | Size | None = None
) -> DataFrame:
    """Join the statistics of the row's key and add ``z_score``."""
    joined = enrich(df, stats, key, key, {"mean_total": "mean_total", "std_total": "std_total"}, proof)
    return joined.withColumn("z_score", guarded_z(F.col(value), F.col("mean_total"), F.col("std_total")))


def taxi_rules(z_limit: float = 3.0, distance_limit: float = 100.0, null_amounts: bool = False) -> list[Rule]:
    """Flag rules in order. NULL amounts pass unless ``null_amounts`` asks for a rule on them."""
    total, fare, distance = F.col("total_amount"), F.col("fare_amount"), F.col("trip_distance")
    rules = [
        ((total < 0) | (fare < 0), v.MONTANT_NEGATIF),
        (distance.isNull() | (distance <= 0), v.DISTANCE_NULLE),
        (distance > distance_limit, v.DISTANCE_ABERRANTE),
        (F.col("PULocationID").isNull(), v.LOCATION_NULLE),
        (F.col("tpep_dropoff_datetime") < F.col("tpep_pickup_datetime"), v.INVERSION_TEMPS),
        (F.abs("z_score") > z_limit, v.ANOMALIE_STATISTIQUE),
    ]
    return [(total.isNull() | fare.isNull(), "MONTANT_NULL"), *rules] if null_amounts else rules


def extra_rules() -> list[Rule]:
    """Rules for the full schema, to be tried after the others."""
    # Regulated amounts in dollars.
    extra_max, mta_tax, improvement = 5.0, 0.5, 0.3
    return [
        (F.col("store_and_fwd_flag") == "Y", "TRANSMISSION_DIFFEREE"),
        ((F.col("extra") > extra_max) | (F.col("extra") < 0), "EXTRA_ANORMAL"),
        (F.col("mta_tax") != mta_tax, "MTA_TAX_ANORMALE"),
        (F.col("improvement_surcharge") != improvement, "IMPROVEMENT_ANORMALE"),
    ]


def flag(df: DataFrame, rules: list[Rule], default: str = v.VALIDE, name: str = "quality_flag") -> DataFrame:
    """Label each row with the first rule that holds; a NULL predicate does not hold."""
    verdict = reduce(lambda rest, rule: F.when(rule[0], rule[1]).otherwise(rest), reversed(rules), F.lit(default))
    return df.withColumn(name, verdict)


def route(df: DataFrame, flag_col: str = "quality_flag", valid: str = v.VALIDE) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected rows."""
    return df.where(F.col(flag_col) == valid), df.where(F.col(flag_col) != valid)


def with_route(df: DataFrame, flag_col: str = "quality_flag", valid: str = v.VALIDE) -> DataFrame:
    """Add ``route`` (gold or quarantine), so one pass can write both as partitions."""
    return df.withColumn("route", F.when(F.col(flag_col) == valid, "gold").otherwise("quarantine"))


def _tally(flag_col: str, valid: str) -> dict[str, Column]:
    ok = F.col(flag_col) == valid
    return {"gold": F.count_if(ok), "quarantine": F.count_if(~ok), "total": F.count(F.lit(1))}


def quality_summary(
    flagged: DataFrame, by: tuple[str, ...] = (), flag_col: str = "quality_flag", valid: str = v.VALIDE
) -> DataFrame:
    """Valid, rejected and total rows with the reject rate in percent, in one pass."""
    tally = [expr.alias(name) for name, expr in _tally(flag_col, valid).items()]
    return flagged.groupBy(*by).agg(*tally).withColumn("rate_pct", share_pct(F.col("quarantine"), F.col("total")))


def anomaly_distribution(flagged: DataFrame, flag_col: str = "quality_flag", valid: str = v.VALIDE) -> DataFrame:
    """Rejected rows per flag, most frequent first."""
    return (
        flagged.where(F.col(flag_col) != valid)
        .groupBy(flag_col)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), flag_col)
    )


def flag_coverage(flagged: DataFrame, flags: tuple[str, ...] = v.FLAGS, flag_col: str = "quality_flag") -> DataFrame:
    """Rows per expected flag, with zero for flags that never occur."""
    wide = flagged.agg(*[F.count_if(F.col(flag_col) == f).alias(f) for f in flags])
    pairs = F.array(*[F.struct(F.lit(f).alias(flag_col), F.col(f).alias("n")) for f in flags])
    return wide.select(F.inline(pairs)).withColumn("present", F.col("n") > 0)


def dashboard_delta(flagged: DataFrame, batch: str, first: int, second: int, flag_col: str = "quality_flag",
                    valid: str = v.VALIDE) -> DataFrame:
    """Quality summary at two moments (rows up to a batch) and the change between them, in one pass."""
    ok = F.col(flag_col) == valid

    def counts(tag: str, upto: int) -> list[Column]:
        seen = F.col(batch) <= upto
        return [
            F.count_if(seen & ok).alias(f"gold_{tag}"),
            F.count_if(seen & ~ok).alias(f"quarantine_{tag}"),
        ]

    def rate(tag: str) -> Column:
        bad = F.col(f"quarantine_{tag}")
        return share_pct(bad, F.col(f"gold_{tag}") + bad).alias(f"rate_{tag}")

    return flagged.where(F.col(batch) <= max(first, second)).agg(*counts("1", first), *counts("2", second)).select(
        "*",
        (F.col("gold_2") - F.col("gold_1")).alias("gold_delta"),
        (F.col("quarantine_2") - F.col("quarantine_1")).alias("quarantine_delta"),
        rate("1"),
        rate("2"),
    )


def recall(flagged: DataFrame, truth: str, flag_col: str = "quality_flag", valid: str = v.VALIDE) -> DataFrame:
    """Precision and recall of the quarantine against a known corruption column."""
    hit, real = F.col(flag_col) != valid, F.col(truth)
    return flagged.agg(
        F.count_if(hit & real).alias("tp"), F.count_if(hit & ~real).alias("fp"), F.count_if(~hit & real).alias("fn")
    ).select(
        "*",
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
    )


def repair(
    flagged: DataFrame,
    pickup: str = "tpep_pickup_datetime",
    dropoff: str = "tpep_dropoff_datetime",
    max_duration: str = "24 hours",
    flag_col: str = "quality_flag",
    z_limit: float = 3.0,
) -> DataFrame:
    """Decide what happens to each row, in one pass.

    Inverted times are swapped when the resulting duration is plausible. The flag stood for the first rule that
    held, so a swapped row is judged by the rule that comes after it as well: its flag becomes valid or outlier.
    Statistical outliers come back marked ``is_outlier``, valid rows stay gold, all others stay in quarantine.
    """
    early, late = F.least(pickup, dropoff), F.greatest(pickup, dropoff)
    swap = (F.col(flag_col) == v.INVERSION_TEMPS) & (late <= early + F.expr(f"INTERVAL {max_duration}"))
    beyond = F.coalesce(F.abs("z_score") > z_limit, F.lit(False)) if "z_score" in flagged.columns else F.lit(False)
    judged = F.when(beyond, v.ANOMALIE_STATISTIQUE).otherwise(v.VALIDE)
    outlier = (F.col(flag_col) == v.ANOMALIE_STATISTIQUE) | (swap & beyond)
    return flagged.withColumns(
        {
            pickup: F.when(swap, early).otherwise(F.col(pickup)),
            dropoff: F.when(swap, late).otherwise(F.col(dropoff)),
            flag_col: F.when(swap, judged).otherwise(F.col(flag_col)),
            "is_outlier": outlier,
            "disposition": F.when(swap, "swapped")
            .when(outlier, "kept_as_outlier")
            .when(F.col(flag_col) == v.VALIDE, "gold")
            .otherwise("quarantined"),
        }
    )


def repaired_gold(flagged: DataFrame) -> DataFrame:
    """Gold rows and repaired ones from one pass over the flagged rows; filter on ``is_outlier`` for the clean view."""
    return repair(flagged).where(F.col("disposition") != "quarantined").drop("disposition")


def reinjected(gold: DataFrame, repaired: DataFrame) -> DataFrame:
    """Gold rows together with the repaired ones; filter on ``is_outlier`` for the clean view."""
    back = repaired.where(F.col("disposition") != "quarantined").drop("disposition")
    return gold.withColumn("is_outlier", F.lit(False)).unionByName(back)


Checks = dict[str, tuple[Column, float, float]]


def judged(rows: DataFrame) -> DataFrame:
    """Add ``passed``: whether ``value`` lies between ``low`` and ``high``; no value does not pass."""
    passed = F.coalesce(F.col("value").between(F.col("low"), F.col("high")), F.lit(False))
    return rows.withColumn("passed", passed)


def check_ranges(df: DataFrame, checks: Checks) -> DataFrame:
    """One row per named aggregate with its value, bounds and outcome; one pass for all."""
    wide = df.agg(*[expr.cast("double").alias(name) for name, (expr, _, _) in checks.items()])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                F.col(name).alias("value"),
                F.lit(float(low)).alias("low"),
                F.lit(float(high)).alias("high"),
            )
            for name, (_, low, high) in checks.items()
        ]
    )
    return judged(wide.select(F.inline(rows)))


def observe_ranges(df: DataFrame, checks: Checks) -> tuple[DataFrame, Observation]:
    """Collect the checked aggregates while ``df`` is written, without a second pass."""
    seen = Observation()
    return df.observe(seen, *[expr.cast("double").alias(name) for name, (expr, _, _) in checks.items()]), seen


def observe_stream(df: DataFrame, name: str, checks: Checks) -> DataFrame:
    """Collect the checked aggregates of every micro-batch on its way; ``stream_verdicts`` reads them from the progress."""
    return df.observe(name, *[expr.cast("double").alias(check) for check, (expr, _, _) in checks.items()])


def judge_ranges(spark: SparkSession, seen: Observation, checks: Checks) -> DataFrame:
    """Check table of an observed frame, once it has been written."""
    values = seen.get
    rows = [(name, values[name], float(low), float(high)) for name, (_, low, high) in checks.items()]
    return judged(spark.createDataFrame(rows, "check_name string, value double, low double, high double"))
