from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import label, seconds, verdict
from tidemark.operators import kpi as k
from tidemark.operators.schema import schema_diff
from tidemark.operators.scoring import derive_labels, score_by_lookup

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rides(spark):
    rows = [(T0 + timedelta(minutes=7 * i % 240, seconds=i), "AB"[i % 2] if i % 5 else None, float(i)) for i in range(200)]
    return spark.createDataFrame(rows, "ts timestamp, k string, x double")


def test_tumbling(rides):
    out = k.window_kpi(rides, "ts", ["k"], {"n": F.count(F.lit(1)), "m": F.avg("x")})
    assert out.columns == ["window_start", "window_end", "k", "n", "m"]
    assert out.groupBy().sum("n").first()[0] == 200
    assert out.where("k IS NULL").count() > 0


def test_sliding_counts_equal_expanded_windows(rides):
    fast = k.sliding_counts(rides, "ts", ["k"], {"n": F.col("x") > 50}, "50 minutes", "10 minutes")
    slow = k.window_kpi(rides, "ts", ["k"], {"n": F.count_if(F.col("x") > 50)}, "50 minutes", "10 minutes")
    assert fast.columns == slow.columns
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0


def test_sliding_size_must_be_a_multiple(rides):
    with pytest.raises(ValueError):
        k.sliding_counts(rides, "ts", [], {"n": F.lit(True)}, "25 minutes", "10 minutes")


def test_closed_includes_the_window_that_ends_at_the_watermark(spark):
    rows = [(T0, T0 + timedelta(minutes=m)) for m in (10, 20, 21)]
    df = spark.createDataFrame(rows, "window_start timestamp, window_end timestamp")
    assert k.closed_only(df, F.lit(T0 + timedelta(minutes=25))).count() == 2


def test_confidence_interval(spark):
    df = spark.createDataFrame([("A", 10.0), ("A", 20.0), ("B", 5.0), ("B", -1.0), (None, 3.0)], "k string, x double")
    got = {r["k"]: r for r in k.mean_ci(df, "k", "x", "stream").collect()}
    half = 1.96 * 7.0710678 / 2**0.5
    assert got["A"]["ic95_low"] == pytest.approx(15 - half)
    assert got["B"]["n"] == 1 and got["B"]["ic95_low"] is None
    assert set(got) == {"A", "B"}


def test_rank_of_boroughs_is_comparable(spark, small):
    from workload.queries import registry

    rows = registry()["kpi_compare"](spark, small).collect()
    by_source = {s: {r["pickup_borough"] for r in rows if r["source"] == s} for s in ("stream", "batch")}
    assert by_source["stream"] and by_source["stream"] <= by_source["batch"]


def test_component_rates(spark):
    df = spark.createDataFrame([("A", 10.0, 8.0, 2.0), ("A", 10.0, 5.0, 1.0)], "k string, t double, f double, p double")
    row = k.component_rates(df, "k", "t", {"fare": ["f"], "tip": ["p"]}).first()
    assert (row["n"], row["n_balanced"], row["fare_rate"], row["tip_rate"]) == (2, 1, 0.65, 0.15)


def test_layer_ratio_of_an_empty_layer(spark):
    up = spark.createDataFrame([(1,), (6,)], "b int")
    got = {r["mark"]: r["layer_ratio"] for r in k.layer_ratio(up.limit(0), up, "b", [5, 10]).collect()}
    assert got == {5: 0.0, 10: 0.0}


def test_latency_summary(spark):
    log = spark.createDataFrame([(20, 1.0, 5), (20, 21.0, 9), (50, 20.0, 3)], "rate int, d double, n int")
    got = {r["rate"]: r for r in k.latency_summary(log, "rate", "d", "n").collect()}
    assert (got[20]["n_saturated"], got[20]["rows_final"], got[20]["duration_avg"]) == (1, 9, 11.0)
    assert got[50]["n_saturated"] == 0


def test_labels_and_limits(spark):
    df = spark.createDataFrame([(0, 0.05), (3, 0.1), (9, 0.25), (None, 0.2)], "c int, p double")
    got = [tuple(r) for r in df.select(label(F.col("c"), {0: "a", 3: "b"}), verdict(F.col("p"))).collect()]
    assert got == [("a", "stable"), ("b", "moderate"), (None, "drift"), (None, "moderate")]
    assert seconds("10 minutes") == 600 and seconds("1 hour") == 3600
    with pytest.raises(ValueError):
        seconds("0 minutes")


def test_lookup_scoring_keeps_unknown_zones(spark):
    trips = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, PULocationID int")
    clusters = spark.createDataFrame([(10, 2)], "PULocationID int, cluster_pca int")
    got = {r["id"]: (r["prediction"], r["cluster_label"]) for r in score_by_lookup(trips, clusters).collect()}
    assert got == {1: (2, "HUB_URBAIN"), 2: (None, None)}


def test_derived_labels(spark):
    rows = [(0, 7.0, 31.0, 14.0), (1, 19.0, 55.0, 9.0), (2, 2.5, 20.0, 432.0), (3, 5.0, 84.0, 3.0)]
    profile = spark.createDataFrame(rows, "prediction int, avg_dist double, avg_fare double, avg_trips double")
    got = {r["prediction"]: r["cluster_label"] for r in derive_labels(profile).collect()}
    assert got == {0: "BANLIEUE_REG", 1: "LONG_COURRIER", 2: "HUB_URBAIN", 3: "PREMIUM_LUXE"}


def test_schema_diff(spark):
    left = spark.createDataFrame([(1, None, "x")], "a int, b int, c string")
    right = spark.createDataFrame([(1, 2, 3)], "a int, b bigint, d int")
    got = {r["name"]: (r["status"], r["left_filled"], r["right_filled"]) for r in schema_diff(left, right).collect()}
    assert got == {
        "a": ("same", 1, 1), "b": ("type_mismatch", 0, 1), "c": ("only_left", 1, None), "d": ("only_right", None, 1),
    }
