from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.operators import quality as q

T0 = datetime(2024, 1, 1, 8)
SCHEMA = (
    "id int, total_amount double, fare_amount double, trip_distance double, PULocationID int, "
    "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, z_score double"
)


def trip(i, total=10.0, fare=8.0, distance=2.0, zone=1, minutes=10, z=0.0):
    return (i, total, fare, distance, zone, T0, T0 + timedelta(minutes=minutes), z)


@pytest.mark.parametrize(
    "row, expected",
    [
        (trip(1), v.VALIDE),
        (trip(2, total=0.0, fare=0.0), v.VALIDE),
        (trip(3, total=-0.01), v.MONTANT_NEGATIF),
        (trip(4, fare=-1.0), v.MONTANT_NEGATIF),
        (trip(5, total=None, fare=-1.0), v.MONTANT_NEGATIF),
        (trip(6, total=None), v.VALIDE),
        (trip(7, distance=None), v.DISTANCE_NULLE),
        (trip(8, distance=0.0), v.DISTANCE_NULLE),
        (trip(9, distance=100.0), v.VALIDE),
        (trip(10, distance=100.01), v.DISTANCE_ABERRANTE),
        (trip(11, distance=float("nan")), v.DISTANCE_ABERRANTE),
        (trip(12, zone=None), v.LOCATION_NULLE),
        (trip(13, minutes=0), v.VALIDE),
        (trip(14, minutes=-1), v.INVERSION_TEMPS),
        (trip(15, z=3.0), v.VALIDE),
        (trip(16, z=-3.01), v.ANOMALIE_STATISTIQUE),
        (trip(17, z=float("nan")), v.ANOMALIE_STATISTIQUE),
        (trip(18, z=None), v.VALIDE),
        (trip(19, total=-5.0, distance=0.0, z=9.0), v.MONTANT_NEGATIF),
    ],
)
def test_flag_boundaries(spark, row, expected):
    df = spark.createDataFrame([row], SCHEMA)
    assert q.flag(df, q.taxi_rules()).first()["quality_flag"] == expected


def test_null_amount_rule_is_optional(spark):
    df = spark.createDataFrame([trip(1, total=None)], SCHEMA)
    assert q.flag(df, q.taxi_rules(null_amounts=True)).first()["quality_flag"] == "MONTANT_NULL"


def test_statistics_and_z_score(spark):
    rows = [("A", 10.0, 1.0), ("A", 20.0, 1.0), ("B", 5.0, 1.0), ("A", 600.0, 1.0), ("A", 30.0, 100.0), (None, 7.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, total_amount double, trip_distance double")
    stats = q.reference_stats(df, "k", "total_amount", q.clean_rows())
    got = {r["k"]: (r["mean_total"], r["std_total"], r["n_samples"]) for r in stats.collect()}
    assert got["A"] == (15.0, pytest.approx(7.0710678), 2)
    assert got["B"] == (5.0, None, 1)
    assert set(got) == {"A", "B"}
    z = {(r["k"], r["total_amount"]): r["z_score"] for r in q.z_score(df, stats, "k", "total_amount").collect()}
    assert z[("A", 600.0)] == pytest.approx(82.73149)
    assert z[("B", 5.0)] == 0.0 and z[(None, 7.0)] == 0.0


def flagged(spark):
    rows = [(1, v.VALIDE, 1), (2, v.VALIDE, 2), (3, v.DISTANCE_NULLE, 2), (4, v.INVERSION_TEMPS, 3)]
    return spark.createDataFrame(rows, "id int, quality_flag string, batch int")


def test_routes_partition_the_rows(spark):
    df = flagged(spark)
    gold, rejected = (r.select("id") for r in q.route(df))
    assert gold.intersect(rejected).count() == 0
    assert gold.union(rejected).count() == df.count()


def test_summary_and_empty_input(spark):
    df = flagged(spark)
    assert q.quality_summary(df).first().asDict() == {"gold": 2, "quarantine": 2, "total": 4, "rate_pct": 50.0}
    assert q.quality_summary(df.limit(0)).first()["rate_pct"] == 0.0
    by = {r["batch"]: r["rate_pct"] for r in q.quality_summary(df, ("batch",)).collect()}
    assert by == {1: 0.0, 2: 50.0, 3: 100.0}


def test_coverage_lists_missing_flags(spark):
    got = {r["quality_flag"]: (r["n"], r["present"]) for r in q.flag_coverage(flagged(spark)).collect()}
    assert got[v.VALIDE] == (2, True) and got[v.LOCATION_NULLE] == (0, False)
    assert tuple(sorted(got)) == tuple(sorted(v.FLAGS))


def test_delta(spark):
    row = q.dashboard_delta(flagged(spark), "batch", 2, 3).first()
    assert (row["gold_delta"], row["quarantine_delta"]) == (0, 1)
    assert (row["rate_1"], row["rate_2"]) == (pytest.approx(100 / 3), 50.0)


def test_repair(spark):
    rows = [
        (1, v.INVERSION_TEMPS, T0, T0 - timedelta(minutes=7)),
        (2, v.INVERSION_TEMPS, T0, T0 - timedelta(hours=30)),
        (3, v.ANOMALIE_STATISTIQUE, T0, T0 + timedelta(minutes=5)),
        (4, v.DISTANCE_ABERRANTE, T0, T0 + timedelta(minutes=5)),
    ]
    schema = "id int, quality_flag string, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp"
    fixed = q.repair(spark.createDataFrame(rows, schema))
    got = {r["id"]: r for r in fixed.collect()}
    assert got[1]["tpep_pickup_datetime"] == T0 - timedelta(minutes=7) and got[1]["disposition"] == "swapped"
    assert got[2]["tpep_pickup_datetime"] == T0 and got[2]["disposition"] == "quarantined"
    assert got[3]["is_outlier"] and got[3]["disposition"] == "kept_as_outlier"
    assert got[4]["disposition"] == "quarantined"
    back = q.reinjected(spark.createDataFrame([], schema), fixed)
    assert sorted(r["id"] for r in back.collect()) == [1, 3]


def test_swapped_rows_are_judged_again(spark):
    rows = [(1, v.INVERSION_TEMPS, 9.0), (2, v.INVERSION_TEMPS, 0.1), (3, v.VALIDE, 0.0), (4, v.DISTANCE_NULLE, 9.0)]
    df = spark.createDataFrame(rows, "id int, quality_flag string, z_score double").withColumns(
        {"tpep_pickup_datetime": F.lit(T0), "tpep_dropoff_datetime": F.lit(T0 - timedelta(minutes=7))}
    )
    got = {r["id"]: (r["quality_flag"], r["is_outlier"]) for r in q.repaired_gold(df).collect()}
    assert got == {1: (v.ANOMALIE_STATISTIQUE, True), 2: (v.VALIDE, False), 3: (v.VALIDE, False)}


def test_clean_gold_has_no_outliers_and_reads_the_facts_once(spark, small):
    from workload import views
    from workload.queries import registry

    clean = registry()["gold_clean"](spark, small)
    z = views.Source(spark, small).flagged.select("trip_id", "z_score")
    assert clean.join(z, "trip_id").where("abs(z_score) > 3").count() == 0
    text = clean._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    # Once for the rows, once for the statistics.
    assert text.count("events.parquet") == 2


def test_recall(spark):
    rows = [(v.VALIDE, True), (v.VALIDE, False), ("X", True), ("X", True), ("X", False)]
    r = q.recall(spark.createDataFrame(rows, "quality_flag string, truth boolean"), "truth").first()
    assert (r["tp"], r["fp"], r["fn"]) == (2, 1, 1)
    assert r["precision"] == r["recall"] == pytest.approx(2 / 3)


def test_check_ranges(spark):
    df = spark.range(10)
    got = q.check_ranges(df, {"mean": (F.avg("id"), 4.5, 5), "low": (F.min("id"), 1, 2), "none": (F.lit(None), 0, 1)})
    assert {r["check_name"]: r["passed"] for r in got.collect()} == {"mean": True, "low": False, "none": False}


def test_observed_ranges_need_no_second_pass(spark):
    checks = {"mean": (F.avg("id"), 4.0, 5.0), "top": (F.max("id"), 0.0, 5.0)}
    df, seen = q.observe_ranges(spark.range(10), checks)
    df.write.format("noop").mode("overwrite").save()
    got = {r["check_name"]: (r["value"], r["passed"]) for r in q.judge_ranges(spark, seen, checks).collect()}
    assert got == {"mean": (4.5, True), "top": (9.0, False)}
