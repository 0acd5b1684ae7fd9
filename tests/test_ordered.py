import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import verdict
from tidemark.operators.drift import psi, retrain_signal, share_by_batch, streaks
from tidemark.plans.ordered import followers, rolling_mean, row_numbers, running, with_blocks


@pytest.fixture(scope="module")
def series():
    rng = random.Random(5)
    at = sorted(rng.sample(range(-50, 400), 120))
    return [(b, rng.choice([None, rng.uniform(-1, 1)])) for b in at]


@pytest.fixture(scope="module")
def frame(spark, series):
    shuffled = random.Random(6).sample(series, len(series))
    return spark.createDataFrame(shuffled, "b bigint, x double")


@pytest.mark.parametrize("block", [1, 7, 100_000])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running(frame, series, block, inclusive):
    out = running(frame, "b", {"s": ("sum", F.col("x")), "m": ("max", F.col("x"))}, inclusive, block)
    got = {r["b"]: (r["s"], r["m"]) for r in out.collect()}
    for i, (b, _) in enumerate(series):
        past = [x for _, x in series[: i + inclusive] if x is not None]
        assert got[b][0] == pytest.approx(sum(past))
        assert got[b][1] == (max(past) if past else None)


def test_null_and_huge_order_values_are_kept(spark):
    big = 2**60
    df = spark.createDataFrame([(None, 5), (big, 1), (big + 1, 2), (big + 2, 3)], "b bigint, x int")
    out = running(df, "b", {"s": ("sum", F.col("x"))}, block=2)
    assert {r["b"]: r["s"] for r in out.collect()} == {None: 5, big: 6, big + 1: 8, big + 2: 11}


@pytest.mark.parametrize("block", [3, 100_000])
def test_positions_and_rolling_mean(frame, series, block):
    assert [r["rn"] for r in row_numbers(frame, "b", block=block).orderBy("b").collect()] == list(range(1, 121))
    got = {r["b"]: r["m"] for r in rolling_mean(frame, "b", "x", 5, "m", block).collect()}
    assert len(got) == len(series)
    for i, (b, _) in enumerate(series):
        last = [x for _, x in series[max(0, i - 4) : i + 1] if x is not None]
        assert got[b] == (pytest.approx(sum(last) / len(last)) if last else None)


def test_streaks(frame, series):
    got = {r["b"]: r["consecutive"] for r in streaks(frame, "b", F.col("x") > 0).collect()}
    run = 0
    for b, x in series:
        run = run + 1 if x is not None and x > 0 else 0
        assert got[b] == run


def test_shares_and_psi(spark):
    rows = [(1, "A")] * 3 + [(1, "B")] + [(1, None)] + [(2, "A")] * 2 + [(2, "B")] * 2 + [(9, "B")] * 4
    shares = share_by_batch(spark.createDataFrame(rows, "batch int, c string"), "batch", "c", ("A", "B", "C"))
    first = shares.where("batch = 1").first()
    assert (first["n"], first["A"], first["C"]) == (5, 3, 0)
    assert (first["pct_A"], first["pct_C"]) == (60.0, 0.0)
    base = {"A": 0.55, "B": 0.35, "C": 0.0}
    last = {"A": 0.0, "B": 1.0, "C": 0.0}
    want = sum((last[k] - base[k]) * math.log((last[k] + 1e-3) / (base[k] + 1e-3)) for k in base)
    scored = {r["batch"]: r for r in psi(shares, "batch", 2, ("A", "B", "C")).collect()}
    assert scored[9]["psi"] == pytest.approx(want)
    assert scored[9]["verdict"] == "drift" and scored[1]["verdict"] == "stable"


def test_retrain_after_three(spark):
    rows = [(1, 0.3), (2, 0.25), (3, 0.1), (4, 0.4), (5, 0.4), (6, 0.4), (7, 0.4)]
    df = spark.createDataFrame([(b, p, "x") for b, p in rows], "b int, psi double, verdict string")
    got = {r["b"]: (r["consecutive"], r["retrain"]) for r in retrain_signal(df, "b").collect()}
    assert [got[b][0] for b in range(1, 8)] == [1, 2, 0, 1, 2, 3, 1]
    assert sorted(b for b in got if got[b][1]) == [6]


def test_baseline_is_of_the_first_batches_that_exist(spark):
    for first in (0, 100):
        rows = [(first + b, c) for b in range(8) for c in ("A" * 3 + "B" if b < 5 else "B" * 4)]
        shares = share_by_batch(spark.createDataFrame(rows, "batch int, c string"), "batch", "c", ("A", "B"))
        got = [r["verdict"] for r in psi(shares, "batch", 5, ("A", "B")).orderBy("batch").collect()]
        assert got == ["stable"] * 5 + ["drift"] * 3
    assert spark.range(1).select(verdict(F.lit(None).cast("double"))).first()[0] is None


@pytest.mark.parametrize("spread", [1, 10**6, 2**50])
def test_blocks_go_by_rows_not_by_values(spark, spread):
    df = spark.range(2000).selectExpr(f"id * {spread}L AS b")
    sizes = [r["count"] for r in with_blocks(df, "b", 100).groupBy("_block").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 200


def test_followers(spark):
    values = random.Random(8).sample(range(-(10**12), 10**12), 500)
    df = spark.createDataFrame([(v,) for v in values], "b bigint")
    for block in (7, 100_000):
        got = {r["b"]: r["next"] for r in followers(df, "b", "next", block).collect()}
        ordered = sorted(values)
        assert got == dict(zip(ordered, [*ordered[1:], None]))
    assert followers(df.where("b IS NULL"), "b", "next").collect() == []
