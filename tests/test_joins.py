import pytest
from pyspark.sql import functions as F

from tidemark.operators.joins import enrich, heavy_keys
from tidemark.plans.bounds import Size, fits_broadcast, measure
from tidemark.streaming.sinks import FileSink, settings
from tidemark.streaming.stages import Stage, run_stage


@pytest.fixture(scope="module")
def facts(spark):
    # One key holds most rows, some rows have none, and the rows of the hot key are exact copies.
    rows = [(7, "x")] * 600 + [(None, "n")] * 200 + [(i % 40, f"r{i}") for i in range(400)]
    return spark.createDataFrame(rows, "k int, v string").repartition(6)


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(i, f"d{i}") for i in range(30)], "key int, name string")


def counted(df):
    return sorted(((r["k"], r["v"], r["label"]) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_and_large_dimension_agree(facts, dim):
    small = enrich(facts, dim, "k", "key", {"name": "label"})
    large = enrich(facts, dim, "k", "key", {"name": "label"}, max_rows=5)
    assert small.columns == large.columns == ["k", "v", "label"]
    assert counted(small) == counted(large)
    assert small.count() == 1200
    assert small.where("k IS NULL OR k >= 30").where("label IS NOT NULL").count() == 0


def test_large_dimension_is_not_hinted(facts, dim, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small, large = (plan(enrich(facts, dim, "k", "key", {"name": "label"}, max_rows=n)) for n in (1000, 5))
        assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
        # What is broadcast then are the salts of heavy keys, on both sides; facts and dimension meet in a merge join.
        assert large.count("SortMergeJoin") == 1 and large.count("_hot") and large.count("BroadcastHashJoin") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_heavy_keys_by_share(facts):
    found = {r["_hot"]: r["_tasks"] for r in heavy_keys(facts, "k", 12).collect()}
    # 610 and 200 of 1,200 rows, in partitions of 100.
    assert found == {7: 7, None: 2}
    assert heavy_keys(facts.limit(0), "k", 12).collect() == []
    names = heavy_keys(facts.select(F.col("v").alias("a b")), "a b", 12).collect()
    assert {r["_hot"] for r in names} == {"x", "n"}


def test_hot_key_spreads_by_its_share_and_only_its_rows_are_copied(facts, dim, spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "12"}
    with settings(spark, conf):
        joined = enrich(facts, dim, "k", "key", {"name": "label"}, max_rows=5)
        parts = joined.where("k = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()
        empty = joined.where("k IS NULL").groupBy(F.spark_partition_id().alias("p")).count().collect()
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        copies = _copies(dim, heavy_keys(facts, "k", 12))
        cold = joined.select("k", F.spark_partition_id().alias("p")).where("k <> 7").distinct().groupBy("k").count()
        most = cold.agg(F.max("count")).first()[0]
    assert len(parts) >= 4 and len(empty) == 2 and sizes < 400
    assert copies == {7: 7}
    assert most == 1


def _copies(dim, heavy):
    """How often the join copies the rows of the dimension, from the shuffled side's rows."""
    return {r["_hot"]: r["_tasks"] for r in heavy.join(dim, heavy["_hot"] == dim["key"]).collect()}


def test_repeated_key_is_an_error(facts, dim):
    twice = dim.unionByName(dim.where("key = 3"))
    for most in (5, 1000):
        with pytest.raises(ValueError, match="2 rows of the lookup"):
            enrich(facts, twice, "k", "key", {"name": "label"}, max_rows=most)
    with pytest.raises(ValueError, match="2 rows of the lookup"):
        enrich(facts, twice, "k", "key", {"name": "label"}, proof=Size(31, 100))
    # Rows without a key match nothing, however many there are.
    keyless = dim.unionByName(dim.where("key < 3").selectExpr("CAST(NULL AS INT) AS key", "name"))
    assert counted(enrich(facts, keyless, "k", "key", {"name": "label"})) == counted(enrich(facts, dim, "k", "key", {"name": "label"}))


@pytest.mark.parametrize("known", [True, False])
def test_large_dimension_on_a_stream(facts, dim, spark, tmp_path, known):
    heavy = heavy_keys(facts, "k", 8) if known else None
    facts.write.parquet(f"{tmp_path}/facts")
    stream = spark.readStream.schema(facts.schema).parquet(f"{tmp_path}/facts")

    def build():
        return enrich(stream, dim, "k", "key", {"name": "label"}, max_rows=5, heavy=heavy)

    run_stage(Stage("salted", build, FileSink(f"{tmp_path}/out"), f"{tmp_path}/cp"))
    assert counted(spark.read.parquet(f"{tmp_path}/out")) == counted(enrich(facts, dim, "k", "key", {"name": "label"}))


def test_measure(spark):
    df = spark.createDataFrame([(1, "abc", [1]), (2, None, None)], "a int, b string, c array<int>")
    assert measure(df) == Size(2, 2 * (8 + 8) + 3 + len('{"c":[1]}') + len("{}"))
    assert measure(df.limit(0)) == Size(0, 0)
    assert measure(df, "a") == Size(2, 2 * (8 + 8) + 3 + len('{"c":[1]}') + len("{}"), 1)
    assert measure(df.limit(0), "a") == Size(0, 0, 0)
    assert fits_broadcast(spark.range(10), 10) and not fits_broadcast(spark.range(11), 10)
    assert not fits_broadcast(Size(3, 10**9))
