import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import zorder_key
from tidemark.plans.bounds import measure
from tidemark.plans import layout
from tidemark.plans.layout import compact, data_files, file_stats, layer_of, packed_files, write_lookup_layer, zorder_rewrite
from workload import queries as q
from workload import views as w

COLS = ["tpep_pickup_datetime", "PULocationID"]


def test_key_interleaves_bits(spark):
    df = spark.createDataFrame([(0b101, 0b011)], "a int, b int")
    assert df.select(zorder_key(["a", "b"], 3)).first()[0] == 0b011011
    with pytest.raises(ValueError):
        zorder_key(["a"] * 8, 8)


def test_rewrite_keeps_rows_and_narrows_files(spark, medium, tmp_path):
    trips = w.Source(spark, medium).trips
    before, after = f"{tmp_path}/before", f"{tmp_path}/after"
    trips.repartition(40).write.parquet(before)
    zorder_rewrite(spark.read.parquet(before), COLS, after, files=8)
    old, new = spark.read.parquet(before), spark.read.parquet(after)
    assert old.exceptAll(new).count() == 0 and new.exceptAll(old).count() == 0
    assert (file_stats(spark, before).first()["n_files"], file_stats(spark, after).first()["n_files"]) == (40, 8)

    def spread(df):
        per = df.groupBy(F.col("_metadata.file_path")).agg((F.max("PULocationID") - F.min("PULocationID")).alias("s"))
        return per.agg(F.avg("s")).first()[0]

    assert spread(new) < spread(old)


def test_hot_bucket_fills_several_files(spark, tmp_path):
    hot = spark.range(4000, numPartitions=8).selectExpr("id", "CAST(7 AS INT) AS a", "CAST(7 AS INT) AS b")
    cold = spark.range(2000, numPartitions=2).selectExpr("id", "CAST(id % 50 AS INT) AS a", "CAST(id % 9 AS INT) AS b")
    zorder_rewrite(hot.union(cold), ["a", "b"], f"{tmp_path}/z", files=6)
    sizes = spark.read.parquet(f"{tmp_path}/z").groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(sizes) == 6 and max(r["count"] for r in sizes) < 2500


def test_adaptive_execution_sizes_the_files(spark, tmp_path):
    df = spark.range(5000).selectExpr("id", "CAST(id % 50 AS INT) AS a", "CAST(id % 9 AS INT) AS b")
    zorder_rewrite(df, ["a", "b"], f"{tmp_path}/z")
    row = file_stats(spark, f"{tmp_path}/z").first()
    assert row["n_rows"] == 5000 and 1 <= row["n_files"] <= 4


def test_null_and_unsupported_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (None, 2)], "a int, b int")
    zorder_rewrite(df, ["a", "b"], f"{tmp_path}/n", files=1)
    assert spark.read.parquet(f"{tmp_path}/n").count() == 2
    with pytest.raises(TypeError):
        zorder_rewrite(df.selectExpr("'x' AS s"), ["s"], f"{tmp_path}/s")


def test_file_stats_match_the_files(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(f"{tmp_path}/t")
    row = file_stats(spark, f"{tmp_path}/t").first()
    assert (row["n_files"], row["n_rows"]) == (3, 100)
    assert row["total_bytes"] == sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert pq.read_table(f"{tmp_path}/t").num_rows == 100


def test_cached_dimension_is_reused(spark, small):
    zones = w.zones(spark, small).cache()
    try:
        assert measure(zones).rows == 25
        assert "InMemoryTableScan" in zones.select("Zone")._jdf.queryExecution().executedPlan().toString()
    finally:
        zones.unpersist()


# -- compaction -------------------------------------------------------------------------------


def names(spark, path):
    rows = data_files(spark, path, ["p"]).collect()
    return {p: {r["_file"] for r in rows if r["p"] == p} for p in {r["p"] for r in rows}}


@pytest.fixture
def layer(spark, tmp_path):
    """Folder 05 and the null folder have eight small files, folder b has one."""
    path = f"{tmp_path}/layer"
    many = spark.range(800, numPartitions=8).selectExpr("id", "IF(id % 2 = 0, '05', NULL) AS p")
    many.write.partitionBy("p").parquet(path)
    spark.range(800, 900, numPartitions=1).selectExpr("id", "'b' AS p").write.mode("append").partitionBy("p").parquet(path)
    return path


def test_only_partitions_with_small_files_are_replaced(spark, layer):
    before = {tuple(r) for r in spark.read.parquet(layer).collect()}
    old = names(spark, layer)
    assert compact(spark, layer, ["p"]) == 2
    new = names(spark, layer)
    assert new["b"] == old["b"] and not new["05" if "05" in new else 5] & old.get("05", old.get(5))
    assert sorted(len(f) for f in new.values()) == [1, 1, 1]
    assert {tuple(r) for r in spark.read.parquet(layer).collect()} == before and spark.read.parquet(layer).count() == 900
    assert compact(spark, layer, ["p"]) == 0 and names(spark, layer) == new


def test_files_are_filled_up_to_the_wanted_size(spark, layer):
    sizes = [r["_bytes"] for r in data_files(spark, layer, ["p"]).where("p = 'b' OR p IS NULL").collect()]
    full = 3 * max(sizes)
    compact(spark, layer, ["p"], full)
    counts = sorted(len(f) for f in names(spark, layer).values())
    assert counts[0] == 1 and counts[1] == counts[2] and 2 <= counts[1] <= 4


def test_a_run_that_died_is_finished_by_the_next(spark, layer, monkeypatch):
    before = spark.read.parquet(layer).count()
    real, calls = layout._replace, []

    def dies(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        real(*args)

    monkeypatch.setattr(layout, "_replace", dies)
    with pytest.raises(RuntimeError):
        compact(spark, layer, ["p"])
    monkeypatch.setattr(layout, "_replace", real)
    # The worst moment: the old files of a partition are gone already.
    spark.createDataFrame([(-1, "05")], "id bigint, p string").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("p").parquet(layer)
    assert compact(spark, layer, ["p"]) == 0
    rows = spark.read.parquet(layer)
    assert rows.count() == before and rows.where("id < 0").count() == 0
    assert all(len(f) == 1 for f in names(spark, layer).values())


def test_bins_are_cut_by_length(spark):
    files = [("a", f"f{i}", n) for i, n in enumerate([10, 10, 10, 60, 250])] + [("b", "g", 500), ("c", "h", 90), ("c", "i", 90)]
    got = packed_files(spark.createDataFrame(files, "p string, _file string, _bytes long"), ["p"], 100).collect()
    bins = {}
    for r in got:
        bins.setdefault((r["p"], r["_bin"]), set()).add(r["_file"])
    # A lone file has nothing to join; the long file begins within the first hundred bytes.
    assert set(map(frozenset, bins.values())) == {frozenset({"f0", "f1", "f2", "f3", "f4"}), frozenset({"h", "i"})}
    assert sorted({b for _, b in bins}) == list(range(len(bins)))


# -- layers and lookups -----------------------------------------------------------------------


def scanned(df):
    """Rows that the scan handed on, after it skipped row groups."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metrics().apply("numOutputRows").value()


def test_bloom_filter_skips_an_absent_key_inside_the_range(spark, tmp_path):
    # Even numbers only, so an odd one lies within least and greatest; no dictionary that could exclude it.
    df = spark.range(0, 20_000, 2).selectExpr("id", "id % 7 AS x")
    with_filter, without = f"{tmp_path}/bloom", f"{tmp_path}/plain"
    spark.conf.set("parquet.enable.dictionary", "false")
    try:
        write_lookup_layer(df, {"id": 10_000}, with_filter, 2)
        df.repartition(2, "id").write.option("parquet.enable.dictionary", "false").parquet(without)
    finally:
        spark.conf.unset("parquet.enable.dictionary")
    for path, absent in ((with_filter, 0), (without, 10_000)):
        stored = spark.read.parquet(path)
        assert scanned(stored.where("id = 7777")) == absent
        assert [r["id"] for r in stored.where("id = 7778").collect()] == [7778]
    assert 0 < scanned(spark.read.parquet(with_filter).where("id = 7778")) < 10_000


def test_a_layer_is_written_once_until_its_source_changes(spark, tmp_path):
    source, calls = f"{tmp_path}/source", []

    def write(path):
        calls.append(path)
        spark.read.parquet(source).write.mode("overwrite").parquet(path)

    spark.range(5).write.parquet(source)
    first = layer_of(spark, "t", source, write)
    assert layer_of(spark, "t", source, write) == first and calls == [first]
    spark.range(5, 9).write.mode("append").parquet(source)
    second = layer_of(spark, "t", source, write)
    assert second != first and spark.read.parquet(second).count() == 9


def test_a_half_written_layer_is_written_again(spark, tmp_path):
    source = f"{tmp_path}/source"
    spark.range(5).write.parquet(source)

    def half(path):
        spark.range(2).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").mode("overwrite").parquet(path)

    path = layer_of(spark, "h", source, half)
    assert spark.read.parquet(path).count() == 2
    assert layer_of(spark, "h", source, lambda p: spark.range(5).write.mode("overwrite").parquet(p)) == path
    assert spark.read.parquet(path).count() == 5


def test_small_files_are_written_many_a_task(spark, small, tmp_path):
    """Tables of several files, none of whole small files, ids null or repeated: as many files as full ones hold the rows."""
    events = spark.read.parquet(f"{small}/events.parquet").withColumn("event_id", F.expr("CASE WHEN event_id % 5 > 0 THEN event_id % 90 END"))
    for n in (3001, 7, 777, 9000):
        events.crossJoin(spark.range(10)).drop("id").limit(n).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    path = q._scattered(spark, str(tmp_path), "scattered")
    trips, back = w.Source(spark, str(tmp_path)).trips, spark.read.parquet(path)
    sizes = [r["count"] for r in back.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sorted(sizes)[0] == trips.count() % 250 and sorted(sizes)[1:] == [250] * (trips.count() // 250)
    assert trips.exceptAll(back).isEmpty() and back.exceptAll(trips).isEmpty()
    tasks = {r[0] for r in back.select(F.regexp_extract(F.col("_metadata.file_path"), r"part-(\d+)-", 1)).distinct().collect()}
    assert len(tasks) == -(-len(sizes) // q.TASK_FILES)
