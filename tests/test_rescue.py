import json

from tidemark.sources.files import pinned_schema, read_csv_dimension
from tidemark.sources.rescue import rescue, rescue_json, rescue_variant, rescued_schema


def schema(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def test_extra_and_unfit_values_are_kept(spark):
    df = spark.createDataFrame([(1, "7", "x"), (2, "n/a", None)], "id int, n string, more string")
    got = {r["id"]: r for r in rescue(df, schema(spark, "id int, n int, absent double")).collect()}
    assert (got[1]["n"], got[1]["absent"], json.loads(got[1]["_rescued_data"])) == (7, None, {"more": "x"})
    assert got[2]["n"] is None and json.loads(got[2]["_rescued_data"]) == {"n": "n/a"}


def test_casts_that_lose_something_are_not_taken(spark):
    df = spark.sql("SELECT 1 AS id, 2.7D AS n, TIMESTAMP'2024-01-02 03:04:05' AS d UNION ALL SELECT 2, 3D, TIMESTAMP'2024-01-02 00:00:00'")
    got = {r["id"]: r for r in rescue(df, schema(spark, "id int, n int, d date")).collect()}
    assert (got[1]["n"], got[1]["d"]) == (None, None) and set(json.loads(got[1]["_rescued_data"])) == {"n", "d"}
    assert got[2]["n"] == 3 and str(got[2]["d"]) == "2024-01-02" and got[2]["_rescued_data"] is None


def test_nothing_left_over(spark):
    df = spark.createDataFrame([(1, None)], "id int, more string")
    assert rescue(df, schema(spark, "id int")).first()["_rescued_data"] is None
    assert rescue(df.select("id"), schema(spark, "id int")).first()["_rescued_data"] is None


def test_json_payload(spark):
    rows = [(1, '{"k": 5, "z": "q"}'), (2, '{"k": "five"}'), (3, "no json"), (4, '{"k": 8}'), (5, None)]
    df = spark.createDataFrame(rows, "id int, p string")
    got = {r["id"]: (r["k"], r["_rescued_data"]) for r in rescue_json(df, "p", schema(spark, "k int")).collect()}
    assert got[1][0] == 5 and json.loads(got[1][1]) == {"z": "q"}
    assert got[2][0] is None and json.loads(got[2][1]) == {"k": "five"}
    assert got[3] == (None, "no json") and got[4] == (8, None) and got[5] == (None, None)


def test_files_with_different_schemas(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/d/a")
    spark.range(2).selectExpr("id", "'s' AS later").write.parquet(f"{tmp_path}/d/b")
    wide = pinned_schema(spark, f"{tmp_path}/d/*", merge=True)
    assert wide.fieldNames() == ["id", "later"]
    out = rescue(spark.read.schema(wide).parquet(f"{tmp_path}/d/*"), schema(spark, "id bigint"))
    assert out.count() == 5 and out.where("_rescued_data IS NOT NULL").count() == 2


def test_dimension_is_stored_once(spark, tmp_path):
    path = f"{tmp_path}/zones"
    spark.sql("SELECT 1 AS LocationID, 'Q' AS Borough").write.option("header", True).csv(path)
    first = read_csv_dimension(spark, path, table="ref_zones_once")
    assert first.dtypes == [("LocationID", "int"), ("Borough", "string")]
    again = read_csv_dimension(spark, f"{tmp_path}/missing", table="ref_zones_once")
    assert again.collect() == first.collect()


def test_variant_keeps_kinds_and_nesting(spark):
    rows = [
        (1, '{"k": 5, "z": {"a": [1, {"b": 2.5}]}}'), (2, '{"k": "five", "n": 7}'), (3, "no json"), (4, '{"k": 8}'), (5, None),
        (6, "[1, 2]"), (7, '{"k": 2.7}'), (8, '{"k": 3.0}'), (9, '{"k": null}'), (10, '{"k": 99999999999}'), (11, "{}"),
        (12, '{"k": true, "d": "2024-01-02 03:04:05"}'), (13, ""), (14, '{"d": "2024-01-02", "b": 2}'), (15, '{"b": true}'),
    ]
    pinned = schema(spark, "k int, d date, b boolean")
    out = rescue_variant(spark.createDataFrame(rows, "id int, p string"), "p", pinned)
    assert out.columns == ["id", "k", "d", "b", "_rescued_data"] and dict(out.dtypes)["_rescued_data"] == "variant"
    got = {r["id"]: r for r in out.selectExpr("id", "k", "d", "b", "to_json(_rescued_data) AS left").collect()}
    left = {i: r["left"] and json.loads(r["left"]) for i, r in got.items()}
    assert got[1]["k"] == 5 and left[1] == {"z": {"a": [1, {"b": 2.5}]}}
    assert got[2]["k"] is None and left[2] == {"k": "five", "n": 7}
    assert left[3] == "no json" and left[4] is None and got[5]["left"] is None and left[6] == [1, 2]
    assert got[7]["k"] is None and left[7] == {"k": 2.7} and got[8]["k"] == 3 and left[8] is None
    assert got[9]["k"] is None and left[9] is None and left[10] == {"k": 99999999999} and left[11] is None
    assert left[12]["d"] == "2024-01-02 03:04:05" and got[12]["d"] is None
    assert str(got[14]["d"]) == "2024-01-02" and left[14] == {"b": 2} and got[15]["b"] is True
    assert got[12]["k"] is None and left[12]["k"] is True
    inner = "schema_of_variant(variant_get(_rescued_data, '$.z.a[1].b', 'variant'))"
    assert out.where("id = 1").selectExpr(f"{inner} AS s").first()["s"].startswith("DECIMAL")


def test_variant_schema_of_what_appeared(spark):
    df = spark.createDataFrame([('{"k": 1, "a": 2}',), ('{"k": 1, "b": "x"}',)], "p string")
    found = rescued_schema(rescue_variant(df, "p", schema(spark, "k int"))).first()["appeared"]
    assert found == "OBJECT<a: BIGINT, b: STRING>"


def test_variant_layer_reads_old_and_new_files(spark, tmp_path):
    pinned = schema(spark, "k int")
    for payload in ('{"k": 1}', '{"k": 2, "late": {"x": 3}}'):
        df = spark.createDataFrame([(payload,)], "p string")
        rescue_variant(df, "p", pinned).write.mode("append").parquet(f"{tmp_path}/t")
    rows = spark.read.parquet(f"{tmp_path}/t").selectExpr("k", "variant_get(_rescued_data, '$.late.x', 'int') AS x")
    assert sorted((r["k"], r["x"]) for r in rows.collect()) == [(1, None), (2, 3)]
