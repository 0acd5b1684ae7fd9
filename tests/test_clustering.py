import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidemark.operators import clustering as cl
from tidemark.streaming.sinks import FileSink
from tidemark.streaming.stages import Stage, run_stage
from workload import views as w

COLS = ("a", "b")


@pytest.fixture(scope="module")
def points():
    rng = random.Random(3)
    return [(i, rng.gauss(cx, 0.6), rng.gauss(cy, 0.6)) for i, (cx, cy) in enumerate([(0, 0), (4, 4), (0, 5), (6, 0)] * 30)]


@pytest.fixture(scope="module")
def frame(spark, points):
    return spark.createDataFrame(points, "id int, a double, b double").repartition(4)


def brute(x, centres, passes, tol=1e-4):
    for _ in range(passes):
        d = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
        ids = d.argmin(axis=1)
        new = np.array([x[ids == j].mean(axis=0) if (ids == j).any() else centres[j] for j in range(len(centres))])
        moved, centres = np.linalg.norm(new - centres), new
        if moved < tol:
            break
    return centres, ids, d.min(axis=1).sum()


@pytest.mark.parametrize("passes", [1, 3, 20])
def test_lloyd_equals_brute_force(frame, points, passes):
    init = cl.first_centres(frame, "id", COLS, 4)
    centres, assigned = cl.lloyd(frame, COLS, init, passes)
    want, ids, wss = brute(np.array([p[1:] for p in points]), np.array(init), passes)
    assert np.allclose(centres, want)
    assert [r["cluster"] for r in assigned.orderBy("id").collect()] == ids.tolist()
    row = cl.inertia(assigned).first()
    assert (row["n"], row["inertia"]) == (len(points), pytest.approx(wss))


def test_inertia_never_rises(frame):
    init = cl.first_centres(frame, "id", COLS, 4)
    seen = [cl.inertia(cl.lloyd(frame, COLS, init, n)[1]).first()["inertia"] for n in (1, 2, 4)]
    assert seen == sorted(seen, reverse=True)


def test_empty_cluster_keeps_its_centre_and_ties_go_low(spark):
    df = spark.createDataFrame([(0.0, 0.0), (2.0, 0.0)], "a double, b double")
    centres, assigned = cl.lloyd(df, COLS, [[1.0, 0.0], [1.0, 0.0], [99.0, 99.0]], 1)
    assert centres == [[1.0, 0.0], [1.0, 0.0], [99.0, 99.0]]
    assert [r["cluster"] for r in assigned.collect()] == [0, 0]


def test_standardise_and_back(frame):
    m = cl.feature_moments(frame, COLS).first()
    scaled = cl.standardise(frame, m, COLS)
    r = scaled.agg(F.avg("a"), F.stddev("b")).first()
    assert r[0] == pytest.approx(0, abs=1e-9) and r[1] == pytest.approx(1)
    back = cl.destandardise(scaled, m, COLS).agg(F.sum("a")).first()[0]
    assert back == pytest.approx(frame.agg(F.sum("a")).first()[0])


def test_constant_feature_does_not_divide_by_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    m = cl.feature_moments(df, COLS).first()
    assert m["std_b"] == 1.0
    one = cl.feature_moments(df.limit(1), COLS).first()
    assert one["std_a"] == 1.0


def test_features_drop_incomplete_rows(spark):
    rows = [(1.0, 1.0, 1.0, 0.0, 1), (0.0, 1.0, 1.0, 0.0, 1), (1.0, 1.0, 1.0, -0.1, 1), (1.0, 1.0, 1.0, 0.0, None)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cl.TRIP_FEATURES[:4]) + ", passenger_count int")
    assert cl.trip_features(df).count() == 1


def test_zone_model_covers_every_zone(spark, small):
    features = cl.zone_features(w.Source(spark, small).trips, clean=True)
    scored = cl.train_zone_model(features).transform(features)
    assert scored.count() == features.count()
    assert scored.where("cluster_pca NOT BETWEEN 0 AND 3").count() == 0


def test_saved_model_scores_the_stream_as_the_batch(spark, small, tmp_path):
    rows = cl.trip_features(w.Source(spark, small).trips, keep=("trip_id",))
    cl.train_trip_model(rows).write().save(f"{tmp_path}/model")
    model = PipelineModel.load(f"{tmp_path}/model")

    def build():
        trips = w.trip_stream(spark, small)
        return model.transform(cl.trip_features(trips, keep=("trip_id",))).select("trip_id", "prediction")

    run_stage(Stage("scored", build, FileSink(f"{tmp_path}/out"), f"{tmp_path}/cp"))
    streamed = spark.read.parquet(f"{tmp_path}/out")
    batch = model.transform(rows).select("trip_id", "prediction")
    assert streamed.exceptAll(batch).count() == 0 and streamed.count() == batch.count()


def test_twenty_passes_beat_six(spark, medium):
    from tidemark.operators import clustering as cl
    from workload import queries as w

    scaled, _ = w._scaled(spark, medium)
    init = cl.first_centres(scaled, "trip_id", cl.TRIP_FEATURES, 4)
    few, many = (
        cl.inertia(cl.lloyd(scaled, cl.TRIP_FEATURES, init, max_iter=n)[1]).first()["inertia"] for n in (6, w.LLOYD_PASSES)
    )
    assert w.LLOYD_PASSES == 20 and many < few
