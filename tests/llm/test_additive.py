"""The additive model against plain counts, row-by-row sums and held-out labels."""

import zlib

import numpy as np

from tidemark.llm import additive as ad

DOC = "doc_id bigint, text string, quality int, score double, words string"


def test_figures_by_hand():
    text = "Aa aa aa b|| c# 12 É\n\nAa aa aa b||\nx x"
    f = dict(zip(ad.FIGURES, ad.text_figures([b"zz", text.encode(), b""])[1]))
    words = text.split()
    assert np.isclose(f["words"], np.log1p(len(words)))
    assert np.isclose(f["word_length"], sum(map(len, words)) / len(words))
    assert np.isclose(f["symbols"], 5 / len(words)) and np.isclose(f["symbol_words"], 3 / len(words))
    assert np.isclose(f["upper"], 2 / sum(c.isascii() and c.isalpha() for c in text))
    assert np.isclose(f["digits"], 2 / sum(map(len, words)))
    assert np.isclose(f["stutter"], 3 / len(words)) and np.isclose(f["longest_stutter"], np.log1p(1))
    assert np.isclose(f["distinct"], len(set(words)) / len(words))
    assert np.isclose(f["lines"], np.log1p(3)) and f["repeated_lines"] == 0 and np.isclose(f["bars"], 4 / len(words))
    assert (ad.text_figures([b"", b" \n"]) == 0).all()


def test_figures_do_not_depend_on_neighbours():
    texts = [b"a b a b a b a b", b"", b"q! q! q! q!\nq! q! q! q!", b"b", "ß ñ # é".encode()]
    alone = np.concatenate([ad.text_figures([t]) for t in texts])
    assert np.allclose(ad.text_figures(texts), alone)


def test_model_learns_an_interaction_and_sums_tables():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(ad.FIGURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.4)).astype(int)
    plain, model = ad.fit_additive(x[:3000], y[:3000], pairs=0), ad.fit_additive(x[:3000], y[:3000])
    right = lambda m: ((m.scores(x[3000:]) >= 0.5) == y[3000:]).mean()
    # Both cuts may lie up to half a coarse bin beside the true ones.
    assert right(plain) < 0.7 and right(model) > 1 - 1 / ad.PAIR_BINS and (0, 3) in model.pairs
    row = x[7]
    total = model.intercept + sum(t[int((c <= v).sum())] for v, c, t in zip(row, model.cuts, model.tables))
    total += sum(t[int((model.coarse[i] <= row[i]).sum()), int((model.coarse[j] <= row[j]).sum())] for (i, j), t in zip(model.pairs, model.pair_tables))
    assert np.isclose(ad.logistic(np.array([total])), model.scores(x[7:8]))
    order = rng.permutation(3000)
    assert np.allclose(ad.fit_additive(x[:3000][order], y[:3000][order]).scores(x), model.scores(x))


def test_edges(spark):
    docs = spark.createDataFrame([(i, t, 1, 0.5, "w") for i, t in enumerate([None, "", " ", "a b", "x" * 5000, "a b"])] + [(None, "n", None, None, None)] * 2, DOC)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = ad.classify(docs, none).collect()
    assert len(out) == 8 and {r.score for r in out} == {0.5} and {r.predicted for r in out} == {0}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    odd = spark.createDataFrame([(i, q, 0) for i, q in [(0, 1), (1, None), (3, 1), (4, 7), (None, 0), (3, 0), (99, 0)]], "doc_id bigint, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in ad.classify(docs, odd).collect())
    assert ad.classify(docs.limit(0), odd).collect() == []


def test_labels_of_held_out_rows_are_not_read(spark, medium):
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality", "toxic")
    a, b = ({r.doc_id: r.score for r in ad.classify(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_fit_rows_bound(spark, medium):
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    described = ad.figures(docs)
    whole, some = ad.labelled(described, labels), ad.labelled(described, labels, 100)
    assert 60 <= len(some) <= 140 < len(whole)
    assert set(map(tuple, some.to_numpy())) <= set(map(tuple, whole.to_numpy()))


def test_held_out_accuracy(spark):
    import __spark_entry__ as entry_point

    sf = "/root/testdata/sf0.1"
    out = entry_point.queries()["op12_additive_quality"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality IS NOT NULL")
    rows = out.where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").toPandas()
    good, bad = rows[rows.quality == 1], rows[rows.quality == 0]
    assert (good.predicted == 1).mean() > 0.98 and (bad.predicted == 0).mean() > 0.9
    ahead = (good.score.to_numpy()[:, None] > bad.score.to_numpy()[None, :]).mean()
    assert ahead > 0.99
