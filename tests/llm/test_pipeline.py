"""The pipeline: every stage works on what its predecessor kept, and its decisions take effect."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
import public_tokenizers
from llm import brute
from tidemark.llm import mixing
from tidemark.llm.rows import addressed, without


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    root, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{small}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, small)
        result.write.parquet(f"{root}/{name}")
        out.append((docs, spark.read.parquet(f"{root}/{name}")))
        docs = out[-1][1]
    return out


def test_columns_stay_until_the_last_stage(stages):
    assert all(after.columns == before.columns for before, after in stages[:-1])
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "personal_data", "mix_sources", "sentence_pieces"]


def test_language_stage_keeps_clean_documents(stages):
    before, after = stages[0]
    assert after.count() >= 0.98 * before.count()
    assert after.join(before, before.columns, "left_anti").count() == 0


def test_one_document_of_each_group_stays(stages):
    before, after = stages[1]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    want = {c for _, _, c in brute.groups(rows, 5, 80)}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(want)


def test_personal_data_is_gone_and_the_rest_is_not(stages):
    before, after = ({r["doc_id"]: r for r in df.collect()} for df in stages[2])
    assert before.keys() == after.keys()
    for i, r in before.items():
        assert not brute.private(after[i]["text"])
        assert after[i]["n_chars"] == len(after[i]["text"])
        if not any(c.isdigit() or c == "@" for c in r["text"]):
            assert after[i] == r


def test_mix_repeats_documents(stages):
    before, after = stages[3]
    total = lambda df: sum(len(brute.words(r["text"])) for r in df.collect())
    assert abs(total(after) - total(before)) < 0.1 * total(before)
    assert after.groupBy("doc_id").count().agg(F.max("count")).first()[0] in (2, 3)


def test_pieces_decode_to_the_texts(stages):
    import hashlib

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    before, after = stages[4]
    want = sorted((r["doc_id"], library.encode(r["text"]), hashlib.sha256(r["text"].encode()).hexdigest()) for r in before.collect())
    assert sorted((r["doc_id"], r["ids"], r["decoded_sha256"]) for r in after.collect()) == want


def test_odd_rows_pass_through_all_stages(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "the and " * 40, "en", None, 1), (3, "the and " * 40, "en", None, 1), (None, "the with " * 50, "en", "s", 2)]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/a/documents.parquet")
    spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/b/documents.parquet")
    for d in "ab":
        spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/{d}/labels.parquet")
    out = corpus_pipeline.run(spark, f"{tmp_path}/a").collect()
    assert {r["doc_id"] for r in out} <= {3, None}
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").collect() == []


PLANTED = [(9001, "0101 ### 0202", None, None, None), (9002, "zq " * 3, None, None, None), (9002, "zq " * 3, None, None, None)]


def _frames(spark, small):
    """The same documents, odd ones among them, as frames that have no file of their own."""
    docs = spark.read.parquet(f"{small}/documents.parquet").where("doc_id < 60")
    planted = spark.createDataFrame(PLANTED, docs.schema)
    twice = spark.createDataFrame([(1,), (2,)], "_n int")
    return {
        "union": docs.unionByName(planted).unionByName(docs.where("doc_id < 20")),
        "local": spark.createDataFrame(docs.collect() + PLANTED + docs.where("doc_id < 20").collect(), docs.schema),
        "join": docs.crossJoin(twice).select(docs.columns),
        # The address of the file's row is that of both copies.
        "explode": docs.withColumn("_n", F.explode(F.array(F.lit(1), F.lit(2)))).select(docs.columns),
    }


@pytest.mark.parametrize("kind", ["union", "local", "join", "explode"])
def test_stages_take_frames_without_files(spark, small, tmp_path, kind):
    docs = _frames(spark, small)[kind]
    docs.write.parquet(f"{tmp_path}/docs")
    filed = spark.read.parquet(f"{tmp_path}/docs")
    whole = lambda df: sorted(map(str, df.collect()))
    spoken = whole(corpus_pipeline.identify_language(spark, docs, small))
    assert spoken == whole(corpus_pipeline.identify_language(spark, filed, small))
    if kind in ("union", "local"):
        assert not any("doc_id=9001" in r for r in spoken)
    left = corpus_pipeline.join_near_copies(spark, docs, small).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(r["doc_id"] for r in left) == sorted({c for _, _, c in brute.groups(rows, 5, 80)})


def test_rows_without_an_address_are_not_matched(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    with pytest.raises(ValueError):
        without(docs, addressed(docs))


def test_queries_are_registered():
    names = entry_point.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} == {k.split("_")[0] for k in names if k.startswith("op")}


def test_rest_works_without_this_package(tmp_path):
    """A copy of the repository without the optional parts still imports, with the other queries."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    skip = ("llm", ".git", "__pycache__")
    for folder, names, files in os.walk(root):
        names[:] = [n for n in names if n not in skip]
        to = tmp_path / os.path.relpath(folder, root)
        to.mkdir(exist_ok=True)
        for f in files:
            if f.endswith(".py") and f != "corpus_pipeline.py":
                (to / f).write_text(open(os.path.join(folder, f)).read())
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, timeout=120).returncode == 0


def test_mix_plans_do_not_grow_with_the_rounds(spark):
    """Sources that are filled in several rounds: what reads the result plans one table of rounds, not a branch for each."""
    rows = [(i, " ".join(["w"] * (1 + i * 37 % 90)), "abc"[i % 3]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mixed = mixing.mix(docs, cells=16)
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") <= 1
    assert mixed.count() == 300


def test_a_round_of_the_mix_stores_three_tables(spark, monkeypatch):
    """Every job costs the driver buffers and threads: a round stores its turn, its cut cells and its end, and asks nothing more."""
    names, asked = [], []
    frame = type(spark.range(1))
    store, empty = mixing.stored, frame.isEmpty
    monkeypatch.setattr(mixing, "stored", lambda df, name: names.append(name) or store(df, name))
    monkeypatch.setattr(frame, "isEmpty", lambda df: asked.append(1) or empty(df))
    rows = [(i, " ".join(["w"] * (1 + i * 37 % 90)), "abc"[i % 3]) for i in range(300)]
    mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), cells=16)
    rounds = names.count("mix_round")
    assert rounds > 1 and not asked
    assert sum(n in ("mix_words", "mix_turn", "mix_cut", "mix_round") for n in names) == 3 * rounds
