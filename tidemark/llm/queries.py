"""One query per operator, over whole tables, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.bounds import stored

Query = Callable[[SparkSession, str], DataFrame]

_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


def registry() -> dict[str, Query]:
    return dict(_registry)


def oracle_sql() -> dict[str, str]:
    from tidemark.llm import oracle

    return dict(oracle.SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_merkle_fingerprints(spark, sf_dir):
    from tidemark.llm import fingerprints

    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


@query
def op2_pii_label_model(spark, sf_dir):
    from tidemark.llm import pii

    return pii.find(table(spark, sf_dir, "documents"))


@query
def op3_reply_tree_chat(spark, sf_dir):
    from tidemark.llm import chat

    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    # Stored once: the positions of turns are read by every join.
    formatted = chat.format_trees(stored(chat.as_tree(turns), "chat_turns"))
    least = F.when(F.col("tree") != -(2**63), F.col("tree"))
    return chat.digests(formatted).withColumn("conv_id", least).drop("tree")


@query
def op4_evidence_fusion(spark, sf_dir):
    from tidemark.llm import language

    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language.TextModel.fit(docs.select("lang", "text"))
    columns = ["lang", "confidence", "text_lang", "kept"]
    none = F.lit(None).cast("bigint")
    of_docs = language.identify_documents(docs, model).select(F.col("id").alias("doc_id"), none.alias("page_id"), *columns)
    of_pages = language.identify_pages(pages, model).select(none.alias("doc_id"), F.col("id").alias("page_id"), *columns)
    return of_docs.unionByName(of_pages)


@query
def op5_patched_blocks(spark, sf_dir):
    from public_tokenizers import path

    from tidemark.llm import token_blocks

    return token_blocks.token_files(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"))


@query
def op6_suffix_pieces(spark, sf_dir):
    from public_tokenizers import path

    from tidemark.llm import pieces

    return pieces.encode_and_read_back(table(spark, sf_dir, "documents"), path("piece_bpe_32k.model"))


@query
def op7_vertical_jaccard(spark, sf_dir):
    from tidemark.llm import jaccard

    return jaccard.link_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op8_isolation_rules(spark, sf_dir):
    from tidemark.llm import anomalies

    out = anomalies.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.select(*base, "score")


@query
def op9_exponential_mix(spark, sf_dir):
    from tidemark.llm import mixing

    quality = mixing.document_quality(table(spark, sf_dir, "labels"))
    mixed = mixing.mix(table(spark, sf_dir, "documents"), quality=quality)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op10_two_pass_shuffle(spark, sf_dir):
    from tidemark.llm import sharding

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.two_pass_shuffle(docs)
    text = F.coalesce("doc.text", F.lit(""))
    return out.select(
        "doc.doc_id",
        sharding.row_size("doc.text").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op11_incidence_alignment(spark, sf_dir):
    from public_tokenizers import path

    from tidemark.llm import alignment

    out = alignment.align_corpus(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
    return out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared", "overlap_bytes"
    )


@query
def op12_additive_quality(spark, sf_dir):
    from tidemark.llm import additive

    out = additive.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


@query
def op13_block_whitening(spark, sf_dir):
    from tidemark.llm import whitening

    return whitening.whiten(table(spark, sf_dir, "embeddings"))
