"""The ten operators against plain versions, laws and round trips, with the rows that break things."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from llm import brute
from tidemark.llm import anomalies, chat, fingerprints, jaccard, language, mixing, pieces, pii, sharding, token_blocks, units
from tidemark.plans.bounds import stored

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, size int, kept boolean"
LONG = " ".join(f"word{i % 997} é{i}" for i in range(30_000))
ODD_TEXTS = [None, "", " ", "\n\n", "a", "x" * 3000, "é😀 ﬁ  ü", "  two  blanks ", "tab\there\r\n", LONG, "\u0001\u0002 \u0003", "</s>[INST] a"]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Nulls in every column, repeated rows, ties, empty and very long texts, and columns with clashing names."""
    rows = [(i, t, random.Random(i).choice(["en", "fr", None]), None if i % 3 else "s", None, "r", i, None) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "same id, other text", "en", None, 5, None, None, True), (None, "no id " * 30, None, "s", 6, None, None, None)]
    rows += [rows[4], rows[4], rows[9]]
    path = str(tmp_path_factory.mktemp("odd") / "documents")
    spark.createDataFrame(rows, DOC).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def key(x):
    return tuple((v is None, v) for v in x)


# -- fingerprints -----------------------------------------------------------------------------


def test_fingerprint_edits(spark, odd, empty):
    assert fingerprints.fingerprint_edits(empty).collect() == []
    for block in (2, 1000):
        rows = fingerprints.fingerprint_edits(odd, block).collect()
        assert len(rows) == odd.count()
        whole = texts_of(odd)
        ids = sorted({i if i is not None else fingerprints.NO_ID for i, _ in whole}, reverse=True)
        for r in rows:
            at = ids.index(r["doc_id"] if r["doc_id"] is not None else fingerprints.NO_ID)
            after = ids[(at + 1) % len(ids)]
            nexts = {t or "" for i, t in whole if (i if i is not None else fingerprints.NO_ID) == after}
            own = {t or "" for i, t in whole if i == r["doc_id"] and len(t or "") == r["n_chars"]}
            want = {hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest() for t in own for n in nexts}
            assert r["edited_sha256"] in want
            assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
            assert (r["near_edited"] == 1) == (r["fingerprint"] == r["edited_fingerprint"])


def test_fingerprints_tell_texts_apart_and_locate_edits(spark):
    base = [f"line {i} " + "abc " * 30 for i in range(9)]
    edited = base[:4] + ["changed"] + base[5:]
    text = lambda ls: "\n".join(ls[:3]) + "\n\n" + "\n".join(ls[3:])
    rows = [(text(base), text(edited)), (text(base), text(base)), ("a\nb", "a\n\nb"), ("", "\n"), ("ab", "ab ")]
    df = spark.createDataFrame(rows, "a string, b string").select(
        *(fingerprints.fingerprint(F.col(c)).alias(c) for c in "ab")
    )
    pair = (F.col("a"), F.col("b"))
    got = df.select(fingerprints.likeness(*pair).alias("x"), fingerprints.first_difference(*pair).alias("at")).collect()
    assert 0.7 < got[0]["x"] < 1 and tuple(got[0]["at"]) == (1, 1)
    assert got[1]["x"] == 1 and got[1]["at"] is None
    assert all(r["x"] < 1 and r["at"] is not None for r in got[2:])


# -- personal data ----------------------------------------------------------------------------

PRIVATE = [
    "a.b@c.d_e@f.g x@y", "@a.b c@@d.e f@g..h", "1.2.3.4.5.6.7.8 256.1.1.1 01.02.03.255", "4111 1111-1111 1111 4111  1111",
    "+1 (784) 555-9263 4111111111111111", "+12 3456789", "+" * 50 + "1 2", "é😀 mail bosbt.42@mail8.example.com, 42.144.35.254.",
    "a@b." + "c." * 3000 + "d", "1 " * 6000, "x" * 20_000, "1." * 5000, "password=7602ad27cf5550de1c page 12 No. 5",
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "\u00014\u0002@a.b",
]


def test_private_spans(spark, odd, empty):
    assert pii.find(empty).collect() == []
    rng = random.Random(3)
    noise = ["".join(rng.choice("a1.@+- ()4é\n") for _ in range(60)) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate([*ODD_TEXTS, *PRIVATE, *noise])]
    found = pii.find(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert len(found) == len(rows)
    for r in found:
        text = dict(rows)[r["doc_id"]]
        want = brute.private(text)
        assert r["base_sha256"] == brute.private_digest(text), text
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(x[0] == k for x in want) for k in pii.BASE]
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        assert [(k, int(a), int(b)) for k, a, b in spans if k != pii.ADDED] == want
        for _, a, b in (s for s in spans if s[0] == pii.ADDED):
            assert all(int(b) <= x[1] or int(a) >= x[2] for x in want)
    assert pii.find(odd).count() == odd.count()


def test_labelers_are_weighed_and_secrets_found(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    hits = []
    for r in pii.find(docs).collect():
        for s in r["spans"].split(","):
            if s.startswith(pii.ADDED):
                _, a, b = s.split(":")
                hits.append(texts[r["doc_id"]][max(0, int(a) - 12) : int(b)])
    assert sum("token" in h for h in hits) >= 5
    # What is added looks like a key or a long number, never a plain word.
    assert all(sum(c.isdigit() for c in h[12:]) >= 2 for h in hits)


def test_reliabilities_against_brute_force(spark):
    rng = np.random.default_rng(11)
    # Three good labelers, one that guesses, one that mostly abstains.
    truth = rng.random(4000) < 0.3
    wrong, silent = (0.1, 0.15, 0.2, 0.5, 0.1), (0.1, 0.1, 0.3, 0.1, 0.9)
    cast = np.array([np.where(rng.random(4000) < q, 0, np.where(rng.random(4000) < w, 1 - 2 * truth, 2 * truth - 1)) for w, q in zip(wrong, silent)]).T
    votes, n = np.unique(cast, axis=0, return_counts=True)
    rows = [(*map(int, v), int(c)) for v, c in zip(votes, n)]
    patterns = spark.createDataFrame(rows, [*pii.LABELERS, "n"])
    prior, says = pii.reliabilities(patterns)
    want = brute.reliabilities([dict(zip([*pii.LABELERS, "n"], r)) for r in rows], pii.LABELERS, pii.TOLERANCE)
    assert prior == pytest.approx(want[0], abs=1e-9) and abs(prior - 0.3) < 0.03
    for name in pii.LABELERS:
        for vote in (1, 0, -1):
            assert says[name][vote] == pytest.approx(want[1][name][vote], abs=1e-9)
    odds = [says[name][1][0] / says[name][1][1] for name in pii.LABELERS]
    assert min(odds[:3]) > 2 > max(odds[3], 1 / odds[3])
    assert pii.reliabilities(patterns.limit(0)) is None


def test_recall_of_added_spans(spark, medium):
    """Planted by kind: every kind is found whole in nine of ten cases, ordinary numbers are left alone."""
    rng = np.random.default_rng(7)
    draw = lambda letters, n: "".join(rng.choice(list(letters), n))
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    planted = {}
    for i in range(30):
        for k, (shape, hit) in enumerate({
            "the token = {} was set": draw("0123456789abcdef", 32), "use apikey: {} there": draw(letters + "0123456789", 24) + "7",
            "my account number {} is new": draw("123456789", 11), f"see page {i + 1} of chapter {i % 9 + 1} from 19{i + 10}": "",
        }.items()):
            planted[10_000_000 + 10 * i + k] = (k, shape.format(hit), hit)
    docs = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text")
    both = docs.unionByName(spark.createDataFrame([(i, text) for i, (_, text, _) in planted.items()], docs.schema))
    right = [0] * 4
    for r in pii.find(both).where("doc_id >= 10000000").collect():
        kind, text, hit = planted[r["doc_id"]]
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        assert r["n_spans"] == len(spans)
        right[kind] += [text[int(a) : int(b)] for _, a, b in spans] == ([hit] if hit else [])
    assert min(right) >= 27


def test_redaction(spark, odd):
    out = pii.redact(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    rows = [(0, PRIVATE[7]), (1, PRIVATE[4]), (2, "clean \u0001 text 12"), (3, None)]
    got = {r["doc_id"]: r["text"] for r in pii.redact(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[0] == "é😀 mail [EMAIL], [IP]." and got[2] == rows[2][1] and got[3] is None
    assert not any(brute.private(t) for t in got.values())


# -- chat -------------------------------------------------------------------------------------


def test_template_is_reversible():
    rng = random.Random(1)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ANS]", "[ROLE=", "[/ROLE]", "\\", " ", "<", "[", "x", "\n", "😀", "]"]
    for _ in range(400):
        turns = [(rng.choice(["user", "system", "assistant", "to\"]ol", None, ""]), "".join(rng.choices(bits, k=rng.randrange(9)))) for _ in range(rng.randrange(5))]
        text, loss = chat.render(turns)
        assert chat.parse(text) == turns
        assert [chat.unescape(text[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant"]


def test_best_branches_of_trees(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for tree in range(30):
        n = rng.randrange(1, 25)
        parent = {i: rng.choice([None, 99, *range(i)]) if i else None for i in range(n)}
        if tree == 5 and n > 3:
            parent[1], parent[2] = 2, 1
        score = {i: rng.choice([0.0, 1.0, 2.0]) for i in range(n)}
        rows += [(tree, i, parent[i], score[i], rng.choice(["user", "assistant"]), f"{tree}/{i}") for i in range(n)]
        want[tree] = brute.best_path(set(range(n)), parent, score)
    rows += [(77, i, i - 1, None, "user", f"77/{i}") for i in range(70)] + [(None, 1, None, 0.0, "user", "lost"), (78, 1, 2, 0.0, "user", "a"), (78, 2, 1, 0.0, "user", "b")]
    want[77] = list(range(70))
    kind = "tree bigint, node bigint, parent bigint, score double, role string, text string"
    df = spark.createDataFrame(rows + rows[:5], kind)
    got = {r["tree"]: [int(t.split("/")[1]) for _, t in chat.parse(r["formatted"])] for r in chat.format_trees(df).collect()}
    assert got == {k: v for k, v in want.items() if v}
    two = chat.format_trees(df, top=2)
    assert two.groupBy("tree").count().agg(F.max("count")).first()[0] == 2
    assert chat.format_trees(spark.createDataFrame([], kind)).collect() == []


def test_linear_conversations_keep_ties_and_nulls(spark):
    kind = "conv_id bigint, turn bigint, role string, text string"
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, 2, None, "x"), (1, None, "system", "s"), (None, 0, "assistant", ""), (2, 5, "assistant", "</s>")]
    got = {r["tree"]: r for r in chat.digests(chat.format_trees(chat.as_tree(spark.createDataFrame(rows, kind)))).collect()}
    assert {k: r["n_turns"] for k, r in got.items()} == {1: 4, -(2**63): 1, 2: 1}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"system\ns\nuser\n\nuser\n\n\nx\n").hexdigest()
    assert (got[2]["loss_chars"], got[2]["loss_sha256"]) == (4, hashlib.sha256(b"</s>").hexdigest())


# -- language ---------------------------------------------------------------------------------


def test_language_of_held_out_texts(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    model = language.TextModel.fit(docs.where("doc_id % 2 = 0"))
    held = docs.where("doc_id % 2 = 1")
    found = {r["id"]: r for r in language.identify_documents(held.withColumn("lang", F.lit(None).cast("string")), model).collect()}
    truth = {r["doc_id"]: r["lang"] for r in held.collect()}
    assert sum(found[i]["lang"] == truth[i] for i in truth) >= 0.99 * len(truth)
    assert sum(r["kept"] for r in found.values()) >= 0.99 * len(truth)


def test_evidence_moves_short_texts(spark):
    rng = random.Random(2)
    say = lambda bits: " ".join(rng.choice(bits) for _ in range(60))
    known = [(say(["the", "and", "with", "which"]), "en") for _ in range(30)] + [(say(["und", "der", "nicht", "mit"]), "de") for _ in range(30)]
    model = language.TextModel.fit(spark.createDataFrame(known, "text string, lang string"))
    pages = [(i, f"http://a.site{i % 5}.de/x", f'<html lang="de"><p>{known[30 + i][0]}</p><script>the and</script>') for i in range(30)]
    pages += [(100 + i, "http://b.one.com/", f"<p>{known[i][0]}") for i in range(30)]
    pages += [(200, "http://a.site1.de/y", '<html lang="de"><p>the mit'), (201, "http://b.one.com/", "<p>the mit"), (202, None, None), (203, "http://[", "<p>123 ???"), (200, "http://a.site1.de/y", '<html lang="de"><p>the mit')]
    got = {r["id"]: r for r in language.identify_pages(spark.createDataFrame(pages, "page_id bigint, url string, html string"), model).collect()}
    assert got[200]["lang"] == "de" and got[201]["lang"] == "en"
    assert all(got[i]["lang"] == "de" for i in range(30)) and all(got[100 + i]["lang"] == "en" for i in range(30))
    assert not got[202]["kept"] and not got[203]["kept"]
    assert language.visible_text("a<script>x<b></script>b<style>c</style><!-- d -->e") == "a b  e"


def test_language_tags_are_their_primary_language(spark, monkeypatch):
    rng = random.Random(5)
    say = lambda bits, n=60: " ".join(rng.choice(bits) for _ in range(n))
    en, pt = ["the", "and", "with", "which"], ["não", "uma", "com", "você"]
    tags = {"en": ["en", "EN", "en-US", "en_GB"], "pt": ["pt-BR", "PT", "pt", " pt_PT"]}
    rows = [(i, say({"en": en, "pt": pt}[k]), tags[k][i % 4], "s") for i in range(80) for k in [("en", "pt")[i // 40]]]
    rows += [(100, "uma com", "pt-BR", "s"), (101, "com", "pt-BR", "s"), (102, "the", "en-US", "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    assert language.TextModel.fit(docs).languages == ["en", "pt"]
    got = {r["id"]: r for r in language.identify_documents(docs).collect()}
    assert all(r["kept"] for r in got.values())
    assert all(got[i]["lang"] == k for i, k in [*((i, ("en", "pt")[i // 40]) for i in range(80)), (100, "pt"), (101, "pt"), (102, "en")])
    monkeypatch.setattr(language, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError):
        language.TextModel.fit(docs)


def test_language_edges(spark, odd, empty):
    assert language.identify_documents(empty).collect() == []
    out = language.identify_documents(odd).collect()
    assert len(out) == odd.count()
    assert all(not r["kept"] for r in out if r["id"] in (0, 1, 2, 3) and r["n"] == 0)


# -- token files ------------------------------------------------------------------------------


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    for ids in ([5], [0] * 4096, rng.integers(0, 49_408, 4096), [2**32 - 1, 0, 7], [1] * 100 + [2**31] * 3, rng.integers(0, 3, 4095)):
        ids = np.array(ids, np.uint32)
        assert (token_blocks.unpack_block(b"xx" + token_blocks.pack_block(ids), 2) == ids).all()


def test_random_access(tmp_path):
    ids = np.random.default_rng(1).integers(0, 50_000, 20_001).astype(np.uint32)
    with open(tmp_path / "f", "wb") as sink:
        out = token_blocks.BlockFile(sink)
        for part in np.array_split(ids, 7):
            out.write(part)
        out.close()
    data = (tmp_path / "f").read_bytes()
    assert len(token_blocks.block_starts(data)) == 5
    for a, b in ((0, 20_001), (4095, 4097), (8192, 8192), (20_000, 20_001)):
        assert (token_blocks.read_ids(data, a, b) == ids[a:b]).all()


@pytest.mark.parametrize("file_ids", [1000, 8_000_000])
def test_token_files(odd, empty, file_ids):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    known = Tokenizer.from_file(path)
    rows = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_blocks.token_files(odd, path, file_ids=file_ids).collect()]
    rows.sort(key=lambda r: r[1])
    assert [key(r[:1])[0][1] or -1 for r in rows] == sorted(key(r[:1])[0][1] or -1 for r in rows)
    want = sorted((i, len(x) + 1, zlib.crc32(np.array([*x, 2], "<u4"))) for i, t in texts_of(odd) for x in [known.encode(t or "", add_special_tokens=False).ids] if i is not None)
    assert sorted((i, n, c) for i, _, n, c in rows if i is not None) == want
    assert [r[1] for r in rows] == np.cumsum([0, *(r[2] for r in rows)])[:-1].tolist()
    assert token_blocks.token_files(empty, path).collect() == []


def test_words_encode_as_whole_texts_do():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [t or "" for t in ODD_TEXTS] + ["it's 'S don''t x-'s 12ab ÉÀß×é <|endoftext|>x ΣΑΣ İx é ½ ª ´t'RE 'LL", "a​ 你好 😀!? \x1c y z"]
    ids, n = token_blocks.word_encoder(path)([token_blocks._units(t) for t in texts])
    whole = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == [i for x in whole for i in x] and n.tolist() == list(map(len, whole))


def test_words_parted_together():
    texts = [None, "", " ", "a b", " c\n\nd\t", "x", "y z é\rü\x0bw", "\n", "a  a", None]
    for kind in (pa.string(), pa.large_string()):
        for first in range(len(texts) + 1):
            words, n = units.parted(pa.array(texts, kind).slice(first))
            want = [[u for u in token_blocks._units(t) if u] for t in texts[first:]]
            assert words.to_pylist() == [u for x in want for u in x] and n.tolist() == [len(x) for x in want]


def test_words_of_many_texts_are_looked_up_once():
    class Counted(dict):
        asked = 0

        def get(self, *given):
            Counted.asked += 1
            return super().get(*given)

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["it's 12ab, Éa x-y\n<|endoftext|>z Σ ", None, *["the same few words, it's 12ab"] * 500, "w" * 60]
    pool = token_blocks.word_encoder(path)
    want = token_blocks.word_encoder(path)([token_blocks._units(t) for t in texts])
    pool.at = Counted()
    for _ in range(2):
        ids, n = pool.of_words(*units.parted(pa.array(texts)))
        assert ids.tolist() == want[0].tolist() and n.tolist() == want[1].tolist()
    assert Counted.asked == 2 * len({u for t in texts for u in token_blocks._units(t) if u})


# -- pieces -----------------------------------------------------------------------------------


def test_pieces_are_those_of_the_library(spark, small, odd, empty):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for df in (docs, odd):
        out = pieces.decode(pieces.encode(df, path), path).collect()
        assert len(out) == df.count()
        have = sorted((key((r["doc_id"],)), r["ids"], r["decoded"]) for r in out)
        want = sorted((key((i,)), library.encode(t or ""), (t or "").replace("▁", " ")) for i, t in texts_of(df))
        assert have == want
    assert pieces.decode(pieces.encode(empty, path), path).collect() == []


def test_long_and_short_relaxing_agree_and_whole_texts_too():
    path = public_tokenizers.path("piece_bpe_32k.model")
    codec = pieces.Codec(path)
    rng = random.Random(6)
    texts = ["".join(rng.choice("the oingr é\nx") for _ in range(120)) for _ in range(60)]
    a, n = codec.encode(texts)
    codec.v.cuts_at_blanks = False
    codec.pool.clear()
    b, m = codec.encode(texts)
    assert a.tolist() == b.tolist() and n.tolist() == m.tolist()
    old, pieces.LONG_UNIT = pieces.LONG_UNIT, 10
    codec.pool.clear()
    c, _ = codec.encode(texts)
    pieces.LONG_UNIT = old
    assert a.tolist() == c.tolist()


# -- Jaccard join -----------------------------------------------------------------------------


def _near(rng, vocabulary, n):
    base = [rng.choice(vocabulary) for _ in range(n)]
    out = []
    for _ in range(rng.randrange(2, 14)):
        w = list(base)
        for _ in range(rng.randrange(0, max(2, n // 25))):
            w[rng.randrange(n)] = rng.choice(vocabulary)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, k, percent):
    rng = random.Random(k)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts = [t for n in (3, 4, 8, 9, 12, 20, 21, 40, 90, 200, 400) for t in _near(rng, vocabulary, n)]
    texts += [shared + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 90))) for _ in range(40)]
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, "One two"), (903, "one TWO"), (5, texts[5]), (5, "other text"), (None, texts[7])]
    rows += [(904, "É b c d e f"), (905, "é b c d e f")]
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 4)
    got = jaccard.link_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), k, percent).collect()
    assert sorted(key((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == sorted(map(key, brute.groups(rows, k, percent)))
    # One row of every group is kept.
    assert sum(r["keep"] for r in got) == brute.groups(rows, k, percent, count=True)


def test_jaccard_edges(spark, odd, empty):
    assert jaccard.link_groups(empty).collect() == []
    got = jaccard.link_groups(odd, extra=("row", "size")).collect()
    assert sorted(key((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == sorted(map(key, brute.groups(texts_of(odd))))
    # The caller's columns come back as they are, whatever their names.
    assert sorted(key((r["row"], r["size"])) for r in got) == sorted(key((r["row"], r["size"])) for r in odd.collect())
    clash = odd.select("doc_id", "text", F.col("size").alias("n"), F.lit("k").alias("key"), F.lit(1).alias("parts"))
    assert {r["key"] for r in jaccard.link_groups(clash, extra=("n", "key", "parts")).collect()} == {"k"}


@pytest.mark.parametrize("same", [None, 7])
def test_texts_of_one_id_are_not_crossed(spark, monkeypatch, same):
    """Many near copies without an id of their own: every row's text is described once more, not once for every row."""
    rng = random.Random(8)
    texts = [t for _ in range(12) for t in _near(rng, [f"w{i}" for i in range(400)], 60)]
    rows = [(same, t) for t in texts]
    seen, plain = [], jaccard._compared

    def counted(members, sets, percent):
        seen.append((sets.count(), sets.select("row").distinct().count()))
        return plain(members, sets, percent)

    monkeypatch.setattr(jaccard, "_compared", counted)
    got = jaccard.link_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(key((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == sorted(map(key, brute.groups(rows)))
    assert sum(r["keep"] for r in got) == brute.groups(rows, count=True)
    assert seen[0][0] == seen[0][1] and 2 <= seen[0][0] <= len(rows)


def test_packed_signatures_meet(spark, monkeypatch):
    """Every bucket count, frequent fragments on a path of their own or not: the nodes that meet are those of all pairs."""
    rng = random.Random(3)
    texts = [t for _ in range(20) for t in _near(rng, [f"w{i}" for i in range(300)], 50)] + ["tiny text"] * 3 + ["", None]
    docs = spark.createDataFrame([(t,) for t in texts], "_text string").repartition(5)
    pairs = set()
    for t in texts:
        sign, node = jaccard._signed([(t or "").encode()], 3, jaccard.Levels(90), jaccard.NODE_SHIFT)
        pairs |= set(zip(sign.tolist(), node.tolist()))
    by_sign = {}
    for sign, node in pairs:
        by_sign.setdefault(sign, set()).add(node)
    want = sorted((node, len(nodes)) for nodes in by_sign.values() if len(nodes) > 1 for node in nodes)
    for hot in (None, 4):
        if hot:
            monkeypatch.setattr(jaccard, "HOT_ROWS", hot)
            monkeypatch.setattr(jaccard, "HOT_SAMPLE", 1)
            assert len(jaccard._frequent(docs, 3, 90, 10**4)) > 0
        for signs in (1, 10**8 // 2):
            monkeypatch.setattr(jaccard, "BUCKET_SIGNS", 10**7)
            met = jaccard._met(docs, 3, 90, signs if hot is None else 10**4)
            assert sorted((r["row"], r["c"]) for r in met.collect()) == want
            # Nodes that meet in the same fragment have the same joint digest.
            assert met.groupBy("g").agg(F.count_distinct("c").alias("n")).where("n > 1").count() == 0


def test_sets_of_one_node_are_compared(spark, monkeypatch):
    """Digests that agree in what stands for a set: nothing is lost, and nothing linked by it."""
    rng = random.Random(5)
    rows = list(enumerate(t for n in (10, 30, 60) for t in _near(rng, [f"w{i}" for i in range(200)], n)))
    rows = [(i, t) for i, t in rows] + [(100 + i, t + " more") for i, t in rows]
    for shift in (61, 63):
        monkeypatch.setattr(jaccard, "NODE_SHIFT", shift)
        got = jaccard.link_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 90).collect()
        assert sorted(key((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == sorted(map(key, brute.groups(rows, 3, 90)))


def _thue_morse(n):
    return "".join("ab"[i.bit_count() % 2] for i in range(n)), "".join("ba"[i.bit_count() % 2] for i in range(n))


def test_long_words_that_sums_of_powers_confuse(spark):
    """Words whose bytes give one sum at any step, alone, in a shingle twice, and between equal words."""
    rows = []
    for n in (63, 64, 65, 128, 1024, 2048, 4096):
        x, y = _thue_morse(n)
        line = " ".join(f"w{n}x{i}" for i in range(5))
        for text in (x, y, f"{line} {x} {line}", f"{line} {y} {line}", f"one {x} two {y}", f"one {x} two {x}", f"{x} {y} {x} {y} {x}", f"{x[:-1]} {y[:-1]} a b"):
            rows.append((len(rows), text))
    got = jaccard.link_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(key((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == sorted(map(key, brute.groups(rows)))
    for n in (1024, 4096):
        x, y = _thue_morse(n)
        assert len(set(units.Words([f"{x} {y} {x}a {y}a a{x} a{y}".encode()]).hashes().tolist())) == 6


@pytest.mark.parametrize("rows_of_block", [3, 512])
def test_only_rows_that_share_enough_go_on_from_mixed_groups(spark, monkeypatch, rows_of_block):
    """Every pair of two families that shares three fragments meets, and no row without such a partner is copied."""
    rng = random.Random(9)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", rows_of_block)
    family = {row: rng.randrange(40) for row in range(300)}
    groups = {g: (rng.randrange(1, 3), rng.sample(sorted(family), rng.choice([3, 8, 20]))) for g in range(30)}
    groups |= {100 + g: (rng.randrange(1, 4), rng.sample(groups[g][1], 2)) for g in range(30)}
    frame = spark.createDataFrame([(g, len(m), r, w) for g, (w, m) in groups.items() for r in m], "g bigint, c bigint, row bigint, weight bigint")
    got = jaccard._mixed(frame, spark.createDataFrame(list(family.items()), "row bigint, family bigint")).collect()
    shared = {}
    for weight, members in groups.values():
        for a, b in itertools.permutations(members, 2):
            if family[a] != family[b]:
                shared[a, b] = shared.get((a, b), 0) + weight
    near = {pair for pair, n in shared.items() if n >= jaccard.SHARED}
    together = {}
    for r in got:
        together.setdefault(r["key"], set()).add(r["row"])
    met = {(a, b) for rows in together.values() for a, b in itertools.permutations(rows, 2)}
    assert near and near <= met
    assert all(any((a, b) in near for b in rows) for rows in together.values() for a in rows)
    # A pair is compared in one place.
    assert len(got) == len({tuple(r) for r in got}) <= len(near) < sum(len(m) for _, m in groups.values()) / 2


def test_sets_move_to_their_blocks_once(spark, monkeypatch):
    rng = random.Random(12)
    rows = list(enumerate(t for _ in range(8) for t in _near(rng, [f"w{i}" for i in range(300)], 50)))
    plans, plain = {}, jaccard.stored

    def kept(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return plain(df, name)

    monkeypatch.setattr(jaccard, "stored", kept)
    assert jaccard.link_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).count() == len(rows)
    # Described, and compared, by one step each; by address and to the blocks, and not stored between.
    assert plans["jaccard_links"].count("MapInArrow") == 2 and plans["jaccard_links"].count("REPARTITION_BY_COL") == 1
    assert "jaccard_sets" not in plans


def test_overlaps_in_fragments():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, 80)).astype(np.uint64) for _ in range(20)]
    want = [[len(np.intersect1d(a, b)) if a is not b else 0 for b in sets] for a in sets]
    for columns in (7, 4096):
        got = jaccard.overlaps(sets, columns)
        np.fill_diagonal(got, 0)
        assert got.astype(int).tolist() == want


# -- quality ----------------------------------------------------------------------------------


def test_rule_statistics(spark, small, odd, empty):
    for df in (spark.read.parquet(f"{small}/documents.parquet"), odd):
        labels = spark.createDataFrame([(1, 1, 0), (1, None, 0), (None, 1, 0), (9, 1, 0)], "doc_id bigint, quality int, toxic int")
        got = anomalies.judge(df, labels).collect()
        names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        assert sorted(key([r[c] for c in names]) for r in got) == sorted(key((i, *brute.rule_stats(t))) for i, t in texts_of(df))
        assert not any(r["kept"] and r["base_failed"] for r in got)
    assert anomalies.judge(empty, labels).collect() == []


def test_forest_on_held_out_labels(spark, medium):
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    fit, held = labels.where("doc_id % 2 = 0"), {r["doc_id"]: r["quality"] for r in labels.where("doc_id % 2 = 1").collect()}
    judged = {r["doc_id"]: r for r in anomalies.judge(docs, fit).collect()}
    good = [i for i, q in held.items() if q == 1 and not judged[i]["base_failed"]]
    # Bad rows that the base rule lets through: the forest alone decides on them.
    bad = [i for i, q in held.items() if q == 0 and not judged[i]["base_failed"]]
    assert len(bad) >= 10
    assert sum(judged[i]["kept"] for i in good) >= 0.99 * len(good)
    assert sum(not judged[i]["kept"] for i in bad) >= 0.9 * len(bad)


def test_repeated_rows_do_not_change_the_forest(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    once = {r["doc_id"]: (r["score"], r["kept"]) for r in anomalies.judge(docs, labels, fit_rows=40).collect()}
    thrice = anomalies.judge(docs.unionAll(docs).unionAll(docs), labels.unionAll(labels), fit_rows=40).collect()
    assert len(thrice) == 3 * len(once) and all(once[r["doc_id"]] == (r["score"], r["kept"]) for r in thrice)


def test_path_lengths_against_a_walk():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 4))
    forest = anomalies.grow_forest(x, trees=9, sample=64)
    probe = np.vstack([x[:40], 10 * rng.normal(size=(20, 4))])
    for row, got in zip(probe, anomalies.scores(probe, forest, 64)):
        lengths = []
        for feature, split, left, right, path, _ in forest:
            at = 0
            while feature[at] >= 0:
                at = left[at] if row[feature[at]] <= split[at] else right[at]
            lengths.append(path[at])
        assert got == pytest.approx(2 ** (-np.mean(lengths) / anomalies.average_path(64)))


def test_forest_sets_odd_rows_apart():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(500, 3)), [[8, 8, 8]]])
    s = anomalies.scores(x, anomalies.grow_forest(x[:500]))
    assert s.argmax() == 500 and s[500] > 0.6 > np.median(s)


def test_bad_labels_move_the_threshold():
    good = [(c, 100, 0) for c in range(1, 11)]
    # Without bad rows: the lowest threshold that loses at most the share.
    assert anomalies.calibrated(good, 0.2) == 8
    # Good rows are not lost where no bad one is set apart.
    assert anomalies.calibrated(good[:9] + [(10, 100, 5)], 0.2) == 9
    assert anomalies.calibrated([(1, 100, 5)] + good[1:], 0.2) == 10
    # Many bad rows under the share are worth good ones, few are not.
    assert anomalies.calibrated(good[:6] + [(7, 1, 5000), *good[7:8], (9, 100, 1), (10, 100, 1)], 0.25) == 6
    assert anomalies.calibrated(good[:6] + [(7, 100, 5), *good[7:8], (9, 100, 1), (10, 100, 1)], 0.2) == 8
    assert anomalies.calibrated([], 0.2) == anomalies.BINS


def test_posterior_against_brute_force(spark, small, odd):
    docs, pages = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "pages"))
    model = language.TextModel.fit(docs)
    declared = docs.withColumn("lang", F.when(F.col("doc_id") % 3 != 0, F.col("lang")))
    for evidence in (language.page_evidence(pages.limit(300), model), language.document_evidence(declared, model), language.document_evidence(odd, model)):
        evidence = stored(evidence, "language_test")
        rows = evidence.collect()
        want = brute.fused(rows, model.languages)
        got = language.fuse(evidence, model).collect()
        # Rows of one id may be repeated: they are compared in order of all they hold.
        sides = (
            sorted((key((r["id"], r["n"], r["host"])), w[1], w[0], w[2], w[3]) for r, w in zip(rows, want)),
            sorted((key((r["id"], r["n"], r["host"])), r["confidence"], r["lang"], r["text_lang"], r["kept"]) for r in got),
        )
        assert len(rows) > 3 and len(sides[0]) == len(sides[1])
        for w, g in zip(*sides):
            assert w[0] == g[0] and w[2:] == g[2:] and w[1] == pytest.approx(g[1], abs=1e-9)


def test_markup_is_read_by_attribute():
    read = language.markup_language
    assert read('<html data-lang="xx" lang="de">') == "de" and read("<HTML LANG=pt-BR>") == "pt" and read("<html xml:lang='fr'>") is None
    assert read('<html title="lang=xx" lang = "en_US">') == "en" and read("<html><p lang='de'>") is None and read("") is None
    assert read("<!-- <html lang='de'> --><html lang='fr'>") == "fr" and read("<html lang='english'>") is None
    assert read("<html lang='de") is None and read("<html lang>") is None
    assert language.visible_text("a<!-- b > c <p>d</p> -->e<p>f</p>").split() == ["a", "e", "f"]
    assert language.visible_text("a<!-- b").split() == ["a"]


# -- mixing -----------------------------------------------------------------------------------


def test_targets_fill_up_to_the_limit(spark):
    sizes = [("a", 1000, 1), ("b", 10, 1), ("c", 3, 1), ("d", 0, 1), ("ä", 400, 1), ("z", 5, 1), (None, 90, 1)]
    df = spark.createDataFrame(sizes, "source string, source_size bigint, n_docs bigint")
    got = {r["source"]: (r["weight"], r["target"]) for r in mixing.targets(mixing.ranked_sources(df, (5, 2, 1))).collect()}
    assert [got[s][0] for s in ("a", "b", "c", "d", "z", "ä", None)] == [5, 2, 1, 5, 2, 1, 5]
    assert sum(t for _, t in got.values()) == pytest.approx(1508)
    level = [t / w for s, (w, t) in got.items() if t < 3 * dict((x[0], x[1]) for x in sizes)[s] - 1e-9]
    assert max(level) == pytest.approx(min(level))
    assert all(t <= 3 * dict((x[0], x[1]) for x in sizes)[s] + 1e-9 for s, (_, t) in got.items())


def test_mix_meets_its_targets_and_repeats(spark, odd, empty, medium):
    assert mixing.mix(empty).collect() == []
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    runs = [sorted((r["doc_id"], r["taken"]) for r in mixing.mix(docs.repartition(n)).collect()) for n in (3, 7)]
    assert runs[0] == runs[1]
    for df in (docs, odd):
        rows = mixing.mix(df, cells=8).collect()
        assert len(rows) == df.count()
        for source in {r["source"] for r in rows}:
            own = [r for r in rows if r["source"] == source]
            assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own) / 2 + 1
            assert all(r["taken"] <= 3 * r["size"] for r in own)
    mixed = mixing.mix(docs)
    applied = mixing.apply_mix(docs, mixed)
    assert applied.columns == docs.columns
    assert applied.count() == mixed.agg(F.sum("times")).first()[0]


@pytest.mark.parametrize("cells", [1, 60])
def test_gaps_are_filled_in_key_order(spark, small, medium, cells):
    """No source misses its target by more than its smallest document left out; whatever the cells, the mix is one."""
    for sf in (small, medium):
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        quality = mixing.document_quality(spark.read.parquet(f"{sf}/labels.parquet"))
        rows = mixing.mix(docs, quality=quality, cells=cells).collect()
        for source in {r["source"] for r in rows}:
            own = [r for r in rows if r["source"] == source]
            epochs = int(own[0]["target"] // max(own[0]["source_size"], 1))
            left_out = [r["size"] for r in own if r["times"] == epochs and r["size"]]
            miss = abs(sum(r["taken"] for r in own) - own[0]["target"])
            assert miss < min(left_out, default=1)
        got = sorted((r["doc_id"], r["times"]) for r in rows)
        assert got == sorted((r["doc_id"], r["times"]) for r in mixing.mix(docs, quality=quality).collect())


def test_a_cell_is_gone_through_in_order():
    table = pa.table({"key": [3.0, 1.0, 2.0, 4.0], "doc_id": [None, 1, 2, 9], "size": [4, 50, 3, 1], "n": [3, 1, 2, 9], "start": [20] * 4})
    got = mixing._in_order(table).to_pydict()
    # 50 does not fit, two of 3, three of 4, then two of 1.
    assert got["m"] == [0, 2, 3, 2] and set(got["rest"]) == {0}


def test_better_documents_are_taken_first(spark):
    rows = [(i, "w " * 10, "a" if i < 400 else "b") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    quality = spark.range(800).selectExpr("id AS doc_id", "CASE WHEN id % 2 = 0 THEN 8.0D ELSE 0.5D END AS quality")
    got = mixing.mix(docs, quality=quality, weights=(1, 3)).where("source = 'a'").collect()
    taken = [sum(r["taken"] > 0 for r in got if r["doc_id"] % 2 == p) for p in (0, 1)]
    assert taken[0] > 3 * taken[1] > 0


def test_the_decided_mix_is_applied_row_by_row(spark, tmp_path):
    """Null and repeated ids of one size, of which the mix takes some: each row as often as it was decided."""
    rows = [(None, f"n{i} " + "w " * 9, "a") for i in range(60)] + [(7, f"r{i} " + "w " * 9, "a") for i in range(41)]
    rows += [(100 + i, "w " * 10, "b") for i in range(90)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    for by_text in (False, True):
        mixed = mixing.mix(docs, weights=(3, 5), by_text=by_text)
        decided = mixed.groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect()
        applied = {r["source"]: r["n"] for r in mixing.apply_mix(docs, mixed).groupBy("source").agg((10 * F.count(F.lit(1))).alias("n")).collect()}
        assert applied == {r["source"]: r["n"] for r in decided}
        assert all(abs(applied[r["source"]] - r["t"]) <= 5 for r in decided)
        assert 0 < mixed.where("source = 'a' AND times = 0").count() < 101
    # Which null ids are taken depends on their texts.
    few = mixing.mix(docs, weights=(1, 9), by_text=True).where("doc_id IS NULL AND source = 'a'")
    assert {r["times"] for r in few.select("times").distinct().collect()} == {0, 1}
    with pytest.raises(ValueError):
        mixing.apply_mix(docs.unionByName(docs), mixed)


# -- sharding ---------------------------------------------------------------------------------


@pytest.mark.parametrize("bucket_bytes", [200, 4 << 20])
def test_two_pass_shuffle(spark, odd, empty, small, bucket_bytes):
    assert sharding.two_pass_shuffle(empty).collect() == []
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for df in (docs, odd):
        out = sharding.two_pass_shuffle(df, bucket_bytes=bucket_bytes)
        assert sorted(map(str, (r["doc"] for r in out.collect()))) == sorted(map(str, df.collect()))
        shards = {}
        for r in out.collect():
            shards.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in shards.values())
        sizes = [len(shards.get(i, [])) for i in range(40)]
        assert max(sizes) - min(sizes) <= 1
    placed = sorted((r["shard"], r["slot"], r["doc"]["doc_id"]) for r in sharding.two_pass_shuffle(docs, bucket_bytes=bucket_bytes).collect())
    order = [x[2] for x in placed]
    assert np.corrcoef(order, range(len(order)))[0, 1] ** 2 < 0.1


# -- helpers ----------------------------------------------------------------------------------


def test_words_of_many_texts():
    texts = [(t or "").encode() for t in ODD_TEXTS]
    w = units.Words(texts)
    assert w.count.tolist() == [len(brute.words(t)) for t in ODD_TEXTS]
    names = [x for t in ODD_TEXTS for x in brute.words(t)]
    assert len(set(zip(names, w.hashes().tolist()))) == len(set(names)) == len(set(w.hashes().tolist()))


def test_slices_cover_everything():
    texts = [None, "a" * 10, "", "b" * 50, "c"]
    for limit in (1, 20, 1000):
        got = list(units.slices(texts, limit))
        assert [t for _, part in got for t in part] == [(t or "").encode() for t in texts]
        assert [s for s, _ in got] == np.cumsum([0, *(len(p) for _, p in got)])[:-1].tolist()
