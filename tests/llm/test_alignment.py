"""Alignment of tokenizers against nested loops over bytes."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from tidemark.llm import alignment as al

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOC = "doc_id bigint, text string, lang string, n_a int, links string, best int, n_chars bigint"
TEXTS = [
    None, "", " ", "a", "  two  blanks ", "tab\there\r\n", "é😀 ﬁ  ü", "<|endoftext|> </s> <s>", "▁ low line", "日本語のテキスト" * 9, "x" * 500,
    "\u0001\u0002 \u0003", "The cat sat; the cat didn't sit.\n" * 40, " ".join(f"word{i % 97}é{i}" for i in range(6000)), "…" * 40, "  wide", " " * 300,
]


def sides():
    return al._tokenizers(A, B)


def brute(texts):
    """Per text the spans, links and groups, by comparing every pair of spans of a window; None where it has no tokens."""
    side_a, side_b = sides()
    out = []
    for text in texts:
        spans = []
        for side in (side_a, side_b):
            ids = side.encode([text])[0] if text else []
            raw = [side.vocabulary.flat[side.vocabulary.first[i] :][: side.vocabulary.length[i]].tobytes() for i in ids]
            ends = np.cumsum([len(x) for x in raw]).tolist()
            spans.append((ids, raw, [(e - len(x), e) for e, x in zip(ends, raw)]))
        want = f" {text}".encode()
        if not text or any(b"".join(raw) != want for _, raw, _ in spans):
            out.append(None)
            continue
        (a, _, sa), (b, _, sb) = spans
        both = sorted({e for _, e in sa} & {e for _, e in sb})
        owner = [{i for i, (s, e) in enumerate(side) for _ in range(e - s)} for side in (sa, sb)]
        assert [len(x) for x in owner] == [len(a), len(b)]
        byte_b = [j for j, (s, e) in enumerate(sb) for _ in range(e - s)]
        links = sorted({(i, byte_b[k]) for i, (s, e) in enumerate(sa) for k in range(s, e)})
        groups, low = [], 0
        for end in both:
            groups.append(([i for i, (s, e) in enumerate(sa) if low < e <= end] if len(a) < 400 else None,
                           [j for j, (s, e) in enumerate(sb) if low < e <= end] if len(a) < 400 else None))
            low = end
        out.append((a, b, groups, links))
    return out


def expected(texts):
    found = brute(texts)
    count = Counter((x[0][i], x[1][j]) for x in found if x for i, j in x[3])
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    rows = []
    for x in found:
        if x is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = x
        ids = [(a[i], b[j]) for i, j in links]
        digest = None
        if len(a) < 400:
            line = ";".join(",".join(str(a[i]) for i in p) + "|" + ",".join(str(b[j]) for j in q) for p, q in groups)
            digest = hashlib.sha256(line.encode()).hexdigest()
        rows.append((len(a), len(b), len(groups), len(ids), sum(count[p] == top[p[1]] for p in ids), sum(count[p] for p in ids), digest))
    return rows


@given(st.lists(st.lists(st.integers(0, 6), max_size=4), max_size=7), st.integers(1, 5), st.integers(1, 9), st.randoms())
@settings(max_examples=150, deadline=None)
def test_row_products(rows, n_columns, chunk, random):
    left = np.array([[random.randint(0, 1) for _ in range(7)] for _ in rows]).reshape(len(rows), 7)
    right = np.array([[random.randint(0, 1) for _ in range(n_columns)] for _ in range(7)])

    def csr(m):
        return al.Incidence(np.concatenate([[0], np.cumsum(m.sum(axis=1))]).astype(int), np.nonzero(m)[1], m.shape[1])

    out = np.zeros((len(rows), n_columns), int)
    for row, column, value in al.row_products(csr(left), csr(right), chunk):
        assert (np.diff(row * n_columns + column) > 0).all()
        out[row, column] += value
    assert (out == left @ right).all()
    back = al.transposed(csr(right))
    assert (back.start == csr(right.T).start).all() and (back.column == csr(right.T).column).all()


@given(st.lists(st.integers(1, 4), min_size=1, max_size=30), st.randoms())
@settings(max_examples=80, deadline=None)
def test_links_and_groups(lengths, random):
    left, right = sum(lengths), []
    while left:
        right.append(random.randint(1, min(left, 5)))
        left -= right[-1]
    a, b, shared = al.overlap_links(np.array(lengths), np.array(right))
    ends = np.cumsum(lengths), np.cumsum(right)
    want = []
    for i, e in enumerate(ends[0]):
        for j, f in enumerate(ends[1]):
            over = min(e, f) - max(e - lengths[i], f - right[j])
            if over > 0:
                want.append((i, j, over))
    assert list(zip(a.tolist(), b.tolist(), shared.tolist())) == want
    ga, gb, n = al.groups_of(np.array(lengths), np.array(right))
    pairs = [(x, y) for x, y, _ in zip(*al._joined(al.group_links(ga, gb, n)))]
    assert pairs == [(i, j) for i in range(len(lengths)) for j in range(len(right)) if ga[i] == gb[j]]


@pytest.mark.parametrize("vector_pairs", [al.VECTOR_PAIRS, 0])
def test_align_corpus(spark, vector_pairs):
    texts = [*TEXTS, TEXTS[12], TEXTS[3]]
    rows = [(None if i == 5 else i // 2, t, None, 7, "x", None, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOC).repartition(3)
    out = al.align_corpus(docs, A, B, vector_pairs, slice_bytes=4000).collect()
    want = Counter((r[0], *w[:6]) for r, w in zip(rows, expected(texts)))
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) for r in out) == want
    digests = Counter(w[6] for w in expected(texts) if w[6] is not None)
    have = Counter(r.groups_sha256 for r in out)
    assert all(have[d] == n for d, n in digests.items())
    assert all((r.groups_sha256 == "") == (r.n_a == 0) for r in out)
    assert al.align_corpus(docs.limit(0), A, B, vector_pairs).collect() == []


SPACED = st.lists(st.sampled_from([" ", "  ", "\n", "\t", "\u00a0", "\u3000", "a", "B1", "don't", "é", "▁", ".", "<s>", "ing", "日"]), max_size=14)


@given(st.lists(SPACED, min_size=1, max_size=6))
@settings(max_examples=300, deadline=None)
def test_words_give_the_ids_of_whole_texts(parts):
    texts = [t for t in map("".join, parts) if t]
    for side in sides():
        flat, counts = side.ids(texts)
        want = side.encode(texts)
        assert counts.tolist() == list(map(len, want)) and flat.tolist() == [i for x in want for i in x]


def test_words_of_a_slice_are_parted_once_and_looked_up_once_each(monkeypatch):
    """The time of a slice goes with its distinct words, not with all of them, and both sides take the same words."""
    texts = ["the cat sat on the mat " * 200 + str(i % 3) for i in range(60)] + [" odd  one", "tab \tafter", "end "]
    fresh = al.ByteLevelTokenizer(A), al.PieceTokenizer(B)
    asked, cuts, cut = [], [], al.parted
    monkeypatch.setattr(al, "parted", lambda given: cuts.append(len(given)) or cut(given))
    for side in fresh:
        numbers = side.pool.numbers
        monkeypatch.setattr(side.pool, "numbers", lambda units, f=numbers: asked.append(list(units)) or f(units))
    whole, at = al.align([t.encode() for t in texts], *fresh)
    assert cuts == [len(texts)] and [sorted(x) for x in asked] == [sorted({"the", "cat", "sat", "on", "mat", "0", "1", "2"})] * 2
    assert at.tolist() == list(range(len(texts)))
    for ids, owner, side in ((whole.a_ids, whole.a_text, fresh[0]), (whole.b_ids, whole.b_text, fresh[1])):
        assert ids.tolist() == [i for x in side.encode(texts) for i in x]
        assert np.bincount(owner).tolist() == list(map(len, side.encode(texts)))


@given(st.lists(st.lists(st.integers(0, 123456), min_size=1, max_size=5), min_size=1, max_size=5), st.data())
@settings(max_examples=60, deadline=None)
def test_group_strings(groups, data):
    others = [data.draw(st.lists(st.integers(0, 123456), min_size=1, max_size=3)) for _ in groups]
    flat = lambda x: np.array([i for g in x for i in g], np.int64)
    group = lambda x: np.repeat(np.arange(len(x)), list(map(len, x)))
    first = np.array(sorted({0, data.draw(st.integers(0, len(groups) - 1))}))
    lines = al.group_strings(flat(groups), group(groups), flat(others), group(others), len(groups), first, 123457)
    each = [",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in zip(groups, others)]
    assert lines == [";".join(each[i:j]).encode() for i, j in zip(first, [*first[1:], len(each)])]


def test_query(spark, small):
    import __spark_entry__ as entry_point

    out = entry_point.queries()["op11_incidence_alignment"](spark, small)
    rows = {r.doc_id: r for r in out.collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(rows) == len(docs)
    short = [d for d in docs]
    for d, w in zip(short, expected([d.text for d in short])):
        r = rows[d.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == w[:6]
        assert w[6] is None or r.groups_sha256 == w[6]
        assert r.n_shared >= r.n_links and (r.overlap_bytes == len(f" {d.text}".encode()) or not r.n_a)
