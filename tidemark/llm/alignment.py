"""Alignment of two tokenizers over the bytes of a text, by products of sparse incidence matrices.

A token-byte incidence matrix has a row per token occurrence and a column per byte of the text. Both tokenizers' matrices
are built by hand in CSR form (row starts, columns). Gustavson's row products A·Bᵀ give the overlap links: an entry is a
pair of token occurrences, its value the bytes they share. Byte offsets where a token of each side ends cut a text into
groups; the token-group incidence matrices give the links of all pairs that share a group by the same product.

Tasks take texts in slices and keep, for every document, its distinct id pairs with their numbers. How many links of the
corpus hold an id pair is a grouped sum over these; the documents' shares in it are a product of the document-pair
matrix with that vector. The vector is given to all tasks when its measured size allows, else it is joined.

Nulls and edge cases: a null or empty text has no tokens; neither has one whose tokens, joined, are not a space and the
text (a normaliser changed it), so that byte ranges would not be comparable: figures are 0 and the digest is ''. A null
id stays; repeated rows and ids are documents of their own; strings of special tokens inside texts are plain text; a
document is aligned whole, in one task; an empty table gives an empty result; other columns are not read, so their names
may clash.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.units import IdPool, slices, strings
from tidemark.plans.bounds import stored

#: Id pairs (16 bytes each) that every task is given; more are joined instead.
VECTOR_PAIRS = 2_000_000
#: Products of one chunk of rows.
CHUNK = 1 << 20
#: Bytes of text that are aligned together.
SLICE = 1 << 20


class Incidence(NamedTuple):
    """Sparse 0/1 matrix in CSR form: the columns of row i are ``column[start[i]:start[i + 1]]``."""

    start: np.ndarray
    column: np.ndarray
    n_columns: int


def token_bytes_matrix(length: np.ndarray) -> Incidence:
    """Row i is a token that covers the ``length[i]`` bytes after those of the tokens before it."""
    start = np.concatenate([[0], np.cumsum(length)])
    return Incidence(start, np.arange(start[-1]), int(start[-1]))


def token_group_matrix(group: np.ndarray, n_groups: int) -> Incidence:
    """Row i is a token of group ``group[i]``."""
    return Incidence(np.arange(len(group) + 1), group, n_groups)


def transposed(m: Incidence) -> Incidence:
    """Columns become rows; the order of rows is kept inside every column."""
    row = np.repeat(np.arange(len(m.start) - 1), np.diff(m.start))
    start = np.concatenate([[0], np.cumsum(np.bincount(m.column, minlength=m.n_columns))])
    in_order = len(m.column) < 2 or bool((m.column[1:] >= m.column[:-1]).all())
    return Incidence(start, row if in_order else row[np.argsort(m.column, kind="stable")], len(m.start) - 1)


def row_products(a: Incidence, b: Incidence, chunk: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entries (row, column, value) of ``a @ b`` by Gustavson's method, in order, for runs of rows.

    A row of the result is the sum of the rows of ``b`` that the row of ``a`` has columns for. Runs end before they need
    more than ``chunk`` products, so a large result is never held whole.
    """
    per_entry = np.diff(b.start)[a.column]
    upto = np.concatenate([[0], np.cumsum(per_entry)])[a.start]
    n, low = len(a.start) - 1, 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(upto, upto[low] + chunk, "right")) - 1)
        entries = slice(a.start[low], a.start[high])
        times = per_entry[entries]
        total = int(times.sum())
        at = np.repeat(b.start[a.column[entries]] - (np.cumsum(times) - times), times) + np.arange(total)
        row = np.repeat(np.arange(low, high), upto[low + 1 : high + 1] - upto[low:high])
        key = row * b.n_columns + b.column[at]
        if (key[1:] < key[:-1]).any():
            key.sort()
        first = np.flatnonzero(np.concatenate([np.ones(min(1, total), bool), key[1:] != key[:-1]]))
        key, value = key[first], np.diff(np.append(first, total))
        row = key // max(b.n_columns, 1)
        yield row, key - row * b.n_columns, value
        low = high


def overlap_links(a_length: np.ndarray, b_length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, shared bytes) of all occurrences whose byte ranges overlap."""
    return _joined(row_products(token_bytes_matrix(a_length), transposed(token_bytes_matrix(b_length))))


def _joined(parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = list(parts) or [(np.zeros(0, np.int64),) * 3]
    return tuple(np.concatenate(x) for x in zip(*parts))


def groups_of(a_length: np.ndarray, b_length: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(group of every A token, of every B token, groups): byte offsets where tokens of both sides end cut the groups."""
    a_end, b_end = np.cumsum(a_length), np.cumsum(b_length)
    a_ends, b_ends = np.zeros((2, max(a_end[-1:].sum(), b_end[-1:].sum()) + 1), bool)
    a_ends[a_end], b_ends[b_end] = True, True
    a_cut, b_cut = b_ends[a_end], a_ends[b_end]
    return np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut, int(a_cut.sum())


def group_links(a_group: np.ndarray, b_group: np.ndarray, n_groups: int):
    """Runs of (A token, B token, 1) of all occurrences that share a group."""
    return row_products(token_group_matrix(a_group, n_groups), transposed(token_group_matrix(b_group, n_groups)))


class Vocabulary:
    """Bytes of every token id, for joining and measuring."""

    def __init__(self, tokens: list[bytes]):
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.spaced = np.array([t.startswith(b" ") for t in tokens])

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens, one after the other."""
        length = self.length[ids]
        total = int(length.sum())
        return self.flat[np.repeat(self.first[ids] - (np.cumsum(length) - length), length) + np.arange(total)]


def byte_level_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for every byte: itself where it prints, else one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Parted(NamedTuple):
    """Texts parted at every single space: the distinct words of ``plain`` texts, the words' numbers and how many each has.

    At a space that other white space follows, or that ends or begins a text, neither vocabulary parts alone: such
    texts are ``odd``, and their words are not among the others.
    """

    plain: np.ndarray
    odd: np.ndarray
    words: list[str]
    number: np.ndarray
    counts: np.ndarray


def parted(texts: list[str]) -> Parted:
    lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    coded = lists.flatten().dictionary_encode()
    words, number = strings(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False)
    counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    head = pc.utf8_slice_codeunits(coded.dictionary, 0, 1).dictionary_encode()
    strange = np.array([not c or c.isspace() for c in strings(head.dictionary)], bool)[head.indices.to_numpy(zero_copy_only=False)]
    is_odd = np.zeros(len(texts), bool)
    if strange.any():
        owner = np.repeat(np.arange(len(texts)), counts)
        is_odd[owner[strange[number]]] = True
        used, number = np.unique(number[~is_odd[owner]], return_inverse=True)
        words = [words[i] for i in used.tolist()]
    return Parted(np.flatnonzero(~is_odd), np.flatnonzero(is_odd), words, number, counts[~is_odd])


class Side:
    """A tokenizer that parts at every single space before a word, so that words are encoded once and looked up after."""

    vocabulary: Vocabulary

    def __init__(self):
        self.pool = IdPool(self._words)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words: many go to the tokenizer as one text, where a token that starts with a space starts a word."""
        runs = [" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)]
        flat, counts = _as_array(self.encode(runs))
        first = np.flatnonzero(self.vocabulary.spaced[flat])
        if len(first) != len(words) or "" in words or not np.isin(np.cumsum(counts) - counts, first).all():
            return _as_array(self.encode(words))
        return flat, np.diff(np.append(first, len(flat)))

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def ids(self, texts: list[str], at: Parted | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids of each), as ``encode`` gives them; texts with other spaces are encoded whole.

        ``at`` is what ``parted`` returns for them, where it is known: both sides part alike.
        """
        at = at or parted(texts)
        parts = [self.pool.of_coded(at.words, at.number, at.counts), _as_array(self.encode([texts[i] for i in at.odd.tolist()]))]
        if not len(at.odd):
            return parts[0][0].astype(np.int64), parts[0][1]
        length = np.zeros(len(texts), np.int64)
        length[at.plain], length[at.odd] = parts[0][1], parts[1][1]
        start = np.cumsum(length) - length
        out = np.zeros(int(length.sum()), np.int64)
        for rows, (flat, n) in zip((at.plain, at.odd), parts):
            out[np.repeat(start[rows] - (np.cumsum(n) - n), n) + np.arange(len(flat))] = flat
        return out, length


class ByteLevelTokenizer(Side):
    """Side A: ``tokenizers`` over a space and the text."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        alphabet, tokens = byte_level_alphabet(), [b""] * self.model.get_vocab_size()
        special = {t.content for t in self.model.get_added_tokens_decoder().values()}
        for token, i in self.model.get_vocab().items():
            tokens[i] = token.encode() if token in special else bytes(alphabet[c] for c in token)
        self.vocabulary = Vocabulary(tokens)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)]


class PieceTokenizer(Side):
    """Side B: ``sentencepiece``, which puts the space before the text itself."""

    def __init__(self, path: str):
        super().__init__()
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.vocabulary = Vocabulary([
            bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


_sides: dict[tuple[str, str], tuple[ByteLevelTokenizer, PieceTokenizer]] = {}


def _tokenizers(a: str, b: str) -> tuple[ByteLevelTokenizer, PieceTokenizer]:
    """The tokenizers of this worker."""
    if (a, b) not in _sides:
        _sides[a, b] = ByteLevelTokenizer(a), PieceTokenizer(b)
    return _sides[a, b]


def _as_array(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum()))
    return flat, counts


def _equal(tokens: list[bytes], want: list[bytes]) -> np.ndarray:
    return np.fromiter((t == w for t, w in zip(tokens, want)), bool, len(want))


def _cut(flat: np.ndarray, counts: np.ndarray) -> list[bytes]:
    raw, edge = flat.tobytes(), np.concatenate([[0], np.cumsum(counts)]).tolist()
    return [raw[edge[i] : edge[i + 1]] for i in range(len(counts))]


@lru_cache(4)
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of the numbers below ``n`` with room for a mark behind, and which of these bytes are written."""
    power = 10 ** np.arange(len(str(max(n - 1, 0))) - 1, -1, -1)
    number = np.arange(n)[:, None]
    written = number >= power
    written[:, -1] = True
    digits = (number // power % 10 + ord("0")).astype(np.uint8)
    return np.column_stack([digits, np.zeros(n, np.uint8)]), np.column_stack([written, np.ones(n, bool)])


def group_strings(a_ids, a_group, b_ids, b_group, n_groups: int, first_group: np.ndarray, n_ids: int) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of every document; ``first_group`` has the first group of each document.

    The ids of both sides, all below ``n_ids``, are brought into one order by counting, then written as digits, all at once.
    """
    a_of, b_of = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
    # A token comes after all of its side, and after those of the other side in earlier groups (B: and in its own).
    a_at = np.arange(len(a_ids)) + (np.cumsum(b_of) - b_of)[a_group]
    b_at = np.arange(len(b_ids)) + np.cumsum(a_of)[b_group]
    ids, mark = np.zeros(len(a_ids) + len(b_ids), np.int64), np.full(len(a_ids) + len(b_ids), ord(","), np.uint8)
    ids[a_at], ids[b_at] = a_ids, b_ids
    mark[a_at[np.cumsum(a_of) - 1]] = ord("|")
    mark[b_at[np.cumsum(b_of) - 1]] = ord(";")
    digits, written = _decimals(n_ids)
    cells, shown = digits[ids], written[ids]
    cells[:, -1] = mark
    width = np.concatenate([[0], np.cumsum(written.sum(axis=1)[ids])])
    raw = cells[shown].tobytes()
    upto = np.concatenate([[0], np.cumsum(a_of + b_of)])
    edge = width[upto[np.append(first_group, n_groups)]]
    # Without the mark after the last group.
    return [raw[edge[i] : max(edge[i], edge[i + 1] - 1)] for i in range(len(first_group))]


class Aligned(NamedTuple):
    """Texts that both tokenizers give back, one after the other."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    n_groups: int
    a_text: np.ndarray
    b_text: np.ndarray
    first_group: np.ndarray


def align(texts: list[bytes], side_a: ByteLevelTokenizer, side_b: PieceTokenizer) -> tuple[Aligned, np.ndarray]:
    """The alignment of those texts that can be aligned, and their places in ``texts``."""
    plain = [i for i, t in enumerate(texts) if t]
    given = [texts[i].decode() for i in plain]
    words = parted(given)
    a_ids, a_n = side_a.ids(given, words)
    b_ids, b_n = side_b.ids(given, words)
    want = [b" " + texts[i] for i in plain]
    own = np.repeat(np.arange(len(plain)), a_n), np.repeat(np.arange(len(plain)), b_n)
    same = np.ones(len(plain), bool)
    for ids, at, side in ((a_ids, own[0], side_a), (b_ids, own[1], side_b)):
        size = np.bincount(at, side.vocabulary.length[ids], len(plain)).astype(np.int64)
        same &= _equal(_cut(side.vocabulary.joined(ids), size), want)
    a_ids, b_ids = a_ids[same[own[0]]], b_ids[same[own[1]]]
    kept = np.flatnonzero(same)
    a_length, b_length = side_a.vocabulary.length[a_ids], side_b.vocabulary.length[b_ids]
    a_group, b_group, n_groups = groups_of(a_length, b_length)
    a_text, b_text = (np.repeat(np.arange(len(kept)), n[kept]) for n in (a_n, b_n))
    first = np.cumsum(a_n[kept]) - a_n[kept]
    whole = Aligned(a_ids, b_ids, a_group, b_group, n_groups, a_text, b_text, a_group[first] if len(kept) else np.zeros(0, np.int64))
    return whole, np.array(plain, np.int64)[kept]


_PAIRS = pa.list_(pa.int32())
ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_shared bigint, overlap_bytes bigint, "
    "groups_sha256 string, pair_a array<int>, pair_b array<int>, times array<int>"
)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    edge = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(edge, pa.array(values.astype(np.int32), pa.int32()))


def _describe(path_a: str, path_b: str, slice_bytes: int):
    """Tasks turn texts into figures and distinct id pairs of every document."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side_a, side_b = _tokenizers(path_a, path_b)
        n_a_ids, n_b_ids = len(side_a.vocabulary.length), len(side_b.vocabulary.length)
        for batch in batches:
            ids = batch.column("doc_id")
            for start, texts in slices(batch.column("text").to_pylist(), slice_bytes):
                x, at = align(texts, side_a, side_b)
                n = len(at)
                count = lambda rows, by=None: np.bincount(rows, by, n).astype(np.int64)
                link_a, link_b, shared = overlap_links(side_a.vocabulary.length[x.a_ids], side_b.vocabulary.length[x.b_ids])
                text = x.a_text[link_a]
                n_shared = np.zeros(n, np.int64)
                for row, _, _ in group_links(x.a_group, x.b_group, x.n_groups):
                    n_shared += count(x.a_text[row])
                code = (text * n_a_ids + x.a_ids[link_a]) * n_b_ids + x.b_ids[link_b]
                code, times = np.unique(code, return_counts=True)
                of_text, pair_b = code // n_b_ids, code % n_b_ids
                of_text, pair_a = of_text // n_a_ids, of_text % n_a_ids
                lines = group_strings(x.a_ids, x.a_group, x.b_ids, x.b_group, x.n_groups, x.first_group, max(n_a_ids, n_b_ids))
                groups = np.diff(np.append(x.first_group, x.n_groups))
                whole = lambda v: _spread(v, at, len(texts))
                digest = [""] * len(texts)
                for i, s in zip(at.tolist(), lines):
                    digest[i] = hashlib.sha256(s).hexdigest()
                per_text = whole(count(of_text))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, len(texts)), *(pa.array(whole(v)) for v in (
                        count(x.a_text), count(x.b_text), groups, count(text), n_shared, count(text, shared))),
                     pa.array(digest, pa.string()), _lists(pair_a, per_text), _lists(pair_b, per_text), _lists(times, per_text)],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "overlap_bytes", "groups_sha256", "pair_a", "pair_b", "times"],
                )
        # What was kept of this task's words is given back: workers live on.
        side_a.pool.clear()
        side_b.pool.clear()

    return describe


def _spread(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    out[at] = values
    return out


def alignments(docs: DataFrame, path_a: str, path_b: str, slice_bytes: int = SLICE) -> DataFrame:
    """Figures of every document, and its distinct id pairs (``pair_a``, ``pair_b``) with their numbers of links (``times``)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_describe(path_a, path_b, slice_bytes), ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, links, best): links of the whole corpus by id pair, and whether no other pair of its B id has more.

    Partial sums come before the move; there are at most as many rows as pairs of vocabulary entries.
    """
    pairs = aligned.select(F.explode(F.arrays_zip("pair_a", "pair_b", "times")).alias("p"))
    sums = pairs.groupBy(F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b")).agg(F.sum("p.times").cast("bigint").alias("links"))
    counts = stored(sums, "alignment_pairs")
    most = counts.groupBy("b").agg(F.max("links").alias("_most"))
    return counts.join(most, "b").select("a", "b", "links", (F.col("links") == F.col("_most")).alias("best"))


def _by_vector(counts: DataFrame, aligned: DataFrame) -> DataFrame:
    """(.., n_best, count_sum) by a vector of all pairs that every task holds."""
    base = 1 << 32
    table = counts.select((F.col("a") * F.lit(base) + F.col("b")).alias("code"), "links", "best").toPandas().sort_values("code")
    vector = tuple(table[c].to_numpy() for c in ("code", "links", "best"))
    held = aligned.sparkSession.sparkContext.broadcast(vector)
    figures = [f for f in ALIGNED.split(", ") if "array" not in f]
    names = [f.split()[0] for f in figures]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, links, best = held.value
        for batch in batches:
            a, b, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("pair_a", "pair_b", "times"))
            n = np.asarray(batch.column("pair_a").value_lengths().fill_null(0), np.int64)
            at = np.searchsorted(code, a * base + b)
            edge = np.concatenate([[0], np.cumsum(n)])
            sums = [np.concatenate([[0], np.cumsum(times * v[at])]) for v in (best, links)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *(pa.array(s[edge[1:]] - s[edge[:-1]]) for s in sums)],
                [*names, "n_best", "count_sum"],
            )

    return aligned.mapInArrow(weigh, ", ".join([*figures, "n_best bigint", "count_sum bigint"]))


def _by_join(counts: DataFrame, aligned: DataFrame) -> DataFrame:
    """The same by joining every document's pairs with the counts; for more pairs than a task should hold."""
    rows = stored(aligned.withColumn("_row", F.monotonically_increasing_id()), "alignment_rows")
    pairs = rows.select("_row", F.explode(F.arrays_zip("pair_a", "pair_b", "times")).alias("p"))
    pairs = pairs.select("_row", F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"), "p.times")
    sums = pairs.join(counts, ["a", "b"]).groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("links")).alias("count_sum")
    )
    zero = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("n_best", "count_sum")}
    return rows.drop("pair_a", "pair_b", "times").join(sums, "_row", "left").withColumns(zero).drop("_row")


def align_corpus(docs: DataFrame, path_a: str, path_b: str, vector_pairs: int = VECTOR_PAIRS, slice_bytes: int = SLICE) -> DataFrame:
    """Figures of every document with ``n_best`` (links whose pair is its B id's most frequent) and ``count_sum`` (links' counts)."""
    aligned = stored(alignments(docs, path_a, path_b, slice_bytes), "alignments")
    counts = stored(pair_counts(aligned), "alignment_counts")
    return (_by_vector if counts.count() <= vector_pairs else _by_join)(counts, aligned)
