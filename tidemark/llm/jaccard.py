"""N-gram Jaccard join by fragments of the shingle order: groups of documents that link at a similarity.

A document's set is its distinct n-word shingles, as 64-bit hashes; the hash order is the global order. Vertical
partitioning cuts this order into K fragments, the same for all documents of about one size. Two sets that differ
in at most D shingles differ in at most D fragments, so with K > D some fragments are equal in both: equal fragments
propose pairs, and every document signs only as many fragments (D + 3 that are not empty) as leaves three equal ones.
What shares fewer is not compared. Overlaps are then counted over whole sets in blocks of documents; they alone decide.
Vertical partitioning proper would count them by fragment and pair and sum those rows per pair, a number that grows with
the square of a family (figures in the README); here fragments are signatures, and Spark partitions by block.

Equal sets are one class and are joined once. A set is proposed as a node of 32 bits of its digest; signatures are packed
by bucket with the nodes, so that a move takes about 8 bytes for each, and those nobody shares end there. Texts are read
again where they lie for the sets that meet others; neither texts nor signatures are joined to rows. Proposed documents are gathered around the one they share most
fragments with; such a family is compared in blocks of bounded size, whose tasks return a spanning forest of the links
they find and never the pairs. Groups with an equal fragment that several families meet in are sifted first, by lists of
the groups that each row is in: of a group, those rows go on that share three fragments with a row of another family,
and every pair only in one of the groups that it shares. So a set is copied for few of its groups. All links
between different sets are found, whatever the size of a group; the rows copied for a family grow with its square
over the block size.

Nulls and edge cases: a null or empty text, or one without words, has an empty set and links with nothing; with
fewer words than n, the whole sequence is the one shingle; a null id is a document whose component has no smaller
id unless another member has one; rows with one id and different texts are separate documents; repeated rows and
copies share a class; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.rows import ADDRESS, addressed
from tidemark.llm.units import Words, mix64, slices
from tidemark.plans.bounds import stored

WORDS, PERCENT = 3, 90
#: Sizes up to the next power of this share their fragments.
LEVEL_RATIO = 1.25
#: Equal fragments that linked sets share at least; fewer are chance, such as a passage that many documents have.
SHARED = 3
#: Bytes of text that a task takes at once; arrays over them take up to 40 times as much.
SLICE = 512 << 10
#: Documents and shingles of one side of a block.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 1_000_000
#: Shingles of one fragment of the order when overlaps are counted.
COLUMNS = 4096
#: Signatures that a task packs together, and that one bucket holds.
RECORD_SIGNS, BUCKET_SIGNS = 1_000_000, 1_000_000
#: A fragment that so many rows share is summed by its own path; one of so many rows is looked at to find it. At most
#: HOT_LIST fragments are given to all tasks: with more signatures, more rows make a fragment frequent.
HOT_ROWS, HOT_SAMPLE, HOT_LIST = 65_536, 16, 50_000
#: A node is a digest without so many of its last bits.
NODE_SHIFT = 32
#: Bits of the filter that tells which texts are needed again.
FILTER_BITS = 1 << 25
_ODD = np.uint64(0xA24BAED4963EE407)


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    w = Words(texts, lower=True)
    grams, first = w.grams(n)
    out, bound = [], np.searchsorted(w.text[first], np.arange(w.n_texts + 1))
    short = w.hashes() if (w.count < n).any() else None
    start = np.concatenate([[0], np.cumsum(w.count)])
    for i in range(w.n_texts):
        if w.count[i] >= n:
            out.append(np.unique(grams[bound[i] : bound[i + 1]]))
        elif w.count[i]:
            total = np.full(1, w.count[i], np.uint64)
            for h in short[start[i] : start[i + 1]]:
                total = mix64(total + h)
            out.append(total)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def difference(s: int, t: int, percent: int) -> int:
    """Shingles in which linked sets of at most these sizes differ at most."""
    return (s + t) * (100 - percent) // (100 + percent)


class Levels:
    """Sizes that share a cut of the hash order."""

    def __init__(self, percent: int, ratio: float = LEVEL_RATIO):
        self.percent, self.ratio, self.top = percent, ratio, [8]

    def of(self, size: int) -> int:
        while self.top[-1] < size:
            self.top.append(int(self.top[-1] * self.ratio) + 1)
        return int(np.searchsorted(self.top, size))

    def most(self, size: int) -> int:
        """About as many signatures as a set of this size has; for cutting work, not for results."""
        largest = 100 * size // self.percent
        tops = [self.top[i] for i in range(self.of(size), self.of(largest) + 1)] if size else []
        return sum(difference(size, min(top, largest), self.percent) + SHARED for top in tops)

    def signatures(self, s: np.ndarray) -> list[np.ndarray]:
        """Signatures of one set: at its own level, and at those where larger partners are."""
        n = len(s)
        largest = 100 * n // self.percent
        out = []
        for level in range(self.of(n), self.of(largest) + 1):
            top = self.top[level]
            allowed = difference(n, min(top, largest), self.percent)
            if not allowed:
                continue
            most = difference(top, top, self.percent)
            k = most + SHARED + 3 + most // 5
            fragment = ((s >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
            start = np.flatnonzero(np.concatenate([[True], fragment[1:] != fragment[:-1]]))
            full = fragment[start]
            value = np.add.reduceat(mix64(s), start)
            # Enough fragments with shingles that, after all differences, SHARED equal ones are left.
            count = allowed + SHARED
            if len(full) >= count:
                out.append(mix64(value[:count] + (full[:count].astype(np.uint64) + np.uint64(level * 1_000_003)) * _ODD))
            else:
                # Too few fragments with shingles: every shingle by itself proposes pairs.
                out.append(mix64(s + np.uint64(level + 1) * _ODD))
                out.append(mix64(value + (full.astype(np.uint64) + np.uint64(level * 1_000_003)) * _ODD))
        return out


def _as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    return np.array([[mix64(s).sum(), mix64(s ^ _ODD).sum()] for s in sets], np.uint64).reshape(-1, 2)


def _node(hi: np.ndarray, shift: int) -> np.ndarray:
    """What stands for a set while pairs are proposed: the first bits of its digest. Sets that share them are proposed together."""
    return (hi >> np.uint64(shift)).astype(np.uint32)


def _key_rows(n: int, percent: int, extra: list[str]):
    """Tasks turn texts into (doc_id, size, two digests, number of signatures, extra columns as they are)."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Levels(percent)
        for batch in batches:
            ids = batch.column("_doc")
            for start, texts in slices(batch.column("_text").to_pylist(), SLICE):
                sets = shingle_sets(texts, n)
                size = np.array([len(s) for s in sets], np.int64)
                digest = _digests(sets)
                signs = np.array([levels.most(len(s)) for s in sets], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, len(sets)), pa.array(size), pa.array(_as_long(digest[:, 0].copy())),
                     pa.array(_as_long(digest[:, 1].copy())), pa.array(signs), *(batch.column(c).slice(start, len(sets)) for c in extra)],
                    ["_doc", "_n", "_hi", "_lo", "_signs", *extra],
                )

    return describe


_KEYS = "_doc bigint, _n bigint, _hi bigint, _lo bigint, _signs bigint"


def keyed(docs: DataFrame, words: int, percent: int, extra: tuple[str, ...] = ()) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_doc"), F.col("text").alias("_text"), *extra)
    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in extra)
    return rows.mapInArrow(_key_rows(words, percent, list(extra)), _KEYS + kinds)


#: Bits of a signature that are compared; what falls together by chance is told apart by the overlaps.
SIGN_BITS = 46


def _signed(texts: list[bytes], n: int, levels: Levels, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, nodes) of all texts with a set, each pair once."""
    sets = [s for s in shingle_sets(texts, n) if len(s)]
    values = [np.concatenate(parts) if (parts := levels.signatures(s)) else np.zeros(0, np.uint64) for s in sets]
    if not values:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    nodes = np.repeat(_node(_digests(sets)[:, 0], shift), [len(v) for v in values])
    return np.concatenate(values) >> np.uint64(64 - SIGN_BITS), nodes


def _unique_pairs(sign: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((node, sign))
    sign, node = sign[order], node[order]
    new = np.ones(len(sign), bool)
    new[1:] = (sign[1:] != sign[:-1]) | (node[1:] != node[:-1])
    return sign[new], node[new]


def _pack(words: int, percent: int, buckets: int, frequent: np.ndarray, only: bool):
    """Tasks pack signatures into records of (bucket, gaps between the sorted signatures, nodes), copies left out.

    Signatures of ``frequent`` are left out; with ``only`` they alone are returned, as rows of (sign, node).
    """

    shift = NODE_SHIFT

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, held, size = Levels(percent), [], 0

        def records() -> pa.RecordBatch:
            sign, node = _unique_pairs(*(np.concatenate(x) for x in zip(*held)))
            hot = np.isin(sign, frequent) if len(frequent) else np.zeros(len(sign), bool)
            if only:
                return pa.RecordBatch.from_arrays([pa.array(sign[hot].astype(np.int64)), pa.array(node[hot].astype(np.int64))], ["sign", "node"])
            sign, node = sign[~hot], node[~hot]
            bucket = _bucket(sign, buckets)
            start = np.flatnonzero(np.concatenate([np.ones(min(1, len(sign)), bool), bucket[1:] != bucket[:-1]]))
            out = []
            for low, high in zip(start.tolist(), [*start[1:].tolist(), len(sign)]):
                gaps = np.diff(sign[low:high], prepend=np.uint64(0))
                first, rest = int(gaps[0]), gaps[1:]
                wide = bool(len(rest)) and int(rest.max()) >= 1 << 32
                out.append((int(bucket[low]), first, rest.astype("<u8" if wide else "<u4").tobytes(), node[low:high].astype("<u4").tobytes()))
            columns = list(zip(*out)) or [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["bucket", "first", "gaps", "nodes"])

        for batch in batches:
            for _, texts in slices(batch.column("_text").to_pylist(), SLICE):
                held.append(_signed(texts, words, levels, shift))
                size += len(held[-1][0])
                if size >= RECORD_SIGNS:
                    yield records()
                    held, size = [], 0
        if held:
            yield records()

    return pack


_PACKED = "bucket int, first bigint, gaps binary, nodes binary"


def _bucket(sign: np.ndarray, buckets: int) -> np.ndarray:
    top = (sign >> np.uint64(SIGN_BITS - 24)).astype(np.int64)
    return (top * buckets) >> 24


def _unpacked(first: int, gaps: bytes, nodes: bytes) -> tuple[np.ndarray, np.ndarray]:
    node = np.frombuffer(nodes, "<u4")
    rest = np.frombuffer(gaps, "<u8" if len(gaps) == 8 * (len(node) - 1) and gaps else "<u4").astype(np.uint64)
    return np.cumsum(np.concatenate([[np.uint64(first)], rest]), dtype=np.uint64), node


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks take bucket after bucket and return (row, c, g) of every node and signature that another node shares."""
    key, held = None, []

    def found() -> pa.RecordBatch:
        sign, node = _unique_pairs(*(np.concatenate(x) for x in zip(*held)))
        start = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]]))
        count = np.diff(np.append(start, len(sign)))
        joint = np.bitwise_xor.reduceat(mix64(node.astype(np.uint64) + _ODD), start)
        several = np.repeat(count > 1, count)
        return pa.RecordBatch.from_arrays(
            [pa.array(node[several].astype(np.int64)), pa.array(np.repeat(count, count)[several].astype(np.int64)),
             pa.array(_as_long(np.repeat(joint, count)[several]))], ["row", "c", "g"])

    for batch in batches:
        for record in batch.to_pylist():
            if record["bucket"] != key and held:
                yield found()
                held.clear()
            key = record["bucket"]
            held.append(_unpacked(record["first"], record["gaps"], record["nodes"]))
    if held:
        yield found()


_SETS = "_n bigint, parts array<bigint>"


def _wanted_sets(n: int, bits: np.ndarray | None):
    """Tasks turn texts into sets, for rows that the filter ``bits`` may hold; addresses as they are."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if bits is not None:
                slot = batch.column("_slot").to_numpy()
                batch = batch.filter(pa.array((bits[slot >> 3] >> (slot & 7) & 1).astype(bool)))
            for start, texts in slices(batch.column("_text").to_pylist(), SLICE):
                sets = shingle_sets(texts, n)
                bound = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.diff(bound).astype(np.int64)), pa.ListArray.from_arrays(bound, pa.array(_as_long(flat))),
                     *(batch.column(c).slice(start, len(sets)) for c in ADDRESS)], ["_n", "parts", *ADDRESS])

    return describe


def _slot(bits: int):
    return F.pmod(F.xxhash64(*ADDRESS), F.lit(bits))


def address_filter(rows: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit for every address's slot: a filter of fixed size that lets each address pass, and few others.

    Spark adds the bits up in pieces of 4 KB; the more rows, the more others pass, but its size stays.
    """
    # Pieces number their slots from 1.
    slot = rows.select((_slot(bits) + 1).alias("_slot"))
    pieces = slot.groupBy(F.expr("bitmap_bucket_number(_slot)").alias("piece")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_slot))").alias("set"))
    out = np.zeros(bits // 8 + 4096, np.uint8)
    for row in pieces.toLocalIterator():
        out[(row["piece"] - 1) * 4096 : row["piece"] * 4096] = np.frombuffer(row["set"], np.uint8)
    return out


def overlaps(sets: list[np.ndarray], columns: int = COLUMNS) -> np.ndarray:
    """Sizes of all intersections, summed over slices of the hash order that bound the memory."""
    flat = np.concatenate(sets)
    if not len(flat):
        return np.zeros((len(sets), len(sets)), np.float32)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    name = np.cumsum(new) - 1
    shared = np.bincount(name)[name] > 1
    name, owner = name[shared], owner[shared]
    name = np.cumsum(np.concatenate([[False], name[1:] != name[:-1]])) if len(name) else name
    total = np.zeros((len(sets), len(sets)), np.float32)
    n = int(name[-1]) + 1 if len(name) else 0
    for low in range(0, n, columns):
        a, b = np.searchsorted(name, [low, low + columns])
        part = np.zeros((len(sets), min(columns, n - low)), np.float32)
        part[owner[a:b], name[a:b] - low] = 1
        total += part @ part.T
    return total


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest, from the roots on."""
    todo, out = np.ones(len(linked), bool), []
    for i in range(len(linked)):
        if not todo[i]:
            continue
        todo[i] = False
        edge = [i]
        while edge:
            at = edge.pop()
            near = np.flatnonzero(linked[at] & todo)
            todo[near] = False
            edge += near.tolist()
            out += [(at, j) for j in near.tolist()]
    return out


def spanning_links(rows: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A forest that joins the same rows as all links among the sets of one block."""
    size = np.array([len(s) for s in sets], np.float64)
    shared = overlaps(sets).astype(np.float64)
    linked = 100 * shared >= percent * (size[:, None] + size[None, :] - shared)
    return [(int(rows[i]), int(rows[j])) for i, j in _forest(linked)]


def sifted(block: tuple[int, int, int], rows: np.ndarray, own: np.ndarray, groups: list[np.ndarray], weights: list[np.ndarray], families: np.ndarray) -> list[tuple[int, int]]:
    """(key, row) of the rows of one block that share SHARED fragments with a row of another family; such rows share a key.

    ``groups`` are the groups that each row is in, with their numbers of fragments; ``own`` is its chunk. A pair counts in
    the smallest of its common groups alone, and in one block of that, so that it is compared once.
    """
    key, i, j = block
    several = [np.concatenate([mix64(g[w > n] + np.uint64(n) * _ODD) for n in range(SHARED)]) for g, w in zip(groups, weights)]
    near = (overlaps(several) >= SHARED) & (families[:, None] != families[None, :])
    if i != j:
        near &= own[:, None] != own[None, :]
    if not near.any():
        return []
    near &= overlaps([g[g < np.int64(key).view(np.uint64)] for g in groups]) == 0
    of, met = np.arange(len(rows)), np.zeros(len(rows), bool)
    for a, b in _forest(near):
        of[b] = of[a]
        met[[a, b]] = True
    place = np.array([key, i, j], np.int64).view(np.uint64)
    names = mix64(mix64(mix64(place[:1] + _ODD) + place[1:2]) + place[2:]) + mix64(rows.view(np.uint64))
    return [(int(k), int(r)) for k, r in zip(_as_long(names[of[met]]), rows[met])]


def _by_block(out: list[str], columns: list[str], take):
    """Tasks take the rows of one block after the other from their sorted partition; ``take`` makes pairs ``out`` of them."""

    def pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
        both = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, own, held, found = None, [], [], [], []

        def close() -> None:
            if len(rows) > 1:
                found.extend(take(key, np.array(rows, np.int64), np.array(own), *map(list, zip(*held))))

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j"))))
            values = [batch.column(c) for c in columns]
            for at, (k, row, chunk) in enumerate(zip(keys, batch.column("row").to_pylist(), batch.column("own").to_pylist())):
                if k != key:
                    close()
                    key, rows, own, held = k, [], [], []
                rows.append(row)
                own.append(chunk)
                # Copied, so that what is held does not keep its batch.
                held.append([v[at].values.to_numpy(zero_copy_only=False).astype(np.int64) for v in values])
            if len(found) > 10_000:
                yield pairs(found)
                found.clear()
        close()
        yield pairs(found)

    return run


def _compare(percent: int):
    return _by_block(["a", "b"], ["parts"], lambda _, rows, own, sets: spanning_links(rows, [s.view(np.uint64) for s in sets], percent))


def _sift(block: tuple[int, int, int], rows: np.ndarray, own: np.ndarray, groups: list[np.ndarray], weights: list[np.ndarray], families: list[np.ndarray]) -> list[tuple[int, int]]:
    return sifted(block, rows, own, [g.view(np.uint64) for g in groups], weights, np.concatenate(families))


def _stored_moves(step: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``step`` as stored, and how many of its rows moved, counted while it was written."""
    seen = Observation()
    out = stored(step.observe(seen, F.count_if("moved").alias("moved")), name)
    return out.drop("moved"), seen.get["moved"] or 0


def roots(pointers: DataFrame) -> DataFrame:
    """Follow (row, to) pointers, which have no cycles, to their ends; doubles the reach with every pass."""
    moved = 1
    while moved:
        ahead = pointers.select(F.col("row").alias("_row"), F.col("to").alias("_to"))
        step = pointers.join(ahead, F.col("to") == F.col("_row"), "left").select(
            "row", F.coalesce("_to", "to").alias("to"), (F.coalesce("_to", "to") != F.col("to")).alias("moved")
        )
        pointers, moved = _stored_moves(step, "jaccard_roots")
    return pointers


def components(links: DataFrame) -> DataFrame:
    """(row, root): the smallest row that links lead to. Minimum labels spread along links and along themselves."""
    # Links are read once: a union of both directions would find them twice.
    either = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    both = stored(links.select(either.alias("_link")).select("_link.a", "_link.b").distinct(), "jaccard_links")
    labels = both.groupBy("a").agg(F.min("b").alias("_b")).select(F.col("a").alias("row"), F.least("a", "_b").alias("to"))
    labels, moved = stored(labels, "jaccard_labels"), 1
    while moved:
        far = labels.select(F.col("row").alias("b"), F.col("to").alias("_to"))
        seen = both.join(far, "b").groupBy("a").agg(F.min("_to").alias("_near"))
        spread = labels.join(seen, F.col("row") == F.col("a")).select("row", "to", F.least("to", "_near").alias("next"))
        jump = labels.select(F.col("row").alias("_row"), F.col("to").alias("_to"))
        step = spread.join(jump, F.col("next") == F.col("_row"), "left").select(
            "row", F.least("next", "_to").alias("to"), (F.least("next", "_to") < F.col("to")).alias("moved")
        )
        labels, moved = _stored_moves(step, "jaccard_labels")
    return labels.withColumnRenamed("to", "root")


def _frequent(texts: DataFrame, words: int, percent: int, signs: int) -> np.ndarray:
    """Signatures that about HOT_ROWS nodes or more share, found in one of HOT_SAMPLE texts. It only chooses how they are counted."""
    least = max(HOT_ROWS, -(-signs // HOT_LIST)) // HOT_SAMPLE
    if signs < least:
        return np.zeros(0, np.uint64)

    shift, one_of = NODE_SHIFT, HOT_SAMPLE

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Levels(percent)
        for batch in batches:
            for _, part in slices(batch.column("_text").to_pylist(), SLICE):
                # Copies stay together, so that they count once.
                part = [t for t in part if zlib.crc32(t) % one_of == 0]
                sign, node = _unique_pairs(*_signed(part, words, levels, shift)) if part else (np.zeros(0, np.uint64), np.zeros(0, np.uint32))
                yield pa.RecordBatch.from_arrays([pa.array(sign.astype(np.int64)), pa.array(node.astype(np.int64))], ["sign", "node"])

    pairs = texts.mapInArrow(some, "sign bigint, node bigint").distinct()
    many = pairs.groupBy("sign").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= max(1, least)).select("sign")
    return np.sort(np.array([r["sign"] for r in many.collect()], np.uint64))


def _met(texts: DataFrame, words: int, percent: int, signs: int) -> DataFrame:
    """(row, c, g) of every node and fragment that another node shares: the nodes that do, and their joint digest.

    Signatures go to their buckets packed, about 8 bytes each, and only those that meet come out.
    """
    frequent = _frequent(texts, words, percent, signs)
    buckets = max(texts.sparkSession.sparkContext.defaultParallelism, -(-signs // BUCKET_SIGNS))
    packed = texts.mapInArrow(_pack(words, percent, buckets, frequent, False), _PACKED).repartition(buckets, "bucket")
    rare = packed.sortWithinPartitions("bucket").mapInArrow(_meet, "row bigint, c bigint, g bigint")
    if not len(frequent):
        return rare
    # A fragment that many nodes share is summed before it is moved; its few sums go to the nodes, not its nodes to one task.
    hot = stored(texts.mapInArrow(_pack(words, percent, buckets, frequent, True), "sign bigint, node bigint").distinct(), "jaccard_frequent")
    digest = F.bit_xor(F.xxhash64("node"))
    sums = stored(hot.groupBy("sign").agg(F.count(F.lit(1)).alias("c"), digest.alias("g")), "jaccard_frequent")
    # At most HOT_LIST rows, up to chance.
    return rare.unionByName(hot.join(F.broadcast(sums), "sign").select(F.col("node").alias("row"), "c", "g")).where("c > 1")


def _proposals(met: DataFrame) -> DataFrame:
    """(g, c, row, weight): groups of nodes with an equal fragment; groups with the same nodes are one, with their number."""
    return _with_partners(stored(met.groupBy("g", "c", "row").agg(F.count(F.lit(1)).alias("weight")), "jaccard_groups"))


def _with_partners(groups: DataFrame) -> DataFrame:
    """Without the rows that share fewer fragments than linked sets do, and the groups they leave with one row."""
    enough = groups.groupBy("row").agg(F.sum("weight").alias("w")).where(F.col("w") >= SHARED).select("row")
    left = stored(groups.join(enough, "row"), "jaccard_partners")
    several = left.groupBy("g", "c").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("g", "c")
    return stored(left.join(several, ["g", "c"]), "jaccard_partners")


def _families(groups: DataFrame) -> DataFrame:
    """(row, family): every row joins the row that it shares most fragments with, and that one's family."""
    degree = stored(groups.groupBy("row").agg(F.sum("weight").alias("degree")), "jaccard_degrees")
    ranked = groups.join(degree, "row")
    hubs = ranked.groupBy("g", "c").agg(F.max(F.struct("degree", "row")).alias("hub"))
    shared = (
        groups.join(hubs, ["g", "c"])
        .groupBy("row", F.col("hub.row").alias("to"), F.col("hub.degree").alias("d"))
        .agg(F.sum("weight").alias("shared"))
    )
    best = shared.groupBy("row").agg(F.max(F.struct("shared", "d", "to")).alias("best"))
    return roots(stored(best.select("row", F.col("best.to").alias("to")), "jaccard_hubs")).withColumnRenamed("to", "family")


def _mixed(groups: DataFrame, families: DataFrame) -> DataFrame:
    """(key, row) of rows that share fragments across families, from the groups whose rows are of several families."""
    member = groups.join(families, "row")
    several = member.groupBy("g", "c").agg(F.min("family").alias("x"), F.max("family").alias("y")).where("x <> y")
    mixed = _with_partners(member.join(several, ["g", "c"]).select("g", "c", "row", "weight", "family"))
    # A row's list has a number for every group that it is in, so it is shorter than the row's signatures.
    held = F.collect_list(F.struct(F.xxhash64("g", "c").alias("key"), "weight"))
    lists = stored(mixed.groupBy("row").agg(held.alias("held"), F.collect_set("family").alias("family")), "jaccard_lists")
    lists = lists.select("row", F.col("held.key").alias("groups"), F.col("held.weight").alias("weights"), "family")
    members = lists.select(F.explode("groups").alias("key"), "row", F.size("groups").cast("bigint").alias("n"))
    return _blocks(members, lists, ["row"]).mapInArrow(_by_block(["key", "row"], ["groups", "weights", "family"], _sift), "key bigint, row bigint")


def _blocks(members: DataFrame, described: DataFrame, on: list[str]) -> DataFrame:
    """The rows of every key with what describes them, sorted into blocks of chunk pairs; a chunk is bounded in rows and in shingles.

    ``members`` are (key, row, n) and the columns ``on``, by which ``described`` is joined.
    """
    sized = stored(members, "jaccard_members")
    chunks = sized.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s")).where("m > 1")
    number = F.greatest(F.ceil(F.col("m") / BLOCK_ROWS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int")
    placed = sized.drop("n").join(chunks.select("key", number.alias("k")), "key")
    own = F.pmod(F.xxhash64("row"), F.col("k")).cast("int")
    spread = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    keyed = spread.select("row", "own", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *[c for c in on if c != "row"])
    # A merge join at every size, as all sets are moved by ``on`` once, whatever joins them there.
    blocks = keyed.hint("merge").join(described, on).drop(*(c for c in on if c != "row")).repartition("key", "i", "j")
    return blocks.sortWithinPartitions("key", "i", "j")


def _compared(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among the rows of every key; sets go from where their texts lie to their blocks."""
    return _blocks(members, sets.select("parts", *ADDRESS), list(ADDRESS)).mapInArrow(_compare(percent), "a bigint, b bigint")


def link_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_shingles, component_id, keep) of every row, and ``extra`` columns of ``docs`` as they are.

    ``keep`` marks one row of each component, one with the smallest id. Rows are told apart by the addresses of
    ``docs``, or by those that ``addressed`` gives them.
    """
    if not set(ADDRESS) <= set(docs.columns):
        docs = addressed(docs.select("doc_id", "text", *extra))
    carried = tuple(dict.fromkeys([*extra, *ADDRESS]))
    rows = keyed(docs, words, percent, extra=carried).withColumn("_row", F.monotonically_increasing_id())
    # Row numbers are fixed once the rows are written; they are short, without texts, sets or signatures.
    rows = stored(rows, "jaccard_rows")
    key = ["_n", "_hi", "_lo"]
    first = F.min(F.struct("_row", *ADDRESS))
    least = F.min(F.struct(F.col("_doc").isNull().alias("null"), F.col("_doc").alias("doc"), F.col("_row").alias("row")))
    classes = stored(rows.where("_n > 0").groupBy(*key).agg(first.alias("_first"), least.alias("least")), "jaccard_classes")
    reps = classes.select(F.col("_first._row").alias("rep"), F.shiftrightunsigned("_hi", NODE_SHIFT).alias("node"), F.col("_n").alias("n"), *[F.col(f"_first.{c}").alias(c) for c in ADDRESS])
    signs = rows.agg(F.coalesce(F.sum("_signs"), F.lit(0))).first()[0]

    texts = docs.select(F.col("text").alias("_text"))
    groups = _proposals(_met(texts, words, percent, signs))
    families = _families(groups)
    # Different sets of one node have met nobody in each other: they are compared as a group of their own.
    twins = stored(reps.groupBy("node").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("node"), "jaccard_twins")
    # From nodes to the rows that stand for their sets, one per class.
    nodes = families.select(F.col("row").alias("node")).union(twins).distinct()
    involved = stored(reps.join(nodes, "node").select("rep", "node", "n", *ADDRESS), "jaccard_involved")
    # Texts are read again where they lie; a filter of fixed size leaves the rows that may be needed, and only their
    # sets move: once to where they meet by address, as ids may be null or repeat, and on to their blocks. A merge join
    # at every size, so that small tables show what large ones need.
    again = docs.select(F.col("text").alias("_text"), _slot(FILTER_BITS).alias("_slot"), *ADDRESS)
    address = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in ADDRESS)
    sets = again.mapInArrow(_wanted_sets(words, address_filter(involved)), f"{_SETS}, {address}")
    sets = sets.join(involved.hint("merge"), list(ADDRESS)).select(F.col("rep").alias("row"), "parts", *ADDRESS)

    members = families.select(F.col("family").alias("key"), "row").unionByName(_mixed(groups, families))
    members = members.unionByName(twins.select((-1 - F.col("node")).alias("key"), F.col("node").alias("row")))
    members = members.join(involved.select("rep", "n", F.col("node").alias("row"), *ADDRESS), "row").select("key", F.col("rep").alias("row"), "n", *ADDRESS)
    labels = components(_compared(members, sets, percent))
    # From rows to classes to components; a component's id is the smallest id of all its rows.
    rep = F.col("_first._row")
    whole = classes.join(labels, rep == F.col("row"), "left").select(*key, "least", F.coalesce("root", rep).alias("root"))
    whole = stored(whole, "jaccard_wholes")
    least = whole.groupBy("root").agg(F.min("least").alias("of_all"))
    named = whole.join(least, "root").select(*key, F.col("of_all.doc").alias("_component"), F.col("of_all.row").alias("_kept"))
    plain = rows.where("_n = 0").select("_doc", "_n", F.col("_doc").alias("_component"), F.lit(True).alias("_keep"), *extra)
    grouped = rows.where("_n > 0").join(named, key).select("_doc", "_n", "_component", (F.col("_row") == F.col("_kept")).alias("_keep"), *extra)
    names = {"_doc": "doc_id", "_n": "n_shingles", "_component": "component_id", "_keep": "keep"}
    return grouped.unionByName(plain).select(*[F.col(c).alias(name) for c, name in names.items()], *extra)
