"""SentencePiece encoding by suffix-array matching, and decoding.

A batch of texts is one string. Its suffixes are sorted by their first characters (as many as the longest piece
has), by doubling ranks; every piece of the vocabulary is then looked up by binary search, and the range of suffixes
that begin with it gives all its occurrences at once. The occurrences, sorted by position, are the edges of a
lattice, and relaxing them gives the segmentation.

The model is a byte-pair one, so relaxing follows its rule: among the edges that join two neighbouring segments,
the one with the best score, leftmost first, is taken until none is left, in all texts side by side. (A shortest
path over the same edges is what a unigram model needs; for this model it gives other pieces.) Characters without a
piece become byte pieces.

Texts repeat their words, and no piece reaches over a blank or a line end, which is checked in the vocabulary, so
texts are cut there and only words that the worker has not seen are matched. A vocabulary that fails the check is
matched on whole texts.

Nulls and edge cases: a null or empty text has no ids and decodes to the empty text; U+2581 is read as a blank;
repeated rows are encoded each; an empty table gives an empty result; very long words are relaxed with a queue.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.units import SLICE_BYTES, IdPool

BLANK = "▁"
#: Characters that are indexed at once, and the length from which a unit is relaxed with a queue.
BATCH_CHARS, LONG_UNIT = 200_000, 256
_UNIT = re.compile(r" +[^ \n]*|\n+[^ \n]*")


class Vocabulary:
    """Pieces, scores and byte ids of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        special = [sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) for i in range(n)]
        self.ids = np.array([i for i in range(n) if not special[i]], np.int32)
        names = [sp.id_to_piece(i) for i in range(n)]
        self.pieces = [names[i] for i in self.ids]
        # Higher is better; ranks instead of scores, so that they compare as integers.
        score = np.array([sp.get_score(int(i)) for i in self.ids])
        self.rank = np.zeros(n, np.int64)
        self.rank[self.ids] = np.searchsorted(np.unique(score), score) + 1
        self.byte = np.zeros(256, np.int32)
        self.bytes: list[bytes] = [p.replace(BLANK, " ").encode() for p in names]
        for i in range(n):
            if sp.is_byte(i):
                value = int(names[i][3:5], 16)
                self.byte[value], self.bytes[i] = i, bytes([value])
            elif sp.is_control(i):
                self.bytes[i] = b""
        self.longest = max(map(len, self.pieces))
        inner = any(BLANK in p.lstrip(BLANK) or "\n" in p for p in self.pieces)
        self.cuts_at_blanks = not inner
        # Pieces as rows of code points, shorter ones padded.
        self.length = np.array([len(p) for p in self.pieces])
        self.codes = np.zeros((len(self.pieces), self.longest), np.int64)
        for row, p in zip(self.codes, self.pieces):
            row[: len(p)] = [ord(c) for c in p]


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Start positions sorted by the ``depth`` code points that follow them."""
    rank, reach = np.unique(codes, return_inverse=True)[1].astype(np.int64), 1
    while reach < depth:
        ahead = np.concatenate([rank[reach:] + 1, np.zeros(min(reach, len(rank)), np.int64)])
        rank = np.unique(rank * (len(codes) + 2) + ahead, return_inverse=True)[1].astype(np.int64)
        reach *= 2
    return np.argsort(rank, kind="stable")


def occurrences(codes: np.ndarray, order: np.ndarray, pieces: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every piece the range of ``order`` whose suffixes begin with it; all pieces are searched side by side."""
    padded = np.concatenate([codes, np.full(pieces.shape[1] + 1, -1, codes.dtype)])
    low, high = np.zeros(len(pieces), np.int64), np.full(len(pieces), len(order))

    def bound(rows: np.ndarray, at: int, strict: bool) -> np.ndarray:
        a, b, want = low[rows].copy(), high[rows].copy(), pieces[rows, at]
        while True:
            open_ = a < b
            if not open_.any():
                return a
            mid = (a + b) >> 1
            here = padded[order[np.minimum(mid, len(order) - 1)] + at]
            right = open_ & ((here <= want) if strict else (here < want))
            a = np.where(right, mid + 1, a)
            b = np.where(open_ & ~right, mid, b)

    for at in range(pieces.shape[1]):
        rows = np.flatnonzero((length > at) & (low < high))
        if not len(rows):
            break
        first, last = bound(rows, at, False), bound(rows, at, True)
        low[rows], high[rows] = first, last
    return low, high


class Matcher:
    """Segments units (each starting with a blank sign or a line end) of one batch."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary

    def lattice(self, codes: np.ndarray) -> np.ndarray:
        """Ids of the piece at every (position, length - 1), -1 where there is none."""
        v = self.v
        order = suffix_array(codes, v.longest)
        low, high = occurrences(codes, order, v.codes, v.length)
        n = high - low
        start = np.cumsum(n) - n
        at = order[np.repeat(low - start, n) + np.arange(int(n.sum()))]
        piece = np.repeat(np.arange(len(n)), n)
        # Edges by position, then length: their place in the table.
        edge = at * v.longest + v.length[piece] - 1
        table = np.full(len(codes) * v.longest, -1, np.int32)
        table[edge] = v.ids[piece]
        return table

    def segment(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per unit)."""
        ids, counts, begin = [], [], 0
        while begin < len(units):
            end, size = begin, 0
            while end < len(units) and (end == begin or size < BATCH_CHARS):
                size += len(units[end]) + 1
                end += 1
            a, b = self._batch(units[begin:end])
            ids.append(a)
            counts.append(b)
            begin = end
        return np.concatenate(ids), np.concatenate(counts)

    def _batch(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer(" ".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        length = np.fromiter(map(len, units), np.int64, len(units))
        # What parts the units is no character.
        codes[np.cumsum(length + 1)[:-1] - 1] = -1
        table = self.lattice(codes)
        first = np.cumsum(length + 1) - (length + 1)
        long_ = length > LONG_UNIT
        start = np.flatnonzero(codes >= 0)
        unit = np.repeat(np.arange(len(units)), length)
        short = ~long_[unit]
        spans = [self._relax(table, start[short], unit[short])]
        spans += [self._relax_long(table, int(first[i]), int(length[i]), i) for i in np.flatnonzero(long_)]
        begin, stop, owner = (np.concatenate(x) for x in zip(*spans))
        sort = np.argsort(begin, kind="stable")
        begin, stop, owner = begin[sort], stop[sort], owner[sort]
        found = table[begin * self.v.longest + np.minimum(stop - begin, self.v.longest) - 1]
        missing = np.flatnonzero(found < 0)
        if not len(missing):
            return found, np.bincount(owner, minlength=len(units))
        # Byte pieces for characters of their own.
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in codes[begin[missing]].tolist()]
        width = np.ones(len(found), np.int64)
        width[missing] = [len(r) for r in raw]
        out = np.repeat(found, width)
        at = np.cumsum(width) - width
        for m, r in zip(missing, raw):
            out[at[m] : at[m] + len(r)] = self.v.byte[list(r)]
        return out, np.bincount(np.repeat(owner, width), minlength=len(units))

    def _joined(self, table: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Rank of the piece over [begin, stop), 0 where there is none."""
        n = stop - begin
        fits = n <= self.v.longest
        piece = np.where(fits, table[begin * self.v.longest + np.where(fits, n, 1) - 1], -1)
        return np.where(piece >= 0, self.v.rank[piece], 0)

    def _relax(self, table: np.ndarray, start: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every unit takes its best edge, then the next, all units side by side."""
        begin, stop, owner = start.copy(), start + 1, unit.copy()
        done = []
        if not len(begin):
            return begin, stop, owner
        rank = np.zeros(len(begin), np.int64)
        pair = np.flatnonzero(owner[:-1] == owner[1:])
        rank[pair] = self._joined(table, begin[pair], stop[pair + 1])
        while len(begin):
            head = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            place = np.arange(len(begin))
            # The best rank, and the leftmost of its places.
            key = (rank << 32) - place
            best = np.maximum.reduceat(key, head)
            size = np.diff(np.concatenate([head, [len(begin)]]))
            more = np.repeat(best > 0, size)
            if not more.all():
                done.append((begin[~more], stop[~more], owner[~more]))
                begin, stop, owner, rank = begin[more], stop[more], owner[more], rank[more]
                key, best, size = key[more], best[best > 0], size[best > 0]
                if not len(begin):
                    break
            take = np.flatnonzero(key == np.repeat(best, size))
            stop[take] = stop[take + 1]
            keep = np.ones(len(begin), bool)
            keep[take + 1] = False
            moved = np.cumsum(keep) - 1
            begin, stop, owner, rank = begin[keep], stop[keep], owner[keep], rank[keep]
            at = moved[take]
            for side in (at, at - 1):
                side = side[side >= 0]
                pair = side[(side + 1 < len(begin))]
                same = owner[pair] == owner[np.minimum(pair + 1, len(begin) - 1)]
                rank[side[side + 1 >= len(begin)]] = 0
                rank[pair[~same]] = 0
                ok = pair[same]
                rank[ok] = self._joined(table, begin[ok], stop[ok + 1])
        return tuple(np.concatenate(x) for x in zip(*done))

    def _relax_long(self, table: np.ndarray, first: int, n: int, unit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for one long unit, with a queue of edges."""
        width, rank = self.v.longest, self.v.rank
        left, right, size = list(range(-1, n - 1)), list(range(1, n + 1)), [1] * n
        queue: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = right[i]
            if 0 <= i and j < n and size[i] + size[j] <= width:
                piece = table[(first + i) * width + size[i] + size[j] - 1]
                if piece >= 0:
                    heapq.heappush(queue, (-int(rank[piece]), i, size[i], size[j]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = right[i]
            # An edge is stale when one of its sides has grown or gone.
            if size[i] != a or j >= n or size[j] != b:
                continue
            size[i], size[j] = a + b, 0
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        begin = np.array([i for i in range(n) if size[i]], np.int64)
        return begin + first, begin + first + np.array([size[i] for i in begin]), np.full(len(begin), unit)


class Codec:
    """Encodes and decodes texts with one vocabulary; keeps the words it has seen."""

    def __init__(self, path: str):
        self.v = Vocabulary(path)
        matcher = Matcher(self.v)
        # A unit's first character stands for itself (line end) or for a blank.
        self.pool = IdPool(lambda units: matcher.segment([u.replace(" ", BLANK) for u in units]), limit=2_000_000)

    def units(self, text: str | None) -> list[str]:
        """What the text is cut into, with the blank that the model puts first."""
        if not text:
            return []
        whole = " " + text.replace(BLANK, " ")
        return _UNIT.findall(whole) if self.v.cuts_at_blanks else [whole]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text)."""
        return self.pool([self.units(t) for t in texts])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the blank that encoding puts first; broken byte runs become U+FFFD."""
        raw = b"".join(map(self.v.bytes.__getitem__, ids.tolist()))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


_ENCODED = "doc_id bigint, n_ids bigint, ids array<int>"
_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of this worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _encode(path: str, read_back: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(path)
        for batch in batches:
            texts, docs = batch.column("text"), batch.column("doc_id")
            begin = 0
            while begin < len(texts):
                part, size = [], 0
                while begin + len(part) < len(texts) and (not part or size < SLICE_BYTES):
                    part.append(texts[begin + len(part)].as_py())
                    size += len(part[-1] or "")
                flat, n = known.encode(part)
                edge = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                columns = {
                    "doc_id": docs.slice(begin, len(part)), "n_ids": pa.array(n),
                    "ids": pa.ListArray.from_arrays(edge, pa.array(flat)),
                }
                if read_back:
                    columns |= _described(known, np.split(flat, edge[1:-1]))
                yield pa.RecordBatch.from_pydict(columns)
                begin += len(part)
        # What was kept of this task's words is given back: workers live on.
        known.pool.clear()

    return run


def _described(known: Codec, each: list[np.ndarray]) -> dict[str, pa.Array]:
    """A checksum of every document's ids, and a digest of what they decode to."""
    return {
        "ids_crc32": pa.array([zlib.crc32(x.astype("<u4")) for x in each], pa.int64()),
        "decoded_sha256": pa.array([hashlib.sha256(known.decode(x).encode()).hexdigest() for x in each], pa.string()),
    }


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_ids, ids) of every whole text."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_encode(model), _ENCODED)


def encode_and_read_back(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_ids, ids, ids_crc32, decoded_sha256): encoded and decoded in the same task."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_encode(model, True), f"{_ENCODED}, ids_crc32 bigint, decoded_sha256 string")


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(path)
        for batch in batches:
            texts = [known.decode(row.values.to_numpy(zero_copy_only=False)) for row in batch.column("ids")]
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    return run


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Add ``decoded``, the text of the ids."""
    return encoded.mapInArrow(_decode(model), f"{_ENCODED}, decoded string")
