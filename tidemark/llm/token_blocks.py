"""Token ids in binary files of patched frame-of-reference blocks.

A block holds 4,096 ids: their minimum, and the differences from it packed at the width that a given share of
them needs. Larger differences are exceptions: their low bits stay in place, and a list has their positions and
high bits. A file is

    "PFR1" | block ... | index | index size (u64) | ids (u64)
    block:  ids u16, width u8, exceptions u16, minimum u32, packed bits, positions u16 ..., high bits u32 ...
    index:  the start of every block, u64

so any block is found without reading those before it. Files are written by tasks under names of their own; a
manifest, written by Spark, names the files of the tasks that succeeded, with the documents' lengths. A task that is
repeated leaves a file that no manifest names.

Nulls and edge cases: a null or empty text has only the end id; a null id comes first in order; repeated rows are
separate documents, ordered by (id, hash of the text); an empty table gives no files and an empty result; long texts
are encoded in units, so nothing is cut off.
"""

from __future__ import annotations

import os
import posixpath
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.units import IdPool, parted, strings
from tidemark.plans.bounds import run_dir

BLOCK = 4096
WIDTH_SHARE = 0.97
END_ID = 2
MAGIC = b"PFR1"
#: Texts of about this size are encoded at once: more of them share their words.
SLICE_BYTES = 6 << 20
_HEAD = struct.Struct("<HBHI")


def pack_block(ids: np.ndarray, share: float = WIDTH_SHARE) -> bytes:
    """One block of at most 65,535 ids below 2**32."""
    low = int(ids.min())
    rest = (ids - low).astype(np.uint32)
    widths = np.frexp(rest.astype(np.float64))[1]
    at = min(len(ids) - 1, int(share * len(ids)))
    width = int(np.partition(widths, at)[at])
    odd = np.flatnonzero(widths > width)
    # One plane of bits after the other.
    bits = ((rest >> np.arange(width, dtype=np.uint32)[:, None]) & 1).astype(np.uint8)
    packed = np.packbits(bits, axis=1, bitorder="little").tobytes()
    high = rest[odd] >> np.uint32(width) if width < 32 else rest[odd]
    return (
        _HEAD.pack(len(ids), width, len(odd), low)
        + packed
        + odd.astype("<u2").tobytes()
        + high.astype("<u4").tobytes()
    )


def unpack_block(data: bytes, at: int) -> np.ndarray:
    """The ids of the block that starts at ``at``."""
    n, width, n_odd, low = _HEAD.unpack_from(data, at)
    at += _HEAD.size
    size = (n + 7) // 8 * width
    planes = np.frombuffer(data, np.uint8, size, at).reshape(width, (n + 7) // 8)
    rest = np.zeros(n, np.uint32)
    for j, bits in enumerate(np.unpackbits(planes, axis=1, count=n, bitorder="little")):
        rest |= bits.astype(np.uint32) << np.uint32(j)
    at += size
    odd = np.frombuffer(data, "<u2", n_odd, at)
    high = np.frombuffer(data, "<u4", n_odd, at + 2 * n_odd)
    rest[odd] |= high.astype(np.uint32) << np.uint32(width)
    return rest + np.uint32(low)


class BlockFile:
    """Writes one file block by block; holds one unfinished block and the index."""

    def __init__(self, sink, share: float = WIDTH_SHARE, block: int = BLOCK):
        self.sink, self.share, self.block = sink, share, block
        self.at, self.ids, self.starts, self.rest = len(MAGIC), 0, [], np.zeros(0, np.uint32)
        sink.write(MAGIC)

    def write(self, ids: np.ndarray) -> None:
        ids = np.concatenate([self.rest, ids.astype(np.uint32)])
        whole = len(ids) // self.block * self.block
        for i in range(0, whole, self.block):
            self._put(ids[i : i + self.block])
        self.rest = ids[whole:]

    def _put(self, ids: np.ndarray) -> None:
        data = pack_block(ids, self.share)
        self.starts.append(self.at)
        self.at += len(data)
        self.ids += len(ids)
        self.sink.write(data)

    def close(self) -> None:
        if len(self.rest):
            self._put(self.rest)
        index = np.array(self.starts, "<u8").tobytes()
        self.sink.write(index + struct.pack("<QQ", len(index), self.ids))


def block_starts(data: bytes) -> np.ndarray:
    if data[:4] != MAGIC:
        raise ValueError("not a token block file")
    size = struct.unpack_from("<Q", data, len(data) - 16)[0]
    return np.frombuffer(data, "<u8", size // 8, len(data) - 16 - size).astype(np.int64)


def read_ids(data: bytes, first: int, last: int, block: int = BLOCK) -> np.ndarray:
    """Ids ``first`` up to ``last`` (exclusive) of a file, from the blocks that hold them."""
    if last <= first:
        return np.zeros(0, np.uint32)
    starts = block_starts(data)
    parts = [unpack_block(data, starts[i]) for i in range(first // block, (last - 1) // block + 1)]
    skip = first // block * block
    return np.concatenate(parts)[first - skip : last - skip]


_pools: dict[str, IdPool] = {}
#: Words of these characters only are lower-cased and parted here as the tokenizer does it; others go to it whole.
_PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]+").fullmatch
_ALL_PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ\n]*").fullmatch
#: Parts of words that stand one to a line; the line ends are parts too.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+|\n").findall


def word_encoder(vocabulary: str) -> IdPool:
    """Encoder of lists of words. Words part at white space, which the tokenizer drops anyway.

    Plain words share their parts (letters, digits, signs): "Word," and "word" need one part each to be encoded. The
    parts of a slice go to the tokenizer in one text; a part's last id is one that ends a word.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(vocabulary)
    ends = np.zeros(known.get_vocab_size(), bool)
    ends[[i for token, i in known.get_vocab().items() if token.endswith("</w>")]] = True

    def whole(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in known.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for x in ids for i in x], np.int32), np.array([len(x) for x in ids], np.int64)

    def together(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        runs = [" ".join(parts[i : i + 1000]) for i in range(0, len(parts), 1000)]
        flat = np.concatenate([np.array(e.ids, np.int32) for e in known.encode_batch_fast(runs, add_special_tokens=False)])
        last = np.flatnonzero(ends[flat])
        if len(last) != len(parts) or not ends[flat[-1]]:
            return whole(parts)
        return flat, np.diff(np.concatenate([[-1], last]))

    pieces = IdPool(together)

    def by_parts(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        coded = pa.array(_PARTS("\n".join(words).lower()), pa.large_string()).dictionary_encode()
        distinct, code = strings(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False)
        gap = distinct.index("\n") if len(words) > 1 else -1
        ends = np.flatnonzero(code == gap)
        upto = np.concatenate([[-1], ends, [len(code)]])
        if gap >= 0:
            distinct[gap] = distinct[gap - 1]  # No part; this number is not used.
        if pieces.used > pieces.limit:
            pieces.clear()
        return pieces.of_numbers(pieces.numbers(distinct)[code[code != gap]], np.diff(upto) - 1)

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "\n".join(words)
        if "<|" not in joined and _ALL_PLAIN(joined) and joined.count("\n") == len(words) - 1 and "" not in words:
            return by_parts(words)
        plain = [i for i, w in enumerate(words) if _PLAIN(w) and "<|" not in w]
        odd = sorted(set(range(len(words))) - set(plain))
        flat = [by_parts([words[i] for i in plain]), whole([words[i] for i in odd])]
        length = np.zeros(len(words), np.int64)
        length[plain], length[odd] = flat[0][1], flat[1][1]
        start = np.cumsum(length) - length
        ids = np.zeros(int(length.sum()), np.int32)
        for rows, (own, n) in zip((plain, odd), flat):
            ids[np.repeat(start[rows] - (np.cumsum(n) - n), n) + np.arange(len(own))] = own
        return ids, length

    return WordEncoder(encode, pieces)


class WordEncoder(IdPool):
    """Words over parts; both are forgotten together."""

    def __init__(self, encode, parts: IdPool):
        self.parts = parts
        super().__init__(encode)

    def clear(self) -> None:
        super().clear()
        self.parts.clear()


def _pool(vocabulary: str) -> IdPool:
    """The encoder of this worker. Later tasks of the worker find the words of earlier ones, within the pool's limit."""
    if vocabulary not in _pools:
        _pools[vocabulary] = word_encoder(vocabulary)
    return _pools[vocabulary]


def _units(text: str | None) -> list[str]:
    """The words of one text, and empty ones between white space; ``parted`` takes many texts."""
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if text else []


def _write_files(vocabulary: str, path: str, end_id: int, share: float, file_ids: int):
    """A task writes its sorted documents to files and returns a manifest row per file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = _pool(vocabulary)
        store, folder = pafs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        name = out = sink = None
        docs, counts, task, part = [], [], TaskContext.get().partitionId(), 0

        def done() -> pa.RecordBatch:
            out.close()
            sink.close()
            return pa.RecordBatch.from_pydict(
                {"file": [name], "task": [task], "part": [part], "n_ids": [out.ids], "doc_ids": [docs], "counts": [counts]},
                schema=_MANIFEST,
            )

        for batch in batches:
            texts = batch.column("text")
            ids = batch.column("doc_id").to_pylist()
            upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            begin = 0
            while begin < len(ids):
                # Documents up to the one that reaches the size of a slice.
                before = int(upto[begin - 1]) if begin else 0
                end = min(len(ids), int(np.searchsorted(upto, before + SLICE_BYTES)) + 1)
                flat, n = pool.of_words(*parted(texts.slice(begin, end - begin)))
                # The end id goes after every document.
                with_end = np.full(len(flat) + len(n), end_id, np.uint32)
                spot = np.arange(len(flat)) + np.repeat(np.arange(len(n)), n)
                with_end[spot] = flat
                if out is None:
                    name, docs, counts = f"{uuid.uuid4().hex}.pfr", [], []
                    sink = store.open_output_stream(posixpath.join(folder, name))
                    out = BlockFile(sink, share)
                out.write(with_end)
                docs += ids[begin:end]
                counts += (n + 1).tolist()
                begin = end
                if out.ids >= file_ids:
                    yield done()
                    out, part = None, part + 1
        if out is not None:
            yield done()

    return write


_MANIFEST = pa.schema([
    ("file", pa.string()), ("task", pa.int64()), ("part", pa.int64()), ("n_ids", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
])
MANIFEST = "file string, task bigint, part bigint, n_ids bigint, doc_ids array<bigint>, counts array<bigint>"


def write_token_files(
    docs: DataFrame, vocabulary: str, path: str, end_id: int = END_ID, share: float = WIDTH_SHARE, file_ids: int = 8_000_000
) -> DataFrame:
    """Encode all documents in ascending id order into files below ``path``; returns the manifest.

    The range partitioning moves every text once. ``path`` is a URI or a folder that all executors share.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    ranged = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    manifest = ranged.mapInArrow(_write_files(vocabulary, path, end_id, share, file_ids), MANIFEST)
    manifest.write.parquet(f"{path}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _read_back(path: str):
    """A task opens the files of its manifest rows and describes their documents."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(posixpath.join(folder, row["file"])) as file:
                    data = file.read()
                counts = np.array(row["counts"], np.int64)
                edges = np.concatenate([[0], np.cumsum(counts)])
                crc = np.zeros(len(counts), np.int64)
                # Documents in runs of about a million ids, so that the decoded ids stay small.
                begin = 0
                while begin < len(counts):
                    end = max(begin + 1, int(np.searchsorted(edges, edges[begin] + (1 << 20), "right")) - 1)
                    ids = read_ids(data, int(edges[begin]), int(edges[end])).astype("<u4")
                    for i in range(begin, end):
                        crc[i] = zlib.crc32(ids[edges[i] - edges[begin] : edges[i + 1] - edges[begin]])
                    begin = end
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": pa.array(row["before"] + edges[:-1], pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                })

    return read


def read_token_files(manifest: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files that the manifest names."""
    # One short row per file: the ids before it. Tasks follow each other as the ranges of ids do.
    order = Window.orderBy("task", "part").rowsBetween(Window.unboundedPreceding, -1)
    before = manifest.select("file", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before"))
    named = manifest.select("file", "doc_ids", "counts").join(before, "file")
    # The manifest is small beside the files. A number of tasks and a key of their own keep it from being read by
    # one task: adaptive execution would join the few rows together.
    spread = named.repartition(max(1, manifest.count()), F.xxhash64("file"))
    return spread.mapInArrow(_read_back(path), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_files(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Write the files below the shared folder and read them back."""
    path = run_dir(docs.sparkSession, "tokens")
    if "://" not in path and not path.startswith("file:"):
        path = f"file://{os.path.abspath(path)}"
    return read_token_files(write_token_files(docs, vocabulary, path, **options), path)
