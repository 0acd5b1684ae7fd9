"""Chat formatting of reply trees: root-to-leaf paths, branches ranked by score, one conversation per chosen path.

Messages point to their parent. Iterative self-joins double the reach of these pointers, so a thread of n messages
takes log2(n) joins; the stored pointers then list the messages of the chosen paths, again one join per doubling.
Only the chosen paths are listed, and texts are joined last.

The template opens a conversation with ``<s>`` and sets a turn as ``open text close``, with a blank on both sides of
the text. A control string inside a text, and any backslashes before it, get one more backslash, which reading
takes away again, so every text comes back as it was and none can end a turn.

Nulls and edge cases: a null text is empty; a null role is kept as null; a null score counts as 0; a null parent or
one that does not exist makes a root; messages that only lead into a circle are in no path; of several messages
with one id in a tree the smallest by (score, role, text) counts; repeated rows count once in trees and are kept in
linear conversations; an empty table gives an empty result. One formatted conversation is one record and must fit
in memory, as any row must.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.bounds import stored

BEGIN = "<s>"
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")}
OTHER = ("[ROLE=", "[/ROLE]")
_CONTROL = "|".join(re.escape(x) for x in [BEGIN, *(m for pair in MARKS.values() for m in pair), *OTHER])
_ESCAPE = re.compile(rf"(\\*)({_CONTROL})")
_UNESCAPE = re.compile(rf"\\(\\*)({_CONTROL})")
_CLOSE = {role: re.compile(rf"(?<!\\){re.escape(close)}") for role, (_, close) in {**MARKS, None: OTHER}.items()}


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def render(turns: Iterable[tuple[str | None, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the (start, end) code points of what the loss counts: assistant texts."""
    parts, at, loss = [BEGIN], len(BEGIN), []
    for role, text in turns:
        if role in MARKS:
            first, last = MARKS[role]
        else:
            first, last = f"{OTHER[0]}{json.dumps(role, ensure_ascii=False)}]", OTHER[1]
        body = escape(text)
        start = at + len(first) + 1
        if role == "assistant":
            loss.append((start, start + len(body)))
        parts.append(f"{first} {body} {last}")
        at = start + len(body) + 1 + len(last)
    return "".join(parts), loss


def parse(formatted: str) -> list[tuple[str | None, str]]:
    """Read the turns back."""
    if not formatted.startswith(BEGIN):
        raise ValueError("not a formatted conversation")
    at, turns = len(BEGIN), []
    while at < len(formatted):
        for role, (first, _) in MARKS.items():
            if formatted.startswith(first, at):
                at, close = at + len(first), _CLOSE[role]
                break
        else:
            if not formatted.startswith(OTHER[0], at):
                raise ValueError(f"no turn at {at}")
            role, at = json.JSONDecoder().raw_decode(formatted, at + len(OTHER[0]))
            at, close = at + 1, _CLOSE[None]
        end = close.search(formatted, at)
        turns.append((role, unescape(formatted[at + 1 : end.start() - 1])))
        at = end.end()
    return turns


def _pointers(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the ancestors at distance 1, 2, 4, ... and (tree, node, depth, total score up to the root)."""
    known = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    up = nodes.join(known, (F.col("tree") == F.col("t")) & (F.col("parent") == F.col("n")), "left").select(
        "tree", "node", F.col("n").alias("up"), F.coalesce("score", F.lit(0.0)).alias("total"), F.lit(1).alias("depth")
    )
    tables, left = [], -1
    while True:
        up = stored(up, "chat_pointers")
        n = up.where("up IS NOT NULL").count()
        if not n or n == left:
            break
        tables.append(up)
        far = up.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("_up"), F.col("total").alias("_total"), F.col("depth").alias("_depth"))
        up = up.join(far, (F.col("tree") == F.col("t")) & (F.col("up") == F.col("n")), "left").select(
            "tree", "node", F.col("_up").alias("up"),
            (F.col("total") + F.coalesce("_total", F.lit(0.0))).alias("total"),
            (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
        )
        left = n
    # What still points somewhere is on its way around a circle.
    return tables, up.where("up IS NULL").select("tree", "node", "depth", "total")


def chosen_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, leaf, rank, place, node) of the ``top`` best branches of every tree, by mean score, then length.

    ``messages`` has tree, node, parent, score.
    """
    nodes = stored(messages.select("tree", "node", "parent", F.col("score").cast("double").alias("score")), "chat_nodes")
    tables, paths = _pointers(nodes)
    parents = nodes.select(F.col("tree").alias("t"), F.col("parent").alias("p")).where("p IS NOT NULL").distinct()
    leaves = paths.join(parents, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("p")), "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("depth")), F.desc("depth"), "node")
    leaves = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    listed = leaves.select("tree", F.col("node").alias("leaf"), "rank", F.col("depth").alias("place"), "node")
    for i in range(len(tables) - 1, -1, -1):
        step = tables[i].where("up IS NOT NULL").select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        more = listed.join(step, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("n"))).select(
            "tree", "leaf", "rank", (F.col("place") - 2**i).cast("int").alias("place"), F.col("up").alias("node")
        )
        listed = stored(listed.unionByName(more), "chat_paths")
    return listed


def _render_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns of one path follow each other in the sorted partition; one conversation is held at a time."""
    key, turns, out, size = None, [], [], 0

    def flush() -> pa.RecordBatch:
        names = ["tree", "leaf", "rank", "formatted", "loss"]
        return pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in out], schema=_FORMATTED)

    def close() -> int:
        if key is None:
            return 0
        formatted, loss = render(turns)
        out.append((*key, formatted, [{"start": a, "end": b} for a, b in loss]))
        return len(formatted)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("tree", "leaf", "rank", "role", "text")]
        for tree, leaf, rank, role, text in zip(*columns):
            if (tree, leaf, rank) != key:
                size += close()
                key, turns = (tree, leaf, rank), []
                if size > 1 << 22:
                    yield flush()
                    out, size = [], 0
            turns.append((role, text or ""))
    close()
    yield flush()


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FORMATTED = pa.schema([("tree", pa.int64()), ("leaf", pa.int64()), ("rank", pa.int32()), ("formatted", pa.string()), ("loss", _SPAN)])


def format_trees(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, leaf, rank, formatted, loss) from messages with tree, node, parent, score, role, text (ids are longs)."""
    ids = [F.col(c).cast("bigint").alias(c) for c in ("tree", "node", "parent")]
    rest = F.struct(F.col("score").cast("double").alias("score"), "role", "text", "parent")
    whole = messages.select(*ids, "score", "role", "text").where("tree IS NOT NULL AND node IS NOT NULL")
    whole = whole.groupBy("tree", "node").agg(F.min(rest).alias("m")).select("tree", "node", "m.*")
    paths = chosen_paths(whole, top)
    said = whole.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text")
    turns = paths.join(said, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("n")))
    placed = turns.select("tree", "leaf", "rank", "place", "role", "text").repartition("tree", "leaf")
    return placed.sortWithinPartitions("tree", "leaf", "place").mapInArrow(
        _render_rows, "tree bigint, leaf bigint, rank int, formatted string, loss array<struct<start:bigint,end:bigint>>"
    )


def as_tree(turns: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as trees of one branch; ties by role and text.

    A null conversation id is the smallest long.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    numbered = turns.select(F.coalesce("conv_id", F.lit(-(2**63))).alias("tree"), "turn", "role", "text")
    return numbered.select("tree", F.row_number().over(order).cast("bigint").alias("node"), "role", "text").select(
        "tree", "node", (F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text"
    )


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            turns = parse(row["formatted"])
            said, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
            for role, text in turns:
                said.update(f"{role or ''}\n{text}\n".encode())
            for span in row["loss"]:
                text = unescape(row["formatted"][span["start"] : span["end"]])
                loss.update(text.encode())
                chars += len(text)
            out.append({
                "tree": row["tree"], "n_turns": len(turns), "turns_sha256": said.hexdigest(), "loss_chars": chars,
                "loss_sha256": loss.hexdigest(), "formatted_chars": len(row["formatted"]),
            })
        yield pa.RecordBatch.from_pylist(out, schema=_DIGESTS)


_DIGESTS = pa.schema([
    ("tree", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say, read back from them."""
    return formatted.select("tree", "formatted", "loss").mapInArrow(
        _digest_rows,
        "tree bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
