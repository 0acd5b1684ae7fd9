"""Mixing sources to target weights by exponential keys (weighted sampling without replacement).

A source's target is its share of all words by weight, held to a multiple of what the source has; the excess
goes to the others by weight until no source is above its limit. A source gives whole epochs first; what is
left of its target is filled by documents in the order of their exponential keys: ``-ln(u) / quality``, where
``u`` comes from a digest of the document's id, so every run takes the same documents.

Nulls and edge cases: a null text has no words; a null source is a source of its own, last in order; a null or
non-positive quality counts as 1; documents without words are taken in every whole epoch and wherever a source has
room for a word, and give no words;
a source without words has target 0; repeated rows with one id are separate documents with equal keys, ordered
by size and then by a hash of where they are stored, and so are rows with a null id (with ``by_text``, only those
whose texts are equal too); an empty table gives an empty result. Columns of the input that clash are not used.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.llm.rows import ADDRESS, addressed, plain_scan
from tidemark.plans.bounds import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: A source's key range is cut into cells of about this many documents of the corpus, CELLS at most, before its
#: documents are summed up. Only cells in which a budget ends are gone through in order.
CELL_ROWS, CELLS = 2048, 4096


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) from a digest of ``key``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(2**48)


def ranked_sources(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Sources by code point, null last, with repeating weights.

    The position of a source is counted within its first two code points and added to what comes before, so no
    task orders all sources.
    """
    head = F.substring("source", 1, 2)
    keyed = sizes.withColumn("_head", head)
    heads = keyed.groupBy("_head").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(
        F.sum("_n").over(Window.orderBy(F.asc_nulls_last("_head")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    heads = heads.select(F.col("_head").alias("_of"), before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_head").orderBy(F.asc_nulls_last("source")))
    place = F.col("_before") + F.col("_inside") - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    return (
        keyed.withColumn("_inside", inside)
        .join(heads, F.col("_head").eqNullSafe(F.col("_of")))
        .select("source", "source_size", "n_docs", weight.cast("bigint").alias("weight"))
    )


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target``: every source's share by weight, at most ``max_epochs`` times its size.

    Each pass is one aggregation to one row: the sources above their limit are held at it, and the rest shares
    what they leave. The level only rises, so the passes end when no further source reaches its limit.
    """
    limit = F.col("source_size") * max_epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    left, weight, held = total, None, -1
    while True:
        share = F.lit(False) if weight is None else F.col("weight") * F.lit(left) > limit * F.lit(weight)
        row = sources.agg(
            F.count_if(share).alias("n"),
            F.coalesce(F.sum(F.when(share, limit)), F.lit(0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~share, F.col("weight"))), F.lit(0)).alias("free"),
        ).first()
        if row["n"] == held or not row["free"]:
            break
        held, left, weight = row["n"], total - row["fixed"], row["free"]
    if not weight:
        return sources.withColumn("target", F.lit(0.0))
    wanted = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(weight))
    over = F.col("weight") * F.lit(left) > limit * F.lit(weight)
    return sources.withColumn("target", F.when(over, limit.cast("double")).otherwise(wanted))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality: DataFrame | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 11,
    cells: int | None = None,
    by_text: bool = False,
) -> DataFrame:
    """How often every document is taken: (doc_id, source, size, source_size, target, times, taken) and its address.

    ``quality`` has one row (doc_id, quality) per rated document; the others count as 1. The fractional selection goes
    on in key order after a document that does not fit, and takes at last one more if that brings the source nearer to
    its target; so a source misses it by less than the smallest document left out. ``by_text`` derives the keys from id and text, so that null and repeated ids have keys of
    their own. Addresses are those of ``docs`` if it has them (``addressed``).
    """
    if not set(ADDRESS) <= set(docs.columns):
        docs = addressed(docs.select(id_col, text_col, source_col))
    name = F.col(id_col)
    if by_text:
        name = F.concat_ws(":", F.coalesce(name.cast("string"), F.lit("null")), F.md5(F.coalesce(text_col, F.lit(""))))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"),
        uniform(name, seed).alias("u"), *ADDRESS,
    )
    if quality is not None:
        rated = quality.groupBy("doc_id").agg(F.max("quality").alias("quality"))
        rows = rows.join(rated, "doc_id", "left")
    else:
        rows = rows.withColumn("quality", F.lit(1.0))
    good = F.when(F.col("quality") > 0, F.col("quality")).otherwise(F.lit(1.0))
    key = -F.log(F.col("u")) / good
    rows = stored(rows.withColumn("key", key).drop("quality", "u"), "mix_rows")
    if cells is None:
        cells = min(CELLS, max(1, rows.count() // CELL_ROWS))
    # The share of keys below this one if all had weight 1: cells hold about equally many documents.
    cell = F.least(F.floor((1 - F.exp(-F.col("key"))) * cells), F.lit(cells - 1)).cast("int")
    rows = rows.withColumn("cell", cell)

    per_cell = stored(rows.groupBy("source", "cell").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")), "mix_cells")
    sizes = per_cell.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("n").alias("n_docs"))
    # The ranking is stored, else every pass of the targets ranks and broadcasts anew.
    plan = stored(targets(stored(ranked_sources(sizes, weights), "mix_ranks"), max_epochs), "mix_plan")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("epochs", epochs.cast("bigint")).withColumn(
        "left", F.col("target") - F.col("epochs") * F.col("source_size")
    )
    grid = per_cell.select("source", "cell")
    rounds, picks = _fill(rows, grid, plan.select(F.col("source").alias("_of"), F.floor("left").cast("bigint").alias("room")))

    # One row per source and cell: documents up to `most` words are taken; `rest` is what no document fits into.
    same = F.col("source").eqNullSafe(F.col("_of"))
    between = same & (F.col("cell") > F.col("after")) & (F.col("cell") < F.coalesce("cut", F.lit(cells)))
    most = grid.join(rounds, between).select(F.col("source").alias("_s"), F.col("cell").alias("_c"), F.col("room").alias("most"))
    rests = rounds.groupBy(F.col("_of")).agg(F.min("rest").alias("rest"))
    of_source = plan.drop("weight", "n_docs").join(rests, same, "left").drop("_of").withColumnRenamed("source", "_of")
    edges = grid.join(of_source, same).join(most, F.col("source").eqNullSafe(F.col("_s")) & (F.col("cell") == F.col("_c")), "left")
    edges = edges.select(F.col("source").alias("_source"), F.col("cell").alias("_cell"), "source_size", "target", "epochs", "left", "rest", "most")
    # Stored, for every later step joins it: else each of them plans and broadcasts all rounds anew, in the driver's memory.
    edges = stored(edges, "mix_edges")
    placed = rows.join(edges, F.col("source").eqNullSafe(F.col("_source")) & (F.col("cell") == F.col("_cell")))
    whole = F.when(F.col("size") > 0, F.coalesce(F.col("size") <= F.col("most"), F.lit(False))).otherwise(F.col("left") >= 1)

    # One more document of a source where that brings it nearer to its target.
    gap = F.coalesce("rest", F.lit(0)) + F.col("left") - F.floor("left")
    open_ = _picked(placed, picks).where(~whole & (F.col("size") > 0) & (F.coalesce("_m", F.lit(0)) < F.coalesce("_n", F.lit(1))))
    nearer = open_.where(F.col("size") < 2 * gap).groupBy("source").agg(F.min(F.struct(*_ORDER)).alias("x"))
    one = nearer.select("source", "x.*", F.lit(1).cast("bigint").alias("m"), F.lit(None).cast("bigint").alias("n"))
    alike = ["source", *_ORDER]
    merged = picks.unionByName(one).groupBy(*alike).agg(F.sum("m").alias("m"), F.max("n").alias("n"))
    joined = _picked(placed, stored(merged, "mix_picks"))
    among = F.col("_m").isNotNull() & (F.col("_n").isNull() | (F.col("_m") < F.col("_n")))
    sure = joined.where(~among).withColumn("extra", whole | F.col("_m").isNotNull())
    some = _first_rows(joined.where(among))
    times = F.col("epochs") + F.col("extra").cast("bigint")
    columns = ["doc_id", "source", "size", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken"), *ADDRESS]
    return sure.select(*columns).unionByName(some.select(*columns))


_ORDER = ("key", "doc_id", "size")


def _fill(rows: DataFrame, grid: DataFrame, rooms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fill the room of every source in key order: a document that does not fit is left out, and the filling goes on.

    A round sums up, by cell, the documents that would fit, up to the cell where the room ends. The cells before it are
    taken whole; that one cell is gone through in order, and the next round begins after it with the room that is
    left. Returns the rounds (_of, after, cut, room, rest): documents of at most ``room`` words in the cells between
    ``after`` and ``cut`` are taken; and the documents taken in cut cells (source, key, doc_id, size, m of n alike).
    """
    spark = rows.sparkSession
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("source", "cell", *_ORDER))
    in_cell = F.col("source").eqNullSafe(F.col("_source")) & (F.col("cell") == F.col("_cell"))
    same = F.col("source").eqNullSafe(F.col("_of"))
    sized, rounds, cuts = rows.where("size > 0"), [], []
    # How many sources go on is counted while they are stored: every job more costs the driver buffers and threads.
    going = Observation()
    opened = rooms.where("room >= 1").withColumn("after", F.lit(-1))
    state = stored(opened.observe(going, F.count(F.lit(1)).alias("n")), "mix_state")
    while going.get["n"]:
        ahead = grid.join(state, same).where("cell > after").select(F.col("source").alias("_source"), F.col("cell").alias("_cell"), "room")
        fitting = sized.join(ahead, in_cell).where("size <= room")
        words = fitting.groupBy("source", "cell").agg(F.sum("size").alias("words"), F.first("room").alias("room"))
        upto = words.withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("cell")))
        ends = upto.groupBy("source").agg(
            F.min(F.when(F.col("upto") > F.col("room"), F.struct("cell", (F.col("room") - F.col("upto") + F.col("words")).alias("start")))).alias("e"),
            F.sum("words").alias("all"),
        )
        ends = ends.select("source", F.col("e.cell").alias("cut"), F.col("e.start").alias("start"), "all")
        turn = state.join(ends, same, "left").drop("source")
        turn = stored(turn.withColumn("all", F.coalesce("all", F.lit(0))), "mix_turn")
        edge = turn.where("cut IS NOT NULL").select(F.col("_of").alias("_source"), F.col("cut").alias("_cell"), "room", "start")
        inside = sized.join(edge, in_cell).where("size <= room").groupBy("source", "cell", *_ORDER)
        alike = inside.agg(F.count(F.lit(1)).alias("n"), F.first("start").alias("start"))
        cut = stored(alike.groupBy("source", "cell").applyInArrow(_in_order, f"{kinds}, n bigint, m bigint, rest bigint"), "mix_cut")
        cuts.append(cut.where("m > 0").select("source", *_ORDER, "m", "n"))
        left = cut.groupBy("source").agg(F.first("rest").alias("left"))
        done = turn.join(left, same, "left").drop("source")
        done = done.select("_of", "after", "cut", "room", F.coalesce("left", F.col("room") - F.col("all")).alias("rest"))
        going, more = Observation(), F.expr("cut IS NOT NULL AND rest >= 1")
        done = stored(done.observe(going, F.count_if(more).alias("n")), "mix_round")
        rounds.append(done)
        state = done.where(more).select("_of", F.col("rest").alias("room"), F.col("cut").alias("after"))
    if not rounds:
        of = rows.schema["source"].dataType.simpleString()
        kind = f"_of {of}, after int, cut int, room bigint, rest bigint"
        return spark.createDataFrame([], kind), rows.select("source", *_ORDER, F.col("size").alias("m"), F.col("size").alias("n")).where("false")
    # One table each, not a branch for every round in the plans that follow.
    return stored(reduce(DataFrame.unionByName, rounds), "mix_rounds"), stored(reduce(DataFrame.unionByName, cuts), "mix_cuts")


def _in_order(table: pa.Table) -> pa.Table:
    """One cell of one source in order: of every alike documents as many as fit into what is left."""
    table = table.sort_by([(c, "ascending") for c in _ORDER])
    rest, taken = table.column("start")[0].as_py(), []
    for size, n in zip(table.column("size").to_pylist(), table.column("n").to_pylist(), strict=True):
        taken.append(min(n, rest // size))
        rest -= taken[-1] * size
    table = table.drop_columns(["start"]).append_column("m", pa.array(taken, pa.int64()))
    return table.append_column("rest", pa.array([rest] * len(taken), pa.int64()))


def _picked(rows: DataFrame, picks: DataFrame) -> DataFrame:
    """Add ``_m`` and ``_n``: of the documents alike, how many are taken, null where none of them was picked."""
    names = {c: f"_p_{c}" for c in ("source", *_ORDER)}
    on = [F.col(c).eqNullSafe(F.col(p)) for c, p in names.items()]
    few = picks.withColumnsRenamed({**names, "m": "_m", "n": "_n"})
    return rows.join(few, reduce(lambda a, b: a & b, on), "left").drop(*names.values())


def _first_rows(alike: DataFrame, parts: int = CELLS) -> DataFrame:
    """Mark ``_m`` of the rows alike by the hash of their address, counted in parts of it."""
    by = ["source", *_ORDER, "_part"]
    rows = alike.withColumn("_part", F.pmod(F.xxhash64(*ADDRESS), F.lit(parts)))
    per_part = rows.groupBy(*[F.col(c).alias(f"_q_{c}") for c in by]).agg(F.count(F.lit(1)).alias("_count"))
    earlier = Window.partitionBy(*[f"_q_{c}" for c in by[:-1]]).orderBy("_q__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.withColumn("_start", F.coalesce(F.sum("_count").over(earlier), F.lit(0)))
    number = F.row_number().over(Window.partitionBy(*by).orderBy(*ADDRESS))
    on = [F.col(c).eqNullSafe(F.col(f"_q_{c}")) for c in by]
    placed = rows.withColumn("_number", number).join(starts, reduce(lambda a, b: a & b, on))
    return placed.withColumn("extra", F.col("_start") + F.col("_number") <= F.col("_m"))


def document_quality(labels: DataFrame) -> DataFrame:
    """Quality weights of labelled documents: 2 for good ones, 0.5 for bad ones."""
    return labels.groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 2.0).otherwise(0.5)).alias("quality"))


def apply_mix(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents as often as they are taken; with the columns of ``docs``, without addresses.

    ``docs`` is what ``mix`` was given: a plain scan of files, or any frame that ``addressed`` returned.
    """
    if not set(ADDRESS) <= set(docs.columns):
        if not plain_scan(docs):
            raise ValueError("docs has no addresses: give mix and apply_mix the same addressed frame")
        docs = addressed(docs)
    picks = mixed.where("times > 0").select(*ADDRESS, F.col("times").cast("int").alias("_times"))
    copies = F.sequence(F.lit(1), F.col("_times"))
    columns = [c for c in docs.columns if c not in ADDRESS]
    return docs.join(picks, list(ADDRESS)).withColumn("_copy", F.explode(copies)).select(*columns)
