"""Quality rules with an isolation forest over their statistics.

One pass counts what the rules need in every whole text. Trees of random splits are grown over the statistics of a
bounded sample of documents labelled good; a document that few splits set apart is unlike them. Splits are drawn from a
box wider than the sample, so the empty space around it is cut too: a document far out comes into a leaf without rows
after few splits, one just outside after more. The path lengths alone make the score. The threshold is calibrated on all
labelled rows, good and bad: a given share of the good ones may be lost, more only for many bad ones each. A document is
kept when the base rule holds and its score is not above the threshold.

Nulls and edge cases: a null or empty text has no words and fails the base rule; labels without a document or with a
null quality are not used; several labels of one id count as good if one is; without good labels the forest judges
nothing and the base rule decides; repeated rows are judged alike, and equal rows count once in the sample; an empty table gives an empty result; other
columns of the documents are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.units import Words, slices
from tidemark.plans.bounds import stored

MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
TREES, SAMPLE = 128, 256
#: How far splits go beyond the rows of a tree, on either side, as a multiple of their range.
BEYOND = 3.0
#: Distinct labelled rows that the forest is fitted on at most: those with the smallest hash.
FIT_ROWS = 16_384
LOSS = 0.002
#: Bad rows that the threshold must set apart for every good row it loses beyond LOSS.
PRICE = 10
BINS = 4096

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_distinct", "n_bars"]
FEATURES = ["symbols", "repeated", "upper", "marks", "distinct", "word_length", "dup_lines", "bars"]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?;:=+~^_\"'()[]{}\\/@`-")] = True
_BLANK = b"\t\n\x0b\x0c\r "


def text_stats(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Counts per text; texts are UTF-8."""
    w = Words(texts)
    lead = w.inside & ((w.buf & 0xC0) != 0x80)
    grams, first = w.grams(WINDOW)
    # A window counts as repeated within its own text only.
    keyed = grams + w.text[first].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    _, back, n = np.unique(keyed, return_inverse=True, return_counts=True)
    cover = np.zeros(len(w.start) + 1, np.int64)
    again = first[n[back] > 1]
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0
    own = w.hashes() + w.text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    distinct = np.unique(own, return_index=True)[1]
    dup = []
    for t in texts:
        lines = [x for x in t.split(b"\n") if x.strip(_BLANK)]
        dup.append(len(lines) - len(set(lines)))
    return {
        "n_words": w.count,
        "word_chars": w.per_text(lead),
        "n_symbols": w.per_text(_SYMBOL[w.buf]),
        "n_dup_lines": np.array(dup, np.int64),
        "n_repeat_words": np.bincount(w.text[covered], minlength=w.n_texts),
        "n_upper": w.per_text(_UPPER[w.buf]),
        "n_marks": w.per_text(_MARK[w.buf]),
        "n_distinct": np.bincount(w.text[distinct], minlength=w.n_texts),
        "n_bars": w.per_text(w.buf == ord("|")),
    }


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start, texts in slices(batch["text"].tolist()):
            stats = pd.DataFrame(text_stats(texts))[STATS]
            stats.insert(0, "doc_id", batch["doc_id"].iloc[start : start + len(texts)].array)
            yield stats


def statistics(docs: DataFrame) -> DataFrame:
    kind = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in STATS)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(_count, kind)


def features(stats: pd.DataFrame) -> np.ndarray:
    """Rule statistics as rates, one row per document."""
    words = np.maximum(stats["n_words"].to_numpy(float), 1)
    chars = np.maximum(stats["word_chars"].to_numpy(float), 1)
    rate = lambda c, by: stats[c].to_numpy(float) / by
    return np.column_stack([
        rate("n_symbols", words), rate("n_repeat_words", words), rate("n_upper", chars), rate("n_marks", words),
        # Longer texts repeat more words; the square root of the length takes most of that out.
        rate("n_distinct", words) * np.sqrt(np.maximum(words, 100) / 100), chars / words,
        np.log1p(stats["n_dup_lines"].to_numpy(float)), rate("n_bars", words),
    ])


def grow_forest(x: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 5, beyond: float = BEYOND) -> list[tuple]:
    """Trees as (feature, split, left, right, path length at leaf) arrays, every one over a random part of ``x``.

    A node is a box; a split cuts it at a random place of a random feature, whether or not rows lie on both sides.
    """
    rng = np.random.default_rng(seed)
    depth = int(np.ceil(np.log2(max(2, min(sample, len(x))))))
    forest = []
    for _ in range(trees):
        rows = x[rng.choice(len(x), min(sample, len(x)), replace=False)]
        margin = beyond * np.maximum(np.ptp(rows, axis=0), 1e-3)
        nodes: list[list[float]] = []
        todo = [(rows, rows.min(axis=0) - margin, rows.max(axis=0) + margin, 0, -1, 0)]
        while todo:
            part, low, high, level, parent, side = todo.pop()
            at = len(nodes)
            if parent >= 0:
                nodes[parent][2 + side] = at
            if level >= depth or len(part) <= 1:
                nodes.append([-1, 0.0, at, at, level + average_path(len(part))])
                continue
            j = int(rng.integers(x.shape[1]))
            cut = low[j] + rng.random() * (high[j] - low[j])
            nodes.append([j, cut, 0, 0, 0.0])
            below, above = high.copy(), low.copy()
            below[j] = above[j] = cut
            under = part[:, j] <= cut
            todo += [(part[under], low, below, level + 1, at, 0), (part[~under], above, high, level + 1, at, 1)]
        a = np.array(nodes)
        forest.append((a[:, 0].astype(np.int64), a[:, 1], a[:, 2].astype(np.int64), a[:, 3].astype(np.int64), a[:, 4], depth))
    return forest


def average_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a tree of ``n`` rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def scores(x: np.ndarray, forest: list[tuple], sample: int = SAMPLE) -> np.ndarray:
    """Anomaly scores in (0, 1); higher is odder."""
    total = np.zeros(len(x))
    for feature, split, left, right, path, depth in forest:
        at = np.zeros(len(x), np.int64)
        for _ in range(depth):
            j = feature[at]
            go_left = x[np.arange(len(x)), np.maximum(j, 0)] <= split[at]
            at = np.where(j < 0, at, np.where(go_left, left[at], right[at]))
        total += path[at]
    return 2.0 ** (-total / len(forest) / max(average_path(sample), 1e-9))


def calibrated(cells: list[tuple[int, int, int]], loss: float = LOSS) -> int:
    """The highest cell of the score that is kept, from (cell, good rows, bad rows) in order.

    Good rows lost within the share ``loss`` cost nothing, each one beyond it as much as PRICE bad rows kept. The
    cheapest threshold is taken, of equal ones the highest; without bad rows the lowest within the share.
    """
    allowed, judged = loss * sum(good for _, good, _ in cells), any(bad for *_, bad in cells)
    lost, passed, best, least = 0, sum(bad for *_, bad in cells), BINS, None
    for cell, good, bad in reversed(cells):
        cost = max(0.0, lost - allowed) * PRICE + passed
        if least is None or cost < least or (not judged and cost <= least):
            best, least = cell, cost
        lost, passed = lost + good, passed - bad
    return best


def judge(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, loss: float = LOSS) -> DataFrame:
    """Statistics, ``base_failed``, ``score`` and ``kept`` of every document."""
    spark = docs.sparkSession
    stats = stored(statistics(docs), "rule_stats")
    rated = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    stats = stats.withColumn("base_failed", base)
    good = stats.where(~base).join(rated.where("quality = 1"), "doc_id").select("doc_id", *STATS).distinct()
    good = stored(good.withColumn("_h", F.xxhash64("doc_id", *STATS)), "rule_good")
    # A bounded sample: the threshold below still sees every labelled row. About twice as many as are taken are ordered,
    # whatever the number of tasks.
    place = F.col("_h").cast("double") / float(1 << 64) + 0.5
    low = good.where(place * good.count() < 2 * fit_rows)
    sample = low.orderBy("_h", "doc_id", *STATS).limit(fit_rows).select(*STATS).toPandas()
    if not len(sample):
        return stats.withColumns({"score": F.lit(None).cast("double"), "kept": ~F.col("base_failed")})
    x = features(sample)
    scale = np.maximum(np.percentile(x, 99, axis=0) - np.percentile(x, 1, axis=0), 1e-6)
    middle = np.median(x, axis=0)
    forest = grow_forest((x - middle) / scale)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(score=scores((features(batch) - middle) / scale, forest))

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema.fields)
    scored = stored(stats.mapInPandas(score, f"{kind}, score double"), "rule_scores")
    cells = (
        scored.where("NOT base_failed").join(rated, "doc_id")
        .groupBy(F.ceil(F.col("score") * BINS).cast("int").alias("cell"))
        .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") != 1).alias("bad"))
        .orderBy("cell").collect()
    )
    threshold = calibrated([(r["cell"], r["good"], r["bad"]) for r in cells], loss) / BINS
    kept = ~F.col("base_failed") & (F.col("score") <= F.lit(threshold))
    return scored.withColumn("kept", kept)
