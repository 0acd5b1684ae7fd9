"""Quality classifier: a generalised additive model with pairwise interactions, scored by adding table entries.

Figures of a whole text (no label, language, source or id among them) fall into bins. The model is an intercept, one
lookup table per figure over its bins, and one table of two dimensions for each of a few pairs of figures. Tables are
learned by cyclic boosting: figure after figure, round after round, a shallow tree is grown over the bins' sums of the
logistic loss's gradients, and a small part of its leaves is added to the figure's table. Pairs are chosen by what a tree
of both figures would still gain, then boosted alike. Rounds end when rows put aside for it stop getting better. A text's
score is the logistic function of the sum of its table entries, looked up for whole batches at once.

Labels: only of documents that are not held out (``crc32`` of the id as text, modulo 4, is not 2). The tables are fitted
on at most about ``FIT_ROWS`` distinct labelled rows (figures and label), chosen by a hash of the row against a share
found by counting; copies of a text count once. Everything else is done for all rows.

Nulls and edge cases: a null or empty text, or one without words, has the figures 0 and is scored as such; a null id is
never labelled nor held out; labels that are null or other than 0 and 1 are not used, of several for one id the largest
counts; without labelled rows, or with those of one label only, the score is the smoothed share of label 1; repeated rows
score alike; an empty table gives an empty result; other columns are not read, so names may clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.units import Words, slices
from tidemark.plans.bounds import fits_broadcast, stored

#: Distinct labelled rows that tables are fitted on, about.
FIT_ROWS = 20_000
HELD_OUT, FOLDS = 2, 4
POSITIVE = 0.7
BINS, PAIR_BINS, PAIRS = 48, 12, 6
RATE, PENALTY, LEAST_WEIGHT, ROUNDS, PATIENCE = 0.1, 1.0, 1.0, 300, 25
#: One of so many fitted rows only tells when to stop.
ASIDE = 7

FIGURES = [
    "words", "word_length", "symbols", "symbol_words", "upper", "upper_words", "marks", "digits", "wide",
    "stutter", "longest_stutter", "repeated", "distinct", "lines", "repeated_lines", "line_words", "bars", "doubled_marks",
]


def _marked(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SYMBOL, _MARK, _DIGIT = _marked(b"#*$%&|<>"), _marked(b"!?;:=+~^_\"'()[]{}\\/@`"), _marked(b"0123456789")
_UPPER, _LOWER = _marked(bytes(range(65, 91))), _marked(bytes(range(97, 123)))
_BLANK = b"\t\n\x0b\x0c\r "


def _longest_runs(equal: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Per text, the longest run of set flags; flags of two texts do not touch."""
    edge = np.diff(np.concatenate([[0], equal.astype(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out = np.zeros(n, np.int64)
    np.maximum.at(out, text[start], end - start)
    return out


def text_figures(texts: list[bytes]) -> np.ndarray:
    """One row per text, columns as ``FIGURES``."""
    w = Words(texts)
    n, words = w.n_texts, np.maximum(w.count, 1)
    lead = w.per_text(w.inside & ((w.buf & 0xC0) != 0x80))
    chars = np.maximum(lead, 1)
    h = w.hashes()
    per_word = lambda flags: np.bincount(w.text[flags], minlength=n) if len(h) else np.zeros(n, np.int64)
    last = w.buf[w.end - 1] if len(h) else np.zeros(0, np.uint8)
    cased = np.maximum(w.per_text(_UPPER[w.buf]) + w.per_text(_LOWER[w.buf]), 1)
    second = w.buf[np.minimum(w.start + 1, len(w.buf) - 1)] if len(h) else last
    equal = np.concatenate([[False], (h[1:] == h[:-1]) & (w.text[1:] == w.text[:-1])]) if len(h) else np.zeros(0, bool)
    salt = np.uint64(0xD6E8FEB86659FD93)
    own = np.unique(h + w.text.astype(np.uint64) * salt, return_index=True)[1]
    grams, first = w.grams(4)
    new = np.unique(grams + w.text[first].astype(np.uint64) * salt, return_index=True)[1]
    n_grams = np.bincount(w.text[first], minlength=n)
    doubled = _MARK[w.buf] & np.concatenate([[False], w.buf[1:] == w.buf[:-1]])
    lines, again = np.zeros(n), np.zeros(n)
    for i, t in enumerate(texts):
        filled = [x for x in t.split(b"\n") if x.strip(_BLANK)]
        lines[i], again[i] = len(filled), len(filled) - len(set(filled))
    return np.column_stack([
        np.log1p(w.count),
        lead / words,
        w.per_text(_SYMBOL[w.buf]) / words,
        per_word(_SYMBOL[last]) / words,
        w.per_text(_UPPER[w.buf]) / cased,
        per_word(_UPPER[second]) / words,
        w.per_text(_MARK[w.buf]) / words,
        w.per_text(_DIGIT[w.buf]) / chars,
        w.per_text(w.buf >= 0xC0) / chars,
        per_word(equal) / words,
        np.log1p(_longest_runs(equal, w.text, n)),
        1 - np.bincount(w.text[first[new]], minlength=n) / np.maximum(n_grams, 1) - (n_grams == 0),
        # Longer texts repeat more words; the square root of the length takes most of that out.
        np.bincount(w.text[own], minlength=n) / words * np.sqrt(np.maximum(words, 100) / 100),
        np.log1p(lines),
        again / np.maximum(lines, 1),
        np.log1p(w.count / np.maximum(lines, 1)),
        w.per_text(w.buf == ord("|")) / words,
        w.per_text(doubled) / words,
    ])


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start, texts in slices(batch["text"].tolist()):
            out = pd.DataFrame(text_figures(texts), columns=FIGURES)
            out.insert(0, "doc_id", batch["doc_id"].iloc[start : start + len(texts)].array)
            yield out


def figures(docs: DataFrame) -> DataFrame:
    kind = "doc_id bigint, " + ", ".join(f"{c} double" for c in FIGURES)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(_describe, kind)


# -- learning ---------------------------------------------------------------------------------


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + PENALTY)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, bins left of the cut) of the best cut of a row of bins; (0, 0) where none helps."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = _gain(left_g, left_h) + _gain(right_g, right_h) - _gain(g.sum(), h.sum())
    gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = 0
    at = int(gain.argmax())
    return (float(gain[at]), at + 1) if gain[at] > 0 else (0.0, 0)


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values over the bins of one figure."""
    _, at = _best_cut(g, h) if depth else (0.0, 0)
    if not at:
        return np.full(len(g), -g.sum() / (h.sum() + PENALTY))
    return np.concatenate([shallow_tree(g[:at], h[:at], depth - 1), shallow_tree(g[at:], h[at:], depth - 1)])


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, leaf values) over the bins of two figures: a cut along one of them, then one along the other on each side."""
    best, values = 0.0, np.full(g.shape, -g.sum() / (h.sum() + PENALTY))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        ca, cb = np.cumsum(a, axis=0), np.cumsum(b, axis=0)
        for at in range(1, a.shape[0]):
            total, parts = -float(_gain(g.sum(), h.sum())), []
            for sg, sh in ((ca[at - 1], cb[at - 1]), (ca[-1] - ca[at - 1], cb[-1] - cb[at - 1])):
                more, cut = _best_cut(sg, sh)
                total += more + float(_gain(sg.sum(), sh.sum()))
                parts.append((sg, sh, cut))
            if total > best and min(sh.sum() for _, sh, _ in parts) >= LEAST_WEIGHT:
                rows = []
                for (sg, sh, cut), size in zip(parts, (at, a.shape[0] - at)):
                    leaf = np.concatenate([np.full(len(x), -x.sum() / (y.sum() + PENALTY)) for x, y in ((sg[:cut], sh[:cut]), (sg[cut:], sh[cut:]))])
                    rows.append(np.tile(leaf, (size, 1)))
                best, found = total, np.concatenate(rows)
                values = found.T if turned else found
    return best, values


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _loss(margin: np.ndarray, y: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(y == 1, -margin, margin)).mean()) if len(y) else 0.0


@dataclass
class AdditiveModel:
    """Intercept, cut points and a table per figure, and coarse cut points and tables of pairs."""

    intercept: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[j], x[:, j], "right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.coarse[i], x[:, i], "right"), np.searchsorted(self.coarse[j], x[:, j], "right")]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return logistic(self.margins(x))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Cut points between the quantiles of what values there are."""
    seen = np.unique(values)
    if len(seen) > bins:
        seen = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))
        return seen
    return (seen[1:] + seen[:-1]) / 2


def _cycle(steps, tables: list[np.ndarray], margin: np.ndarray, y: np.ndarray, aside: np.ndarray) -> list[np.ndarray]:
    """Rounds over all ``steps``; each is (bins as one number, shape, tree). Returns the tables of the best round."""
    fit = ~aside
    judged = aside if aside.any() and fit.any() else fit
    fit = fit if fit.any() else judged
    best, kept, since = _loss(margin[judged], y[judged]), [t.copy() for t in tables], 0
    for _ in range(ROUNDS):
        for k, (cell, shape, tree) in enumerate(steps):
            p = logistic(margin[fit])
            size = int(np.prod(shape))
            g = np.bincount(cell[fit], p - y[fit], size).reshape(shape)
            h = np.bincount(cell[fit], p * (1 - p), size).reshape(shape)
            step = RATE * tree(g, h)
            tables[k] += step
            margin += step.reshape(-1)[cell]
        now = _loss(margin[judged], y[judged])
        if now < best - 1e-6:
            best, kept, since = now, [t.copy() for t in tables], 0
        else:
            since += 1
            if since >= PATIENCE:
                break
    return kept


def fit_additive(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS) -> AdditiveModel:
    """Learn the tables; rows are put in order first, so that the order they come in does not show."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model
    order = np.lexsort((y, *x.T))
    x, y = x[order], y[order].astype(float)
    # Every label gives rows that tell when to stop.
    aside = np.zeros(len(y), bool)
    for label in (0, 1):
        aside[np.random.default_rng(3).permutation(np.flatnonzero(y == label))[::ASIDE][1:]] = True
    model.cuts = [_cuts(x[:, j], BINS) for j in range(x.shape[1])]
    cell = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.cuts)]
    steps = [(c, (len(cut) + 1,), shallow_tree) for c, cut in zip(cell, model.cuts)]
    model.tables = _cycle(steps, [np.zeros(s[1]) for s in steps], np.full(len(y), model.intercept), y, aside)

    model.coarse = [_cuts(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    rough = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.coarse)]
    margin = model.margins(x)
    p = logistic(margin)
    ranked = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            shape = len(model.coarse[i]) + 1, len(model.coarse[j]) + 1
            both = rough[i] * shape[1] + rough[j]
            size = shape[0] * shape[1]
            gain, _ = pair_tree(np.bincount(both, p - y, size).reshape(shape), np.bincount(both, p * (1 - p), size).reshape(shape))
            ranked.append((-gain, i, j, both, shape))
    chosen = [r for r in sorted(ranked, key=lambda r: r[:3])[:pairs] if r[0] < 0]
    steps = [(both, shape, lambda g, h: pair_tree(g, h)[1]) for *_, both, shape in chosen]
    tables = _cycle(steps, [np.zeros(s[1]) for s in steps], margin, y, aside) if steps else []
    model.pairs, model.pair_tables = [(i, j) for _, i, j, *_ in chosen], tables
    return model


# -- on tables --------------------------------------------------------------------------------


def held_out(doc_id: str = "doc_id") -> Column:
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def labelled(described: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> pd.DataFrame:
    """About ``fit_rows`` distinct rows of figures and label, of documents that are not held out."""
    rated = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max("quality").cast("int").alias("quality")).where(~held_out())
    )
    few = F.broadcast if fits_broadcast(rated) else lambda df: df
    rows = stored(described.where(~held_out()).join(few(rated), "doc_id").select(*FIGURES, "quality").distinct(), "additive_rows")
    n = rows.count()
    # Chosen where they lie; what goes on is about that many rows, whatever their number.
    draw = F.pmod(F.xxhash64(F.lit(11), *FIGURES, "quality"), F.lit(1 << 30)) / float(1 << 30)
    return (rows.where(draw < fit_rows / n) if n > fit_rows else rows).toPandas()


def fit(described: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> AdditiveModel:
    rows = labelled(described, labels, fit_rows)
    return fit_additive(rows[FIGURES].to_numpy(float), rows["quality"].to_numpy(int))


def classify(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, positive: float = POSITIVE) -> DataFrame:
    """(doc_id, held_out, score, predicted) and the figures of every document."""
    described = stored(figures(docs), "additive_figures")
    model = fit(described, labels, fit_rows)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(score=model.scores(batch[FIGURES].to_numpy(float)))

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in described.schema.fields)
    scored = described.mapInPandas(score, f"{kind}, score double")
    predicted = F.when(F.col("score") >= positive, 1).otherwise(0)
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.cast("int").alias("predicted"), *FIGURES)
