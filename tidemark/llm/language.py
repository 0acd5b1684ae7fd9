"""Language identification by Bayesian evidence fusion.

Four kinds of evidence about a row meet in one posterior: the likelihood of its text under letter-trigram models,
the language that its markup (or its table) declares, the suffix of its address, and a prior of its host. What a
declaration, a suffix and a host say is not assumed but counted: grouped sums of the text posteriors over all rows.
A host's prior is smoothed towards its domain's, and that towards the whole corpus; a row is left out of the sums
that judge it. The trigram models are fitted on a bounded sample of labelled documents per language.

A row is rejected when no language explains its text better than chance letters do and nothing else is known of
it, or when the best language stays below ``SURE``.

Nulls and edge cases: a null or empty text, and one without letters, has no text evidence; null hosts, suffixes and
declarations count as values of their own and carry no weight if they are alike in all languages; ties go to the
first language by name; tags with a region or a script ('pt-BR', 'EN_us') are their primary language; repeated rows
are judged alike; with no labelled sample every row is undetermined and rejected; an empty table gives an empty
result; very long texts are counted in slices.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.units import slices
from tidemark.plans.bounds import stored

BUCKETS = 1 << 13
#: Languages of the labels at most: models are held by the driver and every task, and every language is a column of the sums.
MAX_LANGUAGES = 512
#: Labelled documents per language that the trigram models are fitted on at most, by the hash of their text.
FIT_ROWS = 2_000
#: Trigrams of a text that count at most: neighbours are not independent, so longer texts do not grow surer.
EFFECTIVE = 150
#: Weight of the level above in the smoothing of hosts and of declared values, in rows.
SMOOTH = 5.0
SURE = 0.6
#: Bytes of text that are counted at once.
SLICE = 1 << 20

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_HTML_TAG = re.compile(r"<html\b((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.DOTALL)


def markup_language(html: str) -> str | None:
    """Primary subtag of the ``lang`` attribute of the first ``html`` tag, in lower case, outside comments."""
    tag = _HTML_TAG.search(_COMMENT.sub(" ", html))
    for m in _ATTRIBUTE.finditer(tag[1]) if tag else ():
        if m[1].lower() == "lang":
            primary = re.split(r"[-_]", (m[2] or m[3] or m[4] or "").strip().lower())[0]
            return primary if re.fullmatch(r"[a-z]{2,3}", primary) else None
    return None


def visible_text(html: str) -> str:
    """Text between tags, without comments, scripts and styles; one pass."""
    out, skip = [], None
    for i, part in enumerate(_COMMENT.sub(" ", html).split("<")):
        if not i:
            out.append(part)
            continue
        tag, _, rest = part.partition(">")
        name = tag[:8].lower()
        if skip:
            if name.startswith("/" + skip):
                skip = None
                out.append(rest)
            continue
        skip = next((s for s in ("script", "style") if name.startswith(s)), None)
        if not skip:
            out.append(rest)
    return " ".join(out)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text number) of all letter trigrams; white space, digits and signs are alike."""
    buf = _FOLD[np.frombuffer(b"  ".join(texts) + b"  ", np.uint8)]
    length = np.array([len(t) + 2 for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), length)
    x = buf.astype(np.uint32)
    three = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    good = (buf[1:-1] != 32) & (owner[:-2] == owner[2:])
    return ((three[good] * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int32), owner[1:-1][good]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for start, texts in slices(batch.column("text").to_pylist(), SLICE):
            bucket, owner = grams(texts)
            names = sorted(set(langs[start : start + len(texts)]))
            code = np.array([names.index(x) for x in langs[start : start + len(texts)]])
            count = np.bincount(code[owner] * BUCKETS + bucket, minlength=len(names) * BUCKETS)
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_pydict({
                "lang": [names[i] for i in at // BUCKETS], "bucket": (at % BUCKETS).astype(np.int32), "n": count[at],
            })


def primary_language(tag: Column) -> Column:
    """The primary subtag of a language tag, in lower case: 'pt-BR' and 'PT_br' are 'pt'; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(tag.cast("string"), r"^\s*([^-_\s]*)", 1)), F.lit(""))


class TextModel:
    """Log likelihood ratios of trigram buckets against chance, a row per language."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table

    @staticmethod
    def fit(labelled: DataFrame, per_language: int = FIT_ROWS) -> TextModel:
        """``labelled`` has lang and text; counts come back as one row per language and bucket.

        Tags of one primary language are one language. More than MAX_LANGUAGES are refused, none is left out.
        """
        rows = labelled.select(primary_language(F.col("lang")).alias("lang"), "text")
        rows = rows.where("lang IS NOT NULL AND text IS NOT NULL").withColumn("h", F.xxhash64("text"))
        n = rows.agg(F.count_distinct("lang")).first()[0]
        if n > MAX_LANGUAGES:
            raise ValueError(f"lang has {n} languages, more than {MAX_LANGUAGES}: is it a column of language tags?")
        # Only hashes are ranked, and of these the lowest, about twice as many as are taken; at most MAX_LANGUAGES counts.
        sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("_n"))
        place = F.col("h").cast("double") / float(1 << 64) + 0.5
        low = rows.join(F.broadcast(sizes), "lang").where(place * F.col("_n") < 2 * per_language).select("lang", "h")
        rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
        # The texts of the sample are joined by their hashes.
        chosen = low.distinct().withColumn("r", rank).where(F.col("r") <= per_language).select("lang", "h")
        sample = rows.select("lang", "h", "text").join(F.broadcast(chosen), ["lang", "h"]).dropDuplicates(["lang", "h"])
        counted = sample.select("lang", "text").mapInArrow(_count_grams, "lang string, bucket int, n bigint")
        found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
        languages = sorted({r["lang"] for r in found})
        table = np.full((len(languages), BUCKETS), 0.1)
        for r in found:
            table[languages.index(r["lang"]), r["bucket"]] += r["n"]
        table = np.log(table / table.sum(axis=1, keepdims=True)) + np.log(BUCKETS) if languages else table
        return TextModel(languages, table)

    def likelihoods(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x languages log likelihood ratios, of EFFECTIVE trigrams at most; trigrams)."""
        bucket, owner = grams(texts)
        n = np.bincount(owner, minlength=len(texts))
        sums = [np.bincount(owner, weights=row[bucket], minlength=len(texts)) for row in self.table]
        scale = np.minimum(n, EFFECTIVE) / np.maximum(n, 1)
        return np.column_stack([s * scale for s in sums]) if sums else np.zeros((len(texts), 0)), n


def _evidence(model: TextModel, web: bool, extra: tuple[str, ...] = ()):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids, declared = batch.column("id"), batch.column("declared").to_pylist()
            hosts = batch.column("host").to_pylist()
            if web:
                pages = [t or "" for t in texts]
                declared = [markup_language(p) for p in pages]
                texts = [visible_text(p) for p in pages]
                hosts = [_host(u) for u in hosts]
            domain = [".".join(h.split(".")[-2:]) if h else None for h in hosts]
            suffix = [h.rsplit(".", 1)[-1] if h and "." in h else None for h in hosts]
            for start, part in slices(texts, SLICE):
                ratio, n = model.likelihoods(part)
                end = start + len(part)
                yield pa.RecordBatch.from_pydict({
                    "id": ids.slice(start, len(part)), "host": pa.array(hosts[start:end], pa.string()),
                    "domain": pa.array(domain[start:end], pa.string()), "suffix": pa.array(suffix[start:end], pa.string()),
                    "declared": pa.array(declared[start:end], pa.string()), "n": pa.array(n.astype(np.int64)),
                    "ratio": pa.array(list(ratio), pa.list_(pa.float64())),
                    **{c: batch.column(c).slice(start, len(part)) for c in extra},
                })

    return run


def _host(url: str | None) -> str | None:
    try:
        return (urlsplit(url or "").hostname or None) if url else None
    except ValueError:
        return None


_EVIDENCE = "id bigint, host string, domain string, suffix string, declared string, n bigint, ratio array<double>"


def page_evidence(pages: DataFrame, model: TextModel) -> DataFrame:
    rows = pages.select(F.col("page_id").cast("bigint").alias("id"), F.col("html").alias("text"), F.col("url").alias("host"), F.lit(None).cast("string").alias("declared"))
    return rows.mapInArrow(_evidence(model, True), _EVIDENCE)


def document_evidence(docs: DataFrame, model: TextModel, extra: tuple[str, ...] = ()) -> DataFrame:
    """Documents declare a language in their table; their source stands for a host. ``extra`` columns stay as they are."""
    declared = primary_language(F.col("lang")).alias("declared")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text", F.col("source").alias("host"), declared, *extra)
    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in extra)
    return rows.mapInArrow(_evidence(model, False, extra), _EVIDENCE + kinds)


def _shares(sums: Column, base: Column) -> Column:
    """Sums per language, smoothed towards ``base``, as shares."""
    total = F.aggregate(sums, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(sums, base, lambda s, b: (F.greatest(s, F.lit(0.0)) + SMOOTH * b) / (F.greatest(total, F.lit(0.0)) + SMOOTH))


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    weights = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(F.array(weights), lambda w: F.transform(w, lambda x: x / F.aggregate(w, F.lit(0.0), lambda a, y: a + y)))[0]


def fuse(evidence: DataFrame, model: TextModel) -> DataFrame:
    """Add ``lang``, ``confidence``, ``text_lang`` and ``kept`` to written evidence rows."""
    k = len(model.languages)
    if not k:
        return evidence.withColumns({"lang": F.lit("und"), "confidence": F.lit(0.0), "text_lang": F.lit("und"), "kept": F.lit(False)})
    # Texts that chance letters explain as well have no say in the sums.
    known = (F.col("n") > 0) & (F.array_max("ratio") > 0)
    flat = F.array(*[F.lit(1.0 / k)] * k)
    rows = evidence.withColumn("p", F.when(known, _softmax(F.col("ratio"))).otherwise(F.array(*[F.lit(0.0)] * k)))
    sums = F.array(*[F.sum(F.get("p", F.lit(i))) for i in range(k)])
    whole = rows.agg(sums.alias("s")).first()["s"] or [0.0] * k
    total = sum(whole)
    corpus = [(x + 1.0) / (total + k) for x in whole]
    base = F.array(*[F.lit(x) for x in corpus])

    def summed(key: str) -> DataFrame:
        return rows.groupBy(key).agg(sums.alias(f"s_{key}")).withColumnRenamed(key, f"k_{key}")

    joined = rows
    for key in ("declared", "suffix", "domain", "host"):
        table = summed(key)
        joined = joined.join(table, F.col(key).eqNullSafe(F.col(f"k_{key}")), "left").drop(f"k_{key}")
    # A row does not count itself.
    others = lambda key: F.zip_with(f"s_{key}", "p", lambda s, p: s - p)
    domain = _shares(others("domain"), base)
    host = _shares(others("host"), domain)
    logs = F.when(F.col("n") > 0, F.col("ratio")).otherwise(F.array(*[F.lit(0.0)] * k))
    logs = F.zip_with(logs, host, lambda a, b: a + F.log(b))
    for key in ("declared", "suffix"):
        # Shares over the corpus' own shares: how much more often the value goes with the language.
        lift = F.zip_with(_shares(others(key), base), base, lambda a, b: a / b)
        logs = F.zip_with(logs, lift, lambda a, b: a + F.log(b))
    posterior = _softmax(logs)
    names = F.array(*[F.lit(x) for x in model.languages])
    best = lambda a: F.element_at(names, F.array_position(a, F.array_max(a)).cast("int"))
    out = joined.withColumn("posterior", posterior).withColumn("confidence", F.array_max("posterior"))
    declared = F.coalesce(F.col("declared").isin(*model.languages), F.lit(False))
    explained = F.when(F.col("n") > 0, known).otherwise(F.lit(False)) | ((F.col("n") > 0) & declared & (F.col("n") < 10))
    kept = explained & (F.col("confidence") >= SURE)
    return out.select(
        *evidence.columns,
        F.when(explained, best(F.col("posterior"))).otherwise(F.lit("und")).alias("lang"),
        "confidence",
        F.when(known, best(F.col("p"))).otherwise(F.lit("und")).alias("text_lang"),
        kept.alias("kept"),
    )


def identify_documents(docs: DataFrame, model: TextModel | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """(id, lang, confidence, text_lang, kept) of every row of ``docs`` (doc_id, text, lang, source)."""
    model = model or TextModel.fit(docs.select("lang", "text"))
    return fuse(stored(document_evidence(docs, model, extra), "language_documents"), model)


def identify_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    """The same for web pages (page_id, url, html)."""
    return fuse(stored(page_evidence(pages, model), "language_pages"), model)
