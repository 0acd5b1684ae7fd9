r"""Personal data by weak supervision, with DataFrame functions and ``pyspark.ml`` only.

Four base kinds are found by their patterns and checks, and always count. Beyond them, every other run of characters
with a digit or an ``@`` is a candidate. Labelers vote on a candidate (yes, no, abstain): patterns of shape, a
gazetteer of ordinary and of telling words, and the words before it. Expectation-maximisation over the counts of
vote patterns estimates how far each labeler can be relied on and how likely each pattern is personal data; a
logistic regression on features of the span learns from these likelihoods and decides. No label is read.

Text positions come from cutting a text at the matches: a match starts after all gaps and matches before it. The
patterns are written so that no text takes quadratic time or deep recursion: separators inside numbers and domains
are first marked by a control character, and runs are taken whole. U+0001 to U+0003 in a text count as "!".

Nulls and edge cases: a null or empty text has no spans; rows are numbered, so repeated rows are separate; spans of
different kinds may overlap, added ones overlap no base span; without candidates, or when the votes do not tell two
classes apart, nothing is added; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.bounds import stored

BASE = ("email", "ip", "card", "phone")
ADDED = "secret"
_SPACE, _DOT, _DASH = "\u0001", "\u0002", "\u0003"
PATTERNS = {
    "email": rf"(?:(?<![A-Za-z0-9._%+{_DOT}-])|\G)[A-Za-z0-9._%+{_DOT}-]++@[A-Za-z0-9-]++{_DOT}[A-Za-z0-9{_DOT}-]*+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": rf"[0-9][0-9{_SPACE}{_DASH}]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    ADDED: r"(?:(?<![A-Za-z0-9._%+@-])|\G)[A-Za-z0-9._%+@-]*[0-9@][A-Za-z0-9._%+@-]*+",
}
#: Words that announce a private value, and words that announce an ordinary number.
TELLING = ("password", "passwd", "pwd", "token", "secret", "apikey", "key", "pin", "ssn", "passport", "iban", "account", "login", "card", "tel", "phone", "mobile", "fax", "mail", "contact")
ORDINARY = ("page", "chapter", "section", "version", "figure", "table", "year", "no", "vol", "line", "item", "step", "part", "license", "copyright")
CONTEXT = 32
#: Expectation-maximisation ends when a pass changes the mean log likelihood of a span's votes by less than this.
TOLERANCE = 1e-5
#: Added spans need this probability.
SURE = 0.9
LABELERS = ("shape", "length", "digits", "before", "gazetteer")


def _prepared(text: Column, kind: str) -> Column:
    clean = F.translate(text, _SPACE + _DOT + _DASH, "!!!")
    if kind == "email":
        return F.regexp_replace(clean, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _DOT)
    if kind == "card":
        spaced = F.regexp_replace(clean, r"(?<=[0-9])\x20(?=[0-9])", _SPACE)
        return F.regexp_replace(spaced, r"(?<=[0-9])-(?=[0-9])", _DASH)
    return clean


def _restored(text: Column) -> Column:
    return F.translate(text, _SPACE + _DOT + _DASH, " .-")


def _worth_a_look(text: Column, kind: str) -> Column:
    marks = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    return marks.get(kind, text.rlike("[0-9@]"))


def _let(value: Column, use) -> Column:
    """Compute ``value`` once and use it several times."""
    return F.transform(F.array(value), use)[0]


def matches(text: Column, kind: str) -> Column:
    """Array of (gap: code points since the match before, before: the end of that gap, hit), and the rest behind."""
    pattern = F.lit(PATTERNS[kind])

    def cut(s: Column) -> Column:
        gaps, hits = F.split(s, PATTERNS[kind], -1), F.regexp_extract_all(s, pattern, F.lit(0))
        return F.zip_with(
            F.slice(gaps, 1, F.size(hits)), hits,
            lambda g, h: F.struct(
                F.char_length(g).alias("gap"),
                F.when(F.lit(kind == ADDED), F.substring(g, -CONTEXT, CONTEXT)).alias("before"),
                h.alias("hit"),
            ),
        )

    none = F.expr("CAST(array() AS array<struct<gap:int,before:string,hit:string>>)")
    return F.when(_worth_a_look(text, kind), _let(_prepared(text, kind), cut)).otherwise(none)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    each = F.transform(F.split(F.reverse(digits), ""), worth)
    return F.aggregate(each, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def valid(kind: Column, hit: Column) -> Column:
    """Whether a match of a base kind passes its check."""
    digits = _digits(hit)
    n = F.length(digits)
    part = "0*([0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", hit.rlike(rf"^{part}(\.{part}){{3}}$"))
        .when(kind == "card", n.between(13, 19) & _luhn(F.substring(digits, 1, 19)))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(F.lit(False))
    )


def votes(hit: Column, before: Column) -> dict[str, Column]:
    """What every labeler says about a candidate: 1 yes, -1 no, 0 nothing."""
    low, n = F.lower(before), F.char_length(hit)
    n_digits = F.length(_digits(hit))
    telling, ordinary = "|".join(TELLING), "|".join(ORDINARY)
    letters = F.lower(F.regexp_replace(hit, "[^A-Za-z]", ""))
    return {
        "shape": F.when(hit.rlike(r"^[0-9a-fA-F]{16,}$") | hit.rlike(r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+_-]{20,}$"), 1)
        .when(hit.rlike(r"^([0-9]{1,5}|[0-9]+[.][0-9]+|[0-9]+(st|nd|rd|th|%))$"), -1).otherwise(0),
        "length": F.when(n >= 12, 1).when(n <= 4, -1).otherwise(0),
        "digits": F.when(n_digits >= 7, 1).when(n_digits <= 2, -1).otherwise(0),
        "before": F.when(low.rlike(rf"\b({telling})\s*(is|no|number)?\s*[=:#]?\s*[\"']?$"), 1)
        .when(low.rlike(rf"\b({ordinary})[.]?\s*$"), -1).otherwise(0),
        "gazetteer": F.when(letters.isin(*TELLING), 1).when(letters.isin(*ORDINARY), -1).otherwise(0),
    }


def features(hit: Column, before: Column) -> dict[str, Column]:
    """Coarse features of a span; together they take a bounded number of values."""
    n = F.greatest(F.char_length(hit), F.lit(1))
    share = lambda pattern: F.round(F.length(F.regexp_replace(hit, pattern, "")) / n * 4) / 4
    return {
        "size": F.least(F.floor(F.log2(n)), F.lit(6)).cast("double"),
        "digit_share": share("[^0-9]"),
        "hex_share": share("[^0-9a-f]"),
        "marks": hit.rlike("[^A-Za-z0-9]").cast("double"),
        "assigned": before.rlike(r"[=:]\s*[\"']?$").cast("double"),
        "told": (votes(hit, before)["before"] == 1).cast("double"),
    }


def candidates(docs: DataFrame) -> DataFrame:
    """One written row per document: its number, its id, and the matches of every kind."""
    numbered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    found = {f"m_{kind}": matches(F.col("text"), kind) for kind in PATTERNS}
    return stored(numbered.withColumns(found).drop("text"), "pii_matches")


def placed(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, before, hit) of every match; positions are running sums over short rows."""
    each = [
        found.select("row", F.lit(kind).alias("kind"), F.posexplode(f"m_{kind}").alias("at", "m")) for kind in PATTERNS
    ]
    rows = reduce(DataFrame.unionByName, each).select("row", "kind", "at", "m.*")
    length = F.char_length("hit")
    upto = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + length).over(upto)
    return rows.withColumn("end", end).select("row", "kind", (F.col("end") - length).alias("start"), "end", "before", "hit")


def _free(spans: DataFrame) -> DataFrame:
    """Checked base spans, and the candidates that overlap none of them."""
    checked = spans.withColumn("base", valid(F.col("kind"), F.col("hit"))).where(F.col("base") | (F.col("kind") == ADDED))
    by = Window.partitionBy("row").orderBy("start")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(by.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(by.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    clear = (F.coalesce(before, F.lit(-1)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    return checked.withColumn("clear", clear).where(F.col("base") | F.col("clear")).drop("clear")


def reliabilities(patterns: DataFrame, tolerance: float = TOLERANCE) -> tuple[float, dict[str, dict[int, tuple[float, float]]]] | None:
    """Expectation-maximisation over counted vote patterns: the share of personal data, and per labeler and vote its
    probability for (personal, other) spans. One aggregation to one row per pass; at most 3**labelers rows in all.
    Passes go on until the likelihood stands still, however many that takes.
    """
    count = patterns.agg(F.sum("n")).first()[0]
    if not count:
        return None
    prior = 0.5
    # Labelers start out better than chance, which also says which class is which.
    says = {name: {1: (0.5, 0.15), 0: (0.35, 0.35), -1: (0.15, 0.5)} for name in LABELERS}
    before = -math.inf
    while True:
        yes, no = _sides(prior, says, {name: F.col(name) for name in LABELERS})
        # Named columns first: in every one of the sums the products would be a large program.
        weighed = patterns.withColumns({"_p": yes / (yes + no), "_fit": F.log(yes + no)})
        p = F.col("_p")
        sums = [F.sum(F.col("n") * p).alias("yes"), F.sum(F.col("n") * F.col("_fit")).alias("fit")]
        for name in LABELERS:
            for vote in (1, 0, -1):
                here = F.when(F.col(name) == vote, F.col("n")).otherwise(0)
                sums += [F.sum(here * p).alias(f"{name}_{vote}_p"), F.sum(here * (1 - p)).alias(f"{name}_{vote}_q")]
        row = weighed.agg(*sums).first()
        fit, yes = row["fit"] / count, row["yes"]
        if abs(fit - before) < tolerance:
            return prior, says
        before = fit
        prior = min(max(yes / count, 1e-6), 1 - 1e-6)
        # One vote of each kind is added, so that none is held impossible.
        says = {
            name: {
                vote: ((row[f"{name}_{vote}_p"] + 1) / (yes + 3), (row[f"{name}_{vote}_q"] + 1) / (count - yes + 3))
                for vote in (1, 0, -1)
            }
            for name in LABELERS
        }


def _sides(prior: float, says: dict, vote: dict[str, Column]) -> tuple[Column, Column]:
    """Probability of the votes together with personal data, and with other spans."""

    def product(side: int, start: float) -> Column:
        out = F.lit(start)
        for name, table in says.items():
            out = out * F.when(vote[name] == 1, table[1][side]).when(vote[name] == -1, table[-1][side]).otherwise(table[0][side])
        return out

    return product(0, prior), product(1, 1 - prior)


def likelihood(prior: float, says: dict, vote: dict[str, Column]) -> Column:
    """Probability of personal data given the votes, as a column."""
    yes, no = _sides(prior, says, vote)
    return yes / (yes + no)


def train(spans: DataFrame):
    """The final span classifier as a function (hit, before) -> probability column, or None where nothing can be told."""
    found = spans.where(F.col("kind") == ADDED)
    seen = found.select(
        *[v.cast("int").alias(k) for k, v in votes(F.col("hit"), F.col("before")).items()],
        *[v.alias(k) for k, v in features(F.col("hit"), F.col("before")).items()],
    )
    names = list(features(F.col("hit"), F.col("before")))
    counted = stored(seen.groupBy(*LABELERS, *names).agg(F.count(F.lit(1)).alias("n")), "pii_votes")
    patterns = stored(counted.groupBy(*LABELERS).agg(F.sum("n").alias("n")), "pii_patterns")
    model = reliabilities(patterns)
    if model is None:
        return None
    p = likelihood(*model, {name: F.col(name) for name in LABELERS})
    soft = counted.withColumn("p", p).groupBy(*names).agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no"))
    both = soft.select(*names, F.lit(1.0).alias("label"), F.col("yes").alias("w")).unionByName(
        soft.select(*names, F.lit(0.0).alias("label"), F.col("no").alias("w"))
    ).where("w > 0.001")
    totals = {r["label"]: r["w"] for r in both.groupBy("label").agg(F.sum("w").alias("w")).collect()}
    if len(totals) < 2 or min(totals.values()) < 1:
        return None
    ready = VectorAssembler(inputCols=names, outputCol="x").transform(both).coalesce(1)
    fit = LogisticRegression(featuresCol="x", weightCol="w", regParam=0.001, maxIter=50).fit(ready)
    weights, bias = list(fit.coefficients), fit.intercept

    def probability(hit: Column, before: Column) -> Column:
        z = reduce(lambda a, b: a + b, [F.lit(float(w)) * c for w, c in zip(weights, features(hit, before).values())], F.lit(float(bias)))
        return 1 / (1 + F.exp(-z))

    return probability


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, n_secret, base_sha256, spans, n_spans) of every row."""
    found = candidates(docs)
    spans = stored(_free(placed(found)), "pii_spans")
    probability = train(spans)
    sure = F.lit(False) if probability is None else (F.col("kind") == ADDED) & (probability(F.col("hit"), F.col("before")) >= SURE)
    kept = spans.where(F.col("base") | sure)
    rank = F.array_position(F.array(*[F.lit(k) for k in (*BASE, ADDED)]), F.col("kind"))
    name = F.concat_ws(":", "kind", "start", "end")
    per_doc = kept.groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in (*BASE, ADDED)],
        F.sort_array(F.collect_list(F.struct(rank.alias("r"), "start", name.alias("s")))).alias("all"),
    )
    base = F.array_join(F.transform(F.filter("all", lambda x: x["r"] <= len(BASE)), lambda x: x["s"]), ",")
    text = F.array_join(F.transform("all", lambda x: x["s"]), ",")
    joined = found.select("row", "doc_id").join(per_doc, "row", "left")
    return joined.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in (*BASE, ADDED)],
        F.sha2(F.coalesce(base, F.lit("")), 256).alias("base_sha256"),
        F.coalesce(text, F.lit("")).alias("spans"),
        F.coalesce(F.size("all"), F.lit(0)).cast("bigint").alias("n_spans"),
    )


def _cut_out(kind: str, probability):
    """A text as pieces: the gap before a match, the match, and whether it goes."""

    def good(before: Column, hit: Column) -> Column:
        return probability(hit, before) >= SURE if kind == ADDED else valid(F.lit(kind), hit)

    def piece(gap: Column, hit: Column) -> Column:
        goes = hit.isNotNull() & good(F.substring(gap, -CONTEXT, CONTEXT), hit)
        return F.struct(gap.alias("g"), F.coalesce(hit, F.lit("")).alias("h"), F.coalesce(goes, F.lit(False)).alias("ok"))

    def cut(s: Column) -> Column:
        return F.zip_with(F.split(s, PATTERNS[kind], -1), F.regexp_extract_all(s, F.lit(PATTERNS[kind]), F.lit(0)), piece)

    return cut


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Put ``[KIND]`` in place of every span, kind after kind; the classifier is trained on all of ``docs`` first.

    A text without spans stays as it is. Nothing is shuffled by document: a text is cut at its matches and joined
    again.
    """
    probability = train(stored(_free(placed(candidates(docs.select("doc_id", F.col(text_col).alias("text"))))), "pii_spans"))
    text = F.coalesce(text_col, F.lit(""))
    out = docs.withColumn("_new", text).withColumn("_hits", F.lit(0))
    for kind in (*BASE, ADDED):
        if kind == ADDED and probability is None:
            continue
        pieces = F.when(_worth_a_look(F.col("_new"), kind), _let(_prepared(F.col("_new"), kind), _cut_out(kind, probability)))
        joined = F.array_join(F.transform("_p", lambda x: F.concat(x["g"], F.when(x["ok"], F.lit(f"[{kind.upper()}]")).otherwise(x["h"]))), "")
        n = F.size(F.filter("_p", lambda x: x["ok"]))
        out = out.withColumn("_p", pieces).withColumn("_n", F.when(F.col("_p").isNotNull(), n).otherwise(0))
        out = out.withColumn("_new", F.when(F.col("_n") > 0, _restored(joined)).otherwise(F.col("_new")))
        out = out.withColumn("_hits", F.col("_hits") + F.col("_n"))
    changed = F.when(F.col("_hits") > 0, F.col("_new")).otherwise(F.col(text_col))
    return out.withColumn(text_col, changed).drop("_new", "_hits", "_p", "_n")
