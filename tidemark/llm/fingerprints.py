"""Document fingerprints: a Merkle tree over the sections and paragraphs of a text, with DataFrame functions only.

Blank lines part sections, line ends part paragraphs, and a paragraph is cut into leaves of 64 code points. Every
paragraph is digested whole; a section's node is the digest of its paragraphs' digests, and the root that of the
sections' nodes. Both cuts can be undone, so equal roots mean equal texts. The fingerprint is one string:

    root|section:paragraph=.leaf.leaf;paragraph=.leaf/section:...

with short node names (8 hex digits) below the root (64). Two fingerprints tell whether the texts are equal (the
root), how alike they are (shared leaves), and where they part (``first_difference``).

Nulls and edge cases: a null text counts as empty; the empty text has one section with one empty paragraph without
leaves; very long paragraphs are cut in one linear pass; repeated rows and equal texts give equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.bounds import cut
from tidemark.plans.ordered import with_blocks

LEAF = r"(?s).{1,64}"
NODE = 8
#: Documents per block of the id order.
BLOCK = 1_000
#: Stands for a null id: below all others.
NO_ID = -(2**62)


def _short(digest: Column) -> Column:
    return F.substring(digest, 1, NODE)


def _leaves(paragraph: Column) -> Column:
    pieces = F.regexp_extract_all(paragraph, F.lit(LEAF), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: F.concat(F.lit("."), _short(F.sha2(p, 256)))), "")


def _section(section: Column) -> Column:
    """(node, branch) of one section."""
    paragraphs = F.transform(
        F.split(section, "\n", -1),
        lambda p: F.struct(F.sha2(p, 256).alias("node"), _leaves(p).alias("leaves")),
    )
    return F.transform(
        F.array(paragraphs),
        lambda ps: F.struct(
            F.sha2(F.array_join(F.transform(ps, lambda p: p["node"]), ""), 256).alias("node"),
            F.array_join(F.transform(ps, lambda p: F.concat(_short(p["node"]), F.lit("="), p["leaves"])), ";").alias("branch"),
        ),
    )[0]


def fingerprint(text: Column) -> Column:
    """The fingerprint string of a text column."""
    sections = F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n", -1), _section)
    return F.transform(
        F.array(sections),
        lambda ss: F.concat(
            F.sha2(F.array_join(F.transform(ss, lambda s: s["node"]), ""), 256),
            F.lit("|"),
            F.array_join(F.transform(ss, lambda s: F.concat(_short(s["node"]), F.lit(":"), s["branch"])), "/"),
        ),
    )[0]


def root(print_: Column) -> Column:
    return F.substring_index(print_, "|", 1)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else the share of leaves that both have (Dice), below 1 in any case."""
    leaves = [F.array_distinct(F.regexp_extract_all(x, F.lit(r"\.([0-9a-f]{8})"), F.lit(1))) for x in (a, b)]
    total = F.size(leaves[0]) + F.size(leaves[1])
    # Both empty without equal roots: texts of line ends only.
    shared = F.size(F.array_intersect(*leaves)) * 2.0 / F.greatest(total, F.lit(1))
    return F.when(root(a) == root(b), F.lit(1.0)).otherwise(F.least(shared, 1 - F.lit(1.0) / (total + 2)))


def first_difference(a: Column, b: Column) -> Column:
    """(section, paragraph), both from 0, of the first branch in which two fingerprints differ; null for equal ones."""

    def at(x: Column, y: Column, mark: str) -> Column:
        left, right = F.split(x, mark), F.split(y, mark)
        n = F.greatest(F.size(left), F.size(right))
        differs = F.transform(F.sequence(F.lit(0), n - 1), lambda i: ~F.get(left, i).eqNullSafe(F.get(right, i)))
        return F.array_position(differs, True).cast("int") - 1

    branches = [F.substring_index(x, "|", -1) for x in (a, b)]
    section = at(*branches, "/")
    # Without the section's own node, which differs whenever one of its paragraphs does.
    inner = [F.substring_index(F.coalesce(F.get(F.split(x, "/"), section), F.lit("")), ":", -1) for x in branches]
    return F.when(root(a) != root(b), F.struct(section.alias("section"), at(*inner, ";").alias("paragraph")))


def fingerprint_edits(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Fingerprints of every document, of its edited text, and how alike they and the next document's are.

    The edited text ends in the first code points of the next document by descending id (after the last: the
    first) in place of its own last half. Rows with one id share their next document; of several rows with the
    next id, the largest by (length, hash) counts. A null id comes after all others; the only document follows
    itself.

    Quantiles of the id cut the table into blocks of about ``block`` documents. Texts are moved once, to their
    block, and every block also gets the document that its lowest id is followed by.
    """
    text = F.coalesce("text", F.lit(""))
    own = docs.select("doc_id", text.alias("text")).withColumn("_key", F.coalesce("doc_id", F.lit(NO_ID)))
    home = with_blocks(own, "_key", block)
    lower = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    spans = home.groupBy("_block").agg(F.min("_key").alias("_low"), F.max("_key").alias("_high"))
    # One row per block, not per document: the key that comes before the block's lowest one.
    spans = cut(spans.select("_block", "_low", "_high", F.max("_high").over(lower).alias("_guest")))
    ends = spans.agg(F.min("_low").alias("low"), F.max("_high").alias("high")).first()
    if ends["low"] is None:
        guests = spans.select("_guest", F.lit(0).alias("_to"), F.lit(NO_ID).alias("_as"))
    else:
        first = F.col("_guest").isNull()
        guests = spans.select(
            F.when(first, F.lit(ends["high"])).otherwise(F.col("_guest")).alias("_guest"),
            F.col("_block").alias("_to"),
            F.when(first, F.lit(ends["low"] - 1)).otherwise(F.col("_guest")).alias("_as"),
        )
    guests = cut(guests)

    # At most one guest per block, so this side is bounded by MAX_BLOCKS rows of three numbers.
    visits = home.join(F.broadcast(guests), F.col("_key") == F.col("_guest")).select(
        F.lit(True).alias("_visit"), "doc_id", "text", F.col("_as").alias("_key"), F.col("_to").alias("_block")
    )
    rows = home.select(F.lit(False).alias("_visit"), "doc_id", "text", "_key", "_block").unionByName(visits)
    rows = rows.withColumns({
        "n_chars": F.char_length("text").cast("bigint"),
        "_hash": F.xxhash64("text"),
        "fingerprint": fingerprint(F.col("text")),
    })
    smaller = Window.partitionBy("_block").orderBy("_key").rangeBetween(Window.unboundedPreceding, -1)
    following = F.max(F.struct("_key", "n_chars", "_hash", "text", "fingerprint")).over(smaller)
    paired = rows.withColumn("_next", following).where(~F.col("_visit"))

    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half)
    edited = F.concat(kept, F.substring("_next.text", F.lit(1), half))
    out = paired.select("doc_id", "n_chars", "fingerprint", edited.alias("_edited"), F.col("_next.fingerprint").alias("_next_print"))
    out = out.select("*", F.sha2("_edited", 256).alias("edited_sha256"), fingerprint(F.col("_edited")).alias("edited_fingerprint"))
    pair = (F.col("fingerprint"), F.col("edited_fingerprint"))
    return out.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(*pair).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next_print")).alias("near_next"),
        first_difference(*pair).alias("_where"),
    ).select("*", "_where.section", "_where.paragraph").drop("_where").withColumnsRenamed(
        {"section": "edit_section", "paragraph": "edit_paragraph"}
    )
