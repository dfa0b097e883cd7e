"""License and copyright notices, found by ordered signatures.

A text is taken as words: A-Z become small, every run of ASCII bytes other than letters and digits
parts two words, all else belongs to words. A signature is a regular expression over words, hand-written
in `license_rules`, that is tried only on texts that hold its keyword; keywords are found by one
intersection with the words of the text. All signatures of a text run side by side, and what they find
is placed by running sums of the words between the matches.

Detections overlap: "GNU General Public License version 3" holds the name of the license, its version
and a hint. A detection goes if its words all lie in those of another one of a better tier, or of its
own tier that is longer, or as long and earlier in the list. Phrases of `base` stand outside of this.

All of it is expressions, windows over the detections of one text, and one shuffle of narrow rows.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearfold.llm.license_rules import signatures

BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: How sure a detection of each tier makes that a text speaks of its license; tier 0 are base phrases.
CONFIDENCE = {0: 0.5, 1: 1.0, 2: 0.9, 3: 0.7, 4: 0.3}

Rule = tuple[int, str, str, str]


def over_words(pattern: str) -> str:
    """The pattern for a text in which every word has a space of its own on either side."""
    return f" {pattern.replace(' ', '  ')} "


def all_rules(base: Sequence[tuple[str, str]] = BASE) -> list[Rule]:
    """`tier, label, keyword, pattern`, base phrases first."""
    for phrase, _ in base:
        words = phrase.split(" ")
        if any(words[:k] == words[-k:] for k in range(1, len(words))):
            raise ValueError(f"places of {phrase!r} can share words")
    return [(0, label, phrase.split(" ")[-1], phrase) for phrase, label in base] + signatures()


def _by_keyword(rules: Sequence[Rule]) -> Column:
    """Map from keyword to its rules as structs `no, tier, label, pattern`."""
    entries = []
    numbered = sorted(enumerate(rules), key=lambda r: r[1][2])
    for keyword, own in groupby(numbered, key=lambda r: r[1][2]):
        structs = [
            F.struct(
                F.lit(no).alias("no"), F.lit(tier).alias("tier"), F.lit(label).alias("label"),
                F.lit(over_words(pattern)).alias("pattern"),
            )
            for no, (tier, label, _, pattern) in own
        ]
        entries += [F.lit(keyword), F.array(*structs)]
    return F.create_map(*entries)


def _n_words(padded: Column) -> Column:
    return F.floor((F.length(padded) - F.length(F.replace(padded, F.lit(" "), F.lit("")))) / 2)


def _found(rules: Sequence[Rule]) -> Column:
    """What each rule of the keywords `present` finds in `padded`: words before and in its matches."""
    table = _by_keyword(rules)
    due = F.flatten(F.transform("present", lambda k: F.element_at(table, k)))
    found = F.transform(
        due,
        lambda r: F.struct(
            r["no"].alias("no"), r["tier"].alias("tier"), r["label"].alias("label"),
            F.transform(F.split("padded", r["pattern"]), _n_words).alias("before"),
            F.transform(F.regexp_extract_all("padded", r["pattern"], F.lit(0)), _n_words).alias("inside"),
        ),
    )
    return F.filter(found, lambda f: F.size(f["inside"]) > 0)


def detections(docs: DataFrame, id_col: str, text_col: str, rules: Sequence[Rule]) -> DataFrame:
    """`row, doc_id, n_words, no, tier, label, start, stop, kept`: every match of every rule.

    `row` numbers the rows of this read. A text without a match has one row with nulls.
    """
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    said = F.regexp_replace(F.translate(F.coalesce(F.col(text_col), F.lit("")), upper, lower), SEPARATORS, "  ")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.trim(said).alias("said"))
    rows = rows.select(
        "row", "doc_id",
        F.when(F.col("said") != "", F.split("said", "  ")).otherwise(F.array().cast("array<string>")).alias("words"),
        F.when(F.col("said") != "", F.concat(F.lit(" "), "said", F.lit(" "))).otherwise("").alias("padded"),
    )
    keywords = F.array(*[F.lit(k) for k in sorted({r[2] for r in rules})])
    rows = rows.select(
        "row", "doc_id", F.size("words").cast("bigint").alias("n_words"),
        "padded", F.array_intersect(keywords, "words").alias("present"),
    )
    rows = rows.select("row", "doc_id", "n_words", F.explode_outer(_found(rules)).alias("f"))
    match = F.arrays_zip(F.slice("f.before", 1, F.size("f.inside")).alias("before"), F.col("f.inside").alias("inside"))
    rows = rows.select("row", "doc_id", "n_words", "f.no", "f.tier", "f.label", F.posexplode_outer(match).alias("place", "m"))
    rows = rows.repartition("row")
    of_rule = Window.partitionBy("row", "no").orderBy("place")
    so_far, until = (of_rule.rowsBetween(Window.unboundedPreceding, k) for k in (0, -1))
    start = F.sum("m.before").over(so_far) + F.coalesce(F.sum("m.inside").over(until), F.lit(0))
    rows = rows.select(
        "row", "doc_id", "n_words", "no", "tier", "label", start.alias("start"), (start + F.col("m.inside")).alias("stop")
    )
    outer = Window.partitionBy("row").orderBy("start", F.desc("stop"), "no").rowsBetween(Window.unboundedPreceding, -1)
    tiers = sorted({r[0] for r in rules} - {0})
    reach = {f"reach_{t}": F.max(F.when((F.col("tier") > 0) & (F.col("tier") <= t), F.col("stop"))).over(outer) for t in tiers}
    rows = rows.withColumns(reach)
    covered = F.lit(False)
    for t in tiers:
        covered = covered | ((F.col("tier") == t) & (F.coalesce(f"reach_{t}", F.lit(-1)) >= F.col("stop")))
    return rows.withColumn("kept", F.col("tier").isNotNull() & ~covered).drop(*reach)


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: Sequence[tuple[str, str]] = BASE,
    rules: Sequence[Rule] | None = None,
) -> DataFrame:
    """One row for every row of `docs`: what its text says about its license.

    `n_words`; `n_base`, the places of `base` phrases, with the smallest and largest of their starts in
    words, `first_word, last_word` (null without any); `base_labels` and `labels`, the latter with those of
    kept detections, sorted arrays of distinct labels; `score`, the confidence of the best detection, 0
    without any; `detections`, the kept ones as `start, stop, label, tier` in words.

    A null text is empty and has no words; a null id stays null; rows that share an id or are equal in
    all columns are rows of their own. Whole texts are read, whatever their length. Other columns are
    not read. `base` phrases must not overlap themselves.
    """
    rules = all_rules(base) if rules is None else rules
    found = detections(docs, id_col, text_col, rules)
    is_base, kept = F.col("tier") == 0, F.col("kept")
    sure = F.coalesce(*[F.when(F.col("tier") == t, F.lit(c)) for t, c in CONFIDENCE.items()])
    spans = F.struct("start", "stop", "label", "tier")
    return found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.count(F.when(is_base, 1)).alias("n_base"),
        F.min(F.when(is_base, F.col("start"))).alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(is_base, F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set(F.when(kept, F.col("label")))).alias("labels"),
        F.coalesce(F.max(F.when(kept, sure)), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(kept, spans))).alias("detections"),
    ).drop("row")
