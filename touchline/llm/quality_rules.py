"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A document passes through rules in order and stops at the first that rejects it.
The order comes from a bounded sample: each rule's cost (timed) and selectivity
(share it rejects) give its rejections per cost, and the rule with the most goes
first. The verdict is the conjunction of the rules, so it does not depend on that
order; ``failed_rule`` names the first rule of the order that rejected.

Null text counts as empty (no words, base rule fails). Null or repeated ids are
kept as they are, one output row per input row. Extra input columns are dropped.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import space_words, text_or_empty

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Rows of the sample that orders the rules. The order changes speed, never a verdict.
SAMPLE_ROWS = 1000


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets the feature columns by name and is true for a bad document."""

    name: str
    rejects: Callable[[], Column]


def _ratio_over(part: Column, per_cent: int, whole: Column) -> Column:
    return part * 100 > whole * per_cent


#: The cascade's rules beside the base rule. Each reads base features or the text.
RULES = [
    Rule("symbols", lambda: _ratio_over(F.col("n_symbols"), 20, F.col("word_chars"))),
    Rule("duplicate_lines", lambda: _ratio_over(F.col("n_dup_lines"), 50, F.col("_n_lines"))),
    Rule("word_length", lambda: (F.col("word_chars") < 2 * F.col("n_words"))
         | (F.col("word_chars") > 25 * F.col("n_words"))),
    Rule("digits", lambda: _ratio_over(
        F.length("_text") - F.length(F.translate(F.col("_text"), "0123456789", "")), 40, F.col("word_chars"))),
    Rule("ellipsis_lines", lambda: _ratio_over(
        F.size(F.filter(F.col("_lines"), lambda x: x.endswith("..."))), 50, F.col("_n_lines"))),
]

BASE_RULE = Rule("base", lambda: F.col("base_failed"))


def covered_by_repeats(words: Column) -> Column:
    """Words inside a 3-word window that occurs twice or more in the array."""
    n = F.size(words)
    windows = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p")),
    )
    return F.when(n >= 3, windows)


def with_features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the base features; internal columns begin with an underscore.

    The repeated windows are found by sorting a document's own window hashes, so
    a document is one row all the way and nothing is shuffled.
    """
    d = docs.select("doc_id", text_or_empty().alias("_text"))
    d = d.select("*", space_words(F.col("_text")).alias("_words"),
                 F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
                 .alias("_lines"))
    d = d.select(
        "doc_id", "_text", "_lines",
        F.size("_lines").cast("long").alias("_n_lines"),
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate(F.col("_text"), " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate(F.col("_text"), SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered_by_repeats(F.col("_words")).alias("_win"),
    )
    # Sorting is needed only where some window occurs twice.
    has_repeat = F.size(F.array_distinct(F.col("_win.h"))) < F.size("_win")
    d = d.withColumn("_win", F.when(has_repeat, F.sort_array("_win")))
    same = lambda a, i, x: F.coalesce(F.get(a, i)["h"] == x["h"], F.lit(False))
    d = d.withColumn("_pos", F.sort_array(F.transform(
        F.filter("_win", lambda x, i: same(F.col("_win"), i - 1, x) | same(F.col("_win"), i + 1, x)),
        lambda x: x["p"])))
    # Each window covers 3 words, or as many as lie before the next such window.
    covered = F.aggregate(
        F.transform("_pos", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_pos", i + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"), lambda acc, x: acc + x)
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_win", "_pos")
    return d.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def cascade_order(features: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per second on at most ``sample_rows`` rows, most first.

    A timing is not repeatable, so neither is the order; verdicts are.
    """
    sample = features.limit(sample_rows).select(*[c for c in features.columns if c != "doc_id"]).cache()
    try:
        total = sample.count()
        if not total:
            return list(rules)
        scored = []
        for i, rule in enumerate(rules):
            began = time.perf_counter()
            rejected = sample.filter(rule.rejects()).count()
            scored.append((-(rejected / total) / max(time.perf_counter() - began, 1e-4), i))
    finally:
        sample.unpersist()
    return [rules[i] for _, i in sorted(scored)]


def apply_cascade(features: DataFrame, ordered: list[Rule]) -> DataFrame:
    """Adds ``failed_rule`` (null if kept) and ``kept``. A CASE stops at the first
    rejecting rule, so later rules are not evaluated for a rejected document."""
    failed = F.when(ordered[0].rejects(), F.lit(ordered[0].name))
    for rule in ordered[1:]:
        failed = failed.when(rule.rejects(), F.lit(rule.name))
    return features.withColumn("failed_rule", failed).withColumn("kept", F.col("failed_rule").isNull())


def quality_rules(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: base features, ``base_failed``, ``failed_rule``, ``kept``."""
    features = with_features(docs)
    ordered = cascade_order(features, [BASE_RULE, *(RULES if rules is None else rules)], sample_rows)
    out = apply_cascade(features, ordered)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "failed_rule")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) > 0) AS ls FROM d),
p AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - 1, 1))) AS i, ws FROM w WHERE len(ws) >= 3),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i+1], ws[i+2]) AS c FROM p),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (
        SELECT doc_id, unnest([i, i+1, i+2]) AS j FROM g WHERE c >= 2) GROUP BY doc_id),
f AS (SELECT w.doc_id, w.t, ls, len(ws)::BIGINT AS n_words,
             length(regexp_replace(w.t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             (length(w.t) - length(regexp_replace(w.t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(r.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR 100 * n_symbols > 20 * word_chars
            OR 100 * n_dup_lines > 50 * len(ls)
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words
            OR 100 * (length(t) - length(regexp_replace(t, '[0-9]', '', 'g'))) > 40 * word_chars
            OR 100 * len(list_filter(ls, lambda x: ends_with(x, '...'))) > 50 * len(ls)) AS kept
FROM b
"""
