"""License scans by diagonal voting, in DataFrame functions only.

Every rolling 3-word hash of a document is joined to the positions at which the
templates hold it. A hit at document word p and template word q votes for the
diagonal p - q. Votes are counted per (document, template, diagonal); diagonals
at most ``max_gap`` apart are merged (an inserted or missing word moves the rest
to a neighbouring diagonal) and the merged span is verified by the share of the
template's words that its hits cover, each hit compared word by word.

The template side is a fixed list, so its broadcast does not grow with the data.
Votes are combined before each shuffle and a group is one (document, template),
at most as long as its document.

Null text is empty: no words, no places, no labels, score 0. Repeated or null
ids: one row each (a row key made from the row itself separates them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import lower_ascii, text_or_empty

# The base phrases and their labels.
BASE_PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

#: Phrases and notices of the method's own: (words, label).
NOTICES = [
    ("gnu general public license version 2", "gpl-2"),
    ("gnu general public license version 3", "gpl-3"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license version 2", "mpl-2"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in "
     "compliance with the license", "apache-2"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met", "bsd"),
    ("released into the public domain", "public-domain"),
]

K = 3
#: Diagonals this close are one alignment.
MAX_GAP = 2
#: A notice is reported when at least this share of its words is matched.
MIN_COVER = 0.85
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _gram(words: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + j) for j in range(K)])


def templates(spark, base=None, notices=None) -> DataFrame:
    """``tid, label, is_base, n_grams, n_template_words, q, h, q_words``: one row per template position."""
    rows = [(i, label, i < len(base or BASE_PHRASES), text.split(" "))
            for i, (text, label) in enumerate([*(base or BASE_PHRASES), *(NOTICES if notices is None else notices)])]
    t = spark.createDataFrame(rows, "tid int, label string, is_base boolean, tw array<string>")
    t = t.withColumn("q", F.explode(F.sequence(F.lit(0), F.size("tw") - K)))
    return t.select("tid", "label", "is_base", F.size("tw").alias("n_tw"), (F.size("tw") - K + 1).alias("n_grams"),
                    "q", _gram(F.col("tw"), F.col("q")).alias("h"), F.slice("tw", F.col("q") + 1, K).alias("q_words"))


def hits(docs: DataFrame, tmpl: DataFrame) -> DataFrame:
    """Verified (row key, position) x (template, position) matches of all rolling word 3-grams."""
    grams = docs.filter(F.size("_w") >= K).select(
        "_key", "_w", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("_w") - K),
                                               lambda i: _gram(F.col("_w"), i))).alias("p", "h"))
    m = grams.join(F.broadcast(tmpl), "h").filter(F.slice("_w", F.col("p") + 1, K) == F.col("q_words"))
    return m.select("_key", "tid", "label", "is_base", "n_grams", "n_tw", "p", "q", (F.col("p") - F.col("q")).alias("diag"))


def spans(hit: DataFrame, max_gap: int = MAX_GAP, min_cover: float = MIN_COVER) -> DataFrame:
    """Merged, verified spans: ``_key, tid, label, is_base, first_word, end_word, cover, exact``."""
    votes = hit.groupBy("_key", "tid", "diag").agg(
        F.first("label").alias("label"), F.first("is_base").alias("is_base"),
        F.first("n_grams").alias("n_grams"), F.first("n_tw").alias("n_tw"),
        F.min("p").alias("first"), (F.max("p") + K).alias("end"), F.collect_set("q").alias("qs"))
    # Template positions hit on the diagonal; a repeated input row does not vote twice.
    votes = votes.withColumn("votes", F.size("qs"))
    w = Window.partitionBy("_key", "tid").orderBy("diag")
    # A new alignment begins where the next diagonal is far, or the template has already been begun anew.
    new = (F.col("diag") - F.lag("diag").over(w) > max_gap) | F.lag("diag").over(w).isNull()
    # A complete diagonal is an alignment of its own.
    whole = (F.col("votes") == F.col("n_grams")) | (F.lag("votes").over(w) == F.col("n_grams"))
    marked = votes.withColumn("begin", (new | whole).cast("int"))
    marked = marked.withColumn("run", F.sum("begin").over(w))
    merged = marked.groupBy("_key", "tid", "run").agg(
        F.first("label").alias("label"), F.first("is_base").alias("is_base"), F.first("n_tw").alias("n_tw"),
        F.max("n_grams").alias("n_grams"), F.max("votes").alias("top_votes"),
        F.min("first").alias("first_word"), F.max("end").alias("end_word"),
        F.array_distinct(F.flatten(F.collect_list("qs"))).alias("qs"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("qs", lambda q: F.sequence(q, q + K - 1)))))
    merged = merged.withColumn("cover", covered / F.col("n_tw")).withColumn(
        "exact", F.col("top_votes") == F.col("n_grams"))
    return merged.filter(F.when(F.col("is_base"), F.col("exact")).otherwise(F.col("cover") >= min_cover))


def license_scan(docs: DataFrame, base=None, notices=None, max_gap: int = MAX_GAP,
                 min_cover: float = MIN_COVER) -> DataFrame:
    """One row per document with its places, labels, spans and score.

    ``score`` is the largest covered share of a reported template, 0 without one.
    """
    spark = docs.sparkSession
    d = docs.select("doc_id", lower_ascii(text_or_empty()).alias("_t"))
    # One scan gives word counts and hits: a document's words are split once per use.
    words = F.array_remove(F.split("_t", WORD_BREAK), "")
    d = d.select("doc_id", F.xxhash64("doc_id", "_t").alias("_h"), words.alias("_w"))
    keyed = d.select("doc_id", "_h", F.struct("doc_id", "_h").alias("_key"), "_w")
    found = spans(hits(keyed, templates(spark, base, notices)), max_gap, min_cover)
    per_doc = found.groupBy("_key").agg(
        F.count(F.when(F.col("is_base"), 1)).alias("n_base"),
        F.min(F.when(F.col("is_base"), F.col("first_word"))).alias("first_word"),
        F.max(F.when(F.col("is_base"), F.col("first_word"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("is_base"), F.col("label")))).alias("base_set"),
        F.array_sort(F.collect_set("label")).alias("label_set"),
        F.max("cover").alias("score"),
        F.array_sort(F.collect_list(F.struct("first_word", "end_word", "label", "cover"))).alias("spans"))
    per_doc = per_doc.select(F.col("_key.doc_id").alias("_id"), F.col("_key._h").alias("_kh"), *per_doc.columns[1:])
    all_docs = keyed.select("doc_id", "_h", F.size("_w").cast("long").alias("n_words"))
    joined = all_docs.join(per_doc, (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.col("_h") == F.col("_kh")), "left")
    return joined.select(
        "doc_id", "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce(F.concat_ws(",", "base_set"), F.lit("")).alias("base_labels"),
        F.coalesce(F.concat_ws(",", "label_set"), F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "spans")
