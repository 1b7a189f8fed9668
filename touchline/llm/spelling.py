"""Spelling variant grouping: words one edit apart, joined by asymmetric q-chunks.

1. Maximal runs of letters of at least ``MIN_LENGTH`` are counted over all texts.
2. For two words of lengths L <= M <= L + 1 the shorter one contributes two disjoint
   chunks, its halves; the longer one contributes its positional grams of the same
   lengths. One edit touches one half only, so the other is a gram of the longer word, at
   its own place or shifted by M - L, that is, within one. Grams at other places can not
   meet a chunk and are not sent.
3. The half that holds the edit is divided again by the same rule (``_segments``, two
   letters each in words up to 32 letters), and what is preserved of it is part of the
   join key. So words that share a key agree but for one short segment, and a common chunk
   has no large group.
4. Candidates are verified by the edit distance with a limit of one.

A word's form is its near word of largest n, if that is ``RATIO`` times its own n or more;
forms are followed to the last, the root, by pointer doubling (n grows ``RATIO``-fold at
each step, so a chain is short).

Null or empty texts have no words; a null doc_id reads as empty in the hash of step 1 of
:func:`noisy_runs`. Repeated rows count again. Ties go to the smallest word in code-point
order. An empty table gives no rows. Extra columns are not read. Whole texts are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import lower_ascii, stage, text_or_empty

MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
LETTERS = r"[A-Za-zÀ-ÿ]"


def runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``doc_id, run``: every maximal run of letters of at least ``min_length``, A-Z lower-cased."""
    found = F.regexp_extract_all(text_or_empty(), F.lit(f"{LETTERS}{{{min_length},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run")).select("doc_id", lower_ascii(F.col("run")).alias("run"))


def noisy_runs(found: DataFrame, every: int = 31) -> DataFrame:
    """``word``: the runs, with one letter left out of those whose crc32 with the doc_id
    ``every`` divides: the misspellings that a corpus is given for a test of the grouping."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    hashed = found.select("run", h.alias("_h"), F.length("run").alias("_l"))
    at = F.expr("cast(_h % _l as int)")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("_l")))
    return hashed.select(F.when(F.col("_h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words of at least ``min_length`` letters and ``min_count`` occurrences."""
    counted = words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _segments(length) -> F.Column:
    """Number of segments of a word: both halves divided until two letters are left, at most 16."""
    return F.when(length <= 8, 4).when(length <= 16, 8).otherwise(16)


def _keys(words: DataFrame, longer_by: int) -> DataFrame:
    """``word, n, length, segment, gram, rest``: a row per segment that may hold the edit.

    ``length`` is that of the shorter word of a pair, which this word is (``longer_by`` 0)
    or exceeds by one. ``gram`` is the half that the edit leaves alone (a chunk of the
    shorter word, a gram of the longer one), ``rest`` a hash of what else it leaves alone."""
    w = words.withColumn("length", F.length("word") - longer_by)
    w = w.withColumn("_k", _segments(F.col("length"))).withColumn("segment", F.explode(F.expr("sequence(0, _k - 1)")))
    w = w.withColumn("_from", F.expr("cast(segment * length div _k as int)")).withColumn("_to", F.expr("cast((segment + 1) * length div _k as int)"))
    half, first = F.expr("cast(length div 2 as int)"), F.expr("segment * 2 < _k")
    all_ = F.length("word")
    # The half with the segment, without the segment.
    before = F.when(first, F.substring("word", F.lit(1), F.col("_from"))).otherwise(F.substring("word", half + 1, F.col("_from") - half))
    after = F.when(first, F.substring("word", F.col("_to") + longer_by + 1, half - F.col("_to"))).otherwise(F.substring("word", F.col("_to") + longer_by + 1, all_))
    gram = F.when(first, F.substring("word", half + longer_by + 1, all_)).otherwise(F.substring("word", F.lit(1), half))
    return w.select("word", "n", "length", "segment", gram.alias("gram"), F.xxhash64(before, after).alias("rest"))


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: pairs of words exactly one edit apart, each once, from ``word, n``."""
    chunks = _keys(words, 0)
    grams = chunks.withColumn("shift", F.lit(0)).unionByName(
        _keys(words.filter(F.length("word") > 1), 1).withColumn("shift", F.lit(1)))
    chunks = chunks.select(F.col("word").alias("a"), F.col("n").alias("a_n"), *[F.col(c).alias(f"_{c}") for c in ("length", "segment", "gram", "rest")])
    grams = grams.withColumnRenamed("word", "b").withColumnRenamed("n", "b_n")
    same = [F.col(f"_{c}") == F.col(c) for c in ("length", "segment", "gram", "rest")]
    # Words of equal length meet in both orders: one is enough.
    pairs = chunks.join(grams, [*same, (F.col("shift") == 1) | (F.col("a") < F.col("b"))])
    return pairs.filter(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form`` (one form a word, no circles): the last of the chain."""
    found = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        nxt = found.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        moved = stage(found.join(nxt, F.col("root") == F.col("_w"), "left").select(
            "word", F.coalesce("_r", "root").alias("root"), F.isnotnull("_r").alias("_moved")), "spelling-roots")
        found = moved.drop("_moved")
        if moved.filter("_moved").isEmpty():
            return found


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word of ``word, n``: ``word, form, root, n, n_near, form_n``."""
    words = stage(words.select("word", "n"), "spelling-words")
    pairs = stage(near_pairs(words), "spelling-pairs")
    ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = ends.groupBy("a", "a_n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("x"), F.col("b"))).alias("_m"))
    best = best.select("a", "a_n", "n_near", F.col("_m.b").alias("_b"), (-F.col("_m.x")).alias("_bn"))
    is_form = F.col("_bn") >= ratio * F.col("a_n")
    best = stage(best.select("a", "n_near", F.when(is_form, F.col("_b")).alias("form"), F.when(is_form, F.col("_bn")).alias("form_n")), "spelling-forms")
    root = roots(best.filter("form IS NOT NULL").select(F.col("a").alias("word"), "form")).withColumnRenamed("word", "_r")
    out = words.join(best, F.col("word") == F.col("a"), "left").join(root, F.col("word") == F.col("_r"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The words of all texts, as :func:`noisy_runs` leaves them, with their forms and roots."""
    return group_variants(vocabulary(noisy_runs(runs(docs))))
