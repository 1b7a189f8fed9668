"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Each source has a weight and a size (words). A token budget is shared in
proportion to the weights; a source may not exceed ``max_epochs`` times its size,
and what it cannot take is shared again among the others until none is above.
The sources' level is found by rounds of plain aggregates (each round clamps at
least one more source), so no source's documents are gathered anywhere.

A source at rate ``target / size`` takes every document ``floor(rate)`` whole
times and the fraction of one further repetition from a seeded order of its
documents: those whose seeded hash comes first, up to the remaining words, the
document on the border in part. The border is found by a histogram of the hash
(``BINS`` bins per source, pre-aggregated), then by a running sum inside the one
border bin, so a hot source is never sorted whole.

Null source is a source of its own (last in the order); null text has size 0.
Repeated rows of one doc_id hash alike and are ordered by size among themselves;
an empty table gives an empty result. Extra columns are dropped by :func:`mix`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import SPACE_CLASS, stage, text_or_empty

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET_SHARE = 1.5
MAX_EPOCHS = 2.0
SEED = 7
#: Copies of a source's plan row that its documents are dealt over.
SALTS = 64
#: Histogram bins of one source. A border bin holds about 1 / BINS of a source.
BINS = 65536


def n_words(text):
    """Runs of non-space: places where a word begins, without building the words."""
    return F.size(F.array_remove(F.split(text, SPACE_CLASS), "")).cast("long")


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id, source, size, u`` with u a seeded hash of doc_id in [0, 2**32)."""
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 8), 16, 10)
    return docs.select("doc_id", "source", n_words(text_or_empty()).alias("size"), u.cast("long").alias("u"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget_share: float = BUDGET_SHARE,
                   max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, weight, target`` from one row per source (source, source_size).

    Sources in code-point order, null last, take the weights in turn.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = stage(sizes.select("source", F.col("source_size").cast("long").alias("source_size"), w.alias("weight")), "mix-sources")
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = s.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    budget = total * float(budget_share)
    # A source is clamped when level * weight > cap. The level only rises, so the
    # clamped set only grows, and it stops changing after at most one round a source.
    clamped_before = -1
    level = 0.0
    while True:
        is_clamped = F.lit(level) * F.col("weight") >= cap
        row = s.agg(F.sum(F.when(is_clamped, cap).otherwise(0.0)).alias("taken"),
                    F.sum(F.when(is_clamped, 0.0).otherwise(F.col("weight"))).alias("open"),
                    F.count(F.when(is_clamped, 1)).alias("n")).first()
        if row["n"] == clamped_before or not row["open"]:
            break
        clamped_before = row["n"]
        level = max(level, (budget - row["taken"]) / row["open"])
    return s.withColumn("target", F.least(F.lit(level) * F.col("weight"), cap))


def mix(docs: DataFrame, weights=WEIGHTS, budget_share: float = BUDGET_SHARE, max_epochs: float = MAX_EPOCHS,
        seed: int = SEED, bins: int = BINS) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, whole, part, taken``.

    ``whole`` is how often the document is taken entire, ``part`` the words of the
    further repetition (0, its size, or, on the border, something between).
    """
    d = stage(sized(docs, seed), "mix-sizes")
    targets = source_targets(d.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget_share, max_epochs)
    targets = stage(targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
                    .withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
                    .withColumnRenamed("source", "_s"), "mix-targets")
    span = 2**32 // bins
    binned = d.withColumn("bin", F.floor(F.col("u") / span).cast("int"))
    hist = binned.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
    hist = hist.withColumn("upto", upto).join(targets.select("_s", "rest"), F.col("source").eqNullSafe(F.col("_s")))
    # The border bin is the first whose running total reaches the rest.
    border = hist.filter((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest"))).groupBy("_s").agg(
        F.min("bin").alias("border"), F.min(F.col("upto") - F.col("words")).alias("before"))
    plan = targets.join(border.withColumnRenamed("_s", "_b"), F.col("_s").eqNullSafe(F.col("_b")), "left").drop("_b")
    # The plan has one row per source. Its rows are repeated over SALTS, and a document
    # joins the copy that its hash names, so a hot source's documents go to many tasks.
    plan = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    m = binned.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("u") % SALTS == F.col("_salt")), "left")
    outside = m.filter(F.coalesce(F.col("bin") != F.col("border"), F.lit(True))).withColumn(
        "part", F.when(F.col("bin") < F.col("border"), F.col("size")).otherwise(F.lit(0)).cast("long"))
    before = F.sum("size").over(Window.partitionBy("source").orderBy("u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1))
    inside = m.filter(F.col("bin") == F.col("border")).withColumn("_before", F.coalesce(before, F.lit(0)) + F.col("before"))
    inside = inside.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("_before"))).cast("long"))
    cols = ["doc_id", "source", "size", "source_size", "target", "whole", "part"]
    out = outside.select(*cols).unionByName(inside.select(*cols))
    return out.withColumn("taken", F.col("whole") * F.col("size") + F.col("part"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows: each document ``whole`` times, and once more, cut after
    ``part`` words, where it has a part. Columns are those of ``docs``.

    Rows with the same doc_id, source and size share a plan row (repeats included).
    """
    plan = mix(docs, **options)
    keys = ["doc_id", "source", "size"]
    plan = plan.groupBy(*keys).agg(F.max("whole").alias("_whole"), F.max("part").alias("_part"))
    plan = plan.select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z"), "_whole", "_part")
    d = docs.withColumn("_size", n_words(text_or_empty()))
    j = d.join(plan, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_size") == F.col("_z")))
    full = F.array_repeat(F.lit(-1), (F.col("_whole") + (F.col("_part") >= F.col("_size")).cast("int") * (F.col("_size") > 0).cast("int")).cast("int"))
    cut = F.when((F.col("_part") > 0) & (F.col("_part") < F.col("_size")), F.array(F.col("_part").cast("int"))).otherwise(F.array().cast("array<int>"))
    j = j.withColumn("_take", F.explode(F.concat(full, cut)))
    pieces = F.concat_ws(" ", F.slice(F.array_remove(F.split("text", SPACE_CLASS), ""), F.lit(1), F.greatest(F.col("_take"), F.lit(0))))
    text = F.when(F.col("_take") < 0, F.col("text")).otherwise(pieces)
    return j.withColumn("text", text).select(*docs.columns)


def _sql(weights=WEIGHTS, share=BUDGET_SHARE, epochs=MAX_EPOCHS, seed=SEED, bins=BINS) -> str:
    w = ", ".join(f"{x:g}" for x in weights)
    return f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('{seed}|' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS u FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS z,
             list_value({w})[((row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(weights)} + 1)::INT]::DOUBLE AS w
      FROM d GROUP BY source),
-- The level at which the sources up to this one, in the order of size by weight, are at their cap.
o AS (SELECT *, {epochs} * z / w AS r,
             coalesce(sum({epochs} * z) OVER (ORDER BY {epochs} * z / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
             sum(w) OVER (ORDER BY {epochs} * z / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
             {share} * sum(z) OVER () AS budget FROM s),
l AS (SELECT arg_min((budget - capped) / open, r) FILTER (r > (budget - capped) / open) AS level FROM o),
t AS (SELECT source, z::BIGINT AS source_size, round(least(w * coalesce(level, 1e300), {epochs} * z), 6) AS target,
             least(w * coalesce(level, 1e300), {epochs} * z) AS exact FROM s, l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(exact / source_size) ELSE 0 END::BIGINT AS whole FROM t),
q AS (SELECT *, round(exact - whole * source_size)::BIGINT AS rest FROM p),
c AS (SELECT d.*, q.source_size, q.target, q.whole, q.rest,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY u, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM c
"""


ORACLE = _sql()
