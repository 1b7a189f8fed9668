"""Proportional stratified interleaving of documents into shards, in DataFrame functions only.

1. Rows are reduced to (doc_id, source, size, crc32 of the text); equal ones collapse to
   one row with a count before anything is ranked, and each copy gets its own seeded hash.
2. The seeded hash shuffles every source. A row's rank in its source is the number of rows
   in earlier hash bins (a histogram, summed over two levels) plus its rank in its bin.
3. A row's fractional rank is (rank + phase) / rows of the source, where the phase is a
   hash of the source in (0, 1): sources of one row are spread over the whole range too.
4. The position by fractional rank is found in the same way: bins, then the rank in a bin.
   Cutting positions evenly gives shards whose row counts differ by at most one, and every
   run of positions holds each source in its share, within a row or two.

No source, text or copy is gathered anywhere: a task ranks one bin of about
``ROWS_PER_BIN`` narrow rows, whatever the source. Texts move only in :func:`write_shards`.

Null text has size 1 (0 bytes) and the crc32 of nothing; null source is a source of its
own; a null doc_id is a value like any other. Repeated rows are placed one by one; which
of them takes which of their slots makes no difference. Order and ties do not depend on
files or partitions. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import stage, text_or_empty

SHARDS = 16
SEED = 11
#: Rows of one bin, the unit that a task ranks; bins of one group of the upper level.
ROWS_PER_BIN, BINS_PER_GROUP = 8192, 1024
#: Copies of one row that one task makes.
COPY_BLOCK = 65536
#: Rows of one written file.
FILE_ROWS = 65536
LAW = "rows"
_KEYS = ["doc_id", "_source", "size", "text_crc32", "_more"]


def _keys(identify: list) -> list:
    """Columns ``_KEYS``: what tells rows apart. ``_source`` is never null."""
    source = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source")))
    return [F.col("doc_id"), source.alias("_source"), (F.octet_length(text_or_empty()) + 1).cast("long").alias("size"),
            F.crc32(text_or_empty()).alias("text_crc32"), (F.xxhash64(*identify) if identify else F.lit(0).cast("long")).alias("_more")]


def _copies(counted: DataFrame) -> DataFrame:
    """One row per copy (``_copy`` from 0). Many copies are made in blocks by many tasks."""
    few = counted.filter(F.col("_m") <= COPY_BLOCK).withColumn("_copy", F.explode(F.expr("sequence(0L, _m - 1)")))
    many = counted.filter(F.col("_m") > COPY_BLOCK).withColumn("_b", F.explode(F.expr(f"sequence(0L, (_m - 1) div {COPY_BLOCK})")))
    many = many.repartition(*_KEYS, "_b").withColumn(
        "_copy", F.explode(F.expr(f"sequence(_b * {COPY_BLOCK}, least(_m, (_b + 1) * {COPY_BLOCK}) - 1)"))).drop("_b")
    return few.unionByName(many).drop("_m")


def _before(rows: DataFrame, keys: list[str], bin_: str) -> DataFrame:
    """``*keys, bin_, _before, _in``: rows of earlier bins and of this one, by ``keys``.

    Sums run over two levels, so a window holds the bins of a group, or one row a group."""
    counts = rows.groupBy(*keys, bin_).agg(F.count("*").alias("_in")).withColumn("_group", F.expr(f"{bin_} div {BINS_PER_GROUP}"))
    groups = counts.groupBy(*keys, "_group").agg(F.sum("_in").alias("_rows"))
    upto = Window.partitionBy(*keys).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("_earlier", F.coalesce(F.sum("_rows").over(upto), F.lit(0)))
    inside = Window.partitionBy(*keys, "_group").orderBy(bin_).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_inside", F.coalesce(F.sum("_in").over(inside), F.lit(0)))
    return counts.join(groups.drop("_rows"), [*keys, "_group"]).select(*keys, bin_, (F.col("_earlier") + F.col("_inside")).alias("_before"), "_in")


def _placed(docs: DataFrame, shards: int, seed: int, identify: list, rows_per_bin: int) -> DataFrame:
    counted = stage(docs.select(*_keys(identify)).groupBy(*_KEYS).agg(F.count("*").alias("_m")), "shard-contents")
    n = counted.agg(F.sum("_m").alias("n")).first()["n"] or 0
    bins = max(1, -(-n // rows_per_bin))

    # Rank in the source, by the seeded hash.
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *_KEYS, "_copy"), 1)
    rows = _copies(counted).withColumn("_u", u).withColumn("_bin", F.expr(f"shiftright(_u, 31) * {bins} div {1 << 32}"))
    before = _before(rows, ["_source"], "_bin")
    sizes = before.groupBy("_source").agg(F.sum("_in").alias("_n"))
    rank = F.row_number().over(Window.partitionBy("_source", "_bin").orderBy("_u", *_KEYS, "_copy")) - 1
    ranked = rows.join(before.join(sizes, "_source"), ["_source", "_bin"]).withColumn("_rank", rank + F.col("_before"))
    phase = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("_source")), 32) + 0.5) / F.lit(float(1 << 32))
    ranked = ranked.withColumn("_at", (F.col("_rank") + phase) / F.col("_n"))
    ranked = ranked.withColumn("_bin", F.least(F.floor(F.col("_at") * bins), F.lit(bins - 1)).cast("long"))
    ranked = stage(ranked.select(*_KEYS, "_rank", "_at", "_bin"), "shard-ranks")

    # Position in the order of fractional ranks, cut evenly.
    order = F.row_number().over(Window.partitionBy("_bin").orderBy("_at", "_source", "_rank")) - 1
    placed = ranked.join(_before(ranked, [], "_bin").drop("_in"), "_bin").withColumn("_p", order + F.col("_before"))
    placed = placed.withColumn("shard", F.expr(f"cast(_p * {shards} div {max(n, 1)} as int)"))
    return placed.withColumn("slot", F.expr(f"_p - (shard * {n}L + {shards - 1}) div {shards}"))


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """One row per document: ``doc_id, source, size, text_crc32, law, shard, slot, grown_shard``.

    ``slot`` counts from 0 in its shard; ``grown_shard`` is null, since rows move when the
    number of shards changes."""
    source = F.when(F.col("_source") != "", F.expr("substring(_source, 2)"))
    return _placed(docs, shards, seed, [], rows_per_bin).select(
        "doc_id", source.alias("source"), "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """Write the documents, all their columns, as Parquet folders ``shard=0`` ... in slot
    order, and read them back with ``shard`` and ``slot``. Columns of these names are
    replaced. A file holds at most ``FILE_ROWS`` consecutive slots of a shard.

    Rows are told apart by all columns but maps, which cannot be compared."""
    docs = docs.drop("shard", "slot")
    others = [f.name for f in docs.schema.fields if f.name not in ("doc_id", "source", "text") and not isinstance(f.dataType, T.MapType)]
    identify = [F.isnull("text"), *others]
    slots = _placed(docs, shards, seed, identify, rows_per_bin)
    slots = slots.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(_KEYS)], "shard", "slot")
    kept = docs.select(F.struct(*docs.columns).alias("_row"), *[c.alias(f"_k{i}") for i, c in enumerate(_keys(identify))])
    names = [f"_k{i}" for i in range(len(_KEYS))]
    kept = kept.dropDuplicates(names)
    same = F.lit(True)
    for i in range(len(_KEYS)):
        same = same & F.col(f"_s{i}").eqNullSafe(F.col(f"_k{i}"))
    out = slots.join(kept, same).select("_row.*", "shard", "slot").withColumn("_file", F.expr(f"slot div {FILE_ROWS}"))
    out = out.repartition("shard", "_file").sortWithinPartitions("shard", "slot").drop("_file")
    out.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)
