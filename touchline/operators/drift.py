"""Schema gate: how the fields and types of incoming records differ from the contract.

Reading with an explicit schema turns what does not fit into nulls and drops what is
new. Here every record is parsed as a VARIANT, which keeps its own fields and types, and
unfolded field by field: one generated row per deepest field, each container counted at its first
child. The counts per (match, path, type) are partial aggregates, so what is shuffled is
the number of different shapes, not of records. Contract and counts are then compared:

* ``unknown``: a field that the contract does not have (its own fields are not listed);
* ``retyped``: a value of a type that the contract's type does not take (``found``);
* ``missing``: records (or list entries) whose object lacks a field of the contract;
* ``unparsable``: lines that are no JSON; they belong to no match.

A JSON null is a value of any type. Whole numbers are decimals, too, not the reverse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import schemas
from touchline.functions.clock import match_date

ROOT = "$"
NULL = "VOID"


def contract_paths(schema: T.DataType, path: str = ROOT) -> list[tuple[str, str | None, list[str]]]:
    """``(path, parent object's path or null, kinds of value that it takes)`` of every field."""

    def walk(kind: T.DataType, at: str, parent: str | None) -> list[tuple]:
        if isinstance(kind, T.StructType):
            inner = [w for f in kind.fields for w in walk(f.dataType, f"{at}.{f.name}", at)]
            return [(at, parent, ["OBJECT"]), *inner]
        if isinstance(kind, T.ArrayType):
            return [(at, parent, ["ARRAY"]), *walk(kind.elementType, f"{at}[]", None)]
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            return [(at, parent, ["BIGINT", "DECIMAL", "DOUBLE", "FLOAT"])]
        if isinstance(kind, T.IntegralType):
            return [(at, parent, ["BIGINT"])]
        return [(at, parent, ["BOOLEAN" if isinstance(kind, T.BooleanType) else "STRING"])]

    return walk(schema, path, None)


def _depth(schema: T.DataType) -> int:
    if isinstance(schema, T.StructType):
        return 1 + max((_depth(f.dataType) for f in schema.fields), default=0)
    return 1 + _depth(schema.elementType) if isinstance(schema, T.ArrayType) else 0


def _kind(v) -> F.Column:
    """``OBJECT``, ``ARRAY``, ``DECIMAL`` ... without what is inside."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def field_counts(lines: DataFrame, schema: T.StructType = schemas.FRAME_WITH_ID) -> DataFrame:
    """``match_id, path, kind, n``: how often each field occurs with each kind of value in
    the JSON lines (column ``value``); ``path`` is null for unparsable lines."""
    spark = lines.sparkSession
    v = F.try_parse_json("value")
    named = F.coalesce(F.try_variant_get(F.col("v0"), "$.matchId", "string"), match_date(F.try_variant_get(F.col("v0"), "$.wallClock", "bigint")))
    rows = lines.select(v.alias("v0")).withColumn("match_id", named)
    rows = rows.select("match_id", "v0", F.lit(ROOT).alias("path0"), _kind(F.col("v0")).alias("kind0"))
    depth = _depth(schema)
    for i in range(1, depth + 1):
        child = spark.tvf.variant_explode_outer(F.col(f"v{i - 1}").outer()).select(
            F.col("pos").alias(f"pos{i}"), F.col("key").alias(f"key{i}"), F.col("value").alias(f"v{i}"))
        step = F.when(F.col(f"key{i}").isNull(), F.lit("[]")).otherwise(F.concat(F.lit("."), F.col(f"key{i}")))
        rows = rows.lateralJoin(child).withColumn(f"path{i}", F.when(F.col(f"pos{i}").isNotNull(), F.concat(F.col(f"path{i - 1}"), step)))
        rows = rows.withColumn(f"kind{i}", _kind(F.col(f"v{i}"))).drop(f"v{i - 1}", f"key{i}")
    # A field is counted in the row of its first child's first child and so on.
    nodes, first = [], F.lit(True)
    for i in range(depth, -1, -1):
        nodes.append(F.when(first & (F.col(f"path{i}").isNotNull() if i else F.lit(True)), F.struct(
            F.when(F.col(f"kind{i}").isNotNull(), F.col(f"path{i}")).alias("path"), F.col(f"kind{i}").alias("kind"))))
        first = first & F.coalesce(F.col(f"pos{i}") == 0, F.lit(True)) if i else first
    fields = rows.select("match_id", F.explode(F.filter(F.array(*nodes), lambda n: n.isNotNull())).alias("f"))
    return fields.groupBy("match_id", F.col("f.path").alias("path"), F.col("f.kind").alias("kind")).agg(F.count("*").alias("n"))


def drift_report(lines: DataFrame, schema: T.StructType = schemas.FRAME_WITH_ID, optional: Sequence[str] = ("$.matchId",)) -> DataFrame:
    """``match_id, path, problem, found, n`` of everything that differs from the contract.

    ``optional`` names paths that may be absent."""
    spark = lines.sparkSession
    contract = spark.createDataFrame([(p, parent, kinds, p in optional) for p, parent, kinds in contract_paths(schema)],
                                     "path string, parent string, kinds array<string>, optional boolean")
    counts = field_counts(lines, schema)
    known = contract.select(F.col("path").alias("_path"), "kinds")
    held = counts.where("path IS NOT NULL").join(known, F.col("path") == F.col("_path"), "left")
    retyped = held.where(F.col("kinds").isNotNull() & (F.col("kind") != NULL) & ~F.array_contains("kinds", F.col("kind")))
    # A new field is listed once: not again for what lies below it, or below a retyped one.
    over = F.regexp_extract("path", r"^(.*?)(\[\]|\.[^.\[]+)$", 1)
    taken = contract.where(F.array_contains("kinds", F.lit("OBJECT")) | F.array_contains("kinds", F.lit("ARRAY"))).select(F.col("path").alias("_over"), F.col("kinds").alias("_ok"))
    step = F.when(F.col("path").endswith("[]"), F.lit("ARRAY")).otherwise(F.lit("OBJECT"))
    unknown = held.where(F.col("kinds").isNull()).join(taken, (over == F.col("_over")) & F.array_contains("_ok", step), "left_semi")
    totals = counts.where("path IS NOT NULL").groupBy("match_id", "path").agg(F.sum("n").alias("n"))
    objects = counts.where("kind = 'OBJECT'").select(F.col("match_id").alias("_m"), F.col("path").alias("_p"), F.col("n").alias("_n"))
    wanted = objects.join(contract.where(~F.col("optional")).select(F.col("path").alias("_child"), "parent"), F.col("_p") == F.col("parent"))
    missing = wanted.join(totals, F.col("_m").eqNullSafe(F.col("match_id")) & (F.col("_child") == F.col("path")), "left")
    missing = missing.select(F.col("_m").alias("match_id"), F.col("_child").alias("path"), (F.col("_n") - F.coalesce("n", F.lit(0))).alias("n")).where("n > 0")
    nothing = F.lit(None).cast("string")
    parts = [
        unknown.select("match_id", "path", F.lit("unknown").alias("problem"), F.col("kind").alias("found"), "n"),
        retyped.select("match_id", "path", F.lit("retyped").alias("problem"), F.col("kind").alias("found"), "n"),
        missing.select("match_id", "path", F.lit("missing").alias("problem"), nothing.alias("found"), "n"),
        counts.where("path IS NULL").select("match_id", F.lit(ROOT).alias("path"), F.lit("unparsable").alias("problem"), nothing.alias("found"), "n"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
