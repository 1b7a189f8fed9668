from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import DOC_SCHEMA, documents, frame
from pyspark.sql import functions as F

from touchline.llm import catalog, sharding
from touchline.llm.common import read


def check(rows, docs, shards=16):
    """The contract: every document once, counts one apart, slots gapless, the mixture in each shard."""
    want = Counter((d[0], len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def mixture(rows, shards=16):
    total, per = Counter(r.source for r in rows), Counter((r.shard, r.source) for r in rows)
    n, k = len(rows), len(total)
    for (source, m) in total.items():
        for s in range(shards):
            assert abs(per[s, source] - m / shards) <= 2 + 2 * k * m / n, (source, s)


def test_contract_on_edge_cases(spark):
    docs = documents()
    check(sharding.interleave(frame(spark, clash=True), rows_per_bin=4).collect(), docs)


def test_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    check(catalog.op11_interleave(spark, sf_dir).collect(), docs)
    mixture(sharding.interleave(read(spark, sf_dir, "documents")).collect())


def plain(rows, shards):
    """The same order by plain sorts: rows are with u, the seeded hash, and phase."""
    by = defaultdict(list)
    for r in rows:
        by[r["_source"]].append(r)
    order = []
    for group in by.values():
        group.sort(key=lambda r: r["u"])
        order += [((i + r["phase"]) / len(group), r["_source"], i, r["doc_id"]) for i, r in enumerate(group)]
    order.sort()
    n = len(order)
    return [(x[3], p * shards // n) for p, x in enumerate(order)]


@pytest.mark.parametrize("rows_per_bin", [7, 100, 65536])
def test_equals_plain_sorts(spark, rows_per_bin):
    rng = random.Random(3)
    rows = [(i, f"text {i}", "en", "big" if rng.random() < 0.6 else rng.choice(["a", "b", None]), 1) for i in range(997)]
    df = frame(spark, rows)
    keyed = df.select(*sharding._keys([])).withColumn("_copy", F.lit(0).cast("long"))
    u = F.shiftrightunsigned(F.xxhash64(F.lit(sharding.SEED), *sharding._KEYS, "_copy"), 1)
    phase = (F.shiftrightunsigned(F.xxhash64(F.lit(sharding.SEED), F.col("_source")), 32) + 0.5) / F.lit(float(1 << 32))
    want = plain([r.asDict() for r in keyed.withColumn("u", u).withColumn("phase", phase).collect()], 16)
    got = sharding.interleave(df, rows_per_bin=rows_per_bin).orderBy("shard", "slot").collect()
    assert [(r.doc_id, r.shard) for r in got] == want


def test_hot_source_copies_and_singletons(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPY_BLOCK", 50)
    rows = [(7, "copy", "en", "hot", 1)] * 400 + [(i, "t", "en", "hot", 1) for i in range(100, 500)]
    rows += [(i, "t", "en", f"host{i}", 1) for i in range(1000, 1300)]  # sources of one row each
    got = sharding.interleave(frame(spark, rows), rows_per_bin=32).collect()
    check(got, rows)
    hot = Counter(r.shard for r in got if r.source == "hot")
    single = Counter(r.shard for r in got if r.source != "hot")
    copies = Counter(r.shard for r in got if r.doc_id == 7)
    assert min(hot.values()) >= 40 and max(hot.values()) <= 60
    assert len(single) == 16 and max(single.values()) <= 40
    assert len(copies) == 16 and max(copies.values()) <= 45  # copies are shuffled one by one


def test_independent_of_partitions(spark):
    rows = documents()
    a = sharding.interleave(frame(spark, rows)).collect()
    b = sharding.interleave(frame(spark, rows[::-1]).repartition(5), rows_per_bin=3).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_empty(spark):
    got = sharding.interleave(frame(spark, []))
    assert got.collect() == [] and got.columns == ["doc_id", "source", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_written_shards(spark, tmp_path):
    rows = [*documents(), (31, None, "en", "src1", 0)]  # the same id with empty and with null text
    df = spark.createDataFrame([(*r, {"a": 1}, 5) for r in rows], DOC_SCHEMA + ", m map<string,int>, slot int")
    back = sharding.write_shards(df, str(tmp_path / "out"), shards=4)
    got = back.collect()
    assert Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in got) == Counter(rows)
    assert {r.m["a"] for r in got} == {1}
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and len(slots) == 4
