from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import DOC_SCHEMA, documents, frame, words

import corpus_pipeline
from touchline.llm import catalog, toxicity_fm


def data(seed=0, n=600):
    """Toxic where two mild terms meet: what additive weights alone cannot tell."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        w = words(rng, 20).split(" ") + ["grumlo"] * a + ["the-zorps"] * b
        rng.shuffle(w)
        rows.append((i, " ".join(w), int(a and b)))
    return rows


def auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean())


def test_scores_against_the_formula():
    rng = np.random.default_rng(0)
    m = toxicity_fm.Model(0.3, rng.normal(size=50).astype(np.float32), rng.normal(size=(50, 4)).astype(np.float32))
    rows = [np.array([1, 5, 9]), np.empty(0, dtype=np.int64), np.array([2, 3])]
    got = m.scores(np.concatenate(rows).astype(np.int64), np.array([0, 3, 3, 5]))
    for r, s in zip(rows, got):
        raw = 0.3 + m.w[r].sum() + sum(m.v[i] @ m.v[j] for k, i in enumerate(r) for j in r[k + 1:])
        assert s == pytest.approx(1 / (1 + np.exp(-raw)), rel=1e-4)


def test_learns_and_holds_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/labels.parquet")
    out = catalog.QUERIES["op9_toxicity_fm"](spark, sf_dir.replace("0.001", "0.01"))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    lab = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    seen = [i for i in rows if i in lab]
    y, s = np.array([lab[i] for i in seen]), np.array([rows[i]["score"] for i in seen])
    assert auc(y, s) > 0.8
    # labels of the held-out fold change nothing
    from pyspark.sql import functions as F

    flipped = labels.withColumn("toxic", F.when(toxicity_fm.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity_fm.train(docs, labels), toxicity_fm.train(docs, flipped)
    assert a.bias == b.bias and (a.w == b.w).all() and (a.v == b.v).all()


def test_fits_in_a_task(spark, monkeypatch):
    """The driver gets the model, never the sample; the model is that of a plain fit on the sampled rows."""
    rows, fit, seen = data(n=300), toxicity_fm.fit, []

    def on_driver(x, y):
        seen.append(len(x))
        return fit(x, y)

    monkeypatch.setattr(toxicity_fm, "fit", on_driver)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = toxicity_fm.train(docs, labels)
    assert not any(seen)
    h = toxicity_fm.TermHasher()
    pairs = sorted((h.ids(t.encode()).tobytes(), y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 5)
    want = fit([np.frombuffer(x, dtype=np.int32) for x, _ in pairs], np.array([y for _, y in pairs]))
    assert got.bias == want.bias and (got.w == want.w).all() and (got.v == want.v).all()
    assert got.w.any() and got.v.shape == (toxicity_fm.BUCKETS, toxicity_fm.FACTORS)
    none = toxicity_fm.train(docs, labels.filter("toxic = 7"))  # no sample
    assert none.bias == -30.0 and not none.w.any() and not none.v.any()


def test_pairs_weigh_in():
    h = toxicity_fm.TermHasher()
    rows = data()
    x, y = [h.ids(t.encode()) for _, t, _ in rows], np.array([v for *_, v in rows])
    m = toxicity_fm.fit(x[:450], y[:450], epochs=30)
    begin = np.concatenate(([0], np.cumsum([len(r) for r in x[450:]])))
    s = m.scores(np.concatenate(x[450:]), begin)
    assert auc(y[450:], s) > 0.95


def test_edge_cases(spark):
    docs = frame(spark, clash=True)
    labels = spark.createDataFrame([(0, 1, None), (None, 1, 1), (9999, 1, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    model = toxicity_fm.train(docs, labels)  # one class only: everything is clean
    out = toxicity_fm.score(docs, model)
    assert out.columns == [*docs.columns, "toxicity"] and out.count() == len(documents())
    assert toxicity_fm.keep_clean(docs, model).count() == len(documents())
    none = spark.createDataFrame([], DOC_SCHEMA)
    assert toxicity_fm.score(none, toxicity_fm.train(none, labels)).count() == 0


def test_pipeline_stages(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "source_mixing", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity_fm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    toxic = {r["doc_id"] for r in toxicity_fm.score(docs, model).filter("toxicity >= 0.5").collect()}
    from test_ngram_join import brute as join_brute
    from test_packing import check_pieces
    from test_suffix_dedup import brute as dedup_brute

    from touchline.llm.common import stage

    def rows(df):
        return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()]

    for name, fn in corpus_pipeline.STAGES:
        before, docs = docs, stage(fn(spark, docs, sf_dir), name)
        if name != "packing":
            assert docs.dtypes == before.dtypes
        old, new = rows(before), rows(docs) if name != "packing" else []
        if name == "toxicity":
            assert {r[0] for r in new} == {r[0] for r in old} - toxic
        elif name == "ngram_jaccard_join":
            groups = join_brute(old, 5, 80)
            assert {r[0] for r in new} == {d for d, n, c in groups if n == 0 or d == c}
        elif name == "suffix_array_dedup":
            sums = {d: s for d, *_, s in dedup_brute(old)}
            assert len(new) == len(old)
            for d, text, _, _, n in new:
                assert n == len(text)
                if "\ufffd" not in text and hashlib.sha256(text.encode()).hexdigest() != sums[d]:
                    # only a cut inside a character may differ: the rest of that character goes
                    assert any(ord(c) > 127 for c in dict((r[0], r[1]) for r in old)[d])
        elif name == "source_mixing":
            sizes = {r[0]: len(r[1].split()) for r in old}
            assert all(len(r[1].split()) <= sizes[r[0]] for r in new)
            total = sum(len(r[1].split()) for r in new)
            assert abs(total - 1.5 * sum(sizes.values())) <= len({r[3] for r in old}) + 1
            assert max(Counter(r[0] for r in new).values()) <= 2
    check_pieces(docs.collect(), rows(before))
