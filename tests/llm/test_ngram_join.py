from __future__ import annotations

import random
import re

import numpy as np
import pytest
from helpers import DOC_SCHEMA, ascii_lower, documents, frame, words

from touchline.llm import ngram_join

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = SPLIT.findall(ascii_lower(text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, threshold):
    sets = {}
    for r in rows:
        sets.setdefault((r[0], r[1]), shingles(r[1], k))
    keys = list(sets)
    root = {i: i for i in range(len(keys))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            a, b = sets[keys[i]], sets[keys[j]]
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    first = {}  # the texts of one id are one document
    for i, (doc, _) in enumerate(keys):
        if doc is not None and sets[keys[i]]:
            x, y = find(i), find(first.setdefault(doc, i))
            root[max(x, y)] = min(x, y)
    groups = {}
    for i, (doc, _) in enumerate(keys):
        groups.setdefault(find(i), []).append(doc)
    low = {g: min((d for d in ds if d is not None), default=None) for g, ds in groups.items()}
    return sorted(((doc, len(sets[doc, text]), low[find(i)]) for i, (doc, text) in enumerate(keys)), key=repr)


@pytest.mark.parametrize("k,threshold", [(3, 90), (5, 80)])
def test_matches_brute_force(spark, k, threshold):
    rows = documents()
    for clash in (False, True):
        got = ngram_join.ngram_join(frame(spark, rows, clash), k, threshold)
        assert got.columns == ["doc_id", "n_shingles", "component_id"]
        got = [tuple(r) for r in got.collect()]
        assert len(got) == len(rows)
        assert sorted(set(got), key=repr) == brute(rows, k, threshold)


def test_blocks_over_many_tiles(spark):
    """A cluster of variants: some pairs link, some do not; blocks are dealt over tiles."""
    rng = random.Random(4)
    base = words(rng, 150).split(" ")
    rows = []
    for i in range(80):
        w = list(base)
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = f"w{rng.random()}"
        rows.append((i, " ".join(w), "en", "s", 1))
    for chunk in (1 << 20, 1500):
        got = ngram_join.ngram_join(frame(spark, rows), 3, 90, chunk=chunk)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 3, 90)


def test_tree_keeps_every_possible_pair():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2**63, 60 + i % 9, dtype=np.uint64)) for i in range(70)]
    for i in range(0, 70, 3):
        sets[i] = np.unique(np.concatenate([sets[0][:56], rng.integers(0, 2**63, 5, dtype=np.uint64)]))
    sets.sort(key=len)
    maps = [ngram_join.bitmap(s, 4) for s in sets]
    tree = ngram_join.SignatureTree(maps, [len(s) for s in sets], min(len(m) for m in maps))
    left = {(a, b) for i, j in ngram_join.candidates(tree, tree, True, 80) for a, b in zip(i.tolist(), j.tolist())}
    linked = {(i, j) for i in range(70) for j in range(i + 1, 70)
              if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert linked and linked <= left
    assert len(left) < 70 * 69 / 4  # and it prunes


def test_empty_table_and_one_per_group(spark):
    assert ngram_join.ngram_join(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
    docs = frame(spark)
    kept = ngram_join.one_per_group(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 20 not in ids and 21 not in ids and {0, 1, 30, 31, 32, 33} <= set(ids)


A, B, C = "one two three four five six", "seven eight nine ten eleven twelve", "some words that no other text has"


def test_texts_of_a_repeated_id_are_one_document(spark):
    rows = [(1, A, "en", "s", 1), (2, B, "en", "s", 1), (5, A, "en", "s", 1), (5, B, "en", "s", 1), (7, C, "en", "s", 1), (5, "", "en", "s", 0)]
    got = sorted(tuple(r) for r in ngram_join.ngram_join(frame(spark, rows)).collect())
    assert got == [(1, 4, 1), (2, 4, 1), (5, 0, 5), (5, 4, 1), (5, 4, 1), (7, 4 + 1, 7)]
    assert sorted(got, key=repr) == brute(rows, 3, 90)
    kept = sorted((r["doc_id"], r["text"]) for r in ngram_join.one_per_group(frame(spark, rows)).collect())
    assert kept == [(1, A), (5, ""), (7, C)]


def test_repeated_rows_of_a_kept_id(spark):
    rows = [(1, A, "en", "s", 1), (1, A, "en", "s", 1), (1, C, "en", "t", 1), (2, B, "en", "s", 1),
            (None, A, "en", "s", 1), (None, A, "en", "s", 1), (3, None, "en", "s", 0), (3, None, "en", "s", 0)]
    kept = ngram_join.one_per_group(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert got == sorted([(1, A), (2, B), (3, None), (3, None), (None, A), (None, A)], key=repr)
