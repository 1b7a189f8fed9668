from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from helpers import DOC_SCHEMA, documents, frame

from touchline.llm import suffix_dedup


def brute(rows, window=50):
    texts = [((r[0] if r[0] is not None else 1 << 62), (r[1] or "").encode()) for r in rows]
    first = {}
    for i, t in sorted(texts):
        for j in range(len(t) - window + 1):
            first.setdefault(t[j:j + window], i)
    out = []
    for (i, t), r in zip(texts, rows):
        gone = np.zeros(len(t), bool)
        for j in range(len(t) - window + 1):
            if first[t[j:j + window]] < i:
                gone[j:j + window] = True
        runs = sum(1 for j in range(len(t)) if gone[j] and (j == 0 or not gone[j - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((r[0], len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"hot_docs": 2, "chunk_bytes": 2000, "bucket_bytes": 2000}])
def test_matches_brute_force(spark, options):
    rows = documents()
    for clash in (False, True):
        got = suffix_dedup.suffix_dedup(frame(spark, rows, clash), **options).drop("kept").collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_low_alphabet_self_repeats(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab") for _ in range(30)) * rng.randint(1, 9), "x", "y", 1) for i in range(40)]
    rows += [(100 + i, rows[i][1][7:] + "\x00" * 60, "x", "y", 1) for i in range(20)]
    got = suffix_dedup.suffix_dedup(frame(spark, rows)).drop("kept").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_segments_of_a_long_text(monkeypatch):
    rng = random.Random(5)
    text = bytes(rng.choice(b"abcd ") for _ in range(5000))
    whole = suffix_dedup.anchors([text], 50, 16)
    monkeypatch.setattr(suffix_dedup, "SLAB", 300)
    cut = suffix_dedup.anchors([text], 50, 16)

    def windows(a):
        return [(h, w) for h, _, lo, hi in zip(*[x.tolist() for x in a]) for w in range(lo, hi + 1)]

    assert sorted(windows(whole)) == sorted(windows(cut)) and len(windows(cut)) == 4951


def test_maximal_repeats_lists_all_occurrences():
    core = b"x" * 5 + b"the quick brown fox jumps over the lazy dog again and again"
    contexts = [b"1" + core + b"a", b"2" + core + b"b", b"3" + core[5:] + b"c"]
    c, o, n, m = suffix_dedup.maximal_repeats(contexts, np.array([7, 8, 9]), 50)
    rows = set(zip(c.tolist(), o.tolist(), n.tolist(), m.tolist()))
    assert {(0, 1, len(core), 7), (1, 1, len(core), 7)} <= rows  # the longer one, in two
    assert {(0, 6, len(core) - 5, 7), (1, 6, len(core) - 5, 7), (2, 1, len(core) - 5, 7)} <= rows  # the shorter, in three
    assert (0, 2, len(core) - 1, 7) not in rows  # not maximal: the byte before is the same


def test_empty_table_and_texts(spark):
    assert suffix_dedup.suffix_dedup(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
    docs = frame(spark)
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[20] == "" and texts[0] == documents()[0][1]
