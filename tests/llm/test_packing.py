from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import DOC_SCHEMA, documents, frame

from touchline.llm import packing_bfd, packing_bm25, tokens
from touchline.llm.tokens import ChunkTokenizer, encode, tokenizer_path


def reference_ids(text):
    from tokenizers import Tokenizer

    if not hasattr(reference_ids, "tok"):
        reference_ids.tok = Tokenizer.from_file(tokenizer_path())
    return np.array([*reference_ids.tok.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def check_pieces(rows, docs, seq_len=2048):
    ids = defaultdict(list)
    for r in docs:
        ids[r[0]].append(reference_ids(r[1]))
    seqs, per_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append(r)
        per_doc[r["doc_id"]].append(r)
        own = [x for x in ids[r["doc_id"]] if len(x) == r["doc_tokens"]]
        assert any(zlib.crc32(x[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for x in own)
    assert set(per_doc) == set(ids)
    for doc, parts in per_doc.items():
        assert sum(p["length"] for p in parts) == sum(len(x) for x in ids[doc])
        if len(ids[doc]) == 1:
            at = 0
            for p in sorted(parts, key=lambda p: p["start"]):
                assert p["start"] == at
                at += p["length"]
    lengths = []
    for parts in seqs.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= seq_len
        lengths.append(at)
    return lengths


def test_tokenizer_equals_its_library():
    rng, tok = random.Random(3), ChunkTokenizer(tokenizer_path())
    alphabet = "aB'stre 12\n\t.,éÉßÿ×÷ ªº_<|>endoftext日本́ \x1c\x1f\x7f\x85İςΣ—½'ll"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    for t in [*texts, "<|endoftext|> a<|startoftext|>", "it's we'll I'VE", "''s", ""]:
        assert tok.ids(t.encode()) == reference_ids(t)[:-1].astype("<u2").tobytes(), repr(t)


def test_batches_of_texts_equal_single_texts():
    rng, tok = random.Random(4), ChunkTokenizer(tokenizer_path())
    plain, odd = "aB'stre 12\n\t\x0b\x0c\r.,éÉßÿ×÷_>endoftext'll  ", "日本́ \x1c\x85İςΣ—½<|>"
    texts = ["".join(rng.choice(plain + odd * (i % 3 == 0)) for _ in range(rng.randint(0, 40))).encode() for i in range(2000)]
    for some in (texts, [*texts[:5], b"", b" \n "], [b""], []):
        assert tok.batch(some) == [reference_ids(t.decode())[:-1].astype("<u2").tobytes() for t in some]


def test_words_are_kept_without_what_they_are_written_with():
    tok = ChunkTokenizer(tokenizer_path())
    tok.batch([b"goal, goal. (goal) goal; goal's"])
    assert set(tok._chunks) == {"goal", ",", ".", "(", ")", ";", "'s"}


def test_tokenizer_is_dropped_after_its_step():
    """Spark keeps its workers: one that has tokenized must not hold its words beside an index."""

    class Stop(Exception):
        pass

    class Tokens:
        def select(self, *columns):
            return self

        def mapInArrow(self, fn, schema):
            list(fn(iter([pa.RecordBatch.from_pydict({"ids": [b"\1\0"]})])))
            raise Stop

    list(encode(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "t": [b"one text"]})])))
    assert tokens._worker_tokenizer.cache_info().currsize == 1
    with pytest.raises(Stop):
        packing_bm25.document_frequencies(Tokens())
    assert tokens._worker_tokenizer.cache_info().currsize == 0


def test_bfd_round_trip(spark):
    rows = documents()
    for clash in (False, True):
        seqs = packing_bfd.pack_bfd(frame(spark, rows, clash), shard_pieces=7)
        check_pieces(packing_bfd.pieces(seqs).collect(), rows)
        for s in seqs.collect():
            assert len(s["input_ids"]) == 4096 and s["cu_seqlens"][-1] == s["n_tokens"]
            assert s["position_resets"] == s["cu_seqlens"][:-1]


def test_best_fit_against_a_plain_scan():
    rng = random.Random(8)
    lengths = [rng.randint(1, 99) for _ in range(500)]
    bins = []
    for i in sorted(range(500), key=lambda i: (-lengths[i], i)):
        fits = [b for b in bins if b[0] >= lengths[i]]
        if fits:
            best = min(b[0] for b in fits)
            b = [b for b in fits if b[0] == best][0]
            b[0] -= lengths[i]
            b[1].append(i)
        else:
            bins.append([100 - lengths[i], [i]])
    got = packing_bfd.best_fit_decreasing(lengths, 100)
    assert sorted(i for b in got for i in b) == list(range(500))
    assert all(sum(lengths[i] for i in b) <= 100 for b in got)
    assert len(got) == len(bins)


def test_bm25_round_trip_and_padding(spark):
    rows = documents()
    for shard in (256, 3):
        got = packing_bm25.pack_bm25(frame(spark, rows), shard_docs=shard).collect()
        lengths = check_pieces(got, rows)
        assert all(n == 2048 or n & (n - 1) == 0 for n in lengths)  # no padding at all
        assert all(zlib.crc32(np.frombuffer(r["ids"], "<u2").astype("<u4").tobytes()) == r["ids_crc32"] for r in got)


def bm25_corpus(seed, n=30, vocabulary=50):
    rng = np.random.default_rng(seed)
    docs = [rng.integers(0, vocabulary, rng.integers(5, 80)).astype("<u2") for _ in range(n)]
    df = np.zeros(packing_bm25.VOCABULARY)
    for d in docs:
        df[np.unique(d)] += 1
    return docs, np.log1p((n - df + 0.5) / (df + 0.5)), np.mean([len(d) for d in docs])


def formula(q, d, idf, mean):
    return sum(idf[t] * (d == t).sum() * 2.2 / ((d == t).sum() + 1.2 * (0.25 + 0.75 * len(d) / mean)) for t in np.unique(q))


def test_bm25_scores_against_the_formula():
    docs, idf, mean = bm25_corpus(1)
    want = [[formula(q, d, idf, mean) for d in docs] for q in docs]
    for dense in (0, 8, 16, 1000):  # all lists by the product, some, none
        assert np.allclose(packing_bm25.shard_scores(docs, idf, mean, dense), want, rtol=1e-5)


def plain_filling(items, idf, mean, window):
    """The filling rule, document by document, on scores of the formula."""
    docs = {it[0]: it[4] for it in items}
    length = {it[0]: len(it[3]) for it in items}
    score = {a: {b: formula(docs[a], docs[b], idf, mean) for b in docs if b != a} for a in docs}
    best = {a: max(score[a], key=lambda b: score[a][b]) for a in docs}
    followers = {a: sorted((b for b in docs if best[b] == a and score[b][a] > 0), key=lambda b: -score[b][a]) for a in docs}
    seeds = sorted(docs, key=lambda a: -len(followers[a]))
    open_, windows, at = set(docs), [], None
    while open_:
        if at is None:
            at = next(s for s in seeds if s in open_)
        line = []

        def bring(b):
            if b in open_ and b not in line:
                line.append(b)
                for f in followers[b]:
                    bring(f)

        for b in [at, *sorted((b for b in open_ if b != at), key=lambda b: -score[at][b])]:
            bring(b)
        current, room, at = [], window, None
        for b in line:
            take = min(room, length[b])
            current.append((b, take))
            room, length[b] = room - take, length[b] - take
            if length[b]:
                at = b
            else:
                open_.discard(b)
            if not room:
                break
        windows.append(current)
    return windows


def test_filling_against_the_plain_rule():
    for seed, window in ((2, 64), (3, 100), (4, 17), (5, 500)):
        docs, idf, mean = bm25_corpus(seed, n=40, vocabulary=400)
        items = [(i, 0, len(d), d, d) for i, d in enumerate(docs)]
        windows, rest = packing_bm25.pack_shard(items, idf, mean, window)
        assert all(sum(len(p[3]) for p in w) == window for w in windows) and sum(len(p[3]) for p in rest) < window
        got = [[(p[0], len(p[3])) for p in w] for w in [*windows, rest] if w]
        assert got == plain_filling(items, idf, mean, window)


def neighbour_setup(seed=5, n=300):
    """Tokens of pairs: two documents share their words but for one rare word each."""
    rng = random.Random(seed)
    rows = []
    for i in range(n // 2):
        w = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(30)]
        rows += [(i, " ".join([*w, f"Ωx{rng.random()}"])), (10_000 + i, " ".join([f"日{rng.random()}", *w]))]
    return [(d, t, "en", "s", len(t)) for d, t in rows]


def test_like_documents_have_near_places(spark):
    """Ten vocabularies: the order by place keeps each of them together."""
    rng = np.random.default_rng(4)
    ids = [(t, rng.integers(t * 300, t * 300 + 300, 80).astype("<u2")) for t in rng.permutation(np.repeat(np.arange(10), 60))]
    tok = spark.createDataFrame([(i, len(x), bytearray(x.tobytes()), i) for i, (_, x) in enumerate(ids)], "doc_id long, n_tokens long, ids binary, row long")
    df, n, mean = packing_bm25.document_frequencies(tok)
    order = packing_bm25.placed(tok, n, np.log1p((n - df + 0.5) / (df + 0.5)), mean, 64).orderBy("p1", "p2", "p3", "row").collect()
    topic = [ids[r["row"]][0] for r in order]
    assert sorted(r["row"] for r in order) == list(range(600))
    assert np.mean([a == b for a, b in zip(topic, topic[1:])]) > 0.9


def test_partitions_are_even_ranges_of_the_order(spark, monkeypatch):
    """A third of the documents are one text; bounds from the fitting sample, and from one of their own."""
    rng = np.random.default_rng(6)
    ids = [np.full(20, 7, dtype="<u2") if i % 3 == 0 else rng.integers(0, 3000, 60).astype("<u2") for i in range(900)]
    tok = spark.createDataFrame([(i, len(x), bytearray(x.tobytes()), i) for i, x in enumerate(ids)], "doc_id long, n_tokens long, ids binary, row long")
    df, n, mean = packing_bm25.document_frequencies(tok)
    for sample in (16384, 200):
        monkeypatch.setattr(packing_bm25, "SAMPLE_ROWS", sample)
        rows = packing_bm25.placed(tok, n, np.log1p((n - df + 0.5) / (df + 0.5)), mean, 8).orderBy("p1", "p2", "p3", "row").collect()
        parts = [r["part"] for r in rows]
        assert parts == sorted(parts) and set(parts) == set(range(packing_bm25.n_parts(n, 8)))
        assert max(np.bincount(parts)) <= 3 * 900 / packing_bm25.n_parts(n, 8)


def test_near_copies_share_a_window(spark):
    """One differing rare word does not part two documents, however many lie between them."""
    got = packing_bm25.pack_bm25(frame(spark, neighbour_setup(n=600)), shard_docs=16).collect()
    at = defaultdict(set)
    for r in got:
        at[r["doc_id"]].add(r["sequence_id"])
    together = sum(bool(at[i] & at[10_000 + i]) for i in range(300))
    assert together >= 270


def test_long_documents_are_indexed_whole():
    """The rest of a long document goes to the neighbour of its beginning."""
    begin, rest, other = np.arange(0, 50, dtype="<u2"), np.arange(100, 110, dtype="<u2"), np.arange(200, 210, dtype="<u2")
    items = [(0, 2048, 2058, rest, np.concatenate([begin, rest])), (1, 0, 10, other, other), (2, 0, 10, begin[:10], begin[:10])]
    windows, _ = packing_bm25.pack_shard(items, np.ones(packing_bm25.VOCABULARY), 20.0, 20)
    assert [p[0] for p in windows[0]] == [0, 2]


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOC_SCHEMA)
    assert packing_bfd.pieces(packing_bfd.pack_bfd(none)).count() == 0
    assert packing_bm25.pack_bm25(none).count() == 0
