"""Lexical retrieval packing: windows filled with BM25 neighbours of a seed document.

1. Every document is tokenized once and staged (ids as uint16).
2. Document frequencies of all token ids are counted over the whole corpus. The
   vocabulary is fixed (49,408 ids), so the collected table has a bound.
3. A document's BM25 weights are projected to a sketch of ``SKETCH`` numbers. Centroids of
   two levels, fitted on a bounded sample of sketches, and the sketch's signs below them
   name its place: the range partition by place is the order of the index shards, so
   documents of like vocabulary come together. The work is linear in the corpus.
4. A task chains a pool of consecutive documents from nearest sketch to nearest sketch and
   cuts the chain at weak links into shards of about ``shard_docs``. Each shard has an inverted index over the whole
   documents, which every document queries with all its terms. Documents that are the best
   neighbour of most others are seeds first. A seed's window takes its unused neighbours:
   those that have the seed as their own best neighbour, then what the seed's own query
   returns, best first; each brings those whose best neighbour it is. The last neighbour is cut to fit and its rest seeds the next
   window. What remains at the end of a shard is passed to the next one.
5. Windows of a document that is longer than the window are its own; its rest is placed
   by the terms of the whole document. A partition's last, short window is cut into
   powers of two, which need no padding.

Null or empty text is the end id alone. Repeated rows and null ids are documents
of their own. An empty table gives no pieces. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import give_back, small, stage
from touchline.llm.tokens import TOKEN_COLUMNS, encode, forget, texts

WINDOW = 2048
#: Documents of one index shard: bounds a task's memory and a query's cost.
SHARD_DOCS = 1024
#: Numbers of a sketch, rows that the centroids are fitted on, centroids of a level at most.
SKETCH, SAMPLE_ROWS, MAX_CENTROIDS = 64, 16384, 64
#: Sampled rows per partition that its bounds are read from, and in all at most.
BOUND_ROWS, MAX_BOUND_ROWS = 64, 1_000_000
#: Clusters of two levels that a shard holds on average.
CLUSTERS_PER_SHARD = 8
#: Shards that a task orders at a time, and those of a partition at least, but for the last.
POOL_SHARDS, PARTITION_SHARDS = 4, 16
#: Ids of more documents of a shard than this are scored by a dense product, others by postings.
DENSE_DOCS = 48
#: Ids above the vocabulary do not occur (uint16).
VOCABULARY = 65536
K1, B = 1.2, 0.75
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "ids binary")


class Terms(NamedTuple):
    """Distinct ids of some documents with their counts, document by document."""

    owner: np.ndarray
    terms: np.ndarray
    counts: np.ndarray
    lengths: np.ndarray

    @staticmethod
    def of(raw: list) -> Terms:
        """From ids as bytes or arrays (uint16), at most 65,536 documents."""
        lengths = np.array([len(memoryview(x).cast("B")) // 2 for x in raw], dtype=np.int64)
        ids = np.frombuffer(b"".join([bytes(x) for x in raw]), "<u2")
        key = np.repeat(np.arange(len(raw), dtype=np.uint32) << 16, lengths) | ids
        key.sort()
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, dtype=np.int64)
        found = key[first]
        return Terms((found >> 16).astype(np.int64), (found & 0xFFFF).astype(np.int64), np.diff(first, append=len(key)), lengths)

    def weights(self, idf: np.ndarray, mean: float) -> np.ndarray:
        """BM25 weight that a query with the id gives the document."""
        norm = K1 * (1 - B + B * self.lengths / mean)
        return (idf[self.terms] * self.counts * (K1 + 1) / (self.counts + norm[self.owner])).astype(np.float32)


def document_frequencies(tok: DataFrame) -> tuple[np.ndarray, int, float]:
    """(frequency of each id, number of documents, mean length) over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # a worker that has tokenized would hold its chunks through the steps below
        df = np.zeros(VOCABULARY, dtype=np.int64)
        for b in small(batches):
            df += np.bincount(Terms.of(b.column(0).to_pylist()).terms, minlength=VOCABULARY)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], names=["token", "df"])

    rows = tok.select("ids").mapInArrow(count, "token long, df long").groupBy("token").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(VOCABULARY, dtype=np.int64)
    for r in rows:  # at most one row per id of the vocabulary
        df[r["token"]] = r["df"]
    n, mean = tok.agg(F.count("*"), F.avg("n_tokens")).first()
    return df, n, float(mean or 1.0)


@lru_cache(maxsize=1)
def _projection() -> np.ndarray:
    """The same random directions in every worker, one row per token id."""
    return np.random.default_rng(17).standard_normal((VOCABULARY, SKETCH), dtype=np.float32)


def sketches(raw: list, idf: np.ndarray, mean: float) -> np.ndarray:
    """One row per document: its BM25 weights, projected and scaled to length one."""
    t = Terms.of(raw)
    w, r = t.weights(idf, mean), _projection()
    ends = np.searchsorted(t.owner, np.arange(len(raw) + 1))
    out = np.zeros((len(raw), SKETCH), dtype=np.float32)
    for i, (lo, hi) in enumerate(zip(ends, ends[1:])):
        out[i] = w[lo:hi] @ r[t.terms[lo:hi]]
    return unit(out)


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-9)


def _centroids(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; an empty centroid stays where it is."""
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where((np.bincount(near, minlength=len(c)) > 0)[:, None], unit(sums), c)
    return c


class Places:
    """Where a sketch belongs in the order of documents: centroid, centroid below it, signs."""

    def __init__(self, sample: np.ndarray, clusters: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean = sample.mean(axis=0)
        x = unit(sample - self.mean)
        k = max(1, min(MAX_CENTROIDS, round(clusters**0.5)))
        self.top = _centroids(x, k, rng)
        near = (x @ self.top.T).argmax(axis=1)
        self.below = [_centroids(x[near == i] if (near == i).any() else self.top[i:i + 1], k, rng) for i in range(len(self.top))]

    def of(self, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = unit(sketches - self.mean)
        first = (x @ self.top.T).argmax(axis=1)
        second = np.zeros(len(x), dtype=np.int64)
        for i in np.unique(first):
            second[first == i] = (x[first == i] @ self.below[i].T).argmax(axis=1)
        left = x - np.stack([self.below[i][j] for i, j in zip(first, second)]) if len(x) else x
        signs = (left[:, :32] > 0) @ (1 << np.arange(31, -1, -1, dtype=np.int64))
        return first, second, signs


def n_parts(n_docs: int, shard_docs: int) -> int:
    """Grows with the corpus, so that a partition's share does not."""
    return n_docs // (PARTITION_SHARDS * shard_docs) + 1


def bounds(keys: list[tuple], parts: int) -> list[tuple]:
    """Where partitions 1, 2, ... begin, so that a sample of keys is dealt evenly."""
    keys = sorted(keys)
    return [keys[len(keys) * i // parts] for i in range(1, parts)] if keys else []


def placed(tok: DataFrame, n_docs: int, idf: np.ndarray, mean: float, shard_docs: int) -> DataFrame:
    """``tok`` with the columns ``p1, p2, p3``: sorted by them and ``row``, like documents are
    near each other. ``part`` numbers ``n_parts`` ranges of that order, of like size by the
    sample: the ranges are named here, since a range partition would sketch every document
    a second time only to sample them."""
    spark = tok.sparkSession
    shared = spark.sparkContext.broadcast(idf)  # fixed size: one entry per id

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            s = sketches(b.column(0).to_pylist(), shared.value, mean)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in s], pa.binary()), b.column(1)], names=["s", "row"])

    def some(rows: int) -> DataFrame:
        # By a threshold on a hash: each task keeps its share, and no more than a little over ``rows`` come.
        share = int(min(1.0, rows / max(n_docs, 1)) * (1 << 30)) + 1
        return tok.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < share).select("ids", "row")

    taken = some(SAMPLE_ROWS).mapInArrow(sampled, "s binary, row long").collect()
    sample = np.stack([np.frombuffer(r["s"], "<f4") for r in taken]) if taken else np.zeros((1, SKETCH), "<f4")
    places = Places(sample, CLUSTERS_PER_SHARD * n_docs // shard_docs + 1)
    model = spark.sparkContext.broadcast(places)  # at most MAX_CENTROIDS squared sketches
    parts = n_parts(n_docs, shard_docs)
    if parts * BOUND_ROWS <= SAMPLE_ROWS:
        known = list(zip(*[p.tolist() for p in places.of(sample)], [r["row"] for r in taken]))
    else:
        def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in small(batches):
                at = model.value.of(sketches(b.column(0).to_pylist(), shared.value, mean))
                yield pa.RecordBatch.from_arrays([*[pa.array(p, pa.int64()) for p in at], b.column(1)], names=["p1", "p2", "p3", "row"])

        more = some(min(MAX_BOUND_ROWS, parts * BOUND_ROWS)).mapInArrow(located, "p1 long, p2 long, p3 long, row long")
        known = [tuple(r) for r in more.collect()]
    begins = spark.sparkContext.broadcast(bounds(known, parts))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            s = sketches(b.column(2).to_pylist(), shared.value, mean)
            short = pa.array([x.tobytes() for x in s.astype(np.float16)], pa.binary())
            at = model.value.of(s)
            part = [bisect_right(begins.value, key) for key in zip(*[p.tolist() for p in at], b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, short, *[pa.array(p, pa.int64()) for p in at], pa.array(part, pa.int32())],
                                             names=["doc_id", "n_tokens", "ids", "row", "sketch", "p1", "p2", "p3", "part"])

    return tok.select("doc_id", "n_tokens", "ids", "row").mapInArrow(
        place, TOKEN_COLUMNS + ", row long, sketch binary, p1 long, p2 long, p3 long, part int")


def chain(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, similarity of each to the one before it): every next one is the nearest that is left."""
    m = len(x)
    near = x @ x.T
    order, link = np.zeros(m, dtype=np.int64), np.ones(m, dtype=np.float32)
    blocked = np.zeros(m, dtype=np.float32)
    at = 0
    for i in range(1, m):
        blocked[at] = -9
        nxt = int((near[at] + blocked).argmax())
        order[i], link[i] = nxt, near[at, nxt]
        at = nxt
    return order, link


def shard_cuts(link: np.ndarray, shard_docs: int) -> list[int]:
    """Where shards begin: at the weakest link of those a quarter shorter or longer than ``shard_docs``."""
    cuts, at = [0], 0
    while len(link) - at > shard_docs * 5 // 4:
        lo = at + max(1, shard_docs * 3 // 4)
        at = lo + int(link[lo:at + max(2, shard_docs * 5 // 4)].argmin())
        cuts.append(at)
    return [*cuts, len(link)]


def shard_scores(docs: list[np.ndarray], idf: np.ndarray, mean: float, dense_docs: int = DENSE_DOCS) -> np.ndarray:
    """(query, document): BM25 of all pairs of a shard, by its inverted index.

    Postings of an id are the documents that hold it. Long lists are columns of a dense
    product; short ones are added up list by list. Queries are all terms of a document."""
    m, found = len(docs), Terms.of(docs)
    terms, owner, weight = found.terms, found.owner, found.weights(idf, mean)
    order = np.argsort(terms, kind="stable")
    terms, owner, weight = terms[order], owner[order], weight[order]
    begin = np.flatnonzero(np.diff(terms, prepend=-1))
    size = np.diff(begin, append=len(terms))
    dense = size > dense_docs
    column = np.repeat(np.where(dense, np.cumsum(dense) - 1, -1), size)
    holds = np.zeros((m, int(dense.sum())), dtype=np.float32)
    weights = np.zeros_like(holds)
    common = column >= 0
    holds[owner[common], column[common]] = 1
    weights[owner[common], column[common]] = weight[common]
    out = holds @ weights.T
    # Short lists: every posting meets all postings of its list.
    rows = np.flatnonzero(~common)
    lists = np.repeat(np.arange(len(size)), size)[rows]
    count = size[lists]
    asking = np.repeat(owner[rows], count)
    step = np.arange(len(asking)) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(begin[lists], count) + step
    out += np.bincount(asking * m + owner[at], weights=weight[at], minlength=m * m).reshape(m, m).astype(np.float32)
    return out


def in_line(seed: int, score: np.ndarray, named: list[list[int]], unused: np.ndarray) -> Iterator[int]:
    """Unused documents in the order that a window takes them: the seed, then what its query
    returns, best first; each brings those that have it as their best neighbour, and theirs."""
    met = ~unused
    met[seed] = False
    others = np.flatnonzero(unused)
    others = others[others != seed]
    for top in [[seed], others[np.argsort(-score[others], kind="stable")].tolist()]:
        for one in top:
            stack = [one]
            while stack:
                j = stack.pop()
                if not met[j]:
                    met[j] = True
                    yield j
                    stack += reversed(named[j])


def pack_shard(items: list[tuple], idf: np.ndarray, mean: float, window: int) -> tuple[list[list[tuple]], list[tuple]]:
    """Full windows and the rest. An item is (doc, start, doc_tokens, ids as uint16 array, ids of the whole document)."""
    m = len(items)
    score = shard_scores([it[4] for it in items], idf, mean)
    np.fill_diagonal(score, -1.0)
    best, top = score.argmax(axis=1), score.max(axis=1)
    named = [[] for _ in range(m)]  # those that have the document as their best neighbour, best first
    for q in np.argsort(-top, kind="stable"):
        if top[q] > 0:
            named[best[q]].append(int(q))
    seeds = iter(np.argsort([-len(x) for x in named], kind="stable").tolist())
    left = list(items)  # an item's unplaced rest
    unused = np.ones(m, dtype=bool)
    windows: list[list[tuple]] = []
    at = None
    while True:
        if at is None:
            at = next((s for s in seeds if unused[s]), None)
        if at is None:
            return windows, []
        current, room = [], window
        line, at = in_line(at, score[at], named, unused), None
        for j in line:
            doc, start, total, ids, whole = left[j]
            current.append((doc, start, total, ids[:room], whole))
            if len(ids) <= room:
                unused[j] = False
                room -= len(ids)
            else:
                left[j] = (doc, start + room, total, ids[room:], whole)
                room, at = 0, j  # the rest of a cut document seeds the next window
            if not room:
                break
        else:
            return windows, current  # no document is left for this window
        windows.append(current)


def powers_of_two(pieces: list[tuple]) -> list[list[tuple]]:
    """Cut a short window into sequences whose lengths are powers of two."""
    n = sum(len(p[3]) for p in pieces)
    out, todo = [], list(pieces)
    while n:
        room = 1 << (n.bit_length() - 1)
        n -= room
        seq = []
        while room:
            doc, start, total, ids, *_ = todo.pop(0)
            seq.append((doc, start, total, ids[:room]))
            if len(ids) > room:
                todo.insert(0, (doc, start + room, total, ids[room:]))
            room -= len(seq[-1][3])
        out.append(seq)
    return out


def pack_bm25(docs: DataFrame, window: int = WINDOW, path: str | None = None, shard_docs: int = SHARD_DOCS,
              with_ids: bool = True) -> DataFrame:
    """One row per piece (see SCHEMA); ``ids`` are its uint16 ids unless ``with_ids`` is false."""
    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 32
        for b in encode(batches, path):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.arange(row, row + b.num_rows))], names=["doc_id", "n_tokens", "ids", "row"])
            row += b.num_rows

    tok = stage(texts(docs).mapInArrow(numbered, TOKEN_COLUMNS + ", row long"), "pack-tokens")
    df, n_docs, mean = document_frequencies(tok)
    idf = np.log1p((n_docs - df + 0.5) / (df + 0.5))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(idf)  # fixed size: one entry per id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What earlier steps keep in a worker is not needed beside the pools and indexes here.
        forget()
        _projection.cache_clear()
        give_back()
        weights = shared.value
        next_id = TaskContext.get().partitionId() << 32

        def emit(sequences):
            nonlocal next_id
            cols = [[] for _ in range(8)]
            for seq in sequences:
                offset = 0
                for doc, start, total, ids, *_ in seq:
                    row = (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, next_id, offset,
                           ids.tobytes() if with_ids else None)
                    offset += len(ids)
                    for c, v in zip(cols, row):
                        c.append(v)
                next_id += 1
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if i == 7 else pa.int64()) for i, c in enumerate(cols)],
                                              names=[x.split(" ")[0] for x in SCHEMA.split(", ")])

        waiting: list[tuple] = []
        pool: list[tuple] = []

        def drain(last: bool):
            nonlocal waiting, pool
            order, link = chain(np.stack([np.frombuffer(x, "<f2") for _, x in pool]).astype(np.float32))
            ends = shard_cuts(link, shard_docs)
            if not last:
                ends = ends[:-1]  # the chain's end, what has found no neighbour yet, meets the next documents
            for lo, hi in zip(ends, ends[1:]):
                full, waiting = pack_shard([*waiting, *[pool[i][0] for i in order[lo:hi]]], weights, mean, window)
                yield emit(full)
            pool = [] if last else [pool[i] for i in order[ends[-1]:]]

        for b in small(batches):
            for doc, n, raw, at in zip(*[b.column(i).to_pylist() for i in (0, 1, 2, 4)]):
                ids = np.frombuffer(raw, "<u2")
                whole = n // window * window
                if whole:
                    yield emit([[(doc, s, n, ids[s:s + window])] for s in range(0, whole, window)])
                if whole < n:
                    pool.append(((doc, whole, n, ids[whole:], ids), at))
                if len(pool) >= POOL_SHARDS * shard_docs:
                    yield from drain(False)
        if pool:
            yield from drain(True)
        while waiting:
            full, rest = pack_shard(waiting, weights, mean, window)
            yield emit(full)
            if not full:
                break
            waiting = rest
        if waiting:
            yield emit(powers_of_two(waiting))

    ranged = placed(tok, n_docs, idf, mean, shard_docs).repartitionById(n_parts(n_docs, shard_docs), "part")
    return ranged.sortWithinPartitions("p1", "p2", "p3", "row").mapInArrow(run, SCHEMA)
