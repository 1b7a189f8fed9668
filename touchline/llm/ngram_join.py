"""N-gram Jaccard join with signature trees.

Each document is the set of its distinct word k-shingles (64-bit hashes). Two
documents link when ``100 * intersection >= threshold * union``. All links between
different texts count; the result is one row per document with its component.

1. A count sketch of fixed size gives every shingle a global rank, rare first.
2. One pass makes (doc_id, set size, set fingerprint, prefix). Of the p = n - ceil(t n) + 1
   first shingles in rank order linked sets share one, and of the p + l - 1 first ones
   they share l. Equal sets collapse to one representative by a partial aggregate.
3. A representative of whose p + l - 1 first shingles fewer than l occur in any other
   prefix links with nothing and goes no further. The others form a block for each of
   their p first shingles that two of them hold; blocks of the same members are kept once. A block is dealt over as many tiles as its size asks for
   (chunk pairs), so no block is ever in one task whole; a tile has a size bound.
4. In a tile, members are put into classes by set size; each class has a signature
   tree whose nodes hold OR-combined token bitmaps and size ranges. The dual traversal
   drops node pairs whose largest possible overlap is below what a link needs. Members
   joined by remaining pairs form groups; a group found in several tiles is kept once.
5. The sets of group members (only these) are made again and the groups' pairs are
   verified by a second, finer tree and the sets themselves, unless already connected.
6. Groups give star edges; connected components give the smallest reachable doc_id.

Defined results: null or empty text has size 0 and links with nothing (its own
component). Rows with one doc_id are one document: their links are joined. A null
doc_id gets the component of equal or linked sets with an id, else null. An empty
table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from touchline.llm.common import bound_batches, small, stage, text_or_empty
from touchline.llm.graph import components

K = 3
THRESHOLD = 90  # per cent
SKETCH = 1 << 18
#: Shingles of one side of a tile (8 bytes each).
CHUNK = 1 << 20
#: Bitmap bits per shingle: of the tiles' bitmaps, and of those made from whole sets.
TILE_BITS, SET_BITS = 2, 32
#: Fan-out of a tree node.
FAN = 8
CACHE_WORDS = 200_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        made = self[word] = xxhash.xxh3_64_intdigest(word)
        return made


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word k-shingles (A-Z lower-cased)."""

    def __init__(self, k: int):
        self.k, self._words = k, _WordHashes()

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self._words) > CACHE_WORDS:
            self._words.clear()
        # On bytes, lower and split know A-Z, the blank and 9 to 13 only.
        words = [t.lower().split() for t in texts]
        n = [len(w) for w in words]
        h = np.fromiter(map(self._words.__getitem__, chain.from_iterable(words)), dtype=np.uint64, count=sum(n))
        acc = self._shingles(h, self.k)
        out, at = [], 0
        for size in n:
            if size >= self.k:
                out.append(np.unique(acc[at:at + size - self.k + 1]))
            else:  # the whole sequence as one, or nothing
                out.append(self._shingles(h[at:at + size], size) if size else np.empty(0, dtype=np.uint64))
            at += size
        return out

    @staticmethod
    def _shingles(h: np.ndarray, width: int) -> np.ndarray:
        n = max(len(h) - width + 1, 0)
        # The width is part of the hash: a short text equals no shingle of a longer one.
        acc = np.full(n, width, dtype=np.uint64)
        for i in range(width):
            acc = (acc ^ (acc >> np.uint64(29))) * _P + h[i:i + n]
        return mix64(acc)


def prefix_size(n: int, threshold: int) -> int:
    return n - -(-threshold * n // 100) + 1


def shared_needed(n: int, threshold: int) -> int:
    """l: so many shingles of its extended prefix a set shares with any linked one."""
    return (prefix_size(n, threshold) + 1) // 2


def extended_size(n: int, threshold: int) -> int:
    return prefix_size(n, threshold) + shared_needed(n, threshold) - 1


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().cast("binary").alias("t"))


def shingle_ranks(docs: DataFrame, k: int, size: int = SKETCH) -> np.ndarray:
    """Counts of shingles over all documents by hash bucket (a table of fixed size)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, total = Shingler(k), np.zeros(size, dtype=np.int64)
        for b in small(batches):
            sets = np.concatenate(shingles(b.column(1).to_pylist()))
            total += np.bincount((sets & np.uint64(size - 1)).astype(np.int64), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["b", "n"])

    sums = _texts(docs).mapInArrow(count, "b long, n long").groupBy("b").agg(F.sum("n").alias("n")).toArrow()
    ranks = np.zeros(size, dtype=np.int64)
    ranks[sums.column(0).to_numpy()] = sums.column(1).to_numpy()
    return np.minimum(ranks, 2**31 - 1).astype(np.int32)


def bitmap(shingles: np.ndarray, per_shingle: int) -> np.ndarray:
    """One bit per hash; as many as the next power of two of ``per_shingle`` times the set's size."""
    bits = max(64, 1 << (per_shingle * len(shingles) - 1).bit_length())
    flags = np.zeros(bits, dtype=bool)
    flags[(shingles & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags).view(np.uint64)


def signatures(docs: DataFrame, ranks, k: int, threshold: int) -> DataFrame:
    """``doc_id, n, fp, prefix, bits``; ``ranks`` is a broadcast of :func:`shingle_ranks`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, rank = Shingler(k), np.minimum(ranks.value, (1 << 20) - 1).astype(np.uint64)
        mask = np.uint64(len(rank) - 1)
        for b in small(batches):
            n, fp, prefix, bits = [], [], [], []
            for s in shingles(b.column(1).to_pylist()):
                n.append(len(s))
                if len(s):
                    # Rank first, then hash: the same order for every document.
                    order = (rank[(s & mask).astype(np.int64)] << np.uint64(44)) | (s >> np.uint64(20))
                    size = extended_size(len(s), threshold)
                    first = np.argpartition(order, size - 1)[:size] if size < len(s) else np.arange(len(s))
                    prefix.append(s[first[np.argsort(order[first])]].tobytes())
                    fp.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    bits.append(bitmap(s, TILE_BITS).tobytes())
                else:
                    prefix.append(b"")
                    fp.append(None)
                    bits.append(b"")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), *[pa.array(x, pa.binary()) for x in (fp, prefix, bits)]],
                names=["doc_id", "n", "fp", "prefix", "bits"])

    return _texts(docs).mapInArrow(run, "doc_id long, n long, fp binary, prefix binary, bits binary")


def _prefix_rows(reps: DataFrame, threshold: int, extended: bool) -> DataFrame:
    """``token, rep, n, need``: a row per prefix shingle, of the extended prefix or of the first p only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            rep, n = b.column(0).to_numpy(), b.column(1).to_numpy()
            sets = [np.frombuffer(p, np.int64) for p in b.column(2).to_pylist()]
            if not extended:
                sets = [s[:prefix_size(size, threshold)] for s, size in zip(sets, n.tolist())]
            count = np.array([len(s) for s in sets])
            need = np.array([shared_needed(size, threshold) for size in n.tolist()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(sets)), *[pa.array(np.repeat(x, count)) for x in (rep, n, need)]],
                names=["token", "rep", "n", "need"])

    return reps.select("rep", "n", "prefix").mapInArrow(run, "token long, rep long, n long, need long")


class SignatureTree:
    """Members (sorted by size) under nodes with OR-combined bitmaps and size ranges."""

    def __init__(self, bitmaps: list[np.ndarray], sizes: list[int], words: int):
        # A wider bitmap is folded: its bit numbers are hashes modulo a power of two.
        low = np.stack([np.bitwise_or.reduce(m.reshape(-1, words), axis=0) if len(m) > words else m for m in bitmaps])
        size = np.array(sizes, dtype=np.int64)
        # Several shingles on one bit: so many more than common bits can two sets share.
        extra = size - np.bitwise_count(low).sum(axis=1, dtype=np.int64)
        self.levels = [(low, size, size, extra)]
        while len(self.levels[-1][0]) > FAN:
            b, lo, hi, ex = self.levels[-1]
            at = np.arange(0, len(b), FAN)
            self.levels.append((np.bitwise_or.reduceat(b, at, axis=0), np.minimum.reduceat(lo, at),
                                np.maximum.reduceat(hi, at), np.maximum.reduceat(ex, at)))


def possible(x, y, i: np.ndarray, j: np.ndarray, threshold: int) -> np.ndarray:
    """Whether nodes i of level x and j of level y can hold a linked pair."""
    bx, lx, hx, ex = x
    by, ly, hy, ey = y
    ok = (hx[i] * 100 >= threshold * ly[j]) & (hy[j] * 100 >= threshold * lx[i])
    at = np.flatnonzero(ok)
    step = max(1, (1 << 19) // bx.shape[1])  # bounds the gathered bitmaps
    for s in range(0, len(at), step):
        p = at[s:s + step]
        common = np.bitwise_count(bx[i[p]] & by[j[p]]).sum(axis=1, dtype=np.int64) + np.minimum(ex[i[p]], ey[j[p]])
        # intersection >= t / (100 + t) * (|A| + |B|), at least for the smallest members
        ok[p] = common * (100 + threshold) >= threshold * (lx[i[p]] + ly[j[p]])
    return ok


def candidates(x: SignatureTree, y: SignatureTree, same: bool, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Member pairs left by the dual traversal, in bounded pieces (depth first)."""
    stack = []
    dx, dy = len(x.levels) - 1, len(y.levels) - 1
    i, j = np.meshgrid(np.arange(len(x.levels[dx][0])), np.arange(len(y.levels[dy][0])), indexing="ij")
    stack.append((dx, dy, i.ravel(), j.ravel()))
    while stack:
        dx, dy, i, j = stack.pop()
        if same and dx == dy:
            keep = i <= j if dx else i < j
            i, j = i[keep], j[keep]
        ok = possible(x.levels[dx], y.levels[dy], i, j, threshold)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if dx == 0 and dy == 0:
            yield i, j
            continue
        for s in range(0, len(i), 4096):
            a, b = i[s:s + 4096], j[s:s + 4096]
            nx, ny = dx, dy
            if dx >= dy:
                nx, (a, b) = dx - 1, _children(a, b, len(x.levels[dx - 1][0]))
            if dy >= dx:
                ny, (b, a) = dy - 1, _children(b, a, len(y.levels[dy - 1][0]))
            stack.append((nx, ny, a, b))


def _children(node: np.ndarray, other: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    child = (node[:, None] * FAN + np.arange(FAN)).ravel()
    keep = child < n
    return child[keep], np.repeat(other, FAN)[keep]


def size_class(n: int, threshold: int) -> int:
    return int(math.log(n) / -math.log(threshold / 100) + 1e-9)


class Linker:
    """Union-find over members: (id, set size, bitmap). ``confirm(i, j)`` decides a pair
    that the trees leave; without it every such pair joins."""

    def __init__(self, members: list[tuple[int, int, np.ndarray]], threshold: int, confirm=None):
        self.members, self.threshold, self.confirm = members, threshold, confirm
        self.root = list(range(len(members)))

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def _classes(self, lo: int, hi: int) -> dict[int, list[int]]:
        out: dict[int, list[int]] = {}
        # Equal sizes by bitmap: similar sets tend to share a node.
        for i in sorted(range(lo, hi), key=lambda i: (self.members[i][1], self.members[i][2].tobytes())):
            out.setdefault(size_class(self.members[i][1], self.threshold), []).append(i)
        return out

    def _tree(self, ids: list[int], words: int) -> SignatureTree:
        return SignatureTree([self.members[i][2] for i in ids], [self.members[i][1] for i in ids], words)

    def _join(self, x: list[int], y: list[int], same: bool) -> None:
        words = min(len(self.members[x[0]][2]), len(self.members[y[0]][2]))
        tx = self._tree(x, words)
        ty = tx if same else self._tree(y, words)
        ax, ay = np.array(x), np.array(y)
        for i, j in candidates(tx, ty, same, self.threshold):
            for p, q in zip(ax[i].tolist(), ay[j].tolist()):
                rp, rq = self.find(p), self.find(q)
                if rp != rq and (self.confirm is None or self.confirm(p, q)):
                    self.root[max(rp, rq)] = min(rp, rq)

    def run(self, split: int | None = None) -> list[list[int]]:
        """Groups (member numbers) of linked members; with ``split``, pairs across that border only."""
        n = len(self.members)
        if split is None and n == 2:  # the usual case: one pair
            self._join([0], [1], False)
        else:
            a = self._classes(0, n if split is None else split)
            b = a if split is None else self._classes(split, n)
            for c, own in sorted(a.items()):
                # Linked sizes lie in one class or in neighbours; one class more guards against rounding.
                for d in (c, c + 1, c + 2) if split is None else (c - 2, c - 1, c, c + 1, c + 2):
                    other = b.get(d)
                    if other and not (split is None and c == d and len(own) < 2):
                        self._join(own, other, split is None and c == d)
        groups: dict[int, list[int]] = {}
        for i in range(n):
            groups.setdefault(self.find(i), []).append(i)
        return [g for g in groups.values() if len(g) > 1]


def _tile_groups(tiles: DataFrame, threshold: int) -> DataFrame:
    """``gid, members``: groups that bitmaps cannot tell apart. Tiles arrive sorted by
    (token, ci, cj); one tile at a time is in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, left, right = None, [], []
        found: dict[bytes, list[int]] = {}

        def close():
            if key is None:
                return
            cross = key[1] != key[2]
            if (cross and not (left and right)) or len(left) + len(right) < 2:
                return
            members = left + right
            for g in Linker(members, threshold).run(len(left) if cross else None):
                ids = sorted(members[i][0] for i in g)
                found[hashlib.blake2b(np.array(ids).tobytes(), digest_size=16).digest()] = ids

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.list_(pa.int64()))],
                                              names=["gid", "members"])

        for b in small(batches):
            for token, ci, cj, own, rep, n, raw in zip(*[c.to_pylist() for c in b.columns]):
                if (token, ci, cj) != key:
                    close()
                    key, left, right = (token, ci, cj), [], []
                (left if own == ci else right).append((rep, n, np.frombuffer(raw, np.uint64)))
            if len(found) > 5000:
                yield rows()
                found.clear()
        close()
        yield rows()

    return tiles.select("token", "ci", "cj", "own", "rep", "n", "bits").mapInArrow(run, "gid binary, members array<long>")


def _group_edges(groups: DataFrame, threshold: int) -> DataFrame:
    """Star edges of the verified links of groups that arrive sorted by gid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sets = None, [], []
        a, b = [], []

        def confirm(p: int, q: int) -> bool:
            less, more = (sets[p], sets[q]) if len(sets[p]) < len(sets[q]) else (sets[q], sets[p])
            at = np.searchsorted(more, less)
            at[at == len(more)] = 0
            both = int((more[at] == less).sum())
            return 100 * both >= threshold * (len(less) + len(more) - both)

        def close():
            if len(ids) > 1:
                members = [(i, len(s), bitmap(s, SET_BITS)) for i, s in zip(ids, sets)]
                for g in Linker(members, threshold, confirm).run():
                    low = min(ids[i] for i in g)
                    for i in g:
                        if ids[i] != low:
                            a.append(ids[i]), b.append(low)

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in small(batches):
            for gid, rep, raw in zip(*[c.to_pylist() for c in batch.columns]):
                if gid != key:
                    close()
                    key, ids, sets = gid, [], []
                ids.append(rep), sets.append(np.frombuffer(raw, np.uint64))
            if len(a) > 10_000:
                yield rows()
                a.clear(), b.clear()
        close()
        yield rows()

    return groups.select("gid", "rep", "set").mapInArrow(run, "a long, b long")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(k)
        for b in small(batches):
            sets = [s.tobytes() for s in shingles(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], names=["doc_id", "set"])

    return _texts(docs).mapInArrow(run, "doc_id long, set binary")


def _one_document(sig: DataFrame, reps: DataFrame) -> DataFrame:
    """Edges that join the texts of a repeated id: the id and the representative of each text."""
    twice = sig.filter("doc_id IS NOT NULL AND fp IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
    twice = stage(twice.filter("lo <> hi").select(F.col("doc_id").alias("_i")), "ngram-repeated-ids")
    texts = sig.join(twice, F.col("doc_id") == F.col("_i"), "left_semi").select(F.col("doc_id").alias("a"), F.col("fp").alias("_f"))
    return texts.join(reps, F.col("_f") == F.col("fp")).filter("a <> rep").select("a", F.col("rep").alias("b"))


def ngram_join(docs: DataFrame, k: int = K, threshold: int = THRESHOLD, chunk: int = CHUNK) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``."""
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.select("doc_id", "text")
    ranks = spark.sparkContext.broadcast(shingle_ranks(docs, k))
    sig = stage(signatures(docs, ranks, k, threshold), "ngram-signatures")
    reps = sig.filter("fp IS NOT NULL").groupBy("fp").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix"),
        F.first("bits").alias("bits"), F.count("*").alias("copies"))
    reps = stage(reps, "ngram-reps")
    named = reps.filter("rep IS NOT NULL")
    rows = _prefix_rows(named, threshold, extended=True)
    common = stage(rows.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1").select(F.col("token").alias("_t")), "ngram-common")
    likely = rows.join(common, F.col("token") == F.col("_t")).groupBy("rep").agg(F.count("*").alias("c"), F.first("need").alias("need"))
    likely = stage(likely.filter("c >= need").select(F.col("rep").alias("_l")), "ngram-likely")
    rows = _prefix_rows(named.join(likely, F.col("rep") == F.col("_l"), "left_semi"), threshold, extended=False)
    # Blocks: shingles that two of these prefixes or more hold; blocks of the same members once.
    blocks = rows.groupBy("token").agg(F.count("*").alias("c"), F.sum("n").alias("total"),
                                       F.sum(F.xxhash64("rep").cast("decimal(28,0)")).alias("who"))
    blocks = blocks.filter("c > 1").groupBy("c", "total", "who").agg(F.min("token").alias("_t"))
    blocks = stage(blocks.select("_t", F.ceil(F.col("total") / chunk).cast("int").alias("parts")), "ngram-blocks")
    hit = rows.join(blocks, F.col("token") == F.col("_t")).select("token", "rep", "parts")
    hit = hit.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    hit = hit.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    hit = hit.select("token", F.col("rep").alias("_r"), "own", F.least("own", "_j").alias("ci"), F.greatest("own", "_j").alias("cj"))
    tiles = hit.join(reps.select("rep", "n", "bits"), F.col("_r") == F.col("rep"))
    tiles = tiles.repartition("token", "ci", "cj").sortWithinPartitions("token", "ci", "cj")
    groups = stage(_tile_groups(tiles, threshold).dropDuplicates(["gid"]), "ngram-groups")
    members = groups.select("gid", F.explode("members").alias("rep"))
    # The sets of group members only, made again from their texts.
    wanted = stage(members.select("rep").distinct(), "ngram-members")
    texts = docs.join(wanted, docs["doc_id"] == wanted["rep"], "left_semi").dropDuplicates(["doc_id", "text"])
    sets = stage(shingle_sets(texts, k).filter(F.length("set") > 0), "ngram-sets")
    together = members.join(sets, members["rep"] == sets["doc_id"]).select("gid", "rep", "set")
    links = _group_edges(together.repartition("gid").sortWithinPartitions("gid"), threshold)
    found = components(links.unionByName(_one_document(sig, reps)))
    # A set's component: that of its representative.
    classes = reps.select("fp", "rep", "copies").join(found, F.col("rep") == F.col("node"), "left")
    classes = classes.select(F.col("fp").alias("_fp"), F.coalesce("component", "rep").alias("_c"), "rep", "copies").filter("copies > 1 OR _c <> rep")
    classes = stage(classes.select("_fp", "_c"), "ngram-classes")
    out = sig.select("doc_id", "n", "fp").join(classes, F.col("fp") == F.col("_fp"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("_c", "doc_id").alias("component_id"))


def one_per_group(docs: DataFrame, k: int = 5, threshold: int = 80) -> DataFrame:
    """The documents whose doc_id is their component's; columns as they were.

    Rows without words are all kept, and so are rows with a null id. Of several rows of a
    kept id one stays: the first by its text, then by a hash of its columns.
    """
    groups = ngram_join(docs, k, threshold).filter("n_shingles > 0 AND component_id <> doc_id")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    gone = groups.select(F.col("doc_id").alias("_gone")).distinct()
    out = docs.join(gone, (F.col("doc_id") == F.col("_gone")) & worded, "left_anti")
    twice = docs.filter(worded & F.col("doc_id").isNotNull()).groupBy("doc_id").count().filter("count > 1")
    twice = stage(twice.select(F.col("doc_id").alias("_twice")), "ngram-repeated-rows")
    repeated = (F.col("doc_id") == F.col("_twice")) & worded
    plain = [f.name for f in docs.schema if not isinstance(f.dataType, MapType)]
    first = F.min_by(F.struct(*docs.columns), F.struct("text", F.xxhash64(*plain)))
    ones = out.join(twice, repeated, "left_semi").groupBy(F.col("doc_id").alias("_id")).agg(first.alias("_row")).select("_row.*")
    return out.join(twice, repeated, "left_anti").unionByName(ones)
