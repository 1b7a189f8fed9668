"""Embedding near-dedup on a robust-pruned flat graph.

1. Vectors that can link (finite, not zero) are cast to double, equal ones collapsed.
2. Centroids of a bounded sample make overlapping shards: a vector goes to its
   ``overlap`` nearest ones. A shard beyond ``SHARD_CAP`` members is dealt into parts;
   each part has a graph of its own and answers all of the shard's members, block by block.
3. A part's graph: nearest candidates, robust-pruned (a candidate is dropped if a chosen
   neighbour is nearer to it by the factor alpha), some long edges, with reverse edges. The
   adjacency lists that a vector gets in its shards are united.
4. Every vector searches the parts of its shards: a greedy beam search from medoids (the
   square root of the part, farthest-first), then range expansion, which follows the
   neighbours of everything in range until none is new. Near copies (within half the range
   of a leader) are one node of the walk; where the leader's angle leaves it open, their
   cosines are computed in double, so no link is below the threshold.
5. A pair that meets in several shards counts in the first they share. Links are counted
   and joined into stars inside the part; pairs are never sent anywhere.
6. Recall is audited: bounded sample queries against all vectors by brute force, in
   blocks, query by query and by size of neighbourhood. Below ``min_recall`` the overlap
   is raised and the graph built anew; past ``MAX_OVERLAP`` every vector searches all
   shards that can hold one in range, which misses nothing.

Defined results: a null, empty, zero or non-finite vector links with nothing and is its
own component. A null vec_id takes no part (no links, null component, not kept).
Repeated rows (same id and vector) are one vector. Vectors of different lengths do not
link. An empty table gives no rows.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import bound_batches, small, stage
from touchline.llm.graph import components

THRESHOLD = 0.95
#: Vectors that centroids are fitted on, at most; and most centroids.
SAMPLE_VECTORS = 32_768
MAX_SHARDS = 8192
#: Members of a shard aimed at, and most members of one part.
SHARD_SIZE, SHARD_CAP = 1024, 4096
OVERLAP = 2
DEGREE, CANDIDATES, ALPHA = 24, 48, 1.2
#: Random long edges of a row, and the longest list of neighbours.
FAR, WIDTH = 4, 48
#: Nodes the greedy search keeps, and those it opens at a time.
BEAM, OPEN = 16, 4
BLOCK = 256
#: Audit queries and the recall below which the index is built anew.
AUDIT_QUERIES, MIN_RECALL = 4096, 0.98
#: The widest overlap that is tried before the exact search.
MAX_OVERLAP = 16

log = logging.getLogger(__name__)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, fp, v``: v the vector as doubles (little-endian bytes), fp its fingerprint;
    both null where it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 2000):
            out = []
            for e in b.column(1).to_pylist():
                x = None
                if e and None not in e:
                    x = np.array(e, dtype=np.float64) + 0.0
                    norm = np.linalg.norm(x)
                    if not np.isfinite(x).all() or not norm > 0:
                        x = None
                    elif not np.isfinite(norm) or norm < 1e-150:  # scale first: squares leave the range
                        x = x / np.abs(x).max()
                out.append(None if x is None else x.tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["vec_id", "v"])

    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return v.mapInArrow(run, "vec_id long, v binary").select("vec_id", F.when(F.col("v").isNotNull(), F.sha2("v", 256)).alias("fp"), "v")


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return x / np.linalg.norm(x, axis=1)[:, None]


def fit_centroids(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Spherical k-means of unit rows."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.concatenate([(x[s:s + 4096] @ c.T).argmax(axis=1) for s in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1)
        c = np.where(norm[:, None] > 0, total / np.maximum(norm, 1e-300)[:, None], c)
    return c


def robust_prune(x: np.ndarray, rows: np.ndarray, cand: np.ndarray, own: np.ndarray, degree: int, alpha: float) -> list[list[int]]:
    """Of each row's candidates (nearest first, with their cosines ``own``) at most ``degree``: the
    nearest that is left is taken, and what is nearer to it by the factor alpha is dropped."""
    out = [[] for _ in rows]
    dist = np.sqrt(np.maximum(2 - 2 * own, 0))
    alive = np.ones(cand.shape, dtype=bool)
    vecs = x[cand]
    at = np.arange(len(rows))
    for _ in range(min(degree, cand.shape[1])):
        has = alive.any(axis=1)
        if not has.any():
            break
        pick = alive.argmax(axis=1)
        alive[at, pick] = False
        chosen = cand[at, pick]
        for r in np.flatnonzero(has).tolist():
            out[r].append(int(chosen[r]))
        between = np.sqrt(np.maximum(2 - 2 * np.matmul(vecs, x[chosen][:, :, None])[:, :, 0], 0))
        alive &= alpha * between > dist
    return out


def narrow(x: np.ndarray, i: int, cand: np.ndarray, width: int = WIDTH, alpha: float = ALPHA) -> np.ndarray:
    """A list within ``width``: half of it robust-pruned, half an even choice by distance of the
    rest, which keeps the long edges."""
    if len(cand) <= width:
        return cand
    sim = x[cand] @ x[i]
    order = np.argsort(-sim, kind="stable")
    cand, sim = cand[order], sim[order]
    kept = robust_prune(x, np.array([i]), cand[None], sim[None], width // 2, alpha)[0]
    rest = cand[~np.isin(cand, kept)]
    return np.concatenate([kept, rest[np.linspace(0, len(rest) - 1, width - len(kept)).astype(int)]])


def build_graph(x: np.ndarray, degree: int = DEGREE, pool: int = CANDIDATES, alpha: float = ALPHA) -> list[np.ndarray]:
    """Neighbours of each row: robust-pruned of its nearest, ``FAR`` seeded random rows (long
    edges, so that no group of near copies is cut off), and the reverse of both."""
    n = len(x)
    if n == 1:
        return [np.empty(0, dtype=np.int64)]
    pool = min(pool, n - 1)
    out = []
    for s in range(0, n, BLOCK):
        rows = np.arange(s, min(s + BLOCK, n))
        sim = x[rows] @ x.T
        sim[np.arange(len(rows)), rows] = -np.inf
        cand = np.argpartition(-sim, pool - 1, axis=1)[:, :pool]
        own = np.take_along_axis(sim, cand, axis=1)
        order = np.argsort(-own, axis=1, kind="stable")
        out += robust_prune(x, rows, np.take_along_axis(cand, order, axis=1), np.take_along_axis(own, order, axis=1), degree, alpha)
    for i, row in enumerate(np.random.default_rng(11).integers(0, n, (n, FAR)).tolist()):
        out[i] += [j for j in row if j != i]
    back = [[] for _ in range(n)]
    for i, row in enumerate(out):
        for j in row:
            back[j].append(i)
    return [narrow(x, i, np.unique(np.array(a + b, dtype=np.int64))) for i, (a, b) in enumerate(zip(out, back))]


def balls(x: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaders such that every row is within half the range of one: (leaders, the place of each
    row's leader in them, widest angle of each). Rows of one ball all link with each other."""
    half = np.cos(np.arccos(threshold) / 2)
    leaders, owner, sim_of = [], np.full(len(x), -1), np.ones(len(x))
    for s in range(0, len(x), BLOCK):
        rows = np.arange(s, min(s + BLOCK, len(x)))
        if leaders:
            sim = x[rows] @ x[leaders].T
            best = sim.argmax(axis=1)
            top = sim[np.arange(len(rows)), best]
            owner[rows] = np.where(top >= half, best, -1)
            sim_of[rows] = np.where(top >= half, top, 1)
        left = rows[owner[rows] < 0]
        between = x[left] @ x[left].T
        for k, i in enumerate(left.tolist()):
            if owner[i] >= 0:
                continue
            mine = (between[k] >= half) & (owner[left] < 0)
            mine[k] = True
            owner[left[mine]], sim_of[left[mine]] = len(leaders), between[k, mine]
            sim_of[i] = 1
            leaders.append(i)
    radius = np.zeros(len(leaders))
    np.maximum.at(radius, owner, np.arccos(np.clip(sim_of, -1, 1)))
    return np.array(leaders), owner, radius


def medoids(x: np.ndarray) -> np.ndarray:
    """Entry points of the search: the medoid and farthest-first rows, the square root of all."""
    starts = [int((x @ x.mean(axis=0)).argmax())]
    sim = x @ x[starts[0]]
    for _ in range(int(np.sqrt(len(x))) - 1):
        starts.append(int(sim.argmin()))
        sim = np.maximum(sim, x @ x[starts[-1]])
    return np.unique(starts)


class Part:
    """The graph of one part, its balls as nodes: near copies are walked once, as one node."""

    def __init__(self, x: np.ndarray, near: list, threshold: float):
        self.x, self.threshold, self.range = x, threshold, np.arccos(threshold)
        self.leaders, self.owner, self.radius = balls(x, threshold)
        self.y = x[self.leaders]
        n = len(self.leaders)
        lists = [set() for _ in range(n)]
        for i, row in enumerate(near):
            lists[self.owner[i]].update(self.owner[np.asarray(row, dtype=np.int64)].tolist())
        lists = [narrow(self.y, i, np.array(sorted(a - {i}), dtype=np.int64)) for i, a in enumerate(lists)]
        self.adjacency = np.full((n, max(1, max(len(a) for a in lists))), n)
        for i, a in enumerate(lists):
            self.adjacency[i, :len(a)] = a
        self.start = medoids(self.y)
        self.padded = np.vstack([self.y, np.zeros((1, x.shape[1]))]).astype(np.float32)
        # A ball is in range if one of its rows can be; the margin covers float32.
        self.bar = np.append(np.cos(np.minimum(self.range + self.radius, np.pi)) - 1e-5, np.inf).astype(np.float32)
        self.met = 0  # nodes compared with queries so far

    def _meet(self, claim: np.ndarray, rows: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Which of ``near`` (a list per row) are new to their query, each once."""
        col = np.broadcast_to(np.arange(near.shape[1], dtype=np.int32), near.shape)
        at = np.broadcast_to(rows[:, None], near.shape)
        new = claim[at, near] < 0
        claim[at[new], near[new]] = col[new]
        return new & (claim[at, near] == col)

    def walk(self, q: np.ndarray, own: np.ndarray | None = None, beam: int = BEAM) -> np.ndarray:
        """Boolean (queries, balls): balls in range. A greedy beam search from the medoids, then
        range expansion until none is new. ``own`` is the ball of a query that lies in this
        part (else -1), which is in range by itself."""
        n, m = len(self.leaders), len(q)
        q32 = q.astype(np.float32)
        claim = np.full((m, n + 1), -1, dtype=np.int32)  # -1: not met yet
        claim[:, n] = 0
        claim[:, self.start] = 0
        first = q32 @ self.padded[self.start].T
        hit = np.zeros((m, n), dtype=bool)
        hit[:, self.start] = first >= self.bar[self.start]
        ids, sims, opened = np.full((m, beam), n), np.full((m, beam), -np.inf, np.float32), np.ones((m, beam), dtype=bool)
        k = min(beam, len(self.start))
        top = np.argpartition(-first, k - 1, axis=1)[:, :k]
        ids[:, :k], sims[:, :k], opened[:, :k] = self.start[top], np.take_along_axis(first, top, 1), False
        active = np.arange(m)
        while len(active):
            waiting = np.where(opened[active], -np.inf, sims[active])
            best = np.argpartition(-waiting, OPEN - 1, axis=1)[:, :OPEN]
            go = np.take_along_axis(waiting, best, 1) > -np.inf
            some = go.any(axis=1)
            active, best, go = active[some], best[some], go[some]
            if not len(active):
                break
            opened[active[:, None], best] = True
            near = self.adjacency[np.where(go, ids[active[:, None], best], 0)]
            near = np.where(go[:, :, None], near, n).reshape(len(active), -1)
            fresh = self._meet(claim, active, near)
            s = np.matmul(self.padded[near], q32[active][:, :, None])[:, :, 0]
            s[~fresh] = -np.inf
            r, c = np.nonzero(s >= self.bar[near])
            hit[active[r], near[r, c]] = True
            all_ids = np.concatenate([ids[active], near], axis=1)
            all_sims = np.concatenate([sims[active], s], axis=1)
            all_open = np.concatenate([opened[active], ~fresh], axis=1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[active], sims[active] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_sims, top, 1)
            opened[active] = np.take_along_axis(all_open, top, 1)
        if own is not None:
            here = np.flatnonzero(own >= 0)
            hit[here, own[here]] = True
            claim[here, own[here]] = 0
        done = np.zeros_like(hit)
        while True:
            r, c = np.nonzero(hit & ~done)
            if not len(r):
                break
            done[r, c] = True
            for s in range(0, len(r), 4096):
                near = self.adjacency[c[s:s + 4096]]
                new = claim[r[s:s + 4096, None], near] < 0
                pair = np.unique(np.repeat(r[s:s + 4096], new.sum(axis=1)) * (n + 1) + near[new])
                qs, ns = pair // (n + 1), pair % (n + 1)
                claim[qs, ns] = 0
                for t in range(0, len(qs), 65536):
                    a, b = qs[t:t + 65536], ns[t:t + 65536]
                    inside = np.einsum("ij,ij->i", q32[a], self.padded[b]) >= self.bar[b]
                    hit[a[inside], b[inside]] = True
        self.met += int((claim[:, :n] >= 0).sum())
        return hit

    def rows_in(self, found: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Boolean (queries, rows): rows of the found balls within range, in double. A ball that
        lies in the range whole needs no comparison (triangle inequality of angles)."""
        r, b = np.nonzero(found)
        angle = np.empty(len(r))
        for t in range(0, len(r), 65536):
            angle[t:t + 65536] = np.arccos(np.clip(np.einsum("ij,ij->i", q[r[t:t + 65536]], self.y[b[t:t + 65536]]), -1, 1))
        whole = angle + self.radius[b] <= self.range - 1e-6
        sure, open_ = np.zeros_like(found), np.zeros_like(found)
        sure[r[whole], b[whole]] = True
        open_[r[~whole], b[~whole]] = True
        hit = sure[:, self.owner]
        r, c = np.nonzero(open_[:, self.owner])
        for t in range(0, len(r), 65536):
            a, d = r[t:t + 65536], c[t:t + 65536]
            hit[a, d] = np.einsum("ij,ij->i", q[a], self.x[d]) >= self.threshold
        return hit

    def search(self, q: np.ndarray, own: np.ndarray | None = None, beam: int = BEAM) -> np.ndarray:
        """Boolean (queries, rows): rows found within range; ``own`` is a query's row here or -1."""
        ball = None if own is None else np.where(own >= 0, self.owner[own], -1)
        return self.rows_in(self.walk(q, ball, beam), q)


def visited(c: np.ndarray, sim: np.ndarray, gap: np.ndarray, threshold: float) -> tuple[int, np.ndarray]:
    """The home (nearest centroid) of a vector and the shards that are home to all vectors
    within range: beyond the border between two homes by more than the range nothing is."""
    home = int(sim.argmax())
    return home, np.flatnonzero(sim[home] - sim <= np.sqrt(2 - 2 * threshold) * gap[home] + 1e-9)


def _assign(reps: DataFrame, centroids, parts, overlap: int | None, threshold: float) -> DataFrame:
    """Members and queries of cells: ``rep, copies, v, shards, shard, part, block, member, query``.

    A shard of several parts has as many blocks of queries; a cell is one part and one block,
    so neither side of it grows with the shard.

    Without ``overlap`` the answer is exact: a vector is a member of its home alone and
    queries every shard that can hold one in range (``shards`` is empty, no pair meets twice).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c_of = centroids.value
        n_parts = parts.value if parts is not None else {}
        gaps: dict[int, np.ndarray] = {}
        for b in small(batches, 1000):
            rows = [[] for _ in range(9)]
            for rep, copies, v in zip(*[x.to_pylist() for x in b.columns[:3]]):
                dim = len(v) // 8
                base, c = c_of[dim]
                sim = c @ _unit([v])[0]
                if overlap is None:
                    if dim not in gaps:
                        gaps[dim] = np.sqrt(np.maximum(2 - 2 * c @ c.T, 0))
                    home, found = visited(c, sim, gaps[dim], threshold)
                    shards, named, home = [base + int(i) for i in found], [], base + home
                else:
                    k = min(overlap, len(c))
                    shards = named = sorted(base + int(i) for i in np.argpartition(-sim, k - 1)[:k])
                    home = None
                for s in shards:
                    n = n_parts.get(s, 1)
                    own = (rep * 2654435761 >> 16) % n
                    inside = home in (None, s)
                    cells = [(p, own, inside and p == own, True) for p in range(n)]
                    if inside:
                        cells += [(own, q, True, False) for q in range(n) if q != own]
                    for cell in cells:
                        for col, val in zip(rows, (rep, copies, v, named, s, *cell)):
                            col.append(val)
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)],
                                             names=["rep", "copies", "v", "shards", "shard", "part", "block", "member", "query"])

    return reps.select("rep", "copies", "v").mapInArrow(
        run, "rep long, copies long, v binary, shards array<int>, shard int, part int, block int, member boolean, query boolean")


def _links(reps: DataFrame, sample: dict[int, np.ndarray], n_of: dict[int, int], overlap: int | None, threshold: float):
    """(rep, n other distinct vectors' copies linked) and star edges, for one overlap (None: exact)."""
    spark = reps.sparkSession
    fitted, base = {}, 0
    for dim, x in sorted(sample.items()):
        k = int(min(MAX_SHARDS, len(x), max(1, round(n_of[dim] / SHARD_SIZE))))
        fitted[dim] = (base, fit_centroids(x, k))
        base += k
    centroids = spark.sparkContext.broadcast(fitted)  # at most MAX_SHARDS rows a dimension
    sizes = _assign(reps, centroids, None, overlap, threshold).groupBy("shard").count().collect()  # a row per shard: bounded
    parts = spark.sparkContext.broadcast({r["shard"]: -(-r["count"] // SHARD_CAP) for r in sizes if r["count"] > SHARD_CAP})
    members = stage(_assign(reps, centroids, parts, overlap, threshold), "vec-members")

    def build(t: pa.Table) -> pa.Table:
        ids = t.column("rep").to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        x = _unit([v.as_py() for v in t.column("v").take(pa.array(order))])
        near = [ids[a].tolist() for a in build_graph(x)]
        return pa.Table.from_arrays([pa.array(ids), pa.array(near, pa.list_(pa.int64()))], names=["node", "near"])

    graph = members.filter("member AND part = block").select("rep", "v", "shard", "part").groupBy("shard", "part").applyInArrow(
        lambda t: build(t), "node long, near array<long>")
    united = graph.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))

    def search(t: pa.Table) -> pa.Table:
        t = t.take(pa.array(np.argsort(t.column("rep").to_numpy())))
        ids, copies = t.column("rep").to_numpy(), t.column("copies").to_numpy()
        x = _unit(t.column("v").to_pylist())
        shard = t.column("shard")[0].as_py()
        sets = np.array([s + [-1] * ((overlap or 1) - len(s)) for s in t.column("shards").to_pylist()])
        node = np.flatnonzero(t.column("member").to_numpy(zero_copy_only=False))
        links, low = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        if len(node):
            place = {int(i): k for k, i in enumerate(ids[node])}
            y = x[node]
            graph = None
            if overlap is not None:
                near_ids = t.column("near").take(pa.array(node)).to_pylist()
                graph = Part(y, [[place[j] for j in (a or []) if j in place] for a in near_ids], threshold)
            found = []
            asked = np.flatnonzero(t.column("query").to_numpy(zero_copy_only=False))
            for s in range(0, len(asked), BLOCK):
                q = asked[s:s + BLOCK]
                if graph is None:  # the exact search compares all
                    hit = x[q] @ y.T >= threshold
                else:
                    hit = graph.search(x[q], np.array([place.get(int(i), -1) for i in ids[q]]))
                hit &= ids[q][:, None] != ids[node][None, :]
                r, c = np.nonzero(hit)
                earlier = np.zeros(len(r), dtype=bool)  # the pair shares a smaller shard
                for k in range(sets.shape[1]):
                    mine = sets[q[r], k]
                    earlier |= (mine >= 0) & (mine < shard) & (sets[node[c]] == mine[:, None]).any(axis=1)
                np.add.at(links, q[r[~earlier]], copies[node[c[~earlier]]])
                found.append((q, np.packbits(hit, axis=1)))
            while True:  # least label over all links found here
                before = low.copy()
                for q, bits in found:
                    hit = np.unpackbits(bits, axis=1, count=len(node)).astype(bool)
                    if not hit.any():
                        continue
                    best = np.minimum(low[q], np.where(hit, low[node][None, :], len(ids)).min(axis=1))
                    low[q] = best
                    r, c = np.nonzero(hit)
                    np.minimum.at(low, node[c], best[r])
                if (before == low).all():
                    break
        return pa.Table.from_arrays([pa.array(ids), pa.array(links), pa.array(ids[low])], names=["rep", "links", "star"])

    joined = members.join(united, members["rep"] == united["node"], "left").drop("node")
    return stage(joined.groupBy("shard", "part", "block").applyInArrow(lambda t: search(t), "rep long, links long, star long"), "vec-links")


def hash_sample(rows: DataFrame, n: int) -> DataFrame:
    """Some ``n`` rows (all, where there are no more): those whose hash of ``rep`` is below a
    bound that follows from the count, so no task sorts or gathers the sample."""
    total = rows.count()
    if total <= n:
        return rows
    return rows.filter(F.pmod(F.xxhash64("rep"), F.lit(1 << 40)) < int(n / total * (1 << 40)))


def audit(reps: DataFrame, links: DataFrame, threshold: float, queries: int = AUDIT_QUERIES) -> float:
    """Least recall over the sizes of neighbourhoods, by brute force in blocks.

    A query's recall is the found share of its true links. Queries with 1, 2 to 9, 10 to 99
    (and so on) true links are averaged apart, so those of large groups hide no others.
    Queries are random vectors, found links or not, and as many of those with links.
    """
    spark = reps.sparkSession
    linked = links.groupBy("rep").agg(F.sum("links").alias("links"))
    q = reps.join(linked, "rep", "left").na.fill(0, ["links"])
    random = hash_sample(q, queries).select("rep", "v", "links")
    with_links = hash_sample(q.filter("links > 0"), queries).select("rep", "v", "links")
    rows = {r["rep"]: (bytes(r["v"]), r["links"]) for r in [*random.collect(), *with_links.collect()]}
    if not rows:
        return 1.0
    shared = spark.sparkContext.broadcast([(k, v[0]) for k, v in rows.items()])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        by_dim: dict[int, list] = {}
        for k, v in asked:
            by_dim.setdefault(len(v), []).append((k, v))
        by_dim = {d: (np.array([k for k, _ in a]), _unit([v for _, v in a])) for d, a in by_dim.items()}
        total = dict.fromkeys((k for k, _ in asked), 0)
        for b in small(batches, 1000):
            got: dict[int, list] = {}
            for rep, copies, v in zip(*[c.to_pylist() for c in b.columns]):
                got.setdefault(len(v), []).append((rep, copies, v))
            for d, a in got.items():
                if d not in by_dim:
                    continue
                ids, x = by_dim[d]
                hit = x @ _unit([v for _, _, v in a]).T >= threshold
                hit &= ids[:, None] != np.array([r for r, _, _ in a])[None, :]
                for k, n in zip(ids.tolist(), (hit * np.array([c for _, c, _ in a])).sum(axis=1).tolist()):
                    total[k] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["rep", "n"])

    true = reps.select("rep", "copies", "v").mapInArrow(count, "rep long, n long").groupBy("rep").agg(F.sum("n").alias("n")).collect()
    return least_recall([(r["n"], rows[r["rep"]][1]) for r in true])


def least_recall(counts: list[tuple[int, int]]) -> float:
    """Least mean recall of the size classes of (true links, found links) of queries."""
    classes: dict[int, list[float]] = {}
    for n, found in counts:
        if n:
            classes.setdefault(len(str(n)) if n > 1 else 0, []).append(min(n, found) / n)
    return min((sum(c) / len(c) for c in classes.values()), default=1.0)


def embedding_links(vectors: DataFrame, threshold: float = THRESHOLD, overlap: int = OVERLAP, min_recall: float = MIN_RECALL) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    bound_batches(vectors.sparkSession)
    clean = stage(usable(vectors), "vec-clean")
    linkable = clean.filter("vec_id IS NOT NULL AND fp IS NOT NULL")
    reps = stage(linkable.select("vec_id", "fp", "v").groupBy("fp").agg(
        F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("copies"), F.first("v").alias("v")), "vec-reps")
    n_of = {r["d"] // 8: r["n"] for r in reps.groupBy(F.length("v").alias("d")).agg(F.count("*").alias("n")).collect()}
    total = sum(n_of.values())
    if not total:
        return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                              F.col("vec_id").cast("long").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    picked = hash_sample(reps, SAMPLE_VECTORS).select("v").collect()
    sample: dict[int, list] = {}
    for r in picked:
        sample.setdefault(len(r["v"]) // 8, []).append(bytes(r["v"]))
    missing = [d for d in n_of if d not in sample]
    for d in missing:  # a rare length that the sample has none of
        sample[d] = [bytes(r["v"]) for r in reps.filter(F.length("v") == 8 * d).limit(64).collect()]
    sample = {d: _unit(v) for d, v in sample.items()}
    while True:
        links = _links(reps, sample, n_of, overlap, threshold)
        if overlap is None:
            break  # exact
        recall = audit(reps, links, threshold)
        log.info("overlap %d: recall %.4f", overlap, recall)
        if recall >= min_recall:
            break
        overlap = overlap * 2 if overlap < MAX_OVERLAP else None
    found = components(links.filter("star <> rep").select(F.col("rep").alias("a"), F.col("star").alias("b")))
    counts = links.groupBy("rep").agg(F.sum("links").alias("links")).select(F.col("rep").alias("_l"), "links")
    per = reps.select("fp", "rep", "copies").join(counts, F.col("rep") == F.col("_l"), "left").join(found, F.col("rep") == F.col("node"), "left")
    per = stage(per.select(F.col("fp").alias("_fp"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"),
                           F.coalesce("component", "rep").alias("c")), "vec-result")
    out = clean.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("fp")).alias("fp")).join(per, F.col("fp") == F.col("_fp"), "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("c", "vec_id"))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
