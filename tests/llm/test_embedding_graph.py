from __future__ import annotations

import numpy as np

from touchline.llm import embedding_graph as eg

SCHEMA = "vec_id long, embedding array<float>, label int, v string, rep int, copies int"


def brute(rows, threshold=0.95):
    distinct = {}
    for i, e in rows:
        distinct.setdefault((i, None if e is None else tuple(np.float32(x) if x is not None else None for x in e)), e)
    keys = list(distinct)
    unit = []
    for i, e in keys:
        ok = i is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(x != 0 for x in e)
        x = np.array(e, dtype=np.float32).astype(np.float64) if ok else None
        unit.append(x / np.linalg.norm(x) if ok else None)
    n, root = len(keys), list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * n
    for a in range(n):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    low = {}
    for a in range(n):
        if keys[a][0] is not None:
            low[find(a)] = min(low.get(find(a), 1 << 62), keys[a][0])
    return sorted(((keys[a][0], links[a], low.get(find(a)), keys[a][0] is not None and keys[a][0] == low.get(find(a))) for a in range(n)), key=repr)


def make(seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 30))):
            rows.append((len(rows), (centre + rng.normal(size=16) * 0.12).astype(np.float32).tolist()))
    rows += [(1000 + i, rows[3][1]) for i in range(6)]  # copies
    rows.append((2000, [float(2 * x) for x in rows[5][1]]))  # another length, the same direction
    rows += [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [float("nan")] * 16), (3004, [None, 1.0]), (3005, [float("inf")] * 16)]
    rows += [(4000, [1.0, 2.0]), (4001, [1.0, 2.0]), (None, rows[0][1]), (7, rows[7][1]), (-5, rows[8][1])]
    return rows


def test_matches_brute_force(spark):
    rows = make()
    df = spark.createDataFrame([(i, e, 1, "x", 2, 3) for i, e in rows], SCHEMA)
    got = [tuple(r) for r in eg.embedding_links(df).collect()]
    assert len(got) == len(rows)
    assert sorted(set(got), key=repr) == sorted(set(brute(rows)), key=repr)


def test_shards_dealt_into_parts(spark, monkeypatch):
    monkeypatch.setattr(eg, "SHARD_SIZE", 40)
    monkeypatch.setattr(eg, "SHARD_CAP", 25)
    rows = [r for r in make(3) if r[0] is not None]
    df = spark.createDataFrame([(i, e, 1, "x", 2, 3) for i, e in rows], SCHEMA)
    got = {r["vec_id"]: r for r in eg.embedding_links(df).collect()}
    want = brute(rows)
    found, true = sum(r["n_links"] for r in got.values()), sum(w[1] for w in want)
    assert all(got[w[0]]["n_links"] <= w[1] for w in want)  # none below the threshold
    assert found >= 0.9 * true


def test_search_against_all_rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 24))
    x[:200] = x[0] + rng.normal(size=(200, 24)) * 0.1
    x /= np.linalg.norm(x, axis=1)[:, None]
    part = eg.Part(x, eg.build_graph(x), 0.9)
    hit = part.search(x)
    true = x @ x.T >= 0.9
    assert not (hit & ~true).any() and hit.sum() >= 0.99 * true.sum()


def test_the_graph_is_walked():
    """Vectors without near ones: few entry points, a part of the rows compared, each query
    still reaches its own row from the medoids."""
    x = np.random.default_rng(3).normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    part = eg.Part(x, eg.build_graph(x), 0.95)
    assert len(part.leaders) == 2000 and len(part.start) <= 45 and part.adjacency.shape[1] <= eg.WIDTH
    hit = np.concatenate([part.search(x[s:s + 250]) for s in range(0, 2000, 250)])
    assert np.diag(hit).mean() >= 0.99 and hit.sum() <= 2000
    assert part.met <= 0.4 * 2000 * 2000


def test_balls_hold_only_linked_rows():
    """Rows of a ball all link; a crowd of near copies is one node."""
    x = crowds(6, 50, spread=0.01)
    leaders, owner, radius = eg.balls(x, 0.95)
    for k in range(len(leaders)):
        rows = np.flatnonzero(owner == k)
        assert (x[rows] @ x[rows].T >= 0.95 - 1e-12).all()
        assert np.arccos(np.clip(x[rows] @ x[leaders[k]], -1, 1)).max() <= radius[k] + 1e-9
    assert (owner >= 0).all() and len(leaders) == 6


def test_pairs_at_the_threshold_are_compared():
    """Angles just inside and outside the range of a ball are decided by the cosine itself."""
    theta = np.arccos(0.95)
    turns = np.array([0, theta - 1e-9, theta + 1e-9, theta / 2, theta / 2 + 1e-9, 2 * theta])
    x = np.stack([np.cos(turns), np.sin(turns)], axis=1)
    part = eg.Part(x, eg.build_graph(x), 0.95)
    assert (part.search(x, np.arange(len(x))) == (x @ x.T >= 0.95)).all()


def crowds(groups, size, seed=7, dim=32, spread=0.02):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(size=dim) / np.sqrt(dim) + rng.normal(size=(size, dim)) * spread for _ in range(groups)])
    return x / np.linalg.norm(x, axis=1)[:, None]


def test_groups_larger_than_pool_and_beam():
    """Many groups that fill the candidate pool and the beam; none may be lost."""
    for groups, size in ((5, 200), (12, 80), (1, 900), (300, 3)):
        x = crowds(groups, size)
        hit = eg.Part(x, eg.build_graph(x), 0.95).search(x)
        true = x @ x.T >= 0.95
        assert (hit == true).all()


def test_large_groups_end_to_end(spark):
    x = crowds(3, 200, seed=2)
    df = spark.createDataFrame([(i, v.tolist(), 1, "x", 2, 3) for i, v in enumerate(x)], SCHEMA)
    got = {r["vec_id"]: r["n_links"] for r in eg.embedding_links(df).collect()}
    y = x.astype(np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1)[:, None]
    assert [got[i] for i in range(len(x))] == ((y @ y.T >= 0.95).sum(axis=1) - 1).tolist()


def test_recall_of_small_neighbourhoods_is_not_drowned():
    hot, lost = [(9000, 9000)] * 300, [(3, 0)] * 20
    assert eg.least_recall([*hot, *lost, (0, 0)]) == 0 and eg.least_recall(hot) == 1 and eg.least_recall([]) == 1


def test_audit_that_never_passes_ends_exact(spark, monkeypatch):
    """Shards cut through the groups: what no overlap mends is searched exactly."""
    monkeypatch.setattr(eg, "SHARD_SIZE", 20)
    monkeypatch.setattr(eg, "SHARD_CAP", 25)
    monkeypatch.setattr(eg, "MAX_OVERLAP", 1)
    monkeypatch.setattr(eg, "audit", lambda *a, **k: 0.0)
    x = crowds(4, 60, seed=3, dim=16, spread=0.05)
    df = spark.createDataFrame([(i, v.tolist(), 1, "x", 2, 3) for i, v in enumerate(x)], SCHEMA)
    got = {r["vec_id"]: r["n_links"] for r in eg.embedding_links(df, overlap=1).collect()}
    y = x.astype(np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1)[:, None]
    assert [got[i] for i in range(len(x))] == ((y @ y.T >= 0.95).sum(axis=1) - 1).tolist()


def test_cells_of_a_hot_shard_are_bounded(spark):
    """No task gets all queries of a shard: a cell holds one part and one block."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 8))
    reps = spark.createDataFrame([(i, 1, bytearray(v.tobytes())) for i, v in enumerate(x)], "rep long, copies long, v binary")
    shared = spark.sparkContext.broadcast({8: (0, x[:1] / np.linalg.norm(x[0]))})
    cells = eg._assign(reps, shared, spark.sparkContext.broadcast({0: 8}), 1, 0.95).collect()
    at, met = {}, set()
    for r in cells:
        at.setdefault((r["part"], r["block"]), []).append(r)
    for rows in at.values():
        assert len(rows) <= 160  # of 400: about 50 members and 50 queries
        met |= {(q["rep"], m["rep"]) for q in rows if q["query"] for m in rows if m["member"]}
    assert len(met) == 400 * 400  # every query meets every member


def test_hash_sample_is_near_its_size(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "rep")
    assert 800 < eg.hash_sample(rows, 1000).count() < 1200
    assert eg.hash_sample(rows, 20_000).count() == 20_000


def test_empty_table(spark):
    assert eg.embedding_links(spark.createDataFrame([], SCHEMA)).count() == 0
