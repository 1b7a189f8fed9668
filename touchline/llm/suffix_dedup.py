"""Suffix-array dedup: repeated passages across documents, found by an LCP-interval tree.

Texts are UTF-8 bytes. A byte is removed if a ``WINDOW``-byte string that covers it
also starts in a document with a smaller doc_id.

A suffix array of the whole corpus would move every byte's suffix. Here each window
is represented by its anchor, the GRAM-byte string with the least hash in it (equal
windows have equal anchors), and only anchors that occur in two documents go on:

1. Documents are dealt into chunks of bounded size by a hash of doc_id. A chunk sends
   each distinct anchor hash once, with the number of its documents.
2. Anchor buckets find hashes of two documents or more and tell the chunks.
3. A chunk sends each distinct context (the union of the windows that one anchor
   represents, under 100 bytes) once, with the smallest and largest doc_id that hold it.
   Anchors of very many documents send single windows instead, keyed by the window, so
   that what differs around a common passage does not meet in one bucket.
4. A bucket sorts the suffixes of its distinct contexts (those of WINDOW bytes or more),
   computes the LCPs of neighbours and stack-scans them into the interval tree. An
   interval whose occurrences differ in the byte before (or begin their context) is a
   maximal repeat group: its length and the smallest document go back for all occurrences.
5. The chunk marks the bytes of occurrences in larger documents.

All messages are one per chunk and distinct key, so copies are collapsed before each
shuffle, and the text itself is shuffled once (the chunked exchange is reused).

Defined results: null text is empty; texts shorter than WINDOW lose nothing. A null
doc_id counts as larger than all others. Rows of equal doc_id (or both null) do not
remove from each other. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import bound_batches, give_back, text_or_empty

WINDOW = 50
GRAM = 16
#: Text bytes of one chunk, on average.
CHUNK_BYTES = 8 << 20
#: Text bytes per anchor bucket.
BUCKET_BYTES = 16 << 20
#: From so many documents on, an anchor's windows are sent one by one.
HOT_DOCS = 1000
#: Bytes hashed at a time; longer texts are cut into overlapping segments.
SLAB = 1 << 18
#: Contexts whose suffixes are sorted at a time (whole anchor groups).
RUN_CONTEXTS = 2048
#: The id that stands for null.
NO_ID = np.iinfo(np.int64).max
#: A context's first byte has no known byte before it.
NO_BYTE = 256

_P = np.uint64(0x9E3779B97F4A7C15)
_POS = np.uint64((1 << 22) - 1)
#: Anchor hashes have 48 bits.
_HASH = np.uint64((1 << 48) - 1)


def _u(n: int) -> np.uint64:
    return np.uint64(n)


def slab_anchors(a: np.ndarray, begin: np.ndarray, window: int, gram: int):
    """Anchors of the windows of a slab of segments (``begin``: their offsets, end included).

    Returns arrays: hash, first window start, last window start. Windows do not cross segments.
    """
    n = len(a) - gram + 1
    empty = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    if len(a) < window:
        return empty
    x = a.astype(np.uint64)
    x = x[:-1] | (x[1:] << _u(8))
    x = x[:-2] | (x[2:] << _u(16))
    x = x[:-4] | (x[4:] << _u(32))  # eight bytes from each offset
    h = x[:n] * _P
    for off in [*range(8, gram - 8, 8), gram - 8]:
        h = ((h ^ (h >> _u(29))) + x[off:off + n]) * _P
    h ^= h >> _u(32)
    h *= _P
    h ^= h >> _u(29)
    h &= _HASH
    # Least hash, leftmost at ties: the position takes the place of the lowest bits.
    m = (h << _u(16) & ~_POS) | np.arange(n, dtype=np.uint64)
    width, span = window - gram + 1, 1
    while span * 2 <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    if width > span:
        m = np.minimum(m[:span - width], m[width - span:])
    at = (m & _POS).astype(np.int64)
    valid = np.ones(len(at), dtype=bool)
    for e in begin[1:]:
        valid[max(0, e - window + 1):e] = False
    i = np.flatnonzero(valid)
    if not len(i):
        return empty
    p = at[i]
    new = np.flatnonzero(np.concatenate(([True], (p[1:] != p[:-1]) | (i[1:] != i[:-1] + 1))))
    return h[p[new]], i[new], np.concatenate((i[new[1:] - 1], i[-1:]))


def anchors(texts: list[bytes], window: int, gram: int):
    """Arrays (hash, text index, first window start, last window start) of all texts."""
    out = []
    parts: list[tuple[int, int, bytes]] = []
    size = 0

    def flush():
        begin = np.concatenate(([0], np.cumsum([len(p[2]) for p in parts])))
        h, lo, hi = slab_anchors(np.frombuffer(b"".join(p[2] for p in parts), np.uint8), begin, window, gram)
        seg = np.searchsorted(begin, lo, side="right") - 1
        shift = np.array([p[1] for p in parts], dtype=np.int64)[seg] - begin[seg]
        doc = np.array([p[0] for p in parts], dtype=np.int32)[seg]
        out.append((h, doc, (lo + shift).astype(np.int32), (hi + shift).astype(np.int32)))

    for d, t in enumerate(texts):
        if len(t) < window:
            continue
        for off in range(0, len(t) - window + 1, SLAB):
            part = t[off:off + SLAB + window - 1]
            parts.append((d, off, part))
            size += len(part)
            if size >= SLAB:
                flush()
                parts, size = [], 0
    if parts:
        flush()
    if not out:
        return np.empty(0, np.uint64), *[np.empty(0, np.int32)] * 3
    return tuple(np.concatenate(c) for c in zip(*out))


def _docs_of(h: np.ndarray, d: np.ndarray):
    """Distinct hashes, and in how many texts each occurs. ``d`` does not fall, as anchors come text by text."""
    order = np.argsort(h, kind="stable")
    h, d = h[order], d[order]
    new = np.concatenate(([True], h[1:] != h[:-1]))
    first = new | np.concatenate(([True], d[1:] != d[:-1]))
    at = np.flatnonzero(new)
    return h[at], np.add.reduceat(first, at, dtype=np.int64)


def _sorted_docs(docs: pa.Table) -> tuple[pa.Table, np.ndarray, list[bytes]]:
    """A chunk in an order that does not depend on how its rows arrived (the table without its texts)."""
    ids = [NO_ID if i is None else i for i in docs.column("doc_id").to_pylist()]
    texts = docs.column("text").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
    rest = docs.drop_columns(["text"]).take(pa.array(order, pa.int64()))
    return rest, np.array([ids[i] for i in order], dtype=np.int64), [texts[i] for i in order]


def _split(bucket: np.ndarray):
    """Index arrays of equal buckets."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    return [(int(bucket[part[0]]), part) for part in np.split(order, cuts) if len(part)]


def lcp_intervals(lcp: list[int], left: list[int], doc: list[int], least: int):
    """Intervals (length, first, last, left-diverse, smallest doc) of a suffix array by stack scan.

    ``lcp[i]`` belongs to suffixes i - 1 and i; ``left`` has the byte before each suffix.
    """
    stack: list[list] = []  # [length, first, left byte or None where they differ, doc]
    out = []
    for i in range(1, len(left) + 1):
        n = lcp[i] if i < len(left) else -1
        low, byte, first = doc[i - 1], left[i - 1], i - 1
        if byte == NO_BYTE:
            byte = None
        while stack and stack[-1][0] > n:
            length, lb, b, m = stack.pop()
            byte = b if b == byte else None
            low, first = min(low, m), lb
            out.append((length, lb, i - 1, byte is None, low))
        if n >= least:
            if stack and stack[-1][0] == n:
                top = stack[-1]
                top[2] = top[2] if top[2] == byte else None
                top[3] = min(top[3], low)
            else:
                stack.append([n, first, byte, low])
        elif stack:
            raise AssertionError("intervals below the least length stay on no stack")
    return out


def maximal_repeats(contexts: list[bytes], docs: np.ndarray, window: int):
    """Maximal repeat groups among distinct contexts: arrays (context, offset, length, smallest doc), a row per occurrence.

    ``docs`` has each context's smallest document. A context that no other shares a
    window with, but which several documents may hold, is a group of its own.
    """
    lens = np.array([len(c) for c in contexts], dtype=np.int64)
    width = int(lens.max())
    stride = 2 * width
    flat = np.zeros(len(contexts) * stride, dtype=np.uint8)
    begin = np.arange(len(contexts)) * stride
    joined = np.frombuffer(b"".join(contexts), np.uint8)
    shift = np.repeat(begin - np.concatenate(([0], np.cumsum(lens)[:-1])), lens)
    flat[np.arange(len(joined)) + shift] = joined
    # Suffixes of at least a window, as rows padded with zeros (lengths tell pads from bytes).
    count = lens - window + 1
    ctx = np.repeat(np.arange(len(contexts)), count)
    off = np.arange(count.sum()) - np.repeat(np.concatenate(([0], np.cumsum(count)[:-1])), count)
    rows = np.lib.stride_tricks.sliding_window_view(flat, width)[begin[ctx] + off]
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{width}").ravel(), kind="stable")
    rows, ctx, off = rows[order], ctx[order], off[order]
    size = lens[ctx] - off
    differ = rows[1:] != rows[:-1]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    lcp = np.concatenate(([0], np.minimum(lcp, np.minimum(size[1:], size[:-1]))))
    left = np.where(off > 0, flat[np.maximum(begin[ctx] + off - 1, 0)].astype(np.int64), NO_BYTE)
    low = docs[ctx]
    # Runs of neighbours that share a window are the roots of the tree; lone suffixes repeat nowhere else.
    starts = np.flatnonzero(lcp < window)
    ends = np.concatenate((starts[1:], [len(lcp)]))
    many = ends - starts > 1
    found = []
    for s, e in zip(starts[many].tolist(), ends[many].tolist()):
        found.extend((n, s + a, s + b, m) for n, a, b, diverse, m in lcp_intervals(
            [0, *lcp[s + 1:e].tolist()], left[s:e].tolist(), low[s:e].tolist(), window) if diverse)
    # A lone suffix at its context's beginning, held by several documents: the context repeats as a whole.
    alone = starts[~many & (off[starts] == 0)]
    c, o, n, m = [ctx[alone]], [off[alone]], [lens[ctx[alone]]], [low[alone]]
    if found:
        length, a, b, smallest = (np.array(x, dtype=np.int64) for x in zip(*found))
        reps = b - a + 1
        at = np.repeat(a - np.concatenate(([0], np.cumsum(reps)[:-1])), reps) + np.arange(reps.sum())
        c.append(ctx[at]), o.append(off[at]), n.append(np.repeat(length, reps)), m.append(np.repeat(smallest, reps))
        # Suffixes that begin a context and end it too: equal windows of many documents inside one context.
        whole = np.flatnonzero(off == 0)
        c.append(ctx[whole]), o.append(off[whole]), n.append(lens[ctx[whole]]), m.append(low[whole])
    return tuple(np.concatenate(x) for x in (c, o, n, m))


class Chunk:
    """A chunk's anchors and contexts; the same whenever it is made from the same rows."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], told: np.ndarray, hot: np.ndarray, window: int, gram: int):
        h, d, lo, hi = anchors(texts, window, gram)
        distinct, count = _docs_of(h, d) if len(h) else (h, h)
        known = np.union1d(distinct[count > 1], told)
        alive = np.isin(h, known) if len(known) else np.zeros(len(h), bool)
        h, d, lo, hi = h[alive], d[alive], lo[alive], hi[alive]
        is_hot = np.isin(h, hot) if len(hot) else np.zeros(len(h), bool)
        if is_hot.any():  # one context per window
            n = np.where(is_hot, hi - lo + 1, 1)
            at = np.repeat(np.arange(len(h)), n)
            step = (np.arange(n.sum()) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n)).astype(np.int32)
            h, d, single = h[at], d[at], is_hot[at]
            lo, hi = lo[at] + step, np.where(single, lo[at] + step, hi[at])
            is_hot = single
        number: dict[bytes, int] = {}
        ctx = np.empty(len(h), dtype=np.int32)
        for at in range(0, len(h), 20_000):
            part = slice(at, at + 20_000)
            ctx[part] = [number.setdefault(texts[t][a:b], len(number))
                         for t, a, b in zip(d[part].tolist(), lo[part].tolist(), (hi[part] + window).tolist())]
        self.texts = list(number)
        self.doc, self.lo, self.ctx = d, lo, ctx  # occurrences
        self.key = np.zeros(len(number), dtype=np.uint64)
        self.key[ctx] = h
        single = np.zeros(len(number), dtype=bool)
        single[ctx] = is_hot
        for i in np.flatnonzero(single).tolist():
            self.key[i] = int.from_bytes(hashlib.blake2b(self.texts[i], digest_size=8).digest(), "little")
        self.low = np.full(len(number), NO_ID, dtype=np.int64)
        self.high = np.full(len(number), np.iinfo(np.int64).min, dtype=np.int64)
        np.minimum.at(self.low, ctx, ids[d])
        np.maximum.at(self.high, ctx, ids[d])


def _pack(data: bytes) -> bytes:
    """Messages are compressed better than shuffle files are by default."""
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


#: A maximal repeat group's occurrence as a chunk is told it.
GROUP = np.dtype([("ctx", "<u4"), ("off", "<u2"), ("len", "<u2"), ("low", "<i8")])
TOLD = np.dtype([("chunk", "<i4"), *GROUP.descr])


def _short(h: np.ndarray) -> bytes:
    """Hashes as six bytes each. They choose what is looked at; equality is decided on the texts."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _long(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def _told(messages: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    told, hot = [], []
    for kind, data in zip(messages.column("kind").to_pylist(), messages.column("data").to_pylist()):
        if kind < 2:
            (told if kind == 0 else hot).append(_long(data))
    none = np.empty(0, np.uint64)
    return np.unique(np.concatenate([none, *told, *hot])), np.unique(np.concatenate([none, *hot]))


def suffix_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, chunk_bytes: int = CHUNK_BYTES,
                 bucket_bytes: int = BUCKET_BYTES, hot_docs: int = HOT_DOCS, carry: list[str] | None = None,
                 with_text: bool = True, whole_characters: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``.

    ``kept`` holds the remaining bytes (null unless ``with_text``), without what is left
    of cut characters if ``whole_characters``. Columns named in ``carry`` come along as
    the struct ``carried``.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("binary")))).first()[0] or 0
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = int(max(width, total // chunk_bytes + 1))
    buckets = int(max(2 * width, total // bucket_bytes + 1))
    carried = F.struct(*[F.col(c) for c in carry]).alias("carried") if carry else F.lit(None).cast("struct<x:int>").alias("carried")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"), carried)
    base = base.withColumn("chunk", F.pmod(F.xxhash64(F.coalesce("doc_id", F.crc32("text"))), F.lit(chunks)).cast("int"))
    base = base.repartition(chunks, "chunk")

    def hashes(table: pa.Table) -> pa.Table:
        _, ids, texts = _sorted_docs(table)
        h, d, _, _ = anchors(texts, window, gram)
        cols = [[], [], [], []]
        if len(h):
            distinct, count = _docs_of(h, d)
            own = table.column("chunk")[0].as_py()
            for b, at in _split((distinct % _u(buckets)).astype(np.int64)):
                for part, several in ((at[count[at] == 1], False), (at[count[at] > 1], True)):
                    if len(part):
                        counts = count[part].astype(np.uint32).tobytes() if several else b""
                        for c, v in zip(cols, (b, own, _short(distinct[part]), counts)):
                            c.append(v)
        return pa.Table.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                                     pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())],
                                    names=["bucket", "chunk", "hashes", "counts"])

    def shared(table: pa.Table) -> pa.Table:
        h, n, src, several = [], [], [], []
        for c, data, counts in zip(*[table.column(x).to_pylist() for x in ("chunk", "hashes", "counts")]):
            a = _long(data)
            h.append(a), src.append(np.full(len(a), c)), several.append(np.full(len(a), bool(counts)))
            n.append(np.frombuffer(counts, np.uint32).astype(np.int64) if counts else np.ones(len(a), np.int64))
        h, n, src, several = (np.concatenate(x) for x in (h, n, src, several))
        _, place = np.unique(h, return_inverse=True)
        docs_of = np.bincount(place, weights=n)[place]
        cols = [[], [], []]
        for kind, pick in ((0, (docs_of > 1) & ~several & (docs_of < hot_docs)), (1, docs_of >= hot_docs)):
            at = np.flatnonzero(pick)
            for c, part in _split(src[at]):
                for col, v in zip(cols, (c, kind, _short(h[at[part]]))):
                    col.append(v)
        return pa.Table.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())],
                                    names=["chunk", "kind", "data"])

    def contexts(table: pa.Table, messages: pa.Table) -> pa.Table:
        cols = [[] for _ in range(6)]
        if table.num_rows:
            _, ids, texts = _sorted_docs(table)
            c = Chunk(ids, texts, *_told(messages), window, gram)
            own = table.column("chunk")[0].as_py()
            if len(c.texts):
                for b, at in _split((c.key % _u(buckets)).astype(np.int64)):
                    at = at[np.argsort(c.key[at], kind="stable")]  # texts of one anchor are alike
                    parts = [c.texts[i] for i in at.tolist()]
                    info = np.stack([at, c.low[at], c.high[at]]).astype(np.int64)
                    row = (b, own, _pack(b"".join(parts)), _pack(np.array([len(p) for p in parts], np.uint8).tobytes()),
                           _pack(info.tobytes()), _pack(c.key[at].tobytes()))
                    for col, v in zip(cols, row):
                        col.append(v)
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.Table.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds)], names=["bucket", "chunk", "texts", "lens", "info", "keys"])

    def repeats(table: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        ctx, src, info, keys = [], [], [], []
        for c, texts, lens, raw, key in zip(*[table.column(x).to_pylist() for x in ("chunk", "texts", "lens", "info", "keys")]):
            texts, lens, raw, key = map(_unpack, (texts, lens, raw, key))
            at = 0
            for n in lens:
                ctx.append(number.setdefault(texts[at:at + n], len(number)))
                at += n
            src.append(np.full(len(lens), c))
            info.append(np.frombuffer(raw, np.int64).reshape(3, -1))
            keys.append(np.frombuffer(key, np.uint64))
        ctx, src, info, keys = np.array(ctx), np.concatenate(src), np.concatenate(info, axis=1), np.concatenate(keys)
        texts = list(number)
        low = np.full(len(texts), NO_ID, dtype=np.int64)
        np.minimum.at(low, ctx, info[1])
        key = np.zeros(len(texts), dtype=np.uint64)
        key[ctx] = keys
        # The chunks' copies of each context.
        copies = np.argsort(ctx, kind="stable")
        begin = np.searchsorted(ctx[copies], np.arange(len(texts) + 1))
        told = []
        # Windows are equal only under one anchor: a run of whole anchor groups is sorted at a time.
        order = np.argsort(key, kind="stable")
        edges = np.concatenate((np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0))), [len(order)]))
        cut = 0
        while cut < len(edges) - 1:
            end = int(np.searchsorted(edges, edges[cut] + RUN_CONTEXTS, side="right")) - 1
            end = max(end, cut + 1)
            part = order[edges[cut]:edges[end]]
            cut = end
            c, o, n, m = maximal_repeats([texts[i] for i in part.tolist()], low[part], window)
            c = part[c]
            reps = begin[c + 1] - begin[c]
            at = np.repeat(np.arange(len(c)), reps)
            member = copies[np.repeat(begin[c] - np.concatenate(([0], np.cumsum(reps)[:-1])), reps) + np.arange(reps.sum())]
            use = m[at] < info[2][member]  # of use where the group begins in a smaller document
            at, member = at[use], member[use]
            out = np.empty(len(at), dtype=TOLD)
            out["chunk"], out["ctx"], out["off"], out["len"], out["low"] = src[member], info[0][member], o[at], n[at], m[at]
            told.append(out)
        told = np.concatenate(told)
        cols = [[], [], []]
        for s, p in _split(told["chunk"]) if len(told) else []:
            data = np.empty(len(p), dtype=GROUP)
            for f in GROUP.names:
                data[f] = told[f][p]
            for col, v in zip(cols, (s, 2, _pack(data.tobytes()))):
                col.append(v)
        return pa.Table.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())],
                                    names=["chunk", "kind", "data"])

    def remove(table: pa.Table, messages: pa.Table) -> pa.Table:
        table, ids, texts = _sorted_docs(table)
        size = np.array([len(t) for t in texts], dtype=np.int64)
        begin = np.concatenate(([0], np.cumsum(size + 1)))  # a place more per text, for runs that end with it
        gone = np.zeros(begin[-1], dtype=np.int16)  # +1 where an occurrence begins, -1 after its end
        groups = [np.frombuffer(_unpack(d), GROUP) for k, d in
                  zip(messages.column("kind").to_pylist(), messages.column("data").to_pylist()) if k == 2]
        if groups:
            c = Chunk(ids, texts, *_told(messages), window, gram)
            told = np.concatenate(groups)
            told = told[np.argsort(told["ctx"], kind="stable")]
            lo, hi = np.searchsorted(told["ctx"], c.ctx, side="left"), np.searchsorted(told["ctx"], c.ctx, side="right")
            step = 1 << 16
            for s in range(0, len(c.ctx), step):
                reps = hi[s:s + step] - lo[s:s + step]
                at = np.repeat(lo[s:s + step] - np.concatenate(([0], np.cumsum(reps)[:-1])), reps) + np.arange(reps.sum())
                occ = np.repeat(np.arange(s, s + len(reps)), reps)
                use = told["low"][at] < ids[c.doc[occ]]  # the group begins in a smaller document
                at, occ = at[use], occ[use]
                first = begin[c.doc[occ]] + c.lo[occ] + told["off"][at]
                np.add.at(gone, first, 1)
                np.add.at(gone, first + told["len"][at], -1)
        removed, runs, sums, kept = [], [], [], []
        for t, a in zip(texts, begin.tolist()):
            r = np.cumsum(gone[a:a + len(t)], dtype=np.int32) > 0
            n = int(np.count_nonzero(r))
            removed.append(n)
            runs.append(int(r[0]) + int(np.count_nonzero(r[1:] & ~r[:-1])) if n else 0)
            left = np.frombuffer(t, np.uint8)[~r].tobytes() if n else t
            sums.append(hashlib.sha256(left).hexdigest())
            if whole_characters and n:
                left = left.decode("utf-8", "ignore").encode()
            kept.append(left if with_text else None)
        return pa.Table.from_arrays(
            [table.column("doc_id"), pa.array(size), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
             pa.array(sums, pa.string()), pa.array(kept, pa.binary()), table.column("carried")],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "carried"])

    def then_give_back(fn):
        def run(*tables: pa.Table) -> pa.Table:
            out = fn(*tables)
            give_back()
            return out

        return run

    f_hashes, f_shared, f_contexts, f_repeats, f_remove = map(then_give_back, (hashes, shared, contexts, repeats, remove))
    told = base.groupBy("chunk").applyInArrow(lambda t: f_hashes(t), "bucket int, chunk int, hashes binary, counts binary")
    told = told.groupBy("bucket").applyInArrow(lambda t: f_shared(t), "chunk int, kind int, data binary")
    ctx = base.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        lambda a, b: f_contexts(a, b), "bucket int, chunk int, texts binary, lens binary, info binary, keys binary")
    groups = ctx.groupBy("bucket").applyInArrow(lambda t: f_repeats(t), "chunk int, kind int, data binary")
    out = base.groupBy("chunk").cogroup(told.unionByName(groups).groupBy("chunk")).applyInArrow(
        lambda a, b: f_remove(a, b),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, carried " + base.schema["carried"].dataType.simpleString())
    return out if carry else out.drop("carried")


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``; all rows and columns stay.

    A cut inside a character drops the rest of that character. Null text stays null
    only where nothing was there to cut: it comes back empty.
    """
    others = [c for c in docs.columns if c != "text"]
    out = suffix_dedup(docs, carry=others, whole_characters=True, **options)
    return out.select(*[F.col("kept").cast("string").alias(c) if c == "text" else F.col(f"carried.`{c}`").alias(c) for c in docs.columns])
