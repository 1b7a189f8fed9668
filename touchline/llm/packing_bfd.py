"""Token-id matrices by best-fit-decreasing packing.

A document's ids are cut into pieces of at most ``seq_len``; the pieces of one
shard (a bounded run of a task's rows) are placed longest first, each into the
open sequence with the least room that still holds it. A segment tree over the
room values 0..seq_len finds that sequence in log(seq_len) steps.

Each output row is one sequence: the row of the padded id matrix, the cumulative
segment lengths, the places where positions restart at 0, and which piece of
which document each segment is. Splitting is lossless: pieces of a document
concatenated by ``start`` give its ids.

Empty or null text is the end id alone. Repeated rows and null ids are packed as
documents of their own. A very long text is one row's ids; its full pieces are
emitted at once. An empty table gives no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import small
from touchline.llm.tokens import encode, texts

SEQ_LEN = 2048
#: Pieces packed together; bounds a task's memory (about 2 bytes an id).
SHARD_PIECES = 8192
PAD_ID = 0

SCHEMA = ("sequence_id long, n_tokens int, input_ids binary, cu_seqlens array<int>, position_resets array<int>, "
          "doc_ids array<long>, starts array<long>, doc_tokens array<long>")


class RoomTree:
    """Open sequences by their remaining room; finds the least room of at least x."""

    def __init__(self, seq_len: int):
        self.size = 1 << seq_len.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, seq: int) -> None:
        self.open[room].append(seq)
        i = room + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, sequence) with the least room >= need, removed from the tree."""
        i, count = need + self.size, self.count
        while not count[i]:
            while i & 1:  # a right child: climb to an ancestor that has a right sibling
                i >>= 1
                if i <= 1:
                    return None
            i += 1
            if i & (i - 1) == 0:  # past the last leaf of this level
                return None
        while i < self.size:
            i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.size
        seq = self.open[room].pop()
        while i:
            count[i] -= 1
            i >>= 1
        return room, seq


def best_fit_decreasing(lengths: list[int], seq_len: int = SEQ_LEN) -> list[list[int]]:
    """Indexes of the pieces of each sequence, in order of placement."""
    tree, bins = RoomTree(seq_len), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        found = tree.take(n)
        if found is None:
            bins.append([i])
            room, seq = seq_len, len(bins) - 1
        else:
            room, seq = found
            bins[seq].append(i)
        if room > n:
            tree.add(room - n, seq)
    return bins


def pack_bfd(docs: DataFrame, seq_len: int = SEQ_LEN, path: str | None = None, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per sequence, see the module text. ``input_ids``: ``seq_len`` uint16, padded with 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << 32

        def emit(sequences):
            nonlocal next_id
            cols = [[] for _ in range(8)]
            for pieces in sequences:
                ids = b"".join(p[3] for p in pieces)
                cu = [0]
                for p in pieces:
                    cu.append(cu[-1] + len(p[3]) // 2)
                row = (next_id, cu[-1], ids.ljust(2 * seq_len, b"\0"), cu, cu[:-1],
                       [p[0] for p in pieces], [p[1] for p in pieces], [p[2] for p in pieces])
                next_id += 1
                for c, v in zip(cols, row):
                    c.append(v)
            types = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()),
                     pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            names = [x.split(" ")[0] for x in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        waiting: list[tuple] = []
        for batch in encode(batches, path):  # tokenized in the same task: one Python worker
            full = []
            for doc, n, ids in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                for start in range(0, n, seq_len):
                    piece = (doc, start, n, ids[2 * start:2 * (start + seq_len)])
                    (full if len(piece[3]) == 2 * seq_len else waiting).append(piece)
                if len(full) >= 512:
                    yield emit([[p] for p in full])
                    full = []
                if len(waiting) >= shard_pieces:
                    shard, waiting = waiting, []
                    yield emit([[shard[i] for i in b] for b in best_fit_decreasing([len(p[3]) // 2 for p in shard], seq_len)])
            if full:
                yield emit([[p] for p in full])
        if waiting:
            yield emit([[waiting[i] for i in b] for b in best_fit_decreasing([len(p[3]) // 2 for p in waiting], seq_len)])

    return texts(docs).mapInArrow(run, SCHEMA)


def pieces(sequences: DataFrame) -> DataFrame:
    """One row per piece of the packed sequences, with the CRC-32 of its ids as little-endian uint32."""

    def crcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            out = [[] for _ in range(7)]
            for seq, ids, cu, docs, starts, totals in zip(*[b.column(i).to_pylist() for i in range(6)]):
                for k, doc in enumerate(docs):
                    part = np.frombuffer(ids, "<u2")[cu[k]:cu[k + 1]].astype("<u4").tobytes()
                    for c, v in zip(out, (doc, starts[k], len(part) // 4, zlib.crc32(part), totals[k], seq, cu[k])):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=PIECE_COLUMNS)

    s = sequences.select("sequence_id", "input_ids", "cu_seqlens", "doc_ids", "starts", "doc_tokens")
    return s.mapInArrow(crcs, ", ".join(f"{c} long" for c in PIECE_COLUMNS))


PIECE_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def write_matrices(sequences: DataFrame, path: str) -> None:
    """Write the packed rows as Parquet: fixed-width id rows plus segment lengths and resets."""
    sequences.write.mode("errorifexists").parquet(path)


def padding_share(sequences: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    return sequences.agg((1 - F.sum("n_tokens") / (F.count("*") * seq_len)).alias("padding"))
