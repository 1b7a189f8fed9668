"""Token ids of whole texts, tokenized chunk by chunk inside Spark tasks.

The tokenizer drops white space and never joins across it, so a text's ids are
the ids of its white-space-separated chunks in order. A task takes the distinct chunks of
a batch of texts and keeps the ids of words it has met in a bounded cache.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import bound_batches, small, text_or_empty

#: Words that a worker keeps; beyond that the newer half goes (results are the same).
CACHE_CHUNKS = 300_000
#: Texts whose distinct chunks are looked up together.
BATCH_TEXTS = 1000
END_ID = 1
TOKENIZER = "word_bpe_49k.json"

# Texts of these characters alone need no Unicode normalization and no Unicode tables:
# ASCII and the Latin-1 letters. Anything else goes through the tokenizer's own pipeline.
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_ODD = re.compile("[^\\x09-\\x0d\\x20-\\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]")
# Fixed value: the tokenizer's word pattern, for lower-cased text of those characters.
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s{_LETTERS}0-9]+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the rest for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class _ChunkIds(dict):
    """Ids of lower-cased chunks (uint16, little-endian), made where they are missing; words are kept."""

    def __init__(self, model):
        super().__init__()
        self._model, self._letters = model, _byte_letters()

    def __missing__(self, chunk: str) -> bytes:
        words = _WORD.findall(chunk)
        if len(words) != 1:  # not kept: words are far fewer than what they are written together with
            return b"".join(map(self.__getitem__, words))
        mapped = chunk if chunk.isascii() else chunk.encode("utf-8").decode("latin-1").translate(self._letters)
        ids = [t.id for t in self._model.tokenize(mapped)]
        self[chunk] = made = struct.pack(f"<{len(ids)}H", *ids)
        return made

    def shrink(self) -> None:
        """Keep the older half: what is frequent was met early."""
        for chunk in list(islice(reversed(self), len(self) // 2)):
            del self[chunk]


class ChunkTokenizer:
    """``ids(text_bytes)``: little-endian uint16 ids as bytes (the vocabulary has 49,408 entries).

    White space is dropped and never joined across, so chunks are encoded one by one,
    and a chunk's ids are looked up where it has been met before.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        self._chunks = _ChunkIds(self._tok.model)

    def _plain(self, text: str) -> bytes:
        if len(self._chunks) > CACHE_CHUNKS:
            self._chunks.shrink()
        return b"".join(map(self._chunks.__getitem__, text.lower().split()))

    def ids(self, text: bytes) -> bytes:
        whole = text.decode("utf-8")
        if not _ODD.search(whole) and "<|" not in whole:
            return self._plain(whole)
        # ASCII white space separates in any text: only the chunks that need it take the long way.
        out = []
        for chunk in text.split():
            c = chunk.decode("utf-8")
            if _ODD.search(c) or "<|" in c:
                out.append(np.array(self._tok.encode(c, add_special_tokens=False).ids, dtype="<u2").tobytes())
            else:
                out.append(self._plain(c))
        return b"".join(out)

    def batch(self, texts: list[bytes]) -> list[bytes]:
        """``ids`` of every text; a chunk is looked up once, however often the texts hold it."""
        out, plain, at = [b""] * len(texts), [], []
        for i, text in enumerate(texts):
            whole = text.decode("utf-8")
            if _ODD.search(whole) or "<|" in whole:
                out[i] = self.ids(text)
            else:
                plain.append(whole.lower())
                at.append(i)
        if len(self._chunks) > CACHE_CHUNKS:
            self._chunks.shrink()
        chunks = pc.ascii_split_whitespace(pa.array(plain, pa.large_string()))
        coded = chunks.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        met = pa.array(list(map(self._chunks.__getitem__, distinct)), pa.large_binary())
        ids = met.take(coded.indices)
        _, offsets, data = ids.buffers()
        begin = np.frombuffer(offsets, "<i8", len(ids) + 1)[np.asarray(chunks.offsets)].tolist() if len(ids) else [0] * (len(at) + 1)
        raw = memoryview(data) if data is not None else memoryview(b"")
        for i, lo, hi in zip(at, begin, begin[1:]):
            out[i] = bytes(raw[lo:hi])
        return out


@lru_cache(maxsize=1)
def _worker_tokenizer(path: str) -> ChunkTokenizer:
    """One per Python worker: Spark uses a worker for many tasks, so later ones begin with its chunks."""
    return ChunkTokenizer(path)


def forget() -> None:
    """Drop the worker's tokenizer and its chunks, for steps that come after the tokens are stored."""
    _worker_tokenizer.cache_clear()


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


TOKEN_COLUMNS = "doc_id long, n_tokens long, ids binary"


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id, t``: what :func:`encode` reads; null text is empty."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().cast("binary").alias("t"))


def encode(batches: Iterator[pa.RecordBatch], path: str | None = None, end_id: int = END_ID) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, text bytes) to ``doc_id, n_tokens, ids`` (uint16 little-endian, ``end_id`` last)."""
    tok = _worker_tokenizer(path or tokenizer_path())
    end = struct.pack("<H", end_id)
    for batch in small(batches, BATCH_TEXTS):
        ids = [x + end for x in tok.batch(batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
            names=["doc_id", "n_tokens", "ids"])


def tokenized(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids``."""
    return texts(docs).mapInArrow(lambda batches: encode(batches, path, end_id), TOKEN_COLUMNS)
