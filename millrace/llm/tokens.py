"""Encoding of texts by a byte-level BPE vocabulary given as a file of ranks.

A text is cut into words by the vocabulary's pattern. A word's pieces are held as a contiguous array of boundaries with
the rank of each adjacent pair beside it; the least rank is sought again and again, its boundary deleted, and the two
neighbouring ranks refreshed. Words of more than ``LONG_WORD`` bytes take a heap over linked pieces, which gives the
same ids in n log n steps. Words once encoded are kept per worker process, up to a bound.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

TOKENIZER_DIR = os.environ.get("MILLRACE_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE_50K = "byte_bpe_50k.tiktoken"
#: fixed value: the pattern that goes with the rank files
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_WORD, CACHED_WORDS = 256, 200_000
NONE = 1 << 60


def load_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x.strip())}


def merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word, by scans of a contiguous rank array."""
    ends = list(range(len(word) + 1))
    get = ranks.get
    near = [get(word[i : i + 2], NONE) for i in range(len(word) - 1)]
    while near:
        low = min(near)
        if low == NONE:
            break
        i = near.index(low)
        del ends[i + 1], near[i]
        if i < len(near):
            near[i] = get(word[ends[i] : ends[i + 2]], NONE)
        if i:
            near[i - 1] = get(word[ends[i - 1] : ends[i + 1]], NONE)
    return [ranks[word[a:b]] for a, b in zip(ends, ends[1:])]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids by a heap: the least rank first, of equal ones the leftmost."""
    n = len(word)
    nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
    live = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = nxt[i] if live[i] else n
        if j >= n or nxt[j] != end:
            continue  # a piece of it has been merged since
        live[j] = False
        nxt[i] = end
        if end < n:
            prev[end] = i
            if (r := ranks.get(word[i : nxt[end]])) is not None:
                heapq.heappush(heap, (r, i, nxt[end]))
        if prev[i] >= 0 and (r := ranks.get(word[prev[i] : end])) is not None:
            heapq.heappush(heap, (r, prev[i], end))
    return [ranks[word[i : nxt[i]]] for i in range(n) if live[i]]


class Encoder:
    def __init__(self, lines: bytes):
        import regex

        self.ranks = load_ranks(lines)
        self.find = regex.compile(PATTERN).findall
        self.known: dict[str, list[int]] = {}

    def word(self, w: str) -> list[int]:
        b = w.encode()
        one = self.ranks.get(b)
        ids = [one] if one is not None else (merge_short if len(b) <= LONG_WORD else merge_long)(b, self.ranks)
        if len(w) <= 64:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[w] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        get, word, add = self.known.get, self.word, out.extend
        for w in self.find(text):
            add(get(w) or word(w))
        return out


_ENCODERS: dict[int, Encoder] = {}


def _encoder(lines: bytes) -> Encoder:
    key = hash(lines)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(lines)
    return _ENCODERS[key]


def _vocabulary(df: DataFrame, path: str | None):
    # a file of fixed size, under 1 MB, read on the driver so that executors need no copy
    with open(path or f"{TOKENIZER_DIR}/{BYTE_BPE_50K}", "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode_texts(df: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, ids)`` per row of ``df`` (doc_id, text), without special tokens; their strings are ordinary text.

    Null and empty texts give an empty list; blank ones are encoded as they are. Texts of any length are encoded whole.
    A null doc_id and repeated rows are kept; an empty table gives no rows.
    """
    lines = _vocabulary(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(lines.value)
        for b in batches:
            ids = [np.array(e.encode(t), np.int32) if t else np.zeros(0, np.int32) for t in b.column(1).to_pylist()]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            flat = np.concatenate([*ids, np.zeros(0, np.int32)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "ids"])

    return df.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def count_tokens(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``df`` with its column ``text`` replaced by ``tokens``, the number of its ids (0 for null and empty)."""
    lines = _vocabulary(df, path)
    keep = [f for f in df.schema if f.name != text]
    shape = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + ["tokens bigint"])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(lines.value)
        for b in batches:
            n = pa.array([len(e.encode(t)) if t else 0 for t in b.column(at).to_pylist()], pa.int64())
            rest = [i for i in range(b.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in rest], n], [*[b.schema.names[i] for i in rest], "tokens"])

    return df.mapInArrow(run, shape)
