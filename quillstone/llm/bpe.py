"""Byte-level BPE of whole texts with a public vocabulary, in two tiers.

Texts are cut into pre-tokens by the vocabulary's pattern. Tier one resolves pre-tokens that are themselves in the vocabulary through a minimal
perfect hash (hash and displace): one slot per entry and no probing, so the whole table is a few flat arrays that executors share. An entry is
only admitted if the merges of its own bytes lead to it, which makes the shortcut exact. Tier two merges the bytes of all other pre-tokens with
a heap of candidate pairs over a linked list of parts, n log n in the length of a pre-token, so a text without any blank does no harm.

Distribution: one Arrow pass, no shuffle. The tables are broadcast; their size is that of the vocabulary file and does not grow with the data.
A worker keeps resolved pre-tokens in a memo of bounded size.

Defined results: null, empty -> ``[]``; blank text is encoded like any other; strings that look like special tokens are ordinary text; lone surrogates
cannot occur in Arrow text. Whole texts are encoded, whatever their length.
"""

from __future__ import annotations

import base64
import heapq
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary files lie on every machine; a parameter of each operator, overridden by this environment variable.
VOCABULARY = os.environ.get("QUILLSTONE_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-token pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same pattern over plain ASCII, where its classes are spelled out and the standard library's faster matcher can take them.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^A-Za-z0-9 \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+(?![^ \t\n\r\x0b\x0c])|[ \t\n\r\x0b\x0c]+"
MEMO = 400_000
PIECE_CHARS = 1_000_000


class PerfectHash:
    """Minimal perfect hash over byte strings: ``n`` keys in ``n`` slots. Buckets of keys are displaced, largest first; lone keys take what is left."""

    PER_BUCKET = 3

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // self.PER_BUCKET)
        hashes = self._hash(keys)
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        sizes = np.diff(bounds)
        self.displacement = np.zeros(self.buckets, dtype=np.int64)
        taken = np.zeros(n, dtype=bool)
        slots = np.empty(n, dtype=np.int64)
        for i in np.argsort(-sizes, kind="stable"):
            if sizes[i] < 2:
                break
            members = order[bounds[i] : bounds[i + 1]]
            base, span = 0, 32
            while True:
                d = np.arange(base, base + span, dtype=np.uint64)
                at = self._place(hashes[members][None, :], d[:, None])
                ok = ~taken[at].any(axis=1)
                if sizes[i] == 2:
                    ok &= at[:, 0] != at[:, 1]
                elif ok.any():
                    s = np.sort(at, axis=1)
                    ok &= (s[:, 1:] != s[:, :-1]).all(axis=1)
                if ok.any():
                    k = int(np.argmax(ok))
                    self.displacement[i] = base + k
                    taken[at[k]] = True
                    slots[members] = at[k]
                    break
                base, span = base + span, min(2 * span, 1 << 14)
                if base > 1 << 32:
                    raise ValueError("repeated keys have no perfect hash")
        free = np.flatnonzero(~taken)
        lone = np.flatnonzero(sizes == 1)
        members = order[bounds[lone]]
        self.displacement[lone] = -1 - free[: len(lone)]  # a negative entry names the slot itself
        slots[members] = free[: len(lone)]
        self.slots = slots

    @staticmethod
    def _hash(keys: list[bytes]) -> np.ndarray:
        digest = xxhash.xxh3_64_intdigest
        return np.fromiter((digest(k) for k in keys), dtype=np.uint64, count=len(keys))

    def _place(self, hashes: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Slot of a hash under a displacement: a mixed sum, so that neither divides the number of slots."""
        x = hashes + d * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(self.n)).astype(np.int64)

    def lookup(self, keys: list[bytes]) -> np.ndarray:
        """The slot each key would have; right for keys of the set, anything else for others."""
        hashes = self._hash(keys)
        d = self.displacement[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        return np.where(d < 0, -1 - d, self._place(hashes, np.maximum(d, 0).astype(np.uint64)))


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by its merges: lowest rank first, leftmost among equals, from a heap over linked parts."""
    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that starts here
    following = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []
    get = ranks.get
    for i in range(n - 1):
        if (r := get(piece[i : i + 2])) is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    while heap:
        r, i, stop = heapq.heappop(heap)
        if not alive[i]:
            continue
        j = following[i]
        if j >= n or end[j] != stop or end[i] != j:
            continue  # one of the two has grown since
        end[i] = stop
        alive[j] = False
        k = following[i] = following[j]
        if k < n:
            before[k] = i
            if (r := get(piece[i : end[k]])) is not None:
                heapq.heappush(heap, (r, i, end[k]))
        p = before[i]
        if p >= 0 and (r := get(piece[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = following[i]
    return out


class Encoder:
    """The two tiers over one vocabulary."""

    def __init__(self, lines: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}
        whole = [t for t, i in self.ranks.items() if len(t) == 1 or merge_bytes(t, self.ranks) == [i]]
        self.table = PerfectHash(whole)
        self.keys: list[bytes] = [b""] * len(whole)
        self.ids = np.empty(len(whole), dtype=np.int32)
        for token, slot in zip(whole, self.table.slots, strict=True):
            self.keys[slot] = token
            self.ids[slot] = self.ranks[token]
        self.memo: dict[str, tuple[int, ...]] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("memo", "pattern", "ascii")} | {"memo": {}}

    def resolve(self, tokens: set[str]) -> None:
        """Put the ids of pre-tokens into the memo."""
        memo = self.memo
        new = [t for t in tokens if t not in memo]
        if not new:
            return
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = list(tokens)
        raw = [t.encode() for t in new]
        slots = self.table.lookup(raw)
        ids, keys, ranks = self.ids[slots].tolist(), self.keys, self.ranks
        for text, piece, slot, i in zip(new, raw, slots.tolist(), ids, strict=True):
            memo[text] = (i,) if keys[slot] == piece else tuple(merge_bytes(piece, ranks))

    def encode(self, text: str | None) -> array:
        """Ids of a whole text; long texts go in runs of pre-tokens so that memory stays flat."""
        out = array("i")
        if not text:
            return out
        if not hasattr(self, "pattern"):
            import regex

            self.pattern, self.ascii = regex.compile(PATTERN), re.compile(ASCII_PATTERN)
        pattern = self.ascii if text.isascii() else self.pattern
        if len(text) <= PIECE_CHARS:
            runs: Iterator[list[str]] = iter((pattern.findall(text),))
        else:
            found = (m.group() for m in pattern.finditer(text))
            runs = iter(lambda: list(islice(found, 100_000)), [])
        for tokens in runs:
            memo = self.memo
            try:
                ids = [memo[t] for t in tokens]
            except KeyError:
                self.resolve(set(tokens))
                ids = [memo[t] for t in tokens]
            out.extend(chain.from_iterable(ids))
        return out


_built: dict[str, Encoder] = {}


def encoder(path: str = VOCABULARY) -> Encoder:
    """The encoder of a vocabulary file, built once per driver."""
    if path not in _built:
        with open(path, "rb") as f:
            _built[path] = Encoder(f.read())
    return _built[path]


_sent: dict[tuple[str, str], object] = {}


def _shared(df: DataFrame, path: str):
    """The encoder on the workers, sent once per application; its size is that of the vocabulary file."""
    context = df.sparkSession.sparkContext
    at = (context.applicationId, path)
    if at not in _sent:
        _sent[at] = context.broadcast(encoder(path))
    return _sent[at]


def encode(df: DataFrame, key: str, text: str | Column, path: str = VOCABULARY) -> DataFrame:
    """(key, ids array<int>) of each row."""
    shared = _shared(df, path)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in _parts(batch):
                values, offsets = array("i"), [0]
                for t in part.column(1).to_pylist():
                    values.extend(own.encode(t))
                    offsets.append(len(values))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(values, dtype=np.int32) if len(values) else np.zeros(0, np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[key, "ids"])

    return df.select(key, (F.col(text) if isinstance(text, str) else text).cast("string").alias("__text")).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def lengths(df: DataFrame, key: str, text: str | Column, path: str = VOCABULARY) -> DataFrame:
    """(key, n_tokens int) of each row; the ids themselves never leave the worker."""
    shared = _shared(df, path)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in _parts(batch):
                n = pa.array([len(own.encode(t)) for t in part.column(1).to_pylist()], pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), n], names=[key, "n_tokens"])

    return df.select(key, (F.col(text) if isinstance(text, str) else text).cast("string").alias("__text")).mapInArrow(run, f"`{key}` {kind}, n_tokens int")


def _parts(batch: pa.RecordBatch, chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about as much text each, so that a batch of long texts is not held as ids at once."""
    sizes = np.array([0 if v is None else v for v in pc.binary_length(batch.column(1)).to_pylist()], dtype=np.int64)
    of = np.cumsum(sizes) // chars
    cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)
