"""Byte-level BPE encoding and decoding with a public rank file, as array<int> columns.

Two-tier lookup. A minimal perfect hash over the vocabulary resolves a pre-token that is a token as a whole: one hash,
one slot, one comparison of bytes. Any other pre-token is merged: its bytes are a linked list and a heap holds the
neighbours that form a token, lowest rank first, leftmost among equals. A batch encodes each distinct stretch of text
only once: texts are cut where white space begins, which no match of the pattern ever crosses from the left.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from partwise.llm._batches import SEPARATOR, coded, flat, gathered, list_column, list_values, pieces

_CACHED = 300_000  # distinct stretches, and pre-tokens, kept from batch to batch


class PerfectHash:
    """Minimal perfect hash of distinct byte strings, hash and displace: n keys, n slots, no two keys in one slot."""

    def __init__(self, keys: list[bytes]):
        self.n, self.buckets = len(keys), max(1, len(keys) // 2)
        hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        order = np.argsort(hashes % np.uint64(self.buckets), kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(hashes[order] % np.uint64(self.buckets))) + 1)
        slots, free = np.full(len(keys), -1), np.ones(len(keys), bool)
        self.shift = [0] * self.buckets
        single = []
        for group in sorted(groups, key=len, reverse=True):
            if len(group) == 1:
                single.append(int(group[0]))
                continue
            if not len(group):
                continue
            a, b = self._parts(hashes[group])
            tried = 0
            while True:
                d = np.arange(tried, tried + 64)
                at = (a[None, :] + d[:, None] * b[None, :]) % self.n
                fits = free[at].all(1)
                if len(group) > 1:
                    ordered = np.sort(at, 1)
                    fits &= (ordered[:, 1:] != ordered[:, :-1]).all(1)
                if fits.any():
                    k = int(np.argmax(fits))
                    slots[group], free[at[k]] = at[k], False
                    self.shift[int(hashes[group[0]] % np.uint64(self.buckets))] = int(d[k])
                    break
                tried += 64
        for key, slot in zip(single, np.flatnonzero(free).tolist()):  # alone in its bucket: any free slot will do
            slots[key] = slot
            self.shift[int(hashes[key] % np.uint64(self.buckets))] = -1 - slot
        self.keys, self.values = [b""] * self.n, [0] * self.n
        for i, s in enumerate(slots.tolist()):
            self.keys[s], self.values[s] = keys[i], i

    def _parts(self, h):
        return ((h >> np.uint64(8)) & np.uint64(0x3FFFFFF)).astype(np.int64), ((h >> np.uint64(34)) & np.uint64(0x3FFFFFF)).astype(np.int64) | 1

    def get(self, key: bytes) -> int:
        """The key's position in the list given, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        slot = -1 - d if d < 0 else (((h >> 8) & 0x3FFFFFF) + d * (((h >> 34) & 0x3FFFFFF) | 1)) % self.n
        return self.values[slot] if self.keys[slot] == key else -1


class Vocabulary:
    """Tokens and ranks of a rank file (lines of base64 token and rank), and the pattern that cuts pre-tokens."""

    def __init__(self, path: str, pattern: str):
        pairs = [line.split() for line in Path(path).read_bytes().splitlines() if line.strip()]
        tokens = [base64.b64decode(a) for a, _ in pairs]
        self.ids = [int(b) for _, b in pairs]
        self.tokens = dict(zip(self.ids, tokens))
        self.table = PerfectHash(tokens)
        self.pattern = pattern

    def plain(self) -> dict:
        """Everything as builtins, to be broadcast; restored() makes the vocabulary again without building the hash."""
        return {"ids": self.ids, "tokens": self.tokens, "pattern": self.pattern, "table": vars(self.table)}

    @classmethod
    def restored(cls, plain: dict) -> Vocabulary:
        self = cls.__new__(cls)
        self.table = PerfectHash.__new__(PerfectHash)
        vars(self.table).update(plain["table"])
        self.ids, self.tokens, self.pattern = plain["ids"], plain["tokens"], plain["pattern"]
        return self

    def rank(self, token: bytes) -> int:
        k = self.table.get(token)
        return self.ids[k] if k >= 0 else -1


@functools.lru_cache(4)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read on the driver, which alone needs the file; tasks get it broadcast (its size is the file's)."""
    return Vocabulary(path, pattern)


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.find = vocabulary, regex.compile(vocabulary.pattern).findall
        self.byte = [vocabulary.rank(bytes([b])) for b in range(256)]
        self.pairs: dict[int, int] = {}
        self.known: dict[bytes, list[int]] = {}
        self.words: dict[bytes, list[int]] = {}

    def joined(self, a: int, b: int) -> int:
        """The rank of two tokens as one, or -1."""
        if len(self.pairs) > 1_000_000:
            self.pairs.clear()
        r = self.pairs[a << 32 | b] = self.vocabulary.rank(self.vocabulary.tokens[a] + self.vocabulary.tokens[b])
        return r

    def merge(self, token: bytes) -> list[int]:
        ids = [self.byte[b] for b in token]
        n, known, joined = len(ids), self.pairs.get, self.joined
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks, heap = [-1] * n, []  # of each live token with the one after it
        for i in range(n - 1):
            r = known(ids[i] << 32 | ids[i + 1])
            if r is None:
                r = joined(ids[i], ids[i + 1])
            if r >= 0:
                ranks[i] = r
                heap.append(r << 32 | i)
        heapq.heapify(heap)
        while heap:
            x = heapq.heappop(heap)
            rank, i = x >> 32, x & 0xFFFFFFFF
            if ranks[i] != rank:
                continue  # one of the two has been merged since
            j = after[i]
            k = after[i] = after[j]
            ids[i], ids[j], ranks[j], r = rank, -1, -1, -1
            if k < n:
                before[k] = i
                r = known(rank << 32 | ids[k])
                if r is None:
                    r = joined(rank, ids[k])
                if r >= 0:
                    heapq.heappush(heap, r << 32 | i)
            ranks[i] = r
            h = before[i]
            if h >= 0:
                r = known(ids[h] << 32 | rank)
                if r is None:
                    r = joined(ids[h], rank)
                ranks[h] = r
                if r >= 0:
                    heapq.heappush(heap, r << 32 | h)
        return [x for x in ids if x >= 0]

    def stretch(self, text: bytes) -> list[int]:
        out: list[int] = []
        for word in self.find(text.decode("utf-8", "replace")):
            b = word.encode()
            ids = self.words.get(b)
            if ids is None:
                r = self.vocabulary.rank(b)
                ids = [r] if r >= 0 else self.merge(b)
                if len(self.words) < _CACHED and len(b) < 64:
                    self.words[b] = ids
            out += ids
        return out

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of all rows of a text column."""
        raw, at = flat(column)
        starts = _stretches(raw, at)
        ends = np.append(starts[1:], len(raw)) if len(starts) else starts
        codes, distinct = coded(raw, starts, ends)
        lists = []
        for text in distinct.to_pylist():
            ids = self.known.get(text)
            if ids is None:
                ids = self.stretch(text)
                if len(self.known) < _CACHED and len(text) < 64:
                    self.known[text] = ids
            lists.append(ids)
        lists_at = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
        ids = gathered(codes, lists_at, np.fromiter((x for ids in lists for x in ids), np.int32, int(lists_at[-1])))
        per_stretch = np.concatenate([[0], np.cumsum((lists_at[1:] - lists_at[:-1])[codes])])
        return per_stretch[np.searchsorted(starts, at, "left")], ids


_WIDE_SPACE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def _stretches(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where rows start, and where ASCII white space follows a character that is no white space at all."""
    blank = SEPARATOR[raw]
    start = np.zeros(len(raw), bool)
    start[1:] = blank[1:] & ~blank[:-1]
    if len(raw) and np.isin(raw, [0xC2, 0xE1, 0xE2, 0xE3]).any():
        data = raw.tobytes()
        for wide in _WIDE_SPACE:
            k = data.find(wide)
            while k >= 0:
                if k + len(wide) < len(raw):
                    start[k + len(wide)] = False
                k = data.find(wide, k + 1)
    begins = at[:-1]
    start[begins[begins < len(raw)]] = True
    return np.flatnonzero(start)


def encode_batches(batches: Iterable[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) batches to (doc_id, ids array<int>)."""
    encoder = Encoder(vocabulary)
    for batch in batches:
        for part in pieces(batch, "text"):
            yield pa.RecordBatch.from_arrays([part.column(0), list_column(*encoder.texts(part.column(1)))], ["doc_id", "ids"])


def decode_batches(batches: Iterable[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) batches to (doc_id, ids, decoded binary)."""
    tokens = pa.array([vocabulary.tokens.get(i, b"") for i in range(max(vocabulary.ids) + 1)], pa.binary())
    for batch in batches:
        at, ids = list_values(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _strung(at, ids, tokens)], ["doc_id", "ids", "decoded"])


def _strung(at: np.ndarray, codes: np.ndarray, strings: pa.Array) -> pa.Array:
    """For each row, the strings of its codes one after the other."""
    found = strings.cast(pa.large_binary()).take(pa.array(codes))
    _, offsets, data = found.buffers()
    ends = np.frombuffer(offsets, np.int64)[: len(codes) + 1]
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(ends[at])), data]).cast(pa.binary())


def encode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row of doc_id and text; other columns are ignored.

    Null and empty texts give an empty array; equal rows are each encoded; an empty table gives an empty result.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary(path, pattern).plain())
    docs = documents.select(documents["doc_id"].cast("long"), documents["text"].cast("string"))
    return docs.mapInArrow(lambda b: encode_batches(b, Vocabulary.restored(shared.value)), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded binary): the bytes that the ids stand for. An id that is not in the file adds nothing."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary(path, pattern).plain())
    return encoded.select("doc_id", "ids").mapInArrow(lambda b: decode_batches(b, Vocabulary.restored(shared.value)), "doc_id long, ids array<int>, decoded binary")


def round_trip_digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded and its ids decoded again, in one pass.

    Null and empty texts have no ids and the digests of empty strings.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary(path, pattern).plain())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary.restored(shared.value)
        decimals = pa.array([b"%d," % i for i in range(max(known.ids) + 1)], pa.binary())
        for batch in decode_batches(encode_batches(batches, known), known):
            at, ids = list_values(batch.column(1))
            texts = _strung(at, ids, decimals)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(at)), pa.array([hashlib.sha256(t[:-1]).hexdigest() for t in texts.to_pylist()]), pa.array([hashlib.sha256(t).hexdigest() for t in batch.column(2).to_pylist()])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = documents.select(documents["doc_id"].cast("long"), documents["text"].cast("string"))
    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
