"""Token ids in files of shuffled planes: a whole corpus as one ascending sequence of documents.

Format. A chunk holds whole documents, about a million ids. Its ids are cut into blocks of fixed size; a block is
transposed into byte planes (all lowest bytes, then the next ones, as 32-bit ids have them) or bit planes, planes of
zeros are left out, and each other plane is compressed with zstandard. The chunk index has, for each chunk, its shard,
its number, the ids before it in the shard, and its documents with their lengths. Chunks are rows of Parquet files, so
any store that Spark writes will do; shards are ranges of doc_id, numbered upwards, and a shard is written by one task.

Scale. Texts stay where they are read: they are encoded first, and their ids (two bytes each, where the vocabulary is
that small) are shuffled to their shard. Shards are as many as the bytes of text call for, and their bounds are
quantiles of doc_id; rows of one doc_id that fill several shards are spread over these by the hash of their text.

Tokens. The distinct words between ASCII white space of some megabytes of text are encoded once, in long texts of many
words; the tokenizer's own normalizer and pattern never join what white space separates, so a text's ids are its words'
ids. A task keeps the ids of the words it has seen, up to a fixed number (KEPT), and starts anew beyond it.
"""

from __future__ import annotations

import json
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partwise.llm._batches import LOWER, SEPARATOR, coded, flat, gathered, pieces, shared_folder

BLOCK = 1 << 16
SHARD_BYTES = 32 << 20  # of text
KEPT = 1 << 18  # words
_LOWEST = -(1 << 63)
_HEAD = "<4sBII"  # magic, planes a block at most, ids a block, ids
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
CHUNKS = "shard int, chunk int, before long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"


def pack(ids: np.ndarray, block: int = BLOCK, bits: bool = False, level: int = 3) -> bytes:
    """A chunk of 32-bit ids as compressed planes."""
    press = zstandard.ZstdCompressor(level=level)
    planes = 32 if bits else 4
    out = [struct.pack(_HEAD, b"PLN1", planes, block, len(ids))]
    for start in range(0, len(ids), block):
        rows = ids[start : start + block].astype("<u4").view(np.uint8).reshape(-1, 4)
        if bits:
            rows = np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1, bitorder="little")
        else:
            rows = np.ascontiguousarray(rows.T)
        data = [press.compress(plane.tobytes()) if plane.any() else b"" for plane in rows]
        out += [struct.pack(f"<{planes}I", *map(len, data)), *data]
    return b"".join(out)


def unpack(payload: bytes) -> np.ndarray:
    """The ids of a chunk."""
    magic, planes, block, count = struct.unpack_from(_HEAD, payload)
    if magic != b"PLN1":
        raise ValueError("not a chunk of id planes")
    expand, at, out = zstandard.ZstdDecompressor(), struct.calcsize(_HEAD), []
    for start in range(0, count, block):
        n = min(block, count - start)
        sizes = struct.unpack_from(f"<{planes}I", payload, at)
        at += 4 * planes
        rows = np.zeros((planes, n if planes == 4 else (n + 7) // 8), np.uint8)
        for k, size in enumerate(sizes):
            if size:
                rows[k] = np.frombuffer(expand.decompress(payload[at : at + size]), np.uint8)
                at += size
        if planes == 32:
            rows = np.packbits(np.unpackbits(rows, axis=1, count=n, bitorder="little").T, axis=1, bitorder="little").T
        out.append(np.ascontiguousarray(rows.T).view("<u4").ravel())
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


class WordEncoder:
    """Ids of whole texts by a tokenizer whose words are independent of each other.

    Words are encoded many in one text, without offsets. Where the tokenizer marks the last token of each match of its
    pattern by a suffix, a word has as many marked tokens as its normal form has matches, which tells words apart; a
    text whose marks do not add up, and words that hold a special token's name, are encoded word by word.
    """

    def __init__(self, tokenizer_json: str, special_as_text: bool = True):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = special_as_text
        model = json.loads(tokenizer_json)
        self.special = [] if special_as_text else [t["content"] for t in model.get("added_tokens", [])]
        names = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if max(names.values()) < 1 << 16 else "<u4")
        suffix = model["model"].get("end_of_word_suffix")
        cuts = [x["pattern"]["Regex"] for x in (model.get("pre_tokenizer") or {}).get("pretokenizers", []) if x["type"] == "Split"]
        normal = model.get("normalizer") or {}
        self.lowers = "Lowercase" in [x["type"] for x in [normal, *normal.get("normalizers", [])]]
        self.after_letter = np.zeros(256, bool)  # what the pattern always parts from a letter before it
        self.marked = None
        self.kept = (pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(0, self.dtype))  # words, their numbers of ids, and their ids
        if suffix and len(cuts) == 1:
            self.marked = np.zeros(max(names.values()) + 1, bool)
            self.marked[[i for name, i in names.items() if name.endswith(suffix)]] = True
            self.parts = regex.compile(f" |{cuts[0]}").findall
            self.after_letter[[b for b in _MARKS if all(self.parts(f"{a}{chr(b)}{c}")[:1] == [a] for a in "azAZ" for c in ("", *"azs'0", chr(b)))]] = True

    def _singly(self, words: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _group(self, words: list[str], joined: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many of the joined text's ids each word has, and all ids."""
        low = joined.lower() if joined.isascii() else unicodedata.normalize("NFC", joined).lower()
        blank = np.flatnonzero(np.array([m == " " for m in self.parts(low)] + [True]))
        marks = np.flatnonzero(self.marked[ids])
        per_word = np.diff(blank, prepend=-1) - 1
        if len(blank) != len(words) or per_word.sum() != len(marks) or (len(ids) and (not len(marks) or marks[-1] != len(ids) - 1)):
            lists = self._singly(words)
            return np.array([len(x) for x in lists], np.int64), np.concatenate(lists)
        ends = np.concatenate([[0], marks + 1])[np.cumsum(per_word)]
        return np.diff(ends, prepend=0), ids

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids of all words one after the other."""
        if self.marked is None:
            lists = self._singly(words)
            return np.array([len(x) for x in lists], np.int64), np.concatenate([np.zeros(0, self.dtype), *lists])
        counts, out = [np.zeros(0, np.int64)], [np.zeros(0, self.dtype)]
        for k in range(0, len(words), 4_096):
            groups = [words[i : min(i + 256, k + 4_096)] for i in range(k, min(len(words), k + 4_096), 256)]
            joined = [" ".join(g) for g in groups]
            for group, text, found in zip(groups, joined, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
                n, ids = self._group(group, text, np.array(found.ids, self.dtype))
                counts.append(n)
                out.append(ids)
        return np.concatenate(counts), np.concatenate(out)

    def _units(self, raw: np.ndarray, at: np.ndarray, cut: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of what is encoded on its own, words or (cut) what follows a letter in them, and each row's first."""
        word = ~SEPARATOR[raw]
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        breaks = np.zeros(len(raw) + 1, bool)
        breaks[at] = True
        if cut:
            breaks[1:-1] |= self.after_letter[raw[1:]] & _LETTER[raw[:-1]]
        begins |= word & breaks[:-1]
        ends |= word & breaks[1:]
        starts = np.flatnonzero(begins)
        return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at, "left")

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each row: their numbers, and all ids one after the other."""
        raw, at = flat(column)
        low = LOWER[raw]
        data = low.tobytes() if self.special else b""
        named = any(s.lower().encode() in data for s in self.special)  # a name counts as it is written, so nothing is lowered
        starts, ends, first = self._units(raw, at, not named)
        codes, distinct = coded(low if self.lowers and not named else raw, starts, ends)
        place, counts, ids = self._known(distinct, named)
        lists_at = np.concatenate([[0], np.cumsum(counts)])
        codes = place[codes]
        per_word = np.concatenate([[0], np.cumsum(counts[codes])])
        return np.diff(per_word[first]), gathered(codes, lists_at, ids)

    def _known(self, distinct: pa.Array, named: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each distinct word stands in a list of words, whose numbers of ids and ids follow; words kept are not encoded again."""
        if named:  # some hold a special token's name: those are encoded one by one, and nothing is kept
            words = [w.decode("utf-8", "replace") for w in distinct.to_pylist()]
            odd = np.array([any(s in w for s in self.special) for w in words])
            lists = self._singly([w for w, o in zip(words, odd) if o])
            counts, ids = self.encode([w for w, o in zip(words, odd) if not o])
            place = np.where(odd, len(counts) + np.cumsum(odd) - 1, np.cumsum(~odd) - 1)
            return place, np.concatenate([counts, np.array([len(x) for x in lists], np.int64)]), np.concatenate([ids, *lists])
        words, counts, ids = self.kept
        place = pc.index_in(distinct, value_set=words).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        found = distinct.take(pa.array(new))
        more, more_ids = self.encode([w.decode("utf-8", "replace") for w in found.to_pylist()])
        place[new] = len(words) + np.arange(len(new))
        both = pa.concat_arrays([words, found]), np.concatenate([counts, more]), np.concatenate([ids, more_ids])
        self.kept = both if len(both[0]) <= KEPT else (found, more, more_ids)
        return place, both[1], both[2]


def _shard_bounds(docs: DataFrame, shards: int | None) -> list[int]:
    """Upper bounds of all shards but the last, as doc_ids; a doc_id that fills several shards stands there several times."""
    if shards is None:
        bytes_ = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(1, -(-bytes_ // SHARD_BYTES))
    if shards == 1:
        return []
    at = F.percentile_approx(F.coalesce("doc_id", F.lit(_LOWEST)), [i / shards for i in range(1, shards)], max(10_000, 10 * shards))
    return docs.agg(at).first()[0] or []


def write_ids(documents: DataFrame, path: str, tokenizer_file: str, end_id: int, shards: int | None = None, chunk_ids: int = 1 << 20, bits: bool = False, special_as_text: bool = True) -> None:
    """Writes the ids of all rows of doc_id and text to path, in ascending doc_id order, end_id after each document.

    Null and empty texts give the end id alone. Rows of equal doc_id stand next to each other, by the hash of their
    text; a null doc_id counts as the smallest there is. An empty table writes an empty index. With special_as_text, a
    special token's name in a text (<|endoftext|>) is encoded like other text; without, as by the library's default, it
    is the special token's id. Shards have about SHARD_BYTES of text unless their number is given.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(Path(tokenizer_file).read_text())
    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    bounds = _shard_bounds(docs, shards)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, upper = WordEncoder(shared.value, special_as_text), np.array(bounds, np.int64)
        for batch in batches:
            for part in pieces(batch, "text", 2 << 20):
                counts, ids = encoder.texts(part.column(2))
                key = part.column(0).fill_null(_LOWEST).to_numpy()
                low, high = np.searchsorted(upper, key, "left"), np.searchsorted(upper, key, "right")
                share = part.column(1).to_numpy().astype(np.float64) / 2.0**64 + 0.5
                shard = low + np.minimum((share * np.maximum(high - low, 1)).astype(np.int64), np.maximum(high - low, 1) - 1)
                at = np.concatenate([[0], np.cumsum(counts)]) * encoder.dtype.itemsize
                packed = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids))])
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), part.column(0), part.column(1), pa.array(np.full(len(part), encoder.dtype.itemsize), pa.int32()), packed], ["shard", "doc_id", "h", "width", "ids"])
                pa.default_memory_pool().release_unused()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk, before = -1, 0, 0
        docs, lengths, parts, held = [], [], [], 0
        end = np.array([end_id], np.uint32)

        def row() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            arrays = [pa.array([shard], pa.int32()), pa.array([chunk], pa.int32()), pa.array([before]), pa.array([len(ids)]), pa.array([docs], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())), pa.array([pack(ids, bits=bits)], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["shard", "chunk", "before", "n_ids", "doc_ids", "lengths", "payload"])

        for batch in batches:
            for own, doc, _, width, data in zip(*(c.to_pylist() for c in batch.columns)):
                if own != shard or held >= chunk_ids:
                    if docs:
                        yield row()
                    chunk, before = (chunk + 1, before + held) if own == shard else (0, 0)
                    shard, docs, lengths, parts, held = own, [], [], [], 0
                ids = np.frombuffer(data, f"<u{width}").astype(np.uint32)
                docs.append(doc)
                lengths.append(len(ids) + 1)
                parts += [ids, end]
                held += len(ids) + 1
        if docs:
            yield row()

    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(encoded, "shard int, doc_id long, h long, width int, ids binary")
    ordered = rows.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", F.coalesce("doc_id", F.lit(_LOWEST)), "h")
    ordered.mapInArrow(run, CHUNKS).write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids array<long>) of every document in the files, start counting all ids before it.

    With digest, ids_crc32 (of the ids as little-endian unsigned 32-bit integers) stands in place of ids.
    """
    chunks = spark.read.schema(CHUNKS).parquet(path)
    shards = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row a shard
    bases = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, before, docs, lengths, payload in zip(*(c.to_pylist() for c in batch.columns)):
                ids = unpack(payload)
                at = np.concatenate([[0], np.cumsum(lengths)])
                shown = pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at, at[1:])], pa.int64()) if digest else pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(docs), pa.int32()), pa.array(docs, pa.int64()), pa.array(before + at[:-1]), pa.array(lengths, pa.int64()), shown], ["shard", "doc_id", "place", "n_tokens", "shown"])

    found = chunks.select("shard", "before", "doc_ids", "lengths", "payload").mapInArrow(run, f"shard int, doc_id long, place long, n_tokens long, shown {'long' if digest else 'array<long>'}")
    name = "ids_crc32" if digest else "ids"
    return found.join(bases, "shard").select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", F.col("shown").alias(name))


def written_digests(documents: DataFrame, tokenizer_file: str, end_id: int) -> DataFrame:
    """The documents' ids by the library's defaults, written to a new place in the shared folder, and what is read back: (doc_id, start, n_tokens, ids_crc32)."""
    path = shared_folder(documents.sparkSession)
    write_ids(documents, path, tokenizer_file, end_id, special_as_text=False)
    return read_ids(documents.sparkSession, path, digest=True)
