"""Token counts of whole texts under a byte-level BPE file of the tokenizers library, without keeping any ids.

Map-side two-tier lookup. Texts are cut into pre-tokens with array operations; the distinct pre-tokens of some megabytes
are looked up in a broadcast hash table of the corpus's frequent pre-tokens and their numbers of tokens (first tier), the
rest in the cache of the task's worker (second tier), and only what neither knows is encoded by the library. Counts are
added up by row. No pre-token leaves its task on this path, and equal pre-tokens of a slab are looked up once.

What is frequent is counted on a bounded sample of rows (TABLE_ROWS, spread over the whole table). It decides what is
found in the first tier and nothing else: any table, an empty one included, gives the same counts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partwise.llm._batches import SEPARATOR, U64, coded, flat, mixed, tabled

TABLE_ROWS, TABLE_SIZE = 20_000, 65_536
LIMIT = 512
_SLAB = 4 << 20  # bytes of text that are cut at once
_KEPT = 300_000  # pre-tokens a worker keeps; beyond that it starts anew
_SHORT = 64  # bytes of a pre-token that is worth keeping
_LETTER, _NUMBER, _OTHER, _SPACE, _UNKNOWN = range(5)


class Cutter:
    """Pre-tokens of a flat text buffer. The library itself tells, once for each character met, how it classes it."""

    def __init__(self, tokenizer_json: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        plain = json.loads(tokenizer_json)
        pre, added = plain.get("pre_tokenizer") or {}, plain.get("added_tokens") or []
        if plain["model"]["type"] != "BPE" or plain.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("a byte-level BPE file without normalizer or added prefix is asked for")
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")) or any(re.search(r"[\t-\r ]", t["content"]) for t in added):
            raise ValueError("added tokens that strip, need whole words or hold blanks are not supported")
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = special_as_text
        apart = [t["content"].encode() for t in added if not (special_as_text and t["special"])]
        self.apart = re.compile(b"|".join(map(re.escape, sorted(apart, key=len, reverse=True)))) if apart else None
        self.kinds = np.full(0x110000, _UNKNOWN, np.uint8)

    def classed(self, points: np.ndarray) -> np.ndarray:
        kinds = self.kinds[points]
        if (kinds == _UNKNOWN).any():
            new = np.unique(points[kinds == _UNKNOWN])
            self.kinds[new] = _SPACE
            for kind, beside in ((_LETTER, "a"), (_NUMBER, "1"), (_OTHER, "!")):  # a character of the same class is not cut off
                probe = "".join(f"{beside}{chr(c) if not 0xD800 <= c < 0xE000 else '!'}\n" for c in new.tolist())
                begins = np.zeros(3 * len(new) + 1, bool)
                begins[[a for _, (a, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)]] = True
                self.kinds[new[~begins[1::3]]] = kind
            kinds = self.kinds[points]
        return kinds

    def cut(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where pre-tokens start in a flat buffer whose rows start at `at` (the end included)."""
        place = np.flatnonzero((raw & 0xC0) != 0x80)
        if not len(place):
            return place
        points = _code_points(raw, place)
        kinds = self.classed(points)
        same_row = np.ones(len(place) + 1, bool)  # with the character before
        same_row[np.searchsorted(place, at[at <= place[-1]])] = False
        same_row[[0, -1]] = False
        begin = ~same_row[:-1]
        begin[1:] |= kinds[1:] != kinds[:-1]
        blank = kinds == _SPACE
        last = np.flatnonzero(blank[:-1] & ~blank[1:] & same_row[1:-1])  # the last of blanks that a word follows goes alone
        begin[last] = True
        begin[last[points[last] == 0x20] + 1] = False  # or, if a space, with the word
        self._contractions(points, kinds, same_row, begin)
        starts = place[begin]
        return self._undivided(raw, at, starts) if self.apart else starts

    def _contractions(self, points: np.ndarray, kinds: np.ndarray, same_row: np.ndarray, begin: np.ndarray) -> None:
        marks = np.flatnonzero((points[:-1] == 0x27) & begin[:-1] & (kinds[1:] == _LETTER) & same_row[1:-1])
        if not len(marks):
            return
        one = np.isin(points[marks + 1], [ord(c) for c in "stmd"])
        third = np.minimum(marks + 2, len(points) - 1)
        pair = np.isin(points[marks + 1] << 8 | np.minimum(points[third], 0xFF), [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")]) & (marks + 2 < len(points)) & same_row[np.minimum(marks + 2, len(points))]
        for k, length in ((marks[one], 2), (marks[pair & ~one], 3)):
            begin[k + 1] = False
            after = k + length
            begin[after[after < len(begin)]] = True

    def _undivided(self, raw: np.ndarray, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Added tokens' strings as one slice each, with what is beside them cut as if it stood alone."""
        data = raw.tobytes()
        if not self.apart.search(data):
            return starts
        found = [starts]
        edges = np.unique(np.concatenate([[0], at, [len(raw)]]))
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            spans = [m.span() for m in self.apart.finditer(data, lo, hi)]
            if spans:
                cuts = np.array([lo, *(p for span in spans for p in span), hi])
                own, apart = Cutter.__new__(Cutter), starts[(starts < lo) | (starts >= hi)]
                own.__dict__.update(self.__dict__, apart=None)
                inner = own.cut(raw[lo:hi], cuts - lo) + lo
                inside = np.searchsorted(cuts, inner, "right") % 2 == 0  # between an odd and an even cut: within such a string
                inner = inner[~inside | np.isin(inner, cuts[1:-1:2])]
                starts, found = apart, [*found, inner]
        found[0] = starts
        return np.unique(np.concatenate(found))

    def counts(self, words: list[bytes]) -> list[int]:
        """The library's number of tokens of each slice."""
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)]


def _code_points(raw: np.ndarray, place: np.ndarray) -> np.ndarray:
    first = raw[place].astype(np.int64)
    wide = np.flatnonzero(first >= 0x80)
    if len(wide):
        padded = np.concatenate([raw, np.zeros(3, np.uint8)])
        p, b = place[wide], first[wide]
        c1, c2, c3 = (padded[p + k].astype(np.int64) & 0x3F for k in (1, 2, 3))
        two, three = (b & 0x1F) << 6 | c1, (b & 0x0F) << 12 | c1 << 6 | c2
        first[wide] = np.where(b < 0xE0, two, np.where(b < 0xF0, three, np.minimum((b & 0x07) << 18 | c1 << 12 | c2 << 6 | c3, 0x10FFFF)))
    return first


def slabs(raw: np.ndarray, at: np.ndarray, most: int = _SLAB) -> Iterator[tuple[int, int]]:
    """Ranges of about `most` bytes of a flat buffer that end with a row or where ASCII blanks begin after a printed ASCII character.

    No pre-token runs over such a place and none depends on what is before it, so a text of any length is cut in bounded memory.
    """
    lo = 0
    while lo < len(raw):
        hi = min(lo + most, len(raw))
        if hi < len(raw):
            row = int(at[np.searchsorted(at, hi, "right") - 1])
            hi = row if row > lo else _blank_after(raw, at, hi)
        yield lo, hi
        lo = hi


def _blank_after(raw: np.ndarray, at: np.ndarray, place: int) -> int:
    end = int(at[np.searchsorted(at, place, "right")])
    while place < end:
        upto = min(place + 65_536, end)
        k = np.flatnonzero(SEPARATOR[raw[place:upto]] & (raw[place - 1 : upto - 1] > 0x20) & (raw[place - 1 : upto - 1] < 0x7F))
        if len(k):
            return place + int(k[0])
        place = upto
    return end


def slices(cutter: Cutter, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """(row of each pre-token, its code, the distinct pre-tokens) for each slab of a text column."""
    raw, at = flat(column)
    for lo, hi in slabs(raw, at):
        inside = at[(at > lo) & (at < hi)] - lo
        starts = cutter.cut(raw[lo:hi], np.concatenate([[0], inside, [hi - lo]]))
        codes, distinct = coded(raw[lo:hi], starts, np.append(starts[1:], hi - lo))
        yield np.searchsorted(at, starts + lo, "right") - 1, codes, distinct


_TABLE = tabled(21)


def _hashes(column: pa.Array) -> np.ndarray:
    """64 bits of each non-empty slice of a binary column, from its bytes and their places."""
    raw, at = flat(column)
    if not len(column):
        return np.zeros(0, U64)
    within = np.arange(len(raw)) - np.repeat(at[:-1], np.diff(at))
    return mixed(np.add.reduceat(mixed(_TABLE[raw] + within.astype(U64) * U64(0x9E3779B97F4A7C15)), at[:-1]) + np.diff(at).astype(U64))


class LengthTable:
    """Open addressing over flat arrays: frequent pre-tokens to their numbers of tokens, looked up many at once."""

    def __init__(self, keys: list[bytes], lengths: list[int]):
        self.keys, self.lengths = pa.array(keys, pa.large_binary()), np.array(lengths, np.int32)
        self.hashes = _hashes(self.keys)
        self.slots = np.full(1 << max(4, (2 * len(keys)).bit_length()), -1, np.int32)
        mask = len(self.slots) - 1
        for i, h in enumerate(self.hashes.tolist()):
            s = h & mask
            while self.slots[s] >= 0:
                s = (s + 1) & mask
            self.slots[s] = i

    def find(self, words: pa.Array) -> np.ndarray:
        """The number of tokens of each word, or -1 for a word that is not in the table."""
        h, out = _hashes(words), np.full(len(words), -1, np.int64)
        slot, mask, waiting = (h & U64(len(self.slots) - 1)).astype(np.int64), len(self.slots) - 1, np.arange(len(words))
        while len(waiting):
            k = self.slots[slot[waiting]]
            waiting, k = waiting[k >= 0], k[k >= 0]
            same = self.hashes[k] == h[waiting]
            out[waiting[same]] = k[same]
            waiting = waiting[~same]
            slot[waiting] = (slot[waiting] + 1) & mask
        hit = np.flatnonzero(out >= 0)
        equal = np.asarray(pc.equal(words.take(pa.array(hit)), self.keys.take(pa.array(out[hit]))), bool)
        out[hit] = np.where(equal, self.lengths[out[hit]], -1)
        return out


def frequent(documents: DataFrame, tokenizer_json: str, rows: int = TABLE_ROWS, size: int = TABLE_SIZE, special_as_text: bool = False) -> LengthTable:
    """The most frequent short pre-tokens of about `rows` rows drawn from the whole table, at most `size` of them, with their lengths.

    A task adds up its own rows first and sends on an eighth of `size` at most, its heaviest; words seen once in all are
    not frequent. What the driver gets is bounded by `size`.
    """
    shared = documents.sparkSession.sparkContext.broadcast(tokenizer_json)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, sums = Cutter(shared.value, special_as_text), {}
        for batch in batches:
            for _, codes, distinct in slices(cutter, batch.column(0)):
                for word, n in zip(distinct.to_pylist(), np.bincount(codes, minlength=len(distinct)).tolist()):
                    if len(word) < _SHORT:
                        sums[word] = sums.get(word, 0) + n
                if len(sums) > 4 * size:
                    sums = dict(sorted(sums.items(), key=lambda x: -x[1])[:size])
        best = sorted(sums.items(), key=lambda x: (-x[1], x[0]))[: -(-size // 8)]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in best], pa.binary()), pa.array([n for _, n in best], pa.int64())], ["word", "n"])

    total = documents.count()
    drawn = documents.select(documents["text"].cast("string").alias("text")).sample(min(1.0, rows / total) if total else 1.0, 7)
    sums = drawn.mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    words = [bytes(r.word) for r in sums.orderBy(F.desc("n"), "word").limit(size).collect()]
    return LengthTable(words, Cutter(tokenizer_json, special_as_text).counts(words))


class Counter:
    """Tokens of each row of a text column, by the two tiers."""

    def __init__(self, cutter: Cutter, table: LengthTable):
        self.cutter, self.table, self.known, self.encoded = cutter, table, {}, 0

    def texts(self, column: pa.Array) -> np.ndarray:
        out = np.zeros(len(column), np.int64)
        for rows, codes, distinct in slices(self.cutter, column):
            lengths = self.table.find(distinct)
            missed = np.flatnonzero(lengths < 0)
            lengths[missed] = self._missed(distinct.take(pa.array(missed)).to_pylist())
            out += np.bincount(rows, weights=lengths[codes], minlength=len(out)).astype(np.int64)
        return out

    def _missed(self, words: list[bytes]) -> list[int]:
        new = [w for w in words if w not in self.known]
        counts = dict(zip(new, self.cutter.counts(new)))
        self.encoded += len(new)
        out = [counts[w] if w in counts else self.known[w] for w in words]
        if len(self.known) + len(counts) > _KEPT:
            self.known = {}
        self.known.update((w, n) for w, n in counts.items() if len(w) < _SHORT)
        return out


def count_tokens(documents: DataFrame, path: str, limit: int = LIMIT, table_rows: int = TABLE_ROWS, special_as_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of doc_id and text; other columns are ignored.

    n_bytes: UTF-8 bytes; n_tokens: as the library gives without adding special tokens; over_limit: n_tokens > limit.
    Strings of special tokens inside texts are tokens, the library's default, or ordinary text with special_as_text.
    A null or empty text has no bytes and no tokens; repeated rows and null ids are rows of their own; an empty table
    gives an empty result. A text of any length is cut in slabs of some megabytes. The file is read on the driver alone.
    """
    content = Path(path).read_text(encoding="utf-8")
    spark = documents.sparkSession
    tier = frequent(documents, content, table_rows, special_as_text=special_as_text)
    shared, table = spark.sparkContext.broadcast(content), spark.sparkContext.broadcast(vars(tier))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = LengthTable.__new__(LengthTable)
        vars(first).update(table.value)
        counter = Counter(Cutter(shared.value, special_as_text), first)
        for batch in batches:
            n = counter.texts(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(flat(batch.column(1))[1])), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    docs = documents.select(documents["doc_id"].cast("long"), documents["text"].cast("string"))
    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
