"""Subword lattice language model: the probability of a text over all segmentations into an existing vocabulary.

A word is cut in every possible way into pieces of a public vocabulary; a piece's weight starts from the score that the
file gives it and is re-estimated once from the training texts (expected counts by forward and backward recursion in log
space). Every word of every text is scored by this lattice; a word seen in training has one edge more, whose share
(SEEN) is a small, fixed part of the model. A text's probability is the product over its words and its end, as a piece
with a word start never lies within a word.

Scale. Texts are read once: a block of some megabytes is one row with its distinct words, their training counts, its
documents and its words as codes. Distinct words of blocks are shuffled by word, read sorted, one word at a time, and
dealt back to their blocks, many more partitions than blocks, so that a task has one block or none; there the rows of a
block are read one after the other. No table of all words is ever sent to one place; a frequent word is a row a block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.llm._batches import LOWER, U64, coded, flat, mixed, pieces, stored, tabled, word_bounds

FOLDS, HELD = 7, 2
SEEN = 0.2  # share of the edge that is a whole word seen in training
_BLOCK_BYTES = 16 << 20
_LONG = 64
_BASE = U64(0x9E3779B97F4A7C15)
_BYTE = mixed(tabled(31))
_BLOCK = ("block long, words array<binary>, train array<long>, pieces array<int>, expected array<double>, doc_ids array<long>, held array<boolean>, lengths array<long>, codes binary")


def piece_weights(model_file: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece file as bytes, a word start as byte 0, and their natural log weights.

    The file's scores are the pieces' ranks, so weights follow them as one over rank (Zipf's law). Byte pieces stand
    for what no other piece covers.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    found: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i):
            continue
        name, score = model.id_to_piece(i), model.get_score(i)
        text = bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", "\0").encode()
        if model.is_byte(i):
            score = -float(model.get_piece_size())
        if b"\0" not in text[1:] and len(text):
            found[text] = max(found.get(text, -np.inf), -np.log(2.7 - score))
    found.setdefault(b"\0", -np.log(2.7 + model.get_piece_size()))
    names = sorted(found)
    weights = np.array([found[n] for n in names])
    return names, weights - np.logaddexp.reduce(weights)


def _log_sum(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    low, high = (a, b) if a < b else (b, a)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


class Lattice:
    """Marginal log probabilities of words, many at a time."""

    def __init__(self, names: list[bytes], weights: np.ndarray):
        self.longest = max(map(len, names))
        hashes = np.array([self._hash(np.frombuffer(n, np.uint8)[None, :])[0] for n in names], U64)
        order = np.argsort(hashes)
        self.hashes, self.weights, self.ids = hashes[order], weights[order], order
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(hashes >> U64(44)).astype(np.int64)] = True
        self.by_name = {n: (k, w) for k, (n, w) in enumerate(zip(names, weights.tolist()))}

    @staticmethod
    def _hash(rows: np.ndarray) -> np.ndarray:
        h = np.zeros(len(rows), U64)
        for k in range(rows.shape[1]):
            h = h * _BASE + _BYTE[rows[:, k]]
        return mixed(h)

    def edges(self, rows: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each end position, (start, which rows, which piece) of the pieces that end there."""
        n, length = rows.shape
        values = _BYTE[rows]
        out: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(length + 1)]
        for i in range(length):
            h = np.zeros(n, U64)
            for j in range(i + 1, min(length, i + self.longest) + 1):
                h = h * _BASE + values[:, j - 1]
                m = mixed(h)
                may = np.flatnonzero(self.seen[(m >> U64(44)).astype(np.int64)])
                if len(may):
                    at = np.searchsorted(self.hashes, m[may])
                    hit = self.hashes[np.minimum(at, len(self.hashes) - 1)] == m[may]
                    if hit.any():
                        out[j].append((i, may[hit], at[hit]))
        return out

    def forward(self, n: int, edges: list) -> np.ndarray:
        alpha = np.full((len(edges), n), -np.inf)
        alpha[0] = 0
        for j, ending in enumerate(edges):
            for i, rows, piece in ending:
                alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[i, rows] + self.weights[piece])
        return alpha

    def _ending(self, word: bytes, j: int) -> Iterator[tuple[int, int, float]]:
        """(start, number in names, weight) of the pieces that end at j."""
        for i in range(max(0, j - self.longest), j):
            found = self.by_name.get(word[i:j])
            if found is not None:
                yield i, *found

    def _one(self, word: bytes) -> list[float]:
        alpha = [0.0] + [-math.inf] * len(word)
        for j in range(1, len(word) + 1):
            for i, _, w in self._ending(word, j):
                alpha[j] = _log_sum(alpha[j], alpha[i] + w)
        return alpha

    def _add_uses(self, word: bytes, count: int, out: np.ndarray) -> None:
        """Adds the expected uses of each piece in one word, in memory linear in it."""
        alpha, beta = self._one(word), [-math.inf] * len(word) + [0.0]
        for j in range(len(word), 0, -1):
            for i, piece, w in self._ending(word, j):
                beta[i] = _log_sum(beta[i], beta[j] + w)
                out[piece] += math.exp(alpha[i] + w + beta[j] - alpha[-1]) * count

    def _by_length(self, words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(which words, their bytes as rows, each after a word start), for each length up to _LONG."""
        raw, at = flat(words)
        lengths = np.diff(at)
        for length in np.unique(lengths).tolist():
            if length <= _LONG:
                for which in np.array_split(w := np.flatnonzero(lengths == length), max(1, len(w) >> 15)):
                    rows = np.zeros((len(which), length + 1), np.uint8)
                    rows[:, 1:] = raw[at[which][:, None] + np.arange(length)]
                    yield which, rows

    def log_probability(self, words: pa.Array) -> np.ndarray:
        """Natural log of each word's probability over all its segmentations."""
        out = np.full(len(words), np.nan)
        for which, rows in self._by_length(words):
            out[which] = self.forward(len(which), self.edges(rows))[-1]
        for k in np.flatnonzero(np.isnan(out)).tolist():
            out[k] = self._one(b"\0" + words[k].as_py())[-1]
        return out

    def expected(self, words: pa.Array, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece (in the order of names) in words that occur counts times; words beyond _LONG are taken one by one."""
        total = np.zeros(len(self.hashes))
        for which, rows in self._by_length(words):
            edges = self.edges(rows)
            alpha = self.forward(len(which), edges)
            beta = np.full_like(alpha, -np.inf)
            beta[-1] = 0
            for j in range(len(edges) - 1, 0, -1):
                for i, r, piece in edges[j]:
                    beta[i, r] = np.logaddexp(beta[i, r], beta[j, r] + self.weights[piece])
            for j, ending in enumerate(edges):
                for i, r, piece in ending:
                    use = np.exp(alpha[i, r] + self.weights[piece] + beta[j, r] - alpha[-1, r]) * counts[which[r]]
                    total += np.bincount(piece, use, len(total))
        out = np.zeros(len(total))
        out[self.ids] = total
        raw, at = flat(words)
        for k in np.flatnonzero(np.diff(at) > _LONG).tolist():
            self._add_uses(b"\0" + raw[at[k] : at[k + 1]].tobytes(), int(counts[k]), out)
        return out


def _blocks(docs: DataFrame, names: list[bytes], weights: np.ndarray) -> DataFrame:
    """Blocks of documents (see _BLOCK) from (doc_id, held, text)."""
    shared = docs.sparkSession.sparkContext.broadcast((names, weights.tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(shared.value[0], np.array(shared.value[1]))
        number = 0
        for batch in batches:
            for part in pieces(batch, "text", _BLOCK_BYTES):
                raw, at = flat(part.column(2))
                starts, ends, first = word_bounds(raw, at)
                codes, words = coded(LOWER[raw], starts, ends)
                lengths = np.diff(first)
                held = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                train = np.bincount(codes[np.repeat(~held, lengths)], minlength=len(words))
                learnt = np.flatnonzero(train)
                expected = lattice.expected(words.take(pa.array(learnt)), train[learnt])
                used = np.flatnonzero(expected)
                one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind))
                yield pa.RecordBatch.from_arrays([
                    pa.array([(TaskContext.get().partitionId() << 32) + number]), one(words.cast(pa.binary()), pa.binary()), one(train, pa.int64()), one(used, pa.int32()), one(expected[used], pa.float64()),
                    one(part.column(0).to_pylist(), pa.int64()), one(held, pa.bool_()), one(lengths, pa.int64()), pa.array([codes.astype("<u4").tobytes()], pa.binary())],
                    ["block", "words", "train", "pieces", "expected", "doc_ids", "held", "lengths", "codes"])
                number += 1

    return docs.mapInArrow(run, _BLOCK)


def _counted(words: DataFrame, names: list[bytes], weights: np.ndarray) -> DataFrame:
    """(block, code, c, q, new) from rows (word, block, code, train) sorted by word within a partition.

    c sums train over a word's rows, q is its lattice probability (natural log), new marks one row of each word.
    """
    shared = words.sparkSession.sparkContext.broadcast((names, weights.tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(shared.value[0], np.array(shared.value[1]))
        held: list[pa.RecordBatch] = []  # rows of the last word, which may go on

        def done(rows: pa.Table) -> pa.RecordBatch:
            word = rows.column(0).combine_chunks()
            new = np.ones(len(word), bool)
            if len(word) > 1:
                new[1:] = pc.not_equal(word.slice(1), word.slice(0, len(word) - 1)).to_numpy(zero_copy_only=False)
            at, group = np.flatnonzero(new), np.cumsum(new) - 1
            c = np.add.reduceat(rows.column(3).to_numpy(), at)
            q = lattice.log_probability(word.take(pa.array(at)))
            return pa.RecordBatch.from_arrays([rows.column(1).combine_chunks(), rows.column(2).combine_chunks(), pa.array(c[group]), pa.array(q[group]), pa.array(new)], ["block", "code", "c", "q", "new"])

        for batch in batches:
            if not batch.num_rows:
                continue
            last = batch.column(0)[batch.num_rows - 1]
            if held and held[-1].column(0)[0] == last and batch.column(0)[0] == last:
                held.append(batch)
                continue
            start = pc.index(batch.column(0), last).as_py()
            if held or start:
                yield done(pa.Table.from_batches([*held, batch.slice(0, start)]))
            held = [batch.slice(start)]
        if held:
            yield done(pa.Table.from_batches(held))

    return words.mapInArrow(run, "block long, code int, c long, q double, new boolean")


def mixed_log10(q: np.ndarray, c: np.ndarray, n: int, seen: float = SEEN) -> np.ndarray:
    """log10 of (1 - seen) * exp(q) + seen * c / n: the lattice with the edge of the whole word; without training, the lattice alone."""
    if not n:
        return q / np.log(10)
    with np.errstate(divide="ignore"):
        return np.logaddexp(np.log1p(-seen) + q, np.log(seen) + np.log(c) - np.log(n)) / np.log(10)


def score_documents(documents: DataFrame, model_file: str, folds: int = FOLDS, held_fold: int = HELD, seen: float = SEEN) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of doc_id and text.

    Tokens are the words between ASCII white space, A-Z lower-cased, and one end. Rows whose crc32 of doc_id as text
    modulo folds is held_fold are not learnt from. base_score is add-one smoothing of token counts, score the lattice
    model, in which a whole word seen in training has the share `seen` (0 to below 1); both are log10 probabilities of the whole text. A null or empty text is an end alone; a null doc_id counts
    as the text ""; equal rows are scored alike; with no training rows a text has the weights of the vocabulary alone;
    an empty table gives an empty result; other columns are ignored.
    """
    spark: SparkSession = documents.sparkSession
    names, weights = piece_weights(str(Path(model_file)))
    held = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % folds == held_fold
    blocks = stored(_blocks(documents.select(F.col("doc_id").cast("long"), held.alias("held"), F.col("text").cast("string")), names, weights))

    ends = blocks.select(F.explode("held").alias("h")).agg(F.count(F.when(~F.col("h"), 1))).first()[0]
    learnt = blocks.select(F.explode(F.arrays_zip("pieces", "expected")).alias("x")).groupBy("x.pieces").agg(F.sum("x.expected").alias("n")).toArrow()  # a row a piece at most
    uses = np.zeros(len(names))
    uses[learnt.column(0).to_numpy()] = learnt.column(1).to_numpy()
    prior = 1000.0
    total = uses.sum() + ends + prior
    weights = np.log((uses + prior * np.exp(weights) * (1 - 1e-4)) / total)
    end_weight = float(np.log((ends + prior * 1e-4) / total))

    rows = blocks.select("block", F.posexplode(F.arrays_zip("words", "train")).alias("code", "x")).select(F.col("x.words").alias("word"), "block", "code", F.col("x.train").alias("train"))
    counted = stored(_counted(rows.repartition("word").sortWithinPartitions("word"), names, weights))
    sums = counted.where("new").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    n, v = sums.n + ends, sums.v + (ends > 0)

    end_base = float(np.log10((ends + 1) / (n + v + 1)))
    end_model = float(mixed_log10(np.array([end_weight]), np.array([ends]), n, seen)[0])

    def scores(head: dict, code: np.ndarray, c: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(code)
        c, q = c[order], q[order]
        base, model = np.log10((c + 1) / (n + v + 1)), mixed_log10(q, c, n, seen)
        lengths, codes = np.array(head["lengths"], np.int64), np.frombuffer(head["codes"], "<u4")
        at = np.concatenate([[0], np.cumsum(lengths)])
        summed = lambda x: np.array([x[codes[a:b]].sum() for a, b in zip(at, at[1:])])  # noqa: E731  each text on its own, so equal texts score alike
        return pa.RecordBatch.from_arrays([
            pa.array(head["doc_ids"], pa.int64()), pa.array(head["held"], pa.bool_()), pa.array(lengths + 1), pa.array((summed(c > 0) + (ends > 0)).astype(np.int64)),
            pa.array(np.full(len(lengths), n, np.int64)), pa.array(summed(base) + end_base), pa.array(summed(model) + end_model)],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, head, found = None, None, []  # a block, its documents, its words

        def done() -> Iterator[pa.RecordBatch]:
            if head is not None:
                yield scores(head, *(np.concatenate([np.zeros(0, kind), *(x[i] for x in found)]) for i, kind in enumerate((np.int64, np.int64, np.float64))))

        for batch in batches:
            block = batch.column(0).to_numpy()
            for start, end in zip(cuts := [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)], cuts[1:]):
                if end == start:
                    continue
                if block[start] != current:
                    yield from done()
                    current, head, found = block[start], None, []
                part = batch.slice(start, end - start)
                whole = part.column(1).to_numpy() < 0
                for k in np.flatnonzero(whole).tolist():
                    head = {name: part.column(name)[k].as_py() for name in ("doc_ids", "held", "lengths", "codes")}
                found.append(tuple(part.column(k).to_numpy()[~whole] for k in (1, 2, 3)))
        yield from done()

    names = ("doc_ids", "held", "lengths", "codes")
    heads = blocks.select("block", F.lit(-1).alias("code"), F.lit(0).cast("long").alias("c"), F.lit(0.0).alias("q"), *names)
    kinds = dict(heads.dtypes)
    empty = [(F.lit(b"") if name == "codes" else F.array().cast(kinds[name])).alias(name) for name in names]  # not null: Arrow writes a row of null lists in steps that grow with the batch
    rows = heads.unionByName(counted.select("block", "code", "c", "q", *empty))
    dealt = rows.repartition(max(1, 4 * blocks.count()), "block").sortWithinPartitions("block")
    return dealt.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
