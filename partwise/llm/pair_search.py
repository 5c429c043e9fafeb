"""Ranked lexical search by MaxScore whose bounds hold for pairs of terms.

Texts are read once. Each task writes its documents as shards: for every term of the queries the documents that hold it,
with counts. When the corpus's statistics are known, a second pass over the shards, which are far smaller, turns counts
into impacts and adds, for chosen pairs of terms, the list of documents that hold both and the highest sum of their two
impacts. A query cuts its terms into disjoint pairs and single terms. No document gets more from a pair than the larger of
its joint maximum and the two single ones, which is less than the sum of these, so lists can be skipped sooner: once the
bounds of what is left stay below the tenth best score, no new document is taken up, and those at hand are looked up only
while they can still be among the best.

Nothing but the best rows of each task is shuffled. Terms of queries are broadcast, some megabytes of them at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partwise.llm._batches import LOWER, coded, flat, pieces, stored, word_bounds
from partwise.llm.token_counts import slabs

BEST = 10
_APART = np.ones(256, bool)  # bytes that are in no term
_APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_SHARD, _SHARD_POSTINGS = 32 << 20, 1 << 20  # bytes of text, and postings, of one shard
_SLAB = 8 << 20  # bytes of text that are cut at once
_ITEMS, _ITEM_BYTES = 1000, 4 << 20  # of queries broadcast at a time, about
_SALTS = 64

_SHARD_SCHEMA = "n_docs long, n_terms long, docs array<long>, words array<int>, terms array<int>, counts array<int>, at array<int>, tf array<int>"
_IMPACT_SCHEMA = "docs array<long>, terms array<int>, counts array<int>, at array<int>, impacts array<int>, pairs array<int>, joint array<long>, pair_counts array<int>, pair_at array<int>"


def _terms(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """For some megabytes of a text column after the other: the row of each term, all terms as codes, and what the codes stand for."""
    raw, at = flat(column)
    for lo, hi in slabs(raw, at, _SLAB):  # a text of any length is cut at blanks, where no term runs over
        inside = np.concatenate([[0], at[(at > lo) & (at < hi)] - lo, [hi - lo]])
        part = LOWER[raw[lo:hi]]
        starts, ends, first = word_bounds(part, inside, _APART)
        codes, distinct = coded(part, starts, ends)
        yield np.searchsorted(at, lo, "right") - 1 + np.repeat(np.arange(len(inside) - 1), np.diff(first)), codes, distinct


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms array<binary>): the distinct terms of each item; texts of one item_id are taken together."""
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, codes, distinct in _terms(batch.column(1)):
                pairs = np.unique(np.stack([rows, codes]), axis=1) if len(codes) else np.zeros((2, 0), np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(pairs[0])), distinct.take(pa.array(pairs[1])).cast(pa.binary())], ["item_id", "term"])

    given = items.select(items["item_id"].cast("long"), items["text"].cast("string"))
    return given.mapInArrow(cut, "item_id long, term binary").groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def shards(documents: DataFrame, terms: list[bytes]) -> DataFrame:
    """Rows of _SHARD_SCHEMA, stored: documents as they are read, with postings of the given terms sorted by term and document."""
    shared = documents.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(shared.value, pa.large_binary())
        held, size, postings = [], 0, 0
        for batch in batches:
            for part in pieces(batch, "text"):
                held.append(_postings(part, wanted))
                size, postings = size + int(flat(part.column(1))[1][-1]), postings + len(held[-1][3])
                if size >= _SHARD or postings >= _SHARD_POSTINGS:
                    yield _shard(held)
                    held, size, postings = [], 0, 0
        if held:
            yield _shard(held)

    docs = documents.select(documents["doc_id"].cast("long"), documents["text"].cast("string"))
    return stored(docs.mapInArrow(run, _SHARD_SCHEMA))


def _postings(batch: pa.RecordBatch, wanted: pa.Array) -> tuple:
    count, n, found = batch.num_rows, np.zeros(batch.num_rows, np.int64), [np.zeros(0, np.int64)]
    for rows, codes, distinct in _terms(batch.column(1)):
        n += np.bincount(rows, minlength=count)
        ids = pc.fill_null(pc.index_in(distinct, value_set=wanted), -1).to_numpy(zero_copy_only=False)[codes] if len(distinct) else codes
        found.append(ids[ids >= 0].astype(np.int64) * count + rows[ids >= 0])
    keys, tf = np.unique(np.concatenate(found), return_counts=True)
    return batch.column(0), n, keys // max(1, count), keys % max(1, count), tf


def _shard(held: list[tuple]) -> pa.RecordBatch:
    docs = pa.concat_arrays([h[0] for h in held])
    n = np.concatenate([h[1] for h in held])
    before = np.cumsum([0, *(len(h[1]) for h in held[:-1])])
    term, doc, tf = (np.concatenate(x) for x in ([h[2] for h in held], [h[3] + b for h, b in zip(held, before)], [h[4] for h in held]))
    order = np.argsort(term, kind="stable")
    term, doc, tf = term[order], doc[order], tf[order]
    has = np.zeros(len(n), bool)
    has[doc] = True  # other documents count in the statistics alone
    place = np.cumsum(has) - 1
    found, counts = np.unique(term, return_counts=True)
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [pa.array([int((n > 0).sum())]), pa.array([int(n.sum())]), _listed(docs.take(pa.array(np.flatnonzero(has)))), one(n[has].astype(np.int32), pa.int32()),
         one(found.astype(np.int32), pa.int32()), one(counts.astype(np.int32), pa.int32()), one(place[doc].astype(np.int32), pa.int32()), one(tf.astype(np.int32), pa.int32())],
        ["n_docs", "n_terms", "docs", "words", "terms", "counts", "at", "tf"])


def _listed(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def statistics(index: DataFrame, terms: int) -> tuple[int, int, list[int]]:
    """Documents with terms, all their terms, and the number of documents that hold each of the given terms."""
    total = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
    df = [0] * terms
    for r in index.select(F.inline(F.arrays_zip("terms", "counts"))).groupBy("terms").agg(F.sum("counts").alias("n")).collect():  # a row for each term of the queries
        df[r.terms] = r.n
    return total.n, total.l, df


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def paired(queries: list[list[int]], weights: list[int]) -> tuple[list[tuple[int, int]], list[list[tuple[int, int, int]]]]:
    """The distinct pairs of terms that lists are made for, and each query's units: (pair, a, b), or (-1, a, -1) for a single term.

    A query takes and pairs its terms in the order of their weights, as the sum of two high maxima is what a joint one lowers most.
    """
    pairs: dict[tuple[int, int], int] = {}
    units = []
    for terms in queries:
        order = sorted(terms, key=lambda t: (-weights[t], t))
        own = [(pairs.setdefault((a, b), len(pairs)), a, b) for a, b in zip(order[::2], order[1::2])]
        units.append(own + [(-1, order[-1], -1)] * (len(order) % 2))
    return list(pairs), units


def impacts(index: DataFrame, n: int, length: int, weights: list[int], pairs: list[tuple[int, int]]) -> DataFrame:
    """Rows of _IMPACT_SCHEMA, stored: each shard's counts as impacts, and its intersection lists with their joint maxima."""
    shared = index.sparkSession.sparkContext.broadcast((np.array(weights, np.int64), np.array(pairs, np.int64).reshape(-1, 2)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, chosen = shared.value
        for batch in batches:
            for docs, words, terms, counts, at, tf in zip(*(batch.column(i) for i in range(2, 8))):
                yield _impact_row(docs, *(x.values.to_numpy().astype(np.int64) for x in (words, terms, counts, at, tf)), n, length, w, chosen)

    return stored(index.mapInArrow(run, _IMPACT_SCHEMA))


def _impact_row(docs, words, terms, counts, at, tf, n, length, w, chosen) -> pa.RecordBatch:
    share = 10 + (90 * words * n) // max(1, length)
    s = (1_000_000_000 * tf) // (1000 * tf + 8 * share[at])
    ends = np.cumsum(counts)
    slot = np.full(len(w), -1)
    slot[terms] = np.arange(len(terms))
    kept, joint, lists = [], [], []
    both = np.flatnonzero((slot[chosen] >= 0).all(1)) if len(chosen) else []
    for p in both:
        (a, b), (x, y) = chosen[p], slot[chosen[p]]
        one, two = slice(ends[x] - counts[x], ends[x]), slice(ends[y] - counts[y], ends[y])
        in_one, in_two = _common(at[one], at[two])
        if len(in_one):
            kept.append(p)
            joint.append(int((w[a] * s[one][in_one] + w[b] * s[two][in_two]).max()))
            lists.append(at[one][in_one])
    row = lambda values, kind: pa.array([np.asarray(values)], pa.list_(kind))
    i32 = lambda values: row(np.asarray(values, np.int32), pa.int32())
    return pa.RecordBatch.from_arrays(
        [_listed(docs.values), i32(terms), i32(counts), i32(at), i32(s), i32(kept), row(np.array(joint, np.int64), pa.int64()), i32([len(x) for x in lists]), i32(np.concatenate(lists) if lists else [])],
        ["docs", "terms", "counts", "at", "impacts", "pairs", "joint", "pair_counts", "pair_at"])


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the values that two sorted lists share stand in each."""
    if len(a) > len(b):
        return _common(b, a)[::-1]
    k = np.searchsorted(b, a)
    hit = np.flatnonzero((k < len(b)) & (b[np.minimum(k, len(b) - 1)] == a)) if len(b) else np.zeros(0, np.int64)
    return hit, k[hit]


class Shard:
    """One row of impacts as arrays, ready for queries."""

    def __init__(self, row: tuple, weights: np.ndarray):
        docs, terms, counts, self.at, self.impacts, pairs, joint, pair_counts, pair_at = row
        self.weights, self.ids, self.missing = weights, pc.fill_null(docs, 0).to_numpy(), np.asarray(docs.is_null())
        self.ends = dict(zip(terms.tolist(), np.cumsum(counts).tolist()))
        self.counts = dict(zip(terms.tolist(), counts.tolist()))
        starts = np.cumsum(counts) - counts
        highest = np.maximum.reduceat(self.impacts, starts) if len(counts) else np.zeros(0, np.int64)
        self.best = dict(zip(terms.tolist(), (highest * weights[terms]).tolist()))
        self.joint = dict(zip(pairs.tolist(), joint.tolist()))
        ends = np.cumsum(pair_counts)
        self.members = {p: pair_at[e - c : e] for p, c, e in zip(pairs.tolist(), pair_counts.tolist(), ends.tolist())}

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        e = self.ends[term]
        s = slice(e - self.counts[term], e)
        return self.at[s], self.impacts[s] * self.weights[term]

    def bounds(self, query: list[tuple[int, int, int]], pair_bounds: bool = True) -> tuple[list[int], list[int]]:
        """The query's terms found here, in its order, and the most that a document gets from each term and all after it."""
        terms, rest = [], [0]
        for p, a, b in reversed(query):
            one, two = self.best.get(a), self.best.get(b)
            if two is not None:
                terms.append(b)
                rest.append(rest[-1] + two)
            if one is not None:
                terms.append(a)
                rest.append(rest[-1] + one if two is None or not pair_bounds else rest[-2] + max(self.joint.get(p, 0), one, two))
        return terms[::-1], rest[::-1]

    def scores(self, places: np.ndarray, terms: Iterable[int]) -> np.ndarray:
        out = np.zeros(len(places), np.int64)
        for t in terms:
            at, impact = self.postings(t)
            mine, theirs = _common(places, at)
            out[mine] += impact[theirs]
        return out


def _tenth(scores: np.ndarray, best: int) -> int:
    return int(np.partition(scores, len(scores) - best)[len(scores) - best]) if len(scores) >= best else 0


def best_of_shard(shard: Shard, query: list[tuple[int, int, int]], floor: int = 0, best: int = BEST, pair_bounds: bool = True) -> tuple[np.ndarray, np.ndarray, int]:
    """(places, scores, postings read): every document of a shard that is among its `best` and scores at least `floor`, all ties included."""
    terms, rest = shard.bounds(query, pair_bounds)
    acc, taken, read = np.zeros(len(shard.ids), np.int64), None, 0
    seeds = [shard.members[p] for p, _, _ in query if len(shard.members.get(p, ())) >= best] if pair_bounds and not floor else []
    if seeds:  # no score is known yet: documents that hold both of two rare terms give a first one
        first = min(seeds, key=len)[: 10 * best]
        read += len(first) * len(terms)
        floor = _tenth(shard.scores(first, terms), best)
    for i, term in enumerate(terms):
        if taken is None and rest[i] < floor:
            taken = np.flatnonzero(acc)
        if taken is None:
            at, impact = shard.postings(term)
            acc[at] += impact
            read += len(at)
            if acc[at].max() >= rest[i + 1]:
                floor = max(floor, _tenth(acc, best))
            continue
        taken = taken[acc[taken] + rest[i] >= floor]
        if not len(taken):
            break
        acc[taken] += shard.scores(taken, [term])
        read += len(taken)
        floor = max(floor, _tenth(acc[taken], best))
    taken = np.flatnonzero(acc) if taken is None else taken
    taken = taken[(acc[taken] > 0) & (acc[taken] >= max(floor, _tenth(acc[taken], best)))]
    return taken, acc[taken], read


def search(documents: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's `best` highest-scoring documents, equal scores by doc_id (null last).

    Every row is a document, repeated rows and null ids too; null and empty texts have no terms. Texts of one item_id are
    one item; an item whose terms no document holds has no rows; scores are above 0. Other columns are ignored. Items are
    taken in as many turns over the documents as keep a turn's terms to some megabytes (one, for up to 1,000 items).
    """
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0)).alias("b")).first()
    turns = max(1, -(-size.n // _ITEMS), -(-size.b // _ITEM_BYTES))
    own = lambda t: items if turns == 1 else items.where(F.pmod(F.xxhash64(F.coalesce(F.col("item_id").cast("long"), F.lit(0))), F.lit(turns)) == t)
    return reduce(DataFrame.unionByName, [_one_turn(documents, own(t), best) for t in range(turns)])


def _one_turn(documents: DataFrame, items: DataFrame, best: int) -> DataFrame:
    spark = documents.sparkSession
    rows = item_terms(items).collect()  # bounded by the turn
    terms = sorted({bytes(t) for r in rows for t in r.terms})
    number = {t: i for i, t in enumerate(terms)}
    index = shards(documents, terms)
    n, length, df = statistics(index, len(terms))
    weights = [weight(n, d) for d in df]
    pairs, units = paired([[number[bytes(t)] for t in r.terms] for r in rows], weights)
    lists = impacts(index, n, length, weights, pairs)
    shared = spark.sparkContext.broadcast(([r.item_id for r in rows], units, np.array(weights, np.int64)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, queries, w = shared.value
        found = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * len(queries)
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(batch.num_columns))):
                shard = Shard((row[0].values, *(x.values.to_numpy().astype(np.int64) for x in row[1:])), w)
                for q, query in enumerate(queries):
                    ids, missing, scores = found[q]
                    at, new, _ = best_of_shard(shard, query, int(scores[-1]) if len(scores) == best else 0, best)
                    if len(at):
                        ids, missing, scores = (np.concatenate(x) for x in ((ids, shard.ids[at]), (missing, shard.missing[at]), (scores, new)))
                        order = np.lexsort((ids, missing, -scores))[:best]
                        found[q] = ids[order], missing[order], scores[order]
        places = np.repeat(np.arange(len(queries)), [len(x[0]) for x in found])
        ids, missing, scores = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(item_ids, pa.int64()).take(pa.array(places, pa.int64())), pa.array(ids, pa.int64(), mask=missing.astype(bool)), pa.array(scores, pa.int64())], ["item_id", "doc_id", "score"])

    some = lists.mapInArrow(run, "item_id long, doc_id long, score long")
    salted = some.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)))  # a task's best first meet others' in parts
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).where(F.col("rank") <= best)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= best).select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+') AS terms FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark
), c AS (
  SELECT count(*)::BIGINT AS n, sum(len(terms))::BIGINT AS l FROM d WHERE len(terms) > 0
), p AS (
  SELECT row, doc_id, len(terms)::BIGINT AS words, unnest(terms) AS term FROM d
), f AS (
  SELECT row, doc_id, words, term, count(*)::BIGINT AS tf FROM p WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * c.n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, c GROUP BY term, c.n
), s AS (
  SELECT q.item_id, f.row, f.doc_id, sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 8 * (10 + (90 * f.words * c.n) // c.l))))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN w USING (term), c GROUP BY q.item_id, f.row, f.doc_id
), r AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM s WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
"""
