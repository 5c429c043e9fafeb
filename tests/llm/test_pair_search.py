"""Ranked search against every score by a plain loop, and what pair bounds save."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from partwise.llm import pair_search as ps
from partwise.llm import queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, best=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n, length = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    df = {t: sum(t in b for _, b in bags) for ts in wanted.values() for t in ts}
    out = []
    for i, ts in wanted.items():
        scored = []
        for doc, bag in bags:
            m = 10 + (90 * sum(bag.values()) * n) // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in ts if bag[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(i, k + 1, None if missing else doc, -score) for k, (score, missing, doc) in enumerate(sorted(scored)[:best])]
    return sorted(out, key=str)


def words(rng, n, vocabulary=60):
    return " ".join(rng.choice(["w", "W", "é"]) + str(min(int(rng.expovariate(0.08)), vocabulary)) + rng.choice(["", ".", ",", "-x"]) for _ in range(n))


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(4)
    docs = [(i, words(rng, rng.randint(1, 60))) for i in range(400)]
    docs += [(1000 + i, docs[0][1]) for i in range(60)] + [docs[1]] * 3 + [(2000, None), (2001, ""), (2002, " \t.,"), (None, docs[2][1]), (2003, "w1 " * 200_000)]
    items = [(i, words(rng, rng.randint(1, 30))) for i in range(25)] + [(30, docs[0][1]), (31, None), (32, "unknown words"), (33, "w1"), (33, "w2"), (None, "w3 w4"), (34, docs[0][1]), (34, docs[0][1])]
    return docs, items


def rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_equals_every_score(spark, tables, monkeypatch):
    docs, items = tables
    want = brute(docs, items)
    monkeypatch.setattr(ps, "_SHARD", 1 << 12)  # many shards, so that scores of one bound the next
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score long, rank string").repartition(3)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id long")
    assert rows(ps.search(d, q)) == want
    monkeypatch.setattr(ps, "_SLAB", 100)  # texts cut in many places
    assert rows(ps.search(d, q)) == want
    monkeypatch.setattr(ps, "_ITEMS", 10)  # several turns
    assert rows(ps.search(d, q, best=3)) == brute(docs, items, 3)
    assert rows(ps.search(d.limit(0), q)) == [] and rows(ps.search(d, q.limit(0))) == []


def shards_of(spark, docs, items):
    found = ps.item_terms(items).collect()
    names = sorted({bytes(t) for r in found for t in r.terms})
    number = {t: i for i, t in enumerate(names)}
    index = ps.shards(docs, names)
    n, length, df = ps.statistics(index, len(names))
    weights = [ps.weight(n, x) for x in df]
    pairs, units = ps.paired([[number[bytes(t)] for t in r.terms] for r in found], weights)
    for batch in ps.impacts(index, n, length, weights, pairs).toArrow().combine_chunks().to_batches():
        for row in zip(*(batch.column(i) for i in range(batch.num_columns))):
            yield ps.Shard((row[0].values, *(x.values.to_numpy().astype(np.int64) for x in row[1:])), np.array(weights)), units, pairs


def test_pair_bounds_hold_and_save_postings(spark, sf_small):
    docs, items = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "benchmark"))
    read = Counter()
    for shard, units, pairs in shards_of(spark, docs, items):
        for query in units:
            (every, apart), (_, joint) = shard.bounds(query, False), shard.bounds(query)
            scores = shard.scores(np.arange(len(shard.ids)), every)
            for i in range(len(every) + 1):
                assert shard.scores(np.arange(len(shard.ids)), every[i:]).max(initial=0) <= joint[i] <= apart[i]
            for p, a, b in query:
                if p in shard.joint:
                    both = np.intersect1d(shard.postings(a)[0], shard.postings(b)[0])
                    assert shard.members[p].tolist() == both.tolist() and (a, b) == pairs[p]
                    assert shard.joint[p] == shard.scores(both, (a, b)).max()
            tenth = ps._tenth(scores, 10)
            for bounds in (True, False):
                at, found, n = ps.best_of_shard(shard, query, tenth, pair_bounds=bounds)
                read[bounds] += n
                assert sorted(at.tolist()) == np.flatnonzero((scores >= tenth) & (scores > 0)).tolist() and (found == scores[np.sort(at)]).all()
            read["all"] += sum(shard.counts[t] for t in every)
    assert read[True] < read[False] < read["all"]


def test_query_equals_its_sql(spark, sf_small):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    want = con.execute(queries.ORACLE_SQL["op12_pair_search"])
    names = [d[0] for d in want.description]
    assert rows(queries.op12_pair_search(spark, sf_small)) == sorted((tuple(r[names.index(c)] for c in ("item_id", "rank", "doc_id", "score")) for r in want.fetchall()), key=str)
