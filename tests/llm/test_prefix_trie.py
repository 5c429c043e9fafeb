"""The prefix trie against a plain walk over rebuilt conversations, and list ranking against the list itself."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from partwise.llm import prefix_trie, queries
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, n long, depth string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role, text), role or "", text or ""))
    own = {c: [(x[3], x[4]) for x in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        turns = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    totals = {}
    for node in sorted(members, key=len, reverse=True):
        leaves = sum(totals[k][0] for k in kids[node]) if kids[node] else 1
        saved = sum(totals[k][1] for k in kids[node]) + ((len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0)
        totals[node] = leaves, saved
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids[node]), *totals[node], hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, m in members.items())


def found(spark, rows, few=40):
    df = spark.createDataFrame([(*r[:4], 1, "x") for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r[c] for c in NAMES) for r in prefix_trie.conversation_trie(df, few).collect())


def random_rows(seed, convs, texts=3, most=12):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-convs, 2 * convs), convs):
        for turn in range(rng.randint(0, most)):
            rows.append((c, rng.choice([None, turn, turn, turn // 2]), rng.choice(["user", "assistant", None]), rng.choice(["", None, *"abcé"[:texts]])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_walk(spark, seed):
    rows = random_rows(seed, 60)
    assert found(spark, rows) == brute(rows)


def test_odd_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "a")]) == []
    rows = [(7, 1, "user", "a")]  # h(7) leaves no turn of its own or it, by crc32; its family's first conversation is absent
    assert found(spark, rows) == brute(rows)
    rows = [(5, None, None, None)] * 3 + [(5, 1, "user", "x" * 2_000_000), (6, 1, "user", "x"), (6, 1, "user", "x")]
    assert found(spark, rows) == brute(rows)


def test_long_and_common_conversations_are_split(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_CHUNK", 3)
    monkeypatch.setattr(prefix_trie, "_RUN", 2)
    monkeypatch.setattr(prefix_trie, "_SIBLINGS", 4)
    rows = [(5, i, "user", str(i % 3)) for i in range(300)] + [(c, i, "user", "same") for c in range(10, 60) for i in range(9)] + [(c, 0, "user", str(c)) for c in range(100, 160)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 300])
def test_list_ranking(spark, n):
    order = random.Random(n).sample(range(10**6), n)
    rows = [(a, order[i - 1] if i else None, order[i + 1] if i + 1 < n else None) for i, a in enumerate(order)]
    places = {r.arc: r.pos for r in prefix_trie.ranked(spark.createDataFrame(rows, "arc long, pred long, next long"), few=4).collect()}
    assert places == {a: i for i, a in enumerate(order)}


def test_running_values_over_chunks(spark):
    rows = [(k, i // 7, i, i * k) for k in (1, 2) for i in range(100)]
    df = spark.createDataFrame(rows, "key long, chunk long, at long, v long")
    out = {(r.key, r["at"]): r.v for r in prefix_trie.running(df, ["key"], "chunk", ["at"], ["v"]).collect()}
    assert out == {(k, i): k * i * (i + 1) // 2 for k in (1, 2) for i in range(100)}
    alone = prefix_trie.running(df.where("key = 1"), [], "chunk", ["at"], ["v"], levels=2)
    assert {r["at"]: r.v for r in alone.collect()} == {i: i * (i + 1) // 2 for i in range(100)}
    bits = prefix_trie.running(df.where("key = 1"), ["key"], "chunk", ["at"], ["v"], "xor").agg(F.max_by("v", "at").alias("v")).first().v
    want = 0
    for i in range(100):
        want ^= i
    assert bits == want


def test_query_equals_its_sql(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf_small}/conversations.parquet')")
    want = con.execute(queries.ORACLE_SQL["op11_prefix_trie"])
    names = [d[0] for d in want.description]
    df = queries.op11_prefix_trie(spark, sf_small)
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r[c] for c in NAMES) for r in df.collect()) == sorted(tuple(r[names.index(c)] for c in NAMES) for r in want.fetchall())
