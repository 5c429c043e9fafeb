"""Trie of conversation prefixes, with sums over subtrees by the Euler-tour technique.

A prefix is named by the exclusive or of 120 hashed bits of each of its turns and their places, so names are running
values within a conversation and texts never leave the task that reads them. A node is a name; its parent's name is its
own without the last turn. The tour enters and leaves every node once: enter a node, its children one after the other,
leave it. This list of arcs is ranked distributedly: in each round arcs of locally highest priority (about a third) are
spliced out by one shuffle of messages to their neighbours, until few are left, and then take their places back in the
opposite order. Over arcs in the order of their places, running sums of leaves and savings give each subtree's sum as
the difference between leaving and entering its top.

No group meets in one task beyond a bound: running values are taken within chunks and then over the chunks' totals,
siblings are linked within hashed buckets and then bucket to bucket, and ids of a node's members reach its digest as
sorted runs that are read as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partwise.llm._batches import stored

FAMILY, STARTS = 5, 9
FEW = 256  # arcs that are left when splicing ends
_CHUNK = 12  # bits: turns of a conversation, arcs of the tour and chunks of these that one window holds
_SIBLINGS = 8192  # children of one node that one window holds, about
_RUN = 9  # bits of conv_id that members in one run share
_NAME = ["depth", "k1", "k2"]


def running(df: DataFrame, keys: list[str], chunk: str, order: list[str], columns: list[str], kind: str = "sum", levels: int = 1) -> DataFrame:
    """df with each column as its running value over the rows of equal keys in order of chunk and `order`.

    A window holds one chunk; totals of chunks are run over in the same way, and added where a chunk has others before it.
    """
    total, before = (F.sum, lambda a, b: a - b) if kind == "sum" else (F.bit_xor, lambda a, b: a.bitwiseXOR(b))
    joined = (lambda a, b: a + b) if kind == "sum" else (lambda a, b: a.bitwiseXOR(b))
    totals = df.groupBy(*keys, chunk).agg(*[total(c).alias(c) for c in columns])
    own = [F.col(c).alias(f"own_{c}") for c in columns]
    if levels > 1:
        after = running(totals.select("*", *own, F.shiftright(chunk, _CHUNK).alias("wide")), keys, "wide", [chunk], columns, kind, levels - 1)
    else:
        upto = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, 0)
        after = totals.select("*", *own).withColumns({c: total(c).over(upto) for c in columns})
    later = after.withColumn("first", F.min(chunk).over(Window.partitionBy(*keys))).where(F.col(chunk) > F.col("first")) if keys else after
    later = later.select(*keys, chunk, *[before(F.col(c), F.col(f"own_{c}")).alias(f"before_{c}") for c in columns])
    within = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    here = df.withColumns({c: total(c).over(within) for c in columns})
    out = here.join(later, [*keys, chunk], "left")
    return out.withColumns({c: joined(F.col(c), F.coalesce(f"before_{c}", F.lit(0).cast("long"))) for c in columns}).drop(*[f"before_{c}" for c in columns])


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, bytes), stored: the turns of every conversation from 1, texts reduced to digests.

    The order is by turn, null first, then, where turns tie, by digest. Rows of a null conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    dealt = stored(rows.repartitionByRange("conv_id", "turn", "digest").withColumn("chunk", F.spark_partition_id().cast("long")).withColumn("pos", F.lit(1).cast("long")))
    return stored(running(dealt, ["conv_id"], "chunk", ["turn", "digest"], ["pos"]).select("conv_id", "pos", "digest", "bytes"))


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, turns) of numbered turns, each conversation as it stands."""
    members = stored(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")))
    return members, turns.join(members, "conv_id").select("conv_id", "pos", "digest", "bytes", (F.col("pos") == F.col("n")).alias("last"))


def rebuilt(turns: DataFrame, family: int = FAMILY, starts: int = STARTS) -> tuple[DataFrame, DataFrame]:
    """(members: conv_id, n; turns: conv_id, pos, digest, bytes, last): each conversation c with the first h turns of c - c % family in place of its own first h.

    h is crc32 of c in decimal, modulo `starts`. A turn goes to at most `family` conversations each way.
    """
    def h(c: Column) -> Column:
        return F.crc32(c.cast("string")) % starts

    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    convs = lengths.select("conv_id", "own", h(F.col("conv_id")).alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    given = lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("based"))
    members = stored(convs.join(given, "base", "left").withColumn("start", F.least("h", F.coalesce("based", F.lit(0))))
                     .select("conv_id", "h", "start", (F.col("start") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")))
    own = turns.join(members, "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("start")).alias("pos"), "digest", "bytes", "n")
    heads = turns.where((F.col("pos") < starts) & (F.col("conv_id") % family == 0))
    sent = heads.withColumn("to", F.explode(F.array(*[F.lit(i) for i in range(1 - family, family)]))).withColumn("to", F.col("conv_id") + F.col("to"))
    sent = sent.where((F.col("to") - F.col("to") % family == F.col("conv_id")) & (F.col("pos") <= h(F.col("to")))).select(F.col("to").alias("conv_id"), "pos", "digest", "bytes")
    both = own.unionByName(sent.join(members.select("conv_id", "n"), "conv_id"))
    return members.select("conv_id", "n"), both.select("conv_id", "pos", "digest", "bytes", (F.col("pos") == F.col("n")).alias("last"))


def named(turns: DataFrame) -> DataFrame:
    """A row for each turn: conv_id, depth, the prefix's name (k1, k2), its parent's (p1, p2), bytes, last."""
    bits = F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("digest")))
    half = lambda at: F.conv(F.substring(bits, at, 15), 16, 10).cast("long")
    rows = turns.select("conv_id", F.col("pos").alias("depth"), half(1).alias("k1"), half(17).alias("k2"), half(1).alias("e1"), half(17).alias("e2"), "bytes", "last", F.shiftright(F.col("pos") - 1, _CHUNK).alias("chunk"))
    keys = running(rows, ["conv_id"], "chunk", ["depth"], ["k1", "k2"], "xor")
    return keys.select("conv_id", *_NAME, F.col("k1").bitwiseXOR(F.col("e1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("e2")).alias("p2"), "bytes", "last")


def _ends(members: DataFrame, keys: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of nodes at which conversations end: the digest of their decimal ids, ascending, comma-joined."""
    zero = [F.lit(0).cast("long").alias(c) for c in _NAME]
    ends = keys.where("last").select("conv_id", *_NAME).unionByName(members.where("n = 0").select("conv_id", *zero))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    runs = ends.groupBy(*_NAME, F.shiftright("conv_id", _RUN).alias("run")).agg(ids.alias("ids"))
    dealt = runs.repartition(*_NAME).sortWithinPartitions(*_NAME, "run").select(*_NAME, "ids")
    return dealt.mapInArrow(_digested, "depth long, k1 long, k2 long, ends_sha256 string")


def _digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, seen = None, hashlib.sha256()
    for batch in batches:
        out = []
        for *key, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if key == name:
                seen.update(b",")
            else:
                if name is not None:
                    out.append((*name, seen.hexdigest()))
                name, seen = key, hashlib.sha256()
            seen.update(ids.encode())
        yield _rows(out)
    if name is not None:
        yield _rows([(*name, seen.hexdigest())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], [*_NAME, "ends_sha256"])


def tree_nodes(members: DataFrame, keys: DataFrame) -> DataFrame:
    """(node, parent, conv_id, parent_conv_id, depth, k1, k2, n_convs, saved), stored: one row for each distinct prefix, the root included."""
    found = keys.groupBy(*_NAME).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("bytes").alias("bytes"), F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    none = F.lit(None).cast("long")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        *[F.lit(0).cast("long").alias(c) for c in _NAME], "conv_id", "n_convs", F.lit(0).cast("long").alias("bytes"), none.alias("p1"), none.alias("p2"))
    nodes = stored(found.unionByName(root).withColumn("node", F.monotonically_increasing_id()))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return stored(nodes.join(above, ["depth", "p1", "p2"], "left").select("node", "parent", "conv_id", "parent_conv_id", *_NAME, "n_convs", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")))


def tour(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(arcs: arc, pred, next; children: parent, n_children) of (node, parent). Arc 2 * node enters a node, 2 * node + 1 leaves it."""
    buckets = nodes.count() // _SIBLINGS + 1
    kids = nodes.where("parent IS NOT NULL").select("node", "parent", F.pmod(F.xxhash64("node"), F.lit(buckets)).alias("bucket"))
    beside = kids.select(F.col("node"), F.lead("node").over(Window.partitionBy("parent", "bucket").orderBy("node")).alias("to")).where("to IS NOT NULL")
    ends = kids.groupBy("parent", "bucket").agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count(F.lit(1)).alias("n"))
    chain = stored(ends.withColumn("to", F.lead("first").over(Window.partitionBy("parent").orderBy("bucket"))))
    children = stored(chain.groupBy("parent").agg(F.sum("n").alias("n_children"), F.min_by("first", "bucket").alias("first")))
    enter, leave = (lambda c: F.col(c) * 2), (lambda c: F.col(c) * 2 + 1)
    steps = (nodes.join(children.withColumnRenamed("parent", "node"), "node", "left").select(enter("node").alias("arc"), F.coalesce(enter("first"), leave("node")).alias("next"))
             .unionByName(beside.select(leave("node").alias("arc"), enter("to").alias("next")))
             .unionByName(chain.select(leave("last").alias("arc"), F.coalesce(enter("to"), leave("parent")).alias("next"))))
    both = steps.select(F.inline(F.array(F.struct("arc", "next", F.lit(None).cast("long").alias("pred")), F.struct(F.col("next").alias("arc"), F.lit(None).cast("long").alias("next"), F.col("arc").alias("pred")))))
    return both.groupBy("arc").agg(F.max("pred").alias("pred"), F.max("next").alias("next")), children.select("parent", "n_children")


def ranked(arcs: DataFrame, few: int = FEW) -> DataFrame:
    """(arc, pos) of a doubly linked list (arc, pred, next): places from 0 on.

    Round by round an arc whose hashed priority exceeds both neighbours' is spliced out; no two neighbours ever are, so
    each arc left gets one message from either side at most. The at most `few` arcs left in the end are followed by the
    driver; then each round's arcs are placed before the arc that they were followed by.
    """
    spark = arcs.sparkSession
    left, gone = stored(arcs.withColumn("far", F.when(F.col("next").isNotNull(), 1).otherwise(0).cast("long"))), []
    while left.count() > few:
        rank = lambda c: F.xxhash64(F.lit(len(gone)), c)  # noqa: E731, B023
        out = F.col("pred").isNotNull() & F.col("next").isNotNull() & (rank("arc") > rank("pred")) & (rank("arc") > rank("next"))
        marked = left.withColumn("out", F.coalesce(out, F.lit(False)))
        none = F.lit(None).cast("long")
        message = lambda to, pred, nxt, far, own: F.struct(to.alias("arc"), pred.alias("pred"), nxt.alias("next"), far.alias("far"), F.lit(own).alias("own"))
        c = F.col
        sent = marked.select(F.inline(F.when(c("out"), F.array(message(c("pred"), none, c("next"), c("far"), False), message(c("next"), c("pred"), none, F.lit(0).cast("long"), False)))
                                      .otherwise(F.array(message(c("arc"), c("pred"), c("next"), c("far"), True)))))
        new = lambda name: F.coalesce(F.max(F.when(~c("own"), c(name))), F.max(F.when(c("own"), c(name)))).alias(name)
        gone.append(marked.where("out").select("arc", "next", "far"))
        left = stored(sent.groupBy("arc").agg(new("pred"), new("next"), F.sum("far").alias("far")))
    after = {r.arc: (r.next, r.far) for r in left.collect()}
    arc, place, rows = next(iter(after.keys() - {a for a, _ in after.values()}), None), 0, []
    while arc is not None:
        rows.append((arc, place))
        arc, place = after[arc][0], place + after[arc][1]
    placed = spark.createDataFrame(rows, "arc long, pos long")
    for step in reversed(gone):  # half as many arcs again each time, so that all these tables are three times the list
        known = placed.withColumnRenamed("arc", "next")
        placed = stored(placed.unionByName(step.join(known, "next").select("arc", (F.col("pos") - F.col("far")).alias("pos"))))
    return placed


def prefix_trie(members: DataFrame, turns: DataFrame, few: int = FEW) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    members: conv_id and n (number of turns) of every conversation, turnless ones included, each once; turns: conv_id,
    pos from 1 to n, digest of role and text, bytes of the text, last (pos = n). A node is (conv_id, depth), as two nodes
    of one depth share no member. Without members there is no node, not even the root.
    """
    keys = stored(named(turns))
    nodes = tree_nodes(members, keys)
    arcs, children = tour(nodes)
    places = ranked(arcs, few).groupBy(F.shiftright("arc", 1).alias("node")).agg(F.min("pos").alias("entered"), F.max("pos").alias("left"))
    whole = nodes.join(children.withColumnRenamed("parent", "node"), "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    whole = stored(whole.withColumn("leaf", (F.col("n_children") == 0).cast("long")).join(places, "node"))
    zero = F.lit(0).cast("long")
    along = whole.select("node", F.inline(F.array(F.struct(F.col("entered").alias("pos"), "leaf", "saved"), F.struct(F.col("left").alias("pos"), zero.alias("leaf"), zero.alias("saved")))))
    sums = running(along.withColumn("chunk", F.shiftright("pos", _CHUNK)), [], "chunk", ["pos"], ["leaf", "saved"], levels=2)
    within = sums.groupBy("node").agg((F.max("leaf") - F.min("leaf")).alias("leaves_below"), (F.max("saved") - F.min("saved")).alias("saved_below"))
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.join(within, "node").join(_ends(members, keys), _NAME, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("leaves_below") + F.col("leaf")).alias("n_leaves"),
        (F.col("saved_below") + F.col("saved")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, few: int = FEW) -> DataFrame:
    """prefix_trie of the rebuilt conversations of a table with conv_id, turn, role and text; other columns are ignored.

    Null roles and texts are empty; turns that tie are ordered by a digest of role and text, so repeated rows are turns
    of their own; rows of a null conv_id are left out; an empty table gives an empty result. Lengths count UTF-8 bytes.
    """
    members, turns = rebuilt(numbered(conversations))
    return prefix_trie(members, turns, few)


SQL = r"""
WITH given AS (
  SELECT conv_id, turn, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS x, strlen(coalesce(text, '')) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL
), t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(x)) AS pos, md5(x) AS x, bytes FROM given
), c AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
             lambda a, b: list_reduce(list_prepend(xor(a, b), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]), lambda y, i: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) % 9 AS h
  FROM t GROUP BY conv_id
), r AS (
  SELECT c.conv_id, t.pos, t.x, t.bytes FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(b.n, 0)), t.x, t.bytes
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h LEFT JOIN c b ON b.conv_id = c.base
), named AS (
  SELECT conv_id, pos AS depth, md5(string_agg(x, ',') OVER (PARTITION BY conv_id ORDER BY pos)) AS k, bytes FROM r
  UNION ALL SELECT conv_id, 0, '', 0 FROM c
), p AS (
  SELECT *, lag(k) OVER (PARTITION BY conv_id ORDER BY depth) AS up, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM named
), n AS (
  SELECT k, depth, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
  FROM p GROUP BY k, depth
), w AS (
  SELECT n.*, (SELECT count(*) FROM n m WHERE m.up = n.k AND m.depth = n.depth + 1) AS n_children FROM n
), s AS (
  SELECT p.k, p.depth, count(*) FILTER (WHERE w.n_children = 0) AS n_leaves, sum(w.saved) AS saved_tokens
  FROM w JOIN p ON p.conv_id = w.conv_id AND p.depth <= w.depth GROUP BY p.k, p.depth
)
SELECT w.conv_id, w.depth::BIGINT AS depth, (SELECT m.conv_id FROM n m WHERE m.k = w.up AND m.depth = w.depth - 1) AS parent_conv_id, w.n_convs::BIGINT AS n_convs, w.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM w JOIN s ON s.k = w.k AND s.depth = w.depth
"""
