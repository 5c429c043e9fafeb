"""Mixing sources to target weights by hash-threshold histograms, in DataFrame functions only.

Sources share a budget of words by weight, none beyond a multiple of its own size. A source then takes each document
as often as its target holds its whole size, and once more those whose hash lies below its threshold. The threshold is
found without sorting documents: sizes are summed by source and leading hash bits, running sums over these few buckets
name the bucket in which the budget ends, and only that bucket is cut again by the next bits, down to one hash.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partwise.llm._batches import stored

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
_STEP, _BITS = 12, 60
_BROADCAST_SOURCES = 10_000


def _hash() -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _key() -> Column:
    return F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), "source"))


def sized(documents: DataFrame) -> DataFrame:
    """(doc_id, source, key, size, h): words of the whole text, and 60 bits of the md5 of doc_id as text."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return documents.select("doc_id", "source", _key().alias("key"), size.alias("size"), _hash().alias("h"))


def source_targets(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(key, source_size, target): one row per source; weights repeat over the sources in code point order, null last.

    The order of all sources is needed to weigh them, so rows of sources (not of documents) meet in one window.
    """
    sums = docs.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source from here on
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))) + 1).cast("int"))
    sums = sums.withColumn("w", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    rank = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    filled = sums.withColumn("level", (F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(rank), F.lit(0.0)))
                             / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(rank), F.lit(0.0))))
    # sources fill up in the order of cap / weight; the first level that its own source can hold is the common one, of tied sources the highest
    place = F.col("cap") / F.col("w")
    level = F.min_by("level", F.when(F.col("level") <= place, F.struct(place, -F.col("level")))).over(every)
    return filled.withColumn("common", level).select("key", "source_size", F.coalesce(F.least(F.col("cap"), F.col("common") * F.col("w")), F.col("cap")).alias("target"))


def _with(docs: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    return docs.join(F.broadcast(sources) if few else sources, "key")


def _thresholds(docs: DataFrame, weights: tuple[float, ...], share: float, most: float) -> tuple[DataFrame, bool]:
    """One row per source: key, source_size, target, times, rest, and the hash (prefix) in which the rest ends; whether rows are few."""
    sources = source_targets(docs, weights, share, most)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = stored(sources.withColumn("times", times.cast("long")).withColumn("rest", F.col("target") - F.col("times") * F.col("source_size"))
                   .withColumn("prefix", F.lit(0).cast("long")).withColumn("before", F.lit(0.0)).withColumn("own", F.lit(0.0)))
    few = state.count() <= _BROADCAST_SOURCES
    for done in range(0, _BITS, _STEP):
        inside = F.shiftright("h", _BITS - done) == F.col("prefix") if done else F.lit(True)
        hist = _with(docs, state.select("key", "prefix"), few).where(inside).groupBy("key", F.shiftright("h", _BITS - done - _STEP).alias("bucket")).agg(F.sum("size").alias("n"))
        upto = hist.withColumn("sum", F.sum("n").over(Window.partitionBy("key").orderBy("bucket")))
        near = upto.join(state.select("key", "rest", F.col("before").alias("low")), "key").where("low + sum > rest")
        first = near.groupBy("key").agg(F.min(F.struct("bucket", (F.col("low") + F.col("sum") - F.col("n")).alias("before"), F.col("n").cast("double").alias("own"))).alias("f"))
        state = stored(state.select("key", "source_size", "target", "times", "rest").join(first, "key", "left").select(
            "key", "source_size", "target", "times", "rest", F.coalesce("f.bucket", F.lit(-1)).alias("prefix"), F.coalesce("f.before", F.lit(0.0)).alias("before"), F.coalesce("f.own", F.lit(0.0)).alias("own")))
    return state, few


def _times() -> Column:
    """How often a row with h and its source's threshold is taken."""
    closer = F.col("before") + F.col("own") - F.col("rest") < F.col("rest") - F.col("before")
    return F.col("times") + ((F.col("h") < F.col("prefix")) | ((F.col("h") == F.col("prefix")) & closer)).cast("long")


def mix(documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row of doc_id, text and source.

    taken is size times 0, 1 or more whole repeats, at most `most` times. A null or empty text has size 0; a null
    source is a source; rows of equal doc_id and source are taken alike; an empty table gives an empty result. Other
    columns are ignored. Reruns agree, as hashes depend on doc_id alone.
    """
    docs = stored(sized(documents))
    state, few = _thresholds(docs, weights, share, most)
    return _with(docs, state, few).select("doc_id", "source", "size", "source_size", "target", (F.col("size") * _times()).alias("taken"))


def mixed_rows(documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The rows of documents as often as the mix takes them, with the columns of documents; texts are not shuffled.

    No row is taken more than `most` times. A row of size 0 (null, empty or blank text) is taken by its hash, too; repeated rows are taken
    alike; an empty table gives an empty result; columns may have any names.
    """
    state, few = _thresholds(stored(sized(documents)), weights, share, most)
    row = F.struct(*[F.col(c) for c in documents.columns]).alias("row")
    hashed = documents.select(row, _key().alias("key"), _hash().alias("h"))
    taken = _with(hashed, state.select("key", "times", "rest", "prefix", "before", "own"), few).withColumn("taken", F.least(_times(), F.lit(ceil(most)).cast("long"))).where("taken > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "taken"))).select("row.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
         2.0::DOUBLE * sum(size)::DOUBLE AS cap FROM d GROUP BY source
), l AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER r, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER r, 0)) AS level
  FROM s WINDOW r AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(cap, w * (SELECT max(level) FROM l l2 WHERE level <= cap / w AND cap / w = (SELECT min(cap / w) FROM l l3 WHERE l3.level <= l3.cap / l3.w))) AS target FROM l
), u AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS times FROM t
), v AS (
  SELECT d.doc_id, d.source, d.size, d.h, u.source_size, u.target, u.times, u.target - u.times * u.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h)::DOUBLE AS own
  FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source
)
SELECT doc_id, source, size, source_size, target,
       (size * (times + CASE WHEN upto <= rest OR (upto - own <= rest AND upto - rest < rest - (upto - own)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM v
"""
