"""Folds and markup on one part, or one text, of very many rows or tags: the time they take grows with these alone."""

import random
import time

import pytest
from partwise.functions import columns
from partwise.operators import cues as cu
from partwise.operators import folds
from partwise.operators import intervals as iv
from partwise.sources import subtitles as sub
from pyspark.sql import functions as F

N = 100_000
LIMIT = 40  # seconds; a tenth of them on an idle machine


@pytest.fixture
def clock():
    began = time.time()
    yield
    assert time.time() - began < LIMIT


def test_gate_of_one_part(spark, clock):
    rows = spark.range(N).select(F.lit(1).cast("long").alias("part_id"), F.col("id").alias("pos"), F.col("id").alias("ordinal"), (F.col("id") * 1000).alias("start_t"), (F.col("id") * 1000 + F.when(F.col("id") % 3 == 1, 1500).otherwise(900)).alias("end_t"),
                                 F.lit(10).cast("long").alias("visible"), F.lit(0).cast("long").alias("c_start"), F.lit(10**12).alias("c_end"))
    found = {r.reason: r["count"] for r in folds.gate_cues(rows).groupBy("reason").count().collect()}
    third = len(range(2, N, 3))
    assert found == {None: N - third, "processing_duplication": third}


def test_utf16_of_one_payload(spark, clock):
    text = F.repeat(F.concat(F.lit("aé😀"), F.col("id").cast("string")), 30 * N)
    rows = spark.range(1, 3).select("id", F.encode(text, "UTF-16BE").alias("whole"), F.lit("utf-16be").alias("d"))
    rows = rows.select("id", "d", F.when(F.col("id") == 1, F.col("whole")).otherwise(F.concat("whole", F.unhex(F.lit("D83D")))).alias("content"))
    found = {r.id: (r.state, r.n) for r in sub.decoded(rows, "d").select("id", "state", F.length("text").alias("n")).collect()}
    assert found == {1: ("decoded", 4 * 30 * N), 2: ("encoding_ambiguous", None)}


def test_chapters_of_one_part(spark, clock):
    rows = spark.range(N).select(F.lit(1).cast("long").alias("part_id"), F.col("id").alias("pos"), F.lit(True).alias("own_part"), (F.col("id") * 7919 % N * 2).alias("start_ordinal"), (F.col("id") * 7919 % N * 2 + 1 + F.col("id") % 2).alias("end_ordinal"), F.lit(4 * N).alias("last"))
    found = folds.first_wins(rows)
    assert found.where("reason is null").agg(F.max("number") + 1, F.count("number")).first()[:] == (found.where("reason is null").count(),) * 2


def test_chapters_are_those_of_a_plain_loop(spark):
    rng = random.Random(9)
    rows = [(p, i, rng.random() < 0.9, (a := rng.randint(-1, 60)), a + rng.randint(-1, 6), 60) for p in range(4) for i in range(60)]
    want = {}
    for p in range(4):
        taken = []
        for _, i, own, a, b, last in (r for r in rows if r[0] == p):
            reason = "foreign_part" if not own else "inverted" if a > b else "unknown_ordinal" if a < 0 or b > last else "overlap" if any(a <= y and x <= b for x, y in taken) else None
            taken += [(a, b)] if reason is None else []
            want[p, i] = reason
    df = spark.createDataFrame(rows, "part_id long, pos long, own_part boolean, start_ordinal long, end_ordinal long, last long").repartition(5)
    assert {(r.part_id, r.pos): r.reason for r in folds.first_wins(df).collect()} == want


def test_chunks_of_one_part(spark, clock):
    rows = spark.range(N).select(F.lit(1).cast("long").alias("part_id"), (F.col("id") * 10).alias("start_t"), (F.col("id") * 10 + F.when(F.col("id") % 4 == 0, 10).otherwise(7)).alias("end_t"))
    found = folds.pack_chunks(rows, 100).collect()
    assert max(r.end_t - r.start_t for r in found) <= 100 and sum(r.runs for r in found) == N - N // 4 and len(found) == max(r.chunk for r in found) + 1


def test_tags_of_one_text(spark, clock):
    text = "<b>" * 30_000 + "x <b c> y" + "</b>" * 30_000 + "<i>z</i> " * 30_000
    r = cu.strip_markup(spark.createDataFrame([(1, text)], "k int, t string"), "t").first()
    assert len(r.corrections) == 120_000 and r.stripped == "x <b c> y" + "z " * 30_000 and [tuple(d) for d in r.diagnostics] == [(90_002, 90_007, "<b c>")]


def test_blanks_begin_attributes(spark):
    cases = {
        "<b >x</b >": "<b >x</b >", "<b>x</b >y</b>": "x</b >y", "<font >x</font>": "x", "<font >x</font >": "<font >x</font >", "<font\tcolor=red>x</FONT>": "x", "<font\ncolor=red>x</font>": "<font\ncolor=red>x</font>",
        "<b\n>x</b>": "<b\n>x</b>", "<B>x</b>": "x", "<i><b >x</i>": "<b >x", "</b><b>x</b>": "</b>x", "<fontx>y</fontx>": "<fontx>y</fontx>",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    found = {r.t: r for r in cu.strip_markup(df, "t").collect()}
    assert {k: r.stripped for k, r in found.items()} == cases
    told = cu.markup_diagnostics(cu.strip_markup(df, "t"), "t")
    assert {(r.t, r.tag) for r in told.where("t = '<b>x</b >y</b>'").collect()} == {("<b>x</b >y</b>", "</b >")}
    assert all(r.unhandled == bool(r.diagnostics) for r in found.values())
    assert cu.strip_markup(spark.createDataFrame([(None,)], "t string"), "t").first().stripped is None


def test_every_coordinate_of_a_cue(spark):
    cues = [(1, 0, 0, 100, 300, 10), (1, 1, 1, 90, 300, 10), (1, 2, 2, 400, 601, 10), (2, 0, 0, 1000, 1200, 10), (2, 1, 1, 1100, 1300, 10), (2, 2, 2, 1200, 1400, 0), (3, 0, 0, 0, 200, 10)]
    parts = [("c", 1, 0, 100, 600), ("c", 2, 1, 1000, 2000)]
    df = spark.createDataFrame(cues, "part_id long, pos long, ordinal long, start_t long, end_t long, visible long")
    line = spark.createDataFrame(parts, "collection string, part_id long, part_pos long, start_t long, end_t long")
    found = {(r.part_id, r.pos): tuple(r)[3:] for r in folds.gate_on_timeline(df, line).collect()}
    none = (None,) * 4
    assert found == {
        (1, 0): (None, 100, 300, 0, 200, 0, 200), (1, 1): ("out_of_coverage", 90, 300, *none), (1, 2): ("out_of_coverage", 400, 601, *none), (2, 0): (None, 1000, 1200, 0, 200, 500, 700),
        (2, 1): ("processing_duplication", 1100, 1300, *none), (2, 2): ("missing_text", 1200, 1400, *none), (3, 0): ("out_of_coverage", 0, 200, *none)}


def test_ticks_are_exact_or_refused(spark):
    rows = [(90_000, 90_000, 1), (90_000, 90_000, 2), (-1, 1000, 1), (5, 0, 1), (5, None, 1), (5, -3, 1), (5, 1000, 0), (2**62, 1000, 1), (None, 1000, 1), (7, 7, 1)]
    df = spark.createDataFrame(rows, "n long, base long, num long").select(columns.ticks("n", "base", 90_000, "num").alias("t"), columns.ticks("n", "base", 1000, "num").alias("ms"))
    found = [(tuple(r.t), tuple(r.ms)) for r in df.collect()]
    none = lambda reason: (None, reason)
    assert found == [
        ((90_000, None), none("time_base_not_common")), ((180_000, None), none("time_base_not_common")), ((-90, None), (-1, None)), *[(none("time_base_invalid"),) * 2] * 4,
        (none("ticks_out_of_range"), (2**62, None)), ((None, None), (None, None)), (none("time_base_not_common"),) * 2]


def test_least_common_base(spark):
    import math

    of = lambda bases: columns.least_common(spark.createDataFrame([(b,) for b in bases], "b long"), "b").first()[0]
    for bases in ([1000, 90_000, 48_000], [30_000, 1001, 24_000, 0, -5, None], [1], [2**40, 3**14]):
        assert of(bases) == math.lcm(*[b for b in bases if b and b > 0])
    assert of([2**62, 3]) is None and of([0]) == 1


def test_carve_refuses_overlapping_bases(spark):
    df = lambda rows: spark.createDataFrame(rows, "k long, start_t long, end_t long, name string")
    minus = spark.createDataFrame([(1, 2, 3)], "k long, start_t long, end_t long")
    assert sorted(map(tuple, iv.carve(df([(1, 0, 5, "a"), (1, 5, 9, "b")]), minus, ["k"]).select("k", "start_t", "end_t", "name").collect())) == [(1, 0, 2, "a"), (1, 3, 5, "a"), (1, 5, 9, "b")]
    with pytest.raises(Exception, match="base intervals overlap"):
        iv.carve(df([(1, 0, 20, "a"), (1, 5, 10, "b")]), minus, ["k"]).collect()
