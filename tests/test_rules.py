"""Rules of runs, parts and segments as functions on own tables."""

from partwise.operators import audit, screen, segments, speech, tracks
from partwise.operators import intervals as iv
from pyspark.sql import functions as F


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=str)


def test_rules_of_runs(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "part int, ids string")
    new = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (5, "e")], "part int, ids string")
    assert rows(audit.changed_parts(old, new, "part", "ids")) == [(1, "unaffected"), (2, "changed"), (3, "unaffected"), (4, "removed"), (5, "added")]
    failures = spark.createDataFrame([(9, "k", 1), (3, "k", 1), (5, "k", 2), (6, None, 2), (7, None, 2)], "report int, kind string, gate int")
    assert rows(audit.recurring(failures, ["kind", "gate"], "report"), "reports", "first_report") == [(2, 3), (2, 6)]
    steps = spark.createDataFrame([(1, "f", 0), (1, "f", 0), (2, "f", 0), (2, "f", 0), (2, "ok", 0), (3, "ok", 9), (4, "ok", 0), (4, "f", 0)], "run int, s string, size int")
    told = audit.terminal_status(steps, "run", F.col("s") == "f", F.col("size") > 5, 1)
    assert rows(told) == [(1, "failed"), (2, "incomplete"), (3, "complete_with_warnings"), (4, "complete")]
    assert rows(audit.verbatim_runs(steps, "run", F.col("s") == "ok", F.col("size") > 5)) == [(1, False), (2, False), (3, True), (4, False)]
    measured = spark.createDataFrame([("a", 5, "high"), ("a", 7, "high"), ("b", 6, "low")], "capability string, peak long, confidence string")
    assert rows(audit.peak_memory(measured, "capability")) == [("a", 7, "high"), ("b", 6, "low"), (None, 7, "mixed")]
    taken = spark.createDataFrame([(1, "a", 4000, "high", 1, 1), (1, "a", 9000, "high", 2, 0), (1, "a", 1, "low", 3, 0)], "source long, capability string, peak long, confidence string, run_id int, seq int")
    estimate = audit.decode_estimate(spark.createDataFrame([(1, 10), (2, 10)], "source long, s long"), taken, ["a", "b"])
    assert rows(estimate) == [(1, "a", 9, 9, 9, True), (1, "b", 2, 4, 10, False), (2, "a", 2, 4, 10, False), (2, "b", 2, 4, 10, False)]
    events = spark.createDataFrame([(1, 2, 50, 1), (1, 1, 20, 2), (2, 1, 5, 9)], "run int, sequence int, at long, bytes long")
    assert rows(audit.elapsed_and_size(events, "run")) == [(1, 30, 3)]
    runs = spark.createDataFrame([(1, "s", True), (2, "s", True), (3, "s", False), (4, "t", False)], "run int, source string, good boolean")
    assert rows(audit.latest_eligible(runs, "source", "run", F.col("good"))) == [("s", 2)]
    assert rows(audit.first_valid(runs, "source", "run", "run", F.col("good"))) == [("s", 1)]


def test_rules_of_parts_and_cues(spark):
    cues = spark.createDataFrame([(1, i, i * 10, i * 10 + 5, t) for i, t in enumerate(["a", " ", "b", "c"])], "p int, source_ordinal int, start_t long, end_t long, text string")
    changes = spark.createDataFrame([(1, -5), (1, 11), (1, 12), (1, 20), (1, 99), (2, 5)], "p int, t long")
    assert rows(segments.cuts_at_changes(cues, changes, "p", ["start_t"])) == [(1, 0, 1), (1, 2, 3)]
    assert rows(segments.language_union(spark.createDataFrame([(1, ["b", "a"]), (1, ["a"]), (2, [])], "c int, languages array<string>"), "c")) == [(1, ["a", "b"]), (2, [])]
    raw = spark.createDataFrame([(1, 0, "x"), (1, 1, "y")], "p int, place int, content string")
    assert rows(segments.bind_content(cues.where("source_ordinal > 0"), raw, "p", "source_ordinal", "place", "content")) == [(1, 0, "x"), (1, 1, "y"), (1, 2, None)]
    frames = spark.createDataFrame([(1, screen.SELECTED), (1, screen.SELECTED), (1, "other"), (2, "other")], "p int, reason string")
    assert rows(screen.resource_plan(frames, "p", 3, 10, 1)) == [(1, 2, 6, 20, False)]
    packets = spark.createDataFrame([(1, 1, 5), (1, 2, 90), (2, 1, 5), (2, 1, None)], "p int, stream int, size long")
    assert rows(tracks.growth_estimate(packets, "p", "stream", 40)) == [(1, 80, 80), (2, 5, 40)]
    assert rows(tracks.in_order(cues, "p"), "source_ordinal", "place") == [(0, 1), (1, 2), (2, 3), (3, 4)]
    assert rows(tracks.with_provenance({"a": cues.limit(1), "b": cues.limit(0)}, ["p"])) == [(1, "a")]
    assert rows(iv.from_own_start(cues.where("source_ordinal > 0"), "p")) == [(1, 0, 5), (1, 10, 15), (1, 20, 25)] and rows(iv.envelope(cues, "p")) == [(1, 0, 35)]
    streams = spark.createDataFrame([(1, 2, 0, 9, "complete"), (1, 1, 3, 4, "complete"), (2, 0, None, None, "coverage_indeterminate"), (2, 1, 0, 1, "complete")], "p int, stream int, start_t long, end_t long, state string")
    assert rows(speech.first_stream_coverage(streams, "p", "stream")) == [(1, 3, 4)]
    assert rows(speech.assembled(cues, "p", "source_ordinal"), "source_ordinal", "ordinal") == [(0, 0), (2, 1), (3, 2)]
    assert rows(speech.speaker_labels(spark.createDataFrame([(7, 30), (7, 4), (7, 30)], "p int, cluster int"), "p", "cluster"), "label") == [("part-07:speaker-01",), ("part-07:speaker-02",), ("part-07:speaker-02",)]
    assert rows(speech.leading(cues, "p", ["start_t"], 2), "source_ordinal") == [(0,), (1,)]
