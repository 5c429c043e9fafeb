"""Chunks and cues, windows, proposals, gated replacement, publication, files as sources: own tables and worked cases."""

import random

import pytest
from partwise.operators import alignment as al
from partwise.operators import publication, screen, segments, speech, tracks
from partwise.sources import subtitles as sub
from pyspark.sql import functions as F


def test_a_cue_goes_to_the_chunk_that_holds_it(spark):
    rng = random.Random(5)
    chunks, cues = [], []
    for k in range(5):
        t = 0
        for n in range(30):
            t += rng.randint(0, 3)
            chunks.append((k, n, t, t + rng.randint(1, 9)))
            t = chunks[-1][3]
        cues += [(k, i, (a := rng.randint(-5, 250)), a + rng.randint(1, 6), {"x": i}) for i in range(80)]
    df = spark.createDataFrame(cues, "k long, cue_id long, start_t long, end_t long, more map<string,int>")
    found = al.assign_to_chunks(df, spark.createDataFrame(chunks, "k long, chunk long, start_t long, end_t long"), ["k"], "chunk").collect()
    assert len(found) == len(cues)
    for r in found:
        want = next(((n, a, b) for k, n, a, b in chunks if k == r.k and a <= r.start_t and r.end_t <= b), (None, None, None))
        assert (r.chunk, r.chunk_start, r.chunk_end) == want and r.more == {"x": r.cue_id}
    with pytest.raises(Exception, match="chunks overlap"):
        al.assign_to_chunks(df, spark.createDataFrame([(0, 0, 0, 9), (0, 1, 5, 7)], "k long, chunk long, start_t long, end_t long"), ["k"], "chunk").collect()


def test_a_cue_of_no_length_must_stand_within_its_chunk(spark):
    spans = "k long, {} long, start_t long, end_t long"
    chunks = spark.createDataFrame([(1, 1, 0, 10), (1, 2, 10, 20), (1, 3, 25, 25), (2, 1, 5, 9)], spans.format("chunk"))
    cues = spark.createDataFrame([(1, i, t, t) for i, t in enumerate((0, 4, 10, 11, 20, 25))] + [(2, 6, 5, 6), (2, 7, 9, 9)], spans.format("cue_id"))
    found = {r.cue_id: (r.chunk, r.chunk_start, r.chunk_end) for r in al.assign_to_chunks(cues, chunks, ["k"], "chunk").collect()}
    none = (None, None, None)
    assert found == {0: none, 1: (1, 0, 10), 2: none, 3: (2, 10, 20), 4: none, 5: none, 6: (1, 5, 9), 7: none}


def test_windows_are_padded_and_clamped_and_every_cue_has_a_proposal(spark):
    rows = [(1, 1000, 2000, 0, 5000, [(0.5, 0.75), (-1.0, 9.0), (0.25, 0.25)]), (2, 100, 4900, 0, 5000, [(0.0, 0.5)]), (3, 1000, 2000, None, None, [(0.0, 1.0)]), (4, 1000, 2000, 0, 5000, [(2.0, 1.0)]), (5, 1000, 2000, 0, 5000, None), (6, 1000, 2000, 0, 5000, [(9.0, 99.0)])]
    df = spark.createDataFrame(rows, "cue_id long, start_t long, end_t long, chunk_start long, chunk_end long, items array<struct<start:double,end:double>>").withColumns({"lo": F.lit(0).cast("long"), "total": F.lit(500).cast("long"), "sure": F.lit(0.9)})
    windows = al.alignment_windows(df, "lo", 100, 1000, 20)
    found = {r.cue_id: (r.window_start, r.window_end, r.proposed_start, r.proposed_end, r.proposed_confidence) for r in al.proposals(windows, "items", "total", "lo", 100, 1000, "sure").collect()}
    assert found == {1: (80, 220, 1300, 1550, 0.9), 2: (0, 500, 0, 500, 0.9), 3: (None, None, 1000, 2000, 0.0), 4: (80, 220, 1000, 2000, 0.0), 5: (80, 220, 1000, 2000, 0.0), 6: (80, 220, 1000, 2000, 0.0)}


def test_only_gated_cues_within_the_envelope_replace(spark):
    subtitles = spark.createDataFrame([(1, 1, 0, 100), (1, 2, 100, 200), (1, 3, 200, 300)], "part_id long, cue_id long, start_t long, end_t long")
    asr = spark.createDataFrame([(1, 11, 0, 0, 10, 60, 2), (1, 12, 1, 1, 110, 150, 2), (1, 13, 2, 2, 120, 160, 2), (1, 14, 3, 3, 210, 400, 2)], "part_id long, cue_id long, pos long, ordinal long, start_t long, end_t long, visible long")
    wanted = spark.createDataFrame([(1, 1, 0, 100), (1, 2, 100, 200), (1, 3, 200, 300)], "part_id long, interval_id long, start_t long, end_t long")
    corrections, cues = al.gated_replacement(subtitles, asr, wanted, "cue_id", "interval_id", 1000, 0, 10**6)
    assert {r.interval_id: (r.reason, r.admitted, r.rejected) for r in corrections.collect()} == {1: ("asr_cues_passed_gates", 1, 0), 2: ("asr_cues_failed_gates", 1, 1), 3: ("no_asr_candidate", 0, 0)}
    assert sorted((r.cue_id, r.provenance) for r in cues.collect()) == [(2, "subtitle_track"), (3, "subtitle_track"), (11, "asr")]


def test_publication_by_mode_gate_and_evidence(spark):
    plans = spark.createDataFrame([("a", "full_asr"), ("b", None), ("c", "enhancement"), ("d", "enhancement"), ("e", "other")], "collection string, mode string")
    parts = spark.createDataFrame([("a", "p1"), ("a", "p2"), ("b", "p"), ("d", "q"), ("d", "q")], "collection string, part_id string")
    rows = [("a", "p1", "subtitles", "verbatim", "o", "n", True, None, None), ("a", "p2", "subtitles", "verbatim", "o", "n", False, True, None), ("a", "p1", "subtitles", "readable", None, "n", False, None, None), ("a", "p1", "subtitles", "source", "o", None, None, None, None),
            ("a", None, "transcript", "verbatim", "t", None, None, None, True), ("a", None, "segments", None, "s", "x", True, None, None)]
    evidence = spark.createDataFrame(rows, "collection string, part_id string, kind string, basis string, original string, adopted string, gates_passed boolean, partial boolean, invalid boolean")
    found = {(r.collection, r.path): (r.status, r.timing_view, r.timing_basis, r.reason) for r in publication.project_artifacts(plans, parts, evidence).collect()}
    assert found["a", "parts/p1/subtitles.verbatim.srt"] == ("valid", "part_relative", "adopted_alignment", None) and found["a", "parts/p2/subtitles.verbatim.vtt"] == ("partial", "part_relative", "original", None)
    assert found["a", "parts/p1/subtitles.readable.srt"] == ("unavailable", "part_relative", None, None) and found["a", "transcript.verbatim.md"] == ("invalid", "collection_virtual", "original", None)
    assert found["a", "segments.json"] == ("valid", "collection_virtual", None, None) and found["a", "content-report.md"] == ("unavailable", None, None, None)
    assert len([k for k in found if k[0] == "a"]) == 2 * 4 + 4 + 2 + 3
    assert {k: v[3] for k, v in found.items() if k[0] != "a"} == {("b", None): "missing_asr_mode", ("c", None): "empty_plan", ("d", None): "duplicate_part", ("e", None): "missing_asr_mode"}
    assert [(r.basis, r.original) for r in publication.unused_evidence(plans, parts, evidence).collect()] == [("source", "o")]


def test_sources_are_files(spark, tmp_path):
    for name, data in {"a.mp4": b"\x00\xff", "b.mp4": b"\x00\xff", "c.mp4": b"\x00", "d.txt": b"other"}.items():
        (tmp_path / name).write_bytes(data)
    files = sub.hashed(sub.read_payloads(spark, str(tmp_path), "*.mp4")).withColumn("path", F.regexp_extract("path", r"[^/]+$", 0))
    assert sorted((r.kept, r.copies, r["size"]) for r in sub.one_source_each(files).collect()) == [("a.mp4", 2, 2), ("c.mp4", 1, 1)]
    parts = spark.createDataFrame([("x", 1, "a.mp4"), ("x", 2, "b.mp4"), ("x", 3, "gone.mp4"), ("y", 1, "b.mp4")], "collection string, part int, path string")
    assert {(r.collection, r.part): r.reason for r in sub.distinct_parts(parts, files, "collection", "part").collect()} == {("x", 1): None, ("x", 2): "duplicate_part", ("x", 3): "source_unavailable", ("y", 1): None}


def test_source_preserving_writers(spark):
    vtt = "﻿WEBVTT my talk\r\n\r\nNOTE a\r\nb\r\n\r\nlate\r\n00:05.000 --> 00:06.000 line:1\r\nx\r\n\r\n00:01.000 --> 00:02.000\r\ny\r\nz\r\n"
    files = spark.createDataFrame([(1, vtt), (2, "nothing")], "k int, text string")
    as_vtt = {r.k: r for r in sub.source_rendered(files, "k", form="vtt", to="vtt").collect()}
    as_srt = {r.k: r for r in sub.source_rendered(files, "k", form="vtt", to="srt").collect()}
    assert as_vtt[1].text == vtt.replace("\r\n", "\n") and as_vtt[1].losses == [] and (as_vtt[2].text, as_vtt[2].reason) == (None, "syntax_invalid")
    assert as_srt[1].text == "late\n00:00:05,000 --> 00:00:06,000\nx\n\n2\n00:00:01,000 --> 00:00:02,000\ny\nz\n" and [tuple(x) for x in as_srt[1].losses] == [(None, "WEBVTT my talk"), (None, "NOTE a\nb"), (0, "line:1")]
    back = sub.source_rendered(files.select("k", F.lit(as_srt[1].text).alias("text")).limit(1), "k", form="srt", to="vtt").first()
    assert back.text == "WEBVTT\n\nlate\n00:00:05.000 --> 00:00:06.000\nx\n\n2\n00:00:01.000 --> 00:00:02.000\ny\nz\n" and back.losses == []


def test_reviews_are_told_by_their_models(spark):
    primary = spark.createDataFrame([(i, "low_confidence", " ", m) for i, m in enumerate(["a", "a", "", None, "a"])], "i int, reason string, primary_text string, primary_model string")
    review = spark.createDataFrame([(0, "t", "b"), (1, "t", "a"), (2, "t", "b"), (3, "t", "b"), (4, "t", "")], "i int, review_text string, review_model string")
    kinds = speech.classified_reviews(primary, review, "i")
    assert [r.kind for r in kinds.orderBy("i").collect()] == ["independent_review", "recovery", *["review_classification_invalid"] * 3]
    assert [r.decision for r in speech.arbitrate(primary, kinds, "i").orderBy("i").collect()] == ["review_adopted", *["review-needed"] * 4]


def test_facts_media_coverage_and_selectors(spark):
    segs = spark.createDataFrame([(1, 0, 10, True), (1, 1, 20, False), (2, 5, None, True), (2, 3, None, False), (3, 0, None, True), (3, 1, 7, True)], "part_id int, segment int, start_t long, fresh boolean")
    facts = spark.createDataFrame([(1, 5, "a"), (1, 10, "b"), (1, 25, "c"), (2, 1, "d"), (3, 1, "e"), (4, 1, "f")], "part_id int, t long, name string")
    assert {r.name: (r.segment, r.attached) for r in segments.assign_facts(facts, segs, "part_id", "segment").collect()} == {"a": (0, True), "b": (0, True), "c": (1, False), "d": (3, False), "e": (1, True), "f": (None, False)}
    runs = spark.createDataFrame([(1, 10, 20), (2, 10, 20), (3, 10, 20)], "p int, start_t long, end_t long")
    audio = spark.createDataFrame([(1, 20, 30, "speech_likely"), (1, 0, 10, "speech_likely"), (1, 12, 13, "non_speech"), (1, 21, 22, "speech_likely"), (3, 10, 12, "speech_likely")], "p int, start_t long, end_t long, state string")
    media = screen.embedded_media(runs, audio, spark.createDataFrame([(1,), (2,)], "p int"), "p", 1000)
    assert {r.p: (r.basis, [tuple(x) for x in r.overlapping_audio]) for r in media.collect()} == {1: ("picture_plus_audio", [(0, 10), (20, 30)]), 2: ("picture_plus_audio", []), 3: ("picture_only", [])}
    parts = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "c string, p int")
    spans = lambda *r: spark.createDataFrame(r, "p int, start_t long, end_t long")
    found = tracks.caption_coverage(parts, spans((1, 0, 10), (1, 5, 20), (2, 0, 5)), spans((1, 0, 4), (1, 2, 6)), "c", "p")
    assert {(r.c, r.p): (r.covered, r.playback) for r in found.collect()} == {("a", 1): (6, 20), ("a", 2): (0, 5), ("a", None): (6, 25), ("b", 3): (0, None), ("b", None): (0, None), (None, None): (6, 25)}
    docs = spark.createDataFrame([(1, 0, ("t", [1]), [("d", [1]), None, (" ", [1]), ("d", [9])], None), (1, 1, None, None, [("e", [])])], "part_id int, segment int, title struct<text:string,cue_ids:array<int>>, detailed_content array<struct<text:string,cue_ids:array<int>>>, caveats array<struct<text:string,cue_ids:array<int>>>")
    told = segments.validate_content(docs, spark.createDataFrame([(1, 0, [1]), (1, 1, [2])], "part_id int, segment int, owned array<int>"))
    assert {(r.segment, r.kind, r.idx): r.outcome == "kept" for r in told.collect()} == {(0, "title", 0): True, (0, "detail", 0): True, (0, "detail", 1): False, (0, "detail", 2): False, (0, "detail", 3): False, (1, "title", 0): False, (1, "caveat", 0): False}


def test_work_folders_are_cleared(spark):
    sub.clear_work(spark)
    path = sub.work_folder(spark)
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3 and sub.clear_work(spark) == 1 and sub.clear_work(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
