"""Operators on tables of a caller's own, with worked cases."""

import random

import pytest
from partwise.functions import columns
from partwise.operators import audit, cues as cu, screen, segments, speech, suspicion, tracks, urls
from partwise.sources import subtitles as sub
from pyspark.sql import functions as F


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_redacted_urls_keep_no_secret(spark):
    cases = {
        "https://user:secret@Host.Example.com:8443/p?q=1#f": ("https", "host.example.com", "/p"), "HTTP://a.org": ("http", "a.org", "/"), "https://a@b@c.net/x@y": ("https", "c.net", "/x@y"),
        "https://[::1]:80/z": ("https", "[::1]", "/z"), "https://h.de?x=/y": ("https", "h.de", "/"), "no url": ("", "", "/"),
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string").select("url", urls.redacted(F.col("url")).alias("u"))
    assert {r.url: (r.u.scheme, r.u.host, r.u.path) for r in df.collect()} == cases


def test_url_policy(spark):
    entries = spark.createDataFrame([("c", 1, "http://a.org/1"), ("c", 2, "http://a.org/2"), ("c", 3, "http://a.org/1"), ("d", 1, "http://a.org/1"), ("d", 2, "https://a.org/1"), ("d", 3, "ftp://a.org")], "c string, n int, url string")
    found = urls.authorized(entries, "c", "url", "n", spark.createDataFrame([("c",)], "c string"))
    assert [r[3] for r in rows(found.select("c", "n", "url", "verdict"), "c", "n")] == ["authorized", "insecure_http_not_authorized", "duplicate_url", "insecure_http_not_authorized", "authorized", "url_invalid"]
    visits = spark.createDataFrame([(1, "https://a.org/x", u) for u in ("https://a.org/y", "http://a.org/y", "https://b.org/", "https://cdn.net/", "http://cdn.net/")], "p int, a string, u string")
    told = urls.destinations(visits, "a", "u", spark.createDataFrame([(1, "CDN.net"), (2, "b.org")], "p int, host string"), "p")
    assert {r.u: r.verdict for r in told.collect()} == {"https://a.org/y": "allowed", "http://a.org/y": "https_downgrade", "https://b.org/": "host_escalation", "https://cdn.net/": "allowed", "http://cdn.net/": "https_downgrade"}


def test_broken_payloads_are_ambiguous_and_do_not_stop_the_job(spark):
    le = "aé😀".encode("utf-16le")
    cases = [(1, b"\xff\xfe" + le, None), (2, b"\xff\xfe" + le[:-1], None), (3, b"\xff\xfe" + le[:-2], None), (4, b"\xfe\xff\xdc\x00\xd8\x00", None), (5, b"\xef\xbb\xbf\xff", None), (6, le, "utf-16le"), (7, "é".encode(), "utf-16be"), (8, b"x", "latin-1"), (9, b"\xff\xfe", None)]
    found = {r.i: (r.state, r.text) for r in sub.decoded(spark.createDataFrame(cases, "i int, content binary, d string"), "d").collect()}
    bad = ("encoding_ambiguous", None)
    assert found == {1: ("decoded", "aé😀"), 2: bad, 3: bad, 4: bad, 5: bad, 6: ("decoded", "aé😀"), 7: ("decoded", "쎩"), 8: bad, 9: ("decoded", "")}


def test_utf16_is_whole_where_a_strict_decoder_says_so(spark):
    rng, units = random.Random(31), (0x41, 0x0A, 0xD7FF, 0xD800, 0xDBFF, 0xDC00, 0xDFFF, 0xE000, 0x41D8, 0xDC)
    cases = []
    for i in range(600):
        name, order = (("utf-16le", "little"), ("utf-16be", "big"))[i % 2]
        body = b"".join(rng.choice(units).to_bytes(2, order) for _ in range(rng.randrange(9))) + b"\xd8" * (i % 20 == 0)
        try:
            want = body.decode(name.replace("16", "16-"))
        except UnicodeDecodeError:
            want = None
        cases.append((i, body, name, want))
    found = {r.i: (r.state, r.text) for r in sub.decoded(spark.createDataFrame(cases, "i int, content binary, d string, want string"), "d").collect()}
    assert found == {i: ("encoding_ambiguous" if want is None else "decoded", want) for i, _, _, want in cases}


@pytest.mark.parametrize("form, text, want", [
    ("srt", "1\n00:00:01,000 --> 00:00:02,000\nNOTES on a talk\n\n2\n00:00:03,000 --> 00:00:04,500\nx", (None, [(None if 0 else "1", "", 1000, 2000, "NOTES on a talk"), ("2", "", 3000, 4500, "x")])),
    ("srt", "NOTES\n00:00:01,000 --> 00:00:02,000\nx", (None, [("NOTES", "", 1000, 2000, "x")])),
    ("srt", "00:00:01.000 --> 00:00:02.000\nx", ("syntax_invalid", [])),
    ("srt", "00:00:01,000 --> 00:00:02,000 line:1\nx", ("syntax_invalid", [])),
    ("srt", "01:00 --> 02:00\nx", ("syntax_invalid", [])),
    ("srt", "a\nb\n00:00:01,000 --> 00:00:02,000\nx", ("syntax_invalid", [])),
    ("srt", "00:00:01,000 --> 00:00:02,000\n \n\n00:00:03,000 --> 00:00:02,000\nx", ("syntax_invalid", [])),
    ("srt", "00:00:03,000 --> 00:00:02,000\nx\n\nno timing", ("duration_invalid", [])),
    ("srt", "", ("syntax_invalid", [])),
    ("vtt", "﻿WEBVTT head\r\n\r\nNOTE a\r\nb\r\n\r\n00:01.000 --> 00:02.500 align:left  line:2\r\none\r\ntwo\r\n\r\nid\r\n100:00:00.000 --> 100:00:01.000\r\nx", (None, [(None, "align:left  line:2", 1000, 2500, "one\ntwo"), ("id", "", 360_000_000, 360_001_000, "x")])),
    ("vtt", "WEBVTT\n\nNOTE\n00:01.000 --> 00:02.000\nx", (None, [("NOTE", "", 1000, 2000, "x")])),
    ("vtt", "WEBVTTX\n\n00:01.000 --> 00:02.000\nx", ("syntax_invalid", [])),
    ("vtt", "WEBVTT\n\n00:01,000 --> 00:02,000\nx", ("syntax_invalid", [])),
    ("vtt", "WEBVTT\n\nSTYLE\n::cue {}", ("syntax_invalid", [])),
])
def test_srt_and_vtt_are_two_forms(spark, form, text, want):
    tracks_, cues = sub.parse_cues(spark.createDataFrame([(1, text)], "k int, text string"), "k", form=form)
    assert tracks_.first().reason == want[0]
    assert [(r.identifier, r.settings, r.start_t, r.end_t, r.text) for r in cues.orderBy("ordinal").collect()] == want[1]


def test_rendering_keeps_names_and_tells_lost_settings(spark):
    cues = spark.createDataFrame([(1, 0, 0, 1500, "a", "intro", "line:1"), (1, 1, 2000, 3000, "b", None, None), (2, 0, -5, 10, "c", None, None)], "k int, source_ordinal long, start_t long, end_t long, text string, identifier string, settings string")
    srt = {r.k: r for r in sub.rendered(cues, "k").collect()}
    vtt = {r.k: r for r in sub.rendered(cues, "k", form="vtt").collect()}
    assert srt[1].text == "intro\n00:00:00,000 --> 00:00:01,500\na\n\n2\n00:00:02,000 --> 00:00:03,000\nb\n" and [tuple(x) for x in srt[1].losses] == [(0, "line:1")]
    assert vtt[1].text.startswith("WEBVTT\n\nintro\n00:00:00.000 --> 00:00:01.500 line:1\na\n") and vtt[1].losses == [] and (srt[2].text, srt[2].reason) == (None, "negative_time")


def test_times_before_zero_round_outwards(spark):
    df = spark.createDataFrame([(-1, 1), (-1000, -999), (1, 999), (0, 1000)], "s long, e long")
    start, end = columns.outward("s", "e", 1000)
    assert [tuple(r) for r in df.select(start, end).collect()] == [(-1, 1), (-1, 0), (0, 1), (0, 1)]


def test_markup_is_what_innermost_pairs_taken_out_again_and_again_leave(spark):
    import random
    import re

    rnd = random.Random(2)
    parts = ["<b>", "</b>", "<i>", "</i>", "<u>", "</U>", "<font a=1>", "</font>", "x", " y ", "<", "<b c>", "<br>"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    opens = r"<[biu]\s*>|<font(?:\s[^<>]*)?>"
    pairs = re.compile(rf"(?is)(?:<([biu])\s*>|<(font)(?:\s[^<>]*)?>)((?:(?!{opens}).)*?)</(?(1)\1|\2)\s*>")

    def plain(text):
        after = pairs.sub(lambda m: "\0" + m[3].replace("<", "\1") + "\0", text)  # closing tags within a pair are spent, and nothing grows together
        return text.replace("\0", "").replace("\1", "<") if after == text else plain(after)

    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = {r.i: r for r in cu.strip_markup(df, "t").collect()}
    assert all(found[i].stripped == plain(t) for i, t in enumerate(texts))
    c = cu.strip_markup(spark.createDataFrame([("say <i>it</i> so",)], "t string"), "t").first().corrections
    assert [tuple(x) for x in c] == [(4, 7, 2, 2), (9, 13, 2, 2)]


def test_readable_mode_keeps_exact_repeats(spark):
    df = spark.createDataFrame([(1, 0, 0, 2, "again"), (1, 1, 0, 2, "again")], "part_id long, source_ordinal long, start_t long, end_t long, text string").withColumn("tokens", columns.tokens(F.col("text")))
    assert [(r.kept_from, r.correction) for r in cu.rolling(df, "part_id", readable=True).orderBy("source_ordinal").collect()] == [(0, None), (0, "possible_duplicate")]


def test_envelopes_are_refused_whole(spark):
    head = '"schema_version":1,"projection_version":"v1","adapter":"a","capability":'
    item = '{"part_id":"p","visual_page_id":"g","pts":{"numerator":1,"denominator":%d},"text":"abc","confidence":0.5,"language_spans":[{"language":"en","start_char":0,"end_char":%d}]}'
    good, late, den = item % (2, 3), item % (2, 4), item % (0, 3)
    outputs = [(i, "```json\n{%s\"ocr\",\"result\":{\"items\":[%s]}}\n```" % (head, x)) for i, x in enumerate([good, f"{good},{late}", den])] + [(3, "{" + head + '"other","result":{"items":[]}}'), (4, "not json"), (5, "{" + head + '"ocr","result":{}}')]
    found = {r.k: (r.valid, r.reason) for r in sub.read_envelopes(spark.createDataFrame(outputs, "k int, json string"), "k", kind="ocr").collect()}
    assert found == {0: (True, None), **{k: (False, "model_output_invalid") for k in range(1, 6)}}


def test_vad_partition_merges_neighbours_and_refuses_segments_outside(spark):
    usable = spark.createDataFrame([(1, 0, 10), (2, 0, 10), (3, 0, 10)], "p int, start_t long, end_t long")
    segs = spark.createDataFrame([(1, 1, 3, "speech_likely"), (1, 3, 4, "speech_likely"), (1, 6, 7, "non_speech"), (2, 8, 11, "speech_likely"), (3, 1, 5, "speech_likely"), (3, 4, 6, "non_speech")], "p int, start_t long, end_t long, state string")
    found = rows(speech.vad_partition(usable, segs, "p").select("p", "start_t", "end_t", "state", "reason"), "p", "start_t")
    want = [(0, 1, "indeterminate"), (1, 4, "speech_likely"), (4, 6, "indeterminate"), (6, 7, "non_speech"), (7, 10, "indeterminate")]
    assert found == [*((1, a, b, s, None) for a, b, s in want), (2, None, None, None, "model_output_invalid"), (3, None, None, None, "model_output_invalid")]


def test_detectors_stand_in_one_order_with_their_thresholds(spark):
    token = "array<struct<text:string,confidence:double>>"
    data = [(1, 0, 0, 2000, "a a a a", [("a", None)] * 4, ["x", "y", "x", "y"]), (1, 1, 2000, 4000, "b2 17", [("b2", 0.4), ("17", 0.5)], ["x", "y", "x"])]
    cues = spark.createDataFrame(data, f"p int, source_ordinal long, start_t long, end_t long, text string, tokens {token}, languages array<string>")
    sound = spark.createDataFrame([(1, 500, 1500, "non_speech"), (1, 2500, 3499, "non_speech"), (1, 3900, 5000, "speech_likely"), (1, 6000, 6999, "speech_likely")], "p int, start_t long, end_t long, state string")
    found = [(r.place, r.start_t, r.end_t, r.detector, r.ordinals, r.evidence) for r in suspicion.detect(cues, sound, "p", 1000, 1000).orderBy("place").collect()]
    assert found == [(1, 0, 2000, "repetition", [0], "a 4"), (2, 0, 2000, "language_switching", [0], "3"), (3, 500, 1500, "vad_coverage", [0], ""), (4, 2000, 4000, "confidence", [1], "b2"), (5, 2000, 4000, "numbers_entities", [1], "b2 17"), (6, 4000, 5000, "coverage_checks", [], "")]


def test_tiling_rejects_with_reasons_and_falls_back(spark):
    cues = spark.createDataFrame([(p, f"c{p}{i}", i) for p in (1, 2) for i in range(4)], "part_id long, cue_id string, place long")
    spans = [(1, 0, 1, "c10", "c11"), (1, 1, 1, "c12", "c13"), (1, 2, 1, "c10", "c11"), (1, 3, 2, "c10", "c13"), (1, 4, 1, "c13", "c12"), (1, 5, 1, "c10", "nope"), (2, 0, 2, "c20", "c21"), (2, 1, 2, "c23", "c23")]
    outcomes, found = segments.tile(spark.createDataFrame(spans, "part_id long, pos int, named_part long, start_cue string, end_cue string"), cues)
    assert [r[2] for r in rows(outcomes, "part_id", "pos")] == ["accepted", "accepted", "boundary_duplicate", "boundary_crosses_part", "boundary_empty", "boundary_out_of_range", "coverage_breaking", "coverage_breaking"]
    assert [(r.part_id, r.ordinal, r.origin, r.cue_ids) for r in found.orderBy("part_id", "ordinal").collect()] == [(1, 0, "adjudicated", ["c10", "c11"]), (1, 1, "adjudicated", ["c12", "c13"]), (2, 0, "conservative_fallback", ["c20", "c21", "c22", "c23"])]


def test_intervals_are_replaced_whole_or_not_at_all(spark):
    s = "p int, cue string, start_t long, end_t long"
    subtitles = spark.createDataFrame([(1, "s1", 0, 4), (1, "s2", 4, 8), (1, "s3", 9, 14), (1, "s4", 20, 24), (1, "s5", 30, 34)], s)
    asr = spark.createDataFrame([(1, "a1", 1, 3, True), (1, "a2", 5, 9, True), (1, "a3", 21, 22, True), (1, "a4", 22, 23, False)], s + ", admitted boolean")
    wanted = spark.createDataFrame([(1, 7, 0, 10), (1, 8, 20, 25), (1, 9, 30, 40)], "p int, interval int, start_t long, end_t long")
    log, cues = tracks.replace_intervals(subtitles, asr, wanted, "p", "cue", "interval", 10)
    assert [(r.interval, r.reason, r.replaced_cue_ids, r.asr_cue_ids) for r in log.orderBy("interval").collect()] == [(7, "asr_cues_passed_gates", ["s1", "s2"], ["a1", "a2"]), (8, "asr_cues_failed_gates", ["s4"], []), (9, "no_asr_candidate", ["s5"], [])]
    assert sorted((r.cue, r.provenance) for r in cues.collect()) == [("a1", "asr"), ("a2", "asr"), ("s3", "subtitle_track"), ("s4", "subtitle_track"), ("s5", "subtitle_track")]


def test_asr_cues_of_no_length_neither_replace_nor_block(spark):
    s = "p int, cue string, start_t long, end_t long"
    subtitles = spark.createDataFrame([(1, "s1", 2, 8), (1, "s2", 5, 5), (1, "s3", 21, 24), (1, "s4", 31, 34)], s)
    asr = spark.createDataFrame([(1, "a1", 1, 3, True), (1, "a2", 4, 4, True), (1, "a3", 6, 6, False), (1, "a4", 22, 22, True), (1, "a5", 33, 33, False)], s + ", admitted boolean")
    wanted = spark.createDataFrame([(1, 7, 0, 10), (1, 8, 20, 25), (1, 9, 30, 40)], "p int, interval int, start_t long, end_t long")
    log, cues = tracks.replace_intervals(subtitles, asr, wanted, "p", "cue", "interval", 10)
    found = [(r.interval, r.reason, r.admitted, r.rejected, r.replaced_cue_ids, r.asr_cue_ids) for r in log.orderBy("interval").collect()]
    assert found == [(7, "asr_cues_passed_gates", 1, 0, ["s1", "s2"], ["a1"]), (8, "no_asr_candidate", 0, 0, ["s3"], []), (9, "no_asr_candidate", 0, 0, ["s4"], [])]
    assert sorted((r.cue, r.provenance) for r in cues.collect()) == [("a1", "asr"), ("s3", "subtitle_track"), ("s4", "subtitle_track")]


def test_default_classes_and_comments_read_out(spark):
    items = spark.createDataFrame([(1, "看弹幕和关注", 0.9), (2, "logo", 0.1), (3, "播放", 0.2), (4, "播放备注", 0.9), (5, "备注", 0.9), (6, "text", 0.9)], "i int, text string, confidence double")
    assert [(r["class"], r.kind, r.marker) for r in screen.classified(items).orderBy("i").collect()] == [("excluded", "danmaku", "弹幕"), ("excluded", "logo", "logo"), ("classification_uncertain", None, None), ("background_ui", None, None), ("speaker_supplement", None, None), ("page_text", None, None)]
    comments = spark.createDataFrame([(1, 1, 5000, "这个问题问得好"), (1, 2, 5000, "讲得很清楚"), (1, 3, 5000, "ab")], "p int, comment int, pts long, text string")
    cues = spark.createDataFrame([(1, "b", 6900, 7500, "这个问题，问得好！"), (1, "a", 1000, 3000, "有人问：讲得 很清楚"), (1, "c", 9000, 9900, "讲得很清楚 ab")], "p int, cue string, start_t long, end_t long, text string")
    found = {r.comment: (r.cited, r.basis) for r in screen.host_reads(comments, cues, "p", "comment", "cue", 1000, 1000).collect()}
    assert found == {1: (["b"], "host_read"), 2: (["a"], "host_selected")}


def test_artifacts_are_carried_only_where_content_lacks(spark):
    s = "path string, kind string, part_id string, status string, sha256 string"
    prior = spark.createDataFrame([("a", "srt", "p1", "valid", "1"), ("b", "srt", "p1", "partial", "2"), ("c", "document", "p1", "valid", "3"), ("d", "srt", None, "valid", "4"), ("e", "srt", "p2", "valid", "5"), ("f", "srt", "p1", "failed", None)], s)
    new = spark.createDataFrame([("a", "srt", "p1", "unavailable", None), ("b", "srt", "p1", "valid", "9"), ("g", "srt", "p3", "unavailable", None)], s)
    found = rows(audit.carried_artifacts(prior, new, spark.createDataFrame([("p2",)], "part_id string")).select("path", "status", "sha256", "origin"), "path")
    assert found == [("a", "valid", "1", "carried"), ("b", "valid", "9", "new"), ("g", "unavailable", None, "new")]


def test_track_and_collection_states(spark):
    cand = spark.createDataFrame([(1, "a", True, False), (1, "b", False, False), (2, "a", True, False), (2, "b", True, False), (3, "a", True, False), (3, "b", True, False), (4, "a", False, True), (5, "a", False, False), (6, "a", True, False), (6, "b", True, False)], "p int, track string, valid boolean, ambiguous boolean")
    found = tracks.select_tracks(cand, spark.createDataFrame([(3, "b"), (6, "z")], "p int, selected string"), "p")
    assert [(r.track, r.state) for r in found.orderBy("p").collect()] == [("a", "completed"), (None, "awaiting_subtitle_selection"), ("b", "completed"), (None, "blocked"), (None, "subtitle_unavailable_requires_asr_plan"), (None, "blocked")]
    state = tracks.collection_state(found.withColumn("c", F.when(F.col("p").isin(3, 5), "x").when(F.col("p") == 2, "y").when(F.col("p") == 1, "z").otherwise("w")), "c")
    assert {r.c: (r.collection_state, r.asr_parts) for r in state.collect()} == {"x": ("partial", 1), "y": ("awaiting_subtitle_selection", 0), "z": ("completed", 0), "w": ("blocked", 0)}


def test_journal_with_a_hole_and_a_torn_tail(spark):
    edges = {None: {"created"}, "created": {"running"}, "running": {"completed"}}
    lines = [(1, 1, 1, None, "created"), (1, 2, 2, "created", "running"), (1, 3, None, None, None), (2, 1, 1, None, "created"), (2, 2, 3, "created", "running"), (2, 3, 4, "created", "completed")]
    found = {r.run_id: tuple(r)[1:] for r in audit.replay(spark.createDataFrame(lines, "run_id int, line int, sequence long, from_status string, to_status string"), edges).collect()}
    assert found == {1: ("running", 3, 0, 0, 2, 1), 2: ("completed", 5, 1, 1, 1, 0)}
