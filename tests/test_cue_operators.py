from partwise.functions import columns
from partwise.operators import cues as cu
from partwise.operators import folds
from partwise.sources import subtitles as sub
from pyspark.sql import functions as F

CUES = "part_id long, source_ordinal long, start_t long, end_t long, text string"


def rolled(spark, rows):
    df = spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], CUES).withColumn("tokens", columns.tokens(F.col("text")))
    return [(r.kept_from, r.correction) for r in cu.rolling(df, "part_id").orderBy("source_ordinal").collect()]


def test_rolling_overlap_is_cut_and_exact_repeats_go(spark):
    assert rolled(spark, [(0, 2, "we need"), (1, 3, "need to act")]) == [(0, None), (1, "proven_rolling_overlap")]
    assert rolled(spark, [(0, 2, "again"), (0, 2, "again"), (0, 2, "again")]) == [(0, None), (None, "exact_duplicate_omitted"), (None, "exact_duplicate_omitted")]
    assert rolled(spark, [(0, 1, "repeat"), (3, 4, "repeat it")]) == [(0, None), (0, "possible_duplicate")]
    assert rolled(spark, [(0, 1, "a b"), (1, 2, "c d")]) == [(0, None), (0, None)]


def test_tokens_are_lossless(spark):
    text = "a  b\r\nc　d "
    tokens = spark.range(1).select(columns.tokens(F.lit(text)).alias("t")).first().t
    assert "".join(tokens) == text.replace("\r\n", "\n") and tokens == ["a", "  ", "b", "\n", "c", "　", "d", " "]


def test_markup_only_when_closed_and_nested(spark):
    cases = {"<b>x</b> y": ("x y", False), "<b><i>x</b></i>": ("<b>x</b></i>", True), "<font color=red>x</font>": ("x", False), "<b id=1>x</b>": ("<b id=1>x</b>", True), "plain": ("plain", False)}
    df = spark.createDataFrame([(k,) for k in cases], "html string")
    rows = {r.html: (r.stripped, r.unhandled) for r in cu.strip_markup(df, "html").collect()}
    assert rows["<b>x</b> y"] == cases["<b>x</b> y"] and rows["<font color=red>x</font>"][0] == "x" and rows["plain"] == ("plain", False) and rows["<b id=1>x</b>"] == cases["<b id=1>x</b>"]
    assert rows["<b><i>x</b></i>"][1]


def test_srt_round_trip_and_atomic_refusal(spark):
    cues = spark.createDataFrame([(1, 0, 0, 1500, "one"), (1, 1, 3600000, 3661001, "two\nlines"), (2, 0, 5, 9, "x")], CUES)
    texts = sub.rendered(cues, "part_id")
    tracks, back = sub.parse_cues(texts, "part_id")
    assert sorted((r.part_id, r.start_t, r.end_t, r.text) for r in back.collect()) == [(1, 0, 1500, "one"), (1, 3600000, 3661001, "two\nlines\n".strip()), (2, 5, 9, "x")]
    bad = texts.withColumn("text", F.regexp_replace("text", "01:01:01,001", "00:00:00,000"))
    tracks, back = sub.parse_cues(bad, "part_id")
    assert {r.part_id: (r.reason, r.n_cues) for r in tracks.collect()} == {1: ("duration_invalid", 0), 2: (None, 1)} and back.count() == 1


def test_payload_marks(spark):
    rows = [(1, "é".encode()), (2, b"\xef\xbb\xbfok"), (3, b"\xff\xfe" + "é".encode("utf-16le")), (4, b"\xfe\xff" + "é".encode("utf-16be")), (5, b"\xc3"), (6, b"")]
    found = {r.i: (r.state, r.text) for r in sub.decoded(spark.createDataFrame(rows, "i int, content binary")).collect()}
    assert found == {1: ("decoded", "é"), 2: ("decoded", "ok"), 3: ("decoded", "é"), 4: ("decoded", "é"), 5: ("encoding_ambiguous", None), 6: ("decoded", "")}


def test_gate_precedence_and_refused_cues_do_not_matter_later(spark):
    schema = "part_id long, pos long, ordinal long, start_t long, end_t long, visible long, c_start long, c_end long"
    rows = [(0, 0, 0, 1000), (1, 1, 5000, 6500), (2, 2, 6000, 7000), (3, 0, 6500, 7000), (4, 4, 6500, 7500), (5, 5, 8000, 8010), (6, 6, 9000, 12000), (7, 7, 7500, 8500)]
    df = spark.createDataFrame([(1, p, o, a, b, 0 if p == 4 else 10, 0, 10000) for p, o, a, b in rows], schema)
    reasons = [r.reason for r in sorted(folds.gate_cues(df).collect(), key=lambda r: [x[1] for x in rows].index(r.ordinal) if r.ordinal else 0)]
    assert sorted(map(str, reasons)) == sorted(["None", "None", "processing_duplication", "non_monotonic", "missing_text", "duration_implausible", "out_of_coverage", "None"])


def test_chunks_pack_coalesce_and_refuse(spark):
    df = lambda *r: spark.createDataFrame([(1, *x) for x in r], "part_id long, start_t long, end_t long")
    pack = lambda d, w: [(r.start_t, r.end_t, r.runs, r.error) for r in folds.pack_chunks(d, w).orderBy("chunk").collect()]
    assert pack(df((0, 4), (4, 6), (8, 10), (11, 19)), 10) == [(0, 10, 2, None), (11, 19, 1, None)]
    assert pack(df((0, 11)), 10) == [(None, None, None, "chunk_window_exceeded")]
    assert pack(df((0, 5), (4, 6)), 10) == [(None, None, None, "chunk_speech_runs_invalid")]


def test_first_chapter_wins(spark):
    schema = "part_id long, pos long, own_part boolean, start_ordinal long, end_ordinal long, last long"
    rows = [(1, 0, True, 4, 6, 9), (1, 1, True, 5, 7, 9), (1, 2, True, 0, 3, 9), (1, 3, False, 8, 9, 9), (1, 4, True, 9, 8, 9), (1, 5, True, 8, 10, 9)]
    found = {r.pos: (r.reason, r.number) for r in folds.first_wins(spark.createDataFrame(rows, schema)).collect()}
    assert found == {0: (None, 1), 1: ("overlap", None), 2: (None, 0), 3: ("foreign_part", None), 4: ("inverted", None), 5: ("unknown_ordinal", None)}
