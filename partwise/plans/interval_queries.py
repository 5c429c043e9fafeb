"""Queries of the interval and coverage operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partwise.operators import alignment as al
from partwise.operators import intervals as iv
from partwise.operators import speech as sp
from partwise.operators import tracks as tr
from partwise.plans import inputs
from partwise.plans.inputs import HOURS_6, sql
from partwise.plans.registry import query


def _envelope(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min("start_t").alias("start_t"), F.max("end_t").alias("end_t"))


_USABLE = iv.union_sql("(SELECT user_id AS part_id, start_t, end_t FROM ev )", "part_id")


def _users(spark, sf_dir) -> DataFrame:
    return inputs._events(spark, sf_dir).select(F.col("user_id").alias("part_id"), "start_t", "end_t")


def _usable(spark, sf_dir) -> DataFrame:
    return iv.union(_users(spark, sf_dir), "part_id")


@query(sql(f"SELECT * FROM {iv.union_sql('packets', 'part_id')}"))
def F01_interval_union(spark, sf_dir):
    """Minimal cover of each part's packets."""
    return iv.union(inputs.packets(spark, sf_dir), "part_id")


@query(sql(f"SELECT part_id, start_t, end_t FROM {iv.subtract_sql('(SELECT part_id, start_t, end_t FROM vad )', 'captions', 'part_id')}"))
def F02_interval_subtract(spark, sf_dir):
    """Speech and silence intervals without the captions."""
    return iv.carve(inputs.vad(spark, sf_dir).drop("state"), inputs.captions(spark, sf_dir), ["part_id"])


_GAPS = """(SELECT part_id, stream_index, reach AS start_t, start_t AS end_t FROM (SELECT part_id, stream_index, start_t,
    max(end_t) OVER (PARTITION BY part_id, stream_index ORDER BY start_t, end_t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM packets ) WHERE reach < start_t)"""


@query(sql("SELECT part_id, stream_index, min(start_t) AS start_t, max(end_t) AS end_t, 'complete' AS state FROM packets GROUP BY part_id, stream_index"))
def D01_stream_coverage(spark, sf_dir):
    """Envelope of each stream."""
    return iv.coverage(inputs.packets(spark, sf_dir), "part_id", "stream_index")


@query(sql(f"SELECT * FROM {_GAPS}"))
def E01_coverage_gaps(spark, sf_dir):
    """Gaps within each stream's coverage."""
    return iv.gaps(inputs.packets(spark, sf_dir), "part_id", "stream_index")


_ALL_GAPS = f"SELECT * FROM {_GAPS} UNION ALL SELECT part_id, stream_index, max(end_t) - 1000, max(end_t) + 1000 FROM packets WHERE stream_index % 13 = 5 GROUP BY ALL"


@query(sql(f"""SELECT part_id, stream_index, start_t, end_t, NULL AS reason FROM {iv.subtract_sql('(SELECT part_id, stream_index, min(start_t) AS start_t, max(end_t) AS end_t FROM packets WHERE stream_index % 13 <> 5 GROUP BY ALL)', _GAPS, 'part_id, stream_index')}
    UNION ALL SELECT DISTINCT part_id, stream_index, NULL::BIGINT, NULL::BIGINT, 'audio_coverage_invalid' FROM packets WHERE stream_index % 13 = 5"""))
def F03_usable_audio(spark, sf_dir):
    """Each stream's coverage minus its gaps; a gap beyond the coverage (made up for some streams) refuses the stream."""
    packets = inputs.packets(spark, sf_dir)
    keys = ["part_id", "stream_index"]
    coverage = _envelope(packets, *keys)
    beyond = coverage.where("stream_index % 13 = 5").select(*keys, (F.col("end_t") - 1000).alias("start_t"), (F.col("end_t") + 1000).alias("end_t"))
    return sp.usable_audio(coverage, iv.gaps(packets, *keys).unionByName(beyond), *keys)


@query(sql(f"SELECT part_id, start_t - min(start_t) OVER (PARTITION BY part_id) AS start_t, end_t - min(start_t) OVER (PARTITION BY part_id) AS end_t FROM {iv.union_sql('packets', 'part_id')}"))
def D02_playback_coverage(spark, sf_dir):
    """Usable intervals over all streams of a part, from the part's own zero."""
    return iv.from_own_start(inputs.packets(spark, sf_dir), "part_id")



_TRACKED = "SELECT * FROM captions WHERE part_id % 8 <> 5"


@query(sql(f"""SELECT part_id // 10 AS collection, part_id, coalesce(sum(covered), 0)::BIGINT AS covered, sum(playback)::BIGINT AS playback FROM (
    SELECT part_id, NULL::BIGINT AS covered, end_t - start_t AS playback FROM {_USABLE} UNION ALL SELECT part_id, end_t - start_t, NULL FROM {iv.union_sql('tracked', 'part_id')})
    GROUP BY ROLLUP (part_id // 10, part_id)""", tracked=_TRACKED))
def D03_caption_time_coverage(spark, sf_dir):
    """Caption time and playback time of each part, of each collection (part null) and of all, as exact ratios; some parts have no selected track."""
    users = _users(spark, sf_dir)
    parts = users.select(F.floor(F.col("part_id") / 10).alias("collection"), "part_id")
    return tr.caption_coverage(parts, users, inputs.captions(spark, sf_dir).where("part_id % 8 <> 5"), "collection", "part_id")


@query(sql("SELECT part_id, min(start_t) AS start_t, max(end_t) AS end_t FROM cues GROUP BY part_id"))
def D05_caption_envelope(spark, sf_dir):
    """First start and last end of each part's cues."""
    return iv.envelope(inputs.cues(spark, sf_dir), "part_id")



_LATE = "CASE WHEN part_id % 6 = 1 AND source_ordinal % 4 = 3 THEN 10000000 ELSE 0 END"


@query(sql(f"""SELECT c.part_id, c.source_ordinal, CASE WHEN c.e_t <= e.last_t THEN c.s_t - e.origin + e.offset_t END AS start_t, CASE WHEN c.e_t <= e.last_t THEN c.e_t - e.origin + e.offset_t END AS end_t,
    CASE WHEN c.e_t > e.last_t THEN 'part_relative_out_of_coverage' END AS reason FROM (SELECT part_id, source_ordinal, start_t + {_LATE} AS s_t, end_t + {_LATE} AS e_t FROM cues ) c JOIN (
    SELECT part_id, origin, origin + dur AS last_t, coalesce(sum(dur) OVER (PARTITION BY part_id // 10 ORDER BY part_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS offset_t
    FROM (SELECT part_id, min(start_t) AS origin, max(end_t) - min(start_t) AS dur FROM cues GROUP BY part_id)) e USING (part_id)"""))
def E02_collection_timeline(spark, sf_dir):
    """Cue times on their collection's timeline: a part starts where the parts before it end; times beyond a part are refused."""
    cues = inputs.cues(spark, sf_dir)
    parts = _envelope(cues, "part_id").select(F.floor(F.col("part_id") / 10).alias("collection"), "part_id", F.col("part_id").alias("part_pos"), "start_t", "end_t")
    late = cues.withColumn("start_t", F.col("start_t") + F.expr(_LATE)).withColumn("end_t", F.col("end_t") + F.expr(_LATE))
    return tr.collection_times(late, parts).select("part_id", "source_ordinal", "start_t", "end_t", "reason")


_OVER = "part_id % 17 = 3"
_SEGMENTS = f"SELECT part_id, start_t, end_t, state FROM vad WHERE NOT {_OVER} UNION ALL SELECT user_id, start_t, end_t, 'speech_likely' FROM ev WHERE user_id % 17 = 3"
_PARTITION = f"""(SELECT part_id, state, start_t, end_t FROM vad WHERE NOT {_OVER} UNION ALL SELECT part_id, 'indeterminate', start_t, end_t FROM {iv.subtract_sql(f"(SELECT * FROM {_USABLE} WHERE NOT {_OVER})", 'vad', 'part_id')})"""
_WHOLE = iv.union_sql(_PARTITION, "part_id, state")
_REFUSED = "(SELECT part_id FROM (SELECT *, max(end_t) OVER (PARTITION BY part_id ORDER BY start_t, end_t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (SELECT user_id AS part_id, start_t, end_t FROM ev WHERE user_id % 17 = 3 AND start_t < end_t)) GROUP BY part_id HAVING bool_or(start_t < reach))"
_CLEAN = "(SELECT part_id, 'speech_likely' AS state, start_t, end_t FROM " + iv.union_sql("(SELECT user_id AS part_id, start_t, end_t FROM ev WHERE user_id % 17 = 3)", "part_id") + f" WHERE part_id NOT IN {_REFUSED})"


def _activity(spark, sf_dir) -> DataFrame:
    """Segments as a detector gives them; in some parts they overlap."""
    wrong = _users(spark, sf_dir).where(_OVER).withColumn("state", F.lit("speech_likely"))
    return inputs.vad(spark, sf_dir).where(f"not {_OVER}").unionByName(wrong)


def _partition(spark, sf_dir) -> DataFrame:
    return sp.vad_partition(_usable(spark, sf_dir), _activity(spark, sf_dir), "part_id")


@query(sql(f"SELECT part_id, state, start_t, end_t, NULL AS reason FROM {_WHOLE} UNION ALL SELECT part_id, state, start_t, end_t, NULL FROM {_CLEAN} UNION ALL SELECT part_id, NULL, NULL::BIGINT, NULL::BIGINT, 'model_output_invalid' FROM {_REFUSED}"))
def F04_vad_partition(spark, sf_dir):
    """Usable audio as speech, silence and indeterminate rest, equal neighbours merged; overlapping segments refuse a part."""
    return _partition(spark, sf_dir)


_USER_GAPS = """(SELECT part_id, reach AS start_t, start_t AS end_t, 'gap' AS state FROM (SELECT user_id AS part_id, start_t, max(end_t) OVER (PARTITION BY user_id ORDER BY start_t, end_t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ev ) WHERE reach < start_t)"""
_OPEN = f"(SELECT part_id, state, start_t, end_t FROM {_WHOLE} WHERE state <> 'non_speech' UNION ALL SELECT part_id, state, start_t, end_t FROM {_CLEAN} UNION ALL SELECT part_id, state, start_t, end_t FROM {_USER_GAPS})"


@query(sql(f"SELECT part_id, CASE WHEN state = 'speech_likely' THEN 'uncovered_speech' ELSE 'audio_state_indeterminate' END AS risk, start_t, end_t, state = 'speech_likely' AND end_t - start_t > 36000000000 AS elevated FROM {iv.subtract_sql(_OPEN, 'captions', 'part_id', 'state, ')}"))
def F05_uncovered_speech_risk(spark, sf_dir):
    """Speech, indeterminate audio and gaps without captions; long speech is elevated."""
    return sp.uncovered_risk(_partition(spark, sf_dir), iv.gaps(_users(spark, sf_dir), "part_id"), inputs.captions(spark, sf_dir), 36_000_000_000, "part_id")


@query(sql(f"SELECT part_id, start_t, end_t FROM {_WHOLE} WHERE state = 'non_speech' AND end_t - start_t > 18000000000"))
def F06_long_silences(spark, sf_dir):
    """Silences longer than five hours."""
    return sp.long_silences(_partition(spark, sf_dir), 18_000_000_000).select("part_id", "start_t", "end_t")


_SPEECH = "(SELECT part_id, start_t, end_t FROM vad WHERE state = 'speech_likely')"


@query(sql(f"SELECT part_id, start_t, end_t FROM {iv.subtract_sql(_SPEECH, 'captions', 'part_id')} WHERE end_t - start_t >= 3600000000"))
def F07_textless_speech(spark, sf_dir):
    """Pieces of speech of an hour or more that no cue covers."""
    speech = inputs.vad(spark, sf_dir).where("state = 'speech_likely'").drop("state")
    return sp.textless_speech(speech, inputs.captions(spark, sf_dir), 3_600_000_000, "part_id")


_DECISION = "CASE WHEN part_id % 4 = 0 THEN 'full_length_review_requested' WHEN part_id % 4 = 3 AND part_id % 5 = 0 THEN 'yes' END"


@query(sql(f"""SELECT part_id, start_t, end_t, 'suspicious_intervals' AS scope, NULL AS reason FROM {iv.union_sql('captions', 'part_id')} WHERE ({_DECISION}) IS NULL
    UNION ALL SELECT part_id, CASE WHEN d LIKE 'full%' THEN lo END, CASE WHEN d LIKE 'full%' THEN hi END, CASE WHEN d LIKE 'full%' THEN 'full_length' END, CASE WHEN d = 'yes' THEN 'review_scope_invalid' END
    FROM (SELECT part_id, {_DECISION} AS d, lo, hi FROM (SELECT user_id AS part_id, min(start_t) AS lo, max(end_t) AS hi FROM ev GROUP BY user_id)) WHERE d IS NOT NULL"""))
def F08_review_windows(spark, sf_dir):
    """Suspicious intervals merged; a part as a whole by the one decision for it; other decisions refused."""
    parts = _envelope(_users(spark, sf_dir), "part_id").withColumn("decision", F.expr(_DECISION))
    return sp.review_windows(inputs.captions(spark, sf_dir), parts, "part_id")


# Window probabilities: each event is one window of 512 samples, its value the probability in percent.
_WINDOWS = "(SELECT user_id AS part_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) * 512 AS start_t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) * 512 AS end_t, value FROM ev )"
_LOUD = f"(SELECT part_id, start_t, end_t FROM {_WINDOWS} WHERE value >= 40)"
_RUNS = f"""{iv.union_sql(f"(SELECT part_id, greatest(start_t - 256, 0) AS start_t, least(end_t + 256, total) AS end_t FROM {iv.union_sql(_LOUD, 'part_id', 1024)} JOIN (SELECT part_id, max(end_t) AS total FROM {_WINDOWS} GROUP BY part_id) USING (part_id) WHERE end_t - start_t >= 1536)", 'part_id')}"""


def _windows(spark, sf_dir) -> DataFrame:
    rn = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return inputs._events(spark, sf_dir).select(F.col("user_id").alias("part_id"), ((rn - 1) * 512).cast("long").alias("start_t"), (rn * 512).cast("long").alias("end_t"), "value")


@query(sql(f"SELECT * FROM {_RUNS}"))
def F09_speech_runs(spark, sf_dir):
    """Loud windows as runs: merged over short silence, short ones dropped, padded, clamped and merged again."""
    return sp.speech_runs(_windows(spark, sf_dir), "part_id", 40, 1024, 1536, 256)


@query(sql(f"""SELECT part_id, start_t, end_t, 'speech_likely' AS state FROM {_RUNS} WHERE part_id % 9 <> 0 UNION ALL SELECT part_id, start_t, end_t, 'non_speech' FROM {iv.subtract_sql(f'(SELECT part_id, 0 AS start_t, max(end_t) AS end_t FROM {_WINDOWS} WHERE part_id % 9 <> 0 GROUP BY part_id)', _RUNS, 'part_id')}
    UNION ALL SELECT part_id, 0, max(end_t), 'indeterminate' FROM {_WINDOWS} WHERE part_id % 9 = 0 GROUP BY part_id"""))
def F10_speech_tiles(spark, sf_dir):
    """Speech runs and the silence between them over the whole sample range; parts without calibration are indeterminate."""
    whole = _windows(spark, sf_dir).groupBy("part_id").agg(F.lit(0).cast("long").alias("start_t"), F.max("end_t").alias("end_t")).withColumn("calibrated", F.col("part_id") % 9 != 0)
    runs = F09_speech_runs(spark, sf_dir).join(whole.where("calibrated").select("part_id"), "part_id", "left_semi")
    return sp.speech_tiles(runs, whole, "part_id")


_SILENT = "(SELECT part_id, start_t, end_t FROM vad WHERE state = 'non_speech')"


@query(sql(f"SELECT c.part_id, c.cue_id, greatest(c.start_t, v.start_t) AS start_t, least(c.end_t, v.end_t) AS end_t FROM captions c JOIN {_SILENT} v ON c.part_id = v.part_id AND v.start_t < c.end_t AND c.start_t < v.end_t WHERE least(c.end_t, v.end_t) - greatest(c.start_t, v.start_t) >= 3600000000"))
def C02_text_over_silence(spark, sf_dir):
    """Every overlap of a cue and a silence of an hour or more."""
    silent = inputs.vad(spark, sf_dir).where("state = 'non_speech'").drop("state")
    return sp.text_over_silence(inputs.captions(spark, sf_dir), silent, 3_600_000_000, ["part_id"], HOURS_6)


_TURNS = "SELECT part_id, cue_id, start_t, end_t + CASE WHEN part_id % 19 = 4 AND cue_id % 50 = 7 THEN 10000000000000 ELSE 0 END AS end_t, cue_id % 100 AS confidence FROM captions "


@query(sql(f"""SELECT part_id, cue_id, conflicts, states, CASE WHEN bool_or(NOT inside) OVER (PARTITION BY part_id) THEN 'model_output_invalid' WHEN conflicts > 0 THEN 'conflict' WHEN confidence >= 40 THEN 'published' ELSE 'dropped' END AS outcome FROM (
    SELECT t.part_id, t.cue_id, count(v.state) AS conflicts, coalesce(string_agg(DISTINCT v.state, ',' ORDER BY v.state), '') AS states, any_value(t.confidence) AS confidence,
      EXISTS (SELECT 1 FROM {_USABLE} u WHERE u.part_id = t.part_id AND u.start_t <= t.start_t AND t.end_t <= u.end_t AND u.start_t < t.end_t AND t.start_t < u.end_t) AS inside
    FROM turns t LEFT JOIN (SELECT * FROM vad WHERE state <> 'speech_likely') v ON t.part_id = v.part_id AND v.start_t < t.end_t AND t.start_t < v.end_t GROUP BY t.part_id, t.cue_id, t.start_t, t.end_t)""", turns=_TURNS))
def C03_speaker_vad_conflict(spark, sf_dir):
    """Turns over anything but speech conflict; others are published if confident; one outside usable audio refuses its part."""
    far = F.when((F.col("part_id") % 19 == 4) & (F.col("cue_id") % 50 == 7), 10_000_000_000_000).otherwise(0)
    turns = inputs.captions(spark, sf_dir).withColumn("end_t", F.col("end_t") + far).withColumn("confidence", F.col("cue_id") % 100)
    return sp.turn_gate(turns, inputs.vad(spark, sf_dir), _usable(spark, sf_dir), "part_id", "cue_id", HOURS_6, 40)


_CHUNKS = "(SELECT part_id, start_t, end_t, row_number() OVER (PARTITION BY part_id ORDER BY start_t) AS chunk FROM " + iv.union_sql("(SELECT user_id AS part_id, start_t, start_t + (end_t - start_t) // 2 AS end_t FROM ev )", "part_id") + ")"


_ASSIGNED = f"SELECT c.part_id, c.cue_id, c.start_t, c.end_t, min(k.chunk) AS chunk, min(k.start_t) AS chunk_start, min(k.end_t) AS chunk_end FROM captions c LEFT JOIN {_CHUNKS} k ON c.part_id = k.part_id AND k.start_t <= c.start_t AND c.end_t <= k.end_t AND k.start_t < c.end_t AND c.start_t < k.end_t GROUP BY c.part_id, c.cue_id, c.start_t, c.end_t"
_SAMPLED = """SELECT a.*, lo, total, greatest(round_even((start_t - lo) / 125.0, 0)::BIGINT - 1600, round_even((chunk_start - lo) / 125.0, 0)::BIGINT) AS ws, least(round_even((end_t - lo) / 125.0, 0)::BIGINT + 1600, round_even((chunk_end - lo) / 125.0, 0)::BIGINT) AS we
    FROM assigned a JOIN (SELECT user_id AS part_id, min(start_t) AS lo, round_even((max(end_t) - min(start_t)) / 250.0, 0)::BIGINT AS total FROM ev GROUP BY user_id) USING (part_id)"""
_PLACED = "SELECT *, chunk IS NOT NULL AND we > ws AS whole, least(greatest(ws + 2000 * (cue_id % 4), 0), total) AS pa, least(greatest(ws + 2000 * (cue_id % 4) + 4000 * (cue_id % 3), 0), total) AS pb FROM sampled "


@query(sql("""SELECT part_id, cue_id, chunk, CASE WHEN whole THEN ws END AS window_start, CASE WHEN whole THEN we END AS window_end, CASE WHEN placed THEN lo + pa * 125 ELSE start_t END AS start_t, CASE WHEN placed THEN lo + pb * 125 ELSE end_t END AS end_t, CASE WHEN placed THEN 0.75 ELSE 0.0 END::DOUBLE AS confidence
    FROM (SELECT *, whole AND cue_id % 3 <> 0 AND pb > pa AS placed FROM placed_at )""", assigned=_ASSIGNED, sampled=_SAMPLED, placed_at=_PLACED))
def C09_assign_cues_to_chunks(spark, sf_dir):
    """The chunk that contains a cue wholly, the padded window within it, and a proposal for each cue: one without a place keeps its time at confidence 0."""
    half = _users(spark, sf_dir).withColumn("end_t", F.expr("start_t + (end_t - start_t) div 2"))
    chunks = iv.union(half, "part_id").withColumn("chunk", F.row_number().over(Window.partitionBy("part_id").orderBy("start_t")))
    spans = _users(spark, sf_dir).groupBy("part_id").agg(F.min("start_t").alias("lo"), F.bround((F.max("end_t") - F.min("start_t")).cast("decimal(20,0)") / 250, 0).cast("long").alias("total"))
    held = al.assign_to_chunks(inputs.captions(spark, sf_dir), chunks, ["part_id"], "chunk").join(spans, "part_id")
    first = (F.col("cue_id") % 4 * 0.25).alias("start")
    items = held.withColumns({"items": F.array(F.struct(first, (first + F.col("cue_id") % 3 * 0.5).alias("end")), F.struct(F.lit(-1.0).alias("start"), F.lit(9.0).alias("end"))), "sure": F.lit(0.75)})
    found = al.proposals(al.alignment_windows(items, "lo", 8000, 1_000_000, 1600), "items", "total", "lo", 8000, 1_000_000, "sure")
    return found.select("part_id", "cue_id", "chunk", "window_start", "window_end", F.col("proposed_start").alias("start_t"), F.col("proposed_end").alias("end_t"), F.col("proposed_confidence").alias("confidence"))


@query(sql(f"""SELECT c.part_id, c.cue_id, coalesce(string_agg(CASE WHEN v.start_t IS NOT NULL THEN round_even((greatest(c.start_t, v.start_t) - v0.lo) * 16 / 1000.0, 0)::BIGINT::VARCHAR || '-' || round_even((least(c.end_t, v.end_t) - v0.lo) * 16 / 1000.0, 0)::BIGINT::VARCHAR END, ',' ORDER BY greatest(c.start_t, v.start_t), least(c.end_t, v.end_t)), '') AS windows, count(v.start_t) = 0 AS empty
    FROM captions c JOIN (SELECT user_id AS part_id, min(start_t) AS lo FROM ev GROUP BY user_id) v0 ON v0.part_id = c.part_id LEFT JOIN {_SPEECH} v ON c.part_id = v.part_id AND v.start_t < c.end_t AND c.start_t < v.end_t GROUP BY c.part_id, c.cue_id"""))
def C16_trim_to_speech(spark, sf_dir):
    """Each review window cut to the speech in it, as sorted sample windows; windows without speech stay, empty."""
    cues, speech = inputs.captions(spark, sf_dir), inputs.vad(spark, sf_dir).where("state = 'speech_likely'").drop("state")
    origin = _users(spark, sf_dir).groupBy("part_id").agg(F.min("start_t").alias("lo"))
    return tr.trimmed(cues, speech, origin, "part_id", "cue_id", HOURS_6, 1_000_000, 16_000)


@query(sql(f"""SELECT part_id, first_reason AS reason, bad FROM (SELECT part_id, count(reason) AS bad, arg_min(reason, cue_id) FILTER (reason IS NOT NULL) AS first_reason FROM (
    SELECT c.part_id, c.cue_id, CASE WHEN c.start_t < e.start_t OR c.end_t > e.end_t THEN 'cue_out_of_coverage' WHEN bool_or(g.start_t IS NOT NULL) THEN 'cue_crosses_coverage_gap' END AS reason
    FROM captions c JOIN (SELECT user_id AS part_id, min(start_t) AS start_t, max(end_t) - 72000000000 AS end_t FROM ev GROUP BY user_id) e ON c.part_id = e.part_id
    LEFT JOIN (SELECT part_id, start_t - 60000000 AS start_t, end_t FROM {_USER_GAPS}) g ON g.part_id = c.part_id AND g.start_t < c.end_t AND c.start_t < g.end_t WHERE c.part_id % 23 <> 1 GROUP BY c.part_id, c.cue_id, c.start_t, c.end_t, e.start_t, e.end_t) GROUP BY part_id)
    UNION ALL SELECT part_id, 'coverage_indeterminate', count(*) FROM captions WHERE part_id % 23 = 1 GROUP BY part_id"""))
def C01_cue_coverage_check(spark, sf_dir):
    """A track is refused as a whole for its first cue outside the coverage or across a gap, or without known coverage."""
    users = _users(spark, sf_dir)
    envelope = users.groupBy("part_id").agg(F.min("start_t").alias("start_t"), (F.max("end_t") - 72_000_000_000).alias("end_t")).where("part_id % 23 <> 1")
    gaps = iv.gaps(users, "part_id").withColumn("start_t", F.col("start_t") - 60_000_000)
    return tr.coverage_check(inputs.captions(spark, sf_dir), envelope, gaps, "part_id", "cue_id", HOURS_6)


_WANTED = "(SELECT part_id, start_t, end_t, row_number() OVER (PARTITION BY part_id ORDER BY start_t) AS interval_id FROM " + iv.union_sql("(SELECT user_id AS part_id, start_t, start_t + (end_t - start_t) * 2 // 3 AS end_t FROM ev )", "part_id") + ")"


#: ASR cues as they come, in order of time; some are repeated numbers, some are blank, some run beyond the subtitles.
_HEARD = "SELECT part_id, cue_id, start_t, end_t + CASE WHEN cue_id % 37 = 5 THEN 800000000000000 ELSE 0 END AS end_t, CASE WHEN cue_id % 31 = 7 THEN 0 ELSE row_number() OVER (PARTITION BY part_id ORDER BY start_t, cue_id) END AS ordinal, row_number() OVER (PARTITION BY part_id ORDER BY start_t, cue_id) AS pos, (cue_id % 29 <> 0)::BIGINT AS visible FROM captions "
_CANDIDATES = "SELECT h.*, row_number() OVER (PARTITION BY h.part_id ORDER BY pos) AS rn FROM heard h JOIN (SELECT user_id AS part_id, min(start_t) AS c_start, max(end_t) AS c_end FROM ev GROUP BY user_id) e ON h.part_id = e.part_id AND h.start_t >= c_start AND h.end_t <= c_end"
_JUDGED = """SELECT part_id, 0::BIGINT AS rn, NULL::BIGINT AS cue_id, NULL::BIGINT AS start_t, NULL::BIGINT AS end_t, NULL::VARCHAR AS reason, NULL::BIGINT AS lo, NULL::BIGINT AS ls, NULL::BIGINT AS le FROM (SELECT DISTINCT part_id FROM candidates )
    UNION ALL SELECT n.part_id, n.rn, n.cue_id, n.start_t, n.end_t, n.reason, CASE WHEN n.reason IS NULL THEN n.ordinal ELSE n.lo END, CASE WHEN n.reason IS NULL THEN n.start_t ELSE n.ls END, CASE WHEN n.reason IS NULL THEN n.end_t ELSE n.le END FROM (
      SELECT o.*, f.lo, f.ls, f.le, CASE WHEN f.lo IS NOT NULL AND (o.ordinal <= f.lo OR o.start_t < f.ls) THEN 'non_monotonic' WHEN f.lo IS NOT NULL AND o.start_t < f.le THEN 'processing_duplication' WHEN o.visible = 0 THEN 'missing_text'
        WHEN o.end_t - o.start_t > 4000000000000 THEN 'duration_implausible' END AS reason FROM judged f JOIN candidates o ON o.part_id = f.part_id AND o.rn = f.rn + 1) n"""


@query(sql(f"""SELECT i.part_id, i.interval_id, CASE WHEN bool_or(a.reason IS NOT NULL) THEN 'asr_cues_failed_gates' WHEN count(a.cue_id) > 0 THEN 'asr_cues_passed_gates' ELSE 'no_asr_candidate' END AS reason,
      count(a.cue_id) FILTER (a.reason IS NULL) AS admitted, count(a.cue_id) FILTER (a.reason IS NOT NULL) AS rejected,
      (SELECT count(*) FROM (SELECT user_id AS part_id, start_t, end_t FROM ev ) s WHERE s.part_id = i.part_id AND i.start_t <= s.start_t AND s.end_t <= i.end_t AND i.start_t < s.end_t AND s.start_t < i.end_t) AS replaced
    FROM {_WANTED} i LEFT JOIN (SELECT * FROM judged WHERE rn > 0 AND start_t < end_t) a ON a.part_id = i.part_id AND i.start_t <= a.start_t AND a.end_t <= i.end_t GROUP BY i.part_id, i.interval_id, i.start_t, i.end_t""", heard=_HEARD, candidates=_CANDIDATES, judged=_JUDGED).replace("WITH ", "WITH RECURSIVE ", 1))
def C10_interval_replacement(spark, sf_dir):
    """A correction row for each user interval: replaced by its ASR cues, held to the subtitles' envelope and gated, only if there are some and none was refused."""
    users = _users(spark, sf_dir)
    wanted = iv.union(users.withColumn("end_t", F.expr("start_t + (end_t - start_t) * 2 div 3")), "part_id").withColumn("interval_id", F.row_number().over(Window.partitionBy("part_id").orderBy("start_t")))
    c, place = F.col("cue_id"), F.row_number().over(Window.partitionBy("part_id").orderBy("start_t", "cue_id")).cast("long")
    asr = inputs.captions(spark, sf_dir).withColumn("pos", place)
    asr = asr.select("part_id", "cue_id", "pos", F.when(c % 31 == 7, 0).otherwise(F.col("pos")).alias("ordinal"), "start_t", (F.col("end_t") + F.when(c % 37 == 5, 800_000_000_000_000).otherwise(0)).alias("end_t"), (c % 29 != 0).cast("long").alias("visible"))
    subtitles = inputs._events(spark, sf_dir).select(F.col("user_id").alias("part_id"), F.col("event_id").alias("cue_id"), "start_t", "end_t")
    corrections, _ = al.gated_replacement(subtitles, asr, wanted, "cue_id", "interval_id", HOURS_6, 0, 4_000_000_000_000)
    return corrections.select("part_id", "interval_id", "reason", "admitted", "rejected", F.size("replaced_cue_ids").cast("long").alias("replaced"))
