"""Queries of speech, transcription quality and arbitration operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partwise.functions.columns import words
from partwise.operators import audit, folds
from partwise.operators import intervals as iv
from partwise.operators import speech as sp
from partwise.operators import suspicion as su
from partwise.plans import inputs, interval_queries
from partwise.plans.inputs import HOURS_6, sql
from partwise.plans.registry import query

_BLANK = r"'[ \t\n\x0b\f\r]+'"
_WORDS = rf"list_filter(regexp_split_to_array(text, {_BLANK}), lambda x: x <> '')"


def _asr(spark, sf_dir) -> DataFrame:
    """ASR cues in given order, some repeated, backwards or blank."""
    o = F.col("source_ordinal")
    envelope = Window.partitionBy("part_id")
    rows = inputs.cues(spark, sf_dir).withColumns({"c_start": F.min("start_t").over(envelope), "c_end": F.greatest(F.min("start_t").over(envelope), F.max("end_t").over(envelope) - 3000)})
    return rows.select("part_id", o.alias("pos"), F.when(o % 5 == 4, o - 2).otherwise(o).alias("ordinal"), "start_t", "end_t", F.when((F.col("part_id") + o) % 11 == 0, 0).otherwise(F.length(F.regexp_replace("text", r"(?U)\s+", ""))).cast("long").alias("visible"), "c_start", "c_end")


_ASR = rf"""SELECT part_id, source_ordinal AS pos, CASE WHEN source_ordinal % 5 = 4 THEN source_ordinal - 2 ELSE source_ordinal END AS ordinal, start_t, end_t,
    CASE WHEN (part_id + source_ordinal) % 11 = 0 THEN 0 ELSE length(regexp_replace(text, {_BLANK}, '', 'g')) END AS visible, min(start_t) OVER (PARTITION BY part_id) AS c_start, greatest(min(start_t) OVER (PARTITION BY part_id), max(end_t) OVER (PARTITION BY part_id) - 3000) AS c_end FROM cues """


_GATE_ORDER = "SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY pos) AS rn FROM asr "
_GATE_FOLD = """SELECT part_id, 0::BIGINT AS rn, NULL::BIGINT AS ordinal, NULL::VARCHAR AS reason, NULL::BIGINT AS raw_start, NULL::BIGINT AS raw_end, NULL::BIGINT AS lo, NULL::BIGINT AS ls, NULL::BIGINT AS le FROM (SELECT DISTINCT part_id FROM asr )
    UNION ALL SELECT n.part_id, n.rn, n.ordinal, n.reason, n.start_t, n.end_t, CASE WHEN n.reason IS NULL THEN n.ordinal ELSE n.lo END, CASE WHEN n.reason IS NULL THEN n.start_t ELSE n.ls END, CASE WHEN n.reason IS NULL THEN n.end_t ELSE n.le END FROM (
      SELECT o.*, f.lo, f.ls, f.le, CASE WHEN o.start_t < o.c_start OR o.end_t > o.c_end THEN 'out_of_coverage' WHEN f.lo IS NOT NULL AND (o.ordinal <= f.lo OR o.start_t < f.ls) THEN 'non_monotonic'
        WHEN f.lo IS NOT NULL AND o.start_t < f.le THEN 'processing_duplication' WHEN o.visible = 0 THEN 'missing_text' WHEN o.end_t - o.start_t < 20 * o.visible OR o.end_t - o.start_t > 400 * o.visible THEN 'duration_implausible' END AS reason
      FROM fold f JOIN gated o ON o.part_id = f.part_id AND o.rn = f.rn + 1) n"""


_LINE = "SELECT part_id, c_start, coalesce(sum(c_end - c_start) OVER (PARTITION BY part_id // 10 ORDER BY part_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS offset_t FROM (SELECT DISTINCT part_id, c_start, c_end FROM asr )"


@query(sql("""SELECT part_id, ordinal, reason, raw_start, raw_end, CASE WHEN reason IS NULL THEN raw_start - c_start END AS part_start, CASE WHEN reason IS NULL THEN raw_end - c_start END AS part_end,
    CASE WHEN reason IS NULL THEN raw_start - c_start + offset_t END AS collection_start, CASE WHEN reason IS NULL THEN raw_end - c_start + offset_t END AS collection_end FROM fold JOIN line USING (part_id) WHERE rn > 0""",
    asr=_ASR, gated=_GATE_ORDER, fold=_GATE_FOLD, line=_LINE).replace("WITH ", "WITH RECURSIVE ", 1))
def E10_asr_monotonic_gate(spark, sf_dir):
    """ASR cues gated in order against the last admitted one, each in raw, part and collection time."""
    cues = _asr(spark, sf_dir)
    parts = cues.groupBy("part_id").agg(F.min("c_start").alias("start_t"), F.min("c_end").alias("end_t")).select(F.floor(F.col("part_id") / 10).alias("collection"), "part_id", F.col("part_id").alias("part_pos"), "start_t", "end_t")
    return folds.gate_on_timeline(cues, parts).drop("pos")


_ORDERED = f"SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY start_t) AS rn, max(end_t - start_t) OVER (PARTITION BY part_id) AS longest FROM {interval_queries._RUNS}"
_PACK = """SELECT part_id, 0::BIGINT AS rn, -1::BIGINT AS chunk, NULL::BIGINT AS first_t, NULL::BIGINT AS start_t, NULL::BIGINT AS end_t FROM (SELECT DISTINCT part_id FROM ordered WHERE longest <= 16384)
    UNION ALL SELECT o.part_id, o.rn, CASE WHEN o.end_t - f.first_t <= 16384 THEN f.chunk ELSE f.chunk + 1 END, CASE WHEN o.end_t - f.first_t <= 16384 THEN f.first_t ELSE o.start_t END, o.start_t, o.end_t FROM pack f JOIN ordered o ON o.part_id = f.part_id AND o.rn = f.rn + 1"""


@query(sql("""SELECT part_id, chunk, min(start_t) AS start_t, max(end_t) AS end_t, count(*) AS runs, NULL AS error FROM pack WHERE rn > 0 GROUP BY part_id, chunk
    UNION ALL SELECT DISTINCT part_id, 0, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, 'chunk_window_exceeded' FROM ordered WHERE longest > 16384""", ordered=_ORDERED, pack=_PACK).replace("WITH ", "WITH RECURSIVE ", 1))
def F11_speech_chunks(spark, sf_dir):
    """Speech runs packed into chunks of bounded length."""
    return folds.pack_chunks(interval_queries.F09_speech_runs(spark, sf_dir), 16_384)


_CHAPTERS = """SELECT part_id, source_ordinal AS pos, (part_id + source_ordinal) % 13 <> 0 AS own_part, source_ordinal * 3 % 5 AS s, source_ordinal * 3 % 5 + source_ordinal % 3 - (source_ordinal % 7 = 6)::INT * 2 AS e, max(source_ordinal) OVER (PARTITION BY part_id) AS last, row_number() OVER (PARTITION BY part_id ORDER BY source_ordinal) AS rn FROM cues """
_TAKING = """SELECT part_id, 0::BIGINT AS rn, 0::BIGINT AS pos, 0::BIGINT AS s, 0::BIGINT AS e, NULL::VARCHAR AS reason, []::BIGINT[] AS ss, []::BIGINT[] AS es FROM (SELECT DISTINCT part_id FROM chapters )
    UNION ALL SELECT part_id, rn, pos, s, e, reason, CASE WHEN reason IS NULL THEN list_append(ss, s) ELSE ss END, CASE WHEN reason IS NULL THEN list_append(es, e) ELSE es END FROM (
      SELECT c.part_id, c.rn, c.pos, c.s, c.e, t.ss, t.es, CASE WHEN NOT c.own_part THEN 'foreign_part' WHEN c.s > c.e THEN 'inverted' WHEN c.s < 0 OR c.e > c.last THEN 'unknown_ordinal' WHEN len(list_filter(range(1, len(t.ss) + 1), lambda k: c.s <= t.es[k] AND t.ss[k] <= c.e)) > 0 THEN 'overlap' END AS reason
      FROM taking t JOIN chapters c ON c.part_id = t.part_id AND c.rn = t.rn + 1)"""


@query(sql("SELECT part_id, pos, s AS start_ordinal, e AS end_ordinal, reason, CASE WHEN reason IS NULL THEN row_number() OVER (PARTITION BY part_id, reason IS NULL ORDER BY s) - 1 END AS number FROM taking WHERE rn > 0", chapters=_CHAPTERS, taking=_TAKING).replace("WITH ", "WITH RECURSIVE ", 1))
def E12_chapter_first_wins(spark, sf_dir):
    """Chapters in given order, later overlapping ones refused."""
    rows = inputs.cues(spark, sf_dir).withColumn("last", F.max("source_ordinal").over(Window.partitionBy("part_id")))
    o = F.col("source_ordinal")
    return folds.first_wins(rows.select("part_id", o.alias("pos"), ((F.col("part_id") + o) % 13 != 0).alias("own_part"), (o * 3 % 5).alias("start_ordinal"), (o * 3 % 5 + o % 3 - (o % 7 == 6).cast("int") * 2).alias("end_ordinal"), "last"))



@query(sql("SELECT part_id, row_number() OVER (PARTITION BY part_id ORDER BY source_ordinal) - 1 AS ordinal, source_ordinal AS chunk FROM cues WHERE trim(text) <> ''"))
def F12_assemble_asr_cues(spark, sf_dir):
    """Chunks with visible text as cues, numbered without holes."""
    return sp.assembled(inputs.cues(spark, sf_dir).withColumnRenamed("source_ordinal", "chunk"), "part_id", "chunk").select("part_id", "ordinal", "chunk")


@query(sql("""SELECT part_id, CASE WHEN wanted IS NULL AND n = 1 THEN one WHEN wanted IS NOT NULL AND list_contains(open, wanted) THEN wanted END AS stream_index,
    CASE WHEN wanted IS NULL AND n = 0 THEN 'audio_stream_unavailable' WHEN wanted IS NULL AND n > 1 THEN 'awaiting_audio_stream_selection' WHEN wanted IS NOT NULL AND NOT list_contains(open, wanted) THEN 'audio_stream_selection_invalid' ELSE 'selected' END AS state FROM (
    SELECT part_id, CASE WHEN part_id % 3 = 0 THEN part_id WHEN part_id % 3 = 1 AND part_id % 2 = 0 THEN -7 END AS wanted, coalesce(list(stream_index) FILTER (open), []) AS open, count(*) FILTER (open) AS n, min(stream_index) FILTER (open) AS one
    FROM (SELECT DISTINCT part_id, stream_index, part_id % 5 <> 2 AND (part_id % 5 <> 1 OR stream_index < 50) AS open FROM packets ) GROUP BY part_id)"""))
def D20_select_audio_stream(spark, sf_dir):
    """The one audio stream of each part, or the requested one, or why there is none."""
    streams = iv.coverage(inputs.packets(spark, sf_dir), "part_id", "stream_index").withColumn("codec_type", F.expr("case when part_id % 5 <> 2 and (part_id % 5 <> 1 or stream_index < 50) then 'audio' else 'video' end"))
    requests = streams.select("part_id", F.expr("case when part_id % 3 = 0 then part_id when part_id % 3 = 1 and part_id % 2 = 0 then -7 end").alias("wanted")).where("wanted is not null").distinct()
    return sp.select_audio_stream(streams, streams, requests, "part_id")



@query(sql("SELECT part_id, min(start_t) AS start_t, max(end_t) AS end_t FROM packets WHERE stream_index = part_id GROUP BY part_id"))
def D21_part_video_coverage(spark, sf_dir):
    """Envelope of the first video stream of each part."""
    return sp.first_stream_coverage(iv.coverage(inputs.packets(spark, sf_dir), "part_id", "stream_index"), "part_id", "stream_index")



@query(sql("SELECT part_id, cue_id, printf('part-%02d:speaker-%02d', part_id, dense_rank() OVER (PARTITION BY part_id ORDER BY cue_id % 7)) AS label FROM captions "))
def E09_speaker_labels(spark, sf_dir):
    """Labels by the rank of a cluster within its part."""
    return sp.speaker_labels(inputs.captions(spark, sf_dir).withColumn("cluster", F.col("cue_id") % 7), "part_id", "cluster").select("part_id", "cue_id", "label")


_PROPOSED = """SELECT part_id, source_ordinal, CASE WHEN part_id % 9 = 7 AND source_ordinal = 2 THEN text || 'x' ELSE text END AS text, start_t + (source_ordinal * 37 % 11) * 90 - CASE WHEN part_id % 6 = 5 AND source_ordinal = 3 THEN 20000 ELSE 0 END AS start_t,
    end_t + (source_ordinal * 37 % 11) * 90 - CASE WHEN part_id % 6 = 5 AND source_ordinal = 3 THEN 20000 ELSE 0 END AS end_t, (part_id + source_ordinal) % 10 AS confidence FROM cues """
_ALIGNED = """SELECT c.part_id, c.source_ordinal, c.start_t, c.end_t, p.start_t AS ps, p.end_t AS pe, c.text <> p.text AS differs,
    CASE WHEN p.confidence < 3 THEN 'alignment_low_confidence' WHEN p.end_t - p.start_t < CASE WHEN c.role = 'user' THEN 1500 ELSE 1000 END OR p.end_t - p.start_t > CASE WHEN c.role = 'user' THEN 50000 ELSE 60000 END THEN 'alignment_duration_implausible'
      WHEN NOT EXISTS (SELECT 1 FROM audio u WHERE u.part_id = p.part_id AND u.start_t <= p.start_t AND p.end_t <= u.end_t) THEN 'alignment_out_of_coverage'
      WHEN EXISTS (SELECT 1 FROM heard v WHERE v.part_id = p.part_id AND v.state = 'non_speech' AND v.start_t < p.end_t AND p.start_t < v.end_t) THEN 'alignment_vad_conflict' END AS reason,
    EXISTS (SELECT 1 FROM heard v WHERE v.part_id = p.part_id AND v.state = 'indeterminate' AND v.start_t < p.end_t AND p.start_t < v.end_t) AS unsure FROM cues c JOIN proposed p ON p.part_id = c.part_id AND p.source_ordinal = c.source_ordinal"""
_AUDIO = "SELECT part_id, min(start_t) AS start_t, max(end_t) - 3000 AS end_t FROM cues GROUP BY part_id"
_HEARD = "SELECT part_id, start_t + 10 AS start_t, start_t + (end_t - start_t) // 2 AS end_t, CASE source_ordinal % 8 WHEN 7 THEN 'non_speech' WHEN 5 THEN 'indeterminate' ELSE 'speech_likely' END AS state FROM cues WHERE (end_t - start_t) // 2 > 10"


def _heard(cues: DataFrame) -> DataFrame:
    state = F.when(F.col("source_ordinal") % 8 == 7, "non_speech").when(F.col("source_ordinal") % 8 == 5, "indeterminate").otherwise("speech_likely")
    return cues.where("(end_t - start_t) div 2 > 10").select("part_id", (F.col("start_t") + 10).alias("start_t"), F.expr("start_t + (end_t - start_t) div 2").alias("end_t"), state.alias("state"))


@query(sql("""SELECT part_id, source_ordinal, outcome, CASE WHEN outcome = 'adopted' THEN ps ELSE start_t END AS new_start, CASE WHEN outcome = 'adopted' THEN pe ELSE end_t END AS new_end, outcome = 'adopted' AND unsure AS risk FROM (
    SELECT *, CASE WHEN bool_or(differs) OVER w THEN 'alignment_text_contract_violation' WHEN bool_or(back) OVER w THEN 'alignment_untrusted' ELSE coalesce(reason, 'adopted') END AS outcome FROM (
    SELECT *, coalesce(new < lag(new) OVER (PARTITION BY part_id ORDER BY source_ordinal), false) AS back FROM (SELECT *, CASE WHEN reason IS NULL THEN ps ELSE start_t END AS new FROM aligned )) WINDOW w AS (PARTITION BY part_id))""", proposed=_PROPOSED, audio=_AUDIO, heard=_HEARD, aligned=_ALIGNED))
def C04_alignment_adoption(spark, sf_dir):
    """Proposed times adopted cue by cue by text, confidence, length, coverage and activity; a part whose starts would go backwards reverts as a whole."""
    cues = inputs.cues(spark, sf_dir).withColumn("language", F.col("role"))
    o, part = F.col("source_ordinal"), F.col("part_id")
    shift = (o * 37 % 11) * 90 - F.when((part % 6 == 5) & (o == 3), 20000).otherwise(0)
    proposals = cues.select("part_id", "source_ordinal", F.when((part % 9 == 7) & (o == 2), F.concat("text", F.lit("x"))).otherwise(F.col("text")).alias("text"), (F.col("start_t") + shift).alias("start_t"), (F.col("end_t") + shift).alias("end_t"), ((part + o) % 10).alias("confidence"))
    proposals = proposals.withColumn("confidence", F.col("confidence") / 10)
    audio = cues.groupBy("part_id").agg(F.min("start_t").alias("start_t"), (F.max("end_t") - 3000).alias("end_t"))
    roles = cues.select("language").distinct()
    bounds = roles.select("language", F.when(F.col("language") == "user", 1500).otherwise(1000).alias("shortest"), F.when(F.col("language") == "user", 50000).otherwise(60000).alias("longest"))
    return sp.align(cues, proposals, audio, _heard(cues), bounds, "part_id", 60_000, 0.3)


_SPANS = rf"list_transform(range(1, len({_WORDS}) + 1), lambda i: CASE WHEN strlen({_WORDS}[i]) % 3 = 0 THEN 'a' ELSE 'b' END)"


def _tokens(cues: DataFrame) -> DataFrame:
    """Cues with the tokens and languages that a speech model would give them."""
    tokens = F.transform(words("text"), lambda w, i: F.struct(w.alias("text"), (((i + 1) * 7 + F.col("part_id")) % 10 / 10).alias("confidence")))
    return cues.withColumn("tokens", tokens).withColumn("languages", F.transform(words("text"), lambda w: F.when(F.octet_length(w) % 3 == 0, "a").otherwise("b")))


@query(sql(rf"SELECT part_id, source_ordinal, array_to_string(low, ' ') AS low FROM (SELECT part_id, source_ordinal, list_transform(list_filter(range(1, len(w) + 1), lambda i: (i * 7 + part_id) % 10 < 2), lambda i: w[i]) AS low FROM (SELECT part_id, source_ordinal, {_WORDS} AS w FROM cues )) WHERE len(low) > 0"))
def G01_low_confidence_tokens(spark, sf_dir):
    """Cues with tokens below a confidence of 0.2, and these tokens."""
    rows = _tokens(inputs.cues(spark, sf_dir)).withColumn("low", su.low_tokens(F.col("tokens"), 0.2))
    return rows.where(F.size("low") > 0).select("part_id", "source_ordinal", F.array_join("low", " ").alias("low"))



@query(sql(rf"SELECT part_id, source_ordinal, switches FROM (SELECT part_id, source_ordinal, len(list_filter(range(2, len(w) + 1), lambda i: (strlen(w[i]) % 3 = 0) <> (strlen(w[i - 1]) % 3 = 0)))::BIGINT AS switches FROM (SELECT part_id, source_ordinal, {_WORDS} AS w FROM cues )) WHERE switches > 20"))
def G02_language_switching(spark, sf_dir):
    """Cues with more than twenty changes of language between neighbouring spans."""
    rows = _tokens(inputs.cues(spark, sf_dir)).select("part_id", "source_ordinal", su.switches(F.col("languages")).cast("long").alias("switches"))
    return rows.where("switches > 20")



@query(r"SELECT doc_id, len(m) + len(d) AS n, array_to_string(list_concat(m, d), ' ') AS matches FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \t\n\x0b\f\r]+'), lambda w: regexp_matches(w, '[0-9]') AND regexp_matches(w, '\p{L}')) AS m, regexp_extract_all(text, '[0-9]{3,}') AS d FROM documents) WHERE len(m) > 0 OR len(d) > 0")
def G03_numbers_entities(spark, sf_dir):
    """Words that mix letters and digits, then runs of three digits or more, listed."""
    rows = inputs.table(spark, sf_dir, "documents").select("doc_id", su.numeric_matches(F.col("text"), 3).alias("found"))
    return rows.where(F.size("found") > 0).select("doc_id", F.size("found").cast("long").alias("n"), F.array_join("found", " ").alias("matches"))


@query(rf"SELECT doc_id, n AS longest, w AS unit FROM (SELECT doc_id, w, count(*) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, min(i)) AS place FROM (SELECT doc_id, i - row_number() OVER (PARTITION BY doc_id, w ORDER BY i) AS grp, w, i FROM (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (SELECT doc_id, {_WORDS} AS w FROM documents))) GROUP BY doc_id, grp, w) WHERE place = 1 AND n > 2")
def E07_within_cue_repetition(spark, sf_dir):
    """Texts in which a word stands more than twice in a row, and the word of the first longest run."""
    rows = inputs.table(spark, sf_dir, "documents").select("doc_id", su.longest_run(words("text")).alias("run"))
    return rows.where("run.length > 2").select("doc_id", F.col("run.length").cast("long").alias("longest"), F.col("run.unit").alias("unit"))


_DOC_LINES = "SELECT doc_id AS part_id, generate_subscripts(l, 1) AS ordinal, unnest(l) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)"


@query(sql("SELECT part_id, min(ordinal) AS first_ordinal, max(ordinal) AS last_ordinal, any_value(text) AS text FROM (SELECT *, sum(new) OVER (PARTITION BY part_id ORDER BY ordinal ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN text = lag(text) OVER (PARTITION BY part_id ORDER BY ordinal) THEN 0 ELSE 1 END AS new FROM doc_lines )) GROUP BY part_id, run HAVING count(*) > 1", doc_lines=_DOC_LINES))
def E08_across_cue_repetition(spark, sf_dir):
    """Runs of equal neighbouring lines."""
    lines = inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("part_id"), F.posexplode(F.split("text", "\n")).alias("i", "text")).withColumn("ordinal", (F.col("i") + 1).cast("long"))
    found = iv.runs(lines, ["part_id"], ["ordinal"], F.col("text"))
    return found.groupBy("part_id", "run").agg(F.min("ordinal").alias("first_ordinal"), F.max("ordinal").alias("last_ordinal"), F.first("text").alias("text"), F.count("*").alias("n")).where("n > 1").drop("run", "n")


_SAID = "SELECT part_id, source_ordinal, start_t, end_t, text || CASE WHEN source_ordinal % 5 = 2 THEN ' la la la la la' ELSE '' END || CASE WHEN source_ordinal % 6 = 1 THEN ' a1 2024' ELSE '' END AS text FROM cues "
_SOUND = "SELECT part_id, start_t + 100 AS start_t, start_t + 1500 AS end_t, 'non_speech' AS state FROM cues WHERE source_ordinal % 3 = 0 UNION ALL SELECT part_id, end_t - 100, end_t + 2500, 'speech_likely' FROM cues WHERE source_ordinal % 4 = 3"
_LISTED = rf"SELECT *, {_WORDS} AS w FROM said "
_FOUND = rf"""SELECT c.part_id, greatest(c.start_t, v.start_t) AS start_t, least(c.end_t, v.end_t) AS end_t, 0 AS position, c.source_ordinal::VARCHAR AS ordinals, '' AS evidence FROM said c JOIN (SELECT * FROM sound WHERE state = 'non_speech') v ON c.part_id = v.part_id AND v.start_t < c.end_t AND c.start_t < v.end_t WHERE least(c.end_t, v.end_t) - greatest(c.start_t, v.start_t) >= 1000
    UNION ALL SELECT part_id, start_t, end_t, 1, '', '' FROM {iv.subtract_sql(iv.union_sql("(SELECT part_id, start_t, end_t FROM sound WHERE state = 'speech_likely')", 'part_id'), '(SELECT part_id, start_t, end_t FROM said WHERE start_t < end_t)', 'part_id')} WHERE end_t - start_t >= 1000
    UNION ALL SELECT part_id, start_t, end_t, 2, source_ordinal::VARCHAR, array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: (i * 7 + part_id) % 10 < 5), lambda i: w[i]), ' ') FROM listed WHERE len(list_filter(range(1, len(w) + 1), lambda i: (i * 7 + part_id) % 10 < 5)) > 0
    UNION ALL SELECT part_id, start_t, end_t, 3, source_ordinal::VARCHAR, (SELECT arg_min(unit, (-n, at_)) || ' ' || max(n)::VARCHAR FROM runs r WHERE r.part_id = l.part_id AND r.source_ordinal = l.source_ordinal) FROM listed l WHERE (SELECT max(n) FROM runs r WHERE r.part_id = l.part_id AND r.source_ordinal = l.source_ordinal) > 3
    UNION ALL SELECT part_id, arg_min(start_t, source_ordinal), arg_max(end_t, source_ordinal), 3, string_agg(source_ordinal::VARCHAR, ',' ORDER BY source_ordinal), 'across' FROM (SELECT *, sum(new) OVER (PARTITION BY part_id ORDER BY source_ordinal ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN text = lag(text) OVER (PARTITION BY part_id ORDER BY source_ordinal) THEN 0 ELSE 1 END AS new FROM said )) GROUP BY part_id, run HAVING count(*) > 3
    UNION ALL SELECT part_id, start_t, end_t, 4, source_ordinal::VARCHAR, len(list_filter(range(2, len(w) + 1), lambda i: (strlen(w[i]) % 3 = 0) <> (strlen(w[i - 1]) % 3 = 0)))::VARCHAR FROM listed WHERE len(list_filter(range(2, len(w) + 1), lambda i: (strlen(w[i]) % 3 = 0) <> (strlen(w[i - 1]) % 3 = 0))) > 2
    UNION ALL SELECT part_id, start_t, end_t, 5, source_ordinal::VARCHAR, array_to_string(m || d, ' ') FROM (SELECT *, list_filter(w, lambda x: regexp_matches(x, '[0-9]') AND regexp_matches(x, '\p{{L}}')) AS m, regexp_extract_all(text, '[0-9]{{2,}}') AS d FROM listed ) WHERE len(m) + len(d) > 0"""
_UNIT_RUNS = "SELECT part_id, source_ordinal, unit, count(*) AS n, min(i) AS at_ FROM (SELECT part_id, source_ordinal, unit, i, i - row_number() OVER (PARTITION BY part_id, source_ordinal, unit ORDER BY i) AS grp FROM (SELECT part_id, source_ordinal, w[i] AS unit, i FROM (SELECT part_id, source_ordinal, w, unnest(generate_series(1, len(w))) AS i FROM listed ))) GROUP BY part_id, source_ordinal, unit, grp"


@query(sql("SELECT part_id, start_t, end_t, ['vad_coverage', 'coverage_checks', 'confidence', 'repetition', 'language_switching', 'numbers_entities'][position + 1] AS detector, ordinals, evidence FROM found ", said=_SAID, sound=_SOUND, listed=_LISTED, runs=_UNIT_RUNS, found=_FOUND))
def G04_detect_suspicions(spark, sf_dir):
    """Findings of all six detectors as one table, with both bounds and the evidence."""
    cues, o = inputs.cues(spark, sf_dir), F.col("source_ordinal")
    said = cues.withColumn("text", F.concat("text", F.when(o % 5 == 2, " la la la la la").otherwise(""), F.when(o % 6 == 1, " a1 2024").otherwise("")))
    silence = cues.where("source_ordinal % 3 = 0").select("part_id", (F.col("start_t") + 100).alias("start_t"), (F.col("start_t") + 1500).alias("end_t"), F.lit("non_speech").alias("state"))
    sound = silence.unionByName(cues.where("source_ordinal % 4 = 3").select("part_id", (F.col("end_t") - 100).alias("start_t"), (F.col("end_t") + 2500).alias("end_t"), F.lit("speech_likely").alias("state")))
    found = su.detect(_tokens(said), sound, "part_id", 60_000, 1000)
    return found.select("part_id", "start_t", "end_t", "detector", F.array_join(F.transform("ordinals", lambda x: x.cast("string")), ",").alias("ordinals"), "evidence")


_REVIEW = """SELECT *, CASE WHEN review_text IS NULL THEN NULL WHEN primary_model = '' OR coalesce(review_model, '') = '' THEN 'review_classification_invalid' WHEN primary_model = review_model THEN 'recovery' ELSE 'independent_review' END AS kind FROM (
    SELECT event_id AS interval_id, CASE WHEN event_type IN ('purchase', 'signup') THEN 'text_over_silence' ELSE 'low_confidence' END AS reason, CASE WHEN event_id % 7 = 0 THEN ' ' ELSE 'p' || (event_id % 4)::VARCHAR END AS primary_text, CASE WHEN event_id % 41 = 0 THEN '' ELSE 'm' || (event_id % 3)::VARCHAR END AS primary_model,
    CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'p' || (doc_id % 6)::VARCHAR END AS review_text, CASE WHEN doc_id % 9 <> 4 THEN 'm' || (doc_id % 4)::VARCHAR END AS review_model FROM events LEFT JOIN documents ON doc_id = event_id)"""


@query(sql("""SELECT interval_id, kind, CASE WHEN NOT independent THEN 'review-needed' WHEN primary_text = review_text THEN 'agreement' WHEN rule IS NOT NULL THEN 'review_adopted' ELSE 'review-needed' END AS decision, rule, CASE WHEN rule IS NOT NULL THEN review_text ELSE primary_text END AS text FROM (
    SELECT *, coalesce(kind = 'independent_review', false) AS independent, CASE WHEN coalesce(kind, '') <> 'independent_review' OR primary_text = review_text THEN NULL WHEN trim(primary_text) = '' AND trim(review_text) <> '' THEN 'fills_gap' WHEN reason = 'text_over_silence' AND trim(primary_text) <> '' AND trim(review_text) = '' THEN 'drops_silence' END AS rule FROM review )""", review=_REVIEW))
def C11_review_text_join(spark, sf_dir):
    """Primary text of each suspicious interval and the review of it, told independent by the models' names, arbitrated by a truth table."""
    e, d = F.col("event_id"), F.col("doc_id")
    primary = inputs.table(spark, sf_dir, "events").select(e.alias("interval_id"), F.when(F.col("event_type").isin("purchase", "signup"), "text_over_silence").otherwise("low_confidence").alias("reason"), F.when(e % 7 == 0, " ").otherwise(F.concat(F.lit("p"), (e % 4).cast("string"))).alias("primary_text"),
                                                           F.when(e % 41 == 0, "").otherwise(F.concat(F.lit("m"), (e % 3).cast("string"))).alias("primary_model"))
    review = inputs.table(spark, sf_dir, "documents").select(d.alias("interval_id"), F.when(d % 5 == 0, "").otherwise(F.concat(F.lit("p"), (d % 6).cast("string"))).alias("review_text"), F.when(d % 9 != 4, F.concat(F.lit("m"), (d % 4).cast("string"))).alias("review_model"))
    classified = sp.classified_reviews(primary, review, "interval_id")
    return sp.arbitrate(primary, classified, "interval_id").join(classified.select("interval_id", "kind"), "interval_id", "left").select("interval_id", "kind", "decision", "rule", "text")


@query(sql("SELECT run_id, bool_and(to_status <> 'failed' OR sequence % 3 = 0) AND bool_or(to_status = 'completed') AS verbatim FROM run_events GROUP BY run_id"))
def D17_verbatim_emission(spark, sf_dir):
    """Verbatim output only of a run that completed with every check passed."""
    return audit.verbatim_runs(inputs.run_events(spark, sf_dir), "run_id", (F.col("to_status") != "failed") | (F.col("sequence") % 3 == 0), F.col("to_status") == "completed")



@query(sql("SELECT part_id, cue_id, start_t, end_t FROM (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY start_t, cue_id) AS rn FROM captions ) WHERE rn <= 3"))
def H02_leading_chunks(spark, sf_dir):
    """The first three chunks of each part."""
    return sp.leading(inputs.captions(spark, sf_dir), "part_id", ["start_t", "cue_id"], 3)


_SNAP = "least(greatest(round_even({} * 16 / 1000.0, 0)::BIGINT, 0), last_sample)"
_TIMED = "SELECT part_id, cue_id, start_t - lo + (cue_id % 3) * 31 AS s, start_t - lo + (cue_id % 5) * 310 AS e, greatest(round_even((hi - lo) * 16 / 1000.0, 0)::BIGINT - 50000000, 0) AS last_sample FROM captions JOIN (SELECT user_id AS part_id, min(start_t) AS lo, max(end_t) AS hi FROM ev GROUP BY user_id) USING (part_id)"


@query(sql(f"""SELECT kind, part_id, cue_id, a, b FROM (SELECT 'turn' AS kind, part_id, cue_id, {_SNAP.format('s')} AS a, {_SNAP.format('e')} AS b FROM timed
    UNION ALL SELECT 'alignment', part_id, cue_id, {_SNAP.format('(s - 400)')}, {_SNAP.format('(s + 900)')} FROM timed WHERE cue_id % 7 <> 0
    UNION ALL SELECT 'region', part_id, cue_id, {_SNAP.format('s')}, {_SNAP.format('(s + 2500)')} FROM timed ) WHERE a < b""", timed=_TIMED))
def B12_snap_model_times(spark, sf_dir):
    """Times of turns, aligned words and screen regions to samples, half to even, clamped; empty ones are dropped."""
    ends = interval_queries._users(spark, sf_dir).groupBy("part_id").agg(F.min("start_t").alias("lo"), F.max("end_t").alias("hi"))
    last = F.greatest(F.bround((F.col("hi") - F.col("lo")).cast("decimal(30,6)") * 16 / 1000, 0).cast("long") - 50_000_000, F.lit(0).cast("long"))
    timed = inputs.captions(spark, sf_dir).join(ends, "part_id").select("part_id", "cue_id", (F.col("start_t") - F.col("lo") + (F.col("cue_id") % 3) * 31).alias("start_t"), (F.col("start_t") - F.col("lo") + (F.col("cue_id") % 5) * 310).alias("end_t"), last.alias("last_sample"))
    item = lambda a, b: F.struct(a.cast("long").alias("start_t"), b.cast("long").alias("end_t"))
    s, gone = F.col("start_t"), F.col("cue_id") % 7 == 0
    words_ = F.array(item(s, s + 900), item(s - 400, F.lit(None)), item(F.when(~gone, s - 400), s + 100), item(F.lit(None), F.lit(None)))
    aligned = timed.withColumn("items", F.when(gone, F.array(item(s, F.lit(None)))).otherwise(words_))
    done = lambda df, kind: df.select(F.lit(kind).alias("kind"), "part_id", "cue_id", F.col("first").alias("a"), F.col("last").alias("b"))
    turns, regions = sp.snap_spans(timed, 1_000_000, 16_000), sp.snap_spans(timed.withColumn("end_t", s + 2500), 1_000_000, 16_000)
    return done(turns, "turn").unionByName(done(sp.snap_alignment(aligned, 1_000_000, 16_000), "alignment")).unionByName(done(regions, "region"))


@query(sql("""SELECT part_id, cluster, role, evidence, coalesce(min(fault) OVER (PARTITION BY part_id), CASE WHEN known THEN 'kept' ELSE 'cluster_unknown' END) AS outcome FROM (
      SELECT part_id, source_ordinal % 3 AS cluster, role || source_ordinal::VARCHAR AS role, 'subtitle_text' AS evidence, source_ordinal % 3 < 2 AS known, CASE WHEN source_ordinal % 3 < 2 AND part_id % 5 = 1 AND source_ordinal % 4 = 1 THEN 'model_output_invalid' END AS fault FROM cues
      UNION ALL SELECT part_id, CASE WHEN part_id % 9 = 2 THEN 7 ELSE 1 END, 'host', 'user_metadata', part_id % 9 <> 2, CASE WHEN part_id % 9 = 2 THEN 'role_metadata_invalid' END FROM (SELECT DISTINCT part_id FROM cues WHERE part_id % 3 = 2))"""))
def C18_role_citation_check(spark, sf_dir):
    """Role candidates need a known cluster and the very text of the cue they cite; user metadata join in; one fault refuses the output."""
    cues, o, p = inputs.cues(spark, sf_dir), F.col("source_ordinal"), F.col("part_id")
    turns = cues.select("part_id").distinct().select("part_id", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("cluster"))
    proposals = cues.select("part_id", (o % 3).cast("long").alias("cluster"), F.concat("role", o.cast("string")).alias("role"), "source_ordinal", F.when((p % 5 == 1) & (o % 4 == 1), F.concat("text", F.lit("x"))).otherwise(F.col("text")).alias("text"))
    metadata = cues.where("part_id % 3 = 2").select("part_id").distinct().select("part_id", F.when(p % 9 == 2, 7).otherwise(1).cast("long").alias("cluster"), F.lit("host").alias("role"))
    return sp.role_citations(turns, proposals, cues, metadata, "part_id")
