"""Queries of sources, cue text and track operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partwise.functions import columns
from partwise.operators import cues as cu
from partwise.operators import audit, tracks, urls
from partwise.operators import intervals as iv
from partwise.plans import inputs
from partwise.plans.inputs import sql
from partwise.plans.registry import query
from partwise.sources import envelopes as env
from partwise.sources import subtitles as sub
from partwise.sources.subtitles import work_folder

def _lines(spark, sf_dir) -> DataFrame:
    """Cues as a subtitle file has them: one line each, none before zero and none without a length."""
    start = F.col("start_t") + 200
    rows = inputs.cues(spark, sf_dir).withColumn("text", F.concat(F.lit("- "), F.regexp_replace("text", r"[\r\n]+", " ")))
    return rows.withColumns({"start_t": start, "end_t": F.greatest(F.col("end_t") + 200, start + 1)})


_LINES = r"SELECT part_id, source_ordinal, role, '- ' || regexp_replace(text, '[\r\n]+', ' ', 'g') AS text, start_t + 200 AS start_t, greatest(end_t + 200, start_t + 201) AS end_t FROM cues"


def _stamp_sql(c: str) -> str:
    return f"printf('%02d:%02d:%02d,%03d', {c} // 3600000, ({c} // 60000) % 60, ({c} // 1000) % 60, {c} % 1000)"


_SRT = f"SELECT part_id, string_agg(n::VARCHAR || chr(10) || {_stamp_sql('start_t')} || ' --> ' || {_stamp_sql('end_t')} || chr(10) || text || chr(10), chr(10) ORDER BY n) AS text FROM (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY start_t, end_t, source_ordinal) AS n FROM lines ) GROUP BY part_id"


@query("SELECT doc_id, CASE WHEN doc_id % 5 IN (3, 4) THEN 'encoding_ambiguous' ELSE 'decoded' END AS state, CASE WHEN doc_id % 5 < 3 THEN sha256(text) END AS text_sha256 FROM documents")
def A01_read_subtitle_payloads(spark, sf_dir):
    """Raw payloads decoded by a requested decoder or by their marks; half of a character, or of a pair of bytes, is ambiguous."""
    docs = inputs.table(spark, sf_dir, "documents")
    plain, kind, asked = F.encode("text", "UTF-8"), F.col("doc_id") % 5, F.col("doc_id") % 35 == 20
    content = (F.when(asked, F.encode("text", "UTF-16BE")).when(kind == 1, F.concat(F.unhex(F.lit("EFBBBF")), plain)).when(kind == 2, F.concat(F.unhex(F.lit("FFFE")), F.encode("text", "UTF-16LE")))
               .when(kind == 3, F.concat(plain, F.unhex(F.lit("C3")))).when(kind == 4, F.concat(F.unhex(F.lit("FEFF")), F.encode("text", "UTF-16BE"), F.unhex(F.lit("D8")))).otherwise(plain))
    rows = docs.select("doc_id", content.alias("content"), F.when(asked, "utf-16be").alias("decoder"))
    return sub.decoded(rows, "decoder").select("doc_id", "state", F.sha2("text", 256).alias("text_sha256"))



_WRONG = "(part_id % 7 = 3 OR part_id % 14 = 5)"


@query(sql(f"""SELECT part_id, CASE WHEN {_WRONG} THEN 'syntax_invalid' END AS reason, CASE WHEN {_WRONG} THEN 0 ELSE count(*) END AS n_cues, CASE WHEN NOT {_WRONG} THEN sum(start_t + end_t)::BIGINT END AS times,
    CASE WHEN NOT {_WRONG} THEN sum(length(text))::BIGINT END AS chars, CASE WHEN NOT {_WRONG} THEN count(*) FILTER (part_id % 2 = 1 AND source_ordinal % 2 = 0) END AS settings FROM lines GROUP BY part_id""", lines=_LINES))
def A02_parse_cues(spark, sf_dir):
    """SRT and VTT texts parsed into cues, a wrong timing line or header refuses its track."""
    cues = _lines(spark, sf_dir).withColumn("settings", F.when((F.col("part_id") % 2 == 1) & (F.col("source_ordinal") % 2 == 0), "align:left line:2"))
    broken = lambda df: df.withColumn("text", F.when(F.col("part_id") % 7 == 3, F.regexp_replace("text", "-->", "->")).otherwise(F.col("text")))
    header = F.when(F.col("part_id") % 14 == 5, "WEBVT\n\n").otherwise("WEBVTT - made here\n\nNOTE not a cue\nof two lines\n\nSTYLE\n::cue {}\n\n")
    srt = broken(sub.rendered(cues.where("part_id % 2 = 0").drop("settings"), "part_id"))
    vtt = broken(sub.rendered(cues.where("part_id % 2 = 1"), "part_id", form="vtt")).withColumn("text", F.concat(header, F.expr("substring(text, 9)")))
    (t1, c1), (t2, c2) = sub.parse_cues(srt, "part_id"), sub.parse_cues(vtt, "part_id", form="vtt")
    sums = c1.unionByName(c2).groupBy("part_id").agg(F.sum(F.col("start_t") + F.col("end_t")).alias("times"), F.sum(F.length("text")).alias("chars"), F.count_if(F.col("settings") != "").alias("settings"))
    return t1.unionByName(t2).join(sums, "part_id", "left")



def _probe_json(spark, sf_dir) -> DataFrame:
    events = inputs._events(spark, sf_dir)
    duration = F.when((F.col("user_id") % 11 == 0) & (F.col("event_id") % 5 == 0), F.lit(None)).otherwise(F.col("end_t") - F.col("start_t"))
    packet = F.struct(F.lit(0).alias("stream_index"), F.col("start_t").alias("pts"), duration.alias("duration"), (F.col("event_id") % 1000).alias("size"))
    base = F.when(F.col("part_id") % 13 == 7, "0/1000").otherwise("1/1000")
    streams = F.array(F.struct(F.lit(0).alias("index"), F.lit("audio").alias("codec_type"), F.lit("aac").alias("codec_name"), base.alias("time_base")))
    g = events.where("start_t < end_t").groupBy(F.col("user_id").alias("part_id")).agg(F.collect_list(packet).alias("packets"))
    return g.select("part_id", F.to_json(F.struct(streams.alias("streams"), "packets")).alias("json"))



_BAD_PROBE = "(user_id % 13 = 7 OR (user_id % 11 = 0 AND bool_or(event_id % 5 = 0)))"


@query(sql(f"SELECT user_id AS part_id, CASE WHEN {_BAD_PROBE} THEN 'probe_invalid' ELSE 'accepted' END AS state, count(*) AS packets, CASE WHEN NOT {_BAD_PROBE} THEN sum(end_t - start_t)::BIGINT END AS duration, CASE WHEN NOT {_BAD_PROBE} THEN sum(event_id % 1000)::BIGINT END AS bytes FROM ev WHERE start_t < end_t GROUP BY user_id"))
def A03_read_packet_probe(spark, sf_dir):
    """Probe documents parsed; one packet without a duration, or a time base of zero, refuses the document."""
    probes = sub.read_probe(_probe_json(spark, sf_dir), "part_id")
    total = lambda c: F.when(F.col("state") == "accepted", F.aggregate("packets", F.lit(0).cast("long"), lambda n, p: n + p[c]))
    return probes.select("part_id", "state", F.size("packets").cast("long").alias("packets"), total("duration").alias("duration"), total("size").alias("bytes"))



@query("SELECT p_partkey AS part_id, i::INT AS index, p_brand AS language FROM part, unnest(generate_series(1, p_size % 3)) AS t(i)")
def A04_list_subtitle_tracks(spark, sf_dir):
    """Subtitle streams of probe documents with their language."""
    subtitle = F.transform(F.sequence(F.lit(1), F.col("p_size") % 3), lambda i: F.struct(i.cast("int").alias("index"), F.lit("subtitle").alias("codec_type"), F.lit("1/1000").alias("time_base"), F.struct(F.col("p_brand").alias("language")).alias("tags")))
    video = F.array(F.struct(F.lit(0).alias("index"), F.lit("video").alias("codec_type"), F.lit("1/1000").alias("time_base"), F.struct(F.lit(None).cast("string").alias("language")).alias("tags")))
    streams = F.when(F.col("p_size") % 3 > 0, F.concat(video, subtitle)).otherwise(video)
    docs = inputs.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part_id"), F.to_json(F.struct(streams.alias("streams"), F.array().cast("array<int>").alias("packets"))).alias("json"))
    return sub.subtitle_tracks(sub.read_probe(docs, "part_id"), "part_id").drop("format")


#: What is done to an envelope's JSON, and the rule that it breaks then (none: it stays valid). Cues and items share what stands above them.
_FAULTS = (
    (None, ()), ("not_json", (("{", "{{"),)), ("not_an_object", ()), ("schema_version", (('"schema_version":1', '"schema_version":"1"'),)), ("schema_version", (('"schema_version":1', '"schema_version":2'),)),
    ("projection_schema_version", (('"projection_schema_version":"v1"', '"projection_schema_version":"v0"'),)), ("adapter_identity", (('"adapter_identity"', '"adapter"'),)), ("capability", (('"capability":"', '"capability":"no '),)),
    ("result", (('"result":{', '"result":null,"r":{'),)),
)
_CUE_FAULTS = (
    ("cues_not_a_list", (('"cues":[', '"cues":{},"c":['),)), ("cue_not_an_object", (('"cues":[', '"cues":[7,'),)), ("cue_field_missing", (('"ordinal":', '"order":'),)), ("cue_ordinal", (('"ordinal":', '"ordinal":-1,"o":'),)), ("cue_ordinal", (('"ordinal":', '"ordinal":true,"o":'),)),
    ("time_not_an_object", (('"start":{', '"start":5,"s":{'),)), ("time_not_whole", (('"numerator":', '"numerator":"1","n":'),)), ("time_not_whole", (('"denominator":1000', '"denominator":1000.5'),)), ("time_denominator", (('"denominator":1000', '"denominator":0'),)),
    ("cue_interval", (('"end":{"numerator":', '"end":{"numerator":-1000000000000,"n":'),)), ("cue_text", (('},"text":', '},"text":null,"t":'),)), ("tokens_not_a_list", (('"tokens":[', '"tokens":7,"k":['),)), ("token_not_an_object", (('"tokens":[', '"tokens":["w",'),)),
    ("token_field_missing", (('0.5,"text":', '0.5,"word":'),)), ("token_text", (('0.5,"text":', '0.5,"text":5,"t":'),)), ("token_confidence", (('"confidence":0.5', '"confidence":1.5'),)), ("token_confidence", (('"confidence":0.5', '"confidence":"0.5"'),)),
    ("spans_not_a_list", (('"language_spans":[', '"language_spans":"x","l":['),)), ("span_not_an_object", (('"language_spans":[', '"language_spans":[null,'),)), ("span_field_missing", (('"language":', '"lang":'),)), ("span_language", (('"language":"en"', '"language":""'),)),
    ("span_index", (('"start_token":0', '"start_token":-1'),)), ("span_index", (('"end_token":', '"end_token":1.5,"e":'),)), ("span_empty", (('"start_token":0', '"start_token":9'),)), ("span_beyond", (('"end_token":', '"end_token":9,"e":'),)), ("span_beyond", (('"tokens":[', '"tokens":null,"k":['),)),
    (None, (('"tokens":[', '"tokens":null,"k":['), ('"language_spans":[', '"language_spans":null,"l":['))), (None, (('"confidence":0.5,', ""),)), (None, (('"confidence":0.5', '"confidence":1'),)),
)
_ITEM_FAULTS = (
    ("items_not_a_list", (('"items":[', '"items":"x","c":['),)), ("item_not_an_object", (('"items":[', '"items":["x",'),)), ("item_field_missing", (('"confidence":0.5,', ""),)), ("item_part", (('"part_id":"p"', '"part_id":""'),)), ("item_page", (('"visual_page_id":"', '"visual_page_id":1,"v":"'),)),
    ("time_denominator", (('"denominator":1000', '"denominator":-1'),)), ("item_text", (('},"text":', '},"text":[],"t":'),)), ("item_confidence", (('"confidence":0.5', '"confidence":-0.1'),)), ("item_confidence", (('"confidence":0.5', '"confidence":null'),)), ("span_beyond", (('"end_char":', '"end_char":1000000,"e":'),)),
)


def _detail_sql(number: str, faults: tuple) -> str:
    return f"CASE {number} % {len(faults)} " + " ".join(f"WHEN {i} THEN '{code}'" for i, (code, _) in enumerate(faults) if code) + " END"


def _spoiled(number, body, faults: tuple):
    out = body
    for i, (code, edits) in enumerate(faults):
        bad = F.concat(F.lit("["), body, F.lit("]")) if code == "not_an_object" else reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), edits, body)
        out = F.when(number % len(faults) == i, bad).otherwise(out)
    return out


_ASR_FAULTS, _OCR_FAULTS = _FAULTS + _CUE_FAULTS, _FAULTS + _ITEM_FAULTS
_DETAILS = f"SELECT 'asr' AS kind, part_id AS id, n, {_detail_sql('part_id', _ASR_FAULTS)} AS detail FROM (SELECT part_id, count(*) AS n FROM cues GROUP BY part_id) UNION ALL SELECT 'ocr', doc_id, 1, {_detail_sql('doc_id', _OCR_FAULTS)} FROM documents"


@query(sql("""SELECT kind, id, detail IS NULL AS valid, detail, CASE WHEN detail IS NULL THEN n ELSE 0 END AS admitted FROM details
    UNION ALL SELECT 'text', part_id, part_id % 8 <> 1, CASE WHEN part_id % 8 = 1 THEN 'model_output_invalid' END, CASE WHEN part_id % 8 <> 1 THEN 2 ELSE 0 END FROM cues GROUP BY part_id""", details=_DETAILS))
def A05_read_model_outputs(spark, sf_dir):
    """Model output envelopes of speech, screen text and prose, fenced or not; a breach refuses all of one and is told."""
    cues, docs = inputs.cues(spark, sf_dir), inputs.table(spark, sf_dir, "documents")
    fenced = lambda body: F.when(F.col("id") % 2 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body).alias("json")
    head = lambda kind: [F.lit(1).alias("schema_version"), F.lit("v1").alias("projection_schema_version"), F.lit("a1").alias("adapter_identity"), F.lit(kind).alias("capability")]
    time = lambda c: F.struct(c.alias("numerator"), F.lit(1000).alias("denominator"))
    span = lambda unit, end: F.array(F.struct(F.lit("en").alias("language"), F.lit(0).alias(f"start_{unit}"), end.alias(f"end_{unit}"))).alias("language_spans")
    token = F.array(F.struct(F.lit(0.5).alias("confidence"), "text")).alias("tokens")
    cue = F.struct(F.col("source_ordinal").alias("ordinal"), time(F.col("start_t")).alias("start"), time(F.greatest(F.col("end_t"), F.col("start_t") + 1)).alias("end"), "text", token, span("token", F.lit(1)))
    asr = cues.groupBy(F.col("part_id").alias("id")).agg(F.struct(F.collect_list(cue).alias("cues")).alias("result")).select("id", F.to_json(F.struct(*head("asr"), "result")).alias("body"))
    item = F.struct(F.lit("p").alias("part_id"), F.lit("page-01").alias("visual_page_id"), F.lit(0.5).alias("confidence"), time(F.col("doc_id")).alias("pts"), F.concat(F.lit("-"), F.coalesce("text", F.lit(""))).alias("text"), span("char", F.lit(1)))
    ocr = docs.select(F.col("doc_id").alias("id"), F.struct(F.array(item).alias("items")).alias("result")).select("id", F.to_json(F.struct(*head("ocr"), "result")).alias("body"))
    admitted = F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("admitted")
    strict = lambda df, kind, faults: env.read_strict(df.select("id", fenced(_spoiled(F.col("id"), F.col("body"), faults))), "id", kind=kind, projection="v1", adapter="a1", capabilities=(kind,)).select(F.lit(kind).alias("kind"), "id", (F.col("state") == "projected").alias("valid"), "detail", admitted)
    prose = cues.groupBy(F.col("part_id").alias("id")).agg(F.create_map(F.lit("title"), F.min("role"), F.lit("summary"), F.max("role")).alias("result"))
    loose = [F.lit(1).alias("schema_version"), F.lit("v1").alias("projection_version"), F.when(F.col("id") % 8 == 1, "").otherwise("a").alias("adapter"), F.lit("text").alias("capability")]
    text = sub.read_envelopes(prose.select("id", fenced(F.to_json(F.struct(*loose, "result")))), "id", kind="text")
    text = text.select(F.lit("text").alias("kind"), "id", "valid", F.col("reason").alias("detail"), F.when(F.col("valid"), F.size("items")).otherwise(0).cast("long").alias("admitted"))
    return strict(asr, "asr", _ASR_FAULTS).unionByName(strict(ocr, "ocr", _OCR_FAULTS)).unionByName(text)


@query(sql("SELECT part_id, source_ordinal, text, start_t, end_t, 'asr' AS provenance FROM cues"))
def A06_write_cue_tables(spark, sf_dir):
    """Cues written in the candidate shape by part bucket, and read again."""
    path = work_folder(spark)
    sub.write_cues(inputs.cues(spark, sf_dir).drop("role").withColumn("provenance", F.lit("asr")), path)
    return spark.read.parquet(path).drop("part_bucket")


_BLOCKS = f"SELECT *, n::VARCHAR || chr(10) || {_stamp_sql('start_t')} || ' --> ' || {_stamp_sql('end_t')} AS head, CASE WHEN source_ordinal % 3 = 0 THEN 'line:1' ELSE '' END AS settings FROM (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY start_t, end_t, source_ordinal) AS n FROM lines )"


@query(sql("""SELECT part_id, form, CASE WHEN part_id % 11 <> 4 THEN length(text) END AS chars, CASE WHEN part_id % 11 <> 4 THEN sha256(text) END AS text_sha256, CASE WHEN part_id % 11 <> 4 THEN losses ELSE 0 END AS losses, CASE WHEN part_id % 11 = 4 THEN 'negative_time' END AS reason FROM (
      SELECT part_id, 'srt' AS form, string_agg(head || chr(10) || text || chr(10), chr(10) ORDER BY n) AS text, count(*) FILTER (settings <> '') AS losses FROM blocks GROUP BY part_id
      UNION ALL SELECT part_id, 'vtt', 'WEBVTT' || chr(10) || chr(10) || string_agg(replace(head, ',', '.') || CASE WHEN settings <> '' THEN ' ' || settings ELSE '' END || chr(10) || text || chr(10), chr(10) ORDER BY n), 0 FROM blocks GROUP BY part_id)
    UNION ALL SELECT part_id, form, length(text), sha256(text), losses, NULL FROM (
      SELECT part_id, 'source_srt' AS form, string_agg(head || chr(10) || text || chr(10), chr(10) ORDER BY n DESC) AS text, 3 + count(*) FILTER (settings <> '') AS losses FROM blocks GROUP BY part_id
      UNION ALL SELECT part_id, 'source_vtt', 'WEBVTT - made here' || chr(10) || chr(10) || 'NOTE not a cue' || chr(10) || 'of two lines' || chr(10) || chr(10) || 'STYLE' || chr(10) || '::cue {}' || chr(10) || chr(10) || string_agg(replace(head, ',', '.') || CASE WHEN settings <> '' THEN ' ' || settings ELSE '' END || chr(10) || text || chr(10), chr(10) ORDER BY n DESC), 0 FROM blocks GROUP BY part_id)""", lines=_LINES, blocks=_BLOCKS))
def A07_render_srt_vtt(spark, sf_dir):
    """Each part's cues as one SRT and one VTT text; SRT loses settings, which is told; negative times are refused. A VTT file whose cues stand in no order of time is written as it is, and as SRT in its own order."""
    early = F.when(F.col("part_id") % 11 == 4, 10**9).otherwise(0)
    cues = _lines(spark, sf_dir).withColumn("settings", F.when(F.col("source_ordinal") % 3 == 0, "line:1")).withColumns({c: F.col(c) - early for c in ("start_t", "end_t")})
    one = lambda form: sub.rendered(cues, "part_id", form=form).select("part_id", F.lit(form).alias("form"), F.length("text").cast("long").alias("chars"), F.sha2("text", 256).alias("text_sha256"), F.size("losses").cast("long").alias("losses"), "reason")
    n = F.row_number().over(Window.partitionBy("part_id").orderBy("start_t", "end_t", "source_ordinal"))
    turned = _lines(spark, sf_dir).withColumn("settings", F.when(F.col("source_ordinal") % 3 == 0, "line:1")).withColumn("n", n)
    body = sub.rendered(turned.withColumns({"identifier": F.col("n").cast("string"), "source_ordinal": -F.col("n")}), "part_id", form="vtt", source_order=True)
    head = F.lit("WEBVTT - made here\n\nNOTE not a cue\nof two lines\n\nSTYLE\n::cue {}\n\n")
    files = body.select("part_id", F.replace(F.concat(head, F.expr("substring(text, 9)")), F.lit("\n"), F.lit("\r\n")).alias("text"))
    kept = lambda to: sub.source_rendered(files, "part_id", form="vtt", to=to).select("part_id", F.lit(f"source_{to}").alias("form"), F.length("text").cast("long").alias("chars"), F.sha2("text", 256).alias("text_sha256"), F.size("losses").cast("long").alias("losses"), "reason")
    return one("srt").unionByName(one("vtt")).unionByName(kept("srt")).unionByName(kept("vtt"))



@query(sql("SELECT part_id, sha256(string_agg(text, chr(10) ORDER BY start_t, end_t, source_ordinal)) AS text_sha256 FROM cues GROUP BY part_id"))
def A08_render_transcript(spark, sf_dir):
    """Each part's cue lines in order as prose."""
    return sub.transcripts(inputs.cues(spark, sf_dir), "part_id").select("part_id", F.sha2("text", 256).alias("text_sha256"))


#: The part whose texts a part's file holds: each seventh part is a copy of the one before it.
_SOURCE_OF = "part - CASE WHEN part % 7 = 3 THEN 1 ELSE 0 END"
_FILES = f"""SELECT part, sha256(string_agg(text || chr(10), '' ORDER BY doc_id)) AS sha256, sum(strlen(text) + 1)::BIGINT AS size FROM (SELECT DISTINCT doc_id // 10 AS part FROM documents) p JOIN (SELECT doc_id, coalesce(text, '') AS text, doc_id // 10 AS source FROM documents) d ON d.source = {_SOURCE_OF} GROUP BY part"""


@query(sql("""SELECT part, sha256, size, count(*) OVER (PARTITION BY sha256, size) AS copies, min(part) OVER (PARTITION BY sha256, size) AS kept,
    CASE WHEN sha256 IS NULL THEN 'source_unavailable' WHEN row_number() OVER (PARTITION BY part // 20, sha256 ORDER BY part) > 1 THEN 'duplicate_part' END AS reason FROM (SELECT DISTINCT doc_id // 10 AS part FROM documents) LEFT JOIN files USING (part)""", files=_FILES))
def A09_hash_and_dedupe_sources(spark, sf_dir):
    """Source files of parts hashed as bytes: one source for equal bytes, its first part and number of copies, and parts of a collection that repeat another's."""
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.floor(F.col("doc_id") / 10).alias("source"))
    parts = docs.select(F.col("source").alias("part")).distinct()
    path = work_folder(spark)
    rows = parts.withColumn("source", F.expr(_SOURCE_OF)).join(docs, "source").select("part", "doc_id", F.col("text").alias("value"))
    rows.repartition("part").sortWithinPartitions("part", "doc_id").select("part", "value").write.partitionBy("part").text(path)
    number = F.regexp_extract("path", r"/part=(-?\d+)/", 1).cast("long")
    files = sub.hashed(sub.read_payloads(spark, path, "*.txt")).withColumn("path", F.format_string("%018d", number))  # paths as the parts name them
    named = parts.select("part", F.format_string("%018d", "part").alias("path"), F.floor(F.col("part") / 20).alias("collection"))
    kept = sub.one_source_each(files).select("sha256", F.col("kept").cast("long").alias("kept"), "copies")
    return sub.distinct_parts(named, files, "collection", "part").join(kept, "sha256", "left").select("part", "sha256", "size", "copies", "kept", "reason")


@query(sql("""SELECT run_id, digest, files, missing, extra, mismatch FROM (SELECT run_id, sha256(string_agg(path::VARCHAR || ' ' || sha256, chr(10) ORDER BY path)) AS digest, count(*) AS files FROM present GROUP BY run_id) FULL JOIN (
    SELECT coalesce(m.run_id, p.run_id) AS run_id, count(*) FILTER (p.path IS NULL) AS missing, count(*) FILTER (m.path IS NULL) AS extra, count(*) FILTER (m.sha256 <> p.sha256) AS mismatch FROM manifest m FULL JOIN present p ON m.run_id = p.run_id AND m.path = p.path GROUP BY 1) USING (run_id)"""))
def A10_file_tree_digest(spark, sf_dir):
    """One digest per root over its sorted paths and digests, and what differs from the pinned manifest."""
    present = inputs.present(spark, sf_dir)
    counts = audit.compared(inputs.manifest(spark, sf_dir), present, ["run_id"], "path").groupBy("run_id").agg(*[F.count_if(F.col("finding") == f).alias(n) for f, n in (("missing", "missing"), ("unexpected", "extra"), ("hash_mismatch", "mismatch"))])
    return audit.tree_digest(present, "run_id").join(counts, "run_id", "full")



_BASE = "CASE user_id % 3 WHEN 0 THEN 1000 WHEN 1 THEN 90000 ELSE 48000 END"
_TICKS = f"event_id * (user_id % 2 + 1) * (720000 // ({_BASE}))"


@query(f"""SELECT event_id, part_id, ticks, CASE WHEN ticks >= origin THEN ticks - origin END AS relative, CASE WHEN ticks < origin THEN 'part_relative_negative' END AS reason,
      CASE WHEN part_id % 3 = 0 THEN event_id * (part_id % 2 + 1) END AS in_ms, CASE WHEN part_id % 3 <> 0 THEN 'time_base_not_common' END AS ms_reason FROM (
    SELECT event_id, user_id AS part_id, {_TICKS} AS ticks, min({_TICKS}) FILTER (event_id % 10 <> 0) OVER (PARTITION BY user_id) AS origin FROM events)""")
def B01_exact_ticks(spark, sf_dir):
    """Presentation times of mixed bases as ticks of their least common denominator, and from the part's start; times before it are refused, and so is a thousandth of a second for bases that do not divide it."""
    rows = inputs.table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("part_id"), F.expr("user_id % 2 + 1").alias("tb_num"), F.expr(_BASE.replace("THEN 1000", "THEN 1000L")).alias("tb_den"))
    shared = rows.withColumn("per_second", columns.least_common(rows, "tb_den").scalar())
    exact = shared.withColumn("t", columns.ticks("event_id", "tb_den", "per_second", "tb_num")).withColumn("ms", columns.ticks("event_id", "tb_den", 1000, "tb_num")).withColumn("ticks", F.col("t.ticks"))
    exact = exact.withColumn("origin", F.min(F.when(F.col("event_id") % 10 != 0, F.col("ticks"))).over(Window.partitionBy("part_id")))
    late = F.col("ticks") >= F.col("origin")
    return exact.select("event_id", "part_id", "ticks", F.when(late, F.col("ticks") - F.col("origin")).alias("relative"), F.coalesce(F.col("t.reason"), F.when(F.col("ticks") < F.col("origin"), "part_relative_negative")).alias("reason"), F.col("ms.ticks").alias("in_ms"), F.col("ms.reason").alias("ms_reason"))


@query(sql(f"SELECT event_id, floor(s / 1000.0)::BIGINT AS start_ms, ceil(e / 1000.0)::BIGINT AS end_ms, CASE WHEN s >= 0 THEN {_stamp_sql('((s // 1000) % 86400000)')} END AS start_s FROM (SELECT event_id, CASE WHEN event_id % 3 = 1 THEN -end_t - 7 ELSE start_t + 7 END AS s, CASE WHEN event_id % 3 = 1 THEN -start_t - 7 ELSE end_t + 7 END AS e FROM packets )"))
def B02_outward_ms(spark, sf_dir):
    """Microseconds outwards to milliseconds, before zero as well; times from zero on as time stamps of the day."""
    flip = F.col("event_id") % 3 == 1
    rows = inputs.packets(spark, sf_dir).select("event_id", F.when(flip, -F.col("end_t") - 7).otherwise(F.col("start_t") + 7).alias("s"), F.when(flip, -F.col("start_t") - 7).otherwise(F.col("end_t") + 7).alias("e"))
    start, end = columns.outward("s", "e", 1000)
    return rows.select("event_id", start.alias("start_ms"), end.alias("end_ms"), F.when(F.col("s") >= 0, columns.stamp(F.pmod(start, F.lit(86400000)))).alias("start_s"))


@query(r"SELECT doc_id, len(regexp_extract_all(text, '[ \t\n\x0b\f\r]+|[^ \t\n\x0b\f\r]+'))::BIGINT AS n_tokens, len(regexp_extract_all(text, '[ \t\n\x0b\f\r]+'))::BIGINT AS n_blank FROM documents")
def B03_normalize_and_tokenize(spark, sf_dir):
    """Lossless runs of white space and of anything else."""
    rows = inputs.table(spark, sf_dir, "documents").select("doc_id", columns.tokens(F.col("text")).alias("tokens"))
    return rows.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.size(F.filter("tokens", lambda t: t.rlike(r"^\s"))).cast("long").alias("n_blank"))


#: Pages whose simple tags some have blanks, attributes or font names, each kind in a seventh of them.
_VARIANTS = (("<b>", "<b >"), ("</b>", "</b >"), ("<p>", '<font color="x">'), ("<p>", "<FONT\tsize=1>"), ("</p>", "</font >"))
_TAGGED = "SELECT page_id, CASE page_id % 7 " + " ".join(f"WHEN {k + 1} THEN replace(html, '{a}', '{b}')" for k, (a, b) in enumerate(_VARIANTS[:2])) + r""" WHEN 3 THEN replace(replace(html, '<p>', '<font color="x">'), '</p>', '</font>')
    WHEN 4 THEN replace(replace(html, '<p>', '<FONT' || chr(9) || 'size=1>'), '</p>', '</font>') WHEN 5 THEN replace(replace(html, '<p>', '<font>'), '</p>', '</font >') ELSE html END AS html FROM pages"""
_PIECES = r"(?i)</?(?:b|i|u|font)>|</?font[ \t]+[^<>]*>|[^<]+|<"
_MARKED = "SELECT page_id, html, row_number() OVER (PARTITION BY page_id ORDER BY i) AS rn, at_, at_ + length(piece) AS after_, lower(regexp_extract(piece, '(?i)^</?(b|i|u|font)[ \\t>]', 1)) AS name, piece[1:2] = '</' AS closing FROM (SELECT page_id, html, i, p[i] AS piece, coalesce(sum(length(p[i])) OVER (PARTITION BY page_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at_ FROM (SELECT page_id, html, p, unnest(generate_series(1, len(p))) AS i FROM (SELECT page_id, html, regexp_extract_all(html, '" + _PIECES + "') AS p FROM tagged ))) WHERE regexp_matches(piece, '(?i)^<(b|i|u|font)[ \\t>]|^</(b|i|u|font)>')"
_WALK = """SELECT page_id, 0::BIGINT AS rn, []::VARCHAR[] AS open_, []::BIGINT[] AS starts, 0::BIGINT AS removed, 0::BIGINT AS cut, NULL::BIGINT AS first_at FROM (SELECT DISTINCT page_id FROM marked )
    UNION ALL SELECT m.page_id, m.rn, CASE WHEN closes THEN open_[1:len(open_) - 1] WHEN m.closing THEN open_ ELSE list_append(open_, m.name || '|' || (m.after_ - m.at_)::VARCHAR) END, CASE WHEN closes THEN starts[1:len(starts) - 1] WHEN m.closing THEN starts ELSE list_append(starts, m.at_) END,
      removed + CASE WHEN closes THEN 2 ELSE 0 END, cut + CASE WHEN closes THEN m.after_ - m.at_ + split_part(open_[len(open_)], '|', 2)::BIGINT ELSE 0 END, CASE WHEN closes THEN least(coalesce(first_at, starts[len(starts)]), starts[len(starts)]) ELSE first_at END
    FROM (SELECT m.*, w.open_, w.starts, w.removed, w.cut, w.first_at, m.closing AND len(w.open_) > 0 AND split_part(w.open_[len(w.open_)], '|', 1) = m.name AS closes FROM walk w JOIN marked m ON m.page_id = w.page_id AND m.rn = w.rn + 1) m"""


@query(sql(r"""SELECT p.page_id, coalesce(removed, 0) AS removed, length(p.html) - coalesce(cut, 0) AS chars, CASE WHEN first_at IS NOT NULL THEN len(regexp_extract_all(substr(p.html, 1, first_at + 1), '[ \t\n\x0b\f\r]+|[^ \t\n\x0b\f\r]+')) - 1 END AS first_token,
    len(regexp_extract_all(p.html, '<[^<>]*>')) - coalesce(removed, 0) AS unhandled
    FROM tagged p LEFT JOIN (SELECT page_id, arg_max(removed, rn) AS removed, arg_max(cut, rn) AS cut, max_by(first_at, rn) AS first_at FROM walk GROUP BY page_id) USING (page_id)""", tagged=_TAGGED, marked=_MARKED, walk=_WALK).replace("WITH ", "WITH RECURSIVE ", 1))
def B04_strip_markup(spark, sf_dir):
    """Pages without their closed simple tags, the token where the first one stood, and how many tags are left to be told of."""
    pages, k = inputs.table(spark, sf_dir, "pages"), F.col("page_id") % 7
    to = lambda *pairs: reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, F.col("html"))
    html = (F.when(k == 1, to(_VARIANTS[0])).when(k == 2, to(_VARIANTS[1])).when(k == 3, to(_VARIANTS[2], ("</p>", "</font>"))).when(k == 4, to(_VARIANTS[3], ("</p>", "</font>"))).when(k == 5, to(("<p>", "<font>"), _VARIANTS[4])).otherwise(F.col("html")))
    found = cu.strip_markup(pages.select("page_id", html.alias("html")), "html")
    return found.select("page_id", F.size("corrections").cast("long").alias("removed"), F.length("stripped").cast("long").alias("chars"), F.get("corrections", F.lit(0))["first_token"].cast("long").alias("first_token"), F.size("diagnostics").cast("long").alias("unhandled"))


_PAGE_URLS = "SELECT page_id, CASE WHEN page_id % 4 = 1 THEN replace(url, '://', '://user:secret@') WHEN page_id % 4 = 2 THEN regexp_replace(url, '^([a-z]+://[^/?#]*)', '\\1:8443') ELSE url END AS url FROM pages"
_HOST = "lower(regexp_extract(url, '^[A-Za-z]+://(?:[^/?#@]*@)*([^/?#@:]*)', 1))"
_PATH = "regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)"
_URL = f"SELECT page_id, url, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) AS scheme, {_HOST} AS host, CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END AS path FROM page_urls "


def _urls(spark, sf_dir) -> DataFrame:
    """Page addresses, some with a user and password or with a port."""
    k = F.col("page_id") % 4
    url = F.when(k == 1, F.replace("url", F.lit("://"), F.lit("://user:secret@"))).when(k == 2, F.regexp_replace("url", "^([a-z]+://[^/?#]*)", "$1:8443")).otherwise(F.col("url"))
    return inputs.table(spark, sf_dir, "pages").select("page_id", url.alias("url"))


@query(sql("SELECT page_id, scheme || '://' || host || path AS redacted, scheme = 'https' AS https FROM urls ", page_urls=_PAGE_URLS, urls=_URL))
def B08_redact_url(spark, sf_dir):
    """Scheme, host and path only: no user, password, port, query or fragment."""
    rows = _urls(spark, sf_dir).withColumn("u", urls.redacted(F.col("url")))
    return rows.select("page_id", F.concat("u.scheme", F.lit("://"), "u.host", "u.path").alias("redacted"), F.col("u.https").alias("https"))


@query(sql("""SELECT page_id, CASE WHEN again THEN 'duplicate_url' WHEN scheme = 'http' AND (collection % 2 = 1 OR sum(CASE WHEN scheme = 'http' AND NOT again THEN 1 ELSE 0 END) OVER (PARTITION BY collection ORDER BY page_id) > 1) THEN 'insecure_http_not_authorized' ELSE 'authorized' END AS entry,
      CASE WHEN host <> lead_host AND NOT (collection % 3 = 0 AND lead_host LIKE 'm.%') THEN 'host_escalation' WHEN scheme = 'https' AND lead_scheme <> 'https' THEN 'https_downgrade' ELSE 'allowed' END AS destination
    FROM (SELECT *, page_id % 10 AS collection, row_number() OVER (PARTITION BY page_id % 10, url ORDER BY page_id) > 1 AS again, coalesce(lead(host) OVER w, host) AS lead_host, coalesce(lead(scheme) OVER w, scheme) AS lead_scheme FROM urls WINDOW w AS (PARTITION BY page_id % 10 ORDER BY page_id))""", page_urls=_PAGE_URLS, urls=_URL))
def B09_url_policy_check(spark, sf_dir):
    """Entries of collections, and where each leads (here to the next page), by the rules for duplicates, http, hosts and downgrades."""
    rows = _urls(spark, sf_dir).withColumn("collection", F.col("page_id") % 10)
    entries = urls.authorized(rows, "collection", "url", "page_id", rows.where("collection % 2 = 0").select("collection").distinct()).withColumnRenamed("verdict", "entry")
    visits = entries.withColumn("next", F.coalesce(F.lead("url").over(Window.partitionBy("collection").orderBy("page_id")), "url"))
    hosts = rows.select("collection", urls.redacted(F.col("url"))["host"].alias("host")).where("collection % 3 = 0 and host like 'm.%'")
    return urls.destinations(visits, "url", "next", hosts, "collection").select("page_id", "entry", F.col("verdict").alias("destination"))


@query(sql("SELECT part_id, source_ordinal, round_even(start_t * 16000 / 1000.0, 0)::BIGINT AS first_sample, least(greatest(round_even(end_t * 44100 / 1000.0, 0)::BIGINT, 0), 10000000) AS last_sample, (end_t - start_t) * 16000 % 1000 = 0 AS exact FROM cues "))
def B10_sample_time_map(spark, sf_dir):
    """Cue times as sample indexes, half to even, clamped to the file."""
    return inputs.cues(spark, sf_dir).select("part_id", "source_ordinal", columns.samples("start_t", 16000, 1000).alias("first_sample"), F.least(F.greatest(columns.samples("end_t", 44100, 1000), F.lit(0)), F.lit(10000000)).alias("last_sample"), ((F.col("end_t") - F.col("start_t")) * 16000 % 1000 == 0).alias("exact"))


@query(sql("""SELECT part_id // 10 AS collection, count(*) AS lines, sha256(string_agg('P' || i::VARCHAR || ':' || j::VARCHAR || ' ' || text, chr(10) ORDER BY i, j)) AS prompt_sha256, count(*) + count(DISTINCT part_id) AS aliases, count(*) AS mapped FROM (
    SELECT *, dense_rank() OVER (PARTITION BY part_id // 10 ORDER BY part_id) - 1 AS i, row_number() OVER (PARTITION BY part_id ORDER BY start_t, end_t, source_ordinal) - 1 AS j FROM cues ) GROUP BY part_id // 10"""))
def B13_render_prompt_table(spark, sf_dir):
    """Cues under short names as one prompt per collection, and the way back from each name."""
    cues = inputs.cues(spark, sf_dir).withColumn("collection", F.floor(F.col("part_id") / 10))
    prompts, aliases = tracks.prompt_table(cues, "collection", "part_id")
    back = tracks.with_identities(aliases.select("collection", "alias"), aliases, "collection", "part_id").groupBy("collection").agg(F.count("*").alias("aliases"), F.count_if(F.col("identity").contains(":")).alias("mapped"))
    return prompts.join(back, "collection").select("collection", "lines", F.sha2("prompt", 256).alias("prompt_sha256"), "aliases", "mapped")



_ROLL = r"""SELECT part_id, source_ordinal, start_t, end_t, text FROM cues_r UNION ALL SELECT part_id, source_ordinal + 500000, start_t, end_t, text FROM cues_r WHERE (part_id + source_ordinal) % 5 = 0"""
_ROLL0 = r"""SELECT part_id, source_ordinal * 1000 + i AS source_ordinal, start_t + i * 900 AS start_t, start_t + i * 900 + CASE WHEN i % 3 = 2 THEN 700 ELSE 1000 END AS end_t, array_to_string(w[3 * i + 1 : 3 * i + 8], ' ') AS text
    FROM (SELECT part_id, source_ordinal, start_t, w, unnest(range(0, (len(w) + 2) // 3)) AS i FROM (SELECT part_id, source_ordinal, start_t, list_filter(regexp_split_to_array(text, '[ \t\n\x0b\f\r]+'), lambda x: x <> '') AS w FROM cues))"""


@query(sql(r"""SELECT part_id, source_ordinal, CASE WHEN exact THEN NULL ELSE coalesce(k, 0) END AS kept_from, CASE WHEN exact THEN 0 ELSE coalesce(k, 0) END AS readable_from, CASE WHEN ptext IS NULL THEN NULL WHEN exact THEN 'exact_duplicate_omitted' WHEN k IS NOT NULL THEN 'proven_rolling_overlap'
      WHEN len(list_filter(list_intersect(pt, t), lambda x: trim(x) <> '')) > 0 THEN 'possible_duplicate' END AS correction FROM (
    SELECT *, CASE WHEN ptext IS NOT NULL AND NOT exact AND start_t <= pend THEN list_max(list_filter(range(1, least(len(pt), len(t) - 1) + 1), lambda k: pt[len(pt) - k + 1 : len(pt)] = t[1:k] AND len(list_filter(t[1:k], lambda x: trim(x) <> '')) > 0)) END AS k FROM (
    SELECT *, coalesce(ptext = text AND pstart = start_t AND pend = end_t, false) AS exact, regexp_extract_all(text, '\s+|\S+') AS t, regexp_extract_all(ptext, '\s+|\S+') AS pt FROM (
    SELECT *, lag(text) OVER w AS ptext, lag(start_t) OVER w AS pstart, lag(end_t) OVER w AS pend FROM roll WINDOW w AS (PARTITION BY part_id ORDER BY start_t, end_t, source_ordinal))))""", cues_r=_ROLL0, roll=_ROLL))
def E03_rolling_dedup(spark, sf_dir):
    """What is said as rolling captions of eight words, five of them again in the next: exact repeats dropped, proven overlaps cut, other shared words flagged."""
    o, i = F.col("source_ordinal"), F.col("i")
    said = inputs.cues(spark, sf_dir).withColumn("w", columns.words("text")).where(F.size("w") > 0)
    spread = said.select("part_id", "source_ordinal", "start_t", "w", F.explode(F.sequence(F.lit(0), F.floor((F.size("w") + 2) / 3).cast("int") - 1)).alias("i"))
    base = spread.select("part_id", (o * 1000 + i).alias("source_ordinal"), (F.col("start_t") + i * 900).alias("start_t"), (F.col("start_t") + i * 900 + F.when(i % 3 == 2, 700).otherwise(1000)).alias("end_t"), F.array_join(F.slice("w", i * 3 + 1, 8), " ").alias("text"))
    both = base.unionByName(base.where((F.col("part_id") + o) % 5 == 0).withColumn("source_ordinal", o + 500_000))
    rows = both.withColumn("tokens", columns.tokens(F.col("text")))
    readable = cu.rolling(rows, "part_id", readable=True).select("part_id", "source_ordinal", F.col("kept_from").cast("long").alias("readable_from"))
    return cu.rolling(rows, "part_id").select("part_id", "source_ordinal", F.col("kept_from").cast("long").alias("kept_from"), "correction").join(readable, ["part_id", "source_ordinal"])


@query(sql("SELECT part_id, source_ordinal, row_number() OVER (PARTITION BY part_id ORDER BY start_t, end_t, source_ordinal) AS place FROM cues "))
def H01_cue_order(spark, sf_dir):
    """The total order of cues."""
    return tracks.in_order(inputs.cues(spark, sf_dir), "part_id").select("part_id", "source_ordinal", "place")



_CAND = "SELECT part_id, role AS track, bool_and(start_t < end_t) AND NOT (part_id % 9 = 1 AND role = 'user') AND part_id % 8 <> 6 AS valid, part_id % 6 = 0 AND role = 'user' AS ambiguous, max(CASE WHEN part_id % 4 = 1 THEN 'assistant' WHEN part_id % 12 = 7 THEN 'nobody' END) AS selected FROM cues GROUP BY part_id, role"
_PART_STATE = """SELECT part_id, n_valid, CASE WHEN n_valid = 1 THEN only_track ELSE picked END AS track, CASE WHEN n_valid = 1 OR picked IS NOT NULL THEN 'completed' WHEN n_valid = 0 AND NOT amb THEN 'subtitle_unavailable_requires_asr_plan' WHEN n_valid > 1 AND selected IS NULL THEN 'awaiting_subtitle_selection' ELSE 'blocked' END AS state FROM (
    SELECT part_id, count(*) FILTER (valid) AS n_valid, min(track) FILTER (valid) AS only_track, max(CASE WHEN valid AND track = selected THEN track END) AS picked, bool_or(ambiguous) AS amb, max(selected) AS selected FROM cand GROUP BY part_id)"""


@query(sql("""SELECT part_id, n_valid, track, state, CASE WHEN bool_or(state = 'awaiting_subtitle_selection') OVER c THEN 'awaiting_subtitle_selection' WHEN bool_or(state = 'completed') OVER c AND bool_or(state LIKE 'subtitle_un%') OVER c THEN 'partial' WHEN bool_or(state = 'completed') OVER c THEN 'completed' ELSE 'blocked' END AS collection_state,
    count(*) FILTER (state LIKE 'subtitle_un%') OVER c AS asr_parts FROM part_states WINDOW c AS (PARTITION BY part_id // 4)""", cand=_CAND, part_states=_PART_STATE))
def D04_select_track(spark, sf_dir):
    """The one valid track of a part, or the one chosen by the user, or the part's state; and the state of its collection."""
    p = F.col("part_id")
    cand = inputs.cues(spark, sf_dir).groupBy("part_id", F.col("role").alias("track")).agg(F.bool_and(F.col("start_t") < F.col("end_t")).alias("ok"))
    cand = cand.select("part_id", "track", (F.col("ok") & ~((p % 9 == 1) & (F.col("track") == "user")) & (p % 8 != 6)).alias("valid"), ((p % 6 == 0) & (F.col("track") == "user")).alias("ambiguous"))
    chosen = cand.select("part_id", F.when(p % 4 == 1, "assistant").when(p % 12 == 7, "nobody").alias("selected")).where("selected is not null").distinct()
    parts = tracks.select_tracks(cand, chosen, "part_id").withColumn("collection", F.floor(p / 4))
    return parts.join(tracks.collection_state(parts, "collection"), "collection").select("part_id", "n_valid", "track", "state", "collection_state", "asr_parts")


@query(sql("SELECT user_id % 50 AS part_id, least(sum(CASE WHEN event_id % 97 = 0 THEN NULL ELSE round(value * 100)::BIGINT END), count(DISTINCT user_id) * 20000000)::BIGINT AS known, CASE WHEN bool_or(event_id % 97 = 0) THEN count(DISTINCT user_id) * 20000000 ELSE least(sum(round(value * 100)::BIGINT), count(DISTINCT user_id) * 20000000)::BIGINT END AS estimate FROM ev GROUP BY user_id % 50"))
def D15_subtitle_growth_estimate(spark, sf_dir):
    """Packet bytes of selected streams, at most a cap a stream; an unusable size means the cap."""
    rows = inputs._events(spark, sf_dir).select((F.col("user_id") % 50).alias("part_id"), "user_id", F.when(F.col("event_id") % 97 != 0, F.round(F.col("value") * 100).cast("long")).alias("size"))
    return tracks.growth_estimate(rows, "part_id", "user_id", 20_000_000)



@query(sql("SELECT part_id, source_ordinal, start_t, end_t, CASE WHEN role = 'user' THEN 'subtitle' ELSE 'asr' END AS provenance FROM cues "))
def I01_cue_provenance_union(spark, sf_dir):
    """Kept subtitle cues and ASR cues as one table, tagged."""
    rows = inputs.cues(spark, sf_dir)
    return tracks.with_provenance({"subtitle": rows.where("role = 'user'"), "asr": rows.where("role <> 'user'")}, ["part_id", "source_ordinal", "start_t", "end_t"])



@query(sql("""SELECT part_id, CASE WHEN s THEN 'subtitle' WHEN a THEN 'asr' ELSE 'unavailable' END AS basis, CASE WHEN NOT s AND NOT a THEN coalesce(lo, 0) END AS omitted_from, CASE WHEN NOT s AND NOT a THEN coalesce(hi, 1) END AS omitted_to, CASE WHEN NOT s AND NOT a THEN coalesce(why, 'no_valid_primary_track') END AS reason FROM (
    SELECT part_id, bool_or(role = 'system') AS s, bool_or(role = 'assistant' AND part_id % 3 <> 0) AS a, min(start_t) FILTER (part_id % 15 <> 3) AS lo, max(end_t) FILTER (part_id % 15 <> 3) AS hi, arg_min(CASE WHEN source_ordinal % 2 = 1 THEN 'syntax_invalid' ELSE 'duration_invalid' END, source_ordinal) FILTER (part_id % 15 <> 3 AND part_id % 15 <> 6 AND source_ordinal > 0) AS why FROM cues GROUP BY part_id)"""))
def C20_choose_cue_source(spark, sf_dir):
    """The selected subtitle, else the ASR transcript, else nothing, with the range left out and the first diagnostic."""
    cues, p, o = inputs.cues(spark, sf_dir), F.col("part_id"), F.col("source_ordinal")
    why = F.when((p % 15 != 6) & (o > 0), F.when(o % 2 == 1, "syntax_invalid").otherwise("duration_invalid"))
    candidates = cues.where("part_id % 15 <> 3").select("part_id", o.alias("pos"), "start_t", "end_t", why.alias("diagnostic"))
    return tracks.choose_source(cues, cues.where("role = 'system'"), cues.where("role = 'assistant' and part_id % 3 <> 0"), candidates, "part_id")


_SELECTORS = """SELECT part_id + CASE WHEN part_id % 10 = 9 THEN 100000000 ELSE 0 END AS part_id, source_ordinal AS selector_id, CASE source_ordinal % 3 WHEN 0 THEN 'part' WHEN 1 THEN 'range' ELSE 'cue' END AS kind, CASE WHEN source_ordinal % 3 = 1 THEN start_t END AS start_t,
    CASE WHEN source_ordinal % 3 = 1 THEN end_t + CASE WHEN part_id % 7 = 2 THEN 100000000 WHEN part_id % 7 = 4 THEN -100000000 ELSE 0 END END AS end_t, CASE WHEN source_ordinal % 3 = 2 THEN source_ordinal + CASE WHEN part_id % 11 = 5 THEN 1000 ELSE 0 END END AS ordinal FROM cues WHERE source_ordinal % 4 = 1 OR part_id % 3 = 0"""
_RESOLVED = """SELECT s.selector_id, s.part_id, s.kind, CASE WHEN s.kind = 'part' THEN lo WHEN s.kind = 'range' THEN s.start_t ELSE c.start_t END AS start_t, CASE WHEN s.kind = 'part' THEN hi WHEN s.kind = 'range' THEN s.end_t ELSE c.end_t END AS end_t,
      CASE WHEN lo IS NULL THEN 'enhancement_part_unknown' WHEN s.kind = 'range' AND s.start_t >= s.end_t THEN 'enhancement_range_invalid' WHEN s.kind = 'range' AND (s.start_t < lo OR s.end_t > hi) THEN 'enhancement_range_out_of_coverage' WHEN s.kind = 'cue' AND c.start_t IS NULL THEN 'enhancement_cue_unknown' END AS reason
    FROM selectors s LEFT JOIN (SELECT part_id, min(start_t) AS lo, max(end_t) AS hi FROM cues GROUP BY part_id) e ON e.part_id = s.part_id LEFT JOIN cues c ON c.part_id = s.part_id AND c.source_ordinal = s.ordinal"""
_SCOPE = f"(SELECT part_id, start_t, end_t FROM resolved WHERE part_id NOT IN (SELECT part_id FROM resolved WHERE reason IS NOT NULL))"


@query(sql(f"SELECT part_id, selector_id, start_t, end_t, reason FROM (SELECT part_id, selector_id, CASE WHEN reason IS NULL THEN start_t END AS start_t, CASE WHEN reason IS NULL THEN end_t END AS end_t, reason FROM resolved ) UNION ALL SELECT part_id, -1, start_t, end_t, 'scope' FROM {iv.union_sql(_SCOPE, 'part_id')} UNION ALL SELECT part_id, s, min(start_t), max(end_t), CASE WHEN s = -3 THEN 'scope' END FROM cues, (VALUES (-2), (-3)) v(s) GROUP BY part_id, s", selectors=_SELECTORS, resolved=_RESOLVED))
def B11_selector_scope(spark, sf_dir):
    """User selectors resolved against retained cues, or why not, and each part's merged scope."""
    cues, p, o = inputs.cues(spark, sf_dir), F.col("part_id"), F.col("source_ordinal")
    kind = F.when(o % 3 == 0, "part").when(o % 3 == 1, "range").otherwise("cue")
    far = F.when(p % 7 == 2, 100_000_000).when(p % 7 == 4, -100_000_000).otherwise(0)
    selectors = cues.where("source_ordinal % 4 = 1 or part_id % 3 = 0").select(
        (p + F.when(p % 10 == 9, 100_000_000).otherwise(0)).alias("part_id"), o.alias("selector_id"), kind.alias("kind"), F.when(o % 3 == 1, F.col("start_t")).alias("start_t"), F.when(o % 3 == 1, F.col("end_t") + far).alias("end_t"),
        F.when(o % 3 == 2, o + F.when(p % 11 == 5, 1000).otherwise(0)).alias("source_ordinal"))
    resolved, scope = tracks.selector_scope(selectors, cues, "part_id")
    merged = scope.select("part_id", F.lit(-1).alias("selector_id"), "start_t", "end_t", F.lit("scope").alias("reason"))
    one = spark.range(1).select(F.lit(-2).cast("long").alias("selector_id"), F.lit(None).cast("long").alias("part_id"), F.lit("all").alias("kind"), *[F.lit(None).cast("long").alias(c) for c in ("start_t", "end_t", "source_ordinal")])
    every, whole = tracks.selector_scope(one, cues, "part_id")
    again = every.select("part_id", "selector_id", "start_t", "end_t", "reason").unionByName(whole.select("part_id", F.lit(-3).alias("selector_id"), "start_t", "end_t", F.lit("scope").alias("reason")))
    return resolved.select("part_id", "selector_id", "start_t", "end_t", "reason").unionByName(merged).unionByName(again)
