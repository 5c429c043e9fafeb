"""Subtitle payloads, cue parsing and rendering, probe documents and model outputs as DataFrames."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partwise.functions.columns import stamp

STAMP = r"^(?:(\d{2,}):)?([0-5]\d):([0-5]\d)[,.](\d{3})$"
PROBE = "streams array<struct<index:int,codec_type:string,codec_name:string,time_base:string,tags:struct<language:string>>>, packets array<struct<stream_index:int,pts:bigint,duration:bigint,size:bigint>>"
_SPAN = "array<struct<language:string,start_char:int,end_char:int>>"
ENVELOPES = {
    "asr": f"schema_version int, projection_version string, adapter string, capability string, cues array<struct<text:string,start_t:bigint,end_t:bigint,confidence:double,language_spans:{_SPAN}>>",
    "ocr": f"schema_version int, projection_version string, adapter string, capability string, result struct<items:array<struct<part_id:string,visual_page_id:string,pts:struct<numerator:bigint,denominator:bigint>,text:string,confidence:double,language_spans:{_SPAN}>>>",
    "text": "schema_version int, projection_version string, adapter string, capability string, result map<string,string>",
}
MOST_BYTES = 256 << 20


def read_payloads(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, content) of raw files below a folder; empty files are not listed."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "content")


def hashed(payloads: DataFrame) -> DataFrame:
    """(path, sha256, size) of raw files (path, content)."""
    return payloads.select("path", F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("size"))


def one_source_each(files: DataFrame) -> DataFrame:
    """(sha256, size, kept, copies) of hashed files: one source for equal bytes, kept under its first path."""
    return files.groupBy("sha256", "size").agg(F.min("path").alias("kept"), F.count(F.lit(1)).alias("copies"))


def distinct_parts(parts: DataFrame, files: DataFrame, collection: str, part: str) -> DataFrame:
    """parts (collection, part, path) with the sha256 and size of their file and a reason: source_unavailable, or duplicate_part for every part of a collection whose bytes an earlier one has."""
    rows = parts.join(files, "path", "left")
    place = F.row_number().over(Window.partitionBy(collection, "sha256").orderBy(part))
    return rows.withColumn("reason", F.when(F.col("sha256").isNull(), "source_unavailable").when(place > 1, "duplicate_part"))


def _whole_utf16(body: Column, big_endian: bool) -> Column:
    """Whether bytes are UTF-16: an even number of them, and surrogates only in pairs, high before low.

    Bytes are taken as Latin-1 characters, two to a unit, and the first surrogate is looked for that is a high one without
    a low one behind it, or a low one without a high one before it: one pass, without recursion.
    """
    unit = (lambda top: rf"[{top}].") if big_endian else (lambda top: rf".[{top}]")
    high, low, either = unit(r"\xD8-\xDB"), unit(r"\xDC-\xDF"), unit(r"\xD8-\xDF")
    alone = rf"(?s)\A(?:..)*?{either}(?:(?<={high})(?!{low})|(?<={low})(?<!{high}{low}))"
    return (F.length(body) % 2 == 0) & ~F.decode(body, "ISO-8859-1").rlike(alone)


def decoded(payloads: DataFrame, decoder: str | None = None) -> DataFrame:
    """Adds state and text of content. A requested decoder (a column: utf-8, utf-16le or utf-16be) decides, else the
    UTF-8 and UTF-16 marks, else strict UTF-8; anything that is not whole in that encoding is encoding_ambiguous, and a
    payload of MOST_BYTES or more incomplete."""
    content = F.col("content")
    asked = F.lower(F.col(decoder)) if decoder else F.lit(None).cast("string")
    head = F.hex(F.substring(content, 1, 3))
    mark = F.when(head == "EFBBBF", "utf-8").when(head.startswith("FFFE"), "utf-16le").when(head.startswith("FEFF"), "utf-16be")
    rows = payloads.withColumn("_as", F.coalesce(asked, mark, F.lit("utf-8"))).withColumn("_body", F.when(mark == F.col("_as"), F.when(mark == "utf-8", F.expr("substring(content, 4)")).otherwise(F.expr("substring(content, 3)"))).otherwise(content))
    body, kind = F.col("_body"), F.col("_as")
    whole = F.when(kind == "utf-8", F.is_valid_utf8(body.cast("string"))).when(kind == "utf-16le", _whole_utf16(body, False)).when(kind == "utf-16be", _whole_utf16(body, True)).otherwise(F.lit(False))
    rows = rows.withColumn("state", F.when(F.length(content) >= MOST_BYTES, "incomplete").when(whole, "decoded").otherwise("encoding_ambiguous"))
    text = F.when(F.col("state") == "decoded", F.when(kind == "utf-8", body.cast("string")).when(kind == "utf-16le", F.decode(body, "UTF-16LE")).otherwise(F.decode(body, "UTF-16BE")))
    return rows.withColumn("text", text).drop("_as", "_body")


def _ms(value: Column) -> Column:
    """A time stamp in milliseconds; null if it is none."""
    part = lambda k: F.regexp_extract(value, STAMP, k).cast("bigint")
    hours = F.when(F.regexp_extract(value, STAMP, 1) == "", F.lit(0).cast("bigint")).otherwise(F.regexp_extract(value, STAMP, 1).cast("bigint"))
    return F.when(value.rlike(STAMP), ((hours * 60 + part(2)) * 60 + part(3)) * 1000 + part(4))


def _is_timing(line: Column) -> Column:
    sides = F.split(line, "-->")
    end = F.regexp_extract(F.trim(F.get(sides, F.lit(1))), r"^(\S*)", 1)
    return (F.size(sides) == 2) & F.trim(F.get(sides, F.lit(0))).rlike(STAMP) & end.rlike(STAMP)


def parse_cues(files: DataFrame, *keys: str, form: str = "srt") -> tuple[DataFrame, DataFrame]:
    """(tracks, cues) of files (keys, text) in one form, srt or vtt.

    Blocks stand between blank lines: at most one identifier line, a timing line, text. SRT times have a comma and no
    settings; VTT has the header WEBVTT, times with a point and perhaps without hours, settings, and NOTE, STYLE and
    REGION blocks, which are passed over. tracks has the reason of refusal (syntax_invalid or duration_invalid, of the
    first wrong block) and n_cues; one wrong block, a wrong header or no cue refuses the whole track.
    cues: keys, ordinal, identifier, settings, start_t, end_t, text.
    """
    lines = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), r"\A\uFEFF+", ""), r"\r\n?", "\n")
    rows = files.withColumn("_t", lines)
    header = F.lit(True) if form == "srt" else F.col("_t").rlike(r"\AWEBVTT(?:[ \t\n]|\z)")
    body = F.col("_t") if form == "srt" else F.regexp_replace("_t", r"\A[^\n]*\n?", "")
    blocks = F.filter(F.transform(F.split(body, r"\n(?:[ \t]*\n)+"), lambda b: F.regexp_replace(b, r"\A\n+|\n+\z", "")), lambda b: b.rlike(r"(?U)\S"))
    if form == "vtt":
        second = lambda b: F.get(F.split(b, "\n"), F.lit(1))
        blocks = F.filter(blocks, lambda b: ~(F.get(F.split(b, "\n"), F.lit(0)).rlike(r"^(NOTE|STYLE|REGION)([ \t]|$)") & ~F.coalesce(_is_timing(second(b)), F.lit(False))))
    rows = rows.select(*keys, header.alias("_good"), F.posexplode_outer(blocks).alias("ordinal", "_b")).withColumn("_l", F.split("_b", "\n"))
    at = F.array_position(F.transform("_l", lambda x: x.contains("-->")), True).cast("int") - 1
    rows = rows.withColumn("_at", at).withColumn("_sides", F.split(F.get("_l", F.greatest("_at", F.lit(0))), "-->"))
    right = F.trim(F.get("_sides", F.lit(1)))
    rows = rows.withColumn("_a", F.trim(F.get("_sides", F.lit(0)))).withColumn("_e", F.regexp_extract(right, r"^(\S*)", 1)).withColumn("settings", F.trim(F.regexp_extract(right, r"^\S*\s+([\s\S]*)$", 1)))
    rows = rows.withColumn("start_t", _ms(F.col("_a"))).withColumn("end_t", _ms(F.col("_e"))).withColumn("text", F.array_join(F.slice("_l", F.greatest(F.col("_at"), F.lit(0)) + 2, F.size("_l")), "\n"))
    wrong_point = F.concat("_a", "_e").contains("." if form == "srt" else ",")
    syntax = F.col("_b").isNull() | (F.col("_at") < 0) | (F.col("_at") > 1) | (F.size("_sides") != 2) | wrong_point | F.col("start_t").isNull() | F.col("end_t").isNull()
    if form == "srt":
        syntax = syntax | (F.col("settings") != "")
    no_text = ~F.col("text").rlike(r"(?U)\S")
    error = F.when(F.coalesce(syntax, F.lit(True)), "syntax_invalid").when(F.col("start_t") >= F.col("end_t"), "duration_invalid").when(no_text, "syntax_invalid")
    rows = rows.withColumn("_error", error)
    first = F.min_by("_error", F.when(F.col("_error").isNotNull(), F.coalesce("ordinal", F.lit(0))))
    rows = rows.withColumn("reason", F.when(~F.col("_good"), "syntax_invalid").otherwise(first.over(Window.partitionBy(*keys))))
    tracks = rows.groupBy(*keys).agg(F.first("reason").alias("reason"), F.count_if(F.col("reason").isNull()).alias("n_cues"))
    identifier = F.when(F.col("_at") == 1, F.trim(F.get("_l", F.lit(0))))
    return tracks, rows.where("reason is null").select(*keys, "ordinal", identifier.alias("identifier"), "settings", "start_t", "end_t", "text")


def rendered(cues: DataFrame, *keys: str, form: str = "srt", source_order: bool = False) -> DataFrame:
    """(keys, text, losses, reason): one SRT or VTT text per track, cues in order (start_t, end_t, source_ordinal), times in milliseconds; with source_order as they came, by source_ordinal.

    A cue's identifier, where it has one, else its place stands before it. Settings stay in VTT; SRT leaves them out and
    tells each in losses (source_ordinal, settings). A negative time refuses the track (negative_time).
    """
    named = lambda c: F.col(c) if c in cues.columns else F.lit(None).cast("string")
    rows = cues.select(*keys, "source_ordinal", "start_t", "end_t", "text", named("identifier").alias("identifier"), F.coalesce(named("settings"), F.lit("")).alias("settings"))
    point = "," if form == "srt" else "."
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(*(() if source_order else ("start_t", "end_t")), "source_ordinal")))
    timing = F.concat(stamp(F.col("start_t"), point), F.lit(" --> "), stamp(F.col("end_t"), point))
    if form == "vtt":
        timing = F.when(F.col("settings") != "", F.concat(timing, F.lit(" "), "settings")).otherwise(timing)
    name = F.coalesce(F.when(F.col("identifier") != "", F.col("identifier")), F.col("n").cast("string"))
    block = F.concat(name, F.lit("\n"), timing, F.lit("\n"), F.col("text"), F.lit("\n"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", block.alias("block")))), lambda b: b["block"]), "\n")
    lost = F.transform(F.sort_array(F.collect_list(F.when(F.col("settings") != "", F.struct("n", "source_ordinal", "settings")))), lambda x: F.struct(x["source_ordinal"].alias("source_ordinal"), x["settings"].alias("settings")))
    g = rows.groupBy(*keys).agg(text.alias("_text"), lost.alias("_lost"), F.bool_or((F.col("start_t") < 0) | (F.col("end_t") < 0)).alias("_below"))
    whole = F.col("_text") if form == "srt" else F.concat(F.lit("WEBVTT\n\n"), F.col("_text"))
    none = F.array().cast("array<struct<source_ordinal:bigint,settings:string>>")
    losses = F.when(~F.col("_below"), F.col("_lost").cast("array<struct<source_ordinal:bigint,settings:string>>")).otherwise(none) if form == "srt" else none
    return g.select(*keys, F.when(~F.col("_below"), whole).alias("text"), losses.alias("losses"), F.when(F.col("_below"), "negative_time").alias("reason"))


def source_rendered(files: DataFrame, *keys: str, form: str, to: str) -> DataFrame:
    """(keys, text, losses, reason) of subtitle files (keys, text) of one form as srt or vtt, every cue as its source has it and in its order.

    A VTT source stays VTT as it is, but for line ends; SRT leaves out what it cannot hold and tells it in losses
    (source_ordinal, lost): a header that says more than WEBVTT and NOTE, STYLE and REGION blocks (null), then the
    settings of cues. A file that parse_cues refuses has no text, and its reason.
    """
    tracks, cues = parse_cues(files, *keys, form=form)
    lines = F.regexp_replace(F.coalesce("text", F.lit("")), r"\r\n?", "\n")
    lost = "array<struct<source_ordinal:bigint,lost:string>>"
    if (form, to) == ("vtt", "vtt"):
        texts = files.select(*keys, lines.alias("_text"), F.array().cast(lost).alias("losses"))
    else:
        made = rendered(cues.withColumnRenamed("ordinal", "source_ordinal"), *keys, form=to, source_order=True)
        texts = made.select(*keys, F.col("text").alias("_text"), F.transform("losses", lambda x: F.struct(x["source_ordinal"].cast("bigint").alias("source_ordinal"), x["settings"].alias("lost"))).alias("losses"))
        if form == "vtt":
            whole = F.regexp_replace(lines, r"\A\uFEFF+", "")
            blocks = F.transform(F.split(F.regexp_replace(whole, r"\A[^\n]*\n?", ""), r"\n(?:[ \t]*\n)+"), lambda b: F.regexp_replace(b, r"\A\n+|\n+\z", ""))
            first = lambda b: F.get(F.split(b, "\n"), F.lit(0))
            directives = F.filter(blocks, lambda b: first(b).rlike(r"^(NOTE|STYLE|REGION)([ \t]|$)") & ~F.coalesce(_is_timing(F.get(F.split(b, "\n"), F.lit(1))), F.lit(False)))
            header = first(whole)
            above = F.transform(F.concat(F.when(header != "WEBVTT", F.array(header)).otherwise(F.array().cast("array<string>")), directives), lambda x: F.struct(F.lit(None).cast("bigint").alias("source_ordinal"), x.alias("lost")))
            texts = texts.join(files.select(*keys, above.alias("_above")), [*keys]).withColumn("losses", F.concat("_above", "losses")).drop("_above")
    rows = tracks.select(*keys, "reason").join(texts, [*keys], "left")
    good = F.col("reason").isNull()
    return rows.select(*keys, F.when(good, F.col("_text")).alias("text"), F.when(good, F.col("losses")).otherwise(F.array().cast(lost)).alias("losses"), "reason")


def transcripts(cues: DataFrame, *keys: str) -> DataFrame:
    """The cue lines of a part in order as one text."""
    lines = F.sort_array(F.collect_list(F.struct("start_t", "end_t", "source_ordinal", "text")))
    return cues.groupBy(*keys).agg(F.array_join(F.transform(lines, lambda c: c["text"]), "\n").alias("text"))


def read_probe(documents: DataFrame, *keys: str) -> DataFrame:
    """(keys, state, streams, packets) of media probe documents in column json.

    A stream without an index, a codec type or a time base of two whole numbers above zero, or a packet of an audio or
    video stream without a pts and a duration above zero, refuses the document (probe_invalid). A packet that names no
    stream counts as one of those.
    """
    parsed = documents.select(*keys, F.from_json("json", PROBE).alias("d"))
    timed = lambda s: s["time_base"].isNull() | s["time_base"].rlike(r"^[1-9]\d*/[1-9]\d*$")
    needed = lambda s: ~s["codec_type"].isin("audio", "video", "subtitle") | s["time_base"].isNotNull()
    streams = F.forall(F.coalesce("d.streams", F.array()), lambda s: s["index"].isNotNull() & s["codec_type"].isNotNull() & timed(s) & needed(s))
    exempt = F.transform(F.filter(F.coalesce("d.streams", F.array()), lambda s: ~s["codec_type"].isin("audio", "video")), lambda s: s["index"])
    packets = F.forall("d.packets", lambda p: F.coalesce(F.array_contains(exempt, p["stream_index"]), F.lit(False)) | (p["pts"].isNotNull() & (F.coalesce(p["duration"], F.lit(0)) > 0)))
    good = F.coalesce(streams & packets, F.lit(False))
    return parsed.select(*keys, F.when(good, "accepted").otherwise("probe_invalid").alias("state"), F.col("d.streams").alias("streams"), F.col("d.packets").alias("packets"))


def subtitle_tracks(probes: DataFrame, *keys: str) -> DataFrame:
    """One row per subtitle stream of an accepted document, with its language and format."""
    return probes.where("state = 'accepted'").select(*keys, F.inline("streams")).where("codec_type = 'subtitle'").select(*keys, "index", F.col("tags.language").alias("language"), F.col("codec_name").alias("format"))


def read_envelopes(outputs: DataFrame, *keys: str, kind: str = "asr", schema_version: int = 1, projection_version: str = "v1", capabilities: tuple[str, ...] = ("asr", "ocr", "text")) -> DataFrame:
    """(keys, valid, reason, items) of model outputs of one kind (asr, ocr, text) in column json, a Markdown fence removed.

    Wrong versions, no adapter, an unknown capability, a missing field, a confidence outside 0 to 1, an empty interval or
    a language span that is empty or ends beyond its text refuse the whole envelope (model_output_invalid).
    """
    body = F.regexp_replace("json", r"\A\s*```(?:json)?[ \t]*\n?|\n?\s*```\s*\z", "")
    e = outputs.select(*keys, F.from_json(body, ENVELOPES[kind]).alias("e"))
    spans = lambda x: F.forall(F.coalesce(x["language_spans"], F.array()), lambda s: F.coalesce((F.length(s["language"]) > 0) & (s["start_char"] >= 0) & (s["start_char"] < s["end_char"]) & (s["end_char"] <= F.length(x["text"])), F.lit(False)))
    if kind == "asr":
        items = F.col("e.cues")
        good = lambda c: c["text"].isNotNull() & (c["start_t"] < c["end_t"]) & (c["confidence"].isNull() | c["confidence"].between(0, 1)) & spans(c)
    elif kind == "ocr":
        items = F.col("e.result.items")
        good = lambda c: (F.length(c["part_id"]) > 0) & (F.length(c["visual_page_id"]) > 0) & c["pts"]["numerator"].isNotNull() & (c["pts"]["denominator"] > 0) & c["text"].isNotNull() & c["confidence"].between(0, 1) & spans(c)
    else:
        items, good = F.map_entries("e.result"), lambda c: c["key"].isNotNull()
    whole = (F.col("e.schema_version") == schema_version) & (F.col("e.projection_version") == projection_version) & (F.length("e.adapter") > 0) & F.col("e.capability").isin(*capabilities) & items.isNotNull() & F.forall(items, lambda c: F.coalesce(good(c), F.lit(False)))
    valid = F.coalesce(whole, F.lit(False))
    return e.select(*keys, valid.alias("valid"), F.when(~valid, "model_output_invalid").alias("reason"), F.when(valid, items).alias("items"))


_WORK: list[str] = []  # folders in use, for clear_work()


def work_folder(spark: SparkSession) -> str:
    """A new folder in the place that all executors share; where none is set, a local run takes a temporary one and a cluster refuses."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: written tables need a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-shared-")
    _WORK.append(f"{root.rstrip('/')}/{uuid.uuid4().hex}")
    return _WORK[-1]


def clear_work(spark: SparkSession) -> int:
    """Deletes what this process has written to work folders so far, once it is read; returns how many there were."""
    jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    while _WORK:
        path = jvm.org.apache.hadoop.fs.Path(_WORK.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def write_cues(cues: DataFrame, path: str, buckets: int = 16) -> None:
    """Cues in the shared candidate shape, in folders by part bucket."""
    cues.withColumn("part_bucket", F.pmod(F.xxhash64("part_id"), F.lit(buckets))).repartition("part_bucket").write.partitionBy("part_bucket").parquet(path)
