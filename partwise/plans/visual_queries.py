"""Queries of page index, on-screen text and segment operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partwise.operators import intervals as iv
from partwise.operators import screen as sc
from partwise.operators import segments as sg
from partwise.plans import inputs
from partwise.plans.inputs import HOURS_6, sql
from partwise.plans.registry import query

STABLE, CHANGED, LEGIBLE, SHORTEST = (sc.PAGES[k] for k in ("stability_min", "region_diff_change", "text_value_min", "minimum_transition_run"))
#: Rules for the sample's prose, of the same shape as the default ones.
CLASSES = {"minimum_confidence": 20, "excluded_markers": {"watermark": ["hewh", "sthti"], "player_ui": ["onth ", "ndsh"]}, "category_markers": {"background_ui": ["er th"], "speaker_supplement": ["and "]}}
HOST_READ = {"minimum_comment_length": 6, "match_window_seconds": 20, "selection_markers": ["t h"]}
_STRIP = "'" + sc.STRIPPED.replace("'", "''") + "'"


@query(sql("SELECT f.part_id, f.pts, f.place FROM frames f WHERE EXISTS (SELECT 1 FROM captions c WHERE c.part_id = f.part_id AND c.start_t <= f.pts AND f.pts < c.end_t)"))
def B05_frames_in_scope(spark, sf_dir):
    """Frames within any scope interval of their part, start included and end not."""
    scope = iv.union(inputs.captions(spark, sf_dir), "part_id")
    frames = inputs.frames(spark, sf_dir).withColumn("start_t", F.col("pts")).withColumn("end_t", F.col("pts") + 1)
    return iv.overlap_join(frames, scope, ["part_id"], HOURS_6).select("part_id", "pts", "place")


_SETTLED = f"SELECT *, NOT (region_diff >= {CHANGED} OR stability < {STABLE}) AS settled FROM frames "
_APPEAR = "SELECT part_id, fingerprint, run, min(pts) AS first_pts, max(pts) AS last_pts, count(*) AS n, min(place) AS seen_at FROM (SELECT *, sum(new) OVER (PARTITION BY part_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN settled = lag(settled) OVER w AND fingerprint = lag(fingerprint) OVER w THEN 0 ELSE 1 END AS new FROM settled_frames WINDOW w AS (PARTITION BY part_id ORDER BY place))) WHERE settled GROUP BY part_id, fingerprint, run"
_PAGED = "SELECT *, dense_rank() OVER (PARTITION BY part_id ORDER BY first_at) AS page FROM (SELECT *, min(seen_at) OVER (PARTITION BY part_id, fingerprint) AS first_at FROM appear )"


def _settled(spark, sf_dir) -> DataFrame:
    return sc.settled(inputs.frames(spark, sf_dir))


@query(sql("SELECT part_id, page, first_pts, last_pts, n FROM paged ", settled_frames=_SETTLED, appear=_APPEAR, paged=_PAGED))
def E04_page_index(spark, sf_dir):
    """Pages and their appearances; a fingerprint that comes back is the same page."""
    return sc.page_index(_settled(spark, sf_dir)).select("part_id", "page", "first_pts", "last_pts", "n")


_SELECTED = f"""SELECT f.part_id, f.place, CASE WHEN f.settled THEN p.page END AS page, CASE WHEN NOT f.settled THEN 'unselected_transition_frame' WHEN edge_density >= {LEGIBLE} AND f.place = min(CASE WHEN f.settled AND edge_density >= {LEGIBLE} THEN f.place END) OVER (PARTITION BY f.part_id, CASE WHEN f.settled THEN p.page END) THEN 'selected_page_representative'
      WHEN edge_density < {LEGIBLE} THEN 'unselected_below_text_value' ELSE 'unselected_duplicate_of_selected' END AS reason FROM settled_frames f LEFT JOIN (SELECT DISTINCT part_id, fingerprint, page FROM paged ) p ON p.part_id = f.part_id AND p.fingerprint = f.fingerprint"""


@query(sql("SELECT part_id, place, page, reason FROM chosen ", settled_frames=_SETTLED, appear=_APPEAR, paged=_PAGED, chosen=_SELECTED))
def E05_page_representative(spark, sf_dir):
    """Every frame with the reason why it is or is not its page's representative, the earliest legible settled frame."""
    return sc.frame_selection(_settled(spark, sf_dir)).select("part_id", "place", "page", "reason")


_TRANSITIONS = f"SELECT part_id, min(pts) AS start_t, max(pts) AS end_t, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY part_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN settled = lag(settled) OVER (PARTITION BY part_id ORDER BY place) THEN 0 ELSE 1 END AS new FROM settled_frames )) WHERE NOT settled GROUP BY part_id, run HAVING count(*) >= {SHORTEST}"


@query(sql("SELECT * FROM trans ", settled_frames=_SETTLED, trans=_TRANSITIONS))
def E06_transition_runs(spark, sf_dir):
    """Maximal runs of frames without a page, three at least."""
    return sc.transition_runs(_settled(spark, sf_dir))



@query(sql("""SELECT t.part_id, t.start_t, t.end_t, coalesce(string_agg(v.start_t::VARCHAR || '-' || v.end_t::VARCHAR, ',' ORDER BY v.start_t, v.end_t), '') AS audio, CASE WHEN t.part_id % 10 = 0 THEN 'picture_only' ELSE 'picture_plus_audio' END AS basis
    FROM trans t LEFT JOIN (SELECT * FROM vad WHERE state = 'speech_likely' AND part_id % 10 <> 0) v ON t.part_id = v.part_id AND v.start_t <= t.end_t AND t.start_t <= v.end_t GROUP BY t.part_id, t.start_t, t.end_t""", settled_frames=_SETTLED, trans=_TRANSITIONS))
def C17_embedded_media_audio(spark, sf_dir):
    """Transition runs with the active audio that they touch, both ends included; some parts have no audio report."""
    vad = inputs.vad(spark, sf_dir)
    found = sc.embedded_media(E06_transition_runs(spark, sf_dir).select("part_id", "start_t", "end_t"), vad, vad.where("part_id % 10 <> 0"), "part_id", HOURS_6)
    listed = F.array_join(F.transform("overlapping_audio", lambda x: F.concat(x["start_t"].cast("string"), F.lit("-"), x["end_t"].cast("string"))), ",")
    return found.select("part_id", "start_t", "end_t", listed.alias("audio"), "basis")


@query(sql(f"SELECT part_id, count(*) AS selected, count(*) * 3 AS seconds, count(*) * 4194304 AS bytes, count(*) <= 4 AS fits FROM (SELECT DISTINCT f.part_id, f.fingerprint FROM settled_frames f WHERE f.settled AND edge_density >= {LEGIBLE}) GROUP BY part_id", settled_frames=_SETTLED))
def D14_ocr_resource_plan(spark, sf_dir):
    """Seconds and bytes of reading each part's representative frames."""
    return sc.resource_plan(E05_page_representative(spark, sf_dir), "part_id", 3, 4_194_304, 4)



@query(sql("""SELECT i.cue_id, CASE WHEN e.lo IS NULL THEN 'visual_text_part_unknown' WHEN i.start_t < e.lo OR i.start_t >= e.hi THEN 'ocr_item_out_of_coverage' WHEN p.page IS NULL THEN 'ocr_item_unknown_page' WHEN NOT bool_or(p.first_pts <= i.start_t AND i.start_t <= p.last_pts) THEN 'ocr_item_page_time_mismatch' ELSE 'admitted' END AS outcome
    FROM captions i LEFT JOIN paged p ON p.part_id = i.part_id AND p.page = i.cue_id % 6 LEFT JOIN (SELECT part_id, min(pts) AS lo, max(pts) - 86400000000 AS hi FROM frames WHERE part_id % 31 <> 7 GROUP BY part_id) e ON e.part_id = i.part_id GROUP BY i.cue_id, i.part_id, i.start_t, p.page, e.lo, e.hi""", settled_frames=_SETTLED, appear=_APPEAR, paged=_PAGED))
def C05_ocr_item_gate(spark, sf_dir):
    """On-screen items refused for an unknown part or page, or a time outside coverage or every appearance of the page."""
    pages = sc.page_index(_settled(spark, sf_dir)).select("part_id", F.col("page").cast("long").alias("page"), "first_pts", "last_pts")
    items = inputs.captions(spark, sf_dir).select("part_id", "cue_id", F.col("start_t").alias("pts"), (F.col("cue_id") % 6).alias("page"))
    parts = inputs.frames(spark, sf_dir).where("part_id % 31 <> 7").groupBy("part_id").agg(F.min("pts").alias("start_t"), (F.max("pts") - 86_400_000_000).alias("end_t"))
    return sc.item_gate(items, parts, pages, "cue_id").select("cue_id", "outcome")


_KIND = "CASE " + " ".join(f"WHEN contains(text, '{m}') THEN '{k}'" for k, ms in CLASSES["excluded_markers"].items() for m in ms) + " END"
_MARKER = "CASE " + " ".join(f"WHEN contains(text, '{m}') THEN '{m}'" for ms in CLASSES["excluded_markers"].values() for m in ms) + " END"


@query(sql(f"SELECT doc_id, CASE WHEN ({_KIND}) IS NOT NULL THEN 'excluded' WHEN confidence < 20 THEN 'classification_uncertain' WHEN contains(text, 'er th') THEN 'background_ui' WHEN contains(text, 'and ') THEN 'speaker_supplement' ELSE 'page_text' END AS class, {_KIND} AS kind, {_MARKER} AS marker FROM ocr_items "))
def B06_classify_ocr_items(spark, sf_dir):
    """Items by fixed precedence: noise with its kind and marker, uncertain, categories, page text."""
    return sc.classified(inputs.ocr_items(spark, sf_dir), CLASSES).select("doc_id", "class", "kind", "marker")


@query(f"SELECT doc_id, sha256(translate(text, {_STRIP}, '')) AS matched FROM documents")
def B07_normalize_for_match(spark, sf_dir):
    """Texts without white space and punctuation, for comparison."""
    return inputs.table(spark, sf_dir, "documents").select("doc_id", F.sha2(sc.plain("text"), 256).alias("matched"))


_COMMENTS = f"SELECT part_id, source_ordinal AS comment_id, start_t AS pts, substr(translate(text, {_STRIP}, ''), 3, 6) AS phrase FROM cues WHERE length(translate(text, {_STRIP}, '')) >= 10"
_PLAIN = f"SELECT part_id, source_ordinal, start_t, end_t, translate(text, {_STRIP}, '') AS plain FROM cues "


@query(sql("""SELECT m.part_id, comment_id, string_agg(source_ordinal::VARCHAR, ',' ORDER BY start_t, source_ordinal) AS cited, CASE WHEN bool_or(contains(substr(plain, 1, instr(plain, phrase) - 1) || substr(plain, instr(plain, phrase) + length(phrase)), 'th')) THEN 'host_selected' ELSE 'host_read' END AS basis
    FROM comments m JOIN plain_cues c ON c.part_id = m.part_id AND c.start_t <= m.pts + 20000 AND m.pts - 20000 <= c.end_t AND contains(plain, phrase) GROUP BY m.part_id, comment_id""", comments=_COMMENTS, plain_cues=_PLAIN))
def C06_host_read_upgrade(spark, sf_dir):
    """Comments that cues nearby read out, these cues in order; a marker beside the comment's first place says that the host chose it."""
    cues = inputs.cues(spark, sf_dir)
    comments = cues.withColumn("p", sc.plain("text")).where("length(p) >= 10").select("part_id", F.col("source_ordinal").alias("comment_id"), F.col("start_t").alias("pts"), F.expr("substring(p, 3, 6)").alias("text"))
    found = sc.host_reads(comments, cues, "part_id", "comment_id", "source_ordinal", 60_000, 1000, HOST_READ)
    return found.select("part_id", "comment_id", F.array_join(F.transform("cited", lambda c: c.cast("string")), ",").alias("cited"), "basis")


#: Segments begin with what users say; in some parts no cue has a time, and some segments are not made anew.
_SEGMENTS = "SELECT part_id, source_ordinal AS segment, CASE WHEN part_id % 6 <> 2 THEN start_t END AS start_t, source_ordinal % 3 <> 1 AS fresh FROM cues WHERE role = 'user'"


@query(sql("""SELECT f.part_id, f.source_ordinal, f.segment, coalesce(s.fresh, false) AS attached FROM (
      SELECT c.part_id, c.source_ordinal, coalesce((SELECT arg_max(segment, (s.start_t, segment)) FROM segs s WHERE s.part_id = c.part_id AND s.start_t <= c.start_t + 100), (SELECT arg_min(segment, (s.start_t, segment)) FROM segs s WHERE s.part_id = c.part_id AND s.start_t IS NOT NULL), (SELECT min(segment) FROM segs s WHERE s.part_id = c.part_id)) AS segment FROM cues c) f
    LEFT JOIN segs s ON s.part_id = f.part_id AND s.segment = f.segment""", segs=_SEGMENTS))
def C07_assign_facts_to_segments(spark, sf_dir):
    """Each fact belongs to the last segment that starts at or before it; earlier ones, and those of parts without timed cues, to the first; only segments made anew get theirs attached."""
    cues = inputs.cues(spark, sf_dir)
    segs = cues.where("role = 'user'").select("part_id", F.col("source_ordinal").alias("segment"), F.when(F.col("part_id") % 6 != 2, F.col("start_t")).alias("start_t"), (F.col("source_ordinal") % 3 != 1).alias("fresh"))
    facts = cues.select("part_id", (F.col("start_t") + 100).alias("t"), "source_ordinal")
    return sg.assign_facts(facts, segs, "part_id", "segment").select("part_id", "source_ordinal", "segment", "attached")


@query(sql("""SELECT part_id, cut AS start_pos, coalesce(lead(cut) OVER (PARTITION BY part_id ORDER BY cut), n) - 1 AS end_pos FROM (SELECT part_id, 0 AS cut, n FROM cut_parts UNION SELECT part_id, cut, n FROM cuts )""",
    placed="SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY start_t, source_ordinal) - 1 AS pos, count(*) OVER (PARTITION BY part_id) AS n FROM cues ",
    changes="SELECT DISTINCT part_id, start_t - 50 AS t FROM cues WHERE source_ordinal % 3 = 2",
    cuts="SELECT DISTINCT c.part_id, cut, c.n FROM (SELECT h.part_id, h.t, min(p.pos) AS cut, any_value(p.n) AS n FROM changes h JOIN placed p ON p.part_id = h.part_id AND p.start_t >= h.t GROUP BY h.part_id, h.t) c WHERE cut > 0 AND cut < n",
    cut_parts="SELECT DISTINCT part_id, n FROM cuts "))
def C08_page_change_boundaries(spark, sf_dir):
    """Page changes as cuts before the first cue that starts at or after them; the spans between."""
    cues = inputs.cues(spark, sf_dir)
    changes = cues.where("source_ordinal % 3 = 2").select("part_id", (F.col("start_t") - 50).alias("t"))
    return sg.cuts_at_changes(cues, changes, "part_id", ["start_t", "source_ordinal"])



_SPANS = """SELECT part_id, s * 10 AS pos, part_id AS named, s, e, n FROM (SELECT part_id, source_ordinal AS s, coalesce(lead(source_ordinal) OVER (PARTITION BY part_id ORDER BY source_ordinal), n) - 1 AS e, n, role, source_ordinal FROM (SELECT *, count(*) OVER (PARTITION BY part_id) AS n FROM cues ) WHERE role = 'user' OR source_ordinal = 0) WHERE NOT (part_id % 7 = 0 AND s > 0 AND s < 4)"""
_PROPOSED = """SELECT part_id, pos, named, s, e, n FROM spans UNION ALL SELECT part_id, pos + 1, named, s, e, n FROM spans WHERE part_id % 5 = 1 UNION ALL SELECT part_id, pos + 2, named + 1, s, e, n FROM spans WHERE part_id % 4 = 2
    UNION ALL SELECT part_id, pos + 3, named, e, s, n FROM spans WHERE part_id % 6 = 3 AND s < e UNION ALL SELECT part_id, pos + 4, named, s, e + 1000, n FROM spans WHERE part_id % 8 = 5"""
_JUDGED = """SELECT *, CASE WHEN reason IS NULL AND row_number() OVER (PARTITION BY part_id, s, e, reason IS NULL ORDER BY pos) > 1 THEN 'boundary_duplicate' ELSE reason END AS verdict FROM (
    SELECT *, CASE WHEN named <> part_id THEN 'boundary_crosses_part' WHEN s >= n OR e >= n THEN 'boundary_out_of_range' WHEN s > e THEN 'boundary_empty' END AS reason FROM proposed )"""
_TILED = """SELECT part_id, bool_and(s = coalesce(prev + 1, 0)) AND max(e) = any_value(n) - 1 AS tiled FROM (SELECT *, lag(e) OVER (PARTITION BY part_id ORDER BY s, e) AS prev FROM judged WHERE verdict IS NULL) GROUP BY part_id"""


@query(sql("""SELECT 'proposal' AS kind, part_id, pos, NULL::BIGINT AS s, NULL::BIGINT AS e, coalesce(verdict, CASE WHEN tiled THEN 'accepted' ELSE 'coverage_breaking' END) AS outcome FROM judged LEFT JOIN tiled_parts USING (part_id)
    UNION ALL SELECT 'segment', part_id, row_number() OVER (PARTITION BY part_id ORDER BY s) - 1, s, e, 'adjudicated' FROM judged JOIN tiled_parts USING (part_id) WHERE verdict IS NULL AND tiled
    UNION ALL SELECT 'segment', part_id, 0, 0, count(*) - 1, 'conservative_fallback' FROM cues WHERE part_id NOT IN (SELECT part_id FROM tiled_parts WHERE tiled) GROUP BY part_id""", spans=_SPANS, proposed=_PROPOSED, judged=_JUDGED, tiled_parts=_TILED))
def E11_segment_tiling(spark, sf_dir):
    """Proposed spans, each with its outcome, and the segments: spans that tile a part's cues, else one that owns them all."""
    part, p = Window.partitionBy("part_id"), F.col("part_id")
    cues = inputs.cues(spark, sf_dir)
    base = cues.withColumn("n", F.count("*").over(part)).where("role = 'user' or source_ordinal = 0")
    spans = base.select("part_id", (F.col("source_ordinal") * 10).alias("pos"), p.alias("named_part"), F.col("source_ordinal").alias("start_cue"), (F.coalesce(F.lead("source_ordinal").over(part.orderBy("source_ordinal")), F.col("n")) - 1).alias("end_cue")).where("not (part_id % 7 = 0 and start_cue > 0 and start_cue < 4)")
    start, end, pos = F.col("start_cue"), F.col("end_cue"), F.col("pos")
    kind = lambda where, k, named=p, first=start, last=end: F.when(F.expr(where), F.struct((pos + k).alias("pos"), named.alias("named_part"), first.alias("start_cue"), last.alias("end_cue")))
    variants = F.array(kind("true", 0), kind("part_id % 5 = 1", 1), kind("part_id % 4 = 2", 2, named=p + 1), kind("part_id % 6 = 3 and start_cue < end_cue", 3, first=end, last=start), kind("part_id % 8 = 5", 4, last=end + 1000))
    proposals = spans.select("part_id", F.inline(F.filter(variants, lambda v: v.isNotNull())))
    outcomes, segments = sg.tile(proposals, cues.select("part_id", F.col("source_ordinal").alias("cue_id"), F.col("source_ordinal").alias("place")))
    none = F.lit(None).cast("long")
    told = outcomes.select(F.lit("proposal").alias("kind"), "part_id", "pos", none.alias("s"), none.alias("e"), "outcome")
    owned = F.size("cue_ids") - 1 + F.col("start_place")
    return told.unionByName(segments.select(F.lit("segment").alias("kind"), "part_id", F.col("ordinal").alias("pos"), F.col("start_place").alias("s"), owned.cast("long").alias("e"), F.col("origin").alias("outcome")))


@query(sql("SELECT DISTINCT part_id FROM frames f WHERE region_diff >= 50 AND part_id IN (SELECT part_id FROM captions )"))
def I02_visually_affected_parts(spark, sf_dir):
    """Parts with page changes that are available."""
    return inputs.frames(spark, sf_dir).where("region_diff >= 50").select("part_id").intersect(inputs.captions(spark, sf_dir).select("part_id"))


@query(sql("SELECT DISTINCT part_id FROM (SELECT doc_id % 400 AS part_id FROM documents) WHERE part_id NOT IN (SELECT part_id FROM frames )"))
def I04_uncovered_parts(spark, sf_dir):
    """Parts without video coverage."""
    return inputs.table(spark, sf_dir, "documents").select((F.col("doc_id") % 400).alias("part_id")).subtract(inputs.frames(spark, sf_dir).select("part_id"))


_NAMED = """SELECT DISTINCT part_id, 'pages' AS list, page::BIGINT AS item FROM paged UNION ALL SELECT part_id, 'facts', doc_id FROM ocr_items UNION ALL SELECT part_id, 'changes', pts FROM frames WHERE region_diff >= 50 UNION ALL SELECT part_id, 'comments', source_ordinal FROM cues WHERE role = 'user'"""


@query(sql("SELECT part_id, " + ", ".join(f"coalesce(string_agg(item::VARCHAR, ',' ORDER BY item) FILTER (list = '{n}'), '') AS {n}" for n in ("pages", "facts", "changes", "comments")) + " FROM named GROUP BY part_id", settled_frames=_SETTLED, appear=_APPEAR, paged=_PAGED, named=_NAMED))
def I05_visual_part_inventory(spark, sf_dir):
    """Every part that any visual table names, with its pages, facts, changes and comments."""
    frames, item = _settled(spark, sf_dir), lambda c: F.col(c).cast("long").alias("item")
    found = sc.inventory("part_id", pages=sc.page_index(frames).select("part_id", item("page")).distinct(), facts=inputs.ocr_items(spark, sf_dir).select("part_id", item("doc_id")),
                         changes=frames.where("region_diff >= 50").select("part_id", item("pts")), comments=inputs.cues(spark, sf_dir).where("role = 'user'").select("part_id", item("source_ordinal")))
    return found.select("part_id", *[F.array_join(F.transform(n, lambda x: x.cast("string")), ",").alias(n) for n in ("pages", "facts", "changes", "comments")])


_CLAIMS = "SELECT part_id, source_ordinal AS claim_id, source_ordinal // 2 AS segment, CASE WHEN source_ordinal % 5 = 4 THEN ' ' ELSE text END AS text, CASE WHEN source_ordinal % 11 = 10 THEN NULL WHEN source_ordinal % 7 = 6 THEN []::BIGINT[] ELSE [source_ordinal, source_ordinal + CASE WHEN source_ordinal % 3 = 1 THEN 1 ELSE 0 END] END AS cue_ids FROM cues "


def _failure_sql(text: str, cited: str, segment: str = "segment") -> str:
    foreign = f"list_sort(list_distinct(list_filter({cited}, lambda c: c // 2 <> {segment})))"
    return f"CASE WHEN trim(coalesce({text}, '')) = '' THEN 'claim has no text' ELSE {_cited_sql(cited, segment)} END".replace("FOREIGN", foreign)


def _cited_sql(cited: str, segment: str = "segment") -> str:
    foreign = f"list_sort(list_distinct(list_filter({cited}, lambda c: c // 2 <> {segment})))"
    return f"CASE WHEN {cited} IS NULL THEN 'citation is missing or malformed' WHEN len({cited}) < 1 THEN 'cites fewer than one NormalizedCue' WHEN len({foreign}) > 0 THEN 'cites cue(s) not owned by this segment: ' || array_to_string({foreign}, ', ') END"


def _owned(cues: DataFrame) -> DataFrame:
    """Segments of two cues each, with all they own."""
    s = F.floor(F.col("source_ordinal") / 2)
    return cues.select("part_id", s.alias("segment")).distinct().withColumn("owned", F.array(F.col("segment") * 2, F.col("segment") * 2 + 1))


def _claims(cues: DataFrame) -> DataFrame:
    o = F.col("source_ordinal")
    cited = F.when(o % 11 == 10, F.lit(None)).when(o % 7 == 6, F.array().cast("array<bigint>")).otherwise(F.array(o, o + F.when(o % 3 == 1, 1).otherwise(0)))
    return cues.select("part_id", o.alias("claim_id"), F.floor(o / 2).alias("segment"), F.when(o % 5 == 4, " ").otherwise(F.col("text")).alias("text"), cited.alias("cue_ids"))


@query(sql(f"""SELECT part_id, segment, kind, idx, CASE WHEN message IS NULL THEN 'kept' ELSE 'unsupported_generated_claim' END AS outcome, message FROM (
    SELECT part_id, segment, 'title' AS kind, 0 AS idx, CASE WHEN segment % 3 = 2 THEN 'claim is missing or not an object' ELSE {_failure_sql('text', 'cue_ids')} END AS message FROM ranked WHERE place = 0
    UNION ALL SELECT part_id, segment, 'detail', place, {_failure_sql('text', 'cue_ids')} FROM ranked
    UNION ALL SELECT part_id, segment, 'entity', i, CASE WHEN i = 1 THEN 'claim is missing or not an object' ELSE {_failure_sql('text', 'cue_ids')} END FROM ranked, (VALUES (0), (1)) v(i) WHERE place = 0 AND segment % 4 = 1)""",
    claims=_CLAIMS, ranked="SELECT *, row_number() OVER (PARTITION BY part_id, segment ORDER BY claim_id) - 1 AS place FROM claims "))
def G05_validate_claims(spark, sf_dir):
    """Titles and details of segments need text and citations, all of cues that their segment owns; a missing title or item is told."""
    cues = inputs.cues(spark, sf_dir)
    claims = _claims(cues).groupBy("part_id", "segment").agg(F.transform(F.sort_array(F.collect_list(F.struct("claim_id", "text", "cue_ids"))), lambda c: F.struct(c["text"].alias("text"), c["cue_ids"].alias("cue_ids"))).alias("detailed_content"))
    first, k = F.get("detailed_content", F.lit(0)), F.col("segment")
    documents = claims.withColumns({"title": F.when(k % 3 != 2, first), "entities": F.when(k % 4 == 1, F.array(first, F.lit(None)))})
    return sg.validate_content(documents, _owned(cues))


_QA = f"""SELECT part_id, segment, o, text, CASE WHEN q IS NOT NULL THEN 'question: ' || q WHEN a IS NOT NULL THEN 'answer: ' || a END AS message FROM (SELECT part_id, o, o // 2 AS segment, text,
    {_failure_sql('text', '[o]', '(o // 2)')} AS q, {_failure_sql("CASE WHEN o % 4 = 3 THEN ' ' ELSE role END", 'CASE WHEN o % 5 = 4 THEN []::BIGINT[] ELSE [o] END', '(o // 2)')} AS a FROM items )"""
_ITEMS = "SELECT part_id, source_ordinal AS o, text, role FROM cues "
_PEOPLE = f"""SELECT part_id, o, CASE WHEN o % 6 = 5 THEN 'person names no cited reference' WHEN o % 7 = 3 THEN 'an anonymous speaker label does not establish identity' WHEN c IS NOT NULL AND o % 8 = 5 THEN 'an anonymous speaker label does not establish identity' ELSE c END AS message FROM (SELECT *, {_cited_sql('CASE WHEN o % 4 = 1 THEN [o + 1] ELSE [o] END', '(o // 2)')} AS c FROM items )"""
_CONTRA = f"""SELECT part_id, o, CASE WHEN o % 9 = 4 THEN 'the pipeline never chooses which contradictory claim is true' WHEN o % 5 = 0 THEN 'a contradiction needs at least two cited sides' ELSE coalesce('side 0 ' || a, 'side 1 ' || b) END AS message FROM (
    SELECT *, {_failure_sql('text', '[o]', '(o // 2)')} AS a, {_failure_sql('role', 'CASE WHEN o % 7 = 2 THEN []::BIGINT[] ELSE [o, o + 3] END', '(o // 2)')} AS b FROM items )"""
_OPEN_Q = f"""SELECT part_id, o, CASE WHEN c IS NOT NULL THEN c WHEN o % 4 = 2 THEN 'an unresolved question carries an answer' WHEN known THEN 'the question is answered elsewhere in the segment' END AS message FROM (
    SELECT i.part_id, i.o, {_failure_sql('i.said', '[i.o]', '(i.o // 2)')} AS c, EXISTS (SELECT 1 FROM qa WHERE qa.message IS NULL AND qa.part_id = i.part_id AND qa.segment = i.o // 2 AND qa.text = i.said) AS known FROM (SELECT *, CASE WHEN o % 3 = 0 THEN text ELSE 'why ' || text END AS said FROM items ) i)"""


@query(sql("SELECT kind, part_id, o AS item, CASE WHEN message IS NULL THEN 'kept' ELSE 'unsupported_generated_claim' END AS outcome, message FROM (SELECT 'qa' AS kind, part_id, o, message FROM qa UNION ALL SELECT 'people', * FROM people UNION ALL SELECT 'contradictions', * FROM contra UNION ALL SELECT 'unresolved', * FROM open_q )", items=_ITEMS, qa=_QA, people=_PEOPLE, contra=_CONTRA, open_q=_OPEN_Q))
def G06_validate_qa_people_contradictions(spark, sf_dir):
    """Pairs of question and answer, people, contradictions and unresolved questions, each kept or pruned with the reason."""
    cues, o = inputs.cues(spark, sf_dir), F.col("source_ordinal")
    none, own, owned = F.array().cast("array<bigint>"), F.array("source_ordinal"), _owned(cues)
    rows = cues.select("part_id", F.floor(o / 2).alias("segment"), o.alias("item"), "source_ordinal", "text", "role")
    claim = lambda text, cited: F.struct(text.alias("text"), cited.alias("cue_ids"))
    pairs = rows.withColumn("question", claim(F.col("text"), own)).withColumn("answer", claim(F.when(o % 4 == 3, " ").otherwise(F.col("role")), F.when(o % 5 == 4, none).otherwise(own)))
    qa = sg.validate_answers(pairs, owned, "item")
    people = rows.select("part_id", "segment", "item", F.when(o % 6 == 5, "").otherwise(F.col("role")).alias("reference"), F.when(o % 7 == 3, "speaker_label").alias("identity_source"), F.when(o % 8 == 5, "S1").alias("speaker_label"), F.when(o % 4 == 1, F.array(o + 1)).otherwise(own).alias("cue_ids"))
    two = F.array(claim(F.col("text"), own), claim(F.col("role"), F.when(o % 7 == 2, none).otherwise(F.array(o, o + 3))))
    contradictions = rows.select("part_id", "segment", "item", F.when(o % 9 == 4, "left").alias("resolved_to"), F.when(o % 5 == 0, F.slice(two, 1, 1)).otherwise(two).alias("sides"))
    unresolved = rows.select("part_id", "segment", "item", F.when(o % 3 == 0, F.col("text")).otherwise(F.concat(F.lit("why "), "text")).alias("text"), own.alias("cue_ids"), F.when(o % 4 == 2, "yes").alias("answer"))
    answered = qa.where("outcome = 'kept'").join(rows, ["part_id", "segment", "item"]).select("part_id", "segment", "text")
    out = None
    for kind, df in (("qa", qa), ("people", sg.validate_people(people, owned, "item")), ("contradictions", sg.validate_contradictions(contradictions, owned, "item")), ("unresolved", sg.validate_unresolved(unresolved, answered, owned, "item"))):
        one = df.select(F.lit(kind).alias("kind"), "part_id", "item", "outcome", "message")
        out = one if out is None else out.unionByName(one)
    return out


@query(sql("SELECT s.part_id, s.segment, p.claim_id AS content_of FROM (SELECT part_id, source_ordinal, row_number() OVER (PARTITION BY part_id ORDER BY source_ordinal) - 1 AS segment FROM cues WHERE role = 'user') s LEFT JOIN (SELECT part_id, source_ordinal AS claim_id, row_number() OVER (PARTITION BY part_id ORDER BY source_ordinal DESC) - 1 AS pos FROM cues ) p ON p.part_id = s.part_id AND p.pos = s.segment"))
def G07_segment_content_binding(spark, sf_dir):
    """Segment k takes the content of the raw proposal at list position k."""
    cues = inputs.cues(spark, sf_dir)
    raw = cues.select("part_id", F.col("source_ordinal").alias("content_of"), (F.row_number().over(Window.partitionBy("part_id").orderBy(F.desc("source_ordinal"))) - 1).alias("position"))
    return sg.bind_content(cues.where("role = 'user'"), raw, "part_id", "source_ordinal", "position", "content_of")



_PRIOR = "SELECT part_id // 10 AS report, part_id, CASE WHEN part_id % 8 = 5 AND source_ordinal > 2 THEN source_ordinal + 1 ELSE source_ordinal END AS ordinal, CASE WHEN part_id % 12 = 7 AND source_ordinal = 1 THEN 0 ELSE source_ordinal END AS cue FROM cues "


@query(sql("""SELECT report, part_id, holes, double_owned, unknown_cited, bool_or(holes OR double_owned > 0 OR unknown_cited > 0) OVER (PARTITION BY report) AS drifted FROM (
    SELECT report, part_id, (SELECT bool_or(ordinal <> rn) FROM (SELECT ordinal, row_number() OVER (ORDER BY ordinal) - 1 AS rn FROM prior q WHERE q.part_id = g.part_id)) AS holes, (SELECT count(*) FROM (SELECT cue FROM prior q WHERE q.part_id = g.part_id GROUP BY cue HAVING count(*) > 1)) AS double_owned,
      (part_id % 9 = 4)::BIGINT AS unknown_cited FROM (SELECT DISTINCT report, part_id FROM prior ) g)""", prior=_PRIOR))
def G08_check_prior_report(spark, sf_dir):
    """An earlier report stands when ordinals have no hole, every cue has one owner and chapters cite what is there; one breach drifts all of it."""
    p, o = F.col("part_id"), F.col("source_ordinal")
    rows = inputs.cues(spark, sf_dir).select(F.floor(p / 10).alias("report"), "part_id", F.when((p % 8 == 5) & (o > 2), o + 1).otherwise(o).alias("ordinal"), F.array(F.when((p % 12 == 7) & (o == 1), 0).otherwise(o)).alias("cue_ids"))
    chapters = rows.select("report", "part_id").distinct().select("report", "part_id", F.array(F.lit(0).cast("long"), F.when(p % 9 == 4, 100_000).otherwise(0).cast("long")).alias("ordinals"))
    return sg.check_report(rows, chapters)


@query(sql("""SELECT 'entry' AS kind, part_id // 10 AS collection, part_id * 1000 + source_ordinal AS pos, CASE WHEN source_ordinal % 6 = 5 THEN 'collection_entry_empty' WHEN part_id % 9 = 2 THEN 'collection_entry_cites_unavailable_part' WHEN source_ordinal >= 4 THEN 'collection_entry_unknown_segment' ELSE 'kept' END AS outcome FROM cues
    UNION ALL SELECT 'limitation', part_id // 10, part_id, CASE WHEN part_id % 9 = 2 THEN 'text_content_unavailable' ELSE 'conservative_single_segment_fallback' END FROM (SELECT DISTINCT part_id FROM cues ) WHERE part_id % 9 = 2 OR part_id % 13 = 6
    UNION ALL SELECT 'collection', part_id // 10, NULL, CASE WHEN bool_or(part_id % 9 = 2 OR part_id % 13 = 6) THEN 'partial' ELSE 'complete' END FROM cues GROUP BY part_id // 10"""))
def D06_collection_summary(spark, sf_dir):
    """Summary entries refused for no, unavailable or unknown references, the limitations, and whether a collection is partial."""
    o, part = F.col("source_ordinal"), F.col("part_id")
    cues = inputs.cues(spark, sf_dir).withColumn("collection", F.floor(part / 10))
    refs = F.when(o % 6 == 5, F.array().cast("array<struct<part:bigint,ordinal:bigint>>")).otherwise(F.array(F.struct(part.alias("part"), F.lit(0).cast("long").alias("ordinal")), F.struct(part.alias("part"), o.alias("ordinal"))))
    entries = cues.select("collection", (part * 1000 + o).alias("pos"), refs.alias("refs"))
    parts = cues.select("collection", "part_id").distinct().select("collection", "part_id", (part % 9 != 2).alias("available"), (part % 13 == 6).alias("used_fallback"))
    segments = parts.select("part_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("ordinal"))
    outcomes, limitations, states = sg.summarize(entries, parts, segments)
    row = lambda df, kind, pos, outcome: df.select(F.lit(kind).alias("kind"), "collection", pos.cast("long").alias("pos"), F.col(outcome).alias("outcome"))
    return row(outcomes, "entry", F.col("pos"), "outcome").unionByName(row(limitations, "limitation", F.col("part_id"), "limitation")).unionByName(row(states, "collection", F.lit(None), "state"))


@query(sql(f"""SELECT part_id // 5 AS collection, CASE WHEN coalesce(sum(users), 0) = 0 THEN 'failed' WHEN bool_or(fallback OR part_id % 7 = 0) THEN 'partial' ELSE 'complete' END AS status, sum(bad)::BIGINT AS unsupported FROM (
    SELECT c.part_id, count(*) FILTER (c.role = 'user' AND c.part_id % 40 >= 10) AS users, bool_or(c.source_ordinal % 7 = 6 AND c.part_id % 3 = 0) AS fallback, count(*) FILTER (({_failure_sql('l.text', 'l.cue_ids', 'l.segment')}) IS NOT NULL) AS bad FROM cues c JOIN claims l ON l.part_id = c.part_id AND l.claim_id = c.source_ordinal GROUP BY c.part_id) GROUP BY part_id // 5""", claims=_CLAIMS))
def D07_segment_status(spark, sf_dir):
    """Complete, partial or failed for each collection, with its unsupported claims."""
    cues, p = inputs.cues(spark, sf_dir), F.col("part_id")
    bad = sg.validate_claims(_claims(cues), _owned(cues), "claim_id").groupBy("part_id").agg(F.count_if(F.col("outcome") != "kept").alias("unsupported"))
    parts = cues.groupBy("part_id").agg(F.count_if((F.col("role") == "user") & (p % 40 >= 10)).alias("segments"), F.bool_or((F.col("source_ordinal") % 7 == 6) & (p % 3 == 0)).alias("used_fallback")).join(bad, "part_id")
    return sg.status(parts.withColumn("unavailable", p % 7 == 0).withColumn("collection", F.floor(p / 5)), "collection")


@query("SELECT doc_id // 10 AS chapter, string_agg(DISTINCT lang, ',' ORDER BY lang) AS languages FROM documents GROUP BY doc_id // 10")
def D19_language_union(spark, sf_dir):
    """The sorted distinct languages of each chapter's segments."""
    docs = inputs.table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 10).alias("chapter"), F.array("lang").alias("languages"))
    return sg.language_union(docs, "chapter").withColumn("languages", F.array_join("languages", ","))
