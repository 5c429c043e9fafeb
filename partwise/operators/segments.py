"""Segments of a part's cues: tiling, content checks, earlier reports, collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNSUPPORTED = "unsupported_generated_claim"
#: Sources of an identity that name nobody.
ANONYMOUS = ("speaker_label", "diarization")
#: What is said of content that is not kept; results carry these sentences.
SAYS = {
    "missing": "claim is missing or not an object",
    "no_text": "claim has no text",
    "malformed": "citation is missing or malformed",
    "too_few": "cites fewer than one NormalizedCue",
    "foreign": "cites cue(s) not owned by this segment: ",
    "nameless": "person names no cited reference",
    "anonymous": "an anonymous speaker label does not establish identity",
    "chosen": "the pipeline never chooses which contradictory claim is true",
    "one_side": "a contradiction needs at least two cited sides",
    "answered": "an unresolved question carries an answer",
    "elsewhere": "the question is answered elsewhere in the segment",
}


def tile(proposals: DataFrame, cues: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(outcomes, segments) of proposals (part_id, pos, named_part, start_cue, end_cue), pos once a part, for cues (part_id, cue_id, place from 0).

    outcomes: each proposal with boundary_crosses_part, boundary_out_of_range, boundary_empty, boundary_duplicate (the
    first of equal spans wins), coverage_breaking or accepted. A part's accepted spans must tile its cues exactly, else
    each is coverage_breaking and one segment owns all. segments: part_id, ordinal, start_place, end_place, origin
    (adjudicated, conservative_fallback), cue_ids.
    """
    part = Window.partitionBy("part_id")
    end = lambda side, cue: F.struct(F.lit(side).alias("side"), F.col(cue).alias("cue_id"))
    ends = proposals.select("part_id", "pos", "named_part", F.inline(F.array(end(0, "start_cue"), end(1, "end_cue"))))
    places = cues.select("part_id", "cue_id", F.col("place").cast("long").alias("place"), F.count(F.lit(1)).over(part).alias("n"))
    at = lambda side: F.max(F.when(F.col("side") == side, F.col("place")))
    rows = ends.join(places, ["part_id", "cue_id"], "left").repartition("part_id").groupBy("part_id", "pos").agg(F.max("named_part").alias("named_part"), at(0).alias("s"), at(1).alias("e"), F.max("n").alias("n"))
    reason = F.when(F.col("named_part") != F.col("part_id"), "boundary_crosses_part").when(F.col("s").isNull() | F.col("e").isNull(), "boundary_out_of_range").when(F.col("s") > F.col("e"), "boundary_empty")
    rows = rows.withColumn("reason", reason)
    again = F.row_number().over(Window.partitionBy("part_id", "s", "e", F.col("reason").isNull()).orderBy("pos")) > 1
    rows = rows.withColumn("reason", F.when(F.col("reason").isNull() & again, "boundary_duplicate").otherwise(F.col("reason"))).withColumn("good", F.col("reason").isNull())
    fits = F.col("s") == F.coalesce(F.lag("e").over(Window.partitionBy("part_id", "good").orderBy("s", "e")) + 1, F.lit(0))
    rows = rows.withColumn("fits", F.when(F.col("good"), fits))
    tiled = F.coalesce(F.bool_and("fits").over(part) & (F.max(F.when(F.col("good"), F.col("e"))).over(part) == F.max("n").over(part) - 1), F.lit(False))
    rows = rows.withColumn("tiled", tiled)
    outcomes = rows.select("part_id", "pos", F.coalesce("reason", F.when(F.col("tiled"), "accepted").otherwise("coverage_breaking")).alias("outcome"))
    number = (F.row_number().over(part.orderBy("s")) - 1).cast("long")
    marks = rows.where("good and tiled").select("part_id", F.col("s").alias("place"), number.alias("mark"), F.lit(None).cast(cues.schema["cue_id"].dataType).alias("cue_id"))
    own = cues.select("part_id", F.col("place").cast("long").alias("place"), F.lit(None).cast("long").alias("mark"), "cue_id")
    held = own.unionByName(marks).withColumn("mark", F.last("mark", True).over(part.orderBy("place", F.col("mark").asc_nulls_last()))).where("cue_id is not null")
    ids = F.transform(F.sort_array(F.collect_list(F.struct("place", "cue_id"))), lambda c: c["cue_id"])
    segments = held.groupBy("part_id", F.col("mark")).agg(F.min("place").alias("start_place"), F.max("place").alias("end_place"), ids.alias("cue_ids"))
    return outcomes, segments.select("part_id", F.coalesce("mark", F.lit(0).cast("long")).alias("ordinal"), "start_place", "end_place", F.when(F.col("mark").isNull(), "conservative_fallback").otherwise("adjudicated").alias("origin"), "cue_ids")


def citation_failure(cue_ids: Column, owned: Column) -> Column:
    """What is wrong with a citation list, or null."""
    foreign = F.array_sort(F.array_except(cue_ids, owned))
    return (F.when(cue_ids.isNull() | F.exists(cue_ids, lambda c: c.isNull()), SAYS["malformed"]).when(F.size(cue_ids) < 1, SAYS["too_few"])
            .when(F.size(foreign) > 0, F.concat(F.lit(SAYS["foreign"]), F.array_join(F.transform(foreign, lambda c: c.cast("string")), ", "))))


def claim_failure(text: Column, cue_ids: Column, owned: Column) -> Column:
    """What is wrong with a text and its citations, or null."""
    return F.when(F.coalesce(F.trim(text), F.lit("")) == "", SAYS["no_text"]).otherwise(citation_failure(cue_ids, owned))


def _told(rows: DataFrame, failure: Column, *names: str) -> DataFrame:
    return rows.withColumn("message", failure).select(*names, F.when(F.col("message").isNotNull(), UNSUPPORTED).otherwise("kept").alias("outcome"), "message")


def validate_claims(claims: DataFrame, segments: DataFrame, item: str) -> DataFrame:
    """(part_id, segment, item, outcome, message) of claims (part_id, segment, item, text, cue_ids); segments: part_id, segment, owned."""
    rows = claims.join(segments, ["part_id", "segment"], "left").withColumn("owned", F.coalesce("owned", F.array().cast(dict(claims.dtypes)["cue_ids"])))
    return _told(rows, claim_failure(F.col("text"), F.col("cue_ids"), F.col("owned")), "part_id", "segment", item)


#: The lists of a segment's details and what each one's items are called.
DETAILS = {"detailed_content": "detail", "numeric_values": "numeric_value", "entities": "entity", "examples": "example", "conditions": "condition", "caveats": "caveat"}


def validate_content(documents: DataFrame, segments: DataFrame) -> DataFrame:
    """(part_id, segment, kind, idx, outcome, message) of the title and the details of segments.

    documents: part_id, segment, title struct(text, cue_ids) and, as far as there, the lists of DETAILS, array of the
    same struct. A title is asked for, so a missing one is told; an item that is null is missing; lists may be null.
    """
    claim = F.col("title")
    one = lambda kind, i, c: F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("idx"), c.alias("claim"))
    parts = [F.array(one("title", F.lit(0), claim))]
    listed = lambda name, kind: F.transform(name, lambda c, i: one(kind, i, c))
    for name, kind in DETAILS.items():
        if name in documents.columns:
            items = listed(name, kind)
            parts.append(F.when(F.col(name).isNotNull(), items).otherwise(F.array().cast(documents.select(items.alias("x")).schema["x"].dataType)))
    claims = documents.select("part_id", "segment", F.inline(F.concat(*parts)))
    rows = claims.join(segments, ["part_id", "segment"], "left")
    failure = F.when(F.col("claim").isNull(), SAYS["missing"]).otherwise(claim_failure(F.col("claim.text"), F.col("claim.cue_ids"), F.coalesce("owned", F.array().cast(dict(segments.dtypes)["owned"]))))
    return _told(rows, failure, "part_id", "segment", "kind", "idx")


def validate_answers(pairs: DataFrame, segments: DataFrame, item: str) -> DataFrame:
    """Questions and answers (question, answer: struct(text, cue_ids)): both sides must be cited claims."""
    rows = pairs.join(segments, ["part_id", "segment"], "left")
    one = lambda side: F.when(F.col(side).isNull(), SAYS["missing"]).otherwise(claim_failure(F.col(f"{side}.text"), F.col(f"{side}.cue_ids"), F.col("owned")))
    q, a = one("question"), one("answer")
    return _told(rows, F.when(q.isNotNull(), F.concat(F.lit("question: "), q)).when(a.isNotNull(), F.concat(F.lit("answer: "), a)), "part_id", "segment", item)


def validate_people(people: DataFrame, segments: DataFrame, item: str) -> DataFrame:
    """People (reference, identity_source, speaker_label, cue_ids): named by reference, not by an anonymous source, and cited."""
    rows = people.join(segments, ["part_id", "segment"], "left")
    cited = citation_failure(F.col("cue_ids"), F.col("owned"))
    failure = (F.when(F.coalesce(F.trim("reference"), F.lit("")) == "", SAYS["nameless"]).when(F.col("identity_source").isin(*ANONYMOUS), SAYS["anonymous"])
               .when(cited.isNotNull() & F.col("speaker_label").isNotNull(), SAYS["anonymous"]).otherwise(cited))
    return _told(rows, failure, "part_id", "segment", item)


def validate_contradictions(rows: DataFrame, segments: DataFrame, item: str) -> DataFrame:
    """Contradictions (resolved_to, sides array<struct(text, cue_ids)>): unresolved, with two cited sides at least."""
    rows = rows.join(segments, ["part_id", "segment"], "left")
    sides = F.transform("sides", lambda s, i: F.concat(F.lit("side "), i.cast("string"), F.lit(" "), claim_failure(s["text"], s["cue_ids"], F.col("owned"))))
    failure = (F.when(F.col("resolved_to").isNotNull(), SAYS["chosen"]).when(F.coalesce(F.size("sides"), F.lit(0)) < 2, SAYS["one_side"])
               .otherwise(F.get(F.filter(sides, lambda s: s.isNotNull()), F.lit(0))))
    return _told(rows, failure, "part_id", "segment", item)


def validate_unresolved(rows: DataFrame, answered: DataFrame, segments: DataFrame, item: str) -> DataFrame:
    """Unresolved questions (text, cue_ids, answer): cited, without an answer, and not asked in a verified pair of the segment (answered: part_id, segment, text)."""
    known = answered.select("part_id", "segment", "text").distinct().withColumn("known", F.lit(True))
    rows = rows.join(segments, ["part_id", "segment"], "left").join(known, ["part_id", "segment", "text"], "left")
    claim = claim_failure(F.col("text"), F.col("cue_ids"), F.col("owned"))
    failure = F.when(claim.isNotNull(), claim).when(F.col("answer").isNotNull(), SAYS["answered"]).when(F.col("known"), SAYS["elsewhere"])
    return _told(rows, failure, "part_id", "segment", item)


def check_report(segments: DataFrame, chapters: DataFrame) -> DataFrame:
    """(report, part_id, holes, double_owned, unknown_cited, drifted): whether an earlier report still stands.

    segments: report, part_id, ordinal, cue_ids; chapters: report, part_id, ordinals. A part's ordinals must be 0..n-1,
    each cue have one owner, and chapters cite known ordinals; one breach anywhere makes the whole report drifted.
    """
    keys = ["report", "part_id"]
    hole = F.col("ordinal") != F.row_number().over(Window.partitionBy(*keys).orderBy("ordinal")) - 1
    ordinals = segments.withColumn("hole", hole).groupBy(*keys).agg(F.bool_or("hole").alias("holes"))
    owners = segments.select(*keys, F.explode("cue_ids").alias("cue")).groupBy(*keys, "cue").agg(F.count("*").alias("n")).groupBy(*keys).agg(F.count_if(F.col("n") > 1).alias("double_owned"))
    cited = chapters.select(*keys, F.explode("ordinals").alias("ordinal")).join(segments.select(*keys, "ordinal").distinct(), [*keys, "ordinal"], "left_anti").groupBy(*keys).agg(F.count("*").alias("unknown_cited"))
    rows = ordinals.join(owners, keys, "left").join(cited, keys, "full")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    rows = rows.select(*keys, F.coalesce("holes", F.lit(False)).alias("holes"), zero("double_owned").alias("double_owned"), zero("unknown_cited").alias("unknown_cited"))
    breach = F.col("holes") | (F.col("double_owned") > 0) | (F.col("unknown_cited") > 0)
    return rows.withColumn("drifted", F.bool_or(breach).over(Window.partitionBy("report")))


def summarize(entries: DataFrame, parts: DataFrame, segments: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(outcomes, limitations, collections) of entries (collection, pos, refs array<struct(part, ordinal)>).

    parts: collection, part_id, available, used_fallback; segments: part_id, ordinal. The first failing reference
    decides: collection_entry_empty, collection_entry_cites_unavailable_part or collection_entry_unknown_segment.
    limitations: unavailable parts (text_content_unavailable, omitted) and fallback parts
    (conservative_single_segment_fallback); a collection with one is partial.
    """
    refs = entries.select("collection", "pos", F.posexplode_outer("refs").alias("i", "r"))
    known = parts.select("collection", F.col("part_id").alias("ref_part"), "available")
    there = segments.select(F.col("part_id").alias("ref_part"), F.col("ordinal").alias("ref_ordinal")).distinct().withColumn("there", F.lit(True))
    rows = refs.withColumn("ref_part", F.col("r.part")).withColumn("ref_ordinal", F.col("r.ordinal")).join(known, ["collection", "ref_part"], "left").join(there, ["ref_part", "ref_ordinal"], "left")
    reason = F.when(F.col("r").isNull(), "collection_entry_empty").when(F.col("available") == F.lit(False), "collection_entry_cites_unavailable_part").when(F.col("available").isNull() | F.col("there").isNull(), "collection_entry_unknown_segment")
    rows = rows.withColumn("reason", reason)
    outcomes = rows.groupBy("collection", "pos").agg(F.coalesce(F.min_by("reason", F.when(F.col("reason").isNotNull(), F.coalesce("i", F.lit(0)))), F.lit("kept")).alias("outcome"))
    limit = F.when(~F.col("available"), "text_content_unavailable").when(F.col("used_fallback"), "conservative_single_segment_fallback")
    limitations = parts.withColumn("limitation", limit).where("limitation is not null").select("collection", "part_id", "limitation", (~F.col("available")).alias("omitted"))
    states = parts.groupBy("collection").agg(F.when(F.bool_or(~F.col("available") | F.col("used_fallback")), "partial").otherwise("complete").alias("state"))
    return outcomes, limitations, states


def status(parts: DataFrame, key: str) -> DataFrame:
    """(key, status, unsupported) from parts (key, segments, used_fallback, unavailable, unsupported): failed without any segment, partial with a fallback or an unavailable part, else complete."""
    g = parts.groupBy(key).agg(F.sum("segments").alias("s"), F.bool_or(F.col("used_fallback") | F.col("unavailable")).alias("less"), F.sum("unsupported").alias("unsupported"))
    return g.select(key, F.when(F.coalesce("s", F.lit(0)) == 0, "failed").when(F.col("less"), "partial").otherwise("complete").alias("status"), "unsupported")


def assign_facts(facts: DataFrame, segments: DataFrame, key: str, segment: str) -> DataFrame:
    """facts (key, t, ...) with the one segment that owns each, and attached.

    segments: key, segment, start_t (the first start of its timed cues, null without any), fresh. A fact belongs to the
    last segment that starts at or before it, an earlier one to the segment that starts first, and where no segment of a
    key has a time to the first by number. attached: whether the owner is fresh, made anew. Without segments, null and
    false. Facts and segments meet in one sort of their key.
    """
    own = F.struct(F.col(segment).alias("segment"), "fresh")
    none = F.lit(None)
    marks = segments.select(key, F.col("start_t").alias("_t"), F.lit(0).alias("_kind"), own.alias("_segment"), "start_t")
    kind = marks.schema["_segment"].dataType
    rows = facts.select(key, F.col("t").alias("_t"), F.lit(1).alias("_kind"), none.cast(kind).alias("_segment"), none.cast("long").alias("start_t"), F.struct(*facts.columns).alias("_row"))
    both = marks.withColumn("_row", none.cast(rows.schema["_row"].dataType)).unionByName(rows)
    order = Window.partitionBy(key).orderBy(F.col("_t").asc_nulls_first(), "_kind", F.col("_segment.segment"))
    every = Window.partitionBy(key)
    timed = F.col("start_t").isNotNull()
    last = F.last(F.when(timed, F.col("_segment")), True).over(order)
    first = F.coalesce(F.min_by(F.when(timed, F.col("_segment")), F.when(timed, F.struct("start_t", "_segment.segment"))).over(every), F.min("_segment").over(every))
    owned = both.withColumn("_own", F.coalesce(last, first)).where("_kind = 1")
    return owned.select("_row.*", F.col("_own.segment").alias(segment), F.coalesce("_own.fresh", F.lit(False)).alias("attached"))


def cuts_at_changes(cues: DataFrame, changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """(key, start_pos, end_pos): spans of cue places that page changes (key, t) cut, each before the first cue that starts at or after it.

    cues: key, start_t and the columns of their order. A change before the first cue or after the last start cuts
    nothing; a key without cuts has no rows.
    """
    part = Window.partitionBy(key)
    none = F.lit(None)
    placed = cues.withColumn("pos", F.row_number().over(part.orderBy(*order)) - 1).withColumn("n", F.count(F.lit(1)).over(part)).select(key, F.col("start_t").alias("t"), F.lit(1).alias("kind"), "pos", "n")
    marks = changes.select(key, "t", F.lit(0).alias("kind"), none.cast("int").alias("pos"), none.cast("long").alias("n")).distinct()
    after = part.orderBy("t", "kind", "pos").rowsBetween(0, Window.unboundedFollowing)
    cuts = placed.unionByName(marks).withColumn("cut", F.first("pos", True).over(after)).withColumn("total", F.max("n").over(part)).where("kind = 0 and cut > 0 and cut < total").select(key, "cut", "total").distinct()
    spans = cuts.unionByName(cuts.select(key, F.lit(0).alias("cut"), "total").distinct())
    return spans.select(key, F.col("cut").cast("long").alias("start_pos"), (F.coalesce(F.lead("cut").over(part.orderBy("cut")), F.col("total")) - 1).cast("long").alias("end_pos"))


def language_union(segments: DataFrame, chapter: str) -> DataFrame:
    """(chapter, languages): the sorted distinct languages (array) of each chapter's segments."""
    return segments.groupBy(chapter).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("languages")))).alias("languages"))


def bind_content(segments: DataFrame, proposals: DataFrame, key: str, order: str, position: str, content: str) -> DataFrame:
    """(key, segment, content): segment k of a key, counted in order, takes the content of the proposal at list position k, or none."""
    numbered = segments.select(key, (F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1).cast("long").alias("segment"))
    return numbered.join(proposals.select(key, F.col(position).cast("long").alias("segment"), content), [key, "segment"], "left")
