"""Speech evidence: usable audio, activity, risks, tiles, review windows, turns, alignment, streams, model times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partwise.operators import intervals as iv

#: Reasons of refusal.
COVERAGE_INVALID, OUTPUT_INVALID, SCOPE_INVALID = "audio_coverage_invalid", "model_output_invalid", "review_scope_invalid"
FULL_LENGTH = "full_length_review_requested"


def usable_audio(coverage: DataFrame, gaps: DataFrame, *keys: str) -> DataFrame:
    """(keys, start_t, end_t, reason): coverage (one interval a key) minus its gaps.

    Gaps that overlap each other, are empty or leave the coverage refuse the key: one row with null bounds and
    audio_coverage_invalid.
    """
    names = list(keys)
    order = Window.partitionBy(*keys).orderBy("start_t", "end_t")
    bounds = coverage.select(*keys, F.col("start_t").alias("lo"), F.col("end_t").alias("hi"))
    bad = (F.col("start_t") >= F.col("end_t")) | (F.col("start_t") < F.col("lo")) | (F.col("end_t") > F.col("hi")) | F.coalesce(F.col("start_t") < F.lag("end_t").over(order), F.lit(False))
    wrong = gaps.select(*keys, "start_t", "end_t").join(bounds, names).withColumn("bad", bad).where("bad").select(*keys).distinct()
    good = iv.carve(coverage.select(*keys, "start_t", "end_t").join(wrong, names, "left_anti"), gaps.select(*keys, "start_t", "end_t"), names)
    refused = coverage.select(*keys).join(wrong, names, "left_semi").distinct()
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(refused.withColumns({"start_t": F.lit(None).cast("long"), "end_t": F.lit(None).cast("long"), "reason": F.lit(COVERAGE_INVALID)}))


def vad_partition(usable: DataFrame, segments: DataFrame, *keys: str) -> DataFrame:
    """(keys, state, start_t, end_t, reason): usable audio as segments (with state) and indeterminate rest, equal neighbours merged.

    A key with a segment outside usable audio or over another one is refused as a whole: one row with null bounds and
    model_output_invalid. One exchange by key.
    """
    whole = Window.partitionBy(*keys)
    rows = iv.sweep([segments.select(*keys, "start_t", "end_t", "state"), usable.select(*keys, "start_t", "end_t")], list(keys), F.struct("state"))
    bad = F.bool_or((F.col("n0") > 1) | ((F.col("n0") > 0) & (F.col("n1") == 0))).over(whole)
    rows = rows.withColumn("bad", bad).where("n1 > 0 or bad").withColumn("state", F.when(F.col("n0") > 0, F.col("_p.state")).otherwise("indeterminate"))
    order = whole.orderBy("start_t")
    new = (F.col("state") != F.lag("state").over(order)) | (F.col("start_t") != F.lag("end_t").over(order))
    rows = rows.withColumn("new", F.coalesce(new, F.lit(True)).cast("int"))
    run = F.when(F.col("bad"), -1).otherwise(F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    found = rows.withColumn("run", run).groupBy(*keys, "run").agg(F.first("state").alias("state"), F.min("start_t").alias("start_t"), F.max("end_t").alias("end_t"), F.first("bad").alias("bad"))
    keep = lambda c: F.when(~F.col("bad"), F.col(c)).alias(c)
    return found.select(*keys, keep("state"), keep("start_t"), keep("end_t"), F.when(F.col("bad"), OUTPUT_INVALID).alias("reason"))


def uncovered_risk(partition: DataFrame, gaps: DataFrame, captions: DataFrame, longer_than: int, *keys: str) -> DataFrame:
    """(keys, risk, start_t, end_t, elevated): likely speech, indeterminate audio and gaps of the coverage, without captions.

    Only speech longer than longer_than ticks is elevated.
    """
    kind = F.when(F.col("state") == "speech_likely", "uncovered_speech").otherwise("audio_state_indeterminate")
    open_ = partition.where("state <> 'non_speech'").select(*keys, "start_t", "end_t", kind.alias("risk"))
    base = open_.unionByName(gaps.select(*keys, "start_t", "end_t", F.lit("audio_state_indeterminate").alias("risk")))
    found = iv.carve(base, captions, list(keys))
    return found.withColumn("elevated", (F.col("risk") == "uncovered_speech") & (F.col("end_t") - F.col("start_t") > longer_than))


def long_silences(partition: DataFrame, longer_than: int) -> DataFrame:
    """Silences of a partition that are longer than longer_than ticks."""
    return partition.where((F.col("state") == "non_speech") & (F.col("end_t") - F.col("start_t") > longer_than))


def textless_speech(speech: DataFrame, cues: DataFrame, at_least: int, *keys: str) -> DataFrame:
    """Pieces of disjoint speech intervals of at_least ticks or more that no cue covers."""
    return iv.carve(speech, cues, list(keys)).where(F.col("end_t") - F.col("start_t") >= at_least)


def text_over_silence(cues: DataFrame, silence: DataFrame, at_least: int, keys: list[str], width: int) -> DataFrame:
    """Every overlap of a cue and a silence of at_least ticks or more."""
    return iv.intersect(cues, silence, keys, width).where(F.col("end_t") - F.col("start_t") >= at_least)


def review_windows(suspicious: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """(key, start_t, end_t, scope, reason) from suspicious intervals and parts (key, start_t, end_t, decision).

    Without a decision a part's intervals are merged; full_length_review_requested takes the part as a whole; any other
    decision refuses the part (review_scope_invalid).
    """
    few = suspicious.join(parts.where("decision is null").select(key), key, "left_semi")
    merged = iv.union(few, key).select(key, "start_t", "end_t", F.lit("suspicious_intervals").alias("scope"), F.lit(None).cast("string").alias("reason"))
    asked = F.col("decision") == FULL_LENGTH
    when = lambda c: F.when(asked, c)
    rest = parts.where("decision is not null").select(key, when(F.col("start_t")).alias("start_t"), when(F.col("end_t")).alias("end_t"), when(F.lit("full_length")).alias("scope"), F.when(~asked, SCOPE_INVALID).alias("reason"))
    return merged.unionByName(rest)


def speech_runs(windows: DataFrame, key: str, threshold: float, min_silence: int, min_speech: int, pad: int) -> DataFrame:
    """Windows (key, start_t, end_t, value) at or above threshold as runs: merged over short silence, short ones dropped, padded, clamped, merged again."""
    total = windows.groupBy(key).agg(F.min("start_t").alias("lo"), F.max("end_t").alias("hi"))
    merged = iv.union(windows.where(F.col("value") >= threshold), key, gap=min_silence).where(F.col("end_t") - F.col("start_t") >= min_speech).join(total, key)
    padded = merged.select(key, F.greatest(F.col("start_t") - pad, F.col("lo")).alias("start_t"), F.least(F.col("end_t") + pad, F.col("hi")).alias("end_t"))
    return iv.union(padded, key)


def speech_tiles(runs: DataFrame, whole: DataFrame, key: str) -> DataFrame:
    """Runs as speech and the rest of whole (key, start_t, end_t, calibrated) as silence; where the detector is not calibrated, one indeterminate row."""
    known, not_known = whole.where("calibrated"), whole.where("not calibrated")
    tiles = iv.sweep([known.select(key, "start_t", "end_t"), runs.select(key, "start_t", "end_t")], [key]).where("n0 > 0")
    state = F.when(F.col("n1") > 0, "speech_likely").otherwise("non_speech")
    return tiles.select(key, "start_t", "end_t", state.alias("state")).unionByName(not_known.select(key, "start_t", "end_t", F.lit("indeterminate").alias("state")))


def turn_gate(turns: DataFrame, activity: DataFrame, usable: DataFrame, key: str, turn: str, width: int, min_confidence: float) -> DataFrame:
    """(key, turn, conflicts, states, outcome) of speaker turns (key, turn, start_t, end_t, confidence).

    A turn over anything but likely speech is a conflict with the sorted states; another one is published if confident
    enough, else dropped. One turn outside every usable interval refuses all turns of its key (model_output_invalid).
    """
    none = F.lit(None).cast("string")
    other = iv.overlap_join(turns.select(key, turn, "start_t", "end_t"), activity.where("state <> 'speech_likely'").select(key, "start_t", "end_t", "state"), [key], width).select(key, turn, "state", F.lit(False).alias("inside"))
    within = iv.overlap_join(turns.select(key, turn, "start_t", "end_t"), usable.select(key, "start_t", "end_t"), [key], width).where("r_start <= start_t and end_t <= r_end").select(key, turn, none.alias("state"), F.lit(True).alias("inside"))
    every = turns.select(key, turn, none.alias("state"), F.lit(False).alias("inside"), "confidence")
    rows = every.unionByName(other.unionByName(within), allowMissingColumns=True).groupBy(key, turn).agg(
        F.count("state").alias("conflicts"), F.array_join(F.array_sort(F.collect_set("state")), ",").alias("states"), F.bool_or("inside").alias("inside"), F.max("confidence").alias("confidence"))
    outside = F.bool_or(~F.col("inside")).over(Window.partitionBy(key))
    outcome = F.when(outside, OUTPUT_INVALID).when(F.col("conflicts") > 0, "conflict").when(F.col("confidence") >= min_confidence, "published").otherwise("dropped")
    return rows.select(key, turn, "conflicts", "states", outcome.alias("outcome"))


def align(cues: DataFrame, proposals: DataFrame, usable: DataFrame, activity: DataFrame, bounds: DataFrame, key: str, width: int, min_confidence: float) -> DataFrame:
    """(key, source_ordinal, outcome, new_start, new_end, risk) of cues (key, source_ordinal, text, language, start_t, end_t).

    Proposals (key, source_ordinal, text, start_t, end_t, confidence) must name each cue once with its very text, else
    the whole key is alignment_text_contract_violation. Then, in this order: alignment_low_confidence,
    alignment_duration_implausible (bounds: language, shortest, longest), alignment_out_of_coverage (not within one
    usable interval), alignment_vad_conflict (over non_speech), else adopted, with risk where it lies over
    indeterminate audio. Starts that would decrease in order of ordinals revert the key (alignment_untrusted).
    """
    part = Window.partitionBy(key)
    p = proposals.select(key, "source_ordinal", F.col("text").alias("p_text"), F.col("start_t").alias("p_start"), F.col("end_t").alias("p_end"), "confidence").withColumn("times", F.count("*").over(Window.partitionBy(key, "source_ordinal")))
    rows = cues.select(key, "source_ordinal", "text", "language", "start_t", "end_t").join(p, [key, "source_ordinal"], "full").join(bounds, "language", "left")
    broken = F.bool_or(F.col("text").isNull() | F.col("p_text").isNull() | (F.col("text") != F.col("p_text")) | (F.col("times") > 1)).over(part)
    spans = p.select(key, "source_ordinal", F.col("p_start").alias("start_t"), F.col("p_end").alias("end_t"))
    inside = iv.overlap_join(spans, usable.select(key, "start_t", "end_t"), [key], width).where("r_start <= start_t and end_t <= r_end").select(key, "source_ordinal", F.lit("inside").alias("fact"))
    over = iv.overlap_join(spans, activity.where("state <> 'speech_likely'").select(key, "start_t", "end_t", "state"), [key], width).select(key, "source_ordinal", F.col("state").alias("fact"))
    facts = inside.unionByName(over).groupBy(key, "source_ordinal").agg(F.collect_set("fact").alias("facts"))
    has = lambda fact: F.coalesce(F.array_contains("facts", fact), F.lit(False))
    length = F.col("p_end") - F.col("p_start")
    reason = (F.when((F.col("confidence") < min_confidence) | (F.col("confidence") > 1), "alignment_low_confidence").when((length < F.col("shortest")) | (length > F.col("longest")), "alignment_duration_implausible")
              .when(~has("inside"), "alignment_out_of_coverage").when(has("non_speech"), "alignment_vad_conflict"))
    rows = rows.withColumn("broken", broken).join(facts, [key, "source_ordinal"], "left").withColumn("reason", reason).withColumn("risk", F.col("reason").isNull() & has("indeterminate"))
    rows = rows.withColumn("new", F.when(F.col("reason").isNull(), F.col("p_start")).otherwise(F.col("start_t")))
    back = F.coalesce(F.col("new") < F.lag("new").over(part.orderBy("source_ordinal")), F.lit(False))
    rows = rows.withColumn("back", back).withColumn("untrusted", F.bool_or("back").over(part))
    outcome = F.when(F.col("broken"), "alignment_text_contract_violation").when(F.col("untrusted"), "alignment_untrusted").otherwise(F.coalesce("reason", F.lit("adopted")))
    rows = rows.where("text is not null").withColumn("outcome", outcome)
    taken = F.col("outcome") == "adopted"
    pick = lambda a, b: F.when(taken, F.col(a)).otherwise(F.col(b))
    return rows.select(key, "source_ordinal", "outcome", pick("p_start", "start_t").alias("new_start"), pick("p_end", "end_t").alias("new_end"), (taken & F.col("risk")).alias("risk"))


def snapped(seconds_num: Column, seconds_den: int, rate: int, most: Column) -> Column:
    """A model's time as a sample index: half to even, clamped to 0 and most."""
    return F.least(F.greatest(F.bround(seconds_num.cast("decimal(30,6)") * rate / seconds_den, 0).cast("long"), F.lit(0).cast("long")), most)


def snap_spans(spans: DataFrame, per_second: int, rate: int) -> DataFrame:
    """Spans (..., start_t, end_t, last_sample) of a model as samples [first, last); empty ones are dropped."""
    rows = spans.withColumn("first", snapped(F.col("start_t"), per_second, rate, F.col("last_sample"))).withColumn("last", snapped(F.col("end_t"), per_second, rate, F.col("last_sample")))
    return rows.where("first < last")


def snap_alignment(cues: DataFrame, per_second: int, rate: int) -> DataFrame:
    """Cues (..., items array<struct<start_t,end_t>>, last_sample): from the first start to the last end of the items that have both; none, or an empty one, drops the cue."""
    timed = F.filter("items", lambda x: x["start_t"].isNotNull() & x["end_t"].isNotNull())
    rows = cues.withColumn("start_t", F.array_min(F.transform(timed, lambda x: x["start_t"]))).withColumn("end_t", F.array_max(F.transform(timed, lambda x: x["end_t"])))
    return snap_spans(rows.where("start_t is not null"), per_second, rate)


def select_audio_stream(parts: DataFrame, streams: DataFrame, requests: DataFrame, key: str) -> DataFrame:
    """(key, stream_index, state) of every part: its one determinate audio stream, or the requested one, or why there is none.

    parts has key, streams (key, stream_index, codec_type, state), requests (key, wanted). Reasons:
    audio_stream_unavailable, awaiting_audio_stream_selection, audio_stream_selection_invalid.
    """
    found = streams.where("codec_type = 'audio' and state = 'complete'").groupBy(key).agg(F.collect_set("stream_index").alias("open"))
    rows = parts.select(key).distinct().join(found, key, "left").join(requests, key, "left").withColumn("open", F.coalesce("open", F.array().cast("array<bigint>")))
    n, wanted = F.size("open"), F.col("wanted")
    state = (F.when(wanted.isNull() & (n == 0), "audio_stream_unavailable").when(wanted.isNull() & (n > 1), "awaiting_audio_stream_selection")
             .when(wanted.isNotNull() & ~F.array_contains("open", F.coalesce(wanted, F.lit(-1))), "audio_stream_selection_invalid").otherwise("selected"))
    return rows.withColumn("state", state).select(key, F.when(F.col("state") == "selected", F.coalesce("wanted", F.col("open")[0])).alias("stream_index"), "state")


def role_citations(turns: DataFrame, proposals: DataFrame, cues: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    """(key, cluster, role, evidence, outcome) of role proposals (key, cluster, role, source_ordinal, text) and user metadata (key, cluster, role).

    A proposal of an unknown cluster is dropped. One whose text is not that of the cue it cites refuses all of its key
    (model_output_invalid). Metadata of an unknown cluster refuse the key too (role_metadata_invalid); else they join in.
    """
    known = turns.select(key, "cluster").distinct().withColumn("known", F.lit(True))
    cited = cues.select(key, "source_ordinal", F.col("text").alias("retained"))
    p = proposals.join(known, [key, "cluster"], "left").join(cited, [key, "source_ordinal"], "left")
    wrong = F.coalesce(F.col("known"), F.lit(False)) & ~F.coalesce(F.col("retained") == F.col("text"), F.lit(False))
    p = p.select(key, "cluster", "role", F.lit("subtitle_text").alias("evidence"), F.coalesce("known", F.lit(False)).alias("known"), F.when(wrong, OUTPUT_INVALID).alias("fault"))
    m = metadata.join(known, [key, "cluster"], "left").select(key, "cluster", "role", F.lit("user_metadata").alias("evidence"), F.coalesce("known", F.lit(False)).alias("known"), F.when(F.col("known").isNull(), "role_metadata_invalid").alias("fault"))
    rows = p.unionByName(m).withColumn("refused", F.min("fault").over(Window.partitionBy(key)))
    outcome = F.coalesce(F.col("refused"), F.when(~F.col("known"), "cluster_unknown").otherwise("kept"))
    return rows.select(key, "cluster", "role", "evidence", outcome.alias("outcome"))


#: What a review is, by the models of the primary text and of the review.
INDEPENDENT, RECOVERY, UNCLASSIFIED = "independent_review", "recovery", "review_classification_invalid"


def review_kind(primary_model: Column, review_model: Column) -> Column:
    """An independent review only if another model made it; the same model's is a recovery; without both names, none can be told."""
    known = (F.length(primary_model) > 0) & (F.length(review_model) > 0)
    return F.when(~F.coalesce(known, F.lit(False)), UNCLASSIFIED).when(primary_model == review_model, RECOVERY).otherwise(INDEPENDENT)


def classified_reviews(primary: DataFrame, review: DataFrame, interval: str) -> DataFrame:
    """review (interval, review_text, review_model) with kind, and independent as arbitrate takes it, by primary's (interval, primary_model)."""
    models = primary.select(interval, "primary_model")
    return review.join(models, interval, "left").withColumn("kind", review_kind(F.col("primary_model"), F.col("review_model"))).withColumn("independent", F.col("kind") == INDEPENDENT).drop("primary_model")


def arbitrate(primary: DataFrame, review: DataFrame, interval: str, rules: tuple[str, ...] = ("fills_gap", "drops_silence")) -> DataFrame:
    """(interval, decision, rule, text) of suspicious intervals (interval, reason, primary_text) and their reviews (interval, review_text, independent).

    A missing or dependent review is review-needed; equal texts are agreement; else the first enabled rule that fires
    adopts the review: fills_gap (only the primary text is blank) or drops_silence (text over silence that the review
    leaves blank); else review-needed. text is the primary one unless the review is adopted.
    """
    p, r = F.trim("primary_text"), F.trim("review_text")
    fires = {"fills_gap": (p == "") & (r != ""), "drops_silence": (F.col("reason") == "text_over_silence") & (p != "") & (r == "")}
    independent, same = F.coalesce("independent", F.lit(False)), F.col("primary_text") == F.col("review_text")
    rule = F.when(~independent | same, F.lit(None).cast("string"))
    for name in rules:
        rule = rule.when(fires[name], name)
    rows = primary.join(review, interval, "left").withColumn("rule", rule)
    decision = F.when(~independent, "review-needed").when(same, "agreement").when(F.col("rule").isNotNull(), "review_adopted").otherwise("review-needed")
    return rows.select(interval, decision.alias("decision"), "rule", F.when(F.col("rule").isNotNull(), F.col("review_text")).otherwise(F.col("primary_text")).alias("text"))


def assembled(chunks: DataFrame, key: str, order: str) -> DataFrame:
    """Chunks (key, order, text, ...) with visible text, and their ordinal among these, from 0 without holes."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    return chunks.where(F.trim("text") != "").withColumn("ordinal", place.cast("long"))


def speaker_labels(turns: DataFrame, key: str, cluster: str) -> DataFrame:
    """turns with label: their part's number and the rank of their cluster within it, never a name."""
    rank = F.dense_rank().over(Window.partitionBy(key).orderBy(cluster))
    return turns.withColumn("label", F.format_string("part-%02d:speaker-%02d", key, rank))


def leading(rows: DataFrame, key: str, order: list[str], most: int) -> DataFrame:
    """The first `most` rows of each key in order; no task sorts more than it keeps of what it reads."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_n") <= most).drop("_n")


def first_stream_coverage(streams: DataFrame, key: str, stream: str) -> DataFrame:
    """(key, start_t, end_t): the coverage (start_t, end_t, state) of each key's first stream, where it is complete."""
    first = F.min_by(F.struct("start_t", "end_t", "state"), stream).alias("c")
    return streams.groupBy(key).agg(first).where("c.state = 'complete'").select(key, "c.start_t", "c.end_t")
