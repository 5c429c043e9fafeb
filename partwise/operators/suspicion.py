"""Detectors of suspicious speech text: six rules, one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partwise.functions.columns import words
from partwise.operators import intervals as iv
from partwise.operators import speech as sp

#: Default rules and, in this order, the detectors.
RULES = {
    "vad_coverage": {"minimum_silence_overlap_seconds": 1},
    "coverage_checks": {"minimum_textless_speech_seconds": 1},
    "confidence": {"minimum_token_confidence": 0.5},
    "repetition": {"maximum_consecutive_repetitions": 3},
    "language_switching": {"maximum_language_switches": 2},
    "numbers_entities": {"minimum_digit_run": 2},
}
DETECTORS = list(RULES)


def low_tokens(tokens: Column, floor: float) -> Column:
    """The texts of tokens below a confidence; one without a confidence never counts."""
    return F.transform(F.filter(tokens, lambda t: t["confidence"].isNotNull() & (t["confidence"] < floor)), lambda t: t["text"])


def longest_run(units: Column) -> Column:
    """struct(unit, length) of the first longest run of equal neighbours; length 0 without units."""
    start = F.struct(F.lit("").alias("w"), F.lit(0).alias("n"), F.lit("").alias("unit"), F.lit(0).alias("length"))

    def step(s: Column, w: Column) -> Column:
        n = F.when((s["n"] > 0) & (s["w"] == w), s["n"] + 1).otherwise(1)
        return F.struct(w.alias("w"), n.alias("n"), F.when(n > s["length"], w).otherwise(s["unit"]).alias("unit"), F.greatest(s["length"], n).alias("length"))

    found = F.aggregate(units, start, step)
    return F.struct(found["unit"].alias("unit"), found["length"].alias("length"))


def switches(languages: Column) -> Column:
    """How often neighbours differ."""
    n = F.size(languages)
    pairs = F.zip_with(F.slice(languages, F.lit(2), F.greatest(n - 1, F.lit(0))), F.slice(languages, F.lit(1), F.greatest(n - 1, F.lit(0))), lambda a, b: a != b)
    return F.size(F.filter(pairs, lambda x: F.coalesce(x, F.lit(False))))


def numeric_matches(text: Column, digits: int) -> Column:
    """Words that mix a letter and a digit, then runs of `digits` digits or more, in that order."""
    mixed = F.filter(words(text), lambda w: w.rlike(r"\p{Nd}") & w.rlike(r"\p{L}"))
    return F.concat(mixed, F.regexp_extract_all(text, F.lit(rf"\p{{Nd}}{{{digits},}}"), F.lit(0)))


def repeated_cues(cues: DataFrame, key: str, most: int) -> DataFrame:
    """(key, start_t, end_t, ordinals) of runs of more than `most` neighbouring cues of the same text, in order of ordinals."""
    runs = iv.runs(cues.select(key, "source_ordinal", "start_t", "end_t", "text"), [key], ["source_ordinal"], F.col("text"))
    g = runs.groupBy(key, "run").agg(F.min_by("start_t", "source_ordinal").alias("start_t"), F.max_by("end_t", "source_ordinal").alias("end_t"), F.sort_array(F.collect_list("source_ordinal")).alias("ordinals"))
    return g.where(F.size("ordinals") > most).drop("run")


def detect(cues: DataFrame, activity: DataFrame, key: str, width: int, per_second: int, rules: dict | None = None) -> DataFrame:
    """(key, place, start_t, end_t, detector, ordinals, evidence): the findings of all six detectors, in one order per key.

    cues: key, source_ordinal, start_t, end_t, text, tokens array<struct<text,confidence>>, languages array<string>.
    place counts from 1 in order of start, end and detector (then ordinals and evidence). Thresholds: an overlap with
    silence and speech without text count from their length on, repetitions and switches beyond it.
    """
    rules = RULES if rules is None else rules
    none = F.array().cast("array<bigint>")

    def found(rows: DataFrame, detector: str, ordinals: Column, evidence: Column) -> DataFrame:
        return rows.select(key, "start_t", "end_t", F.lit(DETECTORS.index(detector)).alias("position"), ordinals.cast("array<bigint>").alias("ordinals"), evidence.cast("string").alias("evidence"))

    own = F.array("source_ordinal")
    silent = activity.where("state = 'non_speech'").select(key, "start_t", "end_t")
    speech = iv.union(activity.where("state = 'speech_likely'").select(key, "start_t", "end_t"), key)
    over = sp.text_over_silence(cues.select(key, "source_ordinal", "start_t", "end_t"), silent, rules["vad_coverage"]["minimum_silence_overlap_seconds"] * per_second, [key], width)
    bare = sp.textless_speech(speech, cues.select(key, "start_t", "end_t"), rules["coverage_checks"]["minimum_textless_speech_seconds"] * per_second, key)
    most = rules["repetition"]["maximum_consecutive_repetitions"]
    units = F.when(F.size("tokens") > 0, F.transform("tokens", lambda t: t["text"])).otherwise(words("text"))
    told = lambda detector, rule, evidence: F.when(rule, F.struct(F.lit(DETECTORS.index(detector)).alias("position"), evidence.cast("string").alias("evidence")))
    seen = cues.withColumns({"_low": low_tokens(F.col("tokens"), rules["confidence"]["minimum_token_confidence"]), "_run": longest_run(units), "_turns": switches(F.col("languages")), "_numbers": numeric_matches(F.col("text"), rules["numbers_entities"]["minimum_digit_run"])})
    local = F.array(  # what one cue alone shows: all four in one pass over the cues
        told("confidence", F.size("_low") > 0, F.array_join("_low", " ")), told("repetition", F.col("_run.length") > most, F.concat_ws(" ", "_run.unit", F.col("_run.length").cast("string"))),
        told("language_switching", F.col("_turns") > rules["language_switching"]["maximum_language_switches"], F.col("_turns")), told("numbers_entities", F.size("_numbers") > 0, F.array_join("_numbers", " ")))
    within = seen.select(key, "start_t", "end_t", own.cast("array<bigint>").alias("ordinals"), F.inline(F.filter(local, lambda f: f.isNotNull()))).select(key, "start_t", "end_t", "position", "ordinals", "evidence")
    across = repeated_cues(cues, key, most)
    every = (found(over, "vad_coverage", own, F.lit("")).unionByName(found(bare, "coverage_checks", none, F.lit(""))).unionByName(within).unionByName(found(across, "repetition", F.col("ordinals"), F.lit("across"))))
    place = F.row_number().over(Window.partitionBy(key).orderBy("start_t", "end_t", "position", "ordinals", "evidence"))
    names = F.array(*[F.lit(d) for d in DETECTORS])
    return every.select(key, place.cast("long").alias("place"), "start_t", "end_t", F.get(names, F.col("position")).alias("detector"), "ordinals", "evidence")
