"""Publication: what a plan's mode and parts ask for, from small tables of rules, and which evidence stands for each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What each mode publishes as subtitles and as transcript, the extensions, and the documents of every collection.
SUBTITLES = {"subtitle_first": ("source", "readable"), "full_asr": ("verbatim", "readable"), "enhancement": ("enhanced",)}
TRANSCRIPT = {"subtitle_first": "source", "full_asr": "verbatim", "enhancement": "enhanced"}
EXTENSIONS = {"subtitles": ("srt", "vtt"), "transcript": ("md", "json")}
DOCUMENTS = {"content_report": "content-report.md", "segments": "segments.json", "correction_log": "correction-log.json"}
_RULE = "mode string, of_part boolean, kind string, basis string, name string, timing_view string, governed boolean"


def rules(spark: SparkSession) -> DataFrame:
    """(mode, of_part, kind, basis, name, timing_view, governed): a row for each file that a mode asks for, some thirty in all.

    governed: whether adopted alignments may replace its times. Documents have no basis; those without a timeline no view.
    """
    rows = []
    for mode, bases in SUBTITLES.items():
        for basis in bases:
            for extension in EXTENSIONS["subtitles"]:
                rows += [(mode, of_part, "subtitles", basis, f"subtitles.{basis}.{extension}", "part_relative" if of_part else "collection_virtual", True) for of_part in (True, False)]
        rows += [(mode, False, "transcript", TRANSCRIPT[mode], f"transcript.{TRANSCRIPT[mode]}.{extension}", "collection_virtual", True) for extension in EXTENSIONS["transcript"]]
        rows += [(mode, False, kind, None, name, "collection_virtual" if kind == "segments" else None, False) for kind, name in DOCUMENTS.items()]
    return spark.createDataFrame(rows, _RULE)


def expected_artifacts(plans: DataFrame, parts: DataFrame) -> DataFrame:
    """(collection, part_id, path, kind, basis, timing_view, governed, reason) of plans (collection, mode) and their parts (collection, part_id).

    A plan of no known mode (missing_asr_mode), without parts (empty_plan) or with a part twice (duplicate_part) is one
    row with that reason and no path.
    """
    counted = parts.groupBy("collection").agg(F.count("part_id").alias("n"), F.count_distinct("part_id").alias("different"))
    n = F.coalesce("n", F.lit(0))
    reason = F.when(~F.coalesce(F.col("mode").isin(*SUBTITLES), F.lit(False)), "missing_asr_mode").when(n == 0, "empty_plan").when(n > F.col("different"), "duplicate_part")
    judged = plans.join(counted, "collection", "left").select("collection", "mode", reason.alias("reason"))
    ruled = judged.where("reason is null").join(F.broadcast(rules(plans.sparkSession)), "mode")  # some thirty rows
    of_parts = ruled.where("of_part").join(parts, "collection").withColumn("path", F.concat(F.lit("parts/"), F.col("part_id").cast("string"), F.lit("/"), "name"))
    names = ("collection", "part_id", "path", "kind", "basis", "timing_view", "governed", "reason")
    part = parts.schema["part_id"].dataType
    whole = ruled.where("not of_part").withColumn("part_id", F.lit(None).cast(part)).withColumn("path", F.col("name"))
    refused = judged.where("reason is not null").select("collection", F.lit(None).cast(part).alias("part_id"), *[F.lit(None).cast("string").alias(c) for c in names[2:6]], F.lit(None).cast("boolean").alias("governed"), "reason")
    return of_parts.select(*names).unionByName(whole.select(*names)).unionByName(refused)


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"_part": F.coalesce(F.col("part_id").cast("string"), F.lit("")), "_basis": F.coalesce("basis", F.lit(""))})


def project_artifacts(plans: DataFrame, parts: DataFrame, evidence: DataFrame) -> DataFrame:
    """(collection, path, kind, status, timing_view, timing_basis, sha256, reason) of every artifact that plans ask for.

    evidence: collection, part_id (null: of the collection), kind, basis (null: a document), original, adopted (texts),
    gates_passed, partial, invalid; of more than one row the first by its texts counts. The
    adopted text stands where there is one and its gates have passed, else the original one; without either the artifact
    is unavailable and has no digest, for nothing is made up. Evidence that no plan asks for is left (unused_evidence).
    """
    wanted = _keyed(expected_artifacts(plans, parts))
    keys = ["collection", "_part", "kind", "_basis"]
    place = Window.partitionBy(*keys).orderBy("original", "adopted")
    given = _keyed(evidence).withColumn("_n", F.row_number().over(place)).where("_n = 1").select(*keys, "original", "adopted", "gates_passed", "partial", "invalid")
    rows = wanted.join(given, keys, "left")
    adopted = F.col("governed") & F.col("adopted").isNotNull() & F.coalesce("gates_passed", F.lit(False))
    content = F.when(adopted, F.col("adopted")).otherwise(F.col("original"))
    flag = lambda c: F.coalesce(c, F.lit(False))
    status: Column = F.when(F.col("reason").isNotNull(), "refused").when(content.isNull(), "unavailable").when(flag("invalid"), "invalid").when(flag("partial"), "partial").otherwise("valid")
    basis = F.when(F.col("governed") & content.isNotNull(), F.when(adopted, "adopted_alignment").otherwise("original"))
    return rows.select("collection", "path", "kind", status.alias("status"), "timing_view", basis.alias("timing_basis"), F.sha2(content, 256).alias("sha256"), "reason")


def unused_evidence(plans: DataFrame, parts: DataFrame, evidence: DataFrame) -> DataFrame:
    """The rows of evidence that stand for no artifact of their plan, such as another mode's."""
    keys = ["collection", "_part", "kind", "_basis"]
    return _keyed(evidence).join(_keyed(expected_artifacts(plans, parts)).select(*keys), keys, "left_anti").select(*evidence.columns)
