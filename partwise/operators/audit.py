"""Manifests, digests, reuse of recorded work, reports and journals of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Actions that write a path, classes that may be deleted, states whose content counts, states that passed every gate.
WRITTEN = ("created", "modified", "published", "downloaded")
DELETABLE = ("safe_to_delete", "rebuildable")
CONTENT = ("valid", "partial")
AUDITED = ("complete", "complete_with_warnings")


def compared(recorded: DataFrame, present: DataFrame, keys: list[str], path: str, digest: str = "sha256") -> DataFrame:
    """(keys, path, finding) of every path of either side: missing, unexpected, hash_mismatch, or null where both agree."""
    m, p = recorded.select(*keys, path, F.col(digest).alias("_m")), present.select(*keys, path, F.col(digest).alias("_p"))
    finding = F.when(F.col("_p").isNull(), "missing").when(F.col("_m").isNull(), "unexpected").when(F.col("_m") != F.col("_p"), "hash_mismatch")
    return m.join(p, [*keys, path], "full").select(*keys, path, finding.alias("finding"))


def tree_digest(entries: DataFrame, root: str) -> DataFrame:
    """(root, digest, files): one digest over a root's sorted lines of path and digest. A root is one directory; its list of files is one row."""
    listed = F.sort_array(F.collect_list(F.struct("path", "sha256")))
    text = F.array_join(F.transform(listed, lambda e: F.concat_ws(" ", e["path"].cast("string"), e["sha256"])), "\n")
    return entries.groupBy(root).agg(F.sha2(text, 256).alias("digest"), F.count("*").alias("files"))


def projection_digest(entries: DataFrame, run: str, version: Column, inputs: Column, config: Column) -> DataFrame:
    """(run, digest, key): a digest over sorted entries as JSON, and the key that changes with the version, the inputs' digests or the configuration."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct("path", "sha256"))), lambda e: F.to_json(e))
    g = entries.groupBy(run).agg(F.sha2(F.array_join(listed, ","), 256).alias("digest"), F.min(version).alias("_v"), F.array_sort(F.collect_set(inputs)).alias("_i"), F.min(config).alias("_c"))
    return g.select(run, "digest", F.sha2(F.concat_ws("|", "_v", F.array_join("_i", "|"), "_c"), 256).alias("key"))


def adoptable(recorded: DataFrame, planned: DataFrame, keys: list[str]) -> DataFrame:
    """recorded units (keys, status, digest) with outcome: reusable (adopted) if completed and of the digest planned now.

    Else why not: the status of one that did not complete, unit_no_longer_planned, or invalidation_key_changed.
    planned: keys, fresh.
    """
    rows = recorded.join(planned.select(*keys, "fresh"), keys, "left")
    outcome = F.when(F.col("status") != "completed", F.col("status")).when(F.col("fresh").isNull(), "unit_no_longer_planned").when(F.col("fresh") != F.col("digest"), "invalidation_key_changed").otherwise("adopted")
    return rows.withColumn("outcome", outcome)


def carried_parts(prior: DataFrame, new: DataFrame, affected: DataFrame, key: str, report: Column, report_digest: Column) -> DataFrame:
    """Rows of both bases, one origin a part: new rows where there are any, else prior rows of parts not affected, with the report and digest they come from."""
    fresh = new.withColumn("origin", F.lit("new")).withColumn("from_report", F.lit(None).cast("string")).withColumn("from_sha256", F.lit(None).cast("string"))
    kept = prior.join(affected.select(key).distinct(), key, "left_anti").join(new.select(key).distinct(), key, "left_anti")
    return fresh.unionByName(kept.withColumn("origin", F.lit("carried")).withColumn("from_report", report).withColumn("from_sha256", report_digest))


def carried_artifacts(prior: DataFrame, new: DataFrame, affected: DataFrame) -> DataFrame:
    """(path, kind, part_id, status, sha256, origin) of artifacts: new ones, and prior ones where the path is absent or without content.

    Carried are only artifacts of a part that is not affected, with content (valid or partial) and a digest; never
    documents nor files of the whole collection (part_id null).
    """
    rows = ("path", "kind", "part_id", "status", "sha256")
    usable = prior.where(F.col("status").isin(*CONTENT) & (F.col("kind") != "document") & F.col("part_id").isNotNull() & F.col("sha256").isNotNull()).join(affected.select("part_id").distinct(), "part_id", "left_anti")
    old = usable.select("path", *[F.col(c).alias(f"o_{c}") for c in rows[1:]])
    both = new.select(*rows).join(old, "path", "full")
    own = F.col("kind").isNotNull() & (F.col("status").isin(*CONTENT) | F.col("o_kind").isNull())
    return both.select("path", *[F.when(own, F.col(c)).otherwise(F.col(f"o_{c}")).alias(c) for c in rows[1:]], F.when(own, "new").otherwise("carried").alias("origin"))


def quality_report(gates: DataFrame, review: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, stage, scope, status, n, review_intervals, verification): gate outcomes counted, with the run's review intervals in order.

    gates: run_id, stage, scope, status; review: run_id, scope, reason, detail; runs: run_id, run_status. Only a run that
    is complete, with or without warnings, is model_audited; any other is review_needed.
    """
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("scope", "reason", "detail"))), lambda r: F.concat_ws("|", r["scope"], r["reason"], r["detail"])), ";")
    needed = review.groupBy("run_id", "scope").agg(lines.alias("review_intervals"))
    level = F.when(F.col("run_status").isin(*AUDITED), "model_audited").otherwise("review_needed")
    counted = gates.groupBy("run_id", "stage", "scope", "status").agg(F.count("*").alias("n"))
    return counted.join(needed, ["run_id", "scope"], "left").join(runs, "run_id", "left").select("run_id", "stage", "scope", "status", "n", F.coalesce("review_intervals", F.lit("")).alias("review_intervals"), level.alias("verification"))


def run_inventory(entries: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(run_id, n_read, written, deletable, published, duplicates, error) from entries (run_id, path, action, deletion_class) and artifacts (run_id, path, status).

    Published entries count only for artifacts with content. A path recorded twice for one action is an error
    (duplicate_inventory_entry).
    """
    content = artifacts.where(F.col("status").isin(*CONTENT)).select("run_id", "path").distinct().withColumn("has", F.lit(True))
    rows = entries.withColumn("again", F.row_number().over(Window.partitionBy("run_id", "path", "action").orderBy("deletion_class")) > 1).join(content, ["run_id", "path"], "left")
    a = F.col("action")
    g = rows.groupBy("run_id").agg(F.count_if(a == "read").alias("n_read"), F.count_if(a.isin(*WRITTEN)).alias("written"), F.count_if(F.col("deletion_class").isin(*DELETABLE)).alias("deletable"),
                                   F.count_if((a == "published") & F.col("has")).alias("published"), F.count_if("again").alias("duplicates"))
    return g.withColumn("error", F.when(F.col("duplicates") > 0, "duplicate_inventory_entry"))


def calibration(expected: DataFrame, produced: DataFrame, key: str) -> DataFrame:
    """(key, state, false_accepts, false_rejects) of candidates whose outputs (key, item, accepted, body) are compared as canonical JSON.

    A candidate with an item too many, too few or different in any field is calibration_failed, else qualified.
    """
    canon = F.sha2(F.to_json(F.struct("accepted", "body", "item")), 256)
    e = expected.select(key, "item", F.col("accepted").alias("e_accepted"), canon.alias("e"))
    p = produced.select(key, "item", F.col("accepted").alias("p_accepted"), canon.alias("p"))
    rows = e.join(p, [key, "item"], "full")
    yes, no = F.coalesce("p_accepted", F.lit(False)), F.coalesce("e_accepted", F.lit(False))
    g = rows.groupBy(key).agg(F.bool_and(F.coalesce(F.col("e") == F.col("p"), F.lit(False))).alias("same"), F.count_if(yes & ~no).alias("false_accepts"), F.count_if(~yes & no).alias("false_rejects"))
    return g.select(key, F.when(F.col("same"), "qualified").otherwise("calibration_failed").alias("state"), "false_accepts", "false_rejects")


def replay(events: DataFrame, edges: dict[str | None, set[str]]) -> DataFrame:
    """(run_id, status, next_sequence, illegal, holes, valid_prefix, torn) of journals (run_id, line, sequence, from_status, to_status).

    line is the place in the file; an event must be whole (sequence and to_status not null), run on without a hole, come
    from the status before it and follow an edge. valid_prefix is the number of leading events for which all this holds,
    torn how many a repair drops behind the last whole one. status is that after the longest beginning of whole events.
    """
    order = Window.partitionBy("run_id").orderBy("line")
    whole = F.col("sequence").isNotNull() & F.col("to_status").isNotNull()
    rows = events.withColumn("whole", F.min(whole.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    before, last = F.lag("to_status").over(order), F.lag("sequence").over(order)
    legal = F.lit(False)
    for a, to in edges.items():
        if to:
            legal = legal | ((F.col("before").isNull() if a is None else F.coalesce(F.col("before") == a, F.lit(False))) & F.col("to_status").isin(*sorted(to)))
    rows = rows.withColumn("before", before).withColumn("hole", F.col("sequence") != F.coalesce(last + 1, F.lit(1)))
    linked = F.col("from_status").eqNullSafe(F.col("before"))
    rows = rows.withColumn("illegal", F.col("whole") & ~(F.coalesce(legal, F.lit(False)) & linked)).withColumn("hole", F.col("whole") & F.coalesce("hole", F.lit(False)))
    good = F.min((F.col("whole") & ~F.col("illegal") & ~F.col("hole")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("good", good)
    kept = F.when(F.col("whole"), F.col("line"))
    return rows.groupBy("run_id").agg(F.max_by(F.when(F.col("whole"), F.col("to_status")), kept).alias("status"), (F.coalesce(F.max(F.when(F.col("whole"), F.col("sequence"))), F.lit(0)) + 1).cast("long").alias("next_sequence"),
                                      F.count_if("illegal").alias("illegal"), F.count_if("hole").alias("holes"), F.sum("good").cast("long").alias("valid_prefix"), F.count_if(~F.col("whole")).alias("torn"))


def changed_parts(old: DataFrame, new: DataFrame, key: str, base: str) -> DataFrame:
    """(key, state) of parts of two bases (key, base: what a part's base consists of, in order): added, removed, changed or unaffected."""
    both = old.select(key, F.col(base).alias("_o"), F.lit(True).alias("_in_old")).join(new.select(key, F.col(base).alias("_n"), F.lit(True).alias("_in_new")), key, "full")
    return both.select(key, F.when(F.col("_in_old").isNull(), "added").when(F.col("_in_new").isNull(), "removed").when(~F.col("_o").eqNullSafe(F.col("_n")), "changed").otherwise("unaffected").alias("state"))


def recurring(failures: DataFrame, parts: list[str], report: str) -> DataFrame:
    """(fingerprint, reports, first_report) of failures seen more than once; a fingerprint is the digest of the columns `parts`."""
    rows = failures.select(report, F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in parts]), 256).alias("fingerprint"))
    return rows.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("reports"), F.min(report).alias("first_report")).where("reports > 1")


def terminal_status(steps: DataFrame, run: str, failed: Column, warned: Column, most_failed: int) -> DataFrame:
    """(run, status): failed if every step has, incomplete if more than most_failed have, else complete, with warnings if any step warned."""
    g = steps.groupBy(run).agg(F.bool_and(failed).alias("all"), F.count_if(failed).alias("some"), F.bool_or(warned).alias("warned"))
    return g.select(run, F.when(F.col("all"), "failed").when(F.col("some") > most_failed, "incomplete").when(F.col("warned"), "complete_with_warnings").otherwise("complete").alias("status"))


def peak_memory(measurements: DataFrame, capability: str) -> DataFrame:
    """(capability, peak, confidence) of measurements (capability, peak, confidence), and of all (capability null): the largest peak, and the one confidence or `mixed`."""
    labels = F.array_sort(F.collect_set("confidence"))
    return measurements.rollup(capability).agg(F.max("peak").alias("peak"), F.when(F.size(labels) == 1, labels[0]).otherwise("mixed").alias("confidence"))


def decode_estimate(sources: DataFrame, measurements: DataFrame, capabilities: list[str], confidence: str = "high", factors: tuple[int, int, int] = (8, 3, 1), per_second: int = 1000) -> DataFrame:
    """(source, capability, optimistic, likely, conservative, measured): seconds for each source (source, s: its length) and capability.

    measurements: source, capability, peak, confidence, run_id, seq. The newest one of the confidence asked for is all
    three; without one the length is divided by each of the factors and rounded up.
    """
    newest = measurements.where(F.col("confidence") == confidence).groupBy("source", "capability").agg(F.expr(f"max_by(peak, struct(run_id, seq)) div {per_second}").alias("m"))
    rows = sources.withColumn("capability", F.explode(F.array(*[F.lit(c) for c in capabilities]))).join(newest, ["source", "capability"], "left")
    over = lambda k: F.coalesce("m", F.expr(f"(s + {k - 1}) div {k}"))
    return rows.select("source", "capability", *[over(k).alias(n) for k, n in zip(factors, ("optimistic", "likely", "conservative"))], F.col("m").isNotNull().alias("measured"))


def elapsed_and_size(events: DataFrame, run: str) -> DataFrame:
    """(run, elapsed, disk) of runs with two events (run, sequence, at, bytes) or more: time between the first and the last, and their bytes."""
    g = events.groupBy(run).agg((F.max_by("at", "sequence") - F.min_by("at", "sequence")).alias("elapsed"), F.sum("bytes").alias("disk"), F.count(F.lit(1)).alias("n"))
    return g.where("n >= 2").drop("n")


def verbatim_runs(steps: DataFrame, run: str, passed: Column, completed: Column) -> DataFrame:
    """(run, verbatim): only a run that has completed and whose every step has passed is emitted verbatim."""
    return steps.groupBy(run).agg((F.bool_and(passed) & F.bool_or(completed)).alias("verbatim"))


def latest_eligible(runs: DataFrame, source: str, run: str, eligible: Column) -> DataFrame:
    """(source, run): the newest eligible run of each source."""
    return runs.where(eligible).groupBy(source).agg(F.max(run).alias(run))


def first_valid(candidates: DataFrame, source: str, candidate: str, order: str, valid: Column) -> DataFrame:
    """(source, candidate): the first valid candidate of each source in order."""
    return candidates.where(valid).groupBy(source).agg(F.min_by(candidate, order).alias("candidate"))
