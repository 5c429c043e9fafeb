"""Queries of re-analysis, manifest, run and audit operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partwise.operators import audit, publication
from partwise.plans import inputs
from partwise.plans.inputs import sql
from partwise.plans.registry import query
from partwise.sources import journals
from partwise.sources.subtitles import work_folder
from partwise.streaming import journal

@query(sql("SELECT coalesce(m.run_id, p.run_id) AS run_id, coalesce(m.path, p.path) AS path, CASE WHEN p.path IS NULL THEN 'missing' WHEN m.path IS NULL THEN 'unexpected' WHEN m.sha256 <> p.sha256 THEN 'hash_mismatch' END AS finding FROM manifest m FULL JOIN present p ON m.run_id = p.run_id AND m.path = p.path WHERE p.path IS NULL OR m.path IS NULL OR m.sha256 <> p.sha256"))
def C12_verify_bundle(spark, sf_dir):
    """Two-way comparison of a manifest with what is there."""
    return audit.compared(inputs.manifest(spark, sf_dir), inputs.present(spark, sf_dir), ["run_id"], "path").where("finding is not null")



_OLD = "SELECT part_id, string_agg(source_ordinal::VARCHAR, ',' ORDER BY start_t, source_ordinal) AS ids FROM cues WHERE part_id % 10 <> 4 GROUP BY part_id"
_NEW = "SELECT part_id, string_agg(CASE WHEN part_id % 6 = 1 THEN source_ordinal + 1 ELSE source_ordinal END::VARCHAR, ',' ORDER BY CASE WHEN part_id % 6 = 2 THEN -source_ordinal ELSE source_ordinal END) AS ids FROM cues WHERE part_id % 10 <> 7 GROUP BY part_id"


def _bases(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    cues = inputs.cues(spark, sf_dir)
    listed = lambda order, value: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, value.alias("v")))), lambda c: c["v"].cast("string")), ",").alias("ids")
    o, p = F.col("source_ordinal"), F.col("part_id")
    old = cues.where("part_id % 10 <> 4").groupBy("part_id").agg(listed(["start_t", "source_ordinal"], o))
    new = cues.where("part_id % 10 <> 7").groupBy("part_id").agg(listed([F.when(p % 6 == 2, -o).otherwise(o).alias("k")], F.when(p % 6 == 1, o + 1).otherwise(o)))
    return old, new


@query(sql("SELECT part_id, CASE WHEN o.ids IS NULL THEN 'added' WHEN n.ids IS NULL THEN 'removed' WHEN o.ids <> n.ids THEN 'changed' ELSE 'unaffected' END AS state FROM old_base o FULL JOIN new_base n USING (part_id)", old_base=_OLD, new_base=_NEW))
def C13_affected_parts(spark, sf_dir):
    """Parts whose ordered cue ids differ between two bases."""
    old, new = _bases(spark, sf_dir)
    return audit.changed_parts(old, new, "part_id", "ids")



_ARTIFACTS = """SELECT path, kind, part_id, status, sha256 FROM (SELECT doc_id AS path, CASE WHEN doc_id % 10 = 9 THEN 'document' ELSE 'srt' END AS kind, CASE WHEN doc_id % 14 <> 5 THEN doc_id // 4 END AS part_id, ['valid', 'partial', 'invalid', 'unavailable'][doc_id % 4 + 1] AS status, CASE WHEN doc_id % 4 < 3 THEN sha256(text) END AS sha256 FROM documents)"""


@query(sql("""SELECT 'part' AS level, part_id AS id, CASE WHEN n.ids IS NOT NULL AND (o.ids IS NULL OR o.ids <> n.ids) THEN n.ids ELSE o.ids END AS content, CASE WHEN n.ids IS NOT NULL AND (o.ids IS NULL OR o.ids <> n.ids) THEN 'new' ELSE 'carried' END AS origin, CASE WHEN n.ids IS NOT NULL AND (o.ids IS NULL OR o.ids <> n.ids) THEN NULL ELSE 'r1' END AS source FROM old_base o FULL JOIN new_base n USING (part_id)
    UNION ALL SELECT 'artifact', coalesce(n.path, p.path), CASE WHEN n.path IS NOT NULL AND (n.status IN ('valid', 'partial') OR p.path IS NULL) THEN n.sha256 ELSE p.sha256 END, CASE WHEN n.path IS NOT NULL AND (n.status IN ('valid', 'partial') OR p.path IS NULL) THEN 'new' ELSE 'carried' END, NULL
      FROM (SELECT path, kind, part_id, status, sha256 FROM artifacts WHERE path % 3 <> 1) n FULL JOIN (SELECT path, sha256 || 'p' AS sha256 FROM (SELECT path, kind, part_id, CASE WHEN path % 3 = 2 THEN 'valid' ELSE status END AS status, sha256 FROM artifacts ) WHERE status IN ('valid', 'partial') AND kind <> 'document' AND part_id IS NOT NULL AND sha256 IS NOT NULL AND part_id % 7 <> 3) p ON p.path = n.path""", old_base=_OLD, new_base=_NEW, artifacts=_ARTIFACTS))
def C14_carry_forward_merge(spark, sf_dir):
    """Prior rows of unaffected parts and new rows of the others; prior artifacts where the new run has none with content."""
    old, new = _bases(spark, sf_dir)
    changed = new.join(old, ["part_id", "ids"], "left_anti")
    parts = audit.carried_parts(old, changed, changed, "part_id", F.lit("r1"), F.sha2("ids", 256)).select(F.lit("part").alias("level"), F.col("part_id").alias("id"), F.col("ids").alias("content"), "origin", F.col("from_report").alias("source"))
    d = F.col("doc_id")
    docs = inputs.table(spark, sf_dir, "documents").select(d.alias("path"), F.when(d % 10 == 9, "document").otherwise("srt").alias("kind"), F.when(d % 14 != 5, F.floor(d / 4)).alias("part_id"),
                                                           F.get(F.array(*[F.lit(x) for x in ("valid", "partial", "invalid", "unavailable")]), (d % 4).cast("int")).alias("status"), F.when(d % 4 < 3, F.sha2("text", 256)).alias("sha256"))
    prior = docs.withColumn("status", F.when(F.col("path") % 3 == 2, "valid").otherwise(F.col("status"))).withColumn("sha256", F.concat("sha256", F.lit("p")))
    merged = audit.carried_artifacts(prior, docs.where("path % 3 <> 1"), docs.where("part_id % 7 = 3"))
    return parts.unionByName(merged.select(F.lit("artifact").alias("level"), F.col("path").alias("id"), F.col("sha256").alias("content"), "origin", F.lit(None).cast("string").alias("source")))



_UNITS = """SELECT event_id, user_id % 40 AS part_id, event_id % 6 AS stage, to_status, sha256((user_id % 40)::VARCHAR || '|' || (event_id % 6)::VARCHAR || '|' || (event_id % 4 = 0)::INT::VARCHAR) AS digest, sha256((user_id % 40)::VARCHAR || '|' || (event_id % 6)::VARCHAR || '|0') AS fresh FROM (SELECT run_id AS user_id, event_id, to_status FROM run_events )"""


@query(sql("SELECT event_id, CASE WHEN to_status <> 'completed' THEN to_status WHEN stage = 5 AND part_id > 30 THEN 'unit_no_longer_planned' WHEN digest <> fresh THEN 'invalidation_key_changed' ELSE 'adopted' END AS outcome FROM units ", units=_UNITS))
def C15_adoptable_units(spark, sf_dir):
    """Recorded units that can be used again, by digests computed anew, or why not."""
    key = lambda *parts: F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)
    rows = inputs.run_events(spark, sf_dir).select("event_id", (F.col("run_id") % 40).alias("part_id"), (F.col("event_id") % 6).alias("stage"), F.col("to_status").alias("status"))
    recorded = rows.withColumn("digest", key(F.col("part_id"), F.col("stage"), (F.col("event_id") % 4 == 0).cast("int")))
    planned = rows.select("part_id", "stage").distinct().where("not (stage = 5 and part_id > 30)").withColumn("fresh", key(F.col("part_id"), F.col("stage"), F.lit(0)))
    return audit.adoptable(recorded, planned, ["part_id", "stage"]).select("event_id", "outcome")


@query("SELECT sha256(event_type || '|' || (user_id % 20)::VARCHAR) AS fingerprint, count(*) AS reports, min(event_id) AS first_report FROM events WHERE event_type = 'error' GROUP BY 1 HAVING count(*) > 1")
def C19_recurring_failures(spark, sf_dir):
    """Failures that come back, by fingerprint of key and gate."""
    errors = inputs.table(spark, sf_dir, "events").where("event_type = 'error'").withColumn("gate", F.col("user_id") % 20)
    return audit.recurring(errors, ["event_type", "gate"], "event_id")



@query(sql("""SELECT g.run_id, g.stage, g.scope, g.status, g.n, coalesce(r.review_intervals, '') AS review_intervals, CASE WHEN g.run_id % 4 IN (0, 1) THEN 'model_audited' ELSE 'review_needed' END AS verification FROM (
      SELECT run_id, 's' || (event_id % 3)::VARCHAR AS stage, 'p' || (event_id % 2)::VARCHAR AS scope, to_status AS status, count(*) AS n FROM run_events GROUP BY ALL) g
    LEFT JOIN (SELECT run_id, 'p' || (event_id % 2)::VARCHAR AS scope, string_agg('p' || (event_id % 2)::VARCHAR || '|' || to_status || '|' || event_id::VARCHAR, ';' ORDER BY to_status, event_id::VARCHAR) AS review_intervals FROM run_events WHERE size > 400 GROUP BY ALL) r USING (run_id, scope)"""))
def D08_quality_report(spark, sf_dir):
    """Gate outcomes per stage and scope, the review intervals in order, and what level of verification a run may claim."""
    rows = inputs.run_events(spark, sf_dir).withColumn("stage", F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string"))).withColumn("scope", F.concat(F.lit("p"), (F.col("event_id") % 2).cast("string")))
    review = rows.where("size > 400").select("run_id", "scope", F.col("to_status").alias("reason"), F.col("event_id").cast("string").alias("detail"))
    status = F.get(F.array(*[F.lit(x) for x in ("complete", "complete_with_warnings", "incomplete", "failed")]), (F.col("run_id") % 4).cast("int"))
    return audit.quality_report(rows.select("run_id", "stage", "scope", F.col("to_status").alias("status")), review, rows.select("run_id").distinct().withColumn("run_status", status))


@query(sql("SELECT run_id, CASE WHEN bool_and(to_status = 'failed') THEN 'failed' WHEN count(*) FILTER (to_status = 'failed') > 15 THEN 'incomplete' WHEN bool_or(size > 480) THEN 'complete_with_warnings' ELSE 'complete' END AS status FROM run_events GROUP BY run_id"))
def D09_run_terminal_status(spark, sf_dir):
    """How a run ended, from its parts."""
    return audit.terminal_status(inputs.run_events(spark, sf_dir), "run_id", F.col("to_status") == "failed", F.col("size") > 480, 15)



@query(sql("SELECT capability, max(peak) AS peak, CASE WHEN count(DISTINCT confidence) = 1 THEN min(confidence) ELSE 'mixed' END AS confidence FROM measurements GROUP BY ROLLUP (capability)"))
def D10_peak_memory(spark, sf_dir):
    """Largest peak per capability and of the run (null), with the one confidence or `mixed`."""
    return audit.peak_memory(inputs.measurements(spark, sf_dir), "capability")



@query(sql("""SELECT p.p_partkey AS source, c.capability, coalesce(m.peak // 1000, (p.p_size * 60 + 7) // 8) AS optimistic, coalesce(m.peak // 1000, (p.p_size * 60 + 2) // 3) AS likely, coalesce(m.peak // 1000, p.p_size * 60) AS conservative, m.peak IS NOT NULL AS measured
    FROM part p CROSS JOIN (VALUES ('AF'), ('NF'), ('NO'), ('RF')) c(capability) LEFT JOIN (SELECT source, capability, arg_max(peak, (run_id, seq)) AS peak FROM measurements WHERE confidence = 'high' GROUP BY source, capability) m ON m.source = p.p_partkey AND m.capability = c.capability"""))
def D11_decode_estimate(spark, sf_dir):
    """The newest measurement of a source for each capability, else its length over three factors, rounded up."""
    sources = inputs.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("source"), (F.col("p_size") * 60).cast("long").alias("s"))
    return audit.decode_estimate(sources, inputs.measurements(spark, sf_dir), ["AF", "NF", "NO", "RF"])



@query(sql("""SELECT run_id, arg_max("at", sequence) - arg_min("at", sequence) AS elapsed, round(sum(size) * 100)::BIGINT AS disk FROM run_events GROUP BY run_id HAVING count(*) >= 2"""))
def D12_run_elapsed_and_disk(spark, sf_dir):
    """Time between a run's first and last event, and its sizes."""
    events = inputs.run_events(spark, sf_dir).withColumn("bytes", F.round(F.col("size") * 100).cast("long"))
    return audit.elapsed_and_size(events, "run_id")



_ENTRIES = """SELECT run_id, floor(size)::BIGINT AS path, ['read', 'created', 'modified', 'published', 'downloaded'][event_id % 5 + 1] AS action, ['safe_to_delete', 'rebuildable', 'published', 'keep_for_audit'][event_id % 4 + 1] AS deletion_class FROM run_events """


@query(sql("""SELECT run_id, n_read, written, deletable, published, duplicates, CASE WHEN duplicates > 0 THEN 'duplicate_inventory_entry' END AS error FROM (SELECT run_id, count(*) FILTER (action = 'read') AS n_read, count(*) FILTER (action <> 'read') AS written, count(*) FILTER (deletion_class IN ('safe_to_delete', 'rebuildable')) AS deletable,
    count(*) FILTER (action = 'published' AND path % 4 < 2) AS published, count(*) - count(DISTINCT (path, action)) AS duplicates FROM entries GROUP BY run_id)""", entries=_ENTRIES))
def D13_run_inventory(spark, sf_dir):
    """What a run read, wrote, published with content and may delete; a repeated path and action is an error."""
    pick = lambda names, k: F.get(F.array(*[F.lit(x) for x in names]), (F.col("event_id") % k).cast("int"))
    entries = inputs.run_events(spark, sf_dir).select("run_id", F.floor("size").alias("path"), pick(("read", "created", "modified", "published", "downloaded"), 5).alias("action"), pick(("safe_to_delete", "rebuildable", "published", "keep_for_audit"), 4).alias("deletion_class"))
    status = F.when(F.col("path") % 4 == 0, "valid").when(F.col("path") % 4 == 1, "partial").otherwise("unavailable")
    return audit.run_inventory(entries, entries.select("run_id", "path").distinct().withColumn("status", status))


@query(sql("""SELECT run_id, sha256(string_agg('{"path":' || path::VARCHAR || ',"sha256":"' || sha256 || '"}', ',' ORDER BY path)) AS digest, sha256('v2|' || string_agg(DISTINCT sha256, '|' ORDER BY sha256) || '|cfg' || (run_id % 3)::VARCHAR) AS key FROM manifest GROUP BY run_id"""))
def D16_projection_digest(spark, sf_dir):
    """One digest over a manifest's sorted entries as JSON, and the key that tells when it is stale."""
    config = F.concat(F.lit("cfg"), (F.col("run_id") % 3).cast("string"))
    return audit.projection_digest(inputs.manifest(spark, sf_dir), "run_id", F.lit("v2"), F.col("sha256"), config)


@query("""SELECT candidate, CASE WHEN bool_and(coalesce(same, false)) THEN 'qualified' ELSE 'calibration_failed' END AS state, count(*) FILTER (coalesce(p, false) AND NOT coalesce(e, false)) AS false_accepts, count(*) FILTER (coalesce(e, false) AND NOT coalesce(p, false)) AS false_rejects FROM (
    SELECT doc_id // 8 AS candidate, n_chars > 1000 AS e, CASE WHEN doc_id % 29 <> 1 THEN length(text) > CASE WHEN doc_id % 50 = 0 THEN 3000 ELSE 1000 END END AS p,
      doc_id % 29 <> 1 AND (n_chars > 1000) = (length(text) > CASE WHEN doc_id % 50 = 0 THEN 3000 ELSE 1000 END) AND doc_id % 31 <> 2 AS same FROM documents) GROUP BY candidate""")
def D18_calibration_eval(spark, sf_dir):
    """Produced outputs compared with expected ones, whole and as canonical JSON, per candidate."""
    d = F.col("doc_id")
    docs = inputs.table(spark, sf_dir, "documents").select(F.floor(d / 8).alias("candidate"), d.alias("item"), "n_chars", "text")
    expected = docs.select("candidate", "item", (F.col("n_chars") > 1000).alias("accepted"), F.sha2("text", 256).alias("body"))
    k = F.col("item")
    produced = docs.where("item % 29 <> 1").select("candidate", "item", (F.length("text") > F.when(k % 50 == 0, 3000).otherwise(1000)).alias("accepted"), F.when(k % 31 == 2, "other").otherwise(F.sha2("text", 256)).alias("body"))
    return audit.calibration(expected, produced, "candidate")


_LEGAL = " OR ".join(f"(from_status {'IS NULL' if a is None else f'= {chr(39)}{a}{chr(39)}'} AND to_status IN ({', '.join(chr(39) + b + chr(39) for b in sorted(to))}))" for a, to in journal.EDGES.items() if to)


#: How a journal's end is damaged, by run_id % 7: cut within its last record, its last line feed gone, a foreign line in it, a record of another schema, a byte that is no UTF-8.
_LINE_SQL = """'{"schema_version":' || CASE WHEN run_id % 7 = 4 AND line = 8 THEN '2' ELSE '1' END || ',"kind":"transition","sequence":' || CASE WHEN run_id % 5 = 1 AND line > 10 THEN line + 1 ELSE line END || ',"from":' || coalesce('"' || CASE WHEN run_id % 6 = 3 AND line % 9 = 5 THEN 'paused' ELSE prev END || '"', 'null') || ',"to":"' || to_status || '"}'"""
_JOURNAL = f"""SELECT run_id, line, last, CASE WHEN run_id % 5 = 1 AND line > 10 THEN line + 1 ELSE line END AS sequence, CASE WHEN run_id % 6 = 3 AND line % 9 = 5 THEN 'paused' ELSE prev END AS from_status, to_status, strlen({_LINE_SQL}) AS bytes,
    CASE run_id % 7 WHEN 1 THEN line < last WHEN 2 THEN line < last WHEN 3 THEN line < 5 WHEN 4 THEN line < 8 WHEN 5 THEN line < least(last, 6) ELSE true END AS kept
    FROM (SELECT run_id, sequence AS line, to_status, lag(to_status) OVER (PARTITION BY run_id ORDER BY sequence) AS prev, max(sequence) OVER (PARTITION BY run_id) AS last FROM run_events )"""
_REPLAYED = f"""SELECT *, min((legal AND NOT hole)::INT) OVER (PARTITION BY run_id ORDER BY line ROWS UNBOUNDED PRECEDING) AS good FROM (
    SELECT run_id, line, sequence, to_status, bytes, coalesce(sequence <> coalesce(lag(sequence) OVER w + 1, 1), false) AS hole, coalesce({_LEGAL.replace('from_status', 'prev')}, false) AND given IS NOT DISTINCT FROM prev AS legal
    FROM (SELECT run_id, line, sequence, to_status, bytes, from_status AS given, lag(to_status) OVER (PARTITION BY run_id ORDER BY line) AS prev FROM journal_lines WHERE kept) WINDOW w AS (PARTITION BY run_id ORDER BY line))"""


@query(sql("""SELECT run_id, status, coalesce(next_sequence, 1) AS next_sequence, coalesce(illegal, 0) AS illegal, coalesce(holes, 0) AS holes, coalesce(valid_prefix, 0) AS valid_prefix, dropped, coalesce(size, 0) AS size FROM (
      SELECT run_id, count(*) FILTER (NOT kept) + (run_id % 7 = 3 AND max(last) >= 5)::INT AS dropped FROM journal_lines GROUP BY run_id) LEFT JOIN (
      SELECT run_id, arg_max(to_status, line) AS status, max(sequence) + 1 AS next_sequence, count(*) FILTER (NOT legal) AS illegal, count(*) FILTER (hole) AS holes, sum(good)::BIGINT AS valid_prefix, sum(bytes + 1)::BIGINT AS size FROM replayed GROUP BY run_id) USING (run_id)""", journal_lines=_JOURNAL, replayed=_REPLAYED))
def E13_journal_replay(spark, sf_dir):
    """Journals read from bytes: what a repair of a torn tail keeps and drops, and what the kept events say of each run."""
    order = Window.partitionBy("run_id").orderBy("sequence")
    rows = inputs.run_events(spark, sf_dir).select("run_id", F.col("sequence").alias("line"), F.lag("to_status").over(order).alias("prev"), F.max("sequence").over(Window.partitionBy("run_id")).alias("last"), "to_status")
    r, line = F.col("run_id"), F.col("line")
    given = F.when((r % 6 == 3) & (line % 9 == 5), "paused").otherwise(F.col("prev"))
    text = F.concat(F.lit('{"schema_version":'), F.when((r % 7 == 4) & (line == 8), "2").otherwise("1"), F.lit(',"kind":"transition","sequence":'), F.when((r % 5 == 1) & (line > 10), line + 1).otherwise(line).cast("string"), F.lit(',"from":'),
                    F.coalesce(F.when(given.isNotNull() & F.col("prev").isNotNull(), F.concat(F.lit('"'), given, F.lit('"'))), F.lit("null")), F.lit(',"to":"'), "to_status", F.lit('"}'))
    text = F.when((r % 7 == 3) & (line == 5), F.concat(F.lit("garbage {\n"), text)).otherwise(text)
    whole = F.encode(F.concat(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", text.alias("t")))), lambda x: x["t"]), "\n"), F.lit("\n")), "UTF-8").alias("whole")
    files = rows.groupBy("run_id").agg(whole, F.max("last").alias("last"))
    cut = lambda n: F.expr(f"substring(whole, 1, length(whole) - {n})")
    files = files.withColumn("_lines", F.split(F.decode("whole", "UTF-8"), "\n"))
    bytes_of = lambda *lines: F.encode(F.concat_ws("\n", *lines), "UTF-8")
    bad = F.expr("concat(substring(whole, 1, length(whole) - 2), unhex('FF'), unhex('7D0A'))")
    sixth, size = F.concat(bytes_of(F.slice("_lines", 1, 5), F.concat(F.get("_lines", F.lit(5)), F.lit("#"))), F.unhex(F.lit("FF0A"))), F.size("_lines")
    wrong = F.when(F.col("last") > 6, F.concat(sixth, bytes_of(F.slice("_lines", F.lit(7), F.greatest(size - 6, F.lit(0)))))).when(F.col("last") == 6, sixth).otherwise(bad)
    content = F.when(r % 7 == 1, cut(9)).when(r % 7 == 2, cut(1)).when(r % 7 == 5, wrong).otherwise(F.col("whole"))
    kept = journals.kept_lines(journals.journal_lines(files.select("run_id", content.alias("content")), "run_id"), "run_id")
    told = audit.replay(journals.transitions(kept, "run_id"), journal.EDGES).drop("torn")
    none = {c: F.coalesce(c, F.lit(d).cast("long")) for c, d in (("next_sequence", 1), ("illegal", 0), ("holes", 0), ("valid_prefix", 0))}
    return journals.repairs(kept, "run_id").select("run_id", "dropped", "size").join(told, "run_id", "left").withColumns(none)


@query("""WITH k0 AS (SELECT doc_id AS part_id, doc_id // 50 AS collection, sha256(text) AS h FROM documents), c AS (SELECT collection, sha256('s0|1|' || string_agg(h, '|' ORDER BY h)) AS k FROM k0 GROUP BY collection),
    k1 AS (SELECT part_id, sha256('s1|1|' || h || '|' || k || '|cfg' || (part_id % 3)::VARCHAR) AS key1 FROM k0 JOIN c USING (collection)), k2 AS (SELECT *, sha256('s2|1|' || key1 || '|cfg') AS key2 FROM k1)
    SELECT part_id, key1, key2, sha256('s3|2|' || key2 || '|cfg') AS key3 FROM k2""")
def E14_invalidation_keys(spark, sf_dir):
    """Chained keys of stages: a change reaches only what lies downstream."""
    parts = inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("part_id"), F.floor(F.col("doc_id") / 50).alias("collection"), F.sha2("text", 256).alias("h"))
    first = parts.groupBy("collection").agg(F.sha2(F.concat(F.lit("s0|1|"), F.array_join(F.sort_array(F.collect_list("h")), "|")), 256).alias("k"))
    chain = lambda *x: F.sha2(F.concat_ws("|", *x), 256)
    keyed = parts.join(first, "collection").withColumn("key1", chain(F.lit("s1"), F.lit("1"), "h", "k", F.concat(F.lit("cfg"), (F.col("part_id") % 3).cast("string"))))
    keyed = keyed.withColumn("key2", chain(F.lit("s2"), F.lit("1"), "key1", F.lit("cfg"))).withColumn("key3", chain(F.lit("s3"), F.lit("2"), "key2", F.lit("cfg")))
    return keyed.select("part_id", "key1", "key2", "key3")


@query(sql("SELECT run_id % 30 AS source, max(run_id) AS run_id FROM (SELECT run_id, arg_max(to_status, sequence) AS status, count(*) FILTER (size > 300) AS valid FROM run_events GROUP BY run_id) WHERE status IN ('completed', 'running') OR (status = 'paused' AND valid > 5) GROUP BY run_id % 30"))
def H03_latest_bundle(spark, sf_dir):
    """The newest eligible run of each source."""
    runs = inputs.run_events(spark, sf_dir).groupBy("run_id").agg(F.max_by("to_status", "sequence").alias("status"), F.count_if(F.col("size") > 300).alias("valid")).withColumn("source", F.col("run_id") % 30)
    return audit.latest_eligible(runs, "source", "run_id", F.col("status").isin("completed", "running") | ((F.col("status") == "paused") & (F.col("valid") > 5)))



@query(sql("SELECT run_id, arg_min(event_id, sequence) AS candidate FROM run_events WHERE size > 250 GROUP BY run_id"))
def H04_first_valid_candidate(spark, sf_dir):
    """The first valid candidate of each source in report order."""
    return audit.first_valid(inputs.run_events(spark, sf_dir), "run_id", "event_id", "sequence", F.col("size") > 250)



_MODE = "CASE collection % 4 WHEN 0 THEN 'subtitle_first' WHEN 1 THEN 'full_asr' WHEN 2 THEN 'enhancement' END"
_OWN = "CASE collection % 4 WHEN 0 THEN 'source' WHEN 1 THEN 'verbatim' ELSE 'enhanced' END"
_PLANNED = f"SELECT DISTINCT part_id // 10 AS collection, part_id, {_MODE.replace('collection', '(part_id // 10)')} AS mode FROM cues "
_TIMED = "min(text) FILTER (source_ordinal % 5 <> 3) AS original, CASE WHEN count(*) > 2 THEN max(text) END AS adopted, count(*) > 3 AS passed, count(*) < 3 AS partial, bool_or(source_ordinal % 7 = 6) AS invalid"
_EVIDENCE = f"""WITH k AS (SELECT *, part_id // 10 AS collection, CASE WHEN role = 'user' THEN {_OWN.replace('collection', '(part_id // 10)')} ELSE 'readable' END AS basis FROM cues ) SELECT collection, part_id::VARCHAR AS part, 'subtitles' AS kind, basis, {_TIMED} FROM k WHERE part_id % 5 <> 3 GROUP BY ALL
    UNION ALL SELECT collection, '', 'subtitles', basis, {_TIMED} FROM k GROUP BY ALL UNION ALL SELECT collection, '', 'transcript', basis, {_TIMED} FROM k GROUP BY ALL
    UNION ALL SELECT collection, '', 'content_report', '', min(role), NULL, NULL, false, NULL FROM k GROUP BY ALL UNION ALL SELECT collection, '', 'segments', '', CASE WHEN collection % 3 <> 0 THEN min(role) END, max(role), true, true, collection % 3 = 2 FROM k GROUP BY collection"""
_RULES = " UNION ALL ".join(
    [f"SELECT '{m}' AS mode, {str(of).lower()} AS of_part, 'subtitles' AS kind, '{b}' AS basis, 'subtitles.{b}.{x}' AS name, '{'part_relative' if of else 'collection_virtual'}' AS timing_view, true AS governed" for m, bs in publication.SUBTITLES.items() for b in bs for x in ("srt", "vtt") for of in (True, False)]
    + [f"SELECT '{m}', false, 'transcript', '{b}', 'transcript.{b}.{x}', 'collection_virtual', true" for m, b in publication.TRANSCRIPT.items() for x in ("md", "json")]
    + [f"SELECT '{m}', false, '{k}', '', '{n}', {chr(39) + 'collection_virtual' + chr(39) if k == 'segments' else 'NULL'}, false" for m in publication.SUBTITLES for k, n in publication.DOCUMENTS.items()])
_WANTED_FILES = """SELECT p.collection, p.part_id::VARCHAR AS part, 'parts/' || p.part_id || '/' || name AS path, kind, basis, timing_view, governed FROM planned p JOIN rules r ON r.mode = p.mode AND of_part
    UNION ALL SELECT DISTINCT p.collection, '', name, kind, basis, timing_view, governed FROM planned p JOIN rules r ON r.mode = p.mode AND NOT of_part"""


@query(sql("""SELECT collection, path, kind, CASE WHEN content IS NULL THEN 'unavailable' WHEN coalesce(invalid, false) THEN 'invalid' WHEN coalesce(partial, false) THEN 'partial' ELSE 'valid' END AS status, timing_view,
      CASE WHEN governed AND content IS NOT NULL THEN CASE WHEN takes THEN 'adopted_alignment' ELSE 'original' END END AS timing_basis, sha256(content) AS sha256, NULL AS reason FROM (
      SELECT *, governed AND adopted IS NOT NULL AND coalesce(passed, false) AS takes, CASE WHEN governed AND adopted IS NOT NULL AND coalesce(passed, false) THEN adopted ELSE original END AS content FROM wanted_files LEFT JOIN evidence USING (collection, part, kind, basis))
    UNION ALL SELECT DISTINCT collection, NULL, NULL, 'refused', NULL, NULL, NULL, 'missing_asr_mode' FROM planned WHERE mode IS NULL""", planned=_PLANNED, rules=_RULES, wanted_files=_WANTED_FILES, evidence=_EVIDENCE))
def I03_project_artifacts(spark, sf_dir):
    """Every artifact that the plans of collections ask for by mode, with its status and timing; nothing is made up."""
    cues = inputs.cues(spark, sf_dir).withColumn("collection", F.floor(F.col("part_id") / 10))
    parts = cues.select("collection", "part_id").distinct()
    plans = parts.select("collection").distinct().withColumn("mode", F.expr(_MODE))
    rows = cues.withColumn("basis", F.when(F.col("role") == "user", F.expr(_OWN)).otherwise("readable"))
    o, n = F.col("source_ordinal"), F.count(F.lit(1))
    timed = [F.min(F.when(o % 5 != 3, F.col("text"))).alias("original"), F.when(n > 2, F.max("text")).alias("adopted"), (n > 3).alias("gates_passed"), (n < 3).alias("partial"), F.bool_or(o % 7 == 6).alias("invalid")]
    of_part = rows.where("part_id % 5 <> 3").groupBy("collection", "part_id", "basis").agg(*timed).withColumn("kind", F.lit("subtitles"))
    whole = rows.groupBy("collection", "basis").agg(*timed).withColumn("part_id", F.lit(None).cast("long"))
    role = cues.groupBy("collection").agg(F.min("role").alias("low"), F.max("role").alias("high"))
    none, third = F.lit(None), F.col("collection") % 3
    document = lambda kind, *x: role.select("collection", none.cast("long").alias("part_id"), none.cast("string").alias("basis"), F.lit(kind).alias("kind"), *[c.alias(a) for c, a in zip(x, ("original", "adopted", "gates_passed", "partial", "invalid"))])
    reports = document("content_report", F.col("low"), none.cast("string"), none.cast("boolean"), F.lit(False), none.cast("boolean")).unionByName(document("segments", F.when(third != 0, F.col("low")), F.col("high"), F.lit(True), F.lit(True), third == 2))
    evidence = of_part.unionByName(whole.withColumn("kind", F.lit("subtitles"))).unionByName(whole.withColumn("kind", F.lit("transcript"))).unionByName(reports)
    return publication.project_artifacts(plans, parts, evidence)


@query(sql(f"SELECT run_id, arg_max(to_status, sequence) AS status, max(sequence) + 1 AS next_sequence, count(*) FILTER (NOT legal) AS illegal, 0 AS repeated, string_agg(sequence::VARCHAR, ',' ORDER BY sequence) FILTER (NOT legal) AS told FROM (SELECT *, coalesce({_LEGAL}, false) AS legal FROM (SELECT *, lag(to_status) OVER (PARTITION BY run_id ORDER BY sequence) AS from_status FROM run_events )) GROUP BY run_id"))
def ST01_journal_stream(spark, sf_dir):
    """The journal followed as a stream of several batches, whose files mix each run's events, to its last states and every illegal step."""
    events, states, marks = work_folder(spark), work_folder(spark), work_folder(spark)
    rows = inputs.run_events(spark, sf_dir).select("run_id", "sequence", "to_status")
    rows.repartitionByRange(6, F.xxhash64("run_id", "sequence")).write.json(events)  # six files, three batches
    journal.followed(journal.read_journal(spark, events, 2), states, marks)
    found = spark.read.parquet(states)
    last = F.max_by(F.struct("to_status", "next_sequence", "illegal", "repeated"), F.when(F.col("kind") == "status", F.col("batch"))).alias("s")
    told = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("kind") == "illegal", F.col("sequence")))), lambda x: x.cast("string")), ",")
    states_ = found.groupBy("run_id").agg(last, told.alias("told"))
    return states_.select("run_id", F.col("s.to_status").alias("status"), "s.next_sequence", "s.illegal", "s.repeated", F.when(F.col("told") != "", F.col("told")).alias("told"))
