"""Model tables derived from the driver's tables, each once as a DataFrame and once as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Microseconds since 1970 of a timestamp without a zone, whatever the session's zone.
MICROS = "(unix_date(cast(ts as date)) * 86400000000L + (hour(ts) * 3600L + minute(ts) * 60L) * 1000000L + cast(extract(second from ts) * 1000000 as bigint))"
HOURS_6 = 6 * 3600 * 1_000_000
STATES = "CASE WHEN event_type IN ('click', 'view') THEN 'speech_likely' WHEN event_type IN ('purchase', 'signup') THEN 'non_speech' END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed cues of conversations: 60 ms a character, some overlapping their predecessor."""
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    text = F.coalesce("text", F.lit(""))
    start = F.coalesce(F.sum(60 * F.length(text)).over(before), F.lit(0)) - F.when(F.col("turn") % 3 == 1, 200).otherwise(0)
    return (table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("part_id"), F.col("turn").alias("source_ordinal"), "role", text.alias("text"), start.cast("long").alias("start_t"))
            .withColumn("end_t", F.col("start_t") + 60 * F.length("text")))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("start_t", F.expr(MICROS)).withColumn("end_t", F.expr("start_t + cast(round(value * 100) as bigint) * 3600000L"))


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select((F.col("user_id") % 50).alias("part_id"), F.col("user_id").alias("stream_index"), "start_t", "end_t", "event_id")


def vad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disjoint speech and silence intervals of each user; what is neither is absent."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = _events(spark, sf_dir).withColumn("end_t", F.least("end_t", F.coalesce(F.lead("start_t").over(order), F.col("end_t"))))
    return rows.select(F.col("user_id").alias("part_id"), "start_t", "end_t", F.expr(STATES).alias("state")).where("state is not null and start_t < end_t")


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cue of every event: a third of its length, from a quarter of it on."""
    rows = _events(spark, sf_dir).withColumn("c", F.expr("start_t + (end_t - start_t) div 4"))
    return rows.select(F.col("user_id").alias("part_id"), F.col("c").alias("start_t"), F.expr("c + (end_t - start_t) div 3").alias("end_t"), F.col("event_id").alias("cue_id"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rn = F.row_number().over(order)
    k = F.get_json_object("props", "$.k").cast("int")
    return _events(spark, sf_dir).select(
        F.col("user_id").alias("part_id"), F.col("start_t").alias("pts"), rn.alias("place"), F.concat(F.lit("p"), (F.floor((rn - 1) / 4) % 5).cast("string")).alias("fingerprint"),
        (100 - k % 50).alias("stability"), (F.floor("value").cast("int") % 101).alias("edge_density"), (F.col("event_id") * 37 % 60).cast("int").alias("region_diff"))


def ocr_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 150).alias("part_id"), "text", (F.col("doc_id") % 100).alias("confidence"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was recorded: a path and digest per document, some hundred documents a run."""
    return table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 200).alias("run_id"), F.col("doc_id").alias("path"), F.sha2("text", 256).alias("sha256"))


def present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is there: some altered, some dropped, some added."""
    m = manifest(spark, sf_dir)
    kept = m.where("path % 17 <> 0").withColumn("sha256", F.when(F.col("path") % 13 == 0, F.concat(F.lit("x"), "sha256")).otherwise(F.col("sha256")))
    return kept.unionByName(m.where("path % 19 = 0").withColumn("path", F.col("path") + 1_000_000_000))


RUN_STATES = ["created", "running", "paused", "completed", "failed"]
STATE_OF = "CASE event_type WHEN 'signup' THEN 'created' WHEN 'click' THEN 'running' WHEN 'view' THEN 'paused' WHEN 'purchase' THEN 'completed' ELSE 'failed' END"


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return _events(spark, sf_dir).select(F.col("user_id").alias("run_id"), F.row_number().over(order).alias("sequence"), F.expr(STATE_OF).alias("to_status"), F.col("start_t").alias("at"), F.col("value").alias("size"), "event_id")


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("capability"), (F.col("l_quantity") * 1000).cast("long").alias("peak"), F.col("l_partkey").alias("source"), F.col("l_orderkey").alias("run_id"),
        F.col("l_linenumber").alias("seq"), F.when(F.col("l_discount") > 0.05, "high").otherwise("low").alias("confidence"))


_EVENTS = "SELECT *, epoch_us(ts) AS start_t, epoch_us(ts) + round(value * 100)::BIGINT * 3600000 AS end_t FROM events"
SQL: dict[str, str] = {
    "cues": """SELECT conv_id AS part_id, turn AS source_ordinal, role, coalesce(text, '') AS text,
        (coalesce(sum(60 * length(coalesce(text, ''))) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - CASE WHEN turn % 3 = 1 THEN 200 ELSE 0 END)::BIGINT AS start_t,
        (coalesce(sum(60 * length(coalesce(text, ''))) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - CASE WHEN turn % 3 = 1 THEN 200 ELSE 0 END)::BIGINT + 60 * length(coalesce(text, '')) AS end_t FROM conversations""",
    "ev": _EVENTS,
    "packets": "SELECT user_id % 50 AS part_id, user_id AS stream_index, start_t, end_t, event_id FROM ev",
    "vad": f"""SELECT * FROM (SELECT user_id AS part_id, start_t, least(end_t, coalesce(lead(start_t) OVER (PARTITION BY user_id ORDER BY ts, event_id), end_t)) AS end_t, {STATES} AS state FROM ev)
        WHERE state IS NOT NULL AND start_t < end_t""",
    "captions": "SELECT user_id AS part_id, c AS start_t, c + d // 3 AS end_t, event_id AS cue_id FROM (SELECT user_id, event_id, end_t - start_t AS d, start_t + (end_t - start_t) // 4 AS c FROM ev )",
    "frames": """SELECT user_id AS part_id, start_t AS pts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place,
        'p' || (((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 4) % 5)::VARCHAR AS fingerprint, 100 - (json_extract(props, '$.k')::INT) % 50 AS stability,
        floor(value)::INT % 101 AS edge_density, (event_id * 37 % 60)::INT AS region_diff FROM ev""",
    "ocr_items": "SELECT doc_id, doc_id % 150 AS part_id, text, doc_id % 100 AS confidence FROM documents",
    "manifest": "SELECT doc_id // 200 AS run_id, doc_id AS path, sha256(text) AS sha256 FROM documents",
    "present": """SELECT run_id, path, CASE WHEN path % 13 = 0 THEN 'x' || sha256 ELSE sha256 END AS sha256 FROM manifest WHERE path % 17 <> 0
        UNION ALL SELECT run_id, path + 1000000000, sha256 FROM manifest WHERE path % 19 = 0""",
    "run_events": f"""SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sequence, {STATE_OF} AS to_status, start_t AS "at", value AS size, event_id FROM ev""",
    "measurements": """SELECT l_returnflag || l_linestatus AS capability, (l_quantity * 1000)::BIGINT AS peak, l_partkey AS source, l_orderkey AS run_id, l_linenumber AS seq,
        CASE WHEN l_discount > 0.05 THEN 'high' ELSE 'low' END AS confidence FROM lineitem""",
}


def sql(body: str, **more: str) -> str:
    """body with the inputs that it and `more` name as common table expressions, in order."""
    parts = {**SQL, **more}
    text = body + " ".join(more.values())
    wanted: set[str] = set()
    while True:
        found = {n for n in parts if n not in wanted and any(t in text for t in (f" {n} ", f" {n}\n", f" {n})", f" {n},", f" {n};")) or text.endswith(f" {n}")}
        if not found:
            break
        wanted |= found
        text += " ".join(f" {parts[n]} " for n in found)
    return "WITH " + ", ".join(f"{n} AS ({parts[n]})" for n in parts if n in wanted) + " " + body
