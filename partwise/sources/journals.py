"""Run journals from bytes: lines with their places, events told from torn and foreign ones, and what a repair keeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partwise.sources.envelopes import _field, _is_object, _text, _whole

#: The schema of events and their kinds.
SCHEMA_VERSION = 1
KINDS = ("transition", "control_request_observed", "decision_pause", "recovery", "publication_verification_failed")


def journal_lines(payloads: DataFrame, *keys: str) -> DataFrame:
    """(keys, line, offset, bytes, ended, body, event): every line of raw journals (keys, content) from 1 on.

    A line ends with a line feed; what follows the last one is a line that has not ended, unless it is empty. offset and
    bytes are its place in the file without the line feed; body is null where it is no UTF-8. event is the line as
    VARIANT if it is one: an object of the schema version with a known kind and a whole sequence. A null or empty
    content has no lines. A journal is one row of content, as readers of whole files give it.
    """
    chars = F.decode("content", "ISO-8859-1")  # a character for each byte, so that places are those of the file
    pieces = F.split(chars, "\n", -1)
    rows = payloads.select(*keys, F.size(pieces).alias("_n"), F.posexplode(pieces).alias("_at", "_c"))
    rows = rows.where((F.col("_at") < F.col("_n") - 1) | (F.col("_c") != ""))
    order = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("_c").cast("long")
    raw = F.encode("_c", "ISO-8859-1")
    placed = rows.select(*keys, (F.col("_at") + 1).cast("long").alias("line"), F.coalesce(F.sum(size + 1).over(order), F.lit(0).cast("long")).alias("offset"), size.alias("bytes"), (F.col("_at") < F.col("_n") - 1).alias("ended"), F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string")).alias("body"))
    parsed = placed.withColumn("_v", F.try_parse_json("body"))
    return parsed.withColumn("event", F.when(_is_event(F.col("_v")), F.col("_v"))).drop("_v")


def _is_event(value: Column) -> Column:
    rule = _is_object(value) & (_whole(_field(value, "schema_version")) == SCHEMA_VERSION) & _text(_field(value, "kind")).isin(*KINDS) & _whole(_field(value, "sequence")).isNotNull()
    return F.coalesce(rule, F.lit(False))


def kept_lines(lines: DataFrame, *keys: str) -> DataFrame:
    """The lines of journal_lines with kept: whether a line and all before it have ended and are events."""
    order = Window.partitionBy(*keys).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("kept", F.min((F.col("ended") & F.col("event").isNotNull()).cast("int")).over(order) == 1)


def repairs(kept: DataFrame, *keys: str) -> DataFrame:
    """(keys, lines, kept, dropped, size): of each journal of kept_lines how many lines a repair keeps and drops, and the size in bytes that it cuts the file to."""
    stays = F.col("kept")
    return kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("lines"), F.count_if(stays).alias("kept"), F.count_if(~stays).alias("dropped"), F.coalesce(F.max(F.when(stays, F.col("offset") + F.col("bytes") + 1)), F.lit(0).cast("long")).alias("size"))


def transitions(kept: DataFrame, *keys: str) -> DataFrame:
    """(keys, line, sequence, from_status, to_status) of the transitions among kept lines, as audit.replay takes them; a from that is null or absent is null."""
    rows = kept.where("kept").where(_text(_field(F.col("event"), "kind")) == "transition")
    e = F.col("event")
    return rows.select(*keys, "line", _whole(_field(e, "sequence")).alias("sequence"), _text(_field(e, "from")).alias("from_status"), _text(_field(e, "to")).alias("to_status"))
