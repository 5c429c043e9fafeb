"""Order-dependent folds: each row of a key is judged against what the fold has kept of the rows before it.

A fold reads its key's rows as a sorted stream and keeps a few values (or, for chapters, the accepted spans), so a key of
any length takes time in proportion to its rows and no more memory than what is kept.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Step = Callable[..., object]


def folded(rows: DataFrame, key: str, order: list[str], inputs: list[str], result: str, kind: str, start: Callable[[], Step]) -> DataFrame:
    """rows with a column `result` (kind: string or long): what the key's step, made by start(), says of the inputs of each row in order."""
    types = {"string": pa.string(), "long": pa.int64()}
    at = [rows.columns.index(c) for c in (key, *inputs)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, step, known = None, None, False
        for batch in batches:
            out = []
            for k, *values in zip(*(batch.column(i).to_pylist() for i in at)):
                if not known or k != current:
                    current, step, known = k, start(), True
                out.append(step(*values))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, types[kind])], [*batch.schema.names, result])

    dealt = rows.repartition(key).sortWithinPartitions(key, *order)
    return dealt.mapInArrow(run, rows.schema.add(result, kind))


def gate_cues(cues: DataFrame, lowest: int = 20, highest: int = 400) -> DataFrame:
    """(part_id, ordinal, reason), reason of refusal (null: admitted), of cues (part_id, pos, ordinal, start_t, end_t, visible, c_start, c_end) in order of pos.

    Each is compared with the last admitted one; a refused cue does not affect later ones. In order of precedence:
    out_of_coverage, non_monotonic, processing_duplication, missing_text, duration_implausible (ticks a character).
    """
    return gated(cues, lowest, highest).select("part_id", "ordinal", "reason")


def gated(cues: DataFrame, lowest: int, highest: int) -> DataFrame:
    """cues with all their columns and reason, as gate_cues has it."""
    def start() -> Step:
        last = None

        def step(ordinal: int, begin: int, end: int, visible: int, low: int, high: int) -> str | None:
            nonlocal last
            if begin < low or end > high:
                return "out_of_coverage"
            if last and (ordinal <= last[0] or begin < last[1]):
                return "non_monotonic"
            if last and begin < last[2]:
                return "processing_duplication"
            if visible == 0:
                return "missing_text"
            if not lowest * visible <= end - begin <= highest * visible:
                return "duration_implausible"
            last = ordinal, begin, end
            return None

        return step

    return folded(cues, "part_id", ["pos"], ["ordinal", "start_t", "end_t", "visible", "c_start", "c_end"], "reason", "string", start)


def gate_on_timeline(cues: DataFrame, parts: DataFrame, lowest: int = 20, highest: int = 400) -> DataFrame:
    """gate_cues with every coordinate: (part_id, pos, ordinal, reason, raw_start, raw_end, part_start, part_end, collection_start, collection_end).

    parts: collection, part_id, part_pos, start_t, end_t (coverage in raw time), one row a part. A part's time starts
    with its coverage, and its collection's where the parts before it end. A boundary before the coverage or beyond it
    has no place in the part's time, nor in the collection's, and refuses its cue (out_of_coverage), as does a part that
    is not in the timeline; order and overlap are judged in collection time. Refused cues keep their raw times alone.
    """
    before = Window.partitionBy("collection").orderBy("part_pos").rowsBetween(Window.unboundedPreceding, -1)
    length = F.col("end_t") - F.col("start_t")
    placed = parts.select("part_id", F.col("start_t").alias("c_start"), F.col("end_t").alias("c_end"), F.coalesce(F.sum(length).over(before), F.lit(0).cast("long")).alias("offset"))
    rows = cues.drop("c_start", "c_end").join(placed, "part_id", "left")
    known = F.col("offset").isNotNull()
    shifted = rows.withColumns({"raw_start": F.col("start_t"), "raw_end": F.col("end_t"), "part_start": F.col("start_t") - F.col("c_start"), "part_end": F.col("end_t") - F.col("c_start")})
    moved = shifted.withColumns({"start_t": F.when(known, F.col("part_start") + F.col("offset")).otherwise(0), "end_t": F.when(known, F.col("part_end") + F.col("offset")).otherwise(0),
                                 "c_end": F.when(known, F.col("c_end") - F.col("c_start") + F.col("offset")).otherwise(0), "c_start": F.when(known, F.col("offset")).otherwise(1)})
    judged = gated(moved, lowest, highest)
    admitted = lambda c, name: F.when(F.col("reason").isNull(), F.col(c)).alias(name)
    return judged.select("part_id", "pos", "ordinal", "reason", "raw_start", "raw_end", admitted("part_start", "part_start"), admitted("part_end", "part_end"), admitted("start_t", "collection_start"), admitted("end_t", "collection_end"))


def pack_chunks(runs: DataFrame, window: int) -> DataFrame:
    """(part_id, chunk, start_t, end_t, runs, error): speech runs (part_id, start_t, end_t) packed from left to right into chunks of at most `window` ticks.

    Touching runs are one. Runs that overlap (chunk_speech_runs_invalid), else one longer than the window
    (chunk_window_exceeded), refuse the part with one error row.
    """
    order = Window.partitionBy("part_id").orderBy("start_t", "end_t")
    reached = F.max("end_t").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.select("part_id", "start_t", "end_t", (F.col("start_t") < reached).alias("over"), F.coalesce(F.col("start_t") > reached, F.lit(True)).cast("int").alias("new"))
    islands = marked.withColumn("island", F.sum("new").over(order)).groupBy("part_id", "island").agg(F.min("start_t").alias("start_t"), F.max("end_t").alias("end_t"), F.bool_or(F.coalesce("over", F.lit(False))).alias("over"))
    every = Window.partitionBy("part_id")
    error = F.when(F.bool_or("over").over(every), "chunk_speech_runs_invalid").when(F.max(F.col("end_t") - F.col("start_t")).over(every) > window, "chunk_window_exceeded")
    judged = islands.withColumn("error", error).drop("island", "over")

    def start() -> Step:
        first, number = None, -1

        def step(begin: int, end: int, error: str | None) -> int:
            nonlocal first, number
            if error is not None:
                return 0
            if first is None or end - first > window:
                first, number = begin, number + 1
            return number

        return step

    packed = folded(judged, "part_id", ["start_t"], ["start_t", "end_t", "error"], "chunk", "long", start)
    good = lambda c: F.when(F.col("error").isNull(), c)
    return packed.groupBy("part_id", "chunk", "error").agg(good(F.min("start_t")).alias("start_t"), good(F.max("end_t")).alias("end_t"), good(F.count(F.lit(1))).alias("runs")).select("part_id", "chunk", "start_t", "end_t", "runs", "error")


def first_wins(chapters: DataFrame) -> DataFrame:
    """(part_id, pos, start_ordinal, end_ordinal, reason, number) of chapters (part_id, pos, own_part, start_ordinal, end_ordinal, last) in given order.

    One that overlaps an accepted one goes; accepted ones never overlap, so they are kept sorted and only the nearest is
    looked at. number: place of an accepted chapter by its start.
    """

    def start() -> Step:
        starts: list[int] = []
        ends: list[int] = []

        def step(own_part: bool, first: int, final: int, last: int) -> str | None:
            if not own_part:
                return "foreign_part"
            if first > final:
                return "inverted"
            if first < 0 or final > last:
                return "unknown_ordinal"
            k = bisect_left(ends, first)
            if k < len(starts) and starts[k] <= final:
                return "overlap"
            starts.insert(k, first)
            ends.insert(k, final)
            return None

        return step

    judged = folded(chapters, "part_id", ["pos"], ["own_part", "start_ordinal", "end_ordinal", "last"], "reason", "string", start)
    place = F.row_number().over(Window.partitionBy("part_id", F.col("reason").isNull()).orderBy("start_ordinal")) - 1
    return judged.select("part_id", "pos", "start_ordinal", "end_ordinal", "reason", F.when(F.col("reason").isNull(), place).cast("long").alias("number"))
