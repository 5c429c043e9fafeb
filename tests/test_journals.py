"""Journals as bytes in real files, the repair of torn tails, and the journal as a stream that is stopped and goes on."""

import json

import pandas as pd
import pytest
from partwise.operators import audit
from partwise.sources import envelopes, journals
from partwise.sources.subtitles import read_payloads
from partwise.streaming import journal
from pyspark.sql import functions as F


def event(n, **more):
    return json.dumps({"schema_version": 1, "kind": "transition", "sequence": n, "from": None, "to": "created"} | more)


def plain_repair(raw: bytes):
    """Kept and dropped lines and the kept size, by a plain walk over the bytes."""
    def good(line):
        try:
            e = json.loads(line.decode())
        except ValueError:
            return False
        return isinstance(e, dict) and type(e.get("schema_version")) is int and e["schema_version"] == 1 and e.get("kind") in journals.KINDS and type(e.get("sequence")) is int

    lines = raw.split(b"\n")
    open_end = lines.pop()
    kept = next((i for i, line in enumerate(lines) if not good(line)), len(lines))
    return kept, len(lines) + bool(open_end) - kept, sum(len(x) + 1 for x in lines[:kept])


def test_repair_of_real_files(spark, tmp_path):
    a, b, c = event(1), event(2, note="é  end"), event(3, kind="recovery")
    files = {
        "clean": f"{a}\n{b}\n{c}\n", "cut": f"{a}\n{b}\n{c[:20]}", "open": f"{a}\n{b}", "garbage": f"{a}\n{{nonsense\n{c}\n", "blank": f"{a}\n\n{c}\n", "windows": f"{a}\r\n{b}\n", "list": f"{a}\n[1]\n", "kind": f"{a}\n{event(2, kind='other')}\n",
        "version": f"{event(1, schema_version=2)}\n{b}\n", "text_version": f"{event(1, schema_version='1')}\n", "bool": f"{a}\n{event(True)}\n", "float": f"{a}\n{event(2.5)}\n", "missing": f'{a}\n{{"schema_version":1,"kind":"transition"}}\n', "none": f"{a[:10]}",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.jsonl").write_bytes(text.encode())
    (tmp_path / "bytes.jsonl").write_bytes(f"{a}\n".encode() + b"\xff\xfe\n" + f"{c}\n".encode())
    (tmp_path / "empty.jsonl").write_bytes(b"")
    found = journals.kept_lines(journals.journal_lines(read_payloads(spark, str(tmp_path), "*.jsonl"), "path"), "path")
    told = {r.path.rsplit("/", 1)[1][:-6]: (r.kept, r.dropped, r.size) for r in journals.repairs(found, "path").collect()}
    want = {p.stem: plain_repair(p.read_bytes()) for p in tmp_path.iterdir()}
    assert want.pop("empty") == (0, 0, 0) and told == want
    for r in found.collect():
        raw = (tmp_path / r.path.rsplit("/", 1)[1]).read_bytes()
        assert raw[r.offset : r.offset + r.bytes].decode("utf-8", "ignore") == (r.body if r.body is not None else raw[r.offset : r.offset + r.bytes].decode("utf-8", "ignore")) and r.ended == (raw[r.offset + r.bytes : r.offset + r.bytes + 1] == b"\n")
    steps = journals.transitions(found, "path").where("path like '%clean%'").orderBy("line").collect()
    assert [(r.sequence, r.from_status, r.to_status) for r in steps] == [(1, None, "created"), (2, None, "created")]


def write(path, n, rows):
    path.mkdir(exist_ok=True)
    (path / f"{n}.json").write_text("".join(json.dumps({"run_id": r, "sequence": s, "to_status": t}) + "\n" for r, s, t in rows))


STEPS = ["created", "running", "paused", "running", "completed", "running", "failed"]


def test_a_stopped_stream_goes_on_and_equals_the_batch_replay(spark, tmp_path):
    events, out, marks = tmp_path / "events", str(tmp_path / "out"), str(tmp_path / "marks")
    rows = [(run, i + 1, t) for run in range(1, 8) for i, t in enumerate(STEPS[: run % 7 + 1])]
    write(events, 1, rows[1::3] + rows[:1])
    write(events, 2, rows[2::3] + rows[1:3])
    write(events, 3, rows[0::3])
    stream = journal.read_journal(spark, str(events), 1)

    def breaks(df, batch):
        df.limit(2).write.mode("overwrite").parquet(f"{out}/batch={batch}")
        if batch == 1:
            raise RuntimeError("stopped in the middle of a batch")

    with journal.state_store(spark, timers_alone=False):
        query = journal.journal_states(stream).writeStream.outputMode("append").foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}") if i == 0 else breaks(df, i)).option("checkpointLocation", marks).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="stopped in the middle"):
        query.awaitTermination()
    journal.followed(stream, out, marks)
    found = spark.read.parquet(out)
    assert found.select("batch").distinct().count() == 3
    states = {r.run_id: tuple(r.s) for r in found.where("kind = 'status'").groupBy("run_id").agg(F.max_by(F.struct("to_status", "next_sequence", "illegal"), "batch").alias("s")).collect()}
    lines = [(r, s, s, STEPS[s - 2] if s > 1 else None, t) for r, s, t in rows]
    replay = audit.replay(spark.createDataFrame(lines, "run_id long, line long, sequence long, from_status string, to_status string"), journal.EDGES)
    assert states == {r.run_id: (r.status, r.next_sequence, r.illegal) for r in replay.collect()}
    illegal = sorted((r.run_id, r.sequence, r.from_status, r.to_status) for r in found.where("kind = 'illegal'").collect())
    assert illegal == sorted((r, s, STEPS[s - 2] if s > 1 else None, t) for r, s, t in rows if t not in journal.EDGES.get(STEPS[s - 2] if s > 1 else None, set()))
    assert found.where("kind = 'status'").groupBy("run_id").agg(F.max("repeated").alias("n")).agg(F.sum("n")).first()[0] == 3
    before = found.count()
    journal.followed(stream, out, marks)
    assert spark.read.parquet(out).count() == before


class Fake:
    """A handle with states and timers in memory."""

    def __init__(self):
        self.timers, self.states = set(), {}

    def getValueState(self, name, schema):  # noqa: N802
        return self._state(name)

    getListState = getValueState  # noqa: N815

    def _state(self, name):
        outer = self

        class State:
            def exists(self):
                return name in outer.states

            def get(self):
                return outer.states[name]

            def update(self, value):
                outer.states[name] = value

            put = update

            def clear(self):
                outer.states.pop(name, None)

        return State()

    def listTimers(self):  # noqa: N802
        return list(self.timers)

    def deleteTimer(self, t):  # noqa: N802
        self.timers.discard(t)

    def registerTimer(self, t):  # noqa: N802
        self.timers.add(t)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return self.ms


def test_an_idle_run_takes_what_waits_and_tells_the_hole():
    handle, follower = Fake(), journal.Follower(500)
    follower.init(handle)

    def told(frames):
        return [tuple(None if pd.isna(v) else v for v in row) for f in frames for row in f.itertuples(index=False)]

    first = told(follower.handleInputRows((7,), iter([pd.DataFrame([(3, "paused"), (1, "created"), (3, "paused")], columns=["sequence", "to_status"])]), At(100)))
    assert first == [(7, "status", None, None, "created", 2, 0, 1)] and handle.states["early"] == [(3, "paused")] and handle.timers == {600}
    second = told(follower.handleInputRows((7,), iter([pd.DataFrame([(5, "failed")], columns=["sequence", "to_status"])]), At(300)))
    assert second == [(7, "status", None, None, "created", 2, 0, 1)] and handle.timers == {800}
    idle = told(follower.handleExpiredTimer((7,), At(900), None))
    assert idle == [(7, "hole", 3, "created", "paused", 4, 1, 1), (7, "hole", 5, "paused", "failed", 6, 2, 1), (7, "status", None, None, "failed", 6, 2, 1), (7, "idle", None, None, "failed", 6, 2, 1)]
    assert "early" not in handle.states


def test_envelopes_tell_types_apart(spark):
    cue = {"ordinal": 0, "start": {"numerator": 1, "denominator": 3}, "end": {"numerator": 1, "denominator": 2}, "text": "one two", "tokens": [{"text": "one", "confidence": 1}, {"text": "two"}], "language_spans": [{"language": "en", "start_token": 0, "end_token": 2}], "more": [None]}
    head = {"schema_version": 1, "projection_schema_version": "p", "adapter_identity": "a", "capability": "asr"}
    cases = {
        1: (head | {"result": {"cues": [cue]}}, None), 2: (head | {"result": {"cues": []}}, None), 3: (head | {"result": {"cues": [cue, cue | {"text": None}]}}, "cue_text"), 4: (head | {"result": {"cues": None}}, "cues_not_a_list"),
        5: (head | {"schema_version": 1.0, "result": {"cues": []}}, "schema_version"), 6: (head | {"schema_version": None, "result": {"cues": []}}, "schema_version"), 7: (head | {"result": []}, "result"), 8: (head | {"capability": ["asr"], "result": {"cues": []}}, "capability"),
        9: (head | {"result": {"cues": [cue | {"end": cue["start"]}]}}, "cue_interval"), 10: (head | {"result": {"cues": [cue | {"start": {"numerator": 1, "denominator": 2}, "end": {"numerator": 2, "denominator": 4}}]}}, "cue_interval"),
        11: (head | {"result": {"cues": [cue | {"start": None}]}}, "time_not_an_object"), 12: (head | {"result": {"cues": [cue | {"tokens": [{"text": "a", "confidence": False}]}]}}, "token_confidence"), 13: (head | {"result": {"cues": [cue | {"language_spans": [{"language": "en", "start_token": 0, "end_token": 3}]}]}}, "span_beyond"),
    }
    rows = [(k, json.dumps(v)) for k, (v, _) in cases.items()] + [(20, None), (21, ""), (22, "```json\n" + json.dumps(cases[1][0]) + "\n```\n"), (23, "null"), (24, '"text"')]
    found = {r.k: r for r in envelopes.read_strict(spark.createDataFrame(rows, "k int, json string"), "k", kind="asr", projection="p", adapter="a", capabilities=("asr",)).collect()}
    assert {k: found[k].detail for k in cases} == {k: d for k, (_, d) in cases.items()}
    assert (found[20].detail, found[21].detail, found[22].detail, found[23].detail, found[24].detail) == ("not_json", "not_json", None, "not_an_object", "not_an_object")
    item = found[1]["items"][0]
    assert (item.start.numerator, item.start.denominator, [tuple(t) for t in item.tokens], [tuple(s) for s in item.language_spans]) == (1, 3, [("one", 1.0), ("two", None)], [("en", 0, 2)])
    assert found[3]["items"] is None and found[3].state == "model_output_invalid" and found[1].capability == "asr"
