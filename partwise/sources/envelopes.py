"""Model output envelopes read strictly: a value of a wrong JSON type, an absent one and null are three things.

An envelope is parsed as VARIANT, and each rule asks for the type that the JSON has; no value is cast into shape. The
first rule that is broken, in the order of the document, refuses the whole envelope and is told.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TIME = "struct<numerator:bigint,denominator:bigint>"
_ITEMS = {
    "asr": f"array<struct<ordinal:bigint,start:{_TIME},end:{_TIME},text:string,tokens:array<struct<text:string,confidence:double>>,language_spans:array<struct<language:string,start_token:bigint,end_token:bigint>>>>",
    "ocr": f"array<struct<part_id:string,visual_page_id:string,pts:{_TIME},text:string,confidence:double,language_spans:array<struct<language:string,start_char:bigint,end_char:bigint>>>>",
}
_LIST = {"asr": "cues", "ocr": "items"}
#: Fields that a projection schema asks for.
REQUIRED = {"cue": ("ordinal", "start", "end", "text"), "token": ("text",), "item": ("part_id", "visual_page_id", "pts", "text", "confidence"), "token_span": ("language", "start_token", "end_token"), "char_span": ("language", "start_char", "end_char")}


def _field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def _of(value: Column, kinds: str, kind: str) -> Column:
    """The value, null unless its JSON type is one of a pattern of kinds."""
    return F.when(F.schema_of_variant(value).rlike(f"^(?:{kinds})"), F.try_variant_get(value, "$", kind))


def _text(value: Column) -> Column:
    return _of(value, "STRING$", "string")


def _whole(value: Column) -> Column:
    """A whole number of 64 bits; neither true nor 1.0 is one."""
    return _of(value, "BIGINT$", "bigint")


def _real(value: Column) -> Column:
    return _of(value, "BIGINT|DECIMAL|DOUBLE|FLOAT", "double")


def _list(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def _given(value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value)


def _unless(rule: Column, code: str) -> Column:
    """The code where a rule does not hold, or cannot be told."""
    return F.when(~F.coalesce(rule, F.lit(False)), F.lit(code))


def _first_of(values: Column, fault: Callable[[Column], Column]) -> Column:
    """The fault of the first value that has one."""
    return F.get(F.filter(F.transform(values, fault), lambda f: f.isNotNull()), F.lit(0))


def _fields(value: Column, kind: str, code: str) -> Column:
    there = F.lit(True)
    for name in REQUIRED[kind]:
        there = there & _field(value, name).isNotNull()
    return _unless(there, code)


def _time(value: Column, code: str) -> Column:
    numerator, denominator = _whole(_field(value, "numerator")), _whole(_field(value, "denominator"))
    return F.coalesce(_unless(_is_object(value), f"{code}_not_an_object"), _unless(numerator.isNotNull() & denominator.isNotNull(), f"{code}_not_whole"), _unless(denominator > 0, f"{code}_denominator"))


def _before(start: Column, end: Column) -> Column:
    wide = lambda v, name: _whole(_field(v, name)).cast("decimal(19,0)")
    return wide(start, "numerator") * wide(end, "denominator") < wide(end, "numerator") * wide(start, "denominator")


def _token(value: Column) -> Column:
    confidence = _field(value, "confidence")
    return F.coalesce(_unless(_is_object(value), "token_not_an_object"), _fields(value, "token", "token_field_missing"), _unless(_text(_field(value, "text")).isNotNull(), "token_text"),
                      F.when(_given(confidence), _unless(_real(confidence).between(0, 1), "token_confidence")))


def _span(value: Column, kind: str, unit: str, most: Column) -> Column:
    start, end = _whole(_field(value, f"start_{unit}")), _whole(_field(value, f"end_{unit}"))
    return F.coalesce(_unless(_is_object(value), "span_not_an_object"), _fields(value, kind, "span_field_missing"), _unless(F.length(_text(_field(value, "language"))) > 0, "span_language"),
                      _unless((start >= 0) & (end >= 0), "span_index"), _unless(start < end, "span_empty"), _unless(end <= most, "span_beyond"))


def _lists(value: Column, name: str, code: str, fault: Callable[[Column], Column]) -> Column:
    """Fault of a list that may be absent or null."""
    found = _field(value, name)
    return F.when(_given(found), F.coalesce(_unless(_list(found).isNotNull(), code), _first_of(_list(found), fault)))


def _cue(value: Column) -> Column:
    tokens = F.coalesce(F.size(_list(_field(value, "tokens"))), F.lit(0))
    return F.coalesce(
        _unless(_is_object(value), "cue_not_an_object"), _fields(value, "cue", "cue_field_missing"), _unless(_whole(_field(value, "ordinal")) >= 0, "cue_ordinal"), _time(_field(value, "start"), "time"), _time(_field(value, "end"), "time"),
        _unless(_before(_field(value, "start"), _field(value, "end")), "cue_interval"), _unless(_text(_field(value, "text")).isNotNull(), "cue_text"),
        _lists(value, "tokens", "tokens_not_a_list", _token), _lists(value, "language_spans", "spans_not_a_list", lambda s: _span(s, "token_span", "token", tokens)))


def _item(value: Column) -> Column:
    named = lambda n: F.length(_text(_field(value, n))) > 0
    return F.coalesce(
        _unless(_is_object(value), "item_not_an_object"), _fields(value, "item", "item_field_missing"), _unless(named("part_id"), "item_part"), _unless(named("visual_page_id"), "item_page"), _time(_field(value, "pts"), "time"),
        _unless(_text(_field(value, "text")).isNotNull(), "item_text"), _unless(_real(_field(value, "confidence")).between(0, 1), "item_confidence"),
        _lists(value, "language_spans", "spans_not_a_list", lambda s: _span(s, "char_span", "char", F.length(_text(_field(value, "text"))))))


def read_strict(outputs: DataFrame, *keys: str, kind: str, projection: str, adapter: str, capabilities: tuple[str, ...], schema_version: int = 1) -> DataFrame:
    """(keys, state, detail, capability, items) of model outputs (keys, json) of one kind: asr (cues with tokens) or ocr (items).

    state is projected, or model_output_invalid with the first broken rule as detail and no items; a Markdown fence
    around the JSON goes. An envelope names its schema_version, the projection_schema_version and adapter_identity asked
    for and a known capability; result holds the list. Times are whole numerators over denominators above zero,
    intervals have a length, confidences lie within 0 and 1 (a token's may be null or absent), language spans are
    ranges of tokens of their cue, or of characters of their item's text. A null document is not_json.
    """
    body = F.regexp_replace("json", r"\A\s*```(?:json)?[ \t]*\n?|\n?\s*```\s*\z", "")
    rows = outputs.select(*keys, body.alias("_body"), F.try_parse_json(body).alias("_v"))
    v, name = F.col("_v"), _LIST[kind]
    items, capability = _field(_field(v, "result"), name), _text(_field(v, "capability"))
    detail = F.coalesce(
        _unless(v.isNotNull(), "not_json"), _unless(_is_object(v), "not_an_object"), _unless(_whole(_field(v, "schema_version")) == schema_version, "schema_version"),
        _unless(_text(_field(v, "projection_schema_version")) == projection, "projection_schema_version"), _unless(_text(_field(v, "adapter_identity")) == adapter, "adapter_identity"),
        _unless(capability.isin(*capabilities), "capability"), _unless(_is_object(_field(v, "result")), "result"), _unless(_list(items).isNotNull(), f"{name}_not_a_list"), _first_of(_list(items), _cue if kind == "asr" else _item))
    told = rows.withColumn("detail", detail)
    good = F.col("detail").isNull()
    parsed = F.from_json("_body", f"result struct<{name}:{_ITEMS[kind]}>")["result"][name]
    return told.select(*keys, F.when(good, "projected").otherwise("model_output_invalid").alias("state"), "detail", F.when(good, capability).alias("capability"), F.when(good, parsed).alias("items"))
