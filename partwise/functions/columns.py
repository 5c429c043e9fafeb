"""Column functions: exact ticks, time stamps, lossless tokens, comparison forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Why a time has no ticks.
BASE_INVALID, BASE_NOT_COMMON, OUT_OF_RANGE = "time_base_invalid", "time_base_not_common", "ticks_out_of_range"


def ticks(number: str, base: str, per_second: str | int, numerator: str = "1") -> Column:
    """struct<ticks, reason>: number * numerator / base seconds as whole ticks of per_second (a column or a number), exactly.

    Without ticks, and with a reason, are a base or numerator that is null or not above zero (time_base_invalid), a base
    that does not divide per_second (time_base_not_common) and ticks beyond 64 bits (ticks_out_of_range). A null number
    has neither.
    """
    reason = F.when(F.expr(f"not coalesce({base} > 0 and {numerator} > 0, false)"), BASE_INVALID).when(F.expr(f"coalesce({per_second} % nullif({base}, 0) <> 0, true)"), BASE_NOT_COMMON)
    exact = lambda c: f"cast({c} as decimal(19,0))"
    value = F.expr(f"try_cast(try_multiply(try_multiply({exact(number)}, {exact(numerator)}), {exact(f'{per_second} div nullif({base}, 0)')}) as bigint)")
    found = F.when(reason.isNull(), value)
    return F.struct(found.alias("ticks"), F.coalesce(reason, F.when(F.expr(f"{number} is not null") & found.isNull(), OUT_OF_RANGE)).alias("reason"))


def least_common(bases: DataFrame, base: str) -> DataFrame:
    """(per_second): one row, the least number that all bases above zero divide; null beyond 64 bits, 1 without any.

    Distinct bases meet in one row: real time bases are a handful.
    """
    gcd = "aggregate(sequence(1, 93), struct(s as a, b as b), (e, i) -> if(e.b = 0, e, struct(e.b as a, e.a % nullif(e.b, 0) as b))).a"  # Euclid's steps within 64 bits
    return bases.where(f"{base} > 0").agg(F.expr(f"aggregate(sort_array(collect_set(cast({base} as bigint))), 1L, (s, b) -> try_multiply(s div {gcd}, b))").alias("per_second"))


def outward(start: str, end: str, per_ms: int) -> tuple[Column, Column]:
    """An interval in whole milliseconds that contains it: the start rounded down and the end up, before zero as well."""
    down = lambda c: F.expr(f"({c} - pmod({c}, {per_ms})) div {per_ms}")
    return down(start), -F.expr(f"(-({end}) - pmod(-({end}), {per_ms})) div {per_ms}")


def stamp(ms: Column, point: str = ",") -> Column:
    """HH:MM:SS,mmm of milliseconds."""
    whole = F.floor(ms / 1000)
    return F.format_string(f"%02d:%02d:%02d{point}%03d", F.floor(whole / 3600), F.floor(whole / 60) % 60, whole % 60, ms % 1000)


def samples(ticks_column: str, rate: int, per_second: int) -> Column:
    """Ticks as a sample index, half to even."""
    return F.bround(F.expr(f"cast({ticks_column} * {rate} as decimal(30,3)) / {per_second}"), 0).cast("long")


def tokens(text: Column) -> Column:
    """Alternating runs of white space and of anything else, lossless; line ends are line feeds."""
    return F.regexp_extract_all(F.regexp_replace(text, r"\r\n?", "\n"), F.lit(r"(?U)\s+|\S+"), F.lit(0))


def words(text: Column | str) -> Column:
    """Runs of anything but (Unicode) white space."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
