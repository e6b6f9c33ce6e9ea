"""Scalar column functions (Column -> Column), all JVM-side built-ins.

No Python UDF is used anywhere: each function composes ``pyspark.sql.functions``
so it stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera import config as C

MICROS_PER_MINUTE = 60_000_000

# Null tokens a pandas CSV reader treats as missing even for text columns.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Optional parts in brackets; a zone moves the time to UTC (the session's zone).
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm[:ss][.SSSSSS][.SSS]", "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSS][.SSS][XXX]",
                     "dd/MM/yyyy HH:mm[:ss]", "yyyy-MM-dd", "dd/MM/yyyy")


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens_to_null(c: str | Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Text column with any of the null tokens replaced by null."""
    c = col_of(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def any_null(cols: Iterable[str]) -> Column:
    """true when any of the columns is null."""
    out = None
    for name in cols:
        cond = F.col(name).isNull()
        out = cond if out is None else (out | cond)
    return out if out is not None else F.lit(False)


def strip(c: str | Column) -> Column:
    """strip leading/trailing white space of any script (no-break and wide
    spaces, tabs, line ends, information separators)."""
    return F.regexp_replace(col_of(c), r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$", "")


def is_digits(c: str | Column, length: int) -> Column:
    """exactly ``length`` ASCII digits (anchors reject a trailing newline)."""
    return col_of(c).rlike(r"\A[0-9]{%d}\z" % length)


_MAPS: dict[tuple, Column] = {}


def map_literal(mapping: Mapping[str, str]) -> Column:
    """A constant map column from a small fixed dictionary. Built once per
    Spark context: a Column is an unresolved expression and can be reused."""
    from pyspark import SparkContext
    key = (id(SparkContext._active_spark_context), tuple(mapping.items()))
    cached = _MAPS.get(key)
    if cached is None:
        items = []
        for k, v in mapping.items():
            items += [F.lit(k), F.lit(v)]
        cached = _MAPS[key] = F.create_map(*items)
    return cached


def lookup(c: str | Column, mapping: Mapping[str, str], default=None) -> Column:
    """dictionary lookup with default; the dictionary is a map literal,
    so no join or broadcast is needed for a fixed vocabulary."""
    found = F.try_element_at(map_literal(mapping), col_of(c))
    if default is None:
        return found
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def surrogate_key(c: str | Column, digits: int = 8) -> Column:
    """First ``digits`` hex digits of MD5 as a non-negative bigint. 8 are the
    source's 32-bit key; up to 15 fit a bigint where members are too many for 32 bits."""
    return F.conv(F.substring(F.md5(col_of(c).cast("string")), 1, digits), 16, 10).cast("bigint")


def member_key(c: str | Column) -> Column:
    """Surrogate key, or -1 for a null member."""
    c = col_of(c)
    return F.when(c.isNull(), F.lit(C.NO_MEMBER_KEY).cast("bigint")).otherwise(surrogate_key(c))


def pseudonym(c: str | Column, salt: str = "") -> Column:
    """upper-case first 16 hex digits of SHA-256 (optionally salted)."""
    c = col_of(c).cast("string")
    if salt:
        c = F.concat(F.lit(salt), c)
    return F.upper(F.substring(F.sha2(c, 256), 1, 16))


def code_from_name(c: str | Column, width: int = 10) -> Column:
    """F8: spaces to underscores, upper case, first ``width`` characters."""
    return F.substring(F.upper(F.replace(col_of(c), F.lit(" "), F.lit("_"))), 1, width)


def parse_timestamp(c: str | Column, formats: Iterable[str] = TIMESTAMP_FORMATS) -> Column:
    """text to TIMESTAMP_NTZ, unparseable -> null (never raises under ANSI).
    Timestamp input is passed through."""
    c = col_of(c)
    parsed = [F.try_to_timestamp(c, F.lit(fmt)) for fmt in formats]
    return F.coalesce(*parsed).cast("timestamp_ntz")


def diff_micros(start: str | Column, end: str | Column) -> Column:
    """Exact difference ``end - start`` in microseconds (bigint)."""
    return F.timestamp_diff("MICROSECOND", col_of(start), col_of(end))


def micros_to_minutes(c: str | Column) -> Column:
    """fractional minutes (double)."""
    return col_of(c).cast("double") / F.lit(MICROS_PER_MINUTE)


def minutes_to_micros(c: str | Column) -> Column:
    """Inverse of :func:`micros_to_minutes`; exact for values it produced."""
    return F.round(col_of(c) * F.lit(MICROS_PER_MINUTE)).cast("bigint")


def date_key(c: str | Column) -> Column:
    """yyyymmdd integer of a date or timestamp."""
    c = col_of(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def financial_year(c: str | Column) -> Column:
    """April-March financial year label ``FY2024/25``."""
    c = col_of(c)
    start = F.year(c) - F.when(F.month(c) < 4, 1).otherwise(0)
    return F.concat(F.lit("FY"), start.cast("string"), F.lit("/"),
                    F.substring((start + 1).cast("string"), 3, 2))


def iso_day_of_week(c: str | Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(col_of(c)) + 1).cast("int")


def tat_band(mins: str | Column) -> Column:
    """Turnaround band of fractional minutes; null or negative is Invalid."""
    m = col_of(mins)
    out = F.when(m.isNull() | (m < 0), F.lit(C.TAT_BAND_INVALID))
    for upper, label in C.TAT_BANDS:
        out = out.when(m <= upper, F.lit(label))
    return out.otherwise(F.lit(C.TAT_BAND_OVER))


def tat_flag(micros: str | Column, min_mins: int, max_mins: int) -> Column:
    """V05 flag on exact microseconds; null compares false and stays OK."""
    us = col_of(micros)
    return (F.when(us < F.lit(min_mins * MICROS_PER_MINUTE), F.lit("NEGATIVE_TAT"))
            .when(us > F.lit(max_mins * MICROS_PER_MINUTE), F.lit("EXCESSIVE_TAT"))
            .otherwise(F.lit("OK")))


def round_half_up(c: str | Column, digits: int) -> Column:
    """round half away from zero, on the double scaled by ``10^d``."""
    scale, x = float(10 ** digits), col_of(c)
    size = F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
    return F.when(x < 0, -size).otherwise(size)


def percent_text(passed: str | Column, failed: str | Column) -> Column:
    """``95.1%`` with a zero guard, from exact integer arithmetic
    (tenths of a percent, rounded half up)."""
    p, f = col_of(passed).cast("bigint"), col_of(failed).cast("bigint")
    total = F.greatest(p + f, F.lit(1).cast("bigint"))
    tenths = int_div(F.lit(2000) * p + total, F.lit(2) * total)
    return F.concat(int_div(tenths, F.lit(10)).cast("string"), F.lit("."),
                    F.pmod(tenths, F.lit(10)).cast("string"), F.lit("%"))


def int_div(a: Column, b: Column) -> Column:
    """Exact floor division of non-negative bigints."""
    return ((a - F.pmod(a, b)) / b).cast("bigint")


def year_month_key(date_key_col: str | Column) -> Column:
    """L3: ``YYYY_MM`` from a yyyymmdd key, ``UNKNOWN`` when missing."""
    s = col_of(date_key_col).cast("string")
    return F.coalesce(F.concat(F.substring(s, 1, 4), F.lit("_"), F.substring(s, 5, 2)),
                      F.lit("UNKNOWN"))
