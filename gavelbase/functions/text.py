"""Column functions for loosely kept text: blanks, listing ids, display times. All stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space to trim besides ASCII: no-break, ideographic, en and em spaces, zero-width marks.
SPACE = r"[\s\u00a0\u2000-\u200d\u202f\u2060\u3000\ufeff]"

#: Full-width forms and the ideographic space, and what they are in ASCII.
WIDE = "".join(chr(x) for x in range(0xFF01, 0xFF5F)) + "\u3000"
NARROW = "".join(chr(x - 0xFEE0) for x in range(0xFF01, 0xFF5F)) + " "

#: Words that state nothing (fixed values, compared in lower case after trimming).
EMPTY_WORDS = ("", "-", "--", "/", "nan", "none", "null", "n/a", "未知", "无", "暂无", "不适用", "待核实", "不详")


def strip(c: Column) -> Column:
    """Trim every kind of white space; null stays null."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def is_blank(c: Column) -> Column:
    """True for null, white space and words that state nothing."""
    return c.isNull() | F.lower(strip(c)).isin(*EMPTY_WORDS)


def non_blank(c: Column) -> Column:
    """The trimmed value, or null if it says nothing."""
    return F.when(~is_blank(c), strip(c))


def half_width(c: Column) -> Column:
    """Full-width digits and signs as ASCII."""
    return F.translate(c, WIDE, NARROW)


def norm_id(c: Column) -> Column:
    """A listing id as text: full-width signs narrowed, trimmed, without a decimal tail of zeros (``"１２３.0 "`` gives ``"123"``)."""
    return F.regexp_replace(strip(half_width(c.cast("string"))), r"\.0+$", "")


def id_number(c: Column) -> Column:
    """A listing id as a number; null if it isn't one."""
    return norm_id(c).try_cast("bigint")


_TIME = r"(\d{4})\D+(\d{1,2})\D+(\d{1,2})(?:\D+(\d{1,2})(?:\D+(\d{1,2})(?:\D+(\d{1,2}))?)?)?"


def time_seconds(c: Column) -> Column:
    """Seconds since 1970 of a displayed time in any of the usual layouts, read as written; null if it is none."""
    s = half_width(c)

    def part(i: int) -> Column:
        return F.coalesce(F.regexp_extract(s, _TIME, i).try_cast("int"), F.lit(0))

    days = F.datediff(F.try_to_timestamp(F.concat_ws("-", part(1), F.lpad(part(2).cast("string"), 2, "0"), F.lpad(part(3).cast("string"), 2, "0")), F.lit("yyyy-MM-dd")).cast("date"), F.lit("1970-01-01").cast("date"))
    return days.cast("bigint") * 86400 + part(4) * 3600 + part(5) * 60 + part(6)
