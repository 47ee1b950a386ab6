"""Scalar functions over loose text: cleaning, keys, links, numbers, money, dates, JSON wrappers. Native column expressions, but for ``text_key`` and ``unescape``."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from gavelbase.functions.lazy import arrow_udf
from gavelbase.functions.text import SPACE, is_blank, strip

#: Control characters that XML, and so a workbook, may not hold.
ILLEGAL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]"


def tidy_lines(c: Column, most_breaks: int = 1) -> Column:
    """Line ends as line feeds, runs of blanks as one, runs of more than ``most_breaks`` line feeds cut to that, trimmed."""
    c = F.regexp_replace(F.regexp_replace(c, "\r\n?", "\n"), "　", " ")
    c = F.regexp_replace(c, "[ \t]+", " ")
    c = F.regexp_replace(c, "\n{%d,}" % (most_breaks + 1), "\n" * most_breaks)
    return strip(c)


def one_line(c: Column) -> Column:
    """Every run of white space as one blank, trimmed."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def compact(c: Column, limit: int = 0, tail: str = "…") -> Column:
    """One line of at most ``limit`` characters, the tail included; 0 sets no limit."""
    s = one_line(c)
    return s if limit <= 0 else F.when(F.length(s) > limit, F.concat(F.substring(s, 1, limit - len(tail)), F.lit(tail))).otherwise(s)


def truncate(c: Column, limit: int) -> Column:
    """The first ``limit`` characters and ``...`` where there are more; a limit of 0 or less sets none."""
    return c if limit <= 0 else F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit("..."))).otherwise(c)


def legal(c: Column) -> Column:
    return F.regexp_replace(c, ILLEGAL, "")


def label(c: Column) -> Column:
    """A form label without white space and punctuation."""
    return F.regexp_replace(c, rf"({SPACE}|[：:；;，,。.、])+", "")


def file_label(c: Column, most: int = 80) -> Column:
    """A name that a file system takes."""
    return F.substring(F.regexp_replace(strip(c), r'[\\/:*?"<>|\s]+', "_"), 1, most)


def url(c: Column, host: str = "") -> Column:
    """An absolute link: ``//`` gets https, ``/`` the host; back slashes turned, a last slash dropped."""
    s = F.regexp_replace(F.translate(strip(c), "\\", "/"), "/+$", "")
    return F.when(s.startswith("//"), F.concat(F.lit("https:"), s)).when(s.startswith("/") & (F.lit(host) != ""), F.concat(F.lit(host), s)).otherwise(s)


def number_in_link(c: Column) -> Column:
    """The listing id that a link holds: the last run of five digits and more."""
    return F.regexp_extract(c, r"(\d{5,})\D*$", 1)


def split_joined(c: Column) -> Column:
    """Trimmed values of a cell joined by semicolons, bars, commas or line feeds, without empty ones."""
    return F.filter(F.transform(F.split(c, "[；;|,，\n]+"), strip), lambda x: x != "")


def add_to_set(c: Column, value: str) -> Column:
    """A joined set with one more value, in order."""
    parts = F.coalesce(F.filter(F.split(c, r"[；;|,，\s]+"), lambda x: x != ""), F.array().cast("array<string>"))
    return F.array_join(F.array_union(parts, F.array(F.lit(value))), "；")


def join_distinct(values: Column, sep: str = "；") -> Column:
    """Non-blank values of an array, each once, in order."""
    return F.array_join(F.array_distinct(F.filter(F.transform(values, strip), lambda x: ~is_blank(x))), sep)


def excerpt(c: Column, word: str, before: int = 90, after: int = 90) -> Column:
    """The text around the first place of a word, with ellipses where it is cut; null where the word isn't."""
    at = F.locate(word, c)
    start, stop = F.greatest(at - before, F.lit(1)), F.least(at + len(word) + after, F.length(c) + 1)
    return F.when(at > 0, F.concat(F.when(start > 1, F.lit("…")).otherwise(F.lit("")), F.substring(c, start, stop - start), F.when(stop <= F.length(c), F.lit("…")).otherwise(F.lit(""))))


def keyword_hits(c: Column, words: list[str], most: int = 30) -> Column:
    """The words that a text holds, in the vocabulary's order, at most so many."""
    return F.slice(F.array_compact(F.array(*(F.when(c.contains(w), F.lit(w)) for w in sorted(words)))), 1, most)


def sentences(c: Column, most: int = 260) -> Column:
    """Sentences with the sign that ends them, each once, in order, cut at ``most`` characters. A point ends one before white space; line feeds are ends."""
    parts = F.regexp_extract_all(F.regexp_replace(c, "\n+", "。"), F.lit(r"(?s)((?:(?!\.\s)[^。！？；;])*(?:[。！？；;]|\.(?=\s)|$))"), 1)
    said = F.filter(F.transform(parts, lambda x: F.substring(strip(x), 1, most)), lambda x: ~x.rlike("^[。！？；;.]*$"))
    return F.array_distinct(said)


def keyword_sentences(c: Column, words: list[str], most: int = 3) -> Column:
    """The first sentences that hold one of the words."""
    return F.slice(F.filter(sentences(c), lambda s: F.array_contains(F.transform(F.array(*map(F.lit, words)), lambda w: s.contains(w)), True)), 1, most)


#: Endings of divisions' names, in the order in which they are taken off.
DIVISION_ENDINGS = ("特别行政区", "自治区", "自治州", "自治县", "地区", "省", "市", "区", "县", "镇", "街道", "乡")


def division(c: Column) -> Column:
    """A division's name without its endings."""
    for ending in DIVISION_ENDINGS:
        c = F.regexp_replace(c, f"^(.{{2,}}){ending}$", "$1")
    return c


def code_prefix(c: Column) -> Column:
    """What a division's code shares with all within it; a code of nine digits and more is a town's, of which nine count."""
    return F.when(F.length(c) >= 9, F.substring(c, 1, 9)).when(c.endswith("0000"), F.substring(c, 1, 2)).when(c.endswith("00"), F.substring(c, 1, 4)).otherwise(F.substring(c, 1, 6))


def jsonp(c: Column) -> Column:
    """The payload of a call wrapper, else the text itself."""
    inner = F.regexp_extract(c, r"(?s)^\s*[\w.$]+\((.*)\)\s*;?\s*$", 1)
    return F.when(inner != "", inner).otherwise(c)


def blob(*cols: Column) -> Column:
    """Non-blank texts, each once, on lines of their own."""
    return join_distinct(F.array(*cols), "\n")


_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def number(c: Column) -> Column:
    """A finite number as written, thousands separators allowed; else null."""
    s = F.regexp_replace(strip(c.cast("string")), "[,，]", "")
    return F.when(s.rlike(_NUMBER), s.try_cast("double"))


def whole(c: Column) -> Column:
    """A number cut to a whole one."""
    n = number(c)
    return F.when(F.abs(n) < 9e18, n.cast("bigint"))


def first_number(c: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(c, "[,，]", ""), r"\d+(\.\d+)?", 0).try_cast("double")


def money(c: Column) -> Column:
    """Yuan: the first number, by the scale written right after it."""
    s = F.regexp_replace(c, r"[,，\s]", "")
    scale = F.regexp_extract(s, r"\d+(?:\.\d+)?(亿|千万|百万|万|千)?", 1)
    times = F.when(scale == "亿", 1e8).when(scale == "千万", 1e7).when(scale == "百万", 1e6).when(scale == "万", 1e4).when(scale == "千", 1e3).otherwise(1.0)
    return F.round(first_number(s) * times, 2)


def cents(c: Column) -> Column:
    return F.bround(number(c) / 100, 2)


def epoch_text(c: Column) -> Column:
    """Seconds or milliseconds since 1970 as text in the session's time zone; null unless above zero."""
    n = number(c)
    s = F.when(n > 1e10, n / 1000).otherwise(n)
    return F.when(s > 0, F.date_format(F.timestamp_seconds(F.floor(s)), "yyyy-MM-dd HH:mm:ss"))


def day(c: Column) -> Column:
    """The first date in a text as yyyy-MM-dd (digits as written), else its first ten characters."""
    date = r"(\d{4})[-/.年](\d{1,2})[-/.月](\d{1,2})"
    got = F.concat_ws("-", F.regexp_extract(c, date, 1), F.lpad(F.regexp_extract(c, date, 2), 2, "0"), F.lpad(F.regexp_extract(c, date, 3), 2, "0"))
    return F.when(c.rlike(date), got).otherwise(F.substring(c, 1, 10))


def strict_time(c: Column) -> Column:
    return F.try_to_timestamp(strip(c), F.lit("yyyy-MM-dd HH:mm:ss"))


def coordinate_key(lat: Column, lon: Column) -> Column:
    """Latitude and longitude with six decimals."""
    return F.concat_ws(",", F.format_string("%.6f", lat), F.format_string("%.6f", lon))


def distance_text(m: Column) -> Column:
    """Whole metres below a kilometre, else kilometres with two decimals, halves rounded up; null stays null."""
    return F.when(m.isNull(), F.lit(None).cast("string")).when(m < 1000, F.concat(F.bround(m, 0).cast("bigint").cast("string"), F.lit("m"))).otherwise(F.concat(F.format_string("%.2f", m / 1000), F.lit("km")))


#: Words removed from keys, in this order, and the signs removed after them.
KEY_NOISE = ("拍卖公告", "第一次拍卖", "第二次拍卖", "一拍", "二拍", "变卖", "司法拍卖", "网络司法拍卖", "房产一套", "房屋一套", "房地产", "房产", "房屋", "住宅", "位于", "标的物")
_KEY_SIGNS = re.compile(r"[\\/:*?\"<>|,，。；;、\s\-_—（）()【】\[\]{}]+")
#: Words that are no text in keys.
KEY_MISSING = ("", "none", "null", "nan")


def text_key_of(s: str | None) -> str:
    """A text's key; the words go in their order, so that a longer one may be left in part where a shorter one is taken first."""
    s = (s or "").strip()
    if s.lower() in KEY_MISSING:
        return ""
    s = unicodedata.normalize("NFKC", html.unescape(s)).lower()
    for word in KEY_NOISE:
        s = s.replace(word, "")
    return _KEY_SIGNS.sub("", s)


@arrow_udf("string")
def text_key(c: pd.Series) -> pd.Series:
    """A text's key: unescaped, compatibility forms folded, lower case, without noise words and punctuation."""
    return c.map(text_key_of)


@arrow_udf("string")
def unescape(c: pd.Series) -> pd.Series:
    return c.map(lambda s: None if s is None else html.unescape(s).replace(" ", " "))
