"""Quantities recorded in different units: find each number and its unit, then convert to one unit per field.

Method: a multi-pattern automaton holds all unit aliases and is run over each cell, and over the row's own text where a
bare number needs it; the longest match next to a number wins, the field's kind of measure decides between aliases of
several measures, and the factor comes from a broadcast table of units, whose size is fixed by this module.

Defined results: a null, blank or wordy cell states no quantity and gives no row; a cell that gives several quantities gives
the one the field asks for (total floor area before the inner area, the unit's floor before the number of floors); a
repeated row gives its own row; an infinite or unreadable number gives none. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelbase.functions.numerals import HAN, LARGE, han_number, narrow

#: Measure, alias (in lower case, half width), factor to square metres, yuan or floors.
UNITS = (
    ("area", "平方米", 1.0), ("area", "平米", 1.0), ("area", "平方", 1.0), ("area", "平", 1.0), ("area", "㎡", 1.0), ("area", "m²", 1.0), ("area", "m2", 1.0), ("area", "m^2", 1.0),
    ("area", "sqm", 1.0), ("area", "sq.m", 1.0), ("area", "平方公尺", 1.0), ("area", "坪", 400 / 121), ("area", "亩", 10000 / 15), ("area", "公顷", 10000.0), ("area", "ha", 10000.0),
    ("area", "平方英尺", 0.09290304), ("area", "平方呎", 0.09290304), ("area", "平方尺", 1 / 9), ("area", "呎", 0.09290304), ("area", "sqft", 0.09290304), ("area", "sq.ft", 0.09290304), ("area", "sq ft", 0.09290304), ("area", "ft²", 0.09290304), ("area", "ft2", 0.09290304),
    ("area", "平方公里", 1e6), ("area", "万平方米", 1e4), ("area", "公亩", 100.0),
    ("money", "元", 1.0), ("money", "圆", 1.0), ("money", "yuan", 1.0), ("money", "千元", 1e3), ("money", "万元", 1e4), ("money", "万", 1e4), ("money", "百万元", 1e6), ("money", "百万", 1e6), ("money", "千万元", 1e7), ("money", "千万", 1e7), ("money", "亿元", 1e8), ("money", "亿", 1e8), ("money", "角", 0.1), ("money", "分", 0.01),
    ("floor", "层", 1.0), ("floor", "楼", 1.0), ("floor", "f", 1.0), ("floor", "层楼", 1.0),
)

#: What stands before a floor's number and what it makes of it, and words that are a floor.
ROLES = (
    ("below", "地下"), ("below", "负"), ("below", "b"), ("below", "-"), ("below", "−"), ("below", "–"), ("total", "共"), ("total", "总高"), ("total", "总层数"), ("total", "总"), ("total", "地上"),
    ("own", "所在层"), ("own", "所在楼层"), ("own", "位于"), ("own", "底层"), ("own", "第"), ("mark", "："), ("mark", ":"),
)
FLOOR_WORDS = (("首层", 1.0), ("首楼", 1.0), ("底层", 1.0), ("底楼", 1.0))

_NUMBER = re.compile(r"[+-]?\d{1,3}(?:[,，]\d{3})+(?:\.\d+)?|[+-]?\d+(?:\.\d+)?|[+-]?\.\d+")
_HAN = re.compile(f"[{HAN}{''.join(LARGE)}]+(?:点[{HAN}]+)?")
_COUNT = re.compile(rf"\d+(?:\.0+)?(?!\.?\d)|[{HAN}]+")


@cache
def automaton(measure: str) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for k, (m, alias, _) in enumerate(UNITS):
        if m == measure:
            a.add_word(alias, (k, len(alias)))
    a.make_automaton()
    return a


def units_in(text: str, measure: str) -> dict[int, tuple[int, int]]:
    """Start to (end, unit) of the longest alias that begins at each place."""
    best: dict[int, tuple[int, int]] = {}
    for end, (k, size) in automaton(measure).iter(text):
        start = end - size + 1
        if start not in best or best[start][0] < end + 1:
            best[start] = (end + 1, k)
    return best


@cache
def role_automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for role, alias in ROLES:
        a.add_word(alias, (role, len(alias)))
    a.make_automaton()
    return a


def roles_in(text: str) -> dict[int, tuple[int, str]]:
    """End to (start, role) of the longest alias that ends at each place."""
    best: dict[int, tuple[int, str]] = {}
    for last, (role, size) in role_automaton().iter(text):
        if last + 1 not in best or best[last + 1][0] > last + 1 - size:
            best[last + 1] = (last + 1 - size, role)
    return best


def _numbers(s: str) -> list[tuple[int, int, float]]:
    """Start, end and value of each number; a Chinese numeral counts where no digits are next to it."""
    out = [(m.start(), m.end(), float(m.group().replace(",", "").replace("，", ""))) for m in _NUMBER.finditer(s)]
    if not out:
        for m in _HAN.finditer(s):
            if any(c in HAN for c in m.group()) and (v := han_number(m.group())) is not None:
                out.append((m.start(), m.end(), float(v)))
    return out


def _unit_after(s: str, at: int, units: dict[int, tuple[int, int]]) -> int | None:
    while at < len(s) and s[at] in " \t余多":
        at += 1
    return units[at][1] if at in units else None


def _first(measure: str, alias: str) -> int:
    return next(k for k, (m, a, _) in enumerate(UNITS) if m == measure and a == alias)


BASE = {"area": _first("area", "平方米"), "money": _first("money", "元"), "floor": _first("floor", "层")}


def clean(cell: str) -> str:
    return narrow(cell).replace(" ", " ").strip().lower()


def _forms(number: str) -> set[str]:
    """A number as it may be written: with and without separators, and without zeros at its end."""
    plain = re.sub("[,，]", "", number).lstrip("+")
    short = plain.rstrip("0").rstrip(".") if "." in plain else plain
    whole, _, part = short.lstrip("-").partition(".")
    parted = f"{int(whole):,}" if whole.isdigit() else whole
    return {number, plain, short, parted + ("." + part if part else ""), parted + plain.lstrip("-")[len(whole) :]} - {""}


def context_unit(number: str, text: str, measure: str) -> int | None:
    """The unit that a text gives to a number: right after it, or announced just before it. Line breaks are no part of the text."""
    plain = re.sub(r"[\s　]+", "", narrow(text)).lower()
    units = units_in(plain, measure)
    for m in re.finditer("|".join(re.escape(x) for x in sorted(_forms(number), key=lambda x: (-len(x), x))), plain):
        if m.start() and (plain[m.start() - 1].isdigit() or plain[m.start() - 1] == "." or re.search(r"\d[,，]$", plain[max(0, m.start() - 2) : m.start()])) or re.match(r"\d|\.\d|[,，]\d{3}", plain[m.end() : m.end() + 4]):
            continue
        k = _unit_after(plain, m.end(), units)
        if k is not None:
            return k
        if said := re.match(r"[^。；;]{0,4}单位[为是：:]*", plain[m.end() : m.end() + 12]):
            k = _unit_after(plain, m.end() + said.end(), units)
            if k is not None:
                return k
        before = plain[max(0, m.start() - 24) : m.start()]
        for said in reversed(list(re.finditer(r"单位[为是：:]*", before))):
            if "。" not in before[said.end() :]:
                k = _unit_after(plain, max(0, m.start() - 24) + said.end(), units)
                if k is not None:
                    return k
    return None


def area(cell: str, text: str) -> tuple[float, int] | None:
    """Total floor area: the number after 建筑面积 if the cell names parts, else the first with an area unit, else a bare number."""
    s = clean(cell)
    numbers = _numbers(s)
    if not numbers:
        return None
    units = units_in(s, "area")
    start = s.find("建筑面积")
    inner = [m.start() for m in re.finditer("套内|使用面积|公摊|土地", s)]
    ranked = []
    for n, (a, b, v) in enumerate(numbers):
        k = _unit_after(s, b, units)
        part = any(i < a and not s[i:a].count("建筑面积") for i in inner) and not (start >= 0 and start < a and all(not start < i < a for i in inner))
        ranked.append((part, k is None, n, v, k, s[a:b]))
    part, _, _, v, k, written = min(ranked, key=lambda x: x[:3])
    if k is None:
        rest = _NUMBER.sub("", s)
        if re.sub(r"[约\s.+-]|建筑面积|[：:]", "", rest):
            return None  # a number among words without a unit is no area
        k = context_unit(written, text, "area") if text and written[-1].isdigit() else None
        k = BASE["area"] if k is None else k
    return v, k


def money(cell: str, text: str) -> tuple[float, int] | None:
    s = clean(cell)
    m = _NUMBER.search(s)
    if m:
        v = float(m.group().replace(",", "").replace("，", ""))
        units = units_in(s, "money")
        k = _unit_after(s, m.end(), units)
        if k is not None:
            return v, k
        rest = (s[: m.start()] + s[m.end() :]).strip()
        if re.sub(r"[¥￥约\s]|rmb|cny|人民币|整", "", rest):
            return None
        if text:
            k = context_unit(m.group(), text, "money")
        return v, BASE["money"] if k is None else k
    units, runs = units_in(s, "money"), list(re.finditer(f"[{HAN}{''.join(LARGE)}]+", s))
    named = [(m, k) for m in runs if (k := _unit_after(s, m.end(), units)) is not None]
    if not named or UNITS[named[0][1]][2] != 1.0:
        m = re.fullmatch(f"(?:人民币)?([{HAN}{''.join(LARGE)}]+)整?", s)
        v = han_number(m.group(1)) if m else None
        return None if v is None else (float(v), BASE["money"])
    v = han_number(named[0][0].group())
    # tenths and hundredths of a yuan follow
    return None if v is None else (float(v) + sum((han_number(m.group()) or 0) * UNITS[k][2] for m, k in named[1:] if UNITS[k][2] < 1), named[0][1])


def _counts(s: str) -> list[tuple[int, int, float, int | None, set[str], int]]:
    """Start, end, value and unit of each whole number, the roles before it and where these begin."""
    units, roles = units_in(s, "floor"), roles_in(s)
    out = []
    for m in _COUNT.finditer(s):
        v = float(m.group()) if m.group()[0].isdigit() else han_number(m.group())
        if v is None:
            continue
        own, at = set(), m.start()
        while at in roles:
            at, role = roles[at]
            own.add(role)
        end, k = units[m.end()] if m.end() in units else (m.end(), None)
        out.append((m.start(), end, float(v), k, own, at))
    return out


def floor(cell: str, text: str) -> tuple[float, int] | None:
    """The unit's floor; below ground negative. The number begins the cell but for its roles, and ends it or is parted from what follows."""
    s = re.sub(r"\s+", "", clean(cell))
    if s in dict(FLOOR_WORDS):
        return dict(FLOOR_WORDS)[s], BASE["floor"]
    counts = _counts(s)
    if not counts:
        return None
    _, end, v, k, roles, start = counts[0]
    if start or "total" in roles or not re.match(r"$|[/(（,，、共]|总", s[end:]):
        return None
    return (-v if "below" in roles else v), BASE["floor"] if k is None else k


def floors(cell: str, text: str) -> tuple[float, int] | None:
    """The number of floors of the building: the number said to be the total, else the only one, else the one behind a slash."""
    s = re.sub(r"\s+", "", clean(cell))
    counts = _counts(s)
    if not counts:
        return None
    _, end, v, k, _, start = next((c for c in counts if "total" in c[4]), counts[-1])
    if "total" not in next((c[4] for c in counts if "total" in c[4]), ()):
        alone = len(counts) == 1 and start == counts[0][0] == 0 and re.fullmatch("[楼高]?", s[end:])
        behind = s[: counts[-1][0]].endswith("/") and s.count("/") == 1 and end == len(s)
        if not alone and not behind:
            return None
    return v, BASE["floor"] if k is None else k


#: A cell of one number without a unit; words that say nothing of it may stand before.
_MAY_NEED_TEXT = r"^(?:约|建筑面积|[¥￥]|人民币|[Rr][Mm][Bb]|[：:]|[\s　\u00a0])*[+-]?[0-9０-９.．,，]+[\s　\u00a0]*整?$"
READERS = {"area": area, "money": money, "floor": floor, "floors": floors}
MEASURES = {"area": "area", "money": "money", "floor": "floor", "floors": "floor"}


def convert_units(df: DataFrame, fields: dict[str, str], context: str | None = None, id_col: str = "row_id") -> DataFrame:
    """Quantities of the fields in square metres, yuan or floors.

    fields: column name to kind (area, money, floor, floors); context: the column whose text may give a bare number its unit.
    Gives row_id, field_name, kind, number, unit and value. One pass and one broadcast join with the table of units.
    """
    if bad := set(fields.values()) - set(READERS):
        raise ValueError(f"unknown kinds: {sorted(bad)}")
    text = F.col(f"`{context}`").cast("string") if context else F.lit(None).cast("string")
    cells = df.select(
        F.col(f"`{id_col}`").cast("bigint").alias("_id"),
        text.alias("_t"),
        F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.lit(k).alias("k"), F.col(f"`{f}`").cast("string").alias("v")) for f, k in fields.items()))).alias("_x"),
    ).where("_x.v is not null").select("_id", F.col("_x.f").alias("_f"), F.col("_x.k").alias("_k"), F.col("_x.v").alias("_v"), F.when(F.col("_x.v").rlike(_MAY_NEED_TEXT), F.col("_t")).alias("_t"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in frames:
            got = [READERS[k](v, t or "") for k, v, t in zip(x["_k"], x["_v"], x["_t"])]
            keep = [g is not None and abs(g[0]) < 1e300 for g in got]
            got = [g for g, k in zip(got, keep) if k]
            yield pd.DataFrame({"row_id": x["_id"][keep], "field_name": x["_f"][keep], "kind": x["_k"][keep], "number": [g[0] for g in got], "unit_no": [g[1] for g in got]})

    units = df.sparkSession.createDataFrame([(k, m, a, f) for k, (m, a, f) in enumerate(UNITS)], "unit_no int, measure string, unit string, factor double")
    found = cells.mapInPandas(read, "row_id bigint, field_name string, kind string, number double, unit_no int")
    return found.join(F.broadcast(units), "unit_no").select("row_id", "field_name", "kind", "number", "unit", (F.col("number") * F.col("factor")).alias("value"))
