"""Postal addresses taken apart: province, city, district, town, road, number, estate, building, unit, floor, room or bay.

Place names are learned from the tables' own columns (:class:`Places`), so that names written without their ending can be told
from the road or estate that follows. All numbers are read as numbers, however written.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from gavelbase.functions.numerals import DIGITS, SMALL, han_number, narrow
from gavelbase.functions.text import EMPTY_WORDS

#: Where each Latin initial begins in the sound-ordered part of GB 2312.
INITIALS = (
    (0xB0A1, "a"), (0xB0C5, "b"), (0xB2C1, "c"), (0xB4EE, "d"), (0xB6EA, "e"), (0xB7A2, "f"), (0xB8C1, "g"), (0xB9FE, "h"), (0xBBF7, "j"), (0xBFA6, "k"), (0xC0AC, "l"), (0xC2E8, "m"),
    (0xC4C3, "n"), (0xC5B6, "o"), (0xC5BE, "p"), (0xC6DA, "q"), (0xC8BB, "r"), (0xC8F6, "s"), (0xCBFA, "t"), (0xCDDA, "w"), (0xCEF4, "x"), (0xD1B9, "y"), (0xD4D1, "z"), (0xD7FA, "*"),
)
#: Endings of estate names.
ESTATE_ENDS = ("花园", "小区", "公寓", "广场", "家园", "新城", "名都", "豪园", "华府", "雅筑", "公馆", "湾畔", "豪庭", "大厦", "花苑", "苑", "城", "园", "庭", "府")

_NUM = "".join(DIGITS)[:12] + "".join(SMALL)[:3]
_HAN_BEFORE = re.compile(rf"(?<![一-鿿])?第?([{_NUM}]+)(?=号|栋|幢|座|#|楼|单元|层|房|室|单位)")
#: A room's number behind its house, with nothing behind it.
_HAN_ROOM = re.compile(rf"(?<=[楼栋幢座#])([{_NUM}]{{3,6}})(?=$|[\s,，;；(（])")
_HEAD = re.compile(r"^[【\[][^】\]]*[】\]]|^.{0,14}?位于|^坐落(?:于)?[:：]?|^地址[:：]?")
_TAIL = re.compile(r"(?:[【\[][^】\]]*[】\]]$|[(（](?:含装修|二拍|一拍|变卖|[一二三]次拍卖)[)）]|(?:的)?(?:不动产|房地产)$|(?:的)?房产一?[处套]?$|(?:的)?(?:住宅|商铺|厂房|车位|别墅|写字楼|办公|公寓)一[套间处个]$|的(?:住宅|商铺|厂房|车位|别墅|写字楼|办公|公寓)$|一[处套间个]$|司法拍卖$|\\s+$)")
_ROAD = re.compile(r"^([一-鿿]{1,8}?(?:大道|大街|公路|胡同(?=\d)|路|街|巷|(?<!街)道(?=\d)|[里弄](?=\d)))(?!道)(?:(\d{1,5})(?:-\d{1,3})?(弄)?)?(?:号(?!楼)|#(?!楼))?")
_HOUSE = r"第?(?<![a-z0-9])0*(\d{1,4}|[a-z]\d{0,2})(?:#楼|号楼|栋|幢|座|#|楼(?!层))"
_LANE_HOUSE = re.compile(r"^0*(\d{1,4})号(?=\d)")
_UNIT = r"(?:第?0*(\d{1,2}|[a-z])(?:单元|门(?=\d)))?"
_ENDED = "(?:房|室|号房|号|单位|户)"
_BAY = re.compile(rf"(?:{_HOUSE})?{_UNIT}(?:(负|地下|-|b)(\d)层)?(?:车位|车库)?([a-z]{{1,2}})-?(\d{{1,5}})号?(?:车位|车库)?$")
#: A bay with a number only must be called one.
_PLAIN_BAY = re.compile(rf"(?:{_HOUSE})?{_UNIT}(?:(负|地下|-|b)(\d)层)?(?:车位|车库)(\d{{1,5}})号?$|(?:{_HOUSE})?{_UNIT}(?:(负|地下|-|b)(\d)层)?0*(\d{{1,5}})号?(?:车位|车库)$")
#: A room of one or two digits needs its word or a unit before it.
_FLAT = re.compile(rf"{_HOUSE}{_UNIT}(?:第?(-?\d{{1,2}})(?:层|楼))?(?:0*(\d{{3,6}}[a-z]?){_ENDED}?|0*(\d{{1,2}}[a-z]?){_ENDED})$")
_ROOM_ONLY = re.compile(rf"^(?:0*(\d{{1,4}})号)?{_UNIT}(?:第?(-?\d{{1,2}})(?:层|楼))?0*(\d{{3,6}}[a-z]?)(?:房|室|单位|户)$")
_DASH = re.compile(r"(?<![\da-z])0*(\d{1,3}|[a-z])-(?:0*(\d{1,2})-)?0*(\d{3,6})(?:房|室|号|单位)?$")
_HOUSE_ONLY = re.compile(rf"{_HOUSE}{_UNIT}$")


_END_STARTS = {e[:k] for e in ESTATE_ENDS for k in range(1, len(e) + 1)}


def _is_ending(s: str) -> bool:
    """Whether it is an estate name's ending, cut off, turned round or with one wrong character."""
    return s in _END_STARTS or len(s) == 2 and (any(len(e) == 2 and (s[0] == e[0]) != (s[1] == e[1]) for e in ESTATE_ENDS) and s[1] not in "区县市" or s[::-1] in ESTATE_ENDS)


@dataclass
class Places:
    """Known names, without their endings: provinces, cities, and districts with their city."""

    provinces: set[str] = field(default_factory=set)
    cities: set[str] = field(default_factory=set)
    districts: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def of(pairs: list[tuple[str, str]], provinces: list[str]) -> Places:
        """pairs: city and district with their endings, as in a court's name."""
        p = Places({x.removesuffix("省") for x in provinces if x}, {c.removesuffix("市") for c, _ in pairs if c}, {})
        for c, d in pairs:
            if d:
                p.districts.setdefault(d[:-1] if d[-1] in "区县市" and len(d) > 2 else d, c.removesuffix("市"))
        return p


def sound(name: str) -> str:
    """The initials of a name's characters, once each and in order of the alphabet, so that swapped, doubled and like-sounding characters agree."""
    out = set()
    for c in name:
        try:
            b = c.encode("gb2312")
        except UnicodeEncodeError:
            out.add("*")
            continue
        v = b[0] << 8 | b[1] if len(b) == 2 else 0
        out.add(next((s for lo, s in reversed(INITIALS) if v >= lo), c) if v else c)
    return "".join(sorted(out))


def core(estate: str) -> str:
    """An estate's name without its ending and without doubled characters; a name whose end is no ending, not even a spoilt one, is whole."""
    s = re.sub(r"(.)\1+", r"\1", estate)
    for e in ESTATE_ENDS:
        if s.endswith(e) and len(s) > len(e) + 1:
            return s[: -len(e)]
    return next((s[:k] for k in range(2, len(s)) if _is_ending(s[k:])), s)


def ending(estate: str) -> frozenset[str]:
    """The endings that an estate's name may have: the one it has, those that differ by one character or go on where it is cut off; none if it has no room for one."""
    s = re.sub(r"(.)\1+", r"\1", estate)
    tail = s[len(core(estate)) :]
    if not tail:
        return frozenset()
    if tail in ESTATE_ENDS:
        return frozenset((tail,))
    near = frozenset(e for e in ESTATE_ENDS if len(e) == len(tail) == 2 and (sum(a != b for a, b in zip(e, tail)) == 1 or e == tail[::-1]) or len(tail) == 1 and e.startswith(tail))
    return near or frozenset((tail,))


def parse(text: str | None, places: Places) -> dict[str, str]:
    """The parts that a text states; those it doesn't are empty. ``room`` is a flat's number or a bay's letter and number."""
    out = dict.fromkeys(("city", "district", "road", "number", "estate", "house", "unit", "room"), "")
    if not text or text.strip().lower() in EMPTY_WORDS:
        return out
    s = re.sub(r"(?<=\d)\s+(?=号|#|栋|幢|座)", "", narrow(text).strip().lower())
    for _ in range(4):
        s = _TAIL.sub("", s.strip())
    s = _HEAD.sub("", s)
    s = _HAN_BEFORE.sub(lambda m: m.group().replace(m.group(1), str(int(v)) if (v := han_number(m.group(1))) is not None else m.group(1)), s)
    s = _HAN_ROOM.sub(lambda m: str(int(v)) if (v := han_number(m.group(1))) is not None else m.group(1), s)
    for part in re.split(r"[\s,，、;；()（）]+", s):
        part = part.strip("。.的")
        while part:
            before = part
            for p in places.provinces:
                if part.startswith(p):
                    part = part[len(p) :].removeprefix("省")
            part = _place(part, places, out)
            if m := re.match(r"^[一-鿿]{2,3}?(?:街道|镇|乡)(?=.|$)", part):
                part = part[m.end() :]
            elif m := re.match(r"^[一-鿿]{2}街(?=[一-鿿]{2,8}?(?:大道|路|街|巷)(?:\d|$))", part):
                part = part[m.end() :]
            if part == before:
                break
        m = _ROAD.match(part)
        if m and (not out["road"] or m.group(2) and not out["number"]):
            out["road"], out["number"] = m.group(1), (m.group(2) or "").lstrip("0") + ("弄" if m.group(3) else "")
            part = part[m.end() :]
            if m.group(3) and (h := _LANE_HOUSE.match(part)):  # houses of a lane are numbered
                out["house"], part = h.group(1), part[h.end() :]
        if m := _BAY.search(part):
            house, unit, _, _, letter, no = m.groups()
            out["house"], out["unit"], out["room"] = out["house"] or (house or ""), out["unit"] or (unit or ""), letter + no.lstrip("0")
        elif m := _PLAIN_BAY.search(part):
            g = m.groups()
            house, unit, no = (g[0], g[1], g[4]) if g[4] else (g[5], g[6], g[9])
            out["house"], out["unit"], out["room"] = out["house"] or (house or ""), out["unit"] or (unit or ""), "#" + no.lstrip("0")
        elif m := _FLAT.search(part):
            out["house"], out["unit"], out["room"] = m.group(1), m.group(2) or "", m.group(4) or m.group(5)
        elif m := _DASH.search(part):
            out["house"], out["unit"], out["room"] = m.group(1), m.group(2) or "", m.group(3)
        elif m := _ROOM_ONLY.match(part):
            out["house"], out["unit"], out["room"] = out["house"] or (m.group(1) or ""), out["unit"] or (m.group(2) or ""), m.group(4)
        elif m := _HOUSE_ONLY.search(part):
            out["house"], out["unit"] = m.group(1), m.group(2) or ""
        if m:
            part = part[: m.start()]
        part = re.sub(r"[^一-鿿a-z0-9]", "", part)
        if part and not out["estate"] and re.search("[一-鿿]{2}", part):
            out["estate"] = part
    if out["district"] and not out["city"]:
        out["city"] = places.districts.get(out["district"], "")
    return out


def _place(part: str, places: Places, out: dict[str, str]) -> str:
    for kind, names, ends in (("city", places.cities, "市"), ("district", places.districts, "区县市")):
        for size in (4, 3, 2):
            name = part[:size]
            if len(name) == size and name in names:
                rest = part[size:]
                if rest[:1] in ends and rest:
                    rest = rest[1:]
                elif re.match(r"(?:大道|路|街|巷|中路|北路|南路)\d*", rest) or _is_ending(re.match("[一-鿿]*", rest).group()):
                    continue  # the name of a road or an estate
                if not out[kind]:
                    out[kind] = name
                return rest
    return part


def _key(name: str) -> str:
    """A name's different characters in order of their codes, so that a swap or a doubled character doesn't count."""
    return "".join(sorted(set(name)))


def road_key(road: str) -> str:
    """As for names, the road's kind (and a side, as in 北路) kept apart at the end."""
    s = re.sub(r"(.)\1+", r"\1", road)
    kind = re.search(r"(?:[东南西北中])?(?:大道|大街|公路|胡同|路|街|巷|道|里|弄)$", s)
    cut = max(kind.start(), 2) if kind else len(s)
    return _key(s[:cut]) + s[cut:]


PARSED = "city string, district string, road string, number string, estate string, house string, unit string, room string, road_key string, estate_key string, ends string, road_sound string, estate_sound string"


def features(text: str | None, places: Places) -> dict[str, str]:
    p = parse(text, places)
    road = re.sub(r"(.)\1+", r"\1", p["road"])
    p["road_key"] = road_key(road) if road else ""
    p["estate_key"] = _key(core(p["estate"])) if p["estate"] else ""
    p["ends"] = ",".join(sorted(ending(p["estate"]))) if p["estate"] else ""
    p["road_sound"] = sound(road[:2]) if road else ""
    p["estate_sound"] = sound(p["estate_key"]) if p["estate"] else ""
    return p
