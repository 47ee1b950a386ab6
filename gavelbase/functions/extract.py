"""Fields out of descriptions: sections, labelled values, form tables, places, surroundings.

Each extractor is a plain function of one text, applied through an Arrow UDF where native expressions can't say it.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from gavelbase.functions import clean
from gavelbase.functions.lazy import arrow_udf
from gavelbase.functions.numerals import HAN, narrow

#: Sections of a description and the headings they go by.
SECTIONS = {
    "拍品名称": ("拍品名称", "标的物名称", "标的名称"),
    "权利来源": ("权利来源", "处置依据", "拍卖依据"),
    "权证情况": ("权证情况",),
    "拍品所有人": ("拍品所有人", "标的物所有人", "标的所有人", "权利人", "产权人"),
    "拍品现状": ("拍品现状", "标的物现状", "标的现状"),
    "租赁情况": ("租赁情况", "租赁或占有情况", "是否出租或承包", "租赁情况/占用情况"),
    "钥匙/占用情况": ("钥匙/占用情况", "钥 匙", "钥匙", "占用情况", "钥匙情况"),
    "户籍/工商注册": ("户籍/工商注册", "户口情况", "户籍情况", "工商注册"),
    "欠费情况": ("欠费情况",),
    "权利限制状况及抵押状况": ("权利限制状况及抵押状况", "权利限制情况", "抵押情况"),
    "成交后提供的文件": ("成交后提供的文件", "成交后提供 的文件", "提供的文件"),
    "拍品介绍": ("拍品介绍", "标的物介绍", "拍卖标的介绍"),
    "房屋权属状况": ("房屋权属状况",),
    "土地权属状况": ("土地权属状况",),
}
#: Fields of a survey form and the labels they go by.
LABELS = {
    "标的物名称": ("标的名称", "拍品名称", "标的物名称", "标的物名称、坐落", "拍卖对象"),
    "权证情况": ("产权证号", "权属证号", "权属证明号码", "权证情况", "不动产证号", "不动产权证书号", "房产证号", "房地产权证号"),
    "被执行人": ("标的所有人", "标的物所有人", "拍品所有人", "权利人", "产权人", "被执行人"),
    "钥匙": ("钥匙", "钥匙情况", "钥匙/占用情况", "占有使用或租赁情况", "占用情况", "租赁情况/占用情况", "使用情况"),
    "腾空情况": ("是否已腾空",),
    "户籍注册": ("户籍/工商注册", "户口情况", "户籍情况", "工商注册"),
    "欠费情况": ("欠费情况", "欠费"),
    "提供文件": ("提供的文件", "成交后提供的文件"),
    "建筑面积": ("建筑面积", "建筑总面积", "建筑面积合计", "房屋建筑面积", "证载建筑面积", "面积"),
    "总层数": ("房屋总层数", "总层数", "总楼层", "建筑物总层数", "建筑物总高"),
    "房屋类型": ("房屋类型", "性质", "房屋性质"),
    "房屋用途": ("房屋用途", "用途", "规划用途", "使用性质"),
    "所在层": ("所在楼层", "所在层", "所在层数", "所在楼层/总楼层", "所在层数/总层数", "楼层", "房屋楼层", "层次"),
    "竣工时间": ("房产年龄", "建筑年份", "竣工时间", "竣工日期", "竣工时期", "建成时间", "建成年份", "建成年代", "建成年月", "建筑年代", "房屋建筑年代"),
    "购买时间": ("购买时间", "购买日期", "购置时间", "取得时间", "取得日期"),
    "核准日期": ("询价反馈日期", "议价反馈日期", "核准日期"),
    "所有权来源": ("所有权来源", "所有权取得方式", "转移方式", "取得方式"),
    "土地用途": ("土地用途",),
    "土地性质": ("土地性质", "权利性质"),
    "使用期限": ("使用期限", "宗地使用期限", "土地使用年限"),
    "权利来源": ("拍卖依据", "拍卖依据文号", "案号", "案 号"),
    "权利限制状况及抵押状况": ("权利限制情况", "权利限制状况及抵押状况", "抵押情况"),
}
#: Words of surroundings.
SURROUNDING = ("周边配套", "周边情况", "周边环境", "周边状况", "区位状况", "区位情况", "配套情况", "生活配套", "公共配套")
TRAFFIC = ("交通", "公交", "地铁", "车站", "高速", "道路", "路网", "出行", "便捷")
SERVICES = ("学校", "幼儿园", "小学", "中学", "医院", "卫生所", "诊所", "银行", "商场", "超市", "市场", "商业", "百货", "酒店")
SETTING = ("绿地", "环境", "景观", "居住氛围", "居住环境", "自然及人文环境", "成熟社区")

_plain = lambda s: re.sub(r"[\s：:；;，,。.、]+", "", s or "")
_FIELD = {_plain(a): f for f, names in LABELS.items() for a in names}
_HEADING = {a: s for s, names in SECTIONS.items() for a in names}
_HEADINGS = re.compile(r"(?:^|(?<=[\n。；;]))[ \t]*(" + "|".join(re.escape(a) for a in sorted(_HEADING, key=len, reverse=True)) + r")[ \t]*(?:[：:]|(?=\n))")


def sections(text: str | None) -> dict[str, str]:
    """Section to its text: from its heading to the next; the first of each counts."""
    out: dict[str, str] = {}
    text = text or ""
    found = list(_HEADINGS.finditer(text))
    for m, after in zip(found, [*found[1:], None]):
        body = text[m.end() : after.start() if after else len(text)].strip()
        if body:
            out.setdefault(_HEADING[m.group(1)], body)
    return out


def labelled(text: str | None) -> dict[str, str]:
    """Field to value for ``label：value`` parts of lines and for values on the line after a label; the first said value counts."""
    out: dict[str, str] = {}
    lines = [x.strip() for x in (text or "").split("\n")]
    for k, line in enumerate(lines):
        parts = [p for p in re.split(r"[；;。|\t]|\s{2,}", line) if p.strip()]
        for p in parts:
            name, colon, value = p.partition("：") if "：" in p else p.partition(":")
            field = _FIELD.get(_plain(name))
            if field and not colon and k + 1 < len(lines) and len(parts) == 1:
                value = lines[k + 1] if _plain(lines[k + 1]) not in _FIELD else ""
            if field and value.strip() and value.strip() not in ("/", "无"):
                out.setdefault(field, value.strip())
    return out


def form_rows(rows: list[list[str]] | None) -> dict[str, str]:
    """Field to value of a form: a label's value is what follows it in its row up to the next label; ``/`` and ``无`` say nothing. A row of three
    labels and more is a header, and the next row that begins with a number (or has as many cells) gives the values."""
    out: dict[str, str] = {}
    rows = [[(c or "").strip() for c in r] for r in rows or []]
    for k, row in enumerate(rows):
        fields = [_FIELD.get(_plain(c)) for c in row]
        if sum(f is not None for f in fields) >= 3 and all(f is not None or re.fullmatch(r"序号|编号|备注|", c) for f, c in zip(fields, row)):
            for values in rows[k + 1 : k + 4]:
                if len(values) == len(row) and not re.search("合计|小计|总计", values[0]) and (re.match(rf"[\d{HAN}]", values[0]) or not any(_FIELD.get(_plain(v)) for v in values)):
                    for f, v in zip(fields, values):
                        if f and v and v not in ("/", "无"):
                            out.setdefault(f, v)
                    break
            continue
        current, value = None, []
        for c, f in [*zip(row, fields), ("", "end")]:
            if f:
                said = " ".join(x for x in value if x)
                if current and said and said not in ("/", "无"):
                    out.setdefault(current, said)
                current, value = f, []
            else:
                value.append(c)
    return out


_N, _HN = r"[0-9]+(?:\.[0-9]+)?", "[0-9一二三四五六七八九十百]+"
#: Patterns of a field in running text, one group each, the surest first. None needs to look around, so they run in any engine.
TIERS = {
    "建筑面积": (
        rf"(?:^|[^下摊内地用])(?:建筑 ?总 ?面积|建筑 ?面积 ?合计|房屋 ?建筑 ?面积|证载 ?建筑 ?面积|建筑 ?面积)(?:合计|共计|约|为|是|计)? ?[:：]? ?({_N}) ?(?:平方米|平米|㎡|m²|m2)",
        rf"(?:^|[^下摊内地用筑])(?:总)?面积(?:共计|约|为|是|计)? ?[:：]? ?({_N}) ?(?:平方米|平米|㎡)",
    ),
    "所在层": (
        rf"(?:所在 ?楼 ?层|所在 ?层 ?数|所在 ?层|房屋 ?楼 ?层|楼层|层次)(?: ?[/／] ?(?:总楼层|总层数))?(?:为|是)? ?[:：]? ?第? ?(-?{_HN})(?: ?[-至到] ?{_HN})? ?(?:层|楼|F|/)",
        rf"(?:标的|房屋)(?:位于|坐落于|处于|为|在) ?第? ?({_HN}) ?(?:层|楼|F)",
        rf"(?:位于|对象位于|住)[^，,。；;]{{0,20}}?第 ?({_HN}) ?(?:层|楼|F)",
        rf"(?:总|共) ?{_HN} ?(?:层|楼|F)[ ，,、；;]*第? ?({_HN}) ?(?:层|楼|F)",
        r"(?:所在位置|楼宇位置)[^；;，,。]{0,60}?([0-9]+) ?层",
    ),
    "总层数": (
        rf"(?:总层数|总楼层|建筑物总高|总高|共)(?:为|计)? ?[:：]? ?({_HN}) ?(?:层|楼|F)",
        rf"总 ?({_HN}) ?(?:层|楼|F)",
        rf"({_HN}) ?层[^，,。；;建]{{0,14}}?(?:住宅楼|商住楼|楼房|混合结构|钢混|砖混)",
        rf"(?:所在 ?楼 ?层|所在 ?层|楼层|层次)[^，,。；;/]{{0,12}}/ ?({_HN}) ?(?:层|楼|F)?",
    ),
    "竣工时间": (
        r"(?:竣工|建成) ?(?:时间|日期|时期|年份|年代|年月)(?:为|是)? ?[:：]? ?([0-9]{4}(?: ?年(?: ?[0-9]{1,2} ?月(?: ?[0-9]{1,2} ?日)?)?|-[0-9]{1,2}(?:-[0-9]{1,2})?)?)",
        r"建筑 ?年 ?代(?:为|是)? ?[:：]? ?([0-9]{4})",
        r"(?:建成于|建于) ?([0-9]{4}(?: ?年(?: ?[0-9]{1,2} ?月)?)?)",
    ),
}


def inline_fields(c: Column) -> Column:
    """Area, floor, number of floors and year of building named in running text, as a map of what is found: of each field the first tier that matches. Native."""
    s = clean.one_line(c)
    first = lambda tiers: F.coalesce(*(F.when(s.rlike(p), F.regexp_extract(s, p, 1)) for p in tiers), F.lit(""))
    found = F.array(*(F.struct(F.lit(f).alias("k"), first(tiers).alias("v")) for f, tiers in TIERS.items()))
    return F.map_from_entries(F.filter(found, lambda x: x["v"] != ""))


def inline(text: str | None) -> dict[str, str]:
    """The same of one text."""
    s = re.sub(r"\s+", " ", narrow(text or "")).strip()
    found = {f: next((m.group(1) for p in tiers if (m := re.search(p, s))), "") for f, tiers in TIERS.items()}
    return {f: v for f, v in found.items() if v}


def description(text: str | None) -> dict[str, str]:
    """All fields of a description: labelled values, then those of running text, then sections."""
    out = labelled(text)
    for more in (inline(text), sections(text)):
        for k, v in more.items():
            out.setdefault(k, v)
    return out


#: A province whose addresses are read by its cities' names, and these.
KNOWN_CITIES = {"广东": ("广州市", "深圳市", "珠海市", "汕头市", "佛山市", "韶关市", "湛江市", "肇庆市", "江门市", "茂名市", "惠州市", "梅州市", "汕尾市", "河源市", "阳江市", "清远市", "东莞市", "中山市", "潮州市", "揭阳市", "云浮市")}
#: Cities without districts, where such a name is none.
UNDIVIDED = ("东莞市", "中山市")
#: Provinces by their full form, of which the first are cities of their own.
PROVINCE = r"^((?:北京|天津|上海|重庆)市|(?:内蒙古|广西|宁夏|新疆|西藏)自治区|(?:香港|澳门)特别行政区|[一-龥]{2,8}省)"
OWN_CITIES = ("北京市", "天津市", "上海市", "重庆市")
_PARTED = "省市区县镇乡街道盟旗 "


def _named_to(s: Column, ending: str) -> Column:
    """What stands between the last sign that parts names and the first place of an ending; null if that is nothing."""
    before = F.substring_index(s, ending, 1)
    name = F.regexp_extract(before, f"([^{_PARTED}]*)$", 1)
    return F.when((F.instr(s, ending) > 1) & (name != ""), F.concat(name, F.lit(ending)))


def let(value: Column, f) -> Column:
    """f of a value that is worked out once however often f names it."""
    return F.element_at(F.transform(F.array(value), lambda v: f(v)), 1)


def region_parts(address: Column) -> Column:
    """Province, city and county of an address as a struct, all native: by the cities' names in a known province, else by the names' endings."""

    def parts(s: Column, province: Column, city: Column) -> Column:
        named = F.coalesce(*(_named_to(s, e) for e in ("区", "县", "市", "旗")), F.lit(""))
        return F.struct(province.alias("province"), city.alias("city"), F.when(named != city, named).otherwise(F.lit("")).alias("county"))

    def by_endings(s: Column) -> Column:
        full = F.regexp_extract(s, PROVINCE, 1)
        return let(F.when(full != "", full).otherwise(F.regexp_extract(s, "^([一-龥]{2,3})[一-龥]{2,6}市", 1)), lambda province: by_province(s, province))

    def by_province(s: Column, province: Column) -> Column:
        first = F.regexp_extract(F.substring(s, F.length(province) + 1, F.length(s)), "^([一-龥]{2,12}市)", 1)
        city = F.when(first != "", first).when(province.isin(*OWN_CITIES), province).otherwise(F.coalesce(*(_named_to(s, e) for e in ("市", "自治州", "地区", "盟")), F.lit("")))
        return let(city, lambda c: parts(s, province, c))

    def by_names(s: Column, name: str, known: Column) -> Column:
        behind = F.substring(s, F.position(known, s) + F.length(known), F.length(s))
        wide = F.regexp_extract(behind, "^([一-龥]{1,12}(?:区|县|市|旗|镇|街道))", 1)
        near = F.regexp_extract(behind, "^([一-龥]{1,12}(?:区|县|市|旗))", 1)
        none = lambda own: (known.isin(*UNDIVIDED) & ((own == known) | own.contains("名下位于"))) | own.startswith(known) | own.contains("位于")
        county = let(F.when(wide.rlike("(街道|镇)$") & (near != ""), near).otherwise(wide), lambda own: F.when(none(own), F.lit("")).otherwise(own))
        return F.struct(F.lit(name).alias("province"), known.alias("city"), county.alias("county"))

    def whole(s: Column) -> Column:
        out = by_endings(s)
        for name, cities in KNOWN_CITIES.items():
            known = F.when(s.startswith(name), F.coalesce(*(F.when(s.contains(c), F.lit(c)) for c in cities)))
            out = let(known, lambda k, rest=out, name=name: F.when(k.isNotNull(), by_names(s, name, k)).otherwise(rest))
        return out

    return let(F.coalesce(clean.tidy_lines(address), F.lit("")), whole)


def label_section(text: str | None, labels: tuple[str, ...] = SURROUNDING, limit: int = 500) -> str:
    """What stands under one of the labels: the rest of its line, else the lines up to a blank one or the next heading."""
    lines = [x.strip() for x in (text or "").split("\n")]
    stop = set(_HEADING) | set(SURROUNDING)
    for k, line in enumerate(lines):
        m = re.match("(?:" + "|".join(map(re.escape, labels)) + r")\s*[：:]?\s*(.*)$", line)
        if not m:
            continue
        kept = [m.group(1)] if m.group(1) else []
        for after in lines[k + 1 :]:
            if kept and (not after or after.rstrip("：:") in stop or m.group(1)):
                break
            if after:
                kept.append(after)
        if kept:
            return re.sub(r"\s+", " ", " ".join(kept))[:limit]
    return ""


@arrow_udf("map<string,string>")
def description_fields(c: pd.Series) -> pd.Series:
    return c.map(description)


@arrow_udf("map<string,string>")
def section_fields(c: pd.Series) -> pd.Series:
    return c.map(sections)


@arrow_udf("map<string,string>")
def form_fields(c: pd.Series) -> pd.Series:
    return c.map(lambda rows: form_rows([list(r) for r in rows] if rows is not None else None))


def surroundings(c: Column) -> Column:
    """Sentences on traffic, services and setting, and the words met: a struct, all native."""
    picked = lambda words, most: F.array_join(clean.keyword_sentences(c, list(words), most), "；")
    words = sorted({*SURROUNDING, *TRAFFIC, *SERVICES, *SETTING})
    return F.struct(picked(TRAFFIC, 3).alias("traffic"), picked(SERVICES, 4).alias("services"), picked(SETTING, 3).alias("setting"), F.array_join(clean.keyword_hits(c, words, 30), "、").alias("words"))
