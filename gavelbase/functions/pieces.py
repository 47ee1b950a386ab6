"""Pieces of landed texts and JSON: windows around words, labelled amounts, coordinates, links, attachments, bids, maps. All native column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gavelbase.functions import clean
from gavelbase.functions.text import is_blank, non_blank, strip

_AMOUNT = r"([0-9][0-9,，]*(?:\.[0-9]+)?\s*(?:万元|万|元)?)"
#: Keys by which attachments name their parts.
ATTACHMENT_KEYS = {"title": ("title", "name", "fileName", "attachmentName"), "id": ("id", "fileId", "attachmentId"), "url": ("url", "href", "downloadUrl", "attachmentAddress")}
#: Parts of links that are no photographs.
NO_PHOTO = ("logo", "icon", "qrcode", "二维码", "tps-", "tb1", "png")
#: What is cut off an address before it is looked up, in this order.
ADDRESS_CUTS = (r".*?名下位于", r".*?位于", r"的不动产.*$", r"房产一处.*$", r"房产.*$", r"住宅.*$", r"[（(].*?[)）]")


def windows(c: Column, words: list[str], before: int, after: int, most: int) -> Column:
    """The text around the first place of each word, in the words' order, white space collapsed, each once, the first ``most`` of them joined."""

    def around(word: str) -> Column:
        at = F.locate(word, c)
        start = F.greatest(at - before, F.lit(1))
        return F.when(at > 0, clean.one_line(F.substring(c, start, at + after - start)))

    found = F.array_distinct(F.filter(F.array_compact(F.array(*map(around, words))), lambda x: x != ""))
    return F.array_join(F.slice(found, 1, most), "；")


def amount(c: Column) -> Column:
    """Yuan of a short text: its first number, times 10 000 where the text says 万; null unless above zero."""
    n = clean.first_number(c) * F.when(c.contains("万"), 10_000.0).otherwise(1.0)
    return F.when(n > 0, F.round(n, 2))


def amount_between(c: Column, low: float = 1e3, high: float = 1e11) -> Column:
    """As :func:`amount`, only within the bounds."""
    n = amount(c)
    return F.when(n.between(low, high), n)


def labelled_amount(c: Column, labels: list[str], low: float = 0.0, high: float = float("inf")) -> Column:
    """Yuan behind the first of the labels whose amount lies within the bounds."""
    pattern = "(?:" + "|".join(labels) + r")(?:合计|总计|总额|为|是|：|:|\s)*(?:人民币|约)?\s*" + _AMOUNT
    said = F.transform(F.regexp_extract_all(c, F.lit(pattern), 1), amount)
    return F.try_element_at(F.filter(said, lambda x: x.isNotNull() & (x >= low) & (x <= high)), F.lit(1))


def labelled_whole(c: Column, labels: list[str]) -> Column:
    """The whole number behind the first of the labels."""
    found = F.regexp_extract(c, "(?:" + "|".join(labels) + r")\s*[：:为]?\s*([0-9][0-9,]*)", 1)
    return F.regexp_replace(found, ",", "").try_cast("bigint")


def lon_lat(c: Column) -> Column:
    """The first two numbers of a text as a struct lon, lat; null where there are fewer."""
    n = F.filter(F.transform(F.split(c, r"[,，\s()（）]+"), clean.number), lambda x: x.isNotNull())
    return F.when(F.size(n) >= 2, F.struct(F.get(n, 0).alias("lon"), F.get(n, 1).alias("lat")))


def bid_yuan(price: Column, reference: Column) -> Column:
    """A bid that may be in cents: it is if it exceeds ten times the reference, or if there is none."""
    return F.when((reference > 0) & (price <= reference * 10), price).otherwise(F.round(price / 100, 2))


def dotted_day(c: Column) -> Column:
    return F.try_to_timestamp(strip(c), F.lit("yyyy.MM.dd")).cast("date")


def lookup_address(c: Column) -> Column:
    """An address as it is looked up: introductions, kinds of property and brackets cut off, no white space; the text itself where nothing is left."""
    s = reduce(lambda x, pattern: F.regexp_replace(x, pattern, ""), ADDRESS_CUTS, clean.tidy_lines(c))
    s = F.regexp_replace(s, r"\s+", "")
    return F.when(s != "", s).otherwise(clean.tidy_lines(c))


def with_region(address: Column, *region: Column) -> Column:
    """An address with the parts of its region that it lacks before it, unless it names one by its kind; parts come once."""
    parts = F.array_distinct(F.array_compact(F.array(*(F.when(~is_blank(r) & ~address.contains(strip(r)), strip(r)) for r in region))))
    own = F.coalesce(reduce(lambda a, b: a | b, (address.contains(x) for x in ("省", "市", "自治区", "特别行政区"))), F.lit(False))
    return F.when(is_blank(address), F.lit("")).when(own | (F.size(parts) == 0), address).otherwise(F.concat(F.array_join(parts, ""), address))


def digest(fields: dict[str, Column]) -> Column:
    """A line ``label：value`` for each field that says something."""
    return F.array_join(F.array_compact(F.array(*(F.when(~is_blank(v), F.concat(F.lit(k + "："), strip(v))) for k, v in fields.items()))), "\n")


def joined_pairs(fields: dict[str, Column]) -> Column:
    """``label:value`` of the fields that say something, joined."""
    return F.array_join(F.array_compact(F.array(*(F.when(~is_blank(v), F.concat(F.lit(k + ":"), strip(v))) for k, v in fields.items()))), "；")


def links_of_ids(links: Column, ids: Column, prefix: str) -> Column:
    """The links as they are, else one made of each id."""
    made = F.array_join(F.transform(clean.split_joined(ids), lambda x: F.concat(F.lit(prefix), x)), "；")
    return F.coalesce(non_blank(links), made, F.lit(""))


def photo_links(links: Column) -> Column:
    """Links of an array that may be photographs, with a scheme, each once and in order."""
    full = F.transform(F.filter(links, lambda x: ~is_blank(x)), lambda x: F.when(strip(x).startswith("//"), F.concat(F.lit("https:"), strip(x))).otherwise(strip(x)))
    return F.array_distinct(F.filter(full, lambda x: ~reduce(lambda a, b: a | b, (F.lower(x).contains(w) for w in NO_PHOTO))))


def first_said_map(*maps: Column) -> Column:
    """One map of several: for each key the first value that says something; keys without one are left out."""
    none = F.create_map().cast("map<string,string>")
    merged = reduce(lambda a, b: F.map_zip_with(F.coalesce(a, none), F.coalesce(b, none), lambda k, x, y: F.coalesce(non_blank(x), y)), maps)
    return F.map_filter(F.transform_values(F.coalesce(merged, none), lambda k, v: non_blank(v)), lambda k, v: v.isNotNull())


def compact_json(c: Column, empty: Column) -> Column:
    """JSON of a struct, map or array; empty text where it is null or ``empty``."""
    return F.when(c.isNull() | empty, F.lit("")).otherwise(F.to_json(c))


def attachments(payload: Column) -> Column:
    """Array of title, id, fileType and url of a payload's attachments, whichever keys it uses; empty where there are none."""
    item = "array<map<string,string>>"
    raw = [F.from_json(F.get_json_object(clean.jsonp(payload), p), item) for p in ("$.data.attaches", "$.data.attachments", "$.data.files", "$.data")]
    some = F.coalesce(*(F.when(F.size(x) > 0, x) for x in raw), F.array().cast(item))
    pick = lambda m, keys: F.coalesce(*(non_blank(F.try_element_at(m, F.lit(k))) for k in keys), F.lit(""))
    return F.transform(some, lambda m: F.struct(pick(m, ATTACHMENT_KEYS["title"]).alias("title"), pick(m, ATTACHMENT_KEYS["id"]).alias("id"), pick(m, ("fileType",)).alias("file_type"), clean.url(pick(m, ATTACHMENT_KEYS["url"])).alias("url")))


def attachment_summary(items: Column) -> Column:
    """Count, names, ids and links of attachments, joined, as a struct."""
    said = lambda part: F.array_join(F.filter(F.transform(items, lambda x: x[part]), lambda x: x != ""), "；")
    return F.struct(F.size(items).alias("n"), said("title").alias("names"), said("id").alias("ids"), said("url").alias("links"))


def best_bid(records: Column) -> Column:
    """The highest, then latest, of the bids that closed the deal, else of all. records: array of struct status, price, time."""
    deals = F.filter(records, lambda x: F.coalesce(x["status"] == "deal", F.lit(False)))
    pool = F.when(F.size(deals) > 0, deals).otherwise(records)
    ranked = F.transform(pool, lambda x: F.struct(F.coalesce(x["price"], F.lit(0.0)).alias("p"), F.coalesce(x["time"], F.lit(0)).alias("t"), x.alias("x")))
    return F.array_max(ranked)["x"]


def tag_names(tags: Column) -> Column:
    """The names of a JSON list of tags: of each the alias, else the name, blank ones left out."""
    items = F.from_json(tags, "array<map<string,string>>")
    return F.filter(F.transform(items, lambda m: F.coalesce(non_blank(F.try_element_at(m, F.lit("alias"))), non_blank(F.try_element_at(m, F.lit("name"))))), lambda x: x.isNotNull())


#: Patterns of a loan's details.
LENDER = r"([一-鿿]{2,24}(?:银行|金融|担保|贷款)[一-鿿]{0,16})"
LOAN_SHARE = r"(?:最高可贷|可贷比例|贷款成数)[^0-9一二三四五六七八九十]{0,20}([0-9一二三四五六七八九十]{1,3}\s*(?:成|%|％))"
LOAN_RATE = r"(?:参考利率|利率)[^0-9]{0,20}([0-9]+(?:\.[0-9]+)?\s*[%％])"


def loan_details(c: Column) -> Column:
    """Lender, share and rate that a text names, as a struct; blank where it doesn't."""
    found = lambda pattern: F.coalesce(F.regexp_replace(F.regexp_extract(c, pattern, 1), " ", ""), F.lit(""))
    return F.struct(found(LENDER).alias("lender"), found(LOAN_SHARE).alias("share"), found(LOAN_RATE).alias("rate"))


def rights_passages(c: Column) -> Column:
    """The passages on rights, house and land of a notice, each up to the next heading, as a struct; blank where there is none."""
    part = lambda head, stop, group=1: strip(F.regexp_extract(c, rf"(?s){head}[:：]?\s*(.+?)(?:{stop}|$)", group))
    rights = part("(?:权利限制状况及\\s*抵押状况|权利限制情况|抵押情况)", "成交后提供|拍品介绍|房屋权属状况|土地权属状况")
    house = part("房屋权属状况", "土地权属状况|2、土地权属状况|土地宗地号")
    other = part("(?:标的物名称、坐落|标的物情况|房产概况及拍卖标的|拍卖标的物情况)", "特别提示|税、费|竞买人条件|土地使用期限|使用期限")
    land = part("土地权属状况", "特别提示|竞买公告|竞买须知")
    return F.struct(rights.alias("rights"), F.when(house != "", house).otherwise(other).alias("house"), land.alias("land"))
