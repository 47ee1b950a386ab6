"""Landed JSON of list pages, details, map services and region trees as typed rows.

Each reader takes a table of landed documents (a JSON text, call wrappers allowed) and selects its fields with native JSON expressions; a
document that can't be read gives no rows, or an error text where calls are reported one by one. Numbers come as numbers, times as text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelbase.functions import clean, pieces
from gavelbase.functions.text import non_blank, norm_id

_ITEM = "array<map<string,string>>"
#: The answer's first word where a call went well.
CALL_OK = "SUCCESS::调用成功"


def _get(item: Column, *keys: str) -> Column:
    """The first of the keys' values that says something, as text."""
    return F.coalesce(*(non_blank(F.try_element_at(item, F.lit(k))) for k in keys), F.lit(""))


def _items(pages: DataFrame, body: str, paths: tuple[str, ...], keep: list[str]) -> DataFrame:
    found = F.coalesce(*(F.from_json(F.get_json_object(clean.jsonp(F.col(f"`{body}`")), p), _ITEM) for p in paths))
    return pages.select(*(F.col(f"`{c}`") for c in keep), F.posexplode(found).alias("pos", "item"))


def _yuan(item: Column, *keys: str) -> Column:
    return clean.number(_get(item, *keys))


def first_index(pages: DataFrame, body: str = "body", keep: list[str] = ()) -> DataFrame:
    """Rows of the first platform's list pages: ids and links, place, prices in yuan and as shown, counters, times, labels."""
    x, i = _items(pages, body, ("$.datas", "$.data", "$"), list(keep)), F.col("item")
    own = norm_id(_get(i, "id"))
    return x.select(
        *keep, own.alias("标的物ID"), F.when(own != "", F.concat(F.lit("https://paimai.jd.com/"), own)).otherwise("").alias("链接"), _get(i, "title").alias("标题"), _get(i, "city", "courtCityName").alias("城市"), _get(i, "productAddress").alias("地址"), _get(i, "shopName").alias("处置机构"),
        _get(i, "currentPriceCN", "currentPriceWithUnit", "currentPriceStr").alias("当前价"), _yuan(i, "currentPrice").alias("当前价_元"), _yuan(i, "minPrice").alias("起拍价_元"), _get(i, "assessmentPriceCN", "assessmentPriceStr").alias("评估价"), _yuan(i, "assessmentPrice").alias("评估价_元"), _yuan(i, "marketPrice").alias("市场价_元"), _yuan(i, "ensurePrice").alias("保证金_元"),
        clean.whole(_get(i, "bidCount")).alias("出价次数"), clean.whole(_get(i, "accessNumber", "uvCount")).alias("围观次数"), clean.epoch_text(_get(i, "startTimeMills", "startTime")).alias("开始时间"), clean.epoch_text(_get(i, "endTimeMills", "endTime")).alias("结束时间"), _get(i, "labelSet").alias("labelSet"), _get(i, "skuId").alias("skuId"), _get(i, "publishSource").alias("publishSource"),
    )


def second_pages(pages: DataFrame, body: str = "body", keep: list[str] = ()) -> DataFrame:
    """Each page's ok, error, total, page, page_size and items (JSON): the scene's payload unwrapped; a page without a scene is an empty first one."""
    b = clean.jsonp(F.col(f"`{body}`"))
    ok = F.coalesce(F.get_json_object(b, "$.ret[0]") == CALL_OK, F.lit(False))
    scheme = F.get_json_object(b, "$.data.data.scenes[0].schemeList[0]")
    whole = lambda p, default: F.coalesce(clean.whole(F.get_json_object(scheme, p)), F.lit(default)).cast("bigint")
    size = whole("$.pageSize", 10)
    return pages.select(*keep, ok.alias("ok"), F.when(~ok, F.concat(F.lit("call failed: "), F.coalesce(F.get_json_object(b, "$.ret"), F.substring(b, 1, 80), F.lit("")))).alias("error"), whole("$.totalCount", 0).alias("total"), whole("$.page", 1).alias("page"), F.when(size > 0, size).otherwise(10).alias("page_size"), F.coalesce(F.get_json_object(scheme, "$.contentList"), F.lit("[]")).alias("items"))


def second_index(pages: DataFrame, body: str = "body", keep: list[str] = ()) -> DataFrame:
    """Rows of the second platform's good list pages: ids and links, prices (landed in cents) in yuan, coordinates, tags, times."""
    good = second_pages(pages, body, list(keep)).where("ok")
    x, i = _items(good, "items", ("$",), list(keep)), F.col("item")
    own = norm_id(_get(i, "itemId"))
    link = F.when(own != "", F.concat(F.lit("https://sf-item.taobao.com/sf_item/"), own, F.lit(".htm"))).otherwise("")
    at = pieces.lon_lat(F.regexp_replace(_get(i, "coordinate"), r'[\[\]"]', " "))
    extra = F.from_json(_get(i, "extraMap"), "map<string,string>")
    return x.select(
        *keep, own.alias("标的物ID"), link.alias("链接"), _get(i, "title").alias("标题"), _get(i, "locationCode").alias("locationCode"), _get(i, "shopName").alias("处置机构"),
        clean.cents(_get(i, "currentPrice")).alias("当前价_元"), clean.cents(_get(i, "initialPrice")).alias("起拍价_元"), clean.cents(_get(extra, "bail")).alias("保证金_元"), clean.cents(_get(i, "consultPrice")).alias("评估价_元"), clean.cents(_get(i, "marketPrice")).alias("市场价_元"),
        clean.whole(_get(i, "pv")).alias("围观次数"), clean.whole(_get(i, "bidCnt")).alias("出价次数"), clean.epoch_text(_get(i, "startTime")).alias("开始时间"), clean.epoch_text(_get(i, "endTime")).alias("结束时间"), at["lon"].alias("经度"), at["lat"].alias("纬度"), F.array_join(F.array_distinct(pieces.tag_names(_get(i, "tags"))), "、").alias("标签"), clean.url(_get(i, "picURL")).alias("图片链接"), _get(extra, "hArea").alias("hArea_raw"),
    )


def id_chunks(ids: DataFrame, key: str, size: int = 200) -> DataFrame:
    """chunk and ids (joined) of so many ids at most, for calls that take several: chunks by a hash of the id, so none is filled in one task."""
    n = ids.agg(F.ceil(F.count("*") / (size * 0.5)).alias("n"))
    part = ids.select(F.col(f"`{key}`").cast("string").alias("id")).distinct().crossJoin(F.broadcast(n)).withColumn("part", F.pmod(F.xxhash64("id"), F.greatest("n", F.lit(1))))  # one row is joined
    listed = part.groupBy("part").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("ids") - 1) / size)), lambda k: F.slice("ids", (k * size + 1).cast("int"), size))
    return listed.select("part", F.posexplode(cut).alias("k", "own")).select(F.concat_ws("-", "part", "k").alias("chunk"), F.array_join("own", ",").alias("ids"), F.size("own").alias("n"))


def configs(pages: DataFrame, body: str = "body") -> DataFrame:
    """A row for each item of the configuration call's map: 标的物ID and its settings as a map."""
    m = F.from_json(F.coalesce(F.get_json_object(clean.jsonp(F.col(f"`{body}`")), "$.data"), clean.jsonp(F.col(f"`{body}`"))), "map<string,string>")
    return pages.select(F.explode(m).alias("k", "v")).select(norm_id(F.col("k")).alias("标的物ID"), F.from_json("v", "map<string,string>").alias("config"))


def detail_calls(calls: DataFrame, key: str, kind: str, body: str, wanted: tuple[str, ...]) -> DataFrame:
    """A row for each listing: a column of each wanted call's body (the latest by ``_at``), ``errors`` (which calls lack one or can't be read) and ``status``: 成功, 部分成功 or 失败."""
    good = F.when(F.from_json(clean.jsonp(F.col(f"`{body}`")), "map<string,string>").isNotNull() | F.col(f"`{body}`").rlike(r"^\s*(<|\[)"), F.col(f"`{body}`"))
    per = calls.groupBy(F.col(f"`{key}`")).agg(*(F.max_by(good, F.when((F.col(f"`{kind}`") == k) & good.isNotNull(), F.col("_at"))).alias(k) for k in wanted))
    failed = F.array_compact(F.array(*(F.when(F.col(k).isNull(), F.lit(k)) for k in wanted)))
    return per.withColumn("errors", F.array_join(failed, "；")).withColumn("status", F.when(F.size(failed) == 0, "成功").when(F.size(failed) < len(wanted), "部分成功").otherwise("失败"))


def geocodes(answers: DataFrame, body: str = "body", keep: list[str] = ()) -> DataFrame:
    """The best place of a geocoder's answer: lon, lat, province, city, district, found."""
    b = clean.jsonp(F.col(f"`{body}`"))
    first = F.coalesce(F.get_json_object(b, "$.geocodes[0]"), F.get_json_object(b, "$.result"), F.get_json_object(b, "$[0]"))
    part = lambda *paths: F.coalesce(*(non_blank(F.get_json_object(first, p)) for p in paths), F.lit(""))
    at = pieces.lon_lat(part("$.location"))
    lon, lat = (F.coalesce(clean.number(F.coalesce(*(F.get_json_object(first, p) for p in ps))), v) for ps, v in ((("$.location.lng", "$.lon"), at["lon"]), (("$.location.lat", "$.lat"), at["lat"])))
    return answers.select(*keep, lon.alias("lon"), lat.alias("lat"), part("$.province", "$.addressComponent.province").alias("province"), part("$.city", "$.addressComponent.city").alias("city"), part("$.district", "$.addressComponent.district").alias("district"), (lon.isNotNull() & lat.isNotNull()).alias("found"))


def map_elements(answers: DataFrame, body: str = "body") -> DataFrame:
    """Elements of a map service's answers, each once: poi_id, lat, lon, center and tags, as the nearest search takes them."""
    one = "array<struct<id bigint, lat double, lon double, center struct<lat double, lon double>, tags map<string,string>>>"
    x = answers.select(F.explode(F.from_json(F.get_json_object(clean.jsonp(F.col(f"`{body}`")), "$.elements"), one)).alias("e"))
    return x.select(F.col("e.id").alias("poi_id"), "e.lat", "e.lon", "e.center", F.coalesce("e.tags", F.create_map().cast("map<string,string>")).alias("tags")).dropDuplicates(["poi_id"])


def first_path(spark: SparkSession, *paths: str) -> str:
    """The first of the paths that is there and isn't empty."""
    conf = spark._jsc.hadoopConfiguration()
    for p in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = at.getFileSystem(conf)
        if fs.exists(at) and fs.getContentSummary(at).getLength() > 0:
            return p
    raise FileNotFoundError(f"none of {paths}")


def newest_path(spark: SparkSession, pattern: str) -> str | None:
    """The path of a pattern that was written last; of equal times the last by name."""
    at = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []
    best = max(((f.getModificationTime(), f.getPath().toString()) for f in found), default=None)
    return best[1] if best else None


def page_fields(page_text: Column, labels: dict[str, str]) -> Column:
    """Fields of a page's text by patterns with one group, as a map of what is found."""
    found = [F.struct(F.lit(f).alias("k"), F.coalesce(F.regexp_extract(page_text, p, 1), F.lit("")).alias("v")) for f, p in labels.items()]
    return F.map_from_entries(F.filter(F.array(*found), lambda x: x["v"] != ""))


#: A bidding block's fields, digits without separators.
BID_BLOCK = {"起拍价": r"起拍价[：:\s]*[¥￥]?\s*([0-9.]+)", "保证金": r"保证金[：:\s]*[¥￥]?\s*([0-9.]+)", "加价幅度": r"(?:加价幅度|加幅)[：:\s]*[¥￥]?\s*([0-9.]+)", "评估价": r"评估价[：:\s]*[¥￥]?\s*([0-9.]+)", "竞价周期": r"竞价周期[：:\s]*([0-9]+\s*[天日小时]+)", "延时周期": r"延时周期[：:\s]*([0-9]+\s*[分钟次/]+)"}


def bid_block(page_text: Column) -> Column:
    return page_fields(F.regexp_replace(page_text, "[,，]", ""), BID_BLOCK)


def union_logs(frames: list[DataFrame], key: str, done: Column) -> DataFrame:
    """Ids that any of the logs has finished, each once."""
    return reduce(DataFrame.unionByName, (f.where(F.coalesce(done, F.lit(False))).select(norm_id(F.col(f"`{key}`")).alias("id")) for f in frames)).where("id <> ''").distinct()
