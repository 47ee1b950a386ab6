"""Queries of the listing operators over the whole tables, each with its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelbase.functions import clean, extract
from gavelbase.functions.text import NARROW, WIDE, is_blank, norm_id, strip, time_seconds
from gavelbase.operators import conform, dedupe, joins, merge, nearest, sequences
from gavelbase.operators.slabs import great_circle
from gavelbase.plans.geo_units_packed import positions
from gavelbase.session import table
from gavelbase.sources.documents import html_parts, json_field
from gavelbase.sources.jsonlines import parse_lines

JD, JDD, MERGE = "jd_auction_spider", "jd_api_detail_backfill", "merge_jd_ali_region_tables"
ALI, ALIT, ALI2, POI = "ali_sf_api_detail_backfill", "ali_sf_attachment_text_backfill", "ali_sf_local_attachment_second_pass", "poi_distance_backfill"
QUERIES: dict = {}
ORACLE: dict = {}

_WORDS = "('', '-', '--', '/', 'nan', 'none', 'null', 'n/a', '未知', '无', '暂无', '不适用', '待核实', '不详')"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^[\\s\\x{{3000}}\\x{{a0}}]+|[\\s\\x{{3000}}\\x{{a0}}]+$', '', 'g')"


def _blank(c: str) -> str:
    return f"({c} is null or lower({_strip(c)}) in {_WORDS})"


def _id(c: str = "标的物ID") -> str:
    narrow = f"translate({c}, '{WIDE}', '{NARROW.replace(chr(39), chr(39) * 2)}')"
    return f"regexp_replace({_strip(narrow)}, '\\.0+$', '')"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


_LISTING = ["标题", "完整地址", "格式化地址", "建筑面积", "所在层", "总层数", "房屋用途", "评估价", "坐标", "交通-地铁站", "附件文本"]
_FULL = " + ".join(f'(not {_blank(chr(34) + c + chr(34))})::int' for c in _LISTING)


@query(f"""select id, row_id, fullness from (select {_id()} as id, row_id, {_FULL} as fullness,
    row_number() over (partition by {_id()} order by {_FULL} desc, row_id) as k from {JD}) where k = 1""")
def dedupe_most_complete(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, JD).select(norm_id(F.col("标的物ID")).alias("id"), "row_id", *map(_q, _LISTING)).withColumn("fullness", dedupe.completeness(_LISTING))
    return dedupe.keep_best(df, F.col("id"), -F.col("fullness"), F.col("row_id")).select("id", "row_id", F.col("fullness").cast("int").alias("fullness"))


@query(f"select {_id()} as id, arg_max(row_id, (epoch_us(ingested_at), row_id)) as row_id from {ALI} group by 1")
def dedupe_keep_last(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, ALI).select(norm_id(F.col("标的物ID")).alias("id"), "row_id", "ingested_at")
    return dedupe.keep_last(df, F.col("id"), F.col("ingested_at"), F.col("row_id")).select("id", "row_id")


_OK = "附件正文抓取状态 = '成功'"
_FIRST = lambda c: f"coalesce(arg_min({c}, row_id) filter ({_OK} and not {_blank(c)}), arg_min({c}, row_id) filter (not {_blank(c)}))"


@query(f"""select {_id()} as id, min(row_id) as first_seen, count(*) as n_rows, {_FIRST('"权证情况"')} as "权证情况", {_FIRST('"房屋用途"')} as "房屋用途" from {ALIT} group by 1""")
def group_reduce_first_said(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, ALIT).withColumn("id", norm_id(F.col("标的物ID")))
    return dedupe.group_reduce(df, "id", ["权证情况", "房屋用途"], F.coalesce(F.col("附件正文抓取状态") == "成功", F.lit(False)), F.col("row_id"))


@query("select origin_key, doc_id, n_copies from (select origin_key, doc_id, count(*) over (partition by origin_key) as n_copies from documents) where n_copies > 1 and origin_key is not null")
def duplicates_keep_all(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.duplicates(table(spark, d, "documents").select("origin_key", "doc_id").where("origin_key is not null"), "origin_key").select("origin_key", "doc_id", "n_copies")


@query("select doc_id, n_copies from (select doc_id, count(*) over (partition by md5(text)) as n_copies from documents where text is not null) where n_copies > 1")
def exact_copies(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "documents").where("text is not null").select("doc_id", F.md5("text").alias("h"))
    return dedupe.duplicates(df, "h").select("doc_id", "n_copies")


@query(f"select {_id()} as key, min(row_id) as first_seen from {JDD} group by 1")
def ordered_distinct_ids(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.ordered_distinct(table(spark, d, JDD), norm_id(F.col("标的物ID")), F.col("row_id"))


@query(f"""select id, string_agg(v, '；' order by o) as joined from (select {_id()} as id, {_strip('"权证情况"')} as v, min(row_id) as o from {ALIT}
    where not {_blank('"权证情况"')} group by 1, 2) group by id""")
def joined_distinct_values(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, ALIT).select(norm_id(F.col("标的物ID")).alias("id"), "row_id", strip(F.col("权证情况")).alias("v"))
    return dedupe.joined_values(df, "id", F.col("v"), F.col("row_id"))


@query(f"select 城市, row_id, rank from (select 城市, row_id, row_number() over (partition by 城市 order by row_id) as rank from {JD}) where rank <= 20")
def sample_first_k(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.first_k(table(spark, d, JD).select("城市", "row_id"), "城市", 20, F.col("row_id")).select("城市", "row_id", "rank")


@query(f"select row_id, ({_FULL}) + 3 * (not {_blank('完整地址')})::int + 4 * (not {_blank('建筑面积')})::int as score from {JD}")
def row_score(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, JD).select("row_id", dedupe.score(_LISTING, {"完整地址": 3, "建筑面积": 4}).cast("int").alias("score"))


_COVER = [*_LISTING, "城市"]


@query(" union all ".join(f"""select '{c}' as field_name, count(*) filter (not {_blank(chr(34) + c + chr(34))} and "{c}" <> '0') as filled,
    round(count(*) filter (not {_blank(chr(34) + c + chr(34))} and "{c}" <> '0') / count(*), 4) as rate from {JD}""" for c in _COVER))
def field_coverage(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.coverage(table(spark, d, JD), _COVER)


@query(f"select 解析状态 as status, count(*) as n, count(distinct {_id()}) as ids, count(distinct 链接) filter (not {_blank('链接')}) as links from {JD} group by 1")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, JD).groupBy(F.col("解析状态").alias("status")).agg(F.count("*").alias("n"), F.countDistinct(norm_id(F.col("标的物ID"))).alias("ids"), F.countDistinct(F.when(~is_blank(F.col("链接")), F.col("链接"))).alias("links"))


_SIGNS = {"建筑面积": "建筑面积为?[0-9.]+", "所在层": "所在层为第[-0-9]+层", "总层数": "总层数[0-9]+层", "交通-地铁站": "轨道交通站点约[0-9]+米"}


@query(" union all ".join(f"""select '{c}' as field_name, count(*) filter ({_blank(chr(34) + c + chr(34))}) as missing,
    count(*) filter ({_blank(chr(34) + c + chr(34))} and regexp_matches(coalesce(附件文本, ''), '{p}')) as with_signal from {JD}""" for c, p in _SIGNS.items()))
def audit_gaps(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.gaps(table(spark, d, JD), {c: (F.coalesce("附件文本", F.lit("")), p) for c, p in _SIGNS.items()})


@query(f"""with v as (select row_id, unnest(string_split_regex(附件正文二次解析更新列, '[；;|,，\n]+')) as x from {ALI2})
    select {_strip('x')} as field_name, count(*) as n from v where {_strip('x')} <> '' group by 1""")
def changed_columns(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, ALI2).select(F.explode(clean.split_joined(F.col("附件正文二次解析更新列"))).alias("field_name")).groupBy("field_name").agg(F.count("*").alias("n"))


_COORD = f"""select row_id, try_cast({_strip('纬度')} as double) as lat, try_cast({_strip('经度')} as double) as lon from {POI}
    where regexp_matches({_strip('纬度')}, '^[0-9]+\\.?[0-9]*$') and regexp_matches({_strip('经度')}, '^[0-9]+\\.?[0-9]*$')"""


@query(f"with c as ({_COORD}) select printf('%.6f,%.6f', lat, lon) as coord_key, count(*) as n from c where lat between 20.0 and 25.8 and lon between 109.0 and 118.0 group by 1")
def coordinate_counts(spark: SparkSession, d: str) -> DataFrame:
    return positions(spark, d).groupBy(clean.coordinate_key(F.col("lat"), F.col("lon")).alias("coord_key")).agg(F.count("*").alias("n"))


_CATS = {"交通-公交站": "tags['highway'] = 'bus_stop' or tags['public_transport'] = 'platform' or tags['amenity'] = 'bus_station'", "教育-小学": "tags['amenity'] = 'school' and (coalesce(tags['name:zh'], tags['name'], tags['name:en']) is null or contains(coalesce(tags['name:zh'], tags['name'], tags['name:en']), '小学'))", "公园-公园": "tags['leisure'] = 'park' or tags['boundary'] = 'protected_area'"}


@query("with e as (select *, coalesce(case when lat is not null and lon is not null then lat end, center.lat) as y, coalesce(case when lat is not null and lon is not null then lon end, center.lon) as x from poi_elements), p as (" + _COORD + ") "
    + " union all ".join(f"""select point_id, category, cast(floor(min(m) + 0.5) as bigint) as metres from (select p.row_id as point_id, '{c}' as category, 2 * 6371000.0 * asin(sqrt(pow(sin((radians(e.y) - radians(p.lat)) / 2), 2)
    + cos(radians(p.lat)) * cos(radians(e.y)) * pow(sin(radians(e.x - p.lon) / 2), 2))) as m from p join e on abs(e.y - p.lat) < 0.05 where coalesce({w}, false)
    and p.lat between 20.0 and 25.8 and p.lon between 109.0 and 118.0) where m <= {nearest.CATEGORIES[c][1]} group by point_id, category""" for c, w in _CATS.items()))
def nearest_by_category(spark: SparkSession, d: str) -> DataFrame:
    got = nearest.nearest(positions(spark, d), table(spark, d, "poi_elements"), list(_CATS))
    return got.select("point_id", "category", F.floor(F.col("distance_m") + 0.5).cast("bigint").alias("metres"))


def _in_category(c: str) -> str:
    tags, _, words = nearest.CATEGORIES[c]
    ok = " or ".join(f"tags['{k}'] in ('yes', 'true', '1')" if v == "yes" else f"tags['{k}'] = '{v}'" for k, v in tags)
    name = "coalesce(tags['name:zh'], tags['name'], tags['name:en'])"
    return f"({ok})" + (f" and ({name} is null or " + " or ".join(f"contains({name}, '{w}')" for w in words) + ")" if words else "")


@query("with e as (select *, coalesce(case when lat is not null and lon is not null then lat end, center.lat) as y, coalesce(case when lat is not null and lon is not null then lon end, center.lon) as x from poi_elements), p as (" + _COORD + ") "
    + " union all ".join(f"""select point_id, category, cast(floor(min(m) + 0.5) as bigint) as metres from (select p.row_id as point_id, '{c}' as category, 2 * 6371000.0 * asin(sqrt(pow(sin((radians(e.y) - radians(p.lat)) / 2), 2)
    + cos(radians(p.lat)) * cos(radians(e.y)) * pow(sin(radians(e.x - p.lon) / 2), 2))) as m from p join e on abs(e.y - p.lat) < 0.05 where coalesce({_in_category(c)}, false)
    and p.lat between 20.0 and 25.8 and p.lon between 109.0 and 118.0) where m <= {nearest.CATEGORIES[c][1]} group by point_id, category""" for c in nearest.CATEGORIES))
def nearest_all_categories(spark: SparkSession, d: str) -> DataFrame:
    got = nearest.nearest(positions(spark, d), table(spark, d, "poi_elements"))
    return got.select("point_id", "category", F.floor(F.col("distance_m") + 0.5).cast("bigint").alias("metres"))


_BASE = f"select id, row_id as base_row, 标题, 评估价 from (select {_id()} as id, *, row_number() over (partition by {_id()} order by row_id) as k from {JD}) where k = 1"
_DET = f"select id, 标的物名称 as 标题, 评估价_详情_元 as 评估价, 详情地址 from (select {_id()} as id, *, row_number() over (partition by {_id()} order by ingested_at desc, row_id desc) as k from {JDD}) where k = 1"


def _base(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, JD).select(norm_id(F.col("标的物ID")).alias("id"), F.col("row_id").alias("base_row"), "标题", "评估价")
    return dedupe.keep_best(df, F.col("id"), F.col("base_row"))


def _detail(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, JDD).select(norm_id(F.col("标的物ID")).alias("id"), F.col("标的物名称").alias("标题"), F.col("评估价_详情_元").alias("评估价"), "详情地址", "ingested_at", "row_id")
    return dedupe.keep_last(df, F.col("id"), F.col("ingested_at"), F.col("row_id")).select("id", "标题", "评估价", "详情地址")


@query(f"with b as ({_BASE}), d as ({_DET}) select b.id, base_row, b.标题, b.评估价, 详情地址 from b left join d using (id)")
def join_base_wins(spark: SparkSession, d: str) -> DataFrame:
    return joins.base_wins(_base(spark, d), _detail(spark, d), "id")


@query(f"with b as ({_BASE}), d as ({_DET}) select b.id, base_row, d.标题, d.评估价, 详情地址 from b left join d using (id)")
def join_detail_wins(spark: SparkSession, d: str) -> DataFrame:
    return joins.detail_wins(_base(spark, d), _detail(spark, d), "id")


@query(f"with b as ({_BASE}), d as ({_DET}) select b.id, base_row, case when d.id is not null then d.标题 else b.标题 end as 标题, case when d.id is not null then d.评估价 else b.评估价 end as 评估价, 详情地址 from b left join d using (id)")
def join_override(spark: SparkSession, d: str) -> DataFrame:
    return joins.override(_base(spark, d), _detail(spark, d), "id")


@query(f"""with b as ({_BASE}), d as ({_DET}) select b.id, base_row, b.标题, case when {_blank('b.评估价')} and not {_blank('d.评估价')} then d.评估价 else b.评估价 end as 评估价,
    case when {_blank('b.评估价')} and not {_blank('d.评估价')} then '评估价' else '' end as changed from b left join d using (id)""")
def fill_blank_only(spark: SparkSession, d: str) -> DataFrame:
    return joins.fill_from(_base(spark, d), _detail(spark, d), "id", {"评估价": "评估价"}).withColumn("changed", F.array_join("changed", "；"))


@query(f"with b as ({_BASE}), d as ({_DET}) select coalesce(d.id, b.id) as id, case when d.id is not null then d.标题 else b.标题 end as 标题, case when d.id is not null then d.评估价 else b.评估价 end as 评估价 from b full join d on b.id = d.id")
def overlay_replace(spark: SparkSession, d: str) -> DataFrame:
    return joins.overlay(_base(spark, d).drop("base_row"), _detail(spark, d).drop("详情地址"), "id")


@query(f"select row_id from {JD} where {_id()} not in (select {_id()} from {JDD} where 详情抓取状态 in ('成功', '部分成功') and 标的物ID is not null)")
def resume_pending(spark: SparkSession, d: str) -> DataFrame:
    key = lambda t: table(spark, d, t).withColumn("id", norm_id(F.col("标的物ID")))
    return joins.pending(key(JD), key(JDD), "id", F.col("详情抓取状态").isin("成功", "部分成功")).select("row_id")


@query(f"select row_id from {JD} where {_id()} in (select {_id()} from {JDD})")
def wanted_only(spark: SparkSession, d: str) -> DataFrame:
    key = lambda t: table(spark, d, t).withColumn("id", norm_id(F.col("标的物ID")))
    return joins.only(key(JD), key(JDD), "id").select("row_id")


@query("select distinct c_nationkey as k from customer except select s_nationkey from supplier where s_suppkey > 50")
def except_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).distinct().join(table(spark, d, "supplier").where("s_suppkey > 50").select(F.col("s_nationkey").alias("k")), "k", "left_anti")


@query("select distinct c_nationkey as k from customer except select s_nationkey from supplier")
def except_all_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).distinct().join(table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")), "k", "left_anti")


@query(f"""select 'jd' as source, {_id()} as id, 详情地址 as place, null as area from {JDD} union all select 'ali', {_id()}, null, 建筑面积 from {ALI}""")
def union_differing(spark: SparkSession, d: str) -> DataFrame:
    jd = table(spark, d, JDD).select(norm_id(F.col("标的物ID")).alias("id"), F.col("详情地址").alias("place"))
    ali = table(spark, d, ALI).select(norm_id(F.col("标的物ID")).alias("id"), F.col("建筑面积").alias("area"))
    return conform.union_all({"jd": jd, "ali": ali}, "source").select("source", "id", "place", "area")


@query(f"""select cast(row_id as varchar) as row_id, coalesce(case when not {_blank('标的物名称')} then {_strip('标的物名称')} end, '') as 标题,
    coalesce(case when not {_blank('建筑面积')} then {_strip('建筑面积')} end, '未知') as 建筑面积, coalesce(case when not {_blank('"法院/处置机构"')} then {_strip('"法院/处置机构"')} end, '') as 处置法院, '' as 格式化地址 from {ALI}""")
def conform_to_target(spark: SparkSession, d: str) -> DataFrame:
    return conform.conform(table(spark, d, ALI), ["row_id", "标题", "建筑面积", "处置法院", "格式化地址"], {"标题": ["标的名称", "标的物名称"], "处置法院": ["处置机构", "法院/处置机构"]}, defaults={"建筑面积": "未知"})


_T0 = "timestamp '2025-06-01'"


@query(f"with f as (select min(row_id) as m from {JDD} where ingested_at >= {_T0}) select row_id from {JDD}, f where m is null or row_id <= m")
def cutoff_stop(spark: SparkSession, d: str) -> DataFrame:
    return sequences.until(table(spark, d, JDD).select("row_id", "ingested_at"), F.col("row_id"), F.col("ingested_at") >= F.lit("2025-06-01").cast("timestamp")).select("row_id")


@query(f"with f as (select max(row_id) as m from {JDD} where 详情抓取状态 = '失败') select row_id from {JDD}, f where m is null or row_id > m")
def resume_after_mark(spark: SparkSession, d: str) -> DataFrame:
    return sequences.after_last(table(spark, d, JDD).select("row_id", "详情抓取状态"), F.col("row_id"), F.col("详情抓取状态") == "失败").select("row_id")


@query("""with f as (select event_id, user_id, case when event_id = min(event_id) over (partition by user_id) then 1 else 0 end as is_new from events),
    g as (select event_id // 20 as page, sum(is_new) as new_items from f group by 1),
    s as (select *, sum((new_items > 0)::int) over (order by page) as seen from g),
    r as (select *, case when new_items > 0 then 0 else row_number() over (partition by seen order by page) - (case when seen > 0 then 1 else 0 end) end as empty_run from s)
    select page, cast(new_items as bigint) as new_items, empty_run from r where page <= coalesce((select min(page) from r where empty_run >= 5), 9e18)""")
def stop_without_news(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "events").select("event_id", "user_id")
    return sequences.until_no_news(df, "event_id", F.floor(F.col("event_id") / 20), "user_id")


@query("select event_id, cast(sum((event_type = 'purchase')::int) over (order by event_id) as bigint) as so_far from events")
def running_count(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "events").select("event_id", "event_type")
    return sequences.running(df, F.col("event_id"), (F.col("event_type") == "purchase").cast("bigint"), "so_far").select("event_id", "so_far")


@query(f"select row_id from {JD} where 标题 is not null and not (contains(标题, '车位') or contains(标题, '车库') or contains(标题, '地下室')) and contains(coalesce(完整地址, ''), '市')")
def keyword_filters(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("标题")
    return table(spark, d, JD).where(~(t.contains("车位") | t.contains("车库") | t.contains("地下室")) & F.coalesce(F.col("完整地址"), F.lit("")).contains("市")).select("row_id")


@query(f"select 城市, avg((coalesce(contains(处置法院, 城市), false))::int) >= 0.8 as in_scope, count(*) as n from {JD} where 城市 is not null group by 1")
def scope_ratio(spark: SparkSession, d: str) -> DataFrame:
    inside = F.coalesce(F.col("处置法院").contains(F.col("城市")), F.lit(False)).cast("int")
    return table(spark, d, JD).where("`城市` is not null").groupBy("城市").agg((F.avg(inside) >= 0.8).alias("in_scope"), F.count("*").alias("n"))


_SPLIT = "list_filter(list_transform(string_split_regex(附件名称, '[；;|,，\n]+'), lambda x: " + _strip("x") + "), lambda x: x <> '')"


@query(f"""with v as (select row_id, unnest({_SPLIT}) as name from {ALI}),
    r as (select row_id, name, row_number() over (partition by row_id order by case when contains(name, '评估') then 0 when contains(name, '查询') then 1 else 2 end, name collate "binary") as rank from v)
    select row_id, name, rank from r where rank <= 2""".replace(' collate "binary"', ""))
def attachment_priority(spark: SparkSession, d: str) -> DataFrame:
    name = lambda x: F.struct(F.when(x.contains("评估"), 0).when(x.contains("查询"), 1).otherwise(2).alias("class"), x.alias("name"))
    best = F.slice(F.array_sort(F.transform(clean.split_joined(F.col("附件名称")), name)), 1, 2)
    return table(spark, d, ALI).select("row_id", F.posexplode(best).alias("k", "x")).select("row_id", F.col("x.name").alias("name"), (F.col("k") + 1).cast("bigint").alias("rank"))


@query(f"select row_id, {_id()} as id, regexp_extract(链接, '([0-9]{{5,}})[^0-9]*$', 1) as link_id, regexp_replace(trim(链接), '/+$', '') as link from {JD}")
def normalised_ids_and_links(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, JD).select("row_id", norm_id(F.col("标的物ID")).alias("id"), clean.number_in_link(F.col("链接")).alias("link_id"), clean.url(F.col("链接")).alias("link"))


_SAID = "regexp_replace(评估价_详情_元, '[,，\\s]', '', 'g')"


@query(f"""select row_id, round(try_cast(regexp_extract({_SAID}, '[0-9]+(\\.[0-9]+)?') as double) * case regexp_extract({_SAID}, '[0-9]+(?:\\.[0-9]+)?(亿|千万|百万|万|千)?', 1)
    when '亿' then 1e8 when '千万' then 1e7 when '百万' then 1e6 when '万' then 1e4 when '千' then 1e3 else 1.0 end, 2) as yuan from {ALI} where 评估价_详情_元 is not null""")
def money_in_yuan(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, ALI).where("`评估价_详情_元` is not null").select("row_id", clean.money(F.col("评估价_详情_元")).alias("yuan"))


_DATE = "'([0-9]{4})[-/.年]([0-9]{1,2})[-/.月]([0-9]{1,2})'"


@query(f"select row_id, case when regexp_matches(结束时间, {_DATE}) then regexp_extract(结束时间, {_DATE}, 1) || '-' || lpad(regexp_extract(结束时间, {_DATE}, 2), 2, '0') || '-' || lpad(regexp_extract(结束时间, {_DATE}, 3), 2, '0') else substr(结束时间, 1, 10) end as day from {MERGE} where 结束时间 is not null")
def dates_as_days(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, MERGE).where("`结束时间` is not null").select("row_id", clean.day(F.col("结束时间")).alias("day"))


@query("select event_id, strftime(make_timestamp(event_id * 86400 * 1000000), '%Y-%m-%d %H:%M:%S') as at from events where event_id > 0")
def epochs_as_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").where("event_id > 0").select("event_id", clean.epoch_text(F.col("event_id") * 86400).alias("at"))


@query("select event_id, json_extract_string(props, '$.k') as k from events")
def json_fields(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", json_field(F.concat(F.lit("cb("), "props", F.lit(");")), "$.none", "$.k").alias("k"))


@query("select event_id, json_extract_string(props, '$.k') as k from events")
def tolerant_json_lines(spark: SparkSession, d: str) -> DataFrame:
    good = table(spark, d, "events").select("event_id", F.col("props").alias("value"))
    bad = good.select("event_id", F.explode(F.array(F.lit(""), F.lit("[1]"), F.lit("{broken"))).alias("value"))
    return parse_lines(good.unionByName(bad), ["k"])


_AT = "position('电梯' in text)"


@query(f"""select doc_id, (case when greatest({_AT} - 90, 1) > 1 then '…' else '' end) || substr(text, greatest({_AT} - 90, 1), least({_AT} + 92, length(text) + 1) - greatest({_AT} - 90, 1))
    || (case when least({_AT} + 92, length(text) + 1) <= length(text) then '…' else '' end) as part from documents where contains(text, '电梯')""")
def excerpts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where(F.col("text").contains("电梯")).select("doc_id", clean.excerpt(F.col("text"), "电梯").alias("part"))


_VOCAB = sorted({*extract.SURROUNDING, *extract.TRAFFIC, *extract.SERVICES, *extract.SETTING})


@query("select doc_id, array_to_string(list_filter([" + ", ".join(f"case when contains(text, '{w}') then '{w}' end" for w in _VOCAB) + "], lambda x: x is not null)[1:30], '、') as words from documents where text is not null")
def keyword_hits(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.array_join(clean.keyword_hits(F.col("text"), _VOCAB), "、").alias("words"))


_TOKEN = "城市"
for _e in clean.DIVISION_ENDINGS:
    _TOKEN = f"regexp_replace({_TOKEN}, '^(.{{2,}}){_e}$', '\\1')"


@query(f"select 城市, {_TOKEN} as token, count(*) as n from {JD} where 城市 is not null group by 1, 2")
def division_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, JD).where("`城市` is not null").groupBy("城市").agg(F.count("*").alias("n")).select("城市", clean.division(F.col("城市")).alias("token"), "n")


@query("""with names as (select distinct r_name as parent, substr(n_name, 1, 4) as token from nation join region on n_regionkey = r_regionkey),
    tree as (select r_name as parent, n_name as child, n_nationkey as code, n_nationkey as pos from nation join region on n_regionkey = r_regionkey)
    select parent, token, arg_min(child, pos) as child, arg_min(code, pos) as code from names join tree using (parent)
    where token = child or contains(token, child) or contains(child, token) group by 1, 2""")
def fuzzy_divisions(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    names = both.select(F.col("r_name").alias("parent"), F.substring("n_name", 1, 4).alias("token")).distinct()
    return joins.divisions(names, both.select(F.col("r_name").alias("parent"), F.col("n_name").alias("child"), F.col("n_nationkey").alias("code"), F.col("n_nationkey").alias("pos")))


@query("select r_name, c_mktsegment, count(*) as n, round(sum(c_acctbal), 2) as balance from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2")
def code_labels(spark: SparkSession, d: str) -> DataFrame:
    got = joins.lookup(table(spark, d, "customer").withColumnRenamed("c_nationkey", "n_nationkey"), table(spark, d, "nation"), "n_nationkey", ["n_regionkey"])
    got = joins.lookup(got.withColumnRenamed("n_regionkey", "r_regionkey"), table(spark, d, "region"), "r_regionkey", ["r_name"])
    return got.groupBy("r_name", "c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("""select l_orderkey, arg_max(l_linenumber, (l_extendedprice, -l_linenumber)) as line, max(l_extendedprice) as price from lineitem group by 1""")
def best_record(spark: SparkSession, d: str) -> DataFrame:
    best = F.max(F.struct("l_extendedprice", (-F.col("l_linenumber")).alias("k")))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(best.alias("b")).select("l_orderkey", (-F.col("b.k")).alias("line"), F.col("b.l_extendedprice").alias("price"))


@query("select o_orderkey, o_custkey, o_orderdate from (select *, row_number() over (order by o_orderdate desc, o_orderkey) as k from orders) where k between 11 and 60")
def stable_sort_slice(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").orderBy(F.col("o_orderdate").desc(), "o_orderkey").offset(10).limit(50).select("o_orderkey", "o_custkey", "o_orderdate")


_PARTS = "list_filter(string_split_regex(coalesce(附件正文二次解析更新列, ''), '[；;|,，\\s]+'), lambda x: x <> '')"


@query(f"select row_id, array_to_string(list_sort(list_distinct(list_append({_PARTS}, '所在层'))), '；') as names from {ALI2}")
def changed_column_sets(spark: SparkSession, d: str) -> DataFrame:
    """The packed cells as sets, with one more name."""
    names = clean.add_to_set(F.col("附件正文二次解析更新列"), "所在层")
    return table(spark, d, ALI2).select("row_id", F.array_join(F.array_sort(F.split(names, "；")), "；").alias("names"))


@query(f"""with a as (select s.poi_id, s.lat, s.lon from (select poi_id, coalesce(case when lat is not null and lon is not null then lat end, center.lat) as lat, coalesce(case when lat is not null and lon is not null then lon end, center.lon) as lon, tags from poi_elements) s where tags['leisure'] = 'park' and lat is not null)
    select a.poi_id, cast(floor(2 * 6371000.0 * asin(sqrt(pow(sin((radians(23.12) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(23.12)) * pow(sin(radians(113.26 - lon) / 2), 2))) + 0.5) as bigint) as metres from a""")
def distance_to_point(spark: SparkSession, d: str) -> DataFrame:
    parks = nearest.of_category(nearest.element_places(table(spark, d, "poi_elements")), "公园-公园")
    return parks.select("poi_id", F.floor(great_circle(F.col("lat"), F.col("lon"), F.lit(23.12), F.lit(113.26)) + 0.5).cast("bigint").alias("metres"))


@query(f"""select row_id, case when r >= 1000 then printf('%.2f', r / 1000) || 'km' else cast(round_even(r, 0) as bigint) || 'm' end as shown from (select row_id, cast(row_id % 4000 as double) / 2 as r from {POI})""")
def distance_texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, POI).select("row_id", clean.distance_text((F.col("row_id") % 4000).cast("double") / 2).alias("shown"))


@query()
def text_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys of titles and names of all listings, with compatibility forms folded."""
    titles = [table(spark, d, t).select("row_id", F.col(c).alias("t")) for t, c in ((MERGE, "标题"), (JD, "标题"), (JDD, "标的物名称"), (ALI, "标的物名称"))]
    return reduce(DataFrame.unionByName, titles).select("row_id", clean.text_key(F.col("t")).alias("key"))


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, JD).select("row_id", F.col("附件文本").alias("t")).unionByName(table(spark, d, ALI2).select("row_id", F.col("附件正文文本").alias("t"))).where("t is not null")


@query()
def description_fields(spark: SparkSession, d: str) -> DataFrame:
    """Fields that attachment texts name, one per row."""
    return _texts(spark, d).select("row_id", F.explode(extract.description_fields(F.col("t"))).alias("field_name", "value"))


def _named_to(ending: str) -> str:
    before = f"split_part(s, '{ending}', 1)"
    name = f"regexp_extract({before}, '([^省市区县镇乡街道盟旗 ]*)$', 1)"
    return f"case when position('{ending}' in s) > 1 and {name} <> '' then {name} || '{ending}' end"


_CITIES = extract.KNOWN_CITIES["广东"]
_KNOWN = "case " + " ".join(f"when contains(s, '{c}') then '{c}'" for c in _CITIES) + " end"


@query(f"""with a as (select row_id, trim(regexp_replace(regexp_replace(regexp_replace(replace(详情地址, '　', ' '), '\r\n?', '\n', 'g'), '[ \t]+', ' ', 'g'), '\n{{2,}}', '\n', 'g')) as s from {JDD} where 详情地址 is not null),
    b as (select *, regexp_extract(s, '{extract.PROVINCE}', 1) as full_name, regexp_extract(s, '^([一-龥]{{2,3}})[一-龥]{{2,6}}市', 1) as short_name, case when starts_with(s, '广东') then {_KNOWN} end as known from a),
    c as (select *, case when full_name <> '' then full_name else short_name end as p from b),
    e as (select *, regexp_extract(substr(s, length(p) + 1), '^([一-龥]{{2,12}}市)', 1) as first_city from c),
    f as (select *, case when first_city <> '' then first_city when p in ('北京市', '天津市', '上海市', '重庆市') then p else coalesce({", ".join(_named_to(x) for x in ("市", "自治州", "地区", "盟"))}, '') end as city, coalesce({", ".join(_named_to(x) for x in ("区", "县", "市", "旗"))}, '') as county from e)
    select row_id, case when known is not null then '广东' else p end as province, coalesce(known, city) as city, case when known is not null then null when county <> city then county else '' end as county from f""")
def region_parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, JDD).where("`详情地址` is not null").select("row_id", extract.region_parts(F.col("详情地址")).alias("r")).select("row_id", "r.province", "r.city", "r.county")


@query()
def surrounding_fields(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("row_id", extract.surroundings(F.col("t")).alias("s")).select("row_id", "s.traffic", "s.services", "s.setting", "s.words")


@query()
def page_text_and_forms(spark: SparkSession, d: str) -> DataFrame:
    """Text and form fields of a page made of each listing."""
    page = F.concat(F.lit("<p>"), F.coalesce("标题", F.lit("")), F.lit("</p><table><tr><td>建筑面积</td><td>"), F.coalesce("建筑面积", F.lit("")), F.lit("</td><td>所在层</td><td>"), F.coalesce("所在层", F.lit("")), F.lit("</td></tr></table>"))
    got = table(spark, d, JD).select("row_id", html_parts(page).alias("p"))
    return got.select("row_id", F.col("p.text").alias("text"), extract.form_fields(F.col("p.rows")).alias("f")).select("row_id", "text", F.try_element_at("f", F.lit("建筑面积")).alias("area"))


RULES = merge.Rules(link="链接", item="标的物ID", title="标题", end="结束时间", texts=("完整地址", "标题"), figures={"area": ("建筑面积",), "assess": ("评估价",), "date": ("结束时间",), "court": ("处置机构",)}, combos=(("area", "assess"), ("area", "date"), ("assess", "date", "court"), ("area", "court")), weights={"建筑面积": 4, "评估价": 3, "完整地址": 3})


@query()
def merged_platforms(spark: SparkSession, d: str) -> DataFrame:
    """First-platform rows folded with the second platform's, in order of row id."""
    return merge.merge_platforms(_both_platforms(spark, d), "source", "row_id", RULES).withColumn("sources", F.array_join("sources", "；")).withColumn("n_members", F.size("members")).drop("members")


def _both_platforms(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, MERGE).select(F.lit("jd").alias("source"), "row_id", "标的物ID", F.lit("").alias("链接"), "标题", "完整地址", "建筑面积", F.col("评估价_元").cast("bigint").cast("string").alias("评估价"), "结束时间", "处置机构")
    b = table(spark, d, ALI).select(F.lit("ali").alias("source"), "row_id", "标的物ID", F.lit("").alias("链接"), F.col("标的物名称").alias("标题"), F.col("标的物名称").alias("完整地址"), "建筑面积", F.col("评估价_详情_元").alias("评估价"), F.lit("").alias("结束时间"), F.col("法院/处置机构").alias("处置机构"))
    return a.unionByName(b)


@query()
def merged_by_full_rules(spark: SparkSession, d: str) -> DataFrame:
    """The same rows folded by the five full keys on five texts."""
    a = table(spark, d, MERGE).select(F.lit("jd").alias("source"), "row_id", "标的物ID", F.lit("").alias("链接"), "标题", F.col("完整地址").alias("地址"), F.lit("").alias("标的物名称"), "建筑面积", *(F.col(c).cast("bigint").cast("string").alias(c) for c in ("评估价_元", "起拍价_元")), "结束时间", "处置机构", F.col("附件数量").cast("string").alias("附件数量"))
    b = table(spark, d, ALI).select(F.lit("ali").alias("source"), "row_id", "标的物ID", F.lit("").alias("链接"), F.lit("").alias("标题"), F.lit("").alias("地址"), "标的物名称", "建筑面积", F.col("评估价_详情_元").alias("评估价_元"), F.lit("").alias("起拍价_元"), F.lit("").alias("结束时间"), F.col("法院/处置机构").alias("处置机构"), F.col("附件数量").cast("string").alias("附件数量"))
    return merge.merge_platforms(a.unionByName(b), "source", "row_id", merge.FULL_RULES).withColumn("sources", F.array_join("sources", "；")).withColumn("n_members", F.size("members")).drop("members")


@query()
def merge_component_sizes(spark: SparkSession, d: str) -> DataFrame:
    """How many components of how many rows the platform merge folds."""
    return merge.component_sizes(_both_platforms(spark, d), "source", "row_id", RULES)


_SHOWN = "case when m < 1000 then cast(cast(round_even(m, 0) as bigint) as varchar) || 'm' else printf('%.2f', m / 1000) || 'km' end"


@query("with e as (select *, coalesce(case when lat is not null and lon is not null then lat end, center.lat) as y, coalesce(case when lat is not null and lon is not null then lon end, center.lon) as x from poi_elements), p as (" + _COORD + f""" ),
    spot as (select printf('%.6f,%.6f', lat, lon) as coord_key, min(lat) as lat, min(lon) as lon from p where lat between 20.0 and 25.8 and lon between 109.0 and 118.0 group by 1),
    near as ({" union all ".join(f"select coord_key, '{c}' as category, min(m) as m from (select coord_key, 2 * 6371000.0 * asin(sqrt(pow(sin((radians(e.y) - radians(s.lat)) / 2), 2) + cos(radians(s.lat)) * cos(radians(e.y)) * pow(sin(radians(e.x - s.lon) / 2), 2))) as m from spot s join e on abs(e.y - s.lat) < 0.05 where coalesce({_in_category(c)}, false)) where m <= {nearest.CATEGORIES[c][1]} group by coord_key" for c in nearest.CATEGORIES)}),
    wide as (select coord_key, {", ".join(f"max(case when category = '{c}' then {_SHOWN} end) as c{k}" for k, c in enumerate(nearest.CATEGORIES))} from near group by coord_key)
    select p.row_id, {", ".join(f"coalesce(c{k}, '') as " + chr(34) + c + chr(34) for k, c in enumerate(nearest.CATEGORIES))} from p left join wide on wide.coord_key = printf('%.6f,%.6f', lat, lon) where p.lat between 20.0 and 25.8 and p.lon between 109.0 and 118.0""")
def distances_by_coordinate_key(spark: SparkSession, d: str) -> DataFrame:
    """Each position's row with the distances of all categories, looked up by its coordinate key."""
    at = positions(spark, d)
    got = nearest.surroundings_by_place(at, table(spark, d, "poi_elements"))
    keyed = at.select("row_id", clean.coordinate_key(F.col("lat"), F.col("lon")).alias("coord_key"))
    return joins.lookup(keyed, got, "coord_key", list(nearest.CATEGORIES)).drop("coord_key")


@query(f"select 标的物ID is not null as has_id, count(*) as n, max(time_s) as latest from (select 标的物ID, epoch(ingested_at) as time_s from {POI}) group by 1".replace("max(time_s) as latest", "cast(max(floor(time_s)) as bigint) as latest"))
def log_freshness(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, POI).groupBy(F.col("标的物ID").isNotNull().alias("has_id")).agg(F.count("*").alias("n"), F.max(F.unix_timestamp("ingested_at")).alias("latest"))


@query(f"select row_id, ((cast(y as bigint) * 12 + m) * 31 + dd) as day_no from (select row_id, regexp_extract(s, '([0-9]{{4}})[^0-9]+([0-9]{{1,2}})[^0-9]+([0-9]{{1,2}})', 1) as y, cast(regexp_extract(s, '([0-9]{{4}})[^0-9]+([0-9]{{1,2}})[^0-9]+([0-9]{{1,2}})', 2) as bigint) as m, cast(regexp_extract(s, '([0-9]{{4}})[^0-9]+([0-9]{{1,2}})[^0-9]+([0-9]{{1,2}})', 3) as bigint) as dd from (select row_id, 抓取时间 as s from {JD} where 抓取时间 is not null))")
def times_in_any_layout(spark: SparkSession, d: str) -> DataFrame:
    at = F.timestamp_seconds(time_seconds(F.col("抓取时间")))
    return table(spark, d, JD).where("`抓取时间` is not null").select("row_id", ((F.year(at) * 12 + F.month(at)) * 31 + F.dayofmonth(at)).cast("bigint").alias("day_no"))
