"""Queries of landed documents, pieces of text and assembled rows over the whole tables, each with its SQL. Where no table holds landed JSON, the
documents are made of the tables' rows in the services' shapes, and the SQL reads the rows themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelbase.functions import clean, extract, pieces
from gavelbase.functions.text import norm_id
from gavelbase.operators import assemble
from gavelbase.plans.geo_units_packed import positions
from gavelbase.plans.listings import _COORD, _blank, _id, _strip, ALI, ALI2, JD, JDD, MERGE
from gavelbase.session import table
from gavelbase.sources import landed

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _said(c: str) -> str:
    return f"(case when not {_blank(c)} then {_strip(c)} else '' end)"


def _once(items: str) -> str:
    """Elements of a list, each once, in order."""
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)"


@query(f"""select row_id, {_id()} as "标的物ID", case when {_id()} <> '' then 'https://paimai.jd.com/' || {_id()} else '' end as 链接, {_said('标题')} as 标题, {_said('完整地址')} as 地址, {_said('处置法院')} as 处置机构, try_cast(replace({_said('评估价')}, ',', '') as double) as "评估价_元" from {JD} where 标的物ID is not null""")
def landed_first_index(spark: SparkSession, d: str) -> DataFrame:
    item = F.struct(F.col("标的物ID").alias("id"), F.col("标题").alias("title"), F.col("完整地址").alias("productAddress"), F.col("处置法院").alias("shopName"), F.col("评估价").alias("assessmentPrice"))
    pages = table(spark, d, JD).where("`标的物ID` is not null").select("row_id", F.concat(F.lit("cb("), F.to_json(F.struct(F.array(item).alias("datas"))), F.lit(");")).alias("body"))
    return landed.first_index(pages, keep=["row_id"]).select("row_id", "标的物ID", "链接", "标题", "地址", "处置机构", "评估价_元")


def _second_pages(spark: SparkSession, d: str) -> DataFrame:
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint").cast("string")
    item = F.struct(F.col("标的物ID").alias("itemId"), F.col("标题").alias("title"), F.col("处置机构").alias("shopName"), cents("评估价_元").alias("consultPrice"), cents("起拍价_元").alias("initialPrice"), F.col("附件数量").cast("string").alias("pv"))
    scheme = F.struct(F.lit(1).alias("totalCount"), F.col("row_id").alias("page"), F.array(item).alias("contentList"))
    whole = F.struct(F.array(F.when(F.col("标题").isNotNull(), F.lit(landed.CALL_OK)).otherwise(F.lit("FAIL"))).alias("ret"), F.struct(F.struct(F.array(F.struct(F.array(scheme).alias("schemeList"))).alias("scenes")).alias("data")).alias("data"))
    return table(spark, d, MERGE).select("row_id", F.to_json(whole).alias("body"))


@query(f"""select row_id, {_id()} as "标的物ID", {_said('标题')} as 标题, {_said('处置机构')} as 处置机构, "评估价_元", "起拍价_元", case when 附件数量 is not null then cast(附件数量 as bigint) end as "围观次数" from (select *, cast(round("评估价_元" * 100) as bigint) / 100 as a from {MERGE}) where 标题 is not null and 标的物ID is not null""")
def landed_second_index(spark: SparkSession, d: str) -> DataFrame:
    return landed.second_index(_second_pages(spark, d), keep=["row_id"]).where("`标的物ID` <> ''").select("row_id", "标的物ID", "标题", "处置机构", "评估价_元", "起拍价_元", "围观次数")


@query(f"select row_id, 标题 is not null as ok, 1 as total, case when 标题 is not null then '' else 'call failed: [\"FAIL\"]' end as error from {MERGE}")
def landed_pages(spark: SparkSession, d: str) -> DataFrame:
    return landed.second_pages(_second_pages(spark, d), keep=["row_id"]).select("row_id", "ok", F.col("total").cast("int").alias("total"), F.coalesce("error", F.lit("")).alias("error"))


@query(f"select count(distinct {_id()}) as ids, true as bounded from {JDD} where 标的物ID is not null")
def call_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Ids in chunks of 200 at most for calls that take several."""
    ids = table(spark, d, JDD).where("`标的物ID` is not null").select(norm_id(F.col("标的物ID")).alias("id"))
    return landed.id_chunks(ids, "id").agg(F.sum("n").alias("ids"), F.coalesce(F.max("n") <= 200, F.lit(True)).alias("bounded"))


@query(f"""select id, case when b and r then '' when b then 'realtime' when r then 'basic' else 'basic；realtime' end as errors, case when b and r then '成功' when b or r then '部分成功' else '失败' end as status
    from (select {_id()} as id, coalesce(bool_or(详情抓取状态 in ('成功', '部分成功')), false) as b, coalesce(bool_or(详情抓取状态 = '成功'), false) as r from {JDD} where 标的物ID is not null group by 1)""")
def detail_call_status(spark: SparkSession, d: str) -> DataFrame:
    """What each listing's detail calls brought, error by error."""
    body = lambda ok: F.when(ok, F.to_json(F.struct(F.col("标的物名称").alias("name"), F.lit(1).alias("one")))).otherwise("broken{")
    status = F.coalesce("详情抓取状态", F.lit(""))
    calls = F.explode(F.array(F.struct(F.lit("basic").alias("kind"), body(status.isin("成功", "部分成功")).alias("body")), F.struct(F.lit("realtime").alias("kind"), body(status == "成功").alias("body"))))
    log = table(spark, d, JDD).where("`标的物ID` is not null").select(norm_id(F.col("标的物ID")).alias("id"), F.col("row_id").alias("_at"), calls.alias("c")).select("id", "_at", "c.*")
    return landed.detail_calls(log, "id", "kind", "body", ("basic", "realtime")).select("id", "errors", "status")


@query(f"""select row_id, 1 as n, {_said('附件名称')} as names, {_said('附件ID')} as ids from {ALI}""")
def detail_attachments(spark: SparkSession, d: str) -> DataFrame:
    item = F.struct(F.coalesce("附件名称", F.lit("")).alias("fileName"), F.coalesce("附件ID", F.lit("")).alias("attachmentId"))
    x = table(spark, d, ALI).select("row_id", F.to_json(F.struct(F.struct(F.array(item).alias("attaches")).alias("data"))).alias("body"))
    return x.select("row_id", pieces.attachment_summary(pieces.attachments(F.col("body"))).alias("s")).select("row_id", "s.n", "s.names", "s.ids")


@query("select poi_id, lat, lon, center.lat as center_lat, center.lon as center_lon, cast(coalesce(cardinality(tags), 0) as int) as n_tags from poi_elements")
def landed_elements(spark: SparkSession, d: str) -> DataFrame:
    """Map elements out of a map service's answers."""
    e = F.struct(F.col("poi_id").alias("id"), "lat", "lon", "center", "tags")
    answers = table(spark, d, "poi_elements").select(F.to_json(F.struct(F.array(e).alias("elements"))).alias("body"))
    return landed.map_elements(answers).select("poi_id", "lat", "lon", F.col("center.lat").alias("center_lat"), F.col("center.lon").alias("center_lon"), F.size("tags").alias("n_tags"))


@query(f"with c as ({_COORD}) select row_id, lon, lat from c where lat between 20.0 and 25.8 and lon between 109.0 and 118.0")
def landed_geocodes(spark: SparkSession, d: str) -> DataFrame:
    """Places out of a geocoder's answers."""
    at = positions(spark, d).select("row_id", F.to_json(F.struct(F.array(F.struct(F.concat_ws(",", F.col("lon").cast("string"), F.col("lat").cast("string")).alias("location"))).alias("geocodes"))).alias("body"))
    return landed.geocodes(at, keep=["row_id"]).select("row_id", "lon", "lat")


_PAIR = "'([0-9]+\\.?[0-9]*)[,，[:space:]]+([0-9]+\\.?[0-9]*)'"


@query(f"select row_id, try_cast(regexp_extract(坐标, {_PAIR}, 1) as double) as lon, try_cast(regexp_extract(坐标, {_PAIR}, 2) as double) as lat from {JD} where regexp_matches(坐标, {_PAIR})")
def coordinate_pairs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, JD).select("row_id", pieces.lon_lat(F.col("坐标")).alias("at")).where("at is not null").select("row_id", "at.lon", "at.lat")


_LABELS = ["评估总价", "评估价值", "评估价", "估价结果"]
_AMOUNTS = "regexp_extract_all(附件正文文本, '(?:" + "|".join(_LABELS) + ")(?:合计|总计|总额|为|是|：|:|\\s)*(?:人民币|约)?\\s*([0-9][0-9,，]*(?:\\.[0-9]+)?\\s*(?:万元|万|元)?)', 1)"
_YUAN = "round(try_cast(regexp_extract(replace(replace(x, ',', ''), '，', ''), '[0-9]+(\\.[0-9]+)?') as double) * case when contains(x, '万') then 10000.0 else 1.0 end, 2)"


@query(f"with v as (select row_id, list_filter(list_transform({_AMOUNTS}, lambda x: {_YUAN}), lambda y: y between 1000 and 100000000000) as l from {ALI2}) select row_id, l[1] as yuan from v where len(l) > 0")
def labelled_prices(spark: SparkSession, d: str) -> DataFrame:
    """The first valuation that each text states, within bounds."""
    return table(spark, d, ALI2).select("row_id", pieces.labelled_amount(F.col("附件正文文本"), _LABELS, 1e3, 1e11).alias("yuan")).where("yuan is not null")


@query(f"select row_id, try_cast(replace(regexp_extract(附件文本, '(?:总层数|共)\\s*[：:为]?\\s*([0-9][0-9,]*)', 1), ',', '') as bigint) as n from {JD} where regexp_matches(附件文本, '(?:总层数|共)\\s*[：:为]?\\s*([0-9][0-9,]*)')")
def labelled_floors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, JD).select("row_id", pieces.labelled_whole(F.col("附件文本"), ["总层数", "共"]).alias("n")).where("n is not null")


_NUM = "try_cast(regexp_extract(replace(replace(评估价, ',', ''), '，', ''), '[0-9]+(\\.[0-9]+)?') as double) * case when contains(评估价, '万') then 10000.0 else 1.0 end"


@query(f"select row_id, round({_NUM}, 2) as yuan from {JD} where {_NUM} > 0 and round({_NUM}, 2) between 1000 and 100000000000")
def amounts_in_bounds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, JD).select("row_id", pieces.amount_between(F.col("评估价")).alias("yuan")).where("yuan is not null")


_WORDS = ("评估", "交易税费", "物业管理费", "租赁")
_AROUND = "[" + ", ".join(f"case when position('{w}' in 附件正文文本) > 0 then trim(regexp_replace(substr(附件正文文本, greatest(position('{w}' in 附件正文文本) - 80, 1), position('{w}' in 附件正文文本) + 220 - greatest(position('{w}' in 附件正文文本) - 80, 1)), '[\\s\\x{{3000}}]+', ' ', 'g')) end" for w in _WORDS).replace("{{", "{").replace("}}", "}") + "]"


@query(f"with v as (select row_id, list_filter({_AROUND}, lambda x: x is not null and x <> '') as l from {ALI2} where 附件正文文本 is not null) select row_id, array_to_string(({_once('l')})[1:2], '；') as parts from v")
def text_windows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, ALI2).where("`附件正文文本` is not null").select("row_id", pieces.windows(F.col("附件正文文本"), list(_WORDS), 80, 220, 2).alias("parts"))


_TIDY = f"{_strip(chr(34) + '完整地址' + chr(34))}"
_CUT = _TIDY
for _p in pieces.ADDRESS_CUTS:
    _CUT = f"regexp_replace({_CUT}, '{_p}', '', 'g')"


@query(f"select row_id, case when regexp_replace({_CUT}, '\\s+', '', 'g') <> '' then regexp_replace({_CUT}, '\\s+', '', 'g') else {_TIDY} end as address from {JD} where 完整地址 is not null")
def lookup_addresses(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, JD).where("`完整地址` is not null").select("row_id", pieces.lookup_address(F.col("完整地址")).alias("address"))


_LACKS = lambda c: f"case when not {_blank(c)} and not contains(详情地址, {_strip(c)}) then {_strip(c)} end"
_REGION = f"list_filter([{', '.join(map(_LACKS, ('详情省', '详情市', '详情区县')))}], lambda x: x is not null)"


@query(f"""select row_id, case when {_blank('详情地址')} then '' when contains(详情地址, '省') or contains(详情地址, '市') or contains(详情地址, '自治区') or contains(详情地址, '特别行政区') or len({_REGION}) = 0 then 详情地址 else array_to_string({_once(_REGION)}, '') || 详情地址 end as address from {JDD}""")
def addresses_with_region(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, JDD).select("row_id", pieces.with_region(F.col("详情地址"), F.col("详情省"), F.col("详情市"), F.col("详情区县")).alias("address"))


_DIGEST = {"标题": "标题", "面积": "建筑面积", "用途": "房屋用途"}


@query("select row_id, array_to_string(list_filter([" + ", ".join(f"case when not {_blank(c)} then '{k}：' || {_strip(c)} end" for k, c in _DIGEST.items()) + f"], lambda x: x is not null), chr(10)) as digest, array_to_string(list_filter([" + ", ".join(f"case when not {_blank(c)} then '{k}:' || {_strip(c)} end" for k, c in _DIGEST.items()) + f"], lambda x: x is not null), '；') as pairs from {JD}")
def listing_digests(spark: SparkSession, d: str) -> DataFrame:
    fields = {k: F.col(c) for k, c in _DIGEST.items()}
    return table(spark, d, JD).select("row_id", pieces.digest(fields).alias("digest"), pieces.joined_pairs(fields).alias("pairs"))


_IDS = "list_filter(list_transform(string_split_regex(附件ID, '[；;|,，\\n]+'), lambda x: " + _strip("x") + "), lambda x: x <> '')"


@query(f"select row_id, coalesce(array_to_string(list_transform({_IDS}, lambda x: 'https://files.example/' || x), '；'), '') as links from {ALI}")
def links_from_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, ALI).select("row_id", pieces.links_of_ids(F.lit(None).cast("string"), F.col("附件ID"), "https://files.example/").alias("links"))


@query(" union all ".join(f"select row_id, replace(regexp_extract(附件正文文本, '{p}', 1), ' ', '') as value, '{k}' as detail from {ALI2} where regexp_matches(附件正文文本, '{p}')" for k, p in (("lender", pieces.LENDER), ("share", pieces.LOAN_SHARE), ("rate", pieces.LOAN_RATE))))
def loan_details(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, ALI2).select("row_id", pieces.loan_details(F.col("附件正文文本")).alias("s"))
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("detail"), F.col(f"s.{k}").alias("value")) for k in ("lender", "share", "rate"))))
    return x.select("row_id", each.alias("x")).select("row_id", "x.value", "x.detail").where("value <> ''")


_AREA, _FLOORS = "建筑面积为?([0-9.]*[0-9])", "总层数([0-9]+)层"
_FOUND = {"建筑面积": f"regexp_extract(附件文本, '{_AREA}', 1)", "总层数": f"regexp_extract(附件文本, '{_FLOORS}', 1)"}
_NEW = {c: f"coalesce(case when not {_blank(c)} then trim(regexp_replace({c}, '[\\s\\x{{3000}}]+', ' ', 'g')) end, nullif({p}, ''))" for c, p in _FOUND.items()}
_FILLED = {c: f"({_blank(c)} and {_NEW[c]} is not null)" for c in _FOUND}
_REPAIRED = {c: f"(not {_blank(c)} and {_NEW[c]} is not null and {_NEW[c]} <> {c})" for c in _FOUND}


def _repaired_rows(spark: SparkSession, d: str) -> DataFrame:
    found = {"建筑面积": F.regexp_extract("附件文本", _AREA, 1), "总层数": F.regexp_extract("附件文本", _FLOORS, 1)}
    return assemble.fill_or_repair(table(spark, d, JD).select("row_id", "建筑面积", "总层数", "附件文本"), found, {c: clean.one_line for c in found}, "长文本")


@query("select row_id, " + ", ".join(f"coalesce({_NEW[c]}, {c}) as {c}" for c in _FOUND) + ", array_to_string(list_filter([" + ", ".join(f"case when {_FILLED[c]} then '{c}' end" for c in _FOUND) + "], lambda x: x is not null), '；') as filled, array_to_string(list_filter([" + ", ".join(f"case when {_REPAIRED[c]} then '{c}' end" for c in _FOUND) + f"], lambda x: x is not null), '；') as repaired from {JD}")
def filled_or_repaired(spark: SparkSession, d: str) -> DataFrame:
    return _repaired_rows(spark, d).select("row_id", *_FOUND, F.array_join("filled", "；").alias("filled"), F.array_join("repaired", "；").alias("repaired"))


@query(" union all ".join(f"select '{c}' as field_name, count(*) filter ({_FILLED[c]}) as filled, count(*) filter ({_REPAIRED[c]}) as repaired, count(*) filter (not {_blank(c)} and not {_REPAIRED[c]}) as kept from {JD}" for c in _FOUND))
def fill_counts(spark: SparkSession, d: str) -> DataFrame:
    return assemble.fill_counts(_repaired_rows(spark, d), list(_FOUND))


@query(f"select row_id from {JD} where 解析状态 is null or trim(解析状态) <> '已解析'")
def pending_rows(spark: SparkSession, d: str) -> DataFrame:
    return assemble.pending_details(table(spark, d, JD), F.col("解析状态")).select("row_id")


@query(f"select row_id from {JD} where {_blank('建筑面积')} or {_blank('附件文本')} or ({_blank('所在层')} and {_blank('总层数')})")
def rows_that_want_text(spark: SparkSession, d: str) -> DataFrame:
    return assemble.wants_text(table(spark, d, JD), ["建筑面积", "附件文本"], all_of=["所在层", "总层数"]).select("row_id")


@query(f"select row_id from {JD} where 标的物ID is not null and {_id()} not in (select id from (select {_id()} as id, arg_max(coalesce(详情抓取状态, ''), row_id) as s from {JDD} where 标的物ID is not null group by 1) where s = '失败')")
def not_known_failures(spark: SparkSession, d: str) -> DataFrame:
    key = lambda t: table(spark, d, t).where("`标的物ID` is not null").withColumn("id", norm_id(F.col("标的物ID")))
    log = key(JDD).select("id", F.col("row_id").alias("_at"), F.coalesce("详情抓取状态", F.lit("")).alias("s"))
    return assemble.not_failed(key(JD), log, "id", F.col("s")).select("row_id")


@query(f"""select count(*) as log_rows, count(distinct {_id()}) as ids, count(*) - count(distinct {_id()}) as repeated, count(distinct {_id()}) filter (详情抓取状态 <> '失败') as finished,
    (select count(distinct {_id()}) from {JD}) as target, count(distinct {_id()}) filter (详情抓取状态 <> '失败') >= (select count(distinct {_id()}) from {JD}) as met from {JDD}""")
def log_supervision(spark: SparkSession, d: str) -> DataFrame:
    return assemble.supervision(table(spark, d, JDD), table(spark, d, JD), norm_id(F.col("标的物ID")), F.col("详情抓取状态") != "失败")


@query("""with r as (select o_orderpriority as k, cast(min(o_orderdate) as date) as s, cast(max(o_orderdate) as date) as e from orders group by 1), y as (select *, unnest(range(year(s), year(e) + 1)) as y from r)
    select k, cast(y - year(s) as int) as bucket_no, greatest(s, make_date(y, 1, 1)) as range_start, least(e, make_date(y, 12, 31)) as range_end from y""")
def yearly_ranges(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("k")).agg(F.min("o_orderdate").cast("date").alias("s"), F.max("o_orderdate").cast("date").alias("e"))
    return assemble.day_ranges(r, ["k"], F.col("s"), F.col("e"))


@query("""with r as (select o_orderpriority as k, cast(min(o_orderdate) as date) as s, cast(max(o_orderdate) as date) as e, count(*) as n from orders group by 1), m as (select *, cast(s + cast(floor((e - s) / 2) as int) as date) as mid from r)
    select k, n, s as range_start, mid as range_end from m where n > 100 and s < e union all select k, n, cast(mid + 1 as date), e from m where n > 100 and s < e union all select k, n, s, e from m where not (n > 100 and s < e)""")
def halved_ranges(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("k")).agg(F.count("*").alias("n"), F.min("o_orderdate").cast("date").alias("range_start"), F.max("o_orderdate").cast("date").alias("range_end"))
    return assemble.halved(r, "range_start", "range_end", F.col("n"), 100)


@query("""select r_name as parent, case when r_name like 'A%' then lower(n_name) else n_name end as child, case when r_name like 'A%' then 'modern' else 'legacy' end as vintage from nation join region on n_regionkey = r_regionkey""")
def division_trees(spark: SparkSession, d: str) -> DataFrame:
    """Two vintages of a tree: a parent's children come from the first that has any."""
    both = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    tree = lambda df, name: df.groupBy(F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("name")).agg(F.sort_array(F.collect_list(F.struct(F.col("n_nationkey").cast("string").alias("code"), name.alias("name")))).alias("children"))
    trees = {"modern": tree(both.where("r_name like 'A%'"), F.lower("n_name")), "legacy": tree(both, F.col("n_name"))}
    return assemble.tree_children(trees).select("parent", "child", "vintage")


@query(f"""with v as (select row_id, list_filter(list_transform(string_split(附件文本, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') as l, list_filter(list_distinct(regexp_extract_all(所在层, '([0-9]+层)', 1)), lambda x: x <> '') as n from {JD}),
    w as (select *, list_filter(list_transform(l, lambda x, i: case when len(list_filter(n, lambda y: contains(replace(x, ' ', ''), y))) > 0 then i end), lambda i: i is not null)[1] as hit from v)
    select row_id, cast(hit as int) as line_no, array_to_string(l[greatest(hit - 1, 1):hit + 2], ' ') as context from w where hit is not null""")
def row_contexts(spark: SparkSession, d: str) -> DataFrame:
    """The first line of each text that names the listing's floor, with its neighbours."""
    return assemble.row_contexts(table(spark, d, JD), "row_id", F.col("所在层"), F.col("附件文本"), ["([0-9]+层)"])


@query("""select l_orderkey, coalesce(arg_max(l_linenumber, (l_extendedprice, l_linenumber)) filter (l_returnflag = 'R'), arg_max(l_linenumber, (l_extendedprice, l_linenumber))) as line from lineitem group by 1""")
def best_bids(spark: SparkSession, d: str) -> DataFrame:
    """The highest line of each order, returned ones before others: bids of which those that closed a deal come first."""
    bid = F.struct(F.when(F.col("l_returnflag") == "R", "deal").alias("status"), F.col("l_extendedprice").cast("double").alias("price"), F.col("l_linenumber").cast("bigint").alias("time"))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(bid).alias("b")).select("l_orderkey", pieces.best_bid(F.col("b"))["time"].cast("int").alias("line"))  # an order has seven lines at most


@query(f"select row_id, coalesce(nullif({_said('完整地址')}, ''), nullif({_said('格式化地址')}, '')) as place, nullif({_said('建筑面积')}, '') as area from {JD}")
def first_said_maps(spark: SparkSession, d: str) -> DataFrame:
    one = lambda **kv: F.create_map(*(x for k, c in kv.items() for x in (F.lit(k), F.col(c))))
    m = pieces.first_said_map(one(place="完整地址", area="建筑面积"), one(place="格式化地址"))
    return table(spark, d, JD).select("row_id", m.alias("m")).select("row_id", F.try_element_at("m", F.lit("place")).alias("place"), F.try_element_at("m", F.lit("area")).alias("area"))


def _tiers(field: str) -> str:
    out = "''"
    for p in reversed(extract.TIERS[field]):
        out = f"case when regexp_matches(s, '{p}') then regexp_extract(s, '{p}', 1) else {out} end"
    return out


@query("with t as (" + " union all ".join(f"select row_id, trim(regexp_replace({c}, '[\\s\\x{{3000}}]+', ' ', 'g')) as s from {t} where {c} is not null" for t, c in ((JD, "附件文本"), (ALI2, "附件正文文本"))) + ") " + " union all ".join(f"select row_id, '{f}' as field_name, {_tiers(f)} as value from t where {_tiers(f)} <> ''" for f in extract.TIERS))
def inline_fields(spark: SparkSession, d: str) -> DataFrame:
    """Area, floor, number of floors and year of building that running text names, by tiers of patterns, in both tables of texts."""
    both = table(spark, d, JD).select("row_id", F.col("附件文本").alias("t")).unionByName(table(spark, d, ALI2).select("row_id", F.col("附件正文文本").alias("t"))).where("t is not null")
    return both.select("row_id", F.explode(extract.inline_fields(F.col("t"))).alias("field_name", "value"))


@query(f"select row_id, case when 评估价_元 > 0 and 起拍价_元 * 100 <= 评估价_元 * 10 then 起拍价_元 * 100 else round(起拍价_元 * 100 / 100, 2) end as yuan from {MERGE}")
def bids_in_yuan(spark: SparkSession, d: str) -> DataFrame:
    """Prices landed in cents, told by their size against a reference."""
    return table(spark, d, MERGE).select("row_id", pieces.bid_yuan(F.col("起拍价_元") * 100, F.col("评估价_元")).alias("yuan"))
