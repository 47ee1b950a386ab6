"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelbase.functions.text import half_width, id_number, is_blank, strip, time_seconds
from gavelbase.llm.consensus import representatives
from gavelbase.llm.entities import match
from gavelbase.llm.glyphs import form_classes, look_alikes, same_form
from gavelbase.llm.leakage import leaks
from gavelbase.llm.linkage import learn_places, linked, parsed
from gavelbase.llm.mixing import mix
from gavelbase.llm.scans import labelled, misread, noise, paragraphs, texts
from gavelbase.operators.units import convert_units
from gavelbase.session import checkpoint, table

#: A statement that points elsewhere, reports an error, or is cut off.
ELSEWHERE = "^(详见|见|参见|请见|参照|同|按|以.*为准)|为准$"
FAILED = "失败|错误|异常|超时|(?i:error|timeout|failed|exception)"
CUT_OFF = "(…|\\.\\.\\.|。。。|···)$"


def usable_text(c: Column) -> Column:
    """The value as stored where it states something, else null."""
    s = strip(c)
    return F.when(~is_blank(c) & ~s.rlike(ELSEWHERE) & ~s.rlike(FAILED) & ~s.rlike(CUT_OFF), c)


def usable_area(c: Column) -> Column:
    number = F.regexp_extract(F.regexp_replace(half_width(c), "(?<=\\d),(?=\\d{3})", ""), "\\d+(\\.\\d+)?", 0).try_cast("double")
    return F.when(usable_text(c).isNotNull() & (number > 0), c)


def best_values(spark: SparkSession, d: str, weights: str = "recency") -> DataFrame:
    first = table(spark, d, "ali_sf_attachment_text_backfill")
    second = table(spark, d, "ali_sf_local_attachment_second_pass")
    # a reading that came out whole is trusted more than one that came out in part or failed
    status = F.col("附件正文抓取状态")
    trust = F.when(status == "成功", 1.0).when(status == "部分成功", 0.75).otherwise(0.5)
    a = representatives(first, id_number(F.col("标的物ID")), {c: usable_text(F.col(f"`{c}`")) for c in ("权证情况", "钥匙/占用情况")}, time_seconds(F.col("附件正文抓取时间")), weights=weights, trust=trust)
    b = representatives(second, id_number(F.col("标的物ID")), {"建筑面积": usable_area(F.col("建筑面积"))}, time_seconds(F.col("附件正文二次解析时间")), weights=weights)
    return a.unionByName(b)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return best_values(spark, d).where("n_rows >= 2").select(F.col("item").alias("item_id"), "field_name", "row_id")


def p1_records(spark: SparkSession, d: str) -> DataFrame:
    """One surviving record per listing: for each field the best value that any of its rows offers, by trust, completeness and recency together."""
    best = best_values(spark, d, "mixed")
    return best.groupBy(F.col("item").alias("item_id")).agg(*(F.max(F.when(F.col("field_name") == f, F.col("value"))).alias(f) for f in ("权证情况", "钥匙/占用情况", "建筑面积")))


def places(spark: SparkSession, d: str):
    courts = [table(spark, d, t).select(c) for t, c in (("jd_auction_spider", "处置法院"), ("jd_api_detail_backfill", "法院/处置机构"), ("merge_jd_ali_region_tables", "处置机构"), ("ali_sf_api_detail_backfill", "法院/处置机构"))]
    return learn_places(courts, table(spark, d, "jd_api_detail_backfill").select("详情省"))


def linked_addresses(spark: SparkSession, d: str) -> DataFrame:
    known = places(spark, d)
    address = F.when(~is_blank(F.col("完整地址")), F.col("完整地址")).otherwise(F.col("格式化地址"))
    rows = parsed(table(spark, d, "jd_auction_spider"), "row_id", address, known).unionByName(parsed(table(spark, d, "jd_api_detail_backfill"), "row_id", F.col("详情地址"), known))
    return linked(rows)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return linked_addresses(spark, d).select("row_id_a", "row_id_b")


def matched_units(spark: SparkSession, d: str) -> DataFrame:
    known = places(spark, d)
    merge, ali = table(spark, d, "merge_jd_ali_region_tables"), table(spark, d, "ali_sf_api_detail_backfill")

    def side(df: DataFrame, name: str, area: str, price: str, text_price: bool) -> DataFrame:
        size = convert_units(df, {area: "area"}).select("row_id", F.round("value", 2).alias("area")).where("area > 0")
        cost = convert_units(df, {price: "money"}).select("row_id", F.round("value", 2).alias("price")) if text_price else df.select("row_id", F.col(price).alias("price"))
        return parsed(df, "row_id", F.col(name), known).join(size, "row_id", "left").join(cost.where("price > 0"), "row_id", "left")

    return match(side(merge, "完整地址", "建筑面积", "评估价_元", False), side(ali, "标的物名称", "建筑面积", "评估价_详情_元", True))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return matched_units(spark, d).select(F.col("left_id").alias("merge_row_id"), F.col("right_id").alias("ali_row_id"))


def p3_matches(spark: SparkSession, d: str) -> DataFrame:
    return matched_units(spark, d).select(F.col("left_id").alias("merge_row_id"), F.col("right_id").alias("ali_row_id"), F.round("confidence", 4).alias("confidence"))


def scanned(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    cells = texts(table(spark, d, "ali_sf_local_attachment_second_pass"), ["附件正文文本"]).unionByName(texts(table(spark, d, "jd_auction_spider"), ["附件文本"]))
    lines = checkpoint(labelled(cells))
    return lines, misread(lines)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return noise(*scanned(spark, d)).select("row_id", "line_no", "noise_kind").distinct()


def p7_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return paragraphs(*scanned(spark, d))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return look_alikes(table(spark, d, "documents")).select(F.col("id_a").alias("doc_id_a"), F.col("id_b").alias("doc_id_b")).distinct()


def p10_forms(spark: SparkSession, d: str) -> DataFrame:
    return same_form(table(spark, d, "documents")).select(F.col("_id").alias("doc_id"), "canonical")


def p10_classes(spark: SparkSession, d: str) -> DataFrame:
    """Each document that has a look-alike of another stored text, with its class and the class's size."""
    return form_classes(table(spark, d, "documents")).withColumnRenamed("id", "doc_id")


QUERIES = {
    "p1_found": p1_found, "p1_records": p1_records, "p3_found": p3_found, "p3_matches": p3_matches, "p6_found": p6_found, "p7_found": p7_found, "p7_paragraphs": p7_paragraphs, "p8_found": p8_found, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_forms": p10_forms, "p10_classes": p10_classes,
}

_WORDS = "('', '-', '--', '/', 'nan', 'none', 'null', 'n/a', '未知', '无', '暂无', '不适用', '待核实', '不详')"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^[\\s\\x{{3000}}]+|[\\s\\x{{3000}}]+$', '', 'g')"


def _usable(c: str) -> str:
    s = _strip(c)
    return f"({c} is not null and lower({s}) not in {_WORDS} and not regexp_matches({s}, '^(详见|见|参见|请见|参照|同|按|以.*为准)|为准$') and not regexp_matches({s}, '失败|错误|异常|超时|(?i:error|timeout|failed|exception)') and not regexp_matches({s}, '(…|\\.\\.\\.|。。。|···)$'))"


def _p1(t: str, c: str, time: str, more: str = "true") -> str:
    parts = [f"try_cast(regexp_extract({time}, '(\\d{{4}})\\D+(\\d{{1,2}})\\D+(\\d{{1,2}})\\D+(\\d{{1,2}})\\D+(\\d{{1,2}})\\D+(\\d{{1,2}})', {i}) as bigint)" for i in range(1, 7)]
    stamp = "((((" + parts[0] + " * 12 + " + parts[1] + ") * 31 + " + parts[2] + ") * 24 + " + parts[3] + ") * 60 + " + parts[4] + ") * 60 + " + parts[5]
    return f"""select item_id, '{c.strip('"')}' as field_name, arg_min(row_id, (-t, row_id)) filter (where ok) as row_id from (
        select try_cast(regexp_replace(trim(translate(标的物ID, '０１２３４５６７８９．', '0123456789.')), '\\.0+$', '') as bigint) as item_id, row_id, {stamp} as t, {_usable(c)} and {more} as ok from {t})
      where item_id is not null group by item_id having count(*) >= 2 and count(*) filter (where ok) >= 1"""


ORACLE = {
    "p1_found": "\nunion all\n".join((
        _p1("ali_sf_attachment_text_backfill", '"权证情况"', "附件正文抓取时间"),
        _p1("ali_sf_attachment_text_backfill", '"钥匙/占用情况"', "附件正文抓取时间"),
        _p1("ali_sf_local_attachment_second_pass", '"建筑面积"', "附件正文二次解析时间", "coalesce(try_cast(regexp_extract(建筑面积, '\\d+(\\.\\d+)?') as double) > 0, false)"),
    )),
}
