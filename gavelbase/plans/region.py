"""The region pipeline's stages over the landed tables: index, detail, aligned, merged, organised."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelbase.functions import extract
from gavelbase.functions.text import norm_id
from gavelbase.operators import conform, dedupe, merge
from gavelbase.plans.listings import ALI, ALI2, JD, JDD, MERGE, RULES
from gavelbase.plans.pipeline import Pipeline
from gavelbase.session import table

#: Columns of an aligned row besides its platform.
TARGET = ["row_id", "标的物ID", "链接", "标题", "完整地址", "建筑面积", "评估价", "结束时间", "处置机构", "附件文本"]
ALIASES = {"row_id": ["详情行"], "标的物ID": ["详情标的物ID"], "标题": ["标的物名称"], "完整地址": ["格式化地址", "详情地址", "标的物名称"], "建筑面积": ["二次建筑面积"], "评估价": ["评估价_详情_元", "评估价_元"], "处置机构": ["处置法院", "法院/处置机构"], "附件文本": ["附件正文文本"]}


def keyed(df: DataFrame) -> DataFrame:
    """With the listing's key; a row without an id stays a listing of its own."""
    own = norm_id(F.col("标的物ID"))
    return df.withColumn("key", F.coalesce(F.nullif(own, F.lit("")), F.concat(F.lit("row "), F.col("row_id").cast("string"))))


def latest(df: DataFrame) -> DataFrame:
    return dedupe.keep_last(keyed(df), F.col("key"), F.col("ingested_at"), F.col("row_id"))


def aligned(jd: DataFrame, jd_detail: DataFrame, waiting: DataFrame, ali: DataFrame, second: DataFrame) -> DataFrame:
    """Both platforms' rows with the target columns; the index and the first detail go before what comes later, details without an index row stay."""
    later = {"row_id": "详情行", "标的物ID": "详情标的物ID"}
    first = jd.join(jd_detail.withColumnsRenamed(later), "key", "full")
    other = ali.join(second.withColumnsRenamed(later | {"建筑面积": "二次建筑面积"}).drop("ingested_at"), "key", "full")
    # the price column is a number there
    waiting = waiting.withColumn("评估价", F.col("评估价_元").cast("decimal(20, 2)").cast("string")).drop("评估价_元")
    rows = {"jd": [first, waiting], "ali": [other]}
    return conform.union_all({s: conform.union_all({str(k): conform.conform(x, TARGET, ALIASES) for k, x in enumerate(xs)}) for s, xs in rows.items()}, "source").withColumn("row_id", F.col("row_id").cast("bigint"))


def stages(p: Pipeline, d: str) -> None:
    """Add the stages over the tables of a folder."""
    landed = lambda name: table(p.spark, d, name)
    full = [c for c in landed(JD).columns if c not in ("row_id", "标的物ID")]
    p.stage("index")(lambda run: dedupe.keep_most_complete(keyed(landed(JD)), F.col("key"), F.col("row_id"), full))
    p.stage("jd_detail")(lambda run: latest(landed(JDD)))
    p.stage("ali_detail")(lambda run: latest(landed(ALI)))
    p.stage("ali_second_pass")(lambda run: latest(landed(ALI2)))
    p.stage("aligned")(lambda run: aligned(run.table("index"), run.table("jd_detail"), landed(MERGE), run.table("ali_detail"), run.table("ali_second_pass")))
    p.stage("merged")(lambda run: merge.merge_platforms(run.table("aligned"), "source", "row_id", RULES))
    p.stage("organised")(lambda run: run.table("merged").withColumn("s", extract.surroundings(F.col("附件文本"))).select("*", "s.*").drop("s"))
