"""Queries of the core operators for locations, quantities and packed cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelbase.operators.packed import split_packed
from gavelbase.operators.slabs import read_number, within_distance
from gavelbase.operators.units import convert_units
from gavelbase.session import table

RADIUS_M = 3000.0
LAT, LON = (20.0, 25.8), (109.0, 118.0)


def metro_stations(spark: SparkSession, d: str) -> DataFrame:
    """poi_id, lat and lon of the metro stations that lie somewhere."""
    tag = lambda k: F.element_at("tags", F.lit(k))
    own = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return (
        table(spark, d, "poi_elements")
        .where((tag("railway") == "station") | (tag("station") == "subway") | tag("subway").isin("yes", "true", "1"))
        .select("poi_id", F.when(own, F.col("lat")).otherwise(F.col("center.lat")).alias("lat"), F.when(own, F.col("lon")).otherwise(F.col("center.lon")).alias("lon"))
        .where("lat is not null and lon is not null")
    )


def positions(spark: SparkSession, d: str) -> DataFrame:
    """row_id, lat and lon of the listing positions within the window."""
    return (
        table(spark, d, "poi_distance_backfill")
        .select("row_id", read_number(F.col("纬度")).alias("lat"), read_number(F.col("经度")).alias("lon"))
        .where(F.col("lat").between(*LAT) & F.col("lon").between(*LON))
    )


def station_pairs(spark: SparkSession, d: str) -> DataFrame:
    return within_distance(positions(spark, d), metro_stations(spark, d), RADIUS_M, ("row_id", "lat", "lon"), ("poi_id", "lat", "lon"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return station_pairs(spark, d).select(F.col("centre_id").alias("poi_id"), F.col("point_id").alias("row_id"))


def p2_nearest(spark: SparkSession, d: str) -> DataFrame:
    """The nearest station's distance in whole metres for each listing position that has one in reach."""
    return station_pairs(spark, d).groupBy(F.col("point_id").alias("row_id")).agg(F.floor(F.min("distance_m") + 0.5).cast("bigint").alias("nearest_m"), F.count("*").alias("stations"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    spider = convert_units(table(spark, d, "jd_auction_spider"), {"建筑面积": "area", "所在层": "floor", "总层数": "floors"}, "标的物详情描述")
    second = convert_units(table(spark, d, "ali_sf_local_attachment_second_pass"), {"评估价_元": "money"}, "附件正文文本")
    return spider.unionByName(second).select("row_id", "field_name", F.round("value").cast("bigint").alias("whole_value"))


def packed_values(spark: SparkSession, d: str) -> DataFrame:
    detail = split_packed(table(spark, d, "ali_sf_api_detail_backfill"), {"附件名称": "file", "附件链接": "link", "附件ID": "plain"})
    second = split_packed(table(spark, d, "ali_sf_local_attachment_second_pass"), {"附件正文二次解析更新列": "plain"})
    return detail.unionByName(second)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return packed_values(spark, d).where("n_values >= 2 and item_text <> ''").select("row_id", "field_name", "pos_no", "item_text")


QUERIES = {"p2_found": p2_found, "p2_nearest": p2_nearest, "p4_found": p4_found, "p5_found": p5_found}

_NUMBER = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"
_P2 = f"""
with station as (
  select poi_id, case when lat is not null and lon is not null then lat else center.lat end as lat,
         case when lat is not null and lon is not null then lon else center.lon end as lon
  from poi_elements
  where coalesce(tags['railway'] = 'station', false) or coalesce(tags['station'] = 'subway', false) or coalesce(tags['subway'] in ('yes', 'true', '1'), false)
), place as (
  select row_id, case when regexp_matches(trim(纬度), {_NUMBER}) then try_cast(trim(纬度) as double) end as lat,
         case when regexp_matches(trim(经度), {_NUMBER}) then try_cast(trim(经度) as double) end as lon
  from poi_distance_backfill
), near as (
  select s.poi_id, p.row_id, 2 * 6371000.0 * asin(sqrt(least(greatest(pow(sin((radians(s.lat) - radians(p.lat)) / 2), 2)
         + cos(radians(p.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - p.lon) / 2), 2), 0.0), 1.0))) as distance_m
  from place p join station s on abs(s.lat - p.lat) < 0.03
  where p.lat between 20.0 and 25.8 and p.lon between 109.0 and 118.0
)
"""
ORACLE = {
    "p2_found": _P2 + "select poi_id, row_id from near where distance_m <= 3000",
    "p2_nearest": _P2 + "select row_id, cast(floor(min(distance_m) + 0.5) as bigint) as nearest_m, count(*) as stations from near where distance_m <= 3000 group by row_id",
}
