"""Queries that run a stream over a table until all of it is taken in."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelbase.session import shared_folder, table
from gavelbase.streaming.append_log import read_latest, upsert_log


def work_folder(spark: SparkSession) -> str:
    """A new folder in the cluster's shared one."""
    return f"{shared_folder(spark, 'streams')}/{uuid.uuid4().hex}"


def append_log_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The last event of each user, kept up by a stream."""
    folder = work_folder(spark)
    schema = table(spark, d, "events").schema
    # a pattern, for the stream source takes a plain path to be a folder
    stream = spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]").select("user_id", "ts", "event_id", "event_type")
    upsert_log(stream, f"{folder}/table", f"{folder}/mark", "user_id", ["ts", "event_id"]).awaitTermination()
    return read_latest(spark, f"{folder}/table").select("user_id", "event_id", "event_type")


def seed_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Each region with each market segment; the distinct segments are gathered into one row that is joined."""
    segments = table(spark, d, "customer").agg(F.array_sort(F.collect_set("c_mktsegment")).alias("s"))
    return table(spark, d, "region").crossJoin(F.broadcast(segments)).select("r_name", F.explode("s").alias("segment"))  # one row is joined


def page_counts(spark: SparkSession, d: str) -> DataFrame:
    """Pages of 30 that each city's listings fill."""
    return table(spark, d, "jd_auction_spider").where("`城市` is not null").groupBy("城市").agg(F.ceil(F.count("*") / 30).alias("pages"))


QUERIES = {"append_log_upsert": append_log_upsert, "seed_partitions": seed_partitions, "page_counts": page_counts}
ORACLE = {
    "append_log_upsert": "select user_id, arg_max(event_id, (epoch_us(ts), event_id)) as event_id, arg_max(event_type, (epoch_us(ts), event_id)) as event_type from events group by 1",
    "seed_partitions": "select r_name, segment from region, (select distinct c_mktsegment as segment from customer)",
    "page_counts": "select 城市, cast(ceil(count(*) / 30) as bigint) as pages from jd_auction_spider where 城市 is not null group by 1",
}
