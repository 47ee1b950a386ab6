"""Operators on ordered scans: stop at a cutoff, resume after a mark, stop after a run without news, gaps and runs.

A scan is cut into ranges of its order of ``RANGE_ROWS`` rows; running sums are made within ranges and over the ranges'
totals, so no scan is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_ROWS = 100_000


def running(df: DataFrame, order: Column, value: Column, out: str) -> DataFrame:
    """The sum of ``value`` up to each row in the order (a bigint without repeats)."""
    cut = df.withColumn("_o", order.cast("bigint")).withColumn("_v", value)
    bounds = cut.agg(F.min("_o").alias("lo"), F.max("_o").alias("hi"), F.count("*").alias("n"))
    width = F.greatest(F.ceil((F.col("hi") - F.col("lo") + 1) / F.greatest(F.ceil(F.col("n") / RANGE_ROWS), F.lit(1))), F.lit(1))
    cut = cut.crossJoin(F.broadcast(bounds.select("lo", width.alias("width")))).withColumn("_r", F.floor((F.col("_o") - F.col("lo")) / F.col("width")))  # one row is joined
    totals = cut.groupBy("_r").agg(F.sum("_v").alias("_t"))
    before = totals.select("_r", F.coalesce(F.sum("_t").over(Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))  # one row for each range
    w = Window.partitionBy("_r").orderBy("_o").rowsBetween(Window.unboundedPreceding, 0)
    return cut.join(before, "_r").withColumn(out, F.col("_b") + F.sum("_v").over(w)).drop("_o", "_v", "_r", "_b", "lo", "width")


def until(df: DataFrame, order: Column, stop: Column) -> DataFrame:
    """Rows up to and with the first that meets the condition."""
    first = df.where(stop).agg(F.min(order).alias("_m"))
    return df.crossJoin(F.broadcast(first)).where(F.col("_m").isNull() | (order <= F.col("_m"))).drop("_m")  # one row is joined


def after_last(df: DataFrame, order: Column, mark: Column) -> DataFrame:
    """Rows after the last that meets the condition; all rows if none does."""
    last = df.where(mark).agg(F.max(order).alias("_m"))
    return df.crossJoin(F.broadcast(last)).where(F.col("_m").isNull() | (order > F.col("_m"))).drop("_m")  # one row is joined


def until_no_news(df: DataFrame, order: str, page: Column, item: str, pages: int = 5) -> DataFrame:
    """Per page: its new items, and whether the scan has stopped before it, ``pages`` pages in a row having brought no new item."""
    first = df.groupBy(item).agg(F.min(order).alias(order)).withColumn("_new", F.lit(1))
    by_page = df.join(first, [item, order], "left").groupBy(page.alias("page")).agg(F.coalesce(F.sum("_new"), F.lit(0)).alias("new_items"))
    runs = running(by_page, F.col("page"), (F.col("new_items") > 0).cast("bigint"), "_seen")
    w = Window.partitionBy("_seen").orderBy("page")
    ranked = runs.withColumn("_k", F.row_number().over(w) - F.when(F.col("_seen") > 0, 1).otherwise(0)).withColumn("empty_run", F.when(F.col("new_items") > 0, 0).otherwise(F.col("_k")))
    return until(ranked, F.col("page"), F.col("empty_run") >= pages).select("page", "new_items", F.col("empty_run").cast("bigint").alias("empty_run"))
