"""Deduplication and grouped reductions. Every reduction is an aggregate with partial sums, so a hot key is reduced before it is shuffled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelbase.functions.text import is_blank


def filled(c: Column) -> Column:
    return (~is_blank(c.cast("string"))).cast("int")


def completeness(cols: list[str]) -> Column:
    """How many of the columns say something."""
    return reduce(lambda a, b: a + b, (filled(F.col(f"`{c}`")) for c in cols), F.lit(0))


def score(cols: list[str], weights: dict[str, int], counted: str | None = None, most: int = 10) -> Column:
    """Completeness with extra weights for some columns, and a count of at most ``most`` added."""
    s = completeness(cols)
    for c, w in weights.items():
        s = s + filled(F.col(f"`{c}`")) * w
    return s + (F.least(F.coalesce(F.col(f"`{counted}`").try_cast("int"), F.lit(0)), F.lit(most)) if counted else F.lit(0))


def _whole(df: DataFrame) -> Column:
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def keep_best(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The row of each key that comes first in the order; the order must tell all rows of a key apart."""
    return df.groupBy(key.alias("_k")).agg(F.min_by(_whole(df), F.struct(*(c.alias(f"o{k}") for k, c in enumerate(order)))).alias("_r")).select("_r.*")


def keep_most_complete(df: DataFrame, key: Column, tie: Column, cols: list[str] | None = None) -> DataFrame:
    """The fullest row of each key; among equals the first by ``tie``."""
    return keep_best(df, key, -completeness(cols or df.columns), tie)


def keep_last(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The last row of each key by the order, as in an append log."""
    return df.groupBy(key.alias("_k")).agg(F.max_by(_whole(df), F.struct(*(c.alias(f"o{k}") for k, c in enumerate(order)))).alias("_r")).select("_r.*")


def group_reduce(df: DataFrame, key: str, cols: list[str], trusted: Column, order: Column) -> DataFrame:
    """Per key and column the first value that says something among trusted rows, else among all; ``first_seen`` orders the groups."""

    def first(c: str, where: Column) -> Column:
        v = F.col(f"`{c}`")
        ok = where & ~is_blank(v.cast("string"))
        return F.min_by(F.when(ok, v), F.when(ok, order))

    aggs = [F.coalesce(first(c, trusted), first(c, F.lit(True))).alias(c) for c in cols]
    return df.groupBy(F.col(f"`{key}`")).agg(F.min(order).alias("first_seen"), F.count("*").alias("n_rows"), *aggs)


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """All rows of keys that occur more than once. Keys are counted first and joined, so no key is windowed in one task."""
    several = df.groupBy(*keys).agg(F.count("*").alias("n_copies")).where("n_copies > 1")
    return df.join(several, list(keys))


def ordered_distinct(df: DataFrame, key: Column, order: Column) -> DataFrame:
    """Each key once, with the place where it is first seen."""
    return df.groupBy(key.alias("key")).agg(F.min(order).alias("first_seen"))


def joined_values(df: DataFrame, key: str, value: Column, order: Column, most: int | None = None, sep: str = "；") -> DataFrame:
    """Distinct values of each key in the order of their first rows, joined. Distinct values are reduced before they are collected."""
    firsts = df.groupBy(F.col(f"`{key}`"), value.alias("_v")).agg(F.min(order).alias("_o")).where(~is_blank(F.col("_v")))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_o", "_v"))), lambda x: x["_v"])
    return firsts.groupBy(F.col(f"`{key}`")).agg(F.array_join(F.slice(listed, 1, most) if most else listed, sep).alias("joined"))


def first_k(df: DataFrame, key: str, k: int, *order: Column) -> DataFrame:
    """The first k rows of each key, with their rank."""
    w = Window.partitionBy(F.col(f"`{key}`")).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def coverage(df: DataFrame, cols: list[str], also_empty: tuple[str, ...] = ("0",)) -> DataFrame:
    """field_name, filled and rate of each column in one pass over the table."""
    ok = {c: filled(F.col(f"`{c}`")) * F.coalesce((~F.col(f"`{c}`").cast("string").isin(*also_empty)).cast("int"), F.lit(0)) for c in cols}
    one = df.agg(F.count("*").alias("_n"), *(F.coalesce(F.sum(v), F.lit(0)).alias(f"c{k}") for k, v in enumerate(ok.values())))
    fields = F.explode(F.array(*(F.struct(F.lit(c).alias("f"), F.col(f"c{k}").alias("n")) for k, c in enumerate(cols))))
    return one.select("_n", fields.alias("x")).select(F.col("x.f").alias("field_name"), F.col("x.n").cast("bigint").alias("filled"), F.when(F.col("_n") > 0, F.round(F.col("x.n") / F.col("_n"), 4)).otherwise(F.lit(0.0)).alias("rate"))


def gaps(df: DataFrame, signals: dict[str, tuple[Column, str]]) -> DataFrame:
    """Per field: rows where it is blank, and those of them whose text shows a sign of it. signals: field to text and pattern."""
    aggs, names = [], list(signals)
    for k, (c, (text, pattern)) in enumerate(signals.items()):
        blank = is_blank(F.col(f"`{c}`"))
        aggs += [F.count_if(blank).alias(f"m{k}"), F.count_if(blank & F.coalesce(text.rlike(pattern), F.lit(False))).alias(f"s{k}")]
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("field_name"), F.col(f"m{k}").alias("missing"), F.col(f"s{k}").alias("with_signal")) for k, c in enumerate(names))))
    return df.agg(*aggs).select(rows.alias("x")).select("x.*")
