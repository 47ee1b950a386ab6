"""Assembling rows from landed parts: filling and repairing fields, region trees, ranges of days, supervision of logs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelbase.functions.text import is_blank, non_blank, norm_id


def fill_or_repair(df: DataFrame, parsed: dict[str, Column], cleaned: dict[str, Callable[[Column], Column]], source: str = "") -> DataFrame:
    """Each field keeps its value, cleaned, where that says something, else takes the parsed one.

    ``filled`` names the fields that were blank, ``repaired`` those whose value changed; ``source`` is noted where either is. Values are
    worked out from the row as it comes in.
    """
    old = {f: F.col(f"`{f}`").cast("string") for f in parsed}
    own = {f: non_blank(cleaned[f](old[f])) if f in cleaned else non_blank(old[f]) for f in parsed}
    new = {f: F.coalesce(own[f], non_blank(v)) for f, v in parsed.items()}
    names = lambda ok: F.array_compact(F.array(*(F.when(ok(f), F.lit(f)) for f in parsed)))
    filled = names(lambda f: is_blank(old[f]) & new[f].isNotNull())
    repaired = names(lambda f: ~is_blank(old[f]) & new[f].isNotNull() & (new[f] != old[f]))
    out = df.select(*(F.coalesce(new[c], old[c]).alias(c) if c in parsed else F.col(f"`{c}`") for c in df.columns), filled.alias("filled"), repaired.alias("repaired"))
    return out.withColumn("fill_source", F.when((F.size("filled") > 0) | (F.size("repaired") > 0), F.lit(source)).otherwise(F.lit("")))


def fill_counts(done: DataFrame, fields: list[str]) -> DataFrame:
    """field_name, filled, repaired and kept of a table made by :func:`fill_or_repair`, in one pass."""
    per = [F.struct(F.lit(f).alias("field_name"), F.array_contains("filled", f).alias("f"), F.array_contains("repaired", f).alias("r"), (~is_blank(F.col(f"`{f}`"))).alias("s")) for f in fields]
    x = done.select(F.explode(F.array(*per)).alias("x")).select("x.*")
    return x.groupBy("field_name").agg(F.count_if("f").alias("filled"), F.count_if("r").alias("repaired"), F.count_if(F.col("s") & ~F.col("f") & ~F.col("r")).alias("kept"))


def copies(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns under other names besides their own (target to source), blank where a table lacks the source; a target that says something is kept."""
    have = set(df.columns)
    value = lambda t, s: F.coalesce(*([non_blank(F.col(f"`{t}`").cast("string"))] if t in have else []), *([F.col(f"`{s}`").cast("string")] if s in have else []), F.lit(""))
    return df.withColumns({t: value(t, s) for t, s in names.items()})


def update_said(base: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """The patch's values in the place of the base's where they say something; the patch has each key once."""
    src = patch.select(F.col(f"`{key}`"), *(F.col(f"`{c}`").alias(f"_p_{c}") for c in patch.columns if c != key))
    out = base.join(src, key, "left")
    shared = [c for c in patch.columns if c != key]
    cols = [F.coalesce(non_blank(F.col(f"`_p_{c}`").cast("string")), F.col(f"`{c}`").cast("string")).alias(c) if c in shared else F.col(f"`{c}`") for c in base.columns]
    return out.select(*cols, *(F.col(f"`_p_{c}`").alias(c) for c in shared if c not in base.columns))


def pending_details(df: DataFrame, status: Column, done: str = "已解析") -> DataFrame:
    """Rows whose trimmed status isn't ``done``."""
    return df.where(F.coalesce(F.trim(status) != done, F.lit(True)))


def wants_text(df: DataFrame, wanted: list[str], force: bool = False, all_of: list[str] = ()) -> DataFrame:
    """Rows where one of the ``wanted`` fields says nothing, or all of ``all_of`` do; all rows if forced."""
    if force:
        return df
    some = reduce(lambda a, b: a | b, (is_blank(F.col(f"`{c}`").cast("string")) for c in wanted))
    every = reduce(lambda a, b: a & b, (is_blank(F.col(f"`{c}`").cast("string")) for c in all_of)) if all_of else F.lit(False)
    return df.where(some | every)


def not_failed(df: DataFrame, log: DataFrame, key: str, status: Column, failed: tuple[str, ...] = ("失败",)) -> DataFrame:
    """Rows whose key's last log row isn't a known failure. log: key, _at (the order) and the status' columns."""
    last = log.groupBy(F.col(f"`{key}`")).agg(F.max_by(status, F.col("_at")).alias("_s"))
    return df.join(last.where(F.col("_s").isin(*failed)).select(key), key, "left_anti")


def in_scope(df: DataFrame, group: Column, code: Column, prefix: Column, least: float = 0.8) -> DataFrame:
    """group, n, coded, inside and in_scope: whether at least so large a share of a group's codes begin with what is expected; a missing code counts as inside."""
    inside = F.coalesce(code.startswith(prefix), F.lit(True)) | is_blank(code)
    return df.groupBy(group.alias("group")).agg(F.count("*").alias("n"), F.count_if(~is_blank(code)).alias("coded"), F.count_if(inside).alias("inside")).withColumn("in_scope", F.col("inside") >= least * F.col("n"))


def tree_children(trees: dict[str, DataFrame], overrides: DataFrame | None = None) -> DataFrame:
    """parent, child, code, pos and vintage of several vintages of a division tree. trees: name to code, name, children (array of struct code, name), the preferred first.

    A parent's children come whole from the first vintage that has any, the overrides (parent, child, code, pos) before all.
    """
    parts = [] if overrides is None else [overrides.select("parent", "child", "code", "pos").withColumn("rank", F.lit(0)).withColumn("vintage", F.lit("override"))]
    for k, (name, t) in enumerate(trees.items(), 1):
        parts.append(t.select(F.col("name").alias("parent"), F.posexplode("children").alias("pos", "c")).select("parent", F.col("c.name").alias("child"), F.col("c.code").alias("code"), F.col("pos").cast("bigint").alias("pos"), F.lit(k).alias("rank"), F.lit(name).alias("vintage")))
    rows = reduce(DataFrame.unionByName, parts)
    first = rows.groupBy("parent").agg(F.min("rank").alias("rank"))
    return rows.join(first, ["parent", "rank"]).select("parent", "child", "code", "pos", "vintage")


def day_ranges(df: DataFrame, key: list[str], start: Column, end: Column) -> DataFrame:
    """A row for each calendar year that a range of days touches: range_start, range_end and bucket_no."""
    years = F.posexplode(F.sequence(F.year(start), F.year(end)))
    cut = df.select(*key, start.alias("_s"), end.alias("_e"), years.alias("bucket_no", "_y"))
    return cut.select(*key, "bucket_no", F.greatest("_s", F.make_date("_y", F.lit(1), F.lit(1))).alias("range_start"), F.least("_e", F.make_date("_y", F.lit(12), F.lit(31))).alias("range_end"))


def halved(df: DataFrame, start: str, end: str, n: Column, most: int) -> DataFrame:
    """Ranges that hold more than ``most`` rows cut at their middle day; a range of one day is kept whole however many it holds."""
    mid = F.date_add(F.col(start), F.floor(F.datediff(F.col(end), F.col(start)) / 2).cast("int"))
    two = F.array(F.struct(F.col(start).alias("s"), mid.alias("e")), F.struct(F.date_add(mid, 1).alias("s"), F.col(end).alias("e")))
    cut = F.when((n > most) & (F.col(start) < F.col(end)), two).otherwise(F.array(F.struct(F.col(start).alias("s"), F.col(end).alias("e"))))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (start, end)]
    return df.select(*rest, F.explode(cut).alias("_x")).select(*rest, F.col("_x.s").alias(start), F.col("_x.e").alias(end))


def supervision(log: DataFrame, wanted: DataFrame, key: Column, done: Column) -> DataFrame:
    """One row: log rows, different ids, repeated rows, finished ids, the target (different wanted ids) and whether it is met."""
    got = log.select(key.alias("k"), F.coalesce(done, F.lit(False)).alias("d"))
    one = got.agg(F.count("*").alias("log_rows"), F.countDistinct("k").alias("ids"), F.countDistinct(F.when(F.col("d"), F.col("k"))).alias("finished"))
    target = wanted.agg(F.countDistinct(key).alias("target"))
    return one.crossJoin(F.broadcast(target)).select("log_rows", "ids", (F.col("log_rows") - F.col("ids")).alias("repeated"), "finished", "target", (F.col("finished") >= F.col("target")).alias("met"))  # one row is joined


def row_contexts(df: DataFrame, row_id: str, title: Column, text: Column, patterns: list[str], before: int = 1, after: int = 2) -> DataFrame:
    """row_id, line_no and context of the first line of a text that holds one of the names that a title gives (by patterns, group 1), white space aside."""
    names = F.array_distinct(F.flatten(F.array(*(F.regexp_extract_all(title, F.lit(p), 1) for p in patterns))))
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    cut = df.select(F.col(f"`{row_id}`"), F.filter(names, lambda x: x != "").alias("_n"), lines.alias("_l"))
    hit = F.transform("_l", lambda line, i: F.when(F.exists("_n", lambda n: F.replace(line, F.lit(" ")).contains(F.replace(n, F.lit(" ")))), i + 1))
    at = F.array_min(F.array_compact(hit))
    found = cut.withColumn("_at", at).where("_at is not null")
    start = F.greatest(F.col("_at") - before, F.lit(1))
    return found.select(row_id, F.col("_at").alias("line_no"), F.array_join(F.slice("_l", start, F.col("_at") + after - start + 1), " ").alias("context"))


def listing_key() -> Column:
    return norm_id(F.col("标的物ID"))
