"""Joins of an index with detail logs under the collision rules in use, overlays, resume and lookup joins.

All are equi joins left to the optimizer: a small side is broadcast by its size, a skewed one is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelbase.functions.text import is_blank


def _shared(base: DataFrame, detail: DataFrame, key: str) -> list[str]:
    return [c for c in detail.columns if c in base.columns and c != key]


def base_wins(base: DataFrame, detail: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Columns of both come from the base."""
    return base.join(detail.drop(*_shared(base, detail, key)), key, how)


def detail_wins(base: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """Columns of both come from the detail; rows without a detail lose theirs."""
    return base.drop(*_shared(base, detail, key)).join(detail, key, "left")


def override(base: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """Columns of both come from the detail where a row has one, even blank values; other rows keep the base's."""
    shared = _shared(base, detail, key)
    marked = detail.select(F.col(f"`{key}`"), F.lit(True).alias("_hit"), *(F.col(f"`{c}`").alias(f"_d_{c}") for c in detail.columns if c != key))
    out = base.join(marked, key, "left")
    cols = [F.when(F.col("_hit"), F.col(f"`_d_{c}`")).otherwise(F.col(f"`{c}`")).alias(c) if c in shared else F.col(f"`{c}`") for c in base.columns]
    return out.select(*cols, *(F.col(f"`_d_{c}`").alias(c) for c in detail.columns if c != key and c not in shared))


def fill_from(base: DataFrame, other: DataFrame, key: str, cols: dict[str, str], placeholders: tuple[str, ...] = ()) -> DataFrame:
    """Blank values (or placeholders) of the base filled from another table (target to source column); ``changed`` names the filled ones."""
    src = other.select(F.col(f"`{key}`"), *(F.col(f"`{s}`").alias(f"_s_{t}") for t, s in cols.items()))
    out = base.join(src, key, "left")
    empty = {t: is_blank(F.col(f"`{t}`")) | F.coalesce(F.col(f"`{t}`").isin(*placeholders), F.lit(False)) if placeholders else is_blank(F.col(f"`{t}`")) for t in cols}
    fills = {t: e & ~is_blank(F.col(f"`_s_{t}`")) for t, e in empty.items()}
    changed = F.array_compact(F.array(*(F.when(f, F.lit(t)) for t, f in fills.items())))
    return out.select(*(F.when(fills[c], F.col(f"`_s_{c}`")).otherwise(F.col(f"`{c}`")).alias(c) if c in cols else F.col(f"`{c}`") for c in base.columns), changed.alias("changed"))


def overlay(base: DataFrame, patch: DataFrame, key: str, append: bool = True) -> DataFrame:
    """Rows of the patch in the place of the base's rows of the same key; with ``append`` also those of new keys. The patch has each key once."""
    mark = patch.select(F.col(f"`{key}`"), F.struct(*(F.col(f"`{c}`") for c in base.columns)).alias("_p"))
    own = base.select(F.col(f"`{key}`"), F.struct(*(F.col(f"`{c}`") for c in base.columns)).alias("_b"))
    return own.join(mark, key, "full_outer" if append else "left").select(F.coalesce("_p", "_b").alias("_r")).select("_r.*")


def pending(wanted: DataFrame, log: DataFrame, key: str, done: Column) -> DataFrame:
    """Wanted rows without a finished log row."""
    return wanted.join(log.where(done).select(F.col(f"`{key}`")).distinct(), key, "left_anti")


def only(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    return df.join(wanted.select(F.col(f"`{key}`")).distinct(), key, "left_semi")


def lookup(df: DataFrame, dim: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Values of a table of unique keys; where the key is found they replace the row's own."""
    hit = dim.select(F.col(f"`{key}`"), *(F.col(f"`{c}`").alias(f"_h_{c}") for c in cols), F.lit(True).alias("_hit"))
    out = df.join(hit, key, "left")
    keep = [c for c in df.columns if c not in cols]
    return out.select(*(F.col(f"`{c}`") for c in keep), *((F.when(F.col("_hit"), F.col(f"`_h_{c}`")).otherwise(F.col(f"`{c}`")) if c in df.columns else F.col(f"`_h_{c}`")).alias(c) for c in cols))


def divisions(names: DataFrame, tree: DataFrame) -> DataFrame:
    """The first child division of a parent whose name equals or contains a token or is contained in it.

    names: parent, token; tree: parent, child, code, pos. The parents join by hash; only a parent's own children are compared.
    """
    hit = names.join(tree, "parent").where((F.col("token") == F.col("child")) | F.col("token").contains(F.col("child")) | F.col("child").contains(F.col("token")))
    return hit.groupBy("parent", "token").agg(F.min_by(F.struct("child", "code"), F.col("pos")).alias("c")).select("parent", "token", "c.child", "c.code")
