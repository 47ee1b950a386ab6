"""Conforming tables to one schema: alias ladders, defaults, ordered columns, unions of differing columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelbase.functions.text import non_blank


def first_said(df: DataFrame, names: list[str], trimmed: bool = True) -> Column:
    """The first of the columns that says something; columns that the table lacks are passed over."""
    have = [F.col(f"`{n}`").cast("string") for n in names if n in df.columns]
    return F.coalesce(*(non_blank(c) if trimmed else F.nullif(c, F.lit("")) for c in have)) if have else F.lit(None).cast("string")


def find_column(columns: list[str], candidates: list[str]) -> str | None:
    return next((c for c in candidates if c in columns), None)


def conform(df: DataFrame, target: list[str], aliases: dict[str, list[str]], derived: dict[str, Column] | None = None, defaults: dict[str, str] | None = None) -> DataFrame:
    """Exactly the target columns in their order: a derived value, else the same-named column, else its aliases, else the default, else empty text."""
    derived, defaults = derived or {}, defaults or {}

    def value(t: str) -> Column:
        ladder = [derived[t].cast("string")] if t in derived else []
        return F.coalesce(*ladder, first_said(df, [t, *aliases.get(t, [])]), F.lit(defaults.get(t, ""))).alias(t)

    return df.select(*(value(t) for t in target))


def ordered(df: DataFrame, first: list[str]) -> DataFrame:
    """The named columns first (missing ones as empty text), then the rest as they stand."""
    return df.select(*(F.col(f"`{c}`") if c in df.columns else F.lit("").alias(c) for c in first), *(F.col(f"`{c}`") for c in df.columns if c not in first))


def union_all(frames: dict[str, DataFrame], tag: str | None = None) -> DataFrame:
    """All rows; a table without a column gives null there; ``tag`` names the table of each row."""
    tagged = [f.withColumn(tag, F.lit(n)) if tag else f for n, f in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def unique_headers(names: list[str | None]) -> list[str]:
    """Header cells as column names: blank ones numbered, repeated ones counted."""
    out: list[str] = []
    for k, n in enumerate(names, 1):
        base = (n or "").strip() or f"列{k}"
        name, i = base, 2
        while name in out:
            name, i = f"{base}_{i}", i + 1
        out.append(name)
    return out


def require(df: DataFrame, names: list[str]) -> DataFrame:
    if lacking := [n for n in names if n not in df.columns]:
        raise ValueError(f"columns missing: {lacking}")
    return df


def same_header(*frames: DataFrame) -> None:
    if any(f.columns != frames[0].columns for f in frames):
        raise ValueError("the tables' headers differ")
