"""Order-dependent merge of two platforms' listings.

Rows come in one order. A row joins the cluster of its own platform key, else the cluster of the first of its composite keys
whose rows are all of other platforms. A merged row keeps the base's values and fills blank ones; the fuller row is the
base; keys that a fill creates count at once.

Every composite key holds one of the row's long texts, and a merged row's texts come from its members, so rows that can meet
are connected by platform keys and long texts. Rows of one platform key are one entity to begin with. Texts connect entities
only where they can lead to a meeting: a row joins a cluster by its own key, and a cluster's keys come from its entities'
figures, so an entity whose rows together lack the figures of every composite key neither joins nor is joined; and rows meet
across platforms, so a text that entities of one platform only hold leads nowhere. Connected components are found by
spreading the smallest label over what is left, in rounds that each write a checkpoint; within a component the rows are folded
in order. A component is folded in one task, as the order demands; its size is reported by ``component_sizes``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelbase.functions.clean import text_key_of
from gavelbase.functions.numerals import narrow
from gavelbase.functions.text import EMPTY_WORDS
from gavelbase.session import checkpoint


@dataclass(frozen=True)
class Rules:
    """Columns of the merge. texts: long texts in order; figures: column groups, each the first that says something; combos: the figures that a key needs besides its text."""

    link: str
    item: str
    title: str
    end: str
    texts: tuple[str, ...]
    figures: dict[str, tuple[str, ...]]
    combos: tuple[tuple[str, ...], ...]
    weights: dict[str, int]
    least_text: int = 8
    #: Column of a count of attachments, of which at most ten add to a row's score.
    counted: str = ""


#: The texts, figures and keys by which rows of two platforms are one listing.
FULL_RULES = Rules(
    link="链接", item="标的物ID", title="标题", end="结束时间", texts=("详情地址", "地址", "标的物名称", "标的名称", "标题"),
    figures={"area": ("建筑面积",), "start": ("起拍价_元",), "current": ("当前价_元",), "assess": ("评估价_元", "市场价_元"), "date": ("结束时间", "成交时间"), "court": ("法院/处置机构", "处置机构")},
    combos=(("area", "start", "current", "date"), ("area", "start", "date"), ("area", "assess", "date"), ("start", "current", "date", "court"), ("area", "start", "current")),
    weights={"标的物名称": 3, "详情地址": 3, "建筑面积": 4, "评估价_元": 3, "市场价_元": 3, "附件抓取状态": 2, "标的物介绍文本": 6, "竞买公告文本": 4, "附件索引原文": 4}, counted="附件数量",
)


def _said(v) -> str:
    s = "" if v is None else str(v).strip()
    return "" if s.lower() in EMPTY_WORDS else s


def _figure(kind: str, v: str) -> str:
    if kind == "date":
        m = re.search(r"(\d{4})\D+(\d{1,2})\D+(\d{1,2})", v)
        return f"{m[1]}-{int(m[2]):02}-{int(m[3]):02}" if m else v[:10]
    if kind == "court":
        return text_key_of(v)
    m = re.search(r"\d+(?:\.\d+)?", narrow(v).replace(",", ""))
    if not m or float(m[0]) <= 0:
        return ""
    return f"{float(m[0]):.2f}" if kind == "area" else str(round(float(m[0]) * (1e4 if "万" in v else 1)))


class Fold:
    """The clusters of one component."""

    def __init__(self, rules: Rules):
        self.rules, self.rows, self.sources, self.members, self.scores = rules, [], [], [], []
        self.by_platform: dict[str, int] = {}
        self.by_key: dict[str, int] = {}

    def texts(self, row: dict) -> list[str]:
        keys = (text_key_of(_said(row.get(t))) for t in self.rules.texts)
        return list(dict.fromkeys(k for k in keys if len(k) >= self.rules.least_text))

    def platform_key(self, row: dict, source: str) -> str:
        if link := _said(row.get(self.rules.link)).rstrip("/"):
            return f"{source}|link|{link}"
        if item := re.sub(r"\.0+$", "", narrow(_said(row.get(self.rules.item))).strip()):
            return f"{source}|id|{item}"
        return f"{source}|row|{text_key_of(_said(row.get(self.rules.title)))}|{_figure('date', _said(row.get(self.rules.end)))}"

    def figures(self, row: dict) -> dict[str, str]:
        return {k: _figure(k, next((s for c in cols if (s := _said(row.get(c)))), "")) for k, cols in self.rules.figures.items()}

    def keys(self, row: dict) -> list[str]:
        figures = self.figures(row)
        return ["|".join((*need, t, *(figures[k] for k in need))) for t in self.texts(row) for need in self.rules.combos if all(figures[k] for k in need)]

    def score(self, row: dict) -> int:
        files = re.fullmatch(r"\d+(?:\.\d+)?", _said(row.get(self.rules.counted))) if self.rules.counted else None
        return sum(bool(_said(v)) + (self.rules.weights.get(c, 0) if _said(v) else 0) for c, v in row.items()) + (min(int(float(files[0])), 10) if files else 0)

    def add(self, row: dict, source: str, name: int) -> None:
        own = self.platform_key(row, source)
        at = self.by_platform.get(own)
        if at is None:
            at = next((k for key in self.keys(row) if (k := self.by_key.get(key)) is not None and source not in self.sources[k]), None)
        if at is None:
            at = len(self.rows)
            self.rows.append(row)
            self.sources.append({source})
            self.members.append([])
            self.scores.append(self.score(row))
        else:
            held = self.rows[at]
            better = self.score(row) > self.scores[at]
            base, other = (row, held) if better else (held, row)
            merged = {c: v if _said(v) else other.get(c) if _said(other.get(c)) else v for c, v in base.items()}
            self.scores[at] = self.score(merged) if better else max(self.scores[at], self.score(merged))
            self.rows[at] = merged
            self.sources[at].add(source)
        self.members[at].append(name)
        self.by_platform[own] = at
        for key in self.keys(self.rows[at]):
            self.by_key.setdefault(key, at)


def _links(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """_seq and entity (the hash of its platform key) of each row, and the links: entity and the hash of a text by which it may meet others."""
    names = list(rules.figures)

    def hashes(frames):
        fold = Fold(rules)
        for x in frames:
            out = []
            for r in x.to_dict("records"):
                figures = fold.figures(r)
                out.append((r["_seq"], r["_source"], fold.platform_key(r, r["_source"]), [bool(figures[n]) for n in names], fold.texts(r)))
            yield pd.DataFrame(out, columns=["_seq", "_source", "entity", "has", "texts"])

    rows = checkpoint(df.mapInPandas(hashes, "_seq bigint, _source string, entity string, has array<boolean>, texts array<string>").withColumn("entity", F.xxhash64("entity")))
    has = lambda n: F.max(F.col("has")[names.index(n)].cast("int")) == 1
    whole = reduce(lambda a, b: a | b, (reduce(lambda a, b: a & b, (has(n) for n in need)) for need in rules.combos))
    able = rows.groupBy("entity").agg(whole.alias("able")).where("able").select("entity")
    texts = rows.select("entity", "_source", F.explode("texts").alias("k")).select("entity", "_source", F.xxhash64("k").alias("k")).distinct().join(able, "entity")
    shared = texts.groupBy("k").agg(F.min("_source").alias("a"), F.max("_source").alias("b")).where("a <> b").select("k")
    return rows.select("_seq", "entity"), checkpoint(texts.join(shared, "k").select(F.col("entity").alias("_seq"), "k").distinct())


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """_seq and the smallest _seq that it is connected with, for what has a link. Keys are stars: a round spreads each key's smallest label and each row's."""
    label = checkpoint(links.select("_seq").distinct().withColumn("component", F.col("_seq")))
    for _ in range(most_rounds):
        least = links.join(label, "_seq").groupBy("k").agg(F.min("component").alias("c"))
        new = links.join(least, "k").groupBy("_seq").agg(F.min("c").alias("component"))
        # a label's own label shortens long chains
        jump = new.join(new.select(F.col("_seq").alias("component"), F.col("component").alias("to")), "component").select("_seq", F.least("component", "to").alias("component"))
        jump = checkpoint(jump)
        if jump.join(label.withColumnRenamed("component", "old"), "_seq").where("component <> old").limit(1).count() == 0:
            return jump
        label = jump
    raise RuntimeError("the components did not settle")


def component_sizes(df: DataFrame, source: str, order: str, rules: Rules) -> DataFrame:
    own = df.withColumn("_source", F.col(f"`{source}`")).withColumn("_seq", F.col(f"`{order}`").cast("bigint"))
    return _components(own, rules).groupBy("component").agg(F.count("*").alias("rows")).groupBy("rows").agg(F.count("*").alias("components"))


def _components(own: DataFrame, rules: Rules) -> DataFrame:
    """_seq and component of each row: its entity's, or that of the entities its texts connect it with."""
    rows, links = _links(own, rules)
    joined = components(links).withColumnRenamed("_seq", "entity")
    return rows.join(joined, "entity", "left").select("_seq", F.coalesce("component", "entity").alias("component"))


def merge_platforms(df: DataFrame, source: str, order: str, rules: Rules) -> DataFrame:
    """One row per cluster: the merged values, ``sources`` and ``members`` (the order numbers of its rows). All value columns are strings."""
    values = [c for c in df.columns if c not in (source, order)]
    own = df.select(F.col(f"`{source}`").alias("_source"), F.col(f"`{order}`").cast("bigint").alias("_seq"), *(F.col(f"`{c}`").cast("string").alias(c) for c in values))
    own = checkpoint(own)
    grouped = own.join(_components(own, rules), "_seq")

    def fold(x: pd.DataFrame) -> pd.DataFrame:
        f = Fold(rules)
        for r in x.sort_values("_seq").to_dict("records"):
            f.add({c: r[c] for c in values}, r["_source"], r["_seq"])
        return pd.DataFrame([{**row, "sources": sorted(s), "members": m} for row, s, m in zip(f.rows, f.sources, f.members)], columns=[*values, "sources", "members"])

    schema = ", ".join(f"`{c}` string" for c in values) + ", sources array<string>, members array<bigint>"
    return grouped.groupBy("component").applyInPandas(fold, schema)
