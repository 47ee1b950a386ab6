"""Mixing sources to target weights.

Method: a low-discrepancy schedule. The k-th slot's point frac(k * golden ratio) falls, by the cumulative target weights, to a
source, so every stretch of the schedule has the target shares almost exactly; a slot's rank within its source names the
block it takes. The documents of a source, shuffled by a hash, are laid end to end by their tokens and cut into blocks of
equal tokens; a source that is too small is shuffled again and repeated, at most as often as allowed.

The number of slots is the largest that no source's blocks, repeats included, fall short of, or the one asked for. Where the
blocks asked for would give less than ``SLOTS_EACH`` slots a target, they are cut smaller, so that a small corpus, or one with a
small source, still has a mix with the target shares.

Scale: running sums and ranks are made in two steps, within ranges of bounded size and over the ranges' totals, so no source
is ever ordered in one task. The targets are a small table whose size is checked.

Defined results: documents without a source, or of a source without a target, take no part; a null text has no tokens and is
left out; the target shares hold before the size, so the scarcest source sets the size of the whole mix, and a source with a
target but without documents limits it to nothing and is reported with share 0; repeated rows are documents of their own.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gavelbase.session import checkpoint

GOLDEN = (math.sqrt(5) - 1) / 2
#: At most so many sources may have a target; their table is broadcast.
MAX_TARGETS = 10_000
#: Rows of a source in one range, and slots in one range.
RANGE_ROWS = 50_000
#: So many slots for each target at least, on average; below that the blocks are cut smaller.
SLOTS_EACH = 64
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
_ENCODINGS: dict = {}


def _encoding(path: str):
    if path not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def token_counts(df: DataFrame, id_col: str, text_col: str, keep: list[str], tokenizer: str = TOKENIZER) -> DataFrame:
    """The named columns and the number of tokens of the whole text."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = _encoding(tokenizer)
        for x in frames:
            n = [len(encoding.encode_ordinary(t)) for t in x["_text"]]
            yield x.drop(columns="_text").assign(tokens=pd.Series(n, index=x.index, dtype="int64"))

    own = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), *(F.col(f"`{c}`").cast("string").alias(c) for c in keep), F.col(f"`{text_col}`").alias("_text")).where("_text is not null")
    return own.mapInPandas(count, ", ".join(["doc_id bigint", *(f"`{c}` string" for c in keep), "tokens bigint"]))


def running_sum(df: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    """The sum of ``value`` before each row of its key, by ``order`` (a bigint spread evenly, as a hash is); no key is ordered in one task."""
    n = df.groupBy(key).agg(F.count("*").alias("_n"))
    cut = df.join(n, key).withColumn("_r", F.floor((F.col(order).cast("double") / 2.0**63 + 1) / 2 * F.ceil(F.col("_n") / RANGE_ROWS)).cast("bigint"))
    sums = cut.groupBy(key, "_r").agg(F.sum(value).alias("_s"))
    before = sums.withColumn("_b", F.coalesce(F.sum("_s").over(Window.partitionBy(key).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    w = Window.partitionBy(key, "_r").orderBy(order, "_tie").rowsBetween(Window.unboundedPreceding, -1)
    return cut.join(before.select(key, "_r", "_b"), [key, "_r"]).withColumn(out, F.col("_b") + F.coalesce(F.sum(value).over(w), F.lit(0))).drop("_n", "_r", "_b")


def mix(df: DataFrame, targets: DataFrame, total_tokens: int | None = None, block_tokens: int = 2048, tokenizer: str = TOKENIZER, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """The mix and its report.

    targets: source, target_share, max_repeats. The mix has slot_no, source, block_no, doc_id, repeat_no and tokens; a
    document belongs to the block in which it starts. A block has block_tokens tokens, or less where few fit. The report has source, target_share, actual_share, tokens, documents,
    repeats_used and max_repeats.
    """
    spark = df.sparkSession
    goal = targets.select("source", F.col("target_share").cast("double"), F.col("max_repeats").cast("int")).where("source is not null and target_share > 0 and max_repeats > 0")
    rows = goal.orderBy("source").limit(MAX_TARGETS + 1).collect()
    if len(rows) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    small = spark.createDataFrame([tuple(r) for r in rows], "source string, target_share double, max_repeats int")
    counted = token_counts(df, id_col, text_col, [source_col], tokenizer).withColumnRenamed(source_col, "source").where("source is not null and tokens > 0").join(F.broadcast(small.select("source")), "source")
    counted = checkpoint(counted)
    have = {r["source"]: r["t"] for r in counted.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}  # one row per target at most
    share_sum = sum(r["target_share"] for r in rows) or 1.0
    limit = min((have.get(r["source"], 0) * r["max_repeats"] / (r["target_share"] / share_sum) for r in rows), default=0.0)
    total = min(limit, total_tokens) if total_tokens is not None else limit
    block_tokens = min(block_tokens, max(1, int(total // (SLOTS_EACH * max(1, len(rows))))))
    slots = int(total // block_tokens)
    edges, up = [], 0.0
    for r in rows:
        edges.append((r["source"], up, up + r["target_share"] / share_sum))
        up = edges[-1][2]
    point = F.pmod(F.col("id") * F.lit(GOLDEN), F.lit(1.0))
    source = F.coalesce(*(F.when(point < hi, F.lit(s)) for s, _, hi in edges), F.lit(edges[-1][0])) if edges else F.lit(None).cast("string")
    slot = spark.range(slots).select(F.col("id").alias("slot_no"), source.alias("source"), F.floor(F.col("id") / RANGE_ROWS).alias("r"))
    before = slot.groupBy("source", "r").agg(F.count("*").alias("n")).withColumn("b", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    slot = slot.join(before.select("source", "r", "b"), ["source", "r"]).withColumn("block_no", F.col("b") + F.row_number().over(Window.partitionBy("source", "r").orderBy("slot_no")) - 1).select("slot_no", "source", "block_no")
    # the mix ends before the first slot whose source has no block left; the last block of a source may be a shorter one
    blocks = spark.createDataFrame([(r["source"], -(-have.get(r["source"], 0) * r["max_repeats"] // block_tokens)) for r in rows], "source string, blocks bigint")
    end = slot.join(F.broadcast(blocks), "source").where("block_no >= blocks").agg(F.min("slot_no").alias("end")).first()["end"]
    if end is not None:
        slots, slot = end, slot.where(F.col("slot_no") < end)

    # passes over a source: as many as its share of the slots needs, which its slots exceed by the discrepancy of the points at most
    over = 2 * (3 + math.log(slots + 1) / -math.log(GOLDEN))
    need = {r["source"]: math.ceil((r["target_share"] / share_sum * slots + over) * block_tokens / have[r["source"]]) if have.get(r["source"]) else 0 for r in rows}
    passes = spark.createDataFrame([(r["source"], min(need[r["source"]], r["max_repeats"]), have.get(r["source"], 0)) for r in rows], "source string, passes int, have bigint")
    copies = counted.join(F.broadcast(passes), "source").where("passes > 0").withColumn("repeat_no", F.explode(F.sequence(F.lit(1), F.col("passes"))))
    copies = copies.withColumn("_k", F.concat_ws("\u0001", "source", F.col("repeat_no").cast("string"))).withColumn("_o", F.xxhash64("doc_id", "repeat_no", F.lit(seed))).withColumn("_tie", F.col("doc_id"))
    placed = running_sum(copies, "_k", "_o", "tokens", "_at").withColumn("block_no", F.floor((F.col("_at") + (F.col("repeat_no") - 1) * F.col("have")) / block_tokens).cast("bigint"))
    mixed = placed.join(slot, ["source", "block_no"]).select("slot_no", "source", "block_no", "doc_id", "repeat_no", "tokens")

    got = mixed.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.countDistinct("doc_id").alias("documents"), F.max("repeat_no").alias("repeats_used"))
    report = (
        small.join(got, "source", "left")
        .select("source", "target_share", F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"), F.coalesce("documents", F.lit(0)).cast("bigint").alias("documents"), F.coalesce("repeats_used", F.lit(0)).cast("int").alias("repeats_used"), "max_repeats")
        .withColumn("actual_share", F.coalesce(F.try_divide("tokens", F.sum("tokens").over(Window.partitionBy(F.lit(1)))), F.lit(0.0)))
    )
    return mixed, report
