"""Evaluation texts that leaked into training text.

Method: q-gram lemma filter. A passage of m characters with at most e edits shares at least m + 1 - q (e + 1) q-grams with its
copy, all within a band of diagonals. For each document the q-grams it shares with each item are counted in overlapping
bands of diagonals; pairs with a band that meets the bound for a quarter of the item (one of two stretches that hold half of
it is at least that long) are verified by banded local alignment, and the two best stretches must hold the asked share.

Texts are compared in one form: look-alike characters mapped, case folded, only letters and digits kept, so layout,
punctuation and width don't count. Whole documents are scanned. The items' q-gram index is a stated query set: it is sent to
the tasks in blocks of at most ``BLOCK_CHARS`` characters, one scan of the documents for each block.

Defined results: null or empty documents and items give no rows; an item with fewer letters and digits than ``q`` can't be
found; equal items are each reported; repeated documents each give their rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelbase.llm.glyphs import decompositions

Q = 4
#: Edits allowed per character of a stretch.
BUDGET = 0.10
#: Most characters of items in one broadcast block (about 60 bytes each).
BLOCK_CHARS = 2_000_000
#: Characters of documents looked at together.
SCAN_CHARS = 1_000_000
#: Diagonals of a document lie within this, so a pair and a band make one number.
SHIFT = 1 << 26
_MULT = np.uint64(0x9E3779B97F4A7C15)
_DROP = re.compile(r"[\W_]+")


def plain(text: str, table: dict[int, str]) -> str:
    return _DROP.sub("", text.translate(table)).casefold()


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q code points from each place."""
    n = len(codes) - q + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(q):
        h = (h ^ codes[k : k + n].astype(np.uint64)) * _MULT
        h ^= h >> np.uint64(29)
    return h


class Index:
    """q-grams of items with their places."""

    def __init__(self, ids: list[int], texts: list[str], table: dict[str, str], q: int = Q, budget: float = BUDGET, share: float = 0.5):
        self.table = {ord(c): e for c, e in table.items()}
        pairs = [(i, t) for i, t in zip(ids, (plain(t, self.table) for t in texts)) if len(t) >= q]
        self.ids, self.texts = np.array([i for i, _ in pairs], np.int64), [t for _, t in pairs]
        self.size = np.array([len(t) for t in self.texts], np.int64)
        self.q, self.share = q, share
        part = np.maximum(np.ceil(self.size * share / 2), q)
        self.edits = np.floor(part * budget).astype(np.int64)
        self.bound = np.maximum(part + 1 - q * (self.edits + 1), 2).astype(np.int64)
        grams = [_grams(_codes(t), q) for t in self.texts]
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(hashes, kind="stable")
        self.item, self.place = item[order].astype(np.int64), place[order].astype(np.int64)
        self.keys, self.first = np.unique(hashes[order], return_index=True)
        self.last = np.append(self.first[1:], len(hashes))
        self.width = int(2 * max([1, *self.edits.tolist()]) + 2)

    def find(self, texts: list[str]) -> list[tuple[int, int, float]]:
        """Index of the text, index of the item and share found."""
        if not len(self.ids) or not texts:
            return []
        docs = [plain(t, self.table) for t in texts]
        starts = np.zeros(len(docs) + 1, np.int64)
        np.cumsum([len(t) + self.q for t in docs], out=starts[1:])
        codes = _codes("".join(t + "\0" * self.q for t in docs))
        grams = _grams(codes, self.q)
        at = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == grams)
        n = self.last[at[hit]] - self.first[at[hit]]
        where = np.repeat(hit, n)
        post = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[at[hit]], n)
        doc = np.searchsorted(starts, where, side="right") - 1
        item, place = self.item[post], self.place[post]
        diagonal = where - starts[doc] - place
        half = self.width // 2
        pair = doc * len(self.ids) + item
        band = diagonal // half  # each pair of neighbouring halves is one band, so bands overlap by half
        joint = pair * SHIFT + band + SHIFT // 2
        order = np.argsort(joint)
        joint, place = joint[order], place[order]
        first = np.flatnonzero(np.concatenate([[True], joint[1:] != joint[:-1]])) if len(joint) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(joint)))
        low, high = (np.minimum.reduceat(place, first), np.maximum.reduceat(place, first)) if len(first) else (first, first)
        pair, band = joint[first] // SHIFT, joint[first] % SHIFT - SHIFT // 2
        follows = np.zeros(len(count), np.int64)
        if len(count) > 1:
            near = (pair[1:] == pair[:-1]) & (band[1:] == band[:-1] + 1)
            follows[:-1][near] = count[1:][near]
        both = count + follows
        good = np.unique(pair[both >= self.bound[pair % len(self.ids)]]) if len(pair) else pair
        out = []
        lo, hi = np.searchsorted(pair, good), np.searchsorted(pair, good, side="right")
        for p, a, b in zip(good.tolist(), lo.tolist(), hi.tolist()):
            d, i = divmod(p, len(self.ids))
            least = max(4, self.bound[i] // 4)
            bands = []
            for k in range(a, b):
                if both[k] >= least or count[k] >= least:
                    n = k + 1 if follows[k] else k
                    bands.append((int(band[k]) * half, int(band[k] + 2) * half, int(min(low[k], low[n])), int(max(high[k], high[n])) + self.q, int(both[k])))
            found = self._verify(docs[d], self.texts[i], bands)
            if found >= self.share:
                out.append((d, i, found))
        return out

    def _verify(self, doc: str, item: str, bands: list[tuple[int, int, int, int, int]]) -> float:
        """The share of the item in its two best stretches. A band is aligned where its q-grams lie in the item, with room for edits at both ends; the fullest come first."""
        merged: list[list[int]] = []
        for lo, hi, a, b, n in sorted(bands):
            if merged and lo <= merged[-1][1] and hi - merged[-1][0] <= 8 * self.width:
                m = merged[-1]
                merged[-1] = [m[0], max(hi, m[1]), min(a, m[2]), max(b, m[3]), m[4] + n]
            else:
                merged.append([lo, hi, a, b, n])
        spans: list[tuple[int, int]] = []
        best, room = 0, 3 * self.q
        for lo, hi, low, high, _ in sorted(merged, key=lambda m: -m[4]):
            todo = [(max(0, low - room), min(len(item), high + room))]
            while todo:
                a, b = todo.pop()
                if b - a < 2 * self.q:
                    continue
                s = local_stretch(item, doc, a, b, lo - 2, hi + 2)
                if s is None or s[1] - s[0] < 2 * self.q:
                    continue
                spans.append(s)
                todo += [(a, s[0]), (s[1], b)]
                c, d = s
                best = max(best, d - c, *((f - e) + (d - c) - max(0, min(d, f) - max(c, e)) for e, f in spans))
            if best >= 0.99 * len(item):
                break
        return best / len(item)


def local_stretch(item: str, doc: str, a: int, b: int, lo: int, hi: int) -> tuple[int, int] | None:
    """The span of item[a:b] of the best local alignment with the document on diagonals lo to hi (match 1, edit -2)."""
    width = hi - lo + 1
    score, start = [0] * (width + 2), [a] * (width + 2)
    best, span, size = 0, None, len(doc)
    for i in range(a, b):
        c = item[i]
        new, begun = [0] * (width + 2), [i + 1] * (width + 2)
        left, left_start = 0, i + 1
        for k in range(max(0, -(i + lo)), min(width, size - i - lo)):
            s, t = (score[k] + 1, start[k] if score[k] else i) if doc[i + lo + k] == c else (score[k] - 2, start[k])
            if score[k + 1] - 2 > s:
                s, t = score[k + 1] - 2, start[k + 1]
            if left - 2 > s:
                s, t = left - 2, left_start
            if s > 0:
                new[k], begun[k] = s, t
                if s > best:
                    best, span = s, (t, i + 1)
            left, left_start = (s, t) if s > 0 else (0, i + 1)
        score, start = new, begun
    return span


def leaks(docs: DataFrame, items: DataFrame, share: float = 0.5, doc_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id and found_share of each document that holds at least ``share`` of an item in one stretch or two."""
    spark = docs.sparkSession
    own = docs.select(F.col(f"`{doc_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null")
    queries = items.select(F.col(f"`{item_col}`").cast("bigint").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null and item_id is not null")
    total = queries.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    queries = queries.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))

    def scan(block: int) -> DataFrame:
        rows = queries.where(F.col("_block") == block).orderBy("item_id", "text").collect()
        shared = spark.sparkContext.broadcast(([r["item_id"] for r in rows], [r["text"] for r in rows], decompositions(spark)))

        def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = Index(*shared.value, share=share)
            for x in frames:
                ids, texts = x["doc_id"].to_numpy(), x["text"].tolist()
                cut = np.cumsum([len(t) for t in texts]) // SCAN_CHARS
                for k in np.unique(cut):
                    part = np.flatnonzero(cut == k)
                    got = index.find([texts[i] for i in part])
                    yield pd.DataFrame({"doc_id": [ids[part[d]] for d, _, _ in got], "item_id": [index.ids[i] for _, i, _ in got], "found_share": [s for _, _, s in got]})

        return own.mapInPandas(find, "doc_id bigint, item_id bigint, found_share double")

    return reduce(DataFrame.unionByName, (scan(b) for b in range(blocks)))
