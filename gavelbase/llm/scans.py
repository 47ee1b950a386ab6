"""Noise in text from scanned pages: running heads and feet, page numbers, broken words, misread characters.

Method: the lines of a text are labelled by a hidden Markov model with the states body, header, page number and blank. A line
is observed by its layout: the form of a page number, a return in the text (up to two misread characters), a place at a
page's edge, an end or a width like running text, and whether many texts have the same line. The model starts from a rough guess
and is fitted on the line sequences of all texts (Viterbi training; sequences are counted first, so equal ones are fitted
once). Paragraphs are put together from the body lines; a hyphen at a line's end within a word is taken out.

Misread characters are found in the running text by their contexts: a character is misread where its neighbours call for
another one almost everywhere in the corpus, and the two are confused in several different contexts. All texts are counted. A
character may come apart in two: two characters that nearly always stand together are read as one sign, whose contexts tell
whether they should be one.

Scale: texts are taken through in batches, all lines' states and all characters' contexts of a batch at once. Contexts are
first counted in a table of hashed counters, of bounded size, which leaves out those that can't reach ``LEAST`` uses; the rest
are counted exactly, within tasks before they are shuffled, and joined by hash. Only the pairs of confused characters, the
signs (no more than half the code points), the counters' bits and the frequent lines are sent to all tasks.

Defined results: a null or empty text gives no rows; a text of one line is body; very long texts take time linear in their
length; repeated rows each give their rows; ids need not be unique across the given fields.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelbase.session import checkpoint

BODY, HEADER, PAGE, BLANK = range(4)
KINDS = ("body", "header", "page_no", "blank")
#: A line is frequent if this share of the texts, and at least three, have it.
FREQUENT = 0.0005
#: A context calls for a character that holds TOP of its uses, if it is used LEAST times; another of at most RARE of them is doubted.
TOP, RARE, LEAST = 0.8, 0.15, 20
#: Two characters are confused if the contexts where one is doubted hold this share of the uses of all that call for the other; the
#: lower share is enough for a character that itself is called for in less than OWN of its uses.
COVER, COVER_RARE, OWN = 0.45, 0.1, 0.1
MAX_PAIRS = 50_000
#: Characters counted together in a task, and counts held before they are passed on.
CHARS, HELD = 400_000, 2_000_000
#: Hashed counters: two to a power within these, by the corpus' size.
COUNTERS = (16, 24)
#: Two characters are one sign where their joint uses hold this share of the uses of each; signs are numbered from a private plane.
JOINT, SIGN = 0.8, 0xF0000
#: Fixed values.
HYPHENS = "-‐‑­－–"
_HYPHENS = set(HYPHENS)
_DIGIT = "0-9OoIlSBZ"
_HAN = "一二三四五六七八九十百零〇"
_MARK = r"[-—–·~～=]{1,3}"
_PAGE = re.compile(rf"^(?:第\s*[{_DIGIT}{_HAN}]{{1,4}}\s*页(?:\s*[,，/]?\s*共\s*[{_DIGIT}{_HAN}]{{1,4}}\s*页)?|[Pp]age\s+[{_DIGIT}]{{1,4}}(?:\s+of\s+[{_DIGIT}]{{1,4}})?|[Pp]\s?\.\s?[{_DIGIT}]{{1,4}}|[{_DIGIT}]{{1,4}}\s*/\s*[{_DIGIT}]{{1,4}}|[〔\[(（【]\s*[{_DIGIT}]{{1,4}}\s*[〕\])）】]|{_MARK}\s*[{_DIGIT}]{{1,4}}\s*{_MARK}|[{_DIGIT}]{{1,4}})$")
_END = re.compile(r"[。；：，、？！;:,?!]\s*$")
_BROKEN = re.compile(rf"[A-Za-z][{HYPHENS}]\s*$")
_LIKE_DIGIT = re.compile(r"(?<=\d)[OoIlSBZ]|[OoIlSBZ](?=\d)|\d")
SYMBOLS = 19
SCHEMA = "row_id bigint, field_name string, text string"


_ANY_DIGIT = re.compile(r"\d")
_MARKS = re.compile("[，。；]")


def line_key(line: str) -> str:
    s = "".join(line.split())
    return _LIKE_DIGIT.sub("9", s) if _ANY_DIGIT.search(s) else s


def key_hash(key: str) -> int:
    h = xxhash.xxh64_intdigest(key)
    return h - (1 << 64) if h >> 63 else h


def _width(line: str) -> int:
    return len(line) + sum(map("⺀".__le__, line))


def returning(keys: list[str]) -> list[bool]:
    """Whether a line comes again in the text, up to two characters in lines of six and more. Near lines share a third; all different ones that share it are compared."""
    count = Counter(keys)
    again = {k for k, n in count.items() if n > 1 and k}
    shared: dict[tuple, list[str]] = {}
    for k in count:
        n = len(k)
        if n >= 6:
            for part, (a, b) in enumerate(((0, n // 3), (n // 3, 2 * n // 3), (2 * n // 3, n))):
                shared.setdefault((n, part, k[a:b]), []).append(k)
    for same in shared.values():
        if len(same) > 1:
            signs = np.array([[ord(c) for c in k] for k in same], np.int32)
            for i, k in enumerate(same[:-1]):
                near = np.flatnonzero((signs[i + 1 :] != signs[i]).sum(axis=1) <= 2)
                if len(near):
                    again.update((k, *(same[i + 1 + j] for j in near.tolist())))
    return [k in again for k in keys]


def symbols(lines: list[str], frequent: set[int]) -> list[int]:
    """The observation of each line."""
    stripped = [x.strip() for x in lines]
    page = [len(s) <= 40 and bool(_PAGE.match(s)) for s in stripped]  # no form of a page number is longer
    keys = ["" if p else line_key(s) for p, s in zip(page, stripped)]
    again = returning(keys)
    widths = Counter(_width(x.rstrip()) for x, s, p, r in zip(lines, stripped, page, again) if s and not p and not r)
    usual = widths.most_common(1)[0][0] if widths else 0
    filled = [i for i, s in enumerate(stripped) if s]
    edge = set()
    for k, i in enumerate(filled):
        for j in (k - 1, k + 1):
            if not 0 <= j < len(filled) or page[filled[j]] or again[filled[j]]:
                edge.add(i)
    out = []
    for i, s in enumerate(stripped):
        if not s:
            out.append(0)
        elif page[i]:
            out.append(1 + (i in edge))
        else:
            like_body = bool(_MARKS.search(s)) or lines[i].startswith("\u3000\u3000") or bool(_END.search(s)) or bool(_BROKEN.search(lines[i])) or abs(_width(lines[i].rstrip()) - usual) <= 2 or len(s) > 60
            out.append(3 + again[i] * 8 + (i in edge) * 4 + like_body * 2 + (key_hash(keys[i]) in frequent))
    return out


def first_guess() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, step and observation weights before training (logarithms)."""
    emit = np.full((4, SYMBOLS), 1e-4)
    emit[BLANK, 0] = 1
    emit[PAGE, 1], emit[PAGE, 2] = 0.2, 0.8
    emit[BODY, 1], emit[BODY, 2] = 0.002, 0.0005
    for again in (0, 1):
        for edge in (0, 1):
            for like in (0, 1):
                for often in (0, 1):
                    s = 3 + again * 8 + edge * 4 + like * 2 + often
                    emit[HEADER, s] = (0.9 if again else 0.1) * (0.8 if edge else 0.2) * (0.15 if like else 0.85) * (0.7 if often else 0.3)
                    emit[BODY, s] = (0.01 if again else 0.99) * (0.2 if edge else 0.8) * (0.93 if like else 0.07) * (0.2 if often else 0.8)
    step = np.array([[0.75, 0.1, 0.05, 0.1], [0.5, 0.15, 0.25, 0.1], [0.45, 0.35, 0.01, 0.19], [0.6, 0.2, 0.15, 0.05]])
    start = np.array([0.5, 0.25, 0.2, 0.05])
    return np.log(start), np.log(step), np.log(emit / emit.sum(axis=1, keepdims=True))


#: Cells of sequences decoded together.
DECODED = 2_000_000


def decode_all(sequences: list, model: tuple) -> list[np.ndarray]:
    """The likeliest states of each sequence: all sequences of about one length take each step together."""
    start, step, emit = (np.asarray(x) for x in model)
    size = np.array([len(x) for x in sequences], np.int64)
    out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(sequences)
    order = np.argsort(-size, kind="stable")
    order = order[: int((size > 0).sum())]
    at = 0
    while at < len(order):
        longest = int(size[order[at]])
        own = order[at : at + max(1, DECODED // longest)]
        at += len(own)
        n = size[own]
        seen = np.zeros((len(own), longest), np.int64)
        inside = np.arange(longest) < n[:, None]
        seen[inside] = np.concatenate([np.asarray(sequences[k], np.int64) for k in own])
        score = start + emit[:, seen[:, 0]].T
        back = np.zeros((longest, len(own), 4), np.int8)
        for t in range(1, longest):
            go = int(np.searchsorted(-n, -t, side="left"))  # the sequences that are longer, which come first
            by = score[:go, :, None] + step
            back[t, :go] = by.argmax(axis=1)
            score[:go] = by.max(axis=1) + emit[:, seen[:go, t]].T
        path = np.zeros((len(own), longest), np.int32)
        state = score.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            go = int(np.searchsorted(-n, -t, side="left"))
            path[:go, t] = state[:go]
            if t:
                state[:go] = back[t, np.arange(go), state[:go]]
        for k, p, m in zip(own.tolist(), path, n.tolist()):
            out[k] = p[:m]
    return out


def decode(observed: list[int], model: tuple) -> list[int]:
    """The likeliest states."""
    return decode_all([observed], model)[0].tolist()


def fit(sequences: DataFrame, rounds: int = 2) -> tuple:
    """The model fitted on counted sequences: seq array<int>, n."""
    model = first_guess()
    for _ in range(rounds):

        def tally(frames: Iterator[pd.DataFrame], model=model) -> Iterator[pd.DataFrame]:
            start, step, emit = np.zeros(4, np.int64), np.zeros(16, np.int64), np.zeros(4 * SYMBOLS, np.int64)
            for x in frames:
                keep = [k for k, q in enumerate(x["seq"]) if len(q)]
                if not keep:
                    continue
                seqs, times = [x["seq"].iloc[k] for k in keep], x["n"].to_numpy(np.int64)[keep]
                paths = decode_all(seqs, model)
                size = np.array([len(p) for p in paths])
                state, seen, n = np.concatenate(paths).astype(np.int64), np.concatenate(seqs).astype(np.int64), np.repeat(times, size)
                ends = np.cumsum(size) - 1
                inner = np.ones(len(state), bool)
                inner[ends] = False
                inner = np.flatnonzero(inner)
                start += np.bincount(state[ends - size + 1], times, 4).astype(np.int64)
                step += np.bincount(state[inner] * 4 + state[inner + 1], n[inner], 16).astype(np.int64)
                emit += np.bincount(state * SYMBOLS + seen, n, 4 * SYMBOLS).astype(np.int64)
            rows = [("start", k, 0, v) for k, v in enumerate(start)] + [("step", k // 4, k % 4, v) for k, v in enumerate(step)] + [("emit", k // SYMBOLS, k % SYMBOLS, v) for k, v in enumerate(emit)]
            yield pd.DataFrame([r for r in rows if r[3]], columns=["what", "a", "b", "n"])

        rows = sequences.mapInPandas(tally, "what string, a int, b int, n bigint").groupBy("what", "a", "b").agg(F.sum("n").alias("n")).collect()  # at most 4 + 16 + 76 rows
        guess = [np.exp(x) * 20 for x in first_guess()]  # the guess counts as so many lines, so that small corpora stay near it
        start, step, emit = (g.copy() for g in guess)
        for r in rows:
            if r["what"] == "start":
                start[r["a"]] += r["n"]
            else:
                (step if r["what"] == "step" else emit)[r["a"], r["b"]] += r["n"]
        model = (np.log(start / start.sum()), np.log(step / step.sum(axis=1, keepdims=True)), np.log(emit / emit.sum(axis=1, keepdims=True)))
    return model


def next_body(i: int, path: list[int]) -> int:
    j = i + 1
    while j < len(path) and path[j] != BODY:
        j += 1
    return j


def broken(lines: list[str], path: list[int], i: int) -> bool:
    """Whether a body line ends within a word that the next line of text goes on with."""
    if path[i] != BODY or lines[i].rstrip()[-1:] not in _HYPHENS or not _BROKEN.search(lines[i]):
        return False
    j = next_body(i, path)
    return j < len(path) and bool(re.match(r"\s*[a-z]", lines[j]))


class Signs:
    """Pairs of characters that are also read as one sign each, numbered from ``SIGN``."""

    def __init__(self, pairs: list[tuple[int, int]]):
        self.keys = np.array(sorted(a << 21 | b for a, b in pairs), np.int64)
        self.first = np.zeros(0x110000, bool)
        self.first[self.keys >> 21] = True

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a sign begins, and its number."""
        at = np.flatnonzero(self.first[codes[:-1]]) if len(codes) and len(self.keys) else np.zeros(0, np.int64)
        key = codes[at].astype(np.int64) << 21 | codes[at + 1].astype(np.int64)
        k = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        good = np.flatnonzero(self.keys[k] == key) if len(at) else k
        return at[good], k[good] + SIGN


def running_text(lines: list[str], path: list[int], placed: bool = True) -> tuple[str, list[int], list[int]]:
    """The body's characters without white space and broken words' hyphens, with the line (from 1) and the place in it of each if ``placed``."""
    chars, line_no, place = [], [], []
    for i, (x, s) in enumerate(zip(lines, path)):
        if s != BODY:
            continue
        end = len(x.rstrip())
        if broken(lines, path, i):
            end -= 1
        k = len(x) - len(x.lstrip())
        part = x[k:end]
        words = part.split()
        chars += words
        if placed:
            at = range(k, end) if len(words) == 1 else [k + j for j, c in enumerate(part) if not c.isspace()]
            line_no += [i + 1] * len(at)
            place += at
    return "".join(chars), line_no, place


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _classes(text: str) -> np.ndarray:
    """Code points; digits are one class."""
    c = _codes(text).astype(np.uint64)
    return np.where((c >= 48) & (c <= 57), np.uint64(48), c)


#: Places of the neighbours that make a context; the first two have neighbours on both sides, the last tells dates from counts.
CONTEXTS = ((-2, -1, 1), (-1, 1, 2), (-3, -2, -1), (1, 2, 3), (-6, -5, -4, -3, -2, -1))
#: The contexts of signs: those of one side are their first or last character's as well.
BOTH_SIDES = 2


#: Where all neighbours lie beyond the text's ends.
NO_CONTEXT = -1
#: A context's hash, its kind (3 bits) and a code point (21) make one number.
CONTEXT_BITS = 40


#: Class of what lies between texts, as far as a context reaches.
BETWEEN = "\0" * 6


def together(texts: list[str]) -> str:
    """Texts in one line, parted so that no context reaches from one to another."""
    return BETWEEN + BETWEEN.join(texts) + BETWEEN


def contexts(c: np.ndarray, at: np.ndarray, size: int = 1) -> np.ndarray:
    """Hashes of the contexts (one row per kind) of what stands at the places and is ``size`` characters long. c: classes of texts put together; the texts' ends are a class of their own."""
    out = []
    for kind, places in enumerate(CONTEXTS if size == 1 else CONTEXTS[:BOTH_SIDES]):
        h = np.full(len(at), kind + 1, np.uint64)
        some = np.zeros(len(at), bool)
        for p in places:
            near = c[at + (p if p < 0 else p + size - 1)]
            some |= near != 0
            h = (h ^ near) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
        out.append(np.where(some, ((h >> np.uint64(64 - CONTEXT_BITS)) << np.uint64(3) | np.uint64(kind)).view(np.int64), NO_CONTEXT))
    return np.array(out).reshape(len(out), -1)


def units(text: str, signs: Signs) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Class, place, and classes of the whole with the size: first all characters, then all signs of texts put together."""
    codes = _codes(text)
    c = _classes(text)
    at = np.flatnonzero(c)
    yield c[at].astype(np.int64), at, c, 1
    at, number = signs.find(codes)
    yield number, at, c, 2


def labelled(df: DataFrame) -> DataFrame:
    """row_id, field_name, text and the state of each line. df: row_id, field_name, text."""
    spark = df.sparkSession
    own = df.where("text is not null and text <> ''")
    n = own.count()

    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in frames:
            total: Counter = Counter()
            for t in x["text"]:
                lines = [s for s in (y.strip() for y in t.split("\n")) if s]
                if len(lines) > 2:
                    total.update({key_hash(k) for k in (line_key(s) for s in lines if not _END.search(s)) if k})
                if len(total) > HELD:
                    yield pd.DataFrame(list(total.items()), columns=["key", "n"])
                    total = Counter()
            yield pd.DataFrame(list(total.items()), columns=["key", "n"])

    least = max(3, int(FREQUENT * n))
    often = own.select("text").mapInPandas(keys, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key").collect()  # at most lines per text / FREQUENT
    frequent = spark.sparkContext.broadcast({r["key"] for r in often})

    def observe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in frames:
            yield x.assign(seq=[symbols(t.split("\n"), frequent.value) for t in x["text"]])

    observed = checkpoint(own.select("row_id", "field_name", "text").mapInPandas(observe, SCHEMA + ", seq array<int>"))
    model = fit(observed.groupBy("seq").agg(F.count("*").alias("n")))

    @F.pandas_udf("array<int>")
    def states(seq: pd.Series) -> pd.Series:
        # a single line is running text, whatever texts begin with
        return pd.Series([p if np.count_nonzero(s) > 1 else np.where(np.asarray(s) == 0, BLANK, BODY).astype(np.int32) for s, p in zip(seq, decode_all(list(seq), model))])

    return observed.select("row_id", "field_name", "text", states("seq").alias("path"))


def tallied(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value once, and how often it occurs."""
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.diff(np.append(first, len(values)))


def signs_of(lines: DataFrame) -> Signs:
    """Pairs of characters that hardly occur but together. Each character has one such partner on each side at most, so they number no more than half the code points."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in frames:
            c = _codes("\n".join(x["text"]))
            n = np.bincount(c)
            own = np.flatnonzero(n)
            rank = np.zeros(len(n), np.uint32)
            rank[own] = np.arange(len(own))
            own_han = own[own >= 0x2E80]
            yield pd.DataFrame({"a": own_han, "b": -1, "n": n[own_han]})
            part = np.flatnonzero((c[:-1] >= 0x2E80) & (c[1:] >= 0x2E80))
            pair = rank[c[part]].astype(np.uint64) * np.uint64(len(own)) + rank[c[part + 1]]
            pair, n = tallied(pair)
            a, b = np.divmod(pair, np.uint64(max(len(own), 1)))
            yield pd.DataFrame({"a": own[a.astype(np.int64)], "b": own[b.astype(np.int64)], "n": n})

    n = lines.select("text").mapInPandas(count, "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))
    n = checkpoint(n)
    one, two = n.where("b < 0"), n.where("b >= 0 and a <> b")
    both = two.join(one.selectExpr("a", "n as na"), "a").join(one.selectExpr("a as b", "n as nb"), "b")
    got = both.where((F.col("n") >= LEAST) & (F.col("n") >= JOINT * F.greatest("na", "nb"))).select("a", "b").collect()
    return Signs([(r["a"], r["b"]) for r in got if chr(r["a"]).isalnum() and chr(r["b"]).isalnum()])


def misread(lines: DataFrame) -> DataFrame:
    """row_id, field_name, line_no, place, the right character of each misread one and how many characters stand for it. lines: see :func:`labelled`."""
    spark = lines.sparkSession
    base = len(CONTEXTS)
    signs = spark.sparkContext.broadcast(signs_of(lines))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in frames:
            yield pd.DataFrame({"run": [running_text(t.split("\n"), list(p), placed=False)[0] for t, p in zip(x["text"], x["path"])]})

    runs = checkpoint(lines.select("text", "path").mapInPandas(run, "run string").where("run <> ''"))
    chars = runs.agg(F.sum(F.length("run"))).first()[0] or 0
    power = int(np.clip(np.ceil(np.log2(max(base * chars / 16, 1))), *COUNTERS))

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[str]:
        waiting, size = [], 0
        for x in frames:
            for t in x["run"]:
                waiting.append(t)
                size += len(t)
                if size >= CHARS:
                    yield together(waiting)
                    waiting, size = [], 0
        if waiting:
            yield together(waiting)

    counter = lambda ctx: ((ctx.view(np.uint64) >> np.uint64(3)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - power)).astype(np.int64)
    block = min(1 << power, 1 << 16)

    def first_count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros(1 << power, np.int32)
        for text in batches(frames):
            got = np.concatenate([contexts(c, at, size).ravel() for _, at, c, size in units(text, signs.value)])
            k, n = tallied(counter(got[got != NO_CONTEXT]))
            table[k] += n.astype(np.int32)
        cells = np.minimum(table, LEAST).astype(np.uint8).reshape(-1, block)
        some = np.flatnonzero(cells.any(axis=1))
        yield pd.DataFrame({"k": some, "cells": [cells[k].tobytes() for k in some]})

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for x in frames:
            for k, cells in zip(x["k"], x["cells"]):
                total[k] = np.minimum(total.get(k, 0) + np.frombuffer(cells, np.uint8).astype(np.uint16), LEAST)
        yield pd.DataFrame({"k": list(total), "cells": [np.packbits(v >= LEAST).tobytes() for v in total.values()]})

    def bits_of(blocks: DataFrame):
        """A bit for each counter that reaches ``LEAST``, sent to all tasks; tasks' counters are added up by blocks."""
        bits = np.zeros(1 << power, bool)
        for r in blocks.repartition("k").mapInPandas(add, "k bigint, cells binary").collect():
            bits[r["k"] * block : (r["k"] + 1) * block] = np.unpackbits(np.frombuffer(r["cells"], np.uint8)).astype(bool)
        return spark.sparkContext.broadcast(np.packbits(bits))

    # contexts used less often can neither call for a character nor be doubted
    reach = bits_of(runs.mapInPandas(first_count, "k bigint, cells binary"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.unpackbits(reach.value).astype(bool)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def drain() -> pd.DataFrame:
            key = np.concatenate([k for k, _ in held])
            order = np.argsort(key, kind="stable")  # runs that are in order already
            key, n = key[order], np.concatenate([n for _, n in held])[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            total = np.add.reduceat(n, first)
            return pd.DataFrame({"ctx": (key[first] >> np.uint64(21)).astype(np.int64), "ch": (key[first] & np.uint64(0x1FFFFF)).astype(np.int64), "n": total})

        for text in batches(frames):
            for ch, at, c, length in units(text, signs.value):
                for ctx in contexts(c, at, length):
                    keep = np.flatnonzero((ctx != NO_CONTEXT) & bits[counter(ctx)])
                    if len(keep):
                        held.append(tallied(ctx[keep].view(np.uint64) << np.uint64(21) | ch[keep].view(np.uint64)))
                        size += len(held[-1][0])
            if size >= HELD:
                yield drain()
                held, size = [], 0
        if held:
            yield drain()

    counts = checkpoint(runs.mapInPandas(count, "ctx bigint, ch bigint, n bigint").groupBy("ctx", "ch").agg(F.sum("n").alias("n")))
    calls = counts.groupBy("ctx").agg(F.sum("n").alias("all"), F.max("n").alias("most"), F.max_by("ch", "n").alias("right")).where((F.col("all") >= LEAST) & (F.col("most") >= 0.5 * F.col("all")))
    sure = F.col("most") >= TOP * F.col("all")
    judged = counts.join(calls, "ctx")
    doubted = checkpoint(judged.where(sure & (F.col("ch") != F.col("right")) & (F.col("n") <= RARE * F.col("all"))).select("ctx", "ch", "right", "n", "all"))
    # of each character: its uses, those in contexts that call for it, and the weight of all contexts that surely do

    def characters(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for text in batches(frames):
            ch, n = np.unique(np.concatenate([ch for ch, *_ in units(text, signs.value)]), return_counts=True)
            yield pd.DataFrame({"ch": ch, "n": n})

    uses = runs.mapInPandas(characters, "ch bigint, n bigint").groupBy("ch").agg(F.sum("n").alias("uses"))
    called = judged.where("ch = right").groupBy("ch").agg((F.sum("n") / base).alias("own"), F.sum(F.when(sure, F.col("all"))).alias("mass"), F.sum(F.when(sure & (F.pmod("ctx", F.lit(8)) < BOTH_SIDES), F.col("all"))).alias("both"))
    pairs = doubted.groupBy("ch", "right").agg(F.sum("all").alias("cover"))
    pairs = pairs.join(uses, "ch").join(called.select("ch", "own"), "ch", "left").join(called.select(F.col("ch").alias("right"), "mass", "both"), "right")
    own, cover = F.coalesce("own", F.lit(0.0)) / F.col("uses"), F.col("cover") / F.when(F.col("ch") >= SIGN, F.col("both")).otherwise(F.col("mass"))
    pairs = pairs.where((cover >= COVER) | (own <= OWN) & (cover >= COVER_RARE)).select("ch", "right", (own > OWN).alias("common"))
    known = [r for r in pairs.limit(MAX_PAIRS + 1).collect()]
    if len(known) > MAX_PAIRS:
        raise ValueError(f"more than {MAX_PAIRS} pairs of confused characters")
    known = [r for r in known if (chr(r["ch"]).isalnum() or r["ch"] >= SIGN) and chr(r["right"]).isalnum()]
    wrong = spark.sparkContext.broadcast(np.unique(np.array([r["ch"] for r in known], np.int64)))
    small = F.broadcast(spark.createDataFrame([tuple(r) for r in known], "ch bigint, right bigint, common boolean"))
    rules = doubted.select("ctx", "ch", "right").join(small, ["ch", "right"]).select("ctx", "ch", "right")
    marked = lambda ctx, ch: counter((ctx.view(np.uint64) ^ ch.view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64) & np.int64(2**63 - 1))

    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = np.zeros(1 << power, np.uint8)
        for x in frames:
            cells[marked(x["ctx"].to_numpy(np.int64), x["ch"].to_numpy(np.int64))] = LEAST
        cells = cells.reshape(-1, block)
        some = np.flatnonzero(cells.any(axis=1))
        yield pd.DataFrame({"k": some, "cells": [cells[k].tobytes() for k in some]})

    rules = checkpoint(rules)
    # a place whose contexts are all beside these bits meets no rule
    ruled = bits_of(rules.mapInPandas(mark, "k bigint, cells binary"))
    # a common character is in its place where a context calls for it
    vetoes = calls.select("ctx", F.col("right").alias("ch")).join(small.where("common").select("ch").distinct(), "ch").select("ctx", "ch", F.lit(None).cast("bigint").alias("right"))
    rules = rules.unionByName(vetoes)

    def places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.unpackbits(ruled.value).astype(bool)
        for x in frames:
            got = [running_text(t.split("\n"), list(p)) for t, p in zip(x["text"], x["path"])]
            text = together([g[0] for g in got])
            # where each text begins among all
            start = np.cumsum([len(BETWEEN), *(len(g[0]) + len(BETWEEN) for g in got)])[:-1]
            for ch, at, c, size in units(text, signs.value):
                some = np.isin(ch, wrong.value)
                ch, at = ch[some], at[some]
                h = contexts(c, at, size)
                some = np.zeros(len(at), bool)
                for k in h:
                    some |= bits[marked(k, ch)]
                ch, at, h = ch[some], at[some], h[:, some]
                if not len(at):
                    continue
                of = np.searchsorted(start, at, side="right") - 1
                within = [(got[k], j) for k, j in zip(of.tolist(), (at - start[of]).tolist())]
                line, place = [g[1][j] for g, j in within], [g[2][j] for g, j in within]
                out = pd.DataFrame({"row_id": x["row_id"].to_numpy()[of], "field_name": x["field_name"].to_numpy()[of], "line_no": line, "place": place, "ch": ch})
                one = np.array([size == 1 or g[1][j + 1] == g[1][j] and g[2][j + 1] == g[2][j] + 1 for g, j in within])  # a sign lies in one line
                yield pd.concat([out[one].assign(ctx=k[one]) for k in h])[["row_id", "field_name", "line_no", "place", "ctx", "ch"]]

    found = lines.mapInPandas(places, "row_id bigint, field_name string, line_no int, place int, ctx bigint, ch bigint")
    judged = found.join(rules, ["ctx", "ch"]).groupBy("row_id", "field_name", "line_no", "place").agg(F.min("right").alias("right"), F.max((F.col("ch") >= SIGN).cast("int")).alias("more"), F.sum(F.col("right").isNull().cast("int")).alias("in_place"))
    return judged.where("in_place = 0").select("row_id", "field_name", "line_no", "place", "right", (F.col("more") + 1).alias("size"))


def noise(lines: DataFrame, wrong: DataFrame) -> DataFrame:
    """row_id, field_name, line_no and noise_kind (header, page_no, hyphen, misread)."""

    def kinds(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in frames:
            out = []
            for r, f, t, p in zip(x["row_id"], x["field_name"], x["text"], x["path"]):
                path, own = list(p), t.split("\n")
                out += [(r, f, i + 1, KINDS[s]) for i, s in enumerate(path) if s in (HEADER, PAGE)]
                out += [(r, f, i + 1, "hyphen") for i in range(len(own)) if broken(own, path, i)]
            yield pd.DataFrame(out, columns=["row_id", "field_name", "line_no", "noise_kind"])

    layout = lines.mapInPandas(kinds, "row_id bigint, field_name string, line_no int, noise_kind string")
    return layout.unionByName(wrong.select("row_id", "field_name", "line_no", F.lit("misread").alias("noise_kind")).distinct())


def paragraphs(lines: DataFrame, wrong: DataFrame) -> DataFrame:
    """row_id, field_name, para_no and paragraph: the body put together, misread characters replaced (digits only where the digit is known by shape)."""
    shape = {"O": "0", "o": "0", "I": "1", "l": "1", "S": "5", "B": "8", "Z": "2"}
    fixes = wrong.groupBy("row_id", "field_name").agg(F.collect_list(F.struct("line_no", "place", "right", "size")).alias("fixes"))

    def put(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in frames:
            out = []
            for r, f, t, p, fix in zip(x["row_id"], x["field_name"], x["text"], x["path"], x["fixes"]):
                path, own = list(p), [list(y) for y in t.split("\n")]
                for k in fix if fix is not None else ():
                    c = own[k["line_no"] - 1][k["place"]]
                    own[k["line_no"] - 1][k["place"]] = shape.get(c, c) if k["right"] == 48 else chr(k["right"])
                    if k["size"] == 2:
                        own[k["line_no"] - 1][k["place"] + 1] = ""
                own = ["".join(y) for y in own]
                parts, blank, joined = [], True, False
                for i, (y, s) in enumerate(zip(own, path)):
                    if s == BLANK:
                        blank = not parts or bool(_END.search(parts[-1]))
                    if s != BODY:
                        continue
                    text = y.strip()
                    fresh = blank or y.startswith(("　", "    ")) and not joined or (parts and path[i - 1] == BODY and parts[-1].endswith("。") and _width(own[i - 1].rstrip()) < 0.7 * max(map(_width, own)))
                    cut = broken(own, path, i)
                    text = text[:-1] if cut else text
                    if fresh or not parts:
                        parts.append(text)
                    else:
                        space = " " if parts[-1][-1:].isascii() and parts[-1][-1:].isalnum() and text[:1].isascii() and text[:1].isalpha() and not joined else ""
                        parts[-1] += space + text
                    blank, joined = False, cut
                out += [(r, f, k + 1, y) for k, y in enumerate(parts) if y]
            yield pd.DataFrame(out, columns=["row_id", "field_name", "para_no", "paragraph"])

    return lines.join(fixes, ["row_id", "field_name"], "left").mapInPandas(put, "row_id bigint, field_name string, para_no int, paragraph string")


def texts(df: DataFrame, fields: list[str], id_col: str = "row_id") -> DataFrame:
    """row_id, field_name and text of the named columns."""
    one = lambda f: F.struct(F.lit(f).alias("f"), F.col(f"`{f}`").cast("string").alias("t"))
    cells: Column = F.explode(F.array(*(one(f) for f in fields)))
    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("row_id"), cells.alias("c")).select("row_id", F.col("c.f").alias("field_name"), F.col("c.t").alias("text"))
