"""Several values packed in one cell: split into one value per row with its position kept.

Method: the Arrow string buffers of a batch are scanned as bytes. A running count of quote bytes gives the quote parity at
each byte; delimiter masks outside quotes, checked against the shape of the field's values, give the child offsets; from
these a list array is built and flattened with its parents' ordinals. No value is touched one by one, but for the few that
hold an escape sign.

Defined results: a null, blank or empty cell gives no rows; an empty slot gives a row with empty text (it keeps its
position); a quote that is never closed is an ordinary character; a JSON array is split at its commas and its escapes are
read. Rows of the input may be repeated; each gives its own rows. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How the values of a field look: file names end in an extension, links begin with a scheme, plain values hold no delimiter.
SHAPES = ("plain", "file", "link")

#: Fixed values.
DELIMITERS = (";", ",", "|", "\t", "\n", "；", "，", "、", "<br>", "<br/>", "<br />", "<BR>", "<BR/>")
_BLANKS = tuple(x.encode() for x in (" ", "\t", "\r", "\n", "　", " ", "​", "﻿"))
SCHEMA = "row_id bigint, field_name string, pos_no int, item_text string, n_values int"


def _match(data: np.ndarray, at: np.ndarray, what: bytes) -> np.ndarray:
    """Whether the bytes from each position are ``what``; positions beyond the end don't match."""
    ok = (at >= 0) & (at + len(what) <= len(data))
    for k, b in enumerate(what):
        ok &= data[np.clip(at + k, 0, max(len(data) - 1, 0))] == b
    return ok


def _trim(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Move both ends of each span past white space."""
    starts, ends = starts.copy(), ends.copy()
    for left in (True, False):
        open_ = np.flatnonzero(starts < ends)
        while len(open_):
            moved = np.zeros(len(open_), bool)
            for w in _BLANKS:
                at = starts[open_] if left else ends[open_] - len(w)
                hit = ~moved & (ends[open_] - starts[open_] >= len(w)) & _match(data, at, w)
                if left:
                    starts[open_[hit]] += len(w)
                else:
                    ends[open_[hit]] -= len(w)
                moved |= hit
            open_ = open_[moved]
            open_ = open_[starts[open_] < ends[open_]]
    return starts, ends


def _gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The strings of byte spans."""
    size = ends - starts
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    index = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[index])))


def _skip_space(data: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, step: int) -> np.ndarray:
    """Past ASCII blanks from each position on, within its row."""
    at = at.copy()
    while True:
        inside = (at >= low) & (at < high)
        hit = inside & np.isin(data[np.clip(at, 0, max(len(data) - 1, 0))], (32, 9, 13))
        if not hit.any():
            return at
        at[hit] += step


def split_cells(cells: pa.Array, shape: str) -> pa.Array:
    """A list of the values of each non-null cell."""
    cells = pc.fill_null(cells, "").cast(pa.large_string())
    n = len(cells)
    offsets = np.frombuffer(cells.buffers()[1], np.int64)[cells.offset : cells.offset + n + 1]
    data = np.frombuffer(cells.buffers()[2], np.uint8) if cells.buffers()[2] is not None and offsets[-1] else np.zeros(1, np.uint8)
    low, high = _trim(data, offsets[:-1], offsets[1:])
    is_json = (high - low >= 2) & (data[np.clip(low, 0, len(data) - 1)] == 91) & (data[np.clip(high - 1, 0, len(data) - 1)] == 93)
    low, high = low + is_json, high - is_json

    quote = np.flatnonzero(data == 34)
    row = np.searchsorted(offsets, quote, side="right") - 1
    known = (row >= 0) & (row < n)
    quote, row = quote[known], row[known]
    if is_json.any() and len(quote):  # an escaped quote of a JSON array opens and closes nothing
        run, at = np.zeros(len(quote), np.int64), quote - 1
        back = is_json[row] & (data[np.clip(at, 0, None)] == 92)
        while back.any():
            run[back] += 1
            at = at - 1
            back &= (at >= 0) & (data[np.clip(at, 0, None)] == 92)
        quote, row = quote[run % 2 == 0], row[run % 2 == 0]
    odd = np.bincount(row, minlength=n) % 2 == 1
    quote, row = quote[~odd[row]], row[~odd[row]]

    def inside(at: np.ndarray, of: np.ndarray) -> np.ndarray:
        return (np.searchsorted(quote, at) - np.searchsorted(quote, low[of])) % 2 == 1

    found, sizes = [], []
    for mark in DELIMITERS:
        b = mark.encode()
        at = np.flatnonzero(data == b[0])
        at = at[_match(data, at, b)] if len(b) > 1 else at
        found.append(at)
        sizes.append(np.full(len(at), len(b)))
    at, size = np.concatenate(found), np.concatenate(sizes)
    order = np.argsort(at, kind="stable")
    at, size = at[order], size[order]
    of = np.searchsorted(offsets, at, side="right") - 1
    keep = (of >= 0) & (of < n)
    at, size, of = at[keep], size[keep], of[keep]
    keep = (at >= low[of]) & (at + size <= high[of]) & ~inside(at, of) & (~is_json[of] | (data[at] == 44))
    at, size, of = at[keep], size[keep], of[keep]

    if shape != "plain" and len(at):
        before, after = _skip_space(data, at - 1, low[of], high[of], -1), _skip_space(data, at + size, low[of], high[of], 1)
        first, last = before < low[of], after >= high[of]
        near = np.clip(before, 0, len(data) - 1)
        starts_mark, ends_mark = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
        starts_mark[at], ends_mark[at + size - 1] = True, True
        empty = first | ends_mark[near] | starts_mark[np.clip(after, 0, len(data))] & ~last
        if shape == "link":
            begin = after + (data[np.clip(after, 0, len(data) - 1)] == 34)
            word = _match(data, after, b'""')
            for scheme in (b"http", b"HTTP", b"ftp", b"//"):
                word |= _match(data, begin, scheme)
            good = is_json[of] | last | word | empty & (starts_mark[np.clip(after, 0, len(data))] | first)
        else:
            good = is_json[of] | empty | (data[near] == 34)
            for k in range(1, 6):  # an extension of one to five letters or digits, the first a letter
                letters = before - k >= low[of]
                for j in range(k):
                    c = data[np.clip(before - j, 0, len(data) - 1)]
                    letters &= (c >= 97) & (c <= 122) | (c >= 65) & (c <= 90) | ((c >= 48) & (c <= 57) if j < k - 1 else False)
                good |= letters & (data[np.clip(before - k, 0, len(data) - 1)] == 46)
            none = np.bincount(of, good & ~empty, minlength=n) == 0  # no value of the cell has an extension
            dots = np.zeros(n, bool)
            dots[np.clip(np.searchsorted(offsets, np.flatnonzero(data == 46), side="right") - 1, 0, max(n - 1, 0))] = True
            good |= none[of] & ~dots[of]
        at, size, of = at[good], size[good], of[good]

    count = np.bincount(of, minlength=n) + 1
    count[low >= high] = 0
    keep = count[of] > 0
    at, size, of = at[keep], size[keep], of[keep]
    lists = np.zeros(n + 1, np.int64)
    np.cumsum(count, out=lists[1:])
    starts, ends = np.zeros(lists[-1], np.int64), np.zeros(lists[-1], np.int64)
    full = count > 0
    starts[lists[:-1][full]], ends[lists[1:][full] - 1] = low[full], high[full]
    slot = np.arange(len(at)) + np.cumsum(full)[of] - 1 if len(at) else np.zeros(0, np.int64)
    ends[slot], starts[slot + 1] = at, at + size

    starts, ends = _trim(data, starts, np.maximum(starts, ends))
    quoted = (ends - starts >= 2) & (data[np.clip(starts, 0, len(data) - 1)] == 34) & (data[np.clip(ends - 1, 0, len(data) - 1)] == 34)
    parent = np.repeat(np.arange(n), count)
    items = _gather(data, starts + quoted, ends - quoted)
    if quoted.any():
        items = pc.if_else(pa.array(quoted & ~is_json[parent]), pc.replace_substring(items, '""', '"'), items)
    escaped = is_json[parent] & quoted & pc.match_substring(items, "\\").to_numpy(zero_copy_only=False)
    if escaped.any():
        values = items.to_pylist()
        for k in np.flatnonzero(escaped):
            try:
                values[k] = json.loads(f'"{values[k]}"')
            except ValueError:
                pass
        items = pa.array(values, pa.large_string())
    items = pc.utf8_trim_whitespace(items)
    return pa.LargeListArray.from_arrays(pa.array(lists), items)


def split_packed(df: DataFrame, fields: dict[str, str], id_col: str = "row_id") -> DataFrame:
    """Each value of the packed fields on a row of its own.

    fields: column name to shape (see SHAPES). Gives row_id, field_name, pos_no (from 1), item_text and n_values, the
    number of values of the cell that aren't empty. One pass over the input, without a shuffle.
    """
    if bad := set(fields.values()) - set(SHAPES):
        raise ValueError(f"unknown shapes: {sorted(bad)}")
    cells = df.select(
        F.col(f"`{id_col}`").cast("bigint").alias("_id"),
        F.explode(F.array(*(F.struct(F.lit(k).alias("f"), F.lit(s).alias("s"), F.col(f"`{k}`").cast("string").alias("v")) for k, s in fields.items()))).alias("_x"),
    ).select("_id", F.col("_x.f").alias("_f"), F.col("_x.s").alias("_s"), F.col("_x.v").alias("_v"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shape in SHAPES:
                part = pa.Table.from_batches([batch])
                part = part.filter(pc.and_(pc.equal(part["_s"], shape), pc.is_valid(part["_v"]))).combine_chunks()
                if not part.num_rows:
                    continue
                lists = split_cells(part["_v"].chunk(0), shape)
                parent = pc.list_parent_indices(lists).to_numpy()
                items = lists.flatten()
                filled = pc.greater(pc.binary_length(items), 0).to_numpy(zero_copy_only=False)
                pos = np.arange(len(parent)) - lists.offsets.to_numpy()[parent] + 1
                yield pa.RecordBatch.from_arrays(
                    [part["_id"].chunk(0).take(pa.array(parent)), part["_f"].chunk(0).take(pa.array(parent)), pa.array(pos, pa.int32()), items.cast(pa.string()), pa.array(np.bincount(parent, filled, minlength=len(lists))[parent].astype(np.int32))],
                    names=["row_id", "field_name", "pos_no", "item_text", "n_values"],
                )

    return cells.where("_v is not null").mapInArrow(split, SCHEMA)
