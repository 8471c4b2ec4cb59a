"""Several values packed in one string: one row per value, with its position.

The bytes of a whole Arrow batch are scanned at once. Byte-class masks give the delimiter runs, run lengths the parity
of quotes, and a rule of the field's grammar tells which delimiter runs count. All rows then advance value by value in
step, looking up the next counting delimiter or closing quote, so that the number of NumPy calls is that of the longest
list, not of the rows. Child offsets make a list array, which is flattened with its parent ordinals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grammar:
    """What a value of a field looks like.

    ``prefixes``: a value begins with one of these words, else (empty) with any byte, or with letters and a colon if
    ``code``. ``number``: a value ends in a colon and a number ("int" or "real"); else any text ends it.
    ``blank``: blanks alone may separate.
    """

    prefixes: tuple[str, ...] = ()
    code: bool = False
    number: str = ""
    blank: bool = False


TAGS = Grammar(prefixes=("genre---", "instrument---", "mood---"), blank=True)
LANGS = Grammar(code=True, number="real")
EVENTS = Grammar(number="int")

SEPARATORS, WHITE, QUOTES = b" \t\n\r,;|", b" \t\n\r", b"\"'"
_OPEN, _CLOSE = b"["[0], b"]"[0]


def _mask(buf: np.ndarray, chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table[buf]


def _next(true: np.ndarray) -> np.ndarray:
    """For each place the first place from it on where ``true`` holds, else the length."""
    n = len(true)
    at = np.where(true, np.arange(n), n)
    return np.append(np.minimum.accumulate(at[::-1])[::-1], n)


def _last(true: np.ndarray) -> np.ndarray:
    """For each place the last place up to it where ``true`` holds, else -1."""
    return np.maximum.accumulate(np.where(true, np.arange(len(true)), -1))


def _starts_with(buf: np.ndarray, at: np.ndarray, word: bytes) -> np.ndarray:
    ok = np.ones(len(at), bool)
    for i, c in enumerate(word):
        ok &= buf[np.minimum(at + i, len(buf) - 1)] == c
    return ok


def _runs(true: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], true.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _begins(buf: np.ndarray, at: np.ndarray, g: Grammar) -> np.ndarray:
    """Whether a value, quoted or not, begins at each place."""
    at = np.where(_mask(buf[np.minimum(at, len(buf) - 1)], QUOTES), at + 1, at)
    at = np.minimum(at, len(buf) - 1)
    if g.prefixes:
        return np.logical_or.reduce([_starts_with(buf, at, p.encode()) for p in g.prefixes])
    if g.code:
        letter = _mask(buf, b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ-_")
        colon = _next(~letter)[at]
        inside = np.minimum(colon, len(buf) - 1)
        digit = _mask(buf, b"0123456789.")
        return (colon > at) & (buf[inside] == b":"[0]) & digit[np.minimum(inside + 1, len(buf) - 1)]
    return ~_mask(buf[at], SEPARATORS)


def _ends(buf: np.ndarray, at: np.ndarray, g: Grammar) -> np.ndarray:
    """Whether a value may end just before each place."""
    before = np.maximum(at - 1, 0)
    if g.number:
        digit = _mask(buf, b"0123456789." if g.number == "real" else b"0123456789")
        colon = _last(~digit)[before]
        c = np.maximum(colon, 0)
        named = (c > 0) & ~_mask(buf[np.maximum(c - 1, 0)], SEPARATORS)
        return digit[before] & (colon >= 0) & (buf[c] == b":"[0]) & named
    if g.prefixes:
        ok = np.zeros(len(at), bool)
        for p in g.prefixes:
            w = p.encode()
            first = np.flatnonzero(buf == w[0])
            there = np.zeros(len(buf), bool)
            there[first[_starts_with(buf, first, w)]] = True
            m = _last(there)[before]
            ok |= (m >= 0) & (m + len(w) <= before)
        return ok & ~_mask(buf[before], SEPARATORS)
    return ~_mask(buf[before], SEPARATORS)


def split_packed(strings: pa.Array, g: Grammar) -> pa.ListArray:
    """The values of each string, in order; null and blank strings give an empty list."""
    strings = strings.cast(pa.large_string()) if not pa.types.is_large_string(strings.type) else strings
    strings = pc.fill_null(strings, "")
    n = len(strings)
    if n == 0:
        return pa.ListArray.from_arrays(pa.array([0], pa.int32()), pa.array([], pa.string()))
    off = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + n + 1]
    data = strings.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    off = off - off[0]
    # a newline after each string keeps runs and look-ahead inside it
    size = np.diff(off)
    row_of = np.repeat(np.arange(n), size)
    buf = np.full(len(raw) + n + 1, b"\n"[0], np.uint8)
    buf[np.arange(len(raw)) + row_of] = raw
    lo = off[:-1] + np.arange(n)
    hi = lo + size

    sep, white = _mask(buf, SEPARATORS), _mask(buf, WHITE)
    word, last_word = _next(~sep), _last(~sep)

    def trim(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo = np.minimum(word[lo], hi)
        return lo, np.maximum(np.where(hi > 0, last_word[np.maximum(hi - 1, 0)] + 1, 0), lo)

    lo, hi = trim(lo, hi)
    boxed = (hi - lo >= 2) & (buf[lo] == _OPEN) & (buf[np.maximum(hi - 1, 0)] == _CLOSE)
    lo, hi = trim(lo + boxed, hi - boxed)

    # runs of delimiters that count where no quote is open
    a, b = _runs(sep)
    solid = np.zeros(len(a), bool)
    if len(a):
        hard = np.concatenate(([0], np.cumsum(sep & ~white)))
        solid = (hard[b] - hard[a]) > 0
        breaks = np.concatenate(([0], np.cumsum(_mask(buf, b"\t\n\r"))))
        solid |= (breaks[b] - breaks[a]) > 0
        if g.blank:
            solid[:] = True
        solid &= _begins(buf, b, g) & _ends(buf, a, g)
    counts = np.append(a[solid], len(buf))

    quote: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for q in QUOTES:
        s, e = _runs(buf == q)
        quote[q] = (s, e, np.append(e[(e - s) % 2 == 1] - 1, len(buf)))

    rows, starts, stops, marks = [], [], [], []
    active = np.flatnonzero(lo < hi)
    cur = lo.copy()
    while len(active):
        c, end = cur[active], hi[active]
        head = buf[c]
        start, stop, after = c.copy(), np.empty_like(c), np.empty_like(c)
        plain = ~_mask(head, QUOTES)
        stop[plain] = np.minimum(counts[np.searchsorted(counts, c[plain])], end[plain])
        after[plain] = stop[plain]
        for q in QUOTES:
            mine = head == q
            if not mine.any():
                continue
            s, e, odd = quote[q]
            at = c[mine]
            own = e[np.searchsorted(s, at, "right") - 1]
            close = np.where((own - at - 1) % 2 == 1, own - 1, odd[np.searchsorted(odd, own)])
            open_end = close >= end[mine]
            start[mine] = at + 1
            stop[mine] = np.where(open_end, end[mine], close)
            after[mine] = np.where(open_end, end[mine], close + 1)
        rows.append(active)
        starts.append(start)
        stops.append(stop)
        marks.append(np.where(plain, 0, head))
        cur[active] = np.minimum(word[after], end)
        active = active[cur[active] < end]

    if rows:
        row, s, e, mark = (np.concatenate(x) for x in (rows, starts, stops, marks))
        order = np.argsort(s, kind="stable")
        row, s, e, mark = row[order], s[order], e[order], mark[order]
        first_ink, last_ink = _next(~white), _last(~white)
        s = np.minimum(first_ink[s], e)
        e = np.maximum(last_ink[np.maximum(e - 1, 0)] + 1, s)
        some = e > s
        row, s, e, mark = row[some], s[some], e[some], mark[some]
    else:
        row = s = e = mark = np.zeros(0, np.int64)

    # the bytes of the values, without the second of each doubled quote
    delta = np.zeros(len(buf) + 1, np.int64)
    np.add.at(delta, s, 1)
    np.add.at(delta, e, -1)
    keep = np.cumsum(delta[:-1]) > 0
    inside = np.zeros(len(buf) + 1, np.int64)
    for q in QUOTES:
        mine = mark == q
        if mine.any():
            inside[:] = 0
            np.add.at(inside, s[mine], 1)
            np.add.at(inside, e[mine], -1)
            at = np.flatnonzero((buf == q) & (np.cumsum(inside[:-1]) > 0))
            rs = quote[q][0]
            first = rs[np.searchsorted(rs, at, "right") - 1]
            # a run that holds the opening quote begins one place later inside the value
            owner = s[mine][np.searchsorted(s[mine], at, "right") - 1]
            first = np.maximum(first, owner)
            keep[at[(at - first) % 2 == 1]] = False
    upto = np.concatenate(([0], np.cumsum(keep)))
    ends = upto[e]
    items = pa.StringArray.from_buffers(
        len(s), pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32).tobytes()), pa.py_buffer(buf[keep].tobytes())
    )
    heads = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(heads), items)


def unpack(df: DataFrame, key: Column, packed: Column, grammar: Grammar) -> DataFrame:
    """``(record_key, pos, item)``: one row per value of ``packed``, positions from 1 within a string.

    Null, empty and blank strings, and what stands empty between delimiters, give no row. A value's quotes and
    surrounding blanks are no part of it; a quote that is never closed runs to the end of its string. A null key is kept.
    Repeated rows give repeated values; an empty table gives none. Nothing but the two columns is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = split_packed(batch.column(1), grammar)
            parent = pc.list_parent_indices(lists)
            p = parent.to_numpy(zero_copy_only=False)
            heads = lists.offsets.to_numpy(zero_copy_only=False)
            pos = np.arange(len(p), dtype=np.int64) - heads[p] + 1 if len(p) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(parent), pa.array(pos), pc.list_flatten(lists)], ["record_key", "pos", "item"]
            )

    return df.select(key.cast("string").alias("record_key"), packed.cast("string").alias("packed")).where(
        F.length(F.trim("packed")) > 0
    ).mapInArrow(run, "record_key string, pos bigint, item string")
