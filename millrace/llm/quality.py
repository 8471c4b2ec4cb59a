"""Per-document text statistics, and whether a text is prose, a list, a table or junk.

A document's lines are looked at as a grid: counts of each delimiter per line (vertical alignment), the columns where
gaps open, the period of the indentation and the autocorrelation of the line lengths. Lines are then told apart as rows,
entries, junk or running text, together with word, symbol and punctuation ratios; what most of the text is, it is.

The texts of a batch are laid out as one array of characters. Class masks over it and their running sums give every
line's counts, its first and last mark, its tokens and words at once; common words are looked up by the hash of their
characters. Only what a mask can't tell (markers, labels, markup) is searched in single lines. Whole texts are read, of
any length; a text's work is linear in its length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

STATS_SCHEMA = (
    "doc_id bigint, n_chars bigint, n_lines bigint, word_count bigint, mean_word_length double, symbol_ratio double, "
    "end_punct_ratio double, common_word_ratio double, delimiter_alignment double, indent_periodicity double, "
    "length_autocorrelation double, kind string"
)

# fixed values: markers that open an entry of an enumeration
MARKER = re.compile(
    r"^\s*(?:[-*•·–—▪◦‣・●○■□▶►→✓>]+\s*(?=\S)|\(?\d{1,4}\s*[.)．、:：\]]\s*(?=\S)|\[\d{1,4}\]\s*|\(?[A-Za-z]\)\s*|"
    r"[A-Za-z]\.\s+|\(?[ivxlIVXL]{1,6}[.)]\s+|[(（]?[一二三四五六七八九十百]{1,4}[、．.)）]\s*|[(（]\d{1,4}[)）]\s*|[①-⑳]\s*|"
    r"(?:[Ss]tep|[Ss]chritt|[Pp]aso|第)\s*[\d一二三四五六七八九十]{1,4}\s*[:：.、步]?\s*|#\d{1,4}\s+)"
)
LABEL = re.compile(r"^\s*[^\W\d_][\w .&'/-]{0,28}\s?[:：]\s+\S")
CJK = re.compile(r"[぀-ヿ㐀-鿿豈-﫿가-힯]")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
TERMINAL = tuple(".!?。！？…．:：\"”»」』)）’'")
# fixed values: marks that end a sentence, and what may follow them
SENTENCE_MARKS = frozenset(".!?。！？…")
CLOSERS = "\"”»」』)）’' \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u2028\u2029\u3000"
MARKUP = re.compile(r"<[^<>]{0,200}>|&#?\w{1,10};|\{\}")
HEX = re.compile(r"(?<!\S)[0-9A-Fa-f]{2}(?!\S)")
RULE = re.compile(r"^[\s|+:=_.\-─━┼┬┴├┤]+$")
PAIR = re.compile(r"(?<!\S)[^\s=]{1,30}=")
QUOTED = re.compile(r"\"[^\"\n]*\"")
GAP = re.compile(r"\S(?:\s{2,}|\t)(?=\S)")
ROUGH = re.compile(r"[bcdfghjklmnpqrstvwxz]{4,}|[aeiou]{4,}|[jqxz][bcdfghjklmnpqrstvwxz]|[^\W\d_]{16,}")
MOJIBAKE = re.compile(r"[\u0080-ÿŒœŠšŸŽžƒˆ˜–-…‰‹›€™]")
EMOJI = re.compile(r"[\U0001F000-\U0001FAFF☀-➿️‍⃣]")


def repeated_share(text: str) -> float:
    """The share of the text that equals itself one period on, for the period of its own beginning or middle."""
    t = " ".join(text.split())
    n = len(t)
    if n < 24:
        return 0.0
    codes = None
    best = 0.0
    for at in (0, n // 3, n // 2):
        probe = t[at : at + 12]
        nxt = t.find(probe, at + 1)
        if nxt > 0 and (nxt - at) * 3 <= n:
            p = nxt - at
            codes = np.frombuffer(t.encode("utf-32-le"), np.uint32) if codes is None else codes
            best = max(best, float(np.mean(codes[p:] == codes[:-p])))
    return best


def _periodic(x: np.ndarray) -> float:
    """The greatest autocorrelation of a series at lags 1 to 8."""
    n = len(x)
    if n < 4:
        return 0.0
    x = x - x.sum() / n
    v = float(x @ x)
    if v == 0:
        return 1.0
    return max(float(x[k:] @ x[:-k]) / v for k in range(1, min(9, n - 1)))


# classes of characters
BLANK, ALPHA, DIGIT, LETTER, CJK_, MARK, CLOSER, EMOJI_, MOJI, BREAK, RULER, LOWER, WIDE = (1 << i for i in range(13))
#: Characters laid out at once (a longer text is laid out by itself), and the odd multiplier of word hashes.
AT_ONCE, ODD = 1 << 20, 0x9E3779B97F4A7C15


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """The classes and the lower-case form of every character of the basic plane, from the rules above."""
    flags, lower = np.zeros(0x10000, np.uint16), np.arange(0x10000, dtype=np.uint32)
    mojibake, emoji, ruler = set(), set(), set("|+:=_.-─━┼┬┴├┤")
    for code in range(0x10000):
        c = chr(code)
        f = BLANK * c.isspace() | ALPHA * c.isalpha() | DIGIT * c.isdigit() | LETTER * (c.isalnum() and not c.isdecimal()) | LOWER * c.islower() | WIDE * (code > 127)
        f |= MARK * (c in SENTENCE_MARKS) | CLOSER * (c in CLOSERS or c.isspace()) | BREAK * (c in "\n\r\u2028\u2029") | RULER * (c in ruler or c.isspace())
        flags[code] = f
        low = c.lower()
        if low != c and len(low) == 1:
            lower[code] = ord(low)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    for pattern, f in ((CJK, CJK_), (EMOJI, EMOJI_), (MOJIBAKE, MOJI)):
        for m in pattern.finditer(every):
            flags[ord(m.group())] |= f
    return flags, lower


_TABLES: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    if not _TABLES:
        _TABLES.extend(_classes())
        odd = np.full(1 << 16, ODD, np.uint64)
        odd[0] = 1
        with np.errstate(over="ignore"):
            _TABLES.append(np.cumprod(odd))
    return _TABLES


def _install(tables: list[np.ndarray]) -> None:
    if not _TABLES:
        _TABLES.extend(tables)


def _hashes(codes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of each run of characters, runs of more than 64 by their first 64: no common word is that long."""
    power = _tables()[2]
    size = np.minimum(stop - start, 64)
    owner = np.repeat(np.arange(len(start)), size)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    with np.errstate(over="ignore"):
        part = (codes[start[owner] + k].astype(np.uint64) + np.uint64(1)) * power[k + 1]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part)))
        ends = np.cumsum(size)
        return (total[ends] - total[ends - size]) ^ ((stop - start).astype(np.uint64) * np.uint64(ODD))


def _word_hashes(words: frozenset[str]) -> np.ndarray:
    rows = [w for w in words if w]
    if not rows:
        return np.zeros(0, np.uint64)
    codes = np.frombuffer("".join(rows).encode("utf-32-le", "surrogatepass"), np.uint32)
    stop = np.cumsum([len(w) for w in rows])
    return np.unique(_hashes(codes, stop - [len(w) for w in rows], stop))


class Sheet:
    """The lines of a batch of texts that aren't blank, with their measures as arrays; ``doc`` tells each line's text."""

    def __init__(self, texts: list[str], spaced: np.ndarray):
        table, low, _ = _tables()
        joined = "\n".join(texts) + "\n"
        raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.minimum(raw, 0xFFFF)
        flags = table[codes]
        far = np.flatnonzero(raw > 0xFFFF)
        flags[far] = np.where((raw[far] >= 0x1F000) & (raw[far] <= 0x1FAFF), EMOJI_ | WIDE, np.where((raw[far] >= 0x20000) & (raw[far] < 0x40000), ALPHA | LETTER | WIDE, WIDE)).astype(np.uint16)
        self.size = np.array([len(t) for t in texts], np.int64)
        self.begin = np.cumsum(self.size + 1) - self.size - 1
        blank = (flags & BLANK) > 0
        nxt = np.append(flags[1:], np.uint16(BLANK))
        cut = ((flags & BREAK) > 0) | ((raw == 0x85) & ((nxt & BLANK) > 0))
        cuts = np.flatnonzero(cut)
        start, stop = np.concatenate(([0], cuts[:-1] + 1)), cuts
        ink = np.flatnonzero(~blank)
        inks = np.searchsorted(ink, stop) - np.searchsorted(ink, start)
        start, stop, inks = start[inks > 0], stop[inks > 0], inks[inks > 0]
        self.doc = np.searchsorted(self.begin, start, "right") - 1
        self.start, self.stop, self.n = start, stop, inks

        def total(mask: np.ndarray, a: np.ndarray = start, b: np.ndarray = stop) -> np.ndarray:
            there = np.flatnonzero(mask)
            return np.searchsorted(there, b) - np.searchsorted(there, a)

        is_ = lambda f: (flags & f) > 0
        self.alpha, self.digit, self.wide, self.cjk = (total(is_(f)) for f in (ALPHA, DIGIT, WIDE, CJK_))
        some_wide = bool(self.wide.any())
        none = np.zeros(len(start), np.int64)
        self.emoji, self.moji, self.broken = (total(is_(EMOJI_)), total(is_(MOJI)), total(raw == 0xFFFD)) if some_wide else (none, none, none)
        self.first, self.last = ink[np.searchsorted(ink, start)], ink[np.searchsorted(ink, stop) - 1]
        self.lower_first = (flags[self.first] & LOWER) > 0
        # the last character of a line that closes nothing
        said = np.flatnonzero(~is_(CLOSER | EMOJI_))
        mark = said[np.maximum(np.searchsorted(said, stop) - 1, 0)] if len(said) else np.full(len(stop), -1)
        self.ended = (mark >= start) & (mark < stop) & ((flags[np.maximum(mark, 0)] & MARK) > 0)
        self.rule = (total(is_(RULER)) == stop - start) & (self.last > self.first)
        self.counts = {d: total(raw == ord(d)) for d in "\t|;,="}
        for d in ";,":  # a line that ends in its only delimiter isn't cut by it
            self.counts[d] = np.where((self.counts[d] == 1) & (raw[self.last] == ord(d)), 0, self.counts[d])
        after = np.append(raw[1:], 0)
        self.listed = total(((raw == ord(",")) | (raw == ord(";"))) & (after == 32), self.first, self.last) > 0
        self.doubled = total((raw == 32) & (after == 32), start, np.maximum(start, stop - 1)) > 0
        self.quoted = total(raw == ord('"')) > 0
        self.tagged = total((raw == ord("<")) | (raw == ord("&")) | (raw == ord("{"))) > 0
        # tokens
        head = np.flatnonzero(~blank & np.append(True, blank[:-1]))
        tail = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
        own = np.searchsorted(start, head, "right") - 1
        self.tokens = np.bincount(own, minlength=len(start))
        self.longest = np.maximum.reduceat(tail - head, np.searchsorted(own, np.arange(len(start)))) if len(start) else none
        # words: runs of letters of spaced scripts, with apostrophes inside
        letter = is_(LETTER) & ~is_(CJK_)
        apostrophe = (raw == ord("'")) | (raw == 0x2019)
        letter |= apostrophe & np.append(False, letter[:-1]) & np.append(letter[1:], False)
        w0 = np.flatnonzero(letter & ~np.append(False, letter[:-1]))
        w1 = np.flatnonzero(letter & ~np.append(letter[1:], False)) + 1
        small = low[codes]
        h = _hashes(small, w0, w1)
        common = spaced[np.minimum(np.searchsorted(spaced, h), len(spaced) - 1)] == h if len(spaced) else np.zeros(len(h), bool)
        in_doc = np.searchsorted(self.begin, w0, "right") - 1
        docs = len(texts)
        glyph = np.flatnonzero(is_(CJK_) & is_(LETTER))
        glyphs = np.bincount(np.searchsorted(self.begin, glyph, "right") - 1, minlength=docs)
        self.words = np.bincount(in_doc, minlength=docs) + glyphs
        self.word_chars = np.bincount(in_doc, w1 - w0, docs).astype(np.int64) + glyphs
        self.known = np.bincount(in_doc, common, docs).astype(np.int64)
        line = np.searchsorted(start, w0, "right") - 1
        if some_wide:
            plain = total(is_(WIDE), w0, w1) == 0
            w0, w1, line, common = w0[plain], w1[plain], line[plain], common[plain]
        self.found = np.bincount(line, minlength=len(start))
        self.found_chars, self.found_known = np.bincount(line, w1 - w0, len(start)), np.bincount(line, common, len(start))
        self.texts, self.lines_at = texts, np.searchsorted(self.doc, np.arange(docs + 1))
        self.joined = joined
        self.glyphs = np.bincount(self.doc, self.cjk, docs) > 0
        # the delimiters that at least a third of a text's lines hold: with fewer, most can't be rows
        held = {d: self.doubled if d == "  " else self.counts[d] > 0 for d in ("\t", "|", ";", ",", "=", "  ")}
        of = np.diff(self.lines_at)
        self.candidates = {d: (np.bincount(self.doc, h, docs) * 3 >= of) & (of > 1) for d, h in held.items()}

    def line(self, i: int) -> str:
        return self.joined[self.start[i] : self.stop[i]]

    def junk(self, common: frozenset[str]) -> np.ndarray:
        """Which lines can't be read as words, entries or cells in any language."""
        n, wide = self.n, self.wide > 0
        symbols = n - self.alpha - self.digit - np.where(wide, self.emoji, 0)
        junk = wide & ((self.broken > 0.2 * n) | ((n >= 8) & (self.moji > 0.35 * n)))
        for i in np.flatnonzero(self.tagged & ~junk):
            s = self.line(i)
            junk[i] = sum(map(len, MARKUP.findall(s))) > 0.5 * len(s)
        open_ = ~junk & (n >= 6)
        for i in np.flatnonzero(open_ & (self.tokens >= 8) & (2 * self.tokens > 0.8 * n)):
            junk[i] = len(HEX.findall(self.line(i))) > 0.8 * self.tokens[i]
        junk |= open_ & (((symbols > 0.6 * n) & (n >= 8)) | ((self.digit > 0.85 * n) & (self.tokens >= 5)))
        open_ &= ~junk & ~(wide & (self.alpha > 0) & (self.cjk > 0))
        for i in np.flatnonzero(open_ & (self.longest >= 40) & (self.longest > 0.5 * n)):
            junk[i] = not self.line(i).lstrip().startswith("http")
        # broken recognition: words in pieces, with signs and figures in between
        junk |= open_ & (n >= 30) & (self.found > 0) & (symbols + self.digit > 0.25 * n) & (self.found_chars < 2.7 * self.found)
        rough = open_ & ~junk & (self.found >= 5) & (self.found * 2 >= self.tokens) & (self.found_known < 0.08 * self.found)
        for i in np.flatnonzero(rough):
            words = [w for w in WORD.findall(self.line(i).lower()) if w.isascii()]
            junk[i] = sum(1 for w in words if ROUGH.search(w)) > 0.3 * len(words)
        return junk

    def aligned(self, k: int, p: slice) -> float:
        """The share of a text's lines that are rows of the same cells, by the delimiter that aligns best."""
        n = p.stop - p.start
        candidates = [d for d, yes in self.candidates.items() if yes[k]]
        if not candidates:
            return 0.0
        rule, width = self.rule[p], self.last[p] - self.first[p] + 1
        quoted = np.flatnonzero(self.quoted[p])
        bare = {i: QUOTED.sub("q", self.line(p.start + i)).strip() for i in quoted}
        if bare:
            width = width.copy()
            width[quoted] = [len(x) for x in bare.values()]
        share = 0.0
        for d in candidates:
            if d == "=":
                counts = np.array([len(PAIR.findall(bare.get(i) or self.line(p.start + i))) for i in range(n)])
            elif d == "  ":
                counts = np.array([len(GAP.findall(bare.get(i) or self.line(p.start + i).strip())) for i in range(n)])
            else:
                counts = self.counts[d][p]
                if bare and d != "\t":
                    counts = counts.copy()
                    for i, x in bare.items():
                        k = x.count(d)
                        counts[i] = 0 if d in ";," and k == 1 and x.endswith(d) else k
            seen = np.bincount(np.where(rule, 0, counts))[1:]
            if not len(seen) or not seen.any():
                continue
            mode = int(seen.argmax()) + 1
            rows = (counts == mode) & ~rule
            if d == "  ":
                # cells may be empty: what counts is that gaps end in columns that most rows share
                at = [frozenset(m.end() for m in GAP.finditer(self.line(p.start + i))) for i in range(n)]
                ends = Counter(c for a in at for c in a)
                shared = {c for c, k in ends.items() if k * 2 >= seen.sum()}
                rows = (rows | np.array([bool(a) and a <= shared for a in at])) & ~rule
            # two cells: only if both are short everywhere
            if mode < (2 if d in ("=", ",", ";") else 1) and (d == "=" or float(rows.mean()) < 0.75):
                continue
            idx = np.flatnonzero(rows)
            if len(idx) < 2:
                continue
            # cells are short and not sentences
            if float(np.median(width[idx] / (mode + 1))) > 30:
                continue
            if d in (",", ";", "  ") and float(self.ended[p][idx].mean()) > 0.4:
                continue
            if d in (",", ";") and mode < 3 and float(self.listed[p][idx].mean()) > 0.5:
                continue
            share = max(share, float((rows | rule).mean()))
        return share

    def kind(self, i: int, p: slice, junk: np.ndarray, indents: np.ndarray, grid: tuple[float, float, float], ends: float, ratio: float) -> str:
        lengths = (self.stop[p] - self.start[p]).astype(float)
        n, total = len(lengths), float(lengths.sum())
        aligned, indented, stepped = grid
        # rows of one length after another, or records of a fixed number of lines, need fewer aligned ones to be a table
        most = 0.4 if n >= 6 and stepped > 0.6 else 0.5
        if repeated_share(self.texts[i]) > 0.85:
            return "junk"
        if aligned <= most and float(lengths[junk[p]].sum()) > 0.5 * total:
            return "junk"
        if aligned > most:
            wordy = ratio > 0.2 and ends > 0.3
            if not wordy or int(self.digit[p].sum()) > 0.15 * total:
                return "table"
        lines = [self.line(k) for k in range(p.start, p.stop)]
        opens = np.array([bool(MARKER.match(s)) for s in lines])
        marked = opens
        if indented > 0.3 and opens.sum() >= 2:
            # indentation that comes and goes: deeper lines below a marked one go on with its entry
            marked = opens.copy()
            own, inside = -1.0, False
            for k in range(n):
                inside = bool(marked[k]) or (inside and indents[k] > own)
                own = indents[k] if marked[k] else own
                marked[k] = inside
        if n >= 2 and marked.sum() > 0.5 * n:
            return "list"
        if n >= 3:
            ended = self.ended[p]
            short = (lengths * np.where(self.cjk[p] > 0, 2, 1) <= 64) & ~ended
            entry = marked | short | np.array([not e and bool(LABEL.match(s)) for e, s in zip(ended, lines)])
            if entry.sum() > 0.5 * n:
                # wrapped running text has short lines too: they are filled, hold common words and go on in lower case
                flow = int((~ended[:-1] & self.lower_first[p][1:] & ~opens[1:]).sum())
                order = np.sort(lengths)
                k, rest = divmod(0.9 * (n - 1), 1)
                top = order[int(k)] + rest * (order[min(int(k) + 1, n - 1)] - order[int(k)])
                filled = float((lengths > 0.75 * top).mean())
                if not (ratio > 0.2 and (filled > 0.6 or flow > 0.35 * n)):
                    return "list"
        return "prose"


def describe_all(texts: list[str | None], common: Mapping[str, frozenset[str]]) -> list[tuple]:
    """The statistics of each text, and its kind (null for null, empty and blank ones)."""
    out: list[tuple] = [(len(t or ""), 0, 0, *[None] * 8) for t in texts]
    spaced, unspaced = _word_hashes(common["spaced"]), common["unspaced"]
    live = [i for i, t in enumerate(texts) if t and not t.isspace()]
    while live:
        n, chars = 0, 0
        while n < len(live) and (not n or chars + len(texts[live[n]]) <= AT_ONCE):
            chars += len(texts[live[n]])
            n += 1
        part, live = live[:n], live[n:]
        sheet = Sheet([texts[i] for i in part], spaced)
        junk = sheet.junk(common["spaced"])
        for k, i in enumerate(part):
            p = slice(int(sheet.lines_at[k]), int(sheet.lines_at[k + 1]))
            lines = p.stop - p.start
            words, known = int(sheet.words[k]), int(sheet.known[k])
            if sheet.glyphs[k]:
                joined = "".join(CJK.findall(texts[i].lower()))
                known += sum(joined.count(w) * len(w) for w in unspaced)
            ratio = min(1.0, known / words) if words else 0.0
            symbols = 1 - int((sheet.alpha[p] + sheet.digit[p]).sum()) / int(sheet.n[p].sum())
            ends = int(sheet.ended[p].sum()) / lines
            indents = (sheet.first[p] - sheet.start[p]).astype(float)
            grid = (sheet.aligned(k, p), _periodic(indents) if indents.any() else 0.0, _periodic((sheet.stop[p] - sheet.start[p]).astype(float)))
            stats = (len(texts[i]), lines, words, int(sheet.word_chars[k]) / words if words else 0.0, symbols, ends, ratio, *grid)
            out[i] = (*stats, sheet.kind(k, p, junk, indents, grid, ends, ratio))
    return out


def describe(text: str | None, common: Mapping[str, frozenset[str]]) -> tuple:
    """``describe_all`` of one text."""
    return describe_all([text], common)[0]


def text_statistics(docs: DataFrame, common: Mapping[str, frozenset[str]]) -> DataFrame:
    """``STATS_SCHEMA`` per row of ``docs`` (doc_id, text).

    ``common`` holds the common words: ``spaced`` for scripts with blanks (lower case), ``unspaced`` for those without.
    Null, empty and blank texts have no words and a null kind; a null doc_id stays null; an empty table gives no rows.
    """

    tables = _tables()  # of fixed size; made once, on the driver

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in STATS_SCHEMA.split(", ")]
        _install(tables)
        for b in batches:
            got = describe_all(b["text"].tolist(), common)
            yield pd.DataFrame([(i, *g) for i, g in zip(b["doc_id"], got)], columns=names, dtype=object)

    return docs.select("doc_id", "text").mapInPandas(run, STATS_SCHEMA)


def common_words(df: DataFrame) -> dict[str, frozenset[str]]:
    """The fixed table (lang, word, freq_rank) as sets; a dictionary of a few hundred rows, whatever the corpus' size."""
    words = [r[0].strip().lower() for r in df.select("word").where("word IS NOT NULL").collect() if r[0].strip()]
    return {"spaced": frozenset(w for w in words if not CJK.search(w)), "unspaced": frozenset(w for w in words if CJK.search(w))}
