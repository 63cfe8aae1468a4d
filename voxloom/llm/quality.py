"""Problem 9: per-document text statistics, and whether a document is prose, a list, a table or junk."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom.llm.batches import by_size

#: Common function words of each language: the share of common words is a statistic, and tells prose where there are such words.
COMMON = {
    "ak": "no wɔ ho a mu so bi na ne sɛ ɛne yi hɔ biara nyinaa ase efi ɛfa nanso efisɛ enti",
    "de": "der die das den dem des ein eine einen einer und oder aber von zu zum zur mit in im an am auf über für bei nach vor ist nicht es er sie ich denn",
    "en": "the of a an and or but in on at to for from with by near behind is are was that this it not so some one",
    "es": "el la los las un una de del y o pero en con por para al a que es su se lo como uno",
    "fr": "le la les un une des de du et ou mais en dans sur avec pour par à au aux que est ce il elle près",
    "pt": "o a os as um uma de da do das dos e ou mas em no na nos nas com por para ao à que é se",
    "sw": "ya wa cha vya za la kwa na katika ni kuhusu mwa kwenye lakini au kama hiyo kila ndani baada mbele nyuma karibu",
}
COMMON_WORDS = frozenset(w for words in COMMON.values() for w in words.split())
#: Characters that pile up where UTF-8 was read as an eight-bit code.
MOJIBAKE = frozenset("ÃÂ¤¶»¼½¾¿™€œŸžï�ðŸ¢£¥¦§¨©¬®¯°±²³´µ¸¹º")

#: What of the layout may decide.
SIGNALS = ("alignment", "indentation", "lengths")
KINDS = ("prose", "list", "table", "junk")
PROSE, LIST, TABLE, JUNK = range(4)
UNDECIDED = 4  # a line that only the layout around it tells

_WORD = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MARKER = re.compile(r"\s*(?:[-*+•·‣◦▪–—>]|\[[ xX✓]?\]|\(?\d{1,4}[.):]|\(?[A-Za-z][.)])\s+")
_RULE = re.compile(r"[\s|+=:_-]*[-=_|][\s|+=:_-]*")
_PAIR = re.compile(r"[^:]{1,40}:\s+\S")
_SPACES = re.compile(r"\s{2,}")
_VOWEL = re.compile(r"[aeiouyàáâãäåæèéêëìíîïòóôõöøùúûüýœɛɔəıāēīōūα-ωаеёиоуыэюя]", re.I)
_CLUSTER = re.compile(r"[bcdfghjklmnpqrstvwxz]{6,}", re.I)
_CODE = re.compile(r"[A-Za-z0-9+/=_-]{24,}|(?=[0-9a-f]*\d)(?=\d*[a-f])[0-9a-f]{12,}", re.I)
_DELIMITERS = ("\t", "|", ";", ",", "  ")
_STOPS = ".!?…。؟"
_SENTENCE = re.compile(r"\w{2}[.!?…。؟][\s'\"”’»)]+\w")
_QUOTES = "'\"”’»)] \t\r"
_BREAK = "\x1e"  # between the texts of a batch, on a line of its own


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Bits of every code point: 1 letter or digit, 2 white space, 4 mojibake, 8 a delimiter of cells or items, 16 a sign of codes,
    32 a hexadecimal digit."""
    bits = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalnum():
            bits[cp] = 1
        elif ch.isspace():
            bits[cp] = 2
    for ch in MOJIBAKE:
        bits[ord(ch)] |= 4
    for ch in "\t|;,/·•":
        bits[ord(ch)] |= 8
    for ch in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-":
        bits[ord(ch)] |= 16
    for ch in "0123456789abcdefABCDEF":
        bits[ord(ch)] |= 32
    return bits


def _cells(line: str, delimiter: str) -> list[str]:
    if delimiter == "  ":
        return _SPACES.split(line.strip())
    return line.strip().strip("|").split(delimiter) if delimiter == "|" else line.split(delimiter)


def _wordlike(word: str) -> bool:
    """Whether a word could be said: some vowels, no endless run of consonants, no digits among its letters."""
    if len(word) < 3 or word.isdigit():
        return True
    if len(word) > 30:
        return False
    vowels = len(_VOWEL.findall(word))
    if not vowels and not word.isascii():
        return True
    return vowels >= 0.15 * len(word) and not _CLUSTER.search(word) and not any(map(str.isdigit, word))


def _ends(line: str) -> bool:
    return line.rstrip(_QUOTES)[-1:] in _STOPS and bool(line.rstrip(_QUOTES))


def _common_share(line: str) -> float:
    words = _WORD.findall(line.lower().replace("n/a", ""))
    return sum(w in COMMON_WORDS for w in words) / len(words) if words else 0.0


def _listing(line: str) -> bool:
    """Many short items between commas, semicolons or the like, hardly a common word."""
    most, mark = max((line.count(d), d) for d in (",", ";", "|", "/", "·", "•"))
    if most < 3:
        return False
    items = [x for x in line.split(mark) if x.strip()]
    return len(items) >= 4 and len(_WORD.findall(line)) <= 2.6 * len(items) and _common_share(line) < 0.12


def _autocorrelation(x: np.ndarray, lag: int) -> float:
    if len(x) <= lag + 1:
        return 0.0
    d = x - x.mean()
    v = float((d * d).sum())
    return 1.0 if v == 0 else float((d[:-lag] * d[lag:]).sum() / v)


def _period(x: np.ndarray) -> float:
    """The highest autocorrelation at any lag that leaves two pairs."""
    n = len(x)
    d = x - x.mean()
    v = float((d * d).sum())
    if v == 0 or n < 3:
        return 1.0 if n > 2 else 0.0
    power = np.abs(np.fft.rfft(d, 2 * n)) ** 2
    return float(np.fft.irfft(power, 2 * n)[1 : n - 1].max() / v)


def aligned_rows(lines: list[str]) -> list[bool]:
    """Which lines are rows of a table, by vertical alignment of delimiters.

    A row has at least three cells of at most 40 characters and five spaces by one delimiter, and one of the three lines before or after it (blank lines and
    rules aside) has as many cells by it; cells set apart by spaces must mostly start in the same columns.
    """
    solid = [i for i, s in enumerate(lines) if s.strip() and not (_RULE.fullmatch(s) and len(s.strip()) > 2)]
    row = [False] * len(lines)
    for d in _DELIMITERS:
        seen: list[tuple[int, frozenset[int]] | None] = []
        for i in solid:
            cells = _cells(lines[i], d) if d in lines[i] else []
            short = len(cells) >= 3 and all(len(c) <= 40 and c.count(" ") <= 5 for c in cells)
            spots = frozenset(m.end() for m in _SPACES.finditer(lines[i].rstrip())) if d == "  " and short else frozenset()
            seen.append((len(cells), spots) if short else None)
        for k, c in enumerate(seen):
            if c is None or row[solid[k]]:
                continue
            for other in seen[max(0, k - 3) : k] + seen[k + 1 : k + 4]:
                if other is not None and other[0] == c[0] and (d != "  " or 2 * len(c[1] & other[1]) >= len(c[1])):
                    row[solid[k]] = True
                    break
    return row


def _repeats(line: str) -> bool:
    """Whether one token makes up more than half of a line of five or more."""
    tokens = [t for t in line.split() if len(t) > 1 or t.isalnum()]
    return len(tokens) >= 5 and Counter(tokens).most_common(1)[0][1] > 0.5 * len(tokens)


def _long_runs(inside: np.ndarray, least: int, begin: np.ndarray) -> np.ndarray:
    """Which lines (by where they begin) hold a run of at least ``least`` characters that are ``inside``."""
    out = np.flatnonzero(np.r_[True, ~inside, True]) - 1
    at = out[:-1][np.diff(out) > least] + 1
    found = np.zeros(len(begin), bool)
    found[np.searchsorted(begin, at, "right") - 1] = True
    return found


@dataclass
class Lines:
    """Counts per line: words, common and strange ones, the most frequent one's number; characters that aren't space, letters and
    digits, mojibake, delimiters; whether it has a marker, ends like a sentence, or holds something like a code."""

    text: list[str]
    words: np.ndarray
    common: np.ndarray
    strange: np.ndarray
    most: np.ndarray
    chars: np.ndarray
    solid: np.ndarray
    odd: np.ndarray
    marks: np.ndarray
    marker: np.ndarray
    ended: np.ndarray
    coded: np.ndarray

    def at(self, which: np.ndarray, test: Callable[[str], bool]) -> np.ndarray:
        """``test`` of the lines where ``which`` holds, False elsewhere."""
        out = np.zeros(len(which), bool)
        at = np.flatnonzero(which)
        out[at] = [test(self.text[i]) for i in at.tolist()]
        return out


def _line_kinds(x: Lines, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(kind, unsure) of every line, -1 where it is blank: by alignment first, then by symbols and odd words, then by words, sentence
    ends, listings and markers. Only lines whose counts leave a test open are looked at as text."""
    kind = np.where(x.chars == 0, -1, -2)
    unsure = np.zeros(len(kind), bool)

    def settle(which: np.ndarray, as_: int | np.ndarray, sure: bool = True) -> None:
        which = which & (kind == -2)
        kind[which] = as_[which] if isinstance(as_, np.ndarray) else as_
        unsure[which] |= not sure

    open_ = kind == -2
    rule = x.at(open_ & (x.chars > 2) & (x.solid <= 0.1 * x.chars), lambda s: len(s.strip()) > 2 and bool(_RULE.fullmatch(s.strip())))
    settle(rule, np.where(x.at(rule, lambda s: "|" in s or "+" in s), TABLE, PROSE), False)
    settle(x.at(row & (kind == -2) & (x.solid >= 0.2 * x.chars), lambda s: _common_share(s.strip()) < 0.25), TABLE)
    symbols = (x.odd > 0.15 * x.chars) | (x.solid < 0.45 * x.chars) & ((x.chars >= 8) | (x.words == 0))
    settle(symbols, JUNK)
    settle(x.at((kind == -2) & (x.solid < 0.65 * x.chars) & (x.chars >= 10), lambda s: " " not in s.strip()), JUNK)
    settle(x.at((kind == -2) & ((x.most >= 3) & (x.most >= 0.15 * x.words) | (x.solid < 0.8 * x.chars)), _repeats), JUNK)
    settle((x.words >= 3) & (x.strange > 0.5 * x.words), JUNK)
    settle(x.at((kind == -2) & x.coded, lambda s: 2 * sum(map(len, _CODE.findall(s.strip()))) > len("".join(s.split()))), JUNK)

    def content(s: str) -> str:
        m = _MARKER.match(s)
        return s[m.end() :] if m else s.strip()

    listing = x.at((kind == -2) & (x.marks >= 3), lambda s: _listing(content(s)))
    settle(~listing & ((x.words >= 4) & (x.common >= 0.12 * x.words) | (x.words >= 5) & x.ended), PROSE)
    settle(listing | x.marker, LIST)
    settle(x.at((kind == -2) & (x.words <= 6), lambda s: bool(_PAIR.match(s.strip()))), LIST)
    settle(x.words <= 4, LIST, False)
    settle(kind == -2, UNDECIDED)
    return kind, unsure


def _recurs(x: np.ndarray, share: int) -> bool:
    """Whether values come again at some lag up to a ``share``-th of their number: autocorrelation by pair of 0.8 or more."""
    n = len(x)
    d = x - x.mean()
    v = float((d * d).sum())
    if v == 0:
        return True
    power = np.abs(np.fft.rfft(d, 2 * n)) ** 2
    lags = np.arange(1, n // share + 1)
    return bool((np.fft.irfft(power, 2 * n)[lags] * n >= 0.8 * v * (n - lags)).any())


def _by_layout(lines: list[str], kinds: list[int], indent: np.ndarray, signals: Sequence[str] = SIGNALS) -> None:
    """Lines that neither words nor marks decide: items where the stretch of such lines and items is laid out regularly, else prose.

    Regular are four lines or more whose indentation comes again, and six or more whose lengths do, at least three times over.
    A stretch (blank lines aside) ends at any other line; one that holds a sentence, or the same line throughout, is prose.
    """
    stretch: list[int] = []
    for i, k in enumerate([*kinds, PROSE]):
        if k in (LIST, UNDECIDED):
            stretch.append(i)
        elif k >= 0:
            open_lines = [j for j in stretch if kinds[j] == UNDECIDED]
            regular = False
            if open_lines and len({lines[j] for j in stretch}) > 1 and not any(_SENTENCE.search(lines[j]) for j in open_lines):
                for part in (stretch, open_lines):  # with the short lines and marked items around, and without
                    deep, long = indent[part], np.array([len(lines[j].strip()) for j in part], float)
                    regular |= "indentation" in signals and len(part) >= 4 and bool(deep.any()) and _recurs(deep, 2)
                    regular |= "lengths" in signals and len(part) >= 6 and _recurs(long, 3)
            for j in open_lines:
                kinds[j] = LIST if regular else PROSE
            stretch = []


def _settle(lines: list[str], kinds: list[int], unsure: list[bool]) -> None:
    """Short lines without a marker: the end of a wrapped paragraph, a heading, or an item among items."""
    filled = sum(k >= 0 for k in kinds)
    for i, k in enumerate(kinds):
        if k != LIST or not unsure[i]:
            continue
        before = kinds[i - 1] if i else -1
        after = next((x for x in kinds[i + 1 :] if x >= 0), -1)
        if before == PROSE and len(lines[i - 1]) > 20:
            kinds[i] = PROSE
        elif lines[i].rstrip().endswith(":") and after >= 0:
            kinds[i] = after
        elif _ends(lines[i]) and len(lines[i].split()) >= 3:
            kinds[i] = PROSE
        elif filled == 1:
            kinds[i] = LIST if len(lines[i].split()) > 1 else PROSE


STATS = (
    "n_chars", "n_words", "mean_word_length", "symbol_ratio", "line_end_ratio", "common_ratio", "delimiter_alignment",
    "indent_period", "length_autocorrelation", "prose_share", "list_share", "table_share", "junk_share",
)


def _words(text: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(line, code into the distinct words, these) of every word: letters and digits, with single apostrophes and hyphens inside.

    Words are told apart by a 64-bit hash of their code points, all from one running sum; only distinct ones become strings.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.r_[False, (_classes()[points] & 1) > 0, False]
    joint = np.flatnonzero((points == 0x27) | (points == 0x2019) | (points == 0x2D)) + 1
    inside[joint] = inside[joint - 1] & inside[joint + 1]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    with np.errstate(over="ignore"):
        base, back = np.full(len(points), _BASE), np.full(len(points) + 1, np.uint64(pow(int(_BASE), -1, 1 << 64)))
        base[:1], back[0] = 1, 1
        sums = np.r_[np.uint64(0), np.cumsum((points + np.uint64(1)) * np.cumprod(base, dtype=np.uint64), dtype=np.uint64)]
        hashes = (sums[end] - sums[start]) * np.cumprod(back, dtype=np.uint64)[start]
        codes, distinct = pd.factorize((hashes ^ (hashes >> np.uint64(32))) * _BASE)
    sample = np.zeros(len(distinct), np.int64)
    sample[codes[::-1]] = np.arange(len(codes))[::-1]
    lines = np.cumsum(points == 10)[start] if len(start) else start
    return lines, codes, [text[a:b] for a, b in zip(start[sample].tolist(), end[sample].tolist(), strict=True)]


def describe(texts: list[str], signals: Sequence[str] = SIGNALS) -> tuple[np.ndarray, list[str | None]]:
    """(one row of STATS per text, kinds). The kind holds most characters; null for a blank text.

    Characters, words, indentation and what follows from their counts are found for all lines of a batch by table lookups;
    rows are looked for in texts with delimiters, and layouts where lines stay open. ``signals`` are those of the layout that may
    decide: the alignment of delimiters, the periodicity of indentation, the autocorrelation of line lengths.
    """
    n = len(texts)
    docs = [t.replace(_BREAK, " ").replace("\r", "\n").split("\n") for t in texts]
    lines = [s for d in docs for s in d]
    per_doc = np.fromiter(map(len, docs), np.int64, n)
    doc = np.repeat(np.arange(n), per_doc)
    first = np.cumsum(per_doc) - per_doc
    m = len(lines)
    joined = "\n".join(lines) + "\n"
    bits = _classes()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    size = np.fromiter(map(len, lines), np.int64, m)
    begin = np.cumsum(size + 1) - (size + 1)

    def per_line(mask: int) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum((bits & mask) > 0)][np.r_[begin, len(bits)]]) if m else np.zeros(0, np.int64)

    solid, odd, marks = per_line(1), per_line(4), per_line(8)
    chars = size - (per_line(2) - 1)
    line_of, codes, unique = _words(joined.lower())
    feature = np.array([(0, u in COMMON_WORDS, not _wordlike(u), len(u)) for u in unique], np.int64).reshape(-1, 4)
    words, common, strange = (np.bincount(line_of, minlength=m), *(np.bincount(line_of, weights=feature[codes, k], minlength=m).astype(np.int64) for k in (1, 2)))
    most = np.zeros(m, np.int64)
    pair, times = np.unique(line_of * np.int64(len(unique) + 1) + codes, return_counts=True)
    np.maximum.at(most, pair // (len(unique) + 1), times)

    marker = np.array([bool(_MARKER.match(s)) for s in lines], bool)
    ended = np.array([_ends(s) for s in lines], bool) & (chars > 0)
    coded = _long_runs((bits & 16) > 0, 24, begin) | _long_runs((bits & 32) > 0, 12, begin) if m else np.zeros(0, bool)
    wide = np.array(["  " in s and bool(_SPACES.search(s.strip())) for s in lines], bool)
    cells = np.bincount(doc, weights=(marks >= 2) | wide, minlength=n) >= 2
    row = np.zeros(m, bool)
    for d in np.flatnonzero(cells).tolist() if "alignment" in signals else ():
        a, b = first[d], first[d] + per_doc[d]
        row[a:b] = aligned_rows(lines[a:b])
    ink = np.r_[np.flatnonzero((bits & 2) == 0), len(bits)]
    indent = np.minimum(ink[np.searchsorted(ink, begin)] - begin, size) + 8 * marker
    kind, unsure = _line_kinds(Lines(lines, words, common, strange, most, chars, solid, odd, marks, marker, ended, coded), row)
    for d in np.flatnonzero(np.bincount(doc, weights=unsure | (kind == UNDECIDED), minlength=n)).tolist() if m else ():
        a, b = first[d], first[d] + per_doc[d]
        settled = kind[a:b].tolist()
        _by_layout(lines[a:b], settled, indent[a:b], signals)
        _settle(lines[a:b], settled, unsure[a:b].tolist())
        kind[a:b] = settled

    held = np.zeros((n, 4))
    np.add.at(held, (doc[kind >= 0], kind[kind >= 0]), size[kind >= 0])
    total = np.bincount(doc, weights=words, minlength=n)
    top = np.zeros(n)
    if len(codes):
        # the same token over and over: by words, or by what stands between spaces where there are none
        pair, times = np.unique(doc[line_of] * np.int64(len(unique)) + codes, return_counts=True)
        np.maximum.at(top, pair // len(unique), times)
    for d in np.flatnonzero((top > 0.5 * total) | (total == 0)):
        parts = [t for t in texts[d].split() if len(t) > 1 or t.isalnum()]
        if len(parts) >= 8 and Counter(parts).most_common(1)[0][1] > 0.6 * len(parts):
            held[d] = (0, 0, 0, 1)
    sums = held.sum(1, keepdims=True)
    share = held / np.where(sums > 0, sums, 1)
    filled = np.bincount(doc, weights=chars > 0, minlength=n)
    out = np.zeros((n, len(STATS)))

    def ratio(x: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.where(of > 0, x / np.where(of > 0, of, 1), 0.0)

    visible = np.bincount(doc, weights=chars, minlength=n)
    out[:, 0] = [len(t) for t in texts]
    out[:, 1] = total
    out[:, 2] = ratio(np.bincount(doc[line_of], weights=feature[codes, 3], minlength=n), total)
    out[:, 3] = np.where(visible > 0, 1 - ratio(np.bincount(doc, weights=solid, minlength=n), visible), 0)
    out[:, 4] = ratio(np.bincount(doc, weights=ended, minlength=n), filled)
    out[:, 5] = ratio(np.bincount(doc, weights=common, minlength=n), total)
    out[:, 6] = ratio(np.bincount(doc, weights=row, minlength=n), filled)
    some = chars > 0
    for d in np.flatnonzero(filled > 2):
        own = slice(first[d], first[d] + per_doc[d])
        x = size[own][some[own]].astype(float)
        out[d, 8] = _autocorrelation(x, 1)
        y = indent[own][some[own]]
        if y.any():
            out[d, 7] = _period(y)
    out[:, 9:] = share
    kinds = [None if f == 0 else KINDS[PROSE] if p[PROSE] > 0.5 else KINDS[1 + int(p[1:].argmax())] for f, p in zip(filled, share, strict=True)]
    return out, kinds


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_size(batches, "__vx_text"):
        rest = [c for c in batch.schema.names if c != "__vx_text"]
        texts = batch.column("__vx_text").to_pylist()
        stats, kinds = describe([t or "" for t in texts])
        null = np.array([t is None for t in texts], bool)
        columns = [pa.array(stats[:, i], mask=null).cast(pa.int64()) if i < 2 else pa.array(stats[:, i], mask=null) for i in range(len(STATS))]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *columns, pa.array(kinds, pa.string())], [*rest, *STATS, "kind"])


def text_quality(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the statistics of STATS and the kind of ``text``: prose, list, table or junk.

    Lines are told apart by delimiters that align vertically, by their symbols, words and sentence ends, and by markers; where
    these leave a line open, by whether indentation or line lengths around it come again. The text's kind is prose where prose
    lines hold most characters, else the largest of the others. Null texts have null statistics, blank texts a null kind. Columns of the same names are replaced; all others pass through.
    """
    given = df.drop(*STATS, "kind").withColumn("__vx_text", F.col(text) if text not in (*STATS, "kind") else F.lit(None))
    kept = [f for f in given.schema.fields if f.name != "__vx_text"]
    new = [T.StructField(s, T.LongType() if i < 2 else T.DoubleType()) for i, s in enumerate(STATS)]
    schema = T.StructType([*kept, *new, T.StructField("kind", T.StringType())])
    return given.select(*[f.name for f in kept], "__vx_text").mapInArrow(_described, schema)
