"""Problem 7: evaluation texts leaking into training text."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.batches import by_size
from voxloom.operators.lineage import cut, spread

#: Words on end that make a leak; shorter items must occur whole.
WINDOW = 12
#: The sieve that documents' windows pass has so many bits per window of the items, within these bounds.
SIEVE_BITS, SIEVE_LEAST, SIEVE_MOST = 256, 1 << 22, 1 << 30
#: Windows of items that are sent to all tasks for the join; more are joined by a shuffle.
BROADCAST_WINDOWS = 200_000
#: Texts with more words in capitals than this share write no names apart.
MOST_CAPITALS = 0.8

#: Units of measure, which are such only right after a number.
UNITS = frozenset(
    "mm cm dm km mg kg ml cl dl sec min hr hrs ms kb mb gb tb hz khz mhz ghz kw kv mph kmh km² m² m³ usd eur gbp lb lbs oz ft "
    "percent prozent ciento cent metre metres meter meters kilometre kilometres kilometer kilometers gram grams kilogram kilograms litre litres "
    "liter liters hour hours minute minutes second seconds dollar dollars euro euros stunde stunden minuten sekunden hora horas minuto minutos "
    "heure heures seconde secondes saa dakika".split()
)
WORD, NUMBER, UNIT, NAME = range(4)
PLACEHOLDERS = ("", "\x01number", "\x01unit", "\x01name")
#: Ways to read a text: word by word with numbers and units as slots; then with runs of a kind as one slot of any length,
#: with no names, with names told by capitals inside a sentence, and with names told by capitals anywhere.
VARIANTS = ("plain", "numbers", "inside", "anywhere")

_TOKEN = re.compile(r"\x1e|[^\W_]+|[.!?:…\n]")
_BREAK = "\x1e"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def fold(word: str) -> str:
    """The form in which words compare: letter case and the encoding of accents don't matter."""
    return word.casefold() if word.isascii() else unicodedata.normalize("NFC", unicodedata.normalize("NFC", word).casefold())


def _hashes(values: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(values, dtype=object)) | np.uint64(1) if values else np.zeros(0, np.uint64)


@dataclass
class Words:
    """The words of a batch of texts: row of each, code into ``unique`` (folded), kind in each variant, place in its text."""

    row: np.ndarray
    code: np.ndarray
    unique: list[str]
    kinds: dict[str, np.ndarray]
    place: np.ndarray


def read(texts: list[str | None]) -> Words:
    """Words with their kinds. Every text is read by itself: what a word is depends neither on other texts nor on the items."""
    joined = unicodedata.normalize("NFC", _BREAK.join((x or "").replace(_BREAK, " ") for x in texts) + _BREAK)
    codes, unique = pd.factorize(np.array(_TOKEN.findall(joined), dtype=object))
    of = lambda f: np.array([f(u) for u in unique], bool)[codes]
    stop = codes == list(unique).index(_BREAK)
    row_of = np.cumsum(stop) - stop
    word = of(lambda u: u[0].isalnum())
    begins = np.ones(len(codes), bool)
    begins[1:] = ~word[:-1]
    keep = np.flatnonzero(word)
    row, begins, upper = row_of[keep], begins[keep], of(lambda u: u[0].isupper())[keep]
    shouted = of(lambda u: len(u) > 1 and u.isupper())[keep]
    folded = [fold(u) for u in unique]
    code = codes[keep]
    number = np.array([u.isdigit() for u in folded], bool)[code]
    after = np.zeros(len(keep), bool)
    after[1:] = number[:-1] & (row[1:] == row[:-1])
    unit = np.array([u in UNITS for u in folded], bool)[code] & after & ~number
    n = np.bincount(row, minlength=len(texts))
    mixed = (np.bincount(row, weights=upper, minlength=len(texts)) <= MOST_CAPITALS * n)[row]
    plain = np.where(number, NUMBER, np.where(unit, UNIT, WORD)).astype(np.int8)
    named = lambda may: np.where((plain == WORD) & may & mixed, NAME, plain).astype(np.int8)
    kinds = {"plain": plain, "numbers": plain, "inside": named(upper & ~begins & ~shouted), "anywhere": named(upper)}
    first = np.cumsum(n) - n
    return Words(row, code, folded, kinds, np.arange(len(row)) - first[row] if len(row) else np.zeros(0, np.int64))


@dataclass
class Template:
    """A batch of texts in one variant: per unit its hash, kind, row, first word and the word after its last."""

    id: np.ndarray
    kind: np.ndarray
    row: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def template(words: Words, variant: str) -> Template:
    """Units of the texts: a word, or a slot; outside the plain variant a run of one kind of slot is one slot."""
    kind, n = words.kinds[variant], len(words.row)
    fresh = np.ones(n, bool)
    if variant != "plain" and n:
        fresh[1:] = (kind[1:] == WORD) | (kind[1:] != kind[:-1]) | (words.row[1:] != words.row[:-1])
    begin = np.flatnonzero(fresh)
    own, slots = _hashes(words.unique), _hashes(list(PLACEHOLDERS))
    k = kind[begin]
    ids = np.where(k == WORD, own[words.code[begin]], slots[k]) if n else np.zeros(0, np.uint64)
    return Template(ids, k, words.row[begin], begin, np.r_[begin[1:], n].astype(np.int64) if n else begin)


def rolling(ids: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(n, hash of the n ids from each place) for every length: differences of one running sum, brought to a common power."""
    with np.errstate(over="ignore"):
        power = np.full(len(ids), _BASE)
        power[:1] = 1
        power = np.cumprod(power, dtype=np.uint64)
        back = np.full(len(ids), np.uint64(pow(int(_BASE), -1, 1 << 64)))
        back[:1] = 1
        back = np.cumprod(back, dtype=np.uint64)
        sums = np.r_[np.uint64(0), np.cumsum(ids * power, dtype=np.uint64)]
        for n in lengths:
            if 0 < n <= len(ids):
                h = (sums[n:] - sums[:-n]) * back[: len(ids) - n + 1] + np.uint64(n)
                h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                yield n, h ^ (h >> np.uint64(29))


def _slot_values(words: Words, t: Template, at: int, n: int) -> tuple[str, list[str]]:
    """(skeleton, slot values) of the window of n units from unit ``at``."""
    kinds, first, last = t.kind[at : at + n].tolist(), t.begin[at : at + n].tolist(), t.end[at + n - 1]
    held = [words.unique[c] for c in words.code[first[0] : last].tolist()]
    ends = [*(x - first[0] for x in first[1:]), len(held)]
    skeleton, slots, a = [], [], 0
    for kind, b in zip(kinds, ends, strict=True):
        if kind == WORD:
            skeleton.append(held[a])
        else:
            skeleton.append(PLACEHOLDERS[kind])
            slots.append(f"{kind} {' '.join(held[a:b])}")
        a = b
    return " ".join(skeleton), slots


def _usable(t: Template, variant: str, n: int) -> np.ndarray:
    """Windows of n units that stay in one text; reworded ones have a slot and are words by half, by two at least."""
    ok = t.row[: len(t.row) - n + 1] == t.row[n - 1 :]
    if variant != "plain":
        own = np.r_[0, np.cumsum(t.kind == WORD)]
        own = own[n:] - own[:-n]
        ok &= (own < n) & (own >= max(2, n / 2))
    return ok


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_size(batches, 1):
        words = read(batch.column(1).to_pylist())
        ids, rows = batch.column(0).to_pylist(), []
        for variant in VARIANTS:
            t = template(words, variant)
            size = np.bincount(t.row, minlength=len(ids))
            for n, h in rolling(t.id, sorted({min(WINDOW, int(s)) for s in size if s})):
                use = _usable(t, variant, n) & (np.minimum(size, WINDOW)[t.row[: len(h)]] == n)
                for at in np.flatnonzero(use).tolist():
                    rows.append((ids[t.row[at]], variant, n, int(h[at].astype(np.int64)), *_slot_values(words, t, at, n), int(words.place[t.begin[at]])))
        if rows:
            columns = [list(x) for x in zip(*rows, strict=True)]
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.int64()]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, kinds)), ["item_id", "variant", "n", "hash", "skeleton", "theirs", "start"])


def _passes(h: np.ndarray, sieve: np.ndarray, bits: int) -> np.ndarray:
    """Where hashes have both of their bits in the sieve; the second is only looked for where the first is there."""
    mask, found = np.uint64(bits - 1), np.arange(len(h))
    for shift in (3, 34):
        at = ((h[found] if shift > 3 else h) >> np.uint64(shift)) & mask
        found = found[(sieve[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return found


def _pages(batches: Iterator[pa.RecordBatch], bits: int, page: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Parts (page number, bytes) of the sieve that a task's hashes set."""
    held: dict[int, np.ndarray] = {}
    for b in batches:
        h = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        for shift in (3, 34):
            at = ((h >> np.uint64(shift)) & np.uint64(bits - 1)).astype(np.int64)
            for p in np.unique(at >> 19).tolist():
                own = at[(at >> 19) == p] & ((1 << 19) - 1)
                np.bitwise_or.at(held.setdefault(p, np.zeros(page, np.uint8)), own >> 3, (1 << (own & 7)).astype(np.uint8))
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["page", "bits"])


def _sieve(windows: DataFrame, bits: int) -> np.ndarray:
    """A bit field that holds two bits of every window's hash; its size is bounded, whatever the number of windows."""
    parts = windows.select("hash").mapInArrow(lambda b: _pages(b, bits), "page bigint, bits binary")
    field = np.zeros(bits >> 3, np.uint8)
    for r in parts.toLocalIterator():
        at = r.page << 16
        field[at : at + (1 << 16)] |= np.frombuffer(r.bits, np.uint8)[: len(field) - at]
    return field


def _candidates(batches: Iterator[pa.RecordBatch], sieve: np.ndarray, bits: int, lengths: dict[str, list[int]]) -> Iterator[pa.RecordBatch]:
    for batch in by_size(batches, 1):
        words = read(batch.column(1).to_pylist())
        found: dict[tuple, None] = {}
        for variant, wanted in lengths.items():
            t = template(words, variant)
            for n, h in rolling(t.id, wanted):
                at = _passes(h, sieve, bits)
                at = at[_usable(t, variant, n)[at]] if len(at) else at
                for p in at.tolist():
                    skeleton, slots = _slot_values(words, t, p, n)
                    found[int(t.row[p]), variant == "plain", int(h[p].astype(np.int64)), skeleton, tuple(slots)] = None
        if found:
            row, plain, h, skeleton, slots = (list(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(plain), pa.array(h, pa.int64()), pa.array(skeleton), pa.array(list(map(list, slots)), pa.list_(pa.string()))],
                ["doc_id", "plain", "hash", "skeleton", "mine"],
            )


def leaks(corpus: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """(doc_id, item_id, verbatim, reworded): how many windows of each item stand in each document.

    Items and documents become templates with numbers, names and units as typed placeholders; windows of 12 words (all words
    of a shorter item) are joined by hash with those of the items, and the values in the slots then tell whether a window
    stands there verbatim, or reworded: other values, one for each value of the item. Verbatim windows are read word by word
    with numbers and units as slots, whatever the letter case. Reworded ones are of 12 units, where a run of numbers, of
    capitalised words or of units is one slot of any length; a unit is one only right after a number. They need a slot, and
    words for half of their units. Each text is read by itself, so an item's findings don't depend on the other items.

    The corpus is read once, whatever the number of items: documents' windows pass a sieve of bounded size and are then
    joined with the items' windows; only these go to all tasks, and only if they are few. Letter case, encoding of accents,
    punctuation, spaces and line breaks don't matter. Null texts and ids and texts without words match nothing; an item given
    twice matches once. Only pairs with a match come out.
    """
    clean = items.select(F.col(item).cast("bigint").alias("i"), F.col(text).alias("t")).where("i IS NOT NULL AND t IS NOT NULL").distinct()
    made = "item_id bigint, variant string, n int, hash bigint, skeleton string, theirs array<string>, start bigint"
    windows = cut(clean.mapInArrow(_item_windows, made))
    size = windows.count()
    bits = min(SIEVE_MOST, max(SIEVE_LEAST, 1 << (size * SIEVE_BITS).bit_length()))
    lengths: dict[str, list[int]] = {v: [] for v in VARIANTS}
    for r in windows.select("variant", "n").distinct().collect():  # at most 12 for each of four variants
        lengths[r.variant].append(r.n)
    sent = corpus.sparkSession.sparkContext.broadcast(_sieve(windows, bits))
    docs = corpus.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("_t")).where("doc_id IS NOT NULL AND _t IS NOT NULL")
    schema = "doc_id bigint, plain boolean, hash bigint, skeleton string, mine array<string>"
    candidates = spread(docs, "doc_id").mapInArrow(lambda b: _candidates(b, sent.value, bits, lengths), schema)
    known = windows.select("item_id", "start", "hash", "skeleton", "theirs", (F.col("variant") == "plain").alias("plain")).distinct()
    if size <= BROADCAST_WINDOWS:
        known = F.broadcast(known)
    pairs = F.size(F.array_distinct(F.arrays_zip("mine", "theirs")))
    one_to_one = (pairs == F.size(F.array_distinct("mine"))) & (pairs == F.size(F.array_distinct("theirs")))
    equal = F.col("mine") == F.col("theirs")
    matched = candidates.join(known, ["hash", "plain", "skeleton"]).where(F.when(F.col("plain"), equal).otherwise(~equal & one_to_one))
    starts = matched.groupBy("doc_id", "item_id", "start").agg(F.max("plain").cast("long").alias("v"))
    return starts.groupBy("doc_id", "item_id").agg(F.sum("v").alias("verbatim"), F.sum(1 - F.col("v")).alias("reworded"))
