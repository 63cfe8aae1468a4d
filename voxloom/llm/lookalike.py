"""Problem 5: one consistent form for text that looks the same but differs in characters."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom.llm.batches import by_size
from voxloom.operators.lineage import cut, spread

# Parameters: letters of other scripts that look like a Latin or IPA letter, and the letter they look like.
CYRILLIC = (
    "аa еe оo рp сc уy хx іi јj ѕs һh ԁd ԛq ԝw ӏl әə ԑɛ ӡʒ ѵv ԍɡ "
    "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT ХX ҮY УY ԌG ԚQ ԜW ӀI Ѵv ԀD ҺH ӘƏ"
)
GREEK = "αɑ εɛ οo νv ιɩ γɣ υʋ ϲc ϳj κĸ ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϹC ͿJ"
OTHER = "օo ցɡ հh սu ոn աɯ ᴏo ᴠv ᴡw ᴢz ᴜu ᴄc ǝə ⅼl ⅰi ⅴv ⅹx ꞓɔ ℓl ıi"
# Parameters: keyboard stand-ins and near twins of IPA signs, and the sign they stand for.
STAND_INS = "gɡ 'ˈ ’ˈ ‘ˈ ʹˈ ′ˈ ʼˈ `ˈ ´ˈ ꞌˈ ,ˌ ‚ˌ ꓹˌ :ː ∶ː ꞉ː ⁚ː ?ʔ !ǃ |ǀ ∫ʃ"

_TOP = 0x110000
# Scripts of letters that are told apart by words where text isn't phonetic.
_LATIN, _OTHER, _TWIN = 1, 2, 4


def _pairs(text: str) -> list[tuple[str, str]]:
    return [(p[0], p[1]) for p in text.split() if len(p) == 2]


def _same_look(ch: str) -> str:
    """What a character that only stands for others decomposes to, if it looks just like them; else the character.

    Full and half widths, small forms, ligatures and digraphs, Roman numerals, runs of dots and hyphens that don't break. Raised and
    lowered forms, fractions and letters of another shape are left alone.
    """
    tag, *codes = unicodedata.decomposition(ch).split() or [""]
    if not tag.startswith("<"):
        return ch
    out = "".join(chr(int(c, 16)) for c in codes)
    if tag in ("<wide>", "<narrow>", "<small>", "<noBreak>") and len(out) == 1:
        return out
    roman = 0x2160 <= ord(ch) <= 0x217F
    whole = all(c.isalpha() or c in ".!?" for c in out) and (len(out) > 1 or roman)
    return out if tag == "<compat>" and whole else ch


@dataclass(frozen=True)
class Tables:
    """Per code point: length and start of its expansion in ``values``, with and without twins; combining class; script bits."""

    length: np.ndarray
    start: np.ndarray
    values: np.ndarray
    twin: np.ndarray
    combining: np.ndarray
    script: np.ndarray
    pairs: np.ndarray
    composed: np.ndarray


@lru_cache(maxsize=2)
def tables(phonetic: bool = True) -> Tables:
    """Built from rules: format and control characters, soft hyphens and variation selectors vanish; every space becomes a plain
    one and every short hyphen the plain one; what only looks like other characters becomes those; accented letters are taken
    apart. ``twin`` then maps look-alike letters of other scripts and, for phonetic text, the keyboard's stand-ins to the sign
    they look like. ``pairs`` holds every letter and mark that have a composed form, in order, as letter << 21 | mark.
    """
    letters = [x for part in (CYRILLIC, GREEK, OTHER) for x in _pairs(part)]
    twin = np.arange(_TOP, dtype=np.uint32)
    for a, b in letters + (_pairs(STAND_INS) if phonetic else []):
        twin[ord(a)] = ord(b)
    length, start = np.ones(_TOP, np.int8), np.zeros(_TOP, np.int32)
    combining, script = np.zeros(_TOP, np.uint8), np.zeros(_TOP, np.uint8)
    values, pairs = [0], {}
    for cp in range(_TOP):
        if 0x3400 <= cp < 0xA000 or 0xD7FC <= cp < 0xF900 or cp >= 0x2FA20 and not 0xE0000 <= cp < 0xE0200:
            continue  # ideographs, surrogates, private use: they stay as they are
        ch = chr(cp)
        kind = unicodedata.category(ch)
        combining[cp] = unicodedata.combining(ch)
        unseen = cp in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0x180B <= cp <= 0x180F or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF
        if kind in ("Cf", "Cc") and ch not in "\t\n\r" or unseen:
            out = ""
        elif kind in ("Zs", "Zl", "Zp") or ch in "\t\n\r" or cp == 0x2800:
            out = " "
        elif cp in (0x2010, 0x2011, 0x2043, 0xFE63, 0xFF0D):
            out = "-"
        else:
            out = unicodedata.normalize("NFD", _same_look(ch))
            apart = unicodedata.normalize("NFD", ch)
            if len(apart) > 1 and unicodedata.normalize("NFC", apart) == ch and not 0xAC00 <= cp < 0xD7A4:
                base = unicodedata.normalize("NFC", apart[:-1])
                if len(base) == 1:
                    pairs[ord(base) << 21 | ord(apart[-1])] = cp
        if out != ch:
            length[cp], start[cp] = len(out), len(values)
            values.extend(map(ord, out))
        if kind[0] == "L":
            script[cp] = _LATIN if "LATIN" in unicodedata.name(ch, "") else _OTHER
    for a, b in letters:
        script[ord(a)] |= _TWIN
    keys = np.array(sorted(pairs), np.int64)
    return Tables(length, start, np.array(values, np.uint32), twin, combining, script, keys, np.array([pairs[k] for k in keys.tolist()], np.uint32))


def _runs(fresh: np.ndarray) -> np.ndarray:
    return np.cumsum(fresh) - 1 if len(fresh) else np.zeros(0, np.int64)


def _own_script(points: np.ndarray, row: np.ndarray, script: np.ndarray) -> np.ndarray:
    """Which code points stand in a word that is really written in another script, and so keep their letters.

    A word with a Latin letter is Latin, and so is one of look-alikes alone, unless the text has letters of another script
    that look like none.
    """
    bits = script[points]
    letter = (bits > 0) | (points < 128) & (((points | 32) >= 97) & ((points | 32) <= 122))
    joined = letter | np.isin(points, (0x27, 0x2019)) | ((points >= 0x300) & (points < 0x370))
    fresh = np.ones(len(points), bool)
    fresh[1:] = (joined[1:] != joined[:-1]) | (row[1:] != row[:-1])
    word = _runs(fresh)
    latin = np.bincount(word, weights=(bits & _LATIN) > 0) > 0
    genuine = ((bits & _OTHER) > 0) & ((bits & _TWIN) == 0)
    in_text = np.bincount(row, weights=genuine) > 0
    return ~latin[word] & in_text[row]


def _compose(out: np.ndarray, row: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """(code points, rows) with marks composed onto their letters wherever a composed letter exists, as in NFC.

    Marks must be in canonical order. All letters take their first mark, then their second, and so on; a mark that can't be
    joined stays and stands in the way of later ones of its class. Hangul parts are joined by their arithmetic.
    """
    marks = t.combining[out]
    fresh = np.ones(len(out), bool)
    fresh[1:] = (marks[1:] == 0) | (row[1:] != row[:-1])
    begin = np.flatnonzero(fresh)
    size = np.diff(np.r_[begin, len(out)])
    out, gone, held = out.copy(), np.zeros(len(out), bool), np.zeros(len(begin), np.uint8)
    active = np.flatnonzero((size > 1) & (marks[begin] == 0))
    k = 1
    while len(active):
        at = begin[active] + k
        found, new = _joined(out[begin[active]], out[at], t)
        found &= held[active] < marks[at]
        out[begin[active][found]] = new[found]
        gone[at[found]] = True
        held[active[~found]] = marks[at[~found]]
        k += 1
        active = active[size[active] > k]
    out, row = out[~gone], row[~gone]
    while len(out) > 1:  # a letter that joins the one right before it: Hangul, and vowel signs of a few scripts
        found, new = _joined(out[:-1], out[1:], t)
        found &= (row[1:] == row[:-1]) & (t.combining[out[1:]] == 0) & (t.combining[out[:-1]] == 0)
        found[1:] &= ~found[:-1]
        if not found.any():
            break
        out[np.flatnonzero(found)] = new[found]
        stay = np.r_[True, ~found]
        out, row = out[stay], row[stay]
    return out, row


def _joined(first: np.ndarray, second: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """(whether two code points have a composed form, that form)."""
    key = first.astype(np.int64) << 21 | second.astype(np.int64)
    at = np.minimum(np.searchsorted(t.pairs, key), len(t.pairs) - 1)
    found, new = t.pairs[at] == key, t.composed[at].copy()
    a, b = first.astype(np.int64), second.astype(np.int64)
    lead = (a >= 0x1100) & (a < 0x1113) & (b >= 0x1161) & (b < 0x1176)
    tail = (a >= 0xAC00) & (a < 0xD7A4) & ((a - 0xAC00) % 28 == 0) & (b > 0x11A7) & (b < 0x11C3)
    new = np.where(lead, 0xAC00 + ((a - 0x1100) * 21 + b - 0x1161) * 28, np.where(tail, a + b - 0x11A7, new)).astype(np.uint32)
    return found | lead | tail, new


def canonical(texts: pa.Array | Sequence[str | None], phonetic: bool = True) -> pa.Array:
    """The consistent form of every text, as an Arrow array: one pass over an array of code points for the whole batch.

    The Arrow buffer becomes code points at once. Lookup tables give each one's expansion, gathers with offsets write them
    out, look-alike letters become the letter they look like (where text isn't ``phonetic``, only in words that aren't really
    written in that script), runs of marks are brought into canonical order by one stable sort, and marks are composed onto
    their letters; no text is handled by itself. Null stays null, and a text of unseen characters alone becomes empty. Spaces
    at the ends are dropped.
    """
    t = tables(phonetic)
    given = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.large_string())
    n = len(given)
    offsets = np.frombuffer(given.buffers()[1], np.int64)[given.offset : given.offset + n + 1] if n else np.zeros(1, np.int64)
    data = given.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]] if n and given.buffers()[2] is not None else b""
    heads = np.r_[0, np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)]
    sizes = np.diff(heads[offsets - offsets[0]])
    points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(n), sizes)
    more = t.length[points].astype(np.int64)
    ends = np.cumsum(more)
    source = np.repeat(np.arange(len(points)), more)
    within = np.arange(len(source)) - np.repeat(ends - more, more)
    from_table = t.start[points][source]
    out = np.where(from_table > 0, t.values[from_table + within * (from_table > 0)], points[source]).astype(np.uint32)
    row = row[source]
    out = t.twin[out] if phonetic else np.where(_own_script(out, row, t.script), out, t.twin[out]) if len(out) else out
    marks = t.combining[out]
    if (marks > 0).any() or (out >= 0x1100).any():
        fresh = np.ones(len(out), bool)
        fresh[1:] = (marks[1:] == 0) | (row[1:] != row[:-1])
        out, row = _compose(out[np.lexsort((marks, _runs(fresh)))], row, t)
    solid = np.flatnonzero(out != 0x20)
    first, last = np.full(n, len(out)), np.full(n, -1)
    np.minimum.at(first, row[solid], solid)
    np.maximum.at(last, row[solid], solid)
    at = np.arange(len(out))
    keep = (at >= first[row]) & (at <= last[row])
    out, row = out[keep], row[keep]
    wide = 1 + (out >= 0x80).astype(np.int64) + (out >= 0x800) + (out >= 0x10000)
    upto = np.r_[0, np.cumsum(np.bincount(row, weights=wide, minlength=n))].astype(np.int64)
    made = out.astype("<u4").tobytes().decode("utf-32-le").encode()
    null = given.buffers()[0] if given.null_count else None
    if null is not None and given.offset:
        null = pa.array(given.is_valid()).buffers()[1]
    return pa.Array.from_buffers(pa.large_string(), n, [null, pa.py_buffer(upto.tobytes()), pa.py_buffer(made)]).cast(pa.string())


def _canonical_batches(batches: Iterator[pa.RecordBatch], phonetic: bool) -> Iterator[pa.RecordBatch]:
    for batch in by_size(batches, "__vx_text"):
        text = batch.column("__vx_text")
        yield pa.RecordBatch.from_arrays([*batch.columns, canonical(text, phonetic)], [*batch.schema.names, "__vx_form"])


def with_canonical(df: DataFrame, text: str, out: str, phonetic: bool = True) -> DataFrame:
    """``df`` with the consistent form of ``text`` in ``out``. Null stays null; all other columns pass through."""
    given = df.withColumn("__vx_text", F.col(text)).select(*df.columns, "__vx_text")
    schema = T.StructType([*given.schema.fields, T.StructField("__vx_form", T.StringType())])
    done = given.mapInArrow(lambda b: _canonical_batches(b, phonetic), schema)
    return done.withColumn(out, F.col("__vx_form")).drop("__vx_text", "__vx_form")


#: Classes that are sent to all tasks to find their records; more are joined by a shuffle.
BROADCAST_CLASSES = 500_000


def _mixed(df: DataFrame, record: str, text: str, within: Sequence[Column], phonetic: bool) -> tuple[DataFrame, list[str]]:
    """Records (_id, _raw, _look, the keys) whose consistent form has several spellings within their keys.

    Forms are made once and written with a 64-bit hash of keys and form and one of the spelling. Hashes of which there are two
    spellings are found by one aggregate over these two numbers, and only records with such a hash go on, with the real texts.
    """
    keys = [f"_k{i}" for i in range(len(within))]
    rows = df.select(F.col(record).alias("_id"), F.col(text).alias("_raw"), *[c.alias(k) for c, k in zip(within, keys, strict=True)]).dropna()
    forms = with_canonical(spread(rows, "_id"), "_raw", "_look", phonetic)
    forms = cut(forms.withColumn("_group", F.xxhash64(*keys, "_look")).withColumn("_spelled", F.xxhash64("_raw")))
    several = cut(forms.groupBy("_group").agg(F.min("_spelled").alias("_a"), F.max("_spelled").alias("_b")).where("_a <> _b").select("_group"))
    few = F.broadcast(several) if several.count() <= BROADCAST_CLASSES else several
    return forms.join(few, "_group", "left_semi").select("_id", "_raw", "_look", *keys).distinct(), keys


def lookalike_classes(df: DataFrame, record: str, text: str, within: Sequence[Column], phonetic: bool = True) -> DataFrame:
    """(record, class_id, spelling, look): records whose ``text`` looks like another spelling's, within equal ``within``.

    ``class_id`` is the smallest record of the class, ``spelling`` the text as it is, ``look`` the consistent form; a class has two
    spellings or more, and a record one row for each of its texts. Null texts, records and ``within`` are in no class.
    """
    mixed, keys = _mixed(df, record, text, within, phonetic)
    mixed = cut(mixed)
    heads = mixed.groupBy(*keys, "_look").agg(F.min("_id").alias("class_id"), F.count_distinct("_raw").alias("_n")).where("_n > 1")
    return mixed.join(heads, [*keys, "_look"]).select(F.col("_id").alias(record), "class_id", F.col("_raw").alias("spelling"), F.col("_look").alias("look"))


def lookalike_pairs(df: DataFrame, record: str, text: str, within: Sequence[Column], phonetic: bool = True) -> DataFrame:
    """(id_a, id_b), id_a < id_b: records whose ``text`` looks the same but differs in characters, within equal ``within``.

    Groups of exact copies aren't joined with themselves: first each class's distinct spellings are paired, which are few, and
    then the pairs of spellings are filled with their records. Whoever needs no pairs takes ``lookalike_classes``.
    Null texts, records and ``within`` pair with nothing; repeated rows count once; of a record with several texts each counts.
    """
    mixed, keys = _mixed(df, record, text, within, phonetic)
    mixed = cut(mixed)
    spelled = mixed.select(*keys, "_look", "_raw").distinct()
    two = spelled.join(spelled.withColumnRenamed("_raw", "_other"), [*keys, "_look"]).where("_raw < _other")
    left = mixed.join(two, [*keys, "_look", "_raw"]).withColumnRenamed("_id", "_left").drop("_raw")
    right = mixed.withColumnRenamed("_raw", "_other")
    return (
        left.join(right, [*keys, "_look", "_other"])
        .where("_left <> _id")
        .select(F.least("_left", "_id").alias("id_a"), F.greatest("_left", "_id").alias("id_b"))
        .distinct()
    )
