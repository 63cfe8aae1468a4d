"""Problem 4: missing or wrong language labels and stretches in another language."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom.functions.languages import language_code
from voxloom.llm.batches import by_size
from voxloom.llm.sequence import viterbi

#: Families of closely related languages; a language that stands in none is a family of its own.
FAMILIES = {
    "romance": ("es", "fr", "pt", "it", "ca", "gl", "ro"), "germanic": ("de", "en", "nl", "sv", "no", "da", "af", "is"), "niger-congo": ("ak", "sw", "yo", "ig", "zu", "xh", "wo"),
    "slavic": ("ru", "uk", "be", "bg", "pl", "cs", "sk", "hr", "sr", "sl"), "indo-aryan": ("hi", "ur", "bn", "pa", "mr", "ne"), "semitic": ("ar", "he", "am"), "uralic": ("fi", "et", "hu"), "turkic": ("tr", "az", "kk", "uz"),
}
#: Labelled texts that the classifiers are fitted on, about, in equal parts for each language that has so many.
SAMPLE_ROWS = 20_000
#: A language is fitted if so many of its labelled texts agree with their label, and that share of them; most labelled ones first.
LEAST_TEXTS, LEAST_SHARE, MOST_LANGUAGES = 20, 0.3, 200
#: Words on end that make a stretch in another language.
STRETCH = 4
#: The language of a text whose words are known from fitting in a smaller share than KNOWN; labels are never wrong for it.
UNDETERMINED, KNOWN = "und", 0.4

_BITS = 17
_MARKED = r"[^\W_](?:[^\W_]|[\u0300-\u036f])*"
_WORD = re.compile(_MARKED)
_TOKEN = re.compile(rf"\x1e|{_MARKED}")
_END = "\x1e"
_SWITCH = -3.0
_FLOOR = -6.0


def fold(text: str) -> str:
    """Text in which words compare: accents composed, letter case folded."""
    return unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).casefold())


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(indices, owner) of hashed features: the word, its pieces of two to four letters with its edges."""
    idx, owner = [], []
    for i, w in enumerate(words):
        edged = f"<{w}>"
        grams = {edged, *(edged[j : j + n] for n in (2, 3, 4) for j in range(len(edged) - n + 1))}
        idx.extend(grams)
        owner.extend([i] * len(grams))
    codes, names = pd.factorize(np.array(idx, dtype=object))
    hashed = (pd.util.hash_array(names.astype(object)) >> np.uint64(64 - _BITS)).astype(np.int64) if len(names) else np.zeros(0, np.int64)
    return hashed[codes], np.array(owner, np.int64)


def _svm(idx: np.ndarray, owner: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 60, decay: float = 1e-3) -> np.ndarray:
    """A linear support vector machine (squared hinge, last weight: bias), by accelerated gradient steps scaled per feature."""
    n, dim = len(y), 1 << _BITS
    seen = np.unique(idx)
    local = np.searchsorted(seen, idx)
    scale = np.zeros(len(seen))
    np.add.at(scale, local, weight[owner])
    per = np.bincount(owner, minlength=n).max(initial=1)
    w, v, bias, vb = np.zeros(len(seen)), np.zeros(len(seen)), 0.0, 0.0
    for t in range(steps):
        look = w + 0.9 * v
        lb = bias + 0.9 * vb
        slack = np.maximum(0, 1 - y * (np.bincount(owner, weights=look[local], minlength=n) + lb))
        g = -2 * weight * slack * y
        grad = np.bincount(local, weights=g[owner], minlength=len(seen)) + decay * weight.sum() * look / max(1, n)
        v = 0.9 * v - grad / (2 * per * scale + 1e-6) * 0.9
        vb = 0.9 * vb - 0.05 * g.sum() / (2 * weight.sum() + 1e-9)
        w, bias = w + v, bias + vb
    out = np.zeros(dim + 1)
    out[seen], out[dim] = w, bias
    return out


def families_of(langs: Sequence[str]) -> list[str]:
    """The family of every language."""
    known = {x: name for name, group in FAMILIES.items() for x in group}
    return [known.get(x, x) for x in langs]


@dataclass
class Identifier:
    """Fitted weights: one machine per family against the others, one per pair of languages within a family."""

    langs: tuple[str, ...]
    family: np.ndarray
    family_of: np.ndarray
    pairs: dict[tuple[int, int], np.ndarray]
    vocabulary: frozenset[str]

    def scores(self, words: list[str]) -> np.ndarray:
        """Log-probabilities (words x languages): family first, then the votes of the pairs within each family."""
        if not words or not self.langs:
            return np.zeros((len(words), len(self.langs)), np.float32)
        idx, owner = _features(words)
        dim = 1 << _BITS

        def margin(w: np.ndarray) -> np.ndarray:
            return np.bincount(owner, weights=w[idx], minlength=len(words)) + w[dim]

        fam = np.stack([margin(w) for w in self.family], 1) * 3
        fam = fam - np.log(np.exp(fam - fam.max(1, keepdims=True)).sum(1, keepdims=True)) - fam.max(1, keepdims=True)
        within = np.zeros((len(words), len(self.langs)))
        votes = np.zeros((len(words), len(self.langs)))
        for (a, b), w in self.pairs.items():
            m = np.clip(margin(w) * 3, -30, 30)
            p = 1 / (1 + np.exp(-m))
            votes[:, a] += np.log(np.maximum(p, 1e-9))
            votes[:, b] += np.log(np.maximum(1 - p, 1e-9))
        for f in range(len(self.family)):
            own = np.flatnonzero(self.family_of == f)
            v = votes[:, own] / max(1, len(own) - 1)
            within[:, own] = v - np.log(np.exp(v).sum(1, keepdims=True))
        out = np.maximum(fam[:, self.family_of] + within, _FLOOR)
        out -= out.max(1, keepdims=True)
        out[[w not in self.vocabulary for w in words]] *= 0.25
        out[[not _spoken(w) for w in words]] = 0
        return out.astype(np.float32)


def _spoken(word: str) -> bool:
    """Whether a word is of letters (and their marks) alone."""
    return word.isalpha() or "".join(c for c in word if not unicodedata.combining(c)).isalpha()


def fit(langs: Sequence[str], counts: dict[str, np.ndarray]) -> Identifier:
    """Machines fitted on how often each word occurs under each label; a word under several labels counts for each in part."""
    names = families_of(langs)
    order = list(dict.fromkeys(names))
    family_of = np.array([order.index(x) for x in names], np.int64)
    words = [w for w, c in counts.items() if _spoken(w) and c.sum() >= 2]
    n = np.array([counts[w] for w in words], float).reshape(len(words), len(langs))
    share = n / np.maximum(n.sum(0, keepdims=True), 1)  # a large language doesn't outweigh a small one
    share = share / np.maximum(share.sum(1, keepdims=True), 1e-12)
    strength = np.log1p(n.sum(1))
    idx, owner = _features(words)

    def machine(pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
        use = np.flatnonzero(pos + neg > 0.02)
        again = np.full(len(words), -1)
        again[use] = np.arange(len(use))
        keep = again[owner] >= 0
        i, o = idx[keep], again[owner[keep]]
        y = np.r_[np.ones(len(use)), -np.ones(len(use))]
        w = np.r_[pos[use] * strength[use], neg[use] * strength[use]]
        return _svm(np.r_[i, i], np.r_[o, o + len(use)], y, w)

    family = np.array([machine(share[:, family_of == f].sum(1), share[:, family_of != f].sum(1)) for f in range(len(order))])
    pairs = {(a, b): machine(share[:, a], share[:, b]) for a in range(len(langs)) for b in range(a + 1, len(langs)) if family_of[a] == family_of[b]}
    return Identifier(tuple(langs), family, family_of, pairs, frozenset(words))


def fit_on(texts: list[str], labels: list[str]) -> Identifier:
    """An identifier from labelled texts of which some are labelled wrongly or mixed.

    A first vote by word counts under the labels drops texts that speak against their label, and then languages with hardly a
    text that agrees: labels that are only ever wrong. Machines are fitted on the rest.
    """
    found = [[fold(w) for w in _WORD.findall(t)] for t in texts]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    codes, names = pd.factorize(np.array([w for ws in found for w in ws], dtype=object))
    row = np.repeat(np.arange(len(found)), lengths)
    langs = sorted(set(labels))
    while True:
        given = np.array([langs.index(x) if x in langs else -1 for x in labels], np.int64)

        def counted(use: np.ndarray, given=given, langs=langs) -> np.ndarray:
            flat = np.bincount(codes[use] * len(langs) + given[row[use]], minlength=len(names) * len(langs))
            return flat.reshape(len(names), len(langs)).astype(float)

        if not langs:
            return fit([], {})
        counts = counted(given[row] >= 0)
        share = (counts + 0.01) / (counts.sum(0) + 1)
        share = np.log(share / share.sum(1, keepdims=True))
        votes = np.stack([np.bincount(row, weights=share[codes, l], minlength=len(found)) for l in range(len(langs))], 1)
        agrees = (votes.argmax(1) == given) & (lengths > 0)
        good, all_ = (np.bincount(given[use & (given >= 0)], minlength=len(langs)) for use in (agrees, lengths >= 0))
        least = min(LEAST_TEXTS, all_.max())
        kept = [x for x, g, n in zip(langs, good, all_, strict=True) if g >= least and g >= LEAST_SHARE * n]
        if kept == langs:
            return fit(langs, dict(zip(names.tolist(), counted(agrees[row]), strict=True)))
        langs = kept


def fit_on_table(segments: DataFrame, text: str, lang: str, sample_rows: int = SAMPLE_ROWS) -> Identifier:
    """An identifier from about ``sample_rows`` labelled texts, taken by a hash of the text; ``fit_on`` on the driver.

    The languages are those of the labels. Each gets an equal part of the sample, and all its texts where these are fewer; a text
    counts once under each of its labels, however often it is repeated. Which are taken follows from the table alone.
    """
    labelled = segments.select(F.col(text).alias("t"), language_code(F.col(lang)).alias("l")).where(F.col("l").isNotNull() & (F.length("t") > 0))
    per = labelled.groupBy("l").agg(F.approx_count_distinct(F.xxhash64("t"), 0.02).alias("n")).where(F.col("n") >= LEAST_TEXTS / 2)
    sizes = per.orderBy(F.desc("n"), "l").limit(MOST_LANGUAGES).collect()
    if not sizes:
        return fit_on([], [])
    part = sample_rows / len(sizes)
    most = F.create_map(*[F.lit(x) for r in sizes for x in (r.l, int((1 << 30) * min(1.0, part / r.n)))])
    place = F.pmod(F.xxhash64("t"), F.lit(1 << 30))
    taken = labelled.where(place < F.coalesce(F.try_element_at(most, F.col("l")), F.lit(0))).distinct()
    rows = sorted((r.t, r.l) for r in taken.collect())
    return fit_on([t for t, _ in rows], [l for _, l in rows])


_SPANS = pa.list_(
    pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32()), ("start_char", pa.int32()), ("end_char", pa.int32()), ("confidence", pa.float64())])
)


def _identify(batches: Iterator[pa.RecordBatch], model: Identifier) -> Iterator[pa.RecordBatch]:
    langs = model.langs or (UNDETERMINED,)
    s = len(langs)
    trans = np.full((s, s), _SWITCH, np.float32)
    np.fill_diagonal(trans, 0)
    known: dict[str, int] = {}
    table = np.zeros((0, s), np.float32)
    for batch in by_size(batches, "__vx_text"):
        rest = [c for c in batch.schema.names if c != "__vx_text"]
        texts = [(x or "").replace(_END, " ") for x in batch.column("__vx_text").to_pylist()]
        codes, raw = pd.factorize(np.array(_TOKEN.findall(_END.join(texts) + _END), dtype=object))
        again, unique = pd.factorize(np.array([fold(u) for u in raw], dtype=object))
        codes = again[codes]
        new = [u for u in unique if u not in known]
        if len(known) > 500_000:
            known, table, new = {}, np.zeros((0, s), np.float32), list(unique)
        known.update((u, len(table) + i) for i, u in enumerate(new))
        table = np.concatenate([table, model.scores(new) if model.langs else np.zeros((len(new), s), np.float32)])
        at = np.array([known[u] for u in unique], np.int64)[codes]
        stop = codes == list(unique).index(_END)
        row_of = (np.cumsum(stop) - stop)[~stop]
        lengths = np.bincount(row_of, minlength=len(texts)).astype(np.int64)
        emit = table[at[~stop]]
        tags = viterbi(emit, lengths, trans)
        held = np.bincount(row_of * s + tags, minlength=len(texts) * s).reshape(-1, s)
        evidence = np.stack([np.bincount(row_of, weights=emit[:, i], minlength=len(texts)) for i in range(s)], 1).astype(float)
        # the main language holds most words; the summed evidence settles ties
        facts = np.array([(spoken_, spoken_ and u in model.vocabulary) for u in unique for spoken_ in (_spoken(u),)], bool).reshape(-1, 2)
        letters, familiar = facts[codes[~stop]].T
        spoken = np.bincount(row_of, weights=letters, minlength=len(texts))
        open_ = np.bincount(row_of, weights=familiar, minlength=len(texts)) < KNOWN * spoken
        order = held + 0.5 / (1 - (evidence - evidence.max(1, keepdims=True, initial=-np.inf)))
        main = order.argmax(1)
        shifted = np.exp(np.maximum(evidence - evidence.max(1, keepdims=True), -50))
        sure = held[np.arange(len(texts)), main] / np.maximum(lengths, 1) * shifted[np.arange(len(texts)), main] / shifted.sum(1)

        n = len(tags)
        spans: list[list[dict]] = [[] for _ in texts]
        if n:
            fresh = np.ones(n, bool)
            fresh[1:] = (row_of[1:] != row_of[:-1]) | (tags[1:] != tags[:-1])
            begin = np.flatnonzero(fresh)
            size = np.diff(np.r_[begin, n])
            first = np.cumsum(lengths) - lengths
            gap = -np.sort(emit, 1)[:, -2] if s > 1 else np.zeros(n)
            support = np.add.reduceat(gap, begin)
            other = (tags[begin] != main[row_of[begin]]) & (size >= STRETCH) & ~open_[row_of[begin]]
            places: tuple[int, list[tuple[int, int]]] = (-1, [])
            for i in np.flatnonzero(other).tolist():
                b, k, r = int(begin[i]), int(size[i]), int(row_of[begin[i]])
                if places[0] != r:
                    places = (r, [m.span() for m in _WORD.finditer(texts[r])])
                at = b - int(first[r])
                spans[r].append(
                    {"lang": langs[tags[b]], "first_word": at, "n_words": k, "start_char": places[1][at][0], "end_char": places[1][at + k - 1][1], "confidence": float(1 - np.exp(-support[i]))}
                )
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in rest),
                pa.array([None if not k else UNDETERMINED if o else langs[m] for m, k, o in zip(main, spoken, open_, strict=True)], pa.string()),
                pa.array([None if not k else 0.0 if o else float(x) for x, k, o in zip(sure, spoken, open_, strict=True)], pa.float64()),
                pa.array(spans, _SPANS),
            ],
            [*rest, "main_lang", "confidence", "stretches"],
        )


def identify(df: DataFrame, text: str, model: Identifier) -> DataFrame:
    """``df`` with main_lang, confidence and stretches (lang, first_word, n_words, start_char, end_char, confidence) of ``text``.

    Every word is scored by the hierarchy (family, then pairs within it) and Viterbi cuts the text into stretches of one
    language; the main language holds most words. A stretch in another language has at least four words on end; its
    offsets count characters of the text as it is. A text of whose words fewer than KNOWN were met in fitting is of no fitted
    language: it is "und", with confidence 0 and no stretches. Null texts and texts without a word in letters have null languages.
    Columns named like the three new ones are replaced.
    """
    given = df.drop("main_lang", "confidence", "stretches").withColumn("__vx_text", F.col(text))
    kept = [f for f in given.schema.fields if f.name != "__vx_text"]
    span = T.StructType().add("lang", "string").add("first_word", "integer").add("n_words", "integer").add("start_char", "integer").add("end_char", "integer").add("confidence", "double")
    new = T.StructType().add("main_lang", "string").add("confidence", "double").add("stretches", T.ArrayType(span))
    schema = T.StructType([*kept, *new.fields])
    shared = df.sparkSession.sparkContext.broadcast(model)
    return given.mapInArrow(lambda b: _identify(b, shared.value), schema)


def label_findings(df: DataFrame, record: str, lang: str) -> DataFrame:
    """(record, kind, lang) from an identified table: missing and wrong labels, and every other language of mixed texts.

    No label is wrong for a text of undetermined language; one that names a language that wasn't fitted is wrong for a text that
    is of a fitted one. A missing label of an undetermined text comes out as "und".
    """
    label = language_code(F.col(lang))
    kind = F.when(label.isNull(), "missing").when((label != F.col("main_lang")) & (F.col("main_lang") != UNDETERMINED), "wrong")
    found = F.concat(
        F.array(F.struct(kind.alias("kind"), F.col("main_lang").alias("lang"))),
        F.transform(F.array_distinct(F.col("stretches.lang")), lambda x: F.struct(F.lit("mixed").alias("kind"), x.alias("lang"))),
    )
    return (
        df.where(F.col("main_lang").isNotNull() & F.col(record).isNotNull())
        .select(record, F.explode(found).alias("_f"))
        .where(F.col("_f.kind").isNotNull())
        .select(record, "_f.*")
        .distinct()
    )


def span_findings(df: DataFrame, record: str, spans: str, least: float = 0.5) -> DataFrame:
    """(record, start_char, end_char, lang, kind) from an identified table with labelled spans (arrays of start and end).

    ``confirmed``: a stretch that a labelled span covers, by at least ``least`` of the two together; ``unlabelled``: any other
    stretch; ``unconfirmed``: a labelled span that meets no stretch so, with a null language. Spans that aren't two numbers in
    order are unconfirmed as they are.
    """
    given = F.coalesce(F.col(spans), F.array().cast("array<array<bigint>>"))
    pair = F.transform(given, lambda s: F.struct(F.try_element_at(s, F.lit(1)).alias("a"), F.try_element_at(s, F.lit(2)).alias("b")))

    def meets(s: Column, x: Column) -> Column:
        both = F.least(s["b"], x["end_char"]) - F.greatest(s["a"], x["start_char"])
        either = F.greatest(s["b"], x["end_char"]) - F.least(s["a"], x["start_char"])
        return F.coalesce((s["a"] < s["b"]) & (both >= least * either), F.lit(False))

    rows = df.select(record, "stretches", pair.alias("_given")).where(F.col(record).isNotNull())
    made = F.concat(
        F.transform(
            F.coalesce("stretches", F.array().cast(df.schema["stretches"].dataType)),
            lambda x: F.struct(
                x["start_char"].cast("bigint").alias("start_char"), x["end_char"].cast("bigint").alias("end_char"), x["lang"].alias("lang"),
                F.when(F.exists("_given", lambda s: meets(s, x)), "confirmed").otherwise("unlabelled").alias("kind"),
            ),
        ),
        F.transform(
            F.filter("_given", lambda s: ~F.exists("stretches", lambda x: meets(s, x))),
            lambda s: F.struct(s["a"].alias("start_char"), s["b"].alias("end_char"), F.lit(None).cast("string").alias("lang"), F.lit("unconfirmed").alias("kind")),
        ),
    )
    return rows.select(record, F.explode(made).alias("_f")).select(record, "_f.*").distinct()
