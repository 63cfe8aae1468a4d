"""Problem 3: raw transcripts into clean, ordered speaker turns."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions.readings import SPEAKER_WORDS, milliseconds, speaker_key
from voxloom.llm.batches import by_size
from voxloom.llm.sequence import train, viterbi
from voxloom.operators.lineage import spread
from voxloom.operators.runs import merge_runs

#: Hesitation sounds of each language as patterns; none matches a word of that language.
FILLERS = {
    "ak": r"m{2,}|h+m+|e+h+|ɛ+h+",
    "de": r"ä+h+m*|ö+h+m*|h+m+|m{2,}|e+h+m+",
    "en": r"u+h+m*|u+m+|e+r+m*|e+h+m*|h+m+|m{2,}|a+h+m+",
    "es": r"e+h+m*|m{2,}|h+m+|e+m{2,}",
    "fr": r"e+u+h+m*|h+e+u+|h+u+m+|h+m+|m{2,}|e+h+m+",
    "pt": r"a+h+n+|a+h+m+|h+ã+|h+m+|h+u+m+|m{2,}|e+h+m*",
    "sw": r"m{2,}|h+m+|e+h+",
}
LANGS = tuple(FILLERS)
_FILLER = [re.compile(rf"(?:{p})(?:-(?:{p}))*") for p in FILLERS.values()]

# A label is an id or a name; each has words and an end, so that a name can't end in an id.
SPEECH, FILLER, ANNOTATION, TIMESTAMP, ID_WORD, ID_END, NAME_WORD, NAME_END = range(8)
N_TAGS = 8
#: Made-up transcripts that the tagger is trained on.
TRAINED_ON = 1500

_END = "\x00"  # between the transcripts of a batch
_TOKEN = re.compile(
    r"\x00|\(\([^()\x00]*\)\)|\[[^\[\]\x00]*\]|\([^()\x00]*\)|\{[^{}\x00]*\}|<[^<>\x00]*>|\*[^*\x00]+\*|♪[^♪\x00]*♪|[^\s\x00\[\](){}<>*♪]+|[\[\](){}<>*♪]"
)
_OPEN = "[({<*♪"
_EDGES = ".,;!?-…–—\"'«»“”¿¡"
_RUN = re.compile(r"[^\W_]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_SHAPES = ((re.compile(r"\d+"), "9"), (re.compile(r"\s+"), " "), (re.compile(r"(a)a{3,}"), r"\1+"), (re.compile(r"(A)A{3,}"), r"\1+"))
HESITATES = "hesitates"


def shape(text: str) -> str:
    """What a token looks like: capitals as A, other letters as a, up to three of each, digits as one 9, the rest as it is."""
    out = "".join("A" if c.isupper() else "a" if c.isalpha() else c for c in text)
    for pattern, by in _SHAPES:
        out = pattern.sub(by, out)
    return out


class _Looks(dict):
    """What a code point looks like, found once for each: A for capitals, a for other letters, 9 for digits, else itself."""

    def __missing__(self, cp: int) -> str:
        c = chr(cp)
        self[cp] = look = "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c
        return look


_LOOKS = _Looks()


def signature(token: str) -> tuple[str, bool, bool]:
    """All that a token's features depend on: its look, and whether it begins with a word for a speaker or with a lone v."""
    word = _LETTERS.search(token)
    return token.translate(_LOOKS), word is not None and word.group().casefold() in SPEAKER_WORDS, word is not None and word.group() == "v"


def _coded(stem: str, letters: list[str]) -> bool:
    """Whether two or three letters and a number end a token, with nothing but a general word for a speaker in front."""
    return stem[-1:].isdigit() and 0 < len(letters) < 3 and len(letters[-1]) in (2, 3) and (len(letters) == 1 or letters[0].casefold() in SPEAKER_WORDS)


def features(token: str) -> list[str]:
    """Features of a token: its brackets, shape, colon, letter case, lengths, and whether it is a general word for a speaker."""
    bracket = token[0] if len(token) > 1 and token[0] in _OPEN else ""
    core = token.strip("[](){}<>*♪ \t\n") if bracket else token.strip(_EDGES)
    runs, form = _RUN.findall(core), shape(core)
    stem = core.rstrip(": ")
    capital = sum(r[0].isupper() for r in runs)
    short = _LETTERS.findall(stem)
    out = [
        "one", f"bracket {bracket}", f"shape {bracket}{form}", f"ends {bracket}{form[-2:]}", f"begins {bracket}{form[:2]}",
        f"colon {bracket} {core.endswith(':')}", f"runs {bracket} {min(len(runs), 4)}", f"capitals {bracket} {len(runs) > 0 and capital == len(runs)} {min(len(runs), 4)}",
        f"letters {bracket} {any(map(str.isalpha, stem))} {any(map(str.isdigit, stem))}", f"upper {bracket} {len(stem) > 1 and stem.isupper()} {core.endswith(':')}",
        f"digits {bracket} {stem.isdigit()} {core.endswith(':')}", f"length {bracket} {min(len(stem), 4)}",
        f"voice {bracket} {len(runs) > 1 and runs[0] == 'v'}", f"speaker {bracket} {short[0].casefold() in SPEAKER_WORDS if short else False} {core.endswith(':')} {stem[-1:].isdigit()}",
        f"code {bracket} {_coded(stem, short)} {core.endswith(':')}",
        f"stop {token[-1] if token[-1] in _EDGES else ''}",
    ]
    return out


def hesitation_bits(token: str) -> int:
    """Bits of the languages that hesitate with a token."""
    low = token.strip(_EDGES).casefold()
    return sum(1 << i for i, p in enumerate(_FILLER) if p.fullmatch(low)) if len(low) > 1 else 0


def made_up(n: int, seed: int) -> list[list[tuple[str, int]]]:
    """Transcripts as (token, tag), put together at random from made-up words, names, labels, times and remarks of many forms."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    sounds = "a e i o u é ã ɛ ö".split(), "b d f g k l m n p r s t w y ch sh".split()
    syllable = lambda: pick(sounds[1]) + pick(sounds[0])
    word = lambda: (pick(["a", "le", "in", "die", "no", "na"]) if rng.random() < 0.25 else "".join(syllable() for _ in range(rng.integers(1, 5))) + pick(["", "", "n", "s", "r"]))
    name = lambda: word().capitalize()
    digits = lambda k: "".join(str(rng.integers(10)) for _ in range(k))
    code = lambda: "".join(pick("abcdefghijklmnoprstuvwz") for _ in range(rng.choice([2, 2, 2, 3])))

    def moment() -> str:
        r = rng.integers(5)
        if r == 0:
            return f"{rng.integers(0, 100)}:{digits(2)}"
        if r == 1:
            return f"{digits(2)}:{digits(2)}:{digits(2)}"
        if r == 2:
            return f"{digits(2)}:{digits(2)}:{digits(2)}{pick(',.')}{digits(3)}"
        return f"{rng.integers(0, 4000)}{pick(['', '.' + digits(1), '.' + digits(2)])}{pick(['s', 's', ' s', 'ms', 'sec']) if r == 3 else 's'}"

    def cased(text: str, how: float) -> str:
        return text.upper() if how < 0.2 else text.title() if how < 0.35 else text

    def speaker() -> str:
        r = rng.random()
        sep = pick(["-", "_", "", " ", " ", " ", ".", "#"])
        known = f"{code()}{sep}{pick(['', '0', '000'])}{rng.integers(1, 400)}"
        if r < 0.5:
            return cased(known, rng.random())
        general = pick(SPEAKER_WORDS)
        return cased(f"{general}{pick(['-', '_', ' ', ': ', '.'])}{known}" if r < 0.75 else f"{general}{pick(['-', '_', ' ', ''])}{rng.integers(1, 99)}", rng.random())

    def named(most: int = 2) -> str:
        both = " ".join(name() for _ in range(rng.integers(2, most + 1)))
        return both.upper() if rng.random() < 0.25 else both

    made = []
    for _ in range(n):
        loud = rng.random() < 0.1
        seq: list[tuple[str, int]] = []

        def put(text: str, tag: int, last: int | None = None, seq=seq) -> None:
            tokens = _TOKEN.findall(text)
            seq.extend((t, tag) for t in tokens[:-1])
            if tokens:
                seq.append((tokens[-1], tag if last is None else last))

        def bracketed(text: str) -> str:
            a, b = pick(["[]", "()", "{}", "<>", "**", "[]", "()"])
            return a + text + b

        def label(put=put) -> None:
            r = rng.random()
            if r < 0.2:
                put(pick(["[{}]", "({})", "[{}:]", "<{}>"]).format(speaker().replace(": ", " ")), ID_END)
            elif r < 0.35:
                put(pick(["[{}]", "({})", "[{}:]"]).format(named(3)), NAME_END)
            elif r < 0.5:
                put(f"<v{pick(['', '', '.loud'])} {pick([speaker, named])()}>", ID_END)
            elif rng.random() < 0.5:
                put(speaker() + ":", ID_WORD, ID_END)
            else:
                put(named() + ":", NAME_WORD, NAME_END)

        def speech(k: int, loud=loud, seq=seq, put=put) -> None:
            for _ in range(k):
                r = rng.random()
                ending = pick(["", "", "", "", ",", ".", "!", "?", "..."])
                if r < 0.07:
                    seq.extend([(HESITATES, FILLER)] * pick([1, 1, 1, 2, 3]))
                elif r < 0.11:
                    inner = pick([word(), word(), f"{word()} {word()}", f"{word()} {word()} {word()}", f"{word()} {rng.integers(1, 30)}", f"{word()}-{word()}", "", "?"])
                    put(f"♪ {word()} ♪" if rng.random() < 0.1 else bracketed(cased(inner, rng.random() * 3)), ANNOTATION)
                elif r < 0.15:
                    at = moment() if rng.random() < 0.8 else f"{moment()} --> {moment()}"
                    put(bracketed(at).replace("*", "") if rng.random() < 0.6 else at.replace(" s", "s"), TIMESTAMP)
                elif r < 0.18:
                    put(pick(["-", "...", "–", "—", "/", "&", "-->", "♪", ")", "["]), SPEECH)
                elif r < 0.22:
                    put(str(rng.integers(1, 2000)) + ending, SPEECH)
                elif r < 0.235:
                    put(word().lower() + ":", SPEECH)
                elif r < 0.245 and seq and seq[-1][1] == SPEECH and seq[-1][0].isalpha() and seq[-1][0].islower() and len(seq[-1][0]) > 3:
                    put(f"{rng.integers(1, 400)}:", SPEECH)
                elif r < 0.255:
                    put(pick(SPEAKER_WORDS), SPEECH)
                elif r < 0.275:
                    put(cased(code(), rng.random() * 2), SPEECH)
                else:
                    text = word() if rng.random() < 0.75 else name()
                    put((text.upper() if loud else text) + ending, SPEECH)

        if rng.random() < 0.3:
            at = moment()
            put(bracketed(at).replace("*", "") if rng.random() < 0.5 else at.split(" ")[0], TIMESTAMP)
        for _ in range(int(rng.integers(1, 7))):
            if rng.random() < 0.7:
                label()
                if rng.random() < 0.2:
                    put(pick([moment(), f"[{moment()}]", f"({moment()})"]).replace(" ", ""), TIMESTAMP)
                    put(pick(["", "-"]), SPEECH)
            speech(int(rng.integers(0, 9)))
        if seq:
            made.append(seq)
    return made


@dataclass(frozen=True)
class Tagger:
    """Feature weights of the linear chain: ``names`` finds a feature's row in own, before and after."""

    names: dict[str, int]
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    trans: np.ndarray

    def scores(self, token: str) -> np.ndarray:
        """(own, before, after) tag scores of a token; features that training never met say nothing."""
        found = [HESITATES] if token == HESITATES else features(token)
        at = [self.names[f] for f in found if f in self.names]
        return np.stack([x[at].sum(0) for x in (self.own, self.before, self.after)])


#: Where the weights are kept that ``fitted`` makes; ``python -m voxloom.llm.turns`` makes them anew.
WEIGHTS = Path(__file__).with_name("turns_weights.npz")


def fitted() -> Tagger:
    """The tagger, trained on TRAINED_ON made-up transcripts (fixed seed); a label can't break off or change its kind."""
    names: dict[str, int] = {}
    tokens: dict[str, int] = {}
    held, sequences = [], []
    for seq in made_up(TRAINED_ON, 3):
        for t, _ in seq:
            if t not in tokens:
                tokens[t] = len(held)
                found = [HESITATES] if t == HESITATES else features(t)
                held.append(np.array([names.setdefault(f, len(names)) for f in found], np.int64))
        sequences.append((np.array([tokens[t] for t, _ in seq]), np.array([g for _, g in seq], np.int8)))
    weights = train(sequences, held, len(names), N_TAGS, epochs=14)
    own, before, after, trans = (np.round(w, 3) for w in weights)
    for word, end in ((ID_WORD, ID_END), (NAME_WORD, NAME_END)):
        trans[word, [t for t in range(N_TAGS) if t not in (word, end)]] = -1e4
    return Tagger(names, own, before, after, trans)


def write_weights(tagger: Tagger) -> None:
    np.savez_compressed(WEIGHTS, names=np.array(list(tagger.names)), own=tagger.own, before=tagger.before, after=tagger.after, trans=tagger.trans)


@lru_cache(maxsize=1)
def model() -> Tagger:
    """The tagger with the weights that are kept."""
    with np.load(WEIGHTS) as kept:
        return Tagger({str(n): i for i, n in enumerate(kept["names"])}, kept["own"], kept["before"], kept["after"], kept["trans"])


def _pieces(batches: Iterator[pa.RecordBatch], tagger: Tagger, keep: list[str], with_text: bool) -> Iterator[pa.RecordBatch]:
    # Scores of signatures, of which there are far fewer than tokens; 0 is the edge of a transcript and 1 a hesitation.
    scores = [np.zeros((3, N_TAGS)), tagger.scores(HESITATES)]
    looks: dict[tuple, int] = {}
    known: dict[str, tuple[int, int, int]] = {_END: (0, 0, 0)}  # per token: its signature's place, hesitation bits, words
    for batch in by_size(batches, "_text"):
        texts = batch.column("_text").to_pylist()
        langs = np.array([LANGS.index(x) if x in FILLERS else -1 for x in batch.column("_lang").to_pylist()], np.int64)
        joined = unicodedata.normalize("NFC", _END.join((x or "").replace(_END, " ") for x in texts) + _END)
        tokens = np.array(_TOKEN.findall(joined), dtype=object)
        codes, unique = pd.factorize(tokens)
        if len(known) > 400_000:
            known = {_END: (0, 0, 0)}
        for u in unique:
            if u not in known:
                look = signature(u)
                if look not in looks:
                    looks[look] = len(scores)
                    scores.append(tagger.scores(u))
                known[u] = (looks[look], hesitation_bits(u) if u[0] not in _OPEN else 0, len(_RUN.findall(u)))
        fact = np.array([known[u] for u in unique], np.int64).reshape(-1, 3)
        own, before, after = np.array(scores, np.float32).transpose(1, 0, 2)
        stop = codes == list(unique).index(_END)
        row_of = (np.cumsum(stop) - stop)[~stop]
        codes, tokens = codes[~stop], tokens[~stop]
        lengths = np.bincount(row_of, minlength=len(texts)).astype(np.int64)
        place, bits, words = fact[codes].T
        lang = langs[row_of]
        common = np.bitwise_count(bits) == len(LANGS)
        hesitates = np.where(lang >= 0, (bits >> np.maximum(lang, 0)) & 1, common) == 1
        place = np.where(hesitates, 1, place)
        begins = np.r_[True, row_of[1:] != row_of[:-1]] if len(place) else np.zeros(0, bool)
        emit = own[place] + before[np.where(begins, 0, np.r_[0, place[:-1]])] + after[np.where(np.r_[begins[1:], True], 0, np.r_[place[1:], 0])] if len(place) else own[place]
        tags = viterbi(emit, lengths, tagger.trans)
        # a label that the end of the transcript breaks off is speech
        label_word, label_end = np.isin(tags, (ID_WORD, NAME_WORD)), np.isin(tags, (ID_END, NAME_END))
        unfinished = label_word.copy()
        unfinished[:-1] &= (row_of[1:] != row_of[:-1]) if len(tags) else False
        for e in np.flatnonzero(unfinished).tolist():
            row = row_of[e]
            while e >= 0 and label_word[e] and row_of[e] == row:
                tags[e], label_word[e], e = SPEECH, False, e - 1

        ends = np.flatnonzero(label_end)
        # Piece 0 of a row is what stands before its first label.
        labels_in = np.bincount(row_of[ends], minlength=len(texts))
        sizes = labels_in + 1
        offset = np.cumsum(sizes) - sizes
        n = int(sizes.sum())
        piece = np.cumsum(label_end) + row_of if len(tags) else np.zeros(0, np.int64)  # labels so far, and a piece for each row
        speech = tags == SPEECH
        count = np.bincount(piece, weights=np.where(speech, words, 0), minlength=n).astype(np.int32)
        label: list[str | None] = [None] * n
        raw = np.zeros(n, np.int32)
        for e in ends.tolist():
            b = e
            while b > 0 and label_word[b - 1] and row_of[b - 1] == row_of[e]:
                b -= 1
            text = " ".join(tokens[b : e + 1])
            if text[0] not in _OPEN:
                raw[piece[e]] = int(words[b : e + 1].sum())
            elif text[:2] == "<v" and text[2:3] in " .":
                text = text.strip("<> ").partition(" ")[2]
            label[piece[e]] = text
        fields = [pa.array(label, pa.string()), pa.array(count), pa.array(raw)]
        if with_text:
            own, held = tokens[speech], piece[speech]
            cut_at = np.searchsorted(held, np.arange(n + 1))
            fields.append(pa.array([" ".join(own[a:b]) for a, b in zip(cut_at[:-1].tolist(), cut_at[1:].tolist(), strict=True)], pa.string()))
        pieces = pa.ListArray.from_arrays(pa.array(np.r_[offset, n].astype(np.int32)), pa.StructArray.from_arrays(fields, ["label", "n", "raw", "text"][: len(fields)]))
        if any(x is None for x in texts):
            pieces = pa.compute.if_else(pa.array([x is not None for x in texts]), pieces, pa.scalar(None, pieces.type))
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pieces], [*keep, "pieces"])


def speaker_turns(segments: DataFrame, speakers: DataFrame, block_ms: int = 600_000, with_text: bool = False) -> DataFrame:
    """Clean turns (audio_file, turn_no, speaker_id, n_words) of every audio file.

    Each transcript becomes tokens, and a linear-chain model tags them as speech, filler, annotation, timestamp or label;
    Viterbi finds the best tags. What follows a label is a piece by the labelled speaker; what has none in front is by the
    row's speaker. Labels and speaker ids are joined with ``speakers``; a written label with a colon that names nobody is
    speech after all, one in brackets is an annotation. Neighbouring pieces by one speaker, along start_s, segment_id and
    the order in the transcript, are one turn; pieces without words vanish.

    ``with_text`` gives the turns' clean texts (audio_file, turn_no, part_no, start_ms, speaker_id, n_words, text): one row for
    each part of a turn that lies within one block of ``block_ms``, so that no text grows without bound.

    Of several rows of one segment_id the latest by ingested_at counts. Null segment_id, audio_file, start_s and transcript
    give no piece; an empty transcript or one of annotations alone gives none either. A missing or unknown speaker is null,
    and neighbouring pieces by unknown speakers are one turn. Fillers are those of the language named in audio_file, else of
    ``lang``; where neither names one, sounds that are fillers in every language. Ties in time are settled by segment_id.
    """
    path = F.regexp_extract(F.lower("audio_file"), r"(?:^|/)(" + "|".join(LANGS) + r")/", 1)
    code = F.substring(F.lower(F.trim("lang")), 1, 2)
    rows = segments.where(F.col("segment_id").isNotNull()).select(
        "segment_id",
        "ingested_at",
        "audio_file",
        milliseconds(F.col("start_s")).alias("start_ms"),
        "speaker_id",
        F.when(path != "", path).otherwise(F.when(code.isin(*LANGS), code)).alias("_lang"),
        F.col("transcript_text").alias("_text"),
    )
    keep = ["segment_id", "ingested_at", "audio_file", "start_ms", "speaker_id"]
    tagger = model()
    schema = f"segment_id bigint, ingested_at timestamp, audio_file string, start_ms bigint, speaker_id string, pieces array<struct<label:string,n:int,raw:int{',text:string' if with_text else ''}>>"
    tagged = spread(rows, "segment_id").mapInArrow(lambda batches: _pieces(batches, tagger, keep, with_text), schema)
    latest = (
        tagged.groupBy("segment_id")
        .agg(F.max(F.struct("ingested_at", "audio_file", "start_ms", "speaker_id", "pieces")).alias("r"))
        .select("segment_id", "r.*")
        .where(F.col("audio_file").isNotNull() & F.col("start_ms").isNotNull() & F.col("pieces").isNotNull())
    )
    pieces = latest.select("segment_id", "audio_file", "start_ms", "speaker_id", F.posexplode("pieces").alias("piece_no", "p")).select(
        "segment_id",
        "audio_file",
        "start_ms",
        "piece_no",
        F.col("p.n").alias("n"),
        F.col("p.raw").alias("raw"),
        F.col("p.label").alias("label"),
        *([F.col("p.text").alias("text")] if with_text else []),
        speaker_key(F.coalesce("p.label", "speaker_id")).alias("speaker_key"),
    )
    names = speakers.select(F.explode(F.array("speaker_id", "display_name")).alias("name"), F.col("speaker_id").alias("known_speaker"))
    directory = (
        names.select(speaker_key(F.col("name")).alias("speaker_key"), "known_speaker")
        .where(F.col("speaker_key").isNotNull())
        .groupBy("speaker_key")
        .agg(F.min("known_speaker").alias("known_speaker"))
    )
    inside = Window.partitionBy("audio_file", "block").orderBy("start_ms", "segment_id", "piece_no")
    nobody = F.col("label").isNotNull() & F.col("known_speaker").isNull()
    spoken = [F.when(nobody & (F.col("raw") > 0), F.concat_ws(" ", "label", "text")).otherwise(F.col("text")).alias("text")] if with_text else []
    resolved = (
        pieces.join(directory, "speaker_key", "left")
        .withColumn("block", F.floor(F.col("start_ms") / block_ms))
        .withColumn("by", F.last(F.when(~nobody, F.struct("known_speaker")), ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .select(
            "audio_file",
            "block",
            "start_ms",
            "segment_id",
            "piece_no",
            F.col("by.known_speaker").alias("speaker_id"),
            (F.col("n") + F.when(nobody, F.col("raw")).otherwise(0)).cast("long").alias("n_words"),
            *spoken,
        )
        .where(F.col("n_words") > 0)
    )
    order = ["start_ms", "segment_id", "piece_no"]
    turns = merge_runs(resolved, "audio_file", F.col("block"), order, "speaker_id", "n_words", "turn_no", "text" if with_text else None)
    columns = ["audio_file", F.col("turn_no").cast("int").alias("turn_no"), *(["part_no", "start_ms"] if with_text else [])]
    return turns.select(*columns, "speaker_id", F.col("n_words").cast("int").alias("n_words"), *(["text"] if with_text else []))


if __name__ == "__main__":
    write_weights(fitted())
