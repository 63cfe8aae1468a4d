"""Scalar functions against hand vectors and plain Python."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from voxloom.functions import grammar, phonetics, provenance, reports, text
from voxloom.functions.languages import language_code


def one(spark, col, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) if v is not None else F.lit(None).cast("string").alias(k) for k, v in values.items()])
    return df.select(col.alias("x")).first().x


@pytest.mark.parametrize("given,want", [("  This is a SAMPLE text with punctuation!   ", "this is a sample text with punctuation"), ("Öl, 3€ [x] a_b", "öl 3 x a_b"), ("", ""), (None, ""), ("a  b", "a b")])
def test_normalize(spark, given, want):
    assert one(spark, text.normalize_text(F.col("t")), t=given) == want


def test_normalize_flags(spark):
    assert one(spark, text.normalize_text(F.col("t"), lowercase=False, remove_punctuation=False, remove_whitespace=True), t=" A, b ") == "A,b"


def test_hash_and_truncate(spark):
    assert one(spark, text.text_hash(F.col("t")), t="é") == hashlib.sha256("é".encode()).hexdigest()
    assert one(spark, text.squeeze_and_truncate(F.col("t")), t="x" * 101) == "x" * 97 + "..."
    assert one(spark, text.squeeze_and_truncate(F.col("t")), t=" a \n b ") == "a b"


@pytest.mark.parametrize("code,ok", [("en", True), ("aka", True), ("pt-BR", True), ("EN", False), ("pt-br", False), ("e", False), ("en\n", False), (None, False)])
def test_codes(spark, code, ok):
    assert one(spark, text.is_language_code(F.col("t")), t=code) is ok


@pytest.mark.parametrize("label,want", [("en_US", "en"), ("Swahili", "sw"), ("spa", "es"), ("und", None), ("", None), (None, None), (" PT ", "pt"), ("nl-BE", "nl"), ("N/A", None)])
def test_labels(spark, label, want):
    assert one(spark, language_code(F.col("t")), t=label) == want


def test_examples_and_definitions(spark):
    df = spark.createDataFrame([(["a [1] long one", "no[2]", "b"], ["x", " ", "y", "x"])], "e array<string>, d array<string>")
    r = df.select(text.clean_examples(F.col("e")).alias("e"), text.clean_definitions(F.col("d")).alias("d")).first()
    assert r.e == ["a  long one"] and r.d == ["x", "y"]


def test_chunks_cover_the_text(spark):
    t = "".join(chr(97 + i % 26) for i in range(1005))
    rows = text.chunks(spark.createDataFrame([(1, t), (2, ""), (3, None), (4, "short")], "k int, t string"), "k", "t", 400, 50).orderBy("k", "chunk_no").collect()
    assert [(r.k, r.start_char, r.end_char) for r in rows] == [(1, 0, 400), (1, 350, 750), (1, 700, 1005), (4, 0, 5)]
    assert all(r.chunk == (t if r.k == 1 else "short")[r.start_char : r.end_char] for r in rows)


def test_phonetics(spark):
    assert one(spark, phonetics.normalize_ipa(F.col("t")), t="/ˈbʌtn/") == "bʌtn"
    assert one(spark, phonetics.normalize_ipa(F.col("t")), t="[bɚd]") == "bəɹd"
    assert one(spark, phonetics.normalize_ipa(F.col("t")), t="") is None
    got = one(spark, phonetics.dialect_scores(F.col("t")), t="bʌtn")
    assert [(x.dialect, x.confidence) for x in got] == [("British", 0.4), ("American", 0.2), ("Australian", 0.2)]
    assert one(spark, phonetics.syllables(F.col("t")), t="strk") == 1
    assert one(spark, phonetics.consonant_clusters(F.col("t")), t="strand ŋk") == ["str", "nd", "ŋk"]
    assert one(spark, phonetics.pronunciation_variant(F.col("t"), F.lit(None).cast("string")), t="bʌtn") == "standard"


@pytest.mark.parametrize("d,f", [("X becomes Y", "X → Y"), ("NP -> Det N", "NP → Det N"), ("if a verb ends, then add s.", "a verb ends → add s"), ("nothing", None), (None, None)])
def test_formula(spark, d, f):
    assert one(spark, grammar.rule_formula(F.col("t")), t=d) == f


def test_category_and_tone(spark):
    assert one(spark, grammar.rule_category(F.lit("Plural formation"), F.col("t")), t="adds a suffix") == "morphology"
    assert one(spark, grammar.rule_category(F.lit("x"), F.col("t")), t="nothing at all") == "syntax"
    assert one(spark, grammar.rule_category(F.lit("x"), F.col("t")), t=None) is None
    for s, tone in (("Who is it", "interrogative"), ("Stop!", "exclamatory"), ("He shall pass.", "formal"), ("yeah ok", "informal"), ("A day.", "neutral"), ("  ", "neutral"), (None, "neutral")):
        assert one(spark, grammar.surface_tone(F.col("t")), t=s) == tone


def test_tagged_grammar(spark):
    texts = ["Read the new book.", None, "", "The old man can go because he must.", "Go.", "Is it so?", "Cats chased the quiet dog in the house", "Birds", "quickly give it", "7 dogs' 2nd x's"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").withColumn("tags", grammar.tagged(F.col("s")))
    rows = df.select("i", "tags", grammar.grammar_tone(F.col("s"), F.col("tags")).alias("t"), grammar.complexity(F.col("tags")).alias("c"), grammar.sentence_rules(F.col("s"), F.col("tags")).alias("r")).orderBy("i").collect()
    assert [r.t for r in rows[:3]] == ["imperative", "neutral", "neutral"] and rows[5].t == "interrogative"
    assert rows[1].c == rows[2].c == 0 and rows[3].c > rows[4].c > 0 and rows[2].r == []
    # 9 tokens, one subordinator, no conjunction, one pattern (MD VB)
    assert rows[3].c == round(9 / 50 * 3 + 2 / 5 * 3 + 1 / 3 * 2 + 1 / 5 * 2, 2)
    assert [(t.word, t.tag) for t in rows[6].tags] == [("Cats", "NNS"), ("chased", "VBD"), ("the", "DT"), ("quiet", "JJ"), ("dog", "NN"), ("in", "IN"), ("the", "DT"), ("house", "NN")]
    assert [(r.rule_name, r.rule_formula, r.examples) for r in rows[6].r] == [
        ("Adjective Placement", "ADJ + NOUN", ["quiet dog"]), ("Prepositional Phrase", "PREP + DET + NOUN", ["in the house"]), ("SUBJ-VERB-OBJ Word Order", "SUBJ-VERB-OBJ", [texts[6]]),
    ]
    assert {r.rule_type for r in rows[6].r} == {"syntax"} and all(r.rule_description for r in rows[6].r)
    assert rows[7].r == [] and [r.rule_name for r in rows[8].r] == ["Adverb Placement"]


def test_provenance(spark):
    rel = provenance.source_reliability(F.lit("Wiktionary"), F.lit("https://en.wiktionary.org/"), F.lit("dictionary"))
    assert one(spark, rel, t="x") == 3.5
    assert one(spark, provenance.source_type(F.lit("Oxford English Dictionary"), F.col("t")), t=None) == "dictionary"
    assert one(spark, provenance.source_type(F.lit("Site"), F.col("t")), t="https://linguistics.example.com/a") == "linguistic_resource"
    assert one(spark, provenance.source_reliability(F.col("t"), F.lit(None).cast("string"), F.lit(None).cast("string")), t="") == 0.0
    ok, url = provenance.url_status(F.lit(301), F.lit("https://b"), F.lit("https://a"))
    assert one(spark, ok, t="x") is True and one(spark, url, t="x") == "https://b"


def test_reports(spark):
    for n, w in ((0, 2), (1, 4), (2, 8)):
        assert one(spark, reports.backoff(F.lit(n)), t="x") == w
    assert one(spark, reports.traffic_light(F.lit(86), F.lit(100)), t="x") == "yellow"
    assert one(spark, reports.traffic_light(F.lit(84), F.lit(100)), t="x") == "red"
    assert one(spark, reports.duration_text(F.lit(200)), t="x") == "3m 20s"
    assert one(spark, reports.progress_text(F.lit(5), F.lit(20), F.lit(60.0)), t="x") == "5/20 (25.0%), 3m 0s left"
    assert [one(spark, reports.status_badge(F.col("t")), t=x) for x in ("completed", "running", "queued", "failed", "odd", None)] == ["green", "blue", "yellow", "red", "gray", "gray"]
    assert one(spark, reports.progress_percent(F.lit(5), F.lit(0)), t="x") == 0.0


def test_word_card(spark):
    a = lambda *x: F.array(*map(F.lit, x)).cast("array<string>")
    word = {"word": F.lit("w"), "language": F.lit("en"), "definitions": a(*[f"d  {i}" for i in range(20)]), "pronunciations": a("p"), "examples": a("e" * 120), "part_of_speech": a("noun"), "etymology": a(), "related_words": a("r"), "url": F.lit(None).cast("string"), "scrape_date": F.lit("now")}
    card = one(spark, reports.word_card(word), t="x")
    assert card.count("\n    1") == 7 and "15. d 14" in card and "16." not in card and '"' + "e" * 97 + '..."' in card
    assert "**Etymology" not in card and "**URL:** Not available" in card and card.endswith("---")
    assert not one(spark, reports.word_card(word, full=False), t="x").endswith("---")
    assert re.search(r"\*\*Word:\*\* w\n\n\*\*Language:\*\* en\n\n", card)
