"""The relational lexicon: lookups, nested word records, constraint checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions import grammar
from voxloom.functions import phonetics as sounds
from voxloom.operators.lineage import cut


def existing(words: DataFrame, lexicon: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``words`` that stand in ``lexicon``."""
    return words.join(lexicon.select(*keys), keys, "left_semi")


def insert_if_absent(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """``current`` and, of the rows of ``incoming`` with a new key, one each: the smallest by all columns.

    Rows with a null key are never found and come once per null key.
    """
    cols = current.columns
    rest = [c for c in cols if c not in keys]
    fresh = incoming.select(*cols)
    for i, k in enumerate(keys):
        fresh = fresh.withColumn(f"_k{i}", F.col(k))
    have = current.select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)]).distinct()
    same = None
    for i in range(len(keys)):
        c = F.col(f"_k{i}").eqNullSafe(F.col(f"_h{i}"))
        same = c if same is None else same & c
    fresh = fresh.join(have, same, "left_anti")
    if rest:
        fresh = fresh.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
    else:
        fresh = fresh.select(*keys).distinct()
    return current.unionByName(fresh.select(*cols))


def word_records(words: DataFrame, definitions: DataFrame, pronunciations: DataFrame, examples: DataFrame, key: str = "word_id") -> DataFrame:
    """``words`` with arrays of definitions (definition_order, definition_text), pronunciations (ipa, dialect) and examples.

    Each detail table is gathered per word and joined once; a word without details has empty arrays.
    """

    def gathered(df: DataFrame, out: str, *cols: str) -> DataFrame:
        return df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(out))

    out = words
    for df, name, cols in ((definitions, "definitions", ("definition_order", "definition_text")), (pronunciations, "pronunciations", ("ipa", "dialect")), (examples, "examples", ("sentence_text",))):
        part = gathered(df, name, *cols)
        out = out.join(part, key, "left").withColumn(name, F.coalesce(name, F.array().cast(part.schema[name].dataType)))
    return out


def unprocessed(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with a null in any of the columns."""
    condition = F.lit(False)
    for c in columns:
        condition = condition | F.col(c).isNull()
    return df.where(condition)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose key isn't null and names no row of ``parent``: violations of a foreign key."""
    named = parent.select(F.col(parent_key).alias("_parent")).distinct()
    return child.where(F.col(child_key).isNotNull()).join(named, F.col(child_key) == F.col("_parent"), "left_anti")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n): keys without nulls that occur more than once: violations of a unique constraint."""
    rows = df.dropna(subset=keys)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows whose value isn't null and not from low to high: violations of a check constraint."""
    return df.where(F.col(column).isNotNull() & (~F.col(column).between(low, high) | F.isnan(F.col(column).cast("double"))))


def pronunciation_batch(phonetics: DataFrame, words: DataFrame, languages: DataFrame, dialects: DataFrame) -> DataFrame:
    """Pronunciations without variant or notes, with word, language and dialect, and what is worked out for them.

    (phonetic_id, word_text, language_code, dialect_name, ipa_pronunciation, pronunciation_variant, notes, audio_path).
    Pronunciations whose word or language isn't known are left out; a missing dialect stays null. Values that are there stay.
    """
    rows = (
        unprocessed(phonetics, "pronunciation_variant", "notes")
        .join(words.select("word_id", "language_id", "word_text"), "word_id")
        .join(languages.select("language_id", "language_code"), "language_id")
        .join(dialects.select("dialect_id", "dialect_name"), "dialect_id", "left")
    )
    ipa = F.col("ipa_pronunciation")
    return rows.select(
        "phonetic_id",
        "word_text",
        "language_code",
        "dialect_name",
        sounds.normalize_ipa(ipa).alias("ipa_pronunciation"),
        F.coalesce("pronunciation_variant", sounds.pronunciation_variant(ipa, F.col("dialect_name"))).alias("pronunciation_variant"),
        F.coalesce("notes", sounds.pronunciation_note(ipa)).alias("notes"),
        sounds.audio_placeholder(F.col("word_id")).alias("audio_path"),
    )


def sentence_batch(sentences: DataFrame, languages: DataFrame) -> DataFrame:
    """(sentence_id, language_code, complexity_score, grammar_tone, rules) of sentences that lack score or tone.

    Each is tagged once; scores and tones that are there stay. Sentences of unknown languages are left out.
    """
    rows = unprocessed(sentences, "complexity_score", "grammar_tone").join(languages.select("language_id", "language_code"), "language_id")
    rows = rows.withColumn("_tags", grammar.tagged(F.col("sentence_text")))
    return rows.select(
        "sentence_id",
        "language_code",
        F.coalesce("complexity_score", grammar.complexity(F.col("_tags"))).alias("complexity_score"),
        F.coalesce("grammar_tone", grammar.grammar_tone(F.col("sentence_text"), F.col("_tags"))).alias("grammar_tone"),
        grammar.sentence_rules(F.col("sentence_text"), F.col("_tags")).alias("rules"),
    )


def rules_shown(batch: DataFrame) -> DataFrame:
    """(sentence_id, language_code, r) of a sentence batch: one row per rule. The batch is written first, so that taking its rules
    apart field by field doesn't make them anew for every field."""
    return cut(batch.select("sentence_id", "language_code", "rules")).select("sentence_id", "language_code", F.explode("rules").alias("r"))


def new_rules(batch: DataFrame, rules: DataFrame) -> DataFrame:
    """(language_code, rule_name, rule_type, rule_description, rule_formula, example) of a sentence batch that ``rules`` lack.

    One row per language and name, with the smallest example.
    """
    shown = rules_shown(batch).select("language_code", "r.*")
    one = shown.groupBy("language_code", "rule_name").agg(F.min(F.struct("rule_type", "rule_description", "rule_formula", F.col("examples")[0].alias("example"))).alias("r"))
    return one.select("language_code", "rule_name", "r.*").join(rules.select("language_code", "rule_name"), ["language_code", "rule_name"], "left_anti")


def rule_batch(rules: DataFrame) -> DataFrame:
    """``rules`` with a type where it is missing, by name and description, and a formula where that is missing."""
    return rules.withColumn("rule_type", F.coalesce("rule_type", grammar.rule_category(F.col("rule_name"), F.col("rule_description")))).withColumn(
        "rule_formula", F.coalesce("rule_formula", grammar.rule_formula(F.col("rule_description")))
    )


def sentences_of_words(words: DataFrame, bridge: DataFrame, sentences: DataFrame) -> DataFrame:
    """(word_id, sentence_id, sentence_text) of words by the table that ties words to sentences; ties given twice count once."""
    return words.select("word_id").join(bridge.select("word_id", "sentence_id").distinct(), "word_id").join(sentences.select("sentence_id", "sentence_text"), "sentence_id")
