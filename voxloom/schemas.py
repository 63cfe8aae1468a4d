"""Schemas of the data contracts and of the lexicon, the single source for readers, validators and the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_DDL = {
    "SourceRef": "doc_id STRING, start BIGINT, end BIGINT",
    "Labels": "is_dialogue BOOLEAN, topic STRING, register STRING, register_type STRING, code_switch_spans ARRAY<ARRAY<BIGINT>>",
    "TextSegment": "text STRING, lang STRING, labels STRUCT<is_dialogue: BOOLEAN, topic: STRING, register: STRING, register_type: STRING, code_switch_spans: ARRAY<ARRAY<BIGINT>>>, source_ref STRUCT<doc_id: STRING, start: BIGINT, end: BIGINT>",
    "AudioSegment": "audio_file STRING, start DOUBLE, end DOUBLE, speaker_id STRING, transcript_text STRING, lang STRING, dialect_probs MAP<STRING, DOUBLE>, alignment_confidence DOUBLE, diarization_confidence DOUBLE, granularity STRING",
    "SegmentScore": "clarity DOUBLE, alignment DOUBLE, diarization DOUBLE, transcript_accuracy DOUBLE, validity DOUBLE, shape DOUBLE, total DOUBLE, eligible_learner BOOLEAN, eligible_training BOOLEAN, notes STRING",
    "G2PRule": "pattern STRING, ipa STRING, conditions MAP<STRING, STRING>, priority INT",
    "G2POverride": "word STRING, ipa STRING, dialect STRING, notes STRING",
    "TTSDefaults": "speaking_rate DOUBLE, pitch_bias DOUBLE, pause_bias DOUBLE, filler_bias DOUBLE",
    "CurationTargets": "min_minutes_90 DOUBLE, phoneme_coverage DOUBLE, target_dialect_mix MAP<STRING, DOUBLE>",
    "LanguageProfileV1": "language STRING, dialect STRING, script STRING, version STRING, updated_at TIMESTAMP, phoneme_inventory ARRAY<STRING>, g2p_rules ARRAY<STRUCT<pattern: STRING, ipa: STRING, conditions: MAP<STRING, STRING>, priority: INT>>, g2p_overrides ARRAY<STRUCT<word: STRING, ipa: STRING, dialect: STRING, notes: STRING>>, lexicon_refs ARRAY<STRING>, register_defaults MAP<STRING, DOUBLE>, style_tokens ARRAY<STRING>, emotion_tokens ARRAY<STRING>, tts_defaults STRUCT<speaking_rate: DOUBLE, pitch_bias: DOUBLE, pause_bias: DOUBLE, filler_bias: DOUBLE>, fallback_chain ARRAY<STRING>, curation_targets STRUCT<min_minutes_90: DOUBLE, phoneme_coverage: DOUBLE, target_dialect_mix: MAP<STRING, DOUBLE>>, tts_strategy STRING",
    "BatchManifest": "batch_id STRING, lane STRING, language STRING, dialect STRING, inputs ARRAY<STRUCT<uri: STRING, doc_id: STRING>>, outputs MAP<STRING, STRING>, metrics MAP<STRING, DOUBLE>, status STRING",
    "ManifestRow": "wav STRING, sample_rate INT, duration_s DOUBLE, text STRING, phonemes STRING, lang STRING, dialect STRING, speaker_id STRING, style_tags ARRAY<STRING>, granularity STRING",
    "WordRecord": "word STRING, language STRING, definitions ARRAY<STRING>, pronunciations ARRAY<STRING>, examples ARRAY<STRING>, part_of_speech ARRAY<STRING>, etymology ARRAY<STRING>, related_words ARRAY<STRING>, url STRING, scrape_date STRING",
    # lexicon tables
    "languages": "language_id INT, language_code STRING, language_name STRING, family STRING, notes STRING, created_at TIMESTAMP",
    "dialects": "dialect_id INT, language_id INT, dialect_name STRING, region STRING, notes STRING",
    "words": "word_id INT, language_id INT, word_text STRING, part_of_speech STRING, frequency INT, difficulty DECIMAL(5,2), etymology STRING",
    "definitions": "definition_id INT, word_id INT, definition_text STRING, definition_order INT, usage_context STRING",
    "phonetics": "phonetic_id INT, word_id INT, dialect_id INT, ipa_pronunciation STRING, audio_path STRING, is_primary BOOLEAN, pronunciation_variant STRING, notes STRING",
    "grammar_rules": "rule_id INT, language_id INT, rule_name STRING, rule_type STRING, rule_description STRING, rule_formula STRING, complexity_level INT",
    "example_sentences": "sentence_id INT, language_id INT, sentence_text STRING, translation STRING, complexity_score DECIMAL(3,2), grammar_tone STRING",
    "word_sentence_map": "word_id INT, sentence_id INT, position INT",
    "metadata_sources": "source_id INT, source_name STRING, source_type STRING, source_url STRING, reliability_score DECIMAL(3,2), publication_date DATE, license STRING, notes STRING",
    "entity_metadata": "entity_type STRING, entity_id INT, source_id INT, confidence_score DECIMAL(3,2), extraction_date TIMESTAMP",
    "language_relationships": "language_id_1 INT, language_id_2 INT, relationship_type STRING, similarity DECIMAL(3,2)",
    "subagents": "agent_id INT, agent_name STRING, agent_type STRING, last_run TIMESTAMP",
    "change_history": "change_id INT, table_name STRING, record_id INT, field_name STRING, old_value STRING, new_value STRING, reason STRING, changed_at TIMESTAMP",
}

SCHEMAS: dict[str, T.StructType] = {}


def schema(name: str) -> T.StructType:
    """The schema of a contract or lexicon table."""
    if name not in SCHEMAS:
        SCHEMAS[name] = T._parse_datatype_string(_DDL[name])
    return SCHEMAS[name]


def names() -> list[str]:
    return list(_DDL)


def catalogue(spark: SparkSession) -> DataFrame:
    """(contract, position, field, type) of every field of every schema."""
    rows = [(n, i, f.name, f.dataType.simpleString()) for n in _DDL for i, f in enumerate(schema(n).fields)]
    return spark.createDataFrame(rows, "contract string, position int, field string, type string")
