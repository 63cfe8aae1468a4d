"""Queries over the lexicon's tables, made of profiles, overrides and texts: joins, agent batches, links, maintenance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions import grammar
from voxloom.operators import lexicon, metrics, profiles, upsert
from voxloom.plans.corpus import _DIALECTS, _SENT, _q

Tables = Callable[[str], DataFrame]


def _languages(t: Tables) -> DataFrame:
    """Languages of the profiles; the id is made of the code's two letters."""
    code = F.col("lang")
    return t("language_profiles").select((F.ascii(code) * 256 + F.ascii(F.substring(code, 2, 1))).alias("language_id"), code.alias("language_code")).distinct()


def _words(t: Tables) -> DataFrame:
    """Words of the overrides; a word's id is the smallest of its overrides."""
    lang = F.col("lang")
    return t("g2p_overrides").groupBy("lang", F.col("word").alias("word_text")).agg(F.min("override_id").alias("word_id")).withColumn("language_id", F.ascii(lang) * 256 + F.ascii(F.substring(lang, 2, 1)))


def _phonetics(t: Tables) -> DataFrame:
    """Pronunciations of the overrides, those without notes unprocessed."""
    o = t("g2p_overrides").distinct()
    ids = _words(t).select("lang", F.col("word_text").alias("word"), "word_id")
    tied = o.join(ids, ["lang", "word"]).join(t("language_profiles").select("dialect", F.col("profile_id").alias("dialect_id")), "dialect", "left")
    return tied.select(F.col("override_id").alias("phonetic_id"), "word_id", "dialect_id", F.col("ipa").alias("ipa_pronunciation"), F.lit(None).cast("string").alias("pronunciation_variant"), F.when(F.col("notes") != "", F.col("notes")).alias("notes"))


def pronunciation_batch(t: Tables) -> DataFrame:
    dialects = t("language_profiles").select(F.col("profile_id").alias("dialect_id"), F.col("dialect").alias("dialect_name"))
    return lexicon.pronunciation_batch(_phonetics(t), _words(t), _languages(t), dialects).distinct()


def _sentences(t: Tables) -> DataFrame:
    """Texts of the evaluation items and of segments as sentences without score or tone."""
    lang = F.col("lang")
    number = F.ascii(lang) * 256 + F.ascii(F.substring(lang, 2, 1))
    rows = t("text_segments").where("segment_id IS NOT NULL").select(F.col("segment_id").alias("sentence_id"), "lang", "text").distinct()
    return rows.select("sentence_id", number.alias("language_id"), F.col("text").alias("sentence_text"), F.lit(None).cast("double").alias("complexity_score"), F.lit(None).cast("string").alias("grammar_tone"), F.length("lang").alias("code_length")).where("code_length = 2").drop("code_length")


def sentence_batch(t: Tables) -> DataFrame:
    found = lexicon.sentence_batch(_sentences(t), _languages(t))
    return found.select("sentence_id", "language_code", "complexity_score", "grammar_tone", F.size("rules").alias("n_rules"))


def sentence_rules(t: Tables) -> DataFrame:
    """How many sentences of each language show each rule, and how often."""
    shown = lexicon.rules_shown(lexicon.sentence_batch(_sentences(t), _languages(t)))
    return shown.groupBy("language_code", "r.rule_name", "r.rule_formula", "r.rule_type").agg(F.count_distinct("sentence_id").alias("n_sentences"), F.count(F.lit(1)).alias("n"))


def new_rules(t: Tables) -> DataFrame:
    """Rules that sentences show and the language's rules lack: English knows where adjectives go."""
    known = _languages(t).where("language_code = 'en'").select("language_code", F.lit("Adjective Placement").alias("rule_name"))
    return lexicon.new_rules(lexicon.sentence_batch(_sentences(t), _languages(t)), known).select("language_code", "rule_name", "rule_type", "rule_formula", "example")


def rule_batch(t: Tables) -> DataFrame:
    """Items' texts as descriptions of rules, of which every third has a type."""
    kind = F.when(F.col("item_id") % 3 == 0, "phonology")
    rows = t("eval_items").select("item_id", F.col("task").alias("rule_name"), F.concat("text", F.lit(" plural formation becomes s")).alias("rule_description"), kind.alias("rule_type"), F.lit(None).cast("string").alias("rule_formula"))
    return lexicon.rule_batch(rows).select("item_id", "rule_type", "rule_formula")


def _item_words(t: Tables) -> DataFrame:
    """Words of the evaluation items of each language; a word's id is the smallest of its items."""
    tokens = t("eval_items").select("item_id", "lang", F.explode(grammar.words_of(F.col("text"))).alias("word_text"))
    return tokens.groupBy("lang", "word_text").agg(F.min("item_id").alias("word_id"))


def word_sentences(t: Tables) -> DataFrame:
    """Sentences of words over a bridge: the clips whose text holds a word of an evaluation item."""
    clips = t("curated_tts_manifest").where("text IS NOT NULL").select(F.col("clip_id").alias("sentence_id"), "lang", F.col("text").alias("sentence_text")).distinct()
    tokens = clips.select("sentence_id", "lang", F.explode(F.array_distinct(grammar.words_of(F.col("sentence_text")))).alias("word_text"))
    words = _item_words(t)
    bridge = tokens.join(words, ["lang", "word_text"]).select("word_id", "sentence_id")
    tied = lexicon.sentences_of_words(words.select("word_id").distinct(), bridge, clips.drop("lang"))
    return tied.groupBy("word_id").agg(F.count_distinct("sentence_id").alias("n_sentences"), F.sum(F.length("sentence_text")).alias("n_chars"))


def minimal_pairs(t: Tables) -> DataFrame:
    """Pairs of words of a language's evaluation items that differ in their first letter alone, of which both occur in its clips."""
    words = _item_words(t).where(F.length("word_text") > 2).select("lang", "word_text", F.substring("word_text", 2, 99).alias("rest"))
    other = words.select("lang", F.col("word_text").alias("other"), "rest")
    pairs = words.join(other, ["lang", "rest"]).where("word_text < other")
    seen = t("curated_tts_manifest").select("lang", F.explode(grammar.words_of(F.col("text"))).alias("word"))
    return metrics.pair_coverage(pairs, seen, "lang", "word_text", "other", "word").withColumn("coverage", F.round("coverage", 6))


def _links(t: Tables, late: bool) -> DataFrame:
    rows = t("documents").where("source IS NOT NULL AND fetched_at IS NOT NULL").where(F.col("fetched_at") >= "2025-07-01" if late else F.col("fetched_at") < "2025-07-01")
    return rows.select(F.lit("source").alias("entity_type"), (F.length("source")).alias("entity_id"), F.ascii("source").alias("source_id"), F.when(F.col("lang").isNotNull(), F.length("text").cast("double")).alias("confidence_score"), F.col("fetched_at").alias("extraction_date"))


def entity_links(t: Tables) -> DataFrame:
    keys = ["entity_type", "entity_id", "source_id"]
    current = upsert.latest(_links(t, False), keys, F.col("extraction_date"))
    linked = upsert.link_entities(current, _links(t, True))
    return linked.groupBy("entity_id", "source_id").agg(F.max(F.unix_micros("extraction_date")).alias("at_us"), F.count(F.lit(1)).alias("n"))


def maintenance(t: Tables) -> DataFrame:
    """Sources reassessed, and five of them held against made-up responses: every second address answers."""
    names = t("documents").where("source IS NOT NULL").select(F.col("source").alias("source_name")).distinct()
    url = F.concat(F.lit("https://example.org/"), F.md5("source_name"))
    sources = names.select("source_name", F.lit(None).cast("string").alias("source_type"), url.alias("source_url"), F.lit(2.5).alias("reliability_score"))
    answers = sources.select("source_url", F.when(F.md5("source_name") < "8", 200).otherwise(404).alias("status"), F.lit(None).cast("string").alias("location"))
    return upsert.maintenance(sources, answers)


def g2p_resolve(t: Tables) -> DataFrame:
    """Pronunciations of all words of overrides and clips in their dialects."""
    clips = t("curated_tts_manifest").select("lang", "dialect", F.explode(grammar.words_of(F.col("text"))).alias("word"))
    words = t("g2p_overrides").select("lang", "dialect", "word").unionByName(clips)
    return profiles.resolve_pronunciations(words, t("g2p_overrides"), t("g2p_rules"), t("language_profiles")).groupBy("lang", "dialect", "by", "step").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("ipa")).alias("n_chars"), F.min("ipa").alias("first_ipa"), F.max(F.struct("word", "ipa"))["ipa"].alias("last_words_ipa")
    )


QUERIES = {name: _q(f) for name, f in globals().copy().items() if name in (
    "pronunciation_batch", "sentence_batch", "sentence_rules", "new_rules", "rule_batch", "word_sentences", "minimal_pairs", "entity_links", "maintenance", "g2p_resolve",
)}


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _tag_sql(word: str, place: str) -> str:
    """The tag of one token as SQL, written out from the tagger's word lists."""
    closed = " ".join(f"WHEN lower({word}) IN ({_quoted(ws.split())}) THEN '{t}'" for t, ws in grammar.CLOSED.items())
    ends = " ".join(f"WHEN {' OR '.join(f"suffix(lower({word}), '{e}')" for e in es)} THEN '{t}'" for t, es in grammar.ENDINGS)
    adjective = " OR ".join(f"suffix(lower({word}), '{e}')" for e in grammar.ADJECTIVE_ENDINGS)
    return (
        rf"CASE WHEN NOT regexp_matches({word}, '^[\p{{L}}\p{{N}}]') THEN {word} {closed} WHEN regexp_full_match({word}, '\p{{N}}+') THEN 'CD' {ends} "
        rf"WHEN regexp_matches({word}, '^\p{{Lu}}') AND {place} > 1 THEN 'NNP' WHEN {adjective} OR lower({word}) IN ({_quoted(grammar.ADJECTIVES)}) THEN 'JJ' "
        f"WHEN suffix(lower({word}), 's') AND length({word}) > 3 THEN 'NNS' ELSE 'NN' END"
    )


def tagged_sql(source: str, keys: str) -> str:
    """Tables tok (keys, sentence, w, tags), score and shown for the sentences (keys, sentence) of ``source``."""
    count = lambda among: f"len(list_filter(w, lambda x: lower(x) IN ({_quoted(among)})))"
    seen = " + ".join(f"CAST(regexp_matches(parts, '{p}') AS INT)" for p in grammar.COMPLEX)
    tone = f"""CASE WHEN trim(sentence) = '' OR sentence IS NULL THEN 'neutral' WHEN suffix(trim(sentence), '?') OR coalesce(ws[1] IN ({_quoted(grammar.QUESTION_WORDS)}), false) THEN 'interrogative'
        WHEN suffix(trim(sentence), '!') THEN 'exclamatory' WHEN list_has_any(ws, [{_quoted(grammar.FORMAL)}]) THEN 'formal' WHEN list_has_any(ws, [{_quoted(grammar.INFORMAL)}]) THEN 'informal' ELSE 'neutral' END"""
    return rf"""tok AS (SELECT {keys}, sentence, w, list_transform(w, lambda x, i: {_tag_sql('x', 'i')}) AS tags, regexp_extract_all(lower(coalesce(sentence, '')), '[\p{{L}}\p{{N}}_]+(?:''[\p{{L}}\p{{N}}_]+)?') AS ws
        FROM (SELECT {keys}, sentence, regexp_extract_all(coalesce(sentence, ''), '[\p{{L}}\p{{N}}_]+(?:''[\p{{L}}\p{{N}}_]+)?|[^\p{{L}}\p{{N}}_\s]') AS w FROM {source})),
    first_ AS (SELECT *, array_to_string(tags, ' ') AS parts, {_tag_sql('lower(w[1])', '0')} AS head FROM tok),
    score AS (SELECT {keys}, sentence, CASE WHEN len(w) = 0 THEN 0.0 ELSE least(10.0, round(least(len(w) / 50.0, 1) * 3 + least((1 + {count(grammar.SUBORDINATORS)}) / 5.0, 1) * 3 + least(({seen}) / 3.0, 1) * 2 + least(({count(grammar.CONJUNCTIONS)} + {count(grammar.SUBORDINATORS)}) / 5.0, 1) * 2, 2)) END AS complexity,
        CASE WHEN coalesce(prefix(head, 'VB') AND lower(w[1]) NOT IN ({_quoted(grammar.BE)}), false) THEN 'imperative' ELSE {tone} END AS tone FROM first_),
    letters AS (SELECT *, array_to_string(list_transform(tags, lambda t: CASE WHEN prefix(t, 'NN') THEN 'N' WHEN prefix(t, 'VB') THEN 'V' ELSE '.' END), '') AS l FROM tok),
    ordered AS (SELECT {keys}, sentence, concat_ws('-', CASE WHEN prefix(l, 'N') THEN 'SUBJ' END, CASE WHEN contains(l, 'V') THEN 'VERB' END, CASE WHEN regexp_matches(l, 'V.*N') THEN 'OBJ' END) AS o FROM letters),
    places AS (SELECT {keys}, sentence, w, tags, unnest(range(1, len(w) + 1)) AS i FROM tok),
    shown AS (
        SELECT {keys}, sentence, 'Adjective Placement' AS rule_name, 'ADJ + NOUN' AS rule_formula, w[i] || ' ' || w[i + 1] AS example FROM places WHERE prefix(tags[i], 'JJ') AND prefix(tags[i + 1], 'NN')
        UNION ALL SELECT {keys}, sentence, 'Adverb Placement', 'ADV + VERB', w[i] || ' ' || w[i + 1] FROM places WHERE prefix(tags[i], 'RB') AND prefix(tags[i + 1], 'VB')
        UNION ALL SELECT {keys}, sentence, 'Prepositional Phrase', 'PREP + DET + NOUN', w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM places WHERE tags[i] = 'IN' AND tags[i + 1] IN ('DT', 'PRP$') AND prefix(tags[i + 2], 'NN')
        UNION ALL SELECT {keys}, sentence, o || ' Word Order', o, sentence FROM ordered WHERE contains(o, '-'))"""


_CODES = "(SELECT DISTINCT lang FROM language_profiles)"
_SEGMENTS = f"(SELECT DISTINCT segment_id AS sentence_id, lang, text AS sentence FROM text_segments WHERE segment_id IS NOT NULL AND lang IN {_CODES})"
_WORD_IDS = "(SELECT lang, word, min(override_id) AS word_id FROM g2p_overrides GROUP BY 1, 2)"
_NORM = "translate(replace(regexp_replace(regexp_replace(ipa, '^[/\\[(]', ''), '[/\\])]$', ''), 'ɚ', 'əɹ'), 'ˈˌ', '')"
_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+(?:''[\p{L}\p{N}_]+)?')"
_LINKED = """SELECT length(source) AS e, ascii(source) AS s, fetched_at AS f, CASE WHEN lang IS NOT NULL THEN CAST(length(text) AS DOUBLE) END AS c FROM documents WHERE source IS NOT NULL AND fetched_at IS NOT NULL"""
_MOVED = """CASE WHEN regexp_matches(lower(source), 'journal|university|research|proceedings|academia') THEN 4.0 + 0.1 * (CAST(contains(lower(source), 'journal') AS INT) + CAST(contains(lower(source), 'published') AS INT) + CAST(contains(lower(source), 'research') AS INT) + CAST(contains(lower(source), 'study') AS INT) + CAST(contains(lower(source), 'peer-reviewed') AS INT))
    WHEN regexp_matches(lower(source), 'dictionary|lexicon|wordnet|oxford|cambridge|merriam|webster') THEN 3.5 + 0.1 * (CAST(contains(lower(source), 'dictionary') AS INT) + CAST(contains(lower(source), 'definition') AS INT) + CAST(contains(lower(source), 'lexicon') AS INT) + CAST(contains(lower(source), 'wordlist') AS INT))
    WHEN regexp_matches(lower(source), 'linguistics|corpus|grammar|phonology|syntax') THEN 3.0 + 0.1 * (CAST(contains(lower(source), 'corpus') AS INT) + CAST(contains(lower(source), 'linguistic') AS INT) + CAST(contains(lower(source), 'grammar') AS INT) + CAST(contains(lower(source), 'syntax') AS INT) + CAST(contains(lower(source), 'phonology') AS INT))
    WHEN regexp_matches(lower(source), 'forum|wiki|blog|community|user') THEN 1.5 + 0.1 * (CAST(contains(lower(source), 'forum') AS INT) + CAST(contains(lower(source), 'discussion') AS INT) + CAST(contains(lower(source), 'user') AS INT) + CAST(contains(lower(source), 'comment') AS INT) + CAST(contains(lower(source), 'blog') AS INT))
    ELSE 2.5 + 0.1 * (CAST(contains(lower(source), 'reference') AS INT) + CAST(contains(lower(source), 'guide') AS INT) + CAST(contains(lower(source), 'encyclopedia') AS INT)) END"""
ORACLE = {
    "grammar_report": f"""WITH {tagged_sql(_SENT, 'doc_id, sentence_no')} SELECT s.doc_id, s.sentence_no, s.complexity, s.tone, CAST(coalesce(n, 0) AS INT) AS n_rules
        FROM score s LEFT JOIN (SELECT doc_id, sentence_no, count(*) AS n FROM shown GROUP BY 1, 2) r USING (doc_id, sentence_no)""",
    "pronunciation_batch": f"""SELECT DISTINCT o.override_id AS phonetic_id, o.word AS word_text, o.lang AS language_code, p.dialect AS dialect_name, {_NORM} AS ipa_pronunciation,
        CASE WHEN p.dialect IS NULL AND c > 0.7 THEN lower(d) ELSE 'standard' END AS pronunciation_variant,
        CASE WHEN o.notes <> '' THEN o.notes ELSE 'Normalized from ' || chr(39) || ipa || chr(39) || ' to ' || chr(39) || {_NORM} || chr(39) || '. ' || CASE WHEN regexp_matches({_NORM}, '[ɹɻrɾ](?:$|[^aeiouəɑɛɪɔʊʌæɒ])') THEN 'Features: rhoticity: True' ELSE '' END END AS notes,
        'audio_files/word_' || w.word_id || '.mp3' AS audio_path
        FROM g2p_overrides o JOIN {_WORD_IDS} w ON o.lang = w.lang AND o.word = w.word JOIN {_CODES} l ON o.lang = l.lang LEFT JOIN language_profiles p ON p.dialect = o.dialect
        LEFT JOIN (SELECT override_id, ipa AS i, arg_max(dialect, (confidence, CASE dialect WHEN 'American' THEN 3 WHEN 'British' THEN 2 ELSE 1 END)) AS d, max(confidence) AS c FROM ({_DIALECTS}) GROUP BY 1, 2) x ON x.i = o.ipa AND x.override_id = o.override_id""",
    "sentence_batch": f"""WITH {tagged_sql(_SEGMENTS, 'sentence_id, lang')} SELECT s.sentence_id, s.lang AS language_code, s.complexity AS complexity_score, s.tone AS grammar_tone, CAST(coalesce(n, 0) AS INT) AS n_rules
        FROM score s LEFT JOIN (SELECT sentence_id, lang, sentence, count(*) AS n FROM shown GROUP BY 1, 2, 3) r ON s.sentence_id = r.sentence_id AND s.lang = r.lang AND s.sentence IS NOT DISTINCT FROM r.sentence""",
    "sentence_rules": f"WITH {tagged_sql(_SEGMENTS, 'sentence_id, lang')} SELECT lang AS language_code, rule_name, rule_formula, 'syntax' AS rule_type, count(DISTINCT sentence_id) AS n_sentences, count(*) AS n FROM shown GROUP BY 1, 2, 3",
    "new_rules": f"""WITH {tagged_sql(_SEGMENTS, 'sentence_id, lang')} SELECT lang AS language_code, rule_name, 'syntax' AS rule_type, rule_formula, min(example) AS example FROM shown
        WHERE NOT (lang = 'en' AND rule_name = 'Adjective Placement') GROUP BY 1, 2, 4""",
    "rule_batch": r"""SELECT item_id, CASE WHEN item_id % 3 = 0 THEN 'phonology' ELSE CASE WHEN regexp_matches(d, '(subject|object|predicate).*(precede|follow)|(clause|phrase).*(structure|order)|(word order|sentence structure)|(?i)(SVO|SOV|VSO|VOS|OSV|OVS)') THEN 'syntax' ELSE 'morphology' END END AS rule_type,
        'formation → s' AS rule_formula FROM (SELECT item_id, lower(task || ' ' || text || ' plural formation becomes s') AS d FROM eval_items)""",
    "word_sentences": f"""WITH w AS (SELECT lang, word, min(item_id) AS word_id FROM (SELECT item_id, lang, unnest({_WORDS}) AS word FROM eval_items) GROUP BY 1, 2)
        SELECT word_id, count(DISTINCT clip_id) AS n_sentences, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM (SELECT DISTINCT word_id, clip_id, text FROM (
        SELECT DISTINCT clip_id, lang, text, unnest(list_distinct({_WORDS})) AS word FROM (SELECT DISTINCT clip_id, lang, text FROM curated_tts_manifest WHERE text IS NOT NULL)) c JOIN w USING (lang, word)) GROUP BY 1""",
    "minimal_pairs": f"""WITH w AS (SELECT DISTINCT lang, word FROM (SELECT lang, unnest({_WORDS}) AS word FROM eval_items) WHERE length(word) > 2), seen AS (SELECT DISTINCT lang, unnest({_WORDS}) AS word FROM curated_tts_manifest),
        p AS (SELECT a.lang, a.word AS x, b.word AS y FROM w a JOIN w b ON a.lang = b.lang AND a.word[2:] = b.word[2:] AND a.word < b.word)
        SELECT p.lang, count(*) AS n_pairs, count(s.word) FILTER (WHERE r.word IS NOT NULL) AS n_seen, round(n_seen / n_pairs, 6) AS coverage FROM p LEFT JOIN seen s ON s.lang = p.lang AND s.word = x LEFT JOIN seen r ON r.lang = p.lang AND r.word = y GROUP BY 1""",
    "entity_links": f"SELECT CAST(e AS INT) AS entity_id, CAST(s AS INT) AS source_id, epoch_us(max(f)) AS at_us, CAST(1 AS BIGINT) AS n FROM ({_LINKED}) GROUP BY 1, 2",
    "maintenance": f"""WITH s AS (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL), v AS (SELECT count(*) FILTER (WHERE md5(source) < '8') AS n FROM (SELECT source FROM s ORDER BY md5(source || ' 0'), source LIMIT 5)),
        m AS (SELECT count(*) FILTER (WHERE abs(2.5 - ({_MOVED})) > 0.01) AS n FROM s) SELECT m.n AS sources_reassessed, v.n AS sources_verified, m.n > 0 OR v.n > 0 AS success FROM m, v""",
    "g2p_resolve": f"""WITH asked AS (SELECT DISTINCT lang, dialect, word FROM (SELECT lang, dialect, word FROM g2p_overrides UNION ALL SELECT lang, dialect, unnest({_WORDS}) FROM curated_tts_manifest) WHERE lang IS NOT NULL AND word IS NOT NULL),
        chain AS (SELECT lang, dialect, f, min(i) AS step FROM (SELECT lang, dialect, unnest(fallback_chain) AS f, generate_subscripts(fallback_chain, 1) AS i FROM language_profiles) WHERE f <> dialect GROUP BY 1, 2, 3),
        at_ AS (SELECT lang, dialect, word, dialect AS f, 0 AS step FROM asked UNION ALL SELECT a.lang, a.dialect, a.word, c.f, c.step FROM asked a JOIN chain c ON a.lang = c.lang AND a.dialect = c.dialect),
        over_ AS (SELECT lang, dialect, word, arg_max(ipa, (updated_at, override_id)) AS ipa FROM g2p_overrides WHERE ipa IS NOT NULL GROUP BY 1, 2, 3),
        rule_ AS (SELECT lang, dialect, pattern || chr(1) || chr(57343 + CAST(row_number() OVER (PARTITION BY lang, dialect ORDER BY priority DESC, length(pattern) DESC, rule_id) AS INT)) || chr(1) || coalesce(conditions['before'], '') || chr(1) || ipa AS r, row_number() OVER (PARTITION BY lang, dialect ORDER BY priority DESC, length(pattern) DESC, rule_id) AS no FROM g2p_rules WHERE pattern IS NOT NULL AND ipa IS NOT NULL AND dialect IS NOT NULL),
        rules_ AS (SELECT lang, dialect, list(r ORDER BY no) AS rs FROM rule_ GROUP BY 1, 2),
        marked AS (SELECT a.lang, a.f, a.word, rs, list_reduce(list_prepend(a.word, rs), lambda acc, r: replace(acc, split_part(r, chr(1), 1) || split_part(r, chr(1), 3), split_part(r, chr(1), 2) || split_part(r, chr(1), 3))) AS m FROM (SELECT DISTINCT lang, f, word FROM at_) a JOIN rules_ x ON a.lang = x.lang AND a.f = x.dialect),
        made AS (SELECT lang, f, word, list_reduce(list_prepend(m, rs), lambda acc, r: replace(acc, split_part(r, chr(1), 2), split_part(r, chr(1), 4))) AS ipa FROM marked WHERE m <> word),
        all_ AS (SELECT a.lang, a.dialect, a.word, step, 0 AS rank, o.ipa, 'override' AS by_ FROM at_ a JOIN over_ o ON a.lang = o.lang AND a.f = o.dialect AND a.word = o.word
            UNION ALL SELECT a.lang, a.dialect, a.word, 0, 1, o.ipa, 'override' FROM asked a JOIN over_ o ON a.lang = o.lang AND o.dialect IS NULL AND a.word = o.word
            UNION ALL SELECT a.lang, a.dialect, a.word, step, 2, m.ipa, 'rule' FROM at_ a JOIN made m ON a.lang = m.lang AND a.f = m.f AND a.word = m.word
            UNION ALL SELECT lang, dialect, word, 1048576, 9, NULL, 'none' FROM asked),
        best AS (SELECT lang, dialect, word, arg_min({{'ipa': ipa, 'by': by_, 'step': CASE WHEN by_ <> 'none' THEN step END}}, step * 10 + rank) AS b FROM all_ GROUP BY 1, 2, 3)
        SELECT lang, dialect, b.by AS "by", b.step AS step, count(*) AS n, CAST(sum(length(b.ipa)) AS BIGINT) AS n_chars, min(b.ipa) AS first_ipa, arg_max({{'i': b.ipa}}, word).i AS last_words_ipa FROM best GROUP BY 1, 2, 3, 4""",
}
