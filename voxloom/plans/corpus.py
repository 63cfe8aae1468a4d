"""Queries over text: scalar functions, chunks, duplicates, validation, lint, cards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions import grammar, phonetics, provenance, text
from voxloom.functions.languages import language_code
from voxloom.operators import curation, lanes, snapshot, validate
from voxloom.operators.lineage import spread


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _q(build):
    return lambda spark, sf: build(lambda name: _t(spark, sf, name))


def _sentences(t) -> DataFrame:
    return text.sentences(spread(t("documents").select("doc_id", "text"), "doc_id"), "doc_id", "text")


def flagship(t) -> DataFrame:
    """Curation report: distinct texts with a source, per language, with their documents, characters and sources."""
    rows = t("documents").where("text IS NOT NULL AND source IS NOT NULL").withColumn("size", F.length("text"))
    kept = curation.without_duplicates(rows, "doc_id", "text", keep=["lang", "source", "size"])
    return kept.groupBy(F.coalesce(language_code(F.col("lang")), F.lit("?")).alias("lang")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("n_chars"), F.count_distinct("source").alias("n_sources")
    )


def source_reliability(t) -> DataFrame:
    """Kind and reliability of every source by its name and an address made of it."""
    url = F.concat(F.lit("https://www."), F.regexp_replace(F.trim("source"), "_", "-"), F.lit(".example.org/page"))
    rows = t("documents").where("source IS NOT NULL").select("source").distinct().withColumn("url", url)
    kind = provenance.source_type(F.col("source"), F.col("url"))
    return rows.select("source", kind.alias("kind"), F.round(provenance.source_reliability(F.col("source"), F.col("url"), F.lit(None).cast("string")), 6).alias("score"))


def lang_name_lookup(t) -> DataFrame:
    names = t("language_profiles").select(F.col("lang").alias("language_code"), F.concat(F.lit("language "), F.col("lang")).alias("language_name")).distinct()
    return text.language_name(t("speakers").select("speaker_id", "lang"), "lang", names)


def complexity_parts(t) -> DataFrame:
    joins, subs = grammar.marker_counts(F.col("sentence"))
    return _sentences(t).select("doc_id", "sentence_no", F.size(grammar.words_of(F.col("sentence"))).alias("n_words"), joins.alias("n_conjunctions"), subs.alias("n_subordinators"))


def grammar_report(t) -> DataFrame:
    """Complexity, tone and number of rules of every sentence by the built-in tagger, whose word lists are English."""
    s = _sentences(t).withColumn("tags", grammar.tagged(F.col("sentence")))
    return s.select("doc_id", "sentence_no", grammar.complexity(F.col("tags")).alias("complexity"), grammar.grammar_tone(F.col("sentence"), F.col("tags")).alias("tone"), F.size(grammar.sentence_rules(F.col("sentence"), F.col("tags"))).alias("n_rules"))


QUERIES = {
    "flagship": _q(flagship),
    "norm_text": _q(lambda t: t("documents").select("doc_id", text.text_hash(text.normalize_text(F.col("text"))).alias("norm_hash"))),
    "text_sha256": _q(lambda t: t("documents").select("doc_id", text.text_hash(F.col("text")).alias("sha256"))),
    "lang_code_valid": _q(lambda t: t("text_segments").select("lang", text.is_language_code(F.col("lang")).alias("valid"), language_code(F.col("lang")).alias("code")).groupBy("lang", "valid", "code").agg(F.count(F.lit(1)).alias("n"))),
    "lang_name_lookup": _q(lang_name_lookup),
    "truncate_100": _q(lambda t: t("documents").select("doc_id", text.squeeze_and_truncate(F.col("text")).alias("head"))),
    "strip_citations": _q(lambda t: t("documents").select("doc_id", F.length(text.strip_citations(F.concat("text", F.lit(" [12] [x] [3]")))).alias("n"))),
    "chunk_overlap": _q(lambda t: text.chunks(t("documents"), "doc_id", "text").withColumn("chunk", text.text_hash(F.col("chunk")))),
    "exact_dedup": _q(lambda t: curation.exact_classes(t("documents"), "doc_id", "text")),
    "cosine_search": _q(lambda t: curation.cosine_search(t("embeddings"), t("embeddings").where("vec_id % 100 = 0"), "vec_id", "embedding", 0.4).withColumn("cosine", F.round("cosine", 6))),
    "normalize_ipa": _q(lambda t: t("g2p_overrides").select("override_id", phonetics.normalize_ipa(F.concat(F.lit("/"), F.col("ipa"), F.lit("]"))).alias("ipa"), phonetics.is_rhotic(F.col("ipa")).alias("rhotic")).distinct()),
    "dialect_scores": _q(lambda t: t("g2p_overrides").select("override_id", F.explode(phonetics.dialect_scores(F.col("ipa"))).alias("d")).select("override_id", "d.dialect", "d.confidence").distinct()),
    "variant": _q(lambda t: t("g2p_overrides").select("override_id", phonetics.pronunciation_variant(F.col("ipa"), F.col("dialect")).alias("variant"), phonetics.pronunciation_note(F.col("ipa")).alias("note"), phonetics.audio_placeholder(F.col("override_id")).alias("audio")).distinct()),
    "consonant_clusters_top20": _q(lambda t: phonetics.cluster_frequencies(t("curated_tts_manifest"), "text", "lang")),
    "syllable_hist": _q(lambda t: t("g2p_overrides").groupBy("lang", phonetics.syllables(F.col("ipa")).alias("syllables")).agg(F.count(F.lit(1)).alias("n"))),
    "phoneme_pieces": _q(lambda t: t("curated_tts_manifest").select("lang", F.explode(phonetics.phonemes(F.col("phonemes"))).alias("piece")).groupBy("lang", "piece").agg(F.count(F.lit(1)).alias("n"))),
    "categorize_rule": _q(lambda t: _sentences(t).select("doc_id", "sentence_no", grammar.rule_category(F.lit("rule"), F.col("sentence")).alias("category"))),
    "extract_formula": _q(lambda t: t("g2p_rules").select("rule_id", grammar.rule_formula(F.when(F.col("rule_id") % 4 == 3, F.concat(F.lit("If "), "pattern", F.lit(" comes first, then "), "lang", F.lit(" follows. No more"))).otherwise(F.concat("pattern", F.when(F.col("rule_id") % 4 == 0, " -> ").when(F.col("rule_id") % 4 == 1, " becomes ").otherwise(" to "), "lang"))).alias("formula"))),
    "tone_surface": _q(lambda t: _sentences(t).select("doc_id", "sentence_no", grammar.surface_tone(F.col("sentence")).alias("tone"))),
    "complexity_parts": _q(complexity_parts),
    "grammar_report": _q(grammar_report),
    "source_reliability": _q(source_reliability),
    "validate_scores": _q(lambda t: validate.score_issues(t("segment_scores"), F.col("segment_id").cast("string"), ["segment_id"]).select("segment_id", "code", "path")),
    "validate_text_segments": _q(lambda t: validate.segment_issues(t("text_segments"), F.col("segment_id").cast("string"), ["segment_id"]).select("segment_id", "code", "path")),
    "validation_summary": _q(lambda t: validate.summary(validate.segment_issues(t("text_segments"), F.col("segment_id").cast("string"), ["segment_id"]), t("text_segments"))),
    "profile_violations": _q(lambda t: validate.profile_issues(t("language_profiles"), "profile_id").select("profile_id", "code", "path")),
    "lint_report": _q(lambda t: validate.lint_manifest(t("curated_tts_manifest"), "clip_id").select("clip_id", "code")),
    "dataset_card": _q(lambda t: snapshot.dataset_card(t("curated_tts_manifest"), ["lang"]).select("lang", "clips", F.array_join(F.col("sample_rate").cast("array<string>"), ",").alias("sample_rate"), F.round("minutes", 6).alias("minutes"))),
    "grounding": _q(lambda t: curation.grounding_issues(t("text_segments").select("segment_id", "text", F.regexp_replace("source_ref.doc_id", "raw0*", "doc000000").alias("ref"), F.col("source_ref.start_char").alias("a"), F.col("source_ref.end_char").alias("b")), t("documents"), "ref", "a", "b", "text", "doc_ref", "text").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))),
    "text_lane": _q(lambda t: lanes.text_lane(t("documents"), "doc_id", "text")[1]),
    "audio_lane": _q(lambda t: lanes.audio_lane(t("audio_segments").select("segment_id", "start_s", "end_s").distinct(), F.col("start_s"), F.col("end_s"))[1].withColumn("hours", F.round("hours", 6))),
    "batch_estimate": _q(lambda t: lanes.estimate(t("audio_segments").where("end_s > start_s"), F.col("end_s") - F.col("start_s")).select(F.round("hours", 6).alias("hours"), F.round("gib", 6).alias("gib"))),
}

_NORM = r"trim(regexp_replace(regexp_replace(lower(coalesce({0}, '')), '[^\p{{L}}\p{{N}}_\s\x{{A0}}]', '', 'g'), '[\s\x{{A0}}]+', ' ', 'g'))"
_SENT = r"""(SELECT doc_id, CAST(i - 1 AS INT) AS sentence_no, trim(s) AS sentence FROM (
    SELECT doc_id, unnest(p) AS s, generate_subscripts(p, 1) AS i FROM (
        SELECT doc_id, regexp_split_to_array(regexp_replace(text, '([.?!])\s+', '\1' || chr(10), 'g'), '\n+') AS p FROM documents WHERE text IS NOT NULL))
    WHERE length(trim(s)) > 0)"""
_CODE = """(SELECT CASE WHEN l IS NULL OR l IN ('','unknown','unk','und','xx','xxx','zxx','mul','mis','n/a','na','none','null','nan','other','?','-','undefined','undetermined') OR st IN ('','unknown','unk','und','xx','xxx','zxx','mul','mis','n/a','na','none','null','nan','other','?','-','undefined','undetermined') THEN NULL
  ELSE coalesce(list_extract(map_extract(m, l), 1), list_extract(map_extract(m, st), 1), st) END FROM (SELECT lower(trim({0})) AS l, regexp_extract(lower(trim({0})), '^([^-_]*)', 1) AS st,
  MAP {{'ak':'ak','aka':'ak','akan':'ak','twi':'ak','tw':'ak','fante':'ak','fat':'ak','de':'de','deu':'de','ger':'de','german':'de','deutsch':'de','en':'en','eng':'en','english':'en','es':'es','spa':'es','spanish':'es','fr':'fr','fra':'fr','fre':'fr','french':'fr','pt':'pt','por':'pt','portuguese':'pt','sw':'sw','swa':'sw','swh':'sw','swc':'sw','swahili':'sw','kiswahili':'sw','it':'it','ita':'it','italian':'it','italiano':'it','nb':'no','nn':'no','norwegian':'no'}} AS m))"""
_CLASSES = f"""SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS class_id, count(*) OVER (PARTITION BY h) AS n_copies FROM (
    SELECT doc_id, sha256({_NORM.format('text')}) AS h FROM documents WHERE text IS NOT NULL)"""
_HOST = "'www.' || replace(trim(source), '_', '-') || '.example.org'"
_RHOTIC = "regexp_matches({0}, '[ɹɻrɾ](?:$|[^aeiouəɑɛɪɔʊʌæɒ])')"


def _hit(pattern: str, options: tuple[str, ...]) -> str:
    opts = " + ".join(f"CAST(contains(ipa, '{o}') AS INT)" for o in options)
    return f"(CASE WHEN regexp_matches(ipa, '{pattern}') THEN {opts} ELSE 0 END)"


_SIGNS = {
    "American": ("", ((r"tn", ("t", "ʔ")), (r"nt[\p{L}\p{N}_]", ("n(t)", "ʔ")), ("æ([mnŋ][dk]|[sk])", ("æ", "eə")))),
    "British": ("NOT ", (("ɑː", ("ɑː",)), (r"t[\p{L}\p{N}_]", ("t",)), (r"ju[\p{L}\p{N}_]", ("ju", "u")))),
    "Australian": ("NOT ", (("eɪ", ("æɪ",)), ("aɪ", ("ɑɪ",)), ("əʊ", ("əʉ",)))),
}
_DIALECTS = " UNION ALL ".join(
    f"SELECT override_id, ipa, '{d}' AS dialect, least(1.0, (CAST({neg}{_RHOTIC.format('ipa')} AS INT) + {' + '.join(_hit(p, o) for p, o in signs)}) / 5.0) AS confidence FROM (SELECT DISTINCT override_id, ipa FROM g2p_overrides)"
    for d, (neg, signs) in _SIGNS.items()
)
_SCORES = " UNION ALL ".join(f"SELECT segment_id, 'SCORE_RANGE' AS code, segment_id || '.{k}' AS path FROM segment_scores WHERE {k} IS NULL OR isnan({k}) OR NOT {k} BETWEEN 0 AND 100" for k in validate.SCORE_FIELDS)
_BROKEN = """(text IS NULL OR lang IS NULL OR labels IS NULL OR labels.is_dialogue IS NULL OR source_ref IS NULL OR source_ref.doc_id IS NULL OR source_ref.start_char IS NULL OR source_ref.end_char IS NULL
    OR coalesce(len(list_filter(labels.code_switch_spans, lambda s: s IS NULL OR len(s) <> 2 OR s[1] IS NULL OR s[2] IS NULL)), 0) > 0)"""
_SEGMENTS = f"""SELECT segment_id, 'CONTRACT' AS code, CAST(segment_id AS VARCHAR) AS path FROM text_segments WHERE {_BROKEN}
    UNION ALL SELECT segment_id, 'GROUNDING_OFFSETS', segment_id || '.source_ref' FROM text_segments WHERE NOT {_BROKEN} AND source_ref.start_char >= source_ref.end_char"""
_CONJ, _SUBS = (", ".join(f"'{w}'" for w in ws) for ws in (grammar.CONJUNCTIONS, grammar.SUBORDINATORS))
_WORDS = r"regexp_extract_all(lower(sentence), '[\p{L}\p{N}_]+(?:''[\p{L}\p{N}_]+)?')"


def _any(text_: str, terms) -> str:
    return "(" + " OR ".join(f"contains({text_}, '{t}')" for t in terms) + ")"


_KIND = "CASE " + " ".join(f"WHEN {_any(col, terms)} THEN '{k}'" for col, table in (("lower(source)", provenance.NAME_TERMS), ("host", provenance.HOST_TERMS)) for k, terms in table.items()) + " ELSE 'general_reference' END"
_RELIABLE = "CASE kind " + " ".join(
    f"WHEN '{k}' THEN {base} + " + " + ".join(f"CAST(contains(lower(source), '{w}') AS INT) * 0.1" for w in words) + f" + CAST({_any('host', hosts)} AS INT) * 0.3"
    for k, (base, hosts, words) in provenance.RELIABILITY.items()
) + f" END + CAST({_any('host', provenance.TRUSTED_HOSTS)} AS INT) * 0.5"

ORACLE = {
    "flagship": f"""WITH c AS ({_CLASSES.replace("text IS NOT NULL)", "text IS NOT NULL AND source IS NOT NULL)")})
        SELECT coalesce({_CODE.format('d.lang')}, '?') AS lang, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars, count(DISTINCT source) AS n_sources
        FROM documents d JOIN c ON d.doc_id = c.doc_id AND c.doc_id = c.class_id GROUP BY 1""",
    "norm_text": f"SELECT doc_id, sha256({_NORM.format('text')}) AS norm_hash FROM documents",
    "text_sha256": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "lang_code_valid": f"SELECT lang, coalesce(regexp_full_match(lang, '[a-z]{{2,3}}|[a-z]{{2}}-[A-Z]{{2}}'), false) AS valid, {_CODE.format('lang')} AS code, count(*) AS n FROM text_segments GROUP BY 1, 2, 3",
    "lang_name_lookup": """SELECT speaker_id, lang, coalesce(CASE lang WHEN 'en' THEN 'English' WHEN 'es' THEN 'Spanish' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' WHEN 'it' THEN 'Italian'
        WHEN 'pt' THEN 'Portuguese' WHEN 'ru' THEN 'Russian' WHEN 'zh' THEN 'Chinese' WHEN 'ja' THEN 'Japanese' WHEN 'ko' THEN 'Korean' WHEN 'ar' THEN 'Arabic' WHEN 'hi' THEN 'Hindi' END, n) AS language_name
        FROM speakers LEFT JOIN (SELECT DISTINCT lang AS l, 'language ' || lang AS n FROM language_profiles) p ON l = lang""",
    "truncate_100": r"SELECT doc_id, CASE WHEN length(f) > 100 THEN f[1:97] || '...' ELSE f END AS head FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS f FROM documents)",
    "strip_citations": r"SELECT doc_id, CAST(length(regexp_replace(text || ' [12] [x] [3]', '\[[0-9]+\]', '', 'g')) AS INT) AS n FROM documents",
    "chunk_overlap": """SELECT doc_id, CAST(c AS INT) AS chunk_no, CAST(c * 350 AS INT) AS start_char, CAST(least(c * 350 + 400, length(text)) AS INT) AS end_char, sha256(substring(text, c * 350 + 1, 400)) AS chunk
        FROM (SELECT doc_id, text, unnest(range(0, 1 + greatest(0, CAST(ceil((length(text) - 400) / 350.0) AS BIGINT)))) AS c FROM documents WHERE length(text) > 0)""",
    "exact_dedup": _CLASSES,
    "cosine_search": """SELECT q.vec_id AS query_id, v.vec_id AS near_id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 6) AS cosine
        FROM embeddings q JOIN embeddings v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id WHERE list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])) >= 0.4""",
    "normalize_ipa": f"SELECT DISTINCT override_id, translate(replace(ipa, 'ɚ', 'əɹ'), 'ˈˌ', '') AS ipa, {_RHOTIC.format('ipa')} AS rhotic FROM g2p_overrides",
    "dialect_scores": f"SELECT override_id, dialect, CAST(confidence AS DOUBLE) AS confidence FROM ({_DIALECTS}) WHERE confidence > 0",
    "consonant_clusters_top20": r"""SELECT lang, cluster, n, CAST(rank AS INT) AS rank FROM (SELECT lang, cluster, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, cluster) AS rank
        FROM (SELECT lang, unnest(regexp_extract_all(text, '(?i)[bcdfghjklmnpqrstvwxyzðθʃʒŋɹɾɻ]{2,}')) AS cluster FROM curated_tts_manifest) GROUP BY 1, 2) WHERE rank <= 20""",
    "syllable_hist": "SELECT lang, greatest(1, CAST(len(regexp_extract_all(ipa, '(?i)[aeiouæɑɛɪɔʊʌəɒ]+')) AS INT)) AS syllables, count(*) AS n FROM g2p_overrides GROUP BY 1, 2",
    "phoneme_pieces": r"SELECT lang, piece, count(*) AS n FROM (SELECT lang, unnest(regexp_extract_all(phonemes, '[^\s\-.]+')) AS piece FROM curated_tts_manifest) GROUP BY 1, 2",
    "categorize_rule": "SELECT doc_id, sentence_no, CASE "
    + " ".join(f"WHEN regexp_matches(lower('rule ' || sentence), '(?i){'|'.join(p)}') THEN '{c}'" for c, p in grammar.CATEGORIES.items())
    + f" ELSE 'syntax' END AS category FROM {_SENT}",
    "extract_formula": "SELECT rule_id, CASE WHEN rule_id % 4 = 3 THEN pattern || ' comes first → ' || lang || ' follows' WHEN rule_id % 4 < 2 AND regexp_matches(pattern, '[A-Za-z0-9+]$') THEN regexp_extract(pattern, '[A-Za-z0-9+]+$') || ' → ' || lang END AS formula FROM g2p_rules",
    "tone_surface": f"""SELECT doc_id, sentence_no, CASE WHEN suffix(sentence, '?') OR coalesce(w[1] IN ({", ".join(f"'{x}'" for x in grammar.QUESTION_WORDS)}), false) THEN 'interrogative' WHEN suffix(sentence, '!') THEN 'exclamatory'
        WHEN list_has_any(w, [{", ".join(f"'{x}'" for x in grammar.FORMAL)}]) THEN 'formal' WHEN list_has_any(w, [{", ".join(f"'{x}'" for x in grammar.INFORMAL)}]) THEN 'informal' ELSE 'neutral' END AS tone
        FROM (SELECT doc_id, sentence_no, sentence, {_WORDS} AS w FROM {_SENT})""",
    "complexity_parts": f"""SELECT doc_id, sentence_no, CAST(len(w) AS INT) AS n_words, CAST(len(list_filter(w, lambda x: x IN ({_CONJ}))) AS INT) AS n_conjunctions,
        CAST(len(list_filter(w, lambda x: x IN ({_SUBS}))) AS INT) AS n_subordinators FROM (SELECT doc_id, sentence_no, {_WORDS} AS w FROM {_SENT})""",
    "source_reliability": f"SELECT source, kind, CAST(round(least(5.0, {_RELIABLE}), 6) AS DOUBLE) AS score FROM (SELECT source, host, {_KIND} AS kind FROM (SELECT DISTINCT source, lower({_HOST}) AS host FROM documents WHERE source IS NOT NULL))",
    "validate_scores": _SCORES,
    "validate_text_segments": _SEGMENTS,
    "validation_summary": f"SELECT count(*) = 0 AS ok, (SELECT count(*) FROM text_segments) AS checked, count(*) AS n_issues FROM ({_SEGMENTS})",
    "lint_report": """SELECT clip_id, 'DURATION' AS code FROM curated_tts_manifest WHERE NOT coalesce(duration_s, 0) BETWEEN 1.5 AND 14.0 OR isnan(duration_s)
        UNION ALL SELECT clip_id, 'NO_TEXT_OR_PHONEMES' FROM curated_tts_manifest WHERE coalesce(text, '') = '' AND coalesce(phonemes, '') = ''
        UNION ALL SELECT NULL, 'SAMPLE_RATE_MIX' FROM (SELECT count(DISTINCT coalesce(sample_rate, -1)) AS n FROM curated_tts_manifest) WHERE n > 1""",
    "dataset_card": """SELECT lang, count(*) AS clips, array_to_string(list_sort(list(DISTINCT sample_rate) FILTER (WHERE sample_rate IS NOT NULL)), ',') AS sample_rate,
        round(coalesce(sum(duration_s), 0) / 60, 6) AS minutes FROM curated_tts_manifest GROUP BY 1""",
    "text_lane": """SELECT count(DISTINCT doc_id) AS documents, count(*) AS segments, CAST(sum(length(substring(text, c * 350 + 1, 400))) AS BIGINT) AS characters
        FROM (SELECT doc_id, text, unnest(range(0, 1 + greatest(0, CAST(ceil((length(text) - 400) / 350.0) AS BIGINT)))) AS c FROM documents WHERE length(text) > 0)""",
    "audio_lane": "SELECT CAST(sum(n) AS BIGINT) AS clips, round(sum(l) / 3600, 6) AS hours FROM (SELECT end_s - start_s AS l, ceil((end_s - start_s) / 12.0) AS n FROM (SELECT DISTINCT segment_id, start_s, end_s FROM audio_segments)) WHERE l >= 2.0 AND n > 0",
    "batch_estimate": "SELECT round(sum(end_s - start_s) / 3600, 6) AS hours, round(sum(end_s - start_s) * 16000 / 1073741824, 6) AS gib FROM audio_segments WHERE end_s > start_s",
}

_RANGES = (("tts_defaults.speaking_rate", 0.5, 1.8), ("tts_defaults.pitch_bias", -12, 12), ("tts_defaults.pause_bias", 0, 1), ("tts_defaults.filler_bias", 0, 1), ("curation_targets.phoneme_coverage", 0, 1))
ORACLE |= {
    "profile_violations": " UNION ALL ".join(
        f"SELECT profile_id, '{code}' AS code, profile_id || '.{path}' AS path FROM language_profiles WHERE {when}"
        for code, path, when in (
            ("SEMVER", "version", r"NOT coalesce(regexp_full_match(profile_version, '[0-9]+\.[0-9]+\.[0-9]+'), false)"),
            ("REGISTER_SUM", "register_defaults", "register_defaults IS NOT NULL AND NOT coalesce(abs(list_sum(map_values(register_defaults)) - 1) < 1e-6, false)"),
            ("SELF_FALLBACK", "fallback_chain", "list_contains(fallback_chain, dialect)"),
            ("INVENTORY", "phoneme_inventory", "coalesce(len(phoneme_inventory), 0) = 0"),
            ("STRATEGY", "tts_strategy", "coalesce(tts_strategy, '') NOT IN ('standalone', 'grouped', 'cloud_fallback')"),
            *(("RANGE", c, f"NOT {c} BETWEEN {a} AND {b}") for c, a, b in _RANGES),
        )
    ),
    "variant": f"""WITH s AS (SELECT override_id, ipa, arg_max(dialect, (confidence, CASE dialect WHEN 'American' THEN 3 WHEN 'British' THEN 2 ELSE 1 END)) AS d, max(confidence) AS c FROM ({_DIALECTS}) GROUP BY 1, 2),
        o AS (SELECT DISTINCT override_id, dialect, ipa, translate(replace(ipa, 'ɚ', 'əɹ'), 'ˈˌ', '') AS norm FROM g2p_overrides)
        SELECT o.override_id, CASE WHEN o.dialect IS NULL AND c > 0.7 THEN lower(d) ELSE 'standard' END AS variant,
        'Normalized from ' || chr(39) || o.ipa || chr(39) || ' to ' || chr(39) || norm || chr(39) || '. ' || CASE WHEN {_RHOTIC.format('norm')} THEN 'Features: rhoticity: True' ELSE '' END AS note, 'audio_files/word_' || o.override_id || '.mp3' AS audio
        FROM o LEFT JOIN s ON s.override_id = o.override_id AND s.ipa = o.ipa""",
    "grounding": """SELECT CASE WHEN d.doc_ref IS NULL THEN 'no document' WHEN a IS NULL OR b IS NULL OR a < 0 OR a >= b THEN 'offsets' WHEN b > length(d.text) THEN 'out of bounds' ELSE 'other text' END AS reason, count(*) AS n
        FROM (SELECT segment_id, text, regexp_replace(source_ref.doc_id, 'raw0*', 'doc000000') AS ref, source_ref.start_char AS a, source_ref.end_char AS b FROM text_segments) s LEFT JOIN documents d ON s.ref = d.doc_ref
        WHERE d.doc_ref IS NULL OR a IS NULL OR b IS NULL OR a < 0 OR a >= b OR b > length(d.text) OR substring(d.text, a + 1, b - a) IS DISTINCT FROM s.text GROUP BY 1""",
}
