"""Queries of the training-data problems and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions.readings import in_force, recording, speaker_directory, speaker_key
from voxloom.llm.capping import best_scores, cap_contributors
from voxloom.llm.languages import fit_on_table, identify, label_findings, span_findings
from voxloom.llm.leakage import leaks
from voxloom.llm.lookalike import lookalike_classes, lookalike_pairs, with_canonical
from voxloom.llm.mixing import plan_mixes
from voxloom.llm.quality import COMMON, text_quality
from voxloom.llm.splits import assign_splits, group_records
from voxloom.llm.turns import speaker_turns
from voxloom.operators.lineage import spread


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Clean speaker turns of every audio file."""
    return speaker_turns(_t(spark, sf, "audio_segments"), _t(spark, sf, "speakers"))


def p3_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Clean speaker turns with their texts, in parts of at most ten minutes."""
    return speaker_turns(_t(spark, sf, "audio_segments"), _t(spark, sf, "speakers"), with_text=True)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Each clip with the group of clips it hangs together with by speaker or recording."""
    clips = _t(spark, sf, "curated_tts_manifest").select("clip_id", speaker_key(F.col("speaker_id")).alias("speaker_key"), recording(F.col("wav")).alias("recording"))
    known = speaker_directory(_t(spark, sf, "speakers"))
    return group_records(clips.join(known, "speaker_key", "left"), "clip_id", "known_speaker", "recording")


def p2_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Each clip with its group and its split: 80 % train, 10 % validation, 10 % test."""
    return assign_splits(p2_found(spark, sf), "group_key", {"train": 0.8, "validation": 0.1, "test": 0.1})


def _identified(spark: SparkSession, sf: str) -> DataFrame:
    rows = _t(spark, sf, "text_segments").select("segment_id", "text", "lang", F.col("labels.code_switch_spans").alias("spans"))
    return identify(spread(rows, "segment_id"), "text", fit_on_table(rows, "text", "lang"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Missing and wrong language labels, and the other languages of mixed texts."""
    return label_findings(_identified(spark, sf), "segment_id", "lang")


def p4_stretches(spark: SparkSession, sf: str) -> DataFrame:
    """Language and confidence of every text, and of every stretch in another language (offsets are null for the text)."""
    places = ["first_word", "n_words", "start_char", "end_char"]
    rows = _identified(spark, sf).select("segment_id", "main_lang", "confidence", "stretches").distinct()
    whole = rows.select("segment_id", F.col("main_lang").alias("lang"), *[F.lit(None).cast("int").alias(c) for c in places], "confidence")
    parts = rows.select("segment_id", F.explode("stretches").alias("s")).select("segment_id", "s.lang", *[f"s.{c}" for c in places], "s.confidence")
    return whole.unionByName(parts)


def p4_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Stretches in another language beside the labelled spans: confirmed, unlabelled and unconfirmed ones."""
    return span_findings(_identified(spark, sf), "segment_id", "spans")


_IPA_TABLES = {
    "curated_tts_manifest": ("clip_id", "phonemes", lambda: [recording(F.col("wav"))]),
    "g2p_overrides": ("override_id", "ipa", lambda: [F.col("lang"), F.col("word")]),
    "g2p_rules": ("rule_id", "ipa", lambda: [F.col("lang"), F.col("pattern")]),
}


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of records whose phonemes or IPA look the same but differ in characters."""
    found = [
        lookalike_pairs(_t(spark, sf, name), record, text, within()).select(F.lit(name).alias("record_table"), "id_a", "id_b")
        for name, (record, text, within) in _IPA_TABLES.items()
    ]
    return reduce(DataFrame.unionByName, found)


def p5_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Records whose phonemes or IPA look like another spelling's: one row each, with their class and the consistent form."""
    found = [
        lookalike_classes(_t(spark, sf, name), record, text, within()).select(F.lit(name).alias("record_table"), F.col(record).alias("id"), "class_id", "look")
        for name, (record, text, within) in _IPA_TABLES.items()
    ]
    return reduce(DataFrame.unionByName, found).distinct()


def p5_canonical(spark: SparkSession, sf: str) -> DataFrame:
    """Phonemes of every clip in the consistent form, and whether that changed them."""
    rows = _t(spark, sf, "curated_tts_manifest").select("clip_id", "phonemes").distinct()
    return with_canonical(rows, "phonemes", "consistent").select(
        "clip_id", "consistent", (~F.col("phonemes").eqNullSafe(F.col("consistent"))).alias("changed")
    )


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    rows = in_force(_t(spark, sf, "audio_segments"), ["segment_id", "speaker_id", "ingested_at"])
    return rows.join(best_scores(_t(spark, sf, "segment_scores")), "segment_id", "left").select(
        "segment_id", "score", speaker_key(F.col("speaker_id")).alias("speaker_key")
    )


def _best_first() -> list:
    return [F.col("score").desc_nulls_last(), F.col("segment_id").asc()]


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Segments that are dropped when each known speaker keeps the best 50."""
    known = speaker_directory(_t(spark, sf, "speakers"))
    marked = cap_contributors(_scored(spark, sf).where("speaker_key IS NOT NULL"), "speaker_key", _best_first(), max_count=50)
    return marked.where(~F.col("kept")).join(known, "speaker_key", "left_semi").select("segment_id")


def p6_share(spark: SparkSession, sf: str) -> DataFrame:
    """Segments and kept segments of each known speaker when none may have more than 1 % of what is kept."""
    known = speaker_directory(_t(spark, sf, "speakers"))
    rows = _scored(spark, sf).join(known, "speaker_key")
    marked = cap_contributors(rows, "known_speaker", _best_first(), max_share=0.01)
    return marked.groupBy(F.col("known_speaker").alias("speaker_id")).agg(
        F.count(F.lit(1)).alias("n_segments"), F.count_if("kept").alias("n_kept"), F.min(F.when(F.col("kept"), F.col("score"))).alias("lowest_kept")
    )


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold twelve words on end of an evaluation item, or a shorter item whole."""
    return leaks(_t(spark, sf, "documents"), _t(spark, sf, "eval_items")).where("verbatim > 0").select("doc_id", "item_id")


def p7_verbatim(spark: SparkSession, sf: str) -> DataFrame:
    """Per evaluation item that leaked word by word: the documents that hold it, and how many of its windows stand there in all."""
    found = leaks(_t(spark, sf, "documents"), _t(spark, sf, "eval_items")).where("verbatim > 0")
    return found.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("verbatim").alias("n_windows"))


def p7_items(spark: SparkSession, sf: str) -> DataFrame:
    """Per evaluation item: documents that hold it verbatim, and documents that only hold it with other names or numbers."""
    found = leaks(_t(spark, sf, "documents"), _t(spark, sf, "eval_items"))
    return found.groupBy("item_id").agg(F.count_if(F.col("verbatim") > 0).alias("n_verbatim"), F.count_if((F.col("verbatim") == 0) & (F.col("reworded") > 0)).alias("n_reworded"))


def _mixes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return plan_mixes(_t(spark, sf, "documents"), _t(spark, sf, "mix_targets"), weight=F.log1p(F.length("text")))


def p8_mix_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Copies of each document for each mix; longer texts are somewhat more likely."""
    return _mixes(spark, sf)[0]


def p8_mix_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual share of every source of every mix."""
    return _mixes(spark, sf)[1]


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that aren't prose by most of their characters, with what they are."""
    rows = text_quality(spread(_t(spark, sf, "documents").select("doc_id", "text"), "doc_id"), "text")
    return rows.where("kind <> 'prose'").select("doc_id", "kind")


def p9_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Text statistics of every document."""
    return text_quality(spread(_t(spark, sf, "documents").select("doc_id", "text"), "doc_id"), "text").drop("text")


def p9_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The statistics of every document that are plain counts and ratios."""
    done = text_quality(spread(_t(spark, sf, "documents").select("doc_id", "text"), "doc_id"), "text")
    return done.select("doc_id", "n_chars", "n_words", *[F.round(c, 6).alias(c) for c in ("mean_word_length", "symbol_ratio", "line_end_ratio", "common_ratio")])


QUERIES = {
    "p2_found": p2_found,
    "p2_splits": p2_splits,
    "p3_found": p3_found,
    "p3_turns": p3_turns,
    "p4_found": p4_found,
    "p4_stretches": p4_stretches,
    "p4_spans": p4_spans,
    "p5_found": p5_found,
    "p5_classes": p5_classes,
    "p5_canonical": p5_canonical,
    "p6_found": p6_found,
    "p6_share": p6_share,
    "p7_found": p7_found,
    "p7_verbatim": p7_verbatim,
    "p7_items": p7_items,
    "p8_mix_plan": p8_mix_plan,
    "p8_mix_shares": p8_mix_shares,
    "p9_found": p9_found,
    "p9_stats": p9_stats,
    "p9_counts": p9_counts,
}

_KEY = (
    r"nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({0}), '^[^\p{{L}}\p{{N}}]+', ''), "
    r"'^(?:spk|spkr|speaker|sprecher|sprecherin|hablante|locutor|locutora|locuteur|locutrice|falante|orador|oradora|msemaji|kasafo|voice|talker)[^\p{{L}}\p{{N}}]+', ''), "
    r"'[^\p{{L}}\p{{N}}]+', '', 'g'), '(^|\P{{N}})0+(\p{{N}})', '\1\2', 'g'), '')"
)
_SCORED = f"""
WITH known AS (SELECT {_KEY.format('speaker_id')} AS k, min(speaker_id) AS speaker_id FROM speakers GROUP BY 1),
force AS (
    SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY ingested_at DESC NULLS LAST, speaker_id DESC NULLS LAST) AS rn FROM audio_segments),
latest AS (
    SELECT segment_id, total, row_number() OVER (PARTITION BY segment_id ORDER BY scored_at DESC NULLS LAST, total DESC) AS rn
    FROM segment_scores WHERE total BETWEEN 0 AND 100 AND NOT isnan(total)),
ranked AS (
    SELECT f.segment_id, n.speaker_id, l.total AS score,
        row_number() OVER (PARTITION BY n.speaker_id ORDER BY l.total DESC NULLS LAST, f.segment_id) AS r,
        count(*) OVER (PARTITION BY n.speaker_id) AS n
    FROM force f JOIN known n ON {_KEY.format('f.speaker_id')} = n.k LEFT JOIN latest l ON l.segment_id = f.segment_id AND l.rn = 1
    WHERE f.rn = 1)
"""
_TIES = f"""
WITH RECURSIVE known AS (SELECT {_KEY.format('speaker_id')} AS k, min(speaker_id) AS speaker_id FROM speakers GROUP BY 1),
clips AS (
    SELECT clip_id, n.speaker_id AS s, nullif(regexp_extract(lower(wav), 'rec_[0-9]+'), '') AS w
    FROM curated_tts_manifest c LEFT JOIN known n ON {_KEY.format('c.speaker_id')} = n.k WHERE clip_id IS NOT NULL),
keys AS (
    SELECT 'c' || clip_id AS a, '0' || s AS b FROM clips WHERE s IS NOT NULL
    UNION SELECT 'c' || clip_id, '1' || w FROM clips WHERE w IS NOT NULL
    UNION SELECT 'c' || clip_id, '2' || clip_id FROM clips),
edges AS (SELECT x.b AS a, min(y.b) AS b FROM keys x JOIN keys y ON x.a = y.a WHERE x.b > y.b GROUP BY x.b, y.b),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reached AS (SELECT DISTINCT b AS node, b AS other FROM keys UNION SELECT r.node, e.b FROM reached r JOIN both_ways e ON r.other = e.a),
root AS (SELECT node, min(other) AS root FROM reached GROUP BY 1),
grouped AS (SELECT DISTINCT CAST(substring(k.a, 2) AS BIGINT) AS clip_id, substring(min(r.root) OVER (PARTITION BY k.a), 2) AS group_key FROM keys k JOIN root r ON k.b = r.node)
"""
_WORDS = r"regexp_extract_all(lower(nfc_normalize(text)), '[\p{L}\p{N}]+')"
_WINDOWS = f"""
WITH item_words AS (SELECT item_id, {_WORDS} AS w FROM eval_items WHERE text IS NOT NULL),
item_windows AS (
    SELECT DISTINCT item_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS passage
    FROM (SELECT item_id, w, least(12, len(w)) AS n, unnest(range(1, len(w) - least(12, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
doc_windows AS (
    SELECT DISTINCT doc_id, n, array_to_string(w[i:i + n - 1], ' ') AS passage
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)),
held AS (SELECT DISTINCT doc_id, item_id, i FROM doc_windows JOIN item_windows USING (n, passage))
"""
_COMMON = ", ".join(f"'{w}'" for w in sorted({x for words in COMMON.values() for x in words.split()}))
ORACLE: dict[str, str] = {
    "p2_found": _TIES + "SELECT clip_id, group_key FROM grouped",
    "p2_splits": _TIES
    + """, sized AS (SELECT group_key AS g, count(*) AS n FROM grouped GROUP BY 1),
    placed AS (SELECT g, n, row_number() OVER (ORDER BY n DESC, md5(g || ' 0'), g) AS no, row_number() OVER (PARTITION BY n ORDER BY md5(g || ' 0'), g) AS within, sum(n) OVER () AS total FROM sized),
    dealt AS (
        SELECT CAST(0 AS BIGINT) AS no, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b, CAST(0 AS DOUBLE) AS c, CAST(0 AS BIGINT) AS size, '' AS split
        UNION ALL
        SELECT p.no, d.a + CASE WHEN s = 'train' THEN p.n ELSE 0 END, d.b + CASE WHEN s = 'validation' THEN p.n ELSE 0 END, d.c + CASE WHEN s = 'test' THEN p.n ELSE 0 END, CAST(p.n AS BIGINT), s
        FROM (SELECT q.*, e.a AS ea, e.b AS eb, e.c AS ec, CASE WHEN 0.8 * total - e.a >= greatest(0.1 * total - e.b, 0.1 * total - e.c) THEN 'train' WHEN 0.1 * total - e.b >= 0.1 * total - e.c THEN 'validation' ELSE 'test' END AS s
            FROM placed q JOIN dealt e ON q.no = e.no + 1) p JOIN dealt d ON p.no = d.no + 1),
    quota AS (SELECT size, split, count(*) AS k FROM dealt WHERE no > 0 GROUP BY 1, 2),
    upto AS (SELECT size, split, sum(k) OVER (PARTITION BY size ORDER BY CASE split WHEN 'train' THEN 1 WHEN 'validation' THEN 2 ELSE 3 END) AS most, k FROM quota)
    SELECT r.clip_id, r.group_key, u.split FROM grouped r JOIN placed p ON r.group_key = p.g JOIN upto u ON u.size = p.n AND p.within <= u.most AND p.within > u.most - u.k""",
    "p7_found": _WINDOWS + "SELECT DISTINCT doc_id, item_id FROM held",
    "p7_verbatim": _WINDOWS + "SELECT item_id, count(DISTINCT doc_id) AS n_docs, count(*) AS n_windows FROM held GROUP BY 1",
    "p9_counts": rf"""WITH t AS (SELECT doc_id, length(text) AS n_chars, text, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+(?:[''’-][\p{{L}}\p{{N}}]+)*') AS w,
        length(regexp_replace(text, '[\s\p{{Z}}\x{{1C}}-\x{{1F}}\x{{85}}\x{{0B}}]+', '', 'g')) AS ink, length(regexp_replace(text, '[^\p{{L}}\p{{N}}]+', '', 'g')) AS solid,
        list_filter(regexp_split_to_array(replace(text, chr(13), chr(10)), '\n'), lambda s: length(regexp_replace(s, '[\s\p{{Z}}\x{{1C}}-\x{{1F}}\x{{85}}\x{{0B}}]+', '', 'g')) > 0) AS l FROM documents)
        SELECT doc_id, n_chars, len(w) AS n_words, CASE WHEN len(w) > 0 THEN round(list_sum(list_transform(w, lambda x: length(x))) / len(w), 6) WHEN text IS NOT NULL THEN 0.0 END AS mean_word_length,
        CASE WHEN ink > 0 THEN round(1 - solid / ink, 6) WHEN text IS NOT NULL THEN 0.0 END AS symbol_ratio,
        CASE WHEN len(l) > 0 THEN round(len(list_filter(l, lambda s: regexp_matches(s, '[.!?…。؟][''"”’»)\] \t\r]*$'))) / len(l), 6) WHEN text IS NOT NULL THEN 0.0 END AS line_end_ratio,
        CASE WHEN len(w) > 0 THEN round(len(list_filter(w, lambda x: x IN ({_COMMON}))) / len(w), 6) WHEN text IS NOT NULL THEN 0.0 END AS common_ratio FROM t""",
    "p6_found": _SCORED + "SELECT segment_id FROM ranked WHERE r > 50",
    "p6_share": _SCORED
    + """, counts AS (SELECT speaker_id, max(n) AS n FROM ranked GROUP BY 1),
levels AS (SELECT c.n AS c, (SELECT sum(least(x.n, c.n)) FROM counts x) AS total FROM (SELECT DISTINCT unnest(range(1, (SELECT max(n) + 1 FROM counts))) AS n) c),
cap AS (SELECT coalesce(max(c), (SELECT min(n) FROM counts)) AS c FROM levels WHERE c <= 0.01 * total + 1e-9)
SELECT speaker_id, count(*) AS n_segments, count(*) FILTER (WHERE r <= (SELECT c FROM cap)) AS n_kept,
    min(CASE WHEN r <= (SELECT c FROM cap) THEN score END) AS lowest_kept FROM ranked GROUP BY 1""",
}
