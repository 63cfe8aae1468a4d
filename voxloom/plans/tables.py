"""Queries over the lexicon, provenance, metrics, profiles, windows, streams and relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.functions import grammar, reports
from voxloom.functions.readings import in_force
from voxloom.operators import curation, lanes, lexicon, metrics, profiles, upsert
from voxloom.operators.lineage import remove, scratch
from voxloom.plans.corpus import _NORM, _WORDS, _q, _t
from voxloom.sources import html
from voxloom.streaming import events as ev


def word_info(t) -> DataFrame:
    o = t("g2p_overrides").dropDuplicates(["override_id"])
    words = o.select("lang", "word").distinct().withColumn("word_id", F.xxhash64("lang", "word"))
    prons = o.select(F.xxhash64("lang", "word").alias("word_id"), "ipa", F.coalesce("dialect", F.lit("?")).alias("dialect"))
    defs = t("g2p_rules").select(F.xxhash64("lang", "pattern").alias("word_id"), F.col("priority").alias("definition_order"), F.col("ipa").alias("definition_text"))
    examples = o.where("notes <> ''").select(F.xxhash64("lang", "word").alias("word_id"), F.col("notes").alias("sentence_text"))
    out = lexicon.word_records(words, defs, prons, examples)
    return out.select("lang", "word", F.size("definitions").alias("n_definitions"), F.array_join(F.transform("pronunciations", lambda p: F.concat(p["ipa"], F.lit("@"), p["dialect"])), "|").alias("pronunciations"), F.array_join(F.col("examples.sentence_text"), "|").alias("examples"))


def _sources(t, late: bool) -> DataFrame:
    rows = t("documents").where("source IS NOT NULL AND fetched_at IS NOT NULL")
    rows = rows.where(F.col("fetched_at") >= "2025-07-01" if late else F.col("fetched_at") < "2025-07-01")
    return rows.groupBy(F.col("source").alias("source_name")).agg(F.max_by("doc_ref", F.struct("fetched_at", "doc_id")).alias("notes"), F.max(F.lit(None).cast("string")).alias("source_type"), F.max(F.lit(None).cast("string")).alias("source_url"), F.max(F.lit(None).cast("string")).alias("license"))


def source_upsert(t) -> DataFrame:
    cols = ["source_name", "source_type", "source_url", "license", "notes", "reliability_score"]
    current = _sources(t, False).withColumn("reliability_score", F.lit(1.0)).withColumn("source_type", F.lit("general_reference")).select(*cols)
    return upsert.register_sources(current, _sources(t, True)).select("source_name", "notes", F.round("reliability_score", 6).alias("score"))


def change_log(t) -> DataFrame:
    """Differences between the first and the last scoring of every segment."""
    s = t("segment_scores").where("segment_id IS NOT NULL").distinct()
    one = s.groupBy("segment_id").agg(F.min(F.struct("scored_at", "clarity", "total")).alias("a"), F.max(F.struct("scored_at", "clarity", "total")).alias("b"))
    old, new = (one.select("segment_id", *[F.round(f"{x}.{f}", 1).alias(f) for f in ("clarity", "total")]) for x in ("a", "b"))
    return upsert.changes(old, new, "segment_id", ["clarity", "total"], "rescored")


def reliability_reassess(t) -> DataFrame:
    rows = _sources(t, False).select("source_name", F.lit(None).cast("string").alias("source_type"), F.lit(None).cast("string").alias("source_url"), F.lit(2.5).alias("reliability_score"))
    return upsert.reassess(rows)[1].select("source_name", "old_value", F.round(F.col("new_value").cast("double"), 6).alias("new_score"))


def phoneme_coverage(t) -> DataFrame:
    wanted = t("language_profiles").select("lang", F.explode("phoneme_inventory").alias("phoneme"))
    seen = t("curated_tts_manifest").select("lang", F.explode(F.split("phonemes", "")).alias("phoneme")).where("phoneme <> ''")
    return metrics.coverage(wanted, seen, "lang", "phoneme").select("lang", "n_wanted", "n_seen", F.round("coverage", 6).alias("coverage"))


def _mix(t) -> DataFrame:
    return t("language_profiles").select("lang", F.explode("curation_targets.target_dialect_mix").alias("dialect", "weight"))


def dialect_jsd(t) -> DataFrame:
    seconds = t("curated_tts_manifest").where("duration_s > 0").groupBy("lang", "dialect").agg(F.sum("duration_s").alias("weight"))
    return metrics.jensen_shannon(seconds, _mix(t), "lang", "dialect", "weight").select("lang", F.round("jsd", 6).alias("jsd"))


def gap_projection(t) -> DataFrame:
    minutes = t("curated_tts_manifest").groupBy("lang", "dialect").agg((F.sum("duration_s") / 60).alias("minutes"))
    target = t("language_profiles").select("lang", "dialect", F.col("curation_targets.min_minutes_90").alias("minutes")).where("minutes IS NOT NULL")
    return metrics.gaps(minutes, target, ["lang", "dialect"], "minutes").select("lang", "dialect", F.round("actual", 6).alias("actual"), F.round("target", 6).alias("target"), F.round("gap", 6).alias("gap"), reports.traffic_light(F.round("actual", 6), F.col("target")).alias("light"))


def voice_inventory(t) -> DataFrame:
    """Speakers with at least half a minute of clips."""
    return t("curated_tts_manifest").where("speaker_id IS NOT NULL AND duration_s IS NOT NULL").groupBy("speaker_id").agg(F.count(F.lit(1)).alias("clips"), F.round(F.sum("duration_s") / 60, 6).alias("minutes")).where("minutes >= 0.5")


def profile_inherit(t) -> DataFrame:
    p = t("language_profiles").withColumn("rate", F.col("tts_defaults.speaking_rate")).withColumn("minutes", F.col("curation_targets.min_minutes_90"))
    return profiles.inherited(p, ["tts_strategy", "rate", "minutes"])


def latest_score(t) -> DataFrame:
    """The total of each segment's latest row; rows without a segment are one group, which is aggregated before it is shuffled."""
    return t("segment_scores").groupBy("segment_id").agg(F.max(F.struct("scored_at", "total")).alias("last")).select("segment_id", "last.total")


def score_trend(t) -> DataFrame:
    """Mean total per day with the day before and a running mean of seven days."""
    daily = t("segment_scores").where("total BETWEEN 0 AND 100").groupBy(F.to_date("scored_at").alias("day")).agg(F.avg("total").alias("mean_total"), F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("day")  # one row per day: bounded by the calendar
    return daily.select("day", "n", F.round("mean_total", 6).alias("mean_total"), F.round(F.lag("mean_total").over(w), 6).alias("day_before"), F.round(F.avg("mean_total").over(w.rowsBetween(-6, 0)), 6).alias("week_mean"))


def daily_budget(t) -> DataFrame:
    rows = t("audio_segments").select("segment_id", "lang", F.to_date("ingested_at").alias("day"), (F.col("end_s") - F.col("start_s")).alias("seconds"), "ingested_at").where("seconds > 0").distinct()
    marked = curation.within_budget(rows, [F.col("lang"), F.col("day")], [F.col("ingested_at"), F.col("segment_id"), F.col("seconds")], "seconds", 60.0)
    return marked.groupBy("day").agg(F.count_if("within_budget").alias("n_within"), F.count(F.lit(1)).alias("n"))


def html_extract(t) -> DataFrame:
    """Word pages made of overrides and read again."""
    o = t("g2p_overrides").dropDuplicates(["override_id"])
    page = F.concat(
        F.lit("<html><body><h1>"), "word", F.lit("</h1><ul><li><span class='IPA'>"), "ipa", F.lit("</span></li></ul><ol><li>sound of <span>"), "word", F.lit("</span></li><li>in "), "lang",
        F.lit("</li></ol><dl><dd>an example[3] of "), "word", F.lit("</dd><dd>no</dd></dl><div class='usage-example'>say "), "word", F.lit(" twice</div><div id='Synonyms'><ul><li><a href='#'>"), "word", F.lit("</a></li></ul></div></body></html>"),
    )
    read = html.with_record(o.select("override_id", page.alias("html")), "html")
    return read.select("override_id", F.array_join("definitions", "|").alias("definitions"), F.array_join("pronunciations", "|").alias("pronunciations"), F.array_join("related_words", "|").alias("related"), F.array_join("examples", "|").alias("examples"))


def word_cards(t) -> DataFrame:
    """Cards with all sections; more items than a section shows, and definitions that are too long."""
    o = t("g2p_overrides").dropDuplicates(["override_id"])
    many = lambda n, *parts: F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts], F.lit(" "), i.cast("string")))
    word = F.col("word")
    card = reports.word_card(
        {
            "word": word,
            "language": F.col("lang"),
            "definitions": F.concat(F.array(F.repeat(F.concat(word, F.lit("  ")), 60)), many(16, "sound  of ", word)),
            "pronunciations": many(12, F.col("ipa")),
            "examples": many(11, "say ", word),
            "part_of_speech": many(6, "noun"),
            "etymology": many(3, "from ", word),
            "related_words": many(11, word),
            "url": F.when(F.col("override_id") % 2 == 0, F.concat(F.lit("https://example.org/"), word)),
            "scrape_date": F.lit("2025-01-01"),
        }
    )
    return o.select("override_id", card.alias("card"))


def _events(t) -> DataFrame:
    return ev.with_time(t("events"))


def stream_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily throughput by a stream over the events that are there."""
    base = scratch(spark, "stream")
    schema = _t(spark, sf, "events").schema
    # a file source takes folders or patterns: the table's own file, whatever it is called
    stream = ev.stream_table(spark, f"{sf}/event[s].parquet", schema)
    ev.run_available(ev.throughput(ev.with_time(stream), "ts", "1 day", keys=["event_type"], value="value"), f"{base}/out", f"{base}/state")
    remove(spark, f"{base}/state")
    return spark.read.parquet(f"{base}/out")


def rollup_revenue(t) -> DataFrame:
    li = t("lineitem").select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    rows = li.join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.rollup("r_name", "n_name").agg(F.round(F.sum("revenue"), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


def _scored_segments(t) -> DataFrame:
    """Segments in force with their latest total, if any, and their seconds."""
    rows = in_force(t("audio_segments"), ["segment_id", "lang", "start_s", "end_s", "ingested_at"])
    return rows.join(latest_score(t), "segment_id", "left").withColumn("seconds", F.greatest(F.lit(0.0), F.col("end_s") - F.col("start_s")))


def acceptance(t) -> DataFrame:
    """Segments of each language and how many of them have a total from 70 to 100."""
    done = metrics.outcomes(_scored_segments(t), ["lang"], F.col("total").between(70, 100))
    return done.withColumn("success_rate", F.round("success_rate", 6))


def cost_per_hour(t) -> DataFrame:
    """A cent for every second that came in, over the hours that were accepted."""
    ok = F.coalesce(F.col("total").between(70, 100), F.lit(False))
    out = metrics.cost_per_hour(_scored_segments(t), ["lang"], F.col("seconds") * 0.01, F.col("seconds"), ok)
    return out.select("lang", *[F.round(c, 4).alias(c) for c in ("hours", "cost", "cost_per_hour")])


def freshness(t) -> DataFrame:
    """Rows of each lane that are at most 90 days older than the lane's latest, and how many hours old the latest is by the clock of all."""
    kept = metrics.retained(t("audio_segments").select("lang", "ingested_at"), "ingested_at", 90)
    newest = t("audio_segments").agg(F.max("ingested_at")).scalar()
    return kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.max("ingested_at").alias("last")).select("lang", "n", ((F.unix_micros(newest) - F.unix_micros("last")) / 3.6e9).alias("hours_old")).withColumn("hours_old", F.round("hours_old", 4))


def curator_lane(t) -> DataFrame:
    """The card of the curated clips of each language, and how many rows were rejected for what."""
    _, rejected, card = lanes.curator_lane(t("curated_tts_manifest"))
    out = card.select("lang", F.lit("curated").alias("what"), F.col("clips").alias("n"), F.round("minutes", 6).alias("minutes"))
    counts = rejected.groupBy(F.col("code").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return out.unionByName(counts.select(F.lit("all").alias("lang"), "what", "n", F.lit(None).cast("double").alias("minutes")))


QUERIES = {
    "acceptance": _q(acceptance),
    "cost_per_hour": _q(cost_per_hour),
    "freshness": _q(freshness),
    "curator_lane": _q(curator_lane),
    "word_exists": _q(lambda t: lexicon.existing(t("eval_items").select("item_id", "lang", F.explode(grammar.words_of(F.col("text"))).alias("word")).distinct(), t("curated_tts_manifest").select("lang", F.explode(grammar.words_of(F.col("text"))).alias("word")), ["lang", "word"])),
    "word_info": _q(word_info),
    "unprocessed": _q(lambda t: lexicon.unprocessed(t("g2p_overrides"), "dialect", "notes").select("override_id").distinct()),
    "insert_if_absent": _q(lambda t: lexicon.insert_if_absent(t("g2p_rules").groupBy("lang", "pattern").agg(F.min("ipa").alias("ipa")), t("g2p_overrides").select("lang", F.substring("word", 1, 2).alias("pattern"), "ipa"), ["lang", "pattern"])),
    "fk_violations": _q(lambda t: lexicon.orphans(t("segment_scores"), t("audio_segments"), "segment_id", "segment_id").select("segment_id", F.unix_micros("scored_at").alias("scored_us")).distinct()),
    "unique_violations": _q(lambda t: lexicon.duplicates(t("audio_segments"), ["segment_id"])),
    "check_violations": _q(lambda t: lexicon.out_of_range(t("segment_scores"), "total", 0, 100).select("segment_id", "total").distinct()),
    "source_upsert": _q(source_upsert),
    "change_log": _q(change_log),
    "reliability_reassess": _q(reliability_reassess),
    "assign_ids": _q(lambda t: upsert.assign_ids(t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")), t("documents").select(F.col("source").alias("name")), "name", "id")),
    "random_sample": _q(lambda t: t("documents").where("source IS NOT NULL").orderBy(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(" 7"))), "doc_id").limit(5).select("doc_id", "source")),
    "phoneme_coverage": _q(phoneme_coverage),
    "dialect_jsd": _q(dialect_jsd),
    "speaker_gini": _q(lambda t: metrics.gini(t("curated_tts_manifest").where("speaker_id IS NOT NULL").groupBy("lang", "speaker_id").agg(F.count(F.lit(1)).alias("n")), "lang", "n").select("lang", F.round("gini", 6).alias("gini"))),
    "gap_projection": _q(gap_projection),
    "voice_inventory": _q(voice_inventory),
    "score_p95": _q(lambda t: metrics.percentiles(t("segment_scores").where("total BETWEEN 0 AND 100").withColumn("month", F.date_format("scored_at", "yyyy-MM")), "month", "total", [0.5, 0.95]).select("month", F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))),
    "pronunciation_error": _q(lambda t: metrics.error_rate(t("g2p_overrides").select("override_id", "word", "ipa").distinct(), "ipa", "word").select("override_id", F.round("error_rate", 6).alias("error_rate"))),
    "fallback_walk": _q(lambda t: profiles.fallback_steps(t("language_profiles"))),
    "fallback_cycles": _q(lambda t: profiles.fallback_cycles(t("language_profiles"))),
    "profile_inherit": _q(profile_inherit),
    "latest_score": _q(latest_score),
    "score_trend": _q(score_trend),
    "daily_budget": _q(daily_budget),
    "html_extract": _q(html_extract),
    "word_cards": _q(word_cards),
    "lane_throughput": _q(lambda t: ev.throughput(_events(t), "ts", "1 day", keys=["event_type"], value="value").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 2).alias("total"))),
    "sliding_throughput": _q(lambda t: ev.throughput(_events(t), "ts", "1 day", "6 hours").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")),
    "event_sessions": _q(lambda t: ev.sessions(_events(t), "ts", "30 minutes", ["user_id"]).select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n")),
    "late_dedupe": _q(lambda t: ev.without_late_duplicates(_events(t).unionByName(_events(t).where("event_id % 10 = 0")), "ts", "event_id", "1 day").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))),
    "batch_status": _q(lambda t: ev.batch_status(t("events").select((F.col("event_id") % 500).alias("batch_id"), F.when(F.col("event_type") == "purchase", "validate").otherwise(F.col("event_type")).alias("stage"), F.when(F.col("value") > 499, "too much").alias("error"))).select("batch_id", "status", F.array_join("stages", ",").alias("stages"))),
    "stream_daily": lambda spark, sf: stream_daily(spark, sf).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 2).alias("total")),
    "rollup_revenue": _q(rollup_revenue),
    "top_customers": _q(lambda t: t("orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spent")).orderBy(F.desc("spent"), "o_custkey").limit(20)),
    "set_operations": _q(lambda t: t("customer").select(F.col("c_nationkey").alias("k")).intersect(t("supplier").select(F.col("s_nationkey").alias("k"))).withColumn("kind", F.lit("both")).unionByName(t("nation").select(F.col("n_nationkey").alias("k")).exceptAll(t("supplier").select(F.col("s_nationkey").alias("k")).distinct()).withColumn("kind", F.lit("no supplier")))),
    "anti_join": _q(lambda t: t("customer").join(t("orders").where("o_orderdate >= '1997-01-01'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")),
}

_PAIRS = "SELECT DISTINCT override_id, lang, dialect, word, ipa, notes, updated_at FROM g2p_overrides"
_DAILY = "SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2"
_SRC = "SELECT source AS source_name, arg_max(doc_ref, (fetched_at, doc_id)) AS notes FROM documents WHERE source IS NOT NULL AND fetched_at {0} TIMESTAMPTZ '2025-07-01 00:00:00+00' GROUP BY 1"
_REL = """CASE WHEN contains(lower(source_name), 'forum') OR contains(lower(source_name), 'wiki') OR contains(lower(source_name), 'blog') OR contains(lower(source_name), 'user') OR contains(lower(source_name), 'community')
    THEN 1.5 + 0.1 * (CAST(contains(lower(source_name), 'forum') AS INT) + CAST(contains(lower(source_name), 'discussion') AS INT) + CAST(contains(lower(source_name), 'user') AS INT) + CAST(contains(lower(source_name), 'comment') AS INT) + CAST(contains(lower(source_name), 'blog') AS INT)) ELSE 2.5 END"""
_STEPS = """SELECT profile_id, lang, dialect, 0 AS step, dialect AS fallback FROM language_profiles UNION ALL
    SELECT profile_id, lang, dialect, CAST(i AS INT), f FROM (SELECT profile_id, lang, dialect, unnest(fallback_chain) AS f, generate_subscripts(fallback_chain, 1) AS i FROM language_profiles)"""
_SCORED = """WITH f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY ingested_at DESC NULLS LAST, lang DESC, start_s DESC, end_s DESC) AS rn FROM audio_segments WHERE segment_id IS NOT NULL) WHERE rn = 1),
    s AS (SELECT segment_id, total FROM (SELECT segment_id, total, row_number() OVER (PARTITION BY segment_id ORDER BY scored_at DESC NULLS LAST, total DESC NULLS LAST) AS rn FROM segment_scores WHERE segment_id IS NOT NULL) WHERE rn = 1),
    j AS (SELECT lang, greatest(0.0, end_s - start_s) AS seconds, coalesce(total BETWEEN 70 AND 100, false) AS ok FROM f LEFT JOIN s USING (segment_id))"""
ORACLE = {
    "acceptance": _SCORED + " SELECT lang, count(*) AS processed, count(*) FILTER (WHERE ok) AS succeeded, count(*) FILTER (WHERE NOT ok) AS failed, round(count(*) FILTER (WHERE ok) / count(*), 6) AS success_rate FROM j GROUP BY 1",
    "cost_per_hour": _SCORED + """ SELECT lang, round(h, 4) AS hours, round(c, 4) AS cost, CASE WHEN h > 0 THEN round(c / h, 4) END AS cost_per_hour FROM (SELECT lang, coalesce(sum(seconds) FILTER (WHERE ok), 0) / 3600 AS h, coalesce(sum(seconds * 0.01), 0) AS c FROM j GROUP BY 1)""",
    "freshness": """WITH m AS (SELECT max(ingested_at) AS x FROM audio_segments) SELECT lang, count(*) AS n, round((epoch_us(any_value(x)) - epoch_us(max(ingested_at))) / 3.6e9, 4) AS hours_old FROM audio_segments, m WHERE ingested_at IS NULL OR ingested_at >= x - INTERVAL 90 DAYS GROUP BY 1""",
    "curator_lane": rf"""WITH d AS (SELECT DISTINCT * FROM curated_tts_manifest), l AS (SELECT DISTINCT clip_id, code FROM (
            SELECT clip_id, 'DURATION' AS code FROM d WHERE NOT coalesce(duration_s, 0) BETWEEN 1.5 AND 14.0 OR isnan(duration_s) UNION ALL SELECT clip_id, 'NO_TEXT_OR_PHONEMES' FROM d WHERE coalesce(text, '') = '' AND coalesce(phonemes, '') = '') WHERE clip_id IS NOT NULL),
        g AS (SELECT *, nullif({_NORM.format('text')}, '') AS h FROM d WHERE clip_id NOT IN (SELECT clip_id FROM l)),
        c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, h, CASE WHEN h IS NULL THEN clip_id END ORDER BY clip_id) AS rn FROM g) WHERE rn = 1)
        SELECT lang, 'curated' AS what, count(*) AS n, round(coalesce(sum(duration_s), 0) / 60, 6) AS minutes FROM c GROUP BY 1
        UNION ALL SELECT 'all', code, count(*), NULL FROM (SELECT clip_id, code FROM l UNION ALL SELECT clip_id, 'DUPLICATE' FROM (SELECT DISTINCT clip_id FROM g) WHERE clip_id NOT IN (SELECT clip_id FROM c)) GROUP BY 2""",
    "word_exists": rf"""WITH c AS (SELECT DISTINCT lang, unnest({_WORDS.replace('sentence', 'text')}) AS word FROM curated_tts_manifest), i AS (SELECT DISTINCT item_id, lang, unnest({_WORDS.replace('sentence', 'text')}) AS word FROM eval_items)
        SELECT i.lang, i.word, i.item_id FROM i WHERE EXISTS (SELECT 1 FROM c WHERE c.lang = i.lang AND c.word = i.word)""",
    "word_info": f"""SELECT lang, word, CAST(coalesce((SELECT count(*) FROM g2p_rules r WHERE r.lang = o.lang AND r.pattern = o.word), 0) AS INT) AS n_definitions,
        array_to_string(list_transform(list_sort(list({{'i': ipa, 'd': coalesce(dialect, '?')}})), lambda p: p.i || '@' || p.d), '|') AS pronunciations,
        coalesce(array_to_string(list_sort(list(notes) FILTER (WHERE notes <> '')), '|'), '') AS examples FROM ({_PAIRS}) o GROUP BY lang, word""",
    "unprocessed": "SELECT DISTINCT override_id FROM g2p_overrides WHERE dialect IS NULL OR notes IS NULL",
    "insert_if_absent": """WITH c AS (SELECT lang, pattern, min(ipa) AS ipa FROM g2p_rules GROUP BY 1, 2) SELECT * FROM c UNION ALL
        SELECT lang, pattern, min(ipa) FROM (SELECT lang, substring(word, 1, 2) AS pattern, ipa FROM g2p_overrides) i WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = i.lang AND c.pattern = i.pattern) GROUP BY 1, 2""",
    "fk_violations": "SELECT DISTINCT segment_id, epoch_us(scored_at) AS scored_us FROM segment_scores s WHERE segment_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM audio_segments a WHERE a.segment_id = s.segment_id)",
    "unique_violations": "SELECT segment_id, count(*) AS n FROM audio_segments WHERE segment_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "check_violations": "SELECT DISTINCT segment_id, total FROM segment_scores WHERE total IS NOT NULL AND (isnan(total) OR NOT total BETWEEN 0 AND 100)",
    "source_upsert": f"""WITH a AS ({_SRC.format('<')}), b AS ({_SRC.format('>=')}) SELECT coalesce(a.source_name, b.source_name) AS source_name, coalesce(b.notes, a.notes) AS notes,
        CAST(round(CASE WHEN a.source_name IS NOT NULL THEN 1.0 ELSE {_REL.replace('source_name', 'b.source_name')} END, 6) AS DOUBLE) AS score FROM a FULL JOIN b ON a.source_name = b.source_name""",
    "change_log": """WITH o AS (SELECT segment_id, arg_min({'c': round(clarity, 1), 't': round(total, 1)}, (scored_at, coalesce(clarity, -1e9), coalesce(total, -1e9))) AS a, arg_max({'c': round(clarity, 1), 't': round(total, 1)}, (scored_at, coalesce(clarity, -1e9), coalesce(total, -1e9))) AS b FROM segment_scores WHERE segment_id IS NOT NULL GROUP BY 1),
        f AS (SELECT segment_id, 'clarity' AS field_name, CAST(a.c AS VARCHAR) AS old_value, CAST(b.c AS VARCHAR) AS new_value FROM o UNION ALL SELECT segment_id, 'total', CAST(a.t AS VARCHAR), CAST(b.t AS VARCHAR) FROM o)
        SELECT *, 'rescored' AS reason FROM f WHERE old_value IS DISTINCT FROM new_value""",
    "reliability_reassess": f"SELECT source_name, '2.5' AS old_value, CAST(round({_REL}, 6) AS DOUBLE) AS new_score FROM ({_SRC.format('<')}) WHERE abs(2.5 - ({_REL})) > 0.01",
    "assign_ids": """SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation UNION ALL SELECT (SELECT max(n_nationkey) FROM nation) + row_number() OVER (ORDER BY source), source
        FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL AND source NOT IN (SELECT n_name FROM nation))""",
    "phoneme_coverage": """SELECT w.lang, count(*) AS n_wanted, count(s.p) AS n_seen, round(count(s.p) / count(*), 6) AS coverage FROM (SELECT DISTINCT lang, p FROM (SELECT lang, unnest(phoneme_inventory) AS p FROM language_profiles) WHERE p IS NOT NULL) w
        LEFT JOIN (SELECT DISTINCT lang, p FROM (SELECT lang, unnest(regexp_extract_all(phonemes, '(?s).')) AS p FROM curated_tts_manifest)) s ON w.lang = s.lang AND w.p = s.p GROUP BY 1""",
    "speaker_gini": """WITH n AS (SELECT lang, speaker_id, count(*) AS v FROM curated_tts_manifest WHERE speaker_id IS NOT NULL GROUP BY 1, 2), r AS (SELECT lang, v, row_number() OVER (PARTITION BY lang ORDER BY v) AS i, count(*) OVER (PARTITION BY lang) AS m FROM n)
        SELECT lang, round(2.0 * sum(i * v) / (max(m) * sum(v)) - (max(m) + 1.0) / max(m), 6) AS gini FROM r GROUP BY 1""",
    "dialect_jsd": """WITH a AS (SELECT lang, dialect, sum(duration_s) AS w FROM curated_tts_manifest WHERE duration_s > 0 AND dialect IS NOT NULL GROUP BY 1, 2),
        b AS (SELECT lang, dialect, sum(w) AS w FROM (SELECT lang, unnest(map_keys(curation_targets.target_dialect_mix)) AS dialect, unnest(map_values(curation_targets.target_dialect_mix)) AS w FROM language_profiles) WHERE w > 0 GROUP BY 1, 2),
        p AS (SELECT lang, dialect, w / sum(w) OVER (PARTITION BY lang) AS p FROM a), q AS (SELECT lang, dialect, w / sum(w) OVER (PARTITION BY lang) AS q FROM b),
        j AS (SELECT coalesce(p.lang, q.lang) AS lang, coalesce(p, 0) AS p, coalesce(q, 0) AS q FROM p FULL JOIN q ON p.lang = q.lang AND p.dialect = q.dialect)
        SELECT lang, round(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 6) AS jsd FROM j
        WHERE lang IN (SELECT lang FROM a) AND lang IN (SELECT lang FROM b) GROUP BY 1""",
    "gap_projection": """WITH a AS (SELECT lang, dialect, sum(duration_s) / 60 AS m FROM curated_tts_manifest GROUP BY 1, 2), t AS (SELECT lang, dialect, sum(curation_targets.min_minutes_90) AS m FROM language_profiles WHERE curation_targets.min_minutes_90 IS NOT NULL GROUP BY 1, 2)
        SELECT t.lang, t.dialect, round(coalesce(a.m, 0), 6) AS actual, round(t.m, 6) AS target, round(greatest(0, t.m - coalesce(a.m, 0)), 6) AS gap,
        CASE WHEN round(coalesce(a.m, 0), 6) >= t.m THEN 'green' WHEN round(coalesce(a.m, 0), 6) >= 0.85 * t.m THEN 'yellow' ELSE 'red' END AS light FROM t LEFT JOIN a ON a.lang = t.lang AND a.dialect = t.dialect""",
    "voice_inventory": "SELECT speaker_id, count(*) AS clips, round(sum(duration_s) / 60, 6) AS minutes FROM curated_tts_manifest WHERE speaker_id IS NOT NULL AND duration_s IS NOT NULL GROUP BY 1 HAVING round(sum(duration_s) / 60, 6) >= 0.5",
    "score_p95": "SELECT strftime(scored_at AT TIME ZONE 'UTC', '%Y-%m') AS month, round(quantile_cont(total, 0.5), 6) AS p50, round(quantile_cont(total, 0.95), 6) AS p95 FROM segment_scores WHERE total BETWEEN 0 AND 100 GROUP BY 1",
    "fallback_walk": _STEPS,
    "fallback_cycles": """WITH RECURSIVE e AS (SELECT DISTINCT dialect AS a, b FROM (SELECT dialect, unnest(fallback_chain) AS b FROM language_profiles) WHERE b IS NOT NULL AND dialect IS NOT NULL),
        p AS (SELECT a AS dialect, b AS place, 1 AS n FROM e UNION SELECT p.dialect, e.b, n + 1 FROM p JOIN e ON p.place = e.a WHERE p.dialect <> p.place AND n <= (SELECT count(*) FROM e)) SELECT dialect, CAST(min(n) AS INT) AS length FROM p WHERE dialect = place GROUP BY 1""",
    "profile_inherit": f"""WITH s AS ({_STEPS}), p AS (SELECT dialect, arg_max(tts_strategy, (coalesce(updated_at, TIMESTAMPTZ '0001-01-01'), profile_id)) FILTER (WHERE tts_strategy IS NOT NULL) AS tts_strategy, arg_max(tts_defaults.speaking_rate, (coalesce(updated_at, TIMESTAMPTZ '0001-01-01'), profile_id)) FILTER (WHERE tts_defaults.speaking_rate IS NOT NULL) AS rate, arg_max(curation_targets.min_minutes_90, (coalesce(updated_at, TIMESTAMPTZ '0001-01-01'), profile_id)) FILTER (WHERE curation_targets.min_minutes_90 IS NOT NULL) AS minutes FROM language_profiles GROUP BY 1)
        SELECT profile_id, arg_min(p.tts_strategy, step) FILTER (WHERE p.tts_strategy IS NOT NULL) AS tts_strategy, arg_min(p.rate, step) FILTER (WHERE p.rate IS NOT NULL) AS rate, arg_min(p.minutes, step) FILTER (WHERE p.minutes IS NOT NULL) AS minutes FROM s LEFT JOIN p ON p.dialect = s.fallback GROUP BY 1""",
    "latest_score": "SELECT segment_id, total FROM (SELECT segment_id, total, row_number() OVER (PARTITION BY segment_id ORDER BY scored_at DESC NULLS LAST, total DESC NULLS LAST) AS rn FROM segment_scores) WHERE rn = 1",
    "random_sample": "SELECT doc_id, source FROM documents WHERE source IS NOT NULL ORDER BY md5(doc_id || ' 7'), doc_id LIMIT 5",
    "score_trend": """WITH d AS (SELECT CAST(scored_at AT TIME ZONE 'UTC' AS DATE) AS day, avg(total) AS m, count(*) AS n FROM segment_scores WHERE total BETWEEN 0 AND 100 GROUP BY 1)
        SELECT day, n, round(m, 6) AS mean_total, round(lag(m) OVER (ORDER BY day), 6) AS day_before, round(avg(m) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS week_mean FROM d""",
    "html_extract": f"SELECT override_id, 'sound of ' || word || ' ' || word || '|in ' || lang AS definitions, ipa AS pronunciations, word AS related, 'an example of ' || word || '|say ' || word || ' twice' AS examples FROM ({_PAIRS})",
    "word_cards": f"""SELECT override_id, '**Word:** ' || word || E'\\n\\n**Language:** ' || lang || E'\\n\\n**Definitions:**\\n    1. ' || CASE WHEN length(long) > 100 THEN long[1:97] || '...' ELSE long END || E'\\n'
        || array_to_string([('    ' || (i + 1) || '. sound of ' || word || ' ' || i) FOR i IN range(1, 15)], E'\\n') || E'\\n\\n**Pronunciations:**\\n' || array_to_string([('    • ' || ipa || ' ' || i) FOR i IN range(1, 11)], E'\\n')
        || E'\\n\\n**Examples:**\\n' || array_to_string([('    • "say ' || word || ' ' || i || '"') FOR i IN range(1, 11)], E'\\n') || E'\\n\\n**Part of Speech:**\\n' || array_to_string([('    • noun ' || i) FOR i IN range(1, 6)], E'\\n')
        || E'\\n\\n**Etymology:**\\n' || array_to_string([('    • from ' || word || ' ' || i) FOR i IN range(1, 3)], E'\\n') || E'\\n\\n**Related Words:**\\n' || array_to_string([('    • ' || word || ' ' || i) FOR i IN range(1, 11)], E'\\n')
        || E'\\n\\n**URL:** ' || CASE WHEN override_id % 2 = 0 THEN 'https://example.org/' || word ELSE 'Not available' END || E'\\n**Scrape Date:** 2025-01-01\\n\\n---' AS card
        FROM (SELECT *, trim(repeat(word || ' ', 60)) AS long FROM ({_PAIRS}))""",
    "lane_throughput": _DAILY,
    "stream_daily": _DAILY,
    "sliding_throughput": "SELECT w AS window_start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 6 HOURS, ts) - i * INTERVAL 6 HOURS FOR i IN range(0, 4)]) AS w FROM events) GROUP BY 1",
    "event_sessions": """WITH m AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS f FROM events), g AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM m)
        SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTES AS session_end, count(*) AS n FROM g GROUP BY user_id, g""",
    "late_dedupe": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "batch_status": """SELECT event_id % 500 AS batch_id, CASE WHEN max(CAST(value > 499 AS INT)) = 1 THEN 'failed' WHEN max(CAST(event_type = 'purchase' AS INT)) = 1 THEN 'succeeded' ELSE 'running' END AS status,
        array_to_string(list_sort(list(DISTINCT CASE WHEN event_type = 'purchase' THEN 'validate' ELSE event_type END)), ',') AS stages FROM events GROUP BY 1""",
    "rollup_revenue": """SELECT r_name, n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY ROLLUP (r_name, n_name)""",
    "top_customers": "SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
    "set_operations": "SELECT k, 'both' AS kind FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT k, 'no supplier' FROM (SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier)",
    "anti_join": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate >= TIMESTAMP '1997-01-01')",
    "daily_budget": """SELECT day, count(*) FILTER (WHERE s <= 60.0) AS n_within, count(*) AS n FROM (SELECT *, sum(seconds) OVER (PARTITION BY lang, day ORDER BY ingested_at, segment_id, seconds ROWS UNBOUNDED PRECEDING) AS s
        FROM (SELECT DISTINCT segment_id, lang, CAST(ingested_at AT TIME ZONE 'UTC' AS DATE) AS day, end_s - start_s AS seconds, ingested_at FROM audio_segments) WHERE seconds > 0) GROUP BY 1""",
}
