"""Operators over tables: upserts, lexicon, metrics, profiles, lanes, streams; and all queries with SQL on the smallest data."""

import math
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.operators import curation, lanes, lexicon, metrics, profiles, upsert
from voxloom.plans import catalog
from voxloom.streaming import events as ev

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merge_and_insert(spark):
    cur = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), (None, 9, "n")], "k string, v int, w string")
    new = spark.createDataFrame([("b", None, "y"), ("c", 3, "z"), (None, 8, None)], "k string, v int, w string")
    assert rows(upsert.merge(cur, new, ["k"])) == sorted([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z"), (None, 8, "n")], key=str)
    got = lexicon.insert_if_absent(cur, new.unionByName(new.withColumn("v", F.lit(0))), ["k"])
    assert rows(got) == sorted([("a", 1, "x"), ("b", 2, None), ("c", 0, "z"), (None, 9, "n")], key=str)


def test_register_and_reassess(spark):
    cols = "source_name string, source_type string, source_url string, license string, notes string, reliability_score double"
    cur = spark.createDataFrame([("Oxford Dictionary", "dictionary", None, None, "old", 1.0)], cols)
    inc = spark.createDataFrame([("Oxford Dictionary", None, "https://oxford.org", None, None), ("A wiki", None, None, "free", None)], "source_name string, source_type string, source_url string, license string, notes string")
    got = {r.source_name: r for r in upsert.register_sources(cur, inc).collect()}
    assert got["Oxford Dictionary"].reliability_score == 1.0 and got["Oxford Dictionary"].notes == "old" and got["Oxford Dictionary"].source_url == "https://oxford.org"
    assert got["A wiki"].source_type == "user_contributed" and got["A wiki"].reliability_score == 1.5
    after, log = upsert.reassess(upsert.register_sources(cur, inc))
    assert log.count() == 1 and log.first().source_name == "Oxford Dictionary"
    assert {r.source_name: round(r.reliability_score, 6) for r in after.collect()} == {"Oxford Dictionary": 4.4, "A wiki": 1.5}


def test_changes_and_ids(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1)], "id int, p string, q int")
    b = spark.createDataFrame([(1, "x", 5), (2, "z", 1), (3, "n", 0)], "id int, p string, q int")
    assert rows(upsert.changes(a, b, "id", ["p", "q"], "r")) == [(1, "q", None, "5", "r"), (2, "p", "y", "z", "r")]
    got = upsert.assign_ids(spark.createDataFrame([(7, "m")], "id int, name string"), spark.createDataFrame([("b",), ("a",), ("m",), (None,), ("a",)], "name string"), "name", "id")
    assert rows(got) == [(7, "m"), (8, "a"), (9, "b")]


def test_constraints(spark):
    c = spark.createDataFrame([(1, 5.0), (2, float("nan")), (None, -1.0), (2, None)], "k int, v double")
    p = spark.createDataFrame([(1,)], "id int")
    assert lexicon.orphans(c, p, "k", "id").count() == 2
    assert rows(lexicon.duplicates(c, ["k"])) == [(2, 2)]
    assert lexicon.out_of_range(c, "v", 0, 5).count() == 2
    assert lexicon.unprocessed(c, "k", "v").count() == 2


def test_metrics(spark):
    p = spark.createDataFrame([("g", "a", 1.0), ("g", "b", 1.0), ("h", "a", 1.0), ("n", "a", None)], "g string, i string, w double")
    q = spark.createDataFrame([("g", "a", 2.0), ("g", "b", 2.0), ("h", "b", 1.0), ("n", "a", 1.0)], "g string, i string, w double")
    assert {r.g: round(r.jsd, 9) for r in metrics.jensen_shannon(p, q, "g", "i", "w").collect()} == {"g": 0.0, "h": 1.0}
    v = spark.createDataFrame([("e", x) for x in (5, 5, 5)] + [("u", x) for x in (0, 0, 10)] + [("z", 0)], "g string, v int")
    got = {r.g: round(r.gini, 9) for r in metrics.gini(v, "g", "v").collect()}
    assert got["e"] == 0 and math.isclose(got["u"], 2 / 3, abs_tol=1e-6) and got["z"] == 0
    cov = metrics.coverage(p.select("g", "i"), q.where("i = 'a'").select("g", "i"), "g", "i")
    assert {r.g: (r.coverage, r.missing) for r in cov.collect()} == {"g": (0.5, ["b"]), "h": (0.0, ["a"]), "n": (1.0, [])}
    pairs = spark.createDataFrame([("g", "a", "b"), ("g", "b", "a"), ("g", "a", "c"), ("g", "a", "a"), ("g", None, "a"), ("h", "a", "b")], "g string, x string, y string")
    seen = spark.createDataFrame([("g", "a"), ("g", "b"), ("g", "a"), ("h", "a"), (None, "b")], "g string, w string")
    assert rows(metrics.pair_coverage(pairs, seen, "g", "x", "y", "w")) == [("g", 2, 1, 0.5), ("h", 1, 0, 0.0)]
    done = spark.createDataFrame([("g", True, 2.0, 3600.0), ("g", False, 1.0, 3600.0), ("g", None, None, None), ("h", False, 5.0, 1.0)], "g string, ok boolean, cost double, s double")
    assert rows(metrics.outcomes(done, ["g"], F.col("ok"))) == [("g", 3, 1, 2, 1 / 3), ("h", 1, 0, 1, 0.0)]
    assert rows(metrics.cost_per_hour(done, ["g"], F.col("cost"), F.col("s"), F.coalesce("ok", F.lit(False)))) == [("g", 1.0, 3.0, 3.0), ("h", 0.0, 5.0, None)]
    days = spark.createDataFrame([(1, "2025-01-01"), (2, "2025-03-01"), (3, "2025-03-05"), (4, None)], "k int, d string").select("k", F.col("d").cast("timestamp").alias("d"))
    assert sorted(r.k for r in metrics.retained(days, "d", 10).collect()) == [2, 3, 4] and metrics.retained(days.limit(0), "d", 10).count() == 0
    many = spark.createDataFrame([("a", float(x)) for x in (5, 1, 4, 2, 3)] + [("b", 7.0), ("b", float("nan")), ("c", None), (None, 1.0), (None, 3.0)], "g string, x double")
    got = metrics.percentiles(many, "g", "x", [0.5, 0.95]).select("g", F.round("p50", 9), F.round("p95", 9))
    assert rows(got) == sorted([("a", 3.0, 4.8), ("b", 7.0, 7.0), (None, 2.0, 2.9)], key=str)
    e = metrics.error_rate(spark.createDataFrame([("abc", "abd"), (None, "ab"), ("x", "")], "h string, w string"), "h", "w")
    assert [r.error_rate for r in e.collect()] == [1 / 3, 1.0, None]


def test_profiles(spark):
    p = spark.createDataFrame([(1, "en", "en-GH", ["en-GB", "en"], None), (2, "en", "en-GB", ["en"], "x"), (3, "en", "en", None, "y"), (4, "aa", "p", ["q"], None), (5, "aa", "q", ["p"], None)], "profile_id int, lang string, dialect string, fallback_chain array<string>, tts_strategy string").withColumn("updated_at", F.lit("2025-01-01").cast("timestamp"))
    later = p.where("profile_id = 2").selectExpr("profile_id + 10 AS profile_id", "lang", "dialect", "fallback_chain", "'newer' AS tts_strategy", "updated_at + interval 1 day AS updated_at")
    assert rows(profiles.inherited(p.unionByName(later), ["tts_strategy"]).where("profile_id < 3")) == [(1, "newer"), (2, "newer")]
    assert rows(profiles.inherited(p, ["tts_strategy"])) == [(1, "x"), (2, "x"), (3, "y"), (4, None), (5, None)]
    assert rows(profiles.fallback_cycles(p)) == [("p", 2), ("q", 2)]
    o = spark.createDataFrame([(1, "en", "en", "cat", "kat", "2025-01-01"), (2, "en", "en-GB", "cat", "kæt", "2025-01-01"), (3, "en", None, "dog", "dɔɡ", "2025-01-01"), (4, "en", "en-GB", "cat", "kæʔ", "2025-02-01")], "override_id int, lang string, dialect string, word string, ipa string, updated_at string")
    w = spark.createDataFrame([("en", "en-GH", "cat"), ("en", "en-GH", "dog"), ("en", "en-GH", "thin")], "lang string, dialect string, word string")
    r = spark.createDataFrame([(1, "en", "en-GH", "th", "θ", None, 1), (2, "en", "en-GH", "t", "T", None, 5), (3, "en", "en-GH", "h", "h!", {"before": "i"}, 0)], "rule_id int, lang string, dialect string, pattern string, ipa string, conditions map<string,string>, priority int")
    got = {x.word: (x.ipa, x.by, x.step) for x in profiles.resolve_pronunciations(w, o, r, p).collect()}
    assert got == {"cat": ("caT", "rule", 0), "dog": ("dɔɡ", "override", 0), "thin": ("Th!in", "rule", 0)}


def test_pronunciations_follow_the_order(spark):
    """Override, then rule, then the chain; IPA isn't read as letters; conditions and word ends hold; letters with accents are letters."""
    p = spark.createDataFrame([(1, "x", "x-a", ["x-b", "x-c"]), (2, "x", "x-b", []), (3, "x", "x-c", None)], "profile_id int, lang string, dialect string, fallback_chain array<string>")
    o = spark.createDataFrame([(1, "x", "x-b", "ok", "B", "1"), (2, "x", "x-a", "own", "A", "1"), (3, "x", None, "own", "any", "1"), (4, "x", None, "all", "any", "1"), (5, "x", "x-c", "far", "C", "1"), (6, "x", None, "ok2", "any", "1")], "override_id int, lang string, dialect string, word string, ipa string, updated_at string")
    rule = lambda i, d, pat, ipa, cond=None, prio=0: (i, "x", d, pat, ipa, cond, prio)
    r = spark.createDataFrame(
        [rule(1, "x-a", "sh", "ʃe"), rule(2, "x-a", "e", "E"), rule(3, "x-a", "^é", "e:"), rule(4, "x-a", "g$", "G"), rule(5, "x-a", "b", "W", {"position": "medial"}), rule(6, "x-a", "u", "U", {"after": "q"}), rule(7, "x-a", "o", "O", {"before": "o"}, 9), rule(8, "x-b", "ok", "rule"), rule(9, "x-a", ".", "!"), rule(10, "x-b", "z", "Z")],
        "rule_id int, lang string, dialect string, pattern string, ipa string, conditions map<string,string>, priority int",
    )
    words = ["own", "all", "ok", "far", "shé", "éshe", "gag", "babb", "quu", "ooo", "zz", "nnn", "a.c"]
    w = spark.createDataFrame([("x", "x-a", x) for x in words] + [("x", None, "all"), ("x", None, "ok"), (None, "x-a", "all")], "lang string, dialect string, word string")
    got = {(x.dialect, x.word): (x.ipa, x.by, x.step) for x in profiles.resolve_pronunciations(w, o, r, p).collect()}
    want = {"own": ("A", "override", 0), "all": ("any", "override", 0), "ok": ("B", "override", 1), "far": ("C", "override", 2), "shé": ("ʃeé", "rule", 0), "éshe": ("e:ʃeE", "rule", 0), "gag": ("gaG", "rule", 0),
            "babb": ("baWb", "rule", 0), "quu": ("qUu", "rule", 0), "ooo": ("OOo", "rule", 0), "zz": ("ZZ", "rule", 1), "nnn": (None, "none", None), "a.c": ("a!c", "rule", 0)}
    assert got == {("x-a", k): v for k, v in want.items()} | {(None, "all"): ("any", "override", 0), (None, "ok"): (None, "none", None)}
    assert profiles.resolve_pronunciations(w.limit(0), o, r, p).count() == 0 and profiles.resolve_pronunciations(w, o.limit(0), r.limit(0), p).where("by <> 'none'").count() == 0


def test_long_fallback_cycles(spark):
    ring = [(f"d{i:02}", [f"d{(i + 1) % 12:02}"]) for i in range(12)] + [("in", ["d03"]), ("self", ["self"]), ("none", None)]
    p = spark.createDataFrame(ring, "dialect string, fallback_chain array<string>")
    assert rows(profiles.fallback_cycles(p)) == [*((f"d{i:02}", 12) for i in range(12)), ("self", 1)]
    assert profiles.fallback_cycles(p.limit(0)).count() == 0


def test_curation(spark):
    d = spark.createDataFrame([(1, "A b!"), (2, "a  B"), (3, None), (4, "c"), (5, None)], "id int, t string")
    assert rows(curation.exact_classes(d, "id", "t")) == [(1, 1, 2), (2, 1, 2), (4, 4, 1)]
    assert [r.id for r in curation.without_duplicates(d, "id", "t").orderBy("id").collect()] == [1, 3, 4, 5]
    b = curation.within_budget(spark.createDataFrame([("g", 1, 5.0), ("g", 2, None), ("g", 3, 6.0)], "g string, t int, v double"), [F.col("g")], [F.col("t")], "v", 10.0)
    assert [r.within_budget for r in b.orderBy("t").collect()] == [True, True, False]
    docs = spark.createDataFrame([("d", "hello world")], "k string, text string")
    s = spark.createDataFrame([("d", 0, 5, "hello"), ("d", 0, 5, "help"), ("x", 0, 1, "h"), ("d", 5, 5, ""), ("d", 6, 60, "world"), ("d", None, 3, "hel")], "ref string, a int, b int, t string")
    assert sorted(r.reason for r in curation.grounding_issues(s, docs, "ref", "a", "b", "t", "k", "text").collect()) == ["no document", "offsets", "offsets", "other text", "out of bounds"]


def test_cosine_search_in_blocks(spark):
    rng = np.random.default_rng(0)
    m = rng.normal(size=(300, 8))
    data = [(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(900, None), (901, [1.0]), (902, [0.0] * 8)]
    df = spark.createDataFrame(data, "id long, v array<double>")
    got = {(r.query_id, r.near_id) for r in curation.cosine_search(df, df.where("id % 10 = 0"), "id", "v", 0.6, block=7).collect()}
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    assert got == {(i, j) for i in range(0, 300, 10) for j in range(300) if i != j and u[i] @ u[j] >= 0.6}


def test_lanes(spark):
    d = spark.createDataFrame([(1, "x" * 900), (2, None)], "id int, t string")
    parts, m = lanes.text_lane(d, "id", "t")
    assert parts.count() == 3 and m.first().documents == 1
    clips, m = lanes.audio_lane(spark.createDataFrame([(1, 0.0, 30.0), (2, 0.0, 1.0), (3, 5.0, None)], "id int, a double, b double"), F.col("a"), F.col("b"))
    assert [(r.clip_start_s, r.clip_end_s) for r in clips.orderBy("clip_no").collect()] == [(0.0, 10.0), (10.0, 20.0), (20.0, 30.0)]
    st = spark.createDataFrame([("b", 2, {"o": "new"}, None), ("b", 1, {"o": "old", "p": "1"}, {"m": 1.0})], "batch_id string, stage_no int, outputs map<string,string>, metrics map<string,double>")
    r = lanes.fold_manifests(st).first()
    assert r.outputs == {"o": "new", "p": "1"} and r.metrics == {"m": 1.0}


def test_curator_lane(spark):
    ddl = "clip_id int, wav string, sample_rate int, duration_s double, text string, phonemes string, lang string"
    data = [(1, "a", 24000, 2.0, "Hello!", None, "en"), (2, "b", 22050, 2.0, "hello", None, "en"), (3, "c", 24000, 2.0, "hello", None, "de"), (4, "d", 24000, 0.5, "short", None, "en"), (5, "e", 24000, 2.0, None, "x", "en"), (6, "f", 24000, 2.0, "", "x", "en"), (7, "g", 24000, 2.0, "", None, "en"), (1, "a", 24000, 2.0, "Hello!", None, "en")]
    curated, rejected, card = lanes.curator_lane(spark.createDataFrame(data, ddl))
    assert sorted(r.clip_id for r in curated.collect()) == [1, 3, 5, 6]
    assert rows(rejected) == [(2, "DUPLICATE"), (4, "DURATION"), (7, "NO_TEXT_OR_PHONEMES")]
    assert {r.lang: r.clips for r in card.collect()} == {"en": 3, "de": 1}
    assert lanes.curator_lane(spark.createDataFrame([], ddl))[0].count() == 0


def test_links_and_maintenance(spark):
    cols = "entity_type string, entity_id int, source_id int, confidence_score double, extraction_date string"
    cur = spark.createDataFrame([("word", 1, 1, 0.5, "1"), ("word", 2, 1, 0.5, "1")], cols)
    inc = spark.createDataFrame([("word", 1, 1, None, "2"), ("word", 1, 2, 0.9, "2"), ("word", 1, 2, 0.8, "3"), ("rule", 1, 1, 0.1, "2")], cols)
    assert rows(upsert.link_entities(cur, inc)) == sorted([("word", 1, 1, 0.5, "2"), ("word", 2, 1, 0.5, "1"), ("word", 1, 2, 0.8, "3"), ("rule", 1, 1, 0.1, "2")], key=str)
    src = spark.createDataFrame([("A wiki", None, "https://a", 1.5), ("Oxford", None, "https://b", 1.0), ("Forum", None, None, 1.6)], "source_name string, source_type string, source_url string, reliability_score double")
    answers = spark.createDataFrame([("https://a", 200, None), ("https://b", 404, None)], "source_url string, status int, location string")
    assert tuple(upsert.maintenance(src, answers).first()) == (1, 1, True)


def test_agent_batches(spark):
    lang = spark.createDataFrame([(1, "en")], "language_id int, language_code string")
    words = spark.createDataFrame([(1, 1, "cat"), (2, 9, "lost")], "word_id int, language_id int, word_text string")
    phon = spark.createDataFrame([(1, 1, 5, "/kæt/", None, None), (2, 1, None, "kɑː", "mine", None), (3, 1, 5, "k", "a", "b"), (4, 2, 5, "k", None, None), (5, 7, 5, "k", None, None)], "phonetic_id int, word_id int, dialect_id int, ipa_pronunciation string, pronunciation_variant string, notes string")
    dia = spark.createDataFrame([(5, "US")], "dialect_id int, dialect_name string")
    got = {r.phonetic_id: r for r in lexicon.pronunciation_batch(phon, words, lang, dia).collect()}
    assert set(got) == {1, 2} and got[1].ipa_pronunciation == "kæt" and got[1].dialect_name == "US" and got[2].pronunciation_variant == "mine" and got[2].dialect_name is None and got[2].notes.startswith("Normalized")
    sent = spark.createDataFrame([(1, 1, "Cats see the quiet dog.", None, None), (2, 1, "Cats see dogs.", 5.0, None), (3, 1, "x", 1.0, "formal"), (4, 1, None, None, None)], "sentence_id int, language_id int, sentence_text string, complexity_score double, grammar_tone string")
    batch = lexicon.sentence_batch(sent, lang)
    assert {r.sentence_id: r.complexity_score for r in batch.collect()}[2] == 5.0 and batch.count() == 3
    known = spark.createDataFrame([("en", "Adjective Placement")], "language_code string, rule_name string")
    assert [(r.rule_name, r.example) for r in lexicon.new_rules(batch, known).collect()] == [("SUBJ-VERB-OBJ Word Order", "Cats see dogs.")]
    rules = spark.createDataFrame([("Plural formation", "X becomes Y", None, None), ("n", "d", "kept", "kept")], "rule_name string, rule_description string, rule_type string, rule_formula string")
    assert rows(lexicon.rule_batch(rules)) == [("Plural formation", "X becomes Y", "morphology", "X → Y"), ("n", "d", "kept", "kept")]
    bridge = spark.createDataFrame([(1, 1), (1, 1), (2, 2), (8, 1)], "word_id int, sentence_id int")
    assert rows(lexicon.sentences_of_words(words, bridge, sent)) == [(1, 1, "Cats see the quiet dog."), (2, 2, "Cats see dogs.")]


def test_streams_equal_tables(spark, tmp_path):
    base = spark.read.parquet(f"{SF}/events.parquet")
    src = tmp_path / "in"
    base.repartition(3).write.parquet(str(src))
    for name, build in {
        "tumbling": lambda e: ev.throughput(e, "ts", "1 day", keys=["event_type"], value="value"),
        "sliding": lambda e: ev.throughput(e, "ts", "1 day", "6 hours"),
        "session": lambda e: ev.sessions(e, "ts", "30 minutes", ["user_id"]),
    }.items():
        stream = ev.with_time(ev.stream_table(spark, str(src), base.schema, 1))
        ev.run_available(build(stream), str(tmp_path / name / "out"), str(tmp_path / name / "cp"))
        assert rows(spark.read.parquet(str(tmp_path / name / "out"))) == rows(build(ev.with_time(base)))
    twice = tmp_path / "twice"
    base.unionByName(base.limit(50)).repartition(2).write.parquet(str(twice))
    stream = ev.without_late_duplicates(ev.with_time(ev.stream_table(spark, str(twice), base.schema, 1)), "ts", "event_id", "100 days")
    ev.run_available(stream, str(tmp_path / "d/out"), str(tmp_path / "d/cp"), "append")
    assert spark.read.parquet(str(tmp_path / "d/out")).count() == base.count()


def test_stateful_progress_ends_like_the_table(spark, tmp_path):
    stage = F.when(F.col("event_type") == "purchase", "validate").otherwise("other")
    base = spark.read.parquet(f"{SF}/events.parquet").select((F.col("event_id") % 40).alias("batch_id"), stage.alias("stage"), F.when(F.col("value") > 480, "bad").alias("error"))
    base.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = ev.batch_progress(ev.stream_table(spark, str(tmp_path / "in"), base.schema, 1))
    ev.run_available(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "update")
    last = spark.read.parquet(str(tmp_path / "out")).groupBy("batch_id").agg(F.max_by("status", "n_events").alias("status"), F.max("n_events").alias("n"))
    assert {r.batch_id: r.status for r in last.collect()} == {r.batch_id: r.status for r in ev.batch_status(base).collect()}
    assert last.agg(F.sum("n")).first()[0] == base.count()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 5)
    return v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_queries(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    mine = sorted((tuple(plain(r[c]) for c in sorted(got.columns)) for r in got.collect()), key=str)
    if name not in catalog.ORACLE:
        return
    cur = duck.execute(catalog.ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    order = [names.index(c) for c in sorted(names)]
    assert mine == sorted((tuple(plain(r[i]) for i in order) for r in cur.fetchall()), key=str)
