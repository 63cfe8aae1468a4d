import csv
import io
import json
import wave
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from voxloom import schemas
from voxloom.operators import snapshot, validate
from voxloom.sources import html, readers, sinks


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def codes(df):
    return sorted((r.line_no, r.code) for r in df.select("line_no", "code").collect())


def wav(path, rate=24000, seconds=2.0, channels=1, width=2):
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(b"\0" * int(rate * seconds) * channels * width)


def test_numbered_lines(spark, tmp_path):
    p = write(tmp_path / "a.txt", "one\n\n  \nfour\nfive")
    rows = readers.numbered_lines(spark, p).orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in rows] == [(1, "one"), (4, "four"), (5, "five")]
    assert [r.word for r in readers.word_list(spark, p, 2).collect()] == ["one", "four"]


def test_numbered_lines_of_a_split_file(spark, tmp_path):
    p = write(tmp_path / "big.txt", "\n".join(f"line {i}" for i in range(1, 5001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        bad = readers.numbered_lines(spark, p).where(F.concat(F.lit("line "), F.col("line_no")) != F.col("line")).count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert bad == 0


def test_text_jsonl(spark, tmp_path):
    good = {"text": "t", "lang": "en", "labels": {"is_dialogue": True, "topic": "x", "register": "formal"}, "source_ref": {"doc_id": "d", "start": 0, "end": 5}}
    lines = [
        json.dumps(good),
        "{not json",
        "",
        json.dumps(good | {"lang": None}),
        json.dumps(good | {"labels": {"is_dialogue": "yes", "topic": None, "register_type": "informal"}}),
        json.dumps(good | {"source_ref": {"doc_id": "d", "start": 5, "end": 5.0}}),
        json.dumps(good | {"labels": {"is_dialogue": "maybe", "topic": "x"}}),
        json.dumps(good | {"labels": {"is_dialogue": False}, "text": 5}),
        json.dumps(good | {"labels": {"is_dialogue": None}}),
        json.dumps(good | {"labels": {"is_dialogue": 1, "code_switch_spans": [[0, 2], [3]]}}),
        json.dumps(good | {"labels": {"is_dialogue": 1, "code_switch_spans": [[0, 2], [3, 4]]}}),
        json.dumps(good | {"source_ref": {"doc_id": "d", "start": 5}}),
        "[1]",
    ]
    path = write(tmp_path / "t.jsonl", "\n".join(lines))
    broken = [(7, "CONTRACT"), (8, "CONTRACT"), (9, "CONTRACT"), (10, "CONTRACT"), (12, "CONTRACT"), (13, "CONTRACT")]
    found = validate.text_jsonl_issues(spark, path)
    assert codes(found) == [(2, "JSON_DECODE"), (4, "CONTRACT"), (6, "GROUNDING_OFFSETS"), *broken]
    assert {r.path for r in found.where("code = 'CONTRACT'").collect()} == {f"[{i}]" for i in (4, 7, 8, 9, 10, 12, 13)}
    asked = codes(validate.text_jsonl_issues(spark, path, ("is_dialogue", "topic")))
    assert [x for x in asked if x[1] == "LABEL_MISSING"] == [(5, "LABEL_MISSING"), (11, "LABEL_MISSING")]
    assert tuple(validate.report(found, readers.numbered_lines(spark, path), ("JSON_DECODE",)).first()) == (False, 11, 9, 1)


def test_segments_of_a_table(spark):
    ddl = "segment_id int, text string, lang string, labels struct<is_dialogue: boolean, topic: string, register: string, register_type: string, code_switch_spans: array<array<bigint>>>, source_ref struct<doc_id: string, start_char: bigint, end_char: bigint>"
    ok, ref = (True, None, None, None, None), ("d", 0, 5)
    data = [(1, "t", "en", ok, ref), (2, None, "en", ok, ref), (3, "t", "en", (None, "x", None, None, None), ref), (4, "t", "en", ok, None), (5, "t", "en", ok, ("d", None, 5)), (6, "t", "en", ok, ("d", 5, 5)),
            (7, "t", "en", (False, None, None, None, [[1, 2], [None, 3]]), ref), (8, "t", "en", None, ("d", 9, 5)), (9, "", "en", (False, None, None, None, [[1, 2]]), ref)]
    df = spark.createDataFrame(data, ddl)
    found = validate.segment_issues(df, F.col("segment_id").cast("string"), ["segment_id"])
    assert sorted((r.segment_id, r.code) for r in found.collect()) == [(2, "CONTRACT"), (3, "CONTRACT"), (4, "CONTRACT"), (5, "CONTRACT"), (6, "GROUNDING_OFFSETS"), (7, "CONTRACT"), (8, "CONTRACT")]
    assert "labels.is_dialogue" in found.where("segment_id = 3").first().message
    assert validate.segment_issues(df.limit(0), F.lit("x"), ["segment_id"]).count() == 0


def test_profile_files(spark, tmp_path):
    good = validate.example_profile()
    for name, doc in (("a.json", good), ("b.json", good | {"version": "1.0"}), ("c.json", {k: v for k, v in good.items() if k != "phoneme_inventory"}), ("d.json", {k: v for k, v in good.items() if k not in ("version", "tts_strategy")})):
        write(tmp_path / name, json.dumps(doc))
    write(tmp_path / "e.json", "{")
    path = f"{tmp_path}/*.json"
    assert sorted((r["name"], r.code) for r in validate.profile_file_issues(spark, path, ["a.json", "z.json"]).collect()) == [("b.json", "SEMVER"), ("c.json", "CONTRACT"), ("e.json", "JSON_DECODE"), ("z.json", "NOT_FOUND")]
    assert tuple(validate.profile_file_report(spark, path, ["a.json", "z.json"]).first()) == (2, 6, 2 / 6, 1)
    assert tuple(validate.profile_file_report(spark, f"{tmp_path}/a*.json").first()) == (1, 1, 1.0, 0)


def test_scores_jsonl(spark, tmp_path):
    good = dict.fromkeys(validate.SCORE_FIELDS, 50)
    lines = [json.dumps(good), json.dumps(good | {"total": 101}), "[1]", json.dumps(good | {"shape": "high", "clarity": "7"}), json.dumps({k: v for k, v in good.items() if k != "validity"}), "nope"]
    assert codes(validate.scores_jsonl_issues(spark, write(tmp_path / "s.jsonl", "\n".join(lines)))) == [(2, "SCORE_RANGE"), (3, "JSON"), (4, "SCORE_RANGE"), (5, "SCORE_RANGE"), (6, "JSON")]


def test_audio_dataset(spark, tmp_path):
    clips = tmp_path / "clips"
    clips.mkdir()
    wav(clips / "ok.wav")
    wav(clips / "rate.wav", rate=16000)
    wav(clips / "stereo.wav", channels=2)
    wav(clips / "short.wav", seconds=0.5)
    wav(clips / "deep.wav", width=3)
    (clips / "broken.wav").write_bytes(b"RIFFxx")
    names = ["ok", "rate", "stereo", "short", "deep", "broken", "absent"]
    p = write(tmp_path / "m.csv", "audio_file,text\n" + "".join(f'clips/{n}.wav,"a, ""b""\nand more"\n' for n in names) + ",no file\n")
    assert [(r.line_no, r.text) for r in readers.csv_rows(spark, p).orderBy("line_no").collect()] == [*((i + 2, 'a, "b"\nand more') for i in range(7)), (9, "no file")]
    assert codes(validate.audio_dataset_issues(spark, str(clips), p)) == [(3, "SR"), (4, "CHANNELS"), (5, "DURATION"), (6, "BIT_DEPTH"), (7, "WAV_READ"), (8, "MISSING_WAV"), (9, "CSV_FIELD")]


MANIFEST = [("clips/1.wav", 24000, 2.5, "hé|llo", None, "en", "en-US", "s1", ["calm"], None), ("clips/2.wav", 24000, 3.9, 'say "x"', "x", "en", None, None, None, "sentence")]


def test_lint_and_snapshot(spark, tmp_path):
    df = spark.createDataFrame(MANIFEST, schemas.schema("ManifestRow"))
    assert validate.lint_manifest(df, "wav").count() == 0
    paths = snapshot.build_snapshot(df.coalesce(1), str(tmp_path / "out"))
    back = spark.read.schema(schemas.schema("ManifestRow")).json(paths["manifest"])
    assert sorted(map(tuple, back.collect()), key=str) == sorted((tuple(x) for x in df.collect()), key=str)
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "out/metadata").glob("part*"))).decode()
    held = io.StringIO()
    csv.writer(held, delimiter="|").writerows([["clips/1.wav", "hé|llo", "s1"], ["clips/2.wav", 'say "x"', "spk_unknown"]])
    assert sorted(raw.split("\r\n")) == sorted(held.getvalue().split("\r\n"))
    assert sorted(csv.reader(raw.splitlines(), delimiter="|")) == [["clips/1.wav", "hé|llo", "s1"], ["clips/2.wav", 'say "x"', "spk_unknown"]]
    card = spark.read.json(paths["dataset_card"]).first()
    assert card.clips == 2 and card.sample_rate == [24000] and abs(card.minutes - 6.4 / 60) < 1e-9
    bad = spark.createDataFrame([*MANIFEST, ("c", None, None, "", None, "en", None, None, None, None)], schemas.schema("ManifestRow"))
    assert {r.code for r in validate.lint_manifest(bad, "wav").collect()} == {"DURATION", "NO_TEXT_OR_PHONEMES", "SAMPLE_RATE_MIX"}
    with pytest.raises(snapshot.LintError):
        snapshot.build_snapshot(bad, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_profiles(spark):
    ddl = "profile_id int, dialect string, profile_version string, register_defaults map<string,double>, fallback_chain array<string>, phoneme_inventory array<string>, tts_defaults struct<speaking_rate:double,pitch_bias:double,pause_bias:double,filler_bias:double>, curation_targets struct<min_minutes_90:double,phoneme_coverage:double,target_dialect_mix:map<string,double>>, tts_strategy string"
    ok = (1, "a", "1.0.0", {"formal": 0.3, "informal": 0.7}, ["b"], ["x"], (1.0, 0.0, 0.1, 0.05), (1.0, 0.9, None), "grouped")
    bad = (2, "a", "1.0", {"formal": 0.5}, ["b", "a"], [], (2.0, 0.0, float("nan"), 0.05), (1.0, 1.9, None), "cloud")
    none = (3, None, None, None, None, None, None, None, None)
    got = sorted((r.profile_id, r.code) for r in validate.profile_issues(spark.createDataFrame([ok, bad, none], ddl), "profile_id").collect())
    assert got == [(2, "INVENTORY"), (2, "RANGE"), (2, "RANGE"), (2, "RANGE"), (2, "REGISTER_SUM"), (2, "SELF_FALLBACK"), (2, "SEMVER"), (2, "STRATEGY"), (3, "INVENTORY"), (3, "SEMVER"), (3, "STRATEGY")]


def test_summary(spark):
    df = spark.range(5)
    assert tuple(validate.summary(df.where("id > 2"), df).first()) == (False, 5, 2)
    assert tuple(validate.summary(df.limit(0), df.limit(0)).first()) == (True, 0, 0)


PAGE = """<html><ol><li>a <span>sense</span> of it<ol><li>nested</li></ol></li><li>second</li></ol><span class="IPA x">/a/</span><ul><li><span class="IPA">/a/</span> <span class="IPA">/b/</span></li></ul>
<dl><dd>An example[1] here <cite>Someone said</cite></dd><dd>no</dd></dl><div class="usage-example">Use it well</div><div id="Synonyms"><ul><li><a href="#">syn</a></li></ul></div><div id="Other"><li><a>not</a></li></div></html>"""


def test_html(spark):
    d, p, e, r = html.extract(PAGE)
    assert d == ["a sense of it nested sense", "nested", "second"]
    assert p == ["/a/", "/b/"] and r == ["syn"]
    assert e == ["An example here", "Someone said", "Use it well"]
    rows = html.with_record(spark.createDataFrame([(PAGE,), (None,), ("<p>",)], "h string"), "h").collect()
    assert rows[0].related_words == ["syn"] and rows[1].definitions == []


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "j").mkdir()
    write(tmp_path / "j/a.json", '{"word": "x",\n "language": "en"}')
    write(tmp_path / "j/b.json", "{broken")
    docs = {r.path[-6:]: r for r in readers.json_documents(spark, str(tmp_path / "j"), schemas.schema("WordRecord")).collect()}
    assert docs["a.json"].value.word == "x" and docs["b.json"].error == "not JSON"
    log = write(tmp_path / "f.log", "2025-01-01 10:00:00 - Word: 'é' (en) - Error: no page\nnoise\n")
    r = readers.failure_log(spark, log).collect()
    assert [(x.word, x.language, x.reason) for x in r] == [("é", "en", "no page")]
    df = spark.createDataFrame([("a", None), ("b,c", "é")], "x string, y string")
    assert sinks.write_export(df, str(tmp_path / "e"), "csv") and not sinks.write_export(df.limit(0), str(tmp_path / "n"), "csv") and not sinks.write_export(df, str(tmp_path / "n"), "xls")
    assert sorted(map(tuple, spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "e")).collect()), key=str) == [("a", None), ("b,c", "é")]
    sinks.write_markdown(df, "x", str(tmp_path / "md"))
    sinks.write_rejects(spark.createDataFrame([("w", "en", "why")], "word string, language string, reason string"), str(tmp_path / "rej"))
    assert readers.failure_log(spark, str(tmp_path / "rej")).first().reason == "why"
    document = json.loads(sinks.schema_json("TextSegment"))
    assert document["title"] == "TextSegment" and document["properties"]["source_ref"]["properties"]["start"] == {"type": "integer"}
    assert document["properties"]["labels"]["properties"]["code_switch_spans"] == {"type": "array", "items": {"type": "array", "items": {"type": "integer"}}}
    made = {r.file: json.loads(r.document) for r in sinks.schema_documents(spark).collect()}
    assert set(made["index.json"].values()) == set(made) - {"index.json"}
    sinks.write_pretty_json(df.coalesce(1), str(tmp_path / "pretty"))
    shown = "".join(x.read_text(encoding="utf-8") for x in (tmp_path / "pretty").glob("part*"))
    assert [json.loads(x) for x in shown.strip().split("\n\n")] == [{"x": "a", "y": None}, {"x": "b,c", "y": "é"}]
    assert sinks.feed_path("out", "en", datetime(2025, 1, 2, 3, 4, 5)) == "out/wiktionary_en_20250102_030405.json"
    words = write(tmp_path / "w.txt", "one\n two\n\nthree")
    assert [r.word for r in readers.named_word_list(spark, "w", {"w": (words, 2)}).collect()] == ["one", "two"] and readers.named_word_list(spark, "none").count() == 0
    assert spark.range(1).select(readers.language_domain(F.lit("de")).alias("d")).first().d == "de.wiktionary.org"
    assert readers.newest_file(spark, str(tmp_path / "j/*.json")).first().path.endswith(".json")
    ini = write(tmp_path / "db.ini", "[postgresql]\nhost=h\ndatabase=d\nuser=u\n")
    assert readers.database_options(ini) == {"url": "jdbc:postgresql://h:5432/d", "user": "u"}
    df.createOrReplaceTempView("given")
    assert readers.sql_query(spark, "SELECT * FROM given WHERE x = :x", {"x": "a"}).count() == 1
    assert readers.page_addresses(spark.createDataFrame([("a b",)], "word string"), F.lit("en.example.org")).first().url == "https://en.example.org/wiki/a_b"
    meta = write(tmp_path / "metadata.csv", 'clips/1.wav|"a|b"|s\n')
    assert tuple(readers.metadata_rows(spark, meta).select("line_no", "audio_file", "text").first()) == (1, "clips/1.wav", "a|b")
    with pytest.raises(Exception):
        readers.jsonl_strict(spark, write(tmp_path / "bad.jsonl", "{oops\n"), schemas.schema("SourceRef")).collect()


def test_catalogue(spark):
    rows = schemas.catalogue(spark).collect()
    assert {r.contract for r in rows} == set(schemas.names()) and len([r for r in rows if r.contract == "SegmentScore"]) == 10
