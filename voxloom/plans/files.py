"""Queries that write their tables as files, as a user's files would be, and read, check or build from these."""

from __future__ import annotations

import io
import json
import wave

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators import snapshot, validate
from voxloom.operators.lineage import cut, remove, scratch
from voxloom.plans.corpus import _t
from voxloom.sources import readers, sinks


def _kept(df: DataFrame, folder: str) -> DataFrame:
    """The result, written before the files it was read from are deleted."""
    out = cut(df)
    remove(df.sparkSession, folder)
    return out


def _segments_file(spark: SparkSession, sf: str, folder: str) -> str:
    """text_segments as JSON lines, nulls written; every segment whose id ends in 97 is broken off, and some fields have other types."""
    t = _t(spark, sf, "text_segments").where("segment_id IS NOT NULL")
    number = lambda c: F.when(F.col("segment_id") % 50 == 1, F.concat(F.lit("x"), c.cast("string"))).otherwise(c.cast("string"))
    ref = F.struct(F.col("source_ref.doc_id").alias("doc_id"), number(F.col("source_ref.start_char")).alias("start"), F.col("source_ref.end_char").alias("end"))
    row = F.to_json(F.struct("segment_id", "text", "lang", "labels", ref.alias("source_ref")), {"ignoreNullFields": "false"})
    line = F.when(F.col("segment_id") % 100 == 97, F.substring(row, 1, 10)).otherwise(row)
    t.select(line.alias("value")).write.text(folder)
    return folder


def text_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    """Issues of text segments in a file of JSON lines."""
    folder = _segments_file(spark, sf, scratch(spark, "segments"))
    found = validate.text_jsonl_issues(spark, folder, keep={"segment_id": "bigint"})
    return _kept(found.groupBy("segment_id", "code").agg(F.count(F.lit(1)).alias("n")), folder)


def text_jsonl_report(spark: SparkSession, sf: str) -> DataFrame:
    """What the validator of that file says: lines checked, issues, exit code."""
    folder = _segments_file(spark, sf, scratch(spark, "segments"))
    found = cut(validate.text_jsonl_issues(spark, folder))
    return _kept(validate.report(found, readers.numbered_lines(spark, folder), ("JSON_DECODE",)), folder)


def scores_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    """Issues of scores in a file of JSON lines; every row whose segment ends in 97 is a list."""
    folder = scratch(spark, "scores")
    s = _t(spark, sf, "segment_scores").where("segment_id IS NOT NULL")
    row = F.to_json(F.struct("segment_id", *validate.SCORE_FIELDS), {"ignoreNullFields": "false"})
    s.select(F.when(F.col("segment_id") % 100 == 97, F.concat(F.lit("["), row, F.lit("]"))).otherwise(row).alias("value")).write.text(folder)
    found = validate.scores_jsonl_issues(spark, folder, keep={"segment_id": "bigint"})
    fields = F.regexp_extract("path", r"\.(\w+)$", 1).alias("field")
    return _kept(found.groupBy("segment_id", "code", fields).agg(F.count(F.lit(1)).alias("n")), folder)


def _sound(rate: int, channels: int, width: int, seconds: float) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(bytes(int(rate * seconds) * channels * width))
    return out.getvalue()


def _put(spark: SparkSession, path: str, content: bytes) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(content))
    out.close()


def audio_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Issues of a clip list against its sounds: one short clip for each language profile, a configuration table."""
    folder = scratch(spark, "clips")
    ids = sorted(r.profile_id for r in _t(spark, sf, "language_profiles").select("profile_id").collect())
    lines = ["audio_file,text"]
    for i in ids:
        lines.append(f'{"" if i % 7 == 6 else f"clips/c{i}.wav"},"a text, of\ntwo lines and ""quotes"""')
        if i % 5 == 4:
            continue  # no such file
        sound = _sound((24000, 22050, 16000)[i % 3], 1 + (i % 4 == 3), 2 if i % 6 else 1, 2.0 if i % 8 else 0.5)
        _put(spark, f"{folder}/clips/c{i}.wav", b"RIFF" if i % 11 == 10 else sound)
    _put(spark, f"{folder}/list.csv", ("\n".join(lines) + "\n").encode())
    found = validate.audio_dataset_issues(spark, f"{folder}/clips", f"{folder}/list.csv")
    return _kept(found.select(F.col("line_no").cast("bigint").alias("line_no"), "code"), folder)


def profile_files(spark: SparkSession, sf: str) -> DataFrame:
    """Issues of language profiles as JSON documents, with one that is broken off and one that isn't there."""
    folder = scratch(spark, "profiles")
    rows = _t(spark, sf, "language_profiles").withColumn("language", F.col("lang")).withColumn("version", F.col("profile_version"))
    names = []
    for r in rows.select("profile_id", F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("doc")).collect():  # a configuration table
        names.append(f"p{r.profile_id}.json")
        doc = {k: v for k, v in json.loads(r.doc).items() if k not in ("lang", "profile_version")}
        _put(spark, f"{folder}/p{r.profile_id}.json", json.dumps(doc, ensure_ascii=False, indent=1).encode())
    _put(spark, f"{folder}/broken.json", b'{"language": ')
    _put(spark, f"{folder}/example.json", json.dumps(validate.example_profile()).encode())
    expected = [*names, "broken.json", "example.json", "absent.json"]
    found = validate.profile_file_issues(spark, f"{folder}/*.json", expected).select("name", "code")
    said = validate.profile_file_report(spark, f"{folder}/*.json", expected)
    summary = said.select(F.concat(F.lit("report "), F.col("passed").cast("string"), F.lit("/"), F.col("files").cast("string")).alias("name"), F.concat(F.lit("exit "), F.col("exit_code").cast("string")).alias("code"))
    return _kept(found.unionByName(summary), folder)


def dataset_build(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot of the clips that pass the lints at 24 kHz, built from a manifest file and read again from what was written."""
    folder = scratch(spark, "dataset")
    fields = [f for f in ("wav", "sample_rate", "duration_s", "text", "phonemes", "lang", "dialect", "speaker_id", "style_tags", "granularity")]
    clips = _t(spark, sf, "curated_tts_manifest").where("sample_rate = 24000 AND duration_s BETWEEN 1.5 AND 14.0 AND (coalesce(text, '') <> '' OR coalesce(phonemes, '') <> '')")
    sinks.write_jsonl(clips.select(*fields), f"{folder}/given")
    paths = snapshot.build_from_file(spark, f"{folder}/given", f"{folder}/out")
    card = spark.read.schema("clips bigint, sample_rate array<int>, minutes double").json(paths["dataset_card"])
    listed = readers.metadata_rows(spark, paths["metadata"]).agg(F.count(F.lit(1)).alias("listed"), F.count_if(F.col("speaker_id") == "spk_unknown").alias("unknown_speakers"), F.sum(F.length("text")).alias("text_chars"))
    kept = spark.read.json(paths["manifest"]).agg(F.count(F.lit(1)).alias("kept"))
    out = card.select("clips", F.array_join(F.col("sample_rate").cast("array<string>"), ",").alias("sample_rate"), F.round("minutes", 6).alias("minutes"))
    figures = {c: listed.select(c).scalar() for c in listed.columns} | {"kept": kept.scalar()}
    return _kept(out.withColumns(figures), folder)


QUERIES = {f.__name__: f for f in (text_jsonl, text_jsonl_report, scores_jsonl, audio_dataset, profile_files, dataset_build)}

_ROWS = "(SELECT segment_id, segment_id % 100 = 97 AS cut, text, lang, labels, source_ref AS r, segment_id % 50 = 1 AS odd FROM text_segments WHERE segment_id IS NOT NULL)"
_BROKEN = """(text IS NULL OR lang IS NULL OR labels IS NULL OR labels.is_dialogue IS NULL OR r IS NULL OR r.doc_id IS NULL OR r.start_char IS NULL OR odd OR r.end_char IS NULL OR labels.code_switch_spans IS NULL
    OR coalesce(len(list_filter(labels.code_switch_spans, lambda s: s IS NULL OR len(s) <> 2 OR s[1] IS NULL OR s[2] IS NULL)), 0) > 0)"""
_CODES = f"""SELECT CASE WHEN NOT cut THEN segment_id END AS segment_id, CASE WHEN cut THEN 'JSON_DECODE' WHEN {_BROKEN} THEN 'CONTRACT' WHEN r.start_char >= r.end_char THEN 'GROUNDING_OFFSETS' END AS code FROM {_ROWS}"""
_FIELDS = " UNION ALL ".join(f"SELECT segment_id, '{k}' AS field, {k} AS v FROM segment_scores WHERE segment_id IS NOT NULL AND segment_id % 100 <> 97" for k in ("clarity", "alignment", "diarization", "transcript_accuracy", "validity", "shape", "total"))
_PROFILE = " UNION ALL ".join(
    f"SELECT 'p' || profile_id || '.json' AS name, '{code}' AS code FROM language_profiles WHERE {when}"
    for code, when in (
        ("CONTRACT", "lang IS NULL OR dialect IS NULL OR script IS NULL OR phoneme_inventory IS NULL"),
        ("SEMVER", r"NOT regexp_full_match(coalesce(profile_version, '1.0.0'), '[0-9]+\.[0-9]+\.[0-9]+')"),
        ("REGISTER_SUM", "register_defaults IS NOT NULL AND NOT coalesce(abs(list_sum(map_values(register_defaults)) - 1) < 1e-6, false)"),
        ("SELF_FALLBACK", "list_contains(fallback_chain, dialect)"),
        ("INVENTORY", "len(phoneme_inventory) = 0"),
        ("STRATEGY", "coalesce(tts_strategy, 'standalone') NOT IN ('standalone', 'grouped', 'cloud_fallback')"),
        *(("RANGE", f"NOT {c} BETWEEN {a} AND {b}") for c, a, b in (("tts_defaults.speaking_rate", 0.5, 1.8), ("tts_defaults.pitch_bias", -12, 12), ("tts_defaults.pause_bias", 0, 1), ("tts_defaults.filler_bias", 0, 1), ("curation_targets.phoneme_coverage", 0, 1))),
    )
)
ORACLE = {
    "text_jsonl": f"SELECT segment_id, code, count(*) AS n FROM ({_CODES}) WHERE code IS NOT NULL GROUP BY 1, 2",
    "text_jsonl_report": f"""SELECT count(code) = 0 AS ok, count(*) FILTER (WHERE code IS NULL OR code <> 'JSON_DECODE') AS checked, count(code) AS n_issues, CAST(count(code) > 0 AS INT) AS exit_code FROM ({_CODES})""",
    "scores_jsonl": f"""SELECT NULL::BIGINT AS segment_id, 'JSON' AS code, '' AS field, count(*) AS n FROM segment_scores WHERE segment_id % 100 = 97 GROUP BY 1 HAVING count(*) > 0
        UNION ALL SELECT segment_id, 'SCORE_RANGE', field, count(*) FROM ({_FIELDS}) WHERE v IS NULL OR isnan(v) OR NOT v BETWEEN 0 AND 100 GROUP BY 1, 2, 3""",
    "audio_dataset": """WITH c AS (SELECT profile_id AS i, row_number() OVER (ORDER BY profile_id) + 1 AS line_no FROM language_profiles)
        SELECT line_no, unnest(CASE WHEN i % 7 = 6 THEN ['CSV_FIELD'] WHEN i % 5 = 4 THEN ['MISSING_WAV'] WHEN i % 11 = 10 THEN ['WAV_READ']
            ELSE list_concat(CASE WHEN i % 3 = 2 THEN ['SR'] ELSE [] END, CASE WHEN i % 4 = 3 THEN ['CHANNELS'] ELSE [] END, CASE WHEN i % 8 = 0 THEN ['DURATION'] ELSE [] END, CASE WHEN i % 6 = 0 THEN ['BIT_DEPTH'] ELSE [] END) END) AS code FROM c""",
    "profile_files": f"""WITH f AS ({_PROFILE} UNION ALL SELECT 'broken.json', 'JSON_DECODE' UNION ALL SELECT 'absent.json', 'NOT_FOUND') SELECT * FROM f UNION ALL
        SELECT 'report ' || (SELECT count(*) + 3 - (SELECT count(DISTINCT name) FROM f) FROM language_profiles) || '/' || (SELECT count(*) + 3 FROM language_profiles), 'exit 1'""",
    "dataset_build": """SELECT count(*) AS clips, '24000' AS sample_rate, round(sum(duration_s) / 60, 6) AS minutes, count(*) AS listed, count(*) FILTER (WHERE coalesce(speaker_id, 'spk_unknown') = 'spk_unknown') AS unknown_speakers,
        CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS text_chars, count(*) AS kept FROM curated_tts_manifest WHERE sample_rate = 24000 AND duration_s BETWEEN 1.5 AND 14.0 AND (coalesce(text, '') <> '' OR coalesce(phonemes, '') <> '')""",
}
