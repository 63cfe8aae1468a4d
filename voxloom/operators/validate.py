"""Validation: rows become issues (code, message, path), one row each, and a summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.schemas import schema
from voxloom.sources.readers import csv_rows, json_documents, jsonl_tolerant, wav_headers

SCORE_FIELDS = ("clarity", "alignment", "diarization", "transcript_accuracy", "validity", "shape", "total")
SAMPLE_RATES = (22050, 24000)
STRATEGIES = ("standalone", "grouped", "cloud_fallback")
MIN_S, MAX_S = 1.5, 14.0


def issue(code: str, message: Column | str, path: Column, when: Column) -> Column:
    """An issue where ``when`` holds, else null."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(code).alias("code"), text.alias("message"), path.alias("path")))


def issues(df: DataFrame, candidates: list[Column], keep: list[str] | None = None) -> DataFrame:
    """One row for every candidate issue that isn't null."""
    found = F.filter(F.array(*candidates), lambda x: x.isNotNull())
    return df.select(*(keep or []), F.explode(found).alias("_i")).select(*(keep or []), "_i.*")


def summary(found: DataFrame, checked: DataFrame) -> DataFrame:
    """(ok, checked, n_issues): one row."""
    return report(found, checked).drop("exit_code")


def score_issues(scores: DataFrame, path: Column, keep: list[str]) -> DataFrame:
    """SCORE_RANGE for every score that is missing, not a number or not from 0 to 100."""
    found = [
        issue("SCORE_RANGE", F.concat(F.lit(f"{k} "), F.coalesce(F.col(k).cast("string"), F.lit("missing"))), F.concat(path, F.lit(f".{k}")), ~F.coalesce(F.expr(f"try_cast({k} AS double)").between(0, 100), F.lit(False)) | F.coalesce(F.isnan(F.expr(f"try_cast({k} AS double)")), F.lit(False)))
        for k in SCORE_FIELDS
    ]
    return issues(scores, found, keep)


#: Labels that a text segment must have.
REQUIRED_LABELS = ("is_dialogue",)
_TRUTH = ("true", "false", "yes", "no", "on", "off", "1", "0", "1.0", "0.0", "t", "f", "y", "n")


def report(found: DataFrame, checked: DataFrame, unchecked: tuple[str, ...] = ()) -> DataFrame:
    """(ok, checked, n_issues, exit_code): what a validator's run says: 0 without issues, else 1.

    Rows with an issue whose code is in ``unchecked`` couldn't be read and don't count as checked.
    """
    lost = found.where(F.col("code").isin(*unchecked)) if unchecked else found.limit(0)
    both = checked.select(F.lit(1).alias("c"), F.lit(0).alias("i")).unionAll(found.select(F.lit(0).alias("c"), F.lit(1).alias("i"))).unionAll(lost.select(F.lit(-1).alias("c"), F.lit(0).alias("i")))
    sums = both.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("checked"), F.coalesce(F.sum("i"), F.lit(0)).alias("n_issues"))
    return sums.select((F.col("n_issues") == 0).alias("ok"), "checked", "n_issues", (F.col("n_issues") > 0).cast("int").alias("exit_code"))


def _segment_candidates(at: Column, there: Column, faults: dict[str, Column], labels: dict[str, Column], start: Column, end: Column) -> list[Column]:
    """One CONTRACT issue for a row with any fault, naming the fields; label and offset issues only for rows without one."""
    broken = F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in faults.items()]), lambda x: x.isNotNull())
    sound = there & (F.size(broken) == 0)
    return [
        issue("CONTRACT", F.concat(F.lit("missing or of another type: "), F.array_join(broken, ", ")), at, there & (F.size(broken) > 0)),
        *[issue("LABEL_MISSING", name, F.concat(at, F.lit(f".labels.{name}")), sound & value.isNull()) for name, value in labels.items()],
        issue("GROUNDING_OFFSETS", "start not before end", F.concat(at, F.lit(".source_ref")), sound & (start >= end)),
    ]


def segment_issues(
    segments: DataFrame, path: Column, keep: list[str], start: str = "start_char", end: str = "end_char", required: tuple[str, ...] = REQUIRED_LABELS
) -> DataFrame:
    """CONTRACT, LABEL_MISSING and GROUNDING_OFFSETS of text segments.

    Text, language, labels with is_dialogue, and a source reference with its document and both offsets make up the contract; topic
    and register are optional, and spans, where there are any, are pairs of numbers. A row that breaks the contract has that
    one issue. ``required`` names labels that must have a value beside the contract.
    """
    spans = F.exists(F.coalesce("labels.code_switch_spans", F.array().cast("array<array<bigint>>")), lambda s: s.isNull() | (F.size(s) != 2) | F.exists(s, lambda x: x.isNull()))
    columns = ("text", "lang", "labels.is_dialogue", "source_ref.doc_id", f"source_ref.{start}", f"source_ref.{end}")
    faults = {c: F.col(c).isNull() for c in columns} | {"labels.code_switch_spans": spans}
    labels = {name: F.col(f"labels.{name}") for name in required}
    return issues(segments, _segment_candidates(path, F.lit(True), faults, labels, F.col(f"source_ref.{start}"), F.col(f"source_ref.{end}")), keep)


def _get(path: str, kind: str) -> Column:
    return F.try_variant_get("value", f"$.{path}", kind)


def _with_fields(lines: DataFrame, keep: dict[str, str] | None) -> DataFrame:
    return lines.select("*", *[_get(name, kind).alias(name) for name, kind in (keep or {}).items()])


def text_jsonl_issues(spark: SparkSession, path: str, required: tuple[str, ...] = REQUIRED_LABELS, keep: dict[str, str] | None = None) -> DataFrame:
    """(line_no, code, message, path) of a file of text segments, as JSON lines.

    Types are taken leniently: numbers may be written as whole doubles or as text, booleans as yes, on, 1 and the like; text
    must be text. A line that is JSON but no object breaks the contract, and so do
    spans that are written as null. ``keep`` names further columns and the type of the
    top-level field of the same name that each is taken from.
    """
    rows = _with_fields(jsonl_tolerant(spark, path), keep)
    truth = F.lower(_get("labels.is_dialogue", "string")).isin(*_TRUTH)
    start, end = _get("source_ref.start", "bigint"), _get("source_ref.end", "bigint")
    given = F.try_variant_get("value", "$.labels.code_switch_spans", "variant")
    spans = F.try_variant_get("value", "$.labels.code_switch_spans", "array<array<bigint>>")
    texts = {p: ~F.coalesce(F.schema_of_variant(F.try_variant_get("value", f"$.{p}", "variant")) == "STRING", F.lit(False)) for p in ("text", "lang", "source_ref.doc_id")}
    faults = texts | {
        "labels.is_dialogue": ~F.coalesce(truth, F.lit(False)),
        "source_ref.start": start.isNull(),
        "source_ref.end": end.isNull(),
        "labels.code_switch_spans": given.isNotNull() & (spans.isNull() | F.exists(spans, lambda s: s.isNull() | (F.size(s) != 2) | F.exists(s, lambda x: x.isNull()))),
    }
    labels = {name: _get(f"labels.{name}", "string") for name in required}
    there = F.col("value").isNotNull()
    at = F.format_string("[%d]", F.col("line_no"))
    return issues(rows, [issue("JSON_DECODE", "not JSON", at, ~there), *_segment_candidates(at, there, faults, labels, start, end)], ["line_no", *(keep or {})])


def scores_jsonl_issues(spark: SparkSession, path: str, keep: dict[str, str] | None = None) -> DataFrame:
    """(line_no, code, message, path) of a file of scores, as JSON lines; what isn't JSON or no object is an issue too."""
    rows = _with_fields(jsonl_tolerant(spark, path), keep).withColumn("_object", F.schema_of_variant("value").startswith("OBJECT"))
    at = F.format_string("[%d]", F.col("line_no"))
    good = F.coalesce(F.col("_object"), F.lit(False))
    found = [issue("JSON", "not a JSON object", at, ~good)]
    for k in SCORE_FIELDS:
        v = F.when(good, _get(k, "double"))
        found.append(issue("SCORE_RANGE", f"{k} not from 0 to 100", F.concat(at, F.lit(f".{k}")), good & (~F.coalesce(v.between(0, 100), F.lit(False)) | F.coalesce(F.isnan(v), F.lit(False)))))
    return issues(rows, found, ["line_no", *(keep or {})])


def audio_dataset_issues(spark: SparkSession, clips: str, csv: str) -> DataFrame:
    """(line_no, code, message, path) of a CSV with an audio_file column against the WAV files in a folder."""
    rows = csv_rows(spark, csv).withColumn("name", F.regexp_extract("audio_file", r"[^/]+$", 0))
    joined = rows.join(wav_headers(spark, clips).withColumnRenamed("path", "_wav"), "name", "left")
    at = F.format_string("line %d", F.col("line_no"))
    given, there = F.coalesce(F.col("audio_file"), F.lit("")) != "", F.col("_wav").isNotNull()
    read = given & there & F.col("error").isNull()
    found = [
        issue("CSV_FIELD", "audio_file missing", at, ~given),
        issue("MISSING_WAV", F.concat("name", F.lit(" not found")), at, given & ~there),
        issue("WAV_READ", F.concat("name", F.lit(": "), F.coalesce("error", F.lit(""))), at, given & there & F.col("error").isNotNull()),
        issue("SR", F.concat("name", F.lit(": sample rate "), F.col("sample_rate").cast("string")), at, read & ~F.col("sample_rate").isin(*SAMPLE_RATES)),
        issue("CHANNELS", F.concat("name", F.lit(": channels "), F.col("channels").cast("string")), at, read & (F.col("channels") != 1)),
        issue("DURATION", F.concat("name", F.lit(": seconds "), F.round("duration_s", 2).cast("string")), at, read & ~F.col("duration_s").between(MIN_S, MAX_S)),
        issue("BIT_DEPTH", F.concat("name", F.lit(": sample width "), F.col("sample_width").cast("string")), at, read & (F.col("sample_width") != 2)),
    ]
    return issues(joined, found, ["line_no"])


def profile_file_issues(spark: SparkSession, path: str, expected: list[str] | None = None) -> DataFrame:
    """(name, code, message, path) of profile documents, one JSON file each.

    NOT_FOUND for an ``expected`` file name that isn't there, JSON_DECODE for a file that isn't JSON, CONTRACT for one that isn't an
    object or lacks language, dialect, script or phoneme_inventory; else the issues of ``profile_issues``. Fields with a default
    (version 1.0.0, register shares, strategy standalone) may be absent.
    """
    docs = json_documents(spark, path, schema("LanguageProfileV1")).select(F.regexp_extract("path", r"[^/]+$", 0).alias("name"), "value", "error")
    rows = docs.select("name", "error", "value.*").withColumn("version", F.coalesce("version", F.lit("1.0.0"))).withColumn("tts_strategy", F.coalesce("tts_strategy", F.lit("standalone")))
    lacking = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in ("language", "dialect", "script", "phoneme_inventory")]), lambda x: x.isNotNull())
    readable = F.col("error").isNull()
    basic = issues(
        rows,
        [
            issue("JSON_DECODE", "not JSON", F.col("name"), ~readable),
            issue("CONTRACT", F.concat(F.lit("missing or of another type: "), F.array_join(lacking, ", ")), F.col("name"), readable & (F.size(lacking) > 0)),
        ],
        ["name"],
    )
    found = basic.unionByName(profile_issues(rows.where(readable & (F.size(lacking) == 0)), "name", "version"))
    if expected:
        asked = spark.createDataFrame([(n,) for n in expected], "name string").join(docs.select("name"), "name", "left_anti")
        found = found.unionByName(asked.select("name", F.lit("NOT_FOUND").alias("code"), F.lit("no such file").alias("message"), F.col("name").alias("path")))
    return found


def profile_file_report(spark: SparkSession, path: str, expected: list[str] | None = None) -> DataFrame:
    """(passed, files, pass_ratio, exit_code) over profile documents; files that aren't there count as failed; 1.0 of none."""
    found = profile_file_issues(spark, path, expected)
    names = json_documents(spark, path, schema("LanguageProfileV1")).select(F.regexp_extract("path", r"[^/]+$", 0).alias("name"))
    if expected:
        names = names.unionByName(spark.createDataFrame([(n,) for n in expected], "name string"))
    marked = names.distinct().join(found.select("name").distinct().withColumn("bad", F.lit(1)), "name", "left")
    sums = marked.agg(F.count_if(F.col("bad").isNull()).alias("passed"), F.count(F.lit(1)).alias("files"))
    return sums.select("passed", "files", F.when(F.col("files") > 0, F.col("passed") / F.col("files")).otherwise(1.0).alias("pass_ratio"), (F.col("passed") < F.col("files")).cast("int").alias("exit_code"))


def example_profile() -> dict:
    """A language profile that passes all checks, as a plain object to start from."""
    return {
        "language": "en", "dialect": "en-US", "script": "Latin", "version": "1.0.0", "phoneme_inventory": ["p", "t", "k", "s", "m", "n", "i", "a", "u"],
        "g2p_rules": [{"pattern": "th", "ipa": "θ", "conditions": {"position": "initial"}, "priority": 5}],
        "g2p_overrides": [{"word": "the", "ipa": "ðə"}], "register_defaults": {"formal": 0.3, "informal": 0.7}, "style_tokens": ["calm"],
        "tts_defaults": {"speaking_rate": 1.0, "pitch_bias": 0.0, "pause_bias": 0.1, "filler_bias": 0.05}, "fallback_chain": ["en-GB"],
        "curation_targets": {"min_minutes_90": 30.0, "phoneme_coverage": 0.9}, "tts_strategy": "standalone",
    }


def profile_issues(profiles: DataFrame, key: str, version: str = "profile_version") -> DataFrame:
    """(key, code, message, path) of language profiles: version, register shares, fallback to itself, ranges, strategy."""
    total = F.aggregate(F.map_values("register_defaults"), F.lit(0.0), lambda a, x: a + x)
    at = F.col(key).cast("string")

    def outside(c: str, low: float, high: float) -> Column:
        return F.col(c).isNotNull() & (~F.col(c).between(low, high) | F.isnan(c))

    ranges = {"tts_defaults.speaking_rate": (0.5, 1.8), "tts_defaults.pitch_bias": (-12, 12), "tts_defaults.pause_bias": (0, 1), "tts_defaults.filler_bias": (0, 1), "curation_targets.phoneme_coverage": (0, 1)}
    found = [
        issue("SEMVER", "version isn't three numbers", F.concat(at, F.lit(".version")), ~F.coalesce(F.col(version).rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\z"), F.lit(False))),
        issue("REGISTER_SUM", "register shares don't sum to 1", F.concat(at, F.lit(".register_defaults")), F.col("register_defaults").isNotNull() & ~F.coalesce(F.abs(total - 1) < 1e-6, F.lit(False))),
        issue("SELF_FALLBACK", "falls back to itself", F.concat(at, F.lit(".fallback_chain")), F.array_contains("fallback_chain", F.col("dialect"))),
        issue("INVENTORY", "no phonemes", F.concat(at, F.lit(".phoneme_inventory")), F.coalesce(F.size("phoneme_inventory"), F.lit(0)) <= 0),
        issue("STRATEGY", "no known strategy", F.concat(at, F.lit(".tts_strategy")), ~F.coalesce(F.col("tts_strategy").isin(*STRATEGIES), F.lit(False))),
        *[issue("RANGE", f"{c} not from {a} to {b}", F.concat(at, F.lit(f".{c}")), outside(c, a, b)) for c, (a, b) in ranges.items()],
    ]
    return issues(profiles, found, [key])


def lint_manifest(manifest: DataFrame, key: str) -> DataFrame:
    """(key, code, message): clips out of 1.5 to 14 s (a missing duration is 0), clips without text and phonemes, and one row
    with a null key where the sample rates differ; a missing rate counts as a value."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    seconds = F.coalesce(F.col("duration_s"), F.lit(0.0))
    at = F.col(key).cast("string")
    rows = issues(
        manifest,
        [
            issue("DURATION", F.concat(F.coalesce("wav", F.lit("?")), F.lit(" duration out of bounds")), at, ~seconds.between(MIN_S, MAX_S) | F.isnan(seconds)),
            issue("NO_TEXT_OR_PHONEMES", F.concat(F.coalesce("wav", F.lit("?")), F.lit(" missing text/phonemes")), at, empty("text") & empty("phonemes")),
        ],
        [key],
    ).select(key, "code", "message")
    rates = manifest.agg((F.count_distinct("sample_rate") + F.max(F.col("sample_rate").isNull().cast("int"))).alias("n"))
    mixed = rates.where("n > 1").select(F.lit(None).cast(manifest.schema[key].dataType).alias(key), F.lit("SAMPLE_RATE_MIX").alias("code"), F.lit("Multiple sample rates detected").alias("message"))
    return rows.unionByName(mixed)
