"""Readers: JSON lines, CSV, WAV headers, word lists, pages, SQL sources."""

from __future__ import annotations

import configparser
import os
import wave
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom.operators.lineage import cut


def jsonl_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a declared schema; a malformed line ends the job. Blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line): the lines of text files that aren't blank, numbered from 1 within their file, blanks counted.

    Big files are split by Spark into blocks. Lines of a block come in order, so a line's place is its id less the block's first
    one, shifted by the lines of the file's earlier blocks; one row per block is enough for both, and no line is sorted.
    """
    raw = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.col("value").alias("line"), F.monotonically_increasing_id().alias("_at"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        raw.groupBy("file", "_block")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1 - F.col("_first"))
        .drop("_n", "_first")
    )
    return raw.join(blocks, ["file", "_block"]).select("file", (F.col("_at") + F.col("_shift")).alias("line_no"), "line").where(F.trim("line") != "")


def jsonl_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line, value): value is the line as VARIANT, null where it isn't JSON."""
    return numbered_lines(spark, path).withColumn("value", F.try_parse_json("line"))


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, all columns as text, with line_no, the number of the record counted from 2, and the file's name.

    Quoted line breaks belong to their record, so a file is read by one task, record after record; records are numbered from
    each file's first one, for which one row per file is enough. A column named file or line_no is replaced.
    """
    raw = spark.read.options(header=True, multiLine=True, escape='"', inferSchema=False, enforceSchema=True).csv(path).drop("file", "line_no")
    rows = cut(raw.select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("_at"), *[F.col(f"`{c}`") for c in raw.columns]))
    first = rows.groupBy("file").agg(F.min("_at").alias("_first"))
    return rows.join(first, "file").select("file", (F.col("_at") - F.col("_first") + 2).alias("line_no"), *[F.col(f"`{c}`") for c in raw.columns])


def metadata_rows(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, audio_file, text, speaker_id) of a pipe-delimited file without a header."""
    parsed = F.from_csv("line", "audio_file string, text string, speaker_id string", {"sep": "|", "escape": '"'})
    return numbered_lines(spark, path).select("file", "line_no", parsed.alias("r")).select("file", "line_no", "r.*")


def _probe(path: str) -> tuple:
    """(rate, channels, seconds, width, error) from a file's header; the sound itself isn't read."""
    try:
        with open(path.removeprefix("file:"), "rb") if path.startswith(("file:", "/")) else _remote(path) as f, wave.open(f, "rb") as w:
            return w.getframerate(), w.getnchannels(), w.getnframes() / float(w.getframerate()), w.getsampwidth(), None
    except Exception as e:  # noqa: BLE001 - whatever is wrong with a file is its finding
        return None, None, None, None, str(e) or type(e).__name__


def _remote(path: str):
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path)
    return system.open_input_file(at)


def wav_headers(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, sample_rate, channels, duration_s, sample_width, error) of the WAV files under a folder."""

    @F.pandas_udf("sample_rate int, channels int, duration_s double, sample_width int, error string")
    def probe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([_probe(x) for x in s], columns=["sample_rate", "channels", "duration_s", "sample_width", "error"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[wW][aA][vV]").load(path)
    return files.select("path", F.regexp_extract("path", r"[^/]+$", 0).alias("name"), probe("path").alias("m")).select("path", "name", "m.*")


def word_list(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(word): trimmed lines that aren't empty, the first ``limit`` by line number."""
    words = numbered_lines(spark, path).select("line_no", F.trim("line").alias("word"))
    return (words.orderBy("line_no").limit(limit) if limit is not None else words).select("word")


def json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(path, value, error): whole JSON files; the error tells files that can't be parsed, whose value is null."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    parsed = F.from_json("value", schema)
    return text.select("path", F.when(F.try_parse_json("value").isNotNull(), parsed).alias("value"), F.when(F.try_parse_json("value").isNull(), F.lit("not JSON")).alias("error"))


def newest_file(spark: SparkSession, path: str) -> DataFrame:
    """(path, modified): the newest file a pattern finds; the larger path where two are as new."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("modificationTime").alias("modified"))
    return files.agg(F.max_by("path", F.struct("modified", "path")).alias("path"), F.max("modified").alias("modified"))


#: Word lists by name: the file they come from, and how many words of it are taken (None: all).
WORD_LISTS: dict[str, tuple[str, int | None]] = {}
#: Settings of each source of pages; ``domain`` is a template that the language's code is put into.
PAGE_SOURCES: dict[str, dict[str, str]] = {"wiktionary": {"domain": "{language}.wiktionary.org"}}


def named_word_list(spark: SparkSession, name: str, lists: dict[str, tuple[str, int | None]] | None = None) -> DataFrame:
    """The words of a registered list; an unknown name gives an empty table."""
    found = (WORD_LISTS if lists is None else lists).get(name)
    return word_list(spark, *found) if found else spark.createDataFrame([], "word string")


def language_domain(language: Column, source: str = "wiktionary") -> Column:
    """The host of a source's pages in a language; an unknown source has the first one's template."""
    template = PAGE_SOURCES.get(source, {}).get("domain") or next(iter(PAGE_SOURCES.values()))["domain"]
    return F.replace(F.lit(template), F.lit("{language}"), language)


def page_addresses(words: DataFrame, domain: Column, word: str = "word") -> DataFrame:
    """``words`` with the address of each word's page on a language's site."""
    return words.withColumn("url", F.concat(F.lit("https://"), domain, F.lit("/wiki/"), F.url_encode(F.replace(F.col(word), F.lit(" "), F.lit("_")))))


def database_options(path: str | None = None, section: str = "postgresql") -> dict[str, str]:
    """JDBC options from a section of an INI file, else from DB_HOST, DB_PORT, DB_NAME, DB_USER and DB_PASSWORD."""
    if path:
        parser = configparser.ConfigParser()
        parser.read(path)
        if not parser.has_section(section):
            raise KeyError(f"no section {section} in {path}")
        given = dict(parser.items(section))
    else:
        given = {k: v for k, v in {"host": os.environ.get("DB_HOST", "localhost"), "port": os.environ.get("DB_PORT", "5432"), "database": os.environ.get("DB_NAME", ""), "user": os.environ.get("DB_USER", ""), "password": os.environ.get("DB_PASSWORD", "")}.items() if v}
    url = f"jdbc:postgresql://{given.get('host', 'localhost')}:{given.get('port', '5432')}/{given.get('database', '')}"
    return {"url": url, **{k: given[k] for k in ("user", "password") if k in given}}


def sql_query(spark: SparkSession, query: str, params: dict | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """A query with bound parameters over the session's tables and views, or over a database given by ``options``."""
    if options is None:
        return spark.sql(query, args=params or {})
    return spark.read.format("jdbc").options(**options).option("query", query).load()


def failure_log(spark: SparkSession, path: str) -> DataFrame:
    """(logged_at, word, language, reason) from lines like ``2025-01-01 10:00:00 - Word: 'x' (en) - Error: reason``."""
    pattern = r"^(\S+ \S+) - Word: '(.*)' \(([^)]*)\) - Error: (.*)$"
    lines = spark.read.text(path).where(F.col("value").rlike(pattern))
    return lines.select(
        F.try_to_timestamp(F.replace(F.regexp_extract("value", pattern, 1), F.lit(","), F.lit("."))).alias("logged_at"),
        *[F.regexp_extract("value", pattern, i).alias(n) for i, n in ((2, "word"), (3, "language"), (4, "reason"))],
    )
