"""Text functions as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of common language codes.
LANGUAGE_NAMES = {
    "en": "English", "es": "Spanish", "fr": "French", "de": "German", "it": "Italian", "pt": "Portuguese",
    "ru": "Russian", "zh": "Chinese", "ja": "Japanese", "ko": "Korean", "ar": "Arabic", "hi": "Hindi",
}


def normalize_text(text: Column, lowercase: bool = True, remove_punctuation: bool = True, remove_whitespace: bool = False) -> Column:
    """Lower case, without punctuation, white space squeezed (or removed) and trimmed; null becomes empty.

    Letters, digits, the underscore and white space stay; combining marks count as punctuation.
    """
    out = F.coalesce(text, F.lit(""))
    if lowercase:
        out = F.lower(out)
    if remove_punctuation:
        out = F.regexp_replace(out, r"[^\p{L}\p{N}_\s ]", "")
    out = F.regexp_replace(out, r"[\s ]+", "" if remove_whitespace else " ")
    return F.trim(out)


def text_hash(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes in hexadecimal; null for null."""
    return F.sha2(text, 256)


def is_language_code(code: Column) -> Column:
    """Whether a code is two or three lower-case letters, or two with a two-letter region; false for null."""
    return F.coalesce(code.rlike(r"^(?:[a-z]{2,3}|[a-z]{2}-[A-Z]{2})\z"), F.lit(False))


def language_name(df: DataFrame, code: str, languages: DataFrame, out: str = "language_name") -> DataFrame:
    """``df`` with the name of a language: from the fixed names, else from ``languages`` (language_code, language_name), else null.

    A code given twice in ``languages`` takes its smallest name.
    """
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(LANGUAGE_NAMES.items())])
    names = languages.groupBy(F.col("language_code").alias("_code")).agg(F.min("language_name").alias("_name"))
    joined = df.join(names, F.col(code) == F.col("_code"), "left")
    return joined.withColumn(out, F.coalesce(F.try_element_at(table, F.col(code)), F.col("_name"))).drop("_code", "_name")


def squeeze_and_truncate(text: Column, limit: int = 100) -> Column:
    """White space squeezed and trimmed; more than ``limit`` characters are cut and end in three dots."""
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(flat) > limit, F.concat(F.substring(flat, 1, limit - 3), F.lit("..."))).otherwise(flat)


def strip_citations(text: Column) -> Column:
    """Text without citation marks like [12]."""
    return F.regexp_replace(text, r"\[[0-9]+\]", "")


def clean_examples(examples: Column, least: int = 5) -> Column:
    """Examples without citation marks, those longer than ``least`` characters."""
    return F.filter(F.transform(examples, strip_citations), lambda x: F.length(x) > least)


def clean_definitions(definitions: Column) -> Column:
    """Definitions that aren't blank, each once, in the order they first stand in."""
    return F.array_distinct(F.filter(definitions, lambda x: F.length(F.trim(x)) > 0))


def chunks(df: DataFrame, key: str, text: str, size: int = 400, overlap: int = 50) -> DataFrame:
    """(key, chunk_no, start_char, end_char, chunk): windows of ``size`` characters that overlap by ``overlap``.

    The last chunk ends with the text. Null and empty texts give none.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")
    step = size - overlap
    n = F.length(text)
    last = F.greatest(F.lit(0), F.ceil((n - size) / step)).cast("int")
    at = df.where(n > 0).select(key, text, F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"))
    start = (F.col("chunk_no") * step).cast("int")
    end = F.least(start + size, F.length(text))
    return at.select(key, "chunk_no", start.alias("start_char"), end.alias("end_char"), F.substring(F.col(text), start + 1, F.lit(size)).alias("chunk"))


def sentences(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, sentence_no, sentence): a text cut after full stops, question and exclamation marks; blank pieces are left out."""
    parts = F.split(F.regexp_replace(text, r"([.?!])\s+", "$1\n"), r"\n+")
    return (
        df.select(key, F.posexplode(parts).alias("sentence_no", "sentence"))
        .withColumn("sentence", F.trim("sentence"))
        .where(F.length("sentence") > 0)
    )
