"""Writers: JSON lines, metadata CSV, dataset card, exports, markdown, rejects, schemas."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom import schemas


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line, nulls kept, letters as they are."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_metadata_csv(manifest: DataFrame, path: str, use_phonemes: bool = False) -> None:
    """wav, text (or phonemes) and speaker, by pipes, without a header, lines ended by CR LF; a missing speaker is spk_unknown."""
    text = F.col("phonemes" if use_phonemes else "text")
    rows = manifest.select("wav", F.coalesce(text, F.lit("")), F.coalesce("speaker_id", F.lit("spk_unknown")))
    rows.write.mode("overwrite").options(sep="|", escape='"', emptyValue="", nullValue="", lineSep="\r\n").csv(path)


def write_export(df: DataFrame, path: str, kind: str = "csv") -> bool:
    """CSV with a header, or JSON lines; False (and nothing written) for an empty result or an unknown kind."""
    if kind not in ("csv", "json") or df.isEmpty():
        return False
    writer = df.write.mode("overwrite")
    writer.option("header", True).option("escape", '"').csv(path) if kind == "csv" else writer.option("ignoreNullFields", False).json(path)
    return True


def write_markdown(cards: DataFrame, card: str, path: str) -> None:
    """One markdown text after the other."""
    cards.select(F.concat(F.col(card), F.lit("\n")).alias("value")).write.mode("overwrite").text(path)


def write_rejects(rejects: DataFrame, path: str) -> None:
    """Rejected rows (word, language, reason) as log lines with the time."""
    line = F.format_string("%s - Word: '%s' (%s) - Error: %s", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"), "word", "language", "reason")
    rejects.select(line.alias("value")).write.mode("append").text(path)


def write_pretty_json(df: DataFrame, path: str) -> None:
    """One indented JSON document per row, nulls kept, letters as they are; documents are set apart by an empty line."""
    whole = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false", "pretty": "true"})
    df.select(F.concat(whole, F.lit("\n")).alias("value")).write.mode("overwrite").text(path)


def feed_path(folder: str, language: str, at: datetime) -> str:
    """Where a feed of pages in a language goes: named by language and time."""
    return f"{folder}/wiktionary_{language}_{at:%Y%m%d_%H%M%S}.json"


_JSON_TYPES = {"string": {"type": "string"}, "double": {"type": "number"}, "boolean": {"type": "boolean"}, "timestamp": {"type": "string", "format": "date-time"}, "date": {"type": "string", "format": "date"}}


def _json_type(kind: T.DataType) -> dict:
    if isinstance(kind, T.StructType):
        return {"type": "object", "properties": {f.name: _json_type(f.dataType) for f in kind.fields}}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": _json_type(kind.elementType)}
    if isinstance(kind, T.MapType):
        return {"type": "object", "additionalProperties": _json_type(kind.valueType)}
    if isinstance(kind, T.IntegralType):
        return {"type": "integer"}
    return dict(_JSON_TYPES.get(kind.typeName(), {"type": "number"}))


def schema_json(name: str) -> str:
    """The JSON Schema of a contract."""
    return json.dumps({"$schema": "https://json-schema.org/draft/2020-12/schema", "title": name, **_json_type(schemas.schema(name))}, ensure_ascii=False, indent=2)


def schema_documents(spark: SparkSession) -> DataFrame:
    """(name, file, document): the JSON Schema of every contract, and an index that names them all."""
    rows = [(n, f"{n}.json", schema_json(n)) for n in schemas.names()]
    index = json.dumps({n: f for n, f, _ in rows}, indent=2)
    return spark.createDataFrame([*rows, ("index", "index.json", index)], "name string, file string, document string")
