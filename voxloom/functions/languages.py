"""Language labels: codes, regions and names."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameters: two-letter codes with their three-letter codes, English names and own names.
LANGUAGES = {
    "ak": ("aka", "akan", "twi", "tw", "fante", "fat"),
    "de": ("deu", "ger", "german", "deutsch"),
    "en": ("eng", "english"),
    "es": ("spa", "spanish", "español", "espanol", "castilian", "castellano"),
    "fr": ("fra", "fre", "french", "français", "francais"),
    "pt": ("por", "portuguese", "português", "portugues"),
    "sw": ("swa", "swh", "swc", "swahili", "kiswahili"),
    "it": ("ita", "italian", "italiano"),
    "nl": ("nld", "dut", "dutch", "nederlands"),
    "sv": ("swe", "swedish", "svenska"),
    "no": ("nor", "nob", "nno", "nb", "nn", "norwegian", "norsk"),
    "da": ("dan", "danish", "dansk"),
    "pl": ("pol", "polish", "polski"),
    "ru": ("rus", "russian", "русский"),
    "zh": ("zho", "chi", "cmn", "chinese", "mandarin", "中文"),
    "ja": ("jpn", "japanese", "日本語"),
    "ar": ("ara", "arabic", "العربية"),
    "hi": ("hin", "hindi", "हिन्दी"),
    "yo": ("yor", "yoruba"),
    "ig": ("ibo", "igbo"),
    "ha": ("hau", "hausa"),
}
# Parameters: labels that name no language.
NO_LANGUAGE = ("", "unknown", "unk", "und", "xx", "xxx", "zxx", "mul", "mis", "n/a", "na", "none", "null", "nan", "other", "?", "-", "undefined", "undetermined")

_KNOWN = {name: code for code, names in LANGUAGES.items() for name in (code, *names)}


def language_code(label: Column) -> Column:
    """The two-letter code that a label names: codes, codes with a region or script, and names, in any letter case.

    Null for null and for labels that name no language; another language's label comes back in lower case without its region.
    """
    low = F.lower(F.trim(label))
    stem = F.regexp_extract(low, r"^([^-_]*)", 1)
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(_KNOWN.items())])
    return F.when(low.isin(*NO_LANGUAGE) | stem.isin(*NO_LANGUAGE), F.lit(None)).otherwise(F.coalesce(F.try_element_at(table, low), F.try_element_at(table, stem), stem))
