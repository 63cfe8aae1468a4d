"""Pronunciation functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Per dialect whether r is said everywhere, and signs of the dialect: a pattern and what must then occur.
DIALECTS = {
    "American": (True, (("t(?=n)", ("t", "ʔ")), (r"nt(?=[\p{L}\p{N}_])", ("n(t)", "ʔ")), ("æ(?=[mnŋ][dk])|æ(?=[sk]|sp)", ("æ", "eə")))),
    "British": (False, (("ɑː", ("ɑː",)), (r"t(?=[\p{L}\p{N}_])", ("t",)), (r"ju(?=[\p{L}\p{N}_])", ("ju", "u")))),
    "Australian": (False, (("eɪ", ("æɪ",)), ("aɪ", ("ɑɪ",)), ("əʊ", ("əʉ",)))),
}
# An r that is said at the end or before a consonant, consonants of clusters, vowels of syllables.
RHOTIC = r"[ɹɻrɾ](?:$|[^aeiouəɑɛɪɔʊʌæɒ])"
CLUSTER = "(?iu)[bcdfghjklmnpqrstvwxyzðθʃʒŋɹɾɻ]{2,}"
VOWELS = "(?iu)[aeiouæɑɛɪɔʊʌəɒ]+"


def normalize_ipa(ipa: Column) -> Column:
    """IPA without enclosing slash or bracket and stress marks, r-coloured schwa written out; null for null or empty."""
    bare = F.regexp_replace(F.regexp_replace(ipa, r"^[/\[(]", ""), r"[/\])]$", "")
    return F.when(ipa != "", F.translate(F.replace(bare, F.lit("ɚ"), F.lit("əɹ")), "ˈˌ", ""))


def is_rhotic(ipa: Column) -> Column:
    """Whether an r stands at the end or before a consonant."""
    return F.coalesce(ipa.rlike(RHOTIC), F.lit(False))


def dialect_scores(ipa: Column) -> Column:
    """Array of (dialect, confidence), best first: a fifth for fitting rhoticity and for every sign that occurs, at most 1."""
    rhotic, parts = is_rhotic(ipa), []
    for n, (name, (wants, signs)) in enumerate(DIALECTS.items()):
        score = (rhotic == F.lit(wants)).cast("int")
        for pattern, options in signs:
            hits = sum(((ipa.contains(o)).cast("int") for o in options), F.lit(0))
            score = score + F.when(ipa.rlike(pattern), hits).otherwise(0)
        parts.append(F.struct((-F.least(score / 5.0, F.lit(1.0))).alias("minus"), F.lit(n).alias("n"), F.lit(name).alias("dialect")))
    found = F.filter(F.array_sort(F.array(*parts)), lambda x: x["minus"] < 0)
    scored = F.transform(found, lambda x: F.struct(x["dialect"].alias("dialect"), (-x["minus"]).alias("confidence")))
    return F.when(ipa != "", scored).otherwise(F.array().cast("array<struct<dialect:string,confidence:double>>"))


def pronunciation_variant(ipa: Column, dialect: Column) -> Column:
    """``standard``, or the likeliest dialect in lower case if it is surer than 0.7 and none is given."""
    top = F.try_element_at(dialect_scores(ipa), F.lit(1))
    return F.when((top["confidence"] > 0.7) & dialect.isNull(), F.lower(top["dialect"])).otherwise("standard")


def pronunciation_note(ipa: Column) -> Column:
    """What normalising did to a pronunciation, and whether it is rhotic."""
    # The wording of the note.
    norm = normalize_ipa(ipa)
    return F.concat(F.lit("Normalized from '"), ipa, F.lit("' to '"), norm, F.lit("'. "), F.when(is_rhotic(norm), F.lit("Features: rhoticity: True")).otherwise(""))


def audio_placeholder(word_id: Column) -> Column:
    """Path of a word's recording."""
    return F.format_string("audio_files/word_%d.mp3", word_id)


def phonemes(ipa: Column) -> Column:
    """Pieces between white space, hyphens and full stops."""
    return F.regexp_extract_all(ipa, F.lit(r"[^\s\-.]+"), F.lit(0))


def consonant_clusters(ipa: Column) -> Column:
    """Runs of two or more consonants."""
    return F.regexp_extract_all(ipa, F.lit(CLUSTER), F.lit(0))


def syllables(ipa: Column) -> Column:
    """Runs of vowels, at least 1; null for null."""
    return F.greatest(F.lit(1), F.size(F.regexp_extract_all(ipa, F.lit(VOWELS), F.lit(0))))


def cluster_frequencies(df: DataFrame, ipa: str, group: str, top: int = 20) -> DataFrame:
    """(group, cluster, n, rank): the ``top`` consonant clusters of each group; ties by the cluster."""
    from pyspark.sql import Window

    counts = df.select(group, F.explode(consonant_clusters(F.col(ipa))).alias("cluster")).groupBy(group, "cluster").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy(group).orderBy(F.desc("n"), "cluster")
    return counts.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
