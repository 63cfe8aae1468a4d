"""Kinds and reliability of sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Terms in a source's name, and in its host, that show its kind, in the order they are tried.
NAME_TERMS = {
    "academic": ("journal", "university", "research", "proceedings", "academia"),
    "dictionary": ("dictionary", "lexicon", "wordnet", "oxford", "cambridge", "merriam", "webster"),
    "linguistic_resource": ("linguistics", "corpus", "grammar", "phonology", "syntax"),
    "user_contributed": ("forum", "wiki", "blog", "community", "user"),
}
HOST_TERMS = {
    "academic": ("edu", "ac.uk", "research"),
    "dictionary": ("dictionary", "lexicon", "oxford", "cambridge", "merriam-webster"),
    "linguistic_resource": ("linguistics", "grammar", "language"),
    "user_contributed": ("wiki", "forum", "blog"),
}
# Starting score, hosts and name keywords of each kind, and hosts that are trusted in general.
RELIABILITY = {
    "academic": (4.0, ("edu", "ac.uk", "research", "university"), ("journal", "published", "research", "study", "peer-reviewed")),
    "dictionary": (3.5, ("dictionary", "lexicon", "merriam-webster", "oxford", "cambridge"), ("dictionary", "definition", "lexicon", "wordlist")),
    "linguistic_resource": (3.0, ("linguistics", "language", "grammar"), ("corpus", "linguistic", "grammar", "syntax", "phonology")),
    "general_reference": (2.5, ("reference", "wikipedia", "encyclopedia"), ("reference", "guide", "encyclopedia", "wiki")),
    "user_contributed": (1.5, ("forum", "community", "wiki", "blog"), ("forum", "discussion", "user", "comment", "blog")),
}
TRUSTED_HOSTS = ("oxford", "cambridge", "merriam-webster", "britannica", "edu", "gov", "ac.uk", "linguisticsociety.org")


def _any(text: Column, terms: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (text.contains(t) for t in terms))


def host(url: Column) -> Column:
    """The host part of an address in lower case, empty if there is none."""
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("AUTHORITY"))), F.lit(""))


def source_type(name: Column, url: Column) -> Column:
    """The kind of a source by its name, else by its host, else general_reference."""
    out = None
    for text, table in ((F.lower(name), NAME_TERMS), (host(url), HOST_TERMS)):
        for kind, terms in table.items():
            out = F.when(_any(text, terms), kind) if out is None else out.when(_any(text, terms), kind)
    return out.otherwise("general_reference")


def source_reliability(name: Column, url: Column, kind: Column) -> Column:
    """0 to 5: the kind's score, a tenth per keyword in the name, 0.3 for a host of the kind and 0.5 for a trusted one.

    0 for a null or empty name; an unknown kind counts as general_reference, a null kind is worked out from name and host.
    """
    low, at, known = F.lower(name), host(url), F.coalesce(kind, source_type(name, url))
    out = None
    for k, (base, hosts, keywords) in RELIABILITY.items():
        score = F.lit(base)
        for w in keywords:
            score = score + low.contains(w).cast("double") * 0.1
        score = score + _any(at, hosts).cast("double") * 0.3
        if k != "general_reference":
            out = F.when(known == k, score) if out is None else out.when(known == k, score)
        else:
            fallback = score
    total = out.otherwise(fallback) + _any(at, TRUSTED_HOSTS).cast("double") * 0.5
    return F.when(F.coalesce(name, F.lit("")) == "", 0.0).otherwise(F.least(F.lit(5.0), total))


def url_status(status: Column, location: Column, url: Column) -> tuple[Column, Column]:
    """(ok, address) from a response's status: 200, 203 and 206 are fine; a redirect gives its target."""
    moved = status.isin(301, 302, 307, 308) & location.isNotNull()
    return F.coalesce(status.isin(200, 203, 206), F.lit(False)) | moved, F.when(moved, location).otherwise(url)
