"""Word records from HTML pages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
_RELATED = ("Synonyms", "Antonyms", "Related_terms")
RECORD = "definitions array<string>, pronunciations array<string>, examples array<string>, related_words array<string>"


class _Page(HTMLParser):
    """Collects the texts the selectors name while the page streams by."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, dict]] = []
        self.items: list[tuple[list[str], list[str]]] = []
        self.inside: list[tuple[int, int]] = []
        self.pron: list[str] = []
        self.examples: list[str] = []
        self.usage: list[str] = []
        self.related: list[tuple[int, str]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _VOID:
            return
        if tag in ("li", "dd") and self.open and self.open[-1][0] == tag:
            self.handle_endtag(tag)
        if tag == "li" and self.open and self.open[-1][0] == "ol":
            self.inside.append((len(self.open), len(self.items)))
            self.items.append(([], []))
        self.open.append((tag, dict(attrs)))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                self.inside = [x for x in self.inside if x[0] < i]
                return

    def handle_data(self, data: str) -> None:
        text = data.strip()
        if not text or not self.open:
            return
        tags = [t for t, _ in self.open]
        last, attrs = self.open[-1]
        classes = (attrs.get("class") or "").split()
        for depth, n in self.inside:
            self.items[n][0].append(text)
            if last == "span" and len(self.open) - 1 > depth:
                self.items[n][1].append(text)
        if last == "span" and "IPA" in classes:
            self.pron.append(text)
        if "dl" in tags and "dd" in tags[tags.index("dl") :] and last in ("dd", "cite"):
            self.examples.append(text)
        if last == "div" and "usage-example" in classes:
            self.usage.append(text)
        if last == "a" and "li" in tags:
            for t, a in self.open:
                if t == "div" and a.get("id") in _RELATED:
                    self.related.append((_RELATED.index(a["id"]), text))


def extract(html: str | None) -> tuple[list[str], list[str], list[str], list[str]]:
    """(definitions, pronunciations, examples, related words) of a page.

    Definitions are items of ordered lists: all their text, then the text of their spans once more. Pronunciations are spans of
    class IPA, each once. Examples are description list entries and usage examples without citation marks, if longer than
    five characters. Related words are links in lists under the headings for synonyms, antonyms and related terms.
    """
    page = _Page()
    page.feed(html or "")
    page.close()
    definitions = [" ".join(a + b) for a, b in page.items if a or b]
    examples = [e for e in (re.sub(r"\[\d+\]", "", x) for x in page.examples + page.usage) if len(e) > 5]
    return list(dict.fromkeys(d for d in definitions if d.strip())), list(dict.fromkeys(page.pron)), examples, [w for _, w in page.related]


def with_record(pages: DataFrame, html: str) -> DataFrame:
    """``pages`` with the arrays of RECORD, read in Arrow batches; empty arrays for null pages."""

    @F.pandas_udf(RECORD)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([extract(x) for x in s], columns=["definitions", "pronunciations", "examples", "related_words"])

    return pages.withColumn("_r", run(F.col(html))).select("*", "_r.*").drop("_r")
