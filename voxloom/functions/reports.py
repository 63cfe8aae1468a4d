"""Small texts and figures for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.functions.text import squeeze_and_truncate


def backoff(attempt: Column, initial: float = 2.0, factor: float = 2.0) -> Column:
    """Seconds to wait before the next attempt."""
    return initial * F.pow(F.lit(factor), attempt)


def duration_text(seconds: Column) -> Column:
    """``3m 20s``."""
    whole = F.floor(seconds).cast("long")
    return F.format_string("%dm %ds", F.floor(whole / 60).cast("long"), whole % 60)


def progress_text(done: Column, total: Column, elapsed_s: Column) -> Column:
    """``5/20 (25.0%), 3m 0s left``, by the pace so far."""
    left = F.when(done > 0, (total - done) * elapsed_s / done).otherwise(0)
    return F.concat(F.format_string("%d/%d (%.1f%%), ", done, total, F.when(total > 0, done * 100.0 / total).otherwise(0.0)), duration_text(left), F.lit(" left"))


def traffic_light(value: Column, target: Column) -> Column:
    """green at the target, yellow within 15 % of it, else red."""
    return F.when(value >= target, "green").when(value >= 0.85 * target, "yellow").otherwise("red")


# Colours of the states that a job or language can be in; any other state is gray.
BADGES = {"complete": "green", "completed": "green", "in-progress": "blue", "running": "blue", "pending": "yellow", "queued": "yellow", "failed": "red"}


def status_badge(status: Column) -> Column:
    """The colour of a state's badge; gray for null and unknown states."""
    table = F.create_map(*[F.lit(x) for pair in BADGES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, status), F.lit("gray"))


def progress_percent(value: Column, target: Column) -> Column:
    """Percent of a target, at most 100; 0 where there is no target."""
    return F.when(target > 0, F.least(F.lit(100.0), value * 100.0 / target)).otherwise(0.0)


def _section(title: str, items: Column, most: int, line) -> Column:
    shown = F.slice(items, 1, most)
    text = F.concat(F.lit(f"**{title}:**\n"), F.array_join(F.transform(shown, line), "\n"), F.lit("\n"))
    return F.when(F.size(items) > 0, text)


def word_card(word: dict[str, Column], full: bool = True) -> Column:
    """A word as markdown: definitions (15), pronunciations (10), examples (10) and, in the full form, parts of speech (5),
    etymology (2), related words (10) and a closing rule. Empty sections are left out."""
    bullet = lambda x: F.concat(F.lit("    • "), x)
    parts = [
        F.concat(F.lit("**Word:** "), word["word"], F.lit("\n")),
        F.concat(F.lit("**Language:** "), word["language"], F.lit("\n")),
        _section("Definitions", word["definitions"], 15, lambda x, i: F.concat(F.format_string("    %d. ", i + 1), squeeze_and_truncate(x))),
        _section("Pronunciations", word["pronunciations"], 10, bullet),
        _section("Examples", word["examples"], 10, lambda x: F.concat(F.lit('    • "'), squeeze_and_truncate(x), F.lit('"'))),
    ]
    if full:
        parts += [
            _section("Part of Speech", word["part_of_speech"], 5, bullet),
            _section("Etymology", word["etymology"], 2, lambda x: bullet(squeeze_and_truncate(x))),
            _section("Related Words", word["related_words"], 10, bullet),
        ]
    missing = F.lit("Not available")
    parts += [
        F.concat(F.lit("**URL:** "), F.coalesce(word["url"], missing)),
        F.concat(F.lit("**Scrape Date:** "), F.coalesce(word["scrape_date"], missing), F.lit("\n" if full else "")),
    ]
    if full:
        parts.append(F.lit("---"))
    return F.concat_ws("\n", *parts)
