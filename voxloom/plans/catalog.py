"""All queries outside the subpackage for training data."""

from __future__ import annotations

from voxloom.plans import corpus, files, intervals, lexicon, tables

QUERIES = {**corpus.QUERIES, **tables.QUERIES, **intervals.QUERIES, **lexicon.QUERIES, **files.QUERIES}
ORACLE = {**corpus.ORACLE, **tables.ORACLE, **intervals.ORACLE, **lexicon.ORACLE, **files.ORACLE}
