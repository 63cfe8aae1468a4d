"""Exact duplicates, cosine neighbours, running budgets."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.text import normalize_text, text_hash
from voxloom.operators.lineage import cut
from voxloom.operators.ranking import rank_and_running

#: Vectors of queries that go to every task at a time.
QUERY_BLOCK = 20_000


def exact_classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, class_id, n_copies): rows with equal normalised text share the smallest key; null texts are in no class.

    Texts are read and hashed once; keys and hashes are written, and classes are found and joined on these narrow rows. AQE
    splits that join where one text holds very many rows.
    """
    hashed = cut(df.where(F.col(text).isNotNull()).select(key, F.unhex(text_hash(normalize_text(F.col(text)))).alias("_h")))
    classes = hashed.groupBy("_h").agg(F.min(key).alias("class_id"), F.count(F.lit(1)).alias("n_copies"))
    return hashed.join(classes, "_h").select(key, "class_id", "n_copies")


def without_duplicates(df: DataFrame, key: str, text: str, keep: Sequence[str] | None = None) -> DataFrame:
    """Of rows with equal normalised text the one with the smallest key; rows with a null text stay.

    One aggregate over the hash of the text takes the columns along (``keep`` names those that are wanted), so nothing is
    joined back, and copies meet already ahead of the shuffle. Of rows with a null text and the same key one stays.
    """
    kept = [c for c in df.columns if c == key or keep is None or c in keep]
    same, alone = text_hash(normalize_text(F.col(text))), F.col(key)
    there = F.col(text).isNotNull()
    groups = df.groupBy(F.when(there, same).alias("_h"), F.when(~there, alone).alias("_own"))
    return groups.agg(F.min_by(F.struct(*kept), key).alias("_r")).select("_r.*")


def _cosines(batches: Iterator[pa.RecordBatch], sets: list[tuple[np.ndarray, np.ndarray]], least: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        vectors = b.column(1)
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        flat = vectors.flatten().to_numpy(zero_copy_only=False)  # nulls become NaN
        begin = np.cumsum(sizes) - sizes
        keys = b.column(0).to_numpy(zero_copy_only=False)
        for ids, asked in sets:
            width = asked.shape[1]
            use = np.flatnonzero(sizes == width)
            if not len(use) or not width:
                continue
            m = flat[begin[use][:, None] + np.arange(width)]
            whole = ~np.isnan(m).any(1)
            m, own = m[whole], keys[use][whole]
            norm = np.linalg.norm(m, axis=1, keepdims=True)
            m = m / np.where(norm > 0, norm, 1)
            step = max(1, 4_000_000 // max(1, len(m)))
            for k in range(0, len(asked), step):
                sim = m @ asked[k : k + step].T
                r, q = np.nonzero((sim >= least) & (own[:, None] != ids[None, k : k + step]))
                if len(r):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[k : k + step][q]), pa.array(own[r]), pa.array(sim[r, q])], ["query_id", "near_id", "cosine"])


def cosine_search(vectors: DataFrame, queries: DataFrame, key: str, vector: str, least: float, block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, near_id, cosine): for each query all vectors with a cosine of at least ``least``, itself aside.

    Exact: a stated query set against all rows. Queries go out in blocks of at most about ``block``, one pass over the
    vectors per block, and a block is released before the next one is fetched. Null vectors and vectors with nulls or NaN are near
    nothing, vectors of different lengths not near each other; a zero vector has cosine 0.
    """
    vectors_of = lambda df: df.select(F.col(key).cast("bigint").alias("k"), F.col(vector).cast("array<double>").alias("v")).where("k IS NOT NULL AND v IS NOT NULL")
    rows, asked = vectors_of(vectors), vectors_of(queries)
    blocks = max(1, math.ceil(asked.count() / block))
    sc, out = vectors.sparkSession.sparkContext, None
    for i in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("k"), F.lit(blocks)) == i).collect()
        by_width: dict[int, list] = {}
        for r in part:
            if all(x is not None for x in r.v):
                by_width.setdefault(len(r.v), []).append(r)
        sets = []
        for same in by_width.values():
            m = np.array([r.v for r in same], np.float64).reshape(len(same), -1)
            norm = np.linalg.norm(m, axis=1, keepdims=True)
            sets.append((np.array([r.k for r in same], np.int64), m / np.where(norm > 0, norm, 1)))
        sent = sc.broadcast(sets)
        found = rows.mapInArrow(lambda b, s=sent: _cosines(b, s.value, least), "query_id bigint, near_id bigint, cosine double")
        if blocks > 1:  # each block is done and let go before the next one is fetched
            found = cut(found)
            sent.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def within_budget(df: DataFrame, groups: list[Column], order: list[Column], amount: str, budget: float, out: str = "within_budget") -> DataFrame:
    """``df`` with whether the running sum of ``amount`` in each group is still within the budget; null amounts count 0.

    Amounts are summed in whole millionths, over ranges of the order, so that a group of any size is shared out.
    """
    named = [g.alias(f"__vx_g{i}") for i, g in enumerate(groups)]
    rows = df.select(*df.columns, *named, F.round(F.col(amount) * 1_000_000).cast("long").alias("__vx_amount"))
    summed = rank_and_running(rows, [f"__vx_g{i}" for i in range(len(groups))], order, "__vx_amount", "__vx_no", "__vx_upto")
    return summed.select(*[c for c in df.columns if c != out], (F.col("__vx_upto") <= round(budget * 1_000_000)).alias(out))


def grounding_issues(segments: DataFrame, documents: DataFrame, ref: str, start: str, end: str, text: str, doc_key: str, doc_text: str) -> DataFrame:
    """Segments with why their offsets don't yield their text: no document, offsets out of order or bounds, other text."""
    docs = documents.select(F.col(doc_key).alias("_doc"), F.col(doc_text).alias("_text"))
    joined = segments.join(docs, F.col(ref) == F.col("_doc"), "left")
    cut_ = F.substring(F.col("_text"), F.col(start).cast("int") + 1, (F.col(end) - F.col(start)).cast("int"))
    why = (
        F.when(F.col("_doc").isNull(), "no document")
        .when(F.col(start).isNull() | F.col(end).isNull() | (F.col(start) < 0) | (F.col(start) >= F.col(end)), "offsets")
        .when(F.col(end) > F.length("_text"), "out of bounds")
        .when(~cut_.eqNullSafe(F.col(text)), "other text")
    )
    return joined.withColumn("reason", why).where("reason IS NOT NULL").drop("_doc", "_text")
