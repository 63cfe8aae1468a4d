"""Problem 8: mixing sources to target weights."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.batches import by_size
from voxloom.operators.lineage import cut, spread
from voxloom.operators.ranking import rank_and_running

#: A public byte-level vocabulary as ranks; any such file can be given instead.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how that vocabulary cuts text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


@lru_cache(maxsize=2)
def _encoding(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line.strip())}
    return tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(df: DataFrame, text: str, out: str = "n_tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """``df`` without ``text`` but with its number of tokens; 0 for null.

    The vocabulary is read where the query is planned and sent to all tasks, so the file need not lie on every machine.
    """
    with open(tokenizer, "rb") as f:
        sent = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(sent.value).encode_ordinary
        for b in by_size(batches, "_text"):
            n = [len(encode(t)) if t else 0 for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], [*b.schema.names[:-1], out])

    rest = [c for c in df.columns if c not in (text, out)]
    given = df.select(*rest, F.col(text).alias("_text"))
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1]], f"`{out}` bigint"])
    return given.mapInArrow(run, ddl)


def source_key(source: Column) -> Column:
    """The form in which all spellings of one source agree: letters and digits in lower case. Null where there are none."""
    key = F.regexp_replace(F.lower(source), r"[^\p{L}\p{N}]+", "")
    return F.when(key != "", key)


def allocate(targets: list[tuple[float, float]], total: float) -> list[float]:
    """Tokens for each source from (target share, most it can give): the shares of ``total``, and what sources that fall short
    leave is spread over the others in proportion to their shares."""
    given = [0.0] * len(targets)
    open_ = [i for i, (s, m) in enumerate(targets) if s > 0 and m > 0]
    left = total
    while open_:
        shares = sum(targets[i][0] for i in open_)
        short = [i for i in open_ if targets[i][1] <= left * targets[i][0] / shares]
        if not short:
            for i in open_:
                given[i] = left * targets[i][0] / shares
            break
        for i in short:
            given[i] = targets[i][1]
        left -= sum(targets[i][1] for i in short)
        open_ = [i for i in open_ if i not in short]
    return given


def scale_for(bins: list[tuple[float, float, float]], cap: int, goal: float) -> float:
    """The factor f for which the sum of tokens * min(cap, f * weight) over bins (tokens, tokens * weight, largest weight) is goal."""
    low, high = 0.0, 1.0
    worth = lambda f: sum(min(cap * t, f * tw) for t, tw, _ in bins)
    while worth(high) < goal * (1 - 1e-12) and high < 1e18:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if worth(mid) < goal else (low, mid)
    return high


def plan_mixes(
    documents: DataFrame, targets: DataFrame, weight: Column | None = None, total_tokens: int | None = None, seed: int = 0, tokenizer: str = TOKENIZER
) -> tuple[DataFrame, DataFrame]:
    """(plan, shares): copies of each document for each mix, and what each source was meant to and does contribute.

    ``documents`` (doc_id, source, text), ``targets`` (mix_name, source, target_share, max_repeats): a configuration table,
    of which only the rows come to the driver. A mix has ``total_tokens`` tokens, by default as many as its sources hold.
    Every source gets its share of that; one that can't fill it with max_repeats copies of all its texts gives these, and the
    others grow in proportion. Within a source a document is expected f * weight times, at most max_repeats: the whole part
    of that is certain, and the rest is drawn by Pareto order sampling: documents are ranked by the odds of a random number
    over the odds of their rest, and the first ones are taken until the source has its tokens.

    Spellings of a source are one source. Documents without source, id or tokens are in no mix; targets without mix, source,
    positive share or repeats are left out; of a source named twice in a mix the shares add up and the largest repeats hold.
    Sources without documents get 0. Results name a source as the targets write it. plan: mix_name, doc_id, source, n_tokens, copies (at least 1).
    shares has one row per target: target_share, attainable_share (after sources that fall short) and actual_share, which differs
    from that by at most half a document's tokens.
    """
    spark = documents.sparkSession
    goals = (
        targets.select("mix_name", source_key(F.col("source")).alias("source"), F.trim("source").alias("label"), "target_share", "max_repeats")
        .where("mix_name IS NOT NULL AND source IS NOT NULL AND target_share > 0 AND max_repeats > 0 AND NOT isnan(target_share)")
        .groupBy("mix_name", "source")
        .agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("cap"), F.min("label").alias("label"))
        .collect()
    )
    wanted = sorted({r.source for r in goals})
    rows = documents.select("doc_id", source_key(F.col("source")).alias("source"), F.lit(1.0).alias("_w") if weight is None else weight.cast("double").alias("_w"), "text")
    rows = rows.where(F.col("source").isin(wanted) & F.col("doc_id").isNotNull() & (F.length("text") > 0))
    sized = cut(count_tokens(spread(rows, "doc_id"), "text", tokenizer=tokenizer).where("n_tokens > 0").withColumn("_w", F.greatest(F.coalesce("_w", F.lit(0.0)), F.lit(1e-9))))
    bins = (
        sized.groupBy("source", F.floor(F.log2("_w") * 16).alias("_bin"))
        .agg(F.sum("n_tokens").alias("t"), F.sum(F.col("n_tokens") * F.col("_w")).alias("tw"), F.max("_w").alias("w"))
        .collect()
    )
    by: dict[str, list[tuple[float, float, float]]] = {}
    for r in bins:
        by.setdefault(r.source, []).append((float(r.t), float(r.tw), float(r.w)))
    held = {s: sum(b[0] for b in bs) for s, bs in by.items()}
    settings = []
    for mix in sorted({r.mix_name for r in goals}):
        own = sorted((r for r in goals if r.mix_name == mix), key=lambda r: r.source)
        total = total_tokens if total_tokens is not None else sum(held.get(r.source, 0) for r in own)
        amounts = allocate([(r.share, r.cap * held.get(r.source, 0.0)) for r in own], float(total))
        for r, amount in zip(own, amounts, strict=True):
            f = scale_for(by[r.source], r.cap, amount) if amount > 0 else 0.0
            settings.append((mix, r.source, r.label, float(r.share), int(r.cap), int(held.get(r.source, 0)), float(amount), f))
    config = spark.createDataFrame(settings, "mix_name string, source string, label string, target_share double, cap int, available bigint, amount double, f double")
    small = F.broadcast(config) if len(settings) <= 100_000 else config
    draws = sized.join(small, "source").where("f > 0").withColumn("_e", F.least(F.col("cap").cast("double"), F.col("f") * F.col("_w")))
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "mix_name", F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    draws = (
        draws.withColumn("_sure", F.floor("_e").cast("long"))
        .withColumn("_pi", F.col("_e") - F.col("_sure"))
        .withColumn("_q", F.when(F.col("_pi") > 0, (u / (1 - u)) / (F.col("_pi") / (1 - F.col("_pi")))))
        .select("mix_name", "source", "label", "doc_id", "n_tokens", "amount", "_sure", "_q")
    )
    certain = draws.groupBy("mix_name", "source").agg(F.sum(F.col("_sure") * F.col("n_tokens")).alias("_certain"))
    ranked = rank_and_running(draws, ["mix_name", "source"], [F.col("_q").asc_nulls_last(), F.col("doc_id").asc()], value="n_tokens")
    plan = (
        ranked.join(certain, ["mix_name", "source"])
        .withColumn("_more", (F.col("_q").isNotNull() & (F.col("running") - F.col("n_tokens") / 2 <= F.col("amount") - F.col("_certain"))).cast("long"))
        .withColumn("copies", (F.col("_sure") + F.col("_more")).cast("int"))
        .where("copies > 0")
        .select("mix_name", "doc_id", F.col("label").alias("source"), "n_tokens", "copies")
    )
    used = plan.groupBy("mix_name", F.col("source").alias("label")).agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("used"))
    totals = used.groupBy("mix_name").agg(F.sum("used").alias("_all"))
    shares = (
        config.join(used, ["mix_name", "label"], "left")
        .join(totals, "mix_name", "left")
        .select(
            "mix_name",
            F.col("label").alias("source"),
            "target_share",
            F.col("cap").alias("max_repeats"),
            F.col("available").alias("available_tokens"),
            F.coalesce("used", F.lit(0)).alias("used_tokens"),
            (F.col("amount") / F.sum("amount").over(Window.partitionBy("mix_name"))).alias("attainable_share"),
            F.coalesce(F.col("used") / F.col("_all"), F.lit(0.0)).alias("actual_share"),
            (F.col("amount") >= F.col("cap") * F.col("available")).alias("limited"),
        )
    )
    return plan, shares
