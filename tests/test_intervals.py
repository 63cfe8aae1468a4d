import random
from collections import defaultdict

from voxloom.functions.readings import in_force, milliseconds, recording, speaker_key
from voxloom.operators.intervals import periods_and_gaps
from voxloom.operators.ranking import rank_and_running
from voxloom.operators.runs import merge_runs
from pyspark.sql import functions as F

SCHEMA = "f string, s string, a bigint, b bigint, kind string"


def brute(rows):
    groups = defaultdict(list)
    for f, s, a, b, _ in rows:
        if None not in (f, s, a, b) and b > a:
            groups[f, s].append((a, b))
    out = set()
    for (f, s), xs in groups.items():
        merged = []
        for a, b in sorted(xs):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out |= {(f, s, "period", a, b) for a, b in merged}
        out |= {(f, s, "gap", x[1], y[0]) for x, y in zip(merged, merged[1:])}
    return out


def test_random_intervals_with_one_busy_key(spark):
    r = random.Random(1)
    rows = []
    for _ in range(3000):
        f = "hot" if r.random() < 0.4 else f"f{r.randrange(20)}"
        a = r.randrange(0, 3_000_000)
        rows.append((f, f"s{r.randrange(3)}", a, a + r.choice([-5, 0, 1, 500, 4000, 60000]), "x"))
    rows += rows[:200]
    got = periods_and_gaps(spark.createDataFrame(rows, SCHEMA), ["f", "s"], "a", "b", block_ms=50_000)
    assert {tuple(x) for x in got.select("f", "s", "kind", "a", "b").collect()} == brute(rows)


def test_touching_nested_nulls_and_empty(spark):
    rows = [("f", "s", 0, 10, "k"), ("f", "s", 10, 20, "k"), ("f", "s", 12, 15, "k"), ("f", "s", 21, 30, "k"), ("f", None, 0, 9, "k"), (None, "s", 0, 9, "k"), ("f", "s", None, 5, "k"), ("f", "s", 5, None, "k"), ("f", "s", -10, -3, "k")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = periods_and_gaps(df, ["f", "s"], "a", "b").select("kind", "a", "b").collect()
    assert sorted(map(tuple, got)) == [("gap", -3, 0), ("gap", 20, 21), ("period", -10, -3), ("period", 0, 20), ("period", 21, 30)]
    assert periods_and_gaps(df.limit(0), ["f", "s"], "a", "b").count() == 0


def test_readings(spark):
    df = spark.createDataFrame([("SPEAKER es-000088", "./clips/REC_0007/2.WAV", 1.0005), ("es_00088", "x.wav", float("nan")), (" ES 88 ", None, None), ("?", "", 2.5)], "l string, w string, s double")
    rows = df.select(speaker_key(F.col("l")).alias("k"), recording(F.col("w")).alias("r"), milliseconds(F.col("s")).alias("m")).collect()
    assert [x.k for x in rows] == ["es88", "es88", "es88", None]
    assert [x.r for x in rows] == ["rec_0007", None, None, None]
    assert [x.m for x in rows][1:] == [None, None, 2500]


def test_in_force(spark):
    rows = [(1, "a", "2025-01-01"), (1, "b", "2025-01-02"), (1, "b", "2025-01-02"), (2, "x", None), (2, "y", None), (None, "z", "2025-01-01")]
    df = spark.createDataFrame(rows, "segment_id long, v string, t string").withColumn("ingested_at", F.to_timestamp("t"))
    got = {tuple(x) for x in in_force(df, ["segment_id", "v", "ingested_at"]).collect()}
    assert got == {(1, "b"), (2, "y")}


def test_rank_and_running(spark):
    r = random.Random(2)
    rows = [(("hot" if r.random() < 0.5 else f"k{r.randrange(9)}") if r.random() > 0.05 else None, r.randrange(50), i, r.choice([None, 1, 2, 3]), 7) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, score int, id int, v int, rank int")
    got = {x.id: (x["rank"], x.running) for x in rank_and_running(df, ["k"], [F.col("score").desc(), F.col("id").asc()], value="v").collect()}
    by = defaultdict(list)
    for k, s, i, v, _ in rows:
        by[k].append((-s, i, v or 0))
    for xs in by.values():
        total = 0
        for n, (_, i, v) in enumerate(sorted(xs), 1):
            total += v
            assert got[i] == (n, total)
    assert rank_and_running(df.limit(0), ["k"], [F.col("id")]).count() == 0


def test_merge_runs_over_blocks(spark):
    r = random.Random(3)
    rows = [(f"g{r.randrange(4)}", i, r.choice(["a", "b", None]), r.randrange(1, 5)) for i in range(1500)]
    got = merge_runs(spark.createDataFrame(rows, "g string, t int, v string, n int"), "g", F.floor(F.col("t") / 37), ["t"], "v", "n", "no")
    want = set()
    for g in {x[0] for x in rows}:
        turns = []
        for _, _, v, n in sorted((x for x in rows if x[0] == g), key=lambda x: x[1]):
            if turns and turns[-1][0] == v:
                turns[-1][1] += n
            else:
                turns.append([v, n])
        want |= {(g, i, v, n) for i, (v, n) in enumerate(turns, 1)}
    assert {(x.g, x.no, x.v, x.n) for x in got.collect()} == want
