"""Problems 2 to 9: hand cases, brute force, and the defined results for nulls, empty tables, ties, repeats and long texts."""

import random
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import batches, capping, languages, leakage, lookalike, mixing, quality, queries, splits, turns
from voxloom.llm.sequence import shifted_sum, train, viterbi

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_batches_are_cut_by_size():
    import pyarrow as pa

    b = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["ab", None, "c" * 9, "", "dd", "ee"])], ["k", "t"])
    got = [x.column(0).to_pylist() for x in batches.by_size([b, b.slice(0, 0)], "t", 4)]
    assert got == [[0, 1], [2, 3], [4, 5]] or sum(got, []) == list(range(6))
    assert all(len(x) == 1 or sum(len(b.column(1)[i].as_py() or "") for i in x if i != 2) <= 4 for x in got)
    assert [x.column(0).to_pylist() for x in batches.by_size([b.slice(2, 3)], 1, 100)] == [[2, 3, 4]]


def test_viterbi_against_all_paths():
    import itertools

    rng = np.random.default_rng(0)
    lengths = np.array([3, 0, 5, 1])
    emit, trans = rng.normal(size=(9, 3)).astype(np.float32), rng.normal(size=(3, 3)).astype(np.float32)
    got, at = viterbi(emit, lengths, trans), 0
    for n in lengths:
        best = max(itertools.product(range(3), repeat=int(n)), key=lambda p: sum(emit[at + i, t] for i, t in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:])))
        assert tuple(got[at : at + n]) == best
        at += n
    assert len(viterbi(np.zeros((0, 3), np.float32), np.zeros(0, np.int64), trans)) == 0


def tags_of(tokens):
    m = turns.model()
    said = np.array([m.scores(t) for t in tokens], np.float32)
    n = np.array([len(tokens)])
    return viterbi(shifted_sum(said[:, 0], said[:, 1], said[:, 2], n), n, m.trans)


# Tagged by hand: S speech, A annotation, T timestamp, I and N words of a label that is an id or a name, i and n their ends. What
# isn't speech counts as one where it makes no turn: A and T, and a label in brackets.
BY_HAND = [
    ("[00:12:31] Well then we left the harbour (applause and cheering) and nobody spoke.", "TSSSSSSASSS"),
    ("MARIA LOPEZ: no vine ayer. Jorge Diaz: pues claro", "NnSSSNnSS"),
    ("Speaker 7: I saw 42 birds, 3 of them red", "IiSSSSSSSS"),
    ("<v Ana Gil> hola a todos [door slams twice] y adiós", "iSSSASS"),
    ("12:30:05.250 so it begins {crosstalk} now", "TSSSAS"),
    ("locutor 12: bom dia. Locutor 13: bom dia", "IiSSIiSS"),
    ("he said: wait here for 20 minutes", "SSSSSSS"),
    ("the list: one, two, three - done", "SSSSSSS"),
    ("SPEAKER en-4: THIS IS LOUD TALK", "IiSSSS"),
    ("and then (3:07) the old speaker left the room", "SSTSSSSSS"),
    ("EN 17: yes EN 18: no", "IiSIiS"),
    ("[spk_07] fine [spk_08] thanks", "iSiS"),
    ("*sighs* I know *laughs softly* it", "ASSAS"),
    ("00:01:10,500 --> 00:01:12,000 und danach kam der Wagen", "TSSTSSSSS"),
    ("Room 12: was empty, said Anna Weber", "SSSSSSS"),
    ("[Lara Mile] ich komme gleich", "nSSS"),
    ("in 1999 the town of Nivo had 300 people", "SSSSSSSSS"),
    ("78.4s ♪ la la la ♪ then silence", "TASS"),
    ("((cough)) as I said, (inaudible 3 words) again", "ASSSAS"),
    ("fr_00088: oui. fr_00089: non. fr_00088: si", "iSiSiS"),
    ("Captain Davemu met Doctor Sano at the port", "SSSSSSSS"),
    ("Note Well: this stays", "NnSS"),
    ("[1:02:03] [en_00001] ok [1:02:09] [en_00002] good", "TiSTiS"),
    ("vk-12: ja <noise> nein", "iSAS"),
    ("the ratio was 3 - 4 or 5", "SSSSSSSS"),
    ("Sprecherin de-99: Guten Morgen zusammen", "IiSSS"),
    ("{music fades} Kofi Mensah: akwaaba", "ANnS"),
    ("42s so 42 and 43", "TSSSS"),
    ("of the town of Ravo sw_00044: ndiyo", "SSSSSiS"),
    ("they met <2:14> at the bridge <wind>", "SSTSSSA"),
]


def test_tagger_on_transcripts_tagged_by_hand():
    """It beats a table of each token's most frequent tag by its shape, learned from the same made-up transcripts."""
    table = defaultdict(Counter)
    for seq in turns.made_up(turns.TRAINED_ON, 3):
        for t, g in seq:
            table[t if t == turns.HESITATES else (t[0] in "[({<*♪", turns.shape(t))][g] += 1
    code = dict(zip("SATIiNn", (turns.SPEECH, turns.ANNOTATION, turns.TIMESTAMP, turns.ID_WORD, turns.ID_END, turns.NAME_WORD, turns.NAME_END)))
    alike = {turns.TIMESTAMP: turns.ANNOTATION, turns.NAME_WORD: turns.ID_WORD, turns.NAME_END: turns.ID_END}
    right = plain = total = 0
    for text, gold in BY_HAND:
        tokens = turns._TOKEN.findall(text)
        assert len(tokens) == len(gold), (tokens, gold)
        for t, g, mine in zip(tokens, gold, tags_of(tokens).tolist(), strict=True):
            seen = table.get((t[0] in "[({<*♪", turns.shape(t)))
            usual = seen.most_common(1)[0][0] if seen else turns.SPEECH
            same = lambda tag, want=code[g]: alike.get(tag, tag) == alike.get(want, want)
            right, plain, total = right + same(mine), plain + same(usual), total + 1
    print("hand-tagged tokens", total, "model", right / total, "table", plain / total)
    assert right / total >= 0.97 and right > plain + 0.02 * total


def test_features_follow_from_the_signature():
    seen = {}
    texts = [t for seq in turns.made_up(400, 5) for t, _ in seq if t != turns.HESITATES] + [t for x, _ in BY_HAND for t in turns._TOKEN.findall(x)]
    for t in texts:
        assert seen.setdefault(turns.signature(t), turns.features(t)) == turns.features(t), t
    assert len(seen) < len(set(texts)) / 3


def test_kept_weights_are_the_fitted_ones(monkeypatch):
    monkeypatch.setattr(turns, "TRAINED_ON", 200)
    a, b = turns.fitted(), turns.fitted()
    assert a.names == b.names and (a.own == b.own).all()
    kept = turns.model()
    assert kept.own.shape == (len(kept.names), turns.N_TAGS) and kept.trans.shape == (turns.N_TAGS, turns.N_TAGS)
    held = [(t, g) for seq in turns.made_up(200, 99) for t, g in seq]
    ok = 0
    for seq in turns.made_up(200, 99):
        ok += (tags_of([t for t, _ in seq]) == np.array([g for _, g in seq])).sum()
    assert ok / len(held) > 0.98
    assert len(train([(np.array([1, 0]), np.array([0, 1], np.int8))], [np.array([0]), np.array([1, 2])], 3, 2, 2)) == 4


def test_clean_texts_of_turns(spark):
    sp = spark.createDataFrame(SPEAKERS, "speaker_id string, display_name string")
    data = [
        (1, "raw/en/a.wav", 0.0, "en_1", "[00:01] Hello um, there 12 (laughs) mm-hm uh-huh", None),
        (2, "raw/en/a.wav", 1.0, "en_1", "and more. Vivo Tano: yes of course Note Well: indeed", None),
        (3, "raw/en/a.wav", 700.0, "en_2", "later on", None),
    ]
    got = rows(turns.speaker_turns(segments(spark, data), sp, with_text=True))
    assert got == [
        ("raw/en/a.wav", 1, 1, 0, "en_00001", 7, "Hello there 12 uh-huh and more."),
        ("raw/en/a.wav", 2, 1, 1000, "en_00002", 6, "yes of course Note Well: indeed"),
        ("raw/en/a.wav", 2, 2, 700000, "en_00002", 2, "later on"),
    ]


SEG = "segment_id long, audio_file string, start_s double, end_s double, speaker_id string, transcript_text string, lang string, ingested_at timestamp, block string"
SPEAKERS = [("en_00001", "Lara Mile"), ("en_00002", "Vivo Tano")]


def segments(spark, data):
    return spark.createDataFrame([(i, f, s, None, sp, t, lang, None, "clash") for i, f, s, sp, t, lang in data], SEG)


def test_turns(spark):
    sp = spark.createDataFrame(SPEAKERS, "speaker_id string, display_name string")
    data = [
        (1, "raw/en/a.wav", 0.0, "en_1", "[00:01] Hello um, there 12 (laughs)", None),
        (2, "raw/en/a.wav", 1.0, "EN-00001", "and erm more. Vivo Tano: yes of course [SPEAKER en-2] indeed", None),
        (3, "raw/en/a.wav", 2.0, None, "*noise* uh ...", None),
        (4, "raw/en/a.wav", 3.0, "?", "lost words", None),
        (5, "raw/en/a.wav", 4.0, "unknown", "more lost", None),
        (6, "raw/en/a.wav", 5.0, "en_2", "he said Note Well: stay <v Lara Mile> ok", None),
        (7, "raw/en/a.wav", None, "en_2", "no time", None),
        (8, "raw/en/a.wav", 6.0, "en_2", None, None),
        (9, "raw/en/a.wav", 7.0, "en_2", "", None),
        (10, None, 7.0, "en_2", "no file", None),
        (11, "x.wav", 0.0, "en_2", "um acht Uhr ähm", "de-DE"),
        (12, "raw/en/long.wav", 0.0, "en_1", "word um " * 50_000, None),
    ]
    got = rows(turns.speaker_turns(segments(spark, data + data[:3]), sp))
    assert got == sorted(
        [
            ("raw/en/a.wav", 1, "en_00001", 5),
            ("raw/en/a.wav", 2, "en_00002", 4),
            ("raw/en/a.wav", 3, None, 4),
            ("raw/en/a.wav", 4, "en_00002", 5),
            ("raw/en/a.wav", 5, "en_00001", 1),
            ("x.wav", 1, "en_00002", 3),
            ("raw/en/long.wav", 1, "en_00001", 50_000),
        ],
        key=str,
    )
    assert turns.speaker_turns(segments(spark, data).limit(0), sp).count() == 0
    assert turns.speaker_turns(segments(spark, data), sp.limit(0)).where("speaker_id IS NOT NULL").count() == 0


def union_find(links):
    p = {}

    def f(x):
        p.setdefault(x, x)
        while p[x] != x:
            x = p[x]
        return x

    for a, b in links:
        a, b = f(a), f(b)
        p[max(a, b)] = min(a, b)
    return {x: f(x) for x in p}


@pytest.mark.parametrize("task_links", [30, 10_000])
def test_components(spark, task_links):
    r = random.Random(4)
    links = [(f"a{r.randrange(300):03}", f"b{r.randrange(300):03}") for _ in range(250)] + [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)] + [("hub", f"h{i}") for i in range(80)] + [("x", "x")]
    df = spark.createDataFrame([*links, (None, "a"), ("a", None)], "u string, v string")
    got = {x.node: x.root for x in splits.components(df, "u", "v", task_links).collect()}
    want = union_find(links)
    least = defaultdict(lambda: "~")
    for node, root in want.items():
        least[root] = min(least[root], node)
    assert got == {node: least[root] for node, root in want.items()}


def test_components_among_many_lone_nodes(spark, monkeypatch):
    """A component that isn't settled after one level stays whole when lone nodes alone fill more than two tasks."""
    from pyspark import cloudpickle

    chain = [f"n{i:03}" for i in range(56)]
    random.Random(1).shuffle(chain)
    links = [*zip(chain, chain[1:]), *((f"s{i:04}", f"s{i:04}") for i in range(900))]
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    cloudpickle.register_pickle_by_value(splits)  # the workers get the small bound too
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
        monkeypatch.setattr(splits, "TASK_LINKS", 60)
        got = rows(splits.components(spark.createDataFrame(links, "u string, v string"), "u", "v", 60))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        cloudpickle.unregister_pickle_by_value(splits)
    assert got == sorted([(n, "n000") for n in chain] + [(n, n) for n, _ in links[55:]])


def test_groups_of_records(spark):
    data = [(1, "s1", "r1"), (2, None, "r1"), (3, "s2", "r2"), (4, None, "r3"), (5, None, None), (6, "s1", "r9"), (6, "s2", "r8"), (1, "s1", "r1"), (None, "s1", "r1")]
    df = spark.createDataFrame(data, "id long, s string, w string")
    assert rows(splits.group_records(df, "id", "s", "w")) == [(1, "s1"), (2, "s1"), (3, "s1"), (4, "r3"), (5, "5"), (6, "s1")]
    assert splits.group_records(df.limit(0), "id", "s", "w").count() == 0


def greedy(sizes, shares):
    total, have, out = sum(n * k for n, k in sizes), [0.0] * len(shares), {}
    for n, k in sorted(sizes, reverse=True):
        out[n] = [0] * len(shares)
        for _ in range(k):
            i = max(range(len(shares)), key=lambda j: shares[j] * total - have[j])
            out[n][i] += 1
            have[i] += n
    return out, have


def test_deal_is_greedy():
    sizes = [(50, 1), (9, 4), (3, 30), (1, 5000)]
    out, have = greedy(sizes, (0.8, 0.1, 0.1))
    got = splits.deal(sizes, (0.8, 0.1, 0.1))
    assert {n: sum(x) for n, x in got.items()} == dict(sizes)
    mine = [sum(n * got[n][i] for n in got) for i in range(3)]
    assert all(abs(a - b) <= 2 for a, b in zip(mine, have))
    assert splits.deal(sizes[:3], (0.5, 0.5)) == greedy(sizes[:3], (0.5, 0.5))[0]
    assert splits.deal([], (1.0,)) == {}


def test_deal_against_one_by_one():
    r = random.Random(12)
    for _ in range(60):
        sizes = list(Counter(r.choice([1, 1, 2, 3, 7, 50]) for _ in range(r.choice([3, 40, 1500]))).items())
        shares = r.choice([(0.8, 0.1, 0.1), (0.7, 0.1, 0.1), (0.5, 0.5), (1.3, 0.4), (0.25, 0.25, 0.25), (1.0,)])
        want, have = greedy(sizes, shares)
        got = splits.deal(sizes, shares)
        assert got == want, (sizes, shares)
        assert [sum(n * got[n][i] for n in got) for i in range(len(shares))] == have
    got = splits.deal([(1, 2_000_000)], (0.7, 0.1, 0.1))[1]
    assert max(abs(a - b) for a, b in zip(got, (2_000_000 * 0.7 + 200_000 / 3, 2_000_000 * 0.1 + 200_000 / 3, 2_000_000 * 0.1 + 200_000 / 3))) <= 1


def test_components_of_chains_and_hubs_contract(spark):
    r = random.Random(13)
    names = [f"n{i:05}" for i in range(4000)]
    r.shuffle(names)
    chain = list(zip(names, names[1:]))
    hub = [("hub", f"h{i:05}") for i in range(3000)]
    pairs = [(f"p{i}", f"q{i}") for i in range(500)]
    links = chain + hub + pairs + [("hub", names[7])]
    got = {x.node: x.root for x in splits.components(spark.createDataFrame(links, "u string, v string").repartition(9), "u", "v", 300).collect()}
    want = union_find(links)
    least = defaultdict(lambda: "~")
    for node, root in want.items():
        least[root] = min(least[root], node)
    assert got == {node: least[root] for node, root in want.items()}


def test_splits_keep_groups(spark):
    df = spark.range(3000).select("id", F.concat(F.lit("g"), F.when(F.col("id") < 300, 0).otherwise(F.col("id") % 700)).alias("g"), F.lit("old").alias("split"))
    got = splits.assign_splits(df.unionByName(df.limit(1).select(F.lit(9999).cast("long").alias("id"), F.lit(None).cast("string").alias("g"), "split")), "g", {"train": 0.8, "test": 0.2})
    per = got.where("g IS NOT NULL").groupBy("g").agg(F.count_distinct("split").alias("n"), F.count(F.lit(1)).alias("k"))
    assert per.where("n <> 1").count() == 0 and got.where("g IS NULL").first().split is None
    shares = {r.split: r["count"] for r in got.where("g IS NOT NULL").groupBy("split").count().collect()}
    assert abs(shares["test"] - 600) <= 5


def brute_level(counts, share):
    best = 0
    for c in range(1, max(counts) + 1):
        if c <= share * sum(min(n, c) for n in counts) + 1e-9:
            best = c
    return best or min(counts)


def test_water_level():
    r = random.Random(5)
    for _ in range(200):
        counts = [r.choice([1, 2, 3, 10, r.randrange(1, 200)]) for _ in range(r.randrange(1, 30))]
        share = r.choice([0.05, 0.1, 0.2, 0.34, 0.5, 1.0])
        got = capping.water_level(list(Counter(counts).items()), share)
        want = brute_level(counts, share)
        assert min(got, max(counts)) == want, (counts, share, got, want)
    assert capping.water_level([], 0.1) == 0
    for _ in range(100):
        counts = [r.randrange(1, 200) for _ in range(r.randrange(1, 30))]
        share, most = r.choice([0.1, 0.3, 1.0]), r.randrange(1, 120)
        want = min(most, brute_level([min(n, most) for n in counts], share))
        assert min(capping.water_level(list(Counter(counts).items()), share, most), max(counts)) == want


def test_capping(spark):
    r = random.Random(6)
    data = [((None if i % 50 == 0 else "hot" if i % 3 == 0 else f"k{i % 7}"), r.choice([None, 1.0, 2.0, 2.0, 50.0]), i, "rank") for i in range(1000)]
    df = spark.createDataFrame(data, "c string, score double, id long, _rank string")
    order = [F.col("score").desc_nulls_last(), F.col("id").asc()]
    got = {x.id: x.kept for x in capping.cap_contributors(df, "c", order, max_count=20).collect()}
    by = defaultdict(list)
    for c, s, i, _ in data:
        by[c].append((-(s if s is not None else -1), i))
    for c, xs in by.items():
        for n, (_, i) in enumerate(sorted(xs)):
            assert got[i] == (c is None or n < 20)
    capped = capping.cap_contributors(df.where("c IS NOT NULL"), "c", order, max_share=0.2).where("kept").groupBy("c").count().collect()
    total = sum(x["count"] for x in capped)
    assert max(x["count"] for x in capped) <= 0.2 * total
    assert capping.cap_contributors(df, "c", order).where("NOT kept").count() == 0
    assert capping.cap_contributors(df.limit(0), "c", order, max_count=3, max_share=0.1).count() == 0
    s = spark.createDataFrame([(1, 50.0, "2025-01-01"), (1, 101.0, "2025-01-02"), (1, 70.0, "2025-01-01"), (2, None, "2025-01-01"), (3, float("nan"), "2025-01-01"), (None, 5.0, "2025-01-01")], "segment_id long, total double, scored_at string")
    assert rows(capping.best_scores(s)) == [(1, 70.0)]


@pytest.mark.parametrize(
    "a,b,same",
    [("ˈtojə", "'tојә", True), ("ɛ̰́", "ɛ̰́", True), ("ａ b", "a b", True), ("g‍ε", "ɡɛ", True), ("oː", "o:", True), ("kʷ", "kw", False), ("tʰ", "th", False), ("e", "ɛ", False), ("ɪ", "i", False), ("oː", "o", False), ("é", "e", False), ("ê", "ê", True), ("ã", "ã", True), ("ˈa", "a", False), ("ﬁt", "fit", True), ("Ⅷ", "VIII", True), ("a‐b‑c", "a-b-c", True), ("ﬀ", "f", False), ("²", "2", False)],
)
def test_looks(a, b, same):
    x, y = lookalike.canonical([a, b]).to_pylist()
    assert (x == y) is same


def forms(texts, phonetic=True):
    return lookalike.canonical(texts, phonetic).to_pylist()


def test_canonical_of_batches():
    import pyarrow as pa

    assert forms([]) == [] and forms([None, "", "\u200b", "  "]) == [None, "", "", ""]
    many = ["x̰́" * 3, "", None, "é" * 100_000, "ë" + "\u0301\u0323" * 500, " a ", None]
    assert forms(many) == [forms([m])[0] for m in many]
    assert forms(pa.array(many).slice(1, 5)) == forms(many[1:6]) and forms(pa.array(many).slice(2, 1)) == [None]
    r = random.Random(7)
    for _ in range(200):  # what has only canonical differences meets in one form
        t = "".join(r.choice("aeioṵ́̃ɛɔkʷ ") for _ in range(12))
        assert len(set(forms([t, unicodedata.normalize("NFC", t), unicodedata.normalize("NFD", t)]))) == 1


def test_marks_are_composed_as_in_nfc():
    r = random.Random(17)
    letters = "aeiouyAEIOUcnszgɛɔəɪBdxяиあかアשअ"
    marks = "\u0300\u0301\u0302\u0303\u0304\u0306\u0307\u0308\u030a\u030b\u030c\u0323\u0324\u0325\u0327\u0328\u032d\u0331\u0330\u0338\u0345\u3099\u309a\u05b4\u093c"
    texts = ["".join(r.choice(letters) + "".join(r.choice(marks) for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5]))) for _ in range(r.randrange(1, 9))) for _ in range(4000)]
    texts += [chr(c) for c in range(0xC0, 0x250)] + [chr(c) for c in range(0x1E00, 0x1F00)]
    texts = [t for t in texts if all(lookalike._same_look(c) == c for c in t)]
    held = lookalike.tables(False).twin
    plain = [t for t in texts if all(held[ord(c)] == ord(c) for c in unicodedata.normalize("NFD", t))]
    assert len(plain) > 2000 and forms(plain, False) == [unicodedata.normalize("NFC", t) for t in plain]


def test_canonical_of_hangul_and_compatibility_ideographs():
    syllables = "".join(map(chr, range(0xAC00, 0xD7A4)))
    assert forms([syllables, unicodedata.normalize("NFD", syllables)]) == [syllables] * 2
    assert forms([chr(0x2F800), chr(0x2FA1D)]) == [chr(0x4E3D), chr(0x2A600)]


def test_words_of_another_script_keep_their_letters():
    kept = ["Москва большая", "слово сор", "Αθήνα και νερό"]
    assert forms(kept, False) == kept
    assert forms(["mоnеy Москва", "Ноmе", "сор"], False) == ["money Москва", "Home", "cop"]


def test_pairs_of_looks(spark, monkeypatch):
    data = [(1, "a", "k"), (2, "а", "k"), (3, "a", "k"), (3, "a", "k"), (4, "a​", "k"), (5, "b", "k"), (6, "а", "other"), (7, None, "k"), (None, "a", "k"), (8, "а", None)]
    df = spark.createDataFrame(data, "id long, t string, g string")
    assert rows(lookalike.lookalike_pairs(df, "id", "t", [F.col("g")])) == [(1, 2), (1, 4), (2, 3), (2, 4), (3, 4)]
    assert lookalike.lookalike_pairs(df.limit(0), "id", "t", [F.col("g")]).count() == 0
    assert rows(lookalike.lookalike_classes(df, "id", "t", [F.col("g")])) == [(1, 1, "a", "a"), (2, 1, "а", "a"), (3, 1, "a", "a"), (4, 1, "a\u200b", "a")]
    for most in (0, 10**9):
        monkeypatch.setattr(lookalike, "BROADCAST_CLASSES", most)
        assert lookalike.lookalike_pairs(df, "id", "t", [F.col("g")]).count() == 5
    assert lookalike.with_canonical(df.withColumn("_text", F.lit("mine")), "t", "c").where("_text <> 'mine'").count() == 0


@pytest.fixture(scope="module")
def identifier(spark):
    return languages.fit_on_table(spark.read.parquet("/root/testdata/sf0.01/text_segments.parquet"), "text", "lang")


def test_fit_sample_is_of_distinct_texts(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(languages, "fit_on", lambda texts, labels: taken.append(list(zip(texts, labels))))
    texts = [(f"text {i}", ("en", "de", "fr")[i % 3]) for i in range(300)]
    df = spark.createDataFrame(texts + [("again and again", "en")] * 3000 + [(f"unknown {i}", None) for i in range(900)], "t string, l string")
    languages.fit_on_table(df, "t", "l", 400)
    assert taken[0] == sorted([*texts, ("again and again", "en")])
    for parts in (1, 7):
        languages.fit_on_table(df.repartition(parts), "t", "l", 50)
    assert taken[1] == taken[2] and 25 < len(taken[1]) <= 100


def test_held_out_language_accuracy(spark, identifier):
    held = spark.read.parquet("/root/testdata/sf0.1/text_segments.parquet").where("lang IN ('ak','de','en','es','fr','pt','sw') AND size(labels.code_switch_spans) = 0").select("segment_id", "text", "lang")
    got = languages.identify(held, "text", identifier).where("main_lang IS NOT NULL")
    # some labels of the table are wrong on purpose, so agreement stays somewhat below 1
    assert got.where("main_lang = lang").count() / got.count() > 0.9


def test_languages(spark, identifier):
    data = [
        (1, "The old teacher explained a poem about the moon.", None, "x"),
        (2, "The old teacher explained a poem about the moon.", "de", "x"),
        (3, "The old teacher explained a poem about the moon.", "en_GB", "x"),
        (4, "El doctor leyó la carta de casa. The bus driver copied the rules of the game. La vieja maestra cantó la historia del puerto.", "Spanish", "x"),
        (5, None, "en", "x"), (6, "", None, "x"), (7, "12 / 40 / 7 ...", None, "x"), (8, "the list " * 60_000, "und", "x"), (None, "the old teacher", None, "x"),
    ]
    df = spark.createDataFrame(data + data[:2], "segment_id long, text string, lang string, confidence string")
    done = languages.identify(df, "text", identifier)
    assert rows(languages.label_findings(done, "segment_id", "lang")) == [(1, "missing", "en"), (2, "wrong", "en"), (4, "mixed", "en"), (8, "missing", "en")]
    assert {r.segment_id: r.main_lang for r in done.where("segment_id IN (5, 6, 7)").collect()} == {5: None, 6: None, 7: None}
    assert all(0 <= r.confidence <= 1 for r in done.where("confidence IS NOT NULL").collect())
    assert languages.identify(df.limit(0), "text", identifier).count() == 0
    assert languages.identify(df.limit(0), "text", languages.fit_on([], [])).count() == 0


def test_open_set_of_languages(spark, identifier):
    strange = {
        "it": "La vecchia maestra cantava una canzone sulla pioggia vicino al porto della città ogni sera.",
        "no": "Den gamle læreren leste et dikt om månen ved havnen i byen hver kveld.",
        "ru": "Старый учитель читал стихотворение о луне на рынке в городе",
        "zh": "老老师在市场上读了一首关于月亮的诗",
    }
    data = [(i, t, l) for i, (l, t) in enumerate(strange.items())] + [(10 + i, t, None) for i, t in enumerate(strange.values())]
    data += [(20, "The old teacher explained a poem about the moon.", "it"), (21, "The old teacher explained a poem about the moon.", "Norwegian")]
    done = languages.identify(spark.createDataFrame(data, "segment_id long, text string, lang string"), "text", identifier)
    assert rows(languages.label_findings(done, "segment_id", "lang")) == sorted([*((10 + i, "missing", "und") for i in range(4)), (20, "wrong", "en"), (21, "wrong", "en")], key=str)


def test_languages_come_from_the_labels(spark):
    r = random.Random(3)
    sounds = {"pl": "szcz prz ły ów nie", "cs": "ře ště ou ní če", "en": "th wh ing ous ed"}
    words = {l: ["".join(r.choice(x.split()) + r.choice("aeo") for _ in range(2)) for _ in range(40)] for l, x in sounds.items()}
    texts = [(" ".join(r.choice(words[l]) for _ in range(8)), l) for l in words for _ in range(150)]
    noise = [(t, "fi") for t, _ in texts[::9]]  # a label that is only ever wrong
    df = spark.createDataFrame(texts + noise, "text string, lang string")
    model = languages.fit_on_table(df, "text", "lang")
    assert model.langs == ("cs", "en", "pl") and list(model.pairs) == [(0, 2)]
    got = languages.identify(df.limit(450), "text", model)
    assert got.where("main_lang <> lang").count() == 0


def test_spans_in_characters(spark, identifier):
    text = "El doctor leyó la carta de casa.  The bus driver copied the rules of the game! La vieja maestra cantó la historia del puerto."
    apart = unicodedata.normalize("NFD", text)
    found = [x.index("The bus") for x in (text, apart)], [x.index("!") for x in (text, apart)]
    spans = [[[found[0][0], found[1][0]], [0, 12], [5]], None]
    df = spark.createDataFrame([(1, text, spans[0]), (2, apart, spans[1]), (3, None, [[0, 4]]), (4, None, None)], "segment_id long, text string, spans array<array<long>>")
    done = languages.identify(df, "text", identifier)
    got = rows(languages.span_findings(done, "segment_id", "spans"))
    assert got == sorted(
        [(1, found[0][0], found[1][0], "en", "confirmed"), (1, 0, 12, None, "unconfirmed"), (1, 5, None, None, "unconfirmed"), (2, found[0][1], found[1][1], "en", "unlabelled"), (3, 0, 4, None, "unconfirmed")],
        key=str,
    )


def test_recall_of_right_spans(spark):
    """Right spans cover whole clauses; the table's wrong ones begin a text or break off inside a word."""
    got = queries.p4_spans(spark, "/root/testdata/sf0.1").where("kind <> 'unlabelled'")
    text = spark.read.parquet("/root/testdata/sf0.1/text_segments.parquet").select("segment_id", "text").distinct()
    around = got.join(text, "segment_id").withColumn("ahead", F.expr("substring(text, start_char - 1, 2)")).withColumn("last", F.expr("substring(text, end_char, 2)"))
    right = around.where(r"start_char > 0 AND ahead rlike '[.,!?-] ' AND (last rlike '[.,!?] ?' OR last rlike '\\w[.,!? ]' OR length(last) = 1)")
    n, ok = right.count(), right.where("kind = 'confirmed'").count()
    print("right spans", n, "confirmed", ok)
    assert n > 1000 and ok / n >= 0.9


def test_leaks(spark):
    long = "The poet Kino wrote about the old bridge near the market of Pedo in 1999. Then all went home again."
    items = spark.createDataFrame([(1, long), (2, "Short item with Mino"), (3, None), (4, "..."), (1, long)], "item_id long, text string")
    words = long.replace(".", "").split()
    docs = [
        (10, "before " + " ".join(words[2:14]).upper() + " after"),
        (11, "before " + " ".join(words[2:13]) + " after"),
        (12, "x\n> Short,\n> ITEM – with   mino y"),
        (13, "Short item and with Mino"),
        (14, long.replace("Kino", "Lalo").replace("1999", "7")),
        (15, None), (16, ""), (None, long),
        (17, "Then " * 60_000 + long),
        (18, " · ".join(words)),
    ]
    df = spark.createDataFrame([(d, t, "c") for d, t in docs], "doc_id long, text string, item_id string")
    got = leakage.leaks(df, items)
    assert rows(got.where("verbatim > 0").select("doc_id", "item_id")) == [(10, 1), (12, 2), (17, 1), (18, 1)]
    assert rows(got.where("verbatim = 0").select("doc_id", "item_id")) == [(14, 1)]
    for empty in (leakage.leaks(df.limit(0), items), leakage.leaks(df, items.limit(0))):
        assert empty.count() == 0


def test_reworded_names_that_begin_a_sentence(spark):
    items = spark.createDataFrame([(1, "Anna has 3 red apples in a basket."), (2, "we saw that Carla took 5 of the green pears home."), (3, "Where")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "so. Ben has 4 red apples in a basket. and more of it"), (2, "it says BEN has 4 red apples in a basket. and more"), (3, "we saw that DORA took 6 of the green pears home. and so on"), (4, "Anna has 3 red apples in a basket. and so on"), (5, "Paris is large")], "doc_id long, text string")
    want = [(1, 1, 0, 1), (2, 1, 0, 1), (3, 2, 0, 1), (4, 1, 1, 0)]
    assert rows(leakage.leaks(docs, items)) == want


def test_items_do_not_change_what_others_find(spark, monkeypatch):
    """Names that one item writes small, a word that is a unit elsewhere, and the ways to join leave a pair as it is."""
    first = (1, "The poet Kino wrote about the old bridge near the market of Pedo in the rain that day.")
    others = [(2, "kino and pedo are words, and so are the poet and the bridge"), (3, "It was 5 metres near the market"), (4, "THE POET KINO WROTE ABOUT THE OLD BRIDGE NEAR")]
    docs = spark.createDataFrame([(1, first[1].replace("Kino", "Lalo Mendes").replace("Pedo", "Sami")), (2, first[1].lower()), (3, "x")], "doc_id long, text string")
    schema = "item_id long, text string"
    alone = rows(leakage.leaks(docs, spark.createDataFrame([first], schema)))
    assert [x[:2] for x in alone] == [(1, 1), (2, 1)] and alone[0][2] == 0 < alone[0][3] and alone[1][3] == 0 < alone[1][2]
    for most in (10**9, 0):
        monkeypatch.setattr(leakage, "BROADCAST_WINDOWS", most)
        for bits in (1 << 22, 1 << 6):
            monkeypatch.setattr(leakage, "SIEVE_LEAST", bits)
            monkeypatch.setattr(leakage, "SIEVE_MOST", bits)
            assert [x for x in rows(leakage.leaks(docs, spark.createDataFrame([first, *others], schema))) if x[1] == 1] == alone


def test_slots_of_any_length_and_units(spark):
    items = spark.createDataFrame([(1, "She carried 3.5 kg of rice from the market of New York to the house of a friend."), (2, "A s t l g m are letters and a 5 m rope is a rope that a man has")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "She carried 4 lb of rice from the market of Paris to the house of a friend."), (2, "She carried 4 lb of rice from the market of Paris to the house of a foe."), (3, "A s t l g m are letters and a 7 m rope is a rope that a man has"), (4, "A s t x g m are letters and a 7 m rope was a rope that a man had")],
        "doc_id long, text string",
    )
    assert [x[:3] for x in rows(leakage.leaks(docs, items)) if x[2] == 0] == [(1, 1, 0), (2, 1, 0), (3, 2, 0)]
    assert 4 not in [x[0] for x in rows(leakage.leaks(docs, items))]


def reparameterised(text, r, consistent=True):
    """The text with other names (of one to three words) and numbers, one for each, or with one name that gets two."""
    new = {}
    words, out, start, twice = text.split(" "), [], True, 0
    for w in words:
        core = w.strip(".,!?")
        if core.isdigit() or (core[:1].isupper() and not start):
            made = lambda: str(r.randrange(10, 99999)) if core.isdigit() else " ".join("".join(r.choice("bdfgklmnprstv") + r.choice("aeiou") for _ in range(3)).capitalize() for _ in range(r.randrange(1, 4)))  # noqa: B023, E731
            value = new.setdefault(core, made())
            if not consistent and twice < 2:
                value, twice = made(), twice + 1
            out.append(w.replace(core, value))
        else:
            out.append(w)
        start = w[-1:] in ".!?:"
    return " ".join(out)


def test_recall_and_precision_of_reparameterised_items(spark):
    r = random.Random(11)
    base = [x for x in spark.read.parquet("/root/testdata/sf0.01/eval_items.parquet").orderBy("item_id").collect() if len(x.text.split()) >= 12]
    items, docs, want = [], [], set()
    filler = [x.text for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) > 200").orderBy("doc_id").limit(60).collect()]
    for x in base:
        name = next((w for w in x.text.split()[1:] if w[:1].isupper()), None)
        text = x.text + (f" Later {name.strip('.,!?')} counted {r.randrange(2, 40)} boats and {name.strip('.,!?')} left." if name else " Later 7 boats and 7 men left.")
        items.append((x.item_id, text))
        k = len(docs)
        docs.append((k, r.choice(filler) + " " + reparameterised(text, r) + " " + r.choice(filler)))
        want.add((k, x.item_id))
        # a name twice in the last 12 units that gets two values there, and a passage with other words in between
        tail = " ".join(text.split()[-9:])
        docs.append((k + 1, r.choice(filler) + " " + reparameterised(tail, r, False)))
        docs.append((k + 2, " ".join(w + (" indeed" if i % 5 == 4 else "") for i, w in enumerate(reparameterised(text, r).split()))))
    found = {(d, i) for d, i, v, w in rows(leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))) if w and v == 0}
    own = {(d, i) for d, i in found if (d - d % 3, i) in want}
    recall, precision = len(want & own) / len(want), len(want & own) / max(1, len(own))
    print("re-parameterised items: recall", recall, "precision", precision, "other items' pairs", len(found - own))
    assert recall >= 0.9 and precision >= 0.9


def test_allocate():
    assert mixing.allocate([(0.5, 100), (0.5, 10)], 100) == [90, 10]
    assert mixing.allocate([(0.5, 0), (0.5, 1000)], 100) == [0, 100]
    assert mixing.allocate([], 5) == [] and sum(mixing.allocate([(0.7, 5), (0.3, 5)], 100)) == 10


def test_mix_plan(spark):
    docs = [(i, "news-A" if i % 4 else " News_a ", f"word number {i} " * (1 + i % 9)) for i in range(400)] + [(1000 + i, "tiny", "few words here") for i in range(3)] + [(2000, None, "x"), (2001, "tiny", None), (2002, "tiny", ""), (None, "tiny", "x y")]
    d = spark.createDataFrame(docs, "doc_id long, source string, text string")
    t = spark.createDataFrame([("m", "news_a", 0.5, 3), ("m", "Tiny", 0.5, 4), ("m", "absent", 0.1, 4), ("n", "news_a", 1.0, 2), (None, "tiny", 1.0, 1), ("m", "x", None, 1)], "mix_name string, source string, target_share double, max_repeats int")
    plan, shares = mixing.plan_mixes(d, t)
    s = {(r.mix_name, r.source): r for r in shares.collect()}
    assert s["m", "absent"].used_tokens == 0 and s["m", "Tiny"].limited and s["m", "Tiny"].used_tokens == 4 * s["m", "Tiny"].available_tokens
    total = s["m", "news_a"].available_tokens + s["m", "Tiny"].available_tokens
    assert abs(s["m", "news_a"].used_tokens + s["m", "Tiny"].used_tokens - total) < 60
    assert all(abs(r.actual_share - r.attainable_share) < 0.02 for r in s.values())
    assert s["n", "news_a"].actual_share == 1.0 and s["n", "news_a"].used_tokens == s["n", "news_a"].available_tokens
    assert plan.where("copies > 4 OR copies < 1").count() == 0 and plan.groupBy("mix_name", "doc_id").count().where("count > 1").count() == 0
    again, _ = mixing.plan_mixes(d.repartition(7), t)
    assert rows(again) == rows(plan)
    for a, b in ((d.limit(0), t), (d, t.limit(0))):
        assert mixing.plan_mixes(a, b)[0].count() == 0


def test_shares_of_the_data(spark):
    shares = queries.p8_mix_shares(spark, "/root/testdata/sf0.1").collect()
    for mix in {r.mix_name for r in shares}:
        own = [r for r in shares if r.mix_name == mix]
        assert abs(sum(r.actual_share for r in own) - 1) < 1e-9 and abs(sum(r.attainable_share for r in own) - 1) < 1e-9
        total = sum(r.used_tokens for r in own)
        for r in own:  # at most half of the largest document beside what is attainable
            assert abs(r.actual_share - r.attainable_share) <= 20_000 / total and r.used_tokens <= r.max_repeats * r.available_tokens


def test_pareto_inclusion_follows_weights(spark):
    d = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("one two three").alias("text"), F.when(F.col("id") % 2 == 0, 3.0).otherwise(1.0).alias("w"))
    t = spark.createDataFrame([("m", "s", 1.0, 1)], "mix_name string, source string, target_share double, max_repeats int")
    plan, _ = mixing.plan_mixes(d, t, weight=F.col("w"), total_tokens=1500)
    n = {r.even: r["count"] for r in plan.groupBy((F.col("doc_id") % 2 == 0).alias("even")).count().collect()}
    assert sum(n.values()) == 500 and 2.3 < n[True] / n[False] < 4


def test_token_counts(spark):
    import tiktoken  # noqa: F401
    from tokenizers import Tokenizer

    given = ["Hello world", "née  Zoë 123\n\n x", "", None, "a" * 20_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "id long, text string")
    tok = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    tok.encode_special_tokens = True
    assert [r.n_tokens for r in mixing.count_tokens(df, "text").orderBy("id").collect()] == [len(tok.encode(t, add_special_tokens=False).ids) if t else 0 for t in given]


PROSE = "The old teacher explained a poem about the moon at the end of the month."
TEXTS = {
    "prose": [PROSE, PROSE.lower().rstrip("."), "\n".join([PROSE.lower()] * 4), "\n".join(f"- {PROSE}" for _ in range(5)), f"Ann: {PROSE}\nBob: {PROSE}", f"{PROSE}\n\n- bread\n- salt", "\n".join("| " + x for x in (PROSE, PROSE)), PROSE.replace(" ", "  "), "It cost 45 (12%, 3/4) in 2019, and 47 in 2020 for all of them."],
    "list": ["- bread\n- salt\n- yam\n- drum stick", "1. bread\n2) salt\n3. yam", "bread, salt, yam, drum, moon stick, road", "[x] bread\n[ ] salt\n[x] yam", "bread\nsalt\nyam\nmoon road", "kofa: bread\nmilo: salt\ntano: yam"],
    "table": ["a,b,c\nbread,1,2\nsalt,3,4", "| day | code | item |\n| --- | --- | --- |\n| bread | 4 | |\n| salt | 5 | x |", "x\ty\tz\nbread\t1\t\nsalt\t2\tn/a", "bread     12      road\nsalt      7       moon\nyam       14      drum"],
    "junk": ["?? " * 50, "null null null null null null null null null", "[}{>%$=~*^&@#;|\\<>" * 9, "9qKM2HnT6dGjmw4uehcasXpolE806cgjn5Suc1TuYKahOQG68dJCxIJnFqg5Jv9fvMyWN8ZY", "wrnrhczfmrq jbtrnxwfn vljx wrcqrkv cplbvwrjz xdhmjt", "0\n" * 30, "¤Ÿ¤ï½»? ¶¤¿™¤¶€Âï? ™¿œ œ€™Ÿž"],
}


@pytest.mark.parametrize("kind", list(TEXTS))
def test_kinds(kind):
    _, got = quality.describe(TEXTS[kind])
    assert got == [kind] * len(TEXTS[kind])


def test_layout_decides_where_words_do_not():
    def items(n, words=5):
        r = random.Random(n)
        return [" ".join("".join(r.choice("bdfgklmnrt") + r.choice("aeiou") for _ in range(2 + r.randrange(2))) for _ in range(words)) for _ in range(n)]

    nested = "\n".join("    " * (i % 3 > 0) + x for i, x in enumerate(items(9)))
    block = "Sela:\n" + "\n".join("  " + x for x in items(5, 6))
    pairs = "\n".join(x + (" " + "kofa milo tano sela bitu" if i % 2 else "") for i, x in enumerate(items(12)))
    continued = "\n".join(f"- {a}\n  {b}" for a, b in zip(items(6, 3), items(6, 7)))
    assert quality.describe([nested, block, pairs, continued])[1] == ["list"] * 4
    flat = "\n".join(items(11, 7))
    speech = "\n".join("  " + x.replace(" ", ". ", 1) for x in items(8, 6))
    same = "\n".join(items(1) * 5)
    verse = "\n".join("  " * (i % 2) + PROSE.lower().rstrip(".") for i in range(8))
    assert quality.describe([flat, speech, same, verse])[1] == ["prose"] * 4


def test_each_signal_of_the_layout_decides():
    """Without any one of the three signals its case comes out otherwise."""
    r = random.Random(21)
    made = lambda k: " ".join("".join(r.choice("bdfgklmnrt") + r.choice("aeiou") for _ in range(3)) for _ in range(k))
    table = "\n".join(f"{made(3)}\t{made(3)}\t{made(2)}" for _ in range(6))
    nested = "\n".join("    " * (i % 3 > 0) + made(r.randrange(5, 9)) for i in range(12))
    pairs = "\n".join(made(5 if i % 2 else 11) for i in range(12))
    for signal, text, kind in (("alignment", table, "table"), ("indentation", nested, "list"), ("lengths", pairs, "list")):
        assert quality.describe([text])[1] == [kind]
        others = [x for x in quality.SIGNALS if x != signal]
        assert quality.describe([text], others)[1] != [kind], signal
        assert quality.describe([text], [signal])[1] == [kind], signal


def test_a_language_without_a_list_of_common_words():
    sentence = "Stara nauczycielka czytała wczoraj wieczorem wiersz dzieciom mieszkającym obok portu rybackiego"
    prose = [sentence + ".", sentence, sentence.lower(), "\n".join([sentence, "Rybak naprawiał sieci przed zachodem słońca nad zatoką.", "Burmistrz otworzył wystawę obrazów młodych malarzy?"])]
    lists = ["- chleb\n- sól\n- mąka pszenna\n- świeże mleko", "chleb, sól, mąka, mleko, jajka, cebula", "1. młotek\n2. gwoździe\n3. długa deska"]
    table = ["miasto;liczba;rok\nKraków;12;1999\nŁódź;7;2004\nGdańsk;5;2010", "| imię | wiek | dom |\n| --- | --- | --- |\n| Żaneta | 31 | Łódź |"]
    assert quality.describe([*prose, *lists, *table])[1] == ["prose"] * 4 + ["list"] * 3 + ["table"] * 2


def test_words_against_a_pattern():
    r = random.Random(22)
    for _ in range(200):
        text = "".join(r.choice("abÄ9_ '’-.\n\t–İß") for _ in range(r.randrange(0, 60))).lower()
        lines, codes, unique = quality._words(text)
        found = [(i, m.group()) for i, s in enumerate(text.split("\n")) for m in re.finditer(r"[^\W_]+(?:['’-][^\W_]+)*", s)]
        assert [(i, unique[c]) for i, c in zip(lines.tolist(), codes.tolist())] == found


def test_statistics_of_lines_that_are_plainly_prose():
    at = quality.STATS.index
    indented = "\n".join("  " * (i % 2) + PROSE for i in range(8))
    far = "\n".join("  " * (i % 6 == 0) + PROSE for i in range(36))
    rows_of = "\n".join(f"the old road to {x}|near the end of {y}|some of the {y}" for x, y in [("road", "moon"), ("yam", "salt"), ("sea", "drum")])
    (a, f, r), kinds = quality.describe([indented, far, rows_of])
    assert a[at("indent_period")] == pytest.approx(0.75) and f[at("indent_period")] == pytest.approx(30 / 36)
    assert r[at("delimiter_alignment")] == 1.0 and kinds == ["prose", "prose", "prose"]
    few = "\n".join(f"the bread {x} salt {x} drum|{x} yam at {x} moon|{x} road {x}" for x in ("kofa", "milo", "tano"))
    code = "the of a an and " + "Zm9vYmFyYmF6cXV4" * 4
    assert quality.describe([few, "go to go go at go of", code])[1] == ["table", "junk", "junk"]


def test_quality_columns(spark):
    df = spark.createDataFrame([(1, "Two words.", "mine"), (2, None, "mine"), (3, "  \n ", "mine"), (4, PROSE + " " + "word " * 80_000, "mine")], "id long, text string, kind string")
    got = {r.id: r for r in quality.text_quality(df, "text").collect()}
    assert (got[1].n_chars, got[1].n_words, got[1].mean_word_length, got[1].line_end_ratio) == (10, 2, 4.0, 1.0)
    assert abs(got[1].symbol_ratio - 1 / 9) < 1e-9
    assert got[2].kind is None and got[2].n_words is None and got[3].kind is None and got[3].n_words == 0
    assert quality.text_quality(df.limit(0), "text").count() == 0
    together, kinds = quality.describe([t for ts in TEXTS.values() for t in ts])
    alone = [quality.describe([t]) for ts in TEXTS.values() for t in ts]
    assert kinds == [k[0] for _, k in alone] and np.allclose(together, np.concatenate([s for s, _ in alone]))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run(spark, name):
    import duckdb
    from pathlib import Path

    got = queries.QUERIES[name](spark, SF)
    mine = rows(got.select(*sorted(got.columns)))
    if name in queries.ORACLE:
        con = duckdb.connect()
        for p in Path(SF).glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        cur = con.execute(queries.ORACLE[name])
        names = [d[0] for d in cur.description]
        assert mine == sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in cur.fetchall()), key=str)
