"""Problems 2, 3, 4 and 6 against brute force and in edge cases."""

import collections
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import incremental, neardup, records, survivor
from postlens.llm.ids import last_part, posting_number
from postlens.llm.shingles import ExactGrams, words

JOB = "row_id bigint, title string, company string, location string, url string, n_copies int, f1 string"


def jobs(spark, rows):
    return spark.createDataFrame([(i, *r, 1, "x") for i, r in enumerate(rows, 1)], JOB)


def pairs(df):
    return sorted(map(tuple, df.collect()))


def test_copies(spark):
    rows = [
        ("SAP Dev (m/f)", "Ä & Co", "Köln, Germany", "https://x.example/a-1?p=1&q=2"),
        ("sap​ dev m/f.", "Ä &amp; CO", " germany / KÖLN ", "HTTPS://X.example//A-1/?q=2&p=1#"),
        ("Ä&Co", "SAP-Dev (m/f)", "Köln;Germany", "https://x.example/a-1?p=1&q=2&"),
        ("SAP Dev (m/f)", "Ä & Co", None, "https://x.example/a-1?p=1&q=2"),
        ("SAP Dev (m/f)", "Ä & Co", None, "https://x.example/a-1?p=1&q=2"),
        ("SAP Dev (m/f)", "Ä & Co", "", "https://x.example/a-1?p=1&q=2"),
        ("SAP Dev (m/f)", "A & Co", "Köln, Germany", "https://x.example/a-1?p=1&q=2"),
        ("SAP Dev (m/f)", "Ä & Co", "Köln, Germany", "https://x.example/a-1?p=1&q=3"),
        ("SAP Dev (m/f)", "Ä & Co", "Köln, Köln, Germany", "https://x.example/a-1?p=1&q=2"),
        (None, None, None, None),
        (None, None, None, None),
        ("", None, None, None),
        ("x" * 100_000, None, None, None),
    ]
    got = pairs(records.copy_pairs(jobs(spark, rows)))
    assert got == [(1, 2), (1, 3), (4, 5), (10, 11)]
    sizes = {r["row_id"]: r["n_copies"] for r in records.collapse(jobs(spark, rows)).collect()}
    assert sum(sizes.values()) == len(rows) and sizes[1] == 3 and sizes[10] == 2 and sizes[12] == 1


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(records, "_multiset_hash", lambda bags, seed: F.lit(seed).cast("bigint"))
    rows = [("a", "b", "c", "d"), ("b", "a", "C", "d"), ("x", "b", "c", "d"), ("b", "X", "c", "d")]
    assert pairs(records.copy_pairs(jobs(spark, rows))) == [(1, 2), (3, 4)]


def test_copies_of_nothing(spark):
    assert records.copy_pairs(jobs(spark, [])).count() == 0 and records.collapse(jobs(spark, [])).count() == 0


def corpus():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(30, 120))] for _ in range(60)]
    out = []
    for b in base:
        out.append(b)
        for edits in (1, 2, 4, 8):
            c = list(b)
            for _ in range(edits):
                k = rng.randrange(len(c))
                c[k : k + 1] = rng.choice(([], [rng.choice(vocabulary)], [c[k], "new"]))
            out.append(c)
        out.append(list(b))
    texts = [" ".join(x) for x in out]
    texts += [None, "", "<p></p>", "short text", "a b c " * 20, "<b>A</b> b C " * 20, "z " * 3000, texts[0].upper().replace(" ", "<br>")]
    return texts


@pytest.mark.parametrize("n, similarity, least", [(3, 0.7, 30), (5, 0.8, 1)])
def test_near_duplicates_equal_brute_force(spark, n, similarity, least):
    texts = corpus()
    rows = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, description string").withColumn("t", F.lit("clash")).withColumn("a", F.lit(1))
    sets = {}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\W_]+", re.sub(r"<[^>]*>", " ", t or "").lower())
        g = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        if len(w) >= least and g:
            sets[i] = g
    want = [(i, j) for i, j in itertools.combinations(sorted(sets), 2) if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9]
    got = pairs(neardup.similar_rows(rows, "row_id", "description", n=n, similarity=similarity, min_words=least))
    assert got == want and len(want) > 100
    found = neardup.classes(rows, "row_id", "description", n=n, similarity=similarity, min_words=least).collect()
    assert len(found) == sum(t is not None for t in texts)
    root = {r["row_id"]: r["class_id"] for r in found}
    assert all(root[i] == root[j] for i, j in want)
    assert len({root[i] for i, _ in want}) <= 63


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], "row_id bigint, description string")
    assert neardup.similar_rows(empty, "row_id", "description").count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (7, 7)]
    got = {r["node"]: r["root"] for r in neardup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(41)) and {got[100], got[101], got[103]} == {100}


def test_exact_grams_and_words():
    assert words("A<br>b_c É9") == ["a", "b", "c", "é9"]
    for n in (1, 3, 5):
        assert len(ExactGrams(n).of("a b a b a b a b")) == (2 if n > 1 else 2)


def test_posting_numbers(spark):
    cases = [
        ("3100151707", "u", "3100151707"), ("3100369496.0", None, "3100369496"), ("0003100053586", None, "3100053586"), ("3,100,319,492", None, "3100319492"),
        ("urn:li:jobPosting:3100218817", None, "3100218817"), (" \n", "https://x/jobs/view/a-b-3100112536/", "3100112536"), (None, "https://x/jobs/search?currentJobId=3100145038&utm=1", "3100145038"),
        (None, "https://x/jobs/view/3100254018?refId=3100000000", "3100254018"), (None, "https://x/jobs/v/a-b", None), (None, None, None), ("n/a", "https://x/3100254018", None),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a string, b string")
    got = {r["i"]: r["n"] for r in df.select("i", posting_number(F.col("a"), F.col("b")).alias("n")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[2] for c in cases]
    assert spark.range(1).select(last_part(F.lit("HTTPS://X.example/Jobs/V/A-b/?q=1#f")).alias("p")).first()["p"] == "a-b"


POLICIES = (survivor.Policy("d", ("score", "trust", "time"), "n"), survivor.Policy("t", ("time",), "h"), survivor.Policy("v", ("votes",)))


def test_survivors(spark):
    schema = "g string, row_id bigint, d string, n int, t string, h int, v string, trust int, ms bigint, rank int"
    rows = [
        ("a", 1, "x", 5, "t", 1, "Red", 2, 10, 0), ("a", 2, "y", 5, "t", 1, "blue", 1, 5, 0), ("a", 3, "z", 5, "t", 1, " red ", 1, 5, 0), ("a", 4, None, 0, None, None, None, None, None, 0),
        ("b", 5, None, None, None, None, "", None, None, 0), (None, 6, "x", 9, "t", 1, "x", 1, 1, 0), ("c", 7, "x", 1, "t", 1, "k", None, 3, 0), ("c", 7, "x", 1, "t", 1, "k", None, 3, 0),
    ]
    df = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, survivor.winners(df, "g", "row_id", POLICIES, "trust", "ms").select("g", "field", "row_id").collect()))
    assert got == [("a", "d", 2), ("a", "t", 1), ("a", "v", 3), ("c", "d", 7), ("c", "t", 7), ("c", "v", 7)]
    gold = {r["g"]: r for r in survivor.golden(df, "g", "row_id", POLICIES, "trust", "ms").collect()}
    assert (gold["a"]["d"], gold["a"]["v"].strip().lower(), gold["c"]["t"]) == ("y", "red", "t")
    assert survivor.winners(df.limit(0), "g", "row_id", POLICIES, "trust", "ms").count() == 0
    assert spark.range(1).select(survivor.n_distinct_words(F.lit("A a<br>b! É9 é9")).alias("n")).first()["n"] == 3


def slug_rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(("lo", "gra", "bin", "vu", "kel", "tor")) for _ in range(4))
    base = [["senior", "sap", rng.choice(("mm", "sd")), "consultant", rng.choice(("berlin", "porto")), word(), word()] for _ in range(80)]
    out = []
    for b in base:
        w = list(b)
        k = rng.randrange(len(w))
        kind = rng.randrange(5)
        if kind == 0:
            w.insert(k, "new")
        elif kind == 1:
            del w[k]
        elif kind == 2:
            w[k] = w[k][:-1] + "xy"
        elif kind == 3:
            w[-1], w[-2] = word(), word()
        out.append("-".join(w))
    return ["-".join(b) for b in base], out


def contents(spark, rows, batches):
    df = spark.createDataFrame([(i, b, None, u) for i, (u, b) in enumerate(zip(rows, batches, strict=True))], "id bigint, batch_no int, linkedin_job_id string, url string")
    return incremental.contents(df, "id", F.col("batch_no"))


def test_batches_equal_brute_force_and_store(spark, tmp_path):
    old, new = slug_rows()
    url = lambda s: None if s is None else f"https://x.example/jobs/v/{s.upper()}/?q=1"
    arriving = [*new, *new[:5], None, old[0]]
    batches = [1 + i % 3 for i in range(len(arriving))]
    history, incoming = contents(spark, map(url, old), [-1] * len(old)), contents(spark, map(url, arriving), batches)
    want, seen = [], list(old)
    for i in sorted(range(len(arriving)), key=lambda i: (batches[i], i)):
        s = arriving[i]
        if s is None:
            continue
        if any(incremental.one_word_apart(s, o) for o in seen):
            want.append(i)
        seen.append(s)
    for rows_per_bucket in (10, 1_000_000):
        store = incremental.ChunkStore(spark, str(tmp_path / f"s{rows_per_bucket}"), rows_per_bucket)
        got = sorted(r["record"] for r in incremental.known_records(store, history, incoming).collect())
        assert got == sorted(want) and len(want) > 50
    # a batch that comes again, as after a restart, gives the same; one that comes later is known by itself
    again = incoming.where("batch = 2")
    store.append(2, again)
    assert sorted(r["record"] for r in store.check(2, again).collect()) == sorted(i for i in want if batches[i] == 2)
    later = again.withColumn("batch", F.lit(9))
    store.append(9, later)
    assert {r["record"] for r in store.check(9, later).collect()} == {i for i, b in enumerate(batches) if b == 2 and arriving[i] is not None}


def known(spark, tmp_path, history, incoming):
    return incremental.known_records(incremental.ChunkStore(spark, str(tmp_path)), history, incoming)


def test_batches_of_nothing(spark, tmp_path):
    none, some = contents(spark, [], []), contents(spark, ["https://x/v/a-b", None, "https://x/v/a-c"], [1, 1, None])
    assert known(spark, tmp_path / "a", none, none).count() == 0
    assert [r["record"] for r in known(spark, tmp_path / "b", none, some).collect()] == [2]
    assert known(spark, tmp_path / "c", some, none).count() == 0


def test_single_words(spark, tmp_path):
    words = ["consultantberlinlogra", "consultantberlinlogrb", "new-consultantberlinlogra", "other", "consultantberlinlogra-x-y"]
    got = known(spark, tmp_path, contents(spark, ["https://x/v/" + words[0]], [-1]), contents(spark, ["https://x/v/" + w for w in words[1:]], [1] * 4))
    assert sorted(r["record"] for r in got.collect()) == [0, 1]


def test_misspelt_single_words_equal_brute_force(spark, tmp_path):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
    old, new = [word() for _ in range(60)], [word() for _ in range(60)]
    want = {i for i, w in enumerate(new) if any(incremental.one_word_apart(w, o) for o in [*old, *new[:i]])}
    urls = lambda ws: [f"https://x/v/{w}" for w in ws]
    got = known(spark, tmp_path, contents(spark, urls(old), [0] * 60), contents(spark, urls(new), [1] * 60))
    assert {r["record"] for r in got.collect()} == want


def test_chunks_come_back_after_an_edit():
    a, b = "senior-sap-consultant-berlin-logra-vubin", "senior-sap-consutlant-berlin-logra-vubin"
    assert b"".join(incremental.chunks(a)).decode() == a + "-" and len(incremental.chunks(a)) > a.count("-") + 3
    rest = [c for w in a.split("-") if w != "consultant" for c in incremental.chunks(w)]
    assert set(rest) <= set(incremental.chunks(a)) & set(incremental.chunks(b))
    assert incremental.edits("abcd", "abxd", 3) == 1 and incremental.edits("a", "abcdef", 3) == 4


def test_crowded_nodes_give_all_pairs(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(neardup, "CROWD", 10)
    monkeypatch.setattr(neardup, "SIDES", 4)
    rng = np.random.default_rng(1)
    rows = sorted((node, int(t)) for node, n in ((3, 57), (4, 1), (5, 2), (6, 10), (7, 11), (9, 300)) for t in rng.integers(-(2**62), 2**62, n))
    rows = sorted([*rows, *rows[:5]])  # repeated rows
    members = [sorted({t for n, t in rows if n == node}) for node in {n for n, _ in rows}]
    want = {pair for ts in members for pair in itertools.combinations(ts, 2)}
    for size in (1, 7, 64, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[at : at + size]], pa.int64()) for k in (0, 1)], ["node", "t"]) for at in range(0, len(rows), size)]
        dealt = sorted(r for b in neardup._below_nodes(iter(batches)) for r in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True))
        cells = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in dealt[at : at + size]], pa.int64()) for k in range(3)], ["cell", "a", "b"]) for at in range(0, len(dealt), size)]
        got = {r for b in neardup._in_cells(iter(cells)) for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
        assert got == want, size
        grid = [c for c, _, _ in dealt if c >= 0]
        assert max(grid.count(c) for c in set(grid)) < 300


def test_text_shared_by_many_rows_and_pairs_equal_with_small_crowds(spark, monkeypatch):
    """The operator gives the same whatever the size of a crowd (workers have the default, so plans are compared by their rows)."""
    rows = [(i, " ".join(f"w{(i * 7 + k) % 23 if k < 40 else k}" for k in range(60))) for i in range(30)] + [(100 + i, " ".join(f"w{k}" for k in range(60))) for i in range(20)]
    df = spark.createDataFrame(rows, "row_id bigint, text string")
    got = {(r[0], r[1]) for r in neardup.similar_rows(df, "row_id", "text", n=3, similarity=0.7).collect()}
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(58)} for i, t in rows}
    assert got == {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.7 * len(sets[a] | sets[b])}


@pytest.mark.parametrize("crowd", [4096, 1])
def test_texts_of_the_same_phrases_are_no_candidates(monkeypatch, crowd):
    """Pairs that share a node by chance, whose number grows as the square of the texts, go no further than their node."""
    import pyarrow as pa

    monkeypatch.setattr(neardup, "CROWD", crowd)
    monkeypatch.setattr(neardup, "SIDES", 4)
    rng = random.Random(9)
    phrases = [" ".join(f"w{rng.randrange(300)}" for _ in range(8)) for _ in range(60)]
    base = [" ".join(rng.sample(phrases, 15)) for _ in range(2500)]
    texts = [*base, *(t.replace(" ", " new ", 1) for t in base[:200])]
    least = neardup.least_agreement(0.7, 40)
    given = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts), pa.array([1] * len(texts), pa.int64())], ["t", "text", "n"])
    rows = sorted(r for b in neardup._paths(3, 30, 40, 6, 0.7)(iter([given])) for r in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True))

    def batches(rows, width):
        return (pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[at : at + 500]], pa.int64()) for k in range(width)], [str(k) for k in range(width)]) for at in range(0, len(rows), 500))

    dealt = sorted(r for b in neardup._below_nodes(batches(rows, 3), least) for r in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True))
    assert (crowd > 1) == all(c == 0 for c, *_ in dealt)
    got = [r for b in neardup._in_cells(batches(dealt, 4), least) for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    nodes = collections.defaultdict(set)
    for node, t, _ in rows:
        nodes[node % 2**64 >> neardup.BELOW_NODE].add(t)
    met = {p for ts in nodes.values() for p in itertools.combinations(sorted(ts), 2)}
    near = {(i, 2500 + i) for i in range(200)}
    assert near <= set(got) <= met and len(met) > 1000
    assert len(set(got)) < 200 + 0.4 * (len(met) - 200)


def test_agreement_asked_of_sketches_loses_next_to_nothing():
    rng, least = np.random.default_rng(4), neardup.least_agreement(0.7, 40)
    same = rng.random((200_000, 40)) < 0.7 + 0.3 / 4
    assert 0 < (same.sum(axis=1) < least).mean() < 1.5e-4
    x = rng.integers(0, 2**63, (1, 2), dtype=np.uint64)
    assert neardup.agreement(x, x).tolist() == [40] and neardup.agreement(x, x ^ np.array([[0b0110, 3]], np.uint64)).tolist() == [37]
