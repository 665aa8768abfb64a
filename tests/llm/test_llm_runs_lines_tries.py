"""Periodic runs, line runs and the prefix trie beside brute-force versions, and on odd input."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadloom.llm import centroids, lines, ngram_join, periodic, trie
from broadloom.llm.common import split_lookup, stored

DOCS = "doc_id long, text string, runs string, key string, h1 string, n_lines string, gone string, length string"
TURNS = "conv_id long, turn long, role string, text string, depth string, owner string, weight string"


# ------------------------------------------------------------------ periodic runs

def brute_runs(words, least=24):
    """Every diagonal from end to end; of equal stretches that of the smallest lag is the run."""
    n, found = len(words), {}
    for lag in range(1, n // 3 + 1):
        match = 0
        for i in range(lag, n + 1):
            if i < n and words[i] == words[i - lag]:
                match += 1
                continue
            length = match + lag
            if match and length >= max(least, 3 * lag):
                found.setdefault((i - length, length), lag)
            match = 0
    return sorted((s, n, q) for (s, n), q in found.items())


@given(st.lists(st.tuples(st.integers(0, 2), st.integers(1, 9), st.integers(1, 30)), max_size=8), st.sampled_from([3, 7, 24, 31]), st.integers())
@settings(max_examples=150, deadline=None)
def test_runs_equal_brute_force(parts, least, seed):
    choose, words = random.Random(seed), []
    for letters, period, length in parts:
        block = [choose.randint(0, letters) for _ in range(period)]
        words += [block[i % period] for i in range(length)]
    assert [tuple(r) for r in periodic.find_runs(np.array(words, np.int64), least)] == brute_runs(words, least)


def test_runs_of_long_periods_and_long_texts():
    words = list(range(700)) * 4 + [5] * 50
    assert periodic.find_runs(np.array(words)) == brute_runs(words) == [(0, 2800, 700), (2800, 50, 1)]
    assert periodic.find_runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]


def expected_runs(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_run_digests_equal_brute_force(spark):
    choose = random.Random(3)
    texts = [None, "", " \n\t ", "one", "ä b " * 40, "x y " * 30, "A a " * 30, ("the cat sat " * 20) + "on the mat " * 20]
    texts += [" ".join(choose.choice(["a", "b", "c\x0b"]) for _ in range(choose.randint(1, 300))) for _ in range(60)]
    texts += [" ".join(f"w{choose.randint(0, 400)}" for _ in range(1500)) for _ in range(25)]
    rows = [(k, text) for k, text in enumerate(texts)] + [(None, "a " * 50), (None, None), (0, "twice"), (0, "twice")]
    frame = spark.createDataFrame([(d, t, "r", "k", "h", "n", "g", "l") for d, t in rows], DOCS)
    found = periodic.digests(periodic.periodic_runs(periodic.with_planted_periods(frame))).collect()
    assert Counter(tuple(r) for r in found) == Counter(expected_runs(d, t) for d, t in rows)
    assert any(r["n_runs"] for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)


def test_collapsed_text_and_runs_are_real_outputs(spark):
    frame = spark.createDataFrame([(1, "start " + "go on and " * 9 + "end")], "doc_id long, text string")
    row = periodic.periodic_runs(frame).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 27, 3)] and row["collapsed"] == "start go on and end"


# ------------------------------------------------------------------ line runs

def brute_lines(rows, least=10, shortest=1):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    seen = Counter(k for _, text in rows for k in {key(x) for x in (text or "").split("\n")})
    gone = {k for k, n in seen.items() if n >= least and len(k) >= shortest}
    out = []
    for doc_id, text in rows:
        every = (text or "").split("\n")
        left = [x for x in every if key(x) not in gone]
        out.append((doc_id, len(every), len(every) - len(left), "\n".join(left)))
    return Counter(out)


def some_lines():
    choose = random.Random(5)
    common = [f"Line {k}" for k in range(40)] + ["ÄÖ x", " tab\t", "", "  "]
    rows = [(k, "\n".join(choose.choice(common) if choose.random() < 0.4 else f"own {choose.random()}"
                          for _ in range(choose.randint(0, 9)))) for k in range(150)]
    rows += [(200 + k, "HOT line" + "\n hot LINE\x0b" * (k % 3)) for k in range(120)]
    return rows + [(None, None), (None, "hot line"), (None, "hot line"), (1, "again"), (1, "again"), (2, None), (3, ""), (4, "long\n" * 20_000)]


@pytest.mark.parametrize("parts, fanout", [(1, 2), (9, 2), (11, 3)])
def test_dropped_lines_equal_brute_force(spark, parts, fanout):
    rows = some_lines()
    frame = spark.createDataFrame([(d, t, "r", "k", "h", "n", "g", "l") for d, t in rows], DOCS)
    runs = lines.LineRuns(spark, 4, fanout=fanout)
    for part in range(parts):
        runs.add(frame.where(F.abs(F.hash("text", "doc_id")) % parts == part))
    assert sum(len(level) for level in runs.levels) <= fanout * len(runs.levels)
    common = runs.common()
    runs.drop()
    found = Counter(tuple(r) for r in lines.drop_lines(frame, common).select("doc_id", "n_lines", "n_dropped", "text").collect())
    assert found == brute_lines(rows)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_runs_")]


def test_other_thresholds_and_an_empty_table(spark):
    rows = [(k, "Aa\nbbbb\n" + "c" * k) for k in range(6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    common = lines.common_lines([frame], 100, least_documents=3, least_length=3)
    assert Counter(tuple(r) for r in lines.drop_lines(frame, common).collect()) == brute_lines(rows, 3, 3)
    empty = frame.where("false")
    assert lines.drop_lines(empty, lines.common_lines([empty], 0)).count() == 0


def test_runs_merge_without_a_shuffle(spark):
    frame = spark.createDataFrame(some_lines(), "doc_id long, text string")
    runs = lines.LineRuns(spark, 4, fanout=3)
    runs.add(frame.where("doc_id % 2 = 0"))
    runs.add(frame.where("doc_id % 2 = 1"))
    with runs._bucketwise():
        plan = runs._merged(runs.levels[0])._jdf.queryExecution().executedPlan().toString()
    runs.drop()
    assert "Exchange" not in plan and "Sort [" not in plan and plan.count("Bucketed: true") == 2


def test_lookup_of_hot_and_rare_keys(spark):
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("a"), F.lit(1).alias("b"))
    side = spark.createDataFrame([(7, 1, 10_001, "hot"), (5, 1, 1, "rare"), (8, 2, 1, "other")], "a long, b int, often long, name string")
    found = split_lookup(rows, side, ["a", "b"], "often", ["id"])
    assert dict(found.groupBy("name").count().collect()) == {"hot": 10_001, "rare": 1, None: 30_000 - 10_002}


# ------------------------------------------------------------------ prefix trie

def brute_trie(rows, borrow=True):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(role, text) for _, _, role, text in sorted(t)] for c, t in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(turns.get(c - c % 5, [])[:h] + own[h:]) if borrow else tuple(own)
    members = defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        size = len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) if children[node] else 1
        saved[node] = (len(members[node]) - 1) * size + sum(saved[k] for k in children[node])
    return Counter((
        min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
        hashlib.sha256(",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(node))).encode()).hexdigest())
        for node, m in members.items())


def some_turns():
    choose = random.Random(11)
    rows = []
    for c in range(0, 300):
        if c % 50 == 20:
            continue
        for turn in range(choose.randint(1, 12)):
            first = f"open {choose.choice('aaab')}" if turn < 2 else choose.choice(["yes", "no", "é", "", None])
            rows.append((c, turn if choose.random() < 0.95 else None, choose.choice(["user", "user", "bot", None]), first))
    rows += [(c, t, "user", f"same {t}") for c in range(400, 480) for t in range(5)]
    rows += [(500, t, "user", f"deep {t % 7}") for t in range(900)] + [(501, t, "user", f"deep {t % 7}") for t in range(700)]
    return rows + [(None, 1, "user", "lost"), (7, 1, "user", "x"), (7, 1, "user", "x")]


@pytest.mark.parametrize("piece", [20_000, 300, 12])
def test_trie_equals_brute_force(spark, piece):
    rows = some_turns()
    frame = spark.createDataFrame([(*r, "d", "o", "w") for r in rows], TURNS)
    turns = stored(trie.ordered_turns(frame), "turns")
    found = trie.prefix_trie(*trie.with_borrowed_beginnings(turns), piece=piece)
    assert Counter(tuple(r) for r in found.collect()) == brute_trie(rows)


def test_trie_of_the_turns_as_they_are(spark):
    rows = some_turns()[:400]
    turns = stored(trie.ordered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), "turns")
    assert Counter(tuple(r) for r in trie.prefix_trie(*trie.sequences(turns)).collect()) == brute_trie(rows, borrow=False)


def test_trie_of_nothing(spark):
    frame = spark.createDataFrame([(None, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    assert trie.prefix_trie(*trie.with_borrowed_beginnings(trie.ordered_turns(frame))).count() == 0


@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=120))
@settings(max_examples=150, deadline=None)
def test_settle_equals_direct_sums(picks):
    parent = np.array([-1] + [picks[i] % (i + 1) if picks[i] % 17 else -1 for i in range(len(picks))])
    n = len(parent)
    value = np.stack([np.arange(n) % 7 + 1, np.arange(n) ** 2], 1)
    total, weight = value.copy(), np.arange(n) % 5 + 1
    for i in range(n - 1, 0, -1):
        if parent[i] >= 0:
            total[parent[i]] += total[i]
            weight[parent[i]] += weight[i]
    found = centroids.settle(parent, weight, value, np.zeros_like(value))
    assert (found == total).all()


def test_settle_a_deep_chain():
    n = 20_000
    parent = np.arange(n) - 1
    found = centroids.settle(parent, np.arange(n, 0, -1), np.ones((n, 1), np.int64), np.zeros((n, 1), np.int64))
    assert (found[:, 0] == np.arange(n, 0, -1)).all()


# ------------------------------------------------------------------ one document of each group

def some_prose(seed, n=60):
    choose = random.Random(seed)
    return " ".join("".join(choose.choice("abcdefgh") for _ in range(choose.randint(2, 7))) for _ in range(n))


def test_one_of_each_keeps_other_texts_of_a_repeated_id(spark):
    a, b, x, y = (some_prose(k) for k in range(4))
    near = x + " tail"
    rows = [(1, a), (2, a), (2, b), (3, x), (3, y), (4, near), (5, ""), (5, None), (6, "  "), (6, "  "), (None, a), (7, y), (8, a)]
    schema = "doc_id int, text string, gone_id long, node string, row string, text_hash string, `group` string, least int"
    frame = spark.createDataFrame([(d, t, 9, "n", "r", "h", "g", 0) for d, t in rows], schema)
    left = ngram_join.one_of_each(frame)
    assert left.columns == frame.columns and left.dtypes == frame.dtypes
    want = [(1, a), (2, b), (3, x), (3, y), (5, ""), (5, None), (6, "  "), (None, a)]
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(want)
    ids = {(r["doc_id"], r["n_shingles"] > 0, r["component_id"]) for r in ngram_join.near_duplicates(frame).collect()}
    assert {(2, True, 1), (2, True, 2), (4, True, 3), (7, True, 3), (8, True, 1), (5, False, 5)} <= ids


def test_one_text_stays_of_near_copies_under_one_id(spark):
    x = some_prose(9)
    frame = spark.createDataFrame([(3, x), (3, x + " tail"), (5, x), (3, x)], "doc_id long, text string")
    left = [tuple(r) for r in ngram_join.one_of_each(frame).collect()]
    assert len(left) == 1 and left[0] in ((3, x), (3, x + " tail"))


def test_intermediates_are_removed(spark):
    import glob
    rows = [(k, some_prose(k % 7) + (" tail" * (k % 3))) for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/broadloom/"
    before = set(glob.glob(root + "*"))
    assert ngram_join.near_duplicates(frame).count() == 40
    labels = Counter(p.removeprefix(root).rsplit("-", 1)[0] for p in set(glob.glob(root + "*")) - before)
    assert not {"shared", "survivors", "common", "prefixes", "bitmaps", "postings", "open", "sets"} & set(labels)
