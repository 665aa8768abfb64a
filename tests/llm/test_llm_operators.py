"""The training-data operators against brute force, and on odd input."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from broadloom.llm import (
    decontaminate, graph, idstore, language, neighbours, ngram_join, packing, quality, sharding, substring, toxicity,
)
from broadloom.llm.common import among, stored
from broadloom.llm.tokens import Encoder, vocabulary_path
from broadloom.llm.words import shingle_sets
from broadloom.session import shared_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, given by the caller as well.
CLASH = ["node", "shard", "component", "token", "row", "size", "score", "length", "part", "label"]


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def prose(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def edited(rng, text, share):
    return " ".join(w if rng.random() > share else w[::-1] + "x" for w in text.split(" "))


def corpus(seed=5):
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(3, 120)) for _ in range(60)]
    texts += [edited(rng, texts[k % 60], share) for k in range(60) for share in (0.0, 0.02, 0.05)]
    base = prose(rng, 200)
    texts += [edited(rng, base, 0.012) for _ in range(60)] + [base] * 20
    texts += ["", "  \n\t ", None, "One", "one", "Two words", "É x y", "a a a a a a a a a a", prose(rng, 6000)]
    rng.shuffle(texts)
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = corpus()
    return spark.createDataFrame(rows, SCHEMA).repartition(5), {r[0]: r[1] for r in rows}


def awkward(spark):
    """Nulls in every column, empty texts, repeated rows and clashing names."""
    rows = [(1, "one two three four five six", "en", "s", 27), (1, "one two three four five six", "en", "s", 27),
            (None, "one two three four five six", None, None, None), (2, None, None, None, None), (3, "", "en", "s", 0), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit(7).alias(c) for c in CLASH])


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


LABELS = "doc_id long, quality int, toxic int"


# ---------------------------------------------------------------- similarity join


def brute_components(texts, percent=75):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = [i for i in sorted(sets) if sets[i]]
    for a in ids:
        for b in ids:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_similarity_join_equals_brute_force(docs):
    df, texts = docs
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()}
    assert found == brute_components(texts)


def test_all_similar_pairs(docs):
    df, texts = docs
    pairs, members = ngram_join.similar_pairs(df)
    first = {}
    for i in sorted(texts):
        if shingles(texts[i]):
            first.setdefault(shingles(texts[i]), i)
    sets = [(i, s) for s, i in first.items()]
    expected = {(min(a, b), max(a, b)) for a, x in sets for b, y in sets if a < b and 100 * len(x & y) >= 75 * len(x | y)}
    assert {(r.a, r.b) for r in pairs.collect()} == expected
    assert {r.doc_id: r.representative for r in members.collect()} == {i: first.get(shingles(t)) for i, t in texts.items()}


def test_similarity_join_shuffles_no_texts(spark, docs, monkeypatch, static_plans, tmp_path):
    """Also where more texts may have a partner than Spark would broadcast."""
    plans = []
    docs[0].write.parquet(str(tmp_path / "docs"))

    def watched(df, label):
        if label == "sets":
            plans.append(df._jdf.queryExecution().explainString(
                spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
        return stored(df, label)

    monkeypatch.setattr(ngram_join, "stored", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ngram_join.prepare(spark.read.parquet(str(tmp_path / "docs")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", plans[0])
    assert shuffled and not [c for c in shuffled if "text#" in c]


def test_rows_among_keys_pass_and_few_others(spark):
    rows = spark.range(-3_000, 3_000).withColumnRenamed("id", "key").unionByName(spark.createDataFrame([(None,)], "key long"))
    side = spark.createDataFrame([(k,) for k in range(-3_000, 3_000, 6)] + [(None,)], "key long")
    for most in (1, 4_096):
        left = {r.key for r in among(rows, "key", side, most).collect()}
        assert left >= set(range(-3_000, 3_000, 6)) and None not in left
        assert len(left) < 1_000 + 5_000 * 0.1
    assert among(rows, "key", side.limit(0)).count() == 0


def test_similarity_join_on_odd_input(spark):
    out = [tuple(r) for r in ngram_join.near_duplicates(awkward(spark)).collect()]
    assert Counter(out) == Counter([(1, 2, 1), (1, 2, 1), (None, 2, None), (2, 0, 2), (3, 0, 3), (None, 0, None)])
    assert ngram_join.near_duplicates(nothing(spark)).count() == 0
    kept = ngram_join.one_of_each(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, None, None])


def test_shingle_sets_have_the_right_sizes(docs):
    _, texts = docs
    column = [texts[i] for i in sorted(texts)]
    assert [len(s) for s in shingle_sets(pa.array(column, pa.string()))] == [len(shingles(t)) for t in column]


def test_components_of_paths_stars_and_noise(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(8, 50)] + [(1, 1), (None, 3), (200, 201), (201, 200)]
    found = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    expected = {**{k: 100 for k in range(100, 161)}, **{k: 7 for k in range(7, 50)}, 200: 200, 201: 200}
    assert found == expected
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- passages


def test_repeated_passages_are_found_and_cut(spark):
    rng = random.Random(3)
    passage = prose(rng, 55)
    changed = passage.split(" ")
    changed[27] = "other"
    filler = [prose(rng, rng.randint(30, 90)) for _ in range(12)]
    rows = [(0, f"{filler[0]} {passage} {filler[1]}"), (1, f"{filler[2]} {passage} {filler[3]}"), (2, f"{passage}\n{filler[4]}"),
            (3, f"{filler[5]} {' '.join(changed)} {filler[6]}"), (4, filler[7]), (5, filler[8]), (6, None), (7, ""), (None, passage),
            (8, f"{filler[9]} {passage.split(' ')[0]} {filler[10]}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text")).repartition(3)
    found = substring.repeated_passages(df)
    assert {r.doc_id for r in found.collect()} == {1, 2, 3} and {r.kept_doc_id for r in found.collect()} == {0}
    out = {r.doc_id: r for r in substring.remove_passages(df, found).collect()}
    assert out[0].text == rows[0][1] and out[4].text == rows[4][1] and out[8].text == rows[9][1]
    assert out[1].text == f"{filler[2]} {filler[3]}" and out[1].n_chars == len(out[1].text)
    assert out[2].text == filler[4] and out[3].text == f"{filler[5]} {filler[6]}"
    assert out[6].text is None and out[None].text == passage


def covered(found):
    """Words that the passages of each document cover."""
    out = {}
    for r in found.collect():
        out.setdefault(r.doc_id, set()).update(range(r.first_word, r.first_word + r.n_words))
    return out


def test_copy_with_one_more_word_on_its_last_line(spark):
    rng = random.Random(21)
    rows = []
    for k in range(12):
        text = prose(rng, 300)
        rows += [(2 * k, text), (2 * k + 1, f"{text} tail")]
    found = covered(substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")))
    assert set(found) == {2 * k + 1 for k in range(12)}
    assert all(found[2 * k + 1] >= set(range(300)) for k in range(12))


def wrapped(text, n):
    w = text.split(" ")
    return "\n".join(" ".join(w[k:k + n]) for k in range(0, len(w), n))


def test_passages_in_short_lines_and_wrapped_anew(spark):
    rng = random.Random(22)
    rows, expected = [], {}
    for k in range(8):
        passage = prose(rng, 60)
        for j, text in enumerate((wrapped(passage, 3), wrapped(passage, 3), wrapped(passage, 7), passage)):
            head = prose(rng, 30 + j)
            rows.append((10 * k + j, f"{head}\n{text}\n{prose(rng, 30)}"))
            if j:
                expected[10 * k + j] = set(range(30 + j, 90 + j))
    found = covered(substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")))
    assert set(found) == set(expected) and all(found[k] >= expected[k] for k in expected)


def test_long_repetitive_texts_repeat_whole(spark):
    rows = [(0, "la " * 70_000), (1, "la " * 70_000), (2, "do re mi " * 23_333), (3, "re mi do " * 23_333), (4, "fa " * 300), (5, "fa " * 200)]
    found = covered(substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")))
    assert set(found) == {1, 3, 5}
    assert found[1] == set(range(70_000)) and found[5] == set(range(200)) and found[3] >= set(range(69_990))


def test_passages_whose_pieces_are_in_earlier_documents(spark):
    rng = random.Random(23)
    rows, expected = [], {}
    for k in range(6):
        w = prose(rng, 60).split(" ")
        # Every stretch of 25 words stands in a document of its own before.
        rows += [(100 * k + j, f"{prose(rng, 20)} {' '.join(w[a:a + 25])} {prose(rng, 20)}") for j, a in enumerate(range(0, 36, 5))]
        rows += [(100 * k + j, f"{prose(rng, 30)} {' '.join(w)} {prose(rng, 30)}") for j in (50, 60)]
        expected[100 * k + 60] = set(range(30, 90))
    for k in range(6, 12):
        # The first holder has a word more in the middle, the second and third are equal.
        w = prose(rng, 60).split(" ")
        rows += [(100 * k, f"{prose(rng, 30)} {' '.join(w[:30] + ['more'] + w[30:])} {prose(rng, 30)}")]
        rows += [(100 * k + j, f"{prose(rng, 30)} {' '.join(w)} {prose(rng, 30)}") for j in (1, 2)]
        expected[100 * k + 2] = set(range(30, 90))
    found = covered(substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")))
    assert all(found.get(k, set()) >= expected[k] for k in expected)


def test_passages_on_odd_input(spark):
    df = awkward(spark)
    assert substring.repeated_passages(df).count() == 0
    assert substring.remove_passages(df, substring.repeated_passages(df)).columns == df.columns
    assert substring.repeated_passages(nothing(spark)).count() == 0


def test_band_count_reaches_the_recall():
    for rows in (1, 2, 3):
        bands = substring.tune_bands(0.75, 0.95, rows)
        assert 1 - (1 - 0.75**rows) ** bands >= 0.95 > 1 - (1 - 0.75**rows) ** (bands - 1)


# ---------------------------------------------------------------- tokens, packing, store


def test_pieces_encode_like_whole_texts():
    codec = Encoder(vocabulary_path())
    plain = Tokenizer.from_file(vocabulary_path())
    rng = random.Random(8)
    alphabet = "ab É×÷ß ñ.,'|<>!\n\t 1٣Ω日ǅ  ​😀_-x\r"
    texts = ["", None, "x <|endoftext|> y", "it's we'll '", "a\n\n b"] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(800)]
    texts += [prose(rng, 200) for _ in range(20)]
    found = []
    for _, ids, first in codec.texts(pa.array(texts, pa.string())):
        found += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
    assert found == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def encoded(texts):
    plain = Tokenizer.from_file(vocabulary_path())
    return {i: np.array(plain.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for i, t in texts.items()}


def test_packing_is_whole_and_tight(docs):
    df, texts = docs
    ids = encoded(texts)
    rows = packing.pack_documents(df, vocabulary_path()).collect()
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
        assert len(ids[r.doc_id]) <= 1024 and r.piece == 0 or len(ids[r.doc_id]) > 1024
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= 1.06 * -(-sum(map(len, ids.values())) // 1024) + 1


def test_plan_holds_the_histogram():
    rng = random.Random(1)
    histogram = Counter(min(1024, int(rng.expovariate(1 / 300)) + 1) for _ in range(5000))
    plan = packing.plan(histogram)
    used = Counter()
    for parts, count in plan:
        assert sum(parts) <= 1024
        for part in parts:
            used[part] += count
    assert used == histogram
    assert sum(count for _, count in plan) <= 1.01 * -(-sum(k * v for k, v in histogram.items()) // 1024) + 1


def test_packing_on_odd_input(spark):
    rows = packing.pack_documents(awkward(spark), vocabulary_path()).collect()
    assert Counter(r.doc_id for r in rows) == Counter([1, 1, None, None, 2, 3])
    assert packing.pack_documents(nothing(spark), vocabulary_path()).count() == 0


def test_store_round_trip_and_lookup(spark, docs):
    df, texts = docs
    ids = encoded(texts)
    path = shared_path(spark, "store")
    idstore.write_store(df, path, vocabulary_path(), shards=4)
    start = 0
    for r in sorted(idstore.read_digests(spark, path).collect(), key=lambda r: r.doc_id):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids[r.doc_id]), zlib.crc32(ids[r.doc_id].tobytes()))
        start += r.n_tokens
    asked = [0, 5, len(texts) - 1, 10**9, -4, None]
    out = {r.key: list(r.ids) for r in idstore.lookup(spark, path, spark.createDataFrame([(k,) for k in asked], "key long")).collect()}
    assert out == {k: ids[k].tolist() for k in asked[:3]}


def test_store_on_odd_input(spark):
    path = shared_path(spark, "store")
    idstore.write_store(awkward(spark), path, vocabulary_path(), shards=2)
    rows = sorted(idstore.read_digests(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, 1, 1, 2, 3] and rows[-1].n_tokens == 1
    assert idstore.lookup(spark, path, spark.createDataFrame([(1,)], "key long")).count() == 2
    path = shared_path(spark, "store")
    idstore.write_store(nothing(spark), path, vocabulary_path())
    assert idstore.read_digests(spark, path).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(2).integers(0, 2**63, 20_000, dtype=np.uint64))
    table = idstore.PerfectHash.build(keys)
    assert np.array_equal(np.sort(table.find(keys)), np.arange(len(keys)))
    index = idstore.Index(idstore.index_bytes(np.sort(keys.view(np.int64))))
    assert (index.find(np.arange(-5000, -1))[0] >= 0).sum() == 0


# ---------------------------------------------------------------- classifiers


@pytest.mark.parametrize("most, block_rows", [(4_096, 1_000_000), (3, 40)])
def test_shards_are_exact_and_uniform_with_few_sources_for_the_driver(spark, monkeypatch, most, block_rows):
    monkeypatch.setattr(sharding, "MOST_SOURCES", most)
    rows = spark.range(0, 1_200, 1, 17)
    seen, total = Counter(), 0
    for seed in range(6):
        out = sharding.shuffle_into_shards(rows, 5, seed=seed, block_rows=block_rows).collect()
        assert sorted(r["id"] for r in out) == list(range(1_200))
        for shard in range(5):
            assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(240))
        # Where do the first 300 ids fall?  By quarter of each shard's slots, and by shard: uniformly.
        seen.update((r["shard"], r["slot"] // 60) for r in out if r["id"] < 300)
        total += 300
    expected = total / 20
    assert sum((seen[s, q] - expected) ** 2 / expected for s in range(5) for q in range(4)) < 43.8  # 19 degrees, 0.1 %


def test_repetitive_texts_and_items_take_bounded_memory(monkeypatch):
    """Equal words on both sides give the product of their numbers in hits: they are held a slice at a time."""
    import tracemalloc

    from broadloom.llm.words import Words
    raw = ("same " * 3_000).encode()
    words = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), decontaminate.MARKS)
    block = decontaminate.Block([(7, "same " * 600), (8, "other " * 30)])
    whole = list(block.overlaps(words))
    monkeypatch.setattr(decontaminate, "SLICE_HITS", 10_000)
    tracemalloc.start()
    assert list(block.overlaps(words)) == whole == [(0, 0, 0, 0, 600, 600, 600)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16e6  # 1.8 million hits a mask would be 29 MB


def test_machine_learns_a_pair_that_no_sum_can():
    rng = np.random.default_rng(1)
    examples, labels = [], []
    for k in range(3000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        terms = set(rng.integers(10, 60, 8)) | ({1} if insult else set()) | ({2} if group else set())
        examples.append(np.array(sorted(terms)))
        labels.append(float(insult and group))
    labels = np.array(labels)
    model = toxicity.fit(examples, labels)
    slots = [model.slots[x][model.slots[x] >= 0] for x in examples]
    margin = np.array([model.bias + model.weights[s].sum() + 0.5 * ((model.factors[s].sum(0) ** 2) - (model.factors[s] ** 2).sum(0)).sum() for s in slots])
    assert ((margin > 0) == labels).mean() > 0.99
    a, b = model.slots[1], model.slots[2]
    assert model.factors[a] @ model.factors[b] > 0.5


def test_machine_learns_a_pair_whose_terms_say_nothing_alone():
    """Label 1 if both or neither of two terms occur: each term is as common in both classes."""
    rng = np.random.default_rng(0)
    examples, labels = [], []
    for _ in range(3000):
        a, b = rng.integers(0, 2, 2)
        terms = rng.choice(np.arange(100, 400), 30, replace=False).tolist() + [1] * int(a) + [2] * int(b)
        examples.append(np.array(sorted(terms)))
        labels.append(float(a == b))
    labels = np.array(labels)
    model = toxicity.fit(examples[:2000], labels[:2000])
    assert model.slots[1] >= 0 and model.slots[2] >= 0 and model.factors[model.slots[1]] @ model.factors[model.slots[2]] > 0.5
    slots = [model.slots[x][model.slots[x] >= 0] for x in examples[2000:]]
    margin = np.array([model.bias + model.weights[s].sum() + 0.5 * ((model.factors[s].sum(0) ** 2) - (model.factors[s] ** 2).sum(0)).sum() for s in slots])
    assert ((margin > 0) == labels[2000:]).mean() > 0.95


def test_score_is_the_formula_over_all_pairs():
    rng = np.random.default_rng(2)
    texts = ["", None, "one", "One one TWO", "two, three four", "five one two three"]
    slots = np.full(toxicity.BUCKETS, -1)
    buckets = {}
    for _, rows, row, bucket in toxicity._terms(pa.array(texts)):
        for k in range(rows):
            buckets[k] = bucket[row == k]
    known = np.unique(np.concatenate(list(buckets.values())))[1:]  # one term is unknown
    slots[known] = np.arange(len(known))
    model = toxicity.FactorizationMachine(-0.3, slots, rng.normal(size=len(known)), rng.normal(size=(len(known), 3)))
    for k, score in enumerate(model.scores(pa.array(texts))):
        at = [slots[b] for b in buckets[k] if slots[b] >= 0]
        margin = -0.3 + sum(model.weights[i] for i in at) + sum(
            model.factors[i] @ model.factors[j] for n, i in enumerate(at) for j in at[:n])
        assert abs(score - 1 / (1 + np.exp(-margin))) < 1e-9


def test_classifiers_on_odd_input(spark):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 1), (3, None, None), (9, 1, 1)], LABELS)
    for df in (awkward(spark), nothing(spark)):
        for out in (toxicity.score_documents(df, toxicity.train(df, labels)), quality.score_documents(df, labels)):
            rows = out.collect()
            assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
        rows = language.identify(df, language.train(df)).collect()
        assert len(rows) == df.count() and all((r.lang_pred == "und") == (r.score == 0) for r in rows)


def test_language_is_learned_and_held_out(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(5, 60), "abcdefg" if i % 3 else "efghijk"), "x" if i % 3 else "y") for i in range(400)]
    rows += [(400, "12 34 !", "x"), (401, None, "x"), (402, "é", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in language.identify(df, language.train(df)).collect()}
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in out)
    assert np.mean([out[i].lang_pred == rows[i][2] for i in range(400) if out[i].held_out]) > 0.97
    assert out[400].lang_pred == out[401].lang_pred == "und" and out[402].lang_pred in ("x", "y")


def test_rules_follow_tree_paths_and_separate_junk(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, 60) if i % 4 else " ".join(w + "$$$" for w in prose(rng, 60).split())) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(300)], LABELS)
    out = quality.score_documents(df, labels).collect()
    assert all(r.predicted == int(r.doc_id % 4 > 0) for r in out)
    text = "  Tree 0 (weight 1.0):\n    If (feature 0 <= 1.5)\n     If (feature 2 <= 0.5)\n      Predict: 0.0\n     Else (feature 2 > 0.5)\n      Predict: 1.0\n    Else (feature 0 > 1.5)\n     Predict: 1.0\n"
    a, b = quality.STATISTICS[0], quality.STATISTICS[2]
    assert set(quality.tree_paths(text)) == {((a, "<=", 1.5),), tuple(sorted([(a, "<=", 1.5), (b, "<=", 0.5)])), tuple(sorted([(a, "<=", 1.5), (b, ">", 0.5)])), ((a, ">", 1.5),)}


def test_statistics_of_known_texts():
    s = dict(zip(quality.STATISTICS, quality.statistics(pa.array(["Aa aa\naa aa!", None, ""]))[0]))
    assert (s["words"], s["distinct_words"], s["top_word"], s["distinct_lines"], s["repeat_next"]) == (4, 0.5, 0.75, 1.0, 0.5)
    assert not quality.statistics(pa.array([None, ""], pa.string())).any()


# ---------------------------------------------------------------- benchmark


def test_overlaps_with_substitutions(spark):
    rng = random.Random(9)
    items = [(k, prose(rng, rng.randint(18, 50))) for k in range(12)] + [(50, "tiny item"), (51, None), (52, "")]
    docs, expected = [], set()
    for k, (item, text) in enumerate(items[:12]):
        w = text.split(" ")
        for place in range(5, len(w), 9):
            w[place] = "swapped"
        docs.append((k, f"{prose(rng, 30)} {' '.join(w)} {prose(rng, 20)}".upper()))
        expected.add((k, item))
    docs += [(100 + k, prose(rng, 80)) for k in range(20)] + [(200, "A tiny item, here"), (201, None), (202, ""), (None, items[3][1])]
    expected |= {(200, 50), (None, 3)}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_words in (1_000_000, 60):
        found = decontaminate.overlaps(df, bench, block_words).collect()
        assert {(r.doc_id, r.item_id) for r in found} == expected
    kept = decontaminate.clean_documents(df, bench, 60)
    assert {r.doc_id for r in kept.collect()} == {*range(100, 120), 201, 202}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.overlaps(df, empty).count() == 0 and decontaminate.clean_documents(df, empty).count() == df.count()
    assert decontaminate.clean_documents(awkward(spark), bench).columns == awkward(spark).columns
    assert decontaminate.overlaps(nothing(spark), bench).count() == 0


def test_overlaps_in_pieces_and_parts_of_long_items(spark):
    rng = random.Random(24)
    pieces, long = prose(rng, 40).split(" "), prose(rng, 200).split(" ")
    spread = " ".join(" ".join(pieces[a:a + 10]) + f" more{a}" for a in range(0, 40, 10))
    docs = [(1, f"{prose(rng, 40)} {spread} {prose(rng, 30)}"), (2, f"{prose(rng, 40)} {' '.join(long[60:150])} {prose(rng, 30)}"),
            (3, f"{prose(rng, 40)} {' '.join(long[:9])} {prose(rng, 30)}"), (4, f"{prose(rng, 40)} {' '.join(pieces[:10])} {prose(rng, 30)}")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(pieces)), (2, " ".join(long))], "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.overlaps(df, bench).collect()}
    assert set(found) == {1, 2} and found[1].equal_words == 40 and found[2].n_words == 90
    assert {r.doc_id for r in decontaminate.clean_documents(df, bench).collect()} == {3, 4}


# ---------------------------------------------------------------- neighbours


def test_neighbours_recall_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(900, 16)).astype(np.float32)
    vectors[100:140] = vectors[100]
    rows = [(int(i), [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    odd = [(2000, None, 0), (2020, [0.0] * 16, 0), (2040, [float("nan")] * 16, 0), (2060, [float("inf")] + [1.0] * 15, 0),
           (2080, [None] + [1.0] * 15, 0), (None, [1.0] * 16, 0), (2100, [1.0] * 3, 0)]
    df = spark.createDataFrame(rows + odd + rows[:3], "vec_id long, embedding array<float>, score int").repartition(4)
    out = neighbours.nearest(df, F.pmod("vec_id", F.lit(20)) == 0, top=20).collect()
    exact = vectors.astype(float) @ vectors.astype(float).T
    hit = total = 0
    for q in range(0, 900, 20):
        mine = sorted((r for r in out if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 21))
        assert all(abs(r.score - exact[q, r.vec_id]) < 1e-9 for r in mine)
        assert [(r.vec_id) for r in mine] == [r.vec_id for r in sorted(mine, key=lambda r: (-r.score, r.vec_id))]
        best = sorted((-exact[q, k], k) for k in range(900) if k != q)[:20]
        hit += len({r.vec_id for r in mine} & {k for _, k in best})
        total += 20
    assert {r.query_id for r in out} == set(range(0, 900, 20)) and hit / total > 0.9
    few = neighbours.nearest(spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>, score int"), F.col("vec_id") == 0)
    assert few.count() == 2
    assert neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


# ---------------------------------------------------------------- shards


def test_shards_are_exact_and_repeatable(spark, docs):
    df, texts = docs
    rows = sharding.document_sizes(df)
    out = sharding.shuffle_into_shards(rows, 24, block_rows=4).collect()
    sizes = Counter(r.shard for r in out)
    assert len(out) == len(texts) and set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in sizes:
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sizes[shard]))
    assert all(r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in out)
    odd = sharding.shuffle_into_shards(awkward(spark), 4)
    assert odd.count() == 6 and sorted(odd.columns) == sorted({*awkward(spark).columns, "slot"})
    assert sharding.shuffle_into_shards(nothing(spark), 4).count() == 0


def test_matrix_has_exact_margins_and_hypergeometric_means():
    rng = random.Random(2)
    draws = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert abs(np.mean(draws) - 6) < 0.12 and abs(np.var(draws) - 20 * 0.3 * 0.7 * 80 / 99) < 0.3
    big = sharding.hypergeometric(rng, 10**10, 23 * 10**10, 10**6)
    assert abs(big - 10**6 / 24) < 1500
    counts = {0: 100, 1: 7, 2: 0, 5: 43}
    matrix = sharding.communication_matrix(counts, [38, 38, 37, 37], 1)
    assert {k: sum(v) for k, v in matrix.items()} == counts
    assert [sum(v[s] for v in matrix.values()) for s in range(4)] == [38, 38, 37, 37]
