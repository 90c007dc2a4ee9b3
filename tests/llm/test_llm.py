"""The operators of ``llm`` on small tables, against brute force, round trips and held-out rows."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from brightmere.llm import common, epsilon_grid, lang_id, lm_scoring, minhash, mixing, packing, pii, quality, queries
from brightmere.llm import topk_blocks, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, place string, __p string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and long texts, repeated rows, columns with clashing names."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    rows = [
        (1, "the cat sat on the mat and slept well", "en", "a", 37, "p", "q"),
        (1, "the cat sat on the mat and slept well", "en", "a", 37, "p", "q"),
        (2, None, None, None, None, None, None), (3, "", "en", "b", 0, None, None), (4, " \n\t ", "fr", "b", 4, "", ""),
        (5, long, "de", "a", len(long), "p", "q"), (6, long + " end", "de", None, len(long) + 4, "p", "q"),
        (None, "le chat est sur la table", "fr", "c", 24, "p", "q"), (7, "12 34   56", None, "c", 9, "p", "q"),
        (8, "\U00010400\U00010401", "xx", "c", 2, "p", "q"),
    ]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 99), (99, 98), (5, 5)]
    found = dict(map(tuple, common.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert found == {i: 0 for i in range(41)} | {98: 98, 99: 98, 100: 98}
    assert common.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_components_of_few_and_of_many_links(spark, monkeypatch):
    rng = np.random.default_rng(4)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 300, (220, 2))] * 2
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, i) for i in range(2001, 2100)] + [(-5, -4), (None, 3)]
    near = {x: {x} for e in edges if e[0] is not None and e[0] != e[1] for x in e}
    for a, b in edges:
        if a is not None and a != b and near[a] is not near[b]:
            near[a] |= near[b]
            near |= dict.fromkeys(near[b], near[a])
    links = common.staged(spark.createDataFrame(edges, "a bigint, b bigint"), "links")
    context = spark.sparkContext
    took = []
    for few in (common.FEW_EDGES, 0, 100):
        monkeypatch.setattr(common, "FEW_EDGES", few)
        context.setJobGroup(f"components {few}", "")
        rows = common.components(links).collect()
        context.setLocalProperty("spark.jobGroup.id", None)
        took.append(len(context.statusTracker().getJobIdsForGroup(f"components {few}")))
        assert len(rows) == len(near) and dict(map(tuple, rows)) == {x: min(all) for x, all in near.items()}
    assert took[0] <= 5 < took[1]  # few links cost no rounds of shuffles


# 1


def bag(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def overlap(a, b):
    return sum((a & b).values()) / sum((a | b).values()) if a and b else 0.0


def test_signatures_are_unbiased():
    """The share of equal slots is the weighted Jaccard similarity."""
    rng = np.random.default_rng(3)
    shares, wanted = [], []
    for _ in range(150):
        ids = rng.integers(0, 2**63, 60).astype(np.uint64)
        a, b = rng.integers(0, 9, 60), rng.integers(0, 9, 60)
        wanted.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        x, y = minhash.signatures([(ids[a > 0], a[a > 0]), (ids[b > 0], b[b > 0])])
        shares.append((x == y).mean())
    assert abs(np.mean(shares) - np.mean(wanted)) < 0.015


def test_near_duplicates_match_all_pairs(spark):
    random.seed(2)
    word = lambda: random.choice("abcdefgh") + random.choice("klmnop") * random.randint(1, 40)
    texts, rows = [[word() for _ in range(random.randint(1, 120))] for _ in range(25)], []
    for i in range(160):
        text = list(random.choice(texts))
        for _ in range(random.choice([0, 0, 1, 2, 4])):
            text[random.randrange(len(text))] = word()
        rows.append((i * 3, " ".join(text)))
    check_near_duplicates(spark, rows)


def test_near_duplicates_in_whole_buckets(spark, monkeypatch):
    """Documents of one origin, hardly alike enough, of which some have near copies: pivots link
    few of them, so buckets are compared whole, in several parts."""
    monkeypatch.setattr(minhash, "PART_DOCS", 16)
    monkeypatch.setattr(minhash, "PART_WEIGHT", 3000)
    called, whole = [], minhash.remaining
    monkeypatch.setattr(minhash, "remaining", lambda *a: called.append(1) or whole(*a))
    random.seed(3)
    origin, rows = [f"w{random.randrange(10**6)}" for _ in range(200)], []
    for i in range(90):
        text = list(origin)
        for at in random.sample(range(0, 200, 5), 4):
            text[at] = f"x{random.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    for i in range(90, 120):
        text = random.choice(rows)[1].split()
        text[random.randrange(200)] = f"y{i}"
        rows.append((i, " ".join(text)))
    check_near_duplicates(spark, rows)
    assert called


def check_near_duplicates(spark, rows):
    got = {r["doc_id"]: r for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    bags, root = {i: bag(t) for i, t in rows}, {i: i for i, _ in rows}
    for _ in rows:
        for a in bags:
            for b in bags:
                if root[a] != root[b] and overlap(bags[a], bags[b]) >= 0.8:
                    old, new = max(root[a], root[b]), min(root[a], root[b])
                    root = {k: new if v == old else v for k, v in root.items()}
        break
    assert {i: r["component_id"] for i, r in got.items()} == root
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_near_duplicates_of_odd_rows(spark, odd):
    got = [tuple(r) for r in minhash.near_duplicates(odd).collect()]
    assert len(got) == 10
    assert {(i, c, k) for i, _, c, k in got} == {
        (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 5, True), (6, 5, False), (None, None, True),
        (7, 7, True), (8, 8, True),
    }
    kept = minhash.deduplicate(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8]
    assert minhash.near_duplicates(empty(spark)).collect() == []


# 2


def top(rows, every, k):
    out = set()
    for q, x in rows:
        if q % every == 0:
            found = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q)[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(found)}
    return out


def test_topk_matches_all_scores(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-3, 4, 6).tolist()) for i in range(700)] + [(900 + i, [2, 0, 0, 0, 0, 1]) for i in range(300)]
    found = topk_blocks.search(spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>"), 7, 5)
    assert {tuple(r) for r in found.collect()} == top(rows, 7, 5)


def test_topk_of_odd_vectors(spark):
    rows = [(0, [0.5, -0.001]), (0, [0.5, -0.001]), (10, [1.0, None]), (20, None), (30, [float("nan"), 1.0]), (3, [1e9, 0.0]),
            (4, [1e9, 0.0]), (5, []), (None, [1.0, 1.0])]
    vectors = topk_blocks.quantised(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    assert {tuple(r) for r in topk_blocks.search(vectors, 10, 2).collect()} == {
        (0, 1, 3, 128 * 256 * 10**9), (0, 2, 4, 128 * 256 * 10**9)}
    none = spark.createDataFrame([], "vec_id bigint, vector array<bigint>")
    assert topk_blocks.search(none, 10, 2).collect() == []


def test_topk_sends_queries_once_and_never_pairs_them_with_groups(spark, monkeypatch):
    # many groups and several runs of queries; before, every batch of queries was joined with every group
    monkeypatch.setattr(topk_blocks, "GROUP", 1)
    monkeypatch.setattr(topk_blocks, "SENT", 500)
    monkeypatch.setattr(topk_blocks, "FIRST", (4, 2))
    monkeypatch.setattr(topk_blocks, "LEAST", 2)
    rng = np.random.default_rng(11)
    rows = [(i, rng.integers(-40, 41, 5).tolist()) for i in range(2500)]
    frame = spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>")
    found = topk_blocks.search(frame, 50, 5)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in found.collect()} == top(rows, 50, 5)


def test_topk_of_ids_with_several_vectors(spark):
    # rows of one id and one score are one row of the result, and the next best one follows
    rows = [(0, [1, 0]), (0, [2, 0]), (1, [9, 1]), (1, [9, 2]), (1, [9, 3]), (2, [8, 0]), (3, [1, 0]), (3, [2**40, -1])]
    found = topk_blocks.search(spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>"), 10, 3)
    assert {tuple(r) for r in found.collect()} == {(0, 1, 3, 2**41), (0, 2, 3, 2**40), (0, 3, 1, 18)}
    rows = [r for r in rows if r != (0, [2, 0]) and r != (3, [2**40, -1])]
    found = topk_blocks.search(spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>"), 10, 3)
    assert {tuple(r) for r in found.collect()} == {(0, 1, 1, 9), (0, 2, 2, 8), (0, 3, 3, 1)}


# 3


def test_epsilon_grid_matches_all_pairs(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(60, 20))
    rows = [(i * 2, (base[rng.integers(60)] + rng.normal(size=20) * rng.choice([0, 0.1, 0.25])).tolist()) for i in range(900)]
    rows += [(5000, None), (5001, [0.0] * 20), (5002, [None] + [1.0] * 19), (5003, [float("inf")] * 20), (5004, [])]
    found = {r["vec_id"]: r for r in epsilon_grid.near_duplicates(
        spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    x = np.array([v for _, v in rows[:900]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    label = np.arange(900)
    for _ in range(900):
        label = np.minimum(label, np.where(near, label[None], 10**6).min(1))
    assert [found[i * 2]["n_links"] for i in range(900)] == near.sum(1).tolist()
    assert [found[i * 2]["component_id"] for i in range(900)] == (label * 2).tolist()
    assert all((found[i]["n_links"], found[i]["component_id"]) == (0, i) for i in range(5000, 5005))


def test_epsilon_grid_of_nothing(spark):
    kind = "vec_id bigint, embedding array<double>"
    assert epsilon_grid.near_duplicates(spark.createDataFrame([], kind)).collect() == []
    twice = epsilon_grid.near_duplicates(spark.createDataFrame([(1, [1.0]), (1, [1.0]), (2, [1.0, 0.0])], kind)).collect()
    assert sorted(r["n_links"] for r in twice) == [0, 1, 1]


def test_epsilon_grid_compares_blocks_where_they_are(spark, monkeypatch):
    # several stripes, floats, vectors of two lengths, a large group of near copies, copies and
    # zeros of either sign; before, the blocks of every pair of intervals were joined and shuffled
    monkeypatch.setattr(epsilon_grid, "BLOCK", 16)
    monkeypatch.setattr(epsilon_grid, "SENT", 16 * 8 * 30 * 4 * 2)
    monkeypatch.setattr(epsilon_grid, "EDGES", 50)
    shuffled = []
    seen = spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda x: shuffled.append(len(x[1])) or seen(x))
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 30))
    made = [base[rng.integers(40)] + rng.normal(size=30) * rng.choice([0.1, 0.25, 1]) for _ in range(800)]
    made += [base[0] + rng.normal(size=30) * 0.02 for _ in range(500)]
    made += [rng.normal(size=5) for _ in range(300)] + [np.r_[1, np.zeros(4)], np.r_[1, -np.zeros(4)]]
    rows = [(int(i), np.float32(x).tolist()) for i, x in zip(rng.permutation(len(made)), made)]
    frame = spark.createDataFrame(rows + [(9000, rows[0][1]), (9001, rows[1500][1])], "vec_id bigint, embedding array<float>")
    found = {r["vec_id"]: r for r in epsilon_grid.near_duplicates(frame).collect()}
    assert len(shuffled) > 3 and max(shuffled) <= 8 * 2
    links, label = {}, {}
    for size in (30, 5):
        own = [r for r in rows + [(9000, rows[0][1]), (9001, rows[1500][1])] if len(r[1]) == size]
        ids, x = np.array([i for i, _ in own]), np.array([v for _, v in own])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= 0.95
        least = ids.copy()
        for _ in range(len(ids)):
            new = np.where(near, least[None], 10**6).min(1)
            if (new == least).all():
                break
            least = new
        links |= dict(zip(ids.tolist(), (near.sum(1) - 1).tolist()))
        label |= dict(zip(ids.tolist(), least.tolist()))
    assert {i: r["n_links"] for i, r in found.items()} == links
    assert {i: r["component_id"] for i, r in found.items()} == label


def test_epsilon_grid_least_places():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 400, (2, 300))
    label = np.arange(400)
    for _ in range(400):
        for x, y in zip(a, b):
            label[x] = label[y] = min(label[x], label[y])
    assert epsilon_grid.least(400, a, b).tolist() == label.tolist()
    flat = rng.random(1003) < 0.05
    assert epsilon_grid.places(flat).tolist() == np.flatnonzero(flat).tolist()


# 4


def test_mixing_meets_targets(spark, docs):
    labelled = mixing.by_labels(spark.read.parquet(f"{SF}/labels.parquet"))
    found = mixing.rates(docs, labelled, {"clean": 0.7, "poor": 0.2, "toxic": 0.1}).toPandas()
    tokens = found["n_tokens"] * found["rate"]
    assert (found["rate"] >= 0).all() and len(found) == docs.count()
    for domain, share in (("clean", 0.7), ("poor", 0.2), ("toxic", 0.1)):
        assert abs((tokens * found[f"p_{domain}"]).sum() / found["n_tokens"].sum() - share) < 1e-3
    assert np.allclose(found[["p_clean", "p_poor", "p_toxic"]].sum(axis=1), 1)


def test_mixing_counts_labels_of_its_own_documents(spark, docs):
    """Labels of documents that earlier stages dropped change nothing, even if one domain lost most."""
    labelled = mixing.by_labels(spark.read.parquet(f"{SF}/labels.parquet")).cache()
    left = docs.join(labelled.where("domain = 'clean' AND pmod(doc_id, 4) > 0"), "doc_id", "left_anti")
    targets = {"clean": 0.7, "poor": 0.2, "toxic": 0.1}
    model, _ = mixing.fit(left, labelled, targets)
    same, _ = mixing.fit(left, labelled.join(left, "doc_id", "left_semi"), targets)
    assert np.allclose(model.table, same.table) and np.allclose(model.priors, same.priors)


def test_pipeline_mixture_keeps_clean_documents(spark, docs):
    """No document that is labelled clean, or unlabelled and likeliest clean, goes; rates solve the
    least squares with these floors, and toxic documents are thinned out."""
    import corpus_pipeline

    labelled = mixing.by_labels(spark.read.parquet(f"{SF}/labels.parquet"))
    label = {r["doc_id"]: r["domain"] for r in labelled.collect()}
    targets = {"clean": 0.9, "poor": 0.08, "toxic": 0.02}
    model, rows = mixing.fit(docs, labelled, targets, "clean", 1.1)
    found = rows.withColumn("rate", model.rate()).toPandas()
    p, n = np.stack(found["__p"]), found["__tokens"].to_numpy()
    clean = [label[i] == "clean" if i in label else x.argmax() == 0 for i, x in zip(found["doc_id"], p)]
    assert np.array_equal(found["__floor"], np.array(clean, float)) and (found["rate"] >= found["__floor"]).all()
    copies = Counter(r["doc_id"] for r in corpus_pipeline.mixture(spark, docs, SF).select("doc_id").collect())
    assert all(copies[i] >= 1 for i, x in zip(found["doc_id"], clean) if x)
    assert all(abs(copies[i] - r) < 1 for i, r in zip(found["doc_id"], found["rate"]))
    # the optimum: no rate moves without a loss
    total = 1.1 * (n @ p)[0] / 0.9
    miss = (n * found["rate"].to_numpy()) @ p - total * np.array([0.9, 0.08, 0.02])
    best = np.maximum(found["__floor"], 1 - p @ (miss / (mixing.SOFT * total)))
    assert np.allclose(best, found["rate"], atol=0.01)
    toxic = [r for i, r in zip(found["doc_id"], found["rate"]) if label.get(i) == "toxic"]
    assert sum(toxic) < 0.7 * len(toxic)


def test_mixing_is_native_and_takes_odd_rows(spark, odd):
    labelled = spark.createDataFrame([(1, "x"), (5, "y"), (None, "x")], "doc_id bigint, domain string")
    found = mixing.mix(odd, labelled, {"x": 1, "y": 1})
    assert found.columns == odd.columns
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in found._jdf.queryExecution().executedPlan().toString()
    found.collect()
    assert mixing.rates(empty(spark), labelled, {"x": 1, "y": 1}).collect() == []


# 5


def plain(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), ""]


def test_lm_base_scores(spark, odd, monkeypatch):
    monkeypatch.setattr(lm_scoring, "HEAD", 6)  # so that rare words are joined
    found = {r["doc_id"]: r for r in lm_scoring.score_held_out(odd).collect()}
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    rows = [(r["doc_id"], plain(r["text"])) for r in odd.collect()]
    counts = Counter(w for i, x in rows if not held(i) for w in x)
    whole = sum(counts.values())
    for i, x in rows:
        r = found[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held(i), len(x), sum(w in counts for w in x), whole)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (whole + len(counts) + 1)) for w in x))
    assert lm_scoring.score_held_out(empty(spark)).collect() == []


def test_lm_beats_unigrams_and_adds_up(spark, docs):
    found = lm_scoring.score_held_out(docs).toPandas()
    for _, part in found.groupby("held_out"):
        assert part["score"].sum() > part["base_score"].sum()
    words = lm_scoring.vocabulary(lm_scoring.counted(docs.select("text")))
    model = lm_scoring.Model(np.zeros(lm_scoring.OUTCOMES), np.random.default_rng(1).normal(
        size=(lm_scoring.Model.ROWS, lm_scoring.SIZE)).astype(np.float32))
    every = (7 * (lm_scoring.START + 1) + 9) * lm_scoring.OUTCOMES + np.arange(lm_scoring.OUTCOMES)
    assert (10.0 ** model.logs(every)).sum() == pytest.approx(1, abs=1e-4)
    assert words.total == sum(len(plain(r["text"])) for r in docs.select("text").collect())


def test_lm_descent_by_hand(monkeypatch):
    monkeypatch.setattr(lm_scoring, "BATCH", 500)
    rng = np.random.default_rng(5)
    sizes = lm_scoring.Sizes(2, 4)  # the third level has nodes of two places
    bias = rng.normal(size=sizes.outcomes)
    bias[::7] = -40  # logits far from 0
    model = lm_scoring.Model(bias, rng.normal(size=(sizes.rows, lm_scoring.SIZE)).astype(np.float32), sizes)
    model.bias[0] += 200
    words = np.minimum(rng.zipf(1.3, (1200, 3)), sizes.contexts - 1)  # some rows many times, most once
    triple = np.unique((words[:, 0] * sizes.contexts + words[:, 1]) * sizes.outcomes + words[:, 2] % sizes.outcomes)
    times = rng.integers(1, 9, len(triple))
    weights, squares, touched = (np.zeros(x) for x in ((sizes.rows, lm_scoring.SIZE), sizes.rows, sizes.rows))
    weights += model.weights
    order = np.random.default_rng(len(triple)).permutation(len(triple))
    for low in range(0, len(triple), 500):
        some, steps = order[low : low + 500], []
        for bias, (node, place, rows) in zip(model.bias, model.rows(triple[some])):
            width = bias.shape[1]
            logit = bias[node].astype(float) + sum(weights[x, :width] for x in rows)
            gap = np.exp(logit - logit.max(1, keepdims=True))
            gap /= gap.sum(1, keepdims=True)
            gap[np.arange(len(some)), place] -= 1
            steps.append((rows, gap * times[some][:, None]))
        for rows, gap in steps:
            for x in rows:
                slope = np.zeros_like(weights)
                np.add.at(slope[:, : gap.shape[1]], x, gap)
                np.add.at(touched, x, times[some])
                squares += (slope * slope).mean(1)
                weights -= 0.5 / np.sqrt(squares + 1)[:, None] * slope
    found = [np.zeros(sizes.rows, np.float32) for _ in range(2)]
    model.learn(triple, times, *found)
    assert np.allclose(model.weights, weights, atol=1e-4) and np.allclose(found[0], squares, rtol=1e-3, atol=1e-4)
    assert np.array_equal(found[1], touched)
    assert [x.shape[1] for x in model.bias] == sizes.widths  # no work on places that no node has


def test_lm_words_are_looked_up_once(monkeypatch):
    """Each distinct word of a run of texts is coded once, whatever its number of places."""
    sizes, hashes, seen = lm_scoring.Sizes(1, 4), lm_scoring.Sizes.hashes, []
    monkeypatch.setattr(lm_scoring.Sizes, "hashes", lambda self, x: seen.extend(x) or hashes(self, x))
    words = [*(b"w%d" % i for i in range(sizes.words)), b"dog", "\u00e9".encode()]  # the last two are no outcomes
    table = {w.decode(): i for i, w in enumerate(words)}
    counts = np.arange(len(words), 0, -1) + 5
    code = lm_scoring.coder(lm_scoring.Vocabulary(words, counts, 3, 0, 0, np.zeros(64), np.zeros(64), sizes))
    seen.clear()
    texts = ["", " \n", "W1 zzz Dog w0", " ZZZ zzz\x0byyy\x0c\x1c\t", "\u00c9 \u00e9 yyy\x85 yyy " * 50, "\x00 dog"]
    made = list(zip(*(x.to_pylist() for x in code(pa.array(["x", *texts, "x"]).slice(1, len(texts))))))
    assert sorted(seen) == sorted({w.encode() for x in texts for w in plain(x)[:-1] if w not in table})
    for text, (n, known, logs, tails, contexts, rare, times) in zip(texts, made, strict=True):
        found = plain(text)[:-1]
        log = [math.log10(counts[table[w]] + 1) for w in found if w in table]
        assert (n, known) == (len(found) + 1, len(log) + 1) and logs == pytest.approx(sum(log) + math.log10(4))
        assert tails == pytest.approx(sum(math.log10(counts[table[w]] + 1) for w in found if w in ("dog", "\u00e9")))
        codes = [table[w] + 1 if table.get(w, sizes.words) < sizes.words else sizes.context(w.encode()) for w in found]
        assert np.frombuffer(contexts, np.uint32).tolist() == [*codes, 0]
        assert dict(zip(rare, times)) == Counter(w.encode() for w in found if w not in table)


def test_lm_runs_of_rows():
    rng = np.random.default_rng(3)
    for low, high in ((0, 9), (0, 100), (7, 1 << 17), (1 << 40, (1 << 40) + 9), (0, 1 << 40)):
        rows = rng.integers(low, high, 3000)
        rows[::3] = rows[0]
        order, row, start = lm_scoring.runs(rows)
        assert np.array_equal(order, np.argsort(rows, kind="stable")) and np.array_equal(row, np.unique(rows))
        values = rng.integers(0, 99, (3000, 8)).astype(np.float32)
        found, by = lm_scoring.sums(values, order, start)
        for i in range(8):
            assert np.array_equal(found[:, i], np.bincount(np.unique(rows, return_inverse=True)[1], values[:, i])[by])


def test_lm_tables_grow_with_the_tokens(spark, docs, monkeypatch):
    rng = np.random.default_rng(2)
    for leaves in (2, 32, 64):  # three levels, a full third one, four levels
        sizes = lm_scoring.Sizes(leaves, 4)
        model = lm_scoring.Model(rng.normal(size=sizes.outcomes), rng.normal(size=(sizes.rows, lm_scoring.SIZE)).astype(np.float32), sizes)
        every = (sizes.contexts * (sizes.contexts - 1) + 5) * sizes.outcomes + np.arange(sizes.outcomes)
        assert (10.0 ** model.logs(every)).sum() == pytest.approx(1, abs=1e-4)
        assert all(rows.max() < sizes.rows for _, _, rows in model.rows(every))
    small, large = lm_scoring.Sizes.of(10**6), lm_scoring.Sizes.of(10**10)
    assert large.outcomes == 16 * small.outcomes and large.rows > 15 * small.rows
    # words of one bucket are contexts of their own
    one, two = (small.context(x) for x in (b"nearing", b"thing"))
    assert one != two and small.outcome(np.array([one]))[0] == small.outcome(np.array([two]))[0]
    model = lm_scoring.Model(np.zeros(small.outcomes), rng.normal(size=(small.rows, lm_scoring.SIZE)).astype(np.float32), small)
    after = [model.logs((7 * small.contexts + x) * small.outcomes + np.arange(9)) for x in (one, two)]
    assert not np.allclose(*after)
    monkeypatch.setattr(lm_scoring, "ROOT_TOKENS", 2000)
    words = lm_scoring.vocabulary(lm_scoring.counted(docs.select("text")))
    assert words.sizes.leaves > 1 and len(words.contexts()) == len(words.words) > 959
    assert words.tail_n.sum() + words.counts[: words.sizes.words].sum() + words.ends == words.total
    found = lm_scoring.score_held_out(docs).toPandas()
    for _, part in found.groupby("held_out"):
        assert part["score"].sum() > part["base_score"].sum()


# 6

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) < 256 for x in m[0].split("."))
                    or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


def test_strict_spans_match_the_patterns():
    random.seed(4)
    for alphabet in ("ab1.@+-() 2%3_,4", "12.@+- 3", "1 -", "a@.b"):
        for _ in range(4000):
            text = "".join(random.choice(alphabet) for _ in range(random.randint(0, 50)))
            assert pii.joined([x[:3] for x in pii.strict(text) if x[3]]) == pii.joined(spans(text)), text


def test_strict_spans_are_linear():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "a@" * 100_000, "+1 " * 60_000, "1 " * 100_000):
        pii.candidates(text)


def test_pii_of_documents(spark, docs, odd):
    model = pii.fit(docs)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in pii.find(docs, model).collect():
        base = spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(pii.joined(base).split(",")) <= set(r["spans"].split(","))
    assert pii.mask(odd, model).columns == odd.columns
    assert pii.find(odd, pii.fit(odd)).count() == 10
    assert pii.find(empty(spark), pii.fit(empty(spark))).collect() == []
    assert pii.masked("mail a@b.co now", [("email", 5, 11)]) == "mail <EMAIL> now"


def test_pii_adds_what_a_strict_pattern_misses(docs):
    text = "call +1 (826) 555-4081 190.137.2.9 or 8"
    base, every = pii.fit(docs).spans(text)
    assert ("phone", 5, 22) in every and ("phone", 5, 22) not in base


# 7, 8


def test_languages_held_out(docs):
    found = lang_id.predict_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = found[found["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.95
    assert found["score"].between(0, 1).all()


def test_languages_of_odd_rows(spark, odd):
    found = lang_id.predict_held_out(odd).collect()
    assert len(found) == 10
    by = {r["doc_id"]: r["lang_pred"] for r in found}
    assert by[2] == by[3] == by[4] == by[7] == "und" and by[8] != "und"
    assert lang_id.predict_held_out(empty(spark)).collect() == []
    kept = lang_id.reject(odd, lang_id.fit(odd))
    assert kept.columns == odd.columns and {2, 3, 4, 7}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_string_kernel_is_a_count_of_common_grams():
    a, b = lang_id.slots("Das Haus"), lang_id.slots("das, haus")
    assert (a == b).all() and len(lang_id.slots("12 !")) == 0
    marks = lang_id.Landmarks.of([a, lang_id.slots("xyz")])
    assert marks.kernel([b])[0, 0] == pytest.approx(1) and marks.kernel([b])[0, 1] < 0.4


def test_quality_held_out(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.score_held_out(docs, labels).join(labels, "doc_id").toPandas()
    held = found[found["held_out"]]
    rank = held["score"].rank()
    good, bad = (held["quality"] == 1).sum(), (held["quality"] == 0).sum()
    assert (rank[held["quality"] == 1].sum() - good * (good + 1) / 2) / (good * bad) > 0.9


def test_quality_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (5, 0), (None, 1), (99, 0)], "doc_id bigint, quality int")
    found = quality.score_held_out(odd, labels).collect()
    assert len(found) == 10 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    unlabelled = quality.score_held_out(odd, labels.limit(0)).collect()
    assert len(unlabelled) == 10 and all(abs(r["score"] - 0.5) < 0.01 for r in unlabelled)
    assert quality.score_held_out(empty(spark), labels).collect() == []


# 9


def test_packing_round_trip(spark, docs, odd):
    from tokenizers import Tokenizer

    path = queries.tokenizer()
    encode = Tokenizer.from_file(path)
    for frame in (docs, odd.where("doc_id IS NULL OR doc_id > 1")):
        pieces = packing.pack(frame, path).toPandas()
        texts = {-1 if r["doc_id"] is None else r["doc_id"]: r["text"] or "" for r in frame.collect()}
        pieces["doc_id"] = pieces["doc_id"].fillna(-1)
        for i, part in pieces.sort_values("start").groupby("doc_id"):
            ids = np.array([*encode.encode(texts[i], add_special_tokens=False).ids, 1], "<u4")
            assert b"".join(part["ids"]) == ids.tobytes() and (part["doc_tokens"] == len(ids)).all()
        assert set(pieces["doc_id"]) == set(texts)
        length = pieces.groupby("sequence_id")["length"].sum()
        assert (length.iloc[:-1] == 2048).all() and list(length.index) == list(range(len(length)))
        pieces = pieces.sort_values(["sequence_id", "offset"])
        assert (pieces.groupby("sequence_id")["length"].cumsum() - pieces["length"] == pieces["offset"]).all()
    assert packing.pack(empty(spark), path).collect() == []


def test_packing_keeps_the_mixture(docs):
    targets = {"src0": 0.5, "src1": 0.25}
    pieces = packing.pack(docs, queries.tokenizer(), targets=targets).toPandas()
    early = pieces[pieces["sequence_id"] < 2].groupby(["sequence_id", "source"])["length"].sum()
    assert abs(early[0, "src0"] - 1024) <= 20 and abs(early[0, "src1"] - 512) <= 20  # a token for each source


def test_encoder_takes_any_white_space():
    from tokenizers import Tokenizer

    random.seed(6)
    path = queries.tokenizer()
    encode, mine = Tokenizer.from_file(path), packing.Encoder(path)
    for _ in range(1500):
        text = "".join(random.choice(["a", "é", "'s", " ", "  ", "\n", "\t", " ", "\x1c", "1", ".", "the", "\r\n"]) for _ in range(12))
        assert np.frombuffer(mine.ids(text), np.uint16).tolist() == encode.encode(text, add_special_tokens=False).ids


def test_encoder_takes_added_tokens(tmp_path):
    import json

    from tokenizers import Tokenizer

    random.seed(8)
    path = queries.tokenizer()
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    one = model["added_tokens"][0]
    # a second file: tokens that begin alike, and one with white space
    made = [dict(one, id=one["id"] + 1 + i, content=x) for i, x in enumerate(["<|end", "<|endoftext|><|x|>", "a  b"])]
    other = tmp_path / "more.json"
    other.write_text(json.dumps(model | {"added_tokens": [one, *made]}), encoding="utf-8")
    for file in (path, str(other)):
        encode, mine = Tokenizer.from_file(file), packing.Encoder(file)
        texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>\n x"]
        parts = ["<|endoftext|>", "<|end", "oftext|>", "<|x|>", " ", "\n", "a", "  b", "é"]
        texts += ["".join(random.choices(parts, k=9)) for _ in range(400)]
        for text in texts:
            assert np.frombuffer(mine.ids(text), np.uint16).tolist() == encode.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.Encoder(path).ids("a <|endoftext|> b"), np.uint16).tolist() == [64, 220, one["id"], 275]
    strict = tmp_path / "strict.json"
    strict.write_text(json.dumps(model | {"added_tokens": [dict(one, rstrip=True)]}), encoding="utf-8")
    with pytest.raises(ValueError):
        packing.Encoder(str(strict))


# 10


def test_warc_round_trip(spark):
    rows = [(5, "http://a/%\r\nx: y", "é" * 80), (3, None, "é" * 80), (9, "u", "é" * 80), (4, "u", "short"), (6, "u", "short"),
            (7, "u", None), (None, "u", "é" * 80), (8, "u", "x" * 3_000_000), (3, None, "é" * 80)]
    path = warc.write(spark.createDataFrame(rows, "page_id bigint, url string, html string"), frame=1000, bundle=2000)
    back = warc.read(spark, path)
    found = sorted((tuple(r) for r in warc.records(back).collect()), key=str)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    e = ("é" * 80).encode()
    want = [(3, 160, hashlib.sha256(e).hexdigest(), "response", None)] * 2
    want += [(i, 160, hashlib.sha256(e).hexdigest(), "revisit", 3) for i in (5, 9, None)]
    want += [(4, 5, digest("short"), "response", None), (6, 5, digest("short"), "response", None),
             (7, 0, digest(""), "response", None), (8, 3_000_000, digest("x" * 3_000_000), "response", None)]
    assert found == sorted(want, key=str)
    one = back.where("page_id = 5").first()
    assert one["url"] == rows[0][1]
    assert warc.fetch(spark, one["file"], one["frame"], one["position"], one["size"]).startswith(b"WARC/1.1\r\nWARC-Type: revisit")
    # any Zstandard reader can read a bundle from its start
    bundle = bytes(spark.read.format("binaryFile").load(path).first()["content"])
    assert struct.unpack("<I", bundle[-4:])[0] == 0x8F92EAB1
    assert zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(bundle).startswith(b"WARC/1.1")
    none = warc.write(spark.createDataFrame([], "page_id bigint, url string, html string"))
    assert warc.records(warc.read(spark, none)).collect() == []


def test_warc_bundles_match_their_sql(spark, tmp_path):
    from tests import oracle

    name = "op10_warc_bundles"
    con = oracle.connect(SF)
    assert oracle.differences(spark, con, name, queries.QUERIES[name], queries.SQL[name], SF) == []
    # and with equal payloads around the least size of a revisit, in bytes
    rows = [(4, "a", "é" * 50), (2, "b", "é" * 50), (None, "c", "é" * 50), (7, "d", "x" * 99), (8, "d", "x" * 99), (9, None, None)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert oracle.differences(spark, con, name, queries.QUERIES[name], queries.SQL[name], str(tmp_path)) == []


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = common.staged(stage(spark, kept, SF), "stage")
        assert kept.columns == docs.columns and kept.count() > 0
    assert kept.count() <= docs.count()
    pieces = corpus_pipeline.run(spark, SF).toPandas()
    assert (pieces.groupby("sequence_id")["length"].sum().iloc[:-1] == 2048).all()
