"""Ranked lexical search by an automaton, against a plain count of every text."""

import math
import random
import re
from collections import Counter

from brightmere.llm import lexical_scan

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, length string, terms string"
ITEMS = "item_id bigint, text string, block string"


def terms(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(small)


def ranked(docs, items, k=20):
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t, *_ in docs if terms(t)]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    texts = {}
    for i, t, *_ in items:
        if i is not None and t is not None:
            texts[i] = min(t, texts.get(i, t))
    rows = []
    for i, text in texts.items():
        scores = []
        for d, count, length in held:
            m = 75 + 25 * length * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * count[t] // (1000 * count[t] + 12 * m))
                for t in terms(text)
                if count[t]
            )
            if score > 0 and d is not None:
                scores.append((-score, d))
        rows += [(i, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(rows)


def found(spark, docs, items, **more):
    result = lexical_scan.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **more)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, result.collect()))


def odd():
    random.seed(5)
    words = ["the", "The", "THE", "a", "été", "Été", "naïve", "x1", "42", "漢字", "\U00010400", "ab", "abc", "b", "ß"]
    gaps = [" ", ", ", "-", "\n\t", "_", "\x00", "\x7f", "  "]
    made = lambda n: "".join(random.choice(words) + random.choice(gaps) for _ in range(n))
    docs = [(i, made(random.randint(1, 60)), "x", "y") for i in range(120)]
    docs += docs[:3] + [(900, None, None, None), (901, "", "", ""), (902, " ,. \n", "", ""), (None, "the abc x1", "", "")]
    docs += [(903, made(30_000), "", ""), (904, "the", "", ""), (905, "the", "", "")]
    items = [(i, made(random.randint(1, 12)), "z") for i in range(30)]
    items += [(30, None, None), (31, "", ""), (32, "unseen zebra", ""), (None, "the", ""), (33, "b b b THE", ""), (33, "zzz", "")]
    return docs, items


def test_every_rank_and_score(spark):
    docs, items = odd()
    assert found(spark, docs, items) == ranked(docs, items)


def test_items_in_several_automata_give_the_same(spark):
    docs, items = odd()
    assert found(spark, docs, items, k=3, bound=40) == ranked(docs, items, 3)


def test_batches_of_few_scores_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(lexical_scan, "CELLS", 50)
    docs, items = odd()
    assert found(spark, docs, items, k=5) == ranked(docs, items, 5)


def test_equal_scores_go_by_doc_id(spark):
    docs = [(i, "same words here", "", "") for i in reversed(range(50))] + [(77, "others", "", "")]
    assert [r[2] for r in found(spark, docs, [(1, "words", "")])] == list(range(20))


def test_empty_tables(spark):
    docs, items = odd()
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == []
    assert found(spark, [(1, None, "", "")], items) == []
