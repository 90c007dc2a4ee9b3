"""The trie of conversations against one built of plain tuples."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from brightmere.llm import prefix_trie

ROWS = "conv_id bigint, turn bigint, role string, text string, depth string, a string, length int"


def own_turns(rows):
    found = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            sha = hashlib.sha256(text.encode()).hexdigest()
            found[conv].append(((turn is not None, turn or 0), role, sha, text))
    return {c: [(role, text) for _, role, _, text in sorted(said)] for c, said in found.items()}


def rebuilt(own):
    made = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = own.get(c - c % 100, [])[:h] + said[h:]
    return made


def expected(convs):
    members = defaultdict(list)
    for c, said in convs.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
    rows = []
    for key, found in members.items():
        under = [k for k in members if k[: len(key)] == key]
        kids = [k for k in under if len(k) == len(key) + 1]
        childless = [k for k in under if not any(len(x) == len(k) + 1 and x[: len(k)] == k for x in under)]
        saved = sum((len(members[k]) - 1) * len(k[-1][1]) for k in under if k)
        ended = ",".join(str(c) for c in sorted(found) if len(convs[c]) == len(key))
        rows.append((
            min(found), len(key), min(members[key[:-1]]) if key else None, len(found), len(kids), len(childless),
            saved, hashlib.sha256(ended.encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def found(frame):
    assert frame.columns[:8] == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    return sorted((tuple(r)[:8] for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def odd():
    """Few texts, so that conversations share turns; nulls, ties, repeated rows, long texts."""
    random.seed(11)
    texts = ["hello", "yes", "no", "été \U0001f600", "", None, "x" * 5000]
    rows = []
    for c in random.sample(range(1000), 150) + [0, 100, 200]:
        for turn in range(random.randint(1, 9)):
            text = random.choice(texts[:2]) if turn < 3 else random.choice(texts)
            rows.append((c, random.choice([turn, turn, None, 3]), random.choice(["user", "user", None]), text, "x", "y", 1))
    rows += rows[:4] + [(None, 1, "user", "lost", "", "", 0), (90_123, 0, "user", "hello", "", "", 0)]
    rows += [(10**12 + c, t, "user", "hello", "", "", 0) for c in range(40) for t in range(3)]
    rows += [(-5, 0, "user", "hello", "", "", 0)]
    return rows


def truncated(own):
    """As ``rebuilt``, with the remainder that SQL gives to negative numbers."""
    made = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + said[h:]
    return made


def test_rebuilt_nodes(spark, odd):
    convs = truncated(own_turns(odd))
    assert any(not said for said in convs.values())
    assert found(prefix_trie.rebuilt_trie(spark.createDataFrame(odd, ROWS))) == expected(convs)


def test_nodes_of_conversations_as_they_are(spark, odd):
    assert found(prefix_trie.trie(spark.createDataFrame(odd, ROWS))) == expected(own_turns(odd))


def test_conversations_over_many_blocks(spark, odd, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 2)
    monkeypatch.setattr(prefix_trie, "PIECE_BITS", 1)
    assert found(prefix_trie.rebuilt_trie(spark.createDataFrame(odd, ROWS))) == expected(truncated(own_turns(odd)))


def test_leaf_sequences(spark, odd):
    own = own_turns(odd)
    whole = defaultdict(list)
    for c, said in own.items():
        whole[tuple(said)].append(c)
    wanted = sorted(
        (min(c), len(k), len(c)) for k, c in whole.items() if not any(len(x) > len(k) and x[: len(k)] == k for x in whole)
    )
    assert sorted(map(tuple, prefix_trie.leaf_sequences(spark.createDataFrame(odd, ROWS)).collect())) == wanted


def test_empty_and_single(spark):
    assert found(prefix_trie.rebuilt_trie(spark.createDataFrame([], ROWS))) == []
    one = [(7, None, None, None, None, None, None)]
    assert found(prefix_trie.trie(spark.createDataFrame(one, ROWS))) == expected({7: [("", "")]})


def test_copies_of_one_conversation_make_one_path(spark):
    rows = [(c, t, "user", f"turn {t}", "", "", 0) for c in range(300) for t in range(4)]
    nodes = prefix_trie.trie(spark.createDataFrame(rows, ROWS)).collect()
    assert len(nodes) == 5 and all(n["conv_id"] == 0 and n["n_convs"] == 300 and n["n_leaves"] == 1 for n in nodes)
    ended = ",".join(map(str, range(300))).encode()
    assert [n["ends_sha256"] for n in nodes if n["depth"] == 4] == [hashlib.sha256(ended).hexdigest()]
