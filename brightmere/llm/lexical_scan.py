"""Ranked lexical search without an index: an Aho-Corasick automaton of all items' terms reads
every text once.

Terms are runs of ASCII letters, digits and characters beyond ASCII, with A to Z lower-cased.
Each text becomes UTF-8 bytes in which every separator is a blank, and the automaton holds each
wanted term between two blanks, so it reports whole terms only, overlaps at the blanks
included. What it reports maps to the items that hold the term, and a document's scores for all
items are sums over its few different wanted terms.

The automaton goes to every task, so its size is bounded: items whose terms have more than
``BOUND`` bytes together are dealt into blocks, one scan of the texts each. Counts of one scan
(document, length, wanted terms and how often) are staged; statistics and scores read those.
Tasks keep the ``k`` best documents of each item, which salted windows then merge.

Defined cases: a null or term-free text is no document. A row without doc_id counts in the
statistics and is never returned. Repeated rows are documents of their own. Of several items
with one item_id the smallest text counts; items without an id or a term have no rows. Equal
scores go by ascending doc_id. Other columns are not read.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightmere.llm.common import chunks, once, staged, summed

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bytes of the different terms of the items of one automaton, which takes some 50 bytes for each.
BOUND = 4_000_000
# Item scores that a task holds at once, and the parts of an item's best rows before the last merge.
CELLS = 2_000_000
SALTS = 32
BLOCK = 1 << 16

# Separators become blanks, capitals small letters; bytes beyond ASCII stay.
PLAIN = bytes(
    c if c >= 128 or chr(c) in "0123456789" + LOWER else c + 32 if chr(c) in UPPER else 32 for c in range(256)
)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of the items' different terms."""
    text = items.where("item_id IS NOT NULL").groupBy(F.col("item_id").cast("bigint").alias("item_id")).agg(
        F.min("text").alias("text")
    )
    found = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))
    return text.select("item_id", F.explode(found).alias("term")).groupBy("item_id", "term").agg(
        F.count(F.lit(1)).alias("times")
    )


def search(documents: DataFrame, items: DataFrame, k: int = 20, bound: int = BOUND) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item, by descending score.

    One scan of ``documents`` (doc_id, text) for each ``bound`` bytes of the terms of ``items``
    (item_id, text). The terms of one item are never parted, so an item of more than ``bound``
    bytes makes a block of its own size.
    """
    wanted = staged(item_terms(items), "items")
    size = wanted.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    blocks = max(1, -(-size // bound))
    dealt = wanted.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    found = [_block(documents, dealt.where(F.col("block") == b).collect(), k) for b in range(blocks)]
    best = reduce(DataFrame.unionByName, found)
    order = F.col("score").desc(), F.col("doc_id")
    for keys in (["item_id", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))], ["item_id"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        best = best.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")


def _block(documents: DataFrame, wanted: list, k: int) -> DataFrame:
    """The best documents, for each task, of the items whose terms ``wanted`` lists."""
    terms = sorted({r["term"] for r in wanted})
    number = {term: i for i, term in enumerate(terms)}
    ids = sorted({r["item_id"] for r in wanted})
    place = {item: i for i, item in enumerate(ids)}
    postings = sorted((number[r["term"]], place[r["item_id"]], r["times"]) for r in wanted)
    counts = staged(counted(documents, terms), "counts")
    found = np.concatenate([x for _, x in sorted(summed(_frequencies(counts, len(terms)), "int64").items())] or [np.zeros(2, np.int64)])
    n, total, df = int(found[0]), int(found[1]), found[2:]
    weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in df] if n else [0] * len(terms)
    first = np.searchsorted(np.array([t for t, _, _ in postings], np.int64), np.arange(len(terms) + 1))
    item = np.array([i for _, i, _ in postings], np.int64)
    worth = np.array([weight[t] * times for t, _, times in postings], np.int64)
    return counts.where("doc_id IS NOT NULL AND octet_length(terms) > 0").mapInArrow(
        _best(first, item, worth, np.array(ids, np.int64), n, total, k), "item_id bigint, doc_id bigint, score bigint"
    )


def counted(documents: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, length, terms, times) of every document with a term: its number of terms, the
    places in ``terms`` of those it holds, and how often; both packed as 32-bit numbers."""
    name = uuid.uuid4().hex

    def automaton():
        import ahocorasick

        made = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            made.add_word(f" {term.encode().decode('latin-1')} ", i)
        if terms:
            made.make_automaton()
        return made

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = once(name, automaton)
        for batch in chunks(batches, "text"):
            texts = batch.column("text").cast(pa.large_string())
            at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = texts.buffers()[2]
            plain = bytes(memoryview(data)[at[0] : at[-1]]).translate(PLAIN) if data is not None else b""
            at = at - at[0]
            letter = np.frombuffer(plain, np.uint8) != 32
            begins = letter.copy()
            begins[1:] &= ~letter[:-1]
            inner = at[:-1][at[:-1] < at[1:]]
            begins[inner] = letter[inner]
            before = np.concatenate([[0], np.cumsum(begins, dtype=np.int64)])
            length = before[at[1:]] - before[at[:-1]]
            rows = np.flatnonzero(length)
            which, times = [], []
            for i in rows:
                text = f" {plain[at[i] : at[i + 1]].decode('latin-1')} "
                seen = Counter(map(itemgetter(1), found.iter(text))) if terms else {}
                which.append(np.fromiter(seen.keys(), np.uint32, len(seen)).tobytes())
                times.append(np.fromiter(seen.values(), np.uint32, len(seen)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows)),
                    pa.array(length[rows], pa.int64()),
                    pa.array(which, pa.binary()),
                    pa.array(times, pa.binary()),
                ],
                ["doc_id", "length", "terms", "times"],
            )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id bigint, length bigint, terms binary, times binary")


def _frequencies(counts: DataFrame, size: int) -> DataFrame:
    """Blocks to sum: documents, their terms, and the documents of each wanted term."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size + 2, np.int64)
        for batch in batches:
            held[0] += batch.num_rows
            held[1] += int(np.asarray(batch.column("length")).sum())
            seen = np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.uint32)
            held[2:] += np.bincount(seen, minlength=size)
        if held[0]:
            cuts = range(0, size + 2, BLOCK)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([c // BLOCK for c in cuts], pa.int32()),
                    pa.array([held[c : c + BLOCK].tobytes() for c in cuts], pa.binary()),
                ],
                ["block", "data"],
            )

    return counts.select("length", "terms").mapInArrow(add, "block int, data binary")


def _best(first: np.ndarray, item: np.ndarray, worth: np.ndarray, ids: np.ndarray, n: int, total: int, k: int):
    """Score the documents of a task for all items and keep the ``k`` best of each."""
    size = len(ids)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = tuple(np.zeros(0, np.int64) for _ in range(3))  # item, score, doc_id
        least = np.ones(size, np.int64)
        for batch in batches:
            docs = np.asarray(batch.column("doc_id"))
            packed = batch.column("terms").to_pylist()
            terms = np.frombuffer(b"".join(packed), np.uint32).astype(np.int64)
            times = np.frombuffer(b"".join(batch.column("times").to_pylist()), np.uint32).astype(np.int64)
            norm = np.array([75 + 25 * x * n // total for x in batch.column("length").to_pylist()], np.int64)
            ends = np.cumsum([len(p) // 4 for p in packed])
            many = first[terms + 1] - first[terms]
            work = np.concatenate([[0], np.cumsum(many)])[ends]  # postings up to each document
            at = 0
            while at < len(docs):
                done = work[at - 1] if at else 0
                to = max(at + 1, min(at + max(1, CELLS // size), int(np.searchsorted(work, done + CELLS, "right"))))
                lo, hi = (ends[at - 1] if at else 0), ends[to - 1]
                row = np.repeat(np.arange(to - at), np.diff(np.concatenate([[lo], ends[at:to]])))
                gain = 1_000_000_000 * times[lo:hi] // (1000 * times[lo:hi] + 12 * norm[at:to][row])
                each = many[lo:hi]
                skip = np.cumsum(each) - each
                post = np.repeat(first[terms[lo:hi]] - skip, each) + np.arange(int(each.sum()))
                scores = np.zeros((to - at) * size, np.int64)
                np.add.at(scores, np.repeat(row, each) * size + item[post], worth[post] * np.repeat(gain, each))
                near = np.flatnonzero(scores >= np.tile(least, to - at))
                held = _merged(held, (near % size, scores[near], docs[at:to][near // size]), k)
                last = np.flatnonzero(np.bincount(held[0], minlength=size) >= k)
                least[last] = held[1][np.searchsorted(held[0], last) + k - 1]
                at = to
        if len(held[0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[held[0]]), pa.array(held[2]), pa.array(held[1])], ["item_id", "doc_id", "score"]
            )

    return score


def _merged(held: tuple, new: tuple, k: int) -> tuple:
    """The ``k`` best of both for each item, by item, descending score and doc_id."""
    items, scores, docs = (np.concatenate(x) for x in zip(held, new))
    order = np.lexsort((docs, -scores, items))
    items, scores, docs = items[order], scores[order], docs[order]
    place = np.arange(len(items)) - np.searchsorted(items, items)
    keep = place < k
    return items[keep], scores[keep], docs[keep]
