"""A quality classifier with supervised subword embeddings.

Features of a text are its words, pairs of neighbouring words, and the three and four characters
long pieces of its words, hashed to rows of one embedding table. A document is the mean of its features' vectors, and a
softmax over them gives the label. Vectors and softmax are learned together by stochastic
gradient descent in numpy on a bounded sample of labelled rows; every text is scored whole.
Case and punctuation count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightmere.llm.common import chunks, remainder, sample_ids, staged

BITS = 16
SAMPLE = 2000  # training rows of each label, those with the smallest hashes of doc_id
WIDTH = 16
EPOCHS = 5
RATE = 0.3

MIX = np.uint32(0x9E3779B1)
POWERS = np.power(np.uint32(0x01000193), np.arange(64, dtype=np.uint32), dtype=np.uint32)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of several texts: the slots, and the text of each slot."""
    code = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(x) + 1 for x in texts])
    space = (code == 32) | (code == 10) | (code == 9) | (code == 13)
    mixed = (code + np.uint32(1)) * MIX
    mixed ^= mixed >> np.uint32(15)
    found, owner = [], []
    # pieces of n characters, the blank before or after a word counting as one of them
    held = mixed
    blank = space.astype(np.int8)
    for n in (2, 3, 4):
        held = held[: len(code) - n + 1] * np.uint32(0x01000193) + mixed[n - 1 :]
        if n == 2:
            continue
        inner = ~space[1 : len(code) - n + 2]
        for i in range(2, n - 1):
            inner = inner[: len(held)] & ~space[i : len(code) - n + 1 + i]
        at = np.flatnonzero(inner[: len(held)])
        found.append(((held[at] ^ (held[at] >> np.uint32(13))) * MIX + np.uint32(n)) >> np.uint32(32 - BITS))
        owner.append(at + 1)
    # whole words
    start = np.flatnonzero(np.diff(blank, prepend=1) < 0)
    if len(start):
        index = np.arange(start[0], len(code)) - np.repeat(start, np.diff(start, append=len(code)))
        rest = slice(start[0], None)
        weighed = np.where(space[rest], np.uint32(0), mixed[rest] * POWERS[np.minimum(index, 63)])
        word = np.add.reduceat(weighed, start - start[0], dtype=np.uint32)
        found.append(((word ^ (word >> np.uint32(13))) * MIX + np.uint32(7)) >> np.uint32(32 - BITS))
        owner.append(start)
        # pairs of neighbours, without order: a word that follows itself has one slot of its own
        pair = (word[1:] ^ word[:-1]) * MIX
        found.append(((pair ^ (pair >> np.uint32(13))) * MIX + np.uint32(11)) >> np.uint32(32 - BITS))
        owner.append(start[:-1])
    slot = np.concatenate(found)
    return slot.astype(np.int32), np.searchsorted(ends, np.concatenate(owner), side="right")


@dataclass
class Model:
    vectors: np.ndarray  # slots x width
    output: np.ndarray  # width x 2
    bias: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """The probability of label 1. A mean of vectors times the softmax layer is the mean of
        the products, so each slot's product is taken from a table. Without a feature only the
        bias speaks."""
        gap = self.vectors @ (self.output[:, 1] - self.output[:, 0])
        slot, owner = features(texts)
        sums = np.bincount(owner, gap[slot], minlength=len(texts))[: len(texts)]
        n = np.bincount(owner, minlength=len(texts))[: len(texts)]
        return 1 / (1 + np.exp(-np.clip(sums / np.maximum(n, 1) + self.bias[1] - self.bias[0], -40, 40)))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 1) -> Model:
    """Gradient descent, a document at a time, over (slots, counts, label)."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH)).astype(np.float32)
    output, bias = random.normal(0, 0.1, (WIDTH, 2)), np.zeros(2)
    rows = [(s, (n / n.sum()).astype(np.float32), y) for s, n, y in rows if len(s)]
    steps = max(1, EPOCHS * len(rows))
    done = 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            rate, done = RATE * (1 - done / steps), done + 1
            slot, share, label = rows[i]
            mean = share @ vectors[slot]
            out = mean @ output + bias
            out = np.exp(out - out.max())
            gap = out / out.sum()
            gap[label] -= 1
            back = output @ gap
            output -= rate * np.outer(mean, gap)
            bias -= rate * gap
            # each feature moves as the mean moves, as in means of vectors with a shared rate
            vectors[slot] -= (rate * len(slot) * share)[:, None] * back.astype(np.float32)
    return Model(vectors, output, bias)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1; one row for each
    document): at most ``sample`` documents of each label, chosen by hash, texts whole; the bias
    is then moved to the shares that the labels have among all documents. Texts travel for the
    sample alone. Null texts are empty; rows without doc_id or with another label are left out;
    with rows of one label only, that label's bias speaks; with none, the score is within a hundredth of 0.5."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").select("doc_id", F.col("label").cast("int"))
    known = staged(known.join(docs.select("doc_id"), "doc_id", "left_semi"), "labels")
    chosen = sample_ids(known, "label", "doc_id", sample)
    rows = staged(texts.join(chosen.drop("place"), "doc_id").repartition(8), "labelled")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            texts, slots, counts = batch.column(2).to_pylist(), [], []
            for text in texts:
                slot, n = np.unique(features([text])[0], return_counts=True)
                slots.append(slot.astype("<u4").tobytes())
                counts.append(n.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(slots, pa.binary()), pa.array(counts, pa.binary())],
                ["doc_id", "label", "slots", "counts"],
            )

    made = rows.select("doc_id", "label", "text").mapInArrow(run, "doc_id bigint, label int, slots binary, counts binary")
    made = made.toPandas().sort_values(["doc_id", "label", "slots"])
    examples = [
        (np.frombuffer(s, "<u4"), np.frombuffer(n, "<u4"), y)
        for s, n, y in zip(made["slots"], made["counts"], made["label"])
    ]
    taken = made["label"].value_counts()
    del made
    model = train(examples)
    all_rows = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    for label in (0, 1):
        if label in taken:
            model.bias[label] += np.log(all_rows[label] / taken[label])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of (doc_id, held_out, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1_000_000):
            made = model.scores([x or "" for x in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(made), pa.array((made >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), "held_out", "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def score_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all ``docs``, learned from the labels of rows whose crc32(doc_id) modulo 3 is
    not 1. A document that is labelled more than once has its largest label."""
    given = labels.where(remainder("doc_id", 3) != 1).where("quality IN (0, 1)")
    given = given.groupBy("doc_id").agg(F.max("quality").alias("label"))
    model = fit(docs, given)
    held = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return score(docs.select("doc_id", held, "text"), model)
