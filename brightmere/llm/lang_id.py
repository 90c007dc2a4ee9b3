"""Language identification with a string kernel.

The kernel of two texts is the number of n-grams (one to four letters, hashed to 2**18 slots)
that both contain, over the root of the product of their numbers: a blended-spectrum presence
kernel. Landmark texts give the Nystroem features K(x, L) K(L, L)^(-1/2); one-versus-rest kernel
ridge regression is fitted in them from sums that Spark adds up, and texts are scored by
products of batches with the landmark matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightmere.llm.common import chunks, remainder, sample_ids, staged, summed

BITS = 18
GRAMS = 4
SAMPLE = 1000  # training documents of each language, those with the smallest hashes of doc_id
LANDMARKS = 32  # of each language, among them
RIDGE = 1e-3  # times the number of training documents
NONE = "und"


def _letters() -> np.ndarray:
    """Code points up to 65535 as they count: letters in lower case, all else a space."""
    lower = ((c, chr(c).lower()) for c in range(65536))
    return np.array([(ord(x) if len(x) == 1 else c) if chr(c).isalpha() else 32 for c, x in lower], np.uint32)


LETTERS = _letters()


def slots(text: str) -> np.ndarray:
    """The sorted distinct slots of a text's n-grams; empty for a text without letters. Only
    n-grams with a letter count."""
    code = LETTERS[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 65535)]
    # runs of other characters count as one space
    code = code[np.r_[True, (code[1:] != 32) | (code[:-1] != 32)]] if len(code) else code
    flags = np.zeros(1 << BITS, bool)
    if not (code != 32).any():
        return np.empty(0, np.int32)
    code = np.r_[np.uint32(32), code, np.uint32(32)]
    held = np.zeros(len(code), np.uint32)
    for n in range(1, GRAMS + 1):
        held = held[: len(code) - n + 1] * np.uint32(0x01000193) + code[n - 1 :]
        mixed = (held ^ (held >> np.uint32(15))) * np.uint32(0x9E3779B1) + np.uint32(n)
        flags[mixed >> np.uint32(32 - BITS)] = True
    return np.flatnonzero(flags).astype(np.int32)


@dataclass
class Landmarks:
    """Slots that occur in a landmark, and which landmark has which."""

    used: np.ndarray
    matrix: np.ndarray  # slots x landmarks, 0 or 1
    norms: np.ndarray

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> Landmarks:
        used = np.unique(np.concatenate(sets)) if sets else np.empty(0, np.int32)
        matrix = np.zeros((len(used), len(sets)), np.float32)
        for i, s in enumerate(sets):
            matrix[np.searchsorted(used, s), i] = 1
        return cls(used, matrix, np.array([max(1, len(s)) for s in sets], np.float64))

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """K(x, L) of a batch: one product of its presence matrix with the landmarks'."""
        present = np.zeros((len(sets), len(self.used)), np.float32)
        at = np.full(1 << BITS, -1, np.int32)
        at[self.used] = np.arange(len(self.used))
        for i, s in enumerate(sets):
            place = at[s]
            present[i, place[place >= 0]] = 1
        sizes = np.array([max(1, len(s)) for s in sets], np.float64)
        return (present @ self.matrix) / np.sqrt(sizes[:, None] * self.norms)


@dataclass
class Model:
    classes: list[str]
    landmarks: Landmarks
    weights: np.ndarray  # landmarks x classes

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The class of the highest output, ties to the first by name, and the output cut to
        0..1; ``und`` and 0 for null, for texts without a letter and for an empty model. A text
        whose only letters are beyond the first 65,536 characters has the first class and 0."""
        names, scores = [NONE] * len(texts), [0.0] * len(texts)
        sets = [np.empty(0, np.int32) if x is None else slots(x) for x in texts]
        rows = [i for i, s in enumerate(sets) if len(s)] if self.classes else []
        for i, x in enumerate(texts if self.classes else []):
            if not len(sets[i]) and x and any(map(str.isalpha, x)):
                names[i] = self.classes[0]
        for low in range(0, len(rows), 64):
            some = rows[low : low + 64]
            out = self.landmarks.kernel([sets[i] for i in some]) @ self.weights
            best = out.argmax(1)
            for i, c, x in zip(some, best.tolist(), np.clip(out.max(1), 0, 1).tolist()):
                names[i], scores[i] = self.classes[c], x
        return names, scores


def fit(labelled: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Model:
    """Learn from ``labelled`` (doc_id, text, lang): at most ``sample`` whole texts of each
    language, chosen by hash. Rows with a null in any of the three columns are left out."""
    known = labelled.select("doc_id", "text", "lang").where(
        "doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL"
    )
    chosen = sample_ids(known.select("doc_id", "lang"), "lang", "doc_id", sample)
    rows = staged(known.join(chosen, ["doc_id", "lang"]).repartition(8), "languages")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            found = [slots(x).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["lang", "slots"])

    first = rows.where(F.col("place") <= landmarks).orderBy("lang", "place", "text").select("lang", "text")
    first = [(r["lang"], np.frombuffer(bytes(r["slots"]), np.int32))
             for r in first.mapInArrow(sets, "lang string, slots binary").collect()]
    marks = Landmarks.of([s for _, s in first if len(s)])
    classes = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    size = len(marks.norms)
    if not size:
        return Model([], marks, np.zeros((0, 0)))
    at = {c: i for i, c in enumerate(classes)}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, cross = np.zeros((size, size)), np.zeros((size, len(classes)))
        for batch in chunks(batches, "text"):
            kernel = marks.kernel([slots(x) for x in batch.column(1).to_pylist()])
            square += kernel.T @ kernel
            for i, c in enumerate(batch.column(0).to_pylist()):
                cross[:, at[c]] += kernel[i]
        data = [np.r_[square.ravel(), cross.ravel()].tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array(data, pa.binary())], ["block", "data"])

    total = summed(rows.select("lang", "text").mapInArrow(sums, "block int, data binary"))[0]
    square, cross = total[: size * size].reshape(size, size), total[size * size :].reshape(size, -1)
    own = marks.kernel([s for _, s in first if len(s)])
    value, vector = np.linalg.eigh((own + own.T) / 2)
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    features = root.T @ square @ root
    features += RIDGE * rows.count() * np.eye(len(features))
    return Model(classes, marks, root @ np.linalg.solve(features, root.T @ cross))


def identify(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language of every whole text and its score. Other columns,
    whatever their names, stay as they are, but for two of the names asked for."""
    kept = [c for c in docs.columns if c not in (lang, score)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            names, scores = model.predict(batch.column(batch.schema.get_field_index(text)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64())], [*kept, lang, score],
            )

    schema = docs.select(*(F.col(f"`{c}`") for c in kept)).schema.add(lang, "string").add(score, "double")
    return docs.select(*{*kept, text}).mapInArrow(run, schema)


def held_out(n: int, fold: int) -> Column:
    return F.coalesce(remainder("doc_id", n) == fold, F.lit(False))


def predict_held_out(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``; learned from the rows whose
    crc32(doc_id) modulo 4 is not 2. A null doc_id is neither learned from nor held out."""
    rows = docs.select("doc_id", "text", "lang")
    model = fit(rows.where(remainder("doc_id", 4) != 2))
    slim = rows.select("doc_id", held_out(4, 2).alias("held_out"), "text")
    return identify(slim, model).drop("text")


def reject(docs: DataFrame, model: Model, least: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that have a language: those without a letter, and those whose best
    output stays below ``least``, go. A missing lang is filled with the prediction."""
    found = identify(docs, model, lang="__lang", score="__score")
    kept = found.where((F.col("__lang") != NONE) & (F.col("__score") >= least))
    return kept.select(*(F.coalesce("lang", "__lang").alias("lang") if c == "lang" else F.col(f"`{c}`") for c in docs.columns))
