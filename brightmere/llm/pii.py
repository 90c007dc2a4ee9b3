"""Personal data by weak supervision.

Candidates are the matches of the strict patterns and of looser ones (spelled-out addresses,
phone numbers without a plus, numbers shaped like cards or addresses that fail a check). Labelers
vote on each candidate: the strict pattern, a validity check, a gazetteer, the words before it,
the characters around it. Expectation-maximisation estimates what each labeler is worth for each
kind, from the counts of vote patterns over all documents, and its posteriors train a logistic
span classifier on the candidates' shapes and votes. Matches of the strict patterns always stay;
other candidates are added where the classifier says so.

Vote patterns and shapes take few values, so what leaves the tasks is counts of at most a few
thousand patterns, whatever the number of documents.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightmere.llm.common import chunks

# The kinds in their order, top-level domains, card issuers' first digits,
# words before personal data and before other numbers
KINDS = ("email", "ip", "card", "phone")
DOMAINS = set("com org net edu gov io info biz de fr es uk eu us ca ch at it nl example test".split())
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38")
BEFORE = {
    "email": set("email e-mail mail contact write address send reach correo courriel".split()),
    "ip": set("ip host server address login logged client node gateway from".split()),
    "card": set("card visa mastercard amex credit debit pay paid payment tarjeta carte karte".split()),
    "phone": set("phone tel telephone call mobile cell fax ring whatsapp sms tel: telefon teléfono".split()),
}
OTHER = set("version v ver release isbn issn order invoice ref reference id no nr section chapter page build".split())

# The strict patterns. Digits are taken in whole runs and domains are matched from their "@",
# so that no text makes a search run over a stretch again and again.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# The looser ones
SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(]?(?: at |@)[\])]? ?[A-Za-z0-9-]{1,63}"
    r"(?: ?[\[(]? ?(?:dot|\.) ?[\])]? ?[A-Za-z]{2,24}){1,4}(?![A-Za-z0-9])"
)
NATIONAL = re.compile(r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{3,4}(?![0-9])")
GROUPED = re.compile(r"(?<![0-9])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])")
NUMBER = re.compile(r"[0-9]")
LABELERS = 5


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: for each "@" with a domain, all local characters before it that no
    earlier address has taken."""
    done = 0
    at = text.find("@")
    while at >= 0:
        low = at
        while low > done and text[low - 1] in LOCAL_SET:
            low -= 1
        found = DOMAIN.match(text, at) if low < at else None
        if found:
            done = found.end()
            yield low, done
        at = text.find("@", max(at + 1, done))


def strict(text: str) -> list[tuple[str, int, int, bool]]:
    """Matches of the strict patterns and whether they pass their check."""
    found = [("email", a, b, True) for a, b in emails(text)] if "@" in text else []
    if NUMBER.search(text):
        if "." in text:
            for m in IP.finditer(text):
                found.append(("ip", m.start(), m.end(), all(len(y := x.lstrip("0")) < 4 and int(y or 0) < 256 for x in m[0].split("."))))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 11 < len(digits):
                found.append(("card", m.start(), m.end(), len(digits) < 20 and luhn(digits)))
        if "+" in text:
            for m in PHONE.finditer(text):
                found.append(("phone", m.start(), m.end(), 9 <= sum(map(str.isdigit, m[0])) <= 15))
    return found


def order(span: tuple[str, int, int]) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=order))


def candidates(text: str) -> list[tuple[str, int, int, bool, tuple[int, ...]]]:
    """kind, start, end, whether the strict pattern has it, and the votes and shape."""
    found = {(k, a, b): ok for k, a, b, ok in strict(text)}
    taken = [(a, b) for (_, a, b), ok in found.items() if ok]
    free = lambda m: all(m.end() <= a or b <= m.start() for a, b in taken)
    if " at " in text or "@" in text:
        for m in SPELLED.finditer(text):
            if free(m) and ("dot" in m[0] or "@" in m[0]):
                found.setdefault(("email", *m.span()), False)
    if NUMBER.search(text):
        for m in NATIONAL.finditer(text):
            if free(m):
                found.setdefault(("phone", *m.span()), False)
        for m in GROUPED.finditer(text):
            if free(m):
                found.setdefault(("card", *m.span()), False)
    return [(k, a, b, ok, votes(text, k, a, b, ok)) for (k, a, b), ok in found.items()]


def votes(text: str, kind: str, start: int, end: int, ok: bool) -> tuple[int, ...]:
    """The votes of the labelers (1 for, -1 against, 0 none) and three traits of the shape."""
    span = text[start:end]
    digits = "".join(filter(str.isdigit, span))
    words = [w.strip(".,;:()[]<>\"'").lower() for w in text[max(0, start - 40) : start].split()[-4:]]
    around = text[max(0, start - 1) : start] + text[end : end + 1]
    if kind == "email":
        valid = 1 if ok and ".." not in span else -1
        listed = 1 if re.split(r"\W+", span.strip(")]. ").lower())[-1] in DOMAINS else -1
    elif kind == "ip":
        valid = 1 if ok else -1
        listed = 0 if ok and not span.startswith(("0.", "127.", "255.")) else -1
    elif kind == "card":
        valid = 1 if len(digits) < 20 and luhn(digits) else -1
        listed = 1 if ISSUERS.match(digits) else -1
    else:
        valid = 1 if 9 <= len(digits) <= 15 else -1
        listed = 1 if span.startswith(("+", "(")) else 0
    context = 1 if BEFORE[kind] & set(words) else -1 if OTHER & set(words) else 0
    clear = -1 if any(c.isalnum() or c in "_@" for c in around) else 1
    shape = (min(3, len(digits) // 5), min(3, (end - start) // 8), int(any(c in " -()[]" for c in span)))
    return (1 if ok else -1, valid, listed, context, clear, *shape)


@dataclass
class Model:
    """Reliabilities (by kind: prior, and of each labeler the shares of its votes among true and
    false candidates) and the classifier's weights."""

    priors: dict[str, float] = field(default_factory=dict)
    reliabilities: dict[str, np.ndarray] = field(default_factory=dict)  # labeler x class x vote
    weights: np.ndarray | None = None
    known: dict[tuple, float] = field(default_factory=dict)

    def probability(self, kind: str, traits: tuple[int, ...]) -> float:
        if self.weights is None:
            return 0.0
        key = (kind, traits)
        if key not in self.known:
            self.known[key] = float(1 / (1 + np.exp(-np.clip(vector(kind, traits) @ self.weights, -40, 40))))
        return self.known[key]

    def spans(self, text: str) -> tuple[list, list]:
        """The spans of the strict patterns, and all spans."""
        base, more = [], []
        for kind, start, end, ok, traits in candidates(text):
            if ok:
                base.append((kind, start, end))
            elif self.probability(kind, traits) >= 0.5:
                more.append((kind, start, end))
        return base, base + more


def vector(kind: str, traits: tuple[int, ...]) -> np.ndarray:
    """Features of a candidate: its kind, each labeler's vote, and traits of its shape by kind."""
    made = [float(kind == k) for k in KINDS]
    for v in traits[:LABELERS]:
        made += [float(v == 1), float(v == -1)]
    for k in KINDS:
        made += [float(t) if k == kind else 0.0 for t in traits[LABELERS:]]
    return np.array(made)


def fit(docs: DataFrame, rounds: int = 50) -> Model:
    """Reliabilities and classifier from all texts of ``docs``. What the driver gets is the
    count of each pattern (kind, votes, shape)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in chunks(batches, "text"):
            for text in batch.column(0).to_pylist():
                found.update((k, traits) for k, _, _, _, traits in candidates(text or ""))
        kinds = [k for k, _ in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), pa.array([list(t) for _, t in found], pa.list_(pa.int32())),
             pa.array(list(found.values()), pa.int64())], ["kind", "traits", "n"],
        )

    patterns = docs.select("text").mapInArrow(run, "kind string, traits array<int>, n bigint")
    rows = patterns.groupBy("kind", "traits").agg(F.sum("n").alias("n")).collect()
    counts = {(r["kind"], tuple(r["traits"])): r["n"] for r in rows}
    return learned(counts, rounds)


def learned(counts: dict[tuple[str, tuple[int, ...]], int], rounds: int = 50) -> Model:
    """Expectation-maximisation and the classifier, from counts of patterns."""
    model = Model()
    keys = sorted(counts)
    soft = np.zeros(len(keys))
    for kind in KINDS:
        rows = [i for i, (k, _) in enumerate(keys) if k == kind]
        if not rows:
            continue
        n = np.array([counts[keys[i]] for i in rows], float)
        vote = np.array([keys[i][1][:LABELERS] for i in rows]) + 1  # 0 against, 1 none, 2 for
        # to begin with, the share of votes for a candidate among those given
        belief = ((vote == 2).sum(1) + 0.5) / ((vote != 1).sum(1) + 1)
        for _ in range(rounds):
            both = np.stack([1 - belief, belief])  # class x row
            prior = np.clip((both * n).sum(1) / n.sum(), 1e-6, 1)
            rate = np.stack([[(both[c] * n) @ (vote == v) + 0.5 for v in range(3)] for c in range(2)])  # class, vote, labeler
            rate = rate / rate.sum(1, keepdims=True)
            log = np.log(prior)[:, None] + sum(np.log(rate[:, vote[:, j], j]) for j in range(LABELERS))
            belief = 1 / (1 + np.exp(np.clip(log[0] - log[1], -40, 40)))
        model.priors[kind] = float(prior[1])
        model.reliabilities[kind] = rate.transpose(2, 0, 1)
        soft[rows] = belief
    if not keys:
        return model
    x = np.stack([vector(k, t) for k, t in keys])
    n = np.array([counts[k] for k in keys], float)
    n = n / n.sum()
    weights = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (n * (p - soft)) + 1e-4 * weights
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(x.shape[1])
        weights -= np.linalg.solve(curve, slope)
    model.weights = weights
    return model


def find(docs: DataFrame, model: Model) -> DataFrame:
    """A row for each row of ``docs``: doc_id, counts of strict matches by kind, the digest of
    their list, and the list of all spans (code points, end exclusive). Null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            counts, digests, spans = [], [], []
            for text in batch.column(1).to_pylist():
                base, every = model.spans(text or "")
                counts.append([sum(s[0] == k for s in base) for k in KINDS])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in zip(*counts)), pa.array(digests, pa.string()),
                 pa.array(spans, pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return rows.mapInArrow(run, f"doc_id bigint, {counts}, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first covers."""
    made, done = [], 0
    for kind, start, end in sorted(spans, key=order):
        if start >= done:
            made += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join([*made, text[done:]])


def mask(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind, and ``n_chars``, where there is
    such a column, counted anew. Null texts stay null; other columns stay as they are."""
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            texts = [None if x is None else masked(x, model.spans(x)[1])
                     for x in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*rest, "text"])

    slim = docs.select(*(F.col(f"`{c}`") for c in rest), "text")
    made = slim.mapInArrow(run, slim.schema)
    kinds = dict(docs.dtypes)
    if "n_chars" in kinds:
        made = made.withColumn("n_chars", F.length("text").cast(kinds["n_chars"]))
    return made.select(*(F.col(f"`{c}`") for c in docs.columns))
