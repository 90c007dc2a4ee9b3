"""Mixing sources to target weights, with soft membership and DataFrame functions alone.

A labelled table says which domain some documents belong to. Hashed words of a bounded sample of
them give log weights; the mean weight of all words of a text gives every document its posterior
over the domains. Rates r >= 0 are then fitted by projected gradient least squares, so that the
expected tokens of the domains, sum of r * tokens * posterior, match the targets: an iteration is
one distributed sum over the documents, and the gradient's step, scaled by the curvature over the
documents of a rate above 0, joins the steps before it; r is the projection max(0, 1 - p . g) of
their sum. g is as many numbers as there are domains, so no state is stored between iterations.

With an anchor, the documents of that domain stay: their projection is max(1, 1 - p . g). What
they bring of other domains may be more than the targets leave, so a miss of the targets then has
a price (``SOFT``) beside the change of the rates, and the fit has one solution in any case.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightmere.llm.common import sample_ids, staged

SLOTS = 4096  # hashed words
SAMPLE = 2000  # labelled documents of each domain that the weights are learned from
SHARPNESS = 30.0  # of the posterior: times the mean weight of a word
ITERATIONS = 25
NEAR = 1e-6  # share of the targets' sum at which the fit ends
SOFT = 1e-3  # with an anchor: share of the targets' sum that a domain misses for each unit of its g
HALVINGS = 6  # of a step that leads away from the solution


def slots(text: Column) -> Column:
    """Slots of the words of a text, upper and lower case apart; none for a blank text."""
    words = F.split(F.trim(F.regexp_replace(text, "\\s+", " ")), " ")
    found = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(SLOTS)).cast("int"))
    return F.when(F.trim(text) == "", F.array().cast("array<int>")).otherwise(found)


def weights(docs: DataFrame, labelled: DataFrame, domains: list[str], sample: int = SAMPLE) -> list[list[float]]:
    """For each domain, the log weight of each slot against the mean of the domains."""
    ids = sample_ids(labelled, "domain", "doc_id", sample)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ids.drop("place"), "doc_id")
    each = F.concat(F.array(F.lit(-1)), F.array_distinct(slots(F.col("text"))))  # -1 counts the texts themselves
    counts = texts.select("domain", F.explode(each).alias("slot")).groupBy("domain", "slot").count().collect()
    size = {r["domain"]: r["count"] for r in counts if r["slot"] < 0}
    shares = {d: [0.5 / (size.get(d, 0) + 1)] * SLOTS for d in domains}
    for r in counts:  # domains x slots numbers at most
        if r["slot"] >= 0:
            shares[r["domain"]][r["slot"]] = (r["count"] + 0.5) / (size[r["domain"]] + 1)
    logs = {d: [math.log(x) for x in shares[d]] for d in domains}
    mean = [sum(logs[d][i] for d in domains) / len(domains) for i in range(SLOTS)]
    # a domain without labelled documents has no evidence for it or against it
    return [[a - b if size.get(d) else 0.0 for a, b in zip(logs[d], mean)] for d in domains]


def summed_up(of: str, log: Column) -> Column:
    return F.aggregate(of, F.lit(0.0), lambda held, s: held + F.get(log, s))


@dataclass
class Model:
    """Domains, their priors and word weights, and the sum of the steps of the fitted rates."""

    domains: list[str]
    priors: list[float]
    table: list[list[float]]  # by domain, of each slot
    step: list[float]
    anchor: int = -1
    labels: DataFrame | None = None  # with an anchor: doc_id, __sure (labelled as the anchor alone)

    def posterior(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``__tokens`` (words) and ``__p`` (array of the domains' posteriors). Null
        texts are empty; a text without words has the priors."""
        found = docs.withColumn("__slots", slots(F.coalesce("text", F.lit(""))))
        n = F.greatest(F.size("__slots"), F.lit(1))
        logits = []
        for prior, row in zip(self.priors, self.table):
            text = json.dumps([round(x, 4) for x in row])  # a constant that Spark folds once
            log = F.from_json(F.lit(text), "array<double>")
            logits.append(SHARPNESS * summed_up("__slots", log) / n + math.log(prior))
        found = found.withColumn("__logit", F.array(*logits)).withColumn("__tokens", F.size("__slots").cast("double"))
        found = found.withColumn("__grown", F.transform("__logit", lambda x: F.exp(x - F.array_max("__logit"))))
        whole = sum((F.get("__grown", F.lit(k)) for k in range(len(self.domains))), F.lit(0.0))
        return found.withColumn("__p", F.transform("__grown", lambda x: x / whole)).drop("__slots", "__logit", "__grown")

    def floors(self, found: DataFrame) -> DataFrame:
        """``found`` (doc_id, __p) with ``__floor``, the least rate: with an anchor 1 where a document
        is labelled so or, without a label, no other domain is likelier; 0 for all others."""
        if self.labels is None:
            return found.withColumn("__floor", F.lit(0.0))
        likely = F.get("__p", F.lit(self.anchor)) >= F.array_max("__p")
        found = found.join(self.labels, "doc_id", "left")
        return found.withColumn("__floor", F.coalesce("__sure", likely).cast("double")).drop("__sure")

    def moved(self) -> Column:
        return sum((F.get("__p", F.lit(k)) * g for k, g in enumerate(self.step)), F.lit(0.0))

    def rate(self) -> Column:
        """The rate of a document from ``__p`` and ``__floor``."""
        return F.greatest(F.col("__floor"), 1 - self.moved())


def solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """A small system by elimination; a domain without tokens moves nothing."""
    n = len(right)
    rows = [[*row, y] for row, y in zip(matrix, right)]
    for i in range(n):
        best = max(range(i, n), key=lambda j: abs(rows[j][i]))
        rows[i], rows[best] = rows[best], rows[i]
        if abs(rows[i][i]) < 1e-9:
            rows[i] = [*([0.0] * i), 1.0, *([0.0] * (n - i - 1)), 0.0]
        for j in range(n):
            if j != i:
                by = rows[j][i] / rows[i][i]
                rows[j] = [a - by * b for a, b in zip(rows[j], rows[i])]
    return [row[-1] / row[i] for i, row in enumerate(rows)]


def fit(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], anchor: str | None = None,
        grow: float = 1.0) -> tuple[Model, DataFrame]:
    """Learn posteriors from ``labelled`` (doc_id, domain) and fit rates to ``targets`` (weights
    of domains, any positive sum). Returns the model and the rows doc_id, __tokens, __p, __floor.
    Labels of documents that ``docs`` lacks count nowhere.

    The targets' sum is ``grow`` times the tokens of all documents or, with an ``anchor``, so
    large that this domain's target is ``grow`` times its own tokens; its documents have rates of
    one or more. Targets that no such rates can meet are met as nearly as least squares allow; a
    domain that has no tokens gets none.
    """
    domains = sorted(d for d, w in targets.items() if w >= 0)
    known = labelled.where(F.col("domain").isin(domains)).where("doc_id IS NOT NULL").select("doc_id", "domain")
    known = staged(known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "labelled")
    size = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}
    priors = [(size.get(d, 0) + 1) / (sum(size.values()) + len(domains)) for d in domains]
    model = Model(domains, priors, weights(docs, known, domains), [0.0] * len(domains))
    if anchor:
        model.anchor = domains.index(anchor)
        model.labels = known.groupBy("doc_id").agg(F.bool_and(F.col("domain") == anchor).alias("__sure"))
    found = model.posterior(docs.select("doc_id", "text")).drop("text")
    rows = staged(model.floors(found), "posteriors") if anchor else model.floors(staged(found, "posteriors"))
    at = range(len(domains))

    def sums() -> tuple[list[float], list[list[float]], float]:
        """Expected tokens of each domain, the curvature over documents of a rate above its floor,
        and the least of half the rates' squared changes plus g times the tokens."""
        p = [F.get("__p", F.lit(k)) for k in at]
        rate, n = model.rate(), F.col("__tokens")
        live = F.when(F.col("__rate") > F.col("__floor"), n).otherwise(F.lit(0.0))
        each = [F.sum(F.col("__rate") * n * p[k]).alias(f"s{k}") for k in at]
        each += [F.sum(live * p[k] * p[m]).alias(f"h{k}_{m}") for k in at for m in at]
        change = F.col("__rate") - 1
        each.append(F.sum(n * (change * change / 2 + F.col("__rate") * model.moved())).alias("least"))
        found = [float(x or 0.0) for x in rows.withColumn("__rate", rate).agg(*each).first()]
        return found[: len(at)], [found[len(at) * (k + 1) : len(at) * (k + 2)] for k in at], found[-1]

    now, curve, least = sums()
    whole = sum(targets[d] for d in domains) or 1.0
    share = [targets[d] / whole for d in domains]
    total = grow * (now[model.anchor] / share[model.anchor] if anchor else sum(now))
    wanted = [x * total for x in share]
    soft = SOFT * total if anchor else 0.0

    def bound(least: float) -> float:
        """What the steps raise: a lower bound of the fit's squares."""
        return least - sum(g * w + soft * g * g / 2 for g, w in zip(model.step, wanted))

    for _ in range(ITERATIONS):
        gap = [a - b - soft * g for a, b, g in zip(now, wanted, model.step)]
        if not total or max(map(abs, gap)) <= NEAR * total:
            break
        held, before = model.step, bound(least)
        curve = [[x + soft * (k == m) for m, x in enumerate(row)] for k, row in enumerate(curve)]
        step = solve(curve, gap)
        for _ in range(HALVINGS + 1):
            model.step = [a + b for a, b in zip(held, step)]
            now, curve, least = sums()
            if bound(least) >= before - 1e-9 * total:
                break
            step = [x / 2 for x in step]
    return model, rows


def rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float]) -> DataFrame:
    """doc_id, n_tokens, the posterior of each domain (p_<domain>) and the rate of every row of
    ``docs`` (doc_id, text). Repeated rows have equal rates and count each time."""
    model, rows = fit(docs, labelled, targets)
    each = [F.get("__p", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(model.domains)]
    return rows.select("doc_id", F.col("__tokens").cast("bigint").alias("n_tokens"), *each, model.rate().alias("rate"))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], anchor: str | None = None,
        grow: float = 1.0) -> DataFrame:
    """``docs`` with each row as often as its rate says: its whole part, and once more where a
    hash of doc_id falls below the rest. Rows of the ``anchor`` stay. Columns stay as they are."""
    model, _ = fit(docs, labelled, targets, anchor, grow)
    chance = F.xxhash64("doc_id", F.lit("mixing")).cast("double") / 2.0**64 + 0.5
    found = model.floors(model.posterior(docs)).withColumn("__copies", F.floor(model.rate() + chance).cast("int"))
    found = found.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__copies"))))
    return found.select(*(F.col(f"`{c}`") for c in docs.columns))


def by_labels(labels: DataFrame) -> DataFrame:
    """The labelled table of the standard ``labels``: toxic documents, poor and clean ones. A
    document with several labels has the worst."""
    worst = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "clean")
    return worst.select("doc_id", domain.alias("domain")).where("domain IS NOT NULL")
