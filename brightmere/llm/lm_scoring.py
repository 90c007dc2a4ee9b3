"""Scoring texts with a hashed maximum-entropy language model.

The outcomes are the end of a text, the most frequent training words, and buckets of all other
words by their last two bytes; within a bucket a word has its add-one unigram share, so the
probabilities of all words, an unseen one among them, add up to one. The softmax is factored:
first the class of an outcome, then the outcome among the class's, which again may be groups. All
parts are log-linear in the word before (bigram), the word before that (skip), and both together
(trigram), each as an outcome, and in the two words themselves (by hashes) where they are no
outcomes; features of the later parts are hashed together with the class.

Outcomes and hashed rows grow with the square root of the counted training tokens, as does the
share of the data that a task learns from, so what the tasks write grows in proportion to the input.

Tasks count repeated (context, outcome) triples of a million positions at once and descend along
the gradient of each batch of triples; Spark averages the tasks' tables by how often each row was
touched. Words, outcomes and gradients are gathered from every training text. Counts of the most
frequent words travel as a table of bounded size; the counts of all other words are joined.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightmere.llm.common import chunks, remainder, staged, summed

HEAD = 1 << 17  # at most so many words, the most frequent, have counts that every task holds
CLASSES = SIZE = 32
OUTCOMES = CLASSES * SIZE
TAILS = 64  # buckets of other words; the last outcomes
START = OUTCOMES  # the context before the first word
TRIGRAMS = 1 << 13
MEMBERS = 1 << 15
RARER = 1 << 15  # rows of contexts that are no outcomes
POSITIONS = 1_000_000
BATCH = 1 << 14
RATE = 0.5
ROUNDS = 1
BLOCKS = 32
FLUSH = 300_000
ROOT_TOKENS = 1 << 25  # training tokens up to which the tables have the sizes above
HASHED = 1024  # hashes of the words of a bucket as contexts, at these sizes
SCORED = 1 << 12  # triples scored at once
LONG = 16  # so many members of all runs are added at once
LONGER = 64
TOKENS_A_ROW = 25  # that a task learns from at least


@dataclass(frozen=True)
class Sizes:
    """Sizes of the tables: multiples, by ``leaves``, a power of two, of those above."""

    leaves: int = 1
    hashed: int = 0  # hashes of the words of a bucket

    @staticmethod
    def of(tokens: int) -> Sizes:
        leaves = 1 << max(0, round(np.log2(max(1, tokens) / ROOT_TOKENS) / 2))
        return Sizes(leaves, HASHED * leaves)

    @property
    def outcomes(self) -> int:
        return OUTCOMES * self.leaves

    @property
    def words(self) -> int:
        return self.outcomes - TAILS - 1

    @property
    def start(self) -> int:
        return self.outcomes

    @property
    def contexts(self) -> int:
        """Outcomes, the start, and the hashed words of the buckets."""
        return self.outcomes + 1 + TAILS * self.hashed

    @property
    def trigrams(self) -> int:
        return TRIGRAMS * self.leaves

    @property
    def rows(self) -> int:
        return 2 * (self.start + 1) + self.trigrams + (MEMBERS + RARER) * self.leaves

    @property
    def widths(self) -> list[int]:
        """Children of a node of each level of the softmax."""
        found, left = [CLASSES, SIZE], self.leaves
        while left > 1:
            found.append(min(SIZE, left))
            left //= found[-1]
        return found

    def context(self, word: bytes) -> int:
        """The context, and by ``outcome`` the bucket, of a word that is no outcome."""
        return int(self.hashes([word])[0])

    def hashes(self, words: Sequence[bytes]) -> np.ndarray:
        """``context`` of each of the words."""
        tail = np.array([zlib.crc32(w[-2:]) for w in words], np.int64) % TAILS
        return self.outcomes + 1 + tail + TAILS * ((np.array([zlib.crc32(w) for w in words], np.int64) >> 8) % self.hashed)

    def outcome(self, context: np.ndarray) -> np.ndarray:
        tail = split(context - self.outcomes - 1, TAILS)[1] + self.outcomes - TAILS
        return np.where(context > self.outcomes, tail, context)


def split(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Quotient and remainder; quotients by one number are fast, numpy's remainders are not."""
    whole = x // n
    return whole, x - whole * n


def runs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts ``rows``, equal ones as they came, the distinct rows, and where each begins."""
    low, bits = int(rows.min()), len(rows).bit_length()
    rows = rows - low
    if int(rows.max()) >> 32 - bits == 0:  # half as wide numbers are sorted in half the time
        rows = rows.astype(np.uint32)
    both = np.sort(rows << bits | np.arange(len(rows), dtype=rows.dtype))
    rows = both >> bits
    start = np.r_[0, np.flatnonzero(rows[1:] != rows[:-1]) + 1]
    return (both & (1 << bits) - 1).astype(np.int64), rows[start].astype(np.int64) + low, start


def sums(values: np.ndarray, order: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the runs of ``values`` in ``order`` that begin at ``start``, and the runs' numbers. Of wide
    values the k-th members of all runs, the longest first, are added at once, those beyond ``LONG`` apart
    and of runs above ``LONGER`` run by run."""
    if values.shape[1] <= 4:
        return np.stack([np.add.reduceat(x.take(order), start) for x in values.T], 1), np.arange(len(start))
    size = np.diff(start, append=len(order))
    less = len(order) - size
    by = np.argsort(less.astype(np.uint16) if len(order) < 1 << 16 else less, kind="stable")
    first, size = start[by], size[by]
    out = values.take(order[first], 0)
    longer = np.searchsorted(-size, -np.arange(LONGER + 1)).tolist()  # runs of more than k members
    for k in range(1, LONG):
        n = longer[k]
        out[:n] += values.take(order[first[:n] + k], 0)
    few, n = longer[LONGER], longer[LONG]
    rest = values.take(order[first[:n] + LONG], 0)
    for i in range(few):
        rest[i] = values.take(order[first[i] + LONG : first[i] + size[i]], 0).sum(0)
    for k in range(LONG + 1, LONGER):
        if (m := longer[k]) == few:
            break
        rest[few:m] += values.take(order[first[few:m] + k], 0)
    out[:n] += rest
    return out, by


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words of texts, A-Z in lower case; white space is ASCII's. Of each word its text and its
    place among the distinct words, and these, as UTF-8. The end of a text is not among them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    found = lists.flatten().dictionary_encode()
    at, names = found.indices.to_numpy(zero_copy_only=False), found.dictionary.cast(pa.binary())
    none = pc.index(names, pa.scalar(b"", pa.binary())).as_py()  # beside white space at the ends of a text
    if none >= 0:
        names = pa.concat_arrays([names[:none], names[none + 1 :]])
        owner, at = owner[at != none], at[at != none]
        at = at - (at > none)
    return owner, at, names


def bucket(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAILS


def counted(texts: DataFrame) -> DataFrame:
    """(token binary, n) over all texts, ends included; summed in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, times, n = [], [], 0

        def met() -> pa.RecordBatch:
            found = pa.concat_arrays(held).dictionary_encode()
            total = np.bincount(found.indices.to_numpy(), np.concatenate(times)).astype(np.int64)
            return pa.RecordBatch.from_arrays([found.dictionary, pa.array(total)], ["token", "n"])

        for batch in chunks(batches, "text"):
            _, at, names = tokens(batch.column(0))
            held += [names, pa.array([b""], pa.binary())]
            times += [np.bincount(at, minlength=len(names)), [batch.num_rows]]
            n += len(names) + 1
            if n > 2 * FLUSH:
                made = met()
                held, times, n = [made.column(0)], [made.column(1).to_numpy()], made.num_rows
                if n > FLUSH:
                    yield made
                    held, times, n = [], [], 0
        if held:
            yield met()

    return texts.mapInArrow(run, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    words: list[bytes]  # the most frequent tokens but the end, most frequent first
    counts: np.ndarray  # of them
    ends: int
    total: int
    distinct: int
    tail_n: np.ndarray  # tokens of each bucket
    tail_v: np.ndarray  # distinct tokens of each bucket
    sizes: Sizes

    def contexts(self) -> np.ndarray:
        """Of each of the words, by which its outcome is known too."""
        tail = self.sizes.hashes(self.words[self.sizes.words :])
        return np.r_[1 : min(self.sizes.words, len(self.words)) + 1, tail].astype(np.uint32)


def vocabulary(counts: DataFrame) -> Vocabulary:
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    ends = counts.where(F.length("token") == 0).select("n").first()
    words = counts.where(F.length("token") > 0)
    sizes = Sizes.of(sums["n"] or 0)
    # by a histogram of counts, the least count that no more than HEAD words (or outcomes, if more) have
    eighth = F.floor(F.log2("n") * 8).cast("int")
    found = words.groupBy(eighth.alias("e")).agg(F.count("*").alias("v"), F.min("n").alias("least")).collect()
    least, room = None, max(HEAD, sizes.outcomes) if sizes.leaves > 1 else HEAD
    for r in sorted(found, key=lambda r: -r["e"]):
        room -= r["v"]
        if room < 0:
            break
        least = r["least"]
    top = words.where(F.col("n") >= least).collect() if least else []
    top = sorted(top, key=lambda r: (-r["n"], bytes(r["token"])))
    tail = F.pmod(F.crc32(F.substring("token", -2, 2)), F.lit(TAILS)).alias("bucket")
    tail_n, tail_v = np.zeros(TAILS), np.zeros(TAILS)
    for r in words.groupBy(tail).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        tail_n[r["bucket"]], tail_v[r["bucket"]] = r["n"], r["v"]
    names = [bytes(r["token"]) for r in top]
    for word, r in zip(names[: sizes.words], top):
        tail_n[bucket(word)] -= r["n"]
        tail_v[bucket(word)] -= 1
    number = np.array([r["n"] for r in top], np.int64)
    return Vocabulary(names, number, ends["n"] if ends else 0, sums["n"] or 0, sums["v"], tail_n, tail_v, sizes)


ENCODED = (
    "key bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, logs double, tail_logs double, "
    "contexts binary, rare array<binary>, times array<int>"
)
ENCODED_NAMES = [x.split()[0] for x in ENCODED.split(", ")]


def coder(words: Vocabulary) -> Callable[[pa.Array], list[pa.Array]]:
    """From texts to the columns of ``ENCODED`` after the first three. Words are looked up once for all texts."""
    table, context, logs = pa.array(words.words, pa.binary()), words.contexts(), np.log10(words.counts + 1.0)
    sizes, end = words.sizes, float(np.log10(words.ends + 1))

    def run(texts: pa.Array) -> list[pa.Array]:
        owner, at, names = tokens(texts)
        place = pc.index_in(names, table).fill_null(-1).to_numpy()
        have = place >= 0
        out, log, tail = np.zeros(len(names), np.uint32), np.zeros(len(names)), np.zeros(len(names))
        out[have], log[have] = context[place[have]], logs[place[have]]
        tail[place >= sizes.words] = log[place >= sizes.words]
        out[~have] = sizes.hashes(names.filter(pa.array(~have)).to_numpy(zero_copy_only=False))
        size = np.bincount(owner, minlength=len(texts))
        every = np.zeros(len(at) + len(texts), np.uint32)  # with the ends
        every[np.arange(len(at)) + owner] = out[at]
        ends = np.r_[0, 4 * np.cumsum(size + 1)].astype(np.int32)
        contexts = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(every)])
        rare = ~have[at]
        pair, times = np.unique(owner[rare] * len(names) + at[rare], return_counts=True)
        of, which = np.divmod(pair, max(1, len(names)))
        start = pa.array(np.r_[0, np.cumsum(np.bincount(of, minlength=len(texts)))].astype(np.int32))
        known = size - np.bincount(owner[rare], minlength=len(texts)) + (words.ends > 0)
        return [
            pa.array(size + 1), pa.array(known), pa.array(np.bincount(owner, log[at], len(texts)) + end),
            pa.array(np.bincount(owner, tail[at], len(texts)).astype(float)), contexts,
            pa.ListArray.from_arrays(start, names.take(pa.array(which))),
            pa.ListArray.from_arrays(start, pa.array(times.astype(np.int32))),
        ]

    return run


def encoded(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """Each text as contexts, by which its outcomes are known, with the sums that its frequent words give and its rare words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, row = coder(words), TaskContext.get().partitionId() << 40
        for batch in chunks(batches, "text"):
            key = pa.array(np.arange(row, row + batch.num_rows))
            yield pa.RecordBatch.from_arrays([key, *batch.columns[:2], *code(batch.column(2))], ENCODED_NAMES)
            row += batch.num_rows

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, ENCODED)


def triples(texts: list[np.ndarray], sizes: Sizes) -> tuple[np.ndarray, np.ndarray]:
    """(word before last, word before, outcome) of each position as one number, and its text."""
    one = np.concatenate(texts).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    before = np.r_[sizes.start, one[:-1]]
    first = np.r_[True, owner[1:] != owner[:-1]]
    before[first] = sizes.start
    skipped = np.r_[sizes.start, before[:-1]]
    skipped[first] = sizes.start
    return (skipped * sizes.contexts + before) * sizes.outcomes + sizes.outcome(one), owner


class Model:
    """Tables of the softmaxes. ``weights`` has the rows of the first (bigrams, skips, hashed
    trigrams), then the hashed rows of the others."""

    ROWS = Sizes().rows

    def __init__(self, bias: np.ndarray, weights: np.ndarray, sizes: Sizes = Sizes()):
        self.weights, self.sizes = np.ascontiguousarray(weights), sizes
        self.bias = []  # of each level the log counts of the children of each node
        below = bias.astype(np.float32)  # log counts of outcomes
        for width in reversed(sizes.widths):
            below = below.reshape(-1, width)
            self.bias.insert(0, below)
            top = below.max(1)
            below = np.log(np.exp(below - top[:, None]).sum(1)) + top

    def rows(self, triple: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each level the node, the place among its children, and the rows."""
        sizes = self.sizes
        context, outcome = split(triple, sizes.outcomes)
        skipped, before = split(context, sizes.contexts)
        rarer = np.stack([np.where(x > sizes.start, x, 0) * 2 + i for i, x in enumerate((before, skipped))])
        before, skipped = sizes.outcome(before), sizes.outcome(skipped)
        context = (skipped * (sizes.start + 1) + before).astype(np.uint64)
        mixed = ((context * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64)
        three = np.stack([before * 3, skipped * 3 + 1, mixed * 3 + 2])
        free = 2 * (sizes.start + 1) + sizes.trigrams  # the first hashed row
        span, nodes = sizes.outcomes, 1
        for level, width in enumerate(sizes.widths):
            node, span = outcome // span, span // width

            def hashed(x: np.ndarray, low: int, n: int) -> np.ndarray:  # n: a power of two
                seed = (x * (2 * sizes.outcomes) + (nodes + node)).view(np.uint64)
                return ((seed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).view(np.int64) & n - 1) + low

            if level:
                rows = hashed(three, free, MEMBERS * sizes.leaves)
            else:
                rows = np.stack([before, sizes.start + 1 + skipped, 2 * (sizes.start + 1) + split(mixed, sizes.trigrams)[1]])
            words = hashed(rarer, free + MEMBERS * sizes.leaves, RARER * sizes.leaves)
            yield node, split(outcome // span, width)[1], np.concatenate([rows, words])
            nodes *= width

    @staticmethod
    def soft(logit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """In proportion to the probabilities, and their sums."""
        with np.errstate(over="ignore"):
            made = np.exp(logit)
        total = made @ np.ones(logit.shape[1], made.dtype)
        if not (total.min() > 1e-3 and total.max() < 1e30):  # else the largest logit need not be taken off
            made = np.exp(logit - logit.max(1, keepdims=True))
            total = made.sum(1)
        return made, total

    def parts(self, triple: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each level the place as one of all places, the rows, and as ``soft`` has them the
        probabilities of a node's places."""
        for bias, (node, place, rows) in zip(self.bias, self.rows(triple)):
            logit, width = bias.take(node, 0), bias.shape[1]
            table = self.weights.reshape(-1, width)  # of a row only the places that the nodes of this level have
            for x in rows:
                logit += table.take(x * (SIZE // width), 0)
            place += np.arange(0, logit.size, width)
            yield place, rows, *self.soft(logit)

    def logs(self, triple: np.ndarray) -> np.ndarray:
        """log10 of the probability of each triple's outcome, some at a time that a core's cache holds."""
        out = np.zeros(len(triple))
        for low in range(0, len(triple), SCORED):
            for place, _, found, total in self.parts(triple[low : low + SCORED]):
                out[low : low + SCORED] += np.log10(found.reshape(-1)[place] / total)
        return out

    def learn(self, triple: np.ndarray, times: np.ndarray, squares: np.ndarray, touched: np.ndarray) -> None:
        """One descent over distinct triples, with steps scaled by each row's past gradients."""
        random = np.random.default_rng(len(triple)).permutation(len(triple))
        for low in range(0, len(triple), BATCH):
            some = np.sort(random[low : low + BATCH])
            n, steps = times[some].astype(np.float32), []
            several = np.flatnonzero(n != 1)
            for place, every, gap, total in self.parts(triple[some]):
                gap /= total[:, None]
                gap.reshape(-1)[place] -= 1
                gap[several] *= n[several, None]
                steps.append((every, gap))
            every = np.concatenate([x.reshape(-1) for x, _ in steps])
            np.add.at(touched, every, np.tile(n, len(every) // len(n)).astype(touched.dtype))
            for every, gap in steps:
                table = self.weights.reshape(-1, gap.shape[1])
                for rows in every:
                    order, row, start = runs(rows)
                    slope, by = sums(gap, order, start)
                    row = row[by]
                    square = squares[row] + np.einsum("ij,ij->i", slope, slope) / np.float32(SIZE)
                    squares[row] = square
                    slope *= (-RATE / np.sqrt(square + 1.0))[:, None]
                    row *= SIZE // gap.shape[1]
                    slope += table.take(row, 0)
                    table[row] = slope


def texts_of(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[list[pa.RecordBatch], list[np.ndarray]]]:
    """Rows until they have about a million positions, with their contexts."""
    for batch in batches:
        texts = [np.frombuffer(x.as_buffer(), np.uint32) for x in batch.column(column)]
        low, n = 0, 0
        for i, x in enumerate(texts):
            n += len(x)
            if n >= POSITIONS or i == len(texts) - 1:
                yield batch.slice(low, i + 1 - low), texts[low : i + 1]
                low, n = i + 1, 0


def train(rows: DataFrame, words: Vocabulary) -> Model:
    """Fit the tables to the training rows of ``rows`` (held_out, contexts)."""
    sizes = words.sizes
    bias = np.zeros(sizes.outcomes)
    bias[0] = words.ends
    bias[1 : len(words.counts[: sizes.words]) + 1] = words.counts[: sizes.words]
    bias[sizes.outcomes - TAILS :] = words.tail_n + words.tail_v + 1
    bias = np.log(bias + 0.5)
    blocks = BLOCKS * sizes.leaves
    weights, step = None, -(-sizes.rows // blocks)
    # tables of all tasks are summed: not more tasks than tokens are worth it
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, words.total // (TOKENS_A_ROW * sizes.rows))
    known = rows.where("NOT held_out").select("contexts").coalesce(tasks)
    for _ in range(ROUNDS):
        begin = weights

        def run(batches: Iterator[pa.RecordBatch], begin=begin) -> Iterator[pa.RecordBatch]:
            model = Model(bias, np.zeros((sizes.rows, SIZE), np.float32) if begin is None else begin.copy(), sizes)
            squares, touched = np.zeros(sizes.rows, np.float32), np.zeros(sizes.rows)  # counts beyond 2^24 stay exact
            held, n = [], 0
            for _, texts in texts_of(batches, 0):
                held += [x.copy() for x in texts]
                n += sum(map(len, texts))
                if n >= POSITIONS:
                    model.learn(*np.unique(triples(held, sizes)[0], return_counts=True), squares, touched)
                    held, n = [], 0
            if held:
                model.learn(*np.unique(triples(held, sizes)[0], return_counts=True), squares, touched)
            for i in range(blocks if touched.any() else 0):
                part = slice(i * step, (i + 1) * step)
                moved = model.weights[part] - (0 if begin is None else begin[part])
                moved = np.c_[moved * touched[part, None], touched[part]].astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([moved.tobytes()], pa.binary())], ["block", "data"]
                )

        found = summed(known.mapInArrow(run, "block int, data binary"), "float32")
        if found:
            moved = np.concatenate([found[i].reshape(-1, SIZE + 1) for i in range(blocks)])
            weights = (0 if begin is None else begin) + moved[:, :SIZE] / np.maximum(moved[:, SIZE:], 1e-9)
    return Model(bias, np.zeros((sizes.rows, SIZE), np.float32) if weights is None else weights, sizes)


def scored(rows: DataFrame, model: Model, words: Vocabulary) -> DataFrame:
    """The rows with ``made``: log10 of the outcomes' probabilities and of the shares that tail
    words have of one count in their bucket."""
    sizes = words.sizes
    shares = np.zeros(sizes.outcomes)
    shares[sizes.outcomes - TAILS :] = np.log10(words.tail_n + words.tail_v + 1)
    names = ["key", "doc_id", "held_out", "n_tokens", "known", "logs", "tail_logs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(batches, len(names)):
            triple, owner = triples(texts, sizes)
            distinct, at = np.unique(triple, return_inverse=True)
            log = model.logs(distinct) - shares[distinct % sizes.outcomes]
            made = np.bincount(owner, log[at], minlength=len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(made)], [*names, "made"])

    kind = "key bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, logs double, tail_logs double, made double"
    return rows.select(*names, "contexts").mapInArrow(run, kind)


def score_held_out(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of
    ``docs`` (doc_id, text); learned from the rows whose crc32(doc_id) modulo 7 is not 2.

    Null texts are empty and have their end alone. A null doc_id is learned from and not held
    out. Repeated rows count each time. Without training texts every token is unknown.
    """
    held = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False)).alias("held_out")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held, F.coalesce("text", F.lit("")).alias("text"))
    counts = staged(counted(docs.where("NOT held_out").select("text")), "counts")
    words = vocabulary(counts)
    rows = staged(encoded(docs, words), "encoded")
    model = train(rows, words)
    made = staged(scored(rows, model, words), "scored")
    rare = rows.select("key", F.explode(F.arrays_zip("rare", "times")).alias("r"))
    rare = rare.select("key", F.col("r.rare").alias("token"), F.col("r.times").alias("times"))
    rare = rare.join(counts, "token").groupBy("key").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_logs"), F.sum("times").alias("rare_known")
    )
    both = made.join(rare, "key", "left")
    rare_logs, total = F.coalesce("rare_logs", F.lit(0.0)), float(words.total + words.distinct + 1)
    base = F.col("logs") + rare_logs - F.col("n_tokens") * F.log10(F.lit(total))
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(words.total)).cast("bigint").alias("train_tokens"), base.alias("base_score"),
        (F.col("made") + F.col("tail_logs") + rare_logs).alias("score"),
    )
