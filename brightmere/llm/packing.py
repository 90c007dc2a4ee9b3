"""Packing documents into token windows that keep a mixture of sources.

Deficit round-robin over source queues: in each round a queue's credit grows by its quantum
(its share of a window, in 4096ths of a token); the whole tokens of its credit are served and
the fraction stays as its deficit. The served tokens of all rounds, queue after queue, form one
stream, and each window takes the next 2048 of it, so every window holds the target proportions
to about a token for each source and only the last window can be short. Because a queue's credit after t rounds
is a plain product, the round and the place of any token follow from its position in its queue:
deficits carry over windows and over partitions without a sequential pass.

A queue is the documents of one source in the order of the staged partitions. Queue lengths by
partition are summed with a window, so a source that holds most rows is spread like any other.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightmere.llm.common import chunks, once, staged

SCALE = 12  # bits of a quantum below one token

TOKENS = "part int, doc_id bigint, source string, n bigint, begin bigint, ids binary"
PIECES = (
    "doc_id bigint, source string, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


class Encoder:
    """Ids of whole texts by a byte-level BPE given as a JSON file of ``tokenizers``.

    Texts are encoded whole. Wherever a text holds one of the file's added tokens (of several that
    begin there the longest), it is cut, and the token's own id stands between the ids of the parts.
    """

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        plain = model["pre_tokenizer"] == model["pre_tokenizer"] | {
            "type": "ByteLevel", "add_prefix_space": False, "use_regex": True
        }
        if model["model"]["type"] != "BPE" or not plain or model["normalizer"] or len(model["model"]["vocab"]) > 65535:
            raise ValueError("a byte-level BPE without normalizer and of fewer than 65,536 ids is needed")
        added = model.get("added_tokens") or []
        other = any(x.get(flag) for x in added for flag in ("lstrip", "rstrip", "single_word"))
        # those with and those without the flag "normalized" are searched one kind after the other
        other = other or len({bool(x.get("normalized")) for x in added}) > 1
        known = dict(model["model"]["vocab"])
        for x in added:  # tokenizers numbers them itself, whatever the file says
            other = other or x["id"] != known.setdefault(x["content"], len(known)) or x["id"] > 65535
        if other:
            raise ValueError("added tokens need plain flags, of one kind, and the next ids below 65,536")
        self.added = {x["content"]: np.array([x["id"]], np.uint16).tobytes() for x in added if x["content"]}
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        # the byte alphabet of byte-level vocabularies: visible Latin-1 stands for itself
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        code = {chr(b): b for b in shown}
        code |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        ranks = {bytes(code[c] for c in word): i for word, i in model["model"]["vocab"].items()}
        made = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode = made.encode_ordinary

    def ids(self, text: str) -> bytes:
        if not any(x in text for x in self.added):
            return self.plain(text)
        # odd places are added tokens
        parts = enumerate(self.cut.split(text))
        return b"".join(self.added[part] if i % 2 else self.plain(part) for i, part in parts)

    def plain(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        return np.array(self.encode(text), np.uint16).tobytes()


def tokenise(docs: DataFrame, tokenizer: str, end: int = 1) -> DataFrame:
    """The ids of each document with the end id, as little-endian 16-bit numbers, the partition
    and the place of its first id among the ids of its source in that partition."""
    last = np.array([end], np.uint16).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(f"encoder {tokenizer}", lambda: Encoder(tokenizer))
        part, seen = TaskContext.get().partitionId(), {}
        for batch in chunks(batches, "text"):
            sources = batch.column(1).to_pylist()
            ids = [encoder.ids(x) + last for x in batch.column(2).to_pylist()]
            sizes = [len(x) // 2 for x in ids]
            begin = []
            for source, n in zip(sources, sizes):
                begin.append(seen.get(source, 0))
                seen[source] = begin[-1] + n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(ids), pa.int32()), batch.column(0), batch.column(1),
                    pa.array(sizes, pa.int64()), pa.array(begin, pa.int64()), pa.array(ids, pa.binary()),
                ],
                ["part", "doc_id", "source", "n", "begin", "ids"],
            )

    texts = docs.select(
        F.col("doc_id").cast("bigint"), F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return texts.mapInArrow(run, TOKENS)


class Rounds:
    """Where the tokens of each queue go: ``lengths`` and ``shares`` by queue."""

    def __init__(self, lengths: list[int], shares: list[float], window: int):
        self.window = window
        self.lengths = np.array(lengths, np.int64)
        total = sum(shares) or 1.0
        self.quanta = np.array([max(1, round((window << SCALE) * s / total)) for s in shares], np.int64)

    def served(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens of each queue (columns) served after so many rounds (rows)."""
        return np.minimum(self.lengths, (rounds[:, None] * self.quanta) >> SCALE)

    def places(self, queue: int, begin: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cuts of the tokens begin .. begin + n of a queue: start, length, place in the stream."""
        token = np.arange(begin, begin + n, dtype=np.int64)
        quantum = int(self.quanta[queue])
        turn = (((token + 1) << SCALE) + quantum - 1) // quantum  # first round that serves it
        start = np.flatnonzero(np.diff(turn, prepend=turn[0] - 1))
        turns = turn[start]
        before, after = self.served(turns - 1), self.served(turns)
        place = after[:, :queue].sum(1) + before[:, queue:].sum(1) + (token[start] - before[:, queue])
        # and at the ends of windows; a round serves little more than a window
        size = np.diff(start, append=n)
        while True:
            room = self.window - place % self.window
            over = size > room
            if not over.any():
                return start, size, place
            more = (start[over] + room[over], size[over] - room[over], place[over] + room[over])
            size = np.where(over, room, size)
            start, size, place = (np.concatenate(x) for x in zip((start, size, place), more))
            order = np.argsort(start, kind="stable")
            start, size, place = start[order], size[order], place[order]


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end: int = 1,
         targets: dict[str, float] | None = None) -> DataFrame:
    """Pieces of documents in windows of ``window`` tokens: doc_id, source, start, length, ids
    (little-endian unsigned 32 bit), doc_tokens, sequence_id, offset.

    ``targets`` gives the wanted share of each source in every window; without it the sources'
    own shares of the tokens hold, and all queues end together. A source that is not named gets
    its own share of what the others leave. When a queue ends, the others go on in proportion.
    All windows are full but the last. Null texts are empty and have the end id alone; null
    sources form one queue; a repeated row is packed each time; no rows give no pieces. What the
    driver holds is one length for each source.
    """
    tokens = staged(tokenise(docs, tokenizer, end), "tokens")
    parts = tokens.groupBy("part", "source").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("source").orderBy("part")
    parts = staged(parts.select("part", "source", "n", (F.sum("n").over(order) - F.col("n")).alias("first")), "queues")
    queues = {r["source"]: r["n"] for r in parts.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    names = sorted(queues)
    whole = sum(queues.values())
    named = targets or {}
    left, rest = max(0.0, 1.0 - sum(named.values())), sum(n for s, n in queues.items() if s not in named)
    shares = [named[s] if s in named else (left if named else 1.0) * queues[s] / (rest if named else whole) for s in names]
    rounds = Rounds([queues[s] for s in names], shares, window)
    at = {s: i for i, s in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for low in range(0, whole_batch.num_rows, 256):
                batch = whole_batch.slice(low, 256)
                rows, starts, sizes, places, data = [], [], [], [], []
                columns = [batch.column(i).to_pylist() for i in range(4)]
                for i, (source, n, begin, ids) in enumerate(zip(*columns)):
                    start, size, place = rounds.places(at[source], begin, n)
                    wide = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                    data += [wide[4 * a : 4 * (a + b)] for a, b in zip(start.tolist(), size.tolist())]
                    rows.append(np.full(len(start), i))
                    starts.append(start)
                    sizes.append(size)
                    places.append(place)
                row, place = pa.array(np.concatenate(rows)), np.concatenate(places)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(4).take(row), batch.column(0).take(row), pa.array(np.concatenate(starts)),
                        pa.array(np.concatenate(sizes)), pa.array(data, pa.binary()), batch.column(1).take(row),
                        pa.array(place // window), pa.array(place % window),
                    ],
                    ["doc_id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

    placed = tokens.join(parts.select("part", "source", "first"), ["part", "source"])
    placed = placed.select("source", "n", (F.col("begin") + F.col("first")).alias("begin"), "ids", "doc_id")
    return placed.mapInArrow(run, PIECES)


def windows(pieces: DataFrame) -> DataFrame:
    """One row for each window: sequence_id, length, ids in order. A group is one window."""
    each = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("pieces")
    )
    joined = F.aggregate("pieces", F.lit(b"").cast("binary"), lambda held, x: F.concat(held, x["ids"]))
    return each.select("sequence_id", "length", joined.alias("ids"))


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with crc32 of their ids in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source"
    )
