"""Prefix trie of conversations by whole-sequence collapse.

Conversations that are equal turn by turn become one weighted sequence with a list of its ends.
A sequence that is a proper prefix of another (anti-join against all inner prefixes) is no leaf.
Nodes are the different prefixes, found by grouping the prefixes of the weighted sequences.

A turn is known by the SHA-256 of its role and text, a prefix by the exclusive or of 120-bit
SHA-256 digests of (place, turn), which is a running value and can be taken block by block: texts
are read once and never travel, and a conversation of any length is spread over tasks by
blocks of turns. Sums over subtrees need no pairs of nodes and ancestors: every node belongs to
the leaf of least conv_id below it, the nodes of a leaf are the end of its path, and a subtree
is that part of its own leaf's path plus the nodes of all other leaves below.

Defined cases: a null role or text is empty. Turns go by ``turn`` (null first), equal ones by
role and then by the SHA-256 of the text; repeated rows are turns of their own. Rows without
conv_id are left out. An empty table has no nodes, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightmere.llm.common import staged

# Turns of one conversation that one task orders, and bits of conv_id that share a piece of a list of ends.
BLOCK = 1024
PIECE_BITS = 16
KEY = ["depth", "a", "b"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, digest, size) of every turn: its place from 1, the SHA-256 of role and
    text, the code points of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        F.sha2(text, 256).alias("sha"),
        F.length(text).cast("bigint").alias("size"),
    )
    digest = F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "sha"), 256)
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**63))))
    order = F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha")
    here = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy(*order))
    rows = rows.select("conv_id", "block", here.alias("here"), digest.alias("digest"), "size")
    before = _before(rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n")), ["conv_id"], {"n": F.sum})
    return rows.join(before, ["conv_id", "block"]).select(
        "conv_id", (F.col("here") + F.col("n")).alias("place"), "digest", "size"
    )


def _before(totals: DataFrame, keys: list[str], found: dict) -> DataFrame:
    """Totals by ``keys`` and block, each replaced by what the blocks before it add up to."""
    earlier = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, "block", *[F.coalesce(f(c).over(earlier), F.lit(0)).alias(c) for c, f in found.items()])


def _running(rows: DataFrame, keys: list[str], place: Column, found: dict) -> DataFrame:
    """Columns of ``rows`` replaced by their running value by ascending ``place``: within blocks
    of places by a window, from block to block by the blocks' totals."""
    rows = rows.withColumns({"here": place, "block": F.floor(place / BLOCK)})
    to_here = Window.partitionBy(*keys, "block").orderBy("here")
    before = _before(rows.groupBy(*keys, "block").agg(*[f(c).alias(c) for c, f in found.items()]), keys, found)
    before = before.withColumnsRenamed({c: f"{c}_before" for c in found})
    rows = rows.withColumns({c: f(c).over(to_here) for c, f in found.items()})
    both = {c: F.col(c).bitwiseXOR(F.col(f"{c}_before")) if f is F.bit_xor else F.col(c) + F.col(f"{c}_before") for c, f in found.items()}
    joined = rows.join(before, [*keys, "block"]).withColumns(both)
    return joined.drop("here", "block", *[f"{c}_before" for c in found])


def rebuilt(rows: DataFrame, heads: int = 6, every: int = 100) -> tuple[DataFrame, DataFrame]:
    """Conversations with the opening of the first of their hundred.

    Conversation c gets the first h = crc32(c) % ``heads`` turns of c - c % ``every`` (fewer, if
    that has fewer or is absent) and then its own turns after its first h. ``rows`` are those of
    ``turns``; the result is rows (conv_id, depth, digest, size) and (conv_id, length) of every
    conversation, turnless ones included.
    """
    convs = rows.groupBy("conv_id").agg(F.max("place").alias("n")).select(
        "conv_id",
        "n",
        (F.col("conv_id") - F.col("conv_id") % every).alias("first"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
    )
    known = convs.select(F.col("conv_id").alias("first"), F.col("n").alias("opening"))
    convs = convs.join(known, "first", "left").withColumn("head", F.least("h", F.coalesce("opening", F.lit(0))))
    opening = rows.where(F.col("place") < heads).withColumnsRenamed({"conv_id": "first"})
    opening = convs.select("conv_id", "first", "h").join(opening, "first").where("place <= h")
    own = rows.join(convs.select("conv_id", "h", "head"), "conv_id").where("place > h")
    made = opening.select("conv_id", F.col("place").alias("depth"), "digest", "size").unionByName(
        own.select("conv_id", (F.col("place") - F.col("h") + F.col("head")).alias("depth"), "digest", "size")
    )
    length = F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return made, convs.select("conv_id", length.alias("length"))


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, up_a, up_b, size) of every turn: the names of the prefix that ends
    with it and of the one before."""
    named = F.sha2(F.concat(F.col("depth"), F.lit(":"), F.col("digest")), 256)
    part = {c: F.conv(F.substring(named, at, 15), 16, 10).cast("bigint") for c, at in (("a", 1), ("b", 16))}
    rows = rows.select("conv_id", "depth", "size", *[v.alias(c) for c, v in part.items()])
    rows = rows.withColumns({"up_a": F.col("a"), "up_b": F.col("b")})
    rows = _running(rows, ["conv_id"], F.col("depth"), {"a": F.bit_xor, "b": F.bit_xor})
    up = {"up_a": F.col("a").bitwiseXOR(F.col("up_a")), "up_b": F.col("b").bitwiseXOR(F.col("up_b"))}
    return rows.withColumns(up)


def ends(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b): the prefix that is the whole conversation."""
    last = rows.join(lengths, "conv_id").where("depth = length").select("conv_id", *KEY)
    root = lengths.where("length = 0").select("conv_id", *[F.lit(0).cast("bigint").alias(c) for c in KEY])
    return last.unionByName(root)


def sequences(ended: DataFrame) -> DataFrame:
    """(conv_id, n_convs, depth, a, b) of every different conversation: the least conv_id, how
    many conversations are equal, its length and name."""
    return ended.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))


def end_lists(ended: DataFrame) -> DataFrame:
    """(depth, a, b, part, ids): the conversations that end at a prefix, ascending and joined by
    commas, in ascending pieces of at most 65536 neighbouring conv_ids."""
    part = F.shiftright("conv_id", PIECE_BITS).alias("part")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    return ended.groupBy(*KEY, part).agg(ids.alias("ids"))


def end_hashes(lists: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): the pieces of a prefix hashed one after the other."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            keys = zip(*[batch.column(c).to_pylist() for c in KEY])
            for key, ids in zip(keys, batch.column("ids")):
                if key != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_buffer())
            yield _batch(done)
        if now is not None:
            yield _batch([(*now, state.hexdigest())])

    dealt = lists.repartition(*KEY).sortWithinPartitions(*KEY, "part")
    return dealt.mapInArrow(hashed, "depth bigint, a bigint, b bigint, ends_sha256 string")


def _batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*KEY, "ends_sha256"])


def nodes(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """The trie of conversations given as (conv_id, depth, digest, size) and (conv_id, length).

    One row for each node: conv_id (least member), depth, parent_conv_id, n_convs (members),
    n_children, n_leaves (childless nodes of its subtree), saved_tokens (code points that storing
    the subtree's turns once saves), ends_sha256 (of the comma-joined conv_ids that end here), and
    a, b, the node's name. The last turn of a node is turn ``depth`` of conversation ``conv_id``.
    """
    named = staged(prefixes(rows), "prefixes")
    ended = staged(ends(named, lengths), "ends")
    whole = staged(sequences(ended), "sequences")
    # Prefixes of the weighted sequences, the root among them.
    weighed = whole.select("conv_id", "n_convs", F.col("depth").alias("length"))
    path = named.join(weighed, "conv_id").unionByName(
        weighed.select("*", *[F.lit(0).cast("bigint").alias(c) for c in [*KEY, "up_a", "up_b", "size"]])
    )
    path = staged(path, "paths")
    inner = path.where("depth < length").select(*KEY).distinct()
    leaves = whole.join(inner, KEY, "left_anti").select("conv_id")
    below = staged(path.join(leaves, "conv_id").select("conv_id", *KEY), "leaves")
    found = path.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        *[F.min(c).alias(c) for c in ("size", "up_a", "up_b")],
    )
    under = below.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_leaves"), F.min("conv_id").alias("owner"))
    found = staged(found.join(under, KEY).withColumn("saved", (F.col("n_convs") - 1) * F.col("size")), "nodes")
    # A node's own leaf brings the rest of its path, every other leaf below all its nodes.
    total = found.groupBy("owner").agg(F.sum("saved").alias("total")).withColumnRenamed("owner", "conv_id")
    others = below.join(total, "conv_id").groupBy(*KEY).agg(
        (F.sum("total") - F.min_by("total", "conv_id")).alias("others")
    )
    rest = _running(found.select("owner", *KEY, "saved"), ["owner"], -F.col("depth"), {"saved": F.sum}).drop("owner")
    up = [(F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")]
    children = found.where("depth > 0").groupBy(*up).agg(F.count(F.lit(1)).alias("n_children"))
    parent = found.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    result = (
        found.drop("saved").join(rest, KEY).join(others, KEY)
        .join(children, KEY, "left").join(end_hashes(end_lists(ended)), KEY, "left")
        .join(parent, ["depth", "up_a", "up_b"], "left")
    )
    return result.select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
        (F.col("saved") + F.col("others")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"), "a", "b",
    )


def trie(conversations: DataFrame) -> DataFrame:
    """``nodes`` of the conversations as they are, without rebuilding."""
    rows = staged(turns(conversations), "turns")
    lengths = rows.groupBy("conv_id").agg(F.max("place").alias("length"))
    return nodes(rows.withColumnRenamed("place", "depth"), lengths)


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """``nodes`` of the conversations rebuilt by ``rebuilt``."""
    return nodes(*rebuilt(staged(turns(conversations), "turns")))


def leaf_sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, length, n_convs) of the different conversations that no longer one begins with:
    what is left to store or train on when prefixes are shared."""
    rows = staged(turns(conversations), "turns")
    named = staged(prefixes(rows.withColumnRenamed("place", "depth")), "prefixes")
    whole = sequences(ends(named, rows.groupBy("conv_id").agg(F.max("place").alias("length"))))
    last = named.join(whole.select("conv_id", F.col("depth").alias("length")), "conv_id")
    inner = last.where("depth < length").select(*KEY).distinct()
    return whole.join(inner, KEY, "left_anti").select("conv_id", F.col("depth").alias("length"), "n_convs")
