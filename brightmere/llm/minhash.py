"""Near-duplicate documents by BagMinHash.

A document is the multiset of its shingles of five words. Each shingle owns a Poisson process
over time and weight: points come at unit rate for each unit of weight, fall on a random slot of
the signature, and count for a document as far as its multiplicity reaches. The weights are
whole numbers, so the discretisation is exact; the process is generated by dyadic weight
intervals (0, 1], (1, 2], (2, 4] and so on, each as one process whose points are then placed
inside it, so a shingle that occurs a thousand times costs a few processes and not a thousand.
The first time in each slot is equal for two documents with the probability of their weighted
Jaccard similarity. A document needs about m log m points whatever its length, because points
beyond the time by which all slots are filled are never generated.

Signatures are cut into bands; documents that share a band are candidates; candidates are
verified by the overlap of their multisets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightmere.llm.common import bucketed, chunks, components, staged

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 24, 5
SLOTS = BANDS * ROWS
# Candidates whose signatures agree in a smaller share are not verified: at a similarity of 0.8
# a share under 0.58 is six standard deviations away (one pair in a hundred million).
AGREE = 0.58
# A bucket that is compared whole goes in parts of about so many documents and shingles.
PART_DOCS, PART_WEIGHT = 2048, 1 << 18
FAMILY = 6  # bands that share their order of pivots

U = np.uint64
GOLD, FIRST, SECOND = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
POWERS = np.cumprod(np.r_[U(1), np.full((1 << 16) - 1, U(0x5851F42D4C957F2D))])


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> U(30))) * FIRST
    x = (x ^ (x >> U(27))) * SECOND
    return x ^ (x >> U(31))


def stride(k: int) -> np.uint64:
    """``k`` steps of the golden ratio modulo 2**64."""
    return U(k * int(GOLD) & (1 << 64) - 1)


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words of several texts, and the text of each word."""
    texts = [x.lower() for x in texts]
    code = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(x) + 1 for x in texts])
    space = (code == 32) | ((code >= 9) & (code <= 13))
    start = np.flatnonzero(np.diff(space.astype(np.int8), prepend=1) < 0)
    if not len(start):
        return np.empty(0, U), np.empty(0, np.int64)
    rest = slice(start[0], None)
    index = np.arange(start[0], len(code)) - np.repeat(start, np.diff(start, append=len(code)))
    term = np.where(space[rest], U(0), mix(code[rest].astype(U) + GOLD) * POWERS[np.minimum(index, len(POWERS) - 1)])
    return mix(np.add.reduceat(term, start - start[0])), np.searchsorted(ends, start, side="right")


def shingles(texts: list[str]) -> list[np.ndarray]:
    """The hashes of each text's shingles, in their order. A text of one to four words is one
    shingle; a text without words has none."""
    word, owner = words(texts)
    low = np.searchsorted(owner, np.arange(len(texts) + 1))
    made = []
    for a, b in zip(low[:-1], low[1:]):
        n = min(WORDS, b - a)
        held = np.full(b - a - n + 1 if n else 0, U(n))
        for i in range(n):
            held = held * POWERS[1] + word[a + i : a + i + len(held)]
        made.append(mix(held))
    return made


def signatures(bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """BagMinHash signatures (documents x slots) of (distinct shingles, multiplicities); a slot
    holds the bits of the time of its first point."""
    # a process for each shingle and dyadic interval of its weight
    seeds, rates, bases, weights, owners = [], [], [], [], []
    total = np.array([n.sum() for _, n in bags], float)
    for i, (shingle, n) in enumerate(bags):
        level, base, rate = 0, 0, 1
        while len(shingle):
            seeds.append(mix(shingle + stride(level + 1)))
            rates.append(np.full(len(shingle), rate))
            bases.append(np.full(len(shingle), base))
            weights.append(n)
            owners.append(np.full(len(shingle), i))
            level, base, rate = level + 1, base + rate, base + rate
            more = n > base
            shingle, n = shingle[more], n[more]
    out = np.full((len(bags), SLOTS), np.inf)
    if not seeds:
        return out.view(U)
    seed, rate, base, weight, owner = map(np.concatenate, (seeds, rates, bases, weights, owners))
    until = SLOTS * (np.log(SLOTS) + 3) / np.maximum(total, 1)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        chosen = np.zeros(len(bags), bool)
        chosen[todo] = True
        row = np.flatnonzero(chosen[owner])
        time, step = np.zeros(len(row)), 0
        while len(row):
            step += 1
            draw = mix(seed[row] + stride(step))
            time = time - np.log(((draw >> U(11)).astype(float) + 1) * 2.0**-53) / rate[row]
            live = time <= until[owner[row]]
            row, time, draw = row[live], time[live], draw[live]
            spot = mix(draw + SECOND)
            slot = ((spot >> U(32)) * U(SLOTS)) >> U(32)
            place = base[row] + ((spot & U(0xFFFFFFFF)) * rate[row].astype(U) >> U(32)).astype(np.int64)
            hit = place < weight[row]
            np.minimum.at(out.reshape(-1), owner[row[hit]] * SLOTS + slot[hit].astype(np.int64), time[hit])
        todo = todo[np.isinf(out[todo]).any(1)]  # rare: go on to a later time, from the start
        until[todo] *= 2
    return out.view(U)


def bag(shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingle, return_counts=True)


def numbered(shingle: np.ndarray) -> np.ndarray:
    """A multiset as a sorted set: the k-th occurrence of a shingle is an element of its own."""
    distinct, n = bag(shingle)
    again = np.repeat(np.arange(len(distinct)), n)
    count = np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
    return np.sort(np.where(count == 0, distinct[again], mix(distinct[again] + GOLD * count.astype(U))))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two numbered multisets."""
    if not len(a) or not len(b):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprint(shingle: np.ndarray) -> tuple[int, int]:
    """128 bits of a run of shingles; two texts with the same words have the same."""
    if not len(shingle):
        return 0, 0
    place = np.arange(1, len(shingle) + 1, dtype=U) * GOLD
    return int(mix(shingle + place).sum()), int(mix(shingle ^ mix(place)).sum())


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, the fingerprint of its words, its weight, one byte of each slot, and its bands."""
    weigh = POWERS[1 : ROWS + 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1_000_000):
            found = shingles(batch.column(1).to_pylist())
            prints = [fingerprint(x) for x in found]  # equal texts are signed once
            first: dict[tuple[int, int], int] = {}
            for i, p in enumerate(prints):
                first.setdefault(p, i)
            some = list(first.values())
            signed = signatures([bag(found[i]) for i in some])
            band = mix((signed.reshape(len(some), BANDS, ROWS) * weigh).sum(2) + np.arange(1, BANDS + 1, dtype=U) * GOLD)
            at = {p: k for k, p in enumerate(first)}
            rows = [at[p] for p in prints]
            byte = (mix(signed) & U(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), *(pa.array(np.array(x, U).view(np.int64)) for x in zip(*prints)),
                    pa.array([len(s) for s in found], pa.int64()), pa.array([byte[r].tobytes() for r in rows], pa.binary()),
                    pa.array([band[r].view(np.int64) if len(s) else [] for r, s in zip(rows, found)], pa.list_(pa.int64())),
                ],
                ["doc_id", "print_a", "print_b", "weight", "sketch", "bands"],
            )

    texts = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    kind = "doc_id bigint, print_a bigint, print_b bigint, weight bigint, sketch binary, bands array<bigint>"
    return texts.mapInArrow(run, kind)


def promising(pairs: DataFrame, slim: DataFrame) -> DataFrame:
    """Pairs whose weights and signatures allow a similarity of 0.8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SLOTS) for i in (3, 4))
            yield batch.filter(pa.array((x == y).mean(1) >= AGREE)).select([0, 1, 2])

    a = slim.select(F.col("doc_id").alias("a"), F.col("weight").alias("wa"), F.col("sketch").alias("x"))
    b = slim.select(F.col("doc_id").alias("b"), F.col("weight").alias("wb"), F.col("sketch").alias("y"))
    near = pairs.join(a, "a").join(b, "b").where(F.least("wa", "wb") >= SIMILAR * F.greatest("wa", "wb"))
    return near.select("a", "b", "turned", "x", "y").mapInArrow(run, "a bigint, b bigint, turned boolean")


def multisets(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, bag) of the documents ``ids``, staged by doc_id, so that rounds of verification
    move pairs and no bags. Texts are partitioned by doc_id alike at any size."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1_000_000):
            made = [numbered(s).tobytes() for s in shingles(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["doc_id", "bag"])

    texts = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(ids.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return bucketed(texts.mapInArrow(sets, "doc_id bigint, bag binary"), "doc_id", "bags")


def verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """Pairs (a, b) of documents whose multisets overlap by 0.8 or more. Pairs go to the bags of
    the members; the bags of the pivots, few, are dealt anew, so a pivot's pairs may be split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                similarity(np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)) >= SIMILAR
                for x, y in zip(batch.column(2), batch.column(3))
            ]
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    member, pivot = F.when(F.col("turned"), F.col("b")).otherwise(F.col("a")), F.when(F.col("turned"), F.col("a")).otherwise(F.col("b"))
    pairs = pairs.select("a", "b", member.alias("member"), pivot.alias("pivot"))
    wanted = pairs.select(F.col("pivot").alias("doc_id")).distinct()
    held = staged(bags.join(wanted, "doc_id", "left_semi"), "held")
    both = pairs.join(bags.select(F.col("doc_id").alias("member"), F.col("bag").alias("x")), "member")
    both = both.join(held.select(F.col("doc_id").alias("pivot"), F.col("bag").alias("y")), "pivot")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def compared(info: DataFrame, exact: bool) -> DataFrame:
    """Whole buckets, without their pairs being written out. ``info`` has a row for each document:
    doc_id, component, loose, weight, sketch, bands, own (its buckets, each with the number of
    parts of its documents and of its loose ones) and, for ``exact``, bag. Each part of a bucket
    meets each part of the loose documents in one group. Pairs with a loose document, of different
    components, that weights and signatures allow: with ``exact`` those (a, b) whose multisets
    overlap by 0.8 or more, else the documents (id) in any such pair. A pair belongs to the first
    bucket that both have in ``own``."""

    def run(table: pa.Table) -> pa.Table:
        ids, comp, weight, loose, stays, visits = (
            table[c].to_numpy(zero_copy_only=False) for c in ("doc_id", "component", "weight", "loose", "stays", "visits")
        )
        byte = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, SLOTS)
        band = np.array(table["bands"].to_pylist(), np.int64).reshape(-1, BANDS)
        bags = [np.frombuffer(x.as_buffer(), U) for x in table["bag"]] if exact else []
        at, there = table["at"][0].as_py(), np.flatnonzero(stays)
        pairs: list[np.ndarray] = []
        for i in np.flatnonzero(visits):
            other = (comp[there] != comp[i]) & (~loose[there] | (ids[there] > ids[i]))
            near = np.minimum(weight[there], weight[i]) >= SIMILAR * np.maximum(weight[there], weight[i])
            j = there[other & near]
            j = j[(byte[j] == byte[i]).mean(1) >= AGREE]
            j = j[((band[j] == band[i]) & (band[i] != 0)).argmax(1) == at]
            if exact and len(j):
                size = np.array([len(bags[k]) for k in j])
                flat = np.concatenate([bags[k] for k in j])
                place = np.minimum(np.searchsorted(bags[i], flat), len(bags[i]) - 1)
                both = np.add.reduceat(bags[i][place] == flat, np.cumsum(size) - size, dtype=np.int64)
                j = j[both / (len(bags[i]) + size - both) >= SIMILAR]
            if len(j):
                pairs.append(np.stack([np.full(len(j), ids[i]), ids[j]]))
        found = np.concatenate(pairs, 1) if pairs else np.empty((2, 0), np.int64)
        return pa.table({"a": found.min(0), "b": found.max(0)} if exact else {"id": np.unique(found)})

    bucket = info.withColumn("o", F.explode("own"))
    part = F.pmod(F.xxhash64("doc_id"), F.col("o.parts")).cast("int")
    visit = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("o.visits")).cast("int")

    def each(n: str, make) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(n).cast("int") - 1), make)

    def place(p, v, stays: Column, visits: Column) -> Column:
        return F.struct(p.alias("p"), v.alias("v"), stays.alias("stays"), visits.alias("visits"))

    # a document stays in its part, with each part of the loose ones, and a loose one visits the others
    stay = each("o.visits", lambda k: place(part, k, F.lit(True), F.col("loose") & (k == visit)))
    visited = each("o.parts", lambda k: place(k, visit, F.lit(False), F.lit(True)))
    places = F.concat(stay, F.filter(visited, lambda x: F.col("loose") & (x["p"] != part)))
    known = F.transform("bands", lambda b: F.when(F.array_contains(F.col("own.band"), b), b).otherwise(F.lit(0).cast("bigint")))
    bucket = bucket.withColumns({"band": F.col("o.band"), "at": (F.array_position("bands", F.col("o.band")) - 1).cast("int")})
    bucket = bucket.withColumns({"bands": known, "place": F.explode(places)})
    columns = ["doc_id", "component", "loose", "weight", "sketch", "bands", "at", *(["bag"] if exact else [])]
    rows = bucket.select("band", "place.p", "place.v", "place.stays", "place.visits", *columns)
    return rows.groupBy("band", "p", "v").applyInArrow(run, "a bigint, b bigint" if exact else "id bigint")


def remaining(members: DataFrame, loose: DataFrame, heads: DataFrame, found: DataFrame, bags: DataFrame) -> DataFrame:
    """Links (a, b) between documents ``loose`` (band, doc_id) and their whole buckets."""
    known = found.select(F.col("id").alias("doc_id"), "component")
    flags = loose.select("doc_id").distinct().withColumn("loose", F.lit(True))
    rows = members.select("band", "doc_id").join(loose.select("band").distinct(), "band", "left_semi")
    rows = rows.join(heads.select("doc_id", "weight"), "doc_id").join(flags, "doc_id", "left")
    rows = staged(rows.withColumn("loose", F.coalesce("loose", F.lit(False))), "wide")

    def parts(of: Column) -> Column:
        n, weight = F.sum(of.cast("bigint")), F.sum(F.when(of, F.col("weight")).otherwise(0))
        return F.greatest(F.ceil(n / PART_DOCS), F.ceil(weight / PART_WEIGHT), F.lit(1))

    sizes = rows.groupBy("band").agg(parts(F.lit(True)).alias("parts"), parts(F.col("loose")).alias("visits"))
    own = rows.join(sizes, "band").groupBy("doc_id", "loose").agg(F.collect_list(F.struct("band", "parts", "visits")).alias("own"))
    info = own.join(heads, "doc_id").join(known, "doc_id", "left")
    info = staged(info.withColumn("component", F.coalesce("component", "doc_id")), "info")
    # texts' multisets travel for the documents only that some signature is near to
    near = staged(compared(info, False).select(F.col("id").alias("doc_id")).distinct(), "near")
    return compared(info.join(near, "doc_id", "left_semi").join(bags, "doc_id"), True)


def paired(rows: DataFrame, member: str, pivot: str) -> DataFrame:
    """Distinct pairs (a, b), a < b, and whether the pivot is a (turned)."""
    rows = rows.where(F.col(member) != F.col(pivot))
    rows = rows.select(F.least(member, pivot).alias("a"), F.greatest(member, pivot).alias("b"), (F.col(pivot) < F.col(member)).alias("turned"))
    return rows.groupBy("a", "b").agg(F.max("turned").alias("turned"))


def together(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components ``found`` (id, component) with more links (a, b)."""
    if not links.take(1):
        return found
    return components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(links))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): doc_id, class_id (smallest doc_id with the
    same words in order), component_id (smallest doc_id reachable over similarities of 0.8 or
    more), kept (doc_id = component_id).

    Documents with the same words form one class, whose smallest doc_id stands for it from then
    on. In each bucket a pivot is held against all others. Documents of a bucket that stay
    outside of its component are held against three more pivots, and those that still do against
    the whole bucket, part by part, so every pair of a bucket was compared or is connected
    already: a large group of near copies costs two rounds, and no group's pairs are written out.
    Texts without words, null ones too, and rows without doc_id stay alone; rows that repeat a
    doc_id share its class; no rows give no rows.
    """
    signed = staged(sketches(docs), "signed")
    classes = signed.where("weight > 0 AND doc_id IS NOT NULL").groupBy("print_a", "print_b").agg(
        F.min("doc_id").alias("class_id")
    )
    classes = staged(classes, "classes")
    heads = signed.join(classes.select(F.col("class_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    heads = staged(heads.where("weight > 0").select("doc_id", "weight", "sketch", "bands").dropDuplicates(["doc_id"]), "heads")
    slim = heads.select("doc_id", "weight", "sketch")
    rows = heads.select("doc_id", F.posexplode("bands").alias("at", "band"))
    # most bands belong to one document and go before anything else is known of them
    ends = rows.groupBy("band").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = ends.where("low < high").select("band")
    rows = staged(rows.join(shared.hint("merge"), "band", "left_semi"), "shared")
    # the pivots of a bucket are its first documents by hashes that bands of one family share,
    # so the buckets of a group of near copies have few pivots, but not one and the same
    family = F.floor(F.col("at") / FAMILY).cast("int")
    first = [F.min(F.struct(F.xxhash64("doc_id", family, F.lit(i)), "doc_id"))["doc_id"].alias(f"p{i}") for i in range(4)]
    pivots = rows.groupBy("band").agg(F.count("*").alias("n"), *first)
    members = staged(rows.select("doc_id", "band").join(pivots, "band"), "buckets")
    bags = multisets(members.select("doc_id").distinct(), docs)
    tested = staged(promising(paired(members, "doc_id", "p0"), slim), "pairs")
    links = staged(verified(tested, bags), "links")
    found = components(links)

    def apart(rows: DataFrame, *of: str) -> DataFrame:
        """Rows with the component of doc_id (x) and of the columns ``of``, where those of the
        first of them and of doc_id differ."""
        for name, column in zip(("doc_id", *of), ("x", *(f"y{i}" for i in range(len(of))))):
            held = found.select(F.col("id").alias(name), F.col("component").alias(column))
            rows = rows.join(held, name, "left").withColumn(column, F.coalesce(column, name))
        return rows.where("x <> y0")

    # documents that their first pivot doesn't link, in larger buckets, may be linked by others:
    # by three more pivots, and where those fail too, they are held against the whole bucket
    linked = links.select(F.col("a").alias("doc_id"), F.col("b").alias("p0"))
    linked = linked.unionByName(links.select(F.col("b").alias("doc_id"), F.col("a").alias("p0")))
    loose = members.where("n > 2 AND doc_id <> p0").join(linked, ["doc_id", "p0"], "left_anti")
    loose = staged(apart(loose, "p0").select("band", "doc_id", "p0", "p1", "p2", "p3"), "loose")
    if loose.take(1):
        pairs = loose.select("doc_id", F.explode(F.array("p1", "p2", "p3")).alias("held"))
        pairs = paired(apart(pairs.select("doc_id", "held").distinct(), "held"), "doc_id", "held")
        new = staged(promising(pairs.join(tested, ["a", "b"], "left_anti"), slim), "pairs")
        found = together(found, staged(verified(new, bags), "links"))
        loose = staged(apart(loose.select("band", "doc_id", "p0"), "p0"), "loose")
        if loose.take(1):
            found = together(found, staged(remaining(members, loose, heads, found, bags), "links"))
    own = signed.select("doc_id", "print_a", "print_b", "weight").join(classes, ["print_a", "print_b"], "left")
    own = own.withColumn("class_id", F.when(F.col("weight") > 0, F.coalesce("class_id", "doc_id")).otherwise(F.col("doc_id")))
    own = own.join(found.select(F.col("id").alias("class_id"), "component"), "class_id", "left")
    component = F.coalesce("component", "class_id").alias("component_id")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return own.select("doc_id", "class_id", component).withColumn("kept", kept)


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without all but the smallest doc_id of each component; of rows that
    repeat a doc_id one stays. Rows without doc_id stay."""
    found = near_duplicates(docs.select("doc_id", "text"))
    gone = found.where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    rest = docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
    return rest.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(rest.where("doc_id IS NULL"))
