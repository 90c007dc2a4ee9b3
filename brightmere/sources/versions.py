"""Versioned tables on plain Parquet: time travel, history and a change feed.

Every commit is one partition ``_commit_version=N`` of the data folder. An append
adds rows to what earlier commits hold; an overwrite starts the table anew from
its own commit. A commit becomes visible when its row is in the log, which is
written after the data, so a failed write leaves nothing a reader can see and a
retry replaces the half-written partition. The log keeps each commit's layout: an append
may bring new columns (NULL in earlier rows), an overwrite any layout. One writer at a time.
``vacuum`` removes commits that only older versions need.

The log may also keep zones, the least and greatest value of chosen columns in each commit.
Reads of a range skip commits whose zone lies outside of it, and ``retain`` drops wholly expired
commits without reading them and rewrites only those that expire in part.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from brightmere.session import remove_folders

VERSION = "_commit_version"
LOG_LAYOUT = """version BIGINT, operation STRING, rows BIGINT, committed_at TIMESTAMP, layout STRING,
    zones STRING, dropped STRING"""
# Commits that hold rows of the table; those of a retention repeat rows and bring no changes.
HOLDING = ("append", "overwrite", "retain")


def history(spark: SparkSession, root: str) -> DataFrame:
    """One row per visible commit."""
    return _entries(spark, root).drop("layout", "zones", "dropped")


def _entries(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(LOG_LAYOUT).parquet(f"{root}/log")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_LAYOUT)


class Log:
    """The commits of a table, read once: a row for each, and their different layouts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        entries = _entries(spark, root)
        self.rows = sorted(
            entries.select("version", "operation", F.md5("layout").alias("layout"), "zones", "dropped").collect(),
            key=lambda r: (r["version"], r["operation"]),
        )
        self.newest = max((r["version"] for r in self.rows), default=-1)
        self.kept = max((r["version"] for r in self.rows if r["operation"] == "vacuum"), default=0)
        self._layouts: dict[str, StructType] | None = None

    def start(self, version: int) -> int:
        """The commit that the table of a version starts from."""
        return max((r["version"] for r in self.rows if r["operation"] == "overwrite" and r["version"] <= version), default=0)

    def live(self, version: int) -> list[int]:
        """The commits that make up the table of a version."""
        held = [r for r in self.rows if r["operation"] in HOLDING and self.start(version) <= r["version"] <= version]
        dropped = {v for r in held for v in json.loads(r["dropped"] or "[]")}
        return [r["version"] for r in held if r["version"] not in dropped]

    def zone(self, version: int, column: str) -> tuple | None:
        """(least, greatest, has NULLs) of a column in a commit, as texts; None if not known."""
        for r in self.rows:
            if r["version"] == version and r["operation"] in HOLDING and r["zones"]:
                zone = json.loads(r["zones"]).get(column.lower())
                return tuple(zone) if zone else None
        return None

    def layouts(self, versions: list[int]) -> list[StructType]:
        """The different layouts of some commits, the oldest first."""
        if self._layouts is None:
            found = _entries(self.spark, self.root).where("layout IS NOT NULL").select("layout").distinct()
            self._layouts = {hashlib.md5(r[0].encode()).hexdigest(): StructType.fromJson(json.loads(r[0])) for r in found.collect()}
        wanted, made = set(versions), {}
        for r in self.rows:
            if r["version"] in wanted and r["operation"] in HOLDING:
                # A log written before layouts were kept has none: the files tell.
                name = r["layout"] or r["version"]
                if name not in made:
                    made[name] = self._layouts[name] if r["layout"] else self.spark.read.parquet(_folder(self.root, r["version"])).schema
        return list(made.values())


def _folder(root: str, version: int) -> str:
    return f"{root}/data/{VERSION}={version}"


def current_version(spark: SparkSession, root: str) -> int:
    """The newest visible version, or -1 before the first commit."""
    newest = history(spark, root).agg(F.max("version")).first()[0]
    return -1 if newest is None else newest


def _log(
    spark: SparkSession, root: str, version: int, operation: str, rows: int,
    layout: str | None = None, zones: str | None = None, dropped: str | None = None,
) -> None:
    entry = spark.range(0, 1, 1, 1).select(
        F.lit(version).cast("bigint").alias("version"),
        F.lit(operation).alias("operation"),
        F.lit(rows).cast("bigint").alias("rows"),
        F.current_timestamp().alias("committed_at"),
        F.lit(layout).cast("string").alias("layout"),
        F.lit(zones).cast("string").alias("zones"),
        F.lit(dropped).cast("string").alias("dropped"),
    )
    entry.write.mode("append").parquet(f"{root}/log")


def commit(df: DataFrame, root: str, operation: str = "append", zones: Sequence[str] = ()) -> int:
    """Write ``df`` as the next version and return its number.

    An append whose column has another type than in the table is refused. The log keeps the
    least and greatest value of the columns ``zones``, found while the rows are written.
    """
    if operation not in ("append", "overwrite"):
        raise ValueError(f"operation is append or overwrite, not {operation!r}")
    log = Log(df.sparkSession, root)
    if operation == "append" and log.newest >= 0:
        _, conflicts = merged([*log.layouts(log.live(log.newest)), df.schema])
        if conflicts:
            raise ValueError(f"columns of another type than in {root}: {sorted(conflicts)}")
    return _write(df, root, log.newest + 1, operation, zones)


def _write(df: DataFrame, root: str, version: int, operation: str, zones: Sequence[str], dropped: list[int] | None = None) -> int:
    seen, names = Observation(), [z.lower() for z in zones]
    found = [F.count(F.lit(1)).alias("rows")]
    for i, z in enumerate(zones):
        found += [F.min(z).cast("string").alias(f"l{i}"), F.max(z).cast("string").alias(f"h{i}"), F.count_if(F.col(z).isNull()).alias(f"n{i}")]
    df.observe(seen, *found).write.mode("overwrite").parquet(_folder(root, version))
    told = seen.get or {"rows": 0}
    kept = {z: [told.get(f"l{i}"), told.get(f"h{i}"), bool(told.get(f"n{i}"))] for i, z in enumerate(names)}
    _log(
        df.sparkSession, root, version, operation, told["rows"], df.schema.json(),
        json.dumps(kept) if kept else None, json.dumps(dropped) if dropped else None,
    )
    return version


def merged(layouts: list[StructType]) -> tuple[StructType, set[str]]:
    """All columns of ``layouts`` by name, and those that have different types in them."""
    fields, conflicts = {}, set()
    for field in (f for layout in layouts for f in layout.fields):
        known = fields.setdefault(field.name.lower(), StructField(field.name, field.dataType))
        if known.dataType.simpleString() != field.dataType.simpleString():
            conflicts.add(known.name)
    return StructType(list(fields.values())), conflicts


def _read(log: Log, versions: list[int], layout: StructType) -> DataFrame:
    columns = StructType([*layout.fields, StructField(VERSION, LongType())])
    rows = log.spark.read.schema(columns).option("basePath", f"{log.root}/data").parquet(f"{log.root}/data")
    if versions == list(range(min(versions, default=0), max(versions, default=-1) + 1)):
        low, high = (versions[0], versions[-1]) if versions else (0, -1)
        return rows.where((F.col(VERSION) >= low) & (F.col(VERSION) <= high))
    return rows.where(F.col(VERSION).isin(versions))


def _commits(log: Log, versions: list[int]) -> DataFrame:
    """The rows of some commits with the columns of all of them, or with those of the table where
    there are no such commits.

    Where an overwrite in between changed a column's type, the column is text.
    """
    layout, conflicts = merged(log.layouts(versions or log.live(log.newest)))
    if not conflicts:
        return _read(log, versions, layout)
    parts = []
    for start in sorted({log.start(v) for v in versions}):
        held = [v for v in versions if log.start(v) == start]
        own, _ = merged(log.layouts(held))
        rows = _read(log, held, own)
        texts = {f.name: F.col(f"`{f.name}`").cast("string") for f in own.fields if f.name in conflicts}
        parts.append(rows.withColumns(texts) if texts else rows)
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.select(*[f"`{f.name}`" for f in layout.fields], VERSION)


def _outside(log: Log, version: int, kind: str, column: str, low: object, high: object) -> bool:
    """Whether the zone of a commit says that no value lies in a range."""
    zone = log.zone(version, column)
    if zone is None:
        return False
    if zone[0] is None:  # NULLs only
        return True
    known = log.spark.range(1).select(
        (F.lit(zone[1]).cast(kind) < F.lit(low).cast(kind)) if low is not None else F.lit(False),
        (F.lit(zone[0]).cast(kind) > F.lit(high).cast(kind)) if high is not None else F.lit(False),
    )
    return any(known.first())


def read_version(
    spark: SparkSession, root: str, version: int | None = None, within: tuple[str, object, object] | None = None
) -> DataFrame:
    """The table as it was after commit ``version`` (the newest by default).

    The commits to read are found in the log; the data scan prunes to their partitions.
    ``within`` = (column, low, high) gives the rows with a value from ``low`` to ``high`` (None:
    without that bound) and leaves out commits whose zone lies outside.
    """
    log = Log(spark, root)
    wanted = log.newest if version is None else version
    if not log.kept <= wanted <= log.newest:
        raise ValueError(f"there is no version {wanted}, there are {log.kept} to {log.newest}")
    live = log.live(wanted)
    if within is None:
        return _commits(log, live).drop(VERSION)
    column, low, high = within
    layout, _ = merged(log.layouts(live))
    kind = {f.name.lower(): f.dataType.simpleString() for f in layout.fields}[column.lower()]
    rows = _commits(log, [v for v in live if not _outside(log, v, kind, column, low, high)])
    inside = F.col(column).isNotNull()
    for bound, compare in ((low, "__ge__"), (high, "__le__")):
        if bound is not None:
            inside = inside & getattr(F.col(column), compare)(F.lit(bound).cast(kind))
    return rows.where(inside).drop(VERSION)


def changes_since(
    spark: SparkSession, root: str, version: int, upto: int | None = None
) -> DataFrame:
    """Rows committed in ``version`` or later (and up to ``upto``), with their commit version.

    What a retention wrote again is no change.
    """
    log = Log(spark, root)
    if version < log.kept:
        raise ValueError(f"changes before version {log.kept} were removed")
    last = log.newest if upto is None else upto
    return _commits(log, [r["version"] for r in log.rows if r["operation"] in ("append", "overwrite") and version <= r["version"] <= last])


def retain(spark: SparkSession, root: str, ts: str, cutoff: dt.datetime) -> tuple[list[int], list[int]]:
    """Commit a version without the rows before ``cutoff``; rows without a time stay.

    By their zones, commits that end before ``cutoff`` are dropped unread, and those that begin
    at or after it stay as they are. The others are read and what they keep is written as one
    commit. Returns (dropped unread, read and replaced).
    """
    log = Log(spark, root)
    live = log.live(log.newest)
    layout, _ = merged(log.layouts(live))
    kind = {f.name.lower(): f.dataType.simpleString() for f in layout.fields}.get(ts.lower(), "timestamp")
    limit = F.lit(cutoff.isoformat(sep=" ")).cast(kind)
    expired, mixed = [], []
    zones = {v: log.zone(v, ts) for v in live}
    known = {v: z for v, z in zones.items() if z is not None and z[0] is not None}
    if known:
        ends = spark.range(1).select(*[c for z in known.values() for c in (F.lit(z[0]).cast(kind) < limit, F.lit(z[1]).cast(kind) < limit)]).first()
        sides = dict(zip(known, zip(ends[::2], ends[1::2])))
    for v in live:
        if v not in known:
            if zones[v] is None:  # nothing is known of it
                mixed.append(v)
            continue
        begins_before, ends_before = sides[v]
        if ends_before and not zones[v][2]:
            expired.append(v)
        elif begins_before:
            mixed.append(v)
    if expired or mixed:
        rows = _commits(log, mixed).drop(VERSION)
        kept = rows.where((F.col(ts) >= limit) | F.col(ts).isNull())
        _write(kept, root, log.newest + 1, "retain", [ts], [*expired, *mixed])
    return expired, mixed


def vacuum(spark: SparkSession, root: str) -> int:
    """Remove the commits that the newest version does not read; returns the oldest one kept.

    Older versions and their changes cannot be read any more. That is noted before anything
    is deleted, so a run that stops half-way leaves no version that reads in part.
    """
    log = Log(spark, root)
    retained = [r["version"] for r in log.rows if r["operation"] == "retain"]
    horizon = max([log.start(log.newest), *retained])
    if log.newest < 0 or horizon <= log.kept:
        return log.kept
    held = {r["version"] for r in log.rows if r["operation"] in HOLDING}
    gone = {v for v in held if v < horizon} - set(log.live(log.newest))
    before = {v for v in held if v < log.kept} - set(log.live(log.kept))
    _log(spark, root, horizon, "vacuum", 0)
    remove_folders(spark, [_folder(root, v) for v in sorted(gone - before)])
    return horizon


def convert_to_versioned(
    spark: SparkSession, parquet: str, root: str, remove_source: bool = False
) -> int:
    """Make an existing Parquet folder the first version of a versioned table.

    ``remove_source`` deletes the folder once the version is there.
    """
    if current_version(spark, root) >= 0:
        raise ValueError(f"{root} already holds versions")
    version = commit(spark.read.parquet(parquet), root, "overwrite")
    if remove_source:
        remove_folders(spark, [parquet])
    return version
