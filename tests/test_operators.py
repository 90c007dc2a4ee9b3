"""Operators on small inputs, against plain Python and boundary values."""

import datetime as dt

import numpy as np
import pytest
from conftest import plan, values
from pyspark.sql import functions as F

from brightmere.functions import calendar, plugins, privacy, scalars
from brightmere.operators import aggregates, features, increment, joins, models, observe, quality, retention, topk
from brightmere.operators.quantiles import quantiles
from brightmere.session import scratch, scratch_name
from brightmere.sources import jdbc, messages, versions

# Quantiles ------------------------------------------------------------------------------


def test_quantiles_of_a_hot_group(spark):
    """Exact for smooth and lumpy values, whatever share of the rows a group holds."""
    drawn = spark.range(120_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 500).alias("k"),
        F.when(F.col("id") % 7 > 0, F.rand(1) * 1000).alias("smooth"),
        F.when(F.rand(2) < 0.4, 5.0).otherwise(F.floor(F.rand(3) * 20)).alias("lumpy"),
    )
    path = scratch(spark, "drawn")
    drawn.write.parquet(path)
    df = spark.read.parquet(path)
    qs = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = {r.k: r for r in quantiles(df, ["k"], ["smooth", "lumpy"], qs).collect()}
    pdf = df.toPandas()
    groups = dict(list(pdf[pdf.k.notna()].groupby("k"))) | {None: pdf[pdf.k.isna()]}
    assert len(groups[None]) == 80_000 and len(found) == len(groups)
    for k, group in groups.items():
        for name in ("smooth", "lumpy"):
            assert np.allclose(found[k][name], np.quantile(group[name].dropna(), qs), rtol=1e-12)


def test_quantiles_of_nothing(rows):
    df = rows([("a", None), ("b", 1.0)], "k STRING, v DOUBLE")
    assert values(quantiles(df, ["k"], ["v"], [0.5])) == [("a", None), ("b", [1.0])]
    assert quantiles(df.where("false"), ["k"], ["v"], [0.5]).collect() == []


def test_quantiles_of_odd_values_and_keys(rows):
    """As Spark's percentile gives them: infinities, NaN, both zeros, tiny and negative values;
    keys with missing parts stay apart."""
    some = [float("inf"), float("-inf"), float("nan"), 0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1.0, 1.0, 1.0000000000000002, -3.5]
    data = [(None, "x", v) for v in some] + [("x", None, v) for v in some[3:]] + [("x", "x", 2.5), (None, None, 1.0), (None, None, 2.0)]
    df = rows(data, "k STRING, l STRING, v DOUBLE")
    qs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    known = df.groupBy("k", "l").agg(F.percentile("v", qs).alias("v"))
    assert str(values(quantiles(df, ["k", "l"], ["v"], qs))) == str(values(known))


def test_weighted_quantiles_are_those_of_repeated_rows(spark):
    df = spark.range(3_000).selectExpr("id % 3 AS k", "cast(id * 7919 % 1009 AS double) AS v", "id % 5 AS n")
    repeated = df.selectExpr("k", "v", "explode(array_repeat(0, cast(n AS int)))")
    qs = [0.01, 0.33, 0.5, 0.999]
    assert values(quantiles(df.where("n > 0"), ["k"], ["v"], qs, weight="n")) == values(quantiles(repeated, ["k"], ["v"], qs))


def test_quantiles_hold_no_group_and_run_nothing_early(spark):
    """Building starts no job, and no buffer of the plan grows with a group: values are counted by
    hash, sorted and summed up, and no window goes over the values of a whole group."""
    df = spark.range(400_000).selectExpr("0 AS k", "cast(id * 7919 % 399989 AS double) / 7 AS v")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("built", "quantiles")
    found = quantiles(df, ["k"], ["v"], [0.5, 0.9])
    assert len(tracker.getJobIdsForGroup("built")) == 0
    drawn = np.sort(np.arange(400_000) * 7919 % 399989 / 7)
    assert np.allclose(found.first().v, np.quantile(drawn, [0.5, 0.9]), rtol=1e-12)
    text = plan(found)
    assert "percentile" not in text and "ObjectHashAggregate" not in text and "collect_" not in text
    spark.sparkContext.setJobGroup("", "")


def test_sketch_is_close(spark):
    df = spark.range(10_001).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("v"))
    assert abs(quantiles(df, ["k"], ["v"], [0.9], exact=False).first().v[0] - 9000) <= 2


# Ranks and numbers ----------------------------------------------------------------------


def test_latest_with_one_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 100).alias("k"), (F.col("id") % 1000).alias("t"), "id"
    )
    latest = topk.latest_per_key(df, "k", "t", 2, "id")
    best = {}
    for r in df.collect():
        best.setdefault(r.k, []).append((r.t, r.id))
    wanted = sorted((k, t, i) for k, v in best.items() for t, i in sorted(v, reverse=True)[:2])
    assert sorted(tuple(r) for r in latest.collect()) == wanted
    assert "WindowGroupLimit" in plan(latest)


def test_many_rows_per_key(spark):
    """More rows per key than Spark cuts early: the salted way."""
    df = spark.range(6000).select((F.col("id") % 2).alias("k"), F.hash("id").alias("t"), "id")
    found = topk.latest_per_key(df, "k", "t", 1500, "id")
    best = {}
    for r in df.collect():
        best.setdefault(r.k, []).append((r.t, r.id))
    wanted = sorted((k, t, i) for k, v in best.items() for t, i in sorted(v, reverse=True)[:1500])
    assert sorted(tuple(r) for r in found.collect()) == wanted


def test_ordinal_codes_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(F.concat(F.lit("v"), F.col("id") % 700).alias("v"), (5000 - F.col("id")).alias("place"))
        found = {r.v: r.code for r in features.ordinal_encode(df, "v", "place").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    first = {}
    for i in range(5000):
        first[f"v{i % 700}"] = 5000 - i
    assert found == {v: n for n, v in enumerate(sorted(first, key=first.get))}


def test_union_by_name(rows):
    a, b = rows([(1, "x")], "n INT, s STRING"), rows([("y", 2)], "s STRING, n INT")
    assert values(topk.union_all(a, b, rows([(3,)], "n INT"))) == [(1, "x"), (2, "y"), (3, None)]
    assert topk.union_distinct(a, a).count() == 1


# Joins ----------------------------------------------------------------------------------


def test_hierarchy_leaves_out_roots_and_cycles(rows):
    data = [(1, None, "root"), (2, 1, "a"), (3, 2, "b"), (4, 5, "loop"), (5, 4, "loop"), (6, 99, "lost"), (7, None, "lonely")]
    tree = joins.hierarchy(rows(data, "id INT, up INT, name STRING"), "id", "up", "name")
    assert values(tree) == [(2, "a", 1, "root", 1), (3, "b", 2, "a", 2)]


def test_hierarchy_of_any_depth(rows):
    chain = rows([(0, None, "0")] + [(i, i - 1, str(i)) for i in range(1, 105)], "id INT, up INT, name STRING")
    tree = joins.hierarchy(chain, "id", "up", "name")
    assert sorted(r["level"] for r in tree.collect()) == list(range(1, 105))


def test_hierarchy_ends_where_a_repeated_id_closes_a_cycle(rows):
    data = [(1, None, "root"), (2, 1, "a"), (3, 2, "b"), (2, 3, "a again")]
    tree = joins.hierarchy(rows(data, "id INT, up INT, name STRING"), "id", "up", "name")
    assert values(tree) == [(2, "a again", 3, "b", 3), (2, "a", 1, "root", 1), (3, "b", 2, "a", 2)]


def recursion(data):
    """What recursion with UNION ALL gives on a table without cycles."""
    level, found, n = [(i, name) for i, up, name in data if up is None], [], 0
    while level:
        n += 1
        made = [(i, name, up, above, n) for at, above in level for i, up, name in data if up == at]
        found += made
        level = [(i, name) for i, name, *_ in made]
    return sorted(found, key=str)


def test_hierarchy_keeps_every_path(rows):
    """An id below several rows leads on from each of its levels."""
    data = [(1, None, "root"), (3, 1, "c"), (5, 1, "e"), (5, 3, "e too"), (7, 5, "g"), (9, 7, "i"), (9, 1, "i"), (9, 1, "i")]
    found = values(joins.hierarchy(rows(data, "id INT, up INT, name STRING"), "id", "up", "name"))
    assert found == recursion(data)
    assert [r for r in found if r[0] == 7] == [(7, "g", 5, "e too", 3), (7, "g", 5, "e", 2)]


def test_hierarchy_stops_only_on_cycles(rows):
    """Ids beside a cycle keep all their paths, the ids on it lead on once; the graph is random."""
    import random

    random.seed(6)
    paths = [(0, None, "root")] + [(i, random.randrange(max(0, i - 6), i), f"n{i}") for i in range(1, 25) for _ in range(random.randint(1, 2))]
    assert values(joins.hierarchy(rows(paths, "id INT, up INT, name STRING"), "id", "up", "name")) == recursion(paths)
    tied = [(100, 0, "x"), (101, 100, "y"), (100, 101, "x"), (102, 101, "below")]
    found = values(joins.hierarchy(rows(paths + tied, "id INT, up INT, name STRING"), "id", "up", "name"))
    assert [r for r in found if r[0] < 100] == recursion(paths)
    assert [r for r in found if r[0] >= 100] == [
        (100, "x", 0, "root", 1), (100, "x", 101, "y", 3), (101, "y", 100, "x", 2), (102, "below", 101, "y", 3),
    ]


def test_hierarchy_of_nothing(rows):
    assert joins.hierarchy(rows([], "id INT, up INT, name STRING"), "id", "up", "name").count() == 0


def test_hierarchy_broadcasts_no_level(rows, monkeypatch):
    """The files of a level are small beside its rows, which would fill the driver."""
    from pyspark.sql.readwriter import DataFrameWriter

    stored, store = [], DataFrameWriter.parquet

    def noted(self, *given, **named):
        stored.append(plan(self._df))
        return store(self, *given, **named)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    data = [(1, None, "root"), (2, 1, "a"), (3, 2, "b")]
    assert joins.hierarchy(rows(data, "id INT, up INT, name STRING"), "id", "up", "name").count() == 2
    joined = [p for p in stored if "Join" in p]
    assert joined and not any("Broadcast" in p for p in joined)


def test_graph_path_drops_unlinked_nodes(rows):
    alarm = rows([(1, "hot"), (2, "cold"), (3, "unlinked")], "alarm INT, kind STRING")
    asset = rows([(10,), (11,)], "asset INT")
    system = rows([(100, "q")], "system INT, quality STRING")
    belongs = rows([(1, 10), (2, 11)], "src INT, dst INT")
    linked = rows([(10, 100)], "src INT, dst INT")
    path = joins.graph_path([alarm, asset, system], [belongs, linked], ["alarm", "asset", "system"])
    assert values(path.select("kind", "asset", "quality")) == [("hot", 10, "q")]


def test_orphans_ignore_missing_keys(rows):
    child = rows([(1, 1), (2, None), (3, 9)], "id INT, parent INT")
    assert values(joins.orphans(child, rows([(1,)], "pk INT"), {"parent": "pk"}).select("id")) == [(3,)]


def test_correlate_does_not_multiply(rows):
    start = rows([("a", 5, "x"), ("a", 3, "y"), ("a", None, "w"), ("b", 1, "z")], "k STRING, t INT, name STRING")
    end = rows([("a", 10), ("a", 11), ("c", 12)], "k STRING, t INT")
    assert values(joins.correlate(start, end, ["k"], "t", ["name"])) == [("a", 10, 3, "y"), ("a", 11, 3, "y")]


# Aggregates -----------------------------------------------------------------------------


def test_histogram_edges(rows):
    df = rows([(0.0,), (1.0,), (9.99,), (10.0,), (None,)], "v DOUBLE")
    found = {r.bin: (r["count"], r.share) for r in aggregates.histogram(df, "v", 10).collect()}
    assert found == {1: (1, 0.25), 2: (1, 0.25), 10: (2, 0.5)}
    assert aggregates.histogram(rows([(3.0,), (3.0,)], "v DOUBLE"), "v", 4).first()["count"] == 2
    assert aggregates.histogram(rows([], "v DOUBLE"), "v", 4).count() == 0


def test_metric_ratio_zero_divisor(rows):
    t = dt.datetime(2024, 1, 1)
    df = rows([("e", t, "top", 5.0), ("e", t, "base", 0.0), ("f", t, "TOP", 5.0), ("f", t, "base", 20.0), ("g", t, "top", 1.0)],
              "k STRING, ts TIMESTAMP_NTZ, name STRING, value DOUBLE")
    found = aggregates.metric_ratio(df, "top", "base", ["k"], "ts")
    assert values(found.select("k", "ratio")) == [("e", None), ("f", 25.0)]


def test_permissions(rows):
    ddl = "datalakeProperties ARRAY<STRUCT<year: STRING, month: STRING, aclPermissions: ARRAY<STRUCT<type: STRING, groups: ARRAY<STRING>>>>>"
    grant = lambda kind, *groups: {"type": kind, "groups": list(groups)}
    config = rows(
        [([{"year": "2020", "month": "01", "aclPermissions": [grant("read", "a", "b"), grant("write", "a"), grant("execute", "a"), grant("own", "b")]}],)],
        ddl,
    )
    assert values(aggregates.effective_permissions(config, "data/")) == [("data/2020/01/", "a", 7, "rwx"), ("data/2020/01/", "b", 4, "r--")]
    known = rows([("a",)], "group STRING")
    assert values(aggregates.permission_errors(config, known).select("group", "error")) == [("b", "unknown group"), ("b", "unknown type own")]
    with pytest.raises(ValueError, match="2 faulty.*unknown group.*unknown type own"):
        aggregates.check_permissions(config, known)


def test_reconcile(rows):
    a, b = rows([(3,), (4,)], "n INT"), rows([(7,)], "n INT")
    assert aggregates.reconcile(a, b, "n").first().complete
    assert not aggregates.reconcile(a, rows([(6,)], "n INT"), "n").first().complete


# Quality --------------------------------------------------------------------------------


def test_suite_reads_once_and_reports(rows):
    df = rows([(0, 1.5), (10, None), (11, 2.0), (None, 1.0)], "n INT, v DOUBLE")
    checks = [
        quality.Check("between", "n", {"min": 0, "max": 10}),
        quality.Check("not_null", "v"),
        quality.Check("type", "n", {"type": "int"}),
        quality.Check("type", "v", {"type": "int"}),
    ]
    result = quality.run_suite(df, checks, "suite", "run")
    assert plan(result).count("Scan") == 1
    found = [(r.expectation, r.success, r.unexpected, r.total) for r in result.collect()]
    assert found == [
        ("expect_column_values_to_be_between_on_n", False, 1, 4),
        ("expect_column_values_to_not_be_null_on_v", False, 1, 4),
        ("expect_column_values_to_be_of_type_on_n", True, 0, 4),
        ("expect_column_values_to_be_of_type_on_v", False, 4, 4),
    ]
    with pytest.raises(quality.QualityError, match="between_on_n"):
        quality.run_suite(df, checks, "suite", "run", fail=True)
    quality.run_suite(df, checks[2:3], "suite", "run", fail=True)


def test_null_constraint_holds(rows):
    df = rows([(1, None), (0, 5), (2, 1)], "qty INT, ship INT")
    found = quality.check_constraints(df, {"qty": "qty > 0", "ship": "ship >= 2"})
    assert values(found) == [("qty", 1), ("ship", 1)]


# Versions, increments, retention ---------------------------------------------------------


def test_versions(spark, rows):
    root = scratch(spark, "versioned")
    assert versions.current_version(spark, root) == -1
    for n in range(3):
        assert versions.commit(rows([(n,)], "n INT"), root) == n
    versions.commit(rows([(10,)], "n INT"), root, "overwrite")
    versions.commit(rows([(11,)], "n INT"), root)
    assert values(versions.read_version(spark, root, 1)) == [(0,), (1,)]
    assert values(versions.read_version(spark, root, 3)) == [(10,)]
    assert values(versions.read_version(spark, root)) == [(10,), (11,)]
    assert values(versions.changes_since(spark, root, 4)) == [(11, 4)]
    assert versions.changes_since(spark, root, 5).count() == 0
    for missing in (-1, 5):
        with pytest.raises(ValueError):
            versions.read_version(spark, root, missing)
    assert "PartitionFilters: [" in plan(versions.read_version(spark, root, 1))


def test_half_written_commit_is_invisible(spark, rows):
    root = scratch(spark, "versioned")
    versions.commit(rows([(1,)], "n INT"), root)
    rows([(666,)], "n INT").write.parquet(f"{root}/data/{versions.VERSION}=1")
    assert values(versions.read_version(spark, root)) == [(1,)]
    assert values(versions.changes_since(spark, root, 0)) == [(1, 0)]
    versions.commit(rows([(2,)], "n INT"), root)
    assert values(versions.read_version(spark, root)) == [(1,), (2,)]


def test_vacuum(spark, rows):
    root = scratch(spark, "versioned")
    for n in range(2):
        versions.commit(rows([(n,)], "n INT"), root)
    assert versions.vacuum(spark, root) == 0
    versions.commit(rows([(5,)], "n INT"), root, "overwrite")
    versions.commit(rows([(6,)], "n INT"), root)
    assert versions.vacuum(spark, root) == 2 == versions.vacuum(spark, root)
    assert values(versions.read_version(spark, root)) == [(5,), (6,)]
    assert values(versions.read_version(spark, root, 2)) == [(5,)]
    with pytest.raises(ValueError):
        versions.read_version(spark, root, 1)
    with pytest.raises(ValueError):
        versions.changes_since(spark, root, 1)
    assert versions.commit(rows([(7,)], "n INT"), root) == 4


def test_conversion_removes_its_source_when_told(spark, rows):
    for remove in (False, True):
        source, root = scratch(spark, "source"), scratch(spark, "versioned")
        rows([(1,)], "n INT").write.parquet(source)
        versions.convert_to_versioned(spark, source, root, remove_source=remove)
        assert values(versions.read_version(spark, root)) == [(1,)]
        if remove:
            with pytest.raises(Exception, match="PATH_NOT_FOUND"):
                spark.read.parquet(source)
        else:
            assert spark.read.parquet(source).count() == 1


def day(d, month=1):
    return dt.datetime(2024, month, d)


def test_watermark_copy_repeats_after_failure(spark, rows, monkeypatch):
    target, marks = scratch(spark, "target"), scratch(spark, "marks")
    ddl = "n INT, at TIMESTAMP_NTZ"
    first = rows([(1, day(1)), (2, day(2))], ddl)
    assert increment.hwm_copy(first, target, "at", marks, "t") == (increment.FIRST_MARK, day(2))
    later = first.unionByName(rows([(3, day(3)), (4, day(2)), (5, None)], ddl))
    with monkeypatch.context() as broken:
        broken.setattr(increment, "_note", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            increment.hwm_copy(later, target, "at", marks, "t")
    assert increment.watermark(spark, marks, "t") == day(2)
    more = later.unionByName(rows([(6, day(4))], ddl))
    assert increment.hwm_copy(more, target, "at", marks, "t") == (day(2), day(4))
    assert increment.hwm_copy(more, target, "at", marks, "t") == (day(4), day(4))
    # Row 4 lies on the old mark and is not copied; nothing is there twice.
    assert values(increment.read_increments(spark, target).select("n")) == [(1,), (2,), (3,), (6,)]
    assert increment.watermark(spark, marks, "other") == increment.FIRST_MARK


def test_change_feed_with_nothing_new(spark, rows):
    root, marks = scratch(spark, "alarms"), scratch(spark, "markers")
    context = rows([("hot", "asset-1")], "alarm_type STRING, asset STRING")
    ddl = "alarm_id INT, alarm_type STRING"
    versions.commit(rows([(1, "hot"), (2, "cold"), (3, "hot")], ddl), root)
    got, raw, upto = increment.cdf_increment(spark, root, marks, "alarm", context, "alarm_type")
    assert got.count() == 3 and raw.count() == 3 and upto == 1
    # Not confirmed: the same rows come again.
    assert increment.cdf_increment(spark, root, marks, "alarm", context, "alarm_type")[0].count() == 3
    increment.confirm(spark, marks, "alarm", upto)
    assert increment.cdf_increment(spark, root, marks, "alarm", context, "alarm_type")[0].count() == 0
    versions.commit(rows([(4, "cold")], ddl), root)
    got, _, upto = increment.cdf_increment(spark, root, marks, "alarm", context, "alarm_type")
    assert values(got) == [("cold", 4, None)] and upto == 2


def test_month_versions(rows):
    loans = rows([(1, dt.date(2020, 2, 1)), (2, dt.date(2020, 3, 1)), (3, dt.date(2020, 12, 1)), (4, dt.date(2021, 2, 1))], "id INT, issue_d DATE")
    found = [values(increment.filter_month_version(loans, "issue_d", v).select("id")) for v in (0, 1, 10, 12, 2)]
    assert found == [[(1,)], [(2,)], [(3,)], [(4,)], []]
    with pytest.raises(TypeError):
        increment.filter_month_version(loans, "id", 0)


def test_reingest_tolerance(rows):
    t = "2024-01-01 00:00:0"
    config = rows([("new", t + "5", ""), ("same", t + "5", t + "5"), ("edge", t + "5", t + "6"), ("old", t + "5", t + "7"), ("null", t + "5", None)],
                  "id STRING, lastUpdatedSourceSystem STRING, lastUpdatedDatalake STRING")
    assert values(increment.reingest_plan(config).select("id", "reason")) == [
        ("edge", "changed"), ("new", "new"), ("null", "new"), ("same", "changed")]


def test_retention_touches_only_what_expires(spark, rows):
    table = scratch_name("kept")
    data = [(1, 2023, day(1, 1)), (2, 2024, day(9)), (3, 2024, day(10)), (4, 2024, None), (5, 2025, day(20))]
    path = scratch(spark, table)
    rows(data, "n INT, year INT, at TIMESTAMP_NTZ").write.partitionBy("year").option("path", path).saveAsTable(table)
    files = lambda: {r[0] for r in spark.table(table).where("year = 2025").select("_metadata.file_path").collect()}
    before = files()
    assert retention.retain_rows(spark, table, "at", day(10), ["year"]) == 2
    assert values(spark.table(table).select("n")) == [(3,), (4,), (5,)]
    assert files() == before
    assert values(spark.sql(f"SHOW PARTITIONS {table}")) == [("year=2024",), ("year=2025",)]
    assert retention.retain_rows(spark, table, "at", day(10), ["year"]) == 0


def files(spark, root):
    """The data files below a versioned folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/data").select("path")
    return {r[0] for r in found.collect() if r[0].endswith(".parquet")}


def touched(before, after):
    return {f.split(f"{versions.VERSION}=")[1].split("/")[0] for f in before ^ after}


def test_retention_leaves_no_trace(spark, rows):
    """Partitions in one statement, no option changed, no staged rows left."""
    table = scratch_name("kept")
    data = [(n, p, day(n)) for n in range(1, 20) for p in (n // 3, 7)]
    rows(data, "n INT, p INT, at TIMESTAMP_NTZ").write.partitionBy("p").option("path", scratch(spark, table)).saveAsTable(table)
    options = spark.conf.getAll
    said = []
    sql = type(spark).sql
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark), "sql", lambda self, text, *a, **k: (said.append(text), sql(self, text, *a, **k))[1])
        staged = []
        patch.setattr(retention, "scratch", lambda s, label: staged.append(scratch(s, label)) or staged[-1])
        assert retention.retain_rows(spark, table, "at", day(10), ["p"]) == 18
    assert sum("DROP" in text for text in said) == 1 and spark.conf.getAll == options
    assert len(staged) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(staged[0])
    assert values(spark.table(table).select("n", "p")) == sorted([(n, p) for n, p, at in data if at >= day(10)], key=str)


def test_retention_of_commits_by_their_zones(spark, rows):
    """Commits that expire whole are not read, later ones keep their files, mixed ones are rewritten."""
    root = scratch(spark, "versioned")
    ddl = "n INT, at TIMESTAMP_NTZ"
    parts = [[(1, day(1)), (2, day(2))], [(3, day(8)), (4, day(12))], [(5, day(15)), (6, None)], [(7, None)], [(8, day(3)), (9, None)], [(10, day(20))]]
    for part in parts[:5]:
        versions.commit(rows(part, ddl), root, zones=["at"])
    versions.commit(rows(parts[5], ddl), root)  # without a zone
    before = files(spark, root)
    assert versions.retain(spark, root, "at", day(10)) == ([0], [1, 4, 5])
    assert touched(before, files(spark, root)) == {"6"}
    kept = [(4, day(12)), (5, day(15)), (6, None), (7, None), (9, None), (10, day(20))]
    assert values(versions.read_version(spark, root)) == sorted(kept, key=str)
    assert versions.read_version(spark, root, 5).count() == 10
    assert versions.changes_since(spark, root, 5).count() == 1  # what was written again is no change
    assert versions.retain(spark, root, "at", day(10)) == ([], [])
    assert versions.vacuum(spark, root) == 6
    assert touched(before, files(spark, root)) == {"0", "1", "4", "5", "6"}
    assert values(versions.read_version(spark, root)) == sorted(kept, key=str)
    with pytest.raises(ValueError):
        versions.read_version(spark, root, 5)
    versions.commit(rows([(11, day(30))], ddl), root, zones=["at"])
    assert versions.retain(spark, root, "at", day(14)) == ([], [6])
    assert versions.vacuum(spark, root) == 8 and versions.read_version(spark, root).count() == 6


def test_ranges_skip_commits(spark, rows):
    root = scratch(spark, "versioned")
    for n in range(4):
        versions.commit(rows([(10 * n, f"v{n}"), (10 * n + 5, None)], "n INT, t STRING"), root, zones=["N", "t"])
    found = versions.read_version(spark, root, within=("n", 12, 20))
    assert values(found) == [(15, None), (20, "v2")]
    assert {f.split("=")[1].split("/")[0] for f in found.inputFiles()} >= {"1", "2"}
    scanned = {r[0] for r in found.select(F.regexp_extract(F.input_file_name(), r"version=(\d+)", 1)).distinct().collect()}
    assert scanned == {"1", "2"}
    assert "isin" in plan(found).lower() or ">= 1" in plan(found)
    assert values(versions.read_version(spark, root, within=("t", "v3", None))) == [(30, "v3")]
    assert versions.read_version(spark, root, within=("n", 100, None)).count() == 0


def test_copies_of_another_type_are_refused(spark, rows):
    """Before a row is written, and the copies made so far stay readable."""
    target, marks = scratch(spark, "target"), scratch(spark, "marks")
    increment.hwm_copy(rows([(1, day(1))], "n INT, at TIMESTAMP_NTZ"), target, "at", marks, "t")
    with pytest.raises(ValueError, match="n"):
        increment.hwm_copy(rows([("two", day(2))], "n STRING, at TIMESTAMP_NTZ"), target, "at", marks, "t")
    assert increment.watermark(spark, marks, "t") == day(1)
    increment.hwm_copy(rows([(3, day(3), "new")], "n INT, at TIMESTAMP_NTZ, more STRING"), target, "at", marks, "t")
    assert values(increment.read_increments(spark, target).select("n", "more")) == [(1, None), (3, "new")]


def test_retention_in_the_null_partition(spark, rows):
    table = scratch_name("kept")
    data = [(1, None, day(1)), (2, None, day(20)), (3, "it's", day(1)), (4, "z", day(20))]
    path = scratch(spark, table)
    rows(data, "n INT, p STRING, at TIMESTAMP_NTZ").write.partitionBy("p").option("path", path).saveAsTable(table)
    assert retention.retain_rows(spark, table, "at", day(10), ["p"]) == 2
    assert values(spark.table(table).select("n", "p")) == [(2, None), (4, "z")]
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 2


def test_retention_plan(rows):
    months = rows([(2023, 12), (2024, 1), (2024, 2), (2022, 6)], "year INT, month INT")
    found = values(retention.retention_plan(months, dt.date(2024, 2, 1)))
    assert found == [(2022, 6, "drop", True), (2023, 12, "drop", True), (2024, 1, "drop", False), (2024, 2, "keep", False)]


# Features and models --------------------------------------------------------------------


def test_cleansing(rows):
    trips = rows([(1.0, 1, 1), (None, 1, 1), (1.0, 264, 1), (1.0, 1, 265), (1.0, None, 2)], "passenger_count DOUBLE, PULocationID INT, DOLocationID INT")
    assert features.cleanse_trips(trips).count() == 2
    weather = rows([("2022-01-01T00:00", 1.0, 0.0, 5, 3.0), ("2022-01-01T23:00", None, 0.0, 5, 3.0)],
                   "time STRING, `temperature_2m (°C)` DOUBLE, `precipitation (mm)` DOUBLE, `cloud_cover (%)` INT, `wind_speed_10m (km/h)` DOUBLE")
    clean = features.cleanse_weather(weather)
    assert clean.columns == ["time", "temperature_2m_c", "precipitation_mm", "cloudcover_percentage", "windspeed_10m_km_per_hour"]
    assert values(features.weather_features(clean).select("hour", "id")) == [(0, "2022010100")]


def test_demand(rows):
    at = dt.datetime(2022, 1, 3, 8)
    trips = rows([(at.replace(minute=m), z) for m, z in ((5, 1), (3, 2), (9, 3), (1, 4), (2, 99))], "tpep_pickup_datetime TIMESTAMP_NTZ, PULocationID INT")
    zones = rows([(2, "Queens"), (1, "Bronx"), (3, "Queens"), (4, None)], "LocationID INT, Borough STRING")
    found = values(features.demand(trips, zones).select("Borough", "demand", "pickup_timestamp", "borough_id", "weekday_pickup", "hour_pickup"))
    assert found == [("Bronx", 1, at.replace(minute=5), 0, 0, 8), ("Queens", 2, at.replace(minute=3), 1, 0, 8)]


def test_scaling(rows):
    df = rows([(0.0, 5.0), (5.0, 5.0), (10.0, 5.0)], "a DOUBLE, b DOUBLE")
    fit = features.minmax_fit(df, ["a", "b"])
    assert values(features.minmax_apply(df, fit, {"a": "x", "b": "y"}).select("x", "y")) == [(0.0, 0.0), (0.5, 0.0), (1.0, 0.0)]
    assert features.minmax_apply(rows([(20.0, 5.0)], "a DOUBLE, b DOUBLE"), fit, {"a": "x"}).first().x == 2.0


def test_split_is_stable(spark):
    df = spark.range(10_000)
    train, test = features.split(df, ["id"])
    assert train.count() + test.count() == 10_000 and 7800 < train.count() < 8200
    again, _ = features.split(df.repartition(7), ["id"])
    assert values(train) == values(again)
    assert values(features.split(df, ["id"], seed=14)[0]) != values(train)


def test_registry(spark, rows):
    from pyspark.sql.types import StructType

    registry, path = scratch(spark, "registry"), scratch(spark, "set")
    rows([(1, "a")], "n INT, s STRING").write.option("header", True).csv(path)
    layout = StructType.fromDDL("n INT, s STRING")
    assert features.register(spark, registry, "set", path, layout, "n", ["s"], "csv", version=3) == 3
    assert features.register(spark, registry, "set", path + "-none", layout, "n", ["s"], "csv", version=2) == 2
    with pytest.raises(ValueError, match="version 2"):
        features.register(spark, registry, "set", path, layout, "n", ["s"], "csv", version=2)
    assert features.read_feature_set(spark, registry, "set").schema == layout
    assert values(features.read_feature_set(spark, registry, "set", 3)) == [(1, "a")]
    with pytest.raises(KeyError):
        features.read_feature_set(spark, registry, "other")


@pytest.mark.parametrize("family", ["gbt", "poisson", "poisson_trees"])
def test_models_learn(spark, family):
    df = spark.range(400).select((F.col("id") % 20).cast("double").alias("x"), F.exp((F.col("id") % 20) / 10).cast("int").alias("demand"))
    model = models.train_demand(df, family=family, rounds=10)
    metrics = models.regression_metrics(models.score(model, df), "demand", "prediction").first()
    assert metrics["rows"] == 400 and metrics.r2 > 0.7
    with pytest.raises(ValueError):
        models.train_demand(df, family="tree")


@pytest.mark.parametrize("family, expected", [("gbt", 0.0), ("poisson", 1.0), ("poisson_trees", 1.0)])
def test_models_without_rows_stay_at_their_start(rows, family, expected):
    layout = "x DOUBLE, demand BIGINT"
    model = models.train_demand(rows([], layout), family=family)
    assert models.score(model, rows([(2.0, 5)], layout)).collect() == [(2.0, 5, expected)]
    found = models.regression_metrics(models.score(model, rows([], layout)), "demand", "prediction").collect()
    assert found == [(0, None, None, None, None)]


def test_equal_entries_are_counted_without_sorting(spark):
    """Ends are counted by hashes; a least start among them would have all entries sorted."""
    log = spark.createDataFrame([], observe.EVENTS)
    whole = plan(observe.event_counts(log))
    lines = [line for line in whole.splitlines() if "Aggregate(" in line]
    assert any("HashAggregate(" in line and "label" in line and "count(query" in line for line in lines)
    assert not any("SortAggregate(" in line and "label" in line for line in lines)


def test_metrics(rows):
    found = models.regression_metrics(rows([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)], "y DOUBLE, p DOUBLE"), "y", "p").first()
    assert found.mae == 1.0 and found.mse == pytest.approx(5 / 3) and found.r2 == pytest.approx(1 - 5 / 8)


# Calendar and text ----------------------------------------------------------------------


def test_date_dimension(spark):
    days = {r.dim_date_id: r for r in calendar.dim_date(spark, dt.date(2012, 12, 31), dt.date(2021, 1, 3)).collect()}
    known = days[20130908]
    assert (known.day_suffix, known.week_day, known.week_day_name, known.DOW_in_month, known.day_of_year) == ("th", 1, "Sunday", 2, 251)
    assert (known.week_of_month, known.week_of_year, known.ISO_week_of_year, known.quarter_name) == (2, 37, 36, "Third")
    assert (known.MMYYYY, known.month_year) == ("092013", "Sep 2013")
    assert (known.last_day_of_quarter, known.first_day_of_next_year) == (dt.date(2013, 9, 30), dt.date(2014, 1, 1))
    assert days[20160229].last_day_of_month == dt.date(2016, 2, 29)
    assert days[20210103].ISO_week_of_year == 53
    assert len(days) == (dt.date(2021, 1, 3) - dt.date(2012, 12, 31)).days + 1


def test_time_dimension(spark):
    times = calendar.dim_time(spark)
    assert times.count() == 86400
    last = times.where("dim_time_id = 86399").first()
    assert (last.time, last.time_30, last.hour_30, last.minute_number, last.second_number) == ("23:59:59", "23:30:00", 23, 59, 59)
    assert times.where("dim_time_id = 0").first().time == "00:00:00"


def test_folder_stamp_tells_morning_from_evening():
    assert calendar.folder_stamp(dt.datetime(2024, 1, 1, 6)) != calendar.folder_stamp(dt.datetime(2024, 1, 1, 18))


def test_slots(rows):
    df = rows([(dt.datetime(2021, 1, 1, 0, 7),), (dt.datetime(2021, 1, 1, 0, 45),)], "t TIMESTAMP_NTZ")
    assert [r.slot.minute for r in calendar.timestamp_slots(df, "t", 15).orderBy("slot").collect()] == [0, 15, 30, 45]


def test_keys_and_hashes(rows):
    df = rows([("a", None, "b"), ("a", "b", None), ("a|b", "c", "d"), ("a", "b|c", "d")], "x STRING, y STRING, z STRING")
    assert df.select(scalars.surrogate_key(*[F.col(c) for c in "xyz"])).distinct().count() == 4
    hashed = scalars.row_md5(df.limit(2))
    assert hashed.select("md5").distinct().count() == 1
    assert scalars.row_md5(df.limit(2), null_token="?").select("md5").distinct().count() == 2


def test_status_and_totals(rows):
    df = rows([(0,), (1,), (6,), (7,), (None,)], "s INT")
    assert [r[0] for r in df.select(scalars.status_text(F.col("s"))).collect()] == [
        "** Invalid **", "In process", "Cancelled", "** Invalid **", "** Invalid **"]
    line = rows([(None, 0.1, 2)], "p DOUBLE, d DOUBLE, q INT").select(scalars.line_total(F.col("p"), F.col("d"), F.col("q")))
    assert line.first()[0] == 0
    assert rows([(None,)], "n INT").select(scalars.order_number(F.col("n"))).first()[0] == "*** ERROR ***"


def test_xml_without_document(rows):
    df = rows([(1, None), (2, "<a:r xmlns:a='u'><a:x>1</a:x><a:x>2</a:x></a:r>")], "id INT, doc STRING")
    assert values(scalars.xml_fields(df, "doc", {"x": "r/x", "y": "r/y"}).select("id", "x", "y")) == [(2, "1", None)]


def test_xml_paths_are_looked_up_together(rows):
    """A document is parsed once for several paths: prefixes, the first match, texts of inner elements."""
    doc = "<a:r xmlns:a='u'><a:x> 1 <b>b</b><!-- c --><![CDATA[<]]>&amp;</a:x><x>2</x><g/><g><h>z</h></g><e/></a:r>"
    df = rows([(1, doc), (2, "<r><h>h</h></r>"), (3, ""), (4, None)], "id INT, doc STRING")
    found = scalars.xml_fields(df, "doc", {"x": "r/x", "h": "r/g/h", "e": "r/e", "b": "r/x/b"})
    assert values(found.drop("doc")) == [(1, " 1 b<&", "z", None, "b"), (2, None, None, None, None), (3, None, None, None, None)]
    assert plan(found).count("XPathStringEvaluator") == 1
    assert values(scalars.xml_fields(df, "doc", {"h": "r/h"}).select("id", "h")) == [(1, None), (2, "h"), (3, None)]
    assert scalars.xml_fields(df, "doc", {}).columns == ["id", "doc"]
    tall = "/".join(["r"] * 19)
    many = {f"f{i}": path for i, path in enumerate(["r/h", *["r/no"] * 30, tall, "r/h"])}
    found = scalars.xml_fields(df.where("id = 2"), "doc", many).first()
    assert (found.f0, found.f1, found.f31, found.f32) == ("h", None, None, "h")


@pytest.mark.parametrize(
    "text, masked",
    [
        ("mail a.b+c@d-e.co.uk now", "mail <ANONYMIZED> now"),
        ("call +1 555-123-4567 or (020) 7946 0958", "call <ANONYMIZED> or <ANONYMIZED>"),
        ("card 4111 1111 1111 1111.", "card <ANONYMIZED>."),
        ("from 10.0.0.1, see https://x.y/z?q=1", "from <ANONYMIZED>, see <ANONYMIZED>"),
        ("id 123-45-6789", "id <ANONYMIZED>"),
        ("DE89 3704 0044 0532 0130 00", "<ANONYMIZED>"),
        ("year 2024 and 3.14", "year 2024 and 3.14"),
        (None, None),
    ],
)
def test_masking(rows, text, masked):
    df = privacy.anonymize(rows([(text,)], "t STRING"), "t")
    assert df.first().t == masked
    assert df.select(privacy.leaks(F.col("t"))).first()[0] in (0, None)
    assert "Python" not in plan(df)


def test_messages(rows):
    text = rows([("/imu", "1", "seq: 5\nstamp:  a:b \nbare\n")], "topic STRING, ts STRING, text STRING")
    found = messages.stack_messages(text).select("position", "name", "value")
    assert values(found) == [(0, "seq", "5"), (1, "stamp", "a"), (2, "bare", None), (3, "", None)]
    assert text.select(messages.topic_file(F.col("topic"))).first()[0] == "_slash_imu"


def test_topic_table(rows):
    data = [("/imu", 2, "seq: 6\nid: x\nseq: 8"), ("/imu", 1, "seq: 5\nid:\nseq: 7"), ("/imu", 3, "seq: 9"), ("/gps", 1, "lat: 1")]
    df = rows(data, "topic STRING, ts INT, text STRING")
    table = messages.topic_table(df, "/imu")
    assert table.columns == ["ts", "seq", "id", "seq_2"]
    assert values(table) == [(1, "5", "", "7"), (2, "6", "x", "8"), (3, "9", None, None)]
    assert messages.topic_table(df, "/none").columns == ["ts"]


def test_topic_table_goes_by_name(rows):
    data = [("/t", 1, "a: 1"), ("/t", 2, "a: 2\nb: 3"), ("/t", 3, "b: 9\na: 4\nA: 5\n"), ("/t", 4, None)]
    table = messages.topic_table(rows(data, "topic STRING, ts INT, text STRING"), "/t")
    assert table.columns == ["ts", "a", "b", "A_2"]
    assert values(table) == [(1, "1", None, None), (2, "2", "3", None), (3, "4", "9", "5"), (4, None, None, None)]


def test_versions_keep_new_columns(spark, rows):
    from brightmere.sources import versions

    root = scratch(spark, "layouts")
    versions.commit(rows([(1,)], "a INT"), root)
    versions.commit(rows([(2, "x")], "a INT, b STRING"), root)
    assert values(versions.read_version(spark, root)) == [(1, None), (2, "x")]
    assert versions.read_version(spark, root, 0).columns == ["a"]
    with pytest.raises(ValueError, match="another type"):
        versions.commit(rows([("3",)], "a STRING"), root)
    versions.commit(rows([("4", 1.5)], "a STRING, c DOUBLE"), root, "overwrite")
    assert values(versions.read_version(spark, root)) == [("4", 1.5)]
    changes = versions.changes_since(spark, root, 1).select("a", "b", "c", versions.VERSION)
    assert values(changes) == [("2", "x", None, 1), ("4", None, 1.5, 2)]


def test_merge_files_by_size(spark):
    from brightmere.operators import load

    many, merged = scratch(spark, "many"), scratch(spark, "merged")
    spark.range(20_000).repartition(6).write.parquet(many)
    size = load.merge_files(spark, many, merged, file_bytes=40_000)
    found = spark.read.parquet(merged).select("id", F.col("_metadata.file_path").alias("file"))
    assert found.agg(F.count("id"), F.countDistinct("file")).first() == (20_000, -(-size // 40_000))


def test_convert_fails_or_diverts(spark, rows):
    from brightmere.operators import load

    source, target, rejects = (scratch(spark, x) for x in ("csv", "converted", "rejects"))
    rows([("1", "2.5"), ("x", "3"), (None, "y")], "a STRING, b STRING").write.option("header", True).csv(source)
    casts = {"a": "bigint", "b": "double"}
    with pytest.raises(Exception, match="is no"):
        load.convert(spark, source, target, casts)
    for _ in range(2):
        assert load.convert(spark, source, target, casts, rejects) == 2
        assert values(spark.read.parquet(target)) == [(1, 2.5)]
        assert values(spark.read.parquet(rejects)) == [("x", "3", ["a"]), (None, "y", ["b"])]


def test_access_log(spark, tmp_path):
    line = ["1.0", '"a;b"'] + [""] * 27 + ["last"]
    (tmp_path / "a.log").write_text(";".join(line) + "\n\n" + ";".join(line) + "\n")
    df = messages.parse_access_log(spark, str(tmp_path / "a.log"))
    assert df.count() == 2 and len(df.columns) == 30
    assert df.first()["request-start-time"] == "a;b" and df.first()["client-request-id"] == "last"
    assert '"request-start-time":"a;b"' in messages.access_log_json(df).first().body


def test_jdbc_options():
    assert jdbc.jdbc_options("jdbc:x", query="SELECT 1") == {"url": "jdbc:x", "query": "SELECT 1"}
    split = jdbc.jdbc_options("jdbc:x", query="SELECT 1", partition=("id", 0, 100, 8), isolation="READ_UNCOMMITTED")
    assert split["dbtable"] == "(SELECT 1) source" and split["numPartitions"] == "8" and "query" not in split
    assert jdbc.jdbc_options("jdbc:x", table="t")["dbtable"] == "t"
    for wrong in ({}, {"table": "t", "query": "q"}):
        with pytest.raises(ValueError):
            jdbc.jdbc_options("jdbc:x", **wrong)


def test_plugins(spark, rows):
    df = rows([("a", 1), ("b", 2)], "k STRING, n INT")
    assert plugins.run_plugin(spark, "data_filter", df, {"key_col": "k", "filter_criteria": ["b"]}).count() == 1
    assert "md5" in plugins.run_plugin(spark, "md5", df, {}).columns
    with pytest.raises(KeyError):
        plugins.run_plugin(spark, "os.system", df, {})
    with pytest.raises(ValueError):
        plugins.plugin("md5")(lambda s, d, c: d)


# Monitoring -----------------------------------------------------------------------------


def event_log(rows, data):
    names = ["time_generated", "event", "app_id", "metrics_namespace", "cluster", "stage_id", "stage_name",
             "stage_submission", "stage_completion", "task_reason", "run_time"]
    from pyspark.sql.types import StructType

    layout = StructType.fromDDL(observe.EVENTS)
    return rows([tuple(dict(zip(names, d)).get(f.name) for f in layout) for d in data], layout)


def test_stages_of_two_applications_stay_apart(rows):
    t = dt.datetime(2024, 1, 1)
    log = event_log(rows, [
        (t, observe.SUBMITTED, "app-1", "", "c", 1, "map", 0.0, None, None, None),
        (t, observe.SUBMITTED, "app-2", "ns", "c", 1, "join", 0.0, None, None, None),
        (t, "x.SparkListenerStageCompleted", "app-1", "", "c", 1, "map", 0.0, 10.0, None, None),
        (t, observe.TASK_END, "app-2", "ns", "c", 1, None, None, None, "Success", 7.0),
        (t, observe.TASK_END, "app-2", "ns", "c", 1, None, None, None, "ExceptionFailure", 9.0),
        (t, observe.SUBMITTED, "app-3", "", "c", 2, "never ends", 0.0, None, None, None),
    ])
    assert values(observe.duration_quantiles(log).select("slice", "p10", "p90")) == [("c-app-1 map", 10.0, 10.0)]
    assert values(observe.task_p90(log, only=["task_executor_compute_time"]).select("slice", "value")) == [("ExecutorComputeTime c-ns join", 7.0)]
    counts = {(r.query, r.slice): r.value for r in observe.event_counts(log).collect()}
    assert counts == {("stage_throughput", "# StagesCompleted c-app-1 map"): 1, ("task_throughput", "#TasksCompleted c-ns join"): 1}


def test_events_are_read_once_and_meet_as_counts(spark, rows):
    """One scan for the counts of all events; repeated and late starts do not multiply; equal
    ends of a key travel as one row."""
    t = dt.datetime(2024, 1, 1)
    later = t + dt.timedelta(hours=5)
    started = [(later, observe.SUBMITTED, "a", "", "c", 1, "late", 0.0, None, None, None),
               (t, observe.SUBMITTED, "a", "", "c", 1, "map", 0.0, None, None, None),
               (None, observe.SUBMITTED, "a", "", "c", 1, "untimed", 0.0, None, None, None),
               (t, observe.SUBMITTED, None, "", "c", 1, "no key", 0.0, None, None, None)]
    tasks = [(later, observe.TASK_END, "a", "", "c", 1, None, None, None, "Success", 1.0)] * 5000
    tasks += [(None, observe.TASK_END, "a", "", "c", 1, None, None, None, "Success", 1.0)] * 7
    tasks += [(t, observe.TASK_END, None, "", "c", 1, None, None, None, "Success", 1.0)] * 3
    path = scratch(spark, "log")
    event_log(rows, started + tasks).write.parquet(path)
    log = spark.read.parquet(path)
    counts = observe.event_counts(log)
    assert values(counts) == [("task_throughput", t, "#TasksCompleted c-a map", 5007)]
    final = plan(counts).split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final


def test_all_saved_queries_are_there():
    # Two percentiles of one saved query are listed as two measures.
    named = [2, len(observe.TASK_P90) - 1, 6, len(observe.RATIOS), len(observe.COUNTERS), len(observe.GAUGES), len(observe.STREAM_P90)]
    single = ["tasks_per_stage", "host_sum", "running_executors", "errors"]
    assert sum(named) + len(single) == 41
    assert all(hasattr(observe, n) for n in single)
    with pytest.raises(KeyError):
        observe.task_p90(None, only=["nothing"])


def test_metric_families(rows):
    t = dt.datetime(2024, 1, 1)
    log = rows([(t, "app.3.executor.diskBytesSpilled", 10.0, None), (t, "app.3.executor.diskBytesSpilled", 25.0, None),
                (t, "app.driver.executor.RunTime", 50.0, None), (t, "app.driver.executor.cpuTime", 5_000_000.0, None),
                (t, "app.3.shuffle-client.usedDirectMemory", None, 4.0)], observe.METRICS)
    assert values(observe.counter_deltas(log).select("query", "slice", "value")) == [
        ("disk_bytes_spilled", "app.3", 15.0), ("shuffle_disk_spilled_per_executor", "executorid:3", 15.0)]
    assert values(observe.ratio_p90(log).select("query", "slice", "value")) == [("cpu_percent", "app.driver", 10.0)]
    assert values(observe.gauge_p90(log).select("query", "slice")) == [
        ("shuffle_client_direct_memory", "app.3"), ("shuffle_client_memory", "executorid:3")]
    assert values(observe.running_executors(log).select("app", "value")) == [("app", 1)]


def test_status_needs_a_run(rows):
    t = dt.datetime(2024, 1, 1)
    data = [("verifychecks", "c", 1, "r", "{}", t), ("verifychecks", "c", 3, "r", "{}", t), ("verifychecks", "c", 2, "r", "{}", t),
            ("verifychecks", "c", 1, "", "{}", t), ("verifychecks", "c", 1, None, "{}", t), ("other", "c", 1, "r", "{}", t)]
    traces = rows(data, "message STRING, check_name STRING, severity INT, run_id STRING, details STRING, timestamp TIMESTAMP_NTZ")
    assert values(quality.dq_status_counts(traces, ["c"])) == [("failed", 1), ("success", 1)]


def test_messages_are_parsed_once(rows):
    from brightmere.schemas import get_schema
    from brightmere.streaming import streams

    good, dead = streams.decode(rows([("{}",)], "body STRING"), get_schema("device_event"))
    assert plan(good).count("from_json") == 1 and plan(dead).count("from_json") == 1


def test_lineage_is_what_a_frame_reads(spark, rows):
    from brightmere.operators import lineage

    left, right, target, log = (scratch(spark, n) for n in ("left", "right", "target", "log"))
    table = scratch_name("kept")
    rows([(1, "a"), (2, "b")], "n INT, t STRING").write.parquet(left)
    rows([(1,)], "n INT").write.parquet(right)
    rows([(2,)], "n INT").write.option("path", scratch(spark, table)).saveAsTable(table)
    spark.read.parquet(left).where("n > 0").createOrReplaceTempView("left_view")
    frame = spark.sql(f"SELECT * FROM left_view JOIN {table} USING (n)").cache().unionByName(
        spark.read.parquet(right).withColumn("t", F.lit("c"))
    ).unionByName(rows([(9, "made")], "n INT, t STRING"))
    named = sorted([left, right, f"spark_catalog.default.{table}"])
    assert sorted(x.removeprefix("file:") for x in lineage.inputs(frame)) == sorted(x.removeprefix("file:") for x in named)
    assert lineage.write(frame, target, "join", "load-1", log) == lineage.inputs(frame)
    edges = spark.read.parquet(log).collect()
    assert {(e.input, e.process, e.output, e.load_id) for e in edges} == {(i, "join", target, "load-1") for i in lineage.inputs(frame)}
    assert spark.read.parquet(target).count() == 3
    with pytest.raises(Exception, match="already exists"):
        lineage.write(frame, target, "join", "load-2", log, mode="error")
    assert spark.read.parquet(log).where("load_id = 'load-2'").isEmpty()


def test_boosted_counts_match_a_plain_booster(spark):
    """Tree by tree, on a hundred rows with missing values and repeated rows."""
    from brightmere.operators import boosting

    rng = np.random.default_rng(2)
    x = np.stack([rng.integers(0, 12, 100).astype(float), np.round(rng.normal(size=100), 1), rng.integers(0, 2, 100).astype(float)], 1)
    y = rng.poisson(np.exp(0.2 * x[:, 0] * (x[:, 2] + 0.2))).astype(float)
    missing = rng.random(100) < 0.1
    data = [(None if m else a, b, c, n) for (a, b, c), n, m in zip(x.tolist(), y.tolist(), missing)]
    data += data[:10]
    df = spark.createDataFrame(data, "a DOUBLE, b DOUBLE, c DOUBLE, n DOUBLE").repartition(3)
    model = boosting.fit(df, "n", ["a", "b", "c"], rounds=4, depth=2, rate=0.3)

    rows = np.array([[np.inf if a is None else a, b, c] for a, b, c, _ in data])
    counts = np.array([r[3] for r in data])
    margin = np.full(len(rows), np.log(counts.mean()))

    def grow(held, depth):
        g, h = (np.exp(margin) - counts)[held].sum(), np.exp(margin)[held].sum()
        worth = lambda g, h: g * g / (h + 1)
        best = (1e-9, None)
        for f in range(3) if depth else ():
            for cut in model.cuts[f]:
                left = held & (rows[:, f] <= cut)
                lg, lh = (np.exp(margin) - counts)[left].sum(), np.exp(margin)[left].sum()
                gain = worth(lg, lh) + worth(g - lg, h - lh) - worth(g, h)
                if gain > best[0] + 1e-12:
                    best = (gain, left)
        if best[1] is None:
            return np.where(held, -0.3 * g / (h + 1), 0.0)
        return grow(best[1], depth - 1) + grow(held & ~best[1], depth - 1)

    for _ in range(4):
        margin = margin + grow(np.ones(len(rows), bool), 2)
    found = sorted((str(r[:4]), r.prediction) for r in model.transform(df).collect())
    wanted = sorted((str(d), p) for d, p in zip(data, np.exp(margin)))
    assert [f[0] for f in found] == [w[0] for w in wanted]
    assert np.allclose([f[1] for f in found], [w[1] for w in wanted], rtol=1e-9)


def test_boosted_counts_of_nothing(spark):
    from brightmere.operators import boosting

    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (3.0, None)], "x DOUBLE, n INT")
    assert {r.prediction for r in boosting.fit(df, "n", ["x"], 2).transform(df).collect()} == {0.0}
    assert {r.prediction for r in boosting.fit(df.where("false"), "n", ["x"], 2).transform(df).collect()} == {1.0}
