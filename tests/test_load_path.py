"""Landed files to facts: fixtures of the parking load."""

import datetime as dt
import json

import pytest
from conftest import plan, values

from brightmere.functions.scalars import EMPTY_UUID
from brightmere.operators import load, scd
from brightmere.operators.facts import process_fact_parking, star_fact, time_of_load
from brightmere.operators.standardize import standardize_parking_bay, standardize_sensordata
from brightmere.schemas import get_schema
from brightmere.session import scratch, scratch_name
from brightmere.sources.files import read_csv, read_json

WHEN = dt.datetime(2024, 3, 1, 18, 30)
POLYGON = {"type": "MultiPolygon", "coordinates": [[[[144.9, -37.8], [144.8, -37.7]]]]}


def bay(bay_id, last_edit, marker="m", segment="7"):
    return {
        "the_geom": POLYGON, "marker_id": marker, "meter_id": "x", "bay_id": bay_id,
        "last_edit": last_edit, "rd_seg_id": segment, "rd_seg_dsc": "street",
    }


@pytest.fixture
def bays(spark, tmp_path):
    landed = [
        bay("2263", "20240101120000", "old"),
        bay("2263", "20240102120000", "new"),
        bay("7542", "not a time"),
        bay("8523", "20240101120000", segment="x9"),
        bay("1", "20240101120000"),
        bay("01", "20240101120000"),
        bay("no number", "20240101120000"),
    ]
    (tmp_path / "bays.json").write_text(json.dumps(landed, indent=1))
    return read_json(spark, str(tmp_path), get_schema("in_parkingbay_schema"), multiline=True)


def test_bays(bays):
    good, bad = standardize_parking_bay(bays, "load-1", WHEN)
    ids = sorted((r.bay_id, r.marker_id) for r in good.collect())
    # "1" and "01" are two raw keys and become one number.
    assert ids == [(1, "m"), (1, "m"), (2263, "new"), (7542, "m"), (8523, "m")]
    found = {r.bay_id: r for r in good.collect()}
    assert found[7542].last_edit is None and found[8523].rd_seg_id is None
    assert bad.count() == 1 and bad.first().load_id == "load-1"
    wanted = get_schema("interim_parkingbay_schema")
    assert [(f.name, f.dataType) for f in good.schema] == [(f.name, f.dataType) for f in wanted]


def test_geometry_is_carried_through(bays):
    good, _ = standardize_parking_bay(bays, "load-1", WHEN)
    assert good.first().the_geom.coordinates == POLYGON["coordinates"]


def test_dedupe_does_not_depend_on_order(spark, bays):
    again = bays.repartition(5)
    first, second = (standardize_parking_bay(b, "l", WHEN)[0] for b in (bays, again))
    assert values(first.drop("the_geom")) == values(second.drop("the_geom"))


def test_dedupe_cuts_before_the_shuffle(bays):
    good, _ = standardize_parking_bay(bays, "l", WHEN)
    assert "WindowGroupLimit" in plan(good) and "Python" not in plan(good)


def test_sensors(rows):
    landed = rows(
        [("5", "st1", "Present", None, "-37.8", "144.9"), ("x", "st1", "Present", None, None, None),
         ("6", None, "Unoccupied", None, "far", "1")],
        "bay_id STRING, st_marker_id STRING, status STRING, "
        "location STRUCT<coordinates: ARRAY<DOUBLE>, type: STRING>, lat STRING, lon STRING",
    )
    good, bad = standardize_sensordata(landed, 1, WHEN)
    assert values(good.select("bay_id", "lat", "st_marker_id")) == [(5, pytest.approx(-37.8), "st1"), (6, None, None)]
    assert bad.count() == 1
    assert dict(good.dtypes)["lat"] == "float"


def test_corrupt_json_is_diverted(spark, tmp_path):
    source, bad = tmp_path / "in", str(tmp_path / "bad")
    source.mkdir()
    (source / "a.json").write_text('{"a": 1}\n{"a": \n{"a": 3}\n')
    for _ in range(2):  # a load that runs again replaces its bad records
        assert values(read_json(spark, str(source), "a INT", bad_path=bad)) == [(1,), (3,)]
        assert [r.record for r in spark.read.json(bad).collect()] == ['{"a": ']
    read_json(spark, str(source), "a INT", bad_path=bad, load_id="later")
    assert spark.read.json(bad).count() == 2


def test_failfast_rejects(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"a;b"\nx,c\n')
    path = str(tmp_path / "a.csv")
    assert read_csv(spark, path, "id INT, name STRING").count() == 2
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        read_csv(spark, path, "id INT, name STRING", mode="FAILFAST").collect()


def test_unknown_schema():
    with pytest.raises(KeyError):
        get_schema("nothing")


DIM = "dim_parking_bay_id STRING, bay_id INT, marker_id STRING, meter_id STRING, rd_seg_dsc STRING, rd_seg_id STRING, load_id STRING, loaded_on TIMESTAMP"
IN = "bay_id INT, marker_id STRING, meter_id STRING, rd_seg_dsc STRING, rd_seg_id INT"
THEN = dt.datetime(2024, 1, 1)


@pytest.fixture
def dim(rows):
    return rows([("id-1", 21016, "a", "b", "c", "1", "first", THEN), ("id-2", 2263, "a", "b", "c", "1", "first", THEN)], DIM)


@pytest.mark.parametrize("duplicates", ["keep", "unique"])
def test_upsert(rows, dim, duplicates):
    arriving = rows([(2263, "A", "B", "C", 2), (7542, "n", "n", "n", 3), (7542, "n", "n", "n", 3)], IN)
    after = scd.process_dim_parking_bay(arriving, dim, "second", WHEN, duplicates=duplicates)
    found = {r.bay_id: r for r in after.collect()}
    assert after.count() == 3
    assert (found[21016].dim_parking_bay_id, found[21016].marker_id, found[21016].load_id) == ("id-1", "a", "first")
    assert (found[2263].dim_parking_bay_id, found[2263].marker_id, found[2263].rd_seg_id) == ("id-2", "A", "2")
    assert found[2263].load_id == "second"
    assert len(found[7542].dim_parking_bay_id) == 36
    assert after.schema.names == [f.split()[0] for f in DIM.split(", ")]
    # The same load again changes nothing.
    again = scd.process_dim_parking_bay(arriving, after, "second", WHEN, duplicates=duplicates)
    assert values(again) == values(after)


def test_versions_of_a_key_stay_apart(rows, dim):
    arriving = rows([(2263, "A", "B", "C", 2), (2263, "Z", "B", "C", 2)], IN)
    for duplicates in ("keep", "unique"):
        after = scd.process_dim_parking_bay(arriving, dim, "s", WHEN, duplicates=duplicates)
        assert values(after.where("bay_id = 2263").select("dim_parking_bay_id", "marker_id")) == [("id-2", "A"), ("id-2", "Z")]


@pytest.mark.parametrize("null_keys", ["ignore", "append"])
@pytest.mark.parametrize("duplicates", ["keep", "unique"])
def test_upsert_against_three_branches(rows, null_keys, duplicates):
    """Random loads against the definition: kept, changed and new rows, one by one."""
    import random

    draw = random.Random(5)

    def key():
        return draw.choice([None, *range(30)])

    layout = "id STRING, a INT, b STRING, v INT, load_id STRING, loaded_on TIMESTAMP"
    keys = {(key(), draw.choice("xy")) for _ in range(40)}
    dim = [(f"id{n}", a, b, draw.randrange(9), "first", THEN) for n, (a, b) in enumerate(sorted(keys, key=str))]
    arriving = [(key(), draw.choice("xyz"), draw.randrange(3)) for _ in range(120)]
    after = scd.scd1_upsert(
        rows(arriving, "a INT, b STRING, v INT"), rows(dim, layout), ["a", "b"], ["v"], "id", "second", WHEN,
        null_keys=null_keys, duplicates=duplicates,
    )
    ids = {(a, b): i for i, a, b, *_ in dim if a is not None}
    came = {r for r in arriving if null_keys == "append" or r[0] is not None}
    wanted = [(i, a, b, v, "first") for i, a, b, v, *_ in dim if (a, b) not in {r[:2] for r in came} or a is None]
    wanted += [(ids.get((a, b), "new"), a, b, v, "second") for a, b, v in came]
    found = [(r.id if r.id.startswith("id") else "new", r.a, r.b, r.v, r.load_id) for r in after.collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)


@pytest.mark.parametrize("null_keys, added", [("ignore", 0), ("append", 1)])
def test_null_keys(rows, null_keys, added):
    dim = rows([("id-0", None, None, "f", THEN)], "dim_location_id STRING, lat FLOAT, lon FLOAT, load_id STRING, loaded_on TIMESTAMP")
    arriving = rows([(1.5, 2.5), (None, 2.5), (1.5, 2.5), (0.0, 1.0), (-0.0, 1.0)], "lat FLOAT, lon FLOAT")
    after = scd.process_dim_location(arriving, dim, "s", WHEN, null_keys=null_keys)
    assert after.count() == 1 + 2 + added
    later = scd.process_dim_location(arriving, after, "t", WHEN, null_keys=null_keys)
    assert later.count() == 1 + 2 + 2 * added
    assert later.select("dim_location_id").distinct().count() == later.count()


def test_key_modes(rows):
    empty = rows([], "dim_st_marker_id STRING, st_marker_id STRING, load_id STRING, loaded_on TIMESTAMP")
    arriving = rows([("a",), ("b",)], "st_marker_id STRING")
    fixed = [values(scd.process_dim_st_marker(arriving, empty, 1, WHEN)) for _ in range(2)]
    assert fixed[0] == fixed[1]
    random = [values(scd.process_dim_st_marker(arriving, empty, 1, WHEN, key_mode="random")) for _ in range(2)]
    assert random[0] != random[1]
    with pytest.raises(ValueError):
        scd.process_dim_st_marker(arriving, empty, 1, WHEN, key_mode="serial")


def test_fact(rows):
    sensor = rows(
        [(5, "s1", 1.5, 2.5, "Present"), (6, None, None, 2.5, "Gone"), (7, "s2", 0.1, 0.2, None)],
        "bay_id INT, st_marker_id STRING, lat FLOAT, lon FLOAT, status STRING",
    )
    bays = rows([("B5", 5)], "dim_parking_bay_id STRING, bay_id INT")
    places = rows([("L1", 1.5, 2.5), ("L2", 0.1, 0.2)], "dim_location_id STRING, lat FLOAT, lon FLOAT")
    markers = rows([("M1", "s1")], "dim_st_marker_id STRING, st_marker_id STRING")
    fact = process_fact_parking(sensor, bays, places, markers, "l", WHEN)
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in get_schema("dw_fact_parking")]
    found = values(fact.select("dim_parking_bay_id", "dim_location_id", "dim_st_marker_id", "status"))
    assert found == sorted(
        [("B5", "L1", "M1", "Present"), (EMPTY_UUID, EMPTY_UUID, EMPTY_UUID, "Gone"), (EMPTY_UUID, "L2", EMPTY_UUID, None)],
        key=str,
    )
    assert fact.first().dim_date_id == "20240301" and fact.first().dim_time_id == 19800
    assert "Python" not in plan(fact)


def test_star_fact_null_key_matches_nothing(rows):
    facts = rows([(None, 1), (2, 2)], "k INT, n INT")
    dim = rows([("null", None), ("two", 2)], "id STRING, k INT")
    assert values(star_fact(facts, [(dim, ["k"], "id")], "-").select("n", "id")) == [(1, "-"), (2, "two")]


@pytest.mark.parametrize(
    "when, until, since",
    [
        (dt.datetime(2024, 1, 1), 0, 0),
        (dt.datetime(2024, 1, 1, 23, 59, 59), 1, 86399),
        (dt.datetime(2024, 1, 1, 0, 0, 0, 1), 86399, 0),
        (dt.datetime(2024, 1, 1, 18, 30, 0, 500000), 19799, 66600),
    ],
)
def test_time_of_load(rows, when, until, since):
    from pyspark.sql import functions as F

    from brightmere.functions.calendar import dim_time_id

    assert (time_of_load(when), time_of_load(when, "since")) == (until, since)
    c = F.col("t")
    found = rows([(when,)], "t TIMESTAMP_NTZ").select(dim_time_id(c), dim_time_id(c, "since")).first()
    assert tuple(found) == (until, since)


def test_reload_takes_any_load_id(spark, rows):
    table = scratch_name("loads")
    first = rows([(1, "it's"), (2, "b")], "n INT, load_id STRING")
    first.write.partitionBy("load_id").option("path", scratch(spark, table)).saveAsTable(table)
    load.reload_idempotent(rows([(9, "it's"), (8, "other")], "n INT, load_id STRING"), table, "it's")
    assert values(spark.table(table)) == [(2, "b"), (9, "it's")]


def test_tables_are_all_tried(spark):
    good = scratch_name("good")
    spec = {"table_types": [{"type": "x", "tables": [
        {"table_name": "bad_one", "create_sql": "CREATE TABLE nonsense"},
        {"table_name": "neither"},
        {"table_name": good, "create_sql": f"CREATE TABLE {good} (a INT) USING parquet LOCATION '{scratch(spark, good)}'"},
    ]}]}
    with pytest.raises(ValueError, match="bad_one.*neither"):
        load.create_tables(spark, spec)
    assert spark.catalog.tableExists(good)


def test_overwrite_self_keeps_the_table_on_failure(spark, rows):
    from pyspark.sql import functions as F

    table = scratch_name("kept")
    rows([(1,), (2,)], "n INT").write.option("path", scratch(spark, table)).saveAsTable(table)
    broken = spark.table(table).withColumn("n", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        load.overwrite_self(spark, broken, table)
    assert values(spark.table(table)) == [(1,), (2,)]


def test_overwrite_self_creates_a_missing_table(spark, rows):
    table = scratch_name("made")
    load.overwrite_self(spark, rows([(1,)], "n INT"), table, scratch(spark, table))
    assert values(spark.table(table)) == [(1,)]


def test_table_names_are_checked(spark):
    from brightmere.sources.files import create_partition_view

    with pytest.raises(ValueError):
        create_partition_view(spark, "t; DROP TABLE t", 2020, 1)
