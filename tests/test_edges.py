"""One small hand-written case per peculiarity of the data."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest

from inspectstar import schema as names
from inspectstar.operators import Lookup, lookup
from inspectstar.sinks import overwrite
from inspectstar.sources import frame_of, parse_records, read_fields, read_records
from tests.conftest import record, tuples


def test_null_matches_the_null_member(spark):
    rows = spark.createDataFrame([("x", None), ("y", "A")], "id string, grade string")
    dim = spark.createDataFrame([(1, None), (2, "A")], "GRADE_SK int, GRADE string")
    found = lookup(rows, Lookup(dim, {"grade": "GRADE"}, ("GRADE_SK",)))
    assert tuples(found) == [("x", None, 1), ("y", "A", 2)]


def test_lookup_drops_rows_without_member(spark):
    rows = spark.createDataFrame([("x", "B"), ("y", "A"), ("z", None)], "id string, grade string")
    dim = spark.createDataFrame([(2, "A")], "GRADE_SK int, GRADE string")
    found = lookup(rows, Lookup(dim, {"grade": "GRADE"}, ("GRADE_SK",)))
    assert tuples(found) == [("y", "A", 2)]


def test_partly_null_composite_key(spark):
    rows = spark.createDataFrame([("04A", None), ("04A", "x"), (None, None)], "c string, d string")
    members = [(1, None, None), (2, "04A", None), (3, "04A", "x"), (4, None, "x")]
    dim = spark.createDataFrame(members, "SK int, CODE string, TEXT string")
    found = lookup(rows, Lookup(dim, {"c": "CODE", "d": "TEXT"}, ("SK",)))
    assert tuples(found) == [(None, None, 1), ("04A", None, 2), ("04A", "x", 3)]


def test_place_without_id(built):
    read = built([record(), record(camis=None, dba="Ghost", phone="777")])
    assert tuples(read(names.FOOD_PLACES), "CAMIS", "DBA") == [("1", "Diner")]
    assert tuples(read(names.INSPECTIONS), "PHONE") == [("555",)]
    assert tuples(read(names.VIOLATIONS), "PHONE") == [("555",)]


def test_violation_without_place_id_joins_by_date_and_phone(built):
    read = built([record(), record(camis=None, violation_code="10F")])
    assert read(names.INSPECTIONS).count() == 1
    assert read(names.VIOLATIONS).count() == 2


def test_name_arriving_late(dimension):
    records = [record(dba=None), record(dba="X"), record(camis="2", dba=None)]
    places = dimension(records, names.FOOD_PLACES)
    assert tuples(places, "CAMIS", "DBA") == [("1", "X"), ("2", None)]


def test_address_fanout_settles_on_one_inspection(built):
    read = built([record(street="Broad"), record(camis="2", street="Main")])
    addresses = read(names.ADDRESSES)
    assert addresses.count() == 2
    smallest = min(r.ADDRESS_SK for r in addresses.collect())
    assert tuples(read(names.INSPECTIONS), "FOOD_PLACES_SK", "ADDRESS_SK") == [
        (1, smallest),
        (2, smallest),
    ]


def test_shared_phone_attaches_violations_to_both_places(built):
    read = built([record(), record(camis="2", violation_code="10F")])
    assert read(names.INSPECTIONS).count() == 2
    pairs = tuples(read(names.VIOLATIONS), "INSPECTION_SK", "VIOLATION_CODE_SK")
    assert pairs == [(1, 1), (1, 2), (2, 1), (2, 2)]


def test_missing_phones_and_dates_match_each_other(built):
    read = built(
        [
            record(camis="1", phone=None),
            record(camis="2", phone=None),
            record(camis="3", phone=None, inspection_date=None),
        ]
    )
    pairs = tuples(read(names.VIOLATIONS), "INSCPECTION_DATE", "FOOD_PLACES_SK")
    assert pairs == [(None, 3), ("2023-01-02", 1), ("2023-01-02", 2)]


def test_unreadable_and_padded_numbers(dimension):
    records = [
        record(census_tract="abc", latitude="north"),
        record(camis="2", building="20", census_tract="010300"),
    ]
    addresses = dimension(records, names.ADDRESSES)
    rows = tuples(addresses, "BUILDING", "CENSUS_TRACT", "LATITUTDE")
    assert [r[1:] for r in rows] == [(None, None), (10300, Decimal("40.5"))]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts_do_not_depend_on_ansi(spark, dimension, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        addresses = dimension([record(census_tract="abc")], names.ADDRESSES)
        assert tuples(addresses, "CENSUS_TRACT", "ADDRESS_SK") == [(None, 1)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_address_attributes_come_from_one_row(dimension):
    records = [record(latitude="2", longitude="1"), record(latitude="1", longitude="9")]
    addresses = dimension(records, names.ADDRESSES)
    assert tuples(addresses, "LATITUTDE", "LONGITUDE") == [(1, 9)]


def test_empty_and_null_partition_values(spark, tmp_path, built):
    read = built([record(boro=""), record(camis="2", boro=None)])
    assert tuples(read(names.BOROUGH), "BOROUGH_SK", "BOROUGH") == [(1, None), (2, "")]
    assert tuples(read(names.ADDRESSES), "BOROUGH", "ADDRESS_SK") == [(None, 1), (None, 2)]


def test_missing_and_extra_fields_of_a_record(spark, tmp_path):
    path = tmp_path / "records"
    path.mkdir()
    (path / "part-0.json").write_text('{"camis": "1", "score": 7, "location": {"x": 1}}\n')
    row = read_records(spark, str(path)).first()
    assert (row.camis, row.score, row.grade) == ("1", "7", None)
    assert row.asDict().keys() == set(names.STAGE_COLUMNS)
    assert frame_of(spark, [{"camis": "1"}]).first().grade is None


def test_records_in_arrays(spark, tmp_path):
    (tmp_path / "page-1.json").write_text('[{"camis": "1"},\n{"camis": "2", "grade": "A"}]')
    (tmp_path / "page-2.json").write_text('[{"camis": "3"}]')
    rows = read_records(spark, str(tmp_path), arrays=True)
    assert tuples(rows, "camis", "grade") == [("1", None), ("2", "A"), ("3", None)]


def test_malformed_records_fail(spark, tmp_path):
    path = tmp_path / "records"
    path.mkdir()
    (path / "part-0.json").write_text('{"camis": "1"}\n{"camis": \n')
    with pytest.raises(Exception, match="[Mm]alformed"):
        read_records(spark, str(path)).collect()
    lines = spark.createDataFrame([('{"camis": ',)], "record string")
    with pytest.raises(Exception, match="[Mm]alformed"):
        parse_records(lines, "record").collect()
    for missing in (None, "", "  "):
        lines = spark.createDataFrame([('{"camis": "1"}',), (missing,)], "record string")
        with pytest.raises(Exception, match="NULL or empty"):
            parse_records(lines, "record").collect()


def test_short_lines(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("a,b,c\nd,e\n\nf,g,h,i\n")
    fields = read_fields(spark, str(tmp_path / "lines.txt"), ["x", "y", "z"])
    assert tuples(fields) == [
        ("", None, None),
        ("a", "b", "c"),
        ("d", "e", None),
        ("f", "g", "h"),
    ]


def test_second_write_replaces_the_first(spark, tmp_path):
    path = str(tmp_path / "table")
    overwrite(spark.range(5), path)
    overwrite(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_fixed_audit_columns(built):
    moment = datetime.datetime(2024, 5, 6, 7, 8, 9)
    read = built([record()], as_of=moment)
    for table in (names.BOROUGH, names.INSPECTIONS, names.VIOLATIONS):
        assert read(table).first().INGESTION_DATE == moment.date()


def test_audit_columns_follow_the_clock(dimension):
    row = dimension([record()], names.BOROUGH).first()
    assert abs(row.INGESTION_TIME - datetime.datetime.now()) < datetime.timedelta(days=1)


def test_empty_staging(built):
    read = built([])
    assert read(names.FOOD_PLACES).count() == 0


def test_table_layouts(built):
    read = built([record()])
    audit = list(names.AUDIT_COLUMNS)
    inspections = read(names.INSPECTIONS)
    assert sorted(inspections.columns) == sorted([*names.INSPECTION_COLUMNS, *audit])
    assert dict(read(names.ADDRESSES).dtypes) == {
        "ADDRESS_SK": "int",
        "BUILDING": "string",
        "BBL": "string",
        "BIN": "string",
        "STREET": "string",
        "ZIPCODE": "string",
        "BOROUGH": "string",
        "NTA": "string",
        "LATITUTDE": "decimal(38,12)",
        "LONGITUDE": "decimal(38,12)",
        "CENSUS_TRACT": "int",
        "COMMUNITY_BOARD": "int",
        "COUNCIL_DISTRICT": "int",
        "INGESTION_DATE": "date",
        "INGESTION_TIME": "timestamp",
    }
    violations = dict(read(names.VIOLATIONS).dtypes)
    assert sorted(violations) == sorted([*names.VIOLATION_COLUMNS, *audit])
    assert all(t == "int" for c, t in violations.items() if c.endswith("_SK"))
