"""Drifting schemas: all kinds of change, late and repeated rows, ingestion without loss."""

import json
from datetime import datetime

import pytest

from sparkloom.operators import schema_drift as sd

T = "table_id bigint, feed_id bigint, file_no int, delivered_at timestamp_ntz, name string"
C = "table_id bigint, name string, position int, type string"
R = "table_id bigint, row_no bigint, payload string"


@pytest.fixture()
def feed(spark):
    names = [
        {"Qty": ("int64", ["5", "7", "9"]), "Town": ("string", ["Rishpur", "Gharkot", "Rishpur"]), "Paid": ("bool", ["true", "false", "true"])},
        {"Place": ("string", ["Rishpur", "Gharkot", "Gharkot"]), "Qty": ("double", ["5.5", "7.0", "9.0"]), "Paid": ("string", ["Yes", "No", "No"])},
        {"Place": ("string", ["Rishpur", "Gharkot", "Rishpur"]), "quantity": ("int64", ["5", "7", "9"]), "Note": ("string", ["the old book", "a big bag", "the old book"])},
    ]
    tables, columns, register = [], [], []
    for i, cols in enumerate(names, 1):
        tables.append((i, 1, i * 2, datetime(2024, 1, 9 - i), "clash"))  # gaps in file_no, delivered in reverse
        for p, (n, (t, v)) in enumerate(cols.items()):
            columns.append((i, n, p, t))
        for r in range(3):
            register.append((i, r, json.dumps({n: v[r] for n, (t, v) in cols.items()})))
    double = lambda x: x + x[:2]  # noqa: E731 - repeated rows
    return spark.createDataFrame(double(tables), T), spark.createDataFrame(double(columns), C), spark.createDataFrame(double(register), R)


def test_changes(feed):
    got = {tuple(r) for r in sd.schema_changes(*feed).collect()}
    assert got == {
        (1, 4, "renamed", "Town", "Place"), (1, 4, "retyped", "Qty", "Qty"), (1, 4, "retyped", "Paid", "Paid"),
        (1, 6, "renamed", "Qty", "quantity"), (1, 6, "retyped", "Qty", "quantity"), (1, 6, "removed", "Paid", ""), (1, 6, "added", "", "Note"),
    }


def test_ingestion_keeps_everything(feed):
    rows = {(r.file_no, r.row_no): r for r in sd.ingest_feeds(*feed).collect()}
    assert len(rows) == 9
    assert rows[(2, 0)]["values"]["Place"] == "Rishpur" and rows[(2, 0)]["values"]["quantity"] == "5"
    assert json.loads(rows[(4, 0)].rescued) == {"Qty": "5.5"}  # no whole number, kept as it is
    assert rows[(4, 1)]["values"]["quantity"] == "7" and rows[(4, 1)]["values"]["Paid"] == "No"


def test_unapproved_fields_are_rescued(spark, feed):
    approved = spark.createDataFrame([(1, "Place"), (1, "quantity"), (1, "Paid")], "feed_id bigint, column string")
    rows = {(r.file_no, r.row_no): r for r in sd.ingest_feeds(*feed, approved).collect()}
    assert json.loads(rows[(6, 1)].rescued) == {"Note": "a big bag"}


def test_empty_and_null(spark, feed):
    t, c, r = feed
    assert sd.schema_changes(t.limit(0), c.limit(0), r.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None)], T)
    assert sd.schema_changes(nulls.unionByName(t), c, r.unionByName(spark.createDataFrame([(1, 9, None), (1, 10, "[1]")], R))).count() == 7


def test_a_feeds_table_has_typed_columns(spark, feed):
    schema = [(r.column, r.target) for r in sd.feed_schemas(*feed).where("feed_id = 1").orderBy("column").collect()]
    rows = sd.ingest_feeds(*feed)
    t = sd.feed_table(rows, 1, schema)
    kinds, got = dict(t.dtypes), {(r.file_no, r.row_no): r for r in t.collect()}
    assert kinds["quantity"] == "bigint" and set(kinds) == {"file_no", "row_no", *[c for c, _ in schema]}
    assert got[(2, 0)].quantity == 5 and got[(2, 0)].Place == "Rishpur" and got[(4, 0)].quantity is None and len(got) == 9
    odd = spark.createDataFrame([(7, 1, 1, 0, {'a"b': 'x\n"y"', "row_no": "3"}, '{"a\\"b":"x\\n\\"y\\"","row_no":3}', "{}")], "feed_id bigint, file_no bigint, table_id bigint, row_no bigint, values map<string,string>, typed string, rescued string")
    r = sd.feed_table(odd, 7, [('a"b', "string"), ("row_no", "int64")]).first()
    assert r['a"b'] == 'x\n"y"' and r["row_no_2"] == 3
