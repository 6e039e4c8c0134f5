"""Sinks: nothing is written over, names do not collide, indexes are checked on load."""

import pytest

from sparkloom import sinks


def test_versions_and_typed_tables(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    cells = spark.createDataFrame([(t, r, n, v) for t in ("A b", "a-b") for r, (x, y) in enumerate([("0012", "1"), ("7", "2")]) for n, v in (("code", x), ("n", y))], "table_name string, row_no bigint, name string, value string")
    paths = sinks.write_typed_tables(cells, root, ["A b", "a-b", "none"])
    assert sorted(p.rsplit("/", 1)[1] for p in paths.values()) == ["a_b.parquet", "a_b_2.parquet"]
    assert dict(spark.read.parquet(paths["A b"]).dtypes) == {"row_no": "bigint", "code": "string", "n": "bigint"}
    sinks.write_version(cells, root, "cells", 3)
    with pytest.raises(Exception, match="already exists"):
        sinks.write_version(cells, root, "cells", 3)


def test_index_is_checked(spark, tmp_path):
    root = f"file://{tmp_path}/ix"
    v = spark.createDataFrame([("s", 0, "a", [1.0]), ("s", 1, "b", [0.5])], "scope_id string, row_no bigint, chunk_id string, vector array<float>")
    sinks.write_index(v, root, "g000001", "letters")
    assert sinks.load_index(spark, root, "g000001").count() == 2
    sinks.write_index(v.where("row_no = 1"), root, "g000002", "letters")
    with pytest.raises(ValueError, match="do not agree"):
        sinks.load_index(spark, root, "g000002")


def test_the_newest_index_that_agrees_is_loaded(spark, tmp_path):
    root = f"file://{tmp_path}/ix"
    v = spark.createDataFrame([("s", 0, "a", [1.0]), ("s", 1, "b", [0.5])], "scope_id string, row_no bigint, chunk_id string, vector array<float>")
    with pytest.raises(LookupError):
        sinks.newest_index(spark, root)
    sinks.write_index(v, root, "g000001", "letters")
    assert sinks.next_version(spark, f"{root}/vectors") == 2
    sinks.write_index(v.where("row_no = 1"), root, "g000002", "letters")  # does not agree
    v.write.partitionBy("scope_id").parquet(f"{root}/vectors/version=g000003")  # half written
    assert sinks.newest_index(spark, root).count() == 2


def test_many_tables_of_one_schema_are_one_write(spark, tmp_path):
    root = f"file://{tmp_path}/many"
    cells = spark.createDataFrame([(f"t{i}", r, "n", str(r)) for i in range(30) for r in range(3)], "table_name string, row_no bigint, name string, value string")
    paths = sinks.write_typed_tables(cells, root, [f"t{i}" for i in range(30)])
    assert len(paths) == 30 and all(spark.read.parquet(p).count() == 3 for p in list(paths.values())[:3])
    with pytest.raises(FileExistsError):
        sinks.write_typed_tables(cells, root, ["t4"])
