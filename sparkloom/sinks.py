"""Sinks: versioned tables, one Parquet table per extracted table, indexes with their metadata. Nothing is ever written over."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.common import cut
from sparkloom.operators import tables


def write_version(df: DataFrame, root: str, name: str, ordinal: int, by: list[str] | None = None) -> str:
    """A table as version r%06d below ``root``; a version that exists is an error."""
    path = f"{root}/{name}/version=r{ordinal:06d}"
    w = df.write.mode("errorifexists")
    (w.partitionBy(*by) if by else w).parquet(path)
    return path


def write_typed_tables(cells: DataFrame, root: str, names: list[str], key: str = "row_no") -> dict[str, str]:
    """One typed Parquet table for each of the asked-for tables of the long cells table (table_name, row_no, name, value).

    Tables that share their columns and types are written by one job, as
    partitions by table that then get their names; there are as many jobs as
    there are schemas, not tables. The names are the
    caller's choice of what to materialise, not all there are. Names that
    collide as folder names get a number. Returns the path of each table.
    """
    mine = cut(cells.where(F.col("table_name").isin(names)), "typed-cells")
    types: dict[str, dict[str, str]] = {}
    for r in tables.infer_types(mine).orderBy("table_name", "name").collect():  # the asked-for tables' columns
        types.setdefault(r.table_name, {})[r.name] = r.type
    slugs, used = {}, set()
    for n in names:
        slug = base = "".join(c if c.isalnum() else "_" for c in n.lower()).strip("_") or "table"
        i = 1
        while slug in used:
            i += 1
            slug = f"{base}_{i}"
        used.add(slug)
        slugs[n] = slug
    schemas: dict[tuple, list[str]] = {}
    for n, kinds in types.items():
        schemas.setdefault(tuple(kinds.items()), []).append(n)
    out = {}
    for kinds, group in schemas.items():
        named = F.create_map(*[F.lit(x) for n in group for x in (n, slugs[n])])
        own = mine.where(F.col("table_name").isin(group)).withColumn("_table", F.element_at(named, F.col("table_name")))
        typed = tables.typed_table(own, dict(kinds), ["_table", key])
        staged = f"{root}/_writing-{uuid.uuid4().hex}"
        typed.write.option("compression", "snappy").partitionBy("_table").parquet(staged)
        for n in group:
            out[n] = f"{root}/{slugs[n]}.parquet"
            _rename(cells.sparkSession, f"{staged}/_table={slugs[n]}", out[n])
        _remove(cells.sparkSession, staged)
    return out


def _rename(spark: SparkSession, old: str, new: str) -> None:
    """Publish what was written under another name; a name that is taken is an error."""
    if exists(spark, new):
        raise FileExistsError(f"{new} already exists")
    a, b = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(x) for x in (old, new))
    if not a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(a, b):
        raise OSError(f"{old} cannot be renamed to {new}")


def _remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def write_index(vectors: DataFrame, root: str, version: str, model: str) -> None:
    """Vectors by scope with a metadata row per scope: model, dimension, number of vectors."""
    vectors.write.mode("errorifexists").partitionBy("scope_id").parquet(f"{root}/vectors/version={version}")
    meta = vectors.groupBy("scope_id").agg(F.max(F.size("vector")).alias("dimension"), F.count(F.lit(1)).alias("vector_count")).withColumn("embedding_model", F.lit(model))
    meta.write.mode("errorifexists").parquet(f"{root}/index_meta/version={version}")


def load_index(spark: SparkSession, root: str, version: str) -> DataFrame:
    """An index whose counts agree with its metadata; an index that does not agree raises."""
    vectors = spark.read.parquet(f"{root}/vectors/version={version}")
    meta = spark.read.parquet(f"{root}/index_meta/version={version}")
    have = vectors.groupBy("scope_id").agg(F.count(F.lit(1)).alias("n"), F.max("row_no").alias("last"))
    bad = meta.join(have, "scope_id", "full_outer").where("n is null or vector_count is null or n <> vector_count or last + 1 <> n")
    if not bad.isEmpty():
        raise ValueError("the index and its metadata do not agree")
    return vectors


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is at a path of any file system Spark knows."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where))


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names behind ``version=`` below a path, in order; none if nothing is there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(n.partition("=")[2] for n in names if n.startswith("version="))


def next_version(spark: SparkSession, path: str) -> int:
    """The number after the highest version below a path."""
    return max([int(v[1:]) for v in versions(spark, path) if v[1:].isdigit()], default=0) + 1


def newest_index(spark: SparkSession, root: str) -> DataFrame:
    """The newest index that can be loaded and agrees with its metadata; damaged and half-written ones are passed over."""
    for version in reversed(versions(spark, f"{root}/vectors")):
        try:
            return load_index(spark, root, version)
        except (ValueError, AnalysisException):
            continue
    raise LookupError("no index agrees with its metadata")
