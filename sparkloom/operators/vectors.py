"""Exact vector retrieval: embedding, per-scope indexes, filtered top-k with citations."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, StructField, StructType

from sparkloom.common import cut

#: Questions that are scored in one pass, and rows that are scored against them at a time.
QUERY_BLOCK, ROW_BLOCK = 1024, 256


def inner_product(a: Column, b: Column) -> Column:
    """Sum of products in double, in the vectors' order."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def character_embedder(dimension: int = 16) -> Callable[[list[str]], list[list[float]]]:
    """A deterministic stand-in for a model: counts of code points modulo the dimension, unit length."""

    def encode(texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            v = [0.0] * dimension
            for c in t:
                v[ord(c) % dimension] += 1.0
            n = math.sqrt(sum(x * x for x in v)) or 1.0
            out.append([x / n for x in v])
        return out

    return encode


def embed(chunks: DataFrame, encode: Callable[[list[str]], list[list[float]]], text: str = "text", batch: int = 256) -> DataFrame:
    """chunks with ``vector``; blank texts are never embedded and come out with null. A model that returns another number of vectors is an error."""

    @F.pandas_udf("array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out: list[list[float] | None] = [None] * len(s)
            real = [i for i, t in enumerate(s) if t is not None and t.strip()]
            for at in range(0, len(real), batch):
                part = real[at : at + batch]
                got = encode([s.iloc[i] for i in part])
                if len(got) != len(part):
                    raise ValueError("the embedder returned another number of vectors than texts")
                for i, v in zip(part, got, strict=True):
                    out[i] = v
            yield pd.Series(out)

    return chunks.withColumn("vector", vectors(F.col(text)))


def index_rows(chunks: DataFrame, digits: int = 3) -> DataFrame:
    """chunks with ``row_no`` from 0 within their scope, by content and seq (ties: chunk_id).

    Numbered in two steps, so that a scope that holds a third of all rows is
    no single task: within each of the 16^digits ranges of content hashes,
    then shifted by the sizes of the ranges before.
    """
    ranged = chunks.withColumn("_p", F.substring("content_sha256", 1, digits))
    sizes = ranged.groupBy("scope_id", "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("scope_id").orderBy("_p")
    offsets = sizes.select("scope_id", "_p", (F.sum("_n").over(before) - F.col("_n")).alias("_o"))
    inner = Window.partitionBy("scope_id", "_p").orderBy("content_sha256", "seq", "chunk_id")
    numbered = ranged.withColumn("_r", F.row_number().over(inner) - 1).join(offsets, ["scope_id", "_p"])
    return numbered.withColumn("row_no", F.col("_r") + F.col("_o")).drop("_p", "_r", "_o")


def scored(vectors: DataFrame, query: list[float], vector: str = "vector") -> DataFrame:
    """vectors with their ``score`` against one question's vector, which is part of the plan.

    A vector of another dimension raises, it is never skipped.
    """
    q = F.array(*[F.lit(float(x)) for x in query])
    right = F.when(F.size(vector) == len(query), F.col(vector)).otherwise(
        F.raise_error(F.lit("the index and the query have different dimensions")).cast(vectors.schema[vector].dataType)
    )
    return vectors.withColumn("score", inner_product(right, q))


def _filtered(vectors: DataFrame, scope_id: str | None, client: str | None, category: str | None, scope: str) -> DataFrame:
    v = vectors
    if scope_id is not None:
        v = v.where(F.col(scope) == scope_id)
    for name, want in (("client", client), ("category", category)):
        if want is not None:
            v = v.where(F.lower(name).contains(want.lower()))
    return v


def search(
    vectors: DataFrame, query: list[float], k: int = 5, scope_id: str | None = None, client: str | None = None, category: str | None = None,
    scope: str = "scope_id", key: str = "chunk_id",
) -> DataFrame:
    """The k best rows over all scopes by inner product: filters first, k per scope, then k of all; ties by key.

    client and category match as case-insensitive substrings, scope_id exactly.
    Rows are cut to k per scope and salt before they are cut to k per scope,
    so a scope that holds a third of all rows is spread over the salts.
    """
    rows = scored(_filtered(vectors, scope_id, client, category, scope), query).drop("vector")
    salt = F.pmod(F.xxhash64(key), F.lit(32))
    order = [F.desc("score"), F.asc(key)]
    some = rows.withColumn("_s", salt).withColumn("_r", F.row_number().over(Window.partitionBy(scope, "_s").orderBy(*order))).where(F.col("_r") <= k)
    per = some.withColumn("_r", F.row_number().over(Window.partitionBy(scope).orderBy(*order))).where(F.col("_r") <= k)
    return per.drop("_r", "_s").orderBy(*order).limit(k)


def search_set(
    vectors: DataFrame, queries: DataFrame, k: int = 5, scope_id: str | None = None, client: str | None = None, category: str | None = None,
    scope: str = "scope_id", key: str = "chunk_id",
) -> DataFrame:
    """``query_id`` with each of the k best rows of every question of queries (query_id, vector), as ``search`` finds them; ties by key.

    QUERY_BLOCK questions are sent to the tasks at a time, whatever their
    number. A task passes on only rows that reach the k best it has met (ties
    included); those are cut to k per question and salt, then k per question.
    Scores are summed in the vectors' order, so they are those of ``search``.
    """
    rows = _filtered(vectors, scope_id, client, category, scope)
    kept = [f for f in rows.schema.fields if f.name != "vector"]
    id_field = queries.schema["query_id"]
    out_type = StructType([id_field, *kept, StructField("score", DoubleType())])
    found = rows.sparkSession.createDataFrame([], out_type)
    for ids, block in _query_blocks(queries):
        shared = rows.sparkSession.sparkContext.broadcast((ids, block))
        best = rows.select(*[f.name for f in kept], "vector").mapInArrow(_best_rows(shared, k, to_arrow_type(id_field.dataType)), out_type)
        found = found.unionByName(cut(_cut_to(_cut_to(best, k, key, F.pmod(F.xxhash64(key), F.lit(32))), k, key), "search-block"))
    return found


def _query_blocks(queries: DataFrame) -> Iterator[tuple[list, np.ndarray]]:
    ids, held = [], []
    for r in queries.select("query_id", "vector").toLocalIterator():
        ids.append(r.query_id)
        held.append(r.vector)
        if len(ids) == QUERY_BLOCK:
            yield ids, np.array(held, np.float64)
            ids, held = [], []
    if ids:
        yield ids, np.array(held, np.float64)


def _cut_to(rows: DataFrame, k: int, key: str, *within: Column) -> DataFrame:
    w = Window.partitionBy("query_id", *within).orderBy(F.desc("score"), F.asc(key))
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def _best_rows(shared, k: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        best = np.full((len(ids), k), -np.inf)
        for batch in batches:
            for at in range(0, batch.num_rows, ROW_BLOCK):
                b = batch.slice(at, ROW_BLOCK)
                v = b.column(b.num_columns - 1)
                if v.null_count or set(v.value_lengths().to_pylist()) != {q.shape[1]}:
                    raise ValueError("the index and the query have different dimensions")
                x = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1).T.copy()
                score = np.zeros((len(ids), b.num_rows))
                for i in range(len(x)):
                    score += q[:, i, None] * x[i][None, :]
                best = np.partition(np.concatenate([best, score], axis=1), -k, axis=1)[:, -k:]
                of, row = np.nonzero(score >= best.min(axis=1)[:, None])
                take = pa.array(row, pa.int64())
                named = dict(zip(b.schema.names[:-1], (c.take(take) for c in b.columns[:-1]), strict=True))
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(ids, id_type).take(pa.array(of, pa.int64()))} | named | {"score": pa.array(score[of, row])})

    return run


def citation(client: Column, path: Column, unit_ref: Column) -> Column:
    return F.concat(client, F.lit(" - "), path, F.lit(" ["), unit_ref, F.lit("]"))
