"""Processing only new or changed records.

Method: rows are hashed into key buckets, whose number grows with the data in
steps of four (a state of another number is built anew beside the old one).
Buckets of one scope lie together, so what a day changes in a few scopes
touches their buckets only; a hot scope has many. Each bucket of the
input has a fingerprint, its row count with two additive row hashes, which is
order-free and merges map-side. A bucket is recomputed only when its
fingerprint differs from the one stored with its last result, and it is
replaced through dynamic partition overwrite. The fingerprint travels *inside*
the bucket's files as a marker row, so result and fingerprint change together:
a run that dies before the commit leaves the old pair, a run that dies between
two bucket swaps leaves some buckets old and some new, and the next run redoes
exactly the ones whose marker is missing or stale. Nothing is skipped and
nothing is repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "_bucket"
MARK = "_fingerprint"

#: Statuses after which the work has to be done again (fixed values).
RETRY_STATUSES = ("partial", "failed", "locked")


#: Rows that one bucket is made for.
BUCKET_ROWS = 250_000


def key_bucket(keys: list[Column], buckets: int) -> Column:
    """Bucket of a record: a group by the first key (the scope), a place in the group by the full key.

    A scope lies in one group of about the square root of ``buckets`` buckets,
    so that a change in it redoes only those, and a hot scope is split over all of them.
    """
    inner = 1 << (buckets.bit_length() - 1) // 2
    outer = max(1, buckets // inner)
    return (F.pmod(F.xxhash64(keys[0]), F.lit(outer)) * inner + F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(inner))).cast("int")


def bucket_count(rows: int, least: int = 64) -> int:
    """Buckets for so many rows: ``least``, times four until a bucket holds BUCKET_ROWS at most on average."""
    n = least
    while rows > n * BUCKET_ROWS:
        n *= 4
    return n


def _row_hash(df: DataFrame, seed: int) -> Column:
    # A null leaves xxhash64 as it is, so the null flags are hashed too.
    cols = [F.col(f"`{c}`") for c in sorted(c for c in df.columns if c != BUCKET)]
    return F.xxhash64(F.lit(seed), *cols, *[c.isNull() for c in cols])


def bucket_fingerprints(df: DataFrame, side: str) -> DataFrame:
    """One row per bucket: count and additive hashes (sums modulo 2^64 of two row hashes).

    Sums are taken over decimals so that they cannot overflow; they do not
    depend on order or on how the rows are spread over files.
    """
    hashed = df.select(BUCKET, _row_hash(df, 1).alias("_h1"), _row_hash(df, 2).alias("_h2"))
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).cast("string")
    return hashed.groupBy(BUCKET).agg(
        F.concat_ws(":", F.lit(side), F.count(F.lit(1)).cast("string"), total("_h1"), total("_h2")).alias("_part")
    )


def partition_fingerprints(sides: dict[str, DataFrame]) -> DataFrame:
    """Fingerprint of each bucket over all named inputs (bounded: at most ``buckets`` rows)."""
    parts = None
    for side in sorted(sides):
        part = bucket_fingerprints(sides[side], side)
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy(BUCKET).agg(F.sha2(F.concat_ws("|", F.sort_array(F.collect_list("_part"))), 256).alias(MARK))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jvm_path)) and any(s.getPath().getName().startswith(f"{BUCKET}=") for s in fs.listStatus(jvm_path))


def incremental_refresh(
    sides: dict[str, DataFrame],
    compute: Callable[[dict[str, DataFrame]], DataFrame],
    state_path: str,
    constants: str = "",
) -> dict[str, int]:
    """Bring the result at ``state_path`` up to date and say how many buckets were redone.

    sides: inputs that carry the ``_bucket`` column. compute: maps the inputs,
    cut down to the changed buckets, to the result (it must keep ``_bucket``
    and derive each row only from rows of the same bucket). constants: stands
    for small inputs that bear on every bucket; a change redoes all.

    Buckets that lost all their input are replaced by nothing. Empty inputs
    give an empty result.
    """
    spark = next(iter(sides.values())).sparkSession
    now = partition_fingerprints(sides).withColumn(MARK, F.sha2(F.concat_ws("|", F.col(MARK), F.lit(constants)), 256))
    if _exists(spark, state_path):
        before = spark.read.parquet(state_path).where(F.col(MARK).isNotNull()).select(BUCKET, F.col(MARK).alias("_old"))
        delta = (
            now.join(before, BUCKET, "full_outer")
            .where(F.col(MARK).isNull() | F.col("_old").isNull() | (F.col(MARK) != F.col("_old")))
            .select(BUCKET, MARK)
        )
    else:
        delta = now.select(BUCKET, MARK)
    # At most one row per bucket, whatever the size of the data.
    changed = [(r[BUCKET], r[MARK]) for r in delta.collect()]
    if not changed:
        return {"changed": 0}
    marks = spark.createDataFrame(
        [(b, m or "empty") for b, m in changed], f"{BUCKET} int, {MARK} string"
    )
    ids = [b for b, _ in changed]
    part = {k: df.where(F.col(BUCKET).isin(ids)) for k, df in sides.items()}
    result = compute(part).withColumn(MARK, F.lit(None).cast("string"))
    rows = result.unionByName(marks, allowMissingColumns=True)
    (
        rows.repartition(F.col(BUCKET))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(state_path)
    )
    return {"changed": len(changed)}


def read_result(spark: SparkSession, state_path: str, schema: str | None = None) -> DataFrame:
    """The current result, without markers. Where nothing was ever written, no rows of ``schema``."""
    if schema is not None and not _exists(spark, state_path):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(state_path).where(F.col(MARK).isNull()).drop(MARK, BUCKET)


def pending_work(queue: DataFrame, entries: DataFrame, seals: DataFrame, state_path: str, buckets: int | None = None) -> DataFrame:
    """Work of ``queue`` that still has to be done, once each.

    A piece of work is (scope_id, lower-case content_hexdigest, route). It is
    pending if no entry of a sealed run exists for it, or if its entry of the
    latest sealed run carries another fingerprint than the queue or a status of
    ``RETRY_STATUSES``. Runs without ``sealed_at`` count as if they had not
    been. Work with a null in its key is never matched by an entry and stays
    pending. If repeated queue rows disagree on the fingerprint, the latest
    ``discovered_at`` (ties: the greatest fingerprint) is in force; if several
    entries of the same latest run disagree, work is settled when one of them
    settles it (a null fingerprint or status settles nothing). Extra columns are ignored. Empty tables give empty results.
    ``buckets``: by default as many as the data need.
    """
    return refresh_pending(queue, entries, seals, state_path, buckets)[0]


def refresh_pending(queue: DataFrame, entries: DataFrame, seals: DataFrame, state_path: str, buckets: int | None = None) -> tuple[DataFrame, dict[str, int]]:
    """pending_work, and how many buckets there are and were redone."""
    spark = queue.sparkSession
    buckets = buckets or bucket_count(queue.count() + entries.count())
    state_path = f"{state_path}/buckets={buckets}"
    keys = ["scope_id", "content_hexdigest", "route"]
    norm = lambda df: df.withColumn("content_hexdigest", F.lower("content_hexdigest"))
    bucket = key_bucket([F.col(k) for k in keys], buckets)
    q = norm(queue.select(*keys, "route_fingerprint", "discovered_at")).withColumn(BUCKET, bucket)
    # Seals are one row per run: folded into the entries first, so a newly sealed run changes its buckets' fingerprints.
    sealed = seals.where(F.col("sealed_at").isNotNull()).select("run_ordinal").distinct()
    e = norm(entries.select(*keys, "route_fingerprint", "run_ordinal", "status")).join(sealed, "run_ordinal", "left_semi").withColumn(BUCKET, bucket)

    def compute(part: dict[str, DataFrame]) -> DataFrame:
        # Both sides are reduced to one row per key map-side before they meet.
        wanted = part["queue"].groupBy(BUCKET, *keys).agg(
            F.max(F.struct("discovered_at", "route_fingerprint")).getField("route_fingerprint").alias("wanted")
        )
        ok = F.coalesce(~F.col("status").isin(*RETRY_STATUSES), F.lit(False))
        by_print = part["entries"].groupBy(BUCKET, *keys, F.col("route_fingerprint").alias("used")).agg(
            F.max(F.struct(F.col("run_ordinal"), ok.alias("ok"))).alias("last")
        )
        settles = F.col("last.ok") & F.coalesce(F.col("used") == F.col("wanted"), F.lit(False))
        state = (
            by_print.join(wanted, [BUCKET, *keys])
            .groupBy(BUCKET, *keys)
            .agg(F.max(F.struct(F.col("last.run_ordinal"), settles.alias("settled"))).alias("latest"))
            .where(F.col("latest.settled"))
        )
        return wanted.join(state, [BUCKET, *keys], "left_anti").select(BUCKET, *keys, F.col("wanted").alias("route_fingerprint"))

    told = incremental_refresh({"queue": q, "entries": e}, compute, state_path)
    return read_result(spark, state_path, "scope_id string, content_hexdigest string, route string, route_fingerprint string"), told | {"buckets": buckets}
