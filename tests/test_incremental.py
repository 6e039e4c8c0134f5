"""Only new or changed work: settled and open states, incremental refresh, edge cases."""

from datetime import datetime

from pyspark.sql import functions as F

from sparkloom.operators import incremental as inc

Q = "scope_id string, content_hexdigest string, route string, route_fingerprint string, source_path string, discovered_at timestamp_ntz, status string"
E = "scope_id string, content_hexdigest string, route string, route_fingerprint string, run_ordinal int, status string, version_id string"
S = "run_ordinal int, sealed_at timestamp_ntz"
T = datetime(2024, 1, 1)


def frames(spark, queue, entries, seals):
    q = spark.createDataFrame([(s, h, r, f, "p", T, "extra") for s, h, r, f in queue], Q)
    e = spark.createDataFrame([(*x, "v") for x in entries], E)
    return q, e, spark.createDataFrame(seals, S)


def run(spark, tmp_path, queue, entries, seals):
    out = inc.pending_work(*frames(spark, queue, entries, seals), f"file://{tmp_path}/state", buckets=4)
    return {(r.scope_id, r.content_hexdigest, r.route) for r in out.collect()}


def test_states(spark, tmp_path):
    seals = [(1, T), (2, T), (3, None)]
    queue = [("s", "AA", "r", "f1"), ("s", "aa", "r", "f1"), ("s", "bb", "r", "f2"), ("s", "cc", "r", "f1"), ("s", "dd", "r", "f1"), ("s", "ee", "r", "f1"), (None, "ff", "r", "f1")]
    entries = [
        ("s", "aa", "r", "f1", 2, "success"), ("s", "aa", "r", "f1", 1, "failed"),  # settled by its latest sealed run
        ("s", "bb", "r", "f1", 2, "success"),  # another fingerprint
        ("s", "cc", "r", "f1", 1, "success"), ("s", "cc", "r", "f1", 2, "partial"),  # reopened
        ("s", "dd", "r", "f1", 3, "success"),  # only in an unsealed run
        ("s", "ee", "r", "f1", 2, "no_reader"), ("s", "ee", "r", "f1", 2, "no_reader"),  # settled, repeated row
        (None, "ff", "r", "f1", 2, "success"),
    ]
    assert run(spark, tmp_path, queue, entries, seals) == {("s", "bb", "r"), ("s", "cc", "r"), ("s", "dd", "r"), (None, "ff", "r")}


def test_empty_tables(spark, tmp_path):
    assert run(spark, tmp_path, [], [], []) == set()
    assert run(spark, tmp_path / "b", [("s", "aa", "r", "f")], [], []) == {("s", "aa", "r")}


def test_only_changed_buckets_are_redone(spark, tmp_path):
    rows = spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    sides = lambda df: {"in": df.withColumn(inc.BUCKET, inc.key_bucket([F.col("k")], 16))}
    compute = lambda p: p["in"].select(inc.BUCKET, "k", "v")
    path = f"file://{tmp_path}/st"
    assert inc.incremental_refresh(sides(rows), compute, path)["changed"] == 16
    assert inc.incremental_refresh(sides(rows.repartition(7)), compute, path)["changed"] == 0
    changed = rows.withColumn("v", F.when(F.col("k") == 5, 9).otherwise(F.col("v")))
    assert inc.incremental_refresh(sides(changed), compute, path)["changed"] == 1
    got = {(r.k, r.v) for r in inc.read_result(spark, path).collect()}
    assert got == {(i, 9 if i == 5 else 1) for i in range(200)}
    fewer = changed.where("k <> 7")
    inc.incremental_refresh(sides(fewer), compute, path)
    assert inc.read_result(spark, path).count() == 199


def test_fingerprint_sees_repeats_and_nulls(spark):
    def mark(rows):
        df = spark.createDataFrame(rows, "a string, b string").withColumn(inc.BUCKET, F.lit(0))
        return inc.partition_fingerprints({"x": df}).first()[inc.MARK]

    assert mark([("p", None)]) != mark([(None, "p")])
    assert mark([("p", "q")]) != mark([("p", "q"), ("p", "q")])
    assert mark([("p", "q"), ("r", "s")]) == mark([("r", "s"), ("p", "q")])


def test_buckets_grow_and_a_scope_touches_its_own(spark, tmp_path):
    assert [inc.bucket_count(n) for n in (0, 64 * inc.BUCKET_ROWS, 64 * inc.BUCKET_ROWS + 1, 10**9)] == [64, 64, 256, 4096]
    queue = [(f"s{i % 40}" if i % 3 else "hot", f"h{i}", "r", "f1") for i in range(900)]
    entries = [(s, h, r, f, 1, "success") for s, h, r, f in queue[:500]]
    seals = [(1, T), (2, T)]
    path = f"file://{tmp_path}/st"
    first, told = inc.refresh_pending(*frames(spark, queue, entries, seals), path)
    assert first.count() == 400 and told["buckets"] == 64 and told["changed"] > 40
    more = [(s, h, r, f, 2, "success") for s, h, r, f in queue[500:] if s == "s7"]
    now, told = inc.refresh_pending(*frames(spark, queue, entries + more, seals), path)
    assert now.count() == 400 - len(more) and 0 < told["changed"] <= 8
    again, told = inc.refresh_pending(*frames(spark, queue, entries + more, seals), path)
    assert again.count() == 400 - len(more) and told["changed"] == 0
