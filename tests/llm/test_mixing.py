"""Mixing: shares met, caps kept, missing sources reported; the dual against its own conditions and a plain solver."""

import random

import numpy as np
from pyspark.sql import functions as F

from sparkloom.llm import mixing
from sparkloom.llm.tokens import count_tokens

TARGETS = "mix_name string, source string, target_share double, max_repeats int"


def docs(spark, n=900):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        source = "big" if i % 10 else rng.choice(["Small ", "SMALL", "small"])
        rows.append((i, "word " * rng.randint(5, 60), source, "clash"))
    rows += [(10_000, None, "big", "x"), (10_001, "", "small", "x"), (10_002, "no source", None, "x"), (0, rows[0][1], rows[0][2], "again")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, copies string")


def test_shares_and_caps(spark):
    targets = spark.createDataFrame([("m", "big", 0.5, 2), ("m", "small", 0.3, 4), ("m", "none", 0.2, 4), ("m", "big", 0.5, 2)], TARGETS)
    chosen = mixing.mix_documents(docs(spark), targets).cache()
    report = {r.source: r for r in mixing.mix_shares(chosen, targets).collect()}
    assert report["none"].reached_share == 0 and report["none"].n_docs == 0
    assert abs(report["big"].reached_share - 0.625) < 0.01 and abs(report["small"].reached_share - 0.375) < 0.01
    assert chosen.groupBy("source").agg(F.max("copies").alias("m")).where("m > if(source = 'big', 2, 4)").count() == 0
    assert chosen.count() == chosen.select("doc_id").distinct().count()


def test_empty(spark):
    t = spark.createDataFrame([("m", "big", 1.0, 1)], TARGETS)
    assert mixing.mix_documents(docs(spark).limit(0), t).count() == 0
    assert mixing.mix_documents(docs(spark), t.limit(0)).count() == 0


def test_everything_once_is_the_free_solution(spark):
    t = spark.createDataFrame([("m", "big", 1.0, 3)], TARGETS)
    chosen = mixing.mix_documents(docs(spark), t)
    assert chosen.count() >= 805 and chosen.agg(F.max("copies")).first()[0] == 1


def features(spark, seed=2, n=1500):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["notes", "notes", "notes", "letters", "minutes"])
        long = {"notes": 30, "letters": 80, "minutes": 150}[source]
        rows.append((i, "word " * rng.randint(5, 2 * long), source, rng.choice(["en", "EN ", "hi" if source != "minutes" else "en", None])))
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")


def test_the_dual_is_solved(spark):
    """Every uncapped rate is the exponential of a linear form, the sources' tokens are met, the features come near the pool's, and a plain solver finds no better rates."""
    targets = spark.createDataFrame([("m", "notes", 0.2, 2), ("m", "letters", 0.5, 2), ("m", "minutes", 0.3, 2)], TARGETS)
    sized, duals = mixing.plan_mixes(features(spark), targets)
    d = duals[0]
    assert d.done and d.gap < 1e-12 and d.error < 1e-9 and d.steps < 30 and np.abs(d.off).max() < 0.01
    rows = sized.collect()
    by = {r[1]: r for r in d.multipliers()}
    f = np.array([[r[f"f{k}"] for k in range(4)] for r in rows])
    u = np.array([by[r.source][2] for r in rows]) + f @ np.array(d.multipliers()[0][6:])
    cap = np.array([by[r.source][3] for r in rows], float)
    bound = np.array([by[r.source][4] for r in rows])
    rate, t = np.where(bound, cap, np.minimum(np.exp(u), cap)), np.array([r.n_tokens for r in rows], float)
    for s, r in by.items():
        mine = np.array([x.source == s for x in rows])
        assert abs((rate * t)[mine].sum() - r[5]) < 1e-6 * r[5]
        assert r[4] or np.ptp(rate[mine]) > 0.05  # documents of one source differ
    goal = (t[:, None] * f).sum(0) / t.sum()
    assert np.abs((rate * t) @ f / (rate * t).sum() - goal).max() < 0.01
    # Any other rates that meet the same constraints are further from "everything once".
    kl = lambda w: float((t * (w * np.log(w) - w + 1)).sum())
    a = np.array([[float(x.source == s) for x in rows] for s in by] + list(f.T)) * t
    rng = np.random.default_rng(1)
    for _ in range(20):
        step = rng.normal(size=len(t)) * (rate < cap)
        free = a * (rate < cap)
        step -= free.T @ np.linalg.lstsq(free @ free.T, free @ step, rcond=None)[0]
        other = rate + 0.02 * step / np.abs(step).max()
        assert kl(np.clip(other, 1e-9, cap)) >= kl(rate) - 1e-6


def test_a_source_that_bounds_the_mix(spark):
    targets = spark.createDataFrame([("m", "notes", 0.1, 3), ("m", "minutes", 0.9, 1)], TARGETS)
    chosen = mixing.mix_documents(features(spark), targets).cache()
    report = {r.source: r for r in mixing.mix_shares(chosen, targets).collect()}
    assert report["minutes"].at_the_cap and report["minutes"].most_copies == 1 and abs(report["minutes"].reached_share - 0.9) < 0.01


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (4, "<|endoftext|>"), (5, "x" * 100_000)], "doc_id bigint, text string")
    n = {r.doc_id: r.n_tokens for r in count_tokens(df, ["doc_id"]).collect()}
    assert n[1] > 0 and n[2] == n[3] == 0 and n[4] > 1 and n[5] > 100
