"""Deduplication against history, compared with brute force over all pairs of a scope."""

import random

import numpy as np
from pyspark.sql import functions as F

from sparkloom.llm import dedup

SCHEMA = "doc_id bigint, text string, scope_id string, batch_no int, a bigint"


def corpus(seed=5):
    rng = random.Random(seed)
    vocab = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("lor", "mit", "nas", "pek", "rud")]
    make = lambda n: [rng.choice(vocab) for _ in range(n)]
    base = {i: make(rng.randint(60, 140)) for i in range(1, 31)}
    rows = [(i, " ".join(w), f"s{i % 3}", 0, 0) for i, w in base.items()]
    for i in range(31, 91):
        src = rng.choice(list(base))
        w = list(base[src])
        kind = i % 6
        if kind == 0:
            w = make(90)
        elif kind == 1:
            w[7] = "other"
        elif kind == 2:
            w = [x.upper() + "," for x in w]
        elif kind == 3:
            w = w[: len(w) // 2] + make(len(w) // 2)
        elif kind == 4:
            w = w[len(w) // 2 :] + w[: len(w) // 2]
        rows.append((i, "\n".join(w) if kind == 5 else "  ".join(w), f"s{src % 3}" if i % 7 else "s9", 1 + i % 3, 0))
    rows += [(200 + i, rows[3][1], "s1", i % 3, 0) for i in range(40)]  # a hot group of copies
    rows += [(300, None, "s1", 1, 0), (301, "", "s1", 1, 0), (302, "one", "s1", 2, 0), (303, rows[0][1], None, 1, 0), (304, rows[0][1], "s1", None, 0), (305, " ".join(rows[3][1].split()[:40]), "s1", 2, 0)]
    return rows + rows[:4]


def brute(rows):
    signer, out = dedup.Signer(), {}
    seqs = {r[0]: signer.sequence(r[1]) for r in rows if r[1] and r[2] and r[3] is not None}
    for b in rows:
        if b[0] not in seqs or not dedup.has_words(b[1]):
            continue
        for a in rows:
            if a[0] in seqs and a[2] == b[2] and a[3] < b[3] and len(seqs[a[0]]) >= dedup.MIN_INDEXED:
                x, y = seqs[a[0]], seqs[b[0]]
                most = max(len(x), len(y))
                if dedup.common_in_order(x, y) >= dedup.SAME * most:
                    out[b[0]] = min(out.get(b[0], 10**9), a[0])
    return {(a, b) for b, a in out.items()}


def test_against_brute_force(spark):
    rows = corpus()
    got = dedup.dedup_batches(spark.createDataFrame(rows, SCHEMA).repartition(3))
    pairs = [(r.doc_id_a, r.doc_id_b) for r in got.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == brute(rows) and len(pairs) > 40


def test_empty_and_single_batch(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    assert dedup.dedup_batches(df.limit(0)).count() == 0
    assert dedup.dedup_batches(df.where("batch_no = 0")).count() == 0


def test_batches_fed_one_by_one_and_the_index_opened_again(spark, tmp_path):
    df = spark.createDataFrame(corpus(), SCHEMA)
    path, got = f"file://{tmp_path}/ix", {}
    for n in range(4):
        index = dedup.HistoryIndex(spark, path, 4)
        index.submit(df.where(f"batch_no = {n}"))
        index.add(n)
        got[n] = {(r.a, r.b) for r in index.probe(n).collect()}
    whole = {(r.doc_id_a, r.doc_id_b, r.batch_no) for r in dedup.dedup_batches(df).collect()}
    assert not got[0] and all({(a, b) for a, b, k in whole if k == n} >= {(a, b) for a, b in got[n]} for n in got)
    assert {a for v in got.values() for a, _ in v} == {a for a, _, _ in whole}


def test_probing_reads_earlier_partitions_and_does_not_shuffle_them(spark, tmp_path):
    df = spark.createDataFrame(corpus(), SCHEMA)
    index = dedup.HistoryIndex(spark, f"file://{tmp_path}/ix", 4)
    index.submit(df)
    index.add(0)
    leaders = index.keys().where((F.col("batch_no") < 1) & (F.col("standing") == dedup.LEADER)).select("key", F.col("doc_id").alias("a"))
    fresh = dedup.band(index.entries().where("batch_no = 1")).repartition(4, "key")
    firsts = fresh.groupBy("key").agg(F.min("doc_id").alias("first"))
    plan = firsts.hint("shuffle_hash").join(leaders, "key", "left")._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and plan.count("Exchange") == 1 and "(batch_no" in plan.split("PartitionFilters:")[1]


def test_a_batch_whose_run_broke_off_can_be_run_again(spark, tmp_path):
    df = spark.createDataFrame(corpus(), SCHEMA)
    index = dedup.HistoryIndex(spark, f"file://{tmp_path}/ix", 4)
    for n in (0, 1):
        index.submit(df.where(f"batch_no = {n}"))
        index.add(n)
    once = {(r.a, r.b) for r in index.probe(1).collect()}
    index.submit(df.where("batch_no = 1"))
    index.add(1)
    assert once and {(r.a, r.b) for r in index.probe(1).collect()} == once


def test_followers_of_a_bucket_are_tried(spark):
    """Leaders that share passages but not the whole, followers and earlier ids among what is repeated."""
    rng = random.Random(4)
    vocab = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("lor", "mit", "nas", "pek", "rud")]
    make = lambda n: [rng.choice(vocab) for _ in range(n)]
    common, rows = make(70), []
    for i in range(60):  # one boilerplate, half of each text
        rows.append((1000 - i if i % 2 else i, " ".join(common + make(60)), "s", i % 3, 0))
    for i in range(40):
        w = rows[rng.randrange(len(rows))]
        x = w[1].split()
        for _ in range(rng.randrange(14)):
            x[rng.randrange(len(x))] = rng.choice(vocab)
        rows.append((2000 + i, " ".join(x), "s", 3, 0))
    got = {(r.doc_id_a, r.doc_id_b) for r in dedup.dedup_batches(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows) and len(got) >= 40


def test_what_repeats_a_repeated_record_is_found(spark):
    rng = random.Random(8)
    a = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(100)]
    b = [f"n{w}" if i % 5 == 0 else w for i, w in enumerate(a)]
    c = [f"m{w}" if i % 5 == 1 else w for i, w in enumerate(b)]
    rows = [(1, " ".join(a), "s", 0, 0), (2, " ".join(b), "s", 1, 0), (3, " ".join(c), "s", 2, 0)]
    rng.shuffle(rows)
    assert {(r.doc_id_a, r.doc_id_b) for r in dedup.dedup_batches(spark.createDataFrame(rows, SCHEMA)).collect()} == {(1, 2), (2, 3)}


def test_long_records():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 60_000, 30_000).astype(np.uint16)
    b = np.delete(a, range(0, 300))
    assert dedup.same_text(a.tobytes(), b.tobytes()) and not dedup.same_text(a.tobytes(), a[::-1].tobytes())


def test_long_near_copies_are_compared_by_words():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 60_000, 25_000).astype(np.uint16)
    for share in (0.06, 0.08):
        b = a.copy()
        at = rng.random(len(b)) < share
        b[at] = rng.integers(60_000, 65_000, int(at.sum()))
        assert dedup.common_in_order(a, b) == len(a) - at.sum() and dedup.same_text(a.tobytes(), b.tobytes())


def test_order_in_blocks_is_the_plain_longest_common_subsequence(monkeypatch):
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    rng = np.random.default_rng(3)
    monkeypatch.setattr(dedup, "BLOCK", 7)
    for _ in range(60):
        a, b = (rng.integers(0, 6, rng.integers(0, 40)).astype(np.uint16) for _ in range(2))
        assert dedup.common_in_order(a, b) == plain(a, b)


def test_listings_of_numbers_are_compared(spark):
    rng = random.Random(6)
    line = lambda: [f"{rng.randint(1, 28):02d}", rng.choice(["cash", "bank", "rent"]), str(rng.randint(1000, 99999)), f"INV{rng.randint(1000, 9999)}"]
    make = lambda n: [w for _ in range(n) for w in line()]
    a, other = make(16), make(16)
    near = list(a)
    near[10] = "4711"
    # Words enough on one side of the bound and one too few on the other.
    edge = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(30)] + [str(1000 + i) for i in range(40)]
    rows = [(1, " ".join(a), "s", 0), (2, " ".join(a), "s", 1), (3, " ".join(near), "s", 1), (4, " ".join(other), "s", 1), (5, " ".join(edge), "s", 0), (6, " ".join(edge[1:]), "s", 1), (7, "1 2 3", "s", 1)]
    signer = dedup.Signer()
    assert len(signer.sequence(rows[0][1])) < dedup.MIN_INDEXED and [len(signer.sequence(r[1])) for r in rows[4:6]] == [30, 29]
    got = dedup.dedup_batches(spark.createDataFrame(rows, "doc_id bigint, text string, scope_id string, batch_no int"))
    assert {(r.doc_id_a, r.doc_id_b) for r in got.collect()} == {(1, 2), (1, 3), (5, 6)}


def test_recall_of_the_bands_for_scattered_edits():
    """Of the pairs that are the same text by their words in order, at least nine in ten meet in a band, at every share of edits."""
    rng, signer = np.random.default_rng(9), dedup.Signer()
    for kind in ("replaced", "mixed"):
        for share in (0.05, 0.1, 0.15, 0.2, 0.25):
            same = met = 0
            for _ in range(200):
                a = rng.integers(0, 3000, int(rng.integers(60, 300))).astype(np.uint16)
                b = []
                for w in a:
                    if rng.random() >= share:
                        b.append(w)
                        continue
                    how = 0 if kind == "replaced" else rng.integers(3)
                    b += [rng.integers(0, 3000)] if how == 0 else [w, rng.integers(0, 3000)] if how == 1 else []
                b = np.array(b, np.uint16)
                if dedup.same_text(a.tobytes(), b.tobytes()):
                    same += 1
                    met += bool(set(signer.keys(a, 1).tolist()) & set(signer.keys(b, 1).tolist()))
            assert same > 20 and met / same >= 0.9, (kind, share, met, same)


def test_recall_of_the_bands_for_passages_put_in_or_moved():
    rng, signer, met = np.random.default_rng(9), dedup.Signer(), 0
    for i in range(300):
        a = rng.integers(0, 3000, 300).astype(np.uint16)
        new = rng.integers(0, 3000, 75).astype(np.uint16)
        b = np.concatenate([new, a]) if i % 3 == 0 else np.concatenate([a[:150], new, a[150:]]) if i % 3 == 1 else np.concatenate([a[75:], a[:75]])
        assert dedup.same_text(a.tobytes(), b.tobytes())
        met += bool(set(signer.keys(a, 1).tolist()) & set(signer.keys(b, 1).tolist()))
    assert met / 300 >= 0.95


def test_plan_does_not_grow_with_batches(spark):
    """All batches' answers are read in one scan, so the driver holds no plan for each of them."""
    words = [f"word{i}x" for i in range(60)]
    scans = []
    for n in (3, 5):
        rows = [(k, " ".join(words), "s", k) for k in range(n)]
        got = dedup.dedup_batches(spark.createDataFrame(rows, "doc_id bigint, text string, scope_id string, batch_no int"))
        assert {tuple(r) for r in got.collect()} == {(0, k, k) for k in range(1, n)}
        scans.append(got._jdf.queryExecution().optimizedPlan().toString().count("Relation"))
    assert scans[0] == scans[1]
