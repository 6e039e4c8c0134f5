"""Packing: every item once, nothing over capacity, little left unused, order does not matter."""

import random

import pytest

from sparkloom.llm import packing


def test_plan_places_every_item():
    rng = random.Random(2)
    hist = {}
    for _ in range(3000):
        s = min(4096, int(rng.lognormvariate(5, 1)) + 1)
        hist[s] = hist.get(s, 0) + 1
    steps = packing.plan(hist, [512, 1024, 4096])
    placed = {}
    held_all = room_all = 0
    for cap, times, held in steps:
        total = sum(s * n for s, n in held.items())
        assert total <= cap and cap in (512, 1024, 4096)
        held_all, room_all = held_all + total * times, room_all + cap * times
        for s, n in held.items():
            placed[s] = placed.get(s, 0) + n * times
    assert placed == hist and 1 - held_all / room_all < 0.005
    assert packing.plan({}, [8]) == [] and packing.plan({8: 10**9}, [8, 4]) == [(8, 10**9, {8: 1})]


def test_pack(spark):
    sizes = [0, 0, None, 5, 5, 5, 8, 9, 16, 17, 40, 3, 3, 2]
    df = spark.createDataFrame([(i, s, "clash") for i, s in enumerate(sizes)], "doc_id bigint, n_tokens bigint, capacity string")
    rows = packing.pack(df.select("doc_id", "n_tokens"), [8, 16], ["doc_id"], buckets=3).collect()
    per = {}
    for r in rows:
        per.setdefault(r.container_no, []).append(r)
    assert all(sum(r.n_tokens for r in c) <= c[0].capacity and len({r.capacity for r in c}) == 1 for c in per.values())
    back = {}
    for r in rows:
        back.setdefault(r.doc_id, []).append((r.piece_no, r.n_tokens))
    assert {k: sum(n for _, n in v) for k, v in back.items()} == {i: s or 0 for i, s in enumerate(sizes)}
    assert [len(back[i]) for i in (8, 9, 10)] == [1, 2, 3] and sorted(back[10]) == [(0, 16), (1, 16), (2, 8)]
    assert packing.pack(df.limit(0).select("doc_id", "n_tokens"), [8], ["doc_id"]).count() == 0
    with pytest.raises(ValueError, match="capacities"):
        packing.pack(df.select("doc_id", "n_tokens"), [], ["doc_id"])


def test_a_hot_size_is_ranked_without_gaps(spark):
    df = spark.range(1000).selectExpr("id as doc_id", "cast(if(id % 3 = 0, 7, 5) as bigint) as n_tokens")
    rows = packing.ranked_by_size(df, "n_tokens", ["doc_id"], 8).collect()
    for s, n in ((7, 334), (5, 666)):
        assert sorted(r["_rank"] for r in rows if r.n_tokens == s) == list(range(n))


def test_capacities_beyond_the_histogram(spark, monkeypatch):
    monkeypatch.setattr(packing, "MAX_SIZES", 10)
    items = spark.createDataFrame([(i, n) for i, n in enumerate([95, 96, 5, 40, 41, 17, 0, 250, 9, 9])], "doc_id bigint, n_tokens bigint")
    rows = packing.pack(items, [96, 48], ["doc_id"]).collect()
    held = {}
    for r in rows:
        held.setdefault((r.container_no, r.capacity), []).append(r.n_tokens)
    assert all(sum(v) <= c for (_, c), v in held.items()) and len(rows) == 12
    assert {r.doc_id: r.n_tokens for r in rows if r.doc_id < 7} == dict(enumerate([95, 96, 5, 40, 41, 17, 0]))
