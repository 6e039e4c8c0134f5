"""Reading bands: syllables, T-units, kinds of text, fit on ratings and held-out accuracy."""

import math
import os
import random
from datetime import datetime

import pytest

from sparkloom.common import cut
from sparkloom.llm import reading

EASY = ["The cook cut the list.", "Her son saw a red pen at the shop.", "We ate and then he ran home and then she sat down.", "It was fine."]
HARD = [
    "Irrespective of the contemporaneous documentation hereinabove enumerated, the appellate authority unequivocally repudiates the disaggregated reassessment of unabsorbed depreciation, whose evidentiary significance remains uncorroborated.",
    "Whether or not the gift fell due from the one who gave it, then or at all, the deed which was set apart for the wife but not the sons can at most be said to bar the claim of those with a prior charge in law if not in fact.",
]
MID = ["The cashier returned the monthly statement because the printer needed paper.", "The landlord accepted the rent receipt for November after the customer complained twice."]


def text(rng, level, n=12):
    return " ".join(rng.choice({1: EASY, 2: MID, 4: HARD}[level]) for _ in range(n))


def test_syllables():
    seen = {}
    assert [reading.syllables(w, seen) for w in ("the", "paper", "returned", "cake", "boxes", "documentation")] == [1, 2, 2, 1, 2, 5]


def test_hyphenation():
    cases = "in-for-ma-tion ta-ble no-ticed wan-ted cre-ate quick-ly strengths fi-nan-cial make lit-tle box-es"
    assert ["".join(reading.hyphenate(w)) for w in cases.replace("-", "").split()] == cases.replace("-", "").split()
    assert [len(reading.hyphenate(w)) for w in cases.replace("-", "").split()] == [4, 2, 2, 2, 1, 2, 1, 3, 1, 2, 2]


def test_published_formulas():
    w, y, h, c = 20.0, 1.6, 0.15, 4.8
    got = {k: f(w, y, h, c) for k, f in reading.FORMULAS.items()}
    assert {k: round(v, 2) for k, v in got.items()} == {"flesch_kincaid": 11.09, "gunning_fog": 14.0, "smog": 13.02, "coleman_liau": 10.94, "automated_readability": 11.18}


def test_strung_clauses_are_easy():
    seen = {}
    a = reading.measure("The man ran home and then the boy sat down and then the girl ate. It was fine.", seen)
    b = reading.measure("The man ran home. The boy sat down. The girl ate. It was fine.", seen)
    assert abs(a[0] - b[0]) < 1.5
    assert reading.measure("", seen) is None and reading.measure("123 456", seen) is None


def test_running_english():
    assert reading.is_running_english("The clerk paid. He went home.")
    assert not reading.is_running_english("कर अधिकारी ने चेक दिखाया। मिल ने बिल दिया।")
    ledger = "Date | Type | Ref | Amount | Side\n" + "6 May 2018 | Contra | NV/21 | 5,298 | Cr\n" * 9
    assert not reading.is_running_english(ledger) and not reading.is_running_english(ledger.replace(" | ", "  "))


def test_fit_and_held_out(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, (1, 2, 4)[i % 3]), "clash") for i in range(300)]
    rows += [(900, None, ""), (901, "  ", ""), (902, "one", ""), (0, rows[0][1], "again")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, band string")
    t = datetime(2024, 1, 1)
    labels = [(i, r, (1, 2, 4)[i % 3], t) for i in range(150) for r in ("a", "b")] + [(5, "c", None, t), (6, "c", 9, t), (None, "c", 1, t), (4, "a", 2, t)]
    lab = spark.createDataFrame(labels + labels[:5], "doc_id bigint, rater string, grade_band int, rated_at timestamp_ntz")
    got = {r.doc_id: r for r in reading.reading_bands(docs, lab).collect()}
    held = [got[i] for i in range(150, 300)]
    right = sum((r.band == 4) == (r.doc_id % 3 == 2) and (r.band == 1) == (r.doc_id % 3 == 0) for r in held)
    assert right / len(held) > 0.95 and 900 not in got and 901 not in got and 902 in got
    assert reading.reading_bands(docs.limit(0), lab).count() == 0
    assert reading.reading_bands(docs, lab.limit(0)).count() == len(got)


def test_measures_that_no_formula_has_together(spark):
    """Bands that follow from sentences, hard words and letters together: no formula has all three, nor has the median of five."""
    rng = random.Random(3)
    rows, truth = [], {}
    for i in range(1200):
        a, b, c = rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1)
        truth[i] = min(4, max(1, 1 + sum(a + b + c > x for x in (-1, 0, 1))))
        h = 0.2 * math.exp(0.4 * b)
        rows.append((i, 200, True, 18 * math.exp(0.4 * a), 1 + 2.5 * h, h, 5 * math.exp(0.2 * c)))
    measured = spark.createDataFrame(rows, reading.MEASURED)
    labels = spark.createDataFrame([(i, "a", truth[i], datetime(2024, 1, 1)) for i in range(600)], "doc_id bigint, rater string, grade_band int, rated_at timestamp_ntz")
    held = [(r.band, truth[r.doc_id]) for r in reading.banded(measured, reading.fit(measured, labels)).where("doc_id >= 600").collect()]
    found, true, both = sum(p == 4 for p, _ in held), sum(t == 4 for _, t in held), sum(p == t == 4 for p, t in held)
    assert both / true > 0.95 and both / found > 0.95 and sum(p == t for p, t in held) / len(held) > 0.93


def test_held_out_ratings(spark):
    """Fitted on three quarters of the rated documents, in turn: precision and recall of band 4 on the other quarter."""
    folder = "/root/testdata/sf0.1"
    if not os.path.exists(folder):
        pytest.skip("no ratings here")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "reading_labels"))
    rated = reading.rated_bands(labels)
    measured = cut(reading.measures(docs.join(rated.select("doc_id"), "doc_id", "left_semi"))).dropDuplicates(["doc_id"])
    pairs = []
    for k in range(4):
        got = reading.banded(measured, reading.fit(measured, labels.where(f"pmod(xxhash64(doc_id), 4) <> {k}")))
        held = got.where(f"running and n_words >= 80 and pmod(xxhash64(doc_id), 4) = {k}").join(rated.withColumnRenamed("band", "truth"), "doc_id")
        pairs += [(r.band == 4, r.truth == 4) for r in held.collect()]
    both = sum(a and b for a, b in pairs)
    assert both / sum(b for _, b in pairs) >= 0.9 and both / sum(a for a, _ in pairs) >= 0.9 and len(pairs) > 500
