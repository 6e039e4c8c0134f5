"""Reading level of each document.

Method: classic readability formulas: Flesch-Kincaid, Gunning Fog, SMOG,
Coleman-Liau and the Automated Readability Index, from words per sentence,
syllables per word, share of words of three syllables or more, and letters per
word. Without ratings the median of their grade estimates counts. Syllables come from
hyphenation: patterns of letters and digits, made from rules, whose highest
digit at a place says whether a word is divided there.

As the formulas' authors did with their graded passages, weights are fitted,
here on a bounded sample of documents rated by readers and on the logarithms of
the formulas' measures: texts are demanding where sentences are long and words
are, not where one makes up for the other. No formula has all of the measures,
and the median of the five loses what only some of them see; so all measures
are weighed together, by one logistic regression for each cut between bands.
Sentences are cut into T-units, so that main clauses strung together with "and
then" are as easy as they would be one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.common import cut

#: Most rated documents the weights are fitted on (the smallest hashes of their ids).
FIT_SAMPLE = 20_000
#: Fewest rated documents for a fit.
LEAST_RATED = 30
MEASURES = ("words_per_sentence", "syllables_per_word", "hard_share", "letters_per_word")
#: Grades between bands where there are no ratings: what the published formulas give at the ends of primary, middle and secondary school.
GRADES = (6.0, 9.0, 13.0)
# The published formulas, over MEASURES.
FORMULAS = {
    "flesch_kincaid": lambda w, y, h, c: 0.39 * w + 11.8 * y - 15.59,
    "gunning_fog": lambda w, y, h, c: 0.4 * (w + 100 * h),
    "smog": lambda w, y, h, c: 1.043 * (30 * h * w) ** 0.5 + 3.1291,
    "coleman_liau": lambda w, y, h, c: 5.88 * c - 29.6 / w - 15.8,
    "automated_readability": lambda w, y, h, c: 4.71 * c + 0.5 * w - 21.43,
}
#: The logarithms the formulas are fitted on, over MEASURES; ``log`` is the logarithm of the library the values are in.
LOGS = lambda w, y, h, c, log: [log(w), log(y), log(h + 0.02), log(h * w + 0.3), log(c)]
#: What holds the weights of the logarithms, and of their squares and products, near 0: few ratings say little of the latter.
HOLD, HOLD_PRODUCTS = 0.01, 1.0
MIN_WORDS = 80

_WORD = re.compile(r"[a-z]+(?:['’-][a-z]+)*(?![/a-z])")
_REF = re.compile(r"\d(?:[^\s.!?;।]|\.(?=\d))*")
_END = re.compile(r"(?<=[.!?;।])[\"')\]]*\s+|\n\s*\n")
_STRUNG = re.compile(r"\b(?:and|but|so)\s+then\b")
_LEDGER = re.compile(r"\b(?:Dr|Cr)\.?\s*$", re.M)
_SIDE = re.compile(r"\b(?:Dr|Cr)\b(?!\.?\s+[A-Z][a-z])")
_LATIN = re.compile(r"[A-Za-z]")
_OTHER = re.compile(r"[^\W\d_A-Za-z]")
_FIELD = re.compile(r"^\s*[\w.]+\.\d+\.[\w.]+\s*:", re.M)


# Beginnings of syllables, vowels that stand apart, and vowels that do not although a rule would part them.
ONSETS = "bl br ch chr cl cr dr fl fr gh gl gn gr kn ph phr pl pr qu sc sch scr sh shr sk sl sm sn sp spl spr st str sw th thr tr tw wh wr".split()
APART = "i1a i1o i1u e1o u1a u1i u1o y1a y1i y1o e1u o1e a1o".split()
TOGETHER = "ti4on si4on ci4on gi4on ti4al ci4al ti4a ci4a ti4ous ci4ous gi4ous ti4en ci4en si4a qu4a qu4i qu4o gu4i gu4a ai4o e4ou e4o. eo4p eo4r".split()


def hyphenation() -> dict[str, list[int]]:
    """Letters of each pattern (. is a word's end) with the digits between them."""
    consonants, vowels = "bcdfghjklmnpqrstvwxz", "aeiouy"
    rules = [f"1{c}{v}" for c in consonants for v in vowels]
    rules += ["3" + "4".join(o) + v for o in ONSETS for v in vowels]
    rules += APART + TOGETHER
    # A final e is silent, also before s and d, but not after a consonant with l and not where the ending is heard.
    rules += [r for c in consonants for r in (f"4{c}e.", f"4{c}es.") if c != "l"] + [f"4{c}ed." for c in consonants if c not in "td"]
    rules += [f"5{c}6le{end}." for c in "bcdfgkptz" for end in ("", "s", "d")] + [f"{v}4le{end}." for v in vowels for end in ("", "s")]
    rules += [f"7{c}es." for c in "sxzcg"] + ["7ch8es.", "7sh8es."]
    out = {}
    for rule in rules:
        digits = [0]
        for c in rule:
            if c.isdigit():
                digits[-1] = int(c)
            else:
                digits.append(0)
        out[re.sub(r"\d", "", rule)] = digits
    return out


PATTERNS = hyphenation()
_LONGEST = max(map(len, PATTERNS))
_VOWEL = re.compile("[aeiouy]")


def hyphenate(word: str) -> list[str]:
    """A lower-case word divided into its syllables; a part without a vowel is no syllable."""
    s, digits = f".{word}.", [0] * (len(word) + 3)
    for i in range(len(s)):
        for n in range(2, min(_LONGEST, len(s) - i) + 1):
            for k, d in enumerate(PATTERNS.get(s[i : i + n], ())):
                digits[i + k] = max(digits[i + k], d)
    parts = [word[:1]]
    for i, c in enumerate(word[1:], 1):
        if digits[i + 1] % 2 and _VOWEL.search(parts[-1]) and _VOWEL.search(word, i):
            parts.append("")
        parts[-1] += c
    return parts


def syllables(word: str, seen: dict[str, int]) -> int:
    """Syllables of a lower-case word, at least one in each of its parts between hyphens and apostrophes that has a vowel."""
    n = seen.get(word)
    if n is None:
        if len(seen) > 200_000:
            seen.clear()
        n = seen[word] = max(1, sum(len(hyphenate(p)) for p in re.split("['’-]", word) if _VOWEL.search(p)))
    return n


def is_running_english(text: str) -> bool:
    """English running text: mostly Latin letters, sentences, and no listing of ledger lines, cells or field paths."""
    if not text.isascii() and len(_OTHER.findall(text)) > len(_LATIN.findall(text)):
        return False
    words = len(text.split())
    lines = text.count("\n") + 1
    if ("|" in text or "\t" in text) and sum(1 for x in text.split("\n") if x.count("|") >= 3 or x.count("\t") >= 2) * 2 > lines:
        return False
    if "." in text and ":" in text and len(_FIELD.findall(text)) * 2 > lines:
        return False
    if "Dr" in text or "Cr" in text:
        sides = len(_SIDE.findall(text))
        if sides >= 3 and (sides * 40 > words or len(_LEDGER.findall(text)) * 2 > lines):
            return False
    ends = sum(text.count(e) for e in (". ", ".\n", "! ", "? ", "; ", ";\n", ".\r", "।")) + text.rstrip().endswith((".", "!", "?"))
    return ends > 0 and words / ends < 160


def measure(text: str, seen: dict[str, int]) -> tuple[float, ...] | None:
    """MEASURES of a text, in order, or None if it has no words."""
    units = []
    for sentence in _END.split(_REF.sub(" ", text.lower())):
        for unit in _STRUNG.split(sentence) if " then " in sentence else (sentence,):
            words = _WORD.findall(unit)
            if words:
                units.append(words)
    # Headings and leftovers of one or two words are no sentences.
    full = [u for u in units if len(u) >= 3] or units
    if not full:
        return None
    words = [w for u in full for w in u]
    counts = [seen.get(w) or syllables(w, seen) for w in words]
    n = len(words)
    return n / len(full), sum(counts) / n, sum(c >= 3 for c in counts) / n, sum(map(len, words)) / n


MEASURED = "doc_id bigint, n_words int, running boolean, " + ", ".join(f"{k} double" for k in MEASURES)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, n_words (blank-separated), running (English running text) and MEASURES of each text with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for b in batches:
            take, n, running, rows = [], [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                m = measure(t, seen)
                if m is None:
                    continue
                take.append(i)
                n.append(len(t.split()))
                running.append(is_running_english(t))
                rows.append(m)
            cols = list(zip(*rows, strict=True)) if rows else [()] * len(MEASURES)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": b.column(0).take(pa.array(take, pa.int64())), "n_words": pa.array(n, pa.int32()), "running": pa.array(running, pa.bool_())}
                | {k: pa.array(c, pa.float64()) for k, c in zip(MEASURES, cols, strict=True)}
            )

    return docs.where("text is not null and doc_id is not null").select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, MEASURED)


def rated_bands(labels: DataFrame) -> DataFrame:
    """(doc_id, band): the median of the raters' latest bands; nulls and repeated rows do not count, ties go to the lower band."""
    ok = labels.where("doc_id is not null and grade_band between 1 and 4")
    last = ok.groupBy("doc_id", "rater").agg(F.max(F.struct("rated_at", "grade_band")).getField("grade_band").alias("g"))
    return last.groupBy("doc_id").agg(F.expr("percentile_disc(0.5) within group (order by g)").cast("int").alias("band"))


class Fitted(NamedTuple):
    """Means, spreads, least and greatest of LOGS over the rated documents, and the weights of each cut's terms."""

    mean: list[float]
    spread: list[float]
    low: list[float]
    high: list[float]
    cuts: list[list[float]]


def terms(z: list) -> list:
    """Scaled logarithms with their squares and products."""
    return [*z, *(a * b for i, a in enumerate(z) for b in z[i:])]


def fit(measured: DataFrame, labels: DataFrame, sample: int = FIT_SAMPLE) -> Fitted | None:
    """What tells the bands 1|2, 2|3 and 3|4 apart by the ratings; None with fewer than LEAST_RATED of them: the published formulas and GRADES hold.

    At most ``sample`` rated documents come to the driver. A cut with fewer than
    five documents on a side lies where the other ratings have it, half way
    between the bands of a straight line.
    """
    rated = measured.where(f"running and n_words >= {MIN_WORDS // 2}").join(rated_bands(labels), "doc_id")
    rows = rated.orderBy(F.xxhash64("doc_id")).limit(sample).select("band", *MEASURES).collect()
    if len(rows) < LEAST_RATED:
        return None
    band = np.array([r.band for r in rows], dtype=float)
    x = np.column_stack(LOGS(*(np.array([r[k] for r in rows], dtype=float) for k in MEASURES), np.log))
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = (x - mean) / spread
    a = np.column_stack([*terms(list(z.T)), np.ones(len(z))])
    hold = np.array([HOLD] * z.shape[1] + [HOLD_PRODUCTS] * (a.shape[1] - 1 - z.shape[1]) + [1e-6])
    line = np.linalg.solve(a.T @ a + np.diag(np.where(hold == HOLD_PRODUCTS, 1e9, hold)), a.T @ band)
    cuts = []
    for j in (1, 2, 3):
        above = (band > j).astype(float)
        if min(above.sum(), len(band) - above.sum()) < 5:
            cuts.append([*line[:-1].tolist(), float(line[-1] - j - 0.5)])
        else:
            cuts.append(logistic(a, above, hold).tolist())
    return Fitted(mean.tolist(), spread.tolist(), z.min(0).tolist(), z.max(0).tolist(), cuts)


def logistic(a: np.ndarray, y: np.ndarray, hold: np.ndarray) -> np.ndarray:
    """Weights of logistic regression of y (0 or 1) on the columns of a, each held near 0."""
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -50, 50)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + np.diag(hold), a.T @ (p - y) + hold * w)
        w = w - step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
    return w


def published(name: str) -> Column:
    """A published formula's level on the scale of the bands: 1.5, 2.5 and 3.5 at GRADES, straight lines between and beyond them."""
    x, (a, b, c) = FORMULAS[name](*(F.col(k) for k in MEASURES)), GRADES
    return F.when(x < b, F.lit(1.5) + (x - a) / (b - a)).otherwise(F.lit(2.5) + (x - b) / (c - b))


def reading_bands(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_words, running, level (on the scale of the bands), band of each document with words.

    Null and blank texts and texts without Latin words give no row. Repeated
    rows of a doc_id come out once. Documents that are not English running text get a band too, but
    ``running`` false says that the formulas were not made for them.
    """
    # Measured once: the fit and the bands read the same small table.
    measured = cut(measures(docs), "reading").dropDuplicates(["doc_id"])
    return banded(measured, fit(measured, labels))


BANDED = "doc_id bigint, n_words int, running boolean, level double, band int"


def banded(measured: DataFrame, fitted: Fitted | None) -> DataFrame:
    """The level and its band for measured documents: where the log odds of the cuts put it, or the median of the published formulas."""
    if fitted is None:
        levels = [published(name) for name in FORMULAS]
        level = F.greatest(F.lit(0.5), F.least(F.lit(4.49), F.sort_array(F.array(*levels))[len(levels) // 2]))
        return measured.select("doc_id", "n_words", "running", F.round(level, 6).alias("level"), F.greatest(F.lit(1), F.floor(level + 0.5)).cast("int").alias("band"))

    # As expressions of Spark the cuts' terms would be copied into every filter on the band.
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            level = levels_of([b.column(k).to_numpy(zero_copy_only=False) for k in range(3, 3 + len(MEASURES))], fitted)
            rest = {"level": pa.array(np.round(level, 6), pa.float64()), "band": pa.array(np.maximum(1, np.floor(level + 0.5)).astype(np.int32), pa.int32())}
            yield pa.RecordBatch.from_pydict({k: b.column(k) for k in ("doc_id", "n_words", "running")} | rest)

    return measured.select("doc_id", "n_words", "running", *MEASURES).mapInArrow(run, BANDED)


def levels_of(measures: list[np.ndarray], fitted: Fitted) -> np.ndarray:
    """Levels on the scale of the bands: 1.5, 2.5 and 3.5 where a cut's odds are even."""
    # Beyond the rated documents' measures nothing is known of squares and products: their ends hold.
    z = np.clip((np.column_stack(LOGS(*measures, np.log)) - fitted.mean) / fitted.spread, fitted.low, fitted.high)
    a = np.column_stack([*terms(list(z.T)), np.ones(len(z))])
    # A document beyond a cut is beyond all lower ones.
    one, two, three = np.minimum.accumulate(np.clip(a @ np.array(fitted.cuts).T, -30, 30), axis=1).T
    below, above = 0.5 + 2 / (1 + np.exp(-one)), 2.5 + 2 / (1 + np.exp(-three))
    between = [low + x / np.maximum(x - y, 1e-12) for low, x, y in ((1.5, one, two), (2.5, two, three))]
    return np.minimum(4.49, np.select([one < 0, two < 0, three < 0], [below, *between], above))
