"""Noise in text from scanned pages, found and repaired.

Method: sequence labelling. The lines of a page are labelled by a hidden
Markov model with the states top furniture, body, break and bottom furniture.
Its observations are layout features: distance from the page's edges, form of
the line (page number, bare number, marker, blank, heading, sentence), and
whether the line comes again, misreadings and page number apart, on other pages
of the same document. The model is learned from the pages themselves, without
labels: expectation-maximisation (Baum-Welch) over all pages, from a first
guess that also serves as prior. Furniture is taken out, body lines are joined
to paragraphs over their hyphens and over page breaks, breaks end paragraphs.
Words are corrected against a lexicon counted over all text that was not
scanned, by undoing known misreadings.
"""

from __future__ import annotations

import re
from collections import ChainMap, Counter
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.common import cut

#: What is read, and what may have stood there.
MISREAD = (
    ("0", "o"), ("1", "l"), ("1", "i"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"), ("5", "s"), ("$", "s"), ("9", "g"), ("@", "a"), ("6", "b"),
    ("8", "b"), ("3", "e"), ("c", "e"), ("f", "t"), ("cl", "d"), ("ii", "u"), ("b", "h"), ("rn", "m"), ("m", "rn"), ("vv", "w"), ("ﬁ", "fi"),
    ("ﬂ", "fl"), ("l", "i"), ("i", "l"), ("li", "h"), ("€", "e"), ("7", "t"), ("ri", "n"), ("n", "ri"), ("e", "c"), ("t", "f"), ("h", "b"), ("d", "cl"), ("u", "ii"), ("w", "vv"), ("q", "g"), ("g", "q"),
)
HYPHENS = "-¬­‐‑"
PUNCT = ".,;:()'\"[]<>{}?!“”‘’।*"
#: A word that stands so often in text that was not scanned is a word.
MIN_COUNT = 3
#: Most frequent words that every task holds; rarer ones are looked up in the distributed lexicon.
SHARED = 400_000
#: Bits of the fixed filter of the rarer words.
FILTER_BITS = 1 << 26
#: Words held by one task before partial counts are handed on.
FLUSH = 200_000

_TOKEN = re.compile(r"[a-z]+(?:[-'’][a-z]+)*")
_BREAK_END = re.compile(rf"(?<!\s)[{HYPHENS}][ \t]*$")


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all texts: lower-case words of letters, inner hyphens and apostrophes kept."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter[str] = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    c.update([w for x in t.lower().split() if _TOKEN.fullmatch(w := x.strip(PUNCT))])
            if len(c) > FLUSH:
                yield pa.RecordBatch.from_pydict({"word": pa.array(list(c), pa.string()), "n": pa.array(list(c.values()), pa.int64())})
                c.clear()
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(c), pa.string()), "n": pa.array(list(c.values()), pa.int64())})

    return texts.select(text).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Lexicon:
    """Words with their counts: the most frequent as a dictionary, all others as a table with a filter of fixed size."""

    def __init__(self, frequent: dict[str, int], rare: DataFrame | None = None, bits: bytes | None = None):
        self.frequent, self.rare, self.bits = frequent, rare, bits


def _slot(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) % FILTER_BITS for w in words], np.int64)


def lexicon(clean: DataFrame, text: str = "text") -> Lexicon:
    """Words counted at least MIN_COUNT times over all texts. At most SHARED of them come to the driver, whatever the corpus."""
    counts = cut(word_counts(clean, text).where(F.col("n") >= MIN_COUNT), "lexicon")
    frequent = {r.word: r.n for r in counts.orderBy(F.desc("n"), "word").limit(SHARED).toLocalIterator()}
    if counts.count() <= SHARED:
        return Lexicon(frequent)
    last = min(((n, w) for w, n in frequent.items()), key=lambda x: (x[0], [-ord(c) for c in x[1]]))
    rare = counts.where((F.col("n") < last[0]) | (F.col("n") == last[0]) & (F.col("word") > last[1]))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for b in batches:
            h = _slot(b.column(0).to_pylist())
            np.bitwise_or.at(bits, h >> 3, (1 << (h & 7)).astype(np.uint8))
        step = 1 << 16
        blocks = [i for i in range(0, len(bits), step) if bits[i : i + step].any()]
        yield pa.RecordBatch.from_pydict({"at": pa.array(blocks, pa.int32()), "bits": pa.array([bits[i : i + step].tobytes() for i in blocks], pa.binary())})

    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rare.select("word").mapInArrow(mark, "at int, bits binary").toLocalIterator():  # blocks of a filter of fixed size, one after another
        bits[r["at"] : r["at"] + len(r["bits"])] |= np.frombuffer(bytes(r["bits"]), np.uint8)
    return Lexicon(frequent, rare, bits.tobytes())


class Looked(dict):
    """A dictionary that notes what is looked for in vain but may be a rare word."""

    def __init__(self, words: dict[str, int], bits: bytes):
        super().__init__(words)
        self.bits, self.missed = bits, set()

    def __contains__(self, word) -> bool:
        if dict.__contains__(self, word):
            return True
        h = xxhash.xxh64_intdigest(word) % FILTER_BITS
        if self.bits[h >> 3] >> (h & 7) & 1:
            self.missed.add(word)
        return False


class Corrector:
    """Undoes misreadings: a word that is not in the lexicon becomes the likeliest one that is."""

    def __init__(self, words: dict[str, int]):
        self.words = words
        self.known: dict[str, str | None] = {}
        self.by_first: dict[str, list[tuple[str, str]]] = {}
        for read, meant in MISREAD:
            self.by_first.setdefault(read[0], []).append((read, meant))

    def _undo(self, word: str) -> Iterator[str]:
        for i, c in enumerate(word):
            for read, meant in self.by_first.get(c, ()):
                if word.startswith(read, i):
                    yield word[:i] + meant + word[i + len(read) :]

    def ask(self, w: str) -> None:
        """Look for a form and all its undone misreadings, whatever is found."""
        if w in self.words or len(w) > 40:
            return
        once = set(self._undo(w))
        for x in once:
            _ = x in self.words
        if len(w) >= 5:
            for x in once:
                for y in self._undo(x):
                    _ = y in self.words

    def word(self, w: str) -> str | None:
        """The corrected form of a lower-case word, or None if it is right or cannot be told."""
        if w in self.words or len(w) < 3 or len(w) > 40:
            return None
        if w not in self.known:
            if len(self.known) > FLUSH:
                self.known.clear()
            once = list(self._undo(w))
            best = max((x for x in once if x in self.words), key=lambda x: (self.words[x], x), default=None)
            if best is None and len(w) >= 5:
                seen = {y for x in dict.fromkeys(once) for y in self._undo(x)}
                best = max((x for x in seen if x in self.words), key=lambda x: (self.words[x], x), default=None)
            self.known[w] = best
        return self.known[w]


_AMOUNT = re.compile(r"^(?:\d{1,3}(?:,\d{2,3})+(?:\.\d\d)?|\d+\.\d\d)$")
_AMOUNT_READ = str.maketrans({"O": "0", "o": "0", "l": "1", "I": "1", "|": "1", "S": "5", "B": "8", "Z": "2", "g": "9", "G": "6"})
_AMOUNT_LIKE = re.compile(r"^(?=.*\d)(?=.*[OolI|SBZgG])[\dOolI|SBZgG,.]+$")


def fix_token(token: str, corrector: Corrector) -> str | None:
    """The correction of a token as it stands in the text (its inner part, lower case), or None."""
    core = token.strip(PUNCT.replace("!", ""))
    if not core:
        return None
    if core[0].isdigit() or core[0] in "OolI|SB":
        amount = core[:-2] if core.endswith("/-") else core
        if _AMOUNT_LIKE.match(amount):
            fixed = amount.translate(_AMOUNT_READ)
            return fixed if _AMOUNT.match(fixed) else None
    low = core.lower()
    if low in corrector.words or "/" in low or "@" in low[1:-1] and "." in low.partition("@")[2]:
        return None
    bare = low.rstrip("!")
    if bare in corrector.words or not any(c.isalpha() for c in low) or _digits(low) > 2:
        return None
    return corrector.word(low) or (corrector.word(bare) if bare != low else None)


def _digits(w: str) -> int:
    return sum(c.isdigit() for c in w)


def join_broken(left: str, right: str, corrector: Corrector) -> tuple[str, str | None] | None:
    """(the whole word as it should read, its misread form if it had one), or None if it is no broken word."""
    a, b = left.rstrip().rstrip(HYPHENS).lstrip(PUNCT.replace("!", "")).lower(), right.strip(PUNCT.replace("!", "")).lower()
    if not a or not b or not any(c.isalpha() for c in a) or not any(c.isalpha() for c in b):
        return None
    if any(c in "/@|" for c in (a + b).replace("@", "", 1)) or "." in a + b or _digits(a + b) > 2 or "@" in a + b and "_" in a + b:
        return None
    whole, compound = a + b, f"{a}-{b}"
    for form in (whole, compound):
        if form in corrector.words:
            return form, None
    for form in (whole, compound):
        if (fixed := corrector.word(form)) is not None:
            return fixed, form
    bare = b.rstrip("!'’")
    if bare != b:
        return join_broken(left, bare, corrector)
    if a in corrector.words and b in corrector.words and len(a) > 3 and len(b) > 3 and left.rstrip()[-1:] == "-":
        return compound, None
    return whole, None


# --- lines --------------------------------------------------------------------------------------

TOP, BODY, BREAK, BOTTOM = range(4)
LABELS = ("header", "body", "break", "footer")
_PAGE_NO = re.compile(r"^(?:(?:page|pg|p)\b\.?\s*(?:no\b\.?)?\s*\d{1,5}(?:\s*(?:of|/)\s*\d{1,5})?|[-–—]\s*\d{1,5}\s*[-–—]|\[\s*\d{1,5}\s*\]|\d{1,5}\s*(?:/|of)\s*\d{1,5}|पृष्ठ\s*\d+)$", re.I)
_ROMAN = re.compile(r"^(?=[ivxl])(?:x{0,3}|xl|lx{0,3})(?:ix|iv|v?i{0,3})$")
_BARE = re.compile(r"^\d{1,3}$")
#: Characters that are read for each other fall together; what can be read as two characters becomes the two.
_FOLD = str.maketrans(
    {"0": "o", "1": "l", "!": "l", "i": "l", "|": "l", "5": "s", "$": "s", "9": "g", "q": "g", "@": "a", "6": "b", "h": "b", "8": "b", "c": "e", "f": "t",
     "d": "el", "m": "rn", "w": "vv", "u": "ll", "ﬁ": "tl", "ﬂ": "tl"}
)
#: A transcriber's marker is no line of the page: edges are counted without it.
_MARKER = re.compile(r"^\[[A-Z][A-Z ]+\]$")
#: Full lines on either side of a page that are compared with other pages'.
EDGE = 3


def line_key(line: str) -> str:
    """A line with page number and misreading taken away: lines with one key read the same."""
    s = re.sub(r"(?:\s*[|/–—-]\s*(?:page\s*)?\d{1,5}|\s{2,}\d{1,5})$", "", line.strip()).lower()
    return re.sub(r"\s+", " ", s).translate(_FOLD)


def edge_lines(text: str) -> list[tuple[int, str]]:
    """(line number, key) of the lines near the page's edges that could be furniture."""
    lines = text.split("\n")
    full = [i for i, x in enumerate(lines) if x.strip() and not _MARKER.match(x.strip())]
    out = []
    for i in dict.fromkeys([*full[:EDGE], *full[-EDGE:]]):
        s = lines[i].strip()
        if any(c.isalpha() for c in s) and not s.startswith("[") and not _PAGE_NO.match(s):
            out.append((i, line_key(s)))
    return out


#: Forms of a line: blank, page number, Roman number, bare number, long bare number, short line that breaks the text, heading or sentence.
#: Lines that could be a heading come again on other pages (below a page number, or not) or do not.
BLANK, PAGE_NUMBER, ROMAN, BARE, LONG_BARE, BREAK_LIKE, SENTENCE, HEADING, AGAIN, AGAIN_BELOW, MARKER = range(11)
#: Where a full line stands: first, second or further from the top, times the same from the bottom.
PLACES = 9
SYMBOLS = 10 * PLACES


def form_of(s: str) -> int:
    """The form of a stripped line that is no marker."""
    if not s:
        return BLANK
    if _PAGE_NO.match(s):
        return PAGE_NUMBER
    if _ROMAN.match(s):
        return ROMAN
    if _BARE.match(s):
        return BARE if len(s) <= 2 else LONG_BARE
    if s.startswith("[") or s[:1].islower() or s[-1:] in ".;,।":
        return BREAK_LIKE if len(s) < 40 and _breaks(s) else SENTENCE
    return HEADING


def _breaks(s: str) -> bool:
    return s.startswith("(") or s.endswith("-") or s.replace(",", "").replace(".", "").isdigit()


def forms_of(lines: list[str]) -> bytes:
    """Forms of a page's lines."""
    return bytes(MARKER if _MARKER.match(x) else form_of(x) for x in map(str.strip, lines))


def symbols_of(forms: bytes, repeated: set[int]) -> bytes:
    """The observations of a page: form and place of every full line, one symbol for blank lines and one for markers."""
    full = [i for i, f in enumerate(forms) if f not in (BLANK, MARKER)]
    out = bytearray(f == MARKER for f in forms)
    below = bool(full) and forms[full[0]] == PAGE_NUMBER
    for k, i in enumerate(full):
        f = forms[i]
        if f == HEADING and i in repeated:
            f = AGAIN_BELOW if below else AGAIN
        out[i] = f * PLACES + min(k, 2) * 3 + min(len(full) - 1 - k, 2)
    return bytes(out)


def _guess(form: int, ahead: int, behind: int) -> tuple[float, float, float, float]:
    """First guess of a symbol's log weight in each state."""
    if form == BLANK:
        return (-2.0, _NO, -0.1, -2.0)
    top, body, brk, bottom = -9.0 - 6.0 * max(0, ahead - 1), -1.0, -6.0, -9.0 - 6.0 * max(0, behind - 1)
    if form == PAGE_NUMBER:
        top, body, bottom = (-0.5 if ahead < 2 else top), -9.0, (-0.5 if behind < 2 else bottom)
    elif form in (ROMAN, BARE):
        brk = -2.5 if form == BARE else brk
        if behind < 2:
            bottom, body = (-0.7, -6.0) if behind == 0 else (-1.5, -4.0)
        if ahead == 0 and form == ROMAN:
            top, body = -1.0, -6.0
    elif form in (LONG_BARE, BREAK_LIKE):
        brk = -2.5
    elif form in (AGAIN, AGAIN_BELOW):
        if ahead == 0 or ahead == 1 and form == AGAIN_BELOW:
            top, body = -0.5, -9.0
        if behind < 2:
            bottom, body = -0.5, -9.0
    return (top, body, brk, bottom)


#: Log weights of the first guess; the states of the bottom are never left for the body, the body never for the top.
_NO = -1e9
_START = (-1.0, -0.5, -3.0, -6.0)
_TRANS = (
    (-1.2, -0.5, -1.5, _NO),
    (_NO, -0.3, -1.6, -3.0),
    (_NO, -0.4, -2.0, -3.0),
    (_NO, _NO, -1.0, -0.7),
)
#: Lines for each state that the first guess counts as, and rounds of expectation-maximisation.
PRIOR_LINES, ROUNDS = 500.0, 5
#: Below this ratio to the likeliest state, the guess holds: learning moves what is in doubt.
DOUBT = 0.02


class Model:
    """Start, transition and emission probabilities of the four states."""

    def __init__(self, start: np.ndarray, trans: np.ndarray, emit: np.ndarray):
        self.start, self.trans, self.emit, self.seen = start, trans, emit, {}
        with np.errstate(divide="ignore"):
            logs = [np.maximum(np.log(x), _NO) for x in (start, trans, emit)]
        self.log_start, self.log_trans, self.log_emit = logs[0].tolist(), logs[1].tolist(), logs[2].T.tolist()

    @staticmethod
    def first() -> Model:
        own = lambda x: np.exp(np.array(x)) / np.exp(np.array(x)).sum(-1, keepdims=True)
        emit = [_guess(k // PLACES, k % PLACES // 3, k % 3) if k >= PLACES or k < 2 else (_NO,) * 4 for k in range(SYMBOLS)]
        return Model(own(_START), own(_TRANS), own(np.array(emit).T))

    def expected(self, pages: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Expected counts of starts, transitions and emissions, and the log likelihood, of weighted pages (symbols, one row a page, of one length)."""
        n, length = pages.shape
        a, scale = np.zeros((length, n, 4)), np.zeros((length, n))
        for t in range(length):
            x = (self.start if t == 0 else a[t - 1] @ self.trans) * self.emit[:, pages[:, t]].T
            scale[t] = np.maximum(x.sum(1), 1e-300)
            a[t] = x / scale[t][:, None]
        emits, moves, b = np.zeros((4, SYMBOLS)), np.zeros((4, 4)), np.ones((n, 4))
        for t in range(length - 1, -1, -1):
            here = a[t] * b * weights[:, None]
            for k in range(4):
                emits[k] += np.bincount(pages[:, t], here[:, k], SYMBOLS)
            if t:
                ahead = self.emit[:, pages[:, t]].T * b / scale[t][:, None]
                moves += self.trans * ((a[t - 1] * weights[:, None]).T @ ahead)
                b = ahead @ self.trans.T
        return np.concatenate([here.sum(0), moves.ravel(), emits.ravel(), [float((np.log(scale) @ weights).sum())]])

    def updated(self, counts: np.ndarray) -> Model:
        """The model of expected counts, with the first guess as prior."""
        prior = Model.first()
        parts = (counts[:4], counts[4:20].reshape(4, 4), counts[20 : 20 + 4 * SYMBOLS].reshape(4, SYMBOLS))
        made = [c + PRIOR_LINES * p for c, p in zip(parts, (prior.start, prior.trans, prior.emit), strict=True)]
        start, trans, emit = [m / m.sum(-1, keepdims=True) for m in made]
        # What a state is stays fixed: where the guess leaves no doubt, a state gains no more of a symbol than the guess gives it beside the likeliest.
        best = prior.emit.argmax(0)
        most = prior.emit / np.maximum(prior.emit.max(0), 1e-300)
        emit = np.where(most < DOUBT, np.minimum(emit, emit[best, np.arange(SYMBOLS)] * most), emit)
        return Model(start, trans, emit / emit.sum(-1, keepdims=True))

    def page(self, text: str, repeated: set[int], forms: bytes | None) -> list[int]:
        """Labels of a page's lines, from the forms found before if they are this text's."""
        if forms is None or len(forms) != text.count("\n") + 1:
            forms = forms_of(text.split("\n"))
        symbols = symbols_of(forms, repeated)
        if (got := self.seen.get(symbols)) is None:
            if len(self.seen) > FLUSH:
                self.seen.clear()
            got = self.seen[symbols] = self.label(symbols)
        return got

    def label(self, symbols: bytes) -> list[int]:
        """The likeliest states (Viterbi); markers are breaks."""
        score, back = None, []
        for o in symbols:
            e = self.log_emit[o]
            if score is None:
                score = [x + y for x, y in zip(self.log_start, e, strict=True)]
                continue
            now, frm = [], []
            for k in range(4):
                best, at = _NO * 10, 0
                for j in range(4):
                    v = score[j] + self.log_trans[j][k]
                    if v > best:
                        best, at = v, j
                now.append(best + e[k])
                frm.append(at)
            back.append(frm)
            score = now
        if score is None:
            return []
        at = max(range(4), key=lambda k: score[k])
        out = [at]
        for frm in reversed(back):
            at = frm[at]
            out.append(at)
        return [BREAK if o == 1 else k for o, k in zip(symbols, out[::-1], strict=True)]


def learn(pages: DataFrame, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """The model learned from all pages (column symbols), and the log likelihood before each round.

    Pages that look the same are one weighted page; a round is one distributed
    pass over them that sums expected counts, one row for each task.
    """
    kinds = cut(pages.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "layout-kinds")
    model, told = Model.first(), []

    for _ in range(rounds):
        shared = pages.sparkSession.sparkContext.broadcast((model.start, model.trans, model.emit))

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, total = Model(*shared.value), np.zeros(21 + 4 * SYMBOLS)
            for b in batches:
                by: dict[int, list[int]] = {}
                rows, n = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False).astype(float)
                for i, r in enumerate(rows):
                    if r:
                        by.setdefault(len(r), []).append(i)
                for idx in by.values():
                    total += own.expected(np.array([np.frombuffer(rows[i], np.uint8) for i in idx]), n[idx])
            yield pa.RecordBatch.from_pydict({"k": pa.array(np.arange(len(total)), pa.int32()), "v": pa.array(total, pa.float64())})

        summed = {r.k: r.v for r in kinds.mapInArrow(count, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()}
        counts = np.array([summed.get(k, 0.0) for k in range(21 + 4 * SYMBOLS)])
        told.append(float(counts[-1]))
        model = model.updated(counts)
        if len(told) > 1 and told[-1] - told[-2] < 1e-5 * abs(told[-2]):
            break
    return model, told


def label_lines(lines: list[str], repeated: set[int], model: Model | None = None) -> list[int]:
    """The likeliest states of a page's lines."""
    return (model or Model.first()).label(symbols_of(forms_of(lines), repeated))


def find_noise(text: str, labels: list[int], corrector: Corrector) -> list[tuple[str, str]]:
    """(noise_kind, value) of a page whose lines are labelled: hyphen, char and furniture."""
    lines = text.split("\n")
    out: dict[tuple[str, str], None] = {}
    kept: list[str] = []
    for line, label in zip(lines, labels, strict=True):
        if label in (TOP, BOTTOM) and line.strip():
            out["furniture", line.strip()] = None
        else:
            kept.append(line)
    skip_first = False
    for i, line in enumerate(kept):
        tokens = line.split()
        broken = None
        if tokens and _BREAK_END.search(line) and i + 1 < len(kept) and (nxt := kept[i + 1].split()):
            broken = join_broken(tokens[-1], nxt[0], corrector)
        body = tokens[1 if skip_first else 0 : len(tokens) - (1 if broken else 0)]
        for t in body:
            if (fixed := fix_token(t, corrector)) is not None:
                out["char", fixed] = None
        if broken:
            out["hyphen", broken[0]] = None
            if broken[1]:
                out["char", broken[0]] = None
        skip_first = broken is not None
    return list(out)


_CASE = re.compile(r"^[^\w]*")


def _recase(original: str, fixed: str) -> str:
    core = original.strip(PUNCT)
    if core[:1].isupper() and not core[1:].isupper():
        fixed = fixed[:1].upper() + fixed[1:]
    elif core.isupper() and len(core) > 1:
        fixed = fixed.upper()
    head = _CASE.match(original).group(0) if original[:1] in PUNCT else ""
    tail = original[len(original.rstrip(PUNCT.replace("!", ""))) :]
    return head + fixed + tail


def paragraphs_of(text: str, labels: list[int], corrector: Corrector) -> tuple[list[str], bool, bool]:
    """A page's paragraphs without furniture, hyphens undone and misread words corrected; whether the first may go on from the page before and the last may go on.

    A word broken at the page's end stays at the end of the last paragraph with its hyphen.
    """
    lines = text.split("\n")
    body = [(x.strip(), k) for x, k in zip(lines, labels, strict=True) if k in (BODY, BREAK) and not _MARKER.match(x.strip())]
    paragraphs: list[list[str]] = [[]]
    carry = ""
    for n, (line, label) in enumerate(body):
        if not line:
            if not carry:
                paragraphs.append([])
            continue
        if label == BREAK:
            paragraphs.append([])
        tokens = line.split()
        if carry:
            joined = join_broken(carry, tokens[0], corrector)
            if joined:
                tail = tokens[0][len(tokens[0].rstrip(PUNCT)) :]
                tokens[0] = _recase(carry.rstrip(HYPHENS), joined[0]) + tail
            else:
                tokens.insert(0, carry)
            carry = ""
        if _BREAK_END.search(line) and n + 1 < len(body) and len(tokens) >= 1:
            carry = tokens.pop()
        for t in tokens:
            fixed = fix_token(t, corrector)
            paragraphs[-1].append(t if fixed is None else _recase(t, fixed))
        if label == BREAK:
            paragraphs.append([])
    if carry:
        paragraphs[-1].append(carry)
    full = [(x, k) for x, k in body if x]
    whole = [" ".join(p) for p in paragraphs if p]
    starts = bool(full) and full[0][1] == BODY and whole[0][:1].islower()
    ends = bool(full) and full[-1][1] == BODY and whole[-1].rstrip(PUNCT.translate({ord(c): None for c in ".!?।:;"}))[-1:] not in (".", "!", "?", "।", ":", ";", "")
    return whole, starts, ends


def repair(text: str, labels: list[int], corrector: Corrector) -> str:
    """The page's paragraphs as one text."""
    return "\n\n".join(paragraphs_of(text, labels, corrector)[0])


PAGE = ["record_table", "record_key", "doc", "page_no", "text"]
KEYS = ["record_table", "record_key"]


def _layout(pages: DataFrame) -> DataFrame:
    """For each page its forms and the numbers of the edge lines that other pages of its document have too; no text.

    Edge lines are at most 2 * EDGE a page. Counting is by (document, key) with
    map-side combine; the join back is by that key, so a document that holds a
    third of all pages is split by its keys, and by AQE within a key.
    """

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            take, line_no, key, forms = [], [], [], []
            for i, t in enumerate(b.column(4).to_pylist()):
                for n, k, f in [(-1, None, forms_of(t.split("\n"))), *((n, k, None) for n, k in edge_lines(t))]:
                    take.append(i)
                    line_no.append(n)
                    key.append(k)
                    forms.append(f)
            idx = pa.array(take, pa.int64())
            cols = {c: b.column(j).take(idx) for j, c in enumerate(PAGE[:4])}
            yield pa.RecordBatch.from_pydict(cols | {"line_no": pa.array(line_no, pa.int32()), "key": pa.array(key, pa.string()), "forms": pa.array(forms, pa.binary())})

    lines = cut(pages.mapInArrow(edges, "record_table string, record_key string, doc string, page_no int, line_no int, key string, forms binary"), "edge-lines")
    by_key = ["record_table", "doc", "key"]
    often = lines.where("key is not null").groupBy(by_key).agg(F.min("page_no").alias("a"), F.max("page_no").alias("b")).where("a < b").select(by_key)
    marked = lines.join(often, by_key, "left_semi").groupBy(*KEYS).agg(F.collect_set("line_no").alias("_rep"))
    own = lines.where("line_no = -1").groupBy(*KEYS).agg(F.max("forms").alias("forms"))
    return cut(own.join(marked, KEYS, "left"), "page-layout")


def layout_model(layout: DataFrame) -> tuple[Model, list[float]]:
    """The line model, learned from the layouts (forms, _rep) of all pages."""

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
            yield pa.RecordBatch.from_pydict({"symbols": pa.array([symbols_of(f, set(r or ())) for f, r in both], pa.binary())})

    return learn(layout.select("forms", "_rep").mapInArrow(observe, "symbols binary"))


def _labelled(pages: DataFrame, words: Lexicon, work, schema: str) -> DataFrame:
    """``work(text, labels of its lines, corrector)`` gives rows of ``schema``; pages (with all of PAGE) come in whole, once joined with their layout."""
    layout = _layout(pages)
    model, _ = layout_model(layout)
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast((words.frequent, words.bits, (model.start, model.trans, model.emit)))
    names = [x.split()[0] for x in schema.split(", ")]
    arrow = {"string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    types = [arrow[x.split()[1]] for x in schema.split(", ")]
    # Two texts of one page share its layout row; a text it does not fit is laid out again.
    ready = pages.select(*PAGE).join(layout.select(*KEYS, "_rep", "forms"), KEYS, "left").select(*KEYS, "text", "_rep", "forms")

    def asks() -> Callable[..., Iterator[str]]:
        own = Model(*shared.value[2])
        return lambda t, rep, forms: _forms_looked_for(t, own.page(t, set(rep or ()), forms))

    if words.rare is None:
        ready = ready.withColumn("_more", F.lit(None).cast(MORE))
    else:
        ready = ready.join(_rare_words(ready, KEYS, words.rare, shared, asks), KEYS, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, _, parts = shared.value
        own, corrector = Model(*parts), Corrector(frequent)
        for b in batches:
            take, rows = [], []
            for i, (t, rep, forms, more) in enumerate(zip(*(b.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True)):
                for row in work(t, own.page(t, set(rep or ()), forms), _with_more(corrector, frequent, more)):
                    take.append(i)
                    rows.append(row)
            if rows:
                idx = pa.array(take, pa.int64())
                cols = {"record_table": b.column(0).take(idx), "record_key": b.column(1).take(idx)}
                yield pa.RecordBatch.from_pydict(cols | {n: pa.array(c, k) for n, k, c in zip(names, types, zip(*rows, strict=True), strict=True)})

    return ready.select(*KEYS, "text", "_rep", "forms", "_more").mapInArrow(run, f"record_table string, record_key string, {schema}")


#: Rare words that a row found.
MORE = "array<struct<word:string,n:bigint>>"


def _rare_words(rows: DataFrame, keys: list[str], rare: DataFrame, shared, asks: Callable[[], Callable[..., Iterator[str]]]) -> DataFrame:
    """(keys, _more): what each of ``rows`` (keys first) looks for and is no frequent word, if it is in the table of rare ones.

    ``shared``: broadcast of a tuple that begins with the frequent words and the
    filter. ``asks()`` gives, in a task, what yields the forms a row looks for,
    from its columns beside ``keys``.
    """
    kinds = dict(rows.dtypes)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms_of_row, known = asks(), Looked(*shared.value[:2])
        corrector = Corrector(known)
        for b in batches:
            take, asked = [], []
            for i, row in enumerate(zip(*(b.column(k).to_pylist() for k in range(len(keys), b.num_columns)), strict=True)):
                known.missed = set()
                # What is found changes what is looked for next: everything that can come up is asked for.
                for form in forms_of_row(*row):
                    corrector.ask(form)
                take += [i] * len(known.missed)
                asked += known.missed
            idx = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_pydict({k: b.column(n).take(idx) for n, k in enumerate(keys)} | {"word": pa.array(asked, pa.string())})

    asked = rows.mapInArrow(look, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", word string").distinct()
    return asked.join(rare, "word").groupBy(*keys).agg(F.collect_list(F.struct("word", "n")).alias("_more"))


def _with_more(corrector: Corrector, frequent: dict[str, int], more: list | None) -> Corrector:
    """The corrector for a row that found rare words (_more), else the one of the frequent words."""
    return Corrector(ChainMap({x["word"]: x["n"] for x in more}, frequent)) if more else corrector


def _forms_looked_for(text: str, labels: list[int]) -> Iterator[str]:
    """Every word form that the correction of a page can ask the lexicon for, but for undone misreadings of it."""
    lines = [x for x, k in zip(text.split("\n"), labels, strict=True) if k in (BODY, BREAK)]
    full = [s for x in lines if (s := x.strip())]
    for t in (t for x in full for t in x.split()):
        low = t.strip(PUNCT.replace("!", "")).lower()
        yield from (low, low.rstrip("!"))
    # Noise is found line by line; paragraphs go on beyond markers.
    yield from _forms_of_breaks(full)
    unmarked = [x for x in full if not _MARKER.match(x)]
    if len(unmarked) < len(full):
        yield from _forms_of_breaks(unmarked)


def _forms_of_breaks(pieces: list[str]) -> Iterator[str]:
    """The forms that are asked for where a word is broken between a piece of text and the next; a piece that is one word may be broken at both ends."""
    carried: set[str] = set()
    for piece, following in pairwise(pieces):
        if not _BREAK_END.search(piece):
            carried = set()
            continue
        row, right = piece.split(), following.split()[0]
        lefts, carried = {row[-1]} | (carried if len(row) == 1 else set()), set()
        b = right.strip(PUNCT.replace("!", "")).lower()
        for left in lefts:
            a = left.rstrip().rstrip(HYPHENS).lstrip(PUNCT.replace("!", "")).lower()
            for end in {b, b.rstrip("!'’")}:
                yield from (a, end, a + end, f"{a}-{end}")
            # A word with a hyphen behind it is in no lexicon: it is carried on as it stands.
            carried.add(_recase(left.rstrip(HYPHENS), a + b) + right[len(right.rstrip(PUNCT)) :])


def page_noise(pages: DataFrame, words: Lexicon) -> DataFrame:
    """(record_table, record_key, noise_kind, value_key): the noise of each page, once.

    pages: record_table, record_key, doc, page_no, text. Null and empty texts
    give no rows; a line of a one-page document is furniture only as a page
    number; texts are read whole. Repeated rows count once.
    """
    real = pages.select(*PAGE).where("text is not null and text <> ''")
    return _labelled(real, words, find_noise, "noise_kind string, value_key string").distinct()


def repaired_pages(pages: DataFrame, words: Lexicon) -> DataFrame:
    """(record_table, record_key, text): whole paragraphs of each page. Repeated rows once; a page of nothing but furniture gives an empty text."""
    real = pages.select(*PAGE).where("text is not null and text <> ''").dropDuplicates(KEYS)
    return _labelled(real, words, lambda t, labels, c: [(repair(t, labels, c),)], "text string")


#: Pages of a document whose breaks are counted in one task.
PAGES_TOGETHER = 4096


def paragraphs(pages: DataFrame, words: Lexicon) -> DataFrame:
    """(record_table, doc, first_page, last_page, paragraph_no, text): continuous paragraphs, over page breaks too.

    A paragraph goes on over a page break if it does not end there like a
    sentence and the next page that was scanned (the next number) starts in
    lower case; a word broken at the break is put together. paragraph_no counts
    within first_page. A page that is missing, empty or all furniture ends a
    paragraph. Null documents have their pages alone. Of several texts of one
    page the first in order of its key counts.
    """
    real = pages.select(*PAGE).where("text is not null and text <> ''").dropDuplicates(KEYS)
    made = _labelled(real, words, lambda t, labels, c: [paragraphs_of(t, labels, c)], "paras array<string>, starts boolean, ends boolean")
    where = real.select(*KEYS, F.coalesce("doc", F.concat(F.lit("\0"), "record_key")).alias("doc"), "page_no")
    placed = cut(made.where("size(paras) > 0").join(where, KEYS), "paragraphs")
    chosen = placed.groupBy("record_table", "doc", "page_no").agg(F.min("record_key").alias("record_key"))
    placed = placed.join(chosen, ["record_table", "doc", "page_no", "record_key"])
    # Page breaks: small rows without the texts, each joined with the page before.
    page = ["record_table", "doc", "page_no"]
    breaks = placed.select(*page, "starts", "ends", F.size("paras").alias("n"))
    before = breaks.select("record_table", "doc", (F.col("page_no") + 1).alias("page_no"), F.col("ends").alias("_open"))
    joined = breaks.join(before, page, "left").withColumn("goes_on", F.coalesce(F.col("_open") & F.col("starts"), F.lit(False)))
    # A paragraph's number is that of the page it began on: pages of one paragraph through and through pass it on.
    joined = joined.withColumn("_own", F.when(~F.col("goes_on") | (F.col("n") > 1), F.col("page_no")))
    joined = joined.withColumn("_part", F.floor(F.col("page_no") / PAGES_TOGETHER))
    last = joined.groupBy("record_table", "doc", "_part").agg(F.max("_own").alias("_m"))
    carried = last.select("record_table", "doc", "_part", F.max("_m").over(Window.partitionBy("record_table", "doc").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_from"))
    within = F.max("_own").over(Window.partitionBy("record_table", "doc", "_part").orderBy("page_no").rowsBetween(Window.unboundedPreceding, -1))
    begun = joined.withColumn("_in", within).join(carried, ["record_table", "doc", "_part"]).select(*page, "goes_on", "n", F.coalesce("_in", "_from").alias("_before"))
    rows = placed.select(*page, F.posexplode("paras").alias("i", "text")).join(begun, page)
    first = (F.col("i") == 0) & F.col("goes_on")
    counts = begun.select("record_table", "doc", F.col("page_no").alias("_start"), F.col("n").alias("_n"))
    rows = rows.withColumn("_start", F.when(first, F.col("_before")).otherwise(F.col("page_no")))
    rows = rows.join(counts, ["record_table", "doc", "_start"]).withColumn("_no", F.when(first, F.col("_n") - 1).otherwise(F.col("i")))
    whole = rows.groupBy("record_table", "doc", "_start", "_no").agg(F.max("page_no").alias("last_page"), F.sort_array(F.collect_list(F.struct("page_no", "text"))).alias("_parts"))
    whole = whole.withColumn("_texts", F.transform("_parts", lambda x: x["text"]))
    shared = real.sparkSession.sparkContext.broadcast((words.frequent, words.bits))
    if words.rare is None:
        whole = whole.withColumn("_more", F.lit(None).cast(MORE))
    else:
        # Words broken at a page's end may be rare too.
        own, whole = ["record_table", "doc", "_start", "_no"], cut(whole, "paragraph-parts")
        over = whole.where("size(_texts) > 1").select(*own, "_texts")
        whole = whole.join(_rare_words(over, own, words.rare, shared, lambda: _forms_of_breaks), own, "left")

    @F.pandas_udf("string")
    def put_together(parts: pd.Series, found: pd.Series) -> pd.Series:
        frequent, out = shared.value[0], []
        usual = Corrector(frequent)
        for texts, more in zip(parts, found, strict=True):
            corrector = _with_more(usual, frequent, None if more is None else list(more))
            text = texts[0]
            for t in texts[1:]:
                head, _, end = text.rpartition(" ")
                start, _, rest = t.partition(" ")
                joined = join_broken(end, start, corrector) if _BREAK_END.search(text) else None
                if joined:
                    word = _recase(end.rstrip(HYPHENS), joined[0]) + start[len(start.rstrip(PUNCT)) :]
                    text = " ".join(x for x in (head, word, rest) if x)
                else:
                    text = f"{text} {t}"
            out.append(text)
        return pd.Series(out, dtype=object)

    text = F.when(F.size("_texts") == 1, F.col("_texts")[0]).otherwise(put_together("_texts", "_more"))
    return whole.select("record_table", "doc", F.col("_start").alias("first_page"), "last_page", F.col("_no").alias("paragraph_no"), text.alias("text"))
