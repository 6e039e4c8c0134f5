"""Text expressions that agree with Python's string methods code point by code point."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's ``str.strip`` and ``str.split`` take for white space.
_WS = r"[\s\x1c-\x1f]"


def strip(c: Column) -> Column:
    """Python's ``strip()``: also the separators U+001C to U+001F and Unicode spaces, which ``trim`` leaves."""
    return F.regexp_replace(c, rf"(?U)\A{_WS}+|{_WS}+\z", "")


def is_blank(c: Column) -> Column:
    """True for null and for text of nothing but white space."""
    return F.coalesce(strip(c) == "", F.lit(True))


def tokens(c: Column) -> Column:
    """White-space separated tokens, as ``split()`` gives them."""
    return F.filter(F.split(c, rf"(?U){_WS}+"), lambda t: t != "")


def normalise(c: Column) -> Column:
    """One newline form, single blanks, no blanks at line ends, at most one empty line in a row, stripped."""
    s = F.regexp_replace(c, r"\r\n|\r", "\n")
    s = F.regexp_replace(s, r"[ \t]{2,}", " ")
    s = F.regexp_replace(s, r"(?dm)[ \t]+$", "")
    s = F.regexp_replace(s, r"\n{3,}", "\n\n")
    return strip(s)


def token_jaccard(a: Column, b: Column) -> Column:
    """Share of tokens that two texts have in common; 1.0 if neither has any. Nulls count as empty."""
    x, y = tokens(F.coalesce(a, F.lit(""))), tokens(F.coalesce(b, F.lit("")))
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / union)


@functools.cache
def _decomposed() -> tuple[str, str]:
    """Every letter or digit beyond ASCII whose compatibility decomposition has exactly one ASCII character, and that character."""
    pairs = []
    for cp in (*range(0x80, 0x2E80), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)):
        c = chr(cp)
        d = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
        if len(d) == 1:
            pairs.append((c, d))
    return "".join(c for c, _ in pairs), "".join(d for _, d in pairs)


def ascii_slug(c: Column, limit: int = 40) -> Column:
    """Slug of a text: letters decomposed (NFKD) to ASCII, combining marks and what else is not ASCII dropped, runs of the rest to ``_``.

    Characters that decompose to several ASCII characters (ligatures, fractions) are dropped too.
    """
    s = F.regexp_replace(F.translate(c, *_decomposed()), r"[^\x00-\x7f]", "")
    s = F.regexp_replace(F.lower(s), r"[^a-z0-9]+", "_")
    s = F.substring(F.regexp_replace(s, r"^_+|_+$", ""), 1, limit)
    s = F.regexp_replace(s, r"_+$", "")
    return F.when(s == "", "unnamed").otherwise(s)


def snippet(c: Column, length: int = 300) -> Column:
    """White space collapsed, cut to a length."""
    return F.substring(F.array_join(tokens(c), " "), 1, length)
