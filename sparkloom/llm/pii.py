"""Personal information in free text: found, and replaced by typed surrogates.

Detection works on one text at a time with patterns for what personal items
look like and for the words around them. Method of replacement: surrogate
generation. Every distinct item of a scope gets a keyed replacement of its own
type that keeps the item's format (digit groups, case, script, title and with
it gender). Surrogates are checked for collisions and drawn again until all of
a scope are distinct, and every mention of one item in the scope, in whatever
form it is written, gets the same one, so that the text still tells who is who.
Scopes have surrogates of their own: the masked texts of two clients cannot be
joined by the people in them.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.common import cut

# Words that make a number a business paper's, and words that make a name a firm's.
PAPER_WORDS = (
    "docket", "consignment", "bill", "invoice", "challan", "lot", "batch", "receipt", "voucher", "policy", "policies", "order", "ref",
    "reference", "account", "a/c", "acct", "cheque", "card", "hsn", "sac", "gstin", "cin", "tan", "llpin", "utr", "waybill",
    "awb", "tracking", "meter", "file", "case", "article", "loan", "folio", "licence", "license", "token", "serial", "arn", "srn", "din", "iec", "fssai", "udyam", "ack",
    "acknowledgement", "ticket", "booking", "pnr", "shipment", "parcel", "memo", "note", "slip", "entry", "transaction", "txn", "rrn", "warrant", "deposit",
    "डॉकेट", "चालान", "बिल", "चेक", "खाता", "पॉलिसी",
)
FIRM_WORDS = (
    "ltd", "limited", "pvt", "private", "llp", "inc", "co", "company", "corp", "corporation", "traders", "trading", "exports", "imports",
    "industries", "enterprises", "stationers", "bearings", "polymers", "textiles", "ceramics", "logistics", "agro", "foods", "associates",
    "brothers", "bros", "sons", "bank", "mills", "motors", "stores", "services", "solutions", "partners", "group", "trust", "society", "works", "agencies",
    "chemicals", "pharma", "steels", "builders", "infra", "apartments", "chambers", "plaza", "residency", "towers", "nivas", "department", "office",
)
TITLES = {
    "mr": "m", "shri": "m", "sri": "m", "sh": "m", "kumar": "m", "ms": "f", "mrs": "f", "smt": "f", "miss": "f", "kum": "f", "kumari": "f",
    "dr": "", "ca": "", "cs": "", "prof": "", "adv": "", "er": "",
    "श्री": "m", "श्रीमती": "f", "सुश्री": "f", "डॉ": "", "कुमारी": "f",
}

_AT = r"(?:\s?@\s?|\s?[\(\[\{]\s?at\s?[\)\]\}]\s?)"
_DOT = r"(?:\.|\s?[\(\[\{]\s?dot\s?[\)\]\}]\s?)"
EMAIL = re.compile(rf"(?<![\w.+-])([\w][\w.+-]*){_AT}([A-Za-z0-9][\w-]*(?:{_DOT}[A-Za-z0-9][\w-]*)+)", re.I)

#: Digits with the separators numbers are written with; what it stands for is told from its parts and neighbours.
RUN = re.compile(r"\d[\d\s.()-]{8,17}\d")
_CODE = re.compile(r"\(?(?:\+\s?91|0091)\)?[\s.-]{0,2}$|\($")
_PHONE_BODY = re.compile(r"^\(?[1-9]\d{2}\)\s?\d{3}[\s.-]\d{4}$|^\(?0?[1-9]\d{4}[\s.-]?\d{5}$|^0?[1-9]\d{2}[.\s-]\d{3}[.\s-]\d{4}$|^0?[1-9]\d{3}[.\s-]\d{3}[.\s-]\d{3}$|^0?\d{2,4}[\s-]\d{6,8}$|^0?[1-9]\d[\s.-]\d{4}[\s.-]\d{4}$")
_NATIONAL = re.compile(r"^\d{4}([\s-]?)\d{4}\1\d{4}$")
_PAPER_BEFORE = re.compile(
    r"(?:\b(?:" + "|".join(re.escape(w) for w in PAPER_WORDS) + r")s?\b\.?\s*(?:(?:no|number|nos|num|id)\b\.?)?\s*[:#-]?\s*)$", re.I
)
_PAPER_AFTER = re.compile(r"^\s+(?:passed\s+for\s+payment|of\s+\d)", re.I)
#: Personal tax number, found from its digits; the fourth letter says that its holder is a person.
_TAX_TAIL = re.compile(r"\d{4}[\s-]?[A-Za-z](?![A-Za-z0-9])")
_TAX_HEAD = re.compile(r"(?<![A-Za-z0-9])([A-Za-z]{3}[Pp][A-Za-z])([\s-]?)$")
PASSPORT = re.compile(r"(?<![A-Za-z0-9/-])([A-Za-z])(\s?)(\d{7})(?![A-Za-z0-9/-])")
_PASSPORT_BEFORE = re.compile(r"(?:passport|\bpp|पासपोर्ट)\s*(?:(?:no|number|num)\b)?\.?\s*[:#-]?\s*$", re.I)

_ADDRESS_CUES = (
    r"address(?:\s+of\s+\w+)?\s*[:-]|resid(?:es|ing|ent|ence)\s+(?:at|of|in|is)|served\s+(?:at|on)|papers\s+to|shifted\s+to|moved\s+to|lives\s+(?:at|in)|living\s+(?:at|in)|"
    r"house\s*(?:[:-]|\bis\b)|home\s*(?:[:-]|\bis\b)|deliver(?:ed)?\s+to|sent\s+to|posted\s+to|stay(?:s|ing)\s+(?:at|in)|r/o|पता\s*[:-]"
)
ADDRESS_CUE = re.compile(rf"(?<!\w)(?:{_ADDRESS_CUES})\s+(?=(?:Flat|Plot|H\.?\s?No|House|No|Door|Shop|\d|[A-Z]))", re.I)
#: From a cue to a postal code, however far, but not past the end of a sentence (a stop after a word of four letters or more), an empty line, a cell or a listed field.
ADDRESS = re.compile(
    r"((?:[^@|\t;.!?\n]|[.!?](?!(?<=[a-z]{4}[.!?])\s)|\n(?!\s*\n|\w+\.\d+\.)){5,}?(?<![\d/.,])([1-9]\d{2}\s?\d{3}))(?![\d/]|,\d)", re.I,
)

_UPPER, _LOWER = "A-ZÀ-ÖØ-ÞĀ-ž", "a-zà-öø-ÿĀ-ž"
_WORD = rf"(?:[{_UPPER}][{_LOWER}]+|[{_UPPER}]{{2,}})(?![\w@])(?!\.\w)(?!\s?(?:@|[\[({{]\s?at\b))"
_NAME = rf"(?:(?:{_WORD}|[{_UPPER}]\.)(?:\s+(?:[{_UPPER}]\.\s*)*{_WORD}){{0,3}}(?:,\s+{_WORD}(?:\s+[{_UPPER}]\.)?)?)"
_TITLE_WORDS = ("Mr", "Mrs", "Ms", "Miss", "Smt", "Shri", "Sri", "Dr", "CA", "CS", "Prof", "Adv", "Er", "Kum")
_TITLE = rf"(?:(?:{'|'.join(_TITLE_WORDS)})\b\.?)"
_BEFORE = (
    r"(?:[Cc]ontact\s+person\s*[-:]|[Nn]ame(?:\s+of\s+(?:the\s+)?[a-z]+)?\s*:|[Aa]s\s+told\s+by|belongs\s+to|[Rr]eviewed(?:\s+by)?\s*:|[Pp]repared\s+by:?|[Cc]hecked\s+by:?|"
    r"[Nn]ominee:?|handed\s+to|[Ww]e\s+met|[Ss]igned\s+before\s+me\s+by|[Ss]igned\s+by|\(?[Ss]d/-\)?|[Ss]alary\s+of|[Aa]ttn:?|c/o|C/o)"
)
_AFTER = r"(?=\s+(?:can\s+be\s+reached|will\s+collect|has\s+not\s+signed)\b)"
NAME_AFTER_CUE = re.compile(rf"(?<!\w){_BEFORE}\s+({_TITLE}\s+)?({_NAME})")
#: A bare title at the end of a line is a column of a listing (debit side), not a title.
NAME_AFTER_TITLE = re.compile(rf"(?<![\w@.])(?:{_TITLE}(?<=\.)\s+|{_TITLE}[ \t]+)({_NAME})")
NAME_BEFORE_CUE = re.compile(rf"(?<![\w@.,-])({_TITLE}\s+)?({_NAME}){_AFTER}")
# Nouns and verbs that go with people. Before a name the nouns may have an owner ("his brother"), after it stand the verbs.
_KIN = "brother|sister|father|mother|wife|husband|son|daughter|uncle|aunt|friend|colleague|neighbour|neighbor|tenant|trustee|guardian|witness|nephew|niece|cousin"
_ACTS = "called|calls|lives|resides|said|says|wrote|writes|phoned|thanked|joined"
_TWO = rf"(?:(?:{_WORD}|[{_UPPER}]\.)(?:\s+(?:[{_UPPER}]\.\s*)*{_WORD}){{1,2}})"
NAME_OF_KIN = re.compile(rf"(?<!\w)(?:(?:[Mm]y|[Hh]is|[Hh]er|[Oo]ur|[Tt]heir|[Yy]our)\s+(?:{_KIN})|[Tt]hank|[Dd]ear)\s+({_TITLE}\s+)?({_TWO})")
NAME_THAT_ACTS = re.compile(rf"(?<![\w@.,-])({_TITLE}\s+)?({_TWO})(?=\s+(?:{_ACTS})\b|['’]s\s+(?:home|house|wife|husband|mobile|phone|father|mother)\b)")
_DEVANAGARI = r"[\u0900-\u0963\u0970-\u097f]+"
# Words that end a Hindi name.
_AFTER_HINDI = frozenset("ने को का की के से में पर द्वारा जी और व तथा या है हैं था थी थे हो हुआ हुई किया कि भी ही तो यह वह इस उस एक नहीं जो साहब".split())
NAME_IN_HINDI = re.compile(rf"(?<![\w\u0900-\u097f])(?:(?:श्रीमती|सुश्री|श्री|डॉ\.?|कुमारी)\s+|(?:नाम|हस्ताक्षरकर्ता)\s*[:-]\s*)({_DEVANAGARI}(?:[ \t]+{_DEVANAGARI}){{0,3}})")
#: Literals one of which stands in every cue of the patterns for names, addresses and passport numbers: parts of single words, so that no white space breaks them.
_NAME_KEYS = (
    "person", "ame", "told", "belongs", "eviewed", "repared", "hecked", "ominee", "handed", "met", "igned", "d/-", "alary", "ttn", "c/o", "C/o", "reached", "collect", *_TITLE_WORDS, *_KIN.split("|"), "hank", "ear ", "ear\n", "ear\t", *_ACTS.split("|"), "'s", "’s",
)
#: Of the case-folded text.
_ADDRESS_KEYS = ("address", "resid", "served", "papers", "shifted", "moved", "lives", "living", "house", "home", "deliver", "sent", "posted", "staying", "r/o", "पता")
_KEYS = ahocorasick.Automaton()
for _k in _NAME_KEYS:
    _KEYS.add_word(_k, "n")
for _k in ("श्री", "डॉ", "कुमारी", "नाम", "हस्ताक्षरकर्ता"):
    _KEYS.add_word(_k, "h")
_KEYS.add_word("assport", "p")
_KEYS.add_word("ASSPORT", "p")
_KEYS.add_word("PP", "p")
_KEYS.add_word("पासपोर्ट", "p")
for _k in ("@", "at)", "at]", "at}", "AT)", "AT]", "at )", "at ]"):
    _KEYS.add_word(_k, "e")
_KEYS.make_automaton()
_FIRM = re.compile(r"^(?:\s*(?:&|and)\s+(?:Co|Sons|Bros|Company|Associates|Partners)\b|[\s,]*(?:" + "|".join(FIRM_WORDS) + r")\b)", re.I)
_NOT_NAMES = frozenset(
    "the a an this that his her their our my we they she he it one no some any all see new old management customer supplier cashier landlord owner clerk "
    "pan uid id passport aadhaar aadhar pin tel ph call mobile email whatsapp january february march april may june july august september october "
    "november december monday tuesday wednesday thursday friday saturday sunday address name gstin hsn rs docket bill consignment "
    "prepared reviewed contact checked balance ledger stock working page pg whatsapp challan cheque invoice policy registered confidential holder "
    "kyc copy total stamp signed schedules filing options insurance e-mail receipt contra journal sales payment in on at to of for and or not if as is "
    "resides shifted notice deliver date type subject summary note minutes memorandum".split()
)


Item = tuple[int, int, str, str]
#: Words before and after a key among which an item that belongs to it lies: more than its pattern can take.
_REACH = {"n": (12, 16), "e": (12, 40), "p": (6, 8), "h": (2, 8)}
_WORDS = re.compile(r"\S+")


def _windows(t: str) -> dict[str, list[tuple[int, int]]]:
    """Merged stretches of the text around its keys, by kind of item. They begin and end between words, however long the words are."""
    out: dict[str, list[tuple[int, int]]] = {"n": [], "e": [], "p": [], "h": []}
    starts: list[int] | None = None
    for end, kind in _KEYS.iter(t):
        if starts is None:
            starts = [m.start() for m in _WORDS.finditer(t)]
        back, ahead = _REACH[kind]
        at = bisect_right(starts, end)
        a = starts[max(0, at - back)] if starts else 0
        b = starts[at + ahead] if at + ahead < len(starts) else len(t)
        rows = out[kind]
        if rows and rows[-1][1] >= a:
            rows[-1] = (rows[-1][0], b)
        else:
            rows.append((a, b))
    return out


def _find_emails(t: str, windows: list[tuple[int, int]]) -> Iterator[Item]:
    for lo, hi in windows:
        for m in EMAIL.finditer(t, lo, hi):
            user, raw = m.group(1), m.group(2)
            if not re.search(r"[A-Za-z]", raw) or user.isdigit() and " " in m.group(0):  # 40 units @ 1.50
                continue
            end = m.end()
            # A full stop and the next sentence's first word are no part of the domain.
            tail = re.search(r"\.([A-Z][a-z]*)$", raw)
            if tail and "." in raw[: tail.start()] and not raw[: tail.start()].isupper():
                raw, end = raw[: tail.start()], end - len(tail.group(0))
            domain = re.sub(_DOT, ".", raw, flags=re.I)
            if re.search(r"[A-Za-z]", domain.rpartition(".")[2]):
                yield m.start(), end, "email", f"{user}@{domain}".lower()


def _number(t: str, start: int, body: str) -> Item | None:
    """What a run of digits is, if it is a phone or a national number."""
    head = _CODE.search(t, max(0, start - 9), start)
    code = head is not None and head.group(0) != "("
    digits = re.sub(r"\D", "", body)
    if not code and body[:4] == "0091" and len(digits) == 14:
        code, digits = True, digits[4:]
    lo = head.start() if code and head else start
    before, after = t[max(0, lo - 40) : lo], t[start + len(body) : start + len(body) + 24]
    if lo and (before[-1:].isalnum() or before[-1:] in "/,.@#-_") and not re.search(r"(?:[A-Za-z]|[^\w])[.]$|[ \t\n][-]$", before):
        return None
    if after and (after[0].isalnum() or after[0] in "/@_" or re.match(r"[,.-]\d| ?%", after)):
        return None
    if _PAPER_BEFORE.search(before) or _PAPER_AFTER.match(after):
        return None
    if code:
        return (lo, start + len(body), "phone", digits[-10:]) if len(digits) in (10, 11) else None
    if len(digits) == 12 and _NATIONAL.match(body):
        return start, start + len(body), "id", digits
    if (len(digits) == 10 or len(digits) == 11 and digits[0] == "0") and digits[-10] != "0" and (body.isdigit() or _PHONE_BODY.match(body)):
        return start, start + len(body), "phone", digits[-10:]
    return None


def _find_numbers(t: str) -> Iterator[Item]:
    pos = 0
    while m := RUN.search(t, pos):
        body, pos = m.group(0), m.end()
        if body[1:11].isdigit() and len(body) > 15 and body[:15].isdigit():
            continue
        # A run may hold more than the number: what follows on the next line, or in the next group.
        cuts = [len(body)] + [x.start() for x in re.finditer(r"[\s)]+", body)][::-1]
        for cut in cuts:
            if cut >= 10 and (item := _number(t, m.start(), body[:cut])):
                yield item
                pos = max(item[1], m.start() + 1)
                break
        else:
            inner = re.search(r"[\s)-]+", body)
            if inner:
                pos = m.start() + inner.end()


def _find_ids(t: str, windows: list[tuple[int, int]]) -> Iterator[Item]:
    for m in _TAX_TAIL.finditer(t):
        if (h := _TAX_HEAD.search(t, max(0, m.start() - 7), m.start())) is not None:
            tail = m.group(0)
            if bool(h.group(2)) == bool(tail[4:-1]):
                yield h.start(), m.end(), "id", (h.group(1) + tail[:4] + tail[-1]).upper()
    if "ssn" in (low := t.lower()) or "social" in low:
        for m in _SOCIAL.finditer(t):
            yield m.start(1), m.end(3), "id", "".join(m.groups())
    for lo, hi in windows:
        for m in PASSPORT.finditer(t, lo, hi):
            if _PASSPORT_BEFORE.search(t, max(0, m.start() - 24), m.start()):
                yield m.start(), m.end(), "id", (m.group(1) + m.group(3)).upper()


_SOCIAL = re.compile(r"(?:ssn|social\s+security)(?:\s*(?:no|number))?\.?\s*(?:is\s+)?[:#-]?\s*(\d{3})[- ]?(\d{2})[- ]?(\d{4})(?!\d)", re.I)


def _find_addresses(t: str) -> Iterator[Item]:
    low = t.casefold()
    if not any(k in low for k in _ADDRESS_KEYS):
        return
    last: Item | None = None
    for cue in ADDRESS_CUE.finditer(t):
        m = ADDRESS.match(t, cue.end())
        if m is None:
            continue
        item = (m.start(1), m.end(1), "address", re.sub(r"\D", "", m.group(2)))
        # An address begins after the last cue before its code.
        if last is not None and last[1] != item[1]:
            yield last
        last = item
    if last is not None:
        yield last


_ENDS = re.compile(r"\s*(?:[,;.:()<\n|]|$)|\s+(?:can\s+be|will\s+collect|about|on\s+\d|is\s+held|during|has\s+not)\b")


def _clean_name(t: str, start: int, end: int) -> tuple[int, int] | None:
    """Cut a name candidate to the words that can be a name; None if nothing is left or it is a firm's.

    A name may run over a line end, but not once it is complete.
    """
    words = [(start + w.start(), start + w.end()) for w in re.finditer(r"[^\W\d_]+\.?", t[start:end])]
    keep: list[tuple[int, int]] = []
    for a, b in words:
        word = t[a:b].rstrip(".").lower()
        if keep and "\n" in t[keep[-1][1] : a]:
            line_end = t.find("\n", a)
            line = t[a : line_end if line_end >= 0 else len(t)]
            if len(keep) >= 2 and keep[-1][1] - keep[-1][0] > 2 and "," not in t[keep[-1][1] : a] or word in _NOT_NAMES or any(w.lower().rstrip(".") in FIRM_WORDS for w in line.split()[:5]):
                break
        if not keep and (word in TITLES or word in ("cr", "dr")):
            continue  # a title, or the side column of a listing
        if word in _NOT_NAMES:
            break
        if word in FIRM_WORDS:
            return None
        if len(word) > 1 and t[a:b].endswith("."):
            keep.append((a, b - 1))
            break
        keep.append((a, b))
    # More than a given and a family name only where the mention ends there: the next sentence begins with a capital too.
    while sum(b - a > 2 for a, b in keep) > 2 and not _ENDS.match(t, keep[-1][1]):
        keep.pop()
    while keep and keep[-1][1] - keep[-1][0] <= 2 and len(keep) > 1 and not t[keep[-1][0] : keep[-1][1]].endswith("."):
        keep.pop()
    if not keep or not any(b - a > 2 for a, b in keep):
        return None
    a, b = keep[0][0], keep[-1][1]
    nxt = _FIRM.match(t, b, min(len(t), b + 24))
    if nxt and "\n" not in nxt.group(0):
        return None
    return a, b


def _find_names(t: str, windows: list[tuple[int, int]], taken: list[Item]) -> Iterator[Item]:
    spans: list[tuple[int, int]] = []
    for lo, hi in windows:
        for rx, g in ((NAME_AFTER_CUE, 2), (NAME_BEFORE_CUE, 2), (NAME_AFTER_TITLE, 1), (NAME_OF_KIN, 2), (NAME_THAT_ACTS, 2)):
            pos = lo
            while m := rx.search(t, pos, hi):
                end = min([m.end(g), *(x[0] for x in taken if m.start(g) < x[0] < m.end(g))])
                span = _clean_name(t, m.start(g), end)
                if span and rx is NAME_THAT_ACTS and span[1] != m.end(g):
                    span = None  # what acts is not the name
                # What was cut off may be the start of the next mention.
                pos = max(span[1], m.start() + 1) if span else m.start(g) + 1
                if span and not any(a < span[1] and span[0] < b for a, b in spans):
                    spans.append(span)
    for a, b in spans:
        yield a, b, "name", " ".join(t[a:b].lower().split())


def _find_hindi_names(t: str, windows: list[tuple[int, int]]) -> Iterator[Item]:
    """Names in Devanagari after a title or the word for name: up to three words, until a word that goes on with the sentence."""
    for lo, hi in windows:
        for m in NAME_IN_HINDI.finditer(t, lo, hi):
            end = m.start(1)
            for w in list(re.finditer(_DEVANAGARI, m.group(1)))[:4]:
                if w.group() in _AFTER_HINDI or end > m.start(1) and m.group(1)[: w.start()].count(" ") > 2:
                    break
                end = m.start(1) + w.end()
            if end > m.start(1):
                yield m.start(1), end, "name", " ".join(t[m.start(1) : end].split())


def find_all(t: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the personal items of a text, without overlaps, in order."""
    if not t:
        return []
    near = _windows(t)
    found: list[Item] = []
    for items in (_find_emails(t, near["e"]), _find_addresses(t), _find_ids(t, near["p"]), _find_numbers(t), _find_names(t, near["n"], found), _find_hindi_names(t, near["h"])):
        for item in items:
            if not any(item[0] < b and a < item[1] for a, b, _, _ in found):
                found.append(item)
    return sorted(found)


_LAST_WORD = re.compile(r"([^\W\d_\u0900-\u097f]+|[\u0900-\u097f]+)\.?\s+$")


def title_before(t: str, start: int) -> str:
    """m, f or nothing: what the title right before a name says."""
    m = _LAST_WORD.search(t, max(0, start - 24), start)
    return TITLES.get(m.group(1).lower(), "") if m else ""


MENTIONS = "kind string, value string, start int, end int, surface string, gender string"


def detect(records: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row per personal item: keys, kind, value, start and end (code points), the text as written and the gender a name's title tells.

    kind is email, phone, id, address or name; value is its normal form.
    Overlapping finds are settled in that order. Null and empty texts give no
    rows; texts of any length are scanned whole; repeated records give repeated
    rows. Extra columns are ignored. No shuffle: each text is scanned where it lies.
    """
    schema = ", ".join(f"`{k}` {records.schema[k].dataType.simpleString()}" for k in keys) + ", " + MENTIONS

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            take: list[int] = []
            rows: list[tuple] = []
            for i, t in enumerate(b.column(len(keys)).to_pylist()):
                for a, e, kind, value in find_all(t):
                    take.append(i)
                    rows.append((kind, value, a, e, t[a:e], title_before(t, a) if kind == "name" else ""))
            if rows:
                idx = pa.array(take, pa.int64())
                cols = {k: b.column(n).take(idx) for n, k in enumerate(keys)}
                kinds, values, starts, ends, surfaces, genders = zip(*rows, strict=True)
                yield pa.RecordBatch.from_pydict(
                    cols | {"kind": pa.array(kinds, pa.string()), "value": pa.array(values, pa.string()), "start": pa.array(starts, pa.int32()),
                            "end": pa.array(ends, pa.int32()), "surface": pa.array(surfaces, pa.string()), "gender": pa.array(genders, pa.string())}
                )

    return records.select(*keys, F.col(text).alias("_text")).where("_text is not null").mapInArrow(scan, schema)


# --- surrogates ---------------------------------------------------------------------------------

_ONSETS = ("b", "ch", "d", "g", "h", "j", "k", "l", "m", "n", "p", "r", "s", "t", "v", "y")
_VOWELS = ("a", "e", "i", "o", "u")
_HINDI_ONSETS = ("क", "ग", "च", "ज", "ट", "ड", "त", "द", "न", "प", "ब", "म", "य", "र", "ल", "व")
_HINDI_VOWELS = ("", "ा", "ि", "ु", "े")


def _draw(key: bytes, what: str) -> int:
    return int.from_bytes(hmac.new(key, what.encode(), hashlib.sha256).digest(), "big")


def _syllables(n: int, count: int, onsets: tuple[str, ...] = _ONSETS, vowels: tuple[str, ...] = _VOWELS) -> tuple[str, int]:
    out = ""
    for _ in range(count):
        n, a = divmod(n, len(onsets))
        n, b = divmod(n, len(vowels))
        out += onsets[a] + vowels[b]
    return out, n


def canonical(kind: str, value: str) -> str:
    """One form for all ways an item is written: names without initials between, family name last."""
    if kind != "name":
        return value
    if "," in value:
        family, _, given = value.partition(",")
        value = f"{given.strip()} {family.strip()}"
    words = value.split()
    inner = [w for w in words[1:-1] if not (len(w.rstrip(".")) == 1)]
    return " ".join([words[0], *inner, *words[1:][-1:]]) if words else value


def surrogate(key: bytes, kind: str, value: str, gender: str, attempt: int) -> str:
    """The keyed replacement of an item's canonical value: same kind and format, no trace of the value."""
    n = _draw(key, f"{kind}|{value}|{attempt}")
    if kind == "name" and "\u0900" <= value[0] <= "\u097f":
        words = []
        for k in range(min(2, value.count(" ") + 1)):
            word, n = _syllables(n, 3, _HINDI_ONSETS, _HINDI_VOWELS)
            words.append(word + ({"f": "ी", "m": "न"}.get(gender, "र") if k == 0 else "ल"))
        return " ".join(words)
    if kind == "name":
        given, n = _syllables(n, 2)
        given += {"f": "ni", "m": "sh"}.get(gender, "r")
        if len(value.split()[0].rstrip(".")) == 1:
            given = given[0] + "."
        family, n = _syllables(n, 4)
        return f"{given} {family}n" if " " in value else f"{family}n"
    if kind == "email":
        user, n = _syllables(n, 4)
        return f"{user}{n % 10000:04d}@masked.example"
    if kind == "address":
        road, n = _syllables(n, 3)
        return f"No. {n % 989 + 10}, {road.title()} Road {100000 + n // 1000 % 900000}"
    out = []
    for k, c in enumerate(value):
        n, d = divmod(n, 26)
        if c.isdigit():
            out.append(str(d % 9 + 1) if k == 0 else str(d % 10))
        elif len(value) == 10 and k == 3:
            out.append("P")
        else:
            out.append(chr(65 + d))
    return "".join(out)


def render(kind: str, value: str, surface: str, replaced: str) -> str:
    """The placeholder for one mention: its type and the surrogate in the mention's own format."""
    if kind in ("phone", "id"):
        chars, it = [], iter(replaced)
        skip = len([c for c in surface if c.isalnum()]) - len(replaced)
        for c in surface:
            if c.isalnum():
                if skip > 0:  # country code or trunk zero stay
                    skip -= 1
                    chars.append(c)
                else:
                    d = next(it, "")
                    chars.append(d.lower() if c.islower() else d)
            else:
                chars.append(c)
        body = "".join(chars)
    elif kind == "email":
        user, _, domain = replaced.partition("@")
        at = re.search(_AT, surface, re.I)
        dots = re.search(r"\s?[\(\[\{]\s?dot\s?[\)\]\}]\s?", surface, re.I)
        body = user + (at.group(0) if at else "@") + (domain.replace(".", dots.group(0)) if dots else domain)
        body = body.upper() if surface.isupper() else body
    elif kind == "name":
        words = replaced.split()
        if "," in surface and len(words) > 1:
            body = f"{words[-1]}, {' '.join(words[:-1])}"
        else:
            body = replaced
        body = body.upper() if surface.isupper() else body.title()
    else:
        body = replaced
    return f"[{kind.upper()}: {body}]"


def assign_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(scope, kind, canon, gender) with a surrogate each, distinct within a kind of a scope and unlike every real item of the kind.

    Draws again, with the next attempt, for all but the first holder of a
    surrogate (in the order of the items), until no two items of a scope share
    one. Each round works on the losers of the one before, which are few: the
    space of surrogates is wide.
    """
    secret = key.encode()

    @F.pandas_udf("string")
    def draw(scope: pd.Series, kind: pd.Series, canon: pd.Series, gender: pd.Series, attempt: pd.Series) -> pd.Series:
        out = [surrogate(hmac.new(secret, s.encode(), hashlib.sha256).digest(), *row) for s, *row in zip(scope, kind, canon, gender, attempt, strict=True)]
        return pd.Series(out, dtype=object)

    own = ["scope", "kind", "canon"]
    pending, done, attempt = entities.select(*own, F.coalesce("gender", F.lit("")).alias("gender")), None, 0
    real = entities.select("kind", F.col("canon").alias("surrogate")).distinct()
    while True:
        drawn = cut(pending.withColumn("surrogate", draw("scope", "kind", "canon", "gender", F.lit(attempt))), "pii-drawn")
        free = drawn.join(real, ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("scope", "kind", "surrogate"), ["scope", "kind", "surrogate"], "left_anti")
        rank = F.row_number().over(Window.partitionBy("scope", "kind", "surrogate").orderBy("canon"))
        won = cut(free.withColumn("_r", rank).where("_r = 1").drop("_r"), "pii-won")
        done = won if done is None else done.unionByName(won)
        pending = drawn.join(won.select(*own), own, "left_anti").select(*own, "gender")
        if pending.isEmpty():
            return done
        attempt += 1


def replacements(records: DataFrame, keys: list[str], key: str, text: str = "text", scope: str | None = None, document: str | None = None) -> DataFrame:
    """One row for each mention of a personal item: keys, kind, value, start, end and ``put``, the placeholder that replaces it.

    One item has one surrogate in its scope (one scope if none is named), in
    each mention's own format. A name written with an initial takes the
    surrogate of the full name if exactly one full name of its scope and
    document (or of its scope, if no document is named) fits it. Null scopes
    and documents are one each. Repeated records count once.
    """
    # Text does not travel: only its mentions do.
    place = [F.coalesce(F.col(c), F.lit("")).alias(n) if c else F.lit("").alias(n) for c, n in ((scope, "_scope"), (document, "_doc"))]
    found = detect(records.select(*keys, *place, F.col(text).alias("_text")), [*keys, "_scope", "_doc"], "_text")

    @F.pandas_udf("string")
    def canon(kind: pd.Series, value: pd.Series) -> pd.Series:
        return pd.Series([canonical(*row) for row in zip(kind, value, strict=True)], dtype=object)

    found = cut(found.withColumn("canon", canon("kind", "value")), "pii-mentions")
    where = ["_scope", "_doc"]
    # Names with an initial, and the full names of the same place that fit: small tables of names, not of mentions.
    names = found.where("kind = 'name' and canon like '% %'").select(*where, "canon").distinct()
    initial = F.regexp_extract("canon", r"^(\w)\. ", 1)
    short = F.concat(F.substring("canon", 1, 1), F.lit(". "), F.regexp_extract("canon", r"(\S+)$", 1))
    fits = names.where(initial == "").groupBy(*where, short.alias("short")).agg(F.min("canon").alias("full"), F.count(F.lit(1)).alias("n")).where("n = 1")
    same = names.where(initial != "").withColumnRenamed("canon", "short").join(fits, [*where, "short"]).select(*where, F.col("short").alias("canon"), "full")
    found = found.join(same, [*where, "canon"], "left").withColumn("canon", F.coalesce("full", "canon")).drop("full")
    vote = F.sum(F.when(F.col("gender") == "f", 1).when(F.col("gender") == "m", -1).otherwise(0))
    entities = found.groupBy(F.col("_scope").alias("scope"), "kind", "canon").agg(vote.alias("_g"))
    entities = entities.withColumn("gender", F.when(F.col("_g") > 0, "f").when(F.col("_g") < 0, "m").otherwise(""))
    named = assign_surrogates(cut(entities, "pii-entities"), key).select(F.col("scope").alias("_scope"), "kind", "canon", "surrogate")

    @F.pandas_udf("string")
    def show(kind: pd.Series, value: pd.Series, surface: pd.Series, replaced: pd.Series) -> pd.Series:
        return pd.Series([render(*row) for row in zip(kind, value, surface, replaced, strict=True)], dtype=object)

    return found.join(named, ["_scope", "kind", "canon"]).select(*keys, "kind", "value", "start", "end", show("kind", "value", "surface", "surrogate").alias("put")).distinct()


def mask(records: DataFrame, keys: list[str], key: str, text: str = "text", scope: str | None = None, document: str | None = None) -> DataFrame:
    """keys and ``masked_text``: every personal item replaced by ``[TYPE: surrogate]``, as ``replacements`` says.

    Texts without items come out as they are, null texts as null; repeated
    records (same keys and text) once. Texts are shuffled once, to where their
    replacements go.
    """
    rid = F.sha2(F.concat_ws("\x00", *[F.coalesce(F.col(k).cast("string"), F.lit("\x01")) for k in keys], F.coalesce(F.col(text), F.lit("\x01"))), 256)
    more = [c for c in (scope, document) if c]
    base = records.select(*dict.fromkeys([*keys, *more]), F.col(text).alias("_text"), rid.alias("_rid"))
    items = replacements(base, ["_rid"], key, "_text", scope, document)
    lists = items.groupBy("_rid").agg(F.sort_array(F.collect_set(F.struct("start", "end", "put"))).alias("_items"))
    joined = base.select(*keys, "_text", "_rid").dropDuplicates(["_rid"]).join(lists, "_rid", "left")
    # Pieces of the text between the items, by position; no text grows item by item.
    ends = "transform(_items, x -> x.end)"
    built = F.expr(
        "concat(array_join(transform(_items, (x, i) -> concat(substring(_text, if(i = 0, 0, _items[i - 1].end) + 1, x.start - if(i = 0, 0, _items[i - 1].end)), x.put)), ''),"
        f" substring(_text, array_max({ends}) + 1))"
    )
    return joined.select(*keys, F.when(F.col("_items").isNull(), F.col("_text")).otherwise(built).alias("masked_text"))
