"""Readers of document and table formats: bytes to text units and cells. Each returns, none raises."""

from __future__ import annotations

import csv
import email
import email.policy
import io
import json
import re
import zipfile
import zlib
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

from sparkloom.sources.detect import DELIMITERS, decode

csv.field_size_limit(16 * 1024 * 1024)
Unit = tuple[str, str, str]  # unit_type, unit_ref, text
Cell = tuple[str, int, int, str, str]  # table, row, position, text, native kind


class NoReader(Exception):
    """No reader for this format is at hand."""


def normalise(text: str) -> str:
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    text = re.sub(r"[ \t]{2,}", " ", text)
    text = re.sub(r"[ \t]+$", "", text, flags=re.M)
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _part(z: zipfile.ZipFile, name: str) -> ElementTree.Element:
    return ElementTree.fromstring(z.read(name))


def _runs(node: ElementTree.Element) -> str:
    out = []
    for e in node.iter():
        t = _local(e.tag)
        if t == "t":
            out.append(e.text or "")
        elif t in ("tab",):
            out.append("\t")
        elif t in ("br", "cr"):
            out.append("\n")
    return "".join(out)


# --- text ---------------------------------------------------------------------------------------


def read_docx(raw: bytes) -> list[Unit]:
    """Body order kept; a heading starts a unit; tables as piped rows."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        body = next(e for e in _part(z, "word/document.xml") if _local(e.tag) == "body")
    units: list[tuple[str | None, list[str]]] = [(None, [])]
    for e in body:
        kind = _local(e.tag)
        if kind == "p":
            style = next((v for s in e.iter() if _local(s.tag) == "pStyle" for k, v in s.attrib.items() if _local(k) == "val"), "")
            text = _runs(e)
            if re.match(r"^heading\s*\d*$", style, re.I) and text.strip():
                units.append((text.strip(), []))
            elif text.strip():
                units[-1][1].append(text)
        elif kind == "tbl":
            for row in (r for r in e.iter() if _local(r.tag) == "tr"):
                units[-1][1].append(" | ".join(_runs(c).strip() for c in row if _local(c.tag) == "tc"))
    out = []
    for head, lines in units:
        text = normalise("\n".join([head, *lines] if head else lines))
        if text:
            out.append(("heading", f"heading:{head}", text) if head else ("document", "document", text))
    return out


def read_pptx(raw: bytes) -> list[Unit]:
    """Slides in numeric order."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        slides = sorted((int(m.group(1)), n) for n in z.namelist() if (m := re.match(r"^ppt/slides/slide(\d+)\.xml$", n)))
        out = []
        for no, name in slides:
            text = normalise("\n".join(e.text or "" for e in _part(z, name).iter() if _local(e.tag) == "t"))
            if text:
                out.append(("page", f"slide:{no}", text))
    return out


class _Html(HTMLParser):
    SKIP = ("script", "style", "template", "noscript")
    BLOCKS = ("p", "div", "br", "li", "tr", "table", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "header", "footer", "ul", "ol", "title", "pre")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0
        self.tables = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in self.SKIP
        self.tables += tag == "table"
        if tag in self.BLOCKS:
            self.parts.append("\n")
        elif tag in ("td", "th") and self.parts and not self.parts[-1].endswith("\n"):
            self.parts.append(" ")

    def handle_endtag(self, tag):
        if tag in self.SKIP and self.hidden:
            self.hidden -= 1
        if tag in self.BLOCKS:
            self.parts.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def html_text(text: str) -> tuple[str, int]:
    """(text without scripts and styles, number of tables)."""
    p = _Html()
    p.feed(text)
    p.close()
    return normalise("".join(p.parts)), p.tables


def _decoded(raw: bytes) -> str:
    got = decode(raw)
    if got is None:
        raise ValueError("the text cannot be decoded")
    return got[0]


def read_html(raw: bytes) -> list[Unit]:
    text = html_text(_decoded(raw))[0]
    return [("document", "document", text)] if text else []


def read_email(raw: bytes) -> list[Unit]:
    """A unit of headers and one of the body, plain text preferred."""
    m = email.message_from_bytes(raw, policy=email.policy.default)
    head = "\n".join(f"{k}: {m[k]}" for k in ("From", "To", "Cc", "Subject", "Date") if m[k])
    part = m.get_body(preferencelist=("plain", "html"))
    body = ""
    if part is not None:
        body = part.get_content()
        body = html_text(body)[0] if part.get_content_type() == "text/html" else normalise(body)
    return [u for u in (("document", "headers", head), ("document", "body", body)) if u[2].strip()]


_RTF_SKIP = ("fonttbl", "colortbl", "stylesheet", "info", "pict", "object", "header", "footer", "generator", "listtable", "themedata")


def rtf_text(text: str) -> str:
    """Plain text of RTF: groups that hold no text are left out, escapes and line marks resolved."""
    out, stack, skip, uskip, i = [], [], False, 1, 0
    token = re.compile(r"\\([a-z]+)(-?\d+)? ?|\\'([0-9a-f]{2})|\\([^a-z])|([{}])|[\r\n]+|([^\\{}\r\n]+)", re.I)
    while m := token.match(text, i):
        i = m.end()
        word, arg, hexa, sym, brace, plain = m.groups()
        if brace == "{":
            stack.append(skip)
        elif brace == "}":
            skip = stack.pop() if stack else False
        elif word:
            if word in _RTF_SKIP:
                skip = True
            elif skip:
                continue
            elif word in ("par", "line", "row"):
                out.append("\n")
            elif word in ("tab", "cell"):
                out.append("\t")
            elif word == "u" and arg:
                out.append(chr(int(arg) % 65536))
                i += uskip if text[i : i + 1] not in ("\\", "{", "}") else 0
            elif word == "uc" and arg:
                uskip = int(arg)
        elif sym == "*":
            skip = True
        elif skip:
            continue
        elif hexa:
            out.append(bytes.fromhex(hexa).decode("cp1252", "replace"))
        elif sym:
            out.append({"~": "\u00a0", "-": "", "_": "-"}.get(sym, sym))
        elif plain:
            out.append(plain)
    return normalise("".join(out))


def read_rtf(raw: bytes) -> list[Unit]:
    text = rtf_text(raw.decode("latin-1"))
    return [("document", "document", text)] if text else []


def read_plain(raw: bytes) -> list[Unit]:
    text = normalise(_decoded(raw))
    return [("document", "document", text)] if text else []


# --- structured ---------------------------------------------------------------------------------


def xml_value(e: ElementTree.Element):
    """An element as a value: attributes @x, text #text, repeated children as a list, names without namespace."""
    out: dict = {f"@{_local(k)}": v for k, v in e.attrib.items()}
    for c in e:
        if not isinstance(c.tag, str):
            continue
        k, v = _local(c.tag), xml_value(c)
        if k in out:
            out[k] = [*out[k], v] if isinstance(out[k], list) else [out[k], v]
        else:
            out[k] = v
    text = (e.text or "").strip()
    if not out:
        return text
    if text:
        out["#text"] = text
    return out


def parse_xml(raw: bytes):
    """(value, recovered): no entities and no DTD; what XML forbids is taken out and parsing tried again."""
    if re.search(rb"<!(?:DOCTYPE|ENTITY)", raw[:65536], re.I):
        raw = re.sub(rb"<!DOCTYPE[^\[>]*(?:\[.*?\])?[^>]*>", b"", raw, flags=re.I | re.S)
        if re.search(rb"<!ENTITY", raw, re.I):
            raise ValueError("entities are not read")
    try:
        root, recovered = ElementTree.fromstring(raw), False
    except ElementTree.ParseError:
        text = re.sub(r"[^\t\n\r\x20-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]|&#(?:x0*(?:[0-8bcef]|1[0-9a-f])|0*(?:[0-8]|1[124-9]|2\d|3[01]));", "", _decoded(raw))
        text = re.sub(r"&(?!(?:amp|lt|gt|quot|apos|#\d+|#x[0-9a-fA-F]+);)", "&amp;", text)
        root, recovered = ElementTree.fromstring(re.sub(r"^\s*<\?xml[^>]*\?>", "", text)), True
    return {_local(root.tag): xml_value(root)}, recovered


def walk_paths(value, path: str = "") -> Iterator[tuple[str, str]]:
    """(path, text) of each leaf: dotted members and indexes; empty containers are ``(empty)``, null is empty text, booleans lower case."""
    todo = [(path, value)]
    while todo:
        p, v = todo.pop()
        if isinstance(v, dict) and v:
            todo.extend((f"{p}.{k}" if p else str(k), x) for k, x in reversed(list(v.items())))
        elif isinstance(v, list) and v:
            todo.extend((f"{p}.{i}" if p else str(i), x) for i, x in reversed(list(enumerate(v))))
        elif isinstance(v, (dict, list)):
            yield p, "(empty)"
        elif v is None:
            yield p, ""
        elif isinstance(v, bool):
            yield p, str(v).lower()
        else:
            yield p, str(v)


def read_structured(raw: bytes, xml: bool = False) -> list[Unit]:
    value = parse_xml(raw)[0] if xml else json.loads(_decoded(raw))
    tops = value.items() if isinstance(value, dict) else [("", value)]
    out = []
    for k, v in tops:
        text = "\n".join(f"{p}: {t}" for p, t in walk_paths(v, str(k)))
        if text:
            out.append(("field_path", str(k) or "document", text))
    return out


# What makes an array of a structured file a table.
LEAST_ELEMENTS, OBJECT_SHARE, KEY_LIKENESS, KEY_SETS, SCALAR_SHARE, MOST_DEPTH = 3, 0.9, 0.8, 50, 0.7, 2


def _depth(v) -> int:
    """Levels of containers in a value, told without recursion; 0 for a scalar."""
    level, deep = [v], 0
    while level := [x for x in level if isinstance(x, (dict, list))]:
        deep += 1
        level = [y for x in level for y in (x.values() if isinstance(x, dict) else x)]
    return deep


def is_collection(value) -> bool:
    """Whether an array is a table: enough elements, nearly all objects, with much the same members, most of them scalar, nested little."""
    if not isinstance(value, list) or len(value) < LEAST_ELEMENTS:
        return False
    rows = [x for x in value if isinstance(x, dict)]
    if len(rows) < OBJECT_SHARE * len(value):
        return False
    sets = [frozenset(r) for r in rows[:KEY_SETS]]
    pairs = [len(a & b) / max(1, len(a | b)) for i, a in enumerate(sets) for b in sets[i + 1 :]]
    if pairs and sum(pairs) / len(pairs) < KEY_LIKENESS:
        return False
    members = [v for r in rows for v in r.values()]
    if sum(not isinstance(v, (dict, list)) for v in members) < SCALAR_SHARE * len(members):
        return False
    return all(_depth(r) <= MOST_DEPTH for r in rows)


def collections(value) -> Iterator[tuple[str, list[dict]]]:
    """(dotted path, objects) of every array in a value that is a table, outermost first; what lies inside a table is part of its rows."""
    todo = [("", value)]
    while todo:
        path, v = todo.pop()
        if is_collection(v):
            yield path or "records", [x for x in v if isinstance(x, dict)]
        elif isinstance(v, (dict, list)):
            pairs = v.items() if isinstance(v, dict) else enumerate(v)
            todo.extend(reversed([(f"{path}.{k}" if path else str(k), x) for k, x in pairs]))


def read_collections(raw: bytes, xml: bool = False) -> list[Cell]:
    """Cells of the tables in a structured file: a row of names (dotted, as they first occur), then a row for each object."""
    value = parse_xml(raw)[0] if xml else json.loads(_decoded(raw))
    out: list[Cell] = []
    for name, rows in collections(value):
        flat = [flatten_record(r) for r in rows]
        columns = list(dict.fromkeys(k for r in flat for k in r))
        out.extend((name, 0, i, c, "text") for i, c in enumerate(columns))
        out.extend((name, n, i, r.get(c, ""), "text") for n, r in enumerate(flat, 1) for i, c in enumerate(columns))
    return out


def flatten_record(record) -> dict[str, str]:
    """A record's leaves by dotted key; a scalar is ``value``."""
    return dict(walk_paths(record)) if isinstance(record, (dict, list)) else {"value": next(walk_paths(record))[1]}


# --- tables -------------------------------------------------------------------------------------


def find_table_delimiter(text: str) -> str:
    """Over the first 20 lines of 8 KiB: the first delimiter with one consistent width above one, else the one with most columns."""
    sample = [x for x in text[:8192].splitlines()[:20] if x.strip()]
    best, most = ",", 1
    for d in DELIMITERS:
        try:
            widths = [len(r) for r in csv.reader(sample, delimiter=d) if r]
        except csv.Error:
            continue
        if widths and len(set(widths)) == 1 and widths[0] > 1:
            return d
        if widths and max(widths) > most:
            best, most = d, max(widths)
    return best


def read_delimited(raw: bytes, delimiter: str | None = None) -> list[Cell]:
    text = _decoded(raw).lstrip("\ufeff")
    rows = csv.reader(io.StringIO(text, newline=""), delimiter=delimiter or find_table_delimiter(text))
    kept = (r for r in rows if any(c.strip() for c in r))
    return [("table", n, i, c, "text") for n, r in enumerate(kept) for i, c in enumerate(r)]


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]*", ref).group(0):
        n = n * 26 + ord(c) - 64
    return n - 1


# Numbers of the built-in formats for dates and times.
DATE_FORMATS = frozenset((*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)))
_LITERAL = re.compile(r'"[^"]*"|\[[^\]]*\]|\\.|_.|\*.')


def _is_date_format(code: str) -> bool:
    """A number format with letters of dates or times outside its literal parts."""
    return re.search(r"[dmyhs]", _LITERAL.sub("", code.split(";")[0]), re.I) is not None and "general" not in code.lower()


def _date_styles(z: zipfile.ZipFile, names: list[str]) -> set[int]:
    """Numbers of the cell styles whose format is a date or time."""
    if "xl/styles.xml" not in names:
        return set()
    root = _part(z, "xl/styles.xml")
    codes = {int(e.attrib["numFmtId"]): e.attrib.get("formatCode", "") for e in root.iter() if _local(e.tag) == "numFmt"}
    styles = next((e for e in root if _local(e.tag) == "cellXfs"), ())
    ids = [int(e.attrib.get("numFmtId", 0)) for e in styles]
    return {k for k, i in enumerate(ids) if (_is_date_format(codes[i]) if i in codes else i in DATE_FORMATS)}


def serial_date(value: str, epoch_1904: bool = False) -> str | None:
    """A spreadsheet's day number as ISO date, time or both; None for what is no day. The 29th of February 1900, which never was, counts."""
    try:
        days = float(value)
    except ValueError:
        return None
    if not 0 <= days < 2_958_466:
        return None
    if epoch_1904:
        base = datetime(1904, 1, 1)
    else:
        base = datetime(1899, 12, 30) if days >= 60 else datetime(1899, 12, 31)
    at = base + timedelta(seconds=round(days * 86_400))
    if days < 1 and not epoch_1904:
        return at.time().isoformat()
    return at.isoformat() if at.hour or at.minute or at.second else at.date().isoformat()


def read_xlsx(raw: bytes) -> list[Cell]:
    """Stored values of every worksheet; macros are never run. A formula without stored value has kind ``uncached``.

    Kinds: text, number, bool, date (ISO, told from the cell's number format), uncached, empty.
    """
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = z.namelist()
        dates = _date_styles(z, names)
        old_epoch = any(_local(e.tag) == "workbookPr" and e.attrib.get("date1904") in ("1", "true") for e in _part(z, "xl/workbook.xml").iter())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = [_runs(e) for e in _part(z, "xl/sharedStrings.xml") if _local(e.tag) == "si"]
        links = {}
        if "xl/_rels/workbook.xml.rels" in names:
            links = {e.attrib["Id"]: e.attrib["Target"] for e in _part(z, "xl/_rels/workbook.xml.rels")}
        sheets = []
        for e in _part(z, "xl/workbook.xml").iter():
            if _local(e.tag) == "sheet":
                rid = next((v for k, v in e.attrib.items() if _local(k) == "id"), "")
                target = links.get(rid, f"worksheets/sheet{len(sheets) + 1}.xml").lstrip("/")
                sheets.append((e.attrib.get("name", f"sheet{len(sheets) + 1}"), target if target.startswith("xl/") else f"xl/{target}"))
        out: list[Cell] = []
        for name, part in sheets:
            if part not in names:
                continue
            row_no = -1
            for row in (e for e in _part(z, part).iter() if _local(e.tag) == "row"):
                cells = []
                for at, c in enumerate(e for e in row if _local(e.tag) == "c"):
                    kind = c.attrib.get("t", "n")
                    v = next((x.text or "" for x in c if _local(x.tag) == "v"), None)
                    formula = any(_local(x.tag) == "f" for x in c)
                    if kind == "s" and v is not None:
                        text, native = shared[int(v)], "text"
                    elif kind == "inlineStr":
                        text, native = _runs(c), "text"
                    elif kind == "b" and v is not None:
                        text, native = ("TRUE" if v == "1" else "FALSE"), "bool"
                    elif v is None:
                        text, native = "", "uncached" if formula else "empty"
                    elif kind == "d":
                        text, native = v, "date"
                    elif kind == "n" and int(c.attrib.get("s", -1)) in dates and (day := serial_date(v, old_epoch)) is not None:
                        text, native = day, "date"
                    else:
                        text, native = (re.sub(r"\.0+$", "", v), "number") if kind == "n" else (v, "text")
                    cells.append((_column(c.attrib["r"]) if "r" in c.attrib else at, text, native))
                if any(t.strip() for _, t, _ in cells):
                    row_no += 1
                    out.extend((name, row_no, i, t, k) for i, t, k in cells)
        return out


# --- pdf ----------------------------------------------------------------------------------------

_PDF_STRING = re.compile(rb"\((?:[^()\\]|\\.)*\)|<[0-9A-Fa-f\s]*>")
_PDF_SHOW = re.compile(rb"((?:\((?:[^()\\]|\\.)*\)|<[0-9A-Fa-f\s]*>|\[(?:[^\]\\]|\\.)*\]))\s*(Tj|TJ|'|\")|(T\*|\bTd\b|\bTD\b|\bET\b)", re.S)


def _pdf_text(stream: bytes) -> str:
    out = []
    for m in _PDF_SHOW.finditer(stream):
        if m.group(3):
            out.append("\n")
            continue
        for s in _PDF_STRING.findall(m.group(1)):
            if s[:1] == b"<":
                out.append(bytes.fromhex(re.sub(rb"\s", b"", s[1:-1]).decode() + "0" * (len(re.sub(rb"\s", b"", s[1:-1])) % 2)).decode("latin-1"))
            else:
                t = re.sub(rb"\\([nrtbf()\\])", lambda x: {b"n": b"\n", b"r": b"\r", b"t": b"\t"}.get(x.group(1), x.group(1)), s[1:-1])
                out.append(re.sub(rb"\\([0-7]{1,3})", lambda x: bytes([int(x.group(1), 8) & 255]), t).decode("latin-1"))
    return re.sub(r"\n{2,}", "\n", "".join(out)).strip()


def read_pdf(raw: bytes) -> list[tuple[int, int, float, str]]:
    """(page, characters, image share of the page, text) of unencrypted PDFs with plain or Flate streams. Others raise NoReader."""
    if b"/Encrypt" in raw:
        raise NoReader("encrypted")
    objects = {int(m.group(1)): m.group(2) for m in re.finditer(rb"(?:^|\s)(\d+)\s+\d+\s+obj\b(.*?)endobj", raw, re.S)}

    def stream(n: int) -> bytes:
        body = objects.get(n, b"")
        m = re.search(rb"stream\r?\n(.*?)\r?\nendstream", body, re.S)
        if not m:
            return b""
        return zlib.decompress(m.group(1)) if b"/FlateDecode" in body[: m.start()] else m.group(1)

    out = []
    pages = [b for _, b in sorted(objects.items()) if re.search(rb"/Type\s*/Page\b(?!s)", b)]
    for no, body in enumerate(pages, 1):
        refs = re.search(rb"/Contents\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", body)
        data = b"\n".join(stream(int(x)) for x in re.findall(rb"(\d+)\s+\d+\s+R", refs.group(1))) if refs else b""
        box = re.search(rb"/MediaBox\s*\[\s*([\d.\s-]+)\]", body) or re.search(rb"/MediaBox\s*\[\s*([\d.\s-]+)\]", raw)
        x0, y0, x1, y1 = (float(v) for v in box.group(1).split()[:4]) if box else (0, 0, 612, 792)
        area = max((x1 - x0) * (y1 - y0), 1e-9)
        images = sum(abs(float(m.group(1)) * float(m.group(2))) for m in re.finditer(rb"([\d.]+)\s+0\s+0\s+([\d.]+)\s+[\d.-]+\s+[\d.-]+\s+cm\s+/\w+\s+Do", data))
        text = _pdf_text(data)
        out.append((no, len(text), min(images / area, 1.0), text))
    if not out:
        raise NoReader("no pages found")
    return out


# --- Spark forms --------------------------------------------------------------------------------

READERS: dict[str, Callable[[bytes], list[Unit]]] = {
    "word_ooxml": read_docx, "presentation_ooxml": read_pptx, "html": read_html, "email": read_email, "rtf": read_rtf, "plain_text": read_plain,
    "json": read_structured, "xml": lambda raw: read_structured(raw, xml=True),
}
TABLE_READERS: dict[str, Callable[[bytes], list[Cell]]] = {"delimited_text": read_delimited, "spreadsheet_ooxml": read_xlsx, "json": read_collections, "xml": lambda raw: read_collections(raw, xml=True)}


def _guarded(work: Callable[[], list]) -> tuple[list, str | None, str | None]:
    """(rows, error category, message): one bad file is one failed row."""
    try:
        return work(), None, None
    except NoReader as e:
        return [], "NO_COMPATIBLE_READER", str(e)
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, ValueError, StopIteration, zlib.error, EOFError) as e:
        return [], "CORRUPT_FILE", str(e)[:500]
    except Exception as e:  # noqa: BLE001 - the boundary of one unit of work
        return [], "UNEXPECTED_EXCEPTION", f"{type(e).__name__}: {e}"[:500]


UNITS = "path string, unit_type string, unit_ref string, sequence int, text string, error_category string, error_message string"


def read_units(files: DataFrame) -> DataFrame:
    """Text units of files (path, family, content). A file that cannot be read gives one row with its error; one without text gives none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, family, raw in zip(b["path"], b["family"], b["content"], strict=True):
                reader = READERS.get(family)
                units, cat, msg = ([], "NO_COMPATIBLE_READER", str(family)) if reader is None else _guarded(lambda r=reader, x=raw: r(bytes(x or b"")))
                rows.extend((path, k, ref, n, t, None, None) for n, (k, ref, t) in enumerate(units))
                if cat:
                    rows.append((path, None, None, None, None, cat, msg))
            df = pd.DataFrame(rows, columns=[x.split()[0] for x in UNITS.split(", ")])
            df["sequence"] = df["sequence"].astype("Int32")
            yield df

    return files.select("path", "family", "content").mapInPandas(run, UNITS)


CELLS = "path string, table_name string, row_no bigint, position int, text string, native_kind string, error_category string, error_message string"


def read_cells(files: DataFrame) -> DataFrame:
    """Cells of table files (path, family, content), all in one long table; rows of nothing but blanks are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, family, raw in zip(b["path"], b["family"], b["content"], strict=True):
                reader = TABLE_READERS.get(family)
                cells, cat, msg = ([], "NO_COMPATIBLE_READER", str(family)) if reader is None else _guarded(lambda r=reader, x=raw: r(bytes(x or b"")))
                rows.extend((path, *c, None, None) for c in cells)
                if cat:
                    rows.append((path, None, None, None, None, None, cat, msg))
            df = pd.DataFrame(rows, columns=[x.split()[0] for x in CELLS.split(", ")])
            df["row_no"], df["position"] = df["row_no"].astype("Int64"), df["position"].astype("Int32")
            yield df

    return files.select("path", "family", "content").mapInPandas(run, CELLS)


PAGES = "path string, number int, character_count int, image_coverage double, text string, error_category string, error_message string"


def read_pages(files: DataFrame) -> DataFrame:
    """Pages of PDF files (path, content)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, raw in zip(b["path"], b["content"], strict=True):
                pages, cat, msg = _guarded(lambda x=raw: read_pdf(bytes(x or b"")))
                rows.extend((path, *p, None, None) for p in pages)
                if cat:
                    rows.append((path, None, None, None, None, cat, msg))
            df = pd.DataFrame(rows, columns=[x.split()[0] for x in PAGES.split(", ")])
            df["number"], df["character_count"] = df["number"].astype("Int32"), df["character_count"].astype("Int32")
            yield df

    return files.select("path", "content").mapInPandas(run, PAGES)
