"""Queries of the format readers: files are made from table rows inside the query, then detected and read back."""

from __future__ import annotations

import gzip
import io
import zipfile
from collections.abc import Callable, Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.common import load, local_path, work_path
from sparkloom.plans import format_sql
from sparkloom.sources import archives, corpus, detect, readers

QUERIES: dict = {}
ORACLES: dict[str, str] = dict(format_sql.UNITS)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- builders of genuine bytes ------------------------------------------------------------------


def zipped(members: dict[str, bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def make_docx(text: str) -> bytes:
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    rows = []
    for line in clean(text).split("\n"):
        style = '<w:pPr><w:pStyle w:val="Heading1"/></w:pPr>' if line.startswith("## ") else ""
        rows.append(f'<w:p>{style}<w:r><w:t xml:space="preserve">{escape(line)}</w:t></w:r></w:p>')
    return zipped({"[Content_Types].xml": b"<Types/>", "word/document.xml": f"<w:document {w}><w:body>{''.join(rows)}</w:body></w:document>".encode()})


def make_pptx(text: str) -> bytes:
    a = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'
    slides = [p for p in clean(text).split("\n\n") if p.strip()]
    parts = {f"ppt/slides/slide{i}.xml": f"<s {a}>{''.join(f'<a:t>{escape(x)}</a:t>' for x in p.split(chr(10)))}</s>".encode() for i, p in enumerate(slides, 1)}
    return zipped({"ppt/presentation.xml": b"<p/>"} | parts)


def make_html(text: str) -> bytes:
    body = "".join(f"<p>{escape(x)}</p>" for x in clean(text).split("\n"))
    return f"<!DOCTYPE html><html><head><style>p {{}}</style><script>var x = 1;</script></head><body>{body}<table><tr><td>a</td></tr></table></body></html>".encode()


def make_email(text: str) -> bytes:
    return ("From: a@office.example\nTo: b@office.example\nSubject: Papers\nMIME-Version: 1.0\nContent-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\n" + clean(text)).encode()


def make_rtf(text: str) -> bytes:
    out = "".join(c if ord(c) < 128 and c not in "\\{}\n" else "\\par\n" if c == "\n" else f"\\{c}" if c in "\\{}" else "".join(f"\\u{u if u < 32768 else u - 65536}?" for u in _utf16(c)) for c in clean(text))
    return ("{\\rtf1\\ansi{\\fonttbl{\\f0 Arial;}}\\f0 " + out + "}").encode()


def _utf16(c: str) -> list[int]:
    raw = c.encode("utf-16-le")
    return [int.from_bytes(raw[i : i + 2], "little") for i in range(0, len(raw), 2)]


def make_pdf(text: str) -> bytes:
    lines = [x.encode("latin-1", "replace").replace(b"\\", b"\\\\").replace(b"(", b"\\(").replace(b")", b"\\)") for x in clean(text).split("\n")]
    data = b"BT /F1 10 Tf " + b" T* ".join(b"(" + x + b") Tj" for x in lines) + b" ET"
    return (b"%PDF-1.4\n1 0 obj << /Type /Page /MediaBox [0 0 612 792] /Contents 2 0 R >> endobj\n2 0 obj << /Length " + str(len(data)).encode() + b" >> stream\n" + data + b"\nendstream endobj\n%%EOF")


def make_xlsx(rows: list[list[str]]) -> bytes:
    cells = "".join("<row>" + "".join(f'<c t="inlineStr"><is><t>{escape(clean(v))}</t></is></c>' for v in r) + "</row>" for r in rows)
    return zipped({
        "xl/workbook.xml": b'<workbook xmlns:r="r"><sheets><sheet name="Sheet1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": b'<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f"<worksheet><sheetData>{cells}</sheetData></worksheet>".encode(),
    })


def clean(text: str) -> str:
    """What XML can hold."""
    return "".join(c for c in text if c in "\t\n" or 32 <= ord(c) < 0xD800 or 0xE000 <= ord(c) < 0xFFFE or ord(c) > 0xFFFF)


def _files(docs: DataFrame, suffix: str, make: Callable[[str], bytes]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": [f"{i}{suffix}" for i in b["doc_id"]], "content": [make(t) for t in b["text"]]})

    return docs.where("text is not null").select("doc_id", "text").mapInPandas(run, "path string, content binary")


def _units(spark: SparkSession, d: str, suffix: str, make, family: str) -> DataFrame:
    f = _files(load(spark, d, "documents"), suffix, make).withColumn("family", F.lit(family))
    u = readers.read_units(f)
    return u.select("path", "unit_type", "unit_ref", "sequence", F.sha2("text", 256).alias("sha"), F.length("text").alias("chars"), "error_category")


@query()
def docx_units(spark, d):
    return _units(spark, d, ".docx", make_docx, "word_ooxml")


@query()
def pptx_units(spark, d):
    return _units(spark, d, ".pptx", make_pptx, "presentation_ooxml")


@query()
def html_text(spark, d):
    return _units(spark, d, ".html", make_html, "html")


@query()
def email_units(spark, d):
    return _units(spark, d, ".eml", make_email, "email")


@query()
def rtf_units(spark, d):
    return _units(spark, d, ".rtf", make_rtf, "rtf")


@query()
def plain_units(spark, d):
    return _units(spark, d, ".txt", lambda t: t.encode(), "plain_text")


@query()
def pdf_pages(spark, d):
    p = readers.read_pages(_files(load(spark, d, "documents"), ".pdf", make_pdf))
    return p.select("path", "number", "character_count", F.sha2("text", 256).alias("sha"), "image_coverage", "error_category")


_KINDS = ((".docx", make_docx), (".pptx", make_pptx), (".html", make_html), (".eml", make_email), (".rtf", make_rtf), (".txt", lambda t: t.encode()), (".pdf", make_pdf), (".gz", lambda t: gzip.compress(t.encode(), mtime=0)), (".png", lambda t: b"\x89PNG\r\n\x1a\n" + t.encode()))


_BY_TURNS = ("word_ooxml", "presentation_ooxml", "html", "email", "rtf", "", "pdf", "archive_gzip", "image")
_TOLD = ("container", "container", "text", "text", "signature", "text", "signature", "signature", "signature")
_SUBTYPES = ("docx", "pptx", None, None, "rtf", "", "pdf", "gzip", "png")
_EXPECTED = ("'.docx'", "'.pptx'", "'.html'", "'.eml'", "'.rtf'", "", "'.pdf'", "'.gz'", "'.png'")


def _case(values, quote=True) -> str:
    return "CASE doc_id % 9 " + " ".join(f"WHEN {k} THEN " + ("NULL" if v is None else f"'{v}'" if quote else v) for k, v in enumerate(values) if v != "") + " END"


@query(rf"""
WITH t AS (SELECT doc_id, text, regexp_replace(text, '^[\x{{feff}} \t\r\n]+', '') AS s FROM documents WHERE text IS NOT NULL),
l AS (SELECT *, lower(substr(s, 1, 512)) AS head, list_filter(regexp_split_to_array(s, '\r\n|\r|\n')[1:8], lambda x: trim(x, ' ') <> '') AS ls FROM t),
d AS (SELECT *, list_filter([',', ';', chr(9), '|'], lambda c: len(ls) >= 2 AND list_min(list_transform(ls, lambda x: length(x) - length(replace(x, c, '')))) >= 1
             AND list_min(list_transform(ls, lambda x: length(x) - length(replace(x, c, '')))) = list_max(list_transform(ls, lambda x: length(x) - length(replace(x, c, ''))))) AS ds FROM l),
p AS (SELECT *, CASE WHEN text = '' THEN 'empty' WHEN s = '' THEN 'plain_text' WHEN regexp_matches(s, '^[{{\[]') AND json_valid(s) THEN 'json'
        WHEN starts_with(s, '<') THEN CASE WHEN starts_with(head, '<!doctype html') OR contains(head, '<html') THEN 'html' ELSE 'xml' END
        WHEN regexp_matches(head, '^(from|received|return-path|message-id):') THEN 'email' WHEN len(ds) > 0 THEN 'delimited_text' ELSE 'plain_text' END AS own FROM d),
f AS (SELECT *, CASE WHEN doc_id % 9 = 5 THEN own ELSE {_case(_BY_TURNS)} END AS family FROM p)
SELECT doc_id || CASE WHEN doc_id % 10 = 0 THEN '.pdf' WHEN doc_id % 9 = 5 THEN '.txt' ELSE {_case(_EXPECTED, False)} END AS path, family,
       CASE WHEN family = 'empty' THEN 'signature' ELSE {_case(_TOLD)} END AS confidence,
       CASE WHEN doc_id % 9 <> 5 THEN {_case(_SUBTYPES)} WHEN family = 'delimited_text' THEN 'delimiter=' || chr(39) || replace(ds[1], chr(9), chr(92) || 't') || chr(39) END AS subtype,
       CASE WHEN doc_id % 10 = 0 THEN family NOT IN ('pdf', 'plain_text', 'delimited_text', 'empty') ELSE doc_id % 9 = 5 AND family IN ('json', 'html', 'xml', 'email') END AS extension_conflict,
       CASE WHEN doc_id % 9 IN (2, 3) OR doc_id % 9 = 5 AND family <> 'empty' THEN 'utf-8' END AS encoding
FROM f
""")
def format_detect(spark, d):
    """Documents written in nine formats by turns, every tenth under a wrong extension, then detected."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            paths, raw = [], []
            for i, t in zip(b["doc_id"], b["text"], strict=True):
                suffix, make = _KINDS[i % len(_KINDS)]
                paths.append(f"{i}{'.pdf' if i % 10 == 0 else suffix}")
                raw.append(make(t))
            yield pd.DataFrame({"path": paths, "content": raw})

    f = load(spark, d, "documents").where("text is not null").select("doc_id", "text").mapInPandas(run, "path string, content binary")
    return detect.detect_files(f).select("path", "family", "confidence", "subtype", "extension_conflict", "encoding")


@query("SELECT CAST(doc_id AS VARCHAR) || '.zip' AS path, doc_id || '/note.txt' AS member_path, CAST(1 AS INTEGER) AS depth, octet_length(encode(text)) AS bytes, sha256(text) AS content_sha256 FROM documents WHERE text IS NOT NULL")
def archive_members(spark, d):
    f = load(spark, d, "documents").where("text is not null")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            raw = [zipped({f"{i}/note.txt": t.encode(), "../evil.txt": b"x"}) for i, t in zip(b["doc_id"], b["text"], strict=True)]
            yield pd.DataFrame({"path": [f"{i}.zip" for i in b["doc_id"]], "content": raw})

    m = archives.archive_members(f.select("doc_id", "text").mapInPandas(run, "path string, content binary"))
    return m.where("failure is null").select("path", "member_path", "depth", "bytes", "content_sha256")


_REGISTER = """
WITH r AS (SELECT table_id, row_no, any_value(payload) AS payload FROM raw_register GROUP BY 1, 2),
c AS (SELECT r.table_id, r.row_no, j.id AS position, j.value ->> '$' AS v FROM r, json_each(r.payload) j WHERE r.payload IS NOT NULL)
SELECT table_id || '{suffix}' AS path, count(*) AS n_cells, sha256(string_agg(coalesce(v, '-'), chr(10) ORDER BY row_no, position)) AS sha FROM c GROUP BY 1
"""


def _contents(cells: DataFrame) -> DataFrame:
    """Number of cells of each file and the hash of their texts, row by row."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("row_no", "position", "text"))), lambda x: x["text"])
    return cells.groupBy("path").agg(F.count("text").alias("n_cells"), F.sha2(F.array_join(ordered, "\n"), 256).alias("sha"))


def _register_rows(spark, d) -> DataFrame:
    r = load(spark, d, "raw_register").dropDuplicates(["table_id", "row_no"])
    cells = F.from_json("payload", "map<string,string>")
    return r.groupBy("table_id").agg(F.sort_array(F.collect_list(F.struct("row_no", F.transform(F.map_values(cells), lambda x: F.coalesce(x, F.lit("-"))).alias("v")))).alias("rows"))


def _tables(spark, d, suffix: str, make) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": [f"{t}{suffix}" for t in b["table_id"]], "content": [make([list(r["v"]) for r in rows]) for rows in b["rows"]]})

    return _register_rows(spark, d).mapInPandas(run, "path string, content binary")


def make_csv(rows: list[list[str]]) -> bytes:
    import csv

    out = io.StringIO()
    csv.writer(out).writerows(rows)
    return out.getvalue().encode()


@query(_REGISTER.replace("{suffix}", ".csv"))
def csv_rows(spark, d):
    f = _tables(spark, d, ".csv", make_csv).withColumn("family", F.lit("delimited_text"))
    return _contents(readers.read_cells(f))


@query(_REGISTER.replace("{suffix}", ".xlsx"))
def xlsx_cells(spark, d):
    f = _tables(spark, d, ".xlsx", make_xlsx).withColumn("family", F.lit("spreadsheet_ooxml"))
    return _contents(readers.read_cells(f))


@query("""
WITH RECURSIVE f AS (SELECT return_id, any_value(payload) AS payload FROM raw_returns GROUP BY 1),
ok AS (SELECT return_id, CAST(payload AS JSON) AS v FROM f WHERE payload IS NOT NULL AND json_valid(payload)),
n AS (
  SELECT return_id, CAST(j.key AS VARCHAR) AS top, j.id AS pos, CAST(j.key AS VARCHAR) AS path, j.value AS v FROM ok, json_each(ok.v) j
  UNION ALL
  SELECT n.return_id, n.top, n.pos, n.path || '.' || j.key, j.value FROM n, json_each(n.v) j WHERE json_type(n.v) IN ('OBJECT', 'ARRAY')
),
leaves AS (SELECT *, CASE WHEN json_type(v) IN ('OBJECT', 'ARRAY') THEN '(empty)' WHEN json_type(v) = 'NULL' THEN '' WHEN json_type(v) = 'DOUBLE' THEN CAST(CAST(v ->> '$' AS DOUBLE) AS VARCHAR) ELSE v ->> '$' END AS t
           FROM n WHERE NOT (json_type(v) = 'OBJECT' AND len(json_keys(v)) > 0) AND NOT (json_type(v) = 'ARRAY' AND json_array_length(v) > 0)),
units AS (SELECT return_id, top, pos, sum(length(path) + 2 + length(t)) + count(*) - 1 AS chars FROM leaves GROUP BY 1, 2, 3)
SELECT return_id || '.json' AS path, 'field_path' AS unit_type, top AS unit_ref, CAST(row_number() OVER (PARTITION BY return_id ORDER BY pos) - 1 AS INTEGER) AS sequence, CAST(chars AS INTEGER) AS chars, NULL AS error_category FROM units
UNION ALL SELECT return_id || '.json', NULL, NULL, NULL, NULL, 'CORRUPT_FILE' FROM f WHERE payload IS NULL OR NOT json_valid(payload)
""")
def json_units(spark, d):
    r = load(spark, d, "raw_returns").dropDuplicates(["return_id"])
    f = r.select(F.concat(F.col("return_id").cast("string"), F.lit(".json")).alias("path"), F.lit("json").alias("family"), F.col("payload").cast("binary").alias("content"))
    u = readers.read_units(f)
    return u.select("path", "unit_type", "unit_ref", "sequence", F.length("text").alias("chars"), "error_category")


@query("""
SELECT s_suppkey || '.xml' AS path, unnest(['supplier.@key: ' || s_suppkey, 'supplier.name: ' || s_name, 'supplier.acct: ' || CAST(s_acctbal AS VARCHAR)]) AS line FROM supplier
""")
def xml_paths(spark, d):
    s = load(spark, d, "supplier")
    xml = F.format_string('<supplier key="%d"><name>%s</name><acct>%s</acct></supplier>', "s_suppkey", "s_name", F.col("s_acctbal").cast("string"))
    f = s.select(F.concat(F.col("s_suppkey").cast("string"), F.lit(".xml")).alias("path"), F.lit("xml").alias("family"), xml.cast("binary").alias("content"))
    return readers.read_units(f).select("path", F.explode(F.split("text", "\n")).alias("line"))


@query()
def flatten_records(spark, d):
    """The delivered rows' leaves by dotted key."""
    r = load(spark, d, "raw_register").dropDuplicates(["table_id", "row_no"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        for b in batches:
            rows = [(t, n, k, v) for t, n, p in zip(b["table_id"], b["row_no"], b["payload"], strict=True) for k, v in readers.flatten_record(json.loads(p)).items()]
            yield pd.DataFrame(rows, columns=["table_id", "row_no", "key", "value"])

    return r.where("payload is not null").select("table_id", "row_no", "payload").mapInPandas(run, "table_id bigint, row_no bigint, key string, value string")


@query("SELECT CAST(25 AS BIGINT) AS n_files, CAST(sum(octet_length(encode(n_name))) AS BIGINT) AS n_bytes FROM nation")
def corpus_scan(spark, d):
    """A small tree written to the shared folder, one file per nation (hidden and extensionless names among them), then walked."""
    import os

    root = local_path(work_path(spark, "corpus"))
    for r in load(spark, d, "nation").collect():  # a fixed table of 25 rows
        folder = os.path.join(root, f"region{r.n_regionkey}", "files")
        os.makedirs(folder, exist_ok=True)
        name = f".{r.n_nationkey}" if r.n_nationkey % 5 == 0 else f"{r.n_nationkey}" if r.n_nationkey % 5 == 1 else f"{r.n_nationkey}.txt"
        with open(os.path.join(folder, name), "wb") as f:
            f.write(r.n_name.encode())
    return corpus.corpus_files(spark, root).agg(F.count(F.lit(1)).alias("n_files"), F.sum("size_bytes").alias("n_bytes"))
