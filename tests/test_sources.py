"""Readers and detection over genuine bytes made here."""

import gzip
import io
import struct
import zipfile

from sparkloom.plans import formats as mk
from sparkloom.sources import archives, corpus, detect, readers

TEXT = "First line & more\nSecond <line>\n\nThird \u0939\u093f \u20b9 (x)"


def test_detection():
    cases = {
        "a.docx": (mk.make_docx(TEXT), "word_ooxml"), "a.pptx": (mk.make_pptx(TEXT), "presentation_ooxml"), "a.xlsx": (mk.make_xlsx([["a"]]), "spreadsheet_ooxml"),
        "a.html": (mk.make_html(TEXT), "html"), "a.eml": (mk.make_email(TEXT), "email"), "a.rtf": (mk.make_rtf(TEXT), "rtf"), "a.pdf": (mk.make_pdf("x"), "pdf"),
        "a.csv": (b"a,b\n1,2\n", "delimited_text"), "a.txt": (b"just words", "plain_text"), "a.json": (b'{"a": [1]}', "json"), "a.xml": (b"<r/>", "xml"),
        "a.gz": (gzip.compress(b"x"), "archive_gzip"), "a.zip": (mk.zipped({"x": b"1"}), "archive_zip"), "a.7z": (b"7z\xbc\xaf\x27\x1c00", "archive_7z"),
        "Thumbs.db": (b"zz", "non_data_artifact"), "~$a.xlsx": (b"", "non_data_artifact"), "a.exe": (b"MZ", "executable"), "empty.txt": (b"", "empty"),
        "a.bin": (bytes(range(32)) * 9, "unknown"), "a.tsf": (bytes(range(32)) * 9, "tally_binary"), "b.bmp": (b"BM" + struct.pack("<III", 20, 0, 14) + b"\0" * 6, "image"),
    }
    for name, (raw, family) in cases.items():
        assert detect.detect(name, raw).family == family, name
    assert detect.detect("a.pdf", mk.make_docx(TEXT)).conflict and not detect.detect("a.docx", mk.make_docx(TEXT)).conflict


def test_text_round_trips():
    assert readers.read_docx(mk.make_docx("intro\n## Head\nbody"))[1] == ("heading", "heading:## Head", "## Head\nbody")
    assert [u[1] for u in readers.read_pptx(mk.make_pptx("\n\n".join("abcdefghijkl")))] == [f"slide:{i}" for i in range(1, 13)]
    assert readers.read_html(mk.make_html("one\ntwo"))[0][2] == "one\n\ntwo\n\na"
    assert readers.read_email(mk.make_email("body"))[1][2] == "body"
    assert readers.read_rtf(mk.make_rtf(TEXT))[0][2] == TEXT
    assert readers.read_pdf(mk.make_pdf("ab (c)\nd"))[0][3] == "ab (c)\nd"
    assert readers.read_plain("d\u00e9j\u00e0 vu, d\u00e9j\u00e0 lu".encode("cp1252"))[0][2].startswith("d")


def test_tables():
    assert [c[3] for c in readers.read_delimited(b'a;"b\nc"\n;\n1;2\n')] == ["a", "b\nc", "1", "2"]
    assert [(c[1], c[2], c[3]) for c in readers.read_xlsx(mk.make_xlsx([["0012", "x"], ["", ""], ["3", "y"]]))] == [(0, 0, "0012"), (0, 1, "x"), (1, 0, "3"), (1, 1, "y")]


def test_structured():
    assert list(readers.walk_paths({"a": [{"b": True}, []], "c": None})) == [("a.0.b", "true"), ("a.1", "(empty)"), ("c", "")]
    assert readers.parse_xml(b"<r a='1'><x>1</x><x>2</x>t</r>")[0] == {"r": {"@a": "1", "x": ["1", "2"]}}
    value, recovered = readers.parse_xml(b"<r>a & b\x01</r>")
    assert recovered and value == {"r": "a & b"}


def test_archives():
    nested = mk.zipped({"in.zip": mk.zipped({"in2.zip": mk.zipped({"in3.zip": mk.zipped({"deep.txt": b"x"})})}), "../evil": b"x", "ok.txt": b"ok"})
    f = archives.expand(nested)
    assert [m[0] for m in f.members] == ["in.zip", "in.zip!in2.zip", "in.zip!in2.zip!in3.zip", "ok.txt"]
    assert {x[2] for x in f.failures} == {"UNSAFE_MEMBER_PATH", "ARCHIVE_DEPTH_LIMIT_EXCEEDED"}
    bomb = mk.zipped({"z": b"\0" * 3_000_000, "ok": b"1"})
    assert [x[2] for x in archives.expand(bomb).failures] == ["ARCHIVE_SIZE_LIMIT_EXCEEDED"]
    assert [x[2] for x in archives.expand(bomb, archives.Limits(members=1, ratio=1e9)).failures] == ["ARCHIVE_MEMBER_LIMIT_EXCEEDED"]
    assert [x[2] for x in archives.expand(b"PK\x03\x04broken").failures] == ["CORRUPT_FILE"]
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("a", b"1")
    locked = bytearray(raw.getvalue())
    locked[locked.find(b"PK\x01\x02") + 8] |= 1
    assert archives.expand(bytes(locked)).failures[0][2] == "ARCHIVE_MEMBER_LOCKED"


def test_one_bad_file_is_one_row(spark):
    df = spark.createDataFrame([("a.docx", "word_ooxml", bytearray(b"PK")), ("b.txt", "plain_text", bytearray(b"hi")), ("c.doc", "word_ole", bytearray(b"x")), ("d.txt", "plain_text", None)], "path string, family string, content binary")
    got = {(r.path, r.text, r.error_category) for r in readers.read_units(df).collect()}
    assert got == {("a.docx", None, "CORRUPT_FILE"), ("b.txt", "hi", None), ("c.doc", None, "NO_COMPATIBLE_READER")}


def test_corpus_walk(spark, tmp_path):
    for p in ("A/.hidden", "A/B/none", "A/B/empty.txt", "top.txt"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_bytes(b"" if "empty" in p else b"x")
    (tmp_path / "A/link").symlink_to(tmp_path / "top.txt")
    files = corpus.corpus_files(spark, str(tmp_path))
    assert {r.relative_path for r in files.collect()} == {"A/.hidden", "A/B/none", "A/B/empty.txt", "top.txt"}
    assert corpus.with_content(files, str(tmp_path)).count() == 4


def ole(names, sector=512):
    """A compound file whose directory holds the names."""
    entries = b""
    for i, n in enumerate(["Root Entry", *names]):
        raw = n.encode("utf-16-le") + b"\0\0"
        entries += raw.ljust(64, b"\0") + struct.pack("<HB", len(raw), 5 if i == 0 else 2) + b"\0" * 61
    entries = entries.ljust(-(-len(entries) // sector) * sector, b"\0")
    n = len(entries) // sector
    table = [0xFFFFFFFD] + [k + 2 for k in range(n - 1)] + [0xFFFFFFFE]
    header = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + b"\0" * 16 + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + b"\0" * 10
    header += struct.pack("<II", 1, 1) + b"\0" * 24 + struct.pack("<109I", 0, *[0xFFFFFFFF] * 108)
    return header + struct.pack(f"<{sector // 4}I", *table, *[0xFFFFFFFF] * (sector // 4 - len(table))) + entries


def test_compound_files():
    many = [f"Stream{i}" for i in range(9)]
    cases = {"EncryptedPackage": "encrypted_ooxml", "Workbook": "spreadsheet_biff", "Book": "spreadsheet_biff", "WordDocument": "word_ole", "Catalog": "non_data_artifact", "EncryptionInfo": "encrypted_ole", "Else": "unknown"}
    for name, family in cases.items():
        assert detect.detect("x.doc", ole([*many, name])).family == family, name
    assert detect.detect("x.doc", ole(["Workbook"])[:600]).family == "unknown" and detect.detect("x.doc", ole(["Workbook"])[:40]).family == "unknown"


def test_text_forms():
    long = '{"a": [' + ", ".join(f'"item {i}"' for i in range(9000)) + "]}"
    cases = [
        (long.encode(), "json"), (b'{"a": 1, }', "plain_text"), (b"[not json", "plain_text"), ("﻿<html>".encode(), "html"), (b"  <!DOCTYPE html><p>", "html"), (b"<a><html/></a>", "html"),
        ("Received: x\nwords".encode(), "email"), ("wide text, two bytes a character".encode("utf-16-le"), "plain_text"), ("wide".encode("utf-16"), "plain_text"), (b"a;b\n1;2\n\n3;4", "delimited_text"),
        (b"a,b\n1,2,3", "plain_text"), (b"one line, only", "plain_text"), (b"a\0b\0\0\x01\x02" * 50, "unknown"), ("déjà vu ".encode("cp1252") * 9, "plain_text"), (b"x" * 65_535 + "₹".encode(), "plain_text"),
    ]
    for raw, family in cases:
        assert detect.detect("f", raw).family == family, (raw[:30], family)
    assert detect.detect("f.csv", b"a;b\n1;2").subtype == "delimiter=';'"


def test_large_and_lost_files(spark, tmp_path):
    for name, raw in {"A/big.txt": b"words of a text " * 100, "A/big.docx": mk.make_docx(TEXT * 30), "A/gone.txt": b"x", "A/ok.txt": b"ok"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(raw)
    files = spark.createDataFrame(corpus.corpus_files(spark, str(tmp_path)).collect(), corpus.FILES)
    (tmp_path / "A/gone.txt").unlink()
    content = corpus.with_content(files, str(tmp_path), limit=500)
    rows = {r.path: r for r in content.collect()}
    assert rows["A/gone.txt"].failure.startswith("FILE_ACCESS_ERROR") and rows["A/big.txt"].content is None and len(rows["A/big.txt"].content_sha256) == 64 and bytes(rows["A/ok.txt"].content) == b"ok"
    found = {r.path: r.family for r in detect.detect_files(content.where("failure is null"), location="location").collect()}
    assert found == {"A/big.txt": "plain_text", "A/big.docx": "word_ooxml", "A/ok.txt": "plain_text"}


def dated_xlsx(cells, codes=("General", "dd/mm/yyyy", "0.00", '"day" 0', "[h]:mm"), extra=b""):
    """A workbook of one row; cells are (style, value)."""
    fmts = "".join(f'<numFmt numFmtId="{164 + k}" formatCode="{c.replace(chr(34), "&quot;")}"/>' for k, c in enumerate(codes))
    xfs = "".join(f'<xf numFmtId="{164 + k}"/>' for k in range(len(codes))) + '<xf numFmtId="14"/>'
    row = "".join(f'<c s="{s}"><v>{v}</v></c>' for s, v in cells)
    return mk.zipped({
        "xl/workbook.xml": b"<workbook>" + extra + b'<sheets><sheet name="S"/></sheets></workbook>', "xl/styles.xml": f"<styleSheet><numFmts>{fmts}</numFmts><cellXfs>{xfs}</cellXfs></styleSheet>".encode(),
        "xl/worksheets/sheet1.xml": f"<worksheet><sheetData><row>{row}</row></sheetData></worksheet>".encode(),
    })


def test_spreadsheet_dates():
    got = [(c[3], c[4]) for c in readers.read_xlsx(dated_xlsx([(0, "45292"), (1, "45292"), (2, "45292.5"), (3, "3"), (4, "0.25"), (5, "45292.75"), (1, "60"), (1, "59"), (1, "text"), (1, "-1")]))]
    assert got == [
        ("45292", "number"), ("2024-01-01", "date"), ("45292.5", "number"), ("3", "number"), ("06:00:00", "date"), ("2024-01-01T18:00:00", "date"), ("1900-02-28", "date"), ("1900-02-28", "date"), ("text", "number"), ("-1", "number"),
    ]
    assert readers.read_xlsx(dated_xlsx([(1, "43830")], extra=b'<workbookPr date1904="1"/>'))[0][3] == "2024-01-01"


def test_collections_become_tables():
    row = lambda i, **more: {"id": i, "name": f"n{i}"} | more
    value = {"meta": {"n": 1}, "items": [row(1), row(2), row(3, extra={"deep": 1}), row(4)], "few": [row(1), row(2)], "mixed": [row(1), 2, 3, 4], "unlike": [{"a": 1}, {"b": 1}, {"c": 1}],
             "nested": [{"a": {"b": {"c": 1}}, "x": 1, "y": 1, "z": 1}] * 3, "boxes": [{"a": [1], "b": [2]}] * 3, "in": [[row(1), row(2), row(3)]]}
    assert [(n, len(r)) for n, r in readers.collections(value)] == [("items", 4), ("in.0", 3)]
    import json

    cells = readers.read_collections(json.dumps(value["items"]).encode())
    assert [c[3] for c in cells if c[1] == 0] == ["id", "name", "extra.deep"] and [c[3] for c in cells if c[1] == 3] == ["3", "n3", "1"] and [c[3] for c in cells if c[1] == 1] == ["1", "n1", ""]
