"""Small goldens of the catalog, versioning, text, page, table and vector operators."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.operators import catalog, chunking, pages, routing, tables, vectors, versioning
from sparkloom.sources import readers


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_scope_ids_differ_by_category(spark):
    got = values(spark, [("A", "Same & Co"), ("B", "Same & Co"), ("Ä", "")], "category string, client string", catalog.scope_id(F.col("category"), F.col("client")))
    assert len({g[0] for g in got}) == 3 and got[0][0].startswith("a__same_co__") and got[2][0].startswith("a__unnamed__")


def test_longest_root_wins(spark):
    scopes = spark.createDataFrame([("s1", "A"), ("s2", "A/B"), ("s3", "A/BC")], "scope_id string, scope_root string")
    files = spark.createDataFrame([("A/B/x",), ("A/BCD/x",), ("Z/x",), (None,)], "relative_path string")
    got = {r.relative_path: r.resolved_scope for r in catalog.resolve_paths(files, scopes).collect()}
    assert got == {"A/B/x": "s2", "A/BCD/x": "s1", "Z/x": None}
    assert {r.relative_path: r.resolved_scope for r in catalog.resolve_scopes(files, scopes).collect()} == got | {None: None}


def test_dedup_keeps_paths(spark):
    src = spark.createDataFrame([("s", "h", "a", 1), ("s", "h", "b", 2), ("s", "h", "a", 3), ("t", "h", "a", 4), ("s", None, "z", 5)], "scope_id string, content_sha256 string, relative_path string, ord bigint")
    got = {(r.scope_id, r.first_path, r.n_duplicates) for r in catalog.dedup_in_scope(src).collect()}
    assert got == {("s", "a", 1), ("t", "a", 0)}
    assert {(r.scope_id, r.relative_path) for r in catalog.content_paths(src).collect()} == {("s", "a"), ("s", "b"), ("t", "a")}
    assert [r.outcome for r in catalog.dedup_outcomes(src).orderBy("ord").collect()] == ["first", "duplicate", "repeat", "first"]


def test_safe_members(spark):
    names = ["../../evil.txt", "/etc/passwd", "CON", "sub/NUL.txt", "C:/x", "\\\\host\\x", "AY 24-25/x.xlsx", "a\\b.txt", "", None]
    got = [r[0] for r in values(spark, [(n,) for n in names], "p string", catalog.safe_member(F.col("p")))]
    assert [bool(g) for g in got] == [False] * 6 + [True, True, False, False]


def test_reuse(spark):
    rows = [(None, None, "f"), ("success", "f", "f"), ("success", "g", "f"), ("partial", "f", "f"), ("locked", "f", "f"), ("no_reader", "f", "f")]
    args = [F.col("s"), F.col("p"), F.col("f")]
    got = values(spark, rows, "s string, p string, f string", versioning.reuse_decision(*args), versioning.reuse_decision(*args, force=True), versioning.reuse_decision(*args, retry_locked=False))
    assert [g[0] for g in got] == ["process_new", "reuse", "reprocess_config_changed", "retry", "retry", "reuse"]
    assert [g[1] for g in got] == ["process_new"] + ["reprocess_forced"] * 5 and got[4][2] == "reuse"


def test_active_is_never_partial(spark):
    e = spark.createDataFrame([("s", "h", "r", 1, "v1", "success", "f"), ("s", "h", "r", 2, "v2", "partial", "f")], "scope_id string, content_hexdigest string, route string, run_ordinal int, version_id string, status string, route_fingerprint string")
    assert versioning.resolve_active(e).first().version_id == "v1" and versioning.latest_outcome(e).first().version_id == "v2"


def test_unknown_family_raises(spark):
    df = spark.createDataFrame([("no such family",)], "family string")
    with pytest.raises(Exception, match="no route for family"):
        routing.select_routes(df).collect()


def test_fingerprints_do_not_depend_on_order():
    a = routing.section_fingerprint("x", {"a": 0.1 + 0.2, "b": 1})
    assert a == routing.section_fingerprint("x", {"b": 1, "a": 0.3}) and a != routing.section_fingerprint("x", {"b": 2, "a": 0.3})


TEXTS = st.text(alphabet="ab \t\n\r\x1c\u00a0é", max_size=30)


@given(st.lists(TEXTS, min_size=1, max_size=20))
@settings(max_examples=10, deadline=None)
def test_text_agrees_with_python(spark, texts):
    got = values(spark, [(t,) for t in texts], "t string", "t", T.strip(F.col("t")), F.array_join(T.tokens(F.col("t")), "|"), T.normalise(F.col("t")))
    for t, stripped, toks, norm in got:
        assert stripped == t.strip() and toks == "|".join(t.split()) and norm == readers.normalise(t)


@given(st.text(alphabet="ab \n", max_size=300), st.integers(5, 40), st.integers(0, 4))
@settings(max_examples=200, deadline=None)
def test_splitter(text, size, overlap):
    pieces = chunking.split_recursively(text, size, overlap)
    assert all(p in text and 0 < len(p) <= size for p in pieces)
    assert "".join("".join(pieces).split()).count("a") >= text.count("a")
    chunking.locate(pieces, text)
    with pytest.raises(ValueError, match="overlap"):
        chunking.split_recursively("x", 2, 3)


def test_size_bounded_units(spark):
    e = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(t).alias("text")) for k, t in (("a", "xx"), ("a", "yyy"), ("a", "z"), ("b", "w"))])
    got = spark.range(1).select(chunking.size_bounded_units(e, 5).alias("u")).first().u
    assert [(u.key, u.first, u.last, u.chars) for u in got] == [("a", 0, 1, 5), ("a", 2, 2, 1), ("b", 3, 3, 1)]


def test_page_rules(spark):
    rows = [(120, 0.9), (0, 0.5), (5, 0.6), (19, 0.0), (50, 0.1)]
    assert [r[0] for r in values(spark, rows, "c int, v double", pages.page_kind(F.col("c"), F.col("v")))] == ["text", "scanned", "mixed", "empty", "mixed"]


def test_reply_contract():
    ok = '{"document_type":"x","summary":"","visible_text":"t","fields":[{"label":"a","value":"b"}],"tables":[],"uncertainties":[]}'
    assert pages.check_reply(ok) is None and pages.check_reply("nope") == "not JSON" and pages.check_reply("{}").startswith("missing")
    assert pages.check_reply(ok.replace('"visible_text":"t"', '"visible_text":1')) == "wrong type"


def test_transcription_retries(spark):
    images = spark.createDataFrame([("a", bytearray(b"1")), ("b", bytearray(b"2"))], "image_id string, payload binary")
    seen = {}

    def send(p):
        seen[p] = seen.get(p, 0) + 1
        return ((429, "", ""), (503, "", ""), (200, "{}", "length"), (200, "[]", "stop"))[seen[p] - 1] if p == b"1" else (401, "", "")

    got = {r.image_id: (r.status, r.attempts, r.failure) for r in pages.transcribe(images, send).collect()}
    assert got == {"a": ("failed", 4, "not an object"), "b": ("failed", 1, "HTTP 401")}


def test_typing(spark):
    cells = [("t", n, v) for n, vs in {"pad": ["0012", "7"], "int": ["1", " 2 ", ""], "flt": ["1.5", "2"], "money": ["2.50", "1"], "mix": ["1", "x"], "none": ["", None], "big": ["9" * 25]}.items() for v in vs]
    got = {r.name: (r.type, r.null_count) for r in tables.infer_types(spark.createDataFrame(cells, "table_name string, name string, value string")).collect()}
    assert got == {"pad": ("string", 0), "int": ("int64", 1), "flt": ("double", 0), "money": ("string", 0), "mix": ("string", 0), "none": ("string", 2), "big": ("string", 0)}
    assert tables.column_names(["A", "A", "A_1", ""]) == ["A", "A_1", "A_1_1", "column_3"]


def test_rows_are_numbered_without_gaps(spark):
    rows = [(f"c{i}", "hot" if i % 3 else "b", f"{i * 7919 % 4096:03x}", i % 2) for i in range(300)]
    got = vectors.index_rows(spark.createDataFrame(rows, "chunk_id string, scope_id string, content_sha256 string, seq int"), 1).collect()
    for scope in ("hot", "b"):
        own = sorted((r for r in got if r.scope_id == scope), key=lambda r: (r.content_sha256, r.seq, r.chunk_id))
        assert [r.row_no for r in own] == list(range(len(own)))


def test_seal_follows_every_entry(spark):
    schema = "scope_id string, content_hexdigest string, route string, route_fingerprint string, version_id string, run_ordinal int, status string, source_paths array<string>"
    rows = [("s", f"{i * 7919 % 65536:064x}"[::-1], "r", "f", "v", 1, "success", ["p"]) for i in range(50)]
    seal = lambda r: tuple(versioning.seal_body(spark.createDataFrame(r, schema)).first())
    assert seal(rows) == seal(rows[::-1]) and seal(rows)[1] == 50
    assert seal(rows) != seal([*rows[:-1], ("s", rows[-1][1], "r", "f", "v", 1, "partial", ["p"])])


def test_search(spark):
    v = spark.createDataFrame([(1, "a", "Acme", "X", [1.0, 0.0]), (2, "a", "Acme", "X", [1.0, 0.0]), (3, "b", "Zed", "Y", [0.0, 1.0])], "chunk_id bigint, scope_id string, client string, category string, vector array<float>")
    q = [1.0, 0.5]
    assert [r.chunk_id for r in vectors.search(v, q, 2).collect()] == [1, 2]
    assert [r.chunk_id for r in vectors.search(v, q, 2, client="zE").collect()] == [3]
    with pytest.raises(Exception, match="different dimensions"):
        vectors.search(v, [1.0], 1).collect()


def test_search_answers_every_question(spark, monkeypatch):
    import random

    rng = random.Random(4)
    rows = [(i, f"s{i % 3}", f"Client {i % 3}", "X", [float(rng.randint(-2, 2)) for _ in range(4)]) for i in range(400)]
    v = spark.createDataFrame(rows, "chunk_id int, scope_id string, client string, category string, vector array<float>").repartition(5)
    q = v.where("chunk_id % 50 = 0").select(F.col("chunk_id").alias("query_id"), "vector")
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 3)
    for only in (None, "s1"):
        got = {(r.query_id, r.chunk_id, r.score) for r in vectors.search_set(v, q, 4, scope_id=only).collect()}
        want = set()
        for i in range(0, 400, 50):
            score = lambda r: sum(x * y for x, y in zip(r[4], rows[i][4], strict=True))  # noqa: B023, E731
            want |= {(i, r[0], score(r)) for r in sorted((r for r in rows if only in (None, r[1])), key=lambda r: (-score(r), r[0]))[:4]}
        assert got == want and len(got) == 32
    assert vectors.search_set(v, q.limit(0), 4).count() == 0
    with pytest.raises(Exception, match="different dimensions"):
        vectors.search_set(v, q.selectExpr("query_id", "slice(vector, 1, 2) as vector"), 1).collect()


def test_header_test_sees_every_table_of_the_register(spark, tmp_path):
    from sparkloom.plans import core

    rows = [(1, 0, '{"PAN": "A1", "Name": "x"}'), (1, 0, '{"PAN": "A1", "Name": "x"}'), (2, 3, '{"PAN": "7", "Name": "x"}'), (2, 5, '{"PAN": "A", "Name": "x"}'), (3, 0, '{"2024": "a", "b": null}')]
    spark.createDataFrame(rows, "table_id bigint, row_no bigint, payload string").write.parquet(f"file://{tmp_path}/raw_register.parquet")
    got = {tuple(r) for r in core.header_detect_register(spark, f"file://{tmp_path}").collect()}
    assert got == {(1, True, True), (2, True, False), (3, False, False)}


def test_types_by_native_kind(spark):
    columns = {
        "whole": [("1", "number"), ("2", "number"), ("", "empty")], "mix": [("1", "number"), ("2.50", "number")], "flag": [("TRUE", "bool"), ("FALSE", "bool")], "day": [("2024-01-01", "date"), ("2024-01-02T10:00:00", "date")],
        "time": [("10:00:00", "date")], "both": [("1", "number"), ("x", "text")], "dated": [("2024-01-01", "date"), ("3", "number")], "text_day": [("2024-01-01", "text")], "text_int": [("7", "text")], "text_float": [("2.50", "text")], "none": [("", "empty")],
    }
    rows = [("t", n, v, k) for n, vs in columns.items() for v, k in vs]
    df = spark.createDataFrame(rows, "table_name string, name string, value string, native_kind string")
    got = {r.name: (r.type, r.rejected_reason) for r in tables.infer_types(df).collect()}
    assert got == {
        "whole": ("int64", None), "mix": ("double", None), "flag": ("bool", None), "day": ("timestamp", None), "time": ("string", "times without a day"), "both": ("string", "mixed kinds"), "dated": ("string", "mixed kinds"),
        "text_day": ("string", None), "text_int": ("int64", None), "text_float": ("string", "numbers that do not round-trip"), "none": ("string", None),
    }
    assert {r.type for r in tables.infer_types(df, infer=False).collect()} == {"string"}
    t = tables.typed_table(spark.createDataFrame([(0, "day", "2024-01-01"), (0, "flag", "TRUE")], "row_no int, name string, value string"), {"day": "timestamp", "flag": "bool"}, ["row_no"])
    assert dict(t.dtypes) == {"row_no": "int", "day": "timestamp_ntz", "flag": "boolean"} and t.first().flag is True


def test_slugs_decompose_letters(spark):
    cases = {"Çelik Ğ Ołtarz ṁ Ｆｕｌｌ": "celik_g_otarz_m_full", "नमस्ते": "unnamed", "Ångström & Søn": "angstrom_sn", "ﬁle ½": "le", "a" * 60: "a" * 40}
    df = spark.createDataFrame(list(cases.items()), "t string, want string")
    import unicodedata

    for r in df.select("t", "want", T.ascii_slug(F.col("t")).alias("s")).collect():
        assert r.s == r.want, r
        if all(len(unicodedata.normalize("NFKD", c).encode("ascii", "ignore")) < 2 for c in r.t):
            plain = unicodedata.normalize("NFKD", r.t).encode("ascii", "ignore").decode().lower()
            import re

            assert r.s == (re.sub(r"[^a-z0-9]+", "_", plain).strip("_")[:40].rstrip("_") or "unnamed")


def test_waits_between_requests(spark):
    waits = []
    sent = []

    def send(payload):
        sent.append(1)
        return (429, "", "", 7) if len(sent) == 1 else (503, "", "") if len(sent) == 2 else (400, "", "")

    import pandas as pd

    class Frame:
        def select(self, *_):
            return self

        def mapInPandas(self, run, _):
            return list(run(iter([pd.DataFrame({"image_id": ["a"], "payload": [b"x"]})])))

    out = pages.transcribe(Frame(), send, wait=waits.append)[0]
    assert waits[0] == 7.0 and 1.0 <= waits[1] <= 1.5 and len(waits) == 2 and out.failure[0] == "HTTP 400" and out.attempts[0] == 3


def test_released_work_is_gone(spark):
    from sparkloom import common

    df = common.cut(spark.range(5).toDF("x"), "to-go")
    assert df.count() == 5
    path = common._MADE[-1]
    assert common.release(spark, keep=("file:/nowhere",)) >= 1 and path not in common._MADE
    with pytest.raises(Exception, match="(?i)not exist|no such|not found"):
        spark.read.parquet(path).count()
    with pytest.raises(ValueError, match="mounted"):
        common.local_path("hdfs://host/x")
    assert common.local_path("file:///a/b") == common.local_path("file:/a/b") == "/a/b"
