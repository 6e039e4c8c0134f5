"""End to end over a small mixed corpus; settings; the stream form of dedup."""

import gzip

import pytest

from sparkloom import pipeline
from sparkloom.cli import load_settings
from sparkloom.plans import formats as mk


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    r = tmp_path_factory.mktemp("corpus")
    files = {
        "Audit/North/a/memo.docx": mk.make_docx("intro\n## Head\nThe quick brown fox"), "Audit/North/a/copy.docx": mk.make_docx("intro\n## Head\nThe quick brown fox"),
        "Tax/North/a/memo.docx": mk.make_docx("intro\n## Head\nThe quick brown fox"), "Audit/North/reg.csv": b"PAN,Amount\n0012,5\n0013,6\n", "Audit/North/x.pdf": mk.make_pdf("word " * 60),
        "Audit/North/bad.docx": b"PK\x03\x04 broken", "Audit/North/Thumbs.db": b"x", "Audit/North/empty.txt": b"", "Audit/North/b.zip": mk.zipped({"in/one.txt": b"1", "../evil": b"2"}),
        "Audit/North/data.tsf": bytes(range(32)) * 9, "Audit/North/c.gz": gzip.compress(b"zz"), "loose.txt": b"no scope", "Audit/North/scan.png": b"\x89PNG\r\n\x1a\n0",
    }
    for name, raw in files.items():
        (r / name).parent.mkdir(parents=True, exist_ok=True)
        (r / name).write_bytes(raw)
    return r


def test_run(spark, root, tmp_path):
    t = pipeline.run(spark, str(root))
    rec = {r.path: r for r in t["records"].collect()}
    assert len(rec) == 13
    got = {p: r.status for p, r in rec.items()}
    assert got["Audit/North/a/copy.docx"] == "success" and got["Audit/North/a/memo.docx"] == "skipped_duplicate" and got["Tax/North/a/memo.docx"] == "success"
    assert got["Audit/North/Thumbs.db"] == got["Audit/North/empty.txt"] == "excluded_non_data" and got["Audit/North/data.tsf"] == "no_reader"
    assert got["Audit/North/b.zip"] == "partial" and got["Audit/North/c.gz"] == "success" and rec["loose.txt"].error_category == "UNSCOPED_PATH"
    assert rec["Audit/North/empty.txt"].error_category == "EMPTY_FILE" and got["Audit/North/bad.docx"] in ("failed", "partial")
    assert {r.text for r in t["cells"].collect()} >= {"0012", "0013"}
    chunks = t["chunks"].collect()
    assert len({c.chunk_id for c in chunks}) == len(chunks) and any(c.unit_ref == "page:1" for c in chunks)
    out = f"file://{tmp_path}/lake"
    pipeline.publish(t, out, 1)
    with pytest.raises(Exception, match="already exists"):
        pipeline.publish(t, out, 1)
    hits = pipeline.ask(pipeline.build_index(t["chunks"]), "The quick brown fox", 2).collect()
    assert "quick" in hits[0].text


def scanned_pdf(*pages):
    """A PDF whose pages have the given text under an image that covers them."""
    out = b"%PDF-1.4\n"
    for i, (text, image) in enumerate(pages):
        data = (b"600 0 0 780 0 0 cm /Im0 Do " if image else b"") + b"BT (" + text.encode() + b") Tj ET"
        out += b"%d 0 obj << /Type /Page /MediaBox [0 0 612 792] /Contents %d 0 R >> endobj\n%d 0 obj << /Length 9 >> stream\n%s\nendstream endobj\n" % (2 * i + 1, 2 * i + 2, 2 * i + 2, data)
    return out


def test_scanned_pages_are_never_a_silent_success(spark, tmp_path):
    import json

    long = "plain words of a text page " * 8
    files = {"scan.pdf": scanned_pdf(("", True), ("", True)), "mixed.pdf": scanned_pdf((long, False), ("A short note of one line", False), ("", True)), "text.pdf": scanned_pdf((long + "x", False), ("tail", False))}
    for name, raw in files.items():
        (tmp_path / "Audit/North").mkdir(parents=True, exist_ok=True)
        (tmp_path / "Audit/North" / name).write_bytes(raw)
    t = pipeline.run(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[-1]: r for r in t["records"].collect()}
    assert {n: (r.route, r.status) for n, r in got.items()} == {"scan.pdf": ("pdf_vision", "partial"), "mixed.pdf": ("pdf_vision", "partial"), "text.pdf": ("pdf_text", "success")}
    assert got["scan.pdf"].error_message.startswith("pages without transcription: 1, 2: ") and "2, 3" in got["mixed.pdf"].error_message
    texts = [c.text for c in t["chunks"].collect()]
    assert "A short note of one line" in texts and "tail" in texts

    def render(raw, number):
        if number == 3:
            raise ValueError("cannot be drawn")
        return b"page %d" % number

    def send(payload):
        return 200, json.dumps({"document_type": "note", "summary": "", "visible_text": f"seen {payload.decode()}", "fields": [], "tables": [], "uncertainties": []}), "stop"

    t = pipeline.run(spark, str(tmp_path), vision=(render, send))
    got = {r.path.rsplit("/", 1)[-1]: (r.route, r.status) for r in t["records"].collect()}
    assert got == {"scan.pdf": ("pdf_vision", "success"), "mixed.pdf": ("pdf_vision", "partial"), "text.pdf": ("pdf_text", "success")}
    seen = {(r.path.rsplit("/", 1)[-1], r.number): r for r in t["vision"].collect()}
    assert "seen page 2" in seen["scan.pdf", 2].reply and seen["mixed.pdf", 2].native_text == "A short note of one line" and "cannot be drawn" in seen["mixed.pdf", 3].failure


def test_settings(tmp_path):
    f = tmp_path / "s.toml"
    f.write_text("[chunking]\nsize = 500\n")
    got = load_settings(str(f), {"SPARKLOOM_CHUNKING__OVERLAP": "50", "SPARKLOOM_SEARCH__MODE": "exact", "OTHER": "1"})
    assert got["chunking"] == {"size": 500, "overlap": 50} and got["search"] == {"k": 5, "mode": "exact"}
    with pytest.raises(ValueError, match="overlap"):
        load_settings(None, {"SPARKLOOM_CHUNKING__OVERLAP": "5000"})


def test_stream_dedup(spark, tmp_path):
    from sparkloom.streaming import incremental

    src = spark.range(20).selectExpr("concat('s', id % 2) as scope_id", "concat('h', id % 4) as content_sha256", "timestamp'2024-01-01' as discovered_at")
    src.write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(src.schema).parquet(f"file://{tmp_path}/in")
    incremental.append_batches(incremental.first_seen(stream), f"file://{tmp_path}/out", f"file://{tmp_path}/cp").awaitTermination(120)
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 4


def test_members_of_archives_are_files(spark, tmp_path):
    docx = mk.make_docx("intro\n## Head\nOnly inside the archive")
    deep = mk.zipped({"l2.zip": mk.zipped({"l3.txt": b"Words at depth three"}), "table.csv": b"PAN,Amount\n0077,5\n0078,6\n"})
    twice = mk.zipped({"sub/report.docx": docx, "l1.zip": deep, "loose.txt.gz": gzip.compress(b"Words inside gzip"), "copy.txt": b"Words outside as well", "Thumbs.db": b"x"})
    for name, raw in {"Audit/North/b.zip": twice, "Audit/North/out.txt": b"Words outside as well", "Audit/South/c.gz": gzip.compress(b"Words outside as well"), "loose.zip": twice}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(raw)
    t = pipeline.run(spark, str(tmp_path))
    rec = {r.path: r for r in t["member_records"].collect()}
    b = "Audit/North/b.zip!"
    assert {p: r.status for p, r in rec.items()} == {
        f"{b}sub/report.docx": "success", f"{b}l1.zip": "success", f"{b}l1.zip!l2.zip": "success", f"{b}l1.zip!l2.zip!l3.txt": "success", f"{b}l1.zip!table.csv": "success",
        f"{b}loose.txt.gz": "success", f"{b}loose.txt.gz!content": "success", f"{b}copy.txt": "skipped_duplicate", f"{b}Thumbs.db": "excluded_non_data", "Audit/South/c.gz!content": "success",
    }
    assert rec[f"{b}l1.zip!l2.zip!l3.txt"].depth == 3 and {r.archive_path for r in rec.values()} == {"Audit/North/b.zip", "Audit/South/c.gz"}
    assert {r.path: r.status for r in t["records"].collect()} == {"Audit/North/b.zip": "success", "Audit/North/out.txt": "success", "Audit/South/c.gz": "success", "loose.zip": "failed"}
    texts = " ".join(c.text for c in t["chunks"].collect())
    assert all(x in texts for x in ("Only inside the archive", "Words at depth three", "Words inside gzip")) and texts.count("Words outside as well") == 2
    assert {r.text for r in t["cells"].where(f"path = '{b}l1.zip!table.csv'").collect()} >= {"0077", "0078"}


def test_large_files_are_recorded(spark, tmp_path):
    for name, raw in {"Audit/North/big.txt": b"words " * 200, "Audit/North/small.txt": b"words", "Audit/North/big.exe": b"MZ" * 900}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(raw)
    t = pipeline.run(spark, str(tmp_path), limit=1000)
    got = {r.path.rsplit("/", 1)[-1]: (r.family, r.status, r.error_category) for r in t["records"].collect()}
    assert got == {"big.txt": ("plain_text", "failed", "CONTENT_TOO_LARGE"), "small.txt": ("plain_text", "success", None), "big.exe": ("executable", "excluded_non_data", "EXECUTABLE_NOT_PROCESSED")}


def test_a_second_run_does_only_what_is_new(spark, tmp_path):
    root, out = tmp_path / "corpus", f"file://{tmp_path}/lake"
    for name, raw in {"Audit/North/a.txt": b"first words", "Audit/North/b.csv": b"PAN,Amount\n0012,5\n", "Audit/South/c.docx": b"PK\x03\x04 broken", "Audit/South/d.zip": mk.zipped({"in.txt": b"words inside"}), "Audit/North/s.pdf": scanned_pdf(("", True))}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(raw)
    assert pipeline.sealed_manifest(spark, out) is None
    one = pipeline.run(spark, str(root), ordinal=1)
    pipeline.publish(one, out, 1)
    prior = pipeline.sealed_manifest(spark, out)
    assert prior.count() == one["manifest"].count() == 6
    (root / "Audit/North/new.txt").write_bytes(b"second words")
    (root / "Audit/North/again.txt").write_bytes(b"first words")
    two = pipeline.run(spark, str(root), prior=prior, ordinal=2)
    told = {r.path.split("/")[-1]: (r.status, r.decision) for r in two["records"].collect()}
    # The first path of a content in a scope stands for it; what failed or was partial is tried again.
    assert told == {
        "a.txt": ("success", "reuse"), "again.txt": ("skipped_duplicate", None), "b.csv": ("success", "reuse"), "c.docx": ("failed", "retry") if told["c.docx"][0] == "failed" else ("partial", "retry"),
        "d.zip": ("success", "reuse"), "s.pdf": ("partial", "retry"), "new.txt": ("success", "process_new"),
    }
    assert {r.text for r in two["chunks"].collect()} == {"second words"} and two["cells"].count() == 0
    pipeline.publish(two, out, 2)
    assert pipeline.sealed_manifest(spark, out).count() == 6 + two["manifest"].count()
    counts = pipeline.summary(two).first()
    assert counts.n_files == 7 and counts.n_reused >= 3 and counts.n_duplicates == 1 and counts.n_chunks == 1
    other = pipeline.run(spark, str(root), prior=pipeline.sealed_manifest(spark, out), ordinal=3, size=500)
    assert {r.decision for r in other["records"].where("path like '%new.txt'").collect()} == {"reprocess_config_changed"}
    forced = pipeline.run(spark, str(root), prior=prior, ordinal=3, force=True)
    assert forced["records"].where("decision = 'reuse'").isEmpty()


def test_a_changed_manifest_is_refused(spark, tmp_path):
    root, out = tmp_path / "corpus", f"file://{tmp_path}/lake"
    (root / "Audit/North").mkdir(parents=True)
    (root / "Audit/North/a.txt").write_bytes(b"words")
    t = pipeline.run(spark, str(root))
    pipeline.publish(t, out, 1)
    one = pipeline.sealed_manifest(spark, out)
    assert one.count() == 1
    forged = spark.createDataFrame([r.asDict() | {"status": "failed"} for r in one.collect()], one.schema)
    forged.write.mode("append").parquet(f"{out}/manifest/version=r000001")
    with pytest.raises(ValueError, match="seal"):
        pipeline.sealed_manifest(spark, out)


def test_the_command_line(spark, tmp_path, capsys, monkeypatch):
    from sparkloom import cli

    root, out = tmp_path / "corpus", f"file://{tmp_path}/lake"
    (root / "Audit/North").mkdir(parents=True)
    (root / "Audit/North/a.txt").write_bytes(b"the quick brown fox")
    assert cli.main(["search", out, "fox"]) == 2 and cli.main(["gold", out]) == 2
    assert cli.main(["run", str(root), out]) == 0 and cli.main(["search", out, "fox"]) == 2
    assert cli.main(["gold", out]) == 0 and cli.main(["search", out, "quick fox", "--client", "North"]) == 0
    assert "quick brown" in capsys.readouterr().out
    (root / "Audit/North/bad.docx").write_bytes(b"PK\x03\x04 broken")
    assert cli.main(["run", str(root), out]) in (0, 1) and cli.main(["config"]) == 0
    assert "fingerprints" in capsys.readouterr().out
    monkeypatch.setenv("SPARKLOOM_CHUNKING__OVERLAP", "5000")
    assert cli.main(["config"]) == 2
