"""Scanned pages: furniture, broken words, misread characters, paragraphs."""

import os
import random

import pytest

from sparkloom.llm import ocr, queries

WORDS = {w: 50 for w in "the clerk bought customer statement going-concern confirmation on a basis amount of was paid by bank stock office returned signed first second third line here".split()}
LEXICON = ocr.Lexicon(WORDS)
SCHEMA = "record_table string, record_key string, doc string, page_no int, text string, label string"


def pages(spark, rows):
    return spark.createDataFrame([("t", f"{d}:{n}", d, n, t, "clash") for d, n, t in rows], SCHEMA)


def found(spark, rows):
    return {(r.record_key, r.noise_kind, r.value_key) for r in ocr.page_noise(pages(spark, rows), LEXICON).collect()}


def test_noise(spark):
    one = "Stock report / North depot | 1\nThe c1erk b0ught the state-\nment on a going-\nconcern basis.\n\nThe amount of 1,2O4 was paid.\n2019\n    Page 1 of 2"
    two = "St0ck report / North depot | 2\nThe cust-\n  omer signecl 82B, first.\nsecond line here\n\n- 2 -"
    got = found(spark, [("d", 1, one), ("d", 1, one), ("d", 2, two), ("e", 1, "Lonely header\nthe bank paid.\nxii"), ("d", 3, None), ("d", 4, "")])
    assert got == {
        ("d:1", "furniture", "Stock report / North depot | 1"), ("d:1", "furniture", "Page 1 of 2"), ("d:1", "char", "clerk"), ("d:1", "char", "bought"),
        ("d:1", "hyphen", "statement"), ("d:1", "hyphen", "going-concern"), ("d:1", "char", "1,204"),
        ("d:2", "furniture", "St0ck report / North depot | 2"), ("d:2", "furniture", "- 2 -"), ("d:2", "hyphen", "customer"), ("d:2", "char", "signed"),
        ("e:1", "furniture", "xii"),
    }
    assert found(spark, []) == set()


def test_paragraphs(spark):
    one = "Head | 1\nThe c1erk b0ught the state-\nment.\n\nThe bank paid.\n[3]"
    got = {r.record_key: r.text for r in ocr.repaired_pages(pages(spark, [("d", 1, one), ("d", 2, "Head | 2\nthe bank"), ("d", 2, "Head | 2\nthe bank")]), LEXICON).collect()}
    assert got == {"d:1": "The clerk bought the statement.\n\nThe bank paid.", "d:2": "the bank"}


def test_lexicon_counts_everything(spark):
    df = spark.createDataFrame([("Good words, good (words)",), ("good b4d",), (None,), ("",)], "text string")
    assert ocr.lexicon(df).frequent == {"good": 3}


def test_middle_lines_are_never_furniture():
    lines = ["a long line of text here", "Page 3", "Running head", "more text in here", "and the end of it all"]
    assert not {ocr.TOP, ocr.BOTTOM} & set(ocr.label_lines(lines, {2}))
    assert ocr.label_lines([], set()) == []


def test_markers_do_not_hide_the_footer(spark):
    got = found(spark, [("d", 1, "the bank paid.\n  page no 3\n[UNREADABLE]"), ("d", 2, "[UNREADABLE]\n[4]\nthe bank paid.")])
    assert got == {("d:1", "furniture", "page no 3"), ("d:2", "furniture", "[4]")}


def test_repair_survives_very_long_text():
    c = ocr.Corrector(WORDS)
    assert ocr.repair("the bank paid. " * 50_000, [ocr.BODY], c).count("paid") == 50_000


def made_pages(n_docs=40, seed=2):
    """Documents of several pages with a header, a footer or neither, and the right labels of their lines."""
    rng = random.Random(seed)
    vocab = sorted(WORDS)
    out = []
    for d in range(n_docs):
        head, foot, blank = rng.choice(["North depot stock report", "Q3", None, "A very long running header " * 6]), rng.choice(["page", "dash", "firm", None]), rng.random() < 0.5
        for p in range(1, rng.randint(3, 6)):
            lines, labels = [], []
            if head:
                lines.append(head.strip())
                labels.append("top")
            if blank:
                lines.append("")
                labels.append("")
            for _ in range(rng.randint(4, 12)):
                lines.append(" ".join(rng.choice(vocab) for _ in range(rng.randint(3, 9))) + rng.choice(["", "."]))
                labels.append("body")
            if foot:
                lines.append({"page": f"Page {p}", "dash": f"- {p} -", "firm": "Norvo Agro LLP"}[foot])
                labels.append("bottom")
            out.append((f"d{d}", p, "\n".join(lines), labels))
    return out


def test_the_model_learns_from_unlabelled_pages(spark):
    rows = made_pages()
    layout = ocr._layout(pages(spark, [r[:3] for r in rows]).select(*ocr.PAGE))
    model, told = ocr.layout_model(layout)
    assert len(told) >= 3 and all(b >= a - 1e-6 * abs(a) for a, b in zip(told, told[1:], strict=False))
    rep = {r.record_key: set(r["_rep"] or ()) for r in layout.collect()}
    wrong = n = 0
    for d, p, text, labels in rows:
        got = ocr.label_lines(text.split("\n"), rep[f"{d}:{p}"], model)
        for g, want in zip(got, labels, strict=True):
            n += want != ""
            wrong += want != "" and {ocr.TOP: "top", ocr.BODY: "body", ocr.BREAK: "body", ocr.BOTTOM: "bottom"}[g] != want
    assert wrong <= 0.005 * n and abs(model.emit.sum() - 4) < 1e-9 and model.trans[1][0] == 0


def test_headers_of_any_length(spark):
    long = "Annexure to the memorandum of the meeting of the members held at the registered place " * 2
    got = found(spark, [("d", n, f"{head}\nthe bank paid the clerk.\nthe stock was returned") for n, head in ((1, long), (2, long))] + [("e", n, "QZ\nthe bank paid.") for n in (1, 2)])
    assert {(k, v) for k, t, v in got if t == "furniture"} == {("d:1", long.strip()), ("d:2", long.strip()), ("e:1", "QZ"), ("e:2", "QZ")}


def test_paragraphs_over_page_breaks(spark):
    rows = [
        ("d", 1, "Head | 1\nthe clerk paid.\n\nthe customer bought the state-\n- 1 -"), ("d", 2, "Head | 2\nment of the stock\nand\n- 2 -"), ("d", 3, "Head | 3\nwas returned by the bank.\n\nsecond line here.\n- 3 -"),
        ("d", 5, "Head | 5\nthird line here"), ("e", 1, "first line"), ("e", 2, "Second line"), (None, 1, "the bank"), (None, 2, "paid"),
    ]
    got = [(r.doc, r.first_page, r.last_page, r.paragraph_no, r.text) for r in ocr.paragraphs(pages(spark, rows), LEXICON).collect()]
    assert sorted(r[1:] for r in got if r[0] == "d") == [
        (1, 1, 0, "the clerk paid."), (1, 3, 1, "the customer bought the statement of the stock and was returned by the bank."), (3, 3, 1, "second line here."), (5, 5, 0, "third line here"),
    ]
    assert len([r for r in got if r[0] == "e"]) == 2 and len(got) == 8


def test_rare_words_are_looked_up(spark, monkeypatch):
    """With a shared lexicon of a few words the rest is found in the table: the result is the same."""
    clean = spark.createDataFrame([(" ".join(w for w in WORDS for _ in range(3 + len(w))),)], "text string")
    rows = [(d, p, t) for d, p, t, _ in made_pages(6)] + [("x", 1, "Stock\nThe c1erk b0ught the state-\nment on a going-\nconcern basis.\nThe customer signecl, rctnrned.")]
    rows = [(d, p, t.replace("clerk", "cl3rk").replace("office", "oflice")) for d, p, t in rows]
    whole = ocr.lexicon(clean)
    want = {tuple(r) for r in ocr.page_noise(pages(spark, rows), whole).collect()}
    monkeypatch.setattr(ocr, "SHARED", 4)
    few = ocr.lexicon(clean)
    assert len(few.frequent) == 4 and few.rare is not None and len(whole.frequent) > 20
    assert {tuple(r) for r in ocr.page_noise(pages(spark, rows), few).collect()} == want and len(want) > 10


def test_rare_words_at_every_break(spark, monkeypatch):
    """Words broken at a page's end, at a marker, or twice are looked up in the table too."""
    clean = spark.createDataFrame([(" ".join(w for w in WORDS for _ in range(3 + len(w))),)], "text string")
    rows = [
        ("d", 1, "the clerk paid.\n\nthe bank bought the sta7e-"), ("d", 2, "rnent of the stock."), ("e", 1, "the bank paid the conf1r-\n[STAMP]\nmation of the stock."),
        ("f", 1, "the bank paid the con-\nf1rma-\ntion of the stock."), ("g", 1, "the bank bought the con-"), ("g", 2, "f1rma-"), ("g", 3, "tion of the stock."),
    ]
    made = lambda lexicon: {(r.doc, r.first_page, r.paragraph_no, r.text) for r in ocr.paragraphs(pages(spark, rows), lexicon).collect()}
    want = made(ocr.lexicon(clean))
    assert ("d", 1, 1, "the bank bought the statement of the stock.") in want and sum("confirmation of the stock" in r[3] for r in want) == 3
    monkeypatch.setattr(ocr, "SHARED", 1)
    few = ocr.lexicon(clean)
    assert not {"statement", "confirmation"} & set(few.frequent) and made(few) == want


def test_report_counts_rare_words(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    if not os.path.exists(folder):
        pytest.skip("no pages here")
    want = {tuple(r) for r in queries.p6_left_over(spark, folder).collect()}
    monkeypatch.setattr(ocr, "SHARED", 40)
    assert {tuple(r) for r in queries.p6_left_over(spark, folder).collect()} == want and len(want) == 2
