"""Pages of documents: kinds, coverage, roll-ups, transcription contract and its Markdown."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNREADABLE = "[UNREADABLE]"


def page_kind(chars: Column, coverage: Column) -> Column:
    """text, scanned, mixed or empty from the characters of a page's text layer and the share of it that images cover."""
    return (
        F.when(chars >= 120, "text")
        .when(coverage >= 0.5, F.when(chars == 0, "scanned").otherwise("mixed"))
        .when((chars < 20) & (coverage < 0.05), "empty")
        .otherwise("mixed")
    )


def image_coverage(images: Column, page_area: Column) -> Column:
    """Share of a page covered by images (array<struct<w,h>>), at most 1; 0 for pages without area."""
    total = F.aggregate(images, F.lit(0.0), lambda s, x: s + x["w"].cast("double") * x["h"].cast("double"))
    return F.when(page_area > 0, F.least(total / page_area, F.lit(1.0))).otherwise(F.lit(0.0))


def downscaled(width: Column, height: Column, edge: int = 2000) -> tuple[Column, Column]:
    """Size of an image whose longest edge is brought down to ``edge``; smaller images stay as they are."""
    longest = F.greatest(width, height)
    scale = lambda x: F.when(longest <= edge, x).otherwise(F.greatest(F.floor(x * edge / longest), F.lit(1))).cast("int")
    return scale(width), scale(height)


def keep_native(native: Column, jaccard: Column, threshold: float = 0.5) -> Column:
    """A mixed page's own text layer, unless its transcription says the same."""
    return F.when((native != "") & (jaccard < threshold), native)


def document_status(pages: DataFrame, key: str = "content_sha256") -> DataFrame:
    """(key, n_pages, n_failed, status, first_failure): partial if a page failed; the first failed page's message is kept."""
    p = pages.dropDuplicates([key, "number"])
    return p.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_pages"), F.count("failure").alias("n_failed"),
        F.when(F.count("failure") > 0, "partial").otherwise("success").alias("status"),
        F.min_by("failure", F.when(F.col("failure").isNotNull(), F.col("number"))).alias("first_failure"),
    )


#: Members of a reply and the confidences it may give.
REPLY_KEYS = ("document_type", "summary", "visible_text", "fields", "tables", "uncertainties")
CONFIDENCES = ("high", "medium", "low")


def check_reply(content: str | None) -> str | None:
    """Why a transcription reply is not acceptable, or None. Strict: nothing is coerced."""
    try:
        r = json.loads(content or "")
    except (ValueError, RecursionError):
        return "not JSON"
    if not isinstance(r, dict):
        return "not an object"
    if missing := [k for k in REPLY_KEYS if k not in r]:
        return "missing " + ",".join(missing)
    if not all(isinstance(r[k], str) for k in REPLY_KEYS[:3]) or not all(isinstance(r[k], list) for k in REPLY_KEYS[3:]):
        return "wrong type"
    for f in r["fields"]:
        if not isinstance(f, dict) or not isinstance(f.get("label"), str) or not isinstance(f.get("value"), str):
            return "bad field"
        if f.get("confidence", "medium") not in CONFIDENCES:
            return "bad confidence"
    for t in r["tables"]:
        if not isinstance(t, dict) or not isinstance(t.get("columns"), list) or not isinstance(t.get("rows"), list) or not all(isinstance(x, list) for x in t["rows"]):
            return "bad table"
    return None if r["visible_text"].strip() or r["fields"] or r["tables"] else "no content"


def reply_error(c: Column) -> Column:
    """Why a reply is not acceptable, or null."""

    @F.pandas_udf("string")
    def check(s: pd.Series) -> pd.Series:
        return s.map(check_reply)

    return check(c)


#: Answers after which a request is made again.
RETRY_CODES = frozenset({408, 409, 425, 429, 500, 502, 503, 504})


def transcribe(images: DataFrame, send: Callable[[bytes], tuple[int, str, str]], attempts: int = 5, wait: Callable[[float], None] | None = None) -> DataFrame:
    """(image_id, status, attempts, reply, failure) of images (image_id, payload) by an injected transport.

    send returns the HTTP code, the reply and the finish reason and, if the
    service named one, the seconds to wait before asking again. Retried: the
    codes of RETRY_CODES and replies cut off by length; other errors are final.
    Without a named time the waits double from half a second, each lengthened
    by up to half by a number of the image's own, so that tasks do not ask in step.
    One failed image never fails the others.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for image_id, payload in zip(b["image_id"], b["payload"], strict=True):
                failure, reply, n = None, None, 0
                for n in range(1, attempts + 1):
                    code, body, finish, *after = send(bytes(payload))
                    if code == 200 and finish != "length":
                        failure = check_reply(body)
                        reply = body if failure is None else None
                        break
                    failure = "cut off by length" if code == 200 else f"HTTP {code}"
                    if code != 200 and code not in RETRY_CODES:
                        break
                    if wait is not None and n < attempts:
                        spread = int(hashlib.sha256(f"{image_id}:{n}".encode()).hexdigest()[:4], 16) / 0xFFFF
                        wait(float(after[0]) if after and after[0] is not None else 0.5 * 2 ** (n - 1) * (1 + spread / 2))
                rows.append((image_id, "success" if failure is None else "failed", n, reply, failure))
            yield pd.DataFrame(rows, columns=["image_id", "status", "attempts", "reply", "failure"])

    return images.select("image_id", "payload").mapInPandas(run, "image_id string, status string, attempts int, reply string, failure string")


def escape_cell(c: Column) -> Column:
    """A text that can stand in a Markdown table cell."""
    s = F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.replace(s, F.lit("|"), F.lit("\\|")), r"\r\n|\r|\n", " ")


def markdown_row(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(F.transform(cells, lambda c: escape_cell(c)), " | "), F.lit(" |"))


def markdown_table(columns: Column, rows: Column) -> Column:
    """A Markdown table; short rows are filled and long ones cut to the columns."""
    n = F.size(columns)
    filled = F.transform(rows, lambda r: F.slice(F.concat(r, F.array_repeat(F.lit(""), n)), 1, n))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), n), " | "), F.lit(" |"))
    return F.array_join(F.concat(F.array(markdown_row(columns), rule), F.transform(filled, markdown_row)), "\n")


def page_markdown(number: Column, extraction: Column, native: Column, failure: Column) -> Column:
    """One page's section of a transcribed document."""
    title = F.concat(F.lit("## Page "), number.cast("string"))
    text = F.nullif(F.coalesce(extraction["visible_text"], F.lit("")), F.lit(""))
    failed = F.concat(F.lit("_Page failed: "), failure, F.lit("_"))
    layer = F.concat(F.lit("### Native text\n\n"), F.nullif(native, F.lit("")))
    tables = F.transform(F.coalesce(extraction["tables"], F.array().cast("array<struct<caption:string,columns:array<string>,rows:array<array<string>>>>")),
                         lambda t: F.concat_ws("\n\n", F.concat(F.lit("### "), t["caption"]), markdown_table(t["columns"], t["rows"])))
    return F.concat_ws("\n\n", title, failed, text, F.nullif(F.array_join(tables, "\n\n"), F.lit("")), layer)
