"""What a file is and which way it takes: names, text probes, routes, terminal outcomes."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Closed vocabularies and lookup tables.
NON_DATA_NAMES = ("thumbs.db", "desktop.ini", ".ds_store")
NON_DATA_EXTENSIONS = (".lnk", ".css", ".js", ".thmx", ".tmp", ".url")
EXECUTABLE_EXTENSIONS = (".exe", ".bat", ".sh", ".cmd", ".com", ".scr", ".msi")
UNREADABLE_EXTENSIONS = (".1800", ".900", ".001", ".tsf")
EXPECTED_EXTENSIONS = {
    "spreadsheet_ooxml": (".xlsx", ".xlsm", ".xltx", ".xltm"),
    "spreadsheet_biff": (".xls", ".xlt", ".xlk"),
    "spreadsheet_xlsb": (".xlsb",),
    "word_ooxml": (".docx", ".docm", ".dotx"),
    "word_ole": (".doc", ".dot"),
    "presentation_ooxml": (".pptx", ".pptm"),
    "pdf": (".pdf",),
    "image": (".jpg", ".jpeg", ".png", ".bmp", ".gif", ".tif", ".tiff"),
    "rtf": (".rtf",),
    "html": (".htm", ".html", ".xhtml"),
    "xml": (".xml", ".xsd", ".xsl"),
    "json": (".json",),
    "email": (".eml", ".msg"),
    "archive_zip": (".zip", ".jar"),
    "archive_7z": (".7z",),
    "archive_rar": (".rar",),
    "archive_gzip": (".gz", ".gzip", ".emz", ".tgz"),
    "encrypted_ooxml": (".xlsx", ".xlsm", ".docx", ".pptx"),
}
ROUTES = {
    "spreadsheet_ooxml": "tabular_parquet", "spreadsheet_biff": "tabular_parquet", "spreadsheet_xlsb": "tabular_parquet", "delimited_text": "tabular_parquet",
    "image": "vision_image", "word_ooxml": "text_extract", "presentation_ooxml": "text_extract", "rtf": "text_extract", "html": "text_extract",
    "plain_text": "text_extract", "email": "text_extract", "json": "structured", "xml": "structured", "archive_zip": "archive", "archive_7z": "archive",
    "archive_gzip": "archive", "pdf": "pdf_text",
}
TERMINAL = {
    "encrypted_ooxml": ("no_reader", "locked", "PASSWORD_PROTECTED_FILE"),
    "encrypted_ole": ("no_reader", "locked", "PASSWORD_PROTECTED_FILE"),
    "tally_binary": ("no_reader", "no_reader", "NO_COMPATIBLE_READER"),
    "java_serialized": ("no_reader", "no_reader", "NO_COMPATIBLE_READER"),
    "keystore": ("no_reader", "no_reader", "NO_COMPATIBLE_READER"),
    "unknown": ("no_reader", "no_reader", "NO_COMPATIBLE_READER"),
    "non_data_artifact": ("non_data", "excluded_non_data", "NON_DATA_ARTIFACT"),
    "executable": ("non_data", "excluded_non_data", "EXECUTABLE_NOT_PROCESSED"),
    "empty": ("non_data", "excluded_non_data", "EMPTY_FILE"),
}
OPTIONAL = {"archive_rar": ("archive", "unrar"), "word_ole": ("text_extract", "soffice")}
ROUTE_SECTIONS = {
    "tabular_parquet": ("tabular",), "pdf_text": ("pdf", "text", "chunking"), "pdf_vision": ("pdf", "vision"), "text_extract": ("text", "chunking"),
    "structured": ("structured", "tabular", "chunking"), "vision_image": ("vision",), "archive": ("archive",), "no_reader": ("detection",), "non_data": ("detection",),
}


def non_data_class(name: Column, extension: Column) -> Column:
    """non_data_artifact, executable or null, from the name alone."""
    return (
        F.when(F.lower(name).isin(*NON_DATA_NAMES), "non_data_artifact")
        .when(name.startswith("~$") | name.startswith("._"), "non_data_artifact")
        .when(extension.isin(*NON_DATA_EXTENSIONS), "non_data_artifact")
        .when(extension.isin(*EXECUTABLE_EXTENSIONS), "executable")
    )


def text_family(text: Column) -> Column:
    """Family of a decoded text: json, html, xml, email, delimited_text or plain_text. The JSON and delimiter tests are structural.

    Delimited: at least two of the first eight lines are not blank and all of them have the same number, at
    least one, of the first of , ; tab | that qualifies.
    """
    s = F.regexp_replace(text, "^[﻿ \\t\\r\\n]+", "")
    head = F.lower(F.substring(s, 1, 512))
    lines = F.filter(F.slice(F.split(s, r"\r\n|\r|\n"), 1, 8), lambda x: F.trim(x) != "")

    def even(d: str) -> Column:
        n = F.transform(lines, lambda x: F.length(x) - F.length(F.replace(x, F.lit(d), F.lit(""))))
        return (F.size(lines) >= 2) & (F.array_min(n) >= 1) & (F.array_min(n) == F.array_max(n))

    return (
        F.when(s == "", "plain_text")
        .when(s.rlike(r"^[{\[]") & (F.get_json_object(s, "$").isNotNull() | ~F.rtrim(s).rlike(r"[}\]]$")), "json")
        .when(s.startswith("<"), F.when(head.startswith("<!doctype html") | head.contains("<html"), "html").otherwise("xml"))
        .when(head.rlike(r"^(from|received|return-path|message-id):"), "email")
        .when(even(",") | even(";") | even("\t") | even("|"), "delimited_text")
        .otherwise("plain_text")
    )


def expected_extensions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f, e) for f, es in EXPECTED_EXTENSIONS.items() for e in es], "family string, extension string")


def extension_conflicts(probes: DataFrame) -> DataFrame:
    """probes (…, family, extension) whose extension is not one of their family's. Families without a list and empty extensions never conflict."""
    known = expected_extensions(probes.sparkSession)  # a fixed table of a few dozen rows
    listed = probes.where(F.col("family").isin(*EXPECTED_EXTENSIONS) & (F.col("extension") != ""))
    return listed.join(F.broadcast(known), ["family", "extension"], "left_anti")


def route_table(spark: SparkSession, tools: tuple[str, ...] = ()) -> DataFrame:
    """(family, route, terminal_status, error_category) of every family."""
    rows = [(f, r, None, None) for f, r in ROUTES.items()] + [(f, *t) for f, t in TERMINAL.items()]
    for f, (route, tool) in OPTIONAL.items():
        rows.append((f, route, None, None) if tool in tools else (f, "no_reader", "no_reader", "NO_COMPATIBLE_READER"))
    return spark.createDataFrame(rows, "family string, route string, terminal_status string, error_category string")


def select_routes(probes: DataFrame, tools: tuple[str, ...] = ()) -> DataFrame:
    """probes with their route; a family without a route is an error, never a silent fall-through."""
    routed = probes.join(F.broadcast(route_table(probes.sparkSession, tools)), "family", "left")
    return routed.withColumn("route", F.when(F.col("route").isNull(), F.raise_error(F.concat(F.lit("no route for family "), F.coalesce("family", F.lit("null"))))).otherwise(F.col("route")))


def canonical_json(section: dict) -> str:
    """Settings as text that does not depend on order or on float noise."""
    def plain(v):
        if isinstance(v, float):
            return round(v, 6)
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v

    return json.dumps(plain(section), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def section_fingerprint(name: str, section: dict) -> str:
    return hashlib.sha256(f"{name}:{canonical_json(section)}".encode()).hexdigest()[:16]


def route_fingerprints(settings: dict[str, dict]) -> dict[str, str]:
    """Per route the fingerprint of the settings that bear on its outputs."""
    return {
        route: hashlib.sha256("\x00".join(section_fingerprint(s, settings.get(s, {})) for s in sections).encode()).hexdigest()[:16]
        for route, sections in ROUTE_SECTIONS.items()
    }
