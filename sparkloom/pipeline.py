"""The three runs of the lakehouse: files to units and chunks, chunks to vectors, question to cited passages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.common import cut
from sparkloom.functions.text import is_blank, token_jaccard
from sparkloom.operators import catalog, chunking, routing, vectors, versioning
from sparkloom.operators import pages as page_ops
from sparkloom.sources import archives, corpus, detect, readers

Render = Callable[[bytes, int], bytes]
Send = Callable[[bytes], tuple[int, str, str]]


def run(spark: SparkSession, root: str, scopes: DataFrame | None = None, whole_categories: list[str] | None = None, config: str = "cfg", size: int = 1000, overlap: int = 120, vision: tuple[Render, Send] | None = None, limit: int = corpus.CONTENT_LIMIT, prior: DataFrame | None = None, ordinal: int = 1, settings: dict[str, dict] | None = None, force: bool = False) -> dict[str, DataFrame]:
    """Walk a corpus, identify, deduplicate within scopes, route and read.

    Returns the tables ``records`` (one row per file: scope, content, route,
    status, error), ``members`` (of archives), ``member_records`` (as records,
    one row per member at every depth, path ``archive!member``), ``units``,
    ``cells``, ``pages`` (with their kind), ``vision`` and ``chunks``. Members take the scope of their
    archive and are identified, deduplicated, routed and read with the files,
    which come first, then members by depth. Every file and member has a record,
    unscoped, empty and unreadable ones too; one bad file never stops the others.
    ``prior`` are the manifest entries of earlier sealed runs. Work (a content
    of a scope on its route) whose latest outcome stands, under the same
    settings, is not done again: its record says so (``decision``), its
    outputs are those of the version named there. ``manifest`` holds the
    run's own entries, one for each piece of work that was done, ``run_ordinal``
    and all. ``force`` does everything again.

    Files of more than ``limit`` bytes are hashed and identified where they lie
    and recorded as CONTENT_TOO_LARGE.

    A PDF with a scanned or mixed page takes the route pdf_vision. ``vision``
    is the injected pair that draws a page (PDF, page number) and sends the
    image; the replies are in the table vision, a page's own text beside them
    where they do not say the same. A page that fails makes its file partial,
    and without vision the file is partial and its record names the pages.
    The text layer of every page goes into chunks, transcriptions do not.
    """
    files = corpus.corpus_files(spark, root)
    scopes = catalog.discover_scopes(files, whole_categories or []).withColumn("scope_id", catalog.scope_id(F.col("category"), F.col("client"))) if scopes is None else scopes
    content = cut(corpus.with_content(files, root, limit), "run-content").withColumns({"name": F.col("path"), "depth": F.lit(0)})
    # Files that could not be walked or opened: a record each, nothing else.
    unread = files.where("failure is not null").select(F.col("relative_path").alias("path"), "failure").unionByName(content.where("failure is not null").select("path", "failure"))
    content = content.where("failure is null").drop("failure")
    scope_of = catalog.resolve_paths(files, scopes).select(F.col("relative_path").alias("path"), F.col("resolved_scope").alias("scope_id"))
    owned = _identified(content).join(scope_of, "path", "left").withColumns({"archive_path": F.lit(None).cast("string"), "member_path": F.lit(None).cast("string")})
    owned = cut(owned, "run-files")
    # Archives are opened once, to their full depth under one budget; an archive inside one is a member like the others.
    roots = _with_first(owned).where("path = first_path and route = 'archive'")
    found = cut(archives.archive_contents(roots.select("path").join(content, "path")), "run-members")
    members = found.select(*[c.split()[0] for c in archives.MEMBERS.split(", ")])
    inner = found.where("failure is null").select(F.col("file_path").alias("path"), "content", "content_sha256", F.lit(None).cast("string").alias("location"), "name", "depth")
    lineage = found.where("failure is null").select(F.col("file_path").alias("path"), F.col("path").alias("archive_path"), "member_path")
    inside = _identified(inner).join(lineage, "path").join(owned.select(F.col("path").alias("archive_path"), "scope_id"), "archive_path")
    # The first path of a content in a scope is read, the others are duplicates: before any reader runs.
    known = cut(_with_first(owned.unionByName(inside)), "run-routed")
    prints = routing.route_fingerprints({"chunking": {"size": size, "overlap": overlap, "config": config}, "vision": {"enabled": vision is not None}} | (settings or {}))
    print_of = F.create_map(*[F.lit(x) for kv in prints.items() for x in kv])
    firsts = known.where("path = first_path").select("path", "scope_id", "content_sha256", "family", "route")
    decided = cut(_decided(firsts, print_of, prior, force), "run-decided")
    fresh = decided.where("decision <> 'reuse'").select("path", "scope_id", "content_sha256", "family", "route")
    work = fresh.join(content.select("path", "content").unionByName(inner.select("path", "content")), "path")
    large = fresh.join(content.where("content is null").select("path"), "path").where(~F.col("route").isin("no_reader", "non_data"))
    large = large.select("path", F.lit("CONTENT_TOO_LARGE").alias("error_category"), F.lit(f"more than {limit} bytes; identified and recorded, not read").alias("error_message"))
    work = work.where("content is not null")
    units = cut(readers.read_units(work.where(F.col("route").isin("text_extract", "structured"))), "run-units")
    cells = cut(readers.read_cells(work.where("route in ('tabular_parquet', 'structured')")), "run-cells")
    read = readers.read_pages(work.where("route = 'pdf_text'"))
    pages = cut(read.withColumn("kind", F.when(F.col("error_category").isNull(), page_ops.page_kind(F.col("character_count"), F.col("image_coverage")))), "run-pages")
    seen = cut(_transcribed(pages.where(F.col("kind").isin("scanned", "mixed")), work, vision), "run-vision")
    unseen = F.sort_array(F.collect_list(F.when(F.col("failure").isNotNull(), F.col("number"))))
    sighted = seen.groupBy("path").agg(unseen.alias("_unseen"), F.min_by("failure", F.when(F.col("failure").isNotNull(), F.col("number"))).alias("_why"))
    text_pages = pages.where("error_category is null").select(
        "path", F.lit("page").alias("unit_type"), F.format_string("page:%d", "number").alias("unit_ref"), F.col("number").alias("unit_sequence"), "text"
    )
    all_units = units.where("error_category is null").select("path", "unit_type", "unit_ref", F.col("sequence").alias("unit_sequence"), "text").unionByName(text_pages)
    ready = all_units.join(fresh.select("path", "scope_id", "content_sha256"), "path")
    chunks = chunking.number_chunks(chunking.split_units(ready, size, overlap), config)
    errors = large
    for t in (units, cells, pages):
        errors = errors.unionByName(t.where("error_category is not null").select("path", "error_category", "error_message"))
    # A failure counts for the archive and for every archive inside it that holds the member.
    steps = F.split(F.col("file_path"), "!")
    holders = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "!"))
    broken = (
        found.where("failure is not null").select(F.col("path").alias("_root"), F.explode(holders).alias("path"))
        .where(F.length("path") >= F.length("_root")).groupBy("path").agg(F.count(F.lit(1)).alias("_n"))
    )
    status = (
        F.when(F.col("scope_id").isNull(), "failed").when(F.col("path") != F.col("first_path"), "skipped_duplicate").when(F.col("terminal_status").isNotNull(), F.col("terminal_status"))
        .when(F.col("_e.error_category") == "NO_COMPATIBLE_READER", "no_reader").when(F.col("_e.error_category").isNotNull(), "failed").when(F.col("_n").isNotNull(), "partial")
        .when(F.size("_unseen") > 0, "partial").when(F.col("route") == "vision_image", "partial").otherwise("success")
    )
    category = F.when(F.col("scope_id").isNull(), "UNSCOPED_PATH").otherwise(F.coalesce("error_category", "_e.error_category", F.when(F.size("_unseen") > 0, "API_ERROR")))
    pages_left = F.when(F.size("_unseen") > 0, F.concat(F.lit("pages without transcription: "), F.array_join(F.col("_unseen").cast("array<string>"), ", "), F.lit(": "), F.col("_why")))
    route = F.when(F.col("_unseen").isNotNull(), "pdf_vision").otherwise(F.col("route"))
    one = errors.groupBy("path").agg(F.min(F.struct("error_category", "error_message")).alias("_e"))
    kept = decided.select("path", "decision", "prior_status", "prior_route", "prior_version")
    reused = F.col("decision") == "reuse"
    told = known.join(one, "path", "left").join(broken, "path", "left").join(sighted, "path", "left").join(kept, "path", "left").select(
        "path", "scope_id", "content_sha256", "family", F.when(reused, F.col("prior_route")).otherwise(route).alias("route"),
        F.when(reused, F.col("prior_status")).otherwise(status).alias("status"), F.when(~F.coalesce(reused, F.lit(False)), category).alias("error_category"),
        F.coalesce("_e.error_message", pages_left).alias("error_message"), "decision", "prior_version",
        "archive_path", "member_path", "depth",
    )
    told = cut(told, "run-records")
    paths = told.where("scope_id is not null").groupBy("scope_id", "content_sha256").agg(F.sort_array(F.collect_set("path")).alias("source_paths"))
    done = told.where("decision is not null and decision <> 'reuse'").join(paths, ["scope_id", "content_sha256"])
    manifest = done.select(
        "scope_id", F.col("content_sha256").alias("content_hexdigest"), "route", F.element_at(print_of, F.col("route")).alias("route_fingerprint"),
        versioning.version_id(F.lit(ordinal)).alias("version_id"), F.lit(ordinal).alias("run_ordinal"), "status", "source_paths",
    )
    records, member_records = told.where("depth = 0").drop("archive_path", "member_path", "depth"), told.where("depth > 0")
    none = {c: F.lit(None).cast("string") for c in ("content_sha256", "family")}
    records = records.unionByName(unread.join(scope_of, "path", "left").select(
        "path", "scope_id", *[c.alias(n) for n, c in none.items()], F.lit("no_reader").alias("route"), F.lit("failed").alias("status"),
        F.lit("FILE_ACCESS_ERROR").alias("error_category"), F.col("failure").alias("error_message"),
        F.lit(None).cast("string").alias("decision"), F.lit(None).cast("string").alias("prior_version"),
    ))
    return {"records": records, "members": members, "member_records": member_records, "units": units, "cells": cells, "pages": pages, "vision": seen, "chunks": chunks, "manifest": manifest}


#: Routes under which work may have been recorded that is now on the first.
REDIRECTED = {"pdf_text": "pdf_vision"}


def _decided(firsts: DataFrame, print_of: Column, prior: DataFrame | None, force: bool) -> DataFrame:
    """firsts with the decision about each piece of work and the outcome it rests on."""
    none = F.lit(None).cast("string")
    if prior is None:
        return firsts.withColumns({"decision": F.lit("process_new"), "prior_status": none, "prior_route": none, "prior_version": none})
    work = firsts.select("scope_id", F.col("content_sha256").alias("content_hexdigest"), "route", F.element_at(print_of, F.col("route")).alias("route_fingerprint")).distinct()
    last = versioning.prior_outcome(work, versioning.latest_outcome(prior), REDIRECTED)
    # The settings in force are those of the route under which the work was done.
    now = F.element_at(print_of, F.coalesce("prior_route", "route"))
    decision = versioning.reuse_decision(F.col("prior_status"), F.col("prior_fingerprint"), now, force=force)
    last = last.select("scope_id", F.col("content_hexdigest").alias("content_sha256"), "route", decision.alias("decision"), "prior_status", "prior_route", versioning.version_id(F.col("prior_run")).alias("prior_version"))
    return firsts.join(last, ["scope_id", "content_sha256", "route"], "left").withColumn("decision", F.coalesce("decision", F.lit("process_new")))


def summary(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: what a run did, counted over files and members alike."""
    told = tables["records"].withColumn("_m", F.lit(0)).unionByName(tables["member_records"].drop("archive_path", "member_path", "depth").withColumn("_m", F.lit(1)))
    count = lambda c: F.count(F.when(c, 1))
    is_ = lambda *s: F.col("status").isin(*s)
    one = told.agg(
        count(F.col("_m") == 0).alias("n_files"), count(F.col("_m") == 1).alias("n_members"), count(is_("success")).alias("n_success"), count(is_("partial")).alias("n_partial"), count(is_("locked")).alias("n_locked"),
        count(is_("failed")).alias("n_failed"), count(is_("no_reader")).alias("n_no_reader"), count(is_("excluded_non_data")).alias("n_excluded"), count(is_("skipped_duplicate")).alias("n_duplicates"),
        count(F.col("decision") == "reuse").alias("n_reused"), count(F.col("error_category") == "UNSCOPED_PATH").alias("n_unscoped"), F.count_distinct("scope_id").alias("n_scopes"),
    )
    for name, t, cond in (("n_chunks", "chunks", F.lit(True)), ("n_pages", "pages", F.col("error_category").isNull()), ("n_pages_unseen", "vision", F.col("failure").isNotNull()), ("n_tables", None, None)):
        if t:
            one = one.crossJoin(tables[t].agg(count(cond).alias(name)))  # one row by one row
        else:
            one = one.crossJoin(tables["cells"].where("table_name is not null").agg(F.count_distinct("path", "table_name").alias(name)))
    return one


def _identified(content: DataFrame) -> DataFrame:
    """Probe, route, hash and depth of each row of content (path, name, content, content_sha256, depth); the name is the file's own, without its archive."""
    probes = detect.detect_files(content, "name", "location")
    return routing.select_routes(probes).join(content.select("path", "content_sha256", "depth"), "path")


def _with_first(owned: DataFrame) -> DataFrame:
    """owned with ``first_path``: the path of least depth (ties: path) that holds the content in the scope."""
    first = owned.where("scope_id is not null").groupBy("scope_id", "content_sha256").agg(F.min_by("path", F.struct("depth", "path")).alias("first_path"))
    return owned.join(first, ["scope_id", "content_sha256"], "left")


VISION = "path string, number int, kind string, reply string, native_text string, failure string"


def _transcribed(wanted: DataFrame, work: DataFrame, vision: tuple[Render, Send] | None) -> DataFrame:
    """VISION of pages (path, number, kind, text): the reply, the page's own text where the reply does not say the same, or why there is none."""
    if vision is None:
        none = F.lit(None).cast("string")
        return wanted.select("path", "number", "kind", none.alias("reply"), F.nullif("text", F.lit("")).alias("native_text"), F.lit("the vision route is disabled").alias("failure"))
    render, send = vision

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, numbers, raw in zip(b["path"], b["numbers"], b["content"], strict=True):
                for n in numbers:
                    try:
                        image, failure = render(bytes(raw), int(n)), None
                    except Exception as e:  # noqa: BLE001 - the boundary of one page
                        image, failure = None, f"{type(e).__name__}: {e}"[:500]
                    yield pd.DataFrame({"path": [path], "number": [n], "image_id": [f"{n}:{path}"], "payload": [image], "undrawn": [failure]})

    asked = wanted.groupBy("path").agg(F.sort_array(F.collect_list("number")).alias("numbers")).join(work.select("path", "content"), "path")
    images = cut(asked.select("path", "numbers", "content").mapInPandas(draw, "path string, number int, image_id string, payload binary, undrawn string"), "run-images")
    replies = page_ops.transcribe(images.where("payload is not null"), send).select("image_id", "reply", "failure")
    both = wanted.join(images.drop("payload"), ["path", "number"]).join(replies, "image_id", "left")
    same = token_jaccard(F.col("text"), F.coalesce(F.get_json_object("reply", "$.visible_text"), F.lit("")))
    return both.select("path", "number", "kind", "reply", page_ops.keep_native(F.col("text"), same).alias("native_text"), F.coalesce("undrawn", "failure").alias("failure"))


def publish(tables: dict[str, DataFrame], out: str, ordinal: int) -> None:
    """Write a run's tables as version r%06d below ``out``; nothing that exists is written over.

    The manifest is written after the outputs it speaks of, and the seals last:
    one row for each scope with the hash of its entries, or one of no scope for
    a run without entries. A run without seals never happened.
    """
    version = f"r{ordinal:06d}"
    for name in sorted(tables, key=lambda n: n == "manifest"):
        tables[name].write.mode("errorifexists").parquet(f"{out}/{name}/version={version}")
    spark = next(iter(tables.values())).sparkSession
    if "manifest" in tables:
        seals = versioning.seal_body(spark.read.parquet(f"{out}/manifest/version={version}"))
    else:
        seals = spark.createDataFrame([], "scope_id string, n_entries bigint, body_sha256 string")
    whole = spark.createDataFrame([(None, None, None)], "scope_id string, n_entries bigint, body_sha256 string")
    seals.unionByName(whole).select(F.lit(ordinal).alias("run_ordinal"), F.lit(version).alias("version"), "scope_id", "n_entries", "body_sha256").write.mode("errorifexists").parquet(f"{out}/seals/run={ordinal}")


def sealed_manifest(spark: SparkSession, out: str) -> DataFrame | None:
    """The manifest entries of all sealed runs below ``out``, None if there are none. Entries that do not hash to their seal raise: a manifest is never trusted unread."""
    try:
        seals = spark.read.parquet(f"{out}/seals").select(F.col("run_ordinal"), "version", "scope_id", "n_entries", "body_sha256")
    except AnalysisException:
        return None
    runs = [r.run_ordinal for r in seals.select("run_ordinal").distinct().collect()]  # one number a run
    try:
        entries = spark.read.parquet(f"{out}/manifest").where(F.col("run_ordinal").isin(runs)).drop("version")
    except AnalysisException:
        return None
    have = None
    for n in runs:
        body = versioning.seal_body(entries.where(F.col("run_ordinal") == n)).withColumn("run_ordinal", F.lit(n))
        have = body if have is None else have.unionByName(body)
    want = seals.where("scope_id is not null").select("run_ordinal", "scope_id", F.col("n_entries").alias("_n"), F.col("body_sha256").alias("_h"))
    bad = want.join(have, ["run_ordinal", "scope_id"], "full_outer").where(~(F.col("n_entries").eqNullSafe(F.col("_n")) & F.col("body_sha256").eqNullSafe(F.col("_h"))))
    if not bad.isEmpty():
        raise ValueError("a manifest does not agree with its seal")
    return entries


def active_chunks(spark: SparkSession, out: str, entries: DataFrame) -> DataFrame:
    """The chunks of the versions that are active: of each piece of work those of its latest successful (or partial) run."""
    active = versioning.latest_outcome(entries.where("status in ('success', 'partial')")).select("scope_id", F.col("content_hexdigest").alias("content_sha256"), F.col("version_id").alias("version")).distinct()
    newest = active.groupBy("scope_id", "content_sha256").agg(F.max("version").alias("version"))
    return spark.read.parquet(f"{out}/chunks").join(newest, ["scope_id", "content_sha256", "version"], "left_semi").drop("version")


def build_index(chunks: DataFrame, encode=None) -> DataFrame:
    """Vectors of the chunks that are not blank, numbered within their scope."""
    rows = vectors.index_rows(chunks.where(~is_blank(F.col("text"))).dropDuplicates(["chunk_id"]))
    return vectors.embed(rows, encode or vectors.character_embedder())


def ask(index: DataFrame, question: str, k: int = 5, encode=None, **filters) -> DataFrame:
    """The k passages nearest to a question, with scores."""
    return vectors.search(index, (encode or vectors.character_embedder())([question])[0], k, **filters)


def next_version(entries: DataFrame, seals: DataFrame) -> str:
    return versioning.next_ordinal(entries, seals).select(versioning.version_id(F.col("next_ordinal")).alias("v")).first().v
