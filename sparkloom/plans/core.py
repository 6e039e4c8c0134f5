"""Queries of the catalog, versioning, routing, text, page, table and vector operators, with the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.common import load
from sparkloom.functions import text as T
from sparkloom.plans import format_sql
from sparkloom.operators import catalog, chunking, pages, routing, tables, vectors, versioning

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if it has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- catalog ------------------------------------------------------------------------------------

_SLUG = "coalesce(nullif(regexp_replace(substr(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 40), '_+$', ''), ''), 'unnamed')"


@query("SELECT category, client, " + _SLUG.format(x="category") + " || '__' || " + _SLUG.format(x="client") + " || '__' || substr(sha1(category || chr(0) || client), 1, 12) AS computed_id, true AS same FROM scopes")
def scope_ids(spark: SparkSession, d: str) -> DataFrame:
    s = load(spark, d, "scopes").withColumn("computed_id", catalog.scope_id(F.col("category"), F.col("client")))
    return s.select("category", "client", "computed_id", (F.col("computed_id") == F.col("scope_id")).alias("same"))


@query("SELECT doc_id, sha256(text) AS sha, sha256(text) = lower(content_sha256) AS same FROM documents WHERE text IS NOT NULL")
def content_hash(spark, d):
    return load(spark, d, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("sha"), (F.sha2("text", 256) == F.lower("content_sha256")).alias("same"))


@query("""
SELECT DISTINCT split_part(relative_path, '/', 1) AS category, split_part(relative_path, '/', 2) AS client,
       split_part(relative_path, '/', 1) || '/' || split_part(relative_path, '/', 2) AS scope_root, false AS category_is_scope
FROM sources WHERE len(string_split(relative_path, '/')) > 2
""")
def scope_discovery(spark, d):
    return catalog.discover_scopes(load(spark, d, "sources"), [])


@query("""
WITH p AS (SELECT DISTINCT relative_path FROM sources WHERE relative_path IS NOT NULL),
s AS (SELECT scope_root, min(scope_id) AS scope_id FROM scopes GROUP BY 1),
h AS (SELECT p.relative_path, arg_max(s.scope_id, length(s.scope_root)) AS r FROM p JOIN s
      ON p.relative_path = s.scope_root OR starts_with(p.relative_path, s.scope_root || '/') GROUP BY 1)
SELECT p.relative_path, h.r AS resolved_scope FROM p LEFT JOIN h USING (relative_path)
""")
def scope_resolve(spark, d):
    return catalog.resolve_paths(load(spark, d, "sources"), load(spark, d, "scopes"))


_DEDUP = """
WITH p AS (SELECT scope_id, content_sha256, relative_path, min(ord) AS ord FROM sources
           WHERE scope_id IS NOT NULL AND content_sha256 IS NOT NULL GROUP BY ALL)
SELECT scope_id, content_sha256, min(ord) AS first_ord, arg_min(relative_path, ord) AS first_path, count(*) AS n_paths, count(*) - 1 AS n_duplicates
FROM p GROUP BY 1, 2
"""


@query(_DEDUP)
def scope_dedup(spark, d):
    return catalog.dedup_in_scope(load(spark, d, "sources"))


@query("""
WITH s AS (SELECT DISTINCT ON (ord) scope_id, content_sha256, relative_path, ord FROM sources WHERE scope_id IS NOT NULL AND content_sha256 IS NOT NULL)
SELECT scope_id, content_sha256, relative_path, ord,
       CASE WHEN row_number() OVER (PARTITION BY scope_id, content_sha256 ORDER BY ord) = 1 THEN 'first'
            WHEN row_number() OVER (PARTITION BY scope_id, content_sha256, relative_path ORDER BY ord) > 1 THEN 'repeat' ELSE 'duplicate' END AS outcome
FROM s
""")
def dedup_outcomes(spark, d):
    return catalog.dedup_outcomes(load(spark, d, "sources"))


@query("SELECT CAST(count(*) AS BIGINT) AS n_items, CAST(sum(n_duplicates) AS BIGINT) AS n_duplicate_paths FROM (" + _DEDUP + ")")
def dedup_report(spark, d):
    return catalog.dedup_in_scope(load(spark, d, "sources")).agg(F.count(F.lit(1)).alias("n_items"), F.sum("n_duplicates").alias("n_duplicate_paths"))


@query("""
WITH s AS (SELECT DISTINCT scope_id, relative_path, archive_chain, content_sha256, size_bytes FROM sources),
k AS (SELECT scope_id, content_sha256, max(size_bytes) AS b FROM s GROUP BY 1, 2)
SELECT scope_id, count(*) AS n_before, CAST(sum(coalesce(s.size_bytes, 0)) AS BIGINT) AS bytes_before,
       (SELECT count(*) FROM k WHERE k.scope_id IS NOT DISTINCT FROM s.scope_id) AS n_after, (SELECT CAST(sum(coalesce(b, 0)) AS BIGINT) FROM k WHERE k.scope_id IS NOT DISTINCT FROM s.scope_id) AS bytes_after
FROM s GROUP BY 1
""")
def dedup_bytes(spark, d):
    return catalog.dedup_bytes(load(spark, d, "sources"))


@query("""
SELECT DISTINCT relative_path, array_to_string(list_transform(archive_chain, lambda x: x.archive_hash || '!' || x.member_path), '|') AS chain,
       CASE WHEN len(archive_chain) > 0 THEN regexp_extract(archive_chain[len(archive_chain)].member_path, '([^/]*)$', 1)
            ELSE regexp_extract(relative_path, '([^/]*)$', 1) END AS display_name,
       CASE WHEN len(archive_chain) > 0 THEN regexp_extract(archive_chain[len(archive_chain)].member_path, '([^/]*)$', 1)
            ELSE regexp_extract(relative_path, '([^/]*)$', 1) END || '.format.md' AS companion
FROM sources
""")
def companion_paths(spark, d):
    path, chain = F.col("relative_path"), F.col("archive_chain")
    return load(spark, d, "sources").select(
        path, catalog.archive_chain(chain).alias("chain"), catalog.display_name(path, chain).alias("display_name"), catalog.companion_name(path, chain).alias("companion")
    ).distinct()


@query("""
SELECT DISTINCT relative_path, """ + _SLUG.format(x="relative_path") + """ || '__' || substr(sha1(relative_path || chr(0) ||
       array_to_string(list_transform(archive_chain, lambda x: x.archive_hash || '!' || x.member_path), '|')), 1, 10) AS path_slug FROM sources
""")
def path_slugs(spark, d):
    return load(spark, d, "sources").select("relative_path", catalog.path_slug(F.col("relative_path"), F.col("archive_chain")).alias("path_slug")).distinct()


_ROOTS = """
SELECT DISTINCT regexp_replace(relative_path, '/[^/]*/[^/]*$', '') AS bundle_root FROM sources m
WHERE lower(relative_path) LIKE '%.eml' AND len(string_split(relative_path, '/')) > 2
"""
_BUNDLES = """
WITH m AS (""" + _ROOTS + """),
c AS (SELECT DISTINCT relative_path FROM sources WHERE lower(relative_path) LIKE '%.xlsx')
SELECT bundle_root FROM m WHERE EXISTS (SELECT 1 FROM c WHERE starts_with(c.relative_path, m.bundle_root || '/'))
"""


@query(_BUNDLES)
def bundle_roots(spark, d):
    """Folders that hold a message two levels below and a workbook anywhere below: the bundle rule with file types this corpus has."""
    return catalog.bundle_roots(load(spark, d, "sources"), ".eml", ".xlsx")


_SPLIT = "WITH r AS (" + _BUNDLES + """), p AS (SELECT DISTINCT relative_path FROM sources WHERE relative_path IS NOT NULL)
SELECT relative_path, EXISTS (SELECT 1 FROM r WHERE p.relative_path = r.bundle_root OR starts_with(p.relative_path, r.bundle_root || '/')) AS in_bundle FROM p"""


@query(_SPLIT)
def bundle_exclude(spark, d):
    s = load(spark, d, "sources")
    return catalog.split_by_bundles(s, catalog.bundle_roots(s, ".eml", ".xlsx"))


@query("SELECT relative_path FROM (" + _SPLIT + ") WHERE NOT in_bundle")
def except_bundle(spark, d):
    return bundle_exclude(spark, d).where("not in_bundle").select("relative_path")


@query("SELECT DISTINCT scope_id, relative_path FROM sources")
def distinct_paths(spark, d):
    return load(spark, d, "sources").select("scope_id", "relative_path").distinct()


def _count_by(table: str, column: str):
    sql = f"SELECT {column} AS value, count(*) AS n FROM {table} GROUP BY 1"

    def run(spark, d):
        return load(spark, d, table).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))

    return run, sql


for _name, _table, _column in (
    ("count_by_category", "chunks", "category"), ("count_by_family", "documents", "family"), ("count_by_route", "manifest_entries", "route"),
    ("count_by_status", "manifest_entries", "status"), ("count_by_unit_type", "chunks", "unit_type"), ("count_by_failure", "vision_pages", "failure"),
):
    QUERIES[_name], ORACLES[_name] = _count_by(_table, _column)

_EXT = "lower(regexp_extract(regexp_extract(relative_path, '([^/]*)$', 1), '^.+(\\.[^.]+)$', 1))"


@query(f"SELECT {_EXT} AS extension, count(*) AS n FROM sources GROUP BY 1")
def count_by_extension(spark, d):
    return load(spark, d, "sources").groupBy(catalog.extension(F.col("relative_path")).alias("extension")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT {_EXT} AS extension, count(*) AS n FROM sources GROUP BY 1 ORDER BY n DESC, extension LIMIT 15")
def top_extensions(spark, d):
    return count_by_extension(spark, d).orderBy(F.desc("n"), "extension").limit(15)


@query("""
SELECT archive_hash, ord, bytes, total_bytes, n_members,
       CASE WHEN n_members > 3 THEN 'ARCHIVE_MEMBER_LIMIT_EXCEEDED' WHEN total_bytes > 12000 THEN 'ARCHIVE_SIZE_LIMIT_EXCEEDED' END AS failure
FROM (SELECT archive_hash, ord, bytes, CAST(sum(coalesce(bytes, 0)) OVER w AS BIGINT) AS total_bytes, count(*) OVER w AS n_members
      FROM (SELECT DISTINCT archive_chain[1].archive_hash AS archive_hash, ord, size_bytes AS bytes FROM sources WHERE len(archive_chain) > 0)
      WINDOW w AS (PARTITION BY archive_hash ORDER BY ord ROWS UNBOUNDED PRECEDING))
""")
def archive_budget(spark, d):
    s = load(spark, d, "sources").where(F.size("archive_chain") > 0)
    m = s.select(F.col("archive_chain")[0]["archive_hash"].alias("archive_hash"), "ord", F.col("size_bytes").alias("bytes")).distinct()
    return catalog.archive_budget(m, 12_000, 3)


_ODD = ("CASE doc_id % 5 WHEN 0 THEN '../' || relative_path WHEN 1 THEN 'C:/' || relative_path WHEN 2 THEN relative_path || '/nul.txt' WHEN 3 THEN replace(relative_path, '/', chr(92)) ELSE relative_path END")


@query(f"""
SELECT doc_id, member, coalesce(member, '') <> '' AND NOT starts_with(replace(member, chr(92), '/'), '/') AND NOT regexp_matches(member, '^[A-Za-z]:')
       AND NOT list_contains(string_split(replace(member, chr(92), '/'), '/'), '..')
       AND len(list_filter(string_split(replace(member, chr(92), '/'), '/'), lambda s: regexp_matches(lower(string_split(s, '.')[1]), '^(con|prn|aux|nul|com[1-9]|lpt[1-9])$'))) = 0 AS safe
FROM (SELECT doc_id, {_ODD} AS member FROM documents WHERE relative_path IS NOT NULL)
""")
def safe_paths(spark, d):
    docs = load(spark, d, "documents").where("relative_path is not null")
    member = F.expr("CASE doc_id % 5 WHEN 0 THEN '../' || relative_path WHEN 1 THEN 'C:/' || relative_path WHEN 2 THEN relative_path || '/nul.txt' WHEN 3 THEN replace(relative_path, '/', char(92)) ELSE relative_path END")
    return docs.select("doc_id", member.alias("member")).withColumn("safe", catalog.safe_member(F.col("member")))


# --- versioning ---------------------------------------------------------------------------------

_SEALED = """(SELECT DISTINCT m.scope_id, lower(m.content_hexdigest) AS content_hexdigest, m.route, m.route_fingerprint, m.version_id, m.run_ordinal, m.status
 FROM manifest_entries m WHERE m.run_ordinal IN (SELECT run_ordinal FROM run_seals WHERE sealed_at IS NOT NULL))"""
_LATEST = "SELECT scope_id, content_hexdigest, route, e.run_ordinal AS run_ordinal, e.version_id AS version_id, e.status AS status, e.route_fingerprint AS route_fingerprint FROM (SELECT scope_id, content_hexdigest, route, max({{'run_ordinal': run_ordinal, 'version_id': version_id, 'status': status, 'route_fingerprint': route_fingerprint}}) AS e FROM {src} {where} GROUP BY 1, 2, 3)"


def _sealed(spark, d) -> DataFrame:
    return versioning.sealed_entries(load(spark, d, "manifest_entries"), load(spark, d, "run_seals"))


@query(_LATEST.format(src=_SEALED, where=""))
def latest_outcome(spark, d):
    return versioning.latest_outcome(_sealed(spark, d))


@query(_LATEST.format(src=_SEALED, where="WHERE status = 'success'"))
def resolve_active(spark, d):
    return versioning.resolve_active(_sealed(spark, d))


@query("""
SELECT scope_id, content_hexdigest, route, count(*) AS n_attempts, min(run_ordinal) AS first_run, max(run_ordinal) AS last_run,
       string_agg(status, ',' ORDER BY run_ordinal, status) AS statuses
FROM (SELECT DISTINCT scope_id, content_hexdigest, route, run_ordinal, status FROM """ + _SEALED + """) GROUP BY 1, 2, 3
""")
def history(spark, d):
    return versioning.history(_sealed(spark, d))


@query("SELECT CAST(coalesce(max(run_ordinal), 0) + 1 AS INTEGER) AS next_ordinal FROM (SELECT run_ordinal FROM manifest_entries UNION ALL SELECT run_ordinal FROM run_seals)")
def next_ordinal(spark, d):
    return versioning.next_ordinal(load(spark, d, "manifest_entries"), load(spark, d, "run_seals"))


@query("""
WITH s AS (SELECT run_ordinal FROM run_seals WHERE sealed_at IS NOT NULL), e AS (SELECT DISTINCT * FROM manifest_entries WHERE run_ordinal IN (SELECT run_ordinal FROM s)),
last AS (SELECT scope_id, max(run_ordinal) AS r FROM e GROUP BY 1)
SELECT e.scope_id, e.run_ordinal, e.route, count(*) AS n_entries FROM e JOIN last ON e.scope_id = last.scope_id AND e.run_ordinal = last.r GROUP BY ALL
""")
def manifest_active(spark, d):
    """Entries of each scope's highest sealed run, counted by route."""
    e = versioning.sealed_entries(load(spark, d, "manifest_entries"), load(spark, d, "run_seals"))
    last = e.groupBy("scope_id").agg(F.max("run_ordinal").alias("run_ordinal"))
    return e.join(last, ["scope_id", "run_ordinal"], "left_semi").groupBy("scope_id", "run_ordinal", "route").agg(F.count(F.lit(1)).alias("n_entries"))


@query("""
SELECT scope_id, run_ordinal, count(*) AS n, min(version_id) AS first_version, max(version_id) AS last_version FROM
 (SELECT scope_id, run_ordinal, version_id FROM manifest_entries WHERE run_ordinal < 20 UNION ALL SELECT scope_id, run_ordinal, version_id FROM manifest_entries WHERE run_ordinal >= 20) GROUP BY 1, 2
""")
def manifest_union(spark, d):
    m = load(spark, d, "manifest_entries").select("scope_id", "run_ordinal", "version_id")
    both = versioning.carry_forward(m.where("run_ordinal < 20"), m.where("run_ordinal >= 20"))
    return both.groupBy("scope_id", "run_ordinal").agg(F.count(F.lit(1)).alias("n"), F.min("version_id").alias("first_version"), F.max("version_id").alias("last_version"))


_PRIOR = """
WITH latest AS (""" + _LATEST.format(src=_SEALED, where="") + """),
w AS (SELECT DISTINCT scope_id, lower(content_hexdigest) AS content_hexdigest, route, route_fingerprint FROM work_queue)
SELECT w.scope_id, w.content_hexdigest, w.route, w.route_fingerprint, p.run_ordinal AS prior_run, p.status AS prior_status, p.prior_route AS prior_route, p.fp AS prior_fingerprint
FROM (SELECT w.*, max(CASE WHEN l.scope_id IS NOT NULL THEN {'run_ordinal': l.run_ordinal, 'status': l.status, 'prior_route': l.route, 'fp': l.route_fingerprint} END) AS p
      FROM w LEFT JOIN latest l ON w.scope_id = l.scope_id AND w.content_hexdigest = l.content_hexdigest
           AND (l.route = w.route OR (w.route = 'pdf_text' AND l.route = 'pdf_vision')) GROUP BY ALL) w
"""


@query(_PRIOR)
def prior_outcome(spark, d):
    return versioning.prior_outcome(load(spark, d, "work_queue"), versioning.latest_outcome(_sealed(spark, d)), {"pdf_text": "pdf_vision"})


@query("""
SELECT scope_id, content_hexdigest, route, CASE WHEN prior_status IS NULL THEN 'process_new' WHEN prior_fingerprint IS DISTINCT FROM route_fingerprint THEN 'reprocess_config_changed'
  WHEN prior_status IN ('success', 'no_reader', 'excluded_non_data', 'skipped_duplicate') THEN 'reuse' WHEN prior_status = 'locked' THEN 'reuse' ELSE 'retry' END AS decision
FROM (""" + _PRIOR + ")")
def reuse_decision(spark, d):
    p = prior_outcome(spark, d)
    decision = versioning.reuse_decision(F.col("prior_status"), F.col("prior_fingerprint"), F.col("route_fingerprint"), retry_locked=False)
    return p.select("scope_id", "content_hexdigest", "route", decision.alias("decision"))


@query("SELECT DISTINCT run_ordinal, 'r' || lpad(CAST(run_ordinal AS VARCHAR), 6, '0') AS version, run_ordinal AS parsed FROM manifest_entries")
def version_ids(spark, d):
    v = load(spark, d, "manifest_entries").select("run_ordinal").distinct().withColumn("version", versioning.version_id(F.col("run_ordinal")))
    return v.withColumn("parsed", versioning.ordinal_of(F.col("version")))


_FIELD = "CASE WHEN {c} IS NOT NULL THEN '\"{c}\":' || CAST(to_json({c}) AS VARCHAR) END"
_LINE = "'{' || concat_ws(',', " + ", ".join(_FIELD.format(c=c) for c in ("content_hexdigest", "route", "route_fingerprint", "version_id", "run_ordinal", "status", "source_paths")) + ") || '}'"
_NODE = "sha256(string_agg(h, chr(10) ORDER BY h))"


@query(f"""
WITH e AS (SELECT DISTINCT * FROM manifest_entries),
l0 AS (SELECT scope_id, content_hexdigest AS b, {_LINE} AS h FROM e),
l1 AS (SELECT scope_id, b, {_NODE} AS h, count(*) AS n FROM l0 GROUP BY 1, 2),
l2 AS (SELECT scope_id, substr(b, 1, 5) AS b, {_NODE} AS h, sum(n) AS n FROM l1 GROUP BY 1, 2),
l3 AS (SELECT scope_id, substr(b, 1, 3) AS b, {_NODE} AS h, sum(n) AS n FROM l2 GROUP BY 1, 2),
l4 AS (SELECT scope_id, substr(b, 1, 1) AS b, {_NODE} AS h, sum(n) AS n FROM l3 GROUP BY 1, 2)
SELECT scope_id, CAST(sum(n) AS BIGINT) AS n_entries, {_NODE} AS body_sha256 FROM l4 GROUP BY 1
""")
def manifest_seal(spark, d):
    return versioning.seal_body(load(spark, d, "manifest_entries").dropDuplicates())


@query("SELECT count(*) AS n_units, count(*) FILTER (status = 'success') AS n_success, count(*) FILTER (status = 'partial') AS n_partial, count(*) FILTER (status IN ('failed', 'locked')) AS n_open, count(DISTINCT scope_id) AS n_scopes FROM (" + _LATEST.format(src=_SEALED, where="") + ")")
def run_summary(spark, d):
    o = latest_outcome(spark, d)
    return o.agg(
        F.count(F.lit(1)).alias("n_units"), F.count_if(F.col("status") == "success").alias("n_success"), F.count_if(F.col("status") == "partial").alias("n_partial"),
        F.count_if(F.col("status").isin("failed", "locked")).alias("n_open"), F.count_distinct("scope_id").alias("n_scopes"),
    )


# --- routing ------------------------------------------------------------------------------------


@query("SELECT d.doc_id, d.family, CASE d.family " + " ".join(f"WHEN '{f}' THEN '{r}'" for f, r in routing.ROUTES.items()) + " END AS route FROM documents d WHERE d.family IS NOT NULL")
def route_lookup(spark, d):
    return routing.select_routes(load(spark, d, "documents").where("family is not null").select("doc_id", "family")).select("doc_id", "family", "route")


_KNOWN = " OR ".join(f"(family = '{f}' AND extension IN ({', '.join(repr(e) for e in es)}))" for f, es in routing.EXPECTED_EXTENSIONS.items())


@query(f"""
SELECT doc_id, family, extension FROM (SELECT doc_id, family, {_EXT} AS extension FROM documents)
WHERE family IN ({', '.join(repr(f) for f in routing.EXPECTED_EXTENSIONS)}) AND extension <> '' AND NOT ({_KNOWN})
""")
def extension_conflicts(spark, d):
    probes = load(spark, d, "documents").select("doc_id", "family", catalog.extension(F.col("relative_path")).alias("extension"))
    return routing.extension_conflicts(probes).select("doc_id", "family", "extension")


@query(f"""
SELECT doc_id, name, CASE WHEN lower(name) IN ('thumbs.db', 'desktop.ini', '.ds_store') OR starts_with(name, '~$') OR starts_with(name, '._') THEN 'non_data_artifact'
  WHEN ext IN ('.lnk', '.css', '.js', '.thmx', '.tmp', '.url') THEN 'non_data_artifact' WHEN ext IN ('.exe', '.bat', '.sh', '.cmd', '.com', '.scr', '.msi') THEN 'executable' END AS class
FROM (SELECT doc_id, name, lower(regexp_extract(name, '^.+(\\.[^.]+)$', 1)) AS ext FROM
  (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '~$' || n WHEN 1 THEN n || '.tmp' WHEN 2 THEN 'setup.EXE' WHEN 3 THEN 'Thumbs.db' ELSE n END AS name
   FROM (SELECT doc_id, regexp_extract(relative_path, '([^/]*)$', 1) AS n FROM documents WHERE relative_path IS NOT NULL)))
""")
def non_data_names(spark, d):
    docs = load(spark, d, "documents").where("relative_path is not null").select("doc_id", catalog.file_name(F.col("relative_path")).alias("n"))
    name = F.expr("CASE doc_id % 5 WHEN 0 THEN '~$' || n WHEN 1 THEN n || '.tmp' WHEN 2 THEN 'setup.EXE' WHEN 3 THEN 'Thumbs.db' ELSE n END")
    return docs.select("doc_id", name.alias("name")).withColumn("class", routing.non_data_class(F.col("name"), catalog.extension(F.col("name"))))


_EVEN = "(len(ls) >= 2 AND list_min(list_transform(ls, lambda x: length(x) - length(replace(x, {c}, '')))) >= 1 AND list_min(list_transform(ls, lambda x: length(x) - length(replace(x, {c}, '')))) = list_max(list_transform(ls, lambda x: length(x) - length(replace(x, {c}, '')))))"


@query("""
WITH t AS (SELECT doc_id, regexp_replace(text, '^[\\x{feff} \\t\\r\\n]+', '') AS s FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, s, lower(substr(s, 1, 512)) AS head, list_filter(regexp_split_to_array(s, '\\r\\n|\\r|\\n')[1:8], lambda x: trim(x, ' ') <> '') AS ls FROM t)
SELECT doc_id, CASE WHEN s = '' THEN 'plain_text' WHEN regexp_matches(s, '^[{\\[]') AND (json_valid(s) OR NOT regexp_matches(rtrim(s), '[}\\]]$')) THEN 'json'
  WHEN starts_with(s, '<') THEN CASE WHEN starts_with(head, '<!doctype html') OR contains(head, '<html') THEN 'html' ELSE 'xml' END
  WHEN regexp_matches(head, '^(from|received|return-path|message-id):') THEN 'email'
  WHEN """ + " OR ".join(_EVEN.format(c=c) for c in ("','", "';'", "chr(9)", "'|'")) + """ THEN 'delimited_text' ELSE 'plain_text' END AS family FROM l
""")
def detect_text_family(spark, d):
    return load(spark, d, "documents").where("text is not null").select("doc_id", routing.text_family(F.col("text")).alias("family"))


def _print_sql(section: str) -> str:
    body = """'{"minimum":' || min_chunk_characters || ',"overlap":' || chunk_overlap || ',"size":' || chunk_size || '}'""" if section == "chunking" else "'{}'"
    return f"substr(sha256('{section}:' || {body}), 1, 16)"


@query(" UNION ALL ".join(
    f"SELECT extraction_config_version, '{route}' AS route, substr(sha256({' || chr(0) || '.join(_print_sql(s) for s in sections)}), 1, 16) AS fingerprint FROM chunking_settings"
    for route, sections in routing.ROUTE_SECTIONS.items()
))
def route_fingerprint(spark, d):
    """Fingerprints of the routes under each chunking setting (a fixed table)."""
    rows = []
    for r in load(spark, d, "chunking_settings").collect():
        prints = routing.route_fingerprints({"chunking": {"size": r.chunk_size, "overlap": r.chunk_overlap, "minimum": r.min_chunk_characters}})
        rows += [(r.extraction_config_version, route, p) for route, p in prints.items()]
    return spark.createDataFrame(rows, "extraction_config_version string, route string, fingerprint string")


# --- text ---------------------------------------------------------------------------------------

@query("""
SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\\r\\n|\\r', chr(10), 'g'), '[ \\t]{2,}', ' ', 'g'), '(?m)[ \\t]+$', '', 'g'),
       '\\n{3,}', chr(10) || chr(10), 'g'), '^[\\s\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{3000}]+|[\\s\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{3000}]+$', '', 'g')) AS sha
FROM documents WHERE text IS NOT NULL
""")
def normalise_ws(spark, d):
    return load(spark, d, "documents").where("text is not null").select("doc_id", F.sha2(T.normalise(F.col("text")), 256).alias("sha"))


@query("SELECT doc_id, text IS NULL OR length(regexp_replace(text, '[\\s\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{3000}]', '', 'g')) = 0 AS blank FROM documents")
def nonblank(spark, d):
    return load(spark, d, "documents").select("doc_id", T.is_blank(F.col("text")).alias("blank"))


@query("""
SELECT DISTINCT chunk_id, substr(sha256(client_scope_id || chr(0) || content_sha256 || chr(0) || extraction_config_version || chr(0) || unit_sequence || chr(0) || seq), 1, 32) AS computed FROM chunks
""")
def chunk_ids(spark, d):
    c = load(spark, d, "chunks")
    return c.select("chunk_id", chunking.chunk_id(F.col("client_scope_id"), F.col("content_sha256"), F.col("extraction_config_version"), F.col("unit_sequence"), F.col("seq")).alias("computed")).distinct()


def _units(spark, d) -> DataFrame:
    docs = load(spark, d, "documents").where("scope_id is not null and text is not null")
    return docs.select("scope_id", F.sha2("text", 256).alias("content_sha256"), F.lit("document").alias("unit_type"), F.lit("document").alias("unit_ref"), F.lit(0).alias("unit_sequence"), T.normalise(F.col("text")).alias("text")).dropDuplicates(["scope_id", "content_sha256"])


@query()
def chunks(spark, d):
    return chunking.number_chunks(chunking.split_units(_units(spark, d)), "cfg")


@query("SELECT true AS located, true AS within, true AS unique_ids")
def chunk_offsets(spark, d):
    """Every chunk stands at its offset in its unit, none is longer than the size, and ids are unique."""
    u = _units(spark, d).select("scope_id", "content_sha256", F.col("text").alias("whole"))
    c = chunks(spark, d).join(u, ["scope_id", "content_sha256"])
    at = F.expr("substring(whole, char_start + 1, char_end - char_start)") == F.col("text")
    return c.agg(F.bool_and(at).alias("located"), F.bool_and(F.length("text") <= 1000).alias("within"), (F.count_distinct("chunk_id") == F.count("chunk_id")).alias("unique_ids"))


@query("""
SELECT client_scope_id, content_sha256, extraction_config_version, chunk_id, row_number() OVER (PARTITION BY client_scope_id, content_sha256, extraction_config_version ORDER BY unit_sequence, seq, chunk_id) - 1 AS running
FROM (SELECT DISTINCT client_scope_id, content_sha256, extraction_config_version, chunk_id, unit_sequence, seq FROM chunks)
""")
def chunk_seq(spark, d):
    c = load(spark, d, "chunks").select("client_scope_id", "content_sha256", "extraction_config_version", "chunk_id", "unit_sequence", "seq").distinct()
    document = ["client_scope_id", "content_sha256", "extraction_config_version"]
    n = chunking.number_in_document(c, document, "unit_sequence", ["seq", "chunk_id"], "running")
    return n.select(*document, "chunk_id", F.col("running").cast("bigint").alias("running"))


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ord FROM documents WHERE text IS NOT NULL),
m AS (SELECT doc_id, ord, line, CAST(sum(CASE WHEN starts_with(line, '## ') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ord) AS BIGINT) AS unit_no FROM l)
SELECT doc_id, unit_no, max(line) FILTER (starts_with(line, '## ')) AS heading, count(*) AS n_lines, sha256(string_agg(line, chr(10) ORDER BY ord)) AS sha FROM m GROUP BY 1, 2
""")
def heading_units(spark, d):
    lines = chunking.text_lines(load(spark, d, "documents")).withColumn("is_heading", F.col("line").startswith("## "))
    return chunking.heading_units(lines).select("doc_id", "unit_no", "heading", "n_lines", F.sha2("text", 256).alias("sha"))


@query("""
WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ord FROM documents WHERE text IS NOT NULL),
k AS (SELECT doc_id, ord, lower(substr(line, 1, 1)) AS key, length(line) AS n FROM l),
g AS (
  SELECT doc_id, ord, 0 AS unit_no, key, n AS chars FROM k WHERE ord = 0
  UNION ALL
  SELECT k.doc_id, k.ord, CASE WHEN g.key = k.key AND g.chars + k.n <= 400 THEN g.unit_no ELSE g.unit_no + 1 END, k.key, CASE WHEN g.key = k.key AND g.chars + k.n <= 400 THEN g.chars + k.n ELSE k.n END
  FROM g JOIN k ON k.doc_id = g.doc_id AND k.ord = g.ord + 1
)
SELECT doc_id, CAST(unit_no AS INTEGER) AS unit_no, key, CAST(min(ord) AS INTEGER) AS first, CAST(max(ord) AS INTEGER) AS last, CAST(max(chars) AS INTEGER) AS chars FROM g GROUP BY 1, 2, 3
""")
def unit_split(spark, d):
    """Lines of a text as entries keyed by their first letter, cut into units of at most 400 characters."""
    docs = load(spark, d, "documents").where("text is not null")
    entries = F.transform(F.split("text", "\n"), lambda x: F.struct(F.lower(F.substring(x, 1, 1)).alias("key"), x.alias("text")))
    return docs.select("doc_id", F.posexplode(chunking.size_bounded_units(entries, 400)).alias("unit_no", "u")).select("doc_id", "unit_no", "u.*")


_TOK = "list_distinct(list_filter(regexp_split_to_array({x}, '[\\s\\x{{1c}}-\\x{{1f}}\\x{{85}}\\x{{a0}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{3000}}]+'), lambda t: t <> ''))"
_JACC = "CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN 1.0 ELSE CAST(len(list_intersect(a, b)) AS DOUBLE) / len(list_distinct(list_concat(a, b))) END"
_NATIVE = "(SELECT content_sha256, number, native, " + _TOK.format(x="native") + " AS a, " + _TOK.format(x="vis") + " AS b FROM (SELECT DISTINCT content_sha256, number, coalesce(native_text, '') AS native, coalesce(extraction.visible_text, '') AS vis FROM vision_pages))"


@query(f"SELECT content_sha256, number, round({_JACC}, 9) AS jaccard FROM {_NATIVE}")
def token_jaccard(spark, d):
    v = load(spark, d, "vision_pages").select("content_sha256", "number", "native_text", F.col("extraction.visible_text").alias("vis")).distinct()
    return v.select("content_sha256", "number", F.round(T.token_jaccard(F.col("native_text"), F.col("vis")), 9).alias("jaccard")).distinct()


@query(f"SELECT content_sha256, number, CASE WHEN native <> '' AND {_JACC} < 0.5 THEN native END AS kept FROM {_NATIVE}")
def mixed_native(spark, d):
    v = load(spark, d, "vision_pages").select("content_sha256", "number", F.coalesce("native_text", F.lit("")).alias("native"), F.coalesce("extraction.visible_text", F.lit("")).alias("vis")).distinct()
    return v.select("content_sha256", "number", pages.keep_native(F.col("native"), T.token_jaccard(F.col("native"), F.col("vis"))).alias("kept"))


@query("""
SELECT DISTINCT chunk_id, client || ' - ' || source_relpath || ' [' || unit_ref || ']' AS citation FROM chunks
""")
def citations(spark, d):
    c = load(spark, d, "chunks")
    return c.select("chunk_id", vectors.citation(F.col("client"), F.col("source_relpath"), F.col("unit_ref")).alias("citation")).distinct()


@query("SELECT DISTINCT chunk_id, substr(regexp_replace(regexp_replace(text, '" + format_sql._SPACES + "', ' ', 'g'), '^ | $', '', 'g'), 1, 300) AS snippet FROM chunks")
def snippets(spark, d):
    return load(spark, d, "chunks").select("chunk_id", T.snippet(F.col("text")).alias("snippet")).distinct()


@query("SELECT client_scope_id, count(*) AS n_rows, count(DISTINCT chunk_id) AS n_chunks, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM chunks GROUP BY 1")
def chunk_scan(spark, d):
    return load(spark, d, "chunks").groupBy("client_scope_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("chunk_id").alias("n_chunks"), F.sum(F.length("text")).alias("n_chars"))


# --- pages --------------------------------------------------------------------------------------

_PAGES = "(SELECT DISTINCT content_sha256, number, length(coalesce(native_text, '')) AS chars, CASE WHEN extraction IS NULL THEN 0.0 WHEN number % 3 = 0 THEN 0.9 ELSE 0.02 END AS coverage FROM vision_pages)"
_KIND = "CASE WHEN chars >= 120 THEN 'text' WHEN coverage >= 0.5 THEN CASE WHEN chars = 0 THEN 'scanned' ELSE 'mixed' END WHEN chars < 20 AND coverage < 0.05 THEN 'empty' ELSE 'mixed' END"


def _page_kinds(spark, d) -> DataFrame:
    v = load(spark, d, "vision_pages")
    coverage = F.when(F.col("extraction").isNull(), 0.0).when(F.col("number") % 3 == 0, 0.9).otherwise(0.02)
    p = v.select("content_sha256", "number", F.length(F.coalesce("native_text", F.lit(""))).alias("chars"), coverage.alias("coverage")).distinct()
    return p.withColumn("kind", pages.page_kind(F.col("chars"), F.col("coverage")))


@query(f"SELECT content_sha256, number, {_KIND} AS kind FROM {_PAGES}")
def page_kind(spark, d):
    return _page_kinds(spark, d).select("content_sha256", "number", "kind")


@query(f"SELECT content_sha256, count(*) AS n_pages, count(*) FILTER (kind = 'scanned') AS n_scanned, count(*) FILTER (kind = 'mixed') AS n_mixed, bool_or(kind IN ('scanned', 'mixed')) AS needs_vision FROM (SELECT content_sha256, {_KIND} AS kind FROM {_PAGES}) GROUP BY 1")
def pdf_counts(spark, d):
    k = _page_kinds(spark, d)
    return k.groupBy("content_sha256").agg(
        F.count(F.lit(1)).alias("n_pages"), F.count_if(F.col("kind") == "scanned").alias("n_scanned"), F.count_if(F.col("kind") == "mixed").alias("n_mixed"),
        F.bool_or(F.col("kind").isin("scanned", "mixed")).alias("needs_vision"),
    )


@query("SELECT p_partkey, least((p_size * 10.0 * 20.0 + p_size * 5.0 * 8.0) / 4000.0, 1.0) AS coverage FROM part")
def image_coverage(spark, d):
    p = load(spark, d, "part")
    images = F.array(F.struct((F.col("p_size") * 10.0).alias("w"), F.lit(20.0).alias("h")), F.struct((F.col("p_size") * 5.0).alias("w"), F.lit(8.0).alias("h")))
    return p.select("p_partkey", pages.image_coverage(images, F.lit(4000.0)).alias("coverage"))


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN greatest(w, h) <= 2000 THEN w ELSE CAST(greatest(floor(w * 2000.0 / greatest(w, h)), 1) AS INTEGER) END AS w2,
       CASE WHEN greatest(w, h) <= 2000 THEN h ELSE CAST(greatest(floor(h * 2000.0 / greatest(w, h)), 1) AS INTEGER) END AS h2
FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity * 97 AS INTEGER) AS w, CAST(l_partkey % 3500 + 1 AS INTEGER) AS h FROM lineitem)
""")
def downscale_dims(spark, d):
    i = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 97).cast("int").alias("w"), (F.col("l_partkey") % 3500 + 1).cast("int").alias("h"))
    w2, h2 = pages.downscaled(F.col("w"), F.col("h"))
    return i.select("l_orderkey", "l_linenumber", w2.alias("w2"), h2.alias("h2"))


@query("""
WITH p AS (SELECT content_sha256, number, any_value(failure) AS failure FROM vision_pages GROUP BY 1, 2)
SELECT content_sha256, count(*) AS n_pages, count(failure) AS n_failed, CASE WHEN count(failure) > 0 THEN 'partial' ELSE 'success' END AS status, arg_min(failure, number) FILTER (failure IS NOT NULL) AS first_failure FROM p GROUP BY 1
""")
def rollup_status(spark, d):
    return pages.document_status(load(spark, d, "vision_pages"))


@query("SELECT DISTINCT content_sha256, number, coalesce(contains(extraction.visible_text, '[UNREADABLE]'), false) AS unreadable FROM vision_pages")
def unreadable(spark, d):
    return load(spark, d, "vision_pages").select("content_sha256", "number", F.coalesce(F.col("extraction.visible_text").contains(pages.UNREADABLE), F.lit(False)).alias("unreadable")).distinct()


@query("""
SELECT DISTINCT scope_id, '| ' || replace(replace(category, chr(92), chr(92) || chr(92)), '|', chr(92) || '|') || ' | ' || replace(replace(client, chr(92), chr(92) || chr(92)), '|', chr(92) || '|') || ' |' AS md FROM scopes
""")
def format_doc(spark, d):
    return load(spark, d, "scopes").select("scope_id", pages.markdown_row(F.array("category", "client")).alias("md")).distinct()


_CELL = r"regexp_replace(replace(replace(coalesce({x}, ''), chr(92), chr(92) || chr(92)), '|', chr(92) || '|'), '\r\n|\r|\n', ' ', 'g')"
_ROW = "'| ' || array_to_string(list_transform({r}, lambda c: " + _CELL.format(x="c") + "), ' | ') || ' |'"
_TABLE = (
    "array_to_string(list_concat([" + _ROW.format(r='t."columns"') + ", '| ' || array_to_string(list_transform(t.\"columns\", lambda c: '---'), ' | ') || ' |'], "
    "list_transform(t.\"rows\", lambda r: " + _ROW.format(r="list_resize(r, len(t.\"columns\"), '')") + ")), chr(10))"
)


@query(f"""
SELECT DISTINCT content_sha256, number, concat_ws(chr(10) || chr(10), '## Page ' || number, '_Page failed: ' || failure || '_', nullif(extraction.visible_text, ''),
  nullif(array_to_string(list_transform(extraction.tables, lambda t: concat_ws(chr(10) || chr(10), '### ' || t.caption, {_TABLE})), chr(10) || chr(10)), ''),
  '### Native text' || chr(10) || chr(10) || nullif(native_text, '')) AS md
FROM vision_pages
""")
def vision_markdown(spark, d):
    v = load(spark, d, "vision_pages")
    return v.select("content_sha256", "number", pages.page_markdown(F.col("number"), F.col("extraction"), F.col("native_text"), F.col("failure")).alias("md")).dropDuplicates(["content_sha256", "number"])


_MISSING = ", ".join(f"CASE WHEN e.{k} IS NULL THEN '{k}' END" for k in pages.REPLY_KEYS)


@query(f"""
WITH v AS (SELECT content_sha256, number, extraction AS e FROM vision_pages),
m AS (SELECT *, list_filter([{_MISSING}], lambda k: k IS NOT NULL) AS missing,
        list_filter(list_transform(e.fields, lambda f: CASE WHEN f IS NULL OR f.label IS NULL OR f.value IS NULL THEN 'bad field' WHEN f.confidence NOT IN ('high', 'medium', 'low') THEN 'bad confidence' END), lambda x: x IS NOT NULL)[1] AS f_error,
        list_filter(e.tables, lambda t: t IS NULL OR t."columns" IS NULL OR t."rows" IS NULL OR len(list_filter(t."rows", lambda r: r IS NULL)) > 0) AS t_bad FROM v)
SELECT DISTINCT content_sha256, number, CASE WHEN e IS NULL THEN 'not JSON' WHEN len(missing) > 0 THEN 'missing ' || array_to_string(missing, ',') WHEN f_error IS NOT NULL THEN f_error WHEN len(t_bad) > 0 THEN 'bad table'
  WHEN regexp_replace(e.visible_text, '{format_sql._SPACES}', '', 'g') = '' AND len(e.fields) = 0 AND len(e.tables) = 0 THEN 'no content' END AS error FROM m
""")
def reply_validate(spark, d):
    """Replies rebuilt from stored transcriptions; a null extraction has no reply."""
    v = load(spark, d, "vision_pages")
    return v.select("content_sha256", "number", pages.reply_error(F.to_json("extraction")).alias("error")).distinct()


@query()
def vision_fake(spark, d):
    """The client over an injected transport that answers 503 once in a while, then the stored reply."""
    v = load(spark, d, "vision_pages").dropDuplicates(["content_sha256", "number"])
    images = v.select(F.concat_ws(":", "content_sha256", F.col("number").cast("string")).alias("image_id"), F.coalesce(F.to_json("extraction"), F.lit("")).cast("binary").alias("payload"))
    calls: dict[bytes, int] = {}

    def send(payload: bytes):
        calls[payload] = n = calls.get(payload, 0) + 1
        if len(payload) % 7 == 0 and n == 1:
            return 503, "", ""
        return (200, payload.decode(), "stop") if payload else (400, "", "")

    return pages.transcribe(images, send)


# --- tables -------------------------------------------------------------------------------------


def _part_cells(spark, d) -> DataFrame:
    p = load(spark, d, "part")
    cols = {"size": F.col("p_size").cast("string"), "padded": F.lpad(F.col("p_size").cast("string"), 4, "0"), "key": F.col("p_partkey").cast("string"), "brand": F.col("p_brand"), "nothing": F.lit(" ")}
    return p.select(F.lit("part").alias("table_name"), "p_partkey", F.explode(F.array(*[F.struct(F.lit(k).alias("name"), v.alias("value")) for k, v in cols.items()])).alias("c")).select("table_name", F.col("p_partkey").alias("row_no"), "c.name", "c.value")


@query("""
SELECT name, CASE WHEN bool_and(ok) THEN 'int64' ELSE 'string' END AS type FROM (
 SELECT name, regexp_full_match(v, '0|-?[1-9][0-9]*') AND try_cast(v AS BIGINT) IS NOT NULL AS ok FROM (
  SELECT 'size' AS name, CAST(p_size AS VARCHAR) AS v FROM part UNION ALL SELECT 'padded', lpad(CAST(p_size AS VARCHAR), 4, '0') FROM part UNION ALL SELECT 'key', CAST(p_partkey AS VARCHAR) FROM part UNION ALL SELECT 'brand', p_brand FROM part)) GROUP BY 1
""")
def infer_int(spark, d):
    c = _part_cells(spark, d).where("name <> 'nothing'")
    return c.groupBy("name").agg(F.when(F.bool_and(tables.is_int(F.col("value"))), "int64").otherwise("string").alias("type"))


@query("SELECT p_partkey, v AS value, CAST(CAST(v AS DOUBLE) AS VARCHAR) = v AS round_trips FROM (SELECT p_partkey, printf('%.2f', p_retailprice) AS v FROM part)")
def infer_float(spark, d):
    p = load(spark, d, "part").select("p_partkey", F.format_string("%.2f", "p_retailprice").alias("value"))
    return p.withColumn("round_trips", tables.is_float(F.col("value")))


@query(r"""
WITH c AS (SELECT DISTINCT table_id, row_no, payload FROM raw_register WHERE payload IS NOT NULL),
v AS (SELECT CAST(c.table_id AS VARCHAR) AS table_name, j.key AS name, nullif(regexp_replace(j.value ->> '$', '^\s+|\s+$', '', 'g'), '') AS v FROM c, json_each(c.payload) j),
f AS (SELECT *, CASE WHEN v IS NOT NULL THEN regexp_full_match(v, '0|-?[1-9][0-9]*') AND try_cast(v AS BIGINT) IS NOT NULL END AS i, regexp_full_match(v, '[+-]?[0-9]+(_[0-9]+)*') AS p,
             regexp_full_match(v, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') AS d FROM v),
g AS (SELECT *, i OR d AND CAST(try_cast(v AS DOUBLE) AS VARCHAR) = v AS r FROM f)
SELECT table_name, name, count(v) AS n_values, count(*) - count(v) AS null_count,
       CASE WHEN count(v) = 0 THEN 'string' WHEN bool_and(i) THEN 'int64' WHEN bool_and(r) THEN 'double' ELSE 'string' END AS type,
       CASE WHEN count(v) = 0 OR bool_and(i) OR bool_and(r) THEN NULL WHEN bool_and(p) THEN 'integers that do not round-trip' WHEN bool_and(d) THEN 'numbers that do not round-trip' END AS rejected_reason
FROM g GROUP BY 1, 2
""")
def column_profile(spark, d):
    """Types told from the delivered rows of every file."""
    from sparkloom.operators.schema_drift import register_cells

    cells = register_cells(load(spark, d, "raw_register")).select(F.col("table_id").cast("string").alias("table_name"), "name", "value")
    return tables.infer_types(cells)


@query("SELECT p_partkey AS row_no, CAST(p_size AS BIGINT) AS size, lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded, p_partkey AS key, p_brand AS brand, NULL::VARCHAR AS nothing FROM part")
def typed_table(spark, d):
    return tables.typed_table(_part_cells(spark, d), {"size": "int64", "padded": "string", "key": "int64", "brand": "string", "nothing": "string"}, ["row_no"])


@query("""
SELECT 'named' AS table_name, true AS header_detected UNION ALL SELECT 'numbers', false
""")
def header_detect(spark, d):
    n = load(spark, d, "nation").where("n_nationkey = 0").select(F.lit("named").alias("table_name"), F.lit(0).alias("row_no"), F.explode(F.array(F.lit("key"), F.col("n_name"), F.lit("region"))).alias("value"))
    m = load(spark, d, "nation").where("n_nationkey = 0").select(F.lit("numbers").alias("table_name"), F.lit(0).alias("row_no"), F.explode(F.array(F.lit("100"), F.lit("200"))).alias("value"))
    return tables.has_header(n.unionByName(m))


_HEADER_OF = """
SELECT table_id AS table_name, bool_and(v <> '') AND count(v) = count(DISTINCT v) AND NOT bool_or(regexp_full_match(v, '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?')) AS header_detected
FROM (SELECT table_id, regexp_replace(coalesce(x, ''), '^\\s+|\\s+$', '', 'g') AS v FROM (SELECT table_id, unnest({values}) AS x FROM first)) GROUP BY 1
"""


@query("""
WITH first AS (SELECT table_id, arg_min(payload, row_no) AS payload FROM raw_register GROUP BY 1),
k AS (""" + _HEADER_OF.format(values="json_keys(payload)") + """), r AS (""" + _HEADER_OF.format(values="list_transform(json_keys(payload), lambda n: payload ->> n)") + """)
SELECT k.table_name, k.header_detected AS key_row, r.header_detected AS first_row FROM k JOIN r USING (table_name)
""")
def header_detect_register(spark, d):
    """The header test on the key row and on the first delivered row of every table."""
    fields = F.map_entries(F.from_json("payload", "map<string,string>"))
    first = load(spark, d, "raw_register").groupBy(F.col("table_id").alias("table_name")).agg(F.min_by("payload", "row_no").alias("payload"))
    cells = first.select("table_name", F.lit(0).alias("row_no"), F.explode(fields).alias("f"))
    keys, values = (tables.has_header(cells.select("table_name", "row_no", F.col(f"f.{c}").alias("value"))) for c in ("key", "value"))
    return keys.withColumnRenamed("header_detected", "key_row").join(values.withColumnRenamed("header_detected", "first_row"), "table_name")


@query("""
WITH k AS (SELECT table_id, row_no AS ord, json_keys(any_value(payload)) AS keys FROM raw_register WHERE row_no < 50 GROUP BY 1, 2)
SELECT a.table_id AS group_id, count(*) AS n_pairs, round(avg(CAST(len(list_intersect(a.keys, b.keys)) AS DOUBLE) / greatest(len(list_distinct(list_concat(a.keys, b.keys))), 1)), 9) AS mean_jaccard
FROM k a JOIN k b ON a.table_id = b.table_id AND a.ord < b.ord GROUP BY 1
""")
def key_jaccard(spark, d):
    r = load(spark, d, "raw_register").dropDuplicates(["table_id", "row_no"])
    return tables.key_jaccard(r.select(F.col("table_id").alias("group_id"), F.col("row_no").alias("ord"), F.map_keys(F.from_json("payload", "map<string,string>")).alias("keys")))


@query("SELECT event_id, 'k' AS path, json_extract_string(props, '$.k') AS leaf FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_paths(spark, d):
    e = load(spark, d, "events")
    return e.select("event_id", F.lit("k").alias("path"), F.get_json_object("props", "$.k").alias("leaf")).where("leaf is not null")


@query("""
WITH RECURSIVE ok AS (SELECT DISTINCT return_id, CAST(payload AS JSON) AS v FROM raw_returns WHERE payload IS NOT NULL AND json_valid(payload)),
n AS (
  SELECT return_id, CAST(j.key AS VARCHAR) AS path, j.value AS v FROM ok, json_each(ok.v) j
  UNION ALL SELECT n.return_id, n.path || '.' || j.key, j.value FROM n, json_each(n.v) j WHERE json_type(n.v) IN ('OBJECT', 'ARRAY')
)
SELECT DISTINCT return_id, path, CASE WHEN json_type(v) IN ('OBJECT', 'ARRAY') THEN '(empty)' WHEN json_type(v) = 'NULL' THEN '' WHEN json_type(v) = 'DOUBLE' THEN CAST(CAST(v ->> '$' AS DOUBLE) AS VARCHAR) ELSE v ->> '$' END AS leaf
FROM n WHERE NOT (json_type(v) = 'OBJECT' AND len(json_keys(v)) > 0) AND NOT (json_type(v) = 'ARRAY' AND json_array_length(v) > 0)
""")
def json_leaves(spark, d):
    """The path walk over whole payloads: every leaf with its path."""
    import json

    from sparkloom.sources import readers

    def run(batches):
        import pandas as pd

        for b in batches:
            rows = []
            for i, p in zip(b["return_id"], b["payload"], strict=True):
                try:
                    rows += [(i, path, leaf) for path, leaf in readers.walk_paths(json.loads(p))]
                except ValueError:
                    continue
            yield pd.DataFrame(rows, columns=["return_id", "path", "leaf"])

    return load(spark, d, "raw_returns").where("payload is not null").select("return_id", "payload").mapInPandas(run, "return_id bigint, path string, leaf string").distinct()


# --- vectors ------------------------------------------------------------------------------------

_Q = "(SELECT embedding AS q FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings))"


def _vectors(spark, d) -> tuple[DataFrame, list[float]]:
    """The index, and one question: the vector of the smallest id."""
    e = load(spark, d, "embeddings")
    v = e.select(F.col("vec_id").alias("chunk_id"), F.concat(F.lit("scope-"), "label").alias("scope_id"), F.concat(F.lit("Client "), "label").alias("client"), F.lit("All").alias("category"), F.col("embedding").alias("vector"))
    return v, e.agg(F.min_by("embedding", "vec_id").alias("q")).first().q


@query(f"SELECT vec_id AS chunk_id, label, list_dot_product(embedding::DOUBLE[], q::DOUBLE[]) AS score FROM embeddings, {_Q} ORDER BY score DESC, vec_id LIMIT 10")
def vector_topk(spark, d):
    v, q = _vectors(spark, d)
    return vectors.search(v, q, 10).select("chunk_id", F.regexp_extract("scope_id", r"\d+", 0).cast("int").alias("label"), "score")


_SCORES = f"(SELECT vec_id AS chunk_id, 'scope-' || label AS scope_id, list_dot_product(embedding::DOUBLE[], q::DOUBLE[]) AS score FROM embeddings, {_Q} {{where}})"


@query(f"SELECT chunk_id, scope_id, score FROM (SELECT *, row_number() OVER (PARTITION BY scope_id ORDER BY score DESC, chunk_id) AS r FROM {_SCORES.format(where='')}) WHERE r <= 5 ORDER BY score DESC, chunk_id LIMIT 5")
def search_scoped(spark, d):
    v, q = _vectors(spark, d)
    return vectors.search(v, q, 5).select("chunk_id", "scope_id", "score")


@query(f"SELECT chunk_id, scope_id, score FROM {_SCORES.format(where='WHERE label = 3')} ORDER BY score DESC, chunk_id LIMIT 5")
def filtered_search(spark, d):
    v, q = _vectors(spark, d)
    return vectors.search(v, q, 5, scope_id="scope-3", client="CLIENT 3").select("chunk_id", "scope_id", "score")


#: Every row whose id is divisible by 50 as a question, against all rows.
_SET = (
    "SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS r FROM (SELECT q.vec_id AS query_id, e.vec_id AS chunk_id, e.label, "
    "'scope-' || e.label AS scope_id, list_dot_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS score FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0 {where})) WHERE r <= {k}"
)


def _questions(spark, d) -> tuple[DataFrame, DataFrame]:
    e = load(spark, d, "embeddings")
    return _vectors(spark, d)[0], e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


@query(_SET.format(columns="query_id, chunk_id, label, score", where="", k=10))
def vector_topk_set(spark, d):
    v, q = _questions(spark, d)
    return vectors.search_set(v, q, 10).select("query_id", "chunk_id", F.regexp_extract("scope_id", r"\d+", 0).cast("int").alias("label"), "score")


@query(_SET.format(columns="query_id, chunk_id, scope_id, score", where="", k=5))
def search_scoped_set(spark, d):
    v, q = _questions(spark, d)
    return vectors.search_set(v, q, 5).select("query_id", "chunk_id", "scope_id", "score")


@query(_SET.format(columns="query_id, chunk_id, scope_id, score", where="AND e.label = 3", k=5))
def filtered_search_set(spark, d):
    v, q = _questions(spark, d)
    return vectors.search_set(v, q, 5, scope_id="scope-3", client="CLIENT 3").select("query_id", "chunk_id", "scope_id", "score")


@query(f"SELECT count(*) AS n_checked FROM embeddings, {_Q} WHERE len(embedding) = len(q)")
def dim_guard(spark, d):
    v, q = _vectors(spark, d)
    return vectors.scored(v, q).where("score >= -2").agg(F.count(F.lit(1)).alias("n_checked"))


@query("SELECT client_scope_id AS scope_id, chunk_id, row_number() OVER (PARTITION BY client_scope_id ORDER BY content_sha256, seq, chunk_id) - 1 AS row_no FROM (SELECT DISTINCT client_scope_id, chunk_id, content_sha256, seq FROM chunks)")
def gold_rows(spark, d):
    c = load(spark, d, "chunks").select(F.col("client_scope_id").alias("scope_id"), "chunk_id", "content_sha256", "seq").distinct()
    return vectors.index_rows(c).select("scope_id", "chunk_id", F.col("row_no").cast("bigint").alias("row_no"))


@query("SELECT client_scope_id AS scope_id, count(DISTINCT chunk_id) AS n_rows, count(DISTINCT chunk_id) AS n_mapped, true AS agrees FROM chunks GROUP BY 1")
def mapping_check(spark, d):
    g = gold_rows(spark, d)
    return g.groupBy("scope_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_no").alias("n_mapped"), (F.max("row_no") + 1 == F.count(F.lit(1))).alias("agrees"))


@query()
def embed_fake(spark, d):
    c = load(spark, d, "chunks").select("chunk_id", "text").dropDuplicates(["chunk_id"])
    e = vectors.embed(c, vectors.character_embedder())
    return e.select("chunk_id", F.size("vector").alias("dimension"), F.round(vectors.inner_product(F.col("vector"), F.col("vector")), 4).alias("norm"))


@query("SELECT client_scope_id AS scope_id, array_to_string(list_sort(list(DISTINCT extraction_config_version)), ',') AS versions, count(DISTINCT chunk_id) AS n_chunks FROM chunks GROUP BY 1")
def index_meta(spark, d):
    c = load(spark, d, "chunks")
    return c.groupBy(F.col("client_scope_id").alias("scope_id")).agg(F.array_join(F.sort_array(F.collect_set("extraction_config_version")), ",").alias("versions"), F.count_distinct("chunk_id").alias("n_chunks"))


@query("SELECT count(DISTINCT client_scope_id) AS n_scopes, count(DISTINCT chunk_id) AS n_chunks, count(DISTINCT chunk_id) FILTER (text IS NULL OR trim(text) = '') AS n_empty FROM chunks")
def gold_summary(spark, d):
    c = load(spark, d, "chunks")
    return c.agg(F.count_distinct("client_scope_id").alias("n_scopes"), F.count_distinct("chunk_id").alias("n_chunks"), F.count_distinct(F.when(T.is_blank(F.col("text")), F.col("chunk_id"))).alias("n_empty"))


@query("SELECT DISTINCT c.chunk_id, c.client_scope_id FROM chunks c LEFT JOIN scopes s ON c.client_scope_id = s.scope_id WHERE s.scope_id IS NULL OR c.category <> s.category OR c.client <> s.client")
def scope_guard(spark, d):
    """Chunks whose scope is unknown or does not fit their category and client."""
    s = load(spark, d, "scopes").select(F.col("scope_id").alias("client_scope_id"), F.col("category").alias("_c"), F.col("client").alias("_k"))
    c = load(spark, d, "chunks").join(s, "client_scope_id", "left")
    return c.where("_c is null or category <> _c or client <> _k").select("chunk_id", "client_scope_id").distinct()


@query("""
WITH v AS (SELECT scope_id, version_id, max(run_ordinal) AS o FROM """ + _SEALED + """ WHERE status = 'success' GROUP BY 1, 2)
SELECT scope_id, arg_max(version_id, o) AS newest, count(*) AS n_versions FROM v GROUP BY 1
""")
def newest_index(spark, d):
    v = _sealed(spark, d).where("status = 'success'").groupBy("scope_id", "version_id").agg(F.max("run_ordinal").alias("o"))
    return v.groupBy("scope_id").agg(F.max_by("version_id", "o").alias("newest"), F.count(F.lit(1)).alias("n_versions"))


@query("SELECT count(DISTINCT client) AS n_clients, count(DISTINCT category) AS n_categories, count(DISTINCT chunk_id) AS n_chunks FROM chunks")
def catalogue(spark, d):
    return load(spark, d, "chunks").agg(F.count_distinct("client").alias("n_clients"), F.count_distinct("category").alias("n_categories"), F.count_distinct("chunk_id").alias("n_chunks"))
