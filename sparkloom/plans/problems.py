"""Queries of the core operators for incremental, drifting and nested input (p3, p4, p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.common import load, work_path
from sparkloom.operators import incremental, nested, schema_drift


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return schema_drift.schema_changes(load(spark, d, "table_profile"), load(spark, d, "column_profile"), load(spark, d, "raw_register")).distinct()


def p3_feed_rows(spark: SparkSession, d: str) -> DataFrame:
    t, c, r = (load(spark, d, n) for n in ("table_profile", "column_profile", "raw_register"))
    return schema_drift.ingest_feeds(t, c, r).select("feed_id", "file_no", "table_id", "row_no", F.col("typed").alias("typed_values"), "rescued")


def p3_feed_columns(spark: SparkSession, d: str) -> DataFrame:
    """The steady columns of every feed's table with their types, and in how many of its rows they have a value."""
    t, c, r = (load(spark, d, n) for n in ("table_profile", "column_profile", "raw_register"))
    rows = schema_drift.ingest_feeds(t, c, r)
    per = rows.select("feed_id", F.explode(F.map_keys("values")).alias("column")).groupBy("feed_id", "column").agg(F.count(F.lit(1)).alias("n_values"))
    plan = schema_drift.feed_schemas(t, c, r)
    return plan.join(per, ["feed_id", "column"], "left").na.fill({"n_values": 0})


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    pending = incremental.pending_work(
        load(spark, d, "work_queue"), load(spark, d, "manifest_entries"), load(spark, d, "run_seals"), work_path(spark, "pending")
    )
    return pending.select("scope_id", "content_hexdigest", "route")


def p4_pending_after_more_runs(spark: SparkSession, d: str) -> DataFrame:
    """The operator run twice over a growing history: first without the last ten runs, then with them."""
    queue, entries, seals = (load(spark, d, n) for n in ("work_queue", "manifest_entries", "run_seals"))
    state = work_path(spark, "pending-twice")
    incremental.pending_work(queue, entries, seals.where("run_ordinal <= 30"), state)
    return incremental.pending_work(queue, entries, seals, state)


def p4_redone(spark: SparkSession, d: str) -> DataFrame:
    """Buckets redone by runs over a growing history: all at first, those that changed after, none when nothing did; and what is pending then."""
    queue, entries, seals = (load(spark, d, n) for n in ("work_queue", "manifest_entries", "run_seals"))
    state, rows = work_path(spark, "pending-redone"), []
    # One scope's new entries, then the rest of the last runs, then nothing new.
    one = entries.where("run_ordinal > 35").agg(F.min("scope_id")).first()[0]
    steps = [("first", entries.where("run_ordinal <= 35")), ("one scope", entries.where((F.col("run_ordinal") <= 35) | (F.col("scope_id") == one))), ("all", entries), ("nothing new", entries)]
    for k, (step, seen) in enumerate(steps):
        pending, told = incremental.refresh_pending(queue, seen, seals, state)
        rows.append((k, step, told["buckets"], told["changed"], pending.count()))
    return spark.createDataFrame(rows, "step_no int, step string, n_buckets int, n_redone int, n_pending bigint")


def p5_rows(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten_records(load(spark, d, "raw_returns"), ["return_id"])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_rows(spark, d).select("return_id", "child_path", "parent_path").distinct()


def p5_rejected(spark: SparkSession, d: str) -> DataFrame:
    return nested.rejected_records(load(spark, d, "raw_returns"), ["return_id"]).select("return_id").distinct()


def p5_subtypes(spark: SparkSession, d: str) -> DataFrame:
    """The typed tables of all variants, one under the other: kind, keys, links, and the typed columns as JSON with their types."""
    out = None
    for (kind, _), t in nested.subtype_tables(p5_rows(spark, d), work_path(spark, "subtypes"), ["return_id"]).items():
        own = [c for c in t.columns if c not in ("return_id", "child_path", "parent_path")]
        types = ", ".join(f"{c} {k}" for c, k in t.dtypes if c in own)
        row = t.select(F.lit(kind).alias("kind"), "return_id", "child_path", "parent_path", (F.to_json(F.struct(*[F.col(f"`{c}`") for c in own])) if own else F.lit("{}")).alias("typed"), F.lit(types).alias("types"))
        out = row if out is None else out.unionByName(row)
    return out if out is not None else spark.createDataFrame([], "kind string, return_id bigint, child_path string, parent_path string, typed string, types string")


def p5_variants(spark: SparkSession, d: str) -> DataFrame:
    v = nested.variant_catalog(p5_rows(spark, d))
    return v.select("kind", "shape", "n_rows", F.array_join("common_members", ",").alias("common_members"))


QUERIES = {
    "p3_found": p3_found,
    "p3_feed_rows": p3_feed_rows,
    "p3_feed_columns": p3_feed_columns,
    "p4_found": p4_found,
    "p4_pending_after_more_runs": p4_pending_after_more_runs,
    "p4_redone": p4_redone,
    "p5_found": p5_found,
    "p5_rows": p5_rows,
    "p5_variants": p5_variants,
    "p5_rejected": p5_rejected,
    "p5_subtypes": p5_subtypes,
}

_P4 = """
WITH sealed AS (SELECT DISTINCT run_ordinal FROM run_seals WHERE sealed_at IS NOT NULL),
q AS (SELECT scope_id, lower(content_hexdigest) AS content_hexdigest, route,
             max({'d': discovered_at, 'f': route_fingerprint}).f AS wanted
      FROM work_queue GROUP BY ALL),
e AS (SELECT m.scope_id, lower(m.content_hexdigest) AS content_hexdigest, m.route, m.run_ordinal, m.route_fingerprint, m.status
      FROM manifest_entries m JOIN sealed s ON m.run_ordinal = s.run_ordinal),
last AS (SELECT scope_id, content_hexdigest, route, max(run_ordinal) AS run_ordinal FROM e GROUP BY ALL),
settled AS (SELECT DISTINCT q.scope_id, q.content_hexdigest, q.route
            FROM q JOIN last l ON q.scope_id = l.scope_id AND q.content_hexdigest = l.content_hexdigest AND q.route = l.route
            JOIN e ON e.scope_id = l.scope_id AND e.content_hexdigest = l.content_hexdigest AND e.route = l.route
                  AND e.run_ordinal = l.run_ordinal
            WHERE e.route_fingerprint = q.wanted AND e.status NOT IN ('partial', 'failed', 'locked'))
SELECT q.scope_id, q.content_hexdigest, q.route{extra}
FROM q LEFT JOIN settled s ON q.scope_id = s.scope_id AND q.content_hexdigest = s.content_hexdigest AND q.route = s.route
WHERE s.scope_id IS NULL
"""

_AS_ARRAY = """CASE WHEN json_type({v}) = 'VARCHAR' AND starts_with(ltrim({v} ->> '$', chr(32) || chr(9) || chr(10) || chr(13)), '[') AND json_valid({v} ->> '$') THEN CAST({v} ->> '$' AS JSON) ELSE {v} END"""

#: Every object in an array: first the names of all members that hold an array, then the walk with lone objects under such names as arrays of one.
_P5 = f"""
WITH RECURSIVE src AS (SELECT DISTINCT return_id, CAST(payload AS JSON) AS v FROM raw_returns WHERE payload IS NOT NULL AND json_valid(payload)),
n AS (
  SELECT return_id, '$' AS name, {_AS_ARRAY.format(v='v')} AS v FROM src
  UNION ALL
  SELECT n.return_id, CASE WHEN json_type(n.v) = 'OBJECT' THEN CAST(j.key AS VARCHAR) ELSE n.name END, {_AS_ARRAY.format(v='j.value')}
  FROM n, json_each(n.v) j WHERE json_type(n.v) IN ('OBJECT', 'ARRAY')
),
arrays AS (SELECT coalesce(list(DISTINCT name), []) AS names FROM n WHERE json_type(v) = 'ARRAY'),
r AS (
  SELECT return_id, '$' AS name, '$' AS path, '$' AS parent, false AS element, {_AS_ARRAY.format(v='v')} AS v FROM src
  UNION ALL
  SELECT return_id, name, path, parent, element, v FROM (
    SELECT b.return_id, CASE WHEN b.kind = 'OBJECT' THEN CAST(j.key AS VARCHAR) ELSE b.name END AS name,
           CASE WHEN b.kind = 'OBJECT' THEN b.own || '.' || j.key ELSE b.path || '[' || j.key || ']' END AS path,
           CASE WHEN b.is_row THEN b.own ELSE b.parent END AS parent, b.kind = 'ARRAY' AS element, {_AS_ARRAY.format(v='j.value')} AS v
    FROM (SELECT r.*, json_type(r.v) AS kind, json_type(r.v) = 'OBJECT' AND (r.element OR r.name <> '$' AND list_contains(arrays.names, r.name)) AS is_row,
                 r.path || CASE WHEN json_type(r.v) = 'OBJECT' AND NOT r.element AND r.name <> '$' AND list_contains(arrays.names, r.name) THEN '[0]' ELSE '' END AS own
          FROM r, arrays WHERE json_type(r.v) IN ('OBJECT', 'ARRAY')) b, json_each(b.v) j
  )
)
SELECT DISTINCT r.return_id, r.path || CASE WHEN r.element THEN '' ELSE '[0]' END AS child_path, r.parent AS parent_path
FROM r, arrays WHERE json_type(r.v) = 'OBJECT' AND (r.element OR r.name <> '$' AND list_contains(arrays.names, r.name))
"""

ORACLES = {
    "p5_found": _P5,
    "p4_found": _P4.replace("{extra}", ""),
    "p4_pending_after_more_runs": _P4.replace("{extra}", ", q.wanted AS route_fingerprint"),
    "p5_rejected": "SELECT DISTINCT return_id FROM raw_returns WHERE payload IS NULL OR NOT json_valid(payload)",
}
