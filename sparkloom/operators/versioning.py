"""Immutable versions: sealed manifests, active versions, reuse decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values.
STATUSES = ("success", "partial", "locked", "failed", "no_reader", "excluded_non_data", "skipped_duplicate")
SETTLED = ("success", "no_reader", "excluded_non_data", "skipped_duplicate")
KEY = ["scope_id", "content_hexdigest", "route"]


def version_id(ordinal: Column, prefix: str = "r") -> Column:
    return F.format_string(f"{prefix}%06d", ordinal)


def ordinal_of(version: Column, prefix: str = "r") -> Column:
    """The number of a version id; null if it is not one."""
    return F.nullif(F.regexp_extract(version, rf"^{prefix}(\d{{6,}})$", 1), F.lit("")).cast("int")


def sealed_entries(entries: DataFrame, seals: DataFrame) -> DataFrame:
    """Entries of sealed runs, repeated rows once."""
    sealed = seals.where("sealed_at is not null").select("run_ordinal").distinct()
    return entries.join(sealed, "run_ordinal", "left_semi").withColumn("content_hexdigest", F.lower("content_hexdigest")).dropDuplicates()


def latest_outcome(entries: DataFrame) -> DataFrame:
    """Per piece of work its entry of the highest run (ties: greatest version id, then status)."""
    return entries.groupBy(*KEY).agg(F.max(F.struct("run_ordinal", "version_id", "status", "route_fingerprint")).alias("e")).select(
        *KEY, "e.run_ordinal", "e.version_id", "e.status", "e.route_fingerprint"
    )


def resolve_active(entries: DataFrame, fingerprint: str | None = None) -> DataFrame:
    """Per piece of work its latest successful entry: partial and failed results never become active."""
    ok = entries.where("status = 'success'")
    if fingerprint is not None:
        ok = ok.where(F.col("route_fingerprint") == fingerprint)
    return latest_outcome(ok)


def history(entries: DataFrame) -> DataFrame:
    """Per piece of work: number of attempts, first and last run, statuses in order of runs."""
    return entries.select(*KEY, "run_ordinal", "status").distinct().groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_attempts"), F.min("run_ordinal").alias("first_run"), F.max("run_ordinal").alias("last_run"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("run_ordinal", "status"))), lambda x: x["status"]), ",").alias("statuses"),
    )


def next_ordinal(entries: DataFrame, seals: DataFrame) -> DataFrame:
    """One row: the run number after all that were ever claimed, sealed or not."""
    claimed = entries.select("run_ordinal").unionByName(seals.select("run_ordinal"))
    return claimed.agg((F.coalesce(F.max("run_ordinal"), F.lit(0)) + 1).cast("int").alias("next_ordinal"))


def carry_forward(old: DataFrame, new: DataFrame) -> DataFrame:
    """The next manifest: all old entries and the new ones, nothing dropped."""
    return old.unionByName(new)


def reuse_decision(prior_status: Column, prior_fingerprint: Column, fingerprint: Column, force: bool = False, retry_locked: bool = True, retry_failed: bool = True) -> Column:
    """What to do with one unit of work, given its most recent outcome."""
    decision = F.when(prior_status.isNull(), "process_new")
    if force:
        return decision.otherwise("reprocess_forced")
    decision = decision.when(~prior_fingerprint.eqNullSafe(fingerprint), "reprocess_config_changed").when(prior_status.isin(*SETTLED), "reuse")
    if not retry_locked:
        decision = decision.when(prior_status == "locked", "reuse")
    if not retry_failed:
        decision = decision.when(prior_status == "failed", "reuse")
    return decision.otherwise("retry")


def prior_outcome(work: DataFrame, latest: DataFrame, alternative: dict[str, str]) -> DataFrame:
    """work with the latest outcome of its route or of the route it may have been redirected to; the newer run wins."""
    alt = F.lit(None).cast("string")
    for a, b in alternative.items():
        alt = F.when(F.col("route") == a, F.lit(b)).otherwise(alt)
    routes = F.filter(F.array(F.col("route"), alt), lambda r: r.isNotNull())
    w = work.select("scope_id", F.lower("content_hexdigest").alias("content_hexdigest"), "route", "route_fingerprint").distinct()
    tried = w.withColumn("_r", F.explode(routes))
    prior = latest.select("scope_id", "content_hexdigest", F.col("route").alias("_r"), F.struct("run_ordinal", "status", F.col("route").alias("prior_route"), F.col("route_fingerprint").alias("fp")).alias("p"))
    best = tried.join(prior, ["scope_id", "content_hexdigest", "_r"], "left").groupBy("scope_id", "content_hexdigest", "route", "route_fingerprint").agg(F.max("p").alias("p"))
    return best.select(
        "scope_id", "content_hexdigest", "route", "route_fingerprint", F.col("p.run_ordinal").alias("prior_run"), F.col("p.status").alias("prior_status"),
        F.col("p.prior_route").alias("prior_route"), F.col("p.fp").alias("prior_fingerprint"),
    )


def seal_body(entries: DataFrame) -> DataFrame:
    """Per scope: number of entries and the hash of its manifest body, entries sorted by content, route and run.

    The body is hashed as a tree over the contents' hash prefixes, so that a
    scope of any size is never joined into one text in one task: a node has at most 256 children above the leaves.
    """
    line = F.to_json(F.struct("content_hexdigest", "route", "route_fingerprint", "version_id", "run_ordinal", "status", F.col("source_paths")))
    node = lambda c: F.sha2(F.array_join(F.sort_array(F.collect_list(c)), "\n"), 256)
    level = entries.select("scope_id", F.col("content_hexdigest").alias("b"), line.alias("h")).groupBy("scope_id", "b").agg(node("h").alias("h"), F.count(F.lit(1)).alias("n"))
    for digits in (5, 3, 1, 0):
        level = level.groupBy("scope_id", F.substring("b", 1, digits).alias("b")).agg(node("h").alias("h"), F.sum("n").alias("n"))
    return level.select("scope_id", F.col("n").alias("n_entries"), F.col("h").alias("body_sha256"))
