"""Catalog of a corpus: scopes, identities, duplicates within a scope, application bundles, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions.text import ascii_slug

NUL = "\x00"


def scope_id(category: Column, client: Column) -> Column:
    """slug(category)__slug(client)__ first 12 digits of sha1(category NUL client)."""
    digest = F.substring(F.sha1(F.concat(category, F.lit(NUL), client)), 1, 12)
    return F.concat_ws("__", ascii_slug(category), ascii_slug(client), digest)


def archive_chain(chain: Column) -> Column:
    """A chain of archive members as one text: hash!member parts joined by |."""
    return F.array_join(F.transform(F.coalesce(chain, F.array().cast("array<struct<archive_hash:string,member_path:string,depth:int>>")),
                                    lambda x: F.concat_ws("!", x["archive_hash"], x["member_path"])), "|")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Lower-case extension with its dot; empty for names without one and for dot files."""
    return F.lower(F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1))


def path_slug(path: Column, chain: Column) -> Column:
    """slug of the path and 10 digits of sha1(path NUL chain)."""
    return F.concat_ws("__", ascii_slug(path), F.substring(F.sha1(F.concat(path, F.lit(NUL), archive_chain(chain))), 1, 10))


def display_name(path: Column, chain: Column) -> Column:
    """The member's name for a file from an archive, else the file's own."""
    member = F.when(F.size(chain) > 0, F.element_at(chain, -1)["member_path"])
    return file_name(F.coalesce(member, path))


def companion_name(path: Column, chain: Column) -> Column:
    return F.concat(display_name(path, chain), F.lit(".format.md"))


def discover_scopes(files: DataFrame, whole_categories: list[str], path: str = "relative_path") -> DataFrame:
    """(category, client, scope_root, category_is_scope): one scope per client folder; categories of ``whole_categories`` are one scope.

    Files that lie directly in the root or, outside those categories, directly in a category have no scope.
    """
    p = F.split(F.col(path), "/")
    base = files.select(p[0].alias("category"), F.when(F.size(p) > 2, p[1]).alias("second"), F.size(p).alias("_n")).where("_n > 1").distinct()
    whole = F.col("category").isin(whole_categories) if whole_categories else F.lit(False)
    client = F.when(whole, F.col("category")).otherwise(F.col("second"))
    return base.select(
        "category", client.alias("client"), F.when(whole, F.col("category")).otherwise(F.concat_ws("/", "category", "second")).alias("scope_root"), whole.alias("category_is_scope")
    ).where("client is not null").distinct()


def path_prefixes(path: Column) -> Column:
    """All leading folders of a path, the path itself included."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def resolve_scopes(files: DataFrame, scopes: DataFrame, path: str = "relative_path") -> DataFrame:
    """The files with ``resolved_scope``: the scope with the longest root that contains the path, null if none does.

    An equi join on exploded leading folders; scopes that share a root count
    once (the smallest id). The number of rows a file becomes is its depth.
    """
    roots = scopes.where("scope_root is not null").groupBy("scope_root").agg(F.min("scope_id").alias("_scope"))
    keyed = files.withColumn("_id", F.monotonically_increasing_id())
    hits = (
        keyed.select("_id", F.explode(path_prefixes(F.col(path))).alias("scope_root")).join(roots, "scope_root")
        .groupBy("_id").agg(F.max_by("_scope", F.length("scope_root")).alias("resolved_scope"))
    )
    return keyed.join(hits, "_id", "left").drop("_id")


def resolve_paths(paths: DataFrame, scopes: DataFrame, path: str = "relative_path") -> DataFrame:
    """(path, resolved_scope) per distinct path: the deterministic form of resolve_scopes, keyed by the path itself."""
    roots = scopes.where("scope_root is not null").groupBy("scope_root").agg(F.min("scope_id").alias("_scope"))
    distinct = paths.select(path).where(F.col(path).isNotNull()).distinct()
    hits = (
        distinct.select(path, F.explode(path_prefixes(F.col(path))).alias("scope_root")).join(roots, "scope_root")
        .groupBy(path).agg(F.max_by("_scope", F.length("scope_root")).alias("resolved_scope"))
    )
    return distinct.join(hits, path, "left")


def content_paths(sources: DataFrame) -> DataFrame:
    """(scope_id, content_sha256, relative_path, ord): every path of every content of a scope once, with its first ord. Rows without scope or content are left out."""
    real = sources.where("scope_id is not null and content_sha256 is not null")
    return real.groupBy("scope_id", "content_sha256", "relative_path").agg(F.min("ord").alias("ord"))


def dedup_in_scope(sources: DataFrame) -> DataFrame:
    """(scope_id, content_sha256, first_ord, first_path, n_paths, n_duplicates) per content of a scope.

    The first path by ord wins; a path repeated with the same content counts
    once; the same content in another scope is another item. The paths
    themselves stay rows (content_paths), so one content under a third of all paths is no giant row.
    """
    return content_paths(sources).groupBy("scope_id", "content_sha256").agg(
        F.min("ord").alias("first_ord"), F.min_by("relative_path", "ord").alias("first_path"), F.count(F.lit(1)).alias("n_paths"),
        (F.count(F.lit(1)) - 1).alias("n_duplicates"),
    )


def dedup_outcomes(sources: DataFrame) -> DataFrame:
    """(scope_id, content_sha256, relative_path, ord, outcome): first, duplicate or repeat, by ord within scope and content.

    Told from the smallest ords of the content and of the path, which are
    aggregates; no content's rows are sorted in one task.
    """
    s = sources.where("scope_id is not null and content_sha256 is not null").dropDuplicates(["ord"]).select("scope_id", "content_sha256", "relative_path", "ord")
    item = s.groupBy("scope_id", "content_sha256").agg(F.min("ord").alias("_i"))
    path = s.groupBy("scope_id", "content_sha256", "relative_path").agg(F.min("ord").alias("_p"))
    both = s.join(item, ["scope_id", "content_sha256"]).join(path, ["scope_id", "content_sha256", "relative_path"])
    outcome = F.when(F.col("ord") == F.col("_i"), "first").when(F.col("ord") > F.col("_p"), "repeat").otherwise("duplicate")
    return both.select("scope_id", "content_sha256", "relative_path", "ord", outcome.alias("outcome"))


def bundle_roots(paths: DataFrame, marker: str = ".keystore", companion: str = ".properties", path: str = "relative_path") -> DataFrame:
    """(bundle_root): folders two levels above a marker file below which a companion file lies as well; the corpus root is none."""
    p = paths.select(path).where(F.col(path).isNotNull()).distinct()
    parts = F.split(F.col(path), "/")
    roots = p.where(F.lower(F.col(path)).endswith(marker) & (F.size(parts) > 2)).select(
        F.array_join(F.slice(parts, 1, F.size(parts) - 2), "/").alias("bundle_root")
    ).distinct()
    below = p.where(F.lower(F.col(path)).endswith(companion)).select(F.explode(path_prefixes(F.col(path))).alias("bundle_root")).distinct()
    return roots.join(below, "bundle_root", "left_semi")


def split_by_bundles(paths: DataFrame, roots: DataFrame, path: str = "relative_path") -> DataFrame:
    """(path, in_bundle) per distinct path: an equi join on exploded leading folders."""
    p = paths.select(path).where(F.col(path).isNotNull()).distinct()
    inside = p.select(path, F.explode(path_prefixes(F.col(path))).alias("bundle_root")).join(roots, "bundle_root", "left_semi").select(path).distinct()
    return p.join(inside.withColumn("in_bundle", F.lit(True)), path, "left").withColumn("in_bundle", F.coalesce("in_bundle", F.lit(False)))


def archive_budget(members: DataFrame, max_bytes: int, max_members: int) -> DataFrame:
    """members (archive_hash, ord, bytes) with running totals and the limit each breaks, per archive in order.

    Everything after the first member over a limit is over it too.
    """
    w = Window.partitionBy("archive_hash").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    m = members.withColumn("total_bytes", F.sum(F.coalesce("bytes", F.lit(0))).over(w)).withColumn("n_members", F.count(F.lit(1)).over(w))
    category = F.when(F.col("n_members") > max_members, "ARCHIVE_MEMBER_LIMIT_EXCEEDED").when(F.col("total_bytes") > max_bytes, "ARCHIVE_SIZE_LIMIT_EXCEEDED")
    return m.withColumn("failure", category)


#: Device names no member may be called.
RESERVED_NAMES = ("con", "prn", "aux", "nul", *(f"com{i}" for i in range(1, 10)), *(f"lpt{i}" for i in range(1, 10)))


def safe_member(path: Column) -> Column:
    """True for a member path that stays inside its target: relative, no drive, no parent steps, no device names."""
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    segments = F.filter(F.split(p, "/"), lambda s: (s != "") & (s != "."))
    device = lambda s: F.lower(F.substring_index(F.rtrim(s), ".", 1)).isin(*RESERVED_NAMES)
    return (
        F.coalesce(path, F.lit("")).rlike(r"[^\s]") & ~p.startswith("/") & ~p.rlike(r"^[A-Za-z]:") & (F.size(segments) > 0)
        & ~F.exists(segments, lambda s: (s == "..") | device(s)) & ~path.contains(NUL)
    )


def sanitise_member(path: Column) -> Column:
    """A safe path with characters that some file systems refuse replaced by ``_``; changed segments get 8 digits of their sha1."""
    def one(s: Column) -> Column:
        clean = F.regexp_replace(F.regexp_replace(s, r'[<>:"|?*\x01-\x1f]', "_"), r"[. ]+$", "")
        return F.when(clean == s, s).otherwise(F.concat(clean, F.lit("__"), F.substring(F.sha1(s), 1, 8)))

    segments = F.filter(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), lambda s: (s != "") & (s != "."))
    return F.array_join(F.transform(segments, one), "/")


def dedup_bytes(sources: DataFrame) -> DataFrame:
    """(scope_id, n_before, bytes_before, n_after, bytes_after): files of each scope and their bytes, before and after one content is kept once. Repeated rows count once, unknown sizes as nothing."""
    files = sources.select("scope_id", "relative_path", "archive_chain", "content_sha256", "size_bytes").distinct()
    per = files.groupBy("scope_id", "content_sha256").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("size_bytes", F.lit(0))).alias("b"), F.coalesce(F.max("size_bytes"), F.lit(0)).alias("one"))
    return per.groupBy("scope_id").agg(F.sum("n").alias("n_before"), F.sum("b").alias("bytes_before"), F.count(F.lit(1)).alias("n_after"), F.sum("one").alias("bytes_after"))
