"""Schemas that drift between the files of a feed.

Method: rescue-column ingestion. A file is read against the schema in force,
that of the feed's previous file. Fields the schema knows keep their place;
fields it does not know, and values that do not cast to their column's type,
are rescued as JSON instead of being dropped. The rescued fields are then
compared, by content, with the columns the file left empty: a rescued field
whose values look like an empty column's is that column under another name and
is promoted into it, any other rescued field is promoted as a new column, and
an empty column nothing was promoted into has been removed. Promoted and
rescued values are replayed into the feed's typed columns.

Content is compared through value features (exact short values, words, masks
of codes, magnitudes), summed per column *name* over all files. Everything is
an aggregation with map-side combine over (file, column) or (name, feature);
files of one feed are paired by a window over one row per file, so a feed that
holds a third of all rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.common import cut

#: Two columns hold the same content from this cosine of their value features on.
SAME_CONTENT = 0.35


def register_cells(register: DataFrame) -> DataFrame:
    """(table_id, row_no, name, value): one row per field of a delivered row; repeated rows once.

    Payloads that are null or not a JSON object give no cells. A field whose
    value is null gives a cell with a null value.
    """
    rows = register.select("table_id", "row_no", "payload").dropDuplicates()
    return rows.select("table_id", "row_no", F.explode(F.from_json("payload", "map<string,string>")).alias("name", "value"))


def file_pairs(tables: DataFrame) -> DataFrame:
    """(feed_id, file_no, table_id, prev_table_id, prev_file_no) by file_no; repeated rows once.

    If a file_no was delivered more than once, the latest delivery counts
    (ties: the greatest table_id). Files without feed or number are left out.
    """
    files = (
        tables.where("feed_id is not null and file_no is not null and table_id is not null")
        .groupBy("feed_id", "file_no")
        .agg(F.max(F.struct("delivered_at", "table_id")).getField("table_id").alias("table_id"))
    )
    w = Window.partitionBy("feed_id").orderBy("file_no")
    return files.select("*", F.lag("table_id").over(w).alias("prev_table_id"), F.lag("file_no").over(w).alias("prev_file_no"))


def file_columns(columns: DataFrame) -> DataFrame:
    """(table_id, name, type, position), one row per column; repeated rows once."""
    return columns.where("table_id is not null and name is not null").groupBy("table_id", "name").agg(
        F.min("type").alias("type"), F.min("position").alias("position")
    )


def value_features(value: Column) -> Column:
    """Features of a value: what stays the same when a column is renamed or retyped.

    Booleans, dates and percentages are put to one form first; numbers give
    their magnitude and, if short, themselves; codes give their mask (runs of
    letters and digits with their lengths); text gives its words.
    """
    v = F.lower(F.trim(value))
    bare = F.regexp_replace(v, r"[,%]", "")
    number = F.regexp_extract(bare, r"^-?(\d+)(?:\.\d+)?$", 1)
    whole = F.regexp_replace(bare, r"\.(0+|5)$", "")
    mask = F.regexp_replace(F.regexp_replace(v, "[a-z]", "a"), "[0-9]", "9")
    short_mask = F.regexp_replace(F.regexp_replace(mask, "a{3,}", "a+"), "9{6,}", "9+")
    cents = F.when(bare.rlike(r"\.\d\d$"), "c").otherwise("w")
    return (
        F.when(v.isin("true", "false", "yes", "no", "y", "n"), F.array(F.lit("=bool")))
        .when(v.rlike(r"^(\d{4}-\d\d-\d\d([ t].*)?|\d\d?[/-]\d\d?[/-]\d{4}|\d\d?[ -][a-z]{3,9}[ -]\d{2,4})$"), F.array(F.lit("=date")))
        .when(number != "", F.filter(F.array(
            F.concat(F.lit("=num"), F.when(F.length(number) >= 6, "6+").otherwise(F.when(F.length(number) <= 2, "1").otherwise("3")), cents),
            F.when(F.length(whole) <= 2, F.concat(F.lit("=v"), whole)),
            F.when(F.length(number) >= 7, F.lit("=code")),
        ), lambda x: x.isNotNull()))
        .when(v.rlike(r"\d"), F.array(F.concat(F.lit("=m"), short_mask)))
        .otherwise(F.filter(F.split(v, r"[^\p{L}\p{N}/&]+"), lambda w: w != ""))
    )


def name_features(cells: DataFrame) -> DataFrame:
    """(name, f, w): the value features of each column name over all files, as components of a unit vector."""
    counts = (
        cells.where("value is not null")
        .select("name", F.explode(value_features(F.col("value"))).alias("f"))
        .groupBy("name", "f")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = counts.groupBy("name").agg(F.sum("n").alias("t"))
    return counts.join(total, "name").select("name", "f", F.sqrt(F.col("n") / F.col("t")).alias("w"))


def likeness(names: DataFrame, features: DataFrame) -> DataFrame:
    """names (name, prev_name) with ``cosine`` of their value features, where they share any."""
    a = names.join(features.withColumnRenamed("w", "wa"), "name")
    b = features.select(F.col("name").alias("prev_name"), "f", F.col("w").alias("wb"))
    return a.join(b, ["prev_name", "f"]).groupBy("name", "prev_name").agg(F.sum(F.col("wa") * F.col("wb")).alias("cosine"))


def _spelling(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}%]", "")


def rescue_and_match(tables: DataFrame, columns: DataFrame, register: DataFrame) -> DataFrame:
    """How each column of each file reads against the feed's previous file.

    Rows: feed_id, file_no, table_id, prev_table_id, prev_name, prev_type,
    name, type. ``name`` null: the column was left empty and nothing was
    promoted into it. ``prev_name`` null: a rescued field that is new. The
    first file of a feed has prev_table_id null.
    """
    pairs = file_pairs(tables)
    cols = file_columns(columns)
    now = pairs.join(cols, "table_id").select("feed_id", "file_no", "table_id", "prev_table_id", "name", "type")
    before = pairs.where("prev_table_id is not null").join(
        cols.select(F.col("table_id").alias("prev_table_id"), F.col("name").alias("prev_name"), F.col("type").alias("prev_type")), "prev_table_id"
    ).select("feed_id", "file_no", "table_id", "prev_table_id", "prev_name", "prev_type")
    ids = ["feed_id", "file_no", "table_id", "prev_table_id"]
    first = now.where("prev_table_id is null").select(*ids, F.lit(None).cast("string").alias("prev_name"), F.lit(None).cast("string").alias("prev_type"), "name", "type")
    # Fields the schema in force knows keep their place; the others are rescued.
    read = now.where("prev_table_id is not null").select(*ids, F.col("name").alias("key"), "name", "type").join(
        before.select(*ids, F.col("prev_name").alias("key"), "prev_name", "prev_type"), [*ids, "key"], "full_outer"
    )
    read = cut(read.drop("key"), "drift-read")
    known = read.where("name is not null and prev_name is not null")
    rescued = read.where("prev_name is null").select(*ids, "name", "type")
    empty = read.where("name is null").select(*ids, "prev_name", "prev_type")
    # Promotion: only fields rescued from the same file are compared with the columns that file left empty,
    # and names are compared once, however many files they meet in.
    meet = rescued.join(empty, ids)
    names = cut(meet.select("name", "prev_name").distinct(), "drift-names")
    features = cut(name_features(register_cells(register)), "drift-features")
    scores = (
        names.join(likeness(names, features), ["name", "prev_name"], "left")
        .select(
            "name", "prev_name",
            F.when(_spelling(F.col("name")) == _spelling(F.col("prev_name")), 1.0).otherwise(F.coalesce("cosine", F.lit(0.0))).alias("score"),
        )
        .where(F.col("score") >= SAME_CONTENT)
    )
    scored = cut(meet.join(scores, ["name", "prev_name"]), "drift-score")
    promoted = _mutual_best(scored, ids)
    new = rescued.join(promoted.select(*ids, "name"), [*ids, "name"], "left_anti").select(
        *ids, F.lit(None).cast("string").alias("prev_name"), F.lit(None).cast("string").alias("prev_type"), "name", "type"
    )
    gone = empty.join(promoted.select(*ids, "prev_name"), [*ids, "prev_name"], "left_anti").select(
        *ids, "prev_name", "prev_type", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("type")
    )
    out = [*ids, "prev_name", "prev_type", "name", "type"]
    return known.select(out).unionByName(promoted.select(out)).unionByName(new).unionByName(gone).unionByName(first)


def _mutual_best(scored: DataFrame, ids: list[str]) -> DataFrame:
    """One-to-one promotions: greedily by score within a file (at most columns squared candidates a file)."""
    cand = scored.groupBy(*ids).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "name", "prev_name", "type", "prev_type"))).alias("c")
    )
    kind = "array<struct<s:double,name:string,prev_name:string,type:string,prev_type:string>>"
    taken = lambda acc, x: F.exists(acc, lambda y: (y["name"] == x["name"]) | (y["prev_name"] == x["prev_name"]))
    picked = F.aggregate("c", F.array().cast(kind), lambda acc, x: F.when(taken(acc, x), acc).otherwise(F.concat(acc, F.array(x))))
    return cand.select(*ids, F.explode(picked).alias("p")).select(*ids, "p.name", "p.prev_name", "p.type", "p.prev_type")


def schema_changes(tables: DataFrame, columns: DataFrame, register: DataFrame) -> DataFrame:
    """(feed_id, file_no, change_kind, old_name, new_name): every change against the feed's previous file present.

    change_kind: added, removed, renamed, retyped; a column both renamed and
    retyped gives two rows. The order of columns does not matter. Nulls in
    type compare as equal to null only. The first file of a feed changes
    nothing; empty tables give no rows.
    """
    m = rescue_and_match(tables, columns, register).where("prev_table_id is not null")
    change = lambda kind: F.struct(F.lit(kind).alias("kind"), F.coalesce("prev_name", F.lit("")).alias("o"), F.coalesce("name", F.lit("")).alias("n"))
    both = F.col("name").isNotNull() & F.col("prev_name").isNotNull()
    kinds = F.array(
        F.when(F.col("prev_name").isNull(), change("added")),
        F.when(F.col("name").isNull(), change("removed")),
        F.when(both & (F.col("name") != F.col("prev_name")), change("renamed")),
        F.when(both & ~F.col("type").eqNullSafe(F.col("prev_type")), change("retyped")),
    )
    return m.select("feed_id", "file_no", F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("c")).select(
        "feed_id", "file_no", F.col("c.kind").alias("change_kind"), F.col("c.o").alias("old_name"), F.col("c.n").alias("new_name")
    )


def steady_columns(matches: DataFrame) -> DataFrame:
    """(feed_id, table_id, name, column_id): a column's identity through all its names in a feed.

    column_id is ``table_id:name`` of the column's first appearance. Roots are
    found by pointer doubling, so a feed of n files takes log2(n) joins.
    """
    here = F.concat_ws(":", F.col("table_id").cast("string"), "name")
    prev = F.when(F.col("prev_name").isNotNull(), F.concat_ws(":", F.col("prev_table_id").cast("string"), "prev_name"))
    nodes = matches.where("name is not null").select("feed_id", "table_id", "name", here.alias("node"), F.coalesce(prev, here).alias("root"))
    nodes = cut(nodes, "drift-nodes")
    while True:
        up = nodes.select(F.col("node").alias("root"), F.col("root").alias("next"), F.col("feed_id"))
        nodes = cut(nodes.join(up, ["feed_id", "root"], "left").select("feed_id", "table_id", "name", "node", F.coalesce("next", "root").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "drift-nodes")
        if nodes.where("moved").isEmpty():
            return nodes.select("feed_id", "table_id", "name", F.col("root").alias("column_id"))
        nodes = nodes.drop("moved")


def _targets(matches: DataFrame, ids: DataFrame) -> DataFrame:
    """(feed_id, column_id, column, target): each steady column under the name and type of its latest file; names that come twice get the id behind them."""
    latest = matches.where("name is not null").join(ids, ["feed_id", "table_id", "name"]).groupBy("feed_id", "column_id").agg(
        F.max(F.struct("file_no", "name", "type")).alias("t")
    ).select("feed_id", "column_id", F.col("t.name").alias("column"), F.col("t.type").alias("target"))
    dup = Window.partitionBy("feed_id", "column").orderBy("column_id")
    return latest.withColumn("column", F.when(F.row_number().over(dup) > 1, F.concat_ws("#", "column", "column_id")).otherwise(F.col("column")))


def feed_schemas(tables: DataFrame, columns: DataFrame, register: DataFrame) -> DataFrame:
    """(feed_id, column, target): the steady columns of each feed's table and their types."""
    matches = cut(rescue_and_match(tables, columns, register), "drift-match")
    return _targets(matches, steady_columns(matches)).select("feed_id", "column", "target")


def _json(value: Column) -> Column:
    """A text as a JSON string."""
    return F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)


def ingest_feeds(tables: DataFrame, columns: DataFrame, register: DataFrame, approved: DataFrame | None = None) -> DataFrame:
    """One consistent table for all feeds: (feed_id, file_no, table_id, row_no, values, typed, rescued).

    ``values`` maps steady columns to text in the column's target type, the
    type of its latest file: numbers without separators and percent signs,
    booleans as true/false, dates as yyyy-MM-dd. ``typed`` is the same as a
    JSON object with numbers and booleans as such, from which ``feed_table``
    reads a feed's typed columns. ``rescued`` is a JSON object of the fields
    that are in no profile, are not in ``approved`` (feed_id, column; None
    approves all) or do not cast to the target type. No field of a file that
    counts is lost; of several deliveries of one file the latest counts
    (file_pairs).
    """
    matches = cut(rescue_and_match(tables, columns, register), "drift-match")
    ids = steady_columns(matches)
    latest = _targets(matches, ids)
    if approved is not None:
        latest = latest.join(approved.select("feed_id", "column").distinct(), ["feed_id", "column"], "left_semi")
    plan = ids.join(latest, ["feed_id", "column_id"], "left").select("feed_id", "table_id", "name", "column", "target")
    files = matches.select("feed_id", "file_no", "table_id").distinct()
    cells = register_cells(register).join(files, "table_id").join(plan, ["feed_id", "table_id", "name"], "left")
    typed = replay(F.col("value"), F.col("target"))
    fits = F.col("column").isNotNull() & (typed.isNotNull() | F.col("value").isNull())
    bare = F.when(F.col("target").isin("int64", "double", "bool"), typed).otherwise(_json(typed))
    entry = F.when(fits & F.col("value").isNotNull(), F.struct("column", typed.alias("text"), F.concat(_json(F.col("column")), F.lit(":"), bare).alias("json")))
    made = cells.groupBy("feed_id", "file_no", "table_id", "row_no").agg(
        F.sort_array(F.collect_list(entry)).alias("e"), F.to_json(F.map_from_entries(F.collect_list(F.when(~fits, F.struct("name", "value"))))).alias("rescued"),
    )
    return made.select(
        "feed_id", "file_no", "table_id", "row_no", F.map_from_entries(F.transform("e", lambda x: F.struct(x["column"], x["text"]))).alias("values"),
        F.concat(F.lit("{"), F.array_join(F.transform("e", lambda x: x["json"]), ","), F.lit("}")).alias("typed"), "rescued",
    )


_SPARK_TYPES = {"int64": "bigint", "double": "double", "bool": "boolean"}


def feed_table(rows: DataFrame, feed_id: int, schema: list[tuple[str, str]]) -> DataFrame:
    """The typed table of one feed: file_no, row_no and a typed column for each of ``schema`` (column, target), from rows of ingest_feeds.

    Rows written partitioned by feed_id are read for this feed only. Columns
    whose names clash (with file_no, row_no, or one another but for case) get a number.
    """
    taken, fields = {"file_no", "row_no"}, []
    for name, target in schema:
        kind = "date" if target.startswith("timestamp") else _SPARK_TYPES.get(target, "string")
        alias, k = name, 1
        while alias.lower() in taken:
            k += 1
            alias = f"{name}_{k}"
        taken.add(alias.lower())
        quoted = name.replace("`", "``")
        text = F.col("values")[name] if kind in ("string", "date") else F.from_json("typed", f"`{quoted}` {kind}")[name]
        fields.append((text.try_cast("date") if kind == "date" else text).alias(alias))
    return rows.where(F.col("feed_id") == feed_id).select("file_no", "row_no", *fields)


def replay(value: Column, target: Column) -> Column:
    """A rescued text in its column's type, or null if it does not cast."""
    v = F.trim(value)
    bare = F.regexp_replace(v, r"[,%]", "")
    low = F.lower(v)
    date = F.coalesce(F.try_to_timestamp(v, F.lit("yyyy-MM-dd")), F.try_to_timestamp(v, F.lit("dd/MM/yyyy")), F.try_to_timestamp(v, F.lit("yyyy-MM-dd HH:mm:ss")))
    return (
        F.when(target == "int64", F.when(bare.rlike(r"^-?\d+(\.0+)?$"), F.regexp_replace(bare, r"\.0+$", "").try_cast("bigint").cast("string")))
        .when(target == "double", F.when(bare.rlike(r"^-?\d+(\.\d+)?$"), bare.try_cast("double").cast("string")))
        .when(target == "bool", F.when(low.isin("true", "yes", "y"), "true").when(low.isin("false", "no", "n"), "false"))
        .when(target.startswith("timestamp"), F.date_format(date, "yyyy-MM-dd"))
        .otherwise(value)
    )
