"""Extracted tables: header test, round-trip typing, profiles, coercion, flattened records."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import strip

#: A whole number as Python writes it.
INTEGER = r"^(0|-?[1-9][0-9]*)$"
#: What Python reads as a whole number, whether or not it would write it so.
INTEGER_LIKE = r"^[+-]?[0-9]+(_[0-9]+)*$"
#: What may be a number at all; only such texts are looked at one by one.
NUMBER_LIKE = r"(?i)^[+-]?([0-9][0-9_]*\.?[0-9_]*|\.[0-9_]+)(e[+-]?[0-9]+)?$|^[+-]?(inf|infinity|nan)$"


def is_int(c: Column) -> Column:
    """True if the text is a whole number within 64 bits, written as it would be written back. ``0012`` is not."""
    s = strip(c)
    return F.when(s.isNotNull(), s.rlike(INTEGER) & s.try_cast("bigint").isNotNull())


def parses_int(c: Column) -> Column:
    return strip(c).rlike(INTEGER_LIKE)


def float_round_trips(t: str | None) -> bool | None:
    """True if the text is one of the ways Python writes its float value."""
    if t is None:
        return None
    t = t.strip()
    try:
        x = float(t)
    except ValueError:
        return False
    return t in (repr(x), str(x), f"{x:g}")


def is_float(c: Column) -> Column:
    """True if the text equals one of the ways its float value is written; ``2.50`` does not. Java and Python write floats differently, so this runs in Python."""

    @F.pandas_udf("boolean")
    def check(s: pd.Series) -> pd.Series:
        return s.map(float_round_trips)

    return check(c)


def infer_types(cells: DataFrame, infer: bool = True) -> DataFrame:
    """(table_name, name, n_values, null_count, type, rejected_reason) of columns of cells (table_name, name, value and, if there is one, native_kind).

    Blank values are null in every type. native_kind is what the file says a
    value is: number, bool, date or text (null and anything else count as
    text). Order: inference disabled, empty, whole numbers, numbers, bool,
    date, mixed kinds, text. Text becomes a number only if every value is
    written as that number would be written; a column whose values read as
    numbers but are not written as such stays text and says why.
    """
    v = F.when(strip(F.col("value")) == "", None).otherwise(strip(F.col("value")))
    native = F.col("native_kind") if "native_kind" in cells.columns else F.lit("text")
    native = F.when(native.isin("number", "bool", "date"), native).otherwise("text")
    c = cells.select("table_name", "name", v.alias("v"), native.alias("k"))
    flags = c.select(
        "table_name", "name", "v", F.when(F.col("v").isNotNull(), F.col("k")).alias("k"), is_int(F.col("v")).alias("i"), parses_int(F.col("v")).alias("p"),
        F.when(F.col("v").isNotNull(), is_int(F.col("v")) | F.coalesce(is_float(F.when(F.col("v").rlike(NUMBER_LIKE), F.col("v"))), F.lit(False))).alias("f"),
        F.when(F.col("v").isNotNull(), F.col("v").try_cast("double").isNotNull()).alias("d"),
        F.when(F.col("v").isNotNull(), F.col("v").try_cast("timestamp_ntz").isNotNull()).alias("t"),
    )
    agg = flags.groupBy("table_name", "name").agg(
        F.count("v").alias("n_values"), F.sum(F.col("v").isNull().cast("int")).alias("null_count"),
        F.bool_and("i").alias("i"), F.bool_and("p").alias("p"), F.bool_and("f").alias("f"), F.bool_and("d").alias("d"),
        F.bool_and("t").alias("t"), F.min("k").alias("k0"), F.max("k").alias("k1"),
    )
    one = F.when(F.col("k0") == F.col("k1"), F.col("k0"))
    kind = (
        F.when(F.lit(not infer) | (F.col("n_values") == 0), "string").when(F.col("i") & one.isin("number", "text"), "int64").when(F.col("d") & (one == "number"), "double")
        .when(one == "bool", "bool").when((one == "date") & F.col("t"), "timestamp").when(one.isNull(), "string").when(F.col("f"), "double").otherwise("string")
    )
    reason = F.when(F.lit(not infer), "inference disabled").when((F.col("n_values") > 0) & one.isNull(), "mixed kinds").when((one == "date") & ~F.col("t"), "times without a day").when((kind == "string") & F.col("p"), "integers that do not round-trip").when((kind == "string") & F.col("d"), "numbers that do not round-trip")
    return agg.select("table_name", "name", "n_values", "null_count", kind.alias("type"), reason.alias("rejected_reason"))


def has_header(cells: DataFrame) -> DataFrame:
    """(table_name, header_detected): the first row (row_no 0) is complete, unique and holds no number."""
    first = cells.where("row_no = 0").select("table_name", strip(F.coalesce("value", F.lit(""))).alias("v"))
    number = F.col("v").rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$")
    return first.groupBy("table_name").agg(
        (F.bool_and(F.col("v") != "") & (F.count("v") == F.count_distinct("v")) & ~F.bool_or(number)).alias("header_detected")
    )


def column_names(labels: list[str]) -> list[str]:
    """Unique column names in order: blanks by position, repeats with a number until they are unique."""
    out: list[str] = []
    for i, label in enumerate(labels):
        base = (label or "").strip() or f"column_{i}"
        name, n = base, 0
        while name.lower() in {x.lower() for x in out}:
            n += 1
            name = f"{base}_{n}"
        out.append(name)
    return out


def coerce(c: Column, kind: str) -> Column:
    """A text in its column's type; blank is null, and no value is lost: what does not cast stays text by the profile's choice of type."""
    v = F.when(strip(c) == "", None).otherwise(strip(c))
    return {"int64": v.try_cast("bigint"), "double": v.try_cast("double"), "bool": v.try_cast("boolean"), "timestamp": v.try_cast("timestamp_ntz")}.get(kind, v)


def typed_table(cells: DataFrame, types: dict[str, str], keys: list[str]) -> DataFrame:
    """One table's cells (keys, name, value) as rows with a typed column per name."""
    text = cells.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in types])
    return text.select(*keys, *[coerce(F.col(f"`{n}`"), t).alias(n) for n, t in types.items()])


def key_jaccard(records: DataFrame) -> DataFrame:
    """(group_id, n_pairs, mean_jaccard) over pairs of a group's first 50 key sets (group_id, ord, keys).

    The rule looks at 50 sets a group, so a group is one short array, and its
    pairs are compared inside the row.
    """
    sets = records.where("ord < 50").groupBy("group_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "keys"))), lambda x: x["keys"]).alias("s"))
    likeness = lambda a, b: F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))
    pairs = F.flatten(F.transform("s", lambda a, i: F.transform(F.slice("s", i + 2, F.greatest(F.size("s") - i - 1, F.lit(0))), lambda b: likeness(a, b))))
    return sets.withColumn("p", pairs).where(F.size("p") > 0).select(
        "group_id", F.size("p").cast("bigint").alias("n_pairs"), F.round(F.aggregate("p", F.lit(0.0), lambda x, y: x + y) / F.size("p"), 9).alias("mean_jaccard")
    )
