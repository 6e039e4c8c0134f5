"""Deeply nested semi-structured records turned into related flat tables.

Method: structural-variant tables. Every JSON value gets a state from a
bottom-up tree automaton: scalars by their type, arrays by the set of their
elements' states, objects by their members with the members' states. The
automaton's states therefore name *shapes*: two objects have the same state
exactly if they have the same structure all the way down. Rows of one kind
(the member path with the indexes left out) are routed by the shape of their
own members to subtype tables with typed columns; the supertype table of a kind keeps the members
that all its variants share, with the keys and the link to the parent row.

Two passes over the payloads: the first finds which members hold an array
somewhere, the second writes the rows. Each payload is handled on its own, so
no group of rows is ever brought together, and a hot scope needs no treatment.
Values are parsed, normalised, classified and walked with explicit stacks: any
depth of nesting is handled, and every state is computed once.
"""

from __future__ import annotations

import copy
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.common import cut

#: Names of array members that are sent to all tasks. More than this is data used as member names: each record then looks up its own.
MAX_ARRAY_MEMBERS = 100_000
#: Members of arrays of arrays and of the top level have no name of their own.
ROOT = "$"


def as_array(value):
    """The value as the records mean it: text that itself is a JSON array counts as that array."""
    if isinstance(value, str) and value.lstrip(" \t\r\n")[:1] == "[":
        inner = parse(value)
        if isinstance(inner, list):
            return inner
    return value


def parse(payload):
    """The payload's value, or None if it is null or not valid JSON."""
    return parsed(payload)[0]


def parsed(payload) -> tuple[object, str | None]:
    """(value, why there is none). Payloads nested beyond the fast parser's stack are parsed with a stack of their own."""
    if payload is None:
        return None, "null"
    try:
        return json.loads(payload, parse_constant=_no_constant), None
    except RecursionError:
        pass
    except ValueError as e:
        return None, str(e)[:200]
    try:
        return parse_deep(payload), None
    except ValueError as e:
        return None, str(e)[:200]


_SPACE = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*"|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null')


def parse_deep(text: str):
    """A JSON text of any depth. Raises ValueError like the standard parser."""
    stack: list[tuple[list | dict, str | None]] = []  # open containers, each with the member it is at
    at, done, value = 0, False, None
    here: list | dict | None = None
    name: str | None = None

    def bad(where: int):
        raise ValueError(f"not JSON at character {where}")

    def scalar(where: int):
        m = _SCALAR.match(text, where)
        if m is None:
            bad(where)
        return json.loads(m.group()), m.end()

    while True:
        at = _SPACE.match(text, at).end()
        c = text[at : at + 1]
        if done:
            # A value is complete: it goes into the container that is open, or it is the whole.
            if here is None:
                return value if not c else bad(at)
            if isinstance(here, dict):
                here[name] = value
            else:
                here.append(value)
            if c == ",":
                at = _SPACE.match(text, at + 1).end()
            elif c == ("}" if isinstance(here, dict) else "]"):
                value = here
                here, name = stack.pop()
                at += 1
                continue
            else:
                bad(at)
            done = False
        elif c in ("{", "["):
            stack.append((here, name))
            here, name = ({}, None) if c == "{" else ([], None)
            at = _SPACE.match(text, at + 1).end()
            if text[at : at + 1] == ("}" if c == "{" else "]"):
                value, done = here, True
                here, name = stack.pop()
                at += 1
                continue
        else:
            value, at = scalar(at)
            done = True
            continue
        if isinstance(here, dict):
            if text[at : at + 1] != '"':
                bad(at)
            name, at = scalar(at)
            at = _SPACE.match(text, at).end()
            if text[at : at + 1] != ":":
                bad(at)
            at += 1


def normalised(value):
    """The value with every text that is a JSON array replaced by that array, in place where it can be."""
    value = as_array(value)
    todo = [value]
    while todo:
        v = todo.pop()
        pairs = v.items() if isinstance(v, dict) else enumerate(v) if isinstance(v, list) else ()
        for k, x in pairs:
            if isinstance(x, str):
                y = as_array(x)
                if y is x:
                    continue
                v[k] = x = y
            if isinstance(x, (dict, list)):
                todo.append(x)
    return value


def _no_constant(name):
    raise ValueError(name)


def array_members(value) -> set[str]:
    """Names of the members that hold an array somewhere in the (normalised) value."""
    found, todo = set(), [(ROOT, value)]
    while todo:
        name, v = todo.pop()
        if isinstance(v, dict):
            todo.extend(v.items())
        elif isinstance(v, list):
            found.add(name)
            todo.extend((name, x) for x in v)
    return found


def lone_members(value) -> set[str]:
    """Names of the members that hold a lone object somewhere in the (normalised) value: those that another record may show to be arrays."""
    found, todo = set(), [value]
    while todo:
        v = todo.pop()
        if isinstance(v, dict):
            found.update(k for k, x in v.items() if isinstance(x, dict))
            todo.extend(v.values())
        elif isinstance(v, list):
            todo.extend(v)
    return found


_SCALAR_STATES = {type(None): "n", bool: "b", int: "i", float: "f"}


def states(value) -> tuple[str, dict[int, str]]:
    """State of the tree automaton for a normalised value, and of every object and array in it by identity: one bottom-up pass.

    Equal states mean equal structure: scalars by type, arrays by the set of
    their elements' states, objects by their members with the members' states.
    """
    known: dict[int, str] = {}
    names: dict[str, str] = {}

    def of(v) -> str:
        return known[id(v)] if isinstance(v, (dict, list)) else _SCALAR_STATES.get(type(v), "s")

    order, todo = [], [value]
    while todo:
        v = todo.pop()
        if isinstance(v, (dict, list)):
            order.append(v)
            todo.extend(v.values() if isinstance(v, dict) else v)
    for v in reversed(order):
        if isinstance(v, dict):
            inner = ",".join([f"{names.get(k) or names.setdefault(k, json.dumps(k))}:{of(x)}" for k, x in sorted(v.items())])
            known[id(v)] = "o" + hashlib.blake2b(inner.encode(), digest_size=8).hexdigest()
        else:
            inner = "|".join(sorted({of(x) for x in v}))
            known[id(v)] = f"[{inner}]" if len(inner) < 200 else "[" + hashlib.blake2b(inner.encode(), digest_size=8).hexdigest() + "]"
    return of(value), known


def state(value) -> str:
    """State of the tree automaton for any value."""
    return states(normalised(copy.deepcopy(value)))[0]


def own_shape(members: dict) -> list[tuple[str, str]]:
    """An object's scalar members with their types (sorted): what its subtype table has as columns."""
    return [(k, _SCALAR_STATES.get(type(v), "s")) for k, v in sorted(members.items())]


def walk(value, arrays: frozenset[str] | set[str]) -> Iterator[tuple[str, str, str, dict]]:
    """(path, parent path, kind, object) of each object of a normalised value that is a row.

    A lone object under a member of ``arrays`` counts as an array of one.
    Objects under other members belong to the row around them.
    """
    todo = [(ROOT, ROOT, ROOT, ROOT, False, value)]
    while todo:
        name, path, kind, parent, element, v = todo.pop()
        if isinstance(v, dict):
            if name in arrays and name != ROOT and not element:
                path, kind, element = f"{path}[0]", f"{kind}[]", True
            if element:
                yield path, parent, kind, v
                parent = path
            for k, x in reversed(list(v.items())):
                todo.append((k, f"{path}.{k}", f"{kind}.{k}", parent, False, x))
        elif isinstance(v, list):
            for i in range(len(v) - 1, -1, -1):
                todo.append((name, f"{path}[{i}]", f"{kind}[]", parent, True, v[i]))


def array_vocabulary(records: DataFrame, payload: str = "payload") -> DataFrame:
    """Distinct names of array members over all payloads (column member), found by a distributed pass."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for b in batches:
            for p in b.column(0).to_pylist():
                v = parse(p)
                if v is not None:
                    seen |= array_members(normalised(v))
            if len(seen) > MAX_ARRAY_MEMBERS:
                yield pa.RecordBatch.from_pydict({"member": pa.array(sorted(seen), pa.string())})
                seen.clear()
        yield pa.RecordBatch.from_pydict({"member": pa.array(sorted(seen), pa.string())})

    return records.select(payload).mapInArrow(find, "member string").distinct()


def _own_arrays(distinct: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """distinct with ``_arrays``: which of a payload's lone members are array members somewhere. For vocabularies too large to send."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            take, names = [], []
            for i, p in enumerate(b.column(1).to_pylist()):
                v = parse(p)
                mine = lone_members(normalised(v)) if v is not None else ()
                take += [i] * len(mine)
                names += mine
            yield pa.RecordBatch.from_pydict({"_hash": b.column(0).take(pa.array(take, pa.int64())), "member": pa.array(names, pa.string())})

    keyed = distinct.withColumn("_hash", F.sha2("_payload", 256))
    asked = keyed.select("_hash", "_payload").mapInArrow(ask, "_hash string, member string").distinct()
    own = asked.join(vocabulary, "member", "left_semi").groupBy("_hash").agg(F.collect_list("member").alias("_arrays"))
    return keyed.join(own, "_hash", "left").drop("_hash")


ROWS = T.StructType(
    [
        T.StructField("child_path", T.StringType(), False),
        T.StructField("parent_path", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("variant", T.StringType(), False),
        T.StructField("shape", T.StringType(), False),
        T.StructField("members", T.StringType(), False),
    ]
)


def flatten_records(records: DataFrame, keys: list[str], payload: str = "payload") -> DataFrame:
    """Every object in an array as a row: keys, paths, kind, variant, shape and its own members as JSON.

    variant: state of the automaton (structure all the way down). shape: the
    members the row holds itself, nested plain objects as dotted members.
    Repeated records (same keys and payload) give their rows once. Null,
    cut-off and otherwise invalid payloads give none; null and empty members
    give none. Extra columns are ignored, an empty table gives none.
    """
    vocabulary = cut(array_vocabulary(records, payload), "array-members")
    known = vocabulary.limit(MAX_ARRAY_MEMBERS + 1).collect()
    schema = T.StructType([*[records.schema[k] for k in keys], *ROWS.fields])
    distinct = records.select(*keys, F.col(payload).alias("_payload")).dropDuplicates()
    if len(known) > MAX_ARRAY_MEMBERS:
        shared, distinct = None, _own_arrays(distinct, vocabulary)
    else:
        shared, distinct = frozenset(r.member for r in known), distinct.withColumn("_arrays", F.lit(None).cast("array<string>"))
    columns = [*keys, "_payload", "_arrays"]

    def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes: dict[str, str] = {}
        for b in batches:
            take, cols = [], {f.name: [] for f in ROWS}
            for i, (p, own) in enumerate(zip(b.column(len(keys)).to_pylist(), b.column(len(keys) + 1).to_pylist(), strict=True)):
                v = parse(p)
                if v is None:
                    continue
                v = normalised(v)
                arrays = shared if shared is not None else array_members(v) | set(own or ())
                variants = states(v)[1]
                for path, parent, kind, obj in walk(v, arrays):
                    flat = _own_members(obj, arrays)
                    take.append(i)
                    cols["child_path"].append(path)
                    cols["parent_path"].append(parent)
                    cols["kind"].append(kind)
                    variant = variants[id(obj)]
                    cols["variant"].append(variant)
                    # Objects of one state have the same members at any place with the same array names.
                    shape = shapes.get(variant) if shared is not None else None
                    if shape is None:
                        if len(shapes) > 100_000:
                            shapes.clear()
                        shape = shapes[variant] = json.dumps(own_shape(flat))
                    cols["shape"].append(shape)
                    cols["members"].append(json.dumps(flat, ensure_ascii=False))
                    if len(take) >= 20_000:
                        yield _batch(b, take, cols, len(keys))
                        take, cols = [], {f.name: [] for f in ROWS}
            if take:
                yield _batch(b, take, cols, len(keys))

    return distinct.select(*columns).mapInArrow(flatten, schema)


def rejected_records(records: DataFrame, keys: list[str], payload: str = "payload") -> DataFrame:
    """keys and reason of the records whose payload gives no rows because it is null or not valid JSON, once each."""
    schema = T.StructType([*[records.schema[k] for k in keys], T.StructField("reason", T.StringType())])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            why = [parsed(p)[1] for p in b.column(len(keys)).to_pylist()]
            idx = pa.array([i for i, w in enumerate(why) if w], pa.int64())
            kept = {b.schema.names[k]: b.column(k).take(idx) for k in range(len(keys))}
            yield pa.RecordBatch.from_pydict(kept | {"reason": pa.array([w for w in why if w], pa.string())})

    return records.select(*keys, F.col(payload).alias("_payload")).mapInArrow(look, schema).distinct()


def _batch(b: pa.RecordBatch, take: list[int], cols: dict, n: int) -> pa.RecordBatch:
    idx = pa.array(take, pa.int64())
    kept = {b.schema.names[k]: b.column(k).take(idx) for k in range(n)}
    return pa.RecordBatch.from_pydict(kept | {k: pa.array(v, pa.string()) for k, v in cols.items()})


def _own_members(obj: dict, arrays: frozenset[str]) -> dict:
    """The members that stay with the row: scalars, scalar arrays and plain nested objects (dotted)."""
    out, todo = {}, [("", obj)]
    while todo:
        head, o = todo.pop()
        for k, v in o.items():
            if isinstance(v, dict):
                if k not in arrays:
                    todo.append((f"{head}{k}.", v))
            elif isinstance(v, list):
                if v and not any(isinstance(x, (dict, list)) for x in v):
                    out[head + k] = json.dumps(v, ensure_ascii=False)
            else:
                out[head + k] = v
    return out


_TYPES = {"i": T.LongType(), "f": T.DoubleType(), "b": T.BooleanType()}


def variant_catalog(rows: DataFrame) -> DataFrame:
    """Kinds with their shapes, row counts and the members all variants of the kind share.

    One row per (kind, shape): grows with the schema, not with the data.
    """
    shapes = rows.groupBy("kind", "shape").agg(F.count(F.lit(1)).alias("n_rows"), F.approx_count_distinct("variant").alias("n_variants"))
    names = F.transform(F.from_json("shape", "array<array<string>>"), lambda m: m[0])
    # The shared members are an intersection: members that occur in as many shapes of the kind as there are.
    exploded = shapes.select("kind", "shape", F.explode_outer(names).alias("m"))
    totals = shapes.groupBy("kind").agg(F.count(F.lit(1)).alias("k"))
    common = (
        exploded.groupBy("kind", "m").agg(F.count(F.lit(1)).alias("c")).join(totals, "kind").where("c = k")
        .groupBy("kind").agg(F.sort_array(F.collect_list("m")).alias("common_members"))
    )
    return shapes.join(common, "kind", "left").withColumn("common_members", F.coalesce("common_members", F.array().cast("array<string>")))


def subtype_table(rows: DataFrame, kind: str, shape: str, keys: list[str]) -> DataFrame:
    """The typed table of one variant: keys, parent link and a column per member of the shape.

    Member names that clash with a key or link column get the prefix ``m_``.
    """
    taken = {c.lower() for c in (*keys, "child_path", "parent_path")}
    cols = []
    for name, kind_of in json.loads(shape):
        as_type = _TYPES.get(kind_of, T.StringType())
        alias = name if name.lower() not in taken else f"m_{name}"
        while alias.lower() in taken:
            alias = f"m_{alias}"
        taken.add(alias.lower())
        path = "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"
        cols.append(F.get_json_object("members", path).cast(as_type).alias(alias))
    picked = rows.where((F.col("kind") == kind) & (F.col("shape") == shape))
    return picked.select(*keys, "child_path", "parent_path", *cols)


def supertype_table(rows: DataFrame, kind: str, common: list[str], keys: list[str]) -> DataFrame:
    """All rows of a kind with the members its variants share (as text) and the rest as JSON."""
    taken = {c.lower() for c in (*keys, "child_path", "parent_path", "variant", "members")}
    cols = []
    for name in common:
        alias = name
        while alias.lower() in taken:
            alias = f"m_{alias}"
        taken.add(alias.lower())
        cols.append(F.get_json_object("members", "$['" + name.replace("'", "\\'") + "']").alias(alias))
    return rows.where(F.col("kind") == kind).select(*keys, "child_path", "parent_path", "variant", *cols, "members")


def subtype_tables(rows: DataFrame, path: str, keys: list[str]) -> dict[tuple[str, str], DataFrame]:
    """Every variant's typed table by (kind, shape). Rows are routed once, by one write in partitions by kind and shape below ``path``; a table reads its own partition."""
    routed = rows.withColumn("_to", F.substring(F.sha2(F.concat_ws("\0", "kind", "shape"), 256), 1, 16))
    routed.repartition("_to", F.pmod(F.xxhash64(*keys, "child_path"), F.lit(8))).write.partitionBy("_to").parquet(path)
    stored = rows.sparkSession.read.parquet(path)
    made = rows.sparkSession.read.parquet(path).select("kind", "shape", "_to").distinct().orderBy("kind", "shape").collect()  # one row for each variant of the schema
    return {(r.kind, r.shape): subtype_table(stored.where(F.col("_to") == r["_to"]), r.kind, r.shape, keys) for r in made}
