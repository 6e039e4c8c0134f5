"""Text units and chunks: heading units, size-bounded units, the recursive character splitter, ids and offsets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NUL = "\x00"
#: Separators of the recursive splitter, strongest first.
SEPARATORS = ("\n\n", "\n", " ", "")


class LocateError(ValueError):
    """A piece that is not in its unit."""


def _cut_keeping(text: str, separator: str) -> list[str]:
    """The text cut before each separator, which stays at the start of the piece after it."""
    if not separator:
        return list(text)
    head, *rest = text.split(separator)
    return [p for p in (head, *(separator + r for r in rest)) if p]


def _merge(parts: list[str], size: int, overlap: int) -> Iterator[str]:
    """Join small parts to chunks of at most ``size``, each starting with up to ``overlap`` characters of the one before."""
    held: list[str] = []
    total = 0
    for p in parts:
        if held and total + len(p) > size:
            joined = "".join(held).strip()
            if joined:
                yield joined
            while total > overlap or (total > 0 and total + len(p) > size):
                total -= len(held.pop(0))
        held.append(p)
        total += len(p)
    joined = "".join(held).strip()
    if joined:
        yield joined


def split_recursively(text: str, size: int, overlap: int, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Chunks of a text: cut at the first separator it has, too long parts again at the weaker ones, small parts joined."""
    if overlap > size:
        raise ValueError("the overlap is larger than the chunk size")
    at = next(i for i, s in enumerate(separators) if s == "" or s in text)
    weaker = separators[at + 1 :]
    out: list[str] = []
    small: list[str] = []
    for part in _cut_keeping(text, separators[at]):
        if len(part) < size:
            small.append(part)
            continue
        out.extend(_merge(small, size, overlap))
        small = []
        if weaker:
            out.extend(split_recursively(part, size, overlap, weaker))
        else:
            out.append(part)
    out.extend(_merge(small, size, overlap))
    return out


def locate(pieces: list[str], unit: str) -> list[int]:
    """Where each piece starts in its unit: searched from behind the start of the one before, then from the beginning."""
    out, cursor = [], 0
    for p in pieces:
        at = unit.find(p, cursor)
        if at < 0:
            at = unit.find(p)
        if at < 0:
            raise LocateError("a chunk is not part of its unit")
        out.append(at)
        cursor = at + 1
    return out


def chunk_id(scope: Column, content: Column, config: Column, unit_sequence: Column, seq: Column) -> Column:
    """First 32 digits of sha256 over scope, content, configuration, unit and sequence; the path is no part of it."""
    return F.substring(F.sha2(F.concat_ws(NUL, scope, content, config, unit_sequence.cast("string"), seq.cast("string")), 256), 1, 32)


CHUNKS = (
    "scope_id string, content_sha256 string, unit_type string, unit_ref string, unit_sequence int, piece_no int, char_start int, char_end int, text string, text_sha256 string"
)


def split_units(units: DataFrame, size: int = 1000, overlap: int = 120, minimum: int = 1) -> DataFrame:
    """Pieces of text units (scope_id, content_sha256, unit_type, unit_ref, unit_sequence, text). Blank units and pieces shorter than ``minimum`` give none."""
    names = ["scope_id", "content_sha256", "unit_type", "unit_ref", "unit_sequence"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            take, rows = [], []
            for i, t in enumerate(b.column(5).to_pylist()):
                if not t or not t.strip():
                    continue
                pieces = split_recursively(t, size, overlap)
                for n, (p, at) in enumerate(zip(pieces, locate(pieces, t), strict=True)):
                    if len(p) >= minimum:
                        take.append(i)
                        rows.append((n, at, at + len(p), p, hashlib.sha256(p.encode()).hexdigest()))
            if rows:
                idx = pa.array(take, pa.int64())
                cols = list(zip(*rows, strict=True))
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string())
                extra = ("piece_no", "char_start", "char_end", "text", "text_sha256")
                yield pa.RecordBatch.from_pydict(
                    {n: b.column(i).take(idx) for i, n in enumerate(names)} | {n: pa.array(c, k) for n, c, k in zip(extra, cols, kinds, strict=True)}
                )

    return units.select(*names[:4], F.col("unit_sequence").cast("int"), "text").mapInArrow(run, CHUNKS)


#: Units of a document whose chunks are numbered together.
UNITS_TOGETHER = 64


def number_in_document(rows: DataFrame, document: list[str], unit: str, order: list[str], name: str) -> DataFrame:
    """rows with ``name``, counting from 0 through each document by unit and ``order``.

    A document's chunks are numbered stretch by stretch of UNITS_TOGETHER
    units, and stretches are shifted by the sizes of those before them, so that
    a document that holds a third of all chunks is no single task.
    """
    cut_up = rows.withColumn("_stretch", F.floor(F.col(unit) / UNITS_TOGETHER))
    keys = [*document, "_stretch"]
    sizes = cut_up.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.partitionBy(*document).orderBy(F.col("_stretch").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))
    shifts = sizes.select(*[F.col(k).alias(f"_d{i}") for i, k in enumerate(keys)], F.coalesce(before, F.lit(0)).alias("_shift"))
    same = [F.col(k).eqNullSafe(F.col(f"_d{i}")) for i, k in enumerate(keys)]
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(unit, *order)) - 1
    return cut_up.withColumn("_at", within).join(shifts, same).withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_shift", "_stretch", *[f"_d{i}" for i in range(len(keys))])


def number_chunks(pieces: DataFrame, config: str) -> DataFrame:
    """pieces with ``seq``, running through a document's units, and ``chunk_id``."""
    p = number_in_document(pieces, ["scope_id", "content_sha256"], "unit_sequence", ["piece_no"], "seq").withColumn("seq", F.col("seq").cast("int"))
    return p.withColumn("chunk_id", chunk_id(F.col("scope_id"), F.col("content_sha256"), F.lit(config), F.col("unit_sequence"), F.col("seq"))).drop("piece_no")


def heading_units(lines: DataFrame) -> DataFrame:
    """(doc_id, unit_no, heading, n_lines, text): lines (doc_id, ord, line, is_heading) cut before each heading; what precedes the first is one unit."""
    w = Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumn("unit_no", F.sum(F.col("is_heading").cast("int")).over(w))
    return marked.groupBy("doc_id", "unit_no").agg(
        F.max(F.when(F.col("is_heading"), F.col("line"))).alias("heading"), F.count(F.lit(1)).alias("n_lines"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "line"))), lambda x: x["line"]), "\n").alias("text"),
    )


def text_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ord, line): the lines of each text."""
    return docs.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, "\n")).alias("ord", "line"))


def size_bounded_units(entries: Column, limit: int) -> Column:
    """array<struct<unit,first,last,chars>>: entries (array<struct<key,text>>) cut where the key changes or a unit would pass ``limit`` characters.

    A running sum with reset, as a fold over one record's entries.
    """
    kind = "array<struct<key:string,first:int,last:int,chars:int>>"

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        n = F.length(x["text"])
        fits = (F.size(acc) > 0) & (last["key"] == x["key"]) & (last["chars"] + n <= limit)
        grown = F.struct(last["key"].alias("key"), last["first"].alias("first"), (last["last"] + 1).alias("last"), (last["chars"] + n).alias("chars"))
        at = F.coalesce(last["last"] + 1, F.lit(0))
        fresh = F.struct(x["key"].alias("key"), at.alias("first"), at.alias("last"), n.alias("chars"))
        return F.when(fits, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(grown))).otherwise(F.concat(acc, F.array(fresh))).cast(kind)

    return F.aggregate(entries, F.array().cast(kind), step)
