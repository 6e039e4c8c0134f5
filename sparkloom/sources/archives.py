"""Archives: members streamed under one budget per root archive, nested archives to a fixed depth."""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

from sparkloom.operators.catalog import RESERVED_NAMES
from sparkloom.sources.detect import detect

BLOCK = 256 * 1024
#: Bytes of members' contents that leave a task in one batch.
BATCH_BYTES = 64 * 1024 * 1024
# Families that are opened inside an archive, and their leading bytes.
NESTED = ("archive_zip", "archive_gzip", "archive_7z")
NESTED_MAGIC = (b"PK", b"\x1f\x8b", b"7z")


@dataclass
class Limits:
    depth: int = 3
    total_bytes: int = 2 * 1024**3
    members: int = 10_000
    ratio: float = 100.0
    ratio_from: int = 1024 * 1024


@dataclass
class Found:
    members: list[tuple] = field(default_factory=list)
    failures: list[tuple] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    bytes: int = 0


class Stop(Exception):
    def __init__(self, category: str, message: str, whole: bool = False):
        super().__init__(message)
        self.category, self.whole = category, whole


def safe_path(name: str) -> str | None:
    """The member's path below its target, or None if it would leave it or names a device."""
    p = name.replace("\\", "/")
    if not p.strip() or p.startswith("/") or "\x00" in p or re.match(r"^[A-Za-z]:", p):
        return None
    parts = [s for s in p.split("/") if s not in ("", ".")]
    if not parts or any(s == ".." or s.split(".")[0].strip().lower() in RESERVED_NAMES for s in parts):
        return None
    return "/".join(parts)


def _open(raw: bytes) -> Iterator[tuple[str, bool, int, io.BufferedIOBase | None]]:
    """(name, locked, packed size, stream) of each member."""
    if raw[:2] == b"\x1f\x8b":
        yield "content", False, len(raw), gzip.GzipFile(fileobj=io.BytesIO(raw))
    elif raw[:2] == b"PK":
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            for info in z.infolist():
                if not info.is_dir():
                    locked = bool(info.flag_bits & 1)
                    yield info.filename, locked, max(1, info.compress_size), None if locked else z.open(info)
    else:
        raise Stop("NO_COMPATIBLE_READER", "no reader for this archive", whole=True)


def _take(stream, packed: int, found: Found, limits: Limits) -> bytes:
    out, n = [], 0
    while block := stream.read(BLOCK):
        n += len(block)
        found.bytes += len(block)
        if found.bytes > limits.total_bytes:
            raise Stop("ARCHIVE_SIZE_LIMIT_EXCEEDED", "the archive unpacks to more than its limit", whole=True)
        if n > limits.ratio_from and n > limits.ratio * packed:
            raise Stop("ARCHIVE_SIZE_LIMIT_EXCEEDED", "the member's compression ratio is beyond the limit")
        out.append(block)
    return b"".join(out)


def expand(raw: bytes, limits: Limits | None = None) -> Found:
    """All members of an archive and of the archives in it, with one budget for the whole. Never raises; what is refused is a failure."""
    limits, found = limits or Limits(), Found()

    def go(data: bytes, depth: int, chain: tuple[str, ...]) -> None:
        try:
            for name, locked, packed, stream in _open(data):
                path = safe_path(name)
                shown = "!".join((*chain, name))
                if path is None:
                    found.failures.append((shown, depth, "UNSAFE_MEMBER_PATH", "the path leaves its folder"))
                    continue
                if locked:
                    found.failures.append((shown, depth, "ARCHIVE_MEMBER_LOCKED", "the member is encrypted"))
                    continue
                if len(found.members) >= limits.members:
                    raise Stop("ARCHIVE_MEMBER_LIMIT_EXCEEDED", "more members than the limit", whole=True)
                try:
                    content = _take(stream, packed, found, limits)
                except Stop as s:
                    if s.whole:
                        raise
                    found.failures.append((shown, depth, s.category, str(s)))
                    continue
                except (zipfile.BadZipFile, OSError, EOFError) as e:
                    found.failures.append((shown, depth, "CORRUPT_FILE", str(e)[:200]))
                    continue
                full = "!".join((*chain, path))
                found.members.append((full, depth, hashlib.sha256(content).hexdigest(), len(content), content))
                found.names.append(path)
                if content.startswith(NESTED_MAGIC) and detect(path, content).family in NESTED:
                    if depth >= limits.depth:
                        found.failures.append((full, depth, "ARCHIVE_DEPTH_LIMIT_EXCEEDED", "nested deeper than the limit"))
                    else:
                        go(content, depth + 1, (*chain, path))
        except Stop as s:
            if s.whole and depth > 1 and s.category != "NO_COMPATIBLE_READER":
                raise
            found.failures.append(("!".join(chain), depth, s.category, str(s)))
        except (zipfile.BadZipFile, OSError, EOFError, NotImplementedError) as e:
            found.failures.append(("!".join(chain), depth, "CORRUPT_FILE", str(e)[:200]))

    go(raw, 1, ())
    return found


MEMBERS = "path string, archive_hash string, member_path string, depth int, bytes bigint, content_sha256 string, failure string, message string"


def archive_members(files: DataFrame, limits: Limits | None = None) -> DataFrame:
    """One row per member or failure of archives (path, content)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, raw in zip(b["path"], b["content"], strict=True):
                data = bytes(raw or b"")
                whole, found = hashlib.sha256(data).hexdigest(), expand(data, limits)
                rows.extend((path, whole, p, d, n, h, None, None) for p, d, h, n, _ in found.members)
                rows.extend((path, whole, p, d, None, None, c, m) for p, d, c, m in found.failures)
            df = pd.DataFrame(rows, columns=[x.split()[0] for x in MEMBERS.split(", ")])
            df["bytes"] = df["bytes"].astype("Int64")
            yield df

    return files.select("path", "content").mapInPandas(run, MEMBERS)


CONTENTS = f"{MEMBERS}, file_path string, name string, content binary"


def archive_contents(files: DataFrame, limits: Limits | None = None) -> DataFrame:
    """The rows of archive_members with each member's content, its own name, and ``file_path``: archive path, ``!`` and member path.

    A member path that occurs again in its archive gets ``#`` and a number in
    file_path, so that every member is a file of its own.
    """
    columns = [x.split()[0] for x in CONTENTS.split(", ")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        df = pd.DataFrame(rows, columns=columns)
        df["bytes"] = df["bytes"].astype("Int64")
        return df

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, held = [], 0
            for path, raw in zip(b["path"], b["content"], strict=True):
                data = bytes(raw or b"")
                whole, found, seen = hashlib.sha256(data).hexdigest(), expand(data, limits), set()
                for (p, d, h, n, content), name in zip(found.members, found.names, strict=True):
                    unique, again = p, 1
                    while unique in seen:
                        again += 1
                        unique = f"{p}#{again}"
                    seen.add(unique)
                    rows.append((path, whole, p, d, n, h, None, None, f"{path}!{unique}", name, content))
                    held += n
                    if held > BATCH_BYTES:
                        yield frame(rows)
                        rows, held = [], 0
                rows.extend((path, whole, p, d, None, None, c, m, f"{path}!{p}", None, None) for p, d, c, m in found.failures)
            yield frame(rows)

    return files.select("path", "content").mapInPandas(run, CONTENTS)
