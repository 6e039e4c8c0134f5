"""The corpus walk: every regular file, hidden, extensionless and empty ones included; links are not followed."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

FILES = "relative_path string, size_bytes bigint, mtime_ns bigint, failure string"


def _walk(root: str, start: str) -> Iterator[tuple[str, int | None, int | None, str | None]]:
    todo = [start]
    while todo:
        for found in _one_folder(root, todo.pop()):
            if isinstance(found, str):
                todo.append(found)
            else:
                yield found


def corpus_files(spark: SparkSession, root: str) -> DataFrame:
    """Files below a root that all executors see; what cannot be opened or stated is a row with its failure.

    The root's folders are listed here, and where there are few of them the
    folders below, until there are enough for the cluster; their trees are
    walked in parallel. Loose files above them are listed here.
    """
    want = 4 * spark.sparkContext.defaultParallelism
    folders, loose = [""], []
    for _ in range(4):
        if len(folders) >= want or not folders:
            break
        deeper = []
        for folder in folders:
            found = _one_folder(root, folder)
            loose += [r for r in found if not isinstance(r, str)]
            deeper += [r for r in found if isinstance(r, str)]
        folders = deeper
    out = spark.createDataFrame(loose, FILES)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [r for f in b["folder"] for r in _walk(root, f)]
            df = pd.DataFrame(rows, columns=[x.split()[0] for x in FILES.split(", ")])
            df["size_bytes"], df["mtime_ns"] = df["size_bytes"].astype("Int64"), df["mtime_ns"].astype("Int64")
            yield df

    if folders:
        out = out.unionByName(spark.createDataFrame([(f,) for f in folders], "folder string").repartition(min(len(folders), 4 * want)).mapInPandas(run, FILES))
    return out


def _one_folder(root: str, folder: str) -> list:
    """Folders (text) and files or failures (rows) right below a folder."""
    try:
        entries = sorted(os.scandir(os.path.join(root, folder)), key=lambda e: e.name)
    except OSError as e:
        return [(folder, None, None, f"FILE_ACCESS_ERROR: {e.strerror}")]
    out: list = []
    for e in entries:
        rel = f"{folder}/{e.name}" if folder else e.name
        try:
            if e.is_symlink():
                continue
            if e.is_dir():
                out.append(rel)
            elif e.is_file():
                s = e.stat()
                out.append((rel, s.st_size, s.st_mtime_ns, None))
        except OSError as gone:
            out.append((rel, None, None, f"FILE_ACCESS_ERROR: {gone.strerror}"))
    return out


#: Bytes of a file that travel as a column; a row of a table cannot hold much more.
CONTENT_LIMIT = 1 << 30


def with_content(files: DataFrame, root: str, limit: int = CONTENT_LIMIT) -> DataFrame:
    """(path, content, content_sha256, location, failure): bytes and hash of each file, hashed in blocks.

    A file over the limit has its hash and its location and no content: it is
    identified where it lies, and readers that need all its bytes at once
    record it. A file that is gone or cannot be read has neither and a failure.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p in b["relative_path"]:
                at = os.path.join(root, p)
                content, digest, failure = None, None, None
                try:
                    with open(at, "rb") as f:
                        h, parts, n = hashlib.sha256(), [], 0
                        while block := f.read(1 << 20):
                            h.update(block)
                            n += len(block)
                            parts.append(block)
                            if n > limit:
                                parts.clear()
                        content, digest = b"".join(parts) if n <= limit else None, h.hexdigest()
                except OSError as e:
                    failure = f"FILE_ACCESS_ERROR: {e.strerror}"
                yield pd.DataFrame({"path": [p], "content": [content], "content_sha256": [digest], "location": [at], "failure": [failure]})

    return files.where("failure is null").select("relative_path").mapInPandas(run, "path string, content binary, content_sha256 string, location string, failure string")
