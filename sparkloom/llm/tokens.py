"""Text sizes in tokens of a public tokenizer whose vocabulary file is given by path."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Default vocabulary: byte-level BPE for many languages. Never part of this repository.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LOADED: dict[str, object] = {}


def encoding(path: str = VOCABULARY):
    """The tokenizer of a vocabulary file, loaded once per worker."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def count_tokens(docs: DataFrame, keys: list[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """keys and n_tokens of each row; null and empty texts have 0. Whole texts; rows come out as they went in."""
    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys) + ", n_tokens bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_pydict({k: b.column(i) for i, k in enumerate(keys)} | {"n_tokens": pa.array(n, pa.int64())})

    return docs.select(*keys, F.col(text).alias("_text")).mapInArrow(run, schema)
