"""Sizes of texts in tokens of a public byte-pair vocabulary."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A rank file of the public tokenizers; it must be at this place on every worker.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of such rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoding(vocabulary: str = VOCABULARY):
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, Path(vocabulary).read_bytes().splitlines())}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(rows: DataFrame, text: str, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """The kept columns and n_tokens of the whole text; a null text has 0."""
    plain = [f"c{i}" for i in range(len(keep))]
    named = rows.select(*(F.col(k).alias(c) for k, c in zip(keep, plain)), F.col(text).cast("string").alias("t"))
    schema = T.StructType([*(f for f in named.schema if f.name != "t"), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoding(vocabulary).encode_ordinary
        for batch in batches:
            sizes = [len(count(t)) if t else 0 for t in (v.as_py() for v in batch.column(len(plain)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64())], names=[*plain, "n_tokens"])

    return named.mapInArrow(run, schema).select(*(F.col(c).alias(k) for c, k in zip(plain, keep)), "n_tokens")
