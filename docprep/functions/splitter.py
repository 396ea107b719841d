"""The recursive character splitter: pieces up to a size, cut at the coarsest separator that works, with an overlap."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATORS = ("\n\n", "\n", " ", "")
SIZE, OVERLAP = 3000, 100


def _parts(text: str, separator: str) -> list[str]:
    """The text cut before each separator; the separator stays at the start of what follows it."""
    if not separator:
        return list(text)
    first, *rest = text.split(separator)
    return [p for p in (first, *(separator + r for r in rest)) if p]


def _joined(parts: list[str], size: int, overlap: int) -> Iterator[str]:
    """Neighbouring parts put together up to the size; the next piece takes over the last parts within the overlap."""
    held: deque[str] = deque()
    length = 0
    for part in parts:
        if held and length + len(part) > size:
            if whole := "".join(held).strip():
                yield whole
            while length > overlap or (length and length + len(part) > size):
                length -= len(held.popleft())
        held.append(part)
        length += len(part)
    if whole := "".join(held).strip():
        yield whole


def split_recursively(text: str, size: int = SIZE, overlap: int = OVERLAP, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Pieces of at most `size` code points where a separator allows it, stripped, neighbours sharing up to `overlap`."""
    level = next((i for i, s in enumerate(separators) if not s or s in text), len(separators) - 1)
    finer = separators[level + 1 :] if separators[level] else ()
    out: list[str] = []
    small: list[str] = []
    for part in _parts(text, separators[level]):
        if len(part) < size:
            small.append(part)
            continue
        out += _joined(small, size, overlap)
        small = []
        out += split_recursively(part, size, overlap, finer) if finer else [part]
    return [*out, *_joined(small, size, overlap)]


def split_column(text: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """array<string>: the pieces of a text above the size; one of the size or below stays whole and never leaves the JVM."""

    @F.pandas_udf("array<string>")
    def pieces(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else split_recursively(t, size, overlap))

    long = F.length(text) > size
    return F.when(long, pieces(F.when(long, text))).otherwise(F.array(text))
