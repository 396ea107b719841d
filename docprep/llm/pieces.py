"""Splitting oversized items at natural boundaries, by ranges with halos.

A text or file is a row of blocks of a fixed size. A worker gets a range of blocks and a halo on both sides and finds
the boundaries there; with its neighbours it agrees, without talking to them, on the boundary where one block's pieces
end and the next one's begin: the strongest near the block's edge. The tables of boundaries of all ranges are stitched,
their counts and lengths summed up, and pieces come out by offset. No worker holds a whole file, and as blocks hang
on the limit alone, the pieces don't depend on how many blocks a range has.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docprep.session import cut, never_sent

_GAP = re.compile(r"\s+(?=\S)|[。！？；](?=\S)|[，、](?=\S)")
_SENTENCE_END = re.compile(r"[.!?。！？][\"'”’)\]]*$")
PARAGRAPH, LINE, SENTENCE, WORD, NONE = 4, 3, 2, 1, 0
#: A block of a text is so many times the limit long, in code points; a block of a file is so many times longer still, in bytes.
BLOCK, FILE_BLOCK = 4, 16
#: Most tasks that files are spread over.
MOST_TASKS = 100_000
_ESCAPED = re.compile("[\udc80-\udcff]")


def boundaries(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """(position, level) of the places in [start, end] where something new begins: a paragraph, line, sentence or word."""
    for m in _GAP.finditer(text, max(0, start - 1), min(len(text), end + 1)):
        if not start <= m.end() <= end:
            continue
        gap = m.group()
        if gap in "，、":
            yield m.end(), WORD
        elif gap in "。！？；":
            yield m.end(), SENTENCE
        else:
            breaks = max(gap.count("\n"), gap.count("\r"))
            if m.start() == max(0, start - 1) and breaks < 2:  # the gap may begin before
                before = text[max(0, m.start() - 8) : m.end()]
                before = before[len(before.rstrip()) :]
                breaks = max(before.count("\n"), before.count("\r"))
            ends = _SENTENCE_END.search(text, max(0, m.start() - 6), m.start())
            yield m.end(), PARAGRAPH if breaks > 1 else LINE if breaks else SENTENCE if ends else WORD


def _strongest(text: str, start: int, end: int, near: int) -> int | None:
    """The place of the highest level in [start, end], of these the one nearest to `near`, the earlier of two."""
    best = max(boundaries(text, start, end), key=lambda b: (b[1], -abs(b[0] - near), -b[0]), default=None)
    return best and best[0]


def _between_characters(text: str, at: int) -> int:
    """The place, or one shortly before it that doesn't part a letter from its marks, a joined picture or a line end."""
    for back in range(min(32, at)):
        c, before = text[at - back : at - back + 1], text[at - back - 1 : at - back]
        joined = c and (unicodedata.combining(c) or c in "‍︎️" or "\U0001f3fb" <= c <= "\U0001f3ff")
        if not (joined or before == "‍" or before == "\r" and c == "\n"):
            return at - back
    return at


def anchor(text: str, edge: int, reach: int) -> int:
    """Where the pieces of two neighbouring ranges meet: the strongest boundary within reach of the edge."""
    found = _strongest(text, max(1, edge - reach), min(len(text), edge + reach), edge)
    return found if found is not None else _between_characters(text, edge)


def _overlapped(text: str, end: int, overlap: int) -> int:
    """Where the piece after a cut begins: the first sentence or line, else word, within the overlap before the cut."""
    if not overlap or end <= 0:
        return end
    found = [b for b in boundaries(text, max(1, end - overlap), end) if b[0] < end]  # the cut itself would be no overlap
    if not found:
        return _between_characters(text, max(0, end - overlap))
    return next((at for at, level in found if level >= SENTENCE), found[0][0])


def cut_range(text: str, lo: int, hi: int, first: bool, last: bool, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of the range [lo, hi) of a text seen with its halo."""
    start = 0 if first else anchor(text, lo, limit // 2)
    stop = len(text) if last else anchor(text, hi, limit // 2)
    out: list[tuple[int, int]] = []
    if start >= stop:
        return [(0, 0)] if first and last else []
    at = start if first else _overlapped(text, start, overlap)
    while stop - at > limit:
        most = min(at + limit, stop - limit // 2)  # what is left is no scrap within the overlap
        end = _strongest(text, at + limit // 2, most, most)
        end = _between_characters(text, most) if end is None else end
        out.append((at, end))
        at = _overlapped(text, end, overlap)
    return [*out, (at, stop)]


def _check(limit: int, overlap: int) -> None:
    if limit < 2 or not 0 <= overlap < limit // 2 - 32 * (limit > 64):
        raise ValueError("the overlap must stay well below half of the limit")


def _cuts(text: str, base: int, size: int, blocks: range, block: int, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of some blocks of a text of that size, seen through a window that begins at base."""
    top = max(0, -(-(size - limit) // block) - 1)  # a rest within the limit belongs to the block before it
    out: list[tuple[int, int]] = []
    for k in blocks:
        lo, hi = k * block, size if k == top else (k + 1) * block
        out += [(base + a, base + b) for a, b in cut_range(text, lo - base, hi - base, k == 0, k == top, limit, overlap)]
    return out


def split_texts(rows: DataFrame, text: str, keys: list[str], carry: tuple[str, ...] = (), limit: int = 3000, overlap: int = 100, blocks: int = 1) -> DataFrame:
    """(keys, carry, piece_no, start, end, piece): ordered pieces of at most `limit` code points.

    A text within the limit is one piece and stays in the JVM. A longer one is cut before a paragraph, else a line,
    a sentence or a word in the second half of the limit, else between two characters; a piece begins at most `overlap`
    before the end of the one before. Pieces are exact substrings, [start, end) in code points, and cover the text.
    A worker cuts a range of `blocks` blocks at a time, which doesn't change the pieces. A null text has no pieces, ''
    has one empty piece. Repeated rows each come out, and so do different texts that share their keys. Other columns
    are not read. An empty table gives an empty result.
    """
    _check(limit, overlap)
    names = [*keys, *carry]
    plain = [f"c{i}" for i in range(len(names))]
    named = rows.select(*(F.col(n).alias(c) for n, c in zip(names, plain)), F.col(text).cast("string").alias("t")).where("t is not null").withColumn("n", F.length("t"))
    zero = F.lit(0).cast("bigint")
    short = named.where(F.col("n") <= limit).select(*plain, F.lit(0).alias("piece_no"), zero.alias("start"), F.col("n").cast("bigint").alias("end"), F.col("t").alias("piece"))
    # numbered, sliced and checkpointed in one task each: a row keeps its number whatever is lost later
    windows = cut(_windows(named.where(F.col("n") > limit).drop("n").withColumn("row", F.monotonically_increasing_id()), limit, blocks))
    table = _boundary_table(windows.select("row", "range_no", "base", "n", "t").repartition("row", "range_no"), limit, overlap, blocks)
    upto = Window.partitionBy("row").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    stitched = table.withColumn("before", F.coalesce(F.sum(F.size("starts")).over(upto), F.lit(0)))
    joined = windows.select(*plain, "row", "range_no", "base", "t").join(never_sent(stitched), ["row", "range_no"])

    def piece(x: Column, i: Column) -> Column:
        begin = (x["starts"] - F.col("base")).cast("int")
        return F.struct(
            (F.col("before") + i).cast("int").alias("piece_no"), x["starts"].alias("start"), x["ends"].alias("end"), F.substring(F.col("t"), begin + 1, (x["ends"] - x["starts"]).cast("int")).alias("piece")
        )

    long = joined.select(*plain, F.inline(F.transform(F.arrays_zip("starts", "ends"), piece)))
    return short.unionByName(long).select(*(F.col(c).alias(n) for c, n in zip(plain, names)), "piece_no", "start", "end", "piece")


def _windows(texts: DataFrame, limit: int, blocks: int) -> DataFrame:
    """A row for each range of blocks of a text: its columns, range_no, base, n and, as t, the range with its halo."""
    others = [f for f in texts.schema if f.name != "t"]
    schema = T.StructType([*others, T.StructField("range_no", T.IntegerType()), T.StructField("base", T.LongType()), T.StructField("n", T.LongType()), T.StructField("t", T.StringType())])
    block = BLOCK * limit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of: list[int] = []
            made: list[tuple[int, int, int, str]] = []
            held = 0
            for i, value in enumerate(batch.column("t")):
                t = value.as_py()
                top = max(0, -(-(len(t) - limit) // block) - 1)
                for r, first in enumerate(range(0, top + 1, blocks)):
                    base = max(0, first * block - limit)
                    stop = len(t) if first + blocks > top else (first + blocks) * block + limit
                    of.append(i)
                    made.append((r, base, len(t), t[base:stop]))
                    held += stop - base
                if made and (held > 4_000_000 or i == batch.num_rows - 1):
                    take = pa.array(of, pa.int64())
                    columns = [pa.array(c, k) for c, k in zip(zip(*made), (pa.int32(), pa.int64(), pa.int64(), pa.string()))]
                    yield pa.RecordBatch.from_arrays([*(batch.column(f.name).take(take) for f in others), *columns], names=[f.name for f in schema])
                    of, made, held = [], [], 0

    return texts.mapInArrow(run, schema)


def _boundary_table(windows: DataFrame, limit: int, overlap: int, blocks: int) -> DataFrame:
    """(row, range_no, starts, ends): the pieces of each range, by their offsets in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for r, base, n, t in zip(*(batch.column(c) for c in ("range_no", "base", "n", "t"))):
                first, size = r.as_py() * blocks, n.as_py()
                top = max(0, -(-(size - limit) // (BLOCK * limit)) - 1)
                found.append(_cuts(t.as_py(), base.as_py(), size, range(first, min(first + blocks, top + 1)), BLOCK * limit, limit, overlap))
            lists = [pa.array([[p[side] for p in x] for x in found], pa.list_(pa.int64())) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("range_no"), *lists], names=["row", "range_no", "starts", "ends"])

    return windows.mapInArrow(run, "row bigint, range_no int, starts array<bigint>, ends array<bigint>")


def _read(path: str, begin: int, stop: int) -> bytes:
    fs, where = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    with fs.open_input_file(where) as f:
        return f.read_at(stop - begin, begin)


def _decoded(raw: bytes, starts_inside: bool, ends_inside: bool) -> tuple[str, int]:
    """(text, bytes before it) of a part of a UTF-8 file, without the characters cut at its ends; other bytes are escaped, one character each."""
    first = 0
    while starts_inside and first < min(4, len(raw)) and raw[first] & 0xC0 == 0x80:
        first += 1
    end = len(raw)
    if ends_inside:
        back = next((k for k in range(1, 5) if k <= end and raw[end - k] & 0xC0 != 0x80), 0)
        lead = raw[end - back] if back else 0
        need = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        end -= back if back < need else 0
    return raw[first:end].decode("utf-8", "surrogateescape"), first


def _widths(text: str) -> np.ndarray:
    """The bytes before each character and before the end of a text that may hold escaped bytes."""
    if text.isascii():
        return np.arange(len(text) + 1)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    width = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
    width[(code >= 0xDC80) & (code <= 0xDCFF)] = 1
    return np.concatenate(([0], np.cumsum(width)))


def split_files(files: DataFrame, limit: int = 3000, overlap: int = 100, range_bytes: int = 4_000_000) -> DataFrame:
    """(path, piece_no, start_byte, end_byte, start, piece): the pieces of UTF-8 files (path, size) read by byte ranges.

    See sources.files.list_files for the files. A worker reads one range and its halo, never a whole file; how long
    ranges are doesn't change the pieces. start counts code points from the file's begin: the ranges' lengths are
    summed up. A byte that isn't UTF-8 counts as one character and comes out as U+FFFD. An empty file has one empty
    piece; a null path or size is left out, a repeated path counts once, a file that isn't there raises. Two passes read
    the bytes: one for the table of boundaries, which is checkpointed, one to emit pieces by offset. See split_texts
    for where it cuts.
    """
    _check(limit, overlap)
    block, halo = BLOCK * FILE_BLOCK * limit, 4 * (limit + 8)
    step = max(1, range_bytes // block) * block
    known = files.select(F.col("path").cast("string").alias("path"), F.col("size").cast("bigint").alias("size")).where("path is not null and size is not null").dropDuplicates(["path"])
    top = F.greatest(F.lit(0), F.ceil((F.col("size") - halo) / F.lit(block)) - 1)
    ranges = known.withColumn("top", top.cast("bigint")).withColumn("range_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("top") * block / step))))
    tasks = max(1, min(MOST_TASKS, ranges.count()))
    schema = "path string, range_no bigint, chars bigint, start_bytes array<bigint>, end_bytes array<bigint>, starts array<bigint>"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, size, top, k in zip(*(c.to_pylist() for c in batch.columns)):
                first, end = k * step // block, min((k + 1) * step // block, top + 1)
                lo, hi = first * block, size if end > top else end * block
                begin, stop = max(0, lo - halo), min(size, hi + halo)
                text, skipped = _decoded(_read(path, begin, stop), begin > 0, stop < size)
                at = _widths(text) + begin + skipped
                index = lambda byte: int(np.searchsorted(at, byte))  # noqa: B023, E731 - the first character that begins at the byte or after it
                pieces = []
                for b in range(first, end):
                    pieces += cut_range(text, index(b * block), len(text) if b == top else index((b + 1) * block), b == 0, b == top, limit, overlap)
                low = index(lo)
                out.append((path, k, (len(text) if hi == size else index(hi)) - low, [int(at[a]) for a, _ in pieces], [int(at[b]) for _, b in pieces], [a - low for a, _ in pieces]))
            types = (pa.string(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3)
            names = ["path", "range_no", "chars", "start_bytes", "end_bytes", "starts"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, types)], names=names)

    table = cut(ranges.select("path", "size", "top", "range_no").repartition(tasks, "path", "range_no").mapInArrow(find, schema))
    upto = Window.partitionBy("path").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    stitched = table.withColumns({"before": F.coalesce(F.sum(F.size("starts")).over(upto), F.lit(0)), "chars_before": F.coalesce(F.sum("chars").over(upto), F.lit(0))})

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before, chars_before, start_bytes, end_bytes, starts in zip(*(c.to_pylist() for c in batch.columns)):
                raw = _read(path, start_bytes[0], end_bytes[-1]) if starts else b""
                texts = [_ESCAPED.sub("\ufffd", raw[a - start_bytes[0] : b - start_bytes[0]].decode("utf-8", "surrogateescape")) for a, b in zip(start_bytes, end_bytes)]
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * n, pa.string()), pa.array(range(before, before + n), pa.int32()), pa.array(start_bytes, pa.int64()), pa.array(end_bytes, pa.int64()), pa.array([chars_before + s for s in starts], pa.int64()), pa.array(texts, pa.string())],
                    names=["path", "piece_no", "start_byte", "end_byte", "start", "piece"],
                )

    spread = stitched.select("path", "before", "chars_before", "start_bytes", "end_bytes", "starts").repartition(tasks)
    return spread.mapInArrow(emit, "path string, piece_no int, start_byte bigint, end_byte bigint, start bigint, piece string")
