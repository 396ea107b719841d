"""Filling containers of fixed capacity with items, by hierarchical residual packing.

Each partition packs its own items best-fit in decreasing size and emits the containers that are nearly full. The
others become items themselves: partitions are merged like a tree and packed again, round by round, as long as a task
gets a bounded number of them and merging helps. No task holds more than a block, and between rounds only underfull
containers live.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docprep.session import cut

#: Most rows of the table of containers; it goes to every task.
MOST_SPECS = 1000
#: Items, or containers in a later round, that a task packs at once.
BLOCK = 100_000
#: Underfull containers that partitions are merged up to: later rounds never gather more in a task on average.
MERGED = 20_000
#: Bits of a container's number within its task and of the task's partition; the round takes those above.
_NUMBER_BITS, _PARTITION_BITS = 30, 28
_ITEM = pa.struct([("id", pa.int64()), ("piece_no", pa.int32()), ("start_token", pa.int64()), ("n_tokens", pa.int64())])
_BIN = pa.schema([("spec_id", pa.int32()), ("container_id", pa.int64()), ("room", pa.int64()), ("done", pa.bool_()), ("items", pa.list_(_ITEM))])
_BIN_SQL = "spec_id int, container_id bigint, room bigint, done boolean, items array<struct<id:bigint,piece_no:int,start_token:bigint,n_tokens:bigint>>"


@dataclass(frozen=True)
class Spec:
    id: int
    capacity: int
    gap: int


def best_fit(sizes: list[int], capacity: int, gap: int) -> list[list[int]]:
    """Indices by container: the largest first, each into the container that it leaves the least room in."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []  # distinct, sorted
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = bisect_left(rooms, sizes[i] + gap)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(at)
            bins[b].append(i)
            room -= sizes[i] + gap
        else:
            b, room = len(bins), capacity - sizes[i]
            bins.append([i])
        if room not in by_room:
            by_room[room] = []
            insort(rooms, room)
        by_room[room].append(b)
    return bins


def first_id(round_no: int, partition: int) -> int:
    """The first container number of a task: no other task of any round shares one, as each counts below 2**30."""
    if not 0 <= round_no < 1 << 63 - _NUMBER_BITS - _PARTITION_BITS or not 0 <= partition < 1 << _PARTITION_BITS:
        raise ValueError(f"no container numbers for partition {partition} of round {round_no}")
    return (round_no << _PARTITION_BITS | partition) << _NUMBER_BITS


def _pieces(id: int | None, n: int, capacity: int) -> Iterator[tuple[dict, int]]:
    """(item, its size): the whole text, or the pieces of one that exceeds the capacity. An empty text needs one token's room."""
    for k, start in enumerate(range(0, max(n, 1), capacity)):
        size = min(capacity, n - start)
        yield {"id": id, "piece_no": k, "start_token": start, "n_tokens": size}, max(1, size)


def _emit(found: Iterable[tuple[Spec, int, bool, list[dict]]], next_id: int) -> tuple[pa.RecordBatch, int]:
    rows = list(found)
    ids = range(next_id, next_id + len(rows))
    if ids.stop >> _NUMBER_BITS > next_id >> _NUMBER_BITS:
        raise ValueError("a task made more containers than it has numbers")
    columns = ([s.id for s, *_ in rows], list(ids), [room for _, room, *_ in rows], [done for *_, done, _ in rows], [items for *_, items in rows])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BIN)], schema=_BIN), ids.stop


def _first_round(items: DataFrame, specs: list[Spec], nearly: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = first_id(0, TaskContext.get().partitionId())
        held: list[tuple[int | None, int]] = []

        def pack() -> pa.RecordBatch:
            nonlocal next_id, held
            found = []
            for s in specs:
                cut_up = [p for id, n in held for p in _pieces(id, n, s.capacity)]
                for b in best_fit([size for _, size in cut_up], s.capacity, s.gap):
                    room = s.capacity - sum(cut_up[i][1] for i in b) - s.gap * (len(b) - 1)
                    found.append((s, room, room <= (1 - nearly) * s.capacity, [cut_up[i][0] for i in b]))
            batch, next_id = _emit(found, next_id)
            held = []
            return batch

        for batch in batches:
            for id, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append((id, n or 0))
                if len(held) >= BLOCK:
                    yield pack()
        if held:
            yield pack()

    return items.mapInArrow(run, _BIN_SQL)


def _next_round(bins: DataFrame, specs: list[Spec], nearly: float, number: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = first_id(number, TaskContext.get().partitionId())
        held: list[tuple[int, int, list[dict]]] = []

        def pack() -> pa.RecordBatch:
            nonlocal next_id, held
            found = []
            for s in specs:
                mine = [(s.capacity - room, items) for id, room, items in held if id == s.id]
                for b in best_fit([load for load, _ in mine], s.capacity, s.gap):
                    room = s.capacity - sum(mine[i][0] for i in b) - s.gap * (len(b) - 1)
                    found.append((s, room, room <= (1 - nearly) * s.capacity, [x for i in b for x in mine[i][1]]))
            batch, next_id = _emit(found, next_id)
            held = []
            return batch

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("spec_id", "room", "items"))):
                held.append(row)
                if len(held) >= BLOCK:
                    yield pack()
        if held:
            yield pack()

    return bins.mapInArrow(run, _BIN_SQL)


def merged_partitions(parts: int, left: int, fan_in: int) -> int:
    """How many partitions so many underfull containers are merged to: a fan-in fewer, but none of more than MERGED on average."""
    return max(1, min(parts, max(parts // fan_in, -(-left // MERGED))))


def read_specs(specs: DataFrame, spec_id: str, capacity: str, gap: str) -> list[Spec]:
    """The containers' specifications; few by nature, which is checked. Null ids and capacities below one are refused."""
    rows = specs.select(spec_id, capacity, gap).distinct().limit(MOST_SPECS + 1).collect()
    if len(rows) > MOST_SPECS:
        raise ValueError(f"more than {MOST_SPECS} container specifications")
    out = [Spec(r[0], r[1], r[2] or 0) for r in rows if r[0] is not None and r[1] is not None]
    if len(out) < len(rows) or len({s.id for s in out}) < len(out) or any(s.capacity < 1 or s.gap < 0 for s in out):
        raise ValueError("each specification needs its own id, a capacity of at least one and a gap of at least zero")
    return sorted(out, key=lambda s: s.id)


def pack(items: DataFrame, id: str, size: str, specs: DataFrame, spec_id: str = "spec_id", capacity: str = "capacity_tokens", gap: str = "gap_tokens", nearly: float = 0.99, fan_in: int = 8) -> DataFrame:
    """(spec_id, container_id, position, id, piece_no, start_token, n_tokens): every item in a container of each specification.

    Two items in a container are `gap` tokens apart. An item above the capacity is cut into full pieces and a rest;
    no other is cut. An item of null or no size takes one token's room, so that a container holds a bounded number.
    Null ids and repeated rows are packed like any other item. Other columns are not read; an empty table gives an
    empty result. Rounds end when
    partitions can't be merged any further (see merged_partitions) or fewer than one in fifty underfull containers went
    away.
    """
    known = read_specs(specs, spec_id, capacity, gap)
    sized = cut(items.select(F.col(id).cast("bigint").alias("id"), F.col(size).cast("bigint").alias("size")))
    bins = cut(_first_round(sized, known, nearly))
    finished = bins.where("done")
    open_bins, number = bins.where("not done"), 0
    parts, left = bins.rdd.getNumPartitions(), open_bins.count()
    while left:
        merged = merged_partitions(parts, left, fan_in)
        if merged == parts and number:
            break
        number, parts = number + 1, merged
        bins = cut(_next_round(open_bins.coalesce(parts), known, nearly, number))
        finished = finished.unionByName(bins.where("done"))
        open_bins, before = bins.where("not done"), left
        left = open_bins.count()
        if parts > 1 and left > 0.98 * before:
            break
    every = finished.unionByName(open_bins)
    return every.select("spec_id", "container_id", F.posexplode("items").alias("position", "item")).select("spec_id", "container_id", "position", "item.*").withColumnRenamed("id", id)


def fill_rates(packed: DataFrame, specs: DataFrame, spec_id: str = "spec_id", capacity: str = "capacity_tokens") -> DataFrame:
    """(spec_id, containers, tokens, fill): how much of the containers' room holds tokens."""
    by_container = packed.groupBy("spec_id", "container_id").agg(F.sum("n_tokens").alias("n"))
    totals = by_container.groupBy("spec_id").agg(F.count("*").alias("containers"), F.sum("n").alias("tokens"))
    sizes = specs.select(F.col(spec_id).alias("spec_id"), F.col(capacity).alias("c")).distinct()
    return totals.join(sizes, "spec_id").select("spec_id", "containers", "tokens", (F.col("tokens") / (F.col("containers") * F.col("c"))).alias("fill"))
