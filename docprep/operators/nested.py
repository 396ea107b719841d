"""Deeply nested records to related flat tables.

One depth-first visitor goes over each record once and emits a row per entity found, tagged with the table
it belongs to, with its own key, its parent's key and the payload as JSON. The tagged rows are written
partitioned by tag; each table is then a read of one partition with that table's schema applied. Nothing is
shuffled, a record is parsed once however many tables come out, and memory holds one record at a time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docprep.session import shared_path

_DIGITS = re.compile(r"[0-9]+")
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?")
_SPACE = re.compile(r"[ \t\n\r]*")
_LITERALS = {"true": True, "false": False, "null": None}
_BIGINT = 2**63

TAGGED = T.StructType(
    [
        T.StructField("record_id", T.LongType()),
        T.StructField("tag", T.StringType()),
        T.StructField("pk", T.LongType()),
        T.StructField("parent_pk", T.LongType()),
        T.StructField("payload", T.StringType()),
    ]
)
_TAGGED_ARROW = pa.schema([("record_id", pa.int64()), ("tag", pa.string()), ("pk", pa.int64()), ("parent_pk", pa.int64()), ("payload", pa.string())])

#: Schema applied to the payload of each tag.
TABLE_SCHEMAS = {
    "element": "object_id BIGINT, parent_object_id BIGINT, depth INT, path STRING, page BIGINT, text STRING, n_files INT",
    "file": "object_id BIGINT, parent_object_id BIGINT, ordinal INT, file_path STRING",
}


@dataclass(frozen=True)
class Shape:
    """Names of the fields that make an object an element and of those that are carried over."""

    key: str = "ObjectID"
    files: str = "filePaths"
    path: str = "Path"
    page: str = "Page"
    text: str = "Text"


def _refuse(constant: str) -> None:
    raise ValueError(f"{constant} is not JSON")


def _parse_iteratively(s: str) -> object:
    """JSON without recursion, for payloads nested deeper than the interpreter's stack allows."""
    scan = json.decoder.scanstring
    i = _SPACE.match(s, 0).end()
    root: list = []
    stack: list = [root]
    keys: list = [None]

    def put(value: object) -> None:
        top = stack[-1]
        if isinstance(top, list):
            top.append(value)
        else:
            top[keys[-1]] = value

    def key_at(i: int) -> int:
        if s[i : i + 1] != '"':
            raise ValueError("key expected")
        keys[-1], i = scan(s, i + 1, True)
        i = _SPACE.match(s, i).end()
        if s[i : i + 1] != ":":
            raise ValueError("colon expected")
        return _SPACE.match(s, i + 1).end()

    while True:
        c = s[i : i + 1]
        opened = False
        if c in ("{", "["):
            value: object = {} if c == "{" else []
            put(value)
            stack.append(value)
            keys.append(None)
            i = _SPACE.match(s, i + 1).end()
            if s[i : i + 1] != ("}" if c == "{" else "]"):
                opened = True
                if c == "{":
                    i = key_at(i)
        elif c == '"':
            value, i = scan(s, i + 1, True)
            put(value)
        elif m := _NUMBER.match(s, i):
            put(float(m.group()) if m.group(1) or m.group(2) else int(m.group()))
            i = m.end()
        else:
            word = next((w for w in _LITERALS if s.startswith(w, i)), None)
            if word is None:
                raise ValueError("value expected")
            put(_LITERALS[word])
            i += len(word)
        while not opened:
            i = _SPACE.match(s, i).end()
            if len(stack) == 1:
                if i != len(s):
                    raise ValueError("extra data")
                return root[0]
            c = s[i : i + 1]
            if c == ",":
                i = _SPACE.match(s, i + 1).end()
                if isinstance(stack[-1], dict):
                    i = key_at(i)
                opened = True
            elif c == ("}" if isinstance(stack[-1], dict) else "]"):
                stack.pop()
                keys.pop()
                i += 1
            else:
                raise ValueError("comma or end expected")


def parse(payload: str | None) -> object:
    """The parsed payload; None where it is null or not valid JSON."""
    if payload is None:
        return None
    try:
        return json.loads(payload, parse_constant=_refuse)
    except RecursionError:
        try:
            return _parse_iteratively(payload)
        except ValueError:
            return None
    except ValueError:
        return None


def element_key(value: object) -> int | None:
    """The key of an element: a whole number or its digits as text, within a bigint; else None."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, str):
        if not _DIGITS.fullmatch(value) or len(value.lstrip("0")) > 19:
            return None
        value = int(value)
    if isinstance(value, float):
        if value != value or value in (float("inf"), float("-inf")) or value != int(value):
            return None
        value = int(value)
    return value if isinstance(value, int) and -_BIGINT <= value < _BIGINT else None


def strings_in(value: object) -> list[str]:
    """Distinct strings at any depth of a value, in order; keys of objects don't count."""
    found: dict[str, None] = {}
    stack = [value]
    while stack:
        v = stack.pop()
        if isinstance(v, str):
            found.setdefault(v)
        elif isinstance(v, list):
            stack.extend(reversed(v))
        elif isinstance(v, dict):
            stack.extend(reversed(v.values()))
    return list(found)


def visit(root: object, shape: Shape) -> Iterator[tuple[str, int, int | None, dict]]:
    """Depth first, in the order of the payload: (tag, key, parent's key, row). Keys count up within the record."""
    pk = 0
    stack: list[tuple[object, int | None, int | None, int]] = [(root, None, None, 0)]
    while stack:
        node, parent, parent_id, depth = stack.pop()
        if isinstance(node, list):
            stack.extend((v, parent, parent_id, depth) for v in reversed(node) if isinstance(v, dict | list))
            continue
        if not isinstance(node, dict):
            continue
        key = element_key(node.get(shape.key))
        if key is not None:
            me, pk = pk, pk + 1
            files = strings_in(node.get(shape.files))
            page, path, text = node.get(shape.page), node.get(shape.path), node.get(shape.text)
            row = {"object_id": key, "parent_object_id": parent_id, "depth": depth, "n_files": len(files)}
            if isinstance(page, int) and not isinstance(page, bool):
                row["page"] = page
            if isinstance(path, str):
                row["path"] = path
            if isinstance(text, str):
                row["text"] = text
            yield "element", me, parent, row
            for ordinal, f in enumerate(files):
                yield "file", pk, me, {"object_id": key, "parent_object_id": parent_id, "ordinal": ordinal, "file_path": f}
                pk += 1
            parent, parent_id, depth = me, key, depth + 1
        stack.extend((v, parent, parent_id, depth) for v in reversed(node.values()) if isinstance(v, dict | list))


def emit_tagged(records: DataFrame, record_id: str = "record_id", payload: str = "payload", shape: Shape | None = None) -> DataFrame:
    """One pass over the records: rows (record_id, tag, pk, parent_pk, payload).

    Null or invalid payloads, and values other than objects and arrays, give no rows. An object is an element
    if its key field holds a whole number or digits; others are passed through, so their children are linked to
    the nearest element above. A null record_id is kept. Columns other than the two named are not read, so
    their names can't clash. Repeated records come out again under their own record_id. pk and parent_pk are
    unique within a record; parent_pk is null at the top.
    """
    shape = shape or Shape()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            size = 0
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for tag, pk, parent, row in visit(parse(text.as_py()), shape):
                    body = json.dumps(row, ensure_ascii=True)
                    size += len(body)
                    for column, value in zip(out, (rid, tag, pk, parent, body)):
                        column.append(value)
                    if size > 8_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _TAGGED_ARROW)], schema=_TAGGED_ARROW)
                        out, size = [[], [], [], [], []], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _TAGGED_ARROW)], schema=_TAGGED_ARROW)

    two = records.select(F.col(record_id).cast("bigint").alias("record_id"), F.col(payload).cast("string").alias("payload"))
    return two.mapInArrow(run, TAGGED)


def write_tagged(tagged: DataFrame, path: str) -> str:
    """Write the tagged rows partitioned by tag."""
    tagged.write.mode("overwrite").partitionBy("tag").parquet(path)
    return path


def read_table(spark, path: str, tag: str) -> DataFrame:
    """One flat table: the tag's partition, its schema applied to the payload."""
    stored = T.StructType([f for f in TAGGED if f.name != "tag"] + [T.StructField("tag", T.StringType())])
    rows = spark.read.schema(stored).parquet(path).where(F.col("tag") == tag)
    return rows.select("record_id", "pk", "parent_pk", F.from_json("payload", TABLE_SCHEMAS[tag]).alias("p")).select("record_id", "pk", "parent_pk", "p.*")


def flatten_records(records: DataFrame, record_id: str = "record_id", payload: str = "payload", shape: Shape | None = None, path: str | None = None) -> dict[str, DataFrame]:
    """The flat tables by tag ('element', 'file'), written once and linked by (record_id, parent_pk) -> (record_id, pk).

    Without a path the tagged rows go to the shared folder named by spark.checkpoint.dir. An empty input
    gives empty tables.
    """
    spark = records.sparkSession
    path = write_tagged(emit_tagged(records, record_id, payload, shape), path or shared_path(spark, "nested"))
    return {tag: read_table(spark, path, tag) for tag in TABLE_SCHEMAS}


def element_files(tables: dict[str, DataFrame]) -> DataFrame:
    """(record_id, parent_object_id, object_id, file_path): a row per element and file, '' for an element without files."""
    columns = ["record_id", "parent_object_id", "object_id", "file_path"]
    bare = tables["element"].where("n_files = 0").withColumn("file_path", F.lit(""))
    return tables["file"].select(columns).unionByName(bare.select(columns))
