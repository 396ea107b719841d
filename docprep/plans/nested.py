"""Queries over structured_data: nested records as flat, linked tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docprep.operators.nested import element_files, flatten_records
from docprep.session import table, tune


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = flatten_records(table(tune(spark), sf_dir, "structured_data"))
    return element_files(_below_zero(tables))


def _below_zero(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """An element at the top has parent_object_id 0."""
    return {tag: df.na.fill(0, ["parent_object_id"]) for tag, df in tables.items()}


def p1_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = flatten_records(table(tune(spark), sf_dir, "structured_data"))
    return tables["element"].select("record_id", "object_id", "parent_object_id", "path", "page", "text", "n_files")


def p1_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = flatten_records(table(tune(spark), sf_dir, "structured_data"))
    return tables["file"].select("record_id", "object_id", "parent_object_id", "file_path")


QUERIES = {"p1_found": p1_found, "p1_elements": p1_elements, "p1_files": p1_files}

_ELEMENTS = """
WITH node AS (
  SELECT s.record_id, t.key, t.value, t.type, t.fullkey, t.path
  FROM structured_data s, json_tree(CASE WHEN json_valid(s.payload) THEN s.payload END) t
), element AS (
  SELECT record_id, path AS at, TRY_CAST(value->>'$' AS BIGINT) AS object_id
  FROM node
  WHERE key = 'ObjectID' AND (type IN ('UBIGINT', 'BIGINT') OR type = 'VARCHAR' AND regexp_full_match(value->>'$', '[0-9]+'))
    AND TRY_CAST(value->>'$' AS BIGINT) IS NOT NULL
), linked AS (
  SELECT e.record_id, e.at, e.object_id, arg_max(p.object_id, length(p.at)) AS parent_object_id
  FROM element e LEFT JOIN element p
    ON p.record_id = e.record_id AND (starts_with(e.at, p.at || '.') OR starts_with(e.at, p.at || '['))
  GROUP BY ALL
), file AS (
  SELECT DISTINCT l.record_id, l.at, l.object_id, l.parent_object_id, v.value->>'$' AS file_path
  FROM linked l
  JOIN node f ON f.record_id = l.record_id AND f.key = 'filePaths' AND f.path = l.at
  JOIN node v ON v.record_id = f.record_id AND v.type = 'VARCHAR'
    AND (v.fullkey = f.fullkey OR starts_with(v.fullkey, f.fullkey || '.') OR starts_with(v.fullkey, f.fullkey || '['))
)
"""
ORACLE = {
    "p1_found": _ELEMENTS
    + """SELECT l.record_id, coalesce(l.parent_object_id, 0) AS parent_object_id, l.object_id, coalesce(f.file_path, '') AS file_path
FROM linked l LEFT JOIN file f ON f.record_id = l.record_id AND f.at = l.at""",
    "p1_elements": _ELEMENTS
    + """SELECT l.record_id, l.object_id, l.parent_object_id, p.value->>'$' AS path, CAST(g.value->>'$' AS BIGINT) AS page, t.value->>'$' AS text,
  CAST((SELECT count(*) FROM file f WHERE f.record_id = l.record_id AND f.at = l.at) AS INTEGER) AS n_files
FROM linked l
LEFT JOIN node p ON p.record_id = l.record_id AND p.path = l.at AND p.key = 'Path' AND p.type = 'VARCHAR'
LEFT JOIN node g ON g.record_id = l.record_id AND g.path = l.at AND g.key = 'Page' AND g.type IN ('UBIGINT', 'BIGINT')
LEFT JOIN node t ON t.record_id = l.record_id AND t.path = l.at AND t.key = 'Text' AND t.type = 'VARCHAR'""",
    "p1_files": _ELEMENTS + "SELECT record_id, object_id, parent_object_id, file_path FROM file",
}
