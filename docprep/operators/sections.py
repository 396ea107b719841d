"""Elements in reading order to titles, sections, text chunks, tables and figures of each document.

Everything hangs on running counts in reading order. They are taken in two steps, within blocks of positions and
over the blocks' totals, so that a document with a third of all rows is many partitions and not one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docprep.functions.text import SIGNS, replace_all, strip
from docprep.profiles import GENERIC, PROFILES, Profile, media_class

#: Positions in one block of a document.
BLOCK = 20_000


def latest_delivery(elements: DataFrame, key: tuple[str, ...] = ("doc_id", "pos"), arrived: str = "arrived_at") -> DataFrame:
    """One row for each key, of the last to arrive; of rows that arrived together one by a hash of its other columns, the same in every run."""
    others = [c for c in elements.columns if c not in (*key, arrived)]
    newest = F.max_by(F.struct(*(F.col(c) for c in (arrived, *others))), F.struct(F.coalesce(F.col(arrived), F.lit("0001-01-01").cast("timestamp")), -F.xxhash64(*others).cast("decimal(20,0)")))
    return elements.groupBy(*key).agg(newest.alias("r")).select(*key, "r.*").select(elements.columns)


def replace_signs(elements: DataFrame, signs: dict[str, str] = SIGNS) -> DataFrame:
    """Comparison signs as words in every text column; other columns are untouched."""
    text = {f.name for f in elements.schema if f.dataType.typeName() == "string"}
    return elements.select(*(replace_all(F.col(c), signs).alias(c) if c in text else F.col(c) for c in elements.columns))


def running_sums(rows: DataFrame, document: str, position: str, flags: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """The rows with the running sum of each flag over their document, in the order of position, their own included."""
    numbered = rows.withColumn("_block", F.floor(F.col(position) / block))
    inner = Window.partitionBy(document, "_block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    within = numbered.select("*", *(F.sum(flag.cast("int")).over(inner).alias(f"_in_{name}") for name, flag in flags.items()))
    # a block's totals are its last running sums: the same shuffle serves both, and what comes before it runs once
    totals = within.groupBy(document, "_block").agg(*(F.max(f"_in_{name}").alias(f"_all_{name}") for name in flags))
    before = Window.partitionBy(document).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col(document).alias("_d"), F.col("_block").alias("_b"), *(F.coalesce(F.sum(f"_all_{name}").over(before), F.lit(0)).alias(f"_off_{name}") for name in flags))
    joined = within.join(offsets, F.col(document).eqNullSafe(F.col("_d")) & F.col("_block").eqNullSafe(F.col("_b")))
    return joined.select(*rows.columns, *((F.col(f"_in_{name}") + F.col(f"_off_{name}")).cast("int").alias(name) for name in flags))


def _by_profile(profile: Column | None, profiles: dict[str, Profile], of) -> Column:
    default = of(GENERIC)
    if profile is None:
        return default
    return reduce(lambda otherwise, p: F.when(profile == p.name, of(p)).otherwise(otherwise), profiles.values(), default)


def classify(elements: DataFrame, profile: str | None = None, profiles: dict[str, Profile] = PROFILES, block: int = BLOCK) -> DataFrame:
    """Elements up to their document's stop, with class, is_title and running ids.

    Adds cls (TITLE, KEEP, HEADER, TEXT, TABLE, FIGURE or null), is_title, page_no (from 1) and title_id, section_id,
    text_id, table_id, figure_id as they stand after the row. What follows the stop is gone, tables too; a title on the
    stop row itself stays. Rows must be unique by (doc_id, pos). `profile` names a column; without one, or where its
    value is unknown, the generic profile holds. Null text is not the same as ''.
    """
    path, text = F.col("Path"), F.col("Text")
    name = F.col(profile) if profile else None
    ready = elements.withColumn("_stripped", strip(text))  # once, as many rules ask for it
    written = _by_profile(name, profiles, lambda p: p.row_class(path, text, F.col("_stripped")))
    marked = ready.withColumn("cls", F.when(text.isNull(), media_class(path)).otherwise(written)).drop("_stripped")
    marked = marked.withColumn("is_title", F.coalesce(text.isNotNull() & _by_profile(name, profiles, lambda p: p.is_title(path)), F.lit(False)))
    cls = F.coalesce(F.col("cls"), F.lit(""))
    flags = {
        "title_id": F.col("is_title"),
        "section_id": cls.isin("KEEP", "HEADER"),
        "text_id": cls == "TEXT",
        "table_id": cls == "TABLE",
        "figure_id": cls == "FIGURE",
        "_stops": cls == "STOP",
    }
    counted = running_sums(marked, "doc_id", "pos", flags, block)
    kept = counted.where((F.col("_stops") == 0) | ((F.col("_stops") == 1) & (cls == "STOP") & F.col("is_title")))
    return kept.drop("_stops").withColumn("page_no", F.col("Page") + 1)


def element_of(path: Column, kind: str) -> Column:
    """The table or figure at the top of the document that a path lies in, like '//Document/Table[2]/'; else null."""
    return F.nullif(F.regexp_extract(path, rf"//Document/{kind}(?:\[\d+\])?/", 0), F.lit(""))


def titles(classified: DataFrame) -> DataFrame:
    return classified.where("is_title").select("doc_id", "title_id", F.col("Text").alias("title_name"), "Path", F.col("page_no").alias("page"), "ObjectID", "pos")


def sections(classified: DataFrame) -> DataFrame:
    """(doc_id, section_id, section_name, Path, page, ObjectID, is_exception, pos)."""
    rows = classified.where(F.col("cls").isin("KEEP", "HEADER"))
    return rows.select("doc_id", "section_id", F.col("Text").alias("section_name"), "Path", F.col("page_no").alias("page"), "ObjectID", (F.col("cls") == "KEEP").alias("is_exception"), "pos")


def text_chunks(classified: DataFrame) -> DataFrame:
    """(doc_id, text_id, section_id, Path, Text, page, ObjectID, add_element, add_element_table, pos); section 0 comes before the first header.

    add_element tells figures only; tables have a column of their own.
    """
    rows = classified.where(F.col("cls") == "TEXT")
    return rows.select("doc_id", "text_id", "section_id", "Path", "Text", F.col("page_no").alias("page"), "ObjectID", element_of(F.col("Path"), "Figure").alias("add_element"), element_of(F.col("Path"), "Table").alias("add_element_table"), "pos")


def media(classified: DataFrame, kind: str) -> DataFrame:
    """(doc_id, table_id or figure_id, Path, page, filePath, ObjectID): elements without text that are a table or figure themselves."""
    number = f"{kind.lower()}_id"
    return classified.where(F.col("cls") == kind.upper()).select("doc_id", number, "Path", F.col("page_no").alias("page"), F.col("filePaths").alias("filePath"), "ObjectID")
