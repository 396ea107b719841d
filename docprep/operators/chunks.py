"""Sections and their text to final chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docprep.functions.splitter import OVERLAP, SIZE, split_column
from docprep.session import never_sent


def joined_text(texts: Column) -> Column:
    """Texts in order with a blank line between, none before the first that isn't empty; '' for none."""
    first = F.array_position(F.transform(texts, lambda t: t != ""), True)
    return F.when(first > 0, F.array_join(F.slice(texts, F.greatest(F.lit(1), first.cast("int")), F.greatest(F.lit(1), F.size(texts))), "\n\n")).otherwise(F.lit(""))


def section_texts(texts: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, section_id, section_name, text_chunk, text_id, pages): every section with its text; text before the first header is dropped.

    A section without text has '' and empty lists. pages are distinct and sorted.
    """
    body = texts.where("section_id > 0").groupBy("doc_id", "section_id")
    grouped = body.agg(F.array_sort(F.collect_list(F.struct("text_id", "Text"))).alias("t"), F.array_sort(F.collect_set("page")).alias("pages"))
    found = grouped.select("doc_id", "section_id", joined_text(F.col("t.Text")).alias("text_chunk"), F.col("t.text_id").alias("text_id"), "pages")
    joined = sections.select("doc_id", "section_id", "section_name").join(never_sent(found), ["doc_id", "section_id"], "left")
    none = F.array().cast("array<int>")
    return joined.select("doc_id", "section_id", "section_name", F.coalesce("text_chunk", F.lit("")).alias("text_chunk"), F.coalesce("text_id", none).alias("text_id"), F.coalesce("pages", none).alias("pages"))


def split_sections(whole: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """The sections with `piece_no` and their text split where it is longer than the size; each piece repeats text_id and pages."""
    others = [c for c in whole.columns if c != "text_chunk"]
    return whole.select(*others, F.posexplode(split_column(F.col("text_chunk"), size, overlap)).alias("piece_no", "text_chunk"))


def exception_chunks(texts: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, section_id, section_name, text): the text of exception sections, put together without separator; none without text."""
    marked = sections.where("is_exception").select("doc_id", "section_id", "section_name")
    grouped = texts.groupBy("doc_id", "section_id").agg(F.array_sort(F.collect_list(F.struct("text_id", "Text"))).alias("t"))
    return marked.join(never_sent(grouped), ["doc_id", "section_id"]).select("doc_id", "section_id", "section_name", F.array_join("t.Text", "").alias("text"))


def chunk_sheet(chunks: DataFrame, titles: DataFrame) -> DataFrame:
    """The final chunks with their document's first title, null if it has none; chunks without a section name are dropped, null texts are ''."""
    first = titles.groupBy("doc_id").agg(F.min_by("title_name", "pos").alias("Title"))
    named = chunks.where(F.col("section_name").isNotNull()).withColumn("text_chunk", F.coalesce("text_chunk", F.lit("")))
    return named.join(first, "doc_id", "left")
