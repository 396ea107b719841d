"""The pipelines: documents to chunks, media summaries written back, chunks to scored question-answer rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docprep.functions.splitter import OVERLAP, SIZE
from docprep.operators import chunks as C
from docprep.operators import media as M
from docprep.operators import metrics, models, qa
from docprep.operators import sections as S
from docprep.profiles import profile_name
from docprep.session import cut
from docprep.sources.files import unprocessed


def with_profiles(elements: DataFrame, guidelines: DataFrame) -> DataFrame:
    """Elements with their document's profile name."""
    known = guidelines.select("doc_id", profile_name(F.col("profile")).alias("profile")).dropDuplicates(["doc_id"])
    return elements.join(known, "doc_id", "left")


def classified(elements: DataFrame, guidelines: DataFrame | None = None) -> DataFrame:
    """Elements once each, signs written out, classified by their document's profile."""
    once = S.latest_delivery(elements) if "arrived_at" in elements.columns else elements
    named = with_profiles(once, guidelines) if guidelines is not None else once
    return S.classify(S.replace_signs(named), "profile" if guidelines is not None else None)


def chunk_documents(elements: DataFrame, guidelines: DataFrame | None = None, size: int = SIZE, overlap: int = OVERLAP, reuse: bool = False, rows: DataFrame | None = None) -> dict[str, DataFrame]:
    """The data sets of a chunking run by name, each with doc_id: titles, sections, text_chunks, tables, figures, exception_chunks, final_chunks.

    With reuse the classified elements are checkpointed, for runs that write several of the sets. Elements that are
    classified already can be handed in as rows.
    """
    rows = rows if rows is not None else classified(elements, guidelines)
    if reuse:
        rows = cut(rows)
    sections, texts, titles = S.sections(rows), S.text_chunks(rows), S.titles(rows)
    whole = C.section_texts(texts, sections)
    return {
        "titles": titles,
        "sections": sections,
        "text_chunks": texts,
        "tables": S.media(rows, "table"),
        "figures": S.media(rows, "figure"),
        "exception_chunks": C.exception_chunks(texts, sections),
        "final_chunks": C.chunk_sheet(C.split_sections(whole, size, overlap), titles),
    }


def summarise_media(elements: DataFrame, table_summaries: DataFrame, image_summaries: DataFrame, match: str = "substring") -> tuple[DataFrame, DataFrame]:
    """(sheet, elements): the inventory of media with its summaries, and the elements with these written back."""
    sheet = cut(M.media_inventory(elements).withColumn("summary", F.lit(None).cast("string")))  # each merge reads it twice
    merged = M.fill_summaries(M.merge_summaries(sheet, table_summaries, ("object_id_file", "ord")), image_summaries, ("object_id_file", "ord"))
    return merged, M.write_back(elements, merged, match)


def generate_qa(chunks: DataFrame, model: models.TextModel) -> DataFrame:
    """Question-answer rows of the usable chunks; double quotes in contexts become single."""
    return qa.scorable(qa.qa_rows(models.ask_for_pairs(qa.usable_chunks(chunks), model)))


def evaluate_qa(rows: DataFrame, model: models.TextModel, skip: Column | None = None, compat: bool = False) -> DataFrame:
    """The rows with faithfulness; those that speak of their source aren't scored, unless compat asks for all."""
    chosen = None if compat else (skip if skip is not None else F.col("Flag_Source") == 1)
    asked = models.ask_for_verdicts(rows, model)
    return metrics.faithfulness(asked, skip=chosen)


def chunk_new_documents(elements: DataFrame, done: DataFrame, guidelines: DataFrame | None = None) -> dict[str, DataFrame]:
    """chunk_documents for documents that aren't among those done."""
    return chunk_documents(unprocessed(elements, done, "doc_id"), guidelines)
