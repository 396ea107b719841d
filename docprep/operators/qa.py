"""Chunks to prompts, replies to question-answer rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docprep.functions.text import PADDED_SIGNS, citation, replace_all, single_quotes, speaks_of_source, strip

#: A chunk must be longer than this to be asked about.
LEAST_CHUNK = 100
#: A label's stars, at the begin of a line.
_STARS = r"\*{0,2}"


def usable_chunks(chunks: DataFrame, least: int = LEAST_CHUNK) -> DataFrame:
    """Chunks with a section name and, once signs are written out, more characters than the least."""
    named = chunks.where(F.col("section_name").isNotNull())
    return named.withColumn("text_chunk", replace_all(F.col("text_chunk"), PADDED_SIGNS)).where(F.length("text_chunk") > least)


def slice_rows(rows: DataFrame, order: list[str], start: int, stop: int) -> DataFrame:
    """Rows start to stop, from 0, in the order; a top-k report, so its window is the feature."""
    return rows.orderBy(*order).offset(start).limit(stop - start)


def numbered_rows(rows: DataFrame, by: list[str], order: list[str], name: str = "row_no") -> DataFrame:
    """The rows with their number from 1 within `by`."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def _unlabelled(text: Column, label: str) -> Column:
    """The text without such labels and without stars."""
    return strip(F.translate(F.regexp_replace(text, _STARS + label, ""), "*", ""))


def qa_pairs(reply: Column) -> Column:
    """array<struct<question, answer>> of a reply in blocks, each from a line that begins with 'Question' to the next one.

    The answer begins at the first 'Answer' of its block, the question ends at the first line that begins so; a block
    without such a line, and what stands before the first block, is left out.
    """
    blocks = F.filter(F.split(reply, rf"(?m)^(?={_STARS}Question)"), lambda b: b.rlike(rf"^{_STARS}Question [^\x00]*\n{_STARS}Answer"))

    def pair(block: Column) -> Column:
        asked = F.split(block, rf"\n(?={_STARS}Answer)", 2)[0]
        answered = F.substring(block, F.locate("Answer", block), F.length(block))
        return F.struct(_unlabelled(asked, r"Question\s*\d*:").alias("question"), _unlabelled(answered, rf"Answer{_STARS}:").alias("answer"))

    return F.transform(blocks, pair)


def qa_rows(chunks: DataFrame, reply: str = "full_text", title: str = "Title", section: str = "section_name", pages: str = "pages") -> DataFrame:
    """A row for each pair in a chunk's reply: question, answer, pair_no, reference, contexts and the chunk's other columns."""
    pairs = chunks.select("*", F.posexplode(qa_pairs(F.col(reply))).alias("pair_no", "_qa"))
    named = pairs.withColumns({"question": F.col("_qa.question"), "answer": F.col("_qa.answer"), "reference": citation(F.col(title), F.col(section), F.col(pages))})
    return named.drop("_qa").withColumnRenamed("text_chunk", "contexts").withColumn("Flag_Source", speaks_of_source(F.col("question")))


def scorable(rows: DataFrame) -> DataFrame:
    """Rows with contexts, their double quotes single."""
    return rows.where(F.col("contexts").isNotNull()).withColumn("contexts", single_quotes(F.col("contexts")))


def flagged(rows: DataFrame) -> DataFrame:
    return rows.where("Flag_Source = 1")
