"""Column functions on text. Where Python's and the JVM's text rules differ, these follow Python's."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: white space as Python's str methods see it, in a Java character class.
_SPACE = r"[\s\x1c-\x1f]"
#: Signs over the words that stand for them in elements, and with spaces around in chunks for prompts.
SIGNS = {"≥": "more than or equals to", "≤": "less than or equals to"}
PADDED_SIGNS = {"≥": " more than or equals to ", "≤": " less than or equals to ", ">": " more than ", "<": " less than "}
#: Phrases by which a question speaks of its source instead of its subject.
SOURCE_PHRASES = ("the source", "this information", "these guidelines", "this source")


def strip(text: Column) -> Column:
    """str.strip(): all Unicode white space at both ends."""
    return F.regexp_replace(text, rf"(?U)^{_SPACE}+|{_SPACE}+\z", "")


def strip_chars(text: Column, chars: str) -> Column:
    """str.strip(chars): any of the characters at both ends."""
    return F.btrim(text, F.lit(chars))


def split_words(text: Column) -> Column:
    """str.split(): the pieces between white space."""
    return F.filter(F.split(text, rf"(?U){_SPACE}+"), lambda w: w != "")


def replace_all(text: Column, pairs: dict[str, str]) -> Column:
    """Each key replaced by its value, in the order given."""
    return reduce(lambda t, kv: F.replace(t, F.lit(kv[0]), F.lit(kv[1])), pairs.items(), text)


def single_quotes(text: Column) -> Column:
    return F.translate(text, '"', "'")


def one_line(text: Column) -> Column:
    """Stripped, line feeds as spaces, carriage returns gone."""
    return F.translate(F.translate(strip(text), "\n", " "), "\r", "")


def strip_fence(reply: Column) -> Column:
    """A reply without the characters of a code fence and its language tag at both ends; they go as a set of characters."""
    return strip_chars(strip_chars(reply, "`json\n"), "`")


def drop_fence_lines(reply: Column) -> Column:
    """A reply fenced at both ends without its first and last line; any other as it is."""
    fenced = reply.startswith("```") & reply.endswith("```")
    return F.when(fenced, F.regexp_replace(F.regexp_replace(reply, r"(?s)\A[^\n]*\n", ""), r"(?s)\n[^\n]*\z", "")).otherwise(reply)


def speaks_of_source(question: Column) -> Column:
    """1 where the question holds one of the phrases, in any case; else 0, for null too."""
    return F.when(F.lower(question).rlike("|".join(SOURCE_PHRASES)), 1).otherwise(0)


def citation(title: Column, section: Column, pages: Column) -> Column:
    """Where an answer comes from; pages print like a list."""
    listed = F.concat(F.lit("["), F.array_join(pages.cast("array<string>"), ", "), F.lit("]"))
    return F.concat(F.lit("For more information, refer to clinical protocol "), title, F.lit(", Section "), section, F.lit(", Pages "), listed)


def numbered(statements: Column) -> Column:
    """'statement_1: ...' lines."""
    return F.array_join(F.transform(statements, lambda s, i: F.concat(F.lit("statement_"), (i + 1).cast("string"), F.lit(": "), s)), "\n")


def row_prose(row_number: Column, columns: list[tuple[str, Column]]) -> Column:
    """'In row n, The c is: v .  The d is: w .' A null prints as nan; an empty value is left out with its stop."""
    last = len(columns) - 1
    parts = [F.concat(F.lit("In row "), row_number.cast("string"), F.lit(","))]
    for i, (name, value) in enumerate(columns):
        flat = one_line(F.coalesce(value.cast("string"), F.lit("nan")))
        parts.append(F.when(flat != "", F.concat(F.lit(f"The {name} is: "), flat)))
        parts.append(F.when(flat != "", F.lit(". " if i < last else ".")))
    return strip(F.concat_ws(" ", *parts))
