"""Replies of a model that should be JSON and often aren't quite."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docprep.functions.text import replace_all, strip_fence

_MAPS = "array<map<string,string>>"


def wrapped(reply: Column) -> Column:
    """A reply that isn't a list as one, with the usual slips mended: missing commas, escaped and doubled quotes, commas left over."""
    listed = F.concat(F.lit("["), F.replace(reply, F.lit("}{"), F.lit("},{")), F.lit("]"))
    mended = replace_all(listed, {'\\"': '"', '""': '"'})
    mended = replace_all(F.rtrim(mended, F.lit(",")), {"}{": "},{", ", ]": "]"})
    return F.when(reply.startswith("["), reply).otherwise(mended)


def mended_again(text: Column) -> Column:
    """The second attempt at a text that didn't parse. Objects on lines of their own get their commas too."""
    mended = replace_all(text, {'\\"': '"', '""': '"', "}{": "},{"})
    mended = F.regexp_replace(F.rtrim(mended, F.lit(",")), r"\}\s*\n+\s*\{", "},\n{")
    return F.regexp_replace(mended, r",\s*\]\s*\z", "]")


def reply_objects(reply: Column) -> Column:
    """The reply as a list of objects whose values are text; null or empty where even the mended reply isn't one. '' gives null."""
    bare = strip_fence(reply)
    text = wrapped(bare)
    first = F.from_json(text, _MAPS, {"mode": "PERMISSIVE"})
    second = F.from_json(mended_again(text), _MAPS, {"mode": "PERMISSIVE"})
    whole = lambda parsed: F.when(F.forall(parsed, lambda m: m.isNotNull()), parsed)
    return F.when(F.length(bare) > 0, F.coalesce(whole(first), whole(second)))


def statement_verdicts(objects: Column) -> Column:
    """array<struct<statement, reason, verdict>> of objects {statement_N, reason, verdict} or {statement_N: {text, reason, verdict}}.

    A nested object gives an item of its own, a flat one one item; a list with an empty object only gives none.
    """
    parts = "struct<text:string,reason:string,verdict:string>"
    item = lambda text, reason, verdict: F.struct(text.alias("statement"), reason.alias("reason"), verdict.alias("verdict"))
    flat = lambda o: F.array(item(F.element_at(F.map_values(F.map_filter(o, lambda k, _: k.startswith("statement"))), 1), o["reason"], o["verdict"]))

    def nested(o: Column) -> Column:
        return F.transform(F.map_values(o), lambda v: F.from_json(v, parts)).cast("array<struct<text:string,reason:string,verdict:string>>")

    is_nested = lambda o: (F.size(o) > 0) & F.forall(F.map_values(o), lambda v: v.startswith("{"))
    as_items = lambda o: F.when(
        is_nested(o), F.transform(nested(o), lambda s: item(F.coalesce(s["text"], F.lit("")), F.coalesce(s["reason"], F.lit("")), F.coalesce(s["verdict"], F.lit(""))))
    ).otherwise(flat(o))
    return F.flatten(F.transform(F.filter(objects, lambda o: (F.size(o) > 0) | (F.size(objects) > 1)), as_items))


def relevancy_items(reply: Column, accept_flat: bool = False) -> Column:
    """array<struct<question, noncommittal>> of {questions: [text or {question, noncommittal}], noncommittal}.

    Objects without questions are dropped, unless flat {question, noncommittal} objects are accepted. Null if it can't be parsed.
    """
    bare = F.replace(F.replace(strip_fence(reply), F.lit("```json"), F.lit("")), F.lit("```"), F.lit(","))
    listed = F.when(bare.startswith("["), bare).otherwise(F.regexp_replace(F.concat(F.lit("["), bare, F.lit("]")), r"\}\n+\{", "},\n{"))
    parsed = F.from_json(listed, "array<struct<questions:array<string>,noncommittal:int,question:string>>")
    pair = lambda q, n: F.struct(q.alias("question"), F.coalesce(n, F.lit(0)).alias("noncommittal"))

    def items(o: Column) -> Column:
        read = F.transform(o["questions"], lambda q: F.when(q.startswith("{"), F.from_json(q, "struct<question:string,noncommittal:int>")))
        inner = F.transform(o["questions"], lambda q, i: F.when(read[i].isNotNull(), pair(F.coalesce(read[i]["question"], F.lit("")), read[i]["noncommittal"])).otherwise(pair(q, o["noncommittal"])))
        flat = F.when(F.lit(accept_flat) & o["question"].isNotNull(), F.array(pair(o["question"], o["noncommittal"])))
        return F.coalesce(inner, flat, F.array().cast("array<struct<question:string,noncommittal:int>>"))

    return F.when(F.length(bare) == 0, F.array().cast("array<struct<question:string,noncommittal:int>>")).otherwise(F.flatten(F.transform(parsed, items)))
