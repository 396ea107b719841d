"""Scores of question-answer rows from stored replies of a model: no model is called here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docprep.functions import scores
from docprep.functions.json_repair import relevancy_items, reply_objects, statement_verdicts
from docprep.functions.text import drop_fence_lines, strip_fence

#: Statements in one verdict request, and those asked about where there are no more than a batch.
BATCH, FIRST = 5, 4


def statements_of(reply: Column) -> Column:
    """array<string>: the statements in a reply; empty for an empty one and for one that can't be parsed."""
    parsed = F.from_json(strip_fence(reply), "statements array<string>")
    none = F.array().cast("array<string>")
    return F.when(F.length(reply) == 0, none).otherwise(F.coalesce(parsed["statements"], none))


def statement_batches(statements: Column) -> Column:
    """array<array<string>>: fives and a rest for more than five statements, the first four otherwise; none for none."""
    n = F.size(statements)
    many = F.transform(F.sequence(F.lit(1), n, F.lit(BATCH)), lambda i: F.slice(statements, i, BATCH))
    return F.when(n > BATCH, many).when(n > 0, F.array(F.slice(statements, 1, FIRST))).otherwise(F.array().cast("array<array<string>>"))


def verdicts_of(replies: Column) -> Column:
    """array<struct<statement, reason, verdict>> of one reply for each batch; a reply that can't be parsed gives none."""
    items = F.transform(replies, lambda r: F.coalesce(statement_verdicts(reply_objects(r)), F.array().cast("array<struct<statement:string,reason:string,verdict:string>>")))
    return F.flatten(items)


def faithfulness(rows: DataFrame, replies: str = "verdict_replies", answer: str = "answer", skip: Column | None = None) -> DataFrame:
    """The rows with `faithfulness` and `faithfulness_reasons`: the share of statements that the contexts carry.

    replies holds one reply for each batch of statements. An empty answer scores 0; a row without verdicts, or with a
    missing one, NaN. Rows where `skip` holds, such as those that speak of their source, get NaN unread.
    """
    found = verdicts_of(F.coalesce(F.col(replies), F.array().cast("array<string>")))
    score = F.when(F.col(answer) == "", 0.0).otherwise(scores.faithfulness(F.transform(found, lambda v: v["verdict"])))
    if skip is not None:
        score = F.when(F.coalesce(skip, F.lit(False)), F.lit(float("nan"))).otherwise(score)
    return rows.withColumns({"faithfulness": score, "faithfulness_reasons": F.to_json(found)})


def answer_correctness(rows: DataFrame, reply: str = "reply", ground_truth: str = "truth_vector", answer: str = "answer_vector", weights: tuple[float, float] = (0.75, 0.25)) -> DataFrame:
    """The rows with `statement_f1`, `answer_similarity` and their weighted mean `answer_correctness`; a bad reply gives NaN."""
    lists = F.from_json(drop_fence_lines(F.col(reply)), "TP array<string>, FP array<string>, FN array<string>")
    f1 = scores.statement_f1(lists["TP"], lists["FP"], lists["FN"])
    similar = scores.cosine(F.col(ground_truth), F.col(answer)) if weights[1] else F.lit(0.0)
    named = rows.withColumns({"statement_f1": f1, "answer_similarity": similar})
    return named.withColumn("answer_correctness", scores.weighted(F.col("statement_f1"), F.col("answer_similarity"), weights))


def context_precision(rows: DataFrame, replies: str = "replies") -> DataFrame:
    """The rows with `context_precision`: average precision over one reply {reason, verdict} for each context, in their order."""
    verdicts = F.transform(F.col(replies), lambda r: F.from_json(r, "verdict string")["verdict"])
    return rows.withColumn("context_precision", scores.average_precision(verdicts))


def context_recall(rows: DataFrame, reply: str = "reply") -> DataFrame:
    """The rows with `context_recall`: the share of the truth's sentences attributed to the contexts; NaN for a bad reply."""
    objects = F.from_json(F.when(F.col(reply).startswith("["), F.col(reply)).otherwise(F.concat(F.lit("["), F.col(reply), F.lit("]"))), "array<map<string,string>>")
    return rows.withColumn("context_recall", scores.context_recall(F.transform(objects, lambda o: o["Attributed"])))


def answer_relevancy(rows: DataFrame, reply: str = "reply", question_vector: str = "question_vector", vectors: str = "generated_vectors", accept_flat: bool = False) -> DataFrame:
    """The rows with `answer_relevancy`: how near the questions that the answer would answer come to the one asked."""
    items = relevancy_items(F.col(reply), accept_flat)
    cosines = F.transform(F.col(vectors), lambda v: scores.cosine(F.col(question_vector), v))
    return rows.withColumn("answer_relevancy", scores.relevancy(cosines, F.transform(items, lambda i: i["question"]), F.transform(items, lambda i: i["noncommittal"])))
