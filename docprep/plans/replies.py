"""Queries that ask a model, a stand-in that looks things up, and score its replies; the same in DuckDB's SQL."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docprep.functions.json_repair import relevancy_items, reply_objects, statement_verdicts
from docprep.operators import media as M
from docprep.operators import metrics, models, qa
from docprep.plans.pipeline import evaluate_qa, generate_qa
from docprep.session import table, tune


class LookUp:
    """A stand-in for a model: statements are the answer's sentences, and what it is asked about is looked up in the context."""

    def generate(self, prompt: str) -> str:
        field = lambda name, upto: re.search(rf"\n{name}: (.*?)(?=\n{upto}:|\Z)", prompt, re.S).group(1)
        if prompt.startswith("Break"):
            return json.dumps({"statements": [s for s in field("Answer", "None").split(". ") if s]})
        if prompt.startswith("For each statement"):
            context, statements = field("Context", "Statements"), re.findall(r"(?m)^statement_\d+: (.*)$", prompt.partition("\nStatements:\n")[2])
            said = [{"statement_1": s, "reason": "looked up", "verdict": str(int(s in context))} for s in statements]
            return "```json\n" + "\n".join(json.dumps(x) for x in said) + "\n```"
        if prompt.startswith("For each sentence"):
            context, answer = field("Context", "Answer"), field("Answer", "None")
            return json.dumps([{"statement_1": s, "reason": "looked up", "Attributed": str(int(s in context))} for s in answer.split(". ") if s])
        if prompt.startswith("Was the context"):
            return json.dumps({"reason": "looked up", "verdict": str(int(field("Answer", "None")[:20] in field("Context", "Answer")))})
        if prompt.startswith("Compare"):
            given, truth = ([s for s in field(*x).split(". ") if s] for x in (("Answer", "Ground truth"), ("Ground truth", "None")))
            return "```json\n" + json.dumps({"TP": [s for s in given if s in truth], "FP": [s for s in given if s not in truth], "FN": [s for s in truth if s not in given]}) + "\n```"
        if prompt.startswith("Write questions that the answer"):
            return json.dumps({"questions": ["q", field("Answer", "Context")[:40]], "noncommittal": int(" not " in field("Answer", "Context"))})
        if prompt.startswith("Write questions"):
            section, source = field("Section", "Source"), field("Source", "None")
            return f"**Question 1:** What does {section} say?\n**Answer:** {source[:80]}\n\n**Question 2:** How does {section} end?\n**Answer:** {source[-80:]}"
        if prompt.startswith("Summarise what the text"):
            return f"Read: {prompt.partition(chr(10))[2]}"
        raise ValueError("nothing to look up")


class Lengths:
    """A stand-in for an embedder: the vector of a text is its length and a constant."""

    def embed(self, text: str) -> list[float]:
        return [float(len(text)), 10.0]


def _plain(c: str) -> Column:
    """The column in letters, digits, blanks and full stops, single-spaced: what a line of a prompt can hold."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), "[^A-Za-z0-9 .]", " "), " +", " "))


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(tune(spark), sf_dir, "qa_rows")
    return rows.select("qa_id", "Flag_Source", *(_plain(c).alias(c) for c in ("question", "answer", "contexts")))


def _no_nan(c: str) -> Column:
    return F.when(~F.isnan(c), F.round(c, 6)).alias(c)


def asked_faithfulness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements asked for, verdicts asked for in batches, rows that speak of their source left out."""
    return evaluate_qa(_rows(spark, sf_dir), LookUp()).select("qa_id", _no_nan("faithfulness"))


def asked_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.context_recall(models.ask_about(_rows(spark, sf_dir), "recall", LookUp())).select("qa_id", _no_nan("context_recall"))


def asked_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of the contexts as contexts of their own, each asked about."""
    rows = _rows(spark, sf_dir).withColumn("context_list", F.filter(F.split("contexts", r"\. "), lambda s: s != ""))
    replies = models.ask_about_contexts(rows, LookUp(), "qa_id")
    return metrics.context_precision(replies).select("qa_id", _no_nan("context_precision"))


def asked_correctness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answer against its contexts as the truth, sentence by sentence and by vectors."""
    asked = models.ask_about(_rows(spark, sf_dir).withColumn("ground_truth", F.col("contexts")), "correctness", LookUp())
    vectors = models.embed(models.embed(asked, "answer", "answer_vector", Lengths()), "ground_truth", "truth_vector", Lengths())
    return metrics.answer_correctness(vectors).select("qa_id", _no_nan("statement_f1"), _no_nan("answer_correctness"))


def asked_relevancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions asked back from the answer, their vectors against that of the question; noncommittal answers score nothing."""
    asked = models.ask_about(_rows(spark, sf_dir), "relevancy", LookUp())
    questions = asked.withColumn("asked_back", F.transform(relevancy_items(F.col("reply")), lambda i: i["question"]))
    vectors = models.embed(models.embed_each(questions, "asked_back", "generated_vectors", Lengths()), "question", "question_vector", Lengths())
    return metrics.answer_relevancy(vectors).select("qa_id", (_no_nan("answer_relevancy") + F.lit(0.0)).alias("answer_relevancy"))


def generated_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = table(tune(spark), sf_dir, "chunks_data").withColumn("text_chunk", _plain("text_chunk")).withColumn("section_name", F.when(F.col("section_name").isNotNull(), _plain("section_name")))
    rows = generate_qa(chunks, LookUp())
    return rows.select("doc_id", "chunk_no", "pair_no", "question", "answer", F.col("Flag_Source").alias("flag_source"))


def failed_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries from a model that answers some texts, gives nothing for others and fails on the rest."""
    rows = table(tune(spark), sf_dir, "qa_rows").select("qa_id", F.when(F.col("qa_id") % 3 == 0, F.concat(F.lit("text "), F.col("qa_id").cast("string"))).when(F.col("qa_id") % 3 == 1, F.lit("nothing")).otherwise(F.lit("fail")).alias("text"))

    class Moody:
        def generate(self, prompt: str) -> str:
            text = prompt.partition("\n")[2]
            if text == "fail":
                raise RuntimeError("no reply")
            return "" if text == "nothing" else f"Read: {text}"

    return models.summarise_images(rows, Moody()).select("qa_id", "summary")


def read_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images that must be turned until they read as words; those that never do keep their last reading."""
    rows = table(tune(spark), sf_dir, "nation").select("n_nationkey", F.concat((F.col("n_nationkey") % 5 * 90).cast("string"), F.lit("|the nation read")).cast("binary").alias("content"))
    return models.read_images(rows, models.ByteOcr(), {"the", "nation", "read"}).select("n_nationkey", "text")


_SHAPES = ("nested", "fenced", "loose", "empty", "broken")


def reply_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements out of replies of every shape: nested, in a fence, objects on lines of their own, with a comma left over, empty, broken."""
    item = lambda text, verdict: f'{{"statement_1": "{text}", "reason": "r", "verdict": "{verdict}"}}'
    shapes = {
        "nested": '{"statement_1": {"text": "a", "reason": "r", "verdict": "1"}, "statement_2": {"text": "b", "reason": "r", "verdict": "0"}}',
        "fenced": f"```json\n[{item('a', 1)}, {item('b', 0)}]\n```",
        "loose": f"{item('a', 1)}\n{item('b', 0)},",
        "empty": "",
        "broken": "I could not do that.",
    }
    rows = table(tune(spark), sf_dir, "qa_rows").select("qa_id", F.explode(F.map_from_arrays(F.array(*map(F.lit, shapes)), F.array(*map(F.lit, shapes.values())))).alias("shape", "reply"))
    found = F.coalesce(statement_verdicts(reply_objects(F.col("reply"))), F.array().cast("array<struct<statement:string,reason:string,verdict:string>>"))
    return rows.select("qa_id", "shape", F.size(found).alias("n"), F.array_join(F.transform(found, lambda v: F.concat(v["statement"], v["verdict"])), ",").alias("said"))


def flagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows flagged as speaking of their source, their double quotes single."""
    rows = table(tune(spark), sf_dir, "qa_rows")
    return qa.flagged(qa.scorable(rows)).select("qa_id", "contexts")


QUERIES = {q.__name__: q for q in (asked_faithfulness, asked_recall, asked_precision, asked_correctness, asked_relevancy, generated_pairs, failed_replies, read_scans, reply_shapes, flagged_rows)}


def _sql_plain(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(coalesce({c}, ''), '[^A-Za-z0-9 .]', ' ', 'g'), ' +', ' ', 'g'))"


_SAID = f"""WITH said AS (
  SELECT qa_id, Flag_Source, {_sql_plain('answer')} AS answer, {_sql_plain('contexts')} AS contexts FROM qa_rows
), cut AS (SELECT *, list_filter(string_split(answer, '. '), lambda s: s <> '') AS s FROM said)
"""
_WRITTEN = "replace(replace(replace(replace(x, '≥', ' more than or equals to '), '≤', ' less than or equals to '), '>', ' more than '), '<', ' less than ')"
ORACLE = {
    "asked_faithfulness": _SAID
    + """, asked AS (SELECT *, CASE WHEN len(s) > 5 THEN s ELSE s[1:4] END AS a FROM cut)
SELECT qa_id, CASE WHEN Flag_Source = 1 THEN NULL WHEN answer = '' THEN 0.0 WHEN len(a) = 0 THEN NULL
  ELSE round(len(list_filter(a, lambda x: contains(contexts, trim(x))))::DOUBLE / len(a), 6) END AS faithfulness FROM asked""",
    "asked_recall": _SAID + "SELECT qa_id, CASE WHEN len(s) > 0 THEN round(len(list_filter(s, lambda x: contains(contexts, x)))::DOUBLE / len(s), 6) END AS context_recall FROM cut",
    "asked_precision": _SAID
    + """, each AS (
  SELECT qa_id, unnest(list_transform(list_filter(string_split(contexts, '. '), lambda p: p <> ''), lambda p: contains(p, answer[1:20])::INT)) AS v,
    generate_subscripts(list_filter(string_split(contexts, '. '), lambda p: p <> ''), 1) AS i FROM cut
), summed AS (SELECT *, sum(v) OVER (PARTITION BY qa_id ORDER BY i) AS k FROM each)
SELECT qa_id, round(sum(k::DOUBLE / i * v) / (sum(v) + 1e-10::DOUBLE), 6) AS context_precision FROM summed GROUP BY qa_id""",
    "asked_correctness": _SAID
    + """, sides AS (
  SELECT qa_id, s AS a, list_filter(string_split(contexts, '. '), lambda x: x <> '') AS t, length(answer)::DOUBLE AS la, length(contexts)::DOUBLE AS lt FROM cut
), counted AS (
  SELECT *, len(list_filter(a, lambda x: list_contains(t, x)))::DOUBLE AS tp, len(list_filter(a, lambda x: NOT list_contains(t, x))) AS fp, len(list_filter(t, lambda x: NOT list_contains(a, x))) AS fn FROM sides
), f AS (SELECT *, CASE WHEN tp > 0 THEN tp / (tp + 0.5::DOUBLE * (fp + fn)) ELSE 0 END AS f1 FROM counted)
SELECT qa_id, round(f1, 6) AS statement_f1, round(0.75::DOUBLE * f1 + 0.25::DOUBLE * list_cosine_similarity([la, 10.0::DOUBLE], [lt, 10.0::DOUBLE]), 6) AS answer_correctness FROM f""",
    "asked_relevancy": f"""WITH said AS (
  SELECT qa_id, {_sql_plain('question')} AS q, {_sql_plain('answer')} AS a FROM qa_rows
)
SELECT qa_id, round(CASE WHEN contains(a, ' not ') THEN 0::DOUBLE ELSE (list_cosine_similarity([length(q)::DOUBLE, 10.0::DOUBLE], [1.0::DOUBLE, 10.0::DOUBLE])
  + list_cosine_similarity([length(q)::DOUBLE, 10.0::DOUBLE], [length(a[1:40])::DOUBLE, 10.0::DOUBLE])) / 2 END, 6) AS answer_relevancy FROM said""",
    "generated_pairs": f"""WITH written AS (
  SELECT doc_id, chunk_no, {_sql_plain('section_name')} AS s, {_sql_plain('text_chunk')} AS t FROM chunks_data WHERE section_name IS NOT NULL
), pair AS (
  SELECT *, unnest([0, 1]) AS pair_no FROM written WHERE length(t) > 100
), said AS (
  SELECT doc_id, chunk_no, pair_no::INTEGER AS pair_no, CASE pair_no WHEN 0 THEN 'What does ' || s || ' say?' ELSE 'How does ' || s || ' end?' END AS question,
    trim(CASE pair_no WHEN 0 THEN t[1:80] ELSE right(t, 80) END) AS answer FROM pair
)
SELECT *, CASE WHEN regexp_matches(lower(question), 'the source|this information|these guidelines|this source') THEN 1 ELSE 0 END AS flag_source FROM said""",
    "failed_replies": f"SELECT qa_id, CASE qa_id % 3 WHEN 0 THEN 'Read: text ' || qa_id WHEN 1 THEN '{M.EMPTY_SUMMARY}' ELSE '{M.ERROR_SUMMARY}' END AS summary FROM qa_rows",
    "read_scans": "SELECT n_nationkey, CASE WHEN n_nationkey % 5 < 4 THEN 'the nation read' ELSE reverse('the nation read') END AS text FROM nation",
    "reply_shapes": """SELECT qa_id, shape, CASE WHEN shape IN ('empty', 'broken') THEN 0 ELSE 2 END AS n, CASE WHEN shape IN ('empty', 'broken') THEN '' ELSE 'a1,b0' END AS said
FROM qa_rows, (SELECT unnest(['nested', 'fenced', 'loose', 'empty', 'broken']) AS shape)""",
    "flagged_rows": """SELECT qa_id, replace(contexts, '"', '''') AS contexts FROM qa_rows WHERE Flag_Source = 1 AND contexts IS NOT NULL""",
}
