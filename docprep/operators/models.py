"""Operators backed by a model, through clients that are handed in. Replies are stored, so that scoring never asks again."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from string import Formatter
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docprep.functions.text import numbered, single_quotes
from docprep.operators.media import EMPTY_SUMMARY, ERROR_SUMMARY
from docprep.operators.metrics import statement_batches, statements_of
from docprep.session import cut


class TextModel(Protocol):
    def generate(self, prompt: str) -> str: ...


class Embedder(Protocol):
    def embed(self, text: str) -> list[float]: ...


class OcrClient(Protocol):
    def read(self, image: bytes, rotation: int) -> str: ...


class StubModel:
    """Replies made from the prompt alone, for runs without a model: the first rule whose mark the prompt holds answers."""

    def __init__(self, rules: dict[str, str] | None = None, default: str = ""):
        self.rules, self.default = rules or {}, default

    def generate(self, prompt: str) -> str:
        return next((reply for mark, reply in self.rules.items() if mark in prompt), self.default)


class HashEmbedder:
    """Unit vectors from hashed words, for runs without a model: texts with the same words lie together."""

    def __init__(self, size: int = 64):
        self.size = size

    def embed(self, text: str) -> list[float]:
        v = [0.0] * self.size
        for w in text.lower().split():
            h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
            v[h % self.size] += 1.0 if h >> 63 else -1.0
        n = sum(x * x for x in v) ** 0.5
        return [x / n for x in v] if n else v


class ByteOcr:
    """Reads an image's bytes as text, turned back by the rotation it was written with; for tests."""

    def read(self, image: bytes, rotation: int) -> str:
        turn, _, text = image.decode("utf-8", "replace").partition("|")
        return text if turn == str(rotation) else text[::-1]


#: Prompts; our own wording. Scores don't depend on them.
PROMPTS = {
    "statements": 'Break the answer into simple statements that stand on their own. Reply as JSON {{"statements": [...]}}.\nQuestion: {question}\nAnswer: {answer}',
    "verdicts": 'For each statement say whether the context supports it. Reply as a JSON list of {{"statement_N": ..., "reason": ..., "verdict": "0" or "1"}}.\nContext: {context}\nStatements:\n{statements}',
    "correctness": 'Compare the answer with the ground truth and list the statements that are in both (TP), in the answer only (FP) and in the truth only (FN). Reply as JSON.\nQuestion: {question}\nAnswer: {answer}\nGround truth: {ground_truth}',
    "relevancy": 'Write questions that the answer would answer and say whether it is noncommittal. Reply as JSON {{"questions": [...], "noncommittal": 0 or 1}}.\nAnswer: {answer}\nContext: {context}',
    "precision": 'Was the context useful for the answer? Reply as JSON {{"reason": ..., "verdict": "0" or "1"}}.\nQuestion: {question}\nContext: {context}\nAnswer: {answer}',
    "recall": 'For each sentence of the answer say whether the context holds it. Reply as a JSON list of {{"statement_N": ..., "reason": ..., "Attributed": "0" or "1"}}.\nQuestion: {question}\nContext: {context}\nAnswer: {answer}',
    "pairs": "Write questions that a clinician could ask about the section and answer them from it. Number them as 'Question n:' and 'Answer:'.\nSection: {section}\nSource: {source}",
    "context": "Quote the sentences of the source that carry the answer.\nSource: {source}\nQuestion: {question}\nAnswer: {answer}",
    "image": "Summarise what the text read from an image says.\n{text}",
    "table": "Summarise what the table says.\n{text}",
}


def prompt(name: str, **fields: Column) -> Column:
    """The prompt with its fields filled in; a null field is ''."""
    parts: list[Column] = []
    for literal, field, *_ in Formatter().parse(PROMPTS[name]):
        parts.append(F.lit(literal))
        if field is not None:
            parts.append(F.coalesce(fields[field], F.lit("")))
    return F.concat(*parts)


def _ask(rows: DataFrame, inputs: list[str], output: str, kind: T.DataType, arrow: pa.DataType, answer: Callable[..., object]) -> DataFrame:
    """The rows with a column from a Python call for each; done once, as the result is checkpointed."""
    schema = T.StructType([*(f for f in rows.schema if f.name != output), T.StructField(output, kind)])
    names = [f.name for f in schema][:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [answer(*row) for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in inputs))]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in names), pa.array(values, arrow)], names=[*names, output])

    return cut(rows.mapInArrow(run, schema))


def generate(rows: DataFrame, prompt_column: str, output: str, model: TextModel, on_error: str = "", on_empty: str = "") -> DataFrame:
    """The rows with the model's reply to each prompt. A null prompt has a null reply; an error gives `on_error`, no text `on_empty`."""

    def answer(p: str | None) -> str | None:
        if p is None:
            return None
        try:
            return model.generate(p) or on_empty
        except Exception:  # a client may raise anything, and one bad row mustn't end the run
            return on_error

    return _ask(rows, [prompt_column], output, T.StringType(), pa.string(), answer)


def embed(rows: DataFrame, text: str, output: str, embedder: Embedder) -> DataFrame:
    return _ask(rows, [text], output, T.ArrayType(T.DoubleType()), pa.list_(pa.float64()), lambda t: None if t is None else embedder.embed(t))


def embed_each(rows: DataFrame, texts: str, output: str, embedder: Embedder) -> DataFrame:
    """The rows with a vector for each text of an array; a null array has none, a null text a null vector."""
    kind = T.ArrayType(T.ArrayType(T.DoubleType()))
    return _ask(rows, [texts], output, kind, pa.list_(pa.list_(pa.float64())), lambda ts: None if ts is None else [None if t is None else embedder.embed(t) for t in ts])


def read_images(files: DataFrame, ocr: OcrClient, vocabulary: set[str], threshold: float = 0.9, content: str = "content", output: str = "text") -> DataFrame:
    """The files with the text read from each image, turned by 90 degrees up to three times while it reads as gibberish.

    The last reading counts even if it is gibberish. The vocabulary goes to every task; it is a word list of fixed size.
    """

    def gibberish(text: str) -> bool:
        found = [w for w in text.split() if len(w) > 2]
        return sum(w.lower() in vocabulary for w in found) < len(found) * threshold

    def answer(image: bytes | None) -> str | None:
        if image is None:
            return None
        text = ""
        for rotation in (0, 90, 180, 270):
            text = ocr.read(image, rotation)
            if not gibberish(text):
                break
        return text

    return _ask(files, [content], output, T.StringType(), pa.string(), answer)


def summarise_images(texts: DataFrame, model: TextModel, text: str = "text") -> DataFrame:
    """The rows with `summary`; its own texts stand for a failed and for an empty reply."""
    asked = texts.withColumn("_prompt", prompt("image", text=F.col(text)))
    return generate(asked, "_prompt", "summary", model, ERROR_SUMMARY, EMPTY_SUMMARY).drop("_prompt")


def summarise_tables(texts: DataFrame, model: TextModel, text: str = "text") -> DataFrame:
    asked = texts.withColumn("_prompt", prompt("table", text=F.col(text)))
    return generate(asked, "_prompt", "summary", model, ERROR_SUMMARY, EMPTY_SUMMARY).drop("_prompt")


def ask_for_pairs(chunks: DataFrame, model: TextModel) -> DataFrame:
    """The chunks with `full_text`, a reply that holds question-answer pairs; '' after an error."""
    asked = chunks.withColumn("_prompt", prompt("pairs", section=F.col("section_name"), source=F.col("text_chunk")))
    return generate(asked, "_prompt", "full_text", model).drop("_prompt")


def supporting_contexts(rows: DataFrame, model: TextModel, source: str = "contexts") -> DataFrame:
    """The rows with `supporting_context`, what of the source carries the answer."""
    asked = rows.withColumn("_prompt", prompt("context", source=F.col(source), question=F.col("question"), answer=F.col("answer")))
    return generate(asked, "_prompt", "supporting_context", model).drop("_prompt")


def ask_for_verdicts(rows: DataFrame, model: TextModel) -> DataFrame:
    """The rows with `verdict_replies`, one for each batch of the answer's statements, for metrics.faithfulness."""
    asked = rows.withColumn("_prompt", F.when(F.col("answer") != "", prompt("statements", question=single_quotes(F.col("question")), answer=single_quotes(F.col("answer")))))
    said = generate(asked, "_prompt", "_reply", model)
    batches = said.withColumn("_prompts", F.transform(statement_batches(statements_of(F.coalesce("_reply", F.lit("")))), lambda b: prompt("verdicts", context=F.col("contexts"), statements=numbered(b))))

    def answer(prompts: list[str] | None) -> list[str]:
        out = []
        for p in prompts or ():
            try:
                out.append(model.generate(p))
            except Exception:  # as in generate()
                out.append("")
        return out

    return _ask(batches, ["_prompts"], "verdict_replies", T.ArrayType(T.StringType()), pa.list_(pa.string()), answer).drop("_prompt", "_reply", "_prompts")


def ask_about(rows: DataFrame, name: str, model: TextModel, truth: str = "ground_truth") -> DataFrame:
    """The rows with `reply` to the prompt for 'correctness', 'relevancy' or 'recall'; without a truth column the answer stands for it."""
    known = F.col(truth) if truth in rows.columns else F.col("answer")
    fields = {"question": F.col("question"), "answer": known if name == "recall" else F.col("answer"), "context": F.col("contexts"), "ground_truth": known}
    return generate(rows.withColumn("_prompt", prompt(name, **fields)), "_prompt", "reply", model).drop("_prompt")


def ask_about_contexts(rows: DataFrame, model: TextModel, key: str, contexts: str = "context_list", truth: str = "ground_truth") -> DataFrame:
    """(key, replies): a reply for each context in order, for metrics.context_precision."""
    known = F.col(truth) if truth in rows.columns else F.col("answer")
    each = rows.select(key, F.posexplode(contexts).alias("_pos", "_context"), F.col("question"), known.alias("_known"))
    asked = each.withColumn("_prompt", prompt("precision", question=single_quotes(F.col("question")), context=single_quotes(F.col("_context")), answer=single_quotes(F.col("_known"))))
    said = generate(asked, "_prompt", "reply", model)
    return said.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_pos", "reply"))).alias("r")).select(key, F.col("r.reply").alias("replies"))
