"""Scores over verdicts and embeddings. A missing verdict is NaN and makes the score NaN; null is never used for it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _nan() -> Column:
    return F.lit(float("nan"))


def mean(values: Column) -> Column:
    """The mean of an array of doubles; NaN for an empty or null one."""
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return F.when(F.coalesce(F.size(values), F.lit(-1)) > 0, total / F.size(values)).otherwise(_nan())


def verdict_values(verdicts: Column) -> Column:
    """'1' -> 1, '0' -> 0, else NaN."""
    return F.transform(verdicts, lambda v: F.when(v == "1", 1.0).when(v == "0", 0.0).otherwise(_nan()))


def attributed_values(flags: Column) -> Column:
    """A missing or empty flag is NaN; else whether it is '1' without space around."""
    return F.transform(flags, lambda v: F.when(v.isNull() | (v == ""), _nan()).when(F.trim(v) == "1", 1.0).otherwise(0.0))


def faithfulness(verdicts: Column) -> Column:
    return mean(verdict_values(verdicts))


def context_recall(flags: Column) -> Column:
    return mean(attributed_values(flags))


def average_precision(flags: Column) -> Column:
    """Precision at each useful context, averaged; 0 for none."""
    v = attributed_values(flags)
    total = F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("n"), F.lit(0.0).alias("top"))
    step = lambda a, x: F.struct((a["sum"] + x).alias("sum"), (a["n"] + 1).alias("n"), (a["top"] + (a["sum"] + x) / (a["n"] + 1) * x).alias("top"))
    return F.aggregate(v, start, step)["top"] / (total + F.lit(1e-10))


def statement_f1(tp: Column, fp: Column, fn: Column) -> Column:
    """F1 of three lists; NaN if one is missing, 0 without true positives."""
    n = [F.when(x.isNotNull(), F.size(x)).cast("double") for x in (tp, fp, fn)]
    some = tp.isNotNull() & fp.isNotNull() & fn.isNotNull()
    return F.when(~some, _nan()).when(F.size(tp) > 0, n[0] / (n[0] + 0.5 * (n[1] + n[2]))).otherwise(F.lit(0.0))


def weighted(first: Column, second: Column, weights: tuple[float, float] = (0.75, 0.25)) -> Column:
    """The weighted mean; a second weight of 0 leaves the second score out."""
    a, b = weights
    if b == 0:
        return first * F.lit(1.0)
    return (first * F.lit(a) + second * F.lit(b)) / F.lit(a + b)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in doubles; NaN for a zero vector."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(_nan())


def relevancy(similarities: Column, questions: Column, noncommittal: Column) -> Column:
    """The mean similarity, 0 if any question is noncommittal; NaN without any question text."""
    asked = F.exists(questions, lambda q: q != "")
    score = mean(similarities) * F.when(F.exists(noncommittal, lambda n: n != 0), 0.0).otherwise(1.0)
    return F.when(F.coalesce(asked, F.lit(False)), score).otherwise(_nan())
