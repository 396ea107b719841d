"""Reading level of documents: every sentence classified by character and word models, then aggregated and calibrated.

Two multinomial models with L2 regularisation, one over hashed character trigrams and one over hashed words, are
fitted on a bounded sample of labelled documents; their products give each sentence a distribution over levels.
A document's distribution is that of its sentences weighted by words, and its expected level is calibrated by
monotone regression on documents the models haven't seen. All of it runs in numpy over a megabyte of text at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docprep.llm.sketch import span_hashes

LEVELS = 5
#: Most labelled documents that are fitted on, taken in the order of a hash, and the longest of them in code points.
MOST_LABELLED, LONGEST_LABELLED = 1500, 20_000
_BITS = 14
_DIM = 1 << _BITS
_CHUNK = 1_000_000
_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SEPARATOR = b"\n\n\n"


def _lut(chars: bytes, high: bool = False) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    table[128:] = high
    return table


_ALNUM = _lut(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_WORDLY = _lut(b"abcdefghijklmnopqrstuvwxyz0", high=True)
_SPACE = _lut(b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f ")
_STOP = _lut(b".!?")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[ord("0") : ord("9") + 1] = ord("0")


@dataclass
class Sentences:
    """The sentences of some texts: their text, counts and features. Features of sentence i are feature[start[i]:start[i+1]]."""

    owner: np.ndarray
    letters: np.ndarray
    words: np.ndarray
    ends: np.ndarray
    char_feature: np.ndarray
    char_start: np.ndarray
    word_feature: np.ndarray
    word_start: np.ndarray


def sentences(texts: list[str | None]) -> Sentences:
    """Cut at ., ! or ? before white space, at blank lines and at the text's end; the counts of a text's sentences add up to its own."""
    raw = [(_WIDE_SPACE.sub(" ", t) if t and not t.isascii() else t or "").encode("utf-8", "replace") + _SEPARATOR for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    text_end = np.cumsum([len(r) for r in raw])
    folded = _FOLD[data]
    space, alnum = _SPACE[data], _ALNUM[data]
    ended = np.zeros(len(data), bool)
    ended[:-1] = _STOP[data[:-1]] & space[1:]
    blank = np.flatnonzero((data[:-1] == 10) & (data[1:] == 10)) + 1
    start = np.unique(np.concatenate(([0], np.flatnonzero(ended) + 1, blank, text_end[:-1])))
    owner = np.searchsorted(text_end, start, "right")
    letters = np.add.reduceat(alnum.astype(np.int64), start)
    ends = np.add.reduceat(ended.astype(np.int64), start)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    total = np.concatenate(([0], np.cumsum(alnum)))
    first = edge[::2][total[edge[1::2]] > total[edge[::2]]]
    words = np.bincount(np.searchsorted(start, first, "right") - 1, minlength=len(start))
    wide = folded.astype(np.uint32)
    feature = np.full(len(data), _DIM, np.int32)
    feature[:-2] = (((wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]) * np.uint32(2654435761) >> np.uint32(32 - _BITS)).astype(np.int32)
    for back in range(1, len(_SEPARATOR) + 1):  # nothing of the next text shows
        feature[text_end - back] = _DIM
    token = np.flatnonzero(np.diff(np.concatenate(([False], _WORDLY[folded], [False])).astype(np.int8)))
    hashed = (span_hashes(folded, token[::2], token[1::2]) >> np.uint64(64 - _BITS)).astype(np.int32)
    return Sentences(owner, letters, words, ends, feature, np.append(start, len(data)), hashed, np.append(np.searchsorted(token[::2], start), len(hashed)))


def _scores(feature: np.ndarray, start: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """[sentences, levels]: the bias and the mean weight of the features, scaled by the root of their number."""
    size = np.diff(start)
    out = np.empty((len(size), LEVELS), np.float32)
    for level in range(LEVELS):
        sums = np.concatenate((weights[level][feature], np.zeros(1, np.float32)))
        out[:, level] = np.where(size > 0, np.add.reduceat(sums, start[:-1]), 0) / np.sqrt(np.maximum(1, size)) + weights[level][_DIM + 1]
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _fit(feature: np.ndarray, start: np.ndarray, level: np.ndarray, penalty: float = 3e-4, steps: int = 40, rate: float = 0.08) -> np.ndarray:
    """Weights [levels, features + a place for none + bias] by Adam on the regularised log loss."""
    keep = feature != _DIM
    row = np.repeat(np.arange(len(level)), np.diff(start))[keep]
    cells, count = np.unique(row.astype(np.int64) * _DIM + feature[keep], return_counts=True)
    row, column = cells // _DIM, (cells % _DIM).astype(np.int64)
    value = (count / np.sqrt(np.maximum(1, np.diff(start)))[row]).astype(np.float32)
    first = np.searchsorted(row, np.arange(len(level) + 1))
    weights = np.zeros((LEVELS, _DIM + 2), np.float32)
    mean, spread = np.zeros_like(weights), np.zeros_like(weights)
    wanted = np.eye(LEVELS, dtype=np.float32)[level]
    share = 1 / np.maximum(1, wanted.sum(axis=0) * LEVELS)  # levels weigh the same
    each = (wanted * share).sum(axis=1, keepdims=True)
    filled = np.diff(first) > 0
    for step in range(1, steps + 1):
        logits = np.empty((len(level), LEVELS), np.float32)
        for k in range(LEVELS):
            parts = np.concatenate((weights[k][column] * value, np.zeros(1, np.float32)))
            logits[:, k] = np.where(filled, np.add.reduceat(parts, first[:-1]), 0) + weights[k][_DIM + 1]
        error = (_softmax(logits) - wanted) * each
        gradient = penalty * weights
        for k in range(LEVELS):
            gradient[k][:_DIM] += np.bincount(column, error[row, k] * value, minlength=_DIM)
            gradient[k][_DIM + 1] = error[:, k].sum()
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.99 * spread + 0.01 * gradient**2
        weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-6)
    weights[:, _DIM] = 0
    return weights


def _monotone(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the increasing regression of y on x, by pooling neighbours that violate the order."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b in zip(x[order], y[order]):
        pools.append([b, 1, a, a])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m, n, lo, hi = pools.pop()
            p = pools[-1]
            pools[-1] = [(p[0] * p[1] + m * n) / (p[1] + n), p[1] + n, p[2], hi]
    return np.array([(p[2] + p[3]) / 2 for p in pools]), np.array([p[0] for p in pools])


@dataclass
class Model:
    chars: np.ndarray
    words: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]

    def distributions(self, s: Sentences) -> np.ndarray:
        return _softmax(_scores(s.char_feature, s.char_start, self.chars) + _scores(s.word_feature, s.word_start, self.words))


def _by_text(s: Sentences, levels: np.ndarray | None, n: int) -> tuple[np.ndarray, ...]:
    """(sentences with words, letters, words, ends, distribution or None) of each text."""
    add = lambda x: np.bincount(s.owner, x, minlength=n)
    spread = None
    if levels is not None:
        spread = np.stack([add(levels[:, k] * s.words) for k in range(LEVELS)], axis=1) / np.maximum(1, add(s.words))[:, None]
    return add(s.words > 0).astype(np.int64), add(s.letters).astype(np.int64), add(s.words).astype(np.int64), add(s.ends).astype(np.int64), spread


def fit(texts: list[str], levels: list[float]) -> Model | None:
    """The model of labelled texts; every fifth is kept for calibration. None if there are fewer than two."""
    if len(texts) < 2:
        return None
    held = np.arange(len(texts)) % 5 == 4
    if held.sum() < 20:
        held[:] = False
    level = np.asarray(levels, float)
    s = sentences([t for t, h in zip(texts, held) if not h])
    target = np.clip(np.rint(level[~held]).astype(int), 1, LEVELS)[s.owner] - 1
    model = Model(_fit(s.char_feature, s.char_start, target), _fit(s.word_feature, s.word_start, target), (np.array([1.0, LEVELS]), np.array([1.0, LEVELS])))
    if held.any():
        rest = [t for t, h in zip(texts, held) if h]
        s = sentences(rest)
        expected = _by_text(s, model.distributions(s), len(rest))[4] @ np.arange(1, LEVELS + 1)
        model.knots = _monotone(expected, level[held])
    return model


def labelled_sample(documents: DataFrame, labels: DataFrame, id: str, text: str, level: str, most: int = MOST_LABELLED, longest: int = LONGEST_LABELLED) -> tuple[list[str], list[float]]:
    """At most so many labelled texts, in the order of their ids' hashes, with the median of their levels.

    Null levels don't count; texts that are null, empty or too long are left out before the others are counted.
    """
    known = labels.where(F.col(level).isNotNull() & F.col(level).between(1, LEVELS)).groupBy(F.col(id).alias("i")).agg(F.median(level).alias("level"))
    texts = documents.select(F.col(id).alias("i"), F.col(text).alias("t")).where((F.length("t") > 0) & (F.length("t") <= longest))
    chosen = known.join(texts.select("i"), "i", "left_semi").withColumn("h", F.xxhash64("i")).orderBy("h", "i").limit(most)
    rows = texts.join(F.broadcast(chosen), "i").dropDuplicates(["i"]).orderBy("h", "i").collect()
    return [r.t for r in rows], [float(r.level) for r in rows]


def reading_levels(documents: DataFrame, model: Model | None, id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, keep, n_sentences, n_words, n_letters, n_ends, distribution, difficulty): a row for every document.

    Words are the pieces between white space that hold a letter or digit of ASCII, letters all such characters, ends
    the runs of ., ! or ? before white space or the end. distribution is the mean of the sentences' over the levels,
    weighted by words; difficulty the calibrated expected level. Both are null without words or without a model. A
    null text counts as ''. Repeated rows each come out; an empty table gives an empty result. Whole texts are read.
    """
    plain = ["i", *(f"k{j}" for j in range(len(keep)))]
    named = documents.select(F.col(id).alias("i"), *(F.col(k).alias(f"k{j}") for j, k in enumerate(keep)), F.col(text).cast("string").alias("t"))
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema if f.name != "t")
    context = documents.sparkSession.sparkContext.broadcast(model and (model.chars, model.words, model.knots))  # a few hundred kB whatever the data's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = context.value and Model(*context.value)
        for batch in batches:
            texts = batch.column(len(plain)).to_pylist()
            at = 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size + len(texts[stop] or "") < _CHUNK):
                    size += len(texts[stop] or "")
                    stop += 1
                s = sentences(texts[at:stop])
                count, letters, words, ends, spread = _by_text(s, m and m.distributions(s), stop - at)
                difficulty = None if spread is None else np.interp(spread @ np.arange(1, LEVELS + 1), *m.knots)
                some = words > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(at, stop - at) for c in batch.columns[:-1]),
                        *(pa.array(x, pa.int64()) for x in (count, words, letters, ends)),
                        pa.array([p.tolist() if spread is not None and ok else None for p, ok in zip(spread if spread is not None else some, some)], pa.list_(pa.float64())),
                        pa.array(difficulty if difficulty is not None else np.zeros(stop - at), pa.float64(), mask=~some if difficulty is not None else np.ones(stop - at, bool)),
                    ],
                    names=[*plain, "n_sentences", "n_words", "n_letters", "n_ends", "distribution", "difficulty"],
                )
                at = stop

    result = named.mapInArrow(run, f"{kept}, n_sentences bigint, n_words bigint, n_letters bigint, n_ends bigint, distribution array<double>, difficulty double")
    return result.select(F.col("i").alias(id), *(F.col(f"k{j}").alias(k) for j, k in enumerate(keep)), "n_sentences", "n_words", "n_letters", "n_ends", "distribution", "difficulty")


def grade(letters: Column, words: Column, ends: Column) -> Column:
    """The readability grade of counts: letters by word and words by sentence."""
    return F.lit(4.71) * letters / words + F.lit(0.5) * words / F.greatest(ends, F.lit(1)) - F.lit(21.43)


def band(g: Column) -> Column:
    return F.when(g < 8, "plain").when(g < 18, "standard").otherwise("expert")
