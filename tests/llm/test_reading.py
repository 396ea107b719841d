import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docprep.llm import reading as R

EASY, HARD = "the cat sat on a mat and ran to us", "notwithstanding pathophysiological heterogeneity consequently necessitates multivariable recalibration"
TEXTS = ["One two. Three!? Four...", "e.g. this", "", None, " . ! ?", "no end", "a.b c. d", "A b. C", "x\n\ny? \"z.\" w.", "é à ü.", "1.5 mg. 2!", "a\x1cb."]


def plain_counts(t):
    t = t or ""
    words = [w for w in t.split() if re.search("[A-Za-z0-9]", w)]
    return len(words), len(re.findall("[A-Za-z0-9]", t)), len(re.findall(r"[.!?]+(?=\s|$)", t + "\n"))


def labelled(n, seed=0):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        level = rng.randint(1, 5)
        out.append((" ".join(" ".join(rng.choice((HARD if rng.random() < (level - 1) / 4 else EASY).split()) for _ in range(9)) + "." for _ in range(6)), float(level)))
    return out


def test_counts_of_sentences_add_up_and_do_not_depend_on_neighbours():
    s = R.sentences(TEXTS)
    _, letters, words, ends, _ = R._by_text(s, None, len(TEXTS))
    assert [tuple(int(x) for x in c) for c in zip(words, letters, ends)] == [plain_counts(t) for t in TEXTS]
    model = R.fit(*map(list, zip(*labelled(60))))
    together = R._by_text(s, model.distributions(s), len(TEXTS))[4]
    for i, t in enumerate(TEXTS):
        one = R.sentences([t])
        assert np.allclose(R._by_text(one, model.distributions(one), 1)[4][0], together[i], atol=1e-5)


def test_held_out_texts_are_ranked_by_level():
    model = R.fit(*map(list, zip(*labelled(300))))
    rest = labelled(100, seed=9)
    s = R.sentences([t for t, _ in rest])
    expected = R._by_text(s, model.distributions(s), len(rest))[4] @ np.arange(1, 6)
    found = np.interp(expected, *model.knots)
    level = np.array([y for _, y in rest])
    assert np.corrcoef(found, level)[0, 1] > 0.9 and abs(found - level).mean() < 0.7
    assert all(np.diff(model.knots[1]) > 0)


def test_reading_levels(spark):
    rows = [(i, t, "en", 1.0) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "en", 1.0), (None, "a b.", None, 2.0), (99, "word " * 300_000, "en", 0.0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, difficulty double")
    model = R.fit(*map(list, zip(*labelled(200))))
    out = R.reading_levels(df, model, keep=("lang",)).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id is not None and r.doc_id < 90:
            assert (r.n_words, r.n_letters, r.n_ends) == plain_counts(TEXTS[r.doc_id])
        assert (r.difficulty is None) == (r.n_words == 0) and (r.distribution is None or abs(sum(r.distribution) - 1) < 1e-4)
    assert {r.difficulty for r in R.reading_levels(df, None).collect()} == {None}
    assert R.reading_levels(df.limit(0), model).count() == 0


def test_labelled_sample_is_bounded_and_skips_nulls(spark):
    docs = spark.createDataFrame([(i, f"text {i}" if i else None) for i in range(50)] + [(1, "text 1")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 + i % 5) for i in range(50)] + [(1, 4), (1, 4), (2, None), (3, 9)], "doc_id bigint, level int")
    texts, levels = R.labelled_sample(docs, labels, "doc_id", "text", "level", most=30)
    assert len(texts) == len(levels) == 30 and len(set(texts)) == len(texts)
    everything = dict(zip(*R.labelled_sample(docs, labels, "doc_id", "text", "level")))
    assert len(everything) == 49 and everything["text 1"] == 4 and everything["text 3"] == 4
    assert R.fit([], []) is None and R.labelled_sample(docs, labels.limit(0), "doc_id", "text", "level") == ([], [])


@pytest.mark.parametrize("counts,name", [((10, 2, 1), "plain"), ((60, 10, 1), "standard"), ((90, 10, 1), "expert"), ((4, 1, 0), "plain")])
def test_bands(spark, counts, name):
    row = spark.createDataFrame([counts], "l bigint, w bigint, e bigint").select(R.band(R.grade(F.col("l"), F.col("w"), F.col("e"))).alias("b")).first()
    g = 4.71 * counts[0] / counts[1] + 0.5 * counts[1] / max(1, counts[2]) - 21.43
    assert row.b == ("plain" if g < 8 else "standard" if g < 18 else "expert")
