import math

import pytest
from pyspark.sql import functions as F

from docprep.functions import scores
from docprep.operators import metrics, models
from docprep.plans.pipeline import evaluate_qa, generate_qa, summarise_media


def value(spark, column, schema, *row):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first().v


def same(a, b):
    return math.isnan(a) if b is None else a == pytest.approx(b, abs=1e-9)


@pytest.mark.parametrize("verdicts,score", [(["1", "0", "0", "0"], 0.25), (["1"], 1), ([], None), (["1", None], None), (["1", "yes"], None), (None, None)])
def test_faithfulness(spark, verdicts, score):
    assert same(value(spark, scores.faithfulness(F.col("v")), "v array<string>", verdicts), score)


@pytest.mark.parametrize("flags,score", [(["1", "0", " 1 ", "0"], 0.5), (["2"], 0), (["1", ""], None), ([], None)])
def test_context_recall(spark, flags, score):
    assert same(value(spark, scores.context_recall(F.col("v")), "v array<string>", flags), score)


@pytest.mark.parametrize("flags,score", [(["1", "1", "1"], 3 / (3 + 1e-10)), (["0", "1"], 0.5 / (1 + 1e-10)), (["0"], 0), ([], 0), (["1", None], None)])
def test_average_precision(spark, flags, score):
    assert same(value(spark, scores.average_precision(F.col("v")), "v array<string>", flags), score)


@pytest.mark.parametrize("tp,fp,fn,score", [(1, 2, 5, 1 / 4.5), (1, 0, 2, 0.5), (0, 1, 1, 0), (0, 0, 0, 0), (None, 1, 1, None)])
def test_statement_f1(spark, tp, fp, fn, score):
    lists = [None if n is None else ["x"] * n for n in (tp, fp, fn)]
    assert same(value(spark, scores.statement_f1(*map(F.col, "abc")), "a array<string>, b array<string>, c array<string>", *lists), score)


def test_weighted_cosine_and_relevancy(spark):
    two = "a array<float>, b array<float>"
    assert same(value(spark, scores.cosine(F.col("a"), F.col("b")), two, [1.0, 0.0], [1.0, 1.0]), 2**-0.5) and same(value(spark, scores.cosine(F.col("a"), F.col("b")), two, [0.0], [1.0]), None)
    assert same(value(spark, scores.weighted(F.col("a"), F.col("b")), "a double, b double", 0.4, 0.8), 0.5) and same(value(spark, scores.weighted(F.col("a"), F.col("b"), (1, 0)), "a double, b double", 0.4, float("nan")), 0.4)
    rel = scores.relevancy(F.col("s"), F.col("q"), F.col("n"))
    schema = "s array<double>, q array<string>, n array<int>"
    assert same(value(spark, rel, schema, [0.5, 1.0], ["a", "b"], [0, 0]), 0.75) and same(value(spark, rel, schema, [0.5], ["a"], [1]), 0)
    assert same(value(spark, rel, schema, [0.5], [""], [0]), None) and same(value(spark, rel, schema, [], [], []), None)


@pytest.mark.parametrize("n,sizes", [(0, []), (1, [1]), (5, [4]), (6, [5, 1]), (10, [5, 5]), (12, [5, 5, 2])])
def test_batches(spark, n, sizes):
    out = value(spark, metrics.statement_batches(F.col("s")), "s array<string>", [str(i) for i in range(n)])
    assert [len(b) for b in out] == sizes and [x for b in out for x in b] == [str(i) for i in range(sum(sizes))]


def test_metrics_of_stored_replies(spark):
    rows = spark.createDataFrame([(1, "a", ['[{"statement_1":"x","reason":"r","verdict":"1"}]', "broken", '{"statement_2":"y","reason":"r","verdict":"0"}']), (2, "", None), (3, "a", []), (4, "a", ["[]"])], "id int, answer string, verdict_replies array<string>")
    got = {r.id: r.faithfulness for r in metrics.faithfulness(rows).collect()}
    assert got[1] == 0.5 and got[2] == 0 and math.isnan(got[3]) and math.isnan(got[4])
    assert all(math.isnan(r.faithfulness) for r in metrics.faithfulness(rows, skip=F.lit(True)).collect())
    c = spark.createDataFrame([('```json\n{"TP":["a"],"FP":[],"FN":["b","c"]}\n```',), ("bad",)], "reply string").withColumns({"truth_vector": F.array(F.lit(1.0)), "answer_vector": F.array(F.lit(1.0))})
    out = [r.answer_correctness for r in metrics.answer_correctness(c).collect()]
    assert out[0] == 0.75 * 0.5 + 0.25 and math.isnan(out[1])
    r = spark.createDataFrame([('[{"Attributed":"1"},{"Attributed":"0"}]',), ('{"Attributed":"1"}',), ("x",)], "reply string")
    assert [str(x.context_recall) for x in metrics.context_recall(r).collect()] == ["0.5", "1.0", "nan"]


def reverse():
    class Reverse:
        def generate(self, prompt):
            if "boom" in prompt:
                raise RuntimeError
            return prompt[::-1] if "nothing" not in prompt else ""

    return Reverse()


def test_generate_embed_and_ocr(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "boom"), (3, "nothing"), (4, None)], "id int, p string")
    assert [r.o for r in models.generate(df, "p", "o", reverse(), "E", "N").orderBy("id").collect()] == ["ba", "E", "N", None]
    v = [r.v for r in models.embed(df, "p", "v", models.HashEmbedder(8)).orderBy("id").collect()]
    assert v[3] is None and sum(x * x for x in v[0]) == pytest.approx(1)
    images = spark.createDataFrame([(1, b"0|the cat"), (2, b"180|the cat"), (3, b"9|the cat"), (4, None)], "id int, content binary")
    out = models.read_images(images, models.ByteOcr(), {"the", "cat"}).orderBy("id").collect()
    assert [r.text for r in out] == ["the cat", "the cat", "tac eht", None]
    assert [r.summary for r in models.summarise_images(out and models.read_images(images, models.ByteOcr(), {"the", "cat"}), models.StubModel({"cat": "a cat"})).orderBy("id").collect()] == ["a cat", "a cat", "Summary could not be generated.", "Summary could not be generated."]
    assert models.summarise_tables(df.select("id", F.col("p").alias("text")), reverse()).where("summary = 'Error generating summary.'").count() == 1


def test_from_chunks_to_scores(spark):
    chunks = spark.createDataFrame([("d", "S", 'The "dose" is five. ' * 10, "T", [1])], "doc_id string, section_name string, text_chunk string, Title string, pages array<int>")
    model = models.StubModel({
        "Break the answer": '{"statements": ["a", "b", "c", "d", "e", "f"]}',
        "For each statement": '[{"statement_1": "a", "reason": "r", "verdict": "1"}, {"statement_2": "b", "reason": "r", "verdict": "0"}]',
        "Write questions that a clinician": "Question 1: What is the dose?\nAnswer: Five.\nQuestion 2: What does this source say?\nAnswer: Five.",
    })
    rows = generate_qa(chunks, model)
    scored = {r.pair_no: r for r in evaluate_qa(rows, model).collect()}
    assert scored[0].faithfulness == 0.5 and len(scored[0].verdict_replies) == 2 and "'dose'" in scored[0].contexts and math.isnan(scored[1].faithfulness)
    assert all(r.faithfulness == 0.5 for r in evaluate_qa(rows, model, compat=True).collect())
    for name, mark in (("correctness", "Compare the answer"), ("relevancy", "Write questions that the answer"), ("recall", "For each sentence")):
        assert {r.reply for r in models.ask_about(rows, name, models.StubModel({mark: "yes"})).collect()} == {"yes"}
    listed = rows.withColumn("context_list", F.array("contexts", "contexts"))
    got = models.ask_about_contexts(listed, models.StubModel({"useful": '{"verdict": "1"}'}), "pair_no")
    assert {r.context_precision for r in metrics.context_precision(got).collect()} == {2 / (2 + 1e-10)}
    assert models.supporting_contexts(rows, models.StubModel({}, "q")).count() == 2


def test_summaries_are_written_back(spark):
    elements = spark.createDataFrame([("d", 0, "//Document/Table", None, 0, 5, ["tables/file1.xlsx"]), ("d", 1, "//Document/Table/TR", "cell", 0, 6, None), ("d", 2, "//Document/P", "text", 0, 7, None)], "doc_id string, pos int, Path string, Text string, Page int, ObjectID bigint, filePaths array<string>")
    tables = spark.createDataFrame([("d", "file1", 0, "A table.")], "doc_id string, file_name string, ord int, summary string")
    images = spark.createDataFrame([], "doc_id string, image_name string, ord int, summary string")
    sheet, updated = summarise_media(elements, tables, images)
    assert sheet.first().summary == "A table." and [r.Text for r in updated.orderBy("pos").collect()] == ["A table.", "", "text"]
